"""Ids of a lower-casing, word-end tokenizers file, a cached white-space chunk at a time.

The tokenizer drops white space and treats each match of its pattern by itself, so a chunk between
white space always gets the same ids. Chunks are looked up in a bounded cache; a new one is split
and merged by tiktoken, to which the file's merges are given as ranks, the word end as a byte that
no text holds. Texts with characters on which Unicode versions or context-dependent lower-casing may
disagree, or with the string of a special token, go to the library whole. Ids are the library's (tested).
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

#: Chunks a generation of the cache holds (there are two), and characters of the longest chunk it keeps.
CACHED, LONGEST = 300_000, 48
WORD_END, END_BYTE = "</w>", b"\xff"

#: Characters that Unicode versions class alike (blocks of letters, punctuation and signs without gaps).
#: Left out: U+03A3, which Python lower-cases by context, and four control characters that only Python calls white space.
CONTROLS = "\x1c\x1d\x1e\x1f"
ALIKE = "\x00-\x1b\x20-˿̀-ͷΆ-΢Τ-ԯḀ-ỿ‐-⁤₠-₿℀-↋←-⏿─-⯏ぁ-ゖァ-ヿ一-鿕가-힣！-ﾾ\U0001f300-\U0001f64f"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def as_ranks(model: dict) -> dict[bytes, int] | None:
    """The model's tokens as bytes with their ids, if ids go up in the order of merges."""
    letters = byte_letters()
    first = len(model["vocab"])
    ranks = {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    for a, b in merges:
        first = min(first, model["vocab"][a + b])
    if any(model["vocab"][a + b] != first + i for i, (a, b) in enumerate(merges)):
        return None
    for token, id in model["vocab"].items():
        if id < first + len(merges):
            body, end = (token[: -len(WORD_END)], END_BYTE) if token.endswith(WORD_END) else (token, b"")
            ranks[bytes(letters[c] for c in body) + end] = id
    return ranks


class Chunks(dict):
    """Chunk -> its ids as bytes (unsigned, 32 bits). Once full, only chunks seen again since are kept."""

    def __init__(self, find: Callable, merge: Callable):
        self.find, self.merge, self.before = find, merge, {}

    def __missing__(self, chunk: str) -> bytes:
        data = self.before.get(chunk)
        if data is None:
            if chunk.isalpha():
                ids = self.merge(chunk.encode() + END_BYTE)
            else:
                ids = [i for piece in self.find(chunk) for i in self.merge(piece.encode() + END_BYTE)]
            data = array("I", ids).tobytes()
        if len(chunk) <= LONGEST:
            if len(self) >= CACHED:
                self.before = dict(self)
                self.clear()
            self[chunk] = data
        return data


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], bytes]:
    """Text -> ids as bytes, by the tokenizers file ``path`` without added special tokens."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import regex
    import tiktoken
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    whole = lambda text: array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    ranks = as_ranks(spec["model"])
    splits = [p for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
    if ranks is None or len(splits) != 1 or spec["model"].get("end_of_word_suffix") != WORD_END:
        return whole
    pattern = splits[0]["pattern"]["Regex"]
    merge = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece
    known = Chunks(regex.compile(pattern).findall, merge)
    odd = regex.compile(f"[^{ALIKE}]").search
    strange = [*CONTROLS, *(t["content"] for t in spec["added_tokens"])]

    def encode(text: str) -> bytes:
        if any(s in text for s in strange) or not text.isascii() and odd(text):
            return whole(text)
        return b"".join(map(known.__getitem__, unicodedata.normalize("NFC", text).lower().split()))

    return encode

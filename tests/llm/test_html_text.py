"""Layout rules on small pages; words against a plain parser on the whole table."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pytest

from tidebook.llm.common import table
from tidebook.llm.html_text import MAX_DEPTH, extract, visible_text

CASES = [
    ("", ""),
    (None, ""),
    ("plain", "plain"),
    ("<p>a<p>b", "a\n\nb"),
    ("a < b <c", "a < b"),
    ("<b>x</b> <i>y</i>z &amp; &lt;t", "x yz & <t"),
    ("<p>one <b>two<p>three</b> four", "one two\n\nthree four"),
    ("<ul><li>one<li>two<ul><li>x</ul></ul>after", "- one\n- two\n  - x\n\nafter"),
    ("<ol start=3><li>t<li>u</ol>", "3. t\n4. u"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>z", "a     bbb\ncccc  d\n\nz"),
    ("<table><tr><th>H1<th>H2<tr><td colspan=2>wide<tr><td>1<td><ul><li>q<li>r</ul></table>", "H1  H2\nwide\n1   - q\n    - r"),
    ("<pre>a\n  b\n</pre>c", "a\n  b\n\nc"),
    ('<div style="display: none">no<p>no</div>yes<br>line', "yes\nline"),
    ("<p hidden>no</p><template>no</template><noscript>no</noscript>yes", "yes"),
    ('<head><title>t</title></head><body><script>var t="</p>";</script>v</body>', "v"),
    ("<script>never closed", ""),
    ("<!-- gone -- > still -->shown<!-- open", "shown"),
    ('<a href="x>y" title=\'q\'>link</a>', "link"),
    ("<td>loose</td>", "loose"),
    ("<dl><dt>term<dd>meaning<dt>more</dl>", "term\n  meaning\nmore"),
    ("<blockquote>quoted</blockquote>", "  quoted"),
    ("<textarea><b>raw</b></textarea>", "<b>raw</b>"),
    ("<table><tr><td>a<table><tr><td>in</table><td>b</table>", "a   b\nin"),
    ("  lots \n of\t space  <span> here</span>", "lots of space here"),
]


@pytest.mark.parametrize(("html", "text"), CASES)
def test_layout(html, text):
    assert visible_text(html) == text


def test_deep_nesting_and_long_pages():
    assert visible_text("<div>" * (5 * MAX_DEPTH) + "deep") == "deep"
    assert visible_text("<ul><li>" * 2000 + "x").endswith("x")
    assert len(visible_text("<p>" + "word " * 100_000)) == 499_999
    assert visible_text("<a " * 5000) == ""


class Plain(HTMLParser):
    """Text outside head, scripts and styles; every tag but inline ones parts words."""

    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("head", "script", "style", "title")
        self.out.append("" if tag in ("a", "b", "i", "span") else " ")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("head", "script", "style", "title")
        self.out.append("" if tag in ("a", "b", "i", "span") else " ")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_words_of_the_whole_table(spark, sf):
    rows = extract(table(spark, sf, "pages")).collect()
    assert len(rows) == table(spark, sf, "pages").count()
    for row in rows:
        parser = Plain()
        parser.feed(row["html"] or "")
        parser.close()
        assert re.sub(r"(?m)^ *- ", "", row["text"]).split() == "".join(parser.out).split()


def test_in_spark(spark):
    pages = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (3, "<p>x", "u"), (3, "<p>x", "u")], "page_id long, html string, text string")
    out = extract(pages).collect()
    assert [(r["page_id"], r["text"]) for r in out] == [(1, ""), (2, ""), (3, "x"), (3, "x")]
    assert extract(pages.limit(0)).count() == 0

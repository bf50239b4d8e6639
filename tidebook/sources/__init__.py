from tidebook.sources.readers import (  # noqa: F401
    flatten,
    land,
    read_csv,
    read_json_array,
    read_json_lines,
    replace_table,
    row_floor,
    stamp,
)
from tidebook.sources.schemas import RAW_SCHEMAS  # noqa: F401
from tidebook.sources.sinks import export, manifest_rows, write_csv, write_parquet  # noqa: F401

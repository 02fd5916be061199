"""Table and file sources."""

from tierflow.sources.files import (
    MALFORMED,
    READ_OPTIONS,
    TEXT_FORMATS,
    UNKNOWN,
    WRITE_OPTIONS,
    as_text,
    infer_schema,
    list_files,
    load_schema,
    read_csv,
    read_file_stream,
    save_schema,
    with_lineage,
)
from tierflow.sources.headers import HeaderGroup, by_header, infer_by_header, read_by_header
from tierflow.sources.schema_log import add_schema, latest_schema, schema_versions
from tierflow.sources.tables import read_table

__all__ = [
    "HeaderGroup",
    "MALFORMED",
    "READ_OPTIONS",
    "TEXT_FORMATS",
    "UNKNOWN",
    "WRITE_OPTIONS",
    "add_schema",
    "as_text",
    "by_header",
    "infer_by_header",
    "infer_schema",
    "latest_schema",
    "list_files",
    "load_schema",
    "read_by_header",
    "read_csv",
    "read_file_stream",
    "read_table",
    "save_schema",
    "schema_versions",
    "with_lineage",
]

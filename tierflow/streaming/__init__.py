"""Structured Streaming: raw ingestion and streaming refinement."""

from tierflow.streaming.batches import batch_log
from tierflow.streaming.ingest import (
    append_headed,
    append_stream,
    bronze_schema,
    bronze_stream,
    cleaned_schema,
    headed_rows,
)
from tierflow.streaming.silver import append_refined

__all__ = [
    "append_headed",
    "append_refined",
    "append_stream",
    "batch_log",
    "bronze_schema",
    "bronze_stream",
    "cleaned_schema",
    "headed_rows",
]

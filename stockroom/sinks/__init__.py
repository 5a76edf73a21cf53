"""Materializations of model results."""

from stockroom.sinks.tables import (
    PART, SchemaDriftError, as_view, assert_same_schema, bucket_of, committed_mark, create_view, incremental_or_full,
    merge_by_key, missing_days, processed_days, read_table, rebucket, replace_time_range, table_exists,
    with_comments, write_full,
)

__all__ = [n for n in dir() if not n.startswith("_")]

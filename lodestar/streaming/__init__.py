from lodestar.streaming.flows import (
    append_stream,
    apply_changes_stream,
    dedup_append,
    staged,
    table_stream,
    without_repeats,
)

__all__ = ["append_stream", "apply_changes_stream", "dedup_append", "staged", "table_stream", "without_repeats"]

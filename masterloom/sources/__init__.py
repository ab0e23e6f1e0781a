"""File drops, slices of tables, and table and file sinks."""

from masterloom.sources.current import keep_newest
from masterloom.sources.drops import NewestFile, file_stamps, latest_batch, list_files, newest_file, read_drop
from masterloom.sources.export import export_csv
from masterloom.sources.footers import footer_stamps
from masterloom.sources.ledger import Load, RunLedger
from masterloom.sources.slices import batch_slice, utc_text, watermark_slice
from masterloom.sources.tables import (
    DuplicateKeyError,
    any_known,
    append_evolving,
    drop_partition,
    ensure_table,
    many_partitions,
    merge_table,
    of_keys,
    read_evolved,
    replace_contents,
    replace_partition,
    rows_of_keys,
    staged,
    widen_table,
)

__all__ = [
    "DuplicateKeyError",
    "Load",
    "NewestFile",
    "RunLedger",
    "any_known",
    "append_evolving",
    "batch_slice",
    "drop_partition",
    "ensure_table",
    "export_csv",
    "file_stamps",
    "footer_stamps",
    "keep_newest",
    "latest_batch",
    "list_files",
    "many_partitions",
    "merge_table",
    "newest_file",
    "of_keys",
    "read_drop",
    "read_evolved",
    "replace_contents",
    "replace_partition",
    "rows_of_keys",
    "staged",
    "utc_text",
    "watermark_slice",
    "widen_table",
]

from .progress import ProgressLog, late_rows, progress_samples, progress_table, record_progress
from .replay import ROWS_A_FILE, add_slices, arrival_slice, write_even_slices, write_slices
from .runs import SCALE_CONF, finish, run_for, session_conf, start_at_scale
from .versions import VersionedTable, start_snapshots, start_upserts
from .writers import (
    AVAILABLE_NOW,
    OUTPUT_MODES,
    checkpointed_writer,
    console_writer,
    jdbc_batch_writer,
    memory_writer,
    set_checkpoint_root,
    start_delta,
    start_files,
    start_jdbc,
)

__all__ = [
    "AVAILABLE_NOW",
    "OUTPUT_MODES",
    "SCALE_CONF",
    "VersionedTable",
    "add_slices",
    "arrival_slice",
    "checkpointed_writer",
    "console_writer",
    "finish",
    "jdbc_batch_writer",
    "ProgressLog",
    "late_rows",
    "memory_writer",
    "progress_samples",
    "record_progress",
    "progress_table",
    "run_for",
    "session_conf",
    "set_checkpoint_root",
    "start_at_scale",
    "start_delta",
    "start_files",
    "start_jdbc",
    "start_snapshots",
    "start_upserts",
    "write_even_slices",
    "write_slices",
]

from sparkseries.sources.delimited import read_inferred, read_text_columns, write_csv
from sparkseries.sources.layers import read_layer, stack_layers, write_layer
from sparkseries.sources.registry import latest_model, log_run, read_runs, register_model, run_table
from sparkseries.sources.snapshots import history, read_snapshot, write_snapshot

__all__ = [
    "history",
    "latest_model",
    "log_run",
    "read_inferred",
    "read_layer",
    "read_runs",
    "read_snapshot",
    "read_text_columns",
    "register_model",
    "run_table",
    "stack_layers",
    "write_csv",
    "write_layer",
    "write_snapshot",
]

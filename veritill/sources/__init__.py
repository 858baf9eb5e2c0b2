"""Readers and writers of the pipeline's layers."""

from veritill.sources.files import (
    latest_run,
    read_csv,
    read_customers,
    read_fact,
    read_holidays,
    read_layer,
    read_table,
    read_transactions,
)
from veritill.sources.sinks import (
    append_table,
    conform,
    land_raw,
    load_all,
    replace_table,
    save_clean_split,
    save_fact,
    save_layer,
    write_manifest,
)

__all__ = [
    "append_table",
    "conform",
    "land_raw",
    "latest_run",
    "load_all",
    "read_csv",
    "read_customers",
    "read_fact",
    "read_holidays",
    "read_layer",
    "read_table",
    "read_transactions",
    "replace_table",
    "save_clean_split",
    "save_fact",
    "save_layer",
    "write_manifest",
]

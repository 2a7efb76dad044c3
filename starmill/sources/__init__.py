"""Delimited extracts in, Parquet tables in and out."""

from .delimited import read_delimited, write_delimited
from .inference import drift, file_states, inferred_schema, merged_states, resolved, type_states
from .landing import Landed, TooManyRejects, land
from .tables import (
    current_version,
    exists,
    prune_versions,
    read_table,
    replace_table,
    scratch_root,
    spread,
    write_table,
)

__all__ = [
    "Landed",
    "TooManyRejects",
    "current_version",
    "drift",
    "exists",
    "file_states",
    "inferred_schema",
    "land",
    "merged_states",
    "prune_versions",
    "read_delimited",
    "read_table",
    "replace_table",
    "resolved",
    "scratch_root",
    "spread",
    "type_states",
    "write_delimited",
    "write_table",
]

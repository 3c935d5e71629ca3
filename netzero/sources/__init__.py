"""Sources: ledger scans, slice pruning, path resolution, test-table feeds."""

from .ledger import (LEDGER_SCHEMA, MAX_INLINE_SLICES, TABLE_PREFIX, read_ledger, read_slices,
                     slice_predicate)
from .paths import resolve_path, scratch_path, shared_root, written
from .slices import MissingDataset, existing_slices, read_directories
from .tables import (blank_account_ledger_from_tables, ledger_from_tables, requests_from_tables,
                     spelled_ledger_from_tables, table, text_ledger_from_tables)

__all__ = [
    "LEDGER_SCHEMA", "MAX_INLINE_SLICES", "TABLE_PREFIX", "read_ledger", "read_slices", "slice_predicate",
    "resolve_path", "scratch_path", "shared_root", "written", "MissingDataset", "existing_slices", "read_directories",
    "ledger_from_tables", "requests_from_tables", "table", "text_ledger_from_tables",
    "spelled_ledger_from_tables", "blank_account_ledger_from_tables",
]

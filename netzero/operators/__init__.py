"""Operators: lazy DataFrame -> DataFrame transformations."""

from .contract import apply_contract, contract_columns, contract_order, contract_schema, contract_type
from .files import file_plan, files_needed, rows_for_size
from .normalize import normalize, order_entries, project, rejected_amounts, type_and_clean
from .reconcile import DEFAULT_SALTS, reconcile, txn_summary
from .requests import REQUEST_SCHEMA, parse_requests, rejected_requests, valid_requests

__all__ = [
    "apply_contract", "contract_columns", "contract_order", "contract_schema", "contract_type",
    "file_plan", "files_needed", "rows_for_size",
    "normalize", "order_entries", "project", "rejected_amounts", "type_and_clean",
    "DEFAULT_SALTS", "reconcile", "txn_summary",
    "REQUEST_SCHEMA", "parse_requests", "rejected_requests", "valid_requests",
]

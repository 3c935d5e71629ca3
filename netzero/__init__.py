"""netzero — ledger reconciliation on Spark DataFrames.

Entries are netted per (company, account, transaction); a group whose
amounts sum to exactly zero is reconciled and gets one stable id.  Operators
are lazy DataFrame transformations built from Spark built-ins; the plans in
``netzero.plans`` run them over a whole ledger, over requested slices, or
over a stream of requests (``netzero.streaming``).
"""

from .operators import (apply_contract, file_plan, normalize, order_entries, parse_requests,
                        project, reconcile, rejected_amounts, txn_summary, type_and_clean)
from .plans.jobs import reconcile_dataset, reconcile_request_log
from .plans.sink import write_result
from .plans.worker import dead_letters, reconcile_requested
from .sources import read_ledger, read_slices, resolve_path
from .spec import DatasetMapping, OutputContract, ReconSpec
from .streaming import start_request_stream

__all__ = [
    "apply_contract", "file_plan", "normalize", "order_entries", "parse_requests",
    "project", "reconcile", "rejected_amounts", "txn_summary", "type_and_clean",
    "reconcile_dataset", "reconcile_request_log", "write_result", "dead_letters",
    "reconcile_requested", "read_ledger", "read_slices", "resolve_path",
    "DatasetMapping", "OutputContract", "ReconSpec", "start_request_stream",
]

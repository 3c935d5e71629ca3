"""Column contracts and reconciliation settings.

Everything the operators need to know about column names, amount type,
status labels and output layout lives here, so that a ledger with other
column names can be reconciled by passing another ``ReconSpec``.
"""

from __future__ import annotations

import json
import logging
import os
from dataclasses import dataclass, field
from typing import Any, Mapping

from pyspark.sql import SparkSession

log = logging.getLogger("netzero")

# --- Fixed values: names, labels and sizes that results must agree on ---------
# Dataset mapping (projection + sort order per dataset name).
DEFAULT_DATASETS: dict[str, dict[str, list[str]]] = {
    "lancamentos_cj": {
        "columns": ["empresa", "valor_net", "data_contabil", "conta_contabil", "transactionID"],
        "order_by": ["empresa", "conta_contabil", "data_contabil"],
    },
    "clientes": {"columns": ["cliente_id", "nome", "idade", "sexo"]},
    "pagamentos": {"columns": ["pagamento_id", "id_lancamento", "valor_pago", "data_pagamento"]},
}
# Output contract (columns, types, sort order per schema name).
DEFAULT_OUTPUTS: dict[str, dict[str, Any]] = {
    "reconciliation_synthetic_result": {
        "columns": [
            "empresa", "conta_contabil", "data_contabil", "transactionID",
            "valor_net", "reconciliation_status", "conciliation_id",
        ],
        "types": {
            "empresa": "string",
            "conta_contabil": "string",
            "data_contabil": "string",
            "transactionID": "string",
            "valor_net": "decimal",
            "reconciliation_status": "string",
            "conciliation_id": "string",
        },
        "order_by": ["empresa", "conta_contabil", "data_contabil"],
    },
}
RECONCILED_LABEL = "CONCILIADO"
PENDING_LABEL = "PENDENTE"
MONEY_TYPE = "decimal(18,2)"
MONEY_COLUMNS = ("valor", "valor_net")
TEXT_COLUMNS = ("cliente_nome", "empresa", "conta_contabil", "transactionID")
TARGET_FILE_SIZE_MB = 128
ESTIMATED_ROW_SIZE_BYTES = 40
ROWS_PER_FILE = int(TARGET_FILE_SIZE_MB * 1024 * 1024 / ESTIMATED_ROW_SIZE_BYTES)  # 3,355,443
DEFAULT_DATASET = "lancamentos_cj"
DEFAULT_OUTPUT = "reconciliation_synthetic_result"
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class ReconSpec:
    """Names and labels used by the reconciliation operators."""

    company: str = "empresa"
    account: str = "conta_contabil"
    transaction: str = "transactionID"
    amount: str = "valor_net"
    booking_date: str = "data_contabil"
    status: str = "reconciliation_status"
    group_id: str = "conciliation_id"
    balance: str = "saldo_transacional"
    reconciled_label: str = RECONCILED_LABEL
    pending_label: str = PENDING_LABEL
    money_type: str = MONEY_TYPE
    money_columns: tuple[str, ...] = MONEY_COLUMNS
    text_columns: tuple[str, ...] = TEXT_COLUMNS

    @property
    def partition_keys(self) -> list[str]:
        """Directory keys of the ledger dataset (one slice per pair)."""
        return [self.company, self.account]

    @property
    def keys(self) -> list[str]:
        """Group keys: an entry nets against the entries sharing all three."""
        return [self.company, self.account, self.transaction]


@dataclass(frozen=True)
class DatasetMapping:
    """Projection and sort order for one named dataset."""

    columns: tuple[str, ...]
    order_by: tuple[str, ...] = ()

    @classmethod
    def from_config(cls, cfg: Any) -> "DatasetMapping":
        # A dataset entry is either a bare column list or {"columns", "order_by"}.
        if isinstance(cfg, Mapping):
            return cls(tuple(cfg.get("columns", [])), tuple(cfg.get("order_by", []) or []))
        return cls(tuple(cfg))


@dataclass(frozen=True)
class OutputContract:
    """Columns, types and order of a result written by the sink."""

    columns: tuple[str, ...]
    types: Mapping[str, str] = field(default_factory=dict)
    order_by: tuple[str, ...] = ()

    @classmethod
    def from_config(cls, cfg: Mapping[str, Any]) -> "OutputContract":
        return cls(
            tuple(cfg.get("columns", [])),
            dict(cfg.get("types", {})),
            tuple(cfg.get("order_by", []) or []),
        )


def load_json(path: str) -> dict[str, Any]:
    """Read a JSON config file, local or (a URI, or a folder written by Spark) in a
    store that Spark reads; failures are logged and re-raised."""
    try:
        if "://" in path or path.startswith("file:") or os.path.isdir(path):
            spark = SparkSession.getActiveSession()
            if spark is None:
                raise RuntimeError("a config in a store needs a session")
            return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
        with open(path, encoding="utf-8") as fh:
            return json.load(fh)
    except Exception:
        log.exception("cannot load config %s", path)
        raise


def dataset_mappings(config: Mapping[str, Any] | str | None = None) -> dict[str, DatasetMapping]:
    """Mapping config (dict or JSON path) -> {dataset name: DatasetMapping}."""
    raw = load_json(config) if isinstance(config, str) else (config or DEFAULT_DATASETS)
    return {name: DatasetMapping.from_config(cfg) for name, cfg in raw.items()}


def output_contracts(config: Mapping[str, Any] | str | None = None) -> dict[str, OutputContract]:
    """Output-schema config (dict or JSON path) -> {schema name: OutputContract}."""
    raw = load_json(config) if isinstance(config, str) else (config or DEFAULT_OUTPUTS)
    return {name: OutputContract.from_config(cfg) for name, cfg in raw.items()}

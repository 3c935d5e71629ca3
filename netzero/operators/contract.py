"""Output contract: cast, select and order the result columns."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import present, resolve, spread_sort
from ..spec import DEFAULT_OUTPUT, MONEY_TYPE, OutputContract, output_contracts

log = logging.getLogger("netzero")

# Short type names of the contract files; anything else is taken as Spark DDL.
TYPE_ALIASES = {"decimal": MONEY_TYPE, "string": "string"}


def contract_type(name: str) -> str:
    return TYPE_ALIASES.get(name.lower(), name)


def _contract(schema: str, contracts: Mapping[str, OutputContract] | None) -> OutputContract | None:
    return (contracts if contracts is not None else output_contracts()).get(schema)


def contract_columns(df: DataFrame, contract: OutputContract) -> list[Column]:
    """Typed column list of the contract, restricted to columns present."""
    cols = []
    for name in present(df, contract.columns):
        t = next((v for k, v in contract.types.items() if k.lower() == name.lower()), None)
        c = F.col(name)
        cols.append((c.cast(contract_type(t)) if t else c).alias(name))
    return cols


def apply_contract(df: DataFrame, schema: str = DEFAULT_OUTPUT,
                   contracts: Mapping[str, OutputContract] | None = None,
                   sort: bool = True) -> DataFrame:
    """Cast to the contract types, keep and reorder its columns, and (when
    ``sort``) order globally by its ``order_by`` columns.  An unknown schema
    name passes the DataFrame through unchanged."""
    contract = _contract(schema, contracts)
    if contract is None:
        log.warning("no output contract %r; keeping the DataFrame as is", schema)
        return df
    out = df.select(*contract_columns(df, contract))
    order = [resolve(out, c) for c in contract.order_by if resolve(out, c)]
    return spread_sort(out, order) if sort else out


def contract_schema(schema: str = DEFAULT_OUTPUT,
                    contracts: Mapping[str, OutputContract] | None = None) -> T.StructType:
    """Spark schema of results written under a contract — for reading them
    back with partition keys as strings (no type inference)."""
    contract = _contract(schema, contracts)
    if contract is None:
        raise KeyError(f"no output contract {schema!r}")
    return T.StructType([
        T.StructField(c, _spark_type(contract_type(contract.types.get(c, "string"))))
        for c in contract.columns
    ])


def _spark_type(ddl: str) -> T.DataType:
    # the contract's own types need no JVM (usable before a session exists)
    m = re.fullmatch(r"\s*decimal\((\d+),\s*(\d+)\)\s*", ddl, re.IGNORECASE)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    if ddl.strip().lower() == "string":
        return T.StringType()
    return T.DataType.fromDDL(ddl)


def contract_order(df: DataFrame, schema: str = DEFAULT_OUTPUT,
                   contracts: Mapping[str, OutputContract] | None = None) -> list[str]:
    contract = _contract(schema, contracts)
    if contract is None:
        return []
    return [resolve(df, c) for c in contract.order_by if resolve(df, c)]

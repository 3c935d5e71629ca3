"""DuckDB SQL computing the same results as the registered Spark queries.

Written independently of the Spark code, from the rules in the module
docstrings: it is the correctness reference the driver compares against.
Sums are cast to decimal(38,2) (Spark and DuckDB give the sum of
decimal(18,2) different precisions).  Request bodies are built with DuckDB's
own JSON functions and parsed back, so request handling is checked against
an independent JSON parser.
"""

from __future__ import annotations

# Raw ledger over the TPC-H-style tables (debits per line item, credits per
# settled order, null transaction key on every 97th order); keeps o_orderkey.
LEDGER_K = """
ledger_k AS (
  SELECT concat(' ', lower(c.c_mktsegment), ' ') AS empresa,
         o.o_orderpriority AS conta_contabil,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
              ELSE concat('t', cast(o.o_orderkey AS varchar)) END AS "transactionID",
         cast(l.l_shipdate AS date) AS data_contabil,
         cast(l.l_extendedprice AS decimal(18,2)) AS valor_net,
         c.c_name AS cliente_nome,
         o.o_orderkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  UNION ALL
  SELECT concat(' ', lower(c.c_mktsegment), ' '),
         o.o_orderpriority,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
              ELSE concat('T', cast(o.o_orderkey AS varchar), ' ') END,
         cast(o.o_orderdate AS date),
         cast(-p.paid AS decimal(18,2)),
         c.c_name,
         o.o_orderkey
  FROM (SELECT l.l_orderkey, sum(cast(l.l_extendedprice AS decimal(18,2))) AS paid
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE o.o_orderstatus = 'F'
           OR (o.o_orderstatus = 'P' AND l.l_linestatus = 'F')
        GROUP BY l.l_orderkey) p
  JOIN orders o ON p.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""

LEDGER = """
ledger AS (
  SELECT empresa, conta_contabil, "transactionID", data_contabil, valor_net, cliente_nome
  FROM ledger_k
)"""

# Upstream text export: amounts as text, decimal comma on every 101st order.
TEXT_LEDGER = """
text_ledger AS (
  SELECT empresa, conta_contabil, "transactionID", data_contabil,
         CASE WHEN o_orderkey % 101 = 0 THEN replace(cast(valor_net AS varchar), '.', ',')
              ELSE cast(valor_net AS varchar) END AS valor_net,
         cliente_nome
  FROM ledger_k
)"""

# One request message per order; broken bodies on every 79th (not JSON),
# no account on every 89th, no dataset path on every 83rd order.
#: Company as written in a request, dataset path, for each copy of the messages.
RAW_COMPANY = "concat(' ', lower(c.c_mktsegment), ' ')"


def requests(*variants: tuple[str, str]) -> str:
    """CTEs from messages to ``parsed``, one set of messages per (company, path)."""
    each = " UNION ALL ".join(f"""
  SELECT o.o_orderkey AS seq, {i} AS variant,
         CAST(json_object(
           'partition_id', concat('o', cast(o.o_orderkey AS varchar)),
           'data', json_object(
              'empresa', {company},
              'conta_contabil', CASE WHEN o.o_orderkey % 89 <> 0 THEN o.o_orderpriority END,
              'data_source_path', CASE WHEN o.o_orderkey % 83 <> 0 THEN '{path}' END)) AS varchar) AS msg
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""" for i, (company, path) in enumerate(variants))
    return "messages AS (" + each + ")," + REQUEST_RULES


# Broken bodies: no JSON, text after the object, two objects, single quotes, a cut end.
REQUEST_RULES = """
requests AS (
  SELECT seq,
         CASE WHEN seq % 79 <> 0 THEN msg
              WHEN (seq // 79) % 5 = 0 THEN concat('not json o', cast(seq AS varchar))
              WHEN (seq // 79) % 5 = 1 THEN concat(msg, ' trailing')
              WHEN (seq // 79) % 5 = 2 THEN concat(msg, msg)
              WHEN (seq // 79) % 5 = 3 THEN replace(msg, '"', chr(39))
              ELSE left(msg, length(msg) - 3) END AS body
  FROM messages
),
req_fields AS (
  SELECT seq, body,
         coalesce(CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' END, false) AS is_obj
  FROM requests
),
req_values AS (
  SELECT seq, body, is_obj,
         CASE WHEN is_obj THEN json_extract_string(body, '$.partition_id') END AS partition_id,
         CASE WHEN is_obj THEN json_extract_string(body, '$.data.empresa') END AS empresa,
         CASE WHEN is_obj THEN json_extract_string(body, '$.data.conta_contabil') END AS conta_contabil,
         CASE WHEN is_obj THEN json_extract_string(body, '$.data.data_source_path') END AS data_source_path
  FROM req_fields
),
parsed AS (
  SELECT *,
         CASE WHEN NOT is_obj THEN 'invalid_json'
              WHEN coalesce(trim(empresa) = '', true) THEN 'missing_empresa'
              WHEN coalesce(trim(conta_contabil) = '', true) THEN 'missing_conta_contabil'
              WHEN coalesce(trim(data_source_path) = '', true) THEN 'missing_data_source_path'
         END AS reject_reason
  FROM req_values
)"""

REQUESTS = requests((RAW_COMPANY, "ledger"))

# Mapping lancamentos_cj, amounts typed, keys trimmed and upper-cased.
ENTRIES = """
entries AS (
  SELECT upper(trim(empresa)) AS empresa,
         TRY_CAST(valor_net AS decimal(18,2)) AS valor_net,
         data_contabil,
         upper(trim(conta_contabil)) AS conta_contabil,
         upper(trim("transactionID")) AS "transactionID"
  FROM {src}
)"""


def uuid_of(k: str) -> str:
    h = f"md5(concat_ws(chr(31), {k}))"
    return (f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
            f"substr({h}, 17, 4), substr({h}, 21, 12))")


GROUPS = """
groups AS (
  SELECT empresa, conta_contabil, "transactionID",
         sum(valor_net) AS saldo, count(*) AS n_entries
  FROM entries
  GROUP BY empresa, conta_contabil, "transactionID"
)"""

RECONCILED = f"""
reconciled AS (
  SELECT e.empresa, e.conta_contabil, e."transactionID", e.valor_net, e.data_contabil,
         CASE WHEN g.saldo = 0 THEN 'CONCILIADO' ELSE 'PENDENTE' END AS reconciliation_status,
         CASE WHEN g.saldo = 0 THEN {uuid_of('g.empresa, g.conta_contabil, g."transactionID"')}
         END AS conciliation_id
  FROM entries e
  LEFT JOIN groups g
    ON e.empresa = g.empresa AND e.conta_contabil = g.conta_contabil
   AND e."transactionID" = g."transactionID"
)"""

# The request path: every slice nets on its own, and ids depend on dataset and raw slice.
ORIGIN = "request_source, empresa_slice, conta_contabil_slice"
REQUEST_ENTRIES = """
entries AS (
  SELECT request_source, empresa AS empresa_slice, conta_contabil AS conta_contabil_slice,
         upper(trim(empresa)) AS empresa,
         TRY_CAST(valor_net AS decimal(18,2)) AS valor_net,
         data_contabil,
         upper(trim(conta_contabil)) AS conta_contabil,
         upper(trim("transactionID")) AS "transactionID"
  FROM {src}
),
groups AS (
  SELECT request_source, empresa_slice, conta_contabil_slice, "transactionID", sum(valor_net) AS saldo
  FROM entries GROUP BY ALL
)"""
REQUEST_RECONCILED = f"""
reconciled AS (
  SELECT {ORIGIN}, e.empresa, e.conta_contabil, "transactionID", e.valor_net, e.data_contabil,
         CASE WHEN "transactionID" IS NOT NULL AND g.saldo = 0 THEN 'CONCILIADO' ELSE 'PENDENTE' END
           AS reconciliation_status,
         CASE WHEN "transactionID" IS NOT NULL AND g.saldo = 0
              THEN {uuid_of(ORIGIN + ', e.empresa, e.conta_contabil, "transactionID"')} END AS conciliation_id
  FROM entries e LEFT JOIN groups g USING (request_source, empresa_slice, conta_contabil_slice, "transactionID")
)"""
PLAIN = 'empresa, conta_contabil, "transactionID", valor_net, data_contabil, reconciliation_status, conciliation_id'

CONTRACT_COLUMNS = """empresa, conta_contabil, cast(data_contabil AS varchar) AS data_contabil,
       "transactionID", cast(valor_net AS decimal(18,2)) AS valor_net,
       reconciliation_status, conciliation_id"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def reconciled_over(*ctes: str, src: str = "ledger") -> str:
    """CTE list ending in ``reconciled`` computed over the raw source ``src``."""
    return with_ctes(LEDGER_K, LEDGER, *ctes, ENTRIES.format(src=src), GROUPS, RECONCILED)


def requested_over(*ctes: str, src: str) -> str:
    """CTE list ending in ``reconciled`` computed slice by slice over ``src``
    (which has ``request_source``)."""
    return with_ctes(LEDGER_K, LEDGER, *ctes, REQUEST_ENTRIES.format(src=src), REQUEST_RECONCILED)


def sourced(name: str, path: str, table: str, cond: str = "true", reasons: str = "r.reject_reason IS NULL") -> str:
    """CTE ``name``: rows of ``table`` in slices that valid requests for ``path`` name."""
    return f"""
{name} AS (
  SELECT '{path}' AS request_source, * FROM {table} l
  WHERE {cond} AND EXISTS (SELECT 1 FROM parsed r
                WHERE ({reasons}) AND coalesce(r.data_source_path, '{path}') = '{path}'
                  AND r.empresa = l.empresa AND r.conta_contabil = l.conta_contabil)
)"""


SPELLED_LEDGER = """
spelled AS (
  SELECT CASE WHEN o_orderkey % 5 = 0 AND valor_net < 0 THEN upper(trim(empresa)) ELSE empresa END AS empresa,
         conta_contabil, "transactionID", data_contabil, valor_net, cliente_nome
  FROM ledger_k
)"""
BLANK_LEDGER = """
blanks AS (
  SELECT empresa, CASE WHEN o_orderkey % 50 = 0 THEN '  ' ELSE conta_contabil END AS conta_contabil,
         "transactionID", data_contabil, valor_net, cliente_nome
  FROM ledger_k
)"""
DEFAULT_REASONS = "r.reject_reason IS NULL OR r.reject_reason = 'missing_data_source_path'"

# The slice with a damaged file.
DAMAGED = "empresa = ' building ' AND conta_contabil = '1-URGENT'"

RECONCILE = reconciled_over() + "SELECT * FROM reconciled"

SQL = {
    "ledger_source": with_ctes(LEDGER_K, LEDGER) + "SELECT * FROM ledger",
    "normalize": with_ctes(LEDGER_K, LEDGER, ENTRIES.format(src="ledger")) + "SELECT * FROM entries",
    "map_unknown_dataset": with_ctes(LEDGER_K, LEDGER) + """
SELECT upper(trim(empresa)) AS empresa, upper(trim(conta_contabil)) AS conta_contabil,
       upper(trim("transactionID")) AS "transactionID", data_contabil,
       TRY_CAST(valor_net AS decimal(18,2)) AS valor_net,
       upper(trim(cliente_nome)) AS cliente_nome
FROM ledger""",
    "txn_summary": with_ctes(LEDGER_K, LEDGER, ENTRIES.format(src="ledger"), GROUPS) + f"""
SELECT empresa, conta_contabil, "transactionID",
       cast(saldo AS decimal(38,2)) AS saldo_transacional, n_entries,
       (empresa IS NOT NULL AND conta_contabil IS NOT NULL AND "transactionID" IS NOT NULL
        AND coalesce(saldo = 0, false)) AS is_reconciled,
       CASE WHEN empresa IS NOT NULL AND conta_contabil IS NOT NULL
             AND "transactionID" IS NOT NULL AND saldo = 0
            THEN {uuid_of('empresa, conta_contabil, "transactionID"')} END AS conciliation_id
FROM groups""",
    "reconcile": RECONCILE,
    "reconcile_join": RECONCILE,
    "reconcile_salted": RECONCILE,
    "reconcile_null_keys": reconciled_over() + """
SELECT * FROM reconciled
WHERE empresa IS NULL OR conta_contabil IS NULL OR "transactionID" IS NULL""",
    "output_contract": reconciled_over() + f"""
SELECT {CONTRACT_COLUMNS} FROM reconciled
ORDER BY empresa NULLS FIRST, conta_contabil NULLS FIRST, data_contabil NULLS FIRST""",
    "ordered_entries": with_ctes(LEDGER_K, LEDGER, ENTRIES.format(src="ledger")) + """
SELECT * FROM entries
ORDER BY empresa NULLS FIRST, conta_contabil NULLS FIRST, data_contabil NULLS FIRST""",
    "rejected_amounts": with_ctes(LEDGER_K, TEXT_LEDGER) + """
SELECT empresa, conta_contabil, "transactionID", data_contabil,
       'valor_net' AS amount_column, valor_net AS raw_amount
FROM text_ledger
WHERE valor_net IS NOT NULL AND TRY_CAST(valor_net AS decimal(18,2)) IS NULL""",
    "reconcile_text_amounts": reconciled_over(TEXT_LEDGER, src="text_ledger")
    + "SELECT * FROM reconciled",
    "file_plan": reconciled_over() + """
SELECT empresa, conta_contabil, count(*) AS n_rows,
       cast(greatest(1, ceil(count(*) / 500)) AS bigint) AS n_files
FROM reconciled GROUP BY empresa, conta_contabil""",
    "slice_scan": with_ctes(LEDGER_K, LEDGER) + """
SELECT * FROM ledger WHERE conta_contabil = '1-URGENT'""",
    "request_rejects": with_ctes(REQUESTS) + """
SELECT seq, partition_id, reject_reason FROM parsed WHERE reject_reason IS NOT NULL""",
    "reconcile_requested": requested_over(REQUESTS, sourced("wanted", "ledger", "ledger"), src="wanted")
    + f"SELECT {PLAIN} FROM reconciled",
    "reconcile_default_source": requested_over(
        REQUESTS, sourced("wanted", "ledger", "ledger", reasons=DEFAULT_REASONS), src="wanted")
    + f"SELECT {CONTRACT_COLUMNS} FROM reconciled",
    "requested_spellings": requested_over(
        requests((RAW_COMPANY, "ledger"), ("upper(c.c_mktsegment)", "ledger")), SPELLED_LEDGER,
        sourced("wanted", "ledger", "spelled"), src="wanted")
    + f"SELECT {PLAIN}, empresa_slice, conta_contabil_slice FROM reconciled",
    "request_source_errors": with_ctes(requests((RAW_COMPANY, "ledger"), (RAW_COMPANY, "no/such/dataset"))) + """
SELECT partition_id, coalesce(reject_reason, 'source_error') AS reject_reason FROM parsed
WHERE reject_reason IS NOT NULL OR data_source_path = 'no/such/dataset'""",
    "slice_scan_many": with_ctes(LEDGER_K, LEDGER) + """
SELECT * FROM ledger WHERE conta_contabil <> '5-LOW'""",
    "slice_listing": with_ctes(LEDGER_K, LEDGER) + """
SELECT DISTINCT empresa, conta_contabil FROM ledger""",
    "request_slice_errors": with_ctes(REQUESTS) + f"""
SELECT partition_id, coalesce(reject_reason, 'source_error') AS reject_reason FROM parsed
WHERE reject_reason IS NOT NULL OR ({DAMAGED})""",
    "request_slice_results": requested_over(REQUESTS, sourced("wanted", "ledger", "ledger", f"NOT ({DAMAGED})"), src="wanted")
    + f"SELECT {CONTRACT_COLUMNS} FROM reconciled",
    "request_counts": with_ctes(LEDGER_K, LEDGER, REQUESTS) + """
SELECT partition_id, coalesce(n, 0) AS rows FROM parsed
LEFT JOIN (SELECT empresa, conta_contabil, count(*) AS n FROM ledger GROUP BY ALL) USING (empresa, conta_contabil)
WHERE reject_reason IS NULL""",
    "sink_versions": reconciled_over() + f"""
SELECT {CONTRACT_COLUMNS} FROM reconciled
WHERE conta_contabil <> '1-URGENT' OR reconciliation_status = 'CONCILIADO'""",
    "sink_ordered": reconciled_over() + f"SELECT {CONTRACT_COLUMNS} FROM reconciled",
    "sink_measured": reconciled_over() + f"SELECT {CONTRACT_COLUMNS} FROM reconciled",
    "reconcile_colocated": RECONCILE,
    "sink_blank_keys": reconciled_over(BLANK_LEDGER, src="blanks") + f"SELECT {CONTRACT_COLUMNS} FROM reconciled",
    "sink_empty_slice": reconciled_over() + f"SELECT {CONTRACT_COLUMNS} FROM reconciled",
    "sink_fixed_partitions": reconciled_over() + f"SELECT {CONTRACT_COLUMNS} FROM reconciled",
    "config_files": with_ctes(LEDGER_K, LEDGER, ENTRIES.format(src="ledger")) + """
SELECT empresa, "transactionID", valor_net, cast(data_contabil AS varchar) AS data_contabil
FROM entries WHERE valor_net < 0""",
    "custom_contract": reconciled_over() + """
SELECT "transactionID", reconciliation_status, cast(valor_net AS decimal(20,4)) AS valor_net, empresa
FROM reconciled""",
    "stream_messages": requested_over("wanted AS (SELECT 'ledger' AS request_source, * FROM ledger)", src="wanted")
    + f"SELECT {CONTRACT_COLUMNS} FROM reconciled",
    "stream_two_sources": requested_over(
        requests((RAW_COMPANY, "ledger"), (RAW_COMPANY, "copy")), sourced("wanted_a", "ledger", "ledger"),
        sourced("wanted_b", "copy", "ledger", "l.conta_contabil = '1-URGENT'"),
        "wanted AS (SELECT * FROM wanted_a UNION ALL SELECT * FROM wanted_b)", src="wanted")
    + f"SELECT {CONTRACT_COLUMNS}, request_source FROM reconciled",
    "sink_roundtrip": reconciled_over() + f"""
SELECT {CONTRACT_COLUMNS}, empresa AS empresa_part, conta_contabil AS conta_contabil_part
FROM reconciled""",
    "run_metrics": reconciled_over() + """
SELECT count(*) AS rows,
       cast(sum(CASE WHEN reconciliation_status = 'CONCILIADO' THEN 1 ELSE 0 END) AS bigint)
         AS reconciled_rows,
       cast(sum(CASE WHEN reconciliation_status = 'CONCILIADO' THEN 0 ELSE 1 END) AS bigint)
         AS pending_rows
FROM reconciled""",
    "stream_requests": requested_over(REQUESTS, sourced("wanted", "ledger", "ledger"), src="wanted")
    + f"SELECT {CONTRACT_COLUMNS} FROM reconciled",
    "stream_dead_letters": with_ctes(REQUESTS) + """
SELECT partition_id, reject_reason FROM parsed WHERE reject_reason IS NOT NULL""",
}

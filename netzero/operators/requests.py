"""Parsing and validation of reconciliation request messages.

A request body is JSON ``{"partition_id": …, "data": {"empresa": …,
"conta_contabil": …, "data_source_path": …}}``.  A body that is not a JSON
object, or lacks (or has blank) company, account or dataset path, is
rejected with a reason instead of raising, so one bad message never fails
the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import ReconSpec

REQUEST_SCHEMA = T.StructType([
    T.StructField("partition_id", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("empresa", T.StringType()),
        T.StructField("conta_contabil", T.StringType()),
        T.StructField("data_source_path", T.StringType()),
    ])),
])

# Dead-letter reasons, in the order the checks apply.
REASON_NOT_JSON = "invalid_json"
REASON_MISSING = "missing_"  # + field name: missing_empresa, missing_conta_contabil, missing_data_source_path
REQUIRED_FIELDS = ("empresa", "conta_contabil", "data_source_path")


def parse_requests(raw: DataFrame, body: str = "body", spec: ReconSpec = ReconSpec()) -> DataFrame:
    """Add ``partition_id``, the request fields (named after ``spec``'s
    partition keys, plus ``data_source_path``) and ``reject_reason`` (null
    for a valid request).  Other input columns are kept.

    The body is parsed once into a typed struct (JSON values of any type are
    read as their text).  Spark's JSON functions stop reading at the end of the
    first value and accept single quotes, so a body counts as JSON only if it
    parses as the first of exactly two elements of a list whose last one carries the
    body's own digest; an object is told from other values by its brace.
    """
    company, account = spec.partition_keys
    outputs = dict(zip(REQUIRED_FIELDS, (company, account, "data_source_path")))
    # one row for each row, by a generator: a filter on a parsed field is not moved below
    # it, where it would parse the body again for every mention of a field
    msg = F.get(F.col("_nz_list"), F.lit(0))
    digest = F.md5(F.col(body).cast("binary"))
    ended = F.concat(F.lit("["), F.col(body), F.lit(',{"partition_id":"'), digest, F.lit('"}]'))
    elements = F.from_json(ended, T.ArrayType(REQUEST_SCHEMA), {"allowSingleQuotes": "false"})
    parsed = raw.select("*", F.explode(F.array(elements)).alias("_nz_list")).withColumns({
        "_nz_msg": msg,
        "_nz_obj": F.coalesce((F.size("_nz_list") == 2) & (F.get(F.col("_nz_list"), F.lit(1))["partition_id"] == digest)
                              & msg.isNotNull() & F.regexp_like(body, F.lit(r"^[ \t\r\n]*\{")), F.lit(False)),
    }).withColumns({
        "partition_id": F.when(F.col("_nz_obj"), F.col("_nz_msg")["partition_id"]),
        **{out: F.when(F.col("_nz_obj"), F.col("_nz_msg")["data"][name]) for name, out in outputs.items()},
    })
    reason = F.when(~F.col("_nz_obj"), F.lit(REASON_NOT_JSON))
    for name, out in outputs.items():
        reason = reason.when(F.coalesce(F.trim(F.col(out)) == "", F.lit(True)),
                             F.lit(REASON_MISSING + name))
    return parsed.withColumn("reject_reason", reason).drop("_nz_list", "_nz_msg", "_nz_obj")


def valid_requests(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull())


def rejected_requests(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull())

"""Ledger entries and request messages derived from the TPC-H-style tables.

Company = customer market segment, account = order priority, transaction =
order.  Every line item is a debit; orders with status ``F`` are settled in
full by one credit, ``P`` orders only for their ``F`` lines, ``O`` orders not
at all.  Blanks and mixed case are put into the raw keys so that cleaning
matters, and every 97th order carries no transaction key (it would net to
zero if null keys matched).  Nothing is sampled: the ledger has one debit per
line item of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Order keys divisible by this carry a null transaction key.
NULL_KEY_EVERY = 97
# Request messages: orders whose key is divisible by these numbers produce a
# body that is not JSON / has no account / has no dataset path.
BAD_JSON_EVERY = 79
NO_ACCOUNT_EVERY = 89
NO_PATH_EVERY = 83
# Text ledger: amounts of orders whose key is divisible by this are exported
# with a decimal comma ("1234,56"), which does not type as a number.
COMMA_DECIMAL_EVERY = 101
# Credits of these orders carry another raw spelling of the company; entries of
# these orders have a blank account (in the variants of the ledger named after them).
SPELLED_EVERY = 5
BLANK_ACCOUNT_EVERY = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ledger_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ledger entries (see ``_ledger``)."""
    return _ledger(spark, sf_dir).drop("o_orderkey")


def text_ledger_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as an upstream text export: ``valor_net`` is a string, and
    on some orders it uses a decimal comma (``COMMA_DECIMAL_EVERY``)."""
    led = _ledger(spark, sf_dir)
    text = F.col("valor_net").cast("string")
    comma = F.col("o_orderkey") % COMMA_DECIMAL_EVERY == 0
    return led.withColumn(
        "valor_net", F.when(comma, F.translate(text, ".", ",")).otherwise(text)
    ).drop("o_orderkey")


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ledger entries: empresa, conta_contabil, transactionID,
    data_contabil (date), valor_net (decimal(18,2)), cliente_nome.

    The line items are moved once, by order: the sums of an order's lines stand
    beside each line, and its credit comes with one of them.  Orders carry their
    customer's columns into the join, so what is moved for the customer is a
    row for each order, not one for each entry.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_linestatus", F.col("l_shipdate").cast("date").alias("_day"),
    ).where(F.col("l_orderkey").isNotNull())
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    buyers = orders.join(cust, orders.o_custkey == cust.c_custkey).drop("o_custkey", "c_custkey")

    price = F.col("l_extendedprice").cast("decimal(18,2)")
    order = Window.partitionBy("l_orderkey")
    lines = li.select(
        "l_orderkey", "_day", price.alias("_price"),
        F.sum(price).over(order).alias("_all_lines"),
        F.sum(F.when(F.col("l_linestatus") == "F", price)).over(order).alias("_f_lines"),
        F.row_number().over(order.orderBy("l_orderkey")).alias("_line"))
    # F orders are paid in full, P orders for their F lines; an order with nothing
    # paid has no credit.
    paid = (F.when(F.col("o_orderstatus") == "F", F.col("_all_lines"))
            .when(F.col("o_orderstatus") == "P", F.col("_f_lines")))
    kinds = F.when((F.col("_line") == 1) & paid.isNotNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    entries = lines.join(buyers, lines.l_orderkey == buyers.o_orderkey).select("*", F.explode(kinds).alias("_credit"))

    is_credit = F.col("_credit")
    prefix, suffix = F.when(is_credit, F.lit("T")).otherwise(F.lit("t")), F.when(is_credit, F.lit(" ")).otherwise(F.lit(""))
    txn = F.when(
        F.col("o_orderkey") % NULL_KEY_EVERY == 0, F.lit(None).cast("string")
    ).otherwise(F.concat(prefix, F.col("o_orderkey").cast("string"), suffix))
    return entries.select(
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("empresa"),
        F.col("o_orderpriority").alias("conta_contabil"),
        txn.alias("transactionID"),
        F.when(is_credit, F.col("o_orderdate")).otherwise(F.col("_day")).alias("data_contabil"),
        F.when(is_credit, -paid).otherwise(F.col("_price")).cast("decimal(18,2)").alias("valor_net"),
        F.col("c_name").alias("cliente_nome"),
        "o_orderkey",
    )


def spelled_ledger_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with two raw spellings of each company: credits of every
    ``SPELLED_EVERY``-th order are stored under the upper-case name."""
    led = _ledger(spark, sf_dir)
    other = (F.col("o_orderkey") % SPELLED_EVERY == 0) & (F.col("valor_net") < 0)
    return led.withColumn("empresa", F.when(other, F.upper(F.trim("empresa"))).otherwise(F.col("empresa"))).drop("o_orderkey")


def blank_account_ledger_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with a blank account on every ``BLANK_ACCOUNT_EVERY``-th order."""
    led = _ledger(spark, sf_dir)
    blank = F.col("o_orderkey") % BLANK_ACCOUNT_EVERY == 0
    return led.withColumn("conta_contabil", F.when(blank, F.lit("  ")).otherwise(F.col("conta_contabil"))).drop("o_orderkey")


def requests_from_tables(spark: SparkSession, sf_dir: str, source_path: str = "ledger",
                         spelled: bool = False) -> DataFrame:
    """One reconciliation request message per order (``body`` string column).

    The message names the ledger slice of the order (raw company and account
    values, as stored) and ``source_path``.  Slices are requested many times
    over, as an at-least-once queue redelivers them.  Some bodies are broken
    on purpose (see the ``*_EVERY`` rules) so that dead-lettering has work.
    Broken bodies come in five shapes: no JSON at all, text after the object, a
    second object, single quotes, a cut end.  With ``spelled`` the company is
    written in upper case without blanks.  Null fields are left out of the JSON text.
    """
    # Hash-partitioned on the customer key: the exchange a shuffle join with
    # customers needs at scale anyway (so no extra shuffle there), and small
    # inputs still build their messages in parallel tasks.
    orders = (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
              .repartition("o_custkey"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("o_orderkey")
    company = F.upper("c_mktsegment") if spelled else F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))
    data = F.struct(
        company.alias("empresa"),
        F.when(k % NO_ACCOUNT_EVERY != 0, F.col("o_orderpriority")).alias("conta_contabil"),
        F.when(k % NO_PATH_EVERY != 0, F.lit(source_path)).alias("data_source_path"),
    )
    msg = F.to_json(F.struct(
        F.concat(F.lit("o"), k.cast("string")).alias("partition_id"), data.alias("data")))
    shape = F.floor(k / BAD_JSON_EVERY) % 5
    broken = (F.when(shape == 0, F.concat(F.lit("not json o"), k.cast("string")))
              .when(shape == 1, F.concat(msg, F.lit(" trailing")))
              .when(shape == 2, F.concat(msg, msg))
              .when(shape == 3, F.translate(msg, '"', "'"))
              .otherwise(msg.substr(F.lit(1), F.length(msg) - 3)))
    body = F.when(k % BAD_JSON_EVERY == 0, broken).otherwise(msg)
    return (
        orders.join(cust, orders.o_custkey == cust.c_custkey)
        .select(k.alias("seq"), body.alias("body"))
    )

"""Mixing sources to target weights by entropy balancing (DataFrame functions only).

Every source gets a token target.  The document rates that meet all targets,
stay between 0 and ``max_copies`` and are closest to "each document once" in relative
entropy, ``sum(rate * ln(rate) - rate + 1)``, are exponential tilts of the size,
``rate = min(max_copies, exp(lambda_source * size))``: a source that has too many
tokens gives up long documents first, one that has too few repeats them first.
The multipliers minimise the convex dual, whose gradient per source is tokens at
these rates minus target and whose curvature is ``sum(size^2 * rate)`` over the
documents below the bound.  Newton steps run on all sources at once, damped: each
round evaluates the full step, half of it and the middle of the bracket that holds
the answer, and goes on from the best.  A round is one Spark aggregation
over the cells (source, size, rows), which hold every document and shrink the
data before anything is shuffled.  Sizes are taken relative to the source's mean.
Sums are decimal, so they do not depend on the order of the tasks.

Rates are then rounded into whole copies (0, 1 or 2).  Within a source the
cells are walked from the longest documents down and the cumulated rate is
rounded, so the error in tokens stays below the longest document; a few
further passes move single copies in the cell that fits the remaining error.
Which documents of a cell get the extra copy follows a hash of ``doc_id``, in
hash buckets, so a cell holding a third of all rows is spread over tasks.
Everything is a function of the rows alone: reruns agree.

Edge cases: null text has size 0; size-0 documents take nothing and are copied
once, or not at all in a source with target 0; a null source is one
source of its own, ordered last; a source of size 0 has target 0; an empty
table gives an empty result; repeated rows and null ids are rows like any
other.  Extra columns are kept by ``mix`` (internal ones start with ``_nz_``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, stored, table

#: Weights dealt to the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Tokens of the mix over tokens of the corpus, and the most copies of a document.
SHARE = 1.5
MAX_COPIES = 2
#: Newton stops at this largest relative residual, or after so many rounds.
TOLERANCE = 1e-7
MAX_ROUNDS = 60
#: Type of sums of tokens at fractional rates.
TOKENS = "decimal(38,10)"
#: Passes that move single copies to the remaining error.
FIX_PASSES = 4
#: Hash buckets of a cell.
BUCKETS = 1024


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: str):
    """Null-free join key that keeps a null source apart from every string."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(source).cast("string")))


def source_targets(cells: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """(source key, total, target): ``share`` of all tokens dealt by weight; a
    target stops at ``max_copies`` times its source and the excess is dealt
    again by weight, that is ``min(cap, weight * level)`` for one common level.

    One row per source goes through the ordering windows, never documents.
    """
    by_source = Window.orderBy((F.col("_nz_s") == "n"), F.col("_nz_s"))
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = (cells.groupBy("_nz_s").agg(F.sum(F.col("_nz_size") * F.col("_nz_n")).alias("_nz_total"))
         .withColumn("_nz_w", F.element_at(w, ((F.row_number().over(by_source) - 1) % len(weights) + 1).cast("int")))
         .withColumn("_nz_cap", F.col("_nz_total") * F.lit(float(max_copies))))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("_nz_cap") / F.col("_nz_w"), "_nz_s").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "_nz_all": F.sum("_nz_total").over(every) * F.lit(share), "_nz_allw": F.sum("_nz_w").over(every),
        "_nz_c": F.coalesce(F.sum("_nz_cap").over(before), F.lit(0.0)),
        "_nz_cw": F.coalesce(F.sum("_nz_w").over(before), F.lit(0.0)),
    }).withColumn("_nz_level", (F.col("_nz_all") - F.col("_nz_c")) / (F.col("_nz_allw") - F.col("_nz_cw")))
    # sources in order of cap / weight: the first whose cap is not reached sets the level for the rest
    free = F.col("_nz_w") * F.col("_nz_level") <= F.col("_nz_cap")
    s = s.withColumn("_nz_found", F.min(F.when(free, F.struct(F.col("_nz_cap") / F.col("_nz_w"),
                                                             F.col("_nz_s"), F.col("_nz_level"))))
                     .over(every)["_nz_level"])
    target = F.least(F.col("_nz_cap"), F.coalesce(F.col("_nz_w") * F.col("_nz_found"), F.col("_nz_cap")))
    return s.select("_nz_s", "_nz_total", target.alias("_nz_target"))


def rate_of(multiplier, max_copies: int = MAX_COPIES):
    """Copies of a document of ``_nz_size`` under a source's multiplier and ``_nz_mean``."""
    tilt = F.least(multiplier * F.col("_nz_size") / F.col("_nz_mean"), F.lit(math.log(max_copies)))
    return F.when(F.col("_nz_size") == 0, F.lit(1.0)).otherwise(F.exp(tilt))


def newton(cells: DataFrame, targets: DataFrame, max_rounds: int = MAX_ROUNDS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source key, total, target, mean, lambda): minimiser of the dual.  A target
    of 0 has rate 0 (lambda null).

    Only the largest relative residual, one number, comes to the driver.
    """
    weight = F.col("_nz_size") * F.col("_nz_n")
    relative = F.col("_nz_size") / F.col("_nz_mean")
    total, target = F.col("_nz_total"), F.col("_nz_target")
    means = cells.groupBy("_nz_s").agg(
        F.nullif(F.sum(weight) / F.sum("_nz_n"), F.lit(0.0)).alias("_nz_mean"), F.sum(weight * F.col("_nz_size")).alias("_nz_sq"),
        F.min(F.when(F.col("_nz_size") > 0, F.col("_nz_size"))).alias("_nz_least"))
    # at these ends the shortest documents alone settle on which side of the target the tokens are
    short = F.col("_nz_least") / F.col("_nz_mean")
    down = target < total
    full = target >= total * max_copies  # every document at the bound
    state = targets.join(means, "_nz_s").withColumns({
        "_nz_lambda": F.when(full, F.lit(math.log(max_copies)) / short).otherwise(F.when(target > 0, F.lit(0.0))),
        "_nz_lo": F.when(down & (target > 0), F.ln(target / total) / short).otherwise(F.lit(0.0)),
        "_nz_hi": F.when(down, F.lit(0.0)).otherwise(F.lit(math.log(max_copies)) / short),
        "_nz_h": total.cast("double"), "_nz_k": F.col("_nz_sq") / F.col("_nz_mean"),
    }).drop("_nz_sq", "_nz_least")
    gap = F.when(full, F.lit(0.0)).otherwise(F.abs(F.col("_nz_h") - target) / target)
    state = stored(state.withColumn("_nz_gap", F.when(target > 0, gap)), "mix-lambda")
    names = ["_nz_c0", "_nz_c1", "_nz_c2"]
    for _ in range(max_rounds):
        worst = state.agg(F.max("_nz_gap")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
        middle = (F.col("_nz_lo") + F.col("_nz_hi")) / 2
        step = F.when(F.col("_nz_k") > 0, (target - F.col("_nz_h")) / F.col("_nz_k"))

        def inside(c):
            return F.when((c > F.col("_nz_lo")) & (c < F.col("_nz_hi")), c).otherwise(middle)

        state = state.withColumns(dict(zip(names, (inside(F.col("_nz_lambda") + step), inside(F.col("_nz_lambda") + step / 2), middle))))
        sums = []
        for i, c in enumerate(names):
            tokens = weight * rate_of(F.col(c), max_copies)
            free = F.col(c) * relative <= F.lit(math.log(max_copies))
            sums += [F.sum(tokens.cast(TOKENS)).cast("double").alias(f"_nz_h{i}"),
                     F.sum(F.when(free, tokens * relative).otherwise(F.lit(0.0)).cast(TOKENS)).cast("double").alias(f"_nz_k{i}")]
        moments = cells.join(state.where(F.col("_nz_gap") > TOLERANCE).select("_nz_s", "_nz_mean", *names), "_nz_s").groupBy("_nz_s").agg(*sums)
        tried = state.join(moments, "_nz_s", "left")
        each = [(F.col(c), F.col(f"_nz_h{i}"), F.col(f"_nz_k{i}")) for i, c in enumerate(names)]
        gap = lambda h: F.abs(h - target) / target
        best = F.least(F.struct(F.col("_nz_gap").alias("g"), F.col("_nz_lambda").alias("l"), F.col("_nz_h").alias("h"), F.col("_nz_k").alias("k")),
                       *[F.struct(gap(h).alias("g"), c.alias("l"), h.alias("h"), k.alias("k")) for c, h, k in each])
        moved = tried.withColumn("_nz_best", F.when(F.col("_nz_h0").isNotNull(), best))
        state = stored(moved.select(
            "_nz_s", "_nz_total", "_nz_target", "_nz_mean",
            F.greatest("_nz_lo", *[F.when(h <= target, c) for c, h, _ in each]).alias("_nz_lo"),
            F.least("_nz_hi", *[F.when(h >= target, c) for c, h, _ in each]).alias("_nz_hi"),
            *[F.coalesce(F.col(f"_nz_best.{f}"), F.col(old)).alias(old)
              for f, old in (("l", "_nz_lambda"), ("h", "_nz_h"), ("k", "_nz_k"), ("g", "_nz_gap"))]), "mix-lambda")
    return state.select("_nz_s", "_nz_total", "_nz_target", "_nz_mean", "_nz_lambda")


def _rounded(cells: DataFrame, multipliers: DataFrame, max_copies: int) -> DataFrame:
    """Cells with ``_nz_m``, the copies that all their documents get together."""
    down = Window.partitionBy("_nz_s").orderBy(F.desc("_nz_size"))
    source = Window.partitionBy("_nz_s")
    rate = F.when(F.col("_nz_lambda").isNull(), F.lit(0.0)).otherwise(rate_of(F.col("_nz_lambda"), max_copies))
    most = F.col("_nz_n") * max_copies
    c = (cells.join(multipliers, "_nz_s").withColumn("_nz_cum", F.floor(F.sum(rate * F.col("_nz_n")).over(down) + 0.5))
         .withColumn("_nz_m", F.least(most, F.col("_nz_cum") - F.coalesce(F.lag("_nz_cum").over(down), F.lit(0)))))
    for _ in range(FIX_PASSES):
        gap = F.col("_nz_target") - F.sum(F.col("_nz_size") * F.col("_nz_m")).over(source)
        c = c.withColumn("_nz_e", gap)
        room = F.when(F.col("_nz_e") > 0, most - F.col("_nz_m")).otherwise(F.col("_nz_m"))
        fits = (F.col("_nz_size") > 0) & (F.col("_nz_size") <= F.abs("_nz_e")) & (room > 0)
        c = c.withColumn("_nz_pick", F.max(F.when(fits, F.col("_nz_size"))).over(source))
        move = F.least(room, F.floor(F.abs("_nz_e") / F.col("_nz_size"))) * F.signum("_nz_e").cast("long")
        c = c.withColumn("_nz_m", F.col("_nz_m") + F.when(F.col("_nz_size") == F.col("_nz_pick"), move).otherwise(F.lit(0)))
    return c.select("_nz_s", "_nz_size", "_nz_n", "_nz_m", "_nz_total", "_nz_target")


def mix(docs: DataFrame, size: str, source: str = "source", doc_id: str = "doc_id", weights=WEIGHTS,
        share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies`` added (columns of
    those names are replaced).  ``size`` names the column of token counts."""
    keep = [c for c in docs.columns if c not in ("source_size", "target", "copies")]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep]).withColumns({
        "_nz_s": _source_key(source), "_nz_size": F.col(size),
        "_nz_hash": F.xxhash64(doc_id)}).withColumn("_nz_b", F.pmod("_nz_hash", F.lit(BUCKETS)))
    buckets = stored(rows.groupBy("_nz_s", "_nz_size", "_nz_b").agg(F.count(F.lit(1)).alias("_nz_k")), "mix-buckets")
    cells = stored(buckets.groupBy("_nz_s", "_nz_size").agg(F.sum("_nz_k").alias("_nz_n")), "mix-cells")
    targets = stored(source_targets(cells, weights, share, max_copies), "mix-targets")
    plan = _rounded(cells, newton(cells, targets, max_copies=max_copies), max_copies)
    # rows of a cell in earlier buckets: at most BUCKETS rows to a window group
    in_cell = Window.partitionBy("_nz_s", "_nz_size").orderBy("_nz_b")
    start = (buckets.withColumn("_nz_start", F.sum("_nz_k").over(in_cell) - F.col("_nz_k"))
             .join(plan, ["_nz_s", "_nz_size"]))
    keys = ["_nz_s", "_nz_size", "_nz_b"]
    # the id breaks ties of the hash; rows with the same id are alike in all that the mix looks at
    at = F.col("_nz_start") + F.row_number().over(
        Window.partitionBy(*keys).orderBy("_nz_hash", F.col(doc_id)))
    each, extra = F.floor(F.col("_nz_m") / F.col("_nz_n")), F.col("_nz_m") % F.col("_nz_n")
    return (rows.join(start, keys)
            .withColumn("copies", (each + F.when(at <= extra, 1).otherwise(0)).cast("long"))
            .select(*[F.col(f"`{c}`") for c in keep], F.col("_nz_total").alias("source_size"),
                    F.col("_nz_target").alias("target"), "copies"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = stored(table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    out = mix(sizes, "size")
    return out.select("doc_id", "source", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: every document repeated as often as it is taken, with
    ``size`` and ``copy`` (1, 2, …) after the columns of ``docs``."""
    out = mix(docs.withColumn("_nz_words", word_count(text)), "_nz_words")
    return (out.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .withColumn("size", F.col("_nz_words")).drop("_nz_words"))


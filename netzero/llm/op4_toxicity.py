"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; a sample of documents whose
labels are ignored is the unlabelled set.  Risk estimator (logistic loss, class
prior p):  p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-)); when the corrected
negative part falls below zero its gradient is reversed, so the classifier
cannot overfit by making it negative.

``SHARDS`` numpy classifiers are trained in as many tasks, each on all sampled
positives and its own share of the unlabelled sample; the score is the
probability at the mean of their log odds.  Features: hashed words of the text and
their beginnings, of which each classifier keeps those whose rates among positives
and unlabelled documents differ significantly.

Bounds (documented parameters): at most about ``MAX_POSITIVES`` positives and
``MAX_UNLABELLED`` unlabelled documents, chosen by a hash of doc_id; weights of
at most ``MAX_FEATURES`` words a classifier come to the driver.  The class prior is
counted over all labels, and every whole text is scored.

Held out: documents with crc32(doc_id) % 4 == 2 give neither labels, prior, nor
unlabelled text.  Labels, lang, source and doc_id are no inputs of a score.

Edge cases: null text scores like the empty text; null ids are scored and never
used for training; null labels are ignored, of conflicting labels toxic wins;
without a positive label every score is 0; an empty table gives an empty
result; extra columns are kept by ``drop_toxic`` and ignored by ``score``.
Texts reach Python in Arrow batches of ``ARROW_BYTES``; a worker remembers the
features of at most ``_CACHE_MAX`` words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sized_chunks, small_batches, stored, table

SHARDS = 4
MAX_POSITIVES = 6_000
MAX_UNLABELLED = 24_000
MAX_FEATURES = 2_000
HASH_BITS = 20
#: Share of the labelled toxic rate taken as the class prior.  Toxic texts are over-represented among
#: labelled ones and some labels are wrong; a prior above the true one keeps the correction active
#: for good, and clean texts then never get a low score.
PRIOR_DISCOUNT = 0.75
MIN_Z = 5.0
MIN_ROWS = 3
L2 = 1e-4
ROUNDS = 300
THRESHOLD = 0.3
HELD_OUT, FOLDS = 2, 4
BATCH_CHARS = 1 << 22
_WORD = re.compile(r"\w+")
#: Lengths of the word beginnings used as features.
PREFIXES = (4, 5, 6, 7)
_MASK = (1 << HASH_BITS) - 1
#: Features of a word as packed int32: a fifth of the memory of int objects.
_CACHE: dict[str, bytes] = {}
_CACHE_MAX = 300_000


def held_out(doc_id: str | Column = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def features(text: str | None) -> tuple[np.ndarray, float]:
    """(hashed features, value of each): the distinct words of a text and the
    beginnings of each, as often as words share them.  The value falls with the
    square root of the number of words: one odd word in a long text says less."""
    words = set(_WORD.findall((text or "").lower()))
    if len(_CACHE) > _CACHE_MAX:
        _CACHE.clear()
    out: list[bytes] = []
    for w in words:
        ids = _CACHE.get(w)
        if ids is None:
            ids = _CACHE[w] = np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) & _MASK
                                        for x in (w, *("^" + w[:k] for k in PREFIXES if len(w) > k))], np.int32).tobytes()
        out.append(ids)
    return np.frombuffer(b"".join(out), np.int32), 10.0 / np.sqrt(max(4, len(words)))


# --- training ----------------------------------------------------------------

def train(positive: list[tuple[np.ndarray, float]], unlabelled: list[tuple[np.ndarray, float]], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature ids, weights, bias) of one classifier, from rows of (ids, value)."""
    n_p, n_u, size = len(positive), len(unlabelled), 1 << HASH_BITS
    rate = lambda rows: np.bincount(np.concatenate([np.unique(x) for x, _ in rows]), minlength=size)
    c_p, c_u = rate(positive), rate(unlabelled)
    both = (c_p + c_u) / max(1, n_p + n_u)
    spread = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / max(1, n_p) + 1 / max(1, n_u)))
    z = np.abs(c_p / max(1, n_p) - c_u / max(1, n_u)) / spread
    z[c_p + c_u < MIN_ROWS] = 0
    chosen = np.sort(np.argsort(-z, kind="stable")[:MAX_FEATURES])
    chosen = chosen[z[chosen] >= MIN_Z].astype(np.int32)
    place = np.full(size, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def packed(rows: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = [p[p >= 0] for p in (place[x] for x, _ in rows)]
        row = np.repeat(np.arange(len(rows)), [len(x) for x in ids])
        return np.concatenate(ids), row, np.array([v for _, v in rows])[row]

    (i_p, r_p, x_p), (i_u, r_u, x_u) = packed(positive), packed(unlabelled)
    w, b, k = np.zeros(len(chosen)), float(np.log(prior / (1 - prior))), len(chosen)
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    loss = lambda x: np.logaddexp(0, x)  # noqa: E731  of a margin -x
    for t in range(1, ROUNDS + 1):
        f_p = np.bincount(r_p, weights=w[i_p] * x_p, minlength=n_p) + b
        f_u = np.bincount(r_u, weights=w[i_u] * x_u, minlength=n_u) + b
        negative = loss(f_u).mean() - prior * loss(f_p).mean()
        g_plus, g_p, g_u = -prior * sigmoid(-f_p) / n_p, -prior * sigmoid(f_p) / n_p, sigmoid(f_u) / n_u
        if negative >= 0:
            g_p = g_plus + g_p
        else:  # the correction is active: climb back
            g_p, g_u = -g_p, -g_u
        grad = np.append(np.bincount(i_p, weights=g_p[r_p] * x_p, minlength=k) + np.bincount(i_u, weights=g_u[r_u] * x_u, minlength=k)
                         + L2 * w, g_p.sum() + g_u.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, b = w - step[:k], b - step[k]
    return chosen, w, float(b)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
        max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED) -> list[tuple]:
    """The classifiers: [(word ids, weights, bias)], empty without positives."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy(
        F.col("doc_id").alias("_nz_id")).agg(F.max("toxic").alias("_nz_toxic"))
    n, n_pos = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("_nz_toxic") == 1, 1)), F.lit(0))).first()
    if not n_pos:
        return []
    prior = min(0.5, max(1e-4, PRIOR_DISCOUNT * n_pos / n))
    below = lambda part: F.pmod(F.xxhash64("_nz_id", F.lit(part)), F.lit(1 << 30)) < F.lit(int(min(1.0, share[part]) * (1 << 30)))
    trainable = docs.select(F.col(doc_id).alias("_nz_id"), F.col(text).alias("text")).where(
        F.col("_nz_id").isNotNull() & ~held_out("_nz_id"))
    share = {"pos": max_positives / n_pos, "unl": max_unlabelled / max(1, trainable.select("_nz_id").count())}
    # about max_positives ids, by the hash threshold: a bounded side to broadcast
    ids = F.broadcast(known.where((F.col("_nz_toxic") == 1) & below("pos")).select("_nz_id", F.lit(True).alias("pos")))
    rows = trainable.join(ids, "_nz_id", "left").withColumn("unl", below("unl")).where("pos OR unl").select(
        F.coalesce("pos", F.lit(False)).alias("pos"), "unl",
        F.pmod(F.xxhash64("_nz_id", F.lit("shard")), F.lit(SHARDS)).cast("int").alias("shard"),
        F.coalesce("text", F.lit("")).alias("text"))

    def featurise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sized_chunks(frames, "text", BATCH_CHARS):
            rows = [features(t) for t in f["text"]]
            yield pd.DataFrame({"pos": f["pos"], "unl": f["unl"], "shard": f["shard"], "ids": [x for x, _ in rows], "value": [v for _, v in rows]})

    feats = stored(rows.mapInPandas(featurise, "pos boolean, unl boolean, shard int, ids array<int>, value double"), "toxic-sample")
    each = feats.where("pos").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(SHARDS - 1)))).select(
        "shard", F.lit(True).alias("pos"), "ids", "value").unionByName(
        feats.where("unl").select("shard", F.lit(False).alias("pos"), "ids", "value"))

    def learn(f: pd.DataFrame) -> pd.DataFrame:
        # a fixed order of the rows makes the sums, and so the weights, the same in every run
        rows = sorted(((p, np.sort(np.asarray(x, np.int32)), v) for p, x, v in zip(f["pos"], f["ids"], f["value"])),
                      key=lambda r: (r[0], r[1].tobytes()))
        pos, unl = [(x, v) for p, x, v in rows if p], [(x, v) for p, x, v in rows if not p]
        if not pos or not unl:
            return pd.DataFrame(columns=["shard", "ids", "weights", "bias"], dtype=object)
        chosen, w, b = train(pos, unl, prior)
        return pd.DataFrame({"shard": [f["shard"].iloc[0]], "ids": [chosen], "weights": [w], "bias": [b]})

    found = each.groupBy("shard").applyInPandas(learn, "shard int, ids array<int>, weights array<double>, bias double")
    return [(np.array(r.ids, np.int32), np.array(r.weights), r.bias) for r in sorted(found.collect(), key=lambda r: r.shard)]


# --- scoring -----------------------------------------------------------------

def scorer(models: list[tuple]):
    """Column function: text to score."""
    if not models:
        return lambda text: F.lit(0.0)
    # the mean of the classifiers' log odds: a word that only one of them knows counts for its share
    weights = np.zeros(1 << HASH_BITS, np.float32)
    for ids, w, _ in models:
        weights[ids] += (w / len(models)).astype(np.float32)
    words, bias = np.flatnonzero(weights), float(np.mean([b for _, _, b in models]))
    weights = weights[words]  # what is sent to the tasks
    table_of = {}

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not table_of:
            table_of[0] = np.zeros(1 << HASH_BITS, np.float32)
            table_of[0][words] = weights
        f = np.empty(len(texts))
        for i, t in enumerate(texts):
            ids, value = features(t)
            f[i] = table_of[0][ids].sum(dtype=np.float64) * value + bias if len(ids) else bias
        return pd.Series(1 / (1 + np.exp(-np.clip(f, -40, 40))))

    return lambda text: score(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    s = scorer(fit(docs, labels, text, doc_id))
    return docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), s(F.col(text)).alias("score")).select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents predicted toxic."""
    return docs.where(scorer(fit(docs, labels, text, doc_id))(F.col(text)) < THRESHOLD)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from netzero.llm import op4_toxicity as m
from netzero.llm.common import ARROW_BYTES

from .common import edge_docs, edge_rows, empty_docs, read

SF = "/root/testdata/sf0.1"


def test_query_on_held_out_labels(spark):
    rows = m.op4_toxicity(spark, SF).toPandas()
    labels = read(spark, SF, "labels").toPandas()
    assert len(rows) == read(spark, SF, "documents").count()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]).all()
    assert rows.score.between(0, 1).all() and ((rows.score >= m.THRESHOLD).astype(int) == rows.predicted).all()
    j = rows.merge(labels, on="doc_id")
    j = j[j.held_out]
    recall = j[j.toxic == 1].predicted.mean()
    false = j[j.toxic == 0].predicted.mean()
    assert recall > 0.9 and false < 0.03
    rank = j.score.rank()
    n1, n0 = (j.toxic == 1).sum(), (j.toxic == 0).sum()
    assert (rank[j.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.95


def test_held_out_labels_are_not_used(spark):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    flipped = labels.withColumn("toxic", __import__("pyspark").sql.functions.when(m.held_out(), 1 - labels.toxic).otherwise(labels.toxic))
    a, b = m.fit(docs, labels), m.fit(docs, flipped)
    assert all((x[0] == y[0]).all() and (x[1] == y[1]).all() and x[2] == y[2] for x, y in zip(a, b)) and len(a) == len(b) == m.SHARDS


def test_risk_correction_keeps_clean_texts_low():
    rnd = np.random.default_rng(0)
    row = lambda toxic: (np.unique(np.concatenate([rnd.integers(100, 400, 30), [1, 2] if toxic else []])).astype(np.int32), 1.0)
    pos, unl = [row(True) for _ in range(200)], [row(i % 10 == 0) for i in range(2000)]
    ids, w, b = m.train(pos, unl, 0.075)
    at = dict(zip(ids.tolist(), w))
    assert b < -1 and at[1] + at[2] + b > 1


def test_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    out = m.score(edge_docs(spark), labels).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r.score <= 1 for r in out)
    kept = m.drop_toxic(edge_docs(spark), labels)
    assert kept.columns == edge_docs(spark).columns
    none = labels.where("false")
    assert {r.score for r in m.score(edge_docs(spark), none).collect()} == {0.0}
    assert m.drop_toxic(edge_docs(spark), none).count() == len(edge_rows())
    assert m.score(empty_docs(spark), labels).count() == 0


def test_texts_reach_the_scorer_in_small_batches(spark):
    """Arrow batches are bounded by bytes: 40 texts of 100,000 bytes are not one batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat(substr(sha(cast(id AS string)), 1, 10), 10000) AS text")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")

    @F.pandas_udf("long")
    def size(texts: pd.Series) -> pd.Series:
        return pd.Series([int(texts.str.len().sum())] * len(texts))

    try:
        for run in (m.score, m.drop_toxic):
            spark.conf.unset(name)
            run(docs, labels).collect()
            seen = [r.n for r in docs.select(size("text").alias("n")).collect()]
            assert len(seen) == 40 and max(seen) <= ARROW_BYTES + 100_000
    finally:
        spark.conf.unset(name)


def test_remembered_words_are_packed():
    ids, value = m.features("Cat cat elephants")
    crc = lambda x: zlib.crc32(x.encode()) & m._MASK
    assert sorted(ids) == sorted(map(crc, ["cat", "elephants", "^elep", "^eleph", "^elepha", "^elephan"])) and value == 5.0
    assert ids.dtype == np.int32 and m.features(None)[0].dtype == np.int32
    assert len(m._CACHE["elephants"]) == 20 and isinstance(m._CACHE["elephants"], bytes)

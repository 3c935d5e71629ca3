from __future__ import annotations

import corpus_pipeline as p
import __spark_entry__ as entry
from netzero.llm import op2_exact_dedup, op4_toxicity, op6_mixing, op7_decontaminate, op9_simhash, registry

from .common import edge_docs, empty_docs, read

SF = "/root/testdata/sf0.01"
ORDER = ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]


def test_stages_one_by_one(spark):
    assert [n for n, _ in p.STAGES] == ORDER
    docs = read(spark, SF, "documents")
    columns = docs.columns
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        if name == "toxicity":
            want = ids(op4_toxicity.score(docs, read(spark, SF, "labels")).where("predicted = 0"))
        elif name == "exact_dedup":
            want = ids(op2_exact_dedup.exact_dedup(docs).where("kept"))
        elif name == "near_dedup":
            want = ids(op9_simhash.simhash_components(docs).where("doc_id = component_id"))
        else:
            hit = {r.doc_id for r in op7_decontaminate.contaminations(docs, read(spark, SF, "benchmark")).collect()}
            want = [i for i in ids(docs) if i not in hit]
        assert ids(out) == want
        docs = p.stored(out, "t-stage")
    mixed = p.mixing(spark, docs, SF)
    sizes = docs.withColumn("size", op6_mixing.word_count())
    want = {r.doc_id: r.copies for r in op6_mixing.mix(sizes, "size").collect() if r.copies}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want


def test_run_is_the_stages_in_order(spark):
    out = p.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and set(read(spark, "/root/testdata/sf0.001", "documents").columns) <= set(out.columns)


def test_stages_on_edge_cases(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for _, stage in p.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
            stage(spark, docs, SF).count()
        p.mixing(spark, docs, SF).count()


def test_registered():
    names = set(entry.queries())
    assert set(registry.QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES} == set(range(1, 14))
    assert set(registry.SQL) <= set(registry.QUERIES)

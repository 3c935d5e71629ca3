"""Request parsing, validation, dead letters, and request-driven runs."""

from __future__ import annotations

import json

import pytest

from netzero.operators import parse_requests
from netzero.plans.worker import dead_letters, reconcile_default_source, reconcile_requested
from netzero.sources import ledger_from_tables

from .conftest import SF_SMALL


def body(**data) -> str:
    return json.dumps({"partition_id": "p", "data": data})


CASES = [
    (body(empresa=" building ", conta_contabil="1-URGENT", data_source_path="ledger"), None),
    (body(empresa=" building ", data_source_path="ledger"), "missing_conta_contabil"),
    (body(conta_contabil="1-URGENT", data_source_path="ledger"), "missing_empresa"),
    (body(empresa=" building ", conta_contabil="1-URGENT"), "missing_data_source_path"),
    (body(empresa="  ", conta_contabil="1-URGENT", data_source_path="ledger"), "missing_empresa"),
    ("not json", "invalid_json"),
    ("[1, 2]", "invalid_json"),
    ("", "invalid_json"),
    (json.dumps({"data": 5}), "missing_empresa"),
    (body(empresa="a", conta_contabil="b", data_source_path="c") + " trailing", "invalid_json"),
    (body(empresa="a", conta_contabil="b", data_source_path="c") * 2, "invalid_json"),
    (body(empresa="a", conta_contabil="b", data_source_path="c") + "{", "invalid_json"),
    (body(empresa="a", conta_contabil="b", data_source_path="c").replace('"', "'"), "invalid_json"),
    (body(empresa="a", conta_contabil="b", data_source_path="c")[:-2], "invalid_json"),
    (body(empresa="a", conta_contabil="b", data_source_path="c") + ', "x"', "invalid_json"),
    ("  " + body(empresa="a", conta_contabil="b", data_source_path="c") + "\n", None),
]


def test_reasons(spark):
    df = spark.createDataFrame([(b,) for b, _ in CASES], "body string")
    got = [r.reject_reason for r in parse_requests(df).collect()]
    assert got == [r for _, r in CASES]


def test_numeric_fields_become_text(spark):
    df = spark.createDataFrame([(body(empresa=12, conta_contabil=11, data_source_path="x"),)], "body string")
    r = parse_requests(df).first()
    assert (r.empresa, r.conta_contabil, r.reject_reason) == ("12", "11", None)


@pytest.fixture(scope="module")
def ledger_root(spark):
    from netzero.sources import scratch_path

    root = scratch_path(spark, "req")
    ledger_from_tables(spark, SF_SMALL).write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/ledger")
    return root


def test_requested_slices_only(spark, ledger_root):
    bodies = [body(empresa=" building ", conta_contabil="1-URGENT", data_source_path="ledger")] * 2 + [
        body(empresa=" machinery ", data_source_path="ledger"), "garbage"]
    req = spark.createDataFrame([(b,) for b in bodies], "body string")
    out = reconcile_requested(spark, req, root=ledger_root)
    assert {(r.empresa, r.conta_contabil) for r in out.select("empresa", "conta_contabil").distinct().collect()} \
        == {("BUILDING", "1-URGENT")}
    expected = (ledger_from_tables(spark, SF_SMALL)
                .where("empresa = ' building ' and conta_contabil = '1-URGENT'").count())
    assert out.count() == expected  # duplicate request read once
    letters = dead_letters(req).collect()
    assert sorted(r.reject_reason for r in letters) == ["invalid_json", "missing_conta_contabil"]
    again = dead_letters(parse_requests(req))  # already parsed: same letters, no duplicate columns
    assert again.columns.count("partition_id") == 1 and again.count() == 2


def test_no_valid_requests(spark, ledger_root):
    req = spark.createDataFrame([("garbage",)], "body string")
    assert reconcile_requested(spark, req, root=ledger_root).count() == 0


def test_default_source_variant(spark, ledger_root):
    req = spark.createDataFrame([(body(empresa=" building ", conta_contabil="5-LOW"),)], "body string")
    out = reconcile_default_source(spark, req, "ledger", root=ledger_root)
    assert out.count() > 0
    assert {r.conta_contabil for r in out.select("conta_contabil").distinct().collect()} == {"5-LOW"}


# --- property test: request parsing against Python's json module -------------

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_MISSING = object()
value = st.sampled_from([_MISSING, None, "", "  ", "X", " a b ", 12])
data_part = st.one_of(
    st.fixed_dictionaries({}, optional={"empresa": value, "conta_contabil": value,
                                        "data_source_path": value}),
    st.sampled_from([None, "x", [1]]))
message = st.fixed_dictionaries({}, optional={"partition_id": st.sampled_from(["p", 5, None]),
                                              "data": data_part})
garbage = st.sampled_from(["", "not json", "[1, 2]", "1", "null", '"s"', "{", "{}"])


broken = st.builds(lambda m, f: f(_dump(m)), message, st.sampled_from([
    lambda b: b + " trailing", lambda b: b + b, lambda b: b + "{", lambda b: b[:-1], lambda b: b + ",1",
    lambda b: "[" + b + "]", lambda b: " " + b + " "]))


def _dump(obj):
    if isinstance(obj, dict):
        return json.dumps({k: _dump_v(v) for k, v in obj.items() if v is not _MISSING})
    return obj


def _dump_v(v):
    if isinstance(v, dict):
        return {k: x for k, x in v.items() if x is not _MISSING}
    return v


def model(text):
    try:
        obj = json.loads(text)
    except ValueError:
        return "invalid_json"
    if not isinstance(obj, dict):
        return "invalid_json"
    data = obj.get("data")
    data = data if isinstance(data, dict) else {}
    for name in ("empresa", "conta_contabil", "data_source_path"):
        v = data.get(name)
        if v is None or str(v).strip(" ") == "":
            return "missing_" + name
    return None


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(message.map(_dump), garbage, broken), min_size=1, max_size=40))
def test_parse_matches_json_module(spark, bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [r.reject_reason for r in parse_requests(df).collect()]
    assert got == [model(b) for b in bodies]


def test_absent_slice_and_two_datasets(spark, ledger_root):
    from netzero.sources import ledger_from_tables as ledger

    absent = spark.createDataFrame([(body(empresa="nobody", conta_contabil="0", data_source_path="ledger"),)],
                                   "body string")
    assert reconcile_requested(spark, absent, root=ledger_root).count() == 0

    # a second dataset under the same root: each path is reconciled on its own
    ledger(spark, SF_SMALL).where("conta_contabil = '5-LOW'") \
        .write.partitionBy("empresa", "conta_contabil").parquet(f"{ledger_root}/ledger_copy")
    both = spark.createDataFrame(
        [(body(empresa=" building ", conta_contabil="5-LOW", data_source_path=p),) for p in ("ledger", "ledger_copy")],
        "body string")
    out = reconcile_requested(spark, both, root=ledger_root)
    one = reconcile_requested(spark, both.limit(1), root=ledger_root)
    assert out.count() == 2 * one.count() > 0
    assert out.where("reconciliation_status = 'CONCILIADO'").count() == \
        2 * one.where("reconciliation_status = 'CONCILIADO'").count()


def test_result_does_not_depend_on_the_other_requests(spark, scratch):
    """Two raw spellings of a company are two slices: the same rows and ids
    whether they are handled together or one by one."""
    root = scratch("spell")
    raw = spark.createDataFrame([("acme", "1", "T", "10.00"), (" ACME ", "1", "T", "-10.00"), ("acme", "1", "U", "0.00")],
                                "empresa string, conta_contabil string, transactionID string, valor_net string")
    for name in ("x", "y"):
        raw.write.partitionBy("empresa", "conta_contabil").parquet(f"{root}/{name}")
    bodies = [body(empresa=e, conta_contabil="1", data_source_path=p) for e in ("acme", " ACME ") for p in ("x", "y")]

    def rows(bs):
        req = spark.createDataFrame([(b,) for b in bs], "body string")
        return [tuple(r) for r in reconcile_requested(spark, req, root=root, keep_origin=True).collect()]

    together = sorted(map(str, rows(bodies)))
    assert together == sorted(str(r) for b in bodies for r in rows([b]))
    assert sum("CONCILIADO" in r for r in together) == 2  # only the lone zero, once for each dataset
    ids = [r[-1] for b in bodies for r in rows([b]) if r[-1]]
    assert len(set(ids)) == 2

import hashlib
import json

import pytest
from conftest import moment
from pyspark.sql import functions as F

from lamina.functions.keys import campaign_key, version_key
from lamina.operators.contract import (
    ContractViolation,
    check_counts,
    column_audit,
    differences,
    evidence,
    identifier_leaks,
    manifest,
    require_pass,
    row_counts,
    table_digest,
    unknown_references,
)


@pytest.fixture(scope="module")
def tables(spark):
    dim = spark.createDataFrame(
        [("k1", "Active", True), ("k2", "CL-000001", True), ("k3", None, True)],
        "client_key string, lifecycle_stage string, synthetic_record boolean",
    )
    fact = spark.createDataFrame(
        [("k1", 3, True)], "client_key string, event_count long, synthetic_record boolean"
    )
    return {"dim_client": dim, "fact_engagement_daily": fact, "raw": dim.limit(0)}


def expected(spark, **counts):
    return spark.createDataFrame(list(counts.items()), "asset string, expected_rows long")


def test_counts_report_every_failure(spark, tables):
    found = check_counts(tables, expected(spark, dim_client=3, fact_engagement_daily=9), {"raw": 1})
    got = {r.asset: (r.expected_rows, r.min_rows, r.actual_rows, r.status) for r in found.collect()}
    assert got == {
        "dim_client": (3, None, 3, "PASS"),
        "fact_engagement_daily": (9, None, 1, "FAIL"),
        "raw": (None, 1, 0, "FAIL"),
    }
    assert {r.asset: r.actual_rows for r in row_counts(tables).collect()} == {
        "dim_client": 3, "fact_engagement_daily": 1, "raw": 0,
    }


def test_leaks_are_found_by_name_and_by_value(spark, tables):
    named = {"t": spark.createDataFrame([(5, "x")], "Phone long, other string")}
    by_name = identifier_leaks(named).where("forbidden_name").collect()
    assert [(r.asset, r.column_name) for r in by_name] == [("t", "Phone")]
    by_value = identifier_leaks(tables).where("leaked_values > 0").collect()
    assert {(r.asset, r.column_name, r.leaked_values) for r in by_value} == {
        ("dim_client", "lifecycle_stage", 1)
    }


def test_evidence_passes_or_raises(spark, tables, tmp_path):
    good = {"fact_engagement_daily": tables["fact_engagement_daily"]}
    counts = check_counts(good, expected(spark, fact_engagement_daily=1), {})
    record = require_pass(evidence(counts, identifier_leaks(good), good, "dev"), f"{tmp_path}/ok")
    assert record["status"] == "PASS" and record["counts"] == {"fact_engagement_daily": 1}
    assert record["synthetic_data_only"] is True and record["environment"] == "dev"
    bad = check_counts(tables, expected(spark, dim_client=4), {"raw": 1})
    with pytest.raises(ContractViolation) as caught:
        require_pass(evidence(bad, identifier_leaks(tables), tables, "dev"), f"{tmp_path}/bad")
    for part in ("'dim_client'", "'raw'", "dim_client.lifecycle_stage"):
        assert part in str(caught.value)
    assert json.loads(next((tmp_path / "bad").glob("*.json")).read_text())["status"] == "FAIL"


def test_manifest_is_the_digest_of_sorted_json(spark, tables):
    row = manifest({"b": tables["dim_client"], "a": tables["fact_engagement_daily"]}).first()
    text = json.dumps({"a": 1, "b": 3}, sort_keys=True)
    assert row.counts_json == text
    assert row.contract_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_keys_are_plain_digests(spark):
    df = spark.createDataFrame([("CL-000001", moment(1))], "c string, t timestamp")
    row = df.select(version_key(F.col("c"), F.col("t")), campaign_key(F.col("c"))).first()
    assert row[0] == hashlib.sha256(b"CL-000001||2024-01-01T00:00:01.000000Z").hexdigest()
    assert row[1] == hashlib.sha256(b"CL-000001").hexdigest()


def test_equality_checks_ignore_order_and_count_copies(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "n int, s string")
    right = spark.createDataFrame([(2, None), (1, "a"), (3, "c")], "n int, s string")
    assert tuple(differences(left, right).first()) == (3, 3, 1, 1)
    assert tuple(differences(left, left.orderBy("s")).first()) == (3, 3, 0, 0)
    assert table_digest(left).first() == table_digest(left.repartition(5)).first()
    assert table_digest(left).first() != table_digest(right).first()


def test_audits(spark):
    df = spark.createDataFrame(
        [("a", "CL-1", -3), (None, "x", 4), ("a", None, None)], "k string, c string, n int"
    )
    audit = column_audit(
        df, distinct=["k"], nulls=["k", "n"], prefixes={"c": "CL-"}, equals={"c": "x"}, negatives=["n"]
    )
    assert {(r.audit, r.column_name): r.value_count for r in audit.collect()} == {
        ("distinct", "k"): 1, ("null", "k"): 1, ("null", "n"): 1, ("prefix", "c"): 1,
        ("equal", "c"): 1, ("negative", "n"): 1,
    }
    known = spark.createDataFrame([("x",)], "c string")
    assert [r.c for r in unknown_references(df, known, "c").collect()] == ["CL-1"]


def test_a_missing_table_fails(spark, tables):
    found = check_counts(tables, expected(spark, nowhere=3, dim_client=3), {"elsewhere": 1})
    got = {r.asset: (r.actual_rows, r.status) for r in found.collect()}
    assert got["nowhere"] == (None, "FAIL") and got["elsewhere"] == (None, "FAIL")
    assert got["dim_client"] == (3, "PASS") and got["raw"] == (0, "PASS")


def test_rows_that_are_not_synthetic_fail_the_run(spark, tables):
    good = {"fact": tables["fact_engagement_daily"]}
    real = {"fact": good["fact"].withColumn("synthetic_record", F.lit(None).cast("boolean"))}
    counts = check_counts(good, expected(spark, fact=1), {})
    for held, outcome in ((good, "PASS"), (real, "FAIL"), ({"none": spark.range(1)}, "FAIL")):
        record = evidence(counts, identifier_leaks(good), held, "test", "c", ("x", "y")).first()
        assert (record.status, record.catalog, record.schemas) == (outcome, "c", "x,y")

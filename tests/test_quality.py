"""Rules, constraints and audits."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from meterhouse.operators import quality
from meterhouse.operators.quality import Constraints


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, n int")


def test_null_violates_unless_the_rule_allows_it(numbers):
    assert [r["id"] for r in quality.expect_or_drop(numbers, {"r": "n >= 0"}).collect()] == [1]
    kept = quality.expect_or_drop(numbers, {"r": "n IS NULL OR n >= 0"})
    assert [r["id"] for r in kept.orderBy("id").collect()] == [1, 3]


def test_expect_keeps_and_counts(numbers):
    seen = Observation()
    assert quality.expect(numbers, {"r": "n >= 0"}, seen).count() == 3
    assert seen.get == {"rows_in": 3, "r": 2}


def test_drop_counts_before_it_drops(numbers):
    seen = Observation()
    assert quality.expect_or_drop(numbers, {"r": "n >= 0"}, seen).count() == 1
    assert seen.get == {"rows_in": 3, "r": 2}


def test_fail_stops_the_job(numbers):
    with pytest.raises(Exception, match="expectation positive violated"):
        quality.expect_or_fail(numbers, {"positive": "n > 0"}).collect()
    assert quality.expect_or_fail(numbers, {"known": "id > 0"}).count() == 3


def test_mixed_rules(numbers):
    out = quality.apply_rules(numbers, {"a": ("warn", "n > 9"), "b": ("drop", "n IS NOT NULL")})
    assert [r["id"] for r in out.orderBy("id").collect()] == [1, 2]
    with pytest.raises(Exception, match="expectation c violated"):
        quality.apply_rules(numbers, {"c": ("fail", "n > 9")}).collect()


def test_report_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "n int")
    rows = quality.quality_report(empty, {"r": ("warn", "n > 0")}).collect()
    assert [tuple(r) for r in rows] == [("r", "warn", 0, 0)]


def test_constraints(spark):
    spec = Constraints(
        not_null=["name"],
        unique=["id", "name"],
        positive=["n"],
        members={"kind": ["a", "b"]},
        foreign={"parent": ("parents", "p")},
        defaults={"n": 7},
    )
    rows = [
        (1, "x", 1, "a", 1),
        (2, None, None, "a", None),
        (3, "y", 0, "c", 9),
        (3, "z", 5, None, 1),
        (None, "x", 5, "b", 1),
    ]
    df = spark.createDataFrame(rows, "id int, name string, n int, kind string, parent int")
    parents = spark.createDataFrame([(1,), (1,)], "p int")
    found = {
        (r["id"], r["name"]): list(r["_violations"])
        for r in quality.with_violations(df, spec, {"parents": parents}).collect()
    }
    assert found == {
        (1, "x"): ["unique:name"],
        (2, None): ["not_null:name"],
        (3, "y"): ["foreign:parent", "member:kind", "positive:n", "unique:id"],
        (3, "z"): ["unique:id"],
        (None, "x"): ["unique:name"],
    }
    ok, bad = quality.check_constraints(df, spec, {"parents": parents})
    assert ok.count() == 0 and bad.count() == 5


def test_audit_finds_a_repeated_and_a_missing_key(spark):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "k int")

    good = quality.audit_increment(ids(1, 2), ids(1, 2, 3), ids(3), "k").first()
    assert good["is_exact"]
    bad = quality.audit_increment(ids(1, 2), ids(1, 2, 2, 9), ids(3), "k").first().asDict()
    assert (bad["repeated_keys"], bad["missing_keys"], bad["foreign_keys"], bad["is_exact"]) == (1, 1, 1, False)


def test_double_writes(spark):
    log = spark.createDataFrame(
        [(1, 1, 130, None), (1, 1, 130, "c1"), (1, 2, 50, None), (1, 2, 50, "c2"), (2, 1, 10, "c3")],
        "user_id int, time_stamp int, tokens_used int, conversation_id string",
    )
    row = quality.double_write_report(log).first().asDict()
    assert (row["rows_total"], row["twin_pairs"]) == (5, 2)
    assert (row["tokens_logged"], row["tokens_net"]) == (370, 190)
    assert row["inflation"] == pytest.approx(370 / 190, abs=1e-4)


def test_missing_columns_do_not_break_silver(spark):
    from meterhouse.operators import shape

    thin = spark.createDataFrame(
        [(1, 2, 3, "2024-01-01 00:00:00", "success", "12"), (2, 2, 3, "no time", "failed", "x")],
        "q_id int, user_id int, plan_id int, time_stamp string, query_status string, tokens_used string",
    )
    rows = shape.silver_query_events(thin).orderBy("q_id").collect()
    assert [r["tokens_used"] for r in rows] == [12, None]
    assert rows[0]["event_ts"] is not None and rows[1]["event_ts"] is None
    assert rows[0]["conversation_id"] is None


def test_spans_keep_their_order(spark):
    from meterhouse.operators import shape

    trace = (
        '[{"timestamp":"2024-01-01T00:00:00.250","level":"INFO","message":"a"},'
        '{"timestamp":"2024-01-01T00:00:01","level":"WARN","message":"b"},'
        '{"timestamp":"bad","level":"INFO","message":"c"}]'
    )
    df = spark.createDataFrame(
        [("r1", trace), ("r2", None), ("r3", "[]"), ("r4", "no json")],
        "request_id string, backend_trace string",
    )
    rows = shape.request_spans(df).orderBy("step_no").collect()
    assert [(r["request_id"], r["step_no"], r["message"], r["gap_ms"]) for r in rows] == [
        ("r1", 1, "a", None),
        ("r1", 2, "b", 750),
        ("r1", 3, "c", None),
    ]


def test_token_estimate(spark):
    from meterhouse.functions.columns import estimate_tokens

    texts = ["", "   ", "one", "a b c d e f", " lead  and\ttrail \n", "x " * 100, "a b c d e f g"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(estimate_tokens(F.col("t"))).collect()]
    assert got == [max(50, 10 * len(t.split())) for t in texts]

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeframe.config import Rule, load_root_causes, load_rules, parse_rule_text
from gaugeframe.operators import outcomes
from gaugeframe.operators.rules import count_failures, findings, java_regex, skipped_columns
from gaugeframe.operators.samples import (
    duplicate_rows, failing_rows, negative_rows, sample_json, sample_rows)
from gaugeframe.session import local_frame


def rule(kind, *args, table="t", columns=(), **more):
    return Rule(more.pop("id", kind.lower()), table, "d", kind, args, tuple(columns), **more)


def counts(tables, *rules, **options):
    rows = count_failures(tables, rules, **options).collect()
    return {r.check_id: (r.failure_count, r.total_rows) for r in rows}


def strings(spark, *values):
    return {"t": local_frame(spark, [(v,) for v in values], "c string")}


def test_null_percentage(spark):
    assert counts(strings(spark, "a", None, ""), rule("NULL_PERCENTAGE", columns=["c"])) == {
        "null_percentage": (1, 3)}


def test_pattern_finds_and_ends_strictly(spark):
    tables = strings(spark, " AB ", "ABC", "AB\n", None, "xABx")
    assert counts(tables, rule("PATTERN", "^[A-Z]{2}$", columns=["c"])) == {"pattern": (3, 5)}
    assert counts(tables, rule("pattern", "AB", columns=["c"])) == {"pattern": (0, 5)}
    assert java_regex("a$") == r"a\z" and java_regex(r"a\$") == r"a\$"


def test_enum_ignores_case_and_spaces(spark):
    tables = strings(spark, " Lesson", "other", None, "MODULE")
    assert counts(tables, rule("ENUM", "lesson", "Module", columns=["c"])) == {"enum": (1, 4)}


def test_date_range_is_inclusive(spark):
    df = spark.sql("""SELECT * FROM VALUES (timestamp_ntz'2000-01-01'), (timestamp_ntz'1999-12-31'),
        (timestamp_ntz'2024-01-01 00:00:01'), (timestamp_ntz'2024-01-01'), (null) AS t(c)""")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    r = rule("DATE_RANGE", "2000-01-01T00:00:00Z", "now", columns=["c"])
    assert counts({"t": df}, r, as_of=now) == {"date_range": (2, 5)}
    assert counts({"t": df}, r) == {"date_range": (1, 5)}


def test_timestamp_order(spark):
    df = local_frame(
        spark, [(1, 2, 3), (2, 1, 3), (None, 1, 2), (1, None, 0), (1, 1, None), (3, None, None)],
        "a int, b int, c int")
    assert counts({"t": df}, rule("TIMESTAMP_ORDER", columns=["a", "b", "c"])) == {
        "timestamp_order": (3, 6)}


def test_non_negative_counts_sweep_tables(spark):
    tables = {
        "x": local_frame(spark, [(-1, 1, "n"), (2, -2, "m")], "view_count int, COUNTS double, count_note string"),
        "y": local_frame(spark, [(-5,), (None,), (1,)], "n_count bigint"),
    }
    r = rule("NON_NEGATIVE_COUNTS", table="*", column_regex=".*count.*")
    assert counts(tables, r) == {"non_negative_counts": (3, 7)}
    assert skipped_columns(r, tables) == [("x", "count_note")]
    none = rule("NON_NEGATIVE_COUNTS", table="*", column_regex="zzz", fail=0.0)
    present = rule("NULL_PERCENTAGE", table="y", columns=["n_count"], warning=0.1, fail=0.9)
    judged = {r.check_id: r for r in outcomes.judge(
        count_failures(tables, [none, present]), [none, present]).collect()}
    swept = judged["non_negative_counts"]
    assert (swept.total_rows, swept.failure_rate, swept.status) == (0, 0.0, "fail")
    assert judged["null_percentage"].status == "warn"
    named = negative_rows(tables["x"], ["view_count", "COUNTS"]).collect()
    assert Counter(r.failed_column for r in named) == {"view_count": 1, "COUNTS": 1}


def test_unique_mapping_and_duplicates_share_a_pass(spark):
    df = local_frame(
        spark,
        [("a", "1"), ("a", "2"), ("a", None), ("b", "1"), ("b", "1"), (None, "1"), (None, "2")],
        "k string, v string")
    rules = [
        rule("UNIQUE_MAPPING", "k", "v"),
        rule("DUPLICATE_PERCENTAGE", columns=["k"]),
        rule("DUPLICATE_PERCENTAGE", columns=["k", "v"], id="pair"),
        rule("UNIQUE_MAPPING", "v", "k", id="reverse"),
    ]
    assert counts({"t": df}, *rules) == {
        "unique_mapping": (3, 7), "duplicate_percentage": (4, 7), "pair": (1, 7), "reverse": (4, 7)}
    bad = failing_rows({"t": df}, rules[0])
    assert Counter(r.k for r in bad.collect()) == {"a": 3}


@pytest.mark.parametrize("runs", [1, 3])
def test_keys_counted_in_slices_add_up(spark, runs):
    # Hot, NULL and lone keys, in rows that differ; 0.0 and -0.0 are one key.
    rows = [
        (f"r{i % runs}", None if i % 4 == 0 else "hot" if i % 4 == 1 else f"k{i // 3}", i % 50,
         (0.0, -0.0, 1.5, None)[i % 7 % 4])
        for i in range(400)
    ]
    t = local_frame(spark, rows, "run string, c string, v int, x double")
    far = local_frame(spark, [("hot",), (None,), ("k5",)], "c string")
    rules = [
        rule("DUPLICATE_PERCENTAGE", columns=["c"]),
        rule("DUPLICATE_PERCENTAGE", columns=["x"], id="zeros"),
        rule("DUPLICATE_PERCENTAGE", columns=["c", "x"], id="both"),
        rule("UNIQUE_MAPPING", "c", "v"), rule("FK", "far.c", columns=["c"]),
        rule("NULL_PERCENTAGE", columns=["c"]),
    ]
    by = ["run"] if runs > 1 else []
    got = {
        (r.check_id, r.run if by else "r0"): (r.failure_count, r.total_rows)
        for r in count_failures({"t": t, "far": far}, rules, by=by).collect()
    }
    want = {}
    for run in sorted({r for r, *_ in rows}):
        own = [one for one in rows if one[0] == run]
        for check, parts in (("duplicate_percentage", (1,)), ("zeros", (3,)), ("both", (1, 3))):
            keys = Counter(tuple(one[p] for p in parts) for one in own)
            want[check, run] = (sum(n - 1 for n in keys.values()), len(own))
        held = [one for one in own if one[1] is not None]
        values = {c: {v for _, d, v, _ in held if d == c} for _, c, _, _ in held}
        want["unique_mapping", run] = (sum(len(values[c]) > 1 for _, c, _, _ in held), len(own))
        want["fk", run] = (sum(c not in ("hot", "k5") for _, c, _, _ in held), len(own))
        want["null_percentage", run] = (len(own) - len(held), len(own))
    assert got == want
    if not by:
        found = findings({"t": t, "far": far}, rules).collect()
        assert {r.check_id: (r.failure_count, r.total_rows) for r in found if r.key is None} == {
            check: n for (check, _), n in want.items()}
        assert {tuple(r.key): r.failure_count for r in found if r.check_id == "duplicate_percentage" and r.key}[
            (None,)] == 99


def test_foreign_key(spark):
    tables = {
        "s": local_frame(spark, [("1",), ("2",), ("2",), (None,), ("1",)], "f string"),
        "r": local_frame(spark, [("1",), ("1",), (None,)], "id string"),
    }
    r = rule("FK", "r.id", table="s", columns=["f"])
    assert counts(tables, r) == {"fk": (2, 5)}
    assert [x.f for x in failing_rows(tables, r).collect()] == ["2", "2"]


def test_empty_tables_and_errors(spark):
    empty = {"t": local_frame(spark, [], "c string, d string")}
    rules = [rule("NULL_PERCENTAGE", columns=["c"]), rule("DUPLICATE_PERCENTAGE", columns=["c"]),
             rule("UNIQUE_MAPPING", "c", "d"), rule("FK", "t.d", columns=["c"])]
    judged = outcomes.judge(count_failures(empty, rules), rules).collect()
    assert {(r.failure_count, r.total_rows, r.failure_rate) for r in judged} == {(0, 0, 0.0)}
    assert len(judged) == 4
    with pytest.raises(ValueError, match="No handler"):
        count_failures(empty, [rule("MAGIC")])
    with pytest.raises(ValueError, match="Missing staging table"):
        count_failures(empty, [rule("NULL_PERCENTAGE", table="gone", columns=["c"])])


def test_many_runs_at_once_equal_single_runs(spark):
    rows = [("r1", "a", "x"), ("r1", "a", None), ("r2", "a", "x"), ("r2", "q", "x"), ("r2", "q", "x")]
    df = local_frame(spark, rows, "run_id string, k string, v string")
    ref = local_frame(spark, [("a",)], "id string")
    rules = [rule("NULL_PERCENTAGE", columns=["v"]), rule("DUPLICATE_PERCENTAGE", columns=["k"]),
             rule("DUPLICATE_PERCENTAGE", columns=["k", "v"], id="kv"),
             rule("UNIQUE_MAPPING", "k", "v"), rule("FK", "ref.id", columns=["k"])]
    many = count_failures({"t": df, "ref": ref}, rules, by=["run_id"]).collect()
    got = {(r.run_id, r.check_id): (r.failure_count, r.total_rows) for r in many}
    for run in ("r1", "r2"):
        single = counts({"t": df.where(F.col("run_id") == run), "ref": ref}, *rules)
        assert {k[1]: v for k, v in got.items() if k[0] == run} == single


KEYS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(KEYS)
def test_duplicates_equal_ranked_rows(spark, rows):
    df = local_frame(spark, [(*r, i % 3) for i, r in enumerate(rows)], "k string, v int, x int")
    expected = sum(n - 1 for n in Counter(rows).values())
    got = counts({"t": df}, rule("DUPLICATE_PERCENTAGE", columns=["k", "v"]))
    assert got.get("duplicate_percentage", (0, 0))[0] == expected
    ranked = duplicate_rows(df, ["k", "v"], slices=3, chunk=2).collect()
    per_key = Counter()
    for r in ranked:
        per_key[(r.k, r.v)] += 1
    assert len(ranked) == expected
    assert sorted((r.k or "", r.v or 0, r.dq_rank) for r in ranked) == sorted(
        (k or "", v or 0, i) for (k, v), n in Counter(rows).items() for i in range(2, n + 1))
    # Together with one row per key, the failing rows are the table again.
    left = Counter((*r, i % 3) for i, r in enumerate(rows))
    left.subtract((r.k, r.v, r.x) for r in ranked)
    assert all(n >= 0 for n in left.values()) and sum(left.values()) == len(set(rows))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([1, 2, 3, None]), max_size=15), st.lists(st.sampled_from([1, 2, None]), max_size=6))
def test_foreign_key_equals_brute_force(spark, source, target):
    tables = {"s": local_frame(spark, [(v,) for v in source], "f int"),
              "r": local_frame(spark, [(v,) for v in target], "id int")}
    got = counts(tables, rule("FK", "r.id", table="s", columns=["f"])).get("fk", (0, 0))
    assert got == (sum(v is not None and v not in target for v in source), len(source))


def test_samples(spark):
    df = local_frame(spark, [(None, i) for i in range(9)] + [("x", 1), ("x", 2), ("y", -1)], "k string, n_count int")
    rules = [rule("NULL_PERCENTAGE", columns=["k"]), rule("DUPLICATE_PERCENTAGE", columns=["k"]),
             rule("NON_NEGATIVE_COUNTS", table="*", column_regex="count"),
             rule("UNIQUE_MAPPING", "k", "n_count"), rule("FK", "t.n_count", columns=["k"], id="fk")]
    tables = {"t": df, "keys": local_frame(spark, [("x",)], "id string")}
    rules[4] = rule("FK", "keys.id", columns=["k"])
    found = {r.check_id: json.loads(r.sample_bad_rows_json)
             for r in sample_json(sample_rows(tables, rules)).collect()}
    assert found["null_percentage"] == [{"k": None, "n_count": str(i)} for i in range(5)]
    assert [r["dq_rank"] for r in found["duplicate_percentage"]] == ["2", "3", "4", "5", "6"]
    assert found["non_negative_counts"] == [{"k": "y", "n_count": "-1", "failed_column": "n_count"}]
    assert found["unique_mapping"] == [{"k": "x", "n_count": "1"}, {"k": "x", "n_count": "2"}]
    assert found["fk"] == [{"k": "y", "n_count": "-1"}]


def test_rule_configuration(tmp_path):
    assert parse_rule_text("FK(users.user_id)") == ("FK", ("users.user_id",))
    assert parse_rule_text("PATTERN(^a{1,2}$)") == ("PATTERN", ("^a{1,2}$",))
    assert parse_rule_text({"type": "ENUM", "args": ["a,b", 1]}) == ("ENUM", ("a,b", "1"))
    assert parse_rule_text(" NULL_PERCENTAGE ") == ("NULL_PERCENTAGE", ())
    path = tmp_path / "rules.yml"
    path.write_text("""
checks:
  completeness:
    - {id: a, table: users, column: email, rule: NULL_PERCENTAGE}
  integrity:
    - {id: b, table: events, columns: [x, y], rule: "FK(users.user_id)", severity: 5, weight: 2}
""")
    causes = load_root_causes({"checks": {
        "a": [{"probable_cause": "p", "recommended_fix": "f"}, {"probable_cause": "q"}], "b": "?"}})
    loaded = load_rules(path, causes)
    a, b = loaded.rules
    assert (a.columns, a.severity, a.weight, a.warning, a.fail) == (("email",), 1, 1.0, 0.0, 0.0)
    assert (b.columns, b.args, b.dimension) == (("x", "y"), ("users.user_id",), "integrity")
    assert [c.probable_cause for c in loaded.causes_of("a")] == ["p"] and loaded.causes_of("b") == ()
    assert (loaded.baseline, loaded.minimum) == (100.0, 0.0)
    assert b.issue_type == "orphan" and rule("enum").issue_type == "invalid"

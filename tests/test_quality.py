"""Validator invariants and boundaries on small frames."""

import pytest
from pyspark.sql import functions as F

from corral.functions import rules as R
from corral.operators import quality as Q


@pytest.fixture()
def rows(spark):
    data = [
        (1, "a", 10.0, "x@y.com", "12"),
        (2, None, -5.0, "bad", "oops"),
        (3, "  ", 100.0, "z@y.com", None),
        (3, "c", 1000.0, None, "7"),
        (None, "d", 50.0, "q@y.com", "8"),
        (None, "e", 60.0, "r@y.com", "9"),
    ]
    return spark.createDataFrame(data, "id long, name string, amount double, email string, code string")


def multiset(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_split_is_a_partition_of_the_input(spark, rows):
    rules = [
        R.not_null("name", action="quarantine"),
        R.in_range("amount", 0, 500, action="failjob"),
        R.matches("email", "@", action="report"),
    ]
    v = Q.validate(rows, rules)
    good, bad = v.correct_data, v.erroneous_data.drop("action")
    assert good.count() + bad.count() == rows.count()
    assert multiset(good.unionByName(bad)) == multiset(rows)


def test_actions_and_null_verdicts(spark, rows):
    rules = [
        R.not_blank("name", action="quarantine"),
        R.in_range("amount", min_value=0, action="quarantine,failjob"),
        R.matches("email", "@", action="report"),
    ]
    err = {r["id"] if r["id"] != 3 else (3, r["name"]): r["action"] for r in Q.validate(rows, rules).erroneous_data.collect()}
    # id 2: null name, negative amount, bad email -> all three actions, in rule order
    assert err[2] == "quarantine,quarantine,failjob,report" or err[2] == "quarantine,failjob,report"
    assert (3, "  ") in err and err[(3, "  ")] == "quarantine"
    # null email is not a regex violation; the row is good
    assert (3, "c") not in err


def test_report_only_rows_stay_good(spark, rows):
    v = Q.validate(rows, [R.matches("email", "@", action="report")])
    assert v.erroneous_data.count() == 0
    s = {r["Check"]: r["Impacted_Records"] for r in v.summary.collect()}
    assert s == {"regex": 1}


def test_null_action_is_erroneous_without_action(spark, rows):
    v = Q.validate(rows, [R.not_null("name", action=None)])
    bad = v.erroneous_data.collect()
    assert len(bad) == 1 and bad[0]["action"] is None
    assert Q.quarantine_rows(v.erroneous_data).count() == 0
    assert Q.failjob_gate(v.erroneous_data).first()["blocked"] is False


def test_no_rules_keeps_fixed_summary_schema(spark, rows):
    v = Q.validate(rows, [])
    assert v.summary.count() == 0
    assert v.summary.schema == Q.SUMMARY_SCHEMA
    assert v.correct_data.count() == rows.count()


def test_all_rows_bad_and_zero_rows(spark, rows):
    v = Q.validate(rows, [R.expression("amount > 1e9", column="amount", action="failjob")])
    assert v.correct_data.count() == 0
    with pytest.raises(Q.DataQualityStop):
        Q.enforce_failjob_gate(v.erroneous_data)
    empty = rows.where(F.lit(False))
    e = Q.validate(empty, [R.not_null("name")])
    assert [tuple(r) for r in e.summary.collect()] == [("Completeness", "not_null", "name", "Passed", 0, "quarantine")]


def test_unique_groups_null_keys_like_group_by(spark, rows):
    v = Q.validate(rows, [R.unique("id")])
    ids = sorted((r["id"] is None, r["id"] or 0) for r in v.erroneous_data.collect())
    assert ids == [(False, 3), (False, 3), (True, 0), (True, 0)]


def test_foreign_key_null_child_passes_and_parent_duplicates_do_not_multiply(spark, rows):
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk long")
    v = Q.validate(rows, [R.foreign_key("id", parent, "pk")])
    assert v.tagged.count() == rows.count()
    assert sorted(r["id"] for r in v.erroneous_data.collect()) == [3, 3]


def test_type_rule_uses_try_cast(spark, rows):
    v = Q.validate(rows, [R.castable("code", "INT")])
    assert [r["code"] for r in v.erroneous_data.collect()] == ["oops"]


def test_materialize_matches_lazy_outputs(spark, rows, tmp_dir):
    rules = [R.not_null("name", action="quarantine"), R.in_range("amount", 0, 500, action="failjob")]
    v = Q.validate(rows, rules)
    m = v.materialize(location=tmp_dir + "/dq")
    assert multiset(m.correct_data) == multiset(v.correct_data)
    assert multiset(m.erroneous_data) == multiset(v.erroneous_data)
    assert multiset(m.summary) == multiset(v.summary)
    assert m.good_count == v.correct_data.count()
    assert m.failjob_count == 2 and m.quarantined_count == 1


def test_status_texts(spark, rows):
    q_only = Q.validate(rows, [R.not_null("name", action="quarantine")])
    assert Q.execution_status(q_only).first()[0] == Q.STATUS_PASSED_QUARANTINE
    both = Q.validate(rows, [R.not_null("name", action="quarantine"), R.in_range("amount", 0, 500, action="failjob")])
    assert Q.execution_status(both).first()[0] == Q.STATUS_FAILED_QUARANTINE
    fail = Q.validate(rows, [R.in_range("amount", 0, 500, action="failjob")])
    assert Q.execution_status(fail).first()[0] == Q.STATUS_FAILED_NO_QUARANTINE
    none = Q.validate(rows, [R.in_range("amount", -1e9, 1e9, action="failjob")])
    assert Q.execution_status(none).first()[0] == Q.STATUS_PASSED_NO_QUARANTINE
    # the stored-setting reading: a rule that may fail the job marks it failed
    assert Q.execution_status(q_only, configured_failjob=True).first()[0] == Q.STATUS_FAILED_QUARANTINE
    assert Q.ticket_flag([{"failJob": True, "ticket": False}, {"ticket": True}]) == "Yes"


def test_rules_from_config(spark, rows):
    parent = spark.createDataFrame([(1,), (2,)], "pk long")
    specs = [
        {"check": "not_null", "column": "name", "action": "quarantine"},
        {"check": "range", "column": "amount", "min": 0, "max": 500, "action": "failjob"},
        {"check": "in_set", "column": "name", "values": ["a", "c"], "action": "report"},
        {"check": "regex", "column": "email", "pattern": "@"},
        {"check": "length", "column": "name", "max": 1},
        {"check": "type", "column": "code", "data_type": "INT"},
        {"check": "unique", "column": "id"},
        {"check": "foreign_key", "column": "id", "parent": "p", "parent_key": "pk"},
        {"check": "expression", "condition": "amount < 10000", "column": "amount"},
    ]
    v = Q.validate(rows, R.rules_from_config(specs, {"p": parent}))
    assert v.summary.count() == len(specs)
    assert v.correct_data.count() + v.erroneous_data.count() == rows.count()


def test_limits_are_inclusive(spark):
    df = spark.createDataFrame(
        [(0.0, "abc"), (-0.01, "abcd"), (500.0, "ab"), (500.01, ""), (None, None)], "x double, s string"
    )
    rng = Q.validate(df, [R.in_range("x", 0, 500)])
    assert sorted(r["x"] for r in rng.erroneous_data.collect()) == [-0.01, 500.01]
    ln = Q.validate(df, [R.length_between("s", 1, 3)])
    assert sorted(r["s"] for r in ln.erroneous_data.collect()) == ["", "abcd"]
    blank = Q.validate(df, [R.not_blank("s")])
    assert sorted(repr(r["s"]) for r in blank.erroneous_data.collect()) == ["''", "None"]


def test_not_a_number_text(spark):
    df = spark.createDataFrame([("12",), ("1.5",), ("x1",), ("",), (None,)], "v string")
    as_int = Q.validate(df, [R.castable("v", "INT")])
    assert sorted(r["v"] for r in as_int.erroneous_data.collect()) == ["", "1.5", "x1"]
    as_dec = Q.validate(df, [R.castable("v", "DECIMAL(10,2)")])
    assert sorted(r["v"] for r in as_dec.erroneous_data.collect()) == ["", "x1"]

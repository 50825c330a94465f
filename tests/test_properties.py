"""Invariants of the validator on random small frames:
good + bad = input as a multiset; quarantine ⊆ bad; summary counts = brute
force counts per rule; the fail-job gate counts rows whose action has it."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corral.functions import rules as R
from corral.operators import quality as Q

ACTIONS = st.sampled_from(["quarantine", "failjob", "quarantine,failjob", "report", None])
ROW = st.tuples(
    st.one_of(st.none(), st.integers(0, 5)),
    st.one_of(st.none(), st.floats(-10, 10, allow_nan=False)),
    st.one_of(st.none(), st.sampled_from(["a", "b", " ", "", "zz"])),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, max_size=25), a1=ACTIONS, a2=ACTIONS, a3=ACTIONS, a4=ACTIONS)
def test_split_invariants(spark, rows, a1, a2, a3, a4):
    df = spark.createDataFrame(rows, "k int, x double, s string")
    rules = [
        R.in_range("x", -5, 5, action=a1),
        R.not_blank("s", action=a2),
        R.unique("k", action=a3),
        R.in_set("s", ["a", "b"], action=a4),
    ]
    v = Q.validate(df, rules)
    good = [tuple(r) for r in v.correct_data.collect()]
    bad = [tuple(r) for r in v.erroneous_data.collect()]
    assert sorted(good + [b[:3] for b in bad], key=repr) == sorted(rows, key=repr)

    # brute force per rule
    from collections import Counter

    kc = Counter(k for k, _, _ in rows)

    def viol(r):
        k, x, s = r
        return [
            x is not None and not (-5 <= x <= 5),
            s is None or s.strip() == "",
            kc[k] > 1,
            s is not None and s not in ("a", "b"),
        ]

    expected = [sum(viol(r)[i] for r in rows) for i in range(4)]
    got = [r["Impacted_Records"] for r in v.summary.collect()]
    assert got == expected
    blocking = [a != "report" for a in (a1, a2, a3, a4)]
    assert len(bad) == sum(any(f and b for f, b in zip(viol(r), blocking)) for r in rows)
    q = Q.quarantine_rows(v.erroneous_data).count()
    assert q == sum(1 for b in bad if b[3] and "quarantine" in b[3])
    fj = Q.failjob_gate(v.erroneous_data).first()["fail_job_count"]
    assert fj == sum(1 for b in bad if b[3] and "failjob" in b[3])
    # counts from rule flags agree with matching the action text
    c = v.counts().first()
    assert (c["source_count"], c["target_count"], c["quarantined_count"], c["fail_job_count"]) == (
        len(rows), len(good), q, fj)

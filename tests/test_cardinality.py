"""Invariants of the mapping classes on random mappings."""

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from idtrail.operators import cardinality as K

EDGE = st.tuples(
    st.sampled_from(["a", "b", "c", "d", "Entry Withdrawn", None]),
    st.sampled_from(["s", "t", "u", "v", "a", "b", None]),
)


def expected(edges):
    whole = [e for e in edges if None not in e]
    fan_in = Counter(p for p, _ in whole if p != "Entry Withdrawn")
    fan_out = Counter(s for _, s in whole)

    def label(p, s):
        if p == "Entry Withdrawn":
            return "1:0"
        if p is None or s is None:
            return None
        return f"{'n' if fan_in[p] > 1 else '1'}:{'n' if fan_out[s] > 1 else '1'}"

    return Counter((p, s, label(p, s)) for p, s in edges)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(EDGE, min_size=1, max_size=25))
def test_classes_follow_their_definition(spark, edges):
    df = spark.createDataFrame(edges, "primaryID string, secondaryID string")
    want = expected(edges)
    for parts in (1, 5):
        out = K.with_cardinality(df.repartition(parts))
        assert Counter(map(tuple, out.select("primaryID", "secondaryID", K.CLASS).collect())) == want
    out = K.describe_mappings(df)
    assert Counter(map(tuple, out.select("primaryID", "secondaryID", K.CLASS).collect())) == want
    for r in out.collect():
        assert (r[K.PREDICATE] is None) == (r[K.CLASS] is None) == (r["comment"] is None)

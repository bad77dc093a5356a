"""Tables compared by bucketed digests: every kind of difference, and none between equal tables."""

from tidemark.operators import digests

SCHEMA = "k long, v string, w double, extra int"


def test_every_kind_of_difference(spark):
    rows = [(k, f"v{k}", float(k), 1) for k in range(300)] + [(None, "n", None, 1), (7, "twice", 1.0, 1), (7, "twice", 1.0, 1)]
    left = spark.createDataFrame(rows, SCHEMA)
    other = [r for r in rows if r[0] not in (5, 6)] + [(1000, "new", None, 1), (9, "v9", 9.0, 1)]
    other = [(k, "x" if k == 11 else v, None if k == 12 else w, 2) for k, v, w, _ in other]
    other.remove((7, "twice", 1.0, 2))
    right = spark.createDataFrame(other, SCHEMA)
    got = {r.k: (r.kind, r.n_left, r.n_right) for r in digests.differences(left, right, ["k"], ["v", "w"], 16).collect()}
    assert got == {5: ("only_left", 1, 0), 6: ("only_left", 1, 0), 7: ("repeated", 3, 2), 9: ("repeated", 1, 2), 11: ("changed", 1, 1), 12: ("changed", 1, 1), 1000: ("only_right", 0, 1)}
    assert digests.differing_buckets(left, right, ["k"], ["v", "w"], 100_000).count() == 7
    assert digests.differences(left, left.repartition(5, "v"), ["k"], ["v", "w"]).count() == 0
    assert digests.differing_buckets(left, left.orderBy("w"), ["k"], ["v", "w"]).count() == 0
    assert digests.differences(left.limit(0), left.limit(0), ["k"], ["v"]).count() == 0
    assert digests.differences(left, left.limit(0), ["k"], ["v"]).where("kind = 'only_left'").count() == 301
    root = lambda df: digests.table_digest(digests.bucket_digests(df, ["k"], ["v", "w"])).first()
    assert root(left) == root(left.repartition(3)) != root(right) and root(left.limit(0)).n == 0

"""As-of joins in buckets of time against a plain search."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from cellweave.operators import resample

START = datetime(2026, 1, 1)


def plain(left, right, direction, age):
    out = []
    for k, t, x in left:
        own = [(u, v) for j, u, v in right if j == k and k is not None and t is not None and u is not None and v is not None]
        before = max((r for r in own if r[0] <= t), default=None)
        after = min((u for u, _ in own if u >= t), default=None) if own else None
        after = max((r for r in own if r[0] == after), default=None)
        far = lambda r: abs((r[0] - t).total_seconds())
        before, after = (r if r and (age is None or far(r) <= age) else None for r in (before, after))
        near = before if after is None or before is not None and far(before) <= far(after) else after
        r = {"previous": before, "next": after, "nearest": near}[direction]
        out.append((x, r[1] if r else None))
    return sorted(out)


@pytest.mark.parametrize("direction", ["previous", "next", "nearest"])
@pytest.mark.parametrize("age", [None, 500])
@pytest.mark.parametrize("bucket", [60, 3_600, 10**9])
def test_like_a_plain_search(spark, direction, age, bucket):
    rng = random.Random(5)

    def moment():
        return START + timedelta(seconds=rng.randrange(-4_000, 9_000) // 10 * 10)

    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    left = [(key(), moment(), i) for i in range(120)] + [("hot", None, 500), ("none", START, 501)]
    right = [(key(), moment(), rng.random()) for _ in range(60)] + [("hot", START, None), ("hot", None, 1.0), ("a", START, 0.5), ("a", START, 0.7)]
    a = spark.createDataFrame(left, "k string, t timestamp, x int")
    b = spark.createDataFrame(right, "k string, u timestamp, v double")
    out = resample.as_of_by_buckets(a, b, ["k"], "t", "u", "v", bucket, direction, age)
    assert out.columns == ["k", "t", "x", "v"]
    assert sorted((r.x, r.v) for r in out.collect()) == plain(left, right, direction, age)


def test_empty_sides(spark):
    a = spark.createDataFrame([("k", START, 1)], "k string, t timestamp, x int")
    b = spark.createDataFrame([], "k string, u timestamp, v double")
    assert [r.v for r in resample.as_of_by_buckets(a, b, ["k"], "t", "u", "v", 60).collect()] == [None]
    assert resample.as_of_by_buckets(a.where("false"), b, ["k"], "t", "u", "v", 60).count() == 0
    with pytest.raises(ValueError):
        resample.as_of_by_buckets(a, b, ["k"], "t", "u", "v", 60, "sideways")

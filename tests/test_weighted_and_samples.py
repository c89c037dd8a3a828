"""Weighted choice from a table, and samples of large ranges."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from keytally.functions import seeded
from keytally.operators import weighted


@pytest.mark.parametrize("limit", [0, 1 << 17])
def test_choices_follow_the_weights(spark, monkeypatch, limit):
    monkeypatch.setattr(weighted, "MOST_BROADCAST", limit)
    options = {"a": {1: 1, 2: 3, 3: 0}, "b": {i: 1 + 50 * (i == 7) for i in range(20)}, None: {9: 4}, "none": {1: 0, 2: None}}
    weights = spark.createDataFrame([(g, v, w) for g, o in options.items() for v, w in o.items()], "g string, value int, w long")
    rows = spark.range(4000).select("id", F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 8, "b").when(F.col("id") % 10 == 8, "none").alias("g"))
    got = weighted.weighted_choice_from(rows, weights, "g", "value", "w", "v", 1, "s", "id").collect()
    assert sorted(r["id"] for r in got) == list(range(4000))
    for g, o in options.items():
        seen, total = Counter(r["v"] for r in got if r["g"] == g), sum(w or 0 for w in o.values())
        n = sum(seen.values())
        if not total:
            assert set(seen) == {None}
            continue
        for v, w in o.items():
            assert abs(seen[v] - n * w / total) <= 5 * (n * w / total) ** 0.5 + (0 if w else -1 + 1), (g, v)
    assert weighted.weighted_choice_from(rows, weights.limit(0), "g", "value", "w", "v", 1, "s", "id").filter("v is not null").count() == 0


def test_a_choice_is_the_range_its_draw_falls_into(spark):
    weights = spark.createDataFrame([("g", v, w) for v, w in ((1, 5), (2, 1), (3, 1000), (4, 2))], "g string, value int, w long")
    guide, totals = weighted.guide_table(weights, "g", "value", "w")
    rows, total = guide.collect(), totals.first()
    assert len(rows) <= 8
    for at in range(total["total"]):
        found = [r["value"] for r in rows if r["bucket"] == at // total["step"] and r["low"] <= at < r["high"]]
        assert found == [1 if at < 5 else 2 if at < 6 else 3 if at < 1006 else 4]


def test_samples_are_distinct_sorted_and_uniform(spark):
    ids = spark.range(3000).select(seeded.sample_of_range(5, 15, 4, 1, "s", "id").alias("x"))
    seen = Counter()
    for r in ids.collect():
        assert len(set(r["x"])) == 4 and r["x"] == sorted(r["x"]) and 5 <= r["x"][0] and r["x"][-1] < 15
        seen.update(r["x"])
    assert all(abs(n - 1200) < 150 for n in seen.values()) and len(seen) == 10


def test_samples_of_any_amount_and_range(spark):
    amounts = spark.createDataFrame([(0,), (3,), (None,)], "n int")
    got = [r["x"] for r in amounts.select(seeded.sample_of_range(0, 3, F.col("n"), 1, "s", "n").alias("x")).collect()]
    assert got == [[], [0, 1, 2], None]
    x = spark.range(1).select(seeded.sample_of_range(0, 2 ** 52, 50, 1, "s", "id").alias("x")).first()["x"]
    assert len(set(x)) == 50
    with pytest.raises(ValueError):
        seeded.sample_of_range(0, 3, 4, 1, "s", "id")
    with pytest.raises(Exception, match="exceeds"):
        amounts.select(seeded.sample_of_range(0, 2, F.col("n"), 1, "s", "n").alias("x")).collect()

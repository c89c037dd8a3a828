"""Seeded generators: ranges, weights, sample shapes, running sums vs brute force."""

import itertools

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from keytally import fixed_values as fv
from keytally.functions import seeded
from keytally.operators import generate
from keytally.operators.running_sum import running_sum

N = 60_000


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(N).withColumnRenamed("id", "k")


def test_uniform_int_inclusive_bounds(keys):
    row = keys.select(seeded.uniform_int(10, 59, 1, "age", "k").alias("v")) \
        .agg(F.min("v"), F.max("v"), F.count_distinct("v")).first()
    assert tuple(row) == (10, 59, 50)


def test_weighted_choice_frequencies(keys):
    opts = [("search", 20), ("click", 60), ("order", 6), ("pay", 4), ("quit", 10)]
    counts = {r["v"]: r["count"] for r in
              keys.select(seeded.weighted_choice(opts, 7, "action", "k").alias("v")).groupBy("v").count().collect()}
    for value, w in opts:
        expected = N * w / 100
        assert abs(counts[value] - expected) < 5 * (expected ** 0.5) + 1, (value, counts[value], expected)


def test_distinct_sample_shape(keys):
    amount = seeded.uniform_int(1, 5, 3, "n", "k")
    df = keys.select(amount.alias("amount"),
                     seeded.distinct_sample(1, fv.CATEGORY_NUM, amount, 3, "ids", "k").alias("ids"))
    bad = df.filter((F.size("ids") != F.col("amount"))
                    | (F.size(F.array_distinct("ids")) != F.size("ids"))
                    | (F.array_min("ids") < 1) | (F.array_max("ids") > fv.CATEGORY_NUM - 1)
                    | (F.col("ids") != F.array_sort("ids"))).count()
    assert bad == 0
    # every value in [1, 19] appears, 20 never does (exclusive bound)
    values = {r[0] for r in df.select(F.explode("ids")).distinct().collect()}
    assert values == set(range(1, fv.CATEGORY_NUM))


def test_distinct_sample_rejects_impossible_amount(spark):
    with pytest.raises(ValueError):
        seeded.distinct_sample(1, 3, 5, 1, "x", "k")
    df = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(Exception, match="amount exceeds"):
        df.select(seeded.distinct_sample(1, 3, F.col("k") + 1, 1, "x", "k")).collect()


def test_repeat_sample_shape(keys):
    ids = seeded.repeat_sample(1, 20, 4, 3, "rep", "k")
    row = keys.select(ids.alias("ids")).select(F.min(F.size("ids")), F.max(F.size("ids")),
                                                F.min(F.array_min("ids")), F.max(F.array_max("ids"))).first()
    assert tuple(row) == (4, 4, 1, 19)


def test_geometric_length_distribution(keys):
    length = seeded.geometric_length(0.9, 5, "len", "k")
    row = keys.select(length.alias("n")).agg(F.avg("n"), F.avg((F.col("n") == 0).cast("double")),
                                             F.max("n")).first()
    assert abs(row[0] - 9.0) < 0.3
    assert abs(row[1] - 0.1) < 0.01
    assert row[2] <= seeded.max_geometric_length(0.9)


def test_walk_max_step_uses_integer_average():
    assert generate.walk_max_step() == 2 * (86_400_000 // 100_000) == 1728
    with pytest.raises(ValueError):
        generate.walk_max_step(approx_count=10 ** 9)


@pytest.mark.parametrize("range_rows", [1, 4, 7, 1 << 20])
def test_running_sum_matches_brute_force(spark, range_rows):
    # negative and positive keys, ties broken by a second column, uneven blocks
    rows = [(k, t, (k * 7 + t * 3) % 11 - 4) for k, t in itertools.product(range(-23, 41, 3), range(3))]
    df = spark.createDataFrame(rows, "k long, t long, v long")
    got = {(r["k"], r["t"]): r["running"] for r in
           running_sum(df, "v", "k", "running", tie_cols=("t",), range_rows=range_rows).collect()}
    acc, want = 0, {}
    for k, t, v in sorted(rows):
        acc += v
        want[(k, t)] = acc
    assert got == want


def test_event_time_walk_is_monotone(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    walked = generate.event_time_walk(df, "k")
    rows = walked.orderBy("k").select("step_ms", "event_ts").collect()
    start = generate._day_millis(fv.WALK_START_DATE)
    prev = None
    for r in rows:
        assert 0 <= r["step_ms"] < 1728
        if prev is not None:
            assert r["event_ts"] >= prev
        prev = r["event_ts"]
    import datetime as dt
    first = (rows[0]["event_ts"] - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)
    assert first == start + rows[0]["step_ms"]


def test_user_visit_action_columns(spark):
    sessions = spark.range(800).withColumnRenamed("id", "s")
    uva = generate.user_visit_actions(sessions, "s").cache()
    assert uva.columns == ["date", "user_id", "session_id", "page_id", "action_time", "search_keyword",
                           "click_category_id", "click_product_id", "order_category_ids",
                           "order_product_ids", "pay_category_ids", "pay_product_ids", "city_id"]
    # exactly one action kind per row; defaults elsewhere
    kinds = (F.col("search_keyword").isNotNull().cast("int")
             + (F.col("click_category_id") != -1).cast("int")
             + F.col("order_category_ids").isNotNull().cast("int")
             + F.col("pay_category_ids").isNotNull().cast("int"))
    assert uva.filter(kinds != 1).count() == 0
    assert uva.filter(F.col("order_category_ids").isNotNull() != F.col("order_product_ids").isNotNull()).count() == 0
    assert uva.filter((F.col("click_category_id") == -1) != (F.col("click_product_id") == -1)).count() == 0
    row = uva.agg(F.min("page_id"), F.max("page_id"), F.min("city_id"), F.max("city_id"),
                  F.min("user_id"), F.max("user_id")).first()
    assert row[0] >= 1 and row[1] <= fv.PAGE_NUM and row[2] >= 1 and row[3] <= 26
    assert row[4] >= 1 and row[5] <= fv.USER_NUM
    # sessions never overlap in time: per-session spans are disjoint and in session order
    spans = uva.groupBy("session_id").agg(F.min("action_time").alias("lo"), F.max("action_time").alias("hi"))
    ordered = sorted((r["lo"], r["hi"]) for r in spans.collect())
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
    # mean session length ~ 9 actions
    assert 7.5 < uva.count() / spans.count() < 10.5
    uva.unpersist()


def test_user_and_product_tables(spark):
    keys = spark.range(2000).withColumnRenamed("id", "k")
    users = generate.user_info(keys, "k")
    row = users.agg(F.min("user_id"), F.max("user_id"), F.min("age"), F.max("age")).first()
    assert tuple(row) == (1, 2000, fv.AGE_FROM, fv.AGE_TO)
    assert users.filter(F.col("username") != F.concat(F.lit("user_"), F.col("user_id"))).count() == 0
    assert {r[0] for r in users.select("gender").distinct().collect()} == {"男", "女"}
    products = generate.product_info(keys, "k")
    assert {r[0] for r in products.select("extend_info").distinct().collect()} == {"自营", "第三方"}


def test_city_info_literal(spark):
    cities = generate.city_info(spark)
    assert cities.count() == 26
    assert cities.filter(F.col("city_id") == 9).first()["city_name"] == "哈尔滨"


def test_generated_tables_conform_to_declared_schemas(spark):
    """``df.to(schema)`` (the typed ``toDF``): names, order and types as declared."""
    from keytally import schemas
    keys = spark.range(300).withColumnRenamed("id", "k")
    for df, schema in [(generate.user_visit_actions(keys, "k"), schemas.USER_VISIT_ACTION),
                       (generate.user_info(keys, "k"), schemas.USER_INFO),
                       (generate.product_info(keys, "k"), schemas.PRODUCT_INFO),
                       (generate.city_info(spark), schemas.CITY_INFO)]:
        typed = df.to(schema)
        assert [f.name for f in typed.schema] == [f.name for f in schema]
        assert [f.dataType for f in typed.schema] == [f.dataType for f in schema]
        assert typed.count() == df.count()


def test_parse_date_is_midnight(spark):
    from keytally.functions.codecs import format_datetime, ntz_to_millis, parse_date
    row = spark.range(1).select(format_datetime(parse_date(fv.WALK_START_DATE)).alias("s"),
                                ntz_to_millis(parse_date(fv.WALK_START_DATE)).alias("ms")).first()
    assert row["s"] == "2019-11-26 00:00:00"
    assert row["ms"] == generate._day_millis(fv.WALK_START_DATE)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(-10 ** 6, 10 ** 6), st.integers(0, 3), st.integers(-50, 50)),
                min_size=1, max_size=300, unique_by=lambda r: (r[0], r[1])),
       st.sampled_from([3, 16, 1000]))
def test_running_sum_property(spark, rows, range_rows):
    """Random sparse keys with ties, any range size: equals a sequential sum."""
    df = spark.createDataFrame(rows, "k long, t long, v long")
    got = {(r["k"], r["t"]): r["running"] for r in
           running_sum(df, "v", "k", "running", tie_cols=("t",), range_rows=range_rows).collect()}
    acc, want = 0, {}
    for k, t, v in sorted(rows):
        acc += v
        want[(k, t)] = acc
    assert got == want


def test_running_sum_spreads_a_hot_key(spark):
    """One order value holds most rows: they are spread over many ranges."""
    hot = [(7, t, (t * 5) % 9 - 3) for t in range(3000)]
    rest = [(k, t, (k + t) % 7 - 2) for k in range(-40, 60) if k != 7 for t in range(3)]
    df = spark.createDataFrame(hot + rest, "k long, t int, v long")
    out = running_sum(df, "v", "k", "running", tie_cols=("t",), range_rows=200)
    got = {(r["k"], r["t"]): r["running"] for r in out.collect()}
    acc, want = 0, {}
    for k, t, v in sorted(hot + rest):
        acc += v
        want[(k, t)] = acc
    assert got == want


def test_running_sum_with_ties_in_all_order_columns(spark):
    """No tie column: the tied rows get the sums of some order of them, each once."""
    dup = spark.range(5000).select(F.lit(7).cast("long").alias("k"), (F.col("id") % 3).alias("v"), "id")
    got = sorted(r["running"] for r in running_sum(dup, "v", "k", range_rows=500).collect())
    values = [i % 3 for i in range(5000)]
    assert got[-1] == sum(values) and len(got) == 5000 and all(0 <= b - a <= 2 for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("kind,keys", [("double", [2.5, -1.0, None, 0.25, 1e300, None]), ("string", ["b", None, "", "a", "ab", "é"]),
                                       ("date", [None, "2024-01-02", "1999-12-31", "2024-01-01"]),
                                       ("long", [2 ** 62, -(2 ** 62), None, 0, 7])])
@pytest.mark.parametrize("range_rows", [2, 1000])
def test_running_sum_of_any_orderable_key_keeps_nulls(spark, kind, keys, range_rows):
    rows = [(i, None if k is None else str(k), (i * 7) % 5) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "i long, k string, v long").withColumn("k", F.col("k").cast(kind))
    got = running_sum(df, "v", "k", tie_cols=("i",), range_rows=range_rows).collect()
    order = sorted(got, key=lambda r: (r["k"] is not None, r["k"] if r["k"] is not None else 0, r["i"]))
    assert len(got) == len(keys)
    assert [r["running"] for r in order] == list(itertools.accumulate(r["v"] for r in order))


def test_running_sum_of_null_values_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (3, None), (4, 4)], "k long, v long")
    got = [r["running"] for r in running_sum(df, "v", "k", range_rows=1).orderBy("k").collect()]
    assert got == [None, 3, 3, 7]
    assert running_sum(df.limit(0), "v", "k").collect() == []


def test_write_ecommerce_tables(spark, capsys):
    sessions = spark.range(200).withColumnRenamed("id", "s")
    users = spark.range(100).withColumnRenamed("id", "u")
    products = spark.range(100).withColumnRenamed("id", "p")
    counts = generate.write_ecommerce_tables(sessions, "s", users, "u", products, "p", preview_rows=3)
    assert counts["user_info"] == 100 and counts["product_info"] == 100 and counts["city_info"] == 26
    assert counts["user_visit_action"] == generate.user_visit_actions(sessions, "s").count() > 0
    assert spark.table("user_visit_action").columns[0] == "date"
    assert "city_name" in capsys.readouterr().out


def test_generation_is_independent_of_partitioning(spark):
    """Same keys, different partitioning: identical rows. A lost
    partition recomputed anywhere yields what it held before."""
    keys = spark.range(400).withColumnRenamed("id", "s")
    one = keys.coalesce(1)
    many = keys.repartition(7)
    def rows(df):
        return sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())
    a = rows(generate.user_visit_actions(one, "s"))
    b = rows(generate.user_visit_actions(many, "s"))
    assert a == b and len(a) > 0
    walk_small = generate.event_time_walk(many, "s").select("s", "event_ts").collect()
    walk_large = generate.event_time_walk(one, "s").select("s", "event_ts").collect()
    assert sorted(walk_small) == sorted(walk_large)


def _py_draw(seed, salt, *keys):
    import hashlib
    text = "|".join([str(seed), salt, *[str(k) for k in keys]])
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def test_primitives_match_a_pure_python_model(spark):
    """Spark's seeded primitives equal a hashlib model of the same definition."""
    import math
    keys = spark.range(2000).withColumnRenamed("id", "k")
    opts = [("search", 20), ("click", 60), ("order", 6), ("pay", 4)]
    rows = keys.select(
        "k", seeded.draw(42, "x", "k").alias("d"), seeded.uniform_int(10, 59, 42, "age", "k").alias("u"),
        seeded.weighted_choice(opts, 42, "action", "k").alias("w"),
        seeded.uuid_like(42, "session", "k").alias("id"),
        seeded.geometric_length(0.9, 42, "length", "k").alias("g")).collect()
    for r in rows:
        k = r["k"]
        assert r["d"] == _py_draw(42, "x", k)
        assert r["u"] == 10 + _py_draw(42, "age", k) % 50
        pick, bound = _py_draw(42, "action", k) % sum(w for _, w in opts), 0
        for value, weight in opts:
            bound += weight
            if pick < bound:
                assert r["w"] == value
                break
        import hashlib
        h = hashlib.md5(f"42|session|{k}".encode()).hexdigest()
        assert r["id"] == f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}"
        u = _py_draw(42, "length", k) / float(1 << 52)
        assert r["g"] == math.floor(math.log(1.0 - u) / math.log(0.9))

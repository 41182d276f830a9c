"""Heavy keys: detection, salted joins, ordered prefix sums."""

from pyspark.sql import functions as F

from steprisk.operators.prefix import ordered_prefix
from steprisk.operators.skew import HOT, SALT, heavy_keys, skew_left_join, with_hot


def keyed(spark, n):
    """A third of the rows under one key, a tenth without a key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(n).select(F.col("id").alias("event_id"), key.alias("k"), F.lit(1).alias("step"))


def test_heavy_keys_are_found(spark):
    df = keyed(spark, 9_000)
    (found,) = heavy_keys(df, [["k"]], hot_rows=1_000)
    assert list(found.values()) == [3_000]
    assert with_hot(df, ["k"], found).where(HOT).count() == 3_000
    assert with_hot(df, ["k"], {}).where(HOT).count() == 0
    assert heavy_keys(df, [["k"], ["k", "step"]], hot_rows=4_000) == [{}, {}]


def test_every_heavy_key_is_found(spark):
    """Three thousand equally heavy keys, and one below the limit."""
    df = spark.range(30_004).select(F.when(F.col("id") < 30_000, F.col("id") % 3_000).otherwise(-5).alias("k"))
    (found,) = heavy_keys(df, [["k"]], hot_rows=10)
    assert set(found.values()) == {10} and len(found) == 3_000
    marked = with_hot(df, ["k"], found)
    assert marked.where(f"NOT {HOT}").count() == 4
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert " IN (" not in plan and "INSET" not in plan and "Join LeftOuter" in plan


def test_salted_join_equals_plain_join(spark):
    df = keyed(spark, 9_000)
    right = df.where("k IS NOT NULL").groupBy("k").agg(F.max("event_id").alias("last"))
    (found,) = heavy_keys(df, [["k"]], hot_rows=100)
    assert len(found) > 10
    plain = df.join(right, "k", "left")
    for heavy in (found, {}):
        joined = skew_left_join(df, right, ["k"], "event_id", heavy, hot_rows=100).select(*plain.columns)
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
        assert SALT not in joined.columns


def test_heavy_key_is_dealt_over_salts(spark):
    df = keyed(spark, 9_000)
    right = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    (found,) = heavy_keys(df, [["k"]], hot_rows=500)
    plan = skew_left_join(df, right, ["k"], "event_id", found, 500)._jdf.queryExecution().optimizedPlan().toString()
    assert SALT in plan and "Generate explode" in plan


def test_ordered_prefix_is_exact_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5_000).select(
            F.col("id"),
            F.when(F.col("id") % 4 > 0, "big").otherwise("small").alias("g"),
            ((F.col("id") * 7919) % 5_000).alias("place"),
            (F.col("id") % 11).alias("v"),
        )
        got = ordered_prefix(df, [F.col("place")], {"before": "v"}, ["g"], {"top": "v"}).collect()
        rows = sorted((r.g, r.place, r.v) for r in got)
        want, running = {}, {}
        for g, place, v in rows:
            total, top = running.get(g, (0, None))
            want[(g, place)] = (total, top)
            running[g] = (total + v, v if top is None else max(top, v))
        assert {(r.g, r.place): (r.before, r.top) for r in got} == want
        assert len(got) == 5_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ordered_prefix_treats_null_as_a_group(spark):
    df = spark.range(200).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.col("id") % 3).alias("g"), F.lit(1).alias("v"))
    got = ordered_prefix(df, [F.col("id")], {"before": "v"}, ["g"]).where("g IS NULL").orderBy("id").collect()
    assert [r.before for r in got] == list(range(100))


def test_ordered_prefix_descending_without_groups(spark):
    df = spark.range(100).select(F.col("id"), F.lit(2).alias("v"))
    got = ordered_prefix(df, [F.col("id").desc()], {"before": "v"}).collect()
    assert {r.id: r.before for r in got} == {i: 2 * (99 - i) for i in range(100)}

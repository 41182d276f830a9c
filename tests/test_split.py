import pytest
from pyspark.sql import functions as F

from steprisk.operators import ranks, split


def steps(spark, values):
    return spark.createDataFrame([(i, value) for i, value in enumerate(values)], "event_id bigint, step int")


def test_no_overlap(spark):
    train, test, cutoff = split.strict_time_split(steps(spark, [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]), 0.6)
    assert cutoff == 4
    assert train.agg(F.max("step")).first()[0] == 3 and test.agg(F.min("step")).first()[0] == 4


def test_all_rows_are_kept(spark):
    train, test, _ = split.strict_time_split(steps(spark, [1, 1, 2, 2, 3, 3, 4, 4]))
    assert train.count() + test.count() == 8


@pytest.mark.parametrize("fraction", [0.0, 1.0, -0.5, 2])
def test_invalid_fraction(spark, fraction):
    with pytest.raises(ValueError):
        split.strict_time_split(steps(spark, [1, 2, 3]), fraction)


def test_other_errors(spark):
    with pytest.raises(ValueError):
        split.strict_time_split(spark.createDataFrame([(10,), (20,)], "amount int"))
    with pytest.raises(ValueError):
        split.strict_time_split(steps(spark, [1]).limit(0))
    with pytest.raises(ValueError):
        split.strict_time_split(steps(spark, [3, 3, 3, 3]))
    with pytest.raises(ValueError):
        split.strict_time_split(steps(spark, [1, 2]), 0.1)


@pytest.mark.parametrize("fraction", [0.1, 0.37, 0.5, 0.8, 0.95])
def test_cutoff_is_the_sorted_value(spark, tx, fraction):
    ordered = sorted(row.step for row in tx.select("step").collect())
    assert split.cutoff_step(tx, fraction) == ordered[int(len(ordered) * fraction)]


def test_fine_grained_time_column(spark):
    df = spark.range(1_000).select(F.col("id") % 500, (F.col("id") % 500 + 2**40).alias("micros"))
    train, test, cutoff = split.strict_time_split(df, 0.8, "micros")
    assert cutoff == 2**40 + 400 and (train.count(), test.count()) == (800, 200)
    with pytest.raises(ValueError):
        split.strict_time_split(df.withColumn("micros", F.lit(5).cast("bigint")), 0.8, "micros")
    with pytest.raises(ValueError):
        split.strict_time_split(df.limit(0), 0.8, "micros")


@pytest.mark.parametrize("fraction", [0.0, 0.29, 0.5, 0.8, 1.0])
def test_positional_split(spark, fraction):
    df = steps(spark, [1, 2, 2, 2, 2, 2, 2, 3, 3, 4])
    first, rest = split.positional_split(df, fraction)
    n = int(10 * fraction)
    assert sorted(r.event_id for r in first.collect()) == list(range(n))
    assert sorted(r.event_id for r in rest.collect()) == list(range(n, 10))


def test_positional_split_follows_the_row_key_and_loses_nothing(spark):
    df = steps(spark, [5, 1, None, 3, 4, None, 2, 9, None, 8])
    first, rest = split.positional_split(df, 0.6)
    assert sorted(r.event_id for r in first.collect()) == list(range(6))
    assert first.count() + rest.count() == 10


def test_fixed_windows(spark):
    rows = split.fixed_windows(steps(spark, [354, 355, None])).collect()
    assert [(r.step, r.window) for r in rows] == [(354, "reference"), (355, "current")]


@pytest.mark.parametrize("cell_rows", [7, 10**6])
def test_values_at_ranks(spark, monkeypatch, cell_rows):
    """With and without cutting stretches into pieces: the sorted values, for several columns with holes and ties at once."""
    monkeypatch.setattr(ranks, "CELL_ROWS", cell_rows)
    df = spark.range(20_000).select(
        ((F.col("id") * 7919) % 20_011 / 7.0).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise((F.col("id") * 31) % 101).alias("b"),
        F.when(F.col("id") % 5 == 0, float("nan")).when(F.col("id") % 7 > 0, -F.col("id") / 3).alias("c"),
    )
    rows = df.collect()
    values = {
        name: sorted(row[name] for row in rows if row[name] is not None and row[name] == row[name]) for name in "abc"
    }
    wanted = {name: [0, 1, len(found) // 3, len(found) // 2, len(found) - 1] for name, found in values.items()}
    got = ranks.values_at_ranks(df, wanted)
    assert got == {name: {place: values[name][place] for place in places} for name, places in wanted.items()}


def test_ranks_outside_their_sketched_ranges(spark, monkeypatch):
    """Ranges that miss their ranks are widened until they hold them."""
    right, turns = ranks.sketched_ranges, []

    def wrong(found, rows, spots, margin):
        turns.append(margin)
        return [(found[-1], found[-1])] if margin < 1 else right(found, rows, spots, margin)

    monkeypatch.setattr(ranks, "sketched_ranges", wrong)
    df = spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"))
    wanted = {"a": [0, 3, 50], "b": [0, 99]}
    assert ranks.values_at_ranks(df, wanted) == {"a": {0: 0.0, 3: 3.0, 50: 50.0}, "b": {0: 0.0, 99: 198.0}}
    assert set(turns) == set(ranks.MARGINS)


@pytest.mark.parametrize("cell_rows", [3, 10**6])
def test_ranks_of_large_integers_and_wide_doubles(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(ranks, "CELL_ROWS", cell_rows)
    df = spark.range(500).select((F.col("id") + 2**60).alias("k"))
    assert ranks.values_at_ranks(df, {"k": [0, 250, 499]})["k"] == {p: 2**60 + p for p in (0, 250, 499)}
    wide = sorted([-1.7e308, 1.7e308, float("inf"), -0.0, 5e-324, 1e-300, 3.0] + [n / 7 for n in range(20)])
    found = ranks.values_at_ranks(spark.createDataFrame([(v,) for v in wide], "v double"), {"v": range(len(wide))})["v"]
    assert [found[n] for n in range(len(wide))] == wide


def test_few_ranges_are_kept(spark):
    """The reduced table holds a small part of the distinct values, whatever their number."""
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    profile = ranks.long_rows(df, ["v"], []).agg(ranks.grid(F.col("value")).alias("grid")).first()["grid"]
    spots = [(100_000, 100_001)]
    ends = {("v",): ranks.sketched_ranges(profile, 200_000, spots, ranks.MARGINS[0])}
    long = ranks.long_rows(df, ["v"], []).withColumn("rows", F.lit(1))
    chosen = ranks.Selector(long, ["feature"], ends, ["rows"])
    assert chosen.holds(("v",), spots[0]) and chosen.reduced.count() < 4_000
    assert sum(cell.weights[0] for cell in chosen.cells["v",]) == 200_000
    chosen.release()


@pytest.mark.parametrize("kind", ["int", "bigint", "date", "timestamp", "timestamp_ntz", "double"])
def test_cutoff_of_any_time_type(spark, kind):
    """Fine times of every type: the value at the position, in the column's own type."""
    days = "date_add(DATE'1969-12-01', CAST(id % 97 AS INT))"
    made = {
        "int": "CAST(1700000000 + (id * 7919) % 1000 AS INT)", "bigint": "9007199254740993 + (id * 7919) % 1000", "date": days,
        "timestamp": f"CAST({days} AS TIMESTAMP) + make_interval(0, 0, 0, 0, 0, 0, id / 1000)",
        "timestamp_ntz": f"CAST({days} AS TIMESTAMP_NTZ) + make_interval(0, 0, 0, 0, 0, 0, id / 1000)",
        "double": "IF(id % 50 = 0, CAST('NaN' AS DOUBLE), id % 313 / 7)",
    }
    df = spark.range(1_000).select("id", F.expr(made[kind]).alias("at"))
    times = sorted(row["at"] for row in df.collect() if row["at"] == row["at"])
    train, test, cutoff = split.strict_time_split(df, 0.8, "at")
    assert cutoff == times[int(len(times) * 0.8)]
    assert train.count() == sum(time < cutoff for time in times)
    plan = df.where(F.col("at") < cutoff)._jdf.queryExecution().toString()
    assert "Window" not in plan

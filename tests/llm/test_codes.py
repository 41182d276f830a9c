"""Vector codes against plain Lloyd rounds in Python integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from steprisk.llm import codes
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    """Everything in Python integers, one vector at a time."""
    kept = sorted(((i, [math.floor(_exact(x)) for x in v], label) for i, v, label in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // 8
    cut = [[vector[p * size : (p + 1) * size] for _, vector, _ in kept] for p in range(8)]
    books = [[list(part) for part in parts[:16]] for parts in cut]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), n) for n, entry in enumerate(book))

    for _ in range(6):
        for parts, book in zip(cut, books):
            entries = [best(part, book)[1] for part in parts]
            for entry in set(entries):
                mine = [part for part, e in zip(parts, entries) if e == entry]
                book[entry] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [[best(part, book) for part in parts] for parts, book in zip(cut, books)]
    errors = [sum(at[n][0] for at in found) for n in range(len(kept))]
    labels = {}
    for (_, _, label), error in zip(kept, errors):
        labels[label] = labels.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{at[n][1]:02x}" for at in found), errors[n], labels[label], digest) for n, (i, _, label) in enumerate(kept)), key=str
    )


def _exact(value):
    from fractions import Fraction

    return Fraction(value) * 4096


def got(df):
    return sorted((tuple(row) for row in codes.op13_codes(df).collect()), key=str)


def vectors(seed, count, width):
    rng = np.random.default_rng(seed)
    found = np.round(rng.standard_normal((count, width)), 3)
    found[: count // 3] = found[0]  # a third of all vectors are copies
    return [(int(n) * 3, [float(x) for x in v], int(n) % 3 if n % 4 else None) for n, v in enumerate(found)]


@pytest.mark.parametrize(("count", "width", "owner_rows"), [(300, 16, 20), (90, 64, 100_000), (9, 8, 100_000)])
def test_equals_brute_force(spark, monkeypatch, count, width, owner_rows):
    monkeypatch.setattr(codes, "OWNER_ROWS", owner_rows)
    rows = vectors(count, count, width)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_bad_vectors_repeats_and_clashing_columns(spark):
    good = vectors(1, 60, 16)
    good += [good[7], good[7], (good[9][0], good[10][1], 5), (None, good[11][1], 1)]
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 1), (4, [nan] * 16, 1), (7, [1.0, None] + [0.0] * 14, 1), (10, [inf] * 16, 1), (13, [], 1), (16, [1.0] * 8, 1), (19, [1.0] * 15, 1)]
    table = spark.createDataFrame(good + bad, SCHEMA)
    clashing = table.withColumns({name: F.lit("x") for name in ("code", "error", "position", "entry", "salt", "_vector", "_of", "row", "block")})
    assert got(table) == got(clashing) == brute(good)
    assert codes.op13_codes(table.limit(0)).collect() == [] == codes.op13_codes(spark.createDataFrame(bad[:3], SCHEMA)).collect()


def test_wide_values_stay_exact(spark):
    rows = vectors(2, 40, 8)
    rows[3] = (rows[3][0], [2.0**30 + 3] * 8, 1)
    rows[30] = (rows[30][0], [-(2.0**45)] * 8, 1)
    rows[31] = (rows[31][0], [1e300] * 8, 2)
    most = 2**63 - 1
    want = [(*row[:2], row[2] if row[2] <= most else None, *row[3:]) for row in brute(rows)]
    found = got(spark.createDataFrame(rows, SCHEMA))
    assert [(row[0], row[1], row[2], row[4]) for row in found] == [(row[0], row[1], row[2], row[4]) for row in sorted(want, key=str)]


def test_residents_and_arrivals_share_partitions(spark):
    """Joining arrivals to residents makes no new partitions, so residents are not moved."""
    pairs = spark.sparkContext.parallelize([((p, e, 0), np.ones((2, 2))) for p in range(8) for e in range(4)], 3)
    residents = pairs.partitionBy(5, codes.owner_number)
    stayed = residents.mapPartitions(lambda rows: rows, preservesPartitioning=True)
    moved = residents.mapPartitions(lambda rows: (((p, e + 1, s), v) for (p, e, s), v in rows)).partitionBy(5, codes.owner_number)
    both = stayed.union(moved)
    assert both.getNumPartitions() == 5
    for owners in both.map(lambda row: row[0]).glom().collect():
        assert {codes.owner_number(owner) % 5 for owner in owners} <= {codes.owner_number(owners[0]) % 5 if owners else 0}


def test_decoding_gives_the_entries_back(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    kept, width, rows = codes.usable(table)
    books = codes.fit(kept, width, rows)
    coded = codes.encode(kept, width, books)
    errors = {row["vec_id"]: row["error"] for row in coded.collect()}
    whole = {row["vec_id"]: np.floor(np.array(row["embedding"], np.float64) * 4096) for row in table.collect()}
    for row in codes.decode(coded, books).collect():
        assert ((whole[row["vec_id"]] - np.array(row["embedding"]) * 4096) ** 2).sum() == errors[row["vec_id"]]


def test_rounds_lower_the_error(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    kept, width, rows = codes.usable(table)
    total = [codes.encode(kept, width, codes.fit(kept, width, rows, rounds)).agg(F.sum("error")).first()[0] for rounds in (1, 6)]
    assert total[1] < total[0]

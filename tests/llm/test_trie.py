"""The prefix trie against a dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from steprisk.llm import trie
from tests.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuilt=True):
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            held.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    plain = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in held.items()}
    whole = {}
    for conv, turns in plain.items():
        first = zlib.crc32(str(conv).encode()) % 9 if rebuilt else 0
        whole[conv] = tuple(plain.get(conv - conv % 5, [])[:first] + turns[first:])
    members, ends, children = {}, {}, {}
    for conv, turns in whole.items():
        ends.setdefault(turns, []).append(conv)
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[child] for child in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[child] for child in below)
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
                    leaves[node], saved[node], hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def conversations(seed, count, longest):
    """Few texts, so that prefixes repeat; copies, a common first turn, null turns, roles and texts, repeated rows."""
    pick = random.Random(seed)
    rows = []
    for conv in range(count):
        length = 7 if conv % 3 == 0 else pick.randint(1, longest)
        for turn in range(length):
            text = "first" if turn == 0 and conv % 2 else "same" if conv % 3 == 0 else pick.choice(["a", "b", "é", None])
            rows.append((conv * 2 + 3, turn if pick.random() > 0.05 else None, pick.choice(["user", "user", None]) if conv % 3 else "user", text))
    rows += rows[5:9] + [(None, 0, "user", "lost"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("piece", [3, 50, trie.PIECE])
def test_equals_brute_force(spark, piece):
    rows = conversations(1, 150, 9)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(trie.prefix_trie(table, trie.rebuilt_turns, piece)) == brute(rows)


def test_conversations_longer_than_blocks(spark):
    """Copies of a long conversation that branch at, before and after the ends of blocks, and one that holds most rows."""
    trunk = [(turn, "user", f"text {turn}") for turn in range(200)]
    rows = []
    for conv, length in enumerate([200, 200, 16, 17, 15, 32, 33, 48, 1, 100, 16]):
        rows += [(conv, *turn) for turn in trunk[:length]]
        if conv % 2:
            rows += [(conv, 1000 + n, "user", f"own {conv % 4}") for n in range(3)]
    rows += [(900, turn, "user", str(turn % 7)) for turn in range(3000)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert got(trie.prefix_trie(table, trie.plain_turns)) == brute(rows, rebuilt=False)
    assert got(trie.prefix_trie(table, trie.rebuilt_turns, 64)) == brute(rows)


def test_turnless_and_few(spark):
    rows = [(7, 0, "user", "x"), (8, 0, "user", "y"), (12, 0, None, None)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert got(trie.op12_prefix_trie(table)) == brute(rows)
    alone = [(conv, 0, "user", "x") for conv in (1, 2, 3, 4) if zlib.crc32(str(conv).encode()) % 9]
    assert got(trie.op12_prefix_trie(spark.createDataFrame(alone, SCHEMA))) == brute(alone)
    assert trie.op12_prefix_trie(table.limit(0)).collect() == []


def test_clashing_columns(spark):
    rows = conversations(2, 20, 4)
    table = spark.createDataFrame(rows, SCHEMA)
    names = ("depth", "digest", "size", "block", "tags", "one", "head", "x1", "_part", "_last", "one_before", "handed", "parent", "n_convs")
    assert got(trie.op12_prefix_trie(table.withColumns({name: F.lit("x") for name in names}))) == brute(rows)


def test_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(row) for row in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(trie.op12_prefix_trie(table)) == brute(rows)


def test_extents_and_minima_equal_scans():
    rng = np.random.default_rng(4)
    for count in (1, 2, 3, 17, 64):
        lcps = rng.integers(0, 4, count)
        lcps[0] = 0
        rows, depths = np.repeat(np.arange(count), 4), np.tile(np.arange(1, 5), count)
        left, right = trie.extents(lcps, rows, depths)
        for row, depth, low, high in zip(rows, depths, left, right):
            want_low, want_high = row, row
            while want_low > 0 and lcps[want_low] >= depth:
                want_low -= 1
            while want_high + 1 < count and lcps[want_high + 1] >= depth:
                want_high += 1
            assert (low, high) == (want_low, want_high)
        values = rng.integers(0, 1000, count)
        least = trie.least_between(trie.sparse_table(values), left, right)
        assert least.tolist() == [values[a : b + 1].min() for a, b in zip(left, right)]


def test_running_totals_over_many_partitions(spark):
    pick = random.Random(5)
    rows = [(pick.choice([1, 1, 1, 2, 3]), n, pick.randint(-5, 5), pick.getrandbits(60)) for n in range(500)]
    df = spark.createDataFrame(rows, "k long, at long, v long, x long").repartition(7)
    found = {row["at"]: (row["v_before"], row["x_before"]) for row in trie.running(df, "k", [F.col("at")], ["v"], ["x"]).collect()}
    totals = {}
    for key, at, value, mark in rows:
        total, xor = totals.get(key, (0, 0))
        assert found[at] == (total, xor)
        totals[key] = total + value, xor ^ mark


def test_digest_of_a_long_list(spark):
    finals = spark.range(5000).select(F.lit(2).cast("long").alias("depth"), (F.col("id") % 2).alias("x1"), F.lit(-5).cast("long").alias("x2"), (F.col("id") * 37 % 5000).alias("conv_id"))
    want = {odd: hashlib.sha256(",".join(str(n) for n in sorted(i * 37 % 5000 for i in range(5000) if i % 2 == odd)).encode()).hexdigest() for odd in (0, 1)}
    assert {row["x1"]: row["ends_sha256"] for row in trie.ends(finals).collect()} == want

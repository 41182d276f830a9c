"""Near duplicates among many texts of one template, where most pairs are just above or below the limit."""

import random

import numpy as np
import pytest

import corpus_pipeline
from steprisk.llm import minhash, passages

SCHEMA = "doc_id long, text string"


def template(seed, count, changed, length=200):
    pick = random.Random(seed)
    base = [f"w{pick.randrange(10**6)}" for _ in range(length)]
    rows = []
    for number in range(count):
        words = list(base)
        for at in pick.sample(range(length), changed):
            words[at] = f"v{pick.randrange(10**6)}"
        rows.append((number, " ".join(words)))
    return rows


def brute(rows, words, percent=80):
    sets = {}
    for number, text in rows:
        found = text.split()
        sets[number] = {tuple(found[at : at + words]) for at in range(max(1, len(found) - words + 1))}
    parent = {number: number for number in sets}

    def root(number):
        while parent[number] != number:
            number = parent[number]
        return number

    for one in sets:
        for two in sets:
            if two < one:
                both = len(sets[one] & sets[two])
                if 100 * both >= percent * (len(sets[one]) + len(sets[two]) - both):
                    a, b = root(one), root(two)
                    parent[max(a, b)] = min(a, b)
    return {number: root(number) for number in sets}


@pytest.mark.parametrize(("changed", "rows_a_block", "bytes_a_block"), [(5, 4096, 4 << 20), (6, 40, 60_000), (7, 4096, 4 << 20), (7, 40, 60_000), (8, 33, 4 << 20), (9, 4096, 4 << 20)])
def test_templates_equal_brute_force(spark, monkeypatch, changed, rows_a_block, bytes_a_block):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", bytes_a_block)
    rows = template(changed, 200, changed)
    found = minhash.op6_minhash(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {row["doc_id"]: row["component_id"] for row in found} == brute(rows, 2)


def test_two_templates_and_copies(spark):
    rows = template(1, 60, 7) + [(100 + n, text) for n, text in template(2, 60, 3)]
    rows += [(200 + n, rows[5][1]) for n in range(30)] + [(300, rows[70][1] + " tail")]
    found = minhash.op6_minhash(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {row["doc_id"]: row["component_id"] for row in found} == brute(rows, 2)


def test_pipeline_keeps_one_of_each_group(spark, tmp_path):
    rows = template(11, 120, 3)
    docs = spark.createDataFrame([(n, text, "en", "a", 1) for n, text in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()
    groups = brute(rows, 5)
    assert sorted(row["doc_id"] for row in kept) == sorted(set(groups.values()))


def test_least_places_of_matrices():
    rng = np.random.default_rng(2)
    for _ in range(30):
        alike = rng.random((9, 6)) < 0.15
        places = list(range(15))
        for _ in range(15):
            for a, b in zip(*np.nonzero(alike)):
                places[a] = places[9 + b] = min(places[a], places[9 + b])
        assert minhash._together(alike, False).tolist() == places


def test_passages_of_repeated_rows(spark):
    pick = random.Random(8)
    prose = lambda n: " ".join(f"w{pick.randrange(10**6)}" for _ in range(n))
    shared = prose(80)
    rows = [(1, f"{prose(60)} {shared} {prose(40)}"), (2, f"{prose(30)} {shared} {prose(70)}")]
    once = sorted(map(tuple, passages.op7_passages(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    twice = sorted(map(tuple, passages.op7_passages(spark.createDataFrame(rows + rows, SCHEMA)).collect()), key=str)
    assert once and once == twice

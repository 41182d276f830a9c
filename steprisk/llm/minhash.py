"""Near-duplicate documents: universal-hash minima, banding, signature and set verification, connected components.

1. One pass over whole texts: each text's set of distinct shingles (as 64-bit hashes), its size, a 128-bit digest of the
   set, and ``HASHES`` minima under multiply-add hashing. Texts with the same set form a class; only one
   representative per class goes on, so a group of copies of any size is one row from here on.
2. Bands of ``ROWS`` minima are hashed. With ``BANDS`` bands, two sets at the similarity limit of 0.8 share no band
   with probability below 1e-6.
3. In every band bucket each member is paired with the bucket's first member only, under a different order of members in each
   of ``LEADS`` turns: rows grow with the members, not with their square. Pairs whose signatures differ by more than the
   estimate's error allows are dropped, the others are checked on their full sets, and what is linked is merged into components.
4. Exactness: buckets whose members lie in different components are looked at again, member against member. In blocks of
   ``BLOCK_ROWS`` signatures every pair is compared by numpy inside a task; what comes out is not the pairs but who belongs
   together by likely ones: at most one edge per member and block pair. Components of these are families, usually one
   template each. The sets of a family, in blocks of ``BLOCK_BYTES``, are intersected through an inverted list, and again
   only the links that join different components come out. Nothing is capped, and no list of all pairs is ever made.
5. Large-star/small-star components over the links of representatives, carried to all members of their classes.

A pair counts as similar when ``100 * intersection >= percent * union``. Texts of one link may be of any length.

Defined results: a null text, or one without a word, has an empty set and is linked with nothing. A text with fewer
words than a shingle has its whole word sequence as its only shingle. Rows with a null id take no part: component null, kept
true. Rows that repeat an id and a text are members of one class like any other; different texts of one id are one node, linked with
whatever any of them is similar to. Columns other than the id and the text play no
role. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steprisk.llm.common import mixed, written
from steprisk.llm.components import components

ROWS = 5
BANDS = 40
HASHES = ROWS * BANDS
LEADS = 2
# A signature estimates the similarity with a standard error of at most sqrt(0.8 * 0.2 / HASHES) = 0.028 at the limit;
# pairs six standard errors below it are dropped before their sets are read.
SLACK = 6.0
# Blocks of the last stage: signatures of a bucket, shingle hashes of a family. A group is read by one task per pair of blocks.
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
SEED = 23
_BLOCK = 4096
MEMO_WORDS = 100_000

_memo: dict[bytes, int] = {}


# --- sets and signatures --------------------------------------------------------------------------------------------


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word of the text, A-Z lower-cased."""
    memo = _memo
    out = []
    for word in text.encode("utf-8", "surrogatepass").lower().split():
        found = memo.get(word)
        if found is None:
            if len(memo) >= MEMO_WORDS:
                memo.clear()
            found = xxhash.xxh3_64_intdigest(word)
            if len(word) <= 64:
                memo[word] = found
        out.append(found)
    return np.array(out, dtype=np.uint64)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    hashes = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    total = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for place in range(size):
        total = mixed(total + hashes[place : len(hashes) - size + 1 + place])
    return np.unique(total)


_factors = np.random.default_rng(SEED).integers(1, 2**63, size=(2, HASHES), dtype=np.uint64)


def signature(members: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of the high halves of ``a * x + b`` with odd a, block by block."""
    factor, shift = _factors[0] | np.uint64(1), _factors[1]
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    step = max(1, _BLOCK // 16)
    for start in range(0, len(members), step):
        part = members[start : start + step]
        np.minimum(least, (factor[:, None] * part[None, :] + shift[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    rows = minima.astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for place in range(ROWS):
        key = mixed(key + rows[:, place])
    return key.view(np.int64)


def _sketched(words: int):
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                members = shingles(text, words)
                sizes.append(len(members))
                digests.append(xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None)
                signatures.append(signature(members).tobytes() if len(members) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "signature"],
            )

    return sketched


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        keys = np.stack([band_keys(np.frombuffer(s, "<u4")) for s in batch.column(1).to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.repeat(np.arange(len(batch)), BANDS))), pa.array(keys.ravel())],
            names=["node", "band"],
        )


# --- pairs ----------------------------------------------------------------------------------------------------------


def _estimated(percent: int):
    limit = percent / 100
    least = limit - SLACK * (limit * (1 - limit) / HASHES) ** 0.5

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            first, second = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, HASHES) for i in (2, 3)
            )
            alike = (first == second).mean(axis=1) >= least
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(alike))

    return estimated


def _set_rows(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = [shingles(text, words).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(members, pa.binary())], names=["node", "members"])

    return sets


def _confirmed(percent: int):
    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for first, second in zip(batch.column(2), batch.column(3)):
                one, two = (np.frombuffer(x.as_buffer(), np.uint64) for x in (first, second))
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return confirmed


def verified(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that are similar, as ``u``, ``v``: signatures first, full sets after."""
    sizes = sketches.select("node", "n_shingles", "signature")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    signed = (
        pairs.join(sizes.toDF("a", "n_a", "s_a"), "a").join(sizes.toDF("b", "n_b", "s_b"), "b").where(fits)
        .select("a", "b", "s_a", "s_b")
    )
    likely = written(signed.mapInArrow(_estimated(percent), "a long, b long"), "likely-pairs")
    # Sets are made again from the texts of those documents that are in a likely pair, and only once for each.
    wanted = likely.select(F.col("a").alias("node")).unionAll(likely.select(F.col("b").alias("node"))).distinct()
    sets = written(
        texts.join(wanted.hint("merge"), "node", "left_semi").select("node", "text").mapInArrow(_set_rows(words), "node long, members binary"),
        "shingle-sets",
    )
    return (
        likely.join(sets.toDF("a", "m_a"), "a").join(sets.toDF("b", "m_b"), "b").select("a", "b", "m_a", "m_b")
        .mapInArrow(_confirmed(percent), "u long, v long")
    )


def _ordered_pair(first: Column, second: Column) -> list[Column]:
    return [F.least(first, second).alias("a"), F.greatest(first, second).alias("b")]


def similar_links(sketches: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (``u``, ``v``) between representatives whose components are those of all similar pairs.

    ``sketches``: ``node``, ``n_shingles``, ``signature`` per representative; ``texts``: ``node``, ``text``.
    """
    bands = written(
        sketches.select("node", "signature").mapInArrow(_banded, "node long, band long"), "bands"
    )
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("band")
    crowded = written(bands.join(shared, "band"), "shared-bands")

    leads = [F.min_by("node", F.xxhash64("node", F.lit(turn))).alias(f"lead{turn}") for turn in range(LEADS)]
    led = crowded.join(crowded.groupBy("band").agg(*leads), "band")
    pairs = led.select("node", F.explode(F.array(*[f"lead{turn}" for turn in range(LEADS)])).alias("lead"))
    star = pairs.where("node <> lead").select(*_ordered_pair(F.col("node"), F.col("lead"))).distinct()
    star = written(star, "star-pairs")
    links = written(verified(star, sketches, texts, words, percent), "star-links")

    # What may still be missing: links between members of one bucket that lie in different components.
    group = components(links)
    grouped = crowded.join(group.withColumnRenamed("component", "part"), "node", "left").select(
        "node", "band", F.coalesce("part", "node").alias("part")
    )
    open_bands = (
        grouped.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("members"))
        .where("low < high").select("band", "members")
    )
    left = written(grouped.join(open_bands, "band"), "open-bands")
    return links.unionAll(remaining_links(left, sketches, texts, words, percent))


# --- what stars have missed -----------------------------------------------------------------------------------------


def _block_pairs(rows: DataFrame, blocks: Column) -> DataFrame:
    """Every row once per pair (``i``, ``j``) of blocks that its own is part of; ``side`` tells which of the two."""
    own = F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("_blocks"))
    dealt = rows.withColumn("_blocks", blocks.cast("long")).withColumn("_own", own)
    each = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    return each.select(
        *rows.columns, F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
        F.when(F.col("_own") > F.col("_other"), 1).otherwise(0).alias("side"),
    )


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, put together over batches."""
    held, last = [], None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(key).to_numpy(zero_copy_only=False) for key in keys]
        fresh = np.zeros(len(batch), bool)
        for column in columns:
            fresh[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(fresh).tolist()]
        for start, end in zip(starts, [*starts[1:], len(batch)]):
            key = tuple(column[start] for column in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _alike(one: np.ndarray, two: np.ndarray, least: int, parts_one: np.ndarray, parts_two: np.ndarray) -> np.ndarray:
    """Matrix of pairs of different parts whose signatures agree in ``least`` places or more."""
    out = np.empty((len(one), len(two)), bool)
    for row in range(0, len(one), 128):
        for start in range(0, len(two), 128):
            agree = (one[row : row + 128, None, :] == two[None, start : start + 128, :]).sum(axis=2)
            out[row : row + 128, start : start + 128] = agree >= least
    return out & (parts_one[:, None] != parts_two[None, :])


def _together(alike: np.ndarray, same_side: bool) -> np.ndarray:
    """Least reachable place per place, over rows and then columns of the matrix (or rows only, if both are the same)."""
    rows, columns = alike.shape
    one = np.arange(rows)
    two = one if same_side else rows + np.arange(columns)
    none = rows + columns
    while True:
        upper = np.minimum(one, np.where(alike, two[None, :], none).min(axis=1, initial=none))
        lower = np.minimum(two, np.where(alike, upper[:, None], none).min(axis=0, initial=none))
        if same_side:
            upper = lower = np.minimum(upper, lower)
        if (upper == one).all() and (lower == two).all():
            return one if same_side else np.concatenate([one, two])
        one, two = upper, lower


def _families(percent: int):
    limit = percent / 100
    least = int(np.ceil((limit - SLACK * (limit * (1 - limit) / HASHES) ** 0.5) * HASHES))

    def families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["band", "i", "j"]):
            side, nodes, parts = (_column(table, name) for name in ("side", "node", "part"))
            signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u4").reshape(-1, HASHES)
            first = side == 0
            whole = table.column("i")[0].as_py() == table.column("j")[0].as_py()
            other = first if whole else ~first
            order = nodes if whole else np.concatenate([nodes[first], nodes[other]])
            least_place = _together(_alike(signs[first], signs[other], least, parts[first], parts[other]), whole)
            joined = least_place != np.arange(len(least_place))
            if joined.any():
                yield pa.RecordBatch.from_arrays([pa.array(order[joined]), pa.array(order[least_place[joined]])], names=["u", "v"])

    return families


def _new_links(sets: list[np.ndarray], parts: np.ndarray, sides: np.ndarray, whole: bool, percent: int) -> Iterator[tuple[int, int]]:
    """Places of pairs that are similar and join different components, from an inverted list of the sets' members."""
    sizes = np.array([len(members) for members in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, member = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(member, kind="stable")
    holders, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(member))])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    label = np.unique(parts, return_inverse=True)[1]
    for place in range(len(sets)):
        if not whole and sides[place]:
            continue
        mine = member[ends[place] : ends[place + 1]]
        lengths = starts[mine + 1] - starts[mine]
        at = np.repeat(starts[mine] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        both = np.bincount(holders[at], minlength=len(sets))
        similar = (100 * both >= percent * (sizes[place] + sizes - both)) & (label != label[place])
        if not whole:
            similar &= sides == 1
        for other in np.flatnonzero(similar):
            if label[other] != label[place]:
                yield place, int(other)
                label[label == label[other]] = label[place]


def _set_links(percent: int):
    def set_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["family", "i", "j"]):
            sets = [np.frombuffer(members, np.uint64) for members in table.column("members").to_pylist()]
            nodes, parts, sides = (_column(table, name) for name in ("node", "part", "side"))
            whole = table.column("i")[0].as_py() == table.column("j")[0].as_py()
            found = list(_new_links(sets, parts, sides, whole, percent))
            if found:
                one, two = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(nodes[one]), pa.array(nodes[two])], names=["u", "v"])

    return set_links


def remaining_links(left: DataFrame, sketches: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (``u``, ``v``) between members of one bucket in different components, enough of them to join all that belong together.

    ``left``: ``node``, ``band``, ``part`` (component so far), ``members`` (rows of the bucket).
    """
    signed = _block_pairs(left, F.ceil(F.col("members") / BLOCK_ROWS)).join(sketches.select("node", "signature"), "node")
    place = ["band", "i", "j"]
    likely = signed.select(*place, "side", "node", "part", "signature").repartition(*place).sortWithinPartitions(*place)
    family = components(written(likely.mapInArrow(_families(percent), "u long, v long").distinct(), "likely-edges"))
    parts = left.select("node", "part").distinct()
    member = written(family.withColumnRenamed("component", "family").join(parts, "node").join(sketches.select("node", "n_shingles"), "node"), "families")
    sets = written(
        texts.join(member.select("node").distinct().hint("merge"), "node", "left_semi").select("node", "text")
        .mapInArrow(_set_rows(words), "node long, members binary"),
        "family-sets",
    )
    sizes = member.groupBy("family").agg(F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES).alias("blocks"))
    dealt = _block_pairs(member.join(sizes, "family"), F.col("blocks")).join(sets, "node")
    place = ["family", "i", "j"]
    ready = dealt.select(*place, "side", "node", "part", "members").repartition(*place).sortWithinPartitions(*place)
    return ready.mapInArrow(_set_links(percent), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row of ``docs`` (``doc_id``, ``text``)."""
    sketched = written(
        docs.select("doc_id", "text").mapInArrow(
            _sketched(words), "doc_id long, n_shingles long, digest binary, signature binary"
        ),
        "sketches",
    )
    full = sketched.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    classes = written(
        full.groupBy("digest").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature")),
        "classes",
    )
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("node"), "text")
    links = similar_links(classes, texts, words, percent)
    group = components(links)
    # Representatives are the least ids of their classes, so the least representative is the least id reachable.
    named = classes.select("digest", "node").join(group, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id")
    )
    member = full.select("doc_id", "n_shingles", "digest").join(named, "digest").select("doc_id", "n_shingles", "component_id")
    alone = sketched.where(F.col("doc_id").isNull() | F.col("digest").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return member.unionAll(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op6_minhash(docs: DataFrame) -> DataFrame:
    """Two-word shingles, similarity 0.8."""
    return near_duplicates(docs, words=2, percent=80)

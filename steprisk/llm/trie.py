"""Prefix trie of conversations: sorted sequences, their longest common prefixes, and sparse-table range minima.

Every turn of a sequence becomes a 128-bit tag of its depth, role and text. Sequences are cut into segments of ``BLOCK``
turns; a segment is keyed by the XOR of all tags before it, which stands for the prefix that leads to it (two
different prefixes have equal keys with probability 2^-128). Equal segments with equal keys are one row. These rows are
range-partitioned and sorted by (block, key, tags), and each task works off its rows in pieces:

* the longest common prefix (LCP) of neighbouring rows, and a sparse table of range minima over the LCPs;
* a candidate for every prefix at its first row in the piece; each candidate binary-searches the left and the right end of
  the rows that share it, on its own, by steps of falling powers of two through the table;
* sums over the interval from prefix sums, the least member from a second sparse table.

A prefix whose interval touches an end of its piece may go on in the next one: only such pieces of a node, at most ``BLOCK``
on either side of a cut, are added together by a shuffle. So neither a common first turn nor a conversation of any number of turns is
held by one task, and no stack is needed.

Sums over subtrees take a second round over the same segments. Every node belongs to its smallest member. A conversation
carries what belongs to it (childless nodes, saved tokens) on all of its segments, so the sum over a node's members is that over
its subtree, but for the nodes above it that belong to the node's own owner; a running total along the owner takes
these off.

Defined results: rows with a null conv_id take no part. Turns of a conversation are ordered by turn (null first), ties
by role, by the first 32 characters of the text and by digest; equal rows are turns like any others. Null roles and texts are empty.
Conversations without turns after rebuilding are members of the root only. Other columns play no role. An empty table has no
node. Sums beyond a 64-bit integer end the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steprisk.llm.common import written

BLOCK = 16
PIECE = 1 << 16
CHUNK = 512
FAMILY = 5
HANDED = 9
KEY = ["depth", "x1", "x2"]


# --- running totals along a key --------------------------------------------------------------------------------------


def _before(values: np.ndarray, starts: np.ndarray, run: np.ndarray, exclusive: bool) -> np.ndarray:
    """Totals of a run's earlier rows: sums, or XORs if ``exclusive``."""
    if exclusive:
        earlier = np.bitwise_xor.accumulate(values) ^ values
        return earlier ^ earlier[starts][run]
    earlier = np.cumsum(values) - values
    return earlier - earlier[starts][run]


def running(df: DataFrame, key: str, order: Sequence[Column], sums: Sequence[str] = (), xors: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``<name>_before``: the total of column <name> over the rows of the same key before this one.

    Rows are range-partitioned by key and order, so a key of any size is spread. Each task totals its own rows and marks
    its last one. One row per partition goes to the driver, and one offset per partition comes back.
    """
    names = [*sums, *xors]

    def totalled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carried, held = None, {name: np.int64(0) for name in names}, None
        for batch in batches:
            if not len(batch):
                continue
            if held is not None:
                yield held
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
            starts, run = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            totals = []
            for name in names:
                values = batch.column(name).to_numpy(zero_copy_only=False)
                total = _before(values, starts, run, name in xors)
                if last is not None and keys[0] == last:
                    total[run == 0] = total[run == 0] ^ carried[name] if name in xors else total[run == 0] + carried[name]
                carried[name] = total[-1] ^ values[-1] if name in xors else total[-1] + values[-1]
                totals.append(pa.array(total, pa.int64()))
            last = keys[-1]
            held = pa.RecordBatch.from_arrays(
                [*batch.columns, *totals, pa.array(np.full(len(batch), part, np.int32)), pa.array(np.zeros(len(batch), bool))],
                names=[*batch.schema.names, *[f"{name}_before" for name in names], "_part", "_last"],
            )
        if held is not None:
            yield held.set_column(held.num_columns - 1, "_last", pa.array(np.arange(len(held)) == len(held) - 1))

    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)
    added = "".join(f", {name}_before long" for name in names) + ", _part int, _last boolean"
    spread = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    found = written(spread.mapInArrow(totalled, schema + added), "running")

    tails = found.where("_last").select("_part", key, *names, *[f"{name}_before" for name in names]).collect()
    offsets, of, total = [], None, {}
    for tail in sorted(tails, key=lambda row: row["_part"]):
        if of is not None:
            offsets.append((tail["_part"], of, *[int(total[name]) for name in names]))
        own = {name: tail[name] ^ tail[f"{name}_before"] if name in xors else tail[name] + tail[f"{name}_before"] for name in names}
        if tail[key] == of:
            own = {name: own[name] ^ total[name] if name in xors else own[name] + total[name] for name in names}
        of, total = tail[key], own
    carried_over = df.sparkSession.createDataFrame(offsets, f"_part int, `{key}` long" + "".join(f", _o_{name} long" for name in names))
    joined = found.join(F.broadcast(carried_over), ["_part", key], "left")
    zero = F.lit(0).cast("long")
    return joined.withColumns(
        {f"{name}_before": F.col(f"{name}_before") + F.coalesce(f"_o_{name}", zero) for name in sums}
        | {f"{name}_before": F.col(f"{name}_before").bitwiseXOR(F.coalesce(f"_o_{name}", zero)) for name in xors}
    ).select(*df.columns, *[f"{name}_before" for name in names])


# --- member intervals ------------------------------------------------------------------------------------------------


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minimum of every stretch of 2^k values."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def extents(lcps: np.ndarray, rows: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that share the first ``depths`` elements with ``rows``. ``lcps[i]`` belongs to rows i - 1 and i."""
    levels = sparse_table(lcps)
    left, right = rows.copy(), rows.copy()
    for power in range(len(levels) - 1, -1, -1):
        level, step = levels[power], 1 << power
        # To the right: the next 2^power LCPs must all reach the depth.
        start = right + 1
        inside = start + step <= len(lcps)
        fits = inside & (level[np.where(inside, start, 0)] >= depths)
        right = np.where(fits, right + step, right)
        # To the left: the LCPs of the rows left - step + 1 ... left.
        start = left - step + 1
        inside = start >= 1
        fits = inside & (level[np.where(inside, start, 0)] >= depths)
        left = np.where(fits, left - step, left)
    return left, right


def least_between(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minimum over the rows left ... right, from two stretches that may overlap."""
    power = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), levels[0].dtype)
    for each in np.unique(power):
        mine = power == each
        level = levels[each]
        out[mine] = np.minimum(level[left[mine]], level[right[mine] - (1 << each) + 1])
    return out


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists padded to ``width`` values, and their lengths."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out, lengths


def piece_nodes(piece: pa.Table, sums: Sequence[str], least: Sequence[str]) -> pa.Table:
    """The trie nodes of sorted segments: key, parent's key, size of the last turn, totals, and whether the interval is cut."""
    piece = piece.combine_chunks()
    get = lambda name: piece.column(name).chunk(0)
    block, p1, p2 = (get(name).to_numpy(zero_copy_only=False) for name in ("block", "p1", "p2"))
    tags, lengths = _matrix(get("tags"), 2 * BLOCK)
    sizes, _ = _matrix(get("sizes"), BLOCK)
    lengths, count = lengths // 2, len(block)
    one, two = tags[:, 0::2], tags[:, 1::2]

    kin = (block[1:] == block[:-1]) & (p1[1:] == p1[:-1]) & (p2[1:] == p2[:-1])
    alike = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & (np.arange(BLOCK)[None, :] < np.minimum(lengths[1:], lengths[:-1])[:, None])
    lcps = np.concatenate([[0], np.where(kin, np.logical_and.accumulate(alike, axis=1).sum(axis=1), 0)])

    # One candidate for every prefix, at the first row that has it: depths above the LCP with the row before.
    each = lengths - lcps
    rows = np.repeat(np.arange(count), each)
    depths = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + lcps[rows] + 1
    left, right = extents(lcps, rows, depths)

    keys1, keys2 = (np.bitwise_xor.accumulate(np.concatenate([p[:, None], t], axis=1), axis=1) for p, t in ((p1, one), (p2, two)))
    out = {
        "depth": block[rows] * BLOCK + depths,
        "x1": keys1[rows, depths], "x2": keys2[rows, depths], "q1": keys1[rows, depths - 1], "q2": keys2[rows, depths - 1],
        "size": sizes[rows, depths - 1],
    }
    for name in sums:
        total = np.concatenate([[0], np.cumsum(get(name).to_numpy(zero_copy_only=False))])
        out[name] = total[right + 1] - total[left]
    for name in least:
        out[name] = least_between(sparse_table(get(name).to_numpy(zero_copy_only=False)), left, right)
    out["cut"] = (left == 0) | (right == count - 1)
    return pa.table(out)


def nodes(paths: DataFrame, sums: Sequence[str] = (), least: Sequence[str] = (), piece: int = PIECE) -> DataFrame:
    """One row per prefix of ``paths`` (``block``, ``p1``, ``p2``, ``tags``, ``sizes``; distinct): ``KEY``, the parent's ``q1``
    and ``q2``, ``size``, and the totals over the members."""
    names = ["block", "p1", "p2", "tags", "sizes", *sums, *least]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, piece - rows)
                batch = batch.slice(len(part))
                held.append(part)
                rows += len(part)
                if rows == piece:
                    yield from piece_nodes(pa.Table.from_batches(held), sums, least).to_batches(max_chunksize=PIECE)
                    held, rows = [], 0
        if rows:
            yield from piece_nodes(pa.Table.from_batches(held), sums, least).to_batches(max_chunksize=PIECE)

    place = ["block", "p1", "p2", "tags"]
    spread = paths.select(*names).repartitionByRange(*place).sortWithinPartitions(*place)
    schema = "depth long, x1 long, x2 long, q1 long, q2 long, size long" + "".join(f", {name} long" for name in (*sums, *least))
    pieces = written(spread.mapInArrow(found, schema + ", cut boolean"), "trie-pieces")
    cut = pieces.where("cut").groupBy(*KEY).agg(
        *[F.min(name).alias(name) for name in ("q1", "q2", "size")],
        *[F.sum(name).alias(name) for name in sums],
        *[F.min(name).alias(name) for name in least],
    )
    return pieces.where("not cut").drop("cut").unionByName(cut)


# --- rebuilt conversations -------------------------------------------------------------------------------------------


def plain_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id``) and their turns (``conv_id``, ``depth`` from 1, ``digest``, ``size``) as they are."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.left(text, F.lit(32)).alias("head"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"), F.lit(1).cast("long").alias("one"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest")]
    numbered = running(turns, "conv_id", order, sums=["one"])
    turns = numbered.select("conv_id", (F.col("one_before") + 1).alias("depth"), "digest", "size")
    return turns.groupBy("conv_id").agg(F.max("depth").alias("turns")), turns


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``plain_turns``, each conversation c beginning with the first turns of conversation c - c % 5."""
    known, turns = plain_turns(conversations)
    handed = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HANDED).alias("handed")
    donor = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("donor")
    counts = written(known, "conversations")
    convs = counts.select("conv_id", handed, donor).join(counts.select(F.col("conv_id").alias("donor"), "turns"), "donor", "left")
    convs = convs.withColumn("got", F.least("handed", F.coalesce("turns", F.lit(0).cast("long"))))
    own = turns.withColumn("handed", handed).where("depth > handed").join(convs.select("conv_id", "got"), "conv_id").select(
        "conv_id", (F.col("depth") - F.col("handed") + F.col("got")).alias("depth"), "digest", "size"
    )
    given = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("depth") < HANDED)).withColumnRenamed("conv_id", "donor")
    taken = given.join(convs.select("conv_id", "donor", "handed"), "donor").where("depth <= handed").select(
        "conv_id", "depth", "digest", "size"
    )
    return counts.select("conv_id"), own.unionAll(taken)


def segments(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``block``, the key of the prefix before it (``p1``, ``p2``), ``x1`` and ``x2`` of its own tags, ``tags``, ``sizes``."""
    tagged = turns.select(
        "conv_id", F.expr(f"(depth - 1) div {BLOCK}").alias("block"), "depth",
        F.xxhash64("depth", "digest").alias("t1"), F.xxhash64("digest", "depth").alias("t2"), "size",
    )
    cut = tagged.groupBy("conv_id", "block").agg(
        F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"),
        F.sort_array(F.collect_list(F.struct("depth", "t1", "t2", "size"))).alias("at"),
    )
    flat = cut.select(
        "conv_id", "block", "x1", "x2",
        F.flatten(F.transform("at", lambda turn: F.array(turn["t1"], turn["t2"]))).alias("tags"),
        F.transform("at", lambda turn: turn["size"]).alias("sizes"),
    )
    return running(flat, "conv_id", [F.col("block")], xors=["x1", "x2"]).withColumnsRenamed({"x1_before": "p1", "x2_before": "p2"})


# --- digests of member lists -----------------------------------------------------------------------------------------


def _groups(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[tuple[tuple, int, int]]:
    """Runs of rows with equal ``names``: key, first row, row after the last."""
    columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
    fresh = np.zeros(len(batch), bool)
    fresh[0] = True
    for column in columns:
        fresh[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(fresh)
    for start, end in zip(starts, [*starts[1:], len(batch)]):
        yield tuple(int(column[start]) for column in columns), int(start), int(end)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids into comma-joined stretches of at most ``CHUNK``."""
    for batch in batches:
        if not len(batch):
            continue
        ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
        out = [
            (*key, int(ids[at]), ",".join(map(str, ids[at : min(at + CHUNK, end)].tolist())))
            for key, start, end in _groups(batch, KEY)
            for at in range(start, end, CHUNK)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*out)], names=[*KEY, "first", "listed"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the stretches of a key, one after the other: a list of any length needs the memory of one batch."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(pa.array([part], pa.int64()) for part in key), pa.array([digest.hexdigest()])], names=[*KEY, "ends_sha256"]
        )

    for batch in batches:
        if not len(batch):
            continue
        done = []
        for now, start, end in _groups(batch, KEY):
            if now != key:
                if key is not None:
                    done.append(row())
                key, digest = now, None
            for listed in batch.column("listed").slice(start, end - start).to_pylist():
                if digest is None:
                    digest = hashlib.sha256(listed.encode())
                else:
                    digest.update(f",{listed}".encode())
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
    if key is not None:
        yield row()


def ends(finals: DataFrame) -> DataFrame:
    """``KEY`` and ``ends_sha256``: digest of the ascending ids of the conversations (``conv_id``) that end at a node.

    The ids of a node are sorted and joined by many tasks; only the digest itself, which is one chain by definition,
    runs over the joined stretches in one task per node.
    """
    spread = finals.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    listed = spread.mapInArrow(_listed, "depth long, x1 long, x2 long, first long, listed string")
    return listed.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(
        _digested, "depth long, x1 long, x2 long, ends_sha256 string"
    )


# --- trie ------------------------------------------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, sequences: Callable[[DataFrame], tuple[DataFrame, DataFrame]] = plain_turns, piece: int = PIECE) -> DataFrame:
    """One row per distinct prefix of the conversations that ``sequences`` makes of the table."""
    spark = conversations.sparkSession
    known, turns = sequences(conversations)
    cut = segments(turns)
    total = known.agg(F.count(F.lit(1)).alias("convs"), F.min("conv_id").alias("least")).first()
    path = ["block", "p1", "p2", "tags"]
    paths = cut.groupBy(*path).agg(F.min("sizes").alias("sizes"), F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    found = nodes(paths, sums=["n_convs"], least=["conv_id"], piece=piece)

    above = (F.col("depth") - 1).alias("depth")
    children = found.groupBy(above, F.col("q1").alias("x1"), F.col("q2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("q1"), F.col("x2").alias("q2"), F.col("conv_id").alias("parent"))
    none = F.lit(0).cast("long")
    # The root, parent of all first turns, is no row of ``found``: its least member is a constant.
    first, deeper = found.where("depth = 1"), found.where("depth > 1")
    tree = first.withColumn("parent_conv_id", F.lit(total["least"])).unionByName(
        deeper.join(parents, ["depth", "q1", "q2"]).withColumnRenamed("parent", "parent_conv_id")
    ).join(children, KEY, "left").select(
        *KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", none).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saves"),
    )
    tree = running(tree, "conv_id", [F.col("depth")], sums=["saves"])

    owned = written(
        tree.groupBy("conv_id").agg(F.count_if(F.col("n_children") == 0).alias("n_leaves"), F.sum("saves").alias("saved")), "trie-owners"
    )
    weighed = cut.join(owned, "conv_id").groupBy(*path).agg(
        F.min("sizes").alias("sizes"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")
    )
    below = nodes(weighed, sums=["n_leaves", "saved"], piece=piece).select(*KEY, "n_leaves", "saved")

    last = cut.groupBy("conv_id").agg(
        F.max_by(F.struct((F.col("block") * BLOCK + F.size("sizes")).alias("depth"), F.col("p1").bitwiseXOR(F.col("x1")).alias("x1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("x2")), "block").alias("at")
    )
    finals = known.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(f"at.{name}", none).alias(name) for name in KEY])
    lists = written(ends(finals), "trie-ends")

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    rows = tree.join(below, KEY, "left").join(lists, KEY, "left").withColumns(
        {"saved_tokens": F.col("saved") - F.col("saves_before"), "ends_sha256": F.coalesce("ends_sha256", empty)}
    )
    if not total["convs"]:
        return rows.select(*columns)
    whole = owned.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")).first()
    begun = children.where("depth = 0").first()
    listed = lists.where("depth = 0").first()
    root = (
        total["least"], 0, None, total["convs"], begun["n_children"] if begun else 0, whole["n_leaves"] or 1, whole["saved"] or 0,
        listed["ends_sha256"] if listed else hashlib.sha256(b"").hexdigest(),
    )
    kinds = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    return rows.select(*columns).unionAll(spark.createDataFrame([root], kinds))


def op12_prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(conversations, rebuilt_turns)

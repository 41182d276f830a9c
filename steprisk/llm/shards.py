"""Training-order materialisation: every sequence gets a global slot, shards hold slots at a fixed stride.

1. Whole texts are tokenized into sequences of ``SEQUENCE`` ids (the last one of a document padded), which are written once, in
   compressed packs of at most ``PACK`` sequences.
2. Sequences get dense numbers: sequences per task of the written table, offsets over those counts, a place within.
3. A keyed Feistel permutation of the smallest even-bit domain that holds all numbers, walked along its cycle until it
   lands inside, turns number into slot: a bijection that needs no shuffle of its own and no state.
4. Slots are dealt to shards of ``SHARD_SLOTS``. The one shuffle moves compressed blobs of sequences to a stated number of
   range partitions, each a run of whole shards; a task lays out one shard at a time and writes it in slot order. A record
   is ``STRIDE`` bytes, so slot ``n`` of a shard starts at byte ``n * STRIDE`` and reading can start, or resume, anywhere.

Records go through Spark's own file writer, which commits whole files only: little-endian 16-bit ids, and the one byte
that writer puts after every record. The stride, not that byte, tells records apart. That writer begins a new file after
``SHARD_SLOTS`` records: file ``part-P-*-cC`` is shard ``P * shards a task + C``, and only the last shard is shorter.

Defined results: a null or empty text is one sequence holding the end id. Equal or null ``doc_id`` rows give sequences of
their own. An empty table gives no shard. Other columns play no role. A vocabulary whose ids do not fit is refused.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from steprisk.llm.common import shared_path, written
from steprisk.llm.tokens import DEFAULT_VOCABULARY, IDS, WordTokenizer, one_by_one

SEQUENCE = 128
END_ID, PAD_ID = 1, 0xFFFF  # no vocabulary id is that high
PACK = 4096
PACKS = 16  # dealt together: 17 MB
CODEC, LEVEL = "zstd", 3
SHARD_SLOTS = 1 << 16  # 17 MB a file, which its reader holds whole
MOST_TASKS = 20_000  # beyond that many shards, a task writes several
KEY = 20_240_607
ROUNDS = 4
RECORD = np.dtype("<u2")
STRIDE = SEQUENCE * RECORD.itemsize + 1
FILE = re.compile(r"part-(\d+)-[^/]*-c(\d+)\.txt$")


# --- the permutation --------------------------------------------------------------------------------------------------


def half_bits(count: int) -> int:
    """Bits of each half of the domain that holds ``count`` numbers."""
    return max(1, -(-max(1, (count - 1).bit_length()) // 2))


def _round(value, half: int, number: int, key: int):
    """Keyed mixing of one half; the same arithmetic on numpy integers and Python ones."""
    mask = (1 << half) - 1
    value = (value * 0x9E3779B1 + (key + number * 0x85EBCA6B) % (1 << 31)) % (1 << 61)
    value = (value ^ (value >> 29)) % (1 << 31) * 0xC2B2AE35 % (1 << 61)
    return (value ^ (value >> 32)) & mask


def permuted(number: int, half: int, key: int = KEY) -> int:
    left, right = number >> half, number & ((1 << half) - 1)
    for turn in range(ROUNDS):
        left, right = right, left ^ _round(right, half, turn, key)
    return left << half | right


def slots(numbers: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """Slots of ``numbers`` among ``count``: permuted, and again as long as the result lies outside."""
    half = half_bits(count)
    out = numbers.astype(object) if half > 30 else numbers.astype(np.int64)
    pending = np.ones(len(out), dtype=bool)
    while pending.any():
        out[pending] = permuted(out[pending], half, key)
        pending = out >= count
    return out.astype(np.int64)


# --- records ----------------------------------------------------------------------------------------------------------


def checked(vocabulary: str) -> str:
    """``vocabulary``, if all its ids fit a record beside the padding."""
    size = WordTokenizer.of(vocabulary).tokenizer.get_vocab_size()
    if size > PAD_ID:
        raise ValueError(f"{vocabulary} has {size} ids; records hold ids below {PAD_ID}")
    return vocabulary


def sequences(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Packs of sequences: ``part`` and ``place`` (task, and number within, of the first one), ``n``, ``pack`` (compressed:
    ``n`` times ``SEQUENCE`` unsigned 16-bit ids)."""
    checked(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, place = WordTokenizer.of(vocabulary), TaskContext.get().partitionId(), 0
        held, waiting = [], 0
        for batch in batches:
            for raw in tokenizer.encode(one_by_one(batch.column(0))):
                size = len(raw) // IDS.itemsize
                rows = np.full(-(-(size + 1) // SEQUENCE) * SEQUENCE, PAD_ID, dtype=RECORD)
                rows[:size], rows[size] = np.frombuffer(raw, IDS), END_ID
                held.append(rows)
                waiting += len(rows) // SEQUENCE
                if waiting >= PACK:
                    yield from _packs(held, part, place)
                    held, place, waiting = [], place + waiting, 0
        yield from _packs(held, part, place)

    return docs.select("text").mapInArrow(cut, "part long, place long, n long, pack binary")


def _packs(held: list[np.ndarray], part: int, place: int) -> Iterator[pa.RecordBatch]:
    codec, records = pa.Codec(CODEC, LEVEL), np.concatenate(held).reshape(-1, SEQUENCE) if held else np.zeros((0, SEQUENCE), RECORD)
    for at in range(0, len(records), PACK):
        rows = records[at : at + PACK]
        pack = codec.compress(rows.tobytes(), asbytes=True)
        yield pa.RecordBatch.from_pydict({"part": [part], "place": [place + at], "n": [len(rows)], "pack": [pack]})


def _unpacked(codec: pa.Codec, blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(codec.decompress(blob, n * SEQUENCE * RECORD.itemsize, asbytes=True), RECORD).reshape(n, SEQUENCE)


def _dealt(count: int, key: int):
    """Packs, ``PACKS`` at a time, to blobs: the sequences that go to one shard, with their slots in it, by slot."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(CODEC, LEVEL)
        for batch in batches:
            packs = list(zip(*(column.to_pylist() for column in batch.columns)))
            for begin in range(0, len(packs), PACKS):
                some = packs[begin : begin + PACKS]
                records = np.concatenate([_unpacked(codec, pack, n) for _, n, pack in some])
                at = slots(np.concatenate([np.arange(first, first + n) for first, n, _ in some]), count, key)
                order = np.argsort(at)
                shard, rows = at[order] // SHARD_SLOTS, {"shard": [], "at": [], "blob": []}
                ends = [*np.flatnonzero(np.diff(shard, prepend=-1)).tolist(), len(at)]
                for i, j in zip(ends, ends[1:]):
                    rows["shard"].append(int(shard[i]))
                    rows["at"].append((at[order[i:j]] % SHARD_SLOTS).astype("<u4").tobytes())
                    rows["blob"].append(codec.compress(records[order[i:j]].tobytes(), asbytes=True))
                yield pa.RecordBatch.from_pydict(rows)

    return dealt


def _laid_out(count: int):
    """Blobs, by shard, to records in slot order, one shard in memory at a time."""

    def records(shard: int, matrix: np.ndarray, filled: int) -> Iterator[pa.RecordBatch]:
        size = min(SHARD_SLOTS, count - shard * SHARD_SLOTS)
        if filled != size:
            raise ValueError(f"shard {shard} has {filled} of {size} sequences")
        width = SEQUENCE * RECORD.itemsize
        for at in range(0, size, PACK):
            rows = np.ascontiguousarray(matrix[at : min(at + PACK, size)])
            offsets = np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32)
            value = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])
            yield pa.RecordBatch.from_arrays([value], names=["record"])

    def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, current, filled = pa.Codec(CODEC), None, 0
        matrix = np.empty((min(SHARD_SLOTS, count), SEQUENCE), dtype=RECORD)
        for batch in batches:
            for shard, raw, blob in zip(*(column.to_pylist() for column in batch.columns)):
                if shard != current:
                    if current is not None:
                        yield from records(current, matrix, filled)
                    current, filled = shard, 0
                at = np.frombuffer(raw, "<u4")
                matrix[at] = _unpacked(codec, blob, len(at))
                filled += len(at)
        if current is not None:
            yield from records(current, matrix, filled)

    return laid_out


def shards_a_task(count: int) -> int:
    return max(1, -(-count // (SHARD_SLOTS * MOST_TASKS)))


def write_shards(docs: DataFrame, path: str, key: int = KEY, vocabulary: str = DEFAULT_VOCABULARY) -> int:
    """Write the shards of ``docs`` below ``path`` and return the number of sequences."""
    made = written(sequences(docs, vocabulary), "sequences", compression="uncompressed")
    # One row per task of the first pass, to number the sequences without gaps.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = made.groupBy("part").agg(F.sum("n").alias("n"))
    offsets = tasks.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    count = tasks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not count:
        return 0
    numbered = made.join(F.broadcast(offsets), "part").select((F.col("first") + F.col("place")).alias("first"), "n", "pack")
    each = shards_a_task(count)
    (
        numbered.mapInArrow(_dealt(count, key), "shard long, at binary, blob binary")
        .repartitionById(-(-count // (SHARD_SLOTS * each)), F.expr(f"int(shard div {each})"))
        .sortWithinPartitions("shard")
        .mapInArrow(_laid_out(count), "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\n")
        .option("maxRecordsPerFile", SHARD_SLOTS)
        .text(path)
    )
    return count


def _records(each: int):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = np.frombuffer(content.as_buffer(), np.uint8)
                if len(raw) % STRIDE:
                    raise ValueError(f"{path} is not a whole number of records")
                part, file = map(int, FILE.search(path).groups())
                shard, stored = part * each + file, raw.reshape(-1, STRIDE)
                for at in range(0, len(stored), PACK):
                    ids = np.ascontiguousarray(stored[at : at + PACK, :-1]).view(RECORD)
                    used = SEQUENCE - (ids != PAD_ID)[:, ::-1].argmax(axis=1)  # every record holds an id
                    wide, width = memoryview(ids.astype(IDS)).cast("B"), SEQUENCE * IDS.itemsize
                    sums = [zlib.crc32(wide[n * width : n * width + size * IDS.itemsize]) for n, size in enumerate(used.tolist())]
                    place = np.arange(at, at + len(ids))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in (shard * SHARD_SLOTS + place, np.full(len(ids), shard), place * STRIDE, used, sums)],
                        names=["slot", "shard", "byte_offset", "length", "ids_crc32"],
                    )

    return records


def op8_training_order(docs: DataFrame) -> DataFrame:
    """Writes the shards of the whole table and reads them back: one row per record, in files of fixed stride."""
    path = shared_path(docs.sparkSession, "shards")
    count = write_shards(docs, path)
    if not count:
        return docs.sparkSession.createDataFrame([], _RECORDS)
    return read_shards(docs.sparkSession, path, shards_a_task(count))


_RECORDS = "slot long, shard long, byte_offset long, length long, ids_crc32 long"


def read_shards(spark: SparkSession, path: str, each: int = 1) -> DataFrame:
    """Per record in training order: ``slot``, ``shard``, ``byte_offset``, ``length``, ``ids_crc32``. ``each``: shards a task wrote."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_records(each), _RECORDS)

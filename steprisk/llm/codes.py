"""Compression of vectors to short codes by member-resident Lloyd rounds (product quantisation).

Every vector is cut into ``PARTS`` equal stretches; each stretch position has a codebook of ``ENTRIES`` entries. A part
lives with the entry it is assigned to: parts are partitioned by (position, entry, salt) and stay in memory there over
the rounds. In a round the owners assign their resident parts to the new codebook; a part that keeps its entry is not moved,
one that changes it goes to its new owner by the round's only shuffle. Then each owner adds up its residents, the salts
of an entry are added together, and the driver divides: at most ``PARTS * ENTRIES`` rows come back.

The salt spreads an entry that holds most parts over as many owners as the table needs: with one salt per
``OWNER_ROWS`` vectors no owner holds more than about that many, however the vectors are distributed. Residents and
arrivals share one partitioner, so that joining them up is narrow. Parts are held as blocks (one integer matrix per owner and
batch), not row by row. The first placement is checkpointed in the shared folder; a lost executor's
partitions are made again from there, by at most ``ROUNDS`` small shuffles.

All arithmetic is on integers and exact: floating point is used only where every intermediate value is a whole number
below 2^53, wider values take 64-bit integers, and beyond these Python's own.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do empty ones, ones whose
length is no multiple of ``PARTS``, and ones of another length than the most frequent length of the rest (the least on ties).
The codebooks start from the least vec_ids, rows that share an id in the order of their components; fewer than
``ENTRIES`` vectors give as many entries as there are vectors. Rows with a null vec_id are coded, but start no
codebook unless no others are left. Repeated rows are coded once each and count as often as they occur. An error beyond a 64-bit integer
is null. Other columns play no role; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steprisk.llm.common import written
from steprisk.session import shared_folder

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
OWNER_ROWS = 100_000
BLOCK = 65_536
_LONG = 2**63 - 1

Owner = tuple[int, int, int]
Codebooks = list[np.ndarray]


# --- integers of any width -----------------------------------------------------------------------------------------------


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the smallest type that holds them; Python integers stay as they are."""
    if values.dtype == object or not values.size:
        return values
    low, high = int(values.min()), int(values.max())
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def quantised(vectors: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of doubles, exact. A power of two scales without rounding unless it leaves the range."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * SCALE)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    shaped = np.empty(vectors.shape, object)
    for place, value in np.ndenumerate(vectors):
        over, under = float(value).as_integer_ratio()
        shaped[place] = over * SCALE // under
    return shaped


def _most(values: np.ndarray) -> int:
    return int(max(abs(int(values.max())), abs(int(values.min())))) if values.size else 0


def distances(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of every part to every entry, exact."""
    # Of the three terms below, none exceeds the width times the square of twice the largest value.
    bound = 4 * max(_most(parts), _most(book), 1) ** 2 * max(parts.shape[1], 1)
    kind = np.float64 if bound < 2**52 else np.int64 if bound < 2**62 else object
    one, two = parts.astype(kind), book.astype(kind)
    return (one * one).sum(axis=1)[:, None] - 2 * (one @ two.T) + (two * two).sum(axis=1)[None, :]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower one) and the squared distance to it."""
    found = distances(parts, book)
    index = np.argmin(found, axis=1)
    return index, found[np.arange(len(parts)), index]


def _total(parts: np.ndarray) -> np.ndarray:
    """Sums by component as Python integers: they cannot overflow when owners are added up."""
    wide = parts.astype(np.int64) if parts.dtype != object and _most(parts) * max(len(parts), 1) < _LONG else parts.astype(object)
    return wide.sum(axis=0).astype(object)


# --- reading -------------------------------------------------------------------------------------------------------------


def _rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of a batch whose lists all have ``width`` values, as doubles."""
    column = batch.column(0)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), width)


def usable(embeddings: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows that take part (``_vector`` as doubles, ``vec_id``, ``label``), their length and number; zeros if there are none."""
    vector = F.col("embedding").cast("array<double>")
    good = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    whole = embeddings.where(good & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0)).select(
        "vec_id", "label", vector.alias("_vector")
    )
    widths = whole.groupBy(F.size("_vector").alias("width")).agg(F.count(F.lit(1)).alias("rows"))
    most = widths.orderBy(F.desc("rows"), "width").first()
    width, rows = (most["width"], most["rows"]) if most else (0, 0)
    return whole.where(F.size("_vector") == width), width, rows


def first_codebooks(vectors: DataFrame, width: int) -> Codebooks:
    """The parts of the ``ENTRIES`` least vec_ids, position by position."""
    least = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "_vector").select("_vector").limit(ENTRIES).collect()
    whole = quantised(np.array([row["_vector"] for row in least], np.float64).reshape(-1, width))
    size = width // PARTS
    return [whole[:, place * size : (place + 1) * size] for place in range(PARTS)]


# --- rounds --------------------------------------------------------------------------------------------------------------


def owner_number(owner: Owner) -> int:
    """Spreads owners over partitions; one function object for all rounds, which makes their partitioners equal."""
    position, entry, salt = owner
    return (salt * PARTS + position) * ENTRIES + entry


def _split(owner_of: tuple[int, int], parts: np.ndarray, entries: np.ndarray) -> Iterator[tuple[Owner, np.ndarray]]:
    """Blocks of parts by their entries, for one position and salt."""
    position, salt = owner_of
    for entry in np.unique(entries):
        yield (position, int(entry), salt), parts[entries == entry]


def _placed(width: int, salts: int, books: Codebooks):
    """Arrow batches of vectors into blocks (position, entry, salt, dtype, bytes); salts go round in each task."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId()
        for batch in batches:
            if not len(batch):
                continue
            whole = quantised(_rows(batch, width))
            dealt = (np.arange(len(batch)) + turn) % salts
            turn += len(batch)
            out: list[list] = [[], [], [], []]
            for position in range(PARTS):
                parts = whole[:, position * width // PARTS : (position + 1) * width // PARTS]
                entries, _ = nearest(parts, books[position])
                for salt in np.unique(dealt):
                    mine = dealt == salt
                    for owner, block in _split((position, int(salt)), parts[mine], entries[mine]):
                        for column, value in zip(out, (*owner, _packed(block))):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(column, pa.int32()) for column in out[:3]), pa.array(out[3], pa.binary())],
                names=["position", "entry", "salt", "block"],
            )

    return placed


def _packed(block: np.ndarray) -> bytes:
    return pickle.dumps(_narrow(np.ascontiguousarray(block)), protocol=pickle.HIGHEST_PROTOCOL)


def _unpacked(data: bytes) -> np.ndarray:
    return pickle.loads(data)


def _joined(blocks: Iterator[tuple[Owner, np.ndarray]]) -> Iterator[tuple[Owner, np.ndarray]]:
    """Small blocks of one owner put together, up to ``BLOCK`` parts."""
    held: dict[Owner, list[np.ndarray]] = {}
    size: dict[Owner, int] = {}
    for owner, block in blocks:
        held.setdefault(owner, []).append(block)
        size[owner] = size.get(owner, 0) + len(block)
        if size[owner] >= BLOCK:
            yield owner, np.concatenate(held.pop(owner))
            size.pop(owner)
    for owner, found in held.items():
        yield owner, np.concatenate(found)


def _reassigned(books):
    def reassigned(blocks: Iterator[tuple[Owner, np.ndarray]]) -> Iterator[tuple[Owner, Owner, np.ndarray]]:
        """(owner until now, owner from now on, parts)."""
        for owner, parts in _joined(blocks):
            entries, _ = nearest(parts, books.value[owner[0]])
            for now, block in _split((owner[0], owner[2]), parts, entries):
                yield owner, now, block

    return reassigned


def _stayed(rows):
    return ((now, block) for before, now, block in rows if before == now)


def _moved(rows):
    return ((now, block) for before, now, block in rows if before != now)


def _sums(blocks: Iterator[tuple[Owner, np.ndarray]]) -> Iterator[tuple[tuple[int, int], tuple[int, np.ndarray]]]:
    """Count and sum of the residents, by position and entry; an owner's salt ends here."""
    found: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
    for (position, entry, _), parts in blocks:
        count, total = found.get((position, entry), (0, 0))
        found[position, entry] = count + len(parts), total + _total(parts)
    return iter(found.items())


def _updated(books: Codebooks, residents) -> Codebooks:
    """Every entry replaced by its members' floored mean; entries without members stay."""
    totals = residents.mapPartitions(_sums).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).collect()
    new = [book.astype(object) for book in books]
    for (position, entry), (count, total) in totals:
        new[position][entry] = [int(value) // count for value in total]
    return [_fitted(book) for book in new]


def _fitted(book: np.ndarray) -> np.ndarray:
    return book.astype(np.int64) if _most(book) <= _LONG else book


def fit(vectors: DataFrame, width: int, rows: int, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks after ``rounds`` rounds over all vectors (``vec_id``, ``_vector``); ``rows`` sets the number of owners."""
    spark = vectors.sparkSession
    shared_folder(spark)
    context = spark.sparkContext
    books = first_codebooks(vectors, width)
    salts = max(1, -(-rows // OWNER_ROWS))
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(PARTS * ENTRIES * salts, 1 + rows * PARTS // OWNER_ROWS))
    schema = "position int, entry int, salt int, block binary"
    placed = vectors.select("_vector").mapInArrow(_placed(width, salts, books), schema)
    residents = (
        placed.rdd.map(lambda row: ((row[0], row[1], row[2]), _unpacked(bytes(row[3]))))
        .partitionBy(spread, owner_number)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    residents.checkpoint()
    held = [residents]
    books = _updated(books, residents)
    for _ in range(rounds - 1):
        shared = context.broadcast(books)
        rows_now = residents.mapPartitions(_reassigned(shared), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        arrivals = rows_now.mapPartitions(_moved).partitionBy(residents.getNumPartitions(), owner_number)
        residents = rows_now.mapPartitions(_stayed, preservesPartitioning=True).union(arrivals)
        books = _updated(books, residents)
        held.append(rows_now)
        # What the next round reads is held; the round before it is not needed any more.
        held.pop(0).unpersist()
    for left in held:
        left.unpersist()
    return books


# --- codes ---------------------------------------------------------------------------------------------------------------


def codebooks_digest(books: Codebooks) -> str:
    """SHA-256 of all components in decimal, by part, entry and position within the part."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def encode(vectors: DataFrame, width: int, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error`` of every vector: one narrow pass."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            whole = quantised(_rows(batch.select(["_vector"]), width))
            codes, errors = np.empty((len(batch), PARTS), np.uint8), 0
            for position, book in enumerate(books):
                entries, off = nearest(whole[:, position * width // PARTS : (position + 1) * width // PARTS], book)
                codes[:, position] = entries
                errors = errors + (off.astype(np.int64) if off.dtype != object else off).astype(object)
            error = [int(value) if value <= _LONG else None for value in errors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([row.tobytes().hex() for row in codes], pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = {field.name: field.dataType.simpleString() for field in vectors.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return vectors.mapInArrow(coded, schema)


def decode(coded: DataFrame, books: Codebooks) -> DataFrame:
    """The approximate vectors (``vec_id``, ``embedding``): the codebook entries of the parts, scaled back."""

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(bytes.fromhex("".join(batch.column(1).to_pylist())), np.uint8).reshape(-1, PARTS)
            whole = np.concatenate([book[codes[:, place]] for place, book in enumerate(books)], axis=1) / SCALE
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(whole.astype(np.float64)), pa.list_(pa.float64()))], names=["vec_id", "embedding"]
            )

    kind = coded.schema["vec_id"].dataType.simpleString()
    return coded.select("vec_id", "code").mapInArrow(restored, f"vec_id {kind}, embedding array<double>")


def op13_codes(embeddings: DataFrame) -> DataFrame:
    """Code, error, error of all vectors with an equal label, and the codebooks' digest."""
    vectors, width, rows = usable(embeddings)
    if not width:
        return embeddings.sparkSession.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        )
    books = fit(vectors, width, rows)
    coded = written(encode(vectors, width, books), "codes")
    # One row per label; Spark broadcasts it if it is small and else splits the rows of a frequent label.
    sums = coded.groupBy(F.col("label").alias("_of")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_of")), "left").select(
        F.col("vec_id").cast("long").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )

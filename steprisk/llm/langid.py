"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting is one pass over the labelled texts: every task adds up a bucket count per language and emits its nonzero
counts, which Spark sums. The smoothed log-probability matrix (buckets x languages) is the only thing that reaches
the driver and the only broadcast; its size is checked against ``MAX_MATRIX_BYTES``. Scoring gathers the matrix rows
of a text's buckets and adds them up, whole texts in slices of ``SLICE`` characters.

Defined results: a null text, or one without a letter, is ``und`` with score 0. With no labelled row at all every
text is ``und``. Equal scores go to the language that comes first by code point. Rows with a null ``lang`` are not
learned from; repeated rows count as often as they occur. Input columns other than those asked for play no role.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"
ORDERS = (1, 2, 3)
BUCKET_BITS = 15
SMOOTHING = 0.5
SLICE = 1 << 20
# Languages a counting task holds at a time before it emits what it has.
HELD_LANGUAGES = 64
# 256 MB: 1,000 languages of 32,768 buckets in double precision.
MAX_MATRIX_BYTES = 256 << 20

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """True at the code points that are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def characters(text: str) -> np.ndarray:
    """Lower-cased code points with every run of non-letters as one space, a space at both ends; empty: no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letter_table()[codes]
    if not letter.any():
        return codes[:0]
    first_gap = ~letter
    first_gap[1:] &= letter[:-1]
    spaced = np.where(letter, codes, np.uint32(32))[letter | first_gap]
    return np.concatenate(([np.uint32(32)], spaced, [np.uint32(32)]))


def buckets(codes: np.ndarray, bits: int = BUCKET_BITS) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams, slice by slice."""
    longest = max(ORDERS)
    for start in range(0, len(codes), SLICE):
        part = codes[start : start + SLICE + longest - 1].astype(np.uint64)
        fresh = min(SLICE, len(codes) - start)
        for order in ORDERS:
            size = min(fresh, len(part) - order + 1)
            if size <= 0:
                continue
            key = np.full(size, order * 0x9E3779B97F4A7C15 % 2**64, dtype=np.uint64)
            for place in range(order):
                key = (key + part[place : place + size]) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
            yield (key >> np.uint64(64 - bits - 8) & np.uint64((1 << bits) - 1)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prior: np.ndarray  # (languages,)
    log_probability: np.ndarray  # (buckets, languages)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        for language, counts in held.items():
            where = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(where), pa.string()), pa.array(where - 1), pa.array(counts[where])],
                names=["lang", "bucket", "n"],
            )
        held.clear()

    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if language not in held:
                if len(held) >= HELD_LANGUAGES:
                    yield from emit()
                held[language] = np.zeros((1 << BUCKET_BITS) + 1, dtype=np.int64)
            counts = held[language]
            counts[0] += 1  # bucket -1: the texts themselves
            for found in buckets(characters(text or "")):
                counts[1:] += np.bincount(found, minlength=1 << BUCKET_BITS)
    yield from emit()


def fit(labelled: DataFrame) -> LanguageModel:
    """Learn from all rows of ``labelled`` (``text``, ``lang``) whose ``lang`` is not null."""
    counts = (
        labelled.where(F.col("lang").isNotNull())
        .select("lang", "text")
        .mapInArrow(_counted, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    # One array per language: a few rows reach the driver, each of at most 2**BUCKET_BITS + 1 pairs.
    rows = counts.groupBy("lang").agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n"))
    size = 0
    found: dict[str, np.ndarray] = {}
    for row in rows.toLocalIterator():
        size += (1 << BUCKET_BITS) * 8
        if size > MAX_MATRIX_BYTES:
            raise ValueError(f"more languages than a matrix of {MAX_MATRIX_BYTES} bytes holds")
        counts_of = np.zeros((1 << BUCKET_BITS) + 1)
        counts_of[np.asarray(row["bucket"]) + 1] = row["n"]
        found[row["lang"]] = counts_of
    languages = tuple(sorted(found))
    if not languages:
        return LanguageModel((), np.zeros(0), np.zeros((1 << BUCKET_BITS, 0)))
    table = np.stack([found[name] for name in languages], axis=1)
    documents, grams = table[0], table[1:] + SMOOTHING
    return LanguageModel(
        languages, np.log(documents / documents.sum()), np.log(grams) - np.log(grams.sum(axis=0, keepdims=True))
    )


def score_text(model: LanguageModel, text: str | None) -> tuple[str, float]:
    """Most probable language and its posterior probability."""
    codes = characters(text) if text else np.zeros(0, np.uint32)
    if not len(codes) or not model.languages:
        return UNDETERMINED, 0.0
    total = model.log_prior.copy()
    for found in buckets(codes):
        total += model.log_probability[found].sum(axis=0)
    best = int(np.argmax(total))
    return model.languages[best], float(1.0 / np.exp(np.minimum(total - total[best], 0.0)).sum())


def predict(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score``, from ``text`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [name for name in keep if name != "text"]
    schema = T.StructType(
        [docs.schema[name] for name in keep]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [score_text(shared.value, text) for text in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.float64())],
                names=schema.names,
            )

    return docs.select(*keep, "text").mapInArrow(scored, schema)


def keep_identified(docs: DataFrame, model: LanguageModel, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose language is determined with at least ``least_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [score_text(shared.value, text) for text in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([p[0] != UNDETERMINED and p[1] >= least_score for p in pairs], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """True for the documents that are never learned from: crc32 of the id as text leaves 1 modulo 3. Null: false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op9_language_id(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row."""
    marked = docs.select("doc_id", held_out().alias("held_out"), "text", "lang")
    model = fit(marked.where(~F.col("held_out")))
    return predict(marked, model, ("doc_id", "held_out"))

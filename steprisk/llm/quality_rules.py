"""Quality rules: counts over words and lines, and tokeniser fertility with rejection bands per language or script.

Two public vocabularies measure every whole text: characters per token (both), the share of tokens that fall back to
bytes, and the entropy of the token distribution relative to its largest possible value (the one with byte fallback).
A text whose measures lie outside the bands of its language is not written like the rest of it: encoded data, symbol
noise, letters in unusual order or in the wrong script, endless repetition.

Bands come from all documents, per language and length class (powers of two of the number of tokens, the last one open), for short
texts spread more than long ones: the quartiles of each measure, widened by ``WIDTH`` interquartile ranges and at least by
``LEAST_WIDTH`` of the median, so that a language whose texts are all alike does not reject small differences. A language
with fewer than ``LEAST_GROUP`` documents in the class is banded over all lengths; one with fewer documents than that altogether cannot
vouch for itself and is held against its script, in the same way, and a script as rare as that against all documents.
Quartiles are sketches: map-side, mergeable, no group in one task.

Base counts: words, code points in words, symbols, repeated lines, words covered by 5-word windows that occur twice.
``base_failed``: fewer than 10 words, or more than a fifth of the words in repeated windows.

Defined results: a null text has no words and fails the base rules. A null language falls back to the script, a text
without letters to the script ``none``. Equal or null ``doc_id`` rows are measured one by one. Other columns play no role.
An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steprisk.llm.common import written
from steprisk.llm.tokens import DEFAULT_VOCABULARY, MEMO_CHARACTERS, Memo, WordTokenizer, vocabulary_path

BYTE_VOCABULARY = "piece_bpe_32k.model"
WIDTH = 3.0
LEAST_WIDTH = 0.05
LEAST_GROUP = 20
# Lowest and highest length class, and the one that stands for all lengths.
CLASSES, ANY = (4, 10), -1
ACCURACY = 2000
WINDOW = 5
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SALTS = 256
LOW_CODES = 0x800
GROUP_CHARACTERS = 1 << 20  # texts whose new words are encoded together
MEMO_WORDS = 200_000
MEASURES = ("chars_per_piece", "chars_per_word_token", "byte_share", "entropy")

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
# First code points of the letter ranges of some scripts, in order (fixed values of the Unicode blocks).
_SCRIPTS = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
)


@functools.cache
def _script_table(end: int) -> np.ndarray:
    """Per code point below ``end``: 1 + the place of its range in ``_SCRIPTS`` for a letter, else 0."""
    table = np.zeros(end, dtype=np.uint8)
    letters = np.fromiter((code for code in range(end) if chr(code).isalpha()), dtype=np.int64)
    starts = np.array([start for start, _ in _SCRIPTS])
    table[letters] = 1 + np.maximum(np.searchsorted(starts, letters, "right") - 1, 0)
    return table


def script(text: str) -> str:
    """The script with the most letters; ``none`` without letters. Whole text; ties go to the earlier range."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(codes) and codes.max() < LOW_CODES:
        counts = np.bincount(codes, minlength=LOW_CODES)
        found = np.bincount(_script_table(LOW_CODES), counts, len(_SCRIPTS) + 1)[1:].astype(np.int64)
    else:
        found = np.bincount(_script_table(0x110000)[codes], minlength=len(_SCRIPTS) + 1)[1:]
    if not found.any():
        return "none"
    counts = Counter()
    for place, n in enumerate(found.tolist()):
        counts[_SCRIPTS[place][1]] += n
    return counts.most_common(1)[0][0]


# --- base counts ------------------------------------------------------------------------------------------------------


def repeat_words(words: list[bytes]) -> int:
    """Words covered by windows of ``WINDOW`` words that occur at least twice in the text."""
    windows = len(words) - WINDOW + 1
    if windows < 2:
        return 0
    ids = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    keys = np.zeros(windows, dtype=np.uint64)
    for place in range(WINDOW):
        keys = keys * FACTOR + ids[place : place + windows]
    ordered = np.sort(keys)
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    order = np.argsort(keys, kind="stable")
    # Equal keys are candidates; the words themselves decide.
    suspects = np.zeros(windows, dtype=bool)
    suspects[order[1:][same]] = True
    suspects[order[:-1][same]] = True
    places = np.flatnonzero(suspects).tolist()
    counts = Counter(tuple(words[at : at + WINDOW]) for at in places)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for at in places:
        if counts[tuple(words[at : at + WINDOW])] > 1:
            covered[at] += 1
            covered[at + WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACE)]
    return len(lines) - len(set(lines))


def base_counts(text: str) -> tuple[int, int, int, int, int, list[bytes]]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, _SPACE))),
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        duplicate_lines(raw),
        repeat_words(words),
        words,
    )


# --- fertility --------------------------------------------------------------------------------------------------------


class PieceTokenizer:
    """Word by word ids of a vocabulary with byte fallback, with a bounded memo."""

    _loaded: dict[str, PieceTokenizer] = {}

    def __init__(self, vocabulary: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(vocabulary))
        size = self.processor.get_piece_size()
        self.is_byte = np.fromiter((self.processor.is_byte(i) for i in range(size)), dtype=bool, count=size)
        self.memo = Memo(None)  # filled by ``encode``

    @classmethod
    def of(cls, vocabulary: str) -> PieceTokenizer:
        if vocabulary not in cls._loaded:
            cls._loaded[vocabulary] = cls(vocabulary)
        return cls._loaded[vocabulary]

    def encode(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Ids of the words of each text. New words of all texts take one call: a call a word costs more than its ids."""
        self.memo.turn(MEMO_WORDS)
        memo, before = self.memo, self.memo.before
        missing = [word for word in set(chain.from_iterable(texts)) if word not in memo]
        memo.update((word, before[word]) for word in missing if word in before)
        new = [word for word in missing if word not in before]
        found = self.processor.encode([word.decode("utf-8", "replace") for word in new], num_threads=1) if new else []
        raw = np.fromiter(chain.from_iterable(found), "<u2").tobytes()
        end = 0
        for word, ids in zip(new, found):
            begin, end = end, end + 2 * len(ids)
            memo[word] = raw[begin:end]
        encoded = [np.frombuffer(b"".join(map(memo.__getitem__, words)), "<u2") for words in texts]
        for word in new:
            if len(word) > MEMO_CHARACTERS:
                del memo[word]
        return encoded


def relative_entropy(ids: np.ndarray) -> float:
    """Entropy of the ids over that of as many different ones; 1 for fewer than two."""
    if len(ids) < 2:
        return 1.0
    ids = np.sort(ids)
    share = np.diff(np.flatnonzero(np.append(ids[1:] != ids[:-1], True)), prepend=-1) / len(ids)
    return float(-(share * np.log2(share)).sum() / np.log2(len(ids)))


def _grouped(texts: list[str | None]) -> Iterator[list[str]]:
    """Runs of texts of about ``GROUP_CHARACTERS`` altogether."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= GROUP_CHARACTERS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces, tokens = PieceTokenizer.of(BYTE_VOCABULARY), WordTokenizer.of(DEFAULT_VOCABULARY)
    for batch in batches:
        rows = []
        texts, languages = (batch.column(i).to_pylist() for i in (1, 2))
        for group in _grouped(texts):
            counted = [base_counts(text) for text in group]
            encoded = pieces.encode([words for *_, words in counted])
            for text, word_ids, ids, (n_words, word_chars, *others, _) in zip(group, tokens.encode(group), encoded, counted):
                n_tokens = len(word_ids) // 4
                language, kind = languages[len(rows)], "script:" + script(text)
                rows.append(
                    (
                        n_words, word_chars, *others, len(ids),
                        "lang:" + language if language is not None else kind, kind,
                        word_chars / len(ids) if len(ids) else None,
                        word_chars / n_tokens if n_tokens else None,
                        float(pieces.is_byte[ids].mean()) if len(ids) else None,
                        relative_entropy(ids),
                    )
                )
        columns = list(zip(*rows)) if rows else [[] for _ in _MEASURED]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, (_, t) in zip(columns, _MEASURED)]],
            names=["doc_id", *[name for name, _ in _MEASURED]],
        )


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MEASURED = (
    *[(name, pa.int64()) for name in (*_COUNTS, "n_pieces")],
    ("kin", pa.string()),
    ("script", pa.string()),
    *[(name, pa.float64()) for name in MEASURES],
)


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``n_pieces``, ``kin`` (language, else script), ``script`` and the four measures of every row."""
    counts = ", ".join(f"{name} long" for name in (*_COUNTS, "n_pieces"))
    measures = ", ".join(f"{name} double" for name in MEASURES)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "lang").mapInArrow(_measured, f"doc_id {kind}, {counts}, kin string, script string, {measures}")


def sized(measured: DataFrame) -> DataFrame:
    """``measured`` with the length class of every row."""
    power = F.floor(F.log2(F.greatest("n_pieces", F.lit(1)))).cast("int")
    return measured.withColumn("size_class", F.least(F.greatest(power, F.lit(CLASSES[0])), F.lit(CLASSES[1])))


def bands(measured: DataFrame, width: float = WIDTH) -> DataFrame:
    """``kin``, ``script``, ``size_class``, the ``level`` and ``level_class`` they are held against and, per measure, the lowest and highest value accepted."""
    own, every = F.col("size_class"), F.lit(ANY)
    kin, related, all_rows = F.col("kin"), F.col("script"), F.lit("all")
    order = [(kin, own), (kin, every), (related, own), (related, every), (all_rows, every)]
    levels = F.array_distinct(F.array(*[F.struct(one.alias("level"), size.alias("level_class")) for one, size in order]))
    rows = sized(measured)
    quartiles = (
        rows.where("n_pieces > 0")
        .withColumn("against", F.explode(levels))
        .groupBy("against")
        .agg(
            F.count(F.lit(1)).alias("members"),
            *[F.percentile_approx(name, [0.25, 0.5, 0.75], ACCURACY).alias(name) for name in MEASURES],
        )
    )

    def limits(name: str) -> list[Column]:
        low, middle, high = (F.col(name)[i] for i in range(3))
        reach = F.greatest((high - low) * width, F.abs(middle) * LEAST_WIDTH)
        return [(low - reach).alias(f"{name}_low"), (high + reach).alias(f"{name}_high")]

    limited = quartiles.select("against", "members", *[limit for name in MEASURES for limit in limits(name)])
    groups = rows.select("kin", "script", "size_class").distinct()
    chosen = (
        groups.select("*", F.posexplode(levels).alias("place", "against"))
        .join(limited, "against")
        .where((F.col("members") >= LEAST_GROUP) | (F.col("against.level") == "all"))
        .groupBy("kin", "script", "size_class")
    )
    names = ["against.level", "against.level_class", *[f"{name}_{side}" for name in MEASURES for side in ("low", "high")]]
    return chosen.agg(F.min_by(F.struct(*names), "place").alias("band")).select("kin", "script", "size_class", "band.*")


def judged(measured: DataFrame) -> DataFrame:
    """``measured`` (a written table) with ``base_failed``, ``fertility_failed`` and ``kept``."""
    few = F.col("n_words") < 10
    repeated = F.col("n_repeat_words") * 100 > F.col("n_words") * 20
    outside = F.lit(False)
    for name in MEASURES:
        outside = outside | ~F.col(name).between(F.col(f"{name}_low"), F.col(f"{name}_high"))
    # A language may hold most rows: its rows of bands are repeated per salt, and its documents are dealt over them.
    salted = bands(measured).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = sized(measured).withColumn("_salt", F.pmod(F.xxhash64("doc_id", "word_chars", "n_pieces"), F.lit(SALTS)).cast("int"))
    return (
        dealt.join(salted, ["kin", "script", "size_class", "_salt"], "left")
        .withColumns({"base_failed": few | repeated, "fertility_failed": F.coalesce(outside, F.lit(False))})
        .withColumn("kept", ~F.col("base_failed") & ~F.col("fertility_failed"))
    )


def op4_quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept``, and the measures of every row."""
    return judged(written(measure(docs), "fertility")).select(
        "doc_id", *_COUNTS, "base_failed", "kept", "kin", "fertility_failed", *MEASURES
    )

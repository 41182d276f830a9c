"""Byte-pair encoding and decoding of whole texts with a public vocabulary.

Encoding: a text is cut into runs (letters, single digits, signs), each run is spelled in the vocabulary's byte alphabet
and merged on its own. The symbols of a run form a doubly linked list; a priority queue holds (merge rank, place of the
left symbol). The least entry is taken; it is stale, and skipped, when its left symbol is gone or the pair now standing
there has another rank. A run of n bytes costs O(n log n) time and O(n) memory, so one endless word is no harm. Runs that
occur again come from a memo of bounded size.

Decoding: the vocabulary strings of the ids, concatenated as the file's decoder says: a file without one joins them with
spaces, a byte-level one turns the alphabet back into bytes.

What is done by the tokenizer file's own parts: normal form, lower case and cutting of words that are not plain Latin
script (plain ones are cut here, by the same rule). Added tokens of the file are found in the raw text first, the
longest at the leftmost place.

Defined results: null and empty texts, and texts of white space only, have no ids and decode to the empty text. Rows
are independent of each other: repeated rows give equal results, a null id stays null, other columns play no role, an
empty table gives an empty result. Texts of any length are encoded whole, in slices that end at white space. A byte
sequence that is not UTF-8 cannot occur in a string column.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from steprisk.llm.tokens import DEFAULT_VOCABULARY, IDS, PLAIN, RUNS, Memo, slices, vocabulary_path

MEMO_RUNS = 1_000_000  # a run that is not there is merged by Python
MEMO_WORDS = 200_000
_PLACE = (1 << 40) - 1


class Merger:
    """Merges of one vocabulary: ``merged(spelled)`` gives the ids of one run."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        self.ids = vocabulary
        self.suffix = suffix
        self.rank: dict[tuple[int, int], int] = {}
        self.result: list[int] = []
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocabulary[left], vocabulary[right]] = rank
            self.result.append(vocabulary[left + right])

    def symbols(self, spelled: str) -> list[int]:
        """Ids of the single signs, the last one with the word's end; signs that the vocabulary lacks fall out."""
        signs = [*spelled[:-1], spelled[-1] + self.suffix] if spelled else []
        return [self.ids[sign] for sign in signs if sign in self.ids]

    def merged(self, spelled: str) -> list[int]:
        ids = self.symbols(spelled)
        count = len(ids)
        if count < 2:
            return ids
        rank, result = self.rank.get, self.result
        before, after = list(range(-1, count - 1)), [*range(1, count), -1]
        queue = [(r << 40) | place for place in range(count - 1) if (r := rank((ids[place], ids[place + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            left, order = entry & _PLACE, entry >> 40
            right = after[left]
            # -2 marks a symbol that was merged into the one on its left.
            if right < 0 or rank((ids[left], ids[right])) != order:
                continue
            ids[left] = result[order]
            follower = after[left] = after[right]
            after[right] = -2
            if follower >= 0:
                before[follower] = left
                if (r := rank((ids[left], ids[follower]))) is not None:
                    heapq.heappush(queue, (r << 40) | left)
            if (previous := before[left]) >= 0 and (r := rank((ids[previous], ids[left]))) is not None:
                heapq.heappush(queue, (r << 40) | previous)
        out, place = [], 0
        while place >= 0:
            out.append(ids[place])
            place = after[place]
        return out


class Codec:
    """``encode(text)`` and ``decode(ids)`` of one vocabulary file."""

    _loaded: dict[str, Codec] = {}

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        path = vocabulary_path(vocabulary)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.parts = Tokenizer.from_file(path)
        self.merger = Merger(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        added = {token["content"]: token["id"] for token in described["added_tokens"]}
        self.added = {content: np.array([number], IDS).tobytes() for content, number in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.strings = [""] * (max([*model["vocab"].values(), *added.values()]) + 1)
        for content, number in [*model["vocab"].items(), *added.items()]:
            self.strings[number] = content
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.alphabet = {byte: 256 + n for n, byte in enumerate(b for b in range(256) if b not in printable)}
        kind = (described.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"{vocabulary} asks for an unknown decoder: {kind}")
        self.as_bytes = kind == "ByteLevel"
        self.sounds = {chr(code): byte for byte, code in self.alphabet.items()} | {chr(byte): byte for byte in printable}
        self.runs, self.words = Memo(self._run), Memo(self._word)

    @classmethod
    def of(cls, vocabulary: str = DEFAULT_VOCABULARY) -> Codec:
        """One per worker process and vocabulary."""
        if vocabulary not in cls._loaded:
            cls._loaded[vocabulary] = cls(vocabulary)
        return cls._loaded[vocabulary]

    # --- encoding -------------------------------------------------------------------------------------------------

    def _run(self, run: str) -> bytes:
        spelled = run if run.isascii() else run.encode().decode("latin-1").translate(self.alphabet)
        return np.array(self.merger.merged(spelled), IDS).tobytes()

    def _word(self, word: str) -> bytes:
        """A word that is not plain: normal form, case and cuts by the file's own parts."""
        whole = self.parts.normalizer.normalize_str(word) if self.parts.normalizer else word
        runs = (spelled for spelled, _ in self.parts.pre_tokenizer.pre_tokenize_str(whole))
        return np.array([number for spelled in runs for number in self.merger.merged(spelled)], IDS).tobytes()

    def _stretch(self, text: str) -> bytes:
        """Ids of a stretch without added tokens."""
        if PLAIN.fullmatch(text):
            return b"".join(map(self.runs.__getitem__, RUNS.findall(text.lower())))
        return b"".join(
            b"".join(map(self.runs.__getitem__, RUNS.findall(word.lower()))) if PLAIN.fullmatch(word) else self.words[word]
            for word in text.replace("\n", " ").split(" ")
        )

    def encode(self, text: str | None) -> np.ndarray:
        found = []
        for part in slices(text or ""):
            for memo, most in ((self.words, MEMO_WORDS), (self.runs, MEMO_RUNS)):
                if len(memo) > most:
                    memo.clear()
            # Every second piece of the split is an added token.
            for place, piece in enumerate(self.cut.split(part) if self.cut else [part]):
                found.append(self.added[piece] if place % 2 else self._stretch(piece))
        return np.frombuffer(b"".join(found), IDS)

    # --- decoding -------------------------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        strings = map(self.strings.__getitem__, ids.tolist())
        if not self.as_bytes:
            return " ".join(strings)
        sounds = self.sounds
        return b"".join(
            bytes(map(sounds.__getitem__, string)) if all(sign in sounds for sign in string) else string.encode()
            for string in strings
        ).decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of every row of ``docs`` (``doc_id``, ``text``)."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(vocabulary)
        for batch in batches:
            ids = [codec.encode(text.as_py()).astype(np.int32) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id`` and ``text`` of every row of ``encoded`` (``doc_id``, ``ids``); null ids give the empty text."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(vocabulary)
        for batch in batches:
            texts = [codec.decode(np.array(ids.as_py() or [], IDS)) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")


def op11_bpe(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Digests of each text's ids and of what they decode to; ids and decoded texts never leave the task."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(vocabulary)
        for batch in batches:
            counts, ids_hashes, text_hashes = [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py())
                counts.append(len(ids))
                ids_hashes.append(hashlib.sha256(ids).hexdigest())
                text_hashes.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hashes, pa.string()), pa.array(text_hashes, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

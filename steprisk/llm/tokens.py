"""Token ids of whole texts from a public tokenizer file, with bounded memos.

The vocabulary drops white space, cuts text into runs of letters, single digits and runs of signs, and merges within a
run only. Words repeat; a memo makes that cheap. A text of plain Latin script is cut here, exactly as the tokenizer cuts
it, and the runs of new words are merged by the tokenizer's own model. In any other text, words that are not plain take the
tokenizer's whole way. A memo with ``MEMO_PLAIN`` plain words and runs, or ``MEMO_WORDS`` others, is put aside and begun anew;
what comes again is taken over, the rest goes at the next turn.
Long texts are worked off in slices that end at a space or line feed.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

DEFAULT_VOCABULARY = "word_bpe_49k.json"
# About 300 bytes an entry, in every Python worker; a run that is not there costs 3 microseconds.
MEMO_PLAIN = 200_000
MEMO_WORDS = 50_000
MEMO_CHARACTERS = 48
SLICE = 1 << 20
# ASCII but the apostrophe, and precomposed Latin letters: lower-casing them is letter by letter, normal forms leave them
# alone, and Python's classes take the same ones for letters. White space is the six ASCII characters.
PLAIN = re.compile(r"[\t-\r -&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*")
RUNS = re.compile(r"[^\W\d_]+|[0-9]|(?:[^\w \t-\r]|_)+")
IDS = np.dtype("<u4")


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Place of a public vocabulary file; the same package is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Memo(dict):
    """Makes and keeps what is missing; what is used again outlives a ``turn``."""

    def __init__(self, make):
        self.make = make
        self.before: dict = {}

    def turn(self, most: int) -> None:
        """With more than ``most`` entries: put them aside, in place of those put aside before."""
        if len(self) > most:
            self.before = dict(self)
            self.clear()

    def __missing__(self, word: str | bytes) -> bytes:
        ids = self.before.get(word) or self.make(word)
        if len(word) <= MEMO_CHARACTERS:
            self[word] = ids
        return ids


class WordTokenizer:
    """``encode(texts)``: the ids of each text as little-endian unsigned 32-bit bytes."""

    _loaded: dict[str, WordTokenizer] = {}

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.model = self.tokenizer.model
        self.words, self.plain = Memo(self._word), Memo(self._plain)
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        signs = iter(range(256, 512))
        self.alphabet = "".join(chr(byte if byte in printable else next(signs)) for byte in range(256))
        self.packed = [struct.Struct(f"<{n}I").pack for n in range(MEMO_CHARACTERS)]

    @classmethod
    def of(cls, vocabulary: str = DEFAULT_VOCABULARY) -> WordTokenizer:
        """One per worker process and vocabulary."""
        if vocabulary not in cls._loaded:
            cls._loaded[vocabulary] = cls(vocabulary)
        return cls._loaded[vocabulary]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _run(self, run: str) -> bytes:
        spelled = run if run.isascii() else codecs.charmap_decode(run.encode(), "strict", self.alphabet)[0]
        ids = [token.id for token in self.model.tokenize(spelled)]
        return self.packed[len(ids)](*ids) if len(ids) < len(self.packed) else struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, word: str) -> bytes:
        if word.isalpha():
            return self._run(word)
        if word[:-1].isalpha():  # what follows the letters is one digit or sign, a run of its own
            return self.plain[word[:-1]] + self.plain[word[-1]]
        runs = RUNS.findall(word)
        return self._run(word) if len(runs) == 1 else b"".join(map(self.plain.__getitem__, runs))

    def _word(self, word: str) -> bytes:
        return np.array(self._ids(word), IDS).tobytes()

    def _encoded(self, part: str) -> bytes:
        if "<|" not in part and PLAIN.fullmatch(part):
            # Of a plain part, split() takes the same six characters for white space as RUNS does.
            return b"".join(map(self.plain.__getitem__, part.lower().split()))
        return b"".join(
            b"".join(map(self.plain.__getitem__, word.lower().split()))
            if "<|" not in word and PLAIN.fullmatch(word)
            else self.words[word]
            for word in part.replace("\n", " ").split(" ")
        )

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids text by text."""
        for text in texts:
            yield b"".join(map(self._checked, slices(text or "")))

    def _checked(self, part: str) -> bytes:
        self.words.turn(MEMO_WORDS)
        self.plain.turn(MEMO_PLAIN)
        return self._encoded(part)


def one_by_one(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, of which only one at a time is a Python string."""
    return (text.as_py() for text in column)


def slices(text: str) -> Iterator[str]:
    """The text in slices of about ``SLICE`` characters that end before a space or a line feed."""
    start = 0
    while len(text) - start > SLICE:
        ends = [end for end in (text.find(sign, start + SLICE) for sign in " \n") if end >= 0]
        if not ends:
            break
        yield text[start : min(ends)]
        start = min(ends)
    yield text[start:]

"""Token ids of whole texts, encoded in Arrow batches on the executors.

The tokenizer is a file of the ``tokenizers`` library whose path is a parameter; every executor must
be able to open it.  Where the tokenizer drops white space and treats it as a border (probed when it
is loaded), each distinct word is encoded once per worker and remembered in a bounded cache, because
encoding is by far the dearest part.  Otherwise every text is encoded as it is.
"""

from __future__ import annotations

import gc
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.batches import CACHES, release_memory

END_ID = 2
CACHE_WORDS = 500_000
BATCH_IDS = 1_000_000

_BLANKS = bytes.maketrans(b"\t\n\r", b"   ")
_FOLDED = _BLANKS.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
_MARK = "\x01"
_NATIVE = array("I", [1]).tobytes() == b"\x01\0\0\0"
# Latin letters that lower-case one to one and are already in composed form.
_LETTERS = "".join(chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]
                   if chr(c) not in "×÷ß")
_SIGNS = b".,;:!?$%&*#)(\"-"  # what a word may end in, probed as well
_PROBES = ["a b", " a  b ", "one\ttwo\nthree\r\nfour", "l'été, ÉTÉ. it's 12 %% x",
           "Mary had\na little lamb."]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers; an array of the machine's own is quicker."""
    if _NATIVE:
        return array("I", ids).tobytes()
    return np.array(ids, "<u4").tobytes()


class _Words(dict):
    """Ids of words as little-endian bytes; keeps the words met of late, in two generations."""

    def __init__(self, encoder: Encoder, most: int):
        super().__init__()
        self.encoder, self.most, self.older = encoder, most, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encoder.word(word)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    def __init__(self, path: str, cache_words: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.by_word = all(self._words_add_up(p) for p in _PROBES)
        self.letters = self._letter_table() if self.by_word else None
        self.plain_ascii = self.letters is not None and all(
            self.letters[chr(c)] == chr(c).lower() for c in [*range(65, 91), *range(97, 123)])
        self.signs = self._border_signs() if self.letters is not None else b""
        self.words = _Words(self, cache_words or CACHE_WORDS)

    def text(self, raw: bytes) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not raw:
            return b""
        if not self.by_word or _MARK_BYTES in raw or b"<|" in raw:
            return self._encode(raw.decode("utf-8", "replace"))
        words = self.words
        # Combining marks (their first bytes are CC and CD) may compose with one case of a letter only.
        fold = self.plain_ascii and b"\xcc" not in raw and b"\xcd" not in raw
        return b"".join([words[w] for w in raw.translate(_FOLDED if fold else _BLANKS).split(b" ")])

    def word(self, word: bytes) -> bytes:
        if not word:
            return b""
        if self.letters is not None:
            if word[-1] in self.signs:
                stem = word.rstrip(self.signs)
                if stem and self._plain(stem) is not None:
                    return self.words[stem] + self.words[word[len(stem):]]
            else:
                plain = self._plain(word)
                if plain is not None:
                    return _packed([t.id for t in self.tokenize(plain)])
        return self._encode(word.decode("utf-8", "replace"))

    def _plain(self, word: bytes) -> str | None:
        """The word as the model gets it, if it consists of letters that need no further look."""
        if self.plain_ascii and word.isalpha():  # of bytes: ASCII letters only
            return word.lower().decode("ascii")
        try:
            return "".join([self.letters[c] for c in word.decode("utf-8")])
        except (KeyError, UnicodeDecodeError):
            return None

    def _encode(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _words_add_up(self, text: str) -> bool:
        parts = b"".join(self._encode(w) for w in text.split())
        return bool(parts) and parts == self._encode(text)

    def _border_signs(self) -> bytes:
        """The signs that, one or more in any order, are pieces of their own behind a word."""
        ends = [stem + a + b for stem in ("wordes", "É") for a in _SIGNS.decode()
                for b in ["", *_SIGNS.decode()]] + ["wordes" + _SIGNS.decode()]
        apart = all(self._encode(w) == self._encode(w.rstrip(_SIGNS.decode()))
                    + self._encode(w[len(w.rstrip(_SIGNS.decode())):]) for w in ends)
        return _SIGNS if apart else b""

    def _letter_table(self) -> dict[str, str] | None:
        """What normalising and pre-tokenising make of each letter, if letters do not interact."""
        t = self.tokenizer
        if t.normalizer is None or t.pre_tokenizer is None:
            return None

        def shaped(text):
            pieces = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))
            return pieces[0][0] if len(pieces) == 1 else None

        table = {c: shaped(c) for c in _LETTERS}
        both = shaped(_LETTERS)
        probes = ["wordes", "Étéçon", _LETTERS]
        if None in table.values() or both != "".join(table.values()):
            return None
        alike = all([x.id for x in t.model.tokenize("".join(table[c] for c in p))]
                    == t.encode(p, add_special_tokens=False).ids for p in probes)
        return table if alike else None


_MARK_BYTES = _MARK.encode()
_encoders: dict[str, Encoder] = {}


def _forget() -> None:
    if _encoders:
        _encoders.clear()
        gc.collect()  # words lie in cycles, which would stay until the collector happens to run


CACHES.append(_forget)


def encoder(path: str, cache_words: int | None = None) -> Encoder:
    """The worker's encoder; workers are reused, so its cache outlives a task."""
    if path not in _encoders or _encoders[path].words.most != (cache_words or CACHE_WORDS):
        _forget()
        _encoders[path] = Encoder(path, cache_words)
        release_memory()  # what reading the file took
    return _encoders[path]


def encoded_texts(column: pa.Array, path: str, end_id: int | None,
                  cache_words: int | None = None) -> Iterator[bytes]:
    """Ids of each text of a binary column, with the end id; a null text has none of its own."""
    encode = encoder(path, cache_words).text
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    for value in column:
        yield encode(value.as_py() or b"") + end


def text_rows(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    return docs.select(*keys, F.col(f"`{text}`").cast("binary").alias("_text"))


def token_counts(docs: DataFrame, tokenizer: str | None = None, keys: tuple[str, ...] = ("doc_id",),
                 end_id: int | None = END_ID, text: str = "text") -> DataFrame:
    """``keys`` and ``n_tokens`` (with the end id) of every row."""
    path = tokenizer or default_tokenizer()
    rows = text_rows(docs, list(keys), text)
    schema = ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys),
                        "n_tokens long"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(x) // 4 for x in encoded_texts(batch.column(len(keys)), path, end_id)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keys))), pa.array(n, pa.int64())],
                [*keys, "n_tokens"])

    return rows.mapInArrow(count, schema)


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)

"""Byte-pair encoding and decoding by batched merge rounds.

A text is normalised (NFC, white space to one space, lower case) and split into
words as the vocabulary file's tokenizer does. The distinct words of a batch stand
as symbols in one flat array. A round looks up every neighbouring pair by binary
search over the sorted pair keys, takes the lowest rank of each word, and merges
all its occurrences; words without a known pair leave. Pieces between white space that were
met before are taken from a bounded cache.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemill.llm.common import append, ragged, schema_with, texts_of

# White space as the tokenizer's pattern engine sees it, and its words.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD = f"'s|'t|'re|'ve|'m|'ll|'d|[\\p{{L}}]+|[\\p{{N}}]|[^{SPACE}\\p{{L}}\\p{{N}}]+"

CACHED_PIECES = 150_000
ENCODED_ROWS = 500
_NO_RANK = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    own = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in own:
            own[b] = chr(256 + len(own) - len(plain))
    return [own[b] for b in range(256)]


class Vocabulary:
    """The tables of one vocabulary file; its size does not grow with the data."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        ids: dict[str, int] = model["model"]["vocab"]
        end = model["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.last = np.array([ids[s + end] for s in symbols], np.int64)
        pairs = [
            ((ids[a] << 32) | ids[b], rank, ids[a + b])
            for rank, (a, b) in enumerate(model["model"]["merges"])
        ]
        pairs.sort()
        self.keys, self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*pairs))


def merge_rounds(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of the words, one after the other, and the number of each word's."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    symbols = vocabulary.inner[data]
    symbols[np.cumsum(sizes) - 1] = vocabulary.last[data[np.cumsum(sizes) - 1]]
    owner = np.repeat(np.arange(len(raw)), sizes)
    rank = np.full(len(symbols), _NO_RANK, np.int64)  # of the pair that starts here
    merged = np.zeros(len(symbols), np.int64)
    stale = np.arange(len(symbols))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        stale = stale[stale < len(symbols) - 1]
        keys = (symbols[stale] << 32) | symbols[stale + 1]
        at = np.minimum(np.searchsorted(vocabulary.keys, keys), len(vocabulary.keys) - 1)
        known = (vocabulary.keys[at] == keys) & (owner[stale] == owner[stale + 1])
        rank[stale] = np.where(known, vocabulary.ranks[at], _NO_RANK)
        merged[stale] = vocabulary.merged[at]
        rank[-1] = _NO_RANK
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lowest = np.minimum.reduceat(rank, first)
        low = np.repeat(lowest, np.diff(np.append(first, len(owner))))
        kept = low != _NO_RANK
        done.append((owner[~kept], symbols[~kept]))
        hit = np.flatnonzero(kept & (rank == low))
        if not len(hit):
            break
        # In a row of overlapping occurrences every other one is merged.
        head = np.r_[True, np.diff(hit) != 1]
        hit = hit[(hit - hit[head][np.cumsum(head) - 1]) % 2 == 0]
        symbols[hit] = merged[hit]
        kept[hit + 1] = False
        place = np.cumsum(kept) - 1
        touched = np.zeros(place[-1] + 1, bool)
        touched[place[hit]] = touched[np.maximum(place[hit] - 1, 0)] = True
        stale = np.flatnonzero(touched)
        symbols, owner, rank, merged = symbols[kept], owner[kept], rank[kept], merged[kept]
    owner = np.concatenate([o for o, _ in done]) if done else np.zeros(0, np.int64)
    symbols = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    return symbols[order].astype(np.int32), np.bincount(owner, minlength=len(raw))


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.word = regex.compile(f"{WORD}|\n")
        self.space = regex.compile(f"[{SPACE}]+")
        marks = "|".join(regex.escape(s) for s in vocabulary.special)
        self.special = regex.compile(f"({marks})") if marks else None
        self.control = regex.compile("[\\x1c-\\x1f]")
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        for token, i in vocabulary.special.items():
            self._add([token], np.array([i], np.int32), np.ones(1, np.int64))

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(sizes) - sizes]
        self.size = np.r_[self.size, sizes]
        self.ids = np.r_[self.ids, ids]

    def words(self, pieces: list[str]) -> tuple[list[str], np.ndarray]:
        """The words of pieces without white space, and the number of each piece's."""
        text = unicodedata.normalize("NFC", "\n".join(pieces))
        # One character at a time: a final sigma is not treated apart.
        found = self.word.findall(text.replace("Σ", "σ").lower())
        breaks = np.flatnonzero(np.fromiter((w == "\n" for w in found), bool, len(found)))
        return [w for w in found if w != "\n"], np.diff(np.r_[-1, breaks, len(found)]) - 1

    def pieces(self, text: str) -> list[str]:
        """No word holds white space, so a text falls into pieces that are met again
        and again; special tokens are pieces of their own."""
        found: list[str] = []
        parts = self.special.split(text) if self.special else [text]
        for i, part in enumerate(parts):
            if i % 2:
                found.append(part)
            elif self.control.search(part):  # str.split() takes these for white space
                found += filter(None, self.space.split(part))
            else:
                found += part.split()
        return found

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each text's."""
        pieces = [self.pieces(t) for t in texts]
        new = list(set().union(*pieces).difference(self.known))
        if new:
            words, number = self.words(new)
            ids, counts = merge_rounds(words, self.vocabulary)
            ends = np.r_[0, np.cumsum(counts)][np.r_[0, np.cumsum(number)]]
            self._add(new, ids, np.diff(ends))
        sizes = np.zeros(len(texts), np.int64)
        known, parts = self.known, []
        for i, own in enumerate(pieces):
            at = np.fromiter(map(known.__getitem__, own), np.int64, len(own))
            parts.append(self.ids[ragged(self.start[at], self.size[at])])
            sizes[i] = len(parts[-1])
        if len(known) > CACHED_PIECES:  # the cache is full: what is new is not kept
            for piece in new:
                del known[piece]
            self.start, self.size = self.start[: len(known)], self.size[: len(known)]
            self.ids = self.ids[: self.start[-1] + self.size[-1]] if len(known) else self.ids[:0]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), sizes


def _joined(tokens: np.ndarray, ids: np.ndarray) -> str:
    return " ".join(tokens[ids[(ids >= 0) & (ids < len(tokens))]].tolist())


def encode_bpe(
    df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``df`` with the token ids of ``text`` as array<int>, and if ``decoded`` names a
    column, with what :func:`decode_bpe` makes of them, in the same Python process.

    Null and empty texts have an empty array. A column already named as ``ids``
    is replaced; all others pass. The vocabulary file is read on the driver and
    broadcast: its size is fixed.
    """
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tokens = Encoder(shared.value), np.array(shared.value.tokens, object)
        for whole in batches:
            for at in range(0, len(whole), ENCODED_ROWS):
                batch = whole.slice(at, ENCODED_ROWS)
                values, sizes = encoder.batch(texts_of(batch.column(text)))
                ends = np.r_[0, np.cumsum(sizes)]
                offsets = pa.array(ends.astype(np.int32))
                new = {ids: pa.ListArray.from_arrays(offsets, pa.array(values))}
                if decoded:
                    texts = [_joined(tokens, values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                    new[decoded] = pa.array(texts, pa.string())
                yield append(batch, **new)

    added = [(ids, T.ArrayType(T.IntegerType()))] + ([(decoded, T.StringType())] if decoded else [])
    return df.mapInArrow(encode, schema_with(df, *added))


def decode_bpe(df: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the tokens of ``ids`` joined by a space, as the tokenizer decodes.

    A null array gives an empty text; null ids and ids outside the vocabulary are
    left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path).tokens)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = np.array(shared.value, object)
        for batch in batches:
            column = batch.column(ids)
            flat = column.flatten().fill_null(-1).to_numpy()
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy())
            texts = [_joined(tokens, flat[low:high]) for low, high in zip(np.r_[0, ends[:-1]], ends)]
            yield append(batch, **{text: pa.array(texts, pa.string())})

    return df.mapInArrow(decode, schema_with(df, (text, T.StringType())))

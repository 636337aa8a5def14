r"""Byte-level BPE: encode texts to token ids and decode ids to bytes.

A text is cut by the vocabulary's pattern and each piece is encoded alone.
A worker encodes every distinct piece once (a bounded memory of pieces
serves the rest): the new pieces of an Arrow batch are sorted into length
buckets, each bucket is a padded matrix of token ids, and in every round
each row merges its leftmost pair of minimum rank.  Ranks of all pairs
come from one hash table in numpy arrays; after a round the rows move
their tail one place to the left (compaction), and finished rows leave
the matrix.

Pieces of more than ``LONG_PIECE`` bytes (a run of ten thousand dashes)
would need as many rounds as bytes; they take the same merges, in the same
order, from a heap over a linked list.

The vocabulary is read on the driver from the path given (under
``MAX_VOCABULARY`` bytes, checked) and broadcast.  No shuffle; memory is
one Arrow batch and the caches.

Defined results: a null text encodes as an empty one, to no ids; null ids
decode to empty bytes; repeated rows and empty tables need no special care;
the table's own columns are untouched.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import bounded_batches

MAX_VOCABULARY = 64 << 20
LONG_PIECE = 512
#: Cells of one padded matrix.
MATRIX_CELLS = 1 << 18
#: Distinct pieces a worker remembers before it starts afresh, and characters of the longest one it does.
PIECE_CACHE, CACHED_CHARS = 120_000, 64

_NONE = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) -> rank of the joined token, by open addressing."""

    def __init__(self, tokens: dict[bytes, int]):
        keys, values = [], []
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        keys_, values_ = np.array(keys, np.uint64), np.array(values, np.int32)
        self.bits = max(4, int(2 * max(1, len(keys))).bit_length() + 1)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        self.probes = 0
        slot, todo = self._slot(keys_), np.arange(len(keys_))
        while len(todo):
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            at, first = np.unique(slot[todo[free]], return_index=True)
            placed = todo[free][first]
            self.keys[at], self.values[at] = keys_[placed], values_[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank for each pair, or the largest int where there is none."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        found = np.where(self.keys[slot] == keys, self.values[slot], _NONE)
        for _ in range(self.probes - 1):
            # a pair not at its slot may stand further on, up to the first free one
            open_ = np.nonzero((found == _NONE) & (self.keys[slot] != np.uint64(2**64 - 1)))
            if not len(open_[0]):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found[open_] = np.where(self.keys[slot[open_]] == keys[open_], self.values[slot[open_]], _NONE)
        return found


#: For patterns by which texts of plain Latin letters can be cut in an
#: equal, faster form: what such a text must not contain, and the form.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_PLAIN_FORMS = {
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""": (
        rf"[^\t\n\r -~{_LATIN}]",
        rf" ?[{_LATIN}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\t\n\r 0-9{_LATIN}]+|\s+(?!\S)|\s+"),
}


def _splitter(pattern: str):
    """Function that cuts a text into the matches of ``pattern``."""
    every = regex.compile(pattern).findall
    if pattern not in _PLAIN_FORMS:
        return every
    other, plain = (re.compile(p) for p in _PLAIN_FORMS[pattern])
    return lambda text: every(text) if other.search(text) else plain.findall(text)


class ByteBPE:
    """Encoder and decoder for one vocabulary of ranks."""

    def __init__(self, tokens: dict[bytes, int], pattern: str):
        self.bytes_of = {rank: token for token, rank in tokens.items()}
        self.first = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(tokens)
        self.whole = tokens
        self.find = _splitter(pattern)
        self.cache: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = [self.find(t) if t else [] for t in texts]
        known = self.cache
        new = {p for found in pieces for p in found if p not in known}
        if len(known) + len(new) > PIECE_CACHE:
            known.clear()
            new = {p for found in pieces for p in found}
        self._learn(list(new))
        out = [b"".join(map(known.__getitem__, found)) for found in pieces]
        for p in new:
            if len(p) > CACHED_CHARS:
                del known[p]
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Put the ids of each new piece into the cache."""
        todo: list[str] = []
        raws: list[bytes] = []
        for piece, raw in zip(pieces, map(str.encode, pieces)):
            rank = self.whole.get(raw)
            if rank is not None:
                self.cache[piece] = rank.to_bytes(4, "little")
            elif len(raw) > LONG_PIECE:
                self.cache[piece] = self._merge_long(raw).astype("<u4").tobytes()
            else:
                todo.append(piece)
                raws.append(raw)
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        order = lengths.argsort(kind="stable")
        lengths, start = lengths[order], 0
        while start < len(order):  # a bucket: lengths within a factor of 1.25
            most = int(lengths[start]) * 5 // 4
            stop = min(int(lengths.searchsorted(most, "right")), start + max(1, MATRIX_CELLS // most))
            at = order[start:stop].tolist()
            ids = self._merge_bucket([raws[i] for i in at])
            self.cache.update(zip([todo[i] for i in at], ids))
            start = stop

    def _merge_bucket(self, raws: list[bytes]) -> list[bytes]:
        """Merge all rows of a padded matrix, each its leftmost minimum-rank pair a round."""
        lengths = np.array([len(r) for r in raws])
        width = int(lengths.max())
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8)
        ids = self.first[flat.reshape(len(raws), width)]
        column = np.arange(width)
        ranks = np.full((len(raws), width), _NONE, np.int32)
        ranks[:, :-1] = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        ranks[column[None, :] >= lengths[:, None] - 1] = _NONE
        out: list[bytes] = [b""] * len(raws)
        at = np.arange(len(raws))
        while len(at):
            where = ranks.argmin(axis=1)  # the first of equal minima: the leftmost
            row = np.arange(len(at))
            best = ranks[row, where]
            done = best == _NONE
            if done.any():
                flat, step = ids[done].astype("<u4").tobytes(), 4 * ids.shape[1]
                for k, (i, n) in enumerate(zip(at[done].tolist(), lengths[done].tolist())):
                    out[i] = flat[k * step:k * step + 4 * n]
                live = ~done
                width = int(lengths[live].max()) if live.any() else 0
                ids, ranks = ids[live, :width], ranks[live, :width]
                at, lengths, where, best = at[live], lengths[live], where[live], best[live]
                row = row[:len(at)]
                if not len(at):
                    break
            # compaction: what stands right of the pair moves one place to the left
            source = np.minimum(np.arange(width)[None, :] + (np.arange(width)[None, :] > where[:, None]), width - 1)
            ids, ranks = np.take_along_axis(ids, source, 1), np.take_along_axis(ranks, source, 1)
            ids[row, where] = best
            lengths = lengths - 1
            ranks[row, where] = _NONE
            for side in (where - 1, where):  # the two pairs that hold the new token
                ok = (side >= 0) & (side + 1 < lengths)
                r, c = row[ok], side[ok]
                ranks[r, c] = self.pairs.ranks(ids[r, c], ids[r, c + 1])
            ranks[row, lengths - 1] = _NONE
        return out

    def _merge_long(self, raw: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of (rank, place) over a linked list."""
        ids = self.first[np.frombuffer(raw, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.pairs.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist() + [int(_NONE)]
        heap = [(r, i) for i, r in enumerate(ranks) if r != _NONE]
        heapq.heapify(heap)
        rank_of, text_of = self.whole, self.bytes_of

        def rank(i: int) -> int:
            j = after[i]
            return int(_NONE) if j >= n else rank_of.get(text_of[ids[i]] + text_of[ids[j]], int(_NONE))

        while heap:
            best, i = heapq.heappop(heap)
            if ranks[i] != best or ids[i] < 0:
                continue  # the pair has changed since
            j = after[i]
            ids[i], ids[j] = best, -1
            ranks[j] = int(_NONE)
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0:
                    ranks[k] = rank(k)
                    if ranks[k] != _NONE:
                        heapq.heappush(heap, (ranks[k], k))
        return np.array([x for x in ids if x >= 0], np.int64)


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes and rank from lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


def decode_ids(packed: bytes | None, bytes_of: dict[int, bytes]) -> bytes:
    """The bytes of packed ids; none for null."""
    if not packed:
        return b""
    return b"".join(map(bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(MAX_VOCABULARY + 1)
    if len(raw) > MAX_VOCABULARY:
        raise ValueError(f"the vocabulary is larger than {MAX_VOCABULARY} bytes, too large to broadcast")
    return raw


_BUILT: dict[tuple, object] = {}


def _built(build, raw: bytes, *rest):
    """What ``build`` makes of a broadcast vocabulary, made once in a worker."""
    key = (build.__name__, hash(raw), *rest)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = build(raw, *rest)
    return _BUILT[key]


def _coder(raw: bytes, pattern: str) -> ByteBPE:
    return ByteBPE(read_ranks(raw), pattern)


def _token_bytes(raw: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(raw).items()}


#: Characters of text encoded together; bounds what a worker holds besides its Arrow batch.
GROUP_CHARS = 1 << 19


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of about GROUP_CHARS characters; a longer text is a run of its own."""
    group, chars = [], 0
    for text in texts:
        group.append(text)
        chars += len(text or "")
        if chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


class Tokenizer:
    """Column expressions that encode and decode by one vocabulary."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        bounded_batches(spark)
        self.shared = spark.sparkContext.broadcast(read_vocabulary(path))
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """Token ids of a text column, packed as little-endian unsigned 32-bit integers."""
        shared, pattern = self.shared, self.pattern

        @F.pandas_udf(BinaryType())
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            coder = _built(_coder, shared.value, pattern)
            for texts in batches:
                out = [ids for group in _groups(texts.tolist()) for ids in coder.encode(group)]
                yield pd.Series(out, dtype=object)

        return encode(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that packed ids stand for."""
        shared = self.shared

        @F.pandas_udf(BinaryType())
        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            bytes_of = _built(_token_bytes, shared.value)
            for packed in batches:
                yield pd.Series([decode_ids(p, bytes_of) for p in packed], dtype=object)

        return decode(ids)


def n_tokens(ids: Column) -> Column:
    """Number of packed ids."""
    return (F.octet_length(ids) / 4).cast("long")

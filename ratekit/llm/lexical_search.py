r"""Ranked lexical search by dense blocked matrix products.

A few queries (items) are ranked against all documents.  Their terms make
a small vocabulary, so documents need not be inverted: a tile of documents
becomes a dense matrix of impacts over that vocabulary, the items a dense
matrix of term weights, and one BLAS product scores every document of the
tile for every item.

Terms are the maximal runs of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]``
(digits, Latin letters, everything outside ASCII) with A-Z lower-cased.  In
integers, for a document of ``n`` terms and a term met ``tf`` times:

    m      = 100 - B + ((B * n * N) div L)
    impact = (1000000000 * tf) div (1000 * tf + 8 * m)
    score  = sum over the item's terms of weight * impact

with N documents that hold a term, L terms in them, and weight
``floor(1000 * ln((2 N + 2) / (2 df + 1)))``.  An impact is under 10^6, so
products in float64 are exact while the sum over a vocabulary tile stays
under 2^53: the tile's width is cut so that it must (`tile_width`), and the
tiles' sums are added as 64-bit integers.

1. Item terms are made in tasks and put into blocks of bounded bytes; a
   block's vocabulary is broadcast, and one pass over the documents follows
   for each block (one pass, unless the items are very many).
2. The pass cuts every whole text once and stores, per document, its length
   and the counts of the vocabulary's terms it holds.
3. N, L and the document frequencies are sums over that table.
4. The table is scored in tiles; a task keeps the K best of each item,
   ties by smaller id, and its K-th score bars what cannot enter.
5. The tasks' best are merged in two steps, the first spread by a salt.

Defined results: null and empty texts and texts without a term count
nowhere; an item without terms, and one whose terms no document holds, has
no rows; items of one id and the same terms are one item, those of one id
and other terms are ranked each on their own; repeated document rows are
documents of their own; equal scores go by ascending id, a null id first;
empty tables give an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import arrow_batches

#: Share of a document's length in its normalisation, in hundredths.
LENGTH_SHARE = 90
#: Bytes of terms of the items that share one pass over the documents.
BLOCK_BYTES = 8 << 20
#: Documents of one tile, and vocabulary columns of one tile at most.
TILE_ROWS, TILE_COLUMNS = 512, 4096
#: Parts over which an item's candidates are spread before the last merge.
SALTS = 64

_EXACT = 1 << 53
_IMPACT = 10**6

#: Bytes of a text to terms: A-Z lower-cased, ASCII that is no digit or letter to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def distinct_terms(texts: pd.Series) -> pd.Series:
    return pd.Series([sorted(set(terms(x))) for x in texts])


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norms(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """m of documents of ``n`` terms; in Python's integers where 64 bits would not do."""
    if len(n) and LENGTH_SHARE * int(n.max()) * n_docs >= 1 << 63:
        grown = np.array([LENGTH_SHARE * int(x) * n_docs // total for x in n], np.int64)
    else:
        grown = LENGTH_SHARE * n * n_docs // max(total, 1)
    return 100 - LENGTH_SHARE + grown


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def tile_width(weights: np.ndarray) -> int:
    """Columns of a vocabulary tile: their sum of products stays under 2^53 whatever the impacts."""
    heaviest = max(1, int(weights.max(initial=1)))
    return max(1, min(TILE_COLUMNS, (_EXACT - 1) // (heaviest * _IMPACT)))


@dataclass
class Block:
    """Items that share a pass: their ids, the sorted vocabulary, and each item's places in it."""
    items: list
    words: list[bytes]
    places: list[np.ndarray]


def _block(rows) -> Block:
    words = sorted({bytes(t) for r in rows for t in r["terms"]})
    at = {w: i for i, w in enumerate(words)}
    return Block([r["item_id"] for r in rows], words, [np.array([at[bytes(t)] for t in r["terms"]], np.int64) for r in rows])


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Block]:
    """The items with terms, in blocks of about BLOCK_BYTES (more only for one item that alone has more)."""
    made = items.select(F.col(item_id).alias("item_id"), distinct_terms(F.col(text)).alias("terms"))
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda s, t: s + F.octet_length(t) + 64)
    made = made.where(F.size("terms") > 0).dropDuplicates(["item_id", "terms"])
    stored = materialize(made.select("item_id", "terms", size.alias("bytes")), "item-terms")
    total = stored.agg(F.sum("bytes")).first()[0] or 0
    if total <= BLOCK_BYTES:
        parts = [stored] if total else []
    else:
        # dealt by hash into parts of half a block each on average; a part that is over is taken item by item
        n = -(-2 * total // BLOCK_BYTES)
        dealt = materialize(stored.withColumn("part", F.pmod(F.xxhash64("terms"), F.lit(n))), "item-parts")
        parts = [dealt.where(F.col("part") == i) for i in range(n)]
    for part in parts:
        held, size = [], 0
        for r in part.toLocalIterator():
            if held and size + r["bytes"] > BLOCK_BYTES:
                yield _block(held)
                held, size = [], 0
            held.append(r)
            size += r["bytes"]
        if held:
            yield _block(held)


# --- the pass over the texts ---------------------------------------------------------------

_COUNTS = "doc_id long, n long, term array<int>, tf array<long>"


def count_terms(docs: DataFrame, words: list[bytes], doc_id: str, text: str) -> DataFrame:
    """Stored (doc_id, n, term, tf): length, and counts of the vocabulary's terms, of every text with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(shared.value)}
        known = place.keys()
        for batch in batches:
            ids, ns, places, counts = [], [], [], []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(body.as_py())
                if not found:
                    continue
                tf = Counter(found)
                held = [(place[t], tf[t]) for t in tf.keys() & known]
                ids.append(key)
                ns.append(len(found))
                places.append([p for p, _ in held])
                counts.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(places, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "term", "tf"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    with arrow_batches(docs.sparkSession):
        return materialize(rows.mapInArrow(count, _COUNTS), "term-counts")


# --- scoring in tiles ----------------------------------------------------------------------

class _Best:
    """The K best (score, id) of each item so far, ties by ascending id, null ids first."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.score = [np.empty(0, np.int64)] * n_items
        self.null = [np.empty(0, bool)] * n_items
        self.id = [np.empty(0, np.int64)] * n_items
        self.bar = np.ones(n_items, np.int64)  # a score must be above 0, and not under the K-th

    def offer(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        """``scores`` is documents × items."""
        for i in np.flatnonzero((scores >= self.bar).any(axis=0)):
            new = np.flatnonzero(scores[:, i] >= self.bar[i])
            s = np.concatenate([self.score[i], scores[new, i]])
            null = np.concatenate([self.null[i], nulls[new]])
            key = np.concatenate([self.id[i], ids[new]])
            order = np.lexsort((key, ~null, -s))[:self.k]
            self.score[i], self.null[i], self.id[i] = s[order], null[order], key[order]
            if len(order) == self.k:
                self.bar[i] = max(1, s[order[-1]])


def _dense(rows: np.ndarray, place: np.ndarray, values: np.ndarray, lo: int, hi: int, n: int) -> np.ndarray:
    tile = np.zeros((n, hi - lo))
    inside = (place >= lo) & (place < hi)
    tile[rows[inside], place[inside] - lo] = values[inside]
    return tile


def score_tile(lengths: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray,
               tiles: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """64-bit scores (documents × items) of documents given by their concatenated terms and counts."""
    rows = np.repeat(np.arange(len(lengths)), lengths)
    values = impacts(tf, m[rows]).astype(np.float64)
    total = 0
    for lo, hi, item_weights in tiles:
        part = _dense(rows, term, values, lo, hi, len(lengths)) @ item_weights  # exact: under 2^53
        total = total + part.astype(np.int64)
    return total


def weight_tiles(block: Block, weights: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(from, to, vocabulary × items matrix of weights) of every vocabulary tile."""
    width = tile_width(weights)
    term = np.concatenate(block.places)
    item = np.repeat(np.arange(len(block.items)), [len(p) for p in block.places])
    return [(lo, min(lo + width, len(weights)),
             _dense(item, term, weights[term].astype(np.float64), lo, min(lo + width, len(weights)), len(block.items)).T)
            for lo in range(0, len(weights), width)]


def _task_best(counts: DataFrame, block: Block, weights: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """(item, item_id, doc_id, score): each task's K best of each item of the block, items numbered."""
    shared = counts.sparkSession.sparkContext.broadcast((block, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = shared.value
        tiles = weight_tiles(own, w)
        best = _Best(len(own.items), k)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                tile = batch.slice(at, TILE_ROWS)
                ids = tile.column(0)
                n = tile.column(1).to_numpy(zero_copy_only=False)
                lengths = pc.list_value_length(tile.column(2)).to_numpy(zero_copy_only=False)
                term = tile.column(2).flatten().to_numpy(zero_copy_only=False)
                tf = tile.column(3).flatten().to_numpy(zero_copy_only=False)
                scores = score_tile(lengths, term, tf, norms(n, n_docs, total), tiles)
                best.offer(scores, ids.fill_null(0).to_numpy(zero_copy_only=False),
                           ids.is_null().to_numpy(zero_copy_only=False))
        item = np.repeat(np.arange(len(own.items)), [len(s) for s in best.score])
        key, null = np.concatenate(best.id), np.concatenate(best.null)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array([own.items[i] for i in item], pa.int64()),
             pa.array(key, pa.int64(), mask=null), pa.array(np.concatenate(best.score), pa.int64())],
            ["item", "item_id", "doc_id", "score"])

    return counts.mapInArrow(score, "item long, item_id long, doc_id long, score long")


def top(rows: DataFrame, k: int) -> DataFrame:
    """The K best documents of each item, numbered; candidates are merged in two steps."""
    best = [F.desc("score"), F.asc_nulls_first("doc_id")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item", "salt").orderBy(*best)))
    last = F.row_number().over(Window.partitionBy("block", "item").orderBy(*best))
    return first.where(F.col("rank") <= k).withColumn("rank", last).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def search(items: DataFrame, docs: DataFrame, k: int = 10, item_id: str = "item_id", item_text: str = "text",
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the K highest-scoring documents of each item, scores above 0."""
    spark = docs.sparkSession
    found = None
    for number, block in enumerate(item_blocks(items, item_id, item_text)):
        counts = count_terms(docs, block.words, doc_id, text)
        sums = counts.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not sums["docs"]:
            break
        df = np.zeros(len(block.words), np.int64)
        for r in counts.select(F.explode("term").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]  # one row for a word of the block's bounded vocabulary
        weights = np.array([weight(sums["docs"], int(x)) for x in df], np.int64)
        part = _task_best(counts, block, weights, sums["docs"], sums["terms"], k).withColumn("block", F.lit(number))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return top(found, k)

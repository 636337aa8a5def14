r"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set is its distinct 5-word shingles.  Its sketch has ``COORDINATES``
places filled in rounds: in round i < t every shingle is hashed into one
place with a value in [i, i+1); a place keeps its least value.  Rounds t
to 2t-1 offer every shingle to place i - t, so every place is filled
whatever the size of the set, and the rounds stop once all are.  Places
agree with probability equal to the Jaccard similarity and concentrate
about it as if drawn without replacement.

Places are cut into ``BANDS`` bands of ``BAND_ROWS``; documents that agree on a band
are candidates.  A pair at the threshold 0.85 is missed with probability
(1 - 0.85^4)^20 < 4e-7.  Candidates are linked after comparing their full
sets (`components.link_buckets`: hubs first, never all pairs of a group),
and links are closed to components by distributed union-find.

Equal sets are one class first, by a 128-bit digest of the full set, so a
group of copies is one node.  A pandas-free Arrow function computes sketches
of single documents; Spark does grouping, joins and verification.  Sets
are stored only for documents that share a bucket.

Defined results: a null or empty text has an empty set and is linked with
nothing; a null doc_id cannot name a component: component_id is null and
the document is kept; repeated rows get the same answer (and ``keep_first``
keeps one of them); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WordHashes, bounded_batches, broadcast_if_small, mix, odd_constants, packed, shingles, words
from .components import link_buckets

THRESHOLD_PCT = 85
BAND_ROWS = 4
BANDS = 20
COORDINATES = BAND_ROWS * BANDS

_U64 = np.uint64
_ROUND = odd_constants(2 * COORDINATES, seed=41)
_BAND = odd_constants(BAND_ROWS + 1, seed=42)
_FULL = _U64(2**64 - 1)


def sketch(elements: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of a non-empty array of distinct uint64 hashes."""
    places = np.full(size, _FULL)
    for i in range(2 * size):
        h = mix(elements * _ROUND[i] + _U64(i))
        value = _U64(i) << _U64(32) | h & _U64(0xFFFFFFFF)
        if i < size:
            np.minimum.at(places, ((h >> _U64(32)) * _U64(size) >> _U64(32)).astype(np.intp), value)
        else:
            places[i - size] = min(places[i - size], value.min())
        if places.max() != _FULL:
            return places
    return places


def band_keys(places: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band."""
    rows = places.reshape(BANDS, BAND_ROWS)
    total = np.arange(BANDS, dtype=np.uint64) * _BAND[BAND_ROWS]
    for j in range(BAND_ROWS):
        total = mix(total + rows[:, j] * _BAND[j])
    return total


_SKETCHED = "doc_id long, n_shingles long, hi long, lo long, bands array<long>"


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        n = batch.num_rows
        sizes, digests = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64)
        bands, lengths = [], np.zeros(n + 1, np.int32)
        for i, text in enumerate(batch.column(1)):
            found = np.unique(shingles(hashes.of(_lower_words(text.as_py()))))
            sizes[i] = len(found)
            if len(found):
                digest = xxhash.xxh3_128_digest(found.tobytes())
                digests[i] = np.frombuffer(digest, "<u8")
                bands.append(band_keys(sketch(found)))
                lengths[i + 1] = BANDS
        keys = np.concatenate(bands) if bands else np.empty(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), *(pa.array(np.ascontiguousarray(digests[:, j]).view(np.int64)) for j in (0, 1)),
             pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(keys.view(np.int64)))],
            ["doc_id", "n_shingles", "hi", "lo", "bands"])


def _lower_words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else words(None)  # bytes.lower() changes A-Z only


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sets = [np.unique(shingles(hashes.of(_lower_words(t.as_py())))).view(np.int64) for t in batch.column(1)]
        ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
        flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "s"])


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: size and 128-bit digest of its set, and its buckets."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_sketch_batches, _SKETCHED)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """doc_id, n_shingles, class_id (least id with the same set), component_id, kept."""
    if threshold_pct < THRESHOLD_PCT:
        raise ValueError(f"the bands are set for thresholds of {THRESHOLD_PCT} % or more")
    sketched = materialize(sketches(docs, doc_id, text), "sketches")
    classes = materialize(
        sketched.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo")
        .agg(F.min("doc_id").alias("class_id")), "classes")
    heads = sketched.join(broadcast_if_small(classes, 64), ["hi", "lo"]).where("doc_id = class_id")
    buckets = materialize(heads.select(F.explode("bands").alias("bucket"), F.col("class_id").alias("id")), "buckets")

    def sets_of(ids: DataFrame) -> DataFrame:
        rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
        return materialize(rows.join(broadcast_if_small(ids, 40), "id", "left_semi")
                           .mapInArrow(_set_batches, "id long, s array<long>"), "sets")

    labels = link_buckets(buckets, sets_of, threshold_pct)
    linked = sketched.select("doc_id", "n_shingles", "hi", "lo").join(
        broadcast_if_small(classes, 64), ["hi", "lo"], "left").join(
        broadcast_if_small(labels, 48), F.col("class_id") == F.col("node"), "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "class_id"))
    return linked.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id"))
                         .alias("class_id"), component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, columns unchanged; texts are not shuffled for it.

    The removed ids are joined (broadcast if few).  Only rows whose id and text
    occur more than once, if any, are shuffled to keep one of each.
    """
    judged = materialize(near_duplicates(docs, doc_id, text), "near-duplicates")
    removed = judged.where("NOT kept").select(F.col("doc_id").alias("removed")).distinct()
    rows = packed(docs, id=doc_id, text=text).withColumn("id", F.col("id").cast("long"))
    rows = rows.join(broadcast_if_small(removed, 40), F.col("id") == F.col("removed"), "left_anti")
    repeated = materialize(judged.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count()
                           .where("count > 1").select(F.col("doc_id").alias("repeated")), "repeated")
    if repeated.isEmpty():
        return rows.select("row.*")
    few = broadcast_if_small(repeated, 40)
    again = rows.join(few, F.col("id") == F.col("repeated"), "left_semi").dropDuplicates(["id", "text"])
    return rows.join(few, F.col("id") == F.col("repeated"), "left_anti").unionByName(again).select("row.*")

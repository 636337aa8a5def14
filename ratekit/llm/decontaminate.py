r"""Benchmark decontamination by windows of words, in DataFrame functions only.

Both sides are cut into normalised words (ASCII letters lower-cased; a word
is a run of ASCII letters and digits and of any non-ASCII characters).
Every 13 consecutive words of a benchmark item are a window; an item of
fewer words is one window.  The windows form a broadcast hash set, keyed
by the hash of each window's longest word (its anchor, rarer than its
other words).  One pass over the documents looks every word up in it;
where an anchor is met, the document's window around that place is
compared word by word, so a hash never decides.

Documents are never shuffled.  The hits, narrow rows, are stored and then
counted by document: distinct hit words, distinct items.  An empty word
added to each document matches an empty window of the set, so every
document leaves one row with its number of words in the same pass.

The set is broadcast in blocks of a checked size, a pass over the documents
for each; all benchmarks but vast ones are one block.

Defined results: null or empty texts have no words, are never hit and are
kept; a null doc_id is a value like any other; rows that repeat are each
judged; an empty benchmark hits nothing; empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import BROADCAST_BYTES, broadcast_if_small, measured_bytes, packed

WINDOW = 13
#: A document goes if at least one word in this many is hit.
HIT_SHARE = 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters between words, upper-case letters not among them.
_BETWEEN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_WORD = rf"[^{_BETWEEN}]+"
#: Bytes of a window in the broadcast set, its words apart.
_WINDOW_BYTES = 64


def _words(text: Column) -> Column:
    """Normalised words; a null text has none.  lower() equals the translation on ASCII texts only."""
    text = F.coalesce(text, F.lit(""))
    normal = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(normal, F.lit(_WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                      window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Stored tables (window_id, words, anchor, place) and (window_id, item_id).

    ``place`` is where in its window the anchor stands, from 0.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), _words(F.col(text)).alias("w")).where(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(window))
    each = items.select("item_id", "w", width.alias("width"),
                        F.explode(F.sequence(F.lit(1), F.size("w") - width + 1)).alias("start"))
    each = materialize(each.select("item_id", F.slice("w", F.col("start"), F.col("width")).alias("words"))
                       .distinct().withColumn("window_id", F.xxhash64(F.to_json("words"))), "item-windows")
    # longest word first, then by its letters, then the first place of it
    ranked = F.array_max(F.transform("words", lambda w, i: F.struct(
        F.length(w).alias("n"), w.alias("word"), (-i).alias("back"))))
    windows = each.select("words").distinct().withColumn("best", ranked).select(
        F.xxhash64(F.to_json("words")).alias("window_id"), "words",
        F.xxhash64("best.word").alias("anchor"), (-F.col("best.back")).alias("place"))
    return materialize(windows, "windows"), each.select("window_id", "item_id")


def window_hits(docs: DataFrame, windows: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored rows (doc_id, text_hash, n_words, start, width, window_id).

    One row for each occurrence of a window, and one of width 0 for each document.
    The windows are broadcast in as many blocks as keep each under the bound,
    one pass over the documents for each block (one, but for a vast benchmark).
    """
    end = windows.sparkSession.range(1).select(
        F.lit(None).cast("long").alias("window_id"), F.array().cast("array<string>").alias("words"),
        F.xxhash64(F.lit("")).alias("anchor"), F.lit(0).alias("place"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
                       _words(F.col(text)).alias("w"))
    # the words stay with each place only inside generated code: neither a shuffle
    # nor an interpreted function may stand between here and the comparison
    places = rows.select("doc_id", "text_hash", "w", F.posexplode_outer(F.concat("w", F.array(F.lit("")))))
    keyed = places.withColumn("anchor", F.xxhash64("col"))
    blocks = 1 + measured_bytes(windows, _WINDOW_BYTES) // BROADCAST_BYTES
    start = F.col("pos") - F.col("place")
    here = F.slice("w", F.greatest(start + 1, F.lit(1)), F.size("words"))
    hit = F.when(F.size("words") == 0, F.col("col") == "").otherwise((start >= 0) & (here == F.col("words")))
    found = []
    for block in range(blocks):
        part = windows.where(F.pmod("window_id", F.lit(blocks)) == block)
        part = part.unionByName(end) if block == 0 else part
        found.append(keyed.join(F.broadcast(part), "anchor").where(hit).select(
            "doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), start.alias("start"),
            F.size("words").alias("width"), "window_id"))
    return materialize(reduce(DataFrame.unionByName, found), "window-hits")


def hit_words(hits: DataFrame) -> DataFrame:
    """doc_id, text_hash, place: every hit word once, places from 0."""
    return hits.where("width > 0").select("doc_id", "text_hash", F.explode(
        F.sequence(F.col("start"), F.col("start") + F.col("width") - 1)).alias("place")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  hit_share: int = HIT_SHARE) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, items (sorted, as strings), contaminated."""
    windows, of_items = benchmark_windows(benchmark, item_id, item_text, window)
    hits = window_hits(docs, windows, doc_id, text)
    return _judged(hits, of_items, hit_share)


def _judged(hits: DataFrame, of_items: DataFrame, hit_share: int) -> DataFrame:
    key = ["doc_id", "text_hash"]
    n_hit = hit_words(hits).groupBy(key).agg(F.count("*").alias("n_hit"))
    found = hits.where("width > 0").select(*key, "window_id").distinct().join(
        broadcast_if_small(of_items, 40), "window_id")
    items = found.select(*key, F.col("item_id").cast("string").alias("item")).distinct().groupBy(key).agg(
        F.array_sort(F.collect_list("item")).alias("items"))
    counted = materialize(_null_safe(n_hit, items, "inner"), "hit-documents")
    base = hits.where("width = 0").select(*key, "n_words")
    joined = _null_safe(base, broadcast_if_small(counted, 200), "left")
    hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(*key, "n_words", hit.cast("long").alias("n_hit"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                         ((hit > 0) & (hit_share * hit >= F.col("n_words"))).alias("contaminated"))


def _null_safe(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (doc_id, text_hash) where a null id equals a null id; the left one's columns stay."""
    other = right.withColumnsRenamed({"doc_id": "doc_id_", "text_hash": "text_hash_"})
    on = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("text_hash") == F.col("text_hash_"))
    return left.join(other, on, how).drop("doc_id_", "text_hash_")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return packed(docs, doc_id=doc_id, text=text).withColumn(
        "text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      **settings) -> DataFrame:
    """The documents that are not contaminated, columns unchanged."""
    bad = materialize(contamination(docs, benchmark, doc_id, text, **settings)
                      .where("contaminated").select("doc_id", "text_hash").distinct(), "contaminated")
    return _null_safe(_keyed(docs, doc_id, text), broadcast_if_small(bad, 48), "left_anti").select("row.*")


def cut_spans(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """All documents with ``text`` less its hit words and what separates each from the next word."""
    windows, _ = benchmark_windows(benchmark, item_id, item_text, window)
    places = hit_words(window_hits(docs, windows, doc_id, text))
    # a document's own places, at most one for each of its words
    cuts = materialize(places.groupBy("doc_id", "text_hash").agg(F.collect_list("place").alias("cut")), "cuts")
    rows = _null_safe(_keyed(docs, doc_id, text), broadcast_if_small(cuts, 400), "left")
    pieces = F.regexp_extract_all("text", F.lit(rf"{_WORD}[{_BETWEEN}]*"), F.lit(0))
    rest = F.filter(pieces, lambda p, i: ~F.array_contains("cut", i))
    shorter = F.concat(F.regexp_extract("text", rf"^[{_BETWEEN}]*", 0), F.array_join(rest, ""))
    return rows.select(F.when(F.col("cut").isNull(), F.col("text")).otherwise(shorter).alias("cut_text"), "row") \
        .select(*[F.col("cut_text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])

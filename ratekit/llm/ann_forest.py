r"""Approximate nearest neighbours: a forest of random-projection trees.

Nearness is the cosine, in double precision.

fit     Each tree cuts a sample of unit vectors in two, again and again: the
        direction is the difference of two of them drawn at random, the cut
        is the median projection, until a part holds ``LEAF`` or fewer.  The
        sample is the vectors whose id has a hash under a bound, set so that
        they are about ``SAMPLE``: the same however the table is partitioned.  Trees are fitted in tasks, one a
        tree; a forest is a few megabytes and is broadcast.
index   Every vector is sent down every tree; a row of the index is the
        vector and its leaf in each tree.
search  For a query, the nodes of all trees share one priority queue.  A
        node's priority is the sum of squared distances to the planes on
        whose wrong side it lies; the least is opened first.  Leaves are
        taken until they hold ``share`` times as many rows as there are, a
        row met in several trees counting in each (at 1.2 times and 16 trees
        they hold two thirds of the rows, at 0.1 times a tenth or less).
rerank  The rows of the leaves taken are scored exactly against the query.
        Queries come in blocks of bounded bytes, each broadcast to one pass
        over the index; a task scores rows in tiles and keeps the best of
        each query, and the tasks' best are merged.

``share`` sets recall against work and is what the data demand: vectors in
tight clusters need a small one, vectors spread evenly in many dimensions a
large one, since their neighbours are barely nearer than the rest.

Equal vectors are one vector to the forest: the index holds the first of
them, with the least ids of its copies, as many as an answer can name
(``k + 1``, one being the query's own), so a vector that a third of all rows
share is neither a heavy leaf nor many equal candidates, and nothing is
lost.  A score depends on the two vectors alone, so copies tie exactly.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components take no part, nor do those whose length is not the
most frequent one (the longest of such); rows with a null id take no part;
ties go to the smaller id; fewer candidates than ``k`` are all returned;
rows that repeat an id are one row if their vectors are equal, and the row
of the least vector, compared by components, stands if not.  Empty tables
give an empty result.  Only the id and vector columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import arrow_batches, broadcast_if_small

#: Trees, vectors of the sample at most, and vectors of a leaf of the sample.
TREES, SAMPLE, LEAF = 16, 16_384, 16
#: Rows that the leaves taken for a query hold, as a share of all rows; a row met in two trees counts twice.
SHARE = 1.2
#: Bytes of a block of queries, and rows and queries of a tile.
QUERY_BYTES, TILE = 32 << 20, 1024
#: Bytes of an Arrow batch: vectors are of one size, so rows need not be measured one by one.
NO_BOUND = 2**31 - 1
SEED = 20


# --- vectors ---------------------------------------------------------------------------------

def units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled by a power of two first, so that no square over- or underflows."""
    x = np.asarray(vectors, np.float64)
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))
    x = np.ldexp(x, -exponent)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows; each depends on its two vectors alone, not on the batch they come in."""
    scaled = []
    for v in (a, b):
        x = np.asarray(v, np.float64)
        _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))
        scaled.append(np.ldexp(x, -exponent))
    x, y = scaled
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def _usable(vector: Column) -> Column:
    """Whether a vector has components, all finite, and one that is not zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0)


_KEY = ["h1", "h2"]


def sound_vectors(rows: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(id, vector, h1, h2) of every row that takes part, one row an id, and its stored columns id, h1, h2.

    Two hashes tell vectors apart; 0.0 and -0.0 are one value.
    """
    clean = F.transform(vector, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")))
    named = rows.select(F.col(vec_id).cast("long").alias("id"), clean.alias("vector"))
    hashed = named.where(F.col("id").isNotNull() & F.coalesce(_usable(F.col("vector")), F.lit(False))).select(
        "id", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    keys = materialize(hashed.select("id", *_KEY, F.size("vector").alias("d")), "vector-keys")
    lengths = keys.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths["d"] if lengths else 0
    hashed, keys = hashed.where(F.size("vector") == d), keys.where(F.col("d") == d).drop("d")
    again = materialize(keys.groupBy("id").count().where("count > 1").select("id"), "repeated-ids")
    if again.isEmpty():
        return hashed, keys
    again = broadcast_if_small(again, 16)
    stands = hashed.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("vector", *_KEY)).alias("x"))
    single = materialize(hashed.join(again, "id", "left_anti").unionByName(stands.select("id", "x.*")), "single-ids")
    return single, single.select("id", *_KEY)


def distinct_vectors(sound: DataFrame, keys: DataFrame, copies: int) -> DataFrame:
    """Stored (id, vector, ids): each different vector once, under its least id, with its least ``copies`` ids."""
    many = materialize(keys.groupBy(*_KEY).agg(F.count("*").alias("c"), F.min("id").alias("first"))
                       .where("c > 1").select(*_KEY, "first"), "repeated-vectors")
    met = keys.join(broadcast_if_small(many, 40), _KEY)
    # a row number up to a constant is cut before the shuffle, so a vector of many copies sends few
    place = F.row_number().over(Window.partitionBy(*_KEY).orderBy("id"))
    least = met.withColumn("place", place).where(F.col("place") <= copies)
    grouped = materialize(least.groupBy(*_KEY, "first").agg(F.sort_array(F.collect_list("id")).alias("ids")), "copies")
    joined = sound.join(broadcast_if_small(grouped, 48), _KEY, "left")
    return materialize(joined.where("first IS NULL OR id = first").select(
        "id", "vector", F.coalesce("ids", F.array("id")).alias("ids")), "distinct-vectors")


# --- the forest ------------------------------------------------------------------------------

@dataclass
class Tree:
    """Inner node i: plane ``normal[i]``, ``cut[i]``, children ``left[i]`` and ``right[i]``; leaf n is child ``~n``."""
    normal: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.cut) else np.full(len(x), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            above = (x[inner] * self.normal[node]).sum(axis=1) > self.cut[node]
            at[inner] = np.where(above, self.right[node], self.left[node])
        return ~at


def fit_tree(sample: np.ndarray, seed: int, leaf: int = LEAF) -> Tree:
    rng = np.random.default_rng([SEED, seed])
    normal, cut, left, right, leaves = [], [], [], [], 0
    todo = [(np.arange(len(sample)), None, None)]  # rows, and the list and place that point here
    while todo:
        rows, holder, place = todo.pop()
        plane = None
        if len(rows) > leaf:
            a, b = sample[rng.choice(rows, 2, replace=False)]
            along = sample[rows] @ (a - b)
            middle = np.median(along)
            high = along > middle
            plane = (a - b, middle, high) if high.any() and not high.all() else None
        if plane is None:
            node, leaves = ~leaves, leaves + 1
        else:
            node = len(cut)
            size = np.linalg.norm(plane[0])
            normal.append(plane[0] / size)
            cut.append(plane[1] / size)
            left.append(0)
            right.append(0)
            todo += [(rows[~plane[2]], left, node), (rows[plane[2]], right, node)]
        if holder is not None:
            holder[place] = node
    d = sample.shape[1] if sample.ndim == 2 else 0
    return Tree(np.array(normal).reshape(-1, d), np.array(cut), np.array(left, np.int64), np.array(right, np.int64), leaves)


def fit_forest(vectors: DataFrame, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF) -> list[Tree]:
    """Trees over about ``sample`` vectors (all, if there are no more), each fitted in a task of its own."""
    spark = vectors.sparkSession
    bound = int(2**31 * min(1.0, sample / max(1, vectors.count())))
    drawn = vectors.where(F.pmod(F.xxhash64("id"), F.lit(2**31)) < bound)
    rows = drawn.orderBy("id").select("vector").toPandas()["vector"]
    if not len(rows):
        return []
    unit = units(np.stack(rows))
    shared = spark.sparkContext.broadcast(unit)

    def fit(numbers: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in numbers:
            for i in pdf["id"]:
                t = fit_tree(shared.value, int(i), leaf)
                yield pd.DataFrame({"tree": [i], "normal": [t.normal.tobytes()], "cut": [t.cut.tobytes()],
                                    "sides": [np.concatenate([t.left, t.right]).tobytes()], "leaves": [t.leaves]})

    made = spark.range(0, trees, 1, trees).mapInPandas(
        fit, "tree long, normal binary, cut binary, sides binary, leaves long").orderBy("tree").collect()
    out = []
    for r in made:
        cut = np.frombuffer(r["cut"])
        sides = np.frombuffer(r["sides"], np.int64).reshape(2, -1)
        out.append(Tree(np.frombuffer(r["normal"]).reshape(len(cut), unit.shape[1]), cut, sides[0], sides[1], r["leaves"]))
    return out


def index(vectors: DataFrame, forest: list[Tree]) -> DataFrame:
    """Stored (id, vector, ids, leaf): every vector with its leaf in each tree."""
    shared = vectors.sparkSession.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = units(_matrix(b.column("vector"), b.num_rows))
                leaf = np.stack([t.leaf_of(x) for t in shared.value], axis=1).astype(np.int32)
                yield b.append_column("leaf", pa.array(list(leaf), pa.list_(pa.int32())))

    with arrow_batches(vectors.sparkSession, TILE, NO_BOUND):
        return materialize(vectors.mapInArrow(place, "id long, vector array<double>, ids array<long>, leaf array<int>"),
                           "vector-index")


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def leaf_sizes(indexed: DataFrame, forest: list[Tree]) -> list[np.ndarray]:
    """Rows of every leaf of every tree: one number a leaf."""
    counts = indexed.select(F.posexplode("leaf").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect()
    sizes = [np.zeros(t.leaves, np.int64) for t in forest]
    for r in counts:
        sizes[r["tree"]][r["leaf"]] = r["count"]
    return sizes


def leaves_for(q: np.ndarray, forest: list[Tree], sizes: list[np.ndarray], rows: float) -> list[list[int]]:
    """The leaves of each tree that hold ``rows`` rows, nearest first over all trees: one queue for all."""
    sides = [(t.normal @ q - t.cut).tolist() if len(t.cut) else [] for t in forest]
    heap = [(0.0, t, 0 if sides[t] else -1) for t in range(len(forest))]
    taken: list[list[int]] = [[] for _ in forest]
    held = 0
    while heap and held < rows:
        far, t, node = heapq.heappop(heap)
        tree, side = forest[t], sides[t]
        while node >= 0:  # down the near side; the far sides wait in the queue
            s = side[node]
            near, other = (tree.right[node], tree.left[node]) if s > 0 else (tree.left[node], tree.right[node])
            heapq.heappush(heap, (far + s * s, t, int(other)))
            node = int(near)
        taken[t].append(~node)
        held += sizes[t][~node]
    return taken


# --- search ----------------------------------------------------------------------------------

def _plans(queries: DataFrame, forest: list[Tree], sizes: list[np.ndarray], share: float) -> DataFrame:
    """Stored (id, vector, open): each query with a bit for every leaf it takes, trees one after the other."""
    shared = queries.sparkSession.sparkContext.broadcast((forest, sizes))
    rows = share * float(sizes[0].sum()) if sizes else 0.0

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, counts = shared.value
        starts = np.cumsum([0] + [t.leaves for t in trees])
        for b in batches:
            if not b.num_rows:
                continue
            bits = []
            for q in units(_matrix(b.column("vector"), b.num_rows)):
                flags = np.zeros(starts[-1], bool)
                for start, leaves in zip(starts, leaves_for(q, trees, counts, rows)):
                    flags[start + np.array(leaves, np.int64)] = True
                bits.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vector"), pa.array(bits, pa.binary())],
                                             ["id", "vector", "open"])

    with arrow_batches(queries.sparkSession, TILE, NO_BOUND):
        return materialize(queries.select("id", "vector").mapInArrow(plan, "id long, vector array<double>, open binary"),
                           "query-plans")


def _merge(best_s: np.ndarray, best_r: np.ndarray, s: np.ndarray, r: np.ndarray, n: int):
    """The ``n`` best (score, row id) of each query (a row), ties by smaller id."""
    both_s, both_r = np.concatenate([best_s, s], axis=1), np.concatenate([best_r, r], axis=1)
    order = np.lexsort((both_r, -both_s), axis=1)[:, :n]
    return np.take_along_axis(both_s, order, 1), np.take_along_axis(both_r, order, 1)


def _scan(indexed: DataFrame, block: pd.DataFrame, forest: list[Tree], n: int) -> DataFrame:
    """(query, id, score, ids): the ``n`` best rows of each task for each query of the block."""
    spark = indexed.sparkSession
    starts = np.cumsum([0] + [t.leaves for t in forest])
    flags = np.unpackbits(np.stack([np.frombuffer(x, np.uint8) for x in block["open"]]), axis=1)[:, :starts[-1]]
    original = np.stack(block["vector"])
    shared = spark.sparkContext.broadcast((block["id"].to_numpy(), original, units(original), flags))

    def candidates(unit: np.ndarray, leaf: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Cosines to rounding of the tile's rows in leaves that the queries take; -inf for others."""
        _, _, q, mask = shared.value
        s = q[lo:hi] @ unit.T
        open_ = np.zeros(s.shape, bool)
        for t, start in enumerate(starts[:-1]):
            open_ |= mask[lo:hi, start + leaf[:, t]].astype(bool)
        s[~open_] = -np.inf
        return s

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, _, _ = shared.value
        best_s = np.full((len(ids), n), -np.inf)
        best_r = np.full((len(ids), n), np.iinfo(np.int64).max)
        copies: dict[int, list[int]] = {}
        for b in batches:
            for at in range(0, b.num_rows, TILE):
                part = b.slice(at, TILE)
                row_ids = part.column("id").to_numpy(zero_copy_only=False)
                x = _matrix(part.column("vector"), part.num_rows)
                leaf = _matrix(part.column("leaf"), part.num_rows)
                unit = units(x)
                fresh: set[int] = set()
                for lo in range(0, len(ids), TILE):
                    hi = min(lo + TILE, len(ids))
                    s = candidates(unit, leaf, lo, hi)
                    # what may enter: not under the n-th best so far, nor under the n-th of this tile (less rounding)
                    bar = best_s[lo:hi, -1] - 1e-9
                    if s.shape[1] > n:
                        bar = np.maximum(bar, np.partition(s, -n, axis=1)[:, -n] - 1e-9)
                    qi, ri = np.nonzero((s >= bar[:, None]) & (s > -np.inf))
                    if not len(qi):
                        continue
                    exact = cosines(vectors[lo + qi], x[ri])
                    counts = np.bincount(qi, minlength=hi - lo)
                    column = np.arange(len(qi)) - np.repeat(np.cumsum(counts) - counts, counts)
                    new_s = np.full((hi - lo, counts.max()), -np.inf)
                    new_r = np.full((hi - lo, counts.max()), np.iinfo(np.int64).max)
                    new_s[qi, column], new_r[qi, column] = exact, row_ids[ri]
                    hit = np.flatnonzero(counts)
                    best_s[lo + hit], best_r[lo + hit] = _merge(best_s[lo + hit], best_r[lo + hit], new_s[hit], new_r[hit], n)
                    fresh.update(ri.tolist())
                held = part.column("ids")
                for i in fresh:
                    copies[int(row_ids[i])] = held[i].as_py()
            if len(copies) > 4 * best_r.size:  # forget those that were pushed out
                stay = set(best_r.ravel().tolist())
                copies = {k: v for k, v in copies.items() if k in stay}
        q, c = np.nonzero(best_s > -np.inf)
        rows = best_r[q, c]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[q], pa.int64()), pa.array(rows, pa.int64()), pa.array(best_s[q, c], pa.float64()),
             pa.array([copies[int(r)] for r in rows], pa.list_(pa.int64()))], ["query", "id", "score", "ids"])

    return indexed.mapInArrow(scan, "query long, id long, score double, ids array<long>")


def query_blocks(plans: DataFrame) -> Iterator[pd.DataFrame]:
    """The planned queries in blocks of about QUERY_BYTES, cut by hash."""
    sizes = plans.agg(F.count("*").alias("n"), F.max(F.size("vector") * 16 + F.octet_length("open") * 9).alias("b")).first()
    if not sizes["n"]:
        return
    parts = max(1, -(-2 * sizes["n"] * sizes["b"] // QUERY_BYTES)) if sizes["n"] * sizes["b"] > QUERY_BYTES else 1
    for i in range(parts):
        block = plans.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == i).toPandas()
        if len(block):
            yield block


def nearest(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query row, itself excluded.

    ``is_query`` tells the queries, over column ``id``.
    """
    spark = rows.sparkSession
    sound, keys = sound_vectors(rows, vec_id, vector)
    vectors = distinct_vectors(sound, keys, k + 1)
    forest = fit_forest(vectors, trees, sample, leaf)
    if not forest:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexed = index(vectors, forest)
    # every query row, under the vector that stands for it
    stands = indexed.select(F.col("id").alias("class"), F.xxhash64("vector").alias("h1"),
                            F.xxhash64(F.lit(1), "vector").alias("h2"))
    queries = broadcast_if_small(materialize(keys.where(is_query), "queries"), 40)
    asked = materialize(stands.join(queries, _KEY).select(F.col("id").alias("query_id"), "class"), "asked")
    classes = materialize(asked.select(F.col("class").alias("id")).distinct(), "asked-classes")
    plans = _plans(indexed.join(broadcast_if_small(classes, 24), "id", "left_semi"), forest,
                   leaf_sizes(indexed, forest), share)
    found = None
    for block in query_blocks(plans):
        with arrow_batches(spark, TILE, NO_BOUND):
            part = materialize(_scan(indexed, block, forest, k + 1), "found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    near = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = found.select("query", "score", F.explode("ids").alias("vec_id"))
    # k + 1 answers of each vector, of which a query row leaves out its own
    best = materialize(named.withColumn("place", F.row_number().over(near)).where(F.col("place") <= k + 1), "nearest")
    answers = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("a"))
    others = F.filter("a", lambda x: x["vec_id"] != F.col("query_id"))
    joined = asked.join(broadcast_if_small(materialize(answers, "answers"), 48), F.col("class") == F.col("query"))
    each = joined.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                       F.col("x.score").alias("score"))

"""Distributed union-find over an edge table, and candidate linking on top of it.

Components come from alternating large-star and small-star rounds: every
round is joins and grouped minima over the edge table, written to the
shared folder, until the edges form stars around each component's least
node.  No group of edges is ever collected: a hub's edges are spread by
the join's skew handling and its minimum is pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import broadcast_if_small

#: Members up to which all pairs of a bucket are looked at; the work is at most half of it a member.
PAIRWISE = 256
#: 64-bit words of a set's marks.
_WORDS = 4


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every child has one parent and no parent is a child."""
    twice = edges.groupBy("u").count().where("count > 1").select("u")
    chained = edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi")
    return twice.unionByName(chained).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its least node.

    Edges with a null end and loops are ignored; no edges give no rows.
    """
    stars = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges")
    while not _are_stars(stars):
        stars = materialize(_small_star(_large_star(stars)), "stars")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _labelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    at = labels.select(F.col("node").alias(node), F.col("component").alias(label))
    return rows.join(broadcast_if_small(at, 48), node, "left").withColumn(label, F.coalesce(label, node))


def _marks(sets: DataFrame, set_of: Callable[[Column], Column] | None) -> DataFrame:
    """Stored (id, n, w0, ...): the sets' sizes, and for each class of elements whether their number is odd."""
    if set_of is not None:
        sets = sets.select("id", set_of(F.col("s")).alias("s"))
    each = sets.select("id", F.explode_outer("s").alias("x"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("x").bitwiseAND(63).cast("int"))
    word = F.shiftright("x", 6).bitwiseAND(_WORDS - 1)
    odd = [F.coalesce(F.bit_xor(F.when(word == w, bit)), F.lit(0).cast("long")).alias(f"w{w}") for w in range(_WORDS)]
    return materialize(each.groupBy("id").agg(F.count("x").alias("n"), *odd), "set-marks")


def _differing(a: str, b: str) -> Column:
    """Classes whose marks differ: at least as many elements are in one of the sets alone."""
    return sum((F.bit_count(F.col(f"{a}w{w}").bitwiseXOR(F.col(f"{b}w{w}"))) for w in range(_WORDS)), F.lit(0))


def _alike(threshold_pct: int, a: str, b: str) -> Column:
    """Whether sizes and marks leave room for the threshold; true for every pair that reaches it."""
    return ((100 + threshold_pct) * _differing(a, b) <= (100 - threshold_pct) * (F.col(f"{a}n") + F.col(f"{b}n"))) & (
        100 * F.least(f"{a}n", f"{b}n") >= threshold_pct * F.greatest(f"{a}n", f"{b}n"))


def _named(rows: DataFrame, prefix: str, *columns: str) -> DataFrame:
    """``rows`` with the prefix before every name but those of ``columns``."""
    return rows.select(*columns, *[F.col(c).alias(prefix + c) for c in rows.columns if c not in columns])


class _Links:
    """Verified links so far, the pairs that were compared, and the components they make."""

    def __init__(self, sets: DataFrame, threshold_pct: int, set_of: Callable[[Column], Column] | None = None):
        self.sets, self.threshold, self.set_of = sets, threshold_pct, set_of
        self.marks = _marks(sets, set_of)
        self.links: DataFrame | None = None
        self.tested: DataFrame | None = None
        self.labels: DataFrame | None = None

    def _similar(self, pairs: DataFrame) -> DataFrame:
        left = self.sets.select(F.col("id").alias("a"), F.col("s").alias("a_set"))
        right = self.sets.select(F.col("id").alias("b"), F.col("s").alias("b_set"))
        if self.set_of is not None:
            return self._similar_made(pairs.join(left, "a").join(right, "b"))
        shared = F.size(F.array_intersect("a_set", "b_set"))
        union = F.size("a_set") + F.size("b_set") - shared
        return pairs.join(left, "a").join(right, "b").where(
            100 * shared >= self.threshold * union).select("a", "b").distinct()

    def _similar_made(self, joined: DataFrame) -> DataFrame:
        """The similar ones of pairs that carry what their sets are made from.

        The lambdas make each set, and count what is shared, once a pair.
        """
        made = F.array(F.struct(self.set_of(F.col("a_set")).alias("a"), self.set_of(F.col("b_set")).alias("b")))
        counted = F.transform(made, lambda p: F.struct(
            F.size(F.array_intersect(p["a"], p["b"])).alias("shared"), (F.size(p["a"]) + F.size(p["b"])).alias("both")))
        reached = F.exists(counted, lambda c: 100 * c["shared"] >= self.threshold * (c["both"] - c["shared"]))
        return joined.where(reached).select("a", "b").distinct()

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that sizes and marks do not rule out."""
        for c in ("a", "b"):
            own = _named(self.marks, f"{c}_").withColumnRenamed(f"{c}_id", c)
            pairs = pairs.join(broadcast_if_small(own, 64), c)
        return pairs.where(_alike(self.threshold, "a_", "b_")).select("a", "b")

    def compare(self, pairs: DataFrame) -> None:
        """Compare the full sets of pairs (a > b) that were not compared yet; join up what is similar."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if self.tested is not None and pairs.isEmpty():
            return
        found = materialize(self._similar(pairs), "links")
        if self.tested is not None and found.isEmpty():
            self.tested = self.tested.unionByName(pairs)
            return
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        self.links = found if self.links is None else self.links.unionByName(found)
        self.labels = materialize(connected_components(self.links), "labels")

    @staticmethod
    def ordered(joined: DataFrame) -> DataFrame:
        """(a, b, far) of joined rows (a_..., b_...): the greater id first, and how far the marks are apart."""
        far = _differing("a_", "b_") / (F.col("a_n") + F.col("b_n"))
        return joined.select(*_ordered("a_id", "b_id"), far.alias("far"))

    def compare_nearest_first(self, near: DataFrame) -> None:
        """Compare stored pairs (a, b, far) of different components: each id's nearest first, and of the others
        those still apart after that."""
        nearest = [near.groupBy(x).agg(F.min(F.struct("far", y)).alias("y")).select(x, F.col(f"y.{y}").alias(y)).select("a", "b")
                   for x, y in (("a", "b"), ("b", "a"))]
        self.compare(nearest[0].unionByName(nearest[1]).distinct())
        rest = _labelled(_labelled(near.select("a", "b"), self.labels, "a", "x"), self.labels, "b", "y")
        self.compare(rest.where("x <> y").select("a", "b"))


def _ordered(x: str, y: str) -> list[Column]:
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def _bound(threshold_pct: int, a: str, b: str) -> Column:
    """Whether sizes n and own elements u (met in no other set) leave room for the threshold."""
    most = F.least(F.col(f"{a}n") - F.col(f"{a}u"), F.col(f"{b}n") - F.col(f"{b}u"))
    return 100 * most >= threshold_pct * (F.col(f"{a}n") + F.col(f"{b}n") - most)


def _places_bound(threshold_pct: int) -> Column:
    """Whether the first shared element, at these places, leaves enough elements behind it.

    A pair that is similar passes at its first shared element; it may fail
    at later ones, which only repeat it.
    """
    most = 1 + F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    return (100 + threshold_pct) * most >= threshold_pct * (F.col("a_n") + F.col("b_n"))


def _prefixes(sets: DataFrame, threshold_pct: int) -> DataFrame:
    """Stored (id, u, prefix): own elements, and the prefix as an array of elements with their places.

    With all elements in one order, the rarest first, two similar sets of
    sizes n share an element among their first n - ceil(threshold n) + 1.
    """
    each = sets.select("id", F.size("s").alias("n"), F.explode("s").alias("x"))
    counts = each.groupBy("x").agg(F.count("*").alias("df"))
    within = Window.partitionBy("id").orderBy("df", "x")  # a window per set: bounded by its size
    ranked = each.join(counts, "x").withColumn("at", F.row_number().over(within))
    upto = F.col("n") - F.ceil(F.col("n") * F.lit(threshold_pct) / 100) + 1
    own, early = F.col("df") == 1, (F.col("df") > 1) & (F.col("at") <= upto)
    return materialize(ranked.where(own | early).groupBy("id").agg(
        F.sum(own.cast("int")).alias("u"), F.collect_list(F.when(early, F.struct("x", "at"))).alias("prefix")), "set-prefixes")


def link_buckets(buckets: DataFrame, sets_of: Callable[[DataFrame], DataFrame], threshold_pct: int,
                 set_of: Callable[[Column], Column] | None = None) -> DataFrame:
    """Components of ids whose sets are similar and that share a bucket or are linked through others.

    ``buckets`` is (bucket, id); ``sets_of`` gets the stored ids that share a
    bucket with others and returns their sets, a stored table (id, s) with
    s an array of distinct 64-bit elements, or, with ``set_of``, what that
    makes such an array of (a text is smaller than its set).  Links are pairs whose Jaccard similarity,
    counted on the full sets, reaches the threshold.  Full sets are compared
    only where sizes and marks (`_alike`, exact) leave room, and not for all
    pairs of a bucket, for only links between components matter:

    1. each id with one hub, the least id met in any of its buckets;
    2. ids not connected to the hub of some bucket they are in, with it;
    3. in buckets of up to ``PAIRWISE`` members that still hold several
       components, all pairs of different components; in larger ones, ids
       apart from the hub with all that an exact filter leaves: sets of
       another component which share one of the rarest elements
       (`_prefixes`) and whose sizes and own elements leave room; of these
       pairs, each id's nearest by its marks before the others.

    After step 3 every pair of a bucket is connected, was compared, or
    cannot be similar, so no link is lost and nothing is capped.  Returns
    a stored table (node, component).
    """
    hubs = materialize(buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("top"),
                                                     F.count("*").alias("size"))
                       .where("hub < top").select("bucket", "hub", "size"), "hubs")
    shared = materialize(buckets.join(broadcast_if_small(hubs, 64), "bucket"), "shared-buckets")
    found = _Links(sets_of(materialize(shared.select("id").distinct(), "shared-ids")), threshold_pct, set_of)

    found.compare(found.possible(shared.groupBy("id").agg(F.min("hub").alias("hub")).where("hub < id")
                                 .select(F.col("id").alias("a"), F.col("hub").alias("b"))))
    star = _labelled(_labelled(shared.select("id", "hub"), found.labels, "id", "x"), found.labels, "hub", "y")
    found.compare(found.possible(star.where("x <> y").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()))

    members = _labelled(_labelled(shared, found.labels, "id", "label"), found.labels, "hub", "hub_label")
    # a bucket of two has had its one pair compared
    mixed = materialize(members.where("label <> hub_label AND size > 2").select("bucket", "size").distinct(), "mixed-buckets")
    if mixed.isEmpty():
        return found.labels
    small = materialize(_labelled(shared.where(F.col("size") <= PAIRWISE).join(
        broadcast_if_small(mixed.select("bucket"), 40), "bucket", "left_semi").select("bucket", "id"),
        found.labels, "id", "label").join(broadcast_if_small(found.marks, 64), "id"), "mixed-members")
    a, b = _named(small, "a_", "bucket"), _named(small, "b_", "bucket")
    near = a.join(b, "bucket").where((F.col("a_id") > F.col("b_id")) & (F.col("a_label") != F.col("b_label"))
                                     & _alike(threshold_pct, "a_", "b_"))
    near = found.ordered(near)
    large = mixed.where(F.col("size") > PAIRWISE).select("bucket")
    if not large.isEmpty():
        near = near.unionByName(found.ordered(_large_pairs(shared, large, found)))
    found.compare_nearest_first(materialize(near.distinct(), "near-pairs"))
    return found.labels


def _large_pairs(shared: DataFrame, large: DataFrame, found: _Links) -> DataFrame:
    """Pairs of different components in the ``large`` buckets that the prefixes, sizes and marks leave."""
    around = materialize(shared.join(broadcast_if_small(large, 40), "bucket", "left_semi"), "large-members")
    members = _labelled(_labelled(around, found.labels, "id", "label"), found.labels, "hub", "hub_label")
    ids = materialize(members.groupBy("id").agg(F.first("label").alias("label"),
                                                F.max(F.col("label") != F.col("hub_label")).alias("apart")), "large-ids")
    sets = found.sets.join(broadcast_if_small(ids.select("id"), 40), "id", "left_semi")
    if found.set_of is not None:
        sets = sets.withColumn("s", found.set_of(F.col("s")))
    whole = found.marks.join(broadcast_if_small(ids, 48), "id").join(
        broadcast_if_small(_prefixes(sets, found.threshold), 48), "id")
    rows = materialize(whole.withColumn("one", F.explode("prefix")).select("*", "one.*").drop("prefix", "one"), "prefixes")
    a, b = _named(rows.where("apart"), "a_", "x"), _named(rows, "b_", "x")
    once = ~F.col("b_apart") | (F.col("a_id") < F.col("b_id"))
    return a.join(b, "x").where((F.col("a_label") != F.col("b_label")) & once & _bound(found.threshold, "a_", "b_")
                                & _places_bound(found.threshold) & _alike(found.threshold, "a_", "b_"))

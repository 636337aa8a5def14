"""Splits, class weights, epoch order and mini-batches.

Splits are exact and reproducible: every row gets a seeded md5 order key,
so the assignment does not depend on partitioning or on re-execution after
an executor loss (``randomSplit``/``rand`` would).  Sizes follow the
"ceil of the fraction" rule with exact rational arithmetic, so 10 % of
60,000 rows is exactly 6,000.

Stratified split, per stratum (user) with n rows:
  test quota  = floor(n·f) + 1 for the strata with the largest remainders
                (ties by a seeded hash of the stratum) until the total is
                ceil(N·f);
  val quota   = the same rule on the n − test rows left, with the
                validation fraction taken of the total (rescaled) or of
                the remainder;
  rows of a stratum are taken in hash order: first test, then val.

Rows are labelled by comparing their hash with two cut points of their
stratum (a random split has one stratum).  Only (stratum, first 60 bits of
the hash) pairs are stored and ordered, and in two levels: a stratum of more
than ``HOT`` rows is counted by hash prefix first and ordered inside the
prefixes that hold its cuts, so a stratum that holds a third of all rows is
never one task; the others' pairs are shuffled once.  Rows that share a
key share a hash, so a cut may fall among rows of equal bits: those alone are
ranked by their whole hash and a hash of all their columns, over ranges, and
sizes stay exact however often a key repeats.  Null keys are equal keys, and a null stratum is a
stratum; an empty table stays empty.

A caller that names the ``columns`` it needs has its rows computed once: those
columns are stored beside the bits of the hash, or instead of them if the key is
among them, and labelled from there.  Only rows of a divided key are computed again.
A stratified split then labels the stored rows of strata of up to ``HOT`` rows
where they are ordered, so that they are shuffled once and join no cuts.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ordering import global_row_number
from .profile import value_counts

#: Hexadecimal digits of the hash by which rows are counted before they are ordered.
_PREFIX = 4
#: Digits of the hash by which rows are ordered, as a long of 60 bits.
_NARROW = 15
#: Rows from which a stratum is cut into prefixes.
HOT = 200_000


def as_fraction(x: float | Fraction | str) -> Fraction:
    """Exact rational form of a fraction written in decimal (0.15 → 3/20)."""
    return x if isinstance(x, Fraction) else Fraction(str(x))


def validation_fraction(test: float, val: float, relative_to: str) -> Fraction:
    """Fraction of the non-test rows that goes to validation."""
    t, v = as_fraction(test), as_fraction(val)
    if relative_to == "total":
        return v / (1 - t)
    if relative_to == "remainder":
        return v
    raise ValueError("relative_to must be 'total' or 'remainder'")


def seeded_hash(seed: int, *cols: str | Column) -> Column:
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def _least(rows: DataFrame, h: str, n: int) -> str:
    """The ``n``-th least of the different hashes in ``h`` (n from 1): counted by prefix, then ordered inside one."""
    prefix = F.substring(h, 1, _PREFIX)
    counts = materialize(rows.groupBy(prefix.alias("p")).agg(F.count("*").alias("c")), "hash-prefixes")
    upto = counts.withColumn("upto", F.sum("c").over(Window.orderBy("p")))  # at most 16^_PREFIX rows
    at = upto.where(F.col("upto") >= n).orderBy("p").first()
    inside = rows.where(prefix == at["p"]).orderBy(h).select(h)
    return inside.offset(n - 1 - (at["upto"] - at["c"])).first()[0]


def _quota(strata: DataFrame, n_col: str, f: Fraction, out: str, hash_col: str) -> DataFrame:
    """floor(n·f) per stratum plus one for the largest remainders; ``strata`` is a stored table."""
    p, q = f.numerator, f.denominator
    s = strata.withColumn("_fl", F.expr(f"({n_col} * {p}) div {q}")) \
              .withColumn("_rem", F.expr(f"({n_col} * {p}) % {q}"))
    counts = s.groupBy("_rem").agg(F.count("*").alias("c"), F.sum(n_col).alias("n"), F.sum("_fl").alias("fl"))
    by_rem = counts.withColumn("upto", F.sum("c").over(Window.orderBy(F.desc("_rem"))))  # at most q rows
    total = by_rem.agg(F.sum("n").alias("n"), F.sum("fl").alias("fl"),
                       F.collect_list(F.struct("_rem", "c", "upto")).alias("by_rem")).first()
    need = -(-(total["n"] or 0) * p // q) - (total["fl"] or 0)
    more = F.lit(False)
    if need > 0:
        at = next(r for r in sorted(total["by_rem"], key=lambda r: r["upto"]) if r["upto"] >= need)
        left = need - (at["upto"] - at["c"])
        level = F.col("_rem") == at["_rem"]
        if left < at["c"]:
            level = level & (F.col(hash_col) <= _least(s.where(level), hash_col, left))
        more = (F.col("_rem") > at["_rem"]) | level
    return s.withColumn(out, F.col("_fl") + F.when(more, 1).otherwise(0)).drop("_fl", "_rem")


def narrow(h: Column) -> Column:
    """The first 60 bits of a hexadecimal hash as a long: a quarter of its bytes, in the same order."""
    return F.conv(F.substring(h, 1, _NARROW), 16, 10).cast("long")


def _cold_cuts(keys: DataFrame, strata: DataFrame) -> DataFrame:
    """The cuts of strata of ``HOT`` rows at most: one shuffle of the pairs, each stratum after a row of its quotas."""
    none = F.lit(None).cast("long")
    marked = keys.select(F.col("s").alias("g"), "p", none.alias("q_test"), none.alias("q_both")).unionByName(
        strata.select("g", none.alias("p"), "q_test", "q_both"))
    order = Window.partitionBy("g").orderBy(F.asc_nulls_first("p"))
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = marked.select(
        "g", "p", *[F.first(q).over(first).alias(q) for q in ("q_test", "q_both")],
        (F.row_number().over(order) - 1).alias("place"), (F.rank().over(order) - 2).alias("first"),
        F.coalesce(F.lead("p").over(order) == F.col("p"), F.lit(False)).alias("more"))
    at = placed.where(F.col("p").isNotNull() & ((F.col("place") == F.col("q_test")) | (F.col("place") == F.col("q_both"))))
    here = lambda q: F.max(F.when(F.col("place") == F.col(q), F.struct("p", F.col("first").cast("long").alias("before"),
                                                                       F.col("more").alias("shared"))))
    return at.groupBy("g").agg(here("q_test").alias("test"), here("q_both").alias("val"),
                               *[F.first(q).alias(q) for q in ("q_test", "q_both")])


def _hot_cuts(keys: DataFrame, strata: DataFrame) -> DataFrame:
    """The cuts of large strata (few: a broadcast), by counts of prefixes and then inside those that hold a cut."""
    held = keys.join(F.broadcast(strata), F.col("s").eqNullSafe(F.col("g"))).withColumn(
        "b", F.shiftright("p", 4 * (_NARROW - _PREFIX)))
    ends = ("q_test", "q_both")
    inside = lambda q, m: (F.col("before") < F.col(q)) & (F.col(q) <= F.col("before") + F.col(m))
    firsts = [F.first(q).alias(q) for q in ends]
    whole = held.groupBy("g", "b").agg(F.count("*").alias("m"), *firsts)
    over = Window.partitionBy("g").orderBy("b")  # at most 16^_PREFIX rows of a stratum
    parts = whole.withColumn("before", F.sum("m").over(over) - F.col("m")).where(
        inside("q_test", "m") | inside("q_both", "m"))
    parts = materialize(parts.select(F.col("g").alias("g_"), F.col("b").alias("b_"), F.col("before").alias("start")),
                        "split-prefixes")  # two rows a stratum at most
    near = held.join(F.broadcast(parts), F.col("g").eqNullSafe(F.col("g_")) & (F.col("b") == F.col("b_")))
    counts = near.groupBy("g", "b", "p").agg(F.count("*").alias("c"), F.first("start").alias("start"), *firsts)
    order = Window.partitionBy("g", "b").orderBy("p")  # a prefix of one stratum
    placed = counts.withColumn("before", F.col("start") + F.sum("c").over(order) - F.col("c"))
    cut = lambda q: F.max(F.when(inside(q, "c"), F.struct(
        "p", "before", (F.col("before") + F.col("c") > F.col(q)).alias("shared"))))
    return placed.where(inside("q_test", "c") | inside("q_both", "c")).groupBy("g").agg(
        cut("q_test").alias("test"), cut("q_both").alias("val"), *firsts)


def _cuts(keys: DataFrame, strata: DataFrame) -> DataFrame:
    """Stored (g, test, val, q_test, q_both): for each stratum the bits at which either part ends, the rows before
    them, and whether the cut leaves rows of these bits on either side.

    ``keys`` is (s, p), stored, a row for each row; ``strata`` (g, n, q_test, q_both): rows of a
    stratum, and how many of the first ones are test, and test or val.
    """
    hot = materialize(strata.where(F.col("n") > HOT), "hot-strata")  # at most rows / HOT of them
    if hot.isEmpty():
        return materialize(_cold_cuts(keys, strata), "split-cuts")
    rest = keys.join(F.broadcast(hot.select("g")), F.col("s").eqNullSafe(F.col("g")), "left_anti")
    cold = _cold_cuts(rest, strata.where(F.col("n") <= HOT))
    return materialize(cold.unionByName(_hot_cuts(keys, hot)), "split-cuts")


def _stored(rows: DataFrame, columns: Sequence[str], key: str, h: Column) -> DataFrame:
    """The columns of ``rows`` that are needed, stored, and ``_p``: made again from a key that is among them."""
    if key in columns:
        return materialize(rows.select(*columns), "split-rows", codec="zstd").withColumn("_p", narrow(h))
    return materialize(rows.select(*columns, "_p"), "split-rows", codec="zstd")


def _by_cuts() -> Column:
    def first(part: str) -> Column:
        return F.coalesce(F.col("_p") <= F.col(f"{part}.p"), F.lit(False))

    return F.when(first("test"), "test").when(first("val"), "val").otherwise("train")


def _divide(cuts: DataFrame) -> bool:
    """Whether a cut leaves rows of equal bits on either side."""
    return not cuts.where(F.coalesce("test.shared", F.lit(False)) | F.coalesce("val.shared", F.lit(False))).isEmpty()


def _labelled_in_order(held: DataFrame, strata: DataFrame, s: str, needed: list[str], out: str) -> DataFrame | None:
    """The stored rows ``held`` with their label, stored; None if a cut leaves rows of equal bits on either side.

    ``strata`` is that of `_cuts`.  Strata of ``HOT`` rows at most are labelled by their rows' places, each
    after a row of its quotas; the few larger ones by their cuts.
    """
    hot = materialize(strata.where(F.col("n") > HOT), "hot-strata")  # at most rows / HOT of them
    cold, few, any_hot = held, strata, not hot.isEmpty()
    if any_hot:
        cold = held.join(F.broadcast(hot.select("g")), F.col(s).eqNullSafe(F.col("g")), "left_anti")
        few = strata.where(F.col("n") <= HOT)
    own, none = [c for c in dict.fromkeys(needed) if c != s], F.lit(None).cast("long")
    marked = cold.select(F.col(s).alias("_g"), "_p", none.alias("_q_test"), none.alias("_q_both"), *own).unionByName(
        few.select(F.col("g").alias("_g"), none.alias("_p"), F.col("q_test").alias("_q_test"), F.col("q_both").alias("_q_both"),
                   *[F.lit(None).cast(held.schema[c].dataType).alias(c) for c in own]))
    order = Window.partitionBy("_g").orderBy(F.asc_nulls_first("_p"))
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = marked.select("_g", "_p", *own, *[F.first(q).over(first).alias(q) for q in ("_q_test", "_q_both")],
                           (F.row_number().over(order) - 1).alias("_place"), F.lead("_p").over(order).alias("_next"))
    place = F.col("_place")
    label = F.when(place <= F.col("_q_test"), "test").when(place <= F.col("_q_both"), "val").otherwise("train")
    ends = (place == F.col("_q_test")) | (place == F.col("_q_both"))
    done = placed.where(F.col("_p").isNotNull()).select(
        F.col("_g").alias(s), *own, label.alias(out), F.coalesce(ends & (F.col("_next") == F.col("_p")), F.lit(False)).alias("_shared"))
    if any_hot:
        cuts = materialize(_hot_cuts(held.select(F.col(s).alias("s"), F.col("_p").alias("p")), hot), "split-cuts")
        if _divide(cuts):
            return None
        rest = held.join(F.broadcast(hot.select("g")), F.col(s).eqNullSafe(F.col("g")), "left_semi").join(
            F.broadcast(cuts), F.col(s).eqNullSafe(F.col("g")), "left")
        done = done.unionByName(rest.select(s, *own, _by_cuts().alias(out), F.lit(False).alias("_shared")))
    done = materialize(done, "split-labelled", codec="zstd")
    return done.select(*needed, out) if done.where("_shared").isEmpty() else None


def _labelled(rows: DataFrame, cuts: DataFrame, stratum: Column, h: Column, columns: list[str], out: str,
              stored: DataFrame | None = None, needed: list[str] | None = None, follows: Sequence[str] = ()) -> DataFrame:
    """Label ``rows`` (with ``_p``, the bits of their hash ``h``) by the cuts of their stratum.

    ``stored``: the same rows with the columns ``needed`` alone, read where no key is divided.
    """
    # a stratum of no test and no val rows has no cuts
    joined = rows.join(cuts, stratum.eqNullSafe(F.col("g")), "left")
    label = _by_cuts()
    if not _divide(cuts):
        if stored is not None:
            joined = stored.join(cuts, stratum.eqNullSafe(F.col("g")), "left")
        return joined.withColumn(out, label).select(*(needed or columns), out)
    tied = F.coalesce((F.col("_p") == F.col("test.p")) & F.col("test.shared"), F.lit(False)) | \
        F.coalesce((F.col("_p") == F.col("val.p")) & F.col("val.shared"), F.lit(False))
    plain = joined.where(~tied).withColumn(out, label).select(*columns, out)
    # rows of bits that a cut divides, in the order of their hash and a hash of all their columns
    ranked = global_row_number(joined.where(tied).withColumn("_s", stratum).withColumn("_h", h).withColumn(
        "_all", F.xxhash64(*[F.col(f"`{c}`") for c in columns if c not in follows])), ["_s", "_p", "_h", "_all"], out="_rn")
    starts = materialize(ranked.groupBy(F.col("_s").alias("_s2"), F.col("_p").alias("_p2")).agg(F.min("_rn").alias("_r1")),
                         "tie-starts")
    ranked = ranked.join(starts, F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("_p") == F.col("_p2")))
    before = F.when(F.col("_p") == F.col("test.p"), F.col("test.before")).otherwise(F.col("val.before"))
    place = before + F.col("_rn") - F.col("_r1") + 1
    label = F.when(place <= F.col("q_test"), "test").when(place <= F.col("q_both"), "val").otherwise("train")
    return plain.unionByName(ranked.withColumn(out, label).select(*columns, out)).select(*(needed or columns), out)


def stratified_split(df: DataFrame, strata: str = "user_id", key: str = "k",
                     test: float = 0.1, val: float = 0.1, relative_to: str = "total",
                     seed: int = 42, out: str = "split", columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``out`` ∈ {train, val, test}, stratified on ``strata`` (exact quotas); of ``columns``, if named."""
    f_test = as_fraction(test)
    f_val = validation_fraction(test, val, relative_to)
    h = seeded_hash(seed, key)
    rows = df.withColumn("_p", narrow(h))
    held = None if columns is None else _stored(rows, list(dict.fromkeys([strata, *columns])), key, h)
    keys = (rows if columns is None else held).select(F.col(strata).alias("s"), F.col("_p").alias("p"))
    keys = materialize(keys, "split-keys") if columns is None else keys
    per = materialize(keys.groupBy(F.col("s").alias("g")).agg(F.count("*").alias("n")).withColumn(
        "_hs", seeded_hash(seed, "g")), "split-strata")
    per = _quota(per, "n", f_test, "q_test", "_hs").withColumn("_rest", F.col("n") - F.col("q_test"))
    per = _quota(per, "_rest", f_val, "_q_val", "_hs").withColumn("q_both", F.col("q_test") + F.col("_q_val"))
    per = per.select("g", "n", "q_test", "q_both")
    if columns is not None:
        done = _labelled_in_order(held, per, strata, list(columns), out)
        if done is not None:
            return done
    cuts = _cuts(keys, per)
    return _labelled(rows, cuts, F.col(strata), h, df.columns, out, held, columns and list(columns))


def random_split(df: DataFrame, key: str = "k", test: float = 0.1, val: float = 0.1,
                 relative_to: str = "remainder", seed: int = 42, out: str = "split",
                 columns: Sequence[str] | None = None, follows: Sequence[str] = ()) -> DataFrame:
    """Add ``out``: the first ceil(N·test) rows in seeded hash order are test,
    the next ceil(rest·f_val) are validation, the others train; of ``columns``, if named.

    ``follows``: columns that follow from others and have no say in the order of repeated keys.
    """
    f_test = as_fraction(test)
    f_val = validation_fraction(test, val, relative_to)
    h = seeded_hash(seed, key)
    rows = df.withColumn("_p", narrow(h))
    held = None if columns is None else _stored(rows, columns, key, h)
    keys = (rows if columns is None else held).select(F.lit(0).alias("s"), F.col("_p").alias("p"))
    keys = materialize(keys, "split-keys") if columns is None else keys
    n = keys.count()
    n_test = _ceil_share(n, f_test)
    n_both = n_test + _ceil_share(n - n_test, f_val)
    one = df.sparkSession.range(1).select(F.lit(0).alias("g"), F.lit(n).cast("long").alias("n"),
                                          F.lit(n_test).cast("long").alias("q_test"), F.lit(n_both).cast("long").alias("q_both"))
    cuts = materialize(_hot_cuts(keys, one), "split-cuts")
    return _labelled(rows, F.broadcast(cuts), F.lit(0), h, df.columns, out, held, columns and list(columns),
                     follows)  # one row


def _ceil_share(n: int, f: Fraction) -> int:
    return -(-n * f.numerator // f.denominator)


# --- class frequencies and weights --------------------------------------------

def class_frequency(df: DataFrame, label: str = "rating", classes=(1, 2, 3, 4, 5)) -> DataFrame:
    """(label, count) over the full class domain, zero-filled."""
    return value_counts(df, label, by="key", domain=list(classes))


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    """Stored (label, count), a row a class: its readers do not compute the rows again."""
    return materialize(df.groupBy(label).agg(F.count(F.lit(1)).alias("count")), "class-counts")


def balanced_class_weights(df: DataFrame, label: str = "rating") -> DataFrame:
    """(label, count, weight) with weight = n / (k · count), k = classes present."""
    counts = _class_counts(df, label)
    tot = counts.agg(F.sum("count").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return (counts.crossJoin(F.broadcast(tot))
            .select(label, "count", (F.col("_n") / (F.col("_k") * F.col("count"))).alias("weight"))
            .orderBy(label))


def inverse_frequency_weights(df: DataFrame, label: str = "rating") -> DataFrame:
    """(label, count, weight): w = 1/count, rescaled so the weights sum to k."""
    counts = _class_counts(df, label)
    return inverse_frequency_from_counts(counts, label, "count")


def inverse_frequency_from_counts(counts: DataFrame, label: str, count_col: str) -> DataFrame:
    """The same weights from an already aggregated (label, count) table."""
    w = counts.select(label, F.col(count_col).alias("count")).withColumn(
        "_w", F.lit(1.0) / F.col("count"))
    tot = w.agg(F.sum("_w").alias("_sw"), F.count(F.lit(1)).alias("_k"))
    return (w.crossJoin(F.broadcast(tot))  # one-row totals
            .select(label, "count", (F.col("_w") * F.col("_k") / F.col("_sw")).alias("weight"))
            .orderBy(label))


# --- epochs and batches ---------------------------------------------------------

def epoch_batches(df: DataFrame, key: str = "k", batch_size: int = 256, epoch: int = 0,
                  seed: int = 42, out: str = "batch_id", stored: bool = False) -> DataFrame:
    """Shuffle for one epoch and cut fixed-size batches (the last one smaller).

    The shuffle order is a seeded hash of (key, epoch), so each epoch gets a
    fresh, reproducible order; ``batch_id`` = (position − 1) div batch_size.
    ``stored``: rows that are read from a stored table need not be stored again.
    """
    h = seeded_hash(seed, key, F.lit(epoch))
    rows = df.withColumn("_p", narrow(h))
    ranked = global_row_number(rows, ["_p", h], out="_rn", stored=stored)  # the whole hash is compared only where its bits are equal
    return (ranked.withColumn(out, F.expr(f"(_rn - 1) div {int(batch_size)}"))
            .withColumnRenamed("_rn", "position").drop("_p"))


def first_n(df: DataFrame, n: int, order: str = "k") -> DataFrame:
    """The first ``n`` rows in key order (deterministic inspection sample)."""
    return df.orderBy(order).limit(n)

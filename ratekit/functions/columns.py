"""Scalar and array column functions (all built-in expressions, codegen-able).

Each function takes and returns ``Column`` objects so it can sit inside any
projection; none of them introduces a Python UDF.

Array functions accept an optional ``size``.  With it, the expression is
unrolled element by element; Spark's higher-order functions (``transform``,
``aggregate``, ``zip_with``) are evaluated without code generation and hide
common subexpressions, so the unrolled form is several times faster for
short fixed-length arrays (class probabilities, factor vectors).  Without a
size the higher-order form handles any length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

RELEASE_DATE_FORMAT = "d-MMM-yyyy"  # one- or two-digit day, e.g. 4-Feb-1971


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- dates -----------------------------------------------------------------

def date_text_to_epoch(col: str | Column, fmt: str = RELEASE_DATE_FORMAT) -> Column:
    """Text date → unix seconds (BIGINT).  Null stays null; text that does not
    parse raises under ANSI mode (the session default), like a strict parse."""
    return F.unix_timestamp(_c(col), fmt)


# --- rating classes ----------------------------------------------------------

def rating_to_class(col: str | Column) -> Column:
    """Rating 1..5 → zero-based class 0..4."""
    return (_c(col) - 1).cast("int")


def class_to_rating(col: str | Column) -> Column:
    """Zero-based class → rating."""
    return (_c(col) + 1).cast("int")


def round_clip_rating(col: str | Column, lo: int = 1, hi: int = 5) -> Column:
    """Round half to even, then clip to [lo, hi]; returns INT."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), F.rint(_c(col)).cast("int")))


def argmax_class(probs: str | Column) -> Column:
    """Zero-based index of the largest entry; the first one wins a tie."""
    p = _c(probs)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def _items(col: str | Column, size: int) -> list[Column]:
    c = _c(col)
    return [c[i] for i in range(size)]


def _total(xs: list[Column]) -> Column:
    """Left-to-right sum (the same order as an ``aggregate`` fold)."""
    return reduce(lambda a, b: a + b, xs)


def softmax(logits: str | Column, size: int | None = None) -> Column:
    """exp(x - max) / Σ exp(x - max) over an array column."""
    if size:
        xs = _items(logits, size)
        m = F.greatest(*xs) if size > 1 else xs[0]
        es = [F.exp(x - m) for x in xs]
        t = _total(es)
        return F.array(*[e / t for e in es])
    x = _c(logits)
    m = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda v: v / total)


def expected_rating(probs: str | Column, size: int | None = None) -> Column:
    """Σ p_i · (i + 1) over the class probabilities (ratings 1..n)."""
    if size:
        return _total([p * F.lit(float(i + 1)) for i, p in enumerate(_items(probs, size))])
    weighted = F.transform(_c(probs), lambda p, i: p * (i + 1))
    return F.aggregate(weighted, F.lit(0.0), lambda acc, v: acc + v)


def scaled_sigmoid(col: str | Column, scale: float | Column = 4.0,
                   shift: float | Column = 1.0) -> Column:
    """scale · sigmoid(x) + shift (maps the real line onto (shift, shift+scale))."""
    sc = scale if isinstance(scale, Column) else F.lit(float(scale))
    sh = shift if isinstance(shift, Column) else F.lit(float(shift))
    return sc / (F.lit(1.0) + F.exp(-_c(col))) + sh


def one_vs_rest_label(actual: str | Column, cls: str | Column) -> Column:
    """1 when the row belongs to the class, else 0."""
    return (_c(actual) == _c(cls)).cast("int")


def distance_score(prediction: str | Column, cls: str | Column) -> Column:
    """Class score from a scalar prediction: −|prediction − class|."""
    return -F.abs(_c(prediction) - _c(cls))


# --- vectors -----------------------------------------------------------------

def hadamard(u: str | Column, v: str | Column, size: int | None = None) -> Column:
    """Element-wise product of two equally long arrays (GMF interaction)."""
    if size:
        return F.array(*[a * b for a, b in zip(_items(u, size), _items(v, size))])
    return F.zip_with(_c(u), _c(v), lambda a, b: a * b)


def vector_sum(v: str | Column, size: int | None = None) -> Column:
    if size:
        return _total(_items(v, size))
    return F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x)


def dot(u: str | Column, v: str | Column, size: int | None = None) -> Column:
    if size:
        return _total([a * b for a, b in zip(_items(u, size), _items(v, size))])
    return vector_sum(hadamard(u, v))


def l2_norm(v: str | Column, size: int | None = None) -> Column:
    if size:
        return F.sqrt(_total([x * x for x in _items(v, size)]))
    return F.sqrt(F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x * x))


def concat_vectors(*vs: str | Column) -> Column:
    return F.concat(*[_c(v) for v in vs])


def max_norm_clip(v: str | Column, max_norm: float = 1.0) -> Column:
    """Rescale a vector whose L2 norm exceeds ``max_norm`` onto the sphere."""
    n = l2_norm(v)
    factor = F.when(n > max_norm, F.lit(max_norm) / n).otherwise(F.lit(1.0))
    return F.transform(_c(v), lambda x: x * factor)


def cast_vector(v: str | Column, to: str = "double", size: int | None = None) -> Column:
    if size:
        return F.array(*[x.cast(to) for x in _items(v, size)])
    return F.transform(_c(v), lambda x: x.cast(to))


def display_bucket(id_col: str | Column, n_distinct: Column, buckets: int = 10) -> Column:
    """``id % buckets`` when there are more than ``buckets`` distinct ids, else the id."""
    return F.when(n_distinct > buckets, F.pmod(_c(id_col), F.lit(buckets))).otherwise(_c(id_col))


# --- stable pseudo-random numbers --------------------------------------------

def hash_uniform(*parts: str | Column) -> Column:
    """Uniform in (0, 1) from an md5 of the parts: stable under repartitioning
    and recomputation (unlike ``rand``).  52 bits of the digest are used."""
    text = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def hash_normal(*parts: str | Column) -> Column:
    """Standard normal via Box–Muller over two independent hash uniforms."""
    u1 = hash_uniform(*parts, F.lit("u1"))
    u2 = hash_uniform(*parts, F.lit("u2"))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)

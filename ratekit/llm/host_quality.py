r"""Quality rules with host-level verdicts.

Each document is measured by its own words and fails the base rules if it
is too short or repeats itself.  Failures are counted by host, each host's
failure rate is shrunk towards the corpus by an empirical beta prior (a
small host cannot be condemned by one bad page), and hosts whose shrunk
rate is over ``max_rate`` are rejected with all their documents.

Spark does the counting and joining; a pandas UDF measures one text at a
time, so memory is bounded by an Arrow batch and no text is shuffled.  The
host table is stored and joined back: broadcast if it is small on disk,
else by a shuffled join whose skewed hosts AQE splits.

Defined results: a null or empty text has no words, all counts are 0 and
it fails; a document whose host is null is judged by the base rules only;
repeated rows are judged each; an empty table gives an empty result; the
table's own columns are kept whatever they are called.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize
from .common import bounded_batches, packed

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5
MAX_RATE = 0.5
#: Bounds of the prior's strength, in documents.
STRENGTH = (1.0, 10_000.0)

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MEASURES = StructType([StructField(c, LongType()) for c in _COUNTS])


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    parts = raw.split()
    blanks = len(raw) - len(raw.translate(None, _SPACE))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (len(parts), len(text) - blanks, symbols, len(lines) - len(set(lines)),
            repeated_words(parts))


def repeated_words(parts: list[bytes], size: int = WINDOW) -> int:
    """Words inside a window of ``size`` words that occurs twice or more in ``parts``."""
    windows = list(zip(*(parts[j:] for j in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, upto = 0, 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + size - max(start, upto)
            upto = start + size
    return covered


@F.pandas_udf(_MEASURES)
def _measured(texts: pd.Series) -> pd.DataFrame:
    rows = [measure(t) for t in texts]
    return pd.DataFrame(rows, columns=_COUNTS, dtype="int64")


def _with_counts(rows: DataFrame, min_words: int, max_repeat_pct: int) -> DataFrame:
    bounded_batches(rows.sparkSession)
    counted = rows.withColumn("m", _measured("text"))
    return counted.withColumn("base_failed", (F.col("m.n_words") < min_words) | (
        100 * F.col("m.n_repeat_words") > max_repeat_pct * F.col("m.n_words")))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(mean, strength) of the beta prior that the hosts' rates suggest, by moments.

    ``hosts`` has n_docs and n_failed; the answer is one row of sums.
    """
    sums = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f")).first()
    if not sums["n"]:
        return 0.0, STRENGTH[1]
    mean = sums["f"] / sums["n"]
    spread = hosts.agg((F.sum(F.col("n_docs") * F.pow(F.col("n_failed") / F.col("n_docs") - mean, 2))
                        / sums["n"]).alias("v")).first()["v"]
    if spread <= 0:
        return mean, STRENGTH[1]
    return mean, min(max(mean * (1 - mean) / spread - 1, STRENGTH[0]), STRENGTH[1])


def host_verdicts(docs: DataFrame, text: str = "text", host: str = "source",
                  min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
                  max_rate: float = MAX_RATE) -> DataFrame:
    """host, n_docs, n_failed, host_rate, host_rejected: one stored row per host."""
    rows = docs.select(F.col(text).alias("text"), F.col(host).cast("string").alias("host"))
    failed = _with_counts(rows.where("host IS NOT NULL"), min_words, max_repeat_pct)
    hosts = materialize(failed.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")),
        "host-failures")
    mean, strength = beta_prior(hosts)
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return materialize(hosts.withColumn("host_rate", rate)
                       .withColumn("host_rejected", F.col("host_rate") > max_rate), "host-verdicts")


def host_quality(docs: DataFrame, text: str = "text", host: str = "source",
                 min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
                 max_rate: float = MAX_RATE) -> DataFrame:
    """``row`` (the document) and its measures, base_failed, host_rate, host_rejected, kept."""
    verdicts = host_verdicts(docs, text, host, min_words, max_repeat_pct, max_rate)
    rows = packed(docs, text=text, host=host).withColumn("host", F.col("host").cast("string"))
    joined = _with_counts(rows, min_words, max_repeat_pct).join(
        verdicts.select("host", "host_rate", "host_rejected"), "host", "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.select("row", "host", "m.*", "base_failed", "host_rate",
                         rejected.alias("host_rejected"),
                         (~F.col("base_failed") & ~rejected).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", **rules) -> DataFrame:
    """The documents that pass their own and their host's rules, columns unchanged."""
    return host_quality(docs, text, host, **rules).where("kept").select("row.*")

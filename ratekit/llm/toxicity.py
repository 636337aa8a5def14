r"""Toxicity scores from a bidirectional gated recurrent network in numpy.

A word's input vector is a row of a hashed word table plus the sum, over the
root of their number, of rows of a hashed table of its character 4-grams
(over UTF-8 bytes, with word borders), so spelling variants of a stem share their input.  A GRU reads a
window of ``WINDOW`` words in both directions, attention pools its states, and
a linear layer gives the window's logit.  Windows overlap (one starts every
``STRIDE`` words) and cover the whole text; a document's logit is that of its
worst window.

Training fits a documented, bounded sample, at most ``MAX_PER_CLASS`` labelled
documents of each class in the order of a hash of their ids, all words of
them.  Only the text is an input.  A step takes each document's worst
window, by the network so far, and back-propagates through it (multiple
instances, one label), with Adam; word rows are dropped half of the time so that
characters are learnt too.  Everything is seeded.

Scoring is a map over documents in bounded Arrow batches; the network (about
3 MB) is broadcast.  No shuffle of texts: the sample's ids, at most
2 * MAX_PER_CLASS, are broadcast to find their texts.

Defined results: a null or empty text, or one without words, is scored as an
empty window; without labelled rows of both classes the score is 1 where all
labels are 1, else 0; null labels and null ids are not learnt from;
repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import bounded_batches
from .license_scan import normal_words

WINDOW, STRIDE = 48, 24
MAX_PER_CLASS = 1000
EPOCHS, BATCH, RATE = 6, 40, 0.01
WORD_SCALE, GRAM_SCALE = 6, 10
SEED = 11
#: Rows of the two tables, input size, states per direction, attention size.
WORD_ROWS, GRAM_ROWS, INPUT, STATE, ATTENTION = 1 << 14, 1 << 15, 16, 10, 10
#: A longer word is read as pieces of so many bytes.
PIECE = 64
#: Words whose inputs one scoring pass holds, and windows run at once.
WORDS_AT_ONCE, WINDOWS_AT_ONCE = 60_000, 2048

_GRAM = np.array([1, 257, 66_049, 16_974_593], np.uint64)  # powers of 257: four bytes make one number
_LOOKUP = np.uint64(0x9E3779B97F4A7C15)


def text_words(text: str | None) -> list[bytes]:
    words = normal_words(text)
    if any(len(w) > PIECE for w in words):
        words = [w[i:i + PIECE] for w in words for i in range(0, len(w), PIECE)]
    return words


def rows_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows, rows of all 4-grams end to end, and where each word's grams start."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(b"<" + w + b">>" for w in words), np.uint8).astype(np.uint64)
    starts = np.cumsum(lengths + 3) - (lengths + 3)
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)
    grams = sum(flat[at + k] * _GRAM[k] for k in range(4))
    gram_rows = ((grams * _LOOKUP) >> np.uint64(64 - 15)).astype(np.int64) % GRAM_ROWS
    word_rows = np.fromiter((xxhash.xxh3_64_intdigest(w) % WORD_ROWS for w in words), np.int64, len(words))
    return word_rows, gram_rows, first


def windows_of(n: int) -> np.ndarray:
    """Starts of the overlapping windows that cover ``n`` words; none for no words."""
    return np.arange(0, max(n - WINDOW, 0) + STRIDE, STRIDE) if n else np.empty(0, np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    def __init__(self, seed: int = SEED):
        rng = np.random.Generator(np.random.PCG64(seed))

        def draw(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"words": draw(WORD_ROWS, INPUT) * WORD_SCALE, "grams": draw(GRAM_ROWS, INPUT) * GRAM_SCALE,
                  "attend": draw(2 * STATE, ATTENTION), "attend_b": np.zeros(ATTENTION, np.float32),
                  "attend_v": draw(ATTENTION, 1)[:, 0], "out": draw(2 * STATE, 1)[:, 0],
                  "out_b": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"{d}_in": draw(INPUT, 3 * STATE), f"{d}_state": draw(STATE, 3 * STATE),
                       f"{d}_b": np.zeros(3 * STATE, np.float32)}

    def inputs(self, words: list[bytes], drop: np.ndarray | None = None):
        """Input vector of each word, and the rows they come from."""
        word_rows, gram_rows, first = rows_of(words)
        counts = np.diff(np.append(first, len(gram_rows))).astype(np.float32)
        x = np.add.reduceat(self.p["grams"][gram_rows], first, axis=0) / np.sqrt(counts)[:, None]
        own = self.p["words"][word_rows]
        return x + (own if drop is None else own * drop[:, None]), (word_rows, gram_rows, counts)

    def _read(self, d: str, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool):
        """States of one direction over windows ``at`` (rows of ``gates``); with ``keep``, what backward needs."""
        u = self.p[f"{d}_state"]
        n, width = at.shape
        h, states, kept = np.zeros((n, STATE), np.float32), np.empty((width, n, STATE), np.float32), []
        for t in range(width) if d == "f" else range(width - 1, -1, -1):
            g, hu = gates[at[:, t]], h @ u
            zr = _sigmoid(g[:, :2 * STATE] + hu[:, :2 * STATE])
            z, r = zr[:, :STATE], zr[:, STATE:]
            new = np.tanh(g[:, 2 * STATE:] + r * hu[:, 2 * STATE:])
            step = (new + z * (h - new) - h) * mask[:, t, None]
            if keep:
                kept.append((t, h, z, r, new, hu[:, 2 * STATE:]))
            h = h + step
            states[t] = h
        return states, kept

    def forward(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logit of each window; ``at`` holds rows of ``x``, ``mask`` 0 where a window has ended."""
        sides = [self._read(d, x @ self.p[f"{d}_in"] + self.p[f"{d}_b"], at, mask, keep) for d in "fb"]
        states = np.concatenate([s for s, _ in sides], axis=2)
        hidden = np.tanh(states @ self.p["attend"] + self.p["attend_b"])
        scores = hidden @ self.p["attend_v"] + (mask.T - 1) * 1e4
        weight = np.exp(scores - scores.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["out_b"][0]
        return (logit, (sides, states, hidden, weight, pooled)) if keep else logit

    def gradients(self, x, at, mask, target):
        """Gradients of the logistic loss, and that of the inputs."""
        logit, (sides, states, hidden, weight, pooled) = self.forward(x, at, mask, keep=True)
        d_logit = ((_sigmoid(logit) - target) / len(target)).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(axis=2)
        d_scores = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["attend_v"] = np.einsum("tna,tn->a", hidden, d_scores)
        d_hidden = d_scores[:, :, None] * self.p["attend_v"] * (1 - hidden ** 2)
        g["attend"] = np.einsum("tns,tna->sa", states, d_hidden)
        g["attend_b"] = d_hidden.sum(axis=(0, 1))
        d_states = d_states + d_hidden @ self.p["attend"].T
        d_x = np.zeros_like(x)
        for i, d in enumerate("fb"):
            u, d_u = self.p[f"{d}_state"], np.zeros_like(self.p[f"{d}_state"])
            d_gates, d_h = np.zeros((len(x), 3 * STATE), np.float32), np.zeros((at.shape[0], STATE), np.float32)
            for t, h, z, r, new, hn in reversed(sides[i][1]):
                d_out = d_h + d_states[t, :, i * STATE:(i + 1) * STATE]
                d_step = d_out * mask[:, t, None]
                d_new = d_step * (1 - z) * (1 - new ** 2)
                d_z = d_step * (h - new) * z * (1 - z)
                d_r = d_new * hn * r * (1 - r)
                d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(d_gates, at[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
                d_u += h.T @ d_hu
                d_h = d_out - d_step + d_step * z + d_hu @ u.T
            g[f"{d}_state"], g[f"{d}_in"], g[f"{d}_b"] = d_u, x.T @ d_gates, d_gates.sum(axis=0)
            d_x += d_gates @ self.p[f"{d}_in"].T
        return g, d_x

    def logits(self, documents: list[list[bytes]]) -> list[np.ndarray]:
        """The logit of every window of every document; one for an empty document."""
        index: dict[bytes, int] = {}
        places = [np.fromiter((index.setdefault(w, len(index)) for w in d), np.int64, len(d)) for d in documents]
        x = np.concatenate([self.inputs(list(index))[0] if index else np.empty((0, INPUT), np.float32),
                            np.zeros((1, INPUT), np.float32)])
        starts = [windows_of(len(p)) if len(p) else np.zeros(1, np.int64) for p in places]
        at, mask = _window_rows(places, starts, len(x) - 1)
        out = np.concatenate([self.forward(x, at[i:i + WINDOWS_AT_ONCE], mask[i:i + WINDOWS_AT_ONCE])
                              for i in range(0, len(at), WINDOWS_AT_ONCE)])
        return np.split(out, np.cumsum([len(s) for s in starts])[:-1])


def _window_rows(places: list[np.ndarray], starts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each window's words, ``pad`` beyond its document, and 1 where there is a word."""
    at, mask = [], []
    for p, s in zip(places, starts):
        spots = s[:, None] + np.arange(WINDOW)
        inside = spots < len(p)
        row = np.full(spots.shape, pad)
        row[inside] = p[spots[inside]]
        inside[:, 0] = True  # an empty window reads one blank
        at.append(row)
        mask.append(inside)
    return np.concatenate(at), np.concatenate(mask).astype(np.float32)


def fit(texts: list[str | None], labels: list[int], seed: int = SEED) -> Network:
    """A network fitted to the whole texts of labelled documents."""
    rng = np.random.Generator(np.random.PCG64(seed))
    net, documents, target = Network(seed), [text_words(t) for t in texts], np.array(labels, np.float32)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    steps, total = 0, EPOCHS * -(-len(documents) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(documents))
        for i in range(0, len(order), BATCH):
            chosen = order[i:i + BATCH]
            batch = [documents[j] for j in chosen]
            worst = [int(w.argmax()) * STRIDE for w in net.logits(batch)]
            parts = [d[s:s + WINDOW] for d, s in zip(batch, worst)]
            index: dict[bytes, int] = {}
            places = [np.fromiter((index.setdefault(w, len(index)) for w in p), np.int64, len(p)) for p in parts]
            if not index:
                continue
            drop = (rng.random(len(index)) < 0.5).astype(np.float32) * 2
            x, (word_rows, gram_rows, counts) = net.inputs(list(index), drop)
            padded = np.concatenate([x, np.zeros((1, INPUT), np.float32)])
            at, mask = _window_rows(places, [np.zeros(1, np.int64)] * len(parts), len(x))
            g, d_x = net.gradients(padded, at, mask, target[chosen])
            d_x = d_x[:-1]
            g["words"], g["grams"] = np.zeros_like(net.p["words"]), np.zeros_like(net.p["grams"])
            np.add.at(g["words"], word_rows, d_x * drop[:, None])
            np.add.at(g["grams"], gram_rows, np.repeat(d_x / np.sqrt(counts)[:, None], counts.astype(np.int64), axis=0))
            steps += 1
            rate = RATE * min(1, 2 * (1 - steps / (total + 1)))
            for k, v in net.p.items():
                m, s = moments[k]
                m += 0.1 * (g[k] - m)
                s += 0.001 * (g[k] ** 2 - s)
                v -= rate * (m / (1 - 0.9 ** steps)) / (np.sqrt(s / (1 - 0.999 ** steps)) + 1e-8)
    return net


def score_texts(net: Network, texts: list[str | None]) -> np.ndarray:
    """Score of each text in order, in groups of a bounded number of words."""
    out, group, size = [], [], 0
    for text in texts:
        group.append(text_words(text))
        size += len(group[-1])
        if size >= WORDS_AT_ONCE:
            out += [w.max() for w in _long_logits(net, group)]
            group, size = [], 0
    if group:
        out += [w.max() for w in _long_logits(net, group)]
    return _sigmoid(np.array(out, np.float64)) if out else np.empty(0)


def _long_logits(net: Network, group: list[list[bytes]]) -> list[np.ndarray]:
    """Logits of a group; a document of very many words is read in pieces that overlap by a window."""
    if len(group) > 1 or len(group[0]) <= 2 * WORDS_AT_ONCE:
        return net.logits(group)
    step = WORDS_AT_ONCE // STRIDE * STRIDE
    pieces = [group[0][i:i + step + WINDOW] for i in range(0, len(group[0]), step)]
    return [np.concatenate([net.logits([p])[0] for p in pieces])]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label: str = "toxic", max_per_class: int = MAX_PER_CLASS) -> list[tuple[str, int]]:
    """At most ``max_per_class`` (text, label) of each class, in the order of a hash of the id."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")) \
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id"))).distinct()
    order = [F.xxhash64("id"), F.col("id")]
    picked = [known.where(F.col("label") == c).orderBy(*order).limit(max_per_class) for c in (0, 1)]
    ids = picked[0].unionByName(picked[1])
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")
    found = rows.dropDuplicates(["id", "label"]).select("id", "text", "label").collect()  # 2 * max_per_class at most
    return [(r["text"], r["label"]) for r in sorted(found, key=lambda r: (r["id"], r["label"]))]


def with_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                label: str = "toxic", into: str = "toxicity", max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """``docs`` with a score from 0 to 1 in column ``into`` (added, or replaced if it is there)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = training_rows(docs, labels, doc_id, text, label, max_per_class)
    classes = {y for _, y in rows}
    if len(classes) < 2:
        return docs.withColumn(into, F.lit(1.0 if classes == {1} else 0.0))
    shared = spark.sparkContext.broadcast(fit(*map(list, zip(*rows))))

    @F.pandas_udf(DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score_texts(shared.value, texts.tolist()))

    return docs.withColumn(into, scored(F.col(text)))

import random
import zlib

import numpy as np
from ratekit.llm import toxicity as TX
from ratekit.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(np.argsort(score))
    n = label.sum()
    return (order[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def test_query_on_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = QUERIES["op7_toxicity"](spark, SF).collect()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in labels]
    score, label = np.array([r.score for r in held]), np.array([labels[r.doc_id] for r in held])
    assert ((score >= 0.5) == label).mean() > 0.95 and auc(score, label) > 0.93


def slow_logit(net, words):
    """One window's logit, written out step by step."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    sig = lambda v: 1 / (1 + np.exp(-v))
    x = net.inputs(words)[0].astype(np.float64)
    sides, k = [], TX.STATE
    for d in "fb":
        h, states = np.zeros(k), []
        for v in x if d == "f" else x[::-1]:
            g, u = v @ p[f"{d}_in"] + p[f"{d}_b"], h @ p[f"{d}_state"]
            z, r = sig(g[:k] + u[:k]), sig(g[k:2 * k] + u[k:2 * k])
            h = (1 - z) * np.tanh(g[2 * k:] + r * u[2 * k:]) + z * h
            states.append(h)
        sides.append(states if d == "f" else states[::-1])
    s = np.concatenate([np.array(a) for a in sides], axis=1)
    e = np.exp(np.tanh(s @ p["attend"] + p["attend_b"]) @ p["attend_v"])
    return (e / e.sum()) @ s @ p["out"] + p["out_b"][0]


def test_forward_equals_the_plain_recurrence_over_all_windows():
    rng, net = random.Random(1), TX.Network(3)
    docs = [[b"w%d" % rng.randrange(50) for _ in range(n)] for n in (1, 5, 48, 49, 200)]
    for words, got in zip(docs, net.logits(docs)):
        starts = TX.windows_of(len(words))
        assert starts[-1] + TX.WINDOW >= len(words)
        want = [slow_logit(net, words[s:s + TX.WINDOW]) for s in starts]
        np.testing.assert_allclose(got, want, rtol=1e-3, atol=1e-4)


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    net = TX.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.standard_normal((7, TX.INPUT))
    at, mask = rng.integers(0, 7, (3, 6)), np.ones((3, 6))
    mask[0, 4:] = 0
    target = np.array([1.0, 0.0, 1.0])

    def loss():
        logit = net.forward(x, at, mask)
        return np.mean(np.log1p(np.exp(logit)) - target * logit)

    g, d_x = net.gradients(x, at, mask, target)
    for name in ("f_state", "b_in", "f_b", "attend", "attend_v", "out"):
        flat = net.p[name].reshape(-1)
        for i in rng.integers(0, flat.size, 4):
            old, step = flat[i], 1e-2
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * step) - np.asarray(g[name]).reshape(-1)[i]) < 2e-4
    x[2, 3] += 1e-2
    up = loss()
    x[2, 3] -= 2e-2
    assert abs((up - loss()) / 2e-2 - d_x[2, 3]) < 2e-4


def test_long_texts_in_pieces_give_the_same(monkeypatch):
    net, words = TX.Network(3), " ".join(f"w{i % 97}" for i in range(3000))
    whole = TX.score_texts(net, [words, "short", None])
    monkeypatch.setattr(TX, "WORDS_AT_ONCE", 240)
    np.testing.assert_allclose(TX.score_texts(net, [words, "short", None]), whole, rtol=1e-5)


def test_nulls_one_class_no_labels_and_empty_table(spark, docs_of, monkeypatch):
    monkeypatch.setattr(TX, "EPOCHS", 1)
    docs = docs_of([(i, "you stupid clown" if i % 2 else "a fine day") for i in range(40)] + [(None, "x"), (41, None), (41, "")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (41, None)], "doc_id long, toxic int")
    out = TX.with_scores(docs, labels, into="kept")
    assert out.columns == docs.columns and all(0 <= r.kept <= 1 for r in out.collect()) and out.count() == 43
    assert {r.toxicity for r in TX.with_scores(docs, labels.where("toxic = 1")).collect()} == {1.0}
    assert {r.toxicity for r in TX.with_scores(docs, labels.limit(0)).collect()} == {0.0}
    assert TX.with_scores(docs.limit(0), labels).count() == 0

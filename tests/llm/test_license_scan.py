import random
import re

from llm_helpers import SF
from ratekit.llm import license_scan as LS
from ratekit.llm.queries import QUERIES


def normal(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text):
    """license -> matches, by verifying every window at every word against every template."""
    w, out = normal(text), []
    for name, wording in LS.TEMPLATES.items():
        v = normal(wording)
        k = min(5, len(v))
        own = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)}
        n, stride = len(v) - k + 1, max(1, len(v) // 8)
        span = n + max(n // 4, 1) + stride
        every = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
        merged = []
        for s in range(0, len(every)):
            hit = [i for i in range(s, min(s + span, len(every))) if every[i] in own]
            c = len({every[i] for i in hit}) / len(own)
            if c >= LS.MIN_CONTAINED:
                a, b = hit[0], hit[-1] + k
                if merged and a < merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(b, merged[-1][1]), max(c, merged[-1][2]))
                else:
                    merged.append((a, b, c))
        out += [(name, a, b - a, c) for a, b, c in merged]
    return sorted(out, key=lambda m: (m[1], m[0]))


def cases():
    rng = random.Random(2)
    vocab = ["the", "license", "of", "software", "Über", "free", "x1", "permission", "and", "reserved"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    texts = [None, "", " . ", "All rights", "All rights reserved.", "ALL RIGHTS\nRESERVED all rights reserved"]
    for wording in LS.TEMPLATES.values():
        texts.append(say(rng.randrange(0, 60)) + ". " + wording + " " + say(rng.randrange(0, 60)))
        words = wording.split(" ")
        if len(words) > 20:
            words[rng.randrange(len(words))] = "changed"
            texts.append(say(400) + "\n# " + "\n# ".join(words).upper() + "\n" + say(3))
            texts.append(" ".join(words[: len(words) // 2]))
    return texts + [say(3000), say(9000) + " " + LS.TEMPLATES["mit-text"] + say(30) + " " + LS.TEMPLATES["mit-text"]]


def near(a, b):
    """Same licences; the same place up to the words that only some overlapping window saw."""
    return [(x[0], abs(x[1] - y[1]) <= 12, abs(x[3] - y[3]) < 0.2) for x, y in zip(a, b)] == [
        (y[0], True, True) for y in b] and len(a) == len(b)


def test_matches_brute_force_over_every_window():
    texts = cases()
    for chunk in (LS.CHUNK, 64):
        scanner, LS.CHUNK = LS.Scanner(LS.TEMPLATES, LS.MIN_CONTAINED), chunk
        try:
            for t, found in zip(texts, scanner.scan(texts)):
                assert near(found, brute(t)), (t, found, brute(t))
        finally:
            LS.CHUNK = 1 << 14


def test_exact_copies_are_found_where_they_stand():
    scanner = LS.Scanner(LS.TEMPLATES, LS.MIN_CONTAINED)
    for name, wording in LS.TEMPLATES.items():
        found = scanner.scan(["zz " * 77 + wording + " yy" * 50])[0]
        assert (name, 77, len(normal(wording)), 1.0) in found


def test_query_over_the_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = {r.doc_id: r for r in QUERIES["op10_license_scan"](spark, SF).collect()}
    assert out.keys() == docs.keys()
    for i, t in docs.items():
        assert out[i].licenses == ",".join(sorted({m[0] for m in brute(t)}))
    assert any(r.n_matches for r in out.values())


def test_nulls_repeats_empty_table_and_clashing_names(spark, docs_of):
    text = "x. All rights reserved."
    docs = docs_of([(1, text), (1, text), (None, None), (2, "")]).withColumnRenamed("lang", "licenses")
    out = LS.with_licenses(docs)
    assert out.columns == docs.columns
    assert sorted(len(r.licenses) for r in out.collect()) == [0, 0, 1, 1]
    assert LS.with_licenses(docs.limit(0)).count() == 0

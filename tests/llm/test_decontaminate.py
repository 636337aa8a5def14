import random
import re

from llm_helpers import compare
from ratekit.llm import decontaminate as DC
from ratekit.llm.queries import ORACLE_SQL, QUERIES


def normal_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    w, hit, found = normal_words(text), set(), set()
    for item, t in items:
        v = normal_words(t)
        k = min(13, len(v))
        windows = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i:i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def cases():
    rng = random.Random(5)
    vocab = ["the", "of", "Über", "éclair", "ΣΑΣ", "x9", "longerword", "K", "İn", "and", "or2"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.choice([14, 20, 40]))) for i in range(10)]
    items += [(10, "Seven little words, that is all."), (11, items[0][1]), (12, None), (13, ""), (14, "??"),
              (100, items[1][1] + " " + say(5)), (15, "the the the the the the the the the the the the the the")]
    docs = []
    for i in range(60):
        base = say(rng.choice([3, 30, 200]))
        if i % 3 == 0:
            t = items[rng.randrange(10)][1]
            at = rng.randrange(max(1, len(t) // 2))
            base += "; " + t[at:].upper() if i % 2 else " -- " + t
        docs.append((i, base))
    docs += [(60, None), (61, ""), (62, "!?"), (None, items[0][1]), (None, None), (63, "seven, LITTLE words that is ALL"),
             (64, "the " * 30), (64, "the " * 30), (64, "nothing here"), (65, "so " * 50_000 + items[2][1])]
    return docs, items


def test_counts_match_brute_force(spark, docs_of):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = DC.contamination(docs_of(docs), bench).collect()
    got = sorted(repr((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated)) for r in out)
    assert got == sorted(repr((i, *brute(t, items))) for i, t in docs)


def test_dropping_and_cutting(spark, docs_of):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = docs_of(docs)
    kept = DC.drop_contaminated(table, bench)
    assert kept.columns == table.columns
    want = sorted(repr((i, t)) for i, t in docs if not brute(t, items)[3])
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == want
    cut = DC.cut_spans(table, bench)
    assert cut.columns == table.columns and cut.count() == len(docs)
    by_id = {r.doc_id: r.text for r in cut.collect()}
    assert by_id[60] is None and by_id[63] == "" and by_id[62] == "!?"
    for i, t in docs:
        n_words, n_hit = brute(t, items)[:2]
        if i is not None and i != 64:
            assert len(normal_words(by_id[i])) == n_words - n_hit


def test_blocks_of_windows_give_the_same(spark, docs_of, monkeypatch):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(DC, "BROADCAST_BYTES", 40_000)
    out = DC.contamination(docs_of(docs), bench).collect()
    got = sorted(repr((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated)) for r in out)
    assert got == sorted(repr((i, *brute(t, items))) for i, t in docs)


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = docs_of([(1, "a b c"), (2, "d")])
    assert DC.contamination(docs.limit(0), bench).count() == 0
    assert [r.n_hit for r in DC.contamination(docs, bench.limit(0)).collect()] == [0, 0]
    assert DC.drop_contaminated(docs, bench.limit(0)).count() == 2


def test_query_matches_sql_and_runs_no_python(spark, duck):
    compare(spark, duck, "op6_decontaminate", QUERIES, ORACLE_SQL)


def test_windows_in_measured_blocks_with_a_very_long_word(spark, docs_of, monkeypatch):
    monkeypatch.setattr(DC, "BROADCAST_BYTES", 8 << 20)
    long = "x" * 1_000_000
    passage = " ".join(f"p{i}" for i in range(8)) + f" {long} " + " ".join(f"q{i}" for i in range(8))
    items = [(1, passage), (2, " ".join(f"r{i}" for i in range(20)))]
    docs = [(1, "before " + passage + " after"), (2, "x" * 999_999 + " p1 p2"), (3, items[1][1]), (4, long)]
    out = DC.contamination(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = sorted(repr((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated)) for r in out)
    assert got == sorted(repr((i, *brute(t, items))) for i, t in docs)

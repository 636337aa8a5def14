from collections import Counter

from llm_helpers import compare
from ratekit.llm import host_quality as HQ
from ratekit.llm.queries import ORACLE_SQL, QUERIES


def brute(text):
    w = [x for x in "".join(c if c not in " \t\n\r\x0b\x0c" else " " for c in text or "").split(" ") if x]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    counts = Counter(windows)
    covered = {i + j for i, g in enumerate(windows) if counts[g] > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_measures_match_brute_force():
    texts = [None, "", " \n\t", "a", "a b c d e a b c d e", "a a a a a a a", "x\ny\nx\n\n \n", "é\x85ü\x1cz # & <b>",
             "w " * 5000, " ".join(f"v{i % 7}" for i in range(60)), "q q " * 9]
    for t in texts:
        assert HQ.measure(t) == brute(t)


def test_query_matches_sql(spark, duck):
    compare(spark, duck, "op2_host_quality", QUERIES, ORACLE_SQL)


GOOD = "these are twelve quite different words which nobody would ever call repeated junk"


def test_bad_host_takes_its_good_documents_with_it(spark, docs_of):
    rows = [(i, "bad", "junk") for i in range(90)] + [(90 + i, GOOD, "junk") for i in range(10)]
    rows += [(100 + i, GOOD, "fine") for i in range(100)] + [(200, "bad", "tiny"), (201, GOOD, "tiny")]
    rows += [(300, GOOD, None), (301, None, None), (302, "", "fine"), (None, GOOD, "fine"), (100, GOOD, "fine")]
    docs = docs_of(rows)
    out = HQ.host_quality(docs).collect()
    assert len(out) == len(rows)
    kept = Counter((r.host, r.kept) for r in out)
    assert kept[("junk", True)] == 0 and kept[("fine", True)] == 102 and kept[("fine", False)] == 1
    # one failure of two does not condemn a host against a corpus that mostly passes
    assert kept[("tiny", True)] == 1
    assert kept[(None, True)] == 1 and kept[(None, False)] == 1
    good = HQ.keep_good(docs)
    assert good.columns == docs.columns and good.count() == sum(r.kept for r in out)


def test_empty_table_and_very_long_text(spark, docs_of):
    assert HQ.host_quality(docs_of([(1, "x")]).limit(0)).count() == 0
    long = " ".join(str(i) for i in range(300_000))
    r = HQ.host_quality(docs_of([(1, long)])).collect()[0]
    assert r.n_words == 300_000 and r.n_repeat_words == 0 and r.kept

from llm_helpers import compare
from ratekit.llm import url_equivalence as UE
from ratekit.llm.queries import ORACLE_SQL, QUERIES, URL_RULES

RULES = [("block", "bad.net", ""), ("allow", "bad.net", "/ok/"), ("block", "x.org", "/a"), ("allow", "y.org", "/")]


def canonical(to):
    return f'<head><LINK data-a="1" REL="canonical" href="{to}"></head>'


PAGES = [
    (1, "http://bad.net/p", ""), (2, "https://sub.BAD.net/ok/1", ""), (3, "http://notbad.net/p", ""),
    (4, "http://mirror.com/p", canonical("http://bad.net/q")),                       # alias of a blocked target
    (5, "http://chain.com/1", canonical("/2")), (6, "http://chain.com/2?utm_source=z", ""),
    (7, "http://chain.com/2/", '<meta http-equiv="refresh" content="0; URL=http://mirror.com/p">'),
    (8, "http://mixed.com/1", canonical("http://bad.net/m")),                          # blocked and allowed aliases:
    (9, "http://mixed.com/2", canonical("http://mixed.com/1")),                        # the allow wins
    (10, "http://y.org/2", canonical("http://mixed.com/2")),
    (11, "http://x.org/abc#f", canonical("http://y.org/z")),                           # its own rule comes first
    (12, None, canonical("http://bad.net/q")), (13, "no scheme", None), (14, "", ""), (15, "http://", ""),
    (16, "http://free.com:80/x?a=1&ref=q", None), (17, "https://www.free.com/x/?a=1#t", None), (3, "http://notbad.net/p", ""),
    (18, "http://dir.com/d/e?x", canonical("f")), (19, "http://dir.com/d/f", canonical("//bad.net/zz")),
]
WANT = {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "block", 7: "block", 8: "allow", 9: "allow",
        10: "allow", 11: "block", 12: "allow", 13: "allow", 14: "allow", 15: "allow", 16: "allow", 17: "allow",
        18: "block", 19: "block"}


def test_decisions_reach_aliases_and_allows_come_first(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'c' AS host", "1 AS rule")
    out = UE.judge(pages, RULES).collect()
    assert len(out) == len(PAGES)
    assert {r.row.page_id: r.verdict for r in out} == WANT
    by = {r.row.page_id: r for r in out}
    assert (by[2].host, by[2].path, by[2].rule) == ("sub.bad.net", "/ok/1", "bad.net/ok/")
    assert by[16].alias_of == by[17].alias_of and by[5].alias_of == by[4].alias_of
    assert (by[12].host, by[12].path, by[12].rule, by[12].alias_of) == ("", "", None, None)
    kept = UE.keep_allowed(pages, RULES)
    assert kept.columns == pages.columns and kept.count() == sum(WANT[p[0]] == "allow" for p in PAGES)


def test_no_rules_and_empty_table(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert {r.verdict for r in UE.judge(pages, []).collect()} == {"allow"}
    assert UE.judge(pages.limit(0), RULES).count() == 0


def test_query_matches_sql(spark, duck):
    compare(spark, duck, "op5_url_equivalence", QUERIES, ORACLE_SQL)


def test_query_uses_the_rules_of_its_sql():
    from ratekit.llm import oracle
    assert oracle._RULES == URL_RULES

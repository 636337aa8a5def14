import html as html_lib
import random

import pytest
from llm_helpers import SF
from ratekit.llm import html_layout as H
from ratekit.llm.queries import QUERIES

CASES = [
    (None, None), ("", ""), ("plain  text", "plain text"),
    ("<p>a<p>b <b>c</b>d", "a\n\nb cd"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("a<br>b<br/><br>c", "a\nb\n\nc"), ("<br><br>a<br>\n<br><br>b<br><br>", "a\n\n\nb"), ("<div>a</div><br>b", "a\n\nb"),
    ("<table><tr><td colspan=2>long spanning header cell<td>z<tr><td>a<td>b<td>c</table>",
     "long spanning header cell | z\na | b                     | c"),
    ("<table><tr><td>x<td colspan=3>y<tr><td>aa<td>b<td>c<td>d<tr><td colspan=4>w</table>", "x  | y\naa | b | c | d\nw"),
    ("<input type=submit value=Go> <input type=reset> <input type=button value='Pick one'> <input value=typed>", "Go Reset Pick one"),
    ("<p style='visibility:hidden'><input type=submit value=no></p>yes", "yes"),
    ("<div style='white-space: pre'>a  b\n  c</div>d", "a  b\n  c\nd"),
    ("<style>.c{white-space:pre-wrap}</style><p class=c>x\n\n y</p>z", "x\n\n y\n\nz"),
    ("<ol reversed><li>x<li>y<li>z</ol>", "3. x\n2. y\n1. z"), ("<ol reversed start=10><li>x<li value=4>y<li>z</ol>", "10. x\n4. y\n3. z"),
    ("<ul><li>x<li>y<ol start=3><li>q<li value=9>z</ol></ul>t", "- x\n- y\n  3. q\n  9. z\n\nt"),
    ("<table><tr><th>Name<th>Qty<tr><td>pear tree<td>10<tr><td>x</table>", "Name      | Qty\npear tree | 10\nx"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><td>1<td>2</table>", "1 | 2"), ("<table><tr><td>|<td><td>-<tr><td><td>|</table>", "|     | -\n  | |"),
    ("<table><tr><td><ul><li>p<li>q</ul><td>r</table>", "- p | r\n- q"),
    ("<style>.x, #y {display:none} b{color:red}</style><p class='a x'>no</p><p id=y>no</p><b>yes</b>", "yes"),
    ("<p style='visibility:hidden'>no<i style='visibility: visible'>yes</i></p><p hidden>no", "yes"),
    ("<div style='DISPLAY : none !important'>no<p>no</p></div>yes", "yes"),
    ("<head><title>no</title><script>if (a<b) '</p>'</script></head>yes<noscript>no</noscript><template>no</template>", "yes"),
    ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
    ("<dialog>no</dialog><dialog open>yes</dialog><input type=hidden value=no>", "yes"),
    ("<pre>\n a\n   b\n</pre>", " a\n   b"), ("<textarea>x &lt; y</textarea>", "x < y"),
    ("&amp;&lt;&eacute;&#8364;&nosuch;", "&<é€&nosuch;"), ("a<!-- no --><!DOCTYPE x>b<!-- no", "ab"),
    ("x</div></p>y", "x\n\ny"), ("<blockquote>q<p>r</blockquote>", "    q\n\n    r"),
    ("<select><option>a<option>b</select>", "a\nb"), ("<dl><dt>t<dd>d</dl>", "t\n    d"), ("<p>unclosed <a href='x", "unclosed"),
    ("a < b and c<d", "a < b and c"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_layout(page, text):
    assert H.render(page) == text


def blocks(rng, depth=0):
    """A random piece of page and, separately, the lines that it must show; None is a gap."""
    word = lambda: rng.choice(["tree", "Öl", "a&b", "x<y", "long-word", "1"])
    say = lambda: " ".join(word() for _ in range(rng.randrange(1, 6)))
    kind = rng.choice(["p", "p", "h2", "div", "ul", "table", "hidden"]) if depth < 3 else "p"
    esc = html_lib.escape
    if kind in ("p", "h2"):
        t = say()
        close = f"</{kind}>" if kind == "h2" or rng.random() < 0.5 else ""
        return f"<{kind}>" + esc(t).replace(" ", rng.choice([" ", "\n ", "<!-- x --> "])) + close, [None, t, None], kind
    if kind == "div":
        parts = [blocks(rng, depth + 1) for _ in range(rng.randrange(1, 4))]
        return "<div>" + "".join(p[0] for p in parts) + "</div>", [x for p in parts for x in p[1]], kind
    if kind == "ul":
        items = [say() for _ in range(rng.randrange(1, 4))]
        return "<ul>" + "".join(f"<li>{esc(i)}" for i in items) + "</ul>", [None, *[f"- {i}" for i in items], None], kind
    if kind == "table":
        rows = [[say() for _ in range(3)] for _ in range(rng.randrange(1, 4))]
        wide = [max(len(r[c]) for r in rows) for c in range(3)]
        shown = [" | ".join(x.ljust(w) for x, w in zip(r, wide)).rstrip() for r in rows]
        return "<table>" + "".join("<tr>" + "".join(f"<td>{esc(x)}" for x in r) for r in rows) + "</table>", [
            None, *shown, None], kind
    return f"<div hidden><p>{esc(say())}</div>", [], kind


def test_random_pages_match_what_they_were_made_from():
    rng = random.Random(4)
    for _ in range(300):
        parts = [blocks(rng) for _ in range(rng.randrange(1, 7))]
        want, gap = [], False
        for line in (x for p in parts for x in p[1]):
            if line is None:
                gap = True
            else:
                want += [""] if gap and want else []
                want.append(line)
                gap = False
        assert H.render("".join(p[0] for p in parts)) == "\n".join(want)


def test_deep_and_broken_pages_lose_no_text():
    assert H.render("<div>" * 5000 + "deep" + "</div>" * 5000 + "after") == "deep\nafter"
    assert H.render("<b>" * 3000 + "x<p>y") == "x\n\ny"
    for broken in ("<p " * 3000, "<a b='" * 2000, "<" * 20000, "</" * 5000, "<table>" * 500 + "z"):
        H.render(broken)


def test_wide_tables_and_long_pages_take_time_in_proportion():
    import time
    row = "<tr>" + "<td>x" * 1500
    at = time.perf_counter()
    lines = H.render("<table>" + row * 20 + "</table>").split("\n")
    assert lines == [" | ".join(["x"] * 1500)] * 20 and time.perf_counter() - at < 3
    page = "<p>word " * 40_000 + "<pre>" + "line\n" * 40_000 + "</pre>"
    assert H.render(page).count("word") == 40_000 and H.render(page).count("line") == 40_000


def test_query_and_clashing_columns(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = QUERIES["op1_html_layout"](spark, SF).collect()
    assert {r.page_id: r.text for r in out} == {i: H.render(p) for i, p in pages.items()}
    df = spark.createDataFrame([(1, "<p>a", "old"), (1, None, "old"), (1, "<p>a", "old")], "page_id long, html string, text string")
    got = H.extract(df)
    assert got.columns == df.columns and sorted(r.text or "" for r in got.collect()) == ["", "a", "a"]
    assert H.extract(df.limit(0)).count() == 0


AT_RULES = [
    ("@media print { .n{display:none} }", True), ("@media (max-width:600px) { .n{display:none} p{color:red} }", True),
    ("@media screen and (max-width: 9em) { .n{display:none} }", True), ("@media screen { .n{display:none} }", False),
    ("@MEDIA print, Only  Screen { .n{display:none} }", False), ("@media all{@media print{.n{display:none}}}", True),
    ("@media not print { .n{display:none} }", False), ("@layer base { .n{display:none} }", False),
    ("@supports (display:grid) { .n{display:none} }", True), ("@media print{.a{color:red}} .n{display:none}", False),
    ("@import url(x.css); .n{display:none}", False), ("@font-face{font-family:x} @page{margin:0} .n{display:none}", False),
    (".n{color:red; @media print { top:0; display:none; } }", True), (".n{@media screen{display:none}}", False),
    (".a{.n{display:none}}", True), (".a::before{content:'}{'} .n{display:none}", False), ("} .n{display:none}", False),
    ("@media print{" * 3000 + ".n{display:none}", True), ("/* @media print { */ .n{display:none}", False),
]


@pytest.mark.parametrize("css,shown", AT_RULES)
def test_rules_for_print_or_some_widths_hide_nothing(css, shown):
    assert H.render(f"<style>{css}</style><p class=n>menu</p><p>yes") == ("menu\n\nyes" if shown else "yes")


def test_style_sheets_for_print_hide_nothing():
    page = "<style media='{}'>.n{{display:none}}</style><i class=n>menu </i>yes"
    assert [H.render(page.format(m)) for m in ("print", "screen", "(max-width:9em)", "")] == [
        "menu yes", "yes", "menu yes", "yes"]

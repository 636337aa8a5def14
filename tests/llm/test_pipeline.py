"""The pipeline against a brute-force one put together from the operators' brute-force versions."""

import corpus_pipeline
import test_byte_bpe
import test_decontaminate
import test_host_quality
import test_line_dedup
import test_minhash_dedup
from llm_helpers import SF
from ratekit.llm import host_quality as HQ
from ratekit.llm.queries import QUERIES


def base_failed(text):
    n, _, _, _, repeated = test_host_quality.brute(text)
    return n < 10 or 100 * repeated > 20 * n


def good(docs):
    """Rows whose own and whose host's rules hold; rates are shrunk by the moments' prior."""
    hosts = {}
    for _, t, h in docs:
        if h is not None:
            n, f = hosts.get(h, (0, 0))
            hosts[h] = (n + 1, f + base_failed(t))
    total = sum(n for n, _ in hosts.values())
    mean = sum(f for _, f in hosts.values()) / total
    spread = sum(n * (f / n - mean) ** 2 for n, f in hosts.values()) / total
    k = HQ.STRENGTH[1] if spread <= 0 else min(max(mean * (1 - mean) / spread - 1, HQ.STRENGTH[0]), HQ.STRENGTH[1])
    bad = {h for h, (n, f) in hosts.items() if (f + mean * k) / (n + k) > HQ.MAX_RATE}
    return [d for d in docs if not base_failed(d[1]) and d[2] not in bad]


def brute(docs, items):
    docs = good(docs)
    cut = test_line_dedup.brute([(i, t) for i, t, _ in docs])
    lined = [(i, cut[(i, t)], h) for i, t, h in docs if cut[(i, t)] == t or cut[(i, t)].strip(" \t\n\r\x0b\x0c")]
    first = test_minhash_dedup.brute([(i, t) for i, t, _ in lined])
    single = [d for d in lined if first[d[0]][1] == d[0]]
    return {i: t for i, t, _ in single if not test_decontaminate.brute(t, items)[3]}


def test_run_matches_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute(docs, items)
    out = QUERIES["pipeline"](spark, SF).collect()
    assert len(out) == len(want) < len(docs)
    assert {r.doc_id: bytes(r.ids) for r in out} == {i: test_byte_bpe.want(t) for i, t in want.items()}
    assert all(r.round_trip and r.n_tokens == len(r.ids) // 4 for r in out)


def test_every_stage_keeps_the_columns_and_stands_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_nulls_in_any_column_and_repeated_rows(spark):
    text = "these are twelve quite different words which nobody would ever call repeated junk"
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, None, None, None, None), (None, text + " but more", None, None, 3),
            (3, "", "en", "a", 0), (4, "entirely other " + " ".join(f"v{i}" for i in range(40)), None, "b", None)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.dtypes == spark.createDataFrame([], schema).dtypes
    left = sorted((r.doc_id is not None, r.doc_id or 0) for r in docs.collect())
    assert left[0][0] is False and (True, 4) in left and left.count((True, 1)) <= 1


def test_further_columns_with_clashing_names_and_a_very_long_text(spark):
    words = [f"w{i}" for i in range(120_000)]
    rows = [(1, " ".join(words), "en", "a", 5, "r", "k", None, 2.0), (2, " ".join(words[:50]) + "\n" + " ".join(words[60:90]), "en", "a", 5, "r", "k", "n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, "
                                       "kept string, n_words string, component double")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        docs = out
    left = {r.doc_id: r for r in docs.collect()}
    assert left[1].text == rows[0][1] and tuple(left[2]) == rows[1]
    tokens = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert tokens[1].round_trip and tokens[1].n_tokens > 120_000

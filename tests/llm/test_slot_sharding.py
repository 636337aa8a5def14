import zlib
from collections import defaultdict

from llm_helpers import compare
from ratekit.llm import slot_sharding as SS
from ratekit.llm.queries import ORACLE_SQL, QUERIES
from ratekit.session import shared_path


def gapless(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.position)
    return all(sorted(x) == list(range(len(x))) for x in by.values())


def test_query_matches_sql(spark, duck):
    compare(spark, duck, "op8_slot_sharding", QUERIES, ORACLE_SQL)


def test_sizes_places_nulls_and_repeats(spark, docs_of):
    rows = [(i, "word " * (i % 40)) for i in range(2000)] + [(None, "é"), (None, None), (7, "same"), (7, "same"), (8, "")]
    out = SS.shard(docs_of(rows), shared_path(spark, "m"), 5, slots=512).collect()
    assert len(out) == len(rows) and gapless(out)
    assert sorted(r.size for r in out) == sorted(len((t or "").encode()) + 8 for _, t in rows)
    assert sorted(r.text_crc32 for r in out) == sorted(zlib.crc32((t or "").encode()) for _, t in rows)
    loads = [sum(r.size for r in out if r.shard == s) for s in range(5)]
    assert max(loads) - min(loads) <= 0.01 * sum(loads)


def test_growing_edits_the_map_and_moves_rows_only_into_new_shards(spark, docs_of):
    docs = docs_of([(i, "word " * (i % 40)) for i in range(3000)])
    path = shared_path(spark, "m")
    before = {r.doc_id: r.shard for r in SS.shard(docs, path, 4, slots=512).collect()}
    out = SS.rebalance(SS.records(docs, slots=512), path, 6, slots=512).collect()
    moved = {(before[r.doc_id], r.shard) for r in out if before[r.doc_id] != r.shard}
    assert moved and all(new >= 4 for _, new in moved) and gapless(out)
    loads = [sum(r.size for r in out if r.shard == s) for s in range(6)]
    assert max(loads) <= 1.05 * sum(loads) / 6
    assert SS.read_map(spark, path, 1).count() == SS.read_map(spark, path).count() == 512
    assert {r.version for r in SS.read_map(spark, path).collect()} == {2}


def test_empty_table(spark, docs_of):
    path = shared_path(spark, "m")
    assert SS.shard(docs_of([(1, "x")]).limit(0), path, 3, slots=64).count() == 0
    assert sorted(r["count"] for r in SS.read_map(spark, path).groupBy("shard").count().collect()) == [21, 21, 22]

"""Comparison of a query with its SQL."""

SF = "/root/testdata/sf0.001"


def compare(spark, duck, name, queries, oracle, sf=SF):
    """Rows of a query and of its SQL, as sorted lists under sorted column names."""
    df = queries[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    rel = duck.sql(oracle[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())
    assert got == want
    return got

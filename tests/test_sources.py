"""Raw file layouts (synthetic rows only): TSV ratings, latin-1 pipe items,
pipe users, CSV-with-header and Parquet layers."""

import os
import tempfile

import pytest

from ratekit import schemas
from ratekit.operators import features as FE
from ratekit.operators import profile as PR
from ratekit.sources import delimited as D


@pytest.fixture(scope="module")
def raw_dir():
    d = tempfile.mkdtemp(prefix="ratekit-raw-")
    with open(os.path.join(d, "ratings.tsv"), "w") as f:
        f.write("1\t10\t5\t881250949\n1\t10\t5\t881250949\n2\t11\t3\t891717742\n"
                "10\t99\t1\t878887116\n")
    genres_multi = "|".join(["0", "1", "1"] + ["0"] * 16)
    genres_none = "|".join(["0"] * 19)
    rows = [
        f"10|Café Noir (1995)|01-Jan-1995||http://x/1|{genres_multi}",
        f"11|Zoë|4-Feb-1971||http://x/2|{genres_none}",
        f"12|No Date||||{genres_none}",
    ]
    with open(os.path.join(d, "items.txt"), "wb") as f:
        f.write(("\n".join(rows) + "\n").encode("latin-1"))
    with open(os.path.join(d, "users.txt"), "w") as f:
        f.write("1|24|M|technician|85711\n2|53|F|other|01234\n10|24|M|writer|T8H1N\n")
    return d


def test_tsv_ratings(spark, raw_dir):
    r = D.read_raw_ratings(spark, os.path.join(raw_dir, "ratings.tsv"))
    assert r.schema == schemas.RAW_RATINGS
    assert r.count() == 4
    assert PR.duplicate_count(r).first().duplicates == 1


def test_latin1_items_and_dates(spark, raw_dir):
    it = D.read_raw_items(spark, os.path.join(raw_dir, "items.txt"))
    rows = {r.item_id: r for r in it.collect()}
    assert rows[10].title == "Café Noir (1995)" and rows[11].title == "Zoë"
    assert rows[10].Action == 1 and rows[10].Adventure == 1
    s = {r.item_id: r.release_date for r in D.structure_items(it).collect()}
    assert s == {10: 788918400, 11: 34473600, 12: None}
    nulls = {r.column_name: r.all_null for r in PR.all_null_columns(it).collect()}
    assert nulls["video_release_date"] is True and nulls["title"] is False
    kept = PR.drop_null_rows(PR.drop_all_null_columns(D.structure_items(it)))
    assert sorted(r.item_id for r in kept.collect()) == [10, 11]


def test_users_keep_zip_text(spark, raw_dir):
    u = D.read_raw_users(spark, os.path.join(raw_dir, "users.txt"))
    assert sorted(r.zip_code for r in u.collect()) == ["01234", "85711", "T8H1N"]
    oh = FE.one_hot(u.drop("zip_code"), ["gender", "occupation"])
    assert oh.columns[-5:] == ["gender_F", "gender_M", "occupation_other",
                               "occupation_technician", "occupation_writer"]


def test_layer_round_trips(spark, raw_dir):
    u = D.read_raw_users(spark, os.path.join(raw_dir, "users.txt"))
    for fmt in ("parquet", "csv"):
        path = os.path.join(raw_dir, f"layer_{fmt}")
        D.write_layer(u, path, fmt=fmt)
        back = (spark.read.parquet(path) if fmt == "parquet"
                else D.read_csv_with_header(spark, path, schemas.RAW_USERS))
        assert sorted(back.collect()) == sorted(u.collect())


def test_bad_row_fails_fast(spark, raw_dir):
    path = os.path.join(raw_dir, "bad.tsv")
    with open(path, "w") as f:
        f.write("1\t10\tfive\t881250949\n")
    with pytest.raises(Exception):
        D.read_raw_ratings(spark, path).collect()


def test_flagship_plan_prunes_columns(spark):
    import __spark_entry__ as entry
    plan = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "c_acctbal" not in plan

"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each entry computes, with plain SQL over the driver's tables, exactly what
the Spark query of the same name computes.  The adapters are repeated here
as CTEs; parameters (fractions, seeds, batch sizes, patience) are the same
constants the Spark side uses, imported from ``plans.params``.
"""

from __future__ import annotations

from fractions import Fraction

from ..sources.testdata import MONTHS, PART_TYPES
from . import params as P

_MONTH_LIST = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
_FLAGS = ",\n    ".join(
    [f"CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END AS g_{t.lower()}" for t in PART_TYPES]
    + ["CASE WHEN p_size <= 10 THEN 1 ELSE 0 END AS g_tiny"])
GENRES = [f"g_{t.lower()}" for t in PART_TYPES] + ["g_tiny"]

RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
    CAST(1 + floor((l_quantity - 1) / 10) AS INTEGER) AS rating,
    CAST(epoch(l_shipdate) AS BIGINT) AS ts,
    md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
        CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
        CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
        CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR))) AS k,
    round(CAST(1 + floor((l_quantity - 1) / 10) AS INTEGER)
          + (((l_orderkey * 31 + l_partkey * 17) % 1001) - 500) / 250E0, 6) AS pred
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

USERS = """users AS (
  SELECT c_custkey AS user_id,
    CAST(18 + floor((c_acctbal + 1000) / 200) AS INTEGER) AS age,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    c_mktsegment AS occupation, CAST(c_nationkey AS VARCHAR) AS zip_code
  FROM customer)"""

ITEMS = f"""items AS (
  SELECT p_partkey AS item_id, p_name AS title,
    CASE WHEN p_partkey % 97 = 0 THEN NULL
         ELSE concat(CAST(p_size % 28 + 1 AS VARCHAR), '-', {_MONTH_LIST}[p_partkey % 12 + 1],
                     '-', CAST(p_size + 1950 AS VARCHAR)) END AS release_date,
    CAST(NULL AS VARCHAR) AS video_release_date, p_brand AS url,
    {_FLAGS}
  FROM part)"""

SCORED = """scored AS (SELECT k, user_id, item_id, rating AS actual, pred AS prediction FROM ratings)"""

# class probabilities w_i = 1/(1+|p-i|), p_i = w_i / Σw (same op order as Spark)
PROBS = """probs AS (
  SELECT k, user_id, item_id, actual, [w1 / t, w2 / t, w3 / t, w4 / t, w5 / t] AS probabilities
  FROM (SELECT *, (((w1 + w2) + w3) + w4) + w5 AS t FROM (
    SELECT k, user_id, item_id, actual,
      1E0 / (1E0 + abs(prediction - 1E0)) AS w1, 1E0 / (1E0 + abs(prediction - 2E0)) AS w2,
      1E0 / (1E0 + abs(prediction - 3E0)) AS w3, 1E0 / (1E0 + abs(prediction - 4E0)) AS w4,
      1E0 / (1E0 + abs(prediction - 5E0)) AS w5
    FROM scored)))"""

EMB = """emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def hash_uniform(*parts: str) -> str:
    text = "concat_ws('|', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return (f"((CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) + 0.5E0)"
            f" / 4503599627370496E0)")


def hash_normal(*parts: str) -> str:
    u1 = hash_uniform(*parts, "'u1'")
    u2 = hash_uniform(*parts, "'u2'")
    return f"(sqrt(-2E0 * ln({u1})) * cos(6.283185307179586E0 * {u2}))"


def seeded_hash(seed: int, *parts: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + f", '{seed}'))"


def _frac(x) -> Fraction:
    return Fraction(str(x))


def _val_frac(test, val, relative_to) -> Fraction:
    t, v = _frac(test), _frac(val)
    return v / (1 - t) if relative_to == "total" else v


def stratified_split_ctes(test, val, relative_to, seed, src="ratings", name="strat") -> str:
    ft, fv = _frac(test), _val_frac(test, val, relative_to)
    pt, qt, pv, qv = ft.numerator, ft.denominator, fv.numerator, fv.denominator
    h = seeded_hash(seed, "k")
    hs = seeded_hash(seed, "user_id")
    return f"""{name}_pos AS (
  SELECT r.*, row_number() OVER (PARTITION BY user_id ORDER BY {h}) - 1 AS p FROM {src} r),
{name}_per AS (SELECT user_id, count(*) AS n, {hs} AS hs FROM {src} GROUP BY user_id),
{name}_q1 AS (SELECT *, (n * {pt}) // {qt} AS fl, (n * {pt}) % {qt} AS rem FROM {name}_per),
{name}_q1b AS (SELECT user_id, n, hs, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, hs)
    <= (SELECT (sum(n) * {pt} + {qt - 1}) // {qt} - sum(fl) FROM {name}_q1) THEN 1 ELSE 0 END AS q_test
  FROM {name}_q1),
{name}_q2 AS (SELECT *, ((n - q_test) * {pv}) // {qv} AS fl, ((n - q_test) * {pv}) % {qv} AS rem
  FROM {name}_q1b),
{name}_q2b AS (SELECT user_id, q_test, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, hs)
    <= (SELECT (sum(n - q_test) * {pv} + {qv - 1}) // {qv} - sum(fl) FROM {name}_q2) THEN 1 ELSE 0 END AS q_val
  FROM {name}_q2),
{name} AS (SELECT a.* EXCLUDE (p), CASE WHEN p < q_test THEN 'test' WHEN p < q_test + q_val THEN 'val'
    ELSE 'train' END AS split
  FROM {name}_pos a JOIN {name}_q2b b USING (user_id))"""


def random_split_ctes(test, val, relative_to, seed, src="ratings", name="rsplit") -> str:
    ft, fv = _frac(test), _val_frac(test, val, relative_to)
    h = seeded_hash(seed, "k")
    return f"""{name}_rn AS (
  SELECT r.*, row_number() OVER (ORDER BY {h}) AS rn, count(*) OVER () AS nn FROM {src} r),
{name}_t AS (SELECT *, (nn * {ft.numerator} + {ft.denominator - 1}) // {ft.denominator} AS n_test
  FROM {name}_rn),
{name} AS (SELECT * EXCLUDE (rn, nn, n_test), CASE WHEN rn <= n_test THEN 'test'
    WHEN rn <= n_test + ((nn - n_test) * {fv.numerator} + {fv.denominator - 1}) // {fv.denominator}
    THEN 'val' ELSE 'train' END AS split FROM {name}_t)"""


STRAT = stratified_split_ctes(P.STRAT_TEST, P.STRAT_VAL, "total", P.SEED)
RSPLIT = random_split_ctes(P.RAND_TEST, P.RAND_VAL, "remainder", P.SEED)

# users after processing: zip dropped, age scaled, gender and occupation one-hot
_OCC = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
USERS_PROCESSED = """users_stats AS (SELECT avg(CAST(age AS DOUBLE)) AS m,
    CASE WHEN stddev_pop(CAST(age AS DOUBLE)) IS NULL OR stddev_pop(CAST(age AS DOUBLE)) = 0 THEN 1E0
         ELSE stddev_pop(CAST(age AS DOUBLE)) END AS s FROM users),
users_processed AS (SELECT user_id, (CAST(age AS DOUBLE) - m) / s AS age,
    CASE WHEN gender = 'F' THEN 1 ELSE 0 END AS gender_F,
    CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS gender_M,
    """ + ",\n    ".join(f"CASE WHEN occupation = '{o}' THEN 1 ELSE 0 END AS occupation_{o}"
                         for o in _OCC) + """
  FROM users CROSS JOIN users_stats)"""
USER_FEATURES = ["age", "gender_F", "gender_M"] + [f"occupation_{o}" for o in _OCC]

ITEMS_PROCESSED = """items_epoch AS (SELECT * EXCLUDE (release_date),
    CAST(epoch(strptime(release_date, '%d-%b-%Y')) AS BIGINT) AS release_date FROM items),
items_stats AS (SELECT avg(CAST(release_date AS DOUBLE)) AS m,
    CASE WHEN stddev_pop(CAST(release_date AS DOUBLE)) IS NULL
           OR stddev_pop(CAST(release_date AS DOUBLE)) = 0 THEN 1E0
         ELSE stddev_pop(CAST(release_date AS DOUBLE)) END AS s FROM items_epoch),
items_processed AS (SELECT item_id, (CAST(release_date AS DOUBLE) - m) / s AS release_date,
    """ + ", ".join(GENRES) + """
  FROM items_epoch CROSS JOIN items_stats
  WHERE release_date IS NOT NULL)"""


def _r(expr: str, digits: int = 6) -> str:
    # "+ 0" turns a negative zero into zero, as on the Spark side
    return f"(round({expr}, {digits}) + 0E0)"


def _metric_ctes() -> str:
    """Baseline models scored on the random split's test rows."""
    return """tr AS (SELECT * FROM rsplit WHERE split = 'train'),
te AS (SELECT * FROM rsplit WHERE split = 'test'),
gm AS (SELECT avg(CAST(rating AS DOUBLE)) AS g FROM tr),
um AS (SELECT user_id, avg(CAST(rating AS DOUBLE)) AS u FROM tr GROUP BY user_id),
im AS (SELECT item_id, avg(CAST(rating AS DOUBLE)) AS i FROM tr GROUP BY item_id),
preds AS (
  SELECT 'stand_in' AS model, k, rating AS actual, pred AS prediction FROM te
  UNION ALL SELECT 'global_mean', k, rating, g FROM te CROSS JOIN gm
  UNION ALL SELECT 'user_mean', k, rating, coalesce(u, g) FROM te LEFT JOIN um USING (user_id) CROSS JOIN gm
  UNION ALL SELECT 'item_mean', k, rating, coalesce(i, g) FROM te LEFT JOIN im USING (item_id) CROSS JOIN gm),
mlong AS (
  SELECT model, 'accuracy' AS metric,
    avg(CASE WHEN actual = greatest(1, least(5, CAST(round_even(prediction, 0) AS INTEGER)))
        THEN 1E0 ELSE 0E0 END) AS value FROM preds GROUP BY model
  UNION ALL SELECT model, 'mae', avg(abs(prediction - actual)) FROM preds GROUP BY model
  UNION ALL SELECT model, 'rmse', sqrt(avg((prediction - actual) * (prediction - actual)))
    FROM preds GROUP BY model)"""


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    g_cols = ", ".join(GENRES)

    q["rating_by_occupation"] = _with(RATINGS, USERS) + f"""
SELECT u.occupation, count(*) AS ratings, {_r('avg(CAST(r.rating AS DOUBLE))')} AS mean_rating,
  CAST(sum(CASE WHEN r.rating = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_1,
  CAST(sum(CASE WHEN r.rating = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_2,
  CAST(sum(CASE WHEN r.rating = 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_3,
  CAST(sum(CASE WHEN r.rating = 4 THEN 1 ELSE 0 END) AS BIGINT) AS n_4,
  CAST(sum(CASE WHEN r.rating = 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_5
FROM ratings r LEFT JOIN users u USING (user_id) GROUP BY u.occupation"""

    # --- sources and sinks -------------------------------------------------------
    q["ratings_tsv_roundtrip"] = _with(RATINGS) + """
SELECT user_id, item_id, rating, ts AS timestamp FROM ratings"""
    q["items_pipe_latin1_roundtrip"] = _with(ITEMS) + f"""
SELECT item_id, title, CAST(epoch(strptime(release_date, '%d-%b-%Y')) AS BIGINT) AS release_date,
  video_release_date, url, {g_cols} FROM items"""
    q["users_pipe_roundtrip"] = _with(USERS) + "SELECT * FROM users"
    q["users_csv_header_roundtrip"] = _with(USERS) + "SELECT * FROM users"

    # --- profiling ---------------------------------------------------------------
    item_cols = ["item_id", "title", "release_date", "video_release_date", "url"] + GENRES
    q["null_profile"] = _with(RATINGS, USERS, ITEMS) + "\nUNION ALL\n".join(
        [f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
         f"CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM {t}"
         for t, cols in (("ratings", ["user_id", "item_id", "rating", "ts", "k", "pred"]),
                         ("users", ["user_id", "age", "gender", "occupation", "zip_code"]),
                         ("items", item_cols))
         for c in cols])
    q["all_null_columns"] = _with(ITEMS) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, count({c}) = 0 AS all_null FROM items"
        for c in item_cols)
    q["items_dropna"] = _with(ITEMS) + f"""
SELECT item_id, release_date, {g_cols} FROM items
WHERE item_id IS NOT NULL AND title IS NOT NULL AND release_date IS NOT NULL AND url IS NOT NULL
  AND {' AND '.join(f'{g} IS NOT NULL' for g in GENRES)}"""
    q["duplicate_rows"] = _with(RATINGS, USERS) + """
SELECT 'ratings' AS table_name, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows,
  CAST(sum(n - 1) AS BIGINT) AS duplicates
FROM (SELECT user_id, item_id, rating, count(*) AS n FROM ratings GROUP BY ALL)
UNION ALL
SELECT 'users', CAST(sum(n) AS BIGINT), count(*), CAST(sum(n - 1) AS BIGINT)
FROM (SELECT user_id, age, gender, occupation, zip_code, count(*) AS n FROM users GROUP BY ALL)"""
    q["rating_distribution"] = _with(RATINGS) + """
SELECT rating, count(*) AS count FROM ratings GROUP BY rating"""
    q["occupation_counts"] = _with(USERS) + """
SELECT occupation, count(*) AS count FROM users GROUP BY occupation"""
    q["genre_totals"] = _with(ITEMS) + "\nUNION ALL\n".join(
        f"SELECT '{g}' AS genre, CAST(coalesce(sum({g}), 0) AS BIGINT) AS total FROM items"
        for g in GENRES)
    q["distinct_counts"] = _with(RATINGS, USERS) + """
SELECT 'user_id' AS column_name, count(DISTINCT user_id) AS distinct_count FROM ratings
UNION ALL SELECT 'item_id', count(DISTINCT item_id) FROM ratings
UNION ALL SELECT 'zip_code', count(DISTINCT zip_code) FROM users"""
    q["zip_unique_pct"] = _with(USERS) + f"""
SELECT count(*) AS rows, count(DISTINCT zip_code) AS distinct_values,
  {_r('count(DISTINCT zip_code) / count(*) * 100')} AS unique_pct FROM users"""
    b = P.HIST_BINS
    q["age_histogram"] = _with(USERS) + f"""
, st AS (SELECT min(CAST(age AS DOUBLE)) AS lo, max(CAST(age AS DOUBLE)) AS hi FROM users),
binned AS (SELECT CASE WHEN hi - lo = 0 THEN 0
    ELSE least({b - 1}, CAST(floor((CAST(age AS DOUBLE) - lo) / (hi - lo) * {b}) AS INTEGER)) END AS bin
  FROM users CROSS JOIN st WHERE age IS NOT NULL),
cnt AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin),
grid AS (SELECT CAST(range AS INTEGER) AS bin FROM range({b}))
SELECT g.bin, {_r(f'lo + g.bin * ((hi - lo) / {b})')} AS lo,
  {_r(f'lo + (g.bin + 1) * ((hi - lo) / {b})')} AS hi, coalesce(n, 0) AS count
FROM grid g CROSS JOIN st LEFT JOIN cnt c ON g.bin = c.bin"""
    q["timestamp_histogram"] = _with(RATINGS) + f"""
, x AS (SELECT CAST(ts AS DOUBLE) AS x, row_number() OVER (ORDER BY ts) AS rn, count(*) OVER () AS n FROM ratings),
st AS (SELECT any_value(n) AS n, min(x) AS lo, max(x) AS hi, max(CASE WHEN rn = ceil(n * 0.25) THEN x END) AS q1,
    max(CASE WHEN rn = ceil(n * 0.75) THEN x END) AS q3 FROM x),
au AS (SELECT *, CASE WHEN hi = lo THEN 1 ELSE least(10000, ceil((hi - lo) / least((hi - lo) / (log2(n) + 1),
    CASE WHEN q3 > q1 THEN 2 * (q3 - q1) / cbrt(n) ELSE 1E300 END)))::INTEGER END AS bins FROM st),
cnt AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(bins - 1, floor((x - lo) / (hi - lo) * bins)::INTEGER) END AS bin,
    count(*) AS n FROM x, au GROUP BY 1),
grid AS (SELECT CAST(unnest(range(bins)) AS INTEGER) AS bin FROM au)
SELECT g.bin, {_r('lo + g.bin * ((hi - lo) / bins)', 3)} AS lo, {_r('lo + (g.bin + 1) * ((hi - lo) / bins)', 3)} AS hi,
  coalesce(c.n, 0) AS count
FROM grid g CROSS JOIN au LEFT JOIN cnt c ON g.bin = c.bin"""
    q["title_onehot"] = """
SELECT p_partkey AS item_id, (SELECT count(DISTINCT p_name) FROM part) AS size, place, CASE WHEN place IS NULL THEN NULL
  ELSE 1E0 END AS value
FROM part LEFT JOIN (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS place
  FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL)) USING (p_name)"""
    q["split_sizes_stratified"] = _with(RATINGS, STRAT) + """
SELECT split, count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items
FROM strat GROUP BY split"""
    q["split_sizes_random"] = _with(RATINGS, RSPLIT) + """
SELECT split, count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items
FROM rsplit GROUP BY split"""

    # --- features ---------------------------------------------------------------------
    q["release_date_epoch"] = _with(ITEMS) + """
SELECT item_id, release_date AS release_text,
  CAST(epoch(strptime(release_date, '%d-%b-%Y')) AS BIGINT) AS release_epoch FROM items"""
    q["scaled_timestamps"] = _with(RATINGS) + f"""
, st AS (SELECT avg(CAST(ts AS DOUBLE)) AS m, CASE WHEN stddev_pop(CAST(ts AS DOUBLE)) = 0 THEN 1E0
    ELSE stddev_pop(CAST(ts AS DOUBLE)) END AS s FROM ratings)
SELECT k, {_r('(CAST(ts AS DOUBLE) - m) / s')} AS ts_z FROM ratings CROSS JOIN st"""
    q["users_processed"] = _with(USERS, USERS_PROCESSED) + f"""
SELECT user_id, {_r('age')} AS age, gender_F, gender_M,
  {', '.join(f'occupation_{o}' for o in _OCC)} FROM users_processed"""
    q["items_processed"] = _with(ITEMS, ITEMS_PROCESSED) + f"""
SELECT item_id, {_r('release_date')} AS release_date, {g_cols} FROM items_processed"""
    q["encode_users"] = _with(RATINGS) + """
SELECT user_id, dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx
FROM (SELECT DISTINCT user_id FROM ratings)"""
    q["encode_items"] = _with(RATINGS) + """
SELECT item_id, dense_rank() OVER (ORDER BY item_id) - 1 AS item_idx
FROM (SELECT DISTINCT item_id FROM ratings)"""
    q["id_cardinality"] = _with(RATINGS) + """
SELECT max(user_id) + 1 AS n_user_id, max(item_id) + 1 AS n_item_id FROM ratings"""
    feat = USER_FEATURES + ["release_date"] + GENRES
    q["feature_matrix"] = _with(RATINGS, USERS, ITEMS, USERS_PROCESSED, ITEMS_PROCESSED) + f"""
SELECT k, user_id, item_id, rating,
  {', '.join(_r(f'coalesce({c}, 0)') + f' AS {c}' if c in ('age', 'release_date')
             else f'coalesce({c}, 0) AS {c}' for c in feat)}
FROM ratings LEFT JOIN users_processed USING (user_id) LEFT JOIN items_processed USING (item_id)"""
    total = " + ".join(f"CAST(coalesce({c}, 0) AS DOUBLE)" for c in feat)
    q["feature_vectors"] = _with(RATINGS, USERS, ITEMS, USERS_PROCESSED, ITEMS_PROCESSED) + f"""
SELECT k, {len(feat)} AS n_features, {_r(total)} AS feature_sum
FROM ratings LEFT JOIN users_processed USING (user_id) LEFT JOIN items_processed USING (item_id)"""
    eps = hash_normal("k", "'age'", f"'{P.SEED}'")
    q["noisy_user_features"] = _with(RATINGS, USERS, USERS_PROCESSED, RSPLIT) + f"""
SELECT k, split, {_r(f"CASE WHEN split = 'train' THEN coalesce(age, 0) * (1E0 + {P.NOISE_SIGMA}E0 * {eps}) ELSE coalesce(age, 0) END")} AS age
FROM rsplit LEFT JOIN users_processed USING (user_id)"""
    q["display_buckets"] = _with(RATINGS) + """
, nd AS (SELECT count(DISTINCT user_id) AS nu, count(DISTINCT item_id) AS ni FROM ratings)
SELECT CASE WHEN nu > 10 THEN user_id % 10 ELSE user_id END AS user_bucket,
  CASE WHEN ni > 10 THEN item_id % 10 ELSE item_id END AS item_bucket, count(*) AS n
FROM ratings CROSS JOIN nd GROUP BY ALL"""
    q["gmf_lookup"] = _with(RATINGS, EMB) + f"""
SELECT k, CASE WHEN u.vec_id IS NULL THEN 0 ELSE 1 END AS has_user,
  CASE WHEN i.vec_id IS NULL THEN 0 ELSE 1 END AS has_item,
  {_r('list_sum(list_transform(list_zip(u.embedding, i.embedding), lambda x: x[1] * x[2]))', 5)} AS gmf_score,
  CASE WHEN u.vec_id IS NULL OR i.vec_id IS NULL THEN NULL
       ELSE CAST(len(list_concat(u.embedding, i.embedding)) AS INTEGER) END AS concat_dim,
  CASE WHEN u.vec_id IS NULL OR i.vec_id IS NULL THEN NULL
       ELSE {_r('sqrt(list_sum(list_transform(list_concat(u.embedding, i.embedding), lambda x: x * x)))', 5)} END AS concat_norm
FROM ratings LEFT JOIN emb u ON u.vec_id = ratings.user_id LEFT JOIN emb i ON i.vec_id = ratings.item_id"""
    q["embedding_max_norm"] = _with(EMB) + f"""
, nm AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x * x))) AS n FROM emb)
SELECT vec_id, {_r('n')} AS norm_before,
  {_r('sqrt(list_sum(list_transform(list_transform(embedding, lambda x: x * CASE WHEN n > 1E0 THEN 1E0 / n ELSE 1E0 END), lambda y: y * y)))')} AS norm_after
FROM nm"""

    # --- splits and weights ---------------------------------------------------------
    q["stratified_split"] = _with(RATINGS, STRAT) + "SELECT k, user_id, split FROM strat"
    q["random_split"] = _with(RATINGS, RSPLIT) + "SELECT k, split FROM rsplit"
    hb = seeded_hash(P.SEED, "k", f"'{P.BATCH_EPOCH}'")
    q["epoch_batches"] = _with(RATINGS, RSPLIT) + f"""
SELECT k, (row_number() OVER (ORDER BY {hb}) - 1) // {P.BATCH_SIZE} AS batch_id,
  row_number() OVER (ORDER BY {hb}) AS position
FROM rsplit WHERE split = 'train'"""
    q["first_n_sample"] = _with(RATINGS) + f"""
SELECT k, user_id, item_id, rating FROM ratings ORDER BY k LIMIT {P.SAMPLE_N}"""
    q["class_frequency"] = _with(RATINGS) + """
SELECT c.rating, coalesce(n, 0) AS count
FROM (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS rating) c
LEFT JOIN (SELECT rating, count(*) AS n FROM ratings GROUP BY rating) USING (rating)"""
    q["balanced_class_weights"] = _with(RATINGS, STRAT) + f"""
, c AS (SELECT rating, count(*) AS count FROM strat WHERE split = 'train' GROUP BY rating)
SELECT rating, count, {_r('(SELECT sum(count) FROM c) / ((SELECT count(*) FROM c) * count)')} AS weight
FROM c"""
    q["inverse_frequency_weights"] = _with(RATINGS, RSPLIT) + f"""
, c AS (SELECT rating, count(*) AS count, 1E0 / count(*) AS w FROM rsplit WHERE split = 'train' GROUP BY rating)
SELECT rating, count, {_r('w * (SELECT count(*) FROM c) / (SELECT sum(w) FROM c)')} AS weight FROM c"""

    # --- scoring functions ---------------------------------------------------------
    q["round_clip_predictions"] = _with(RATINGS, SCORED) + """
SELECT k, actual, greatest(1, least(5, CAST(round_even(prediction, 0) AS INTEGER))) AS predicted,
  actual - 1 AS actual_class,
  greatest(1, least(5, CAST(round_even(prediction, 0) AS INTEGER))) - 1 AS predicted_class
FROM scored"""
    q["argmax_predictions"] = _with(RATINGS, SCORED, PROBS) + """
SELECT k, actual, CAST(list_position(probabilities, list_max(probabilities)) - 1 AS INTEGER) AS predicted_class
FROM probs"""
    sm = ("(SELECT k, actual, list_transform(e, lambda x: x / list_sum(e)) AS p FROM ("
          "SELECT k, actual, list_transform(lg, lambda x: exp(x - list_max(lg))) AS e FROM ("
          "SELECT k, actual, [-2E0 * abs(prediction - 1E0), -2E0 * abs(prediction - 2E0), "
          "-2E0 * abs(prediction - 3E0), -2E0 * abs(prediction - 4E0), "
          "-2E0 * abs(prediction - 5E0)] AS lg FROM scored)))")
    q["softmax_probabilities"] = _with(RATINGS, SCORED) + f"""
SELECT k, {', '.join(_r(f'p[{i}]') + f' AS prob_{i}' for i in range(1, 6))} FROM {sm}"""
    q["expected_rating"] = _with(RATINGS, SCORED, PROBS) + f"""
SELECT k, actual, {_r('list_sum(list_transform(probabilities, lambda x, i: x * i))')} AS expected_rating
FROM probs"""
    q["scaled_sigmoid"] = _with(RATINGS, SCORED) + f"""
SELECT k, {_r('4E0 / (1E0 + exp(-(prediction - 3E0))) + 1E0')} AS bounded_prediction FROM scored"""
    q["one_vs_rest_scores"] = _with(RATINGS, SCORED) + f"""
SELECT k, c AS class, CASE WHEN actual = c THEN 1 ELSE 0 END AS label,
  {_r('-abs(prediction - c)')} AS score
FROM scored CROSS JOIN (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS c)"""

    # --- evaluation -------------------------------------------------------------------
    pred_cte = """pc AS (SELECT actual, greatest(1, least(5, CAST(round_even(prediction, 0) AS INTEGER))) AS predicted,
    prediction FROM scored)"""
    q["accuracy"] = _with(RATINGS, SCORED, pred_cte) + f"""
SELECT {_r('avg(CASE WHEN actual = predicted THEN 1E0 ELSE 0E0 END)')} AS accuracy FROM pc"""
    prf = """cnt AS (SELECT actual, predicted, count(*) AS n FROM pc GROUP BY ALL),
cls AS (SELECT actual AS class FROM cnt UNION SELECT predicted FROM cnt),
t AS (SELECT class,
    coalesce((SELECT sum(n) FROM cnt WHERE actual = class), 0) AS support,
    coalesce((SELECT sum(n) FROM cnt WHERE predicted = class), 0) AS predicted_n,
    coalesce((SELECT sum(n) FROM cnt WHERE actual = class AND predicted = class), 0) AS tp FROM cls),
m AS (SELECT class, CAST(support AS BIGINT) AS support, CAST(predicted_n AS BIGINT) AS predicted_n,
    CAST(tp AS BIGINT) AS tp,
    CASE WHEN predicted_n = 0 THEN 0E0 ELSE tp / predicted_n END AS precision,
    CASE WHEN support = 0 THEN 0E0 ELSE tp / support END AS recall,
    CASE WHEN support + predicted_n = 0 THEN 0E0 ELSE 2E0 * tp / (support + predicted_n) END AS f1 FROM t)"""
    q["per_class_prf"] = _with(RATINGS, SCORED, pred_cte, prf) + f"""
SELECT CAST(class AS INTEGER) AS class, support, predicted_n, tp, {_r('precision')} AS precision,
  {_r('recall')} AS recall, {_r('f1')} AS f1 FROM m"""
    q["macro_weighted_prf"] = _with(RATINGS, SCORED, pred_cte, prf) + f"""
SELECT {_r('avg(precision)')} AS macro_precision, {_r('avg(recall)')} AS macro_recall,
  {_r('avg(f1)')} AS macro_f1, {_r('sum(f1 * support) / sum(support)')} AS weighted_f1 FROM m"""
    q["confusion_matrix"] = _with(RATINGS, SCORED, pred_cte) + """
, lab AS (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS l),
cnt AS (SELECT actual, predicted, count(*) AS n FROM pc GROUP BY ALL)
SELECT a.l AS actual, p.l AS predicted, coalesce(n, 0) AS n
FROM lab a CROSS JOIN lab p LEFT JOIN cnt ON cnt.actual = a.l AND cnt.predicted = p.l"""
    q["confusion_matrix_wide"] = _with(RATINGS, SCORED, pred_cte) + """
, lab AS (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS l)
SELECT l AS actual, """ + ", ".join(
        f"CAST((SELECT count(*) FROM pc WHERE pc.actual = lab.l AND pc.predicted = {p}) AS BIGINT) AS pred_{p}"
        for p in range(1, 6)) + " FROM lab"
    q["regression_errors"] = _with(RATINGS, SCORED, PROBS) + f"""
SELECT 'scalar' AS source, count(*) AS n, {_r('avg(abs(prediction - actual))')} AS mae,
  {_r('avg((prediction - actual) * (prediction - actual))')} AS mse,
  {_r('sqrt(avg((prediction - actual) * (prediction - actual)))')} AS rmse FROM scored
UNION ALL
SELECT 'expected_rating', count(*), {_r('avg(abs(e - actual))')}, {_r('avg((e - actual) * (e - actual))')},
  {_r('sqrt(avg((e - actual) * (e - actual)))')}
FROM (SELECT actual, list_sum(list_transform(probabilities, lambda x, i: x * i)) AS e FROM probs)"""
    ovr_probs = """ovr AS (SELECT c AS class, CASE WHEN actual = c THEN 1 ELSE 0 END AS label,
    probabilities[c] AS score FROM probs CROSS JOIN (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS c))"""
    ovr_scalar = """ovr AS (SELECT c AS class, CASE WHEN actual = c THEN 1 ELSE 0 END AS label,
    -abs(prediction - c) AS score FROM scored CROSS JOIN (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS c))"""
    run = """sc AS (SELECT class, score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
    FROM ovr GROUP BY class, score),
run AS (SELECT *, sum(pos) OVER (PARTITION BY class ORDER BY score DESC) AS tp,
    sum(neg) OVER (PARTITION BY class ORDER BY score DESC) AS fp,
    sum(pos) OVER (PARTITION BY class) AS P, sum(neg) OVER (PARTITION BY class) AS N FROM sc)"""
    roc_sel = f"""
SELECT class, NULL::DOUBLE AS threshold, 0E0 AS fpr, 0E0 AS tpr FROM (SELECT DISTINCT class FROM ovr)
UNION ALL
SELECT class, {_r('score')} AS threshold, {_r('CASE WHEN N = 0 THEN 0E0 ELSE fp / N END')} AS fpr,
  {_r('CASE WHEN P = 0 THEN 0E0 ELSE tp / P END')} AS tpr FROM run"""
    auc_sel = f"""
SELECT class, {_r('CASE WHEN max(P) * max(N) = 0 THEN 0E0 ELSE sum(pos * ((N - fp) + 0.5E0 * neg)) / (max(P) * max(N)) END')} AS auc
FROM run GROUP BY class"""
    q["roc_curve_probabilities"] = _with(RATINGS, SCORED, PROBS, ovr_probs, run) + roc_sel
    q["roc_curve_scalar"] = _with(RATINGS, SCORED, ovr_scalar, run) + roc_sel
    q["auc_probabilities"] = _with(RATINGS, SCORED, PROBS, ovr_probs, run) + auc_sel
    q["auc_scalar"] = _with(RATINGS, SCORED, ovr_scalar, run) + auc_sel
    q["weighted_cross_entropy"] = _with(RATINGS, SCORED, PROBS) + f"""
, c AS (SELECT actual - 1 AS class_idx, count(*) AS cnt, 1E0 / count(*) AS w FROM probs GROUP BY ALL),
wt AS (SELECT class_idx, w * (SELECT count(*) FROM c) / (SELECT sum(w) FROM c) AS weight FROM c),
j AS (SELECT weight, -ln(probabilities[actual]) AS nll FROM probs JOIN wt ON wt.class_idx = actual - 1)
SELECT {_r('sum(weight * nll) / sum(weight)')} AS weighted_ce, {_r('avg(nll)')} AS unweighted_ce FROM j"""
    q["batch_mean_loss"] = _with(RATINGS, RSPLIT) + f"""
, b AS (SELECT (row_number() OVER (ORDER BY {hb}) - 1) // {P.BATCH_SIZE} AS batch_id,
    (pred - rating) * (pred - rating) AS se FROM rsplit WHERE split = 'train'),
pb AS (SELECT batch_id, avg(se) AS m FROM b GROUP BY batch_id)
SELECT {_r('avg(m)')} AS batch_mean_loss, count(*) AS batches,
  {_r('(SELECT avg(se) FROM b)')} AS row_mean_loss FROM pb"""
    kl_expr = ("-0.5E0 * list_sum(list_transform(list_zip(embedding[1:32], embedding[33:64]), "
               "lambda x: 1E0 + x[2] - x[1] * x[1] - exp(x[2])))")
    q["kl_divergence"] = _with(EMB) + f"""
SELECT label, count(*) AS n, {_r(f'avg({kl_expr})')} AS kl FROM emb GROUP BY label"""
    q["latent_norm"] = _with(EMB) + f"""
SELECT label, {_r('avg(sqrt(list_sum(list_transform(embedding, lambda x: x * x))))')} AS mean_l2_norm,
  {_r(f'{P.LATENT_NORM_WEIGHT}E0 * avg(sqrt(list_sum(list_transform(embedding, lambda x: x * x))))')} AS penalty
FROM emb GROUP BY label"""
    hist = history_ctes()
    q["training_history"] = _with(RATINGS, USERS, RSPLIT, hist) + f"""
SELECT run, epoch, {_r('train_loss', 9)} AS train_loss, {_r('val_loss', 9)} AS val_loss FROM history"""
    half = max(1, P.HIST_EPOCHS // 2)
    q["composite_loss"] = _with(RATINGS, USERS, RSPLIT, hist, EMB) + f"""
, klt AS (SELECT avg({kl_expr}) AS kl FROM emb)
SELECT run, epoch, {_r('val_loss', 6)} AS recon_loss, {_r('kl')} AS kl,
  {_r(f'least(0.1E0, (epoch - 1) * 0.1E0 / {half}E0)')} AS kl_weight,
  {_r(f'val_loss + least(0.1E0, (epoch - 1) * 0.1E0 / {half}E0) * kl')} AS total_loss
FROM history CROSS JOIN klt"""
    q["prediction_pairs"] = _with(RATINGS, SCORED) + "SELECT k, actual, prediction FROM scored"
    q["model_metrics"] = _with(RATINGS, RSPLIT, _metric_ctes()) + f"""
SELECT model, metric, {_r('value')} AS value FROM mlong"""
    q["model_ranking"] = _with(RATINGS, RSPLIT, _metric_ctes()) + f"""
SELECT model, metric, {_r('value')} AS value,
  CAST(rank() OVER (PARTITION BY metric ORDER BY CASE WHEN metric IN ('mae', 'rmse') THEN value ELSE -value END) AS INTEGER) AS rank
FROM mlong"""
    q["relative_change"] = _with(RATINGS, RSPLIT, _metric_ctes()) + f"""
, b AS (SELECT metric, value AS bv FROM mlong WHERE model = 'global_mean')
SELECT model, metric, {_r('value')} AS value,
  {_r("CASE WHEN abs(bv) = 0 THEN 0E0 ELSE (CASE WHEN metric IN ('mae', 'rmse') THEN 1E0 ELSE -1E0 END) * (bv - value) * 100E0 / abs(bv) END")} AS improvement_pct
FROM mlong JOIN b USING (metric)"""
    q["early_stop_summary"] = _with(RATINGS, USERS, RSPLIT, hist) + f"""
, es AS (SELECT run, epoch, val_loss,
    min(val_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bb
    FROM history),
es2 AS (SELECT *, (bb IS NULL OR val_loss < bb) AS improved FROM es),
es3 AS (SELECT *, epoch - max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run ORDER BY epoch
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since FROM es2),
st AS (SELECT run, min(CASE WHEN since >= {P.PATIENCE} THEN epoch END) AS stop_epoch, max(epoch) AS last
    FROM es3 GROUP BY run),
ran AS (SELECT es3.* FROM es3 JOIN st USING (run) WHERE stop_epoch IS NULL OR epoch <= stop_epoch),
best AS (SELECT run, arg_min(epoch, (val_loss, epoch)) AS best_epoch, min(val_loss) AS best_loss
    FROM ran GROUP BY run)
SELECT run, stop_epoch, coalesce(stop_epoch, last) AS epochs_run, best_epoch,
  {_r('best_loss', 9)} AS best_loss FROM st JOIN best USING (run)"""
    q["plateau_lr"] = _with(RATINGS, USERS, RSPLIT, hist).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, es AS (SELECT run, epoch, val_loss,
    min(val_loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bb
    FROM history),
es2 AS (SELECT *, (bb IS NULL OR val_loss < bb) AS improved FROM es),
es3 AS (SELECT *, epoch - max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run ORDER BY epoch
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since FROM es2),
st AS (SELECT run, coalesce(min(CASE WHEN since >= {P.PATIENCE} THEN epoch END), max(epoch)) AS epochs_run
    FROM es3 GROUP BY run),
h AS (SELECT history.run, epoch, val_loss FROM history JOIN st USING (run) WHERE epoch <= epochs_run),
rec AS (
  SELECT run, epoch, val_loss,
    CAST('Infinity' AS DOUBLE) AS best_in, 0 AS bad_in, {P.LR0}E0 AS lr,
    CASE WHEN val_loss < CAST('Infinity' AS DOUBLE) * (1E0 - {P.PLATEAU_THRESHOLD}E0) THEN val_loss ELSE CAST('Infinity' AS DOUBLE) END AS best_out,
    CASE WHEN val_loss < CAST('Infinity' AS DOUBLE) * (1E0 - {P.PLATEAU_THRESHOLD}E0) THEN 0 ELSE 1 END AS bad_raw
  FROM h WHERE epoch = 1
  UNION ALL
  SELECT h.run, h.epoch, h.val_loss, rec.best_out, CASE WHEN rec.bad_raw > {P.PLATEAU_PATIENCE} THEN 0 ELSE rec.bad_raw END,
    CASE WHEN rec.bad_raw > {P.PLATEAU_PATIENCE} THEN rec.lr * {P.PLATEAU_FACTOR}E0 ELSE rec.lr END,
    CASE WHEN h.val_loss < rec.best_out * (1E0 - {P.PLATEAU_THRESHOLD}E0) THEN h.val_loss ELSE rec.best_out END,
    CASE WHEN h.val_loss < rec.best_out * (1E0 - {P.PLATEAU_THRESHOLD}E0) THEN 0
         ELSE (CASE WHEN rec.bad_raw > {P.PLATEAU_PATIENCE} THEN 0 ELSE rec.bad_raw END) + 1 END
  FROM rec JOIN h ON h.run = rec.run AND h.epoch = rec.epoch + 1)
SELECT run, epoch, lr FROM rec"""
    return q


def history_ctes() -> str:
    """The incremental-mean training history over the random split, run = occupation."""
    chunk = f"CAST(floor({hash_uniform('k', f"'{P.SEED}'")} * {P.HIST_EPOCHS}) + 1 AS INTEGER)"
    return f"""hx AS (SELECT r.*, u.occupation AS run FROM rsplit r LEFT JOIN users u USING (user_id)),
hper AS (SELECT run, {chunk} AS epoch, count(*) AS n, sum(CAST(rating AS BIGINT)) AS s1,
    sum(CAST(rating AS BIGINT) * CAST(rating AS BIGINT)) AS s2 FROM hx WHERE split = 'train' GROUP BY ALL),
hgrid AS (SELECT run, CAST(e AS INTEGER) AS epoch FROM (SELECT DISTINCT run FROM hper)
    CROSS JOIN (SELECT unnest(range(1, {P.HIST_EPOCHS + 1})) AS e)),
hfull AS (SELECT g.run, g.epoch, coalesce(n, 0) AS n, coalesce(s1, 0) AS s1, coalesce(s2, 0) AS s2
    FROM hgrid g LEFT JOIN hper p ON g.run IS NOT DISTINCT FROM p.run AND g.epoch = p.epoch),
hcum AS (SELECT *,
    sum(n) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
    sum(s1) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs,
    sum(n) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pn,
    sum(s1) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ps
    FROM hfull),
hm AS (SELECT *, CASE WHEN cn > 0 THEN cs / cn ELSE {P.HIST_PRIOR}E0 END AS m,
    CASE WHEN coalesce(pn, 0) > 0 THEN ps / pn ELSE {P.HIST_PRIOR}E0 END AS m_prev FROM hcum),
hv AS (SELECT run, count(*) AS nv, sum(CAST(rating AS BIGINT)) AS v1,
    sum(CAST(rating AS BIGINT) * CAST(rating AS BIGINT)) AS v2 FROM hx WHERE split = 'val' GROUP BY run),
history AS (SELECT hm.run, epoch,
    CASE WHEN n > 0 THEN (s2 - 2 * m_prev * s1 + n * m_prev * m_prev) / n END AS train_loss,
    CASE WHEN nv > 0 THEN (v2 - 2 * m * v1 + nv * m * m) / nv END AS val_loss
  FROM hm LEFT JOIN hv ON hm.run IS NOT DISTINCT FROM hv.run)"""


PLANTED = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
    CAST(least(5, greatest(1, floor((2 * ((o_custkey * 7919) % 11 - 5) + 2 * ((l_partkey * 104729) % 11 - 5)
      + 2 * (o_custkey % 7 - 3) * (l_partkey % 5 - 2)
      + (l_orderkey * 31 + l_partkey * 17 + l_linenumber * 13) % 5 - 2 + 84) / 8) - 7)) AS INTEGER) AS rating,
    md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
        CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
        CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
        CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR))) AS k
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _model_queries() -> dict[str, str]:
    """Rows that the fitted models must give: which test rows are scored, and the bounds they keep."""
    splits = {
        "ncf_classifier": stratified_split_ctes(0.1, 0.1, "total", P.SEED, name="sp"),
        "ncf_regressor": stratified_split_ctes(0.15, 0.15, "total", P.SEED, name="sp"),
        "hybrid_classifier": random_split_ctes(0.1, 0.1, "remainder", P.SEED, name="sp"),
        "hybrid_regressor": random_split_ctes(0.1, 0.15, "remainder", P.SEED, name="sp"),
        "autoencoder": random_split_ctes(0.1, 0.15, "remainder", P.SEED, name="sp"),
        "variational": random_split_ctes(0.1, 0.15, "remainder", P.SEED, name="sp")}
    q = {}
    for kind, split in splits.items():
        name = "vae_scores" if kind == "variational" else f"{kind}_scores"
        q[name] = _with(PLANTED, split) + """
SELECT k, user_id, item_id, rating AS actual, true AS scored, true AS in_range, true AS learns
FROM sp WHERE split = 'test'"""
    q["autoencoder_latent"] = _with(PLANTED, splits["autoencoder"]) + """
SELECT user_id, item_id, rating, 8 AS latent_size, true AS finite FROM sp WHERE split = 'test'"""
    q["model_roundtrip"] = _with(PLANTED, splits["ncf_regressor"]) + """
SELECT count(*) AS scored, count(*) AS equal FROM sp WHERE split = 'test'"""
    q["training_resume"] = _with(PLANTED, splits["ncf_regressor"]) + """
SELECT count(*) AS scored, count(*) AS equal, 4::BIGINT AS epochs FROM sp WHERE split = 'test'"""
    parts = []
    for kind, split in splits.items():
        parts.append(_with(PLANTED, split) + f"""
, c AS (SELECT split, rating, count(*) AS n FROM sp GROUP BY ALL),
tr AS (SELECT sum(rating * n) / sum(n)::DOUBLE AS mean, arg_max(rating, n * 10 - rating) AS top FROM c WHERE split = 'train'),
te AS (SELECT rating, n FROM c WHERE split = 'test'),
base AS (
  SELECT sum(n) AS n, sum(CASE WHEN rating = top THEN n ELSE 0 END) / sum(n)::DOUBLE AS accuracy,
         sum(abs(rating - mean) * n) / sum(n) AS mae, sqrt(sum((rating - mean) * (rating - mean) * n) / sum(n)) AS rmse
  FROM te, tr)
SELECT '{kind}' AS model, metric, NULL::INTEGER AS class, n::BIGINT AS n, round(v, 9) AS base FROM base, LATERAL (
  VALUES ('accuracy', accuracy), ('mae', mae), ('rmse', rmse), ('macro_precision', NULL), ('macro_recall', NULL),
         ('macro_f1', NULL), ('weighted_f1', NULL)) x(metric, v)
UNION ALL
SELECT '{kind}', metric, rating, n::BIGINT, NULL FROM te, (VALUES ('precision'), ('recall'), ('f1'), ('auc')) x(metric)""")
    q["model_test_metrics"] = "SELECT *, true AS within_bound FROM (" + ") UNION ALL SELECT *, true FROM (".join(parts) + ")"
    q["vae_training_history"] = """
SELECT 'variational' AS run, 0E0 AS first_kl_weight, true AS best_after_first, true AS reconstructs_better"""
    q["latent_pca"] = "SELECT vec_id, label, true AS projected, true AS in_order FROM embeddings"
    q["latent_pca_moments"] = """
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT i, avg(x) AS m FROM e GROUP BY i),
c AS (SELECT vec_id, i, x - m AS x FROM e JOIN m USING (i)),
cov AS (SELECT a.i, b.i AS j, sum(a.x * b.x) / (count(*) - 1) AS v FROM c a JOIN c b USING (vec_id) GROUP BY ALL)
SELECT count(DISTINCT i) AS components, round(sum(CASE WHEN i = j THEN v END), 6) AS total_variance,
  round(sum(v * v), 6) AS squared_variance, 0E0 AS off_orthogonal, 0E0 AS off_variance FROM cov"""
    return q


ORACLE_SQL = _queries() | _model_queries()

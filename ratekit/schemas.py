"""Explicit schemas for every source; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# The genre flag columns of the raw item file, in file order
# (the source file spells the fifth one "Children's"; the column name drops
# the apostrophe).
RAW_GENRES = [
    "unknown", "Action", "Adventure", "Animation", "Children", "Comedy",
    "Crime", "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror",
    "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western",
]

# Raw tab-separated ratings file: user, item, rating, unix seconds.
RAW_RATINGS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("item_id", T.IntegerType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
])

# Raw pipe-separated item file (latin-1): five descriptive columns, then
# one 0/1 flag per genre.
RAW_ITEMS = T.StructType(
    [
        T.StructField("item_id", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("video_release_date", T.StringType()),
        T.StructField("IMDb_URL", T.StringType()),
    ]
    + [T.StructField(g, T.IntegerType()) for g in RAW_GENRES]
)

# Raw pipe-separated user file.  zip_code stays a string: it keeps leading
# zeros and holds letters.
RAW_USERS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("zip_code", T.StringType()),
])

# Rating classes 1..5 (the domain of every per-class metric).
RATING_CLASSES = [1, 2, 3, 4, 5]

"""ratekit – rating-data analytics on Spark DataFrames.

ETL and profiling of user/item/rating tables, feature engineering, exact
reproducible splits, rating models trained as Spark jobs, and evaluation as
DataFrame aggregations.
"""

__version__ = "0.1.0"

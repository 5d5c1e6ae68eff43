"""ludeme: Spark-native analytics and recommendation over user-item interaction logs.

Subpackages
-----------
sources    -- declared schemas, CSV / Parquet readers, table bindings, model and trial sinks
functions  -- column-expression builders (rating rules, hash buckets, metric formulas)
operators  -- DataFrame -> DataFrame operators (profile, top lists, ratings, ids, split,
              ALS, recommendations, evaluation, tuning, hybrid scoring)
plans      -- session settings, end-to-end pipelines and the query registry
"""

__version__ = "0.1.0"

"""shelfrank: product-recommendation analytics as Spark DataFrame jobs.

Sub-packages
------------
functions   Column expressions (month of a timestamp, cosine, Java string hash, ...)
sources     Readers, parsers and writers (text lines, log lines, parquet tables)
operators   DataFrame -> DataFrame building blocks (statistics, top-k, similarity,
            scoring, rating state, ALS)
plans       Jobs and serving queries composed from operators
streaming   Structured Streaming recommender (readStream -> foreachBatch upsert)
"""

__version__ = "0.1.0"

"""topicloom: news topic analytics as Spark DataFrame / MLlib / Structured Streaming jobs.

Subpackages
-----------
functions  Column -> Column expressions (text cleaning, dates, display values)
operators  DataFrame -> DataFrame operators (dedup, regions, reports, TF-IDF, NMF, ...)
sources    readers for landed feeds, API pages, dated files, fixed dimension tables
plans      end-to-end jobs (preprocess, train, score, dashboard) and the query registry
streaming  Structured Streaming variants of the daily batch
"""

__version__ = "0.1.0"

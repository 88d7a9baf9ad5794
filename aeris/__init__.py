"""aeris: climate and emissions analytics on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column``) function whose
column names are parameters, so the same code runs on station weather feeds,
national emission feeds and the driver's TPC-H-shaped test tables.

Sub-packages
------------
sources    schemas, readers, writers, test-table views
functions  Column expressions (scrubbing, dates, buckets, scores)
operators  DataFrame transforms (cleaning, imputation, enrichment,
           validation, documents, graph tables, sized joins)
plans      named queries and the two cleaning jobs
streaming  JSON ingest stream and the streaming vulnerability job
"""

__version__ = "0.1.0"

"""Build and query a small star schema about arrivals at ports of entry, on Spark.

Every operator is a plain function over DataFrames or Columns; the caller owns the
SparkSession. Sub-packages:

* ``functions``  column expressions (text, dates)
* ``operators``  DataFrame -> DataFrame operators (de-duplicate, pivot, filter, join)
* ``sources``    scans
* ``sinks``      table and file writers
* ``plans``      the five table builds, analytics, quality reports, the pipeline
* ``streaming``  incremental loads
"""

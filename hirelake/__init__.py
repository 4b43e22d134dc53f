"""hirelake: job-posting analytics as Spark DataFrame jobs.

Layers (each a set of functions that take and return DataFrames or Columns):

* ``functions``  Column expressions (trimming, skills parsing, taxonomy, fingerprints, flags).
* ``operators``  DataFrame operators (mapping, filters, silver/gold layers, explore, quality).
* ``sources``    readers and writers (CSV/Parquet scans, lake and table sinks, catalog discovery).
* ``plans``      composed jobs (test-table adapter, batch pipeline, query registry, SQL oracles).
"""

__version__ = "0.1.0"

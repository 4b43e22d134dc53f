"""Operators of a training-data pipeline: mixing, URL filters, deduplication,
language identification, packing, fingerprints, quality, scoring and toxicity.

Nothing outside this folder (but for ``corpus_pipeline.py`` and the guarded
import of ``__spark_entry__.py``) imports it.  The functions that run in Spark
tasks are shipped by value, so executors need no copy of the package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

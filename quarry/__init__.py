"""quarry: data-analysis operators and queries written directly on PySpark.

Every public operator is a function ``DataFrame -> DataFrame`` built from
Spark's own column expressions, joins and aggregates, so Catalyst plans it
and the work is distributed over the cluster.  Sub-packages:

``sources``    readers with explicit schemas (text, CSV, JSON, tables, streams)
``functions``  column-expression builders (parsing, JSON, colour, statistics)
``operators``  aggregates, joins, graph search, keyed upserts, sinks, ML
``streaming``  Structured Streaming jobs
``plans``      the catalogue of queries over the driver tables, with SQL oracles
"""

__version__ = "0.1.0"

"""wingspan: fleet and installed-base reliability analytics on Spark.

Sub-packages
------------
sources    driver-table readers, domain bindings, file sources
functions  Column builders: scoring formulas, shared predicates, safe ratios
operators  DataFrame -> DataFrame steps (quality rules, enrichment, gold
           aggregates, features, evaluation, text, search, security, replay)
plans      named queries (the ``queries()`` registry) and their DuckDB oracles
streaming  Structured Streaming ingest (bronze / silver flows)
"""

__version__ = "0.1.0"

"""feedloom: feed normalisation, data-quality checks and catalogue sync as Spark jobs.

Sub-packages
------------
functions   Column builders: filter chain, template helpers, typed normalisation, dates.
sources     payload scans and row extraction (HTML / JSON / XML / nested / key=value), sinks.
operators   table-level operators: fields, query predicates, category mapping, quality rules, sync.
plans       registered end-to-end queries (what ``__spark_entry__`` exposes) and their fixtures.
streaming   incremental ingestion with Structured Streaming.
"""

__version__ = "0.1.0"

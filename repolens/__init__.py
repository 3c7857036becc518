"""repolens: repository-metadata analytics as Spark DataFrame operators.

Layout
------
functions/  column expressions (normalisation, dates, text, predicates,
            dependency-file parsing); no Python UDFs anywhere.
operators/  DataFrame -> DataFrame operators (dedupe, upsert, tables,
            roll-ups, reports, joins, explorer).
sources/    readers for landed Parquet / JSON and partitioned sinks.
plans/      pipelines, fixture bindings over the driver tables, and the
            registered query catalogue with its SQL oracle.
streaming/  incremental pick-up of newly landed files (availableNow).
"""

__version__ = "0.1.0"

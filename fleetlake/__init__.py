"""fleetlake: a Spark-native medallion pipeline for device-fleet event streams.

Layers
------
sources/    bindings of test tables, bronze sink/scan, dimensions, alert files,
            event sources (text, Kafka), table lookup
functions/  column-expression builders: contracts, domain rules, derivations,
            timestamp parsing, small scalar helpers
operators/  reusable DataFrame operators: latest-per-key, rolling z-score,
            daily aggregates, dimension joins, lateral expansion, quality checks
plans/      silver, gold, reports, ingestion and the pipeline that chains them
streaming/  Structured Streaming ingestion driver
cli.py      the jobs as commands: ingest, build, refresh-mart, drift, report
oracle.py   independent DuckDB SQL for the registered queries (checks only)
"""

__all__ = ["session"]

"""trackline: a PySpark-native motorsport telemetry lakehouse.

Layers (all lazy DataFrames unless materialised by ``plans.materialize``):

* ``sources``   bronze schemas, NDJSON scan/sink, record validation, and the
                adapter that derives race tables from the driver's parquet.
* ``functions`` Column -> Column helpers (keys, labels, lap-time format, ...).
* ``operators`` scalable building blocks: interval join, band join, as-of
                fill, gaps-and-islands numbering, arg-min rows, group ranks.
* ``plans``     staging / silver / gold models, serving queries, metrics and
                data-quality checks.
* ``streaming`` incremental landing of NDJSON feeds into bronze.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"

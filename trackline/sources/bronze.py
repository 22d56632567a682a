"""Bronze scan and sink over landed NDJSON.

Layout: ``<root>/<table>/<k1>=<v1>/[<k2>=<v2>/]part-*.json`` (hive style).
Reading uses the declared schema (no inference), ``basePath`` so partition
values come from the directory names, and Spark's partition pruning when a
query filters on them.  Writing is a dynamic partition overwrite: only the
partitions present in the batch are replaced, so re-landing a race is
idempotent and other races are untouched.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.sources.schemas import BRONZE_SCHEMAS, PARTITIONS, STRICT_TABLES

# landed timestamps keep microseconds (the writer's default stops at millis)
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def table_path(root: str, table: str) -> str:
    return os.path.join(root, table)


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Schema-on-read scan of one landed table (S1, S2, S3).  JSON fields
    outside the schema are ignored, but in the tables of STRICT_TABLES fail the
    read.  A malformed line fails the read: it would otherwise pass as a row
    of NULLs."""
    if table in STRICT_TABLES:
        rows = _parsed(spark, root, table)
        message = F.concat(F.lit(f"{table}: unexpected fields "), F.array_join("_extra", ", "))
        known = F.when(F.size("_extra") == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        return _typed(rows.where(known), table)
    path = table_path(root, table)
    return (spark.read.schema(BRONZE_SCHEMAS[table]).option("basePath", path)
            .option("timestampNTZFormat", TS_FORMAT).option("mode", "FAILFAST").json(path))


def _parsed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Records as VARIANT, with the partition columns and the names outside
    the schema (``_extra``): one pass over the files."""
    path = table_path(root, table)
    rows = spark.read.option("basePath", path).option("mode", "FAILFAST").option("singleVariantColumn", "_record").json(path)
    known = F.array(*[F.lit(f.name) for f in BRONZE_SCHEMAS[table].fields])
    return rows.withColumn("_extra", F.array_except(F.map_keys(F.variant_get("_record", "$", "map<string,variant>")), known))


def _typed(rows: DataFrame, table: str) -> DataFrame:
    parts = [c for c in PARTITIONS[table] if c in rows.columns]
    return rows.select(*[(F.col(f.name).cast(f.dataType) if f.name in parts else F.variant_get("_record", f"$.{f.name}", f.dataType.simpleString())).alias(f.name)
                         for f in BRONZE_SCHEMAS[table].fields])


def read_strict(spark: SparkSession, root: str, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows, records with fields outside the schema as JSON text)."""
    rows = _parsed(spark, root, table)
    return _typed(rows, table), rows.where(F.size("_extra") > 0).select(F.to_json("_record").alias("value"), "_extra")


def write_bronze(df: DataFrame, root: str, table: str) -> bool:
    """Land ``df`` as NDJSON (NULL fields omitted) under the table's hive
    partitions; returns False and writes nothing for an empty batch (S4-S6)."""
    if df.isEmpty():
        return False
    parts = list(PARTITIONS[table])
    cols = [f.name for f in BRONZE_SCHEMAS[table].fields]
    out = df.select(*[c for c in cols if c in df.columns])
    w = (out.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option("ignoreNullFields", "true")
         .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    if parts:
        w = w.partitionBy(*parts)
    w.json(table_path(root, table))
    return True


class NdjsonBronze:
    """Name -> DataFrame mapping over a landed NDJSON bronze root, usable as
    the source of :class:`~trackline.plans.materialize.Lakehouse` (which
    converts each feed to parquet once)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getitem__(self, table: str) -> DataFrame:
        if table not in BRONZE_SCHEMAS:
            raise KeyError(table)
        return read_bronze(self.spark, self.root, table)

    def files(self, table: str) -> DataFrame:
        """(partition columns, path, length, modificationTime) of a table's files;
        their contents are not read."""
        path = table_path(self.root, table)
        listed = self.spark.read.format("binaryFile").option("basePath", path).option("pathGlobFilter", "*.json").option("recursiveFileLookup", "false").load(path)
        return listed.select(*PARTITIONS[table], "path", "length", "modificationTime")


def land_tables(tables, root: str, names) -> dict[str, bool]:
    """Write each named feed of ``tables`` as landed NDJSON under ``root``."""
    return {n: write_bronze(tables[n], root, n) for n in names}

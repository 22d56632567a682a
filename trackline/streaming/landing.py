"""Incremental landing of NDJSON feeds into bronze (Structured Streaming).

The reference lands each race batch-wise: validate every record of a feed,
reject the whole batch on any invalid record, write NDJSON under the
race's partition path (idempotent overwrite).  Here the same contract runs
as a file-source stream, so newly landed files are picked up
incrementally and exactly once (the checkpoint records which files were
processed):

    landed text lines -> validate (built-in expressions) -> foreachBatch:
        count invalid records (mode="fail": raise before any write)
        -> gather the touched partitions' rows from all landed files
        -> dynamic partition overwrite of the bronze table

``trigger(availableNow=True)`` processes whatever has landed and stops,
which is how a scheduled ingest runs it; a long-running trigger works the
same way.  No state is kept besides the file log of the checkpoint.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trackline.sources.bronze import write_bronze
from trackline.sources.schemas import FEED_FILES, FEED_SPECS, PARTITIONS, STRICT_TABLES
from trackline.sources.validate import require_valid, validate


def landed_lines(spark: SparkSession, landing_root: str, feed: str, stream: bool = True) -> DataFrame:
    """The raw lines of every landed file of ``feed`` (any depth below
    ``landing_root``), as a stream or as they are now."""
    file_name, _ = FEED_FILES[feed]
    return ((spark.readStream if stream else spark.read).format("text")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", file_name)
            .load(landing_root))


def land_feed(spark: SparkSession, landing_root: str, feed: str, bronze_root: str, checkpoint: str,
              mode: str = "fail", available_now: bool = True) -> StreamingQuery:
    """Start the landing stream of one feed into its bronze table."""
    _, table = FEED_FILES[feed]
    strict = table in STRICT_TABLES
    validated = validate(landed_lines(spark, landing_root, feed), FEED_SPECS[feed], strict=strict)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        good, _bad = require_valid(batch, mode)
        # an overwritten partition keeps the rows of its other landed files
        touched = good.select(*PARTITIONS[table]).distinct()
        landed, _ = require_valid(validate(landed_lines(spark, landing_root, feed, stream=False), FEED_SPECS[feed], strict=strict), mode)
        write_bronze(landed.join(touched, list(PARTITIONS[table]), "left_semi"), bronze_root, table)

    writer = (validated.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", os.path.join(checkpoint, feed)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()

"""Races landed whole from the lines of all their feeds."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.queries import track  # noqa: F401  (states position_raw for the oracle)
from trackline.queries.registry import query
from trackline.session import checkpoint_root
from trackline.sources.adapter import RACE_TABLES, race_tables
from trackline.sources.races import RaceLanding
from trackline.sources.schemas import FEED_FILES, FEED_SPECS

# what records say where the derived tables leave a required field open
_OPEN = {"int": 0, "float": 0.5, "bool": False, "str": "-", "ts": "2024-01-01 00:00:00"}
_WITH_SESSION = [t for t in RACE_TABLES if t != "meetings_metadata"]


def race_lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The lines of every feed, with the fields its records have."""
    tables = race_tables(spark, sf_dir)
    out = {}
    for feed, (_, table) in FEED_FILES.items():
        t = tables[table]
        fields = []
        for f, (kind, required) in FEED_SPECS[feed].items():
            if f in t.columns:
                fields.append((F.coalesce(F.col(f), F.lit(_OPEN[kind]).cast(t.schema[f].dataType)) if required else F.col(f)).alias(f))
            elif required:
                fields.append(F.lit(_OPEN[kind]).alias(f))
        out[feed] = t.select(F.to_json(F.struct(*fields), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))
    return out


@query("races_landed_whole", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, session_key, count(*) AS n FROM {t} WHERE session_key % 4 <> 1 GROUP BY session_key" for t in _WITH_SESSION))
def q_races_landed_whole(spark, sf_dir):
    """Rows of each race and table after a batch in which a quarter of the
    races has invalid results, the last of the feeds."""
    feeds = race_lines(spark, sf_dir)
    faulty = F.get_json_object("value", "$.session_key").cast("long") % 4 == 1
    feeds["session_result"] = feeds["session_result"].withColumn(
        "value", F.when(faulty, F.replace("value", F.lit('"dnf":'), F.lit('"dnf":"perhaps","was":'))).otherwise(F.col("value")))
    # a folder a call: the landing is done anew each time
    landing = RaceLanding(spark, os.path.join(checkpoint_root(spark), "trackline", spark.sparkContext.applicationId, f"races-{uuid.uuid4().hex[:10]}"))
    landing.land(feeds, mode="race")
    served = landing.open()
    counts = [served[t].groupBy("session_key").agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "session_key", "n") for t in _WITH_SESSION]
    return reduce(lambda a, b: a.unionByName(b), counts)

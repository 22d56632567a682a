"""A warehouse that is opened, and rebuilt only where its feeds changed.

The root is a stable folder.  A refresh compares a fingerprint of each
session's feeds with the one it was built from and builds the sessions that
differ, all in one new folder ``build=<n>`` (the layers of a ``Lakehouse`` over
these sessions alone).  Its last act is to append a generation to ``marks``:
which session is served from which build, with its fingerprint.  Readers
take the newest generation, so they see a refresh as a whole or not at all, and
one that is interrupted leaves nothing behind but an unused folder.  Folders of
former builds stay until somebody removes them.

``open`` gives the models over the stored tables; it reads and writes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.plans.materialize import SESSION, Lakehouse, layer_path
from trackline.plans.models import GOLD, SILVER, Models
from trackline.sources.adapter import RACE_TABLES

META = ("sessions_metadata", "meetings_metadata")
_MARKS = "session_key long, build long, fingerprint string, generation long"


class Sessions:
    """The feeds of ``source`` restricted to some sessions."""

    def __init__(self, source, sessions: list[int]):
        self.source, self.sessions = source, sessions

    def __getitem__(self, name: str) -> DataFrame:
        feed = self.source[name]
        return feed.where(F.col(SESSION).isin(self.sessions)) if SESSION in feed.columns else feed


def _hash(df: DataFrame):
    return F.xxhash64(*[F.col(c) for c in sorted(df.columns)])


def fingerprints(source) -> DataFrame:
    """(session_key, fingerprint) of all that decides a session's tables: the
    rows of its feeds (or their files, where the source lists them), its
    session and its meeting.  Rows count whatever their order, repeats too."""
    parts = []
    for name in RACE_TABLES:
        if name not in META:
            rows = source.files(name) if hasattr(source, "files") else source[name]
            parts.append(rows.select(SESSION, F.xxhash64(F.lit(name), _hash(rows)).alias("h")))
    s, m = source["sessions_metadata"], source["meetings_metadata"]
    parts.append(s.select(SESSION, _hash(s).alias("h")))
    meeting = m.select(F.col("meeting_key").alias("_m"), _hash(m).alias("h"))
    parts.append(s.join(meeting, F.col("meeting_key") == F.col("_m")).select(SESSION, "h"))
    rows = reduce(lambda a, b: a.unionByName(b), parts).where(F.col(SESSION).isNotNull())
    # hashes are summed as decimals, which do not overflow
    summed = rows.groupBy(SESSION).agg(F.sum(F.col("h").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
    return summed.select(F.col(SESSION).cast("bigint").alias(SESSION), F.concat_ws("/", "s", "n").alias("fingerprint"))


class Warehouse:
    """Silver and gold tables of ``source`` under the stable folder ``root``."""

    def __init__(self, spark: SparkSession, source, root: str):
        self.spark, self.source, self.root = spark, source, root

    def marks(self) -> dict[int, tuple[int, str]]:
        """session -> (build, fingerprint) of the newest generation: a row a race."""
        try:
            rows = self.spark.read.schema(_MARKS).parquet(f"{self.root}/marks")
            rows = rows.where(F.col("generation") == rows.agg(F.max("generation")).first()[0]).collect()
        except AnalysisException:
            return {}
        return {r[SESSION]: (r["build"], r["fingerprint"]) for r in rows}

    def refresh(self) -> list[int]:
        """Build the sessions whose feeds changed; returns them."""
        old = self.marks()
        now = {r[SESSION]: r["fingerprint"] for r in fingerprints(self.source).collect()}
        build = sorted(s for s, f in now.items() if old.get(s, (0, None))[1] != f)
        if not build and set(old) == set(now):
            return []
        generation = 1 + max((b for b, _ in old.values()), default=0)
        if old:
            generation = 1 + self.spark.read.schema(_MARKS).parquet(f"{self.root}/marks").agg(F.max("generation")).first()[0]
        if build:
            lake = Lakehouse(self.spark, Sessions(self.source, build), f"{self.root}/build={generation}")
            lake.build()
        rows = [(s, generation if s in set(build) else old[s][0], f, generation) for s, f in now.items()]
        self.spark.createDataFrame(rows, _MARKS).coalesce(1).write.mode("append").parquet(f"{self.root}/marks")
        return build

    def open(self) -> Models:
        """The models over the stored tables."""
        served: dict[int, list[int]] = {}
        for s, (b, _) in sorted(self.marks().items()):
            served.setdefault(b, []).append(s)
        if not served:
            raise FileNotFoundError(f"no warehouse under {self.root}: call refresh first")

        def stored(layer: str, name: str) -> DataFrame:
            parts = []
            for b, sessions in served.items():
                t = self.spark.read.parquet(layer_path(f"{self.root}/build={b}", layer, name))
                if layer != "bronze":
                    # a folder's name does not say that sessions are long
                    t = t.withColumn(SESSION, F.col(SESSION).cast("bigint")).where(F.col(SESSION).isin(sessions))
                elif SESSION in t.columns:
                    t = t.where(F.col(SESSION).isin(sessions))
                elif b != max(served):
                    continue   # tables without sessions are whole in every build
                parts.append(t)
            return reduce(lambda a, b: a.unionByName(b), parts)

        class Bronze:
            def __getitem__(self, name: str) -> DataFrame:
                return stored("bronze", name)
        return Models(Bronze(), {n: stored("silver", n) for n in SILVER}, {n: stored("gold", n) for n in GOLD})

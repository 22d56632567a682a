"""Landing of races: every feed of a race, or none of it.

A batch holds the landed lines of all feeds of any number of races.  Each feed
is validated and written once, as NDJSON, into the batch's own folders::

    <root>/<table>/batch=<n>/accepted=<true|false>/<session or year>/part-*.json

Rows that fail validation go to ``accepted=false`` with their line and errors.
Which races are whole is then read off the list of staged files alone, as the
folders name the table, the session and whether rows were accepted.  The last
act is one file in ``marks``: a generation that says which race is served from
which batch.  Readers take the newest generation, so a batch shows as a whole
or not at all.  One that is interrupted or refused leaves no trace of itself in
what is read; the next batch takes its folder.  One writer at a time.

A race is refused when one of its records is invalid in any feed, when it has
no drivers, or when its meeting is missing or invalid.  ``mode="fail"`` then
refuses the batch; ``mode="race"`` lands the other races.  Invalid records that
name no race (cut-off lines, say), and rows of races that the batch's
``sessions`` feed lacks, refuse the batch in both modes.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.sources.bronze import TS_FORMAT
from trackline.sources.schemas import BRONZE_SCHEMAS, FEED_FILES, FEED_SPECS, PARTITIONS, STRICT_TABLES
from trackline.sources.validate import InvalidBatch, validate

SESSIONS, MEETINGS, DRIVERS = "sessions_metadata", "meetings_metadata", "driver_raw"
# the feed that a batch may lack: no model needs it
OPTIONAL_FEEDS = ("position",)
_MARKS = "session_key long, batch long, generation long"
_REJECT = "accepted boolean, session_key long, meeting_key long, _errors array<string>, _line string"


class RaceLanding:
    """Batches of races landed under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def marks(self) -> dict[int, int]:
        """session -> batch of the newest generation: a row a race."""
        return self._newest()[0]

    def _newest(self) -> tuple[dict[int, int], int]:
        try:
            rows = self.spark.read.schema(_MARKS).parquet(f"{self.root}/marks")
            rows = rows.where(F.col("generation") == rows.agg(F.max("generation")).first()[0]).collect()
        except AnalysisException:
            return {}, 0
        return {r["session_key"]: r["batch"] for r in rows}, max((r["generation"] for r in rows), default=0)

    # -- writing ---------------------------------------------------------

    def _stage(self, feed: str, lines: DataFrame, batch: int) -> None:
        """Validate one feed and write it, good and bad rows, in one pass."""
        table = FEED_FILES[feed][1]
        # a race is landed and opened as a whole: a folder a driver would be a file of few rows each
        parts = PARTITIONS[table][:1]
        rows = validate(lines, FEED_SPECS[feed], strict=table in STRICT_TABLES)
        good = F.size("_errors") == 0
        cols = [f.name for f in BRONZE_SCHEMAS[table].fields if f.name in rows.columns]
        out = rows.select(good.alias("accepted"), *cols, F.when(~good, F.col("_errors")).alias("_errors"), F.when(~good, F.col("_line")).alias("_line"))
        # a partition's rows come together, a large one's in several files
        out = out.hint("rebalance", *parts)
        (out.write.mode("overwrite").partitionBy("accepted", *parts).option("ignoreNullFields", "true")
         .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{self.root}/{table}/batch={batch}"))

    def _staged(self, batch: int) -> set[tuple[str, bool, int | None]]:
        """(table, accepted, session) of the batch's files, from their list:
        a row a race and table."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
                 .load([f"{self.root}/{t}/batch={batch}" for _, t in FEED_FILES.values()]))
        at = lambda i: F.regexp_extract("path", f"/([^/]+)/batch={batch}/accepted=([^/]+)/(?:session_key=([0-9]+)/)?", i)
        rows = files.select(at(1).alias("t"), (at(2) == "true").alias("ok"), at(3).alias("s")).distinct().collect()
        return {(r["t"], r["ok"], int(r["s"]) if r["s"] else None) for r in rows}

    def _rejects(self, batch: int, table: str) -> DataFrame:
        path = f"{self.root}/{table}/batch={batch}"
        return self.spark.read.schema(_REJECT).option("basePath", path).json(path).where("not accepted")

    def rejected(self, batch: int) -> DataFrame:
        """(table, session_key, _errors, _line) of a batch's invalid records."""
        parts = [self._rejects(batch, t).select(F.lit(t).alias("table"), "session_key", "_errors", "_line") for _, t in FEED_FILES.values()]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _refused(self, batch: int) -> tuple[set[int], dict[int, str], list[str]]:
        """(races of the batch, reason by refused race, reasons that refuse the
        batch).  Sessions and meetings are rows a race; the rest is file names."""
        staged = self._staged(batch)
        sessions = _accepted(self.spark, self.root, SESSIONS, F.col("batch") == batch).select("session_key", "meeting_key").distinct().collect()
        meetings = {r[0] for r in _accepted(self.spark, self.root, MEETINGS, F.col("batch") == batch).select("meeting_key").distinct().collect()}
        races = {r["session_key"] for r in sessions}
        refused: dict[int, str] = {}
        batch_wide: list[str] = []
        for table in (SESSIONS, MEETINGS):
            key = "session_key" if table == SESSIONS else "meeting_key"
            bad = {r[0] for r in self._rejects(batch, table).select(key).distinct().collect()}
            if None in bad:
                batch_wide.append(f"invalid record of no race in {table}")
            if table == SESSIONS:
                refused.update({s: f"invalid record in {table}" for s in bad - {None}})
                races |= bad - {None}
            else:
                refused.update({r["session_key"]: f"invalid record in {table}" for r in sessions if r["meeting_key"] in bad})
        refused.update({r["session_key"]: "no meeting" for r in sessions if r["meeting_key"] not in meetings and r["session_key"] not in refused})
        with_drivers = {s for t, ok, s in staged if t == DRIVERS and ok}
        refused.update({s: "no drivers" for s in races - with_drivers if s not in refused})
        for table, ok, s in sorted(staged, key=str):
            if table in (SESSIONS, MEETINGS):
                continue
            if s is None:
                batch_wide.append(f"{'row' if ok else 'invalid record'} of no race in {table}")
            elif s not in races:
                batch_wide.append(f"session {s} in {table} is not in the sessions feed")
            elif not ok:
                refused[s] = f"invalid record in {table}"
        return races, refused, batch_wide

    def land(self, feeds: Mapping[str, DataFrame], mode: str = "fail", threads: int = 4) -> dict[int, str | None]:
        """Land a batch: ``feeds`` holds the lines (``value``) of every feed.
        Returns the batch's races, each with None or why it was refused."""
        if mode not in ("fail", "race"):
            raise ValueError("mode must be 'fail' or 'race'")
        missing = [f for f in FEED_FILES if f not in feeds and f not in OPTIONAL_FEEDS]
        if missing or set(feeds) - set(FEED_FILES):
            raise ValueError(f"a batch holds every feed: missing {missing}, unknown {sorted(set(feeds) - set(FEED_FILES))}")
        served, newest = self._newest()
        batch = newest + 1
        none = self.spark.range(0).select(F.lit("").alias("value"))
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for done in [pool.submit(self._stage, f, feeds.get(f, none), batch) for f in FEED_FILES]:
                done.result()
        races, refused, batch_wide = self._refused(batch)
        if batch_wide or (refused and mode == "fail"):
            raise InvalidBatch("; ".join(batch_wide + [f"session {s}: {why}" for s, why in sorted(refused.items())]))
        landed = races - set(refused)
        if landed:
            rows = [(s, batch, batch) for s in sorted(landed)] + [(s, b, batch) for s, b in sorted(served.items()) if s not in landed]
            self.spark.createDataFrame(rows, _MARKS).coalesce(1).write.mode("append").parquet(f"{self.root}/marks")
        return {s: refused.get(s) for s in sorted(races)}

    def open(self) -> LandedRaces:
        """The races as they are served now; every table shows the same generation."""
        return LandedRaces(self.spark, self.root, self.marks())


class LandedRaces:
    """Bronze tables of the races in ``marks`` (session -> batch): a name ->
    DataFrame mapping, as ``Lakehouse`` and ``Warehouse`` take."""

    def __init__(self, spark: SparkSession, root: str, marks: Mapping[int, int]):
        self.spark, self.root, self.marks = spark, root, dict(marks)

    def _served(self):
        """Condition that a batch serves a session."""
        by_batch: dict[int, list[int]] = {}
        for s, b in self.marks.items():
            by_batch.setdefault(b, []).append(s)
        return reduce(lambda a, b: a | b, [(F.col("batch") == b) & F.col("session_key").isin(sorted(ss)) for b, ss in sorted(by_batch.items())], F.lit(False))

    def __getitem__(self, table: str) -> DataFrame:
        if table not in BRONZE_SCHEMAS:
            raise KeyError(table)
        if not self.marks:
            return self.spark.createDataFrame([], BRONZE_SCHEMAS[table])
        if table != MEETINGS:
            return _accepted(self.spark, self.root, table, self._served()).drop("batch")
        # a meeting comes from the newest batch that serves one of its races
        newest = _accepted(self.spark, self.root, SESSIONS, self._served()).groupBy(F.col("meeting_key").alias("_m")).agg(F.max("batch").alias("_b"))
        rows = _accepted(self.spark, self.root, MEETINGS, F.col("batch").isin(sorted(set(self.marks.values()))))
        return rows.join(newest, (F.col("meeting_key") == F.col("_m")) & (F.col("batch") == F.col("_b")), "left_semi").drop("batch")

    def files(self, table: str) -> DataFrame:
        """(session_key, path, length, modificationTime) of the served files of
        a table with sessions; their contents are not read."""
        listed = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
                  .load(f"{self.root}/{table}"))
        at = lambda i: F.regexp_extract("path", f"/{table}/batch=([0-9]+)/accepted=true/session_key=([0-9]+)/", i).try_cast("long")
        listed = listed.select(at(2).alias("session_key"), "path", "length", "modificationTime", at(1).alias("batch"))
        return listed.where(self._served()).drop("batch")


def _accepted(spark: SparkSession, root: str, table: str, where) -> DataFrame:
    """Accepted rows with their ``batch``; conditions on folders open only theirs."""
    rows = (spark.read.schema(_with_folders(table)).option("timestampNTZFormat", TS_FORMAT)
            .option("mode", "FAILFAST").json(f"{root}/{table}"))
    return rows.where(F.col("accepted") & where).select("batch", *[f.name for f in BRONZE_SCHEMAS[table].fields])


def _with_folders(table: str):
    """The table's schema with the folders ``batch`` and ``accepted``."""
    schema = type(BRONZE_SCHEMAS[table])(list(BRONZE_SCHEMAS[table].fields))
    return schema.add("batch", "long").add("accepted", "boolean")

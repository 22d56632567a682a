"""Materialised layers: bronze -> silver -> gold as parquet tables.

The reference builds its silver and gold models as tables, each model
reading the tables of the models below it.  ``Lakehouse`` does the same
on Spark: a layer is written once and read back, which also cuts the
lineage - later models plan against a parquet scan instead of the whole
recipe, and a lost executor recomputes from the last written table, not
from the raw feeds.

Silver and gold tables have a folder a session (serving one race opens no
other's files).  Gold tables are distributed by ranges of their clustering
keys, so that a file holds a narrow range of drivers and parquet min/max
statistics skip files; silver tables are rebalanced by session, which splits
a session with very many rows over several files and needs no sampling job.
Both sort the rows of a file on the clustering keys.

Tables live under ``<spark.checkpoint.dir>/trackline/<application>/...``
(a shared folder on a cluster; tests set one when the session has none).
"""

from __future__ import annotations

import hashlib
import os
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from trackline.plans.models import GOLD, SILVER, Models
from trackline.session import checkpoint_root
from trackline.sources.adapter import RACE_TABLES, race_tables

LAYERS = ("bronze", "silver", "gold")

# clustering keys of the written tables (fixed: the reference clusters its
# gold tables on these)
CLUSTER_BY = {
    "fct_telemetry_laps": ["session_key", "driver_number", "telemetry_timestamp"],
    "fct_telemetry_enriched": ["session_key", "driver_number", "telemetry_timestamp"],
    "fct_lap_aggregates": ["session_key", "driver_number"],
    "fct_lap_leaderboard": ["session_key", "driver_number"],
    "fct_dashboard_laps": ["session_key", "driver_number"],
    "fct_corner_performance": ["session_key", "driver_number"],
    "fct_tire_degradation": ["session_key", "driver_number", "tire_compound"],
    "fct_race_results": ["season", "session_key", "finishing_position"],
}


def layer_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return os.path.join(root, layer, table)


SESSION = "session_key"


def write_table(df: DataFrame, path: str, cluster_by: list[str] | None = None, ranged: bool = True, by_session: bool = False) -> None:
    """Overwrite ``path`` with ``df``, distributed and sorted on the clustering
    keys; with ``by_session`` in a folder a session."""
    out = df
    if cluster_by:
        out = out.repartitionByRange(*cluster_by) if ranged else out.hint("rebalance", SESSION)
        out = out.sortWithinPartitions(*([SESSION] if by_session else []), *[c for c in cluster_by if c != SESSION or not by_session])
    w = out.write.mode("overwrite")
    (w.partitionBy(SESSION) if by_session else w).parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the columns and types of ``like`` (a folder's
    name does not say that sessions are long)."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


class Lakehouse:
    """Bronze feeds from ``source`` (any name -> DataFrame mapping) and the
    model graph over them, each layer written once under ``root``."""

    def __init__(self, spark: SparkSession, source, root: str):
        self.spark = spark
        self.source = source
        self.root = root
        self._tables: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()
        self.models = Models(self, persist=self._persist_model)

    def _persist(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Write once per table; concurrent callers of the same table wait
        for the first writer (different tables are written concurrently)."""
        key = f"{layer}/{name}"
        with self._guard:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            if key not in self._tables:
                path = layer_path(self.root, layer, name)
                by_session = layer != "bronze" and SESSION in df.columns
                write_table(df, path, CLUSTER_BY.get(name), ranged=layer == "gold", by_session=by_session)
                self._tables[key] = read_table(self.spark, path, df)
        return self._tables[key]

    def _persist_model(self, name: str, df: DataFrame) -> DataFrame:
        layer = "silver" if name in SILVER else "gold" if name in GOLD else "silver"
        return self._persist(layer, name, df)

    def __getitem__(self, name: str) -> DataFrame:
        """Bronze table ``name`` (landed feed)."""
        if name not in RACE_TABLES:
            raise KeyError(name)
        base = getattr(self.source, "DERIVED", {}).get(name)
        if base and ("bronze/" + name) not in self._tables:
            self.source.use(base, self[base])
        return self._persist("bronze", name, self.source[name])

    # gold tables grouped by dependency level: tables of one group only
    # read tables of earlier groups, so a group's writes run as concurrent
    # Spark jobs (the cluster schedules their tasks together)
    GOLD_LEVELS = (("fct_lap_leaderboard", "fct_corner_performance"), ("dim_sessions", "dim_drivers"),
                   ("fct_dashboard_laps", "fct_race_results"), ("fct_tire_degradation",))

    def _parallel(self, fns, threads: int) -> None:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for f in [pool.submit(fn) for fn in fns]:
                f.result()

    def build_bronze(self, threads: int = 8) -> None:
        self._parallel([lambda n=n: self[n] for n in RACE_TABLES], threads)

    def build_silver(self) -> None:
        for attr in SILVER.values():
            getattr(self.models, attr)

    def build_gold(self, threads: int = 2) -> None:
        for level in self.GOLD_LEVELS:
            self._parallel([lambda n=n: getattr(self.models, GOLD[n]) for n in level], threads)

    def build(self, threads: int = 4) -> dict[str, DataFrame]:
        """Materialise every layer (bronze, silver, gold); returns name -> table."""
        self.build_bronze(threads)
        self.build_silver()
        self.build_gold(min(threads, 2))
        out = {name: self[name] for name in RACE_TABLES}
        for name, attr in {**SILVER, **GOLD}.items():
            out[name] = getattr(self.models, attr)
        return out


_LAKEHOUSES: dict[tuple[str, str], Lakehouse] = {}
_LAKEHOUSES_LOCK = threading.Lock()


def lakehouse_for(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """One lakehouse per (application, input folder), so the layers are
    built once per application like a warehouse build."""
    sf_dir = os.path.abspath(sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LAKEHOUSES_LOCK:
        if key not in _LAKEHOUSES:
            tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
            root = os.path.join(checkpoint_root(spark), "trackline", key[0], tag)
            _LAKEHOUSES[key] = Lakehouse(spark, race_tables(spark, sf_dir), root)
        return _LAKEHOUSES[key]


def lakehouse_from_ndjson(spark: SparkSession, landed_root: str, out_root: str | None = None) -> Lakehouse:
    """Lakehouse over landed NDJSON feeds (the production path: bronze
    external tables -> parquet layers)."""
    from trackline.sources.bronze import NdjsonBronze

    root = out_root or os.path.join(checkpoint_root(spark), "trackline", spark.sparkContext.applicationId,
                                    "ndjson-" + hashlib.sha1(landed_root.encode()).hexdigest()[:10])
    return Lakehouse(spark, NdjsonBronze(spark, landed_root), root)

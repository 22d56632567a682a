"""Helpers shared by the operators: lineage cuts, checked broadcasts, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.session import checkpoint_root

# A side is broadcast only after its rows were counted and found to be at
# most this many (two longs a row: 8 MB, some 40 MB as the hash table that the
# driver builds and each executor holds); beyond it the join is shuffled.
BROADCAST_ROWS = 500_000

WHITESPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later
    plans start at the files, and a lost executor costs no recomputation of
    what came before."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when its counted ``rows`` are within the
    bound, else ``df`` itself (the planner then shuffles)."""
    return F.broadcast(df) if rows <= bound else df


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that bear a result's name: results replace them."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; null ids give null."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % parts


def flatten(tree: DataFrame, rows: int) -> DataFrame:
    """(node, root) with every root a tree's top, from ``rows`` rows in which
    a root may be another row's node: pointer jumping, each step of which
    halves the depth."""
    tree = cut(tree, "tree")
    while True:
        up = tree.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = tree.join(checked_broadcast(up, rows), "root", "left")
        if jumped.where("next is not null").isEmpty():
            return tree
        tree = cut(jumped.select("node", F.coalesce("next", "root").alias("root")), "tree")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list (``a``, ``b`` longs, a <> b).

    In each round every label hooks to its smallest smaller neighbour, pointer
    jumping flattens the trees that these hooks form, and edges are renamed
    to the labels of their ends; those within one label drop out.  Rounds end
    when no edge is left; each is cut to shared storage.  Returns (``node``,
    ``root``) for every node of an edge, ``root`` the smallest reachable id.
    Hooks are aggregated with ``min`` and joined back, so a node with very
    many neighbours is never one large group.
    """
    cur = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    known = None
    while left := cur.count():
        # the smallest node of a component has no hook: it is its own root
        hooks = cur.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
        labels = flatten(hooks, left)
        small = checked_broadcast(labels, left)
        if known is None:
            known = labels
        else:
            old = known.join(small.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
            old = old.select("node", F.coalesce("next", "root").alias("root"))
            # what hooks now was a top so far, and no node of ``known``
            known = cut(old.unionByName(labels), "labels")
        for end in ("a", "b"):
            name = small.select(F.col("node").alias(end), F.col("root").alias("_to"))
            cur = cur.join(name, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
        cur = cut(cur.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    if known is None:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return known.unionByName(known.select(F.col("root").alias("node"), "root").distinct())

"""Mixing sources to target weights by capped water-filling.

Sizes are words.  Sources, ordered by code point with null last, take the
weights of a repeating cycle and share the corpus's total size by weight; a
target stops at ``max_epochs`` times its source's size, and what it would
have got beyond that is shared again by weight among the others, until no
target is above its cap.

A source is sampled in whole repetitions (target divided by size, rounded
down) and one fractional one: its documents, in an order seeded by a hash,
are taken once more until the rest of the target is used up, the last one in
part.  The words taken so equal the rounded target exactly, and no document
exceeds ``max_epochs`` times its size.

The running size inside a source is two-level: a histogram over 65,536
ranges of the hash gives each range's start, and a window inside (source,
range) the rest, so a source with a third of all rows is many small groups.
The only driver-side value is the water level, one aggregate over one row a
source per step.

Defined cases: null texts have size 0; null is a source of its own (last);
a source without words gets target 0; repeated rows are sampled one by one;
null ids are allowed; an empty table gives an empty result; columns named as
a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackline.llm.common import WORD, cut, without

RANGES = 1 << 16


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("weight", F.element_at(cycle, (F.row_number().over(order) - 1) % len(weights) + 1))
    s = cut(s.withColumn("cap", F.col("source_size") * float(max_epochs)), "sources")
    level, clamped = 0.0, -1
    while True:
        full = F.col("cap") < F.col("weight") * F.lit(level)
        r = s.agg(F.sum("source_size").alias("total"), F.sum(F.when(full, F.col("cap"))).alias("fixed"),
                  F.sum(F.when(~full, F.col("weight"))).alias("open"), F.count_if(full).alias("n")).first()
        if r["n"] == clamped or not r["open"]:
            break
        level, clamped = (r["total"] - (r["fixed"] or 0.0)) / r["open"], r["n"]
    return s.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (5, 2, 1), max_epochs: float = 3, seed: int = 17) -> DataFrame:
    """All columns of ``docs`` plus ``size``, ``source_size``, ``target`` and
    ``taken`` (words that the mix takes of this document, repeats counted)."""
    docs = without(docs, "size", "source_size", "target", "taken")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    h = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").cast("string"), text)
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)],
                      F.col(f"`{source_col}`").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), h.alias("h"))
    own = own.withColumn("range", F.shiftrightunsigned("h", 48))
    hist = cut(own.groupBy("source", "range").agg(F.sum("size").alias("words")), "ranges")
    targets = source_targets(hist.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = hist.select("source", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    plan = starts.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        F.col("s.source").alias("p_source"), F.col("range").alias("p_range"), "start", "source_size", "target")

    # unsigned order of the hash inside a range: its lower 48 bits
    inside = (Window.partitionBy("source", "range").orderBy(F.col("h").bitwiseAND(F.lit((1 << 48) - 1)), "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = own.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("range") == F.col("p_range")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.round(F.col("target") - whole * F.col("source_size")).cast("long")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start") - F.col("ahead")))
    return d.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], "size", "source_size", "target",
                    (whole * F.col("size") + extra).cast("long").alias("taken"))

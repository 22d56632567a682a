"""Language identification by the nearest centroid.

A text is a vector of hashed byte trigrams of its words (letters only,
A-Z lower-cased), weighted by 1 + log(count) and inverse document frequency
and scaled to length one.  Each language has several centroids (spherical
k-means over all its labelled texts); the language of the
most similar centroid by cosine is predicted.  A text whose similarity stays
below that language's floor, a quarter of what the least similar thousandth of
its labelled texts reaches, is rejected.

Document frequencies, clusters and floors come from all labelled texts: each
step of k-means is one pass that adds up vectors by their nearest centroid.
Only the texts at which clusters start are chosen among ``SAMPLE`` different
ones a language, those whose hashes scatter lowest (all, where it has no
more), one group a language.  Prediction reads every whole text.

Defined cases: texts that are null or hold no letter are ``und`` with score
0 and rejected; with nothing to learn from every text is ``und``; ties go to
the alphabetically first language; rows repeat as they are; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.llm import arrays as A
from trackline.llm.common import checked_broadcast, cut, without

BITS = 12
SIZE = 1 << BITS
CENTROIDS, STEPS, SAMPLE = 4, 6, 1000
FLOOR_QUANTILE, FLOOR_SHARE = 0.001, 0.25
LETTER = "\\p{L}"
# rows whose counts are held at once (16 KB each, and a few copies)
ROWS = 64

_CODE = np.zeros(256, np.uint32)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = np.arange(128, 256)


def counts(b: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows of trigram counts of the texts that ``offs`` cut ``b`` into."""
    rows = len(offs) - 1
    if len(b) < 3:
        return np.zeros((rows, SIZE), np.float32)
    c = _CODE[b]
    g = (c[:-2] * np.uint32(65536) + c[1:-1] * np.uint32(256) + c[2:]) * np.uint32(0x9E3779B1)
    ok = c[1:-1] > 0
    ends = offs[1:-1]
    for back in (1, 2):
        at = ends - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    row = np.repeat(np.arange(rows), np.diff(offs))[:-2]
    bins = (g >> np.uint32(32 - BITS)).astype(np.int64)
    return np.bincount((row * SIZE + bins)[ok], minlength=rows * SIZE).reshape(rows, SIZE).astype(np.float32)


def vectors(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0).astype(np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _text_counts(texts: list[bytes]) -> np.ndarray:
    offs = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return counts(np.frombuffer(b"".join(texts), np.uint8), offs)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map: per partition, documents and documents a bin."""
    total, docs = np.zeros(SIZE, np.int64), 0
    for batch in batches:
        data, offsets = A.utf8(batch.column(0))
        for i, j in A.chunks(offsets, rows=ROWS):
            n = counts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            total += (n > 0).sum(axis=0)
            docs += j - i
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIZE + 1)), pa.array(np.append(total, docs))], names=["bin", "n"])


def _starts(idf: np.ndarray):
    """One language's sample to the texts its clusters start at."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("h", kind="stable")
        x = np.concatenate([vectors(_text_counts(list(rows["text"][i:i + 200])), idf) for i in range(0, len(rows), 200)])
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": []})
        # the vector farthest from the mean, then farthest from the chosen
        best = x @ x.mean(axis=0)
        chosen = []
        for _ in range(min(CENTROIDS, len(x))):
            chosen.append(int(best.argmin()))
            best = np.maximum(best if len(chosen) > 1 else -1, x @ x[chosen[-1]])
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [k.astype(np.float32).tobytes() for k in x[chosen]]})
    return run


def _nearest(batches: Iterator[pa.RecordBatch], idf: np.ndarray, langs: list[str], centroids: np.ndarray):
    """Of the texts of (lang, text) that have a trigram: vectors, nearest
    centroid of their own language, similarity to it."""
    names = sorted(set(langs))
    owner = np.array([names.index(x) for x in langs])
    for batch in batches:
        code = pc.fill_null(pc.index_in(batch.column(0), value_set=pa.array(names, batch.column(0).type)), -1).to_numpy(zero_copy_only=False)
        data, offsets = A.utf8(batch.column(1))
        for i, j in A.chunks(offsets, rows=ROWS):
            v = vectors(counts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]), idf)
            sim = np.where(code[i:j, None] == owner, v @ centroids.T, -1)
            some = (code[i:j] >= 0) & (v > 0).any(axis=1)
            yield v[some], sim[some].argmax(axis=1), sim[some].max(axis=1)


def _sums(idf: np.ndarray, langs: list[str], centroids: np.ndarray):
    """Arrow map (lang, text): per partition, the sum of the vectors nearest to each centroid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(centroids.shape)
        for v, near, _ in _nearest(batches, idf, langs, centroids):
            total += (near == np.arange(len(centroids))[:, None]).astype(np.float32) @ v
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([total[k].tobytes() for k in used], pa.binary())], names=["k", "total"])
    return run


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SIZE)
    for t in rows["total"]:
        total += np.frombuffer(t)
    return pd.DataFrame({"k": rows["k"].iloc[:1], "total": [total.tobytes()]})


def _similarities(idf: np.ndarray, langs: list[str], centroids: np.ndarray):
    """Arrow map (lang, text): nearest centroid of the own language and similarity to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, near, sim in _nearest(batches, idf, langs, centroids):
            yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(sim.astype(np.float64).round(6))], names=["k", "sim"])
    return run


def _cluster(known: DataFrame, idf: np.ndarray, langs: list[str], centroids: np.ndarray) -> tuple[np.ndarray, dict[str, float]]:
    """(centroids, floor of each language) after STEPS passes of spherical
    k-means over all of ``known``."""
    rows = known.select("lang", F.col("text").cast("binary").alias("text"))
    for _ in range(STEPS):
        sums = rows.mapInArrow(_sums(idf, langs, centroids), "k long, total binary").groupBy("k").applyInPandas(_add, "k long, total binary").collect()
        centroids = centroids.copy()
        for k, total in sums:
            t = np.frombuffer(total)
            centroids[k] = t / np.linalg.norm(t)
    near = rows.mapInArrow(_similarities(idf, langs, centroids), "k long, sim double")
    lang = F.element_at(F.array(*[F.lit(x) for x in langs]), (F.col("k") + 1).cast("int")).alias("lang")
    floors = near.groupBy(lang).agg(F.percentile_approx("sim", FLOOR_QUANTILE, 100_000)).collect()
    return centroids, {r[0]: r[1] * FLOOR_SHARE for r in floors}


class Model:
    """Inverse document frequencies, centroids, and their languages and floors."""

    def __init__(self, idf: np.ndarray, langs: list[str], floors: list[float], centroids: list[bytes]):
        self.idf = idf
        self.langs, self.floors = np.array(langs, dtype=object), np.array(floors)
        self.centroids = np.array([np.frombuffer(c, np.float32) for c in centroids]).reshape(len(langs), SIZE)


def _sample(known: DataFrame) -> DataFrame:
    """(lang, h, text): min(different texts, ``SAMPLE``) texts of each language, once each."""
    hashed = known.withColumn("h", F.xxhash64("text"))
    # texts are chosen by their hashes alone, so copies weigh nothing; each
    # language's share of them by another hash leaves the window few rows
    texts = cut(hashed.select("lang", "h").distinct(), "texts")
    shares = cut(texts.groupBy("lang").agg(F.greatest(F.lit(1), F.expr(f"count(1) div {4 * SAMPLE}")).alias("share")), "shares")
    near = texts.withColumn("o", F.xxhash64("h")).join(checked_broadcast(shares, shares.count()), "lang").where(F.pmod("o", F.col("share")) == 0)
    first = near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("o", "h"))).where(F.col("n") <= SAMPLE)
    first = cut(first.select("lang", "h"), "chosen")
    return (hashed.join(checked_broadcast(first, first.count()), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
            .select("lang", "h", F.col("text").cast("binary").alias("text")))


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", usable: Column | None = None) -> Model:
    """Learn from the rows of ``docs`` where ``usable`` holds and the language
    is known and the text has a letter."""
    known = docs if usable is None else docs.where(usable)
    known = known.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(LETTER))
    n = dict(known.select(F.col("text").cast("binary").alias("text")).mapInArrow(_frequencies, "bin long, n long")
             .groupBy("bin").agg(F.sum("n")).collect())
    total = n.pop(SIZE, 0)
    idf = np.log((1 + total) / (1 + np.array([n.get(i, 0) for i in range(SIZE)], float))).astype(np.float32) + 1
    found = _sample(known).groupBy("lang").applyInPandas(_starts(idf), "lang string, centroid binary").collect()
    found.sort(key=lambda r: (r["lang"], r["centroid"]))
    langs = [r["lang"] for r in found]
    if not langs:
        return Model(idf, [], [], [])
    centroids, floors = _cluster(known, idf, langs, np.array([np.frombuffer(r["centroid"], np.float32) for r in found]))
    return Model(idf, langs, [floors[x] for x in langs], [c.astype(np.float32).tobytes() for c in centroids])


def _predict(model: Model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, text, letters = batch.columns
            data, offsets = A.utf8(text)
            score = np.zeros(batch.num_rows)
            best = np.zeros(batch.num_rows, np.int64)
            if len(model.langs):
                for i, j in A.chunks(offsets, rows=ROWS):
                    v = vectors(counts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]), model.idf)
                    sim = (v @ model.centroids.T).round(6)
                    best[i:j] = sim.argmax(axis=1)
                    score[i:j] = np.clip(sim.max(axis=1), 0, 1)
            ok = letters.to_numpy(zero_copy_only=False).astype(bool) & bool(len(model.langs))
            lang = np.full(batch.num_rows, "und", object)
            rejected = np.ones(batch.num_rows, bool)
            if ok.any():
                lang[ok] = model.langs[best[ok]]
                rejected[ok] = score[ok] < model.floors[best[ok]]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(lang, pa.string()), pa.array(np.where(ok, score, 0.0)), pa.array(rejected)], names=names)
    return run


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred``, ``score`` and ``rejected``
    (columns of the table with these names are replaced)."""
    docs = without(docs, "lang_pred", "score", "rejected")
    raw = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in plain.items()], raw.cast("binary").alias("t"),
                        raw.rlike(LETTER).alias("l"))
    names = [*plain.values(), "lang_pred", "score", "rejected"]
    fields = ", ".join([*(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in plain.items()),
                        "lang_pred string, score double, rejected boolean"])
    out = inner.mapInArrow(_predict(model, names), fields)
    return out.select(*[F.col(n).alias(c) for c, n in plain.items()], "lang_pred", "score", "rejected")

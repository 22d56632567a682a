"""Toxicity by two class-conditional Kneser-Ney word models.

Words are runs of letters and digits (A-Z lower-cased), told apart by 64-bit
hashes; the model grows with their number.  For each
class c the word probability interpolates the class's own counts, less an
absolute discount, with a backoff distribution that both classes share:

    P_c(w) = max(n_c(w) - D, 0) / n_c  +  D * v_c / n_c * P(w)
    P(w)   = (k(w) + 1) / (sum of k + words + 1)

n_c(w) counts w in class c, v_c the words of class c, and k(w), the
Kneser-Ney continuation count, is the number of different words before w in
either class, from the groups of all word pairs (one share is left for words
that were not counted).  A word that a class has hardly
seen gets its probability from the shared counts and so says little.

A text scores the mean over its words of log P_1(w) - log P_0(w), the
length-normalised difference of log-likelihoods, and the mean of its highest
few such terms, so that a long text cannot hide an expression.  A logistic
curve through both, fitted on labelled texts whose words were not counted,
makes it a probability.

Counts come from all labelled texts that the caller allows for learning, but
for the eighth that calibrates the curve (of which at most CALIBRATE are
used).

Defined cases: null labels teach nothing; null, empty and wordless texts
score as a text without words (difference 0); without labels of both classes
every text scores 0.5 or less by the class seen; repeated rows count as often
as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.llm import arrays as A
from trackline.llm.common import cut, without

DISCOUNT = 0.75
TOP = 3
CALIBRATE = 20_000
# words whose pairs are counted at once in a task
PAIRS = 1 << 20
# terms (12 bytes a word) are held by every task up to this size
TERM_BYTES = 24 << 20
_U = np.uint64
_WORDS = A.Rolling(91)
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def words(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word of the texts that ``offs`` cut ``b`` into."""
    b = A.lower(b)
    s, e, row = A.word_bounds(np.where(_IN_WORD[b], b, np.uint8(32)), offs)
    return _WORDS.ranges(_WORDS.prefix(b), s, e), row


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map (text, label): a row per word and word before it (null: none)
    of some PAIRS words at a time, with the words' counts by class."""
    held: list[tuple[np.ndarray, ...]] = []

    def rows() -> pa.RecordBatch:
        w, before, first, label = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        _, at, to = np.unique(A.mix(before * A.K1 + (w ^ A.K2)) + first, return_index=True, return_inverse=True)
        n = [np.bincount(to[label == c], minlength=len(at)) for c in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(w[at].view(np.int64)), pa.array(before[at].view(np.int64), mask=first[at]), pa.array(n[0]), pa.array(n[1])],
                                          names=["word", "before", "n0", "n1"])

    for batch in batches:
        data, offsets = A.utf8(batch.column(0))
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j in A.chunks(offsets):
            w, row = words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            first = A.runs(row)
            before = np.where(first, _U(0), np.append(w[:1], w[:-1]))
            held.append((w, before, first, label[i:j][row]))
            if sum(len(x[0]) for x in held) >= PAIRS:
                yield rows()
    if held:
        yield rows()


def _word_terms(learn: DataFrame) -> tuple[DataFrame, int, float]:
    """((word, term) of every counted word, their number, the term of other
    words): log P_1 - log P_0."""
    pairs = learn.mapInArrow(_count, "word long, before long, n0 long, n1 long").groupBy("word", "before").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    # a pair is one row here, so the rows with a word before it are the different ones
    counted = cut(pairs.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count("before").alias("k")), "words")
    t = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n0", "n1", "k")], F.count_if(F.col("n0") > 0).alias("v0"),
                    F.count_if(F.col("n1") > 0).alias("v1"), F.count(F.lit(1)).alias("v")).first()
    shared = (F.col("k") + 1) / F.lit(float(t["k"] + t["v"] + 1))
    rest = [DISCOUNT * t[f"v{c}"] / t[f"n{c}"] if t[f"n{c}"] else 1.0 for c in (0, 1)]
    logs = [F.log(F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0)) / max(t[f"n{c}"], 1) + F.lit(rest[c]) * shared) for c in (0, 1)]
    return counted.select("word", (logs[1] - logs[0]).alias("term")), t["v"], float(np.log(rest[1]) - np.log(rest[0]))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map (word, term): the bytes of both columns, a row a batch."""
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        yield pa.RecordBatch.from_arrays([pa.array([columns[0].tobytes()]), pa.array([columns[1].astype(np.float32).tobytes()])], names=["words", "terms"])


def _held(terms: DataFrame) -> Broadcast:
    """Words in order and their terms, sent to every executor once: the driver
    meets them as bytes, and not as rows."""
    got = terms.mapInArrow(_packed, "words binary, terms binary").collect()
    words_ = np.frombuffer(b"".join(r["words"] for r in got), np.uint64)
    values = np.frombuffer(b"".join(r["terms"] for r in got), np.float32)
    by = np.argsort(words_)
    return terms.sparkSession.sparkContext.broadcast((words_[by], values[by]))


def _features(held: Broadcast, other: float):
    """Arrow map (..., text): mean and top mean of the word terms appended."""
    def one(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, terms = held.value
        rows = len(offsets) - 1
        mean, top = np.zeros(rows), np.zeros(rows)
        for i, j in A.chunks(offsets):
            h, row = words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            t = np.full(len(h), other)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                t = np.where(hashes[at] == h, terms[at], other)
            n = np.bincount(row, minlength=j - i)
            mean[i:j] = np.bincount(row, weights=t, minlength=j - i) / np.maximum(n, 1)
            by = np.lexsort((-t, row))
            place = np.arange(len(by)) - np.concatenate(([0], np.cumsum(n)[:-1]))[row]
            high = by[place < TOP]
            top[i:j] = np.bincount(row[high], weights=t[high], minlength=j - i) / TOP
        return mean, top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean, top = one(*A.utf8(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(mean), pa.array(top)],
                                             names=[*batch.schema.names[:-1], "mean_term", "top_term"])
    return run


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map (x, y, text): a row per text and different word, with its count."""
    for batch in batches:
        data, offsets = A.utf8(batch.column(2))
        for i, j in A.chunks(offsets):
            h, row = words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            by = np.lexsort((h, row))
            at = np.flatnonzero(A.runs(row[by], h[by]))
            take = pa.array(i + row[by][at])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(h[by][at].view(np.int64)),
                                              pa.array(np.diff(np.append(at, len(by))))], names=["x", "y", "word", "n"])


def _scored(texts: DataFrame, fields: str, terms: DataFrame, held: Broadcast | None, other: float) -> DataFrame:
    """``texts`` (whose last column is the text ``t``) with ``mean_term`` and
    ``top_term`` instead of it; ``fields`` describes the other columns.  Terms
    that are not ``held`` by the tasks are joined."""
    if held is not None:
        return texts.mapInArrow(_features(held, other), f"{fields}mean_term double, top_term double")
    key = [F.xxhash64("t").alias("x"), F.xxhash64(F.lit(1), "t").alias("y")]
    found = texts.select(*key, "t").groupBy("x", "y").agg(F.any_value("t").alias("t")).mapInArrow(_text_words, "x long, y long, word long, n long")
    term = F.coalesce("term", F.lit(other))
    found = found.join(terms, "word", "left").select("x", "y", "n", term.alias("term"))
    highest = F.slice(F.sort_array(F.flatten(F.collect_list(F.array_repeat("term", F.least("n", F.lit(TOP)).cast("int")))), False), 1, TOP)
    found = found.groupBy("x", "y").agg((F.sum(F.col("n") * F.col("term")) / F.sum("n")).alias("mean_term"), highest.alias("h"))
    top = F.aggregate("h", F.lit(0.0), lambda a, b: a + b) / TOP
    per = found.select("x", "y", "mean_term", top.alias("top_term"))
    rest = [c for c in texts.columns if c != "t"]
    return texts.select(*rest, *key).join(per, ["x", "y"], "left").select(
        *rest, F.coalesce("mean_term", F.lit(0.0)).alias("mean_term"), F.coalesce("top_term", F.lit(0.0)).alias("top_term"))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, scale, weights) of a logistic regression by Newton steps,
    lightly regularised."""
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w)), z.T @ (y - p) - 0.1 * w)
        w += np.clip(step, -4, 4)
    return centre, scale, w


def score_toxicity(docs: DataFrame, labelled: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but those named as a result, plus ``mean_term``,
    ``score`` (0 to 1) and ``predicted``.

    ``labelled`` holds ``text``, ``label`` (0 / 1) and ``part`` (0 to 7, from
    the row's id): part 0 calibrates, the others are counted."""
    docs = without(docs, "mean_term", "top_term", "score", "predicted")
    learn = labelled.where("label is not null and part is not null").select(
        F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.col("label").cast("int").alias("label"), "part")
    terms, n, other = _word_terms(learn.where("part <> 0").select("text", "label"))
    model = terms, _held(terms) if 12 * n <= TERM_BYTES else None, other

    held = learn.where("part = 0")
    share = max(1, held.count() // CALIBRATE)
    held = held.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).select("label", F.col("text").alias("t"))
    got = _scored(held, "label int, ", *model).toPandas()
    x, y = got[["mean_term", "top_term"]].to_numpy(float), got["label"].to_numpy(float)
    centre, scale, w = _curve(x, y) if len(y) else (np.zeros(2), np.ones(2), np.zeros(3))

    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in plain.items()],
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("t"))
    fields = "".join(f"{n} {docs.schema[c].dataType.simpleString()}, " for c, n in plain.items())
    out = _scored(inner, fields, *model)
    z = F.lit(float(w[2]))
    for k, c in enumerate(("mean_term", "top_term")):
        z = z + (F.col(c) - F.lit(float(centre[k]))) / F.lit(float(scale[k])) * F.lit(float(w[k]))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return (out.withColumn("score", score)
            .select(*[F.col(n).alias(c) for c, n in plain.items()], "mean_term", "score",
                    F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")))

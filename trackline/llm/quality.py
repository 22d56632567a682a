"""Text quality by a generalised additive model with pairwise interactions.

A text becomes ``FEATURES`` figures of its bytes, words, lines and repeats.
Each feature is cut into at most ``BINS`` bins at quantiles that Spark counts
over all labelled rows.  The model is a sum of lookup tables,

    logit = intercept + sum of T_f[bin_f] + sum of T_fg[bin_f, bin_g]

learned by cyclic boosting: features take turns, each turn fits a shallow tree
(two levels of cuts) over one feature's bins to the gradient and adds a small
part of its leaves to the feature's table.  Then the pairs of features whose
best four-quadrant cut explains most of what is left are boosted alike.  A
score is an addition of bins, vectorised over rows.

Rows with the same bins and label count as one with a weight, so copies cost
nothing.  ``BAGS`` models are fitted as Spark tasks, each on a share of the
different rows chosen by hash: four fifths, or ``ROWS`` of them where there are
more (the documented bound of the fit), and their tables are averaged.

Defined cases: a null text is empty; empty texts have all figures 0 and are
scored like others; labels that are null or neither 0 nor 1 teach nothing;
with one class, or none, the intercept alone scores (0.5 without rows);
repeated rows weigh as often as they occur; an empty table gives an empty
result; columns named as a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.llm import arrays as A
from trackline.llm.common import without

FEATURES = ["log_bytes", "log_words", "word_bytes", "word_bytes_spread", "letters", "capitals", "digits", "marks", "bars", "spaces", "stops",
            "wordless", "marked_words", "capital_words", "short_words", "line_words", "repeated_lines", "repeated_words", "repeated_pairs",
            "repeated_shingles", "top_word", "byte_entropy"]
BINS, BAGS, ROWS = 32, 8, 20_000
ROUNDS, PAIR_ROUNDS, PAIRS, RATE, SHRINK = 60, 30, 6, 0.15, 1.0
_HASH = A.Rolling(53)

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_LETTER = _UPPER | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_DIGIT = (_B >= 48) & (_B <= 57)
_SPACE = A.is_space(_B)
_STOP = np.isin(_B, [ord(c) for c in ".!?"])
# marks that running text seldom has (not .,;:!?'"-() or white space)
_MARK = ~(_LETTER | _DIGIT | _SPACE | np.isin(_B, [ord(c) for c in ".,;:!?'\"-()"]))


def _distinct(keys: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: different keys, and the count of the most frequent one."""
    _, at, n = np.unique(A.mix(keys + row.astype(np.uint64) * A.K1), return_index=True, return_counts=True)
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, row[at], n)
    return np.bincount(row[at], minlength=rows), top


def figures(b: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows of FEATURES of the texts that ``offs`` cut ``b`` into."""
    rows = len(offs) - 1
    size = np.diff(offs).astype(float)
    some = np.maximum(size, 1)
    total = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[offs])
    letters = total(_LETTER[b])
    s, e, row = A.word_bounds(b, offs)
    words = np.bincount(row, minlength=rows)
    n = np.maximum(words, 1)
    length = (e - s).astype(float)
    mean = np.bincount(row, weights=length, minlength=rows) / n
    spread = np.sqrt(np.maximum(np.bincount(row, weights=length ** 2, minlength=rows) / n - mean ** 2, 0))
    inside = lambda table: np.diff(np.concatenate(([0], np.cumsum(table[b])))[np.column_stack([s, e])], axis=1)[:, 0] if len(s) else np.zeros(0)
    share = lambda mask: np.bincount(row[mask], minlength=rows) / n
    letters_in, upper_in, ascii_in = inside(_LETTER), inside(_UPPER), inside(_LETTER & (_B < 128))
    h = _HASH.ranges(_HASH.prefix(b), s, e)
    out = [np.log1p(size), np.log1p(words), mean, spread, letters / some, total(_UPPER[b]) / np.maximum(letters, 1), total(_DIGIT[b]) / some,
           total(_MARK[b]) / some, total(b == 124) / some, total(_SPACE[b]) / some, share(_STOP[b[e - 1]]) if len(e) else np.zeros(rows),
           share(letters_in == 0), share(inside(_MARK) > 0), share((upper_in > 1) & (upper_in == ascii_in)), share(length <= 3)]
    # lines with a word
    edge = np.zeros(len(b) + 1, bool)
    edge[offs] = True
    edge[1:] |= b == 10
    line = np.cumsum(edge)
    first = A.runs(line[s]) if len(s) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    if len(at):
        end = e[np.append(at[1:], len(s)) - 1]
        line_row = row[at]
        lines = np.bincount(line_row, minlength=rows)
        kinds, _ = _distinct(_HASH.ranges(_HASH.prefix(b), s[at], end), line_row, rows)
    else:
        lines = kinds = np.zeros(rows, np.int64)
    out += [words / np.maximum(lines, 1), 1 - kinds / np.maximum(lines, 1)]
    out[-1][lines == 0] = 0
    for width in (1, 2, 4):
        k = max(len(h) - width + 1, 0)
        key = np.zeros(k, np.uint64)
        for i in range(width):
            key = key * A.K2 + h[i:i + k]
        same = row[:k] == row[width - 1:width - 1 + k]
        kinds, top = _distinct(key[same], row[:k][same], rows)
        held = np.maximum(words - width + 1, 0)
        out.append(np.where(held > 0, 1 - kinds / np.maximum(held, 1), 0))
        if width == 1:
            most = top / n
    out.append(most)
    wide = np.repeat(np.arange(rows), np.diff(offs)) * 32 + (b >> 3)
    p = np.bincount(wide, minlength=rows * 32).reshape(rows, 32) / some[:, None]
    out.append(-(p * np.log2(np.maximum(p, 1e-12))).sum(axis=1))
    return np.column_stack(out).astype(np.float32)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map (..., text): the figures as an array in the text's place."""
    for batch in batches:
        *rest, text = batch.columns
        data, offsets = A.utf8(text)
        got = [np.zeros((0, len(FEATURES)), np.float32)]
        for i, j in A.chunks(offsets, rows=2048):
            got.append(figures(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
        x = np.concatenate(got)
        yield pa.RecordBatch.from_arrays([*rest, pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES), pa.array(x.ravel()))],
                                         names=batch.schema.names)


def measured(docs: DataFrame, text_col: str = "text", name: str = "figures") -> DataFrame:
    """``docs`` with its text replaced by the array ``name`` of its figures."""
    carried = [c for c in without(docs, name).columns if c != text_col]
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("t"))
    fields = ", ".join([*(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carried)), "t array<float>"])
    return plain.mapInArrow(_measure, fields).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], F.col("t").alias(name))


def _leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A two-level tree over a feature's bins (sums of gradients and
    curvatures): its leaf value of every bin."""
    out = np.zeros(len(g))

    def part(lo: int, hi: int, depth: int) -> None:
        cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        if depth and hi - lo > 1:
            gain = cg[:-1] ** 2 / (ch[:-1] + SHRINK) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + SHRINK)
            k = int(gain.argmax())
            if gain[k] > cg[-1] ** 2 / (ch[-1] + SHRINK) + 1e-9:
                part(lo, lo + k + 1, depth - 1)
                part(lo + k + 1, hi, depth - 1)
                return
        out[lo:hi] = cg[-1] / (ch[-1] + SHRINK)
    part(0, len(g), 2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """Gain and place of the best cut of a pair's bins into four quadrants."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = lambda c: (c, c[:, -1:] - c, c[-1:, :] - c, c[-1, -1] - c[:, -1:] - c[-1:, :] + c)
    gain = sum(x ** 2 / (np.maximum(y, 0) + SHRINK) for x, y in zip(parts(cg), parts(ch), strict=True))[:-1, :-1]
    k = int(gain.argmax())
    i, j = divmod(k, gain.shape[1])
    return float(gain[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + SHRINK)), i, j


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, bins: int = BINS, rounds: int = ROUNDS) -> tuple[float, np.ndarray, dict[tuple[int, int], np.ndarray]]:
    """(intercept, tables a feature, tables a pair) of rows of bins ``x``,
    labels ``y`` and weights ``w``."""
    rate = (w @ y + 0.5) / (w.sum() + 1)
    start = float(np.log(rate / (1 - rate)))
    main = np.zeros((x.shape[1], bins))
    pairs: dict[tuple[int, int], np.ndarray] = {}
    if not len(y) or y.min() == y.max():
        return start, main, pairs
    z = np.full(len(y), start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return w * (y - p), w * p * (1 - p)
    for _ in range(rounds):
        for f in range(x.shape[1]):
            g, h = slopes()
            step = RATE * _leaves(np.bincount(x[:, f], weights=g, minlength=bins), np.bincount(x[:, f], weights=h, minlength=bins))
            main[f] += step
            z += step[x[:, f]]
    g, h = slopes()
    square = lambda at, v: np.bincount(at, weights=v, minlength=bins * bins).reshape(bins, bins)
    cells = lambda a, b: x[:, a].astype(np.int64) * bins + x[:, b]
    gains = {(a, b): _quadrants(square(cells(a, b), g), square(cells(a, b), h))[0] for a, b in combinations(range(x.shape[1]), 2)}
    for pair in sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]:
        pairs[pair] = np.zeros((bins, bins))
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in pairs.items():
            at = cells(a, b)
            g, h = slopes()
            sg, sh = square(at, g), square(at, h)
            _, i, j = _quadrants(sg, sh)
            step = np.zeros((bins, bins))
            for r in (slice(0, i + 1), slice(i + 1, bins)):
                for c in (slice(0, j + 1), slice(j + 1, bins)):
                    step[r, c] = RATE * sg[r, c].sum() / (sh[r, c].sum() + SHRINK)
            table += step
            z += step.ravel()[at]
    return start, main, pairs


def _bag(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["bins", "label"], kind="stable")
    x = np.array([np.frombuffer(b, np.uint8) for b in rows["bins"]])
    start, main, pairs = boost(x, rows["label"].to_numpy(float), rows["n"].to_numpy(float))
    out = [(-1, -1, np.array([start])), *((f, -1, t) for f, t in enumerate(main)), *((a, b, t.ravel()) for (a, b), t in pairs.items())]
    return pd.DataFrame([(a, b, t.astype(float).tobytes()) for a, b, t in out], columns=["a", "b", "cells"])


class Model:
    """Cut points and lookup tables."""

    def __init__(self, cuts: list[np.ndarray], start: float, tables: dict[tuple[int, int], np.ndarray]):
        self.cuts, self.start, self.tables = cuts, start, tables

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, f], "right") for f, c in enumerate(self.cuts)]).astype(np.uint8)

    def score(self, x: np.ndarray) -> np.ndarray:
        k = self.bins(x).astype(np.int64)
        z = np.full(len(x), self.start)
        for (a, b), t in self.tables.items():
            z += t[k[:, a]] if b < 0 else t[k[:, a] * BINS + k[:, b]]
        return 1 / (1 + np.exp(-z))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))


def fit(learn: DataFrame, name: str = "figures") -> Model:
    """Learn from rows with the array ``name`` and a ``label`` (0 / 1)."""
    learn = learn.where("label in (0, 1)").select(F.col("label").cast("int").alias("label"), F.col(name).alias("x"))
    at = [k / BINS for k in range(1, BINS)]
    got = learn.agg(*[F.percentile_approx(F.col("x")[f], at, 2000).alias(f"q{f}") for f in range(len(FEATURES))]).first()
    model = Model([np.unique(np.array(got[f] or [], np.float32)) for f in range(len(FEATURES))], 0.0, {})

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = model.bins(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in k], pa.binary())], names=["label", "bins"])
    rows = learn.mapInArrow(binned, "label int, bins binary").groupBy("label", "bins").agg(F.count(F.lit(1)).alias("n"))
    different = rows.count()
    if not different:
        return model
    share = int(1e6 * min(0.8, ROWS / different))
    bagged = rows.withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(BAGS - 1)))).where(F.pmod(F.xxhash64("bins", "label", "bag"), F.lit(1_000_000)) < share)
    for r in bagged.groupBy("bag").applyInPandas(_bag, "a int, b int, cells binary").collect():
        t = np.frombuffer(r["cells"], float) / BAGS
        if r["a"] < 0:
            model.start += float(t[0])
        else:
            model.tables[r["a"], r["b"]] = model.tables.get((r["a"], r["b"]), 0) + t
    return model


def score_quality(rows: DataFrame, model: Model, threshold: float = 0.5, name: str = "figures") -> DataFrame:
    """``rows`` with the array ``name`` replaced by ``score`` (0 to 1) and ``predicted``."""
    rows = without(rows, "score", "predicted")
    carried = [c for c in rows.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, x = batch.columns
            yield pa.RecordBatch.from_arrays([*rest, pa.array(model.score(_matrix(x)))], names=[*batch.schema.names[:-1], "score"])
    plain = rows.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.col(f"`{name}`").alias("x"))
    fields = ", ".join([*(f"c{i} {rows.schema[c].dataType.simpleString()}" for i, c in enumerate(carried)), "score double"])
    out = plain.mapInArrow(run, fields)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))

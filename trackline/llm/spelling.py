"""Spelling variants: words that differ by one letter, found in FM-indexes.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` (A-Z lower-cased), the
vocabulary those of at least ``min_letters`` letters and ``min_count``
occurrences.  Two words are near if one inserted, deleted or replaced letter
makes one the other.

The search scheme has two searches, one for each half of a word.  A single
error leaves the first half as the other word's beginning, or the second half
as its end.  The first search matches the first half exactly from the
delimiter on and extends to the right over the second half with one error; the
second matches the second half exactly from the delimiter at the end and
extends to the left over the first.  Each state is an interval of suffix ranks
over the delimited vocabulary, an edit and the place in the pattern; an
interval whose word begins (or ends) where the pattern is used up is a match.
The two directions of the index are the suffix ranks of the words (read to the
left) and of the reversed words (read to the right).

Neither direction is one index: the words are cut into ranges (of about
``SHARD`` words) in the order of their letters, and of their reversed letters.
All words that begin with a half lie side by side in the first order, all that
end with one in the second, so a word is searched in the few ranges that its
half touches (mostly one).  Ranges are built and searched as Spark groups; the
driver sees the two ends of each range.

A word's *form* is its near word of largest count (ties: smallest in code-point
order), if that is at least ``ratio`` times its own; its *root* is the last of
the forms that follow one another.

Defined cases: null, empty and wordless texts give no words; repeated rows
count each time; a null id reads as one empty text in ``planted``; without
words the result is empty.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.llm.common import cut, flatten

SHARD = 8_000
QUERIES = 4_096
FLUSH = 200_000
RUN = re.compile("[a-zÀ-ÿ]+")
_U = np.uint64


def _words(planted: int, min_letters: int):
    """Arrow map (id, text): words and their counts, of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # bytes.lower() changes A-Z alone
                runs = Counter(RUN.findall(text.as_py().lower().decode("utf-8", "replace")))
                head = zlib.crc32(f"{doc}:".encode())
                for word, n in runs.items():
                    if len(word) < min_letters:
                        continue
                    if planted:
                        h = zlib.crc32(word.encode(), head)
                        if h % planted == 0:
                            word = word[:h % len(word)] + word[h % len(word) + 1:]
                            if len(word) < min_letters:
                                continue
                    total[word] += n
                if len(total) > FLUSH:
                    yield _counted(total)
                    total.clear()
        yield _counted(total)
    return run


def _counted(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: int = 0, min_letters: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of all ``docs``.  With ``planted`` = k, a run whose crc32 h (of
    ``<id>:<run>``) k divides loses its letter h % length first."""
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("t"))
    return (rows.mapInArrow(_words(planted, min_letters), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


class Index:
    """Suffix ranks of a delimited vocabulary, read backwards: rank intervals
    grow to the left by one letter at a time."""

    def __init__(self, words: list[str]):
        text = np.frombuffer(("\n".join(words) + "\n").encode("utf-32-le"), np.uint32)
        ends = text == 10
        self.words = len(words)
        self.letters = np.unique(text[~ends])
        code = np.where(ends, 0, np.searchsorted(self.letters, text) + 1)
        n = len(code)
        # prefix doubling; the delimiters are ordered by their words, so all suffixes differ
        rank = code + self.words
        rank[ends] = np.arange(self.words)
        width = 1
        while True:
            second = np.full(n, -1, np.int64)
            second[:n - width] = rank[width:]
            order = np.lexsort((second, rank))
            new = np.append(True, (np.diff(rank[order]) != 0) | (np.diff(second[order]) != 0))
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            if new.all():
                break
            width *= 2
        before = code[order - 1]
        size = len(self.letters) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(code, minlength=size))))
        blocks = n // 64 + 1
        self.bits = np.zeros((size, blocks), np.uint64)
        self.base = np.zeros((size, blocks), np.int64)
        for c in range(size):
            held = np.zeros(blocks * 64, bool)
            held[:n] = before == c
            self.bits[c] = np.packbits(held, bitorder="little").view(np.uint64)
            self.base[c, 1:] = np.cumsum(np.bitwise_count(self.bits[c]))[:-1]
        # words by the rank of their whole suffix
        word_at = np.cumsum(ends) - ends
        self.word_of = word_at[order[before == 0]]

    def before(self, c: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """How many of the first ``rank`` suffixes follow letter ``c``."""
        block = rank >> 6
        mask = (_U(1) << (rank & 63).astype(np.uint64)) - _U(1)
        return self.base[c, block] + np.bitwise_count(self.bits[c, block] & mask)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of ``words`` one after the other (-1: in no word here), and bounds."""
        text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.letters, text), len(self.letters) - 1)
        return np.where(self.letters[at] == text, at + 1, -1), np.concatenate(([0], np.cumsum([len(w) for w in words])))

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first[c] + self.before(c, lo), self.first[c] + self.before(c, hi)

    def near(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``words``, number of an indexed word) at distance one
        whose last ``exact`` letters of the first are letters of both."""
        text, bounds = self.codes(words)
        found_q, found_w = [], []
        for i in range(0, len(words), QUERIES):
            q = np.arange(i, min(i + QUERIES, len(words)))
            left = bounds[q + 1] - bounds[q]
            q, left, lo, hi = self._exactly(text, bounds, q, left, np.zeros(len(q), np.int64), np.full(len(q), self.words), left - exact[q])
            erred = []
            while len(q):
                c, at = np.divmod(np.arange(len(self.letters) * len(q)), len(q))
                l, h = self.step(c + 1, lo[at], hi[at])
                some = np.flatnonzero(h > l)
                c, at, l, h = c[some] + 1, at[some], l[some], h[some]
                more = left[at] > 0
                wanted = np.where(more, text[np.maximum(bounds[q[at]] + left[at] - 1, 0)], -2)
                erred.append((q[at], left[at], l, h))                                    # a letter more
                other = more & (c != wanted)
                erred.append((q[at[other]], left[at[other]] - 1, l[other], h[other]))    # another letter
                rest = left > 0
                erred.append((q[rest], left[rest] - 1, lo[rest], hi[rest]))              # a letter less
                same = more & (c == wanted)
                q, left, lo, hi = q[at[same]], left[at[same]] - 1, l[same], h[same]
            if erred:
                q, left, lo, hi = (np.concatenate(x) for x in zip(*erred, strict=True))
                q, left, lo, hi = self._exactly(text, bounds, q, left, lo, hi, np.zeros(len(q), np.int64))
                # the word must begin here
                zero = np.zeros(len(q), np.int64)
                l, h = self.before(zero, lo), self.before(zero, hi)
                one = h > l
                pairs = np.unique(np.column_stack([q[one], self.word_of[l[one]]]), axis=0)
                found_q.append(pairs[:, 0])
                found_w.append(pairs[:, 1])
        none = np.zeros(0, np.int64)
        return np.concatenate(found_q or [none]), np.concatenate(found_w or [none])

    def _exactly(self, text, bounds, q, left, lo, hi, until):
        """States extended letter by letter until ``until`` letters are left; the empty ones drop out."""
        done = []
        while len(q):
            ready = left <= until
            done.append([x[ready] for x in (q, left, lo, hi)])
            q, left, lo, hi, until = (x[~ready] for x in (q, left, lo, hi, until))
            c = text[bounds[q] + left - 1]
            l, h = self.step(np.maximum(c, 0), lo, hi)
            some = (c > 0) & (h > l)
            q, left, lo, hi, until = q[some], left[some] - 1, l[some], h[some], until[some]
        return [np.concatenate(x) for x in zip(*done, strict=True)] if done else (q, left, lo, hi)


def _routes(ends: list[tuple[int, str, str]], side: int):
    """Arrow map (key, n, shard): a row for every shard whose range holds words
    that begin with the key's half."""
    shards, firsts, lasts = [e[0] for e in ends], [e[1] for e in ends], [e[2] for e in ends]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, n, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                half = key[:_half(len(key), side)]
                lo = bisect.bisect_left(lasts, half)
                hi = bisect.bisect_right(firsts, half + "\U0010ffff")
                out += [(side, s, key, n, s == own) for s in shards[lo:hi]]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(
                zip(*out, strict=True) if out else [[]] * 5, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.bool_()), strict=True)],
                names=["side", "shard", "key", "n", "held"])
    return run


def _half(length: int, side: int) -> int:
    """Letters of the exact half: the first of a word (side 0), or the last."""
    return length // 2 if side == 0 else length - length // 2


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """One range of the vocabulary: its index, and all near pairs of the words sent there."""
    side = int(rows["side"].iloc[0])
    held = rows[rows["held"]]
    counts = held["n"].to_numpy()
    # side 0: keys are words, an index of the reversed ones reads them to the
    # right; side 1: keys are reversed words, an index of the words reads to the left
    turned = lambda words: [w[::-1] for w in words]
    indexed, asked = turned(held["key"]), turned(rows["key"])
    exact = np.array([_half(len(w), side) for w in asked])
    q, w = Index(indexed).near(asked, exact)
    plain = turned if side == 0 else list
    words, near = np.array(plain(asked), object), np.array(plain(indexed), object)
    return pd.DataFrame({"word": words[q], "near": near[w], "near_n": counts[w]})


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """(word, near, near_n) for all near pairs of ``words`` (word, n), both
    ways; a pair may come twice."""
    spark = words.sparkSession
    parts = max(1, -(-words.count() // shard))
    sent = None
    for side, key in enumerate((F.col("word"), F.reverse("word"))):
        ranged = words.select(key.alias("key"), "n").repartitionByRange(parts, "key").withColumn("shard", F.spark_partition_id())
        ranged = cut(ranged, "ranges")
        ends = [tuple(r) for r in ranged.groupBy("shard").agg(F.min("key"), F.max("key")).collect()]
        routed = ranged.mapInArrow(_routes(sorted(ends, key=lambda e: e[1]), side), "side int, shard int, key string, n long, held boolean")
        sent = routed if sent is None else sent.unionByName(routed)
    found = sent.repartition(2 * parts, "side", "shard") if 2 * parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else sent
    return found.groupBy("side", "shard").applyInPandas(_search, "word string, near string, near_n long")


def spelling_forms(words: DataFrame, ratio: int = 5, shard: int = SHARD) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of ``words`` (word, n)."""
    words = cut(words, "words")
    # a word has at most some 120 near words a letter, whatever the corpus
    near = near_words(words, shard).groupBy("word").agg(F.collect_set(F.struct((-F.col("near_n")).alias("n"), "near")).alias("near"))
    best = F.array_min("near")
    near = near.select("word", F.size("near").cast("long").alias("n_near"), best["near"].alias("form"), (-best["n"]).alias("form_n"))
    out = words.join(near, "word", "left").withColumn("_is", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
    out = cut(out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), *[F.when(F.col("_is"), F.col(c)).alias(c) for c in ("form", "form_n")]), "forms")
    # forms rise in count by the ratio, so chains are short and have no loops
    tree = out.where("form is not null").select(F.col("word").alias("node"), F.col("form").alias("root"))
    weight = tree.agg(F.sum(F.octet_length("node") + F.octet_length("root") + 32)).first()[0] or 0
    roots = flatten(tree, weight // 16).select(F.col("node").alias("word"), "root")
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))

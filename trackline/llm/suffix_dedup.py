"""Exact removal of byte passages that also start earlier in the corpus.

A byte is removed when a string of ``length`` bytes that covers it also
starts earlier: in a document with a smaller id, or earlier in the same
document.  Strings are judged on the input and never cross documents.

The suffix array is sparse but complete.  Of all suffixes only those are
kept that start at an anchor: every ``length``-byte window elects the
leftmost smallest 16-byte gram (by hash) inside it, so equal windows elect
the same offset, and two equal windows always meet at two equal anchors.
About one position in 43 is an anchor.

1. Splitters are taken from a bounded sample of documents and cut the
   suffixes into ranges of their leading 16 bytes (two 8-byte tokens).  A
   prefix that the sample shows more than once as a splitter owns several
   buckets; its suffixes are dealt over them by position.
2. Each bucket sorts its suffixes by multikey quicksort (a token at a time,
   only ties go on), drops those whose leading token is alone, and groups
   the rest by a fingerprint of the whole span that the anchor's windows
   cover.  All but the earliest of equal spans are repeats as a whole.  An
   earliest one remains open when it may share some window with another
   span: the windows of an anchor fall into four pieces by their offset, the
   windows of a piece have a core of bytes in common, and a shared window
   means a shared core (16-bit fingerprints: a false match only costs work).
   It also remains open when its prefix is dealt over several buckets.
3. Open spans are compared across spans and bucket boundaries window by
   window: fingerprints of the window and of its piece's core (64 bits each),
   reduced to the earliest in each batch before the shuffle, dealt by the
   core's, which neighbours share, and reduced again there to merged runs.

Every window is decided by step 2 or 3, so the result is exact up to
fingerprint collisions; no window is sampled away (splitters only steer the
partitioning).

Defined cases: a null text is empty; texts shorter than ``length`` keep all
bytes; a null id sorts after all others; rows with the same id and start
are ties, neither of them earlier; repeated rows get the same result; an
empty table gives an empty result; other columns pass through, but for those
that bear a result's name, which the result replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.llm import arrays as A
from trackline.llm.common import checked_broadcast, cut, free_name, without

GRAM = 16
SAMPLE_DOCS = 2000
# open spans are broadcast as one array of longs a document up to this size
# (8 bytes a span, 64 a document), else the join with the texts is shuffled
SPAN_BYTES = 64 << 20
_U = np.uint64
# windows that a task reduces at once (some 200 bytes each meanwhile)
WINDOWS = 1 << 18
# pieces of an anchor's window offsets, each with a 16-bit core fingerprint
PIECES = 4
_SPAN, _W1, _W2 = A.Rolling(11), A.Rolling(23), A.Rolling(37)
_LAST_ID = 2 ** 63 - 1
# loc packs a start (32 bits), a text tag (24 bits) and the number of further
# window starts in the span (7 bits)
_TAG = 24


def _elect(b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """8-byte tokens of every position, and the anchor of the window at every start."""
    n, width = len(b), length - GRAM + 1
    w = b.astype(np.uint64)
    t = (w[:-1] << _U(8)) | w[1:]
    t = (t[:-2] << _U(16)) | t[2:]
    t = (t[:-4] << _U(32)) | t[4:]
    g = A.mix(t[:-8] * A.K1 + (t[8:] ^ A.K2) * A.K3)
    bits = _U(max(20, n.bit_length()))
    low = (_U(1) << bits) - _U(1)
    g = (g & ~low) | np.arange(len(g), dtype=np.uint64)
    return t, (A.sliding_min(g, width) & low).astype(np.int64)


def _spans(b: np.ndarray, offs: np.ndarray, length: int):
    """Per anchor of one chunk: first window start, number of further starts,
    tokens, span fingerprint and packed core fingerprints (0: no window of
    that piece); ``offs`` are the row bounds within ``b``."""
    n, width = len(b), length - GRAM + 1
    if n < length:
        return None
    lens = np.diff(offs)
    full = lens >= length
    if not full.any():
        return None
    t, elected = _elect(b, length)
    step = np.zeros(len(elected) + 1, np.int32)
    np.add.at(step, offs[:-1][full], 1)
    np.add.at(step, offs[1:][full] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(step)[:-1])
    at = elected[starts]
    new = A.runs(at, starts - np.arange(len(starts)))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    lo, anchor = starts[first], at[first]
    s = _SPAN.prefix(b)
    fp = _SPAN.ranges(s, lo, lo + count - 1 + length)
    fp = A.mix(fp + (anchor - lo).astype(np.uint64) * A.K2)
    cores = np.zeros(len(lo), np.uint64)
    piece = -(-width // PIECES)
    for i in range(PIECES):
        near, far = i * piece, min((i + 1) * piece, width) - 1
        some = (anchor - lo >= near) & (anchor - lo - count + 1 <= far)
        x = anchor[some] - near
        h = _SPAN.ranges(s, x, x + near - far + length)
        cores[some] |= ((h >> _U(48)) | _U(1)) << _U(16 * i)
    return lo, count - 1, t[anchor], t[anchor + 8], fp, cores


def _suffixes(length: int, splitters: np.ndarray | None):
    """Arrow map: documents (id, tag, text) to suffix records with a bucket
    (doubled, plus one if the prefix is dealt over several)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, offsets = A.utf8(batch.column(2))
            for i, j in A.chunks(offsets):
                offs = offsets[i:j + 1] - offsets[i]
                found = _spans(data[offsets[i]:offsets[j]], offs, length)
                if found is None:
                    continue
                lo, more, t1, t2, fp, cores = found
                row = np.searchsorted(offs, lo, "right") - 1
                loc = ((lo - offs[row]) << 31) | (tags[i:j][row] << 7) | more
                doc = ids[i:j][row]
                if splitters is None:
                    bucket, cores = np.zeros(len(lo), np.int64), t2
                else:
                    bucket = _bucket(t1, t2, doc, loc, splitters)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (bucket, t1, cores, fp, doc, loc)],
                                                 names=["bucket", "t1", "cores", "fp", "doc", "loc"])
    return run


def _prefix(t1: np.ndarray, t2: np.ndarray) -> np.ndarray:
    both = np.empty((len(t1), 2), ">u8")
    both[:, 0], both[:, 1] = t1, t2
    return both.view("S16").ravel()


def _bucket(t1, t2, doc, loc, splitters: np.ndarray) -> np.ndarray:
    """Range of the prefix; a prefix that is several splitters is dealt over
    the ranges between them by position."""
    key = _prefix(t1, t2)
    hi = np.searchsorted(splitters, key, "right")
    lo = np.searchsorted(splitters, key, "left")
    share = np.maximum(hi - lo, 1)
    deal = A.mix(doc.view(np.uint64) * A.K1 + loc.view(np.uint64)) % share.astype(np.uint64)
    return 2 * (hi - deal.astype(np.int64)) + (share > 1)


def _sorted_buckets(length: int):
    """Arrow map over one partition of suffix records (whole buckets): rows
    (doc, tag, start, end, open)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
        if not parts:
            return
        bucket, t1, cores, fp, doc, loc = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order = A.multikey_sort([t1, bucket, fp, doc, loc], ties_only=2)
        # a dealt prefix may be alone in its bucket and still repeat elsewhere
        rest = np.setdiff1d(np.flatnonzero(bucket & 1), order, assume_unique=True)
        extra_doc, extra_loc = doc[rest], loc[rest]
        bucket, t1, cores, fp, doc, loc = (x[order] for x in (bucket, t1, cores, fp, doc, loc))
        group = A.runs(t1, bucket)
        new = group | A.runs(fp)
        at = np.flatnonzero(new)
        rep = at[np.cumsum(new) - 1] if len(new) else at
        later = (doc != doc[rep]) | ((loc >> 31) != (loc[rep] >> 31))
        is_open = new & (bucket & 1 > 0)
        gid = np.cumsum(group)[at] << 16
        for i in range(PIECES):
            core = (cores[at] >> (16 * i)) & 0xFFFF
            has = np.flatnonzero(core)
            key = gid[has] | core[has]
            by = np.argsort(key)
            first = A.runs(key[by])
            shared = ~(first & np.append(first[1:], True))
            is_open[at[has[by[shared]]]] = True
        # another text of the same id and start is no repeat of the earliest: it is judged like it
        is_open |= ~new & ~later & is_open[rep]
        take = (~new & later) | is_open
        yield _intervals(np.append(doc[take], extra_doc), np.append(loc[take], extra_loc),
                         np.append(is_open[take], np.ones(len(rest), bool)), length)
    return run


def _intervals(doc, loc, is_open, length) -> pa.RecordBatch:
    lo = loc >> 31
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array((loc >> 7) & (2 ** _TAG - 1)), pa.array(lo), pa.array(lo + (loc & 127) + length), pa.array(is_open)],
        names=["doc", "tag", "lo", "hi", "open"])


_RECORD = "bucket long, t1 long, cores long, fp long, doc long, loc long"
_INTERVAL = "doc long, tag long, lo long, hi long, open boolean"


def _windows(length: int):
    """Arrow map: documents with their open spans (packed lo << 32 | hi) to
    windows, one row per fingerprint and some WINDOWS of a batch (the
    earliest); the later ones among them come out as decided runs (f1 = null).

    f1 is the core fingerprint of the window's piece, f2 that of the window:
    equal windows have both equal, and neighbours share f1, by which they are
    dealt, so that a repeat comes out as runs and not window by window."""
    width = length - GRAM + 1
    piece = -(-width // PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, offsets = A.utf8(batch.column(2))
            spans = batch.column(3)
            so = np.asarray(spans.offsets)
            packed = np.asarray(spans.values)
            out, held = [], 0
            for i, j in A.chunks(offsets):
                base = offsets[i]
                b = data[base:offsets[j]]
                sel = packed[so[i]:so[j]]
                row = np.repeat(np.arange(i, j), np.diff(so[i:j + 1]))
                lo, hi = sel >> 32, sel & (2 ** 32 - 1)
                n = hi - lo - length + 1
                start = A.ranges(lo + offsets[row] - base, n)
                doc_row = np.repeat(row, n)
                if not len(start):
                    continue
                anchor = _elect(b, length)[1][start]
                near = (anchor - start) // piece * piece
                far = np.minimum(near + piece, width) - 1
                out.append((_W1.ranges(_W1.prefix(b), anchor - near, anchor - far + length), _W2.ranges(_W2.prefix(b), start, start + length),
                            ids[doc_row], ((start - offsets[doc_row] + base) << 31) | (tags[doc_row] << 7)))
                held += len(start)
                if held >= WINDOWS:
                    yield _reduced(out, length)
                    out, held = [], 0
            if out:
                yield _reduced(out, length)
    return run


def _reduced(out: list, length: int) -> pa.RecordBatch:
    f1, f2, doc, loc = (np.concatenate(x) for x in zip(*out, strict=True))
    keep, gone_doc, gone_lo, gone_hi, gone_tag = _later(f1, f2, doc, loc, length)
    k, m = len(keep), len(gone_doc)
    none = np.zeros(m, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.append(f1[keep].view(np.int64), none), mask=np.arange(k + m) >= k),
         pa.array(np.append(f2[keep].view(np.int64), gone_hi)),
         pa.array(np.append(doc[keep], gone_doc)),
         pa.array(np.append(loc[keep], (gone_lo << 31) | (gone_tag << 7)))], names=["f1", "f2", "doc", "loc"])


def _later(f1, f2, doc, loc, length):
    """Rows that are first of their fingerprint (by document and start), and
    the other rows merged into runs of covered bytes."""
    order = A.multikey_sort([f1, f2, doc, loc])
    new = A.runs(f1[order], f2[order])
    rep = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    pos = loc >> 31
    gone = (doc[order] != doc[rep]) | (pos[order] != pos[rep])
    g = order[gone]
    tag, start = (loc[g] >> 7) & (2 ** _TAG - 1), pos[g]
    by = np.lexsort((start, tag, doc[g]))
    d, tag, start = doc[g][by], tag[by], start[by]
    first = A.runs(d, tag)
    if len(start):
        first[1:] |= start[1:] > start[:-1] + length
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(start)) - 1
    return order[~gone], d[at], start[at], start[last] + length if len(at) else start[at], tag[at]


def _resolve(length: int):
    """Arrow map over one partition of window rows: covered runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            decided = np.asarray(b.column(0).is_null())
            f1, f2, doc, loc = (c.to_numpy(zero_copy_only=False) for c in (b.column(0).fill_null(0), *b.columns[1:]))
            if decided.any():
                d = decided
                yield _covered(doc[d], (loc[d] >> 7) & (2 ** _TAG - 1), loc[d] >> 31, f2[d])
            rows.append([x[~decided] for x in (f1, f2, doc, loc)])
        if rows:
            f1, f2, doc, loc = (np.concatenate(x) for x in zip(*rows, strict=True))
            _, d, lo, hi, tag = _later(f1, f2, doc, loc, length)
            yield _covered(d, tag, lo, hi)
    return run


def _covered(doc, tag, lo, hi) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, tag, lo, hi)] + [pa.array(np.zeros(len(doc), bool))],
                                      names=["doc", "tag", "lo", "hi", "open"])


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map: (..., text, spans) to (..., kept, n_removed, n_spans)."""
    for batch in batches:
        *rest, text, spans = batch.columns
        data, offsets = A.utf8(text)
        packed, so = np.asarray(spans.values), np.asarray(spans.offsets)
        kept, removed, n_spans = [], np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        for i in range(len(text)):
            whole = data[offsets[i]:offsets[i + 1]]
            if so[i + 1] > so[i]:
                p = np.sort(packed[so[i]:so[i + 1]])
                lo, hi = p >> 32, np.maximum.accumulate(p & (2 ** 32 - 1))
                first = np.append(True, lo[1:] > hi[:-1])
                lo, hi = lo[first], hi[np.append(np.flatnonzero(first)[1:] - 1, len(hi) - 1)]
                removed[i], n_spans[i] = (hi - lo).sum(), len(lo)
                a = np.append(0, hi)
                z = np.append(lo, len(whole))
                kept.append(b"".join(whole[x:y].tobytes() for x, y in zip(a, z, strict=True)))
            else:
                kept.append(whole.tobytes())
        yield pa.RecordBatch.from_arrays([*rest, pa.array(kept, pa.binary()), pa.array(removed), pa.array(n_spans)],
                                         names=[*batch.schema.names[:-2], "kept", "n_removed", "n_spans"])


def _splitters(base: DataFrame, length: int, parts: int) -> np.ndarray:
    """``parts`` - 1 prefixes at equal steps of the sorted suffixes of a
    sample of about SAMPLE_DOCS documents; repeated ones are kept."""
    n = base.count()
    if not n:
        return np.zeros(0, "S16")
    share = max(1, n // SAMPLE_DOCS)
    sample = base.where(F.pmod(F.xxhash64("doc", "tag"), F.lit(share)) == 0)
    rows = (sample.mapInArrow(_suffixes(length, None), _RECORD).where(F.pmod(F.xxhash64("doc", "loc"), F.lit(8)) == 0)
            .select("t1", "cores").toPandas())
    keys = np.sort(_prefix(rows["t1"].to_numpy(np.int64).view(np.uint64), rows["cores"].to_numpy(np.int64).view(np.uint64)))
    if not len(keys):
        return np.zeros(0, "S16")
    return keys[np.linspace(0, len(keys) - 1, parts + 1).astype(int)[1:-1]]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """All columns of ``docs`` plus ``kept`` (binary: the bytes that remain),
    ``n_removed`` and ``n_spans`` (maximal removed runs).  ``length`` is at
    least 32 and at most 142 bytes."""
    if not 32 <= length <= 142:
        raise ValueError("length must be from 32 to 142 bytes")
    docs = without(docs, "kept", "n_removed", "n_spans")
    spark = docs.sparkSession
    raw = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    did = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST_ID))
    tag = F.xxhash64(raw).bitwiseAND(F.lit(2 ** _TAG - 1))
    base = docs.select(did.alias("doc"), tag.alias("tag"), raw.alias("text"))
    parts = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    splitters = _splitters(base, length, 4 * parts)
    records = base.mapInArrow(_suffixes(length, splitters), _RECORD)
    found = cut(records.repartition(parts, "bucket").mapInArrow(_sorted_buckets(length), _INTERVAL), "suffixes")

    packed = (F.shiftleft("lo", 32) + F.col("hi")).alias("p")
    spans = found.where("open").select("doc", "tag", packed).groupBy("doc", "tag").agg(F.collect_list("p").alias("spans"))
    n, holders = found.where("open").agg(F.count(F.lit(1)), F.approx_count_distinct("doc")).first()
    spans = checked_broadcast(spans, 8 * n + 64 * holders, SPAN_BYTES)
    windows = (base.join(spans, ["doc", "tag"]).select("doc", "tag", "text", "spans")
               .mapInArrow(_windows(length), "f1 long, f2 long, doc long, loc long"))
    resolved = (windows.repartition(parts, F.coalesce("f1", "doc")).mapInArrow(_resolve(length), _INTERVAL))
    gone = (found.where("not open").unionByName(resolved).select("doc", "tag", packed)
            .groupBy("doc", "tag").agg(F.collect_list("p").alias("_spans")))

    names = {c: free_name(docs, f"_c{i}") for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(names[c]) for c in docs.columns],
                        did.alias("_did"), tag.alias("_tag"), raw.alias("_text"))
    joined = plain.join(gone.select(F.col("doc").alias("_did"), F.col("tag").alias("_tag"), "_spans"), ["_did", "_tag"], "left")
    carried = [c for c in docs.columns if c != text_col]
    ready = joined.select(*[names[c] for c in carried], "_text",
                          F.coalesce("_spans", F.array().cast("array<long>")).alias("_spans"))
    fields = ", ".join([*(f"`{names[c]}` {docs.schema[c].dataType.simpleString()}" for c in carried),
                        "kept binary", "n_removed long", "n_spans long"])
    done = ready.mapInArrow(_cutter, fields)
    return done.select(*[F.col(names[c]).alias(c) for c in carried], "kept", "n_removed", "n_spans")

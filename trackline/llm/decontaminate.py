"""Benchmark decontamination by templates.

A text becomes a sequence of words (runs of letters and digits, A-Z
lower-cased).  Typed placeholders replace numbers, units after a number, and
names (capitalised words inside a sentence), so a question that was given
new values keeps its template.  Windows of five words of every benchmark item,
with and without placeholders for names, are hash-joined with those of every
document, so an equal window in any case leads to the place.

There the item's own slots decide: its numbers, units and, wherever they stand
capitalised (also at a sentence's opening), its names.  Other words must be
equal but for case; a number stands for a number, a unit for a unit, a name
for itself in any case or for a capitalised word.  A document contains an item
when, along one alignment, at least ``percent`` percent of the item's windows
occur in it and the slots are consistent: every value of the item corresponds
to one value of the document and the other way round.  Equal values make the
copy ``verbatim``, others ``reparameterised``.

An item's first word is left out of its windows (inside a document it may
look like a name).  Items of two to five words hold no window and match by
their whole word sequence; an item of one word matches nothing, so a common
word does not condemn a document.

The items are joined in slices of some SLICE words, each
broadcast to a pass over all documents; results of the slices are united.

Defined cases: null and empty texts contain nothing; rows with null ids are
checked like others (a null item id is reported as null); repeated items are
reported once; an empty benchmark leaves every document clean; columns named
as a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.llm import arrays as A
from trackline.llm.common import without

WIDTH = 5
SLICE = 4_000_000
# alignments of one item in one text that are compared at once
SHIFTS = 4096
LITERAL, NUMBER, UNIT, NAME = range(4)
_U = np.uint64
_HASH = A.Rolling(67)
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 33, 46, 58, 63]] = True
# fixed values: words that name a unit when a number stands before them
UNITS = ("mm cm m km g kg mg l ml s ms h min inch inches foot feet yard yards mile miles ounce ounces pound pounds "
         "second seconds minute minutes hour hours day days week weeks month months year years metre metres meter meters "
         "gram grams litre litres liter liters dollar dollars euro euros cent cents percent degree degrees").split()
_NUMBER, _UNIT, _NAME = (_U(0x1001), _U(0x2002), _U(0x3003))


def _unit_hashes() -> np.ndarray:
    b = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    s, e, _ = A.word_bounds(b, np.array([0, len(b)]))
    return np.sort(_HASH.ranges(_HASH.prefix(b), s, e))


def template(b: np.ndarray, offs: np.ndarray):
    """Words of the texts that ``offs`` cut ``b`` into: template hash, hash
    with literal names, value hash, slot kind (LITERAL, NUMBER, UNIT, NAME),
    capital flag, row."""
    s, e, row = A.word_bounds(np.where(_IN_WORD[b], b, np.uint8(32)), offs)
    low = A.lower(b)
    value = _HASH.ranges(_HASH.prefix(low), s, e)
    kind = np.full(len(s), LITERAL)
    if not len(s):
        return value, value, value, kind, np.zeros(0, bool), row
    digits = np.concatenate(([0], np.cumsum((b >= 48) & (b <= 57))))
    number = digits[e] - digits[s] == e - s
    stops = np.concatenate(([0], np.cumsum(_STOP[b])))
    opens = np.ones(len(s), bool)
    opens[1:] = (row[1:] != row[:-1]) | (stops[s[1:]] > stops[e[:-1]])
    capital = (b[s] >= 65) & (b[s] <= 90)
    after = np.zeros(len(s), bool)
    after[1:] = number[:-1] & (row[1:] == row[:-1])
    units = _unit_hashes()
    unit = after & (units[np.minimum(np.searchsorted(units, value), len(units) - 1)] == value)
    kind[capital & ~opens], kind[unit], kind[number] = NAME, UNIT, NUMBER
    plain = value.copy()
    plain[kind == UNIT], plain[kind == NUMBER] = _UNIT, _NUMBER
    return np.where(kind == NAME, _NAME, plain), plain, value, kind, capital, row


def _windows(word: np.ndarray, row: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of all windows of ``width`` words of one row."""
    n = len(word) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.flatnonzero(row[:n] == row[width - 1:])
    acc = np.zeros(len(start), np.uint64)
    for k in range(width):
        acc = (acc + word[start + k]) * A.K1
    return start, A.mix(acc).view(np.int64)


def _both(word: np.ndarray, plain: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of windows with placeholders for names, and of those
    with literal names where they differ."""
    start, h = _windows(word, row)
    _, other = _windows(plain, row)
    more = h != other
    return np.append(start, start[more]), np.append(h, other[more])


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map (item, text): values and slot kinds of the item's words, and
    the places and hashes of its windows (of its whole sequence if short)."""
    for batch in batches:
        ids = batch.column(0)
        data, offsets = A.utf8(batch.column(1))
        out = []
        for i, j in A.chunks(offsets):
            *words, row = template(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            ends = np.searchsorted(row, np.arange(j - i + 1))
            for d in range(j - i):
                word, plain, value, kind, capital = (x[ends[d]:ends[d + 1]] for x in words)
                if len(value) <= WIDTH:
                    place, h = _windows(value, np.zeros(len(value)), max(1, len(value)))
                    kind, short = np.full(len(value), LITERAL), True
                else:
                    # a word that is a name at one place is one wherever it is capitalised
                    kind = np.where((kind == LITERAL) & capital & np.isin(value, value[kind == NAME]), NAME, kind)[1:]
                    word, plain, value = word[1:], plain[1:], value[1:]
                    place, h = _both(word, plain, np.zeros(len(value)))
                    short = False
                if len(value) > 1:
                    out.append((i + d, value.view(np.int64), kind, place, h, short))
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array([o[0] for o in out], pa.int64())), *(pa.array([o[k] for o in out], pa.list_(pa.int64())) for k in range(1, 5)),
             pa.array([o[5] for o in out], pa.bool_())],
            names=["item", "vals", "kinds", "places", "hashes", "short"])


class _Items:
    """The items of one slice: their words, and their windows sorted by hash;
    for each short length the sequences sorted by hash."""

    def __init__(self, rows):
        self.ids = [None if x != x or x is None else int(x) for x in rows["item"].astype(object)]
        self.values = [np.asarray(v, np.int64) for v in rows["vals"]]
        self.kinds = [np.asarray(v, np.int64) for v in rows["kinds"]]
        sizes: dict[int, list[int]] = {}
        for c, (v, short) in enumerate(zip(self.values, rows["short"], strict=True)):
            sizes.setdefault(len(v) if short else 0, []).append(c)
        self.tables = {}
        for size, codes in sizes.items():
            places = [np.asarray(rows["places"].iloc[c], np.int64) for c in codes]
            h = np.concatenate([np.asarray(rows["hashes"].iloc[c], np.int64) for c in codes])
            by = np.argsort(h, kind="stable")
            self.tables[size] = (h[by], np.repeat(codes, [len(x) for x in places])[by], np.concatenate(places)[by])

    def hits(self, size: int, start: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word position, item, place in the item) of equal hashes."""
        hashes, codes, places = self.tables[size]
        lo = np.searchsorted(hashes, h, "left")
        n = np.searchsorted(hashes, h, "right") - lo
        some = np.flatnonzero(n)
        hit = A.ranges(lo[some], n[some])
        return np.repeat(start[some], n[some]), codes[hit], places[hit]


def _find(items: _Items, percent: int, names: list[str]):
    """Arrow map (..., text): the items found and how, appended."""
    def met(code, shifts, doc, a, z):
        """(place, word position) of the item's windows that the words a to z
        hold, for each of the ``shifts`` of the item in them."""
        mine, kinds = items.values[code], items.kinds[code]
        value, kind, capital = doc
        out = []
        for k in range(0, len(shifts), SHIFTS):
            at = shifts[k:k + SHIFTS, None] + np.arange(len(mine))
            inside = (at >= a) & (at < z)
            at = np.clip(at, a, z - 1)
            same = value[at] == mine
            typed = np.isin(kinds, (NUMBER, UNIT)) & (kind[at] == kinds)
            name = (kinds == NAME) & capital[at]
            ok = inside & (same & ~np.isin(kinds, (NUMBER, UNIT)) | typed | name)
            total = np.concatenate((np.zeros((len(ok), 1), np.int64), np.cumsum(ok, axis=1)), axis=1)
            i, place = np.nonzero(total[:, WIDTH:] - total[:, :-WIDTH] == WIDTH)
            out.append((place, at[i, place]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def judge(code, shifts, doc, a, z):
        """None, or whether the values are alike: the item is met along one
        alignment with consistent slots."""
        total = len(items.values[code]) - WIDTH + 1
        need = -(-percent * total // 100)
        place, pos = met(code, shifts, doc, a, z)
        if len(place) < need:
            return None
        sh = pos - place
        by = np.lexsort((place, sh))
        place, pos, sh = place[by], pos[by], sh[by]
        # windows along one alignment, inserted or lost words allowed for: a band of shifts
        hi = np.searchsorted(sh, sh + max(1, total // 10), "right")
        for lo in np.flatnonzero((hi - np.arange(len(sh)) >= need) & A.runs(sh)):
            band = slice(lo, hi[lo])
            at, first = np.unique(place[band], return_index=True)
            if len(first) < need:
                continue
            words = at[:, None] + np.arange(WIDTH)
            slots = items.kinds[code][words] != LITERAL
            x, y = items.values[code][words][slots], doc[0][pos[band][first][:, None] + np.arange(WIDTH)][slots]
            pairs = np.unique(np.stack([x, y]), axis=1) if len(x) else np.zeros((2, 0))
            if len(np.unique(pairs[0])) == len(np.unique(pairs[1])) == pairs.shape[1]:
                return bool((x == y).all())
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, text = batch.columns
            data, offsets = A.utf8(text)
            out, alike = [set() for _ in range(batch.num_rows)], [True] * batch.num_rows
            for i, j in A.chunks(offsets):
                word, plain, value, kind, capital, row = template(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                doc = value.view(np.int64), kind, capital
                for size in items.tables:
                    if size:
                        pos, code, _ = items.hits(size, *_windows(value, row, size))
                        for d, c in zip(row[pos], code, strict=True):
                            out[i + d].add(items.ids[c])
                        continue
                    pos, code, place = items.hits(0, *_both(word, plain, row))
                    shift = pos - place
                    owner = row[pos]
                    by = np.lexsort((shift, code, owner))
                    shift, code, owner = shift[by], code[by], owner[by]
                    keep = A.runs(owner, code, shift)
                    shift, code, owner = shift[keep], code[keep], owner[keep]
                    cuts = np.append(np.flatnonzero(A.runs(owner, code)), len(owner))
                    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                        d = int(owner[a])
                        got = judge(int(code[a]), shift[a:z], doc, *np.searchsorted(row, [d, d + 1]))
                        if got is not None:
                            out[i + d].add(items.ids[code[a]])
                            alike[i + d] &= got
            kinds = [("verbatim" if same else "reparameterised") if found else None for found, same in zip(out, alike, strict=True)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([list(x) for x in out], pa.list_(pa.int64())), pa.array(kinds, pa.string())], names=names)
    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text: str = "text", percent: int = 80) -> DataFrame:
    """All columns of ``docs`` plus ``item_ids`` (sorted ids of the items that
    the text contains), ``kind`` and ``contaminated``."""
    docs = without(docs, "item_ids", "kind", "contaminated")
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"),
                             F.coalesce(F.col(f"`{item_text}`"), F.lit("")).cast("binary").alias("text")).distinct()
    words = items.mapInArrow(_item_words, "item long, vals array<long>, kinds array<long>, places array<long>, hashes array<long>, short boolean")
    slices = max(1, -(-(words.agg(F.sum(F.size("vals"))).first()[0] or 0) // SLICE))
    plain = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in plain.items()])
    fields = ", ".join([*(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in plain.items())])
    for k in range(slices):
        w = words.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == k).toPandas()
        if k:
            fields += f", items{k} array<long>, kind{k} string"
        else:
            fields += ", items0 array<long>, kind0 string"
        names = [f.split(" ")[0] for f in fields.split(", ")]
        inner = (inner.select("*", F.coalesce(F.col(plain[text_col]), F.lit("")).cast("binary").alias("t"))
                 .mapInArrow(_find(_Items(w), percent, names), fields))
    found = F.sort_array(F.array_distinct(F.concat(*[F.col(f"items{k}") for k in range(slices)])))
    kind = F.array_max(F.array_compact(F.array(*[F.when(F.col(f"kind{k}") == "verbatim", "0").when(F.col(f"kind{k}").isNotNull(), "1")
                                                 for k in range(slices)])))
    return inner.select(*[F.col(n).alias(c) for c, n in plain.items()], found.alias("item_ids"),
                        F.when(kind == "0", "verbatim").when(kind == "1", "reparameterised").alias("kind"),
                        (F.size(found) > 0).alias("contaminated"))

"""Near-duplicate documents: MinHash signatures joined by a multi-index on
their chunks, links confirmed on whole shingle sets.

A text is lower-cased (A-Z) and cut into words at white space; its set holds
the hashes (64 bits) of its distinct word shingles, or of the whole sequence
when it has fewer words.  Two documents are linked when their sets have a
Jaccard similarity of at least ``percent`` / 100.

* Signature: 40 MinHash symbols of 16 bits in ten chunks of four.  By the
  pigeonhole principle two signatures with a Hamming distance of at most 19
  have a chunk with at most one differing symbol; the allowed chunk errors
  are enumerated by leaving out each symbol in turn, so such a pair shares
  at least one of the 40 (chunk, left-out symbol) keys.  A pair at
  similarity 0.8 misses all keys with a probability of 4e-8.
* Equal sets are one class; only its smallest id goes on.
* Stars: within a key only the pairs with the smallest id are formed
  (linear in the key's rows); those that whole sets confirm hook each
  document to its nearest such id.  These hooks form trees, which pointer
  jumping flattens, so a hot group of copies merges without its pairs ever
  being listed.
* What the stars leave in different trees but under one key is then compared
  completely, so no candidate pair that could still join two trees is left
  out.  Only shingles that several trees have can be common to two of them;
  texts with too few of those are out of reach, and for the others a key's
  rows are cut into blocks, each pair of blocks is a group of its own, and
  a group counts all common shingles by one product of its incidence matrix.

Defined cases: null and empty texts have an empty set (n_shingles 0) and
link with nothing; rows with a null id are kept and have no component; rows
that share an id are one node; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.llm import arrays as A
from trackline.llm.common import checked_broadcast, components, cut, flatten

CHUNKS, PER = 10, 4
SYMBOLS = CHUNKS * PER
# a pair at similarity 0.8 has a larger distance with a probability of 1e-6
MAX_DISTANCE = 21
SALT_ROWS = 512
# a signature is 88 bytes: at most so many are broadcast (9 MB)
SIGNATURE_ROWS = 100_000
# rows of a block in the complete comparison, and columns of a matrix product
BLOCK, COLUMNS = 1024, 2048
_U = np.uint64
_WORDS = A.Rolling(51)
_SEEDS = np.random.default_rng(77).integers(0, 2 ** 63, (2, SYMBOLS), dtype=np.uint64)
_LANES = 0x0001000100010001
_S = [f"s{i}" for i in range(CHUNKS)]


def shingle_sets(b: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the rows that ``offs`` cut ``b`` into, as
    (hashes sorted within their row, first index of each row plus the total)."""
    rows = len(offs) - 1
    b = A.lower(b)
    s, e, row = A.word_bounds(b, offs)
    wh = _WORDS.ranges(_WORDS.prefix(b), s, e)
    per = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(per)[:-1]))
    n = np.where(per >= words, per - words + 1, np.minimum(per, 1))
    at = A.ranges(first, np.where(per >= words, n, 0))
    acc = np.zeros(len(at), np.uint64)
    for k in range(words):
        acc = acc * A.K1 + wh[at + k]
    h, owner = A.mix(acc), row[at]
    short = np.flatnonzero((per > 0) & (per < words))
    if len(short):
        acc = per[short].astype(np.uint64)
        for k in range(words - 1):
            has = per[short] > k
            acc[has] = acc[has] * A.K2 + wh[first[short[has]] + k]
        h, owner = np.append(h, A.mix(acc)), np.append(owner, short)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = A.runs(owner, h)
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(rows + 1))


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = A.utf8(batch.column(1))
            n, f1, f2 = (np.zeros(batch.num_rows, t) for t in (np.int64, np.uint64, np.uint64))
            sig = np.zeros((CHUNKS, batch.num_rows), np.uint64)
            for i, j in A.chunks(offsets):
                h, at = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
                n[i:j] = np.diff(at)
                some = np.flatnonzero(n[i:j])
                if not len(some):
                    continue
                lo = at[:-1][some]
                f1[i + some] = A.mix(np.add.reduceat(h * A.K2, lo) + n[i + some].astype(np.uint64))
                f2[i + some] = np.add.reduceat(A.mix(h ^ A.K3), lo)
                for k in range(SYMBOLS):
                    low = np.minimum.reduceat((h ^ _SEEDS[0, k]) * (_SEEDS[1, k] | _U(1)), lo)
                    sig[k // PER, i + some] |= (A.mix(low) & _U(0xFFFF)) << _U(16 * (k % PER))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), *(pa.array(x.view(np.int64)) for x in (f1, f2, *sig))],
                names=["doc", "n", "f1", "f2", *_S])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = A.utf8(batch.column(1))
            out = []
            for i, j in A.chunks(offsets):
                h, at = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
                out += [h[at[k]:at[k + 1]].tobytes() for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc", "items"])
    return run


def _confirm(percent: int):
    """Arrow map over rows sorted by (a, salt, member, b): the sets of ``a``
    first, then each member ``b`` to compare with them.  Pairs of at least
    ``percent``, once each, with their smallest Jaccard distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own, last = None, [], None
        for batch in batches:
            a, salt, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            items = batch.column(4)
            done = []
            for i in range(batch.num_rows):
                s = np.frombuffer(items[i].as_buffer(), np.uint64)
                if here != (a[i], salt[i]):
                    here, own = (a[i], salt[i]), []
                if b[i] == a[i]:
                    own.append(s)
                    continue
                for o in own:
                    both = np.sort(np.concatenate((o, s)), kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    union = len(o) + len(s) - common
                    if 100 * common < percent * union:
                        continue
                    # an id with several texts gives neighbouring rows
                    pair = (a[i], b[i], 1 - common / union)
                    if last is not None and last[:2] == pair[:2]:
                        last = min(last, pair)
                    else:
                        done += [last] if last is not None else []
                        last = pair
            yield _links_batch(done)
        yield _links_batch([last] if last is not None else [])
    return run


def _links_batch(links: list[tuple[int, int, float]]) -> pa.RecordBatch:
    a, b, distance = zip(*links) if links else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(distance, pa.float64())],
                                      names=["a", "b", "distance"])


def _lanes(chunk: str) -> Column:
    """A bit for each of a chunk's symbols in which x and y differ."""
    d = F.col(f"x.{chunk}").bitwiseXOR(F.col(f"y.{chunk}"))
    for shift in (8, 4, 2, 1):
        d = d.bitwiseOR(F.shiftrightunsigned(d, shift))
    return d.bitwiseAND(F.lit(_LANES))


def _agreement() -> Column:
    """Number of equal symbols of the signatures x and y."""
    total = F.lit(SYMBOLS)
    for c in _S:
        total = total - F.bit_count(_lanes(c))
    return total


def _scored(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The distinct (a, b) of ``pairs`` whose signatures are at most
    MAX_DISTANCE apart."""
    p = pairs.join(sigs.alias("x"), F.col("a") == F.col("x.doc")).join(sigs.alias("y"), F.col("b") == F.col("y.doc"))
    return p.where(_agreement() >= SYMBOLS - MAX_DISTANCE).select("a", "b").distinct()


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of the stored ``pairs`` whose whole sets are at least ``percent``
    similar, with their Jaccard ``distance``.  Members of a frequent ``a`` are dealt over salts, each with a copy of its set."""
    load = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("salts"))
    n = pairs.count()
    dealt = pairs.join(load, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"), F.col("b").alias("doc"))
    centres = load.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.col("a").alias("doc"))
    wanted = checked_broadcast(cut(dealt.unionByName(centres), "wanted"), 2 * n)
    rows = (sets.join(wanted, "doc")
            .select("a", "salt", F.col("doc").alias("b"), (F.col("a") != F.col("doc")).alias("member"), "items"))
    return (rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "member", "b")
            .mapInArrow(_confirm(percent), "a long, b long, distance double"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` (its id as long), ``n_shingles``,
    ``component_id`` (smallest id reachable by links) and ``kept`` (it is its
    component's smallest id, or has none)."""
    raw = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), raw.alias("text"))
    fields = ", ".join(["doc long", "n long", *(f"{c} long" for c in ("f1", "f2", *_S))])
    sigs = cut(base.mapInArrow(_signatures(words), fields), "signatures")

    real = sigs.where("doc is not null and n > 0")
    classes = cut(real.groupBy("f1", "f2").agg(F.min("doc").alias("doc"), F.max("doc").alias("z"),
                                               *[F.first(c).alias(c) for c in ("n", *_S)]), "classes")
    several = classes.where("doc <> z").select("f1", "f2", F.col("doc").alias("a"))
    copies = real.select("f1", "f2", F.col("doc").alias("b")).join(several, ["f1", "f2"]).where("a <> b").select("b", "a").distinct()

    keys = []
    for i, c in enumerate(_S):
        for k in range(PER):
            mask = ~(0xFFFF << 16 * k) & (2 ** 64 - 1)
            mask -= 2 ** 64 if mask >= 2 ** 63 else 0
            keys.append(F.xxhash64(F.lit(i * PER + k), F.col(c).bitwiseAND(F.lit(mask))))
    keyed = classes.select("doc", F.explode(F.array(*keys)).alias("key"))
    shared = cut(keyed.groupBy("key").agg(F.min("doc").alias("c"), F.max("doc").alias("z")).where("c <> z").select("key", "c"), "keys")
    members = cut(keyed.join(checked_broadcast(shared, shared.count()), "key").select("key", "doc", "c"), "members")

    nodes = cut(members.select("doc").distinct(), "nodes")
    n_nodes = nodes.count()
    edges = copies.select("a", "b")
    if n_nodes:
        small = checked_broadcast(nodes, n_nodes)
        sig = cut(classes.join(small, "doc").select("doc", *_S), "node-signatures")
        sets = cut(base.join(small, "doc").mapInArrow(_sets(words), "doc long, items binary"), "sets")
        tree, links = _links(members, nodes, n_nodes, sig, sets, percent)
        # copies hang on their class, classes on their tree; only links between trees are a general graph
        tree = checked_broadcast(tree, n_nodes)
        edges = edges.join(tree.withColumnRenamed("node", "a"), "a", "left").select(F.coalesce("root", "a").alias("a"), "b")
        edges = edges.unionByName(tree.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))).unionByName(links.select("a", "b"))
    comp = components(edges)
    out = sigs.select("doc", "n").join(comp.withColumnRenamed("node", "doc"), "doc", "left")
    root = F.coalesce("root", "doc")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), root.alias("component_id"),
                      F.coalesce(F.col("doc") == root, F.lit(True)).alias("kept"))


def _links(members: DataFrame, nodes: DataFrame, n_nodes: int, sig: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(node, root) of the trees that the stars build, and the links
    between different trees, as pairs (a, b) of their roots."""
    stars = members.where("doc <> c").select(F.col("c").alias("a"), F.col("doc").alias("b")).distinct()
    stars = cut(_scored(stars, checked_broadcast(sig, n_nodes, SIGNATURE_ROWS)), "stars")
    links = cut(_verify(stars, sets, percent), "links")
    hooks = links.groupBy("b").agg(F.min_by("a", F.struct("distance", "a")).alias("root")).withColumnRenamed("b", "node")
    tree = nodes.withColumnRenamed("doc", "node")
    tree = flatten(tree.join(hooks, "node", "left").select("node", F.coalesce("root", "node").alias("root")), n_nodes)
    small = checked_broadcast(tree, n_nodes)
    # what is left, completely: every pair of two trees under a key
    links = links.select("a", "b").unionByName(_complete(_mixed(members, small), small, sets, percent))
    for end in ("a", "b"):
        links = links.join(small.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("root", end)
    return tree, links.where("a <> b").distinct()


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map: (doc, label, text, items) to one row per shingle, with the
    set's size."""
    for batch in batches:
        given = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        data, offsets = A.utf8(batch.column(3))
        n = np.diff(offsets) // 8
        h = np.frombuffer(data[offsets[0]:offsets[-1]].tobytes(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*(np.repeat(g, n) for g in given), np.repeat(n, n), h)],
                                         names=["doc", "label", "text", "n", "h"])


def _shareable(mixed: DataFrame, tree: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Per text of the documents of ``mixed`` its size ``n`` and its shingles
    (``items``) that some document of another tree in ``mixed`` has too,
    without the texts that have too few of those."""
    docs = cut(tree.join(checked_broadcast(mixed.select(F.col("doc").alias("node")), mixed.count()), "node", "left_semi")
               .select(F.col("node").alias("doc"), F.col("root").alias("label")), "mixed-docs")
    docs = checked_broadcast(docs, docs.count())
    rows = (sets.join(docs, "doc").select("doc", "label", F.xxhash64("items").alias("text"), "items")
            .mapInArrow(_explode, "doc long, label long, text long, n long, h long"))
    rows = cut(rows, "shingles")
    shared = cut(rows.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("h"), "shared")
    common = rows.join(checked_broadcast(shared, shared.count()), "h")
    items = common.groupBy("doc", "text").agg(F.collect_set("h").alias("items"), F.min("n").alias("n"))
    return cut(items.where(F.lit(100) * F.size("items") >= F.lit(percent) * F.col("n")).select("doc", "n", "items"), "items")


def _complete(mixed: DataFrame, tree: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between documents of ``mixed`` with a common key and
    different labels: whole sets are counted, shingle by shingle."""
    items = _shareable(mixed, tree, sets, percent)
    far = checked_broadcast(items.select("doc"), items.count())
    m = cut(mixed.join(far, "doc", "left_semi"), "mixed")
    # keys with the same members are one: a digest of the members stands for them
    digest = [F.sum(F.xxhash64("doc", F.lit(k)).cast("decimal(20,0)")).alias(f"d{k}") for k in (0, 1)]
    size = (m.groupBy("key").agg(F.count(F.lit(1)).alias("members"), *digest, F.min("label").alias("lo"), F.max("label").alias("hi"))
            .where("lo <> hi").groupBy("members", "d0", "d1").agg(F.min("key").alias("key"))
            .select("key", F.ceil(F.col("members") / BLOCK).alias("blocks")))
    own = F.pmod(F.xxhash64("doc"), F.col("blocks"))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                       lambda g: F.struct(F.least(g, own).alias("i"), F.greatest(g, own).alias("j")))
    rows = m.join(size, "key").join(items, "doc").select("key", F.explode(pair).alias("p"), "label", "doc", "n", "items")
    return (rows.select("key", "p.i", "p.j", "label", "doc", "n", "items").repartition("key", "i", "j")
            .sortWithinPartitions("key", "i", "j").mapInArrow(_products(percent), "a long, b long"))


def _products(percent: int):
    """Arrow map over rows sorted by (key, i, j): links within each group."""
    def links(label, doc, n, items):
        h = np.concatenate(items)
        owner = np.repeat(np.arange(len(items)), [len(x) for x in items])
        _, column, times = np.unique(h, return_inverse=True, return_counts=True)
        several = times > 1
        number = np.cumsum(several) - 1
        use = several[column]
        owner, column = owner[use], number[column[use]]
        by = np.argsort(column, kind="stable")
        owner, column = owner[by], column[by]
        common = np.zeros((len(items), len(items)), np.float32)
        for lo in range(0, int(several.sum()), COLUMNS):
            x, y = np.searchsorted(column, (lo, lo + COLUMNS))
            part = np.zeros((len(items), COLUMNS), np.float32)
            part[owner[x:y], column[x:y] - lo] = 1
            common += part @ part.T
        x, y = np.nonzero((100 + percent) * common.astype(np.int64) >= percent * (n[:, None] + n[None, :]))
        ok = (doc[x] < doc[y]) & (label[x] != label[y])
        return doc[x[ok]], doc[y[ok]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, rows = None, []

        def flush():
            if len(rows) < 2:
                return None
            a, b = links(*(np.array([r[k] for r in rows]) for k in range(3)), [r[3] for r in rows])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        for batch in batches:
            key, i, j, label, doc, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            values, offs = np.asarray(batch.column(6).values), np.asarray(batch.column(6).offsets)
            for r in range(batch.num_rows):
                if here != (key[r], i[r], j[r]):
                    if (out := flush()) is not None:
                        yield out
                    here, rows = (key[r], i[r], j[r]), []
                rows.append((label[r], doc[r], n[r], values[offs[r]:offs[r + 1]].copy()))
        if (out := flush()) is not None:
            yield out
    return run


def _mixed(members: DataFrame, tree: DataFrame) -> DataFrame:
    """The (key, doc) of keys that hold several trees, with the document's
    tree as ``label``."""
    named = members.join(tree.withColumnRenamed("node", "doc"), "doc").select("key", "doc", F.col("root").alias("label"))
    several = cut(named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                  .where("lo <> hi").select("key"), "mixed-keys")
    return cut(named.join(checked_broadcast(several, several.count()), "key"), "mixed")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows whose component has a smaller id."""
    gone = cut(near_duplicates(docs, id_col, text_col, words, percent)
               .where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    gone = checked_broadcast(gone, gone.count())
    return docs.join(gone, F.col(f"`{id_col}`").cast("long") == F.col("_gone"), "left_anti")

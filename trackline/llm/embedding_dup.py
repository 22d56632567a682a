"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors are compared inside their label only, by cosine in double precision;
pairs of at least ``cosine`` are links.

* Equal vectors of a label are one class with its smallest id; copies are
  never expanded into pairs.
* Each label's classes are cut into overlapping shards: every vector belongs
  to the shards of its two nearest centroids.  They come from k-means on a
  sample, at most FAN in one task: a label that needs more gets a tree of
  them, fitted level by level, and its vectors look for their nearest leaves
  below the WIDE nearest nodes of a level.  A label of at most SHARD classes
  is one shard and needs none.
  A shard beyond BLOCK rows is cut into blocks, and each pair of blocks (at
  most some BLOCK rows) is a shard of its own, so a dense region is neither
  one task nor incomplete.
* In each shard a flat graph is built from a random one by two passes of
  batched greedy search and robust pruning (alpha 1.0, then ALPHA), with
  backward edges.  The adjacency lists of a vector from all its shards are
  united.
* Every class searches the united graph of its shards from their medoids,
  greedily with a beam; vectors found in range expand the search over their
  own neighbours, in both directions of an edge (pruning makes the middle of
  a dense region the neighbour of many that are not its own), until no new
  one is in range.
* Found pairs are verified exactly, so none below the threshold is linked.

A task holds one shard's vectors and their similarities (BLOCK x BLOCK
doubles); searches, candidates and found pairs are worked on in pieces of at
most PIECE numbers, whatever the table's size or a shard's density.

``audit_recall`` compares the links of the vectors whose id is divisible by
a number with brute force against all vectors.

Defined cases: vectors that are null, empty, zero, or hold a null or
non-finite component, and null labels, link with nothing and are kept (with
their own id as component); vectors of different length link with nothing;
rows with a null id have no component and are kept; rows that share an id
are one node; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.llm.arrays import chunks, ranges, runs
from trackline.llm.common import checked_broadcast, components, cut

SHARD, BLOCK, SAMPLE_PER_CENTROID = 800, 3000, 16
DEGREE, BEAM, ALPHA = 24, 40, 1.2
ASSIGN = 2
# centroids that one task fits; nodes of a level below which a vector looks on
FAN, WIDE = 256, 32
# numbers in one working array
PIECE = 1 << 21

# node -> (centroids, of each: the leaf's shard or -1, of each: the next node or -1)
Tree = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def _different(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[runs(values)]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists are of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _fit(fan: int):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One node's sample to its centroids, each with the number of leaves it is to have."""
        rows = pa.Table.from_batches(list(batches)).combine_chunks()
        order = np.argsort(rows["h"].to_numpy(), kind="stable")
        x = _unit(_matrix(rows["v"].combine_chunks())[order]).astype(np.float32)
        want = int(rows["k"][0].as_py())
        k = min(want, fan, len(x))
        c = x[np.linspace(0, len(x) - 1, k).astype(int)]
        for _ in range(8):
            own = (x @ c.T).argmax(axis=1)
            sums = np.stack([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(k)])
            c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if want > fan:
            share = np.bincount((x @ c.T).argmax(axis=1), minlength=k) / len(x)
            # at most half of them below one node: a level never repeats itself
            leaves = np.clip(np.rint(share * want), 1, want // 2).astype(np.int64)
        else:
            leaves = np.ones(k, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([v.as_py()] * k, f) for v, f in zip(key, (pa.string(), pa.int32(), pa.int64()), strict=True)]
                                         + [pa.array([r.tobytes() for r in c.astype(np.float64)], pa.binary()), pa.array(leaves)],
                                         names=["label", "dim", "node", "c", "k"])
    return run


def _firsts(rows: np.ndarray, sims: np.ndarray, n: int) -> np.ndarray:
    """Places of each row's ``n`` largest ``sims``, by row and from the largest on."""
    order = np.lexsort((-sims, rows))
    r = rows[order]
    return order[np.arange(len(r)) - np.searchsorted(r, r) < n]


def _nearest(x: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) of the ASSIGN nearest leaves of each row, by row."""
    rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
    found: list[list[np.ndarray]] = [[], [], []]
    while len(rows):
        below: list[list[np.ndarray]] = [[], [], []]
        by = np.argsort(nodes, kind="stable")
        for at in np.split(rows[by], np.flatnonzero(np.diff(nodes[by])) + 1):
            c, leaf, down = tree[int(nodes[by[0]])]
            by = by[len(at):]
            sim = x[at] @ c.T
            near = np.argsort(-sim, axis=1, kind="stable")[:, :WIDE if (down >= 0).any() else ASSIGN]
            r, s, near = np.repeat(at, near.shape[1]), np.take_along_axis(sim, near, 1).ravel(), near.ravel()
            for to, ids in ((found, leaf[near]), (below, down[near])):
                ok = ids >= 0
                for part, values in zip(to, (r[ok], ids[ok], s[ok]), strict=True):
                    part.append(values)
        r, ids, s = (np.concatenate(p) for p in below)
        keep = _firsts(r, s, WIDE)
        rows, nodes = r[keep], ids[keep]
    r, ids, s = (np.concatenate(p) for p in found)
    keep = _firsts(r, s, ASSIGN)
    return r[keep], ids[keep]


def _by_key(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray]]:
    """((label, dim), rows) of a batch's first columns ``label`` and ``dim``, a piece of the vectors at a time."""
    label = batch.column("label").dictionary_encode()
    codes, dim = label.indices.to_numpy(), batch.column("dim").to_numpy()
    order = np.lexsort((dim, codes))
    c, d = codes[order], dim[order]
    for at in np.split(order, np.flatnonzero((c[1:] != c[:-1]) | (d[1:] != d[:-1])) + 1):
        if len(at):
            key = (label.dictionary[int(codes[at[0]])].as_py(), int(dim[at[0]]))
            step = max(1, PIECE // 4 // max(key[1], FAN))
            for i in range(0, len(at), step):
                yield key, at[i:i + step]


def _vectors(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    return _unit(_matrix(batch.column("v").take(pa.array(rows))))


def _descend(trees: dict[tuple, Tree], k: dict[tuple, np.ndarray]):
    """Arrow map of a sample: its rows below the new nodes, each with its node and the leaves wanted there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, to, want = batch.column("node").to_numpy(), np.full(len(batch), -1), np.zeros(len(batch), np.int64)
            for key, at in _by_key(batch):
                for n in np.unique(node[at]):
                    own = at[node[at] == n]
                    c, _, down = trees.get(key, {}).get(int(n), (None, None, None))
                    if c is not None:
                        to[own] = down[(_vectors(batch, own) @ c.T).argmax(axis=1)]
                ok = at[to[at] >= 0]
                want[ok] = k[key][to[ok]]
            ok = pa.array(np.flatnonzero(to >= 0))
            out = batch.set_column(batch.schema.get_field_index("node"), "node", pa.array(to))
            yield out.set_column(out.schema.get_field_index("k"), "k", pa.array(want)).take(ok)
    return run


def _assign(trees: dict[tuple, Tree]):
    """Arrow map (id, label, dim, v): one row per shard of the vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, shards = [], []
            for key, at in _by_key(batch):
                if key in trees:
                    r, own = _nearest(_vectors(batch, at), trees[key])
                    rows.append(at[r])
                    shards.append(own)
                else:
                    rows.append(at)
                    shards.append(np.zeros(len(at), np.int64))
            if rows:
                out = batch.take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.concatenate(shards))], names=["id", "label", "dim", "v", "shard"])
    return run


def _search(sims: np.ndarray, lo: int, graph: np.ndarray, start: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Batched greedy search of some rows for themselves from ``start``:
    (beams by similarity, visited as row * n + row).  ``sims`` has the
    similarities of the rows from ``lo`` on to all ``n``; ``graph`` rows are
    padded with -1."""
    m, n = sims.shape
    every = np.arange(m)
    beams = np.full((m, beam), -1)
    best = np.full((m, beam), -np.inf)
    done = np.zeros((m, beam), bool)
    beams[:, 0], best[:, 0] = start, sims[:, start]
    seen = np.zeros((m, n), bool)
    seen[:, start] = True
    visited = []
    q = every
    while len(q):
        open_ = np.where((beams[q] >= 0) & ~done[q], best[q], -np.inf)
        at = open_.argmax(axis=1)
        ok = open_[np.arange(len(q)), at] > -np.inf
        q, at = q[ok], at[ok]
        pick = beams[q, at]
        done[q, at] = True
        visited.append((q + lo) * n + pick)
        nb = graph[pick]
        fresh = (nb >= 0) & ~seen[q[:, None], nb]
        some = fresh.any(axis=1)
        r, nb, fresh = q[some], nb[some], fresh[some]
        rows, cols = np.nonzero(fresh)
        seen[r[rows], nb[rows, cols]] = True
        s = np.where(fresh, sims[r[:, None], nb], -np.inf)
        some = s.max(axis=1, initial=-np.inf) > best[r, -1]
        r, nb, s = r[some], nb[some], s[some]
        all_s = np.concatenate((best[r], s), axis=1)
        top = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
        best[r] = np.take_along_axis(all_s, top, 1)
        beams[r] = np.where(np.isfinite(best[r]), np.take_along_axis(np.concatenate((beams[r], nb), axis=1), top, 1), -1)
        done[r] = np.take_along_axis(np.concatenate((done[r], np.zeros(nb.shape, bool)), axis=1), top, 1)
    return beams, np.concatenate(visited)


def _pieces(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Rows by their counts, so many at a time that PIECE numbers hold the widest of them for each."""
    order = np.argsort(counts, kind="stable")
    i = 0
    while i < len(order):
        fits = np.maximum(counts[order[i:]], 1) * np.arange(1, len(order) - i + 1) <= PIECE
        j = i + max(1, int(fits.argmin()) if not fits.all() else len(fits))
        yield order[i:j]
        i = j


def _padded(edges: np.ndarray, n: int, rows: np.ndarray | None = None, starts: np.ndarray | None = None) -> np.ndarray:
    """Rows' neighbours of sorted ``edges`` (row * n + row), padded with -1."""
    starts = np.searchsorted(edges, np.arange(n + 1) * n) if starts is None else starts
    rows = np.arange(n) if rows is None else rows
    counts = starts[rows + 1] - starts[rows]
    out = np.full((len(rows), max(1, int(counts.max()))), -1)
    out[np.repeat(np.arange(len(rows)), counts), ranges(np.zeros(len(rows), np.int64), counts)] = edges[ranges(starts[rows], counts)] % n
    return out


def _prune(sims: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
    """Robust pruning of each row's candidates (sorted, row * n + row) to at
    most DEGREE neighbours: the nearest is taken, and drops those that are
    alpha times nearer to it than to the row."""
    n = len(sims)
    candidates = candidates[candidates // n != candidates % n]
    starts = np.searchsorted(candidates, np.arange(n + 1) * n)
    graph = np.full((n, DEGREE), -1)
    for own in _pieces(np.diff(starts)):
        c = _padded(candidates, n, own, starts)
        dist = np.where(c >= 0, 2 - 2 * sims[own[:, None], c], np.inf)
        rows = np.arange(len(own))
        for k in range(DEGREE):
            at = dist.argmin(axis=1)
            left = np.isfinite(dist[np.arange(len(rows)), at])
            if not left.all():
                rows, c, dist, at = rows[left], c[left], dist[left], at[left]
            if not len(rows):
                break
            every = np.arange(len(rows))
            pick = c[every, at]
            graph[own[rows], k] = pick
            between = 2 - 2 * sims[pick[:, None], c]
            dist[alpha ** 2 * between <= dist + 1e-12] = np.inf
            dist[every, at] = np.inf
    return graph


def _medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(axis=0)).argmax())


def _edges(graph: np.ndarray) -> np.ndarray:
    """Sorted row * n + row of a padded graph."""
    src, k = np.nonzero(graph >= 0)
    return _different(src * len(graph) + graph[src, k])


def build_graph(x: np.ndarray) -> np.ndarray:
    """Flat graph of unit vectors: neighbour rows padded with -1."""
    n = len(x)
    rng = np.random.default_rng(n)
    if n <= DEGREE + 1:
        return np.array([[j for j in range(n) if j != i] + [-1] * (DEGREE - n + 1) for i in range(n)]).reshape(n, DEGREE)
    sims = x @ x.T
    step = max(1, PIECE // n)
    graph = _padded(_edges((np.arange(n)[:, None] + rng.integers(1, n, (n, DEGREE))) % n), n)
    for alpha in (1.0, ALPHA):
        start = _medoid(x)
        seen = [_search(sims[i:i + step], i, graph, start, BEAM)[1] for i in range(0, n, step)]
        graph = _prune(sims, _different(np.concatenate([*seen, _edges(graph)])), alpha)
        own = _edges(graph)
        both = _different(np.concatenate((own, own % n * n + own // n)))
        if np.bincount(both // n, minlength=n).max() > DEGREE:
            graph = _prune(sims, both, alpha)
        else:
            graph = _padded(both, n)
    return graph


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard to its adjacency lists, by id."""
    rows = pa.Table.from_batches(list(batches))
    order = np.argsort(rows["id"].to_numpy(), kind="stable")
    ids = rows["id"].to_numpy()[order]
    x = _matrix(rows["v"].combine_chunks())[order]
    del rows
    graph = build_graph(_unit(x))
    kept = graph >= 0
    offsets = np.concatenate(([0], np.cumsum(kept.sum(axis=1)))).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[graph[kept]]))], names=["id", "near"])


def _in_range(x: np.ndarray, edges: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a < b) of at least ``cosine`` that the graph finds, a piece at a time."""
    n, start = len(x), _medoid(x)
    graph = _padded(edges, n)
    ends = _different(np.concatenate((edges, edges % n * n + edges // n)))
    starts = np.searchsorted(ends, np.arange(n + 1) * n)
    degree = np.diff(starts)
    step = max(1, PIECE // n)
    for lo in range(0, n, step):
        sims = x[lo:lo + step] @ x.T
        m = len(sims)
        beams, _ = _search(sims, lo, graph, start, BEAM)
        known = np.zeros((m, n), bool)
        r, k = np.nonzero(beams >= 0)
        known[r, beams[r, k]] = True
        rows = np.arange(lo, lo + m)
        known[np.repeat(np.arange(m), degree[rows]), ends[ranges(starts[rows], degree[rows])] % n] = True
        known[np.arange(m), rows] = False
        hits = sims >= cosine
        hits[np.arange(m), rows] = False
        # vectors found in range, of which the neighbours are yet to be looked at
        front = np.flatnonzero(known & hits)
        grown = np.zeros(m * n, bool)
        grown[front] = True
        while len(front):
            before = grown.copy()
            size = np.cumsum(degree[front % n])
            cuts = np.searchsorted(size, np.arange(PIECE, size[-1], PIECE)) + 1
            for part in np.split(front, cuts):
                d = degree[part % n]
                grown[np.repeat(part // n, d) * n + ends[ranges(starts[part % n], d)] % n] = True
            grown &= hits.ravel()
            front = np.flatnonzero(grown & ~before)
        found = np.flatnonzero(grown)
        a, b = found // n + lo, found % n
        yield a[b > a], b[b > a]


def _range_search(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's vectors, and rows with their united adjacency lists, to its pairs in range."""
        rows = pa.Table.from_batches(list(batches)).select(["id", "v", "near"]).combine_chunks()
        with_v = rows.filter(rows["v"].is_valid()).combine_chunks()
        order = np.argsort(with_v["id"].to_numpy(), kind="stable")
        ids = with_v["id"].to_numpy()[order]
        x = _unit(_matrix(with_v["v"].combine_chunks())[order])
        lists = rows.filter(rows["near"].is_valid()).combine_chunks()
        del rows, with_v
        near = lists["near"].combine_chunks()
        src = np.repeat(np.searchsorted(ids, lists["id"].to_numpy()), near.value_lengths().to_numpy())
        near = near.flatten().to_numpy()
        at = np.minimum(np.searchsorted(ids, near), len(ids) - 1)
        ok = ids[at] == near
        for a, b in _in_range(x, _different(src[ok] * len(ids) + at[ok]), cosine):
            for i in range(0, len(a), PIECE // 8):
                yield pa.RecordBatch.from_arrays([pa.array(ids[a[i:i + PIECE // 8]]), pa.array(ids[b[i:i + PIECE // 8]])], names=["a", "b"])
    return run


def _trees(points: DataFrame) -> dict[tuple, Tree]:
    """Centroids of each (label, dim) beyond SHARD rows, fitted level by level on samples."""
    part = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / float(1 << 30)
    sizes = points.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD)
    sizes = sizes.withColumn("k", F.ceil(F.col("n") / SHARD).cast("long"))
    # a few more than a label's share, so that a small one has enough
    some = F.col("k") * SAMPLE_PER_CENTROID + 64 > part(1) * F.col("n")
    sample = points.join(sizes, ["label", "dim"]).where(some).select("label", "dim", F.lit(0).cast("long").alias("node"), "k", F.xxhash64("id").alias("h"), part(2).alias("p"), "v")
    sample = cut(sample, "sample")
    trees: dict[tuple, Tree] = {}
    shards: dict[tuple, int] = {}
    nodes: dict[tuple, list[int]] = {}
    while True:
        fitted = sample.where(F.col("p") * F.col("k") < FAN).select("label", "dim", "node", "k", "h", "v").groupBy("label", "dim", "node").applyInArrow(
            _fit(FAN), "label string, dim int, node long, c binary, k long")
        found: dict[tuple, list] = {}
        for r in fitted.collect():
            found.setdefault((r["label"], r["dim"], r["node"]), []).append((r["c"], r["k"]))
        level: dict[tuple, Tree] = {}
        for (label, dim, node), rows in found.items():
            key = (label, dim)
            want = nodes.setdefault(key, [0])
            leaf, down = np.full(len(rows), -1), np.full(len(rows), -1)
            for i, (_, k) in enumerate(rows):
                if k > 1:
                    down[i] = len(want)
                    want.append(k)
                else:
                    leaf[i] = shards[key] = shards.get(key, -1) + 1
            fit = (np.frombuffer(b"".join(c for c, _ in rows)).reshape(len(rows), dim), leaf, down)
            level.setdefault(key, {})[node] = trees.setdefault(key, {})[node] = fit
        if not any((down >= 0).any() for tree in level.values() for _, _, down in tree.values()):
            break
        sample = cut(sample.mapInArrow(_descend(level, {key: np.array(k) for key, k in nodes.items()}), sample.schema), "sample")
    # a node that no row of the sample came to is a leaf
    for key, tree in trees.items():
        for _, leaf, down in tree.values():
            for i in np.flatnonzero(down >= 0):
                if int(down[i]) not in tree:
                    shards[key] = leaf[i] = shards.get(key, -1) + 1
                    down[i] = -1
    return trees


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, v) to (id, label, dim, v) of the rows whose vector has a
    length and finite components, scaled by the largest component, so that
    the norm neither overflows nor vanishes."""
    for whole in batches:
        ends = np.concatenate(([0], np.cumsum(whole.column("v").value_lengths().fill_null(0).to_numpy())))
        for i, j in chunks(ends, PIECE):
            batch, dim = whole.slice(i, j - i), np.diff(ends[i:j + 1])
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            top, ok = np.zeros(j - i), dim > 0
            if len(v):
                top[ok] = np.maximum.reduceat(np.abs(v), (ends[i:j] - ends[i])[ok])
            ok = (top > 0) & (top < np.inf)  # nan is neither
            kept = np.repeat(ok, dim)
            v = v[kept] / np.repeat(top[ok], dim[ok]) + 0.0
            offsets = np.concatenate(([0], np.cumsum(dim[ok]))).astype(np.int32)
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("label").take(at), pa.array(dim[ok].astype(np.int32)),
                                              pa.ListArray.from_arrays(pa.array(offsets), pa.array(v))], names=["id", "label", "dim", "v"])


def _valid(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    d = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                       F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    d = d.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    return d.mapInArrow(_scaled, "id long, label string, dim int, v array<double>")


def class_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                cosine: float = 0.98) -> tuple[DataFrame, DataFrame]:
    """(members: ``id``, ``rep``, ``copies``; links ``a``, ``b`` of
    different classes, by their smallest ids)."""
    valid = cut(_valid(vectors, id_col, vector_col, label_col), "vectors")
    classes = cut(valid.groupBy("label", "dim", "v").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies")), "classes")
    # the hash comes first, so that sorting seldom compares vectors
    h = F.xxhash64("v").alias("h")
    members = valid.select("*", h).join(classes.select("*", h), ["h", "label", "dim", "v"]).select("id", "rep", "copies").distinct()

    points = cut(classes.groupBy("rep", "label", "dim").agg(F.min("v").alias("v")).withColumnRenamed("rep", "id"), "points")
    dealt = points.select("id", "label", "dim", "v").mapInArrow(
        _assign(_trees(points)), "id long, label string, dim int, v array<double>, shard long")
    dealt = cut(dealt, "shards")
    group = ["label", "dim", "shard"]
    large = dealt.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    large = cut(large.select(*group, F.ceil(F.col("n") * 2 / BLOCK).alias("blocks")), "blocks")
    parts = dealt.join(checked_broadcast(large, large.count()), group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                       lambda g: F.struct(F.least(g, own).alias("i"), F.greatest(g, own).alias("j")))
    parts = parts.select("id", *group, "v", F.explode(pair).alias("p")).select("id", *group, "p.i", "p.j", "v")
    group = [*group, "i", "j"]
    near = parts.groupBy(*group).applyInArrow(_build, "id long, near array<long>")
    united = cut(near.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "adjacency")
    # the lists go to the shards by themselves, so that the vectors are shuffled once
    lists = parts.select("id", *group).join(united, "id").select("id", *group, F.lit(None).cast("array<double>").alias("v"), "near")
    links = (parts.withColumn("near", F.lit(None).cast("array<long>")).select(*lists.columns).unionByName(lists)
             .groupBy(*group).applyInArrow(_range_search(cosine), "a long, b long").where("a <> b").distinct())
    return cut(members, "members"), cut(links, "links")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                           cosine: float = 0.98) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``,
    ``component_id`` and ``kept``."""
    members, links = class_links(vectors, id_col, vector_col, label_col, cosine)
    weight = members.groupBy("rep").agg(F.max("copies").alias("copies"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(weight, F.col("b") == F.col("rep")).groupBy(F.col("a").alias("o_rep")).agg(F.sum("copies").alias("others"))
    comp = components(links.unionByName(members.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))))
    per = (members.join(others, F.col("rep") == F.col("o_rep"), "left").groupBy("id")
           .agg(F.max(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
           .join(comp.withColumnRenamed("node", "id"), "id", "left"))
    out = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id")).join(per, F.col("vec_id") == F.col("id"), "left")
    root = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"),
                      F.coalesce(F.col("vec_id") == root, F.lit(True)).alias("kept"))


def audit_recall(vectors: DataFrame, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", cosine: float = 0.98) -> DataFrame:
    """One row: ``expected`` links of the queries (ids divisible by ``every``)
    by brute force against all vectors in blocks, and ``found`` ones."""
    members, links = class_links(vectors, id_col, vector_col, label_col, cosine)
    valid = _valid(vectors, id_col, vector_col, label_col)
    queries = valid.where(F.col("id") % every == 0)
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t)
    size = F.sqrt(dot(F.col("v"), F.col("v")))
    q = queries.select(F.col("id").alias("q"), "label", "dim", F.col("v").alias("w"), size.alias("wn"))
    all_ = valid.select("id", "label", "dim", "v", size.alias("vn"))
    true = (all_.join(q, ["label", "dim"]).where(F.col("id") != F.col("q"))
            .where(dot(F.col("v"), F.col("w")) >= F.col("vn") * F.col("wn") * F.lit(cosine)).select("q", "id").distinct())
    rep = members.select("id", "rep")
    t = (true.join(rep.select(F.col("id").alias("q"), F.col("rep").alias("x")), "q").join(rep.select("id", F.col("rep").alias("y")), "id"))
    t = t.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    hit = t.join(links.withColumn("hit", F.lit(1)), ["a", "b"], "left")
    return hit.agg(F.count(F.lit(1)).alias("expected"), F.count_if(F.col("hit").isNotNull() | (F.col("a") == F.col("b"))).alias("found"))

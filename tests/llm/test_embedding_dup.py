"""Near-duplicate vectors: bounded working memory, trees of centroids, blocks."""

import tracemalloc

import numpy as np
import pytest

from trackline.llm import embedding_dup as e


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def clumps(n, each, dims, scale, seed=1):
    rng = np.random.default_rng(seed)
    return np.repeat(rng.normal(size=(n // each, dims)), each, axis=0) + rng.normal(scale=scale, size=(n // each * each, dims))


def test_graph_memory():
    """A shard of clumps has rows with very many candidates: they are pruned in pieces."""
    x = unit(clumps(1600, 20, 64, 0.1))
    tracemalloc.start()
    graph = e.build_graph(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert graph.shape[0] == len(x) and (graph >= 0).any(axis=1).all()
    assert peak < 250e6


@pytest.mark.parametrize("piece", [1 << 9, 1 << 13, 1 << 21])
def test_pairs_in_pieces(monkeypatch, piece):
    """A dense shard's pairs come in pieces, and are all of them."""
    x = unit(np.concatenate((clumps(300, 300, 16, 0.02), clumps(200, 10, 16, 0.02, 2), clumps(100, 1, 16, 1, 3))))
    monkeypatch.setattr(e, "PIECE", piece)
    graph = e.build_graph(x)
    got = list(e._in_range(x, e._edges(graph), 0.98))
    true = np.argwhere(np.triu(x @ x.T >= 0.98, 1))
    pairs = {(int(i), int(j)) for a, b in got for i, j in zip(a, b, strict=True)}
    assert pairs == {(i, j) for i, j in true.tolist()} and sum(len(a) for a, _ in got) == len(pairs)
    assert max(len(a) for a, _ in got) <= max(piece, len(x))


def test_nearest_leaves():
    """Below the nodes of a level the nearest leaves are found; a flat tree gives the two nearest of all."""
    rng = np.random.default_rng(4)
    c, x = unit(rng.normal(size=(60, 8))), unit(rng.normal(size=(500, 8)))
    near = np.argsort(-(x @ c.T), axis=1)[:, :2]
    flat = {0: (c, np.arange(60), np.full(60, -1))}
    rows, leaves = e._nearest(x, flat)
    assert (leaves.reshape(-1, 2) == near).all() and (rows == np.repeat(np.arange(500), 2)).all()
    # 6 nodes of 10 leaves: all of them are looked at
    tree = {0: (c[:6], np.full(6, -1), np.arange(1, 7))} | {i + 1: (c[i * 10:i * 10 + 10], np.arange(i * 10, i * 10 + 10), np.full(10, -1)) for i in range(6)}
    rows, leaves = e._nearest(x, tree)
    assert (leaves.reshape(-1, 2) == near).all() and (rows == np.repeat(np.arange(500), 2)).all()


def test_trees_and_blocks(spark, monkeypatch):
    """Labels with more shards than one task fits, shards beyond a block, a label without centroids."""
    for name, value in (("SHARD", 40), ("FAN", 3), ("BLOCK", 50)):
        monkeypatch.setattr(e, name, value)
    x = np.concatenate((clumps(600, 4, 12, 0.03), clumps(90, 90, 12, 0.02, 2), clumps(30, 3, 12, 0.03, 3))).astype(np.float32)
    label = np.where(np.arange(len(x)) < 690, 1, 2)
    df = spark.createDataFrame([(i, [float(c) for c in v], int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))],
                               "vec_id long, embedding array<float>, label int")
    trees = e._trees(e._valid(df, "vec_id", "embedding", "label"))
    assert list(trees) == [("1", 12)]
    leaves = np.concatenate([leaf[leaf >= 0] for _, leaf, _ in trees["1", 12].values()])
    assert len(trees["1", 12]) > 1 and sorted(leaves) == list(range(len(leaves))) and len(leaves) >= 9
    u = unit(x.astype(float))
    link = (u @ u.T >= 0.98) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    got = {r["vec_id"]: r["n_links"] for r in e.near_duplicate_vectors(df).collect()}
    got = np.array([got[i] for i in range(len(x))])
    assert (got <= link.sum(axis=1)).all() and got.sum() >= 0.95 * link.sum()

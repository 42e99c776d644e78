"""Operator 5 against brute force."""

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import near_vectors
from tallyframe.llm.small_world import Graph


def brute(rows):
    good = [(i, np.array(v, float), lab) for i, v, lab in rows
            if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    ids = sorted({i for i, _, _ in rows if i is not None})
    near, root = {i: set() for i in ids}, {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, v, lab) in enumerate(good):
        for j, w, other in good[:a]:
            if i != j and lab == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
                near[i].add(j)
                near[j].add(i)
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(near[i]) if i is not None else 0, find(i) if i is not None else None, i is None or find(i) == i) for i, _, _ in rows), key=str)


def rows_of(seed, n=260):
    rng = np.random.default_rng(seed)
    rows, centre = [], rng.normal(size=16)
    for i in range(n):
        kind = rng.integers(4)
        if kind == 0:
            v = centre + rng.normal(size=16) * rng.choice([0.02, 0.05, 0.12])
        elif kind == 1 and rows:
            v = np.array(rows[rng.integers(len(rows))][1]) * rng.choice([1.0, 1.0, 2.5])
        else:
            v = rng.normal(size=16)
        rows.append((i * 7 % 1009, [float(np.float32(x)) for x in v], int(rng.integers(2))))
    nan, inf = float("nan"), float("inf")
    return rows + [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [nan] * 16, 1), (2004, [inf] + [1.0] * 15, 1), (2005, [None] + [1.0] * 15, 1),
                   (2006, rows[0][1], None), (None, rows[0][1], 1), (2007, [1.0, 1.0], 0), (2008, [1.0, 1.0], 0), (2009, [1e30, 1e30], 0)]


@pytest.mark.parametrize("seed,shard_rows", [(1, 8192), (2, 40)])
def test_links_and_components(spark, seed, shard_rows):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "null as shard", "null as rep", "null as links")
    got = sorted((tuple(r) for r in near_vectors.near_vectors(df, shard_rows).collect()), key=str)
    assert got == brute(rows)


def test_empty_and_repeated(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert near_vectors.near_vectors(spark.createDataFrame([], kind)).collect() == []
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)]
    assert sorted(map(tuple, near_vectors.near_vectors(spark.createDataFrame(rows, kind)).collect())) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]


def test_graph_finds_neighbours():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 24))
    x[:400] = x[0] + rng.normal(size=(400, 24)) * 0.05
    x = near_vectors.unit(x)
    g = Graph.build(x, np.arange(1500))
    row, node = g.within(x[:600], 0.9, 32)
    true = set(zip(*np.nonzero(x[:600] @ x.T >= 0.9)))
    found = set(zip(row.tolist(), node.tolist()))
    assert found <= true and len(found) >= 0.97 * len(true)


def shard(ids, x):
    return near_vectors.build_shard(pa.table([pa.array(ids, pa.int64()), pa.array([1] * len(ids), pa.int64()), pa.array(x.astype(np.float32).tolist(), pa.list_(pa.float32()))],
                                             names=["vec_id", "copies", "embedding"]))


def test_last_vector_of_a_shard_is_found():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 24))
    x[450] = x[299] * 1.5 + 1e-3  # the only link: to the largest vec_id of the left shard
    left, right = shard(range(300), x[:300]), shard(range(300, 600), x[300:])
    assert near_vectors.search_shards(left, right).to_pylist() == [{"a": 299, "b": 299, "links": 1}, {"a": 450, "b": 299, "links": 1}]
    graph = near_vectors.open_shard(left)[3]
    ids, _ = graph.search(0, graph.x, np.full((300, 1), graph.entry, np.int32), 24)
    assert all(len(set(r)) == len(r) for r in ids.tolist()) and (ids == 299).any()


def test_audit_measures_links_though_there_are_none():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 24))
    ids, _, left, graph, beam = near_vectors.open_shard(shard(range(900), x))
    assert beam == near_vectors.FIRST_BEAM
    q = near_vectors.turned(left, ids)
    near = (near_vectors.unit(q) * near_vectors.unit(left)).sum(axis=1)
    assert near.min() > 0.97999 and near.max() < 0.9901 and near.std() > 1e-3
    # a broken graph finds nothing but its entry: all is compared then
    good, graph.layers = graph.layers, [np.full_like(t, -1) for t in graph.layers]
    assert near_vectors.audited_beam(graph, left, ids) is None
    r, c = (np.concatenate(z) for z in zip(*near_vectors.find(graph, left, left, None)))
    assert (r == c).all() and len(r) == 900
    graph.layers = good

    def only_itself(g):
        """Every query finds the vector nearest to it and nothing else."""
        g.search = lambda k, u, start, beam: (np.pad((u @ g.x.T).argmax(axis=1)[:, None].astype(np.int32), ((0, 0), (0, beam - 1)), constant_values=-1),
                                              np.pad((u @ g.x.T).max(axis=1)[:, None], ((0, 0), (0, beam - 1)), constant_values=-np.inf))
        g.layers = [np.full_like(t, -1) for t in g.layers]

    # where vectors have real links, a match with itself is no proof
    x[450:] = x[:450] + rng.normal(size=(450, 24)) * 0.02
    ids, _, left, graph, _ = near_vectors.open_shard(shard(range(900), x))
    only_itself(graph)
    assert near_vectors.audited_beam(graph, left, ids) is None


def test_links_across_shards_of_random_vectors():
    """Rare links between shards full of unlinked vectors are found (recall by brute force)."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 64))
    x[2000:2300] = near_vectors.turned(x[:300].astype(np.float32), np.arange(300))
    left, right = shard(range(2000), x[:2000]), shard(range(2000, 4000), x[2000:])
    got = {r["a"]: r["b"] for r in near_vectors.search_shards(left, right).to_pylist()}
    assert sum(got.get(2000 + i) == i for i in range(300)) >= 0.97 * 300
    one = near_vectors.turned(np.array([[3.0], [-2.0]], np.float32), np.array([1, 2]))
    assert np.allclose(one, [[1.0], [-1.0]])

"""Operator 5: near-duplicate vectors by small-world graphs per shard.

Equal vectors of one label are one class; its smallest vec_id stands for it.
The classes of a label are dealt into shards of about ``SHARD_ROWS``.  Each
shard's hierarchical graph is built once and stored; then every shard's
vectors query every shard of their label (each pair of shards once), a
query block at a time.  A query is a beam search followed by a walk through
all vectors near enough.  Each graph is audited once, when it is built, with
queries that always have a link to find: stored vectors chosen by hash,
turned by a random angle that leaves a cosine of ``LEAST`` to ``CLOSE``, and,
beside them, the links that stored vectors really have.  Of each kind the
links found must reach ``RECALL`` of those that brute force finds.  Until
they do, the graph's beam is doubled; past ``WIDEST`` all queries of that
graph are compared by brute force.  Each
link found is verified by its cosine in double precision.  A pair of shards
returns, for each vector, the number of links (copies counted) and one edge
to the smallest vector it is joined with there, never the pairs themselves,
so a dense group costs one row per vector.

Defined cases: vectors that are null, empty or zero, or hold null or
non-finite numbers, and vectors with a null label or vec_id, link with
nothing and are their own component.  Vectors of different lengths link with
nothing.  Rows of one vec_id count as one vector.  An empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import arrays as A
from tallyframe.llm import mail as M
from tallyframe.llm.components import components
from tallyframe.llm.shared import stored
from tallyframe.llm.small_world import LOT, Graph

LEAST, CLOSE, RECALL, AUDIT, FIRST_BEAM, WIDEST, SHARD_ROWS = 0.98, 0.99, 0.98, 256, 24, 768, 8192
#: single-precision similarities may be off by this much before verification
SLACK = 1e-5


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision (scaled first, so that nothing overflows)."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    a /= np.abs(a).max(axis=1, keepdims=True)
    b /= np.abs(b).max(axis=1, keepdims=True)
    return np.einsum("nd,nd->n", a, b) / np.sqrt(np.einsum("nd,nd->n", a, a) * np.einsum("nd,nd->n", b, b))


def build_shard(table: pa.Table) -> bytes:
    """A shard's vectors and graph as one binary."""
    ids = table.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, count = ids[order], table.column("copies").to_numpy()[order]
    column = table.column("embedding").combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[order]
    g = Graph.build(unit(x), ids)
    shape = np.array([x.shape[1], g.entry, audited_beam(g, x, ids) or 0, *(t.shape[1] for t in g.layers)], np.int64)
    return M.pack(ids, count, x.astype(np.float64 if x.dtype == np.float64 else np.float32).ravel(), shape, *(t.ravel() for t in g.layers))


def open_shard(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph, int | None]:
    """(ids, copies, vectors, graph, beam) of a shard; no beam: its queries are compared by brute force."""
    ids, count, x, shape, *layers = M.unpack(payload)
    x = x.reshape(len(ids), shape[0])
    graph = Graph(unit(x), [t.reshape(len(ids), w) for t, w in zip(layers, shape[3:], strict=True)], int(shape[1]))
    return ids, count, x, graph, int(shape[2]) or None


def find(graph: Graph, x: np.ndarray, q: np.ndarray, beam: int | None):
    """Verified (query, vector) pairs, a block of queries at a time; all there are if ``beam`` is None."""
    qu = unit(q)
    for a in range(0, len(q), LOT):
        part = qu[a : a + LOT]
        row, node = np.nonzero(part @ graph.x.T >= LEAST - SLACK) if beam is None else graph.within(part, LEAST - SLACK, beam)
        for lo in range(0, len(row), 1 << 18):
            r, c = row[lo : lo + (1 << 18)] + a, node[lo : lo + (1 << 18)]
            fit = exact(q[r], x[c]) >= LEAST
            yield r[fit], c[fit]


def turned(x: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Each vector at a random angle, with a cosine of ``LEAST`` to ``CLOSE`` to what it was; repeatable."""
    v = unit(x).astype(np.float64)
    side = np.random.default_rng(int(ids[0]) & 0x7FFFFFFF).standard_normal(v.shape)
    side -= (side * v).sum(1, keepdims=True) * v
    size = np.linalg.norm(side, axis=1, keepdims=True)
    share = (A.mix(ids.view(A.U64), 62) >> A.U64(11)).astype(np.float64)[:, None] / 2.0**53
    cosine = np.where(size > 1e-9, LEAST + 1e-6 + (CLOSE - LEAST) * share, 1.0)       # one dimension has no side
    return cosine * v + np.sqrt(1 - cosine**2) * side / np.maximum(size, 1e-9)


def audited_beam(graph: Graph, x: np.ndarray, ids: np.ndarray) -> int | None:
    """The first beam that finds enough of the audit's links (None: none does, compare all)."""
    pick = np.argsort(A.mix(ids.view(A.U64), 61), kind="stable")[:AUDIT]

    def links(beam: int | None) -> np.ndarray:
        planted = sum(len(r) for r, _ in find(graph, x, queries, beam))
        real = sum(int((pick[r] != c).sum()) for r, c in find(graph, x, x[pick], beam))
        return np.array([planted, real])

    queries = turned(x[pick], ids[pick])
    truth, beam = links(None), FIRST_BEAM
    while beam <= WIDEST:
        if (links(beam) >= RECALL * truth).all():
            return beam
        beam *= 2
    return None


def search_shards(left: bytes, right: bytes | None) -> pa.Table:
    """Query the left shard with the right shard's vectors (its own if None)."""
    ids, count, x, graph, beam = open_shard(left)
    if right is None:
        q_ids, q_count, q = ids, count, x
    else:
        q_ids, q_count, q, _, _ = open_shard(right)
    n = len(ids)
    shift = 0 if right is None else n
    links, root = np.zeros(shift + len(q_ids), np.int64), np.arange(shift + len(q_ids))
    all_ids = ids if right is None else np.r_[ids, q_ids]
    met: list[np.ndarray] = []
    for r, c in find(graph, x, q, beam):
        if right is None:
            r, c = r[r != c], c[r != c]
            met.append(np.unique(np.minimum(r, c) * n + np.maximum(r, c)))
            continue
        links += np.bincount(r + shift, count[c], len(links)).astype(np.int64) + np.bincount(c, q_count[r], len(links)).astype(np.int64)
        unite(root, r + shift, c)
    if met:  # a pair may be found from either end: count it once
        key = np.unique(np.concatenate(met))
        r, c = key // n, key % n
        links += np.bincount(r, count[c], len(links)).astype(np.int64) + np.bincount(c, count[r], len(links)).astype(np.int64)
        unite(root, r, c)
    hit = np.flatnonzero(links)
    least = np.full(len(root), np.iinfo(np.int64).max)
    np.minimum.at(least, root[hit], all_ids[hit])
    return pa.table([pa.array(all_ids[hit]), pa.array(least[root[hit]]), pa.array(links[hit])], names=["a", "b", "links"])


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of the given pairs; ``root`` names each entry's component."""
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        open_ = low != high
        if not open_.any():
            return
        np.minimum.at(root, high[open_], low[open_])
        while True:
            nxt = root[root]
            if (nxt == root).all():
                break
            root[:] = nxt


def near_vectors(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.coalesce(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))
            & F.coalesce(F.exists("embedding", lambda v: v != 0), F.lit(False)))
    rows = vectors.select("vec_id", "embedding", "label")
    classes = (rows.where(fine).groupBy("label", "embedding").agg(F.min("vec_id").cast("long").alias("rep"), F.count_distinct("vec_id").alias("copies")))
    kinds = classes.groupBy("label", F.size("embedding").alias("width")).agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"))
    dealt = (classes.withColumn("width", F.size("embedding")).join(kinds, ["label", "width"])
             .select("label", "width", F.pmod(F.xxhash64("rep"), "shards").alias("shard"), F.col("rep").alias("vec_id"), "copies", "embedding"))

    def build(key, table: pa.Table) -> pa.Table:
        return pa.table([pa.array([key[0].as_py()], key[0].type), pa.array([key[1].as_py()], pa.int32()), pa.array([key[2].as_py()], pa.int64()), pa.array([build_shard(table)], pa.binary())],
                        names=["label", "width", "shard", "graph"])

    kind = dict(vectors.dtypes)["label"]
    graphs = stored(dealt.groupBy("label", "width", "shard").applyInArrow(lambda key, t: build(key, t), f"label {kind}, width int, shard long, graph binary"))

    def search(batches):
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1), strict=True):
                yield from search_shards(left.as_buffer().to_pybytes(), right.as_buffer().to_pybytes() if right.is_valid else None).to_batches()

    other = graphs.select("label", "width", F.col("shard").alias("other"), F.col("graph").alias("queries"))
    pairs = (graphs.select("label", "width", "shard", "graph").join(other, ["label", "width"]).where("shard <= other")
             .select("graph", F.when(F.col("shard") < F.col("other"), F.col("queries")).alias("queries"))
             .repartition(max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    found = stored(pairs.mapInArrow(search, "a long, b long, links long"))
    labels = components(found.select("a", "b"))
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    per_class = (classes.join(counts, "rep", "left").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
                 .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    good = rows.where(fine).join(per_class, ["label", "embedding"]).select(F.col("vec_id").cast("long").alias("vec_id"), "n_links", "component_id")
    bad = rows.where(~fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

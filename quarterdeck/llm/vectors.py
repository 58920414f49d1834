"""Nearest neighbours by a hierarchical navigable small-world graph for each shard of the vectors.

Rows are dealt evenly into shards of bounded size. A shard's graph is layered: every vector is on
layer 0, a ``1 / DEGREE`` share of a layer is on the next. On each layer a vector links to
near vectors that are not nearer to one another than to it (the usual diversity rule), and back.
Candidates for links are the nearest of the whole layer, found exactly, as a shard is small.
The graph is kept as flat arrays of neighbour numbers, one row of the index per shard.

A search descends from the top layer and ends with a beam of ``ef`` on layer 0; shards are searched
independently and their results merged. Equal vectors are one node of the graph that lists its rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterdeck.workspace import written

SHARD_ROWS = 4096
DEGREE, CANDIDATES = 16, 48
BEAM, UPPER_BEAM, EXPANDED = 96, 8, 4
# Queries that a task has at hand at a time: their number is bounded, not that of the queries.
QUERY_BLOCK = 32_768
SEARCHED = 512


def _frame(nodes: np.ndarray) -> tuple[float, np.ndarray, float]:
    """What makes the vectors of a shard small numbers about zero: a first divisor, a centre and a second
    divisor. Distances within the shard then neither overflow nor drown in an offset that all share."""
    most = float(np.abs(nodes).max())
    centre = (nodes / most).mean(0)
    return most, centre, float(np.abs(nodes / most - centre).max()) or 1.0


def _framed(vectors: np.ndarray, frame: tuple[float, np.ndarray, float]) -> np.ndarray:
    """Vectors in a shard's frame, in double precision; what lies beyond all measure is held at 1e150."""
    most, centre, spread = frame
    with np.errstate(over="ignore"):
        return np.clip((vectors.astype(np.float64) / most - centre) / spread, -1e150, 1e150)


def _measure(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to rows, from their differences. Only differences whose squares would
    leave the range of a double are scaled first."""
    with np.errstate(over="ignore", under="ignore"):
        d = a.astype(np.float64) - b.astype(np.float64)
        out = np.sqrt((d**2).sum(1))
        most = np.abs(d).max(1, initial=0)
        odd = np.isfinite(most) & ((most > 1e150) | ((most < 1e-150) & (most > 0)))
        out[odd] = most[odd] * np.sqrt(((d[odd] / most[odd, None]) ** 2).sum(1))
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``, as far as they tell candidates apart."""
    d = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * (a @ b.T)
    return np.maximum(d, 0)


def _links(x: np.ndarray, degree: int, candidates: int) -> np.ndarray:
    """Neighbours of every row on one layer, nearest first as far as they are diverse, padded by -1."""
    n = len(x)
    c = min(candidates, n - 1)
    out = np.full((n, 2 * degree), -1, np.int32)
    if c < 1:
        return out
    own = np.full((n, degree), -1, np.int32)
    for i in range(0, n, 256):
        rows = np.arange(i, min(n, i + 256))
        d = _distances(x[rows], x)
        d[np.arange(len(rows)), rows] = np.inf
        near = np.argpartition(d, c - 1, axis=1)[:, :c]
        dist = ((x[near] - x[rows][:, None, :]) ** 2).sum(2)
        order = np.argsort(dist, axis=1, kind="stable")
        near, dist = np.take_along_axis(near, order, 1), np.take_along_axis(dist, order, 1)
        v = x[near]
        square = (v**2).sum(2)
        between = square[:, :, None] + square[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
        kept = np.zeros((len(rows), c), bool)
        for j in range(c):
            blocked = (kept[:, :j] & (between[:, j, :j] <= dist[:, j : j + 1])).any(1)
            kept[:, j] = ~blocked & (kept.sum(1) < degree)
        # then the nearest of the others, until the degree is reached
        rank = np.argsort(~kept, axis=1, kind="stable")[:, :degree]
        own[rows, : rank.shape[1]] = np.take_along_axis(near, rank, 1)
    # links back, the nearest first where there are too many
    a = np.repeat(np.arange(n), degree)
    b = own.ravel()
    a, b = a[b >= 0], b[b >= 0]
    pairs = np.unique(np.concatenate([np.stack([a, b], 1), np.stack([b, a], 1)]), axis=0)
    length = ((x[pairs[:, 0]] - x[pairs[:, 1]]) ** 2).sum(1)
    pairs = pairs[np.lexsort((length, pairs[:, 0]))]
    starts = np.searchsorted(pairs[:, 0], np.arange(n))
    place = np.arange(len(pairs)) - starts[pairs[:, 0]]
    fits = place < 2 * degree
    out[pairs[fits, 0], place[fits]] = pairs[fits, 1]
    return out


def build(ids: np.ndarray, vectors: np.ndarray) -> dict:
    """The graph of one shard. ``vectors`` keep their precision; equal ones share a node."""
    order = np.lexsort((ids, *vectors.T[::-1]))
    ids, vectors = ids[order], vectors[order]
    new = np.concatenate([[True], (vectors[1:] != vectors[:-1]).any(1)])
    heads = np.flatnonzero(new)
    nodes = vectors[heads]
    rng = np.random.default_rng(len(nodes))
    shuffled = rng.permutation(len(nodes))  # a layer is a prefix of the nodes of the layer below
    layers = [np.arange(len(nodes))]
    while len(layers[-1]) > DEGREE:
        layers.append(np.sort(shuffled[: max(1, len(layers[-1]) // DEGREE)]))
    frame = _frame(nodes)
    x = _framed(nodes, frame)
    return {
        "ids": ids,
        "heads": np.append(heads, len(ids)),
        "vectors": nodes,
        "frame": frame,
        "layers": layers,
        "links": [_links(x[layer], DEGREE, CANDIDATES) for layer in layers],
    }


def _beam(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``ef`` nearest nodes of a layer met from the ``entry`` nodes, and their squared distances,
    for all queries in step. Missing ones are -1 at infinity."""
    q, n = len(queries), len(x)
    rows = np.arange(q)
    seen = np.zeros((q, n + 1), bool)  # the last column stands for "none"
    seen[:, n] = True

    def measured(ids: np.ndarray, of: np.ndarray) -> np.ndarray:
        d = ((x[ids] - queries[of][:, None, :]) ** 2).sum(2)
        return np.where(ids < 0, np.inf, d)

    def fresh(ids: np.ndarray, of: np.ndarray) -> np.ndarray:
        """``ids`` without those seen before or twice."""
        ids = np.sort(ids, axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        ids[seen[of[:, None], ids]] = -1
        seen[of[:, None], ids] = True
        return ids

    beam = np.full((q, ef), -1, np.int64)
    far = np.full((q, ef), np.inf)
    done = np.ones((q, ef), bool)

    def merge(of: np.ndarray, ids: np.ndarray) -> None:
        d = np.concatenate([far[of], measured(ids, of)], axis=1)
        order = np.argsort(d, axis=1, kind="stable")[:, :ef]
        beam[of] = np.take_along_axis(np.concatenate([beam[of], ids], axis=1), order, 1)
        done[of] = np.take_along_axis(np.concatenate([done[of], ids < 0], axis=1), order, 1)
        far[of] = np.take_along_axis(d, order, 1)

    merge(rows, fresh(entry.astype(np.int64), rows))
    while len(active := np.flatnonzero((~done).any(1))):
        order = np.argsort(done[active], axis=1, kind="stable")[:, :EXPANDED]  # nearest not expanded
        open_ = ~np.take_along_axis(done[active], order, 1)
        nodes = np.where(open_, np.take_along_axis(beam[active], order, 1), -1)
        done[active[:, None], order] = True
        ids = np.where((nodes >= 0)[:, :, None], links[nodes], -1).reshape(len(active), -1).astype(np.int64)
        merge(active, fresh(ids, active))
    return beam, far


def search(graph: dict, queries: np.ndarray, own: np.ndarray, k: int, ef: int = BEAM) -> tuple[np.ndarray, ...]:
    """(query number, id, distance) of the ``k`` nearest rows found for each query, but for the rows
    that have the query's own id. The beam too measures in double precision, from differences; the
    distances returned are those of the original vectors."""
    x, wanted = (_framed(v, graph["frame"]) for v in (graph["vectors"], queries))
    entry = np.zeros((len(queries), 1), np.int64)
    layers, links = graph["layers"], graph["links"]
    for above in range(len(layers) - 1, 0, -1):
        layer, below = layers[above], layers[above - 1]
        found, _ = _beam(x[layer], links[above], wanted, entry, UPPER_BEAM)
        entry = np.where(found >= 0, np.searchsorted(below, layer[found]), -1)
    found, _ = _beam(x, links[0], wanted, entry, max(ef, k + 1))
    heads = graph["heads"]
    number, ids = [], []
    # of equal rows only the k + 1 with the smallest ids can be among the k nearest
    for i in range(k + 1):
        at = heads[np.where(found >= 0, found, 0)] + i
        ok = (found >= 0) & (at < heads[np.where(found >= 0, found, 0) + 1])
        rows, columns = np.nonzero(ok)
        number.append(np.stack([rows, found[rows, columns]], 1))
        ids.append(graph["ids"][at[rows, columns]])
    number, ids = np.concatenate(number), np.concatenate(ids)
    keep = ids != own[number[:, 0]]
    number, ids = number[keep], ids[keep]
    exact = _measure(graph["vectors"][number[:, 1]], queries[number[:, 0]])
    return _nearest(number[:, 0], ids, exact, k)


def _nearest(query: np.ndarray, ids: np.ndarray, distance: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((ids, distance, query))
    query, ids, distance = query[order], ids[order], distance[order]
    same = np.zeros(len(query), bool)
    same[1:] = (query[1:] == query[:-1]) & (ids[1:] == ids[:-1])
    query, ids, distance = query[~same], ids[~same], distance[~same]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], ids[place < k], distance[place < k]


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part: ids that are not null, vectors that are
    not null, empty or zero and hold neither null nor what is not finite."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    taken = F.col(vec_id).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    return vectors.where(F.coalesce(taken, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding")
    )


def _arrays(column: pa.Array) -> list[np.ndarray]:
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return np.split(flat, (offsets - offsets[0])[1:-1])


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def graphs(ids: list[int], rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(r) for r in rows])
        for dim in np.unique(size):
            of = np.flatnonzero(size == dim)
            graph = build(np.array(ids, np.int64)[of], np.stack([rows[i] for i in of]))
            yield pa.RecordBatch.from_pydict(
                {"dim": pa.array([int(dim)], pa.int32()), "graph": pa.array([pickle.dumps(graph)], pa.binary())}
            )

    ids: list[int] = []
    rows: list[np.ndarray] = []
    for batch in batches:
        ids += batch.column("vec_id").to_pylist()
        rows += _arrays(batch.column("embedding"))
        while len(ids) >= SHARD_ROWS:
            yield from graphs(ids[:SHARD_ROWS], rows[:SHARD_ROWS])
            ids, rows = ids[SHARD_ROWS:], rows[SHARD_ROWS:]
    if ids:
        yield from graphs(ids, rows)


def index(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(dim, graph): one row for each shard, of every row of ``vectors`` that takes part."""
    taking_part = valid(vectors, vec_id, embedding)
    shards = max(1, -(-taking_part.count() // SHARD_ROWS))
    return written(taking_part.repartition(shards).mapInArrow(_built, "dim int, graph binary"), "vector-index")


def _found(block, k: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = pickle.loads(block.value)
        best: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for dim, blob in zip(batch.column("dim").to_pylist(), batch.column("graph"), strict=True):
                if dim not in queries:
                    continue
                graph = pickle.loads(blob.as_buffer())
                own, wanted = queries[dim]
                parts = [best[dim]] if dim in best else []
                for i in range(0, len(own), SEARCHED):
                    q, ids, d = search(graph, wanted[i : i + SEARCHED], own[i : i + SEARCHED], k)
                    parts.append([q + i, ids, d])
                best[dim] = list(_nearest(*[np.concatenate(c) for c in zip(*parts, strict=True)], k))
        for dim, (q, ids, d) in best.items():
            yield pa.RecordBatch.from_pydict(
                {"query_id": pa.array(queries[dim][0][q]), "vec_id": pa.array(ids), "score": pa.array(d)}
            )

    return found


def nearest(queries: DataFrame, graphs: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of the index for each query
    (vec_id, embedding), nearest first, ties to the smaller id. Queries go through the shards in blocks
    of bounded size, each block one pass over the index."""
    spark = queries.sparkSession
    once = written(queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    blocks = max(1, -(-once.count() // QUERY_BLOCK))
    hits = None
    for b in range(blocks):
        rows = once.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        block: dict[int, tuple] = {}
        if rows.num_rows:
            vectors = [v for chunk in rows.column("embedding").chunks for v in _arrays(chunk)]
            ids, size = rows.column("vec_id").to_numpy(), np.array([len(v) for v in vectors])
            for dim in np.unique(size):
                of = np.flatnonzero(size == dim)
                block[int(dim)] = (ids[of], np.stack([vectors[i] for i in of]))
        shared = spark.sparkContext.broadcast(pickle.dumps(block))
        own = graphs.mapInArrow(_found(shared, k), "query_id long, vec_id long, score double")
        hits = own if hits is None else hits.unionAll(own)
    each = hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        each.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def neighbours(
    vectors: DataFrame, every: int = 100, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows found for every row whose id is divisible by ``every``, among all
    other rows.

    Rows with a null id, and vectors that are null, empty, zero or hold null or non-finite components
    take no part. Vectors are compared with those of as many components. Repeated ids are one query
    (of the smallest vector) and are listed once, at their nearest; rows with a query's own id are not
    its neighbours. Other columns are ignored; no rows give no rows.
    """
    graphs = index(vectors, vec_id, embedding)
    return nearest(valid(vectors, vec_id, embedding).where(F.col("vec_id") % every == 0), graphs, k)

"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubweave.llm.common import slices, written


@dataclass(frozen=True)
class Params:
    #: Neighbours given out per query.
    k: int = 20
    #: Links of a node on the upper levels; the lowest has twice as many.
    links: int = 16
    #: Width of the search while a graph is built, and of queries.
    build_width: int = 96
    width: int = 96
    #: Vectors of a shard at most, about, and shards at least. A worker holds one shard: of 64 floats
    #: and their links some 4 MB. Larger shards are fewer searches for every query, but need a wider
    #: search: on 51,282 vectors without structure, a width of 96 finds 0.97 of the
    #: true neighbours in 8 shards, and 0.83 in one.
    shard_rows: int = 1 << 13
    least_shards: int = 8
    #: Queries that meet one copy of a shard's graph in one task.
    task_queries: int = 1 << 18


class Graph:
    """Nodes in the order of their levels, highest first, so each level is a prefix of the nodes.

    ``links[l]`` is a flat table of neighbours by node, filled up with -1. Vectors have one more
    component, which makes all of equal length: then the largest inner product is the
    nearest vector, and the graph's shortcuts are those of a distance.
    """

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: list[np.ndarray] | None = None, m: int = 16):
        self.x, self.levels = vectors, levels
        top = int(levels[0]) if len(levels) else 0
        self.sizes = [int(np.searchsorted(-levels, -level, "right")) for level in range(top + 1)]
        self.links = links or [np.full((n, m * (1 + (level == 0))), -1, np.int32) for level, n in enumerate(self.sizes)]

    def walk(self, q: np.ndarray, starts: np.ndarray, level: int, width: int, known: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """For each query the ``width`` best nodes found on a level, best first, and their products;
        -1 where there are fewer. Goes from ``starts`` along the links of the best nodes that
        aren't gone through, a few for every query at a time. ``known``: nodes there are so far."""
        n, links = len(q), self.links[level]
        seen = np.zeros((n, known + 1), bool)  # the last place takes the -1 of missing neighbours
        seen[:, known] = True
        ids, score = self._new(q, starts, seen, np.arange(n))
        done = ids < 0
        while True:
            keep = np.argsort(-score, axis=1, kind="stable")[:, :width]
            ids, score, done = (np.take_along_axis(a, keep, 1) for a in (ids, score, done))
            pick = np.argsort(done, axis=1, kind="stable")[:, :at_once]  # best first, as rows are in order
            open_ = ~np.take_along_axis(done, pick, 1)
            going = np.flatnonzero(open_.any(1))
            if not len(going):
                return ids, score
            near = np.where(open_, np.take_along_axis(ids, pick, 1), 0)[going]
            np.put_along_axis(done, pick, True, 1)
            found = np.where(open_[going][:, :, None], links[near], -1).reshape(len(going), -1)
            more, value = np.full((n, found.shape[1]), -1, np.int64), np.full((n, found.shape[1]), -np.inf, np.float32)
            more[going], value[going] = self._new(q[going], found, seen, going)
            ids, score, done = np.hstack([ids, more]), np.hstack([score, value]), np.hstack([done, more < 0])

    def _new(self, q: np.ndarray, found: np.ndarray, seen: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the nodes found those not seen yet, once each, with their products; marks them."""
        found, rows = np.sort(found, axis=1).astype(np.int64), rows[:, None]
        found = np.where(seen[rows, found], -1, found)  # -1 is the last place of seen
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        seen[rows, found] = True
        score = np.einsum("nkd,nd->nk", self.x[found], q, optimize=True)
        return found, np.where(found < 0, -np.inf, score).astype(np.float32)

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best nodes for each query, over all levels."""
        n = len(self.x)
        if n <= width:
            score = q @ self.x.T
            ids = np.argsort(-score, axis=1, kind="stable")
            return ids, np.take_along_axis(score, ids, 1)
        starts = np.zeros((len(q), 1), np.int64)
        for level in range(len(self.sizes) - 1, 0, -1):
            starts = self.walk(q, starts, level, 8, self.sizes[level], 1)[0]
        return self.walk(q, starts, 0, width, n)

    def choose(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray, m: int) -> np.ndarray:
        """Of candidates, best first, m that are nearer to q than to any chosen before; the best of the rest fill up."""
        n, width = ids.shape
        v = self.x[ids]
        between = v @ v.transpose(0, 2, 1)
        chosen = np.zeros((n, width), bool)
        for k in range(width):
            close = np.where(chosen, between[:, :, k], -np.inf).max(1)
            chosen[:, k] = (ids[:, k] >= 0) & (score[:, k] > close) & (chosen.sum(1) < m)
        rank = np.where(chosen, 0, np.where(ids >= 0, 1, 2))
        order = np.argsort(rank, axis=1, kind="stable")[:, :m]
        out = np.take_along_axis(ids, order, 1)
        if out.shape[1] < m:
            out = np.hstack([out, np.full((n, m - out.shape[1]), -1, out.dtype)])
        return out

    def _link_back(self, level: int, new: np.ndarray, chosen: np.ndarray) -> None:
        """Chosen nodes link back to the new ones; a full node chooses anew among its own and those."""
        links = self.links[level]
        m = links.shape[1]
        a, b = np.repeat(new, chosen.shape[1]), chosen.ravel()
        a, b = a[b >= 0], b[b >= 0]
        order = np.argsort(b, kind="stable")
        a, b = a[order], b[order]
        nodes, first, counts = np.unique(b, return_index=True, return_counts=True)
        for k in range(0, len(nodes), 512):
            own, c = nodes[k : k + 512], counts[k : k + 512]
            place = np.arange(c.max())[None, :]
            src = np.minimum(first[k : k + 512][:, None] + place, len(a) - 1)
            all_ = np.hstack([links[own], np.where(place < c[:, None], a[src], -1)]).astype(np.int64)
            n_all = (all_ >= 0).sum(1)
            few = n_all <= m
            links[own[few]] = -np.sort(-all_[few], axis=1)[:, :m]
            if (~few).any():
                ids, q = all_[~few], self.x[own[~few]]
                score = np.where(ids < 0, -np.inf, np.einsum("nkd,nd->nk", self.x[ids], q, optimize=True))
                order = np.argsort(-score, axis=1, kind="stable")
                links[own[~few]] = self.choose(q, np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1), m)

    @classmethod
    def build(cls, vectors: np.ndarray, levels: np.ndarray, params: Params) -> Graph:
        """Inserts the nodes in order, in batches that grow with the graph: a batch's nodes are looked
        for in the graph so far and among themselves."""
        g = cls(vectors, levels, m=params.links)
        n, at = len(vectors), 1
        while at < n:
            size = min(n - at, max(1, at // 2), 256)
            new = np.arange(at, at + size)
            q = vectors[new]
            mates = q @ q.T
            mates[np.triu_indices(size)] = -np.inf  # a node sees those of its batch before it
            starts = np.zeros((size, 1), np.int64)
            for level in range(len(g.sizes) - 1, -1, -1):
                known = min(at, g.sizes[level])
                mine = np.flatnonzero(new < g.sizes[level])
                if known:
                    ids, score = g.walk(q, starts, level, params.build_width if len(mine) else 8, known)
                    starts = ids[:, :8]
                if not len(mine):
                    continue
                ids, score = ids[mine], score[mine]
                near = np.argsort(-mates[mine], axis=1, kind="stable")[:, : min(size, params.build_width)]
                ids = np.hstack([ids, new[near]])
                score = np.hstack([score, np.take_along_axis(mates[mine], near, 1)])
                ids = np.where(np.isfinite(score), ids, -1)
                order = np.argsort(-score, axis=1, kind="stable")[:, : params.build_width]
                chosen = g.choose(q[mine], np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1), params.links)
                g.links[level][new[mine], : params.links] = chosen
                g._link_back(level, new[mine], chosen)
            at += size
        return g


_KEY = "dim int, shard int"
_NODE = "node int, level int, ids array<long>, vector array<float>, longest double"


def _lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of one length: a component more holds what is missing to the longest."""
    x = x.astype(np.float64) / longest
    return np.column_stack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))]).astype(np.float32)


def _matrix(lists: pa.Array, kind: str) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(lists), -1)


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(dim, id, vector) of the rows that take part."""
    usable = F.exists("v", lambda x: x != 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<float>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(usable, F.lit(False)))
    return rows.select(F.size("v").alias("dim"), "id", F.transform("v", lambda x: x + F.lit(0).cast("float")).alias("vector"))  # one zero


def distinct_vectors(df: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """(dim, vector, ids): each different vector that takes part, with its k + 1 smallest ids. Copies
    of a vector tie, and ties go to smaller ids, so no other copy can be among the k nearest of
    anything. A task gives out as many copies of a vector at most."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    rows = usable_vectors(df, id_col, vector_col).groupBy("dim", "vector", "id").agg(F.count(F.lit(1)).alias("_n"))
    near = rows.withColumn("_p", place).filter(F.col("_p") <= k + 1)
    return near.groupBy("dim", "vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def build_index(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", params: Params | None = None) -> DataFrame:
    """The graphs, a row per different vector: (dim, shard, node, level, ids, vector, longest, shards, links).

    Vectors are dealt to shards by hash; vectors of different lengths never meet. A node's links
    are one flat array, level by level, and the table is written to the shared folder.
    """
    params = params or Params()
    vectors = written(distinct_vectors(df, id_col, vector_col, params.k), "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    sizes = vectors.groupBy("dim").agg(F.greatest(F.lit(params.least_shards), F.ceil(F.count(F.lit(1)) / params.shard_rows)).cast("int").alias("shards"), F.max(norm).alias("longest"))
    h = F.xxhash64("vector")
    # a node goes up a level with a chance of one in ``links``, by its hash
    level = F.floor(-F.log((F.pmod(F.shiftright(h, 20), F.lit(1 << 30)) + 1) / float(1 << 30)) / float(np.log(params.links))).cast("int")
    dealt = vectors.join(sizes, "dim").select("dim", F.pmod(h, F.col("shards")).cast("int").alias("shard"), "shards", level.alias("level"), "ids", "vector", "longest")

    def build(table: pa.Table) -> pa.Table:
        level = table["level"].to_numpy()
        first = np.array([r[0] for r in table["ids"].to_pylist()])
        order = np.lexsort((first, -level))
        table = table.take(pa.array(order))
        level = level[order]
        g = Graph.build(_lengthened(_matrix(table["vector"], "f4"), table["longest"][0].as_py()), level, params)
        flat = [np.concatenate([g.links[at][k] for at in range(int(up) + 1)]) for k, up in enumerate(level)]
        table = table.append_column("node", pa.array(np.arange(len(level)), pa.int32()))
        return table.append_column("links", pa.array(flat, pa.list_(pa.int32()))).select(["dim", "shard", "shards", "node", "level", "ids", "vector", "longest", "links"])

    # a shard to a task: a small table's shards would else be put together, and building one takes long
    n = max(1, sizes.agg(F.sum("shards")).first()[0] or 0)
    made = dealt.repartition(n, "dim", "shard").groupBy("dim", "shard").applyInArrow(build, f"{_KEY}, shards int, {_NODE}, links array<int>")
    return written(made, "graphs")


def _searching(params: Params):
    """Rows of a shard's graph, then its queries, over batch borders."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, graph, ids, vectors, longest = None, [], None, None, None, 1.0

        def opened() -> None:
            nonlocal graph, ids, vectors, longest, held
            if graph is None and held:
                t = pa.Table.from_batches(held)
                held, longest = [], t["longest"][0].as_py()
                levels, vectors, ids = t["level"].to_numpy(), _matrix(t["vector"], "f4"), t["ids"].to_pylist()
                m, flat = params.links, t["links"].combine_chunks()
                values, ends = flat.flatten().to_numpy(), np.r_[0, np.cumsum((levels.astype(np.int64) + 2) * params.links)]
                links = []
                for at in range(int(levels[0]) + 1):
                    start = ends[:-1][levels >= at] + (0 if at == 0 else (at + 1) * m)
                    links.append(values[start[:, None] + np.arange(m * (1 + (at == 0)))])
                graph = Graph(_lengthened(vectors, longest), levels, links)

        for batch in slices(batches, 4096):
            t = pa.Table.from_batches([batch])
            keys = np.column_stack([t[c].to_numpy() for c in ("dim", "shard", "part")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for a, b in zip(np.r_[0, cuts].tolist(), [*cuts.tolist(), len(keys)], strict=True):
                if a == b:
                    continue
                if key != tuple(keys[a]):
                    key, held, graph, ids, vectors = tuple(keys[a]), [], None, None, None
                own = t.slice(a, b - a)
                query = own["is_query"].to_numpy(zero_copy_only=False)
                n_nodes = int((~query).sum())  # nodes come first
                held += own.slice(0, n_nodes).to_batches()
                rest = own.slice(n_nodes)
                opened() if len(rest) else None
                for k in range(0, len(rest) if graph is not None else 0, 256):
                    yield answers(rest.slice(k, 256), graph, ids, vectors, longest)

    def answers(queries: pa.Table, graph: Graph, ids: list, vectors: np.ndarray, longest: float) -> pa.RecordBatch:
        q = _matrix(queries["vector"], "f4")
        own_ids = [r[0] for r in queries["ids"].to_pylist()]
        width = max(params.width, params.k + 1)
        found, score = graph.search(np.column_stack([q / np.float32(longest), np.zeros(len(q), np.float32)]).astype(np.float32), width)
        few = np.isfinite(score).sum(1) < min(params.k + 1, len(vectors))
        near, product = [], []
        for k in range(len(q)):
            at = np.arange(len(vectors)) if few[k] else found[k][found[k] >= 0]  # all, where the graph leads to too few
            value = np.zeros(len(at))
            for d in range(q.shape[1]):  # added up in the order of the components, in double precision
                value += vectors[at, d].astype(np.float64) * float(q[k, d])
            best = np.argsort(-value, kind="stable")
            if len(best) > params.k + 1:
                best = best[value[best] >= value[best[params.k]]]
            pairs = sorted((-value[j], i) for j in best.tolist() for i in ids[at[j]] if i != own_ids[k])[: params.k]
            near.append([i for _, i in pairs])
            product.append([-v for v, _ in pairs])
        return pa.record_batch([pa.array(own_ids, pa.int64()), queries["vkey"].combine_chunks(), pa.array(near, pa.list_(pa.int64())), pa.array(product, pa.list_(pa.float64()))], ["query_id", "vkey", "near", "product"])

    return search


def search_index(index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", params: Params | None = None) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k nearest that the shards have found, by
    inner product in double precision, ties to smaller ids, itself left out.

    Every query goes through every shard's graph; a shard keeps k results a query, and the merge keeps
    k of those. A task reads one shard's graph and then streams its queries, 256 at a time; beyond
    ``task_queries`` a shard's queries are dealt to several tasks with a copy of the graph each.
    """
    params = params or Params()
    asked = written(usable_vectors(queries, id_col, vector_col).distinct(), "vector-queries")
    shards = index.select("dim", "shards").distinct()
    parts = max(1, -(-asked.count() // params.task_queries))
    n = max(1, (shards.agg(F.sum("shards")).first()[0] or 0) * parts)
    none = lambda kind: F.lit(None).cast(kind)
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    nodes = index.select("dim", "shard", every.alias("part"), F.lit(False).alias("is_query"), "node", "level", "ids", "vector", none("long").alias("vkey"), "longest", "links")
    asking = asked.join(shards, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int").alias("part"), F.lit(True).alias("is_query"),
        none("int").alias("node"), none("int").alias("level"), F.array("id").alias("ids"), "vector", F.xxhash64("vector").alias("vkey"), none("double").alias("longest"), none("array<int>").alias("links"),
    )
    met = nodes.unionByName(asking).repartition(n, "dim", "shard", "part").sortWithinPartitions("dim", "shard", "part", "is_query", "node")
    found = met.mapInArrow(_searching(params), "query_id long, vkey long, near array<long>, product array<double>")
    best = found.select("query_id", "vkey", F.explode(F.arrays_zip("near", "product")).alias("x")).select("query_id", "vkey", F.col("x.near").alias("vec_id"), F.col("x.product").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id", "vkey").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= params.k).select("query_id", "rank", "vec_id", "score")


def nearest(queries: DataFrame, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", params: Params | None = None) -> DataFrame:
    """For each query row its k nearest of ``vectors`` by inner product: (query_id, rank, vec_id, score).

    Vectors that are null or zero, or hold a null or non-finite component, take no part, on
    either side, nor do rows without id. Vectors of different lengths never meet. Repeated rows
    count once; an id with several vectors asks with each. Candidates are all rows but those of the
    query's own id; where there are fewer than k, all come. An empty table gives no rows. Other
    columns are left aside, whatever their names.
    """
    params = params or Params()
    index = build_index(vectors, id_col, vector_col, params)
    return search_index(index, queries, id_col, vector_col, params)

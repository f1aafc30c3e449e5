"""Near duplicates among embeddings with a navigable small-world graph per shard."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundings.llm.common import components, staged


#: Ids remembered per query of a search: its memory is the same for shards of any size.
_SLOTS = 8192


def _among(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """For every number of a row of `ids`, whether the same row of `known` has it."""
    order = np.sort(known, axis=1)
    row = np.arange(len(ids))[:, None]
    span = max(int(ids.max(initial=0)), int(order.max(initial=0))) + 2
    flat = (order + row * span).ravel()
    wanted = ids + row * span
    at = np.minimum(np.searchsorted(flat, wanted), len(flat) - 1)
    return flat[at] == wanted


class SmallWorld:
    """A hierarchical navigable small-world graph over unit vectors.

    Points join in batches: each batch searches the graph of the points before it, and its points
    are compared with each other, for candidates; neighbours are chosen so that none is nearer to
    another one chosen than to the point itself, which keeps clusters connected.
    """

    def __init__(self, points: np.ndarray, links: int = 12, beam: int = 48, seed: int = 3) -> None:
        self.points = points
        self.links = links
        levels = np.random.default_rng(seed).exponential(1 / math.log(links), len(points))
        self.level = levels.astype(int)
        order = np.argsort(-self.level, kind="stable")
        self.layers: list[np.ndarray] = []
        for layer in range(int(self.level.max()), -1, -1) if len(points) else ():
            members = order[: int((self.level >= layer).sum())]
            self.layers.insert(0, self._layer(members, beam))

    def _layer(self, members: np.ndarray, beam: int) -> np.ndarray:
        """Neighbours within the layer, -1 where there are fewer."""
        width = 2 * self.links
        graph = np.full((len(self.points), width), -1, np.int64)
        done = 0
        while done < len(members):
            batch = members[done : done + max(32, min(512, done))]
            near = self.points[batch] @ self.points[batch].T
            np.fill_diagonal(near, -2)
            before = members[:done]
            found = self._search(graph, self.points[batch], before[:1], beam)[0] if done else None
            for i, point in enumerate(batch):
                own = np.argsort(-near[i, :i])[: self.links]
                candidates = batch[own]
                if found is not None:
                    candidates = np.concatenate([candidates, found[i][found[i] >= 0]])
                chosen = self._spread(point, candidates, self.links)
                graph[point, : len(chosen)] = chosen
                for other in chosen:
                    free = np.flatnonzero(graph[other] < 0)
                    if len(free):
                        graph[other, free[0]] = point
                    else:
                        kept = self._spread(
                            other, np.append(graph[other], point), width - self.links // 2
                        )
                        graph[other] = -1
                        graph[other, : len(kept)] = kept
            done += len(batch)
        return graph

    def _spread(self, point: int, candidates: np.ndarray, most: int) -> np.ndarray:
        candidates = np.unique(candidates)
        to_point = self.points[candidates] @ self.points[point]
        order = np.argsort(-to_point, kind="stable")
        candidates, to_point = candidates[order], to_point[order]
        between = self.points[candidates] @ self.points[candidates].T
        open_ = np.ones(len(candidates), bool)
        chosen: list[int] = []
        for i in range(len(candidates)):
            if open_[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                open_ &= between[i] <= to_point
        if len(chosen) < most:
            rest = np.setdiff1d(np.arange(len(candidates)), chosen)[: (most - len(chosen)) // 2]
            chosen += rest.tolist()
        return candidates[chosen]

    def _search(
        self, graph: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the `beam` nearest points found for each query at once."""
        n = len(queries)
        ids = np.full((n, beam), -1, np.int64)
        near = np.full((n, beam), -np.inf, np.float32)
        # What each query met last, by a slot of the id: which of the ids that share it, from 1. A point
        # met again after its slot was taken is compared again; one still in the beam is left out
        # below. In numbers as short as can be, so that it stays near the processor.
        slots = min(_SLOTS, len(self.points))
        seen = np.zeros((n, slots), np.min_scalar_type(len(self.points) // slots + 1))
        fresh = np.zeros((n, beam), bool)
        entry = entry.reshape(1, -1).repeat(n, 0) if entry.ndim == 1 else entry
        rows = np.arange(n)
        ids[:, : entry.shape[1]] = entry
        near[:, : entry.shape[1]] = np.einsum("nkd,nd->nk", self.points[entry], queries)
        fresh[:, : entry.shape[1]] = True
        seen[rows[:, None], entry % slots] = entry // slots + 1
        steps = min(beam, 4)
        while len(rows):
            mine = np.where(fresh[rows], near[rows], -np.inf)
            best = np.argpartition(-mine, steps - 1, axis=1)[:, :steps]
            usable = np.take_along_axis(mine, best, 1) > -np.inf
            alive = usable.any(1)
            rows, best, usable = rows[alive], best[alive], usable[alive]
            if not len(rows):
                break
            fresh[rows[:, None], best] = False
            next_ = graph[np.where(usable, ids[rows[:, None], best], 0)]
            next_ = np.where(usable[:, :, None], next_, -1).reshape(len(rows), -1)
            next_.sort(axis=1)
            valid = next_ >= 0
            valid[:, 1:] &= next_[:, 1:] != next_[:, :-1]
            turn, slot = np.divmod(np.maximum(next_, 0), slots)
            valid &= seen[rows[:, None], slot] != turn + 1
            if slots < len(self.points):
                valid &= ~_among(next_, ids[rows])
            at, where = np.nonzero(valid)
            targets = next_[at, where]
            seen[rows[at], slot[at, where]] = turn[at, where] + 1
            similar = np.full(next_.shape, -np.inf, np.float32)
            similar[at, where] = np.einsum(
                "kd,kd->k", self.points[targets], queries[rows[at]], optimize=True
            )
            all_near = np.concatenate([near[rows], similar], 1)
            all_ids = np.concatenate([ids[rows], next_], 1)
            all_fresh = np.concatenate([fresh[rows], valid], 1)
            top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
            near[rows] = np.take_along_axis(all_near, top, 1)
            ids[rows] = np.where(near[rows] > -np.inf, np.take_along_axis(all_ids, top, 1), -1)
            fresh[rows] = np.take_along_axis(all_fresh, top, 1) & (near[rows] > -np.inf)
        return ids, near

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Descends the layers greedily and searches the lowest with the whole beam."""
        top = np.flatnonzero(self.level == self.level.max())[:1]
        entry = np.repeat(top.reshape(1, 1), len(queries), 0)
        for graph in self.layers[:0:-1]:
            found = self._search(graph, queries, entry, 4)
            entry = np.take_along_axis(found[0], found[1].argmax(1)[:, None], 1)
        return self._search(self.layers[0], queries, entry, min(beam, max(1, len(self.points))))

    def within(
        self, queries: np.ndarray, least: float, beam: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """(query, point) places of similarity `least` and more; beams full of them widen."""
        found = []
        pending = np.arange(len(queries))
        while len(pending):
            again = []
            step = max(16, min(512, 4_000_000 // (_SLOTS + 40 * beam)))
            for at in range(0, len(pending), step):
                own = pending[at : at + step]
                ids, near = self.search(queries[own], beam)
                full = (near >= least).all(1) & (beam < len(self.points))
                again.append(own[full])
                hit = (near >= least) & ~full[:, None]
                found.append((np.repeat(own, hit.sum(1)), ids[hit]))
            pending = np.concatenate(again) if again else pending[:0]
            beam *= 4
        return found


def _audited(
    graph: SmallWorld,
    queries: np.ndarray,
    own: np.ndarray,
    least: float,
    beam: int,
    audit: int,
    recall: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Searches with wider beams until a sample compared with every point reaches `recall`.

    `own` is the place of each query among the points, -1 where it is none of them: that a query
    finds itself counts for nothing. Half of the sample is spread over the queries, half over
    those that found another point, so that links are measured wherever there are some.
    """
    sample = true = None
    while True:
        pairs = graph.within(queries, least, beam)
        asked = np.concatenate([p[0] for p in pairs])
        reached = np.concatenate([p[1] for p in pairs])
        others = reached != own[asked]
        asked, reached = asked[others], reached[others]
        if sample is None:
            linked = np.unique(asked)
            sample = np.union1d(
                _spread_over(np.arange(len(queries)), audit // 2), _spread_over(linked, audit // 2)
            )
            true = queries[sample] @ graph.points.T >= least
            member = np.flatnonzero(own[sample] >= 0)
            true[member, own[sample[member]]] = False
        known = np.isin(asked, sample)
        hits = np.zeros_like(true)
        hits[np.searchsorted(sample, asked[known]), reached[known]] = True
        if (hits & true).sum() >= recall * true.sum() or beam >= len(graph.points):
            return asked, reached
        beam *= 2


def _spread_over(places: np.ndarray, most: int) -> np.ndarray:
    if len(places) <= most:
        return places
    return places[np.linspace(0, len(places) - 1, most).astype(int)]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest number near one."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = _scaled(a), _scaled(b)
    return np.einsum("nd,nd->n", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = _scaled(vectors)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def embedding_links(
    vectors: DataFrame,
    threshold: float = 0.9,
    shards: int = 8,
    block: int = 8192,
    beam: int = 32,
    audit: int = 128,
    recall: float = 0.99,
) -> DataFrame:
    """Every vector with the number of others within `threshold` by cosine, and its component.

    Equal vectors form one class. The classes are dealt to `shards`; each shard builds a graph,
    which is stored, and every class queries the graph of every shard, in blocks of about `block`
    queries. A beam that holds nothing but links widens, and so does every beam of a block until
    `audit` of its queries, compared with the whole shard, reach `recall` of their links to other
    vectors; where these have none, nothing was measured. Pairs are verified in double precision,
    whatever the magnitude of the numbers. A task returns counts and a spanning forest, never a list of pairs.

    Returns vec_id, n_links, component_id (smallest vec_id reachable) and kept. Vectors that are
    null, empty or zero, or hold a null or a number that is not finite, link with nothing; vectors
    of different lengths do not link. Repeated vec_ids share an id, not their links, and null ones
    stay null. An empty table gives no rows.
    """
    values = F.col("embedding").cast("array<double>")
    sound = F.coalesce(
        (F.size(values) > 0)
        & F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(values, lambda v: v != 0),
        F.lit(False),
    )
    rows = staged(
        vectors.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(sound, values).alias("vector"),
        ),
        "vectors",
    )
    key = [F.xxhash64(F.lit(s), "vector") for s in (1, 2)]
    classes = staged(
        rows.filter("vector is not null")
        .groupBy("vector")
        .agg(F.min("row").alias("node"), F.count("*").alias("copies"))
        .select(
            "node", "copies", "vector", F.size("vector").alias("width"),
            F.pmod(key[0], F.lit(shards)).alias("shard"), key[1].alias("deal"),
        ),
        "vector-classes",
    )
    kind = "width int, shard long, node long, copies long, vector array<double>, level int"
    graphs = staged(
        classes.drop("deal")
        .groupBy("width", "shard")
        .applyInPandas(_built, kind + ", links array<long>"),
        "graphs",
    )
    blocks = max(1, math.ceil(classes.count() / block))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asked = classes.select(
        "width", every(shards).alias("shard"), F.pmod("deal", F.lit(blocks)).alias("block"),
        "node", "copies", "vector",
    )
    held = graphs.withColumn("block", every(blocks))
    keys = ["width", "shard", "block"]
    compare = _comparison(threshold, beam, audit, recall)
    links = staged(
        asked.groupBy(*keys)
        .cogroup(held.groupBy(*keys))
        .applyInPandas(compare, "node long, links long, tied long"),
        "vector-links",
    )
    roots = components(
        links.filter("tied is not null").select(F.col("node").alias("a"), F.col("tied").alias("b"))
    )
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.join(counts, "node", "left").join(roots, "node", "left").select(
        "vector",
        F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    told = staged(rows.join(known, "vector", "left").drop("vector"), "vector-told")
    least = told.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return told.join(least, "root", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("root").isNull(), F.col("vec_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    """The graph of a shard, a row a point: its level, and its neighbours layer by layer."""
    rows = rows.sort_values("node").reset_index(drop=True)
    graph = SmallWorld(_unit(np.array(rows["vector"].tolist())))
    links = [
        np.concatenate([layer[i] for layer in graph.layers[: graph.level[i] + 1]])
        for i in range(len(rows))
    ]
    return rows.assign(level=graph.level, links=links)[
        ["width", "shard", "node", "copies", "vector", "level", "links"]
    ]


def _restored(rows: pd.DataFrame, points: np.ndarray) -> SmallWorld:
    graph = SmallWorld(points[:0])
    graph.points, graph.level = points, rows["level"].to_numpy()
    width = 2 * graph.links
    graph.layers = []
    # A row has its layers one after another; they are looked up all at once.
    stored = np.concatenate(rows["links"].tolist()).reshape(-1, width)
    first = np.cumsum(graph.level + 1) - graph.level - 1
    for layer in range(int(graph.level.max()) + 1):
        links = np.full((len(points), width), -1, np.int64)
        member = np.flatnonzero(graph.level >= layer)
        links[member] = stored[first[member] + layer]
        graph.layers.append(links)
    return graph


def _comparison(threshold: float, beam: int, audit: int, recall: float) -> Callable:
    def compared(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        columns = ["node", "links", "tied"]
        if not len(asked) or not len(held):
            return pd.DataFrame({c: pd.Series([], dtype="Int64") for c in columns})
        held = held.sort_values("node").reset_index(drop=True)
        points, queries = (np.array(t["vector"].tolist()) for t in (held, asked))
        graph = _restored(held, _unit(points))
        from_, to = asked["node"].to_numpy(), held["node"].to_numpy()
        own = np.minimum(np.searchsorted(to, from_), len(to) - 1)
        own = np.where(to[own] == from_, own, -1)
        a, b = _audited(graph, _unit(queries), own, threshold - 1e-4, beam, audit, recall)
        close = np.ones(len(a), bool)
        for at in range(0, len(a), 100_000):
            part = slice(at, at + 100_000)
            close[part] &= _cosine(queries[a[part]], points[b[part]]) >= threshold
        a, b = a[close], b[close]
        counts = np.bincount(a, held["copies"].to_numpy()[b], len(asked)).astype(np.int64)
        tied = _forest(from_[a], to[b])
        table = pd.DataFrame({"node": from_, "links": counts}).query("links > 0")
        ties = pd.DataFrame({"node": list(tied), "tied": list(tied.values())}, dtype="Int64")
        found = table.merge(ties, "outer", on="node")
        return found.astype({"links": "Int64", "tied": "Int64", "node": "Int64"}).fillna(
            {"links": 0}
        )[columns]

    return compared


def _forest(a: np.ndarray, b: np.ndarray) -> dict[int, int]:
    """Each linked node with the smallest one it is joined to by the pairs."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        low, high = sorted((root(x), root(y)))
        parent[high] = low
    return {x: root(x) for x in list(parent)}

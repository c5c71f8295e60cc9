"""Operator 4: embedding near-dedup by navigable small-world graphs.

Equal vectors are one node.  Nodes are dealt over shards of bounded size; each
shard builds a hierarchical small-world graph.  Every node queries its own shard
and all later ones (a pair needs one direction only), in blocks, with a beam that
is widened for queries that find links, and for all of a block until an audit of
a sample against the whole shard finds at least ``RECALL`` of the links, and
until vectors planted just within the limit are found again, so recall is measured in each
block also where links are rare (the figure is logged); a beam as wide as the shard is the
whole shard.  What is found is
verified by cosine in double precision.

A block sends on sums of links for each node and a forest of its links, so the
output grows with the nodes and not with the pairs; components are united by
distributed rounds.

Defined results: a vector that is null, empty, zero, or holds a null or
non-finite component links with nothing and is its own component; vectors of
different lengths link with nothing of each other; repeated rows are kept and
link with each other; rows of a null vec_id are kept, and name a component only
if it has no other id; labels and other extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import cut, small_batches
from pitchlake.llm.components import components

COSINE, RECALL = 0.95, 0.999
#: Shards at least; bytes of the vectors of one; queries of a block from one shard.
SHARDS, SHARD_BYTES, BLOCK_ROWS = 6, 64 << 20, 12_000
LINKS, BEAM, WIDEST, SPARE, AUDIT, LANES = 12, 32, 128, 16, 512, 256
#: Vectors of a shard that are moved to cosines just above the limit and must be found again
#: from there, and the share of their links that must be.
PLANTED, PLANTED_RECALL = 128, 0.99


class SmallWorld:
    """A hierarchical navigable small-world graph over unit vectors, built and
    queried in batches: all queries of a batch take a step of their beams at once."""

    def __init__(self, unit: np.ndarray, links: int = LINKS, beam: int = BEAM, seed: int = 4):
        self.x = np.ascontiguousarray(unit, np.float32)
        n = len(self.x)
        make = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(1 - make.random(n)) / np.log(links)).astype(int), 8)
        order = make.permutation(n)
        top = int(self.level.max(initial=0))
        self.start = int(order[np.argmax(self.level[order] == top)]) if n else -1
        # The start comes first, so that all upper layers hang together.
        order = np.r_[self.start, order[order != self.start]] if n else order
        self.near = [np.full((n, 2 * links if k == 0 else links), -1, np.int32) for k in range(top + 1)]
        done = 1
        while done < n:
            batch = order[done : done + min(LANES, max(1, done))]
            self._insert(batch, beam)
            done += len(batch)
        # Nodes that a beam does not lead to are held against every query instead.
        lost = [b[~(self.query(self.x[b], BEAM)[0] == b[:, None]).any(axis=1)] for b in np.array_split(np.arange(n), max(1, n // LANES))] if n else []
        self.islands = np.concatenate(lost) if lost else np.zeros(0, np.int64)

    def _insert(self, batch: np.ndarray, beam: int) -> None:
        q = self.x[batch]
        at = np.full(len(batch), self.start)
        own = q @ q.T
        for layer in range(len(self.near) - 1, -1, -1):
            enter = self.level[batch] >= layer
            ids, sims = self.search(q, at, layer, beam if enter.any() else 1)
            at = ids[:, 0]
            if not enter.any():
                continue
            mine = batch[enter]
            # Those of the same batch are not in the graph yet and are compared at once.
            k = min(beam, len(mine))
            among = own[np.ix_(enter, enter)].copy()
            np.fill_diagonal(among, -9)
            best = np.argpartition(-among, k - 1, axis=1)[:, :k]
            got = np.hstack([ids[enter], mine[best]])
            near = np.hstack([sims[enter], np.take_along_axis(among, best, 1)])
            got[near <= -2] = -1
            width = self.near[layer].shape[1]
            chosen = self._spread(got, near, width // 2 if layer == 0 else width)
            self.near[layer][mine, : chosen.shape[1]] = chosen
            self._answer(mine, chosen, layer)

    def _answer(self, new: np.ndarray, chosen: np.ndarray, layer: int) -> None:
        """Links back from the chosen to the new, each list kept spread out."""
        table, width = self.near[layer], self.near[layer].shape[1]
        back = np.repeat(new, chosen.shape[1]), chosen.ravel()
        ok = back[1] >= 0
        src, dst = back[0][ok], back[1][ok]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        nodes, first, many = np.unique(dst, return_index=True, return_counts=True)
        rank = np.arange(len(dst)) - np.repeat(first, many)
        for part in range(0, int(rank.max(initial=-1)) + 1, width):
            use = (rank >= part) & (rank < part + width)
            incoming = np.full((len(nodes), width), -1, np.int64)
            incoming[np.searchsorted(nodes, dst[use]), rank[use] - part] = src[use]
            hit = (incoming >= 0).any(axis=1)
            some, pool = nodes[hit], np.hstack([table[nodes[hit]], incoming[hit]])
            for k in range(0, len(some), 2048):
                p = pool[k : k + 2048]
                sims = np.einsum("bkd,bd->bk", self.x[p], self.x[some[k : k + 2048]])
                sims[p < 0] = -9
                table[some[k : k + 2048]] = self._spread(p, sims, width)

    def _spread(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of each row the nearest ids that are nearer to the row's node than to
        any id taken before; free places go to the nearest of the others."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        x = self.x[ids]
        between = np.matmul(x, x.transpose(0, 2, 1))
        taken = np.zeros(ids.shape, bool)
        for j in range(ids.shape[1]):
            blocked = ((between[:, :j, j] > sims[:, j, None]) & taken[:, :j]).any(axis=1) if j else False
            twice = (ids[:, :j] == ids[:, j, None]).any(axis=1) if j else False
            taken[:, j] = (ids[:, j] >= 0) & ~np.asarray(blocked) & ~np.asarray(twice) & (taken.sum(axis=1) < most)
        twice = np.zeros(ids.shape, bool)
        for j in range(1, ids.shape[1]):
            twice[:, j] = (ids[:, :j] == ids[:, j, None]).any(axis=1)
        rank = np.where(taken, 0, np.where((ids >= 0) & ~twice, 1, 2))
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(ids, order, 1)
        out[np.take_along_axis(rank, order, 1) == 2] = -1
        return out

    def search(self, q: np.ndarray, at: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam's ids and similarities for each query, best first; -1 and -9
        fill places that are empty."""
        lanes, table = len(q), self.near[layer]
        rows = np.arange(lanes)
        seen = np.zeros((lanes, len(self.x)), bool)
        seen[rows, at] = True
        ids = np.full((lanes, beam), -1, np.int64)
        sims = np.full((lanes, beam), -9.0, np.float32)
        ids[:, 0], sims[:, 0] = at, np.einsum("bd,bd->b", self.x[at], q)
        fresh = np.zeros((lanes, beam), bool)
        fresh[:, 0] = True
        live = rows
        while len(live):
            pick = np.argmax(np.where(fresh[live], sims[live], -8), axis=1)
            go = fresh[live, pick]
            live, pick = live[go], pick[go]
            if not len(live):
                break
            fresh[live, pick] = False
            near = table[ids[live, pick]]
            new = (near >= 0) & ~seen[live[:, None], near]
            seen[live[:, None], np.where(near >= 0, near, at[live, None])] = True
            s = np.einsum("bkd,bd->bk", self.x[near], q[live])
            s[~new] = -9
            all_s = np.hstack([sims[live], s])
            keep = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam] if beam < all_s.shape[1] else np.argsort(-all_s, axis=1)
            sims[live] = np.take_along_axis(all_s, keep, 1)
            ids[live] = np.take_along_axis(np.hstack([ids[live], np.where(new, near, -1)]), keep, 1)
            fresh[live] = np.take_along_axis(np.hstack([fresh[live], new]), keep, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def query(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.full(len(q), self.start)
        for layer in range(len(self.near) - 1, 0, -1):
            at = self.search(q, at, layer, 1)[0][:, 0]
        return self.search(q, at, 0, beam)

    def planted(self, least: float) -> np.ndarray:
        """Some of the graph's vectors, each turned in a direction of its own to a
        cosine between ``least`` and a little more."""
        make = np.random.default_rng(len(self.x))
        x = self.x[np.unique(np.linspace(0, len(self.x) - 1, min(PLANTED, len(self.x))).astype(int))].astype(np.float64)
        turn = make.standard_normal(x.shape)
        turn -= (turn * x).sum(axis=1, keepdims=True) * x
        turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
        c = make.uniform(least, least + 0.4 * (1 - least), (len(x), 1))
        return np.ascontiguousarray(c * x + np.sqrt(1 - c * c) * turn, np.float32)

    def found_again(self, planted: np.ndarray, low: np.float32, beam: int) -> tuple[int, int]:
        """Links of planted vectors that a beam finds, as far as it can hold them, and all."""
        truth = planted @ self.x.T >= low
        ids = self.query(planted, beam)[0]
        if len(self.islands):
            ids = np.hstack([ids, np.tile(self.islands, (len(ids), 1))])
        got = [int(t[np.unique(i[i >= 0])].sum()) for t, i in zip(truth, ids, strict=True)]
        want = [min(int(t.sum()), beam) for t in truth]
        return sum(map(min, got, want)), sum(want)

    def links(self, q: np.ndarray, least: float, recall: float = RECALL) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, id) that may reach ``least``, in portions.  Queries that
        find a link beside themselves go on to a wider beam, those that then find
        more than ``SPARE``, and all where the audit fails, to one as wide as the
        graph."""
        q = np.ascontiguousarray(q, np.float32)
        low, n, todo = np.float32(least - 1e-4), len(self.x), np.arange(len(q))
        sample = np.unique(np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int))
        truth = [np.flatnonzero(row >= low) for row in q[sample] @ self.x.T]
        beam, planted = BEAM, self.planted(least)
        while len(todo):
            whole, held, full = beam >= n, [], np.zeros(len(q), bool)
            self.measured = (len(planted), len(planted)) if whole else self.found_again(planted, low, beam)
            if self.measured[0] < PLANTED_RECALL * self.measured[1]:
                beam = 4 * beam if 4 * beam <= WIDEST else n
                continue
            for k in range(0, len(todo), LANES):
                part = todo[k : k + LANES]
                if whole:
                    i, j = np.nonzero(q[part] @ self.x.T >= low)
                    yield part[i], j
                    continue
                ids, sims = self.query(q[part], beam)
                hit = sims >= low
                if len(self.islands):
                    hit[np.isin(ids, self.islands)] = False
                    ids = np.hstack([ids, np.tile(self.islands, (len(part), 1))])
                    hit = np.hstack([hit, q[part] @ self.x[self.islands].T >= low])
                full[part] = hit.sum(axis=1) > (1 if beam == BEAM else SPARE)
                i, j = np.nonzero(hit & ~full[part, None])
                held.append((part[i], ids[i, j]))
            if whole:
                return
            judged = np.isin(sample, todo) & ~full[sample]
            want = sum(len(t) for t, use in zip(truth, judged, strict=True) if use)
            got = sum(int(np.isin(i, sample[judged]).sum()) for i, _ in held)
            if got >= recall * want:
                yield from held
                todo = np.flatnonzero(full)
            beam = 4 * beam if 4 * beam <= WIDEST else n


class Forest:
    """Least roots of local nodes under unions of whole sets."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        x = self.root[x]
        while (up := self.root[x]).tolist() != x.tolist():
            x = up
        return x

    def join(self, x: np.ndarray) -> None:
        roots = np.unique(self.find(x))
        self.root[roots] = roots[0]


def nodes_of(vectors: DataFrame) -> DataFrame:
    """node, v, rows, vec_id (least): one row for each different usable vector."""
    usable = usable_rows(vectors)
    return cut(usable.groupBy("v").agg(F.count(F.lit(1)).alias("rows"), F.min("vec_id").alias("vec_id")).withColumn("node", F.monotonically_increasing_id()))


def with_vector(vectors: DataFrame) -> DataFrame:
    """vec_id and v: the vector in double precision, null where it can't link."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0.0)
    return vectors.select("vec_id", F.when(fine, F.transform(v, lambda x: x + F.lit(0.0))).alias("v"))


def usable_rows(vectors: DataFrame) -> DataFrame:
    return with_vector(vectors).where("v is not null")


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def link(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    small_batches(spark)
    nodes = nodes_of(vectors)
    total, size = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("v") * F.lit(8).cast("long")), F.lit(0))).first()
    shards, blocks = max(SHARDS, -(-size // SHARD_BYTES)), max(1, -(-total // (SHARDS * BLOCK_ROWS)))
    dealt = nodes.select("node", "v", "rows", F.size("v").alias("dim"), F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"))
    rows = dealt.select(
        "node", "v", "rows", "dim", F.col("shard").alias("home"), F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence("shard", F.lit(shards - 1))).alias("shard"),
    )

    def built(key, part):
        part = part.sort_values("node")
        v = np.vstack(part["v"].to_numpy()).astype(np.float64)
        graph = SmallWorld(_unit(v))
        layers = [x.tobytes() for x in graph.near]
        return pd.DataFrame({
            "dim": [key[0]], "shard": [key[1]], "nodes": [part["node"].to_numpy(np.int64).tobytes()], "many": [part["rows"].to_numpy(np.int64).tobytes()],
            "x": [v.tobytes()], "layers": [layers], "start": [graph.start], "islands": [graph.islands.astype(np.int64).tobytes()],
        })

    graphs = cut(
        dealt.groupBy("dim", "shard").applyInPandas(built, "dim int, shard int, nodes binary, many binary, x binary, layers array<binary>, start long, islands binary")
    )
    copies = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def asked(key, graph_rows, part):
        if not len(graph_rows) or not len(part):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        g = graph_rows.iloc[0]
        nodes, many = np.frombuffer(g["nodes"], np.int64), np.frombuffer(g["many"], np.int64)
        v = np.frombuffer(g["x"], np.float64).reshape(len(nodes), -1)
        graph = SmallWorld.__new__(SmallWorld)
        graph.x, graph.start = np.ascontiguousarray(_unit(v), np.float32), int(g["start"])
        graph.islands = np.frombuffer(g["islands"], np.int64)
        graph.near = [np.frombuffer(x, np.int32).reshape(len(nodes), -1) for x in g["layers"]]
        part = part.sort_values("node")
        q = np.vstack(part["v"].to_numpy()).astype(np.float64)
        own, rows_of, home = part["node"].to_numpy(np.int64), part["rows"].to_numpy(np.int64), part["home"].to_numpy() == g["shard"]
        unit_q, unit_v = _unit(q), _unit(v)
        spot = np.searchsorted(nodes, own)  # nodes are in order
        here = (spot < len(nodes)) & (nodes[np.minimum(spot, len(nodes) - 1)] == own)
        # One number for each node of the shard and each query from elsewhere.
        local = np.where(here, spot, len(nodes) + np.arange(len(own)))
        names = np.r_[nodes, own]
        sums, trees = np.zeros(len(names), np.int64), Forest(len(names))
        for i, j in graph.links(unit_q, least):
            fits = own[i] != nodes[j]
            for k in range(0, len(i), 100_000):
                s = slice(k, k + 100_000)
                fits[s] &= np.einsum("kd,kd->k", unit_q[i[s]], unit_v[j[s]]) >= least
            i, j = i[fits], j[fits]
            np.add.at(sums, local[i], many[j])
            # In its own shard a pair is met from both sides; elsewhere this block counts for both.
            far = ~home[i]
            np.add.at(sums, j[far], rows_of[i[far]])
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            queries, first, many_of = np.unique(i, return_index=True, return_counts=True)
            for me, start, found in zip(queries, first, many_of, strict=True):
                trees.join(np.r_[local[me], j[start : start + found]])
        again, planted = graph.measured
        at, roots = np.flatnonzero(sums), trees.find(np.arange(len(names)))
        low = np.full(len(names), np.iinfo(np.int64).max)
        np.minimum.at(low, roots, names)
        tied = np.flatnonzero((low[roots] != names) & (sums > 0))
        return pd.concat([
            pd.DataFrame({"a": names[at], "b": -1, "n": sums[at]}),
            pd.DataFrame({"a": names[tied], "b": low[roots[tied]], "n": 0}),
            pd.DataFrame({"a": [again], "b": [-2], "n": [planted]}),
        ])

    keys = ["dim", "shard", "block"]
    found = cut(copies.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(asked, "a long, b long, n long"))
    again, planted = found.where("b = -2").agg(F.sum("a"), F.sum("n")).first()
    logging.getLogger(__name__).info("%s of %s links of planted vectors were found", again or 0, planted or 0)
    counts = found.where("b = -1").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b >= 0").select("a", "b"))
    named = nodes.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = cut(named.select("v", "rows", "vec_id", "root", F.coalesce("n", F.lit(0)).alias("n")))
    least_id = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    by_vector = cut(named.join(least_id, "root").select("v", (F.col("n") + F.col("rows") - 1).alias("n_links"), "component_id"))
    out = with_vector(vectors).join(by_vector, "v", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: Brute force in DuckDB SQL.
ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND LEN(LIST_FILTER(embedding, LAMBDA x: x IS NULL OR ISNAN(x) OR ISINF(x))) = 0 AND LEN(LIST_FILTER(embedding, LAMBDA x: x <> 0)) > 0),
u AS (SELECT vec_id, e, SQRT(LIST_INNER_PRODUCT(e, e)) AS n FROM v),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a, u b WHERE a.vec_id <> b.vec_id AND LIST_INNER_PRODUCT(a.e, b.e) / (a.n * b.n) >= {COSINE}),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, MIN(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, COUNT(*) AS n_links FROM l GROUP BY a)
SELECT c.vec_id, COALESCE(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.vec_id = c.vec_id
"""

"""Exact top-k by inner product: M-trees in pages, searched best-first.

An inner product is no metric, but with one more component, sqrt(M^2 - |x|^2), all vectors
have the norm M, and the greatest product with a query is the least Euclidean distance.
Over these an M-tree keeps pages: a leaf has a pivot, a covering radius and every entry's
distance to the pivot; an inner page has the same of its children. With the distance from
the query to a pivot known, the triangle inequality bounds the distance to each entry or
child by a stored number alone, and only those that may still win are computed.

The vectors are dealt to the nearest of a few sampled pivots, and each pivot's vectors to
parts of about ``part_rows``; each part has its own tree. Every query first searches the
part it lies in. Its k-th score there bounds the rest: it goes on only to pivots that may
beat it, in blocks of queries, and no part returns what falls short of the bound.
"""

from __future__ import annotations

import heapq
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import pick
from ledgerloom.operators.slices import cut

#: Entries of a page.
PAGE = 512
#: Children of an inner page.
FANOUT = 8
#: The share of |q|^2 + M^2 by which bounds on scores are widened against rounding.
SLACK = 1e-9
NODES = (
    "dim int, pivot int, slice int, node int, parent int, leaf boolean, center binary, "
    "radius double, to_parent double, ids binary, vectors binary, dists binary"
)
HITS = "query_id bigint, vec_id bigint, score bigint"


def quantized(df: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and v = floor(scale * component) of usable vectors, without repeated rows.

    Vectors that are null or hold null or non-finite components take no part, nor do rows
    without a vec_id, which no result could name.
    """
    rows = pick(df, ("vec_id", "bigint"), ("embedding", "array<double>"))
    huge = F.lit(float("inf"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < huge))
    whole = F.transform("embedding", lambda x: F.floor(x * scale).cast("bigint"))
    rows = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(fine)
    return rows.select("vec_id", whole.alias("v")).distinct()


def _augmented(v, top: float):
    """Rows of ``v`` with the component that gives all of them the norm sqrt(top)."""
    import numpy as np

    v = v.astype(float)
    rest = np.sqrt(np.maximum(top - (v * v).sum(1), 0))
    return np.concatenate([v, rest[:, None]], 1)


def _distances(points, center):
    import numpy as np

    return np.sqrt(((points - center) ** 2).sum(1))


def build_tree(ids, v, top: float) -> list[tuple]:
    """Pages of one tree, the root first: (node, parent, leaf, center, radius, to_parent,
    ids, vectors, dists). Vectors alike are split evenly, so a page never holds more than
    PAGE entries."""
    import numpy as np

    points, pages = _augmented(v, top), []

    def split(rows):
        """Row numbers in at most FANOUT groups around points far from each other."""
        seeds, near = [rows[0]], _distances(points[rows], points[rows[0]])
        owner = np.zeros(len(rows), int)
        for k in range(1, FANOUT):
            seeds.append(rows[int(near.argmax())])
            there = _distances(points[rows], points[seeds[-1]])
            owner[there < near] = k
            near = np.minimum(near, there)
        groups = [rows[owner == k] for k in range(FANOUT)]
        if max(map(len, groups)) > 0.9 * len(rows):
            order = rows[np.argsort(_distances(points[rows], points[rows[0]]), kind="stable")]
            groups = np.array_split(order, min(FANOUT, ceil(len(rows) / PAGE)))
        return [g for g in groups if len(g)]

    todo = [(np.arange(len(ids)), -1, None)]
    while todo:
        rows, parent, above = todo.pop()
        mean = points[rows].mean(0)
        center = points[rows[int(_distances(points[rows], mean).argmin())]]
        dists = _distances(points[rows], center)
        node, leaf = len(pages), len(rows) <= PAGE
        to_parent = 0.0 if above is None else float(np.sqrt(((center - above) ** 2).sum()))
        kept = (ids[rows], v[rows], dists) if leaf else (ids[:0], v[:0], dists[:0])
        pages.append(
            (node, parent, leaf, center.tobytes(), float(dists.max()), to_parent)
            + tuple(x.tobytes() for x in kept)
        )
        if not leaf:
            todo += [(group, node, center) for group in split(rows)]
    return pages


class Tree:
    """The pages of one tree, laid out for search."""

    def __init__(self, nodes, dim: int, top: float) -> None:
        import numpy as np

        self.top, self.exact, nodes = top, top < 2**53, nodes.sort_values("node")
        self.centers = np.stack([np.frombuffer(c) for c in nodes["center"]])
        self.radius = nodes["radius"].to_numpy()
        self.to_parent = nodes["to_parent"].to_numpy()
        self.leaf = nodes["leaf"].to_numpy()
        parents = nodes["parent"].to_numpy()
        self.children = [np.flatnonzero(parents == n) for n in range(len(parents))]
        self.ids = [np.frombuffer(x, "i8") for x in nodes["ids"]]
        kept = [
            np.frombuffer(x, "i8").reshape(len(own), dim)
            for x, own in zip(nodes["vectors"], self.ids)
        ]
        self.vectors = [v.astype(float) if self.exact else v for v in kept]
        self.dists = [np.frombuffer(x) for x in nodes["dists"]]

    def scores(self, vectors, q):
        """Inner products in whole numbers; doubles hold them while below 2^53."""
        import numpy as np

        if self.exact:
            return (vectors @ q).astype("i8")
        return np.array([sum(int(a) * int(b) for a, b in zip(x, q)) for x in vectors], "i8")

    def search(self, query_id: int, q, k: int, bound: int | None) -> list[tuple[int, int]]:
        """(score, vec_id) of the k best, ties to the smaller vec_id, none below ``bound``."""
        import numpy as np

        point = np.append(q.astype(float), 0.0)
        size = float(point @ point)
        if self.exact:
            q = point[:-1]
        wide = SLACK * (size + self.top) + 1e-6

        def most(least_distance):
            """Greatest score at a distance of at least this."""
            return (size + self.top - np.maximum(least_distance, 0) ** 2) / 2 + wide

        best: list[tuple[int, int]] = []  # (score, -vec_id), the worst first
        floor = -np.inf if bound is None else bound
        at = float(np.sqrt(((self.centers[0] - point) ** 2).sum()))
        heap = [(-float(most(at - self.radius[0])), 0, at)]
        while heap:
            negative, node, at = heapq.heappop(heap)
            if -negative < floor:
                break
            if self.leaf[node]:
                may = most(np.abs(at - self.dists[node])) >= floor
                ids, vectors = self.ids[node], self.vectors[node]
                if not may.all():
                    ids, vectors = ids[may], vectors[may]
                scores = self.scores(vectors, q)
                high = np.flatnonzero(scores >= floor)
                for score, vec_id in zip(scores[high].tolist(), ids[high].tolist()):
                    if score < floor or vec_id == query_id:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -vec_id))
                    else:
                        heapq.heappushpop(best, (score, -vec_id))
                    if len(best) == k:
                        floor = max(floor, best[0][0])
                continue
            child = self.children[node]
            child = child[most(np.abs(at - self.to_parent[child]) - self.radius[child]) >= floor]
            there = _distances(self.centers[child], point)
            upper = most(there - self.radius[child])
            for n, bound_, d in zip(child.tolist(), upper.tolist(), there.tolist()):
                if bound_ >= floor:
                    heapq.heappush(heap, (-bound_, n, d))
        return [(score, -vec_id) for score, vec_id in best]


def _search_parts(tree: DataFrame, queries: DataFrame, blocks: int, k: int, top: float) -> DataFrame:
    """Each part's answers to the queries sent to it (dim, pivot, slice, vec_id, v, floor).

    A part meets its queries in blocks, so neither side of a group grows with the data.
    """
    keys = ["dim", "pivot", "slice", "block"]
    repeated = tree.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")
    )

    def answer(nodes, asked):
        import numpy as np
        import pandas as pd

        rows = []
        if len(nodes) and len(asked):
            found = Tree(nodes, int(nodes["dim"].iloc[0]), top)
            for query_id, v, floor in zip(asked["vec_id"], asked["v"], asked["floor"]):
                floor = None if pd.isna(floor) else int(floor)
                best = found.search(int(query_id), np.asarray(v, "i8"), k, floor)
                rows += [(int(query_id), vec_id, score) for score, vec_id in best]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    return repeated.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(answer, HITS)


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    pivots: int = 64,
    part_rows: int = 8192,
    query_block: int = 1024,
) -> DataFrame:
    """The ``k`` best scores of every query among all rows but those of its own vec_id.

    ``df``: vec_id, embedding; ``is_query``: a condition on vec_id. Returns query_id, rank
    (from 1), vec_id, score, ties to the smaller vec_id; all rows if there are fewer than k.
    Vectors of another length than the query's have no score. Repeated rows count once;
    an empty table gives no rows. ``pivots`` bounds the sample that deals the vectors out;
    all vectors are indexed, and results are exact.
    """
    spark = df.sparkSession
    rows = cut(quantized(df, scale).withColumn("dim", F.size("v")))
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    facts = rows.agg(
        F.count("*").alias("n"), F.max(size).alias("top"), F.count_if(is_query).alias("asked")
    ).first()
    top = (facts.top or 0.0) * (1 + 1e-12) + 1.0
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(pivots).collect()

    def assign(batches):
        import numpy as np

        by_dim: dict[int, list[int]] = {}
        for i, row in enumerate(sample):
            by_dim.setdefault(row.dim, []).append(i)
        centers = {
            dim: _augmented(np.array([sample[i].v for i in own]).reshape(len(own), dim), top)
            for dim, own in by_dim.items()
        }
        for batch in batches:
            nearest = np.full(len(batch), -1, "i4")
            for dim, at in batch.groupby("dim").indices.items():
                if dim in centers:
                    v = np.stack(batch["v"].to_numpy()[at]).reshape(len(at), dim)
                    points = _augmented(v, top)
                    # of one norm: the nearest center has the greatest product
                    close = (points @ centers[dim].T).argmax(1)
                    nearest[at] = np.array(by_dim[dim])[close]
            yield batch.assign(pivot=nearest)

    fields = "vec_id bigint, v array<bigint>, dim int, pivot int"
    dealt = cut(rows.select("vec_id", "v", "dim").mapInPandas(assign, fields))
    owned = dealt.groupBy("dim", "pivot").agg(F.count("*").alias("n"))
    slices = F.ceil(F.col("n") / part_rows).cast("int")
    # one row per pivot and length of vectors
    counts = cut(owned.withColumn("slices", slices).drop("n"))
    parts = dealt.join(F.broadcast(counts), ["dim", "pivot"]).withColumn(
        "slice", F.pmod(F.xxhash64("vec_id", "v"), F.col("slices")).cast("int")
    )

    def build(key, group):
        import numpy as np
        import pandas as pd

        group = group.sort_values("vec_id", kind="stable")
        v = np.stack(group["v"].to_numpy()).astype("i8").reshape(len(group), key[0])
        pages = build_tree(group["vec_id"].to_numpy("i8"), v, top)
        names = [c.split()[0] for c in NODES.split(", ")]
        return pd.DataFrame([key + page for page in pages], columns=names)

    tree = cut(parts.groupBy("dim", "pivot", "slice").applyInPandas(build, NODES))
    queries = parts.where(is_query).drop("slices")
    blocks = max(1, ceil(facts.asked / query_block))

    seeds = _search_parts(tree, queries.withColumn("floor", F.lit(None).cast("bigint")), blocks, k, top)
    floors = (
        seeds.groupBy("query_id")
        .agg(F.count("*").alias("n"), F.min("score").alias("floor"))
        .select(F.col("query_id").alias("vec_id"), F.expr(f"CASE WHEN n >= {k} THEN floor END AS floor"))
    )
    # how far each sampled pivot's vectors reach: one row per pivot
    reach = {
        (r.dim, r.pivot): r.reach
        for r in _reaches(dealt, sample, top).groupBy("dim", "pivot").agg(F.max("reach").alias("reach")).collect()
    }
    bounded = queries.drop("slice", "pivot").join(floors, "vec_id", "left")

    def send(batches):
        import numpy as np
        import pandas as pd

        centers = {
            key: _augmented(np.array([sample[key[1]].v]).reshape(1, key[0]), top)[0]
            for key in reach
            if key[1] >= 0
        }
        for batch in batches:
            out = []
            for vec_id, v, dim, floor in batch[["vec_id", "v", "dim", "floor"]].itertuples(index=False):
                q = np.append(np.asarray(v, float), 0.0)
                size = float((q * q).sum())
                for (of, pivot), far in reach.items():
                    if of != dim:
                        continue
                    if pivot >= 0 and not pd.isna(floor):
                        gap = max(0.0, float(np.sqrt(((centers[of, pivot] - q) ** 2).sum())) - far)
                        wide = SLACK * (size + top) + 1e-6
                        if (size + top - gap * gap) / 2 + wide < floor:
                            continue
                    out.append((vec_id, v, dim, floor, pivot))
            sent = pd.DataFrame(out, columns=["vec_id", "v", "dim", "floor", "pivot"])
            yield sent.astype({"floor": "Int64"})

    fields = "vec_id bigint, v array<bigint>, dim int, floor bigint, pivot int"
    sent = bounded.select("vec_id", "v", "dim", "floor").mapInPandas(send, fields)
    asked = sent.join(F.broadcast(counts), ["dim", "pivot"]).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    )
    hits = _search_parts(tree, asked.drop("slices"), blocks, k, top).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _reaches(dealt: DataFrame, sample: list, top: float) -> DataFrame:
    """(dim, pivot, reach): per batch, the greatest distance from a pivot to a vector of it."""

    def reaches(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            out = []
            for (dim, pivot), at in batch.groupby(["dim", "pivot"]).indices.items():
                far = 0.0
                if pivot >= 0:
                    v = np.stack(batch["v"].to_numpy()[at]).reshape(len(at), dim)
                    center = _augmented(np.array([sample[pivot].v]).reshape(1, dim), top)[0]
                    far = float(_distances(_augmented(v, top), center).max())
                out.append((dim, pivot, far))
            yield pd.DataFrame(out, columns=["dim", "pivot", "reach"])

    return dealt.select("dim", "pivot", "v").mapInPandas(reaches, "dim int, pivot int, reach double")

"""Exact top-k search by inner product with cover trees over queries and data.

Rows go to the nearest of a bounded number of pivots; each cell is cut into
bounded blocks, the queries of a cell into bounded groups. Block and group get a
cover tree each: the children of a node are points that lie apart and cover it
with half its radius. A pair of trees is walked together. Two nodes with centres
c, d and covering radii R, S hold no pair of a product above
c*d + |c|*S + |d|*R + R*S, and are left when that is below the worst k-th score
of the query node. A group first meets a block of the cell that promises most,
which gives these scores; the same bound between the group's root and the cells
then tells which blocks are sent to it at all.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelspark.llm.arrow import arrow_schema, map_batches, rows_of
from duelspark.session import stage

#: Numbers in a block of vectors or a group of queries; both have 64 rows at least.
BLOCK_VALUES = 1 << 17

#: Cells of the space at most; their pivots are the rows that hash lowest.
PIVOTS = 256

#: A node of so few points has no children.
LEAF = 16

#: Products of whole numbers below this are exact in double precision.
EXACT = float(1 << 53)
LARGEST = (1 << 63) - 1

#: Scores that may go beyond 64 bits travel as digits of so many bits, the first with the sign.
DIGIT = 40
SCORE = "struct<exact:array<bigint>,cut:bigint>"

NODES = (
    "ids array<bigint>, dims int, points binary, low array<int>, high array<int>, center array<int>, radius array<double>, "
    "first array<int>, past array<int>"
)


def whole_numbers(rows: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """id, v: floor(scale * x) of every component as double, for vectors without null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    x = F.transform(vector, lambda c: c.cast("double"))
    floor = lambda c: F.when(F.abs(c) < EXACT, F.floor(c).cast("double")).otherwise(c)
    return (
        rows.select(F.col(key).cast("long").alias("id"), x.alias("x"))
        .filter(F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
        .select("id", F.transform("x", lambda c: floor(c * F.lit(scale))).alias("v"))
        .filter(F.forall("v", finite))
    )


class Tree:
    """Points of a block in the order of their nodes; each node is a stretch of them."""

    def __init__(self, row: dict):
        self.ids = np.asarray(row["ids"], np.int64)
        self.points = np.frombuffer(row["points"], np.float64).reshape(len(self.ids), row["dims"])
        for name in ("low", "high", "center", "first", "past"):
            setattr(self, name, np.asarray(row[name], np.int64))
        self.radius = np.asarray(row["radius"], np.float64)
        self.norm = np.sqrt((self.points**2).sum(axis=1))

    def children(self, nodes: np.ndarray) -> np.ndarray:
        return np.concatenate([np.arange(a, b) for a, b in zip(self.first[nodes], self.past[nodes])])


def grow(ids: np.ndarray, points: np.ndarray) -> dict:
    """A cover tree as a row of NODES."""
    order = np.arange(len(ids))
    low, high, center, radius, first, past = [0], [len(ids)], [0], [0.0], [0], [0]
    away = lambda part, c: np.sqrt(((points[part] - points[c]) ** 2).sum(axis=1))
    center[0] = int(away(order, np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1))).argmin())
    node = 0
    while node < len(low):
        part = order[low[node] : high[node]]
        distance = away(part, center[node])
        radius[node] = float(distance.max())
        if len(part) > LEAF and radius[node] > 0:
            # Farthest first: each new centre lies more than half the radius from the others.
            centers, owner = [center[node]], np.zeros(len(part), np.int64)
            while distance[far := int(distance.argmax())] > radius[node] / 2:
                new = away(part, part[far])
                owner[new < distance] = len(centers)
                distance = np.minimum(distance, new)
                centers.append(int(part[far]))
            sorted_ = np.argsort(owner, kind="stable")
            order[low[node] : high[node]] = part[sorted_]
            counts = np.bincount(owner, minlength=len(centers))
            starts = low[node] + np.concatenate([[0], np.cumsum(counts)])
            first[node], past[node] = len(low), len(low) + len(centers)
            for c, a, b in zip(centers, starts, starts[1:]):
                low.append(int(a)), high.append(int(b)), center.append(c), radius.append(0.0), first.append(0), past.append(0)
        node += 1
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    return {
        "ids": ids[order], "dims": points.shape[1], "points": np.ascontiguousarray(points[order], np.float64).tobytes(),
        "low": low, "high": high, "center": place[center], "radius": radius, "first": first, "past": past,
    }


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole inner products, exact: of 64 bits where all are below EXACT, else unbounded numbers."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims], b[:, :dims]
    if dims * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = lambda x: np.array([[int(c) for c in row] for row in x], object).reshape(x.shape)
    return whole(a).dot(whole(b).T) if dims else np.zeros((len(a), len(b)), object)


def digits(score: int, n: int) -> list[int]:
    """A score as ``n`` numbers that sort like it."""
    low = [(score >> (DIGIT * k)) & ((1 << DIGIT) - 1) for k in range(n - 1)]
    return [score >> (DIGIT * (n - 1)), *reversed(low)]


def joined(parts: list[int]) -> int:
    out = 0
    for part in parts:
        out = (out << DIGIT) + int(part)
    return out


def cut(score: int) -> int:
    """Beyond 64 bits the largest or smallest number."""
    return max(-LARGEST, min(LARGEST, int(score)))


def bound(c, d, cn, dn, r, s):
    """What no product of a point within ``r`` of c and one within ``s`` of d exceeds; cn, dn: norms of c and d. With room for rounding."""
    norms = (cn + r) * (dn + s)
    return np.minimum(d @ c + cn * s + dn * r + r * s, norms) + 1e-9 * norms + 0.5


class Walk:
    """The k best of a block for every query of a group, from given k-th scores on."""

    def __init__(self, queries: Tree, data: Tree, k: int, least: np.ndarray):
        self.q, self.d, self.k = queries, data, k
        self.least = np.array([float(x) for x in least])  # a score below can't be among the best
        self.known = list(least)  # the same in whole numbers
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries.ids]
        dims = min(queries.points.shape[1], data.points.shape[1])
        self.qc, self.dc = queries.points[queries.center][:, :dims], data.points[data.center][:, :dims]
        self.qn, self.dn = queries.norm[queries.center], data.norm[data.center]
        if len(queries.ids) and len(data.ids):
            self.visit(0, np.zeros(1, np.int64))

    def bounds(self, q: int, nodes: np.ndarray) -> np.ndarray:
        return bound(self.qc[q], self.dc[nodes], self.qn[q], self.dn[nodes], self.q.radius[q], self.d.radius[nodes])

    def visit(self, q: int, nodes: np.ndarray) -> None:
        low, high, leaf = self.q.low[q], self.q.high[q], self.q.past[q] == self.q.first[q]
        while True:
            bound = self.bounds(q, nodes)
            keep = bound >= self.least[low:high].min()
            nodes, bound = nodes[keep], bound[keep]
            if not len(nodes):
                return
            open_ = (self.d.past[nodes] > self.d.first[nodes]) & (leaf | (self.d.radius[nodes] > self.q.radius[q]))
            if not open_.any():
                break
            nodes = np.concatenate([nodes[~open_], self.d.children(nodes[open_])])
        if not leaf:
            for child in range(self.q.first[q], self.q.past[q]):
                self.visit(child, nodes)
            return
        order = np.argsort(-bound, kind="stable")
        nodes, bound = nodes[order], bound[order]
        at, bite = 0, self.k + 1
        while at < len(nodes) and bound[at] >= self.least[low:high].min():
            # The first points give k-th scores; then more are taken at once.
            size = np.cumsum(self.d.high[nodes[at:]] - self.d.low[nodes[at:]])
            upto = at + 1 + int(np.searchsorted(size, bite))
            bite = min(2 * bite, 512)
            rows = np.concatenate([np.arange(self.d.low[n], self.d.high[n]) for n in nodes[at:upto]])
            self.take(low, high, rows)
            at = upto

    def take(self, low: int, high: int, rows: np.ndarray) -> None:
        scores, ids = products(self.q.points[low:high], self.d.points[rows]), self.d.ids[rows]
        for n in range(low, high):
            row = scores[n - low]
            good = np.flatnonzero((row >= self.known[n]) & (ids != self.q.ids[n]))
            if not len(good):
                continue
            s, i = np.concatenate([self.best[n][0], row[good]]), np.concatenate([self.best[n][1], ids[good]])
            if s.dtype == object:
                order = np.array(sorted(range(len(s)), key=lambda x: (-s[x], i[x])))
            else:
                order = np.lexsort((i, -s))
            # An id counts once, with its best score: the first in this order.
            top = order[np.sort(np.unique(i[order], return_index=True)[1])[: self.k]]
            self.best[n] = s[top], i[top]
            if len(top) == self.k:
                self.known[n] = max(self.known[n], s[top[-1]])
                self.least[n] = float(self.known[n])


class Cells:
    """Pivots, and what lies around them: the farthest distance of a row and the number of rows."""

    def __init__(self, rows: DataFrame, dims: int, most: int):
        chosen = rows.orderBy(F.xxhash64("id", "v"), "id", "v").limit(most).select("v").collect()
        self.points = padded([row.v for row in chosen], dims)
        self.norms = np.sqrt((self.points**2).sum(axis=1))

    def deal(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` (id, v) with ``cell`` and ``away``, the distance from its pivot, stored."""
        made, dims = "id bigint, v array<double>, cell bigint, away double", self.points.shape[1]

        def each(batch):
            points = padded(batch.column("v").to_pylist(), dims)
            near = self.norms**2 - 2 * points @ self.points.T
            cell = near.argmin(axis=1)
            # Not by the norms: a difference of squares is not exact for near points.
            away = np.sqrt(((points - self.points[cell]) ** 2).sum(axis=1))
            return {"id": batch.column("id"), "v": batch.column("v"), "cell": cell, "away": away}

        return stage(map_batches(rows, made, each), name)

    def measure(self, dealt: DataFrame) -> None:
        self.radius, self.rows = np.full(len(self.points), -1.0), np.zeros(len(self.points), np.int64)
        for row in dealt.groupBy("cell").agg(F.max("away").alias("away"), F.count("id").alias("n")).collect():
            self.radius[row.cell], self.rows[row.cell] = row.away, row.n

    def promise(self, center: np.ndarray, radius: float) -> np.ndarray:
        """What no product of a point within ``radius`` of ``center`` and a row of each cell exceeds; nothing for empty cells."""
        most = bound(center, self.points, np.sqrt((center**2).sum()), self.norms, radius, np.maximum(self.radius, 0))
        return np.where(self.rows > 0, most, -np.inf)


def padded(vectors: list[list[float]], dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for n, v in enumerate(vectors):
        out[n, : len(v)] = v
    return out


def _trees(dealt: DataFrame, size: int, dims: int, name: str) -> DataFrame:
    """Cover trees of about ``size`` points of a cell each, numbered in ``name``, with ``cell`` and the root's centre."""
    made = f"{name} bigint, cell bigint, root array<double>, {NODES}"
    schema = arrow_schema(made)

    def build(key, table):
        import pyarrow as pa

        points = padded(table.column("v").to_pylist(), dims)
        row = grow(np.asarray(table.column("id").to_pylist(), np.int64), points)
        root = np.frombuffer(row["points"], np.float64).reshape(-1, dims)[row["center"][0]]
        cell, sub = (k.as_py() for k in key)
        row |= {name: (cell << 32) + sub, "cell": cell, "root": root}
        return pa.Table.from_batches([rows_of({k: [v] for k, v in row.items()}, schema)])

    # One row per cell.
    parts = dealt.groupBy("cell").agg((F.count("id") / size).cast("long").alias("_parts"))
    placed = dealt.join(F.broadcast(parts), "cell").withColumn("sub", F.pmod(F.xxhash64("id", "v"), F.col("_parts") + 1))
    return stage(placed.select("id", "v", "cell", "sub").groupBy("cell", "sub").applyInArrow(build, made), f"trees-{name}")


def _promising(groups: DataFrame, cells: Cells) -> DataFrame:
    """group, cell, before: the cells a group must see, as far as its worst k-th score (``worst``, null if unknown) tells.

    ``before``: rows of the cells that promise more.
    """
    made = "group bigint, cell bigint, before bigint"
    schema = arrow_schema(made)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                most = cells.promise(np.array(row["root"]), row["far"])
                worst = -np.inf if row["worst"] is None else row["worst"]
                seen = np.flatnonzero((most >= worst) & (cells.rows > 0))
                seen = seen[np.argsort(-most[seen], kind="stable")]
                before = np.cumsum(cells.rows[seen]) - cells.rows[seen]
                yield rows_of([[row["group"]] * len(seen), seen, before], schema)

    return groups.select("group", "root", F.col("radius")[0].alias("far"), "worst").mapInArrow(run, made)


def _walked(pairs: DataFrame, blocks: DataFrame, groups: DataFrame, least: DataFrame | None, k: int, n_digits: int) -> DataFrame:
    """query_id, vec_id, score of the best of every pair (block, group), with the k-th scores of ``least`` (group, id, least)."""
    made = f"query_id bigint, vec_id bigint, score {SCORE}"
    schema = arrow_schema(made)

    def walk(key, left, right):
        import pyarrow as pa

        data, queries = Tree(left.to_pylist()[0]), Tree(right.to_pylist()[0])
        scores = [joined(s["exact"]) for s in right.column("scores").to_pylist()[0] or []]
        known = dict(zip(right.column("known").to_pylist()[0] or [], scores))
        found = Walk(queries, data, k, [known.get(i, -np.inf) for i in queries.ids.tolist()]).best
        columns = [
            np.repeat(queries.ids, [len(s) for s, _ in found]),
            np.concatenate([i for _, i in found]),
            [{"exact": digits(int(x), n_digits), "cut": cut(x)} for s, _ in found for x in s],
        ]
        return pa.Table.from_batches([rows_of(columns, schema)])

    trees = lambda of, name: of.select(name, *[c.split()[0] for c in NODES.split(", ")])
    queries = trees(groups, "group")
    if least is None:
        queries = queries.withColumn("known", F.array().cast("array<bigint>")).withColumn("scores", F.array().cast(f"array<{SCORE}>"))
    else:
        # At most one row per query of a bounded group.
        listed = least.groupBy("group").agg(F.collect_list(F.struct("id", "least")).alias("l"))
        queries = queries.join(listed.select("group", F.col("l.id").alias("known"), F.col("l.least").alias("scores")), "group", "left")
    left = pairs.join(trees(blocks, "block"), "block").withColumnsRenamed({"block": "block_1", "group": "group_1"})
    right = pairs.join(queries, "group").withColumnsRenamed({"block": "block_2", "group": "group_2"})
    return left.groupBy("block_1", "group_1").cogroup(right.groupBy("block_2", "group_2")).applyInArrow(walk, made)


def top_k(
    rows: DataFrame, query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest products of every row where ``query`` with all rows but its own.

    Components are floor(scale * x). Equal scores are ranked by smaller id; fewer
    than k candidates are all returned. Rows with a null id, a null vector or a
    null or non-finite component take no part; a shorter vector ends in zeros.
    Rows that repeat an id are no candidates of each other: their candidates are
    ranked together, and a repeated candidate counts once, with its best score.
    Products are ranked exactly; one beyond 64 bits is returned as the largest
    number. An empty table gives no rows. Other columns are ignored.
    """
    queries = whole_numbers(rows.filter(query), key, vector, scale)
    data = whole_numbers(rows, key, vector, scale).distinct()
    # Of equal vectors only the k + 1 smallest ids can be among the best of anything; the limit also holds before the shuffle.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    data = stage(data.withColumn("_n", place).filter(F.col("_n") <= k + 1).drop("_n"), "topk-vectors")
    largest = F.max(F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)))
    found = data.agg(F.max(F.size("v")).alias("dims"), largest.alias("largest"), F.count("id").alias("n")).first()
    dims = found.dims or 1
    size = max(64, BLOCK_VALUES // dims)
    bits = (dims * int(found.largest or 0) ** 2).bit_length() + 1
    n_digits = 1 if bits < 64 else -(-bits // DIGIT)

    # No more cells than there are blocks to fill them.
    cells = Cells(data, dims, min(PIVOTS, found.n // size + 1))
    dealt = cells.deal(data, "topk-dealt")
    cells.measure(dealt)
    blocks = _trees(dealt, size, dims, "block")
    groups = _trees(cells.deal(queries.distinct(), "topk-queries"), size, dims, "group")
    numbers = stage(blocks.select("cell", "block"), "topk-blocks")

    # Every group begins with a block of each of the cells that promise most, until they hold k rows beside its own.
    best = _promising(groups.withColumn("worst", F.lit(None).cast("double")), cells).filter(F.col("before") <= k)
    start = best.join(numbers, "cell").groupBy("group", "cell").agg(F.min("block").alias("block"))
    start = stage(start.select("group", "block"), "topk-starts")
    first = stage(_walked(start, blocks, groups, None, k, n_digits), "topk-first")

    # Rows that repeat a query's or a candidate's id count once here too.
    kth = (
        first.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("_n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        .filter(F.col("_n") == k)
        .select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    )
    owner = groups.select("group", F.explode("ids").alias("id")).distinct()
    least = stage(owner.join(kth, "id", "left").select("group", "id", "least"), "topk-least")
    # The worst of a group is known only if all its queries have a k-th score.
    floats = F.aggregate("least.exact", F.lit(0.0), lambda acc, d: acc * F.lit(float(1 << DIGIT)) + d)
    worst = least.groupBy("group").agg(
        F.when(F.count("least") == F.count("id"), F.min(floats)).alias("worst")
    )
    seen = _promising(groups.join(worst, "group"), cells).select("group", "cell")
    pairs = stage(seen.join(numbers, "cell").select("group", "block").join(start, ["group", "block"], "left_anti"), "topk-pairs")
    rest = _walked(pairs, blocks, groups, least.filter("least IS NOT NULL"), k, n_digits)
    once = first.union(rest).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = once.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("score.cut").alias("score"))

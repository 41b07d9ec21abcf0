"""Density clusters (Campello, Moulavi, Sander 2013), exact at any size.

Up to MOST_VECTORS vectors come to the driver, where distances are computed row by row. More are cut
into blocks, and tasks take the pairs of blocks: first for the core distances, then for the minimum
spanning tree under mutual reachability of each pair. Every edge of the whole lies in a pair, so the
tree of the union of these trees is a tree of the whole. Work grows with the square of the vectors
and is spread over the tasks; only the last tree, of n - 1 edges, and its labels stand in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageatlas.session import durable, numbered

#: More vectors than that do not come to the driver. Rows of a block; edge lists that one task makes one.
MOST_VECTORS, BLOCK, FAN_IN = 20_000, 4_000, 8


def _spanning_tree(x: np.ndarray, core: np.ndarray) -> list[tuple[float, float, int, int]]:
    """(reach, distance, row, row) of a minimum spanning tree under mutual reachability, by Prim's rule.

    All edges of a row that are shorter than its core distance have one reach; of these the shorter
    distance comes first, so that the tree does not depend on the order of rows or on blocks."""
    n = len(x)
    best, far, near = np.full(n, np.inf), np.full(n, np.inf), np.zeros(n, dtype=int)
    inside = np.zeros(n, dtype=bool)
    at, edges = 0, []
    for _ in range(n - 1):
        inside[at] = True
        apart = 1.0 - x @ x[at]
        d = np.maximum(np.maximum(apart, core), core[at])
        closer = ~inside & ((d < best) | ((d == best) & (apart < far)))
        best[closer], far[closer], near[closer] = d[closer], apart[closer], at
        left = np.where(inside, np.inf, best)
        nxt = int(np.where(left == left.min(), np.where(inside, np.inf, far), np.inf).argmin())
        edges.append((float(best[nxt]), float(far[nxt]), int(near[nxt]), nxt))
        at = nxt
    return sorted(edges)


def labels_of(vectors: np.ndarray, min_cluster_size: int) -> np.ndarray:
    """A label per row, -1 for noise; fewer rows than max(4, min_cluster_size) are all noise.

    Labels follow the smallest row of their cluster, so they do not depend on the tree's order.
    """
    n = len(vectors)
    out = np.full(n, -1)
    if n < max(4, min_cluster_size):
        return out
    x = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    core = np.array([np.partition(1.0 - x @ v, min(min_cluster_size, n) - 1)[min(min_cluster_size, n) - 1] for v in x])
    return _labels_of_tree(n, _spanning_tree(x, core), min_cluster_size)


def _labels_of_tree(n: int, edges: list[tuple[float, float, int, int]], min_cluster_size: int) -> np.ndarray:
    out = np.full(n, -1)
    # single linkage: node n + i joins two nodes at a distance
    up, size, left, right, dist = list(range(n)), [1] * n, [-1] * n, [-1] * n, [0.0] * n

    def top(a: int) -> int:
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    for d, _, a, b in edges:
        a, b = top(a), top(b)
        k = len(up)
        up.append(k)
        up[a] = up[b] = k
        size.append(size[a] + size[b])
        left.append(a)
        right.append(b)
        dist.append(d)

    def points(node: int) -> list[int]:
        stack, got = [node], []
        while stack:
            a = stack.pop()
            if left[a] < 0:
                got.append(a)
            else:
                stack += [left[a], right[a]]
        return got

    # condensed tree: clusters are born where both sides are large enough
    clusters: list[dict] = [{"node": len(up) - 1, "birth": 0.0, "stability": 0.0, "children": []}]
    work = [0]
    while work:
        c = work.pop()
        me, a = clusters[c], clusters[c]["node"]
        while left[a] >= 0:
            lam = 1.0 / max(dist[a], 1e-12)
            p, q = left[a], right[a]
            big = [s for s in (p, q) if size[s] >= min_cluster_size]
            if len(big) == 2:
                me["stability"] += (lam - me["birth"]) * size[a]
                for s in big:
                    clusters.append({"node": s, "birth": lam, "stability": 0.0, "children": []})
                    me["children"].append(len(clusters) - 1)
                    work.append(len(clusters) - 1)
                break
            if not big:
                me["stability"] += (lam - me["birth"]) * size[a]
                break
            small = q if big[0] == p else p
            me["stability"] += (lam - me["birth"]) * size[small]
            a = big[0]
    chosen: set[int] = set()
    value = [0.0] * len(clusters)
    for c in range(len(clusters) - 1, 0, -1):  # children come after their parent
        below = sum(value[k] for k in clusters[c]["children"])
        if clusters[c]["children"] and below > clusters[c]["stability"]:
            value[c] = below
        else:
            value[c] = clusters[c]["stability"]
            stack = list(clusters[c]["children"])
            while stack:
                k = stack.pop()
                chosen.discard(k)
                stack += clusters[k]["children"]
            chosen.add(c)
    groups = sorted((sorted(points(clusters[c]["node"])) for c in chosen), key=lambda g: g[0])
    for k, g in enumerate(groups):
        out[g] = k
    return out


def _forest(d: np.ndarray, r: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which edges make a minimum spanning forest, in its order, by Kruskal's rule."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    p, q = flat[: len(a)].tolist(), flat[len(a) :].tolist()
    up, kept = list(range(len(nodes))), []
    for e in np.lexsort((b, a, r, d)).tolist():
        u, v = p[e], q[e]
        while up[u] != u:
            up[u] = up[up[u]]
            u = up[u]
        while up[v] != v:
            up[v] = up[up[v]]
            v = up[v]
        if u != v:
            up[u] = v
            kept.append(e)
    return np.array(kept, dtype=int)


def _nearest(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distances of each row of x to rows of y; infinite where y has fewer."""
    out = np.full((len(x), k), np.inf)
    m = min(k, len(y))
    for lo in range(0, len(x), 500):
        out[lo : lo + 500, :m] = np.partition(1.0 - x[lo : lo + 500] @ y.T, m - 1, axis=1)[:, :m]
    return out


def _cluster_by_blocks(vectors: DataFrame, min_cluster_size: int, block: int) -> DataFrame:
    rows = durable(numbered(vectors.select("id", "vector"), "row", "id"))
    n = rows.count()
    k, parts = min(min_cluster_size, n), -(-n // block)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        x = np.array(pdf["vector"].tolist(), dtype=float)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "x": [x.tobytes()], "len": [len(x)]})

    def unpack(r) -> np.ndarray:
        return np.frombuffer(r.x).reshape(r.len, -1)

    packed = durable(rows.withColumn("block", F.floor(F.col("row") / block).cast("int")).groupBy("block").applyInPandas(pack, "block int, x binary, len int"))

    def by_pair(blocks: DataFrame) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("other")
        both = blocks.select("*", other)
        return both.select(*blocks.columns, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).repartition(min(parts * parts, 2_000), "i", "j").groupBy("i", "j")

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        r = list(pdf.sort_values("block").itertuples(index=False))
        u, v = unpack(r[0]), unpack(r[-1])
        got = [(r[0].block, _nearest(u, v, k))] + ([(r[-1].block, _nearest(v, u, k))] if len(r) > 1 else [])
        return pd.DataFrame({"block": [b for b, _ in got], "near": [m.tobytes() for _, m in got]})

    def core_of(pdf: pd.DataFrame) -> pd.DataFrame:
        best = np.concatenate([np.frombuffer(m).reshape(-1, k) for m in pdf["near"]], axis=1)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "core": [np.partition(best, k - 1, axis=1)[:, k - 1].tobytes()]})

    core = by_pair(packed).applyInPandas(near, "block int, near binary").groupBy("block").applyInPandas(core_of, "block int, core binary")
    ready = durable(packed.join(core, "block"))
    shape = "part int, d binary, r binary, a binary, b binary"

    def listed(part: int, d: np.ndarray, r: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "d": [d.tobytes()], "r": [r.tobytes()], "a": [a.tobytes()], "b": [b.tobytes()]})

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        r = list(pdf.sort_values("block").itertuples(index=False))
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        if i == j and parts > 1:  # its edges lie in the pairs with other blocks
            return pd.DataFrame({"part": [], "d": [], "r": [], "a": [], "b": []}).astype({"part": "int32"})
        at = np.concatenate([q.block * block + np.arange(q.len) for q in r])
        e = _spanning_tree(np.concatenate([unpack(q) for q in r]), np.concatenate([np.frombuffer(q.core) for q in r]))
        d, apart = np.array([t[0] for t in e]), np.array([t[1] for t in e])
        p, q = at[[t[2] for t in e]], at[[t[3] for t in e]]
        return listed(i * parts + j, d, apart, np.minimum(p, q), np.maximum(p, q))

    def joined(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
        d, r = (np.concatenate([np.frombuffer(m) for m in pdf[c]]) for c in "dr")
        a, b = (np.concatenate([np.frombuffer(m, dtype=np.int64) for m in pdf[c]]) for c in "ab")
        kept = _forest(d, r, a, b)
        return d[kept], r[kept], a[kept], b[kept]

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return listed(int(pdf["part"].iloc[0]), *joined(pdf))

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        found = _labels_of_tree(n, list(zip(*(c.tolist() for c in joined(pdf)))), min_cluster_size)
        return pd.DataFrame({"row": np.arange(n), "label": found})

    from pyspark.sql import Window

    edges = durable(by_pair(ready).applyInPandas(tree, shape))
    while (lists := edges.count()) > FAN_IN:  # of the few lists only their numbers meet in the window
        number = edges.select("part").withColumn("to", F.floor((F.row_number().over(Window.orderBy("part")) - 1) / FAN_IN).cast("int"))
        grouped = edges.join(F.broadcast(number), "part").drop("part").withColumnRenamed("to", "part")
        edges = durable(grouped.repartition(-(-lists // FAN_IN), "part").groupBy("part").applyInPandas(merge, shape), replaces=edges)
    labels = edges.groupBy().applyInPandas(label, "row bigint, label int")
    return rows.select("id", "row").join(durable(labels), "row").select("id", "label")


def cluster(vectors: DataFrame, min_cluster_size: int = 8, most: int = MOST_VECTORS, block: int = BLOCK) -> DataFrame:
    """(id, label) of (id, vector); -1 is noise. More than ``most`` vectors are clustered by tasks, with the
    same method; labels follow the order of id either way."""
    rows = vectors.orderBy("id").limit(most + 1).toArrow()
    if rows.num_rows > most:
        return _cluster_by_blocks(vectors, min_cluster_size, block)
    kind = dict(vectors.dtypes)["id"]
    x = np.array(rows["vector"].to_pylist(), dtype=float) if rows.num_rows else np.zeros((0, 1))
    out = list(zip(rows["id"].to_pylist(), labels_of(x, min_cluster_size).tolist()))
    return vectors.sparkSession.createDataFrame(out, f"id {kind}, label int") if out else vectors.select("id", F.lit(-1).alias("label")).limit(0)

"""Most similar vectors: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample and every vector is routed through it and indexed. Where its
leaves stay crowded, because there are more vectors than a sample can part, each gets a tree of its
own, fitted in a task on a bounded sample of that leaf, so that leaves grow in number with the data
and not in size. A query opens leaves best bin first, by the least promise on the way to each, and widens
its visits until what is left promises less than its own leaf by more than a slack. Promises come for many
queries at once. The slack is calibrated by brute force on queries that no tree was fitted on. A vector
then travels once to each block of leaves it visits, goes down the trees there and meets the members.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pageatlas.session import durable, numbered

#: Vectors a tree is fitted on (as many as expected of a hash sample, below the first level); queries of the
#: calibration that are held out of the fit, and as many that are not.
SAMPLE, HELD_OUT = 20_000, 300
#: Children of a tree node, wanted members of a leaf, and sampled vectors a leaf needs at least.
BRANCHES, LEAF_MEMBERS, LEAF_SAMPLE = 24, 200, 8
#: Leaves of one block, and members or visitors that one task compares at most; more are parted by hash.
BLOCK_LEAVES, BLOCK = 16, 8_192
#: A leaf's number is that of its first-level leaf times this, plus its own below it.
SUB = 4_096
#: Rows whose promises are worked out at once, rows of a batch of visits, similarities that a task holds at once,
#: and meetings of members and visitors, each of up to BLOCK, in a task.
STEP, PIECE, CELLS, GROUPS = 1_024, 8_192, 1 << 20, 4


def usable_vectors(vectors: DataFrame, model: str = "sentence-mini-64", kind: str = "focus", dim: int = 64) -> DataFrame:
    """(id, vector) of the right model and kind, of ``dim`` finite elements, not all zero; each once."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.where((F.col("model") == model) & (F.col("kind") == kind) & F.col("id").isNotNull())
        .where((F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0))
        .select("id", "vector")
        .distinct()
    )


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    """A list column as unit rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(n, -1) if n else np.zeros((0, 1))
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)).astype(kind, copy=False)


def _unit(c: np.ndarray) -> np.ndarray:
    return c / max(np.linalg.norm(c), 1e-12)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> list[np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    at = np.zeros(len(x), dtype=int)
    for _ in range(rounds):
        at = (x @ centres.T).argmax(axis=1)
        for j in range(k):
            m = x[at == j]
            if len(m):
                centres[j] = _unit(m.mean(axis=0))
    return [p for j in range(k) if len(p := np.flatnonzero(at == j))]


class Tree:
    """Nodes, parents before children: ``centres``, ``children`` (-1 where there is none), ``leaf``
    numbers (-1 inside), and ``tight``: the mean similarity of a node's centre to the leaves below it.
    ``tops``: by leaf, centres and tightness of the uppermost branches of that leaf's own tree."""

    def __init__(self, x: np.ndarray, leaves: int, seed: int = 7):
        x = x.astype(np.float32, copy=False)
        self.n_leaves, self._centre, self._below, self._leaf, self._tight = 0, [], [], [], []
        self._grow(x, max(2.0, len(x) / max(leaves, 1)), np.random.default_rng(seed))
        self.centres = np.vstack(self._centre)
        self.children = np.full((len(self._centre), BRANCHES), -1, dtype=np.int32)
        for j, below in enumerate(self._below):
            self.children[j, : len(below)] = below
        self.leaf, self.tight = np.array(self._leaf), np.array(self._tight, dtype=np.float32)
        self.tops: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        del self._centre, self._below, self._leaf, self._tight

    def _grow(self, x: np.ndarray, size: float, rng: np.random.Generator) -> tuple[int, list[np.ndarray]]:
        me, c = len(self._centre), _unit(x.mean(axis=0))
        self._centre.append(c)
        self._below.append([])
        self._leaf.append(-1)
        self._tight.append(1.0)
        parts = _kmeans(x, min(BRANCHES, max(2, round(len(x) / size))), rng) if len(x) > 1.5 * size else []
        if len(parts) < 2:
            self._leaf[me] = self.n_leaves
            self.n_leaves += 1
            return me, [c]
        grown = [self._grow(x[p], size, rng) for p in parts]
        self._below[me], ends = [g[0] for g in grown], [c for g in grown for c in g[1]]
        self._tight[me] = min(1.0, max(0.05, float(np.mean(np.vstack(ends) @ c))))
        return me, ends

    def packed(self) -> bytes:
        """What workers need, without its class, which they may not have."""
        return pickle.dumps(self.__dict__)

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        tree = cls.__new__(cls)
        tree.__dict__ = pickle.loads(data)
        return tree

    def leaf_centres(self) -> np.ndarray:
        at = np.flatnonzero(self.leaf >= 0)
        return self.centres[at[np.argsort(self.leaf[at])]]

    def top(self) -> tuple[np.ndarray, np.ndarray]:
        """Centres and tightness of the branches below the root, at most BRANCHES."""
        below = self.children[0][self.children[0] >= 0] if self.leaf[0] < 0 else np.zeros(1, int)
        return self.centres[below], self.tight[below]

    def promises(self, x: np.ndarray) -> np.ndarray:
        """Of every row and node; what is above the root promises anything."""
        p = x @ self.centres.T
        inner = np.flatnonzero(self.tight < 1)
        p[:, inner] = _promise(p[:, inner], self.tight[inner])
        if self.leaf[0] < 0:
            p[:, 0] = np.inf
        return p

    def keys(self, x: np.ndarray, promises: np.ndarray | None = None) -> np.ndarray:
        """For every row and leaf the least promise on the way to it, down to which it would be opened."""
        key = self.promises(x) if promises is None else promises.copy()
        for j in np.flatnonzero(self.leaf < 0)[1:]:
            below = self.children[j][self.children[j] >= 0]
            key[:, below] = np.minimum(key[:, below], key[:, [j]])
        return key[:, self.ends()]

    def ends(self) -> np.ndarray:
        """The leaves' nodes, by number."""
        at = np.flatnonzero(self.leaf >= 0)
        return at[np.argsort(self.leaf[at])]


def _promise(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """What similarity a leaf below a node may have: that of a row as near to it, of the angle to the node's
    centre, as the mean leaf's angle to the centre allows. Of a leaf it is the similarity itself."""
    s = np.clip(s, -1.0, 1.0)
    return np.where(s < t, s * t + np.sqrt((1 - s * s) * (1 - t * t)), np.where(t < 1, np.float32(1.0), s))


def open_bins(tree: Tree, x: np.ndarray, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, key) of the leaves that each row opens, best bin first.

    With ``least`` those are all leaves with no lesser promise on their way. Without, a row ends with its
    first leaf: that of the highest key, and of those below one bottleneck the most promising; key is then its own promise.
    """
    x = x.astype(np.float32, copy=False)
    out: list[tuple] = []
    for lo in range(0, len(x), STEP):
        promises = tree.promises(x[lo : lo + STEP])
        key = tree.keys(x[lo : lo + STEP], promises)
        if least is None:
            own, row = promises[:, tree.ends()], np.arange(len(key))
            leaf = np.where(key >= key.max(axis=1, keepdims=True), own, -np.inf).argmax(axis=1)
            out.append((row + lo, leaf, own[row, leaf]))
        else:
            row, leaf = np.nonzero(key >= least[lo : lo + STEP, None])
            best = np.lexsort((-key[row, leaf], row))
            out.append((row[best] + lo, leaf[best], key[row, leaf][best]))
    return tuple(np.concatenate(a) for a in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.float32))


def _opened(tree: Tree, x: np.ndarray, least: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf), sorted: the first-level leaves that rows open and in whose trees some branch promises enough; their own in any case."""
    rows, leaves = [], []
    for lo in range(0, len(x), STEP):
        row, leaf, _ = open_bins(tree, x[lo : lo + STEP], least[lo : lo + STEP])
        row += lo
        order = np.argsort(leaf, kind="stable")
        row, leaf = row[order], leaf[order]
        stay = np.ones(len(row), dtype=bool)
        starts = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]])) if len(leaf) else []
        for a, b in zip(starts, [*starts[1:], len(leaf)]):
            if top := tree.tops.get(int(leaf[a])):
                stay[a:b] = _promise(x[row[a:b]] @ top[0].T, top[1]).max(axis=1) >= least[row[a:b]]
        rows.append(row[stay])
        leaves.append(leaf[stay])
    row, leaf = np.concatenate([*rows, np.arange(len(x))]), np.concatenate([*leaves, own])
    both = np.unique(row * SUB + leaf)
    return both // SUB, both % SUB


def _best(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best of each row: rounded to 9 decimals, earlier column first on ties."""
    r = np.round(sims, 9)
    if r.shape[1] > k:
        floor = -np.partition(-r, k - 1, axis=1)[:, k - 1 : k]
        row, col = np.nonzero(r >= floor)
    else:
        row, col = np.nonzero(r > -9)
    order = np.lexsort((col, -r[row, col], row))
    row, col = row[order], col[order]
    start = np.searchsorted(row, np.arange(len(sims)))
    keep = np.arange(len(row)) - start[row] < k
    row, col = row[keep], col[keep]
    found = r[row, col] > -5
    return row[found], col[found]


def classes_of(vectors: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: (num, cid, vector, first): cid its smallest id, ``first`` its k + 1
    smallest ids, ``num`` its place in the order of cid. The ranking keeps k + 1 rows per task before the
    shuffle, so a vector that a third of all rows share stays small. Durable."""
    w = Window.partitionBy("vector").orderBy("id")
    classes = (
        vectors.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("first"))
        .select(F.element_at("first", 1).alias("cid"), "vector", "first")
    )
    return numbered(classes, "num", "cid")


class Index:
    """``rows``: every distinct vector (num, vector, leaf, home), home its similarity to its leaf's centre;
    the tree, the trees of crowded leaves, the slack and the recall that it reached in calibration."""

    def __init__(self, tree: Tree | None, subs: DataFrame | None, rows: DataFrame, slack: float, recall: float):
        self.tree, self.subs, self.rows, self.slack, self.recall = tree, subs, rows, slack, recall


def _wanted_leaves(n: int, sampled: int) -> int:
    return max(1, min(n // LEAF_MEMBERS, sampled // LEAF_SAMPLE))


_ROWS = "num bigint, vector array<float>, leaf bigint, home double"


def _trees_of_crowded(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """(cell, tree, tight, members, top): a tree for each crowded first-level leaf, fitted in a task on about SAMPLE of its rows."""

    def fit(t: pa.Table) -> pa.Table:
        t = t.sort_by("num")
        x, n = matrix(t["vector"], np.float32), t["members"][0].as_py()
        tree = Tree(x, min(_wanted_leaves(n, len(x)), SUB - 1))
        tight = float(np.mean(tree.leaf_centres() @ tree.centres[0]))
        return pa.table({"cell": [t["cell"][0].as_py()], "tree": [tree.packed()], "tight": [tight], "members": [n], "top": [pickle.dumps(tree.top())]})

    share = F.shiftrightunsigned(F.xxhash64(F.lit(3), "num"), 12) / float(1 << 52)
    some = rows.withColumn("cell", F.floor(F.col("leaf") / SUB)).join(crowded, "cell").where(share < SAMPLE / F.col("members"))
    return durable(some.select("cell", "members", "num", "vector").groupBy("cell").applyInArrow(fit, "cell bigint, tree binary, tight double, members bigint, top binary"))


def _with_trees(rows: DataFrame, subs: DataFrame, run, schema: str) -> DataFrame:
    """``run(table, tree)`` over rows (cell, num, ...) of cells with a tree; a cell's rows are parted by hash."""
    parts = F.ceil(F.col("members") / BLOCK)
    left = rows.join(subs.select("cell", "members"), "cell").withColumn("part", F.pmod(F.xxhash64("num"), parts)).drop("members")
    right = subs.select(F.col("cell").alias("tcell"), F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("tpart"), "tree")

    def both(t: pa.Table, tree: pa.Table) -> pa.Table:
        return run(t, Tree.unpacked(tree["tree"][0].as_py())) if t.num_rows else empty

    empty = to_arrow_schema(T.StructType.fromDDL(schema)).empty_table()

    return left.groupBy("cell", "part").cogroup(right.groupBy("tcell", "tpart")).applyInArrow(both, schema)


def build_index(classes: DataFrame, k: int, target_recall: float) -> Index:
    """Fit, route and calibrate. ``classes`` must be durable: (num, cid, vector, ...)."""
    spark = classes.sparkSession
    n = classes.count()
    held_out = min(HELD_OUT, n // 4)
    drawn = classes.select("num", "vector").orderBy(F.xxhash64("num"), "num").limit(held_out + SAMPLE).toArrow()  # bounded: SAMPLE
    x = matrix(drawn["vector"], np.float32)
    if not len(x):
        return Index(None, None, classes.select("num", "vector", F.lit(0).cast("bigint").alias("leaf"), F.lit(1.0).alias("home")), 0.0, 1.0)
    wanted = min(_wanted_leaves(n, len(x) - held_out), SUB - 1)
    tree = Tree(x[held_out:], wanted)
    shared = spark.sparkContext.broadcast(tree.packed())  # at most SAMPLE / LEAF_SAMPLE leaves

    def route(batches):
        tree = Tree.unpacked(shared.value)
        for b in batches:
            row, leaf, key = open_bins(tree, matrix(b.column("vector"), np.float32))
            order = np.argsort(row)
            yield pa.RecordBatch.from_arrays([b.column("num"), b.column("vector"), pa.array(leaf[order].astype(np.int64) * SUB), pa.array(key[order].astype(float))], names=["num", "vector", "leaf", "home"])

    rows = durable(classes.select("num", "vector").mapInArrow(route, _ROWS))
    sizes = rows.groupBy(F.floor(F.col("leaf") / SUB).alias("cell")).agg(F.count("*").alias("members"))
    crowded = sizes.where(F.col("members") > 2 * LEAF_MEMBERS)
    subs = None
    if n > 2 * LEAF_MEMBERS * wanted:  # the sample was too small for the leaves that n asks for
        subs = _trees_of_crowded(rows, crowded)
        for r in subs.select("cell", "tight", "top").collect():  # at most BRANCHES centres per leaf of the first level
            tree.tight[np.flatnonzero(tree.leaf == r["cell"])[0]] = min(1.0, max(0.05, r["tight"]))
            tree.tops[r["cell"]] = pickle.loads(r["top"])
        at = rows.withColumn("cell", F.floor(F.col("leaf") / SUB))

        def deeper(t: pa.Table, sub: Tree) -> pa.Table:
            row, leaf, key = open_bins(sub, matrix(t["vector"], np.float32))
            order = np.argsort(row)
            return pa.table({"num": t["num"], "vector": t["vector"], "leaf": np.asarray(t["leaf"]) + leaf[order] + 1, "home": key[order].astype(float)})

        rows = durable(_with_trees(at, subs, deeper, _ROWS).unionByName(at.join(subs.select("cell"), "cell", "left_anti").select(*rows.columns)))
    if not held_out:
        return Index(tree, subs, rows, 2.0, 1.0)
    slack, recall = _calibrate(tree, subs, rows, drawn["num"].slice(0, 2 * held_out), x[: 2 * held_out], held_out, k, target_recall)
    return Index(tree, subs, rows, slack, recall)


def _calibrate(tree: Tree, subs: DataFrame | None, rows: DataFrame, nums, held: np.ndarray, held_out: int, k: int, target_recall: float) -> tuple[float, float]:
    """The slack down to which queries open the leaves of so large a share of their true neighbours, and the share.

    The first ``held_out`` queries were in no sample that the tree was fitted on, the others were: they lie
    closer to the centres that they helped to make, and so need a slack of their own. The larger one holds.
    """
    spark = rows.sparkSession
    own = nums.to_pylist()
    shared = spark.sparkContext.broadcast((own, held.astype(np.float64)))

    def brute(batches):
        own, q = shared.value
        at = {c: i for i, c in enumerate(own)}
        for b in batches:
            ids = b.column("num").to_pylist()
            x, mine = matrix(b.column("vector")), np.array([(at[c], j) for j, c in enumerate(ids) if c in at], dtype=int).reshape(-1, 2)
            num, leaf = np.asarray(b.column("num")), np.asarray(b.column("leaf"))
            few = max(1, CELLS // max(1, len(x)))
            for lo in range(0, len(q), few):
                sims = q[lo : lo + few] @ x.T
                i, j = mine[(mine[:, 0] >= lo) & (mine[:, 0] < lo + few)].T
                sims[i - lo, j] = -9
                row, col = _best(sims, k)
                yield pa.RecordBatch.from_arrays([pa.array(row + lo, pa.int32()), pa.array(num[col]), pa.array(leaf[col]), pa.array(sims[row, col])], names=["q", "num", "leaf", "sim"])

    ranked = Window.partitionBy("q").orderBy(F.desc(F.round("sim", 9)), "num")
    truth = rows.select("num", "vector", "leaf").mapInArrow(brute, "q int, num bigint, leaf bigint, sim double").withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= k)
    truth = truth.select("q", "leaf")
    home = {r["num"]: r["home"] for r in rows.where(F.col("num").isin(own)).select("num", "home").collect()}
    key = tree.keys(held)
    if subs is None:
        found = [(r["q"], r["leaf"], np.inf) for r in truth.collect()]  # k rows a held-out query
    else:
        queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(held)], "q int, vector array<float>")
        pairs = truth.join(queries, "q").select(F.floor(F.col("leaf") / SUB).alias("cell"), F.col("q").cast("bigint").alias("num"), "leaf", "vector")

        def inside(t: pa.Table, sub: Tree) -> pa.Table:
            keys = sub.keys(matrix(t["vector"], np.float32))
            leaf = np.asarray(t["leaf"]) % SUB - 1
            return pa.table({"q": t["num"], "leaf": t["leaf"], "key": keys[np.arange(len(leaf)), leaf].astype(float)})

        below = _with_trees(pairs, subs, inside, "q bigint, leaf bigint, key double").unionByName(pairs.join(subs.select("cell"), "cell", "left_anti").select(F.col("num").alias("q"), "leaf", F.lit(float("inf")).alias("key")))
        found = [(r["q"], r["leaf"], r["key"]) for r in below.collect()]
    short = [(q < held_out, max(0.0, home[own[q]] - min(float(key[q, leaf // SUB]), sub))) for q, leaf, sub in found]
    groups = [g for new in (True, False) if len(g := np.sort([d for is_new, d in short if is_new is new]))]
    if not groups:
        return 2.0, 1.0
    slack = max(float(g[min(len(g) - 1, math.ceil(target_recall * len(g)) - 1)]) for g in groups) + 1e-6
    return slack, min(float((g <= slack).mean()) for g in groups)


_VISIT = "num bigint, vector array<float>, block bigint, cells array<bigint>, least double, leaf bigint"


def _blocks(index: Index) -> np.ndarray:
    """By first-level leaf the block it is in: BLOCK_LEAVES that follow one another, of leaves with trees as many as have BLOCK members."""
    n = index.tree.n_leaves
    if index.subs is None:
        return np.arange(n) // BLOCK_LEAVES
    sizes = np.zeros(n, dtype=np.int64)
    for r in index.rows.groupBy(F.floor(F.col("leaf") / SUB).alias("cell")).count().collect():  # a row per leaf of the first level
        sizes[r["cell"]] = r["count"]
    out, block, held = np.zeros(n, dtype=np.int64), 0, 0
    for cell, size in enumerate(sizes):
        if held and held + size > BLOCK:
            block, held = block + 1, 0
        out[cell], held = block, held + size
    return out


def _visits(index: Index, blocks: np.ndarray) -> DataFrame:
    """(num, vector, block, cells, least, leaf): where each vector looks, a row per block, down to what promise, and its own leaf."""
    spark, slack = index.rows.sparkSession, index.slack
    shared = spark.sparkContext.broadcast((index.tree.packed(), blocks))  # at most SAMPLE / LEAF_SAMPLE leaves, BRANCHES tops each

    def run(batches):
        packed, blocks = shared.value
        tree = Tree.unpacked(packed)
        for b in batches:
            x, least, own = matrix(b.column("vector"), np.float32), np.asarray(b.column("home")) - slack, np.asarray(b.column("leaf"))
            row, cell = _opened(tree, x, least.astype(np.float32), own // SUB)
            block = blocks[cell]
            new = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(block) != 0)])) if len(row) else np.zeros(0, int)
            ends = np.concatenate([new, [len(row)]])
            for lo in range(0, len(new), PIECE):  # a vector is copied for each block, so a batch grows with what it visits
                some, to = new[lo : lo + PIECE], ends[lo : lo + PIECE + 1]
                at = pa.array(row[some])
                cells = pa.ListArray.from_arrays(pa.array((to - to[0]).astype(np.int32)), pa.array(cell[to[0] : to[-1]]))
                yield pa.RecordBatch.from_arrays([b.column("num").take(at), b.column("vector").take(at), pa.array(block[some]), cells, pa.array(least[row[some]]), pa.array(own[row[some]])], names=["num", "vector", "block", "cells", "least", "leaf"])

    return index.rows.select("num", "vector", "leaf", "home").mapInArrow(run, _VISIT)


#: What meets in a block: members, visitors and the trees of its leaves (num is then the leaf's number).
_MET = {"num": "bigint", "vector": "array<float>", "block": "bigint", "cells": "array<bigint>", "least": "double", "leaf": "bigint", "tree": "binary"}


def _wanted(trees: dict[int, Tree], x: np.ndarray, row: np.ndarray, cell: np.ndarray, least: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf), sorted by leaf: the leaves of the trees below the cells that rows look into, their own in any case."""
    rows, leaves = [np.zeros(0, int)], [np.zeros(0, np.int64)]
    for c in np.unique(cell):
        r = row[cell == c]
        if (tree := trees.get(int(c))) is None:
            rows.append(r)
            leaves.append(np.full(len(r), c * SUB))
            continue
        at, leaf, _ = open_bins(tree, x[r], least[r].astype(np.float32))
        home = r[own[r] // SUB == c]
        both = np.unique(np.stack([np.concatenate([c * SUB + leaf + 1, own[home]]), np.concatenate([r[at], home])]), axis=1)
        leaves.append(both[0])
        rows.append(both[1])
    return np.concatenate(rows), np.concatenate(leaves)


def class_neighbours(index: Index, k: int) -> DataFrame:
    """(num, near): of each distinct vector the k most similar others, structs (far, num), best first; far is
    the negative similarity, rounded to 9 decimals."""
    if index.tree is None:
        return index.rows.select("num", F.array().cast("array<struct<far:double,num:bigint>>").alias("near"))
    blocks = _blocks(index)
    of_cell = F.broadcast(index.rows.sparkSession.createDataFrame(list(enumerate(blocks.tolist())), "cell bigint, block bigint"))  # a row per leaf of the first level
    members = index.rows.select("num", "vector", "leaf", F.floor(F.col("leaf") / SUB).alias("cell")).join(of_cell, "cell")
    visits = durable(_visits(index, blocks))
    # blocks with more members or visitors than a task compares are parted, both ways
    count = lambda df, name: df.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    crowded = durable(count(members, "m").join(count(visits, "v"), "block").where("m > 1 or v > 1"))
    parted = lambda df: df.join(crowded, "block", "left").fillna(1, ["m", "v"])
    hashed = lambda n: F.pmod(F.xxhash64("num"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    here = lambda df, of, *more: df.select(*(c if c in of else F.lit(None).cast(kind).alias(c) for c, kind in _MET.items()), *more)
    there = here(parted(members), ["num", "vector", "block", "leaf"], hashed("m").alias("mpart"), spread("v").alias("vpart"), F.lit(False).alias("asks"))
    come = here(parted(visits), ["num", "vector", "block", "cells", "least", "leaf"], spread("m").alias("mpart"), hashed("v").alias("vpart"), F.lit(True).alias("asks"))
    there = there.unionByName(come)
    if index.subs is not None:
        trees = parted(index.subs.select("cell", "tree").join(of_cell, "cell")).withColumn("mpart", spread("m"))
        there = there.unionByName(here(trees.withColumnRenamed("cell", "num"), ["num", "block", "tree"], "mpart", spread("v").alias("vpart"), F.lit(None).cast("boolean").alias("asks")))

    def compare(t: pa.Table) -> pa.Table:
        asks, tree = t["asks"].combine_chunks(), t.filter(pa.compute.is_null(t["asks"]))
        trees = {c: Tree.unpacked(p) for c, p in zip(tree["num"].to_pylist(), tree["tree"].to_pylist())}
        q, m = t.filter(asks), t.filter(pa.compute.invert(asks)).select(["num", "vector", "leaf"]).sort_by([("leaf", "ascending"), ("num", "ascending")])
        x, y = matrix(q["vector"]), matrix(m["vector"])
        qnum, mnum, mleaf = np.asarray(q["num"]), np.asarray(m["num"]), np.asarray(m["leaf"])
        least, own = np.asarray(q["least"]), np.asarray(q["leaf"])
        lens = np.asarray(pa.compute.list_value_length(q["cells"]), dtype=np.int64) if len(x) else np.zeros(0, np.int64)
        cell, at = np.asarray(pa.compute.list_flatten(q["cells"])), np.concatenate([[0], np.cumsum(lens)])
        kept = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        for first in range(0, len(x), 2_048):
            last = min(len(x), first + 2_048)
            row, want = _wanted(trees, x, np.repeat(np.arange(first, last), lens[first:last]), cell[at[first] : at[last]], least, own)
            starts = np.flatnonzero(np.concatenate([[True], want[1:] != want[:-1]])) if len(want) else []
            got = [kept[0]]
            for a, b in zip(starts, [*starts[1:], len(want)]):
                lo, hi = np.searchsorted(mleaf, [want[a], want[a] + 1])
                few = max(1, CELLS // max(1, hi - lo))
                for r in (row[c : min(b, c + few)] for c in range(a, b if hi > lo else a, few)):
                    sims = x[r] @ y[lo:hi].T
                    same = np.searchsorted(mnum[lo:hi], qnum[r])
                    ok = (same < hi - lo) & (mnum[lo:hi][np.minimum(same, hi - lo - 1)] == qnum[r])
                    sims[np.flatnonzero(ok), same[ok]] = -9
                    i, j = _best(sims, k)
                    got.append((r[i], j + lo, np.round(sims[i, j], 9)))
            i, j, s = (np.concatenate(p) for p in zip(*got))
            order = np.lexsort((mnum[j], -s, i))
            i, j, s = i[order], j[order], s[order]
            keep = np.arange(len(i)) - np.searchsorted(i, i) < k
            kept.append((i[keep], j[keep], s[keep]))
        i, j, s = (np.concatenate(p) for p in zip(*kept))
        ends = np.searchsorted(i, np.arange(len(x) + 1)).astype(np.int32)
        near = pa.StructArray.from_arrays([pa.array(-s), pa.array(mnum[j] if len(j) else np.zeros(0, np.int64))], names=["far", "num"])
        return pa.table({"num": pa.array(qnum, pa.int64()), "near": pa.ListArray.from_arrays(ends, near)})

    # GROUPS meetings to a task at most, on the mean: with fewer tasks their sort fills the executor and spills
    meets = crowded.agg(F.sum(F.col("m") * F.col("v"))).first()[0] or 0
    if meets > GROUPS * int(there.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        there = there.repartition(meets // GROUPS, "block", "mpart", "vpart")
    met = there.groupBy("block", "mpart", "vpart").applyInArrow(compare, "num bigint, near array<struct<far:double,num:bigint>>")
    found = durable(met.groupBy("num").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k).alias("near")))
    # where the leaves that a vector visits have fewer than k others, it is compared with all
    few = found.where(F.size("near") < min(k, found.count() - 1)).select("num")
    if few.isEmpty():
        return found
    asked = index.rows.select("num", "vector").join(few, "num", "left_semi")
    return found.join(few, "num", "left_anti").unionByName(brute_force(asked, index.rows.select("num", "vector"), k))


def brute_force(queries: DataFrame, rows: DataFrame, k: int, block: int = 2_048) -> DataFrame:
    """(num, near) of each query (num, vector) by comparison with all ``rows``, as ``class_neighbours`` gives them.
    Queries and rows meet in pairs of blocks, so neither is ever held as a whole."""

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("num")
        return pa.table({"b": [t["b"][0].as_py()], "nums": [np.asarray(t["num"]).tobytes()], "x": [matrix(t["vector"]).tobytes()]})

    def packed(df: DataFrame, step: int) -> DataFrame:
        placed = numbered(df, "place", "num").select(F.floor(F.col("place") / step).alias("b"), "num", "vector")
        return durable(placed.groupBy("b").applyInArrow(pack, "b bigint, nums binary, x binary"))

    asked, there = packed(queries, block), packed(rows, 2 * block)
    last = asked.agg(F.max("b")).first()[0]
    if last is None:
        return queries.select("num", F.array().cast("array<struct<far:double,num:bigint>>").alias("near"))

    def meet(batches):
        for b in batches:
            for r in b.to_pylist():
                q, m = np.frombuffer(r["qnums"], np.int64), np.frombuffer(r["nums"], np.int64)
                sims = np.frombuffer(r["qx"]).reshape(len(q), -1) @ np.frombuffer(r["x"]).reshape(len(m), -1).T
                sims[q[:, None] == m[None, :]] = -9
                i, j = _best(sims, k)
                ends = np.searchsorted(i, np.arange(len(q) + 1)).astype(np.int32)
                near = pa.StructArray.from_arrays([pa.array(-np.round(sims[i, j], 9)), pa.array(m[j])], names=["far", "num"])
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.ListArray.from_arrays(ends, near)], names=["num", "near"])

    pairs = there.select("nums", "x", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))).alias("qb"))
    met = pairs.join(asked.select(F.col("b").alias("qb"), F.col("nums").alias("qnums"), F.col("x").alias("qx")), "qb").repartition(F.xxhash64("qb", "nums")).mapInArrow(meet, "num bigint, near array<struct<far:double,num:bigint>>")
    return met.groupBy("num").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k).alias("near"))


def most_similar(vectors: DataFrame, k: int = 5, target_recall: float = 0.985) -> DataFrame:
    """(id, neighbour, rank, similarity): for every row its k most similar other rows by cosine.

    ``vectors``: (id, vector) as from ``usable_vectors``. Similarities are rounded to 9 decimals;
    on ties the smaller id comes first. Rows with the very same vector are searched once and answer
    for each other, so copies without bound cost one search. ``target_recall`` is the share of true
    neighbours that calibration has to reach on held-out queries. Fewer than k other rows give as
    many neighbours as there are; one row or none gives no rows.
    """
    classes = classes_of(vectors, k)
    return _of_rows(vectors, classes, class_neighbours(build_index(classes, k, target_recall), k), k)


def _of_rows(vectors: DataFrame, classes: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The neighbours of distinct vectors, as rows of ids."""
    firsts = classes.select("num", "first")
    struct = "array<struct<far:double,id:string>>"
    # candidates of a class: the first ids of itself and of its neighbours
    pool = (
        found.select("num", F.explode("near").alias("n"))
        .select("num", F.col("n.num").alias("other"), F.col("n.far").alias("far"))
        .join(firsts.select(F.col("num").alias("other"), "first"), "other")
        .groupBy("num")
        .agg(F.flatten(F.collect_list(F.transform("first", lambda i: F.struct(F.col("far"), i.alias("id"))))).alias("others"))
    )
    own = F.transform("first", lambda i: F.struct(F.lit(-1.0).alias("far"), i.alias("id")))
    candidates = firsts.join(pool, "num", "left").select("num", "first", F.sort_array(F.concat(own, F.coalesce("others", F.array().cast(struct)))).alias("near"))
    known = candidates.select(F.explode("first").alias("id"), "near")
    # the members beyond the first ones (of vectors shared by more than k + 1 rows) find their class by vector
    crowded = candidates.where(F.size("first") > k).join(classes.select("num", "vector"), "num").select("vector", "first", "near")
    rest = vectors.join(crowded, "vector").where(~F.array_contains("first", F.col("id"))).select("id", "near")
    mine = F.slice(F.filter("near", lambda s: s["id"] != F.col("id")), 1, k)
    return (
        known.unionByName(rest)
        .select("id", F.posexplode(mine))
        .select("id", F.col("col.id").alias("neighbour"), (F.col("pos") + 1).alias("rank"), (-F.col("col.far")).alias("similarity"))
    )


def recall(vectors: DataFrame, k: int = 5, target_recall: float = 0.985, every: int = 50, block: int = 2_048) -> DataFrame:
    """(queries, pairs, found, recall, calibrated, slack): the search against brute force, of every distinct vector whose
    number is divisible by ``every``, over all distinct vectors. ``calibrated`` is what the calibration's queries reached."""
    classes = classes_of(vectors, k)
    index = build_index(classes, k, target_recall)
    asked = F.col("num") % every == 0
    listed = lambda df: df.select("num", F.explode("near.num").alias("other"))
    got = listed(class_neighbours(index, k).where(asked)).withColumn("hit", F.lit(True))
    truth = listed(brute_force(classes.where(asked).select("num", "vector"), classes.select("num", "vector"), k, block))
    return truth.join(got, ["num", "other"], "left").agg(
        F.count_distinct("num").alias("queries"), F.count("*").alias("pairs"), F.count_if("hit").alias("found"), F.round(F.count_if("hit") / F.greatest(F.count("*"), F.lit(1)), 4).alias("recall")
    ).select("*", F.lit(round(index.recall, 4)).alias("calibrated"), F.lit(round(index.slack, 6)).alias("slack"))

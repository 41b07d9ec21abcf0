"""Filling fixed-capacity containers, by a grouping genetic algorithm on islands.

Items are dealt by hash into sub-problems of bounded size. Each sub-problem is solved by several
islands, groups of their own that evolve a population of packings: crossover injects whole
well-filled containers of one parent into the other, removes the items that these repeat, and puts
what was displaced back by best fit. Between rounds every island's elite migrates to the next one in
a ring, through a shuffle; the rounds of a pass are one plan, which writes no table on the way. The
best packing of a sub-problem wins; its poorly filled containers are emptied and their items meet
those of other sub-problems in a further pass.
"""

from __future__ import annotations

import bisect
import math
import random

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageatlas.session import durable

#: Items of one sub-problem, islands that solve it, rounds between migrations, packings of an island, crossovers of a round.
ITEMS, ISLANDS, ROUNDS, POPULATION, CROSSOVERS = 600, 3, 3, 8, 12
#: Islands that one task evolves in turn.
ISLANDS_A_TASK = 12
#: A container filled less than this after the first pass is emptied and its items are packed anew.
FULL_ENOUGH, PASSES = 0.98, 3


class Bin(list):
    """The items of a container, and how full they make it."""

    __slots__ = ("fill",)

    @classmethod
    def of(cls, sizes: dict[int, int], items: list[int]) -> Bin:
        b = cls(items)
        b.fill = items.fill if isinstance(items, Bin) else sum(sizes[i] for i in items)
        return b


def best_fit(sizes: dict[int, int], items: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Put ``items``, largest first, each into the fullest container that holds it."""
    bins[:] = [b if isinstance(b, Bin) else Bin.of(sizes, b) for b in bins]
    room = sorted((capacity - b.fill, k) for k, b in enumerate(bins))
    for i in sorted(items, key=lambda i: (-sizes[i], i)):
        at = bisect.bisect_left(room, (sizes[i], -1))
        if at == len(room):
            bins.append(Bin.of(sizes, [i]))
            bisect.insort(room, (capacity - sizes[i], len(bins) - 1))
        else:
            r, k = room.pop(at)
            bins[k].append(i)
            bins[k].fill += sizes[i]
            bisect.insort(room, (r - sizes[i], k))
    return bins


def fitness(sizes: dict[int, int], bins: list[list[int]], capacity: int) -> float:
    """Mean of squared fills: of packings with as many containers, the one whose waste is gathered in few."""
    return sum((Bin.of(sizes, b).fill if not isinstance(b, Bin) else b.fill) ** 2 for b in bins) / capacity**2 / max(1, len(bins))


def crossover(sizes: dict[int, int], a: list[list[int]], b: list[list[int]], capacity: int, rng: random.Random) -> list[list[int]]:
    """Inject some of the best-filled containers of ``a`` into ``b``; containers of ``b`` that share an item
    with them are broken up and what they lose is put back by best fit."""
    ranked = sorted((Bin.of(sizes, g) for g in a), key=lambda g: -g.fill)
    n = max(1, int(len(ranked) * rng.uniform(0.2, 0.6)))
    injected = ranked[:n]
    taken = {i for g in injected for i in g}
    kept, loose = [], []
    for g in b:
        if taken.isdisjoint(g):
            kept.append(Bin.of(sizes, g))
        else:
            loose.extend(i for i in g if i not in taken)
    # the least-filled container is broken up as well, as mutation
    if len(kept) > 1:
        worst = min(range(len(kept)), key=lambda k: kept[k].fill)
        loose.extend(kept.pop(worst))
    return best_fit(sizes, loose, injected + kept, capacity)


def evolve(sizes: dict[int, int], population: list[list[list[int]]], capacity: int, seed: int) -> list[list[list[int]]]:
    """One round of an island: fill the population up, cross, keep the fittest."""
    rng = random.Random(seed)
    items = sorted(sizes)
    total = sum(sizes.values())
    least = max(1, math.ceil(total / capacity))
    while len(population) < POPULATION:
        first = [i for i in items if rng.random() < 0.5] if population else items
        chosen = set(first)
        rest = [i for i in items if i not in chosen] if population else []
        bins = best_fit(sizes, first, [], capacity)
        rng.shuffle(rest)
        population.append(best_fit(sizes, rest, bins, capacity))
    scored = sorted(((fitness(sizes, p, capacity), k, p) for k, p in enumerate(population)), key=lambda s: (-s[0], s[1]))
    for step in range(CROSSOVERS):
        if len(scored[0][2]) <= least and scored[0][0] > 0.9995:
            break
        x, y = rng.sample(range(min(len(scored), POPULATION)), 2)
        child = crossover(sizes, scored[min(x, y)][2], scored[max(x, y)][2], capacity, rng)
        scored.append((fitness(sizes, child, capacity), len(scored) + step, child))
        scored.sort(key=lambda s: (-s[0], s[1]))
        del scored[POPULATION:]
    return [p for _, _, p in scored]


def _islands(items: DataFrame, seed: int, problems: int) -> DataFrame:
    """One pass over (kind, capacity, part, item, n) in so many parts: (kind, capacity, part, bin, members, fill)."""
    schema = "kind string, capacity bigint, part bigint, island int, fit double, bins array<array<bigint>>, items array<bigint>, sizes array<bigint>"
    start = items.groupBy("kind", "capacity", "part").agg(F.sort_array(F.collect_list(F.struct("item", "n"))).alias("x"))
    population = start.select(
        "kind", "capacity", "part", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"), F.lit(0.0).alias("fit"),
        F.array().cast("array<array<bigint>>").alias("bins"), F.col("x.item").alias("items"), F.col("x.n").alias("sizes"),
    )

    def one_round(number: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            row = pdf.iloc[0]
            sizes = dict(zip(map(int, row["items"]), map(int, row["sizes"])))
            came = sorted([list(map(int, g)) for g in bins] for bins in pdf["bins"] if len(bins))  # in whatever order they arrive
            s = hash((seed, number, int(row["part"]), int(row["island"]), int(row["capacity"])))  # of integers: the same in every process
            best = evolve(sizes, came, int(row["capacity"]), s)
            out = pdf.iloc[[0] * min(2, len(best))].copy()  # an island's elite goes on: to itself and to its neighbour
            out["fit"] = [fitness(sizes, p, int(row["capacity"])) for p in best[:2]]
            out["bins"] = [[g for g in p if g] for p in best[:2]]
            return out

        return run

    # a task is a handful of islands: by a number of its own, as by bytes they would all be one
    tasks = max(1, min(problems * ISLANDS // ISLANDS_A_TASK, 20_000))
    for number in range(ROUNDS):
        evolved = population.repartition(tasks, "kind", "capacity", "part", "island").groupBy("kind", "capacity", "part", "island").applyInPandas(one_round(number), schema)
        if number + 1 < ROUNDS:  # migration along the ring
            population = evolved.withColumn("island", F.explode(F.array("island", ((F.col("island") + 1) % ISLANDS).cast("int"))))
        else:
            population = evolved
    w = Window.partitionBy("kind", "capacity", "part").orderBy(F.desc("fit"), "island", F.hash("bins"))
    best = population.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    size_of = F.map_from_arrays("items", "sizes")
    return best.select("kind", "capacity", "part", size_of.alias("size_of"), F.posexplode("bins").alias("bin", "members")).select(
        "kind", "capacity", "part", "bin",
        F.transform("members", lambda i: F.struct(i.alias("item"), F.element_at("size_of", i).alias("n"))).alias("members"),
        (F.aggregate("members", F.lit(0).cast("bigint"), lambda a, i: a + F.element_at("size_of", i)) / F.col("capacity")).alias("fill"),
    )


def pack(sized: DataFrame, capacities: DataFrame, items_per_part: int = ITEMS, seed: int = 5) -> DataFrame:
    """(container_kind, container, doc_id, piece, start_token, n_tokens) for every document and kind.

    ``sized``: (doc_id, n_tokens); ``capacities``: (container_kind, capacity_tokens). Only a document
    longer than the capacity is split: into whole containers and a remainder, which is packed like any
    other item. Documents without tokens come out once per kind with a null container. Kinds without a
    positive capacity are left out. No document is lost or repeated, and no container overfilled.
    """
    kinds = capacities.where((F.col("capacity_tokens") > 0) & F.col("container_kind").isNotNull()).groupBy(F.col("container_kind").alias("kind")).agg(
        F.max("capacity_tokens").cast("bigint").alias("capacity")
    )
    docs = sized.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"))
    each = durable(docs.crossJoin(F.broadcast(kinds)))  # a row per container kind, a handful
    whole = F.floor(F.col("n_tokens") / F.col("capacity"))
    empty = each.where("n_tokens = 0").select(
        F.col("kind").alias("container_kind"), F.lit(None).cast("string").alias("container"), "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start_token"), "n_tokens"
    )
    filled = each.where("n_tokens >= capacity").select("kind", "capacity", "doc_id", F.explode(F.sequence(F.lit(0), (whole - 1).cast("int"))).alias("piece")).select(
        F.col("kind").alias("container_kind"), F.concat_ws("-", "kind", F.lit("w"), "doc_id", "piece").alias("container"), "doc_id", "piece",
        (F.col("piece") * F.col("capacity")).cast("bigint").alias("start_token"), F.col("capacity").alias("n_tokens"),
    )
    rest = each.select("kind", "capacity", F.col("doc_id").alias("item"), (F.col("n_tokens") % F.col("capacity")).alias("n")).where("n > 0")

    done = None
    left = rest
    for number in range(PASSES):
        count = left.groupBy("kind").agg(F.count("*").alias("items_of_kind"))
        parts = F.greatest(F.floor(F.col("items_of_kind") / items_per_part), F.lit(1))
        dealt = left.join(F.broadcast(count), "kind").withColumn("part", F.pmod(F.xxhash64(F.lit(seed + number), "item"), parts)).select("kind", "capacity", "part", "item", "n")
        bins = _islands(dealt, seed + number, count.agg(F.sum(parts)).first()[0] or 0)
        last = number + 1 == PASSES
        bins = durable(bins.withColumn("keep", F.lit(True) if last else F.col("fill") >= FULL_ENOUGH))
        kept = bins.where("keep").select(
            F.col("kind").alias("container_kind"), F.concat_ws("-", "kind", F.lit(f"p{number}"), "part", "bin").alias("container"), F.col("capacity"), F.explode("members").alias("m")
        ).select("container_kind", "container", "capacity", F.col("m.item").alias("doc_id"), F.col("m.n").alias("n"))
        done = kept if done is None else done.unionByName(kept)
        if last:
            break
        left = durable(bins.where(~F.col("keep")).select("kind", "capacity", F.explode("members").alias("m")).select("kind", "capacity", F.col("m.item").alias("item"), F.col("m.n").alias("n")))
        if left.isEmpty():
            break
    packed = done.join(docs, "doc_id").select(
        "container_kind", "container", "doc_id", F.floor(F.col("n_tokens") / F.col("capacity")).cast("int").alias("piece"),
        (F.col("n_tokens") - F.col("n")).cast("bigint").alias("start_token"), F.col("n").alias("n_tokens"),
    )
    return packed.unionByName(filled).unionByName(empty)


def pack_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(container_kind, capacity_tokens, containers, tokens, least_containers, fill): how well each kind
    is filled; ``least_containers`` is the bound that no packing can go below."""
    used = packed.where(F.col("container").isNotNull()).groupBy("container_kind").agg(F.count_distinct("container").alias("containers"), F.sum("n_tokens").alias("tokens"))
    caps = capacities.groupBy("container_kind").agg(F.max("capacity_tokens").cast("bigint").alias("capacity_tokens"))
    return used.join(caps, "container_kind").select(
        "container_kind", "capacity_tokens", "containers", "tokens",
        F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"),
        F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4).alias("fill"),
    )

"""Histogram trees over a binned table: boosted leaf by leaf or level by level, and extremely random.

The feature rows are binned once (exact values where a feature has few, quantiles otherwise; bin 0 is for missing values).
Rows of equal bins are the same to every tree, so they are packed into one with their number and the sum of their targets;
where rows are drawn by chance, only those whose targets are equal too, and of n equal rows a binomial (in a bootstrap: Poisson)
number is drawn. All growth goes by sums per (node, feature, bin), which tasks make of blocks of packed rows:

* **Boosting** asks for the sums of the nodes that may be split next, of the smaller child of each only: the larger one's
  are its parent's less its sibling's. What it keeps depends on leaves, features and bins, not on rows. ``leaves`` grows
  best gain first; without it a tree grows level by level. Each split learns where missing values go.
* **Random trees** are independent. A threshold is drawn per node and feature between the node's least and largest value,
  by a generator that is seeded by tree and node; the best draw is taken.

``bootstrap`` draws the rows of each tree with replacement and takes the best of all splits instead.

Up to HELD_ROWS packed rows are bytes that one task holds: it goes through all steps of a boosted model. Random trees of up to 32
times as many rows are dealt to tasks. Larger tables are boosted by tasks that run side by side, each with a part of the rows: they
add up their sums of each step (:mod:`panelcast.models.gang`) and go through all steps together. Tables too large for that stay
spread, and every step is a job over all blocks. A level of many random trees is one too, whose sums are shuffled by node so that
only the chosen splits leave the executors.

Targets and gradients are rounded to a grid on which sums of all rows are exact, so results do not depend on the order of sums.
The present predictions of spread rows are kept with them, a new RDD per tree; every REBROADCAST trees it is checkpointed.
"""

from __future__ import annotations

import base64
import json
import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models.gang import Gang, remove, shared_folder, slots
from panelcast.models.growth import Held, Shared, Tree, bagged_rows, binned, boost, both_ways, drawn_rows, forest_split, leaf_of, level_sums, node_sums, one_random_tree
from panelcast.staging import ensure_checkpoint_dir, ship

#: Rows of a block and of a task, trees whose level is one job, boosted trees between two checkpoints.
BLOCK_ROWS, TASK_ROWS, FOREST_BATCH, REBROADCAST = 1 << 16, 1 << 16, 32, 25
#: Packed rows up to which one task holds the table; of tasks that run side by side, which hold some 100 bytes per row.
HELD_ROWS, GANG_ROWS = 1 << 17, 1 << 22


def a_part_per_core(rows: DataFrame) -> DataFrame:
    """For sketches: one task merges those of all partitions, which takes seconds for every few dozen."""
    return rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def feature_edges(rows: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Upper limits of each feature's bins but the last: between neighbouring values, or at quantiles."""
    numbers = rows.select([F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in features])
    shares = [i / bins for i in range(1, bins)]
    quantiles = a_part_per_core(numbers).agg(*[F.percentile_approx(c, shares, 100 * bins).alias(c) for c in features]).first()
    edges = []
    for c in features:
        some = numbers.select(c).where(F.col(c).isNotNull()).distinct().limit(bins + 1).collect()  # bins + 1 numbers
        values = np.sort([r[0] for r in some]) if len(some) <= bins else np.unique(quantiles[c])
        edges.append((values[1:] + values[:-1]) / 2 if len(some) <= bins else values)
    return edges


def packed_rows(rows: DataFrame, features: list[str], edges: list[np.ndarray], low: float, grid: float, middle: int, by_target: bool) -> DataFrame:
    """Rows of equal bins once (with ``by_target``: of equal bins and targets), with the sum of their targets and their number.

    A column ``k`` holds the bins of eight features; targets are steps of the grid from ``low``, less ``middle``.
    """
    names = [f"k{i}" for i in range(-(-len(features) // 8))]

    def run(batches):
        for batch in batches:
            bins = np.zeros((batch.num_rows, 8 * len(names)), np.uint8)
            values = [batch.column(c).to_pandas().to_numpy(np.float64, na_value=np.nan) for c in features]
            bins[:, : len(features)] = binned(np.stack(values), edges).T
            target = np.rint((batch.column("y").to_numpy(zero_copy_only=False) - low) * grid).astype(np.int64) - middle
            keys = bins.view("<i8")
            yield pa.RecordBatch.from_arrays([*[pa.array(keys[:, i]) for i in range(len(names))], pa.array(target)], [*names, "t"])

    plain = rows.select(F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in features])
    steps = plain.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "t"]))
    if by_target:
        return steps.groupBy(*names, "t").agg(F.count("*").alias("n")).select(*names, (F.col("t") * F.col("n")).alias("s"), "n")
    return steps.groupBy(*names).agg(F.sum("t").alias("s"), F.count("*").alias("n"))


def blocks_of(packed: DataFrame, features: int):
    """An RDD of (bins: features x rows, sums of targets, numbers of rows)."""

    def run(batches):
        tables = list(batches)
        if not tables:
            return
        table = pa.Table.from_batches(tables)
        keys = np.stack([table.column(c).to_numpy() for c in table.column_names[:-2]])
        s, n = (table.column(c).to_numpy() for c in ("s", "n"))
        order = np.lexsort([s, *keys])  # rows of a shuffle come in any order
        x = np.ascontiguousarray(keys[:, order].T).astype("<i8").view(np.uint8)[:, :features].T
        for at in range(0, len(s), BLOCK_ROWS):
            part = order[at : at + BLOCK_ROWS]
            columns = (np.ascontiguousarray(x[:, at : at + BLOCK_ROWS]), s[part].astype(np.float64), n[part].astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()]) for c in columns], ["x", "s", "n"])

    whole = packed.mapInArrow(run, "x binary, s binary, n binary")
    return whole.rdd.map(lambda r: (np.frombuffer(bytes(r["x"]), np.uint8).reshape(features, -1), np.frombuffer(bytes(r["s"])), np.frombuffer(bytes(r["n"]))))


class Spread:
    """Sums of the blocks of an RDD, a job each time. The present predictions are kept with the blocks, a new RDD per tree."""

    def __init__(self, blocks, bins: int, p: dict, grid: float):
        self.bins, self.p, self.grid, self.number = bins, p, grid, 0
        self.rows, self.before = blocks.map(lambda b: (*b, np.zeros(len(b[1])))), None

    def begin(self, number: int) -> None:
        self.number = number

    def sums(self, tree: dict, split: list[int], nodes: list[int], features: np.ndarray) -> np.ndarray:
        grid, bins, share, seed, number = self.grid, self.bins, self.p.get("rows", 1.0), self.p["seed"], self.number
        slots = np.full(len(tree["value"]), -1, np.int64)
        slots[nodes] = np.arange(len(nodes))

        def run(partition, blocks):
            total = np.zeros((len(nodes), len(features), bins, 2))
            for i, (x, s, n, margin) in enumerate(blocks):
                gradient, weight = drawn_rows(margin, s, n, grid, share, [seed, number, partition, i])
                slot = slots[leaf_of(tree, both_ways(x))]
                rows = np.flatnonzero((slot >= 0) & (weight > 0))
                total += node_sums(x, rows, gradient[rows], weight[rows], slot[rows], len(nodes), features, bins)
            yield total

        parts = self.rows.mapPartitionsWithIndex(run).collect()  # as many numbers as nodes and bins, from each task
        if self.before is not None:
            self.before.unpersist()
            self.before = None
        return sum(parts[1:], parts[0])

    def end(self, tree: dict, place: np.ndarray) -> None:
        if self.before is not None:
            self.before.unpersist()
        after = self.rows.map(lambda b: (*b[:3], b[3] + tree["value"][leaf_of(tree, both_ways(b[0]))])).persist(StorageLevel.MEMORY_AND_DISK)
        if (self.number + 1) % REBROADCAST == 0:
            after.checkpoint()
        self.rows, self.before = after, self.rows if self.number else None

    def close(self) -> None:
        for rdd in (self.rows, self.before):
            if rdd is not None and rdd.is_cached:
                rdd.unpersist()


def gradient_grid(n: float, span: float) -> float:
    """Steps per unit: sums of n numbers up to twice ``span`` stay below 2 ** 53 of them."""
    return 2.0 ** (50 - math.ceil(math.log2(max(n, 1))) - math.ceil(math.log2(span if span > 1e-200 else 1.0)))


def spread_random_trees(blocks, edges: list[np.ndarray], p: dict, bins: int, base: float, grid: float) -> list[dict]:
    """Independent trees on all rows, a level of FOREST_BATCH trees per job."""
    depth, least, out = p["depth"], p.get("leaf", 1), []
    for begin in range(0, p["trees"], FOREST_BATCH):
        numbers = range(begin, min(begin + FOREST_BATCH, p["trees"]))
        trees, front = {t: Tree() for t in numbers}, {t: [0] for t in numbers}
        for t in numbers:
            trees[t].add(0.0)

        def bag(partition, part, numbers=numbers):
            for k, (x, s, n) in enumerate(part):
                weights = None
                if p.get("bootstrap"):
                    weights = np.stack([fitting(bagged_rows(s, n, p, [p["seed"], t, partition, k])[1]) for t in numbers])
                yield x, s, n, weights

        # drawn once for all levels: a byte per row and tree
        bagged = blocks.mapPartitionsWithIndex(bag)
        bagged = bagged.persist(StorageLevel.MEMORY_AND_DISK) if p.get("bootstrap") else bagged
        for level in range(depth + 1):
            sent = blocks.context.broadcast({t: (trees[t].arrays(), front[t]) for t in numbers if front[t]})

            def run(part, sent=sent):
                blocks = list(part)  # at most 32 x TASK_ROWS rows
                twice = [(x, both_ways(x)) for x, *_ in blocks]
                for t, (tree, nodes) in sent.value.items():

                    def drawn(k, t=t):
                        _, s, n, weights = blocks[k]
                        if weights is None:
                            return s, n
                        weight = weights[t - begin].astype(np.float64)
                        return s / n * weight, weight

                    for node, sums in level_sums(twice, tree, nodes, drawn, len(edges), bins):
                        yield (t, node), sums

            def choose(item, last=level == depth):
                (t, node), sums = item
                total = sums[0].sum(0)
                split = None if last or total[1] < 2 * least else forest_split(sums / [grid, 1.0], edges, p, [p["seed"], t, node])
                return t, node, base + total[0] / grid / total[1], split

            found = bagged.mapPartitions(run).reduceByKey(np.add).map(choose).collect()  # a row per node of the model
            front = {t: [] for t in numbers}
            for t, node, mean, split in sorted(found, key=lambda r: r[:2]):
                trees[t].nodes["value"][node] = mean
                if split:
                    front[t] += trees[t].split(node, *split, 0.0, 0.0)
            sent.unpersist()
            if not any(front.values()):
                break
        if p.get("bootstrap"):
            bagged.unpersist()
        out += [trees[t].arrays() for t in numbers]
    return out


def fitting(weight: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as they need."""
    return weight.astype(np.min_scalar_type(int(weight.max(initial=0.0))))


def table(parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One block of several."""
    x, s, n = zip(*parts)
    x, s, n = np.concatenate(x, axis=1), np.concatenate(s), np.concatenate(n)
    order = np.lexsort([s, *x])  # so that draws do not depend on the partitions
    return x[:, order], s[order], n[order]


def boost_side_by_side(packed: DataFrame, features: int, bins: int, p: dict, grid: float, tasks: int, folder: str) -> list[dict]:
    """The trees of a table that ``tasks`` tasks hold. Rows go to tasks by what they are, so that draws are the same again."""

    def run(batches):
        gang = Gang.of_stage(folder)
        x, s, n = table([(np.zeros((features, 0), np.uint8), np.zeros(0), np.zeros(0)), *map(block_of, batches)])
        trees = boost(Shared(x, s, n, bins, p, grid, gang=gang), features)
        if gang.rank == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees)], pa.binary())], ["trees"])

    def block_of(batch):
        *keys, s, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        return np.stack(keys, 1).astype("<i8").view(np.uint8)[:, :features].T, s.astype(np.float64), n.astype(np.float64)

    dealt = packed.repartitionById(tasks, F.pmod(F.hash(*packed.columns), F.lit(tasks)))
    try:
        return pickle.loads(dealt.mapInArrow(run, "trees binary", barrier=True).collect()[0]["trees"])
    finally:
        remove(folder)


def fit_trees(packed: DataFrame, rows: int, edges: list[np.ndarray], p: dict, boosted: bool, base: float, grid: float) -> list[dict]:
    """The trees of ``rows`` packed rows: of one task that holds the table, of tasks side by side, or of a job for each step.

    All take the same sums, so they find the same trees (but for the rows that are drawn by chance).
    """
    context, bins = packed.sparkSession.sparkContext, max(len(e) for e in edges) + 2

    if boosted and rows > HELD_ROWS:
        tasks = min(slots(context), -(-rows // (HELD_ROWS // 4 or TASK_ROWS)))
        folder = shared_folder(packed.sparkSession) if tasks > 1 and rows <= tasks * GANG_ROWS else None
        if folder:
            return boost_side_by_side(packed, len(edges), bins, p, grid, tasks, folder)
    if rows <= (HELD_ROWS if boosted else 32 * HELD_ROWS):
        blocks = blocks_of(packed.coalesce(1 if boosted else max(1, -(-rows // TASK_ROWS))), len(edges))
        if boosted:
            fit = lambda parts: [boost(Held(*table(parts), bins, p, grid), len(edges))]
            return blocks.mapPartitions(fit).collect()[0]
        sent = context.broadcast(table(blocks.collect()))  # 22 bytes of each of 32 x HELD_ROWS rows at most
        numbers = context.parallelize(range(p["trees"]), min(p["trees"], 4 * context.defaultParallelism))
        trees = numbers.map(lambda t: one_random_tree(*sent.value, edges, p, bins, base, grid, t)).collect()
        sent.unpersist()
        return trees
    ensure_checkpoint_dir(packed.sparkSession)
    # a task per core, as long as its rows stay few enough to hold
    tasks = min(-(-rows // TASK_ROWS), max(context.defaultParallelism, -(-rows // (32 * TASK_ROWS))))
    blocks = blocks_of(packed.coalesce(tasks), len(edges)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not boosted:
            return spread_random_trees(blocks, edges, p, bins, base, grid)
        source = Spread(blocks, bins, p, grid)
        try:
            return boost(source, len(edges))
        finally:
            source.close()
    finally:
        blocks.unpersist()


def to_text(state: dict) -> str:
    """A model as text: its numbers, and per tree the arrays of its nodes."""

    def plain(v):
        return {"kind": v.dtype.str, "data": base64.b64encode(v.tobytes()).decode()} if isinstance(v, np.ndarray) else v

    return json.dumps({**state, "edges": [plain(e) for e in state["edges"]], "trees": [{k: plain(v) for k, v in t.items()} for t in state["trees"]]})


def from_text(text: str) -> dict:
    def full(v):
        return np.frombuffer(base64.b64decode(v["data"]), np.dtype(v["kind"])) if isinstance(v, dict) else v

    state = json.loads(text)
    return {**state, "edges": [full(e) for e in state["edges"]], "trees": [{k: full(v) for k, v in t.items()} for t in state["trees"]]}


class TreeEnsembleModel(Model, DefaultParamsWritable, DefaultParamsReadable):
    """Adds ``prediction``: ``base`` and ``scale`` times the sum of all trees' values."""

    state = Param(Params._dummy(), "state", "the ensemble as text", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def content(self) -> dict:
        return from_text(self.getOrDefault(self.state))

    #: Chained in one plan, every step would hold a worker of its own.
    runs_in_workers = True

    @property
    def accepts_missing(self) -> bool:
        return bool(self.content["missing"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship(dataset.sparkSession)
        content = self.content
        given = dataset.sparkSession.sparkContext.broadcast(content)  # as large as the model

        @F.pandas_udf("double")
        def predict(rows: pd.DataFrame) -> pd.Series:
            model = given.value
            twice = both_ways(binned(rows.to_numpy(np.float64, na_value=np.nan).T, model["edges"]))
            total = np.zeros(len(rows))
            for tree in model["trees"]:
                total += tree["value"][leaf_of(tree, twice)]
            return pd.Series(model["base"] + model["scale"] * total)

        columns = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(content["features"])]
        return dataset.withColumn("prediction", predict(F.struct(*columns)))


class HistogramTrees(Estimator):
    """Fits ``y`` on some columns. ``p``: trees, seed, bins; depth, leaf; boosted: rate, leaves, l2, rows, cols, missing."""

    def __init__(self, p: dict, features: list[str], boosted: bool = True):
        super().__init__()
        self.p, self.features, self.boosted = p, features, boosted

    def _fit(self, dataset: DataFrame) -> TreeEnsembleModel:
        dataset = dataset.where("y IS NOT NULL AND NOT isnan(y)")
        y = F.col("y").cast("double")
        rows, low, high = dataset.agg(F.count("*"), F.min(y), F.max(y)).first()
        if not rows:
            raise ValueError("no rows to fit trees on")
        edges = feature_edges(dataset, self.features, self.p.get("bins", 254))
        ship(dataset.sparkSession)
        grid = gradient_grid(rows, high - low)
        total = dataset.agg(F.sum(F.rint((y - F.lit(low)) * F.lit(grid)).cast("long"))).first()[0]
        middle = round(total / rows)  # the mean, on the grid: else all gradients of a first tree round the same way
        base = low + middle / grid
        by_target = self.p.get("rows", 1.0) < 1.0 or bool(self.p.get("bootstrap"))
        packed = packed_rows(dataset, self.features, edges, low, grid, middle, by_target).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trees = fit_trees(packed, packed.count(), edges, self.p, self.boosted, base, grid)
        finally:
            packed.unpersist()
        base = base if self.boosted else 0.0
        scale = 1.0 if self.boosted else 1.0 / len(trees)
        state = {"features": self.features, "edges": edges, "trees": trees, "base": base, "scale": scale, "missing": bool(self.p.get("missing"))}
        return TreeEnsembleModel(state=to_text(state))

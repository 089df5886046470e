import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel

from panelcast.models import gang
from panelcast.models import growth as g
from panelcast.models import trees as t

FEATURES = ["a", "b", "c"]
LEAVES = {"trees": 4, "rate": 0.5, "leaves": 9, "leaf": 3, "seed": 7}
LEVELS = {"trees": 4, "rate": 0.5, "depth": 3, "l2": 1.0, "leaf": 1, "seed": 7}
RANDOM = {"trees": 5, "depth": 5, "leaf": 2, "seed": 7}


def frame(n=400, seed=0, missing=0.2):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 12, n).astype(float), rng.normal(size=n).round(2), rng.integers(0, 3, n).astype(float)
    y = np.round(3 * (a > 5) + b * (c == 1) + rng.normal(scale=0.3, size=n), 3)
    a[rng.random(n) < missing] = np.nan
    y[np.isnan(a)] += 2
    return np.stack([a, b, c]), y


def table(spark, x, y, parts=3):
    rows = [(float(v), *[None if np.isnan(f) else float(f) for f in r]) for v, r in zip(y, x.T)]
    return spark.createDataFrame(rows, "y double, a double, b double, c double").repartition(parts)


def brute_best(x, g, l2, least):
    """The best gain over all thresholds and both ways for missing values."""
    best = 0.0
    score = lambda m: g[m].sum() ** 2 / (m.sum() + l2)
    for f in x:
        gone = np.isnan(f)
        for limit in np.unique(f[~gone]):
            for left in ((f <= limit), (f <= limit) | gone):
                if left.sum() >= least and (~left).sum() >= least:
                    best = max(best, score(left) + score(~left) - score(np.ones(len(g), bool)))
    return best


def gain_of(tree, node, masks, g, l2):
    score = lambda m: g[m].sum() ** 2 / (m.sum() + l2)
    return score(masks[tree["left"][node]]) + score(masks[tree["right"][node]]) - score(masks[node])


def rows_of_nodes(tree, x, edges):
    masks = {0: np.ones(x.shape[1], bool)}
    for node in range(len(tree["value"])):
        if tree["feature"][node] >= 0:
            f = x[tree["feature"][node]]
            limit = np.append(edges[tree["feature"][node]], np.inf)[tree["bin"][node] - 1]
            left = np.where(np.isnan(f), tree["missing_left"][node], f <= limit)
            masks[tree["left"][node]], masks[tree["right"][node]] = masks[node] & left, masks[node] & ~left
    return masks


@pytest.mark.parametrize("p", [LEAVES, LEVELS])
def test_splits_are_the_best_ones(spark, p):
    x, y = frame(200)
    model = t.HistogramTrees(p, FEATURES).fit(table(spark, x, y))
    content, margin = model.content, np.full(len(y), y.mean())
    for tree in content["trees"]:
        masks, g, l2 = rows_of_nodes(tree, x, content["edges"]), margin - y, p.get("l2", 0.0)
        for node in np.flatnonzero(tree["feature"] >= 0):
            m = masks[node]
            assert gain_of(tree, node, masks, g, l2) == pytest.approx(brute_best(x[:, m], g[m], l2, p["leaf"]), rel=1e-6)
        leaves = np.flatnonzero(tree["feature"] < 0)
        for leaf in leaves:
            m = masks[leaf]
            assert tree["value"][leaf] == pytest.approx(-p["rate"] * g[m].sum() / (m.sum() + l2), rel=1e-6, abs=1e-9)
            margin[m] += tree["value"][leaf]
        assert len(leaves) <= p.get("leaves", 2 ** p.get("depth", 30))
    got = [r["prediction"] for r in model.transform(table(spark, x, y, 1)).collect()]
    np.testing.assert_allclose(got, margin, rtol=1e-6)


def test_leaves_go_by_gain(spark):
    """Of all leaves that could be split, the one of the largest gain was."""
    x, y = frame(300, seed=3)
    p = {**LEAVES, "trees": 1, "leaves": 6}
    content = t.HistogramTrees(p, FEATURES).fit(table(spark, x, y)).content
    tree, g = content["trees"][0], y.mean() - y
    masks = rows_of_nodes(tree, x, content["edges"])
    gains = {n: gain_of(tree, n, masks, g, 0.0) for n in np.flatnonzero(tree["feature"] >= 0)}
    assert len(gains) == 5
    left_out = [brute_best(x[:, masks[n]], g[masks[n]], 0.0, 3) for n in np.flatnonzero(tree["feature"] < 0)]
    assert min(gains.values()) >= max(left_out) - 1e-9


@pytest.mark.parametrize("p,boosted", [(LEAVES, True), (LEVELS, True), (RANDOM, False)])
def test_spread_tables_give_the_same_trees(spark, monkeypatch, p, boosted):
    x, y = frame(500, seed=5)
    df = table(spark, x, y).persist()
    one = t.HistogramTrees(p, FEATURES, boosted).fit(df).content
    monkeypatch.setattr(t, "HELD_ROWS", 0)
    monkeypatch.setattr(t, "TASK_ROWS", 150)
    monkeypatch.setattr(t, "REBROADCAST", 2)
    monkeypatch.setattr(t, "FOREST_BATCH", 3)
    other = t.HistogramTrees(p, FEATURES, boosted).fit(df).content
    for a, b in zip(one["trees"], other["trees"], strict=True):
        assert a["feature"].tolist() == b["feature"].tolist() and a["bin"].tolist() == b["bin"].tolist()
        np.testing.assert_allclose(a["value"], b["value"], rtol=1e-9)


def test_random_trees_differ_on_equal_rows_and_have_drawn_thresholds(spark):
    x, y = frame(400, missing=0.0)
    content = t.HistogramTrees(RANDOM, FEATURES, boosted=False).fit(table(spark, x, y)).content
    roots = {(int(tree["feature"][0]), int(tree["bin"][0])) for tree in content["trees"]}
    assert len(roots) > 1
    for tree in content["trees"]:
        masks = rows_of_nodes(tree, x, content["edges"])
        for node in range(len(tree["value"])):
            assert tree["value"][node] == pytest.approx(y[masks[node]].mean()) and masks[node].sum() >= 2


def test_shares_of_rows_and_features(spark):
    x, y = frame(400)
    p = {**LEAVES, "rows": 0.5, "cols": 0.34, "trees": 12}
    df = table(spark, x, y, 1)
    first, second = (t.HistogramTrees(p, FEATURES).fit(df).content for _ in range(2))
    assert t.to_text(first) == t.to_text(second)
    used = [set(tree["feature"][tree["feature"] >= 0].tolist()) for tree in first["trees"]]
    assert all(len(u) <= 1 for u in used) and len(set().union(*used)) > 1


def test_stored_models_and_odd_tables(spark, tmp_path):
    x, y = frame(120)
    df = table(spark, x, y)
    model = Pipeline(stages=[t.HistogramTrees(LEVELS, FEATURES)]).fit(df)
    model.write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    assert again.stages[-1].accepts_missing is False
    key = ["y", "a", "b", "c"]
    assert sorted(map(str, model.transform(df).orderBy(*key).collect())) == sorted(map(str, again.transform(df).orderBy(*key).collect()))
    same = spark.createDataFrame([(2.0, 1.0, None, 3.0)] * 5 + [(None, 1.0, 1.0, 1.0)], "y double, a double, b double, c double")
    flat = t.HistogramTrees(LEVELS, FEATURES).fit(same).transform(same)
    assert [r["prediction"] for r in flat.collect()] == [2.0] * 6
    with pytest.raises(ValueError):
        t.HistogramTrees(LEVELS, FEATURES).fit(same.limit(0))


def test_few_values_have_exact_edges_and_many_quantiles(spark):
    df = spark.range(5000).selectExpr("cast(id % 4 as double) a", "cast(id as double) b", "cast(null as double) c", "1.0D y")
    a, b, c = t.feature_edges(df, FEATURES, 50)
    assert a.tolist() == [0.5, 1.5, 2.5] and 40 <= len(b) <= 50 and not len(c)
    assert np.abs(np.diff(b) - 100).max() <= 5


def test_feature_rows_are_computed_once(spark, sf_dir):
    """The tree's fit and its predictions read stored feature rows: the plan works none out from the series again."""
    from panelcast.catalogue.machine import one_split_tree

    plan = one_split_tree(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "lambda" not in plan


@pytest.mark.parametrize("p,boosted", [(LEAVES, True), ({**RANDOM, "bootstrap": True}, False), (RANDOM, False)])
def test_equal_rows_are_packed(spark, monkeypatch, p, boosted):
    """Trees work on the distinct rows: copies of a table pack to no more rows and give the same splits."""
    x, y = frame(300, seed=9, missing=0.1)
    seen, fit_trees = [], t.fit_trees
    monkeypatch.setattr(t, "fit_trees", lambda packed, rows, *a: seen.append((rows, packed.agg({"n": "sum"}).first()[0])) or fit_trees(packed, rows, *a))
    p = {**p, "leaf": 1}
    one = t.HistogramTrees(p, FEATURES, boosted).fit(table(spark, x, y)).content
    many = t.HistogramTrees(p, FEATURES, boosted).fit(table(spark, np.tile(x, 5), np.tile(y, 5))).content
    assert seen[0][0] == seen[1][0] <= 300 and [total for _, total in seen] == [300, 1500]
    if "bootstrap" not in p:
        for a, b in zip(one["trees"], many["trees"], strict=True):
            assert a["feature"].tolist() == b["feature"].tolist() and a["bin"].tolist() == b["bin"].tolist()
            np.testing.assert_allclose(a["value"], b["value"], rtol=1e-6, atol=1e-9)


def test_a_bootstrap_draws_rows_with_replacement_and_takes_the_best_splits(spark, monkeypatch):
    x, y = frame(400, seed=2)
    p = {"trees": 200, "depth": 12, "leaf": 1, "seed": 3, "bootstrap": True}
    df = table(spark, x, y).persist()
    one = t.HistogramTrees(p, FEATURES, boosted=False).fit(df)
    assert t.to_text(one.content) == t.to_text(t.HistogramTrees(p, FEATURES, boosted=False).fit(df).content)
    roots = [tree["value"][0] for tree in one.content["trees"]]
    assert np.mean(roots) == pytest.approx(y.mean(), abs=0.05) and np.std(roots) == pytest.approx(y.std() / 20, rel=0.25)
    monkeypatch.setattr(t, "HELD_ROWS", 0)
    few = {**p, "trees": 5, "depth": 4}
    spread = t.HistogramTrees(few, FEATURES, boosted=False).fit(df).content
    assert all(len(tree["value"]) > 5 for tree in spread["trees"])
    got = np.array([r["prediction"] for r in one.transform(table(spark, x, y, 1)).collect()])
    assert np.mean((got - y) ** 2) < 0.2 * y.var()


def test_edges_are_merged_from_a_sketch_per_core(spark, monkeypatch):
    """Partitions do not add to the work of the one task that merges the sketches, and do not change the edges."""
    x, y = frame(3000)
    rows, seen, per_core = table(spark, x, y, 1).persist(), [], t.a_part_per_core
    monkeypatch.setattr(t, "a_part_per_core", lambda df: seen.append(per_core(df)) or seen[-1])
    many = t.feature_edges(rows.repartition(64), FEATURES, 200)
    assert [df.rdd.getNumPartitions() for df in seen] == [spark.sparkContext.defaultParallelism]
    assert all(np.array_equal(a, b) for a, b in zip(many, t.feature_edges(rows, FEATURES, 200), strict=True))
    rows.unpersist()


@pytest.mark.parametrize("bootstrap", [True, False])
def test_sums_of_a_level_side_by_side(monkeypatch, bootstrap):
    """All nodes of a level at once, over all blocks, give what one node of one block at a time adds up to."""
    x, y = frame(500)
    edges = [np.unique(f[~np.isnan(f)])[:-1][:20] for f in x]
    rng = np.random.default_rng(1)
    tree = g.one_random_tree(g.binned(x, edges), np.round(64 * y), np.ones(len(y)), edges, {**RANDOM, "depth": 2}, 24, 0.0, 64.0, 0)
    parts = [slice(0, 200), slice(200, 500)]
    blocks = [(b, g.both_ways(b)) for b in (g.binned(x[:, s], edges) for s in parts)]
    weight = rng.poisson(1.0, 500).astype(float) if bootstrap else np.ones(500)
    drawn = lambda k: (np.round(64 * y)[parts[k]] * weight[parts[k]], weight[parts[k]])
    nodes = [n for n in range(len(tree["value"])) if tree["feature"][n] < 0]
    together = dict(g.level_sums(blocks, tree, nodes, drawn, 3, 24))
    monkeypatch.setattr(g, "SIDE_BY_SIDE", 0)
    single = {}
    for node, sums in g.level_sums(blocks, tree, nodes, drawn, 3, 24):
        single[node] = single.get(node, 0.0) + sums
    assert together.keys() == single.keys() and len(nodes) > 2
    assert all(np.array_equal(together[n], single[n]) for n in nodes if n in single)


def test_a_spread_bootstrap_is_that_of_a_held_table(spark):
    """The weights that are kept for all levels are those a held table draws: one block gives the same trees."""
    x, y = frame(300, missing=0.1)
    p = {"trees": 3, "depth": 5, "leaf": 1, "seed": 3, "bootstrap": True}
    edges = [np.unique(f[~np.isnan(f)])[:-1][:20] for f in x]
    block = (g.binned(x, edges), np.round(64 * y), np.ones(len(y)))
    t.ship(spark)
    spread = t.spread_random_trees(spark.sparkContext.parallelize([block], 1), edges, p, 24, 0.0, 64.0)
    for number, tree in enumerate(spread):
        held = g.one_random_tree(*block, edges, p, 24, 0.0, 64.0, number)
        assert all(np.array_equal(tree[name], held[name]) for name in g.FIELDS) and len(tree["value"]) > 7
    assert t.fitting(np.array([0.0, 3.0, 255.0])).dtype == np.uint8 and t.fitting(np.array([256.0])).dtype == np.uint16


@pytest.mark.parametrize("p", [LEAVES, LEVELS, {**LEAVES, "rows": 0.7}])
def test_tasks_side_by_side_grow_the_trees_of_a_spread_table(spark, monkeypatch, p):
    """Several tasks that add up their sums by files find the trees of a job per step, in a few jobs, and leave no file."""
    x, y = frame(500, seed=5)
    p, df = {**p, "trees": 8}, table(spark, x, y).persist()
    monkeypatch.setattr(t, "HELD_ROWS", 0)
    monkeypatch.setattr(t, "TASK_ROWS", 150)
    folders, shared = [], t.shared_folder
    monkeypatch.setattr(t, "shared_folder", lambda session: folders.append(shared(session)) or folders[-1])
    group = f"side by side {p}"
    spark.sparkContext.setJobGroup(group, "")
    together = t.HistogramTrees(p, FEATURES).fit(df).content
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 25
    assert len(folders) == 1 and not os.path.exists(folders[0])
    if "rows" in p:
        assert t.to_text(together) == t.to_text(t.HistogramTrees(p, FEATURES).fit(df).content)
        return
    monkeypatch.setattr(t, "GANG_ROWS", 0)
    spread = t.HistogramTrees(p, FEATURES).fit(df).content
    assert len(folders) == 1
    for a, b in zip(together["trees"], spread["trees"], strict=True):
        assert all(a[name].tolist() == b[name].tolist() for name in g.FIELDS)


@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_a_gang_adds_up_arrays(tmp_path, monkeypatch, whole):
    monkeypatch.setattr(gang, "WHOLE", whole)
    arrays = [[np.random.default_rng([step, rank]).integers(0, 99, (3, 5)).astype(float) for step in range(6)] for rank in range(3)]

    def run(rank):
        one = gang.Gang(str(tmp_path / "g"), rank, 3)
        return [one.total(a) for a in arrays[rank]]

    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(run, range(3)))
    for step in range(6):
        assert all(np.array_equal(f[step], sum(a[step] for a in arrays)) for f in found)
    assert len(list((tmp_path / "g").iterdir())) <= 6


def test_leaf_by_leaf_growth_asks_few_times(monkeypatch):
    """Nodes that gains known so far would split are asked for together, and rows go to the leaves of the pruned tree."""
    x, y = frame(4000, seed=4)
    edges = [np.unique(f[~np.isnan(f)])[:-1][:60] for f in x]
    p = {**LEAVES, "leaves": 32, "leaf": 1, "rows": 0.8}
    held = g.Held(g.binned(x, edges), np.round(64 * y), np.ones(len(y)), 64, p, 64.0)
    asked, sums = [], held.sums
    monkeypatch.setattr(held, "sums", lambda tree, split, *a: asked.append(len(split)) or sums(tree, split, *a))
    margin = np.zeros(len(y))
    for tree in g.boost(held, 3):
        assert (tree["feature"] < 0).sum() <= 32
        margin += tree["value"][g.leaf_of(tree, held.twice)]
    np.testing.assert_array_equal(held.margin, margin)
    assert len(asked) <= 12 * p["trees"]

"""Forests against a plain recursive version, and their cuts against forests grown that far."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import forest, importance, score, train
from tidewatch.operators.evaluate import expanding_folds
from tidewatch.operators.forest import Forest, Kind, draws, grow, grow_alike


def plain(b, y, w, least, depth, split=2, level=0):
    """The tree as nested tuples, by trying every feature and bin."""
    total = w.sum()
    mean = (w * y).sum() / total
    error = (w * (y - mean) ** 2).sum()
    gain, best = 0.0, None
    if level < depth and total >= split:
        for f in range(b.shape[1]):
            for c in np.unique(b[:, f])[:-1]:
                left = b[:, f] <= c
                wl, wr = w[left].sum(), w[~left].sum()
                s = (w[left] * (y[left] - mean)).sum()
                if min(wl, wr) >= least and s * s * total / (wl * wr) > max(gain * (1 + 1e-12), 1e-12 * error):
                    gain, best = s * s * total / (wl * wr), (f, c)
    if best is None:
        return round(mean, 8), int(total)
    left = b[:, best[0]] <= best[1]
    below = [plain(b[s], y[s], w[s], least, depth, split, level + 1) for s in (left, ~left)]
    return (*map(int, best), round(gain, 6), round(mean, 8), int(total), *below)


def nested(tree, i=0):
    if tree.feature[i] < 0:
        return round(float(tree.value[i]), 8), int(tree.rows[i])
    left = int(tree.left[i])
    own = (int(tree.feature[i]), int(tree.bin[i]), round(float(tree.gain[i]), 6), round(float(tree.value[i]), 8), int(tree.rows[i]))
    return (*own, nested(tree, left), nested(tree, left + 1))


def some_rows(draw):
    n = int(draw.integers(1, 60))
    w = draw.poisson(1, n)
    w[0] = max(1, w[0])
    return draw.integers(0, 6, (n, 3)).astype(np.uint8), draw.integers(0, 5, n).astype(float), w


@pytest.mark.parametrize("seed", range(60))
def test_trees_and_their_cuts(seed):
    draw = np.random.default_rng(seed)
    b, y, w = some_rows(draw)
    least, depth, split = int(draw.integers(1, 4)), int(draw.integers(0, 9)), int(draw.integers(2, 9))
    there = w > 0
    want = plain(b[there], y[there], w[there], least, depth, split)
    deep = grow(b, y, w, least)
    cut = deep.cut(depth, split)
    assert nested(cut) == want
    assert nested(grow(b, y, w, least, depth)) == plain(b[there], y[there], w[there], least, depth)
    (walked,) = deep.walk(b, [depth], split)
    (again,) = cut.walk(b, [1 << 30], 2)
    assert walked.tolist() == again.tolist()
    assert nested(forest.Tree.unpacked(cut.packed())) == want


def test_no_rows_make_a_leaf():
    tree = grow(np.empty((0, 2), np.uint8), np.empty(0), np.empty(0), 1)
    assert tree.feature.tolist() == [-1] and tree.value.tolist() == [0.0]


def test_draws_are_poisson_and_depend_on_tree_and_seed():
    key = np.arange(200_000)
    found = draws(key, 3, 42, True)
    assert abs(found.mean() - 1) < 0.01 and abs(found.var() - 1) < 0.02
    assert draws(key, 3, 42, True).tolist() == found.tolist()
    for other in (draws(key, 4, 42, True), draws(key, 3, 43, True)):
        assert abs(np.corrcoef(found, other)[0, 1]) < 0.01
    assert set(draws(key[:5], 0, 1, False)) == {1}


@pytest.fixture(scope="module")
def table(spark):
    """Whole targets, so that sums do not depend on their order."""
    draw = np.random.default_rng(8)
    x = draw.integers(0, 40, (500, 4)).astype(float)
    y = np.rint(3 * x[:, 0] + 10 * (x[:, 1] > 20) + draw.integers(0, 9, 500))
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "i long, a double, b double, c double, d double, y double").repartition(3)


NAMES = ["a", "b", "c", "d"]


def numbers(model):
    return [getattr(model, c).tolist() for c, _ in Forest.NUMBERS if c not in ("threshold", "gain", "value", "left", "start", "feature")], [
        np.round(model.votes(np.array([[a, b, 5.0, 30.0] for a in range(0, 41, 4) for b in range(0, 41, 4)])), 8).tolist(),
        np.round(model.importances, 8).tolist(),
    ]


@pytest.mark.parametrize("params", [{"maxDepth": None}, {"maxDepth": 6, "minInstancesPerNode": 3}, {"minRowsToSplit": 30}])
def test_large_nodes_are_split_alike_by_histograms_and_in_tasks(table, params):
    params = {"numTrees": 3, **params}
    key = F.xxhash64("i")
    at_once = forest.fit(table, NAMES, "y", params, 7, key)
    assert numbers(forest.fit(table, NAMES, "y", params, 7, key, cells=400)) == numbers(at_once)
    assert numbers(forest.fit(table.repartition(5), NAMES, "y", params, 7, key, cells=4)) == numbers(at_once)


def test_cut_forest_equals_a_forest_grown_to_that_depth(table):
    key = F.xxhash64("i")
    deep = {"numTrees": 30, "maxDepth": None, "minInstancesPerNode": 2}
    full = forest.fit(table, NAMES, "y", deep, 7, key)
    short = forest.fit(table, NAMES, "y", {**deep, "numTrees": 10}, 7, key)
    x = np.random.default_rng(1).integers(0, 40, (50, 4)).astype(float)
    assert np.allclose(full.votes(x)[:, :10], short.votes(x))


@pytest.mark.parametrize("cells", [1 << 22, 400])
def test_validation_errors_are_those_of_single_fits(table, spark, cells):
    grid = {"numTrees": [2, 4], "maxDepth": [2, 4, None], "minRowsToSplit": [2, 25], "minInstancesPerNode": [1, 5]}
    asked = train.combinations(grid)
    from tidewatch.operators.evaluate import fold_blocks

    blocks = fold_blocks(table, ["i"], 3)
    found = forest.validation_errors(blocks, NAMES, "y", asked, 3, 7, F.xxhash64("i"), cells)
    assert len(found) == 3 * len(asked)
    cuts = forest.thresholds(table, NAMES)
    local = table.orderBy("i").toPandas()
    x, y = local[NAMES].to_numpy(), local["y"].to_numpy()
    bins = np.column_stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]).astype(np.uint8)
    keys = np.array([r["k"] for r in table.orderBy("i").select(F.xxhash64("i").alias("k")).collect()])
    for k, (early, late) in enumerate(expanding_folds(table, ["i"], 3)):
        a = np.array(sorted(r["i"] for r in early.collect()))
        b = np.array(sorted(r["i"] for r in late.collect()))
        for c in range(0, len(asked), 5):
            p = forest.Params.of(asked[c])
            votes = [
                next(grow(bins[a], y[a], draws(keys[a], t, 7, True), p.minInstancesPerNode, p.depth).walk(bins[b], [p.depth], p.minRowsToSplit))
                for t in range(p.numTrees)
            ]
            assert found[c, k] == pytest.approx(np.abs(np.mean(votes, axis=0) - y[b]).mean(), rel=1e-9)


def test_cross_validation_picks_the_first_best(table):
    results = train.cross_validate(table, NAMES, "y", ["i"], {"numTrees": [3], "maxDepth": [1, 40, None]}, folds=2)
    assert results.count() == 6
    best = train.best_combination(results).first()
    assert best["combination"] == 1 and best["params"]["maxDepth"] == "40"
    model, params, cv = train.tune(table, NAMES, "y", ["i"], {"numTrees": [3], "maxDepth": [1, 40, None]}, folds=2)
    assert params == {"numTrees": 3, "maxDepth": 40} and cv == best["cv_score"] and model.trees == 3


def test_missing_values_go_left(spark):
    rows = [(float(i % 4) if i % 5 else None, float("nan") if i % 7 == 0 else float(i % 3), float(i % 4 * 10)) for i in range(80)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    model = forest.fit(df, ["a", "b"], "y", {"numTrees": 1, "maxDepth": 4, "bootstrap": False})
    x = np.array([[r[0] if r[0] is not None else np.nan, r[1]] for r in rows])
    low = np.where(np.isnan(x), -1e9, x)
    assert model.votes(x).tolist() == model.votes(low).tolist()
    scored = score.score(df, model, ["a", "b"]).collect()
    assert [r["prediction"] for r in scored] == pytest.approx(model.votes(x)[:, 0].tolist())


def test_saved_and_loaded(table, spark, tmp_path):
    model = forest.fit(table, NAMES, "y", {"numTrees": 2}, 7)
    model.save(spark, str(tmp_path / "m"))
    again = Forest.load(spark, str(tmp_path / "m"))
    assert again.features == tuple(NAMES) and numbers(again) == numbers(model)


def test_only_touched_paths_are_walked_again(table, spark):
    model = forest.fit(table, NAMES, "y", {"numTrees": 7, "maxDepth": 5}, 7)
    draw = np.random.default_rng(2)
    x, z = draw.integers(0, 40, (2, 700, 4)).astype(float)
    y = draw.normal(size=700)
    used = np.flatnonzero(model.importances > 0).tolist()
    found = importance.permuted_errors(model, used, x, z, y)
    np.testing.assert_allclose(found[:, 0], np.abs(model.votes(x).mean(1) - y))
    for k, j in enumerate(used):
        swapped = x.copy()
        swapped[:, j] = z[:, j]
        np.testing.assert_allclose(found[:, k + 1], np.abs(model.votes(swapped).mean(1) - y))


def test_thresholds(spark):
    df = spark.range(1000).selectExpr("cast(id % 3 as double) a", "cast(id as double) b", "cast(null as double) c", "1.0d d")
    a, b, c, d = forest.thresholds(df, list("abcd"), 8)
    assert a.tolist() == [0.5, 1.5] and b.tolist() == [125 * k - 0.5 for k in range(1, 8)] and not len(c) and not len(d)
    with pytest.raises(ValueError):
        forest.thresholds(df, ["a"], 300)


def test_kinds_name_their_rows():
    assert Kind(2, 1) == Kind(2, 1) and forest.Params.of({"maxDepth": None}).depth > 1 << 20


def test_repeated_rows_leave_every_threshold(spark):
    """Far more rows than the sample holds, of few values each."""
    df = spark.range(3 * forest.SAMPLE).selectExpr("cast(id % 24 as double) a", "cast(id % 24 * 10 as double) y")
    (a,) = forest.thresholds(df, ["a"])
    assert a.tolist() == [k + 0.5 for k in range(23)]
    crowded = spark.range(50 * forest.SAMPLE).selectExpr("cast(if(id % 2 = 0, 0, id) as double) a")
    (b,) = forest.thresholds(crowded, ["a"], 8)
    assert len(b) >= 4 and b[0] < 50 < b[1]  # the repeated half is one value in the lowest shares


def test_a_node_of_equal_targets_is_not_split():
    """Rounding makes its squared error a little less than nothing."""
    weights = np.array([[3.0, 4.0]])
    for y in (0.1, 52.3, 117.77):
        assert forest._split_of(weights, weights * y, 7 * y * y * (1 - 1e-15), 1)[0] == -1


def test_limited_trees_of_many_rows_are_not_dealt(table, monkeypatch):
    """Levels of histograms reach their ends, so no row is copied for a tree."""
    key = F.xxhash64("i")
    grid = {"numTrees": [2, 4], "maxDepth": [1, 5], "minRowsToSplit": [2, 25], "minInstancesPerNode": [1, 5]}
    asked = train.combinations(grid)
    from tidewatch.operators.evaluate import fold_blocks

    blocks = fold_blocks(table, ["i"], 3)
    fitted = forest.fit(table, NAMES, "y", {"numTrees": 3, "maxDepth": 6}, 7, key)
    errors = forest.validation_errors(blocks, NAMES, "y", asked, 3, 7, key)

    def dealt(*_):
        raise AssertionError("rows are dealt")

    monkeypatch.setattr(forest, "_groups", dealt)
    monkeypatch.setattr(forest, "HELD", 2000)  # some nodes at a time
    assert numbers(forest.fit(table, NAMES, "y", {"numTrees": 3, "maxDepth": 6}, 7, key, cells=400)) == numbers(fitted)
    found = forest.validation_errors(blocks, NAMES, "y", asked, 3, 7, key, cells=400)
    assert found.keys() == errors.keys() and all(found[c] == pytest.approx(errors[c], rel=1e-9) for c in found)


@pytest.mark.parametrize("dense", [1, 24, 1 << 40])
def test_histograms_and_orders_split_alike_within_a_task(monkeypatch, dense):
    monkeypatch.setattr(forest, "DENSE", dense)
    for seed in range(40):
        draw = np.random.default_rng(seed)
        b, y, w = some_rows(draw)
        least = int(draw.integers(1, 4))
        assert nested(grow(b, y, w, least)) == plain(b[w > 0], y[w > 0], w[w > 0], least, 1 << 30)


def test_trees_of_some_hundred_thousand_rows_are_whole_in_a_task(spark, monkeypatch):
    """Their rows are dealt in blocks, once for some trees and all leaf sizes, not row by row for each."""

    def dealt(*_):
        raise AssertionError("rows are dealt for each tree")

    monkeypatch.setattr(forest, "_groups", dealt)
    df = spark.range(300_000).selectExpr("cast(id % 7 as double) a", "cast(id % 5 as double) b", "cast((id % 7) * (id % 5) as double) y", "id")
    params = {"numTrees": 2, "maxDepth": None, "bootstrap": False}
    model = forest.fit(df, ["a", "b"], "y", params, 7, F.xxhash64("id"))
    assert model.votes(np.array([[6.0, 4.0], [3.0, 0.0]])).tolist() == [[24.0, 24.0], [0.0, 0.0]]
    rows = forest.binned(df, ["a", "b"], forest.thresholds(df, ["a", "b"]), "y", F.xxhash64("id"), F.col("id") % 2)
    parts = forest._packed(rows, 2).collect()
    assert len(parts) < 300 and sum(r["n"] for r in parts) == 300_000


def test_levels_read_packed_rows(table, monkeypatch):
    """Not a record of its own for each row in each pass."""
    level, seen = forest._level, []

    def counted(rows, *rest):
        seen.append(rows.count())
        return level(rows, *rest)

    monkeypatch.setattr(forest, "_level", counted)
    forest.fit(table, NAMES, "y", {"numTrees": 2, "maxDepth": 3}, 7, F.xxhash64("i"), cells=400)
    assert len(seen) == 3 and max(seen) <= 2 * table.sparkSession.sparkContext.defaultParallelism


def test_a_task_copies_one_chunk_of_a_batch(monkeypatch):
    """Whatever the parts that Spark sends at a time; the rows are all there."""
    monkeypatch.setattr(forest, "CHUNK", 20_000)
    draw = np.random.default_rng(5)
    n, size, count = 100, 10_000, 2
    keys, ys, bins = draw.integers(0, 1 << 60, (n, size)), draw.normal(size=(n, size)), draw.integers(0, 32, (n, size, count), np.uint8)
    rows = [k.tobytes() + y.tobytes() + b.tobytes() for k, y, b in zip(keys, ys, bins, strict=True)]
    columns = [pa.array(range(n), pa.int64()), pa.array([i % 3 for i in range(n)], pa.int32()), pa.array([size] * n, pa.int32())]
    batch = pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.binary())], ["part", "block", "n", "rows"])
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    at = 0
    for chunk in forest._chunks(iter([batch]), count):
        some = slice(at // size, at // size + 2)
        assert all((a == b.reshape(a.shape)).all() for a, b in zip(chunk, (bins[some], ys[some], keys[some]), strict=False))
        assert (chunk[3] == np.repeat([i % 3 for i in range(n)][some], size)).all()
        at += len(chunk[1])
    peak = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert at == n * size and peak < 4_000_000 < batch.nbytes / 4


def test_draws_between_and_at_the_bounds():
    key = np.random.default_rng(3).integers(-(1 << 63), (1 << 63) - 1, 300_000)
    found = draws(key, 5, 11, True)
    share = np.array([_share(int(k), 5, 11) for k in key[:5000]])
    assert found[:5000].tolist() == np.searchsorted(forest._POISSON, share, side="right").tolist()
    assert (forest._DRAWS < 0).sum() < 32


def _share(key, tree, seed):
    x = (key + tree * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95) % (1 << 64)
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % (1 << 64)
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % (1 << 64)
    return ((x ^ (x >> 31)) >> 11) * 2.0**-53


@pytest.mark.parametrize("seed", range(40))
def test_trees_of_some_leaf_sizes_at_once(seed):
    draw = np.random.default_rng(seed)
    b, y, w = some_rows(draw)
    depth = int(draw.integers(0, 9)) if seed % 2 else 1 << 30
    trees = grow_alike(b, y, w, [1, 2, 4], depth, 3)
    there = w > 0
    for least, tree in zip([1, 2, 4], trees, strict=True):
        assert nested(tree) == plain(b[there], y[there], w[there], least, depth)
        assert tree.depth[0] == 3


def test_trees_of_some_leaf_sizes_share_their_nodes(monkeypatch):
    """Rows are looked at little more often than for one tree, in blocks that do not grow with the rows."""
    split, seen = forest._Growth._split, []

    def counted(self, nodes, best):
        seen.append((len(nodes.rows), nodes.size.max()))
        return split(self, nodes, best)

    monkeypatch.setattr(forest._Growth, "_split", counted)
    monkeypatch.setattr(forest, "BLOCK", 4096)
    draw = np.random.default_rng(1)
    b, y, w = draw.integers(0, 32, (40_000, 5), np.uint8), draw.exponential(50, 40_000), draw.poisson(1, 40_000)
    asked = []
    for leasts in ([1], [1, 2, 4]):
        seen.clear()
        trees = grow_alike(b, y, w, leasts)
        asked.append(sum(n for n, _ in seen))
        assert max(n for n, size in seen if size <= 4096) <= max(4096, forest.TABLE // 2)
        for least, tree in zip(leasts, trees, strict=True):
            assert tree.rows[tree.feature < 0].min() >= least and tree.rows[tree.feature < 0].sum() == w.sum()
    assert asked[1] < 1.8 * asked[0]


def test_rounding_splits_no_equal_targets_and_no_ties():
    draw = np.random.default_rng(2)
    for y in (0.1, 52.3, 117.77):
        tree = grow(draw.integers(0, 9, (50, 3)).astype(np.uint8), np.full(50, y), draw.poisson(2, 50), 1)
        assert len(tree.feature) == 1
    for _ in range(200):  # both features split alike, with the sides swapped
        side = draw.permutation([0, 0, 1])
        tree = grow(np.column_stack([side, 1 - side]).astype(np.uint8), draw.choice([228.29, 228.36, 161.46], 3), draw.integers(1, 4, 3), 1)
        assert tree.feature[0] in (-1, 0)

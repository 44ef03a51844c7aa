"""Histogram boosting, pruned forests, mergeable ridge and the shared registry against brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from airspark import schemas as S
from airspark.operators import boosting
from airspark.operators import forest as FO
from airspark.operators import ridge as R
from airspark.operators.boosting import BoostedTrees
from airspark.operators.forest import Forest
from airspark.plans import ml as M
from airspark.sources import store as ST


def data(n=400, seed=1):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(size=n).round(1), r.integers(0, 5, n), r.normal(size=n).round(2), np.full(n, 7.0)])
    y = (3 * x[:, 0] + (x[:, 1] == 2) * 9 + x[:, 2] ** 2 * 2 + r.normal(size=n)).round(2)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)], "us_aqi double, _x array<double>").repartition(3)


def brute_boost(x, y, rounds, depth=4, eta=0.05, least=3, l1=0.1, l2=2.0):
    """Exact greedy second-order boosting, squared error: every cut between values is tried."""
    soft = lambda g: np.sign(g) * max(abs(g) - l1, 0.0)
    score = lambda g: soft(g.sum()) ** 2 / (len(g) + l2)
    p = np.full(len(y), y.mean())
    for _ in range(rounds):
        g = p - y
        step = np.zeros(len(y))

        def grow(rows, level):
            best = (1e-6, None)
            if level < depth:
                for f in range(x.shape[1]):
                    for cut in np.unique(x[rows, f]):
                        left = rows[x[rows, f] <= cut]
                        right = rows[x[rows, f] > cut]
                        if min(len(left), len(right)) >= least:
                            gain = score(g[left]) + score(g[right]) - score(g[rows])
                            if gain > best[0] * (1 + 1e-9):
                                best = (gain, (left, right))
            if best[1] is None:
                step[rows] = -eta * soft(g[rows].sum()) / (len(rows) + l2)
            else:
                for part in best[1]:
                    grow(part, level + 1)
        grow(np.arange(len(y)), 0)
        p += step
    return p


@pytest.mark.parametrize("write_every", [2, 25])
def test_boosting_equals_exact_greedy(spark, write_every):
    x, y = data(150)
    df = frame(spark, x, y)
    fitted = BoostedTrees(rounds=5, rows=1.0, columns=1.0, write_every=write_every).fit(df)
    got = {tuple(r._x): r.prediction for r in fitted.transform(df).collect()}
    want = brute_boost(x, y, 5)
    assert max(abs(got[tuple(a)] - w) for a, w in zip(x.tolist(), want)) < 1e-9
    assert sum(fitted.importances) == pytest.approx(1) and fitted.importances[3] == 0


def test_boosting_samples_and_edges(spark, tmp_path):
    x, y = data(400)
    df = frame(spark, x, y).cache()
    model = BoostedTrees(rounds=12, learning_rate=0.3)
    fitted = model.fit(df)
    used = [set(t.feature[t.feature >= 0]) for t in fitted.model.trees]
    assert all(len(u) <= 3 for u in used)  # 85 % of four columns
    error = fitted.transform(df).agg(F.avg(F.pow(F.col("us_aqi") - F.col("prediction"), 2))).first()[0]
    assert error < 0.25 * y.var()
    PipelineModel([fitted.stage()]).write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m").transform(df)
    assert again.exceptAll(fitted.transform(df)).count() == 0
    few = frame(spark, x[:4], y[:4])  # too few rows for a split: every tree is its root
    one = BoostedTrees(rounds=2).fit(few)
    assert all((t.feature < 0).all() for t in one.model.trees) and one.importances == [0.0] * 4
    none = BoostedTrees(rounds=2).fit(df.limit(0))
    assert none.transform(few).select("prediction").distinct().count() == 1
    many = np.column_stack([np.arange(3000.0), np.zeros(3000)])  # more values than bins
    curve = frame(spark, many, np.sin(many[:, 0] / 300) * 10)
    fit = BoostedTrees(rounds=20, learning_rate=0.3, max_bins=32).fit(curve)
    assert fit.transform(curve).agg(F.avg(F.abs(F.col("us_aqi") - F.col("prediction")))).first()[0] < 1.5


def test_boosting_takes_as_many_jobs_whatever_its_rounds(spark):
    df, sc = frame(spark, *data(60)).cache(), spark.sparkContext
    jobs = []
    for rounds in (2, 9):
        sc.setJobGroup(f"boost-{rounds}", "")
        BoostedTrees(rounds=rounds).fit(df)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"boost-{rounds}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0]


def test_boosted_expression_walks_every_tree_and_does_not_grow_with_them(spark):
    x, y = data(300)
    df = frame(spark, x, y).cache()
    parser, leaves = spark._jsparkSession.sessionState().sqlParser(), []
    for rounds in (1, 9):
        fitted = BoostedTrees(rounds=rounds, learning_rate=0.3, min_child=20.0).fit(df)
        leaves.append(parser.parseExpression(fitted.expression()).collectLeaves().size())
    assert leaves[0] == leaves[1]
    trees = fitted.model.trees
    assert any(t.feature[n] < 0 <= t.feature[(n - 1) // 2] for t in trees for n in (1, 2, 3, 4, 5, 6))  # leaves above the last level

    def predict(row):
        total = fitted.model.base
        for t in trees:
            n = 0
            while t.feature[n] >= 0:
                v = row[t.feature[n]]
                n = 2 * n + (2 if v is not None and v > t.cut[n] else 1)
            total += t.value[n]
        return total

    odd = spark.createDataFrame([([None, 2.0, None, 7.0],), ([float("inf"), -1.0, float("-inf"), 7.0],)], "_x array<double>")
    for r in fitted.transform(df.select("_x").unionByName(odd)).collect():
        assert r.prediction == predict(r._x)
    stump = BoostedTrees(rounds=2, depth=0).fit(df)  # every tree is its root
    assert stump.transform(odd).first().prediction == stump.model.base + stump.model.trees[0].value[0] + stump.model.trees[1].value[0]


def test_boosting_over_several_blocks_grows_the_same_trees(spark, monkeypatch):
    x, y = data(300)
    df = frame(spark, x, y).cache()
    one = BoostedTrees(rounds=6).fit(df)
    monkeypatch.setattr(boosting, "ROWS_OF_A_TASK", 150)
    monkeypatch.setattr(boosting, "ROWS_OF_A_BLOCK", (100, 200))
    two = BoostedTrees(rounds=6, write_every=4).fit(df)
    for a, b in zip(one.model.trees, two.model.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all()
        assert a.value == pytest.approx(b.value, abs=1e-9)


def test_boosting_draws_rows_by_the_hash(spark):
    rows = spark.range(500).selectExpr("xxhash64(id, 42) AS draw", f"pmod(xxhash64(id, 42, 7), {boosting.DRAWS}) AS want").collect()
    draw = np.array([r.draw for r in rows]).view(np.uint64)
    assert boosting._drawn(draw, 7).tolist() == [r.want for r in rows]


def test_pruned_forest_is_one_that_never_split_small_nodes(spark):
    from pyspark.ml.functions import array_to_vector
    x, y = data(300)
    df = frame(spark, x, y).withColumn("features", array_to_vector("_x"))
    raw = RandomForestRegressor(labelCol="us_aqi", numTrees=4, maxDepth=8, minInstancesPerNode=3, seed=5).fit(df)
    pruned = M.prune_small(raw, 8)
    assert sum(t.numNodes for t in pruned.trees) < sum(t.numNodes for t in raw.trees)
    path = ST.scratch_path(spark, "trees")
    raw.write().save(path)
    nodes = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        nodes[r.treeID, r.nodeData.id] = r.nodeData

    def predict(tree, row):
        at = nodes[tree, 0]
        while at.leftChild >= 0 and at.rawCount >= 8:
            left = row[at.split.featureIndex] <= at.split.leftCategoriesOrThreshold[0]
            at = nodes[tree, at.leftChild if left else at.rightChild]
        return at.prediction

    got = {tuple(r._x): r.prediction for r in pruned.transform(df).collect()}
    for a in x.tolist():
        assert got[tuple(a)] == pytest.approx(np.mean([predict(t, a) for t in range(4)]), abs=1e-12)
    assert pruned.transform(df).exceptAll(M.prune_small(pruned, 8).transform(df)).count() == 0


def brute_tree(x, y, w, heap, looks, depth, least_leaf=3, least_split=8):
    """Exact greedy tree on rows that count ``w`` times; a function from a row to its prediction."""
    mean = (w * y).sum() / w.sum()
    error = lambda w, y: (w * y * y).sum() - (w * y).sum() ** 2 / w.sum()
    best = (1e-6, None)
    if depth and w.sum() >= least_split:
        for f in np.flatnonzero(looks(heap)):
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                if min(w[left].sum(), w[~left].sum()) >= least_leaf:
                    gain = error(w, y) - error(w[left], y[left]) - error(w[~left], y[~left])
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (f, cut, left))
    if best[1] is None:
        return lambda row: mean
    f, cut, left = best[1]
    below, above = (brute_tree(x[s], y[s], w[s], 2 * heap + 1 + i, looks, depth - 1) for i, s in enumerate((left, ~left)))
    return lambda row: below(row) if row[f] <= cut else above(row)


def test_forest_equals_exact_greedy(spark):
    x, y = data(300)
    df = frame(spark, x, y).cache()
    from pyspark.ml.functions import array_to_vector
    vectors = df.withColumn("features", array_to_vector("_x"))
    model = M.fit_forest(vectors, "us_aqi", numTrees=3, maxDepth=6, minInstancesPerNode=3, featureSubsetStrategy="0.5", seed=5)
    numbered = boosting.binned(df, [[]] * 4, "us_aqi", "_x", 5).orderBy("r").collect()  # numbers and hashes by place, as in the fit
    placed = df.select("us_aqi", "_x").collect()
    assert [r.y for r in numbered] == [r.us_aqi for r in placed]
    xs, ys = np.array([r._x for r in placed]), np.array([r.us_aqi for r in placed])
    draw = np.array([r.draw for r in numbered]).view(np.uint64)
    trees = []
    for t in range(3):
        w = FO._poisson(boosting._drawn(draw, t))
        assert 0.8 < w.mean() < 1.2 and w.max() < 9
        looks = lambda heap, t=t: FO._picked(5, t, np.array([heap], dtype=np.uint64), 4, 2)[0]
        assert sum(looks(0)) == 2
        trees.append(brute_tree(xs[w > 0], ys[w > 0], w[w > 0], 0, looks, 6))
    got = {tuple(r._x): r.prediction for r in model.transform(vectors).collect()}
    for a in x.tolist():
        assert got[tuple(a)] == pytest.approx(np.mean([t(a) for t in trees]), abs=1e-9)
    assert sum(model.featureImportances) == pytest.approx(1)


def test_forest_takes_as_many_jobs_whatever_its_depth(spark):
    from pyspark.ml.functions import array_to_vector
    vectors, sc = frame(spark, *data(400)).withColumn("features", array_to_vector("_x")).cache(), spark.sparkContext
    jobs = []
    for depth in (2, 12):
        sc.setJobGroup(f"forest-{depth}", "")
        est = M.Learner(M.FOREST, [], dict(numTrees=3, maxDepth=depth, minInstancesPerNode=3, featureSubsetStrategy="0.85", seed=1))
        model, _ = est.fit_last(vectors)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"forest-{depth}")))
        assert max(t.depth for t in model.trees) == depth or depth == 12
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0]


def test_forest_edges(spark):
    x, y = data(40)
    one = Forest(trees=2, depth=3).grow(frame(spark, x[:2], y[:2])).collect()  # too few rows for a split
    assert [r.nodeData.leftChild for r in one] == [-1, -1] and {r.treeID for r in one} == {0, 1}
    flat = Forest(trees=2).grow(frame(spark, x, np.full(40, 7.1))).collect()  # nothing to gain
    assert len(flat) == 2 and all(r.nodeData.prediction == pytest.approx(7.1) for r in flat)


def observations(spark, n=900, seed=3):
    r = np.random.default_rng(seed)
    rows = [("ab"[i % 2], dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(i) * 3), float(r.normal() * 20 + 50), 1013.0 + float(r.normal()),
             5.0, None if i % 50 == 0 else float(r.normal() * 9 + 70)) for i in range(n)]
    return spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, pm25_24h double, surface_pressure double, hour double, us_aqi double")


def test_ridge_from_merged_statistics(spark):
    feats = ["pm25_24h", "surface_pressure", "hour"]
    df = observations(spark)
    rows = [r for r in df.collect() if r.us_aqi is not None]
    x, y = np.array([[r[f] for f in feats] for r in rows]), np.array([r.us_aqi for r in rows])
    deviation = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(deviation > 0, deviation, 1)
    w = np.linalg.solve(z.T @ z + np.eye(3), z.T @ (y - y.mean()))
    whole = R.statistics(df, feats)
    model = R.solve(whole, feats)
    predicted = model.intercept + x @ model.coefficients
    assert np.abs(predicted - (y.mean() + z @ w)).max() < 1e-8
    assert model.importances == pytest.approx(np.abs(w).tolist(), abs=1e-8) and model.coefficients[2] == 0
    # Daily training: statistics of old months stay, those of the new month are added.
    assert whole.count() > 4
    cut = F.col("timestamp") < F.lit("2024-03-01").cast("timestamp_ntz")
    parts = R.statistics(df.where(cut), feats).unionByName(R.statistics(df.where(~cut), feats))
    assert R.solve(parts, feats).coefficients == pytest.approx(model.coefficients, rel=1e-9)
    assert R.solve(whole.limit(0), feats).intercept == 0


def model_rows(spark, n=240):
    return spark.range(n).select(
        F.lit("a").alias("city"), (F.timestamp_seconds(F.col("id") * 3600)).cast("timestamp_ntz").alias("timestamp"),
        *[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(S.MODEL_FEATURE_COLUMNS)],
        (F.col("id") % 17 * 5.0).alias(S.TARGET_COLUMN))


def test_one_training_serves_every_caller(spark, tmp_path, monkeypatch):
    small = dict(forest=dict(numTrees=2), boosted=dict(rounds=2))
    path, rows = f"{tmp_path}/registry", model_rows(spark).cache()
    first = M.registered_model(rows, path, "m", **small).first()
    monkeypatch.setattr(M, "train_and_register", None)  # a second training would fail
    again = M.registered_model(rows.repartition(5), path, "m", **small).first()
    assert again == first and first.version == 1 and len(first.feature_importance) == 19
    scored = M.score_with(first, lambda features: rows)
    assert scored.count() == 240 and not {"_x", "features"} & set(scored.columns)
    assert [r.feature for r in M.feature_importance(M.registered_model(rows, path, "m")).collect()]
    with pytest.raises(TypeError):
        M.registered_model(rows.limit(200), path, "m", **small)  # other data: trained anew


def test_learners_share_binned_rows_and_metrics_take_no_job(spark, monkeypatch):
    rows, written, keep = model_rows(spark).cache(), [], boosting.checkpoint
    monkeypatch.setattr(boosting, "checkpoint", lambda df, name: written.append(name) or keep(df, name))
    ests = M.estimators(rows, forest=dict(numTrees=2), boosted=dict(rounds=2))
    metrics, fitted, best = M.compare(rows, rows, ests)
    assert written == ["binned-rows"]
    sc = spark.sparkContext
    sc.setJobGroup("held-metrics", "")
    held = metrics.filter(F.col("model_name") == best).first()
    assert len(sc.statusTracker().getJobIdsForGroup("held-metrics")) == 0
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert held.train_RMSE == held.test_RMSE and [f.name for f in metrics.schema if f.dataType.typeName() == "double"] == metrics.columns[1:]
    again = ests[M.BOOSTED].fit(rows)  # alone, as beside the forest
    assert again.transform(rows).select("prediction").exceptAll(fitted[M.BOOSTED].transform(rows).select("prediction")).count() == 0


def test_two_writers_never_share_a_version(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/registry"
    assert [ST.claim_version(spark, path, "a b/c") for _ in range(3)] == [1, 2, 3]
    assert ST.claim_version(spark, path, "other") == 1
    record = spark.createDataFrame([("a b/c", 1.0)], "name string, mae double")
    done = ST.registry_append(spark, path, record)  # three claims were never written: a gap, not a doubled version
    assert [(r.name, r.version) for r in done.collect()] == [("a b/c", 4)]
    # A writer that saw nothing of the others' claims finds them taken.
    monkeypatch.setattr(ST, "claimed", lambda spark, folder: [])
    assert ST.claim_version(spark, path, "a b/c") == 5


def test_forest_cuts_are_the_same_from_sums_and_from_sorted_rows():
    r = np.random.default_rng(4)
    b, node = r.integers(0, 9, (5, 400)).astype(np.int16), r.integers(0, 6, 400).astype(np.int32)
    w, g = r.integers(1, 4, 400).astype(float), r.normal(size=400)
    count = np.bincount(node, w)
    g -= (np.bincount(node, g) / count)[node] * w  # sums of a node are nothing
    picked = r.random((6, 5)) < 0.7
    picked[:, 0] = True
    order = [o[np.argsort(node[o], kind="stable")] for o in np.argsort(b, axis=1, kind="stable")]
    forest = Forest()
    one, two = (forest._best_summed(b, w, g, node, count, picked, 9), forest._best_sorted(b, w, g, node, count, picked, order))
    assert one[0] == pytest.approx(two[0]) and (one[1] == two[1]).all() and (one[2] == two[2]).all()


def test_forest_grows_the_same_trees_from_many_blocks(spark, monkeypatch):
    df = frame(spark, *data(300)).cache()
    one = Forest(trees=3, depth=5).grow(df).collect()
    monkeypatch.setattr(FO, "ROWS_OF_A_BLOCK", 7)
    assert sorted(Forest(trees=3, depth=5).grow(df).collect()) == sorted(one)


def test_forest_may_be_saved_as_a_pipeline(spark, tmp_path):
    rows = model_rows(spark).cache()
    model = M.estimators(rows, forest=dict(numTrees=3))[M.FOREST].fit(rows)
    M.save_model(model, f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    assert again.stages[-1].getNumTrees == 3 and len(model.importances) == 19
    assert again.transform(rows).select("prediction").exceptAll(model.transform(rows).select("prediction")).count() == 0

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.mllib.clustering import KMeans, KMeansModel
from pyspark.sql import functions as F

import tableprofile as tp
from checks.modelling import FEATURE_QUERIES
from tableprofile.functions.blocks import over_blocks
from tableprofile.operators import clustering, quantiles, trees
from tableprofile.operators.features import working_set
from tableprofile.operators.fitted import NoTrainingRowsError


@pytest.fixture(scope="module")
def points(spark):
    df = spark.range(900).select(
        F.col("id").alias("key"),
        ((F.col("id") * 37) % 101 / 10.0).alias("a"),
        ((F.col("id") * 53) % 89 / 7.0).alias("b"),
        ((F.col("id") * 71) % 97 / 3.0).alias("c"),
    )
    noise = ((F.col("key") * 17) % 13) / 20.0
    y = F.col("a") * 3.0 - F.col("b") * 2.0 + F.col("c") * 0.001 + noise
    return df.select(y.alias("y"), "a", "b", "c", "key")


def test_regression_solves_its_penalised_problem(points):
    """At the optimum of a convex problem its subgradient holds zero."""
    fit = tp.fit_linear_regression(points, key=["key"], features=["a", "b", "c"], max_iter=200, digits=None)
    assert (fit.fact("label"), fit.fact("dropped_rows")) == ("y", 0)
    assert fit.fact("training_rows") + fit.fact("test_rows") == 900
    train = tp.split_by_key(points, ["key"]).filter("is_train").toPandas()
    x, y = train[["a", "b", "c"]].to_numpy(), train["y"].to_numpy()
    sx, sy = x.std(axis=0), y.std()
    xs, ys = (x - x.mean(axis=0)) / sx, (y - y.mean()) / sy
    w = np.array([fit.fact("coefficient", c) for c in "abc"]) * sx / sy
    lam, mix = 0.3 / sy, 0.8
    gradient = -xs.T @ (ys - xs @ w) / len(y) + lam * (1 - mix) * w
    for g, weight in zip(gradient, w):
        if weight:
            assert g == pytest.approx(-lam * mix * math.copysign(1, weight), abs=1e-6)
        else:
            assert abs(g) <= lam * mix + 1e-6


def test_regression_metrics_equal_numpy(points):
    fit = tp.fit_linear_regression(points, key=["key"], features=["a", "b"], reg_param=0.0, digits=None)
    both = tp.split_by_key(points, ["key"]).toPandas()
    train, test = both[both.is_train], both[~both.is_train]
    design = np.column_stack([train.a, train.b, np.ones(len(train))])
    w, *_ = np.linalg.lstsq(design, train.y, rcond=None)
    residual = test.y - (test.a * w[0] + test.b * w[1] + w[2])
    assert fit.fact("rmse") == pytest.approx(math.sqrt((residual**2).mean()))
    assert fit.fact("r2") == pytest.approx(1 - (residual**2).mean() / test.y.var(ddof=0))
    assert fit.fact("intercept") == pytest.approx(w[2])


def test_predictions_keep_the_columns_and_survive_saving(points, tmp_path):
    fit = tp.fit_linear_regression(points, key=["key"])
    scored = fit.predict()
    assert scored.columns == [*points.columns, "prediction"]
    path = str(tmp_path / "model")
    fit.model.write().save(path)
    again = PipelineModel.load(path).transform(points)
    assert again.count() == 900


def test_missing_labels_are_dropped_and_missing_features_are_zero(spark):
    data = [(float(i) if i % 5 else None, float(i) if i % 7 else math.nan) for i in range(200)]
    df = spark.createDataFrame(data, "y double, x double")
    fit = tp.fit_linear_regression(df)
    assert fit.fact("dropped_rows") == 40
    assert fit.fact("training_rows") + fit.fact("test_rows") == 160
    tree = tp.fit_decision_tree(df)
    assert tree.fact("dropped_rows") == 40
    assert fit.predict().filter("prediction is null").count() == 0


def test_label_without_values_is_an_error(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "y double, x double")
    for fit in (tp.fit_linear_regression, tp.fit_decision_tree):
        with pytest.raises(NoTrainingRowsError):
            fit(df)


def test_own_columns_called_label_and_features(spark):
    df = spark.createDataFrame(
        [(float(i % 10), float(i), float(-i)) for i in range(60)],
        "label double, features double, prediction double",
    )
    for job in ("linear_regression", "kmeans", "decision_tree"):
        assert tp.run_model(df, job).filter("metric = 'error'").count() == 0
    scored = tp.fit_decision_tree(df, "label", ["features"]).predict(output="guess")
    assert scored.columns == [*df.columns, "guess"]


def test_too_few_numeric_columns(spark):
    df = spark.createDataFrame([(1.0, "a")], "y double, s string")
    for fit in (tp.fit_linear_regression, tp.fit_decision_tree):
        with pytest.raises(ValueError, match="at least 2 numeric"):
            fit(df)
    with pytest.raises(ValueError, match="feature preparation"):
        tp.fit_kmeans(df.select("s"))


def test_split_does_not_depend_on_partitions(points):
    for key in (["key"], None):
        sides = [
            {tuple(r) for r in tp.split_by_key(points.repartition(n), key).collect()} for n in (1, 5)
        ]
        assert sides[0] == sides[1]
        share = sum(r[-1] for r in sides[0]) / 900
        assert 0.74 < share < 0.86
    assert tp.split_by_key(points, ["key"], train_ratio=1.0).filter("not is_train").count() == 0
    assert tp.split_by_key(points, method="random").columns[-1] == "is_train"
    with pytest.raises(ValueError):
        tp.split_by_key(points, method="sorted")


def test_tree_separates_what_can_be_separated(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("y"), (F.col("id") * 2).alias("x"))
    fit = tp.fit_decision_tree(df)
    assert fit.fact("threshold") == 499.0
    assert fit.fact("accuracy") > 0.97 and fit.fact("f1") > 0.97
    assert fit.fact("depth") >= 1 and fit.fact("num_nodes") >= 3
    rough = tp.fit_decision_tree(df, relative_error=0.01)
    assert abs(rough.fact("threshold") - 499) <= 11


def test_tree_and_regression_do_not_depend_on_partitions(points):
    found = []
    for n in (1, 6):
        df = points.repartition(n, "key").select("y", "a", "b", "key")
        found.append(
            (
                tp.fit_decision_tree(df, key=["key"], max_bins=128).facts,
                tp.fit_linear_regression(df, key=["key"]).facts,
            )
        )
    assert found[0] == found[1]


def test_lloyd_equals_the_library_from_the_same_start(spark, points):
    start = [[1.0, 1.0], [5.0, 5.0], [9.0, 12.0]]
    ours = tp.lloyd_kmeans(points, ["a", "b"], centres=start, max_iter=3, tol=0.0)
    rdd = points.select("a", "b").rdd.map(list)
    theirs = KMeans.train(rdd, 3, maxIterations=3, initialModel=KMeansModel(start), epsilon=0.0)
    for a, b in zip(ours.centres, theirs.clusterCenters):
        assert a == pytest.approx(tuple(b))
    assert ours.cost == pytest.approx(theirs.computeCost(rdd))
    assert sum(ours.sizes) == 900
    sizes = {r["prediction"]: r["count"] for r in ours.predict().groupBy("prediction").count().collect()}
    assert tuple(sizes[i] for i in range(3)) == ours.sizes


def test_lloyd_does_not_depend_on_partitions_and_skips_copies(spark):
    copies = [(1.0, 1.0)] * 60 + [(float(i), float(i % 7)) for i in range(40)]
    df = spark.createDataFrame(copies, "a double, b double")
    found = [tp.lloyd_kmeans(df.repartition(n), k=3, max_iter=5) for n in (1, 6)]
    assert found[0].sizes == found[1].sizes
    assert all(size > 0 for size in found[0].sizes)
    only = spark.createDataFrame([(1.0,), (1.0,), (None,)], "a double")
    assert len(tp.lloyd_kmeans(only, k=3).centres) == 2
    with pytest.raises(ValueError):
        tp.lloyd_kmeans(only.limit(0))


def test_oversampled_start_does_not_depend_on_partitions(spark, points):
    found = [
        tp.lloyd_kmeans(points.repartition(n), ["a", "b"], k=4, seeding="oversampled", tol=0.0)
        for n in (2, 4, 16)
    ]
    for other in found[1:]:
        assert other.sizes == found[0].sizes and other.iterations == found[0].iterations
        assert np.allclose(other.centres, found[0].centres, rtol=1e-12)
    facts = [
        sorted(map(str, tp.run_model(points.repartition(n), "kmeans", k=3).collect())) for n in (2, 16)
    ]
    assert facts[0] == facts[1]


def test_oversampled_start_finds_far_clusters(spark):
    """Ten points far away among thousands; copies hold most rows."""
    rows = [(0.0, 0.0)] * 3000 + [(float(i % 50), float(i % 7)) for i in range(2000)]
    rows += [(1e6, float(i)) for i in range(10)] + [(-1e6, 1e6)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    found = tp.lloyd_kmeans(df, k=3, seeding="oversampled")
    assert sorted(found.sizes) == [1, 10, 5000]
    only = spark.createDataFrame([(1.0,), (1.0,), (None,)], "a double")
    assert sorted(tp.lloyd_kmeans(only, k=3, seeding="oversampled").centres) == [(0.0,), (1.0,)]
    with pytest.raises(ValueError):
        tp.lloyd_kmeans(only.limit(0), seeding="oversampled")
    with pytest.raises(ValueError):
        tp.lloyd_kmeans(only, seeding="unknown")


def test_kmeans_sizes_and_cost(points):
    fit = tp.fit_kmeans(points, ["a", "b"], k=4, digits=None)
    assert sum(fit.fact("size", f"cluster {i}") for i in range(4)) == 900
    centres = np.array([[fit.fact(f"centre of {c}", f"cluster {i}") for c in "ab"] for i in range(4)])
    data = points.select("a", "b").toPandas().to_numpy()
    nearest = ((data[:, None] - centres) ** 2).sum(-1).min(1).sum()
    assert fit.fact("cost") == pytest.approx(nearest, rel=0.05)


def test_metrics_of_missing_and_perfect_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, None)], "label double, prediction double")
    assert tuple(tp.regression_metrics(df).first()) == (0.0, 1.0)
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "label double, prediction double")
    assert tuple(tp.regression_metrics(constant).first()) == (1.0, None)
    guess = spark.createDataFrame([(0.0, 2.0), (1.0, 2.0)], "label double, prediction double")
    assert tuple(tp.classification_metrics(guess).first()) == (0.0, 0.0)


def test_lloyd_with_many_centres_and_copies(spark):
    """Copies fill the first batches of starting rows; the number of jobs stays small."""
    df = spark.range(2000).select(
        F.when(F.col("id") < 1500, 1.0).otherwise(F.col("id").cast("double")).alias("x"),
        (F.col("id") * 0).cast("double").alias("y"),
    )
    found = tp.lloyd_kmeans(df, ["x", "y"], k=120, max_iter=2)
    assert len(set(found.centres)) == 120
    assert sum(found.sizes) == 2000
    few = tp.lloyd_kmeans(df.limit(3).union(df.filter("x > 1998")), ["x", "y"], k=10)
    assert len(few.centres) == 2 and few.cost == 0.0


def test_working_set_uses_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    few = spark.range(100).coalesce(1)
    with working_set(few) as rows:
        assert rows.count() == 100
        assert rows.select(F.spark_partition_id()).distinct().count() == cores
    with working_set(spark.range(100).repartition(cores + 3)) as rows:
        assert rows.select(F.spark_partition_id()).distinct().count() == cores + 3
    with working_set(few.where("id < 0")) as rows:
        assert rows.count() == 0


def counted_sets(monkeypatch, module):
    """The rows of each working set a module keeps, as they come."""
    held = []

    @contextmanager
    def counted(df):
        with working_set(df) as rows:
            held.append(rows.count())
            yield rows

    monkeypatch.setattr(module, "working_set", counted)
    return held


def test_passes_of_kmeans_take_blocks_of_points(spark, monkeypatch):
    """A pass hands few blocks to the Python workers, not each point by itself."""
    held = counted_sets(monkeypatch, clustering)
    x = ((F.col("id") * 37) % 1009).cast("double")
    df = spark.range(50_000).select(F.when(F.col("id") % 50 != 0, x).alias("x"))
    found = tp.lloyd_kmeans(df, ["x"], k=3, seeding="oversampled")
    assert sum(found.sizes) == 50_000
    assert held[0] <= 20
    values = np.array([r["x"] or 0.0 for r in df.collect()])
    centres = np.array(found.centres)[:, 0]
    assert found.cost == pytest.approx(((values[:, None] - centres) ** 2).min(axis=1).sum())


def test_levels_of_a_tree_take_blocks_of_rows(spark, monkeypatch):
    """Rows reach the Python workers in blocks; groups of few columns find the same tree."""
    held = counted_sets(monkeypatch, trees)
    df = spark.range(50_000).select(
        F.col("id").alias("key"), (F.col("id") % 997).alias("y"),
        ((F.col("id") * 37) % 1009).alias("a"), ((F.col("id") % 997) / 7.0).alias("b"),
        (F.col("id") % 5).alias("c"), F.when(F.col("id") % 3 > 0, F.col("id") % 211).alias("d"),
    )
    fit = lambda: tp.fit_decision_tree(df, "y", ["a", "b", "c", "d"], key=["key"], digits=None)
    facts = fit().facts
    assert held[0] == 50_000 and max(held[1:]) <= 20
    monkeypatch.setattr(trees, "_CELLS", 1)
    monkeypatch.setattr(quantiles, "_BRACKETS", 3)
    assert fit().facts == facts


def test_blocks_reach_workers_a_few_at_a_time(spark):
    """No batch of many blocks is gathered, on either side."""
    blocks = spark.range(48, numPartitions=1).select(
        F.expr("cast(repeat('abcdefgh', 131072) as binary)").alias("block"))

    def held(arrays):
        for own in arrays:
            yield pa.RecordBatch.from_arrays(
                [pa.array([own.size]), pa.array([pa.total_allocated_bytes()])], names=["n", "held"])

    found = over_blocks(blocks, 2, np.int64, held, "n long, held long").collect()
    assert [r["n"] for r in found] == [131072] * 48
    assert max(r["held"] for r in found) < 8 << 20
    for made in (
        trees.binned(blocks, [[0.5]], np.dtype(np.uint8)),
        trees._level_counts(blocks, {1: trees.Node(4, 2)}, 0, 2, 4, np.dtype(np.int64)),
        quantiles._counted_parts(blocks, 2, {1: [(0.0, 1.0)]}),
    ):
        assert "MapInArrow" not in made._jdf.queryExecution().toString()


def test_a_content_split_is_checked_without_shuffling_rows(spark, tmp_path):
    """Copies and rows with a NULL (which equal none) aside, each row counts once."""
    rows = [(i % 900, f"{i % 900} " + "x" * 50, None if i % 900 == 7 else 0.5) for i in range(1200)]
    spark.createDataFrame(rows, "a long, b string, c double").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = FEATURE_QUERIES["split_by_content_stable"].run(spark, str(tmp_path))
    assert found.first()["different_rows"] == 899
    assert found.first()["copies_together"] and found.first()["same_again"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    keys = [line for line in plan.splitlines() if "Aggregate [" in line and "hash1" in line]
    assert len(keys) == 1 and "Aggregate [hash1" in keys[0]

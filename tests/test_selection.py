"""Splits, folds, grids and the first-wins arg-min."""

from maillens.operators import selection as SE
from maillens.plans import classification as CL


def test_grid_sizes_and_order():
    assert len(CL.grid_points("logreg")) == 216
    assert len(CL.grid_points("svm")) == 108
    assert len(CL.grid_points("tree")) == 6
    assert len(CL.grid_points("nb")) == 3
    g = CL.grid_points("logreg")
    assert g[0]["iterations"] == 10 and g[-1]["iterations"] == 80
    assert g[1]["mini_batch"] == 1.0 and g[0]["mini_batch"] == 0.5


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "key")
    t = SE.add_split(df, "key").collect()
    train = [r for r in t if r.is_train]
    assert 0.75 < len(train) / len(t) < 0.85
    assert all(r.part == r.fold for r in train)
    assert all(r.part == 5 for r in t if not r.is_train)
    assert {r.fold for r in t} == set(range(5))


def test_first_grid_point_wins_ties(spark):
    m = spark.createDataFrame([(0, 0.2), (1, 0.1 + 1e-17), (2, 0.1), (3, None)],
                              "grid_index int, mean_error double")
    assert SE.best_grid_point(m).first().grid_index == 1


def test_fold_train_counts(spark):
    df = SE.add_split(spark.range(500).withColumnRenamed("id", "key"), "key")
    rows = SE.fold_train_counts(df).collect()
    n_train = df.where("is_train").count()
    for r in rows:
        assert r.n_train + r.n_test == n_train

"""Depth-cut trees against separate fits; the report row; row predictions."""

import random

from pyspark.sql import functions as F

from maillens.operators import tree as TR
from maillens.operators.features import assemble

FEATS = ["a", "b", "c"]


def table(spark, n=240):
    rnd = random.Random(8)
    rows = []
    for i in range(n):
        a, b, c = rnd.random(), rnd.random(), rnd.random()
        y = float((a > 0.5) != (b > 0.3 + 0.2 * c)) if rnd.random() < 0.9 else float(rnd.random() < 0.5)
        rows.append((i, y, i % 3, a, b, c))
    return spark.createDataFrame(rows, "key long, label double, part int, a double, b double, c double").coalesce(1)


def test_cut_trees_equal_separate_fits(spark):
    data = table(spark)
    grid = [{"impurity": imp, "max_depth": d, "max_bins": 32, "grid_index": i}
            for i, (imp, d) in enumerate((imp, d) for imp in ("gini", "entropy") for d in (3, 5, 7))]
    got = TR.cross_validate(data, grid, FEATS, 2)
    counts = {(r.grid_index, r.part, r.label, r.prediction): r["count"] for r in
              got.groupBy("grid_index", "part", "label", "prediction").count().collect()}
    vec = assemble(data, FEATS).select("key", "label", "part", "features")
    for g in grid:
        for m in (0, 2):
            model = TR.fit_one(vec.where((F.col("part") < 2) & (F.col("part") != m)), g["impurity"], g["max_depth"])
            want = model.transform(vec.where(F.col("part") == m)).groupBy("label", "prediction").count().collect()
            for r in want:
                assert counts[g["grid_index"], m, r.label, r.prediction] == r["count"], (g, m)


def test_tree_scoring_is_one_pass(spark):
    grid = [{"impurity": "gini", "max_depth": d, "max_bins": 32, "grid_index": i} for i, d in enumerate((3, 5))]
    got = TR.cross_validate(table(spark), grid, FEATS, 2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "UDF" not in plan
    assert got.count() == 240 * 2


def test_split_counts_read_no_text(spark):
    from maillens.plans.catalog import QUERIES

    for name in ("split_counts", "fold_counts", "fold_train_counts"):
        plan = QUERIES[name].build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "text" not in plan, name

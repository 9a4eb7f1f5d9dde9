"""Grid-search queries of the four classifiers.

The linear models carry a DuckDB twin (a recursive CTE running the same
SGD), trees one that grows them level by level, naive Bayes a closed-form
one; report queries leave out the two time columns of
``classification.report`` so that their rows can be compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from maillens.operators import features as FE
from maillens.plans import classification as CL
from maillens.plans.ml_queries import DOC_FEATURES, learning_table, nb_table
from maillens.plans.registry import query


def _keyed(t):
    return t.withColumnRenamed("doc_id", "key")


def linear_table(spark, sf_dir):
    """Standardised (mean and std of all rows, as the scripts did)."""
    t = FE.standardize(learning_table(spark, sf_dir), DOC_FEATURES)
    return CL.prepared(_keyed(t), DOC_FEATURES)


def tree_table(spark, sf_dir):
    """Unscaled features (the tree script does not scale)."""
    return CL.prepared(_keyed(learning_table(spark, sf_dir)), DOC_FEATURES)


def bayes_table(spark, sf_dir):
    return CL.prepared(_keyed(nb_table(spark, sf_dir)), DOC_FEATURES)


_TABLES = {"logreg": linear_table, "svm": linear_table, "tree": tree_table, "nb": bayes_table}


def _cv(model):
    def build(spark, sf_dir):
        from maillens.functions.text import round6

        t = _TABLES[model](spark, sf_dir)
        m = CL.grid_metrics(spark, model, t, DOC_FEATURES)
        m = spark.createDataFrame(m.collect(), m.schema)   # grid points x parts
        t.unpersist()
        cv = CL.cv_summary(spark, model, m)
        return cv.withColumn("mean_error", round6(F.col("mean_error")))
    build.__doc__ = f"Mean 5-fold CV error of every {CL.MODEL_NAMES[model]} grid point."
    return build


def _final(model):
    def build(spark, sf_dir):
        from maillens.functions.text import round6
        from maillens.operators import selection as SE

        t = _TABLES[model](spark, sf_dir)
        m = CL.grid_metrics(spark, model, t, DOC_FEATURES)
        m = spark.createDataFrame(m.collect(), m.schema)   # grid points x parts
        t.unpersist()
        best = SE.best_grid_point(CL.cv_summary(spark, model, m)).select("grid_index")
        fin = m.where(F.col("part") == SE.N_FOLDS).join(F.broadcast(best), "grid_index")
        return fin.select("grid_index", "n", "tp", "fp", "fn", "tn",
                          *[round6(F.col(c)).alias(c)
                            for c in ("error", "accuracy", "aupr", "auroc")])
    build.__doc__ = (f"{CL.MODEL_NAMES[model]}: best grid point refit on all training rows, "
                     "scored on the test part (error, accuracy %, AUPR, AUROC).")
    return build


def _recursive(body: str, ctes: list[tuple[str, str]]) -> str:
    """``body`` over the document learning table and ``ctes``."""
    from maillens.plans import ml_queries as MQ
    from maillens.sources import fixtures as fx

    sql = fx.with_fixtures(body, "doc_features", extra=dict([("learn", MQ._LEARN), *ctes]))
    return "with recursive " + sql[len("with "):]


def _recursive_insiders(body: str, ctes: list[tuple[str, str]]) -> str:
    """``body`` over the insider learning table and ``ctes``."""
    from maillens.plans import ml_queries as MQ

    chain = [("learn", MQ._insider_learn_sql()), *ctes]
    return "with recursive " + ",\n".join(f"{n} as ({q})" for n, q in chain) + "\n" + body


def _model_ctes(model: str, feats: list[str]) -> list[tuple[str, str]]:
    """Twin of a model's grid search over ``learn``: recursive SGD or trees."""
    from maillens.plans import ml_queries as MQ
    from maillens.plans.sgd_oracle import sgd_ctes
    from maillens.plans.tree_oracle import tree_ctes

    if model == "tree":
        return tree_ctes(CL.grid_points(model), feats, MQ.K)
    stats = "select " + ", ".join(f"avg({c}) m_{c}, stddev_samp({c}) sd_{c}"
                                  for c in feats) + " from learn"
    lin = ("select doc_id, label, part, " + ", ".join(
        f"case when sd_{c} is null or sd_{c} = 0 then 0.0 "
        f"else ({c} - m_{c}) * (1.0 / sd_{c}) end {c}" for c in feats)
        + " from learn, stats")
    kind = "logistic" if model == "logreg" else "hinge"
    return [("stats", stats), ("lin", lin), *sgd_ctes(kind, CL.grid_points(model), feats, MQ.K)]


def _model_sql(model: str, body: str = "select * from cv") -> str:
    return _recursive(body, _model_ctes(model, DOC_FEATURES))


def _without_times(row):
    from maillens.functions.text import round6

    doubles = ("best_cv_error", "final_accuracy", "final_aupr", "final_auroc", "final_error")
    return row.select("model", "grid_size", F.transform("errors", round6).alias("errors"),
                      "best_grid_index", "best_params", *[round6(F.col(c)).alias(c) for c in doubles], "n_test")


def _report(model):
    def build(spark, sf_dir):
        t = _TABLES[model](spark, sf_dir)
        row = CL.report(spark, model, t, DOC_FEATURES)
        t.unpersist()
        return _without_times(row)
    build.__doc__ = f"{CL.MODEL_NAMES[model]}: best grid point, test accuracy, AUPR, AUROC."
    return build


for _m in ("logreg", "svm", "tree"):
    query(f"cv_{_m}", sql=_model_sql(_m))(_cv(_m))


def _predictions(model):
    def build(spark, sf_dir):
        from maillens.operators import linear as LIN
        from maillens.operators import selection as SE

        t = linear_table(spark, sf_dir)
        m = CL.grid_metrics(spark, model, t, DOC_FEATURES)
        best = SE.best_grid_point(CL.cv_summary(spark, model, m)).first()
        kind = "logistic" if model == "logreg" else "hinge"
        weights, intercept = LIN.final_weights(
            t, kind, CL.grid_points(model)[best["grid_index"]], DOC_FEATURES, SE.N_FOLDS)
        out = LIN.predict(t.where(F.col("part") == SE.N_FOLDS), weights, intercept, DOC_FEATURES)
        t.unpersist()      # the prediction is one pass over the checkpointed table
        return out.select(F.col("key").alias("doc_id"), "label", "prediction")
    build.__doc__ = f"{CL.MODEL_NAMES[model]}: prediction of the best refitted model for every test row."
    return build


def _score_areas(metric):
    def build(spark, sf_dir):
        from maillens.functions.text import round6
        from maillens.operators import linear as LIN
        from maillens.operators import ranking as RK
        from maillens.operators import selection as SE

        t = linear_table(spark, sf_dir)
        scored, models = LIN.grid_scores(t, "logistic", CL.grid_points("logreg"), DOC_FEATURES, SE.N_FOLDS)
        areas = RK.score_metrics(scored, ["model", "part"])
        t.unpersist()
        return areas.join(F.broadcast(models), "model").select(
            "grid_index", "part", "n", round6(F.col(metric)).alias(metric))
    build.__doc__ = f"{metric.upper()} from the scores of every logistic grid point on every part."
    return build


def _report_sql(model: str, best: str, cv: str, fin: str) -> str:
    """The report row from ``best(grid_index)``, ``cv(grid_index, params,
    mean_error)`` and ``fin(grid_index, ...)``."""
    return (f"select '{CL.MODEL_NAMES[model]}' model, {len(CL.grid_points(model))}::INTEGER grid_size, "
            f"(select list(mean_error order by grid_index) from ({cv})) errors, "
            "b.grid_index best_grid_index, c.params best_params, c.mean_error best_cv_error, "
            "f.accuracy final_accuracy, f.aupr final_aupr, f.auroc final_auroc, f.error final_error, "
            f"f.n n_test from ({best}) b join ({cv}) c using (grid_index) join ({fin}) f using (grid_index)")


def _nb_report_sql() -> str:
    import json

    from maillens.plans import ml_queries as MQ

    params = " ".join(
        f"when {g['grid_index']} then '" + json.dumps(
            {k: v for k, v in g.items() if k != "grid_index"}, sort_keys=True) + "'"
        for g in CL.grid_points("nb"))
    cv = (f"select grid_index, case grid_index {params} end params, "
          f"{MQ._r6('mean_error')} mean_error from mean")
    rounded = ", ".join(f"{MQ._r6(c)} {c}" for c in ("accuracy", "aupr", "auroc", "error"))
    return _report_sql("nb", "select grid_index from best", cv,
                       f"select grid_index, n, {rounded} from met where part = {MQ.K}")


for _m in ("logreg", "svm", "tree"):
    query(f"final_{_m}", sql=_model_sql(_m, "select * from fin"))(_final(_m))
    query(f"report_{_m}", sql=_model_sql(_m, _report_sql(
        _m, "select * from best", "select * from cv", "select * from fin")))(_report(_m))
for _m in ("auroc", "aupr"):
    query(f"score_{_m}", sql=_model_sql("logreg", f"select grid_index, part, n::BIGINT n, "
                                        f"round({_m} * 1000000.0) / 1000000.0 {_m} from areas"))(_score_areas(_m))
for _m in ("logreg", "svm"):
    query(f"{_m}_predictions", sql=_model_sql(_m, "select * from predicted"))(_predictions(_m))


def _register_nb_report():
    from maillens.plans import ml_queries as MQ

    query("report_nb", sql=MQ._ml_sql(_nb_report_sql()))(_report("nb"))


_register_nb_report()


# ------------------------------------------------------------ insider table
# The scripts' own input: the 21-column insider feature CSV, label =
# column 20 (poi), features at the fixed positions.


def insider_learning(spark, sf_dir):
    """(key, label, features..., is_train, fold, part) and feature names."""
    from maillens.operators import selection as SE
    from maillens.plans.ml_queries import feature_csv

    sel = FE.select_features(FE.fill_numeric(feature_csv(spark, sf_dir)), keep=("email",))
    feats = sel.columns[2:]
    sel = FE.to_double(sel, ["label"] + feats)
    sel = SE.add_split(sel, "email")
    return sel.withColumnRenamed("email", "key"), feats


def _insider_table(model, spark, sf_dir):
    t, feats = insider_learning(spark, sf_dir)
    if model in ("logreg", "svm"):
        t = FE.standardize(t, feats)
    elif model == "nb":
        t = FE.absolute(FE.standardize(t, feats, with_mean=False), ["label"] + feats)
    return CL.prepared(t, feats), feats


def _insider_report(model):
    def build(spark, sf_dir):
        t, feats = _insider_table(model, spark, sf_dir)
        row = CL.report(spark, model, t, feats)
        t.unpersist()
        return _without_times(row)
    build.__doc__ = (f"{CL.MODEL_NAMES[model]} on the insider feature table "
                     "(the scripts' own input): report row.")
    return build


def _insider_report_sql(model: str) -> str:
    from maillens.plans import ml_queries as MQ

    if model == "nb":
        return MQ._insider_sql(_nb_report_sql())
    return _recursive_insiders(_report_sql(model, "select * from best", "select * from cv", "select * from fin"),
                               _model_ctes(model, MQ._INSIDER_FEATS))


for _m in ("logreg", "svm", "tree", "nb"):
    query(f"report_{_m}_insiders", sql=_insider_report_sql(_m))(_insider_report(_m))


# ------------------------------------------------------------ Spark ML's own trainer

ML_GRID = {"reg_param": [0.1, 1.0], "reg_type": ["l2"], "intercept": [True]}


def _lin_cte() -> list[tuple[str, str]]:
    return _model_ctes("logreg", DOC_FEATURES)[:2]


def _register_ml():
    from maillens.operators import selection as SE
    from maillens.plans import ml_queries as MQ
    from maillens.plans.sgd_oracle import ridge_ctes

    grid = SE.param_grid(ML_GRID)
    sql = _recursive(
        f"select grid_index, part, n, tp, fp, fn, tn, {MQ._r6('(fp + fn) / n')} error from conf",
        [*_lin_cte(), *ridge_ctes([g["reg_param"] for g in grid], DOC_FEATURES, MQ.K, 600, 0.4)])

    @query("cv_ml_logreg", sql=sql)
    def q_cv_ml_logreg(spark, sf_dir):
        """L-BFGS logistic regression (Spark ML) on every fold and the test part:
        confusion counts and error of the hard labels. The optimum is unique, so
        these agree with any other way to it; weights do to about 1e-4."""
        from maillens.functions.text import round6
        from maillens.operators import linear as LIN
        from maillens.operators import metrics as ME

        t = linear_table(spark, sf_dir)
        found = ME.evaluate(LIN.ml_cross_validate(t, "logistic", grid, DOC_FEATURES, SE.N_FOLDS),
                            ["grid_index", "part"])
        found = spark.createDataFrame(found.collect(), found.schema)     # grid points x parts
        t.unpersist()
        return found.select("grid_index", "part", "n", "tp", "fp", "fn", "tn", round6(F.col("error")).alias("error"))


_register_ml()


# ------------------------------------------------------------ results store


def _roundtrip(fmt):
    def build(spark, sf_dir):
        from maillens.session import scratch_path
        from maillens.sources import results as RS

        t = bayes_table(spark, sf_dir)
        row = _without_times(CL.report(spark, "nb", t, DOC_FEATURES))
        t.unpersist()
        path = scratch_path(spark, f"results-{fmt}")
        RS.append_result(row.limit(0), path, "second", fmt)
        RS.append_result(row.withColumn("model", F.lit("stale")), path, "first", fmt)
        RS.append_result(row, path, "second", fmt)
        RS.append_result(row, path, "first", fmt)          # a rerun replaces its own run only
        return RS.read_results(spark, path, row.schema, fmt)
    build.__doc__ = f"A nested report row appended to a {fmt} store by two runs, one of them twice, and read back."
    return build


def _register_roundtrips():
    from maillens.plans import ml_queries as MQ

    sql = MQ._ml_sql(f"select run, r.* from ({_nb_report_sql()}) r, (values ('first'), ('second')) v(run)")
    query("result_roundtrip", sql=sql)(_roundtrip("parquet"))
    query("result_roundtrip_csv", sql=sql)(_roundtrip("csv"))


_register_roundtrips()

"""Queries of the classification stage (features, splits, Naive Bayes,
metrics) with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from maillens.functions.text import round6
from maillens.operators import bayes as NB
from maillens.operators import features as FE
from maillens.operators import metrics as ME
from maillens.operators import selection as SE
from maillens.operators import traffic as TR
from maillens.plans.registry import query
from maillens.sources import fixtures as fx
from maillens.sources import mail as S
from maillens.sources.scratch import materialize
from maillens.sources.tables import read_table

K = SE.N_FOLDS
DOC_FEATURES = list(fx.DOC_FEATURE_COLUMNS)

# ---------------------------------------------------------------- Spark side


def learning_table(spark, sf_dir):
    """(doc_id, label, 10 double features, is_train, fold, part).

    Checkpointed to the shared folder (lineage cut): scaling statistics,
    class sums and scoring each read it, and the character counts over
    whole documents are computed once."""
    df = FE.labelled(fx.doc_features(spark, sf_dir), "doc_id", "label", DOC_FEATURES)
    return SE.add_split(df, "doc_id").checkpoint(eager=True)


def learning_keys(spark, sf_dir):
    """(doc_id, label, is_train, fold, part): the split without any feature,
    so a count reads ids and labels only."""
    ids = read_table(spark, sf_dir, "documents").select("doc_id")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return SE.add_split(ids.join(labels, "doc_id"), "doc_id")


def nb_table(spark, sf_dir):
    """Std-only scaling fitted on all rows, then |x| (label included)."""
    t = learning_table(spark, sf_dir)
    t = FE.standardize(t, DOC_FEATURES, with_mean=False, with_std=True)
    return FE.absolute(t, ["label"] + DOC_FEATURES)


def nb_cross_validation(spark, sf_dir):
    t = nb_table(spark, sf_dir)
    return NB.cross_validate(spark, t, DOC_FEATURES, K)


def nb_evaluation(spark, sf_dir):
    """Per (part, smoothing) metrics; grid_index = position of smoothing.

    Evaluated once: the rows (parts x smoothing values, a fixed number) come
    back as a local table, from which best and final rows are derived."""
    _, _, pred = nb_cross_validation(spark, sf_dir)
    ev = ME.evaluate(pred, ["part", "smoothing"])
    idx = F.array_position(F.array(*[F.lit(s) for s in NB.SMOOTHING]), F.col("smoothing"))
    ev = ev.withColumn("grid_index", (idx - 1).cast("int"))
    return spark.createDataFrame(ev.collect(), ev.schema)


def nb_best(ev):
    """The best smoothing of ``nb_evaluation``'s table."""
    mean = SE.mean_cv_error(ev, K)
    smooth = ev.select("grid_index", "smoothing").distinct()
    return SE.best_grid_point(mean).join(smooth, "grid_index")


def insider_csv(spark, sf_dir) -> str:
    def write(path):
        S.write_result(fx.insiders(spark, sf_dir), path)
    return materialize(spark, "insiders-csv", fx.source_paths(sf_dir, "customer"), write)


def insider_feature_csv(spark, sf_dir) -> str:
    def write(path):
        S.write_result(TR.insider_features(fx.messages(spark, sf_dir),
                                           fx.insiders(spark, sf_dir)), path)
    return materialize(
        spark, "insider-features-csv",
        fx.source_paths(sf_dir, "customer", "orders", "lineitem"), write)


def feature_csv(spark, sf_dir):
    return S.read_feature_csv(spark, insider_feature_csv(spark, sf_dir))


# ---------------------------------------------------------------- oracle side



def _r6(x: str) -> str:
    return f"round(({x}) * 1000000.0) / 1000000.0"


_LEARN = (
    "select *, case when is_train then fold else " + str(K) + " end part from ("
    f"select doc_id, label::DOUBLE label, "
    + ", ".join(f"{c}::DOUBLE {c}" for c in DOC_FEATURES)
    + f", {SE.bucket_sql('doc_id')} % 100 < {SE.TRAIN_PCT} is_train, "
    f"({SE.bucket_sql('doc_id', SE.FOLD_SALT)} % {K})::INTEGER fold from doc_features)"
)
_PRED = ("select doc_id, part, smoothing, y label, "
         "first(c order by score desc, c asc) prediction from scores group by 1, 2, 3, 4")
_EV = (
    "select part, smoothing, (list_position([" + ", ".join(str(s) for s in NB.SMOOTHING)
    + "], smoothing) - 1)::INTEGER grid_index, count(*) n, "
    "count(*) filter (where prediction = 1 and label = 1) tp, "
    "count(*) filter (where prediction = 1 and label <> 1) fp, "
    "count(*) filter (where prediction <> 1 and label = 1) fn, "
    "count(*) filter (where prediction <> 1 and label <> 1) tn, "
    "sum(abs(prediction - label)) sabs, sum((prediction - label) ^ 2) ssq "
    "from pred group by 1, 2"
)
_MET = (
    "select *, (fp + fn) / n error, (1 - (fp + fn) / n) * 100 accuracy, "
    "case when tp + fp > 0 then t1 * (tp / (tp + fp)) + (t0 - t1) * ((tp / (tp + fp)) + p0) / 2 "
    "else t0 * p0 end aupr, "
    "f1 * t1 / 2 + (f0 - f1) * (t1 + t0) / 2 + (1 - f0) * (t0 + 1) / 2 auroc, "
    "sabs / n mae, ssq / n mse from ("
    "select *, case when tp + fn > 0 then tp / (tp + fn) else 0.0 end t1, "
    "case when fp + tn > 0 then fp / (fp + tn) else 0.0 end f1, "
    "case when tp + fn > 0 then 1.0 else 0.0 end t0, "
    "case when fp + tn > 0 then 1.0 else 0.0 end f0, (tp + fn) / n p0 from ev)"
)
_MEAN = (f"select grid_index, avg(error) mean_error, count(error) n_folds from met "
         f"where part < {K} group by 1")
_BEST = ("select m.*, (select any_value(smoothing) from met where met.grid_index = m.grid_index)"
         " smoothing from mean m order by round(mean_error, 12) nulls last, grid_index limit 1")


def _nb_chain(feats: list[str], learn_sql: str) -> list[tuple[str, str]]:
    """DuckDB twin of the naive Bayes cross-validation over ``learn``
    (doc_id, label, features..., is_train, fold, part)."""
    std = "select " + ", ".join(f"stddev_samp({c}) sd_{c}" for c in feats) + " from learn"
    nb = ("select doc_id, abs(label) label, is_train, fold, part, "
          + ", ".join(f"abs({c} * case when sd_{c} is null or sd_{c} = 0 then 0.0 "
                      f"else 1.0 / sd_{c} end) {c}" for c in feats)
          + " from learn, sd")
    sums = (f"select part, label, count(*) n, "
            + ", ".join(f"sum({c}) {c}" for c in feats)
            + f" from nb where part < {K} group by 1, 2")
    ms = (f"select m.m part, s.label, sum(s.n) n, "
          + ", ".join(f"sum(s.{c}) {c}" for c in feats)
          + f" from (select range::INTEGER m from range(0, {K + 1})) m "
          "join sums s on s.part <> m.m group by 1, 2")
    tot = "select part, sum(n) n_all, count(*) n_cls from ms group by 1"
    lam = "select unnest([" + ", ".join(str(x) for x in NB.SMOOTHING) + "])::DOUBLE smoothing"
    sumx = " + ".join(f"ms.{c}" for c in feats)
    model = (
        "select ms.part, lam.smoothing, ms.label, "
        "ln(ms.n + lam.smoothing) - ln(tot.n_all + tot.n_cls * lam.smoothing) pi, "
        + ", ".join(f"ln(ms.{c} + lam.smoothing) - ln({sumx} + {len(feats)} * lam.smoothing)"
                    f" t_{c}" for c in feats)
        + " from ms join tot using (part) cross join lam")
    scores = ("select nb.doc_id, nb.part, nb.label y, model.smoothing, model.label c, pi + "
              + " + ".join(f"t_{c} * nb.{c}" for c in feats)
              + " score from nb join model using (part)")
    return [("learn", learn_sql), ("sd", std), ("nb", nb), ("sums", sums), ("ms", ms),
            ("tot", tot), ("lam", lam), ("model", model), ("scores", scores),
            ("pred", _PRED), ("ev", _EV), ("met", _MET), ("mean", _MEAN), ("best", _BEST)]


def _ml_sql(body: str, upto: str = "best") -> str:
    chain = _nb_chain(DOC_FEATURES, _LEARN)
    names = [n for n, _ in chain]
    chain = chain[:names.index(upto) + 1]
    return fx.with_fixtures(body, "doc_features", extra=dict(chain))


# ---------------------------------------------------------------- queries


@query("doc_features", sql=fx.with_fixtures("select * from doc_features", "doc_features"))
def q_doc_features(spark, sf_dir):
    """Labelled learning table: 10 character counts per labelled document."""
    return fx.doc_features(spark, sf_dir)


@query("insiders_csv", sql=fx.with_fixtures("select * from insiders", "insiders"))
def q_insiders_csv(spark, sf_dir):
    """Person CSV read back by position with the fixed schema."""
    return S.read_insiders(spark, insider_csv(spark, sf_dir))


_IF_COLS = (["name", "email"] + list(fx.FEATURE_COLUMNS)
            + ["n_sent", "n_received", "n_from_poi", "n_to_poi", "poi"])


def _insider_features_sql(select: str) -> str:
    from maillens.plans.traffic_queries import _insider_features_sql as base
    inner = base("left")
    return f"select {select} from ({inner})"


_CSV_SELECT = ", ".join(f"{c}::INTEGER {c}" if c.startswith("n_") else c for c in _IF_COLS)


@query("feature_csv", sql=_insider_features_sql(_CSV_SELECT))
def q_feature_csv(spark, sf_dir):
    """Insider feature CSV (header, inferred types) as the classifiers read it."""
    return feature_csv(spark, sf_dir)


_FILL_SELECT = ", ".join(
    f"coalesce({c}, 0) {c}" if c.startswith("f") else
    (f"{c}::INTEGER {c}" if c.startswith("n_") else c) for c in _IF_COLS)


@query("fill_numeric", sql=_insider_features_sql(_FILL_SELECT))
def q_fill_numeric(spark, sf_dir):
    """Numeric null / NaN cells filled with 0."""
    return FE.fill_numeric(feature_csv(spark, sf_dir))


_SEL_NAMES = [_IF_COLS[i] for i in FE.FEATURE_POSITIONS]


def _sel(c: str, cast: str = "") -> str:
    if c.startswith("f"):
        v = f"coalesce({c}, 0)"
    elif c.startswith("n_"):
        v = f"{c}::INTEGER"
    else:
        v = c
    return f"({v}){cast} {c}"


@query("feature_select", sql=_insider_features_sql(
    "email, poi label, " + ", ".join(_sel(c) for c in _SEL_NAMES)))
def q_feature_select(spark, sf_dir):
    """Label (column 20) and features at positions 2-5, 11-13, 15, 18, 19."""
    return FE.select_features(FE.fill_numeric(feature_csv(spark, sf_dir)), keep=("email",))


@query("labelled_points", sql=_insider_features_sql(
    "email, poi::INTEGER::DOUBLE label, " + ", ".join(_sel(c, "::DOUBLE") for c in _SEL_NAMES)))
def q_labelled_points(spark, sf_dir):
    """Selected columns as doubles; boolean label as 0.0 / 1.0."""
    sel = FE.select_features(FE.fill_numeric(feature_csv(spark, sf_dir)), keep=("email",))
    return FE.to_double(sel, ["label"] + _SEL_NAMES)


@query("split_counts", sql=_ml_sql("select is_train, count(*) n from learn group by 1", "learn"))
def q_split_counts(spark, sf_dir):
    """Rows in the 80 % training and 20 % test part (hash split)."""
    return SE.split_counts(learning_keys(spark, sf_dir))


@query("fold_counts", sql=_ml_sql(
    "select fold, count(*) n from learn where is_train group by 1", "learn"))
def q_fold_counts(spark, sf_dir):
    """Training rows per fold (5 folds)."""
    return (learning_keys(spark, sf_dir).where("is_train")
            .groupBy("fold").agg(F.count(F.lit(1)).alias("n")))


@query("fold_train_counts", sql=_ml_sql(
    "select fold, (sum(n) over () - n)::BIGINT n_train, n n_test from "
    "(select fold, count(*) n from learn where is_train group by 1)", "learn"))
def q_fold_train_counts(spark, sf_dir):
    """Training (other 4 folds) and test rows of each CV round."""
    return SE.fold_train_counts(learning_keys(spark, sf_dir))


@query("scaler_stats", sql=_ml_sql(
    "select feature, " + _r6("mean") + " mean, " + _r6("std") + " std from ("
    + " union all ".join(f"select '{c}' feature, avg({c}) mean, stddev_samp({c}) std from learn"
                         for c in DOC_FEATURES) + ")", "learn"))
def q_scaler_stats(spark, sf_dir):
    """Mean and sample standard deviation per feature."""
    st = FE.scaler_stats_table(learning_table(spark, sf_dir), DOC_FEATURES)
    return st.select("feature", round6(F.col("mean")).alias("mean"),
                     round6(F.col("std")).alias("std"))


_SCALED = ", ".join(
    _r6(f"case when sd_{c} is null or sd_{c} = 0 then 0.0 else ({c} - m_{c}) * (1.0 / sd_{c}) end")
    + f" {c}" for c in DOC_FEATURES)
_MEANS = ("select " + ", ".join(f"avg({c}) m_{c}, stddev_samp({c}) sd_{c}" for c in DOC_FEATURES)
          + " from learn")


@query("scaled_features", sql=_ml_sql(
    f"select doc_id, label, {_SCALED} from learn, ({_MEANS})", "learn"))
def q_scaled_features(spark, sf_dir):
    """Standardised features: (x - mean) / sample std, zero std -> 0."""
    t = learning_table(spark, sf_dir).select("doc_id", "label", *DOC_FEATURES)
    t = FE.standardize(t, DOC_FEATURES)
    return t.select("doc_id", "label", *[round6(F.col(c)).alias(c) for c in DOC_FEATURES])


@query("nb_features", sql=_ml_sql(
    "select doc_id, label, " + ", ".join(_r6(c) + f" {c}" for c in DOC_FEATURES)
    + " from nb", "nb"))
def q_nb_features(spark, sf_dir):
    """Std-only scaling, then absolute values (Naive Bayes input)."""
    t = nb_table(spark, sf_dir)
    return t.select("doc_id", "label", *[round6(F.col(c)).alias(c) for c in DOC_FEATURES])


@query("nb_model", sql=_ml_sql(
    "select part, smoothing, label, " + _r6("pi") + " pi, "
    + ", ".join(_r6(f"t_{c}") + f" t_{c}" for c in DOC_FEATURES)
    + " from model", "model"))
def q_nb_model(spark, sf_dir):
    """Naive Bayes parameters of every part (5 folds + final) and smoothing."""
    tbl, classes, _ = nb_cross_validation(spark, sf_dir)
    d = len(DOC_FEATURES)
    per_class = [
        tbl.where(F.col(f"pi_{i}").isNotNull()).select(
            "part", "smoothing", F.lit(float(c)).alias("label"),
            round6(F.col(f"pi_{i}")).alias("pi"),
            *[round6(F.col(f"t_{i}_{j}")).alias(f"t_{DOC_FEATURES[j]}") for j in range(d)])
        for i, c in enumerate(classes)]
    out = per_class[0]
    for other in per_class[1:]:
        out = out.unionByName(other)
    return out


@query("nb_predictions", sql=_ml_sql("select * from pred", "pred"))
def q_nb_predictions(spark, sf_dir):
    """Prediction of every evaluation row under every smoothing value."""
    _, _, pred = nb_cross_validation(spark, sf_dir)
    return pred.select("doc_id", "part", "smoothing", "label", "prediction")


_MET_COLS = ("part, smoothing, grid_index, n, tp, fp, fn, tn, "
             + ", ".join(f"{_r6(c)} {c}" for c in ("error", "accuracy", "aupr", "auroc",
                                                     "mae", "mse")))


def _met_spark(df):
    keep = ["part", "smoothing", "grid_index", "n", "tp", "fp", "fn", "tn"]
    return df.select(*keep, *[round6(F.col(c)).alias(c) for c in
                              ("error", "accuracy", "aupr", "auroc", "mae", "mse")])


@query("cv_nb", sql=_ml_sql(f"select {_MET_COLS} from met", "met"))
def q_cv_nb(spark, sf_dir):
    """Error, accuracy, AUPR, AUROC per fold (and final part) and smoothing."""
    return _met_spark(nb_evaluation(spark, sf_dir))


@query("cv_errors", sql=_ml_sql(
    f"select grid_index, {_r6('mean_error')} mean_error, n_folds from mean", "mean"))
def q_cv_errors(spark, sf_dir):
    """Mean cross-validation error per grid point (non-empty folds)."""
    m = SE.mean_cv_error(nb_evaluation(spark, sf_dir), K)
    return m.select("grid_index", round6(F.col("mean_error")).alias("mean_error"), "n_folds")


@query("best_params", sql=_ml_sql(
    f"select grid_index, {_r6('mean_error')} mean_error, n_folds, smoothing from best"))
def q_best_params(spark, sf_dir):
    """Smallest mean error; ties to the first grid point."""
    b = nb_best(nb_evaluation(spark, sf_dir))
    return b.select("grid_index", round6(F.col("mean_error")).alias("mean_error"),
                    "n_folds", "smoothing")


@query("nb_final", sql=_ml_sql(
    f"select {_MET_COLS} from met where part = {K} "
    "and grid_index = (select grid_index from best)"))
def q_nb_final(spark, sf_dir):
    """Best smoothing refit on all training rows, scored on the test part:
    error, accuracy %, AUPR, AUROC (hard labels), MAE, MSE."""
    ev = nb_evaluation(spark, sf_dir)
    best = nb_best(ev).select("grid_index")
    return _met_spark(ev.where(F.col("part") == K).join(F.broadcast(best), "grid_index"))


_FINAL_WHERE = f" from met where part = {K} and grid_index = (select grid_index from best)"


def _final_cols(*cols):
    def build(spark, sf_dir):
        return q_nb_final(spark, sf_dir).select("grid_index", *cols)
    return build


for _name, _cols, _doc in (
        ("test_error", ("n", "error", "accuracy"),
         "Misclassification rate and accuracy % of the final model on the test part."),
        ("aupr", ("aupr",), "Area under the PR curve of the final model's hard labels."),
        ("auroc", ("auroc",), "Area under the ROC curve of the final model's hard labels."),
        ("prediction_errors", ("mae", "mse"),
         "Mean absolute and squared error of the final model's predictions.")):
    _fn = _final_cols(*_cols)
    _fn.__doc__ = _doc
    _sql_cols = ", ".join(c if c == "n" else f"{_r6(c)} {c}" for c in _cols)
    query(_name, sql=_ml_sql(f"select grid_index, {_sql_cols}" + _FINAL_WHERE))(_fn)


# ------------------------------------------------------------ insider table
# Naive Bayes on the scripts' own input (insider feature CSV, label = poi,
# features at the fixed positions), SQL-checked end to end.

_INSIDER_FEATS = [_IF_COLS[i] for i in FE.FEATURE_POSITIONS]


def _insider_learn_sql() -> str:
    cols = ", ".join(
        (f"coalesce({c}, 0)::DOUBLE {c}" if c.startswith("f") else f"{c}::DOUBLE {c}")
        for c in _INSIDER_FEATS)
    inner = (f"select email doc_id, poi::INTEGER::DOUBLE label, {cols}, "
             f"{SE.bucket_sql('email')} % 100 < {SE.TRAIN_PCT} is_train, "
             f"({SE.bucket_sql('email', SE.FOLD_SALT)} % {K})::INTEGER fold "
             f"from ({_insider_features_sql('*')})")
    return f"select *, case when is_train then fold else {K} end part from ({inner})"


def _insider_sql(body: str) -> str:
    chain = _nb_chain(_INSIDER_FEATS, _insider_learn_sql())
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in chain) + "\n" + body


def insider_nb_evaluation(spark, sf_dir):
    from maillens.plans.model_queries import insider_learning

    t, feats = insider_learning(spark, sf_dir)
    t = FE.absolute(FE.standardize(t, feats, with_mean=False), ["label"] + feats)
    _, _, pred = NB.cross_validate(spark, t, feats, K)
    ev = ME.evaluate(pred, ["part", "smoothing"])
    idx = F.array_position(F.array(*[F.lit(s) for s in NB.SMOOTHING]), F.col("smoothing"))
    return ev.withColumn("grid_index", (idx - 1).cast("int"))


@query("cv_nb_insiders", sql=_insider_sql(f"select {_MET_COLS} from met"))
def q_cv_nb_insiders(spark, sf_dir):
    """Naive Bayes CV on the insider feature CSV (label poi): metrics per
    fold / final part and smoothing."""
    return _met_spark(insider_nb_evaluation(spark, sf_dir))

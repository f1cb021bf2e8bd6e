"""Model input, models and their evaluation."""

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from venue_queries import views as V
from venue_queries.growth import metrics as growth_metrics
from venue_queries.io import geo
from venue_queries.profiles import analysis
from venue_queries.registry import query, r, rounded
from venuekit.operators import metrics as E
from venuekit.operators import success as S
from venuekit.operators.ranks import attach
from venuekit.operators.sampling import split
from venuekit.plans import datasets as D
from venuekit.plans import forests as O
from venuekit.plans import models as M
from venuekit.session import materialize, new_path
from venuekit.sinks.tables import save_model

NUMBERS = ["stars", "review_count", "is_open", "success", "has_wifi", "state_idx", "avg_growth_rate", "avg_star_change",
           "years_with_data"]
_MODEL = "business_id, " + ", ".join(f"{r(c)} as {c}" for c in NUMBERS)


def model_data(spark, d):
    return D.model_dataset(analysis(spark, d), geo(spark, d), growth_metrics(spark, d))


def stored_model_data(spark, d):
    """Model input written out once: a fit reads it many times."""
    return materialize(model_data(spark, d), "model-data")


@query("model_dataset", f"select {_MODEL} from model_v", "model_v")
def model_dataset(spark, d):
    return rounded(model_data(spark, d))


@query("state_index", "select state, state_idx from state_rank_v", "state_rank_v")
def state_index(spark, d):
    return D.state_index(geo(spark, d).select("business_id", "state"))


@query("city_index", """
select city, cast(row_number() over (order by count(*) desc, city) - 1 as double) as city_idx
from geo_v where city is not null group by city""", "geo_v")
def city_index(spark, d):
    return D.state_index(geo(spark, d).select("business_id", "city"), "city", "city_idx")


@query("fallback_dataset", f"""
select business_id, stars, review_count, is_open, city, state, success, wifi_share as has_wifi, takes_credit_cards,
       (select count(*) from review_v r where r.business_id = f.business_id) as reviews_seen,
       {r('avg_review_stars')} as avg_review_stars from feature_v f join votes_v using (business_id)""", "feature_v", "votes_v")
def fallback_dataset(spark, d):
    data = D.fallback_dataset(V.businesses(spark, d), V.reviews(spark, d))
    return rounded(data.drop("name", "categories", "latitude", "longitude"))


@query("model_dataset_direct", f"""
select business_id, coalesce(stars, 0.0) as stars, cast(review_count as double) as review_count, is_open,
       case when stars >= 4.0 then 1.0::double else 0.0::double end as success, wifi_share as has_wifi, takes_credit_cards
from feature_v join votes_v using (business_id)""", "feature_v", "votes_v")
def model_dataset_direct(spark, d):
    return D.model_dataset(D.fallback_dataset(V.businesses(spark, d), V.reviews(spark, d)))


@query("describe_model", " union all ".join(
    f"""select '{c}' as "column", count({c}) as count, {r(f'avg({c})')} as mean, {r(f'stddev_samp({c})')} as stddev,
        {r(f'min({c})')} as min, {r(f'max({c})')} as max from model_v""" for c in NUMBERS), "model_v")
def describe_model(spark, d):
    return rounded(S.describe(model_data(spark, d), NUMBERS))


@query("numeric_complete", """
with g as (select business_id, avg_growth_rate, avg_star_change, years_with_data from growth_v)
select a.business_id, stars, review_count, is_open, success, {g} as avg_growth_rate, years_with_data
from analysis_v a join g using (business_id)
where avg_growth_rate is not null and years_with_data is not null""".format(g=r("avg_growth_rate")),
       "analysis_v", "growth_v")
def numeric_complete(spark, d):
    joined = analysis(spark, d).select("business_id", "name", "stars", "review_count", "is_open", "success").join(
        growth_metrics(spark, d).select("business_id", "avg_growth_rate", "years_with_data"), "business_id", "left"
    )
    with_empty = joined.withColumn("never_filled", F.lit(None).cast("double"))
    return rounded(D.numeric_complete(with_empty, keep_key=True))


_U = "cast('0x' || substr(md5('{seed}:' || {key}), 1, 8) as bigint) / 4294967296.0"


@query("flip_labels", f"""
select business_id, case when {_U.format(seed=123, key='business_id')} < 0.1 then 1 - success else success end as success
from analysis_v""", "analysis_v")
def flip_labels(spark, d):
    return D.flip_labels(analysis(spark, d)).select("business_id", "success")


@query("flip_exact", """
select business_id,
       case when row_number() over (order by md5('123:' || business_id)) <= floor(count(*) over () * 0.1)
            then 1 - success else success end as success
from analysis_v""", "analysis_v")
def flip_exact(spark, d):
    return D.flip_labels_exactly(analysis(spark, d)).select("business_id", "success")


def _noise(column):
    radius = f"sqrt(-2.0 * ln(1.0 - {_U.format(seed=f'42/{column}/r', key='business_id')}))"
    angle = f"cos(2.0 * pi() * {_U.format(seed=f'42/{column}/a', key='business_id')})"
    return r(f"{column} + {radius} * {angle} * 0.1 * (max({column}) over () - min({column}) over ())")


@query("feature_noise", f"""
select business_id, {_noise('review_count')} as review_count, {_noise('price_level')} as price_level, success
from analysis_v""", "analysis_v")
def feature_noise(spark, d):
    noisy = D.add_noise(analysis(spark, d), ["review_count", "price_level"])
    return rounded(noisy.select("business_id", "review_count", "price_level", "success"))


# ---- evaluation on given pairs ----------------------------------------------------------------------------------

@query("regression_metrics", f"""
with p as (select l_extendedprice as y, l_quantity * 1500.0 as p from lineitem)
select count(*) as n, {r('sqrt(sum((y - p) * (y - p)) / count(*))')} as rmse,
       {r('1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} as r2 from p""")
def regression_metrics(spark, d):
    pairs = V.table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500.0).alias("prediction")
    )
    return rounded(E.regression_metrics(pairs, "y"))


def _auc_sql(label, score, view):
    return f"""
with f as (select {score} as s, count(*) filter ({label}) as pos, count(*) filter (not {label}) as neg from {view} group by 1),
c as (select pos, neg, sum(neg) over (order by s) - neg as below from f)
select cast(sum(pos) as bigint) as positives, cast(sum(neg) as bigint) as negatives,
       {r('sum(pos * (below + neg / 2.0)) / (sum(pos)::double * sum(neg))')} as auc from c"""


@query("auc", _auc_sql("o_orderstatus = 'F'", "o_totalprice", "orders"))
def auc(spark, d):
    scored = V.table(spark, d, "orders").select(
        (F.col("o_orderstatus") == "F").cast("double").alias("label"), F.col("o_totalprice").alias("score")
    )
    return rounded(E.auc(scored, "label"))


@query("auc_ties", _auc_sql("success = 1", "review_count", "analysis_v"), "analysis_v")
def auc_ties(spark, d):
    return rounded(E.auc(analysis(spark, d), "success", "review_count"))


_PAIRS = """p as (select success as y, cast(avg_review_stars >= 3.0 as int) as p, business_id from analysis_v),
c as (select count(*) filter (y = 1 and p = 1) as tp, count(*) filter (y = 0 and p = 0) as tn,
             count(*) filter (y = 0 and p = 1) as fp, count(*) filter (y = 1 and p = 0) as fn from p)"""


def pairs(spark, d):
    return analysis(spark, d).withColumn("prediction", (F.col("avg_review_stars") >= 3.0).cast("double"))


@query("confusion_matrix", f"""
with {_PAIRS}
select a as actual, b as predicted, n, {r('100.0 * n / nullif(sum(n) over (partition by a), 0)')} as row_pct
from (select 0 as a, 0 as b, tn as n from c union all select 0, 1, fp from c
      union all select 1, 0, fn from c union all select 1, 1, tp from c)""", "analysis_v")
def confusion_matrix(spark, d):
    return rounded(E.confusion_matrix(pairs(spark, d)))


@query("classification_metrics", f"""
with {_PAIRS}
select {r('(tp + tn) / (tp + tn + fp + fn)')} as accuracy, {r('tp / (tp + fp)')} as precision, {r('tp / (tp + fn)')} as recall,
       {r('2.0 * tp / (2 * tp + fp + fn)')} as f1 from c""", "analysis_v")
def classification_metrics(spark, d):
    return rounded(E.classification_metrics(pairs(spark, d)))


@query("class_report", f"""
with {_PAIRS},
r as (select '0' as class, tn / (tn + fn) as precision, tn / (tn + fp) as recall, 2.0 * tn / (2 * tn + fn + fp) as f1, tn + fp as support from c
      union all select '1', tp / (tp + fp), tp / (tp + fn), 2.0 * tp / (2 * tp + fp + fn), tp + fn from c),
a as (select * from r
      union all select 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) as bigint) from r
      union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), cast(sum(support) as bigint) from r)
select class, {r('precision')} as precision, {r('recall')} as recall, {r('f1')} as f1, support from a""", "analysis_v")
def class_report(spark, d):
    return rounded(E.class_report(pairs(spark, d)))


@query("label_counts", f"""
with {_PAIRS}
select 'success' as "column", cast(y as double) as value, count(*) as n from p group by y
union all select 'prediction', cast(p as double), count(*) from p group by p""", "analysis_v")
def label_counts(spark, d):
    return E.value_counts_of(pairs(spark, d), "success", "prediction")


# ---- fitted models ----------------------------------------------------------------------------------------------

@query("assembled_rows", "select business_id, 8 as n_features from analysis_v", "analysis_v")
def assembled_rows(spark, d):
    vectors = M.assemble(analysis(spark, d), M.ANALYSIS_FEATURES)
    return vectors.select("business_id", F.size(vector_to_array("features")).alias("n_features"))


@query("linreg_one", f"""
with t as (select * from (select o_orderkey, l_extendedprice as y, l_quantity as x from lineitem join orders on l_orderkey = o_orderkey)
           where {_U.format(seed=42, key='o_orderkey')} < 0.8)
select {r('regr_slope(y, x)', 4)} as slope, {r('regr_intercept(y, x)', 4)} as intercept, {r('regr_r2(y, x)')} as r2 from t""")
def linreg_one(spark, d):
    lines = V.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("business_id"), F.col("l_extendedprice").alias("stars"), "l_quantity"
    )
    fit = M.linear_stars(lines, features=["l_quantity"])
    last = fit.model.stages[-1]
    # three numbers of the fitted model, repeated on one derived row
    return lines.agg(
        F.lit(round(float(last.coefficients[0]), 4)).alias("slope"),
        F.lit(round(float(last.intercept), 4)).alias("intercept"),
        F.lit(round(float(last.summary.r2), 6)).alias("r2"),
    )


_TEST = f"{_U.format(seed=42, key='business_id')} >= {{}}"


def _by_label(scored, label, in_train):
    """Rows by label on the training and the test side, and the test rows with a prediction, a label that there is."""
    return scored.groupBy(F.col(label).cast("double").alias("label")).agg(
        F.count_if(in_train).alias("n_train"), F.count_if(~in_train).alias("n_test"),
        F.count_if(~in_train & F.col("prediction").isNotNull()).alias("n_predicted"),
    )


def _by_label_sql(view, label, share):
    test = f"count(*) filter ({_TEST.format(share)})"
    return f"""
select cast({label} as double) as label, count(*) - {test} as n_train, {test} as n_test, {test} as n_predicted
from {view} group by {label}"""


def _fitted_by_label(fit, data, label):
    """A fit keeps the predictions of the test side only."""
    train = split(data, "business_id", M.TRAIN_SHARE, M.SEED)[0].select(label, F.lit(None).cast("double").alias("prediction"))
    both = train.withColumn("is_train", F.lit(True)).union(fit.predictions.select(label, "prediction", F.lit(False)))
    return _by_label(both, label, F.col("is_train"))


_SPLIT = f"""count(*) filter ({_U.format(seed=42, key='business_id')} < 0.8) as n_train,
       count(*) filter ({_U.format(seed=42, key='business_id')} >= 0.8) as n_test"""


@query("linreg_stars", f"""
select {_SPLIT}, 0.0::double as residual_sum, 0.0::double as worst_residual_feature from analysis_v""", "analysis_v")
def linreg_stars(spark, d):
    # least squares leaves residuals that sum to 0, alone and times each feature
    data = materialize(analysis(spark, d), "analysis")
    fit = M.linear_stars(data)
    scored = fit.model.transform(split(data, "business_id", M.TRAIN_SHARE, M.SEED)[0])
    rest = F.col("stars") - F.col("prediction")
    shares = [
        F.abs(F.try_divide(F.sum(rest * F.col(f)), F.sum(F.abs(rest * F.col(f))))) for f in fit.features
    ]
    trained = scored.agg(
        F.count(F.lit(1)).alias("n_train"), F.abs(F.round(F.avg(rest), 6)).alias("residual_sum"),
        F.round(F.greatest(*[F.coalesce(x, F.lit(0.0)) for x in shares]), 6).alias("worst_residual_feature"),
    )
    return attach(trained, fit.predictions.agg(F.count(F.lit(1)).alias("n_test")), ())


@query("rf_success", _by_label_sql("analysis_v", "success", 0.8), "analysis_v")
def rf_success(spark, d):
    data = materialize(analysis(spark, d), "analysis")
    return _fitted_by_label(M.forest_success(data), data, "success")


@query("rf_success_wide", _by_label_sql("model_v", "success", 0.8), "model_v")
def rf_success_wide(spark, d):
    data = stored_model_data(spark, d)
    return _fitted_by_label(M.forest_success_wide(data), data, "success")


@query("rf_stars", _by_label_sql("model_v", "stars", 0.8), "model_v")
def rf_stars(spark, d):
    data = stored_model_data(spark, d)
    return _fitted_by_label(M.forest_stars(data), data, "stars")


OPEN_FEATURES = ["stars", "review_count", "has_wifi", "state_idx", "avg_growth_rate", "avg_star_change", "years_with_data"]


@query("logit_open", " union all ".join(
    f"""select '{f}' as feature, {_SPLIT}, 0.0::double as gradient from model_v""" for f in OPEN_FEATURES), "model_v")
def logit_open(spark, d):
    # at the optimum each feature's gradient, in units of its spread and with the penalty, is 0
    data = stored_model_data(spark, d)
    fit = M.logistic_open(data)
    last = fit.model.stages[-1]
    train, _ = split(data, "business_id", M.TRAIN_SHARE, M.SEED)
    scored = M.with_score(fit.model.transform(train))
    spread = scored.agg(*[F.stddev(f).alias(f"sd_{f}") for f in fit.features])
    miss = F.col("score") - F.col("is_open")
    slopes = attach(scored, spread, ()).agg(
        F.count(F.lit(1)).alias("n_train"),
        *[F.avg(miss * F.coalesce(F.try_divide(f, f"sd_{f}"), F.lit(0.0))).alias(f) for f in fit.features],
        *[F.max(f"sd_{f}").alias(f"sd_{f}") for f in fit.features],
    )
    penalty = last.getRegParam()
    each = F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.col(f) + penalty * float(w) * F.col(f"sd_{f}")).alias("gradient"))
        for f, w in zip(fit.features, last.coefficients, strict=True)
    ])
    tested = fit.predictions.agg(F.count(F.lit(1)).alias("n_test"))
    return attach(slopes, tested, ()).select("n_train", "n_test", F.inline(each)).select(
        "feature", "n_train", "n_test", F.abs(F.round("gradient", 3)).alias("gradient")
    )


@query("rf_holdout", _by_label_sql("model_v", "success", 0.7), "model_v")
def rf_holdout(spark, d):
    fit = M.holdout_forest(stored_model_data(spark, d))
    return _by_label(fit.predictions, "success", F.col("is_train"))


@query("feature_rank")
def feature_rank(spark, d):
    """Rank and importance of each feature of the dashboard's forest, from its table of nodes."""
    fit = M.holdout_forest(stored_model_data(spark, d))
    return O.with_ranks(O.importances(O.forest_nodes(fit.model, fit.features)), fit.features)


@query("forest_routing", f"""
select cast(success as double) as label, count(*) as n_test, count(*) as n_equal
from model_v where {_TEST.format(0.7)} group by success""", "model_v")
def forest_routing(spark, d):
    # rows that the table of nodes predicts as the model does
    fit = M.holdout_forest(stored_model_data(spark, d))
    nodes = O.forest_nodes(fit.model, fit.features)
    tested = fit.predictions.where("not is_train")
    routed = O.route(tested, nodes, fit.features, classes=2, column="routed")
    return routed.groupBy(F.col("success").alias("label")).agg(
        F.count(F.lit(1)).alias("n_test"), F.count_if(F.col("routed") == F.col("prediction")).alias("n_equal")
    )


def _fits(spark, d):
    """The six models by name."""
    first, wide = materialize(analysis(spark, d), "analysis"), stored_model_data(spark, d)
    return {
        "linear_stars": M.linear_stars(first), "forest_success": M.forest_success(first),
        "forest_success_wide": M.forest_success_wide(wide), "forest_stars": M.forest_stars(wide),
        "logistic_open": M.logistic_open(wide), "holdout_forest": M.holdout_forest(wide),
    }


@query("model_metrics")
def model_metrics(spark, d):
    """Every metric of every model, a row each."""
    made = None
    for name, fit in _fits(spark, d).items():
        each = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in fit.metrics.columns])
        part = fit.metrics.select(F.lit(name).alias("model"), F.inline(each))
        made = part if made is None else made.unionByName(part)
    return rounded(made)


@query("model_rankings")
def model_rankings(spark, d):
    """Rank and weight of the features of every model."""
    made = None
    for name, fit in _fits(spark, d).items():
        part = O.with_ranks(fit.ranking, fit.features).select(F.lit(name).alias("model"), "rank", "feature", "importance")
        made = part if made is None else made.unionByName(part)
    return rounded(made)


@query("holdout_predictions", f"""
select business_id, {_U.format(seed=42, key='business_id')} < 0.7 as is_train,
       {_U.format(seed=42, key='business_id')} >= 0.7 as has_prediction, success from model_v""", "model_v")
def holdout_predictions(spark, d):
    scored = M.holdout_forest(stored_model_data(spark, d)).predictions
    return scored.select("business_id", "is_train", F.col("prediction").isNotNull().alias("has_prediction"), "success")


@query("model_rows", f"""
select 'importance' as kind, 7 as n, 0 as with_prediction
union all
select 'row', count(*), count(*) filter ({_U.format(seed=42, key='business_id')} >= 0.7) from model_v""", "model_v")
def model_rows(spark, d):
    fit = M.holdout_forest(stored_model_data(spark, d))
    rows = M.model_rows(fit.ranking, fit.predictions)
    return rows.groupBy(F.when(F.col("feature").isNotNull(), "importance").otherwise("row").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("with_prediction")
    )


@query("model_roundtrip", f"""
select count(*) as n, count(*) as n_equal from model_v where {_U.format(seed=42, key='business_id')} >= 0.8""", "model_v")
def model_roundtrip(spark, d):
    data = stored_model_data(spark, d)
    fit = M.logistic_open(data)
    path = save_model(fit.model, new_path(spark, "logistic-open"))
    again = M.with_score(PipelineModel.load(path).transform(fit.predictions.select(data.columns)))
    both = fit.predictions.select("business_id", F.col("score").alias("first")).join(
        again.select("business_id", F.col("score").alias("second")), "business_id"
    )
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("first") == F.col("second")).alias("n_equal"))

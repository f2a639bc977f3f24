"""Survival, churn and segmentation runs."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import attribution as at
from ..operators import cox, ensembles as en, survival as sv
from ..operators import evaluation as ev
from ..operators import features as ft
from ..operators import models as md
from ..operators import segments as sg
from ..operators import kmeans as km
from ..session import materialize
from ..sources import mapping
from ..sources.schemas import CHANNELS

HOURS = {"unit": "hours", "limit": 24.0}
POINTS_H = [1, 2, 4, 8, 16, 24]
POINTS_D = [7, 14, 30, 60, 90]


def _journeys(operator):
    return lambda spark, sf: operator(mapping.journeys(spark, sf))


def _durations(t):
    return sv.durations(t.users, t.events, **HOURS)


def _lifecycle_durations(spark, sf):
    return sv.durations(*mapping.lifecycles(spark, sf))


def _rounded(df, places=6):
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _rounded_means(df, places=4):
    """Rounded as decimals, half away from zero: a mean of amounts often lies on a half, and the order of its sum must not decide."""
    return df.select(*[F.round(F.col(c).cast("decimal(28,10)"), places).cast("double").alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _curve(spark, sf):
    return sv.kaplan_meier(_lifecycle_durations(spark, sf), ["channel"])


def _cox_data(t):
    """Survival rows with model-ready covariates and their names."""
    rows = materialize(sv.survival_dataset(t, **HOURS))
    capped = rows.withColumn("kyc_turnaround_h", F.least("kyc_turnaround_h", F.lit(200.0)))
    ready, names = ft.dummies(capped.drop("region"), ["channel", "age_band", "device_os"])
    return ready, ["kyc_had_failure", "kyc_turnaround_h", *names]


def _cox(t):
    data, names = _cox_data(t)
    return data, cox.fit(data, names)


COX_AT = {"kyc_had_failure": 0.4, "kyc_turnaround_h": -0.7, "referred": 0.2}


def cox_derivatives(t):
    """Slope and information of the partial likelihood at fixed coefficients."""
    rows = materialize(sv.survival_dataset(t, **HOURS).withColumns({
        "kyc_turnaround_h": F.least("kyc_turnaround_h", F.lit(200.0)), "referred": F.when(F.col("channel") == "referral", 1).otherwise(0)}))
    data = cox.lay_out(rows, list(COX_AT))
    _, gradient, information = cox.derivatives(data, list(COX_AT.values()))
    data.close()
    return _rounded(cox.derivative_rows(rows.sparkSession, data.names, gradient, information), 4)


def cox_optimum(t):
    """Rows of the fit, covariates, and coordinates in which the penalised likelihood still has a slope at its result."""
    rows, names = _cox_data(t)
    model = cox.fit(rows, names)
    data = cox.lay_out(rows, names)
    standard = model.coefficients * data.scale
    _, gradient, information = cox.derivatives(data, standard)
    data.close()
    inverse = np.linalg.inv(information + 0.1 * data.n * np.eye(len(names))) / np.outer(data.scale, data.scale)
    off = int((np.abs(gradient - 0.1 * data.n * standard) > 1e-3).sum())
    wrong = int((np.abs(inverse - model.covariance) > 1e-6 * np.abs(model.covariance).max()).sum())
    return rows.sparkSession.createDataFrame([(data.n, off, wrong)], "n long, slopes_off long, covariances_off long")


def cox_table(t):
    data, model = _cox(t)
    return cox.hazard_ratios(data.sparkSession, model)


def cox_concordance(t):
    data, model = _cox(t)
    return cox.concordance(data, model.score())


def order_scores(spark, sf):
    """A score and a 0/1 label per order: price over its upper end, and whether the order is finished."""
    return mapping.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("user_id"), (F.col("o_totalprice") / 500_000).alias("score"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"))


def tied_scores(spark, sf):
    """As above from events: a hundred distinct scores with many ties."""
    return mapping.read(spark, sf, "events").select(
        F.col("event_id").alias("user_id"), (F.get_json_object("props", "$.k").cast("int") / 100.0).alias("score"),
        (F.col("event_type") == "purchase").cast("int").alias("label"))


def high_risk(spark, sf):
    """Top-tier orders, and those that outreach could prevent at the average precision of the score."""
    scores = order_scores(spark, sf)
    precision = ev.ranking_quality(ev.curve_points(scores)).select(F.round("average_precision", 6)).scalar()
    return ev.high_risk_summary(ev.risk_tiers(scores), precision)


def concordance_check(spark, sf):
    """Concordance of the order value with the time to the first transaction stage."""
    users, events = mapping.lifecycles(spark, sf)
    value = mapping.read(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("user_id"),
                                                     F.floor(F.col("o_totalprice") / 1000).alias("value"))
    return _rounded(cox.concordance(sv.durations(users, events).join(value, "user_id"), F.col("value").cast("double")))


def _prepared(t):
    ready, names = ft.prepared(t)
    return materialize(ft.stratified_split(ready, "churned")), names


def _scored(t, spec=md.SECOND_GENERATION["random_forest"]):
    df, names = _prepared(t)
    model = md.train(spec, df.where("is_test = 0"), names, "churned")
    return df, names, model


def model_quality(spec):
    def run(t):
        df, _, model = _scored(t, spec)
        return md.evaluate(md.score(model, df.where("is_test = 1"), [F.col("churned").alias("label")]))

    return _journeys(run)


def model_cross_validation(t):
    df, names = _prepared(t)
    spec = md.SECOND_GENERATION["logistic_regression"]
    rows = [(metric, *map(float, md.cross_validate(spec, df, names, "churned", metric=metric))) for metric in ("roc_auc", "f1")]
    return df.sparkSession.createDataFrame(rows, "metric string, mean double, deviation double")


def model_comparison(t):
    """All three kinds with the library's own settings."""
    df, names = _prepared(t)
    return md.compare(md.SECOND_GENERATION, df, names, "churned", folds=5)


def model_importance(t):
    df, names, model = _scored(t)
    return md.feature_importance(model, names, df.sparkSession)


# A scorecard of the time before and at the first transaction: splits by hand, values by measurement.
CARD_FEATURES = ["kyc_turnaround_h", "first_txn_amount", "n_pre_tickets", "h_reg_to_verify"]
CARD = [(0, 0, 1, 2, 0, 20.0), (0, 1, 3, 4, 1, 35.0), (0, 2, 5, 6, 3, 5.0), (0, 3, -1, -1, None, None), (0, 4, -1, -1, None, None),
        (0, 5, -1, -1, None, None), (0, 6, 7, 8, 0, 50.0), (0, 7, -1, -1, None, None), (0, 8, -1, -1, None, None),
        (1, 0, 1, 2, 3, 0.0), (1, 1, -1, -1, None, None), (1, 2, 3, 4, 1, 60.0), (1, 3, -1, -1, None, None), (1, 4, 5, 6, 0, 0.0),
        (1, 5, -1, -1, None, None), (1, 6, -1, -1, None, None),
        (2, 0, 1, 2, 1, 15.0), (2, 1, -1, -1, None, None), (2, 2, 3, 4, 2, 0.5), (2, 3, 5, 6, 1, 70.0), (2, 4, -1, -1, None, None),
        (2, 5, -1, -1, None, None), (2, 6, -1, -1, None, None)]


def _card(t):
    """Feature rows with their split, and the scorecard as measured on the training rows."""
    rows = materialize(ft.stratified_split(materialize(ft.activation_features(t)), "churned"))
    splits = rows.sparkSession.createDataFrame(CARD, "tree int, node int, left int, right int, feature int, threshold double")
    nodes = splits.withColumns({"cover": F.lit(0.0), "value": F.lit(0.0), "gain": F.lit(0.0), "weight": F.lit(1.0)})
    return rows, materialize(en.measured(nodes, rows.where("is_test = 0"), CARD_FEATURES, "churned"))


def ensemble_statistics(t):
    return _rounded(_card(t)[1].select("tree", "node", "cover", "value", "gain"))


def ensemble_scores(t):
    rows, nodes = _card(t)
    return _rounded(ev.risk_tiers(en.score(nodes, rows.where("is_test = 1"), CARD_FEATURES, ["user_id"])))


def ensemble_importance(t):
    return _rounded(en.importance(_card(t)[1], CARD_FEATURES))


def ensemble_attribution(t):
    rows, nodes = _card(t)
    found, base = at.explained(nodes, rows.where("is_test = 1"), CARD_FEATURES)
    return _rounded(found.select("user_id", F.lit(base).alias("base"), *[F.col("phi")[i].alias(f) for i, f in enumerate(CARD_FEATURES)]))


def forest_walk(t):
    """Test rows, those whose walked score is the fitted forest's probability, and features whose importance from stored gains differs."""
    df, names, model = _scored(t)
    nodes = materialize(en.node_table(model, df.sparkSession))
    fitted = md.score(model, df.where("is_test = 1"), names).withColumnRenamed("score", "fitted")
    walked = en.score(nodes, fitted, names, ["fitted"])
    stored = md.feature_importance(model, names, df.sparkSession).withColumnRenamed("importance", "fitted")
    off = en.importance(nodes, names).join(stored, "feature").where(F.abs(F.col("importance") - F.col("fitted")) > 1e-9)
    return walked.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("score") - F.col("fitted")) < 1e-9).alias("walked")).select(
        "n", "walked", off.agg(F.count(F.lit(1))).scalar().alias("importances_off"))


def model_risk_scores(t):
    df, _, model = _scored(t)
    return ev.risk_tiers(md.score(model, df, ["user_id"])).orderBy(F.col("score").desc(), "user_id")


def model_attribution(t):
    df, names, model = _scored(t)
    explained, _ = at.attributions(model, df.where("is_test = 1"), names)
    return at.mean_absolute(explained, names)


def model_attribution_sample(t):
    df, names, model = _scored(t)
    explained, _ = at.attributions(model, df.where("is_test = 1"), names, ["user_id", *names])
    explained = materialize(explained)
    top = [r["feature"] for r in at.mean_absolute(explained, names).limit(10).collect()]
    return at.sample_points(explained, names, top)


def attribution_additive(t):
    """Test rows, and those whose base and contributions add up to the forest's probability."""
    df, names, model = _scored(t)
    scored = md.score(model, df.where("is_test = 1"), ["user_id", *names])
    explained, base = at.attributions(model, scored, names, ["user_id", "score"])
    whole = F.aggregate("phi", F.lit(float(base)), lambda a, x: a + x)
    return explained.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(whole - F.col("score")) < 1e-6).alias("additive"))


def logistic_optimum(t):
    """Training rows of the logistic fit, and the coordinates in which the penalised likelihood still has a slope."""
    df, names = _prepared(t)
    train = df.where("is_test = 0")
    model = md.train(md.SECOND_GENERATION["logistic_regression"], train, names, "churned")
    fit = model.stages[-1]
    rows = model.transform(md.weighted(train, "churned")).select(
        md.WEIGHT, (vector_to_array("probability")[1] - F.col(md.LABEL)).alias("miss"),
        F.concat(F.array(F.lit(1.0)), vector_to_array("features")).alias("x"))
    penalty = F.array(*[F.lit(float(b) * fit.getRegParam()) for b in [0.0, *fit.coefficients.toArray()]])
    slopes = rows.select(md.WEIGHT, "miss", F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        (F.sum(F.col(md.WEIGHT) * F.col("miss") * F.col("v")) / F.sum(md.WEIGHT)).alias("g"), F.count(F.lit(1)).alias("n"))
    return slopes.agg(F.max("n").alias("n"), F.count_if(F.abs(F.col("g") + F.get(penalty, F.col("i"))) > 1e-4).alias("off"))


def split_report(t):
    split = ft.stratified_split(materialize(ft.activation_features(t)), "churned")
    return split.groupBy("churned", "is_test", "fold").agg(F.count(F.lit(1)).alias("n"), F.min("user_id").alias("first_user"))


def capped_features(t):
    raw = materialize(ft.activation_features(t))
    timing = [c for c in raw.columns if c.startswith("h_")]
    capped = ft.derived_flags(ft.cap_and_fill(raw, timing))
    return _rounded(capped.select("user_id", *timing, "kyc_speed_flag", "fast_onboarding"), 4)


def encoded_features(t):
    coded, added = ft.dummies(t.users)
    return coded.select("user_id", *added)


def standardised_features(t):
    columns = ["n_transactions", "avg_amount", "n_tickets"]
    return _rounded(ft.standardise(materialize(ft.lifetime_features(t).select("user_id", *columns)), columns), 5)


def _segments(t):
    """Users with a cluster, as many as the silhouette chooses, and named profiles."""
    points = materialize(sg.clustering_input(materialize(sg.rfm(t))))
    best = sg.choose_k(points).where("chosen").first()["k"]
    clustered = materialize(sg.cluster(points, best))
    return clustered, sg.name_segments(sg.profile(clustered))


def banded(t):
    """Users in fixed bands of transaction count and recency: labels that need no model and meet every naming rule."""
    users = sg.rfm(t)
    band = F.least("frequency", F.lit(3)) * 2 + F.when(F.col("recency_days") >= 15, 1).otherwise(0)
    return users.withColumn("cluster", band.cast("int"))


def banded_profiles(t):
    return sg.name_segments(sg.profile(banded(t)))


def lloyd_steps(t):
    """Two K-means steps from the means of the bands: users and centre of every cluster after each."""
    columns = ["recency_days", "frequency", "n_tickets"]
    users = materialize(banded(t).select("cluster", F.array(*[F.col(c).cast("double") for c in columns]).alias("x")))
    means = users.groupBy("cluster").agg(*[F.avg(F.col("x")[j]).alias(c) for j, c in enumerate(columns)]).orderBy("cluster").collect()  # one row per band
    centres, rows = np.array([[r[c] for c in columns] for r in means], float).reshape(-1, len(columns)), []
    for turn in (1, 2) if len(centres) else ():
        [(centres, n, _cost)] = km.step(users, [centres])
        rows += [(turn, j, int(n[j]), *map(float, centre)) for j, centre in enumerate(centres)]
    out = users.sparkSession.createDataFrame(rows, "step int, centre int, n long, " + ", ".join(f"{c} double" for c in columns))
    return _rounded(out, 4)


def band_silhouettes(t):
    """Users and mean Euclidean silhouette of every band, over capped counts of transactions and tickets, so scores are exact."""
    x = F.array(F.least("frequency", F.lit(12)).cast("double"), F.least("n_tickets", F.lit(6)).cast("double"))
    scored = km.silhouette(materialize(banded(t).select("cluster", x.alias("x"))))
    return _rounded(scored.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette")), 5)


def segment_export(t):
    clustered, named = _segments(t)
    return sg.export(clustered.join(named.select("cluster", F.col("segment_name").alias("segment")), "cluster"))


def segment_components(t):
    points = materialize(sg.clustering_input(materialize(sg.rfm(t))))
    parts, share = sg.principal_components(points)
    return parts.withColumn("explained", F.lit(float(sum(share))))


def component_sizes(t):
    """Components without their sign, which no rule fixes, and the share of the variance of each."""
    parts, share = sg.principal_components(materialize(sg.clustering_input(materialize(sg.rfm(t)))))
    sizes = parts.select("user_id", F.round(F.abs("pc1"), 4).alias("pc1"), F.round(F.abs("pc2"), 4).alias("pc2"))
    return sizes.withColumns({f"share{i}": F.round(F.lit(float(v)), 6) for i, v in enumerate(share, 1)})


QUERIES = {
    # survival
    "survival_durations": _journeys(lambda t: _rounded(_durations(t).select("user_id", "channel", "duration", "event"))),
    "survival_dataset_kyc": _journeys(lambda t: _rounded(sv.survival_dataset(t, **HOURS).select(
        "user_id", "duration", "event", "kyc_turnaround_h", "kyc_had_failure"))),
    "survival_summary": lambda s, sf: sv.dataset_summary(materialize(_lifecycle_durations(s, sf))),
    "survival_curve_by_channel": lambda s, sf: _rounded(_curve(s, sf).select("channel", "t", "d", "n", "s")),
    "survival_curve_band": lambda s, sf: _rounded(_curve(s, sf).select("channel", "t", "s_low", "s_high")),
    "survival_curve_journeys": _journeys(lambda t: _rounded(sv.kaplan_meier(_durations(t), ["age_band"]).select("age_band", "t", "d", "n", "s"))),
    "survival_median": lambda s, sf: _rounded(sv.median_survival(_curve(s, sf), ["channel"])),
    "survival_at_times": lambda s, sf: _rounded(sv.survival_at(_curve(s, sf), POINTS_D, ["channel"])),
    "survival_fastest_slowest": lambda s, sf: sv.fastest_and_slowest(_curve(s, sf), 30, "channel"),
    "survival_log_rank": lambda s, sf: _rounded(sv.log_rank(_lifecycle_durations(s, sf), "channel")),
    "survival_log_rank_age": _journeys(lambda t: _rounded(sv.log_rank(_durations(t), "age_band"))),
    "survival_log_rank_pair": lambda s, sf: _rounded(sv.pairwise_log_rank(_lifecycle_durations(s, sf), "channel", "organic", "referral")).drop("p_value"),
    "survival_hazard_ratios": _journeys(cox_table),
    "survival_cox_derivatives": _journeys(cox_derivatives),
    "survival_cox_optimum": _journeys(cox_optimum),
    "survival_model_concordance": _journeys(cox_concordance),
    "survival_concordance": concordance_check,
    # features
    "features_lifetime": _journeys(lambda t: _rounded(ft.lifetime_features(t), 4)),
    "features_at_activation": _journeys(lambda t: _rounded(ft.activation_features(t), 4)),
    "features_first_transactions": lambda s, sf: ft.first_transactions(mapping.commerce(s, sf).transactions).select("user_id", "txn_id", "amount"),
    "features_first_transaction_once": lambda s, sf: ft.first_transactions(mapping.commerce(s, sf).transactions, "first").select("user_id", "txn_id", "amount"),
    "features_tickets_before": _journeys(lambda t: ft.tickets_before(
        t.tickets, ft.stage_times(t.events, ["first_transaction"]).where("t_first_transaction IS NOT NULL"), "t_first_transaction")),
    "features_capped": _journeys(capped_features),
    "features_encoded": _journeys(encoded_features),
    "features_standardised": _journeys(standardised_features),
    "features_split": _journeys(split_report),
    "features_class_weights": _journeys(lambda t: _rounded(ft.class_weights(ft.activation_features(t), "churned"))),
    # evaluation of scores
    "evaluation_ranking": lambda s, sf: _rounded(ev.ranking_quality(ev.curve_points(order_scores(s, sf)))),
    "evaluation_ranking_ties": lambda s, sf: _rounded(ev.ranking_quality(ev.curve_points(tied_scores(s, sf)))),
    "evaluation_curve_points": lambda s, sf: _rounded(ev.curve_points(tied_scores(s, sf)).select("score", "fpr", "tpr", "precision", "recall")),
    "evaluation_confusion": lambda s, sf: ev.confusion(order_scores(s, sf)),
    "evaluation_class_report": lambda s, sf: _rounded(ev.class_report(ev.confusion(order_scores(s, sf)))),
    "evaluation_brier": lambda s, sf: _rounded(ev.brier(order_scores(s, sf))),
    "evaluation_threshold_sweep": lambda s, sf: _rounded(ev.threshold_sweep(order_scores(s, sf))),
    "evaluation_best_threshold": lambda s, sf: _rounded(ev.best_threshold(ev.threshold_sweep(order_scores(s, sf)))),
    "evaluation_calibration": lambda s, sf: _rounded(ev.calibration(order_scores(s, sf))),
    "evaluation_risk_tiers": lambda s, sf: ev.tier_counts(ev.risk_tiers(tied_scores(s, sf))),
    "evaluation_high_risk": high_risk,
    "evaluation_top_risk": lambda s, sf: _rounded(ev.top_risk(ev.risk_tiers(order_scores(s, sf)))),
    # models
    "model_logistic_regression": model_quality(md.FIRST_GENERATION["logistic_regression"]),
    "model_random_forest": model_quality(md.SECOND_GENERATION["random_forest"]),
    "model_cross_validation": _journeys(model_cross_validation),
    "model_comparison": _journeys(model_comparison),
    "model_feature_importance": _journeys(model_importance),
    "model_risk_scores": _journeys(model_risk_scores),
    "model_attribution": _journeys(model_attribution),
    "model_attribution_sample": _journeys(model_attribution_sample),
    "model_attribution_additive": _journeys(attribution_additive),
    "model_logistic_optimum": _journeys(logistic_optimum),
    "model_forest_walk": _journeys(forest_walk),
    "ensemble_node_statistics": _journeys(ensemble_statistics),
    "ensemble_scores": _journeys(ensemble_scores),
    "ensemble_importance": _journeys(ensemble_importance),
    "ensemble_attribution": _journeys(ensemble_attribution),
    # segmentation
    "segment_rfm": lambda s, sf: _rounded(sg.rfm(mapping.commerce(s, sf)), 4),
    "segment_profiles": _journeys(lambda t: _rounded_means(banded_profiles(t))),
    "segment_profile_grid": _journeys(lambda t: _rounded(sg.scale_between(banded_profiles(t), sg.RFM, ["segment_name"]), 4)),
    "segment_channel_mix": _journeys(lambda t: _rounded(sg.mix_by_segment(banded(t), CHANNELS, "cluster"), 4)),
    "segment_metric_rows": _journeys(lambda t: _rounded_means(sg.metric_rows(banded_profiles(t)))),
    "segment_best_and_riskiest": _journeys(lambda t: sg.best_and_riskiest(banded_profiles(t))),
    "segment_stuck": _journeys(lambda t: sg.stuck_at(t.events)),
    "segment_lloyd_steps": _journeys(lloyd_steps),
    "segment_band_silhouettes": _journeys(band_silhouettes),
    "segment_choose_k": _journeys(lambda t: sg.choose_k(materialize(sg.clustering_input(materialize(sg.rfm(t)))))),
    "segment_kmeans_export": _journeys(segment_export),
    "segment_components": _journeys(segment_components),
    "segment_component_sizes": _journeys(component_sizes),
}

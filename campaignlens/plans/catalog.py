"""Registered queries: one callable ``(spark, directory) -> DataFrame`` per operator, with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from campaignlens.functions import decisions
from campaignlens.functions.hashing import keyed_hash
from campaignlens.operators import (
    boosting,
    bootstrap,
    calibration,
    checks,
    classifiers,
    curves,
    explain,
    exploration,
    gains,
    logistic,
    neighbours,
    oversampling,
    prep,
    profiles,
    reporting,
    sampling,
    scoring,
    selection,
    thresholds,
    trees,
)
from campaignlens.operators.naive_bayes import nb_parameters_long
from campaignlens.operators.ranking import ranked_by_hash
from campaignlens.plans import demo, training, tuning
from campaignlens.plans.oracle import (
    AP,
    AUC,
    RATIOS,
    _scorecard_sql,
    counts_sql,
    hash_sql,
    q,
    rounded,
    with_parts,
)
from campaignlens.operators.scorecard import INTERCEPT, score_curve, score_terms, scorecard
from campaignlens.settings import FEATURES, NUMERIC_FEATURES, TARGET, TRANSFORMED_FEATURES, linear_grid
from campaignlens.sources import files
from campaignlens.sources.store import checkpoint_root, durable
from campaignlens.sources.warehouse import raw_customers
from campaignlens.streaming import scoring as streaming_scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
DIGITS = 4  # the registered scores are rounded to four decimals
BOOT_THRESHOLD = 0.25
BATCH_THRESHOLD = 0.25


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = with_parts(sql)
        return function

    return register


def r6(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Round doubles for comparison: eleven digits drop what the order of additions changes, then six are compared."""
    return rows.withColumns({c: F.bround(F.bround(F.col(f"`{c}`").cast("double"), 11), 6) for c in columns})


# --- sources and features -------------------------------------------------------------------


@query("select * from raw")
def raw_table(spark, d):
    return raw_customers(spark, d)


@query("select * from features")
def features(spark, d):
    return demo.build_features(spark, d)


@query("select age_group, count(*) as customers, min(age) as youngest, max(age) as oldest from ("
       "select f.age_group, 2001 - r.Year_Birth as age from features f join raw r on r.ID = f.id) group by age_group")
def age_bins(spark, d):
    raw = raw_customers(spark, d).select(F.col("ID").alias("id"), (F.lit(2001) - F.col("Year_Birth")).alias("age"))
    return (
        demo.features(spark, d)
        .join(raw, "id")
        .groupBy("age_group")
        .agg(F.count(F.lit(1)).alias("customers"), F.min("age").alias("youngest"), F.max("age").alias("oldest"))
    )


# --- exploration ------------------------------------------------------------------------------


@query("select count(*) as rows, 9::bigint as columns from features")
def table_shape(spark, d):
    return exploration.table_shape(demo.features(spark, d).drop("id"))


@query(" union all ".join(
    f"select '{c}' as \"column\", count(*) filter ({c} is null) as missing from features" for c in (*FEATURES, TARGET)))
def missing_counts(spark, d):
    return exploration.missing_counts(demo.features(spark, d), (*FEATURES, TARGET))


@query(f"select (count(*) - (select count(*) from (select distinct {', '.join((*FEATURES, TARGET))} from features)))::bigint as duplicates from features")
def duplicate_rows(spark, d):
    return exploration.duplicate_rows(demo.features(spark, d), (*FEATURES, TARGET))


@query(" union all ".join(
    f"""select '{c}' as "column", count({c}) as count, round_even(round_even(avg({c}), 11), 6) as mean, round_even(round_even(stddev_samp({c}), 11), 6) as std,
 min({c})::double as min, round_even(round_even(quantile_cont({c}::double, 0.25), 11), 6) as q25, round_even(round_even(quantile_cont({c}::double, 0.5), 11), 6) as q50,
 round_even(round_even(quantile_cont({c}::double, 0.75), 11), 6) as q75, max({c})::double as max from features"""
    for c in (*NUMERIC_FEATURES, TARGET)))
def describe_numeric(spark, d):
    return r6(exploration.describe_numeric(demo.features(spark, d)), ["mean", "std", "q25", "q50", "q75"])


@query("select target, count(*) as rows, round_even(round_even(count(*) * 100.0::double / (select count(*) from features), 11), 6) as share_pct from features group by target")
def target_balance(spark, d):
    return r6(exploration.target_balance(demo.features(spark, d)), ["share_pct"])


@query("select count(*) as rows, round_even(round_even(avg(target), 11), 6) as prevalence from features")
def prevalence(spark, d):
    return r6(exploration.prevalence(demo.features(spark, d)), ["prevalence"])


@query("select age_group, count(*) as customers, sum(target)::bigint as responders, round_even(round_even(avg(target) * 100, 11), 6) as response_rate_pct, "
       "case age_group when '18-25' then 1 when '26-35' then 2 when '36-45' then 3 when '46-55' then 4 else 5 end::bigint as position "
       "from features group by age_group")
def response_rate_by_age(spark, d):
    rates = exploration.response_rate_by_age(demo.features(spark, d))
    return r6(rates, ["response_rate_pct"]).withColumn("position", F.col("position").cast("bigint"))


@query("select previous_campaign_response, count(*) as customers, sum(target)::bigint as responders, "
       "round_even(round_even(avg(target) * 100, 11), 6) as response_rate_pct from features group by previous_campaign_response")
def response_rate_by_prior(spark, d):
    return r6(exploration.response_rate_by(demo.features(spark, d), "previous_campaign_response"), ["response_rate_pct"])


def _box_sql() -> str:
    parts = []
    for c in exploration.BOX_COLUMNS:
        parts.append(f"""
select f.target, '{c}' as "column", s.q1, s.median, s.q3,
 min(f.{c}) filter (f.{c} >= s.q1 - 1.5 * (s.q3 - s.q1)) as whisker_low,
 max(f.{c}) filter (f.{c} <= s.q3 + 1.5 * (s.q3 - s.q1)) as whisker_high
from features f join (select target, quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as median,
 quantile_cont({c}, 0.75) as q3 from features group by target) s on s.target = f.target
group by f.target, s.q1, s.median, s.q3""")
    columns = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return f'select target, "column", {rounded(columns)} from (' + " union all ".join(parts) + ")"


@query(_box_sql())
def boxplot_stats(spark, d):
    return r6(exploration.boxplot_stats(demo.features(spark, d)), ["q1", "median", "q3", "whisker_low", "whisker_high"])


@query(" union all ".join(
    f"select '{a}' as a, '{b}' as b, " + ("max(1.0)::double" if a == b else f"round_even(round_even(corr({a}, {b}), 11), 6)") + " as r from features"
    for a in exploration.CORRELATION_COLUMNS for b in exploration.CORRELATION_COLUMNS))
def correlation_matrix(spark, d):
    return r6(exploration.correlation_matrix(demo.features(spark, d)), ["r"])


@query("select * from features order by id limit 5")
def first_rows(spark, d):
    return exploration.first_rows(demo.features(spark, d))


# --- checks -----------------------------------------------------------------------------------


@query("select count(*) as rows, count(*) filter (target is null or target not in (0, 1)) as invalid, "
       "count(*) filter (target is null or target not in (0, 1)) = 0 as ok from features")
def domain_checks(spark, d):
    return checks.target_domain_check(demo.features(spark, d))


@query("select count(*) as rows, count(*) = (select count(*) from customer) as ok from features")
def row_count_check(spark, d):
    expected = spark.read.parquet(f"{d}/customer.parquet").count()
    return checks.row_count_check(demo.features(spark, d), expected)


@query(" union all ".join(
    f"select '{c}' as \"column\", count(*) filter ({q(c)} is null or isnan({q(c)})) as missing, "
    f"count(*) filter ({q(c)} is null or isnan({q(c)})) = 0 as ok from held_x" for c in TRANSFORMED_FEATURES))
def completeness_check(spark, d):
    return checks.completeness_check(demo.held_out_features(spark, d), TRANSFORMED_FEATURES)


@query(" union all ".join(
    f"select '{c}' as feature, round_even(round_even(var_pop({q(c)}), 11), 6) as variance, "
    f"var_pop({q(c)}) > {0.01 if c == 'previous_campaign_response' else 1e-6} as ok from fit_x where fit = -1"
    for c in TRANSFORMED_FEATURES))
def variance_audit(spark, d):
    return r6(checks.variance_audit(demo.fit_features(spark, d).where("fit = -1")), ["variance"])


@query(" union all ".join(
    f"select '{c}' as \"column\", count(*) filter (not ({c} between {low} and {high})) as outside from features"
    for c, (low, high) in checks.INPUT_BOUNDS.items())
    + " union all select 'age_group', count(*) filter (age_group not in ('18-25', '26-35', '36-45', '46-55', '56+')) from features")
def input_bounds(spark, d):
    return checks.input_bounds(demo.features(spark, d))


_CAPTURE_RATE = (
    "(select model, (sum(y) filter (position <= greatest(1, floor(n * 0.2)))) / max(all_pos) as rate from ranked group by model)"
)


@query(f"""
select model, metric, {rounded(['reported', 'recomputed'])}, abs(reported - recomputed) < 1e-9 as ok from (
 select m.model, unnest(['f1', 'fpr', 'capture_rate']) as metric, unnest([m.f1, m.fpr, c.rate])::double as reported,
  unnest([r.f1, r.fpr, g.rate])::double as recomputed
 from test_metrics m join {_CAPTURE_RATE} c on c.model = m.model
 join (select model, 2.0 * sum(case when p >= 0.5 then y else 0 end) / (count(*) filter (p >= 0.5) + sum(y)) as f1,
   (count(*) filter (p >= 0.5 and y = 0))::double / (count(*) - sum(y)) as fpr from tested group by model) r on r.model = m.model
 join (select model, cum_pos / all_pos::double as rate from gains where position = greatest(1, floor(n * 0.2))) g on g.model = m.model)""")
def metric_audit(spark, d):
    test = demo.test_scores(spark, d)
    reported = thresholds.with_ratios(thresholds.confusion(test)).join(curves.top_capture(test, digits=DIGITS), "model")
    return r6(checks.metric_audit(reported), ["reported", "recomputed"])


# --- splits, folds, samples ---------------------------------------------------------------------


@query("select id, target, split from splits")
def stratified_split(spark, d):
    return sampling.stratified_split(demo.features(spark, d)).select("id", "target", "split")


@query("select split, target, count(*) as rows from splits group by split, target")
def split_balance(spark, d):
    return demo.assigned(spark, d).groupBy("split", "target").agg(F.count(F.lit(1)).alias("rows"))


@query("select id, target, fold from assigned where split = 'train'")
def stratified_folds(spark, d):
    train = demo.assigned(spark, d).where("split = 'train'").drop("fold")
    return sampling.stratified_folds(train).select("id", "target", "fold")


@query(f"select id, target, case when rk <= round_even(0.25 * n, 0) then 'validation' else 'subtrain' end as part from ("
       f"select id, target, row_number() over (partition by target order by {hash_sql('id', tag='calibration-split')}, id) as rk, "
       f"count(*) over (partition by target) as n from splits where split = 'train')")
def nested_split(spark, d):
    train = demo.assigned(spark, d).where("split = 'train'").drop("split", "fold")
    return sampling.stratified_split(
        train, 0.25, tag="calibration-split", names=("subtrain", "validation"), output="part"
    ).select("id", "target", "part")


@query(f"select id from splits where split = 'test' order by {hash_sql('id', tag='sample')}, id limit 300")
def hash_sample_300(spark, d):
    return sampling.hash_sample(demo.assigned(spark, d).where("split = 'test'"), 300).select("id")


@query(f"select id, row_number() over (order by {hash_sql('id', tag='rank')}, id) as rank from features")
def hash_rank(spark, d):
    return ranked_by_hash(demo.features(spark, d).select("id"), [], keyed_hash(F.col("id"), tag="rank"))


# --- preprocessing and naive Bayes ----------------------------------------------------------------

_STAT_COLUMNS = [f"{c}_{s}" for c in NUMERIC_FEATURES for s in ("median", "mean", "std")]


@query(f"select fit, rows, age_group_mode, {rounded(_STAT_COLUMNS)} from stats")
def prep_statistics(spark, d):
    train = demo.assigned(spark, d).where("split = 'train'")
    return r6(prep.fold_statistics(train, [demo.FULL_FIT, *range(demo.FOLDS)]), _STAT_COLUMNS)


@query(f"select fit, id, target, {rounded(list(TRANSFORMED_FEATURES))} from held_x")
def transformed_features(spark, d):
    return r6(demo.held_out_features(spark, d).drop("split", "fold"), TRANSFORMED_FEATURES)


@query("select target, n, round_even(round_even(total / (2.0::double * n), 11), 6) as weight from (select target, count(*) as n, "
       "sum(count(*)) over () as total from splits where split = 'train' group by target)")
def class_weights(spark, d):
    return r6(classifiers.balanced_weights(demo.assigned(spark, d).where("split = 'train'")), ["weight"])


@query("select fit, class, feature, " + rounded(["prior", "mean", "variance"]) + " from (" + " union all ".join(
    f"select fit, {cls} as class, '{c}' as feature, prior_{cls} as prior, m{i}_{cls} as mean, v{i}_{cls} as variance from nb"
    for cls in (0, 1) for i, c in enumerate(TRANSFORMED_FEATURES)) + ")")
def nb_parameters(spark, d):
    return r6(nb_parameters_long(demo.nb_parameters(spark, d), ["fit"]), ["prior", "mean", "variance"])


@query("select id, y, split, fold, p from nb_scores")
def nb_scores(spark, d):
    return demo.nb_scores(spark, d)


@query("select id, y, split, fold, p from card_scores")
def scorecard_scores(spark, d):
    return demo.scorecard_scores(spark, d)


def _knn_sql(k: int) -> str:
    d2 = " + ".join(f"(a.{q(c)} - b.{q(c)}) * (a.{q(c)} - b.{q(c)})" for c in TRANSFORMED_FEATURES)
    return f"""
select id, round_even(round_even(avg(y), 11), 6) as p_uniform,
 round_even(round_even(case when count(*) filter (d2 = 0) > 0 then avg(y) filter (d2 = 0)
  else sum(y / sqrt(d2)) / sum(1 / sqrt(d2)) end, 11), 6) as p_distance from (
 select id, y, d2, row_number() over (partition by id order by d2, nid) as rk from (
  select a.id, b.id as nid, b.target as y, round_even({d2}, 9) as d2
  from held_x a join fit_x b on b.fit = -1 where a.split = 'test')) where rk <= {k} group by id"""


@query(_knn_sql(15))
def knn_scores(spark, d):
    test = demo.held_out_features(spark, d).where("split = 'test'")
    train = demo.fit_features(spark, d).where("fit = -1").withColumn("y", F.col(TARGET))
    near = neighbours.nearest_neighbours(test, train, 15)
    uniform = neighbours.neighbour_vote(near, 15).withColumnRenamed("p", "p_uniform")
    weighted = neighbours.neighbour_vote(near, 15, "distance").withColumnRenamed("p", "p_distance")
    return r6(uniform.join(weighted, "id"), ["p_uniform", "p_distance"])


_MOVED = ", ".join(f"round_even(round_even(s.{c} + d.gap * (o.{c} - s.{c}), 11), 6) as {c}" for c in NUMERIC_FEATURES)


@query(f"""
select -d.number - 1 as id, v.age_group, {_MOVED}, 1 as target, true as synthetic
from smote_draws d join smote_base s on s.place = d.place
join smote_near n on n.id = s.id and n.rk = d.pick join minority o on o.id = n.nid
join (select id, age_group, row_number() over (partition by id order by count(*) desc, age_group) as rk from (
 select n.id, m.age_group from smote_near n join minority m on m.id = n.nid where n.rk <= 5) group by id, age_group) v
 on v.id = s.id and v.rk = 1""")
def smotenc_sample(spark, d):
    rows = demo.fit_features(spark, d).where("fit = -1")
    groups = demo.assigned(spark, d).select("id", "age_group")
    made = oversampling.oversample(rows.join(groups, "id")).where("synthetic")
    return r6(made, NUMERIC_FEATURES)


# --- thresholds and economics ---------------------------------------------------------------------

_RATIOS = ["accuracy", "precision", "recall", "f1", "fpr"]


@query(f"select model, tn, fp, fn, tp, 0.5::double as threshold from default_counts")
def confusion_at_050(spark, d):
    return thresholds.confusion(demo.test_scores(spark, d))


@query(f"select model, threshold, tn, fp, fn, tp, {rounded(_RATIOS)} from (select *, {RATIOS} from ("
       f"select t.model, g.threshold, {counts_sql('g.threshold')} from tested t, "
       f"(select unnest([0.0, 0.25, 0.5]) ::double as threshold) g group by t.model, g.threshold))")
def metrics_at_thresholds(spark, d):
    test = demo.test_scores(spark, d)
    wanted = (
        test.select("model").distinct().withColumn("threshold", F.explode(F.array(F.lit(0.0), F.lit(0.25), F.lit(0.5))))
    )
    return r6(thresholds.with_ratios(thresholds.confusion_at(test, wanted)), _RATIOS)


_SWEEP = ["threshold", *_RATIOS, "net_profit"]


@query(f"select model, step, tn, fp, fn, tp, {rounded(_SWEEP)} from sweep")
def threshold_sweep(spark, d):
    return r6(thresholds.threshold_sweep(demo.oof_scores(spark, d)), _SWEEP)


def _sweep_86() -> str:
    return f"""
select model, round_even(threshold, 2) as threshold, tp + fp as contacts, {rounded(['f1', 'net_profit'])} from (
 select *, {RATIOS}, tp * 50.0 - (tp + fp) * 5.0 as net_profit from (
  select t.model, g.threshold, {counts_sql('g.threshold')} from oof t,
   (select 0.05::double + i * ((0.9::double - 0.05::double) / 85) as threshold from range(86) r(i)) g group by t.model, g.threshold))"""


@query(_sweep_86())
def threshold_sweep_short(spark, d):
    sweep = thresholds.threshold_sweep(demo.oof_scores(spark, d), grid=linear_grid(0.05, 0.90, 86))
    out = sweep.select(
        "model", F.bround("threshold", 2).alias("threshold"), (F.col("tp") + F.col("fp")).alias("contacts"), "f1", "net_profit"
    )
    return r6(out, ["f1", "net_profit"])


@query(f"select model, round_even(round_even(threshold, 11), 6) as threshold, metric, round_even(round_even(value, 11), 6) as value from ("
       f"select model, threshold, unnest(['precision', 'recall', 'f1', 'fpr', 'net_profit']) as metric, "
       f"unnest([precision, recall, f1, fpr, net_profit])::double as value from sweep)")
def threshold_curves(spark, d):
    return r6(thresholds.sweep_long(thresholds.threshold_sweep(demo.oof_scores(spark, d))), ["threshold", "value"])


_BEST = ["f1_threshold", "best_f1", "profit_threshold", "best_net_profit"]


@query(f"select model, {rounded(_BEST)} from best")
def best_thresholds(spark, d):
    return r6(thresholds.best_thresholds(thresholds.threshold_sweep(demo.oof_scores(spark, d))), _BEST)


_MONEY = ["threshold", "total_cost", "gross_revenue", "net_profit", "roi_pct", "cost_saved_pct"]


@query(f"select model, position, strategy, contacts, responders_reached, wasted_contacts, {rounded(_MONEY)} from economics")
def strategy_table(spark, d):
    best = thresholds.best_thresholds(thresholds.threshold_sweep(demo.oof_scores(spark, d)))
    return r6(thresholds.strategy_table(demo.test_scores(spark, d), best), _MONEY)


@query(f"""
select model, actual, predicted, round_even(round_even(threshold, 11), 6) as threshold, rows, round_even(round_even(case when whole > 0 then rows / whole else 0.0 end, 11), 6) as share from (
 select model, threshold, unnest(['Non-Responder', 'Non-Responder', 'Responder', 'Responder']) as actual,
  unnest(['Non-Responder', 'Responder', 'Non-Responder', 'Responder']) as predicted,
  unnest([tn, fp, fn, tp]) as rows, unnest([tn + fp, tn + fp, fn + tp, fn + tp]) as whole from tuned_counts)""")
def confusion_normalized(spark, d):
    best = thresholds.best_thresholds(thresholds.threshold_sweep(demo.oof_scores(spark, d)))
    own = best.select("model", F.col("f1_threshold").alias("threshold"))
    cells = thresholds.normalized_confusion(thresholds.confusion_at(demo.test_scores(spark, d), own))
    return r6(cells, ["threshold", "share"])


# --- curves -----------------------------------------------------------------------------------------


@query("select model, round_even(round_even(run_neg / all_neg, 11), 6) as fpr, round_even(round_even(run_pos / all_pos, 11), 6) as tpr, p as threshold from kept "
       "union all select distinct model, 0.0, 0.0, 'inf'::double from tested")
def roc_points(spark, d):
    return r6(curves.roc_points(demo.test_scores(spark, d), digits=DIGITS), ["fpr", "tpr"])


@query("select model, p as threshold, round_even(round_even(run_pos / (run_pos + run_neg), 11), 6) as precision, round_even(round_even(run_pos / all_pos, 11), 6) as recall from curve "
       "union all select distinct model, null, 1.0, 0.0 from tested")
def pr_points(spark, d):
    return r6(curves.pr_points(demo.test_scores(spark, d), digits=DIGITS), ["precision", "recall"])


@query(f"select model, round_even(round_even({AUC}, 11), 6) as roc_auc from curve group by model")
def roc_auc(spark, d):
    return r6(curves.ranking_metrics(demo.test_scores(spark, d)), ["roc_auc"]).select("model", "roc_auc")


@query(f"select model, round_even(round_even({AP}, 11), 6) as pr_auc from curve group by model")
def average_precision(spark, d):
    return r6(curves.ranking_metrics(demo.test_scores(spark, d), digits=DIGITS), ["pr_auc"]).select("model", "pr_auc")


@query("select model, round_even(round_even(coalesce(min(case when run_pos / all_pos >= 0.7 then run_neg / all_neg end), 1.0)::double, 11), 6) as fpr_at_recall "
       "from kept group by model")
def fpr_at_recall70(spark, d):
    return r6(curves.fpr_at_recall(demo.test_scores(spark, d), digits=DIGITS), ["fpr_at_recall"])


@query("select model, 20.0::double as k_percent, greatest(1, floor(max(n) * 0.2))::bigint as n_targeted, "
       "(sum(y) filter (position <= greatest(1, floor(n * 0.2))))::bigint as responders_captured, max(all_pos)::bigint as total_responders, "
       "round_even(round_even(sum(y) filter (position <= greatest(1, floor(n * 0.2))) / max(all_pos)::double, 11), 6) as capture_rate from ranked group by model")
def top20_capture(spark, d):
    return r6(curves.top_capture(demo.test_scores(spark, d), digits=DIGITS), ["capture_rate"])


# --- calibration -------------------------------------------------------------------------------------


@query("select model, round_even(round_even(avg((p - y) * (p - y)), 11), 6) as brier from tested group by model")
def brier(spark, d):
    return r6(calibration.brier(demo.test_scores(spark, d)), ["brier"])


@query("select model, len(list_filter(list_transform(range(1, 10), lambda i: i * 0.1::double), lambda e: e < p))::integer as bin, count(*) as rows, "
       "round_even(round_even(avg(p), 11), 6) as mean_score, round_even(round_even(avg(y), 11), 6) as observed_rate from tested group by all")
def reliability_bins(spark, d):
    return r6(calibration.reliability_table(demo.test_scores(spark, d)), ["mean_score", "observed_rate"])


# --- gains ---------------------------------------------------------------------------------------------


@query("select model, id, p, y, position, decile, cum_pos::bigint as cum_responders, "
       "round_even(round_even(cum_pos / all_pos::double * 100, 11), 6) as cum_pct_responders, round_even(round_even(position / n::double * 100, 11), 6) as cum_pct_customers from gains")
def gains_curve(spark, d):
    return r6(gains.gains_curve(demo.test_scores(spark, d), digits=DIGITS), ["cum_pct_responders", "cum_pct_customers"])


@query("select model, decile, count(*) as customers, sum(y)::bigint as responders, round_even(round_even(max(all_pos)::double / max(n) * 100, 11), 6) as base_rate, "
       "round_even(round_even(avg(y) * 100, 11), 6) as response_rate, round_even(round_even(avg(y) / (max(all_pos)::double / max(n)), 11), 6) as lift from gains group by model, decile")
def decile_lift(spark, d):
    return r6(gains.decile_lift(demo.test_scores(spark, d), digits=DIGITS), ["base_rate", "response_rate", "lift"])


@query("select model, pct::double as pct_customers, position, cum_pos::bigint as cum_responders, round_even(round_even(cum_pos / all_pos::double * 100, 11), 6) as cum_pct_responders "
       "from gains g join (select unnest([20, 30]) as pct) c on g.position = floor(n * pct / 100)")
def gains_at_20_30(spark, d):
    return r6(gains.gains_at(demo.test_scores(spark, d), digits=DIGITS), ["cum_pct_responders"])


# --- bootstrap -------------------------------------------------------------------------------------------


def _boot_sql() -> str:
    parts = [
        f"select model, '{m}' as metric, quantile_cont({m}, 0.025) as ci_lower, quantile_cont({m}, 0.975) as ci_upper, "
        f"stddev_pop({m}) as std, count(*) as replicates from boot group by model"
        for m in bootstrap.METRICS
    ]
    return f"select model, metric, replicates, {rounded(['ci_lower', 'ci_upper', 'std'])} from (" + " union all ".join(parts) + ")"


@query(_boot_sql())
def bootstrap_ci(spark, d):
    out = bootstrap.bootstrap_ci(demo.test_scores(spark, d), BOOT_THRESHOLD, 1000, digits=DIGITS, method="rows")
    return r6(out, ["ci_lower", "ci_upper", "std"])


@query()
def bootstrap_ci_grouped(spark, d):
    return bootstrap.bootstrap_ci(demo.test_scores(spark, d), BOOT_THRESHOLD, 1000)


# --- profiles ----------------------------------------------------------------------------------------------


def _profile_sql() -> str:
    cells = ", ".join(
        f"round_even(avg({c}), 2) as {c}_mean, round_even(quantile_cont({c}::double, 0.5), 2) as {c}_median" for c in NUMERIC_FEATURES
    )
    rows = "(select a.*, t.p, t.y from assigned a join tested t on t.id = a.id where t.model = 'Scorecard')"
    return (
        f"select case when y = 1 then 'Actual Responder' else 'Actual Non-Responder' end as segment, count(*) as customers, {cells} from {rows} group by 1 "
        f"union all select case when p >= 0.25 then 'Predicted Responder' else 'Predicted Non-Responder' end, count(*), {cells} from {rows} group by 1"
    )


@query(_profile_sql())
def profiles_actual_predicted(spark, d):
    rows = demo.assigned(spark, d).where("split = 'test'").withColumn("y", F.col(TARGET)).withColumn("p", scorecard())
    return profiles.customer_profiles(rows, BATCH_THRESHOLD, columns=NUMERIC_FEATURES)


# --- selection ----------------------------------------------------------------------------------------------


@query(f"select model, fold, {rounded(['roc_auc', 'pr_auc'])} from fold_metrics")
def fold_metrics(spark, d):
    return r6(selection.fold_metrics(demo.oof_scores(spark, d), digits=DIGITS), ["roc_auc", "pr_auc"])


_BOARD = [
    "cv_pr_auc_mean", "cv_pr_auc_std", "cv_roc_auc_mean", "cv_roc_auc_std",
    "oof_pr_auc", "oof_roc_auc", "oof_fpr_at_recall", "oof_threshold", "oof_f1",
]


@query(f"select model, {rounded(_BOARD)} from leaderboard")
def dev_leaderboard(spark, d):
    return r6(selection.dev_leaderboard(demo.oof_scores(spark, d), DIGITS), _BOARD)


_PLACED = "(select *, row_number() over (order by cv_pr_auc_mean desc, model) as place from leaderboard)"


@query(f"""
select case when lead < leader_std and fa > fb then runner_up else leader end as selected, leader, runner_up,
 round_even(round_even(lead, 11), 6) as lead, round_even(round_even(leader_std, 11), 6) as leader_std, lead < leader_std as tie_break from (
 select a.model as leader, b.model as runner_up, a.cv_pr_auc_mean - b.cv_pr_auc_mean as lead, a.cv_pr_auc_std as leader_std,
  a.oof_fpr_at_recall as fa, b.oof_fpr_at_recall as fb from {_PLACED} a join {_PLACED} b on a.place = 1 and b.place = 2)""")
def leaderboard_selection(spark, d):
    chosen = selection.select_model(selection.dev_leaderboard(demo.oof_scores(spark, d), DIGITS)).drop("justification")
    return r6(chosen, ["lead", "leader_std"])


_CARD = [*_RATIOS, "roc_auc", "pr_auc", "fpr_at_recall", "capture_rate", "tuned_threshold", "tuned_precision", "tuned_recall", "tuned_f1",
         "cv_pr_auc_mean", "cv_pr_auc_std", "cv_roc_auc_mean", "cv_roc_auc_std", "oof_fpr_at_recall"]


_CAPTURED = (
    "(select model, sum(y) filter (position <= greatest(1, floor(n * 0.2))) as captured, max(all_pos) as total "
    "from ranked group by model)"
)


@query(f"""
select model, tn, fp, fn, tp, captured::bigint as responders_captured, total::bigint as total_responders, {rounded(_CARD)} from (
 select m.*, r.roc_auc, r.pr_auc, k.fpr_at_recall, c.captured, c.total, c.captured / c.total as capture_rate,
  u.threshold as tuned_threshold, u.precision as tuned_precision, u.recall as tuned_recall, u.f1 as tuned_f1,
  l.cv_pr_auc_mean, l.cv_pr_auc_std, l.cv_roc_auc_mean, l.cv_roc_auc_std, l.oof_fpr_at_recall
 from test_metrics m join test_ranking r on r.model = m.model
 join (select model, coalesce(min(case when run_pos / all_pos >= 0.7 then run_neg / all_neg end), 1.0) as fpr_at_recall
  from kept group by model) k on k.model = m.model
 join {_CAPTURED} c on c.model = m.model
 join (select *, {RATIOS} from tuned_counts) u on u.model = m.model join leaderboard l on l.model = m.model)""")
def model_card(spark, d):
    board = selection.dev_leaderboard(demo.oof_scores(spark, d), DIGITS)
    return r6(selection.model_card(demo.test_scores(spark, d), board, DIGITS), _CARD)


@query("select model, metric, round_even(round_even(score, 11), 6) as score from (select m.model, "
       "unnest(['accuracy', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc']) as metric, "
       "unnest([m.accuracy, m.precision, m.recall, m.f1, r.roc_auc, r.pr_auc])::double as score "
       "from test_metrics m join test_ranking r on r.model = m.model)")
def metrics_long(spark, d):
    test = demo.test_scores(spark, d)
    card = thresholds.with_ratios(thresholds.confusion(test)).join(curves.ranking_metrics(test, digits=DIGITS), "model")
    return r6(selection.metrics_long(card), ["score"])


# --- scoring ---------------------------------------------------------------------------------------------------


@query("select id, p, round_even(round_even(p * 50.0 - 5.0, 11), 6) as expected_value, "
       "case when p * 50.0 - 5.0 > 0 then 'Profitable Contact' else 'Negative Expected Return' end as value_class, "
       "case when p >= 0.25 then 'WILL RESPOND' else 'WILL NOT RESPOND' end as \"Prediction\" from card_scores")
def expected_value(spark, d):
    scored = scoring.contact_advice(demo.scorecard_scores(spark, d), BATCH_THRESHOLD)
    out = scored.withColumn("Prediction", decisions.label(F.col("p"), BATCH_THRESHOLD))
    return r6(out.select("id", "p", "expected_value", "value_class", "Prediction"), ["expected_value"])


@query(f"select id, {', '.join(FEATURES)}, p as \"Response_Probability\", "
       f"case when p >= 0.25 then 'WILL RESPOND' else 'WILL NOT RESPOND' end as \"Prediction\" from (select *, {_scorecard_sql()} as p from features)")
def batch_scores(spark, d):
    rows = demo.features(spark, d).drop(TARGET)
    return scoring.score_batch(lambda r: r.withColumn("p", scorecard()), rows, BATCH_THRESHOLD)


@query(f"select count(*) as prospects, count(*) filter (p >= 0.25) as targeted, 0::bigint as unknown_age_group, "
       f"round_even(round_even(count(*) filter (p >= 0.25) / count(*)::double * 100, 11), 6) as targeted_pct, count(*) filter (p >= 0.25) * 5.0::double as spend "
       f"from (select {_scorecard_sql()} as p from features)")
def batch_summary(spark, d):
    rows = demo.features(spark, d).withColumn("p", scorecard())
    return r6(scoring.batch_summary(rows, BATCH_THRESHOLD), ["targeted_pct"])


@query(f"""
select count(*) as rows, round_even(round_even(min(p1 - p0), 11), 6) as smallest_gain, round_even(round_even(avg(p1 - p0), 11), 6) as mean_gain, count(*) filter (p1 - p0 > 0.02) as raised
from (select {_scorecard_sql(previous_campaign_response='0', email_engagement='0.0')} as p0,
 {_scorecard_sql(previous_campaign_response='1', email_engagement='0.2')} as p1 from features)""")
def prior_effect_audit(spark, d):
    low = {"previous_campaign_response": F.lit(0), "email_engagement": F.lit(0.0)}
    high = {"previous_campaign_response": F.lit(1), "email_engagement": F.lit(0.2)}
    rows = demo.features(spark, d).select(scorecard(low).alias("p0"), scorecard(high).alias("p1"))
    return r6(checks.effect_audit(rows), ["smallest_gain", "mean_gain"])


# --- explainability -------------------------------------------------------------------------------------------


def _score_card(rows: DataFrame) -> DataFrame:
    return rows.withColumn("p", scorecard())


def _permutation_sql() -> str:
    variants = " union all ".join(
        f"select '{f}' as feature, v.repeat, v.target as y, {_scorecard_sql(**{f: 'd_' + f})} as p from v" for f in FEATURES
    )
    f1 = "2 * count(*) filter (p >= 0.25 and y = 1) / (count(*) filter (p >= 0.25) + count(*) filter (y = 1))"
    return f"""
select feature, round_even(round_even(avg(base - f1), 11), 6) as importance_mean, round_even(round_even(stddev_pop(base - f1), 11), 6) as importance_std from (
 select feature, repeat, {f1} as f1, (select {f1} from card_scores where split = 'test') as base from (
  {variants.replace(' from v', ' from permuted v')}) group by feature, repeat) group by feature"""


@query(_permutation_sql())
def permutation_importance(spark, d):
    rows = demo.assigned(spark, d).where("split = 'test'").drop("split", "fold")
    out = explain.permutation_importance(_score_card, rows, threshold=BATCH_THRESHOLD)
    return r6(out, ["importance_mean", "importance_std"])


def _shapley_sql() -> str:
    blend = {f: f"(case when (m >> {i}) & 1 = 1 then c.{f} else b.{f} end)" for i, f in enumerate(FEATURES)}
    factorial = [1, 1, 2, 6, 24, 120, 720, 5040, 40320]
    weights = "[" + ", ".join(f"{factorial[s]} * {factorial[7 - s]} / 40320.0::double" for s in range(8)) + "]"
    shares = ", ".join(
        f"sum(v * case when (m >> {i}) & 1 = 1 then {weights}[bit_count(m)] else -{weights}[bit_count(m) + 1] end) as s{i}" for i in range(8)
    )
    return f"""
select feature, round_even(round_even(avg(abs(phi)), 11), 6) as mean_abs_phi from (
 select id, unnest(['{"', '".join(FEATURES)}']) as feature, unnest([{", ".join(f"s{i}" for i in range(8))}]) as phi from (
  select id, {shares} from (
   select c.id, m::integer as m, avg({_scorecard_sql(**blend)}) as v
   from (select * from (select *, row_number() over (order by {hash_sql("id", tag="shapley")}, id) as rk from tested_features) where rk <= {explain.SHAPLEY_ROWS}) c,
    (select {", ".join(FEATURES)} from assigned where split = 'train') b, range(256) t(m) group by c.id, m) group by id)) group by feature"""


@query(_shapley_sql())
def shapley_exact(spark, d):
    """Attributions of the scorecard by all coalitions of the eight features against the whole training split."""
    rows = demo.assigned(spark, d)
    card = explain.AdditiveScore(_score_card, INTERCEPT, score_terms, score_curve)
    values = explain.exact_shapley_values(card, rows.where("split = 'test'"), rows.where("split = 'train'"))
    return r6(explain.shapley_summary(values, len(FEATURES)), ["mean_abs_phi"])


@query()
def shapley_sample(spark, d):
    rows = demo.assigned(spark, d)
    values = explain.shapley_values(
        _score_card, rows.where("split = 'test'"), rows.where("split = 'train'")
    )
    return explain.shapley_summary(values)


def _logit_sql() -> str:
    """The penalized fit by accelerated gradient steps instead of Newton's, until nothing visible moves."""
    n = len(TRANSFORMED_FEATURES) + 1
    step = "1.0 / (1.0 + 0.1 * rows * 12 / 4)"
    momentum = "(sqrt(1.0 + 0.1 * rows * 12 / 4) - 1) / (sqrt(1.0 + 0.1 * rows * 12 / 4) + 1)"
    gradient = "[" + ", ".join(f"0.1 * sum((p - y) * x[{i + 1}])" + (f" + any_value(u[{i + 1}])" if i else "") for i in range(n)) + "]"
    return f"""
select feature, round_even(round_even(exp(w), 11), 6) as odds_ratio, round_even(round_even(abs(w), 11), 6) as abs_log_odds from (
 with recursive logit_x as (select target as y, [1.0::double, {', '.join(f'{q(c)}::double' for c in TRANSFORMED_FEATURES)}] as x, (count(*) over ())::double as rows from fit_x where fit = -1),
 walk as (
  select 0 as k, [0.0::double for i in range({n})] as w, [0.0::double for i in range({n})] as u
  union all
  select k + 1, v, [v[i] + m * (v[i] - w[i]) for i in range(1, {n + 1})] from (
   select k, w, [u[i] - s * g[i] for i in range(1, {n + 1})] as v, m from (
    select k, any_value(w) as w, any_value(u) as u, {gradient} as g, {step.replace('rows', 'any_value(rows)')} as s, {momentum.replace('rows', 'any_value(rows)')} as m
    from (select walk.*, x, y, rows, 1.0 / (1.0 + exp(-list_dot_product(u, x))) as p from walk, logit_x where k < 1500) group by k)))
 select unnest(['{"', '".join(TRANSFORMED_FEATURES)}']) as feature, unnest(w[2:]) as w from walk where k = 1500)"""


@query(_logit_sql())
def logit_odds_ratios(spark, d):
    """Odds ratios of all columns at the published strength 0.1 on the whole training split."""
    rows = demo.fit_features(spark, d).where("fit = -1").select(TARGET, *[F.col(f"`{c}`") for c in TRANSFORMED_FEATURES])
    (found,) = logistic.fit_logits(durable(rows), TRANSFORMED_FEATURES, [0.1], label=TARGET)
    table = explain.odds_ratio_table(explain.coefficient_table(TRANSFORMED_FEATURES, found.coefficients), len(TRANSFORMED_FEATURES))
    return r6(table, ["odds_ratio", "abs_log_odds"])


@query()
def tree_importances(spark, d):
    """Impurity importances of the forest with the published 100 trees of depth 6 on the whole training split."""
    rows = trees.training_rows(demo.fit_features(spark, d).where("fit = -1").withColumn("w", F.lit(1.0)), trees=100)
    nodes, _ = trees.grow(rows, [trees.Stop(6)], trees.FOREST_FEATURES)
    return trees.impurity_importances(nodes)


_NAMES = "['" + "', '".join(TRANSFORMED_FEATURES) + "'][f + 1]"


@query(f"select path, depth, n::bigint as n, n1::bigint as n1, {_NAMES} as feature, round_even(round_even(threshold, 11), 6) as threshold from tree_nodes")
def decision_tree_nodes(spark, d):
    """All nodes of the Gini tree of depth 3 on the whole training split."""
    rows = trees.training_rows(demo.fit_features(spark, d).where("fit = -1").withColumn("w", F.lit(1.0)))
    nodes, _ = trees.grow(rows, [trees.Stop(3)])
    counted = trees.named_nodes(nodes).withColumns({c: F.col(c).cast("bigint") for c in ("n", "n1")})
    return r6(counted.select("path", "depth", "n", "n1", "feature", "threshold"), ["threshold"])


@query(f"""
select t.depth, path, {_NAMES} as feature, round_even(round_even(threshold, 11), 6) as threshold, n::bigint as n, round_even(round_even(value, 11), 6) as value from (
 select 5::bigint as depth, path, f, threshold, n, case when f is null then (n1 - n * p) / (n * p * (1 - p)) end as value from boost_nodes, (select avg(y) as p from boost_x where f = 0) g
 union all
 select 3, path, case when b.depth < 3 then f end, case when b.depth < 3 then threshold end, n,
  case when f is null or b.depth = 3 then (n1 - n * p) / (n * p * (1 - p)) end from boost_nodes b, (select avg(y) as p from boost_x where f = 0) g where b.depth <= 3) t""")
def boosting_first_trees(spark, d):
    """First boosting tree of both published depths on the whole training split; it is the same for every rate."""
    rows, everything = demo.assigned(spark, d).where("split = 'train'"), demo.statistics(spark, d).where("fit = -1")
    fits = [boosting.Fit(0.1, depth, boosting.NO_FOLD) for depth in (3, 5)]
    model = boosting.Boosting(rows, boosting.bins_of(rows, everything, bins=trees.MOST_VALUES // 2), fits)
    model.grow_tree()
    nodes = [(fits[fit].depth, *node) for fit, *node in model.tree_table(0)]
    table = spark.createDataFrame(nodes, "depth bigint, path string, feature string, threshold double, n bigint, value double")
    return r6(table, ["threshold", "value"])


# --- model fitting ----------------------------------------------------------------------------------------------


def _train(spark, d) -> DataFrame:
    return demo.assigned(spark, d).where("split = 'train'").drop("split")


@query()
def oof_scores_rf(spark, d):
    grids = {"Random Forest": {"n_estimators": [50], "max_depth": [6], "min_samples_split": [2]}}
    scores = tuning.candidate_scores(tuning.FoldData(_train(spark, d)), ["Random Forest"], grids)
    return scores.select("model", "fold", "id", "y", "p")


@query(f"""
select 'Naive Bayes' as model, position::integer as position, parameters, {rounded(['cv_pr_auc_mean', 'cv_pr_auc_std', 'cv_roc_auc_mean', 'cv_roc_auc_std'])}
from (select position, parameters, avg(pr_auc) as cv_pr_auc_mean, stddev_pop(pr_auc) as cv_pr_auc_std, avg(roc_auc) as cv_roc_auc_mean,
 stddev_pop(roc_auc) as cv_roc_auc_std from nb_grid_folds group by position, parameters)""")
def grid_search_naive_bayes(spark, d):
    """The published grid, ranked on exact scores."""
    scores = tuning.candidate_scores(tuning.FoldData(_train(spark, d)), ["Naive Bayes"], classifiers.GRIDS)
    return r6(tuning.grid_results(scores), ["cv_pr_auc_mean", "cv_pr_auc_std", "cv_roc_auc_mean", "cv_roc_auc_std"])


@query()
def grid_search_knn(spark, d):
    """The published grid of the neighbour classifier: one search serves all eight settings."""
    scores = tuning.candidate_scores(tuning.FoldData(_train(spark, d)), ["K-Nearest Neighbors"], classifiers.GRIDS)
    return tuning.grid_results(scores)


def _published_search(spark, d, *models: str) -> DataFrame:
    scores = tuning.candidate_scores(tuning.FoldData(_train(spark, d)), models, classifiers.GRIDS)
    return tuning.grid_results(scores)


@query()
def grid_search_decision_tree(spark, d):
    """The published 18 settings over all folds."""
    return _published_search(spark, d, "Decision Tree")


@query()
def grid_search_forest(spark, d):
    """The published 24 settings over all folds, from one forest of 150 trees a fold."""
    return _published_search(spark, d, "Random Forest")


@query()
def grid_search_boosting(spark, d):
    """The published 18 settings over all folds, from 30 ensembles grown side by side."""
    return _published_search(spark, d, "Gradient Boosting")


@query()
def grid_search_small(spark, d):
    """The published settings of three models in one search."""
    return _published_search(spark, d, "Logistic Regression", "Naive Bayes", "Decision Tree")


@query()
def imbalance_study(spark, d):
    rows = demo.assigned(spark, d)
    candidate = classifiers.Candidate("Logistic Regression", {"C": 0.1})
    return tuning.imbalance_study(
        candidate,
        rows.where("split = 'train'").drop("split"),
        rows.where("split = 'test'").drop("split", "fold"),
        parallelism=4,
    )


@query()
def calibration_check(spark, d):
    rows = demo.assigned(spark, d)
    found = training.calibrate(
        classifiers.Candidate("Logistic Regression", {"C": 0.1}),
        rows.where("split = 'train'"),
        rows.where("split = 'test'").drop("split", "fold"),
    )
    # One row of summary figures; its inputs are the Brier scores of the whole splits.
    return spark.createDataFrame([tuple(found.values())], ", ".join(
        f"{k} {'boolean' if isinstance(v, bool) else 'double'}" for k, v in found.items()))


_SIGMOID = """
 with recursive cal_rows as (
  select y, p, split, case when split = 'train' then (row_number() over (partition by split, y order by {hash}, id) - 1) * 5 // count(*) over (partition by split, y) end as cal_fold
  from nb_scores),
 cal_fits as (select r.y, r.p, g.fit from cal_rows r, (select unnest([-1, 0, 1, 2, 3, 4]) as fit) g where r.split = 'train' and r.cal_fold <> g.fit),
 cal_sizes as (select fit, sum(y) as pos, sum(1 - y) as neg from cal_fits group by fit),
 cal_cells as materialized (select f.fit, p, case when y = 1 then (pos + 1.0::double) / (pos + 2) else 1.0::double / (neg + 2) end as t from cal_fits f join cal_sizes s on f.fit = s.fit),
 curve_steps as (
  select 0 as k, fit, 0.0::double as a, 0.0::double as b from cal_sizes
  union all
  select k + 1, fit, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) from (
   select k, fit, any_value(a) as a, any_value(b) as b, sum((m - t) * p) as ga, sum(m - t) as gb,
    sum(m * (1 - m) * p * p) as haa, sum(m * (1 - m) * p) as hab, sum(m * (1 - m)) as hbb
   from (select s.*, c.p, c.t, 1.0 / (1.0 + exp(-(s.a * c.p + s.b))) as m from curve_steps s join cal_cells c on s.fit = c.fit where k < 30) group by k, fit))
 select r.split, avg((r.p - y) ** 2) as raw, avg((1.0 / (1.0 + exp(-(a * r.p + b))) - y) ** 2) as cal,
  max(case when split = 'test' then a end) as a, max(case when split = 'test' then b end) as b
 from cal_rows r join curve_steps s on s.fit = coalesce(r.cal_fold, -1) and s.k = 30 group by r.split"""


@query(f"""
select {rounded(['validation_uncalibrated', 'validation_calibrated', 'test_uncalibrated', 'test_calibrated'])}, validation_calibrated < validation_uncalibrated as validation_improved,
 {rounded(['slope', 'intercept'])} from (
select max(case when split = 'train' then raw end) as validation_uncalibrated, max(case when split = 'train' then cal end) as validation_calibrated,
 max(case when split = 'test' then raw end) as test_uncalibrated, max(case when split = 'test' then cal end) as test_calibrated, max(a) as slope, max(b) as intercept
from ({_SIGMOID.format(hash=hash_sql('id', tag='calibration'))}))""")
def calibration_naive_bayes(spark, d):
    """Sigmoid calibration of naive Bayes: out-of-fold scores of the training split as validation, then the test split."""
    rows = demo.nb_scores(spark, d)
    validation, test = (durable(rows.where(F.col("split") == s).select("id", "y", "p")) for s in ("train", "test"))
    found = calibration.calibration_check(validation, test)
    table = spark.createDataFrame([tuple(found.values())], ", ".join(
        f"{k} {'boolean' if isinstance(v, bool) else 'double'}" for k, v in found.items()))
    return r6(table, [k for k, v in found.items() if not isinstance(v, bool)])


# --- streaming and reports -----------------------------------------------------------------------------------------


@query("select id, p, case when p >= 0.25 then 'WILL RESPOND' else 'WILL NOT RESPOND' end as \"Prediction\" from card_scores")
def score_stream(spark, d):
    source = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    demo.features(spark, d).write.parquet(f"{source}/in")
    arriving = streaming_scoring.customer_stream(spark, f"{source}/in", files_per_trigger=4)
    streaming_scoring.run_available(
        streaming_scoring.score_stream(_score_card, arriving), f"{source}/out", f"{source}/progress"
    )
    stored = spark.read.parquet(f"{source}/out")
    return streaming_scoring.decide_stored(stored, BATCH_THRESHOLD).select("id", "p", "Prediction")


def _policies(spark, d) -> tuple[DataFrame, DataFrame]:
    best = thresholds.best_thresholds(thresholds.threshold_sweep(demo.oof_scores(spark, d)))
    return best, thresholds.strategy_table(demo.test_scores(spark, d), best)


_HEAD = """
select model, max(case when position = 1 then net_profit end) as p1, max(case when position = 2 then net_profit end) as p2,
 max(case when position = 3 then net_profit end) as p3, max(case when position = 4 then net_profit end) as p4,
 max(case when position = 1 then contacts end) as c1, max(case when position = 4 then contacts end) as c4,
 max(case when position = 1 then fp end) as w1, max(case when position = 4 then fp end) as w4,
 max(case when position = 1 then tp end) as r1, max(case when position = 4 then tp end) as r4,
 max(case when position = 4 then roi_pct end) as roi4, max(case when position = 4 then cost_saved_pct end) as s4
from economics group by model"""
_FIGURES = {
    ("profit", "net_profit_everyone"): "p1",
    ("profit", "net_profit_optimal"): "p4",
    ("profit", "gain_over_everyone"): "p4 - p1",
    ("profit", "gain_over_everyone_pct"): "case when p1 <> 0 then (p4 - p1)::double / abs(p1) * 100 else 0 end",
    ("profit", "gain_over_default"): "p4 - p2",
    ("profit", "gain_over_f1"): "p4 - p3",
    ("contacts", "contacts_optimal"): "c4",
    ("contacts", "contacts_avoided"): "c1 - c4",
    ("contacts", "wasted_avoided_pct"): "(w1 - w4) / w1 * 100",
    ("cost", "cost_saved"): "(c1 - c4) * 5",
    ("cost", "cost_saved_pct"): "s4",
    ("reach", "responders_kept_pct"): "r4 / r1 * 100",
    ("return", "roi_optimal_pct"): "roi4",
}


@query(" union all ".join(
    f"select '{s}' as section, '{m}' as metric, model, round_even(round_even(({v})::double, 11), 6) as value from ({_HEAD})" for (s, m), v in _FIGURES.items()))
def report_tables(spark, d):
    _, policies = _policies(spark, d)
    return r6(reporting.headline_figures(policies), ["value"])


@query("""
select model, strategy, printf('%.2f', threshold::double) as threshold, contacts::varchar as contacts,
 '$' || format('{:,.2f}', total_cost::double) as total_cost, tp::varchar as responders_reached, fp::varchar as wasted_contacts,
 '$' || format('{:,.2f}', gross_revenue::double) as gross_revenue, '$' || format('{:,.2f}', net_profit::double) as net_profit,
 format('{:,.1f}', roi_pct::double) || '%' as roi, format('{:,.1f}', cost_saved_pct::double) || '%' as cost_saved from economics""")
def formatted_strategies(spark, d):
    _, policies = _policies(spark, d)
    return reporting.formatted_strategies(policies)


@query("select m.model || ' report' as document, 'Rows' as label, 'n=' || (m.tn + m.fp + m.fn + m.tp) as value from default_counts m")
def consistency_anti_join(spark, d):
    """Key figures that a model's published figures lack: its row count is left out on purpose."""
    counts = thresholds.confusion(demo.test_scores(spark, d))
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    cells = F.array(
        F.struct(F.lit("Rows").alias("label"), F.concat(F.lit("n="), n).alias("value")),
        F.struct(F.lit("Responders").alias("label"), F.concat(F.lit("pos="), F.col("fn") + F.col("tp")).alias("value")),
    )
    name = F.concat("model", F.lit(" report")).alias("document")
    expected = counts.select(name, F.explode(cells).alias("c")).select("document", "c.*")
    documents = counts.select(
        name, F.concat(F.lit("pos="), F.col("fn") + F.col("tp")).alias("value")
    )
    return checks.inconsistent_figures(expected, documents)


def _written(spark, rows: DataFrame, name: str, write=files.write_csv) -> str:
    """Location below the shared folder that ``rows`` have been written to."""
    location = f"{checkpoint_root(spark)}/files-{uuid.uuid4().hex}/{name}"
    write(rows, location)
    return location


@query("select * from raw")
def raw_file_round_trip(spark, d):
    """The raw customers written as a tab-separated file with a header, and read again."""
    write = lambda rows, location: rows.write.option("sep", "\t").option("header", True).csv(location)
    return files.read_raw(spark, _written(spark, raw_customers(spark, d).withColumn("extra", F.lit("x")), "raw", write))


@query("select * from features")
def feature_file_round_trip(spark, d):
    """The feature table written as comma-separated files with headers, and read again."""
    return files.read_features(spark, _written(spark, demo.features(spark, d), "features"))


@query("select segment, " + ", ".join(f"{c}_{s}" for c in NUMERIC_FEATURES for s in ("mean", "median")) + f" from ({_profile_sql()})")
def profile_file_round_trip(spark, d):
    """The profile table written with its two header rows, and read again."""
    return files.read_profiles(spark, _written(spark, profiles_actual_predicted(spark, d), "profiles", files.write_profiles))


@query("""
select model, printf('%.3f', m.accuracy::double) as accuracy, m.tn || ' / ' || m.fp || ' / ' || m.fn || ' / ' || m.tp as confusion
from test_metrics m""")
def formatted_card(spark, d):
    board = selection.dev_leaderboard(demo.oof_scores(spark, d), DIGITS)
    card = reporting.formatted_card(selection.model_card(demo.test_scores(spark, d), board, DIGITS))
    return card.select("model", "accuracy", "confusion")


_DOLLARS = "'$' || format('{{:,.2f}}', ({})::double)"


@query(f"""
select model || ' altered' as document, label, value from (
 select model, unnest(['Optimal net profit', 'Everyone net profit']) as label,
  unnest([max(case when position = 4 then {_DOLLARS.format('net_profit')} end), max(case when position = 1 then {_DOLLARS.format('net_profit')} end)]) as value,
  string_agg({_DOLLARS.format('total_cost')} || ' ' || {_DOLLARS.format('gross_revenue')} || ' ' || {_DOLLARS.format('net_profit + 0.01')}, ' ') as written
 from economics group by model) where not contains(written, value)""")
def output_audit(spark, d):
    """Key figures of both models looked up in a run's written tables, and in altered copies of them: only the altered profits are missing."""
    board = selection.dev_leaderboard(demo.oof_scores(spark, d), DIGITS)
    card = durable(selection.model_card(demo.test_scores(spark, d), board, DIGITS))
    best, policies = (durable(rows) for rows in _policies(spark, d))
    base = f"{checkpoint_root(spark)}/files-{uuid.uuid4().hex}"
    expected = None
    for model in (demo.NAIVE_BAYES, demo.SCORECARD):
        one = lambda rows: rows.where(F.col("model") == model)  # noqa: E731, B023
        shifted = policies.withColumn("net_profit", F.col("net_profit") + 0.01)
        for name, table in ((model, policies), (f"{model} altered", shifted)):
            files.write_csv(reporting.formatted_strategies(one(table)).coalesce(1), f"{base}/{name}/strategies")
            files.write_csv(reporting.formatted_card(one(card)).coalesce(1), f"{base}/{name}/card")
            files.write_csv(one(best).select("model", *[F.format_string("%.2f", c).alias(c) for c in ("f1_threshold", "profit_threshold")]).coalesce(1), f"{base}/{name}/best")
            figures = reporting.key_figures(card, policies, best, model).select(F.lit(name).alias("document"), "label", "value")
            expected = figures if expected is None else expected.union(figures)
    return checks.absent_figures(expected, base)


@query("select model, f1_threshold > 0 and profit_threshold > 0 and f1_threshold <> profit_threshold as ok from best")
def threshold_audit(spark, d):
    best, _ = _policies(spark, d)
    return checks.threshold_audit(best).select("model", "ok")

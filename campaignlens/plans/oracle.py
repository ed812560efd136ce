"""Independent SQL for the registered queries, as common table expressions on the warehouse tables."""

from __future__ import annotations

import re

from campaignlens.settings import AGE_GROUPS, DUMMIES, FEATURES, NUMERIC_FEATURES, TRANSFORMED_FEATURES

TWO_PI = 6.283185307179586
# Fixed values of the demonstration scorecard, stated here once more so that the SQL doesn't lean on the engine.
INTERCEPT = -2.2
WEIGHTS = {
    "income": 0.000008,
    "previous_purchases": 0.02,
    "purchase_frequency": -0.15,
    "previous_campaign_response": 0.45,
    "website_visits": 0.03,
    "email_engagement": 2.4,
    "discount_usage": -0.35,
}
OLDEST_GROUP_WEIGHT = 0.1
# A Poisson(1) draw by inversion from a 32-bit hash steps to the next integer at these.
POISSON_STEPS = (1580030169, 3160060337, 3950075422, 4213413783, 4279248374, 4292415292, 4294609778, 4294923276, 4294962463, 4294966817, 4294967253, 4294967292)


def hash_sql(*parts: str, tag: str) -> str:
    text = " || '|' || ".join([*(f"{p}::varchar" for p in parts), "'42'", f"'{tag}'"])
    return f"('0x' || substr(md5({text}), 1, 8))::bigint"


def q(name: str) -> str:
    return f'"{name}"'


def _scorecard_sql(**swap: str) -> str:
    z = str(INTERCEPT)
    for name, weight in WEIGHTS.items():
        z += f" + {weight!r} * coalesce({swap.get(name, name)}::double, 0.0)"
    group = swap.get("age_group", "age_group")
    z += f" + case when {group} = '56+' then {OLDEST_GROUP_WEIGHT} else 0.0 end"
    return f"round_even(1.0 / (1.0 + exp(-({z}))), 4)"


def _prep_columns() -> str:
    cells = []
    for c in NUMERIC_FEATURES:
        cells.append(
            f"case when s.{c}_std = 0 then 0.0 else (coalesce(f.{c}, s.{c}_median) - s.{c}_mean) / s.{c}_std end as {c}"
        )
    for g, d in zip(AGE_GROUPS[1:], DUMMIES):
        cells.append(f"case when coalesce(f.age_group, s.age_group_mode) = '{g}' then 1.0 else 0.0 end::double as {q(d)}")
    return ",\n ".join(cells)


def _likelihood(cls: int) -> str:
    terms = [f"ln(p.prior_{cls})"]
    for i, c in enumerate(TRANSFORMED_FEATURES):
        x, m, v = f"f.{q(c)}", f"p.m{i}_{cls}", f"p.v{i}_{cls}"
        terms.append(f"- 0.5 * ln({TWO_PI!r} * {v}) - ({x} - {m}) * ({x} - {m}) / (2.0 * {v})")
    return " ".join(terms)


def _parts() -> dict[str, str]:
    prior = " + ".join(f"AcceptedCmp{k}" for k in range(1, 6))
    purchases = "(NumWebPurchases + NumCatalogPurchases + NumStorePurchases)::double"
    tenure = "(date_diff('day', strptime(Dt_Customer, '%d-%m-%Y')::date, date '2001-12-31') / 30.4375)"
    medians = ", ".join(f"quantile_cont({c}, 0.5) as {c}_median" for c in NUMERIC_FEATURES)
    moments = ", ".join(
        f"avg(coalesce(f.{c}, m.{c}_median)) as {c}_mean, stddev_pop(coalesce(f.{c}, m.{c}_median)) as {c}_std"
        for c in NUMERIC_FEATURES
    )
    nb_class = ", ".join(
        f"avg(case when target = {cls} then {q(c)} end) as m{i}_{cls}, var_pop(case when target = {cls} then {q(c)} end) as r{i}_{cls}"
        for cls in (0, 1)
        for i, c in enumerate(TRANSFORMED_FEATURES)
    )
    largest = "greatest(" + ", ".join(f"var_pop({q(c)})" for c in TRANSFORMED_FEATURES) + ")"
    nb_final = ", ".join(
        f"m{i}_{cls}, r{i}_{cls} + epsilon as v{i}_{cls}" for cls in (0, 1) for i in range(len(TRANSFORMED_FEATURES))
    )
    spreads = ", ".join(f"stddev_pop({c})" for c in NUMERIC_FEATURES)
    gap2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in NUMERIC_FEATURES)
    split_h, fold_h = hash_sql("id", tag="split"), hash_sql("id", tag="fold")
    campaigns = ", ".join(
        f"max(case when year(o.o_orderdate) = {1994 + k} and o.o_totalprice > 450000 then 1 else 0 end) as c{k}" for k in range(1, 6)
    )
    return {
        "history": f"""
select o.o_custkey, min(o.o_orderdate) as first_order,
 count(*) filter (o.o_orderpriority in ('1-URGENT', '2-HIGH')) as web,
 count(*) filter (o.o_orderpriority = '3-MEDIUM') as cat,
 count(*) filter (o.o_orderpriority in ('4-NOT SPECIFIED', '5-LOW')) as store,
 count(*) filter (o.o_orderkey in (select l_orderkey from lineitem where l_discount > 0.085)) as deals,
 {campaigns}
from orders o group by o.o_custkey""",
        "visits": "select user_id, count(*) as n from events where event_type = 'view' group by user_id",
        "raw0": """
select c.c_custkey as ID, (1927 + (c.c_custkey * 37) % 60)::integer as Year_Birth,
 case when c.c_acctbal >= 0 then c.c_acctbal * 10 end as Income,
 strftime(h.first_order, '%d-%m-%Y') as Dt_Customer,
 coalesce(h.web, 0)::integer as NumWebPurchases, coalesce(h.cat, 0)::integer as NumCatalogPurchases,
 coalesce(h.store, 0)::integer as NumStorePurchases, coalesce(h.deals, 0)::integer as NumDealsPurchases,
 coalesce(v.n, 0)::integer as NumWebVisitsMonth,
 """
        + ", ".join(f"coalesce(h.c{k}, 0)::integer as AcceptedCmp{k}" for k in range(1, 6))
        + """
from customer c left join history h on h.o_custkey = c.c_custkey left join visits v on v.user_id = c.c_custkey // 10""",
        "raw": f"""
select *, (('0x' || substr(md5(ID::varchar || '|resp'), 1, 8))::bigint % 100
 < 8 + 15 * ({prior}) + case when Income > 80000 then 8 else 0 end)::integer as Response from raw0""",
        "features": f"""
select ID as id,
 case when 2001 - Year_Birth <= 25 then '18-25' when 2001 - Year_Birth <= 35 then '26-35'
  when 2001 - Year_Birth <= 45 then '36-45' when 2001 - Year_Birth <= 55 then '46-55'
  when Year_Birth is not null then '56+' end as age_group,
 Income as income, {purchases} as previous_purchases,
 round_even({purchases} / case when Dt_Customer is not null then greatest({tenure}, 1.0) end, 4) as purchase_frequency,
 case when {prior} >= 1 then 1 else 0 end as previous_campaign_response,
 NumWebVisitsMonth::double as website_visits, round_even(({prior}) / 5.0, 4)::double as email_engagement,
 round_even(least(greatest(case when {purchases} > 0 then NumDealsPurchases::double / {purchases} else 0.0 end, 0.0), 1.0), 4) as discount_usage,
 Response as target from raw""",
        "split_rank": f"""
select *, row_number() over (partition by target order by {split_h}, id) as split_rank,
 count(*) over (partition by target) as class_size from features""",
        "splits": """
select * exclude (split_rank, class_size),
 case when split_rank <= round_even(class_size * 0.2, 0) then 'test' else 'train' end as split from split_rank""",
        "fold_rank": f"""
select *, row_number() over (partition by target order by {fold_h}, id) as fold_rank,
 count(*) over (partition by target) as class_size from splits where split = 'train'""",
        "assigned": """
select * exclude (fold_rank, class_size), ((fold_rank - 1) * 5 // class_size)::integer as fold from fold_rank
union all by name select *, -1 as fold from splits where split = 'test'""",
        "fit_rows": """
select a.*, g.fit from assigned a, (select unnest([-1, 0, 1, 2, 3, 4]) as fit) g
where a.split = 'train' and a.fold <> g.fit""",
        "medians": f"select fit, {medians} from fit_rows group by fit",
        "modes": """
select fit, age_group as age_group_mode from (
 select fit, age_group, row_number() over (partition by fit order by count(*) desc, age_group) as rn
 from fit_rows where age_group is not null group by fit, age_group) where rn = 1""",
        "stats": f"""
select f.fit, count(*) as rows, any_value(o.age_group_mode) as age_group_mode,
 {", ".join(f"any_value(m.{c}_median) as {c}_median" for c in NUMERIC_FEATURES)},
 {moments}
from fit_rows f join medians m on m.fit = f.fit join modes o on o.fit = f.fit group by f.fit""",
        "fit_x": f"select f.fit, f.id, f.split, f.fold, f.target, {_prep_columns()} from fit_rows f join stats s on s.fit = f.fit",
        "held_x": f"select s.fit, f.id, f.split, f.fold, f.target, {_prep_columns()} from assigned f join stats s on s.fit = f.fold",
        "fit_mix": "select f.*, r.age_group from fit_x f join fit_rows r on r.id = f.id and r.fit = f.fit where f.fit = -1",
        "tree_x": "select id, target as y, unnest(range(11)) as f, unnest(["
        + ", ".join(f"{q(c)}::double" for c in TRANSFORMED_FEATURES) + "]) as v from fit_x where fit = -1",
        **grown_sql("tree", "tree_x", 3, "(l1 * l1 + (nl - l1) * (nl - l1)) / nl + (r1 * r1 + (nr - r1) * (nr - r1)) / nr"
                    " - (n1 * n1 + (n - n1) * (n - n1)) / n", "n1 > 0 and n1 < n"),
        "boost_x": "select f.id, f.target as y, unnest(range(11)) as f, unnest(["
        + ", ".join([*[f"coalesce(f.{c}, s.{c}_median)::double" for c in NUMERIC_FEATURES],
                     *[f"(coalesce(f.age_group, s.age_group_mode) = '{g}')::integer::double" for g in AGE_GROUPS[1:]]])
        + "]) as v from fit_rows f join stats s on s.fit = f.fit where f.fit = -1",
        **grown_sql("boost", "boost_x", 5, "nl * nr / n * (l1 / nl - r1 / nr) * (l1 / nl - r1 / nr)", "gain > 1e-9"),
        "minority": "select * from fit_mix where target = 1",
        "penalty": f"select quantile_cont(s, 0.5) as m from (select unnest([{spreads}]) as s from minority)",
        "smote_near": f"""
select id, nid, row_number() over (partition by id order by d2, nid) as rk from (
 select a.id, b.id as nid, round_even({gap2} + case when a.age_group <> b.age_group then p.m * p.m else 0.0 end, 9) as d2
 from minority a join minority b on a.id <> b.id, penalty p)""",
        "smote_base": f"select *, row_number() over (order by {hash_sql('id', tag='smote-base')}, id) as place from minority",
        "smote_draws": f"""
select number, {hash_sql('number', tag='smote-row')} % (select count(*) from minority) + 1 as place,
 {hash_sql('number', tag='smote-neighbour')} % 5 + 1 as pick, {hash_sql('number', tag='smote-gap')} / 4294967296.0::double as gap
from (select unnest(range((select count(*) filter (target = 0) - count(*) filter (target = 1) from fit_mix))) as number)""",
        "nb_raw": f"""
select fit, avg(target) as prior_1, 1 - avg(target) as prior_0, 1e-9 * {largest} as epsilon, {nb_class}
from fit_x group by fit""",
        "nb": f"select fit, epsilon, prior_0, prior_1, {nb_final} from nb_raw",
        "nb_grid_raw": """
select r.* replace (r.epsilon * g.factor as epsilon), g.position, g.parameters from nb_raw r,
 (values (0, 1.0::double, 'var_smoothing=1e-09'), (1, 10.0, 'var_smoothing=1e-08'), (2, 100.0, 'var_smoothing=1e-07'),
  (3, 1000.0, 'var_smoothing=1e-06')) g(position, factor, parameters)""",
        "nb_grid": f"select position, parameters, fit, epsilon, prior_0, prior_1, {nb_final} from nb_grid_raw",
        "nb_grid_scores": f"""
select p.position, p.parameters, f.fold, f.id, f.target as y,
 1.0 / (1.0 + exp(({_likelihood(0)}) - ({_likelihood(1)}))) as p
from held_x f join nb_grid p on p.fit = f.fit where f.split = 'train'""",
        "nb_grid_curve": """
select position, parameters, fold, p, sum(y) as pos, sum(1 - y) as neg,
 sum(sum(y)) over (partition by position, fold order by p desc) as run_pos,
 sum(sum(1 - y)) over (partition by position, fold order by p desc) as run_neg,
 sum(sum(y)) over (partition by position, fold) as all_pos,
 sum(sum(1 - y)) over (partition by position, fold) as all_neg from nb_grid_scores group by position, parameters, fold, p""",
        "nb_grid_folds": f"""
select position, parameters, fold, {AUC} as roc_auc, {AP} as pr_auc from nb_grid_curve group by position, parameters, fold""",
        "nb_scores": f"""
select f.id, f.target as y, f.split, f.fold,
 round_even(1.0 / (1.0 + exp(({_likelihood(0)}) - ({_likelihood(1)}))), 4) as p
from held_x f join nb p on p.fit = f.fit""",
        "card_scores": f"select id, target as y, split, fold, {_scorecard_sql()} as p from assigned",
        "scored": """
select 'Naive Bayes' as model, * from nb_scores union all by name select 'Scorecard' as model, * from card_scores""",
        "tested": "select model, id, y, p from scored where split = 'test'",
        "oof": "select model, fold, id, y, p from scored where split = 'train'",
        "grid": "select i::integer as step, 0.05::double + i * ((0.95::double - 0.05::double) / 90) as threshold from range(91) g(i)",
        "oof_groups": "select model, p, sum(y)::bigint as pos, sum(1 - y)::bigint as neg from oof group by model, p",
        "sweep_counts": """
select s.model, g.step, case when g.step = 90 then 0.95 else g.threshold end as threshold,
 sum(case when s.p < g.threshold then s.neg else 0 end)::bigint as tn,
 sum(case when s.p >= g.threshold then s.neg else 0 end)::bigint as fp,
 sum(case when s.p < g.threshold then s.pos else 0 end)::bigint as fn,
 sum(case when s.p >= g.threshold then s.pos else 0 end)::bigint as tp
from oof_groups s, grid g group by all""",
        "sweep": f"""
select *, {RATIOS}, tp * 50.0 - (tp + fp) * 5.0 as net_profit from sweep_counts""",
        "best": """
select model, arg_min(threshold, (-f1, threshold)) as f1_threshold, max(f1) as best_f1,
 arg_min(threshold, (-net_profit, threshold)) as profit_threshold, max(net_profit) as best_net_profit
from (select model, threshold, f1, net_profit from sweep) group by model""",
        "test_groups": "select model, p, sum(y)::bigint as pos, sum(1 - y)::bigint as neg from tested group by model, p",
        "curve": """
select *, sum(pos) over (partition by model order by p desc) as run_pos,
 sum(neg) over (partition by model order by p desc) as run_neg,
 sum(pos) over (partition by model) as all_pos, sum(neg) over (partition by model) as all_neg,
 row_number() over (partition by model order by p desc) as place,
 lead(pos) over (partition by model order by p desc) as next_pos,
 lead(neg) over (partition by model order by p desc) as next_neg from test_groups""",
        "kept": """
select * from curve where place = 1 or next_pos is null or not (pos = next_pos and neg = next_neg)""",
        "ranked": f"""
select *, row_number() over (partition by model order by p desc, {hash_sql("id", tag="tie")}, id) as position,
 count(*) over (partition by model) as n, sum(y) over (partition by model) as all_pos from tested""",
        "gains": """
select *, sum(y) over (partition by model order by position) as cum_pos,
 greatest(1, ceil((position - 1) * 10 / (n - 1)))::integer as decile from ranked""",
        "oof_curve": """
select model, fold, p, sum(y) as pos, sum(1 - y) as neg,
 sum(sum(y)) over (partition by model, fold order by p desc) as run_pos,
 sum(sum(1 - y)) over (partition by model, fold order by p desc) as run_neg,
 sum(sum(y)) over (partition by model, fold) as all_pos,
 sum(sum(1 - y)) over (partition by model, fold) as all_neg from oof group by model, fold, p""",
        "fold_metrics": f"""
select model, fold, {AUC} as roc_auc, {AP} as pr_auc from oof_curve group by model, fold""",
        "pooled_curve": """
select model, p, pos, neg, sum(pos) over (partition by model order by p desc) as run_pos,
 sum(neg) over (partition by model order by p desc) as run_neg,
 sum(pos) over (partition by model) as all_pos, sum(neg) over (partition by model) as all_neg,
 row_number() over (partition by model order by p desc) as place,
 lead(pos) over (partition by model order by p desc) as next_pos,
 lead(neg) over (partition by model order by p desc) as next_neg from oof_groups""",
        "pooled": f"""
select model, {AUC} as oof_roc_auc, {AP} as oof_pr_auc,
 coalesce(min(case when (place = 1 or next_pos is null or not (pos = next_pos and neg = next_neg))
  and run_pos / all_pos >= 0.7 then run_neg / all_neg end), 1.0) as oof_fpr_at_recall
from pooled_curve group by model""",
        "leaderboard": """
select f.*, b.f1_threshold as oof_threshold, b.best_f1 as oof_f1, p.oof_pr_auc, p.oof_roc_auc, p.oof_fpr_at_recall
from (select model, avg(pr_auc) as cv_pr_auc_mean, stddev_pop(pr_auc) as cv_pr_auc_std,
 avg(roc_auc) as cv_roc_auc_mean, stddev_pop(roc_auc) as cv_roc_auc_std from fold_metrics group by model) f
join pooled p on p.model = f.model join best b on b.model = f.model""",
        "default_counts": f"""
select model, {counts_sql("0.5")} from tested group by model""",
        "test_metrics": f"select *, {RATIOS} from default_counts",
        "test_ranking": f"select model, {AUC} as roc_auc, {AP} as pr_auc from curve group by model",
        "tuned_counts": f"""
select t.model, b.f1_threshold as threshold, {counts_sql("b.f1_threshold")}
from tested t join best b on b.model = t.model group by t.model, b.f1_threshold""",
        "policies": """
select model, unnest([1, 2, 3, 4]) as position,
 unnest(['Strategy 1: Contact Everyone', 'Strategy 2: Default ML (Threshold 0.50)',
  format('Strategy 3: F1-Optimal (Threshold {:.2f})', f1_threshold),
  format('Strategy 4: Profit-Optimal (Threshold {:.2f})', profit_threshold)]) as strategy,
 unnest([0.0, 0.5, f1_threshold, profit_threshold]) as threshold from best""",
        "policy_counts": f"""
select t.model, s.position, s.strategy, s.threshold, {counts_sql("s.threshold")}
from tested t join policies s on s.model = t.model group by all""",
        "economics": """
select *, tp + fp as contacts, (tp + fp) * 5.0 as total_cost, tp as responders_reached, fp as wasted_contacts,
 tp * 50.0 as gross_revenue, tp * 50.0 - (tp + fp) * 5.0 as net_profit,
 case when tp + fp > 0 then (tp * 50.0 - (tp + fp) * 5.0) / ((tp + fp) * 5.0) else 0 end * 100 as roi_pct,
 (tn + fn) / (tn + fp + fn + tp) * 100 as cost_saved_pct from policy_counts""",
        "tested_features": "select id, target, " + ", ".join(FEATURES) + " from splits where split = 'test'",
        "permuted": f"""
select r.*, d.repeat, {", ".join(f"d.{f} as d_{f}" for f in FEATURES)} from
 (select *, row_number() over (order by {hash_sql("id", tag="permute")}, id) as rk from tested_features) r join
 (select *, row_number() over (partition by repeat order by {hash_sql("id", "repeat", tag="permute")}, id) as rk
  from tested_features, (select unnest(range(5)) as repeat) g) d on d.rk = r.rk""",
        "boot_draws": f"""
select t.*, r.replicate, {hash_sql("t.id", "r.replicate", tag="boot")} as h
from tested t, (select unnest(range(1000))::integer as replicate) r""",
        "boot_weights": f"""
select *, ({" + ".join(f"(h >= {c})::bigint" for c in POISSON_STEPS)}) as w from boot_draws""",
        "boot_curve": """
select model, replicate, p, sum(w * y) as pos, sum(w * (1 - y)) as neg,
 sum(sum(w * y)) over (partition by model, replicate order by p desc) as run_pos,
 sum(sum(w * (1 - y))) over (partition by model, replicate order by p desc) as run_neg,
 sum(sum(w * y)) over (partition by model, replicate) as all_pos,
 sum(sum(w * (1 - y))) over (partition by model, replicate) as all_neg
from boot_weights where w > 0 group by model, replicate, p""",
        "boot": f"""
select model, replicate, {AUC} as roc_auc, {AP} as pr_auc,
 2 * sum(case when p >= 0.25 then pos else 0 end)
  / (sum(case when p >= 0.25 then pos + neg else 0 end) + max(all_pos)) as f1
from boot_curve group by model, replicate having max(all_pos) > 0 and max(all_neg) > 0""",
    }


def grown_sql(name: str, source: str, depth: int, gain: str, splits: str) -> dict[str, str]:
    """Common tables that grow one tree level by level from ``(id, y, f, v)``: rows ``_r``, best cuts ``_b``, nodes ``_nodes``.

    ``gain`` is written in rows ``n``, ``nl``, ``nr`` and responders ``n1``, ``l1``, ``r1``; ``splits`` says which nodes and gains allow a cut.
    """
    parts = {f"{name}_r0": f"select id, y, '' as path, f, v from {source} s"}
    for k in range(depth):
        parts[f"{name}_c{k}"] = f"""
select *, n - nl as nr, n1 - l1 as r1 from (
 select path, f, v, sum(m) over w as nl, sum(m1) over w as l1, lead(v) over w as next, sum(m) over (partition by path, f) as n, sum(m1) over (partition by path, f) as n1
 from (select path, f, v, count(*)::double as m, sum(y)::double as m1 from {name}_r{k} group by path, f, v)
 window w as (partition by path, f order by v))"""
        parts[f"{name}_b{k}"] = f"""
select path, {k} as depth, any_value(n) as n, any_value(n1) as n1,
 arg_min({{'f': f, 'v': v, 'next': next}}, (-round(gain, 9), f, v)) filter (where next is not null and {splits}) as cut
from (select *, {gain} as gain from {name}_c{k}) group by path"""
        parts[f"{name}_r{k + 1}"] = f"""
select r.id, r.y, r.path || case when x.v <= (b.cut.v + b.cut.next) / 2 then 'L' else 'R' end as path, r.f, r.v
from {name}_r{k} r join {name}_b{k} b on r.path = b.path join {name}_r{k} x on x.id = r.id and x.f = b.cut.f"""
    inner = " union all ".join(f"select path, depth, n, n1, cut.f as f, (cut.v + cut.next) / 2 as threshold from {name}_b{k}" for k in range(depth))
    parts[f"{name}_nodes"] = f"""
{inner} union all select path, {depth}, count(*), sum(y), null, null from {name}_r{depth} where f = 0 group by path"""
    return parts


def counts_sql(threshold: str) -> str:
    return (
        f"count(*) filter (p < {threshold} and y = 0) as tn, count(*) filter (p >= {threshold} and y = 0) as fp, "
        f"count(*) filter (p < {threshold} and y = 1) as fn, count(*) filter (p >= {threshold} and y = 1) as tp"
    )


RATIOS = (
    "(tp + tn) / (tp + tn + fp + fn) as accuracy, "
    "case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision, "
    "case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall, "
    "case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end as f1, "
    "case when fp + tn > 0 then fp / (fp + tn) else 0.0 end as fpr"
)
AUC = "sum(pos * (all_neg - run_neg + neg / 2.0)) / (max(all_pos)::double * max(all_neg))"
AP = "sum(pos / all_pos::double * run_pos / (run_pos + run_neg)::double)"


def with_parts(body: str) -> str:
    """Prefix a query with the common tables it needs, in dependency order."""
    parts = _parts()
    order = list(parts)
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in order:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b|,\s*{name}\s+[a-z]\b", text):
                needed.add(name)
                pending.append(parts[name])
    chosen = [name for name in order if name in needed]
    if not chosen:
        return body
    return "with " + ",\n".join(f"{name} as materialized ({parts[name]})" for name in chosen) + "\n" + body


def rounded(columns: list[str]) -> str:
    return ", ".join(f"round_even(round_even({q(c)}::double, 11), 6) as {q(c)}" for c in columns)

"""Queries on rank metrics, cut-offs, bins and drift."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from riskmart.config import Policy
from riskmart.functions import status as light
from riskmart.operators import drift, metrics, monitoring, routing
from riskmart.plans.catalog import part, query
from riskmart.plans.data_queries import tidy
from riskmart.plans.views import view
from riskmart.sources.tables import stored

POLICY = Policy()
COHORT = ["model_slot", "model_version", "cohort_date"]
COHORT_SQL = ", ".join(COHORT)


def curve_part(name: str, source: str, keys: str, score: str, label: str = "label") -> None:
    """Cumulative counts from the highest score down."""
    part(name, f"""
select {keys}, threshold, pos, neg, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg,
       sum(pos) over (partition by {keys}) as total_pos, sum(neg) over (partition by {keys}) as total_neg
from (select {keys}, {score} as threshold, sum({label}) as pos, sum(1 - {label}) as neg from {source} group by {keys}, {score})
window w as (partition by {keys} order by threshold desc)""")


def ranks_part(name: str, curve: str, keys: str) -> None:
    part(name, f"""
select {keys}, max(total_pos) as n_bad, max(total_neg) as n_good,
       sum(neg * (cum_pos - pos / 2) / (nullif(total_neg, 0) * cast(nullif(total_pos, 0) as double))) as auc,
       case when max(total_pos) > 0 and max(total_neg) > 0
            then greatest(max(cum_pos / nullif(total_pos, 0) - cum_neg / nullif(total_neg, 0)), 0) end as ks,
       case when max(cum_pos / nullif(total_pos, 0) - cum_neg / nullif(total_neg, 0)) > 0
            then greatest(least(max(threshold) filter (where gap = top), 1.0), 0.0) else 1.0 end as ks_cutoff
from (select *, cum_pos / nullif(total_pos, 0) - cum_neg / nullif(total_neg, 0) as gap,
             max(cum_pos / nullif(total_pos, 0) - cum_neg / nullif(total_neg, 0)) over (partition by {keys}) as top from {curve})
group by {keys}""")


curve_part("c_tied", "v_scored", COHORT_SQL, "score_tied")
ranks_part("r_tied", "c_tied", COHORT_SQL)
curve_part("c_cont", "v_scored", "model_slot", "score_cont")
ranks_part("r_cont", "c_cont", "model_slot")
curve_part("c_doc", "v_doc_scored", "lang", "score", "toxic")
ranks_part("r_doc", "c_doc", "lang")


@query("roc_auc", f"""
select model_slot, model_version, cohort_date, cast(n_bad as bigint) as n_bad, cast(n_good as bigint) as n_good,
       round(auc, 6) as auc, round(2 * auc - 1, 6) as gini from r_tied""")
def roc_auc(spark, sf):
    """By slot, version and cohort on a score with heavy ties."""
    ranks = metrics.rank_metrics(view(spark, sf, "v_scored"), COHORT, "score_tied")
    return tidy(ranks.select(*COHORT, "n_bad", "n_good", "auc", "gini"), 6)


@query("roc_auc_continuous", "select model_slot, round(auc, 6) as auc, round(ks, 6) as ks, round(ks_cutoff, 6) as ks_cutoff from r_cont")
def roc_auc_continuous(spark, sf):
    """Two groups holding half of the rows each, with few ties."""
    ranks = metrics.rank_metrics(view(spark, sf, "v_scored"), ["model_slot"], "score_cont")
    return tidy(ranks.select("model_slot", "auc", "ks", "ks_cutoff"), 6)


@query("ks_statistic", f"select {COHORT_SQL}, round(ks, 6) as ks from r_tied")
def ks_statistic(spark, sf):
    return tidy(metrics.rank_metrics(view(spark, sf, "v_scored"), COHORT, "score_tied").select(*COHORT, "ks"), 6)


@query("ks_threshold", "select lang, round(ks, 6) as ks, round(ks_cutoff, 6) as ks_cutoff from r_doc")
def ks_threshold(spark, sf):
    ranks = metrics.rank_metrics(view(spark, sf, "v_doc_scored"), ["lang"], "score", "toxic")
    return tidy(ranks.select("lang", "ks", "ks_cutoff"), 6)


@query("roc_curve", """
select model_slot, round(threshold, 6) as threshold, cast(cum_pos as bigint) as cum_pos, cast(cum_neg as bigint) as cum_neg,
       round(cum_pos / nullif(total_pos, 0), 6) as tpr, round(cum_neg / nullif(total_neg, 0), 6) as fpr from c_cont""")
def roc_curve(spark, sf):
    curve = metrics.roc_curve(view(spark, sf, "v_scored"), ["model_slot"], "score_cont")
    return tidy(curve.select("model_slot", "threshold", "cum_pos", "cum_neg", "tpr", "fpr"), 6)


def cutoff_part(name: str, source: str, keys: str, score: str, threshold: str) -> None:
    part(name, f"""
select *, (tp + tn) / n as accuracy, tp / nullif(tp + fp, 0) as prec, tp / nullif(tp + fn, 0) as rec,
       (fn + tn) / n as approval_rate, fn / nullif(fn + tn, 0) as bad_rate_approved
from (select {keys}, count(*) as n, count(*) filter (where label = 1 and {score} >= {threshold}) as tp,
             count(*) filter (where label = 0 and {score} >= {threshold}) as fp,
             count(*) filter (where label = 1 and {score} < {threshold}) as fn,
             count(*) filter (where label = 0 and {score} < {threshold}) as tn,
             avg(label) as actual, avg({score}) as predicted from {source} group by {keys})""")


cutoff_part("k_cut", "v_scored", COHORT_SQL, "score_tied", "(0.3 + model_version * 0.1)")
CUT_SQL = """round(accuracy, 6) as accuracy, round(prec, 6) as precision, round(rec, 6) as recall,
       round(2 * prec * rec / nullif(prec + rec, 0), 6) as f1, round(approval_rate, 6) as approval_rate,
       round(bad_rate_approved, 6) as bad_rate_approved, round(prec, 6) as bad_rate_declined"""


@query("cutoff_summary", f"select {COHORT_SQL}, n, tp, fp, fn, tn, {CUT_SQL} from k_cut")
def cutoff_summary(spark, sf):
    """A cut-off that differs by row."""
    scored = view(spark, sf, "v_scored").withColumn("cut", F.expr("0.3 + model_version * 0.1"))
    return tidy(metrics.cutoff_summary(scored, COHORT, "score_tied", "label", "cut"), 6)


@query("decision_rule", """
select model_slot, decision, count(*) as n_rows from (
  select model_slot, case when score_tied >= 0.55 then 'decline' else 'approve' end as decision from v_scored) group by 1, 2""")
def decision_rule(spark, sf):
    scored = view(spark, sf, "v_scored").select("model_slot", F.col("score_tied").alias("score"), F.lit(0.55).alias("threshold"))
    return routing.decide(scored).groupBy("model_slot", "decision").agg(F.count("*").alias("n_rows"))


VARIABLES = ["amount", "quantity", "tax", "returned", "constant", "tail"]
SPLIT = date(1998, 7, 1)
REF = ["model_slot", "variable"]

part("f_long", """
select model_slot, model_version, cohort_date, u.variable, cast(u.value as double) as value
from (select model_slot, model_version, cohort_date, [{'variable': 'amount', 'value': cast(amount as double)}, {'variable': 'quantity', 'value': quantity},
             {'variable': 'tax', 'value': tax}, {'variable': 'returned', 'value': returned}, {'variable': 'constant', 'value': constant},
             {'variable': 'tail', 'value': tail}] as l from v_scored_features) t, unnest(t.l) as x(u)""")
part("f_ref", "select * from f_long where cohort_date < date '1998-07-01'")


def edges_parts(prefix: str, source: str, keys: str) -> None:
    part(f"{prefix}_deciles", f"""
select {keys}, list_sort(list_distinct(quantile_cont(value, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) as e
from {source} where value is not null group by {keys}""")
    part(f"{prefix}_mid", f"""
select {keys}, (value + lag(value) over (partition by {keys} order by value)) / 2 as edge from (select distinct {keys}, value from {source}
join {prefix}_deciles using ({keys}) where value is not null and len(e) = 2)""")
    part(f"{prefix}_edges", f"""
select {keys}, edge, row_number() over (partition by {keys} order by edge) as edge_no
from (select {keys}, unnest(e[2:-2]) as edge from {prefix}_deciles where len(e) > 2
      union all select {keys}, edge from {prefix}_mid where edge is not null)""")


def counts_part(name: str, source: str, keys: str, edges: str, edge_keys: str) -> None:
    """Bins by number of edges at or below the value, found by an as-of join."""
    part(name, f"""
select {keys}, cast(bin as bigint) as bin, count(*) as n, count(*) / sum(count(*)) over (partition by {keys}) as proportion
from (select {', '.join('s.' + k.strip() for k in keys.split(','))}, case when s.value is null then -1 else coalesce(e.edge_no, 0) end as bin
      from {source} s asof left join {edges} e on {' and '.join(f's.{k.strip()} = e.{k.strip()}' for k in edge_keys.split(','))} and s.value >= e.edge)
group by {keys}, bin""")


edges_parts("d", "f_ref", "model_slot, variable")
counts_part("d_ref", "f_ref", "model_slot, variable", "d_edges", "model_slot, variable")


def reference_rows(spark, sf):
    return view(spark, sf, "v_scored_features").where(F.col("cohort_date") < F.lit(SPLIT))


def reference_long(spark, sf):
    return drift.melt(reference_rows(spark, sf), ["model_slot"], VARIABLES)


@query("decile_edges", "select model_slot, variable, edge_no, round(edge, 6) as edge from d_edges")
def decile_edges(spark, sf):
    """Deciles, two values, one value, missing values, and a tail whose edges are all neighbouring midpoints."""
    return tidy(drift.decile_edges(reference_long(spark, sf), REF), 6)


@query("bin_proportions", """
select model_slot, variable, bin, coalesce(n, 0) as n, round(coalesce(proportion, 0), 6) as proportion
from (select distinct model_slot, variable, unnest([cast(-1 as bigint), 0]) as bin from d_ref
      union all select model_slot, variable, edge_no from d_edges) left join d_ref using (model_slot, variable, bin)""")
def bin_proportions(spark, sf):
    long = reference_long(spark, sf)
    edges = drift.decile_edges(long, REF)
    shares = drift.proportions(drift.bin_counts(long, edges, REF, REF), REF)
    return tidy(drift.with_empty_bins(shares, edges, REF), 6)


@query("reference_profile", """
select model_slot, variable, cast(sum(n) as bigint) as n_rows, count(*) filter (where bin >= 0) as n_bins,
       round(coalesce(sum(proportion) filter (where bin = -1), 0), 6) as missing_rate, round(max(proportion), 6) as largest
from d_ref group by 1, 2""")
def reference_profile(spark, sf):
    _, shares = monitoring.reference_profile(reference_rows(spark, sf), ["model_slot"], VARIABLES)
    return tidy(shares.groupBy(*REF).agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("bin") >= 0).alias("n_bins"),
        F.coalesce(F.sum(F.when(F.col("bin") < 0, F.col("proportion"))), F.lit(0.0)).alias("missing_rate"),
        F.max("proportion").alias("largest"),
    ), 6)


def psi_part(name: str, actual: str, reference: str, keys: str, ref_keys: str) -> None:
    """Index over the union of the bins, laid out in full."""
    part(name, f"""
select {keys}, sum((a - r) * ln(a / r)) as psi from (
  select {keys}, bin, greatest(sum(a), 1e-4) as a, greatest(sum(r), 1e-4) as r from (
    select {keys}, bin, proportion as a, 0 as r from {actual}
    union all select {keys}, bin, 0 as a, proportion as r from {reference} join (select distinct {keys} from {actual}) using ({ref_keys}))
  group by {keys}, bin) group by {keys}""")


part("f_now", "select * from f_long where cohort_date >= date '1998-07-01'")
counts_part("d_now", "f_now", "model_slot, model_version, cohort_date, variable", "d_edges", "model_slot, variable")
psi_part("d_psi", "d_now", "d_ref", "model_slot, model_version, cohort_date, variable", "model_slot, variable")
_LIGHT = "case when {0} is null then 'info' when {0} > 0.25 then 'red' when {0} > 0.1 then 'amber' else 'green' end"


@query("feature_csi", "select model_slot, model_version, cohort_date, variable, round(psi, 6) as csi, " + _LIGHT.format("psi") + " as status from d_psi")
def feature_csi(spark, sf):
    """Stability index of each feature by version and month against the slot's earlier rows."""
    keys = [*COHORT, "variable"]
    # the table of scored features that a deployment keeps: read several times, rows and not rows times variables
    scored = stored(view(spark, sf, "v_scored_features").select(*COHORT, *VARIABLES), "scored")
    edges, shares = monitoring.reference_profile(scored.where(F.col("cohort_date") < F.lit(SPLIT)), ["model_slot"], VARIABLES)
    now = scored.where(F.col("cohort_date") >= F.lit(SPLIT))
    long = drift.melt(now, COHORT, VARIABLES)
    actual = drift.proportions(drift.bin_counts(long, edges, keys, REF), keys)
    index = drift.psi(actual, shares, keys, REF)
    return tidy(index.select(*keys, F.col("psi").alias("csi"), light.high_is_bad(F.col("psi"), POLICY.psi_lights).alias("status")), 6)


part("p_long", "select model_slot, cohort_date, 'score' as variable, score_cont as value from v_scored")
part("p_ref_rows", "select * from p_long where cohort_date < date '1998-07-01'")
edges_parts("p", "p_ref_rows", "model_slot, variable")
counts_part("p_ref", "p_ref_rows", "model_slot, variable", "p_edges", "model_slot, variable")
counts_part("p_all", "p_long", "model_slot, cohort_date, variable", "p_edges", "model_slot, variable")
psi_part("p_psi", "p_all", "p_ref", "model_slot, cohort_date, variable", "model_slot, variable")


def score_index(spark, sf):
    scored = stored(view(spark, sf, "v_scored").select("model_slot", "cohort_date", F.col("score_cont").alias("score")), "scored")
    reference = scored.where(F.col("cohort_date") < F.lit(SPLIT))
    edges, shares = monitoring.reference_profile(reference, ["model_slot"], ["score"])
    keys = ["model_slot", "cohort_date", "variable"]
    long = drift.melt(scored, ["model_slot", "cohort_date"], ["score"])
    actual = drift.proportions(drift.bin_counts(long, edges, keys, REF), keys)
    return drift.psi(actual, shares, keys, REF).select("model_slot", "cohort_date", "psi")


@query("score_psi", "select model_slot, cohort_date, round(psi, 6) as psi from p_psi")
def score_psi(spark, sf):
    return tidy(score_index(spark, sf), 6)


@query("traffic_light", "select model_slot, " + _LIGHT.format("psi") + " as status, count(*) as n_months from p_psi group by 1, 2")
def traffic_light(spark, sf):
    lit = score_index(spark, sf).select("model_slot", light.high_is_bad(F.col("psi"), POLICY.psi_lights).alias("status"))
    return lit.groupBy("model_slot", "status").agg(F.count("*").alias("n_months"))


@query("missing_rates", """
select model_slot, cohort_date, variable, round(avg(case when value is null then 1 else 0 end), 6) as missing_rate
from f_long group by 1, 2, 3""")
def missing_rates(spark, sf):
    return tidy(metrics.missing_rates(view(spark, sf, "v_scored_features"), ["model_slot", "cohort_date"], VARIABLES), 6)


@query("exact_quantiles", """
select model_slot, model_version, count(*) as n, round(quantile_cont(score_cont, 0.1), 6) as q10, round(quantile_cont(score_cont, 0.5), 6) as q50,
       round(quantile_cont(score_cont, 0.99), 6) as q99 from v_scored group by 1, 2""")
def exact_quantiles(spark, sf):
    from riskmart.operators.ordered import quantiles
    found = quantiles(view(spark, sf, "v_scored"), ["model_slot", "model_version"], "score_cont", [0.1, 0.5, 0.99])
    at = F.col("quantiles")
    return tidy(found.select("model_slot", "model_version", "n", at[0].alias("q10"), at[1].alias("q50"), at[2].alias("q99")), 6)


curve_part("c_slot", "v_scored", "model_slot, model_version", "score_tied")
ranks_part("r_slot", "c_slot", "model_slot, model_version")
cutoff_part("k_slot", "v_scored", "model_slot, model_version", "score_tied", "0.5")


@query("model_card_metrics", f"""
select concat(model_slot, '_', model_version) as version, round(auc, 6) as oot_auc, round(2 * auc - 1, 6) as oot_gini, round(ks, 6) as oot_ks,
       round(ks_cutoff, 6) as decision_threshold, round(actual, 6) as oot_default_rate, round(predicted, 6) as oot_mean_pd, {CUT_SQL}
from r_slot join k_slot using (model_slot, model_version)""")
def model_card_metrics(spark, sf):
    keys = ["model_slot", "model_version"]
    scored = view(spark, sf, "v_scored").withColumnRenamed("score_tied", "score").withColumn("threshold", F.lit(0.5))
    return tidy(card_metrics(scored, keys).select(F.concat_ws("_", *keys).alias("version"), "*").drop(*keys), 6)


def card_metrics(scored, keys):
    """Out-of-time metrics on the card of each version."""
    ranks = metrics.rank_metrics(scored, keys)
    cut = metrics.cutoff_summary(scored, keys, also=[F.avg("label").alias("oot_default_rate"), F.avg("score").alias("oot_mean_pd")])
    return cut.join(ranks, keys).select(
        *keys, F.col("auc").alias("oot_auc"), F.col("gini").alias("oot_gini"), F.col("ks").alias("oot_ks"),
        F.col("ks_cutoff").alias("decision_threshold"), "oot_default_rate", "oot_mean_pd", "accuracy", "precision", "recall",
        "f1", "approval_rate", "bad_rate_approved", "bad_rate_declined",
    )

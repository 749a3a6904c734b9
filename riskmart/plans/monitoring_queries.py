"""Queries on routing, monitoring facts and report tables, from one prediction per loan and slot."""

from __future__ import annotations

import functools
from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from riskmart.config import Policy
from riskmart.operators import monitoring, populations, registry, report, routing, splits
from riskmart.operators.metrics import rank_metrics
from riskmart.plans import metric_queries as mq
from riskmart.plans.catalog import part, query
from riskmart.plans.data_queries import tidy
from riskmart.plans.views import view
from riskmart.sources.tables import stored

GO_LIVE = date(1998, 7, 1)
POLICY = replace(Policy(), go_live=GO_LIVE)
FEATURES = ["amount", "quantity", "tax", "returned"]
VERSION = ["model_slot", "model_version"]


def predictions(spark, sf):
    return view(spark, sf, "v_predictions")


class World:
    """Predictions and labels as the stored tables they are in a running deployment."""

    def __init__(self, spark, sf):
        all_predictions = stored(predictions(spark, sf), "predictions")
        day = F.col("snapshot_date")
        self.live = all_predictions.where(day >= F.lit(GO_LIVE))
        self.before = all_predictions.where(day < F.lit(GO_LIVE))
        self.spark, self.sf = spark, sf

    @functools.cached_property
    def labels(self):
        """Written only where a query reads them."""
        return stored(view(self.spark, self.sf, "v_labels"), "labels")

    def routed(self):
        return routing.route(self.live)

    def matured(self):
        return populations.matured_cohort(self.live, self.labels, 6, GO_LIVE)

    def matured_routed(self):
        return stored(populations.matured_cohort(stored(self.routed(), "production"), self.labels, 6, GO_LIVE), "matured")

    def matured_before(self):
        return populations.matured_cohort(self.before, self.labels)

    def oot(self):
        """Out-of-time AUC of each version: on the months before go-live."""
        ranks = rank_metrics(self.matured_before(), VERSION)
        return stored(ranks.select(*VERSION, F.col("auc").alias("oot_auc")), "oot")

    def slot_stability(self):
        edges, shares = monitoring.reference_profile(self.before, VERSION, ["score", *FEATURES])
        base = monitoring.score_volume(self.before, VERSION)
        return monitoring.stability_by_slot(self.live, base, edges, shares, FEATURES, POLICY)

    def production_stability(self):
        return monitoring.stability_production(self.routed(), POLICY)

    def slot_performance(self, oot=None):
        return monitoring.performance_by_slot(stored(self.matured(), "matured"), oot or self.oot(), POLICY)

    def production_performance(self, oot=None):
        return monitoring.performance_of_production(self.matured_routed(), oot or self.oot(), POLICY)

    def performance(self):
        oot = self.oot()
        return self.slot_performance(oot).unionByName(self.production_performance(oot))

    def facts(self):
        """All monitoring facts, stored as the monitoring table is."""
        stability = self.slot_stability().unionByName(self.production_stability())
        return stored(stability.unionByName(self.performance()), "facts")


# --- the same in SQL ----------------------------------------------------------------------------------------

part("w_live", "select * from v_predictions where snapshot_date >= date '1998-07-01'")
part("w_before", "select * from v_predictions where snapshot_date < date '1998-07-01'")
part("w_routed", """
select * exclude (model_slot), model_slot as routed_to, 'production' as model_slot from w_live p
where model_slot = 'model_1' or not exists (select 1 from w_live q where q.model_slot = 'model_1' and q.loan_id = p.loan_id
                                            and q.snapshot_date = p.snapshot_date)""")
_MATURED = """
select p.*, l.label, l.snapshot_date as label_date from {0} p join v_labels l on l.loan_id = p.loan_id
and l.snapshot_date = cast(p.snapshot_date + interval 6 month as date)"""
part("w_matured", _MATURED.format("w_live"))
part("w_matured_before", _MATURED.format("w_before"))
part("w_matured_routed", "select * replace ('routed' as model_version), model_version as by_version from (" + _MATURED.format("w_routed") + ")")
mq.curve_part("w_oot_curve", "w_matured_before", "model_slot, model_version", "score")
mq.ranks_part("w_oot", "w_oot_curve", "model_slot, model_version")

_KEYS = "model_slot, model_version, snapshot_date"
for _name, _source in (("w_slot", "w_matured"), ("w_prod", "w_matured_routed")):
    mq.curve_part(f"{_name}_curve", _source, _KEYS, "score")
    mq.ranks_part(f"{_name}_ranks", f"{_name}_curve", _KEYS)
    mq.cutoff_part(f"{_name}_cut", _source, _KEYS, "score", "threshold")
part("w_slot_expected", f"select distinct {_KEYS}, auc as ref_auc from w_matured left join w_oot using (model_slot, model_version)")
part("w_prod_expected", """
select p.model_slot, p.model_version, p.snapshot_date, avg(o.auc) as ref_auc from w_matured_routed p
left join w_oot o on o.model_slot = p.routed_to and o.model_version = p.by_version group by 1, 2, 3""")


def _light(value: str, amber: float, red: float) -> str:
    return f"case when {value} is null then 'info' when {value} > {red} then 'red' when {value} > {amber} then 'amber' else 'green' end"


def _fact(metric: str, value: str, reference: str = "null", status: str = "'info'") -> str:
    return (f"{{'metric': {metric}, 'value': cast({value} as double), 'reference_value': cast({reference} as double), 'status': {status}}}")


def _long(name: str, source: str, group: str, monitored: str, facts: list[str]) -> None:
    part(name, f"""
select {monitored} as monitoring_date, model_slot, model_version, snapshot_date as cohort_date, '{group}' as metric_group,
       u.metric, u.value, u.reference_value, u.status from (select *, [{', '.join(facts)}] as l from {source}) t, unnest(t.l) as x(u)""")


for _name in ("w_slot", "w_prod"):
    part(f"{_name}_all", f"""
select c.*, r.auc, r.ks, e.ref_auc from {_name}_cut c left join {_name}_ranks r using ({_KEYS}) left join {_name}_expected e using ({_KEYS})""")
    _long(f"{_name}_perf", f"{_name}_all", "performance", "cast(snapshot_date + interval 6 month as date)", [
        _fact("'n_labelled'", "n"), _fact("'actual_default_rate'", "actual"), _fact("'mean_predicted_pd'", "predicted"),
        _fact("'calibration_gap'", "abs(predicted - actual)", "null", _light("abs(predicted - actual)", 0.05, 0.10)),
        _fact("'auc'", "auc", "ref_auc", _light("(ref_auc - auc)", 0.03, 0.05)),
        _fact("'gini'", "2 * auc - 1", "2 * ref_auc - 1"), _fact("'ks'", "ks"), _fact("'accuracy'", "accuracy"), _fact("'precision'", "prec"),
        _fact("'recall'", "rec"), _fact("'f1'", "2 * prec * rec / nullif(prec + rec, 0)"), _fact("'approval_rate'", "approval_rate"),
        _fact("'bad_rate_approved'", "bad_rate_approved"), _fact("'bad_rate_declined'", "prec"),
    ])

part("w_volume", """
select l.*, b.mean_score as ref_score, b.approval_rate as ref_rate from
 (select model_slot, model_version, snapshot_date, count(*) as n_scored, avg(score) as mean_score,
         avg(case when decision = 'approve' then 1 else 0 end) as approval_rate from w_live group by 1, 2, 3) l
left join (select model_slot, model_version, avg(score) as mean_score, avg(case when decision = 'approve' then 1 else 0 end) as approval_rate
           from w_before group by 1, 2) b using (model_slot, model_version)""")
_long("w_volume_facts", "w_volume", "stability", "snapshot_date", [
    _fact("'n_scored'", "n_scored"), _fact("'mean_score'", "mean_score", "ref_score"), _fact("'approval_rate'", "approval_rate", "ref_rate"),
])
_MELT = "[" + ", ".join(f"{{'variable': '{v}', 'value': cast({v} as double)}}" for v in ["score", *FEATURES]) + "]"
for _name, _source in (("w_long", "w_live"), ("w_ref_long", "w_before")):
    part(_name, f"""
select model_slot, model_version, snapshot_date, u.variable, u.value
from (select model_slot, model_version, snapshot_date, {_MELT} as l from {_source}) t, unnest(t.l) as x(u)""")
_VKEYS = "model_slot, model_version, variable"
mq.edges_parts("w", "w_ref_long", _VKEYS)
mq.counts_part("w_ref_bins", "w_ref_long", _VKEYS, "w_edges", _VKEYS)
mq.counts_part("w_now_bins", "w_long", "model_slot, model_version, snapshot_date, variable", "w_edges", _VKEYS)
mq.psi_part("w_psi", "w_now_bins", "w_ref_bins", "model_slot, model_version, snapshot_date, variable", _VKEYS)
part("w_shift", """
select p.*, coalesce(n.proportion, 0) as missing_rate, coalesce(r.proportion, 0) as ref_missing from w_psi p
left join (select * from w_now_bins where bin = -1) n using (model_slot, model_version, snapshot_date, variable)
left join (select * from w_ref_bins where bin = -1) r using (model_slot, model_version, variable)""")
_long("w_shift_facts", "w_shift", "stability", "snapshot_date", [
    _fact("case when variable = 'score' then 'psi_score' else concat('csi__', variable) end", "psi", "null", _light("psi", 0.10, 0.25)),
    _fact("case when variable <> 'score' then concat('missing__', variable) end", "missing_rate", "ref_missing",
          "case when missing_rate - ref_missing > 0.2 then 'red' else 'green' end"),
])
part("w_slot_stability", "select * from w_volume_facts union all select * from w_shift_facts where metric is not null")
part("w_monthly", """
select 'production' as model_slot, 'routed' as model_version, *, (select avg(has_clickstream) from w_routed where snapshot_date = date '1998-07-01') as base
from (select snapshot_date, count(*) as n, avg(case when routed_to = 'model_1' then 1 else 0 end) as share, avg(score) as mean_score,
             avg(case when decision = 'approve' then 1 else 0 end) as approval_rate, avg(has_clickstream) as coverage from w_routed group by 1)""")
_long("w_prod_stability", "w_monthly", "stability", "snapshot_date", [
    _fact("'n_scored'", "n"), _fact("'share_routed_model_1'", "share"), _fact("'share_routed_model_2'", "1 - share"),
    _fact("'mean_score'", "mean_score"), _fact("'approval_rate'", "approval_rate"),
    _fact("'clickstream_coverage'", "coverage", "base", "case when base - coverage > 0.2 then 'red' else 'green' end"),
])
part("w_facts", "select * from w_slot_stability union all select * from w_prod_stability union all select * from w_slot_perf union all select * from w_prod_perf")

_FACT = """monitoring_date, model_slot, model_version, cohort_date, metric_group, metric, round(value, 6) as value,
round(reference_value, 6) as reference_value, status"""


@query("matured_cohort", "select loan_id, model_slot, snapshot_date, label_date, label, round(score, 6) as score from w_matured")
def matured_cohort(spark, sf):
    found = World(spark, sf).matured()
    return tidy(found.select("loan_id", "model_slot", "snapshot_date", "label_date", "label", "score"), 6)


@query("production_routing", """
select loan_id, snapshot_date, model_slot, routed_to, model_version, has_clickstream, round(score, 6) as score, decision from w_routed""")
def production_routing(spark, sf):
    routed = World(spark, sf).routed()
    return tidy(routed.select(
        "loan_id", "snapshot_date", "model_slot", "routed_to", "model_version", "has_clickstream", "score", "decision"
    ), 6)


@query("dq_routed_once", "select count(*) as n_loans, cast(0 as bigint) as n_repeated from (select distinct loan_id, snapshot_date from w_routed)")
def dq_routed_once(spark, sf):
    return routing.routed_twice(World(spark, sf).routed())


@query("feature_lookup", """
select routed_to, snapshot_date, count(*) as n_rows, round(sum(round(f.price, 2)), 2) as amount from w_routed p
join (select loan_id, price from (select loan_id, amount as price from v_loans)) f using (loan_id) group by 1, 2""")
def feature_lookup(spark, sf):
    """Feature values of the routed decisions."""
    store = view(spark, sf, "v_loans").withColumnRenamed("amount", "price")
    routed = World(spark, sf).routed()
    found = populations.with_features(routed, store, ["price"])
    return tidy(found.groupBy("routed_to", "snapshot_date").agg(
        F.count("*").alias("n_rows"), F.sum(F.round("price", 2)).alias("amount")
    ), 2)


@query("stability_slot", f"select {_FACT} from w_slot_stability")
def stability_slot(spark, sf):
    return tidy(World(spark, sf).slot_stability(), 6)


@query("stability_production", f"select {_FACT} from w_prod_stability")
def stability_production(spark, sf):
    return tidy(World(spark, sf).production_stability(), 6)


@query("performance_metrics", f"select {_FACT} from w_slot_perf union all select {_FACT} from w_prod_perf")
def performance_metrics(spark, sf):
    return tidy(World(spark, sf).performance(), 6)


@query("expected_auc", "select snapshot_date, round(ref_auc, 6) as ref_auc from w_prod_expected")
def expected_auc(spark, sf):
    world = World(spark, sf)
    return tidy(monitoring.expected_auc(world.matured_routed(), world.oot(), ["snapshot_date"]), 6)


@query("monitoring_pivot", """
select cohort_date, round(avg(value) filter (where model_slot = 'model_1'), 6) as model_1,
       round(avg(value) filter (where model_slot = 'model_2'), 6) as model_2,
       round(avg(value) filter (where model_slot = 'production'), 6) as production
from (select * from w_volume_facts union all select * from w_prod_stability) where metric = 'mean_score' group by 1""")
def monitoring_pivot(spark, sf):
    world = World(spark, sf)
    facts = world.slot_stability().unionByName(world.production_stability())
    return tidy(report.by_slot(facts, "stability", "mean_score"), 6)


@query("red_alerts", f"select {_FACT} from w_facts where status = 'red' and metric in ('auc', 'calibration_gap', 'psi_score')")
def red_alerts(spark, sf):
    return tidy(registry.red_alerts(World(spark, sf).facts()).select(*monitoring.FACT), 6)


@query("alert_list", """
select monitoring_date, model_slot, model_version, cohort_date, metric, round(value, 6) as value,
       round(reference_value, 6) as reference_value, status
from w_facts where status in ('red', 'amber') and monitoring_date <= date '2001-03-01'""")
def alert_list(spark, sf):
    return tidy(report.alerts(report.as_of(World(spark, sf).facts(), "2001-03-01")), 6)


@query("outage_start", "select min(cohort_date) as outage_start from w_prod_stability where metric = 'clickstream_coverage' and status = 'red'")
def outage_start(spark, sf):
    return report.outage_start(World(spark, sf).production_stability())


@query("report_auc", """
select cohort_date, round(avg(value) filter (where model_slot = 'model_1'), 6) as model_1,
       round(avg(value) filter (where model_slot = 'model_2'), 6) as model_2,
       round(max(reference_value) filter (where model_slot = 'production') - 0.05, 6) as alert_line
from (select * from w_slot_perf union all select * from w_prod_perf) where metric = 'auc' group by 1""")
def report_auc(spark, sf):
    facts = stored(World(spark, sf).performance(), "facts")
    return tidy(report.auc_by_month(facts, POLICY), 6)


@query("report_psi", """
select cohort_date, round(avg(value) filter (where model_slot = 'model_1'), 6) as model_1,
       round(avg(value) filter (where model_slot = 'model_2'), 6) as model_2
from w_shift_facts where metric = 'psi_score' group by 1""")
def report_psi(spark, sf):
    return tidy(report.psi_by_month(World(spark, sf).slot_stability()), 6)


def _wide(source: str, metrics: list[str]) -> str:
    cells = ", ".join(f"avg(value) filter (where metric = '{m}') as {m}" for m in metrics)
    listed = ", ".join(f"'{m}'" for m in metrics)
    return f"select cohort_date, {cells} from {source} where metric in ({listed}) group by 1"


@query("report_calibration", f"""
select cohort_date, round(actual_default_rate, 6) as actual_default_rate, round(mean_predicted_pd, 6) as mean_predicted_pd,
       round(max(abs(mean_predicted_pd - actual_default_rate)) over (), 6) as largest_gap
from ({_wide('w_prod_perf', ['actual_default_rate', 'mean_predicted_pd'])})""")
def report_calibration(spark, sf):
    return tidy(report.calibration(stored(World(spark, sf).production_performance(), "facts")), 6)


@query("report_routing", f"""
select cohort_date, cast(round_even(n_scored * share_routed_model_1, 0) as bigint) as n_model_1,
       cast(n_scored - round_even(n_scored * share_routed_model_1, 0) as bigint) as n_model_2
from ({_wide('w_prod_stability', ['n_scored', 'share_routed_model_1'])})""")
def report_routing(spark, sf):
    return report.routing(World(spark, sf).production_stability())


@query("report_business", f"""
select cohort_date, round(approval_rate, 6) as approval_rate, round(actual_default_rate, 6) as actual_default_rate,
       round(bad_rate_approved, 6) as bad_rate_approved, round(avg(bad_rate_approved) over (), 6) as mean_bad_rate_approved,
       round(avg(actual_default_rate) over (), 6) as mean_default_rate
from ({_wide('w_prod_perf', ['approval_rate', 'actual_default_rate', 'bad_rate_approved'])})""")
def report_business(spark, sf):
    return tidy(report.business(stored(World(spark, sf).production_performance(), "facts")), 6)


_TABLE = ["n_labelled", "auc", "gini", "ks", "actual_default_rate", "mean_predicted_pd", "approval_rate", "bad_rate_approved", "bad_rate_declined"]


@query("report_production", f"select cohort_date, {', '.join(f'round({m}, 6) as {m}' for m in _TABLE)} from ({_wide('w_prod_perf', _TABLE)})")
def report_production(spark, sf):
    return tidy(report.production_table(World(spark, sf).production_performance()), 6)


part("w_csi", """
select model_slot, replace(metric, 'csi__', '') as feature, cohort_date, value from w_shift_facts where starts_with(metric, 'csi__')""")
part("w_csi_rank", """
select *, row_number() over (partition by model_slot order by latest desc nulls last, feature) as position
from (select c.model_slot, feature, max(value) filter (where cohort_date = newest) as latest
      from w_csi c join (select model_slot, max(cohort_date) as newest from w_csi group by 1) n using (model_slot) group by 1, 2)""")


@query("csi_matrix", """
select c.model_slot, c.feature, cast(r.position as int) as position, cohort_date, round(avg(c.value), 6) as csi
from w_csi c join w_csi_rank r using (model_slot, feature) where r.position <= 10 group by 1, 2, 3, 4""")
def csi_matrix(spark, sf):
    return tidy(report.csi_matrix(stored(World(spark, sf).slot_stability(), "facts"), POLICY.top_features_monitored), 6)


part("w_corr", "select model_slot, model_version, " + ", ".join(f"round(abs(corr({f}, label)), 6) as {f}" for f in FEATURES)
     + " from w_matured_before group by 1, 2")


@query("top_features", """
select model_slot, model_version, feature, importance, cast(rank as int) as rank from (
  select *, row_number() over (partition by model_slot, model_version order by importance desc, feature) as rank
  from (unpivot w_corr on amount, quantity, tax into name feature value importance) where feature <> 'returned') where rank <= 10""")
def top_features(spark, sf):
    """Most important features per version; importance here is the correlation with the label."""
    known = World(spark, sf).matured_before()
    strength = known.groupBy(*VERSION).agg(*[F.round(F.abs(F.corr(f, "label")), 6).alias(f) for f in FEATURES])
    return splits.top_features(strength.unpivot(VERSION, FEATURES, "feature", "importance"), VERSION, POLICY.top_features_monitored, ["returned"])


@query("latest_periods", "select snapshot_date, count(*) as n_rows from v_predictions where snapshot_date in (select distinct snapshot_date from v_predictions order by 1 desc limit 5) group by 1")
def latest_periods(spark, sf):
    return splits.latest_periods(predictions(spark, sf), 5).groupBy("snapshot_date").agg(F.count("*").alias("n_rows"))

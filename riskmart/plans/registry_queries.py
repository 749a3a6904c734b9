"""Queries on the version history, drawn from the scored rows: a run every second month and slot."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from riskmart.functions import status as light
from riskmart.functions.dates import whole_months
from riskmart.operators import metrics, populations, registry
from riskmart.plans import metric_queries as mq
from riskmart.plans.catalog import part, query
from riskmart.plans.data_queries import TEST_POLICY, tidy
from riskmart.plans.views import view
from riskmart.session import run_folder
from riskmart.sources import cards

FIRST = "date '1995-01-01'"

# the run of a month is scored as one of the seven line numbers, in turn
part("e_runs", f"""
select slot, trained_on, concat(slot, '_', strftime(trained_on, '%Y_%m_%d')) as version,
       1 + (date_diff('month', {FIRST}, trained_on) // 2) % 7 as k,
       row_number() over (partition by slot order by trained_on) as i
from (select distinct model_slot as slot, cohort_date as trained_on from v_scored)
where date_diff('month', {FIRST}, trained_on) % 2 = 0""")
part("e_evals", """
select t.slot, t.trained_on, t.version, s.version as scored_version, round(r.auc, 9) as auc
from e_runs t join e_runs s on s.slot = t.slot and s.trained_on <= t.trained_on
join r_tied r on r.model_slot = t.slot and r.cohort_date = t.trained_on and r.model_version = s.k""")
part("e_fold", """
select slot, i, trained_on, version, version as champion, (select auc from e_evals e where e.slot = e_runs.slot and e.trained_on = e_runs.trained_on
         and e.scored_version = e_runs.version) as challenger_auc, cast(null as varchar) as champion_version,
       cast(null as double) as champion_auc, true as promoted
from e_runs where i = 1
union all
select r.slot, r.i, r.trained_on, r.version, case when coalesce(own.auc >= champ.auc, false) then r.version else f.champion end,
       own.auc, f.champion, champ.auc, coalesce(own.auc >= champ.auc, false)
from e_fold f join e_runs r on r.slot = f.slot and r.i = f.i + 1
left join e_evals own on own.slot = r.slot and own.trained_on = r.trained_on and own.scored_version = r.version
left join e_evals champ on champ.slot = r.slot and champ.trained_on = r.trained_on and champ.scored_version = f.champion""")
part("e_registry", """
select slot, trained_on, version, challenger_auc, champion_version, champion_auc, promoted,
       case when promoted then trained_on end as promoted_at, case when promoted then nxt end as retired_at,
       case when not promoted then 'rejected' when nxt is null then 'champion' else 'retired' end as status
from (select *, min(case when promoted then trained_on end) over (partition by slot order by trained_on rows between 1 following and unbounded following) as nxt
      from e_fold)""")


def runs(spark, sf):
    month = F.col("trained_on")
    since = whole_months(F.lit("1995-01-01").cast("date"), month)
    months = view(spark, sf, "v_scored").select(F.col("model_slot").alias("slot"), F.col("cohort_date").alias("trained_on")).distinct()
    return months.where(since % 2 == 0).select(
        "slot", "trained_on", registry.version_name(F.col("slot"), month).alias("version"),
        (1 + F.floor(since / 2) % 7).cast("int").alias("k"),
    )


def evaluations(spark, sf):
    """AUC of every version so far on each run's month; the join is between run calendars only."""
    aucs = metrics.rank_metrics(view(spark, sf, "v_scored"), mq.COHORT, "score_tied").select(
        F.col("model_slot").alias("slot"), F.col("cohort_date").alias("trained_on"), F.col("model_version").alias("k"),
        F.round("auc", 9).alias("auc"),
    )
    now = runs(spark, sf)
    scored = now.select("slot", "k", F.col("version").alias("scored_version"), F.col("trained_on").alias("_since"))
    seen = aucs.join(scored, ["slot", "k"]).where(F.col("_since") <= F.col("trained_on"))
    return now.drop("k").join(seen, ["slot", "trained_on"]).select("slot", "trained_on", "version", "scored_version", "auc")


def decisions(spark, sf):
    return registry.promotions(evaluations(spark, sf), TEST_POLICY.promotion_tolerance)


def versions(spark, sf):
    return registry.intervals(decisions(spark, sf))


_AUCS = "round(challenger_auc, 6) as challenger_auc, champion_version, round(champion_auc, 6) as champion_auc, promoted"


@query("promotion_gate", f"select slot, trained_on, version, {_AUCS} from e_fold")
def promotion_gate(spark, sf):
    return tidy(decisions(spark, sf), 6)


@query("registry_intervals", f"select slot, trained_on, version, {_AUCS}, promoted_at, retired_at, status from e_registry")
def registry_intervals(spark, sf):
    return tidy(versions(spark, sf), 6)


@query("registry_events", """
select trained_on as date, slot, case when promoted then 'promoted' else 'rejected' end as event, version,
       case when champion_version is null then concat('first deployment; OOT AUC ', format('{:.3f}', challenger_auc))
            else concat('challenger ', version, ' AUC ', format('{:.3f}', challenger_auc), ' vs champion ', champion_version, ' AUC ',
                        format('{:.3f}', champion_auc)) end as detail
from e_fold""")
def registry_events(spark, sf):
    return registry.events(decisions(spark, sf))


@query("registry_upsert", """
select slot, version, trained_on, case when trained_on < date '1997-06-01' then 'first' else 'again' end as source from e_registry""")
def registry_upsert(spark, sf):
    """Runs before 1998, then all runs from June 1997 on written over them."""
    rows = versions(spark, sf).select("slot", "version", "trained_on")
    first = rows.where("trained_on < date '1998-01-01'").withColumn("source", F.lit("first"))
    again = rows.where("trained_on >= date '1997-06-01'").withColumn("source", F.lit("again"))
    return registry.upsert(first, again, ["slot", "version"])


def moments(spark, sf):
    return view(spark, sf, "v_scored").select(F.col("model_slot").alias("slot"), "cohort_date").distinct()


@query("champion_at", """
select m.slot, m.cohort_date, r.version from (select distinct model_slot as slot, cohort_date from v_scored) m
join e_registry r on r.slot = m.slot and r.promoted_at <= m.cohort_date and (r.retired_at is null or r.retired_at > m.cohort_date)""")
def champion_at(spark, sf):
    return populations.live_versions(moments(spark, sf), versions(spark, sf), "cohort_date")


@query("champion_before", """
select m.slot, m.cohort_date, r.version from (select distinct model_slot as slot, cohort_date from v_scored) m
join e_registry r on r.slot = m.slot and r.promoted_at < m.cohort_date and (r.retired_at is null or r.retired_at >= m.cohort_date)""")
def champion_before(spark, sf):
    return populations.live_versions(moments(spark, sf), versions(spark, sf), "cohort_date", strictly_before=True)


@query("version_timeline", """
select slot, version, round(challenger_auc, 6) as oot_auc, promoted_at as start, case when promoted then coalesce(retired_at, date '2001-12-01') end as stop,
       case when promoted then cast(date_diff('day', promoted_at, coalesce(retired_at, date '2001-12-01')) as int) end as days_live,
       case when not promoted then trained_on end as rejected_on
from e_registry""")
def version_timeline(spark, sf):
    return tidy(registry.timeline(versions(spark, sf), "2001-12-01"), 6)


part("e_months", "select distinct model_slot as slot, cohort_date as run_month from v_scored")
part("e_trained", """
select slot, version, trained_on, cast(trained_on - to_months(case when month(trained_on) = 3 then 0 else 8 end) as date) as data_end
from e_runs""")
part("e_newest", """
select m.slot, m.run_month, max(c.run_month) as newest from e_months m
join e_months c on c.slot = m.slot and c.run_month <= cast(m.run_month - interval 6 month as date) group by 1, 2""")
part("e_alerts", "select model_slot as slot, cohort_date as monitoring_date, 'psi_score' as metric, psi as value from p_psi where psi > 0.02")
part("e_last", """
select m.slot, m.run_month, max(t.trained_on) as trained_on, arg_max(t.version, t.trained_on) as last_version,
       arg_max(t.data_end, t.trained_on) as data_end
from e_months m left join e_trained t on t.slot = m.slot and t.trained_on < m.run_month group by 1, 2""")
part("e_hit", """
select l.slot, l.run_month, arg_max(a.metric, a.monitoring_date) as alert_metric, max(a.monitoring_date) as alert_date,
       arg_max(a.value, struct_pack(d := a.monitoring_date, v := a.value)) as alert_value
from e_last l join e_alerts a on a.slot = l.slot and a.monitoring_date > l.trained_on and a.monitoring_date < l.run_month group by 1, 2""")


#: Go-live is the calendar's own start, so that the first month has no run before it.
RETRAIN_POLICY = replace(TEST_POLICY, go_live=date(1995, 1, 1))


@query("retrain_decision", f"""
select slot, run_month, cast(split_part(reason, ' ', 1) in ('first', 'scheduled', 'red') as int) as retrain, reason, last_version, newest, alert_metric, alert_date
from (select *, case when run_month > date '{RETRAIN_POLICY.feature_end}' then 'no new applications to score after {RETRAIN_POLICY.feature_end}'
        when last_version is null then 'first deployment (go-live)'
        when newest is null or newest <= data_end then concat('no new labelled applications since ', last_version, ' (newest month ', coalesce(cast(newest as varchar), 'none'), ')')
        when run_month <= date '2001-06-01' and date_diff('month', date '1995-01-01', run_month) % 2 = 0 then 'scheduled retrain (every 2 months from go-live)'
        when alert_date is not null then concat('red alert: ', alert_metric, '=', format('{{:.3f}}', alert_value), ' on ', alert_date)
        else concat('not a scheduled month and no red alerts since ', trained_on) end as reason
      from e_last left join e_newest using (slot, run_month) left join e_hit using (slot, run_month))""")
def retrain_decision(spark, sf):
    """Run calendar against trained versions, labelled months and red alerts (a tight alert limit)."""
    months = moments(spark, sf).withColumnRenamed("cohort_date", "run_month")
    trained = runs(spark, sf).select(
        "slot", "version", "trained_on", F.expr("add_months(trained_on, case when month(trained_on) = 3 then 0 else -8 end)").alias("data_end")
    )
    known = months.select("slot", F.col("run_month").alias("_month"))
    newest = months.join(known, "slot").where(F.col("_month") <= F.add_months("run_month", -6)).groupBy("slot", "run_month").agg(
        F.max("_month").alias("newest")
    )
    facts = mq.score_index(spark, sf).select(
        F.col("model_slot").alias("slot"), F.col("cohort_date").alias("monitoring_date"), F.lit("psi_score").alias("metric"),
        F.col("psi").alias("value"), light.high_is_bad(F.col("psi"), (0.01, 0.02)).alias("status"),
    )
    return registry.retrain_decisions(months, trained, newest, registry.red_alerts(facts), RETRAIN_POLICY)


part("a_rows", """
select model_slot, cohort_date, case when model_version % 2 = 0 then 'logistic_regression' else 'boosted_trees' end as algorithm, score_tied, label from v_scored""")
mq.curve_part("a_curve", "a_rows", "model_slot, cohort_date, algorithm", "score_tied")
mq.ranks_part("a_ranks", "a_curve", "model_slot, cohort_date, algorithm")


@query("algorithm_choice", """
select model_slot, cohort_date, case when top - plain <= 0.02 then 'logistic_regression' else best end as algorithm,
       round(case when top - plain <= 0.02 then plain else top end, 6) as test_auc
from (select model_slot, cohort_date, max(auc) as top, arg_max(algorithm, auc) as best,
             max(case when algorithm = 'logistic_regression' then auc end) as plain from a_ranks group by 1, 2)""")
def algorithm_choice(spark, sf):
    keys = ["model_slot", "cohort_date"]
    plain = F.when(F.col("model_version") % 2 == 0, "logistic_regression").otherwise("boosted_trees")
    ranks = metrics.rank_metrics(view(spark, sf, "v_scored").withColumn("algorithm", plain), [*keys, "algorithm"], "score_tied")
    results = ranks.select(*keys, "algorithm", F.col("auc").alias("test_auc"))
    return tidy(registry.better_algorithm(results, keys, "logistic_regression", 0.02), 6)


_CARD = ["oot_auc", "oot_gini", "oot_ks", "oot_default_rate", "oot_mean_pd"]


@query("card_flatten", """
select concat(model_slot, '_', model_version) as version, model_slot as slot, 'logistic_regression' as algorithm, date '2001-12-01' as trained_on,
       0.5 as decision_threshold, u.metric, round(u.value, 6) as value
from (select model_slot, model_version, [{'metric': 'oot_auc', 'value': auc}, {'metric': 'oot_gini', 'value': 2 * auc - 1}, {'metric': 'oot_ks', 'value': ks},
             {'metric': 'oot_default_rate', 'value': actual}, {'metric': 'oot_mean_pd', 'value': predicted}] as l
      from r_slot join k_slot using (model_slot, model_version)) t, unnest(t.l) as x(u)""".replace("0.5 as decision", "cast(0.5 as double) as decision"))
def card_flatten(spark, sf):
    """Cards of all versions written as JSON, written again, read back and flattened."""
    keys = ["model_slot", "model_version"]
    scored = view(spark, sf, "v_scored").withColumnRenamed("score_tied", "score").withColumn("threshold", F.lit(0.5))
    names = [F.lit(x) if i == 0 else F.col(x) for c in _CARD for i, x in enumerate((c, c))]
    made = mq.card_metrics(scored, keys).select(
        F.concat_ws("_", *keys).alias("version"), F.col("model_slot").alias("slot"), F.lit("logistic_regression").alias("algorithm"),
        F.lit("2001-12-01").cast("date").alias("trained_on"), F.lit(0.5).alias("decision_threshold"),
        F.create_map(*names).alias("metrics"),
    )
    path = run_folder(spark, "cards")
    cards.write_cards(made, path)
    cards.write_cards(made, path)
    return tidy(cards.flatten_metrics(cards.read_cards(spark, path)), 6)

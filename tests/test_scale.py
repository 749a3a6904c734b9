"""The spread forms of joins, running totals, quantiles and bins against brute force, with hot keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskmart import config as C
from riskmart.operators import drift, joins, metrics, ordered
from riskmart.operators.joins import spread_join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the left rows hold key 7; identical copies among them; some null keys; a repeated right key."""
    left = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 900).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"))
    right = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).union(
        spark.createDataFrame([(7, -1)], "k long, w long"))
    return left, right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join(skewed, how):
    left, right = skewed
    assert len(joins.heavy_keys(left, ["k"], 8, 0)) == 1
    got = spread_join(left, right, ["k"], how, floor=0)
    want = left.join(right, ["k"], how)
    assert "_salt" not in got.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_salts_spread_the_hot_key(skewed):
    left, _ = skewed
    hashes = joins.heavy_keys(left, ["k"], 8, 0)
    salts = joins.salted(left, ["k"], hashes, 8).where("k = 7").groupBy("_salt").count()
    assert salts.count() > 1 and salts.agg(F.max("count")).first()[0] < 2000


def scores(n=4000, seed=1):
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({"g": np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abc"), n)), "score": np.round(rng.random(n) ** 3, 3)})
    df["label"] = (rng.random(n) < 0.2 + 0.5 * df.score).astype(int)
    return df


def brute_auc(d):
    bad, good = d[d.label == 1].score.values, d[d.label == 0].score.values
    return ((bad[:, None] > good).sum() + 0.5 * (bad[:, None] == good).sum()) / (len(bad) * len(good))


@pytest.mark.parametrize("ranges", [2, 7, 200])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, ranges, descending):
    pdf = scores()
    runs = ordered.running_totals(spark.createDataFrame(pdf), ["g"], "score", ["label"], descending, ranges).toPandas()
    cells = pdf.groupby(["g", "score"]).label.sum().reset_index().sort_values(["g", "score"], ascending=[True, not descending])
    cells["cum"] = cells.groupby("g").label.cumsum()
    cells["place"] = cells.groupby("g").cumcount() + 1
    cells["prev"] = cells.groupby("g").score.shift()
    m = cells.merge(runs, on=["g", "score"], suffixes=("", "_s"))
    assert len(m) == len(cells) == len(runs)
    assert (m.cum == m.cum_label).all() and (m.place == m.place_s).all()
    assert ((m.prev == m.prev_score) | (m.prev.isna() & m.prev_score.isna())).all()
    assert (m.total_label == m.groupby("g").label.transform("sum")).all()


def test_auc_against_all_pairs(spark):
    pdf = scores()
    df = spark.createDataFrame(pdf)
    got = {r["g"]: r for r in metrics.rank_metrics(df, ["g"]).collect()}
    flipped = {r["g"]: r["auc"] for r in metrics.rank_metrics(df.withColumn("score", -F.col("score")), ["g"]).collect()}
    for g, d in pdf.groupby("g"):
        assert got[g]["auc"] == pytest.approx(brute_auc(d), abs=1e-12)
        assert flipped[g] == pytest.approx(1 - got[g]["auc"], abs=1e-12)
        cuts = np.sort(d.score.unique())[::-1]
        gaps = [((d.score >= t) & (d.label == 1)).sum() / d.label.sum() - ((d.score >= t) & (d.label == 0)).sum() / (1 - d.label).sum() for t in cuts]
        assert got[g]["ks"] == pytest.approx(max(gaps), abs=1e-12)
        assert got[g]["ks_cutoff"] == pytest.approx(cuts[int(np.argmax(gaps))])


def test_quantiles(spark):
    pdf = scores()
    fractions = [0, 0.01, 0.25, 0.5, 0.9, 1]
    got = {r["g"]: r["quantiles"] for r in ordered.quantiles(spark.createDataFrame(pdf), ["g"], "score", fractions, 13).collect()}
    for g, d in pdf.groupby("g"):
        assert got[g] == pytest.approx(list(np.quantile(d.score, fractions)), abs=1e-12)


def brute_edges(v):
    v = v[~np.isnan(v)]
    e = np.unique(np.quantile(v, np.linspace(0, 1, 11))) if len(v) else np.array([])
    if len(e) <= 2:
        u = np.unique(v)
        return (u[:-1] + u[1:]) / 2
    return e[1:-1]


def brute_shares(v, edges):
    b = np.where(np.isnan(v), -1, np.searchsorted(edges, np.nan_to_num(v), side="right"))
    return {k: c / len(v) for k, c in zip(*np.unique(b, return_counts=True))}


def brute_psi(r, a):
    both = set(r) | set(a)
    f = C.PSI_FLOOR
    return sum((max(a.get(b, 0), f) - max(r.get(b, 0), f)) * np.log(max(a.get(b, 0), f) / max(r.get(b, 0), f)) for b in both)


def variables(seed, n=3000):
    rng = np.random.default_rng(seed)
    tail = np.where(rng.random(n) < 0.95, 0.0, np.round(rng.random(n) * 1000, 1))
    plain = np.where(rng.random(n) < 0.1, np.nan, np.round(rng.normal(seed, 1, n), 2))
    return {"plain": plain, "flag": (rng.random(n) < 0.3).astype(float), "constant": np.ones(n), "tail": tail, "empty": np.full(n, np.nan)}


def long_frame(spark, data):
    rows = [(k, None if np.isnan(x) else float(x)) for k, v in data.items() for x in v]
    return spark.createDataFrame(rows, "variable string, value double")


def test_drift_against_brute_force(spark):
    """Includes a variable with more edges than the array form takes."""
    ref, now = variables(0), variables(1)
    key = ["variable"]
    edges = drift.decile_edges(long_frame(spark, ref), key)
    found = edges.toPandas()
    for name, v in ref.items():
        want = brute_edges(v)
        assert sorted(found[found.variable == name].edge) == pytest.approx(list(want), abs=1e-9), name
        assert sorted(found[found.variable == name].edge_no) == list(range(1, len(want) + 1))
    assert len(brute_edges(ref["tail"])) > drift.ARRAY_EDGES
    shares = {n: drift.proportions(drift.bin_counts(long_frame(spark, d), edges, key, key), key) for n, d in (("ref", ref), ("now", now))}
    index = {r["variable"]: r for r in drift.psi(shares["now"], shares["ref"], key, key).collect()}
    itself = {r["variable"]: r["psi"] for r in drift.psi(shares["ref"], shares["ref"], key, key).collect()}
    got = shares["now"].toPandas()
    for name in ref:
        e = brute_edges(ref[name])
        r, a = brute_shares(ref[name], e), brute_shares(now[name], e)
        mine = got[got.variable == name].set_index("bin").proportion.to_dict()
        assert mine == pytest.approx(a), name
        assert index[name]["psi"] == pytest.approx(brute_psi(r, a), abs=1e-9), name
        assert index[name]["missing_rate"] == pytest.approx(np.isnan(now[name]).mean())
        assert itself[name] == pytest.approx(0, abs=1e-12)
    whole = drift.with_empty_bins(shares["now"], edges, key).groupBy("variable").agg(F.sum("proportion").alias("s"), F.count("*").alias("n")).toPandas()
    assert whole.s.tolist() == pytest.approx([1.0] * len(ref))


@pytest.mark.parametrize("accuracy, margin", [(2000, 4), (10, 0)])
def test_deciles_keep_few_rows(spark, monkeypatch, accuracy, margin):
    """Exact with a good sketch and with a poor one; with the good one no more is stored than brackets, deciles and edges."""
    kept = {}
    store = drift.stored

    def counted(df, name):
        out = store(df, name)
        kept[name] = out.count()
        return out
    monkeypatch.setattr(drift, "stored", counted)
    monkeypatch.setattr(drift, "ACCURACY", accuracy)
    monkeypatch.setattr(drift, "MARGIN", margin)
    values = np.random.default_rng(5).permutation(np.concatenate([np.random.default_rng(4).normal(size=20_000), np.repeat(0.25, 3000)]))
    edges = drift.decile_edges(long_frame(spark, {"x": values}), ["variable"])
    assert sorted(r["edge"] for r in edges.collect()) == pytest.approx(list(brute_edges(values)), abs=1e-12)
    if margin:
        assert kept == {"brackets": 1, "deciles": 1, "edges": 9}
        assert drift.near_ranks(long_frame(spark, {"x": values}), ["variable"], [i / 10 for i in range(11)]).count() < 0.05 * len(values)

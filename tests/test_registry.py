"""Recorded decisions replayed, and a gate whose outcome depends on the earlier ones."""

from datetime import date

from pyspark.sql import functions as F

from riskmart.operators import populations, registry

# Recorded decisions (slot, trained on, challenger AUC, champion AUC, status, retired).
RECORDED = [
    ("model_1", "2024-01-01", 0.8615972825176317, None, "retired", "2024-03-01"),
    ("model_1", "2024-03-01", 0.9019729082935432, 0.884115969908282, "retired", "2024-05-01"),
    ("model_1", "2024-05-01", 0.9178368719781375, 0.9069476560857683, "retired", "2024-07-01"),
    ("model_1", "2024-07-01", 0.918249669254387, 0.9078405431716632, "retired", "2024-09-01"),
    ("model_1", "2024-09-01", 0.931336979236139, 0.9213196389666978, "retired", "2024-11-01"),
    ("model_1", "2024-11-01", 0.9364670840502596, 0.929685805584072, "retired", "2025-01-01"),
    ("model_1", "2025-01-01", 0.9523962735305417, 0.9484729158663081, "champion", None),
    ("model_2", "2024-01-01", 0.7879531041346148, None, "retired", "2024-03-01"),
    ("model_2", "2024-03-01", 0.8291997297699608, 0.8119782899934732, "retired", "2024-07-01"),
    ("model_2", "2024-05-01", 0.8181364305234391, 0.8198969939037208, "rejected", None),
    ("model_2", "2024-07-01", 0.8109882429295325, 0.8081575597214249, "retired", "2024-09-01"),
    ("model_2", "2024-09-01", 0.8138321995464853, 0.8065670712729536, "retired", "2024-11-01"),
    ("model_2", "2024-11-01", 0.7985762688991387, 0.7974050886096692, "retired", "2025-01-01"),
    ("model_2", "2025-01-01", 0.822408415956803, 0.8209840338872597, "champion", None),
]


def recorded(spark):
    rows = [(s, date.fromisoformat(t), a, b) for s, t, a, b, _, _ in RECORDED]
    df = spark.createDataFrame(rows, "slot string, trained_on date, challenger_auc double, champion_auc double")
    met = F.when(F.col("champion_auc").isNotNull(), F.lit("the version before"))
    return df.withColumn("version", registry.version_name(F.col("slot"), F.col("trained_on"))).withColumn("champion_version", met)


def test_unknown_auc_loses(spark):
    rows = [("s", date(2024, 1, 1), "v1", None, None, None), ("s", date(2024, 2, 1), "v2", 0.7, "v1", None), ("s", date(2024, 3, 1), "v3", None, "v1", 0.6)]
    df = spark.createDataFrame(rows, "slot string, trained_on date, version string, challenger_auc double, champion_version string, champion_auc double")
    assert [r["promoted"] for r in registry.recorded_promotions(df).orderBy("trained_on").collect()] == [True, False, False]


def test_replay(spark):
    reg = registry.intervals(registry.recorded_promotions(recorded(spark)))
    got = {(r["slot"], str(r["trained_on"])): (r["status"], str(r["retired_at"]) if r["retired_at"] else None) for r in reg.collect()}
    assert got == {(s, t): (status, retired) for s, t, _, _, status, retired in RECORDED}
    # the version that met each challenger is the one live just before
    asked = recorded(spark).where("champion_auc is not null").select("slot", F.col("trained_on").alias("d"))
    rivals = {(r["slot"], str(r["d"])): r["version"] for r in populations.live_versions(asked, reg, "d", True).collect()}
    assert len(rivals) == 12
    assert rivals["model_2", "2024-07-01"] == "model_2_2024_03_01" and rivals["model_1", "2024-07-01"] == "model_1_2024_05_01"


def test_intervals_do_not_overlap(spark):
    reg = registry.intervals(registry.recorded_promotions(recorded(spark)))
    live = reg.where("promoted_at is not null").select("slot", "promoted_at", "retired_at").collect()
    for a in live:
        for b in live:
            if a["slot"] == b["slot"] and a["promoted_at"] < b["promoted_at"]:
                assert a["retired_at"] is not None and a["retired_at"] <= b["promoted_at"]


def test_gate_follows_the_champion(spark):
    """v2 loses to v1, so v3 meets v1, not v2."""
    rows = [("s", date(2024, 1, 1), "v1", "v1", 0.7),
            ("s", date(2024, 3, 1), "v2", "v2", 0.6), ("s", date(2024, 3, 1), "v2", "v1", 0.65),
            ("s", date(2024, 5, 1), "v3", "v3", 0.6), ("s", date(2024, 5, 1), "v3", "v2", 0.5), ("s", date(2024, 5, 1), "v3", "v1", 0.6)]
    df = spark.createDataFrame(rows, "slot string, trained_on date, version string, scored_version string, auc double")
    got = {r["version"]: r for r in registry.promotions(df).collect()}
    assert [got[v]["promoted"] for v in ("v1", "v2", "v3")] == [True, False, True]
    assert got["v3"]["champion_version"] == "v1" and got["v1"]["champion_auc"] is None


def test_upsert(spark):
    a = spark.createDataFrame([("x", 1), ("y", 1)], "k string, n int")
    b = spark.createDataFrame([("y", 2), ("z", 2)], "k string, n int")
    assert {tuple(r) for r in registry.upsert(a, b, ["k"]).collect()} == {("x", 1), ("y", 2), ("z", 2)}

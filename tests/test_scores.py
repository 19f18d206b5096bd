import datetime as dt

import pytest
from pyspark.sql import functions as F

from mastlight.fixed_values import COVERAGE_WEIGHTS, LIVE_WEIGHTS, RISK_BANDS, RISK_CONFIDENCE
from mastlight.functions import numeric, scoring
from mastlight.plans import recommend, risk


def value(spark, column, kind, build):
    return spark.createDataFrame([(column,)], f"v {kind}").select(build(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("v,ramp,expected", [
    (80.0, (80, 260, 12), 0.0), (170.0, (80, 260, 12), 6.0), (300.0, (80, 260, 12), 12.0), (None, (80, 260, 12), 0.0),
    (-85.0, (-85, -110, 18), 0.0), (-97.5, (-85, -110, 18), 9.0), (-120.0, (-85, -110, 18), 18.0), (None, (-85, -110, 18), 0.0),
    (12.0, (12, 3, 8), 0.0), (7.5, (12, 3, 8), 4.0), (None, (12, 3, 8), 8.0)])
def test_ramp(spark, v, ramp, expected):
    assert value(spark, v, "double", lambda c: F.expr(scoring.ramp_sql("v", *ramp))) == expected


@pytest.mark.parametrize("v,band", [(24.9, "low"), (25.0, "medium"), (45.0, "high"), (69.9, "high"), (70.0, "critical")])
def test_band(spark, v, band):
    assert value(spark, v, "double", lambda c: scoring.tier(c, RISK_BANDS, "low")) == band


@pytest.mark.parametrize("v,name", [(59, "low"), (60, "medium"), (299, "medium"), (300, "high")])
def test_confidence(spark, v, name):
    assert value(spark, v, "int", lambda c: scoring.tier(c, RISK_CONFIDENCE, "low")) == name


@pytest.mark.parametrize("v,digits,expected", [(-87.25, 1, -87.3), (87.25, 1, 87.3), (2.5, 0, 3.0), (None, 1, None)])
def test_rounding_is_half_away_from_zero(spark, v, digits, expected):
    assert value(spark, v, "double", lambda c: numeric.rounded(c, digits)) == expected


def test_half_up_tenth(spark):
    assert value(spark, -0.25, "double", numeric.half_up_tenth) == -0.2
    assert value(spark, 0.25, "double", numeric.half_up_tenth) == 0.3


def inputs(spark, **given):
    schema = [("operator", "string")]
    schema += [(c, "bigint") for c in risk.COUNTS]
    averages = ["live_avg_signal", "live_avg_latency", "live_avg_dl", "qos_avg_signal", "qos_avg_latency",
                "qos_avg_packet_loss", "qos_avg_error_rate", "event_avg_packet_loss", "uptime_avg_percentage",
                "uptime_downtime_minutes", "energy_avg_grid_hours", "energy_avg_generator_hours",
                "maintenance_downtime_minutes", "latency_avg_packet_loss", "dropped_avg_signal"]
    schema += [(c, "double") for c in averages]
    row = {"operator": "MTN", **{c: 0 for c in risk.COUNTS}, **given}
    df = spark.createDataFrame([tuple(row.get(n) for n, _ in schema)], ", ".join(f"{n} {t}" for n, t in schema))
    return df.withColumns({c: F.col(c).cast("decimal(30,1)") for c in averages})


def test_no_data_scores_21(spark):
    got = risk.score_risk(inputs(spark)).first()
    assert (got.score, got.band, got.confidence, got.evidence_count) == (21.0, "low", "low", 0)
    assert [(c.points, c.evidence) for c in got.contributors] == [(8.0, None), (8.0, "0 synthetic outages"), (5.0, None)]


def test_score_is_capped_and_top_six(spark):
    worst = dict(live_avg_signal=-140.0, live_avg_latency=900.0, live_avg_dl=0.0, qos_avg_signal=-130.0, qos_avg_latency=900.0,
                 qos_avg_packet_loss=90.0, qos_avg_error_rate=90.0, event_count=9000, event_avg_packet_loss=90.0,
                 uptime_downtime_minutes=9000.0, uptime_outage_count=90000, uptime_avg_percentage=10.0,
                 hardware_alert_count=900, hardware_bad_health_count=900, energy_avg_grid_hours=0.0,
                 energy_avg_generator_hours=24.0, maintenance_high_priority_count=90, maintenance_downtime_minutes=900.0,
                 latency_sla_miss_count=90, latency_avg_packet_loss=90.0, handover_failure_count=90,
                 dropped_call_count=900, dropped_avg_signal=-130.0, technician_unresolved_count=90)
    got = risk.score_risk(inputs(spark, **worst)).first()
    assert got.score == 100.0 and got.band == "critical" and len(got.contributors) == 6
    assert [c.points for c in got.contributors] == [26.0, 26.0, 18.0, 17.0, 15.0, 15.0]
    assert got.contributors[2].evidence == "-140.0 dBm"
    assert [c.label for c in got.contributors[4:]] == ["Maintenance backlog", "Dropped-call spike"]


@pytest.mark.parametrize("column,steps", [
    ("live_avg_latency", [0.0, 80.0, 150.0, 260.0, 500.0]), ("event_count", [0, 50, 700, 1500, 5000]),
    ("handover_failure_count", [0, 2, 20, 35, 100])])
def test_score_grows_with_input(spark, column, steps):
    scores = [risk.score_risk(inputs(spark, **{column: s})).first().score for s in steps]
    assert scores == sorted(scores) and scores[0] < scores[-1]


def evidence(spark, **given):
    row = {"dest_id": 0, "operator": "MTN", "sample_count": 40, "avg_signal": -80.0, "avg_latency": 100.0, "avg_dl": 25.0,
           "avg_ul": 5.0, "nearest_km": 1.0, "max_age_sec": 1800.0, **given}
    return spark.createDataFrame(
        [tuple(row.values())],
        "dest_id int, operator string, sample_count bigint, avg_signal double, avg_latency double, avg_dl double, "
        "avg_ul double, nearest_km double, max_age_sec double")


@pytest.mark.parametrize("given,weights,source,score,confidence", [
    ({}, LIVE_WEIGHTS, "live_readings", 55.0, "medium"),
    ({}, COVERAGE_WEIGHTS, "synthetic_coverage", 50.0, "medium"),
    ({"max_age_sec": 3601.0}, LIVE_WEIGHTS, "live_readings", 52.5, "medium"),
    ({"sample_count": 1}, LIVE_WEIGHTS, "live_readings", 53.5, "low"),
    ({"sample_count": 120}, LIVE_WEIGHTS, "live_readings", 57.5, "high"),
    ({"avg_signal": None, "avg_latency": None, "avg_dl": None}, LIVE_WEIGHTS, "live_readings", 77.5, "medium")])
def test_recommendation_scores(spark, given, weights, source, score, confidence):
    got = recommend.rank_providers(evidence(spark, **given), weights, source).first()
    assert (got.score, got.confidence) == (score, confidence)


def test_recommend_rejects_bad_parameters(spark):
    empty = spark.createDataFrame([], "id int")
    with pytest.raises(ValueError):
        recommend.recommend({"readings": empty}, float("nan"), 3.0, dt.datetime(2024, 1, 1))
    assert (recommend.clamp_radius(None), recommend.clamp_radius(900), recommend.clamp_radius("0.2")) == (5.0, 50.0, 1.0)
    assert (recommend.clamp_hours("x"), recommend.clamp_hours(0), recommend.clamp_hours(999)) == (24, 24, 168)
    assert (risk.clamp_hours(0), risk.clamp_hours("100"), risk.clamp_hours(-4)) == (6, 72, 1)

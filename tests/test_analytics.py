import re
from decimal import Decimal

from pyspark.sql import functions as F

from adjudica.operators import analytics, dashboards, marts, measures
from adjudica.operators.features import provider_features
from conftest import bene, claim, provider, star_of


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_portfolio(small_star):
    assert rows(analytics.portfolio_kpi(small_star)) == [(9, 4, 4, Decimal("28000.00"), Decimal("3111.11"), Decimal("2200.00"))]


def test_types(small_star):
    got = {r["claim_type"]: r for r in analytics.claim_type_breakdown(small_star).collect()}
    assert (got["Inpatient"]["claim_count"], got["Inpatient"]["total_reimbursed"]) == (4, Decimal("26700.00"))
    assert (got["Outpatient"]["claim_count"], got["Outpatient"]["total_reimbursed"]) == (5, Decimal("1300.00"))
    assert got["Inpatient"]["avg_length_of_stay_days"] == Decimal("6.0")


def test_large_claims_orphans_and_states(small_star):
    assert [r["claim_id"] for r in analytics.largest_claims(small_star).collect()] == ["S3", "S1", "S2", "S4"]
    assert analytics.orphan_claims(small_star["fact_claims_unified"], small_star["dim_providers"], small_star["dim_beneficiaries"]).count() == 0
    assert rows(analytics.state_breakdown(small_star)) == [
        (3, 5, 2, Decimal("13000.00"), Decimal("40.00")), (8, 4, 3, Decimal("15000.00"), Decimal("50.00")),
    ]


def test_ranks_deciles_and_running_totals(small_star):
    ranks = analytics.state_payout_ranks(small_star, [3, 8])
    assert [(r["state_id"], r["provider_id"], r["state_payout_rank"]) for r in ranks.collect()] == [
        (3, "N1", 1), (3, "N2", 2), (8, "N3", 1), (8, "N1", 2), (8, "N4", 3),
    ]
    assert [(r["provider_id"], r["payout_decile"]) for r in analytics.top_payout_deciles(small_star).collect()] == [("N1", 1), ("N3", 2), ("N2", 3), ("N4", 4)]
    full = {(r["provider_id"], r["payout_decile"]) for r in analytics.payout_deciles(small_star, 3).collect()}
    assert full == {("N1", 1), ("N3", 1), ("N2", 2), ("N4", 3)}
    assert [r[2] for r in rows(analytics.cumulative_payout(small_star))] == [Decimal(x) for x in ("16200.00", "22300.00", "28000.00")]


def test_rolling_average(spark):
    claims = [claim(f"C{i}", "Outpatient", "B1", "P1", f"2009-01-0{i}", i * 10) for i in range(1, 6)]
    star = star_of(spark, [provider("P1", True)], [bene("B1")], claims)
    got = [r["rolling_3claim_avg_amount"] for r in analytics.rolling_claim_average(star).collect()]
    assert got == [Decimal(x) for x in ("10.00", "15.00", "20.00", "30.00", "40.00")]


def test_same_day_and_long_stays(spark):
    claims = [
        claim("A", "Outpatient", "B1", "P1", "2009-01-01", 5), claim("B", "Outpatient", "B1", "P1", "2009-01-01", 6),
        claim("C", "Inpatient", "B1", "P1", "2009-01-02", 100, stay=16), claim("D", "Inpatient", "B1", "P1", "2009-01-03", 9, stay=14),
    ]
    star = star_of(spark, [provider("P1", True)], [bene("B1")], claims)
    assert [(r[3], r[4]) for r in rows(analytics.same_day_billing(star))] == [(2, Decimal("11.00"))]
    assert [(r["claim_id"], r["reimbursement_per_day"]) for r in analytics.stay_outliers(star).collect()] == [("C", Decimal("6.25"))]
    assert {tuple(r) for r in dashboards.same_day_distribution(star).collect()} == {(2, 1), (1, 2)}


def test_empty_star(spark):
    star = star_of(spark, [provider("P1", True)], [bene("B1")], [])
    for name, build in analytics.ANALYTICS.items():
        got = build(star).collect()
        assert len(got) == (1 if name == "q01_portfolio_kpi" else 0), name
    assert provider_features(star).first()["total_claims"] is None
    assert marts.temporal_trends(star).count() == 0
    assert measures.portfolio_fraud_rate(marts.drill_base(star)).first()[0] == 0.0


def test_top_claims_with_ties(spark):
    claims = [claim(f"C{i:02d}", "Outpatient", "B1", "P1", "2009-01-01", 7 if i < 30 else i) for i in range(40)]
    df = star_of(spark, [], [], claims)["fact_claims_unified"]
    got = [r["claim_id"] for r in marts.top_claims(df, 15).collect()]
    assert got == [f"C{i}" for i in range(39, 29, -1)] + [f"C{i:02d}" for i in range(5)]
    assert marts.top_claims(df, 100).count() == 40


def scores_of(spark, rows):
    return spark.createDataFrame(rows, "provider_id string, potential_fraud boolean, total_reimbursed double, fraud_risk_probability double, risk_tier string")


def test_measures(small_star, spark):
    drill = marts.drill_base(small_star)
    one = lambda df: df.first()[0]
    assert one(measures.total_claims(drill)) == 9
    assert one(measures.total_reimbursement(drill)) == Decimal("28000.00")
    assert round(one(measures.avg_claim_cost(drill)), 4) == 3111.1111
    assert one(measures.total_deductibles_paid(drill)) == Decimal("2200.00")
    assert one(measures.total_beneficiaries(drill)) == 4
    assert one(measures.fraud_claims_count(drill)) == 4
    assert round(one(measures.portfolio_fraud_rate(drill)), 4) == 44.4444
    assert one(measures.fraud_rate_rag(drill)) == "RED" and one(measures.fraud_rate_colour(drill)) == "#E74C3C"
    assert round(one(measures.inpatient_cost_ratio(drill)), 3) == 95.357
    by_type = {r[0]: r[1] for r in measures.fraud_rate_rag(drill, ["claim_type"]).collect()}
    assert by_type == {"Inpatient": "RED", "Outpatient": "AMBER"}
    scores = scores_of(spark, [("N1", True, 13150.0, 0.9876, "High Risk"), ("N2", False, 5450.0, 0.1, "Low Risk"), ("N9", True, None, 0.5, "High Risk"), ("N8", False, None, 0.1, "Low Risk")])
    assert one(measures.active_providers(scores)) == 4 and one(measures.predicted_high_risk(scores)) == 2
    assert round(one(measures.high_risk_provider_pct(scores)), 2) == 50.0
    assert one(measures.fraud_loss_exposure(scores)) == Decimal("13150.00")
    assert one(measures.risk_badge_colour(scores)) == "#CCCCCC"
    assert one(measures.risk_badge_colour(scores.where("provider_id = 'N1'"))) == "#D9534F"
    assert one(measures.provider_summary(scores)) == "Provider None Selected | Model Probability: 0.0% | Tier: Unknown"
    assert one(measures.provider_summary(scores.where("provider_id = 'N1'"))) == "Provider N1 | Model Probability: 98.8% | Tier: High Risk"
    assert {tuple(r) for r in measures.provider_rank(drill, scores).collect()} == {
        ("N1", Decimal("13150.00"), 1), ("N2", Decimal("5450.00"), 2), ("N9", Decimal("0.00"), 3), ("N8", Decimal("0.00"), 3),
    }


def test_month_measures_respect_gaps(spark):
    trends = spark.createDataFrame([("2008-11", 10, 100.0), ("2008-12", 20, 200.0), ("2009-02", 5, 60.0)], "claim_year_month string, total_claims bigint, total_reimbursement double")
    prior = {r[0]: r[2] for r in measures.prior_month_claims(trends).collect()}
    assert prior == {"2008-11": None, "2008-12": 10, "2009-02": None}
    growth = {r[0]: r[1] for r in measures.month_growth(trends).collect()}
    assert growth == {"2008-11": None, "2008-12": 100.0, "2009-02": None}
    rolling = {r[0]: r[1] for r in measures.rolling_reimbursement(trends).collect()}
    assert rolling == {"2008-11": 100.0, "2008-12": 150.0, "2009-02": 130.0}


def test_marts(small_star, spark):
    features = provider_features(small_star)
    given = spark.createDataFrame([("N1", 0.5), ("N2", 0.3), ("N3", 0.29996), ("N4", 0.49999)], "provider_id string, probability double")
    risk = marts.provider_risk_scores(features, given)
    assert len(risk.columns) == 38
    got = {r["provider_id"]: (r["fraud_risk_probability"], r["model_fraud_prediction"], r["risk_tier"]) for r in risk.collect()}
    assert got == {"N1": (0.5, 1, "High Risk"), "N2": (0.3, 0, "Medium Risk"), "N3": (0.3, 0, "Low Risk"), "N4": (0.5, 0, "Medium Risk")}
    kpi = marts.kpi_summary(small_star, features).first()
    assert kpi["total_fraud_loss_exposure_usd"] == Decimal("21950.00")
    assert kpi["fraud_financial_share_pct"] == Decimal("78.39") and kpi["portfolio_fraud_provider_rate_pct"] == Decimal("50.00")
    assert marts.state_geographic_summary(small_star).first()["total_patients"] == 2
    drill = marts.claims_drillthrough(small_star, risk.where("provider_id <> 'N4'"))
    assert len(drill.columns) == 16 and drill.where("risk_tier IS NULL").count() == 2


def test_dashboards(small_star, spark):
    mix = {r["claim_type"]: r["claim_share_pct"] for r in dashboards.claim_type_mix(small_star).collect()}
    assert mix == {"Inpatient": Decimal("44.44"), "Outpatient": Decimal("55.56")}
    assert rows(dashboards.flagged_states(small_star))[0] == (8, Decimal("14400.00"), 2, 4)
    assert rows(dashboards.stay_quartiles(small_star)) == [(2, 3.5, 6.0, 8.5, 10, 0)]
    assert [r["claim_id"] for r in dashboards.claim_audit(small_star, "N3").collect()] == ["S3"]
    assert {(*r[:3], round(r[3], 2)) for r in dashboards.physician_network(small_star, "N1").collect()} == {("N1", "KA", 2, 0.67), ("N1", "KB", 1, 0.33)}
    features = provider_features(small_star).withColumn("risk_tier", F.lit("High Risk"))
    quadrant = {r["provider_id"]: r["quadrant"] for r in dashboards.provider_quadrant(features).collect()}
    assert quadrant["N1"] == "high volume, high payout" and quadrant["N4"] == "low volume, low payout"
    kept = dashboards.filter_providers(features, small_star, states=[8], min_claims=2)
    assert {r["provider_id"] for r in kept.collect()} == {"N1", "N4"}
    assert dashboards.condition_prevalence(small_star).count() == 2


def test_provider_filter_reaches_the_scan(spark, small_star, tmp_path):
    small_star["fact_claims_unified"].write.parquet(str(tmp_path / "f"))
    star = {"fact_claims_unified": spark.read.parquet(str(tmp_path / "f"))}
    plan = dashboards.claim_audit(star, "N1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(provider_id,N1)" in plan


def sparse_star(spark):
    """Claims without a date, a provider or a patient."""
    claims = [
        claim("A1", "Inpatient", "A", "N1", "2011-05-02", 100), claim("A2", "Outpatient", "A", "N1", "2011-05-31", 50),
        claim("A3", "Outpatient", "B", "N2", "2011-05-31", 0), claim("A4", "Outpatient", None, None, "2011-06-01", 7),
        claim("A5", "Outpatient", "B", "N1", None, 3), claim("A6", "Outpatient", "B", "N2", None, 4),
        claim("A7", "Inpatient", "A", "N2", "2012-05-02", 9),
    ]
    benes = [bene("A", state=3), bene("B", state=None)]
    return star_of(spark, [provider("N1", True), provider("N2", False)], benes, claims)


def test_months_count_each_key_apart(spark):
    trends = marts.temporal_trends(sparse_star(spark))
    assert "Expand" not in trends._jdf.queryExecution().executedPlan().toString()
    got = [(r["claim_year_month"], r["total_claims"], r["inpatient_claims"], r["outpatient_claims"], float(r["total_reimbursement"]), r["active_providers"], r["distinct_beneficiaries"]) for r in trends.collect()]
    assert got == [("2011-05", 3, 1, 2, 150, 2, 2), ("2011-06", 1, 0, 1, 7, 0, 0), ("2012-05", 1, 1, 0, 9, 1, 1), (None, 2, 0, 2, 7, 2, 1)]


def test_states_are_looked_up_with_one_shuffle_of_claims(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = analytics.state_totals(sparse_star(spark))
        plan = totals._jdf.queryExecution().executedPlan().toString()
        got = {(r["state_id"], r["provider_id"], r["n"], r["paid"], r["potential_fraud"]) for r in totals.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not re.search(r"hashpartitioning\(provider_id#\d+, bene_id", plan) and len(re.findall(r"hashpartitioning\(bene_id", plan)) == 2
    assert got == {(3, "N1", 2, 15000, True), (3, "N2", 1, 900, False), (None, "N1", 1, 300, True), (None, "N2", 2, 400, False)}

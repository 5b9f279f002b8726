import random
import re

import pandas as pd
from pyspark.sql import functions as F

from adjudica.operators import features
from adjudica.operators.features import FEATURES, LABEL_DERIVED, assert_no_leakage, exact_median, provider_features
from conftest import bene, claim, provider, star_of


def by_provider(star):
    return {r["provider_id"]: r.asDict() for r in provider_features(star).collect()}


def test_hand_values(feature_star):
    got = by_provider(feature_star)
    x1 = got["X1"]
    assert (x1["total_claims"], x1["total_reimbursed"], x1["inpatient_claims"], x1["outpatient_claims"]) == (5, 4500, 2, 3)
    assert (x1["distinct_beneficiaries"], x1["same_day_duplicate_claims"], x1["mean_length_of_stay"]) == (2, 4, 4.5)
    assert x1["mean_patient_age"] == 51 and x1["median_reimbursed"] == 400 and x1["max_length_of_stay"] == 6
    assert x1["distinct_procedures"] == 2 and x1["distinct_diagnosis_codes"] == 3 and x1["distinct_operating_physicians"] == 1
    assert x1["mean_chronic_conditions"] == 1.5 and x1["renal_disease_ratio"] == 0.5 and x1["diabetes_ratio"] == 0.5
    assert got["X2"]["same_day_duplicate_claims"] == 3 and got["X2"]["mean_length_of_stay"] == 0 and got["X2"]["mean_patient_age"] is None
    assert got["X3"]["mean_patient_age"] == 34


def test_provider_without_claims(feature_star):
    x4 = by_provider(feature_star)["X4"]
    filled = {"mean_length_of_stay", "max_length_of_stay", "distinct_procedures", "same_day_duplicate_claims"}
    assert all((x4[name] == 0) if name in filled else (x4[name] is None) for name in FEATURES)


def test_shape_and_leakage(feature_star):
    df = provider_features(feature_star)
    assert len(FEATURES) == 33 and df.columns == ["provider_id", "potential_fraud", *FEATURES]
    assert not set(assert_no_leakage(df).columns) & set(LABEL_DERIVED)
    assert df.where("total_reimbursed < 0 OR total_claims < 0").count() == 0


def test_one_claim_has_no_spread(spark):
    star = star_of(spark, [provider("P1", True)], [bene("B1")], [claim("C", "Outpatient", "B1", "P1", None, 0)])
    row = by_provider(star)["P1"]
    assert row["std_reimbursed"] == 0 and row["zero_reimbursed_ratio"] == 1 and row["same_day_duplicate_claims"] == 0


def test_against_pandas(spark):
    rng = random.Random(7)
    benes = [bene(f"B{i}", rng.choice(["1930-02-01", "1960-03-04", "1890-01-01", "2015-01-01", None]), flags=rng.sample(["chronic_cancer", "chronic_stroke", "chronic_copd"], 2)) for i in range(8)]
    claims = [
        # One provider holds most claims.
        claim(f"C{i}", rng.choice(["Inpatient", "Outpatient"]), f"B{rng.randrange(9)}", "P0" if rng.random() < 0.6 else f"P{rng.randrange(1, 5)}",
              rng.choice(["2009-01-01", "2009-01-02", None]), rng.choice([0, 10.25, 99.99, 500]), rng.choice([0, 5]), rng.randrange(9),
              rng.choice([None, "D1", "D2", "D3"]), rng.choice([None, "D7"]), rng.choice([None, "X", "Y"]))
        for i in range(300)
    ]
    star = star_of(spark, [provider(f"P{i}", i % 2 == 0) for i in range(6)], benes, claims)
    got = by_provider(star)
    frame = pd.DataFrame(claims).assign(paid=lambda d: d["reimbursed_amount"].astype(float))
    birth = {b["bene_id"]: b["dob"] for b in benes}
    for key, group in frame.groupby("provider_id"):
        row = got[key]
        inpatient = group[group["claim_type"] == "Inpatient"]
        pairs = group[["bene_id"]].drop_duplicates()
        ages = [min(max(2009 - birth[b].year, 0), 115) for b in pairs["bene_id"] if birth.get(b)]
        sizes = group.dropna(subset=["claim_start_date"]).groupby(["bene_id", "claim_start_date"]).size()
        expected = {
            "total_claims": len(group), "median_reimbursed": group["paid"].median(), "std_reimbursed": group["paid"].std(),
            "max_reimbursed": group["paid"].max(), "mean_length_of_stay": inpatient["length_of_stay"].mean(),
            "distinct_attending_physicians": group["attending_physician"].nunique(),
            "distinct_operating_physicians": group["operating_physician"].nunique(),
            "distinct_diagnosis_codes": group["primary_diagnosis_code"].nunique(),
            "distinct_beneficiaries": pairs["bene_id"].nunique(), "mean_patient_age": sum(ages) / len(ages),
            "same_day_duplicate_claims": sizes[sizes > 1].sum(),
            "mean_chronic_conditions": 2 * sum(b in birth for b in pairs["bene_id"]) / len(pairs),
            "claims_per_beneficiary": len(group) / (pairs["bene_id"].nunique() + 1e-5),
        }
        for name, value in expected.items():
            assert abs(row[name] - value) < 1e-6, (key, name)


def test_median_of_even_odd_and_repeated_values(spark):
    rng = random.Random(3)
    data = [("a", v) for v in rng.choices(range(5), k=101)] + [("b", v) for v in rng.choices(range(5), k=100)] + [("c", 4), ("d", None)]
    df = spark.createDataFrame(data, "k string, v bigint")
    got = {r["k"]: r["median"] for r in exact_median(df, "k", F.col("v")).collect()}
    expected = {k: g["v"].median() for k, g in pd.DataFrame(data, columns=["k", "v"]).groupby("k")}
    assert got == {k: v for k, v in expected.items() if k != "d"}


def test_pairs_and_bins_are_dealt_once(spark, feature_star, monkeypatch):
    def sent(df):
        """Keys of the plan's exchanges."""
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)]

    monkeypatch.setattr(features, "ROWS_PER_TASK", 1)  # 9 claims: 9 tasks
    claims, benes = feature_star["fact_claims_unified"], feature_star["dim_beneficiaries"]
    days = sent(features.patient_features(claims, benes))
    assert days.count("provider_id, bene_id") == 1 and not [k for k in days if "claim_start_date" in k]
    medians = exact_median(claims, "provider_id", F.col("deductible_amount").cast("bigint"))
    assert not [k for k in sent(medians) if "_value" in k]
    assert {r["provider_id"]: r["median"] for r in medians.collect()} == {"X1": 20, "X2": 0, "X3": 5}


def test_no_code_of_a_kind_counts_as_none(spark, feature_star):
    found = features.diversity_features(feature_star["fact_claims_unified"], feature_star["fact_inpatient_claims"])
    got = {r["provider_id"]: r.asDict() for r in found.collect()}
    assert (got["X2"]["distinct_operating_physicians"], got["X2"]["distinct_procedures"], got["X2"]["distinct_attending_physicians"]) == (0, 0, 1)


def test_bins_are_not_sent(spark):
    rng = random.Random(5)
    data = [(rng.choice("ab"), rng.randrange(-50_000, 90_000)) for _ in range(301)] + [("c", 7), ("d", None), (None, 3)]
    medians = exact_median(spark.createDataFrame(data, "k string, v bigint"), "k", F.col("v"))
    plan = re.sub(r"#\d+L?", "", medians._jdf.queryExecution().executedPlan().toString())
    dealt, below = re.findall(r"Exchange (hashpartitioning.*REPARTITION_BY_NUM).*\n(.*)", plan)[0]
    assert "_value" in dealt and "_bin" not in dealt + below  # only key and value are sent
    assert plan.count("Exchange hashpartitioning(k, _bin") == 1  # the few middle bins
    expected = {k: g["v"].median() for k, g in pd.DataFrame(data, columns=["k", "v"]).dropna().groupby("k")}
    assert {r["k"]: r["median"] for r in medians.collect()} == expected


def test_parts_can_be_written_one_by_one(spark, feature_star, tmp_path):
    def kept(name, part):
        part.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    got = provider_features(feature_star, kept).collect()
    assert sorted(map(str, got)) == sorted(map(str, provider_features(feature_star).collect()))
    parts = {p.name: spark.read.parquet(str(p)) for p in tmp_path.iterdir()}
    assert set(parts) == {"volume", "medians", "stays", "diversity", "patients"}
    assert all(df.count() == df.select("provider_id").distinct().count() for df in parts.values())

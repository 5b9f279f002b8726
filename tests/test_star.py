import os

import pytest
from pyspark.sql import functions as F

from adjudica.operators import analytics, sampling, star
from adjudica.plans.catalogue import RAW_QUERIES
from adjudica.session import work_dir
from adjudica.schema import ANNUAL_AMOUNTS, CONDITIONS, RAW_COLUMNS, STAR_SCHEMAS
from adjudica.sources import star_store, testdata
from adjudica.sources.raw_files import RAW_FILES, read_raw, write_raw
from adjudica.sources.star_store import LoadError, count_rows, load_star, read_star, reconcile_counts, star_folder, table_counts, verify_load, write_star


def raw(spark, labels=None, benes=None, inpatient=None, outpatient=None):
    def table(name, rows):
        columns = RAW_COLUMNS[name]
        return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ", ".join(f"{c} string" for c in columns))

    def bene(key):
        return {"BeneID": key, "DOB": "1950-01-01", "DOD": "NA", "Gender": "1", "Race": "1", "State": "5", "County": "10",
                "RenalDiseaseIndicator": "Y"} | dict.fromkeys(CONDITIONS, "1") | dict.fromkeys(ANNUAL_AMOUNTS, "100")

    head = {"ClaimStartDt": "2009-01-01", "ClaimEndDt": "2009-01-05", "InscClaimAmtReimbursed": "5000", "DeductibleAmtPaid": "NA"}
    default_in = [head | {"BeneID": "B1", "ClaimID": "C1", "Provider": "P1", "AdmissionDt": "2009-01-01", "DischargeDt": "2009-01-05", "AttendingPhysician": "D1", "ClmDiagnosisCode_1": "NA"}]
    default_out = [head | {"BeneID": "B2", "ClaimID": "C2", "Provider": "P2", "AttendingPhysician": ""}]
    return {
        "labels": table("labels", labels or [{"Provider": "P1", "PotentialFraud": "Yes"}, {"Provider": "P2", "PotentialFraud": "No"}]),
        "beneficiary": table("beneficiary", benes or [bene("B1"), bene("B2")]),
        "inpatient": table("inpatient", default_in if inpatient is None else [head | r for r in inpatient]),
        "outpatient": table("outpatient", default_out if outpatient is None else [head | r for r in outpatient]),
    }


def counts(tables):
    return {row["table"]: row["rows"] for row in count_rows(tables).collect()}


def test_transform_counts_and_stay(spark):
    built = star.build_star(raw(spark))
    assert list(counts(built).values()) == [2, 2, 1, 1, 2]
    claim = built["fact_inpatient_claims"].first()
    assert claim["length_of_stay"] == 4
    assert (claim["primary_diagnosis_code"], claim["deductible_amount"]) == (None, 0)
    assert all(df.columns == STAR_SCHEMAS[name].fieldNames() for name, df in built.items())
    assert built["fact_claims_unified"].where("claim_type = 'Outpatient'").first()["length_of_stay"] == 0


def test_labels_are_trimmed_and_unknown_ones_stay_null(spark):
    rows = [{"Provider": " P1", "PotentialFraud": " Yes"}, {"Provider": "P1 ", "PotentialFraud": "Yes"}, {"Provider": "P2", "PotentialFraud": "Maybe"}]
    got = {r["provider_id"]: (r["potential_fraud"], r["fraud_label"]) for r in star.build_providers(raw(spark, labels=rows)["labels"]).collect()}
    assert got == {"P1": (True, "Yes"), "P2": (None, "Maybe")}


def test_orphans_are_dropped_before_duplicates(spark):
    rows = [
        {"BeneID": "GONE", "ClaimID": "C1", "Provider": "P1", "AdmissionDt": "2009-01-01", "DischargeDt": "2009-01-03"},
        {"BeneID": "B1", "ClaimID": "C1", "Provider": "P1", "AdmissionDt": "2009-01-09", "DischargeDt": "2009-01-01"},
        {"BeneID": "B1", "ClaimID": "C2", "Provider": "GONE", "AdmissionDt": None, "DischargeDt": "2009-01-01"},
    ]
    tables = raw(spark, inpatient=rows)
    built = star.build_star(tables)["fact_inpatient_claims"].collect()
    assert [(r["claim_id"], r["bene_id"], r["length_of_stay"]) for r in built] == [("C1", "B1", 0)]
    orphans = analytics.orphan_claims(
        star.claim_keys(tables), star.build_providers(tables["labels"]), star.build_beneficiaries(tables["beneficiary"])
    )
    # The orphan C1 shares its id with a sound claim.
    assert {(r["claim_id"], r["provider_id"], r["bene_id"]) for r in orphans.collect()} == {("C1", "P1", "GONE"), ("C2", "GONE", "B1")}


def test_registered_orphans_are_staged_first(spark):
    rows = [
        {"BeneID": "GONE", "ClaimID": "C1", "Provider": "P1"}, {"BeneID": "B1", "ClaimID": "C1", "Provider": "P1"},
        {"BeneID": "B1", "ClaimID": "C2", "Provider": "GONE"}, {"BeneID": "GONE", "ClaimID": "C2", "Provider": "GONE"},
    ]
    tables = raw(spark, inpatient=rows)
    found = {
        name: {(r["claim_id"], r["provider_id"], r["bene_id"]) for r in RAW_QUERIES[name](tables).collect()}
        for name in ("q08_orphan_claims", "q08_orphan_claims_read")
    }
    # Of each id the smallest row is staged: the sound C1, and one C2.
    assert found["q08_orphan_claims"] == {("C2", "GONE", "B1")}
    assert found["q08_orphan_claims_read"] == {("C1", "P1", "GONE"), ("C2", "GONE", "B1"), ("C2", "GONE", "GONE")}


def test_dedup_keeps_the_smallest_row(spark):
    df = spark.createDataFrame([("k", 2, None), ("k", 1, "b"), ("k", 1, "a"), ("m", None, "z")], "k string, n int, s string")
    got = {(r["k"], r["n"], r["s"]) for r in star.dedup_first(df, "k").collect()}
    assert got == {("k", 1, "a"), ("m", None, "z")}
    by_text = {(r["k"], r["s"]) for r in star.dedup_first(df, "k", ["s"]).collect()}
    assert by_text == {("k", "a"), ("m", "z")}


def test_dedup_reduces_before_the_shuffle(spark):
    plan = star.dedup_first(spark.range(9).selectExpr("id % 2 AS k", "id"), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_many_lines_are_dealt_by_order(spark, monkeypatch):
    orders = spark.createDataFrame([(k, k % 5) for k in range(40)], "o_orderkey bigint, o_custkey bigint")
    lines = spark.createDataFrame([(k % 40, k) for k in range(200)], "l_orderkey bigint, l_partkey bigint")
    assert testdata._dealt(orders, lines)["lineitem"] is lines
    monkeypatch.setattr(testdata, "LINES_PER_TASK", 10)
    days = testdata._dealt(orders, lines.withColumn("l_shipdate", F.lit("2001-02-03 04:05:06").cast("timestamp")))["lineitem"]
    assert dict(days.dtypes)["l_shipdate"] == "date" and str(days.first()["l_shipdate"]) == "2001-02-03"
    dealt = testdata._dealt(orders, lines)
    assert {df.rdd.getNumPartitions() for df in dealt.values()} == {20}
    joined = dealt["lineitem"].join(dealt["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    assert sorted(r["l_partkey"] for r in joined.collect()) == list(range(200))


def test_unified_fact_is_written_where_it_is_read(spark, tmp_path):
    load_star(raw(spark), str(tmp_path))
    folder = f"{star_folder(spark, str(tmp_path))}/fact_claims_unified"
    # Month folders would send every claim a second time.
    assert not [f for f in os.listdir(folder) if "=" in f]
    rows = spark.read.parquet(folder).select("claim_id", "claim_month").collect()
    assert {(r[0], r[1]) for r in rows} == {("C1", "2009-01"), ("C2", "2009-01")}


def odd_claims(spark):
    """Claims without a beneficiary, orphans of both kinds, and an orphan that shares its id with a sound claim."""
    keys = [("B1", "C1", "P1"), ("GONE", "C1", "P1"), (None, "C3", "P2"), ("B2", "C4", "LOST"), ("B2", "C5", "P2"), ("B2", "C5", "P1"), ("NA", "C6", "NA")]
    rows = [{"BeneID": b, "ClaimID": c, "Provider": p} for b, c, p in keys]
    return raw(spark, inpatient=rows, outpatient=[r | {"ClaimID": "O" + r["ClaimID"]} for r in rows] + [{"BeneID": "AWAY", "ClaimID": "O7", "Provider": "P1"}])


def test_claims_are_not_sent_by_the_key_of_a_large_dimension(spark, tmp_path, monkeypatch):
    tables = odd_claims(spark)
    expected = star.build_star(tables)
    monkeypatch.setattr(star_store, "BROADCAST_ROWS", 1)  # two of each are many
    loaded = load_star(tables, str(tmp_path))
    for name, df in expected.items():
        assert sorted(map(str, loaded[name].select(df.columns).collect())) == sorted(map(str, df.collect()))
    folder = f"{star_folder(spark, str(tmp_path))}/missing"
    missing = {key: spark.read.parquet(f"{folder}/{key}") for key in os.listdir(folder)}
    assert {key: {r[0] for r in df.collect()} for key, df in missing.items()} == {"bene_id": {"GONE", "AWAY"}, "provider_id": {"LOST"}}
    few = {key: F.broadcast(df) for key, df in missing.items()}
    fact = star.build_inpatient(tables["inpatient"], expected["dim_beneficiaries"], expected["dim_providers"], few)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(claim_id" in plan


def test_a_load_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    def blocks():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    tables, found, seen = raw(spark), spark.conf.get(key), []
    monkeypatch.setattr(star_store, "verify_load", lambda *_: seen.append(blocks()))
    before = blocks()
    load_star(tables, str(tmp_path))
    assert seen[0] <= before and spark.conf.get(key) == found


def test_defaults(spark):
    df = spark.createDataFrame([("B", *[None] * 16)], "bene_id string, " + ", ".join(
        [f"{c} boolean" for c in ["renal_disease", *CONDITIONS.values()]] + [f"{c} decimal(12,2)" for c in ANNUAL_AMOUNTS.values()]))
    row = star.apply_defaults(df).first().asDict()
    assert row["chronic_stroke"] is False and row["ip_annual_deductible"] == 0
    assert star.default_stay(spark.createDataFrame([(None,)], "length_of_stay int")).first()[0] == 0


def test_raw_files_round_trip(spark, tmp_path):
    tables = raw(spark, labels=[{"Provider": " P1", "PotentialFraud": "Yes"}, {"Provider": "NA", "PotentialFraud": None}])
    write_raw(tables, str(tmp_path))
    back = read_raw(spark, str(tmp_path))
    assert set(back) == set(RAW_FILES)
    assert {tuple(r) for r in back["labels"].collect()} == {(" P1", "Yes"), (None, None)}
    row = back["inpatient"].first()
    assert row["ClmDiagnosisCode_1"] is None and row["AttendingPhysician"] == "D1"


def test_raw_reader_keeps_extra_columns(spark, tmp_path):
    spark.createDataFrame([("x", "P1", "Yes")], "RecoveryAmount string, Provider string, PotentialFraud string").write.option("header", True).csv(str(tmp_path / "l.csv"))
    back = read_raw(spark, str(tmp_path), {"labels": "l.csv"})["labels"]
    assert back.columns == ["RecoveryAmount", "Provider", "PotentialFraud"]


def test_store_counts_and_reconciliation(spark, tmp_path):
    path = str(tmp_path / "star")
    built = star.build_star(raw(spark))
    loaded = load_star(raw(spark), path)
    assert counts(loaded) == counts(built)
    assert loaded["fact_claims_unified"].where("claim_month = '2009-01'").count() == 2
    check = reconcile_counts(table_counts(spark, path), count_rows(built))
    assert all(r["ok"] for r in check.collect()) and check.count() == 5
    partial = str(tmp_path / "partial")
    loaded["dim_providers"].write.parquet(f"{partial}/dim_providers")
    got = {r["table"]: r["rows"] for r in table_counts(spark, partial).collect()}
    assert got["dim_providers"] == 2 and got["fact_claims_unified"] is None
    assert all(r["rows"] is None for r in table_counts(spark, str(tmp_path / "none")).collect())


def test_write_star_replaces(spark, tmp_path):
    built = star.build_star(raw(spark))
    for _ in range(2):
        write_star(built, str(tmp_path))
    assert counts(read_star(spark, str(tmp_path))) == counts(built)
    verify_load(spark, str(tmp_path))
    built["fact_inpatient_claims"].limit(0).write.mode("overwrite").parquet(f"{star_folder(spark, str(tmp_path))}/fact_inpatient_claims")
    with pytest.raises(LoadError, match="holds 2 rows, the two facts 1"):
        verify_load(spark, str(tmp_path))


def test_a_failed_load_leaves_the_old_star(spark, tmp_path):
    path = str(tmp_path / "star")
    loaded = load_star(raw(spark), path)
    before, folder = counts(loaded), star_folder(spark, path)
    broken = raw(spark)
    broken["outpatient"] = broken["outpatient"].withColumn("ClaimID", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        load_star(broken, path)
    assert star_folder(spark, path) == folder and counts(read_star(spark, path)) == before
    load_star(raw(spark), path)
    assert star_folder(spark, path) != folder and counts(read_star(spark, path)) == before


def test_sample_keeps_the_label_mix(spark):
    labels = spark.createDataFrame([(f"P{i}", "Yes" if i % 10 == 0 else "No") for i in range(200)], "Provider string, PotentialFraud string")
    sample = sampling.stratified_sample(labels, 50)
    assert {r[0]: r[1] for r in sample.groupBy("PotentialFraud").count().collect()} == {"Yes": 5, "No": 45}
    assert sampling.stratified_sample(labels, 50).exceptAll(sample).count() == 0
    assert sampling.stratified_sample(labels, 500).count() == 200
    one = sampling.stratified_sample(labels, 3)
    assert {r[0]: r[1] for r in one.groupBy("PotentialFraud").count().collect()} == {"Yes": 1, "No": 2}


def test_sampled_tables_follow_the_providers(spark):
    cut = sampling.sample_raw(raw(spark), 1)
    kept = [r["Provider"] for r in cut["labels"].collect()]
    assert kept == ["P1"]
    assert cut["inpatient"].count() == 1 and cut["outpatient"].count() == 0
    assert [r["BeneID"] for r in cut["beneficiary"].collect()] == ["B1"]


def test_sample_rows(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("provider_id"))
    assert sampling.sample_rows(df, 10).count() == 10
    assert sampling.sample_rows(df, 1000).count() == 100


def test_another_header_stops_the_read(spark, tmp_path):
    folder = tmp_path / "l.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("Provider,PotentialFraud\nP1,Yes\n")
    (folder / "b.csv").write_text("PotentialFraud,Provider\nNo,P2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path), {"labels": "l.csv"})["labels"].collect()


def test_a_flag_wins_over_its_absence(spark):
    labels = spark.createDataFrame([("P1", "No"), ("P1", "Yes"), ("P2", "No"), ("P2", None)], "Provider string, PotentialFraud string")
    got = {(r["provider_id"], r["potential_fraud"], r["fraud_label"]) for r in star.build_providers(labels).collect()}
    assert got == {("P1", True, "Yes"), ("P2", False, "No")}


def test_a_short_fact_stops_the_load(spark, tmp_path):
    path = str(tmp_path / "star")
    loaded = load_star(raw(spark), path)
    sent = {name: df.count() for name, df in loaded.items()}
    verify_load(spark, path, sent)
    with pytest.raises(LoadError, match="fact_outpatient_claims"):
        verify_load(spark, path, sent | {"fact_outpatient_claims": sent["fact_outpatient_claims"] + 1})


def test_one_folder_for_a_session_without_one(spark):
    assert work_dir(spark) == work_dir(spark)

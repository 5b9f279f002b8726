import os

import pytest

from adjudica.sources.star_store import read_star
from adjudica.operators.quality import DataQualityError
from adjudica.plans import full_run
from adjudica.sources.raw_files import write_raw
from adjudica.sources.testdata import raw_tables


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    tables = raw_tables(spark, "/root/testdata/sf0.001")
    # Ten suppliers are too few for two sides with both labels in each.
    labels = tables["labels"].selectExpr("Provider", "CASE WHEN Provider LIKE '%3' OR Provider LIKE '%7' THEN 'Yes' ELSE 'No' END AS PotentialFraud")
    write_raw({**tables, "labels": labels}, folder)
    return folder


def test_every_stage_leaves_its_output(spark, raw_dir, tmp_path):
    out = str(tmp_path)
    done = full_run.run(spark, raw_dir, out, fail_fast=False, rounds=3, folds=0)
    assert done.features.count() == 10 and done.attributions.count() == 330
    assert len(os.listdir(f"{out}/queries")) == 18 and len(os.listdir(f"{out}/marts")) == 5
    tiers = spark.read.option("header", True).csv(f"{out}/marts/provider_risk_scores").groupBy("risk_tier").count()
    assert sum(r["count"] for r in tiers.collect()) == 10
    stored = read_star(spark, f"{out}/star")
    unified = stored["fact_claims_unified"].count()
    assert unified == sum(stored[f"fact_{k}_claims"].count() for k in ("inpatient", "outpatient"))
    assert spark.read.json(f"{out}/reports/importance").count() == 33
    assert spark.read.json(f"{out}/reports/baselines").count() == 2
    for report in ("raw_metrics", "star_audit"):
        assert spark.read.json(f"{out}/{report}").count() > 5


def test_error_rules_stop_the_load_after_the_report(spark, raw_dir, tmp_path):
    out = str(tmp_path)
    with pytest.raises(DataQualityError, match="death_before_birth"):
        full_run.load(spark, raw_dir, out)
    assert spark.read.json(f"{out}/audit").count() == 34 and not os.path.exists(f"{out}/star")


def test_sample_load(spark, raw_dir, tmp_path):
    out = str(tmp_path)
    full_run.load(spark, raw_dir, out, sample=4, fail_fast=False)
    assert read_star(spark, f"{out}/star")["dim_providers"].count() == 4

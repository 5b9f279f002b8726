"""Provider sampling that keeps the label mix, and the rows that go with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.functions.ordering import hash_order
from adjudica.operators.ranking import hash_ranked


def stratified_sample(labels: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """``n`` labelled providers with the label shares kept; all rows when fewer.

    Yes rows get ``max(1, int(n * yes share))`` places, No rows the others.
    """
    marked = labels.withColumn("_label", F.trim("PotentialFraud"))
    totals = marked.agg(
        F.struct(
            F.count("*").alias("rows"),
            F.count_if(F.col("_label") == "Yes").alias("yes"),
            F.count("_label").alias("labelled"),
        ).alias("t")
    ).scalar()
    ranked = hash_ranked(marked, "Provider", "_label", seed).withColumn("_t", totals)
    yes_places = F.greatest(
        F.lit(1).cast("bigint"),
        F.call_function("div", F.lit(n).cast("bigint") * F.col("_t.yes"), F.col("_t.labelled")),
    )
    places = F.when(F.col("_label") == "Yes", yes_places).when(
        F.col("_label") == "No", F.lit(n) - yes_places
    )
    keep = (F.col("_t.rows") <= n) | (F.col("hash_rank") <= places)
    return ranked.where(keep).select(*labels.columns)


def restrict_claims(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Raw claims of the given providers."""
    return claims.join(providers.select("Provider"), "Provider", "left_semi").select(*claims.columns)


def active_beneficiaries(beneficiaries: DataFrame, inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    """Beneficiaries with at least one claim of either kind."""
    active = inpatient.select("BeneID").union(outpatient.select("BeneID")).distinct()
    return beneficiaries.join(active, "BeneID", "left_semi").select(*beneficiaries.columns)


def sample_raw(raw: dict[str, DataFrame], n: int = 500, seed: int = 42) -> dict[str, DataFrame]:
    """All four raw tables cut down to a stratified provider sample."""
    labels = stratified_sample(raw["labels"], n, seed)
    inpatient = restrict_claims(raw["inpatient"], labels)
    outpatient = restrict_claims(raw["outpatient"], labels)
    return {
        "labels": labels,
        "beneficiary": active_beneficiaries(raw["beneficiary"], inpatient, outpatient),
        "inpatient": inpatient,
        "outpatient": outpatient,
    }


def sample_rows(df: DataFrame, n: int = 1500, seed: int = 42, key: str = "provider_id") -> DataFrame:
    """``n`` rows in md5 order of the key, all rows when there are fewer."""
    return df.orderBy(hash_order(key, seed), key).limit(n)

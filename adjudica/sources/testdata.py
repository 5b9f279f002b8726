"""Claims-shaped raw tables derived from the order tables under test.

Provider = supplier, beneficiary = customer, claim = order line. The text is
plain SQL that other engines run unchanged, so that checks start from the very
same rows. Values are built from whole cents; some cells are missing,
malformed or untrimmed on purpose, and some beneficiaries are left out so that
orphan claims exist. Flagged providers mostly have long stays, with some labels
turned over so that a classifier cannot be perfect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.schema import CONDITIONS

TABLES = ["customer", "supplier", "orders", "lineitem"]
LINES_PER_TASK = 500_000  # as claims some 250 MB while a task sorts them


def _money(cents: str) -> str:
    return (
        f"CAST(CAST(CAST({cents} AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2))"
        " AS DECIMAL(12,2)) AS STRING)"
    )


_LABELS = """
SELECT CASE WHEN s_suppkey % 7 = 0 THEN ' ' ELSE '' END || 'PRV' || CAST(s_suppkey AS STRING) AS Provider,
  CASE WHEN (s_suppkey % 10 = 3) <> (s_suppkey % 17 = 4) THEN 'Yes' ELSE 'No' END
    || CASE WHEN s_suppkey % 11 = 0 THEN ' ' ELSE '' END AS PotentialFraud
FROM supplier
"""

_CHRONIC = ",\n".join(
    f"  CASE WHEN (c_custkey + {i}) % {i + 2} = 0 THEN '1' WHEN c_custkey % 61 = 0 THEN 'NA' ELSE '2' END AS {name}"
    for i, name in enumerate(CONDITIONS)
)

_BENEFICIARY = f"""
SELECT 'BENE' || CAST(c_custkey AS STRING) AS BeneID,
  CAST(DATE '1910-01-01' + CAST((c_custkey * 97) % 25000 AS INT) AS STRING) AS DOB,
  CASE WHEN c_custkey % 50 = 0 THEN CAST(DATE '1910-01-01' + CAST((c_custkey * 97) % 25000 + 20000 AS INT) AS STRING)
       WHEN c_custkey % 333 = 1 THEN '1900-01-01' ELSE 'NA' END AS DOD,
  CAST(c_custkey % 2 + 1 AS STRING) AS Gender,
  CAST(c_custkey % 4 + 1 AS STRING) AS Race,
  CAST(c_nationkey + 1 AS STRING) AS State,
  CAST(c_custkey % 100 AS STRING) AS County,
  CASE WHEN c_custkey % 14 = 0 THEN 'y' WHEN c_custkey % 7 = 0 THEN 'Y' ELSE '0' END AS RenalDiseaseIndicator,
{_CHRONIC},
  CASE WHEN c_custkey % 41 = 0 THEN 'NA' ELSE {_money("abs(acct)")} END AS IPAnnualReimbursementAmt,
  {_money("abs(acct) % 106800")} AS IPAnnualDeductibleAmt,
  {_money("abs(acct) % 77777")} AS OPAnnualReimbursementAmt,
  CASE WHEN c_custkey % 43 = 0 THEN '' ELSE {_money("abs(acct) % 9999")} END AS OPAnnualDeductibleAmt
FROM (SELECT c.*, CAST(round(c_acctbal * 100) AS BIGINT) AS acct FROM customer c) c
WHERE c_custkey % 200 <> 199
"""

_LINES = """
SELECT l.*, o_custkey, CAST(l_shipdate AS DATE) AS ship, CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
  CASE WHEN l_returnflag <> 'R' THEN 0
       WHEN l_suppkey % 10 = 3 THEN CAST(10 + l_partkey % 11 AS INT)
       ELSE CAST(l_partkey % 6 AS INT) END AS stay
FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
"""


def _claims(kind: str) -> str:
    inpatient = kind == "inpatient"
    test = "=" if inpatient else "<>"
    amount = "price % 2000000" if inpatient else "price % 210000"
    deductible = "106800" if inpatient else "(price % 101) * 100"
    stays = (
        """
  CAST(ship AS STRING) AS AdmissionDt,
  CASE WHEN l_partkey % 97 = 0 THEN 'NA' WHEN l_partkey % 89 = 0 THEN '2009-13-40'
       WHEN l_partkey % 83 = 0 THEN CAST(ship - 3 AS STRING) ELSE CAST(ship + stay AS STRING) END AS DischargeDt,"""
        if inpatient
        else ""
    )
    codes = (
        """
  CASE WHEN l_partkey % 40 = 0 THEN 'NA' ELSE 'D' || CAST(l_partkey % 60 AS STRING) END AS ClmAdmitDiagnosisCode,
  CASE WHEN l_partkey % 35 = 0 THEN '' ELSE 'G' || CAST(l_partkey % 45 AS STRING) END AS DiagnosisGroupCode,"""
        if inpatient
        else ""
    )
    procedure = "l_partkey % 4 = 0" if inpatient else "l_partkey % 50 = 0"
    return f"""
SELECT 'BENE' || CAST(o_custkey AS STRING) AS BeneID,
  '{"I" if inpatient else "O"}' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ClaimID,
  CASE WHEN l_partkey % 13 = 0 THEN CAST(ship AS STRING) || ' 00:00:00' ELSE CAST(ship AS STRING) END AS ClaimStartDt,
  CAST(ship + stay AS STRING) AS ClaimEndDt,
  'PRV' || CAST(l_suppkey AS STRING) AS Provider,
  {_money(f"CASE WHEN l_partkey % 20 = 0 THEN 0 ELSE {amount} END")} AS InscClaimAmtReimbursed,
  CASE WHEN l_partkey % 45 = 0 THEN 'NA' ELSE {_money(deductible)} END AS DeductibleAmtPaid,{stays}
  CASE WHEN l_partkey % 25 = 0 THEN 'NA' WHEN l_partkey % 26 = 0 THEN '' ELSE 'PHY' || CAST(l_partkey % 300 AS STRING) END AS AttendingPhysician,
  CASE WHEN l_partkey % 3 = 0 THEN 'PHY' || CAST(l_partkey % 70 AS STRING) ELSE 'NA' END AS OperatingPhysician,
  CASE WHEN l_partkey % 7 = 0 THEN 'PHY' || CAST(l_partkey % 110 AS STRING) ELSE 'nan' END AS OtherPhysician,{codes}
  CASE WHEN l_partkey % 40 = 0 THEN 'NA' ELSE 'D' || CAST(l_partkey % 60 AS STRING) END AS ClmDiagnosisCode_1,
  CASE WHEN {procedure} THEN 'PX' || CAST(l_partkey % 30 AS STRING) ELSE 'NA' END AS ClmProcedureCode_1
FROM ({_LINES}) x WHERE l_returnflag {test} 'R'
"""


RAW_SQL = {
    "labels": _LABELS,
    "beneficiary": _BENEFICIARY,
    "inpatient": _claims("inpatient"),
    "outpatient": _claims("outpatient"),
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw tables over one test-data folder."""
    inputs = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    inputs |= _dealt(inputs["orders"], _spread(inputs["lineitem"]))
    return {
        table: spark.sql(_bound(text), **{n: df for n, df in inputs.items() if _uses(text, n)})
        for table, text in RAW_SQL.items()
    }


def _spread(df: DataFrame) -> DataFrame:
    """Inputs of fewer splits than cores (one small file) are dealt out evenly.

    Real inputs have more splits than cores and pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _dealt(orders: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    """Orders and lines, dealt alike by order where there are many.

    Their join takes this exchange as it is. Its own would be merged to tasks of 64 MB
    of packed lines, which as sorted claims pass a gigabyte and spill.
    """
    tasks = -(-lines.count() // LINES_PER_TASK)
    if tasks > lines.sparkSession.sparkContext.defaultParallelism:
        # The claims read the day only, which is shorter than a time.
        lines = lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date")) if "l_shipdate" in lines.columns else lines
        orders, lines = orders.repartition(tasks, "o_orderkey"), lines.repartition(tasks, "l_orderkey")
    return {"orders": orders, "lineitem": lines}


def _uses(text: str, table: str) -> bool:
    return f"FROM {table}" in text or f"JOIN {table}" in text


def _bound(text: str) -> str:
    for name in TABLES:
        text = text.replace(f"FROM {name}", "FROM {" + name + "}").replace(
            f"JOIN {name}", "JOIN {" + name + "}"
        )
    return text


def _digest_number(*parts) -> Column:
    """First four hex digits of the md5 of the joined parts as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 4), 16, 10).cast("bigint")


def hashed_scores(providers: DataFrame) -> DataFrame:
    """Stand-in scores in thousandths, so that metrics and marts can be checked."""
    return providers.select(
        "provider_id", "potential_fraud",
        ((_digest_number(F.lit("score"), "provider_id") % 1000) / F.lit(1000.0)).alias("probability"),
    )


def hashed_attributions(features: DataFrame, names: list[str]) -> DataFrame:
    """Stand-in attributions (provider_id, feature, value, phi) in thousandths."""
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value")) for n in names])
    return features.select("provider_id", F.inline(pairs)).withColumn(
        "phi", (_digest_number(F.lit("phi"), "provider_id", "feature") % 2001 - 1000) / F.lit(1000.0)
    )


#: A stand-in forest of three small trees, as (tree, id, left, right, feature,
#: cut, value, cover); its cuts part the features of the test tables.
STANDIN_NODES = [
    (0, 0, 1, 2, "total_claims", 510.5, 0.0, 100.0), (0, 1, 3, 4, "inpatient_ratio", 0.3551, 0.0, 50.0),
    (0, 2, 5, 6, "mean_length_of_stay", 2.4613, 0.0, 50.0), (0, 3, -1, -1, None, None, -0.4137, 20.0), (0, 4, -1, -1, None, None, 0.1093, 30.0),
    (0, 5, -1, -1, None, None, 0.2171, 25.0), (0, 6, 13, 14, "total_reimbursed", 2100000.5, 0.0, 25.0),
    (0, 13, -1, -1, None, None, 0.5273, 10.0), (0, 14, -1, -1, None, None, 0.9119, 15.0),
    (1, 0, 1, 2, "total_reimbursed", 2000000.5, 0.0, 100.0), (1, 1, -1, -1, None, None, -0.3231, 45.0),
    (1, 2, 5, 6, "total_claims", 540.5, 0.0, 55.0), (1, 5, -1, -1, None, None, 0.2611, 35.0), (1, 6, -1, -1, None, None, -0.1523, 20.0),
    (2, 0, 1, 2, "mean_patient_age", 66.1, 0.0, 100.0), (2, 1, 3, 4, "total_claims", 480.5, 0.0, 50.0),
    (2, 2, 5, 6, "renal_disease_ratio", 0.1439, 0.0, 50.0), (2, 3, -1, -1, None, None, -0.2047, 10.0), (2, 4, -1, -1, None, None, 0.0589, 40.0),
    (2, 5, -1, -1, None, None, 0.3163, 22.0), (2, 6, -1, -1, None, None, -0.3607, 28.0),
]

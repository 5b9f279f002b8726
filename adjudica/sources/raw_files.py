"""Reading and writing the raw delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adjudica.functions.cleanse import null_tokens

# File name of each raw table.
RAW_FILES = {
    "labels": "Train.csv",
    "beneficiary": "Train_Beneficiarydata.csv",
    "inpatient": "Train_Inpatientdata.csv",
    "outpatient": "Train_Outpatientdata.csv",
}


def read_raw(spark: SparkSession, folder: str, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The raw tables as text columns; every missing-value text is NULL.

    Columns come from the header line, so a table may hold more of them in any
    order. All files of a table must have the same header: Spark compares each
    file's with the first one's, and a file with another order or another column
    stops the read instead of landing in the wrong columns. No types are inferred:
    that would read the whole input twice.
    """
    tables = {}
    for table, name in (files or RAW_FILES).items():
        reader = spark.read.option("header", True).option("nullValue", "NA")
        schema = reader.csv(f"{folder}/{name}").schema
        text = reader.schema(schema).option("enforceSchema", False).csv(f"{folder}/{name}")
        tables[table] = text.select(*[null_tokens(column).alias(column) for column in text.columns])
    return tables


def write_raw(tables: dict[str, DataFrame], folder: str) -> None:
    """Raw tables as header files in the layout ``read_raw`` expects."""
    for table, df in tables.items():
        writer = df.write.mode("overwrite").option("header", True)
        for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
            writer = writer.option(side, False)
        writer.csv(f"{folder}/{RAW_FILES[table]}")

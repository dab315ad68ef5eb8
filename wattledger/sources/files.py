"""CSV reading, run-date loads and saved-file readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from wattledger import schemas
from wattledger.functions.scalars import text_date

# Texts that stand for a missing value in a landed file.
NULL_TEXTS = ["NULL", "null", ""]
_BAD = "_malformed"

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def as_text(schema: StructType) -> StructType:
    """The same columns, all text, plus the slot Spark puts a malformed line in."""
    names = [f.name for f in schema.fields]
    return StructType([StructField(n, StringType()) for n in [*names, _BAD]])


def _null_texts(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TEXTS), c)


def _value(f: StructField) -> Column:
    text = _null_texts(F.col(f.name))
    return text_date(text) if f.dataType.typeName() == "date" else text.try_cast(f.dataType)


def bad_record(schema: StructType) -> Column:
    """True where the line does not fit, a value does not convert or a required one is empty."""
    bad = F.col(_BAD).isNotNull()
    for f in schema.fields:
        bad = bad | (_null_texts(F.col(f.name)).isNotNull() & _value(f).isNull())
        if not f.nullable:
            bad = bad | _value(f).isNull()
    return bad


def read_text(spark: SparkSession, path, schema: StructType) -> DataFrame:
    reader = spark.read.options(**CSV_OPTIONS, columnNameOfCorruptRecord=_BAD)
    return reader.schema(as_text(schema)).csv(path)


def good_rows(raw: DataFrame, schema: StructType) -> DataFrame:
    """Typed rows of a text frame, without the bad records."""
    return raw.filter(~bad_record(schema)).select(
        *[_value(f).alias(f.name) for f in schema.fields]
    )


def read_csv(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """CSV with a header; NULL, null and empty fields are null; bad records are skipped."""
    return good_rows(read_text(spark, path, schema), schema)


def load_schema(table: str) -> StructType:
    fields = {f.name: f for f in schemas.TABLES[table].fields}
    return StructType([fields[c] for c in schemas.LOAD_COLUMNS[table]])


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Table shape with the declared defaults filled in."""
    out = df
    if table in schemas.SOURCE_TAGS:
        tag = F.lit(schemas.SOURCE_TAGS[table])
        have = "data_source" in df.columns
        out = out.withColumn("data_source", F.coalesce("data_source", tag) if have else tag)
    if "created_at" in schemas.TABLES[table].names and "created_at" not in df.columns:
        out = out.withColumn("created_at", F.current_timestamp())
    return schemas.select_typed(out, table)


def run_path(landing: str, run_date) -> str:
    return f"{landing.rstrip('/')}/run_date={run_date}"


def load_raw(spark: SparkSession, landing: str, table: str, run_date) -> DataFrame:
    """Rows of one run date's files in the shape of ``table``; bad records are skipped."""
    rows = read_csv(spark, run_path(landing, run_date), load_schema(table))
    return with_defaults(rows, table)


def rejected(spark: SparkSession, landing: str, table: str, run_date) -> DataFrame:
    """The records :func:`load_raw` skips, as text."""
    schema = load_schema(table)
    raw = read_text(spark, run_path(landing, run_date), schema)
    return raw.filter(bad_record(schema)).select(*[f.name for f in schema.fields])


def load_predictions(spark: SparkSession, landing: str, run_date) -> DataFrame:
    return load_raw(spark, landing, "ml_predictions", run_date)


def check_columns(columns: list[str]) -> None:
    """Raise when a training file lacks a feature or the target."""
    missing = [c for c in schemas.FEATURES if c not in columns]
    if missing:
        raise ValueError(f"Missing required feature columns: {missing}")
    if schemas.TARGET not in columns:
        raise ValueError(f"Missing target column: {schemas.TARGET}")


def read_training(spark: SparkSession, path) -> DataFrame:
    """Training CSV as doubles (and ``date``, when it has one), matched by header name."""
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    check_columns(raw.columns)
    wanted = [*schemas.FEATURES, schemas.TARGET]
    dated = [text_date(F.col("date")).alias("date")] if "date" in raw.columns else []
    return raw.select(
        *dated, *[_null_texts(F.col(c)).try_cast(DoubleType()).alias(c) for c in wanted]
    )


SAVED_GENERATION = StructType(
    [
        StructField("date", StringType()),
        StructField("fuel_type", StringType()),
        StructField("generation_mwh", DoubleType()),
        StructField("respondent", StringType()),
    ]
)


def load_saved_generation(spark: SparkSession, path) -> DataFrame:
    """Saved generation CSV; a time of day in the date column is cut off."""
    rows = read_csv(spark, path, SAVED_GENERATION)
    return rows.withColumn("date", text_date(F.col("date")))

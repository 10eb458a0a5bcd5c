"""Files to DataFrames, with the schema stated and the contract checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.operators.contracts import ContractError, require_rows


SCHEMA_TEXT = {
    "raw_sales": "`Order Date` string, Segment string, Product string, Region string, Subregion string, "
    "Sales double, Profit double, Quantity int",
    "deals": "deal_id string, stage string, close_date string, arr double, rep_name string, account_name string",
    "activity": "deal_id string, activity_type string, activity_date string, contact_role string",
    "transcripts": "deal_id string, call_date string, call_num int, turn_num int, speaker string, turn_text string",
    "emails": "deal_id string, `from` string, `to` string, subject string, body string, timestamp string",
    "opportunities": "opportunity_id string, segment string, account_name string, arr double, stage string, "
    "win_loss_reason string",
    "bookings": "opportunity_id string, segment string, quarter string, booked_arr double, "
    "benchmark_growth_pct double, actual_growth_pct double",
}

# Columns each table must bring; the others may be absent.
REQUIRED = {
    "deals": ("deal_id", "stage", "close_date", "arr", "rep_name", "account_name"),
    "activity": ("deal_id", "activity_type", "activity_date", "contact_role"),
    "transcripts": ("deal_id", "call_date", "call_num", "turn_num", "speaker", "turn_text"),
    "emails": ("deal_id", "body", "timestamp"),
    "opportunities": ("opportunity_id", "segment", "arr", "stage", "win_loss_reason"),
    "bookings": ("opportunity_id", "segment", "quarter", "booked_arr"),
}


def with_ordinal(df: DataFrame) -> DataFrame:
    """Adds ``ordinal``: unique, and rising with the place in the file."""
    return df.withColumn("ordinal", F.monotonically_increasing_id())


def read_csv(spark: SparkSession, path: str, table: str, multi_line: bool | None = None) -> DataFrame:
    """A CRM export by header name.  The header is read first, so a missing column is named.

    Columns the table does not know are left out; an absent optional one is left
    out too.  E-mail bodies may hold line breaks inside quotes, so e-mails are read
    with ``multi_line``, one task per file; other tables split within files.
    """
    lines = table == "emails" if multi_line is None else multi_line
    options = {"header": True, "multiLine": lines, "escape": '"'}
    header = spark.read.options(**options).csv(path).columns
    missing = [name for name in REQUIRED[table] if name not in header]
    if missing:
        raise ContractError(f"{path} missing columns: {', '.join(missing)}")
    known = {f.name: f.dataType for f in T.StructType.fromDDL(SCHEMA_TEXT[table])}
    schema = T.StructType([T.StructField(name, known.get(name, T.StringType())) for name in header])
    rows = with_ordinal(spark.read.options(**options).schema(schema).csv(path))
    return require_rows(rows.select(*(f"`{name}`" for name in header if name in known), "ordinal"))


def read_json_array(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Call transcripts from a JSON array; ``lines`` reads one record per line, which splits over tasks.

    A call or turn number that is no whole number becomes null.
    """
    if not lines:
        # One character of the first line that has any: a minified file is a single line.
        sign = F.substring(F.ltrim(F.col("value")), 1, 1).alias("sign")
        first = spark.read.text(path).select(sign).filter("sign != ''").first()
        if first is None or first["sign"] != "[":
            raise ContractError(f"{path} must be a JSON array")
    known = T.StructType.fromDDL(SCHEMA_TEXT["transcripts"])
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in known])
    rows = spark.read.schema(text).option("multiLine", not lines).option("mode", "FAILFAST").json(path)
    typed = rows.withColumns({c: F.col(c).try_cast("int") for c in ("call_num", "turn_num")})
    return with_ordinal(typed)


def land_csv(spark: SparkSession, path: str, table_path: str, infer: bool = False) -> DataFrame:
    """Replaces the raw table with the file and returns the table; an empty file is an error.

    The schema is stated; with ``infer`` the column types are taken from the data, at the
    cost of a second read.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if infer:
        rows = reader.option("inferSchema", True).csv(path)
    else:
        rows = reader.schema(T.StructType.fromDDL(SCHEMA_TEXT["raw_sales"])).csv(path)
    require_rows(rows)
    rows.write.mode("overwrite").parquet(table_path)
    return spark.read.parquet(table_path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; checks and models read only the columns they name."""
    return spark.read.parquet(path)

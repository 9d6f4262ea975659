"""Readers and writers: raw CSV or parquet, seeds, extracts, marts, bundles."""

from __future__ import annotations

import datetime as dt
import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recurra.functions.dates import month_key
from recurra.sources.schemas import EXTRACT_ALIASES, EXTRACTS, RAW, SEEDS


def scratch(spark: SparkSession) -> str:
    """The session's shared checkpoint folder. Only a local session may go without: its one process shares any folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return sc.getCheckpointDir()


def read_raw(spark: SparkSession, path: str, entity: str, fmt: str = "csv") -> DataFrame:
    """One raw entity as text columns, from CSV (header) or parquet. Blank cells are NULL."""
    schema = RAW[entity]
    if fmt == "parquet":
        return spark.read.parquet(path).select(*[F.col(c).cast("string") for c in schema.names])
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', enforceSchema=False)


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Typed lookup; commas inside quotes stay in the cell."""
    return spark.read.csv(path, schema=SEEDS[name], header=True, quote='"', escape='"', enforceSchema=False)


def by_month(df: DataFrame, date: str) -> DataFrame:
    """Rows dealt by the month of ``date``, which ``write_mart`` then finds in ``month_key_part``."""
    return df.withColumn("month_key_part", month_key(F.col(date))).hint("rebalance", F.col("month_key_part"))


def write_mart(
    df: DataFrame, path: str, mode: str = "overwrite", month_of: str | None = None, watch: dict[str, Column] | None = None,
    columns: list[str] | None = None,
) -> dict[str, int]:
    """S3: write a mart as parquet, by month folder when ``month_of`` names a date column.

    Rows are rebalanced by month first, unless ``by_month`` did so before the wide columns were made: few tasks write each folder,
    and adaptive execution cuts a heavy month into several files and joins light ones. ``watch``
    holds aggregates that are gathered from the rows as they pass (and returned);
    ``columns`` says which columns are written after that.
    """
    seen = Observation()
    if watch:
        df = df.observe(seen, *[c.alias(n) for n, c in watch.items()])
    df = df.select(*columns) if columns else df
    if month_of is None:
        df.write.mode(mode).parquet(path)
    else:
        dealt = df if "month_key_part" in df.columns else by_month(df, month_of)
        dealt.write.mode(mode).partitionBy("month_key_part").parquet(path)
    return dict(seen.get) if watch else {}


def write_ledger(spark: SparkSession, path: str, table: str, rows: int, fingerprint: int, as_of: dt.datetime | None) -> None:
    """One line about a written table, in a folder of its own: a later write replaces it."""
    line = [(rows, fingerprint, as_of)]
    spark.createDataFrame(line, "rows long, fingerprint long, as_of timestamp").coalesce(1).write.mode("overwrite").parquet(f"{path}/table={table}")


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a dataset to SQL."""
    df.createOrReplaceTempView(name)
    return df


def read_mart_extract(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Typed import of one of the six mart extracts."""
    return spark.read.csv(path, schema=EXTRACTS[table], header=True, enforceSchema=False)


def to_extract(mart: DataFrame, table: str) -> DataFrame:
    """The extract's columns and types, taken from the mart of the same name."""
    alias = EXTRACT_ALIASES.get(table, {})
    return mart.select(
        *[F.col(alias.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in EXTRACTS[table].fields]
    )


_FRACTION = r"^-?\d*\.\d+$"
_ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
# What a cell can be; a column's kinds add up to a mask.
BOOLEAN, WHOLE, FRACTION, DAY, TEXT = 1, 2, 4, 8, 16


def cell_kind(v: Column) -> Column:
    """Kind of one non-empty cell. The first character decides whether numbers and days are tried at all, and only cells with a
    point or a dash inside meet a regular expression."""
    number = F.substring(v, 1, 1).isin(*"0123456789-.")
    digits = F.when(v.startswith("-"), F.substr(v, F.lit(2))).otherwise(v)
    whole = (F.length(digits) > 0) & (F.length(F.translate(digits, "0123456789", "")) == 0)
    return (
        F.when(~number, F.when(F.lower(v).isin("true", "false"), BOOLEAN).otherwise(TEXT))
        .when(whole, F.when(v.try_cast("bigint").isNotNull(), WHOLE).otherwise(FRACTION))
        .when(v.contains("."), F.when(v.rlike(_FRACTION), FRACTION).otherwise(TEXT))
        .when(v.rlike(_ISO_DAY) & F.try_to_date(v, "yyyy-MM-dd").isNotNull(), DAY)
        .otherwise(TEXT)
    )


def profile_columns(df: DataFrame) -> dict[str, str]:
    """S6, first half: the narrowest type that every non-empty cell of each column fits.

    One aggregate over all columns, one number a column; a column of mixed kinds stays text. Whole numbers
    mixed with fractions make a double.
    """
    kinds = [F.bit_or(F.when(F.col(f"`{c}`") != "", cell_kind(F.col(f"`{c}`")))).alias(f"k{i}") for i, c in enumerate(df.columns)]
    masks = df.agg(*kinds).first()
    named = {BOOLEAN: "boolean", DAY: "date", WHOLE: "bigint", FRACTION: "double", WHOLE | FRACTION: "double"}
    return {c: named.get(mask, "string") for c, mask in zip(df.columns, masks, strict=True)}


def coerce_columns(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Text columns typed by their values; empty cells become NULL."""
    types = types or profile_columns(df)

    def typed(c: str):
        v = F.nullif(F.col(c), F.lit(""))
        return {"string": v, "boolean": F.lower(v).cast("boolean")}.get(types[c], v.try_cast(types[c])).alias(c)

    return df.select(*[typed(c) for c in df.columns])


def export_marts(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """Every table as one headed CSV folder under ``folder``."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
    return [f"{folder}/{name}" for name in tables]


def fingerprints(df: DataFrame, table: str) -> DataFrame:
    """Per column of a table in plain types: rows, filled cells, and a sum of hashes that does not depend on their order.

    Numbers count to four decimals. One pass and one row per task; two tables agree in a column's line if it holds the same
    values equally often.
    """
    def cell(f: T.StructField):
        c = F.col(f"`{f.name}`")
        text = F.round(c * 10000).cast("bigint").cast("string") if isinstance(f.dataType, T.DoubleType) else c.cast("string")
        return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")

    fields = [f for f in df.schema.fields if f.name not in ("_generated_at", "month_key_part")]
    sums = [F.coalesce(F.sum(cell(f)), F.lit(0)).alias(f"h{i}") for i, f in enumerate(fields)]
    counts = [F.count(f"`{f.name}`").alias(f"n{i}") for i, f in enumerate(fields)]
    lines = [
        F.struct(F.lit(f.name).alias("column"), F.col("rows"), F.col(f"n{i}").alias("filled"), F.col(f"h{i}").alias("fingerprint"))
        for i, f in enumerate(fields)
    ]
    return df.agg(F.count(F.lit(1)).alias("rows"), *sums, *counts).select(F.lit(table).alias("table"), F.inline(F.array(*lines)))


def plain_types(df: DataFrame) -> DataFrame:
    """Exchange form: decimals as double, counts as bigint, dates and timestamps as ISO text."""
    def form(f: T.StructField) -> str:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.DecimalType):
            return f"cast({name} as double) as {name}"
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return f"cast({name} as bigint) as {name}"
        if isinstance(f.dataType, T.DateType):
            return f"cast({name} as string) as {name}"
        if isinstance(f.dataType, T.TimestampType):
            return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss') as {name}"
        return name

    return df.selectExpr(*[form(f) for f in df.schema.fields])

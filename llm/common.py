"""Helpers shared by the operators: reading tables, shared scratch folder, stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_own: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their workers can import it from anywhere, and
    keep batches of texts small: the defaults of 10,000 rows and 64 MB a batch take tens of MB in each task, on both sides."""
    app = spark.sparkContext.applicationId
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "1000")
    if spark.conf.get(BATCH_BYTES) == "67108864b":
        spark.conf.set(BATCH_BYTES, str(8 << 20))
    if app not in _shipped:
        _shipped.add(app)
        path = Path(tempfile.mkdtemp(prefix="llm-")) / "llm.zip"
        with zipfile.ZipFile(path, "w") as out:
            for source in sorted(Path(__file__).parent.glob("*.py")):
                out.write(source, f"llm/{source.name}")
        spark.sparkContext.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, ``spark.checkpoint.dir``. Only a local session may go without."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="llm-"))


def stored(df: DataFrame, label: str, block_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once into a new folder of the shared scratch space and read it back: cuts lineage, survives lost executors.
    Small row groups (``block_bytes``) keep the buffers of long rows small."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.option("parquet.block.size", block_bytes) if block_bytes else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


HOT_KEYS = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of ``groups`` (one row per ``key``; ``size`` is how many rows have it; NULL where there is none).

    Keys held by more than one in ``HOT_KEYS`` of the rows are fewer than that and are looked up by broadcast, so their rows stay
    where they are; only the others meet by key in a shuffle."""
    groups = stored(groups, "groups")
    most = max(1000, (groups.agg(F.sum(size)).first()[0] or 0) // HOT_KEYS)
    columns = [c for c in groups.columns if c not in (key, size)]
    hot = groups.where(F.col(size) > most).select(F.col(key).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in columns])
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_away", F.monotonically_increasing_id())
    spread = F.when(F.col("_hot").isNotNull(), F.col("_away")).otherwise(F.lit(-1))
    cold = groups.where(F.col(size) <= most).select(F.col(key).alias("_cold"), F.lit(-1).cast("long").alias("_spread"), *[F.col(c).alias(f"_cold_{c}") for c in columns])
    joined = marked.withColumn("_away", spread).join(cold, (F.col(key) == F.col("_cold")) & (F.col("_away") == F.col("_spread")), "left")
    return joined.select(*rows.columns, *[F.when(F.col("_hot").isNotNull(), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in columns])

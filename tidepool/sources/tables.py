"""Table scans and table sinks.

Tables are directories of Parquet by default; ``fmt`` switches to any
DataSource format the session has (``delta`` when its jar is present).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class TableNotFound(FileNotFoundError):
    """The table path holds no readable table."""


def driver_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one of the driver's Parquet tables; naming ``columns`` prunes the read schema."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


SPREAD = "spark.tidepool.spread"


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan to as many partitions as the session setting ``spark.tidepool.spread`` says.

    For CPU-heavy per-row work on tables that come as one file of one row group,
    which Spark cannot split.  Unset, as on tables of many files, nothing is shuffled.
    """
    partitions = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(partitions)) if partitions else df


def deal(df: DataFrame) -> DataFrame:
    """``spread`` that deals to ``spark.sql.shuffle.partitions`` partitions where its setting is unset.

    For steps whose work on a row costs far more than moving it: the tasks of a scan are no
    more than the row groups and may differ much in size.
    """
    conf = df.sparkSession.conf
    return df.repartition(int(conf.get(SPREAD, None) or conf.get("spark.sql.shuffle.partitions")))


def scan(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Snapshot scan of a table."""
    return spark.read.format(fmt).load(path)


def guarded_scan(spark: SparkSession, path: str, fmt: str = "parquet",
                 hint: str = "run the stage that writes it first") -> DataFrame:
    """S7 with a clear error when the table is missing.

    Asks the DataSource itself (works on object stores too), not ``os.path``.
    """
    try:
        df = spark.read.format(fmt).load(path)
        df.schema  # noqa: B018  (forces file listing)
        return df
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            raise TableNotFound(f"table not found at {path}: {hint}") from err
        raise


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite table sink."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Schema-checked append sink (S11): refuses undeclared or retyped columns."""
    from tidepool.operators.silver import conform_to_schema
    spark = df.sparkSession
    try:
        target = spark.read.format(fmt).load(path).schema
    except AnalysisException:
        df.write.mode("append").format(fmt).save(path)
        return
    conform_to_schema(df, target).write.mode("append").format(fmt).save(path)


def add_new_by_key(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``existing`` (re-adding an id is a no-op).

    A left-anti join on the key; appending its result keeps the table keyed.
    """
    return new.join(existing.select(*keys), keys, "left_anti")


def append_new_by_key(new: DataFrame, path: str, keys: list[str], fmt: str = "parquet") -> int:
    """S13 as a sink: append only unseen keys; returns how many rows were added."""
    spark = new.sparkSession
    try:
        existing = spark.read.format(fmt).load(path)
    except AnalysisException:
        new.write.mode("append").format(fmt).save(path)
        return spark.read.format(fmt).load(path).count()
    fresh = add_new_by_key(existing, new, keys)
    from tidepool.session import scratch_path
    staged = scratch_path(spark, "append-stage")
    fresh.write.format(fmt).save(staged)   # decided before the target changes
    staged_df = spark.read.format(fmt).load(staged)
    n = staged_df.count()
    staged_df.write.mode("append").format(fmt).save(path)
    return n

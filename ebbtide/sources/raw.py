"""Raw and staged data: format choice, declared or inferred schemas, staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ebbtide.operators.quality import duplicate_rows, profile

# Formats in order of preference when a folder holds several.
FORMATS = ("csv", "parquet")


def _matching(spark: SparkSession, folder: str, extension: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{folder.rstrip('/')}/*.{extension}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def find_raw_data(spark: SparkSession, folder: str) -> str | None:
    """Glob of all files of the preferred format present in the folder, on any supported file system."""
    for extension in FORMATS:
        if _matching(spark, folder, extension):
            return f"{folder.rstrip('/')}/*.{extension}"
    return None


def load_raw_data(
    spark: SparkSession, path: str, schema: StructType | str | None = None, infer_schema: bool = False
) -> DataFrame:
    """Read CSV (with a header) or Parquet by file extension; a schema is declared rather than inferred."""
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension not in FORMATS:
        raise ValueError(f"unsupported file format: .{extension}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if extension == "csv":
        if schema is None:
            reader = reader.option("inferSchema", str(infer_schema).lower())
        return reader.option("header", "true").csv(path)
    return reader.parquet(path)


def save_staging_data(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def load_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_features(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write the feature table; name a snapshot column to keep several observation dates side by side.

    A partitioned write replaces only the snapshots present in ``df``.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def ingest(
    spark: SparkSession,
    staging_path: str,
    raw_file: str | None = None,
    raw_folder: str | None = None,
    schema: StructType | str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw to staging; returns the staged frame, its column profile and its duplicate-row count.

    The checks read the staged Parquet, so the raw files are parsed once.
    """
    path = raw_file or (find_raw_data(spark, raw_folder) if raw_folder else None)
    if path is None:
        raise FileNotFoundError(f"no CSV or Parquet file in {raw_folder}")
    save_staging_data(load_raw_data(spark, path, schema, infer_schema=schema is None), staging_path)
    staged = spark.read.parquet(staging_path)
    return staged, profile(staged), duplicate_rows(staged)

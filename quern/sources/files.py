"""Reading texts as records, and writing results in all formats; stages whose results are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_texts(spark: SparkSession, paths: list[str], delimiter: str | None = None, column: str = "text") -> DataFrame:
    """A row for each record of the files, which the delimiter ends (a line break by default); blank records go, repeated paths count once."""
    reader = spark.read if delimiter is None else spark.read.option("lineSep", delimiter)
    return reader.text(sorted(set(paths))).where(F.trim("value") != "").withColumnRenamed("value", column)


def with_ids(docs: DataFrame, name: str = "doc_id") -> DataFrame:
    """docs with ids of their own, not gapless; they follow the partitions, so a result that refers to them must be written first."""
    return docs.select(F.monotonically_increasing_id().alias(name), "*")


def write(
    df: DataFrame, path: str, form: str = "parquet", compression: str | None = None, partition_by: list[str] | None = None, line_sep: str | None = None,
    most_records: int | None = None, partitions: int | None = None, mode: str = "overwrite",
) -> None:
    """A folder of files. Parquet is zstd-compressed unless said otherwise; text needs one string column; CSV doubles quotes within fields.

    most_records bounds the rows of a file. partitions is the number of files at most; it is lowered without a shuffle.
    """
    if partitions and df.rdd.getNumPartitions() > partitions:
        df = df.coalesce(partitions)
    writer = df.write.format(form).mode(mode)
    if compression or form == "parquet":
        writer = writer.option("compression", compression or "zstd")
    if form == "csv":
        writer = writer.option("escape", '"')
    if line_sep is not None:
        writer = writer.option("lineSep", line_sep)
    if most_records:
        writer = writer.option("maxRecordsPerFile", most_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished result lies there; what a broken run left isn't one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def kept(spark: SparkSession, path: str, make: Callable[[], DataFrame], **how) -> DataFrame:
    """The result of a stage: read where it has been finished before, else made and written."""
    if not exists(spark, path):
        write(make(), path, **how)
    return spark.read.parquet(path)

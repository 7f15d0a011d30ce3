"""Writers: CSV, Parquet, catalog tables and small single-file exports."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Fixed value: more folders than splits have names for.
SPLITS_AT_ONCE = 8

# Options of gzipped text: the level that costs the least time.
FAST_GZIP = {"zlib.compress.level": "BEST_SPEED"}


def write_lines(df: DataFrame, path: str) -> None:
    """Write a frame of one text column as gzipped lines."""
    df.write.options(compression="gzip", **FAST_GZIP).text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace the folder with gzipped CSV files of about the advisory partition size of text.

    A file with quoted line breaks is read by one task, so files are bounded by their bytes:
    rows are measured first, and each task writes as many files as it has text for. No row
    is shuffled; ``df`` is computed twice.
    """
    spark = df.sparkSession
    size = sum((F.coalesce(F.octet_length(F.col(_quoted(c)).cast("string")), F.lit(0)) + 1 for c in df.columns), F.lit(0))
    place = F.shiftright(F.monotonically_increasing_id(), 33)
    widths = df.select(size.alias("size"), place.alias("part")).groupBy("part").agg(F.avg("size").alias("width"))
    widest = widths.agg(F.max("width").alias("width")).first()["width"]
    advised = spark._jsparkSession.sessionState().conf().getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    _write_csv(df, path, max(1, int(_bytes(spark, advised) / (widest or 1))), "gzip")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _bytes(spark: SparkSession, size: str) -> int:
    """The number of bytes that a setting such as ``64MB`` stands for."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def _write_csv(df: DataFrame, path: str, rows: int = 0, compression: str = "none") -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("maxRecordsPerFile", rows)
        .options(compression=compression, **FAST_GZIP)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, compression: str = "zstd") -> None:
    """Replace the folder with a Parquet copy of the whole frame; zstd keeps texts smaller than Snappy."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored folder from which nothing is read any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_vectors(df: DataFrame, path: str) -> None:
    """Vectors and plain columns as gzipped JSON, in which a vector is the struct of its parts."""
    df.write.options(compression="gzip", **FAST_GZIP).json(path)


def read_vectors(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of ``write_vectors`` by the written schema, with vectors as structs of their parts.

    Stating the schema saves a pass that would look for it in all lines.
    """
    parts = [
        StructField(f.name, f.dataType.sqlType() if isinstance(f.dataType, VectorUDT) else f.dataType) for f in schema
    ]
    return spark.read.schema(StructType(parts)).json(path)


def write_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Replace a result table and return it as read back from storage.

    Reading back keeps later uses from computing the query again.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_single_csv(df: DataFrame, path: str) -> str:
    """Write a result that is small by construction as one CSV file and return its path.

    Meant for top-N lists and for one row per class or month: the last step runs
    in one task. The result is computed in parallel and stored first. Use
    ``write_csv`` for everything whose size follows the data.
    """
    spark, rows, folder = df.sparkSession, path + ".rows", path + ".parts"
    write_parquet(df, rows)
    _write_csv(spark.read.parquet(rows).coalesce(1), folder)
    return _rename_part(spark, folder, path, rows)


def _rename_part(spark: SparkSession, folder: str, path: str, rows: str) -> str:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    source, target = hadoop(folder), hadoop(path)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = fs.globStatus(hadoop(folder + "/part-*.csv"))[0].getPath()
    fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(source, True)
    fs.delete(hadoop(rows), True)
    return path


def write_split(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a frame with a ``split`` column as one folder per split, in one pass.

    Parquet keeps vector positions. JSON does not keep the vector type, so it is
    meant for frames of plain columns; it is gzipped. A task keeps a file of each split
    open, so rows are not sorted by it.
    """
    with open_writers(df.sparkSession, SPLITS_AT_ONCE):
        writer = df.write.mode("overwrite").partitionBy("split").format(fmt)
        (writer.options(compression="gzip", **FAST_GZIP) if fmt == "json" else writer).save(path)


@contextmanager
def open_writers(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes by folders keep so many files open in a task; only beyond that are rows sorted."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_split(
    spark: SparkSession, path: str, split: str, schema: StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The rows of one split; the other folders are not read."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).filter(F.col("split") == split)

"""Files in and out: JSON lines in shards, CSV, and slices of a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_json_lines(df: DataFrame, path: str, rows: int = 100_000) -> None:
    """Gzipped JSON lines, at most ``rows`` a shard."""
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", rows).json(path)


def read_json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """RFC 4180 quoting, line ends inside quotes; codes keep their leading zeros through the schema."""
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)


def replace_slices(df: DataFrame, path: str, column: str) -> None:
    """Writes a partitioned table, replacing only the slices that ``df`` has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_json_document(df: DataFrame, path: str, head: str, tail: str) -> None:
    """One JSON document in one file: ``head``, which ends inside an array after an element, a comma and the JSON of each row's only column, ``tail``.

    The parts are written by all tasks; the driver's JVM streams them one after another.
    """
    from pyspark.sql import functions as F

    spark = df.sparkSession
    df.select(F.concat(F.lit(","), F.to_json(df.columns[0])).alias("value")).write.text(f"{path}-parts")
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    folder = hadoop.fs.Path(f"{path}-parts")
    fs = folder.getFileSystem(conf)
    out = fs.create(hadoop.fs.Path(f"{path}/document.json"), True)
    try:
        out.write(bytearray(head.encode()))
        for name in sorted(x.getPath().getName() for x in fs.listStatus(folder)):
            if name.startswith("part-"):
                part = fs.open(hadoop.fs.Path(folder, name))
                hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                part.close()
        out.write(bytearray(tail.encode()))
    finally:
        out.close()
    fs.delete(folder, True)


def bytes_of(spark: SparkSession, path: str) -> int:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def delete_slice(spark: SparkSession, path: str, column: str, value: str) -> bool:
    """Removes one slice of a partitioned table; the others are not touched.  Says whether it was there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

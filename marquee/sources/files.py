"""Readers for catalogue files and event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas
from marquee.functions.parsing import strip

REJECTED = "_rejected"
ORDER = "_order"


def _input_order() -> F.Column:
    """Sorts rows as they stand in their file, files by path."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(ORDER)


def _csv(spark: SparkSession, path: str, schema: T.StructType, header: bool, multi_line: bool) -> DataFrame:
    """``multi_line`` allows line breaks inside quotes, but keeps a file in one
    task; turn it off to split large files."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
    )


def read_titles(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.TITLES_FILE,
    header: bool = True,
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a strict CSV file.

    A row with too many or too few fields is a reject; it keeps its whole text.
    """
    checked = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    read = _csv(spark, path, checked, header, multi_line).select("*", _input_order())
    rows = read.filter(F.col(REJECTED).isNull()).drop(REJECTED)
    rejects = read.filter(F.col(REJECTED).isNotNull()).select(*schema.names[:2], REJECTED, ORDER)
    return rows, rejects


def require_no_rejects(rejects: DataFrame) -> None:
    """Raise an error that names the first few rejected rows."""
    found = [row[REJECTED] for row in rejects.orderBy(ORDER).limit(5).collect()]
    if found:
        raise ValueError("wrong number of fields, starting with: " + " | ".join(found))


def read_pack(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """A plain CSV file; short rows are filled with NULL."""
    return _csv(spark, path, schema, header, multi_line).select("*", _input_order())


def parse_users_dat(lines: DataFrame) -> DataFrame:
    """Split ``value`` on ``::``; lines without exactly five fields are skipped."""
    parts = F.split(strip(F.col("value")), "::", -1)
    kept = lines.withColumn("_parts", parts).filter(F.size("_parts") == 5)
    fields = [F.col("_parts")[i].alias(name) for i, name in enumerate(schemas.USERS_DAT.names)]
    return kept.select(*fields, *[name for name in lines.columns if name != "value"])


def read_users_dat(spark: SparkSession, path: str) -> DataFrame:
    return parse_users_dat(spark.read.text(path).select("value", _input_order()))


def read_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
    format: str = "parquet",
    **kafka_options: str,
) -> DataFrame:
    """An event stream from a folder of files, or from a Kafka topic.

    With ``format="kafka"``, ``source`` is the topic and values are JSON with
    the fields of ``schema``. That form needs the Kafka package on the class
    path and is not covered by the tests.
    """
    if format == "kafka":
        records = spark.readStream.format("kafka").option("subscribe", source).options(**kafka_options).load()
        value = F.from_json(F.col("value").cast("string"), schema)
        return records.select(value.alias("value"), F.col("offset").alias("seq")).select("value.*", "seq")
    reader = spark.readStream.schema(schema).format(format)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source)

"""Log streams: JSON records to typed rows in an hour-partitioned table.

The parsers are plain projections, so the same function serves a stream and a
batch. There is no state and no shuffle; exactly-once delivery comes from the
checkpointed source offsets together with the sink's commit log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.schemas import DATABASE_LOG, LOG_PARTITIONS, NETWORK_LOG
from tidewell.sources.lake import path_exists

TRIGGER = "30 seconds"
REJECTED = "rejected"
_CORRUPT = "_corrupt_record"


def parse_logs(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse the JSON documents in column ``data`` and add the event time and its partition columns.

    Parsing never fails: a bad document, field or time gives NULLs; see
    ``judged_logs`` for what to do with such records.
    """
    return judged_logs(records, schema).drop(REJECTED)


def judged_logs(records: DataFrame, schema: T.StructType) -> DataFrame:
    """As ``parse_logs``, with the text of each record that does not fit in column ``rejected``, else NULL.

    A record fits if it is a JSON document, each of its fields has the declared
    type and range, and its time can be read.
    """
    text = F.col("data").cast("string")
    with_text = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(text, with_text, {"columnNameOfCorruptRecord": _CORRUPT})
    when = F.col("event_timestamp")
    fields = records.select(text.alias("_data"), parsed.alias("record")).select("_data", "record.*")
    timed = fields.withColumn("event_timestamp", F.try_to_timestamp("timestamp"))
    bad = F.col(_CORRUPT).isNotNull() | when.isNull()
    return timed.select(
        *[F.col(f"`{name}`") for name in schema.names], when,
        F.year(when).alias("year"), F.month(when).alias("month"), F.dayofmonth(when).alias("day"),
        F.hour(when).alias("hour"), F.when(bad, F.coalesce("_data", F.lit(""))).alias(REJECTED))


def parse_database_logs(records: DataFrame) -> DataFrame:
    return parse_logs(records, DATABASE_LOG)


def parse_network_logs(records: DataFrame) -> DataFrame:
    return parse_logs(records, NETWORK_LOG)


def split_valid(logs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of judged logs, the rows that fit; and the text of the others, to be replayed once mended."""
    fits = F.col(REJECTED).isNull()
    return logs.filter(fits).drop(REJECTED), logs.filter(~fits).select(F.col(REJECTED).alias("data"))


def as_records(logs: DataFrame, schema: T.StructType) -> DataFrame:
    """The raw form of log rows: one JSON document per row in column ``data``."""
    return logs.select(F.to_json(F.struct(*[F.col(f"`{name}`") for name in schema.names])).alias("data"))


def read_records(spark: SparkSession, source: str = "text", path: str | None = None, **options) -> DataFrame:
    """A stream with a ``data`` column from files, or from any connector on the classpath.

    Connectors such as Kafka deliver their payload in ``value``; one that
    already has ``data`` keeps it. Kafka starts at the earliest retained record.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    for name, value in options.items():
        reader = reader.option(name, value)
    stream = reader.load(path) if path else reader.load()
    return stream if "data" in stream.columns else stream.withColumnRenamed("value", "data")


def create_log_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None,
                     provider: str = "parquet") -> None:
    """Declare the stored log table once; ``provider='iceberg'`` where its jar is installed."""
    derived = ["event_timestamp TIMESTAMP", *[f"`{column}` INT" for column in LOG_PARTITIONS]]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields] + derived
    settings = {"iceberg": "TBLPROPERTIES ('format-version'='2', 'write.parquet.compression-codec'='snappy')",
                "parquet": "OPTIONS ('compression'='snappy')"}.get(provider, "")
    where = f"LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {provider} {settings} "
        f"PARTITIONED BY ({', '.join(LOG_PARTITIONS)}) {where}"
    )


def write_log_stream(logs: DataFrame, checkpoint: str, path: str | None = None, table: str | None = None,
                     provider: str = "parquet", available_now: bool = False) -> StreamingQuery:
    """Append the stream to the log table every 30 seconds, or drain what is there and stop.

    Rows stay in the task that read them (no shuffle on the hour, which would
    send a busy hour to one task); Parquet writers sort by partition instead.
    """
    writer = (
        logs.writeStream.format(provider).outputMode("append").option("checkpointLocation", checkpoint)
        .partitionBy(*LOG_PARTITIONS)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)
    if path:
        writer = writer.option("path", path)
    if provider == "iceberg":
        writer = writer.option("fanout-enabled", "true")
    return writer.toTable(table) if table else writer.start()


def write_quarantine(rejected: DataFrame, checkpoint: str, path: str, available_now: bool = False) -> StreamingQuery:
    """Append the rejected records' text to a folder of its own, one record per row in column ``data``."""
    writer = rejected.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)
    return writer.start(path)


FITS = "fits"
BATCH = "batch"


def write_split_batch(judged: DataFrame, batch: int, path: str, spread: int = 1) -> None:
    """Write one micro-batch of judged logs in one pass: rows that fit by hour, and the text of the others beside them.

    The directories end in the number of the batch, so writing a batch again replaces what it wrote before and adds
    nothing twice. Rows of an hour come together in ``spread`` files; raise it where a batch holds a very busy hour.
    """
    fits = F.col(REJECTED).isNull()
    placed = judged.withColumns({
        **{name: F.when(fits, F.col(name)) for name in LOG_PARTITIONS}, FITS: fits.cast("int"), BATCH: F.lit(batch)})
    salt = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in judged.columns]), F.lit(spread))
    (
        placed.repartition(*LOG_PARTITIONS, FITS, salt).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        .partitionBy(FITS, *LOG_PARTITIONS, BATCH).parquet(path)
    )


def write_split_stream(judged: DataFrame, checkpoint: str, path: str, available_now: bool = False,
                       spread: int = 1) -> StreamingQuery:
    """One stream into two tables below ``path``; the source is read once. See ``read_valid`` and ``read_rejected``."""
    writer = judged.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda rows, batch: write_split_batch(rows, batch, path, spread))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)
    return writer.start()


def _split_schema(schema: T.StructType) -> T.StructType:
    derived = [T.StructField("event_timestamp", T.TimestampType()),
               *[T.StructField(name, T.IntegerType()) for name in LOG_PARTITIONS]]
    return T.StructType([*schema.fields, *derived, T.StructField(REJECTED, T.StringType()),
                         T.StructField(FITS, T.IntegerType()), T.StructField(BATCH, T.IntegerType())])


def _split_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], _split_schema(schema))
    return spark.read.schema(_split_schema(schema)).parquet(path)


def read_valid(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The hour table of a split stream; empty before its first batch."""
    found = _split_table(spark, path, schema).filter(F.col(FITS) == 1)
    return found.select(*[F.col(f"`{name}`") for name in schema.names], "event_timestamp", *LOG_PARTITIONS)


def read_rejected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The text of the records that did not fit, in column ``data``, with the batch they came in."""
    return _split_table(spark, path, schema).filter(F.col(FITS) == 0).select(F.col(REJECTED).alias("data"), BATCH)

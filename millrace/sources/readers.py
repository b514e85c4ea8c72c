"""Readers for documents, rules, access logs, log lines and detection rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import schemas
from millrace.operators.detect import DEFAULT_RULES, DetectionRule

# Object operations that write.
WRITE_EVENTS = ("PutObject", "CompleteMultipartUpload")


def read_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Stored JSON documents; broken ones keep their text in ``_corrupt_record``."""
    return (
        spark.read.schema(schemas.RAW_DOCUMENT)
        .option("multiLine", multi_line).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def with_file_lineage(df: DataFrame) -> DataFrame:
    """Add the file of each row and its modification time, from file metadata."""
    return df.withColumns({
        "s3_uri": F.col("_metadata.file_path"),
        "s3_last_modified": F.col("_metadata.file_modification_time"),
    })


def read_golden(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Golden Parquet; ``merge_schema`` unites columns added over time."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def flatten_key_value_rules(items: DataFrame) -> DataFrame:
    """Typed key-value attributes to flat rule columns."""
    text = ("entity_type", "entity_id", "rule_type", "reason_code", "source_format", "event_type")
    return items.select(
        *[F.col(f"Item.{name}.S").alias(name) for name in text],
        F.col("Item.compliance_flag.BOOL").alias("compliance_flag"))


def read_key_value_rules(spark: SparkSession, path: str) -> DataFrame:
    return flatten_key_value_rules(spark.read.schema(schemas.KEY_VALUE_RULE).json(path))


def read_rules_jdbc(spark: SparkSession, url: str, table: str = "compliance_rules", **options: str) -> DataFrame:
    """Rules from a relational database."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def object_writes(access_log: DataFrame) -> DataFrame:
    """Nested object-access records to flat columns, writes only."""
    return access_log.filter(F.col("eventname").isin(*WRITE_EVENTS)).select(
        "eventtime",
        F.col("useridentity.principalid").alias("principal_id"),
        F.col("requestparameters.bucketName").alias("bucket_name"),
        F.col("requestparameters.key").alias("object_key"),
        F.col("additionalEventData.bytesTransferredIn").alias("size_bytes"),
        F.col("eventname").alias("event_name"),
        F.col("sourceipaddress").alias("source_ip"))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LOG_LINE).json(path)


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """Add the log time and the structured record held in ``message``."""
    return lines.select(
        F.timestamp_millis("timestamp").alias("logged_at"),
        F.from_json("message", schemas.LOG_RECORD).alias("record"),
        F.col("message").alias("line")).select("logged_at", "line", "record.*")


def read_detection_rules(spark: SparkSession, path: str) -> tuple[DetectionRule, ...]:
    """Ordered detection rules from a JSON file; the defaults if it has none.

    A configuration of a handful of rules, so it is read on the driver.
    """
    try:
        rows = detection_rule_table(spark, path).orderBy("position").collect()
    except Exception as error:  # missing or unreadable file
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = []
    rules = tuple(DetectionRule(r["name"], r["format"], r["prefix"], r["contains_key"]) for r in rows)
    return rules or DEFAULT_RULES


def detection_rule_table(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(schemas.DETECTION_RULES).option("multiLine", True).json(path)
        .select(F.posexplode("rules").alias("position", "rule")).select("position", "rule.*"))


def register_table(spark: SparkSession, name: str, path: str, partitions: tuple[str, ...]) -> None:
    """Create an external table over a Parquet folder, or add its new partitions and columns."""
    schema = read_golden(spark, path, merge_schema=True).schema
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'")
    else:
        known = set(spark.table(name).columns)
        added = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in known]
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    spark.sql(f"MSCK REPAIR TABLE {name}")

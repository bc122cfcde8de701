"""File sources and sinks: JSONL with a declared schema, JSON projection,
Parquet (plain and Hive-partitioned), per-file metadata, JSONL export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

# --- fixed values: text formats of timestamps in JSONL files ---
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str,
               ts_format: str = TS_FORMAT) -> DataFrame:
    """Newline-delimited JSON with a declared schema; a malformed record
    fails the read (like a strict cast), nothing is silently dropped."""
    return (spark.read.schema(schema).option("mode", "FAILFAST")
            .option("timestampNTZFormat", ts_format).option("timestampFormat", ts_format)
            .json(path))


# --- fixed values: why a line is not a record ---
NOT_JSON = "not a JSON object"
WRONG_TYPE = "a field does not fit its declared type"


def split_lines(lines: DataFrame, schema: StructType | str, col: str = "value",
                ts_format: str = TS_FORMAT) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of JSON lines: a line that is no object, or has a field that doesn't fit its type,
    goes to the rejects with the raw text and the reason, and the run goes on. Every line that isn't blank is on one side.
    One rule, the parser's own corrupt-record column, decides both sides."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    with_raw = StructType([*schema.fields, StructField("_corrupt", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "timestampNTZFormat": ts_format,
               "timestampFormat": ts_format}
    line = F.col(col)
    parsed = (lines.where(F.trim(line) != "")
                   .select(line.alias("_raw"), F.from_json(line, with_raw, options).alias("_r"),
                           F.json_object_keys(line).isNotNull().alias("_object")))
    bad = F.col("_r._corrupt").isNotNull() | ~F.col("_object")
    return (parsed.where(~bad).select(*[F.col("_r")[f.name].alias(f.name) for f in schema.fields]),
            parsed.where(bad).select(F.col("_raw").alias("raw"),
                                     F.when(F.col("_object"), WRONG_TYPE).otherwise(NOT_JSON).alias("reject_reason")))


def read_jsonl_split(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """``split_lines`` of the text files at ``path``."""
    return split_lines(spark.read.text(path), schema)


def read_raw_lines(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """JSON lines read as text, one row per line, then projected strictly."""
    return project_json(spark.read.text(path).withColumnRenamed("value", "_line"), "_line", fields)


def project_json(df: DataFrame, col: str, fields: str) -> DataFrame:
    """Parse a JSON text column into typed columns. Fields declared STRING
    keep any JSON scalar as text (``3`` -> ``'3'``, null -> NULL), so a type
    change at the source cannot break the load; malformed JSON fails it."""
    parsed = F.from_json(F.col(col), fields, {"mode": "FAILFAST"})
    names = [f.strip().split()[0] for f in fields.split(",")]
    return df.select("*", *[parsed[n].alias(n) for n in names]).drop(col)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Plain or Hive-partitioned Parquet: partition columns are discovered
    from ``key=value`` folders and pruned by filters on them."""
    return spark.read.parquet(path)


def file_report(df: DataFrame) -> DataFrame:
    """Rows per input file, from the hidden ``_metadata`` column."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("rows"))


def export_jsonl(df: DataFrame, path: str, ts_format: str = TS_FORMAT) -> None:
    """Write JSONL with timestamps as formatted text."""
    out = df.select(*[F.date_format(F.col(f.name), ts_format).alias(f.name)
                      if f.dataType.typeName() in ("timestamp", "timestamp_ntz") else F.col(f.name)
                      for f in df.schema.fields])
    out.write.mode("overwrite").json(path)

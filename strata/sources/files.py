"""Batch reads of landing folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """A2: ``_source_file`` (from the hidden ``_metadata`` column of file
    sources, unless the reader gave it) and ``_ingest_ts`` on every row."""
    if "_source_file" not in df.columns:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df.withColumn("_ingest_ts", F.current_timestamp())


def read_csv_batch(spark: SparkSession, path: str, schema: StructType | str | None = None, **opts) -> DataFrame:
    """A1: CSV with a header. Without a schema types are inferred (one
    extra pass: only for small static lookups); with one, columns are matched
    by header name and ``_source_file`` is added."""
    if schema is not None:
        return read_csv_by_header(spark, csv_files(spark, path), schema, **opts)
    return spark.read.option("header", True).option("inferSchema", True).options(**opts).csv(path)


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder (or the file itself)."""
    return [r.path for r in list_landing(spark, path).select("path").collect()]


def as_struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_csv_by_header(spark: SparkSession, paths: list[str], schema: StructType | str, rescued: str | None = None, **opts) -> DataFrame:
    """CSV files whose columns are told by their headers, not by position:
    files are grouped by header line and each group is read in its own order.
    Columns outside the schema come as strings; columns a file lacks are NULL.
    ``rescued`` keeps the whole line of a malformed row."""
    schema = as_struct(schema)
    if not paths:
        return spark.createDataFrame([], schema)
    first = (spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
             .where("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "n").alias("header")))
    groups: dict[str, list[str]] = {}
    for r in first.collect():  # one line a file, of the files of this load
        groups.setdefault(r.header, []).append(r.file_path)
    known = {f.name.lower(): f for f in schema.fields}
    out = None
    for header, members in sorted(groups.items()):
        parsed = spark.read.option("header", True).options(**opts).csv(spark.sparkContext.parallelize([header], 1)).columns
        fields = [StructField(known[c.lower()].name, known[c.lower()].dataType, True) if c.lower() in known else StructField(c, StringType(), True)
                  for c in parsed]
        r = spark.read.option("header", True).options(**opts)
        if rescued:
            fields.append(StructField(rescued, StringType(), True))
            r = r.option("columnNameOfCorruptRecord", rescued)
        part = r.schema(StructType(fields)).csv(members)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in part.columns]
        extra = [c for c in part.columns if c not in schema.names]
        part = part.select("*", *missing, F.col("_metadata.file_path").alias("_source_file")).select(*schema.names, *extra, "_source_file")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_json_array(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A4: files holding one JSON array each; nested arrays stay nested."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_ndjson(spark: SparkSession, path: str, schema: StructType | str | None = None,
                corrupt_col: str | None = "_corrupt_record") -> DataFrame:
    """A5: newline-delimited JSON; a malformed line lands in
    ``corrupt_col`` instead of failing the load (PERMISSIVE)."""
    r = spark.read.option("mode", "PERMISSIVE")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    if schema is not None:
        if corrupt_col and isinstance(schema, StructType) and corrupt_col not in schema.fieldNames():
            schema = StructType(list(schema.fields)).add(corrupt_col, "string")
        r = r.schema(schema)
    return r.json(path)


def read_files(spark: SparkSession, path: str, fmt: str, schema=None, **opts) -> DataFrame:
    """Ad-hoc read of a folder in any format."""
    r = spark.read.format(fmt).options(**opts)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def list_landing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """File inventory (path, length, modificationTime) without reading
    file contents (only the metadata columns are selected, so the binary
    content column is pruned)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", "modificationTime")


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 8, **props) -> DataFrame:
    """A database table, read in ``num_partitions`` parallel range
    queries over ``partition_column`` when given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**props)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()

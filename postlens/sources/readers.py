"""Readers: Parquet, CSV, partitioned tables, JSON listings and watch lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens import schemas
from postlens.functions.values import parse_time, to_number
from postlens.operators.cleaning import parsed_and_rejected
from postlens.sources.writers import NULL_MARK

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "nullValue": NULL_MARK,
    "emptyValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CORRUPT = "_corrupt_row"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, glob: str = "*.csv", **options: str
) -> DataFrame:
    """All CSV files of a folder (or one file), with quoted newlines and quotes kept inside their row.

    Give the schema where it is known: without one Spark reads the files once more to infer it. Where no
    text holds a newline, pass ``multiLine="false"``: Spark can then split large files.
    """
    reader = spark.read.options(**{**CSV_OPTIONS, "pathGlobFilter": glob, **options})
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def read_csv_tolerant(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """A CSV scan that leaves out rows that do not fit the schema."""
    return read_csv_with_rejects(spark, path, schema, **options)[0]


def read_csv_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the raw text of those that do not.

    A row is judged by all its fields: the always-true comparison reads them, or Spark would parse
    only the columns a later step asks for and take a bad row for a good one.
    """
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    options = {**CSV_OPTIONS, **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = spark.read.options(**options).schema(wide).csv(path)
    rows = rows.filter(F.xxhash64(*schema.fieldNames()) >= F.lit(-(2**63)))
    good = rows.filter(F.col(CORRUPT).isNull()).select(*schema.fieldNames())
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("row"), *schema.fieldNames())
    return good, bad


def read_recursive(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files below a folder as one table; columns are matched by name."""
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def read_partitioned(
    spark: SparkSession,
    path: str,
    first_day: str | None = None,
    last_day: str | None = None,
    schema: T.StructType | None = None,
    day_column: str = "dt",
) -> DataFrame:
    """A folder partitioned by ``…/dt=…``, limited to a range of days by partition pruning."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    if first_day is not None:
        table = table.filter(F.col(day_column) >= F.lit(first_day).cast("date"))
    if last_day is not None:
        table = table.filter(F.col(day_column) <= F.lit(last_day).cast("date"))
    return table


def register_partitions(spark: SparkSession, table: str, path: str, schema: T.StructType, by: list[str]) -> DataFrame:
    """Make a partitioned folder a catalog table and pick up the partitions found on disk."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{name}`" for name in by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{table}` ({columns}) USING PARQUET PARTITIONED BY ({keys}) LOCATION '{path}'")
    spark.catalog.recoverPartitions(table)
    return spark.table(table)


PARTITIONS_PER_STATEMENT = 200


def add_partitions(
    spark: SparkSession, table: str, path: str, schema: T.StructType, by: list[str], written: list[tuple]
) -> DataFrame:
    """Make a partitioned folder a catalog table and add the partitions that a run wrote, as the writer names
    them. No folder is listed, so it costs what the run changed and not what the table holds."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{name}`" for name in by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{table}` ({columns}) USING PARQUET PARTITIONED BY ({keys}) LOCATION '{path}'")

    def spec(values: tuple) -> str:
        return "PARTITION (" + ", ".join(f"`{name}` = {_sql_literal(value)}" for name, value in zip(by, values, strict=True)) + ")"

    for at in range(0, len(written), PARTITIONS_PER_STATEMENT):
        specs = " ".join(map(spec, written[at : at + PARTITIONS_PER_STATEMENT]))
        spark.sql(f"ALTER TABLE `{table}` ADD IF NOT EXISTS {specs}")
    if written:
        # A partition that was there already may have other files now.
        spark.catalog.refreshTable(table)
    return spark.table(table)


def _sql_literal(value: object) -> str:
    if value is None:
        return "null"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return text if isinstance(value, (int, float)) and not isinstance(value, bool) else f"'{text}'"


def parsed_json(df: DataFrame, column: str, name: str = "parsed") -> tuple[DataFrame, DataFrame]:
    """Rows with a column of JSON as a variant, whose fields need not be known, and the rows it is broken in, as
    they came. A null column is no reject: its variant is null. Spark's parser ends at the end of the value; what
    follows it plays no part."""
    parsed = df.withColumn(name, F.try_parse_json(F.col(column)))
    broken = F.col(name).isNull() & F.col(column).isNotNull()
    return parsed.filter(~broken), parsed.filter(broken).drop(name)


def json_schema(df: DataFrame, column: str = "parsed") -> DataFrame:
    """One row ``(schema)``: the type that fits all variants of a column, merged by the map tasks."""
    return df.agg(F.schema_of_variant_agg(F.col(column)).alias("schema"))


def json_fields(df: DataFrame, column: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds fields of a variant by path: ``{name: (path, type)}``; null where there is none or it does not fit."""
    return df.withColumns({name: F.try_variant_get(F.col(column), path, kind) for name, (path, kind) in fields.items()})


def flatten_listing(pages: DataFrame, column: str = "json", schema: T.StructType = schemas.LISTING) -> DataFrame:
    """One row per post of nested listing JSON (``data.children[].data``)."""
    return flatten_listing_with_rejects(pages, column, schema)[0]


def flatten_listing_with_rejects(
    pages: DataFrame, column: str = "json", schema: T.StructType = schemas.LISTING
) -> tuple[DataFrame, DataFrame]:
    """The posts of listing pages, and the pages that are no listing, as they came."""
    parsed = pages.withColumn("_listing", F.from_json(F.col(column), schema))
    broken = F.col("_listing.data.children").isNull()
    children = parsed.filter(~broken).select(F.explode("_listing.data.children").alias("child"))
    posts = children.select("child.data.*")
    posts = posts.select(F.timestamp_seconds("created_utc").alias("date"), *[c for c in posts.columns if c != "created_utc"])
    return posts, parsed.filter(broken).drop("_listing")


def read_watchlist(spark: SparkSession, path: str) -> DataFrame:
    """Ids and titles of the submissions to follow."""
    return read_csv(spark, path, schemas.SUBMISSIONS)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Submission ids of a file that numbers its rows in a first, unnamed column."""
    numbered = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("submission_id", T.StringType())])
    return read_csv(spark, path, numbered).select("submission_id")


def read_simulated_posts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Simulated posts with their text dates parsed, and the rows whose dates do not fit the format."""
    arrived = read_csv(spark, path, schemas.SIMULATED_POSTS)
    good, rejects = parsed_and_rejected(
        arrived, {"timestamp": parse_time(F.col("timestamp")), "date": parse_time(F.col("date"), "d/M/yy").cast("date")}
    )
    numbers = {"upvotes": to_number(F.col("upvotes"), "int"), "upvote_ratio": to_number(F.col("upvote_ratio"))}
    return good.withColumns(numbers), rejects


def restrict_to_watchlist(posts: DataFrame, watchlist: DataFrame, key: str = "submission_id") -> DataFrame:
    """Posts whose submission is on the list. A list under Spark's broadcast threshold is broadcast, a
    longer one is joined by shuffle; a left-semi join never repeats a post."""
    return posts.join(watchlist.select(key), key, "left_semi")


def json_field(column: str | Column, path: str, kind: str = "string") -> Column:
    return F.get_json_object(column, path).try_cast(kind)

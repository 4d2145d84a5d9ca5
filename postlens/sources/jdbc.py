"""Database source and sink. Nothing about the server is fixed here; pass it in ``JdbcOptions``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcOptions:
    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def as_dict(self) -> dict[str, str]:
        named = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {**{key: value for key, value in named.items() if value is not None}, **self.extra}


def read_options(
    options: JdbcOptions,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC scan.

    A scan without a partition column is one task. With one, Spark opens ``num_partitions`` ranged
    reads; rows outside the bounds are still read, by the first and the last of them. Spark cannot
    split ``query``, so a split query goes in as a derived table.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    result = {**options.as_dict(), "fetchsize": str(fetch_size)}
    if partition_column is None:
        result.update({"dbtable": table} if table else {"query": query})
        return result
    if bounds is None or not num_partitions:
        raise ValueError("a split read needs bounds and num_partitions")
    result["dbtable"] = table or f"({query}) scanned"
    result["partitionColumn"] = partition_column
    result["lowerBound"], result["upperBound"] = (str(bound) for bound in bounds)
    result["numPartitions"] = str(num_partitions)
    return result


def read_jdbc(spark: SparkSession, options: JdbcOptions, **scan) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(options, **scan)).load()


def reviewed_posts_query(table: str, label: str = "ground_truth_label") -> str:
    """A query with the 0/1 label worked out by the database."""
    return f"SELECT p.*, CASE WHEN lower(trim({label})) = 'yes' THEN 1 ELSE 0 END AS {label}_int FROM {table} p"


def write_jdbc(
    df: DataFrame,
    options: JdbcOptions,
    table: str,
    mode: str = "errorifexists",
    batch_size: int = 5_000,
    connections: int | None = None,
    keep_definition: bool = True,
) -> None:
    """Write a table: ``overwrite`` replaces, ``append`` adds, ``errorifexists`` only creates.

    ``connections`` bounds how many tasks write at once. Overwriting empties the table and keeps its
    definition and indexes unless told otherwise.
    """
    sink = {**options.as_dict(), "dbtable": table, "batchsize": str(batch_size), "truncate": str(keep_definition).lower()}
    if connections:
        sink["numPartitions"] = str(connections)
    df.write.format("jdbc").options(**sink).mode(mode).save()

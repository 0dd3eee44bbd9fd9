"""Source readers (S1, S2) and the availability check (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.sources.schemas import SOURCE_SCHEMAS


def read_source(spark: SparkSession, table: str, path: str, fmt: str = "parquet",
                options: dict | None = None) -> DataFrame:
    """Scan one source with its explicit schema (parquet / csv / json / orc).

    The schema is enforced rather than inferred, so a scan costs one pass and
    Catalyst can prune columns and push filters into the file reader.
    """
    schema = SOURCE_SCHEMAS[table]
    reader = spark.read.schema(schema)
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", "true")
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.format(fmt).load(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """The exploratory path: header + inferred types (one extra pass over the file)."""
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


def hash_predicates(column: str, parts: int, hash_sql: str = "abs(hashtext({column}::text))") -> list[str]:
    """WHERE clauses that split a table by a hash of a text key (the default is PostgreSQL's
    hash); NULL keys go to the first part."""
    h = hash_sql.format(column=column)
    return [f"mod({h}, {parts}) = {k}" + (f" OR {column} IS NULL" if k == 0 else "") for k in range(parts)]


def jdbc_options(table: str, url: str, properties: dict, partition_column: str | None = None,
                 lower=None, upper=None, num_partitions: int = 64) -> dict[str, str]:
    opts = {**properties, "url": url, "dbtable": table}
    if partition_column is not None:
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower),
                     "upperBound": str(upper), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, table: str, url: str, properties: dict,
              partition_column: str | None = None, lower=None, upper=None, num_partitions: int = 64,
              hash_column: str | None = None, single_task: bool = False) -> DataFrame:
    """Parallel JDBC scan in ``num_partitions`` queries: ranges of a number or
    date (``partition_column`` from ``lower`` to ``upper``) or hash classes of a
    text key (``hash_column``).  A read through one connection must be asked
    for with ``single_task``."""
    if hash_column is not None:
        return spark.read.jdbc(url, table, predicates=hash_predicates(hash_column, num_partitions),
                               properties=properties)
    if partition_column is None and not single_task:
        raise ValueError(f"{table}: give partition_column or hash_column, or ask for single_task")
    if partition_column is not None and (lower is None or upper is None):
        raise ValueError(f"{table}: partition_column needs lower and upper")
    return spark.read.format("jdbc").options(**jdbc_options(
        table, url, properties, partition_column, lower, upper, num_partitions)).load()


def check_sources(sources: dict[str, DataFrame], required: list[str] | None = None) -> None:
    """Fail fast when a source is missing or empty.

    ``isEmpty`` stops at the first row found instead of counting the table.
    """
    names = required or list(SOURCE_SCHEMAS)
    missing = [n for n in names if n not in sources]
    empty = [n for n in names if n in sources and sources[n].isEmpty()]
    if missing or empty:
        raise ValueError(f"source check failed: missing={missing} empty={empty}")

"""Banking sources derived from the driver's TPC-H-style tables.

The reference ships no data, so the seven OLTP tables are derived from the
driver's parquet files by a fixed mapping (FIXTURES.md §3).  Every source is a
narrow projection over one big table plus, where needed, a join to
``nation`` / ``region``.  Those two have a fixed size at every scale factor
(25 and 5 rows), so they are broadcast explicitly: the big side is never
shuffled for the lookup.  Dates are shifted by 20 years so that they fall
inside the 2015-2030 calendar.

The mapping deliberately plants rule violations (bad e-mails, out-of-range
scores, negative balances, an unknown card type, empty merchant names) so
that the validity flags, quarantine and checks have hits.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.schemas import MONEY, RATE, SOURCE_SCHEMAS

# Fixed values of the mapping.
YEAR_SHIFT_MONTHS = 240
CREATED_AT_EPOCH = dt.date(2015, 1, 1)
EMAIL_DOMAIN = "example.com"
MANAGER_PREFIX = "manager "
ORDER_STATUS_TO_ACCOUNT_TYPE = {"F": "Business", "O": "Checking", "P": "Savings"}
URGENT_PRIORITY = "1-URGENT"


# The driver tables' column types (the same at every scale
# factor); declaring them skips schema inference on every read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def driver_reader(spark: SparkSession, sf_dir: str):
    """Reader of the driver tables; each file is opened once per reader,
    however many sources use it, with its declared schema."""
    opened: dict[str, DataFrame] = {}

    def read(name: str) -> DataFrame:
        if name not in opened:
            reader = spark.read.schema(DRIVER_SCHEMAS[name]) if name in DRIVER_SCHEMAS else spark.read
            opened[name] = reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        return opened[name]
    return read


def _shift(ts: Column) -> Column:
    """Date part shifted forward by 20 years (Feb 29 stays Feb 29)."""
    return F.add_months(ts.cast("date"), YEAR_SHIFT_MONTHS)


def _conform(df: DataFrame, table: str) -> DataFrame:
    schema = SOURCE_SCHEMAS[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def customers(read) -> DataFrame:
    c = read("customer").select("c_custkey", "c_name", "c_nationkey")
    n = read("nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    local = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    df = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        F.concat(F.lit("C"), k.cast("string")).alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.when(k % 97 == 0, F.concat(local, F.lit(EMAIL_DOMAIN)))
         .otherwise(F.concat(local, F.lit("@" + EMAIL_DOMAIN))).alias("email"),
        F.col("n_name").alias("city"),
        F.when(k % 53 == 0, F.lit(None).cast("int"))
         .when(k % 101 == 0, F.lit(900))
         .otherwise(F.lit(300) + (k * 37) % 551).alias("credit_score"),
        F.date_add(F.lit(CREATED_AT_EPOCH), ((k * 13) % 3000).cast("int"))
         .cast("timestamp_ntz").alias("created_at"),
    )
    return _conform(df, "customers")


def _account_type(status: Column) -> Column:
    expr = None
    for code, label in ORDER_STATUS_TO_ACCOUNT_TYPE.items():
        expr = F.when(status == code, F.lit(label)) if expr is None else expr.when(status == code, F.lit(label))
    return expr


def accounts(read, balance_bump: Column | None = None, keep: Column | None = None) -> DataFrame:
    """Accounts from orders.  ``keep`` / ``balance_bump`` shape the two
    incremental batches (late-arriving accounts, changed balances)."""
    o = read("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    if keep is not None:
        o = o.filter(keep)
    k = F.col("o_orderkey")
    bal = F.col("o_totalprice").cast(MONEY)
    bal = F.when(k % 211 == 0, -bal).otherwise(bal)
    if balance_bump is not None:
        bal = bal + balance_bump
    df = o.select(
        F.concat(F.lit("A"), k.cast("string")).alias("account_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        _account_type(F.col("o_orderstatus")).alias("account_type"),
        bal.alias("balance_usd"),
        _shift(F.col("o_orderdate")).alias("open_date"),
    )
    return _conform(df, "accounts")


def cards(read) -> DataFrame:
    o = read("orders").select("o_orderkey", "o_orderdate").filter(F.col("o_orderkey") % 2 == 0)
    k = F.col("o_orderkey")
    df = o.select(
        F.concat(F.lit("D"), k.cast("string")).alias("card_id"),
        F.concat(F.lit("A"), k.cast("string")).alias("account_id"),
        F.when(k % 199 == 0, F.lit("Prepaid")).when(k % 3 == 0, F.lit("Credit"))
         .otherwise(F.lit("Debit")).alias("card_type"),
        F.date_add(_shift(F.col("o_orderdate")), (F.lit(365) * (F.lit(1) + k % 5)).cast("int"))
         .alias("expiration_date"),
    )
    return _conform(df, "cards")


def loans(read) -> DataFrame:
    o = (read("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
         .filter(F.col("o_orderpriority") == URGENT_PRIORITY))
    k = F.col("o_orderkey")
    df = o.select(
        F.concat(F.lit("L"), k.cast("string")).alias("loan_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_totalprice").cast(MONEY).alias("loan_amount"),
        ((k % 1200).cast("decimal(10,0)") / F.lit(100)).cast(RATE).alias("interest_rate"),
        _shift(F.col("o_orderdate")).alias("start_date"),
    )
    return _conform(df, "loans")


def merchants(read) -> DataFrame:
    s = read("supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read("nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    df = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(
        F.concat(F.lit("M"), k.cast("string")).alias("merchant_id"),
        F.when(k % 50 == 7, F.lit("")).otherwise(F.col("s_name")).alias("merchant_name"),
        F.col("n_name").alias("city"),
    )
    return _conform(df, "merchants")


def branches(read) -> DataFrame:
    n = read("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read("region").select("r_regionkey", "r_name")
    df = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left").select(
        F.concat(F.lit("B"), F.col("n_nationkey").cast("string")).alias("branch_id"),
        F.col("n_name").alias("branch_name"),
        F.concat(F.lit(MANAGER_PREFIX), F.col("n_nationkey").cast("string")).alias("manager_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
    )
    return _conform(df, "branches")


def transactions(read) -> DataFrame:
    li = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                 "l_shipdate", "l_extendedprice")
    price = F.col("l_extendedprice").cast(MONEY)
    # (orderkey, linenumber) is not unique in the driver data; six parts are.
    tx_id = F.concat_ws(
        "-",
        F.concat(F.lit("T"), F.col("l_orderkey").cast("string")),
        F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"), F.col("l_shipdate").cast("date").cast("string"),
        price.cast("string"))
    df = li.select(
        tx_id.alias("transaction_id"),
        F.concat(F.lit("A"), F.col("l_orderkey").cast("string")).alias("account_id"),
        F.concat(F.lit("M"), F.col("l_suppkey").cast("string")).alias("merchant_id"),
        price.alias("amount_usd"),
        _shift(F.col("l_shipdate")).cast("timestamp_ntz").alias("transaction_date"),
    )
    return _conform(df, "transactions")


BUILDERS = {
    "customers": customers, "accounts": accounts, "cards": cards, "merchants": merchants,
    "branches": branches, "loans": loans, "transactions": transactions,
}


class LazySources(dict):
    """The seven sources, each built on first access (a query touching two
    sources opens only their files)."""

    def __init__(self, read):
        super().__init__()
        self._read = read

    def __missing__(self, name: str) -> DataFrame:
        if name not in BUILDERS:
            raise KeyError(name)
        df = BUILDERS[name](self._read)
        self[name] = df
        return df

    def __contains__(self, name) -> bool:
        return name in BUILDERS

    def __iter__(self):
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)

    def keys(self):
        return list(BUILDERS)

    def items(self):
        return [(n, self[n]) for n in BUILDERS]

    def values(self):
        return [self[n] for n in BUILDERS]


def banking_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All seven sources as lazy DataFrames over the driver parquet files."""
    return LazySources(driver_reader(spark, sf_dir))


def account_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two source batches of ``accounts`` for incremental runs: batch one lacks
    every seventh order (those arrive late); batch two holds every account,
    with balance + 100 on every tenth order (a changed attribute)."""
    read = driver_reader(spark, sf_dir)
    first = accounts(read, keep=(F.col("o_orderkey") % 7 != 0))
    bump = F.when(F.col("o_orderkey") % 10 == 0, F.lit(100).cast(MONEY)).otherwise(F.lit(0).cast(MONEY))
    second = accounts(read, balance_bump=bump)
    return [first, second]

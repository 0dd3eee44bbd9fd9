"""Gold star schema: SCD2 dimensions, calendar, facts, and the documented joins.

SCD2: satellite versions joined to the hub (and, for accounts / cards, to
the owning link) and ordered per hub key by ``load_dts`` (ties by
``hash_diff``); ``lead(load_dts)`` closes each version.  Satellite, hub, link
and window all key on the same hash key, so the plan shuffles each input once
and the window reuses that partitioning.  Dimensions of packed keys keep them packed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.banking import credit_tier, date_key, month_start, open_end_ts
from ledgerlake.functions.keys import key_text, packed, packed_keys, surrogate_key, unpacked, unpacked_keys
from ledgerlake.operators.skew import copied, salted_join
from ledgerlake.plans.entities import ENTITIES
from ledgerlake.session import ensure_checkpoint_dir

CALENDAR_START = dt.date(2015, 1, 1)
CALENDAR_END = dt.date(2030, 1, 1)

def versioned(sat: DataFrame, hub: DataFrame, entity: str, attrs: list[str],
              link: DataFrame | None = None, link_other: str | None = None,
              valid_only: bool = False) -> DataFrame:
    """Satellite versions with ``next_load_dts`` (NULL for the current one).

    ``valid_only`` keeps only versions that passed their rules (the reading
    of "latest valid row" in the reference's prose; its SQL reads all rows,
    which is the default).
    """
    e = ENTITIES[entity]
    if valid_only:
        sat = sat.filter(F.col("_is_valid"))
    v = (sat.select(e.hk, *attrs, "hash_diff", "load_dts", "rec_src")
         .join(hub.select(e.hk, e.key), on=e.hk, how="inner"))
    order = [F.col("load_dts"), F.col("hash_diff")]
    if link is not None:
        v = v.join(link.select(e.hk, link_other), on=e.hk, how="inner")
        order.append(F.col(link_other).asc_nulls_last())
    # attributes last: a total order even for colliding hash_diffs
    order += [F.col(a).asc_nulls_last() for a in attrs]
    w = Window.partitionBy(e.hk).orderBy(*order)
    return v.withColumn("next_load_dts", F.lead("load_dts").over(w))


def _scd2_tail() -> list[Column]:
    return [F.col("load_dts").alias("effective_start_date"),
            F.coalesce(F.col("next_load_dts"), open_end_ts()).alias("effective_end_date"),
            F.col("next_load_dts").isNull().alias("is_current"),
            F.col("rec_src").alias("record_source")]


def dim_customer(sat: DataFrame, hub: DataFrame, valid_only: bool = False) -> DataFrame:
    attrs = ["first_name", "last_name", "email", "city", "credit_score", "created_at"]
    v = versioned(sat, hub, "customer", attrs, valid_only=valid_only)
    return v.select(
        surrogate_key(key_text(v, "hk_customer"), "load_dts").alias("customer_key"),
        F.col("hk_customer").alias("customer_hub_key"),
        "customer_id", "first_name", "last_name", "email", "city", "credit_score",
        credit_tier("credit_score").alias("credit_tier"),
        F.to_date("created_at").alias("created_date"),
        month_start("created_at").alias("acquisition_month"),
        *_scd2_tail())


def dim_account(sat: DataFrame, hub: DataFrame, link_customer_account: DataFrame,
                valid_only: bool = False) -> DataFrame:
    v = versioned(sat, hub, "account", ["account_type", "open_date"],
                  link_customer_account, "hk_customer", valid_only)
    return v.select(
        surrogate_key(key_text(v, "hk_account"), "load_dts").alias("account_key"),
        F.col("hk_account").alias("account_hub_key"),
        "account_id",
        F.col("hk_customer").alias("customer_hub_key"),
        "account_type", "open_date", *_scd2_tail())


def dim_card(sat: DataFrame, hub: DataFrame, link_account_card: DataFrame,
             valid_only: bool = False) -> DataFrame:
    v = versioned(sat, hub, "card", ["card_type", "expiration_date"],
                  link_account_card, "hk_account", valid_only)
    return v.select(
        surrogate_key(key_text(v, "hk_card"), "load_dts").alias("card_key"),
        F.col("hk_card").alias("card_hub_key"),
        "card_id",
        F.col("hk_account").alias("account_hub_key"),
        "card_type", "expiration_date", *_scd2_tail())


def dim_merchant(sat: DataFrame, hub: DataFrame, valid_only: bool = False) -> DataFrame:
    v = versioned(sat, hub, "merchant", ["merchant_name", "city"], valid_only=valid_only)
    return v.select(
        surrogate_key(key_text(v, "hk_merchant"), "load_dts").alias("merchant_key"),
        F.col("hk_merchant").alias("merchant_hub_key"),
        "merchant_id", "merchant_name", "city", *_scd2_tail())


def dim_branch(sat: DataFrame, hub: DataFrame, valid_only: bool = False) -> DataFrame:
    v = versioned(sat, hub, "branch", ["branch_name", "manager_name", "city", "country"], valid_only=valid_only)
    return v.select(
        surrogate_key(key_text(v, "hk_branch"), "load_dts").alias("branch_key"),
        F.col("hk_branch").alias("branch_hub_key"),
        "branch_id", "branch_name", "city", "country", "manager_name", *_scd2_tail())


def dim_date(spark: SparkSession, start: dt.date = CALENDAR_START,
             end: dt.date = CALENDAR_END) -> DataFrame:
    """One row per day, generated on the executors from two constants
    (5,480 rows for 2015-01-01 .. 2030-01-01)."""
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    base = spark.range(0, days, 1, numPartitions=1).select(d.alias("date_day"))
    dd = F.col("date_day")
    iso_dow = F.extract(F.lit("DAYOFWEEK_ISO"), dd)
    return base.select(
        date_key(dd).alias("date_key"),
        dd,
        F.year(dd).alias("year"),
        F.quarter(dd).alias("quarter"),
        F.month(dd).alias("month"),
        F.date_format(dd, "MMMM").alias("month_name"),
        F.dayofmonth(dd).alias("day_of_month"),
        iso_dow.cast("int").alias("day_of_week"),
        F.date_format(dd, "EEEE").alias("day_name"),
        iso_dow.isin(6, 7).alias("is_weekend"),
        F.weekofyear(dd).alias("week_of_year"),
        F.dayofyear(dd).alias("day_of_year"),
        (F.last_day(dd) == dd).alias("is_month_end"))


def fact_transactions(sat: DataFrame, link_account_transaction: DataFrame,
                      link_merchant_transaction: DataFrame,
                      link_customer_account: DataFrame, latest_only: bool = False,
                      hot_share: float | None = None, hot_from: DataFrame | None = None,
                      weight: str | None = None, dealt_by: DataFrame | None = None) -> DataFrame:
    """All transaction versions with account, merchant and customer keys
    (``latest_only``: one row per transaction, its latest version).

    The two links on ``hk_transaction`` join on the same partitioning as the
    satellite; the customer lookup re-keys on ``hk_account``, where a hot
    account is split by AQE's skew-join handling, or explicitly by salting
    accounts with more than ``hot_share`` of the transactions.  Hub keys come as text or packed.
    ``dealt_by`` are hot accounts (packed); the fact then keeps its keys packed and stays partitioned by account
    and sub-key (``_salt``), for a consumer that joins on the account.
    """
    if latest_only:
        sat = latest_versions(sat, "hk_transaction")
    s = sat.select("hk_transaction", "amount_usd", "transaction_date", "load_dts", "rec_src")
    lat = link_account_transaction.select("hk_transaction", "hk_account")
    lmt = link_merchant_transaction.select("hk_transaction", "hk_merchant")
    lca = link_customer_account.select("hk_account", "hk_customer")
    j = s.join(lat, "hk_transaction").join(lmt, "hk_transaction")
    # the lookup re-keys every fact row: its keys travel packed
    j, lca = packed_keys(j, "hk_account"), packed_keys(lca, "hk_account")
    if dealt_by is not None:
        j = salted_join(j, lca, "hk_account", hot=dealt_by, keep_salt=True)
    elif hot_share:
        # one transaction per link row: the link has the fact's account distribution
        hot = lat if hot_from is None else hot_from
        hot = packed_keys(hot.select("hk_account", *([weight] if weight else [])), "hk_account")
        j = salted_join(j, lca, "hk_account", hot_share, hot_from=hot, weight=weight)
    else:
        j = j.join(lca, "hk_account")
    key = unpacked if dealt_by is None else F.col
    return j.select(
        key("hk_transaction").alias("transaction_hub_key"),
        key("hk_account").alias("account_hub_key"),
        key("hk_merchant").alias("merchant_hub_key"),
        key("hk_customer").alias("customer_hub_key"),
        date_key("transaction_date").alias("date_key"),
        "transaction_date", "amount_usd",
        F.col("rec_src").alias("record_source"),
        F.col("load_dts").alias("load_date"), *(["_salt"] if dealt_by is not None else []))


def fact_loans(sat: DataFrame, link_customer_loan: DataFrame, latest_only: bool = False) -> DataFrame:
    """All loan versions (``latest_only``: the latest version per loan)."""
    if latest_only:
        sat = latest_versions(sat, "hk_loan")
    s = sat.select("hk_loan", "loan_amount", "interest_rate", "start_date", "load_dts", "rec_src")
    j = s.join(link_customer_loan.select("hk_loan", "hk_customer"), "hk_loan")
    return j.select(
        F.col("hk_loan").alias("loan_hub_key"),
        F.col("hk_customer").alias("customer_hub_key"),
        date_key("start_date").alias("date_key"),
        "start_date", "loan_amount", "interest_rate",
        F.col("rec_src").alias("record_source"),
        F.col("load_dts").alias("load_date"))


def latest_versions(sat: DataFrame, hk: str) -> DataFrame:
    """Latest satellite row per hub key (``row_number() ... desc = 1``), ties
    by ``hash_diff``.  Spark plans a WindowGroupLimit below the shuffle, so
    each map task forwards at most one row per key."""
    w = Window.partitionBy(hk).orderBy(F.col("load_dts").desc(), F.col("hash_diff").desc())
    return sat.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def fact_account_balance(sat: DataFrame, link_customer_account: DataFrame) -> DataFrame:
    s = latest_versions(sat, "hk_account")
    j = s.join(link_customer_account.select("hk_account", "hk_customer"), "hk_account")
    return j.select(
        F.col("hk_account").alias("account_hub_key"),
        F.col("hk_customer").alias("customer_hub_key"),
        date_key("load_dts").alias("date_key"),
        F.to_date("load_dts").alias("snapshot_date"),
        "open_date", "balance_usd",
        F.col("rec_src").alias("record_source"),
        F.col("load_dts").alias("load_date"))


# ---- documented consumer joins (J1-J4) -------------------------------------

def join_current(fact: DataFrame, dim: DataFrame, hub_key: str, hot_share: float | None = None,
                 hot_from: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """Fact -> current dimension row on the durable hub key (hot keys split with ``hot_share``,
    found in ``hot_from``)."""
    d = dim.filter(F.col("is_current"))
    if hot_share:
        return salted_join(fact, d, hub_key, hot_share, hot_from=hot_from, weight=weight)
    return fact.join(d, on=hub_key, how="inner")


def join_point_in_time(fact: DataFrame, dim: DataFrame, hub_key: str, time_col: str,
                       dim_cols: list[str], hot_share: float | None = None,
                       hot_from: DataFrame | None = None, weight: str | None = None,
                       dealt_by: DataFrame | None = None) -> DataFrame:
    """Fact -> the dimension version valid at the fact's time (``start <= t < end``).

    Versions and events are one stream, range-partitioned and sorted by key and
    time, in which an event takes the last version before it; so an event never
    meets all versions of its key, and a hot key's rows spread over many partitions.  Where a key
    goes on in the next partition, that one starts with the last version
    seen before it (one row per partition is carried).  Versions of a key must not overlap, as
    in an SCD2 dimension.  With ``hot_share`` a join on the key alone, salted,
    that pairs every version with the event.

    A fact whose keys are packed and whose rows lie by key and sub-key (``_salt``) of the hot keys ``dealt_by`` is not
    moved again: versions come to it, a hot key's to each of its sub-keys, and the stream is sorted and swept there.
    """
    d = dim.select(hub_key, "effective_start_date", "effective_end_date", *dim_cols)
    if hot_share:
        return unpacked_keys(salted_join(fact, d, hub_key, hot_share, hot_from=hot_from, weight=weight, hot=dealt_by).filter(
            (F.col(time_col) >= F.col("effective_start_date")) & (F.col(time_col) < F.col("effective_end_date"))))
    if dealt_by is not None:
        return unpacked_keys(_swept(fact, d, hub_key, time_col, dim_cols, dealt_by))
    # every row is shuffled twice and stored once: text keys are packed meanwhile
    types = {**dict(d.dtypes), **dict(fact.dtypes)}
    short = {c for c in (hub_key, *fact.columns, *dim_cols) if c.endswith("_key") and types[c] == "string"}
    fact = fact.where(F.col(hub_key).isNotNull() & F.col(time_col).isNotNull())
    d = d.where(F.col(hub_key).isNotNull() & F.col("effective_start_date").isNotNull())
    fact, d = (df.select(*[packed(c).alias(c) if c in short else c for c in df.columns]) for df in (fact, d))
    version = F.struct("effective_start_date", "effective_end_date", *dim_cols)
    rest = [c for c in fact.columns if c != hub_key]
    if len(rest) > 1 and types[time_col] == types["effective_start_date"]:
        rest.remove(time_col)                                # it is the stream's own time
    event = F.struct(*rest) if rest else F.struct(F.lit(None).cast("boolean").alias("_none"))
    versions = d.select(F.col(hub_key).alias("_key"), F.col("effective_start_date").alias("_at"), F.lit(0).alias("_kind"),
                        F.xxhash64("effective_end_date").alias("_tie"), version.alias("_version"))
    events = fact.select(F.col(hub_key).alias("_key"), F.col(time_col).alias("_at"), F.lit(1).alias("_kind"),
                         F.xxhash64(*rest).alias("_tie"), event.alias("_event"))
    # a version that ends as it starts is never valid; without it starts are unique within a key
    versions = versions.where("_version.effective_end_date > _version.effective_start_date")
    stream = versions.unionByName(events, allowMissingColumns=True)
    # boundaries come from samples, so what was placed is kept: the two uses below must agree
    ensure_checkpoint_dir(fact.sparkSession)
    placed = (stream.repartitionByRange("_key", "_at", "_kind", "_tie").withColumn("_part", F.spark_partition_id())
              .drop("_tie").checkpoint(eager=True))
    last = (placed.where("_kind = 0").groupBy("_part")
            .agg(F.max_by(F.struct("_key", "_version"), F.struct("_key", "_at")).alias("_last")))
    parts = placed.select("_part").distinct().join(last, "_part", "left")     # one row per partition
    carried = parts.select("_part", F.last("_last", ignorenulls=True).over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    before = Window.partitionBy("_part", "_key").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    met = (placed.withColumn("_version", F.last("_version", ignorenulls=True).over(before))
           .where("_kind = 1").join(F.broadcast(carried), "_part", "left"))
    found = F.coalesce(F.col("_version"),
                       F.when(F.col("_carried._key") == F.col("_key"), F.col("_carried._version")))
    own = {hub_key: "_key", **({} if time_col in rest else {time_col: "_at"})}
    out = (met.withColumn("_version", found).where(F.col("_at") < F.col("_version.effective_end_date"))
           .select(*[F.col(own.get(c, f"_event.{c}")).alias(c) for c in [hub_key, *fact.drop(hub_key).columns]], "_version.*"))
    return out.select(*[unpacked(c).alias(c) if c in short else c for c in out.columns])


def _swept(fact: DataFrame, d: DataFrame, hub_key: str, time_col: str, dim_cols: list[str], hot: DataFrame) -> DataFrame:
    """:func:`join_point_in_time` of a fact that lies by key and sub-key."""
    rest = [c for c in fact.columns if c not in (hub_key, "_salt")]
    version = F.struct("effective_start_date", "effective_end_date", *dim_cols)
    versions = copied(d.where("effective_end_date > effective_start_date"), hub_key, hot).select(
        hub_key, "_salt", F.col("effective_start_date").alias("_at"), F.lit(0).alias("_kind"), version.alias("_version")
    ).repartition(hub_key, "_salt")                          # as the events are
    events = fact.where(F.col(time_col).isNotNull()).select(
        hub_key, "_salt", F.col(time_col).alias("_at"), F.lit(1).alias("_kind"), F.struct(*rest).alias("_event"))
    before = Window.partitionBy(hub_key, "_salt").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return (versions.unionByName(events, allowMissingColumns=True)
            .withColumn("_version", F.last("_version", ignorenulls=True).over(before))
            .where((F.col("_kind") == 1) & (F.col("_at") < F.col("_version.effective_end_date")))
            .select(hub_key, "_event.*", "_version.*"))


def join_calendar(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fact -> calendar on ``date_key``.  The calendar is bounded (one row
    per day of a fixed 15-year range), so broadcasting it is safe."""
    return fact.join(F.broadcast(calendar), on="date_key", how="inner")


def spend_by_city_quarter(fact_tx: DataFrame, dim_cust: DataFrame, calendar: DataFrame) -> DataFrame:
    """Transaction spend by current customer city, year and quarter.

    The fact side is reduced before it meets the customer dimension: the
    calendar lookup is a broadcast (map-side) join, then a partial aggregate
    per (customer, year, quarter); only those sums are shuffled to the join.
    """
    d = calendar.select("date_key", "year", "quarter")
    per_customer = (fact_tx.select("customer_hub_key", "date_key", "amount_usd")
                    .join(F.broadcast(d), "date_key")
                    .groupBy("customer_hub_key", "year", "quarter")
                    .agg(F.sum("amount_usd").alias("_spend")))
    c = dim_cust.filter("is_current").select("customer_hub_key", "city")
    j = per_customer.join(c, "customer_hub_key")
    return (j.groupBy("city", "year", "quarter")
            .agg(F.sum("_spend").cast("decimal(38,2)").alias("total_spend"))
            .orderBy("year", "quarter", F.col("city").asc_nulls_last()))

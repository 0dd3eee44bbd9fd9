"""Two-batch incremental load of accounts (insert, no-op, change, late arrival).

Batch one is loaded into empty tables; batch two is loaded against what batch
one stored.  The stored tables are the union of both appends, and the SCD2
dimension is rebuilt over them.  In production each batch is written and read
back (:mod:`ledgerlake.plans.pipeline`); here both stay lazy DataFrames.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from ledgerlake.operators import gold
from ledgerlake.operators.bronze import bronze
from ledgerlake.operators.vault import first_rows, load_hub, load_link, load_sat, packed_rows, packed_sat
from ledgerlake.params import SECOND_LOAD_TS, THIRD_LOAD_TS
from ledgerlake.plans.entities import ENTITIES, LINKS
from ledgerlake.plans.loading import load_jobs
from ledgerlake.plans.upkeep import keep_dimension
from ledgerlake.session import ensure_checkpoint_dir
from ledgerlake.sources.driver_tables import account_batches
from ledgerlake.sources.sinks import TableStore


@dataclass
class AccountHistory:
    hub: DataFrame
    link: DataFrame
    sat: DataFrame
    dim: DataFrame


def load_batches(batches: list[DataFrame], params_list, entity="account", link="customer_account"):
    e, l = ENTITIES[entity], LINKS[link]
    hub = link_df = sat = None
    for df, params in zip(batches, params_list):
        b = bronze(df, e.source, params)
        new_hub = load_hub(b, e, params, hub)
        new_link = load_link(b, l, params, link_df)
        new_sat = load_sat(b, e, params, sat)
        hub = new_hub if hub is None else hub.unionByName(new_hub)
        link_df = new_link if link_df is None else link_df.unionByName(new_link)
        sat = new_sat if sat is None else sat.unionByName(new_sat)
    return hub, link_df, sat


def account_history(lh, loads=None) -> AccountHistory:
    """The two account batches loaded at ``loads`` (default: the run's load time and the second one)."""
    loads = loads or (lh.params.load_ts, SECOND_LOAD_TS)
    cached = lh.__dict__.setdefault("_account_history", {})
    if loads not in cached:
        batches = account_batches(lh.spark, lh.sf_dir)
        hub, link, sat = load_batches(batches, [lh.params.with_load_ts(t) for t in loads])
        cached[loads] = AccountHistory(hub, link, sat, gold.dim_account(sat, hub, link))
    return cached[loads]


def packed_account_history(lh, loads) -> DataFrame:
    """The dimension of :func:`account_history` for joins on the account: its hub keys are packed, and hub, link and
    satellite of a batch come from one shuffle by the account.  Rows without an account key, which
    no inner join meets, are not in it."""
    e, customer = ENTITIES["account"], ENTITIES["customer"]
    batches, sat = [], None
    for df, ts in zip(account_batches(lh.spark, lh.sf_dir), loads):
        run = lh.params.with_load_ts(ts)
        rows = packed_rows(bronze(df, e.source, run), e, [], [customer], with_key=True)
        new = packed_sat(rows, e, run, sat)
        sat = new if sat is None else sat.unionByName(new)
        batches.append(rows.withColumn("load_dts", run.load_ts_col))
    every = reduce(DataFrame.unionByName, batches)
    # a key is inserted by the first batch that has it
    first = ["load_dts", e.key, "rec_src"]
    every = every.select(*first, *[c for c in every.columns if c not in first])
    hub, link = first_rows(every, e.hk, e.hk), first_rows(every, e.hk, customer.hk)
    return gold.dim_account(sat, hub, link)


def three_batches(lh) -> DataFrame:
    """The account satellite after a third batch that equals the first (A -> B -> A)."""
    first, _ = account_batches(lh.spark, lh.sf_dir)
    e, params, sat = ENTITIES["account"], lh.params.with_load_ts(THIRD_LOAD_TS), account_history(lh).sat
    return sat.unionByName(load_sat(bronze(first, e.source, params), e, params, sat))


#: Parts of the dimension in the registered upkeep query.
UPKEEP_BUCKETS = 16


def account_upkeep(lh) -> DataFrame:
    """The account dimension after three stored batches, kept up by the keys that each one touches."""
    store = TableStore(lh.spark, f"{ensure_checkpoint_dir(lh.spark)}/upkeep-{uuid.uuid4().hex}")
    first, second = account_batches(lh.spark, lh.sf_dir)
    dim = None
    for df, load_ts in zip((first, second, first), (lh.params.load_ts, SECOND_LOAD_TS, THIRD_LOAD_TS)):
        run = lh.params.with_load_ts(load_ts)
        for _, job in load_jobs(store, {"accounts": bronze(df, "accounts", run)}, run):
            job()
        dim = keep_dimension(store, "dim_account", "account_hub_key", ("sat_account", "hub_account", "link_customer_account"),
                             "hk_account", gold.dim_account, UPKEEP_BUCKETS)
    return dim

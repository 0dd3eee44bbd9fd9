"""Wiring of the layers for one run: sources -> bronze -> vault -> gold.

``Lakehouse`` holds lazily built DataFrames.  Nothing is computed until an
action; each property is memoised so a consumer that needs, say, the account
satellite twice shares one logical subtree (and Spark reuses its exchanges).
For production runs :mod:`ledgerlake.plans.pipeline` writes every table and
re-reads it, so downstream layers start from files, not from lineage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.keys import hash_key, unpacked_keys
from ledgerlake.operators import gold
from ledgerlake.operators.bronze import bronze
from ledgerlake.operators.skew import HOT_SHARE, hot_keys
from ledgerlake.operators.vault import (first_rows, load_hub, load_link, load_sat, packed_hub, packed_link,
                                        packed_rows, packed_sat, quarantine_of_batch)
from ledgerlake.params import DRIVER_RUN, RunParams
from ledgerlake.plans.entities import ENTITIES, LINKS
from ledgerlake.sources.driver_tables import banking_sources


class Lakehouse:
    """All layers of a single (first) load over the given sources."""

    def __init__(self, spark: SparkSession, sources: dict[str, DataFrame],
                 params: RunParams | None = None, sf_dir: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.sources = sources
        self.params = params or DRIVER_RUN
        self._hubs: dict[str, DataFrame] = {}
        self._links: dict[str, DataFrame] = {}
        self._sats: dict[str, DataFrame] = {}
        self._bronze: dict[str, DataFrame] = {}

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, params: RunParams | None = None):
        return cls(spark, banking_sources(spark, sf_dir), params, sf_dir)

    # -- bronze / vault -------------------------------------------------------
    def bronze(self, table: str) -> DataFrame:
        if table not in self._bronze:
            self._bronze[table] = bronze(self.sources[table], table, self.params)
        return self._bronze[table]

    def hub(self, entity: str) -> DataFrame:
        if entity not in self._hubs:
            e = ENTITIES[entity]
            self._hubs[entity] = load_hub(self.bronze(e.source), e, self.params)
        return self._hubs[entity]

    def link(self, name: str) -> DataFrame:
        if name not in self._links:
            l = LINKS[name]
            self._links[name] = load_link(self.bronze(l.source), l, self.params)
        return self._links[name]

    def sat(self, entity: str) -> DataFrame:
        if entity not in self._sats:
            e = ENTITIES[entity]
            self._sats[entity] = load_sat(self.bronze(e.source), e, self.params)
        return self._sats[entity]

    def keyed_link(self, name: str) -> DataFrame:
        """The link's rows for an inner join on its second hub's key (:func:`load_link`)."""
        l = LINKS[name]
        return load_link(self.bronze(l.source), l, self.params, keyed=True)

    def keyed_sat(self, entity: str) -> DataFrame:
        """The satellite's rows for an inner join on its hub key (:func:`load_sat`)."""
        e = ENTITIES[entity]
        return load_sat(self.bronze(e.source), e, self.params, keyed=True)

    def keyed_table(self, name: str) -> DataFrame:
        layer, _, rest = name.partition("_")
        return {"link": self.keyed_link, "sat": self.keyed_sat}[layer](rest)

    def packed_vault(self, entity: str, owner: str | None = None) -> list[DataFrame]:
        """Satellite and hub of ``entity`` and, with ``owner``, its link to that hub, for inner joins on the hub key:
        keys are packed, and the source is shuffled once for all of them."""
        e = ENTITIES[entity]
        owners = [ENTITIES[owner]] if owner else []
        rows = packed_rows(self.bronze(e.source), e, [], owners, with_key=True)
        return [packed_sat(rows, e, self.params), packed_hub(rows, e), *[first_rows(rows, e.hk, o.hk) for o in owners]]

    def packed_versions(self, child: str, parent: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Satellite of ``child``, its link to ``parent`` and the satellite of that, for inner joins on their hub keys:
        keys are packed, each source table is shuffled once by its own key."""
        c, p = ENTITIES[child], ENTITIES[parent]
        rows, parents = packed_rows(self.bronze(c.source), c, [p], []), packed_rows(self.bronze(p.source), p, [], [])
        return packed_sat(rows, c, self.params), first_rows(rows, c.hk, p.hk), packed_sat(parents, p, self.params)

    @cached_property
    def quarantine(self) -> DataFrame:
        return quarantine_of_batch({e.source: self.bronze(e.source) for e in ENTITIES.values()}, self.params)

    # -- gold -------------------------------------------------------------------
    @cached_property
    def dim_customer(self) -> DataFrame:
        return unpacked_keys(gold.dim_customer(*self.packed_vault("customer")))

    @cached_property
    def dim_account(self) -> DataFrame:
        return unpacked_keys(gold.dim_account(*self.packed_vault("account", "customer")))

    @cached_property
    def dim_card(self) -> DataFrame:
        return unpacked_keys(gold.dim_card(*self.packed_vault("card", "account")))

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return unpacked_keys(gold.dim_merchant(*self.packed_vault("merchant")))

    @cached_property
    def dim_branch(self) -> DataFrame:
        return unpacked_keys(gold.dim_branch(*self.packed_vault("branch")))

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.spark)

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return self.transactions_fact()

    def transactions_fact(self, hot_share: float | None = None, dealt: bool = False) -> DataFrame:
        """The fact; ``dealt``: packed and partitioned by account and sub-key of :attr:`hot_accounts`."""
        tx, account, merchant = (ENTITIES[n] for n in ("transaction", "account", "merchant"))
        rows = packed_rows(self.bronze(tx.source), tx, [account], [merchant])    # one shuffle for all three
        return gold.fact_transactions(packed_sat(rows, tx, self.params), first_rows(rows, tx.hk, account.hk),
                                      first_rows(rows, tx.hk, merchant.hk),
                                      packed_link(self.bronze(account.source), LINKS["customer_account"]),
                                      hot_share=hot_share, hot_from=self.account_rows if hot_share else None,
                                      dealt_by=self.hot_accounts if dealt else None)

    @cached_property
    def account_rows(self) -> DataFrame:
        """``hk_account`` of each transaction, as in bronze: shows hot accounts without the fact."""
        return self.bronze("transactions").select(hash_key("account_id").alias("hk_account"))

    @cached_property
    def hot_accounts(self) -> DataFrame:
        """Accounts with more than ``HOT_SHARE`` of the transactions, packed."""
        return hot_keys(self.account_rows.select(F.unhex("hk_account").alias("hk_account")), "hk_account", HOT_SHARE)

    @cached_property
    def account_activity(self) -> DataFrame:
        """``_rows`` transactions by ``hk_account``, counted in bronze."""
        return self.account_rows.groupBy("hk_account").agg(F.count(F.lit(1)).alias("_rows"))

    @cached_property
    def customer_activity(self) -> DataFrame:
        """``_rows`` transactions by ``hk_customer``, likewise."""
        return (self.account_activity.join(self.keyed_link("customer_account"), "hk_account")
                .groupBy("hk_customer").agg(F.sum("_rows").alias("_rows")))

    @cached_property
    def fact_loans(self) -> DataFrame:
        sat, _, link = self.packed_vault("loan", "customer")
        return unpacked_keys(gold.fact_loans(sat, link))

    @cached_property
    def fact_account_balance(self) -> DataFrame:
        sat, _, link = self.packed_vault("account", "customer")
        return unpacked_keys(gold.fact_account_balance(sat, link))

    def table(self, name: str) -> DataFrame:
        """Look a table up by its model name (``hub_customer``, ``dim_card`` ...)."""
        layer, _, rest = name.partition("_")
        if layer == "bronze":
            return self.bronze(rest)
        if layer == "hub":
            return self.hub(rest)
        if layer == "link":
            return self.link(rest)
        if layer == "sat":
            return self.sat(rest)
        if name == "dim_account_history":
            from ledgerlake.plans.incremental import account_history
            return account_history(self).dim
        if name in self.sources:
            return self.sources[name]
        return getattr(self, name)

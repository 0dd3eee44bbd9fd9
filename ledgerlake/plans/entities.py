"""Entity catalogue: the vault is generated from data, not seven copies of code.

Each entity row names its source table, business key, cleaned attributes (in
``hash_diff`` order), its validity rule and its quarantine reason.  Hubs,
satellites, quarantine, bronze and checks are all driven from this table.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.banking import (ACCOUNT_TYPES, CARD_TYPES, CREDIT_SCORE_RANGE,
                                          EMAIL_PATTERN, INTEREST_RATE_RANGE)
from ledgerlake.functions.text import clean_lower, clean_text, clean_title

Cleaner = Callable[[Column], Column]


def _keep(c: Column) -> Column:
    return c


def _null_or(c: Column, cond: Column) -> Column:
    return c.isNull() | cond


@dataclass(frozen=True)
class Entity:
    name: str
    source: str
    key: str
    attrs: tuple[tuple[str, Cleaner], ...]
    # validity rule over the cleaned columns; receives the load time column
    valid: Callable[[Callable[[str], Column], Column], Column]
    reason: str

    @property
    def hk(self) -> str:
        return f"hk_{self.name}"

    @property
    def attr_names(self) -> list[str]:
        return [a for a, _ in self.attrs]


@dataclass(frozen=True)
class Link:
    a: str          # entity name of the first hub
    b: str          # entity name of the second hub
    source: str     # source table carrying both keys

    @property
    def name(self) -> str:
        return f"{self.a}_{self.b}"

    @property
    def hk(self) -> str:
        return f"hk_link_{self.a}_{self.b}"


# Quarantine reason texts, one per entity, as in the reference.
REASONS = {
    "customer": "failed customer validation: email format, credit_score range (300-850), or created_at in the future",
    "account": "failed account validation: balance_usd negative or account_type not recognized",
    "card": "failed card validation: card_type not recognized",
    "merchant": "failed merchant validation: merchant_name is null or empty",
    "branch": "failed branch validation: branch_name is null or empty",
    "loan": "failed loan validation: loan_amount not positive or interest_rate outside 0-100",
    "transaction": "failed transaction validation: amount_usd not positive or transaction_date in the future",
}


def _customer_valid(c, now):
    lo, hi = CREDIT_SCORE_RANGE
    return (_null_or(c("email"), c("email").rlike(EMAIL_PATTERN))
            & _null_or(c("credit_score"), c("credit_score").between(lo, hi))
            & _null_or(c("created_at"), c("created_at") <= now))


def _account_valid(c, now):
    return (_null_or(c("balance_usd"), c("balance_usd") >= 0)
            & _null_or(c("account_type"), c("account_type").isin(*ACCOUNT_TYPES)))


def _card_valid(c, now):
    return _null_or(c("card_type"), c("card_type").isin(*CARD_TYPES))


def _name_valid(col):
    return lambda c, now: c(col).isNotNull() & (c(col) != "")


def _loan_valid(c, now):
    lo, hi = INTEREST_RATE_RANGE
    return (_null_or(c("loan_amount"), c("loan_amount") > 0)
            & _null_or(c("interest_rate"), c("interest_rate").between(lo, hi)))


def _transaction_valid(c, now):
    return (_null_or(c("amount_usd"), c("amount_usd") > 0)
            & _null_or(c("transaction_date"), c("transaction_date") <= now))


ENTITIES: dict[str, Entity] = {e.name: e for e in [
    Entity("customer", "customers", "customer_id",
           (("first_name", clean_title), ("last_name", clean_title), ("email", clean_lower),
            ("city", clean_title), ("credit_score", _keep), ("created_at", _keep)),
           _customer_valid, REASONS["customer"]),
    Entity("account", "accounts", "account_id",
           (("account_type", clean_text), ("balance_usd", _keep), ("open_date", _keep)),
           _account_valid, REASONS["account"]),
    Entity("card", "cards", "card_id",
           (("card_type", clean_text), ("expiration_date", _keep)),
           _card_valid, REASONS["card"]),
    Entity("merchant", "merchants", "merchant_id",
           (("merchant_name", clean_text), ("city", clean_title)),
           _name_valid("merchant_name"), REASONS["merchant"]),
    Entity("branch", "branches", "branch_id",
           (("branch_name", clean_title), ("manager_name", clean_title), ("city", clean_title),
            ("country", clean_text)),
           _name_valid("branch_name"), REASONS["branch"]),
    Entity("loan", "loans", "loan_id",
           (("loan_amount", _keep), ("interest_rate", _keep), ("start_date", _keep)),
           _loan_valid, REASONS["loan"]),
    Entity("transaction", "transactions", "transaction_id",
           (("amount_usd", _keep), ("transaction_date", _keep)),
           _transaction_valid, REASONS["transaction"]),
]}

LINKS: dict[str, Link] = {l.name: l for l in [
    Link("customer", "account", "accounts"),
    Link("account", "card", "cards"),
    Link("customer", "loan", "loans"),
    Link("account", "transaction", "transactions"),
    Link("merchant", "transaction", "transactions"),
]}

ENTITY_ORDER = list(ENTITIES)


def key_of(entity_name: str) -> str:
    return ENTITIES[entity_name].key


def col_getter(df=None):
    return (lambda name: F.col(name)) if df is None else (lambda name: df[name])

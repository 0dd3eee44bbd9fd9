"""Appending one batch to the stored vault; shared by the pipeline and the stream writer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ledgerlake.operators.vault import current_hashes, load_hub, load_link, load_sat
from ledgerlake.params import RunParams
from ledgerlake.plans.entities import ENTITIES, LINKS, Entity
from ledgerlake.sources.sinks import TableStore, batch_tag

# Bucket key of each silver table in catalog mode: the key its consumers join
# on (links are joined on the hub they describe, not on their own key).
SILVER_BUCKET_KEYS = {
    **{f"hub_{e}": f"hk_{e}" for e in ENTITIES},
    **{f"sat_{e}": f"hk_{e}" for e in ENTITIES},
    "link_customer_account": "hk_account",
    "link_account_card": "hk_card",
    "link_customer_loan": "hk_loan",
    "link_account_transaction": "hk_transaction",
    "link_merchant_transaction": "hk_transaction",
}
#: Snapshots kept per satellite: the newest, and the one a retry of its run starts from.
SNAPSHOTS = 2


def _append(store: TableStore, name: str, run: RunParams,
            build: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    key = SILVER_BUCKET_KEYS[name]
    return store.append_batch(build(store.existing("silver", name, run, key)), "silver", name, run, key)


def _append_sat(store: TableStore, bronze_df: DataFrame, e: Entity, run: RunParams) -> DataFrame:
    """The satellite's batch, and the snapshot of current hashes that it leaves
    behind.  A snapshot is named by the batch it covers: it drives the change
    detection only if no other run has appended since, else the history does."""
    name, snap, own = f"sat_{e.name}", f"sat_{e.name}__current", batch_tag(run)
    store.check_newer(name, run)
    covered = [t for t in store.tags("silver", name) if t != own]
    snapshots = [t for t in store.tags("silver", snap) if t != own]
    if not covered:
        previous = None
    elif snapshots and snapshots[-1] == covered[-1]:
        previous = store.batch("silver", snap, snapshots[-1], e.hk)
    else:
        previous = current_hashes(None, store.existing("silver", name, run, e.hk), e.hk, store.narrow)
    stored = store.append_batch(load_sat(bronze_df, e, run, previous, narrow=store.narrow), "silver", name, run, e.hk)
    new = store.batch("silver", name, own, e.hk)
    store.append_batch(current_hashes(previous, new, e.hk, store.narrow), "silver", snap, run, e.hk)
    for old in [t for t in store.tags("silver", snap) if t != own][:-(SNAPSHOTS - 1)]:
        store.drop_batch("silver", snap, old)
    return stored


def check_order(store: TableStore, run: RunParams, sources) -> None:
    """Refuse the whole run before it writes anything if a satellite of one of
    ``sources`` already holds a batch of another run that is as new."""
    for e in ENTITIES.values():
        if e.source in sources:
            store.check_newer(f"sat_{e.name}", run)


def load_jobs(store: TableStore, bronze_tables: dict[str, DataFrame], run: RunParams
              ) -> list[tuple[str, Callable[[], DataFrame]]]:
    """(model, append job) of every hub, satellite and link fed by the given bronze tables."""
    jobs: list[tuple[str, Callable[[], DataFrame]]] = []
    for e in ENTITIES.values():
        if e.source in bronze_tables:
            b = bronze_tables[e.source]
            jobs.append((f"hub_{e.name}", lambda b=b, e=e: _append(
                store, f"hub_{e.name}", run, lambda ex: load_hub(b, e, run, ex, store.narrow))))
            jobs.append((f"sat_{e.name}", lambda b=b, e=e: _append_sat(store, b, e, run)))
    for l in LINKS.values():
        if l.source in bronze_tables:
            b = bronze_tables[l.source]
            jobs.append((f"link_{l.name}", lambda b=b, l=l: _append(
                store, f"link_{l.name}", run, lambda ex: load_link(b, l, run, ex))))
    return jobs

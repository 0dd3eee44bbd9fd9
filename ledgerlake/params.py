"""Run parameters.

The reference reads ``current_timestamp`` / ``current_date`` inside every
model; here "now" is fixed once per run, so that a retried batch computes the
same rows.  A run has an id: stored batches are named by load time and run id,
and only the same run may write its batch again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values used by the driver-table runs (FIXTURES.md §3).
DEFAULT_LOAD_TS = dt.datetime(2024, 1, 1, 0, 0, 0)
SECOND_LOAD_TS = dt.datetime(2024, 2, 1, 0, 0, 0)
THIRD_LOAD_TS = dt.datetime(2024, 3, 1, 0, 0, 0)
# Two load times inside the range of the transactions' dates.
EVENT_LOADS = (dt.datetime(2017, 1, 1), dt.datetime(2019, 1, 1))
DEFAULT_AS_OF = dt.date(2021, 8, 1)
DEFAULT_SOURCE = "driver_parquet"


def utc_now() -> dt.datetime:
    """The current instant as a zone-free UTC time."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class RunParams:
    """One pipeline run: load time (stamped on every vault row), report date
    (``current_date`` of the reports), the audit source tag of bronze and the
    run's id.  Times default to the moment the run is described; a retry
    passes the same object, or the same load time and run id."""

    load_ts: dt.datetime = field(default_factory=utc_now)
    as_of: dt.date = field(default_factory=lambda: utc_now().date())
    source_tag: str = DEFAULT_SOURCE
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    @property
    def load_ts_col(self) -> Column:
        return ts_literal(self.load_ts)

    @property
    def as_of_col(self) -> Column:
        return F.lit(self.as_of)

    def with_load_ts(self, load_ts: dt.datetime) -> "RunParams":
        """Another run of the same settings."""
        return replace(self, load_ts=load_ts, run_id=uuid.uuid4().hex[:12])


def ts_literal(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (business times carry no zone)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def sql_ts(value: dt.datetime) -> str:
    """The same instant as a SQL literal (for oracle SQL)."""
    return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S.%f')}'"


def sql_date(value: dt.date) -> str:
    return f"DATE '{value.isoformat()}'"


#: The fixed run of the registered queries over the driver's tables.
DRIVER_RUN = RunParams(DEFAULT_LOAD_TS, DEFAULT_AS_OF, DEFAULT_SOURCE, "driver")

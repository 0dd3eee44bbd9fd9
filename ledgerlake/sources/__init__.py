from ledgerlake.sources.driver_tables import account_batches, banking_sources
from ledgerlake.sources.readers import check_sources, read_source
from ledgerlake.sources.schemas import SOURCE_SCHEMAS, SOURCE_TABLES

__all__ = ["account_batches", "banking_sources", "check_sources", "read_source",
           "SOURCE_SCHEMAS", "SOURCE_TABLES"]

"""Sources: raw CSV actions, stored tables, dimensions, and the driver-table bindings."""

from creditlake.sources.csv import read_raw_actions
from creditlake.sources.dimensions import organizations_from, users_from
from creditlake.sources.tables import read_parquet_table

__all__ = ["organizations_from", "read_parquet_table", "read_raw_actions", "users_from"]

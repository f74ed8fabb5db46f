"""Organisation and user dimensions.

Dimensions are plain DataFrames projected onto their contracts; ``created_at``
takes the current time when the source has none (the table default).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.schemas import ORGANIZATIONS, USERS


def _project(df: DataFrame, contract, renames: dict[str, str | Column]) -> DataFrame:
    cols = []
    for field in contract.fields:
        source = renames.get(field.name, field.name)
        if isinstance(source, Column):
            expr = source
        elif source in df.columns:
            expr = F.col(source)
        elif field.name == "created_at":
            expr = F.current_timestamp()
        else:
            expr = F.lit(None)
        cols.append(expr.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def organizations_from(df: DataFrame, **renames) -> DataFrame:
    """Project any frame onto (org_id, org_name, industry, created_at)."""
    return _project(df, ORGANIZATIONS, renames)


def users_from(df: DataFrame, **renames) -> DataFrame:
    """Project any frame onto (user_id, user_name, email, org_id, role, created_at)."""
    return _project(df, USERS, renames)

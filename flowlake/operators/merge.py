"""Merges on plain tables: each returns what to append or the whole new content."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowlake.operators.joins import lookup_join, missing_from_large, missing_rows
from flowlake.schemas import AUDIT_COLUMNS


def data_columns(df: DataFrame) -> list[str]:
    """Columns that carry data, without the audit columns."""
    return [c for c in df.columns if c not in AUDIT_COLUMNS]


def insert_only(source: DataFrame, target: DataFrame, keys: list[str], *, large: bool = False) -> DataFrame:
    """Source rows to append: those whose key the target lacks.

    Copies of one new key inside the source all get in, and a NULL key never matches. ``large`` says that
    the target is much larger than the source: a filter of its keys then decides most rows without a shuffle.
    """
    missing = missing_from_large if large else missing_rows
    return missing(source, target, {k: k for k in keys})


def upsert(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """New content of the target: matched rows replaced, others kept, new ones added.

    Write the result to a new path: plain files can not be overwritten while they are read.
    """
    incoming = source.select(*keys).distinct()
    kept = lookup_join(target, incoming, {k: k for k in keys}, "left_anti")
    return kept.unionByName(source)


def insert_new_rows(source: DataFrame, target: DataFrame, *, large: bool = False) -> DataFrame:
    """Source rows to append: those no target row equals on every data column, NULL = NULL.

    ``large`` as for :func:`insert_only`.
    """
    missing = missing_from_large if large else missing_rows
    return missing(source, target, {c: c for c in data_columns(target)}, null_safe=True)

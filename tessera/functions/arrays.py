"""Array-to-rows helpers.

A plain ``explode``/``posexplode`` makes Catalyst infer ``size(arr) > 0 AND arr IS NOT NULL``
and push it below the projection that builds ``arr``; when ``arr`` is an expensive expression
(regex passes, JSON parsing, a sentence split) it is then evaluated twice per row.  The outer
generators infer no such filter; the one null row they emit for an empty array is dropped
right after the generator instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def posexplode_rows(df: DataFrame, keep: list, arr: Column | str, pos_name: str, val_name: str) -> DataFrame:
    out = df.select(*keep, F.posexplode_outer(arr).alias(pos_name, val_name))
    return out.where(F.col(pos_name).isNotNull())


def explode_rows(df: DataFrame, keep: list, arr: Column | str, name: str) -> DataFrame:
    """One row per non-null element."""
    out = df.select(*keep, F.explode_outer(arr).alias(name))
    return out.where(F.col(name).isNotNull())

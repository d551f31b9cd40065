"""Helpers that the corpus operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name prefix of helper columns, so that columns of the input never clash.
OWN = "__mr_"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def content_key(column: str = "text") -> Column:
    """First 16 bytes of the text's SHA-256. Results that depend on the text
    alone are keyed by it, so null or repeated ids do no harm."""
    return F.substring(F.unhex(F.sha2(text_or_empty(column).cast("binary"), 256)), 1, 16)


def n_bytes(column: str = "text") -> Column:
    return F.octet_length(text_or_empty(column)).cast("long")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def require_whole(df: DataFrame, column: str) -> None:
    """Ids that are no whole numbers would get lost in a cast."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.IntegralType | T.NullType):
        raise TypeError(f"{column} is {kind.simpleString()}; whole numbers are needed")


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps between tasks.

    Functions travel with the job and get fresh globals in every task, so the
    object hangs on a module of the worker process. It only saves work: a new
    worker builds its own.
    """
    home = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)

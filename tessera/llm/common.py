"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word of the query contracts: a run without these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with `value` computed once, also where `body` uses it
    inside lambdas (an inlined expression would be computed per element)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def without_spaces(text: Column) -> Column:
    for c in SPACE_CHARS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def spare_name(df: DataFrame, base: str) -> str:
    """A column name that `df` does not use yet (case-insensitively)."""
    used = {c.lower() for c in df.columns}
    name, n = f"_{base}", 0
    while name in used:
        n += 1
        name = f"_{base}{n}"
    return name


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo `n`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def worker_cache(key: Hashable, make: Callable[[], Any]) -> Any:
    """`make()`, once per Python worker.  Functions reach a worker by value and
    anew for each task, so their globals can't hold what should outlast one."""
    held = sys.modules.setdefault("tessera_worker_cache", types.ModuleType("tessera_worker_cache")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]

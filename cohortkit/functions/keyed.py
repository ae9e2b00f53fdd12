"""Keyed pseudo-random values.

The reference draws ``RAND(NEWID())`` once per person. A lazily evaluated ``rand()`` can give a
different value when a task is retried or a branch recomputed, so two tables of one person
could shift apart. Here every value is a pure function of a secret salt and the key:
retries, lost executors and re-runs give the same shift, and no map has to be collected.

value = pmod(first 60 bits of sha256(salt | '|' | key [| '|' | purpose]), modulus)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uint(salt: str, key: Column, purpose: str | None = None) -> Column:
    parts = [F.lit(salt), F.lit("|"), key.cast("string")]
    if purpose:
        parts += [F.lit("|"), F.lit(purpose)]
    digest = F.sha2(F.concat(*parts), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def keyed_mod(salt: str, key: Column, modulus: int, purpose: str | None = None) -> Column:
    return F.pmod(keyed_uint(salt, key, purpose), F.lit(int(modulus)))


def date_shift(salt: str, key: Column, max_shift: int = 183) -> Column:
    """Uniform integer in [-max_shift, max_shift]."""
    return (keyed_mod(salt, key, 2 * max_shift + 1) - max_shift).cast("int")


def replacement_birth_year(salt: str, key: Column, as_of_year: int, over_age: int = 89) -> Column:
    """Year giving an age in [over_age+1, over_age+10] at ``as_of_year``."""
    return (F.lit(as_of_year - (over_age + 1)) - keyed_mod(salt, key, 10, "birth_year")).cast("int")


def sql_keyed_uint(salt: str, key_sql: str, purpose: str | None = None) -> str:
    """DuckDB text of :func:`keyed_uint` (for the oracle)."""
    text = f"'{salt}|' || CAST({key_sql} AS VARCHAR)"
    if purpose:
        text += f" || '|{purpose}'"
    return f"CAST(('0x' || substr(sha256({text}), 1, 15)) AS BIGINT)"

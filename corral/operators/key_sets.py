"""Set rules (``unique``, ``foreign_key``) by staged key sets.

A first pass reads only the key columns and finds the violating keys, with the
number of rows that hold each.  They are aggregated before they are shuffled
and written out, so their true size is known before the rows are touched.  All
rules on the same columns share one set and one join: with few violating keys
Spark broadcasts the set and the full-width rows are not shuffled at all; with
many, hot keys are salted, so no key's rows meet in one task.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corral.functions.rules import SetRule
from corral.session import scratch_location

Keep = Callable[[DataFrame, str], DataFrame]
COUNT = "__n"
_SALT = "__salt"
#: A violating key is hot if it holds at least this share of the violating rows:
#: at most 1 / HOT_SHARE keys, however large the table.
HOT_SHARE = 0.01


def keep_in_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    path = scratch_location(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _key(i: int) -> str:
    return f"__k{i}"


def column_sets(rules: Sequence[tuple[str, SetRule]]) -> dict[tuple[str, ...], list[tuple[str, SetRule]]]:
    """The rules (flag name, rule) by the columns that they look at."""
    sets: dict[tuple[str, ...], list[tuple[str, SetRule]]] = {}
    for flag, rule in rules:
        sets.setdefault(rule.keys, []).append((flag, rule))
    return sets


def violating_keys(df: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, SetRule]]) -> DataFrame:
    """(key columns, flags, rows holding the key) of the keys that violate any of
    ``rules``; one aggregation over the key columns for all of them."""
    names = [_key(i) for i in range(len(keys))]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias(COUNT))
    for flag, rule in rules:
        counts = rule.flag_keys(counts, names, COUNT, flag)
    flags = [flag for flag, _ in rules]
    violated = reduce(lambda a, b: a | b, [F.col(f) for f in flags])
    return counts.where(violated).select(*names, *flags, COUNT)


def _hot_keys(found: DataFrame, names: Sequence[str]) -> list[int]:
    """Hashes of the hot violating keys: at most ``1 / HOT_SHARE`` longs."""
    total = found.agg(F.sum(COUNT).alias("n")).first()["n"] or 0
    least = max(2, int(total * HOT_SHARE))
    return [r["h"] for r in found.where(F.col(COUNT) >= least).select(F.xxhash64(*names).alias("h")).collect()]


def _salts(df: DataFrame) -> int:
    """Salts of a hot key: a few per shuffle partition, so that they fill all of them."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_key_set(df: DataFrame, keys: Sequence[str], found: DataFrame, how: str = "left") -> DataFrame:
    """``df`` with the columns of ``found`` (``__k0``.., others), joined null-safely on
    ``keys``.  A row of a hot key goes to one of many salts, and the key's row in
    ``found`` stands once per salt."""
    names = [_key(i) for i in range(len(keys))]
    hot = _hot_keys(found, names)
    on: list[Column] = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    if hot:
        salts = _salts(df)
        spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
        df = df.withColumn(_SALT, F.when(F.xxhash64(*keys).isin(hot), spread).otherwise(F.lit(0)))
        copies = F.when(F.xxhash64(*names).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        found = found.withColumn("__copy", F.explode(copies))
        on.append(F.col(_SALT) == F.col("__copy"))
    return df.join(found, on=on, how=how).drop(*names, _SALT, "__copy")


def attach_flags(df: DataFrame, rules: Sequence[tuple[str, SetRule]], keep: Keep = keep_in_scratch) -> DataFrame:
    """``df`` with one boolean column per rule: True on every row that violates it."""
    out = df
    for i, (keys, members) in enumerate(column_sets(rules).items()):
        flags = [flag for flag, _ in members]
        found = keep(violating_keys(df, keys, members), f"violating_keys_{i}")
        if found.isEmpty():
            out = out.select("*", *[F.lit(False).alias(f) for f in flags])
            continue
        out = join_key_set(out, keys, found).drop(COUNT)
        out = out.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})
    return out


def duplicate_rows(df: DataFrame, keys: Sequence[str], count_col: str = "n", keep: Keep = keep_in_scratch) -> DataFrame:
    """The rows whose key occurs more than once, with how often it does."""
    from corral.functions.rules import unique

    found = keep(violating_keys(df, keys, [("__dup", unique(*keys))]), "duplicate_keys").drop("__dup")
    return join_key_set(df, keys, found, "inner").withColumnRenamed(COUNT, count_col)

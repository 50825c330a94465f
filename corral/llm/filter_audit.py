"""Audit of how filters overlap: what each one removes, at each step of each order.

A document's fate under every order of the filters depends only on its mask,
the set of filters that it fails.  Each mask is mapped to one big integer
whose 64-bit fields hold all outcomes of all steps of all orders; the integers
are summed per part, one multiplication per mask, and the sum is unpacked.  A
field counts documents, so it stays far under 2 ** 63 and never runs into the
next one.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = tuple(permutations(range(len(FILTERS))))
CELLS = len(ORDERS) * len(FILTERS)
OUTCOMES = ("kept", "removed", "redundant", "unique_fails")
FIELD_BYTES = 8
COPY_BIT = 1 << FILTERS.index("E")

RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)

# The characters that part words, and what filters C and D look for.
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = r"[#$%&*|]"


def text_mask(text: Column) -> Column:
    """Bits of the filters that a text alone decides: A under 100 words, B under
    80 % distinct words, C over 10 % capital letters, D a symbol."""
    words = F.array_remove(F.split(text, SPACES, -1), "")
    n_words = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    fails = [
        n_words < 100,
        100 * F.size(F.array_distinct(words)) < 80 * n_words,
        100 * capitals > 10 * F.length(text),
        text.rlike(SYMBOLS),
    ]
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails[1:], 1)), fails[0].cast("int"))


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``(part, mask, good, toxic, n)``: documents by what they fail and their labels.

    Copies are found by the SHA-256 of the text.  All rows of a text share the
    bits that the text decides, so a group of copies is one row per part and
    label before its smallest id is looked for, however many rows it has.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("copy_key"),
        text_mask(text).alias("mask"),
    )
    marks = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    )
    no = F.lit(False)
    per_text = (
        rows.where("doc_id is not null")
        .groupBy("doc_id", "part", "copy_key", "mask")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(marks, "doc_id", "left")
        .groupBy("copy_key", "mask", "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
        .agg(F.sum("n").alias("n"), F.min("doc_id").alias("lowest"), F.min_by("n", "doc_id").alias("n_lowest"))
    )
    first = F.col("lowest") == F.min("lowest").over(Window.partitionBy("copy_key"))
    split = per_text.withColumn("n_first", F.when(first, F.col("n_lowest")).otherwise(F.lit(0).cast("long"))).select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask").alias("mask"), F.col("n_first").alias("n")),
                F.struct((F.col("mask") + COPY_BIT).alias("mask"), (F.col("n") - F.col("n_first")).alias("n")),
            )
        ),
    )
    keys = ["part", "mask", "good", "toxic"]
    known = split.where("n > 0").groupBy(*keys).agg(F.sum("n").alias("n"))
    unknown = rows.where("doc_id is null").groupBy("part", "mask", no.alias("good"), no.alias("toxic")).agg(F.count(F.lit(1)).alias("n"))
    return known.unionByName(unknown).groupBy(*keys).agg(F.sum("n").alias("n"))


def step_outcomes(mask: int) -> np.ndarray:
    """0 or 1 for each outcome (rows) at each step of each order (columns)."""
    out = np.zeros((len(OUTCOMES), CELLS), dtype="<u8")
    for o, order in enumerate(ORDERS):
        gone = False
        for step, f in enumerate(order):
            fails, cell = bool(mask >> f & 1), o * len(FILTERS) + step
            out[1, cell] = fails and not gone
            out[2, cell] = fails and gone
            out[3, cell] = mask == 1 << f
            gone = gone or fails
            out[0, cell] = not gone
    return out


@cache
def packed(mask: int) -> tuple[int, int]:
    """The big integer with all outcomes of a mask, and the one of removals alone."""
    cells = step_outcomes(mask)
    return int.from_bytes(cells.tobytes(), "little"), int.from_bytes(cells[1].tobytes(), "little")


def unpacked(total: int, fields: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(fields * FIELD_BYTES, "little"), dtype="<u8").astype("int64")


def step_table(part: str, counts: Iterable[tuple[int, bool, bool, int]]) -> pd.DataFrame:
    """The rows of one part from its ``(mask, good, toxic, n)``: at most 128 of them."""
    total = good_lost = toxic_lost = 0
    for mask, good, toxic, n in counts:
        everything, removals = packed(int(mask))
        total += int(n) * everything
        good_lost += int(n) * removals * bool(good)
        toxic_lost += int(n) * removals * bool(toxic)
    table = unpacked(total, len(OUTCOMES) * CELLS).reshape(len(OUTCOMES), CELLS)
    of_cell = np.array(ORDERS).ravel()
    shapley = np.bincount(of_cell, minlength=len(FILTERS)) * 0
    np.add.at(shapley, of_cell, table[1])
    out = {
        "part": part,
        "filter_order": np.repeat(["".join(FILTERS[f] for f in order) for order in ORDERS], len(FILTERS)),
        "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype="int32"), len(ORDERS)),
    }
    out |= dict(zip(OUTCOMES, table))
    out |= {
        "good_lost": unpacked(good_lost, CELLS),
        "toxic_lost": unpacked(toxic_lost, CELLS),
        "shapley": shapley[of_cell],
    }
    return pd.DataFrame(out)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step.

    A null text is empty and a null part the empty string.  Filter E fails a row
    whose text a smaller id has: rows that share the smallest id all pass, and a
    row without an id neither fails E nor makes others fail (nor has labels).
    A label counts if any label row of the id is 1.  Other columns, whatever
    their names, are left behind.  Empty table: no parts, so no rows.
    """
    counts = mask_counts(docs, labels, id_col, text_col, part_col)

    def table(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return step_table(key[0], zip(rows["mask"], rows["good"], rows["toxic"], rows["n"]))

    return counts.groupBy("part").applyInPandas(table, RESULT)


#: The audit in DuckDB, without packing: every order and step joined to the counts.
AUDIT_SQL = r"""
WITH f(i) AS (VALUES (0),(1),(2),(3),(4)),
o AS (SELECT a.i AS i1,b.i AS i2,c.i AS i3,d.i AS i4,e.i AS i5 FROM f a,f b,f c,f d,f e
  WHERE len(list_distinct([a.i,b.i,c.i,d.i,e.i]))=5),
s AS (SELECT concat(substr('ABCDE',i1+1,1),substr('ABCDE',i2+1,1),substr('ABCDE',i3+1,1),substr('ABCDE',i4+1,1),substr('ABCDE',i5+1,1)) AS filter_order,
  unnest([1,2,3,4,5]) AS step, unnest([1<<i1,1<<i2,1<<i3,1<<i4,1<<i5]) AS bit,
  unnest([0,1<<i1,(1<<i1)+(1<<i2),(1<<i1)+(1<<i2)+(1<<i3),31-(1<<i5)]) AS earlier FROM o),
d AS (SELECT doc_id, coalesce(lang,'') AS part, coalesce(text,'') AS t,
  list_filter(regexp_split_to_array(coalesce(text,''),'[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality=1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic=1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good,0) AS good, coalesce(toxic,0) AS toxic,
  CASE WHEN len(w)<100 THEN 1 ELSE 0 END + CASE WHEN 100*len(list_distinct(w))<80*len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100*(length(t)-length(regexp_replace(t,'[A-Z]','','g')))>10*length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t,'[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM d LEFT JOIN l ON d.doc_id=l.doc_id),
c AS (SELECT part,good,toxic,mask,count(*) AS n FROM m GROUP BY ALL),
r AS (SELECT part,filter_order,step,bit,
  sum(CASE WHEN mask&(earlier|bit)=0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask&bit<>0 AND mask&earlier=0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask&bit<>0 AND mask&earlier<>0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask=bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask&bit<>0 AND mask&earlier=0 THEN n*good ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask&bit<>0 AND mask&earlier=0 THEN n*toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part,filter_order,step,bit)
SELECT part,filter_order,CAST(step AS INT) AS step,CAST(kept AS BIGINT) AS kept,CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant,CAST(unique_fails AS BIGINT) AS unique_fails,CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,CAST(sum(removed) OVER (PARTITION BY part,bit) AS BIGINT) AS shapley FROM r
"""

"""Secret scans: fixed patterns, and strings that look random to Markov models.

Everything here is DataFrame expressions; positions are code points, ends
exclusive.
"""

from __future__ import annotations

import json
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corral.llm.common import blocks_of, let, texts_of

# The base patterns, and the least length of the part that counts.
_KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = _KEYWORD + r"[A-Za-z0-9+/_.=-]+"
ASSIGN_VALUE = "^" + _KEYWORD + r"([A-Za-z0-9+/_.=-]+)$"
ACCESS = r"AKIA[A-Z0-9]{12,}"  # 16 characters in all; a shorter run holds no match
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"  # whole runs only
KINDS = ("assign", "access", "hex", "random")

#: Characters of the Markov models; candidates are runs of them.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
#: Shortest run that the ordinary class is trained on: words as well as long runs.
_LEAST_RUN = 4


def _running(items: Column, step, kind: str, inside=None) -> Column:
    """Walk ``items`` with ``step(acc, item)`` over ``(at, found)``, ``found`` an array of type
    ``kind``; returns ``at`` and the ``found`` of every block.  ``inside(acc, block)`` gives what
    the step of a block is told (once per block)."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("found"))

    def walk(acc, block):
        begin = F.struct(acc["at"].alias("at"), F.array().cast(kind).alias("found"))
        if inside is None:
            done = F.aggregate(block, begin, step)
        else:
            done = let(inside(acc, block), lambda told: F.aggregate(block, begin, lambda a, x: step(a, x, acc, told)))
        return let(done, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["found"], F.array(r["found"])).alias("found")))

    return F.aggregate(blocks_of(items), start, walk)


def spans_of(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """Array of ``(start, end, rank, match)`` of the leftmost non-overlapping
    matches (never empty ones).  The text between the matches gives the places."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("hit"))
    kind = "array<struct<start:int,end:int,rank:int,hit:string>>"

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        one = F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), x["hit"].alias("hit"))
        found = F.when(x["hit"].isNotNull(), F.concat(acc["found"], F.array(one))).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    found = let(_running(parts, step, kind), lambda r: F.flatten(r["found"]))
    if keep is not None:
        found = F.filter(found, lambda s: keep(s["hit"]))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(kind))


def _pairs(strings: DataFrame) -> DataFrame:
    """Neighbouring character codes (places in the alphabet) of the distinct strings
    ``s`` of each ``label``, and how often they stand there."""
    codes = F.filter(
        F.transform(F.split("s", ""), lambda c: F.instr(F.lit(ALPHABET), c)), lambda c: c > 0
    )
    pair = F.transform(F.sequence(F.lit(1), F.size("c") - 1), lambda i: F.struct(F.get("c", i - 1).alias("a"), F.get("c", i).alias("b")))
    return (
        strings.groupBy("label", "s")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("label", "n", codes.alias("c"))
        .where(F.size("c") > 1)
        .select("label", "n", F.explode(pair).alias("p"))
        .groupBy("label", "p.a", "p.b")
        .agg(F.sum("n").alias("n"))
    )


def train_markov(docs: DataFrame, sample_docs: int = 20_000, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of every character pair.

    The strings that the base patterns catch, in all documents, are the random
    class; with none of them every next character is equally likely there.  The
    ordinary class is every run of alphabet characters (words, rules, paths,
    links) in the documents without a catch among about ``sample_docs`` chosen by
    a hash of id and text.  Transitions are counted in Spark; at most two counts
    for each pair of the alphabet reach the driver.  Returns a square table, row
    by row; all zero if both classes are empty.
    """
    total = docs.count()
    share = min(1.0, sample_docs / max(total, 1))
    picked = F.pmod(F.xxhash64("doc_id", "text", F.lit("markov")), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    text = F.col("text")
    caught = F.concat(
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
        F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)), lambda m: F.regexp_extract(m, ASSIGN_VALUE, 1)),
    )
    random = docs.select(F.lit(1).alias("label"), F.explode(caught).alias("s")).where(F.length("s") >= 8)
    plain = docs.where(picked).select("text", caught.alias("caught")).where(F.size("caught") == 0)
    ordinary = plain.select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all(text, F.lit(_RUN % _LEAST_RUN), F.lit(0))).alias("s"))
    counts = _pairs(random.unionAll(ordinary))
    k = len(ALPHABET)
    seen = {(r["label"], r["a"] - 1, r["b"] - 1): r["n"] for r in counts.collect()}
    rows = {(label, a): sum(seen.get((label, a, b), 0) for b in range(k)) for label in (0, 1) for a in range(k)}

    def p(label: int, a: int, b: int) -> float:
        return (seen.get((label, a, b), 0) + smoothing) / (rows[label, a] + smoothing * k)

    return [log(p(1, a, b) / p(0, a, b)) for a in range(k) for b in range(k)]


def looks_random(s: Column, table: list[float], min_ratio: float, min_mean: float) -> Column:
    """Whether the table's log ratios of the distinct transitions of ``s`` (a rule has
    one) sum up to ``min_ratio`` and are ``min_mean`` on average."""
    k = len(ALPHABET)
    ratios = F.from_json(F.lit(json.dumps([round(x, 6) for x in table])), "array<double>")
    codes = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def transitions(c):
        place = lambda i: F.when((F.get(c, i - 1) > 0) & (F.get(c, i) > 0), (F.get(c, i - 1) - 1) * k + F.get(c, i))
        return F.array_distinct(F.array_compact(F.transform(F.sequence(F.lit(1), F.size(c) - 1), place)))

    places = F.when(F.length(s) > 1, let(codes, transitions)).otherwise(F.array().cast("array<int>"))
    begin = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"))
    total = F.aggregate(
        places, begin, lambda acc, p: F.struct((acc["sum"] + F.element_at(ratios, p)).alias("sum"), (acc["n"] + 1).alias("n"))
    )
    decide = lambda t: (t["sum"] >= min_ratio) & (t["sum"] >= t["n"] * F.lit(min_mean))
    return F.exists(F.array(total), decide)


def scan_secrets(
    docs: DataFrame,
    table: list[float] | None = None,
    min_run: int = 20,
    min_ratio: float = 12.0,
    min_mean: float = 0.75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, text, base, added)``: the spans of every row, each an array of
    ``(start, end, rank, hit)`` by start and kind.

    ``base`` holds the fixed patterns' spans (whole matches).  ``added`` holds
    runs of at least ``min_run`` alphabet characters whose log-likelihood ratio,
    every distinct transition counted once, is at least ``min_ratio`` in all and
    ``min_mean`` for each transition, and which touch no base span.  ``table`` is
    :func:`train_markov`'s; it is trained on ``docs`` if not given.  Native
    expressions, no shuffle.  Null text: empty, so no spans.  Null or repeated
    ids and repeated rows are kept.  Empty table: no rows.
    """
    rows = texts_of(docs, id_col, text_col)
    table = train_markov(rows) if table is None else table
    return with_spans(rows, table, min_run, min_ratio, min_mean)


def with_spans(
    rows: DataFrame, table: list[float], min_run: int = 20, min_ratio: float = 12.0, min_mean: float = 0.75
) -> DataFrame:
    """``rows`` (column ``text``, never null) with the arrays ``base`` and ``added``."""
    text = F.col("text")
    base = F.array_sort(
        F.concat(
            spans_of(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN_VALUE, 1)) >= 8),
            spans_of(text, ACCESS, 1),
            spans_of(text, HEX, 2),
        ),
        _by_start,
    )
    runs = spans_of(text, _RUN % min_run, 3, lambda m: looks_random(m, table, min_ratio, min_mean))
    clear = F.when(F.size("added") == 0, F.col("added")).otherwise(let(_reaches(F.col("base")), lambda base: _clear_of(F.col("added"), base)))
    return rows.withColumns({"base": base, "added": runs}).withColumn("added", clear)


def _reaches(spans: Column) -> Column:
    """Blocks of the spans with their first start and last end."""
    first = lambda b: F.array_min(F.transform(b, lambda s: s["start"]))
    last = lambda b: F.array_max(F.transform(b, lambda s: s["end"]))
    return F.transform(blocks_of(spans), lambda b: F.struct(first(b).alias("start"), last(b).alias("end"), b.alias("spans")))


def _clear_of(runs: Column, reaches: Column) -> Column:
    """The runs that touch no span; only blocks whose reach meets a run are looked into."""
    meets = lambda r, s: (s["start"] < r["end"]) & (r["start"] < s["end"])
    touched = lambda r: F.exists(reaches, lambda b: meets(r, b) & F.exists(b["spans"], lambda s: meets(r, s)))
    return F.filter(runs, lambda r: ~touched(r))


def redact_secrets(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced and ``n_chars`` (if there)
    counted anew; the other columns are as before.  A null text stays null."""
    table = train_markov(texts_of(docs)) if table is None else table
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    spans = F.array_sort(F.concat("base", "added"), _by_start)
    clean = with_spans(rows, table).select(
        "row", F.when(F.size(spans) == 0, F.col("row.text")).otherwise(redact(F.col("text"), spans)).alias("clean")
    )
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return clean.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _by_start(x: Column, y: Column) -> Column:
    a, b = x["start"] * 4 + x["rank"], y["start"] * 4 + y["rank"]
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, digest and text of the spans of :func:`scan_secrets`' rows."""
    n = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return scanned.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", "added"), _by_start)).alias("spans"),
        F.size("added").cast("long").alias("n_random"),
    )


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span replaced by ``mark``; overlapping spans are one."""

    def chunk(acc, block):
        stop = F.array_max(F.transform(block, lambda s: s["end"]))
        return F.substr(text, acc["at"] + 1, F.greatest(stop - acc["at"], F.lit(0)))

    def step(a, s, acc, part):
        before = F.substr(part, a["at"] - acc["at"] + 1, s["start"] - a["at"])
        piece = F.array(F.concat(before, F.lit(mark)))
        found = F.when(s["start"] >= a["at"], F.concat(a["found"], piece)).otherwise(a["found"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), found.alias("found"))

    def whole(r):
        return F.concat(F.array_join(F.flatten(r["found"]), ""), F.substr(text, r["at"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(let(_running(spans, step, "array<string>", chunk), whole))

"""I-Match document fingerprints, in DataFrame expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corral.llm.common import let, staged, texts_of

#: Randomised lexicon subsets: ``REPEATS`` of each scale; a subset of scale j
#: keeps a lexicon term with probability 2 ** -j, decided by the term's hash.  A term
#: is in one subset of a scale at most, and always in one of the first scale.
SCALES, REPEATS = range(3, 11), 8
SUBSETS = len(SCALES) * REPEATS
#: Up to so many terms the lexicon is sent to every executor (some 100 MB); a larger
#: one is joined as Spark plans it.
BROADCAST_TERMS = 2_000_000


def terms_of(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1))


def lexicon_of(docs: DataFrame, min_idf: float = 2.3, max_idf: float = 6.9) -> DataFrame:
    """Terms ``lex`` whose inverse document frequency ``ln(N / df)`` lies in the band.

    Documents with the same terms in the same order of first use (copies) count
    once, in ``df`` and in ``N``, so that a group of copies does not push its
    terms out of the band.  A term needs df >= N * exp(-max_idf), so the lexicon
    holds at most (mean distinct terms per document) * exp(max_idf) terms however
    large the table is.  Terms of one document only are never in the band.
    """
    # every document has the empty term once: its count is N
    distinct = docs.select(F.array_union(terms_of(F.col("text")), F.array(F.lit(""))).alias("terms")).distinct()
    counts = distinct.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = staged(counts.where("count > 1 or term = ''"), "imatch_terms")
    n = sum(r["count"] for r in df.where("term = ''").collect())
    least, most = max(2, math.ceil(n * math.exp(-max_idf))), max(2, math.floor(n * math.exp(-min_idf)))
    return df.where((F.col("term") != "") & F.col("count").between(least, most)).select(F.col("term").alias("lex"))


def subsets_of(term: Column) -> Column:
    """Numbers of the subsets that keep a term: about two of them.  One hash has a
    field of j bits for each scale j; below ``REPEATS`` it names the subset."""
    bits, found, at = F.xxhash64(term, F.lit(1)), [], 0
    for i, scale in enumerate(SCALES):
        field = F.shiftrightunsigned(bits, at).bitwiseAND(F.lit((1 << scale) - 1))
        found.append(F.when(field < REPEATS, (field + i * REPEATS).cast("int")))
        at += scale
    return F.array_compact(F.array(*found))


def _bucket(splits: list[int]) -> Column:
    """Number of the id range that ``doc_id`` falls in (null ids: the first); found
    in two steps, so a row costs about the square root of the range count."""
    if not splits:
        return F.lit(0)
    step = max(1, math.isqrt(len(splits)))
    groups = [splits[i : i + step] for i in range(0, len(splits), step)]
    heads = F.lit([g[0] for g in groups])
    fine = F.array(*[F.lit(g) for g in groups])
    below = lambda xs: F.size(F.filter(xs, lambda s: s <= F.col("doc_id")))
    group = below(heads)
    inside = F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + below(F.get(fine, group - 1)))
    return F.coalesce(inside, F.lit(0)).cast("int")


def likeness(a: Column, b: Column) -> Column:
    """Weighted share of equal hashes among the subsets that either text has terms
    in; 1 if neither has any.  A subset with many terms hardly ever agrees after
    an edit, so its weight falls by four with each term over one."""
    count = lambda e: F.coalesce(e["n"], F.lit(0))
    weight = lambda x, y: F.pow(F.lit(0.25), F.least(F.greatest(count(x), count(y)), F.lit(40)) - 1)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, w: acc + w)
    used = total(F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), weight(x, y)).otherwise(0.0)))
    same = total(F.zip_with(a, b, lambda x, y: F.when(x["x"] == y["x"], weight(x, y)).otherwise(0.0)))
    return F.when(used == 0, F.lit(1.0)).otherwise(same / used)


def fingerprint_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda e: F.when(e.isNull(), F.lit("-")).otherwise(F.lower(F.hex(e["x"])))), ".")


def _print(entries: Column, x: str, n: str) -> Column:
    """The hash ``x`` and count ``n`` of every subset, null where it has no term."""
    some = F.filter(entries, lambda e: e[n] > 0)
    by_subset = F.map_from_entries(F.transform(some, lambda e: F.struct(e["subset"], F.struct(e[x].alias("x"), e[n].alias("n")))))
    return let(by_subset, lambda m: F.transform(F.lit(list(range(SUBSETS))), lambda k: F.element_at(m, k)))


def _prints(entries: Column) -> Column:
    """The subsets of the lexicon terms (null if there is none) and of all terms."""

    def both(own: Column) -> Column:
        has_lexicon = F.exists(own, lambda e: e["n_lexicon"] > 0)
        return F.struct(
            F.when(has_lexicon, _print(own, "x_lexicon", "n_lexicon")).alias("lexicon"),
            _print(own, "x_all", "n_all").alias("all"),
        )

    return let(entries, both)


def _own(fp: Column) -> Column:
    return F.coalesce(fp["lexicon"], fp["all"])


def _compared(a: Column, b: Column) -> Column:
    """Likeness on lexicon terms if both texts have them, otherwise on all terms."""
    alike = a["lexicon"].isNotNull() & b["lexicon"].isNotNull()
    pick = lambda x: F.when(alike, x["lexicon"]).otherwise(x["all"])
    return likeness(pick(a), pick(b))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_idf: float = 2.3, max_idf: float = 6.9) -> DataFrame:
    """Fingerprint every text and its edited text, and their likeness.

    The edited text replaces the last floor(n/2) code points by the first as
    many (or all) of the next document in ascending id order; after the last
    comes the first.  Rows with equal ids are ordered by text; null ids come
    first; null text is empty.  A text that no
    lexicon term is in is fingerprinted by the same subsets of all its
    terms, and is compared on these with any text (so with
    one that has lexicon terms, too); a text without terms has the empty
    fingerprint.  Empty table: no rows.

    The hash of a subset's terms is the exclusive or of their 64-bit hashes: what
    hashing the sorted distinct terms is for (equal sets, equal values), in
    whatever order the terms come, beside their number.

    Texts are shuffled once, by ranges of the id; the last row of a range takes
    its next text from a small table with the first row of every range.  Terms
    are exploded, joined with the lexicon, dealt to their few subsets
    and aggregated where they are, without a second shuffle.
    """
    spark = docs.sparkSession
    rows = texts_of(docs, id_col, text_col)
    lexicon = lexicon_of(rows, min_idf, max_idf)
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("doc_id").where("doc_id is not null")
    cuts = ids.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    rows = rows.withColumn("bucket", _bucket(sorted({int(x) for x in cuts})))

    lowest = rows.groupBy("bucket").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("lowest"))
    order = Window.orderBy("bucket")  # over one small row per range
    after = lowest.select(
        "bucket",
        F.coalesce(
            F.lead("bucket").over(order),
            F.first("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("next_bucket"),
    )
    firsts = (
        rows.join(
            F.broadcast(lowest.select(F.col("bucket").alias("b_"), "lowest")),
            (F.col("bucket") == F.col("b_")) & (F.coalesce("doc_id", F.lit(-(2**63))) == F.col("lowest")),
        )
        .groupBy("bucket")
        .agg(F.min("text").alias("edge_text"))
    )
    edges = after.join(firsts.withColumnRenamed("bucket", "next_bucket"), "next_bucket").select("bucket", "edge_text")

    place = Window.partitionBy("bucket").orderBy("doc_id", "text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next", F.lit(1), half))
    placed = (
        rows.withColumn("rn", F.row_number().over(place))
        .withColumn("inner_next", F.lead("text").over(place))
        .join(edges, "bucket", "left")
        .withColumn("next", F.coalesce("inner_next", "edge_text"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", edited)
    )
    version = lambda i, c: F.struct(F.lit(i).alias("version"), F.col(c).alias("t"))
    versions = F.array(version(0, "text"), version(1, "edited"))
    # the last row of a range also fingerprints its next text: the next row is elsewhere
    versions = F.when(F.col("inner_next").isNull(), F.concat(versions, F.array(version(2, "next")))).otherwise(versions)
    keys = ["bucket", "rn", "doc_id", "n_chars", "edited_sha256"]
    # the empty term stands for the text itself, so that a text without terms is not lost
    marked = F.col("version") != 1
    terms = (
        placed.select("bucket", "rn", "doc_id", "n_chars", F.unhex(F.sha2("edited", 256)).alias("edited_sha256"), F.explode(versions).alias("v"))
        .select(*keys, "v.version", F.explode(F.array_union(terms_of(F.col("v.t")), F.array(F.lit("")))).alias("term"))
        .where(marked | (F.col("term") != ""))
    )
    small = lexicon.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    in_lexicon = F.col("lex").isNotNull()
    subsets = F.when(F.col("term") == "", F.array(F.lit(-1))).otherwise(subsets_of(F.col("term")))
    per_subset = (
        terms.join(F.broadcast(lexicon) if small else lexicon, F.col("term") == F.col("lex"), "left")
        .select(*keys, "version", in_lexicon.alias("inside"), F.xxhash64("term").alias("h"), F.explode(subsets).alias("subset"))
        .groupBy(*keys, "version", "subset")
        .agg(
            F.bit_xor(F.when(F.col("inside"), F.col("h")).otherwise(F.lit(0).cast("long"))).alias("x_lexicon"),
            F.sum(F.col("inside").cast("int")).alias("n_lexicon"),
            F.bit_xor("h").alias("x_all"),
            F.count(F.lit(1)).alias("n_all"),
        )
    )
    entry = F.struct("version", "subset", "x_lexicon", "n_lexicon", "x_all", "n_all")
    of_version = lambda i: F.filter("entries", lambda e: e["version"] == i)
    per_row = (
        per_subset.groupBy(*keys)
        .agg(F.collect_list(entry).alias("entries"))
        .select(*keys, *[_prints(of_version(i)).alias(f"fp{i}") for i in range(3)])
    )
    following = F.coalesce(F.lead("fp0").over(Window.partitionBy("bucket").orderBy("rn")), F.col("fp2"))
    return per_row.withColumn("following", following).select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        fingerprint_text(_own(F.col("fp0"))).alias("fingerprint"),
        fingerprint_text(_own(F.col("fp1"))).alias("edited_fingerprint"),
        _compared(F.col("fp0"), F.col("fp1")).alias("near_edited"),
        _compared(F.col("fp0"), F.col("following")).alias("near_next"),
    )

r"""Merkle trees over the sections and paragraphs of a text.

A section is a block of text with the line feed that ends it, and a paragraph a unit of a
section up to its closing ``.``, ``!`` or ``?``; both keep every character, so trees are equal
just where texts are. A paragraph's digest is the leaf, a section's digest is over its
leaves, the root over the sections. Equal roots mean equal texts; where roots differ, only
differing sections are entered to find the paragraphs that changed.

All of it is built from SQL functions.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import table

SECTION = r"[^\n]+\n?|\n"
PARAGRAPH = r"[^.!?\n]+[.!?\n]*|[.!?\n]+"
DIGITS = 32  # of a paragraph's and a section's digest; the root has all 64
BUCKETS = 4  # ranges of ids per shuffle partition

# ---- Trees


def _digest(level: str, text: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.lit(level), text), 256), 1, DIGITS)


def tree(text: Column) -> Column:
    """The sections of a text as ``array<struct<hash, leaves>>``; NULL is empty."""
    sections = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SECTION), F.lit(0))
    leaves = F.transform(
        sections,
        lambda s: F.transform(
            F.regexp_extract_all(s, F.lit(PARAGRAPH), F.lit(0)), lambda p: _digest("p", p)
        ),
    )
    return F.transform(
        leaves, lambda x: F.struct(_digest("s", F.array_join(x, "")).alias("hash"), x.alias("leaves"))
    )


def root(of: Column) -> Column:
    """The root digest of a tree, 64 hex digits."""
    return F.sha2(F.array_join(F.transform(of, lambda s: s["hash"]), ""), 256)


def leaves(of: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(of, lambda s: s["leaves"])))


def likeness(same: Column, a: Column, b: Column) -> Column:
    """Twice the shared leaves over all leaves of two trees; 1 just where the texts are the same."""
    both = F.size(a) + F.size(b)
    shared = 2 * F.size(F.array_intersect(a, b))
    return F.when(same, 1.0).otherwise(F.least(shared, both - 1) / F.greatest(both, F.lit(1)))


def edits(before: Column, after: Column) -> Column:
    """``array<struct<section, paragraph>>``: places, from 0, where two trees differ.

    Only sections with different digests are entered. A place that one side lacks counts.
    """

    def within(x: Column, y: Column, section: Column) -> Column:
        longest = F.greatest(F.size(x), F.size(y))
        places = F.filter(
            F.sequence(F.lit(0), longest - 1), lambda i: ~F.get(x, i).eqNullSafe(F.get(y, i))
        )
        return F.transform(places, lambda i: F.struct(section.alias("section"), i.alias("paragraph")))

    none = F.array().cast("array<string>")
    longest = F.greatest(F.size(before), F.size(after))
    sections = F.filter(
        F.sequence(F.lit(0), F.greatest(longest - 1, F.lit(0))),
        lambda i: ~F.get(before, i)["hash"].eqNullSafe(F.get(after, i)["hash"]),
    )
    return F.flatten(
        F.transform(
            sections,
            lambda i: within(
                F.coalesce(F.get(before, i)["leaves"], none),
                F.coalesce(F.get(after, i)["leaves"], none),
                i,
            ),
        )
    )


# ---- Neighbours in the order of ids


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text``: each text with that of the next lower ``doc_id``.

    After the last document comes the first. NULL texts are empty, a NULL ``doc_id`` comes
    last, equal ids follow each other by text. Ids are cut into ranges of about equally many
    documents; a window runs within a range, and the ends of ranges meet by a join on the
    range. Texts are shuffled once.
    """
    spark = docs.sparkSession
    n = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), _range_of(F.col("doc_id"), cuts).alias("range")
    )
    order = Window.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    inside = rows.withColumn("next_text", F.lead("text").over(order))
    heads = (
        rows.withColumn("nth", F.row_number().over(order)).filter("nth = 1").select("range", "text")
    )
    down = Window.orderBy(F.col("range").desc())  # over one row per range
    following = rows.select("range").distinct().select(
        "range",
        F.coalesce(F.lead("range").over(down), F.first("range").over(down)).alias("lower"),
    )
    first = following.join(
        heads.select(F.col("range").alias("lower"), F.col("text").alias("head")), "lower"
    ).select("range", "head")
    return inside.join(first, "range").select(
        "doc_id", "text", F.coalesce("next_text", "head").alias("next_text")
    )


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts lie below, found in two steps; -1 for NULL."""
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    tops = F.from_json(F.lit(json.dumps([g[-1] for g in groups])), "array<bigint>")
    fine = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    coarse = F.size(F.filter(tops, lambda c: c < value))
    inner = F.size(F.filter(F.coalesce(F.get(fine, coarse), F.array().cast("array<bigint>")), lambda c: c < value))
    return F.when(value.isNull(), -1).otherwise(coarse * step + inner).cast("int")


# ---- Query


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The edited text has the last half of the code points replaced by as many of the next
    document. The result has a row for each row of ``docs``.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    return (
        with_next(docs)
        .withColumn("edited", edited)
        .select(
            "doc_id",
            F.length("text").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            (F.col("text") == F.col("edited")).alias("unedited"),
            (F.col("text") == F.col("next_text")).alias("repeated"),
            tree(F.col("text")).alias("own"),
            tree(F.col("edited")).alias("other"),
            leaves(tree(F.col("next_text"))).alias("following"),
        )
        .select(
            "doc_id", "n_chars", "edited_sha256", "unedited", "repeated", "following",
            root(F.col("own")).alias("fingerprint"),
            root(F.col("other")).alias("edited_fingerprint"),
            leaves(F.col("own")).alias("own"),
            leaves(F.col("other")).alias("other"),
        )
        .select(
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
            likeness(F.col("unedited"), F.col("own"), F.col("other")).alias("near_edited"),
            likeness(F.col("repeated"), F.col("own"), F.col("following")).alias("near_next"),
        )
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprinted(table(spark, sf_dir, "documents"))


_TREE = f"""
list_transform(list_transform(regexp_extract_all({{0}}, '{SECTION}'),
    lambda s: list_transform(regexp_extract_all(s, '{PARAGRAPH}'),
        lambda p: left(sha256('p' || p), {DIGITS}))),
  lambda x: {{{{'hash': left(sha256('s' || array_to_string(x, '')), {DIGITS}), 'leaves': x}}}})
"""
_ROOT = "sha256(array_to_string(list_transform({0}, lambda s: s.hash), ''))"
_LEAVES = "list_distinct(flatten(list_transform({0}, lambda s: s.leaves)))"
_LIKE = """
CASE WHEN {2} THEN 1.0::DOUBLE ELSE
  least(2 * len(list_intersect({0}, {1})), len({0}) + len({1}) - 1)::DOUBLE
  / greatest(len({0}) + len({1}), 1)::DOUBLE END
"""
OP4_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
pairs AS (
  SELECT doc_id, t, length(t) AS n,
         coalesce(lead(t) OVER o, first_value(t) OVER o) AS u
  FROM texts WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, t)),
edited AS (SELECT *, left(t, n - n // 2) || left(u, n // 2) AS e FROM pairs),
trees AS (
  SELECT *, {_TREE.format("t")} AS a, {_TREE.format("e")} AS b, {_TREE.format("u")} AS c
  FROM edited),
digests AS (
  SELECT *, {_LEAVES.format("a")} AS x, {_LEAVES.format("b")} AS y, {_LEAVES.format("c")} AS z
  FROM trees)
SELECT doc_id, n::BIGINT AS n_chars, sha256(e) AS edited_sha256,
       {_ROOT.format("a")} AS fingerprint, {_ROOT.format("b")} AS edited_fingerprint,
       {_LIKE.format("x", "y", "t = e")} AS near_edited,
       {_LIKE.format("x", "z", "t = u")} AS near_next
FROM digests
"""

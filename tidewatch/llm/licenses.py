r"""Find licenses by TF-IDF cosine to notice templates, and pass them down directories.

The vectors are sparse: a line's terms against each template's terms, weighted by how few
templates hold a term; unknown terms weigh most. A line whose cosine to a template reaches
the threshold is a header. A document whose words lie mostly in such lines is a license
file and speaks for its directory; other documents take the license of the nearest
ancestor directory that has one, by a join on the path. All of it is SQL functions, and
only license facts, never texts, are shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import table
from tidewatch.plans import stage

# Short notices of well-known licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Mozilla Public License, version 2.0.",
    "Proprietary": "All rights reserved.",
}
LEAST = 0.8  # cosine of a header
# Words of notices that ordinary prose holds too.
EVERYDAY = frozenset(
    "0 1 2 3 4 a all by code file general in is law mit of public source style subject terms "
    "the this to under use version work possible extent".split()
)
TERM = r"[^a-z0-9]+"  # between terms, in lower case

# ---- Templates


def terms(text: str) -> Counter:
    return Counter(t for t in re.split(TERM, text.lower()) if t)


class Weights:
    """Weights of terms, and the unit vectors of the templates."""

    def __init__(self, templates: dict[str, str]):
        counted = {name: terms(text) for name, text in templates.items()}
        held = Counter(t for c in counted.values() for t in c)
        n = len(templates)
        self.idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in sorted(held.items())}
        self.unknown = math.log(1 + n) + 1
        self.vectors = {}
        for name, counts in sorted(counted.items()):
            weights = {t: k * self.idf[t] for t, k in sorted(counts.items())}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            self.vectors[name] = {t: w / norm for t, w in weights.items()}

    def needed(self, least: float) -> list[str]:
        """Terms of which a text with such a cosine to any template holds at least one.

        Terms of a template that together fall short of the cosine are left out, everyday words
        first, then the lightest.
        """
        out = set()
        for vector in self.vectors.values():
            short = 0.0
            for term, w in sorted(vector.items(), key=lambda x: (x[0] not in EVERYDAY, x[1], x[0])):
                short += w * w
                if short >= least * least:
                    out.add(term)
        return sorted(out)


# ---- Lines


def _any_of(found: list[str]) -> str:
    """A pattern for whole terms in lower case."""
    return r"(?<![a-z0-9])(?:" + "|".join(map(re.escape, found)) + r")(?![a-z0-9])"


def _may_match(line: Column, weights: Weights, least: float) -> Column:
    """False only where no cosine can reach ``least``: too few known words among unknown ones.

    With ``k`` known words the known part of the vector is at most ``k`` heaviest weights long,
    and every distinct unknown word, of which there are at least the distinct words less ``k``,
    adds one such weight to the rest.
    """
    folded = F.lower(line)
    known = F.regexp_count(folded, F.lit(_any_of(list(weights.idf)))).cast("double")
    distinct = F.size(F.array_distinct(F.split(folded, TERM))) - 2  # but for the empty ends
    enough = known * known * (1 - least * least) >= (distinct - known) * (least * least)
    return F.when(folded.rlike(_any_of(weights.needed(least))), enough).otherwise(False)


def candidate_lines(text: Column, weights: Weights, least: float) -> Column:
    """``array<struct<text, line>>`` of the lines that may be headers; ``line`` counts from 0."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("text"), i.alias("line")))
    hits = F.filter(lines, lambda x: _may_match(x["text"], weights, least))
    return F.when(F.lower(text).rlike(_any_of(weights.needed(least))), hits)


def best_templates(lines: DataFrame, weights: Weights, least: float) -> DataFrame:
    """``digest, score, license, words`` for each distinct line whose cosine reaches ``least``.

    Lines ``digest, text`` are known by their digest, so terms do not carry a copy of their line. Of
    equal scores the greater name. The weights are a table with a row per template and term.
    """
    spark = lines.sparkSession
    idf = spark.createDataFrame(list(weights.idf.items()), "term string, idf double")
    vectors = spark.createDataFrame(
        [(t, name, w) for name, v in weights.vectors.items() for t, w in v.items()],
        "term string, license string, weight double",
    )
    counted = (
        lines.groupBy("digest").agg(F.first("text").alias("text"))
        .select("digest", F.explode(F.split(F.lower("text"), TERM)).alias("term"))
        .filter("term <> ''")
        .groupBy("digest", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
        .join(F.broadcast(idf), "term", "left")
        .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(weights.unknown)))
    )
    norms = counted.groupBy("digest").agg(F.sum(F.col("w") * F.col("w")).alias("square"), F.sum("tf").alias("words"))
    dots = (
        counted.join(F.broadcast(vectors), "term")
        .groupBy("digest", "license")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    )
    score = F.round(F.col("dot") / F.sqrt("square"), 9)
    best = dots.join(norms, "digest").groupBy("digest", "words").agg(F.max(F.struct(score.alias("score"), "license")).alias("b"))
    return best.select("digest", "words", "b.*").filter(F.col("score") >= least)


# ---- Directories


def licensed(docs: DataFrame, path: Column, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``doc_id, path, own_license, own_score, inherited_license, inherited_from, license``.

    A document's own license is that of its best header; NULL and empty texts have none.
    ``path`` has its parts between slashes; a NULL path is the root's. License files of one
    directory: the best score, then the greater name, speaks for it. A document inherits
    only where it has no license of its own. Rows are kept one for one; rows that agree in
    ``doc_id`` and path are taken for one document.
    """
    directory = F.regexp_replace(F.coalesce(path, F.lit("")), "/?[^/]*$", "")
    weights = Weights(templates)
    seen = stage(
        docs.select(
            "doc_id",
            path.alias("path"),
            directory.alias("directory"),
            candidate_lines(F.col("text"), weights, least).alias("lines"),
            F.coalesce(F.regexp_count(F.lower("text"), F.lit("[a-z0-9]+")), F.lit(0)).alias("all_words"),
        ),
        "seen",
    )
    lines = seen.select("doc_id", "path", F.explode("lines").alias("l")).select(
        "doc_id", "path", "l.text", F.sha2("l.text", 256).alias("digest")
    )
    best = stage(best_templates(lines, weights, least), "best")
    own = (
        lines.select("doc_id", "path", "digest").join(best, "digest")
        .groupBy("doc_id", "path")
        .agg(F.max(F.struct("score", "license")).alias("best"), F.sum("words").alias("header_words"))
    )
    files = (
        seen.filter("lines IS NOT NULL").groupBy("doc_id", "path", "directory").agg(F.sum("all_words").alias("all_words"))
    )
    holders = stage(
        files.alias("f")
        .join(own.alias("o"), _same("f", "o"))
        .select("f.doc_id", "f.path", "directory", "best", (2 * F.col("header_words") >= F.col("all_words")).alias("file")),
        "holders",
    )
    marked = (
        seen.alias("s").join(holders.alias("h"), _same("s", "h"), "left").select("s.doc_id", "s.path", "s.directory", "h.best")
    )
    speaks = (
        holders.filter("file")
        .groupBy(F.col("directory").alias("ancestor"))
        .agg(F.max(F.struct("best.score", "best.license")).alias("said"))
    )
    parts = F.split("directory", "/")
    steps = F.when(F.col("directory") == "", F.array(F.lit(0))).otherwise(
        F.sequence(F.size(parts), F.lit(0), F.lit(-1))
    )
    ancestors = (
        seen.select("directory").distinct()
        .withColumn("depth", F.explode(steps))
        .withColumn("ancestor", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    )
    nearest = (
        ancestors.join(speaks, "ancestor")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "ancestor", "said.license")).alias("near"))
    )
    inherits = F.col("best").isNull()
    return marked.join(stage(nearest, "nearest"), "directory", "left").select(
        "doc_id",
        "path",
        F.col("best.license").alias("own_license"),
        F.col("best.score").alias("own_score"),
        F.when(inherits, F.col("near.license")).alias("inherited_license"),
        F.when(inherits, F.col("near.ancestor")).alias("inherited_from"),
        F.coalesce("best.license", "near.license").alias("license"),
    )


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.path").eqNullSafe(F.col(f"{b}.path"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of every document; its source and language are its directories."""
    docs = table(spark, sf_dir, "documents")
    return licensed(docs, F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))


def _op2_sql() -> str:
    weights = Weights(TEMPLATES)
    idf = ", ".join(f"('{t}', {w!r}::DOUBLE)" for t, w in weights.idf.items())
    vectors = ", ".join(
        f"('{t}', '{name}', {w!r}::DOUBLE)" for name, v in weights.vectors.items() for t, w in v.items()
    )
    return f"""
WITH idf(term, idf) AS (VALUES {idf}),
vectors(term, license, weight) AS (VALUES {vectors}),
d AS (
  SELECT *, regexp_replace(path, '/?[^/]*$', '') AS directory
  FROM (SELECT doc_id, concat_ws('/', source, lang, doc_id::VARCHAR) AS path, text FROM documents)),
lines AS (SELECT doc_id, path, directory, unnest(string_split(text, chr(10))) AS line FROM d),
terms AS (
  SELECT line, term, count(*) AS tf
  FROM (SELECT line, unnest(regexp_split_to_array(lower(line), '{TERM}')) AS term FROM (SELECT DISTINCT line FROM lines))
  WHERE term <> '' GROUP BY line, term),
weighted AS (
  SELECT line, term, tf, tf * coalesce(idf, {weights.unknown!r}::DOUBLE) AS w FROM terms LEFT JOIN idf USING (term)),
norms AS (SELECT line, sum(w * w) AS square, sum(tf) AS words FROM weighted GROUP BY line),
dots AS (SELECT line, license, sum(w * weight) AS dot FROM weighted JOIN vectors USING (term) GROUP BY line, license),
best AS (
  SELECT line, words, max({{'score': round(dot / sqrt(square), 9), 'license': license}}) AS b
  FROM dots JOIN norms USING (line) GROUP BY line, words
  HAVING max(round(dot / sqrt(square), 9)) >= {LEAST}),
own AS (
  SELECT doc_id, path, directory, max(b) AS best, sum(words) AS header_words
  FROM lines JOIN best USING (line) GROUP BY doc_id, path, directory),
files AS (
  SELECT own.* FROM own JOIN d USING (doc_id)
  WHERE 2 * header_words >= len(regexp_extract_all(lower(text), '[a-z0-9]+'))),
speaks AS (SELECT directory AS ancestor, max(best) AS said FROM files GROUP BY directory),
nearest AS (
  SELECT directory, arg_max(ancestor, length(ancestor)) AS ancestor, arg_max(said.license, length(ancestor)) AS license
  FROM (SELECT DISTINCT directory FROM d) JOIN speaks
    ON directory = ancestor OR starts_with(directory, ancestor || '/') OR ancestor = ''
  GROUP BY directory)
SELECT d.doc_id, d.path, best.license AS own_license, best.score AS own_score,
       CASE WHEN best IS NULL THEN nearest.license END AS inherited_license,
       CASE WHEN best IS NULL THEN nearest.ancestor END AS inherited_from,
       coalesce(best.license, nearest.license) AS license
FROM d LEFT JOIN own USING (doc_id, path) LEFT JOIN nearest ON d.directory = nearest.directory
"""


OP2_SQL = _op2_sql()

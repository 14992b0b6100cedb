"""Pack token pieces into sequences of a fixed length by exact complements, then best fit.

Only lengths matter for a packing, so the plan is made from the number of pieces of each
length, a table of at most ``capacity`` rows whatever the corpus. The plan is a list of
patterns, each a set of lengths and the number of sequences that look like it. Pieces
get numbers within their length, chunk by chunk, and a number falls into exactly one
place of one pattern. Nothing but the counts reaches the driver.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidewatch.llm.common import dealt, table
from tidewatch.plans import stage

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
LONG_TEXT, LONG_RUN = 20_000, 2_000
CHUNK, MOST_CHUNKS = 256, 4096  # pieces of one length numbered together; chunks a length

# ---- Tokens


class Encoder:
    """Token ids of texts, the same as those of ``Tokenizer.encode``.

    The rank file holds the same vocabulary and is read by a faster library. Texts with
    characters whose class may differ between the two libraries' Unicode versions, all
    beyond Latin Extended-A, go to the tokenizer itself, and so do texts with very long
    unbroken runs, on which the faster library takes quadratic time.
    """

    def __init__(self, tokenizer: str, ranks: str | None):
        self.slow = Tokenizer.from_file(tokenizer)
        self.fast = None
        if ranks:
            import base64

            with open(ranks, "rb") as lines:
                vocabulary = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            with open(tokenizer) as text:
                added = {t["content"]: t["id"] for t in json.load(text)["added_tokens"]}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens=added
            )
            self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.far = re.compile("[^\x00-ſ]")
        self.run = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

    def ids(self, text: str) -> list[int]:
        if self.fast is None or self.far.search(text) or len(text) > LONG_TEXT and self.run.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        if self.added.search(text):
            return self.fast.encode(text, allowed_special="all")
        return self.fast.encode_ordinary(text)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens; only the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    starts = [0] if first else []
    starts += range(first, n, capacity)
    return [(s, (first or capacity) if s == 0 else capacity) for s in starts]


_PIECES = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"


def pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    ranks: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every whole text; NULL is empty.

    ``tokenizer`` and ``ranks`` are file paths that every worker can read; without them the
    installed public files are used.
    """
    own = tokenizer is None

    @F.pandas_udf(_PIECES)
    def split(texts: pd.Series) -> pd.Series:
        encoder = _encoder(
            public_tokenizers.path(TOKENIZER) if own else tokenizer,
            public_tokenizers.path(RANKS) if own else ranks,
        )
        out = []
        for text in texts:
            ids = np.array([*encoder.ids(text or ""), end], dtype="<u4")
            out.append(
                [
                    {"piece": k, "start": s, "length": n, "ids_crc32": zlib.crc32(ids[s : s + n].tobytes())}
                    for k, (s, n) in enumerate(cut(len(ids), capacity))
                ]
            )
        return pd.Series(out)

    return docs.select("doc_id", F.explode(split("text")).alias("p")).select("doc_id", "p.*")


_encoders: dict[tuple, Encoder] = {}


def _encoder(tokenizer: str, ranks: str | None) -> Encoder:
    key = (tokenizer, ranks)
    if key not in _encoders:
        _encoders[key] = Encoder(tokenizer, ranks)
    return _encoders[key]


# ---- Plan


def complement(left: np.ndarray, gap: int, most: int = 3) -> tuple[int, ...] | None:
    """One, two or three available lengths, ``most`` of them, that sum to ``gap``, longest first."""
    if left[gap] > 0:
        return (gap,)
    if most > 1 and (pair := _pair(left, gap, gap)):
        return pair
    if most < 3:
        return None
    sums = _pair_sums(left, gap)
    left = left.copy()
    for a in np.flatnonzero(left[:gap])[::-1]:
        if sums[gap - a]:
            left[a] -= 1
            if pair := _pair(left, gap - a, a):
                return (int(a), *pair)
            left[a] += 1
    return None


def _pair(left: np.ndarray, total: int, most: int) -> tuple[int, int] | None:
    """Two available lengths up to ``most`` that sum to ``total``."""
    a = np.arange(min(total - 1, most), (total - 1) // 2, -1)
    b = total - a
    hit = np.flatnonzero((left[a] > 0) & (left[b] > 0) & ((a != b) | (left[a] > 1)))
    return (int(a[hit[0]]), int(b[hit[0]])) if len(hit) else None


def _pair_sums(left: np.ndarray, most: int) -> np.ndarray:
    """Index of the sums of two available lengths."""
    there = (left[: most + 1] > 0).astype(np.int64)
    there[0] = 0
    return np.convolve(there, there)[: most + 1] > 0


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """The plan with the fewest sequences among those with complements of three, two and one."""
    plans = [filled(counts, capacity, most) for most in (3, 2, 1)]
    return min(plans, key=lambda p: sum(n for _, n in p))


def filled(counts: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, sequences)`` patterns that use every piece once.

    From the longest piece down, one to three lengths that fill the rest of its sequence
    exactly are taken as often as the rarest of them allows. Where nothing adds up, the
    longest piece that fits goes in, the best fit, and the gap that it leaves is looked up
    again. Each pattern uses up a length, so their number is bounded by the lengths.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    patterns: list[tuple[tuple[int, ...], int]] = []
    for length in range(capacity, 0, -1):
        while left[length]:
            content = _filled(left, length, capacity, most)
            need = np.bincount(content, minlength=capacity + 1)
            times = int((left[need > 0] // need[need > 0]).min())
            left -= need * times
            patterns.append((content, times))
    return patterns


def _filled(left: np.ndarray, length: int, capacity: int, most: int) -> tuple[int, ...]:
    """Available lengths for one sequence that begins with ``length``."""
    content, rest, gap = [length], left.copy(), capacity - length
    rest[length] -= 1
    while gap:
        if others := complement(rest, gap, most):
            return (*content, *others)
        fits = np.flatnonzero(rest[: gap + 1] > 0)
        if not len(fits):
            break
        content.append(int(fits[-1]))
        rest[fits[-1]] -= 1
        gap -= int(fits[-1])
    return tuple(content)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Rows ``length, first, sequence, offset``: from number ``first`` on, pieces of a length
    go to consecutive sequences from ``sequence`` at ``offset``."""
    rows, used, sequence = [], defaultdict(int), 0
    for content, n in patterns:
        offset = 0
        for length in content:
            rows.append((length, used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    frame = pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"], dtype="int64")
    return frame.sort_values(["length", "first"], ignore_index=True)


# ---- Packing


def packed(docs: DataFrame, capacity: int = CAPACITY, **tokens) -> DataFrame:
    """Each piece with its ``sequence_id`` and ``offset``; every sequence is gapless from 0.

    Repeated rows are pieces of their own. An empty table gives an empty result.
    """
    cut_up = stage(pieces(docs, capacity=capacity, **tokens), "pieces")
    counts = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    return placed(numbered(cut_up, counts), places(plan(counts, capacity)))


def numbered(cut_up: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``number`` from 0 within each length, by chunks of a bounded share of the rows."""
    spark = cut_up.sparkSession
    chunks = spark.createDataFrame(
        [(length, max(1, min(MOST_CHUNKS, -(-n // CHUNK)))) for length, n in counts.items()],
        "length long, chunks int",
    )  # a row per length
    in_chunk = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "start", "ids_crc32")
    chunked = (
        cut_up.join(F.broadcast(chunks), "length")
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("chunks")))
        .drop("chunks")
    )
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        chunked.groupBy("length", "chunk")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    ranked = chunked.withColumn("rank", F.row_number().over(in_chunk) - 1)
    return ranked.join(dealt(starts), ["length", "chunk"]).withColumn("number", F.col("base") + F.col("rank"))


def placed(pieces_: DataFrame, plan_: pd.DataFrame) -> DataFrame:
    """Look up the place of each numbered piece in the plan, which is bounded by the lengths."""
    length, first, sequence, offset = (plan_[c].to_numpy() for c in plan_.columns)
    out = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    @F.pandas_udf(out)
    def look_up(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        lengths, numbers = lengths.to_numpy(), numbers.to_numpy()
        row = np.empty(len(lengths), np.int64)
        for n in np.unique(lengths):
            at = lengths == n
            low, high = np.searchsorted(length, [n, n + 1])
            row[at] = low + np.searchsorted(first[low:high], numbers[at], side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[row] + numbers - first[row], "offset": offset[row]})

    return pieces_.withColumn("place", look_up("length", "number")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return packed(table(spark, sf_dir, "documents"))

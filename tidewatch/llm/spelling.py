"""Words of a corpus and their spelling variants, one inserted, deleted or replaced letter apart.

Of two such words of lengths ``m`` and ``m`` or ``m + 1``, the first or the last ``m // 2``
letters are the same, so every pair meets in the shard of a length and a half. Within a shard
words are columns of bits: for every position and letter a bitset says which words have that
letter there. A query runs through its letters once, for all words at a time. One set holds the
words that agree so far, three more those with one letter replaced, inserted or deleted so
far; the latter two read the bitsets of the neighbouring positions. Shards share a unit of
work with others as far as they are small, and are cut into blocks that meet pairwise where
they are large. A unit reports one row per word: how many near words it saw, and the best.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import dealt, table
from tidewatch.plans import stage

LEAST_LETTERS, LEAST_COUNT = 5, 3
DAMAGED = 97  # one of so many runs of a document loses a letter
RATIO = 2  # a form is at least so many times as frequent
BLOCK = 2048  # words of a block
BLOCK_LETTERS = 1 << 20  # letters of a block
UNIT = 1024  # words of small shards that share a unit, on average
HELD = 100_000  # words counted before they are passed on
ROUNDS = 64

_RUN = re.compile("[A-Za-zÀ-ÿ]+")

# ---- Vocabulary


def runs(text: str) -> list[str]:
    """Maximal runs of letters, with A-Z in lower case and other capitals as they are."""
    text = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return _RUN.findall(text)


def damaged(doc_id: str, run: str) -> str:
    """The run as counted: some lose a letter, by the checksum of document and run."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words of whole texts; NULL texts have none, a NULL id reads as empty.

    Tasks count before the shuffle and pass counts on when they hold ``HELD`` words.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"], strict=True):
                for run, n in Counter(runs(text)).items():
                    if len(run) >= least_letters and len(word := damaged(doc_id, run)) >= least_letters:
                        held[word] += n
                if len(held) >= HELD:
                    yield pd.DataFrame(held.items(), columns=["word", "n"])
                    held.clear()
        yield pd.DataFrame(held.items(), columns=["word", "n"])

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counts = texts.filter(F.col("text").isNotNull()).mapInPandas(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# ---- Bitsets


class Letters:
    """Words as columns of bits: ``at(p)[c]`` has a bit set for each word with letter ``c`` at ``p``.

    Bitsets are made from the letter codes as the search gets to a position, so three
    positions are held at a time.
    """

    def __init__(self, words: list[str], codes: dict[str, int]):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.width = -(-len(words) // 64)
        self.codes = letter_codes(words, self.lengths, codes)
        self.count = len(codes) + 1  # the last code is no letter
        self._held: dict[int, np.ndarray] = {}

    def bits(self, marks: np.ndarray) -> np.ndarray:
        """Rows of truth values per word as bitsets."""
        packed = np.zeros((len(marks), self.width * 8), np.uint8)
        got = np.packbits(marks, axis=1, bitorder="little")
        packed[:, : got.shape[1]] = got
        return packed.view(np.uint64)

    def at(self, position: int) -> np.ndarray:
        if position not in self._held:
            self._held = {p: b for p, b in self._held.items() if p >= position - 2}
            marks = np.zeros((self.count, len(self.lengths)), bool)
            if 0 <= position < self.codes.shape[1]:
                column = self.codes[:, position]
                there = np.flatnonzero(column < self.count - 1)
                marks[column[there], there] = True
            self._held[position] = self.bits(marks)
        return self._held[position]

    def of_length(self, least: int) -> np.ndarray:
        """Words that have a letter at position ``least - 1``."""
        return self.bits((self.lengths >= least)[None, :])[0]


def letter_codes(words: list[str], lengths: np.ndarray, codes: dict[str, int]) -> np.ndarray:
    """A row of letter codes per word, filled up with a code that is no letter."""
    out = np.full((len(words), int(lengths.max(initial=0))), len(codes), np.int32)
    letters = np.fromiter((codes[c] for w in words for c in w), np.int32, int(lengths.sum()))
    out[np.arange(out.shape[1]) < lengths[:, None]] = letters
    return out


def near(index: Letters, asked: np.ndarray, start: np.ndarray, drop_after: int | None = None) -> np.ndarray:
    """Bitsets of the words exactly one letter from each of the queries of one length.

    ``asked`` has a row of letter codes per query, ``start`` the words that it may meet. With
    ``drop_after``, words that agree with the query in so many first letters are left out.
    """
    queries, m = asked.shape
    same = start.copy()  # no error so far
    replaced = np.zeros_like(start)
    inserted = np.zeros_like(start)  # the word has one letter more so far
    deleted = np.zeros_like(start)  # and one letter less
    known = None
    for i in range(m):
        letter = asked[:, i]
        here = index.at(i)[letter]
        inserted = (inserted | (same & index.of_length(i + 1))) & index.at(i + 1)[letter]
        deleted = (deleted & index.at(i - 1)[letter]) | same if i else same.copy()
        replaced = (replaced & here) | (same & ~here & index.of_length(i + 1))
        same &= here
        if drop_after == i + 1:
            known = same.copy()
        if not (same.any() or replaced.any() or inserted.any() or deleted.any()):
            break
    inserted |= same & index.of_length(m + 1)
    size = {n: index.bits((index.lengths == n)[None, :])[0] for n in (m - 1, m, m + 1)}
    found = (replaced & size[m]) | (inserted & size[m + 1]) | (deleted & size[m - 1])
    if drop_after == 0:
        known = start
    return found if known is None else found & ~known


# ---- Shards


def sharded(words: DataFrame) -> DataFrame:
    """Every word in the shards of both halves for its own length and for one letter less."""
    length = F.length("word")
    sizes = F.array(length, length - 1)
    halves = words.select("word", "n", F.explode(sizes).alias("m")).filter("m > 0").withColumn("h", F.expr("m div 2"))
    both = F.array(
        F.struct(F.lit(False).alias("last"), F.expr("left(word, h)").alias("half")),
        F.struct(F.lit(True).alias("last"), F.expr("right(word, h)").alias("half")),
    )
    return halves.select("word", "n", "m", F.explode(both).alias("s")).select("word", "n", "m", "s.*")


def units(words: DataFrame) -> DataFrame:
    """``unit, m, last, half, word, n, role``: units of bounded size in which all shards meet.

    ``role`` has bit 1 for words that are looked up and bit 2 for words that ask. A shard of
    more than ``BLOCK`` words, or ``BLOCK_LETTERS`` letters, is cut into blocks that meet pairwise.
    """
    rows = sharded(words)
    key = ["m", "last", "half"]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.greatest(
        F.ceil(F.col("size") / F.lit(BLOCK)), F.ceil(F.col("size") * (F.col("m") + 1) / F.lit(BLOCK_LETTERS))
    ).cast("int")
    sizes = stage(sizes.withColumn("blocks", blocks), "shards")
    small = sizes.filter("blocks = 1").agg(F.sum("size")).first()[0] or 0
    shared = max(1, -(-small // UNIT))
    met = rows.join(dealt(sizes), key)
    # Long words weigh as much as their length says: those share no unit with others.
    mixed = F.when(F.col("m") < 64, F.pmod(F.xxhash64(*key), F.lit(shared))).otherwise(F.xxhash64(*key))
    one = met.filter("blocks = 1").select(F.concat_ws(":", F.lit("s"), mixed).alias("unit"), *key, "word", "n", F.lit(3).alias("role"))
    many = (
        met.filter("blocks > 1")
        .withColumn("block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    pair = lambda a, b: F.concat_ws(":", F.lit("b"), F.xxhash64(*key), a, b)
    own, other = F.col("block"), F.col("other")
    asks = many.select(pair(own, other).alias("unit"), *key, "word", "n", F.when(own == other, 3).otherwise(2).alias("role"))
    looked = many.filter(own != other).select(pair(other, own).alias("unit"), *key, "word", "n", F.lit(1).alias("role"))
    return one.unionByName(asks).unionByName(looked)


_SEEN = "word string, n long, seen long, best_n long, best string"


def search(unit: pd.DataFrame) -> pd.DataFrame:
    """One row per asking word that has near words in the unit."""
    unit = unit.sort_values(["m", "last", "half", "word"], ignore_index=True)
    words, counts = unit["word"].to_numpy(), unit["n"].to_numpy()
    codes = {c: i for i, c in enumerate(sorted(set("".join(words))))}
    shard = unit.groupby(["m", "last", "half"], sort=False).ngroup().to_numpy()
    target = np.flatnonzero(unit["role"].to_numpy() & 1)
    query = np.flatnonzero(unit["role"].to_numpy() & 2)
    index = Letters(words[target].tolist(), codes)
    # The best near word is the first that it meets in this order.
    order = np.lexsort((words[target], -counts[target]))
    rank = np.empty(len(target), np.int64)
    rank[order] = np.arange(len(target))
    of_shard = index.bits(shard[target][None, :] == np.arange(shard.max() + 1)[:, None]) if len(target) else None
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out = []
    sizes = unit["m"].to_numpy()
    lasts = unit["last"].to_numpy()
    groups = pd.Series(query).groupby([lengths[query], sizes[query], lasts[query]]) if len(query) and len(target) else ()
    for (length, m, last), members in groups:
        for some in _parts(members.to_numpy(), index.width):
            asked = letter_codes(words[some].tolist(), lengths[some], codes)
            bits = near(index, asked, of_shard[shard[some]], int(m) // 2 if last else None)
            # Of two words of the longer length, the shards of that length report.
            allowed = index.lengths == m if length > m else (index.lengths == m) | (index.lengths == m + 1)
            bits &= index.bits(allowed[None, :])[0]
            some, bits = some[bits.any(axis=1)], bits[bits.any(axis=1)]
            if not len(some):
                continue
            marks = np.unpackbits(bits.view(np.uint8), axis=1, count=len(target), bitorder="little").astype(bool)
            best = np.where(marks, rank, len(target)).min(axis=1)
            out.append(
                pd.DataFrame(
                    {
                        "word": words[some],
                        "n": counts[some],
                        "seen": marks.sum(axis=1),
                        "best_n": counts[target][order][best],
                        "best": words[target][order][best],
                    }
                )
            )
    if not out:
        return pd.DataFrame({"word": [], "n": [], "seen": [], "best_n": [], "best": []}).astype({"word": object, "best": object})
    return pd.concat(out, ignore_index=True)


def _parts(members: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Queries a few at a time, so that their sets take some megabytes at most."""
    step = max(1, (1 << 18) // max(1, width))
    for i in range(0, len(members), step):
        yield members[i : i + step]


# ---- Forms


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, n_near, best, best_n`` of every word of ``word, n``, ``best`` its most frequent
    near word, the least in code-point order on ties; NULL and 0 where it has none."""
    seen = units(words).groupBy("unit").applyInPandas(lambda unit: search(unit), _SEEN)
    # The least of (-n, word) is the most frequent near word, the least on ties.
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    met = seen.groupBy("word").agg(F.sum("seen").alias("n_near"), best.alias("b"))
    return words.join(dealt(met), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("b.word").alias("best"), (-F.col("b.minus")).alias("best_n"),
    )


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``word, n``.

    A word's form is its best near word if that is ``ratio`` times as frequent; its root is
    the last word of the chain of forms, itself without one. Counts rise along a chain, so it ends.
    """
    found = near_words(words)
    formed = F.col("best_n") >= ratio * F.col("n")
    table_ = stage(
        found.select(
            "word", "n", "n_near", F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")
        ),
        "forms",
    )
    roots = last_forms(table_.filter(F.col("form").isNotNull()).select("word", "form"))
    joined = table_.join(dealt(roots), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` of words that have a form. Every round doubles the way that is followed."""
    roots = stage(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ROUNDS):
        further = dealt(roots.select(F.col("word").alias("root"), F.col("root").alias("next")))
        moved = stage(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        roots = moved.select("word", "root")
        if moved.filter(F.col("next").isNotNull()).isEmpty():
            return roots
    raise RuntimeError(f"no last forms after {ROUNDS} rounds")


def spelling_groups(docs: DataFrame) -> DataFrame:
    """Words of the documents with their forms and roots.

    Repeated rows count as often as they occur, further columns are ignored, and an empty table
    gives an empty result.
    """
    return variants(stage(vocabulary(docs), "words"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form and root."""
    return spelling_groups(table(spark, sf_dir, "documents"))

"""Remove byte strings that occur more than once in a corpus, by suffix sorting.

Every byte covered by a ``length``-byte string that also starts anywhere else, in the same
document or another, goes. Sorting all suffixes of a corpus would multiply it by the depth,
so suffixes are only sorted where strings can repeat:

1. Each window of ``length`` bytes has an anchor, its least-hashed ``gram``-byte string. Equal
   windows have equal anchors at the same place, so a window can only repeat if its
   anchor's string does. Anchors are shuffled as hashes.
2. Around an anchor lie all windows it stands for: up to ``length - gram`` bytes before it and
   ``length`` from it on, its context. Occurrences that share the whole context are covered
   by it at once, however many they are.
3. The other contexts of a repeated string, one per distinct context, are sorted as suffixes
   to the right and as reversed prefixes to the left, by deep-shallow sorting: a multikey
   quicksort over machine words to a shallow depth, then a blind trie for each group
   that still agrees. Common prefixes of neighbours say which windows are shared.
4. A string with very many distinct contexts is not sorted in one task. Its windows are
   counted by hash in two steps, ranges of windows by their common core first, so that
   every count is aggregated before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import dealt, table
from tidewatch.plans import stage

LENGTH = 200
GRAM = 32
CONTEXTS = 512  # distinct contexts of one string that are sorted in one task
SHALLOW = 5  # machine words that the quicksort compares
STEP = 13  # windows of a range
_PIECE = 1 << 20  # bytes hashed at a time; positions in it take 20 bits
_TEXTS = 500  # texts whose contexts are held at a time
_NONE = -(1 << 63)

# ---- Anchors


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed polynomial hash of each ``gram``-byte string, by doubling."""
    with np.errstate(over="ignore"):
        h, width, base = data.astype(np.uint64) + np.uint64(1), 1, np.uint64(0x9E3779B97F4A7C15)
        while width < gram:
            h = h[:-width] * base + h[width:]
            base, width = base * base, width * 2
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys."""
    done = 1
    while done * 2 <= width:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    if done < width:
        keys = np.minimum(keys[: len(keys) - (width - done)], keys[width - done :])
    return keys


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text number, position, hash`` of every anchor; ``gram`` is a power of 2."""
    texts_, places, hashes = [], [], []

    def piece(parts: list[tuple[int, int, bytes]]) -> None:
        data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        sizes = np.array([len(p) for _, _, p in parts])
        starts = np.concatenate(([0], np.cumsum(sizes)))
        h = _gram_hashes(data, gram)
        keys = (h & ~np.uint64(_PIECE - 1)) | np.arange(len(h), dtype=np.uint64)
        least = _least(keys, length - gram + 1)
        of = np.repeat(np.arange(len(parts)), sizes)[: len(least)]
        inside = np.arange(len(least)) + length <= starts[of + 1]
        found = np.unique((least[inside] & np.uint64(_PIECE - 1)).astype(np.int64))
        of = np.searchsorted(starts, found, side="right") - 1
        texts_.append(np.array([t for t, _, _ in parts])[of])
        places.append(found - starts[of] + np.array([s for _, s, _ in parts])[of])
        hashes.append(h[found])

    held, size = [], 0
    for number, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, _PIECE // 2):
            part = text[start : start + _PIECE // 2 + length - 1]
            if size + len(part) >= _PIECE:
                piece(held)
                held, size = [], 0
            held.append((number, start, part))
            size += len(part)
    if held:
        piece(held)
    if not texts_:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    t, p, h = np.concatenate(texts_), np.concatenate(places), np.concatenate(hashes)
    twice = np.zeros(len(t), bool)  # pieces of one text overlap
    order = np.lexsort((p, t))
    t, p, h = t[order], p[order], h[order]
    twice[1:] = (t[1:] == t[:-1]) & (p[1:] == p[:-1])
    return t[~twice], p[~twice], h[~twice]


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``h, c, k, tp``: hash of the string and of its context, text key, text tag and position."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [_utf8(t) for t in batch["text"]]
            number, place, h = anchors(texts, length, gram)
            before = length - gram
            c = np.array(
                [
                    xxhash.xxh3_64_intdigest(texts[i][max(0, a - before) : a + length], min(a, before))
                    for i, a in zip(number.tolist(), place.tolist(), strict=True)
                ],
                dtype=np.uint64,
            )
            yield pd.DataFrame(
                {
                    "h": h.view(np.int64),
                    "c": c.view(np.int64),
                    "k": batch["k"].to_numpy()[number],
                    "tp": (batch["tag"].to_numpy()[number] << 32) | place,
                }
            )

    return docs.select("k", "tag", "text").mapInPandas(run, "h long, c long, k long, tp long")


# ---- Deep-shallow sorting


def deep_shallow(rows: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """``order, lcp`` of byte rows of one width, a multiple of 8, sorted within their groups.

    ``lcp[i]`` is the common prefix of the rows at ``i - 1`` and ``i`` of the order, -1 between groups.
    """
    n, width = rows.shape
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    bounds = np.concatenate(([0], cuts, [n])) if n else np.array([0, 0])
    pending = [(a, b, 0) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) if b - a > 1]
    while pending:
        low, high, depth = pending.pop()
        mine = order[low:high]
        if depth == words.shape[1]:
            continue
        if depth == shallow:
            order[low:high] = mine[BlindTrie.sort([rows[i].tobytes() for i in mine])]
            continue
        key = words[mine, depth]
        pivot = key[len(key) // 2]
        less, same = key < pivot, key == pivot
        a, b = int(less.sum()), int(same.sum())
        if b < len(key):
            order[low:high] = np.concatenate((mine[less], mine[same], mine[key > pivot]))
        pending += [
            part
            for part in ((low, low + a, depth), (low + a, low + a + b, depth + 1), (low + a + b, high, depth))
            if part[1] - part[0] > 1
        ]
    lcp = np.full(n, -1, np.int64)
    if n > 1:
        differ = rows[order[1:]] != rows[order[:-1]]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        lcp[1:] = np.where(group[order[1:]] == group[order[:-1]], first, -1)
    return order, lcp


class BlindTrie:
    """A trie whose nodes know only at which byte their children part."""

    @staticmethod
    def sort(strings: list[bytes]) -> list[int]:
        """The order of strings of one length."""
        same: dict[int, list[int]] = {0: [0]}  # equal strings hang together at the first
        root: list | int = 0  # a leaf, or [depth, {byte: child}]
        for new in range(1, len(strings)):
            text = strings[new]
            node = root
            while not isinstance(node, int):  # blind descent: any child will do where none fits
                node = node[1].get(text[node[0]]) if text[node[0]] in node[1] else next(iter(node[1].values()))
            depth = _common(text, strings[node])
            if depth == len(text):
                same[node].append(new)
                continue
            same[new] = [new]
            above, at = None, root
            while not isinstance(at, int) and at[0] < depth:
                above, at = at, at[1][text[at[0]]]
            if not isinstance(at, int) and at[0] == depth:
                at[1][text[depth]] = new
                continue
            branch = [depth, {strings[node][depth]: at, text[depth]: new}]
            if above is None:
                root = branch
            else:
                above[1][text[above[0]]] = branch
        out, stack = [], [root]
        while stack:
            node = stack.pop()
            if isinstance(node, int):
                out += same[node]
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        return out


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of one length."""
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (differ.bit_length() + 7) // 8


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    width = -(-width // 8) * 8
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(-1, width)


def shared_windows(
    left: list[bytes], right: list[bytes], group: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> tuple[np.ndarray, np.ndarray]:
    """Of each context, the least and greatest ``d`` such that the window that starts ``d`` bytes
    before the anchor occurs in another context of its group; -1 where there is none.

    ``left`` is the text before the anchor, reversed. Two contexts share window ``d`` if they
    agree on ``d`` bytes to the left and ``length - d`` to the right, that is, if they are in
    one run of neighbours with such common prefixes in both orders.
    """
    n, before = len(left), length - gram
    least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    if n < 2:
        return least, most
    ends = []
    for parts, width in ((left, before), (right, length)):
        order, lcp = deep_shallow(_padded(parts, width), group)
        best = np.empty(n, np.int64)
        best[order] = np.maximum(lcp, np.append(lcp[1:], -1))
        ends.append((order, lcp, best, np.array([len(p) for p in parts])))
    (l_order, l_lcp, l_best, l_size), (r_order, r_lcp, r_best, r_size) = ends
    low = np.maximum(0, length - np.minimum(r_best, r_size))
    high = np.minimum(np.minimum(l_best, l_size), before)

    def hits(d: int, waiting: np.ndarray) -> np.ndarray:
        asked = np.flatnonzero((low <= d) & (d <= high))
        if not len(asked) or not waiting[asked].any():
            return np.empty(0, np.int64)
        l_run, r_run = np.empty(n, np.int64), np.empty(n, np.int64)
        l_run[l_order] = np.cumsum(l_lcp < d)
        r_run[r_order] = np.cumsum(r_lcp < length - d)
        key = l_run[asked] * (n + 1) + r_run[asked]
        _, place, times = np.unique(key, return_inverse=True, return_counts=True)
        found = asked[times[place] > 1]
        return found[waiting[found]]

    waiting = low <= high
    for d in range(before + 1):
        if not waiting.any():
            break
        least[at := hits(d, waiting)] = d
        waiting[at] = False
        waiting &= high > d
    waiting = least >= 0
    for d in range(before, -1, -1):
        if not waiting.any():
            break
        most[at := hits(d, waiting)] = d
        waiting[at] = False
    return least, most


# ---- Steps

def contexts(docs: DataFrame, asked: DataFrame, length: int, gram: int) -> DataFrame:
    """``h, n, cs, k, tag, pos, left, right`` of each asked anchor, read from its text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), _TEXTS):
                part = batch.iloc[first : first + _TEXTS]
                counts = [len(p) for p in part["pos"]]
                raw = [_utf8(t) for t in part["text"]]
                places = [(t, a) for t, p in zip(raw, part["pos"], strict=True) for a in p.tolist()]
                out = {c: np.concatenate(list(part[c])) for c in ("h", "n", "cs")}
                out |= {c: np.repeat(part[c].to_numpy(), counts) for c in ("k", "tag")}
                out["pos"] = np.concatenate(list(part["pos"]))
                out["left"] = [t[max(0, a - (length - gram)) : a][::-1] for t, a in places]
                out["right"] = [t[a : a + length] for t, a in places]
                yield pd.DataFrame(out)

    by_text = asked.groupBy("k", "tag").agg(F.collect_list(F.struct("pos", "h", "n", "cs")).alias("a"))
    each = [F.col(f"a.{c}").alias(c) for c in ("pos", "h", "n", "cs")]
    return (
        docs.select("k", "tag", "text").join(by_text, ["k", "tag"]).select("k", "tag", "text", *each)
        .mapInPandas(run, "h long, n long, cs long, k long, tag long, pos long, left binary, right binary")
    )


def sorted_spans(found: DataFrame, length: int, gram: int) -> DataFrame:
    """``k, tag, pos, low, high`` of the contexts that share a window, by suffix sorting.

    The contexts of a string follow each other in one partition; a task holds one batch
    of rows and the string that goes on in the next.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            goes_on = batch["h"] == batch["h"].iloc[-1] if len(batch) else batch["h"] == 0
            held = batch[goes_on]
            yield settled(batch[~goes_on])
        if held is not None:
            yield settled(held)

    def settled(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = shared_windows(list(rows["left"]), list(rows["right"]), rows["h"].to_numpy(), length, gram)
        out = rows[["k", "tag", "pos"]].assign(low=low, high=high)
        return out[(low >= 0) & (rows["n"].to_numpy() == 1)]

    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = found.drop("cs").repartition(tasks, "h").sortWithinPartitions("h")
    return together.mapInPandas(run, "k long, tag long, pos long, low long, high long")


def counted_spans(found: DataFrame, length: int, gram: int) -> DataFrame:
    """The same by counting windows: first ranges of ``STEP`` windows by what all of them hold,
    then the windows of the ranges whose core repeats."""

    def cores(step: int) -> Column:
        @F.pandas_udf("struct<d:array<int>,w:array<binary>>")
        def run(lefts: pd.Series, rights: pd.Series, firsts: pd.Series) -> pd.DataFrame:
            out = []
            for left, right, asked in zip(lefts, rights, firsts, strict=True):
                text, at = left[::-1] + right, len(left)
                starts, digests = [], []
                for first in asked:
                    # Windows that start first to first + step - 1 bytes before the anchor.
                    for d in range(first, min(first + STEP, length - gram + 1), step):
                        last = min(d + step - 1, length - gram)
                        if d > len(left) or length - last > len(right):
                            continue
                        starts.append(d)
                        digests.append(xxhash.xxh3_128_digest(text[max(0, at - d) : at - last + length], d))
                out.append((starts, digests))
            return pd.DataFrame(out, columns=["d", "w"])

        return run("left", "right", "asked")

    def repeated(rows: DataFrame, step: int) -> DataFrame:
        cut = rows.select("h", "k", "tag", "pos", "n", cores(step).alias("x"))
        zipped = F.explode(F.arrays_zip("x.d", "x.w")).alias("x")
        each = cut.select("h", "k", "tag", "pos", "n", zipped).select("h", "k", "tag", "pos", "n", "x.*")
        twice = each.groupBy("h", "w").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times")
        return stage(each.join(dealt(twice), ["h", "w"]).drop("w"), "repeated")

    item = ["h", "k", "tag", "pos"]
    first = found.withColumn("asked", F.sequence(F.lit(0), F.lit(length - gram), F.lit(STEP)))
    ranges = repeated(first, STEP).groupBy(*item).agg(F.collect_list("d").alias("asked"))
    narrowed = found.join(dealt(ranges), item)
    return (
        repeated(narrowed, 1).filter("n = 1")
        .groupBy("k", "tag", "pos")
        .agg(F.min("d").cast("long").alias("low"), F.max("d").cast("long").alias("high"))
    )


# ---- Operator


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = CONTEXTS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` with one row per row of ``docs``.

    ``kept`` is what is left of the text's bytes; ``n_spans`` counts maximal removed runs. NULL
    texts are empty. Repeated rows are other places where a string starts, so a repeated
    text of ``length`` bytes or more goes whole.
    """
    if gram & (gram - 1) or not 0 < gram < length:
        raise ValueError("gram must be a power of 2 below the length")
    keyed = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("k"),
        F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).alias("tag"),
        "text",
    )
    every = stage(anchor_rows(keyed, length, gram), "anchors")
    strings = every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    again = stage(every.join(dealt(strings), "h"), "again")
    distinct = stage(
        again.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "tp")).alias("rep")), "distinct"
    )
    tag, pos = F.shiftright("tp", 32).alias("tag"), F.col("tp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("pos")
    whole = again.join(dealt(distinct.filter("n > 1").select("h", "c")), ["h", "c"]).select(
        "k", tag, pos, F.lit(-1).cast("long").alias("low"), F.lit(-1).cast("long").alias("high")
    )
    several = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("cs")).filter("cs > 1")
    asked = distinct.join(dealt(several), "h").select("h", "n", "cs", "rep.*").select("h", "n", "cs", "k", tag, pos)
    found = stage(contexts(keyed, asked, length, gram), "contexts")
    spans = whole.unionByName(sorted_spans(found.filter(F.col("cs") <= most), length, gram))
    crowded = found.filter(F.col("cs") > most)
    if not crowded.isEmpty():
        spans = spans.unionByName(counted_spans(crowded, length, gram))
    by_text = spans.groupBy("k", "tag").agg(F.collect_list(F.struct("pos", "low", "high")).alias("spans"))

    @F.pandas_udf("struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary>")
    def cut(texts: pd.Series, places: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.DataFrame:
        rows = []
        for text, *spans_ in zip(texts, places, lows, highs, strict=True):
            raw = _utf8(text)
            runs = [] if spans_[0] is None else _runs(len(raw), *spans_, length, gram)
            kept = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in runs)], [*(s for s, _ in runs), len(raw)], strict=True))
            rows.append((len(raw), len(raw) - len(kept), len(runs), kept))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    joined = keyed.join(by_text, ["k", "tag"], "left")
    return joined.select("doc_id", cut("text", "spans.pos", "spans.low", "spans.high").alias("r")).select("doc_id", "r.*")


def _runs(size: int, pos: np.ndarray, low: np.ndarray, high: np.ndarray, length: int, gram: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans cover; ``low`` of -1 is a span's whole context."""
    whole = low < 0
    start = np.where(whole, np.maximum(0, pos - (length - gram)), pos - high)
    end = np.where(whole, np.minimum(size, pos + length), pos - low + length)
    order = np.argsort(start, kind="stable")
    out: list[tuple[int, int]] = []
    for a, b in zip(start[order].tolist(), end[order].tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings take from every document."""
    return deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )

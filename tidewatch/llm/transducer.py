"""Byte pair encoding as a streaming transducer with bounded lookahead, and its decoding.

A merge of a left and a right operand takes place or not depending on what stands right of it
only if an earlier merge crosses the end of the right operand, and that merge's left operand is
then a suffix of it. A difference to the right therefore reaches back along a chain of ever
earlier merges, and no further than the right operands of the longest such chain are long in
total. With one longest token more this is the lookahead of the merge list: tokens that
end so many bytes before the end of what was read are the same whatever follows. They are
emitted, and encoding goes on behind them as if the text began there. What is held is a
buffer of fixed length, however long the text.

Normalisation and the classes of characters are the library's own; words are cut block by
block, and a run that goes beyond a block goes on in the next.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm.common import table

TOKENIZER = "word_bpe_49k.json"
BLOCK = 1 << 16  # characters normalised and cut into words at a time
READ = 1024  # bytes read beyond the lookahead before tokens are emitted
FEW = 64  # symbols merged one pair at a time
SHORT, KNOWN = 48, 200_000  # words up to this length whose tokens are kept, and their number
TOKENS = 4096  # tokens decoded at a time
END = "</w>"

# ---- Merges


class MergeList:
    """Ranks of the merges, ids of the tokens, and the sufficient lookahead.

    The list must be proper: every operand is a byte or made by an earlier merge, and no
    token is made twice. Symbols are strings of the byte alphabet, the last of a word marked.
    """

    def __init__(self, merges: Iterable[tuple[str, str]], ids: dict[str, int], end: str = END):
        self.end, self.ids = end, ids
        self.ranks = {(a, b): r for r, (a, b) in enumerate(merges)}
        self.alphabet = byte_alphabet()
        made = {c for b in self.alphabet for c in (b, b + end)}
        if missing := made - ids.keys():
            raise ValueError(f"{len(missing)} bytes have no token")
        for a, b in self.ranks:
            if a not in made or b not in made or a + b in made:
                raise ValueError(f"merge of {a!r} and {b!r} is out of order or repeated")
            made.add(a + b)
        self.longest = max(map(self.size, made))
        self.lookahead = self.chain() + self.longest

    def size(self, token: str) -> int:
        return len(token) - (len(self.end) if self.end and token.endswith(self.end) else 0)

    def chain(self) -> int:
        """Total length of right operands along the longest chain of ever earlier merges, each
        with a left operand that is a suffix of the right operand before it."""
        reach: dict[str, int] = {}
        longest = 0
        for left, right in self.ranks:
            n = self.size(right)
            reached = n + max(reach.get(right[i:], 0) for i in range(n))
            reach[left] = max(reach.get(left, 0), reached)
            longest = max(longest, reached)
        return longest

    def merged(self, symbols: list[str]) -> list[str]:
        """Symbols after all merges: always the earliest in the list, from the left on ties."""
        return self._one_by_one(symbols) if len(symbols) <= FEW else self._at_once(symbols)

    def _one_by_one(self, symbols: list[str]) -> list[str]:
        rank = self.ranks.get
        symbols = symbols.copy()
        ranks = [rank(pair, _NEVER) for pair in zip(symbols, symbols[1:])]
        while ranks and (least := min(ranks)) != _NEVER:
            i = ranks.index(least)
            symbols[i] += symbols.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), _NEVER)
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), _NEVER)
        return symbols

    def _at_once(self, symbols: list[str]) -> list[str]:
        """Every place of a merge in one go, which the order of a proper list allows."""
        while len(symbols) > 1:
            rank, pair = min((self.ranks.get(p, _NEVER), p) for p in zip(symbols, symbols[1:]))
            if rank == _NEVER:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols


_NEVER = 1 << 60


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where printable, else from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Word:
    """One word, fed in parts: ids come out once no continuation can change them."""

    def __init__(self, merges: MergeList, read: int = READ):
        self.merges, self.most = merges, merges.lookahead + max(read, merges.longest)
        self.held: list[str] = []  # symbols of the word that no token has been emitted for

    def feed(self, part: str) -> Iterator[int]:
        """More characters of the word; the last symbol waits, as it may end the word."""
        alphabet = self.merges.alphabet
        for i in range(0, len(part), self.most):
            self.held += [alphabet[b] for b in part[i : i + self.most].encode("utf-8", "surrogatepass")]
            while len(self.held) > self.most:
                yield from self._emit()

    def _emit(self) -> Iterator[int]:
        window = self.held[: self.most]
        stable = len(window) - self.merges.lookahead
        done = 0
        for token in self.merges.merged(window):
            if done + len(token) > stable:
                break
            done += len(token)
            yield self.merges.ids[token]
        self.held = self.held[done:]

    def close(self) -> Iterator[int]:
        if self.held:
            self.held[-1] += self.merges.end
            for token in self.merges.merged(self.held):
                yield self.merges.ids[token]
            self.held = []


# ---- Texts


class Encoder:
    """Ids of whole texts, as the library's ``encode`` without special tokens gives them."""

    def __init__(self, path: str, read: int = READ, block: int = BLOCK):
        self.library = Tokenizer.from_file(path)
        with open(path) as file:
            setup = json.load(file)
        _supported(setup)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in setup["model"]["merges"]]
        self.merges = MergeList(merges, setup["model"]["vocab"], setup["model"]["end_of_word_suffix"])
        self.added = {t["content"]: t["id"] for t in setup["added_tokens"]}
        found = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, found)) or r"(?!)")
        self.read, self.block = read, block
        self.classes = _Classes(self.library)
        self.known = _Known(self.merges, read)

    def ids(self, text: str) -> Iterator[list[int]]:
        """Ids of the text, some at a time."""
        start = 0
        if any(token in text for token in self.added):
            for hit in self.special.finditer(text):
                yield from self._plain(text, start, hit.start())
                yield [self.added[hit.group()]]
                start = hit.end()
        yield from self._plain(text, start, len(text))

    def _plain(self, text: str, start: int, end: int) -> Iterator[list[int]]:
        """Text without special tokens, block by block."""
        word = kind = None  # the word that the last block ended in, and the class of its run
        rest = ""
        while start < end:
            stop = min(end, start + self.block)
            if stop < end:
                stop = _safe_cut(text, start, stop, end)
            block = rest + self._normal(text[start:stop])
            start, final, rest = stop, stop == end, ""
            shown = block if _plain_letters(block) else block.translate(self.classes)
            out: list[int] = []
            at = 0
            if word is not None:
                at = _RUN[kind].match(shown).end()
                out += word.feed(block[:at])
                if at < len(block) or final:
                    out += word.close()
                    word = None
            sure = len(shown) if final else max(shown.rfind(" "), at)  # no word goes beyond a space
            out += self._words(block, shown, at, sure)
            whole = len(block) - 2  # a word that starts later may still grow into a suffix
            for hit in _WORD.finditer(shown, sure):
                a, b = hit.span()
                if a >= whole:
                    rest = block[a:]
                    break
                if b == len(block) and (kind := hit.lastgroup):
                    word = Word(self.merges, self.read)
                    out += word.feed(block[a:b])
                    break
                out += self.known[block[a:b]]
            yield out

    def _words(self, block: str, shown: str, start: int, end: int) -> Iterator[int]:
        """Ids of the words between two places that no word goes beyond."""
        if shown is block:
            words = _SPLIT.findall(block, start, end)
        else:
            words = [block[hit.start() : hit.end()] for hit in _SPLIT.finditer(shown, start, end)]
        return chain.from_iterable(map(self.known.__getitem__, words))

    def _normal(self, block: str) -> str:
        # Below U+0300 nothing composes, and case and white space are plain.
        if _plain_letters(block):
            return block.lower()
        return self.library.normalizer.normalize_str(block)


class _Known(dict):
    """Ids by word, kept for short ones; emptied when full."""

    def __init__(self, merges: MergeList, read: int):
        super().__init__()
        self.merges, self.read = merges, read

    def __missing__(self, word: str) -> list[int]:
        run = Word(self.merges, self.read)
        found = [*run.feed(word), *run.close()]
        if len(word) <= SHORT:
            if len(self) >= KNOWN:
                self.clear()
            self[word] = found
        return found


def _supported(setup: dict) -> None:
    """Raise unless the file describes the kind of tokenizer that this module follows."""
    model = setup["model"]
    normal = [n["type"] for n in (setup["normalizer"] or {}).get("normalizers", [])]
    split = (setup["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    if (
        model["type"] != "BPE"
        or not model["end_of_word_suffix"]
        or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        or normal != ["NFC", "Replace", "Lowercase"]
        or split.get("pattern", {}).get("Regex") != SPLIT
        or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in setup["added_tokens"])
        or setup["decoder"]
    ):
        raise ValueError("not a lower-casing byte pair tokenizer with word ends")


# Fixed value: how these tokenizer files split words; what matches nothing is dropped.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _below(kind: str) -> str:
    """The characters below U+0300 of a class, for use between brackets."""
    return "".join(re.escape(chr(c)) for c in range(0x300) if regex.match(kind, chr(c)))


# Characters from U+0300 on are looked at through stand-ins from below.
_L, _N, _S = (_below(kind) for kind in (r"\p{L}", r"\p{N}", r"\s"))
_SUFFIX = "'s|'t|'re|'ve|'m|'ll|'d"
_OTHER = f"[^{_S}{_L}{_N}]"
_SPLIT = re.compile(f"{_SUFFIX}|[{_L}]+|[{_N}]|{_OTHER}+")
_WORD = re.compile(f"{_SUFFIX}|(?P<letters>[{_L}]+)|[{_N}]|(?P<others>{_OTHER}+)")
_RUN = {"letters": re.compile(f"[{_L}]*"), "others": re.compile(f"{_OTHER}*")}
_FAR = re.compile("[\u0300-\U0010ffff]")


def _plain_letters(text: str) -> bool:
    return text.isascii() or not _FAR.search(text)


class _Classes(dict):
    """Stand-ins of the same class for characters from U+0300 on, asked of the library."""

    def __init__(self, library: Tokenizer):
        super().__init__()
        self.cut = lambda text: len(library.pre_tokenizer.pre_tokenize_str(text))

    def __missing__(self, code: int) -> int:
        char = chr(code)
        if code < 0x300 or 0xD800 <= code < 0xE000:
            found = code
        elif not self.cut(char):
            found = 0x20
        elif self.cut(char + char) == 2:
            found = 0x30
        else:
            found = 0x71 if self.cut("a" + char) == 1 else 0x21  # a letter that ends no suffix, or another
        self[code] = found
        return found


@lru_cache(maxsize=1)
def _joining() -> frozenset[str]:
    """Characters that may compose with, or move before, the one to their left."""
    joins = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for code in range(0x110000):
        char = chr(code)
        if unicodedata.combining(char):
            joins.add(char)
        parts = unicodedata.decomposition(char)
        if parts and parts[0] != "<" and " " in parts:
            joins.add(chr(int(parts.split()[1], 16)))
    return frozenset(joins)


def _safe_cut(text: str, start: int, stop: int, end: int) -> int:
    """A place near ``stop`` before which and after which the text normalises for itself.

    Searched to the left within the block first, then to the right, so a block grows only
    by marks that belong to one character.
    """
    for at in range(stop, max(start, stop - 64), -1):
        if text[at] < "\u0300" or text[at] not in _joining():
            return at
    while stop < end and text[stop] >= "\u0300" and text[stop] in _joining():
        stop += 1
    return stop


# ---- Decoding


class Decoder:
    """Text of ids, some at a time.

    Without a decoder of its own the library joins token strings by a space. ``plain`` gives
    readable text instead: bytes for the byte alphabet, a space for the end of a word.
    """

    def __init__(self, path: str, plain: bool = False):
        with open(path) as file:
            setup = json.load(file)
        ids = setup["model"]["vocab"] | {t["content"]: t["id"] for t in setup["added_tokens"]}
        end = setup["model"]["end_of_word_suffix"] or ""
        self.pieces: list[bytes | None] = [None] * (max(ids.values()) + 1)
        value = {c: b for b, c in enumerate(byte_alphabet())}
        special = {t["content"] for t in setup["added_tokens"]}
        for token, at in ids.items():
            if plain and token not in special:
                body = token.removesuffix(end) if end else token
                self.pieces[at] = bytes(value[c] for c in body) + (b" " if body != token else b"")
            else:
                self.pieces[at] = token.encode()
        self.joint = b"" if plain else b" "

    def text(self, blocks: Iterable[Iterable[int]]) -> Iterator[str]:
        """Ids unknown to the tokenizer are passed over, as the library does; bytes that are no
        text become U+FFFD."""
        state = codecs.getincrementaldecoder("utf-8")(errors="replace")
        first = True
        for block in blocks:
            found = [p for i in block if 0 <= i < len(self.pieces) and (p := self.pieces[i]) is not None]
            if found:
                yield state.decode((b"" if first else self.joint) + self.joint.join(found))
                first = False
        yield state.decode(b"", final=True)


# ---- Tables

_tools: dict[tuple, Encoder | Decoder] = {}


def _tool(kind: type, path: str | None, *more):
    """One per worker; without a path, of the installed public file."""
    key = (kind, path, *more)
    if key not in _tools:
        _tools[key] = kind(path or public_tokenizers.path(TOKENIZER), *more)
    return _tools[key]


def encoded(text: Column, path: str | None = None) -> Column:
    """Ids of each whole text as ``array<int>``; NULL and empty texts have none.

    ``path`` names a tokenizer file that every worker can read.
    """

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        encoder = _tool(Encoder, path)
        out = []
        for text in texts:
            ids: list[int] = []
            for some in encoder.ids(text or ""):
                ids += some
            out.append(np.array(ids, np.int32))
        return pd.Series(out, dtype=object)

    return run(text)


def decoded(ids: Column, path: str | None = None, plain: bool = False) -> Column:
    """Text of each array of ids; NULL is the empty text."""

    @F.pandas_udf("string")
    def run(lists: pd.Series) -> pd.Series:
        decoder = _tool(Decoder, path, plain)
        return pd.Series(["".join(decoder.text(_slices(x))) for x in lists], dtype=object)

    return run(ids)


def digests(ids: Column, path: str | None = None) -> Column:
    """``n_tokens, ids_sha256, decoded_sha256`` of each array of ids, decoded piece by piece."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(lists: pd.Series) -> pd.DataFrame:
        decoder = _tool(Decoder, path)
        rows = []
        for x in lists:
            x = np.asarray([] if x is None else x, dtype="<u4")
            text = hashlib.sha256()
            for part in decoder.text(_slices(x)):
                text.update(part.encode())
            rows.append((len(x), hashlib.sha256(x.tobytes()).hexdigest(), text.hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(ids)


def _slices(ids) -> Iterator[list[int]]:
    for i in range(0, 0 if ids is None else len(ids), TOKENS):
        yield np.asarray(ids[i : i + TOKENS]).tolist()


def coded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` for every row; repeated rows and NULL ids are rows of their own, further
    columns are ignored, and an empty table gives an empty result."""
    return docs.select("doc_id", encoded(docs["text"], path).alias("ids"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    ids = coded(table(spark, sf_dir, "documents"))
    return ids.select("doc_id", digests(ids["ids"]).alias("d")).select("doc_id", "d.*")

"""Byte-level BPE encoding by prefix dynamic programming, and decoding.

For every byte prefix of a piece there is one valid last token: a token t that ends there such that t is
what the merges leave after the last token of the prefix before t.  ``PrefixTable`` stores these tokens.
Reading it backwards gives the encoding; appending bytes only adds entries; after an edit the entries
before it stay, and new ones are computed only until they repeat the old ones for the length of the
longest token, because an entry depends on no more than that.

Text is cut by the tokenizer's pattern first, and each match encoded separately, as its library does: a
match that is itself a token is that token.  Null texts are empty and have no ids; texts of any length are
encoded whole; repeated rows give repeated rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealmill.llm.common import small_batches, whole_text

# Pieces remembered by a worker; frequent ones come back soon after the memory is emptied.
REMEMBERED = 600_000


def _latin_class(kind: str) -> str:
    """Latin-1 letters (L) or numbers (N), for a character class."""
    return "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == kind)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Matches of ``pattern`` in a text.  Texts of Latin-1 take the same pattern with its classes spelled out
    for the standard ``re``, which is three times as fast; all others the pattern as it is."""
    full = regex.compile(pattern).findall
    parts = {r"\p{L}": _latin_class("L"), r"\p{N}": _latin_class("N"), r"\s": r"\t-\r\x20\x85\xa0"}
    out, i, inside = [], 0, False
    while i < len(pattern):
        code = next((p for p in (*parts, r"\S") if pattern.startswith(p, i)), None)
        if code == r"\S":
            out.append(f"[^{parts[chr(92) + 's']}]")
        elif code:
            out.append(parts[code] if inside else f"[{parts[code]}]")
        else:
            inside = {"[": True, "]": False}.get(pattern[i], inside)
            out.append(pattern[i])
        i += len(code or " ")
    latin = re.compile("".join(out)).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return full(text)
        return latin(text)

    return split


def read_ranks(blob: bytes) -> dict[bytes, int]:
    """Token bytes to id, of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, blob.splitlines())}


class Vocabulary:
    """Ranks, and which tokens may follow which."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = dict(zip(ranks.values(), ranks, strict=True))
        self.longest = max(map(len, ranks))
        self._stride = max(self.tokens) + 2
        self.automaton = ahocorasick.Automaton()  # finds all tokens that end at a byte
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}

    def merged(self, data: bytes, stop: int = 1) -> list[bytes]:
        """What the merges leave of a few bytes (``stop`` parts at least), the lowest rank always first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > stop:
            rank, at = min((self.ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 40:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a byte or a token that no merges make."""
        if token not in self._halves:
            parts = self.merged(self.tokens[token], stop=2)
            whole = len(parts) == 2 and self.ranks.get(b"".join(parts)) == token
            self._halves[token] = tuple(self.ranks[p] for p in parts) if whole else None
        return self._halves[token]

    def may_follow(self, before: int, token: int) -> bool:
        """Do the merges leave ``token`` apart after the token ``before`` (-1: at the start)?

        Undo the merges of both from the latest rank down, the left one's before the right one's of the
        same rank: the two stay apart unless the parts that meet would have been merged at some time,
        before the next merge (rank ``until``) changed one of them.
        """
        if len(self.tokens[token]) > 1 and self.halves(token) is None:
            return False
        if before < 0:
            return True
        a, b, until = before, token, self._stride
        while True:
            joint = self.ranks.get(self.tokens[a] + self.tokens[b])
            if joint is not None and joint < until:
                return False
            left, right = self.halves(a), self.halves(b)
            if left and (a > b or not right):
                a, until = left[1], a
            elif right:
                b, until = right[0], b + 1
            else:
                return True

    def extend(self, data: bytes, last: list[int], end: int) -> None:
        """Append the last tokens of the prefixes of ``data`` up to length ``end`` to ``last``."""
        pairs, stride = self._pairs, self._stride
        text = data.decode("latin-1")
        for at, (token, length) in self.automaton.iter(text, max(0, len(last) - self.longest), end):
            if at + 1 < len(last):
                continue  # that prefix has its token
            before = last[at + 1 - length]
            pair = (before + 1) * stride + token
            valid = pairs.get(pair)
            if valid is None:
                if len(pairs) >= REMEMBERED:
                    pairs.clear()
                valid = pairs[pair] = self.may_follow(before, token)
            if valid:
                last.append(token)
        if len(last) <= end:
            raise ValueError(f"byte {data[len(last) - 1]} is not in the vocabulary")

    def read(self, last: list[int]) -> list[int]:
        """The encoding that a finished table of last tokens holds."""
        out, end = [], len(last) - 1
        while end:
            token = last[end]
            out.append(token)
            end -= len(self.tokens[token])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        last = [-1]
        self.extend(data, last, len(data))
        return self.read(last)


class PrefixTable:
    """The last token of every byte prefix of ``data``, kept up to date under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last, len(self.data))

    def edit(self, at: int, removed: int, inserted: bytes) -> int:
        """Replace ``removed`` bytes from ``at``; returns how many entries were computed anew."""
        old = self.last[at + removed + 1 :]
        self.data = self.data[:at] + inserted + self.data[at + removed :]
        del self.last[at + 1 :]
        same, new = 0, 0
        first = at + len(inserted) + 1
        for end in range(at + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data, self.last, end)
            new += 1
            same = same + 1 if end >= first and self.last[end] == old[end - first] else 0
            if same >= self.vocabulary.longest:
                self.last.extend(old[end - first + 1 :])
                break
        return new

    def ids(self) -> list[int]:
        return self.vocabulary.read(self.last)


class Codec:
    """Encodes and decodes texts; remembers the ids of pieces it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.pieces = splitter(pattern)
        self._known: dict[str, bytes] = {}
        tokens = [self.vocabulary.tokens.get(i, b"") for i in range(max(ranks.values()) + 1)]
        self._flat = np.frombuffer(b"".join(tokens), np.uint8)
        self._length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self._begin = np.cumsum(self._length) - self._length

    def piece(self, text: str) -> bytes:
        """Ids of one match, as little-endian 32-bit integers."""
        data = text.encode()
        whole = self.vocabulary.ranks.get(data)
        ids = [whole] if whole is not None else self.vocabulary.encode(data)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        known = self._known
        pieces = self.pieces(text)
        found = list(map(known.get, pieces))
        if None in found:
            if len(known) >= REMEMBERED:
                known.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    piece = pieces[i]
                    ids = found[i] = known.get(piece) or self.piece(piece)
                    if len(piece) <= 64:
                        known[piece] = ids
        return b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        tokens = np.frombuffer(ids, "<u4")
        length = self._length[tokens]
        shift = self._begin[tokens] - (np.cumsum(length) - length)
        return self._flat[np.arange(length.sum()) + np.repeat(shift, length)].tobytes()


@lru_cache(maxsize=2)
def _codec(blob: bytes, pattern: str) -> Codec:
    return Codec(read_ranks(blob), pattern)


class Tokenizer:
    """Columns that encode and decode, by one rank file (its size is that of the vocabulary)."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        small_batches(spark)
        with open(path, "rb") as file:
            self.ranks = spark.sparkContext.broadcast(file.read())
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """Ids of a string column, as little-endian unsigned 32-bit integers in one binary."""
        ranks, pattern = self.ranks, self.pattern

        @F.pandas_udf("binary")
        def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = _codec(ranks.value, pattern)
            for texts in batches:
                yield pd.Series([codec.encode(x) for x in texts], dtype=object)

        return ids(text)

    def decode(self, ids: Column) -> Column:
        """Bytes of a column made by ``encode``; ids outside the vocabulary are an error."""
        ranks, pattern = self.ranks, self.pattern

        @F.pandas_udf("binary")
        def data(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = _codec(ranks.value, pattern)
            for values in batches:
                yield pd.Series([codec.decode(x) for x in values], dtype=object)

        return data(ids)


def encode_documents(df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row: ids and the bytes they decode to."""
    tokenizer = Tokenizer(df.sparkSession, path, pattern)
    ids = df.select(F.col(doc_id).alias("doc_id"), tokenizer.encode(whole_text(text)).alias("ids"))
    return ids.withColumn("decoded", tokenizer.decode(F.col("ids")))

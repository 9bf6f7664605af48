"""SentencePiece encoding (merges by score) by a table of last tokens, and decoding.

For every prefix of a normalised text there is one valid last token: a token t that ends there such that the
merges, given the last token of the prefix before t and then t, leave the two apart.  An automaton names
the vocabulary pieces that end at a character; a test of the two neighbours picks the valid one, and the ids
are recovered backwards from the end.

Merges go by score, equal scores by place, from the left.  The test undoes the merges of both tokens in the
opposite order and looks, before each, for a merge across their border that would have come first.

Normalisation is that of a model with identity rules: blanks become the blank sign, one is put in front.
Characters outside the vocabulary are spelt by byte pieces.  Texts are cut where no piece of the vocabulary
reaches across, and ids of pieces met before are remembered.

Null and empty texts have no pieces, only the end id where it is asked for, and decode to nothing.  Texts of
any length are encoded whole.  Repeated rows give repeated rows; null or repeated ids make no difference;
an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from dealmill.llm.common import small_batches, whole_text

# Fixed value: the sign that stands for a blank.
BLANK_SIGN = "▁"
REMEMBERED = 400_000
_SHORT = 48
_ATOM = 1 << 30  # a character that is no piece of the vocabulary: this and its code point


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    """A replacement character for every byte that is no part of a character."""
    return "�" * (error.end - error.start), error.end


codecs.register_error("each_byte", _each_byte)


class Vocabulary:
    """The pieces that merges can make, and which may stand side by side."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        p = self.model
        numbers = range(p.get_piece_size())
        if p.encode("a  b ", out_type=str)[0][0] != BLANK_SIGN or p.decode(p.encode("  a  b  ")) != "  a  b  ":
            raise ValueError("only models that put a blank in front and keep all blanks are supported")
        if any(p.is_unused(i) for i in numbers):
            raise ValueError("models with unused pieces are not supported")
        made = [i for i in numbers if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i))]
        self.bytes = {int(p.id_to_piece(i)[3:5], 16): i for i in numbers if p.is_byte(i)}
        if len(self.bytes) < 256:
            raise ValueError("only models that spell unknown characters by bytes are supported")
        self.text = {i: p.id_to_piece(i) for i in made}
        self.id = {t: i for i, t in self.text.items()}
        # Rank 0 merges first; equal scores have equal ranks.
        scores = {s: r for r, s in enumerate(sorted({p.get_score(i) for i in made}, reverse=True))}
        self.rank = {t: scores[p.get_score(i)] for t, i in self.id.items()}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.id.items():
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self._lengths = [len(self.text.get(i, "")) for i in numbers]
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._follows: dict[int, dict[int, bool]] = {}
        self._n_follows = 0

    def atom(self, char: str) -> int:
        return self.id[char] if char in self.id else _ATOM + ord(char)

    def surface(self, token: int) -> str:
        return self.text[token] if token < _ATOM else chr(token - _ATOM)

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a character, or a piece that no merges make."""
        if token >= _ATOM:
            return None
        if token not in self._halves:
            parts = list(self.text[token])
            while len(parts) > 2:
                rank, at = min((self.rank.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank == 1 << 40:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = tuple(map(self.atom, parts)) if len(parts) == 2 else None
        return self._halves[token]

    def may_follow(self, before: int, token: int) -> bool:
        """Do the merges leave ``token`` apart after the token ``before`` (-1: at the start)?"""
        if token < _ATOM and len(self.text[token]) > 1 and self.halves(token) is None:
            return False
        if before < 0:
            return True
        a, b, until = before, token, 1 << 40
        while True:
            joint = self.rank.get(self.surface(a) + self.surface(b))
            if joint is not None and joint < until:
                return False
            left, right = self.halves(a), self.halves(b)
            rank_a = self.rank[self.surface(a)] if left else -1
            rank_b = self.rank[self.surface(b)] if right else -1
            # The latest merge goes first; of equal rank, the one further right was the later.
            if right and rank_b >= rank_a:
                b, until = right[0], rank_b + 1
            elif left:
                a, until = left[1], rank_a
            else:
                return True

    def _learn(self, before: int, token: int) -> bool:
        if self._n_follows >= REMEMBERED:
            self._follows.clear()
            self._n_follows = 0
        self._n_follows += 1
        valid = self._follows.setdefault(before, {})[token] = self.may_follow(before, token)
        return valid

    def encode(self, text: str) -> list[int]:
        """Tokens of a normalised text."""
        whole = self.id.get(text)
        if whole is not None and self.may_follow(-1, whole):
            return [whole]
        last, done, follows, size = [-1], 0, self._follows, len(text)
        append = last.append
        for at, (token, length) in self.automaton.iter(text):
            if at < done:
                continue  # that prefix has its token
            while done < at:  # characters before this one that end no piece
                append(_ATOM + ord(text[done]))
                done += 1
            before = last[at + 1 - length]
            # What is known of the neighbours on the right of ``before``.
            valid = follows[before].get(token) if before in follows else None
            if valid is None:
                valid = self._learn(before, token)
            if valid:
                append(token)
                done += 1
        last += [_ATOM + ord(c) for c in text[done:]]
        out, end, lengths = [], size, self._lengths
        while end:
            token = last[end]
            out.append(token)
            end -= lengths[token] if token < _ATOM else 1
        out.reverse()
        return out

    def cutter(self):
        """Finds the parts of a normalised text that no piece reaches across."""
        long = [t for t in self.id if len(t) > 1]
        joined = {c for t in long for c in t} - {BLANK_SIGN}
        letters = {c for c in joined if c.isalpha()}
        beside = {(x in letters, y in letters) for t in long for x, y in zip(t, t[1:], strict=False) if BLANK_SIGN not in (x, y)}
        blank_inside = any(y == BLANK_SIGN != x for t in long for x, y in zip(t, t[1:], strict=False))
        if blank_inside:
            return lambda text: [text]
        group = lambda chars: "[" + "".join(re.escape(c) for c in sorted(chars)) + "]"
        parts = [BLANK_SIGN + "+", "(?s:.)"]
        if (True, False) in beside or not letters or letters == joined:
            parts.insert(0, f"{BLANK_SIGN}*{group(joined)}+")
        else:  # no piece goes on after its letters
            others = group(joined - letters)
            parts[:0] = [f"{BLANK_SIGN}*{others}*{group(letters)}+", f"{BLANK_SIGN}*{others}+"]
        return re.compile("|".join(parts)).findall


class Codec:
    """Encodes and decodes texts; remembers the ids of parts it has met."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self.cut = self.vocabulary.cutter()
        p = self.vocabulary.model
        self.end = p.eos_id()
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        numbers = range(p.get_piece_size())
        spelt = [self._surface(p, i) for i in numbers]
        # Texts of all pieces one after another, and where each begins.
        self._flat = np.frombuffer(b"".join(spelt), np.uint8)
        self._length = np.array([len(x) for x in spelt])
        self._begin = np.cumsum(self._length) - self._length
        self._control = np.array([p.is_control(i) for i in numbers])
        self._blank_first = {i for i, t in self.vocabulary.text.items() if t[0] == BLANK_SIGN}

    @staticmethod
    def _surface(p: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
        if p.is_byte(i):
            return bytes([int(p.id_to_piece(i)[3:5], 16)])
        if p.is_control(i):
            return b""
        return p.decode([i]).encode() if p.is_unknown(i) else p.id_to_piece(i).replace(BLANK_SIGN, " ").encode()

    def _part(self, text: str) -> bytes:
        out: list[int] = []
        for token in self.vocabulary.encode(text):
            if token < _ATOM:
                out.append(token)
            else:
                out.extend(self.vocabulary.bytes[b] for b in chr(token - _ATOM).encode())
        return struct.pack(f"<{len(out)}i", *out)

    def encode(self, text: str, end: bool = True) -> np.ndarray:
        known = self._known
        parts = self.cut(BLANK_SIGN + text.replace(" ", BLANK_SIGN)) if text else []
        found = list(map(known.get, parts))
        if None in found:
            if len(known) >= REMEMBERED:
                # The parts met last stay at hand; those among them that come again are remembered again.
                self._older, self._known = known, {}
                known = self._known
            older = self._older
            for i, ids in enumerate(found):
                if ids is None:
                    part = parts[i]
                    ids = found[i] = known.get(part) or older.get(part) or self._part(part)
                    if len(part) <= _SHORT:
                        known[part] = ids
        if end:
            found.append(struct.pack("<i", self.end))
        return np.frombuffer(b"".join(found), "<i4")

    def _spell(self, ids: np.ndarray) -> str:
        length = self._length[ids]
        shift = self._begin[ids] - (np.cumsum(length) - length)
        return self._flat[np.arange(length.sum()) + np.repeat(shift, length)].tobytes().decode("utf-8", "each_byte")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the blank in front goes, and bytes that are no character become replacement signs.

        Control ids have no text, but bytes before and after one make no character together.
        """
        if not len(ids):
            return ""
        control = np.flatnonzero(self._control[ids])
        if not len(control) or control[0] == len(ids) - 1:
            text, first = self._spell(ids), ids[0]
        else:
            text = "".join(map(self._spell, np.split(ids, control)))
            first = next((i for i in ids if not self._control[i]), None)
        return text[1:] if first in self._blank_first else text


@lru_cache(maxsize=2)
def _codec(model: bytes) -> Codec:
    return Codec(model)


class Tokenizer:
    """Columns that encode and decode, by one model file (its size is that of the vocabulary)."""

    def __init__(self, spark: SparkSession, path: str):
        small_batches(spark)
        with open(path, "rb") as file:
            self.model = spark.sparkContext.broadcast(file.read())

    def encode(self, text: Column, end: bool = True) -> Column:
        """Ids of a string column, as an array of integers."""
        model = self.model

        @F.pandas_udf(ArrayType(IntegerType()))
        def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = _codec(model.value)
            for texts in batches:
                yield pd.Series([codec.encode(x, end) for x in texts], dtype=object)

        return ids(text)

    def decode(self, ids: Column) -> Column:
        """Text of an array of ids; an id outside the vocabulary is an error."""
        model = self.model

        @F.pandas_udf("string")
        def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = _codec(model.value)
            for values in batches:
                yield pd.Series([codec.decode(np.asarray(x)) for x in values], dtype=object)

        return texts(ids)


def encode_documents(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row: ids with the end id, and the text they decode to."""
    model = Tokenizer(df.sparkSession, path).model

    # Both in one pass through Python: a worker holds the vocabulary once.
    @F.pandas_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(model.value)
        for texts in batches:
            ids = [codec.encode(x) for x in texts]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series([codec.decode(x) for x in ids], dtype=object)})

    done = df.select(F.col(doc_id).alias("doc_id"), both(whole_text(text)).alias("done"))
    return done.select("doc_id", "done.ids", "done.decoded")


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the hashes of ids and decoded text of ``encode_documents``."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

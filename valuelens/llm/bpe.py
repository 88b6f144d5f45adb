"""Byte-level BPE: encoding by dynamic programming over byte prefixes, and decoding.

For every prefix of a piece there is exactly one token that can end its encoding. It is stored per prefix, so
that bytes can be appended at the cost of the new ones alone, and an edit needs new work only up to the
place where the stored tokens agree again.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REMEMBERED_PIECES = 500_000  # of each Python worker, in two halves; a cache only: results do not depend on it
ASKED_BITS = 22  # 2 to this power slots tell which pieces were asked for before
REMEMBERED_PAIRS = 2_000_000
SHORT = 64  # longer pieces are not remembered
MAX_VOCABULARY_BYTES = 64 << 20
_NEVER = 1 << 62


class Vocabulary:
    """Tokens by rank, and which two of them may stand side by side."""

    def __init__(self, file: bytes):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file.splitlines())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.lengths = {rank: len(token) for token, rank in self.ranks.items()}
        #: Every ending of a token, and its rank if it is a token itself.
        self.endings = {token[i:]: None for token in self.ranks for i in range(len(token))} | self.ranks
        self.known_pairs: dict[int, bool] = {}
        self._alone: dict[int, bool] = {}
        self._known_edges: dict[int, tuple] = {}

    def merged(self, data: bytes, trace: list[tuple[int, bytes, bytes]] | None = None) -> list[int]:
        """The definition: merge the adjacent pair of the lowest rank, the leftmost of equals, as long as there is one.

        ``trace`` gets, after each step, the rank merged, the first part and the last part.
        """
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            pairs = [ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(pairs)
            if best == _NEVER:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if trace is not None:
                trace.append((best, parts[0], parts[-1]))
        return [ranks[p] for p in parts]

    def _edges(self, token: int) -> tuple[tuple[int, ...], tuple[int, ...], bool]:
        """What stands first, and what last, while the token is merged, each ending with the token; and whether
        the ranks merged only rise, so that a part's rank tells when it comes into being.
        """
        known = self._known_edges.get(token)
        if known is None:
            data, trace = self.tokens[token], []
            self.merged(data, trace)
            first = dict.fromkeys([data[:1], *(f for _, f, _ in trace)])
            last = dict.fromkeys([data[-1:], *(x for _, _, x in trace)])
            rises = all(a[0] <= b[0] for a, b in zip(trace, trace[1:], strict=False))
            known = tuple(map(self.ranks.get, first)), tuple(map(self.ranks.get, last)), rises
            self._known_edges[token] = known
        return known

    def may_follow(self, pair: int) -> bool:
        """Whether the encoding of the two tokens' bytes (first << 32 | second) is these two tokens.

        It is not if, at some time, the parts on both sides of the border would merge before either of them
        merges with its own neighbour; at equal ranks the leftmost pair merges first.
        """
        first, second = pair >> 32, pair & 0xFFFFFFFF
        (_, left, rises), (right, _, rises_too) = self._edges(first), self._edges(second)
        tokens, rank_of = self.tokens, self.ranks.get
        if not (rises and rises_too):
            known = self.merged(tokens[first] + tokens[second]) == [first, second]
        else:
            i = j = 0
            while True:
                across = rank_of(tokens[left[i]] + tokens[right[j]], _NEVER)
                own = left[i + 1] if i + 1 < len(left) else _NEVER
                other = right[j + 1] if j + 1 < len(right) else _NEVER
                if across < own and across <= other:
                    known = False
                    break
                if own == other == _NEVER:
                    known = True
                    break
                if own <= other:
                    i += 1
                else:
                    j += 1
        if len(self.known_pairs) >= REMEMBERED_PAIRS:
            self.known_pairs.clear()
        self.known_pairs[pair] = known
        return known

    def stands_alone(self, token: int) -> bool:
        """Whether the encoding of the token's bytes is the token."""
        known = self._alone.get(token)
        if known is None:
            known = self._alone[token] = self.merged(self.tokens[token]) == [token]
        return known

    def extend(self, last: list[int], data: bytes, upto: int) -> None:
        """Appends the last tokens of the prefixes that are longer than ``last``, up to this length.

        Of a prefix's endings that are a token, exactly one may follow the last token of what stands before it.
        """
        endings, known_pairs = self.endings, self.known_pairs
        for end in range(len(last) + 1, upto + 1):
            start = end - 1
            while True:
                token = endings[data[start:end]]
                if token is not None:
                    if not start:
                        if self.stands_alone(token):
                            break
                    else:
                        pair = last[start - 1] << 32 | token
                        may = known_pairs.get(pair)
                        if may or may is None and self.may_follow(pair):
                            break
                start -= 1
            last.append(token)

    def ids(self, last: list[int]) -> list[int]:
        """The tokens of the whole, from the last tokens of its prefixes."""
        found, lengths, end = [], self.lengths, len(last)
        while end:
            token = last[end - 1]
            found.append(token)
            end -= lengths[token]
        found.reverse()
        return found


class Prefixes:
    """The last token of every prefix of a byte string. ``last[i]`` ends the encoding of the first i + 1 bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, data, []
        self._extend(len(data))

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(len(self.data))

    def _extend(self, upto: int) -> None:
        self.vocabulary.extend(self.last, self.data, upto)

    def replace(self, start: int, end: int, by: bytes) -> int:
        """Replaces bytes start to end. Returns how many positions behind the edit had to be worked out anew.

        A token depends on the stored ones of as many bytes before as the longest token has. Once that many
        agree in a row with those from before the edit, all that follow do.
        """
        old, agreed = self.last[end:], 0
        self.data = self.data[:start] + by + self.data[end:]
        del self.last[start:]
        self._extend(start + len(by))
        for i, token in enumerate(old):
            self._extend(start + len(by) + i + 1)
            agreed = agreed + 1 if self.last[-1] == token else 0
            if agreed >= self.vocabulary.longest:
                self.last += old[i + 1 :]
                return i + 1
        return len(old)

    def ids(self) -> list[int]:
        return self.vocabulary.ids(self.last)


class _Pieces(dict):
    """Packed ids of short pieces, remembered when they are asked for a second time: most pieces are never asked for again.

    When half of what may be remembered is there, it takes the place of the older half; what is asked for again moves back, so
    that frequent pieces stay and only those not seen for long are forgotten.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.older, self.asked = vocabulary, {}, bytearray(1 << ASKED_BITS)

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.pop(piece, None)
        if packed is None:
            data, last = piece.encode("utf-8", "surrogatepass"), []
            self.vocabulary.extend(last, data, len(data))
            packed = array("I", self.vocabulary.ids(last)).tobytes()
            slot = hash(piece) & len(self.asked) - 1
            if not self.asked[slot]:
                self.asked[slot] = 1
                return packed
        if len(piece) <= SHORT:
            if 2 * len(self) >= REMEMBERED_PIECES:
                self.older, self.asked = dict(self), bytearray(len(self.asked))
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    def __init__(self, file: bytes, pattern: str):
        self.vocabulary = Vocabulary(file)
        self.pieces = _Pieces(self.vocabulary)
        self.split = regex.compile(pattern).findall

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. A null text counts as empty."""
        return b"".join(map(self.pieces.__getitem__, self.split(text or "")))

    def decode(self, packed: bytes | None) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, array("I", packed or b"")))


@cache
def _codec(file: bytes, pattern: str) -> Codec:
    return Codec(file, pattern)


def read_vocabulary(path: str) -> bytes:
    """A rank file, read where the driver runs; its size is checked, as every executor gets it."""
    with open(path, "rb") as f:
        file = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(file) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary of more than {MAX_VOCABULARY_BYTES} bytes")
    return file


def _shared(spark: SparkSession, file: bytes, pattern: str):
    shared = spark.sparkContext.broadcast((file, pattern))
    return lambda: _codec(*shared.value)


def encode(docs: DataFrame, file: bytes, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """Adds ``ids``: the tokens of the whole text, packed as little-endian unsigned 32-bit integers.

    Each match of the pattern is encoded by itself; strings of special tokens are ordinary text. Null and
    empty texts have no ids. A column of that name is replaced; rows are independent of each other.
    """
    codec = _shared(docs.sparkSession, file, pattern)

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([codec().encode(x) for x in texts], dtype=object)

    return docs.withColumn(out, run(F.col(text_col).cast("string")))


def decode(encoded: DataFrame, file: bytes, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``decoded``: the bytes of packed ids; null ids have none. A column of that name is replaced."""
    codec = _shared(encoded.sparkSession, file, pattern)

    @F.pandas_udf("binary")
    def run(ids: pd.Series) -> pd.Series:
        return pd.Series([codec().decode(x) for x in ids], dtype=object)

    return encoded.withColumn(out, run(F.col(ids_col)))


def round_trip(
    docs: DataFrame, file: bytes, pattern: str, text_col: str = "text", ids_out: str = "ids", decoded_out: str = "decoded"
) -> DataFrame:
    """Adds what :func:`encode` and then :func:`decode` add, in one pass: texts cross to Python once, and one worker
    for each task holds the vocabulary and the pieces it has seen, not two that share them out by chance.
    """
    codec = _shared(docs.sparkSession, file, pattern)

    @F.pandas_udf("ids binary, decoded binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        ids = [codec().encode(x) for x in texts]
        decoded = [codec().decode(x) for x in ids]
        return pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(decoded, dtype=object)})

    both = docs.withColumn(decoded_out, run(F.col(text_col).cast("string")))
    return both.withColumn(ids_out, F.col(decoded_out)["ids"]).withColumn(decoded_out, F.col(decoded_out)["decoded"])


def unpack(packed: bytes) -> Iterable[int]:
    return np.frombuffer(packed, "<u4").tolist()

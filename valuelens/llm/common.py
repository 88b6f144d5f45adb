"""Helpers that several operators share."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.session import shared_folder

SHINGLE = 5
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes to the shared folder and reads again: cuts the lineage, and outlives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only doc_id and text, whatever else the table has."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that leaves no visible order (the finaliser of splitmix64)."""
    x = x + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def words(text: str | bytes | None) -> list[bytes]:
    """Lower-cases A-Z and splits at the six ASCII white-space characters, which is what bytes.split does."""
    if text is None:
        return []
    return (text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")).lower().split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_PRIMES = [np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)]
_WHOLE = 32  # bytes; words of so many or more are hashed one by one


def texts_word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ``word_hashes`` of all texts' ``words`` in a row, and where each text's begin and the last one's end."""
    data = b" ".join([b"", *texts]).lower() + bytes(16)
    codes = np.frombuffer(data, np.uint8)[:-16]
    edges = np.flatnonzero(np.diff(_IS_SPACE[codes], append=True))
    first, size = edges[::2] + 1, np.diff(edges)[::2]  # a text begins behind a space
    hashes = _xxh64(data, first, size)
    long = np.flatnonzero(size >= _WHOLE)
    hashes[long] = word_hashes([data[a : a + n] for a, n in zip(first[long].tolist(), size[long].tolist(), strict=True)])
    return hashes, np.searchsorted(first, np.cumsum([0, *(len(text) + 1 for text in texts)]))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def _xxh64(data: bytes, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxh64 without seed of the words that begin there, of fewer than ``_WHOLE`` bytes; others get some value."""
    p1, p2, p3, p4, p5 = _PRIMES
    eights = np.frombuffer(data, "<u8", len(data) // 8)
    h = size.astype(np.uint64) + p5

    def bytes_at(place: np.ndarray) -> np.ndarray:
        """Eight bytes from there on, or as many as there are."""
        at, off = place >> 3, (place << 3 & 63).astype(np.uint64)
        behind = eights[np.minimum(at + 1, len(eights) - 1)]
        return eights[at] >> off | behind << np.uint64(1) << (np.uint64(63) - off)

    for k in range(0, _WHOLE - 8, 8):
        some = np.flatnonzero((size >= k + 8) & (size < _WHOLE))
        h[some] = _turned(h[some] ^ _turned(bytes_at(first[some] + k) * p2, 31) * p1, 27) * p1 + p4
    some = np.flatnonzero(size & 4)
    part = bytes_at(first[some] + (size[some] & ~7)) & np.uint64(0xFFFFFFFF)
    h[some] = _turned(h[some] ^ part * p1, 23) * p2 + p3
    some = np.flatnonzero(size & 3)
    left, rest = size[some] & 3, bytes_at(first[some] + (size[some] & ~3))
    for k in range(3):
        more = left > k
        some, left, rest = some[more], left[more], rest[more]
        h[some] = _turned(h[some] ^ (rest >> np.uint64(8 * k) & np.uint64(255)) * p5, 11) * p1
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, size):
        total = total * _ODD + hashes[k : n + k]
    return mix(total)


def shingles(text: str | bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Distinct, sorted shingle hashes; with fewer words than ``size``, the whole sequence as one."""
    tokens = words(text)
    if not tokens:
        return np.empty(0, np.uint64)
    return np.unique(windows(word_hashes(tokens), min(size, len(tokens))))


#: A key with more than this share of all rows is hot; there are fewer such keys than its inverse.
HOT_KEYS = 10_000


def hot_join(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows joined (inner, null-safely) with ``facts``, which has one row per key and ``n``, the key's number of rows at least.

    Facts of hot keys are broadcast, fewer than ``HOT_KEYS`` of them whatever the input; the other keys meet
    in a shuffle, none of them with more than that share of the rows. Both tables are read twice: pass written ones.
    """
    total = facts.agg(F.sum("n")).first()[0] or 0
    facts = facts.select(*(F.col(k).alias(f"__{k}") for k in keys), *(c for c in facts.columns if c not in keys))
    hot = F.col("n") * HOT_KEYS > total
    same = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = equal if same is None else same & equal
    few, helped = F.broadcast(facts.where(hot)), [f"__{k}" for k in keys]
    many = rows.join(few.select(helped), same, "left_anti").join(facts.where(~hot), same)
    return rows.join(few, same).unionByName(many).drop("n", *helped)

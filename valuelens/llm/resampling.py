"""Importance resampling towards a target: documents whose features look like those of a benchmark are drawn more often.

Features are runs of one and two words. The words of a text are split by a pre-tokeniser, which gives their offsets;
each offset, and each pair of neighbouring offsets, is a window whose CRC names a bucket. Histograms of the buckets over
all documents and over the target give a gain per bucket; a document's weight is its windows' mean gain, to which Gumbel noise
is added, so that the highest scores are a draw without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from valuelens.llm.common import plain, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MIN_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
BLOCK_BYTES = 1 << 20  # of text that is split at a time
LONG_WORD = 64  # bytes; beyond it CRCs are made one by one
_SPLIT = Split(Regex(WORD), "removed", invert=True)


def _step(crc: np.ndarray) -> np.ndarray:
    """The CRC register after one zero byte."""
    return _BYTE[crc & 255] ^ (crc >> 8)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _shift_tables() -> np.ndarray:
    """By number of zero bytes, place of a byte in the register and its value: what it becomes."""
    tables = [np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
    for _ in range(LONG_WORD):
        tables.append(_step(tables[-1]))
    return np.stack(tables)


_BYTE = _byte_table()
_SHIFT = _shift_tables()
_SPACE = np.uint32(zlib.crc32(b" "))


def shifted(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """What must be added to the CRC of ``by`` bytes for that of the first text followed by them."""
    return (
        _SHIFT[by, 0, crc & 255] ^ _SHIFT[by, 1, crc >> 8 & 255] ^ _SHIFT[by, 2, crc >> 16 & 255] ^ _SHIFT[by, 3, crc >> 24]
    )


def word_offsets(data: bytes) -> np.ndarray:
    """Byte offsets (start, end) of the words of a lower-cased text."""
    text = data.decode("utf-8", "surrogatepass")
    found = [offsets for _, offsets in _SPLIT.pre_tokenize_str(text)]
    offsets = np.array(found, np.int64).reshape(-1, 2)
    if len(text) == len(data):
        return offsets
    starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80  # of characters
    return np.append(np.flatnonzero(starts), len(data))[offsets]


def _cuts(data: bytes) -> list[tuple[int, int]]:
    """Blocks of about BLOCK_BYTES that end behind a line or a space, so that no word is cut."""
    cuts = [0]
    while len(data) - cuts[-1] > BLOCK_BYTES:
        after = cuts[-1] + BLOCK_BYTES
        ends = [at for at in (data.find(b" ", after), data.find(b"\n", after)) if at >= 0]
        if not ends:
            break
        cuts.append(min(ends) + 1)
    return list(zip(cuts, [*cuts[1:], len(data)], strict=True))


def word_crcs(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """The CRC of each word, byte by byte for all words at once; long words one by one."""
    lengths = offsets[:, 1] - offsets[:, 0]
    order = np.argsort(-np.minimum(lengths, LONG_WORD + 1), kind="stable")
    order = order[lengths[order] <= LONG_WORD]
    crcs = np.full(len(offsets), 0xFFFFFFFF, np.uint32)
    starts, units = offsets[order, 0], np.frombuffer(data, np.uint8)
    left = len(order) - np.searchsorted(lengths[order][::-1], np.arange(LONG_WORD + 1), "right")  # longer than k
    sorted_crcs = crcs[order]
    for k in range(int(lengths[order[0]]) if len(order) else 0):
        n = left[k]
        here = sorted_crcs[:n]
        sorted_crcs[:n] = _BYTE[(here ^ units[starts[:n] + k]) & 255] ^ (here >> 8)
    crcs[order] = ~sorted_crcs
    for at in np.flatnonzero(lengths > LONG_WORD).tolist():
        crcs[at] = zlib.crc32(data[offsets[at, 0] : offsets[at, 1]])
    return crcs


def window_buckets(data: bytes, offsets: np.ndarray, crcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all single words, and of all pairs of neighbours: the words' bytes, joined by one space."""
    lengths = offsets[1:, 1] - offsets[1:, 0]
    before = shifted(crcs[:-1], np.ones(len(lengths), np.int64)) ^ _SPACE
    pairs = shifted(before, np.minimum(lengths, LONG_WORD)) ^ crcs[1:]
    for at in np.flatnonzero(lengths > LONG_WORD).tolist():
        pairs[at] = zlib.crc32(data[offsets[at + 1, 0] : offsets[at + 1, 1]], int(before[at]))
    return (crcs % BUCKETS).astype(np.uint16), (pairs % BUCKETS).astype(np.uint16)


def features(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """In groups of texts, from ``first`` up to ``last``: of each window the number of its text, its bucket, and whether it is a
    single word. A group has BLOCK_BYTES at most or is one longer text, which is split block by block, the last word
    being carried on to the next.
    """
    lowered = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    first = 0
    while first < len(lowered):
        last, size = first + 1, len(lowered[first])
        while last < len(lowered) and size + len(lowered[last]) < BLOCK_BYTES:
            size += len(lowered[last]) + 1
            last += 1
        data = b"\n".join(lowered[first:last])
        ends = np.cumsum([len(x) + 1 for x in lowered[first:last]])
        carried, parts = np.empty((0, 2), np.int64), []
        for low, high in _cuts(data):
            offsets = np.concatenate([carried, word_offsets(data[low:high]) + low])
            if not len(offsets):
                continue
            numbers = np.searchsorted(ends, offsets[:, 0], "right").astype(np.int32)
            single, pair = window_buckets(data, offsets, word_crcs(data, offsets))
            within, fresh = numbers[1:] == numbers[:-1], slice(len(carried), None)
            parts.append((numbers[fresh], single[fresh], np.ones(len(single[fresh]), bool)))
            parts.append((numbers[1:][within], pair[within], np.zeros(within.sum(), bool)))
            carried = offsets[-1:]
        none = (np.empty(0, np.int32), np.empty(0, np.uint16), np.empty(0, bool))
        yield (first, last, *(np.concatenate(c) for c in zip(*(parts or [none]), strict=True)))
        first = last


def bucketed(rows: DataFrame, name: str) -> DataFrame:
    """doc_id, n_words, buckets (16 bits each) of rows with doc_id and text: written, as splitting costs most by far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, numbers, buckets, single in features(batch.column(1).to_pylist()):
                n = last - first
                ends = 2 * np.cumsum(np.bincount(numbers, minlength=n))
                packed = buckets[np.argsort(numbers, kind="stable")].astype("<u2").tobytes()
                buffers = [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64).tobytes()), pa.py_buffer(packed)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(np.bincount(numbers[single], minlength=n)),
                        pa.Array.from_buffers(pa.large_binary(), n, buffers).cast(pa.binary()),
                    ],
                    names=["doc_id", "n_words", "buckets"],
                )

    return written(rows.mapInArrow(run, "doc_id long, n_words long, buckets binary"), name)


def histogram(rows: DataFrame) -> np.ndarray:
    """Windows of the whole table by bucket: summed in each task, then by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for buckets in batch.column(0):
                sums += np.bincount(np.frombuffer(buckets.as_buffer(), "<u2"), minlength=BUCKETS)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["bucket", "n"])

    found = rows.select("buckets").mapInArrow(count, "bucket long, n long")
    totals = np.zeros(BUCKETS, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket at most
        totals[r.bucket] = r.n
    return totals


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of how much likelier a bucket is in the target, floored."""
    s, t = float(corpus.sum()), float(target.sum())
    ratio = [(b + 1.0) * (s + BUCKETS) / ((a + 1.0) * (t + BUCKETS)) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weigh(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean gain of a row's buckets."""
    shared = rows.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(b.as_buffer(), "<u2") for b in batch.column(2)]
            weights = [int(shared.value[b].sum()) // len(b) if len(b) else 0 for b in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(b) for b in found], pa.int64()), pa.array(weights, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return rows.select("doc_id", "n_words", "buckets").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def scored(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """With ``score``: the weight and a floored Gumbel deviate that only the seed and the id decide."""
    noise = f"conv(substr(sha2(concat('{seed}:', coalesce(cast(doc_id AS string), '')), 256), 1, 8), 16, 10)"
    return weights.withColumn(
        "score", F.expr(f"weight + floor(-1000 * ln(-ln((cast({noise} AS double) + 0.5D) / 4294967296D)))")
    )


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """Adds ``rank`` by score (highest first), then id: 1 to ``drawn``, null beyond.

    Rows are sorted by ranges, never in one task, and written; a row's rank is its place within its range, behind the
    rows of the ranges before it. The driver sees nothing, and what is broadcast has a row per range.
    """
    sorted_rows = rows.orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    placed = written(sorted_rows.withColumn("__at", F.monotonically_increasing_id()), "sorted")
    ranges = placed.groupBy(F.expr("__at >> 33").alias("__range")).agg(F.count("*").alias("__n"))
    before = ranges.selectExpr(
        "__range", "coalesce(sum(__n) OVER (ORDER BY __range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS __before"
    )
    place = F.expr(f"__before + (__at & {(1 << 33) - 1}L) + 1")
    found = placed.withColumn("__range", F.expr("__at >> 33")).join(F.broadcast(before), "__range")
    return found.withColumn("rank", F.when(place <= drawn, place)).drop("__range", "__at", "__before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    seed: int = SEED,
    percent: int = DRAWN_PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank for every row; the drawn ones have a rank.

    Of the documents with at least ``min_words`` words, ``percent`` of a hundred are drawn, rounded down. Null and empty
    texts have no windows and weight 0. Rows without id share one deviate and come last among equals;
    rows that repeat an id share its deviate too, and of equal ones which is ranked first is open. An empty target has
    equal counts in all buckets; without documents there are no rows.
    """
    split = bucketed(plain(docs, id_col, text_col), "buckets")
    wanted = bucketed(target.select(F.lit(0).cast("long").alias("doc_id"), F.col(target_col).cast("string").alias("text")), "target")
    rows = written(scored(weigh(split, gains(histogram(split), histogram(wanted))), seed), "scored")
    enough = F.col("n_words") >= min_words
    drawn = rows.where(enough).count() * percent // 100
    others = rows.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked(rows.where(enough), drawn).unionByName(others)

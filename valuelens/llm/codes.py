"""Product-quantisation codes of vectors, in whole numbers.

A vector is cut into equal parts; each part is coded by the nearest entry of its position's codebook. The nearest entry
is found by bitmasks: of every dimension the entries' coordinates are sorted, and the k-th prefix mask has the bits of the k
least. An initial radius, the distance to a neighbour in one dimension, selects a range per dimension; the range's
entries are the difference of two prefix masks, and the AND over the dimensions leaves a set that holds every entry
within the radius. Only these are measured.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.common import hot_join, written

PARTS = 16
ENTRIES = 64  # a mask has so many bits
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 24  # of a whole component, so that no sum of squares overflows


class Masks:
    """One position's codebook, searched by slices of its sorted coordinates."""

    def __init__(self, codebook: np.ndarray):
        self.codebook = codebook
        self.order = np.argsort(codebook, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(codebook.T, self.order, axis=1)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        nothing = np.zeros((len(bits), 1), np.uint64)
        self.prefixes = np.concatenate([nothing, np.bitwise_or.accumulate(bits, axis=1)], axis=1)
        self.widest = int(np.argmax(self.sorted[:, -1] - self.sorted[:, 0]))

    def _distances(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        return ((points - self.codebook[entries]) ** 2).sum(axis=1)

    def radii(self, points: np.ndarray) -> np.ndarray:
        """No less than the distance to the nearest entry: that to the nearer neighbour in the widest dimension."""
        values, order = self.sorted[self.widest], self.order[self.widest]
        place = np.searchsorted(values, points[:, self.widest])
        below = self._distances(points, order[np.maximum(place - 1, 0)])
        above = self._distances(points, order[np.minimum(place, len(order) - 1)])
        return np.sqrt(np.minimum(below, above)).astype(np.int64) + 1

    def candidates(self, points: np.ndarray) -> np.ndarray:
        """A mask per point: all entries within its radius in every dimension."""
        reach = self.radii(points)
        masks = np.full(len(points), np.iinfo(np.uint64).max, np.uint64)
        for values, prefixes, x in zip(self.sorted, self.prefixes, points.T, strict=True):
            low, high = np.searchsorted(values, x - reach, "left"), np.searchsorted(values, x + reach, "right")
            masks &= prefixes[high] ^ prefixes[low]
        return masks

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, of equals the one with the lowest index, and its squared distance."""
        masks = self.candidates(points).astype("<u8").view(np.uint8).reshape(len(points), 8)
        rows, entries = np.nonzero(np.unpackbits(masks, axis=1, bitorder="little"))
        distances = self._distances(points[rows], entries)
        begins = np.flatnonzero(np.diff(rows, prepend=-1))
        least = np.minimum.reduceat(distances, begins) if len(begins) else distances
        best = np.flatnonzero(distances == least[rows])
        first = best[np.flatnonzero(np.diff(rows[best], prepend=-1))]
        return entries[first], least


@dataclass(frozen=True)
class Codebooks:
    """Whole components by position of the part, entry and place within the part."""

    entries: np.ndarray

    def assign(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes and squared distances by point and part."""
        parts = points.reshape(len(points), len(self.entries), -1)
        found = [Masks(book).nearest(parts[:, p]) for p, book in enumerate(self.entries)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def whole(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, point: floor(256 x) of every component, for vectors without null and non-finite ones."""
    point = f"transform(vector, x -> cast(floor(greatest(least(x * {SCALE}D, {LARGEST}D), -{LARGEST}D)) AS int))"
    return (
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(label_col).alias("label"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        )
        .where("vector IS NOT NULL AND forall(vector, x -> coalesce(abs(x) < double('Infinity'), false))")
        .selectExpr("vec_id", "label", f"{point} AS point")
    )


def _points(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def improved(points: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floored mean of the parts that are nearest to it; entries without any stay.

    Summed in each task, then by Spark: the driver gets a row for each number of the codebooks, whatever the input.
    """
    shared = points.sparkSession.sparkContext.broadcast(books)
    parts, n, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(parts * n, np.int64), np.zeros((parts * n, width), np.int64)
        for batch in batches:
            if batch.num_rows:
                found = _points(batch, 0)
                slots = (shared.value.assign(found)[0] + np.arange(parts) * n).ravel()
                counts += np.bincount(slots, minlength=parts * n)
                np.add.at(totals, slots, found.reshape(-1, width))
        used = np.repeat(np.flatnonzero(counts), width)
        place = np.tile(np.arange(width), len(used) // width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(place), pa.array(counts[used]), pa.array(totals[used, place])], names=["slot", "place", "n", "total"]
        )

    rows = points.select("point").mapInArrow(sums, "slot long, place long, n long, total long")
    entries = books.entries.reshape(parts * n, width).copy()
    for r in rows.groupBy("slot", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        entries[r.slot, r.place] = r.total // r.n
    return Codebooks(entries.reshape(parts, n, width))


def coded(points: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code, error."""
    shared = points.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                indexes, distances = shared.value.assign(_points(batch, 2))
                digits, size = indexes.astype(np.uint8).tobytes().hex(), 2 * indexes.shape[1]
                codes = [digits[i : i + size] for i in range(0, len(digits), size)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(distances.sum(axis=1))],
                    names=["vec_id", "label", "code", "error"],
                )

    label = points.schema["label"].dataType.simpleString()
    return points.select("vec_id", "label", "point").mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, Codebooks]:
    """vec_id, label, code, error, label_error for every vector that is kept, and the codebooks.

    Vectors that are null or hold null, NaN or infinite components are dropped. The vector with the smallest id sets the
    number of components; vectors of another length are dropped, and all of them if it is no multiple of the
    parts. Components beyond 65,536 count as that. Rows without id count as larger than all
    ids when the first entries are chosen, and equal ids go by label and vector. Repeated rows each have a code. Without
    vectors there are no rows, and the codebooks are empty.
    """
    everything = whole(vectors, id_col, vector_col, label_col)
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("label").cast("string").asc_nulls_first(), F.col("point")]
    first = everything.orderBy(by_id).select(F.size("point").alias("n")).first()
    size = first.n if first and first.n % PARTS == 0 else 0
    points = written(everything.where((F.size("point") == size) & (F.size("point") > 0)), "points")
    seeds = points.orderBy(by_id).limit(ENTRIES).collect()
    entries = np.array([r.point for r in seeds], np.int64).reshape(len(seeds), PARTS, -1 if seeds else 0)
    books = Codebooks(entries.transpose(1, 0, 2))
    if not seeds:
        return points.selectExpr("vec_id", "label", "'' AS code", "0L AS error", "0L AS label_error"), books
    for _ in range(ROUNDS):
        books = improved(points, books)
    rows = written(coded(points, books), "codes")
    labels = rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("error").alias("label_error"))
    return hot_join(rows, written(labels, "label-errors"), ["label"]).select("vec_id", "label", "code", "error", "label_error"), books

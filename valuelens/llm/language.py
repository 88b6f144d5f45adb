"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.common import mix

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
MAX_LANGUAGES = 256
UNKNOWN = "und"
BLOCK_TEXTS = 64  # that share a sparse product
BLOCK_CELLS = 1 << 19  # of it that are laid out at a time, unless one text has more
_DOCUMENTS = -1  # stands in the place of a bucket where documents are counted


@dataclass(frozen=True)
class Model:
    """``log_probs`` has a row per bucket and a column per language; 128 kB a language, so at most 32 MB."""

    languages: tuple[str, ...]
    log_probs: np.ndarray
    log_priors: np.ndarray


@cache
def _letters() -> np.ndarray:
    """By code point: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def buckets(text: str | None) -> np.ndarray:
    """The buckets of all character n-grams of the lower-cased text, every run of other characters than
    letters being one space. Empty if there is no letter.
    """
    if not text:
        return np.empty(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    before = np.concatenate(([False], letter[:-1]))
    points = np.where(letter, points, np.uint32(32))[letter | before].astype(np.uint64)
    found, total = [], np.zeros(len(points), np.uint64)
    for k in range(max(ORDERS)):
        n = len(points) - k
        if n <= 0:
            break
        total = (total[:n] << np.uint64(21)) | points[k:]
        if k + 1 in ORDERS:
            found.append((mix(total, k) & np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(found)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the task: a row for each language and bucket that occurs in it."""
    sums: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array((at - 1).astype(np.int32)), pa.array(counts[at])],
                names=["lang", "bucket", "n"],
            )
        sums.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            counts[1:] += np.bincount(buckets(text), minlength=BUCKETS)
            counts[_DOCUMENTS + 1] += 1
        if len(sums) > MAX_LANGUAGES:
            yield from rows()
    yield from rows()


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from every row whose language is not null.

    Counts are summed in each task and then by Spark; what reaches the driver has a row for each language and
    bucket. Null texts count for the prior only. No labelled rows: a model without languages.
    """
    rows = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    sums = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = sums.limit((BUCKETS + 1) * MAX_LANGUAGES + 1).toArrow()
    languages = sorted(pa.compute.unique(got["lang"]).to_pylist())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((BUCKETS + 1, len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    column = np.array([place[x] for x in got["lang"].to_pylist()], np.int64)
    counts[got["bucket"].to_numpy() + 1, column] = got["n"].to_numpy()
    grams = counts[1:] + SMOOTHING
    priors = counts[0] / max(1, counts[0].sum())
    return Model(
        tuple(languages),
        np.log(grams / grams.sum(axis=0)).astype(np.float32),
        np.log(np.maximum(priors, 1e-300)).astype(np.float32),
    )


@dataclass(frozen=True)
class Sparse:
    """The buckets of several texts and how often each occurs: those of text i from ``starts[i]`` up to ``starts[i + 1]``."""

    starts: np.ndarray
    bucket: np.ndarray
    n: np.ndarray

    @staticmethod
    def of(texts: list[str | None]) -> Sparse:
        starts, at, n = [0], [], []
        for text in texts:
            counts = np.bincount(buckets(text), minlength=BUCKETS)
            at.append(np.flatnonzero(counts))
            n.append(counts[at[-1]])
            starts.append(starts[-1] + len(at[-1]))
        none = [np.empty(0, np.int64)]
        return Sparse(np.array(starts), np.concatenate(at or none), np.concatenate(n or none))

    def blocks(self, rows: int) -> Iterator[tuple[int, int]]:
        """Texts from first up to last with so many rows together, or one text."""
        first, last = 0, len(self.starts) - 1
        while first < last:
            end = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + rows, "right")) - 1)
            yield first, end
            first = end


def scores(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Of each text the likeliest language (of equals, the first by name) and its probability.

    One sparse product for many texts: the rows of the matrix that occur, each times its count, summed by text. What is
    laid out at a time is bounded, whatever the texts and languages.
    """
    languages, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
    for start in range(0, len(texts) if model.languages else 0, BLOCK_TEXTS):
        found = Sparse.of(texts[start : start + BLOCK_TEXTS])
        for first, last in found.blocks(max(1, BLOCK_CELLS // len(model.languages))):
            low, high = found.starts[first], found.starts[last]
            own = np.flatnonzero(np.diff(found.starts[first : last + 1]))
            if not len(own):
                continue
            cells = model.log_probs[found.bucket[low:high]] * found.n[low:high, None].astype(np.float64)
            logs = np.add.reduceat(cells, found.starts[first + own] - low, axis=0) + model.log_priors
            at = start + first + own
            best[at] = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            for i, top in zip(at.tolist(), logs.argmax(axis=1).tolist(), strict=True):
                languages[i] = model.languages[top]
    return languages, best


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``; columns of these names are replaced.

    Nothing but the text is used. Null, empty and letterless texts are ``und`` with score 0, and so is
    everything if the model knows no language. Rows are independent: repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        languages, best = scores(shared.value, texts.tolist())
        return pd.DataFrame({"lang_pred": languages, "score": best})

    found = docs.drop("lang_pred", "score").withColumn("__found", predict(F.col(text_col).cast("string")))
    return found.select("*", "__found.lang_pred", "__found.score").drop("__found")

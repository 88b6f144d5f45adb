"""Benchmark decontamination by edit distance, counted in words.

A random walk (CGK) embeds a sequence of words into a longer one such that few edits become few differing
places. Windows of an item's size and the item are embedded alike; if they agree at a few sampled places, in one of
many repetitions, the edit distance of the window's surroundings and the item is worked out exactly.

Only windows around a shared piece are embedded: an item within k edits shares one of k + 1 pieces unchanged,
so that no match is lost by this.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.common import mix, plain, windows, word_hashes, words, written

MAX_EDITS_PERCENT = 20  # of the item's words
REPETITIONS = 24
SAMPLED = 3
BLOCK_WORDS = 2_000_000  # of the benchmark that one pass over the documents looks for; a longer item is its own block
_SPARSE = 64  # slots of a filter for each piece, so that few others pass
_PADDING = np.uint64(0)


def sampled_places(length: int) -> dict[int, np.ndarray]:
    """By place of an embedding, which is three times as long as the words: the repetitions that sample it."""
    chosen = defaultdict(list)
    for r in range(REPETITIONS):
        for place in np.random.default_rng((length, r)).choice(3 * length, min(SAMPLED, 3 * length), replace=False):
            chosen[int(place)].append(r)
    return {place: np.array(r) for place, r in chosen.items()}


def signatures(sequences: np.ndarray) -> np.ndarray:
    """For each row and repetition, a hash of the sampled places of the row's embedding.

    At every step the walk copies the word it stands at and then moves on or stays, as a random function of step,
    word and repetition says. Behind the last word it copies padding.
    """
    rows, length = sequences.shape
    chosen = sampled_places(length)
    padded = np.concatenate([sequences, np.full((rows, 1), _PADDING)], axis=1)
    at, every = np.zeros((rows, REPETITIONS), np.int64), np.arange(rows)[:, None]
    total, bit = np.zeros((rows, REPETITIONS), np.uint64), np.arange(REPETITIONS, dtype=np.uint64)
    for step in range(max(chosen) + 1):
        word = padded[every, at]
        if step in chosen:
            here = chosen[step]
            total[:, here] = mix(total[:, here] ^ word[:, here], step)
        at += (mix(word, step) >> bit & np.uint64(1)).astype(np.int64)
        np.minimum(at, length, out=at)
    return total


def nearest(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of the item to any run of words of the text, and that run's start and end.

    Of equal distances the leftmost end wins, then the longest run. A cell holds its distance in the upper half and the start of
    its run in the lower, so that the least cell is the least distance with the leftmost start; a row is worked out at once,
    as words that only the text has are a running minimum.
    """
    one = np.int64(1) << np.int64(32)
    steps = np.arange(len(text) + 1) * one
    above = np.arange(len(text) + 1, dtype=np.int64)
    for i, word in enumerate(item, 1):
        row = above + one
        row[0] = i * one
        np.minimum(row[1:], above[:-1] + np.where(text == word, np.int64(0), one), out=row[1:])
        above = np.minimum.accumulate(row - steps) + steps
    distances = above >> 32
    end = int(np.argmin(distances))
    return int(distances[end]), int(above[end] & (one - 1)), end


@dataclass
class Items:
    """A block of the benchmark: words, pieces by length, and signatures by length and repetition."""

    ids: list[int]
    hashes: list[np.ndarray]

    def __post_init__(self):
        self.edits = [len(h) * MAX_EDITS_PERCENT // 100 for h in self.hashes]
        self.pieces: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        by_length = defaultdict(list)
        for item, (hashes, edits) in enumerate(zip(self.hashes, self.edits, strict=True)):
            cuts = [len(hashes) * k // (edits + 1) for k in range(edits + 2)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                key = int(windows(hashes[start:end], end - start)[0])
                self.pieces[end - start][key].append((item, start))
            by_length[len(hashes)].append(item)
        self.sorted_pieces = {n: np.sort(np.fromiter(p, np.uint64, len(p))) for n, p in self.pieces.items()}
        self.filters = {}
        for n, keys in self.sorted_pieces.items():
            self.filters[n] = np.zeros(1 << (_SPARSE * len(keys)).bit_length(), bool)
            self.filters[n][(keys & np.uint64(len(self.filters[n]) - 1)).astype(np.int64)] = True
        self.signatures = {}
        for length, members in by_length.items():
            rows = np.stack([self.hashes[m] for m in members])
            known = self.signatures[length] = [defaultdict(list) for _ in range(REPETITIONS)]
            for item, row in zip(members, signatures(rows).tolist(), strict=True):
                for r, signature in enumerate(row):
                    known[r][signature].append(item)

    def near(self, hashes: np.ndarray) -> dict[int, set[int]]:
        """By item, the starts of windows around a piece that the text and the item share."""
        starts: dict[int, set[int]] = defaultdict(set)
        for n, keys in self.sorted_pieces.items():
            grams = windows(hashes, n)
            maybe = np.flatnonzero(self.filters[n][(grams & np.uint64(len(self.filters[n]) - 1)).astype(np.int64)])
            if not len(maybe):
                continue
            place = np.minimum(np.searchsorted(keys, grams[maybe]), len(keys) - 1)
            for at in maybe[keys[place] == grams[maybe]].tolist():
                for item, offset in self.pieces[n][int(grams[at])]:
                    starts[item].add(at - offset)
        return starts

    def windows_of(self, near: dict[int, set[int]], size: int) -> dict[int, np.ndarray]:
        """By item length, all starts at which a window may match; windows may reach over the text's ends."""
        wanted: dict[int, set[int]] = defaultdict(set)
        for item, starts in near.items():
            length, edits = len(self.hashes[item]), self.edits[item]
            for s in starts:
                wanted[length].update(range(max(s - edits, 0), min(s + edits, size - 1) + 1))
        return {length: np.array(sorted(s), np.int64) for length, s in wanted.items() if s}

    def candidates(self, hashes: np.ndarray, near: dict[int, set[int]]) -> dict[int, set[int]]:
        """By item, the starts of windows whose signature is the item's in some repetition."""
        found: dict[int, set[int]] = defaultdict(set)
        for length, starts in self.windows_of(near, len(hashes)).items():
            padded = np.concatenate([hashes, np.full(length, _PADDING)])
            rows = padded[starts[:, None] + np.arange(length)]
            for start, row in zip(starts.tolist(), signatures(rows).tolist(), strict=True):
                for known, signature in zip(self.signatures[length], row, strict=True):
                    for item in known.get(signature, ()):
                        found[item].add(start)
        return found

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """Item, first word, end and edit distance of the best match of each item found in the text."""
        hashes = word_hashes(words(text))
        near = self.near(hashes)
        if not near:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        for item, starts in self.candidates(hashes, near).items():
            length, edits = len(self.hashes[item]), self.edits[item]
            same = [s for s in starts if np.array_equal(hashes[s : s + length], self.hashes[item])]
            if same:
                best[item] = (0, min(same), min(same) + length)
                continue
            target, reach = self.hashes[item], 2 * edits
            merged: list[list[int]] = []
            for start in sorted(starts):
                low, high = max(0, start - reach), min(len(hashes), start + length + reach)
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = high
                else:
                    merged.append([low, high])
            for low, high in merged:
                distance, start, end = nearest(target, hashes[low:high])
                if distance <= edits:
                    best[item] = min(best.get(item, (1 << 62, 0, 0)), (distance, low + start, low + end))
        return sorted((self.ids[item], start, end, distance) for item, (distance, start, end) in best.items())


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """The items in blocks of bounded size, by id. Items that are null, without words or without id match nothing."""
    rows = benchmark.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).orderBy("doc_id", "text")
    ids, hashes, size = [], [], 0
    for row in rows.toLocalIterator():
        found = word_hashes(words(row.text))
        if ids and size + len(found) > BLOCK_WORDS:
            yield ids, hashes
            ids, hashes, size = [], [], 0
        if len(found):
            ids.append(row.doc_id)
            hashes.append(found)
            size += len(found)
    if ids:
        yield ids, hashes


_INDEX: dict[str, Items] = {}


def _index(name: str, shared) -> Items:
    """The index of a block, built once by each worker process."""
    if name not in _INDEX:
        _INDEX.clear()
        _INDEX[name] = Items(*shared.value)
    return _INDEX[name]


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, first_word, end_word, edits: the best match of each item in each document that has one.

    A match is a run of words within ``MAX_EDITS_PERCENT`` of the item's words in edits; words are compared with
    A-Z in lower case. The benchmark is the query set: it goes to the executors in blocks of ``BLOCK_WORDS``, each
    searched in all documents; with more than one block, each one's matches are written before the next is read, so that
    the driver holds one. Items of any length are looked for; one longer than a block is a block of its own. Null or
    empty documents and items match nothing, and neither does an empty table. Repeated documents give repeated rows; repeated items
    are found alike, each under its id. Other columns are not used, whatever their names. Documents are not shuffled at all.
    """
    schema = "doc_id long, item_id long, first_word long, end_word long, edits long"
    rows, spark = plain(docs, id_col, text_col), docs.sparkSession
    found = spark.createDataFrame([], schema)
    blocks = _blocks(plain(benchmark, item_col, item_text_col))
    block = next(blocks, None)
    while block is not None:
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            items = _index(name, shared)
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                got = [(i, *m) for i, text in zip(ids, texts, strict=True) for m in items.search(text)]
                columns = list(zip(*got, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", "item_id", "first_word", "end_word", "edits"],
                )

        matches, block = rows.mapInArrow(run, schema), next(blocks, None)
        if block is not None:
            matches = written(matches, "matches")
            shared.destroy()
        found = found.unionByName(matches)
    return found

"""Passages that repeat across documents, by compact windows.

A hash function orders the five-word shingles of a text; the Cartesian tree of these hashes groups all passages that
have the same least one: a node with its reach (left, place, right) stands for every passage that lies within the
reach and holds the place. Only reaches of a passage's length are kept, about 2 / length of all places.

Passages in two texts collide under a function if their windows have the same least shingle; shifted by the
distance of the two places, the windows' reaches must overlap by a passage. Collisions of a pair of texts at one shift,
or at two next to each other, under enough functions name a region, and the texts decide. Of the texts that meet under a key each is compared with
the first. Where that leaves a text uncovered, all passages of the key meet again, by a hash of the whole passage, so that one
that is held unchanged is always found, and by two anchors near its ends, so that copies with an edit between them find each other
behind texts that hold a part only.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.llm.common import SHINGLE, mix, plain, texts_word_hashes, windows, written

PASSAGE_WORDS = 50
PASSAGE = PASSAGE_WORDS - SHINGLE + 1  # in shingles
FUNCTIONS = 3
ENOUGH = 2
#: Of a passage's shingles so many must agree: as many as a Jaccard similarity of 0.8 takes.
AGREEING = -(-8 * PASSAGE // 9)
HALF = PASSAGE // 2
CHUNK_BITS = 12  # 2 to this power regions of a text may share one reading of it
BATCH_BYTES = 16 << 20  # of shingles that leave a task at a time
TEXTS_IN_MEMORY = 1 << 14  # whose lists of places a task gathers without sorting
GROUP_BYTES = 1 << 20  # of texts, or of shingles, that numpy goes through at once
#: Anchors are the least of so many shingles; two of them that lie so many steps apart stand for a passage.
ANCHOR_WINDOW = 6
ANCHORS_APART = (PASSAGE - 8, PASSAGE)
JACCARD_ROWS = 1 << 14  # passages whose sets are compared at once
MARGIN = 12  # shingles beyond them on either side that are compared
GRAM_BYTES = 3  # of a shingle that is compared with another at an equal place


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` values in a row, from minima of twice as many again and again."""
    least, wide = values, 1
    while 2 * wide <= size:
        least, wide = np.minimum(least[:-wide], least[wide:]), 2 * wide
    more = size - wide
    return np.minimum(least[: len(least) - more], least[more:]) if more else least


def least_places(values: np.ndarray, size: int) -> np.ndarray:
    """Places of values that are the least of some ``size`` in a row, equal ones included."""
    if len(values) < size:
        return np.empty(0, np.int64)
    edge = np.full(size - 1, ~values.dtype.type(0))
    return np.flatnonzero(~sliding_minimum(np.concatenate([edge, ~sliding_minimum(values, size), edge]), size) == values)


def compact_windows(values: np.ndarray, size: int) -> np.ndarray:
    """(left, place, right) of all Cartesian-tree nodes with a reach of ``size`` or more; the leftmost of equals wins.

    Such a node is the least of some ``size`` values in a row, and so are all nodes above it; so the tree of these
    places alone has the same reaches.
    """
    places = least_places(values, size)
    heights = values[places].tolist()
    left, right = [0] * len(places), [len(values) - 1] * len(places)
    stack: list[int] = []
    at = places.tolist()
    for i, height in enumerate(heights):
        while stack and heights[stack[-1]] > height:
            right[stack.pop()] = at[i] - 1
        left[i] = at[stack[-1]] + 1 if stack else 0
        stack.append(i)
    found = np.array([left, at, right], np.int64).T
    return found[found[:, 2] - found[:, 0] + 1 >= size]


def groups(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Rows in a row, of ``most`` together or one that is larger."""
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield slice(first, last)
        first = last


@dataclass
class Shingled:
    """Shingles of several texts in a row, one at the place of each word: those that would reach into the next text are ``outside``."""

    grams: np.ndarray
    outside: np.ndarray
    owner: np.ndarray  # the text of each place
    starts: np.ndarray  # of the texts
    sizes: np.ndarray  # shingles of each text; none or less if it has too few words

    @staticmethod
    def of(texts: list[bytes]) -> Shingled:
        hashes, ends = texts_word_hashes(texts)
        grams = windows(np.concatenate([hashes, np.zeros(SHINGLE - 1, np.uint64)]), SHINGLE)
        owner = np.repeat(np.arange(len(texts)), np.diff(ends))
        outside = np.arange(SHINGLE, len(grams) + SHINGLE) > ends[1:][owner]
        return Shingled(grams, outside, owner, ends[:-1], np.diff(ends) - SHINGLE + 1)


def _once(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """Without rows whose first columns repeat those of an earlier one of this task."""
    seen: set[tuple] = set()
    for batch in batches:
        new = []
        for key in zip(*(batch.column(c).to_pylist() for c in range(n_keys)), strict=True):
            new.append(key not in seen)
            seen.add(key)
        yield batch if all(new) else batch.filter(pa.array(new, pa.bool_()))


def _shingled(texts: pa.Array) -> Iterator[tuple[slice, Shingled]]:
    texts = texts.cast(pa.binary())
    for rows in groups(pc.binary_length(texts).to_numpy(zero_copy_only=False), GROUP_BYTES):
        yield rows, Shingled.of(texts[rows.start : rows.stop].to_pylist())


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window, by its least shingle; and of one function, for each side of its place that has room
    for half a passage, by the shingles of that half.

    Two equal passages around one place have the longer side of it in common, so that they meet by that half even
    where the least shingle is a phrase that many texts hold. Such a meeting is enough by itself.

    Rows are narrow, as there are many: the last three bits of a key are its function's number, ``at`` is the text's hash
    and the place, ``reach`` the steps to the left and to the right, 32 bits each.
    """
    for batch in batches:
        doc_ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
        for rows, texts in _shingled(batch.column(2)):
            out: list[tuple] = []
            halves = windows(texts.grams, HALF + 1)
            for function in range(FUNCTIONS):
                values = mix(texts.grams, function)
                values[texts.outside] = 0  # less than any, so that nothing reaches over a text's end
                found = compact_windows(values, PASSAGE)
                left, place, right = found[~texts.outside[found[:, 1]]].T
                meetings = [(function, mix(texts.grams[place], function + 10), np.ones(len(place), bool))]
                if function == 0:
                    for side, start, room in ((0, place, right - place), (1, place - HALF, place - left)):
                        fits = room >= HALF
                        meetings.append((FUNCTIONS + side, mix(halves[start[fits]], side + 20), fits))
                for number, keys, fits in meetings:
                    numbered = (keys & ~np.uint64(7) | np.uint64(number)).view(np.int64)
                    here, before, behind = place[fits], (place - left)[fits], (right - place)[fits]
                    owner = texts.owner[here]
                    at = hashes[rows][owner] << 32 | here - texts.starts[owner]
                    out.append((numbered, doc_ids[rows][owner], at, before << 32 | behind))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], names=["key", "doc_id", "at", "reach"]
            )


def _collisions(rows: DataFrame) -> DataFrame:
    """Each window with the first one of its key: those of another document, and of the halves' keys all.

    The window function only looks back, so that a key's rows are never held together; and a key's rows make
    one pair each, not all pairs.
    """
    found = rows.mapInArrow(_window_rows, "key long, doc_id long, at long, reach long")
    line = "PARTITION BY key ORDER BY doc_id, at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    first = found.selectExpr(
        "*",
        *(f"first({c}) OVER ({line}) AS {other}" for c, other in (("doc_id", "other_id"), ("at", "other_at"), ("reach", "other_reach"))),
        f"row_number() OVER ({line}) > 2 AS third",
    )
    meets = f"other_id <> doc_id AND {_overlap('least')} + 1 >= {PASSAGE}"
    return first.where(f"{meets} OR key & 7 >= {FUNCTIONS} AND (other_id <> doc_id OR other_at <> at)")


def _overlap(least: str) -> str:
    return " + ".join(f"{least}({_part(part, '')}, {_part(part, 'other_')})" for part in ("left", "right"))


def _part(part: str, side: str) -> str:
    """The place of a packed window, or its steps to the left or to the right."""
    packed = {"place": "{0}at & 4294967295L", "left": "{0}reach >> 32", "right": "{0}reach & 4294967295L"}[part]
    return f"cast({packed.format(side)} AS int)"


def _shifted(collisions: DataFrame) -> DataFrame:
    """Collisions of two documents whose windows overlap by a passage, as pair, shift and overlap."""
    place, other = _part("place", ""), _part("place", "other_")
    low, high = (f"least({_part(part, '')}, {_part(part, 'other_')})" for part in ("left", "right"))
    return collisions.where("other_id <> doc_id").selectExpr(
        "doc_id", "cast(at >> 32 AS int) AS text_hash", "other_id", "cast(other_at >> 32 AS int) AS other_hash",
        "cast(key & 7 AS int) AS function", f"{place} - {other} AS shift", f"{place} - {low} AS low", f"{place} + {high} AS high",
    ).where(f"high - low + 1 >= {PASSAGE}")


def _regions(collisions: DataFrame) -> DataFrame:
    """Per pair of texts and shift, spans of windows that overlap by a passage and meet under enough functions.

    Windows are merged in order of their start (an interval join of a pair's windows with each other). A word that one
    text has more shifts what follows by one: spans with too few functions of their own count those of spans
    at the next shift that overlap them. One exchange, by the pair, serves all steps.
    """
    texts = ["doc_id", "text_hash", "other_id", "other_hash"]
    pair = "PARTITION BY doc_id, text_hash, other_id, other_hash"

    def islands(rows: DataFrame, by: str, order: str, overlap: int) -> DataFrame:
        before = f"max(high) OVER ({pair}, {by} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        number = f"sum(begins) OVER ({pair}, {by} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        return (
            rows.selectExpr("*", f"{before} AS reached")
            .selectExpr("*", f"if(reached - low + 1 >= {overlap}, 0, 1) AS begins")
            .selectExpr("*", f"{number} AS island")
        )

    spans = (
        islands(collisions.repartition(*texts), "shift", "low, high, function", PASSAGE)
        .groupBy(*texts, "shift", "island")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.expr("bit_or(shiftleft(1, function))").alias("functions"))
        .drop("island")
        .withColumn("enough", (F.bit_count("functions") >= ENOUGH) | (F.col("functions") >= 1 << FUNCTIONS))
        .selectExpr("*", "explode(if(enough, array(cast(NULL AS int)), array(shift, shift + 1))) AS band")
    )
    near = f"bit_count(bit_or(functions) OVER ({pair}, band, island)) AS near"
    return (
        islands(spans, "band", "low, high, shift", PASSAGE - 1)
        .selectExpr("*", near)
        .where(f"enough OR near >= {ENOUGH}")
        .select(*texts, "shift", "low", "high")
        .distinct()
    )


def _slices(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """Both texts' shingles in each region, from one join of texts and regions; the other's with one more at both ends, zero
    beyond the text. 24 bits of each are enough, as they are only compared at near places, and most of a passage has to agree.
    """
    number = written(regions.withColumn("region", F.monotonically_increasing_id()), "regions")
    sides = number.select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "region", F.lit(0).alias("side"), "low", "high"
    ).union(
        number.select("other_id", "other_hash", "region", F.lit(1), F.col("low") - F.col("shift") - 1, F.col("high") - F.col("shift") + 1)
    )
    # A chunk holds 2^CHUNK_BITS sides at most, however many a text has.
    chunk = f"(row_number() OVER (PARTITION BY id, hash ORDER BY region, side) - 1) >> {CHUNK_BITS} AS chunk"
    chunks = sides.selectExpr("*", chunk).groupBy("id", "hash", "chunk").agg(
        F.collect_list(F.struct("region", "side", "low", "high")).alias("sides")
    )
    own = (F.col("doc_id") == F.col("id")) & (F.col("text_hash") == F.col("hash"))
    # A task cuts rows that repeat a text once; where two tasks do, the same shingles come twice.
    texts = rows.join(chunks, own).select("doc_id", "text_hash", "chunk", "text", "sides")

    def sliced(region: pa.Array, side: pa.Array, done: int, parts: list[bytes]) -> pa.RecordBatch:
        n = len(parts)
        return pa.RecordBatch.from_arrays(
            [region.slice(done, n), side.slice(done, n), pa.array(parts, pa.binary())], names=["region", "side", "grams"]
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _once(batches, 3):
            for rows, shingled in _shingled(batch.column(3)):
                own = batch.column(4).slice(rows.start, rows.stop - rows.start)
                region, side, low, high = own.flatten().flatten()
                text = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy())
                low, behind, n = low.to_numpy().astype(np.int64), high.to_numpy().astype(np.int64) + 1, shingled.sizes[text]
                first, last = (GRAM_BYTES * (shingled.starts[text] + np.clip(x, 0, n)) for x in (low, behind))
                before, after = GRAM_BYTES * np.maximum(-low, 0), GRAM_BYTES * np.maximum(behind - n, 0)
                grams = shingled.grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES].tobytes()
                parts, size, done = [], 0, 0
                for start, end, zeros, more in zip(first.tolist(), last.tolist(), before.tolist(), after.tolist(), strict=True):
                    parts.append(bytes(zeros) + grams[start:end] + bytes(more))
                    size += len(parts[-1])
                    if size >= BATCH_BYTES:
                        yield sliced(region, side, done, parts)
                        done, parts, size = done + len(parts), [], 0
                yield sliced(region, side, done, parts)

    cuts = texts.mapInArrow(cut, "region long, side int, grams binary")
    both = cuts.groupBy("region").agg(
        *(F.max(F.when(F.col("side") == side, F.col("grams"))).alias(name) for side, name in ((0, "mine"), (1, "theirs")))
    )
    return number.join(both, "region")


def _values(grams: list[bytes]) -> np.ndarray:
    parts = np.frombuffer(b"".join(grams), np.uint8).reshape(-1, GRAM_BYTES).astype(np.int32)
    return parts[:, 0] | parts[:, 1] << 8 | parts[:, 2] << 16


def agreeing_passages(ours: np.ndarray, others: np.ndarray, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts of our passages that agree with one of the other text, and by how many words its start is ahead of its place.

    A passage agrees where enough shingles are equal place by place, or else where the sets of its shingles and of
    those of a passage at most one word ahead or behind have a Jaccard similarity of 0.8. One word more on one
    side takes four shingles of the other and five of its own, of 46 each; two take too many.

    With ``sizes`` these are several regions in a row, of so many of our shingles each; the other text's have two more.
    """
    sizes = np.array([len(ours)]) if sizes is None else sizes
    ends = np.cumsum(sizes)
    region = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(np.arange(PASSAGE, len(ours) + PASSAGE) <= ends[region])
    # equal[e][i]: our shingle i is the other's at i - (e - 1)
    there = np.arange(len(ours)) + 2 * region
    equal = [ours == others[there + 2 - e] for e in range(3)]
    good, ahead = _counted(equal[1], starts, 0, PASSAGE) >= AGREEING, np.zeros(len(starts), np.int64)
    up_to = [equal[0], equal[0] | equal[1], equal[0] | equal[1] | equal[2]]
    from_ = [up_to[2], equal[1] | equal[2], equal[2]]
    # At most so many shingles are shared: of the places 2 to PASSAGE - 3 of each passage, and at the ends only what lies within
    # the other's passage.
    inner = _counted(up_to[2], starts, 2, PASSAGE - 2)
    maybe = np.flatnonzero(~good & (inner + 4 >= AGREEING))
    for d in range(3):
        maybe = maybe[~good[maybe]]
        s = starts[maybe]
        shared = inner[maybe] + up_to[d][s] + up_to[min(d + 1, 2)][s + 1]
        shared = shared + from_[d][s + PASSAGE - 1] + from_[max(d - 1, 0)][s + PASSAGE - 2]
        asked = maybe[shared >= AGREEING]
        for k in range(0, len(asked), JACCARD_ROWS):
            some = asked[k : k + JACCARD_ROWS]
            mine = starts[some]
            alike = _jaccard(ours, mine, others, there[mine] + 2 - d)
            good[some[alike]], ahead[some[alike]] = True, d - 1
    return starts[good], ahead[good]


def _counted(flags: np.ndarray, starts: np.ndarray, low: int, high: int) -> np.ndarray:
    """How many of the flags from low to before high steps behind each start are set."""
    counts = np.concatenate(([0], np.cumsum(flags)))
    return counts[starts + high] - counts[starts + low]


def _jaccard(ours: np.ndarray, mine: np.ndarray, others: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Whether the passages that start there have a Jaccard similarity of 0.8, as sets of shingles."""
    places = np.arange(PASSAGE)
    both = np.concatenate([ours[mine[:, None] + places], others[theirs[:, None] + places]], axis=1)
    n_mine, n_theirs, union = (
        (np.diff(np.sort(x, axis=1), axis=1) != 0).sum(axis=1) + 1 for x in (both[:, :PASSAGE], both[:, PASSAGE:], both)
    )
    return 5 * (n_mine + n_theirs - union) >= 4 * union


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal runs of words, from first to behind the last, that are covered by passages which agree."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(5)).to_numpy(zero_copy_only=False).astype(np.int64)
        for rows in groups(sizes, GROUP_BYTES):
            part = batch.slice(rows.start, rows.stop - rows.start)
            doc_id, text_hash, other_id, low, shift = (part.column(c).to_numpy() for c in range(5))
            n = sizes[rows] // GRAM_BYTES
            good, ahead = agreeing_passages(*(_values(part.column(c).to_pylist()) for c in (5, 6)), n)
            region = np.searchsorted(np.cumsum(n), good, "right")
            begins = np.diff(good, prepend=-PASSAGE_WORDS - 1) > PASSAGE_WORDS
            begins |= np.diff(region, prepend=-1) != 0
            first = np.flatnonzero(begins)
            last = np.append(first[1:] - 1, len(good) - 1)[: len(first)]
            own = region[first]
            start = low[own] + good[first] - (np.cumsum(n) - n)[own]
            columns = [doc_id[own], text_hash[own], start, start + good[last] - good[first] + PASSAGE_WORDS, other_id[own], start - shift[own] - ahead[first]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "text_hash", "first_word", "end_word", "other_id", "other_first_word"],
            )


def _beyond_first(rows: DataFrame, collisions: DataFrame, runs: DataFrame) -> DataFrame:
    """What later texts of a key share with each other, whatever the first text of the key holds.

    Of keys with a window that no verified run covers, all windows' passages meet again, by two kinds of keys: a hash of the
    whole passage, and of two anchors about a passage apart, with anything between them. Every passage has one least place and one
    longer side of it, so that it belongs to one window of a half's key, and equal passages to one key: one that is held
    unchanged is always found. A text that holds a part of a passage only does not hold both its ends; so copies that differ
    between their ends meet copies, and the texts decide. Each row meets the first of its key: one row for each passage or pair of
    anchors, not for each pair of texts. A key's second window has only the first before it, and was
    compared with that; so keys are asked for by their third and later ones.
    """
    # The passages of a window, by their start; of a half's window, those that hold the half too.
    place, left, right, kind = _part("place", ""), _part("left", ""), _part("right", ""), f"(key & 7) - {FUNCTIONS}"
    spans = (
        "key", "doc_id", "cast(at >> 32 AS int) AS text_hash",
        f"{place} - if({kind} = 0, least({left}, {PASSAGE - 1 - HALF}), least({left}, {PASSAGE - 1})) AS low",
        f"{place} + if({kind} = 1, least(-{HALF}, {right} - {PASSAGE - 1}), least(0, {right} - {PASSAGE - 1})) AS high",
    )
    members = collisions.selectExpr(*spans, "third").where("low <= high")
    heads = collisions.selectExpr("key", "other_id AS doc_id", "other_at AS at", "other_reach AS reach").distinct()
    covered = runs.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "first_word", "end_word")
    within = (F.col("first_word") <= F.col("low")) & (F.col("end_word") >= F.col("high") + PASSAGE_WORDS)
    own = (F.col("doc_id") == F.col("id")) & (F.col("text_hash") == F.col("hash"))
    keys = members.where("third").join(covered, own & within, "left_anti").select("key").distinct()
    wanted = members.drop("third").unionByName(heads.selectExpr(*spans).where("low <= high")).join(keys, "key", "left_semi")
    # The highest bit tells the windows of halves, which alone have to be gone through passage by passage.
    ranges = wanted.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(
        F.expr(f"collect_list(if(key & 7 >= {FUNCTIONS}, {1 << 62}L, 0L) | cast(low AS long) << 32 | high)").alias("ranges")
    )
    texts = rows.join(ranges, own).select("doc_id", "text_hash", "text", "ranges")
    line = "PARTITION BY again ORDER BY doc_id, at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    met = texts.mapInArrow(_again_rows, "again long, doc_id long, at long, span int, last int").selectExpr(
        "*", *(f"first({c}) OVER ({line}) AS {other}" for c, other in (("doc_id", "other_id"), ("at", "other_at"), ("last", "other_last")))
    )
    pairs = written(
        met.where("other_id <> doc_id").selectExpr(
            "doc_id", "cast(at >> 32 AS int) AS text_hash", "other_id", "cast(other_at >> 32 AS int) AS other_hash",
            f"{place} - {_part('place', 'other_')} AS shift", f"{place} AS place", "span", "last", "other_last",
        ),
        "again",
    )
    # Passages next to each other in both texts have the same number less their rank; rows may repeat a text.
    line = "PARTITION BY doc_id, text_hash, other_id, other_hash, shift ORDER BY place"
    merged = pairs.where("span = 0").selectExpr("*", f"place - dense_rank() OVER ({line}) AS line").groupBy(
        "doc_id", "text_hash", "other_id", "other_hash", "shift", "line"
    ).agg(F.min("place").alias("low"), F.max("place").alias("high"))
    unchanged = merged.selectExpr(
        "doc_id", "cast(low AS long) AS first_word", f"cast(high + {PASSAGE_WORDS} AS long) AS end_word",
        "other_id", "cast(low - shift AS long) AS other_first_word",
    )
    # Around two anchors, as far as a passage that holds both may reach, and both texts do.
    regions = pairs.where("span > 0").selectExpr(
        "doc_id", "text_hash", "other_id", "other_hash", f"{FUNCTIONS} AS function", "shift",
        f"greatest(0, shift, place - {MARGIN}) AS low", f"least(place + span + {MARGIN}, last, other_last + shift) AS high",
    ).where(f"high - low + 1 >= {PASSAGE}")
    changed = _runs(rows, _regions(regions), "changed")
    return unchanged.unionByName(changed.drop("text_hash"))


def anchors(grams: np.ndarray, outside: np.ndarray | None = None) -> np.ndarray:
    """Places of shingles that are the least of some ``ANCHOR_WINDOW`` in a row: texts that share these share the anchor."""
    values = mix(grams, 30)
    if outside is not None:
        values[outside] = 0  # less than any
    return least_places(values, ANCHOR_WINDOW)


def anchor_pairs(grams: np.ndarray, places: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Each place with the least of the shingles from low to high steps behind it, where the text goes that far: one pair for each
    place, and the same one in texts that agree there."""
    places = places[places + high < len(grams)]
    if not len(places):
        return places, places
    behind = places[:, None] + np.arange(low, high + 1)
    return places, behind[np.arange(len(places)), np.argmin(mix(grams, 30)[behind], axis=1)]


def _again_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of each passage that starts within the ranges, and of the pairs of anchors in these passages, with their places."""
    least, most = ANCHORS_APART
    for batch in _once(batches, 2):
        doc_ids, hashes, ranges = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64), batch.column(3)
        for rows, texts in _shingled(batch.column(2)):
            own = ranges.slice(rows.start, rows.stop - rows.start)
            spans, counts = own.flatten().to_numpy(), own.value_lengths().to_numpy()
            start = np.repeat(texts.starts, counts)
            low, behind, halves = start + (spans >> 32 & 0x3FFFFFFF), start + (spans & 0xFFFFFFFF) + 1, spans >> 62 != 0
            at = np.flatnonzero(_within(low[halves], behind[halves], len(texts.grams)))
            inside = np.concatenate(([0], np.cumsum(_within(low, behind + PASSAGE - 1, len(texts.grams)))))
            left = anchors(texts.grams, texts.outside)
            # With all that lies between them; first those that have room for the nearer end.
            left = left[left + most < (texts.starts + texts.sizes)[texts.owner[left]]]
            left = left[inside[left + least + 1] - inside[left] == least + 1]
            left, right = anchor_pairs(texts.grams, left, least, most)
            both = inside[right + 1] - inside[left] == right + 1 - left
            left, right = left[both], right[both]
            again = np.concatenate([windows(texts.grams, PASSAGE)[at], mix(mix(texts.grams[left], 31) + texts.grams[right], 32)])
            place = np.concatenate([at, left])
            owner = texts.owner[place]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(again.view(np.int64)),
                    pa.array(doc_ids[rows][owner]),
                    pa.array(hashes[rows][owner] << 32 | place - texts.starts[owner]),
                    pa.array(np.concatenate([np.zeros(len(at), np.int64), right - left]).astype(np.int32)),
                    pa.array((texts.sizes - 1)[owner].astype(np.int32)),
                ],
                names=["again", "doc_id", "at", "span", "last"],
            )


def _within(low: np.ndarray, behind: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in a range, from low to before behind."""
    return np.cumsum(np.bincount(low, minlength=n + 1)[:n] - np.bincount(behind, minlength=n + 1)[:n]) > 0


def _runs(rows: DataFrame, regions: DataFrame, name: str) -> DataFrame:
    """What the texts say about the regions: verified runs, written."""
    cut = _slices(rows, regions).select(
        "doc_id", F.col("text_hash").cast("long"), "other_id", F.col("low").cast("long"), F.col("shift").cast("long"), "mine", "theirs"
    )
    schema = "doc_id long, text_hash long, first_word long, end_word long, other_id long, other_first_word long"
    return written(cut.mapInArrow(_verified, schema), name)


@contextmanager
def _gathering(spark: SparkSession) -> Iterator[None]:
    """Meanwhile tasks gather lists of more texts before they go on by sorting."""
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(TEXTS_IN_MEMORY))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, first_word, end_word, other_id, other_first_word: passages of ``PASSAGE_WORDS`` or more that another document holds
    too, with the place in the first document (by id) that it was compared with.

    A run is reported where passages share enough shingles for a Jaccard similarity of 0.8 (A-Z in lower case), at equal
    places or with one word inserted or deleted between them. Repeats within one document do not count. Texts that are null or have fewer words, and
    documents without id, have none. Rows that repeat an id count as one document; of equal rows one counts.
    """
    rows = plain(docs, id_col, text_col).where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("text_hash", F.hash("text"))
    collisions = written(_collisions(rows.select("doc_id", "text_hash", "text")), "collisions")
    with _gathering(docs.sparkSession):  # all lists are gathered before something is written
        runs = _runs(rows, _regions(_shifted(collisions)), "runs")
        more = _beyond_first(rows, collisions, runs)
    return runs.drop("text_hash").unionByName(more).distinct()

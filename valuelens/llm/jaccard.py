"""Exact Jaccard join of shingle sets by vertical partitioning.

All shingles have one global order, frequent ones last. The order is cut into fragments; a pair's overlap is counted in
each fragment by itself and summed per pair. Pairs to be counted come from the head of the order: two sets
that are similar enough share one of their first shingles.

Texts with equal sets are one node. Within a group of nodes that share a first shingle, each is compared with the
group's first node; then all nodes of the group that are still in different components are held against each other
by the outlines of their sets, and compared if these leave a chance. So no link between components is lost, and
copies are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuelens.llm.common import mix, plain, shingles, written
from valuelens.llm.components import components

PERCENT = 80
FRAGMENTS = 8
COUNTERS = 1 << 18  # of the sketch of shingle frequencies; its size does not depend on the input
SIGMAS = 6
FILTER_BITS = 1 << 22
CELLS = 256, 1 << 16  # of a set's outline: at least, and at most
SMALL = 64  # members of a group whose pairs are counted rather than outlined
BLOCK = 1024  # nodes of a group that are compared with as many others at a time
_SIMILAR = f"100 * shared >= {PERCENT} * (n_a + n_b - shared)"
#: Of two sets with ``head`` common shingles in their heads, no more can be common than these and the longer tail.
_REACHES = f"""head + greatest(({PERCENT} * n_a + 99) div 100, ({PERCENT} * n_b + 99) div 100) - 1
    >= ({PERCENT} * (n_a + n_b) + 99 + {PERCENT}) div (100 + {PERCENT})"""
_SIZES = f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)"


def fingerprint(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's set size and fingerprint; at the end, the task's frequencies by counter."""
    sketch = np.zeros(COUNTERS, np.int64)
    none = lambda n, kind: pa.nulls(n, kind)
    names = ["doc_id", "n", "print", "counter", "frequency"]
    for batch in batches:
        sets = [shingles(x) for x in batch.column(1).cast(pa.binary()).to_pylist()]
        if sets:
            slots = (np.concatenate(sets) & np.uint64(COUNTERS - 1)).astype(np.int64)
            sketch += np.bincount(slots, minlength=COUNTERS)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(map(len, sets), pa.int64()),
                pa.array(map(fingerprint, sets), pa.binary()),
                none(len(sets), pa.int32()),
                none(len(sets), pa.int64()),
            ],
            names=names,
        )
    used = np.flatnonzero(sketch)
    yield pa.RecordBatch.from_arrays(
        [
            *(none(len(used), kind) for kind in (pa.int64(), pa.int64(), pa.binary())),
            pa.array(used.astype(np.int32)),
            pa.array(sketch[used]),
        ],
        names=names,
    )


def outline(values: np.ndarray) -> bytes:
    """How many shingles fall in each cell; 255 stands for as many or more. Cells hold two to four on average, or fewer."""
    width = CELLS[0]
    while width * 4 < len(values) and width < CELLS[1]:
        width *= 2
    cells = np.bincount((mix(values, 3) & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.minimum(cells, 255).astype(np.uint8).tobytes()


def _folded(cells: np.ndarray, width: int) -> np.ndarray:
    """Outlines, one in a row, with as many cells as this."""
    if cells.shape[1] == width:
        return cells
    return cells.reshape(len(cells), -1, width).sum(axis=1, dtype=np.uint32)


def _least_sums(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Of one outline and others: the sums of the lesser counts of all cells. No more shingles can be common, unless
    counts stop at 255 in both.
    """
    width = min(len(mine), theirs.shape[1])
    ours, others = _folded(mine[None], width), _folded(theirs, width)
    sums = np.minimum(others, ours).sum(axis=1, dtype=np.int64)
    if 255 in mine:
        sums[(theirs == 255).any(axis=1)] = np.iinfo(np.int64).max
    return sums


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Those pairs (a, b, n_a, n_b) whose outlines do not rule out a link."""
    for batch in batches:
        least = PERCENT * (batch.column(2).to_numpy() + batch.column(3).to_numpy()) / (100 + PERCENT)
        outlines = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
        sums = [_least_sums(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)[None])[0] for a, b in outlines]
        keep = np.array(sums, np.int64) >= least
        yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array(keep))


class Order:
    """The global order: shingles that are no more frequent than chance first, by a hash; then by excess and hash.

    Any order gives the same result. A good one keeps what many texts share out of the heads of their sets.
    """

    def __init__(self, sketch: np.ndarray):
        mean = sketch.mean()
        excess = np.maximum(0, sketch - mean - SIGMAS * np.sqrt(mean))
        self.levels = np.ceil(np.log2(1 + excess)).astype(np.uint8)

    def level(self, values: np.ndarray) -> np.ndarray:
        return self.levels[(values & np.uint64(COUNTERS - 1)).astype(np.int64)]

    def head(self, values: np.ndarray) -> np.ndarray:
        """The first shingles: as many as a similar set cannot all lack."""
        n = len(values)
        count = n - -(-PERCENT * n // 100) + 1
        return values[np.lexsort((mix(values, 7), self.level(values)))[:count]]

    def fragments(self, values: np.ndarray) -> np.ndarray:
        """The last fragment has the frequent shingles; the others are ranges of the hash."""
        by_hash = (mix(values, 7) >> np.uint64(40)).astype(np.int64) * (FRAGMENTS - 1) >> 24
        return np.where(self.level(values) > 0, FRAGMENTS - 1, by_hash)


def _order(profile: DataFrame) -> Order:
    """From the frequencies of all shingles of all texts, in a row per counter."""
    got = (
        profile.where("counter IS NOT NULL").groupBy("counter").agg(F.sum("frequency").alias("n")).toArrow()
    )
    sketch = np.zeros(COUNTERS, np.int64)
    sketch[got["counter"].to_numpy()] = got["n"].to_numpy()
    return Order(sketch)


def _nodes(rows: DataFrame, order: Order) -> DataFrame:
    """One row per distinct set that is not empty: print, n, doc_id (the smallest), head, node (a number)."""
    shared = rows.sparkSession.sparkContext.broadcast(order)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(x) for x in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array(map(fingerprint, sets), pa.binary()),
                    pa.array([shared.value.head(s).view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array(map(outline, sets), pa.binary()),
                ],
                names=["doc_id", "n", "print", "head", "outline"],
            )

    found = rows.mapInArrow(heads, "doc_id long, n long, print binary, head array<long>, outline binary").where("n > 0")
    one = found.groupBy("print").agg(
        F.min("n").alias("n"), F.min("doc_id").alias("doc_id"), F.first("head").alias("head"), F.first("outline").alias("outline"), F.count("*").alias("copies")
    )
    return written(one.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _shared_heads(nodes: DataFrame) -> DataFrame:
    """token, node, n, first (node), first_n of all tokens in the heads of two or more nodes.

    First comes the node with most copies: what others were made from, more often than not. The window only looks back and one row ahead, so a token's rows are never held together.
    """
    heads = nodes.select("node", "n", "copies", F.explode("head").alias("token"))
    order = "OVER (PARTITION BY token ORDER BY copies DESC, node"
    looked = heads.selectExpr(
        "*",
        f"first(struct(node, n)) {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first",
        f"lead(node) {order}) AS next",
    )
    return written(
        looked.where("first.node <> node OR next IS NOT NULL").selectExpr(
            "token", "node", "n", "first.node AS first", "first.n AS first_n"
        ),
        "heads",
    )


def _wanted(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, is_a, print, own (a hash of the id that stands for it): the nodes of these pairs."""
    sides = pairs.select(F.col("a").alias("node"), F.lit(True).alias("is_a")).union(pairs.select("b", F.lit(False)))
    one = sides.groupBy("node").agg(F.max("is_a").alias("is_a"))
    return one.join(nodes.select("node", "print", F.xxhash64("doc_id").alias("own")), "node")


def _needed(wanted: DataFrame) -> np.ndarray:
    """A filter of fixed size that passes the documents that stand for these nodes, and some others."""
    slots = wanted.select(F.col("own").bitwiseAND(FILTER_BITS - 1).cast("int").alias("slot")).distinct()
    passes = np.zeros(FILTER_BITS, bool)
    passes[slots.toArrow()["slot"].to_numpy()] = True
    return passes


def _segments(rows: DataFrame, pairs: DataFrame, nodes: DataFrame, order: Order) -> DataFrame:
    """node, is_a, fragment, part: the shingles of each fragment, of the nodes of these pairs.

    Rows that pass for a node have its print, and so its set. They are told apart by print and id, as the join
    leaves them, so that dropping repeated ones takes no shuffle of its own.
    """
    spark = rows.sparkSession
    wanted = written(_wanted(pairs, nodes), "wanted")
    shared = spark.sparkContext.broadcast((order, np.packbits(_needed(wanted))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, packed = shared.value
        passes = np.unpackbits(packed).view(bool)
        for batch in batches:
            chosen = np.flatnonzero(passes[batch.column(2).to_numpy()])
            batch = batch.take(pa.array(chosen))
            owns, prints, places, parts = [], [], [], []
            for own, text in zip(
                batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True
            ):
                values = shingles(text)
                where = order.fragments(values)
                for fragment in np.unique(where).tolist():
                    owns.append(own)
                    prints.append(fingerprint(values))
                    places.append(fragment)
                    parts.append(values[where == fragment].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owns, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(places, pa.int32()),
                    pa.array(parts, pa.list_(pa.int64())),
                ],
                names=["own", "print", "fragment", "part"],
            )

    own = F.xxhash64("doc_id")
    slotted = rows.select(own.alias("own"), "text", own.bitwiseAND(FILTER_BITS - 1).cast("int").alias("slot"))
    parts = slotted.mapInArrow(cut, "own long, print binary, fragment int, part array<long>")
    found = parts.join(wanted, ["print", "own"]).dropDuplicates(["print", "own", "fragment"])
    return found.select("node", "is_a", "fragment", "part")


def _links(rows: DataFrame, pairs: DataFrame, nodes: DataFrame, order: Order) -> DataFrame:
    """Those pairs (a, b, n_a, n_b) that are similar: overlaps by fragment, summed per pair."""
    segments = written(_segments(rows, pairs, nodes, order), "segments")
    left = segments.select(F.col("node").alias("b"), "fragment", F.col("part").alias("part_b"))
    right = segments.where("is_a").select(F.col("node").alias("a"), "fragment", F.col("part").alias("part_a"))
    counted = (
        pairs.join(left, "b")
        .join(right, ["a", "fragment"])
        .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("part_a", "part_b")).cast("long").alias("partial"))
    )
    sums = counted.groupBy("a", "b", "n_a", "n_b").agg(F.sum("partial").alias("shared"))
    return written(sums.where(_SIMILAR).select("a", "b"), "links")


def _first_pairs(heads: DataFrame) -> DataFrame:
    """Each node with the first node that it shares most first shingles with, of those within reach."""
    tried = heads.where("first <> node").selectExpr("first AS a", "node AS b", "first_n AS n_a", "n AS n_b").where(_SIZES)
    counted = tried.groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("head")).where(_REACHES)
    best = counted.groupBy("b", "n_b").agg(F.max(F.struct("head", (-F.col("a")).alias("minus"), "n_a")).alias("best"))
    return written(best.selectExpr("-best.minus AS a", "b", "best.n_a", "n_b"), "pairs")


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by ``task``, each of two blocks of a group. Per node, those nodes of the other block that are in
    another component and whose outline does not rule out a link.
    """
    names = ["task", "second", "node", "n", "component", "outline"]

    def compare(rows: list[tuple]) -> tuple[list[int], list[list[int]]]:
        first, second = ([r for r in rows if r[1] == side] for side in (False, True))
        other = second or first  # a block with itself comes once
        if not first:
            return [], []
        nodes, sizes, parts = (np.array([r[k] for r in other], np.int64) for k in (2, 3, 4))
        widths = np.array([len(r[5]) for r in other])
        outlines = {
            w: np.frombuffer(b"".join(r[5] for r in other if len(r[5]) == w), np.uint8).reshape(-1, w)
            for w in np.unique(widths).tolist()
        }
        row = np.zeros(len(other), np.int64)  # of a node, among those with as many cells
        for w in outlines:
            row[widths == w] = np.arange(len(outlines[w]))
        owners, lists = [], []
        for _, _, node, n, component, outline_ in first:
            mine = np.frombuffer(outline_, np.uint8)
            least = PERCENT * (sizes + n) / (100 + PERCENT)
            fits = (parts != component) & (np.minimum(sizes, n) >= least) & ((nodes > node) | bool(second))
            kept = []
            for w, cells in outlines.items():
                at = np.flatnonzero(fits & (widths == w))
                if len(at):
                    kept.append(nodes[at[_least_sums(mine, cells[row[at]]) >= least[at]]])
            keep = np.concatenate(kept) if kept else nodes[:0]
            if len(keep):
                owners.append(node)
                lists.append(keep)
        return owners, lists

    def result(rows: list[tuple]) -> pa.RecordBatch:
        owners, lists = compare(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(owners, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["node", "partners"]
        )

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True):
            if held and held[-1][0] != row[0]:
                yield result(held)
                held = []
            held.append(row)
    if held:
        yield result(held)


def _cross_pairs(heads: DataFrame, found: DataFrame, nodes: DataFrame) -> DataFrame:
    """All pairs that share a first shingle, are not in one component yet, and may link.

    In small groups pairs are counted, as a pair that is in no large group has all its common first shingles
    there, and then outlines decide. In large ones outlines decide alone. Large groups are cut into blocks; each two blocks meet in a task of their own, so that a task holds two
    blocks and no more, whatever the size of the group.
    """
    placed = heads.join(found, "node", "left").selectExpr("token", "node", "n", "coalesce(component, node) AS component")
    mixed = placed.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")
    ).where("low <> high").select("token", "members")
    met = written(placed.join(mixed, "token"), "mixed")
    few = met.where(f"members <= {SMALL}")
    a = few.selectExpr("token", "node AS a", "n AS n_a", "component AS c_a")
    b = few.selectExpr("token", "node AS b", "n AS n_b", "component AS c_b")
    counted = a.join(b, "token").where(f"a < b AND c_a <> c_b AND {_SIZES}").groupBy("a", "b", "n_a", "n_b")
    outlines = nodes.select("node", "outline")
    close = (
        counted.agg(F.count("*").alias("head")).where(_REACHES).drop("head")
        .join(outlines.withColumnsRenamed({"node": "a", "outline": "outline_a"}), "a")
        .join(outlines.withColumnsRenamed({"node": "b", "outline": "outline_b"}), "b")
        .select("a", "b", "n_a", "n_b", "outline_a", "outline_b")
        .mapInArrow(_fit, "a long, b long, n_a long, n_b long")
    )
    many = met.where(f"members > {SMALL}").withColumn("last", F.expr(f"cast((members - 1) div {BLOCK} AS int)"))
    rows = many.selectExpr(
        "*", f"(row_number() OVER (PARTITION BY token ORDER BY node) - 1) div {BLOCK} AS block"
    )
    dealt = rows.join(nodes.select("node", "outline"), "node").selectExpr(
        "token", "node", "n", "component", "outline", "block", "explode(sequence(0, last)) AS other"
    ).selectExpr(
        "struct(token, least(block, other) AS i, greatest(block, other) AS j) AS meeting",
        "block > other AS second", "node", "n", "component", "outline",
    )
    # Of two blocks the later one is second; a block with itself has only first rows.
    tasks = dealt.withColumn("task", F.to_json("meeting")).repartition("task").sortWithinPartitions("task")
    lists = tasks.select("task", "second", "node", "n", "component", "outline").mapInArrow(
        _partners, "node long, partners array<long>"
    )
    partners = lists.groupBy("node").agg(F.expr("array_distinct(flatten(collect_list(partners)))").alias("partners"))
    pairs = partners.select("node", F.explode("partners").alias("partner")).selectExpr(
        "least(node, partner) AS a", "greatest(node, partner) AS b"
    ).distinct()
    sizes = nodes.select("node", "n")
    outlined = pairs.join(sizes.selectExpr("node AS a", "n AS n_a"), "a").join(sizes.selectExpr("node AS b", "n AS n_b"), "b")
    return written(close.unionByName(outlined).distinct(), "pairs")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (the smallest id that links lead to, its own included).

    Two texts link when their sets of distinct five-word shingles (A-Z in lower case) have a Jaccard similarity
    of 0.8 or more; a text of fewer words has its whole sequence as one. Null texts and texts without words have
    an empty set and link with nothing, so that their component is their own id. Rows with null ids take part;
    a component of such rows alone has a null id. Rows that repeat an id or a text each get a row. An empty table gives
    none. Sets are compared by 64-bit hashes of shingles and 128-bit fingerprints.
    """
    rows = plain(docs, id_col, text_col)
    profile = written(
        rows.mapInArrow(_profile, "doc_id long, n long, print binary, counter int, frequency long"), "profile"
    )
    order = _order(profile)
    nodes = _nodes(rows, order)
    heads = _shared_heads(nodes)

    links = _links(rows, _first_pairs(heads), nodes, order)
    cross = _cross_pairs(heads, components(links), nodes)
    if not cross.isEmpty():
        links = links.union(_links(rows, cross, nodes, order))
    placed = nodes.select("node", "print", "doc_id").join(components(links), "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = placed.join(smallest, "component").select("print", "component_id")
    texts = profile.where("counter IS NULL").select("doc_id", F.col("n").alias("n_shingles"), "print")
    return texts.join(placed, "print", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )

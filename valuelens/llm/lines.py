"""Line dedup that can be taken back: sharded cuckoo filters in front of exact reference counts.

The index lies in the shared folder as four logs of Parquet, by batch:

* ``refs``: which document holds which line key (signed, so that a deletion takes a reference back);
* ``counts``: by key, how many documents hold it and the smallest of them, as of the batch that last touched it;
* ``filters``: cuckoo filters of the keys that a batch saw first, in shards of a bounded number of keys;
* ``commits``: the batches that are complete. What a failed batch left behind is never read.

A new batch asks the filters first. Keys they do not know are new, and need no look at the exact tables; the others are
counted exactly. A deletion takes references back, looks up the next smallest document where the smallest is gone, and
removes the fingerprints of keys that no document holds any more. Keys are 128-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuelens.llm.common import hot_join, mix, written
from valuelens.session import shared_folder

MIN_CHARACTERS = 10
SPACE = b" \t\n\x0b\x0c\r"
KEYS_PER_SHARD = 1 << 17
SLOTS = 4  # of a bucket
LOAD = 0.9
MAX_GENERATIONS = 8  # filters of more batches are merged into one generation
_ROUNDS = 500

KEY = ["k1", "k2"]
REFS = "k1 long, k2 long, doc_id long, sign int, batch int"
COUNTS = "k1 long, k2 long, n_docs long, first_doc long, generation int, batch int"
COMMITS = "batch int, token string, kind string, generations array<int>"
FILTERS = "generation int, shard long, bits int, slots binary, batch int"


# ------------------------------------------------------------------ lines


def keys_of(text: str | None) -> list[bytes | None]:
    """The key of every line: stripped, A-Z in lower case; None where it is too short to count."""
    found = []
    for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n"):
        key = line.strip(SPACE)
        long = len(key) >= MIN_CHARACTERS and (
            key.isascii() or len(key) - sum(key.count(b) for b in _FOLLOWING if b in key) >= MIN_CHARACTERS
        )
        found.append(key if long else None)
    return found


_FOLLOWING = [bytes([b]) for b in range(0x80, 0xC0)]  # bytes that continue a character


def hashed(keys: list[bytes]) -> np.ndarray:
    """128 bits of each key, as two numbers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<i8").reshape(-1, 2)


def _refs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, parts = batch.column(0).to_pylist(), [], []
        for text in batch.column(1).to_pylist():
            keys = {k for k in keys_of(text) if k is not None}
            sizes.append(len(keys))
            parts.append(hashed(list(keys)))
        both = np.concatenate(parts) if parts else np.empty((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(np.repeat(np.array(ids, np.int64), sizes))], names=["k1", "k2", "doc_id"]
        )


# ----------------------------------------------------------------- filters


class Cuckoo:
    """Sixteen-bit fingerprints in buckets of four; each key has two buckets, either of which tells the other.

    ``bits`` leading bits of a key name its shard, so the bucket comes from a mixture of all of them.
    """

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.mask = np.uint64(len(slots) - 1)

    @staticmethod
    def sized(n: int) -> Cuckoo:
        buckets = 1 << max(0, int(np.ceil(np.log2(max(n, 1) / (LOAD * SLOTS)))))
        return Cuckoo(np.zeros((buckets, SLOTS), np.uint16))

    @staticmethod
    def holding(k1: np.ndarray, k2: np.ndarray) -> Cuckoo:
        """A filter of these keys; a larger one if they do not fit."""
        found = Cuckoo.sized(len(k1))
        while not found.insert(k1, k2):
            found = Cuckoo(np.zeros((2 * len(found.slots), SLOTS), np.uint16))
        return found

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints = (mix(k2.view(np.uint64), 1) & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1  # zero is an empty slot
        one = mix(k1.view(np.uint64), 2) & self.mask
        return prints, one, self.other(one, prints)

    def other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (bucket ^ mix(prints.astype(np.uint64), 3)) & self.mask

    def holds(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        prints, one, two = self.places(k1, k2)
        return ((self.slots[one] == prints[:, None]) | (self.slots[two] == prints[:, None])).any(axis=1)

    def _fill(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts what fits into free slots of its bucket; which ones did not."""
        order = np.argsort(bucket, kind="stable")
        at = bucket[order]
        begins = np.flatnonzero(np.diff(at, prepend=~at[:1]))
        rank = np.arange(len(at)) - np.repeat(begins, np.diff(begins, append=len(at)))
        empty = self.slots[at] == 0
        free = empty.sum(axis=1)
        fits = rank < free
        slot = np.argsort(~empty, axis=1, kind="stable")[np.arange(len(at)), np.minimum(rank, SLOTS - 1)]
        self.slots[at[fits], slot[fits]] = prints[order[fits]]
        return order[~fits]

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """Inserts all keys at once, round by round: into the first bucket, the second, and then by moving others on."""
        prints, one, two = self.places(k1, k2)
        left = self._fill(prints, one)
        prints, bucket = prints[left], two[left]
        for turn in range(_ROUNDS):
            left = self._fill(prints, bucket)
            if not len(left):
                return True
            prints, bucket = prints[left], bucket[left]
            # One of each bucket takes the slot of another, which goes to its other bucket.
            _, chosen = np.unique(bucket, return_index=True)
            at, slot = bucket[chosen], (turn + chosen) % SLOTS
            moved = self.slots[at, slot].copy()
            self.slots[at, slot] = prints[chosen]
            prints[chosen], bucket[chosen] = moved, self.other(at, moved)
        return False

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Takes one copy of each key's fingerprint out; the keys must be in."""
        for print_, one, two in zip(*self.places(k1, k2), strict=True):
            for bucket in (one, two):
                at = np.flatnonzero(self.slots[bucket] == print_)
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    break

    def packed(self) -> bytes:
        return self.slots.astype("<u2").tobytes()

    @staticmethod
    def unpacked(data: bytes) -> Cuckoo:
        return Cuckoo(np.frombuffer(data, "<u2").reshape(-1, SLOTS).copy())


def _shard(bits: int) -> str:
    """The leading bits of a key."""
    return f"shiftrightunsigned(k1, {64 - bits})" if bits else "0L"


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def filters_of(keys: DataFrame, generation: int, batch: int) -> DataFrame:
    """A filter per shard of the keys; there are as many shards as the number of keys asks for."""
    n = keys.count()
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / KEYS_PER_SHARD))))

    def build(table: pa.Table) -> pa.Table:
        k1, k2, shard = _columns(table, "k1", "k2", "shard")
        row = {"generation": generation, "shard": shard[0], "bits": bits, "slots": Cuckoo.holding(k1, k2).packed(), "batch": batch}
        return pa.Table.from_pylist([row], pa.schema([("generation", pa.int32()), ("shard", pa.int64()), ("bits", pa.int32()), ("slots", pa.binary()), ("batch", pa.int32())]))

    return keys.selectExpr("k1", "k2", f"{_shard(bits)} AS shard").groupBy("shard").applyInArrow(build, FILTERS)


# ------------------------------------------------------------------- index


@dataclass
class LineIndex:
    """The index at ``path``; every method that changes it writes one batch and commits it."""

    spark: SparkSession
    path: str

    @staticmethod
    def new(spark: SparkSession) -> LineIndex:
        index = LineIndex(spark, f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}")
        spark.createDataFrame([], COMMITS).write.parquet(f"{index.path}/commits")
        return index

    # reading

    def _log(self, name: str, schema: str) -> DataFrame:
        batches = self._commits()
        paths = [f"{self.path}/{name}/{token}" for _, token, *_ in batches]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _commits(self) -> list[tuple[int, str, str, list[int]]]:
        """batch, folder, kind and the generations of filters that hold from it on; one row per batch."""
        rows = self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits").orderBy("batch").collect()
        return [(r.batch, r.token, r.kind, list(r.generations)) for r in rows]

    def refs(self) -> DataFrame:
        """k1, k2, doc_id: references that hold, one for each document and key of it."""
        log = self._log("refs", REFS)
        if all(kind == "insert" for _, _, kind, _ in self._commits()):
            return log.select(*KEY, "doc_id")
        held = log.groupBy(*KEY, "doc_id").agg(F.sum("sign").alias("sign"))
        return held.where("sign > 0").select(*KEY, "doc_id")

    def counts(self) -> DataFrame:
        """k1, k2, n_docs, first_doc, generation: of all keys that a document holds."""
        log = self._log("counts", COUNTS)
        if len(self._commits()) > 1:
            state = F.max_by(F.struct("n_docs", "first_doc", "generation"), "batch").alias("state")
            log = log.groupBy(*KEY).agg(state).select(*KEY, "state.*")
        return log.where("n_docs > 0").select(*KEY, "n_docs", "first_doc", "generation")

    def filters(self) -> DataFrame:
        """The valid filter of each generation and shard: the last one written."""
        commits = self._commits()
        log = self._log("filters", FILTERS)
        valid = commits[-1][3] if commits else []
        last = log.where(F.col("generation").isin(valid)).groupBy("generation", "shard").agg(F.max("batch").alias("batch"))
        return log.join(last, ["generation", "shard", "batch"])

    def maybe_known(self, keys: DataFrame) -> DataFrame:
        """Keys (one row each) that a filter may hold; no key that the index holds is left out."""
        shards = written(self.filters(), "filters")
        found = None
        for row in shards.select("generation", "bits").distinct().collect():  # MAX_GENERATIONS at most

            def ask(mine: pa.Table, theirs: pa.Table) -> pa.Table:
                if not theirs.num_rows:
                    return mine.slice(0, 0).select(KEY)
                held = Cuckoo.unpacked(theirs.column("slots")[0].as_py()).holds(*_columns(mine, *KEY)) if mine.num_rows else []
                return mine.select(KEY).filter(pa.array(held, pa.bool_()))

            asked = keys.selectExpr(*KEY, f"{_shard(row.bits)} AS shard").groupBy("shard")
            of_row = shards.where((F.col("generation") == row.generation)).select("shard", "slots").groupBy("shard")
            hits = asked.cogroup(of_row).applyInArrow(ask, "k1 long, k2 long")
            found = hits if found is None else found.unionByName(hits)
        return keys.select(*KEY).where("false") if found is None else found.distinct()

    # writing

    def _commit(self, batch: int, token: str, kind: str, generations: list[int], **logs: DataFrame) -> None:
        schemas = {"refs": REFS, "counts": COUNTS, "filters": FILTERS}
        for name, schema in schemas.items():
            rows = logs.get(name)
            rows = self.spark.createDataFrame([], schema) if rows is None else rows
            rows.write.mode("overwrite").parquet(f"{self.path}/{name}/{token}")
        done = self.spark.createDataFrame([(batch, token, kind, generations)], COMMITS)
        done.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _next(self) -> tuple[int, str, list[int]]:
        commits = self._commits()
        batch = len(commits)
        return batch, f"{batch}-{uuid.uuid4().hex}", commits[-1][3] if commits else []

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Adds the documents' lines. A document that is in already adds the keys it did not have."""
        batch, token, generations = self._next()
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        refs = written(rows.where("doc_id IS NOT NULL").mapInArrow(_refs, "k1 long, k2 long, doc_id long").distinct(), "refs")
        keys = written(_by_key(refs), "keys")
        known = None
        if generations:
            maybe = written(self.maybe_known(keys), "maybe")
            known = written(self.counts().join(maybe, KEY, "left_semi"), "known")
            # Only keys that are really known can have a reference that is in already.
            again = self.refs().join(known.select(KEY), KEY, "left_semi")
            fresh = written(refs.join(again, [*KEY, "doc_id"], "left_anti"), "fresh")
            fresh_keys = written(_by_key(fresh), "fresh-keys")
            new = written(fresh_keys.join(known, KEY, "left_anti"), "new")
            old = fresh_keys.alias("f").join(known.alias("k"), KEY)
            both = old.select(
                *KEY, (F.col("f.n_docs") + F.col("k.n_docs")).alias("n_docs"),
                F.least("f.first_doc", "k.first_doc").alias("first_doc"), "k.generation",
            )
        else:
            fresh, new = refs, keys
        counts = new.select(*KEY, "n_docs", "first_doc", F.lit(batch).alias("generation"))
        counts = counts if known is None else counts.unionByName(both)
        if len(generations) < MAX_GENERATIONS:
            generations, filters = [*generations, batch], filters_of(new, batch, batch)
        else:  # one generation again, of all keys
            older = self.counts().join(new, KEY, "left_anti").select(*KEY, "n_docs", "first_doc")
            if known is not None:
                older = older.join(both.select(KEY), KEY, "left_anti").unionByName(both.drop("generation"))
            everything = written(older.unionByName(new), "everything")
            counts = everything.select(*KEY, "n_docs", "first_doc", F.lit(batch).alias("generation"))
            generations, filters = [batch], filters_of(everything, batch, batch)
        self._commit(
            batch, token, "insert", generations,
            refs=fresh.select(*KEY, "doc_id", F.lit(1).alias("sign"), F.lit(batch).alias("batch")),
            counts=counts.withColumn("batch", F.lit(batch)), filters=filters,
        )

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Takes documents out by id; their lines are as if they had never been in. Unknown ids change nothing."""
        batch, token, generations = self._next()
        wanted = ids.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        refs = written(self.refs(), "live")
        gone = written(refs.join(wanted, "doc_id", "left_semi"), "gone")
        counts = self.counts()
        touched = counts.join(_by_key(gone).select(*KEY, F.col("n_docs").alias("less"), F.col("first_doc").alias("lost")), KEY)
        touched = written(touched.withColumn("n", F.col("n_docs")), "touched")
        # The next smallest document is asked for only where the smallest is gone.
        orphans = touched.where("lost = first_doc AND n_docs > less").select(*KEY, "n")
        staying = refs.join(wanted, "doc_id", "left_anti")
        heirs = hot_join(staying, orphans, KEY).groupBy(*KEY).agg(F.min("doc_id").alias("heir"))
        after = written(
            touched.join(heirs, KEY, "left").select(
                *KEY, (F.col("n_docs") - F.col("less")).alias("n_docs"),
                F.coalesce("heir", "first_doc").alias("first_doc"), "generation",
            ), "after",
        )
        dead = after.where("n_docs = 0")
        shards = written(self.filters(), "filters")
        changed = None
        for row in shards.select("generation", "bits").distinct().collect():
            mine = dead.where(F.col("generation") == row.generation).selectExpr(*KEY, f"{_shard(row.bits)} AS shard").groupBy("shard")
            theirs = shards.where(F.col("generation") == row.generation).groupBy("shard")

            def remove(keys: pa.Table, old: pa.Table) -> pa.Table:
                if not keys.num_rows:
                    return old.slice(0, 0)
                held = Cuckoo.unpacked(old.column("slots")[0].as_py())
                held.delete(*_columns(keys, *KEY))
                at = old.schema.get_field_index("slots")
                return old.set_column(at, "slots", pa.array([held.packed()], old.schema.field(at).type))

            part = mine.cogroup(theirs).applyInArrow(remove, shards.schema)
            changed = part if changed is None else changed.unionByName(part)
        changed = None if changed is None else changed.select("generation", "shard", "bits", "slots", F.lit(batch).alias("batch"))
        self._commit(
            batch, token, "delete", generations,
            refs=gone.select(*KEY, "doc_id", F.lit(-1).alias("sign"), F.lit(batch).alias("batch")),
            counts=after.withColumn("batch", F.lit(batch)), filters=changed,
        )

    # results

    def drops(self) -> DataFrame:
        """doc_id, k1, k2: keys whose lines a document loses, as a document with a smaller id holds them too."""
        repeated = written(self.counts().where("n_docs > 1").select(*KEY, "first_doc", F.col("n_docs").alias("n")), "repeated")
        return hot_join(written(self.refs(), "live"), repeated, KEY).where("doc_id <> first_doc").select("doc_id", *KEY)

    def kept(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, n_lines, n_dropped, kept (text) of documents that are in the index.

        A null text counts as empty, which is one line. Rows without id are not in the index and lose nothing. Rows that repeat
        an id are one document: their lines are kept or dropped alike. Without documents there are no rows.
        """
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        lists = self.drops().groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct(*KEY)).alias("keys"))
        marked = rows.join(lists, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "keys")
        return marked.mapInArrow(_cut, "doc_id long, n_lines long, n_dropped long, kept string")


def _by_key(refs: DataFrame) -> DataFrame:
    """A row per key; a key that very many documents hold is summed before the shuffle."""
    return refs.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, dropped in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            lines = (text or "").split("\n")
            stays = [True] * len(lines)
            if dropped:
                wanted = {(d["k1"], d["k2"]) for d in dropped}
                keys = keys_of(text)
                at = [i for i, k in enumerate(keys) if k is not None]
                for i, pair in zip(at, map(tuple, hashed([keys[i] for i in at]).tolist()), strict=True):
                    stays[i] = pair not in wanted
            out.append((len(lines), stays.count(False), "\n".join(x for x, s in zip(lines, stays, strict=True) if s)))
        n_lines, n_dropped, kept = zip(*out, strict=True) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "kept"],
        )


def deduplicated(docs: DataFrame, batches: int = 1, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, LineIndex]:
    """A new index of the documents, inserted in so many batches by a hash of the id, and the documents without repeats."""
    index = LineIndex.new(docs.sparkSession)
    for k in range(batches):
        own = F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)) == k
        index.insert(docs.where(own) if batches > 1 else docs, id_col, text_col)
    return index.kept(docs, id_col, text_col), index

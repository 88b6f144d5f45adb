"""Line dedup: against plain Python, and inserted, deleted and inserted again."""

from collections import defaultdict

import numpy as np
import pytest

from tests.llm.rows import ODD, documents
from valuelens.llm import lines

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def plain_kept(rows):
    """(n_lines, n_dropped, kept) of each row, by position."""
    holders, split = defaultdict(set), []
    for doc_id, text in rows:
        own = (text or "").split("\n")
        keys = [x.strip(" \t\n\v\f\r").translate(LOWER) for x in own]
        split.append((doc_id, own, keys))
        for key in keys:
            if len(key) >= 10 and doc_id is not None:
                holders[key].add(doc_id)
    found = []
    for doc_id, own, keys in split:
        stays = [x for x, k in zip(own, keys) if doc_id is None or len(holders[k]) < 2 or min(holders[k]) == doc_id]
        found.append((doc_id, len(own), len(own) - len(stays), "\n".join(stays)))
    return sorted(found, key=repr)


def got(index, docs):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in index.kept(docs).collect()), key=repr)


def random_rows(seed, n, first=0):
    rng = np.random.default_rng(seed)
    pool = [f"  Line Number {i} of many\t" if i % 3 else f"ünï{i}cödé zeile" for i in range(60)] + ["short", "", "nine char", "ten chars!"]
    return [(first + i, "\n".join(rng.choice(pool, rng.integers(1, 12)))) for i in range(n)]


@pytest.mark.parametrize("batches", [1, 3])
def test_batches_do_not_matter(spark, batches):
    rows = [*random_rows(1, 60), *ODD, (3, None), (-7, "LINE NUMBER 1 OF MANY\nline number 1 of many"), (70, "a\r\nten chars!\r\n ")]
    docs = documents(spark, *rows)
    found, _ = lines.deduplicated(docs, batches)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found.collect()), key=repr) == plain_kept(rows)


def test_deletions_take_insertions_back(spark):
    a, b, c = random_rows(2, 30), random_rows(3, 30, 30), random_rows(4, 10, 60)
    index = lines.LineIndex.new(spark)
    index.insert(documents(spark, *a))
    index.insert(documents(spark, *b))
    before = sorted(map(tuple, index.counts().drop("generation").collect()))
    assert got(index, documents(spark, *a, *b)) == plain_kept(a + b)
    index.insert(documents(spark, *c))
    index.delete(spark.createDataFrame([(i,) for i, _ in c] + [(None,), (999,)], "doc_id long"))
    assert sorted(map(tuple, index.counts().drop("generation").collect())) == before
    # The smallest holders go: others take their place.
    gone = {i for i, _ in a[:20]} | {35}
    index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    left = [r for r in a + b if r[0] not in gone]
    assert got(index, documents(spark, *left)) == plain_kept(left)
    # What no document holds any more is out of the filters, but for keys of equal fingerprints.
    filters = index.filters().collect()
    held = sum(int(np.count_nonzero(lines.Cuckoo.unpacked(r.slots).slots)) for r in filters)
    assert held == index.counts().count()
    index.insert(documents(spark, *a))
    assert got(index, documents(spark, *a, *left)) == plain_kept(sorted({*a, *left}) + [r for r in left if r in a])


def test_a_document_inserted_twice_counts_once(spark):
    rows = random_rows(5, 12)
    index = lines.LineIndex.new(spark)
    for _ in range(2):
        index.insert(documents(spark, *rows))
    assert got(index, documents(spark, *rows)) == plain_kept(rows)
    index.delete(spark.createDataFrame([(i,) for i, _ in rows], "doc_id long"))
    assert index.counts().count() == 0 and index.refs().count() == 0
    assert all(not lines.Cuckoo.unpacked(r.slots).slots.any() for r in index.filters().collect())


def test_many_batches_are_merged(spark, monkeypatch):
    monkeypatch.setattr(lines, "MAX_GENERATIONS", 2)
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", 8)  # so that there are several shards
    rows = random_rows(6, 40)
    index = lines.LineIndex.new(spark)
    for k in range(0, 40, 10):
        index.insert(documents(spark, *rows[k : k + 10]))
    assert got(index, documents(spark, *rows)) == plain_kept(rows)
    assert index.filters().select("generation").distinct().count() <= 2
    assert index.filters().select("shard").distinct().count() > 2


def test_an_unfinished_batch_is_not_read(spark, monkeypatch):
    rows = random_rows(7, 20)
    index = lines.LineIndex.new(spark)
    index.insert(documents(spark, *rows[:10]))

    def stops(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(lines, "filters_of", stops)
        with pytest.raises(RuntimeError):
            index.insert(documents(spark, *rows[10:]))
    again = lines.LineIndex(spark, index.path)
    again.insert(documents(spark, *rows[10:]))
    assert got(again, documents(spark, *rows)) == plain_kept(rows)


def test_empty_tables(spark):
    nothing = documents(spark, (1, "x")).where("false")
    found, index = lines.deduplicated(nothing, 2)
    assert found.count() == 0 and index.counts().count() == 0
    index.delete(spark.createDataFrame([], "doc_id long"))
    assert index.kept(documents(spark, (1, None))).collect()[0].n_lines == 1


def test_a_filter_loses_no_key_and_gives_them_back():
    rng = np.random.default_rng(0)
    keys = rng.integers(-(1 << 63), 1 << 63, (50_000, 2), np.int64)
    held = lines.Cuckoo.holding(keys[:, 0], keys[:, 1])
    assert held.holds(keys[:, 0], keys[:, 1]).all()
    others = rng.integers(-(1 << 63), 1 << 63, (50_000, 2), np.int64)
    assert held.holds(others[:, 0], others[:, 1]).mean() < 0.001
    held.delete(keys[:20_000, 0], keys[:20_000, 1])
    assert held.holds(keys[20_000:, 0], keys[20_000:, 1]).all()
    assert held.holds(keys[:20_000, 0], keys[:20_000, 1]).mean() < 0.001

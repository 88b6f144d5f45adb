"""Near duplicates, repeated passages, the pipeline: against brute force."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.rows import ODD, SF_DIR, documents, prose
from valuelens.llm import components, jaccard, passages, queries
from valuelens.llm.common import shingles, texts_word_hashes, windows, word_hashes, words


def linked(texts):
    """component_id by document, from all pairs."""
    sets = {i: set(shingles(t).tolist()) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def chain(n):
    """Texts that each link with the next only."""
    base = prose(7, 100, 10_000).split()
    return [" ".join(base[k : k + 60]) for k in range(0, 3 * n, 3)]


def test_links_of_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.jaccard_join(spark, SF_DIR).collect()}
    assert found == linked(texts)


@pytest.mark.parametrize("small", [1, 64])
def test_groups_of_near_copies(spark, monkeypatch, small):
    """A small value sends every group through outlines, in blocks of three."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    line = " all of this is one very common line that many texts hold "
    texts = dict(enumerate([*chain(8), *(prose(100 + i, 30) + line + prose(200 + i, 9) for i in range(8)), "A b", "a B", "x y z"]))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(documents(spark, *texts.items())).collect()}
    assert found == linked(texts)


def test_odd_rows_have_components(spark):
    rows = jaccard.join(documents(spark, *ODD)).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    assert by[1] == (0, 1) and by[3] == (0, 3) and by[6] == (1, 4) and by[5][1] == 5
    assert jaccard.join(documents(spark, *ODD).where("false")).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 40), (40, 50), (60, 60)], "a long, b long")
    found = {r.node: r.component for r in components.components(links).collect()}
    assert found == {**dict.fromkeys(range(1, 31), 1), 40: 40, 50: 40}


def test_compact_windows_are_the_tree_of_all_places():
    rng = np.random.default_rng(1)
    for n, size in [(0, 3), (2, 3), (3, 3), (50, 4), (200, 7)]:
        values = rng.integers(0, 60, n).astype(np.uint64)
        expected = []
        for c in range(n):
            left, right = c, c
            while left > 0 and values[left - 1] > values[c]:
                left -= 1
            while right + 1 < n and values[right + 1] >= values[c]:
                right += 1
            if right - left + 1 >= size:
                expected.append([left, c, right])
        assert passages.compact_windows(values, size).tolist() == expected


def test_repeats_of_the_table(spark):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    first, covered, got = {}, defaultdict(set), defaultdict(set)
    for i, text in texts:
        for k, gram in enumerate(windows(word_hashes(words(text)), passages.PASSAGE_WORDS).tolist()):
            if first.setdefault(gram, i) != i:
                covered[i].add(k)
    for r in queries.repeated_passages(spark, SF_DIR).collect():
        got[r.doc_id] |= set(range(r.first_word, r.end_word - passages.PASSAGE_WORDS + 1))
        assert r.end_word - r.first_word >= passages.PASSAGE_WORDS and r.other_id < r.doc_id
    assert covered and not {i: places - got[i] for i, places in covered.items() if places - got[i]}


def test_repeats(spark):
    shared = prose(3, 60, 5000)
    one_edit = " ".join("new" if i == 30 else w for i, w in enumerate(shared.split()))
    docs = [
        (10, prose(11, 40, 5000) + " " + shared),
        (11, shared.upper() + " " + prose(12, 40, 5000)),
        (12, " ".join(shared.split()[:40]) + " " + prose(13, 80, 5000)),
        (13, prose(14, 55, 5000) * 2),
        (14, prose(15, 20, 5000) + " " + one_edit),
    ]
    rows = passages.repeats(documents(spark, *docs, *ODD)).collect()
    assert {r.doc_id for r in rows} == {11, 14}
    [row] = [r for r in rows if r.doc_id == 11]
    assert (row.first_word, row.end_word, row.other_id, row.other_first_word) == (0, 60, 10, 40)
    assert passages.repeats(documents(spark, *docs).where("false")).count() == 0


def test_unchanged_passages_behind_partial_quotes(spark):
    """Earlier texts hold only parts of a passage, so that the later ones must meet each other."""
    docs, later = [], {}
    for i in range(20):
        shared = prose(5000 + i, 60, 5000).split()
        parts = [shared[:45], shared[15:], shared[:49], shared[8:]]
        for k, part in enumerate(parts):
            docs.append((100 * i + k, " ".join([prose(6000 + 10 * i + k, 30, 5000), *part, prose(7000 + 10 * i + k, 30, 5000)])))
        for k in range(4, 8):
            docs.append((100 * i + k, " ".join([prose(6000 + 10 * i + k, 30, 5000), *shared, prose(7000 + 10 * i + k, 30, 5000)])))
            later[100 * i + k] = set(range(30, 41))
    texts, first, expected, got = dict(docs), {}, defaultdict(set), defaultdict(set)
    for i, text in sorted(texts.items()):
        for k, gram in enumerate(windows(word_hashes(words(text)), passages.PASSAGE_WORDS).tolist()):
            if first.setdefault(gram, i) != i:
                expected[i].add(k)
    for r in passages.repeats(documents(spark, *docs)).collect():
        got[r.doc_id] |= set(range(r.first_word, r.end_word - passages.PASSAGE_WORDS + 1))
    assert all(expected[i] >= places for i, places in later.items() if i % 100 > 4)
    assert not {i: places - got[i] for i, places in expected.items() if places - got[i]}


def test_slices_do_not_depend_on_chunks_and_batches(spark, monkeypatch):
    def rows():
        return sorted(queries.repeated_passages(spark, SF_DIR).collect())

    expected = rows()
    monkeypatch.setattr(passages, "CHUNK_BITS", 1)
    monkeypatch.setattr(passages, "BATCH_BYTES", 500)
    assert rows() == expected


def test_most_passages_with_an_edit_are_found(spark):
    docs = []
    for i in range(40):
        shared = prose(1000 + i, 60, 5000).split()
        docs.append((2 * i, " ".join(shared) + " " + prose(2000 + i, 60, 5000)))
        shared[30] = "new"
        docs.append((2 * i + 1, prose(3000 + i, 20, 5000) + " " + " ".join(shared)))
    found = {r.doc_id for r in passages.repeats(documents(spark, *docs)).collect()}
    assert found <= set(range(1, 80, 2)) and len(found) >= 32


@pytest.mark.parametrize("change", ["insert", "delete"])
def test_most_passages_with_a_word_more_or_less_are_found(spark, change):
    docs = []
    for i in range(40):
        shared = prose(1000 + i, 60, 5000).split()
        docs.append((2 * i, " ".join(shared) + " " + prose(2000 + i, 60, 5000)))
        shared[30 : 30 + (change == "delete")] = ["new"] if change == "insert" else []
        docs.append((2 * i + 1, prose(3000 + i, 20, 5000) + " " + " ".join(shared)))
    rows = passages.repeats(documents(spark, *docs)).collect()
    found = {r.doc_id for r in rows}
    assert found <= set(range(1, 80, 2)) and len(found) >= 36
    assert all(abs(r.first_word - 20 - r.other_first_word) <= 1 for r in rows)


def changed(words_, place, change):
    return [*words_[:place], *({"replace": ["new"], "insert": ["new", words_[place]], "delete": []}[change]), *words_[place + 1 :]]


@pytest.mark.parametrize("change", ["replace", "insert", "delete"])
@pytest.mark.parametrize("quotes", [1, 2, 5])
def test_most_edited_passages_behind_partial_quotes_are_found(spark, quotes, change):
    """Earlier texts hold parts of the passage, each with an edit of its own; of two later copies the second has one."""
    docs, rng = [], np.random.default_rng(quotes)
    for i in range(60):
        shared = prose(9000 + i, 60, 5000).split()
        parts = [shared[:45], shared[15:], shared[:44], shared[13:58], shared[16:]][:quotes]
        texts = [*(changed(x, 30 - 15 * (k in (1, 4)), "replace") for k, x in enumerate(parts)), shared, changed(shared, int(rng.integers(12, 48)), change)]
        for k, own in enumerate(texts):
            docs.append((100 * i + k, " ".join([prose(10_000 + 20 * i + k, 30, 5000), *own, prose(20_000 + 20 * i + k, 30, 5000)])))
    rows = passages.repeats(documents(spark, *docs)).collect()
    found = {r.doc_id // 100 for r in rows if r.doc_id % 100 == quotes + 1 and r.other_id % 100 == quotes}
    assert len(found) >= 54
    assert all(r.other_id // 100 == r.doc_id // 100 for r in rows)


def test_anchors_are_shared_by_texts_that_share_their_windows():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    found = passages.anchors(grams)
    values = passages.mix(grams, 30)
    size = passages.ANCHOR_WINDOW
    assert set(found.tolist()) == {i + int(np.argmin(values[i : i + size])) for i in range(len(grams) - size + 1)}
    left, right = passages.anchor_pairs(grams, found, 38, 46)
    assert left.tolist() == [a for a in found.tolist() if a + 46 < len(grams)]
    assert right.tolist() == [a + 38 + int(np.argmin(values[a + 38 : a + 47])) for a in left.tolist()]
    assert len(passages.anchors(grams[:3])) == 0


def test_numpy_goes_through_many_texts_at_once(monkeypatch):
    """The same rows as text by text, with one call for all of them; a range's end is that of its text."""
    texts = [prose(400 + i, 20 * i, 300) for i in range(40)] + ["", " ", "one", "x " * 100, "a b c d e"]
    ids, hashes = pa.array(range(len(texts)), pa.int64()), pa.array([(-1) ** i * i for i in range(len(texts))], pa.int32())
    spans = [[1 << 62 | n - 75 << 32 | n - 60, n - 70 << 32 | n - 50] if (n := len(t.split()) + 1) > 120 else [] for t in texts]
    batch = pa.RecordBatch.from_arrays([ids, hashes, pa.array(texts), pa.array(spans, pa.list_(pa.int64()))], names=["id", "hash", "text", "ranges"])
    calls = []
    monkeypatch.setattr(passages, "compact_windows", lambda *a, f=passages.compact_windows: (calls.append(1), f(*a))[1])

    def rows(step):
        return sorted(r for b in step(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))

    together = rows(passages._window_rows), rows(passages._again_rows)
    assert len(calls) == passages.FUNCTIONS and all(together)
    assert len(list(passages._again_rows(iter([batch])))) == 1
    monkeypatch.setattr(passages, "GROUP_BYTES", 1)
    assert (rows(passages._window_rows), rows(passages._again_rows)) == together


def test_words_of_many_texts_have_the_hashes_of_each():
    rng = np.random.default_rng(3)
    pool = np.frombuffer("aZ \n\x0b\x00\x1c\x1fé\x8509".encode(), np.uint8)
    for _ in range(300):
        sizes = rng.choice([0, 1, 7, 40, 300], int(rng.integers(0, 6)))
        texts = [rng.choice(pool if rng.integers(0, 2) else pool[[0, 1, 2, 0, 1, 0]], n).tobytes() + b"q" * int(rng.integers(0, 70)) for n in sizes]
        found, begins = texts_word_hashes(texts)
        assert found.tolist() == [h for t in texts for h in word_hashes(words(t)).tolist()]
        assert np.diff(begins).tolist() == [len(words(t)) for t in texts] and begins[0] == 0


def test_regions_are_compared_together():
    rng = np.random.default_rng(6)
    ours, others = [], []
    for k in range(60):
        mine = rng.integers(1, 1 << 23, int(rng.integers(10, 200)))
        theirs = mine.tolist()
        for at in rng.integers(0, len(mine), k % 4).tolist():
            theirs[at : at + 5] = rng.integers(1, 1 << 23, 4 + k % 3).tolist()
        ours.append(mine)
        others.append(np.array([0, *theirs, *[0] * 9])[: len(mine) + 2])
    sizes, found = np.array([len(x) for x in ours]), []
    for begin, mine, theirs in zip((np.cumsum(sizes) - sizes).tolist(), ours, others, strict=True):
        found += [(begin + s, a) for s, a in zip(*(x.tolist() for x in passages.agreeing_passages(mine, theirs)), strict=True)]
    together = passages.agreeing_passages(np.concatenate(ours), np.concatenate(others), sizes)
    assert found and list(zip(*(x.tolist() for x in together), strict=True)) == found


def test_rows_that_repeat_a_text_have_its_passages(spark):
    docs = []
    for i in range(6):
        shared = prose(8000 + i, 60, 5000).split()
        docs += [(10 * i + k, " ".join([*part, prose(8100 + 10 * i + k, 30, 5000)])) for k, part in enumerate((shared[:45], shared, shared, changed(shared, 30, "insert")))]
    expected = sorted(passages.repeats(documents(spark, *docs)).collect())
    assert {r.doc_id % 10 for r in expected} >= {2, 3}
    found = passages.repeats(documents(spark, *docs, *docs, *docs).repartition(5)).collect()
    covered = defaultdict(set)
    for r in found:
        covered[r.doc_id] |= set(range(r.first_word, r.end_word))
    assert len(found) == len(set(found))
    assert {(r.doc_id, r.other_id) for r in found} == {(r.doc_id, r.other_id) for r in expected}
    assert all(covered[r.doc_id] >= set(range(r.first_word, r.end_word)) for r in expected)


def test_agreement_is_jaccard_of_passages():
    rng = np.random.default_rng(5)
    size, outcomes = passages.PASSAGE, set()
    for _ in range(200):
        shared = [f"w{k}" for k in rng.integers(0, 10**6, 80)]
        other = list(shared)
        if rng.integers(0, 2):
            other[int(rng.integers(0, 80))] = "changed"
        at, more = int(rng.integers(0, 80)), int(rng.integers(0, 2))
        other[at : at + 1 - more] = ["new"] * more
        ours, theirs = (windows(word_hashes([w.encode() for w in x]), passages.SHINGLE) & np.uint64(0xFFFFFF) for x in (shared, other))
        ours, theirs = ours.astype(np.int64), theirs.astype(np.int64)
        n = min(len(ours), len(theirs))
        ours, padded = ours[:n], np.concatenate(([0], theirs, [0, 0, 0]))[: n + 2]
        expected = set()
        for s in range(n - size + 1):
            for t in (s, s + 1, s + 2):
                a, b = set(ours[s : s + size].tolist()), set(padded[t : t + size].tolist())
                if 5 * len(a & b) >= 4 * len(a | b):
                    expected.add(s)
        assert set(passages.agreeing_passages(ours, padded)[0].tolist()) == expected
        outcomes.add(0 < len(expected) < n - size + 1)
    assert outcomes == {True, False}


def test_pipeline(spark):
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    first = {i for i, (_, c) in linked({i: r.text for i, r in docs.items()}).items() if i == c}
    leaks = {r.doc_id for r in queries.benchmark_leaks(spark, SF_DIR).collect()}
    assert set(out) == first - leaks
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language-id", "near-duplicates", "decontamination", "secrets", "tokens"]


def test_stages_take_odd_rows(spark):
    rows = [(20, prose(1, 60), "en", "a"), (21, prose(1, 60), "en", "a"), (22, "token = abcdefgh " + prose(77, 9000), None, "a"), *ODD]
    docs = documents(spark, *rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    out = {r.doc_id for r in docs.collect()}
    assert 20 in out and 21 not in out and 22 in out and 1 not in out


def test_stages_tell_rows_of_one_id_apart(spark):
    one, other, third = prose(301, 80, 5000), prose(302, 80, 5000), prose(303, 80, 5000)
    near = one + " more"
    rows = [(30, one), (30, one), (30, other), (31, near), (30, third), (None, third), (None, prose(304, 80, 5000)), (None, near)]
    out = corpus_pipeline.near_duplicates(spark, documents(spark, *rows), SF_DIR).collect()
    expected = [(30, one), (30, other), (30, third), (None, prose(304, 80, 5000))]
    assert sorted((r.doc_id or 0, r.text) for r in out) == sorted((i or 0, t) for i, t in expected)

    leak = max((r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()), key=len)
    rows = [(40, leak), (40, one), (None, "see: " + leak), (None, other), (None, None)]
    out = corpus_pipeline.decontaminate(spark, documents(spark, *rows), SF_DIR).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == sorted([(40, one), (0, other), (0, "")])


@pytest.mark.parametrize("n", [3, 255, 1020, 1030, 4100, 20_000])
def test_outlines_never_rule_out_what_is_common(n):
    rng = np.random.default_rng(n)
    mine = rng.integers(0, 1 << 63, n).astype(np.uint64)
    others = [np.concatenate([mine[: n - cut], rng.integers(0, 1 << 63, more).astype(np.uint64)]) for cut, more in ((0, n // 5), (n // 2, n // 3), (n // 5, 0))]
    for other in others:
        rows = np.frombuffer(jaccard.outline(other), np.uint8)[None]
        bound = jaccard._least_sums(np.frombuffer(jaccard.outline(mine), np.uint8), rows)[0]
        assert bound >= len(np.intersect1d(mine, other))

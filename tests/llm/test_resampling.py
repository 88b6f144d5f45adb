"""Importance resampling: against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.rows import LONG, ODD, documents, prose
from valuelens.llm import resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = ["", None, "one", "Two words", "a--b__c ÄÖ straße 漢字 🙂x", "x" * 100 + " y " + "é" * 200 + " z", "\x00a\x7fb", LONG, "aB" * 70]


def plain_buckets(text):
    words = WORD.findall((text or "").encode().lower())
    return sorted(zlib.crc32(w) % 10_000 for w in words + [a + b" " + b for a, b in zip(words, words[1:])])


def plain_scores(rows, target):
    counted = [(i, plain_buckets(t)) for i, t in rows]
    corpus = Counter(b for _, buckets in counted for b in buckets)
    wanted = Counter(b for t in target for b in plain_buckets(t))
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((corpus[b] + 1) * (t + 10_000)))) for b in range(10_000)]
    found = []
    for i, buckets in counted:
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        found.append((i, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    return found


@pytest.mark.parametrize("block", [16, 1000, 1 << 20])
def test_windows_whatever_the_blocks(monkeypatch, block):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", block)
    found, singles = [[] for _ in TEXTS], Counter()
    for first, _, numbers, buckets, single in resampling.features(TEXTS):
        for n, b in zip(numbers.tolist(), buckets.tolist()):
            found[first + n].append(b)
        singles.update((first + numbers[single]).tolist())
    for n, text in enumerate(TEXTS):
        assert sorted(found[n]) == plain_buckets(text)
        assert singles[n] == len(WORD.findall((text or "").encode().lower()))


def test_offsets_are_those_of_the_words():
    data = "a é-漢字 x🙂y".encode()
    assert [data[s:e] for s, e in resampling.word_offsets(data).tolist()] == WORD.findall(data)


def test_every_row_has_a_score_and_the_highest_a_rank(spark):
    rows = [*ODD, *((100 + i, prose(i, 15 + i, 50)) for i in range(40))]
    target = spark.createDataFrame([(1, prose(3, 30, 50)), (2, None), (None, "")], "item_id long, text string")
    got = resampling.resample(documents(spark, *rows), target).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key) == sorted(
        plain_scores(rows, [prose(3, 30, 50)]), key=key
    )
    enough = sorted((r for r in got if r.n_words >= 20), key=lambda r: (-r.score, r.doc_id))
    drawn = [r.doc_id for r in sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])]
    assert drawn == [r.doc_id for r in enough][: 25 * len(enough) // 100]
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, len(drawn) + 1))


def test_empty_tables(spark):
    docs, target = documents(spark, *ODD), spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(docs, target).count() == len(ODD)
    assert resampling.resample(docs.where("false"), target).count() == 0


def test_shifted_crcs():
    for before, after in ((b"abc ", b"def"), (b" ", b"x" * 64)):
        crc = resampling.shifted(np.array([zlib.crc32(before)], np.uint32), np.array([len(after)])) ^ np.uint32(zlib.crc32(after))
        assert int(crc[0]) == zlib.crc32(before + after)

"""Tokens, languages, quality rules, licences: by row, against plain Python."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.rows import LONG, ODD, SF_DIR, documents, prose
from valuelens.llm import bpe, language, licenses, quality, queries

FILE = bpe.read_vocabulary(public_tokenizers.path(queries.VOCABULARY))
ODD_TEXTS = ["", "a", "Ünïcödé 漢字 🙂🙂", "aaaa" * 60, " \n\n  x", "<|endoftext|>", "'s 'll don't", "0123456789", LONG[:3000]]


@pytest.fixture(scope="module")
def library():
    ranks = bpe.Vocabulary(FILE).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_are_those_of_the_library(library):
    codec = bpe.Codec(FILE, public_tokenizers.PATTERN)
    for text in ODD_TEXTS:
        packed = codec.encode(text)
        assert bpe.unpack(packed) == library.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()


def test_pieces_are_remembered_from_the_second_time_on_and_rare_ones_forgotten(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 40)
    codec = bpe.Codec(FILE, public_tokenizers.PATTERN)
    first = " ".join(f"once{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500))
    assert bpe.unpack(codec.encode(first)) == library.encode_ordinary(first)
    assert len(codec.pieces) <= 5  # but for pieces that share a slot
    assert bpe.unpack(codec.encode(first * 3)) == library.encode_ordinary(first * 3)
    for i in range(200):
        text = f" often often x{chr(97 + i % 26)}{chr(97 + i // 26)}" * 2
        assert bpe.unpack(codec.encode(text)) == library.encode_ordinary(text)
        assert len(codec.pieces) + len(codec.pieces.older) <= 40
    assert " often" in codec.pieces or " often" in codec.pieces.older


@pytest.mark.parametrize("seed", range(20))
def test_appends_and_edits_give_what_a_new_encoding_gives(seed):
    vocabulary = bpe.Vocabulary(FILE)
    rng = np.random.default_rng(seed)
    data = rng.choice(list(b"abcdeinstr aeou"), 200).astype(np.uint8).tobytes()
    prefixes = bpe.Prefixes(vocabulary, data[:120])
    prefixes.append(data[120:])
    assert prefixes.ids() == vocabulary.merged(data)
    start = int(rng.integers(0, 190))
    redone = prefixes.replace(start, start + 7, b"ation")
    assert prefixes.ids() == vocabulary.merged(data[:start] + b"ation" + data[start + 7 :])
    assert redone <= len(data) - start


def test_token_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in queries.bpe_round_trip(spark, SF_DIR).collect():
        ids = np.array(library.encode_ordinary(texts[row.doc_id]), "<u4").tobytes()
        assert row.n_tokens == len(ids) // 4
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_odd_rows_have_tokens(spark):
    coded = bpe.decode(bpe.encode(documents(spark, *ODD), FILE, public_tokenizers.PATTERN), FILE, public_tokenizers.PATTERN)
    rows = coded.collect()
    assert len(rows) == len(ODD)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    both = bpe.round_trip(documents(spark, *ODD), FILE, public_tokenizers.PATTERN)
    assert sorted(both.columns) == sorted(coded.columns)
    assert sorted(map(repr, both.select(coded.columns).collect())) == sorted(map(repr, rows))


def test_languages_of_held_out_documents(spark):
    found = queries.language_id(spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(spark):
    docs = documents(spark, (1, "the cat and the hat", "en", None), (2, "der hund und die katze", "de", None), (3, None, "en", None), (4, "x", None, None))
    model = language.train(docs)
    assert model.languages == ("de", "en")
    rows = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(documents(spark, *ODD), model).collect()]
    assert len(rows) == len(ODD)
    assert all((p, s) == ("und", 0.0) for i, p, s in rows if i in (1, 2, 3))
    assert {p for i, p, _ in rows if i in (4, 6)} <= {"de", "en"}
    nothing = language.train(docs.where("false"))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.where("false"), model).count() == 0


def plain_counts(text):
    words = [w for w in (text or "").replace("\t", " ").replace("\r", " ").replace("\f", " ").replace("\v", " ").replace("\n", " ").split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated)


def test_quality_counts(spark):
    texts = [None, "", "a b c", "a b c a b c", "a a a a a", "x\nx\n \n\nx y", "#*$%&|<> 🙂é", "a b c d a b c e", prose(1, 300, 6)]
    rows = quality.document_counts(documents(spark, *enumerate(texts))).select("doc_id", "counts.*").collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id])


def test_hosts_are_shrunk_and_joined(spark):
    good = [(i, prose(i, 80), None, "good") for i in range(30)]
    bad = [(100 + i, "short" if i else prose(500, 80), None, "bad") for i in range(30)]
    few = [(200, "short", None, "few"), (201, prose(600, 80), None, None), (202, None, None, "few"), (203, "short", None, None)]
    rows = {r.id: r for r in quality.judge(documents(spark, *good, *bad, *few)).collect()}
    assert all(rows[i].kept for i in range(30)) and rows[201].kept
    assert rows[100].host_failed and not rows[100].base_failed and not rows[100].kept
    assert not rows[203].host_failed and not rows[203].kept
    assert quality.judge(documents(spark, *ODD)).count() == len(ODD)
    assert quality.judge(documents(spark, *ODD).where("false")).count() == 0


def test_licenses_of_odd_rows(spark):
    more = [(10, "All rights\nreserved. CC BY and cc-by; Released under the MIT licence\nreleased under the mit license!"), (11, "ALL RIGHTS RESERVED all rights reserved")]
    rows = {r.doc_id: r.licenses for r in licenses.scan(documents(spark, *ODD, *more)).collect() if r.doc_id is not None}
    assert (rows[1].n_words, rows[1].places, rows[1].blocks) == (0, [], [])
    assert sorted((p.label, p.word) for p in rows[10].places) == [("cc-by", 3), ("cc-by", 6), ("reserved", 0)]
    assert [(b.label, b.word, b.share) for b in rows[10].blocks] == [("mit", 13, 1.0)]
    assert [p.word for p in rows[11].places] == [0, 3]
    assert licenses.scan(documents(spark, *ODD).where("false")).count() == 0


def plain_blocks(tokens, templates):
    """By template, all starts of a block that meets it, with the share."""
    found = {}
    for label, text in templates.items():
        own = set(licenses.words(text))
        longest = len(licenses.words(text)) * 5 // 4
        for start in range(len(tokens)):
            shared = len(own & set(tokens[start : start + longest]))
            if own and 5 * shared >= 4 * len(own):
                found.setdefault(label, {})[start] = shared / len(own)
    return found


@pytest.mark.parametrize("seed", range(8))
def test_every_block_that_meets_a_template_is_found(seed):
    rng = np.random.default_rng(seed)
    templates = {"a": "x y z v w", "b": "x q", "c": "", "d": "x y x y z z q q r s t"}
    tokens = [bytes([c]) for c in rng.choice(list(b"xyzvwqrstnmopkl"), 400)]
    for frequencies in ({}, {b"x": 9, b"y": 1}, {b"z": 5, b"q": 7}):
        index = licenses.Index.build(templates, frequencies, licenses.THRESHOLD)
        blocks, expected = index.search(tokens), plain_blocks(tokens, templates)
        assert {b.label for b in blocks} == set(expected)
        for block in blocks:
            assert expected[block.label][block.word] == block.share
        for label, starts in expected.items():
            own = [b for b in blocks if b.label == label]
            assert max(b.share for b in own) == max(starts.values())
            # Every block lies at one that is reported, or overlaps it.
            reach = licenses.block_lengths(templates)[label]
            assert all(any(abs(s - b.word) < 2 * reach for b in own) for s in starts)


@pytest.mark.parametrize("label", ["bsd", "cc0", "mit-text", "apache-2.0-notice", "gpl-notice"])
def test_wrapped_notices_are_found_and_spread_words_are_not(spark, label):
    notice = licenses.TEMPLATES[label].split()
    wrapped = "\n * ".join(" ".join(notice[i : i + 9]).upper() for i in range(0, len(notice), 9))
    spread = " ".join(f"{w} {prose(i, 6)}" for i, w in enumerate(notice))
    released = "we released a lot of the work that was done under pressure by the driver with a license"
    docs = documents(spark, (1, f"{prose(1, 30)}\n/* {wrapped} */\n{prose(2, 30)}"), (2, spread), (3, released))
    rows = {r.doc_id: r.licenses.blocks for r in licenses.scan(docs).collect()}
    assert [(b.word, b.share) for b in rows[1] if b.label == label] == [(30, 1.0)]
    assert not rows[2] and not rows[3]


def test_empty_texts_have_no_ids(spark):
    coded = bpe.encode(documents(spark, (1, None), (2, "")), FILE, public_tokenizers.PATTERN)
    assert coded.where(F.length("ids") > 0).count() == 0


def test_languages_against_plain_counts(spark):
    from collections import Counter
    from math import exp, log

    from valuelens.llm.common import mix

    rng = np.random.default_rng(3)
    taught = [(i, "".join(rng.choice(list("abcdéß 漢." if i % 3 else "abxyzéA 1"), 40)), ["aa", "bb"][i % 3 > 0], None) for i in range(30)]
    asked = [(100 + i, "".join(rng.choice(list("abcdxyzéß 漢A1."), n))) for i, n in enumerate([1, 5, 30, 300, 3000] * 6)]

    def grams(text):
        kept = "".join(c if c.isalpha() else " " for c in text.lower())
        kept = "".join(c for i, c in enumerate(kept) if c != " " or (i and kept[i - 1] != " "))
        if not kept.strip():
            return []
        found = []
        for n in (1, 2, 3):
            for i in range(len(kept) - n + 1):
                total = 0
                for c in kept[i : i + n]:
                    total = total << 21 | ord(c)
                found.append(int(mix(np.array([total], np.uint64), n - 1)[0]) % language.BUCKETS)
        return found

    counts, n_docs = {"aa": Counter(), "bb": Counter()}, Counter(r[2] for r in taught)
    for _, text, lang, _ in taught:
        counts[lang].update(grams(text))
    found = language.identify(documents(spark, *asked), language.train(documents(spark, *taught))).collect()
    assert len(found) == len(asked)
    for r in found:
        own = grams(dict(asked)[r.doc_id])
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        logs = {
            lang: log(n_docs[lang] / 30) + sum(
                log((c[g] + language.SMOOTHING) / (c.total() + language.SMOOTHING * language.BUCKETS)) for g in own
            )
            for lang, c in counts.items()
        }
        best = max(logs.values())
        assert logs[r.lang_pred] >= best - 1e-2
        assert r.score == pytest.approx(exp(logs[r.lang_pred] - best) / sum(exp(x - best) for x in logs.values()), abs=2e-3)


@pytest.mark.parametrize("cells", [1, 100, 1 << 22])
def test_blocks_of_the_sparse_product_do_not_matter(monkeypatch, cells):
    rng = np.random.default_rng(1)
    model = language.Model(("a", "b", "c"), rng.standard_normal((language.BUCKETS, 3)).astype(np.float32), np.zeros(3, np.float32))
    texts = ["", None, "x", "hello world", "1 2", LONG[:5000], "ü"]
    expected = language.scores(model, texts)
    monkeypatch.setattr(language, "BLOCK_CELLS", cells)
    found = language.scores(model, texts)
    assert found[0] == expected[0] and np.allclose(found[1], expected[1])
    assert [x == "und" for x in found[0]] == [True, True, False, False, True, False, False]

"""Secrets, personal data, chat, benchmark leaks."""

import hashlib
import re

import numpy as np
import pytest

from tests.compare import differences, duck
from tests.llm.rows import LONG, ODD, SF_DIR, documents, prose
from valuelens.llm import chat, decontamination, pii, queries, secrets
from valuelens.llm.oracle import ORACLE

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
SECRETS = [
    "token = 'abcdef' and ToKeN:xyz and passwd=token=abcdefgh",
    "token: token = abcdefgh",
    "🙂 AKIA" + "A1" * 9 + " AKIAX " + "0123456789abcdef" * 2 + "g",
    "api_key=" + "f" * 30,
    "-----BEGIN RSA PRIVATE KEY----- ghp_" + "G" * 36 + " xoxb-1234567890",
]


def plain_spans(text):
    found = []
    for rank, (kind, pattern, keep) in enumerate(
        [
            ("assign", ASSIGN, lambda m: len(m[2]) >= 6),
            ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
            ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
        ]
    ):
        found += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(text or "") if keep(m)]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


def test_secrets_against_plain_search(spark):
    texts = [*SECRETS, None, "", LONG, *(r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())]
    docs = documents(spark, *enumerate(texts))
    base = tuple(r.kind for r in secrets.BASE_RULES)
    rows = secrets.scan(docs).select("doc_id", "spans", secrets.listed("spans", base).alias("base")).collect()
    assert {r.doc_id: r.base for r in rows} == {i: ",".join(plain_spans(t)) for i, t in enumerate(texts)}
    kinds = {s.kind for r in rows if r.doc_id == 4 for s in r.spans}
    assert kinds == {"private_key", "github", "slack"}


def test_odd_rows_keep_their_number(spark):
    twice = [(7, SECRETS[0]), (7, SECRETS[0]), (None, SECRETS[0]), (7, "clean")]
    rows = secrets.scan(documents(spark, *ODD, *twice)).collect()
    assert len(rows) == len(ODD) + 4 and sum(len(r.spans) == 2 for r in rows) == 3
    assert secrets.scan(documents(spark, *ODD).where("false")).count() == 0


def test_redaction(spark):
    [row] = secrets.scan(documents(spark, (1, "é token=abcdef. " + "0" * 30))).select(secrets.redacted().alias("t")).collect()
    assert row.t == "é [assign] [hex]"


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_no_match_without_the_trigrams(rule):
    pattern = re.compile(rule.pattern, re.A)
    query = secrets.trigram_query(rule.pattern)
    jwt = "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + "." + "c" * 9
    for text in [*SECRETS, "AIza" + "b" * 35, jwt]:
        if pattern.search(text) and query:
            assert any(all(t in text.lower() for t in q) for q in query)


PRIVATE = "Mr. John Smith (john.smith@mail.org, +1 (212) 555-0199) paid with 4111 1111 1111 1111 from 10.20.30.40."


def test_surrogates(spark):
    again = "JOHN.SMITH@MAIL.ORG or 4111-1111-1111-1111; Frau Иванова Анна"
    rows = [(51, PRIVATE), (52, again), (53, "nothing here 2024"), (53, PRIVATE), (None, again), *ODD]
    out = pii.replace(documents(spark, *rows), "key").collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r.text)
    assert "nothing here 2024" in by[53] and by[51][0] in by[53]
    text = by[51][0]
    for value in ("John", "Smith", "mail.org", "212", "4111 1111", "10.20.30.40"):
        assert value not in text
    assert re.fullmatch(r"Mr\. \w+ \w+ \(\w+\.\w+@\w+\.org, \+1 \(\d{3}\) \d{3}-\d{4}\) paid with 4\d{3}( \d{4}){3} from [\d.]+\.", text)
    assert text.split(" ")[1] in pii.NAMES["m latin"].split()
    card = re.search(r"4\d{3}( \d{4}){3}", text)[0].replace(" ", "")
    assert sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(card[::-1])) % 10 == 0
    mail, other = re.search(r"\S+@\S+?(?=,)", text)[0].strip("("), by[52][0]
    assert mail.upper() in other and card in other.replace("-", "")
    assert re.search(r"Frau [А-Я]", other)
    assert pii.replace(documents(spark, *rows).where("false"), "key").count() == 0


def test_surrogates_are_one_to_one_even_if_draws_collide(spark, monkeypatch):
    from pyspark.sql import functions as F

    real = pii.drawn
    monkeypatch.setattr(pii, "drawn", lambda key: F.when(F.col("attempt") == 0, F.lit("1.1.1.1")).otherwise(real(key)))
    entities = spark.createDataFrame([("ip", f"9.9.9.{i}") for i in range(20)] + [("ip", "1.1.1.1")], "kind string, value string")
    rows = pii.surrogates(entities, "key").collect()
    assert len(rows) == len({r.surrogate for r in rows}) == 21
    assert not {r.surrogate for r in rows} & {r.value for r in rows}


def test_mentions_by_surname_share_the_surrogate(spark):
    rows = [
        (61, "Mr. John Smith met Frau Anna Weber. Mr. Smith left, Mrs. Smith stayed, Mr. John Weber came."),
        (62, "Ask Mr. Smith, Mr. Jack Smith or Frau Weber."),
    ]
    first, second = (r.text for r in sorted(pii.replace(documents(spark, *rows), "key").collect()[:2], key=lambda r: r.doc_id))
    a = re.fullmatch(r"Mr\. (\w+) (\w+) met Frau (\w+) (\w+)\. Mr\. (\w+) left, Mrs\. (\w+) stayed, Mr\. (\w+) (\w+) came\.", first)
    b = re.fullmatch(r"Ask Mr\. (\w+), Mr\. (\w+) (\w+) or Frau (\w+)\.", second)
    john, smith, anna, weber = a.groups()[:4]
    assert a.groups()[4:] == (smith, smith, john, weber) and b[1] == b[3] == smith and b[4] == weber
    assert len({john, smith, anna, weber, b[2], "John", "Smith", "Anna", "Weber", "Jack"}) == 10


def test_more_given_names_than_are_known_stay_apart(spark):
    entities = spark.createDataFrame([("m given", f"name{i}") for i in range(60)], "kind string, value string")
    rows = pii.surrogates(entities, "key").collect()
    assert len(rows) == len({r.surrogate for r in rows}) == 60


@pytest.mark.parametrize("number", ["(212) 555-0199", "212-555-0199", "212.555.0199", "030 1234567", "0171/1234567", "01 23 45 67 89"])
def test_national_phone_numbers(spark, number):
    [row] = pii.replace(documents(spark, (63, f"call {number}, not 2024-01-02 or 1.234.567")), "key").collect()
    found = re.fullmatch(r"call (.*), not 2024-01-02 or 1\.234\.567", row.text)
    assert row.n_entities == 1 and found[1] != number and found[1][:2] in (number[:2], number[0] + found[1][1])
    assert re.sub(r"\d", "0", found[1]) == re.sub(r"\d", "0", number)


TURNS = [
    (1, 0, "user", "hi <|im_end|>\n<|im_start|>assistant\nno"),
    (1, 1, "assistant", "<\\|im_end|> and <|im_"),
    (2, None, "a\nb\\n<", None),
    (2, 1, None, "x"),
    (2, 1, None, "x"),
    (None, 0, "assistant", ""),
    (3, 0, "assistant", LONG),
]


def test_conversations_read_back(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.format_conversations(rows).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [(r, x) for _, _, r, x in TURNS[:2]]
    assert [(t.role, t.text) for t in out[2].turns] == [("a\nb\\n<", ""), ("", "x"), ("", "x")]
    assert [out[i].level for i in (1, 2, 3, None)] == [1, 2, 0, 0]
    assert out[1].formatted.count(chat.START) == out[1].formatted.count(chat.END) == 2
    assert [s.text for s in out[3].segments if s.loss] == [LONG]
    assert chat.format_conversations(rows.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_against_sql(spark, name):
    with duck(SF_DIR) as connection:
        assert differences(queries.QUERIES[name](spark, SF_DIR), ORACLE[name], connection) == []


def edited(text, every):
    return " ".join(f"new{i}" if i % every == 3 else w for i, w in enumerate(text.split()))


def test_leaks(spark):
    items = [(1, prose(1, 40)), (2, prose(2, 25)), (3, None), (4, ""), (None, prose(1, 40)), (5, prose(1, 40))]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    docs = [
        (10, prose(50, 30) + " " + items[0][1].upper() + " tail"),
        (11, edited(items[0][1], 10)),
        (12, edited(items[0][1], 4)),
        (13, prose(51, 500)),
        (14, items[1][1]),
        (14, items[1][1]),
    ]
    found = sorted(tuple(r) for r in decontamination.find(documents(spark, *docs, *ODD), benchmark).collect())
    assert [r[:2] for r in found] == [(10, 1), (10, 5), (11, 1), (11, 5), (14, 2), (14, 2)]
    assert found[0] == (10, 1, 30, 70, 0) and found[2][4] == 4
    assert decontamination.find(documents(spark, *docs), benchmark.where("false")).count() == 0
    assert decontamination.find(documents(spark, *docs).where("false"), benchmark).count() == 0


def test_recall_of_edited_items():
    from valuelens.llm.common import word_hashes, words

    texts = [prose(1000 + i, 40) for i in range(60)]
    items = decontamination.Items(list(range(60)), [word_hashes(words(t)) for t in texts])
    found = [i for i, t in enumerate(texts) if any(m[0] == i for m in items.search("a b " + edited(t, 6) + " c"))]
    assert len(found) >= 57


def test_leaks_of_the_table_against_brute_force(spark):
    from valuelens.llm.common import word_hashes, words

    benchmark = {r.item_id: word_hashes(words(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in queries.benchmark_leaks(spark, SF_DIR).collect()}
    for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        text = word_hashes(words(row.text))
        for item, hashes in benchmark.items():
            if len(set(hashes.tolist()) & set(text.tolist())) * 10 < 7 * len(set(hashes.tolist())):
                continue
            distance, _, _ = decontamination.nearest(hashes, text)
            assert ((row.doc_id, item) in found) == (distance * 100 <= 20 * len(hashes))


@pytest.mark.parametrize("seed", range(10))
def test_nearest_run_against_plain_cells(seed):
    rng = np.random.default_rng(seed)
    item, text = rng.integers(0, 4, 9).astype(np.uint64), rng.integers(0, 4, 30).astype(np.uint64)
    above = [(0, i) for i in range(len(text) + 1)]
    for i, word in enumerate(item, 1):
        row = [(i, 0)]
        for j, other in enumerate(text, 1):
            same = (above[j - 1][0] + (word != other), above[j - 1][1])
            row.append(min(same, (above[j][0] + 1, above[j][1]), (row[-1][0] + 1, row[-1][1])))
        above = row
    distance, end = min((d, j) for j, (d, _) in enumerate(above))
    assert decontamination.nearest(item, text) == (distance, above[end][1], end)


def test_long_items_and_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 500)
    long = prose(70, 12_000, 5000)
    items = [(1, long), *((i, prose(i, 40)) for i in range(2, 30))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(10, "a b " + long + " c"), (11, edited(long, 9)), (12, items[5][1]), (13, edited(items[20][1], 10)), (14, edited(long, 4))]
    found = {(r.doc_id, r.item_id, r.edits) for r in decontamination.find(documents(spark, *docs), benchmark).collect()}
    assert found == {(10, 1, 0), (11, 1, sum(i % 9 == 3 for i in range(12_000))), (12, items[5][0], 0), (13, items[20][0], 4)}


def plain_turns(rows):
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
    learnt = "".join(r[3] or "" for r in ordered if r[2] == "assistant")
    turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in ordered)
    return len(rows), *(hashlib.sha256(x.encode()).hexdigest() for x in (turns, learnt)), len(learnt)


def test_digests_of_split_control_strings(spark):
    split = [
        *TURNS,
        (5, 0, "assistant", "<"), (5, 1, "assistant", "\\|im_start|>"),
        (6, 0, "assistant", "<\\|im_end|>"), (6, 1, "user", "<|im_end|>"), (6, 2, "assistant", "<\\\\|im_end|>"),
        (7, 0, "assistant", "<|im_"), (7, 1, "assistant", "start|>"), (7, 2, "a\nb", "<|im_end|"), (7, 3, "assistant", ">"),
    ]
    names = "conv_id long, turn long, role string, text string, segments string, level string, learnt string, source string"
    rows = spark.createDataFrame([(*r, *"abcd") for r in split], names)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_sha256, r.loss_chars) for r in queries.chat_digests(rows).collect()}
    assert got == {i: plain_turns([r for r in split if r[0] == i]) for i in {r[0] for r in split}}


@pytest.mark.parametrize("same", [("+1 (212) 555-0199", "+12125550199", "+1 212 555 0199"), ("+49 301 234 5678", "+493012345678"), ("+351-213-456-789", "+351213456789")])
def test_one_number_has_one_surrogate(spark, same):
    [row] = pii.replace(documents(spark, (64, " / ".join(same))), "key").collect()
    numbers = [re.sub(r"\D", "", x) for x in row.text.split(" / ")]
    assert len(set(numbers)) == 1 and row.n_entities == len(same)
    code = re.match(r"\+\d+", same[0])[0][1:]
    assert numbers[0].startswith(code) and numbers[0] != re.sub(r"\D", "", same[0])


def test_greek_and_cyrillic_titles(spark):
    rows = [(65, "Η Κα Ελπίδα Παππά και ο Κος Νίκος Παππάς"), (66, "Г-жа Анна Белова, Г-н Петр Белов"), (67, "Κυρία Ελπίδα Παππά")]
    texts = {r.doc_id: r.text for r in pii.replace(documents(spark, *rows), "key").collect()}
    found = re.fullmatch(r"Η Κα (\w+) (\w+) και ο Κος (\w+) (\w+)", texts[65])
    assert found[1] in pii.NAMES["f greek"].split() and found[3] in pii.NAMES["m greek"].split()
    assert texts[67] == f"Κυρία {found[1]} {found[2]}"
    found = re.fullmatch(r"Г-жа (\w+) (\w+), Г-н (\w+) (\w+)", texts[66])
    assert found[1] in pii.NAMES["f cyrillic"].split() and found[3] in pii.NAMES["m cyrillic"].split()


def test_surrogates_of_the_table_against_plain_search(spark):
    """What lies between mentions stays; mentions and surrogates are one to one, of one form, and another key gives others."""
    import regex

    plain = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    pattern = regex.compile(regex.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), pii.ANY))
    pairs = {}
    for key in ("one", "two"):
        known = pairs[key] = {}
        for r in pii.replace(spark.read.parquet(f"{SF_DIR}/documents.parquet"), key).collect():
            found = list(pattern.finditer(plain[r.doc_id]))
            assert r.n_entities == len(found)
            at = 0
            for k, m in enumerate(found):
                between = plain[r.doc_id][found[k - 1].end() if k else 0 : m.start()]
                assert r.text.startswith(between, at)
                at += len(between)
                rest = plain[r.doc_id][m.end() : found[k + 1].start() if k + 1 < len(found) else None]
                end = r.text.index(rest, at) if rest else len(r.text)
                assert known.setdefault(m[0], r.text[at:end]) == r.text[at:end]
                at = end
    assert pairs["one"] and set(pairs["one"]) == set(pairs["two"])
    for known in pairs.values():
        assert len({v.lower() for v in known.values()}) == len({k.lower() for k in known})
        assert not set(known) & set(known.values())
        for mention, surrogate in known.items():
            if "@" not in mention and "." not in mention:
                assert re.sub(r"\d", "0", mention) == re.sub(r"\d", "0", surrogate)
    assert sum(pairs["one"][m] == pairs["two"][m] for m in pairs["one"]) * 10 < len(pairs["one"])

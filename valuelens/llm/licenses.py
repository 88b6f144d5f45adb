"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is a run of words of the whole text, over line ends, up to a quarter longer than a template (length filter); it meets the
template when it holds at least the threshold's share of the template's distinct words. Words are ordered by how many
documents of the whole corpus hold them, rarest first. A block that meets the template must hold one of the first words of
that order (prefix filter), so that only blocks around such a word are looked at, and must be able to reach the threshold with
the words from the rarest one found on (positional filter).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from fractions import Fraction
from math import ceil, floor

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = Fraction(4, 5)
LONGEST = Fraction(5, 4)  # of a block, in lengths of its template
MAX_TEMPLATE_WORDS = 1_000_000  # of all templates together, as they go to every executor

PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: Notices as they stand at the head or foot of a text, and the terms that follow them. The licences' own words.
TEMPLATES = {
    "agpl-3.0": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero"
    " general public license as published by the free software foundation either version 3 of the license or at your option any"
    " later version",
    "apache-2.0": "licensed under the apache license version 2.0",
    "apache-2.0-notice": "licensed under the apache license version 2.0 the license you may not use this file except in compliance"
    " with the license you may obtain a copy of the license at http www apache org licenses license 2.0 unless required by"
    " applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without"
    " warranties or conditions of any kind either express or implied",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "bsd-disclaimer": "this software is provided by the copyright holders and contributors as is and any express or implied"
    " warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are"
    " disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special"
    " exemplary or consequential damages",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc-by-nc-text": "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "cc-by-sa-text": "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    "cc-by-text": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
    " license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied"
    " warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
    " provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl-notice": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general"
    " public license as published by the free software foundation either version 2.1 of the license or at your option any"
    " later version",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the rights to use"
    " copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the"
    " software is furnished to do so subject to the following conditions",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the"
    " warranties of merchantability fitness for a particular purpose and noninfringement",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was not"
    " distributed with this file you can obtain one at http mozilla org mpl 2.0",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use"
    " compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or"
    " non commercial and by any means",
}
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """Lower-cases A-Z; every byte of a character beyond ASCII belongs to a word."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def template_sets(templates: dict[str, str]) -> dict[str, frozenset[bytes]]:
    sets = {label: frozenset(words(text)) for label, text in templates.items()}
    if sum(map(len, sets.values())) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    return {label: s for label, s in sets.items() if s}


def block_lengths(templates: dict[str, str]) -> dict[str, int]:
    """How many words a block has at most that can meet each template."""
    return {label: floor(LONGEST * len(words(text))) for label, text in templates.items()}


def word_frequencies(docs: DataFrame, text_col: str, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """Documents of the whole table that hold each word of the templates: summed by tasks, then by Spark."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                sums.update(shared.value.intersection(words(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in sums], pa.string()), pa.array(list(sums.values()), pa.int64())], names=["word", "n"]
        )

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word string, n long")
    got = rows.groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row per template word at most
    return {r.word.encode(): r.n for r in got}


@dataclass(frozen=True)
class Block:
    label: str
    word: int
    end: int
    share: float


@dataclass(frozen=True)
class Index:
    """Templates as words in the global order, with the number of words that a block needs and may have."""

    ordered: dict[str, tuple[bytes, ...]]
    needed: dict[str, int]
    lengths: dict[str, int]

    @staticmethod
    def build(templates: dict[str, str], frequencies: dict[bytes, int], threshold: Fraction) -> Index:
        sets = template_sets(templates)
        ordered = {t: tuple(sorted(s, key=lambda w: (frequencies.get(w, 0), w))) for t, s in sets.items()}
        return Index(ordered, {t: ceil(threshold * len(s)) for t, s in sets.items()}, block_lengths(templates))

    def search(self, tokens: list[bytes]) -> list[Block]:
        """By template the places where blocks meet it, one after the other: of blocks that overlap, the best, then the first."""
        held, found = set(tokens), []
        for label, template in self.ordered.items():
            needed = self.needed[label]
            prefix = held.intersection(template[: len(template) - needed + 1])
            if prefix and len(tokens) >= needed and len(held.intersection(template)) >= needed:
                found += self._blocks(label, tokens, prefix)
        return found

    def _blocks(self, label: str, tokens: list[bytes], prefix: set[bytes]) -> Iterator[Block]:
        """Blocks that begin with a word of the template; others hold no more than the one that begins at their first."""
        template, needed, length = self.ordered[label], self.needed[label], self.lengths[label]
        rank = {word: place for place, word in enumerate(template)}
        rare = [i for i, word in enumerate(tokens) if word in prefix]
        best: Block | None = None
        low = 0
        while low < len(rare):  # the words within reach of rare ones that are near each other
            high = low
            while high + 1 < len(rare) and rare[high + 1] - rare[high] < length:
                high += 1
            first, last = max(0, rare[low] - length + 1), min(len(tokens), rare[high] + length)
            at = [i for i in range(first, last) if tokens[i] in rank]
            counts: Counter[int] = Counter()
            end = 0
            for start in at:
                while end < len(at) and at[end] < start + length:
                    counts[rank[tokens[at[end]]]] += 1
                    end += 1
                if len(counts) >= needed and len(template) - min(counts) >= needed:
                    block = Block(label, start, min(start + length, len(tokens)), len(counts) / len(template))
                    if best and start < best.end:
                        best = max(best, block, key=lambda b: (b.share, -b.word))
                    else:
                        if best:
                            yield best
                        best = block
                place = rank[tokens[start]]
                counts[place] -= 1
                if not counts[place]:
                    del counts[place]
            low = high + 1
        if best:
            yield best


def places(tokens: list[bytes], phrases: dict[str, tuple[bytes, ...]]) -> list[tuple[str, int]]:
    """Where a phrase's words stand one after the other, by label and first word."""
    held, found = set(tokens), []
    for label, phrase in phrases.items():
        if phrase and held.issuperset(phrase):
            at = -1
            for _ in range(tokens.count(phrase[0])):
                at = tokens.index(phrase[0], at + 1)
                if tuple(tokens[at : at + len(phrase)]) == phrase:
                    found.append((label, at))
    return found


def scan(
    docs: DataFrame,
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """Adds ``licenses``: n_words, places (label, word), blocks (label, word, end, share).

    ``places`` are those of phrases, by word of the text from 0; ``blocks`` are runs of words, from the first up to the
    end, that meet a template; of those of one template that overlap, the one with the highest share, then the first. Null and empty
    texts have none. A template without words meets nothing. Rows are independent but for the frequencies, which change the order
    of work and never a result. A column ``licenses`` is replaced.
    """
    sets = template_sets(templates)
    frequencies = word_frequencies(docs, text_col, frozenset().union(*sets.values()))
    shared = docs.sparkSession.sparkContext.broadcast(
        (Index.build(templates, frequencies, threshold), {label: tuple(words(p)) for label, p in phrases.items()})
    )

    @F.pandas_udf(
        "n_words long, places array<struct<label: string, word: long>>,"
        " blocks array<struct<label: string, word: long, end: long, share: double>>"
    )
    def run(texts: pd.Series) -> pd.DataFrame:
        index, phrase_words = shared.value
        rows = []
        for text in texts:
            tokens = words(text)
            at = [{"label": label, "word": i} for label, i in places(tokens, phrase_words)]
            rows.append((len(tokens), at, [asdict(block) for block in index.search(tokens)]))
        return pd.DataFrame(rows, columns=["n_words", "places", "blocks"])

    return docs.withColumn("licenses", run(F.col(text_col).cast("string")))

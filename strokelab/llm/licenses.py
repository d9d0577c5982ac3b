"""Licence scans: base phrases, and licence templates found by a positional index of their rarest words.

Corpus frequencies of the templates' words (a fixed, small vocabulary) are counted over all documents.  A template is a
list of passages (a notice has one, a licence text one for each clause); each passage is indexed by its ``n_rare`` words of
highest IDF with their positions.  A text's occurrences of indexed words vote for (passage, text position - passage
position); alignments that enough different rare words agree on are verified word by word: at least ``agree`` of the
passage's IDF weight must stand there.  A template is found where one of its passages with a mandatory phrase is, with all
mandatory phrases of that passage; its score is the share of its whole IDF weight that was found.

Defined results: null and empty texts have no words, labels are empty strings and places null; repeated rows get the
same result; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrase and label.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Fixed values.  Licence notices and texts: label, then passages, each with the phrases that must stand in it (none: the
#: passage counts only beside one that has some).
TEMPLATES = (
    ("mit", ("released under the mit license", ("mit license",))),
    (
        "mit",
        ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "free of charge")),
        ("to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", ()),
        ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ()),
        ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", ()),
        ("in no event shall the authors or copyright holders be liable for any claim damages or other liability", ()),
    ),
    (
        "isc",
        ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
        ("provided that the above copyright notice and this permission notice appear in all copies", ()),
        ("the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness", ()),
    ),
    ("apache-2", ("licensed under the apache license version 2 0", ("apache license version 2",))),
    (
        "apache-2",
        ("you may not use this file except in compliance with the license", ("in compliance with the license",)),
        ("you may obtain a copy of the license at http www apache org licenses license 2 0", ()),
        ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", ()),
        ("see the license for the specific language governing permissions and limitations under the license", ()),
    ),
    ("cc-by-nc", ("licensed under cc by nc 4 0", ("cc by nc",))),
    ("cc-by-nc", ("licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",))),
    ("cc-by", ("licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",))),
    ("cc-by-sa", ("licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",))),
    ("gpl-3", ("this work is licensed under the gnu general public license version 3", ("general public license", "version 3"))),
    ("gpl-2", ("this work is licensed under the gnu general public license version 2", ("general public license", "version 2"))),
    (
        "gpl",
        ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
        ("is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", ()),
        ("you should have received a copy of the gnu general public license along with this program", ()),
    ),
    ("lgpl", ("licensed under the gnu lesser general public license", ("gnu lesser general public license",))),
    ("agpl-3", ("licensed under the gnu affero general public license version 3", ("gnu affero general public license",))),
    ("mpl-2", ("subject to the terms of the mozilla public license version 2 0", ("mozilla public license",)), ("if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", ())),
    (
        "bsd",
        ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
        ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ()),
        ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ()),
        ("are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages", ()),
    ),
    (
        "zlib",
        ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", ("permission is granted to anyone", "redistribute it freely")),
        ("the origin of this software must not be misrepresented you must not claim that you wrote the original software", ()),
        ("altered source versions must be plainly marked as such and must not be misrepresented as being the original software", ()),
    ),
    ("unlicense", ("this is free and unencumbered software released into the public domain", ("free and unencumbered software",)), ("anyone is free to copy modify publish use compile sell or distribute this software", ())),
)

_SEPARATE = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256)).translate(
    bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
)


def words_of(text: str | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode().translate(_SEPARATE).split()


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Starts of a phrase's words, standing consecutively."""
    out, at, n = [], -1, len(phrase)
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return out
        if words[at : at + n] == phrase:
            out.append(at)


class RareIndex:
    """Postings (word -> passage, position) of each passage's words of highest IDF."""

    def __init__(self, frequencies: dict[str, int], n_docs: int, templates=TEMPLATES, n_rare: int = 4, agree: float = 0.8):
        self.labels = [label for label, *_ in templates]
        # template, words, mandatory phrases
        self.passages = [(i, p.encode().split(), [m.encode().split() for m in must]) for i, (_, *passages) in enumerate(templates) for p, must in passages]
        self.idf = {w: math.log((1 + n_docs) / (1 + frequencies.get(w.decode(), 0))) for _, p, _ in self.passages for w in p}
        self.agree = agree
        self.weight = [sum(self.idf[w] for w in p) for _, p, _ in self.passages]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.votes = []
        for i, (_, p, _) in enumerate(self.passages):
            rare = sorted(dict.fromkeys(p), key=lambda w: (-self.idf[w], w))[:n_rare]
            self.votes.append(max(1, math.ceil(len(rare) / 2)))
            for at, w in enumerate(p):
                if w in rare:
                    self.postings[w].append((i, at))

    def matches(self, words: list[bytes]) -> dict[str, float]:
        """Labels found, each with the largest share of a template's IDF weight that agrees."""
        if self.postings.keys().isdisjoint(words):
            return {}
        seen: dict[tuple[int, int], set] = defaultdict(set)
        for at, w in enumerate(words):
            for i, p in self.postings.get(w, ()):
                seen[i, at - p].add(w)
        best: dict[int, float] = {}  # by passage
        named = set()
        for (i, start), rare in seen.items():
            if len(rare) < self.votes[i]:
                continue
            template, passage, must = self.passages[i]
            same = sum(self.idf[w] for p, w in enumerate(passage) if 0 <= start + p < len(words) and words[start + p] == w)
            if same < self.agree * self.weight[i]:
                continue
            here = words[max(0, start) : max(0, start + len(passage))]
            if not all(places(here, p) for p in must):
                continue
            best[i] = max(same, best.get(i, 0.0))
            if must:
                named.add(template)
        out: dict[str, float] = {}
        for t in named:
            parts = [i for i, (template, *_) in enumerate(self.passages) if template == t]
            weight = sum(self.weight[i] for i in parts)
            score = sum(best.get(i, 0.0) for i in parts) / weight if weight else 1.0
            out[self.labels[t]] = max(score, out.get(self.labels[t], 0.0))
        return out


def find(text: str | None, index: RareIndex) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text."""
    words = words_of(text)
    joined = b" ".join(words)
    base: list[tuple[int, str]] = []
    for phrase, label in PHRASES:
        if phrase.encode() in joined:
            base += [(at, label) for at in places(words, phrase.encode().split())]
    base_labels = {label for _, label in base}
    labels, score = set(base_labels), 1.0 if base else 0.0
    for label, s in index.matches(words).items():
        labels.add(label)
        score = max(score, s)
    at = [a for a, _ in base]
    return len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), min(1.0, score)


def _frequencies(vocabulary: frozenset):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = Counter(), 0
        for b in batches:
            for t in b.column(0):
                total.update(vocabulary.intersection(words_of(t.as_py())))
                n += 1
        words = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words] + [None], pa.string()), pa.array([total[w] for w in words] + [n], pa.int64())], ["word", "n"])

    return run


def rare_index(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> RareIndex:
    """The index, by document frequencies over all documents; its vocabulary is the templates' own words."""
    vocabulary = frozenset(w.encode() for _, *passages in templates for p, _ in passages for w in p.split())
    counted = docs.select(F.col(text)).mapInArrow(_frequencies(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = dict(counted.collect())  # at most one row per template word
    return RareIndex(found, found.pop(None, 0) or 0, templates)


def _scan(index: RareIndex):
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*(find(t.as_py(), index) for t in b.column(1)), strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols, kinds)], ["_key", *names])

    return run


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES) -> DataFrame:
    """Per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    lean = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"_key {dict(docs.dtypes)[key]}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return lean.mapInArrow(_scan(rare_index(lean, "_text", templates)), schema).withColumnRenamed("_key", key)

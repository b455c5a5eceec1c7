"""License scan by a positional index of rare words.

Templates are licence texts and notices. One inverted index holds, for each of their words, which templates have it and where.
Over all documents it is counted how many hold each licence word; its IDF follows. The distinct licence words of a file are
looked up in the index, those of highest IDF first, and their weights are added up for the templates that have them: a template
of which the file lacks more than 1 - SHARE of the weight, wherever its words may stand, cannot match, and is done with. For the
others the RARE rarest words that the file shares with them are placed: each place of such a word and each of its postings give
a start of the template (place minus position), and the starts on which two words agree, give or take SLACK, go on (one, where
the file holds but one). So no list for all templates together lets one licence of a file hide another.

A start is a match if at least SHARE of the template's IDF stands where it should, give or take SLACK words, and then if the
mandatory phrase stands, word for word, within that span. The score is the best share that matched, and at least BASE_SCORE
where a base phrase stands; 0 without either. Base phrases and their labels are found in every text and counted at all places.

A null text is empty: no words, empty labels, null places, score 0. Repeated rows count each; other columns are not looked
at. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import raw, shipped, slices, tidied

RARE, SHARE, BASE_SCORE, SLACK = 12, 0.6, 0.5, 2

# Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Label, mandatory phrase, licence text or notice (public texts, as words).
TEMPLATES = [
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    ("bsd-2-clause", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3-clause", "neither the name of", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("cc-by-4.0", "creative commons attribution 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "licensed under cc by nc 4 0"),
    ("cc-by-nd-4.0", "creative commons attribution noderivatives 4 0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "licensed under cc by sa 4 0"),
    ("cc0-1.0", "cc0 1 0 universal", "this work is dedicated to the public domain under cc0 1 0 universal"),
    ("gpl-2.0", "gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0", "gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-3.0", "gnu general public license version 3", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("lgpl-2.1", "gnu lesser general public license", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "mit license", "released under the mit license"),
    ("mpl-2.0", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("unlicense", "released into the public domain", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software"),
]
#: Templates that differ in this word alone, of which a text must hold the template's own at its place.
DECIDING = {"gpl-2.0": ("version 2",), "gpl-3.0": ("version 3",)}

#: A-Z to a-z; what is neither an ASCII letter or digit nor part of a longer character becomes a space.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


Texts = Sequence[tuple[str, str, str]]


def vocabulary(templates: Texts) -> frozenset[bytes]:
    return frozenset(w for label, phrase, text in templates for part in (text, phrase, *DECIDING.get(label, ())) for w in part.encode().split())


def document_frequencies(docs: DataFrame, templates: Texts = tuple(TEMPLATES)) -> tuple[int, dict[bytes, int]]:
    """The number of documents and, for each licence word, of documents that hold it."""
    known = vocabulary(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for part in slices(batches):
            for text in raw(part.column(0)):
                held.update(known.intersection(words(text)))
                held[b""] += 1
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held]), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    sums = docs.select("text").mapInArrow(tidied(run), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row a licence word
    found = {r["word"].encode(): r["n"] for r in sums}
    return found.pop(b"", 0), found


class Index:
    """word -> [(template, positions)], and the IDF of the words."""

    def __init__(self, n: int, held: dict[bytes, int], templates: Texts = tuple(TEMPLATES)):
        self.idf = {w: math.log((n + 1) / (held.get(w, 0) + 0.5)) + 0.01 for w in vocabulary(templates)}
        self.labels = [label for label, *_ in templates]
        self.words = [text.encode().split() for *_, text in templates]
        self.phrases = [[p.encode().split() for p in (phrase, *DECIDING.get(label, ()))] for label, phrase, _ in templates]
        self.full = [sum(self.idf[w] for w in own) for own in self.words]
        self.postings: dict[bytes, list[tuple[int, np.ndarray]]] = {}
        for t, own in enumerate(self.words):
            for w in dict.fromkeys(own):
                self.postings.setdefault(w, []).append((t, np.array([k for k, x in enumerate(own) if x == w])))

    def matches(self, found: list[bytes]) -> dict[str, float]:
        """Label and matched share of each template that stands in these words."""
        shared = sorted(self.postings.keys() & set(found), key=lambda w: (-self.idf[w], w))
        weight, rare = [0.0] * len(self.words), [[] for _ in self.words]
        for w in shared:
            for t, positions in self.postings[w]:
                weight[t] += self.idf[w] * len(positions)
                if len(rare[t]) < RARE:
                    rare[t].append((w, positions))
        going_on = [t for t in range(len(self.words)) if weight[t] >= SHARE * self.full[t] - 1e-9]
        if not going_on:
            return {}
        lists: dict[bytes, list[int]] = {}
        for at, w in enumerate(found):
            if w in self.idf:
                lists.setdefault(w, []).append(at)
        places = {w: np.array(own, np.int64) for w, own in lists.items()}
        out: dict[str, float] = {}
        for t in going_on:
            starts = self.starts(rare[t], places)
            shares = self.shares(t, starts, places)
            good = shares >= SHARE
            good[good] = self.verified(t, starts[good], places)
            if good.any():
                out[self.labels[t]] = max(out.get(self.labels[t], 0.0), float(shares[good].max()))
        return out

    @staticmethod
    def starts(rare: list[tuple[bytes, np.ndarray]], places: dict[bytes, np.ndarray]) -> np.ndarray:
        """Where a template would start so that two of these words agree, or one if there is but one."""
        agreed: list[np.ndarray] = []
        for w, positions in rare:
            own = np.unique((places[w][:, None] - positions).ravel())
            agreed.append(np.unique((own[:, None] + np.arange(-SLACK, SLACK + 1)).ravel()))
        values, votes = np.unique(np.concatenate(agreed), return_counts=True)
        return values[votes >= min(2, len(rare))]

    def shares(self, t: int, starts: np.ndarray, places: dict[bytes, np.ndarray]) -> np.ndarray:
        """For each start the part of the template's IDF that stands where it should, give or take SLACK words."""
        got = np.zeros(len(starts))
        for position, w in enumerate(self.words[t]):
            own = places.get(w)
            if own is not None:
                at = np.searchsorted(own, starts + position - SLACK)
                near = own[np.minimum(at, len(own) - 1)]
                got += self.idf[w] * ((at < len(own)) & (near <= starts + position + SLACK))
        return got / self.full[t]

    def verified(self, t: int, starts: np.ndarray, places: dict[bytes, np.ndarray]) -> np.ndarray:
        """Whether all key phrases stand, word for word, within the span of each start."""
        sure = np.ones(len(starts), bool)
        for phrase in self.phrases[t]:
            at = places.get(phrase[0], np.zeros(0, np.int64))
            for k, w in enumerate(phrase[1:], 1):
                at = np.intersect1d(at, places.get(w, np.zeros(0, np.int64)) - k, assume_unique=True)
            if not len(at):
                return np.zeros(len(starts), bool)
            first = np.searchsorted(at, starts - SLACK)
            near = at[np.minimum(first, len(at) - 1)]
            sure &= (first < len(at)) & (near + len(phrase) <= starts + len(self.words[t]) + SLACK)
        return sure


def scan(docs: DataFrame, templates: Texts = tuple(TEMPLATES)) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of docs. templates: label, mandatory
    phrase and text each, lower-cased words; a list of any length, which is shipped to the workers."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    get = shipped(docs.sparkSession.sparkContext, Index(*document_frequencies(docs, templates), templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = get()
        phrases = [(b" " + p.encode() + b" ", label) for p, label in BASE.items()]
        for part in slices(batches):
            rows = []
            for text in raw(part.column(1)):
                found = words(text)
                line = b" " + b" ".join(found) + b" "
                starts, base = [], set()
                for phrase, label in phrases:
                    before, word, at = 0, 0, line.find(phrase)
                    while at >= 0:
                        word += line.count(b" ", before, at)
                        starts.append(word)
                        base.add(label)
                        before, at = at, line.find(phrase, at + 1)
                matched = index.matches(found)
                score = max([*matched.values(), BASE_SCORE if base else 0.0], default=0.0)
                rows.append((len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | matched.keys())), score))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select("doc_id", "text").mapInArrow(tidied(run), f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")

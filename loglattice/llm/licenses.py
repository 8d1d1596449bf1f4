"""License scans with a positional index of rare words.

The index holds each template's words with their positions. A file's words that are rare among the templates
(highest inverse document frequency) look up their postings; position in the file minus position in the
template proposes where the template would start. At each proposed start the words at the same relative
positions are intersected. Starts that lie close together, as after an inserted name, count as one match; it
stands if enough of the template agrees and its mandatory key phrases occur inside it word for word.
Phrases that must match in full are templates whose whole text is mandatory.

Defined results: null and empty texts have no words and no matches; repeated rows are scanned each; an empty
table gives an empty result. Other columns are ignored. A file is read whole; the index is fixed and small.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglattice.llm import tokens

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A word is rare if at most this many templates hold it.
RARE_IN = 3
MIN_MATCH = 0.7
SLACK = 8

# The phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

FSF_NOTICE = (
    "is free software you can redistribute it and or modify it under the terms of the {name} as published by the free software "
    "foundation either version {version} of the license or at your option any later version"
)

# Label, usual notice or title, key phrases that a match must hold.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction",
     ["permission is hereby granted", "without restriction"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met", ["redistribution and use", "source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted", ["permission to use copy modify", "with or without fee"]),
    ("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("lgpl", "licensed under the gnu lesser general public license version", ["gnu lesser general public license"]),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ["gnu affero general public license"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0"]),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
     ["attribution sharealike"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("gpl-2", "gnu general public license version 2 june 1991", ["general public license version 2"]),
    ("gpl-3", "gnu general public license version 3 29 june 2007", ["general public license version 3"]),
    ("lgpl", "gnu lesser general public license version 2 1 february 1999", ["lesser general public license version 2 1"]),
    ("lgpl", "gnu lesser general public license version 3 29 june 2007", ["lesser general public license version 3"]),
    ("agpl-3", "gnu affero general public license version 3 19 november 2007", ["affero general public license version 3"]),
    ("gpl-2", FSF_NOTICE.format(name="gnu general public license", version="2"), ["gnu general public license", "either version 2 of"]),
    ("gpl-3", FSF_NOTICE.format(name="gnu general public license", version="3"), ["gnu general public license", "either version 3 of"]),
    ("lgpl", FSF_NOTICE.format(name="gnu lesser general public license", version="2 1"), ["gnu lesser general public license", "either version"]),
    ("agpl-3", FSF_NOTICE.format(name="gnu affero general public license", version="3"), ["gnu affero general public license", "either version 3 of"]),
    ("mpl-2", "mozilla public license version 2 0", ["mozilla public license version 2 0"]),
    ("apache-2", "apache license version 2 0 january 2004", ["apache license version 2 0"]),
    ("bsd", "bsd 3 clause license", ["bsd 3 clause"]),
    ("bsd", "bsd 2 clause license", ["bsd 2 clause"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights",
     ["waived all copyright"]),
]


@dataclass
class Template:
    label: str
    words: list[str]
    phrases: list[list[str]] = field(default_factory=list)
    whole: bool = False


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate({c: c + 32 for c in range(65, 91)}))


def templates() -> list[Template]:
    whole = [Template(label, words_of(p), whole=True) for p, label in PHRASES.items()]
    return whole + [Template(label, words_of(t), [words_of(p) for p in ph]) for label, t, ph in NOTICES]


class Index:
    """Rare words of the templates with their postings (template, position)."""

    def __init__(self, items: list[Template]):
        self.items = items
        vocabulary = sorted({w for t in items for w in [*t.words, *(x for p in t.phrases for x in p)]})
        held = {w: sum(w in t.words for t in items) for w in vocabulary}
        self.idf = {w: math.log(len(items) / max(n, 1)) for w, n in held.items()}
        self.hasher = tokens.WordHasher(51)
        raw = [w.encode() for w in vocabulary]
        ends = np.cumsum([len(w) for w in raw])
        hashes = self.hasher(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, ends[:-1]], ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.number = {vocabulary[o]: i for i, o in enumerate(order.tolist())}
        self.ids = [np.array([self.number[w] for w in t.words]) for t in items]
        self.phrases = [[np.array([self.number[w] for w in p]) for p in t.phrases] for t in items]
        postings: list[list[tuple[int, int]]] = [[] for _ in vocabulary]
        for n, t in enumerate(items):
            highest = max(self.idf[w] for w in t.words)
            least = math.log(len(items) / RARE_IN)
            for q, w in enumerate(t.words):
                # Every template is reachable: its rarest words count as rare however many templates hold them.
                if self.idf[w] >= min(least, highest):
                    postings[self.number[w]].append((n, q))
        self.count = np.array([len(p) for p in postings])
        self.begin = np.cumsum(self.count) - self.count
        flat = [x for p in postings for x in p]
        self.template, self.place = (np.array(c, np.int64) for c in zip(*flat, strict=True))

    def numbers(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word in the index, or -1."""
        h = self.hasher(buf, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)

    def proposals(self, ids: np.ndarray) -> list[np.ndarray]:
        """For each template, the ascending starts at which some rare word would be in its place."""
        hit = np.flatnonzero(ids >= 0)
        hit = hit[self.count[ids[hit]] > 0]
        times = self.count[ids[hit]]
        which = np.repeat(self.begin[ids[hit]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        start = np.repeat(hit, times) - self.place[which]
        return [np.unique(start[self.template[which] == n]) for n in range(len(self.items))]

    def agreement(self, ids: np.ndarray, doc: np.ndarray, starts: np.ndarray, own: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Which words of a template stand at their relative positions, for starts proposed by documents `own`."""
        at = starts[:, None] + np.arange(len(words))
        inside = (at >= 0) & (at < len(ids))
        at = np.clip(at, 0, max(len(ids) - 1, 0))
        return inside & (ids[at] == words) & (doc[at] == own[:, None])

    def places_of(self, ids: np.ndarray, doc: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Starts of a phrase word for word, found through its rarest word."""
        rare = int(np.argmin(np.bincount(ids[ids >= 0], minlength=len(self.hashes))[words]))
        start = np.flatnonzero(ids == words[rare]) - rare
        own = doc[start + rare]
        return start[self.agreement(ids, doc, start, own, words).all(axis=1)] if len(start) else start


def _owners(starts: np.ndarray, ids: np.ndarray, doc: np.ndarray, index: Index, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts with the document of each rare word that proposed them; a start before its document keeps the latter."""
    rare = np.unique(index.place[index.template == n])
    at = starts[:, None] + rare
    ok = (at >= 0) & (at < len(ids))
    at = np.clip(at, 0, len(ids) - 1)
    ok &= ids[at] == index.ids[n][rare]
    row, col = np.nonzero(ok)
    pair = np.unique(np.stack([starts[row], doc[at[row, col]]], axis=1), axis=0)
    return pair[:, 0], pair[:, 1]


def scan(index: Index, buf: np.ndarray, offsets: np.ndarray, min_match: float = MIN_MATCH, slack: int = SLACK):
    """Word counts, and matches (document, template, first word, share of the template) of some texts."""
    starts, ends, doc = tokens.word_spans(buf, offsets, tokens.ALNUM)
    n_words = np.bincount(doc, minlength=len(offsets) - 1)
    begin = np.cumsum(n_words) - n_words
    ids = index.numbers(buf, starts, ends)
    found: list[tuple[int, int, int, float]] = []
    for n, proposed in enumerate(index.proposals(ids)):
        if not len(proposed):
            continue
        at, own = _owners(proposed, ids, doc, index, n)
        agree = index.agreement(ids, doc, at, own, index.ids[n])
        if index.items[n].whole:
            full = agree.all(axis=1)
            found += [(d, n, s - begin[d], 1.0) for s, d in zip(at[full].tolist(), own[full].tolist(), strict=True)]
            continue
        order = np.lexsort((at, own))
        at, own, agree = at[order], own[order], agree[order]
        first = np.flatnonzero(np.r_[True, (np.diff(at) > slack) | (np.diff(own) > 0)])
        last = np.r_[first[1:], len(at)] - 1
        share = np.logical_or.reduceat(agree, first, axis=0).mean(axis=1)
        good = share >= min_match
        for words in index.phrases[n] if good.any() else []:
            places = index.places_of(ids, doc, words)
            low = np.searchsorted(places, np.maximum(at[first] - slack, begin[own[first]]))
            limit = np.minimum(at[last] + len(index.ids[n]) + slack, (begin + n_words)[own[first]])
            good &= np.searchsorted(places, limit - len(words), side="right") > low
        for c in np.flatnonzero(good).tolist():
            d = int(own[first[c]])
            found.append((d, n, max(int(at[first[c]] - begin[d]), 0), float(share[c])))
    return n_words, found


MATCH = "array<struct<label:string,start:bigint,share:double>>"


def _scanner(min_match: float, slack: int):
    kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates())
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        for batch in batches:
            buf, offsets = tokens.text_bytes(batch.column("text"))
            for i, j in tokens.chunks(offsets):
                own = offsets[i : j + 1]
                n_words, found = scan(index, lower[buf[own[0] : own[-1]]], own - own[0], min_match, slack)
                whole: list[list] = [[] for _ in range(j - i)]
                other: list[list] = [[] for _ in range(j - i)]
                for d, n, start, share in sorted(found):
                    item = index.items[n]
                    (whole if item.whole else other)[d].append({"label": item.label, "start": start, "share": share})
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n_words, pa.int64()), pa.array(whole, kind), pa.array(other, kind)],
                    names=["doc_id", "n_words", "phrases", "notices"],
                )

    return run


def scan_licenses(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_match: float = MIN_MATCH, slack: int = SLACK
) -> DataFrame:
    """Rows (doc_id, n_words, phrases, notices): phrases matched in full and notices matched in part."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        _scanner(min_match, slack), f"doc_id bigint, n_words bigint, phrases {MATCH}, notices {MATCH}"
    )

"""Personal data by fixed patterns, extended by a skip-chain conditional random field.

The patterns find e-mail addresses, IP addresses, card numbers and phone numbers as they are usually written. What
they find in a document is evidence about the rest of it: a number that stands there once with its area code and
once without, or a handle repeated without its domain, is the same entity. So every token with a digit or an @
becomes a node of a random field with the labels of the four kinds or none. Neighbouring nodes share a chain
potential; nodes whose digits, last seven digits or name before the @ are equal share a skip potential, each with the next
of its like, so the number of edges is linear in the text. Tokens inside a pattern's match are known; loopy message
passing carries their labels along the edges, and a token whose belief in one kind is high enough becomes
a span of the method's own. Adjacent tokens of one kind make one span.

The field is trained by pseudo-likelihood on the patterns' matches in a sample of at most SAMPLE_DOCS documents that
hold a digit or an @ (the smallest hashes of id and text). A token that has others like it is seen twice, once without its own
features and its neighbours, so that repeats carry weight; a token outside all matches that is like one inside is not
taken for an example of anything. Only counts of distinct surroundings reach the
driver, the MAX_PATTERNS most frequent.

Defined results: null and empty texts hold nothing; matches of a kind are leftmost and do not overlap, and a match that
fails its kind's test is dropped without another try; different kinds may overlap; places are code points; rows that
repeat are scanned each; an empty table gives an empty result. Other columns are ignored. Texts are read whole;
memory is bounded by a chunk or by the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglattice.llm import crf, tokens

# The kinds in their order, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE_DOCS = 4000
MAX_PATTERNS = 20_000
# The most digits of a number whose tokens may be apart.
MOST_DIGITS = {"card": 19, "phone": 15}
# A token is given a kind if the field believes in it this much.
LEAST_BELIEF = 0.6
LEAST_DIGITS, LAST_DIGITS, LEAST_NAME = 4, 7, 4
STEP = np.uint64(0x9E3779B97F4A7C15)

SPACE_BELOW = np.array([c in b"\x20\x09\x0a\x0b\x0c\x0d" for c in range(256)])
DIGIT_STEPS = [1, 3, 4, 7, 9, 12, 16, 20, np.iinfo(np.int64).max]
# "hidden" stands alone in the second view of a training token.
FEATURES = (
    [f"digits from {n}" for n in DIGIT_STEPS[:-1]]
    + ["no digit", "letters", "digits only", "hyphen", "bracket", "one dot", "two dots", "four dots", "token before", "token after", "any"]
    + ["plus", "at", "dot after at", "three dots", "luhn", "hidden"]
)
HIDDEN = FEATURES.index("hidden")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", found.end() if found else at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time of each dotted number, from the left."""
    for chain in DOTTED.finditer(text):
        parts, at = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every match of the patterns, in that order."""
    out = [(s, 0, e) for s, e in _emails(text)] + [(s, 1, e) for s, e in _addresses(text)]
    for m in CARD.finditer(text):
        digits = _digits(m.group()) if len(m.group()) <= 37 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


class Field:
    """Nodes and edges of the texts of one chunk, and what the patterns say about them."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        text, points, self.at = tokens.code_points(buf, offsets)
        narrow = np.minimum(points, 255).astype(np.uint8)
        digit = (points >= 48) & (points <= 57)
        lower = points | np.uint32(32)
        letter = (lower >= 97) & (lower <= 122)
        starts, ends, doc = tokens.word_spans(narrow, self.at, ~SPACE_BELOW)

        def within(mask: np.ndarray) -> np.ndarray:
            upto = np.zeros(len(mask) + 1, np.int64)
            np.cumsum(mask, out=upto[1:])
            return upto

        n_digits, n_at = within(digit), within(points == 64)
        node = np.flatnonzero((n_digits[ends] > n_digits[starts]) | (n_at[ends] > n_at[starts]))
        self.token, self.doc, self.start, self.end = node, doc[node], starts[node], ends[node]

        def count(upto: np.ndarray) -> np.ndarray:
            return upto[self.end] - upto[self.start]

        self.spans: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
        self.known = np.full(len(node), -1)
        for d in np.unique(self.doc).tolist():
            first = int(self.at[d])
            self.spans[d] = base_spans(text[first : int(self.at[d + 1])])
            for s, kind, e in reversed(self.spans[d]):
                low, high = np.searchsorted(self.end, first + s, side="right"), np.searchsorted(self.start, first + e)
                self.known[low:high] = kind
        digits, letters, dots = count(n_digits), count(within(letter)), count(within(points == 46))
        next_to = np.zeros(len(node), bool)
        next_to[1:] = (np.diff(self.token) == 1) & (np.diff(self.doc) == 0)
        self.joined, self.digits = next_to, digits
        self.chain = np.stack([np.flatnonzero(next_to) - 1, np.flatnonzero(next_to)], axis=1)
        followed = np.zeros(len(node), bool)
        followed[self.chain[:, 0]] = True
        ats = np.flatnonzero(points == 64)
        at_place = np.r_[ats, len(points)][np.searchsorted(ats, self.start)]
        has_at = at_place < self.end
        dot_places = np.r_[np.flatnonzero(points == 46), len(points)]
        dot_after = has_at & (dot_places[np.searchsorted(dot_places[:-1], at_place)] < self.end)
        others = count(within(~digit & ~letter & (points < 128)))
        checked = np.zeros(len(node), bool)
        for i in np.flatnonzero((digits >= 12) & (digits <= 19) & (letters == 0)).tolist():
            checked[i] = luhn(_digits(text[self.start[i] : self.end[i]]))
        steps = np.array(DIGIT_STEPS)
        ranges = (digits[:, None] >= steps[:-1]) & (digits[:, None] < steps[1:])
        columns = [
            digits == 0, letters > 0, (letters == 0) & (digits + others == self.end - self.start), count(within(points == 45)) > 0,
            count(within((points == 40) | (points == 41))) > 0, dots == 1, dots == 2, dots >= 4, next_to, followed,
            np.ones(len(node), bool), count(within(points == 43)) > 0, has_at, dot_after, dots == 3, checked, np.zeros(len(node), bool),
        ]
        self.features = np.concatenate([ranges, np.stack(columns, axis=1)], axis=1)
        self.skip = self._alike(points, digit, letter, n_digits, digits, at_place, has_at)
        core = np.flatnonzero(digit | letter | (points == 43) | (points == 40))
        tail = np.flatnonzero(digit | letter | (points == 41))
        after = np.r_[core, len(points)][np.searchsorted(core, self.start)]
        self.core_start = np.minimum(after, self.end)
        self.core_end = np.r_[-1, tail][np.searchsorted(tail, self.end)] + 1

    def _alike(self, points, digit, letter, n_digits, digits, at_place, has_at) -> np.ndarray:
        """Skip edges: each node with the next one of its document that has an equal key of the same family."""
        roller = tokens.Roller(71)
        with np.errstate(over="ignore"):
            sums = roller.sums(points[digit].astype(np.uint64))
            low, high = n_digits[self.start], n_digits[self.end]
            many = np.flatnonzero(digits >= LEAST_DIGITS)
            whole = roller.spans(sums, low[many], high[many])
            long = np.flatnonzero(digits >= LAST_DIGITS)
            last = roller.spans(sums, high[long] - LAST_DIGITS, high[long])
            alnum = np.flatnonzero(digit | letter)
            sums = roller.sums((points[alnum] | np.uint32(32)).astype(np.uint64))
            low, high = np.searchsorted(alnum, self.start), np.searchsorted(alnum, np.where(has_at, at_place, self.end))
            named = np.flatnonzero((high - low >= LEAST_NAME) & (high - low > np.where(has_at, 0, digits)))
            name = roller.spans(sums, low[named], high[named])
            node = np.concatenate([many, long, named])
            family = np.repeat(np.arange(3, dtype=np.uint64), [len(many), len(long), len(named)])
            key = tokens.mix(np.concatenate([whole, last, name]) ^ tokens.mix(self.doc[node].astype(np.uint64) * STEP + family))
        order = np.lexsort((node, key))
        same = key[order][1:] == key[order][:-1]
        pairs = np.stack([node[order][:-1][same], node[order][1:][same]], axis=1)
        return np.unique(pairs, axis=0) if len(pairs) else pairs

    def graph(self) -> crf.Graph:
        return crf.Graph(self.features, self.chain, self.skip)

    def added(self, weights: crf.Weights, least: float) -> list[list[tuple[int, int, int]]]:
        """The method's own spans of every document."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in self.spans]
        if not len(self.token):
            return out
        belief = crf.marginals(self.graph(), weights, np.where(self.known < 0, -1, self.known + 1))
        kind = belief.argmax(axis=1)
        chosen = (kind > 0) & (belief.max(axis=1) >= least) & (self.known < 0) & (self.core_start < self.core_end)
        last, held = -2, 0
        for i in np.flatnonzero(chosen).tolist():
            d, k, n = int(self.doc[i]), int(kind[i]) - 1, int(self.digits[i])
            start, end = int(self.core_start[i] - self.at[d]), int(self.core_end[i] - self.at[d])
            near = last == i - 1 and self.joined[i] and kind[last] - 1 == k
            if near and held + n <= MOST_DIGITS.get(KINDS[k], 0):
                out[d][-1] = (out[d][-1][0], k, end)
                held += n
            else:
                out[d].append((start, k, end))
                held = n
            last = i
        return out


def _fields(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Field]]:
    buf, offsets = tokens.text_bytes(batch.column("text"))
    for i, j in tokens.chunks(offsets):
        own = offsets[i : j + 1]
        yield i, j, Field(buf[own[0] : own[-1]], own - own[0])


PATTERN = "features bigint, before int, after int, skip bigint, label int"


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training rows of all nodes, in one view or both; the number of alike neighbours of each label takes three bits, at most 7."""
    bits = np.int64(1) << np.arange(len(FEATURES))
    for batch in batches:
        for _, _, field in _fields(batch):
            n, label = len(field.token), field.known + 1
            before, after, skip = np.full(n, -1), np.full(n, -1), np.zeros((n, len(KINDS) + 1), np.int64)
            before[field.chain[:, 1]], after[field.chain[:, 0]] = label[field.chain[:, 0]], label[field.chain[:, 1]]
            for a, b in ((0, 1), (1, 0)):
                np.add.at(skip, (field.skip[:, a], label[field.skip[:, b]]), 1)
            # Whether a token that no pattern takes but that is like one they take is an entity is the field's to say.
            told = np.flatnonzero((label > 0) | (skip[:, 1:].sum(axis=1) == 0))
            packed = np.minimum(skip, 7) @ (np.int64(1) << (3 * np.arange(len(KINDS) + 1)))
            again = told[packed[told] > 0]
            blind, alone = np.full(len(again), bits[HIDDEN]), np.full(len(again), -1)
            columns = [
                np.r_[(field.features @ bits)[told], blind], np.r_[before[told], alone], np.r_[after[told], alone],
                np.r_[packed[told], packed[again]], np.r_[label[told], label[again]],
            ]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["features", "before", "after", "skip", "label"],
            )


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS) -> crf.Weights:
    """Weights learned from the patterns' matches in at most `sample` documents with a digit or an @."""
    some = docs.filter(F.col(text).rlike("[0-9@]")).select(
        F.col(text).alias("text"), F.xxhash64(F.col(doc_id).cast("string"), text).alias("draw")
    )
    upto = some.select("draw").distinct().orderBy("draw").limit(sample).agg(F.max("draw")).first()[0]
    seen = some.filter(F.col("draw") <= upto).select("text").mapInArrow(_surroundings, PATTERN) if upto is not None else None
    names = ["features", "before", "after", "skip", "label"]
    rows = []
    if seen is not None:
        counted = seen.groupBy(*names).count()
        rows = counted.orderBy(F.desc("count"), *names).limit(MAX_PATTERNS).collect()
    column = {n: np.array([r[n] for r in rows], np.int64) for n in [*names, "count"]} if rows else {}
    bits, labels = np.arange(len(FEATURES)), len(KINDS) + 1
    none = np.empty(0, np.int64)
    features, skip = column.get("features", none), column.get("skip", none)
    return crf.train(
        crf.Patterns(
            (features[:, None] >> bits) & 1 == 1, column.get("before", none), column.get("after", none),
            (skip[:, None] >> (3 * np.arange(labels))) & 7, column.get("label", none), column.get("count", none),
        ),
        labels,
    )


SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def _finder(weights: crf.Weights, least: float):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def told(spans: list[tuple[int, int, int]]) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, field in _fields(batch):
                more = field.added(weights, least)
                every = [sorted(a + b) for a, b in zip(field.spans, more, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(map(told, field.spans), kind), pa.array(map(told, every), kind)],
                    names=["doc_id", "base", "spans"],
                )

    return run


def find_personal_data(
    docs: DataFrame, weights: crf.Weights | None = None, doc_id: str = "doc_id", text: str = "text", least: float = LEAST_BELIEF
) -> DataFrame:
    """Rows (doc_id, base, spans): matches of the patterns, and these with the method's own, by start and kind."""
    weights = weights if weights is not None else train(docs, doc_id, text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_finder(weights, least), f"doc_id bigint, base {SPAN}, spans {SPAN}")

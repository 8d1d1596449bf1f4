"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Pieces and log scores come from a model file, whose path is a parameter. A space is a marker inside a piece, as
in SentencePiece, and a text gets one space in front. The best segmentation maximises the sum of scores; among
equal sums the one whose last piece is longest wins, then its last but one, and so on. A character that no
piece spells is an unknown of the lowest score minus ten and is written as its UTF-8 bytes, a piece for each.

No piece holds a space after another character, so texts are cut before each run of spaces; each distinct
stretch of a chunk is segmented once, and all stretches of a chunk advance together in numpy. A stretch without spaces
may be as long as its text: time and memory are linear in it.

The marker character itself, where a text holds it, is written as bytes. Decoding therefore gives back every
text exactly.

Defined results: a null text has null ids and decodes to null; an empty text has no ids; repeated rows are
encoded each; an empty table gives an empty result. Other columns pass through whatever their names.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglattice.llm import tokens

MODEL_FILE = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
MARKER = "▁"
UNKNOWN_PENALTY = 10.0


class DoubleArray:
    """A trie over bytes: the child of node s by byte c is base[s] + c if check there is s."""

    def __init__(self, keys: list[bytes]):
        children: list[dict[int, int]] = [{}]
        terminal = [-1]
        for number, key in enumerate(keys):
            node = 0
            for c in key:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    terminal.append(-1)
                node = children[node][c]
            if terminal[node] < 0:
                terminal[node] = number
        size = 2 * len(children) + 1024
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.piece = np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        place = {0: 0}
        low, recent, queue = 256, 256, [0]
        for node in queue:
            kids = np.array(sorted(children[node]), np.int64)
            if not len(kids):
                continue
            # An only child fills the first hole; others look near the last such node.
            begin, reach = (low, 1) if len(kids) == 1 else (max(low, recent - 512), 1024)
            while True:
                spots = begin + np.flatnonzero(free[begin : begin + reach])
                fits = spots[(spots >= kids[0]) & (spots - kids[0] + 256 <= size)] - kids[0]
                for c in kids[1:].tolist():
                    fits = fits[free[fits + c]]
                if len(fits):
                    break
                reach *= 4
            base, at = int(fits[0]), place[node]
            recent = recent if len(kids) == 1 else base + int(kids[0])
            self.base[at] = base
            for c in kids.tolist():
                child, spot = children[node][c], base + c
                free[spot] = False
                place[child] = spot
                self.check[spot] = at
                self.piece[spot] = terminal[child]
                queue.append(child)
            while not free[low]:
                low += 1


@dataclass
class Vocabulary:
    """Pieces by id, with bytes in place of markers; scores; ids of the 256 byte pieces."""

    pieces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    trie: DoubleArray
    of_key: np.ndarray
    unknown: float
    alone: list[int]  # line feeds and tabs, if no piece holds them

    @classmethod
    def build(cls, pieces: list[str], scores: list[float], normal: list[bool], byte_ids: list[int]) -> Vocabulary:
        spelled = [p.replace(MARKER, " ").encode() if ok else b"" for p, ok in zip(pieces, normal, strict=True)]
        for value, at in enumerate(byte_ids):
            spelled[at] = bytes([value])
        keys = [i for i, ok in enumerate(normal) if ok and spelled[i]]
        if any(b" " in spelled[i].lstrip(b" ") for i in keys):
            raise ValueError("a piece holds a space after another character")
        kept = np.array([scores[i] for i in keys], np.float64)
        held = {c for i in keys for c in spelled[i]}
        return cls(
            spelled, np.array(scores, np.float64), np.array(byte_ids, np.int32), DoubleArray([spelled[i] for i in keys]),
            np.array(keys, np.int32), float(kept.min()) - UNKNOWN_PENALTY,
            [c for c in (9, 10, 13) if c not in held],
        )

    @classmethod
    def load(cls, path: str = MODEL_FILE) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        file = SentencePieceProcessor(model_file=path)
        n = file.get_piece_size()
        normal = [not (file.is_byte(i) or file.is_control(i) or file.is_unknown(i) or file.is_unused(i)) for i in range(n)]
        names = [file.id_to_piece(i) for i in range(n)]
        return cls.build(
            names, [file.get_score(i) for i in range(n)], normal, [file.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        )

    def segment(self, flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches of UTF-8 text, one after another, and how many each has."""
        base, check, piece = self.trie.base, self.trie.check, self.trie.piece
        top = len(check)
        score_of = self.scores[self.of_key]
        slot = np.cumsum(length + 1) - (length + 1)  # stretch i owns positions slot[i] .. slot[i] + length[i]
        best = np.full(int((length + 1).sum()), -np.inf)
        best[slot] = 0.0
        back = np.zeros(len(best), np.int32)
        via = np.full(len(best), -1, np.int32)
        order = np.argsort(-length, kind="stable")
        falling = -length[order]
        for p in range(int(length.max(initial=0))):
            own = order[: np.searchsorted(falling, -p)]  # longer than p
            own = own[np.isfinite(best[slot[own] + p])]
            if not len(own):
                continue
            at, src, end = begin[own] + p, slot[own] + p, begin[own] + length[own]
            first = flat[at]
            wide = 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
            wide = np.minimum(wide, end - at)
            spelled = np.zeros(len(own), bool)
            live, node, k = np.arange(len(own)), np.zeros(len(own), np.int64), 0
            while len(live):
                spot = base[node].astype(np.int64) + flat[at[live] + k]
                ok = (spot < top) & (check[np.minimum(spot, top - 1)] == node)
                live, node = live[ok], spot[ok]
                k += 1
                number = piece[node]
                hit = number >= 0
                to = live[hit]
                self._offer(best, back, via, src[to], src[to] + k, score_of[number[hit]], self.of_key[number[hit]])
                spelled[to[wide[to] == k]] = True
                inside = at[live] + k < end[live]
                live, node = live[inside], node[inside]
            to = np.flatnonzero(~spelled)
            self._offer(best, back, via, src[to], src[to] + wide[to], np.full(len(to), self.unknown), np.full(len(to), -1))
        return self._trace(flat, begin, length, slot, back, via)

    @staticmethod
    def _offer(best, back, via, source, target, score, number) -> None:
        total = best[source] + score
        # Starts rise with p, so an equal later offer has a shorter last piece and does not win.
        better = total > best[target]
        best[target[better]] = total[better]
        back[target[better]] = source[better]
        via[target[better]] = number[better]

    def _trace(self, flat, begin, length, slot, back, via) -> tuple[np.ndarray, np.ndarray]:
        n = len(length)
        where, who = slot + length, np.arange(n)
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        depth = 0
        while True:
            go = where > slot[who]
            where, who = where[go], who[go]
            if not len(who):
                break
            steps.append((who, np.full(len(who), depth), via[where], np.stack([back[where], where])))
            where = back[where].astype(np.int64)
            depth += 1
        if not steps:
            return np.empty(0, np.int32), np.zeros(n, np.int64)
        who = np.concatenate([s[0] for s in steps])
        order = np.lexsort((-np.concatenate([s[1] for s in steps]), who))
        who, number = who[order], np.concatenate([s[2] for s in steps])[order]
        span = np.concatenate([s[3] for s in steps], axis=1)[:, order]
        # An unknown character becomes its bytes.
        times = np.where(number < 0, span[1] - span[0], 1)
        ids = np.repeat(number, times)
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            first = np.repeat(np.cumsum(times) - times, times)
            source = begin[who] + span[0] - slot[who]
            ids[odd] = self.byte_ids[flat[np.repeat(source, times)[odd] + odd - first[odd]]]
        return ids, np.bincount(who, weights=times, minlength=n).astype(np.int64)

    def encode(self, buf: np.ndarray, offsets: np.ndarray, hasher: tokens.WordHasher) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has; an empty text has none."""
        n = len(offsets) - 1
        size = np.diff(offsets)
        some = size > 0
        # One space in front of each text that is not empty.
        shift = np.cumsum(some)
        flat = np.empty(len(buf) + int(some.sum()), np.uint8)
        spaced = offsets[:-1] + shift - some
        to = np.arange(len(buf)) + np.repeat(shift, size)
        flat[to] = buf
        flat[spaced[some]] = 32
        ends = spaced + size + some
        blank = flat == 32
        opens = blank.copy()
        opens[1:] &= ~blank[:-1]
        # A line feed or tab that no piece holds is a stretch of its own.
        for c in self.alone:
            lone = np.flatnonzero(flat == c)
            opens[lone] = True
            after = lone + 1
            opens[after[after < len(flat)]] = True
        opens[spaced[some]] = True
        begin = np.flatnonzero(opens)
        length = np.diff(np.r_[begin, len(flat)])
        text = np.searchsorted(ends, begin, side="right")
        _, first, which = np.unique(hasher(flat, begin, begin + length), return_index=True, return_inverse=True)
        ids, count = self.segment(flat, begin[first], length[first])
        start = np.cumsum(count) - count
        times = count[which]
        at = np.repeat(start[which], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        return ids[at], np.bincount(text, weights=times, minlength=n).astype(np.int64)

    def spelling(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all pieces, one after another, and where each begins."""
        return np.frombuffer(b"".join(self.pieces), np.uint8), np.r_[0, np.cumsum([len(p) for p in self.pieces])]


def decode(vocabulary: Vocabulary, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts that the ids spell, and their offsets; the space in front of each is taken off."""
    raw, edge = vocabulary.spelling()
    size = np.diff(edge)[ids]
    at = np.repeat(edge[ids], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat = raw[at]
    total = np.r_[0, np.cumsum(size)]
    bounds = total[np.r_[0, np.cumsum(count)]]
    keep = np.ones(len(flat), bool)
    keep[bounds[:-1][np.diff(bounds) > 0]] = False
    return flat[keep], bounds - np.r_[0, np.cumsum(np.diff(bounds) > 0)]


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, hasher = shared.value, tokens.WordHasher(71)
        for batch in batches:
            column = batch.column("text")
            buf, offsets = tokens.text_bytes(column)
            null = column.is_null().to_numpy(zero_copy_only=False)
            for i, j in tokens.chunks(offsets):
                own = offsets[i : j + 1]
                part, own = buf[own[0] : own[-1]], own - own[0]
                ids, count = vocabulary.encode(part, own, hasher)
                flat, bounds = decode(vocabulary, ids, count)
                edge = pa.array(np.r_[0, np.cumsum(count)].astype(np.int32))
                lists = pa.ListArray.from_arrays(edge, pa.array(ids.astype(np.int32)), mask=pa.array(null[i:j]))
                text = pa.StringArray.from_buffers(
                    j - i, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(flat),
                    pa.array(~null[i:j]).buffers()[1] if null[i:j].any() else None,
                )
                spelled = pa.array(np.isin(ids, vocabulary.byte_ids).cumsum() if len(ids) else np.empty(0, np.int64))
                bytes_upto = np.r_[0, spelled.to_numpy()][np.r_[0, np.cumsum(count)]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(i, j - i), lists, text, pa.array(np.diff(bytes_upto))],
                    names=["row", "ids", "decoded", "n_bytes"],
                )

    return run


def encode_texts(docs: DataFrame, text: str = "text", carry: list[str] | None = None, path: str = MODEL_FILE) -> DataFrame:
    """Rows (row, ids, decoded, n_bytes): piece ids, the text they spell, and how many are byte pieces."""
    rows = docs.select(F.struct(*(carry or docs.columns)).alias("row"), F.col(text).alias("text"))
    schema = T.StructType([
        T.StructField("row", rows.schema["row"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()), T.StructField("n_bytes", T.LongType()),
    ])
    # Some megabytes, as large as the model file makes it.
    return rows.mapInArrow(_encode(docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))), schema)

"""Fill-in-middle: each text is cut at two token boundaries found on a wavelet matrix of its character classes.

Tokens are runs of the letters A-Z, a-z, and every other code point by itself. A code point's class says whether
it goes on a word, begins one, or is a digit, a white space or something else alone. Ranks of the classes that
begin a token add up to the number of tokens before any place, so the number of tokens of a text is a
difference of ranks, and bisection on ranks finds the place where a cut falls. The texts of a chunk share one
matrix, and all their cuts are bisected together.

Which tokens the cuts follow, and the form, come from a hash of the seed and the document id, so that retries
and reruns agree. The parts are moved around sentinels that the text itself does not hold; a text that holds one
stays plain, so every output gives its text back.

Defined results: null and empty texts have no tokens and stay plain as the empty text; a null id is hashed as the
empty string; rows that repeat are cut alike; an empty table gives an empty result. Other columns are ignored.
Texts are read whole; memory is bounded by a chunk or by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.llm import tokens
from loglattice.llm.wavelet import WaveletMatrix

SEED = 1
# Of 100 documents, those from the first number on stay plain; of the others, those below the second are spm.
PLAIN_FROM = 90
SPM_BELOW = 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

INSIDE, WORD, DIGIT, SPACE, OTHER = range(5)
CLASS_BITS = 3
BEGINS = (WORD, DIGIT, SPACE, OTHER)


def classes_of(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The class of every code point; no word goes on from one text into the next."""
    folded = points | np.uint32(32)
    letter = (folded >= 97) & (folded <= 122)
    after = np.zeros(len(points), bool)
    after[1:] = letter[:-1]
    begins = offsets[:-1]
    after[begins[begins < len(points)]] = False
    out = np.full(len(points), OTHER, np.uint8)
    out[(points >= 48) & (points <= 57)] = DIGIT
    out[(points == 32) | ((points >= 9) & (points <= 13))] = SPACE
    out[letter] = WORD
    out[letter & after] = INSIDE
    return out


class Boundaries:
    """Token counts and cut places of the texts of one chunk."""

    def __init__(self, points: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends = offsets[:-1], offsets[1:]
        self.matrix = WaveletMatrix(classes_of(points, offsets), CLASS_BITS)
        self.before = self.begun(self.starts)
        self.totals = self.begun(self.ends) - self.before

    def begun(self, upto: np.ndarray) -> np.ndarray:
        """Tokens that begin before a place."""
        return sum(self.matrix.rank(c, upto) for c in BEGINS)

    def ends_of(self, count: np.ndarray) -> np.ndarray:
        """Where the first `count` tokens of each text end: the last place that no further token begins before."""
        low, high = self.starts.copy(), self.ends.copy()
        wanted = self.before + count
        while (low < high).any():
            middle = (low + high + 1) >> 1
            few = self.begun(middle) <= wanted
            low, high = np.where(few, middle, low), np.where(few, high, middle - 1)
        return low


def _cut(plain_from: int, spm_below: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = tokens.text_bytes(batch.column("text"))
            draw = [batch.column(f"h{i}").to_numpy() for i in range(1, 5)]
            for i, j in tokens.chunks(offsets):
                own = offsets[i : j + 1]
                text, points, at = tokens.code_points(buf[own[0] : own[-1]], own - own[0])
                bounds = Boundaries(points, at)
                one, two = (draw[k][i:j] % (bounds.totals + 1) for k in (0, 1))
                first, second = bounds.ends_of(np.minimum(one, two)), bounds.ends_of(np.maximum(one, two))
                rows = []
                for d, (s, a, b, e) in enumerate(zip(at[:-1].tolist(), first.tolist(), second.tolist(), at[1:].tolist(), strict=True)):
                    whole = text[s:e]
                    if not whole or any(x in whole for x in (PREFIX, SUFFIX, MIDDLE)) or draw[2][i + d] % 100 >= plain_from:
                        rows.append(("plain", None, None, whole))
                        continue
                    p, m, t = PREFIX + text[s:a], MIDDLE + text[a:b], SUFFIX + text[b:e]
                    spm = draw[3][i + d] % 100 < spm_below
                    rows.append(("spm" if spm else "psm", a - s, b - a, t + p + m if spm else p + t + m))
                form, prefix, middle, out = zip(*rows, strict=True)
                raw = [x.encode("utf-8", "surrogateescape") for x in out]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(bounds.totals), pa.array(form), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(raw, pa.binary()).cast(pa.string(), safe=False)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def draws(doc_id: str, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the hash of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
    plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
) -> DataFrame:
    """Rows (doc_id, n, form, prefix_chars, middle_chars, output), one for each row of docs."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *draws(doc_id, seed))
    return rows.mapInArrow(
        _cut(plain_from, spm_below),
        "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    body, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    psm = F.concat(F.substring_index(F.substring_index(body, SUFFIX, 1), PREFIX, -1), middle, F.substring_index(body, SUFFIX, -1))
    spm = F.concat(F.substring_index(body, PREFIX, -1), middle, F.substring_index(F.substring_index(body, PREFIX, 1), SUFFIX, -1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


OP13_SQL = """
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id::VARCHAR) AS h FROM documents
), units AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w,
    [('0x' || substr(h, 1 + 8 * i, 8))::BIGINT FOR i IN range(0, 4)] AS r
  FROM given
), cuts AS (
  SELECT doc_id, t, w, len(w) AS n, least(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS a,
    greatest(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
         WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(list_slice(w, 1, a), '') AS p,
    array_to_string(list_slice(w, a + 1, b), '') AS m, array_to_string(list_slice(w, b + 1, n), '') AS s
  FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

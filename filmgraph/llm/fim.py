"""Fill-in-middle transformation: documents cut into prefix, middle and suffix and reordered.

A wavelet matrix is built over the character classes of a batch of texts. What a class says of a
character (does it begin a token, a line) turns rank queries into counts of unit boundaries, and a
bisection on these ranks finds where a given unit starts. All documents of a batch are cut by the
same few vectorised rank queries.

Units are tokens (``[A-Za-z]+|[^A-Za-z]``, left to right), lines or single characters. The cuts are
drawn per document from the SHA-256 of ``<seed>:<doc_id>``, so they do not depend on the
partitioning or on other rows. A document is written in one of three forms: ``plain`` (the text
itself), ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>`` middle) or ``spm`` (``<S>`` suffix ``<P>`` prefix ``<M>``
middle); ``restored`` rebuilds the exact text from output and form.

Null texts count as empty; empty texts and texts that hold one of the markers stay plain, so every
output can be undone. Rows with equal ids and texts get equal outputs; a null id is drawn from
``<seed>:``. Other columns pass through whatever their names. An empty table stays empty.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The markers.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)

# Character classes: inside a token, first character of a token, the same at the start of a line.
INNER, FIRST, LINE = 0, 1, 2
CLASS_BITS = 2
# Classes that begin a unit of each kind.
STARTS = {"token": (FIRST, LINE), "line": (LINE,), "char": (INNER, FIRST, LINE)}
CHUNK = 1 << 20                   # code points classified at once

RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class FillInMiddle:
    unit: str = "token"
    plain_percent: int = 10
    spm_percent: int = 20         # of the documents that are not plain
    seed: str = "1"

    def __post_init__(self):
        if self.unit not in STARTS:
            raise ValueError(f"unit must be one of {sorted(STARTS)}, not {self.unit!r}")


class WaveletMatrix:
    """Ranks over a sequence of small integers: one bit vector per bit, highest first, each with
    the running count of its 64-bit words; zeros move before ones from level to level."""

    def __init__(self, values: np.ndarray, bits: int):
        self.n, self.bits = len(values), bits
        self.words, self.ones, self.zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            # one word more than needed, so that a rank at the very end reads a word of zeros
            words = np.zeros((self.n // 64 + 1) * 8, dtype=np.uint8)
            words[:len(packed)] = packed
            words = words.view("<u8")
            count = np.zeros(len(words), dtype=np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=count[1:])
            self.words.append(words)
            self.ones.append(count)
            self.zeros.append(self.n - int(np.count_nonzero(bit)))
            if level:
                values = np.concatenate([values[~bit], values[bit]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, below = at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[level][word] + np.bitwise_count(self.words[level][word] & below)

    def rank(self, value: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``value`` before each place of ``at``."""
        lo, hi = np.zeros_like(at), at
        for level in range(self.bits):
            one_lo, one_hi = self._ones(level, lo), self._ones(level, hi)
            if value >> (self.bits - 1 - level) & 1:
                lo, hi = self.zeros[level] + one_lo, self.zeros[level] + one_hi
            else:
                lo, hi = lo - one_lo, hi - one_hi
        return hi - lo


def classes(texts: list[str]) -> np.ndarray:
    """Class of every code point of the texts, one after the other."""
    out = np.empty(sum(map(len, texts)), dtype=np.uint8)
    at = 0
    for text in texts:
        letter, feed = False, True        # of the character before; a text begins a line
        for i in range(0, len(text), CHUNK):
            code = np.frombuffer(text[i:i + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
            lowered = code | 0x20
            letters = (lowered >= ord("a")) & (lowered <= ord("z"))
            begins = ~letters
            begins[1:] |= ~letters[:-1]
            begins[0] |= not letter
            line = np.empty(len(code), dtype=bool)
            line[0], line[1:] = feed, code[:-1] == 0x0A
            own = begins.astype(np.uint8)
            own[line] = LINE
            out[at:at + len(code)] = own
            at += len(code)
            letter, feed = bool(letters[-1]), bool(code[-1] == 0x0A)
    return out


class Boundaries:
    """Units of a batch of texts, counted and found by ranks."""

    def __init__(self, texts: list[str], unit: str):
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.end = np.cumsum(size)
        self.begin = self.end - size
        self.matrix = WaveletMatrix(classes(texts), CLASS_BITS)
        self.starts = STARTS[unit]
        self.base = self.before(self.begin)
        self.count = self.before(self.end) - self.base

    def before(self, at: np.ndarray) -> np.ndarray:
        """Units that start before each place of the batch."""
        return sum(self.matrix.rank(c, at) for c in self.starts)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Code points of each text before its unit number ``units`` (its length if it has no more):
        the last place before which no more than ``units`` units start."""
        lo, hi = self.begin.copy(), self.end.copy()
        while (open_ := lo < hi).any():
            middle = (lo + hi + 1) >> 1
            fits = self.before(middle) - self.base <= units
            lo = np.where(open_ & fits, middle, lo)
            hi = np.where(open_ & ~fits, middle - 1, hi)
        return lo - self.begin


def draws(seed: str, doc_id: str | None) -> list[int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transform_batch(ids: list[str | None], texts: list[str], t: FillInMiddle) -> list[tuple]:
    """``(n, form, prefix_chars, middle_chars, output)`` of each text."""
    units = Boundaries(texts, t.unit)
    h = [draws(t.seed, i) for i in ids]
    ends = [sorted((a % (n + 1), b % (n + 1)))
            for (a, b, _, _), n in zip(h, units.count.tolist(), strict=True)]
    first = units.cut(np.asarray([e[0] for e in ends], dtype=np.int64)).tolist()
    second = units.cut(np.asarray([e[1] for e in ends], dtype=np.int64)).tolist()
    out = []
    for text, n, a, b, (_, _, h3, h4) in zip(texts, units.count.tolist(), first, second, h,
                                             strict=True):
        if not text or h3 % 100 >= 100 - t.plain_percent or any(m in text for m in MARKERS):
            out.append((n, "plain", None, None, text))
            continue
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < t.spm_percent:
            form, made = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        else:
            form, made = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
        out.append((n, form, a, b - a, made))
    return out


def transform(docs: DataFrame, out: str, t: FillInMiddle | None = None, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``out``: n (units of the text), form, prefix_chars and
    middle_chars (code points, null if plain) and output."""
    t = t or FillInMiddle()

    @F.pandas_udf(RESULT)
    def cut(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = transform_batch([i if isinstance(i, str) else None for i in ids],
                               [x if isinstance(x, str) else "" for x in texts], t)
        made = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return made.astype({"n": "Int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    # the id goes as text: a null beside it must not turn it into a double
    return docs.withColumn(out, cut(F.col(doc_id).cast("string"), F.col(text).cast("string")))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of, from output and form alone. A text that is cut holds no
    marker, so the first of each kind behind the one before is the one that was put there."""
    def split(one: str, two: str):
        begin = F.locate(two, output)
        stop = F.locate(MIDDLE, output, 1)
        head = F.substring(output, F.lit(len(one) + 1), begin - len(one) - 1)
        tail = F.substring(output, begin + len(two), stop - begin - len(two))
        return head, F.substring(output, stop + len(MIDDLE), F.length(output)), tail

    prefix, middle, suffix = split(PREFIX, SUFFIX)
    suffix_2, middle_2, prefix_2 = split(SUFFIX, PREFIX)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix_2, middle_2, suffix_2))
            .otherwise(output))

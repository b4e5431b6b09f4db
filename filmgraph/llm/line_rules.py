"""Line-first document cleaning.

Every line with a word is judged on its own - navigation, boilerplate, markup noise, shouting and
missing sentence punctuation - and removed when it fails; a document is rejected when the removed
lines held more than a set share of its word characters, or when the whole text fails the base
counts. All work happens row by row inside one vectorised function: no shuffle, no join, any number
of rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD

# Fixed value: the symbol characters counted by the base rule.
SYMBOLS = re.compile(r"[#*$%&|<>]")

# Rule patterns; the SQL statement uses the same strings (the RE2 and Python readings agree).
SENTENCE_END = r"[.!?:;…。！？][\"'»”’)\]]*[ \t\r]*$"
NAV_SEPARATOR = r"[|»›•]"
SHOUT = r"!!"
BOILERPLATE = (r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie policy|"
               r"accept (all )?cookies|javascript (is|must be)|click here|sign (in|up) (to|for)|"
               r"subscribe to|skip to (main )?content)")


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the verdict; lines longer than ``boilerplate_words`` are never boilerplate."""

    min_words: int = 50               # base: fewer words fail
    max_repeat_percent: int = 50      # base: more repeated words fail
    nav_percent: int = 20             # separators per 100 words that make a line navigation
    symbol_percent: int = 20          # symbols per 100 words that make a line markup noise
    shout_percent: int = 20           # "!!" per 100 words that make a line shouting
    boilerplate_words: int = 40
    unpunctuated_words: int = 8       # shorter lines without a sentence end are fragments
    max_lost_percent: int = 50        # of word characters; more lost rejects the document


OUT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, kept boolean, lost_chars long, nav_lines long, noise_lines long, "
       "boilerplate_lines long, fragment_lines long, cleaned string")

_SENTENCE_END = re.compile(SENTENCE_END)
_NAV = re.compile(NAV_SEPARATOR)
_SHOUT = re.compile(SHOUT)
_BOILERPLATE = re.compile(BOILERPLATE)


def line_verdict(line: str, n_words: int, rules: LineRules) -> str | None:
    """Name of the first rule a line breaks, None for a line that stays."""
    if 100 * len(_NAV.findall(line)) > rules.nav_percent * n_words:
        return "nav"
    if (100 * len(SYMBOLS.findall(line)) > rules.symbol_percent * n_words
            or 100 * len(_SHOUT.findall(line)) > rules.shout_percent * n_words):
        return "noise"
    if n_words <= rules.boilerplate_words and _BOILERPLATE.search(line):
        return "boilerplate"
    if n_words < rules.unpunctuated_words and not _SENTENCE_END.search(line):
        return "fragment"
    return None


def repeated_words(words: list[str]) -> int:
    """Words lying in a 3-word window that occurs at least twice in the text."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def judge_text(text: str | None, rules: LineRules) -> tuple:
    """All output columns of one text, in the order of ``OUT``."""
    text = text or ""
    words = WORD.findall(text)
    word_chars = sum(map(len, words))
    symbols = len(SYMBOLS.findall(text))
    seen: set[str] = set()
    dup_lines = lost = 0
    broken = {"nav": 0, "noise": 0, "boilerplate": 0, "fragment": 0}
    stay = []
    for line in text.split("\n"):
        own = WORD.findall(line)
        if not own:
            continue
        if line in seen:
            dup_lines += 1
        else:
            seen.add(line)
        rule = line_verdict(line, len(own), rules)
        if rule:
            broken[rule] += 1
            lost += sum(map(len, own))
        else:
            stay.append(line)
    repeats = repeated_words(words)
    n = len(words)
    failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    kept = not failed and 100 * lost <= rules.max_lost_percent * word_chars
    return (n, word_chars, symbols, dup_lines, repeats, failed, kept, lost, broken["nav"],
            broken["noise"], broken["boilerplate"], broken["fragment"], "\n".join(stay))


def judge(docs: DataFrame, out: str, text: str = "text",
          rules: LineRules | None = None, with_cleaned: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out`` holding the counts, the verdict and (on request) the
    cleaned text.

    Null and empty texts have no words: zero counts, ``base_failed`` true, ``kept`` false. Repeated
    rows are judged alike, each on its own; an empty table gives an empty result; other columns,
    whatever their names, pass through untouched (``out`` must be a free name).
    """
    rules = rules or LineRules()
    names = [f.split()[0] for f in OUT.split(", ")]
    schema = OUT if with_cleaned else OUT.rsplit(", ", 1)[0]
    width = len(names) if with_cleaned else len(names) - 1

    @F.pandas_udf(schema)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        rows = [judge_text(t if isinstance(t, str) else None, rules)[:width] for t in texts]
        return pd.DataFrame(rows, columns=names[:width])

    return docs.withColumn(out, verdict(F.col(text).cast("string")))

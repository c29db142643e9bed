"""Quality rules on repetition within a text, from suffix arrays over words.

The words of many texts form one array of word numbers, and its suffixes are sorted by doubling: suffixes ranked by their first h
words are ranked by 2h words through the pair of ranks at i and i + h, and only suffixes that still share their rank are
sorted again. First ranks hold the text's number, so suffixes of different texts never share one, and repetition is counted
within a text. The ranks of all doublings stay, and give the longest common prefix of neighbours in the suffix array exactly, by
powers of two from the top.

The deepest interval of the LCP array around a suffix is as long as the larger of its two neighbouring LCPs: that many words
from there occur elsewhere in the text as well. Starts whose repeat isn't a continuation of the one before are those of
maximal repeated substrings; the union of their spans is what repetition covers.

Rules: a text fails if repeats of at least `REPEAT` words cover more than `COVERED` of its words, or if one repeat has more than
`LONGEST` words.

Memory is some tens of bytes per word of a slice of texts, and four more for each doubling that the longest repeat takes. A
text is never cut.

Defined results: null is the empty text, which has no words and fails the base rules; repeated rows count each by itself; columns
named like the results are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm.common import joined, list_array, query, slices, strings, table

REPEAT = 12  # words from which a repeat counts as covering
COVERED = 0.3
LONGEST = 200
WINDOW = 3
LEAST_WORDS = 50
REPEATED_SHARE = 50  # percent of the words that may stand in repeated windows

_BLANKS = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

MEASURES = T.StructType(
    [
        *[T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")],
        T.StructField("spans", T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()))),
    ]
)


class _Numbers(dict):
    """Numbers words in the order of their first occurrence."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def suffix_array(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and their ranks by 1, 2, 4, ... words; equal ranks mean equal words of one text."""
    n = len(words)
    ends = np.searchsorted(text, text, "right")  # where the suffix's text ends
    key = text.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(key, kind="stable")
    fresh = np.diff(key[order], prepend=-1) != 0
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = start
    levels, h = [rank.astype(np.int32)], 1
    # slots of the suffix array whose suffix still shares its rank
    alone = fresh & np.append(fresh[1:], True)
    slots = np.flatnonzero(~alone)
    while len(slots):
        at = order[slots]
        ahead = at + h
        inside = ahead < ends[at]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        both = rank[at] * (n + 1) + second
        by = np.argsort(both, kind="stable")
        at, both = at[by], both[by]
        order[slots] = at
        fresh = np.diff(both, prepend=-1) != 0
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        alone = fresh & np.append(fresh[1:], True)
        slots = slots[~alone]
        h *= 2
        if len(slots):
            levels.append(rank.astype(np.int32))
    return order, levels


def repeat_lengths(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Per position, the most words from there that occur elsewhere in the text too."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(a), dtype=np.int64)
    live = np.flatnonzero(levels[0][a] == levels[0][b]) if n else np.zeros(0, dtype=np.int64)
    a, b = a[live], b[live]
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        common[live[same]] += 1 << k
        a, b = a + (same << k), b + (same << k)
    out = np.zeros(n, dtype=np.int64)
    out[order[:-1]] = common
    out[order[1:]] = np.maximum(out[order[1:]], common)
    return out


def _covered(lengths: np.ndarray, least: int, width: int | None = None) -> np.ndarray:
    """Which positions stand in a repeat of at least `least` words (in its first `width` words, if given)."""
    n = len(lengths)
    starts = np.flatnonzero(lengths >= least)
    stops = starts + (lengths[starts] if width is None else width)
    change = np.bincount(starts, minlength=n + 1) - np.bincount(stops, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def measured(texts: list[str], repeat: int = REPEAT, with_spans: bool = True) -> dict[str, np.ndarray | list]:
    """The columns of `MEASURES` for some texts."""
    raw = [t.encode() for t in texts]
    number, parts = _Numbers(), []
    for t in raw:
        cut = t.split()
        parts.append(np.fromiter(map(number.__getitem__, cut), dtype=np.int64, count=len(cut)))
    counts = np.array([len(p) for p in parts], dtype=np.int64)
    words, text = np.concatenate([np.zeros(0, dtype=np.int64), *parts]), np.repeat(np.arange(len(raw)), counts)
    lengths = repeat_lengths(*suffix_array(words, text)) if len(words) else np.zeros(0, dtype=np.int64)
    within = _covered(lengths, repeat)
    longest = np.zeros(len(raw), dtype=np.int64)
    np.maximum.at(longest, text, lengths)
    lines = [[line for line in t.split(b"\n") if line.strip(_BLANKS)] for t in raw]
    out = {
        "n_words": counts,
        "word_chars": np.array([len(t) - (len(r) - len(r.translate(None, _BLANKS))) for t, r in zip(texts, raw, strict=True)], dtype=np.int64),
        "n_symbols": np.array([len(r) - len(r.translate(None, _SYMBOLS)) for r in raw], dtype=np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64),
        "n_repeat_words": np.bincount(text, _covered(lengths, WINDOW, WINDOW), minlength=len(raw)).astype(np.int64),
        "covered_words": np.bincount(text, within, minlength=len(raw)).astype(np.int64),
        "longest_repeat": longest,
    }
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    if with_spans and within.any():
        # runs of covered words, cut where the text changes; then in code points of the text
        change = np.flatnonzero((np.diff(within.astype(np.int8), prepend=0) != 0) | (np.diff(text, prepend=0) != 0))
        stops = np.append(change[1:], len(within))
        before = np.cumsum(counts) - counts
        for i in np.unique(text[within]).tolist():
            places = [m.span() for m in _WORD.finditer(texts[i])]
            mine = (text[change] == i) & within[change]
            spans[i] = [(places[a - before[i]][0], places[z - 1 - before[i]][1]) for a, z in zip(change[mine].tolist(), stops[mine].tolist(), strict=True)]
    out["spans"] = spans
    return out


def repetition(repeat: int = REPEAT):
    """The column function text -> `MEASURES`; spans are code points of what repeats of `repeat` words or more cover."""

    @F.arrow_udf(MEASURES)
    def measure(texts: pa.Array) -> pa.Array:
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        kind = pa.struct([*[(f.name, pa.int64()) for f in MEASURES.fields[:-1]], ("spans", pa.list_(span))])
        pieces = []
        for piece in slices(texts):
            found = measured(strings(piece), repeat)
            flat = [s for row in found["spans"] for s in row]
            values = pa.StructArray.from_arrays([pa.array([s[i] for s in flat], pa.int32()) for i in range(2)], fields=list(span))
            columns = [pa.array(found[f.name]) for f in MEASURES.fields[:-1]]
            pieces.append(pa.StructArray.from_arrays([*columns, list_array(values, map(len, found["spans"]))], fields=list(kind)))
        return joined(pieces, kind)

    return measure


def with_verdict(
    df: DataFrame, text: str = "text", repeat: int = REPEAT, covered: float = COVERED, longest: int = LONGEST
) -> DataFrame:
    """Add the fields of `MEASURES`, `base_failed` and `kept`."""
    names = [f.name for f in MEASURES.fields]
    found = df.withColumn("_measures_of_text", repetition(repeat)(text))
    found = found.withColumns({c: F.col(f"_measures_of_text.{c}") for c in names}).drop("_measures_of_text")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_SHARE * F.col("n_words"))
    fine = (F.col("covered_words") <= covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)


def without_repetitive(df: DataFrame, text: str = "text", **limits) -> DataFrame:
    """`df` less the texts that fail the rules."""
    return with_verdict(df, text, **limits).filter("kept").select(*df.columns)


@query("op12_repetition_rules")
def op12_repetition_rules(spark, folder):
    """Counts, base rules and verdict of every document."""
    found = with_verdict(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words",
        "longest_repeat", F.size("spans").alias("n_spans"),
    )

"""Language identification: script ranges narrow the candidates, then Viterbi decoding over per-word scores labels spans.

Training counts, for each language, the hashed character n-grams of all labelled texts and the letters of each script; what
reaches the driver is one number per language and n-gram bucket, whatever the size of the corpus. A word's score for a language
is the mean log probability of its n-grams, times the square root of its length (neighbouring n-grams aren't independent). A
language is a candidate for a word only if it writes a fair share of its letters in the word's script. Over the words of a
text, Viterbi decoding with a penalty for each change of language labels every word, so mixed texts fall into spans. The
prediction is the language with most letters, its score the share of them weighted by how clearly words speak for it.

Characters are handled as arrays of code points, many texts at a time. The n-grams of each distinct word of a group of texts are
hashed and scored once. In decoding, all texts of a slice advance one word at a time together.

Memory: a task holds the counts of at most `HELD` languages, and slices and groups of texts get smaller as the model gets more
languages; the model itself has a megabyte per language.

Defined results: a null text, or one without letters, is `und` with score 0 (combining marks alone are no letters); without any
labelled text, everything is `und`. Repeated rows are learnt from, and predicted, each by itself.
A word in a script of no known language takes part in no decision. Ties go to the first language in alphabetical order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm.common import bucket_of, joined, list_array, query, slices, strings, table, worker_memory

GRAMS = (1, 2, 3, 4)
BUCKET_BITS = 16
SWITCH = 6.0  # penalty of a change of language, in the unit of word scores
SCRIPT_SHARE = 0.001
SMOOTHING = 0.5
WORD_PIECE = 1 << 20  # code points of a group of texts
FEW = 12  # texts that are decoded one by one, when all others have ended
HELD = 32  # languages whose counts a task holds at a time
PAD = max(GRAMS) - 1
RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType().add("lang", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType())
            ),
        ),
    ]
)

# First code points of runs of one script, and the script's number; 0 holds Latin and all that is not listed.
SCRIPTS = [
    (0x0370, 1), (0x0400, 2), (0x0530, 3), (0x0590, 4), (0x0600, 5), (0x0700, 0), (0x0900, 6), (0x0980, 7), (0x0A00, 8),
    (0x0B00, 9), (0x0B80, 10), (0x0C00, 11), (0x0D00, 12), (0x0E00, 13), (0x0E80, 14), (0x0F00, 15), (0x1000, 16),
    (0x10A0, 17), (0x1100, 18), (0x1200, 19), (0x1380, 0), (0x1F00, 1), (0x2000, 0), (0x2E80, 20), (0x3040, 21),
    (0x3100, 20), (0x3130, 18), (0x3190, 20), (0x31F0, 21), (0x3200, 20), (0xA000, 0), (0xAC00, 18), (0xD7B0, 0),
    (0xF900, 20), (0xFB00, 0), (0x20000, 20), (0x30000, 0),
]
N_SCRIPTS = 22
_TABLE = 0x30000  # letters beyond are treated alike


def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its lower case where that is one character, whether it is a letter (1) or a combining mark (2), and its script."""
    memory = worker_memory("language")
    if "characters" not in memory:
        memory["characters"] = _character_table()
    return memory["characters"]


def _character_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower, letter = np.arange(_TABLE, dtype=np.uint32), np.zeros(_TABLE, dtype=np.uint8)
    for code in range(_TABLE):
        c = chr(code)
        if c.isalpha():
            letter[code] = 1
            if len(low := c.lower()) == 1:
                lower[code] = ord(low)
    letter[0x0300:0x0370] = 2  # combining marks belong to their word, but make none
    starts = np.array([s for s, _ in SCRIPTS])
    numbers = np.array([0] + [n for _, n in SCRIPTS], dtype=np.uint8)
    return lower, letter, numbers[np.searchsorted(starts, np.arange(_TABLE), "right")]


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with a blank after each, and where each text starts."""
    codes = np.frombuffer("".join(t + " " for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.minimum(codes, _TABLE - 1), np.concatenate([[0], ends[:-1]]).astype(np.int64)


_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64))


class Words:
    """The words (runs of letters) of some texts, and the n-gram buckets of the distinct ones.

    `starts` and `ends` are places in the joined texts, `of` numbers the distinct words; `distinct_starts` and `distinct_ends` are
    their places in an array of their own, where `PAD` blanks stand before and behind each word.
    """

    def __init__(self, texts: list[str]):
        lower, letter, script = _characters()
        codes, self.text_starts = _codes(texts)
        kind = letter[codes]
        edges = np.flatnonzero(np.diff((kind > 0).astype(np.int8), prepend=0, append=0))
        starts, ends = edges[::2], edges[1::2]
        letters = np.concatenate([[0], np.cumsum(kind == 1)])
        real = letters[ends] > letters[starts]
        self.starts, self.ends = starts[real], ends[real]
        self.text = np.searchsorted(self.text_starts, self.starts, "right") - 1
        lengths = self.ends - self.starts
        # a word counts as of the script of its first letter; only Latin words often hold more than one
        self.script = script[codes[self.starts]]
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        places = inside + np.repeat(self.starts, lengths)
        low = lower[codes[places]]
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _POWERS[inside & 4095])])
        stops = np.cumsum(lengths)
        hashes = total[stops] - total[stops - lengths] + lengths.astype(np.uint64) * _POWERS[7]
        _, first, self.of = np.unique(hashes, return_index=True, return_inverse=True)
        self.first = first
        size = lengths[first]
        self.distinct_ends = np.cumsum(size + PAD)
        self.distinct_starts = self.distinct_ends - size
        self.codes = np.full(int(size.sum()) + PAD * (len(size) + 1), 32, dtype=np.uint32)
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        self.codes[within + np.repeat(self.distinct_starts, size)] = low[within + np.repeat((stops - lengths)[first], size)]

    def grams(self):
        """For each n: the bucket of the n-gram that ends at each position of the distinct words.

        An n-gram may begin on blanks before its word, which mark the start; and the blank after a word ends some.
        """
        codes = self.codes.astype(np.uint64)
        rolling = np.zeros(len(codes), dtype=np.uint64)
        for n in range(1, max(GRAMS) + 1):
            shifted = np.concatenate([np.full(n - 1, 32, dtype=np.uint64), codes[: len(codes) - n + 1]])
            rolling = rolling + (shifted + np.uint64(n)) * np.uint64((0x9E3779B97F4A7C15 * (2 * n + 1) ** 5 | 1) & (1 << 64) - 1)
            if n in GRAMS:
                mixed = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                yield n, (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _pieces(texts: list[str], limit: int = WORD_PIECE):
    """Texts in groups of about `limit` characters; a longer text is cut at a blank, with its index kept."""
    group, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            stop = len(text) if len(text) - at <= limit else text.rfind(" ", at + 1, at + limit)
            stop = at + limit if stop <= at and at < len(text) else stop
            group.append((i, at, text[at:stop] if at or stop < len(text) else text))
            size += stop - at + 1
            if size >= limit:
                yield group
                group, size = [], 0
            at = stop
            if at >= len(text):
                break
    if group:
        yield group


def _word_places(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per distinct word, first and one past the last position of the n-grams that count for it: they end within it or just behind."""
    return np.minimum(words.distinct_starts + max(0, n - 2), words.distinct_ends), words.distinct_ends + (1 if n > 1 else 0)


def _sums(values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Sums of ranges of rows, which are not empty, do not overlap and follow each other."""
    if not len(first):
        return np.zeros((0, *values.shape[1:]))
    cuts = np.column_stack([first, stop]).ravel()
    closed = np.concatenate([values, np.zeros((1, *values.shape[1:]), dtype=values.dtype)])  # so that the last stop is a place
    return np.add.reduceat(closed, cuts, axis=0, dtype=np.float64)[::2]


def train(labelled: DataFrame, text: str, lang: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log probabilities (n-gram order, bucket, language) and script shares (script, language).

    Counts cover all rows with a language. They are summed per task first, so a task sends at most one row for each
    language and bucket that it has seen.
    """
    size = len(GRAMS) << BUCKET_BITS

    def taken(counts: dict[str, np.ndarray]):
        for name, at in counts.items():
            where = np.flatnonzero(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(where), pa.string()), pa.array(where), pa.array(at[where])], names=["lang", "at", "n"]
            )
        counts.clear()

    def counted(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            start = 0
            for piece in slices(batch["text"]):
                langs = batch["lang"].slice(start, len(piece)).to_pylist()
                start += len(piece)
                for group in _pieces(strings(piece)):
                    words = Words([t for _, _, t in group])
                    names, number = np.unique(np.array([langs[i] for i, _, _ in group]), return_inverse=True)
                    of = number.ravel()[words.text]
                    buckets = list(words.grams())
                    for i, name in enumerate(names.tolist()):
                        mine = of == i
                        if name not in counts and len(counts) >= HELD:
                            yield from taken(counts)
                        at = counts.setdefault(name, np.zeros(size + N_SCRIPTS, dtype=np.int64))
                        at[size:] += np.bincount(words.script[mine], (words.ends - words.starts)[mine], N_SCRIPTS).astype(np.int64)
                        # each n-gram of a distinct word as often as the word occurs
                        often = np.bincount(words.of[mine], minlength=len(words.first))
                        held = np.flatnonzero(often)
                        for k, (n, bucket) in enumerate(buckets):
                            first, stop = (x[held] for x in _word_places(words, n))
                            long = stop - first
                            places = np.arange(long.sum()) + np.repeat(first - (np.cumsum(long) - long), long)
                            found = np.bincount(bucket[places], np.repeat(often[held], long), 1 << BUCKET_BITS)
                            at[k << BUCKET_BITS : k + 1 << BUCKET_BITS] += found.astype(np.int64)
        yield from taken(counts)

    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    found = rows.mapInArrow(counted, "lang string, at bigint, n bigint").groupBy("lang", "at").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(found["lang"].to_pylist()))
    number = {name: i for i, name in enumerate(names)}
    counts = np.zeros((size + N_SCRIPTS, len(names)))
    if names:
        which = np.array([number[x] for x in found["lang"].to_pylist()])
        counts[found["at"].to_numpy(), which] = found["n"].to_numpy()
    grams = counts[:size].reshape(len(GRAMS), 1 << BUCKET_BITS, len(names)) + SMOOTHING
    letters = counts[size:]
    return names, np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32), letters / np.maximum(1, letters.sum(axis=0))


def word_scores(words: Words, weights: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Per distinct word and language; languages that do not write the word's script are out, all are alike where none does."""
    total, count = np.zeros((len(words.first), weights.shape[2])), np.zeros(len(words.first))
    for k, (n, bucket) in enumerate(words.grams()):
        first, stop = _word_places(words, n)
        total += _sums(weights[k][bucket], first, stop)
        count += stop - first
    scores = total / np.maximum(1, count)[:, None] * np.sqrt(words.distinct_ends - words.distinct_starts)[:, None]
    fits = allowed[words.script[words.first]]
    scores = np.where(fits, scores, -np.inf)
    top = scores.max(axis=1, keepdims=True, initial=-np.inf)
    with np.errstate(invalid="ignore"):
        return np.where(fits.any(axis=1, keepdims=True), np.maximum(scores - top, -25.0), 0.0)


def viterbi(scores: np.ndarray, text: np.ndarray, n_texts: int, of: np.ndarray | None = None) -> np.ndarray:
    """The best language of each word; `text` (ascending) says which text a word is of, `of` which row of scores it has.

    Texts advance together, a word a step. When no more than `FEW` are left, each goes on alone.
    """
    of = np.arange(len(text)) if of is None else of
    counts = np.bincount(text, minlength=n_texts)
    order = np.argsort(-counts, kind="stable")
    starts, counts = (np.cumsum(counts) - counts)[order], counts[order]
    switched, best_before = np.zeros((len(text), scores.shape[1]), dtype=bool), np.zeros(len(text), dtype=np.int16)
    value = np.zeros((n_texts, scores.shape[1]))
    label = np.zeros(len(text), dtype=np.int16)
    longest = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(longest), "left")  # texts that have a word t
    together = int(np.searchsorted(-active, -FEW, "left"))  # steps with more than FEW texts
    for t in range(together):
        a = active[t]
        at, now = starts[:a] + t, value[:a]
        if t:
            best = now.argmax(axis=1)
            reach = now[np.arange(a), best] - SWITCH
            switched[at] = now < reach[:, None]
            best_before[at] = best
            now = np.maximum(now, reach[:, None])
        value[:a] = now + scores[of[at]]
    for i in range(int(active[together]) if together < longest else 0):
        _alone(scores, of, int(starts[i]), together, int(counts[i]), value[i], switched, best_before)
    last = value.argmax(axis=1)
    for i in range(int(active[together]) if together < longest else 0):
        rest = slice(int(starts[i]) + together, int(starts[i] + counts[i]))
        now, found = int(last[i]), []
        for moved, before in zip(switched[rest].tolist()[::-1], best_before[rest].tolist()[::-1], strict=True):
            found.append(now)
            if moved[now]:  # never so at the text's first word
                now = before
        label[rest], last[i] = found[::-1], now
    for t in range(together - 1, -1, -1):
        a = active[t]
        at = starts[:a] + t
        label[at] = last[:a]
        if t:
            last[:a] = np.where(switched[at, last[:a]], best_before[at], last[:a])
    return label


def _alone(scores, of, start: int, done: int, count: int, value: np.ndarray, switched: np.ndarray, best_before: np.ndarray) -> None:
    """The steps of one text from word `done` on; leaves its last values in `value`."""
    now, moves, befores = value.tolist(), [], []
    for t, row in enumerate(scores[of[start + done : start + count]].tolist(), done):
        if t:
            top = max(now)
            reach = top - SWITCH
            befores.append(now.index(top))
            moves.append([v < reach for v in now])
            now = [(reach if v < reach else v) + s for v, s in zip(now, row, strict=True)]
        else:
            befores.append(0)
            moves.append([False] * len(row))
            now = [v + s for v, s in zip(now, row, strict=True)]
    switched[start + done : start + count], best_before[start + done : start + count] = moves, befores
    value[:] = now


def labelled_texts(texts: list[str], names: list[str], weights: np.ndarray, allowed: np.ndarray) -> list[dict]:
    """Prediction, score and spans of each text."""
    if not names:
        return [{"lang_pred": "und", "score": 0.0, "spans": []} for _ in texts]
    parts, rows = [], 0
    for group in _pieces(texts, max(1 << 14, WORD_PIECE * 8 // (8 + len(names)))):
        words = Words([t for _, _, t in group])
        index = np.array([i for i, _, _ in group], dtype=np.int64)[words.text]
        # places within the whole text
        shift = np.array([at for _, at, _ in group], dtype=np.int64)[words.text] - words.text_starts[words.text]
        known = allowed[words.script].any(axis=1)
        scores = word_scores(words, weights, allowed)
        parts.append((index, words.starts + shift, words.ends + shift, words.of.ravel() + rows, known, scores))
        rows += len(scores)
    index, starts, ends, of, known, scores = (np.concatenate(column) for column in zip(*parts, strict=True))
    label = viterbi(scores, index, len(texts), of)
    letters = (ends - starts).astype(np.float64)
    by_lang = np.zeros((len(texts), len(names)))
    np.add.at(by_lang, (index, label), np.where(known, letters, 0))
    odds = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    odds = odds / np.maximum(odds.sum(axis=1, keepdims=True), 1e-9)
    clear = odds[of, label] if len(label) else letters
    sure = np.bincount(index, letters * clear, minlength=len(texts)) / np.maximum(1, np.bincount(index, letters, minlength=len(texts)))
    total, best = by_lang.sum(axis=1), by_lang.argmax(axis=1)
    change = np.flatnonzero((np.diff(index, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
    stop = np.concatenate([change[1:], [len(index)]]).astype(np.int64) if len(change) else change
    spans: list[list[dict]] = [[] for _ in texts]
    for a, b in zip(change.tolist(), stop.tolist(), strict=True):
        if known[a:b].any():
            spans[index[a]].append({"lang": names[label[a]], "start": int(starts[a]), "end": int(ends[b - 1])})
    out = []
    for i, text in enumerate(texts):
        if total[i]:
            share = by_lang[i, best[i]] / total[i]
            out.append({"lang_pred": names[best[i]], "score": float(min(1.0, share * sure[i])), "spans": spans[i]})
        elif any(map(str.isalpha, text)):
            # letters, but of no script that was learnt
            out.append({"lang_pred": names[0], "score": 0.0, "spans": []})
        else:
            out.append({"lang_pred": "und", "score": 0.0, "spans": []})
    return out


class Languages:
    """A trained model; `predict` is the column function text -> (lang_pred, score, spans)."""

    def __init__(self, labelled: DataFrame, text: str = "text", lang: str = "lang"):
        self.names, weights, shares = train(labelled, text, lang)
        # one float per n-gram bucket and language: a megabyte per language
        shared = labelled.sparkSession.sparkContext.broadcast((self.names, weights, shares >= SCRIPT_SHARE))

        @F.arrow_udf(RESULT)
        def predict(texts: pa.Array) -> pa.Array:
            out = []
            for piece in slices(texts, max(1 << 16, (4 << 20) * 8 // (8 + len(shared.value[0])))):
                rows = labelled_texts(strings(piece), *shared.value)
                flat = [s for r in rows for s in r["spans"]]
                kind = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
                spans = list_array(pa.array(flat, kind), [len(r["spans"]) for r in rows])
                names = pa.array([r["lang_pred"] for r in rows], pa.string())
                out.append(pa.StructArray.from_arrays([names, pa.array([r["score"] for r in rows], pa.float64()), spans], names=["lang_pred", "score", "spans"]))
            kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])
            return joined(out, kind)

        self.predict = predict


@query("op5_language_spans")
def op5_language_spans(spark, folder):
    """The language of every document, learnt from three quarters of them."""
    docs = table(spark, folder, "documents")
    held_out = bucket_of("doc_id", 4) == 2
    model = Languages(docs.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), model.predict("text").alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", F.size("found.spans").alias("n_spans"))

"""Toxicity scores of texts whose offensive words may be disguised.

Noisy channel. A character language model is counted over all words of all documents. Words that look disguised (letters mixed
with look-alike digits and signs, letters repeated three times or more, single letters set apart) become lattices: a sign
stands for the letters it resembles, a run of a letter for one or two, a separator for nothing. Viterbi decoding finds the
path that is cheapest under language model and channel, and the restored word takes the place of the disguised one.

Score. Words of the restored text and their beginnings are hashed features. Those that are significantly more frequent in texts
labelled toxic enter a logistic regression on their counts. It is fitted on at most about `FIT_ROWS` distinct labelled texts, taken by
a hash of the text and so evenly from all of them; each counts as often as it occurs, and the feature counts are summed by Spark.

A run of single letters set apart may hold several words: a separator is read as nothing or as the border of a word. Disguised
words and runs of any length are read; the states of the lattice are bounded, so the time is linear in their length.

Defined results: null is the empty text, which gets the score of a text without evidence. Without labelled rows of
both classes every score is the share of toxic ones (0 without any). Repeated labelled rows count each; of repeated labels of
one document one counts. Among features that tell equally well the one of the smaller number comes first, among readings that
cost the same the one found first. Result columns replace columns of the same name.
"""

from __future__ import annotations

import math
import re
import uuid
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm.common import bucket_of, joined, list_array, query, slices, table, worker_memory
from saleslake.sources.shared import written

FIT_ROWS = 20_000
FEATURE_BITS = 22
FEATURES = 512
LEAST_Z = 5.0
PREFIXES = range(4, 10)  # in bytes
RIDGE = 1.0
FIT_SLICE = 1024  # rows of the fit that are held as wide numbers at a time

# Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou",
}
SEPARATORS = " .-_*'"
SIGN_COST, KEEP_SIGN_COST, SEPARATOR_COST, COLLAPSE_COST = 0.5, 6.0, 0.2, 0.1
REMEMBERED, REMEMBERED_LENGTH = 50_000, 64  # words, of so many characters at most, that a worker remembers

SLICE = 1 << 19  # bytes of text read at a time; the arrays made of them take some sixty times as much

CLASSES = 64  # of characters in the language model: 0 the border of a word, 1-26 a-z, others hashed
_SIGNS = "".join(map(re.escape, LOOKALIKES))
# signs before a letter, or those that are no marks behind the last one
_SUSPECT = re.compile(f"[{_SIGNS}]+(?=[a-zà-ÿ])|(?<=[a-zà-ÿ])[0-9@$€£]+$")
_MARKS = "!|+(*"
_CODE = re.compile("[0-9a-f]{16,}")  # digests and the like are no words
_SPACED = re.compile(rf"(?<![^\W_])(?:[a-z{_SIGNS}][{re.escape(SEPARATORS)}]){{2,}}[a-z{_SIGNS}](?![^\W_])")
_TOKEN = re.compile(r"\S+")
_TRIPLE = re.compile(r"([a-z])\1\1")
_EDGES = ".,;:?\"'()[]{}<>%&#=~^/\\"


def _class(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27 + ord(char) % (CLASSES - 27)


_CLASS_OF = np.array([_class(chr(c)) if chr(c).isalpha() else 0 for c in range(0x3000)], dtype=np.int64)


def _trigrams(texts: list[str]) -> np.ndarray:
    """Counts of character trigrams over all words, each with a border before and after."""
    codes = np.frombuffer("".join(f"  {t}  " for t in texts).lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = _CLASS_OF[np.minimum(codes, len(_CLASS_OF) - 1)]
    index = (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]
    # of the trigrams that end in a border only those right after a word count
    return np.bincount(index[(c[2:] > 0) | (c[1:-1] > 0)], minlength=CLASSES**3)


def character_model(docs: DataFrame, text: str) -> np.ndarray:
    """Log probabilities [before last, last, next] from the trigrams of all rows; one number per trigram reaches the driver."""

    def counted(batches):
        total = np.zeros(CLASSES**3, dtype=np.int64)
        for batch in batches:
            for piece in slices(batch[0], SLICE):
                total += _trigrams([t or "" for t in piece.to_pylist()])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    found = docs.select(text).mapInArrow(counted, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CLASSES**3)
    counts[found["at"].to_numpy()] = found["n"].to_numpy()
    counts = counts.reshape(CLASSES, CLASSES, CLASSES)
    pairs = counts.sum(axis=0) + 0.5
    lower = pairs / pairs.sum(axis=1, keepdims=True)
    return np.log((counts + 20.0 * lower) / (counts.sum(axis=2, keepdims=True) + 20.0)).astype(np.float32)


_SIGN_SET = "".join(LOOKALIKES)


def restored_word(token: str, model) -> str:
    """The cheapest reading of a disguised word, or of several words set apart, which blanks then separate.

    States are the last two letters; `best` maps each to (cost, reading), a reading being (letters, the reading before).
    """

    def cost(a: int, b: int, c: int) -> float:
        return -model[(a * CLASSES + b) * CLASSES + c]

    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    i = 0
    while i < len(token):
        char = token[i]
        end = i + 1
        while end < len(token) and token[end] == char:
            end += 1
        repeats = end - i
        readings: list[tuple[str, float]] = []
        if char.isalpha():
            readings = [(char * k, COLLAPSE_COST * (repeats != k)) for k in ((1, 2) if repeats > 2 else (repeats,))]
        else:
            for letter in LOOKALIKES.get(char, ""):
                readings += [(letter * k, SIGN_COST) for k in ({1, min(repeats, 2)})]
            if char in SEPARATORS:
                readings += [("", SEPARATOR_COST), (" ", SEPARATOR_COST)]
            readings.append(("", KEEP_SIGN_COST))
        step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (spent, before) in best.items():
            for letters, extra in readings:
                if letters == " " and not b:
                    continue  # a border behind a border
                x, y, total = a, b, spent + extra
                for letter in letters:
                    z = 0 if letter == " " else _class(letter)
                    total += cost(x, y, z)
                    x, y = y, z
                if (x, y) not in step or total < step[x, y][0]:
                    step[x, y] = (total, (letters, before) if letters else before)
        best, i = step, end
    _, reading = min(((spent + (cost(a, b, 0) if b else 0.0), reading) for (a, b), (spent, reading) in best.items()), key=lambda r: r[0])
    parts = []
    while reading is not None:
        letters, reading = reading
        parts.append(letters)
    return "".join(reversed(parts)).strip()


def restored(text: str, model, memo: dict[str, str]) -> str:
    """The text in lower case with its disguised words restored."""

    def read(token: str) -> str:
        if len(token) > REMEMBERED_LENGTH:
            return restored_word(token, model)
        if token not in memo:
            if len(memo) >= REMEMBERED:
                memo.clear()
            memo[token] = restored_word(token, model)
        return memo[token]

    def word(match: re.Match) -> str:
        core = match.group().strip(_EDGES)
        bare = core.rstrip(_SIGN_SET)
        # one or two signs behind the last letter may stand for letters, more of them are marks; so are two of those that end sentences
        if len(core) - len(bare) > (1 if core[-1:] in _MARKS else 2):
            core = bare
        if len(core) < 3 or not any(map(str.isalpha, core)) or _CODE.fullmatch(core):
            return match.group()
        if _SUSPECT.search(core) or _TRIPLE.search(core):
            return read(core)
        return match.group()

    return _TOKEN.sub(word, _SPACED.sub(lambda m: read(m.group()), text.lower()))


_POWERS = np.cumprod(np.full(4096, 0xD6E8FEB86659FD93, dtype=np.uint64))
_LETTER = np.array([(97 <= b <= 122) or b >= 128 for b in range(256)])


def _hashed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


class _Hashed:
    """Features of the words of some lower-case texts: every word, and its beginnings."""

    def __init__(self, raw: list[bytes]):
        data = np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in raw])
        inside = _LETTER[data]
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.lengths = self.ends - self.starts
        self.text = np.searchsorted(ends, self.starts, "right")
        self.data = data
        place = np.zeros(len(data), dtype=np.int64)
        place[inside] = np.arange(len(data))[inside] - np.repeat(self.starts, self.lengths)
        terms = np.where(inside, (data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 4095], np.uint64(0))
        self.total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms)])

    def suspects(self) -> np.ndarray:
        """Texts with letters repeated three times, or three letters set apart by one place."""
        d = self.data
        triple = np.flatnonzero((d[:-2] == d[1:-1]) & (d[1:-1] == d[2:]) & _LETTER[d[2:]]) if len(d) > 2 else np.zeros(0, dtype=np.int64)
        found = self.text[np.searchsorted(self.starts, triple, "right") - 1] if len(triple) else triple
        single = self.lengths == 1
        apart = single[:-2] & single[1:-1] & single[2:] & (self.starts[2:] - self.starts[:-2] == 4) if len(single) > 2 else single[:0]
        return np.unique(np.concatenate([found, self.text[:-2][apart] if len(single) > 2 else found[:0]]))

    def features(self):
        """(text, feature) arrays, one pair for whole words and one for each length of beginnings."""
        whole = self.total[self.ends] - self.total[self.starts]
        yield self.text, _hashed(whole + np.uint64(7))
        for size in PREFIXES:
            long = self.lengths >= size
            at = self.starts[long]
            yield self.text[long], _hashed(self.total[at + size] - self.total[at])


def _prepared(piece: pa.Array, model, memo: dict[str, str]) -> _Hashed:
    """The hashed features of some texts after restoring disguised words."""
    raw = [(t or b"").lower() for t in pc.cast(piece, pa.binary()).to_pylist()]
    words = _Hashed(raw)
    doubtful = set(words.suspects().tolist())
    changed = False
    for i, text in enumerate(raw):
        if i in doubtful or _SUSPECT_BYTES.search(text):
            plain = restored(text.decode("utf-8", "replace"), model, memo).encode("utf-8", "surrogatepass")
            changed |= plain != text
            raw[i] = plain
    return _Hashed(raw) if changed else words


_SUSPECT_BYTES = re.compile(b"[" + b"".join(re.escape(c).encode() for c in LOOKALIKES if c < "\x7f") + rb"]+(?=[a-z\x80-\xff])|\xe2\x82\xac(?=[a-z])|\xc2\xa3(?=[a-z])|[a-z](?:[0-9@$]|\xe2\x82\xac|\xc2\xa3)")


def _memo(model: str) -> dict[str, str]:
    """The words that a worker has restored under the named language model; it remembers one model's."""
    memory = worker_memory("toxicity")
    if memory.get("restored_by") != model:
        memory["restored_by"], memory["restored"] = model, {}
    return memory["restored"]


class Toxicity:
    """A fitted model; `score` is the column function text -> probability of being toxic."""

    def __init__(self, docs: DataFrame, labelled: DataFrame, text: str = "text", label: str = "toxic"):
        """`docs`: all documents, for the language model. `labelled`: rows with text and label, all of which may be learnt."""
        spark = docs.sparkSession
        model, name = spark.sparkContext.broadcast(array("f", character_model(docs, text).ravel())), uuid.uuid4().hex

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def distinct_features(texts: pa.Array) -> pa.Array:
            pieces = []
            for piece in slices(texts, SLICE):
                parts = [t * (1 << FEATURE_BITS) + f for t, f in _prepared(piece, model.value, _memo(name)).features()]
                both = np.unique(np.concatenate(parts))
                per_text = np.bincount(both >> FEATURE_BITS, minlength=len(piece))
                pieces.append(list_array(pa.array((both & (1 << FEATURE_BITS) - 1).astype(np.int32)), per_text))
            return joined(pieces, pa.list_(pa.int32()))

        # distinct texts by their hash: copies of one text are one row with a weight, however many they are
        known = F.col(HASH) if HASH in labelled.columns else text_hash(text)
        hashed = labelled.filter(F.col(label).isNotNull()).select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("toxic"), known.alias("hash"))
        share = min(1.0, FIT_ROWS / max(1, hashed.select("hash", "toxic").distinct().count()))
        picked = hashed.filter(F.pmod("hash", F.lit(1 << 20)) < int(share * (1 << 20)))
        picked = picked.groupBy("text", "toxic").agg(F.count(F.lit(1)).alias("weight"))
        sample = written(picked.select("toxic", "weight", "text", distinct_features("text").alias("features")), "toxicity-sample")
        totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
        toxic, clean = totals.get(1, 0), totals.get(0, 0)
        self.features, weights = np.zeros(0, dtype=np.int64), np.array([-30.0 if not toxic else math.log(toxic / clean) if clean else 30.0, 0.0])
        if toxic and clean:
            counts = sample.select("toxic", "weight", F.explode("features").alias("feature")).groupBy("feature").agg(
                F.sum(F.col("toxic") * F.col("weight")).alias("in_toxic"), F.sum("weight").alias("in_all")
            )
            p = F.col("in_all") / (toxic + clean)
            z = (F.col("in_toxic") / toxic - (F.col("in_all") - F.col("in_toxic")) / clean) / F.sqrt(p * (1 - p + 1e-9) * (1 / toxic + 1 / clean))
            best = counts.withColumn("z", z).filter(F.col("z") >= LEAST_Z).filter("in_toxic >= 3").orderBy(F.desc("z"), "feature").limit(FEATURES)
            self.features = np.array(sorted(r["feature"] for r in best.select("feature").collect()), dtype=np.int64)
        column = spark.sparkContext.broadcast(self._columns())

        def design(piece: pa.Array) -> np.ndarray:
            """Per text: log counts of the features, and the log number of words."""
            words, columns = _prepared(piece, model.value, _memo(name)), column.value
            out = np.zeros((len(piece), int(columns.max(initial=-1)) + 2))
            for text_at, feature in words.features():
                at = columns[feature]
                np.add.at(out, (text_at[at >= 0], at[at >= 0]), 1)
            out[:, -1] = np.bincount(words.text, minlength=len(piece))
            return np.log1p(out)

        @F.arrow_udf(T.ArrayType(T.FloatType()))
        def designed(texts: pa.Array) -> pa.Array:
            parts = [design(piece) for piece in slices(texts, SLICE)]
            return joined([list_array(pa.array(d.astype(np.float32).ravel()), [d.shape[1]] * len(d)) for d in parts], pa.list_(pa.float32()))

        if len(self.features):
            # about FIT_ROWS rows of at most FEATURES + 1 numbers
            matrix = sample.select("toxic", "weight", designed("text").alias("x")).toArrow()
            # views of what has come, no copies
            blocks = [x.flatten().to_numpy().reshape(len(x), -1) for x in matrix["x"].chunks if len(x)]
            weights = fitted(blocks, matrix["toxic"].to_numpy(), matrix["weight"].to_numpy())
            del matrix, blocks
        self.weights = weights
        of_model = spark.sparkContext.broadcast(weights)

        @F.arrow_udf(T.DoubleType())
        def score(texts: pa.Array) -> pa.Array:
            w, parts = of_model.value, [np.zeros(0)]
            for piece in slices(texts, SLICE):
                x = design(piece)
                parts.append(1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -40, 40))))
            return pa.array(np.concatenate(parts))

        self.score = score

    def _columns(self) -> np.ndarray:
        columns = np.full(1 << FEATURE_BITS, -1, dtype=np.int16)
        columns[self.features] = np.arange(len(self.features))
        return columns


def fitted(x: np.ndarray | list[np.ndarray], y: np.ndarray, often: np.ndarray | None = None) -> np.ndarray:
    """Ridge logistic regression by Newton steps; intercept first. Rows (each counted `often` times) and columns are bounded, see `Toxicity`.

    `x` may come in blocks of rows. Only `FIT_SLICE` rows at a time are made wide numbers, so the driver holds the rows once, as they are.
    """
    blocks = x if isinstance(x, list) else [x]
    often = np.ones(len(y)) if often is None else often.astype(np.float64)
    ends = np.cumsum([0, *map(len, blocks)])
    places = [(k, i, min(i + FIT_SLICE, len(b))) for k, b in enumerate(blocks) for i in range(0, len(b), FIT_SLICE)]
    width = blocks[0].shape[1] + 1
    w, ridge = np.zeros(width), np.full(width, RIDGE)
    ridge[0] = 1e-6
    for _ in range(30):
        gradient, hessian = ridge * w, np.diag(ridge)
        for k, i, end in places:
            rows = np.ones((end - i, width))
            rows[:, 1:] = blocks[k][i:end]
            at = slice(ends[k] + i, ends[k] + end)
            p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
            gradient += rows.T @ (often[at] * (p - y[at]))
            hessian += (rows * (often[at] * (p * (1 - p) + 1e-6))[:, None]).T @ rows
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


HASH = "_hash_of_text"


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def labelled_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Text, label and the text's hash of the rows to learn from: labelled, and not held out.

    The hash is made before the join, so that only texts which are picked by it are moved.
    """
    usable = labels.filter((bucket_of(key, 5) != 0) & F.col(label).isNotNull()).select(key, label).dropDuplicates([key])
    return docs.select(key, text, text_hash(text).alias(HASH)).join(usable, key).select(text, label, HASH)


def without_toxic(docs: DataFrame, labels: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """`docs` less the rows predicted toxic, learnt from `labels` and the texts of `base` (else of `docs`)."""
    base = docs if base is None else base
    model = Toxicity(docs, labelled_rows(base, labels))
    return docs.filter(model.score("text") < 0.5)


@query("op9_toxicity")
def op9_toxicity(spark, folder):
    """Scores of all documents, learnt from the labels of four fifths of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = Toxicity(docs, labelled_rows(docs, table(spark, folder, "labels")))
    scored = docs.select("doc_id", (bucket_of("doc_id", 5) == 0).alias("held_out"), model.score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

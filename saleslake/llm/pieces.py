"""SentencePiece encoding and decoding by a prefix table of merge-type tokens.

A BPE vocabulary merges adjacent symbols by the score of what they form, the leftmost first among equals. For such
vocabularies the encoding of every prefix of a word is itself a prefix of encodings: each prefix has exactly one last token.
`PrefixTable` stores that token per prefix. Its candidates are the vocabulary entries that end there, found by walking
the automaton of all entries; the right one is the only one whose pair with the last token of the remaining prefix is
compatible, i.e. encodes to just these two. Ids are then recovered backwards, from the last token of the whole word.
Compatibility is decided by merging the two tokens' characters, and remembered.

Two things let long texts be cut without changing their encoding. No entry holds a space mark after another character, so
no merge crosses the start of a word. And entries of several space marks score below all others, so a run of marks is merged
after the word behind it has or has not taken the last mark. Both are verified when a vocabulary is read. Characters outside
the vocabulary become byte tokens and never merge.

Defined results: a null or empty text has no ids, and no ids decode to the empty text. Existing columns named like the
result are replaced.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm.common import list_array, query, slices, strings, table, worker_memory

MARK = "▁"
# Entries and characters that a worker remembers at most; a full memo starts again.
REMEMBERED_WORDS = 200_000
REMEMBERED_CHARACTERS = 1 << 24
PAIR_BITS = 21


def vocabulary(path: str) -> tuple[tuple[str, ...], tuple[float, ...], str]:
    """Pieces, scores and kinds (one letter per id: n normal, b byte, u unknown, c control) of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kinds = "".join(
        "b" if model.is_byte(i) else "u" if model.is_unknown(i) else "c" if model.is_control(i) or model.is_unused(i) else "n"
        for i in ids
    )
    return tuple(model.id_to_piece(i) for i in ids), tuple(model.get_score(i) for i in ids), kinds


class _Table:
    """An open hash table of non-negative 64-bit keys and small values, looked up by whole arrays."""

    def __init__(self, bits: int):
        self.bits, self.held = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int32)

    def find(self, asked: np.ndarray) -> np.ndarray:
        """The values of the keys, -1 where there is none."""
        slot = ((asked.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        keys = self.keys[slot]
        out = np.where(keys == asked, self.values[slot], np.int32(-1))
        left = np.flatnonzero((keys != asked) & (keys >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            keys = self.keys[slot[left]]
            same = keys == asked[left]
            out[left[same]] = self.values[slot[left[same]]]
            left = left[~same & (keys >= 0)]
        return out

    def add(self, key: int, value: int) -> None:
        slot = ((key * 0x9E3779B97F4A7C15) & (1 << 64) - 1) >> (64 - self.bits)
        while self.keys[slot] >= 0:
            slot = (slot + 1) & ((1 << self.bits) - 1)
        self.keys[slot], self.values[slot] = key, value
        self.held += 1

    @property
    def full(self) -> bool:
        return self.held * 2 > 1 << self.bits


class _Index(dict):
    """Numbers segments in the order in which they are first asked for."""

    def __missing__(self, segment: str) -> int:
        self[segment] = number = len(self)
        return number


class PrefixTable:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, pieces: tuple[str, ...], scores: tuple[float, ...], kinds: str):
        self.pieces, self.scores = pieces, scores
        self.ids = {p: i for i, p in enumerate(pieces) if kinds[i] == "n"}
        self.byte_ids = {int(pieces[i][1:-1], 16): i for i in range(len(pieces)) if kinds[i] == "b"}
        runs = [p for p in self.ids if len(p) > 1 and not p.strip(MARK)]
        if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) for p in self.ids):
            raise ValueError("an entry crosses the start of a word")
        least = min((scores[i] for p, i in self.ids.items() if len(p) > 1 and p.strip(MARK)), default=0.0)
        if any(scores[self.ids[p]] >= least for p in runs):
            raise ValueError("runs of spaces are merged before words")
        self.known = frozenset(p for p in self.ids if len(p) == 1)
        outside = "".join(map(re.escape, sorted(self.known)))
        self.part = re.compile(f"[{outside}]+|[^{outside}]").findall
        self._automaton([p for p in self.ids if p not in set(runs)])
        # a line end that has no entry of its own is a barrier like a space, and cuts words shorter
        self.cuts_lines = "\n" not in self.known
        ends = "\n" if self.cuts_lines else ""
        self.cut = re.compile(f"{MARK}+[^{MARK}{ends}]*|[^{MARK}{ends}]+" + ("|\n+" if ends else "")).findall
        self.bytes_of = [
            b" \xe2\x81\x87 " if k == "u" else b"" if k == "c" else bytes([int(p[1:-1], 16)]) if k == "b" else p.replace(MARK, " ").encode()
            for p, k in zip(pieces, kinds, strict=True)
        ]
        self.length_of = np.array([len(p) for p in pieces])
        self.pairs = _Table(PAIR_BITS)
        self._forget()
        self.runs: dict[int, np.ndarray] = {}

    def _forget(self) -> None:
        self.index, self.flat, self.characters = _Index(), np.zeros(0, dtype=np.int32), 0
        self.starts, self.sizes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _automaton(self, entries: list[str]) -> None:
        """The prefix tree of all entries as a hash table of edges (state, character) -> state."""
        numbers = {c: i for i, c in enumerate(sorted({c for p in entries for c in p}))}
        self.alphabet = len(numbers)
        self.char_at = np.zeros(max(map(ord, numbers)) + 1, dtype=np.int64)
        self.char_at[[ord(c) for c in numbers]] = list(numbers.values())
        edges: dict[int, int] = {}
        tokens = [-1]
        for piece in entries:
            state = 0
            for c in piece:
                edge = state * self.alphabet + numbers[c]
                state = edges.setdefault(edge, len(tokens))
                if state == len(tokens):
                    tokens.append(-1)
            tokens[state] = self.ids[piece]
        self.token_at = np.array(tokens)
        self.edges = _Table(max(10, (4 * len(edges)).bit_length()))
        for edge, state in edges.items():
            self.edges.add(edge, state)

    def merged(self, text: str) -> list[int]:
        """Plain merging of known characters: the best score first, the leftmost among equals."""
        symbols, after = list(text), list(range(1, len(text) + 1))
        before, queue = list(range(-1, len(text) - 1)), []

        def propose(left: int) -> None:
            right = after[left]
            if right < len(symbols) and (i := self.ids.get(symbols[left] + symbols[right])) is not None:
                heapq.heappush(queue, (-self.scores[i], left, right, symbols[left], symbols[right]))

        for left in range(len(symbols) - 1):
            propose(left)
        while queue:
            _, left, right, a, b = heapq.heappop(queue)
            if symbols[left] != a or symbols[right] != b or after[left] != right:
                continue
            symbols[left], symbols[right] = a + b, ""
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            if before[left] >= 0:
                propose(before[left])
            propose(left)
        return [self.ids[s] for s in symbols if s]

    def run(self, length: int) -> np.ndarray:
        """Ids of a run of marks."""
        if length not in self.runs:
            if len(self.runs) > 1000:
                self.runs.clear()
            self.runs[length] = np.array(self.merged(MARK * length), dtype=np.int32)
        return self.runs[length]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens' characters encode to just these two; with left < 0, whether the token stands alone."""
        pieces, ids, scores = self.pieces, self.ids, self.scores
        border = 0 if left < 0 else len(pieces[left])
        symbols = list(pieces[right] if left < 0 else pieces[left] + pieces[right])
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                token = ids.get(symbols[i] + symbols[i + 1])
                if token is not None and (best is None or scores[token] > best):
                    best, at = scores[token], i
            if best is None:
                return len(symbols) == 1 + (border > 0) and border < 2
            if at == border - 1:
                return False  # the two would merge
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            border -= at < border

    def compatible_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`compatible` of many pairs, each pair decided once."""
        asked = (left + 1) * len(self.pieces) + right
        known = self.pairs.find(asked)
        while (new := known < 0).any():
            if self.pairs.full:
                self.pairs = _Table(PAIR_BITS)
            # at most a quarter of the table at once, so that a new table holds what is asked
            for key in np.unique(asked[new])[: 1 << (PAIR_BITS - 2)].tolist():
                self.pairs.add(key, self.compatible(key // len(self.pieces) - 1, key % len(self.pieces)))
            known[new] = self.pairs.find(asked[new])
        return known > 0

    def matches(self, chars: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All places (word, start, end, token) where an entry occurs, from one automaton walk per character position.

        The states of all words advance together: `edges` holds the transitions of the prefix tree of all entries, so a walk
        from each start visits just the entries that begin there.
        """
        width, found = chars.shape[1], []
        for start in range(width):
            word = np.flatnonzero(lengths > start)
            state, end = np.zeros(len(word), dtype=np.int64), start
            while len(word) and end < width:
                state = self.edges.find(state * self.alphabet + chars[word, end])
                end += 1
                alive = state > 0
                word, state = word[alive], state[alive].astype(np.int64)
                token = self.token_at[state]
                hit = token >= 0
                found.append((word[hit], np.full(hit.sum(), start), np.full(hit.sum(), end), token[hit]))
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def known_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of known characters, one after another, and the number of ids of each; from prefix tables."""
        lengths = np.array([len(w) for w in words])
        flat = self.char_at[np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)]
        chars = np.zeros((len(words), int(lengths.max())), dtype=np.int64)
        chars[np.arange(chars.shape[1]) < lengths[:, None]] = flat
        word, start, end, token = self.matches(chars, lengths)
        order = np.argsort(end, kind="stable")
        word, start, end, token = word[order], start[order], end[order], token[order]
        cuts = np.searchsorted(end, np.arange(1, chars.shape[1] + 2))
        last = np.full((len(words), chars.shape[1] + 1), -1)
        for at in range(1, chars.shape[1] + 1):
            here = slice(cuts[at - 1], cuts[at])
            fits = self.compatible_all(last[word[here], start[here]], token[here])
            last[word[here][fits], at] = token[here][fits]
        at, word, taken = lengths.copy(), np.arange(len(words)), []
        while len(word):
            token = last[word, at[word]]
            at[word] -= self.length_of[token]
            taken.append((word, at[word], token))
            word = word[at[word] > 0]
        word, start, token = (np.concatenate(column) for column in zip(*taken, strict=True))
        return token[np.lexsort((start, word))].astype(np.int32), np.bincount(word, minlength=len(words))

    def segment(self, segment: str) -> np.ndarray:
        """Ids of any segment: a run of marks and the word behind it, or a piece without marks."""
        rest = segment.lstrip(MARK)
        marks = len(segment) - len(rest)
        if not rest:
            return self.run(marks)
        ids = []
        for part in self.part((MARK if marks else "") + rest):  # unknown characters stand alone between the parts
            if part[0] in self.known:
                ids.append(self.known_words([part])[0])
            else:
                ids.append(np.array([self.byte_ids[b] for b in part.encode()], dtype=np.int32))
        if marks and ids[0][0] == self.ids.get(MARK):
            ids = [self.run(marks), ids[0][1:], *ids[1:]]
        elif marks > 1:
            ids = [self.run(marks - 1), *ids]
        return np.concatenate(ids)

    def learn(self, segments: list[str]) -> None:
        """Append the ids of new segments to what this worker remembers, in the order of `index`."""
        first, single = len(self.sizes), [len(s) > 0 and s[:2] != MARK * 2 and self.known.issuperset(s) for s in segments]
        starts, sizes = np.zeros(len(segments), dtype=np.int64), np.zeros(len(segments), dtype=np.int64)
        total, flat = len(self.flat), [self.flat]
        plain = np.flatnonzero(np.array(single, dtype=bool))
        lengths = np.array([len(segments[i]) for i in plain.tolist()], dtype=np.int64)
        plain = plain[np.argsort(lengths, kind="stable")]
        lengths = np.sort(lengths)
        at = 0
        while at < len(plain):  # words of similar length together; the matrices of a batch stay at a few megabytes
            stop = min(np.searchsorted(lengths, max(8, lengths[at] * 5 // 4), "right"), at + max(1, (1 << 19) // lengths[at]))
            here = plain[at:stop]
            ids, counts = self.known_words([segments[i] for i in here.tolist()])
            starts[here], sizes[here] = total + np.cumsum(counts) - counts, counts
            flat.append(ids)
            total, at = total + len(ids), stop
        for i in np.flatnonzero(~np.array(single, dtype=bool)).tolist():
            if segments[i]:
                ids = self.segment(segments[i])
                starts[i], sizes[i] = total, len(ids)
                flat.append(ids)
                total += len(ids)
        self.flat = np.concatenate(flat)
        self.characters += sum(map(len, segments))
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        assert len(self.sizes) == first + len(segments)

    def split(self, text: str) -> list[str]:
        """Segments of a text; some may be empty."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if MARK * 2 in marked or "\x01" in marked:
            return self.cut(marked)
        marked = marked.replace(MARK, "\x01" + MARK)
        return (marked.replace("\n", "\x01\n\x01") if self.cuts_lines else marked).split("\x01")

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after another, and the number of ids of each."""
        if len(self.index) > REMEMBERED_WORDS or self.characters > REMEMBERED_CHARACTERS:
            self._forget()
        before, at, counts = len(self.index), [], []
        for text in texts:
            segments = self.split(text)
            at.append(np.fromiter(map(self.index.__getitem__, segments), dtype=np.int64, count=len(segments)))
            counts.append(len(segments))
        at = np.concatenate(at) if at else np.zeros(0, dtype=np.int64)
        if len(self.index) > before:
            self.learn(list(itertools.islice(self.index, before, None)))
        starts, sizes = self.starts[at], self.sizes[at]
        ends = np.cumsum(sizes)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]
        per_text = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return ids, np.diff(per_text)

    def decoded(self, ids: list[int]) -> str:
        """The text of ids; one leading space goes, and each byte that is no UTF-8 becomes U+FFFD."""
        if not ids:
            return ""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        first = next((i for i in ids if self.bytes_of[i]), None)
        if first is not None and self.pieces[first].startswith(MARK):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return raw.decode(errors="piecewise")


def _bytewise(error: UnicodeDecodeError):
    """One replacement character per byte that does not belong to a whole character."""
    return "�", error.start + 1


def _of_worker(pieces, scores, kinds) -> PrefixTable:
    """The worker's table for a vocabulary; it remembers the last one."""
    import codecs

    codecs.register_error("piecewise", _bytewise)
    memory, key = worker_memory("pieces"), hash((pieces, scores, kinds))
    if memory.get("key") != key:
        memory["key"], memory["table"] = key, PrefixTable(pieces, scores, kinds)
    return memory["table"]


CODED = "ids array<int>, decoded string"


class Pieces:
    """The column functions of one model file: `encode`, `decode`, and `coded`, which does both and encodes each text once.

    The vocabulary, bounded by that file, is broadcast. Results leave a worker in pieces of the size of `slices`.
    """

    def __init__(self, spark: SparkSession, path: str):
        shared = spark.sparkContext.broadcast(vocabulary(path))

        @F.arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            of = _of_worker(*shared.value)
            for texts in batches:
                for piece in slices(texts):
                    ids, counts = of.encoded(strings(piece))
                    yield list_array(pa.array(ids), counts)

        @F.arrow_udf("string")
        def decode(ids: pa.Array) -> pa.Array:
            of = _of_worker(*shared.value)
            # row by row: the ids of a whole batch as Python integers would take many times its size
            return pa.array([of.decoded(row.as_py() or []) for row in ids], pa.string())

        @F.arrow_udf(CODED)
        def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            of = _of_worker(*shared.value)
            for texts in batches:
                for piece in slices(texts):
                    ids, counts = of.encoded(strings(piece))
                    ends = np.cumsum(counts).tolist()
                    plain = [of.decoded(ids[a:z].tolist()) for a, z in zip([0, *ends], ends, strict=False)]
                    columns = [list_array(pa.array(ids), counts), pa.array(plain, pa.string())]
                    yield pa.StructArray.from_arrays(columns, names=["ids", "decoded"])

        # equal input gives equal output; the mark keeps the optimizer from running it once for each use of its result
        self.encode, self.decode, self.coded = encode.asNondeterministic(), decode, coded.asNondeterministic()


def with_ids(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of the text column as an array."""
    return df.withColumn(ids, Pieces(df.sparkSession, path).encode(text))


def with_decoded(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text of the id column."""
    return df.withColumn(decoded, Pieces(df.sparkSession, path).decode(ids))


def model_path() -> str:
    """The vocabulary of the registered query: a file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op4_piece_ids")
def op4_piece_ids(spark, folder):
    """Every document encoded and decoded again, as counts and digests."""
    model = Pieces(spark, model_path())
    found = table(spark, folder, "documents").select("doc_id", model.coded("text").alias("coded"))
    return found.select(
        "doc_id",
        F.size("coded.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("coded.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )

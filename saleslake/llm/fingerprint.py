"""Document fingerprints by a homomorphic multiset hash over paragraphs.

A paragraph (a line that isn't blank) is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors,
lane by lane and modulo a power of two. So the order of paragraphs does not matter, a paragraph is inserted or deleted by
adding or subtracting its vector, and fingerprints of parts add up to that of the whole.

The vector has two parts. `LANES` lanes modulo 2**16 come from an extendable-output hash of the paragraph; they
decide equality. `SKETCH` lanes modulo 2**32 are a signed count sketch of its three-word runs (the whole line where it is
shorter); their scalar products estimate how many runs two documents share, which gives the likeness.

Defined results: null is the empty text; the empty text, or one of blank lines only, is the zero vector; two
zero vectors are alike (1); the vectors are written in base64. Existing columns named like the results are replaced.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm.common import joined, query, slices, strings, table

LANES = 64
SKETCH = 256
RUN = 3
_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64))
_BYTES = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)], dtype=np.uint64)
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", dtype=np.uint8))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sketches(raw: list[bytes]) -> np.ndarray:
    """One signed count sketch per text."""
    data = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    text_ends = np.cumsum([len(t) + 1 for t in raw])
    edges = np.flatnonzero(np.diff((~_BLANK[data]).astype(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros((len(raw), SKETCH), dtype=np.int64)
    inside = ~_BLANK[data]
    place = np.arange(len(data)) - np.repeat(np.concatenate([starts, [len(data)]]), np.diff(np.concatenate([[0], starts[1:], [len(data)], [len(data)]])))
    terms = np.where(inside, _BYTES[data] * _POWERS[place & 4095], np.uint64(0))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms)])
    words = _mixed(total[ends] - total[starts])
    line = np.cumsum(data == 10)[starts]
    text = np.searchsorted(text_ends, starts, "right")
    run, whole = words * np.uint64(3), np.ones(len(words), dtype=bool)
    for k in range(1, RUN):
        follows = np.zeros(len(words), dtype=bool)
        follows[: len(words) - k] = line[k:] == line[: len(words) - k]
        later = np.concatenate([words[k:], np.zeros(min(k, len(words)), dtype=np.uint64)])[: len(words)]
        run = run + np.where(follows, _mixed(later + np.uint64(k)), np.uint64(0))
        whole &= follows
    first = np.concatenate([[True], line[1:] != line[:-1]])
    length = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1]
    kept = whole | (first & (length < RUN))
    hashes, text = _mixed(run[kept]), text[kept]
    lane = text * SKETCH + (hashes & np.uint64(SKETCH - 1)).astype(np.int64)
    sign = 1.0 - 2.0 * ((hashes >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    return np.rint(np.bincount(lane, sign, len(raw) * SKETCH)).astype(np.int64).reshape(len(raw), SKETCH)


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Equality lanes (uint16) and sketch lanes (int32) of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lanes = np.zeros((len(raw), LANES), dtype=np.uint16)
    for i, text in enumerate(raw):
        lines = [line for line in text.split(b"\n") if line.strip()]
        if lines:
            digests = b"".join(hashlib.shake_128(line).digest(2 * LANES) for line in lines)
            lanes[i] = np.frombuffer(digests, dtype="<u2").reshape(-1, LANES).sum(axis=0, dtype=np.uint16)
    with np.errstate(over="ignore"):
        return lanes, _sketches(raw).astype(np.int32)


def written_out(lanes: np.ndarray, sketch: np.ndarray) -> str:
    return base64.b64encode(lanes.astype("<u2").tobytes() + sketch.astype("<i4").tobytes()).decode()


def read_in(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[: 2 * LANES], dtype="<u2"), np.frombuffer(raw[2 * LANES :], dtype="<i4")


def combined(fingerprint: str, other: str, sign: int = 1) -> str:
    """The fingerprint of all paragraphs of both; with sign -1, of the first less those of the other."""
    (a, x), (b, y) = read_in(fingerprint), read_in(other)
    with np.errstate(over="ignore"):
        return written_out(a + np.uint16(sign % 65536) * b, x + np.int32(sign) * y)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """About the share of runs in common, against the larger of the two; exactly 1 for equal fingerprints."""
    if np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]):
        return 1.0
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    return float(np.clip(x @ y / max(x @ x, y @ y, 1.0), 0.0, 1.0))


@F.arrow_udf(T.StringType())
def fingerprint(texts: pa.Array) -> pa.Array:
    pieces = [pa.array(map(written_out, *vectors(strings(piece))), pa.string()) for piece in slices(texts)]
    return joined(pieces, pa.string())


def _updated(sign: int):
    @F.arrow_udf(T.StringType())
    def update(fingerprints: pa.Array, texts: pa.Array) -> pa.Array:
        other = [written_out(*v) for v in zip(*vectors(strings(texts)), strict=True)]
        return pa.array([combined(f, o, sign) for f, o in zip(fingerprints.to_pylist(), other, strict=True)], pa.string())

    return update


with_paragraphs, without_paragraphs = _updated(1), _updated(-1)  # column functions (fingerprint, text) -> fingerprint


def with_fingerprint(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("fingerprint", fingerprint(text))


# --- neighbours in the order of a key ---


def _range_of(key: str, bounds: list, first: int = 0):
    """The number of bounds at or below the key, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    below, above = _range_of(key, bounds[:middle], first), _range_of(key, bounds[middle + 1 :], first + middle + 1)
    return F.when(F.col(key) < bounds[middle], below).otherwise(above)


def in_ranges(df: DataFrame, key: str, then: list[str]) -> DataFrame:
    """Rows dealt to tasks by ranges of `key` and sorted there by (`_ahead`, key, *then), nulls first.

    After its own rows (`_ahead` 0) each task finds the rows with the first key of the next range (`_ahead` 1), and the task
    of the last range those of the first range. Only cut points and first keys, one per task, pass through the driver.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(df.approxQuantile(key, [i / parts for i in range(1, parts)], 0.1 / parts)))
    bounds = [int(b) for b in bounds]
    at = F.when(F.col(key).isNull(), F.lit(0)).otherwise(_range_of(key, bounds))
    rows = df.withColumn("_at", at)
    found = {r["_at"]: r for r in rows.groupBy("_at").agg(F.min(key).alias("least"), F.max(F.col(key).isNull()).alias("nulls")).collect()}
    used = sorted(found)
    before = {now: used[i - 1] for i, now in enumerate(used)}
    opens = F.lit(False)
    if used:
        firsts = [found[r]["least"] for r in used if not found[r]["nulls"]]
        opens = F.coalesce(F.col(key).isin(firsts), F.lit(bool(found[used[0]]["nulls"])))
    target = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("_at")] if used else F.lit(0)
    own = F.struct(F.col("_at").alias("to"), F.lit(0).alias("ahead"))
    dealt = rows.withColumn("_to", F.explode(F.when(opens, F.array(own, F.struct(target.alias("to"), F.lit(1).alias("ahead")))).otherwise(F.array(own))))
    dealt = dealt.select(*df.columns, F.col("_to.to").alias("_part"), F.col("_to.ahead").alias("_ahead"))
    return dealt.repartitionById(len(bounds) + 1, F.col("_part")).sortWithinPartitions("_ahead", F.asc_nulls_first(key), *map(F.asc_nulls_first, then)).drop("_part")


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _compared(batches):
    """For each row in order, its text against its edited text and against the next row."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    last = None  # (key, text) of the row that waits for the next
    for batch in batches:
        start = 0
        for piece in slices(batch["text"]):
            keys = batch["doc_id"].slice(start, len(piece)).to_pylist()
            ahead = batch["_ahead"].slice(start, len(piece)).to_pylist()
            start += len(piece)
            rows = [] if last is None else [last]
            for key, text, flag in zip(keys, strings(piece), ahead, strict=True):
                rows.append((key, text))
                if flag:
                    break
            last = None if ahead[-1] and 1 in ahead and len(rows) < 2 else rows[-1]
            if len(rows) > 1:
                texts = [t for _, t in rows]
                edited = [edited_text(a, b) for a, b in zip(texts, texts[1:], strict=False)]
                lanes, sketch = vectors(texts)
                e_lanes, e_sketch = vectors(edited)
                out = []
                for i, text in enumerate(edited):
                    mine, other, following = (lanes[i], sketch[i]), (e_lanes[i], e_sketch[i]), (lanes[i + 1], sketch[i + 1])
                    digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((rows[i][0], len(texts[i]), digest, written_out(*mine), written_out(*other), likeness(mine, other), likeness(mine, following)))
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            if 1 in ahead:
                return


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and their edited texts, and their likeness to those and to the next document.

    Documents follow each other by doc_id (nulls first; equal keys by text), the first follows the last; each row counts, so
    repeated rows follow each other. A single row follows itself.
    """
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
        "near_next double"
    )
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return in_ranges(rows, "doc_id", ["text"]).mapInArrow(_compared, schema)


@query("op8_multiset_fingerprints")
def op8_multiset_fingerprints(spark, folder):
    return compared_with_next(table(spark, folder, "documents"))

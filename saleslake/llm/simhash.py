"""SimHash fingerprints and their exact similarity join by the generalised pigeonhole principle.

Join. The bits are put into an order that keeps correlated bits together (`bit_order`, from one co-occurrence count over all
fingerprints) and cut into m parts. If two fingerprints differ in at most `tau` bits and the thresholds of the parts
sum to `tau - m + 1`, they differ in some part by no more than its threshold; a part may have the threshold -1 and is not
probed then. Thresholds and m come from dynamic programming over estimated costs: the keys to emit, and the candidate
pairs expected from exact histograms of 8-bit chunks, whose distance distributions are convolved (`allocation`).
To differ by at most t bits within a part is to agree outside some t of its bits, so each fingerprint emits one key per
choice of t bits of each probed part, and candidates are the members of a bucket. They are verified by the bits that differ.

Hot buckets. A bucket with more than `HOT` members isn't paired. The bits that it leaves open are cut into tau + 1 parts, and its
members emit one finer key per part, by the same principle. Where no more than `OPEN` bits are open, they emit one key per
choice of `tau` of them, holding all other bits: members are linked exactly if they share such a key, and a key has at
most 2**tau distinct fingerprints. So the work stays linear in the members, however alike they are.

Defined results: a null or empty text, or one without words, has fingerprint zero, which is linked like any other. Rows with a
null key keep their fingerprint and component. Columns named like the results are replaced.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm.common import joined, list_array, query, slices, table
from saleslake.llm.components import components
from saleslake.sources.shared import written

BITS = 64
CHUNK = 8
HOT = 200
OPEN = 12  # open bits down to which a crowded bucket is made finer
SEED = 42
BLOCK = 1 << 16  # features whose bits are held unpacked at a time
# Relative cost of an emitted key and of a candidate pair.
KEY_COST, PAIR_COST = 1.0, 0.3


def words_of(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text, with A-Z in lower case, cut at the six ASCII spaces."""
    return raw.lower().split()


def shingle_hashes(raw: bytes, words: int) -> np.ndarray:
    """XXH64 of each run of `words` words, repeats included; of the whole sequence where there are fewer words."""
    import xxhash

    parts = words_of(raw)
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    text, digest = b" ".join(parts), xxhash.xxh64_intdigest
    ends = list(itertools.accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends[:-1]]
    hashes = [digest(text[s : e - 1], SEED) for s, e in zip(starts, ends[min(words, len(parts)) - 1 :], strict=False)]
    return np.array(hashes, dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes."""
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _raw_texts(piece: pa.Array) -> list[bytes]:
    return [t or b"" for t in pc.cast(piece, pa.binary()).to_pylist()]


def fingerprint_of(words: int) -> Column:
    """The column function text -> fingerprint over shingles of `words` words, as a signed 64-bit number."""

    @F.arrow_udf(T.LongType())
    def fingerprint(texts: pa.Array) -> pa.Array:
        pieces = []
        for piece in slices(texts):
            numbers = [majority(shingle_hashes(raw, words)) for raw in _raw_texts(piece)]
            pieces.append(pa.array(np.array(numbers, dtype=np.uint64).view(np.int64)))
        return joined(pieces, pa.int64())

    return fingerprint


# --- the join ---


def _unpacked(numbers: np.ndarray) -> np.ndarray:
    return np.unpackbits(numbers.astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _counted(fingerprints: DataFrame, tally) -> np.ndarray:
    """`tally` (an array of counts per block of fingerprints) summed over all rows; the result is as small as one block's."""

    def counts(batches):
        total = None
        for batch in batches:
            numbers = batch["p"].to_numpy(zero_copy_only=False)
            for i in range(0, len(numbers), BLOCK):
                here = tally(numbers[i : i + BLOCK])
                total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "n"])

    summed = fingerprints.select("p").mapInArrow(counts, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    found = summed.toArrow()
    out = np.zeros(tally(np.zeros(0, dtype=np.int64)).size, dtype=np.int64)
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out


def _together(numbers: np.ndarray) -> np.ndarray:
    bits = _unpacked(numbers).astype(np.float32)
    return np.rint(bits.T @ bits).astype(np.int64)


def bit_order(together: np.ndarray, n: int) -> list[int]:
    """All bits, chunk by chunk; each chunk is filled with the bits that correlate most with those it holds already."""
    share = together / max(1, n)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    related = np.abs((share - np.outer(p, p)) / spread)
    np.fill_diagonal(related, 0)
    left, order = set(range(BITS)), []
    while left:
        rest = sorted(left)
        chunk = [max(rest, key=lambda b: related[b, rest].sum())]
        left.remove(chunk[0])
        while left and len(chunk) < CHUNK:
            chunk.append(max(sorted(left), key=lambda b: related[b, chunk].sum()))
            left.remove(chunk[-1])
        order += chunk
    return order


def _arranged(numbers: np.ndarray, order: list[int]) -> np.ndarray:
    packed = np.packbits(_unpacked(numbers)[:, order], axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.int64)[:, 0]


def _distances(histogram: np.ndarray) -> np.ndarray:
    """Of two random rows, the probability of each distance within a chunk."""
    share = histogram / max(1, histogram.sum())
    values = np.arange(len(share))
    weight = np.array([bin(v).count("1") for v in values])
    return np.array([(share[:, None] * share[values[:, None] ^ values[weight == d][None, :]]).sum() for d in range(CHUNK + 1)])


def allocation(histograms: np.ndarray, n: int, tau: int) -> list[tuple[int, int, int]]:
    """(first bit, width, threshold) of the probed parts: the cheapest m and thresholds by dynamic programming."""
    chunks = BITS // CHUNK
    near = [_distances(h) for h in histograms]
    best = (math.inf, [])
    for parts in range(1, chunks + 1):
        cuts = [round(i * chunks / parts) for i in range(parts + 1)]
        costs = []
        for first, stop in itertools.pairwise(cuts):
            width, law = (stop - first) * CHUNK, np.array([1.0])
            for c in range(first, stop):
                law = np.convolve(law, near[c])
            # two rows at distance d within the part meet under every choice of t bits that holds their d bits
            meet = [sum(law[d] * math.comb(width - d, t - d) for d in range(t + 1)) for t in range(tau + 1)]
            keys = [n * math.comb(width, t) for t in range(tau + 1)]
            costs.append([0.0] + [KEY_COST * k + PAIR_COST * n * n / 2 * m for k, m in zip(keys, meet, strict=True)])
        # reached[s]: cheapest choice for the parts so far with thresholds that sum to s
        reached: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (spent, chosen) in reached.items():
                for t in range(-1, tau + 1):
                    new = (spent + cost[t + 1], [*chosen, t])
                    if total + t not in step or new < step[total + t]:
                        step[total + t] = new
            reached = step
        spent, chosen = reached.get(tau - parts + 1, (math.inf, []))
        if spent < best[0]:
            bounds = zip(itertools.pairwise(cuts), chosen, strict=True)
            best = spent, [(a * CHUNK, (b - a) * CHUNK, t) for (a, b), t in bounds if t >= 0]
    return best[1]


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def _choices(bits: list[int], size: int) -> list[int]:
    """One mask per choice of `size` of the bits."""
    return [sum(1 << b for b in chosen) for chosen in itertools.combinations(bits, size)]


def links(fingerprints: DataFrame, tau: int, reach: int | None = None) -> DataFrame:
    """All (a, b) with a < b of the distinct numbers in column `p` that differ in at most `tau` bits.

    A column `space` may hold groups that are joined apart (fingerprints of different kinds). With `reach`, for proposals that
    are verified anyway, members of a crowded bucket are linked to its first member as well if they differ from it in at
    most `reach` bits. That only adds links.
    """
    space = "space" in fingerprints.columns
    fingerprints = fingerprints if space else fingerprints.withColumn("space", F.lit(0))
    n = fingerprints.count()
    order = bit_order(_counted(fingerprints, _together).reshape(BITS, BITS), n)

    def chunk_values(numbers: np.ndarray) -> np.ndarray:
        chunks = _arranged(numbers, order).view(np.uint8).reshape(-1, BITS // CHUNK)
        return np.stack([np.bincount(chunks[:, c], minlength=1 << CHUNK) for c in range(BITS // CHUNK)])

    parts = allocation(_counted(fingerprints, chunk_values).reshape(BITS // CHUNK, 1 << CHUNK), n, tau)

    @F.arrow_udf(T.LongType())
    def arranged(numbers: pa.Array) -> pa.Array:
        return pa.array(_arranged(numbers.to_numpy(zero_copy_only=False), order))

    # a key is the number of the bits that it fixes, and their values
    start = [
        ((1 << width) - 1 << first) & ~mask
        for first, width, t in parts
        for mask in _choices(list(range(first, first + width)), t)
    ]
    fixed = F.explode(F.array(*[F.lit(_signed(f)).cast("bigint") for f in start]))
    entries = fingerprints.select("space", "p", arranged("p").alias("q")).select("*", fixed.alias("fixed"))
    bucket, pairs = ["space", "fixed", "value"], None
    while True:
        keyed = entries.withColumn("value", F.col("q").bitwiseAND(F.col("fixed")))
        first = F.min(F.struct("q", "p")).alias("first")
        sizes = keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members"), first).filter("members > 1")
        members = written(keyed.join(written(sizes, "simhash-buckets"), bucket), "simhash-members")
        few = members.filter(F.col("members") <= HOT)
        near = F.expr(f"bit_count(a.q ^ b.q) <= {tau} and a.p < b.p")
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in bucket]
        found = few.alias("a").join(few.alias("b"), [*same, near])
        pairs = _united(pairs, found.select("a.space", F.col("a.p").alias("a"), F.col("b.p").alias("b")))
        hot = members.filter(F.col("members") > HOT).select("space", "p", "q", "fixed", "first")
        if reach is not None:
            close = F.expr(f"bit_count(q ^ first.q) <= {reach}")
            ends = [f(F.col("p"), F.col("first.p")).alias(c) for f, c in ((F.least, "a"), (F.greatest, "b"))]
            pairs = _united(pairs, hot.filter(close).select("space", *ends).filter("a < b"))
        hot = hot.drop("first")
        # one number per kind of key
        masks = [row[0] & (1 << BITS) - 1 for row in hot.select("fixed").distinct().collect()]
        narrow = [f for f in masks if BITS - bin(f).count("1") <= max(OPEN, tau)]
        if narrow:
            pairs = _united(pairs, _linked_by_choices(hot, narrow, tau))
        wide = [f for f in masks if f not in narrow]
        if not wide:
            break
        entries = _joined_masks(hot, {f: _finer(f, tau) for f in wide}, "finer").select("space", "p", "q", F.col("finer").alias("fixed"))
    pairs = pairs.distinct()
    return pairs if space else pairs.drop("space")


def _united(first: DataFrame | None, second: DataFrame) -> DataFrame:
    return second if first is None else first.union(second)


def _finer(fixed: int, tau: int) -> list[int]:
    """The open bits cut into tau + 1 parts, each fixed on top: rows at `tau` bits agree in one of the parts."""
    bits = [b for b in range(BITS) if not fixed >> b & 1]
    cuts = [round(i * len(bits) / (tau + 1)) for i in range(tau + 2)]
    return [fixed | sum(1 << b for b in bits[a:z]) for a, z in itertools.pairwise(cuts)]


def _joined_masks(rows: DataFrame, masks: dict[int, list[int]], name: str) -> DataFrame:
    """Each row once for every number of its `fixed`. The numbers depend on the bits only, not on the data's size."""
    flat = [(_signed(f), _signed(m)) for f, many in masks.items() for m in many]
    small = rows.sparkSession.createDataFrame(flat, f"fixed bigint, {name} bigint")
    return rows.join(F.broadcast(small), "fixed")


def _linked_by_choices(hot: DataFrame, masks: list[int], tau: int) -> DataFrame:
    """Links within crowded buckets: rows that agree outside some `tau` of the open bits."""
    every = (1 << BITS) - 1
    kept = {f: [every & ~m for m in _choices([b for b in range(BITS) if not f >> b & 1], tau)] for f in masks}
    groups = (
        _joined_masks(hot, kept, "kept")
        .groupBy("space", "kept", F.col("q").bitwiseAND(F.col("kept")).alias("rest"))
        .agg(F.collect_set("p").alias("all"))  # at most 2**tau
        .filter(F.size("all") > 1)
    )
    close = groups.select("space", F.explode("all").alias("b"), "all").select("space", F.explode("all").alias("a"), "b")
    return close.filter("a < b")


def clustered(df: DataFrame, key: str, words: int, tau: int, text: str = "text") -> DataFrame:
    """(key, fingerprint number `p`, component_id): components of fingerprints linked at `tau` or fewer bits.

    The component is the smallest key reachable over links, null only where no row of it has a key.
    """
    prints = written(df.select(key, fingerprint_of(words)(text).alias("p")), "simhash-prints")
    distinct = written(prints.groupBy("p").agg(F.min(key).alias("least")), "simhash-distinct")
    linked = written(components(links(distinct.select("p"), tau)).withColumnRenamed("node", "p"), "simhash-linked")
    ids = distinct.join(linked, "p").groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(written(ids, "simhash-ids"), "root").select("p", "component_id")
    all_ids = written(
        distinct.join(named, "p", "left").select("p", F.coalesce("component_id", "least").alias("component_id")),
        "simhash-components",
    )
    return prints.join(all_ids, "p").select(key, "p", "component_id")


@query("op1_simhash_links")
def op1_simhash_links(spark, folder):
    """Fingerprint and component of every document: 3-word shingles, links at two or fewer bits."""
    found = clustered(table(spark, folder, "documents"), "doc_id", words=3, tau=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("p"), 16, "0")).alias("fingerprint"), "component_id")


# --- near-duplicate texts ---

SIMILARITY = 0.8
SHINGLE = 5
LINK_WORDS, LINK_BITS = 3, 2  # of the fingerprints, as in `op1_simhash_links`
PAIRED = 0.25  # pairs for each member of a bucket at the start, down to which rounds go on
SHRINK = 0.9  # while a round leaves no more of the pairs, another follows
STEP_ROWS, STEP = 256, 16  # rows of the first step over what the rounds leave, about; growth of a step
# Bands of minimum hashes. At a Jaccard similarity s two texts share a band with probability 1 - (1 - s**BAND_ROWS)**BANDS:
# 0.99994 at 0.8 and 0.999998 at 0.85.
BANDS = 32
BAND_ROWS = 6
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FACTORS, _SHIFTS = np.random.default_rng(SEED).integers(0, 1 << 32, (2, BANDS * BAND_ROWS), dtype=np.uint32)
_FACTORS |= np.uint32(1)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One number per band over the minima of `BAND_ROWS` hash functions each; of no shingles, none."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    high, least = (hashes >> np.uint64(32)).astype(np.uint32)[:, None], np.full(len(_FACTORS), (1 << 32) - 1, dtype=np.uint32)
    for i in range(0, len(high), 512):
        least = np.minimum(least, (high[i : i + 512] * _FACTORS + _SHIFTS).min(axis=0))
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for minima in least.reshape(BANDS, BAND_ROWS).T.astype(np.uint64):
        keys = (keys ^ (keys >> np.uint64(29)) ^ minima) * _ODD
    return keys ^ (keys >> np.uint64(32))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _bands(texts: pa.Array) -> pa.Array:
    """The band keys of the shingles of each text."""
    pieces = []
    for piece in slices(texts):
        rows = [band_keys(shingle_hashes(raw, SHINGLE)) for raw in _raw_texts(piece)]
        flat = np.concatenate([np.zeros(0, dtype=np.uint64), *rows]).view(np.int64)
        pieces.append(list_array(pa.array(flat), map(len, rows)))
    return joined(pieces, pa.list_(pa.int64()))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _shingle_sets(texts: pa.Array) -> pa.Array:
    pieces = []
    for piece in slices(texts):
        rows = [np.unique(shingle_hashes(raw, SHINGLE)) for raw in _raw_texts(piece)]
        flat = np.concatenate([np.zeros(0, dtype=np.uint64), *rows]).view(np.int64)
        pieces.append(list_array(pa.array(flat), map(len, rows)))
    return joined(pieces, pa.list_(pa.int64()))


def _word_sequence(text: str) -> Column:
    """A digest of the words of a text, in order; equal for texts that have the same shingles throughout."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.sha2(F.trim(F.regexp_replace(plain, r"[\x20\x09-\x0D]+", " ")), 256)


def _alike(pairs: DataFrame, shingled: DataFrame) -> DataFrame:
    """The (id, head) of `pairs` with similar shingles."""
    of_head = shingled.select(F.col("id").alias("head"), F.col("shingles").alias("of_head"))
    both = pairs.join(shingled, "id").join(of_head, "head")
    shared = F.size(F.array_intersect("shingles", "of_head"))
    return both.filter(shared >= SIMILARITY * (F.size("shingles") + F.size("of_head") - shared)).select("id", "head")


def _ordered(shingled: DataFrame) -> DataFrame:
    """Per id its shingles in one order, those of the fewest texts first, and 512 parities, each of the shingles of one residue."""
    each = shingled.select("id", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    often = written(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")), "near-often")
    # no longer than the text
    ordered = each.join(often, "shingle").groupBy("id", "size").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("all"))
    # after the aggregate: beside `explode` they would be computed again for each shingle
    bit = "if(shiftright(x.shingle, 6) & 7 = {k}, shiftleft(1L, cast(x.shingle & 63 as int)), 0L)"
    parity = [F.expr(f"aggregate(all, 0L, (a, x) -> a ^ {bit.format(k=k)})").alias(f"parity{k}") for k in range(8)]
    return written(ordered.select("*", *parity), "near-ordered")


def _prefix_pairs(ordered: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """(id, head) of all pairs of `ordered`, or of a row of each, that may be similar, by prefix filtering; `head` has the lower rank.

    With the shingles in one order, the rarest first, two similar texts share one of the shorter one's first 1 - 2 s / (1 + s) and
    the longer one's first 1 - s, for s = `SIMILARITY`. So what many texts have in common proposes nothing while they differ.
    Of those pairs go the ones whose shingle sets differ too much by their parities: sets differ in at least as many shingles
    as in parities.
    """
    kept = ["id", "size", *[f"parity{k}" for k in range(8)]]

    def first(rows: DataFrame, share: float) -> DataFrame:
        needed = F.ceil(F.col("size") * share - 1e-9).cast("int")
        return rows.select(*kept, F.inline(F.slice("all", 1, F.col("size") - needed + 1))).filter("n > 1")

    a, b = (F.struct(F.xxhash64(f"{c}.id").alias("at"), F.col(f"{c}.id").alias("id")) for c in "ab")
    shorter = (F.col("a.size") < F.col("b.size")) | ((F.col("a.size") == F.col("b.size")) & (a < b))
    both = F.col("a.size") + F.col("b.size")
    unlike = F.expr(" + ".join(f"bit_count(a.parity{k} ^ b.parity{k})" for k in range(8)))
    may = (F.col("a.size") >= F.col("b.size") * SIMILARITY - 1e-9) & (unlike <= both * (1 - SIMILARITY) / (1 + SIMILARITY) + 1e-9)

    def met(shorts: DataFrame, longs: DataFrame) -> DataFrame:
        short, long = first(shorts, 2 * SIMILARITY / (1 + SIMILARITY)).alias("a"), first(longs, SIMILARITY).alias("b")
        found = short.join(long, (F.col("a.shingle") == F.col("b.shingle")) & shorter & may)
        return found.select(F.greatest(a, b)["id"].alias("id"), F.least(a, b)["id"].alias("head"))

    pairs = met(ordered, ordered) if others is None else met(ordered, others).union(met(others, ordered))
    return pairs.distinct()


def _steps(rows: DataFrame) -> list[int | None]:
    """Bounds of `at`: each step ends behind `STEP` times as many rows as the one before, the first behind `STEP_ROWS` at most; None ends the last."""
    steps = max(0, math.ceil(math.log(max(1, rows.count()) / STEP_ROWS, STEP)))
    shares = [STEP**-k for k in range(steps, 0, -1)]
    found = rows.agg(F.percentile_approx("at", shares, 10_000)).first()[0] if shares else []
    return [*sorted(set(found or [])), None]


def _copies_among(keyed: DataFrame, shingled: DataFrame) -> list[DataFrame]:
    """Ids that go. Rows are proposed to each other by equal keys (`keyed`: id, key) and compared by `shingled` (id, shingles).

    All proposed pairs of rows that stay are compared. In each round, a row that comes first in all its buckets stays; the
    members of its buckets are compared to it, go or are done with it, and it leaves the buckets. Rounds go on while
    many pairs are left and shrink by them. Then the rows left in buckets are taken in steps, the lowest ranks first: all similar pairs
    of a step's rows are found; rows without a similar row before them stay, and those similar to them go, until no
    pair is left; then the rows of later steps go that are similar to one that stays. A row with many similar rows has some in
    an early step, so few are left around it when its own step comes, and the similar pairs found grow with the rows and not with
    the square of a group. Both ways keep the same rows.
    """
    rank, gone = F.struct(F.xxhash64("id").alias("at"), "id"), []
    before, few = math.inf, None
    while True:
        heads = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("first")).filter("n > 1")
        placed = written(keyed.join(written(heads, "near-heads"), "key").select("id", "key", "n", F.col("first.id").alias("head")), "near-placed")
        entries, others = placed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()
        few = PAIRED * entries if few is None else few
        if others / 2 <= few or others > SHRINK * before:
            break
        before = others
        leads = placed.groupBy("id").agg(F.bool_and(F.col("id") == F.col("head")).alias("leads")).filter("leads")
        centres = written(leads.select(F.col("id").alias("head")), "near-centres")
        asked = written(placed.filter("id != head").select("id", "head").distinct().join(centres, "head"), "near-asked")
        gone.append(written(_alike(asked, shingled).select("id").distinct(), "near-gone"))
        keyed = placed.select("id", "key").join(centres.select(F.col("head").alias("id")).union(gone[-1]), "id", "left_anti")
        keyed = written(keyed, "near-keyed")
    # as in the rounds, a pair counts if it shares a key, so when they end has no effect on what stays; a row has BANDS + 1 keys at most
    keys = written(placed.groupBy("id").agg(F.collect_list("key").alias("keys")), "near-keys")
    of_head = keys.select(F.col("id").alias("head"), F.col("keys").alias("of_head"))

    def similar(pairs: DataFrame) -> DataFrame:
        alike = _alike(written(pairs, "near-pairs"), shingled)
        shared = alike.join(keys, "id").join(of_head, "head").filter(F.arrays_overlap("keys", "of_head"))
        return shared.select("id", "head")

    left = _ordered(shingled.join(keys.select("id"), "id")).withColumn("at", F.xxhash64("id"))
    for bound in _steps(left):
        here = left if bound is None else left.filter(F.col("at") <= bound)
        edges, stay_here = written(similar(_prefix_pairs(here)), "near-edges"), here
        while edges.limit(1).count():
            stay = edges.select("head").distinct().join(edges.select(F.col("id").alias("head")), "head", "left_anti")
            gone.append(written(edges.join(stay, "head").select("id").distinct(), "near-gone"))
            stay_here = stay_here.join(gone[-1], "id", "left_anti")
            rest = edges.join(gone[-1], "id", "left_anti").join(gone[-1].select(F.col("id").alias("head")), "head", "left_anti")
            edges = written(rest.select("id", "head"), "near-edges")
        if bound is not None:
            later = left.filter(F.col("at") > bound)
            gone.append(written(similar(_prefix_pairs(stay_here, later)).select("id").distinct(), "near-gone"))
            left = written(later.join(gone[-1], "id", "left_anti"), "near-left")
    return gone


def without_near_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` less the copies: of each group of near-duplicate texts one row stays, with all its columns.

    Rows with equal word sequences are copies; those with the smallest key of them stay (rows that share a key are one
    document, and stay or go together). Texts without words are no copies of each other and all stay, as do rows with a
    null key.
    Other texts are proposed to each other if the join of `op1_simhash_links` puts their fingerprints into one component, or if they share
    one of `BANDS` bands of minimum hashes (fingerprints miss most pairs near 0.8), and compared by the Jaccard similarity
    of their five-word shingles. A text goes only for one that stays and has 0.8 or more, and no two proposed
    texts as similar as that both stay.
    """
    rows = df.filter(F.col(key).isNotNull() & (F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x09-\x0D]", " ")) != ""))
    prints = written(rows.select(F.col(key).alias("id"), _word_sequence(text).alias("words"), _bands(text).alias("bands"), fingerprint_of(LINK_WORDS)(text).alias("p")), "near-prints")
    firsts = written(prints.groupBy("words").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("p").alias("p")), "near-firsts")
    copies = prints.join(firsts.select("words", F.col("id").alias("first")), "words").filter("id > first").select("id")
    # a key that stands in several rows counts once, with one of its texts
    single = firsts.dropDuplicates(["id"])
    # the join of `op1_simhash_links`: rows of one component have its number as a key, beside those of their bands
    linked = written(components(links(firsts.select("p").distinct(), LINK_BITS)), "near-linked")
    root = F.xxhash64(F.lit("component"), F.coalesce("root", "p")).alias("key")
    of_component = single.select("id", "p").join(linked.withColumnRenamed("node", "p"), "p", "left").select("id", root)
    spread = single.select("id", F.explode("bands").alias("key")).union(of_component)
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    keyed = written(spread.join(shared, "key").select("id", "key"), "near-keyed")
    members = written(keyed.select("id").distinct(), "near-members")
    texts = rows.select(F.col(key).alias("id"), F.col(text).alias("of_id")).join(members, "id")
    shingled = written(texts.select("id", _shingle_sets("of_id").alias("shingles")).dropDuplicates(["id"]), "near-shingles")
    dropped = copies
    for ids in _copies_among(keyed, shingled):
        dropped = dropped.union(ids)
    return df.join(dropped.distinct().withColumnRenamed("id", key), key, "left_anti")

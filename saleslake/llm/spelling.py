"""Spelling variants: words one edit apart, and the much more frequent form that each stands for.

Two words are one inserted, deleted or replaced character apart exactly if they differ, and their common prefix and common suffix
together reach the longer length less one. Words are compared as rows of padded matrices of code points, block against
block: a whole diagonal of pairs at a time, the prefix from the left-aligned matrix and the suffix from the right-aligned one.

Blocks. With m the longer length, the range of a pair's prefix length, 0 to m - 1, is cut into `PARTS` parts. A pair whose prefix
length lies in part i agrees before the part's begin and behind its end, so it meets in the block of all words of length m
or m - 1 that agree there. It is counted in that block only, so no pair counts twice. A word is in 2 * PARTS blocks,
as the longer word and as the shorter one.

Large blocks. A block of more than `TILE` words is cut into tiles, and each pair of tiles is compared as a piece of work of its
own; no task ever holds more than two tiles of it. Neighbour counts and best forms are combined before they are shuffled.

Defined results: null texts have no words; a null document key counts as the empty text in the hash that picks damaged words;
repeated rows count each time. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.common import query, table
from saleslake.sources.shared import written

PARTS = 4
TILE = 512
RATIO = 10
_CELLS = 1 << 22  # of a comparison at a time
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def counted_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2) -> DataFrame:
    """(word, n) of the runs of letters of all texts, one in 31 of them damaged by the loss of one character.

    Which runs are damaged, and where, is a matter of the CRC32 of the document's key and the run.
    """
    runs = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(f"[a-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("run"))
    hashed = each.select("run", F.crc32(F.encode(F.concat("key", F.lit(":"), "run"), "utf-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _blocks(word: Column) -> Column:
    """Array of (m, part, block) of a word: the hash of what stays fixed in each part."""
    length = F.length(word)

    def block(more: int, i: int) -> Column:
        m = length + more
        first, stop = F.floor(m * i / PARTS).cast("int"), F.floor(m * (i + 1) / PARTS).cast("int")
        # the suffix behind the part, counted from the end
        behind = F.substring(word, length - (m - stop) + 1, m - stop)
        return F.struct(m.alias("m"), F.lit(i).alias("part"), F.xxhash64(m, F.lit(i), F.substring(word, F.lit(1), first), behind).alias("block"))

    return F.array(*[block(more, i) for more in (0, 1) for i in range(PARTS)])


def _near_pairs(words: list[bytes], m: np.ndarray, part: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the pairs (left, right) of words are one edit apart and belong to the part of their block."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    longer = np.maximum(lengths[left], lengths[right])
    # both of length m, or one of them a character shorter
    fits = (longer == m[left]) & (np.abs(lengths[left] - lengths[right]) < 2)
    left, right, longer = left[fits], right[fits], longer[fits]
    near = np.zeros(len(left), dtype=bool)
    width = int(lengths.max())
    plain = np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width)
    turned = np.array([w[::-1] for w in words], dtype=f"S{width}").view(np.uint8).reshape(len(words), width)
    step = max(1, _CELLS // (width + 1))
    for i in range(0, len(left), step):
        a, b, most = left[i : i + step], right[i : i + step], longer[i : i + step]
        ends = np.zeros((len(a), 1), dtype=bool)
        least = np.minimum(lengths[a], lengths[b])
        prefix = np.minimum(np.argmin(np.hstack([plain[a] == plain[b], ends]), axis=1), least)
        suffix = np.minimum(np.argmin(np.hstack([turned[a] == turned[b], ends]), axis=1), least)
        differ = (prefix < least) | (lengths[a] != lengths[b])
        own = (prefix >= most * part[a] // PARTS) & (prefix < most * (part[a] + 1) // PARTS)
        near[i : i + step] = differ & own & (prefix + suffix >= most - 1)
    out = np.zeros(len(fits), dtype=bool)
    out[fits] = near
    return out


def _diagonals(block: np.ndarray, tile: np.ndarray, crossed: np.ndarray):
    """All pairs of rows of equal blocks (ascending), one distance at a time; in a piece of two tiles only pairs across them."""
    alive = np.arange(len(block))
    for distance in range(1, len(block)):
        alive = alive[alive + distance < len(block)]
        alive = alive[block[alive] == block[alive + distance]]
        if not len(alive):
            return
        pairs = alive[~crossed[alive] | (tile[alive] != tile[alive + distance])]
        if len(pairs):
            yield pairs, pairs + distance


def _compared(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Per word with neighbours in these whole blocks: their number, and the one with most occurrences, then first."""
    words = [w.encode("latin-1") for w in batch["word"].to_pylist()]
    n, m, part = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "m", "part"))
    tile, crossed = batch["tile"].to_numpy(zero_copy_only=False), batch["crossed"].to_numpy(zero_copy_only=False)
    found = [(np.zeros(0, dtype=np.int64),) * 2]
    # rows of similar width together, so that a long word does not widen the matrices of short ones
    width = np.ceil(np.log2(np.maximum(m, 2))).astype(np.int64)
    _, block = np.unique(np.stack([batch["block"].to_numpy(zero_copy_only=False), width]), axis=1, return_inverse=True)
    for size in np.unique(width):
        rows = np.flatnonzero(width == size)
        rows = rows[np.argsort(block.ravel()[rows], kind="stable")]
        mine = [words[i] for i in rows.tolist()]
        for a, b in _diagonals(block.ravel()[rows], tile[rows], crossed[rows]):
            near = _near_pairs(mine, m[rows], part[rows], a, b)
            found.append((rows[a[near]], rows[b[near]]))
    a, b = (np.concatenate(c) for c in zip(*found, strict=True))
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    ranks = np.unique(np.array([*words, b""]), return_inverse=True)[1]
    order = np.lexsort((ranks[b], -n[b], ranks[a]))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.diff(ranks[a], prepend=-1))
    near = np.diff(np.append(first, len(a)))
    column = batch["word"]
    return pa.RecordBatch.from_arrays(
        [column.take(pa.array(a[first])), pa.array(near), column.take(pa.array(b[first])), pa.array(n[b[first]])],
        names=["word", "n_near", "best", "best_n"],
    )


def _by_block(batches):
    """`_compared` over rows sorted by block; a block that runs on into the next batch waits for it."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        rows = rows.combine_chunks()
        block = rows["block"].to_numpy()
        last = len(block) - int(np.argmax(np.append(block[::-1] != block[-1], True)))  # where the last block begins
        held = rows.slice(last)
        if last:
            yield _compared(rows.slice(0, last).combine_chunks().to_batches()[0])
    if held is not None:
        yield _compared(held.combine_chunks().to_batches()[0])


_FOUND = "word string, n_near bigint, best string, best_n bigint"


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of the words with a neighbour one edit away.

    `words`: word, n; distinct words of characters up to U+00FF. `best` is the neighbour of largest n, then the first by code points.
    """
    keyed = words.select("word", "n", F.inline(_blocks(F.col("word"))))
    of_block = Window.partitionBy("block")
    placed = keyed.withColumns({"size": F.count(F.lit(1)).over(of_block), "at": F.row_number().over(of_block.orderBy("word"))})
    placed = written(placed.filter("size > 1").withColumn("tile", F.floor((F.col("at") - 1) / TILE).cast("int")).drop("at"), "spelling-blocks")
    small = placed.filter(F.col("size") <= TILE).withColumn("crossed", F.lit(False))
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    large = placed.filter(F.col("size") > TILE).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    # a piece is the block and an ordered pair of tiles
    large = large.withColumn("crossed", F.col("tile") != F.col("other")).withColumn(
        "block", F.xxhash64("block", F.least("tile", "other"), F.greatest("tile", "other"))
    )
    columns = ["word", "n", "m", "part", "block", "tile", "crossed"]
    pieces = small.select(*columns).union(large.select(*columns))
    found = pieces.repartition("block").sortWithinPartitions("block").mapInArrow(_by_block, _FOUND)
    rank = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("r")
    whole = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), rank)
    return whole.select("word", "n_near", F.col("r.w").alias("best"), (-F.col("r.n")).alias("best_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the last word of the chain of forms from each word of `links` (word, form), which has no rings.

    Chains halve in each round, and their length is bounded, as the counts along one grow by a factor each time.
    """
    reached = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reached = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return reached


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Every word with its count, form, root and number of neighbours.

    `words`: word, n. The form is the best neighbour (see `neighbours`), if it occurs at least `ratio` times as often.
    """
    words = written(words, "spelling-words")
    near = words.join(neighbours(words), "word", "left")
    often = F.col("best_n") >= ratio * F.col("n")
    formed = written(
        near.select("word", F.when(often, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(often, F.col("best_n")).alias("form_n")),
        "spelling-forms",
    )
    last = roots(formed.filter("form is not null"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op13_spelling_variants")
def op13_spelling_variants(spark, folder):
    """All words of the documents with the forms that they are variants of."""
    return variants(counted_words(table(spark, folder, "documents")))

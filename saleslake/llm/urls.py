"""URL verdicts: host and path rules first, then a Bloom filter cascade over the corpus's complete set of hosts.

A cascade answers membership exactly for every key of a known universe. Level 0 encodes the listed keys; level 1 encodes
the keys of the universe which level 0 takes for listed although they are not; level 2 the listed keys which level 1
takes for those; and so on until a level lets no wrong key pass. A key is probed level by level; the first level that rejects it
decides. The hosts of the pages that are judged are the universe, so no verdict is a guess, and pages are judged without
a join or a shuffle of pages: only the filters travel.

Keys are dealt into shards by hash so that the filters of a shard have a bounded size (`SHARD_KEYS` listed keys); more keys
mean more shards, and each shard is one pass over the pages with its own bounded broadcast.

Defined results: a null url, or one without `://`, has empty host and path; no rule fits an empty host, and it is looked up
like any other. An empty list or universe gives `allow` everywhere. Result columns replace columns of the same name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import query, table
from saleslake.sources.shared import written

HASHES = 6
LATER_RATE = 0.5  # of wrong keys passed on by each level after the first
SHARD_KEYS = 2_000_000  # listed keys per shard; a filter of it takes about 4 MB
MAX_LEVELS = 64

# (verdict, host, path prefix)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# Hosts with a label of such a word are listed in the registered query.
LISTED_WORDS = ["spam", "pills", "casino", "farm", "cheap"]


def host_of(url: Column) -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, with A-Z in lower case."""
    host = F.regexp_extract(_rest(url), r"\A([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end; empty where the host is followed by neither."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def with_rule(df: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Add `rule` and its verdict: of the rules that fit host (or a parent domain) and path prefix, the longest."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return df.withColumns({"rule": rule, "verdict": verdict})


def _bits(key: str, level: int, bits: int) -> Column:
    """The bit positions of a key in a level; each level hashes anew."""
    first, second = F.xxhash64(F.lit(level), key), F.xxhash64(F.lit(-1 - level), key)
    return F.array(
        *[
            F.pmod(F.shiftrightunsigned(first, 2) + F.shiftrightunsigned(second, 1) % (1 << 40) * i, F.lit(bits))
            for i in range(HASHES)
        ]
    )


def _filter_bits(count: int, rate: float) -> int:
    """Bits of a filter of `count` keys with `HASHES` hashes which passes `rate` of other keys; whole 64-bit words."""
    per_key = -HASHES / math.log(1 - rate ** (1 / HASHES))
    return max(64, -(-math.ceil(count * per_key) // 64) * 64)


def _built(keys: DataFrame, key: str, level: int, bits: int) -> np.ndarray:
    """A level's filter. Words are or-ed on the executors; at most `bits / 64` rows reach the driver."""
    words = (
        keys.select(F.explode(_bits(key, level, bits)).alias("bit"))
        .groupBy(F.floor(F.col("bit") / 64).cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("ones"))
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    for batch in words.toArrow().to_batches():
        out[batch["word"].to_numpy()] = batch["ones"].to_numpy()
    return out


def _passes(key: str, sizes: list[int], broadcast) -> Column:
    """Whether a key is listed, by all levels; `sizes` are their bits."""

    @F.arrow_udf("boolean")
    def listed(positions: pa.Array) -> pa.Array:
        filters, n = broadcast.value, len(positions)
        flat = positions.flatten().to_numpy(zero_copy_only=False).reshape(n, len(filters), HASHES)
        answer, undecided = np.zeros(n, dtype=bool), np.ones(n, dtype=bool)
        for level, words in enumerate(filters):
            at = flat[:, level, :]
            held = ((words[at >> 6] >> (at & 63)) & 1).all(axis=1)
            answer[undecided & ~held] = level % 2 == 1
            undecided &= held
        answer[undecided] = len(filters) % 2 == 1
        return pa.array(answer)

    return listed(F.concat(*[_bits(key, level, bits) for level, bits in enumerate(sizes)]))


class Cascade:
    """Filters of one shard of keys, built from `listed` and `universe` (a frame of distinct keys each)."""

    def __init__(self, listed: DataFrame, universe: DataFrame, key: str):
        self.key, self.levels = key, []
        self._context = universe.sparkSession.sparkContext
        others = universe.join(listed, key, "left_anti")
        inside, outside = listed.count(), others.count()
        if not inside or not outside:
            self.everything = bool(inside)
            return
        self.everything = None
        rate = min(LATER_RATE, max(1e-4, inside * math.sqrt(LATER_RATE) / outside))
        # `held` are the keys of the level to build, `kept_out` those it must not take for its own
        held, count, kept_out = listed, inside, others
        while count:
            level = len(self.levels)
            if level == MAX_LEVELS:
                raise RuntimeError("equal hashes of different keys at every level")
            bits = _filter_bits(count, rate if level == 0 else LATER_RATE)
            self.levels.append((bits, _built(held, key, level, bits)))
            # the next level encodes what this one wrongly takes
            held, kept_out = written(kept_out.filter(self._in_level(level)), "urls-level"), held
            count = held.count()

    def _in_level(self, level: int) -> Column:
        """Membership in a single level."""
        bits, words = self.levels[level]
        shared = self._context.broadcast(words)

        @F.arrow_udf("boolean")
        def held(positions: pa.Array) -> pa.Array:
            at = positions.flatten().to_numpy(zero_copy_only=False).reshape(len(positions), HASHES)
            return pa.array(((shared.value[at >> 6] >> (at & 63)) & 1).all(axis=1))

        return held(_bits(self.key, level, bits))

    def contains(self) -> Column:
        if self.everything is not None:
            return F.lit(self.everything)
        shared = self._context.broadcast([words for _, words in self.levels])
        return _passes(self.key, [bits for bits, _ in self.levels], shared)


def listed_by_cascade(df: DataFrame, listed: DataFrame, key: str, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Add `listed`: whether the row's key is in `listed` (distinct keys). The keys of `df` are the universe.

    A null key is not listed. One pass over `df` per shard of `shard_keys` listed keys.
    """
    universe = written(df.select(key).dropna().distinct(), "urls-universe")
    listed = written(listed.select(key).dropna().distinct(), "urls-listed")
    shards = max(1, -(-listed.count() // shard_keys))
    out = None
    for shard in range(shards):
        in_shard = F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(shards)) == shard
        cascade = Cascade(listed.filter(in_shard), universe.filter(in_shard), key)
        rows = df.filter(in_shard) if shards > 1 else df
        part = rows.withColumn("listed", F.col(key).isNotNull() & cascade.contains())
        out = part if out is None else out.unionByName(part)
    return out


def judged(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict. Where no rule fits, pages of a host in `listed` (a frame of hosts) are blocked."""
    parsed = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    ruled = with_rule(listed_by_cascade(parsed, listed, "host"), rules)
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.withColumn("verdict", F.coalesce("verdict", method)).drop("listed")


def hosts_with_words(pages: DataFrame, words: list[str], url: str = "url") -> DataFrame:
    """A list of hosts: those of the pages with a label part (cut at dots and dashes) among `words`."""
    hosts = pages.select(host_of(F.col(url)).alias("host")).distinct()
    return hosts.filter(F.arrays_overlap(F.split("host", "[.-]"), F.array(*map(F.lit, words))))


def _oracle() -> str:
    rest = "case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end"
    host = f"translate(regexp_extract({rest}, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))

    def case(values):
        fits = [f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')" for _, h, p in ordered]
        return "case " + " ".join(f"when {f} then '{v}'" for f, v in zip(fits, values, strict=True)) + " end"

    words = ", ".join(f"'{w}'" for w in LISTED_WORDS)
    listed = f"list_has_any(regexp_split_to_array(host, '[.-]'), [{words}])"
    return f"""with parsed as (select page_id, coalesce({host}, '') as host, coalesce({path}, '') as path from pages)
    select page_id, host, path, {case([h + p for _, h, p in ordered])} as rule,
    coalesce({case([v for v, _, _ in ordered])}, case when {listed} then 'block' else 'allow' end) as verdict from parsed"""


@query("op6_url_cascade", _oracle())
def op6_url_cascade(spark, folder):
    """The verdict for every page; the list is drawn from the hosts of all pages by their labels."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    listed = hosts_with_words(pages, LISTED_WORDS)
    return judged(pages, listed, RULES).select("page_id", "host", "path", "rule", "verdict")

"""Hard-negative mining by cover trees over norm-augmented candidates.

Each candidate x gets one further coordinate, sqrt(M - |x|^2) with M the largest squared norm of its block, so that all have the
same norm; a query gets a 0 there. Then |q - x|^2 = |q|^2 + M - 2 q.x, and an inner product is known from a distance.

Tree. Centres are taken farthest first. Those whose distance from all earlier ones exceeds the radius of a level are the
level's nodes, so the nodes of a level are apart, cover all points and are nodes of all later levels too. A node's parent is
the nearest node of the level before, and its covering radius the largest distance to any point below it.

Search. By the triangle inequality a node's radius bounds the inner products of all that is below it. Going down the levels,
nodes whose bounds lie outside of a query's score window are skipped with all below them. The leaves that remain are visited best
first, by the upper bound that the window leaves them, until no leaf can hold a better row than the k found; every row of a
visited leaf is scored exactly, in integers.

Scale. Candidates are dealt by hash of their id into blocks of about `BLOCK` rows, queries into blocks of `QUERIES`, and each pair of blocks is one
piece of work with a tree of its own, of bounded size however many rows share a label or a vector. A piece asks its tree for
`TOGETHER` queries at a time. Only the k best per query of each piece are shuffled.

Defined results: rows with a null id, label or vector, or with a null component, take no part. Rows that share an id are one row, the
one with the smallest label and vector. Shorter vectors count as continued by zeros. Scores beyond 64 bits wrap around. Empty tables
give empty results, and columns other than the named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.common import query, table
from saleslake.sources.shared import written

BLOCK = 8192
QUERIES = 16384
TOGETHER = 1024
LEAF = 16  # rows of a leaf, on average
SHRINK = 1.3  # ratio of the radii of two levels
AT_ONCE = 8  # leaves of a query that are visited before it is asked again whether it is done


class CoverTree:
    """A cover tree over the rows of an integer matrix."""

    def __init__(self, points: np.ndarray):
        self.points = points
        x = points.astype(np.float64)
        norms = (x * x).sum(axis=1)
        self.top = float(norms.max())
        y = np.column_stack([x, np.sqrt(np.maximum(0.0, self.top - norms))])
        count = len(y)
        self.centres = [0]
        near, gap = np.zeros(count, dtype=np.int64), ((y - y[0]) ** 2).sum(axis=1)
        lengths = (y * y).sum(axis=1)
        # sizes[l] nodes on level l; parents[l] of the nodes of level l + 1
        self.sizes, self.parents = [1], []
        radius, most = np.sqrt(gap.max()), max(1, count // LEAF)
        while len(self.centres) < most and gap.max() > 0:
            radius /= SHRINK
            parent = near.copy()
            links = list(range(len(self.centres)))
            while len(self.centres) < most and gap.max() > radius * radius:
                new = int(gap.argmax())
                links.append(int(parent[new]))
                distance = np.maximum(0.0, lengths + lengths[new] - 2 * (y @ y[new]))
                distance[new] = 0.0
                closer = distance < gap
                near[closer], gap[closer] = len(self.centres), distance[closer]
                self.centres.append(new)
            if len(links) > self.sizes[-1]:
                self.sizes.append(len(links))
                self.parents.append(np.array(links))
        # covering radii, from the distances of all points to the nodes above them
        self.radii, above = [], near
        for level in range(len(self.sizes) - 1, -1, -1):
            distance = np.sqrt(((y - y[np.array(self.centres)[above]]) ** 2).sum(axis=1))
            radii = np.zeros(self.sizes[level])
            np.maximum.at(radii, above, distance)
            self.radii.insert(0, radii)
            if level:
                above = self.parents[level - 1][above]
        order = np.argsort(near, kind="stable")
        cuts = np.searchsorted(near[order], np.arange(len(self.centres) + 1))
        self.leaves = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def scores(self, queries: np.ndarray, rows) -> np.ndarray:
        """Exact inner products: in floating point where no sum can reach 2**53, else in integers."""
        points = self.points[rows]
        bound = np.abs(queries).max(initial=0) * float(np.abs(points).max(initial=0)) * points.shape[1]
        if bound < 2**52:
            return np.rint(queries.astype(np.float64) @ points.T.astype(np.float64)).astype(np.int64)
        return queries @ points.T

    def bounds(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Per query and leaf, the best score that the leaf may hold within the window; -inf where it can hold none."""
        q = queries.astype(np.float64)
        both = ((q * q).sum(axis=1) + self.top)[:, None]
        distance = np.sqrt(np.maximum(0.0, both - 2 * (q @ self.points[self.centres].T.astype(np.float64))))
        slack = 1e-9 * (both + 1)
        alive = np.ones((len(q), 1), dtype=bool)
        for level, size in enumerate(self.sizes):
            if level:
                alive = alive[:, self.parents[level - 1]]
            near = np.maximum(0.0, distance[:, :size] - self.radii[level])
            far = distance[:, :size] + self.radii[level]
            best = (both - near * near) / 2 + slack
            alive = alive & (best >= low[:, None]) & ((both - far * far) / 2 - slack <= high[:, None])
        return np.where(alive, np.minimum(best, high[:, None]), -np.inf)

    def best(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray, allowed, names: np.ndarray, k: int):
        """(query, row, score) of the `k` best allowed rows per query with low <= score <= high; ties by smaller name.

        `allowed(queries, rows)` says which pairs count, as a matrix.
        """
        bounds = self.bounds(queries, low, high)
        order = np.argsort(-bounds, axis=1, kind="stable")
        found = (np.zeros(0, dtype=np.int64),) * 3
        least = np.full(len(queries), -np.inf)  # the k-th best score so far
        for first in range(0, bounds.shape[1], AT_ONCE):
            leaves = order[:, first : first + AT_ONCE]
            reach = np.take_along_axis(bounds, leaves, axis=1)
            asked = (reach > -np.inf) & (reach >= least[:, None])
            if not asked.any():
                break  # bounds only fall from here on
            who, which = np.nonzero(asked)
            leaf = leaves[who, which]
            by_leaf = np.argsort(leaf, kind="stable")
            who, leaf = who[by_leaf], leaf[by_leaf]
            cuts = np.flatnonzero(np.diff(leaf, prepend=-1))
            new = [found]
            for a, b in zip(cuts, [*cuts[1:], len(leaf)], strict=True):
                mine, rows = who[a:b], self.leaves[leaf[a]]
                score = self.scores(queries[mine], rows)
                fits = (score >= low[mine, None]) & (score <= high[mine, None]) & (score >= least[mine, None])
                i, j = np.nonzero(fits & allowed(mine, rows))
                new.append((mine[i], rows[j], score[i, j]))
            at, row, score = (np.concatenate(c) for c in zip(*new, strict=True))
            ranked = np.lexsort((names[row], -score, at))
            at, row, score = at[ranked], row[ranked], score[ranked]
            starts = np.flatnonzero(np.diff(at, prepend=-1))
            place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
            kept = place < k
            least[at[place == k - 1]] = score[place == k - 1]
            found = at[kept], row[kept], score[kept]
        return found


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as rows of a matrix, continued by zeros."""
    lists = vectors.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _dealt(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int):
    """Both sides with `work`, the number of a pair of blocks: each query meets each row in one piece of work."""
    across, down = max(1, -(-n_rows // BLOCK)), max(1, -(-n_queries // QUERIES))
    block = F.pmod(F.xxhash64("id"), F.lit(across))
    part = F.pmod(F.xxhash64(*[c for c in queries.columns if c in ("anchor_id", "positive_id")]), F.lit(down))
    left = queries.withColumn("part", part).withColumn("work", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))).withColumn("work", F.col("part") * across + F.col("work"))
    right = rows.withColumn("block", block).withColumn("work", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))).withColumn("work", F.col("work") * across + F.col("block"))
    return left.drop("part").groupBy("work"), right.drop("block").groupBy("work")


def _searched(queries: DataFrame, rows: DataFrame, counts: tuple[int, int], same: bool, k: int) -> DataFrame:
    """The `k` best rows per query over all blocks: (anchor_id, positive_id, positive_score, id, score, rank).

    `queries`: anchor_id, label, v, positive_id, positive_score, low, high. With `same`, rows of the anchor's label but the
    anchor itself count, else those of other labels.
    """

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        names = ["anchor_id", "positive_id", "positive_score", "id", "score"]
        empty = pa.table({n: pa.array([], pa.int64()) for n in names})
        if not len(asked) or not len(held):
            return empty
        width = max(int(max(asked["v"].combine_chunks().value_lengths().to_numpy().max(), held["v"].combine_chunks().value_lengths().to_numpy().max())), 1)
        ids, labels = held["id"].to_numpy(), held["label"].to_numpy()
        anchors, of = asked["anchor_id"].to_numpy(), asked["label"].to_numpy()

        tree, points = CoverTree(_matrix(held["v"], width)), _matrix(asked["v"], width)
        low, high = (asked[c].to_numpy().astype(np.float64) for c in ("low", "high"))
        found = []
        for first in range(0, len(points), TOGETHER):
            some = slice(first, first + TOGETHER)

            def allowed(who, at, of=of[some], anchors=anchors[some]):
                alike = of[who, None] == labels[at]
                return alike & (anchors[who, None] != ids[at]) if same else ~alike

            who, row, score = tree.best(points[some], low[some], high[some], allowed, ids, k)
            found.append((who + first, row, score))
        who, row, score = (np.concatenate(c) for c in zip(*found, strict=True))
        taken = asked.select(names[:3]).take(pa.array(who))
        return taken.append_column("id", pa.array(ids[row])).append_column("score", pa.array(score))

    left, right = _dealt(queries, rows, *counts)
    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, id bigint, score bigint"
    found = left.cogroup(right).applyInArrow(search, schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def usable_rows(df: DataFrame, key: str, label: Column, vector: Column) -> DataFrame:
    """(id, label, v) of the rows that take part; `vector` holds integers."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"), vector.alias("v"))
    whole = rows.filter("id is not null and label is not null and v is not null").filter(F.forall("v", lambda x: x.isNotNull()))
    return whole.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100)
) -> DataFrame:
    """Of each anchor and each of its nearest rows of the same label, the highest rows of other labels within a score window.

    `rows`: see `usable_rows`. A negative's score lies between `share` (a ratio) of the positive's score and that score.
    """
    rows = written(rows, "negatives-rows")
    asked = written(rows.filter(is_anchor).select(F.col("id").alias("anchor_id"), "label", "v"), "negatives-anchors")
    n_rows, n_anchors = rows.count(), asked.count()
    everything = {"positive_id": F.lit(0).cast("bigint"), "positive_score": F.lit(0).cast("bigint"), "low": F.lit(float("-inf")), "high": F.lit(float("inf"))}
    alike = _searched(asked.withColumns(everything), rows, (n_anchors, n_rows), True, positives)
    alike = written(alike.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    part, whole = share
    # part * p <= whole * x <= whole * p, in integers
    least = F.ceil(F.col("positive_score").cast("decimal(20,0)") * part / whole)
    windows = asked.join(alike, "anchor_id").withColumns({"low": least.cast("double"), "high": F.col("positive_score").cast("double")})
    found = _searched(windows, rows, (n_anchors * positives, n_rows), False, negatives)
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


@query(
    "op11_hard_negatives",
    """with vectors as (
        select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
        from embeddings where label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
        select a.id as anchor_id, b.id as id, a.label = b.label as alike,
            cast(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) as bigint) as score
        from vectors a join vectors b on a.id % 100 = 0 and a.id <> b.id),
    positives as (
        select anchor_id, id as positive_id, score as positive_score from scored where alike
        qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
    select anchor_id, positive_id, cast(row_number() over best as integer) as rank, id as negative_id, positive_score,
        score as negative_score
    from positives join scored using (anchor_id)
    where not alike and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
    window best as (partition by anchor_id, positive_id order by score desc, id)
    qualify row_number() over best <= 5""",
)
def op11_hard_negatives(spark, folder):
    """Hard negatives of every hundredth vector, against all vectors."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    df = table(spark, folder, "embeddings").filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("bigint"))
    return hard_negatives(usable_rows(df, "vec_id", label, vector), F.col("id") % 100 == 0)

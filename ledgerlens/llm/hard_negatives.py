"""Mining of hard negatives: for an anchor and each of its positives, the best rows of other labels that score below it.

The search is exact and prunes by length and by coordinates. Rows are sorted by the length of their vector and cut into
blocks of bounded size, anchors into groups likewise. A block is left out where even its longest vector cannot reach what
the anchors of a group need. Within a block, buckets of similar length are taken from the longest down. A row can
reach a score only if the angle between the two vectors is small enough, which bounds each of its coordinates; for an
anchor's *focus* coordinates (those of greatest size) the rows within the bounds are a range of the bucket's sorted
list of that coordinate. The ranges are intersected, starting with the shortest, and what is left is verified with
whole inner products. What an anchor needs grows as better rows are found. Where the ranges keep most of a bucket, as
with vectors that point everywhere, its rows are all verified, for many anchors in one matrix product.

Positives are searched among the rows of an anchor's label, so blocks hold one label there, negatives among all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm.store import stored

BLOCK_BITS, GROUP_BITS = 13, 11  # at most 8,192 rows in a block, 2,048 anchors in a group
BUCKET = 2048  # rows of similar length that share their sorted lists
FOCUS = 4  # coordinates looked at per anchor
DENSE = 0.5  # share of a bucket from which on ranges are not worth intersecting
#: Scaled components beyond this count as this, so that sums of up to 500 products fit in 64 bits.
LARGEST = 1 << 27
EXACT = 1 << 53  # up to here sums of whole doubles are exact
CHUNK = 256  # anchors multiplied at a time

POSITIVES = "anchor_id long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


class Bucket:
    """Rows of similar length with a sorted list per coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        length = np.sqrt((vectors.astype(float) ** 2).sum(1))
        self.longest = length.max()
        self.unit = vectors / np.where(length == 0, 1, length)[:, None]
        self.order = np.argsort(self.unit, axis=0)
        self.sorted = np.take_along_axis(self.unit, self.order, 0)

    def candidates(self, unit: np.ndarray, length: np.ndarray, need: np.ndarray) -> list[np.ndarray | None]:
        """Per anchor the rows that may score ``need`` or more, or None where that may be most of them.

        An angle of at most a between anchor and row, and of b between the anchor and an axis, leave the row's
        angle to the axis within a of b. Bounds are widened a little, so that rounding loses nothing.
        """
        out: list[np.ndarray | None] = [None] * len(unit)
        reach = length * self.longest
        cosine = np.divide(need, reach, out=np.full(len(unit), 2.0), where=reach > 0)
        for i in np.flatnonzero((need > 0) & (cosine > 1 + 1e-9)):
            out[i] = np.zeros(0, np.int64)
        some = np.flatnonzero((need > 0) & (cosine <= 1 + 1e-9))
        if not len(some):
            return out
        alpha = np.arccos(np.clip(cosine[some], -1, 1))[:, None]
        focus = np.argsort(-np.abs(unit[some]), axis=1, kind="stable")[:, :FOCUS]
        beta = np.arccos(np.clip(np.take_along_axis(unit[some], focus, 1), -1, 1))
        low = np.cos(np.minimum(beta + alpha, np.pi)) - 1e-9
        high = np.cos(np.maximum(beta - alpha, 0)) + 1e-9
        first, last = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for axis in np.unique(focus):
            here = focus == axis
            first[here] = np.searchsorted(self.sorted[:, axis], low[here], side="left")
            last[here] = np.searchsorted(self.sorted[:, axis], high[here], side="right")
        for k, i in enumerate(some):
            best = int(np.argmin(last[k] - first[k]))
            if last[k, best] - first[k, best] > DENSE * len(self.ids):
                continue
            rows = self.order[first[k, best] : last[k, best], focus[k, best]]
            for f in range(focus.shape[1]):
                if f != best:
                    value = self.unit[rows, focus[k, f]]
                    rows = rows[(value >= low[k, f]) & (value <= high[k, f])]
            out[i] = rows
        return out


def _matrix(table: pa.Table, column: str = "vec") -> np.ndarray:
    lists = table.column(column).combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy().reshape(len(lists), -1).astype(np.int64)


def _buckets(table: pa.Table):
    """The buckets of a block, the longest vectors first."""
    vectors, ids, labels = _matrix(table), table.column("vec_id").to_numpy(), table.column("label").to_numpy()
    order = np.lexsort((ids, -(vectors.astype(float) ** 2).sum(1)))
    for at in range(0, len(order), BUCKET):
        rows = order[at : at + BUCKET]
        yield Bucket(ids[rows], labels[rows], vectors[rows])


class Best:
    """The best (score, id) pairs so far, within limits: the greatest scores first, then the least ids."""

    def __init__(self, most: int, low: int | None = None, high: int | None = None):
        self.most, self.low, self.high = most, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def need(self) -> float:
        """A score below this one is of no use."""
        low = -np.inf if self.low is None else self.low
        return max(low, self.scores[-1]) if len(self.scores) == self.most else low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        use = scores >= self.need()
        if self.high is not None:
            use &= scores <= self.high
        if not use.any():
            return
        scores, ids = np.r_[self.scores, scores[use]], np.r_[self.ids, ids[use]]
        if len(scores) > 4 * self.most:
            cut = np.partition(scores, len(scores) - self.most)[len(scores) - self.most]
            scores, ids = scores[scores >= cut], ids[scores >= cut]
        order = np.lexsort((ids, -scores))[: self.most]
        self.scores, self.ids = scores[order], ids[order]


def _searched(rows: pa.Table, vectors: np.ndarray, wanted: list[list[Best]], usable) -> None:
    """Offers each anchor's lists the rows of the block that may belong there; ``usable(anchor, bucket, rows)`` says which
    of the rows an anchor may take."""
    length = np.sqrt((vectors.astype(float) ** 2).sum(1))
    unit = vectors / np.where(length == 0, 1, length)[:, None]
    for bucket in _buckets(rows):
        largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(bucket.vectors).max(initial=0)) * vectors.shape[1]
        kind = float if largest < EXACT else np.int64
        those, mine = bucket.vectors.astype(kind), vectors.astype(kind)
        need = np.array([min(b.need() for b in lists) for lists in wanted])
        found = bucket.candidates(unit, length, need)

        def offer(i: int, at: np.ndarray, scores: np.ndarray) -> None:
            keep = (scores >= need[i]) & usable(i, bucket, at)
            for best in wanted[i]:
                best.add(scores[keep], bucket.ids[at][keep])

        for i, at in enumerate(found):
            if at is not None and len(at):
                offer(i, at, (those[at] @ mine[i]).astype(np.int64))
        dense = [i for i, at in enumerate(found) if at is None]
        everyone = np.arange(len(bucket.ids))
        for k in range(0, len(dense), CHUNK):
            part = dense[k : k + CHUNK]
            scores = (mine[part] @ those.T).astype(np.int64)
            for i, row in zip(part, scores):
                offer(i, everyone, row)


def _positives(most: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if rows.num_rows and anchors.num_rows:
            ids = anchors.column("vec_id").to_numpy()
            lists = [[Best(most)] for _ in ids]
            _searched(rows, _matrix(anchors), lists, lambda i, bucket, at: bucket.ids[at] != ids[i])
            for anchor, (best,) in zip(ids.tolist(), lists):
                out[0] += [anchor] * len(best.ids)
                out[1] += best.ids.tolist()
                out[2] += best.scores.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], names=[f.split()[0] for f in POSITIVES.split(", ")])

    return run


def _negatives(most: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if rows.num_rows and anchors.num_rows:
            ids, labels = anchors.column("vec_id").to_pylist(), anchors.column("label").to_numpy()
            windows = anchors.column("windows").to_pylist()
            lists = [[Best(most, w["low"], w["high"]) for w in own] for own in windows]
            _searched(rows, _matrix(anchors), lists, lambda i, bucket, at: bucket.labels[at] != labels[i])
            for anchor, own, bests in zip(ids, windows, lists):
                for window, best in zip(own, bests):
                    for c, v in zip(out, ([anchor], [window["positive_id"]], [window["positive_score"]])):
                        c += v * len(best.ids)
                    out[3] += best.ids.tolist()
                    out[4] += best.scores.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], names=[f.split()[0] for f in NEGATIVES.split(", ")])

    return run


def prepared(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, label, vec, length): usable rows with scaled whole components, one row per id, vectors filled up with zeros."""
    limit = F.lit(float(LARGEST))

    def whole(x: Column) -> Column:
        return F.floor(F.least(F.greatest(x.cast("double") * scale, -limit), limit)).cast("int")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))

    ids, labels, vectors = F.col(id_col).cast("long"), F.col(label_col).cast("long"), F.col(vector_col)
    usable = rows.filter(ids.isNotNull() & labels.isNotNull() & vectors.isNotNull() & F.forall(vectors, finite))
    usable = usable.select(ids.alias("vec_id"), labels.alias("label"), F.transform(vectors, whole).alias("vec"))
    least = usable.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("row"))
    single = stored(least.select("vec_id", "row.*"), "vectors")
    wide = single.agg(F.max(F.size("vec"))).first()[0] or 0
    filled = F.concat("vec", F.array_repeat(F.lit(0), F.lit(wide) - F.size("vec")))
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return single.select("vec_id", "label", filled.alias("vec"), F.sqrt(square).alias("length"))


def _sorted(rows: DataFrame, number: str, bits: int, *by: str | Column) -> DataFrame:
    """The rows in that order, cut into runs of 2**bits rows with a number each, from 0 without gaps.

    A row's place is its place in its partition and the rows of the partitions before it, so runs are full however many
    partitions there are.
    """
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(placed.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), number)
    # one row per partition
    parts = placed.groupBy("part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(F.broadcast(starts), "part").withColumn(number, F.shiftright(F.col("at") + F.col("shift"), bits)).drop("part", "at", "shift")


def _named(side: str, *columns: str) -> list[Column]:
    """The columns under names of their own, as both sides of a cogroup come from one table."""
    return [F.col(c).alias(f"{side}_{c}") for c in columns]


def mine(
    rows: DataFrame,
    anchor: Column | str,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are whole inner products of vectors whose components are ``floor(scale * x)``; higher ones come first, equal
    ones by smaller id. Anchors are the rows for which ``anchor``, a condition on ``vec_id`` and ``label``, holds. Their
    positives are the first ``positives`` other rows of the label, all if there are fewer. Per positive the first
    ``negatives`` rows of other labels come whose score is ``low`` to ``high`` percent of the positive's; none if none is.

    Rows with a null id, label or vector, or with a component that is null or not finite, take no part. An id that
    occurs more than once counts once, with its least label and vector, so copies of a row are no partners of each other.
    A shorter vector is filled up with zeros. Components beyond ``LARGEST`` after scaling count as ``LARGEST``.
    Other columns are not looked at. An empty table, or one without anchors, gives no rows.
    """
    all_rows = prepared(rows, id_col, label_col, vector_col, scale)
    of_label = _sorted(all_rows, "block", BLOCK_BITS, "label", F.desc("length"), "vec_id")
    anchors = _sorted(all_rows.filter(anchor), "team", GROUP_BITS, "label", F.desc("length"), "vec_id")
    vector = ["vec_id", "label", "vec"]

    blocks, teams = of_label.select("label", "block").distinct(), anchors.select("label", "team").distinct()
    meet = stored(blocks.join(teams, "label").select("label", "block", "team"), "meetings")
    # a block and a team meet once; both sides of a meeting are bounded
    left = of_label.join(meet, ["label", "block"]).select(*vector, *_named("row", "block", "team"))
    right = anchors.join(meet, ["label", "team"]).select(*vector, *_named("anchor", "block", "team"))
    left, right = left.groupBy("label", "row_block", "row_team"), right.groupBy("label", "anchor_block", "anchor_team")
    scored = left.cogroup(right).applyInArrow(_positives(positives), POSITIVES)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = scored.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= positives).drop("nth")

    # 100 * score between low * positive and high * positive, in whole numbers
    score = F.col("positive_score").cast("decimal(19,0)")
    at_least, at_most = F.ceil(score * low / 100).cast("long"), F.floor(score * high / 100).cast("long")
    limits = chosen.select("*", at_least.alias("low"), at_most.alias("high")).filter("low <= high")
    window = F.struct("positive_id", "positive_score", "low", "high")
    wanted = limits.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(window).alias("windows"))
    seeking = stored(anchors.join(wanted, "vec_id"), "seeking")

    of_all = _sorted(all_rows, "block", BLOCK_BITS, F.desc("length"), "vec_id")
    longest = stored(of_all.groupBy("block").agg(F.max("length").alias("longest")), "blocks")
    needs = seeking.groupBy("team").agg(F.max("length").alias("reach"), F.min(F.array_min("windows.low")).alias("least"))
    # every team lists the blocks and leaves out those that are too short for it
    last = longest.agg(F.max("block")).first()[0] or 0
    listed = needs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))))
    meet = listed.join(longest, "block").filter(F.col("reach") * F.col("longest") * 1.000001 >= F.col("least"))
    meet = stored(meet.select("block", "team"), "meetings")
    left = of_all.join(meet, "block").select(*vector, *_named("row", "block", "team"))
    right = seeking.join(meet, "team").select(*vector, "windows", *_named("anchor", "block", "team"))
    left, right = left.groupBy("row_block", "row_team"), right.groupBy("anchor_block", "anchor_team")
    scored = left.cogroup(right).applyInArrow(_negatives(negatives), NEGATIVES)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: SQL for the query over ``embeddings``: labels shifted where the id is divisible by 7, every 50th id an anchor.
ORACLE = """
WITH used AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.vec, r.vec) AS BIGINT) AS score
    FROM used a JOIN used r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3"""

"""Exact search of hard negatives by length buckets and feasible ranges of coordinates."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from daymill import workspace
from daymill.llm.common import bound_batches
from daymill.llm.ranking import placed

BUCKET, BUCKET_NUMBERS = 4096, 1 << 20  # vectors of a length bucket at most, and components of all of them
FOCUS = 5  # coordinates of a query whose feasible ranges are intersected
SAMPLE = 64  # each round looks at this many times the rows of the round before; the last one at all
FIRST_ROUND = 1 << 14  # rows of the first round at most
# Squared integer lengths from here on would not keep 100 times a score within 64 bits.
LARGEST = 1 << 56
EXACT = 1 << 53  # products below this are exact in floating point

FOUND = StructType([StructField(n, LongType()) for n in ("query", "part", "id", "score")])


def feasible(unit: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per coordinate of a unit vector, the range outside which no unit vector's coordinate lies whose cosine with it is
    `cosine` or more (0 to 1): x * y + sqrt(1 - x²) * sqrt(1 - y²) bounds the cosine, given the coordinates x and y."""
    spread = np.arccos(np.clip(cosine, -1, 1))
    angle = np.arccos(np.clip(unit, -1, 1))
    return np.cos(np.minimum(angle + spread, np.pi)), np.cos(np.maximum(angle - spread, 0))


class Bucket:
    """Vectors of similar length, their unit vectors, and for each coordinate the list of its values in order."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        squares = np.einsum("ij,ij->i", vectors.astype(np.float64), vectors.astype(np.float64))
        lengths = np.sqrt(squares)
        self.longest = float(lengths.max(initial=0))
        self.units = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(self.units, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.units, self.order, axis=0)
        self.floats = vectors.astype(np.float64) if self.longest**2 < EXACT else None

    def candidates(self, query: np.ndarray, length: float, least: float) -> np.ndarray:
        """Rows that may have a product of `least` or more with the query: none, where the longest vector is too
        short, else those whose coordinates are in the feasible ranges of the query's FOCUS largest ones."""
        if least <= 0 or not length:
            return np.arange(len(self.ids)) if least <= 0 else np.zeros(0, np.int64)
        cosine = least / (length * self.longest) if self.longest else 2.0
        if cosine > 1 + 1e-9:
            return np.zeros(0, np.int64)
        unit = query / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        low, high = feasible(unit[focus], np.full(len(focus), cosine - 1e-9))
        low, high = low - 1e-7, high + 1e-7
        starts = [np.searchsorted(self.sorted[:, f], x) for f, x in zip(focus, low)]
        ends = [np.searchsorted(self.sorted[:, f], x, side="right") for f, x in zip(focus, high)]
        narrow = int(np.argmin([e - s for s, e in zip(starts, ends)]))
        rows = self.order[starts[narrow] : ends[narrow], focus[narrow]]
        for k, f in enumerate(focus):
            if k != narrow and len(rows):
                value = self.units[rows, f]
                rows = rows[(value >= low[k]) & (value <= high[k])]
        return rows

    def products(self, rows: np.ndarray, query: np.ndarray, length: float) -> np.ndarray:
        if self.floats is not None and self.longest * length < EXACT:
            return (self.floats[rows] @ query.astype(np.float64)).astype(np.int64)
        return (self.vectors[rows] * query).sum(1)


def first_rows(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, ties by smaller id."""
    if len(scores) > n:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:n]


def _matrix(lists: pa.ListArray, first: int, last: int) -> np.ndarray:
    """Vectors of one length, rows `first` to `last` (exclusive) of a batch, as a matrix."""
    part = lists.slice(first, last - first)
    return part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(last - first, -1)


def _search(n: int, same_label: bool):
    """Rows of (bucket, kind) in order: the vectors of a bucket, then the queries that go to it, a few at a time."""
    names = FOUND.names

    def answer(bucket: Bucket, own: int, label: int, query: np.ndarray, low: list, high: list, out: list) -> None:
        length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        low, high = [-LARGEST if x is None else x for x in low], [LARGEST if x is None else x for x in high]
        rows = bucket.candidates(query, length, min(low))
        rows = rows[((bucket.labels[rows] == label) == same_label) & (bucket.ids[rows] != own)]
        scores = bucket.products(rows, query, length)
        for part, (least, most) in enumerate(zip(low, high)):
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            at = inside[first_rows(scores[inside], bucket.ids[rows[inside]], n)]
            out.append((np.full(len(at), own), np.full(len(at), part), bucket.ids[rows[at]], scores[at]))

    def run(batches):
        key, held, bucket = None, [], None
        for batch in batches:
            out = []
            keys, kinds = batch.column("bucket").to_pylist(), batch.column("kind").to_pylist()
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            marks = list(zip(keys, kinds))
            cuts = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if keys[a] != key:
                    key, held, bucket = keys[a], [], None
                vectors = _matrix(batch.column("vector"), a, b)
                if kinds[a] == 0:
                    held.append((ids[a:b], labels[a:b], vectors))
                    continue
                if bucket is None and held:
                    bucket = Bucket(*(np.concatenate(c) for c in zip(*held)))
                if bucket is not None:
                    low, high = (batch.column(c).slice(a, b - a).to_pylist() for c in ("low", "high"))
                    for i in range(b - a):
                        answer(bucket, ids[a + i], labels[a + i], vectors[i], low[i], high[i], out)
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)

    return run


class Vectors:
    """Integer vectors in length buckets, to be searched exactly for the highest products within score ranges.

    Vectors of a group (the same number of components, and the same label where a search is within labels) are ranked by
    length, and each BUCKET of them is a bucket: a bounded part of a group of any size, of similar lengths. A query goes to
    the buckets of its groups whose longest vector can reach its lowest score. There the coordinates' sorted lists
    give, for the query's largest coordinates, the rows in the feasible range; their intersection is verified exactly.
    A bucket's task holds its vectors and a few queries at a time.

    Searches run in rounds over samples of the rows that grow by SAMPLE, the last over all. What a round finds is a
    lower bound of the final scores, by which the next one prunes: so each bucket hands on few rows per query, and the
    result, which comes from the last round, is exact.
    """

    def __init__(self, vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label", scale: int = 256):
        """Components become floor(scale * component). Rows take no part that have a null id, label, vector or component, no
        component, a non-finite one, or a squared integer length of 2 ** 56 or more (whose scores may pass 64 bits). Rows of
        equal id count as one, the smallest by (label, vector). Only the named columns are read."""
        bound_batches(vectors.sparkSession)
        label = F.col(label) if isinstance(label, str) else label
        scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(x * scale))
        finite = ~F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) >= float(1 << 28) / scale))
        rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col)).filter(
            "id is not null and label is not null"
        ).filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).filter(finite)
        rows = rows.select("id", "label", F.transform(scaled, lambda x: x.cast("long")).alias("vector"))
        square = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
        rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select("id", "r.label", "r.vector")
        rows = rows.withColumns({"size": F.size("vector"), "square": square}).filter(F.col("square") < float(LARGEST))
        self.rows = workspace.materialize(rows.withColumn("chance", F.pmod(F.xxhash64("id", F.lit("round")), F.lit(1 << 40))), "vectors")
        self.n = self.rows.count()
        self.ranked: dict[bool, DataFrame] = {}

    def _buckets(self, same_label: bool) -> DataFrame:
        if same_label not in self.ranked:
            group = ["label", "size"] if same_label else ["size"]
            self.ranked[same_label] = workspace.materialize(placed(self.rows, group, [F.desc("square"), F.col("id")], "by-length"), "buckets")
        return self.ranked[same_label]

    def best(self, queries: DataFrame, n: int, same_label: bool) -> DataFrame:
        """(query, part, id, score, rank): for each query (id, label, vector, low, high: arrays of one score range per
        part, null for no bound) and part the first n other rows of the same (or another) label with a score in the range."""
        queries = workspace.materialize(queries.select("id", "label", "vector", "low", "high", F.size("vector").alias("size")), "queries")
        step = 1
        while self.n / step > FIRST_ROUND:
            step *= SAMPLE
        while True:
            found = self._round(queries, n, same_label, step)
            if step == 1:
                return found
            step //= SAMPLE
            # The n-th score found is a lower bound for those to come.
            worst = found.filter(F.col("rank") == n).select("query", "part", "score")
            worst = worst.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("part", "score"))).alias("worst"))
            raised = F.transform("low", lambda low, i: F.greatest(low, F.element_at("worst", i.cast("long"))))
            queries = workspace.materialize(
                queries.join(worst, queries["id"] == worst["query"], "left").select(
                    "id", "label", "vector", F.when(F.col("worst").isNull(), F.col("low")).otherwise(raised).alias("low"), "high", "size"
                ), "queries")

    def _round(self, queries: DataFrame, n: int, same_label: bool, step: int) -> DataFrame:
        group = ["label", "size"] if same_label else ["size"]
        per_bucket = F.greatest(F.lit(1), F.least(F.lit(BUCKET), F.floor(BUCKET_NUMBERS / F.col("size"))))
        rows = self._buckets(same_label).filter(F.col("chance") % step == 0).withColumn(
            "bucket_no", F.floor(F.col("place") / (per_bucket * step)).cast("long")
        )
        bounds = workspace.materialize(rows.groupBy(*group, "bucket_no").agg(F.max("square").alias("longest")), "bounds")
        last = bounds.groupBy(*group).agg(F.max("bucket_no").alias("last"))
        own = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
        # Without a bound, or below zero, every bucket can hold an answer.
        least = F.when(~F.exists("low", lambda x: x.isNull()), F.array_min("low"))
        reach = F.coalesce(F.col("least") <= 0, F.lit(True)) | (F.sqrt("own") * F.sqrt("longest") >= F.col("least") * (1 - 1e-9))
        sent = (
            queries.filter(F.size("low") > 0).withColumns({"own": own, "least": least}).join(last, group)
            .withColumn("bucket_no", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).join(bounds, [*group, "bucket_no"]).filter(reach)
        )
        bucket, none = F.concat_ws("/", *group, "bucket_no").alias("bucket"), F.array().cast("array<bigint>")
        both = rows.select(bucket, F.lit(0).alias("kind"), "id", "label", "vector", none.alias("low"), none.alias("high")).unionByName(
            sent.select(bucket, F.lit(1).alias("kind"), "id", "label", "vector", "low", "high")
        )
        found = both.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_search(n, same_label), FOUND)
        order = Window.partitionBy("query", "part").orderBy(F.desc("score"), "id")
        return workspace.materialize(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n), "found")


def mine(vectors: Vectors, anchors: DataFrame, *, n_positives: int = 5, n_negatives: int = 5, percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its first `n_positives` other rows of its label by score; for each, the negatives are the first
    `n_negatives` rows of other labels whose score is at most the positive's and at least `percent` of it. Ties go to
    smaller ids. `anchors` has the ids of the anchors; ids that are no vector find nothing.
    """
    chosen = vectors.rows.join(anchors.select(F.col(anchors.columns[0]).cast("long").alias("id")).distinct(), "id", "left_semi")
    unbounded = F.array(F.lit(None).cast("long"))
    positives = vectors.best(chosen.select("id", "label", "vector", unbounded.alias("low"), unbounded.alias("high")), n_positives, True)
    # The least score s with percent * p <= 100 * s: the quotient rounded up.
    least = F.expr(f"(score * {percent} + pmod(-score * {percent}, 100)) div 100").alias("least")
    ranges = positives.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "score", least))).alias("p"))
    asked = chosen.join(ranges, chosen["id"] == ranges["query"])
    negatives = vectors.best(
        asked.select("id", "label", "vector", F.col("p.least").alias("low"), F.col("p.score").alias("high")), n_negatives, False
    )
    named = positives.select(
        F.col("query").alias("anchor_id"), (F.col("rank") - 1).cast("long").alias("no"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    hit = (F.col("query") == F.col("anchor_id")) & (F.col("part") == F.col("no"))
    return negatives.join(named, hit).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


ORACLE = """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
    s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
            list_sum(list_transform(list_zip(a.e, v.e), lambda z: z[1] * z[2]))::BIGINT AS score FROM a JOIN v ON a.vec_id <> v.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
    WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, vec_id)
    QUALIFY row_number() OVER w <= 5"""

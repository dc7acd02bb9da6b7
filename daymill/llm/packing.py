"""Packing of token ids into sequences by best fit over the histogram of lengths."""

import math
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from daymill import workspace
from daymill.llm.common import bound_batches, gathered
from daymill.llm.ranking import placed
from daymill.llm.ranks import RankEncoder

CAPACITY = 2048
# A plan has a few rows per length, whatever the number of documents. One that takes more than this is not broadcast.
BROADCAST_ROWS = 200_000

PLAN = "length int, first long, slots long, sequence long, each long, offset int"


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """(rows of PLAN, number of sequences) for `counts` pieces of each length, by best fit, longest first.

    Equal pieces are placed together: sequences with the same space left are ranges of numbers, and the fullest that still
    has room takes as many copies as fit in each of its sequences, before the next one is touched, as best fit
    would piece by piece. A row says that pieces `first` .. `first` + `slots` - 1 of a length go to the sequences from
    `sequence` on, `each` to a sequence, the first of them at `offset`.
    """
    rows, ranges, spaces, opened = [], {}, [], 0

    def put(space: int, first: int, n: int) -> None:
        if n and space:
            if space not in ranges:
                ranges[space] = []
                insort(spaces, space)
            ranges[space].append((first, n))

    for length in sorted((k for k in counts if counts[k]), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit into {capacity}")
        left, rank = counts[length], 0
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = ranges[space].pop()
                if not ranges[space]:
                    del ranges[space], spaces[at]
            else:
                space, first, n = capacity, opened, math.ceil(left / (capacity // length))
                opened += n
            each = space // length
            full = min(n, left // each)
            if full:
                rows.append((length, rank, full * each, first, each, capacity - space))
                put(space - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            some = min(left, each) if full < n else 0
            if some:
                rows.append((length, rank, some, first + full, some, capacity - space))
                put(space - some * length, first + full, 1)
                rank, left = rank + some, left - some
            put(space, first + full + bool(some), n - full - bool(some))
    return rows, opened


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of n ids: whole sequences, and before them what is left over."""
    return [n % capacity] * (n % capacity > 0) + [capacity] * (n // capacity)


class Packing:
    """Whole documents as ids with an end id each, in as few sequences of `capacity` ids as best fit finds.

    Documents longer than a sequence are cut into whole sequences, the rest first; no other one is cut. Only the number of
    pieces of each length, at most `capacity` numbers, reaches the driver, which plans by count; then each
    piece takes the slot that the plan gives to its rank among the pieces of its length. Ranks come from ranges of
    (length, id), so a length that a third of all pieces share is as many tasks as it asks for.

    Null texts are empty and consist of the end id; ids may be null or repeat, each row is packed once. Of `docs` only
    the two named columns are read. An empty table gives no sequences.
    """

    def __init__(self, docs: DataFrame, tokenizer_path: str, *, end_id: int = 0, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text"):
        spark = docs.sparkSession
        bound_batches(spark)
        self.id_col, self.capacity = id_col, capacity
        schema = StructType([
            StructField("id", docs.schema[id_col].dataType), StructField("piece", IntegerType()), StructField("start", LongType()),
            StructField("length", IntegerType()), StructField("ids", BinaryType()),
        ])
        named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        pieces = named.mapInArrow(_pieces(tokenizer_path, end_id, capacity, schema.names), schema)
        pieces = pieces.withColumns({"ids_crc32": F.crc32("ids"), "at": F.monotonically_increasing_id()})
        self.pieces = workspace.materialize(pieces, "pieces")
        counts = {r.length: r.n for r in self.pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
        plan, self.n_sequences = best_fit(counts, capacity)
        self.plan = spark.createDataFrame(plan, PLAN)
        self.plan_rows = len(plan)

    def placements(self) -> DataFrame:
        """A row per piece: id, piece (from 0), start (ids of its document before it), length, ids_crc32 (of the ids as
        little-endian 32-bit numbers), sequence_id, offset (place in the sequence, gapless from 0), at (key of the piece)."""
        narrow = self.pieces.select("id", "piece", "start", "length", "ids_crc32", "at")
        ranked = placed(narrow, ["length"], ["id", "piece", "at"], "ranked-pieces")
        slots = self.plan.withColumnRenamed("length", "of_length")
        if self.plan_rows <= BROADCAST_ROWS:
            slots = F.broadcast(slots)
        own = (F.col("length") == F.col("of_length")) & (F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("slots"))
        rank = F.col("place") - F.col("first")
        return ranked.join(slots, own).select(
            F.col("id").alias(self.id_col), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
            (F.col("sequence") + F.floor(rank / F.col("each"))).cast("long").alias("sequence_id"),
            (F.col("offset") + (rank % F.col("each")) * F.col("length")).cast("long").alias("offset"), "at",
        )

    def sequences(self) -> DataFrame:
        """sequence_id, n_tokens, ids (little-endian 32-bit numbers) of each packed sequence, and its documents in order."""
        named = self.placements().select("at", F.col(self.id_col).alias("id"), "sequence_id", "offset", "length")
        whole = named.join(self.pieces.select("at", "ids"), "at")
        parts = whole.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "id", "ids"))).alias("parts"))
        joined = F.aggregate("parts.ids", F.lit(b""), lambda held, x: F.concat(held, x))
        return parts.select(
            "sequence_id", F.aggregate("parts.length", F.lit(0).cast("long"), lambda n, x: n + x).alias("n_tokens"), joined.alias("ids"),
            F.col("parts.id").alias(f"{self.id_col}s"), F.col("parts.offset").alias("offsets"),
        )


def _pieces(path: str, end_id: int, capacity: int, names: list[str]):
    def run(batches):
        encoder = RankEncoder(path)
        for held in gathered(batches, limit=2 << 20):
            rows, out = [], []
            for i, text in enumerate(held.column("text").to_pylist()):
                ids = np.append(encoder.ids(text), np.uint32(end_id)).astype("<u4").tobytes()
                start = 0
                for k, n in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((i, k, start, n))
                    out.append(ids[4 * start : 4 * (start + n)])
                    start += n
            if not rows:
                continue
            at, piece, starts, lengths = (list(c) for c in zip(*rows))
            ids = held.column("id").combine_chunks().take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(piece, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), pa.array(out, pa.binary())], names=names
            )

    return run

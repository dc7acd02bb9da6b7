"""What the operators share: the input tables, Arrow batches of bounded size, hold-out, links to components."""

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill import workspace

# White space of the word contracts: words are runs of anything else.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
SMALL_BYTES = 2 << 20  # of batches and of texts at once, where other stages share the executors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Arrow batches are bounded in rows and bytes, so that long texts do not add up in a worker, nor their buffers outside
    the heap of the executor, which keeps what it once took."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def free_name(df: DataFrame, name: str) -> str:
    """A column name like this one that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(id_col: str = "doc_id") -> Column:
    """One document in five, by the checksum of its id as text; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def gathered(batches: Iterable[pa.RecordBatch], text_col: str = "text", limit: int = 6 << 20) -> Iterator[pa.Table]:
    """Batches put together until their texts reach the limit: fewer, larger vector operations."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text_col).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool and, where the C library can, what small objects have left in its heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow, after whose last batch the worker gives its memory back. Spark keeps workers for the tasks to
    come, of other stages as well, so what one holds for nothing adds to the executor's memory all the while."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every id in a link: component_id is the smallest id it can reach.

    Alternating stars: each round links the larger neighbours of every node to its smallest one, then the
    smaller ones; the links become stars around the minima. Each round is written to the shared folder, and
    only minima by node are aggregated, combined in the tasks first, so a node with very many links is no
    hot spot. Rounds stop when a round changes nothing.
    """
    spark = links.sparkSession
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).filter("u <> v").distinct()
    edges = workspace.materialize(edges, "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = workspace.materialize(large.filter("u <> v").distinct(), "stars")
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(low, F.col("u") == F.col("k")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()
        edges = workspace.materialize(small, "links")
        new = _state(edges)
        if new == state:
            break
        state = new
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return stars.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of links and the sum of their hashes: equal before and after a round that changed nothing."""
    hashed = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), hashed).first())

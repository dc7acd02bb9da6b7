"""Near-duplicate embeddings by counting collisions of one-dimensional projections."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from daymill import workspace
from daymill.llm.common import bound_batches, components
from daymill.llm.hyperminhash import mix

COUNTED = 48  # projections whose window collisions are counted
WINDOW = 2.5  # half width of a window around a query, in standard deviations of a pair at the bound
CELL = 8.0  # width of a cell, in the same unit
MISS = 1e-4  # chance that a pair at the bound meets in no table, and that it falls short of the count
BLOCK = 256  # vectors of a cell that are compared as one block
PAIRS = 1 << 22  # pairs of the blocks that a task works on at once


def directions(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def same_cell(spread: float) -> float:
    """Chance that a normal difference of this standard deviation, in units of the cell's width, stays in a cell."""
    x = np.linspace(-1, 1, 4001)
    density = np.exp(-0.5 * (x / spread) ** 2) / (spread * math.sqrt(2 * math.pi))
    return float(((1 - np.abs(x)) * density).sum() * (x[1] - x[0]))


def least_count(n: int, p: float, miss: float) -> int:
    """The largest count that a sum of n chances p falls short of with a probability of at most `miss`."""
    total = 0.0
    for k in range(n + 1):
        total += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if total > miss:
            return k
    return n


class Plan:
    """Sizes of the search, from the cosine bound and the number of vectors.

    For unit vectors at the bound, a projection on a normal direction differs by a normal number whose deviation is their
    distance; for unrelated ones it is sqrt(2). A table has so many projections in its cells that an unrelated vector meets
    about one other; it grows with the logarithm of n. There are so many tables that a pair at the bound meets in one.
    """

    def __init__(self, cosine: float, n: int, seed: int = 0):
        self.cosine, self.seed = cosine, seed
        distance = math.sqrt(2 - 2 * cosine)
        self.cell, self.window = CELL * distance, WINDOW * distance
        near, far = same_cell(1 / CELL), same_cell(min(3.0, math.sqrt(2) / self.cell))
        self.per_table = max(2, math.ceil(math.log(max(n, 2)) / -math.log(far)))
        self.tables = math.ceil(math.log(MISS) / math.log1p(-(near**self.per_table)))
        self.least = least_count(COUNTED, math.erf(WINDOW / math.sqrt(2)), MISS)

    def cells(self, units: np.ndarray) -> np.ndarray:
        """Key of the cell of each vector in each table."""
        dim = units.shape[1]
        place = units @ directions(dim, self.tables * self.per_table, self.seed)
        shift = np.random.default_rng([self.seed, dim, 1]).uniform(0, self.cell, place.shape[1])
        cell = np.floor((place + shift) / self.cell).astype(np.int64).astype(np.uint64).reshape(len(units), self.tables, -1)
        factors = mix(np.arange(1, self.per_table + 1, dtype=np.uint64)) | np.uint64(1)
        total = (mix(cell + np.uint64(5)) * factors).sum(2, dtype=np.uint64)
        return mix(total + np.arange(1, self.tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dim))

    def counted(self, units: np.ndarray) -> np.ndarray:
        return units @ directions(units.shape[1], COUNTED, self.seed + 1)


def unit_vectors(cells: list) -> tuple[np.ndarray, np.ndarray]:
    """(units of vectors of one length, which rows they are): without null, zero or non-finite ones."""
    some = np.array([v is not None and len(v) > 0 and None not in v for v in cells], bool)
    at = np.flatnonzero(some)
    values = np.array([cells[i] for i in at], np.float64)
    if not len(at):
        return np.zeros((0, 1)), at
    with np.errstate(over="ignore", invalid="ignore"):
        largest = np.abs(values).max(1)
        good = np.isfinite(values).all(1) & (largest > 0)
        values, at = values[good] / largest[good, None], at[good]
    return values / np.sqrt((values * values).sum(1, keepdims=True)), at


def _by_length(cells: list):
    lengths = np.array([-1 if v is None else len(v) for v in cells])
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        units, at = unit_vectors([cells[i] for i in rows])
        if len(at):
            yield units, rows[at]


def window_counts(projections: np.ndarray, group: np.ndarray, sizes: np.ndarray, window: float) -> np.ndarray:
    """Collisions of each ordered pair (query, other) of each group, all pairs of a group after those of the one before.

    For each projection the vectors are sorted within their groups; those in the window around a query collide with it.
    """
    first = np.cumsum(sizes) - sizes
    base = np.cumsum(sizes**2) - sizes**2
    counts = np.zeros(int((sizes**2).sum()), np.uint8)
    own = np.arange(len(group)) - first[group]
    apart = 4 * (np.abs(projections).max() + window) if len(group) else 1.0
    for k in range(projections.shape[1]):
        key = projections[:, k] + apart * group
        order = np.argsort(key)
        ordered = key[order]
        low, high = np.searchsorted(ordered, key - window), np.searchsorted(ordered, key + window, side="right")
        n = high - low
        ends = np.cumsum(n)
        other = order[np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - n), n)]
        query = np.repeat(np.arange(len(group)), n)
        counts[base[group[query]] + own[query] * sizes[group[query]] + own[other]] += 1
    return counts


def _keys(plan: Plan):
    names = ["id", "key"]

    def run(batches):
        for batch in batches:
            ids, labels = batch.column("id").to_numpy(), batch.column("label_key").to_numpy().astype(np.uint64)
            for units, at in _by_length(batch.column("vector").to_pylist()):
                keys = mix(plan.cells(units) ^ mix(labels[at])[:, None]).view(np.int64)
                for k in range(0, len(at), 500):
                    part = keys[k : k + 500]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[at[k : k + 500]], part.shape[1])), pa.array(part.ravel())], names=names)

    return run


def _compare(plan: Plan):
    """Rows of (key, i, j) groups, sorted: per vector of a group its links there and the smallest one of its local component."""
    names = ["id", "n_links", "low"]

    def work(table: pa.Table):
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        keys, labels = table.column("key").to_numpy(), table.column("label_key").to_numpy().astype(np.uint64)
        i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
        lists = table.column("vector").combine_chunks()
        # A cell's vectors have one length, but equal keys of cells may meet by chance; lengths keep them apart.
        for units, at in _by_length(lists.to_pylist()):
            fresh = np.ones(len(at), bool)
            fresh[1:] = (keys[at][1:] != keys[at][:-1]) | (i[at][1:] != i[at][:-1]) | (j[at][1:] != j[at][:-1])
            group = np.cumsum(fresh) - 1
            sizes = np.bincount(group)
            counts = window_counts(plan.counted(units), group, sizes, plan.window)
            passed = np.flatnonzero(counts >= plan.least)
            base = np.cumsum(sizes**2) - sizes**2
            g = np.searchsorted(base, passed, side="right") - 1
            first = np.cumsum(sizes) - sizes
            a, b = np.divmod(passed - base[g], sizes[g])
            a, b = first[g] + a, first[g] + b
            x, y = at[a], at[b]
            # Each pair once: within one block, or across the two blocks of the group.
            once = (ids[x] < ids[y]) & (labels[x] == labels[y]) & ((i[x] == j[x]) | (block[x] != block[y]))
            a, b, x, y = a[once], b[once], x[once], y[once]
            cells = mix(plan.cells(units) ^ mix(labels[at])[:, None]).view(np.int64)
            linked = np.zeros(len(a), bool)
            for k in range(0, len(a), 1 << 15):
                p, q = a[k : k + (1 << 15)], b[k : k + (1 << 15)]
                # A pair that meets in several tables belongs to the first.
                here = cells[p, (cells[p] == cells[q]).argmax(1)] == keys[at[p]]
                linked[k : k + len(p)] = here & ((units[p] * units[q]).sum(1) >= plan.cosine)
            x, y = x[linked], y[linked]
            if not len(x):
                continue
            n = np.bincount(np.concatenate([x, y]), minlength=len(ids))
            low = ids.copy()
            while True:
                before = low.copy()
                least = np.minimum(low[x], low[y])
                np.minimum.at(low, x, least)
                np.minimum.at(low, y, least)
                if (low == before).all():
                    break
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(n[some]), pa.array(low[some])], names=names)

    def run(batches):
        held, pairs = [], 0
        for batch in batches:
            held.append(batch)
            pairs += batch.num_rows * 2 * BLOCK
            if pairs >= PAIRS:
                table = pa.Table.from_batches(held)
                # The last group may go on in the next batch.
                last = [table.column(c)[-1].as_py() for c in ("key", "i", "j")]
                same = np.ones(table.num_rows, bool)
                for c, v in zip(("key", "i", "j"), last):
                    same &= table.column(c).to_numpy() == v
                cut = int(np.argmax(same))
                if cut:
                    yield from work(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                pairs = sum(x.num_rows for x in held) * 2 * BLOCK
        if held:
            yield from work(pa.Table.from_batches(held))

    return run


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    cosine: float = 0.98, seed: int = 0) -> DataFrame:
    """id, n_links (other vectors of the same label at cosine >= `cosine`), component_id (smallest id reachable), kept.

    Labels and cells of several tables part the vectors; a cell's key joins the cells of a few projections. Within a cell
    every further projection is sorted, the vectors in the window around each query are counted per pair, and pairs
    with a count that the wanted recall allows are verified in double precision. A pair that meets in several tables counts
    in the first only. Large cells are split into blocks by a hash of the ids and compared block against block, so a group
    of copies is as many tasks as its size asks for; tasks give sums and local components, a row per vector, never pairs.

    Null labels, and vectors that are null, empty, zero or hold null or non-finite numbers link with nothing, nor do vectors of
    different lengths. Rows of equal id count as one vector, the smallest by (label, vector); null ids link with nothing.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(label_col).alias("label_key"), F.col(vector_col).alias("vector")
    )
    rows = rows.groupBy("id").agg(F.min(F.struct("label_key", "vector")).alias("r")).select("id", "r.label_key", "r.vector")
    rows = workspace.materialize(rows, "vectors")
    plan = Plan(cosine, rows.count(), seed)
    keys = workspace.materialize(rows.mapInArrow(_keys(plan), "id long, key long"), "cell-keys")
    cells = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = keys.join(cells, "key").withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks").cast("long")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = members.select("key", "id", "block", other.alias("other")).select(
        "key", "id", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    dealt = paired.join(rows, "id").select("key", "i", "j", "block", "id", "label_key", "vector")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    schema = StructType([StructField(n, LongType()) for n in ("id", "n_links", "low")])
    found = workspace.materialize(dealt.mapInArrow(_compare(plan), schema), "links-by-block")
    counts = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    linked = counts.join(groups, "id", "left")
    out = vectors.select(F.col(id_col).alias("own")).join(linked, F.col("own") == F.col("id"), "left")
    component = F.coalesce("component_id", "own")
    return out.select(
        F.col("own").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"),
        component.eqNullSafe(F.col("own")).alias("kept"),
    )

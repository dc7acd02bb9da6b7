"""Near-duplicates on word shingles by HyperMinHash sketches, and exact confirmation."""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, ShortType, StructField, StructType

from daymill import workspace
from daymill.llm.common import SMALL_BYTES, bound_batches, components, gathered, lean

SHINGLE_WORDS = 5
# A sketch has BUCKETS registers, each of 6 bits of leading zeros and MANTISSA bits after the leading one. ROWS registers
# make a band. Two sets of similarity 0.75 share a band with probability 1 - (1 - 0.75**5) ** 40, all but 2 in 100,000.
SKETCHES, BUCKETS, ROWS, MANTISSA = 5, 40, 5, 10
BANDS = SKETCHES * BUCKETS // ROWS
EMPTY = -1
# Chance that registers of different minima agree: equal zeros in a third of cases, then equal mantissas.
COLLIDE = 1 / 3 / (1 << MANTISSA)
SIGMAS = 5.0  # standard deviations of an estimate by which it may miss before a pair is left out
BLOCK = 256  # members of a bucket that are compared as one block
CHUNK = 1 << 18  # pairs of blocks that a task works on at once


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the distinct shingles, ascending within each text, one text after the other; their number per text).

    A-Z become small, words are runs without white space, a shingle is SHINGLE_WORDS words, or all of a shorter text.
    Hashes have 64 bits: two different shingles of a pair of texts agree with a probability below 1e-10.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    coded = words.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    codes = coded.indices.to_numpy()
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    word, doc = hashes[codes][real] if len(codes) else np.zeros(0, np.uint64), doc[real]
    counts = np.bincount(doc, minlength=len(lists))
    first = np.cumsum(counts) - counts
    # The k-th word of a shingle counts with its own factor; a short text's shingle holds its length as well.
    factors = mix(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)
    total, place = np.zeros(len(word), np.uint64), np.arange(len(word)) - first[doc]
    for k in range(SHINGLE_WORDS):
        shifted = np.concatenate([word[k:], np.zeros(min(k, len(word)), np.uint64)])
        total += np.where(place + k < counts[doc], shifted, 0).astype(np.uint64) * factors[k]
    short = counts[doc] < SHINGLE_WORDS
    starts = np.where(short, place == 0, place <= counts[doc] - SHINGLE_WORDS)
    shingle, doc = mix(total + np.where(short, counts[doc], 0).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[starts], doc[starts]
    order = np.lexsort((shingle, doc))
    shingle, doc = shingle[order], doc[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])
    return shingle[fresh], np.bincount(doc[fresh], minlength=len(lists))


def registers(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Compressed registers of all sketches, a row per text; EMPTY where no shingle fell."""
    doc = np.repeat(np.arange(len(counts)), counts)
    out = np.full((len(counts), SKETCHES * BUCKETS), EMPTY, np.int16)
    for k in range(SKETCHES):
        scattered = mix(shingles ^ mix(np.array([k + 1], np.uint64))[0])
        bucket = ((scattered >> np.uint64(32)) * np.uint64(BUCKETS)) >> np.uint64(32)
        least = np.full(len(counts) * BUCKETS, np.iinfo(np.uint32).max, np.uint32)
        np.minimum.at(least, doc * BUCKETS + bucket.astype(np.int64), scattered.astype(np.uint32))
        # Number of zeros before the leading one, and the bits behind it.
        power = np.frexp(least.astype(np.float64))[1]
        behind = (least.astype(np.uint64) << (33 - power).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
        packed = ((32 - power) << MANTISSA) | (behind >> np.uint64(32 - MANTISSA)).astype(np.int64)
        used = np.bincount(doc * BUCKETS + bucket.astype(np.int64), minlength=len(least)) > 0
        out[:, k * BUCKETS : (k + 1) * BUCKETS] = np.where(used, packed, EMPTY).reshape(len(counts), BUCKETS)
    return out


def band_keys(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key of each band of each text, whether it has a register that is not empty)."""
    cells = regs.reshape(len(regs), BANDS, ROWS)
    factors = mix(np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(77)) | np.uint64(1)
    total = (mix(cells.astype(np.int64).astype(np.uint64) + np.uint64(2)) * factors).sum(2, dtype=np.uint64)
    return mix(total + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64), (cells != EMPTY).any(2)


def estimate(equal: Column, used: Column) -> Column:
    """Similarity from the number of equal registers among the used ones, less what collisions add."""
    return (equal - COLLIDE * used) / (used * (1 - COLLIDE))


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, digest of the set, band keys, registers) per row."""
    schema = StructType(
        [StructField("id", docs.schema[id_col].dataType), StructField("n_shingles", LongType()), StructField("digest", BinaryType()),
         StructField("bands", ArrayType(LongType())), StructField("regs", ArrayType(ShortType()))]
    )

    def run(batches):
        for held in gathered(batches, text_col, SMALL_BYTES):
            shingles, counts = shingle_sets(held.column(text_col))
            regs = registers(shingles, counts)
            keys, some = band_keys(regs)
            ends = np.cumsum(counts)
            data = shingles.tobytes()
            digests = [hashlib.blake2b(data[8 * (e - n) : 8 * e], digest_size=16).digest() for e, n in zip(ends.tolist(), counts.tolist())]
            at = np.concatenate([[0], np.cumsum(some.sum(1))]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(at), pa.array(keys[some]))
            cells = pa.ListArray.from_arrays(pa.array((np.arange(len(counts) + 1) * regs.shape[1]).astype(np.int32)), pa.array(regs.ravel()))
            ids = held.column(id_col).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts), pa.array(digests, pa.binary()), bands, cells], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(lean(run), schema)


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, shingles) of the documents in `ids`, whole sets."""
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("shingles", ArrayType(LongType()))])

    def run(batches):
        for held in gathered(batches, "text", SMALL_BYTES):
            shingles, counts = shingle_sets(held.column("text"))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(shingles.view(np.int64)))
            yield pa.RecordBatch.from_arrays([held.column("id").combine_chunks(), lists], names=schema.names)

    wanted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi")
    return wanted.mapInArrow(lean(run), schema)


def likely(percent: int) -> Column:
    """Whether registers x and y of sets of sizes m and n leave room for the similarity: sizes first, then the
    collision-corrected estimate with SIGMAS standard deviations to spare."""
    bound = percent / 100
    equal = F.size(F.filter(F.zip_with("x", "y", lambda x, y: (x == y) & (x != EMPTY)), lambda e: e))
    used = F.size(F.filter(F.zip_with("x", "y", lambda x, y: (x != EMPTY) | (y != EMPTY)), lambda e: e))
    sizes = 100 * F.least("m", "n") >= percent * F.greatest("m", "n")
    return sizes & (estimate(equal, used) >= bound - SIGMAS * F.sqrt(F.lit(bound * (1 - bound)) / used))


def whole_groups(batches, keys: list[str], limit: int = 4 << 20):
    """Tables of whole groups of sorted rows, put together until they reach `limit` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < limit:
            continue
        table = pa.Table.from_batches(held)
        same = np.ones(table.num_rows, bool)
        for name in keys:
            column = table.column(name).to_numpy()
            same &= column == column[-1]
        cut = int(np.argmax(same))  # the last group may go on in the next batch
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
        size = sum(x.nbytes for x in held)
    if held:
        yield pa.Table.from_batches(held)


class OpenGroups:
    """Rows of whole (key, outer, inner) groups: of a bucket that holds several groups of documents, a block of the members
    outside its main group (side 0) and a block of all its members (side 1)."""

    KEYS = ["key", "outer", "inner"]

    def __init__(self, table: pa.Table, percent: int):
        column = lambda name: table.column(name).to_numpy()
        marks = np.stack([column(c) for c in self.KEYS])
        fresh = np.ones(table.num_rows, bool)
        fresh[1:] = (marks[:, 1:] != marks[:, :-1]).any(0)
        self.group, self.percent = np.cumsum(fresh) - 1, percent
        self.key, self.side, self.id, self.part, self.main, self.n = (column(c) for c in ("key", "side", "id", "part", "main", "n"))
        self.regs = table.column("regs").combine_chunks().flatten().to_numpy().reshape(table.num_rows, SKETCHES * BUCKETS)
        count = lambda side: np.bincount(self.group[self.side == side], minlength=int(fresh.sum()))
        self.outer, self.inner, self.first = count(0), count(1), np.flatnonzero(fresh)

    def likely(self):
        """Chunks of pairs (rows x, rows y) of one group that may be similar enough, from different groups of documents:
        by size, then by the collision-corrected estimate with SIGMAS standard deviations to spare. A pair that
        shares several bands is looked at in the bucket of the first."""
        pairs, bands = self.outer * self.inner, np.empty((len(self.regs), BANDS), np.int64)
        for i in range(0, len(bands), 2048):  # a register takes many times its size while keys are made
            bands[i : i + 2048] = band_keys(self.regs[i : i + 2048])[0]
        ends, bound = np.cumsum(pairs), self.percent / 100
        for low in range(0, int(ends[-1]) if len(ends) else 0, CHUNK):
            k = np.arange(low, min(low + CHUNK, int(ends[-1])))
            g = np.searchsorted(ends, k, side="right")
            a, b = np.divmod(k - (ends - pairs)[g], self.inner[g])
            x, y = self.first[g] + a, self.first[g] + self.outer[g] + b
            once = (self.part[y] == self.main[y]) | (self.id[x] < self.id[y])
            sizes = 100 * np.minimum(self.n[x], self.n[y]) >= self.percent * np.maximum(self.n[x], self.n[y])
            right = (self.part[x] != self.part[y]) & once & sizes
            x, y = x[right], y[right]
            for i in range(0, len(x), CHUNK // 32):
                p, q = x[i : i + CHUNK // 32], y[i : i + CHUNK // 32]
                r, s = self.regs[p], self.regs[q]
                same, some = r == s, r != EMPTY
                shared = same.reshape(len(p), BANDS, ROWS).all(2) & some.reshape(len(p), BANDS, ROWS).any(2)
                used = np.maximum((some | (s != EMPTY)).sum(1), 1)
                near = ((same & some).sum(1) - COLLIDE * used) / (used * (1 - COLLIDE))
                here = bands[p, shared.argmax(1)] == self.key[p]
                kept = here & (near >= bound - SIGMAS * np.sqrt(bound * (1 - bound) / used))
                yield p[kept], q[kept]

    def similar(self, x: np.ndarray, y: np.ndarray, shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the whole sets of rows x and y, of one group, are similar enough. Many pairs of few rows are counted by
        a product of the rows' incidence with the shingles that several of them hold, a block of shingles at a time."""
        of = lambda i: shingles[ends[i] - self.n[i] : ends[i]]
        rows, at = np.unique(np.concatenate([x, y]), return_inverse=True)
        common = np.zeros(len(x), np.int64)
        if len(x) < 4 * len(rows):
            for i, (p, q) in enumerate(zip(x, y)):
                small, large = (of(p), of(q)) if self.n[p] <= self.n[q] else (of(q), of(p))
                place = np.searchsorted(large, small)
                common[i] = (large[np.minimum(place, len(large) - 1)] == small).sum()
        else:
            own = np.repeat(np.arange(len(rows)), self.n[rows])
            held, code, times = np.unique(np.concatenate([of(i) for i in rows]), return_inverse=True, return_counts=True)
            column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[code]
            own, column = own[column >= 0], column[column >= 0]
            order = np.argsort(column, kind="stable")
            own, column = own[order], column[order]
            total = np.zeros((len(rows), len(rows)), np.float32)
            for low in range(0, int((times > 1).sum()), 2048):
                a, b = np.searchsorted(column, [low, low + 2048])
                incidence = np.zeros((len(rows), 2048), np.float32)
                incidence[own[a:b], column[a:b] - low] = 1
                total += incidence @ incidence.T
            common = total[at[: len(x)], at[len(x) :]].astype(np.int64)
        return 100 * common >= self.percent * (self.n[x] + self.n[y] - common)

    def meet(self, low: np.ndarray, at: slice, x: np.ndarray, y: np.ndarray) -> None:
        """Give rows x and y, and with them all rows of their parts in the group `at`, the smallest of their `low`."""
        parts, code = np.unique(self.part[at], return_inverse=True)
        while len(x) and (low[x] != low[y]).any():
            least = np.minimum(low[x], low[y])
            np.minimum.at(low, x, least)
            np.minimum.at(low, y, least)
            smallest = parts.copy()
            np.minimum.at(smallest, code, low[at])
            low[at] = smallest[code]


def _candidates(percent: int):
    """Members of groups that have a likely partner there."""
    def run(batches):
        for table in whole_groups(batches, OpenGroups.KEYS):
            rows, some = OpenGroups(table, percent), np.zeros(table.num_rows, bool)
            for x, y in rows.likely():
                some[x] = some[y] = True
            yield from table.select([*OpenGroups.KEYS, "side", "id"]).filter(pa.array(some)).combine_chunks().to_batches()

    return run


def _linked_parts(percent: int):
    """(a, b): a group of documents and the smallest one that it is linked with in a task, at most a row per group."""
    def run(batches):
        for table in whole_groups(batches, OpenGroups.KEYS):
            rows, lists = OpenGroups(table, percent), table.column("shingles").combine_chunks()
            rows.n = np.diff(lists.offsets.to_numpy())
            # Sets are ascending as unsigned numbers.
            shingles, ends = lists.flatten().to_numpy().view(np.uint64), np.cumsum(rows.n)
            low = rows.part.copy()
            for x, y in rows.likely():
                cuts = np.flatnonzero(np.diff(rows.group[x], prepend=-1, append=-1))
                for a, b in zip(cuts, cuts[1:]):
                    # What has met already needs no comparison.
                    open_ = np.flatnonzero(low[x[a:b]] != low[y[a:b]]) + a
                    if len(open_):
                        linked = open_[rows.similar(x[open_], y[open_], shingles, ends)]
                        g = rows.group[x[a]]
                        rows.meet(low, slice(rows.first[g], rows.first[g] + rows.outer[g] + rows.inner[g]), x[linked], y[linked])
            moved = np.flatnonzero(low != rows.part)
            links = np.unique(np.stack([rows.part[moved], low[moved]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], names=["a", "b"])

    return run


class NearDuplicates:
    """Documents linked by a Jaccard similarity of their shingle sets of `percent` / 100 or more, and their groups.

    Equal sets are one first, by digest. Bands of compressed registers give buckets; in each, every member is compared with
    the smallest one (collision-corrected estimate of the registers, then the whole sets), and the links give groups. Where
    a bucket still holds several groups, each member outside its smallest one's group is compared with all members of other
    groups, block by block within tasks. So every pair that shares a band is either in one group already or compared, without all
    pairs of a group of copies, and no row is made for a pair but for those with a bucket's smallest member.
    Counts and minima by bucket are combined in the tasks; joins by bucket are between large tables that the adaptive planner
    splits when skewed. Candidates grow with the corpus, so no side of their joins is broadcast: hints ask for a shuffle.

    Null and empty texts have no shingles and link with nothing. Rows of equal id are one document; a null id links with nothing.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75):
        bound_batches(docs.sparkSession, SMALL_BYTES)
        self.id_col, self.percent = id_col, percent
        self.sketches = workspace.materialize(sketch(docs, id_col, text_col), "sketches")
        usable = self.sketches.filter("n_shingles > 0 and id is not null")
        self.same = workspace.materialize(usable.groupBy("digest").agg(F.min("id").alias("rep")), "equal-sets")
        reps = self.same.select(F.col("rep").alias("id"), F.col("digest")).hint("shuffle_hash")
        rows = usable.join(reps, ["id", "digest"], "left_semi").select(F.explode("bands").alias("key"), "id")
        buckets = rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low <> high").drop("high")
        members = workspace.materialize(rows.join(buckets.hint("shuffle_hash"), "key"), "bucket-members")
        ids = members.select("id").distinct().hint("shuffle_hash")
        held = usable.join(ids, "id", "left_semi").groupBy("id").agg(F.min(F.struct("digest", "n_shingles", "regs")).alias("r"))
        self.regs = workspace.materialize(held.select("id", F.col("r.n_shingles").alias("n"), "r.regs"), "candidates")
        self.sets = workspace.materialize(_sets(docs, ids, id_col, text_col), "shingle-sets")
        stars = members.filter("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
        stars = workspace.materialize(self._estimated(stars), "star-pairs")
        groups = workspace.materialize(components(self.confirmed(stars)), "groups")
        merged = components(self._across(members, groups))
        merged = merged.select(F.col("id").alias("part"), F.col("component_id").alias("whole"))
        own = groups.join(merged, groups["component_id"] == merged["part"], "left").select(
            "id", F.coalesce("whole", "component_id").alias("component_id")
        )
        self.groups = workspace.materialize(own.union(merged).groupBy("id").agg(F.min("component_id").alias("component_id")), "merged-groups")

    def _with(self, rows: DataFrame, key: str, size: str, name: str) -> DataFrame:
        """Rows with size and registers of the document in column `key`."""
        named = self.regs.select(F.col("id").alias(key), F.col("n").alias(size), F.col("regs").alias(name))
        return rows.join(named.hint("merge"), key)

    def _estimated(self, pairs: DataFrame) -> DataFrame:
        return self._with(self._with(pairs, "a", "m", "x"), "b", "n", "y").filter(likely(self.percent)).select("a", "b")

    def _across(self, members: DataFrame, groups: DataFrame) -> DataFrame:
        """Links (a, b) between groups of documents that share a bucket; documents in no group are one of their own.

        In a bucket, members outside the group of its smallest one are compared with all members. Both are dealt out in blocks
        of about BLOCK, each block of the ones against each of the others as one task's group, so rows grow with
        the members, not with their pairs. A first pass compares registers only; the whole sets of those that have a
        likely partner go to the second, which confirms pairs and hands on which groups met.
        """
        lows = groups.select(F.col("id").alias("low"), F.col("component_id").alias("low_part"))
        named = members.join(groups, "id", "left").join(lows, "low", "left").select(
            "key", "id", F.coalesce("component_id", "id").alias("part"), F.coalesce("low_part", "low").alias("main")
        )
        named = workspace.materialize(named, "members-by-group")
        outside = F.col("part") != F.col("main")
        blocks = named.groupBy("key").agg(F.count_if(outside).alias("m"), F.count(F.lit(1)).alias("n")).filter("m > 0").select(
            "key", *[F.ceil(F.col(c) / BLOCK).cast("int").alias(name) for c, name in (("m", "outers"), ("n", "inners"))]
        )
        open_ = named.join(blocks.hint("shuffle_hash"), "key")
        block = lambda count: F.pmod(F.xxhash64("id", F.lit("block")), F.col(count).cast("long")).cast("int")
        each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
        one = open_.filter(outside).select("key", "id", "part", "main", F.lit(0).alias("side"), block("outers").alias("outer"), each("inners").alias("inner"))
        two = open_.select("key", "id", "part", "main", F.lit(1).alias("side"), each("outers").alias("outer"), block("inners").alias("inner"))
        rows = workspace.materialize(one.unionByName(two.select(one.columns)).join(self.regs.hint("merge"), "id"), "open-members")
        dealt = lambda frame: frame.repartition(*OpenGroups.KEYS).sortWithinPartitions(*OpenGroups.KEYS, "side", "id")
        some = StructType([rows.schema[c] for c in (*OpenGroups.KEYS, "side", "id")])
        some = workspace.materialize(dealt(rows).mapInArrow(lean(_candidates(self.percent)), some), "likely-members")
        whole = rows.join(some, [*OpenGroups.KEYS, "side", "id"], "left_semi").join(self.sets.hint("merge"), "id")
        links = StructType([StructField("a", LongType()), StructField("b", LongType())])
        return workspace.materialize(dealt(whole).mapInArrow(lean(_linked_parts(self.percent)), links), "linked-groups")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole sets are similar enough."""
        sets = self.sets.select("id", "shingles")
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("s")).hint("merge"), "a").join(
            sets.select(F.col("id").alias("b"), F.col("shingles").alias("t")).hint("merge"), "b"
        ).select("a", "b", (F.size("s") + F.size("t")).alias("both"), F.size(F.array_intersect("s", "t")).alias("common"))
        return both.filter(100 * F.col("common") >= self.percent * (F.col("both") - F.col("common"))).select("a", "b").distinct()

    def report(self) -> DataFrame:
        """A row per document: id, n_shingles, component_id (smallest id of its group), kept (it is that one)."""
        named = self.sketches.select("id", "n_shingles", "digest").join(self.same, "digest", "left")
        own = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "rep"))
        joined = named.join(self.groups.withColumnRenamed("id", "rep"), "rep", "left")
        component = F.when(F.col("id").isNotNull(), F.coalesce(own, "id"))
        return joined.select(F.col("id").alias(self.id_col), "n_shingles", component.alias("component_id")).withColumn(
            "kept", F.coalesce(F.col(self.id_col) == F.col("component_id"), F.lit(True))
        )


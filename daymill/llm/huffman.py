"""Token ids in files under a canonical, length-limited Huffman code of their global counts."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from daymill import workspace
from daymill.llm.chunks import ChunkEncoder, load, ragged
from daymill.llm.common import bound_batches, gathered

MAX_BITS = 20  # of a code; the decoding table has 2 ** MAX_BITS entries
BLOCK_IDS = 1 << 18  # a block is closed at the document with which it reaches so many ids
TEXT_BYTES = 16 << 20  # of texts tokenized at once: the more, the fewer chunks recur in other rounds
CHECKPOINT_IDS = 128  # ids between two bit offsets that a block notes


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol's code, 0 for those that do not occur: optimal among codes of at most `limit` bits
    (package-merge). A lone symbol gets one bit."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        weights = np.concatenate([leaf, packages])
        rank = np.argsort(weights, kind="stable")
        levels.append(rank < len(leaf))
        merged = weights[rank]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(leaf) - 2
    depth = np.zeros(len(leaf), np.int64)
    for leaves in reversed(levels):
        own = int(leaves[:take].sum())
        depth[:own] += 1  # leaves come in order of their counts
        take = 2 * (take - own)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        bits = lengths[order].astype(np.uint64)
        width = np.uint64(1) << (np.uint64(MAX_BITS) - bits)  # of a code among all words of MAX_BITS bits
        codes[order] = (np.cumsum(width) - width) >> (np.uint64(MAX_BITS) - bits)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, bits) for each word of MAX_BITS bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    width = np.int64(1) << (MAX_BITS - lengths[order].astype(np.int64))
    symbols = np.zeros(1 << MAX_BITS, np.uint32)
    bits = np.zeros(1 << MAX_BITS, np.uint8)
    filled = int(width.sum())
    symbols[:filled] = np.repeat(order.astype(np.uint32), width)
    bits[:filled] = np.repeat(lengths[order], width)
    return symbols, bits


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """(bits of the codes one after the other, bit offset of each CHECKPOINT_IDS-th id as 64-bit numbers)."""
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    starts = ends - bits
    total = int(ends[-1]) if len(ends) else 0
    out = np.zeros(total // 8 + 5, np.uint8)
    # Each code lies in 4 bytes at most; bits of different codes never meet, so sums by byte put them together.
    word = (codes[ids] << (32 - bits - (starts & 7)).astype(np.uint64)).astype(np.uint32)
    at = starts >> 3
    first = np.flatnonzero(np.diff(at, prepend=-1))
    for k in range(4 if len(at) else 0):
        part = (word >> np.uint32(24 - 8 * k)) & np.uint32(255)
        out[at[first] + k] += np.add.reduceat(part, first).astype(np.uint8)
    return out.tobytes(), starts[::CHECKPOINT_IDS].astype("<u8").tobytes()


def unpack(data: bytes, checkpoints: bytes, n: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The n ids of a block, all stretches between checkpoints side by side."""
    symbols, bits = table
    at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
    source = np.frombuffer(data, np.uint8).astype(np.uint32)
    words = (source[:-3] << 24) | (source[1:-2] << 16) | (source[2:-1] << 8) | source[3:]
    last = len(words) - 1
    out = np.empty((CHECKPOINT_IDS, len(at)), np.uint32)
    for k in range(CHECKPOINT_IDS):
        word = (words[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)
        out[k] = symbols[word]
        at += bits[word]
    return out.T.reshape(-1)[:n]


ENCODED = [StructField("ids", BinaryType())]
BLOCK = [
    StructField("part", IntegerType()), StructField("block", IntegerType()), StructField("start", LongType()),
    StructField("n_ids", LongType()), StructField("bits", BinaryType()), StructField("checkpoints", BinaryType()),
    StructField("doc_n", BinaryType()),
]


def id_type(tokenizer_path: str, end_id: int) -> str:
    """Numpy type of ids between the two steps: 16 bits where the vocabulary fits, else 32."""
    return "<u2" if max(load(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def _tokenize(path: str, kind: str, end_id: int, text_col: str, id_col: str, names: list[str]):
    def run(batches):
        encoder = ChunkEncoder(path, blanks_lead=False)
        for held in gathered(batches, text_col, TEXT_BYTES):
            counts, ids = encoder.ids(held.column(text_col))
            # The end id goes behind each document.
            ends = np.cumsum(counts + 1)
            out = np.full(int(ends[-1]) if len(ends) else 0, end_id, kind)
            out[ragged(ends - counts - 1, counts)] = ids
            cells = [out[e - c - 1 : e].tobytes() for e, c in zip(ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays([held.column(id_col).combine_chunks(), pa.array(cells, pa.binary())], names=names)

    return run


def _count(kind: str):
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["token", "n"])

    return run


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int = 1, id_col: str = "doc_id",
              text_col: str = "text") -> None:
    """Encode whole texts and write their ids to `folder` in ascending order of the id column.

    `folder`/codebook holds the code lengths, `folder`/blocks the coded blocks, each with whole documents, their
    numbers of ids and bit offsets by which it is decoded on its own. Null texts are empty and hold the end id only;
    null ids come first; rows of equal id follow each other by a hash of their ids. Texts are tokenized once: their ids go to
    the shared folder, are counted there (a count per id, at most the vocabulary, reaches the driver), and are dealt
    out by ranges of (id, hash), which splits runs of equal ids as well.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    id_field = StructField(id_col, docs.schema[id_col].dataType)
    names, number = [id_col, "ids"], id_type(tokenizer_path, end_id)
    width = np.dtype(number).itemsize
    encoded = docs.select(id_col, text_col).mapInArrow(
        _tokenize(tokenizer_path, number, end_id, text_col, id_col, names), StructType([id_field, *ENCODED])
    )
    encoded = workspace.materialize(encoded, "ids")
    found = encoded.select("ids").mapInArrow(_count(number), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r.token for r in found], default=0) + 1, np.int64)
    for r in found:
        counts[r.token] = r.n
    lengths = code_lengths(counts)
    spark.createDataFrame([(lengths.tobytes(),)], "lengths binary").coalesce(1).write.parquet(f"{folder}/codebook")
    codes = canonical_codes(lengths)
    schema = StructType([*BLOCK, StructField("doc_ids", ArrayType(id_field.dataType))])

    def blocks(batches):
        part, block, start = TaskContext.get().partitionId(), 0, 0
        ids, keys, size = [], [], 0

        def close():
            nonlocal block, start, ids, keys, size
            flat = np.frombuffer(b"".join(ids), number)
            bits, checkpoints = pack(flat, codes, lengths)
            doc_n = np.array([len(x) // width for x in ids], "<u8").tobytes()
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(kind)]
            row = (part, block, start, len(flat), bits, checkpoints, doc_n, keys)
            out = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=schema.names)
            block, start, ids, keys, size = block + 1, start + len(flat), [], [], 0
            return out

        for batch in batches:
            kind = batch.schema.field(id_col).type
            for key, data in zip(batch.column(id_col).to_pylist(), batch.column("ids").to_pylist()):
                ids.append(data)
                keys.append(key)
                size += len(data) // width
                if size >= BLOCK_IDS:
                    yield close()
        if ids:
            yield close()

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Ranges come from a sample of these two columns, which the driver sees; ids themselves stay in the tasks.
    place = [F.col(id_col), F.xxhash64("ids")]
    ordered = encoded.repartitionByRange(parts, *place).sortWithinPartitions(*place, "ids")
    ordered.mapInArrow(blocks, schema).write.parquet(f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str, *, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """From the files: id, start (ids of all documents before it), n_tokens, ids_crc32, and the ids if wanted.

    Every block is decoded by its own task share. Starts need the totals of the writer's partitions, a small table.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    stored = spark.read.parquet(f"{folder}/codebook").first()
    lengths = np.frombuffer(bytes(stored.lengths), np.uint8)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    key_type = blocks.schema["doc_ids"].dataType.elementType
    fields = [StructField(id_col, key_type), StructField("part", IntegerType()), StructField("start", LongType()),
              StructField("n_tokens", LongType()), StructField("ids_crc32", LongType())]
    if with_ids:
        fields.append(StructField("ids", BinaryType()))
    schema = StructType(fields)

    def decode(batches) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                n = np.frombuffer(row["doc_n"].as_py(), "<u8").astype(np.int64)
                ids = unpack(row["bits"].as_py(), row["checkpoints"].as_py(), row["n_ids"].as_py(), table).astype("<u4")
                ends = np.cumsum(n)
                data = memoryview(ids.tobytes())
                cells = [data[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), n.tolist())]
                columns = [
                    row["doc_ids"].values, pa.array(np.full(len(n), row["part"].as_py(), np.int32)),
                    pa.array(ends - n + row["start"].as_py()), pa.array(n),
                    pa.array([zlib.crc32(c) for c in cells], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([bytes(c) for c in cells], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    decoded = blocks.select("part", "start", "n_ids", "bits", "checkpoints", "doc_n", "doc_ids").mapInArrow(decode, schema)
    out = [id_col, (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return decoded.join(before, "part").select(*out)

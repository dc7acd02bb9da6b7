"""Exact deduplication by Grace hashing: equal contents are found by comparing them whole."""

import hashlib
import itertools
import os
import pickle
import struct
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from daymill import workspace
from daymill.llm.common import BATCH_ROWS, SMALL_BYTES, bound_batches, lean

TABLE_BYTES = 64 << 20
FANOUT = 16
HEAD = struct.Struct("<QQ")


class ContentTable:
    """Open addressing with linear probing; a slot matches when the whole content does."""

    def __init__(self, limit: int):
        self.limit, self.used = limit, 0
        self.contents: list[bytes] = []
        self.hashes: list[int] = []
        self.slots = np.full(1024, -1, np.int64)

    def find(self, key: int, content: bytes) -> int:
        """Index of the content, added if absent; -1 when it is absent and the table is full."""
        mask = len(self.slots) - 1
        at = key & mask
        while (held := self.slots[at]) >= 0:
            if self.hashes[held] == key and self.contents[held] == content:
                return int(held)
            at = (at + 1) & mask
        if self.contents and self.used + len(content) > self.limit:
            return -1
        self.slots[at] = len(self.contents)
        self.contents.append(content)
        self.hashes.append(key)
        self.used += len(content) + 400  # and what is kept of it
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return len(self.contents) - 1

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for i, key in enumerate(self.hashes):
            at = key & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def grace_fold(records: Iterable[tuple], begin, join, limit: int = TABLE_BYTES, level: int = 0) -> Iterator[tuple]:
    """Fold (content, item) records into one state per distinct content, a bounded part of them in memory.

    begin(item) makes a content's state, join(state, item) adds a further record. Yields (None, state, item) for each
    record as it joins, and (content, state, None) for each content in the end. Records whose content is in the table
    join it there. Once the table is full, the others go to spill files, items included, by a hash that differs at each level,
    and each file is treated the same way. Every level settles at least one content, so it ends for any input, one
    content with all the records included. Items can be whatever pickles.
    """
    table, states = ContentTable(limit), []
    with tempfile.TemporaryDirectory() as folder:
        files: dict[int, object] = {}
        for content, item in records:
            key = xxhash.xxh64_intdigest(content, seed=level)
            at = table.find(key, content)
            if at < 0:
                part = (key >> 56) % FANOUT
                if part not in files:
                    files[part] = open(os.path.join(folder, str(part)), "wb")
                packed = pickle.dumps(item)
                files[part].write(HEAD.pack(len(content), len(packed)))
                files[part].write(content)
                files[part].write(packed)
                continue
            if at == len(states):
                states.append(begin(item))
            else:
                join(states[at], item)
            yield None, states[at], item
        for f in files.values():
            f.close()
        for content, state in zip(table.contents, states):
            yield content, state, None
        del table, states
        for part in sorted(files):
            path = os.path.join(folder, str(part))
            yield from grace_fold(_spilled(path), begin, join, limit, level + 1)
            os.unlink(path)


def grace_groups(records: Iterable[tuple], limit: int = TABLE_BYTES) -> Iterator[tuple]:
    """(content, labels of its records) for each distinct content of (content, label) records."""
    for content, labels, _ in grace_fold(records, lambda label: [label], list.append, limit):
        if content is not None:
            yield content, labels


def _spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while head := f.read(HEAD.size):
            size, packed = HEAD.unpack(head)
            yield f.read(size), pickle.loads(f.read(packed))


def _higher(a, b) -> bool:
    """Ids in order, null below all."""
    return b is None or (a is not None and a > b)


class Best:
    """Of a content: the number of its rows, and the mark and id of the row that stays."""

    __slots__ = ("gid", "n", "id", "at", "sha", "gids")

    def __init__(self, gid, n, id_, at, sha=None):
        self.gid, self.n, self.id, self.at, self.sha, self.gids = gid, n, id_, at, sha, [gid]

    def add(self, n, id_, at) -> None:
        self.n += n
        if _higher(id_, self.id):
            self.id, self.at = id_, at


def _in_tasks(docs: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """A row per document with its mark `at` and its other columns, and a row per distinct content of each input partition
    (rep) with the text, the number of its rows, and the mark and id of the one that would stay there.

    Rows leave the task as they are read or, where their content is spilled, with it; the table keeps contents and Best only."""
    rest = StructType([StructField(f.name, f.dataType, True) for f in docs.schema if f.name != text_col])
    schema = StructType(
        [StructField("gid", LongType()), StructField("rep", BooleanType()), StructField("id", docs.schema[id_col].dataType), StructField("at", LongType()),
         StructField("no_text", BooleanType()), StructField("n", LongType()), StructField("sha", StringType()), StructField("text", StringType()),
         StructField("rest", rest)]
    )

    def run(batches):
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        numbers, marks, kind = itertools.count(base), itertools.count(base), None

        def records():
            nonlocal kind
            for batch in batches:
                kind = batch.schema
                for row in batch.to_pylist():
                    text = row.pop(text_col)
                    yield (text or "").encode("utf-8"), (next(marks), text is None, row)

        def arrow(out):
            row_type = pa.struct([pa.field(f.name, f.type) for f in kind if f.name != text_col])
            kinds = [pa.int64(), pa.bool_(), kind.field(id_col).type, pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), row_type]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=schema.names)

        begin = lambda item: Best(next(numbers), 1, item[2][id_col], item[0])
        out, size = [], 0
        for content, best, item in grace_fold(records(), begin, lambda best, item: best.add(1, item[2][id_col], item[0]), limit):
            if content is None:
                out.append((best.gid, False, item[2][id_col], item[0], item[1], None, None, None, item[2]))
            else:
                out.append((best.gid, True, best.id, best.at, None, best.n, hashlib.sha256(content).hexdigest(), content.decode("utf-8"), None))
                size += len(content)
            if size > SMALL_BYTES or len(out) >= BATCH_ROWS:
                yield arrow(out)
                out, size = [], 0
        if out:
            yield arrow(out)

    return docs.mapInArrow(lean(run), schema)


def _across(reps: DataFrame, limit: int) -> DataFrame:
    """(gid, keep_id, keep_at, owner, group_size, text_sha256): the contents of all partitions, dealt out by their
    hash. `owner` marks one gid of each content."""
    schema = StructType(
        [StructField("gid", LongType()), StructField("keep_id", reps.schema["id"].dataType), StructField("keep_at", LongType()),
         StructField("owner", BooleanType()), StructField("group_size", LongType()), StructField("text_sha256", StringType())]
    )

    def run(batches):
        kind = None

        def records():
            nonlocal kind
            for batch in batches:
                kind = batch.schema
                for gid, n, top, at, sha, text in zip(*(batch.column(i).to_pylist() for i in range(6))):
                    yield text.encode("utf-8"), (gid, n, top, at, sha)

        def arrow(out):
            kinds = [pa.int64(), kind.field("id").type, pa.int64(), pa.bool_(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=schema.names)

        def joined(best, item):
            best.add(item[1], item[2], item[3])
            best.gids.append(item[0])

        out = []
        for content, best, _ in grace_fold(records(), lambda item: Best(*item), joined, limit):
            if content is not None:
                out += [(gid, best.id, best.at, gid == best.gid, best.n, best.sha) for gid in best.gids]
            if len(out) > 20_000:
                yield arrow(out)
                out = []
        if out:
            yield arrow(out)

    return reps.select("gid", "n", "id", "at", "sha", "text").repartition(F.col("sha")).mapInArrow(lean(run), schema)


class ExactDedup:
    """Equal texts of `docs` and the row that stays of each: the one with the largest id.

    Contents are the whole texts as they are; null counts as empty. In each input partition a table of contents
    (at most `limit` bytes, the rest through spill files) leaves one copy of each, so a content that fills a third
    of all rows sends one row per partition into the shuffle. The shuffle deals contents out by their hash, and the
    same table joins what the partitions found. Ids may repeat or be null (below all others): still exactly one row
    of each content stays. Other columns of any name are kept. The first step is written to the shared folder.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TABLE_BYTES):
        bound_batches(docs.sparkSession, SMALL_BYTES)
        self.columns, self.id_col, self.text_col = docs.columns, id_col, text_col
        self.parts = workspace.materialize(_in_tasks(docs, id_col, text_col, limit), "contents")
        self.reps, self.members = self.parts.filter("rep"), self.parts.filter("not rep")
        self.groups = workspace.materialize(_across(self.reps, limit), "content-groups")

    def report(self) -> DataFrame:
        """A row per document, dropped ones too: id, keep_id, group_size, kept, text_sha256."""
        joined = self.members.select("gid", F.col("id").alias(self.id_col), "at").join(self.groups, "gid")
        return joined.select(self.id_col, "keep_id", "group_size", (F.col("at") == F.col("keep_at")).alias("kept"), "text_sha256")

    def kept(self) -> DataFrame:
        """The rows that stay, with the columns of the input."""
        texts = self.reps.join(self.groups.filter("owner").select("gid", "keep_at"), "gid").select("keep_at", "text")
        rows = self.members.select("at", "no_text", "rest").join(texts, F.col("at") == F.col("keep_at"))
        own = {self.text_col: F.when(~F.col("no_text"), F.col("text")).alias(self.text_col)}
        return rows.select(*[own.get(c, F.col("rest")[c].alias(c)) for c in self.columns])

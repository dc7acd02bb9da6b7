"""Merkle manifest against a plain recursive construction."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from daymill.llm import merkle
from daymill.llm.queries import QUERIES
from daymill.llm.ranking import placed

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def up(nodes):
    """(root, for each node the siblings of its way as (left, right)); nodes alone on a level go up as they are."""
    ways, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for way, k in zip(ways, at):
            run = level[k // 8 * 8 : k // 8 * 8 + 8]
            way.append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
        at, level = [k // 8 for k in at], [H(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0], ways


def brute(rows):
    """The query's rows as plain tuples."""
    def leaf(r, text):
        return H(*(field(v) for v in (r[0], r[1], r[2], r[3], text)))

    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: up([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in langs}
    root, tops = up([trees[g][0] for g in langs])
    out = []
    for g, top in zip(langs, tops):
        for (_, _, digest, r), way in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            steps = way + top
            held = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                held = leaf(r, r[4] and r[4].translate(small))
            for left, right in steps:
                held = H(left, held, right)
            out.append((r[0], digest, trees[g][0], root, H(*(a + b for a, b in steps)), held, held == root))
    return sorted(out, key=repr)


def result(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).withColumns({"idx": F.lit(1), "tree": F.lit("x"), "_p_part": F.lit(None).cast("int")}).write.mode("overwrite").parquet(
        f"{path}/documents.parquet"
    )
    return sorted((tuple(r) for r in QUERIES["op11_merkle_proofs"](spark, str(path)).collect()), key=repr)


CASES = {
    "one row": [(5, "a", "en", 3, "ABC")],
    "one row each": [(1, None, None, None, None), (2, "a", "", 0, ""), (3, "a", "z", 1, "Z")],
    "runs of every length": [(i, "s", f"l{n}", i, f"Text {i}") for n in (1, 7, 8, 9, 63, 64, 65, 73) for i in range(n)],
    "many languages": [(i, "s", f"l{i % 70}", None, "é日 X" * i) for i in range(200)],
    "one language": [(i, "s", "en", i, f"T{i}") for i in range(600)],
    "nulls, ties and repeats": [(None, None, None, None, None)] * 3 + [(7, "a", None, 1, "Ab"), (7, "b", None, 1, "Ab"), (7, "a", None, 1, "Ab"), (-3, "-", "-", 0, "1:x")],
    "long text": [(i, "s", "en", 0, "Long Text " * 100_000 if i == 4 else None) for i in range(12)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_rows(spark, tmp_path, name):
    assert result(spark, CASES[name], tmp_path) == brute(CASES[name])


def test_no_rows(spark):
    manifest = merkle.Manifest(spark.createDataFrame([], SCHEMA))
    assert manifest.root is None and manifest.proofs().count() == 0


def test_shuffled_ancestors_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(CASES["one language"], SCHEMA)
    broadcast = {repr(r) for r in merkle.Manifest(docs).proofs().collect()}
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", -1)
    assert {repr(r) for r in merkle.Manifest(docs).proofs().collect()} == broadcast


def test_places(spark):
    rows = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then null when id % 7 < 5 then 'hot' else 'x' || (id % 40) end as g")
    got = placed(rows, ["g"], [F.desc("id")]).collect()
    held = {}
    for r in sorted(got, key=lambda r: -r.id):
        assert r.place == held.get(r.g, 0)
        held[r.g] = r.place + 1
    assert all(r.group_size == held[r.g] for r in got) and len(got) == 5000
    assert sorted(r.place for r in placed(rows, [], ["id"]).collect()) == list(range(5000))

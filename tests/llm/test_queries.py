"""Registered queries over whole tables against brute force, exact round trips and held-out labels."""

import collections
import re
import zlib
from array import array

import duckdb
import numpy as np
import public_tokenizers
import pytest

from checks.compare import compare, duck
from daymill.llm import chunks
from daymill.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stored(sf_dir, table, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{table}.parquet'").fetchall()


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(SMALL))
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def groups(ids, links):
    """Smallest reachable id of each id."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_links(sets):
    ids = sorted(i for i in sets if sets[i])
    holders = collections.defaultdict(list)
    for i in ids:
        for s in sets[i]:
            holders[s].append(i)
    common = collections.Counter((a, b) for held in holders.values() for k, a in enumerate(held) for b in held[k + 1 :])
    return [(a, b) for (a, b), n in common.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, sf_dir, name):
    rows, differences = compare(spark, duck(sf_dir), QUERIES[name], ORACLE[name], sf_dir)
    assert rows > 0 and differences == []


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_embeddings(spark, sf_dir):
    rows = stored(sf_dir, "embeddings", "vec_id, embedding, label")
    units = np.array([r[1] for r in rows], float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = np.argwhere(units @ units.T >= 0.98)
    links = [(rows[a][0], rows[b][0]) for a, b in near if a < b and rows[a][2] == rows[b][2]]
    want = groups([r[0] for r in rows], links)
    counts = collections.Counter(x for pair in links for x in pair)
    got = QUERIES["op1_projection_collisions"](spark, sf_dir).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (counts[i], c, c == i) for i, c in want.items()}


def test_toxicity_held_out(spark, sf_dir):
    """At this size few labels are learned from; most held-out rows must be right, and columns in range."""
    labels = dict(stored(sf_dir, "labels", "doc_id, toxic"))
    got = QUERIES["op2_toxicity"](spark, sf_dir).collect()
    assert len(got) == len(stored(sf_dir, "documents", "doc_id"))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.9


def test_language_held_out(spark, sf_dir):
    lang = dict(stored(sf_dir, "documents", "doc_id, lang"))
    got = QUERIES["op5_language_id"](spark, sf_dir).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.98
    assert not any(r.rejected for r in got)


def test_sentencepiece_round_trip(spark, sf_dir):
    got = QUERIES["op3_sentencepiece_dropout"](spark, sf_dir).collect()
    assert len(got) == len(stored(sf_dir, "documents", "doc_id")) and all(r.lossless and r.n_tokens == len(r.ids) for r in got)


def test_near_duplicates(spark, sf_dir):
    sets = {i: shingles(t) for i, t in stored(sf_dir, "documents", "doc_id, text")}
    want = groups(sets, near_links(sets))
    got = QUERIES["op4_hyperminhash"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), c, c == i) for i, c in want.items()}


def test_token_counts_and_files(spark, sf_dir):
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op6_token_counts"](spark, sf_dir).collect()}
    files = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op7_huffman_ids"](spark, sf_dir).collect()}
    byte, word = (chunks.load(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    start = 0
    for i, text in sorted(stored(sf_dir, "documents", "doc_id, text")):
        n = len(byte.encode(text, add_special_tokens=False).ids)
        assert counts[i] == (len(text.encode()), n, n > 512)
        ids = [*word.encode(text, add_special_tokens=False).ids, 1]
        assert files[i] == (start, len(ids), zlib.crc32(array("I", ids).tobytes()))
        start += len(ids)


def test_mix_comes_near_its_targets(spark, sf_dir):
    rows = QUERIES["op10_source_mix"](spark, sf_dir).collect()
    source = dict(stored(sf_dir, "documents", "doc_id, source"))
    taken, target = collections.Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) <= 0.02 * t for s, t in target.items())
    again = QUERIES["op10_source_mix"](spark, sf_dir).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}

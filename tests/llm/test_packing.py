"""Packing: the plan against best fit piece by piece, ids against the library, and the packed sequences themselves."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daymill.llm import chunks, packing
from daymill.llm.queries import QUERIES
from daymill.llm.ranks import RankEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def piece_by_piece(counts, capacity):
    """Space left in each sequence, by best fit over single pieces, longest first."""
    left = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [i for i, space in enumerate(left) if space >= length]
            if fits:
                left[min(fits, key=lambda i: left[i])] -= length
            else:
                left.append(capacity - length)
    return sorted(left)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(0, 15), max_size=10))))
def test_plan_is_best_fit(case):
    capacity, counts = case
    rows, n = packing.best_fit(counts, capacity)
    placed, used = collections.Counter(), collections.defaultdict(list)
    for length, first, slots, sequence, each, offset in rows:
        assert first == placed[length]
        placed[length] += slots
        for j in range(slots):
            used[sequence + j // each].append((offset + j % each * length, length))
    assert dict(placed) == {k: v for k, v in counts.items() if v}
    for parts in used.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([x for _, x in parts])[:-1]]
    assert sorted(used) == list(range(n))
    assert sorted(capacity - sum(x for _, x in p) for p in used.values()) == piece_by_piece(counts, capacity)


def test_plan_refuses_what_does_not_fit():
    with pytest.raises(ValueError):
        packing.best_fit({5: 1}, 4)
    assert packing.best_fit({}, 4) == ([], 0)


def test_encoder_equals_the_library():
    encoder, library = RankEncoder(PATH), chunks.load(PATH)
    assert encoder.ranks is not None
    letters = [chr(c) for c in (*range(0x250), *range(0x2000, 0x2070))] + list(" \n\t\x85\xa0\x1c'’") * 20 + list("abcdest'") * 20
    draw = random.Random(1)
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(5000)]
    texts += ["a<|endoftext|>b", "日本 語 ͸", "x" * 5000, " " * 3000 + "y", "\n" * 1500, "", "'LL we'Ll 'll"]
    assert all(encoder.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids for t in texts)
    assert encoder.ids(None).tolist() == []


def test_encoder_leaves_other_files_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = RankEncoder(path), chunks.load(path)
    assert encoder.ranks is None and encoder.ids("Two words").tolist() == library.encode("Two words", add_special_tokens=False).ids


def checked(rows, texts, capacity):
    """Rows hold every document whole and gapless sequences."""
    library = chunks.load(PATH)
    of, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(of) == set(texts)
    for i, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(of[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]]
        assert sum(r.length for r in pieces) == len(ids) and all(r.length == capacity for r in pieces[1:])
        assert len(pieces) == 1 or len(ids) > capacity
        assert [r.ids_crc32 for r in pieces] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces]
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= capacity
    lengths = collections.Counter(r.length for r in rows)
    assert len(sequences) == len(piece_by_piece(lengths, capacity))


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    checked(QUERIES["op13_best_fit_packing"](spark, sf_dir).collect(), texts, 2048)


def test_sequences_hold_the_ids(spark):
    draw = random.Random(3)
    texts = {i: " ".join(draw.choice("one two three four".split()) for _ in range(draw.randint(0, 40))) for i in range(60)}
    texts |= {60: None, 61: "", 62: "long " * 300, 63: texts[0], 64: texts[0]}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, at string")
    packed = packing.Packing(docs, PATH, capacity=64)
    placed = packed.placements().collect()
    checked(placed, texts, 64)
    sequences = {r.sequence_id: r for r in packed.sequences().collect()}
    assert len(sequences) == packed.n_sequences
    for r in placed:
        s = sequences[r.sequence_id]
        assert s.n_tokens * 4 == len(s.ids) and zlib.crc32(s.ids[4 * r.offset : 4 * (r.offset + r.length)]) == r.ids_crc32
        assert s.doc_ids[s.offsets.index(r.offset)] == r.doc_id


def test_null_and_repeated_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (None, None), (1, "b c"), (1, "b c")], "doc_id long, text string")
    rows = packing.Packing(docs, PATH, capacity=8).placements().collect()
    assert len(rows) == 4 and sorted((r.sequence_id, r.offset) for r in rows) == sorted({(r.sequence_id, r.offset) for r in rows})
    empty = packing.Packing(docs.limit(0), PATH)
    assert empty.n_sequences == 0 and empty.placements().count() == 0 and empty.sequences().count() == 0

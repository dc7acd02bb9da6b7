"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import ctypes
import gc
import os
import random
import tempfile

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from daymill import workspace
from daymill.llm import (
    chat, chunks, common, embedding_dedup, exact_dedup, huffman, hyperminhash, language_id, mixing, sentencepiece_dropout,
    token_counts, toxicity,
)
from tests.llm.test_queries import groups, near_links, shingles

BYTE, WORDS, PIECES = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string, lang string, source string, gid string, score string, row string, ids string, _key long, size string"
ODD = [None, "", " ", "\n\t", "a", "▁x ▁", "<|endoftext|> x", "É " * 3, "word " * 30_000, "x" * 50_000, "中文 字", "same", "same", "\x00"]


def docs(spark, rows):
    """Columns whose names the operators use themselves are there too."""
    filled = [(i, t, "en", s, "g", "s", "r", "i", 7, "z") for i, t, s in rows]
    return spark.createDataFrame(filled, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 3 else "a") for i, t in enumerate(ODD)]
    return docs(spark, [*rows, (4, "a", "b"), (4, "a", "b"), (None, "same", "a"), (None, "alone", None)]).repartition(3)


def new_folder(spark):
    return workspace.new_path(spark, "test")


def test_grace_groups_with_spills():
    random.seed(1)
    contents = [random.choice([b"", b"hot", b"x" * random.randrange(40), str(random.randrange(300)).encode()]) for _ in range(5000)]
    for limit in (1, 2000, 1 << 20):
        found = {}
        for content, labels in exact_dedup.grace_groups(((c, i) for i, c in enumerate(contents)), limit):
            assert content not in found
            found[content] = sorted(labels)
        want = {}
        for i, c in enumerate(contents):
            want.setdefault(c, []).append(i)
        assert found == want


def test_exact_dedup(spark, odd):
    for limit in (10, 1 << 20):
        job = exact_dedup.ExactDedup(odd, limit=limit)
        report, kept = job.report().collect(), job.kept()
        assert len(report) == odd.count() and kept.columns == odd.columns
        rows = kept.collect()
        texts = [r.text or "" for r in rows]
        assert len(set(texts)) == len(texts) == len({r.text or "" for r in odd.collect()})
        assert {r.doc_id for r in rows if r.text == "same"} == {12} and {r.doc_id for r in rows if not r.text} == {1}
        assert sum(r.kept for r in report) == len(rows)
        assert {r.group_size for r in report if r.keep_id == 4} == {3}
    assert exact_dedup.ExactDedup(odd.limit(0)).report().count() == 0


def test_near_duplicates_on_planted_groups(spark):
    random.seed(4)
    words = [f"w{i}" for i in range(3000)]
    texts, passage = [], " ".join(random.choices(words, k=60))
    for _ in range(12):
        base = random.choices(words, k=random.choice([3, 8, 40, 200]))
        for _ in range(random.choice([1, 3, 40])):
            copy = list(base)
            for _ in range(random.randrange(4)):
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append(random.choice([" ", "\n"]).join(copy))
    texts += [passage + " " + " ".join(random.choices(words, k=40)) for _ in range(80)] + [None, "", "One two", "one TWO"]
    frame = docs(spark, [(i, t, "a") for i, t in enumerate(texts)]).repartition(5)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = groups(sets, near_links(sets))
    got = hyperminhash.NearDuplicates(frame).report().collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), c) for i, c in want.items()}


def test_near_duplicates_on_odd_rows(spark, odd):
    got = hyperminhash.NearDuplicates(odd).report().collect()
    assert len(got) == odd.count()
    assert {(r.component_id, r.kept) for r in got if r.doc_id == 12} == {(11, False)}
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert hyperminhash.NearDuplicates(odd.limit(0)).report().count() == 0


def test_components(spark):
    random.seed(2)
    path = list(range(100, 160))
    random.shuffle(path)
    links = list(zip(path, path[1:])) + [(1, k) for k in range(2, 40)] + [(50, 51), (51, 50), (7, 7)]
    got = common.components(spark.createDataFrame(links, "a long, b long"))
    want = groups({x for l in links for x in l}, links)
    assert {(r.id, r.component_id) for r in got.collect()} == set(want.items())


def test_embeddings_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in (1, 2):
        for size in (1, 2, 30, 600):
            base = rng.standard_normal(24)
            for _ in range(size):
                rows.append((n, (base + rng.standard_normal(24) * 0.08 * np.linalg.norm(base) / 5).tolist(), label))
                n += 1
    bad = [None, [0.0] * 24, [float("nan")] * 24, [float("inf"), *[1.0] * 23], [None, *[1.0] * 23], [], [1.0, 2.0]]
    rows += [(n + k, v, 1) for k, v in enumerate(bad)] + [(n + 20, rows[0][1], None), (n + 21, [2 * x for x in rows[0][1]], 1)]
    frame = spark.createDataFrame([*rows, (None, rows[0][1], 1)], "vec_id long, embedding array<double>, label int").repartition(4)
    links = []
    for k, (i, v, x) in enumerate(rows):
        for j, w, y in rows[:k]:
            ok = all(u is not None and len(u) == 24 and None not in u and np.isfinite(u).all() and np.any(u) for u in (v, w))
            if ok and x == y and x is not None and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links.append((i, j))
    want = groups([r[0] for r in rows], links)
    got = embedding_dedup.near_duplicates(frame).collect()
    assert {r.vec_id: r.component_id for r in got if r.vec_id is not None} == want
    assert sum(r.n_links for r in got) == 2 * len(links) and len(got) == len(rows) + 1
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("file,lead", [(WORDS, False), (BYTE, True)])
def test_chunks_are_the_library(file, lead):
    random.seed(5)
    signs = [" ", "  ", "\n", "a", "B", "é", "́", " ", " ", "\x1c", "1", "'s", ".", "<|endoftext|>", "Σ", "İ", "中", "\r\n", "😀", "don't"]
    texts = [None, *["".join(random.choices(signs, k=random.randrange(15))) for _ in range(3000)], *[t for t in ODD if t]]
    encoder = chunks.ChunkEncoder(file, lead)
    counts, ids = encoder.ids(pa.array(texts))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert encoder.tokenizer.encode(text or "", add_special_tokens=False).ids == ids[a:b].tolist()


def test_token_counts_use_the_cache(spark, odd):
    cache = new_folder(spark)
    first = token_counts.count_tokens(odd, cache, BYTE)
    rows = sorted((r.n_bytes, r.n_tokens) for r in first.collect())
    tokenizer = chunks.load(BYTE)
    assert rows == sorted((len((r.text or "").encode()), len(tokenizer.encode(r.text or "").ids)) for r in odd.collect())
    stored = spark.read.parquet(cache).count()
    assert stored == len({r.text or "" for r in odd.collect()})
    again = token_counts.count_tokens(odd, cache, BYTE)
    assert sorted((r.n_bytes, r.n_tokens) for r in again.collect()) == rows and spark.read.parquet(cache).count() == stored
    assert token_counts.count_tokens(odd.limit(0), new_folder(spark), BYTE).count() == 0


def test_huffman_codes():
    rng = np.random.default_rng(0)
    for counts in (np.array([0, 5]), np.array([1, 1, 1]), 2 ** np.arange(30), rng.zipf(1.3, 3000) % 100000):
        lengths = huffman.code_lengths(counts)
        used = lengths[counts > 0].astype(int)
        assert used.max() <= huffman.MAX_BITS and (lengths[counts == 0] == 0).all()
        assert sum(2 ** (huffman.MAX_BITS - n) for n in used.tolist()) <= 2**huffman.MAX_BITS
        ids = rng.choice(np.flatnonzero(counts), 1000).astype(np.uint32)
        packed = huffman.pack(ids, huffman.canonical_codes(lengths), lengths)
        assert (huffman.unpack(*packed, 1000, huffman.decoding_table(lengths)) == ids).all()


def test_huffman_files(spark, odd):
    folder = new_folder(spark)
    huffman.write_ids(odd, folder, WORDS)
    got = huffman.read_ids(spark, folder, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in odd.collect()), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    tokenizer = chunks.load(WORDS)
    want = sorted((-1 if r.doc_id is None else r.doc_id, [*tokenizer.encode(r.text or "").ids, 1]) for r in odd.collect())
    assert sorted((-1 if r.doc_id is None else r.doc_id, np.frombuffer(r.ids, "<u2").tolist() if False else np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    empty = new_folder(spark)
    huffman.write_ids(odd.limit(0), empty, WORDS)
    assert huffman.read_ids(spark, empty).count() == 0


def test_sentencepiece(spark, odd):
    model = SentencePieceProcessor(model_file=PIECES)
    plain = sentencepiece_dropout.encode(odd, PIECES, dropout=0.0)
    for r in plain.collect():
        if "▁" not in (r.text or ""):
            assert r.ids == model.encode(r.text or "")
    one, same, other = (
        {(r.doc_id, r.text): r for r in sentencepiece_dropout.decode(
            sentencepiece_dropout.encode(odd.repartition(n), PIECES, dropout=0.3, seed=s), PIECES).collect()}
        for s, n in ((1, 1), (1, 7), (2, 1))
    )
    assert all(r.decoded == (r.text or "") for r in one.values())
    assert {k: r.ids for k, r in one.items()} == {k: r.ids for k, r in same.items()}
    assert any(r.ids != other[k].ids for k, r in one.items())
    assert sentencepiece_dropout.encode(odd.limit(0), PIECES).count() == 0


def test_segmenting_side_by_side_is_the_agenda():
    random.seed(6)
    pieces = sentencepiece_dropout.Pieces.of(PIECES)
    signs = [" ", "a", "the", "é", "́", "中", "😀", "ing", "er", "\x00", "▁"]
    words = [" " + "".join(random.choices(signs, k=random.randrange(20))) for _ in range(2000)]
    keys = [random.getrandbits(64) for _ in words]
    for bound in (0, sentencepiece_dropout.MASK // 4, sentencepiece_dropout.MASK):
        got = pieces.encode_all(words, keys, bound)
        assert [np.frombuffer(x, "<i4").tolist() for x in got] == [pieces.encode(w, k, bound) for w, k in zip(words, keys)]


def test_each_occurrence_skips_by_itself(spark):
    """Every merge of a frequent word is skipped at about the dropout's share of its occurrences, in their own pattern."""
    pieces, n = sentencepiece_dropout.Pieces.of(PIECES), 20000
    for word in ("the", "information", "quickly"):
        merges = []
        pieces.encode(" " + word, 0, 0, merges)
        plain = np.array(pieces.encode(" " + word, 0, 0), "<i4").tobytes()
        docs = spark.createDataFrame([(i, " ".join([word] * 100)) for i in range(n // 100)], "doc_id long, text string")
        # Without its last merge a word comes out in two pieces; without none in one.
        whole = sum(r.ids.count(int(np.frombuffer(plain, "<i4")[0])) for r in sentencepiece_dropout.encode(docs, PIECES).collect())
        assert len(plain) == 4 and whole / n > 0.9 ** len(merges) - 0.02
        keys = np.array([random.Random(i).getrandbits(64) for i in range(n)], np.uint64)
        bound = sentencepiece_dropout.MASK // 10
        parts, at = pieces.encode_occurrences([" " + word], np.zeros(n, np.int64), keys, bound)
        alone = [np.array(pieces.encode(" " + word, int(k), bound), "<i4").tobytes() for k in keys[:3000]]
        assert [parts[i] for i in at[:3000]] == alone
        for left, piece in merges:
            mixed = (keys ^ np.uint64((left * sentencepiece_dropout.FIRST ^ piece * sentencepiece_dropout.SECOND) & sentencepiece_dropout.MASK))
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(sentencepiece_dropout.THIRD)
            assert abs(((mixed ^ (mixed >> np.uint64(29))) < np.uint64(bound)).mean() - 0.1) < 0.01
    # One merge: it is skipped at a tenth of the places of a corpus, under every seed.
    pair = next(p for p, i in pieces.id_of.items() if len(p) == 2 and p[0] == " " and p[1].isascii() and p[1].isalpha())
    docs = spark.createDataFrame([(i, " ".join([pair[1]] * 100)) for i in range(n // 100)], "doc_id long, text string")
    for seed in range(3):
        ids = [x for r in sentencepiece_dropout.encode(docs, PIECES, seed=seed).collect() for x in r.ids]
        assert abs(1 - ids.count(pieces.id_of[pair]) / n - 0.1) < 0.01


def test_language_rejects(spark, odd):
    random.seed(7)
    words = {"en": "the of and that with this from have were been".split(), "de": "der die und nicht eine werden durch schon über".split()}
    rows = [(i, " ".join(random.choices(words[x], k=40)), x) for i, x in enumerate(["en", "de"] * 100)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = [(1, "the of that have"), (2, "nicht durch die"), (3, None), (4, "12 34 !!"), (5, "日本語の文章がここにあります" * 20), (6, "")]
    got = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 6)] == ["en", "de", "und", "und", "und"]
    assert [got[i].rejected for i in (1, 2, 3, 4, 5, 6)] == [False, False, True, True, True, True]
    assert language_id.predict(odd, model).count() == odd.count()
    nothing = language_id.fit(odd.limit(0))
    assert {r.lang_pred for r in language_id.predict(odd, nothing).collect()} == {"und"}


def test_toxic_clauses(spark, odd):
    random.seed(8)
    calm = "river stone letter window garden music paper morning".split()
    rows = []
    for i in range(400):
        words = random.choices(calm, k=30)
        if i % 5 == 0:
            words[random.randrange(30)] = random.choice(["dolt", "oafish"])
        rows.append((" ".join(words) + ".", int(i % 5 == 0)))
    model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    assert {"dolt", "oafish"} <= set(model.words)
    assert model.score("a garden and a dolt") > 0.5 > model.score("a garden and a stone")
    contexts = lambda t: [c for _, c in model.matches(t)]
    assert contexts("you are a dolt") == [(False, False, True)]
    assert contexts("not a dolt. dolt") == [(True, False, False), (False, False, False)]
    assert contexts('he wrote "dolt" today') == [(False, True, True)]
    assert contexts("we will kill them") == [(False, False, True)] and contexts("they kill time") == []
    assert toxicity.score(odd, model).count() == odd.count() and model.score(None) == model.score("")
    assert toxicity.fit(spark.createDataFrame([], "text string, toxic int")).score("dolt") < 0.5


def test_toxicity_keeps_the_rate_of_capped_classes(spark):
    """2 % toxic; a rare insult in three toxic texts and a common word in both: a bound on the sample moves no score much."""
    rng = random.Random(5)
    plain = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    text = lambda *more: " ".join([*rng.choices(plain, k=8), *more])
    rows = [(text("you", "glorkish" if i < 3 else "dolt"), 1) for i in range(120)]
    rows += [(text("you", "dolt") if i < 60 else text("dolt") if i < 90 else text(), 0) for i in range(5880)]
    labelled = spark.createDataFrame(rows, "text string, toxic int")
    whole, capped = toxicity.fit(labelled, per_class=6000), toxicity.fit(labelled, per_class=600)
    assert whole.words == capped.words and "glorkish" in capped.words and "dolt" in capped.words
    for words in ([], ["you", "dolt"], ["dolt"], ["you", "glorkish"], ["not", "dolt"]):
        line = " ".join([*plain[:8], *words])
        assert abs(whole.score(line) - capped.score(line)) < 0.1, words


def test_toxicity_keeps_every_telling_word(spark):
    words = ["".join(chr(97 + i // 17**k % 17) for k in range(4)) + "zkq" for i in range(6000)]
    rows = [(" ".join([*words[1500 * (i % 4) : 1500 * (i % 4 + 1)], str(i), "x" * i]), 1) for i in range(12)]
    rows += [(f"plain line {'o' * i}", 0) for i in range(1200)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(words) <= set(model.words)


def test_grams_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["one two", "", None, "1 two", "  ", "two", "Zwei, drei!", "x" * 9000]
    together, letters = language_id.gram_counts(texts)
    for k, text in enumerate(texts):
        alone, n = language_id.gram_counts([text])
        assert (alone[0] == together[k]).all() and n[0] == letters[k]
    assert language_id.gram_counts([])[0].shape == (0, language_id.BUCKETS)


def test_language_model_against_plain_sums(spark):
    """The same fit from whole arrays in one process: frequencies, centroids, floors, and every label and cosine."""
    draw = random.Random(3)
    words = {lang: ["".join(draw.choice(abc) for _ in range(draw.randrange(2, 8))) for _ in range(60)]
             for lang, abc in (("aa", "abcdefg"), ("bb", "efghijk"), ("cc", "aeiourst"))}
    rows = [(" ".join(draw.choice(words[lang]) for _ in range(draw.choice((3, 60, 400)))), lang) for lang in words for _ in range(90)]
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string").repartition(4))
    texts, names = [t for t, _ in rows], sorted(words)
    counts, letters = language_id.gram_counts(texts)
    idf = np.log((1 + len(texts)) / (1 + (counts > 0).sum(0))) + 1
    vectors = np.log1p(counts) * idf
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    langs = np.array([names.index(lang) for _, lang in rows])
    cluster, n = np.digitize(letters, (250, 1000, 4000)) % language_id.CENTROIDS, language_id.CENTROIDS
    for _ in range(language_id.ROUNDS):
        sums = np.array([[vectors[(langs == x) & (cluster == k)].sum(0) for k in range(n)] for x in range(3)])
        sums = np.where(sums.any(-1, keepdims=True), sums, sums.sum(1, keepdims=True))
        centroids = sums / np.linalg.norm(sums, axis=-1, keepdims=True)
        cluster = np.array([(centroids[x] @ v).argmax() for x, v in zip(langs, vectors)])
    assert model.languages == names and np.allclose(model.idf, idf, atol=1e-5) and np.allclose(model.centroids, centroids, atol=1e-4)
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    cosines = (vectors @ centroids.reshape(3 * n, -1).T).reshape(len(texts), 3, n).max(-1)
    for r in language_id.predict(asked, model).collect():
        assert r.lang_pred == names[cosines[r.id].argmax()] and abs(r.score - cosines[r.id].max()) < 1e-4 and not r.rejected
    assert (model.floors > 0).any() and (model.floors <= language_id.REJECT_SHARE).all()


def test_mix(spark, odd):
    sized = mixing.mix(odd, common.word_count(F.col("text")))
    rows = sized.collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    kept = mixing.mixed_rows(sized)
    assert kept.columns == odd.columns and kept.count() >= 0
    assert mixing.mix(odd.limit(0), common.word_count(F.col("text"))).count() == 0
    parties = spark.createDataFrame([("a", 53.0), ("b", 24.0), ("c", 23.0), ("d", 0.0)], "party string, votes double")
    for n in (0, 1, 7, 100):
        got = {r.party: r.seats for r in mixing.sainte_lague(parties, [], "party", F.col("votes"), F.lit(n)).collect()}
        quotients = sorted(((-v / (2 * k - 1), p) for p, v in parties.collect() for k in range(1, n + 1)))[:n]
        assert {p: got.get(p, 0) for p in "abcd"} == {p: sum(q[1] == p for q in quotients) for p in "abcd"}


def test_seats_of_many_parties(spark):
    """One group with most parties, equal votes, a party far larger than the rest and parties without votes."""
    draw = random.Random(5)
    votes = {0: [draw.choice((0, 7, 7, 900, 1000 + draw.randrange(50))) for _ in range(3000)] + [10**6], 1: [4, 4, 4], 2: [5]}
    seats = {0: 7001, 1: 2, 2: 0}
    rows = [(g, i, float(v), seats[g]) for g, group in votes.items() for i, v in enumerate(group)]
    parties = spark.createDataFrame(rows, "g int, party int, votes double, seats long").repartition(5)
    found = mixing.sainte_lague(parties, ["g"], "party", F.col("votes"), F.col("seats")).collect()
    got = {(r.g, r.party): r.seats for r in found}
    assert len(got) == len(found) == len(rows)
    for g, group in votes.items():
        ranked = sorted((-v / (2 * k - 1), i, k) for i, v in enumerate(group) for k in range(1, seats[g] + 1) if v / (2 * k - 1) > 100 or k < 12)
        won = ranked[: seats[g]]
        assert all(got[g, i] == sum(w[1] == i for w in won) for i in set(w[1] for w in won) | set(range(len(group))[:200]))
        assert sum(n for (h, _), n in got.items() if h == g) == seats[g]
    assert mixing.sainte_lague(parties.limit(0), ["g"], "party", F.col("votes"), F.col("seats")).count() == 0


def test_chats(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (3, 5, "user", "hi"), (3, 9, "assistant", "yes"),
        (3, 12, "user", "more"), (4, 0, "user", None), (5, 0, "user", ""), (6, 0, None, "hi"), (7, 0, "user", "hi"), (7, 0, "user", "hi"),
        (None, 0, "user", "lost"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("h1", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.n_copies) for r in chat.format_chats(frame).collect()}
    assert got == {3: (3, 1), 4: (1, 1), 5: (1, 1), 6: (1, 1), 7: (2, 1), None: (1, 1)}
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_pipeline_against_plain_python(spark, sf_dir):
    import corpus_pipeline

    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = table.collect()
    step = table
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = step
        step = workspace.materialize(stage(spark, before, sf_dir), f"stage-{k}")
        if k < 4:
            assert step.columns == table.columns
        if k == 0:
            assert step.count() == len(rows)  # all have letters and are near their language
        elif k == 1:
            last = {r.text: r.doc_id for r in sorted(before.collect(), key=lambda r: r.doc_id)}
            assert sorted(r.doc_id for r in step.collect()) == sorted(last.values())
        elif k == 2:
            sets = {r.doc_id: shingles(r.text) for r in before.collect()}
            want = groups(sets, near_links(sets))
            assert sorted(r.doc_id for r in step.collect()) == sorted(i for i, c in want.items() if i == c)
        elif k == 3:
            copies = {r.row.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mix(before, common.word_count(F.col("text"))).collect()}
            assert sorted(r.doc_id for r in step.collect()) == sorted(i for i, n in copies.items() for _ in range(n))
        else:
            assert step.count() == before.count() and step.columns == ["doc_id", "n_tokens", "ids"]
            get = sentencepiece_dropout.Pieces.of(PIECES).bytes_of.__getitem__
            texts = {r.doc_id: r.text for r in before.collect()}
            assert all(b"".join(map(get, r.ids))[1:].decode() == texts[r.doc_id] for r in step.collect())


def test_pipeline_on_odd_rows(spark, odd):
    import corpus_pipeline

    step = odd
    for _, stage in corpus_pipeline.STAGES:
        step = workspace.materialize(stage(spark, step, ""), "odd-stage")
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = workspace.materialize(stage(spark, empty, ""), "empty-stage")
    assert empty.count() == 0


@pytest.mark.parametrize("block", [256, 7])
def test_near_duplicates_of_families(spark, monkeypatch, block):
    """Families whose members are near each other's bound: links across groups, in blocks and whole, as by brute force."""
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    draw = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    rows, number = [], 0
    for size, changes in ((60, 9), (40, 5), (30, 14), (25, 3)):
        text = [draw.choice(words) for _ in range(300)]
        for _ in range(size):
            own = list(text)
            for k in draw.sample(range(300), draw.randint(1, changes)):
                own[k] = draw.choice(words)
            rows.append((number, " ".join(own)))
            number += 1
    sets = {i: frozenset(zip(*[t.split()[k:] for k in range(5)])) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    low = {i: i for i in sets}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            break
    assert 10 < len(set(low.values())) < 150
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in hyperminhash.NearDuplicates(docs).report().collect()}
    assert got == low


def test_rows_across_groups_grow_with_members(spark, monkeypatch):
    """A family of which no two are similar enough: rows between the tasks grow as its members, not as their pairs."""
    counts, whole = {}, workspace.materialize

    def counted(df, name):
        out = whole(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(hyperminhash.workspace, "materialize", counted)
    rows = {}
    for n in (150, 600):
        draw, counts = random.Random(n), {}
        text = [f"w{draw.randrange(4000)}" for _ in range(400)]
        texts = []
        for i in range(n):
            own = list(text)
            for k in draw.sample(range(400), 9):
                own[k] = f"x{draw.randrange(10**9)}"
            texts.append((i, " ".join(own)))
        hyperminhash.NearDuplicates(spark.createDataFrame(texts, "doc_id long, text string"))
        rows[n] = counts
    for name in ("open-members", "likely-members", "star-pairs", "linked-groups"):
        assert rows[600][name] <= 8 * max(rows[150][name], 100), (name, rows)


def test_clashing_names(spark, odd):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.standard_normal(8).tolist(), i % 2, 1, 2) for i in range(20)]
    frame = spark.createDataFrame(vectors + [(20, vectors[0][1], 0, 1, 2)], "id long, vector array<double>, label_key int, key int, block int")
    rows = embedding_dedup.near_duplicates(frame, id_col="id", vector_col="vector", label_col="label_key").collect()
    assert {r.id: r.component_id for r in rows} == {i: i % 20 for i in range(21)}
    named = odd.withColumns({"__segment_key": F.lit("mine"), "kept_id": F.lit("too")})
    encoded = sentencepiece_dropout.encode(named, PIECES, dropout=0.0)
    assert {r["__segment_key"] for r in encoded.collect()} == {"mine"} and encoded.columns == [c for c in named.columns if c != "ids"] + ["ids"]
    import corpus_pipeline

    assert corpus_pipeline.drop_near_copies(spark, named, "").columns == named.columns
    assert set(exact_dedup.ExactDedup(named.withColumns({"gid": F.lit(1), "at": F.lit(2), "rest": F.lit(3), "text_sha256": F.lit("s")})).kept().columns) > set(named.columns)


def test_exact_dedup_keeps_little_of_many_rows():
    """What the table keeps of a row is bounded: rows of a hot content leave as they come."""
    held = []

    def joined(best, item):
        best.add(1, item, item)

    for content, best, item in exact_dedup.grace_fold(((b"hot" if i % 3 else str(i).encode(), i) for i in range(30_000)), lambda i: exact_dedup.Best(i, 1, i, i), joined, 50_000):
        if content is not None:
            held.append((content, best.n, best.id, best.gids))
    assert len(held) == 10_001 and next(h for h in held if h[0] == b"hot")[1:3] == (20_000, 29_999)
    assert all(len(h[3]) == 1 for h in held)


def test_decoding_holds_few_texts_at_once():
    import tracemalloc

    pieces = sentencepiece_dropout.Pieces.of(PIECES)
    plain = [i for p, i in pieces.id_of.items() if p.isascii() and p.startswith(" ")]
    ids = np.resize(np.array(plain), 1_500_000)
    counts = np.full(3000, 500)
    tracemalloc.start()
    texts = pieces.texts(ids, counts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(texts) == 3000 and texts[7] == b"".join(pieces.bytes_of[i] for i in ids[3500:4000])[1:].decode()
    assert most < 60 << 20


def anonymous_mb() -> float:
    with open("/proc/self/status") as f:
        return int(next(x for x in f if x.startswith("RssAnon")).split()[1]) / 1024


@pytest.mark.skipif(not os.path.exists("/proc/self/status") or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="needs Linux with glibc")
@pytest.mark.parametrize("which, most", [("sketch", 25), ("encode", 90)])
def test_workers_give_memory_back(spark, monkeypatch, which, most):
    """What a task's function has freed is the system's again when its rows end: workers stay, beside the executor's heap."""
    frame, caught = spark.createDataFrame([(1, "a")], "doc_id long, text string"), []
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, *rest: caught.append(run) or self)
    if which == "sketch":
        hyperminhash.sketch(frame, "doc_id", "text")
    else:
        sentencepiece_dropout.encode(frame, PIECES)
    random.seed(2)

    def batches(n):
        for i in range(n):
            texts = [" ".join(f"{random.getrandbits(32):x}" for _ in range(400)) for _ in range(400)]
            ids = pa.array(range(400 * i, 400 * i + 400), pa.int64())
            key = [ids] if which == "encode" else []
            yield pa.RecordBatch.from_arrays([ids, pa.array(texts), *key], names=["doc_id", "text", "__segment_key"][: 2 + len(key)])

    for n in (1, 4):  # the first loads what stays
        for _ in caught[0](batches(n)):
            pass
        del _
        gc.collect()
        if n == 1:
            pa.default_memory_pool().release_unused()
            ctypes.CDLL(None).malloc_trim(0)
            before = anonymous_mb()
    assert anonymous_mb() - before < most


def test_language_takes_few_texts_at_once():
    import tracemalloc

    model = language_id.LanguageModel(["a"], np.ones(language_id.BUCKETS, np.float32), np.ones((1, language_id.CENTROIDS, language_id.BUCKETS), np.float32), np.zeros(language_id.LENGTH_BINS))
    texts = ["word and word " * 250] * 512
    language_id.letters_table()
    tracemalloc.start()
    names, scores, _ = model.predict(texts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert names == ["a"] * 512 and len(set(scores)) == 1
    assert most < 40 << 20


def test_ids_do_not_depend_on_texts_at_once(spark, odd):
    encoded = [
        sorted(map(str, sentencepiece_dropout.encode(odd.select("doc_id", "text"), PIECES, **some).collect())) for some in ({}, {"at_once": 1}, {"at_once": common.SMALL_BYTES})
    ]
    assert encoded[0] == encoded[1] == encoded[2]

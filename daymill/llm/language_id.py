"""Language identification by the nearest of several clustered centroids per language."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from daymill import workspace
from daymill.llm.common import SMALL_BYTES, bound_batches, lean
from daymill.llm.sampling import labelled_sample

BUCKETS = 1 << 13  # of hashed n-grams
GRAMS = (1, 2, 3)
CENTROIDS = 4  # per language
ROUNDS = 4
SAMPLE_PER_LANGUAGE = 4000  # labelled documents to fit on, at most, about
SAMPLE_TASKS = 16
SLOTS = 64  # sums of centroids that leave a task at once, 4 MB
# A text is rejected when its cosine with every centroid is below this share of what all but a few training texts of its
# length reach: two in a thousand, none where there are fewer.
REJECT_SHARE, REJECT_QUANTILE = 0.5, 0.002
LENGTH_BINS = 24  # by powers of two of the number of letters
GROUP_DOCS, GROUP_CHARS = 64, 1 << 19  # at once: a text takes 64 KB for each array of counts, a character some 100 bytes

UNKNOWN = "und"
_LETTERS = None


def letters_table() -> np.ndarray:
    """Whether a code point is a letter (Unicode category L)."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(counts of hashed character n-grams per text, number of letters per text). Texts are lower-cased, whole; what
    lies between letters counts as one blank."""
    counts = np.zeros((len(texts), BUCKETS), np.float32)
    letters = np.zeros(len(texts), np.int64)
    table = letters_table()
    codes = [np.frombuffer((" " + (t or "").lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    flat = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    is_letter = table[flat]
    if not len(flat):
        return counts, letters
    # Of what is no letter, the first of each run stays, and every text has a blank before it wherever it lies in the list.
    keep = is_letter | np.concatenate([[True], is_letter[:-1]]) | np.concatenate([[True], doc[1:] != doc[:-1]])
    flat, doc, is_letter = np.where(is_letter, flat, 32)[keep].astype(np.uint64), doc[keep], is_letter[keep]
    letters += np.bincount(doc[is_letter], minlength=len(texts))
    total = counts.ravel()
    mixed = np.zeros_like(flat)
    for n in range(1, max(GRAMS) + 1):
        end = len(flat) - n + 1
        if end <= 0:
            break
        mixed = (mixed[:end] * np.uint64(0x100000001B3)) ^ flat[n - 1 :]
        if n not in GRAMS:
            continue
        hashed = ((mixed + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)
        inside = doc[:end] == doc[n - 1 :]
        if n == 1:
            inside &= is_letter
        at = doc[:end][inside] * BUCKETS + hashed[inside].astype(np.int64)
        total += np.bincount(at, minlength=total.size).astype(np.float32)
    return counts, letters


def grouped(texts: list[str | None]):
    """Runs of consecutive texts of bounded number and size: (first, last + 1)."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and (i - start >= GROUP_DOCS or chars + size > GROUP_CHARS):
            yield start, i
            start, chars = i, 0
        chars += size
    if start < len(texts):
        yield start, len(texts)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(-1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # languages x CENTROIDS x BUCKETS, unit length
    floors: np.ndarray  # by length bin: cosine below which a text is rejected

    def vectors(self, texts) -> tuple[np.ndarray, np.ndarray]:
        counts, letters = gram_counts(texts)
        return _unit(np.log1p(counts) * self.idf), letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine with its nearest centroid, rejected)."""
        names, scores, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for a, b in grouped(texts):
            vectors, letters = self.vectors(texts[a:b])
            if not self.languages:
                names += [UNKNOWN] * (b - a)
                continue
            cosines = vectors @ self.centroids.reshape(-1, BUCKETS).T
            best = cosines.argmax(1)
            top = np.clip(cosines[np.arange(b - a), best].astype(float), 0, 1)
            names += [self.languages[k // CENTROIDS] if n else UNKNOWN for k, n in zip(best.tolist(), letters.tolist())]
            scores[a:b] = np.where(letters > 0, top, 0)
            rejected[a:b] = (letters == 0) | (top < self.floors[length_bin(letters)])
        return names, scores, rejected


def length_bin(letters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(letters, 1)).astype(int), LENGTH_BINS - 1)


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Document frequencies, then spherical k-means within each language, then distances by length.

    Fitted on a sample of about `per_language` labelled texts per language. Each pass is one job: tasks sum by row of
    the result (centroid, or length bin), rows are added up in the cluster, and the driver gets each row once, which is
    the model's own size. Rows without language or letters do not count; without any row the model knows no language.
    """
    bound_batches(labelled.sparkSession, SMALL_BYTES)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang is not null and text is not null")
    sample = labelled_sample(rows, "lang", per_language).dropDuplicates(["lang", "text"]).repartition(SAMPLE_TASKS)
    sample = workspace.materialize(sample, "language-sample").coalesce(SAMPLE_TASKS)
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], np.ones(BUCKETS, np.float32), np.zeros((0, CENTROIDS, BUCKETS), np.float32), np.zeros(LENGTH_BINS))
    number = {name: i for i, name in enumerate(languages)}
    size = len(languages) * CENTROIDS

    def passes(job, shape):
        """Sum over tasks of what `job` adds for (texts, language numbers) to an array of this shape."""

        def run(batches):
            total = np.zeros(shape)
            for batch in batches:
                texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
                for a, b in grouped(texts):
                    job(total, texts[a:b], np.array([number[x] for x in langs[a:b]]))
            used = np.flatnonzero(total.any(1))
            for slots in (used[k : k + SLOTS] for k in range(0, len(used), SLOTS)):
                sums = pa.array([total[k].astype("<f8").tobytes() for k in slots], pa.binary())
                task = pa.array([TaskContext.get().partitionId()] * len(slots), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), task, sums], names=["slot", "task", "sums"])

        def add(rows):
            total = np.zeros(shape[1])
            for k in np.argsort(rows.column("task").to_numpy()):  # in one order, so that a rerun gives the same
                total += np.frombuffer(rows.column("sums")[int(k)].as_py(), "<f8")
            return pa.table({"slot": rows.column("slot").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

        total = np.zeros(shape)
        parts = sample.select("text", "lang").mapInArrow(lean(run), "slot int, task int, sums binary")
        for row in parts.groupBy("slot").applyInArrow(add, "slot int, sums binary").collect():
            total[row.slot] = np.frombuffer(bytes(row.sums), "<f8")
        return total

    def frequencies(total, texts, _):
        counts, letters = gram_counts(texts)
        total[0, :BUCKETS] += (counts > 0).sum(0)
        total[0, BUCKETS] += (letters > 0).sum()

    found = passes(frequencies, (1, BUCKETS + 1))[0]
    idf = np.log((1 + found[-1]) / (1 + found[:-1])).astype(np.float32) + 1
    model = LanguageModel(languages, idf, np.zeros((len(languages), CENTROIDS, BUCKETS), np.float32), np.zeros(LENGTH_BINS))

    def assign(total, texts, langs):
        vectors, letters = model.vectors(texts)
        if model.centroids.any():
            cosines = (vectors @ model.centroids.reshape(-1, BUCKETS).T).reshape(len(vectors), -1, CENTROIDS)
            cluster = cosines[np.arange(len(langs)), langs].argmax(1)
        else:  # at first by length, which differs most among texts of one language
            cluster = np.digitize(letters, (250, 1000, 4000)) % CENTROIDS
        slot = langs * CENTROIDS + cluster
        for k in np.unique(slot):
            total[k] += vectors[slot == k].sum(0)

    for _ in range(ROUNDS):
        sums = passes(assign, (size, BUCKETS)).reshape(len(languages), CENTROIDS, BUCKETS)
        # A cluster without texts takes the language's mean.
        empty = ~sums.any(-1)
        sums[empty] = np.broadcast_to(sums.sum(1, keepdims=True), sums.shape)[empty]
        model.centroids = _unit(sums).astype(np.float32)

    steps = 200

    def distances(total, texts, langs):
        vectors, letters = model.vectors(texts)
        top = (vectors @ model.centroids.reshape(-1, BUCKETS).T).max(1)
        some = letters > 0
        np.add.at(total, (length_bin(letters[some]), np.minimum((top[some] * steps).astype(int), steps - 1)), 1)

    seen = passes(distances, (LENGTH_BINS, steps))
    floor, last = np.zeros(LENGTH_BINS), 0.0
    for k in range(LENGTH_BINS):  # a longer text is nearer; bins with few texts take the bound of the one before
        if seen[k].sum() >= 50:
            last = float(np.searchsorted(np.cumsum(seen[k]), REJECT_QUANTILE * seen[k].sum(), side="right") / steps)
        floor[k] = REJECT_SHARE * last
    model.floors = floor
    return model


def predict(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred, score (cosine, 0 to 1) and rejected. Null texts and texts without a letter are
    `und`, score 0, rejected. Columns of these names are replaced. A model's size depends on languages and buckets only."""
    bound_batches(docs.sparkSession, SMALL_BYTES)
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    docs = docs.drop(*[f.name for f in added])
    schema = StructType([*docs.schema.fields, *added])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores, rejected = shared.value.predict(batch.column(text_col).to_pylist())
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(lean(run), schema)

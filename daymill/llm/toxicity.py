"""Toxicity by a weighted finite-state grammar over clauses, its weights learned from labels."""

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from daymill import workspace
from daymill.llm.common import bound_batches
from daymill.llm.sampling import labelled_sample, once

SAMPLE_PER_CLASS = 30_000  # labelled texts to fit contexts and the curve on, at most, about
HELD_FORMS = 200_000  # forms that a task counts before it hands them on, about
SAMPLE_TASKS = 16
STEMS = (4, 5, 6)  # lengths of word beginnings that may be insults in whatever form they take
LEAST_TEXTS = 3  # toxic texts that hold an insult, at least
LEAST_ODDS = 2.0  # natural logarithm
REACH = 3  # words after a negation that it covers
BINS, BIN_WIDTH = 128, 0.1  # of either feature

# Closed word classes of the grammar, in English, German, French and Spanish.
TARGETS = frozenset("you your yours yourself they them he she dich dir euch ihr du deine dein toi tu vous tes ton votre tú te ti usted ustedes vosotros".split())
NEGATIONS = frozenset("not no never none nobody isn aren wasn don doesn nicht kein keine keinen nie niemals pas jamais aucun aucune nunca jamás ningún ninguna".split())
REPORTS = frozenset("said says say wrote writes claimed claims quoted called sagte sagt schrieb behauptete nannte dit disait écrit affirme dijo dice escribió afirmó llamó".split())
INTENTS = frozenset("will gonna going shall werde werden wirst vais va allons voy vas vamos".split())
HARMS = frozenset("kill hurt destroy beat stab shoot töten verletzen vernichten schlagen tuer frapper détruire matar herir golpear destruir".split())
THREAT_WEIGHT = 4.0
# How a context scales what it surrounds before labels say otherwise: negated, reported, aimed at someone.
PRIOR = {"negated": 0.5, "reported": 0.5, "targeted": 1.2}
PRIOR_TEXTS = 5.0

WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n\"“”„«»]")
STOPS = frozenset(".!?;:\n")
QUOTES = frozenset('"“”„«»')


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine over token tags: start state, and the step to (next state, output or None)."""

    start: object
    step: Callable


def compose(*machines: Transducer) -> Transducer:
    """All machines on the same tags: the state is the tuple of theirs, the output that of the machine that has one.
    States are made as they are met and kept in a table."""
    table: dict = {}

    def step(state, tag):
        key = (state, tag)
        if key not in table:
            moves = [m.step(s, tag) for m, s in zip(machines, state)]
            table[key] = (tuple(m[0] for m in moves), next((m[1] for m in moves if m[1]), None))
        return table[key]

    return Transducer(tuple(m.start for m in machines), step)


# Each machine reads tags: insult, target, negation, report, intent, harm, quote, word.
INSULT = Transducer(None, lambda s, tag: (None, "insult" if tag == "insult" else None))
# An intent, up to REACH words, then harm.
THREAT = Transducer(0, lambda s, tag: (0, "threat") if tag == "harm" and s else (REACH if tag == "intent" else max(0, s - 1), None))
TARGET = Transducer(False, lambda s, tag: (s or tag == "target", None))
NEGATION = Transducer(0, lambda s, tag: (REACH if tag == "negation" else max(0, s - 1), None))
# Speech is reported after a verb of saying, or inside quotation marks.
REPORT = Transducer((False, False), lambda s, tag: ((s[0] or tag == "report", s[1] ^ (tag == "quote")), None))
GRAMMAR = compose(INSULT, THREAT, TARGET, NEGATION, REPORT)


@dataclass
class ToxicityModel:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    factors: dict[tuple, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (0.0, 0.0, -2.0)  # by feature, and the offset

    def weight(self, word: str) -> float:
        """The most telling of the word and its beginnings; 0 for no insult."""
        best = self.words.get(word, 0.0)
        for n in STEMS:
            if len(word) > n:
                best = max(best, self.stems.get(word[:n], 0.0))
        return best

    def matches(self, text: str | None) -> Iterator[tuple[float, tuple]]:
        """(weight, (negated, reported, targeted)) of each match, clause by clause."""
        if not text:
            return
        tokens = TOKEN.findall(text.lower())
        known = {w: x for w in set(tokens) if (x := self.weight(w))}
        if not known and HARMS.isdisjoint(tokens):
            return
        state, found, quoted = GRAMMAR.start, [], False
        for token in [*tokens, "\n"]:
            if token in STOPS:
                targeted = state[2]
                yield from ((w, (negated, reported, targeted)) for w, negated, reported in found)
                # A clause begins anew, but a quotation goes on.
                state, found = (*GRAMMAR.start[:4], (False, quoted)), []
                continue
            tag = (
                "insult" if token in known else "quote" if token in QUOTES else "target" if token in TARGETS
                else "negation" if token in NEGATIONS else "report" if token in REPORTS
                else "intent" if token in INTENTS else "harm" if token in HARMS else "word"
            )
            before = state
            state, out = GRAMMAR.step(state, tag)
            quoted = state[4][1]
            if out:
                weight = known[token] if out == "insult" else THREAT_WEIGHT
                found.append((weight, before[3] > 0, any(before[4])))

    def features(self, text: str | None) -> tuple[float, float]:
        """What the matched clauses weigh together, as a logarithm, and the weight of the strongest match. Of equal
        matches (same weight and context) the k-th counts one k-th, so that repeated lines do not add up."""
        counts = Counter(self.matches(text))
        weights = {m: m[0] * self.factors.get(m[1], 1.0) for m in counts}
        total = sum(weights[m] * sum(1 / k for k in range(1, n + 1)) for m, n in counts.items())
        return math.log1p(total), max(weights.values(), default=0.0)

    def score(self, text: str | None) -> float:
        x = sum(a * b for a, b in zip(self.curve, (*self.features(text), 1.0)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def learn_lexicon(texts: DataFrame) -> tuple[dict[str, float], dict[str, float], tuple[int, int]]:
    """Words and beginnings of words that are telling: their log odds, where the likelihood ratio against chance
    beats the number of candidates tried; and the number of clean and of toxic texts. Counted once per text, over all
    of them, in tables that a task hands on when they reach HELD_FORMS; the telling ones reach the driver."""
    counted = texts.select("text", "toxic").mapInArrow(_count_forms, "form string, pos long, n long")
    counted = counted.groupBy("form").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    # The empty form stands for all texts.
    counted = workspace.materialize(counted.filter((F.col("pos") >= LEAST_TEXTS) | (F.col("form") == "")), "insult-candidates")
    totals = counted.filter("form = ''").first()
    pos, n = (totals.pos, totals.n) if totals else (0, 0)
    if not pos or pos == n:
        return {}, {}, (n - pos, pos)
    counted = counted.filter("form <> ''")
    tried = max(2, counted.count())
    share = pos / n
    neg = F.col("n") - F.col("pos")
    part = lambda k, p: F.when(k > 0, k * F.log(k / (F.col("n") * p))).otherwise(0.0)
    ratio = part(F.col("pos"), share) + part(neg, 1 - share)
    odds = F.log((F.col("pos") + 0.5) / (neg + 0.5) * ((1 - share) / share))
    telling = counted.filter((F.col("pos") > F.col("n") * share) & (ratio > math.log(tried))).select("form", odds.alias("odds"))
    rows = telling.filter(F.col("odds") > LEAST_ODDS).collect()
    return (
        {r.form: r.odds for r in rows if not r.form.endswith("*")},
        {r.form[:-1]: r.odds for r in rows if r.form.endswith("*")},
        (n - pos, pos),
    )


def _count_forms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(form, toxic texts, texts) of words, of beginnings marked by a star, and of the empty form for every text."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(WORD.findall(text.lower()))
            counts[toxic].update(words)
            for k in STEMS:
                counts[toxic].update({w[:k] + "*" for w in words if len(w) > k})
            counts[toxic][""] += 1
        if len(counts[0]) + len(counts[1]) > HELD_FORMS:
            yield _form_batch(counts)
            counts = (Counter(), Counter())
    yield _form_batch(counts)


def _form_batch(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    forms = list(counts[0].keys() | counts[1].keys())
    pos = [counts[1][f] for f in forms]
    n = [counts[0][f] + k for f, k in zip(forms, pos)]
    return pa.RecordBatch.from_arrays([pa.array(forms, pa.string()), pa.array(pos, pa.int64()), pa.array(n, pa.int64())], names=["form", "pos", "n"])


def _prior(context: tuple) -> float:
    return math.prod(PRIOR[k] for k, on in zip(("negated", "reported", "targeted"), context) if on)


def fit(labelled: DataFrame, *, text_col: str = "text", label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Insults from labels, then what each context is worth, then a logistic curve from clause sums to labels.

    Insults are counted over all texts of `labelled`, equal texts once; rows without label or text do not count. Hand in
    a bounded frame (sampling.with_labels), as the model holds the telling forms of its vocabulary. Contexts and curve, a few
    numbers, are fitted on about `per_class` texts of each class, each weighing as many texts of its class as there are for one
    in the sample, so that classes keep their natural rates whatever the bound. Contexts are worth their log odds relative
    to those of all matches, drawn towards PRIOR while few texts show them. The curve is fitted to counts by (bins of both features, label), a table of fixed size.
    """
    bound_batches(labelled.sparkSession)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("toxic"))
    rows = rows.filter("toxic in (0, 1) and text is not null").withColumn("at", F.monotonically_increasing_id())
    # Labels and texts meet once; equal texts are told by their digests.
    rows = once(workspace.materialize(rows, "labelled-texts"), ["text", "toxic"])
    words, stems, totals = learn_lexicon(rows)
    sample = labelled_sample(rows, "toxic", per_class).select("toxic", "text").repartition(SAMPLE_TASKS)
    sample = workspace.materialize(sample, "toxicity-sample")
    model = ToxicityModel(words, stems)

    def contexts(batches):
        found: dict = {}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                kinds = {c for _, c in model.matches(text)}
                for c in [*kinds, *(["any"] if kinds else []), "text"]:
                    found.setdefault(str(c), [0, 0])[toxic] += 1
        keys = sorted(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([found[k][0] for k in keys], pa.int64()), pa.array([found[k][1] for k in keys], pa.int64())],
            names=["context", "neg", "pos"],
        )

    counted = sample.select("text", "toxic").mapInArrow(contexts, "context string, neg long, pos long")
    by = {r.context: (r.neg, r.pos) for r in counted.groupBy("context").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).collect()}
    if "text" not in by:
        return ToxicityModel()
    weights = [total / max(1, n) for total, n in zip(totals, by["text"])]
    shown_by = {k: sum(v) for k, v in by.items()}
    by = {k: (v[0] * weights[0], v[1] * weights[1]) for k, v in by.items()}
    base = (by["text"][0] + 1) / (by["text"][1] + 1)
    odds = lambda k: max(0.1, math.log((by[k][1] + 1) / (by[k][0] + 1) * base))
    for context in [(a, b, c) for a in (False, True) for b in (False, True) for c in (False, True)]:
        seen = sum(by.get(str(context), (0, 0)))
        # Few texts cannot show high odds: a context is compared with what as many texts of the usual purity would.
        if seen:
            usual = (by["any"][1] / max(1, sum(by["any"]))) * seen
            likely = max(0.1, math.log((usual + 1) / (seen - usual + 1) * base))
            shown = min(1.5, odds(str(context)) / likely)
        else:
            shown = 1.0
        # The prior gives way to texts that were read, not to what they weigh.
        read = shown_by.get(str(context), 0)
        part = read / (read + PRIOR_TEXTS)
        model.factors[context] = part * shown + (1 - part) * _prior(context)

    def sums(batches):
        counts = np.zeros((BINS, BINS, 2), np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                a, b = (min(BINS - 1, round(x / BIN_WIDTH)) for x in model.features(text))
                counts[a, b, toxic] += 1
        at = np.argwhere(counts)
        columns = [pa.array(at[:, k], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts[tuple(at.T)], pa.int64())], names=["a", "b", "toxic", "n"])

    binned = sample.select("text", "toxic").mapInArrow(sums, "a long, b long, toxic long, n long")
    rows = binned.groupBy("a", "b", "toxic").agg(F.sum("n").alias("n")).collect()
    model.curve = _logistic([(r.a * BIN_WIDTH, r.b * BIN_WIDTH, r.toxic, r.n * weights[r.toxic]) for r in rows])
    return model


def _logistic(points: Iterable[tuple]) -> tuple[float, ...]:
    """Weights of both features and the offset by Newton's method, with a small prior against infinite ones. Steps are
    halved until the loss falls, as whole ones swing from side to side where one class is rare."""
    a, b, y, n = (np.array(v, float) for v in zip(*points))
    design, w = np.stack([a, b, np.ones_like(a)], 1), np.zeros(3)
    loss = lambda w: n @ (np.logaddexp(0, design @ w) - y * (design @ w)) + 0.025 * w @ w
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (n * (p - y)) + 0.05 * w
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(3)
        step, now = np.linalg.solve(hessian, gradient), loss(w)
        while np.abs(step).max() > 1e-9 and loss(w - step) > now:
            step /= 2
        if np.abs(step).max() <= 1e-9:
            break
        w -= step
    return tuple(float(v) for v in w)


def score(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from 0.5 on). Whole texts; null and empty ones match nothing and get
    the score of a text without matches. Columns of these names are replaced. The model holds the telling forms of the
    labels' vocabulary."""
    bound_batches(docs.sparkSession)
    added = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    docs = docs.drop(*[f.name for f in added])
    schema = StructType([*docs.schema.fields, *added])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(t) for t in batch.column(text_col).to_pylist()]
            columns = [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)

"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, report, other). Small transducers read the symbols of a clause:
one marks insults and threats, one what stands shortly after a negation, one what is reported speech, one what is aimed
at a person before or after it. Composed into one machine they mark every matched clause, and the marks with the weights of
the words give the features of a text. The weakest pattern is a clause with an insult that is aimed at nobody; its weight is fitted
to the labels like the others' (in the given tables most toxic texts hold no other pattern, their words make no sentences). A threat
that is aimed at nobody, and words of no pattern, add nothing.

The lexicon starts from fixed word lists and learns more words and word beginnings from labels; the weights of the
patterns start from fixed ones and are fitted to the labels. Both use a bounded sample (about ``ROWS`` rows of each label,
chosen by a hash) of rows that are not held out. Label, language, source and id are no inputs of a score.

Defined cases: null and empty texts match nothing and get the score of no match; repeated rows get equal scores.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .frames import held_out, stored, texts

ROWS = 3000
# Learned words and word beginnings that a model holds at most, those with the most evidence.
LEXICON = 4000
# Strength that a pattern adds to a text at most, so that a long text of many weak matches is no surer than one of a few.
MOST = 3.0
STEMS = range(4, 9)

# Word lists of the grammar, for English, German, French and Spanish.
INSULTS = """idiot idiots moron morons loser losers scum trash clown stupid pathetic worthless disgusting imbecile dumbass
jerk bastard vermin filth fool freak creep pig dummkopf arschloch idioten trottel abschaum versager widerlich connard
salaud imbécile crétin ordure minable idiote idiota imbécil estúpido estúpida basura payaso asqueroso inútil"""
THREATS = """kill murder hurt destroy beat shoot stab strangle burn hang töten umbringen erschießen verprügeln tuer
frapper détruire étrangler matar golpear destruir quemar"""
TARGETS = """you your yourself yours u ur du dich dir dein deine ihr euch tu te toi ton vous votre tú ti usted ustedes vuestro"""
NEGATIONS = """not no never isn aren wasn don doesn nobody nicht kein keine nie niemals pas jamais aucun nunca jamás tampoco"""
REPORTS = """said says told wrote claimed quoted called reported alleged sagte schrieb behauptete angeblich dit écrit
prétend dijo escribió afirmó supuestamente"""
# Where the fit starts: no match, insult, aimed insult, negated, reported, aimed threat.
PRIOR = (-3.0, 4.0, 1.0, 0.5, 1.0, 4.0)
SEED = 4.0

TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
WORD = re.compile(r"[^\W\d_]+")
ALPHABET = "ITGNRO"
INSULT, THREAT, NEGATED, REPORTED, AIMED, AIMED_AFTER = (1 << k for k in range(6))


class Transducer:
    """Arcs (state, symbol) -> (next state, marks)."""

    def __init__(self, arcs: dict):
        self.arcs = arcs

    def compose(self, other: Transducer) -> Transducer:
        """Both machines on the same symbols; marks add up. Only states that are reached are built."""
        arcs, todo, seen = {}, [(0, 0)], {(0, 0): 0}
        while todo:
            pair = todo.pop()
            for s in ALPHABET:
                (a, m), (b, n) = self.arcs[pair[0], s], other.arcs[pair[1], s]
                if (a, b) not in seen:
                    seen[a, b] = len(seen)
                    todo.append((a, b))
                arcs[seen[pair], s] = (seen[a, b], m | n)
        return Transducer(arcs)


def marker() -> Transducer:
    """Marks the words that carry an insult or a threat."""
    return Transducer({(0, s): (0, {"I": INSULT, "T": THREAT}.get(s, 0)) for s in ALPHABET})


def scope(opener: str, reach: int, mark: int) -> Transducer:
    """Marks insults and threats at most ``reach`` words after the opener."""
    arcs = {}
    for left, s in itertools.product(range(reach + 1), ALPHABET):
        arcs[left, s] = (reach if s == opener else max(left - 1, 0), mark if left and s in "IT" else 0)
    return Transducer(arcs)


def aimed_after(reach: int) -> Transducer:
    """Marks a target at most ``reach`` words after an insult or threat."""
    arcs = {}
    for left, s in itertools.product(range(reach + 1), ALPHABET):
        arcs[left, s] = (reach if s in "IT" else 0 if s == "G" else max(left - 1, 0), AIMED_AFTER if left and s == "G" else 0)
    return Transducer(arcs)


def grammar() -> Transducer:
    out = marker()
    for part in (scope("N", 3, NEGATED), scope("R", 6, REPORTED), scope("G", 4, AIMED), aimed_after(3)):
        out = out.compose(part)
    return out


@dataclass
class Model:
    lexicon: dict[str, float]  # words and word beginnings (those end with *) of insults
    weights: list[float]

    def reader(self) -> Reader:
        return Reader(self.lexicon)


class Reader:
    """Turns a text into pattern features; made once in each task."""

    def __init__(self, lexicon: dict[str, float]):
        self.arcs = grammar().arcs
        self.fixed = {w: ("I", SEED) for w in INSULTS.split()} | {w: ("T", SEED) for w in THREATS.split()}
        for s, words in (("G", TARGETS), ("N", NEGATIONS), ("R", REPORTS)):
            self.fixed |= {w: (s, 0.0) for w in words.split()}
        self.lexicon = lexicon
        self.seen: dict[str, tuple[str, float]] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        got = self.seen.get(word)
        if got is None:
            learned = max([self.lexicon.get(word, 0.0), *(self.lexicon.get(word[:n] + "*", 0.0) for n in STEMS)])
            s, w = self.fixed.get(word, ("O", 0.0))
            got = ("I", max(learned, w)) if learned and s in "IO" else (s, w)
            if len(self.seen) > 200_000:
                self.seen.clear()
            self.seen[word] = got
        return got

    def __call__(self, text: str | None) -> list[float]:
        """Insult, aimed insult, negated, reported, aimed threat; zero without a match."""
        low = (text or "").lower()
        out = [0.0] * 5
        if not any(self.symbol(w)[0] in "IT" for w in set(WORD.findall(low))):
            return out
        state, clause = 0, []
        for token in itertools.chain(TOKEN.findall(low), "."):
            if token in ".!?;:\n":
                if any(m & (INSULT | THREAT) for m, _ in clause):
                    self.add(clause, out)
                state, clause = 0, []
            else:
                s, weight = self.symbol(token)
                state, mark = self.arcs[state, s]
                if mark:
                    clause.append((mark, weight))
        return [min(x, MOST) for x in out]

    @staticmethod
    def add(clause: list[tuple[int, float]], out: list[float]) -> None:
        after = any(m & AIMED_AFTER for m, _ in clause)
        for m, weight in clause:
            if not m & (INSULT | THREAT):
                continue
            strength, aimed = weight / SEED, after or m & AIMED
            if m & NEGATED:
                out[2] += strength
            elif m & REPORTED:
                out[3] += strength
            elif m & THREAT:
                out[4] += strength if aimed else 0.0
            else:
                out[0] += strength
                out[1] += strength if aimed else 0.0


def sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, dict[int, int]]:
    """Texts with label, about ``rows`` of each label, and the number of training rows of each label."""
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for label, n in counts.items():
        keep |= (F.col("label") == label) & (share < min(1.0, rows / max(n, 1)))
    chosen = F.broadcast(known.filter(keep))  # about 2 * rows rows of two numbers
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return own.join(chosen, "doc_id").select("label", "text"), counts


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, word or word beginning, and a hash of its neighbours, once for each text."""
    for b in batches:
        for label, text in zip(b.column(0).to_pylist(), texts(b)):
            words = WORD.findall((text or "").lower())
            found: dict[str, int] = {}
            for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                if len(word) < 4 or word in found:
                    continue
                near = zlib.crc32(f"{before} {after}".encode())
                found[word] = near
                for n in STEMS:
                    if n < len(word):
                        found.setdefault(word[:n] + "*", near)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(found), pa.int32()), pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                    names=["label", "word", "near"],
                )


def learn_lexicon(rows: DataFrame, n: dict[int, int], size: int = LEXICON) -> dict[str, float]:
    """Words and word beginnings that mark label 1.

    A word counts once for each different pair of neighbours, so copies of a text count once. Its evidence is the
    likelihood ratio against the share of label 1; it has to exceed what the best of all candidates reaches by chance.
    """
    if not n.get(0) or not n.get(1):
        return {}
    toxic, clean = F.col("label") == 1, F.col("label") == 0
    seen = rows.mapInArrow(_word_rows, "label int, word string, near bigint").groupBy("word", "near")
    seen = seen.agg(F.count_if(toxic).alias("t"), F.count_if(clean).alias("c"))
    per = seen.groupBy("word").agg(F.sum((F.col("t") > 0).cast("long")).alias("t"), F.sum("c").alias("c"))
    base = n[1] / (n[0] + n[1])
    t, c = F.col("t"), F.col("c")
    odds = F.log((t + 0.5) / (n[1] + 1.0) / ((c + 0.5) / (n[0] + 1.0)))
    part = F.when(c > 0, c * F.log(c / (t + c) / (1 - base))).otherwise(0.0)
    per = per.withColumn("odds", odds).withColumn("evidence", t * F.log(t / (t + c) / base) + part)
    found = per.filter((t >= 3) & (F.col("odds") >= 2.5))
    # The number of candidates is that of words seen as often as the rarest that can pass.
    tries = max(1, per.filter((t + c) >= 3).count())
    kept = found.filter(F.col("evidence") >= math.log(tries) + 3.0).orderBy(F.desc("evidence"), "word").limit(size).collect()
    best = {r["word"]: r for r in kept}
    out = {}
    for word, r in best.items():
        # A beginning gives way to a longer form that covers nearly all of it.
        stem = word.rstrip("*")
        longer = [q for q in best if q != word and q.startswith(stem) and word.endswith("*") and best[q]["t"] >= 0.95 * r["t"]]
        if not longer:
            out[word] = float(min(max(r["odds"], 3.0), 6.0))
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", rows: int = ROWS) -> Model:
    known, counts = sample(docs, labels, rows, id_col, text_col, label_col)
    known = stored(known, "toxicity-sample")  # the only scan of the documents
    n = {k: min(v, rows) for k, v in counts.items()}
    lexicon = learn_lexicon(known, n)
    found = known.mapInArrow(_feature_rows(lexicon), "label int, x array<double>").collect()
    if not found:
        return Model(lexicon, list(PRIOR))
    x = np.array([[1.0, *r["x"]] for r in found])
    y = np.array([r["label"] for r in found], dtype=float)
    share = y.mean()
    weights = logistic(x, y)
    if 0 < share < 1 and counts.get(0) and counts.get(1):
        # The sample holds the labels in other shares than the training rows.
        weights[0] += math.log(counts[1] / counts[0]) - math.log(share / (1 - share))
    return Model(lexicon, [float(w) for w in weights])


def _feature_rows(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(lexicon)
        for b in batches:
            x = [read(t) for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, pull: float = 0.5) -> np.ndarray:
    """Maximum a posteriori weights around the fixed ones, by Newton steps."""
    prior = np.array(PRIOR)
    w = prior.copy()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + pull * (w - prior)
        bend = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    # More matches never make a text cleaner.
    return np.concatenate([w[:1], np.maximum(w[1:], 0.0)])


def score_of(features: list[float], weights: list[float]) -> float:
    z = weights[0] + sum(w * x for w, x in zip(weights[1:], features))
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


def scored(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, score and the pattern features of each row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    lexicon, weights = model.lexicon, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(lexicon)
        for b in batches:
            x = [read(t) for t in texts(b)]
            scores = pa.array([score_of(f, weights) for f in x], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), scores, pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "score", "patterns"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, patterns array<double>")


def kept(docs: DataFrame, model: Model, limit: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, all columns as they are."""
    lexicon, weights = model.lexicon, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(lexicon)
        for b in batches:
            yield b.filter(pa.array([score_of(read(t), weights) < limit for t in texts(b, text_col)], pa.bool_()))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))

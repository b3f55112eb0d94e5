"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A small lexicon of insults to start from (fixed values); more words are mined from labelled rows.
SEED_WORDS = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "scum", "trash", "garbage", "loser", "losers", "pathetic",
    "worthless", "disgusting", "clown", "clowns", "fool", "coward", "liar", "filth", "vermin", "hate", "kill", "ugly",
    "dummkopf", "abschaum", "arschloch", "imbécile", "crétin", "connard", "salaud", "estúpido", "imbécil", "basura",
    "asqueroso", "idiota",
)
# Patterns over whole lower-cased texts: name, expression, vote where it is found (fixed values).
PATTERNS = (
    ("addressed", r"\byou(?:'re| are)?\s+(?:all\s+)?(?:idiots?|morons?|stupid|scum|trash|losers?|pathetic)\b", 1),
    ("shut up", r"\bshut\s+up\b", 1),
    ("masked", r"\b\w[*@#$]{2,}\w*\b", 1),
    ("shouted", r"!{3,}", 1),
    ("licence", r"\b(?:licensed under|all rights reserved|cc by)\b", -1),
    ("courtesy", r"\b(?:please|thank you|thanks|gracias|merci|danke)\b", -1),
)
PREFIXES = (4, 5, 6)
_WORD = re.compile(r"\w+")


def word_features(word: str) -> list[str]:
    """A word, and its beginnings as separate features marked by a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


@dataclass
class Model:
    """Weights of word features and patterns, with what the label model estimated."""

    weights: dict[str, float]
    bias: float
    accuracies: dict[str, float] = field(default_factory=dict)
    redundancy: dict[str, float] = field(default_factory=dict)


def is_held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text is divisible by 5. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _features_of(wanted: dict[str, int], patterns):
    """A function from a text to the sorted positions of its features in ``wanted``."""
    compiled = [(wanted[f"/{name}/"], re.compile(rule)) for name, rule, _ in patterns if f"/{name}/" in wanted]
    seen: dict[str, tuple] = {}

    def features(text: str) -> list[int]:
        text = text.lower()
        found: set[int] = set()
        for word in set(_WORD.findall(text)):
            here = seen.get(word)
            if here is None:
                here = tuple(wanted[f] for f in word_features(word) if f in wanted)
                if len(seen) < 300_000:
                    seen[word] = here
            if here:
                found.update(here)
        found.update(at for at, rule in compiled if rule.search(text))
        return sorted(found)

    return features


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(text, toxic) of at most ``max_rows`` labelled documents outside the held-out fold, chosen by a hash of the id.
    Several labels of one document count as toxic if one does; null labels don't count.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    # At most max_rows pairs of two numbers.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "_toxic")


def _count_features(batches: Iterator) -> Iterator:
    from collections import Counter

    import pyarrow as pa

    positive, negative = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(_WORD.findall((text or "").lower()))
            found = {f for w in words if len(w) <= 40 for f in word_features(w)}
            (positive if toxic else negative).update(found)
    names = list(positive | negative)
    for at in range(0, len(names), 20_000):
        part = names[at:at + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array([positive[n] for n in part], pa.int64()),
             pa.array([negative[n] for n in part], pa.int64())], names=["feature", "pos", "neg"])


def mine_features(training: DataFrame, most: int) -> list[tuple[str, int, int]]:
    """The ``most`` features that speak most clearly for the toxic class, with their counts in either class."""
    candidates = (
        training.mapInArrow(_count_features, "feature string, pos bigint, neg bigint")
        .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where((F.col("pos") >= 3) & (F.col("pos") > F.col("neg")))
        .withColumn("score", F.col("pos") * F.log((F.col("pos") + 0.5) / (F.col("neg") + 0.5)))
        .orderBy(F.desc("score"), "feature").limit(most)
    )
    return [(r["feature"], r["pos"], r["neg"]) for r in candidates.collect()]


def _vote_rows(wanted: dict[str, int], patterns):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        features = _features_of(wanted, patterns)
        for batch in batches:
            found = [features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["found", "toxic"])

    return run


class LabelModel:
    """A generative model of voters given the true class.

    Each voter speaks with a probability that depends on the class; expectation-maximisation estimates these and the
    share of toxic rows. Voters that agree beyond what the class explains are correlated: a voter's evidence is divided
    by one plus its correlations with the others inside the classes, so copies of one signal count about once.
    The labels of the training rows are one more voter, of the accuracy ``label_accuracy``.
    """

    def __init__(self, rounds: int = 15, label_accuracy: float = 0.98):
        self.rounds, self.label_accuracy = rounds, label_accuracy

    def fit(self, votes, labels):
        """``votes``: rows by voters, 1 where a voter speaks. Returns the posterior of class 1."""
        import numpy as np

        n = len(votes)
        a = self.label_accuracy
        given = np.where(labels == 1, math.log(a / (1 - a)), math.log((1 - a) / a))
        post = np.where(labels == 1, a, 1 - a)
        for _ in range(self.rounds):
            ones = max(post.sum(), 1e-9)
            zeros = max(n - post.sum(), 1e-9)
            p1 = (post @ votes + 0.1) / (ones + 1.0)
            p0 = ((1 - post) @ votes + 0.1) / (zeros + 1.0)
            p1, p0 = np.clip(p1, 1e-6, 1 - 1e-6), np.clip(p0, 1e-6, 1 - 1e-6)
            inside = 0.0
            for weight, p in ((post, p1), (1 - post, p0)):
                centred = (votes - p) * np.sqrt(weight)[:, None]
                cov = centred.T @ centred / max(weight.sum(), 1e-9)
                sd = np.sqrt(np.clip(np.diag(cov), 1e-12, None))
                inside = np.maximum(inside, np.clip(cov / np.outer(sd, sd), 0, 1))
            inside = inside - np.diag(np.diag(inside))
            self.redundancy = np.where(inside > 0.3, inside, 0).sum(axis=1)
            spoken = np.log(p1 / p0) / (1 + self.redundancy)
            silent = np.log((1 - p1) / (1 - p0)) / (1 + self.redundancy)
            logit = math.log(ones / zeros) + given + votes @ (spoken - silent) + silent.sum()
            post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        self.spoken = spoken
        self.accuracy = p1 * ones / (p1 * ones + p0 * zeros)
        return post


def fit_linear(found: list[list[int]], target, size: int, rounds: int = 400, penalty: float = 1e-4):
    """Logistic regression on sparse binary features and soft targets, by Adam on the whole sample."""
    import numpy as np

    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    cols = np.array([c for f in found for c in f], dtype=np.int64)
    share = target.mean()
    balance = np.where(target > 0.5, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        z = b + np.bincount(rows, w[cols], len(found))
        error = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(found)
        grad = np.append(np.bincount(cols, error[rows], size) + penalty * w, error.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        w -= move[:-1]
        b -= move[-1]
    return w, float(b)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, voters: int = 300,
                 features: int = 3_000) -> Model:
    """Learns from at most ``max_rows`` labelled rows (all bounds are parameters; nothing else reaches the driver).

    Voters are seed words, patterns and the ``voters`` clearest mined features; the classifier's features are those
    and the next mined ones up to ``features``. Without labels, or without one of the classes, seed words alone decide.
    """
    import numpy as np

    training = training_rows(docs, labels, max_rows)
    mined = mine_features(training, features)
    names = list(dict.fromkeys([
        *SEED_WORDS, *(f"/{n}/" for n, _, _ in PATTERNS), *(f for f, _, _ in mined)]))
    wanted = {name: at for at, name in enumerate(names)}
    rows = training.mapInArrow(_vote_rows(wanted, PATTERNS), "found array<int>, toxic int").collect()
    labelled = np.array([r["toxic"] for r in rows], dtype=np.int64)
    if not len(rows) or labelled.min() == labelled.max():
        return Model({w: 4.0 for w in SEED_WORDS}, -2.0)
    found = [r["found"] for r in rows]
    n_voters = min(len(names), len(SEED_WORDS) + len(PATTERNS) + voters)
    votes = np.zeros((len(rows), n_voters), dtype=np.float32)
    for at, here in enumerate(found):
        votes[at, [c for c in here if c < n_voters]] = 1
    label_model = LabelModel()
    post = label_model.fit(votes, labelled)
    w, b = fit_linear(found, post, len(names))
    return Model(
        {name: float(x) for name, x in zip(names, w) if abs(x) > 1e-6}, b,
        dict(zip(names[:n_voters], map(float, label_model.accuracy))),
        dict(zip(names[:n_voters], map(float, label_model.redundancy))))


def _score(names: list[str], weights: list[float], bias: float):
    wanted = {name: at for at, name in enumerate(names)}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        features = _features_of(wanted, PATTERNS)
        for batch in batches:
            scores = [
                1 / (1 + math.exp(-max(-30.0, min(30.0, bias + sum(weights[i] for i in features(t.as_py() or ""))))))
                for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(scores, pa.float64()), *batch.columns[1:]], names=["_score", *batch.schema.names[1:]])

    return run


def score_toxicity(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text",
                   name: str = "score") -> DataFrame:
    """The columns ``keep`` and the score ``name`` (0 to 1) of every document, from its whole text alone.

    A null text is empty; its score is that of a text without features. Rows are neither dropped nor merged.
    """
    names = list(model.weights)
    shape = docs.select(F.lit(0.0).alias("_score"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]).schema
    scored = docs.select(
        F.col(text_col).alias("_text"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    ).mapInArrow(_score(names, [model.weights[n] for n in names], model.bias), shape)
    return scored.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_score").alias(name))

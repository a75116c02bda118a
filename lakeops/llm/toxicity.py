"""Toxicity by weak supervision.

Voters are words (a lexicon) and word beginnings (patterns) that occur far more often in
toxic than in other labelled texts of the training part, or far more rarely; the latter vote for
the other class, and a voter that does not occur abstains. A generative label model sees
only their votes: expectation maximization estimates, again in every round, how often each voter
and each pair of voters fires on toxic and on other texts, and weighs a vote by what it adds to the
voter it depends on most. Its posterior labels train a linear classifier on the presence of words
and beginnings; that classifier scores every text.

Counting and scoring run in Spark over all rows. Fitted on a bounded sample: at most
``max_per_class`` labelled training texts of either class, the smallest by a
hash of ``doc_id``, and at most ``max_voters`` voters of either class plus ``max_features`` features; these are
all that reaches the driver.

Edge cases: a null text is empty and gets the classifier's base score; a null
``doc_id`` counts as the empty string in the fold; labels that are null or belong to no
document are not used, of several labels of a document the largest counts; without
labelled texts of both classes every score is 0; texts are read whole. Only
``doc_id`` and ``text`` of the documents are read, and only ``text`` enters a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import no_cycle_collection, stash, text_or_empty

FOLDS = 5
MAX_PER_CLASS = 5000
MIN_EVIDENCE = 13.0  # nats of log-likelihood ratio: beyond what chance gives any of a million features
MAX_VOTERS = 500  # of either class
MAX_FEATURES = 800
VOTER_PRECISION = 0.993  # of a voter, for its class, were both classes equally frequent
BEGINNINGS = (3, 4, 5, 6)
CACHE_WORDS = 300_000
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def word_features(word: str) -> list[str]:
    """The word itself, and its beginnings (marked by a hyphen)."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


def text_features(text: str) -> set[str]:
    return {f for w in set(LETTERS.findall(text.lower())) for f in word_features(w)}


def _sample(documents: DataFrame, labels: DataFrame, max_per_class: int) -> DataFrame:
    """(text, toxic) of at most ``max_per_class`` training texts of either class."""
    train = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    chosen = [
        train.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class) for c in (0, 1)
    ]
    # bounded by 2 * max_per_class rows of two numbers
    ids = F.broadcast(stash(chosen[0].union(chosen[1]), "toxicity-ids"))
    rows = documents.select("doc_id", text_or_empty(F.col("text")).alias("text")).join(ids, "doc_id")
    # copies of a text count once
    return stash(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxicity-sample")


def _count_features(sample: DataFrame) -> DataFrame:
    """(feature, toxic_texts, other_texts): texts of either class each feature occurs in."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(rows["text"], rows["toxic"]):
                seen[toxic].update(text_features(text))
            names = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({
                "feature": names, "toxic_texts": [seen[1][n] for n in names], "other_texts": [seen[0][n] for n in names],
            })

    parts = sample.select("text", "toxic").mapInPandas(count, "feature string, toxic_texts long, other_texts long")
    return parts.groupBy("feature").agg(F.sum("toxic_texts").alias("toxic_texts"), F.sum("other_texts").alias("other_texts"))


def _presence(sample: DataFrame, features: list[str]) -> np.ndarray:
    """Texts by features, for the bounded sample and the bounded feature list."""
    place = {f: i for i, f in enumerate(features)}

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"hits": [sorted(place[f] for f in text_features(t) if f in place) for t in rows["text"]]})

    rows = sample.select("text").mapInPandas(find, "hits array<int>").collect()
    out = np.zeros((len(rows), len(features)), np.float32)
    for i, r in enumerate(rows):
        out[i, r["hits"]] = 1.0
    return out


def _rates(votes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each voter, and each pair of voters together, fires among rows of these weights."""
    one, two = weight @ votes, (votes * weight[:, None]).T @ votes
    return np.clip(one / weight.sum(), 1e-9, 1 - 1e-9), two / weight.sum()


def _information(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Mutual information in nats of every pair of voters."""
    out = np.zeros_like(two)
    for a, b, both in (
        (one, one, two), (one, 1 - one, one[:, None] - two), (1 - one, one, one[None, :] - two),
        (1 - one, 1 - one, 1 - one[:, None] - one[None, :] + two),
    ):
        both = np.maximum(both, 1e-12)
        out += both * np.log(both / np.outer(a, b))
    return out


def _dependence_tree(score: np.ndarray) -> np.ndarray:
    """Parent of each voter (-1: the root) in the spanning tree of the largest sum of ``score``."""
    parent, best = np.full(len(score), -1), np.full(len(score), -np.inf)
    left, at = np.ones(len(score), bool), 0
    for _ in range(len(score) - 1):
        left[at] = False
        nearer = left & (score[at] > best)
        best[nearer], parent[nearer] = score[at][nearer], at
        at = int(np.argmax(np.where(left, best, -np.inf)))
    return parent


def label_model(votes: np.ndarray, toxic_voter: np.ndarray | None = None, rounds: int = 30) -> np.ndarray:
    """Posterior probability of the toxic class per row of a 0/1 matrix of votes, by expectation maximization.

    Column j fires (1) for the toxic class where ``toxic_voter[j]`` (None: all do), else for
    the other class; 0 is an abstention. The start takes nine of ten majorities of votes for
    right, and its balance of the classes is kept. Every round estimates under the posteriors of the last one, within either class, how often each voter and each pair
    of voters fires; the strongest dependences within the classes make a tree, and a vote counts
    for what it adds to that of its parent in the tree, so a copy of a voter adds nothing. No voter is
    taken for worse than chance. An abstention says nothing; that all abstain is a voter of its own.
    """
    toxic_voter = np.ones(votes.shape[1], bool) if toxic_voter is None else toxic_voter
    votes, row, copies = np.unique(votes.astype(np.float64), axis=0, return_inverse=True, return_counts=True)
    silent = votes.sum(axis=1) == 0
    p = np.where(votes @ np.where(toxic_voter, 1.0, -1.0) > 0, 0.9, 0.1)
    balance = np.log((copies @ p + 1) / (copies @ (1 - p) + 1))
    for _ in range(rounds):
        weight = np.stack([copies * (1 - p), copies * p])
        total = weight.sum(axis=1)
        rates = [_rates(votes, w) for w in weight]
        parent = _dependence_tree(sum(t * _information(*r) for t, r in zip(total, rates)))
        kid = np.flatnonzero(parent >= 0)
        log_beside, log_alone = [], []  # of a vote: its rate where the parent votes as well, and its rate
        for one, two in rates:
            beside = one.copy()
            beside[kid] = two[kid, parent[kid]] / one[parent[kid]]
            log_beside.append(np.log(np.clip(beside, 1e-4, 1)))
            log_alone.append(np.log(np.clip(one, 1e-4, 1)))
        parent_fires = np.zeros_like(votes)
        parent_fires[:, kid] = votes[:, parent[kid]]
        quiet = (weight @ silent + 0.1) / (total + 0.2)
        logit = balance + silent * np.log(quiet[1] / quiet[0])
        # no voter is worse than chance: a vote never speaks against its own class
        beside, alone = (
            np.where(toxic_voter, np.maximum(r[1] - r[0], 0), np.minimum(r[1] - r[0], 0)) for r in (log_beside, log_alone)
        )
        logit = logit + (votes * parent_fires) @ beside + (votes * (1 - parent_fires)) @ alone
        last, p = p, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(p - last).max() < 1e-9:
            break
    return p[row.ravel()]


def linear_classifier(x: np.ndarray, p: np.ndarray, decay: float = 2e-5, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels ``p``, both classes weighing the same.

    A text without any feature is added as one of the other class, with a small weight.
    """
    x, p = np.vstack([x, np.zeros((1, x.shape[1]), x.dtype)]), np.append(p, 0.0)
    weight = np.where(p >= 0.5, 0.5 / max(1, (p >= 0.5).sum()), 0.5 / max(1, (p < 0.5).sum())).astype(np.float64)
    weight[-1] = 0.05
    w, b = np.zeros(x.shape[1]), 0.0
    mean, square = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, steps + 1):
        off = weight * (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - p)
        grad = np.append(x.T @ off + decay * w, off.sum())
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
        move = 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-10)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of words and word beginnings, and the bias; ``bias`` None: nothing was learned."""

    weights: dict[str, float]
    bias: float | None

    def score(self, text: Column) -> Column:
        """Probability-like score (0 to 1) of a string column."""
        model = self

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known: dict[str, tuple[str, ...]] = {}
            weights = model.weights
            with no_cycle_collection():
                for texts in batches:
                    out = np.zeros(len(texts))
                    if model.bias is None:
                        yield pd.Series(out)
                        continue
                    for i, text in enumerate(texts):
                        found: set[str] = set()
                        for word in set(LETTERS.findall(text.lower())):
                            if (hits := known.get(word)) is None:
                                hits = tuple(f for f in word_features(word) if f in weights)
                                if len(known) >= CACHE_WORDS:
                                    known.clear()
                                known[word] = hits
                            if hits:
                                found.update(hits)
                        out[i] = model.bias + sum(weights[f] for f in sorted(found))
                    yield pd.Series(1 / (1 + np.exp(-np.clip(out, -30, 30))))

        return run(text_or_empty(text))


def fit(
    documents: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS, max_voters: int = MAX_VOTERS,
    max_features: int = MAX_FEATURES,
) -> ToxicityModel:
    """Learn from the training rows of ``labels`` (doc_id, toxic) and their ``documents`` (doc_id, text)."""
    sample = _sample(documents, labels, max_per_class)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return ToxicityModel({}, None)
    n = F.col("toxic_texts") + F.col("other_texts")
    share = sizes[1] / (sizes[0] + sizes[1])
    term = lambda k, expected: F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)
    evidence = term(F.col("toxic_texts"), n * share) + term(F.col("other_texts"), n * (1 - share))
    rate_toxic, rate_other = F.col("toxic_texts") / sizes[1], F.col("other_texts") / sizes[0]
    counts = stash(
        _count_features(sample).withColumn("evidence", evidence).withColumn("precision", rate_toxic / (rate_toxic + rate_other))
        .filter(F.col("evidence") >= MIN_EVIDENCE),
        "toxicity-counts",
    )
    # the bounded lists of voters and of all features, those with most evidence first
    ranked = lambda df, n: [r["feature"] for r in df.orderBy(F.desc("evidence"), "feature").limit(n).collect()]
    toxic_voters = ranked(counts.filter(F.col("precision") >= VOTER_PRECISION), max_voters)
    if not toxic_voters:
        return ToxicityModel({}, None)
    voters = toxic_voters + ranked(counts.filter(F.col("precision") <= 1 - VOTER_PRECISION), max_voters)
    features = voters + [f for f in ranked(counts, max_features) if f not in set(voters)]
    presence = _presence(sample, features)
    posterior = label_model(presence[:, : len(voters)], np.arange(len(voters)) < len(toxic_voters))
    weights, bias = linear_classifier(presence, posterior)
    return ToxicityModel(dict(zip(features, weights.tolist())), bias)


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted per row of ``documents``, by a model fitted on the training labels."""
    model = fit(documents, labels)
    out = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Toxicity by weak supervision.

Lexicon and pattern voters vote on every document; a generative label model estimates how accurate the voters are and
which of them are correlated, from the counts of all vote patterns; a linear classifier is trained on its posterior
labels and scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm import simhash
from creditloom.llm.common import column, crc_mod, staged, text_of

#: Bounds of the fit: labelled documents that lexicons are drawn from and documents the classifier sees (both in
#: expectation, chosen by a hash), and features kept.
LABELLED_SAMPLE = 40_000
TRAINING_SAMPLE = 40_000
POSITIVE_FEATURES, NEGATIVE_FEATURES = 8_000, 2_000
STEMS = (4, 5, 6)
LEXICONS = 6
#: Labelled documents whose fingerprints differ in so few bits count once.
COPY_SHINGLE, COPY_BITS = 3, 6
MIN_DOCS = 3
#: A feature counts from here on, and enters the voters' lexicons from there on; a hundred thousand candidates give
#: a few by chance at the first and next to none at the second.
MIN_Z, STRONG_Z = 4.0, 5.0
WORD = re.compile(r"[^\W\d_]+")
COUNTED_AT_ONCE = 300_000


def features_of(text: str) -> set[str]:
    """Words (``=word``) and the stems they begin with (``4word``...), each once."""
    words = set(WORD.findall(text.lower()))
    found = {"=" + w for w in words}
    for size in STEMS:
        found.update(str(size) + w[:size] for w in words if len(w) > size)
    return found


# -- lexicons ---------------------------------------------------------------------------------------------------------


class Feature(NamedTuple):
    name: str
    evidence: float  # log odds of the label with and without the feature
    z: float  # signed root of the likelihood ratio statistic: how surely it is not chance


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pack(found: Counter) -> Iterator[pa.RecordBatch]:
        items = list(found.items())
        for at in range(0, len(items), 50_000):
            keys, ns = zip(*items[at : at + 50_000])
            names, toxic = zip(*keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(toxic, pa.int32()), pa.array(ns, pa.int64())], names=["name", "toxic", "n"]
            )

    found: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            found.update((name, toxic) for name in features_of(text.as_py()))
            found["", toxic] += 1
        if len(found) >= COUNTED_AT_ONCE:
            yield from pack(found)
            found = Counter()
    yield from pack(found)


def _xlog(x: Column, expected: Column) -> Column:
    return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)


def lexicon(labelled: DataFrame) -> list[Feature]:
    """The features that tell the labels of (text, toxic) apart most surely, best first on either side."""
    counted = labelled.mapInArrow(_feature_counts, "name string, toxic int, n long")
    by_name = staged(
        counted.groupBy("name").agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
        ),
        "lexicon",
    )
    total = by_name.filter("name = ''").first()
    if not total or not total.a or not total.b:
        return []
    a, b, share = F.col("a"), F.col("b"), total.a / (total.a + total.b)
    evidence = F.log((a + 0.5) * (total.b - b + 0.5) / ((b + 0.5) * (total.a - a + 0.5)))
    gain = _xlog(a, (a + b) * share) + _xlog(b, (a + b) * (1 - share))
    rated = by_name.filter(f"name <> '' and a + b >= {MIN_DOCS}").select(
        "name", evidence.alias("evidence"), (F.signum(evidence) * F.sqrt(F.greatest(2 * gain, F.lit(0.0)))).alias("z")
    )
    best = rated.filter(f"z >= {MIN_Z}").orderBy(F.desc("z"), "name").limit(POSITIVE_FEATURES).collect()
    worst = rated.filter(f"z <= -{MIN_Z}").orderBy("z", "name").limit(NEGATIVE_FEATURES).collect()
    return [Feature(*r) for r in best + worst]


def one_of_each(labelled: DataFrame) -> DataFrame:
    """One document of every group of near copies: copies share words and label, and are no evidence beyond the first.
    ``labelled`` is a bounded sample."""
    judged = simhash.near_copies(labelled, COPY_SHINGLE, COPY_BITS).filter("doc_id = component_id")
    chosen = staged(judged.select("doc_id").distinct(), "one-of-each")
    return labelled.join(F.broadcast(chosen), "doc_id")


# -- voters -----------------------------------------------------------------------------------------------------------


class Voter(NamedTuple):
    name: str
    toxic: bool  # what it votes when it votes
    features: frozenset[int]
    at_least: int = 1
    at_most: int | None = None


def voters(found: list[Feature]) -> list[Voter]:
    """Lexicons of words, one pattern per stem length, repeated hits; on the clean side two lexicons and no hit."""
    strong = [i for i, f in enumerate(found) if f.evidence > 1.5 and f.z >= STRONG_Z]
    words = [i for i in strong if found[i].name[0] == "="]
    clean = [i for i, f in enumerate(found) if f.z < 0]
    built = [Voter(f"lexicon {k}", True, frozenset(words[k::LEXICONS])) for k in range(LEXICONS)]
    built += [Voter(f"stem {s}", True, frozenset(i for i in strong if found[i].name[0] == str(s))) for s in STEMS]
    built += [
        Voter("several words", True, frozenset(words), 2),
        Voter("no hit", False, frozenset(strong), 0, 0),
        Voter("clean words 0", False, frozenset(clean[0::2]), 3),
        Voter("clean words 1", False, frozenset(clean[1::2]), 3),
    ]
    return built


def votes(hit: set[int], panel: list[Voter]) -> int:
    """Bit k is set if voter k votes; a voter that does not vote abstains."""
    pattern = 0
    for k, voter in enumerate(panel):
        n = len(hit & voter.features)
        if n >= voter.at_least and (voter.at_most is None or n <= voter.at_most):
            pattern |= 1 << k
    return pattern


# -- label model ------------------------------------------------------------------------------------------------------


class LabelModel:
    """P(label, votes) with one dependency per voter: a tree over the voters whose votes stay correlated given the
    label (largest conditional mutual information), fitted by expectation maximisation; known labels are held."""

    MIN_INFORMATION = 0.002

    def __init__(self, n_voters: int, rounds: int = 25):
        self.n_voters, self.rounds = n_voters, rounds

    def fit(self, patterns: np.ndarray, unknown: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> LabelModel:
        """patterns: vote patterns; the others: documents with that pattern by what is known of their label."""
        on = (patterns[:, None] >> np.arange(self.n_voters) & 1).astype(float)
        belief = (toxic + 0.1) / (toxic + clean + 1.0)
        for _ in range(self.rounds):
            weights = np.stack([clean + unknown * (1 - belief), toxic + unknown * belief])
            self._maximise(on, weights)
            belief = self.posterior(patterns)
        return self

    def _maximise(self, on: np.ndarray, weights: np.ndarray) -> None:
        total = weights.sum(axis=1) + 2.0
        self.prior = total / total.sum()
        ones = np.stack([w @ on for w in weights]) + 1.0  # label x voter
        both = np.stack([(on * w[:, None]).T @ on for w in weights]) + 0.5  # label x voter x voter
        self.votes_given = ones / total[:, None]
        p = {
            (1, 1): both / total[:, None, None],
            (1, 0): (ones[:, :, None] - both) / total[:, None, None],
            (0, 1): (ones[:, None, :] - both) / total[:, None, None],
        }
        p = {k: np.clip(v, 1e-9, 1) for k, v in p.items()}
        p[0, 0] = np.clip(1 - p[1, 1] - p[1, 0] - p[0, 1], 1e-9, 1)
        single = {1: np.clip(self.votes_given, 1e-9, 1), 0: np.clip(1 - self.votes_given, 1e-9, 1)}
        information = sum(
            v * (np.log(v) - np.log(single[i][:, :, None]) - np.log(single[j][:, None, :])) for (i, j), v in p.items()
        )
        self.correlation = np.einsum("y,yij->ij", self.prior, information)
        self.parent = self._tree(self.correlation)
        self.tables = np.zeros((2, self.n_voters, 2))  # label, voter, vote of its parent -> P(vote)
        for k, parent in enumerate(self.parent):
            for y in range(2):
                if parent < 0:
                    self.tables[y, k] = self.votes_given[y, k]
                else:
                    yes, with_parent = ones[y, parent], both[y, k, parent]
                    self.tables[y, k, 1] = np.clip(with_parent / yes, 1e-4, 1 - 1e-4)
                    self.tables[y, k, 0] = np.clip((ones[y, k] - with_parent) / max(total[y] - yes, 1e-9), 1e-4, 1 - 1e-4)
        self.tables = np.clip(self.tables, 1e-4, 1 - 1e-4)

    def _tree(self, information: np.ndarray) -> list[int]:
        """Parents in a largest spanning forest over pairs that share enough information; -1 without a parent."""
        parent, todo = [-1] * self.n_voters, set(range(self.n_voters))
        while todo:
            tree = [min(todo)]
            todo -= set(tree)
            while todo:
                value, child, via = max((information[a, b], -b, a) for a in tree for b in todo)
                if value < self.MIN_INFORMATION:
                    break
                parent[-child] = via
                tree.append(-child)
                todo.remove(-child)
        return parent

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of the toxic label for each vote pattern."""
        on = patterns[:, None] >> np.arange(self.n_voters) & 1
        log = np.tile(np.log(self.prior)[:, None], (1, len(patterns)))
        for k, parent in enumerate(self.parent):
            given = on[:, parent] if parent >= 0 else np.zeros(len(patterns), int)
            for y in range(2):
                p = self.tables[y, k][given]
                log[y] += np.log(np.where(on[:, k] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))

    def accuracies(self, panel: list[Voter]) -> list[float]:
        """Share of a voter's votes that are right."""
        joint = self.prior[:, None] * self.votes_given
        return [float(joint[int(v.toxic), k] / joint[:, k].sum()) for k, v in enumerate(panel)]


# -- classifier -------------------------------------------------------------------------------------------------------


def train(rows: list[list[int]], target: np.ndarray, n_features: int, steps: int = 500, ridge: float = 0.01):
    """Logistic regression on 0/1 features and probabilistic labels, by full-batch gradient steps: (weights, bias).

    Both labels weigh the same in total.  The ridge spreads the evidence: documents with one or two toxic words must
    score too, although most have more."""
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows]) if lengths.sum() else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(rows)), lengths)
    weights, bias = np.zeros(n_features), 0.0
    if not len(rows) or not 0 < target.sum() < len(rows):
        return weights, bias
    share = 1 + ((1 - target).sum() / target.sum() - 1) * target
    share = share / share.sum()
    seen, seen_bias = np.full(n_features, 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(of, weights[flat], len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) * share
        slope = np.bincount(flat, error[of], n_features) + ridge * weights
        seen += slope**2
        seen_bias += error.sum() ** 2
        weights -= 0.6 * slope / np.sqrt(seen)
        bias -= 0.6 * error.sum() / np.sqrt(seen_bias)
    return weights, bias


class Model(NamedTuple):
    names: dict[str, int]
    weights: np.ndarray
    bias: float
    panel: list[Voter]
    labels: LabelModel | None


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> tuple[DataFrame, Model]:
    """One row per document (doc_id, held_out, score), and the fitted model.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic (0 or 1; others and null are no labels, of several for an
    id the largest counts).  Labels of ids whose crc32 modulo ``folds`` is ``held_out`` are never read; a score sees
    the text only.  Null and empty texts have no features and get the classifier's base rate, repeated rows are scored
    each.  Without both labels in the training part, or without documents, every score is 0.  Each text is read once
    after the lexicon sample; what the fit needs of it is stored as a list of feature numbers.
    """
    spark = docs.sparkSession
    source = docs.select(column(docs, "doc_id").alias("doc_id"), text_of(docs, "text").alias("text"))
    known = (
        labels.select(column(labels, "doc_id").alias("doc_id"), column(labels, "toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)")
        .filter(crc_mod(F.col("doc_id"), folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )

    def sampled(df: DataFrame, rows: int, most: int, salt: int, *keys: Column | str) -> DataFrame:
        share = min(1.0, most / max(rows, 1))
        return df.filter(F.pmod(F.xxhash64(F.lit(salt), *keys), F.lit(1 << 20)) < int(share * (1 << 20)))

    n_known = known.count()
    drawn = sampled(source, n_known, LABELLED_SAMPLE, 1, "doc_id").filter(crc_mod(F.col("doc_id"), folds) != held_out)
    # The drawn labels are bounded by the sample, so their documents meet them without moving texts.
    drawn = drawn.join(F.broadcast(sampled(known, n_known, LABELLED_SAMPLE, 1, "doc_id")), "doc_id")
    found = lexicon(one_of_each(drawn).select("text", "toxic"))
    fold = (crc_mod(F.col("doc_id"), folds) == held_out).alias("held_out")
    if not found:
        return source.select("doc_id", fold, F.lit(0.0).alias("score")), Model({}, np.zeros(0), 0.0, [], None)
    names, panel = {f.name: i for i, f in enumerate(found)}, voters(found)
    sent = spark.sparkContext.broadcast((names, panel))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, panel = sent.value
        for batch in batches:
            hits = [
                sorted({names[f] for f in features_of(text.as_py()) if f in names}) for text in batch.column("text")
            ]
            patterns = [votes(set(h), panel) for h in hits]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(hits, pa.list_(pa.int32())), pa.array(patterns, pa.int64())],
                names=["doc_id", "hits", "pattern"],
            )

    read_once = source.mapInArrow(read, f"doc_id {id_type}, hits array<int>, pattern long")
    seen = staged(read_once.join(known, "doc_id", "left"), "features")

    def n(condition: str) -> Column:
        return F.sum(F.when(F.expr(condition), 1).otherwise(0)).alias(condition)

    of = ("toxic is null", "toxic = 0", "toxic = 1")
    counts = np.array(seen.groupBy("pattern").agg(*map(n, of)).collect(), np.int64).reshape(-1, 4)
    label_model = LabelModel(len(panel)).fit(counts[:, 0], *(counts[:, k].astype(float) for k in (1, 2, 3)))
    belief = dict(zip(counts[:, 0].tolist(), label_model.posterior(counts[:, 0]).tolist()))
    rows = int(counts[:, 1:].sum())
    training = sampled(seen, rows, TRAINING_SAMPLE, 2, "doc_id", "pattern").select("hits", "pattern").toArrow()
    target = np.array([belief[p] for p in training.column("pattern").to_pylist()])
    weights, bias = train(training.column("hits").to_pylist(), target, len(found))
    fitted = spark.sparkContext.broadcast((weights, bias))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = fitted.value
        for batch in batches:
            hits = batch.column("hits")
            at = np.repeat(np.arange(len(hits)), np.diff(hits.offsets.to_numpy()))
            flat = hits.values.to_numpy()[hits.offsets[0].as_py() : hits.offsets[-1].as_py()]
            z = np.bincount(at, weights[flat], len(hits)) + bias
            scores = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    scored = seen.select("doc_id", "hits").mapInArrow(rate, f"doc_id {id_type}, score double")
    return scored.select("doc_id", fold, "score"), Model(names, weights, bias, panel, label_model)

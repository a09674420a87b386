"""Language identification by words first, character n-grams for words the model has not seen."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import column, crc_mod, staged

UNDETERMINED = "und"
#: Bounds of the fit: documents per language (in expectation), languages, words and n-grams kept (the most frequent
#: of every language).
DOCS_PER_LANGUAGE = 5_000
LANGUAGES = 500
WORDS = 150_000
GRAMS = 80_000
LONGEST_GRAM = 4
WORD = re.compile(r"[^\W\d_]+")
COUNTED_AT_ONCE = 200_000
CACHED_WORDS = 50_000


class Model(NamedTuple):
    """Log frequencies by language: ``words[known[w]]`` of a word, ``grams[parts[g]]`` of an n-gram."""

    languages: list[str]
    known: dict[str, int]
    words: np.ndarray
    parts: dict[str, int]
    grams: np.ndarray


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str, size: int) -> list[str]:
    """The n-grams of the word between blanks, without those that are only a blank: every language has them."""
    padded = f" {word} " if size > 1 else word
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


def _tables(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    rows = []
    for lang, counts in found.items():
        rows += [(lang, 0, w, n) for w, n in counts.items()]
        grams: Counter = Counter()
        for word, n in counts.items():
            for size in range(1, LONGEST_GRAM + 1):
                for gram in grams_of(word, size):
                    grams[gram] += n
        rows += [(lang, len(g), g, n) for g, n in grams.items()]
    for at in range(0, len(rows), 50_000):
        langs, sizes, pieces, ns = zip(*rows[at : at + 50_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs), pa.array(sizes, pa.int32()), pa.array(pieces), pa.array(ns, pa.int64())],
            names=["lang", "size", "piece", "n"],
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            found.setdefault(lang, Counter()).update(words_of(text.as_py()))
        if sum(map(len, found.values())) >= COUNTED_AT_ONCE:
            yield from _tables(found)
            found = {}
    yield from _tables(found)


def fit(
    labelled: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    words: int = WORDS,
    grams: int = GRAMS,
) -> Model:
    """Fit on rows (key, text, lang); rows without text or language are ignored.

    Up to ``docs_per_language`` documents of a language in expectation, chosen by a hash, are counted as a Spark job;
    the most frequent words and n-grams of every language come to the driver.  Both bounds are parameters of the classifier.
    """
    labelled = labelled.filter("text is not null and lang is not null")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("docs")).orderBy(F.desc("docs"), "lang").limit(LANGUAGES)
    keep = {r.lang: min(1.0, docs_per_language / r.docs) for r in sizes.collect()}
    languages = sorted(keep)
    share = F.lit(0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, int(keep[lang] * (1 << 20))).otherwise(share)
    sample = labelled.filter(F.pmod(F.xxhash64("key", F.length("text")), F.lit(1 << 20)) < share)
    counted = sample.select("lang", "text").mapInArrow(_count, "lang string, size int, piece string, n long")
    by_lang = staged(counted.groupBy("size", "piece", "lang").agg(F.sum("n").alias("n")), "pieces")
    summed = by_lang.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()
    totals = {(r["size"], r["lang"]): r["n"] for r in summed}
    seen_words = _table(by_lang.filter("size = 0"), words, totals, languages)
    seen_grams = _table(by_lang.filter("size > 0"), grams, totals, languages)
    return Model(languages, *seen_words, *seen_grams)


def _table(
    by_lang: DataFrame, most: int, totals: dict[tuple[int, str], int], languages: list[str]
) -> tuple[dict[str, int], np.ndarray]:
    """The most frequent pieces of every language, at most ``most`` together, and their log frequencies.  A piece has its
    best rank in any language, so a language with few documents keeps as many pieces as a large one.  Ranks and the last
    rank that is kept follow from tables of counts, so no task ranks all pieces; pieces come to the driver as Arrow columns, one row per language
    that has them.  A language without the piece gets half an occurrence in the largest language's
    total, so that a language with few documents is not favoured."""
    of_lang = Window.partitionBy("lang").orderBy(F.desc("n"))
    ranks = by_lang.groupBy("lang", "n").agg(F.count("*").alias("pieces"))
    ranks = ranks.select("lang", "n", F.sum("pieces").over(of_lang).alias("rank"))
    best = by_lang.join(F.broadcast(ranks), ["lang", "n"]).groupBy("size", "piece").agg(F.min("rank").alias("rank"))
    sizes_of = best.groupBy("rank").agg(F.count("*").alias("pieces"))
    so_far = F.sum("pieces").over(Window.orderBy("rank"))
    last = sizes_of.withColumn("so_far", so_far).filter(F.col("so_far") <= most).agg(F.max("rank").alias("rank")).first()
    kept = best.filter(F.col("rank") <= last.rank) if last.rank else best.orderBy("rank", "piece").limit(most)
    rows = kept.select("size", "piece").join(by_lang, ["size", "piece"]).select("size", "piece", "lang", "n").toArrow()
    if not rows.num_rows:
        return {}, np.zeros((0, len(languages)))
    pieces = rows.column("piece").combine_chunks().dictionary_encode()
    at, place = {lang: i for i, lang in enumerate(languages)}, pieces.indices.to_numpy()
    sizes, langs = rows.column("size").to_pylist(), rows.column("lang").to_pylist()
    norms = np.array([totals[size, lang] for size, lang in zip(sizes, langs)], float)
    largest = {size: max(n for (s, _), n in totals.items() if s == size) for size in set(sizes)}
    shares = np.zeros((len(pieces.dictionary), len(languages)))
    shares[place] = 0.5 / np.array([largest[size] for size in sizes], float)[:, None]
    shares[place, [at[lang] for lang in langs]] = rows.column("n").to_numpy() / norms
    return {piece: i for i, piece in enumerate(pieces.dictionary.to_pylist())}, np.log(shares)


class Scorer:
    """Log-likelihoods of texts under a model; vectors of unseen words are kept for the worker's next texts."""

    def __init__(self, model: Model):
        self.model = model
        self.unseen: dict[str, np.ndarray] = {}

    def back_off(self, word: str) -> np.ndarray:
        """Mean over the n-grams of the longest size of which the model knows any."""
        vector = self.unseen.get(word)
        if vector is None:
            parts, vector = self.model.parts, np.zeros(len(self.model.languages))
            for size in range(LONGEST_GRAM, 0, -1):
                if found := [parts[g] for g in grams_of(word, size) if g in parts]:
                    vector = np.add.reduce(self.model.grams.take(found, axis=0), axis=0) / len(found)
                    break
            if len(self.unseen) >= CACHED_WORDS:
                self.unseen.clear()
            self.unseen[word] = vector
        return vector

    def judge(self, text: str | None) -> tuple[str, float]:
        """(language, posterior probability with equal priors)."""
        counts = Counter(words_of(text or ""))
        if not self.model.languages or not any(c.isalpha() for word in counts for c in word):
            return UNDETERMINED, 0.0
        known, at, ns = self.model.known, [], []
        total = np.zeros(len(self.model.languages))
        for word, n in counts.items():
            i = known.get(word)
            if i is None:
                total += n * self.back_off(word)
            else:
                at.append(i)
                ns.append(n)
        total += np.array(ns, float) @ self.model.words[at] if at else 0.0
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """One row per document: (doc_id, lang_pred, score) and the columns ``more``.

    A null text and a text without a letter are ``und`` with score 0; so is everything under a model of no language.
    Equal likelihoods go to the first language in alphabetical order.  Repeated rows are judged each.
    """
    source = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"), *more)
    kept = [f for f in source.schema if f.name != "text"]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            judged = [scorer.judge(text.as_py()) for text in batch.column("text")]
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array([j[0] for j in judged], pa.string()), pa.array([j[1] for j in judged], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), "lang_pred", "score"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return source.mapInArrow(work, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    folds: int = 3, held_out: int = 1) -> DataFrame:
    """Fit on the documents whose id's crc32 modulo ``folds`` is not ``held_out`` and judge all of them: (doc_id,
    held_out, lang_pred, score).  Language and id choose training rows only; a prediction sees nothing but the text."""
    fold = crc_mod(column(docs, id_col), folds) == held_out
    training = docs.filter(~fold).select(
        column(docs, id_col).alias("key"), column(docs, text_col).alias("text"), column(docs, lang_col).cast("string").alias("lang")
    )
    return predict(docs, fit(training), id_col, text_col, fold.alias("held_out")).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """``docs`` without rows that have no language: no letter, or nothing in the text that tells the languages apart.

    Judged inside one pass over the rows themselves, so all columns stay and nothing is joined.  Null and empty texts have
    no letter; repeated rows are judged each.  Where no row that may be learned from has a language, or only one language
    is known, nothing can tell languages apart, so every row with a letter stays.  An empty table gives an empty result.
    """
    fold = crc_mod(column(docs, "doc_id"), 3) == 1
    model = fit(docs.filter(~fold).select(F.col("doc_id").alias("key"), "text", F.col("lang").cast("string").alias("lang")))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    several = len(model.languages) > 1
    chance = 1 / len(model.languages) + 1e-9 if several else 0.0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            texts = [text.as_py() for text in batch.column("text")]
            if several:
                keep = [lang != UNDETERMINED and score > chance for lang, score in map(scorer.judge, texts)]
            else:
                keep = [any(c.isalpha() for c in text or "") for text in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)

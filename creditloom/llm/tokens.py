"""Token counts: pieces are counted once per distinct pre-token and joined to per-document pre-token frequencies.

The pre-tokens that are frequent in a bounded sample are counted on the driver and joined inside the tasks, so no key
of the shuffled join is hot; every other pre-token goes through a distinct table and an equi-join.  Which side a
pre-token takes changes no result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm import bpe
from creditloom.llm.common import column, staged, text_of

#: Bounds of what is counted ahead: documents looked at (in expectation), pre-tokens broadcast, and the bytes of each, so
#: the broadcast table holds at most 6.4 MB of text.  Longer pre-tokens go through the join, however frequent.
SAMPLE_DOCS = 20_000
HEAD_WORDS = 100_000
HEAD_BYTES = 64
OUT_ROWS = 50_000


def head_words(source: DataFrame, path: str, sample_docs: int, limit: int) -> list[str]:
    """The most frequent pre-tokens of a sample; at most ``limit`` of at most ``HEAD_BYTES`` bytes."""
    rows = source.count()
    keep = min(1.0, sample_docs / max(rows, 1))
    sample = source.filter(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 20)) < int(keep * (1 << 20)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, found = bpe.load(path), Counter()
        for batch in batches:
            for text in batch.column("text"):
                found.update(set(coder.pieces_of(text.as_py())[0]))
                if len(found) >= 4 * HEAD_WORDS:
                    yield from pack(found)
                    found = Counter()
        yield from pack(found)

    def pack(found: Counter) -> Iterator[pa.RecordBatch]:
        words = list(found)
        for at in range(0, len(words), OUT_ROWS):
            part = words[at : at + OUT_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([found[w] for w in part])], names=["word", "n"])

    short = sample.mapInArrow(count, "word string, n long").filter(F.octet_length("word") <= HEAD_BYTES)
    counted = short.groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.filter("n >= 3").orderBy(F.desc("n"), "word").limit(limit)
    return [r.word for r in top.select("word").collect()]


def frequencies(source: DataFrame, path: str, head: dict[str, int]) -> DataFrame:
    """Per document one row without a word (doc_id, n_bytes, tokens of head words and special strings) and one row
    (word, n) for each of its other pre-tokens; ``row`` ties them."""
    known = source.sparkSession.sparkContext.broadcast(head)
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"row long, word string, n long, doc_id {id_type}, n_bytes long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, pieces, row = bpe.load(path), known.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            id_kind = batch.column("doc_id").type
            rows, words, ns, ids, sizes = [], [], [], [], []

            def flush() -> pa.RecordBatch:
                kinds = (pa.int64(), pa.string(), pa.int64(), id_kind, pa.int64())
                columns = [pa.array(v, k) for v, k in zip((rows, words, ns, ids, sizes), kinds)]
                return pa.RecordBatch.from_arrays(columns, names=["row", "word", "n", "doc_id", "n_bytes"])

            for key, size, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_bytes", "text"))):
                found, special = coder.pieces_of(text)
                total, first = len(special), len(rows)
                rows.append(row)
                words.append(None)
                ns.append(0)
                for word, n in Counter(found).items():
                    if (count := pieces.get(word)) is None:
                        words.append(word)
                        ns.append(n)
                    else:
                        total += n * count
                ns[first] = total
                more = len(words) - first - 1
                rows += [row] * more
                ids += [key] + [None] * more
                sizes += [size] + [None] * more
                row += 1
                if len(rows) >= OUT_ROWS:
                    yield flush()
                    rows, words, ns, ids, sizes = [], [], [], [], []
            if rows:
                yield flush()

    return source.mapInArrow(count, schema)


def piece_counts(words: DataFrame, path: str) -> DataFrame:
    """(word, pieces) of distinct pre-tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(path)
        for batch in batches:
            words = batch.column("word")
            lengths = [len(coder.encode_word(w)) for w in words.to_pylist()]
            yield pa.RecordBatch.from_arrays([words, pa.array(lengths, pa.int64())], names=["word", "pieces"])

    return words.mapInArrow(count, "word string, pieces long")


def token_counts(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    head: int = HEAD_WORDS,
) -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_tokens).

    Null and empty texts count 0 and 0; a special string inside a text counts one token; repeated rows are counted
    each; only id and text are read.  An empty table gives an empty result.
    """
    text = text_of(docs, text_col)
    source = docs.select(
        column(docs, id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    coder = bpe.load(path)
    ahead = {word: len(coder.encode_word(word)) for word in head_words(source, path, sample_docs, head)}
    stored = staged(frequencies(source, path, ahead), "pretokens")
    rare = stored.filter("word is not null").select("row", "word", "n")
    counted = piece_counts(rare.select("word").distinct(), path)
    tokens = rare.join(counted, "word").select("row", (F.col("n") * F.col("pieces")).alias("n"))
    base = stored.filter("word is null").select("row", "n", "doc_id", "n_bytes")
    return (
        tokens.select("row", "n", F.lit(None).cast(base.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"))
        .unionByName(base)
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
        .drop("row")
    )

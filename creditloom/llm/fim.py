"""Fill-in-middle by a learned rank index over token boundaries.

The boundaries of a text's tokens (ASCII letter runs, other code points one by one) are n + 1 growing offsets.  A few
straight segments predict the offset of a rank; a segment is kept whole while its prediction is at most ``MAX_ERROR``
off, otherwise it is halved, so every prediction's error fits one stored signed byte.  A cut is the prediction of its
segment plus the stored residual, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import by_batch, column, text_of

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Largest distance of a prediction from the true offset; residuals are signed bytes.
MAX_ERROR = 127
#: Fixed-point bits of a slope.
SCALE = 20


class RankIndex(NamedTuple):
    """Segments (first rank, offset there, slope) in the order of their ranks, and a residual for every rank."""

    ranks: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    @property
    def tokens(self) -> int:
        return len(self.residuals) - 1

    def offset(self, rank: int) -> int:
        """The exact offset of a boundary: prediction of its segment, corrected by the residual."""
        at = int(np.searchsorted(self.ranks, rank, side="right")) - 1
        steps = rank - int(self.ranks[at])
        return int(self.offsets[at]) + (int(self.slopes[at]) * steps >> SCALE) + int(self.residuals[rank])


def boundaries(text: str) -> np.ndarray:
    """Offsets (code points) of all token boundaries, 0 and the text's length included."""
    if text.isascii():
        codes = np.frombuffer(text.encode(), np.uint8)
    else:
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    letter = ((codes | 32) - codes.dtype.type(97)) < 26  # unsigned: what lies below "a" wraps around
    inside = np.zeros(len(codes) + 1, bool)
    np.logical_and(letter[1:], letter[:-1], out=inside[1:-1])
    return np.flatnonzero(~inside)


def fit(offsets: np.ndarray, max_error: int = MAX_ERROR) -> RankIndex:
    """Segments over the ranks of ``offsets``, level by level: blocks whose line strays further than ``max_error`` are
    halved until every line holds."""
    n = len(offsets)
    residuals = np.zeros(n, np.int8)
    starts, ends = np.array([0]), np.array([n])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(starts):
        slopes = ((offsets[ends - 1] - offsets[starts]) << SCALE) // np.maximum(ends - 1 - starts, 1)
        sizes = ends - starts
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        steps = np.arange(sizes.sum()) - first
        ranks = np.repeat(starts, sizes) + steps
        error = offsets[ranks] - np.repeat(offsets[starts], sizes) - (np.repeat(slopes, sizes) * steps >> SCALE)
        holds = np.maximum.reduceat(np.abs(error), np.cumsum(sizes) - sizes) <= max_error
        good = np.repeat(holds, sizes)
        residuals[ranks[good]] = error[good]
        found.append((starts[holds], offsets[starts[holds]], slopes[holds]))
        starts, ends = starts[~holds], ends[~holds]
        halves = (starts + ends) // 2
        starts, ends = np.concatenate([starts, halves]), np.concatenate([halves, ends])
    ranks, firsts, slopes = (np.concatenate(part) for part in zip(*found))
    order = np.argsort(ranks)
    return RankIndex(ranks[order], firsts[order], slopes[order], residuals)


def _hashes(id_column: Column) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``1:`` and the decimal id, as numbers."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row, whole texts.

    ``n`` counts the tokens; ``form`` is plain, psm or spm; the two lengths are code points, null where plain.  A null
    text is the empty text, which is plain, and so is a text that holds one of the marks.  A null id hashes as an empty
    one.  Repeated rows are each returned, an empty table gives an empty result; other columns are not read.
    """
    source = docs.select(
        column(docs, id_col).alias("doc_id"), text_of(docs, text_col).alias("text"), *_hashes(column(docs, id_col))
    )
    id_type = source.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = [
            arranged(text.as_py(), *numbers)
            for text, *numbers in zip(batch.column("text"), *(batch.column(f"h{k}").to_pylist() for k in (1, 2, 3, 4)))
        ]
        n, form, prefix, middle, output = zip(*made)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.string()),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    schema = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return by_batch(source, work, schema)


def arranged(text: str, h1: int, h2: int, h3: int, h4: int) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix length, middle length, output) of one text."""
    index = fit(boundaries(text))
    n = index.tokens
    if not text or h3 % 100 >= 90 or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    start, end = (index.offset(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if h4 % 100 < 20:
        return n, "spm", start, end - start, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", start, end - start, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from.  Marks have no common border, so their first occurrences are the inserted ones."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, len(first) + 1, F.length(output))
        tail = F.split_part(rest, F.lit(second), F.lit(2))
        return (
            F.split_part(rest, F.lit(second), F.lit(1)),
            F.split_part(tail, F.lit(MIDDLE), F.lit(1)),
            F.split_part(tail, F.lit(MIDDLE), F.lit(2)),
        )

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    late_suffix, late_prefix, late_middle = parts(SUFFIX, PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(late_prefix, late_middle, late_suffix))
        .otherwise(output)
    )


def sql() -> str:
    """The same rows by lists of tokens; the text rebuilt is the text."""
    return """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, t, tokens, len(tokens) AS n,
           CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
           CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM cut
), spans AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parted AS (
    SELECT doc_id, t, n, form, array_to_string(tokens[1:i], '') AS p, array_to_string(tokens[i + 1:j], '') AS m,
           array_to_string(tokens[j + 1:n], '') AS s
    FROM spans
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parted
"""

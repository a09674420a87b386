"""Exact duplicates through sharded cuckoo-filter indexes of live digests."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import column, parts, staged, text_of, unused

SLOTS = 4
MAX_KICKS = 500
DIGESTS_PER_SHARD = 250_000
LOWEST_ID = -(2**63)


class CuckooIndex:
    """Cuckoo filter over digests with the stored keys behind it.

    A bucket holds four 16-bit fingerprints.  A fingerprint match is only a hint: it counts when the key stored for
    that slot (digest and byte length of the content) is the same.  Deleting frees the slot.  When an insertion finds
    no room after ``MAX_KICKS`` moves, the table doubles and is refilled from the stored keys.
    """

    def __init__(self, capacity: int = 1024):
        self.keys: list[bytes | None] = []
        self.values: list = []
        self.free: list[int] = []
        self.resizes = 0
        size = 2
        while size * SLOTS * 0.9 < capacity:
            size *= 2
        self._clear(size)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = array("H", bytes(2 * SLOTS * buckets))
        self.entries = array("q", bytes(8 * SLOTS * buckets))

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[:2], "little") or 1
        first = int.from_bytes(key[2:8], "little") & self.mask
        return mark, first, (first ^ mark * 0x5BD1E995) & self.mask

    def _slot(self, key: bytes) -> int:
        mark, first, second = self._places(key)
        marks, entries, keys = self.marks, self.entries, self.keys
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if marks[slot] == mark and keys[entries[slot]] == key:
                    return slot
        return -1

    def get(self, key: bytes):
        """The value of a live key, or None."""
        slot = self._slot(key)
        return None if slot < 0 else self.values[self.entries[slot]]

    def delete(self, key: bytes) -> bool:
        slot = self._slot(key)
        if slot < 0:
            return False
        entry = self.entries[slot]
        self.marks[slot] = 0
        self.keys[entry] = self.values[entry] = None
        self.free.append(entry)
        return True

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not live."""
        if self.free:
            entry = self.free.pop()
            self.keys[entry], self.values[entry] = key, value
        else:
            entry = len(self.keys)
            self.keys.append(key)
            self.values.append(value)
        if not self._place(key, entry):
            self._grow()

    def _place(self, key: bytes, entry: int) -> bool:
        mark, bucket, second = self._places(key)
        marks, entries = self.marks, self.entries
        for at in (bucket, second):
            for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                if not marks[slot]:
                    marks[slot], entries[slot] = mark, entry
                    return True
        for kick in range(MAX_KICKS):
            slot = bucket * SLOTS + (kick * 7 + mark) % SLOTS
            mark, marks[slot] = marks[slot], mark
            entry, entries[slot] = entries[slot], entry
            bucket = (bucket ^ mark * 0x5BD1E995) & self.mask
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not marks[slot]:
                    marks[slot], entries[slot] = mark, entry
                    return True
        return False  # the entry in hand has no slot; the caller refills from the stored keys

    def _grow(self) -> None:
        buckets = self.mask + 1
        placed = False
        while not placed:
            buckets *= 2
            self.resizes += 1
            self._clear(buckets)
            placed = all(self._place(key, e) for e, key in enumerate(self.keys) if key is not None)

    def live(self) -> Iterator[tuple[bytes, object]]:
        return ((k, v) for k, v in zip(self.keys, self.values) if k is not None)


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, digest) per row, stored; the digest is the text's SHA-256 and its byte length, ``row`` tells
    repeated rows apart."""
    text = text_of(docs, text_col)
    length = F.lpad(F.hex(F.octet_length(text)), 16, "0")
    digest = F.unhex(F.concat(F.sha2(text, 256), length))
    return staged(
        docs.select(
            F.monotonically_increasing_id().alias("row"), column(docs, id_col).alias("doc_id"), digest.alias("digest")
        ),
        "digests",
    )


#: Rows a task gathers before it merges them; what it holds are its different digests and so many rows.
MERGE_ROWS = 50_000


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within a task become one row, so a text that is a third of the corpus is a row per task."""
    names = ["digest", "rank", "row", "n"]

    def merged(parts: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(parts).sort_by([("rank", "ascending"), ("row", "ascending")])
        out = t.group_by("digest", use_threads=False).aggregate([("rank", "last"), ("row", "last"), ("n", "sum")])
        return out.select(["digest", "rank_last", "row_last", "n_sum"]).rename_columns(names)

    parts, waiting = [], 0
    for batch in batches:
        rank = pc.fill_null(batch.column("doc_id").cast(pa.int64()), LOWEST_ID)
        ones = pa.array(np.ones(batch.num_rows, np.int64))
        parts.append(pa.table([batch.column("digest"), rank, batch.column("row"), ones], names=names))
        waiting += batch.num_rows
        if waiting >= MERGE_ROWS:
            parts, waiting = [merged(parts)], 0
    if parts:
        yield from merged(parts).combine_chunks().to_batches(max_chunksize=10_000)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Insert one shard's digests; a later document replaces the live entry by deleting it."""
    index = CuckooIndex()
    for batch in batches:
        for key, rank, row, n in zip(*(c.to_pylist() for c in batch.columns)):
            live = index.get(key)
            if live is None:
                index.insert(key, (rank, row, n))
            elif (rank, row) > live[:2]:
                index.delete(key)
                index.insert(key, (rank, row, n + live[2]))
            else:
                live = (*live[:2], n + live[2])
                index.delete(key)
                index.insert(key, live)
    rows = []
    for key, (rank, row, n) in index.live():
        if n > 1:
            rows.append((key, None if rank == LOWEST_ID else rank, row, n))
    for at in range(0, len(rows), 10_000):
        keys, ids, kept, sizes = zip(*rows[at : at + 10_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(kept, pa.int64()), pa.array(sizes, pa.int64())],
            names=["digest", "keep_id", "keep_row", "group_size"],
        )


def copy_groups(prints: DataFrame) -> DataFrame:
    """Digests held by several rows: (digest, keep_id, keep_row, group_size)."""
    spark = prints.sparkSession
    shards = parts(spark, prints.count(), DIGESTS_PER_SHARD)
    combined = prints.mapInArrow(_combine, "digest binary, rank long, row long, n long")
    return combined.repartition(shards, "digest").mapInArrow(
        _shard, "digest binary, keep_id long, keep_row long, group_size long"
    )


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (row, doc_id, digest, keep_id, group_size, kept).

    Texts are equal when identical byte for byte; a null text is the empty text.  Of equal texts the row with the
    largest id stays, a null id being the smallest; of rows that repeat id and text, one stays.  Ids must be integers.
    An empty table gives an empty result.
    """
    prints = fingerprinted(docs, id_col, text_col)
    return (
        prints.join(copy_groups(prints), "digest", "left")
        .select(
            "row",
            "doc_id",
            "digest",
            F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
        )
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`copies` drops; columns stay as they are, whatever their names.  Rows join
    on digest and id together, so a hot text spreads over its ids."""
    text, mark, key = text_of(docs, text_col), unused(docs, "digest"), unused(docs, "dropped_id")
    length = F.lpad(F.hex(F.octet_length(text)), 16, "0")
    judged = staged(copies(docs, id_col, text_col), "copies")
    dropped = judged.filter("not kept").select(F.col("digest").alias(mark), F.col("doc_id").alias(key))
    repeated = judged.filter("group_size > 1").groupBy("digest", "doc_id").agg(F.max("kept").alias("k"), F.count("*").alias("n"))
    repeated = repeated.filter("k and n > 1").select(F.col("digest").alias(mark), F.col("doc_id").alias(key))
    marked = docs.withColumn(mark, F.unhex(F.concat(F.sha2(text, 256), length)))

    def same(other: DataFrame):
        return (marked[mark] == other[mark]) & column(marked, id_col).eqNullSafe(other[key])

    rest = marked.join(dropped, same(dropped), "left_anti")
    if not repeated.isEmpty():
        doubled = marked.join(repeated, same(repeated), "left_semi").dropDuplicates([mark, id_col])
        rest = rest.unionByName(doubled)
    return rest.drop(mark)

"""Repeated byte strings by suffix arrays over anchor shards.

A text's windows of ``width`` bytes are grouped by anchors: the window's 32-byte gram of smallest hash.  Neighbouring
windows share an anchor, and equal windows have equal anchors, so a *run* (the windows of one anchor, one string of less
than two widths) meets all its equals among the strings of its anchor.  Only anchors that occur twice matter; of equal
strings one is sorted.  Shards of whole anchors build a suffix array by two-stage sorting, and windows whose common
prefix with a neighbour reaches the width are repeated.  An anchor with more than ``HOT`` different strings around it is
not gathered: its windows are counted one by one, by digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm import screens
from creditloom.llm.common import by_batch, column, parts, staged, text_of

WIDTH = 200
GRAM = 32
#: Different strings of one anchor that are sorted together, 5 MB at most or so.
HOT = 20_000
#: Bytes sorted at once, and bytes hashed at once.
SORT_BYTES, HASH_BYTES = 1 << 20, 1 << 17
#: Strings a shard holds on average at most.
STRINGS_PER_SHARD = 50_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


# -- runs -----------------------------------------------------------------------------------------------------------


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a multiple of 8) at every position."""
    n = len(data) - gram + 1
    loads = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = loads[:n] * _ODD[0]
    for at in range(8, gram, 8):
        h ^= h >> np.uint64(29)
        h += loads[at : at + n]
        h *= _ODD[at // 8 % 4]
    h ^= h >> np.uint64(32)
    h *= _ODD[1]
    h ^= h >> np.uint64(29)
    return h


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` neighbours, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // size) * size, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, size)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - size + 1], before[size - 1 : n])


def window_hashes(h: np.ndarray, at: np.ndarray, width: int, gram: int, odd: int) -> np.ndarray:
    """A hash of the windows at some positions, from the gram hashes that cover them."""
    total = np.zeros(len(at), np.uint64)
    for k, offset in enumerate([*range(0, width - gram, gram), width - gram]):
        total = (total ^ (total >> np.uint64(31))) * _ODD[odd] + h[at + offset] * _ODD[(k + odd) % 4]
    total ^= total >> np.uint64(32)
    return total * _ODD[odd]


def runs_of(data: bytes, ends: np.ndarray, width: int, gram: int):
    """Runs of the texts in ``data`` that end at ``ends``: (text number, start in data, windows, key, string id)."""
    starts = np.concatenate([[0], ends[:-1]])
    if len(data) < width or not (ends - starts >= width).any():
        return None
    h = gram_hashes(data, gram)
    spots = sliding_minimum((h & _HIGH) | np.arange(len(h), dtype=np.uint64), width - gram + 1) & _LOW
    change = np.zeros(len(data) + 1, np.int32)
    long_enough = ends - starts >= width
    change[starts[long_enough]] += 1
    change[ends[long_enough] - width + 1] -= 1
    windows = np.flatnonzero(np.cumsum(change[: len(spots)]))
    spots = spots[windows].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(spots) != 0) | (np.diff(windows) != 1)]))
    sizes = np.diff(np.append(first, len(windows)))
    at = windows[first]
    ids = window_hashes(h, at, width, gram, 2) + window_hashes(h, at + sizes - 1, width, gram, 3)
    return np.searchsorted(ends, at, side="right"), at, sizes, h[spots[first]], ids


def hashed(column_: pa.Array, width: int, gram: int):
    """Runs of a binary column, in pieces of some texts: (bytes, first row, text ends in the bytes, runs)."""
    offsets = np.frombuffer(column_.buffers()[1], np.int32)[column_.offset : column_.offset + len(column_) + 1].astype(np.int64)
    values, row = column_.buffers()[2], 0
    while row < len(column_):
        last = int(np.searchsorted(offsets, offsets[row] + HASH_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(column_))
        data = values[int(offsets[row]) : int(offsets[last])].to_pybytes() if offsets[last] > offsets[row] else b""
        found = runs_of(data, offsets[row + 1 : last + 1] - offsets[row], width, gram)
        if found is not None:
            yield data, row, offsets[row:last] - offsets[row], found
        row = last


# -- suffix array -----------------------------------------------------------------------------------------------------


def two_stage_order(data: bytes, wanted: np.ndarray, width: int) -> np.ndarray:
    """Positions of the wanted suffixes in the order of their first ``width`` bytes.

    A suffix smaller than its successor is sorted directly.  The others are induced: buckets of first bytes are scanned
    in order, and every entry puts its predecessor, if that is larger, behind those its own bucket already has.  Only
    what the wanted suffixes are induced from is sorted beside them.
    """
    marked = data + b"\xff"  # larger than any byte of UTF-8, so the last suffix is smaller than its successor
    text = np.frombuffer(marked + b"\x00", np.uint8)
    n = len(data)
    step = np.diff(text[: n + 1].astype(np.int16))
    unequal = np.flatnonzero(step)  # the last byte differs from the mark, so every byte has an unequal one ahead
    smaller = np.repeat(step[unequal] > 0, np.diff(unequal, prepend=-1))
    bases = np.flatnonzero(smaller)
    next_base = np.repeat(bases, np.diff(bases, prepend=-1))
    ends = next_base[wanted] + 1  # each wanted suffix is induced from the next smaller one
    needed = np.cumsum(np.bincount(wanted, minlength=n + 1) - np.bincount(ends, minlength=n + 1))[:n] > 0
    direct = np.flatnonzero(needed & smaller)
    direct = np.array(sorted(direct.tolist(), key=lambda p: marked[p : p + width]), np.int64)
    induced = needed & ~smaller
    heads = text[direct]
    cuts = np.searchsorted(heads, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for byte in range(256):
        larger = waiting[byte]
        at = np.concatenate(larger) if larger else direct[:0]
        bucket = []
        while len(at):
            bucket.append(at)
            before = at[at > 0] - 1
            at = before[induced[before] & (text[before] == byte)]
        bucket.append(direct[cuts[byte] : cuts[byte + 1]])
        entries = np.concatenate(bucket)
        if not len(entries):
            continue
        order.append(entries)
        before = entries[entries > 0] - 1
        before = before[induced[before] & (text[before] > byte)]
        by = text[before]
        sort = np.argsort(by, kind="stable")
        before, by = before[sort], by[sort]
        edges = np.flatnonzero(np.diff(by)) + 1
        for part in np.split(before, edges) if len(before) else []:
            waiting[text[part[0]]].append(part)
    everything = np.concatenate(order) if order else direct
    is_wanted = np.zeros(n, bool)
    is_wanted[wanted] = True
    return everything[is_wanted[everything]]


def common_prefixes(data: bytes, order: np.ndarray, width: int) -> np.ndarray:
    """Common prefix of each suffix in the order with the one before it, up to ``width`` bytes; the first has none."""
    words = np.ndarray((len(data) + width + 1,), "<u8", data + bytes(width + 8), strides=(1,))
    common = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for at in range(0, width, 8):
        differ = words[order[alive] + at] ^ words[order[alive - 1] + at]
        apart = differ != 0
        last, differ = alive[apart], differ[apart]
        for byte in range(1, 8):  # equal bytes before the first different one
            common[last] += differ & np.uint64((1 << 8 * byte) - 1) == 0
        alive = alive[~apart]
        common[alive] += 8
    return np.minimum(common, width)


def repeated_windows(strings: list[bytes], width: int) -> list[np.ndarray]:
    """For each of some different strings, which of its windows start anywhere else in them."""
    data = b"".join(strings)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.cumsum(lengths) - lengths
    counts = np.maximum(lengths - width + 1, 0)
    wanted = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    repeated = np.zeros(len(data) + 1, bool)
    if len(wanted):
        order = two_stage_order(data, wanted, width)
        long_enough = common_prefixes(data, order, width) >= width
        repeated[order[long_enough]] = True
        repeated[order[:-1][long_enough[1:]]] = True
    return [repeated[s : s + c] for s, c in zip(starts.tolist(), counts.tolist())]


def spans_of(flags: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Bytes covered by the flagged windows, as (start, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [(s, e + width - 1) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())]


# -- Spark ------------------------------------------------------------------------------------------------------------


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(doc, data): a text's bytes under 16 bytes of its SHA-256, the same in every job."""
    text = text_of(docs, text_col)
    return docs.select(F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("doc"), text.cast("binary").alias("data"))


def _runs(docs: DataFrame, text_col: str, width: int, gram: int) -> DataFrame:
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc = batch.column("doc")
        for _, row, starts, (texts, at, sizes, keys, ids) in hashed(batch.column("data"), width, gram):
            yield pa.RecordBatch.from_arrays(
                [
                    doc.take(pa.array(texts + row)),
                    pa.array((at - starts[texts]).astype(np.int32)),
                    pa.array(sizes.astype(np.int32)),
                    pa.array(keys.view(np.int64)),
                    pa.array(ids.view(np.int64)),
                ],
                names=["doc", "start", "windows", "key", "string"],
            )

    return by_batch(_texts(docs, text_col), work, "doc binary, start int, windows int, key long, string long")


def _places(docs: pa.Array, starts: np.ndarray, bits: int) -> np.ndarray:
    """Screen positions of (doc, start)."""
    heads = np.frombuffer(b"".join(docs.to_pylist()), "<u8")[::2]
    mixed = (heads + starts.astype(np.uint64) * _ODD[2]) * _ODD[3]
    return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64)


def _strings(docs: DataFrame, text_col: str, width: int, gram: int, chosen, hot, chosen_bits: int, hot_bits: int) -> DataFrame:
    """(shard key, key, string, windows, hot, data) of the chosen runs; a task sends a string once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            doc = batch.column("doc")
            for data, row, starts, (texts, at, sizes, keys, ids) in hashed(batch.column("data"), width, gram):
                begin = at - starts[texts]
                take = screens.passes(chosen.value, _places(doc.take(pa.array(texts + row)), begin, chosen_bits))
                at, sizes, keys, ids = (x[take] for x in (at, sizes, keys, ids))
                fresh = []
                for k, mark in enumerate((keys ^ ids * _ODD[0]).tolist()):
                    if mark not in sent:
                        sent.add(mark)
                        fresh.append(k)
                if not fresh:
                    continue
                at, sizes, keys, ids = (x[fresh] for x in (at, sizes, keys, ids))
                is_hot = screens.passes(hot.value, keys & np.uint64(hot_bits - 1))
                spread = np.where(is_hot, keys ^ ids * _ODD[1], keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(spread.view(np.int64)),
                        pa.array(keys.view(np.int64)),
                        pa.array(ids.view(np.int64)),
                        pa.array(is_hot),
                        pa.array([data[a : a + s + width - 1] for a, s in zip(at.tolist(), sizes.tolist())], pa.binary()),
                    ],
                    names=["shard", "key", "string", "hot", "data"],
                )

    schema = "shard long, key long, string long, hot boolean, data binary"
    return _texts(docs, text_col).mapInArrow(run, schema)


def _sorted_shards(strings: DataFrame, width: int, gram: int, shards: int) -> DataFrame:
    """Repeated spans (key, string, s, e) of the strings; of hot ones every window with its digest (w1, w2)."""

    def spans(group: list[tuple[int, int, bytes]]) -> Iterator[tuple]:
        for (key, string, _), flags in zip(group, repeated_windows([x[2] for x in group], width)):
            for s, e in spans_of(flags, width):
                yield key, string, s, e, None, None

    def windows(key: int, string: int, data: bytes) -> Iterator[tuple]:
        h = gram_hashes(data, gram)
        at = np.arange(len(data) - width + 1)
        one, two = (window_hashes(h, at, width, gram, odd).view(np.int64).tolist() for odd in (0, 1))
        for s, (w1, w2) in enumerate(zip(one, two)):
            yield key, string, s, s + width, w1, w2

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        group: list[tuple[int, int, bytes]] = []
        size, last, shard_before = 0, None, None
        for batch in batches:
            for shard, key, string, hot, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, string) == last:
                    continue
                last = (key, string)
                if hot:
                    yield from windows(key, string, data)
                    continue
                if size >= SORT_BYTES and shard != shard_before:
                    yield from spans(group)
                    group, size = [], 0
                shard_before = shard
                group.append((key, string, data))
                size += len(data)
        if group:
            yield from spans(group)

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    names = ["key", "string", "s", "e", "w1", "w2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in found(batches):
            rows.append(row)
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    dealt = strings.repartition(shards, "shard").sortWithinPartitions("shard", "key", "string")
    return dealt.mapInArrow(run, "key long, string long, s int, e int, w1 long, w2 long")


def _key_bits(df: DataFrame, bits: int) -> np.ndarray:
    return screens.packed(df, F.col("key").bitwiseAND(F.lit(bits - 1)), bits)


def repeated_spans(
    docs: DataFrame, text_col: str = "text", width: int = WIDTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """(doc, runs): for every text with repeated windows, runs of (start, spans from there on)."""
    spark = docs.sparkSession
    runs = staged(_runs(docs, text_col, width, gram), "runs")
    twice = runs.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    bits = screens.bits_for(runs.count() // 4)
    known = spark.sparkContext.broadcast(_key_bits(twice, bits))

    def screened(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = batch.column("key").to_numpy().view(np.uint64) & np.uint64(bits - 1)
        yield batch.filter(pa.array(screens.passes(known.value, keys)))

    candidates = by_batch(runs, screened, runs.schema.simpleString()[7:-1].replace(":", " "))
    strings = staged(
        candidates.groupBy("key", "string").agg(
            F.count("*").alias("n"), F.min(F.struct("doc", "start", "windows")).alias("first")
        ),
        "strings",
    )
    n_strings = strings.count()
    chosen_bits, hot_bits = screens.bits_for(n_strings), screens.bits_for(n_strings // (hot + 1), 64)

    def placed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = _places(batch.column("doc"), batch.column("start").to_numpy(), chosen_bits)
        yield pa.RecordBatch.from_arrays([pa.array(at)], names=["p"])

    places = by_batch(strings.select("first.doc", "first.start"), placed, "p long")
    chosen = spark.sparkContext.broadcast(screens.packed(places, F.col("p"), chosen_bits))
    crowded = strings.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot)
    crowd = spark.sparkContext.broadcast(_key_bits(crowded, hot_bits))
    found = staged(
        _sorted_shards(
            _strings(docs, text_col, width, gram, chosen, crowd, chosen_bits, hot_bits),
            width,
            gram,
            parts(spark, n_strings, STRINGS_PER_SHARD),
        ),
        "repeats",
    )
    one_by_one = found.filter("w1 IS NOT NULL")
    shared = one_by_one.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    spans = (
        found.filter("w1 IS NULL")
        .select("key", "string", "s", "e")
        .unionByName(one_by_one.join(shared, ["w1", "w2"], "left_semi").select("key", "string", "s", "e"))
        .unionByName(
            strings.filter("n > 1").select(
                "key", "string", F.lit(0).alias("s"), (F.col("first.windows") + F.lit(width - 1)).alias("e")
            )
        )
    )
    # Stored, so that the join below shuffles both sides and can split a string that occurs very often.
    cover = staged(spans.groupBy("key", "string").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "cover")
    return (
        candidates.join(cover, ["key", "string"])
        .groupBy("doc")
        .agg(F.collect_set(F.struct("start", "spans")).alias("runs"))
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
    hot: int = HOT,
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the maximal runs of removed bytes (start, end) and the bytes left.

    A byte goes if a string of ``width`` bytes that covers it also starts anywhere else, in the same text or another.
    ``gram`` is a multiple of 8, at most half the width.  A null text is the empty text; texts shorter than the width
    keep all bytes.  Rows that repeat a text repeat its strings, so each of them loses all bytes, whatever the ids.  An
    empty table gives an empty result; other columns are not read.
    """
    if gram % 8 or not 8 <= gram <= width // 2:
        raise ValueError("gram must be a multiple of 8, at most half the width")
    text = text_of(docs, text_col)
    source = docs.select(
        column(docs, id_col).alias("doc_id"),
        F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("doc"),
        text.cast("binary").alias("data"),
    )
    joined = source.join(repeated_spans(docs, text_col, width, gram, hot), "doc", "left")
    id_type = source.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n_bytes, spans, kept = [], [], []
        for data, runs in zip(batch.column("data"), batch.column("runs").to_pylist()):
            data = data.as_py()
            merged: list[dict] = []
            for start, end in sorted((r["start"] + x["s"], r["start"] + x["e"]) for r in runs or () for x in r["spans"]):
                if merged and start <= merged[-1]["end"]:
                    merged[-1]["end"] = max(end, merged[-1]["end"])
                else:
                    merged.append({"start": start, "end": end})
            edges = [0, *(x for m in merged for x in (m["start"], m["end"])), len(data)]
            n_bytes.append(len(data))
            spans.append(merged)
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_bytes, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )

    schema = f"doc_id {id_type}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"
    return by_batch(joined.select("doc_id", "data", "runs"), work, schema)


def sql(width: int = WIDTH) -> str:
    """The same rows by counting every window of every text."""
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
    SELECT r, i, md5(substr(h, 2 * i + 1, {2 * width})) AS w
    FROM (SELECT r, h, unnest(range(0, len(h) // 2 - {width} + 1)) AS i FROM texts WHERE len(h) >= {2 * width})
), starts AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1
), marked AS (
    SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + {width}, -1) AS opens FROM starts
), spans AS (
    SELECT r, min(i) AS s, max(i) + {width} AS e
    FROM (SELECT r, i, sum(CAST(opens AS INT)) OVER (PARTITION BY r ORDER BY i) AS g FROM marked) GROUP BY r, g
), gaps AS (
    SELECT r, e AS s, lead(s) OVER (PARTITION BY r ORDER BY s) AS e FROM spans
    UNION ALL SELECT r, 0, min(s) FROM spans GROUP BY r
), left_over AS (
    SELECT texts.r, string_agg(substr(h, 2 * s + 1, 2 * (coalesce(e, len(h) // 2) - s)), '' ORDER BY s) AS h
    FROM gaps JOIN texts USING (r) GROUP BY texts.r
), removed AS (
    SELECT r, CAST(sum(e - s) AS BIGINT) AS n, count(*) AS spans FROM spans GROUP BY r
)
SELECT doc_id, len(texts.h) // 2 AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(left_over.h, texts.h))) AS kept_sha256
FROM texts LEFT JOIN removed USING (r) LEFT JOIN left_over USING (r)
"""

"""Near duplicates by 64-bit SimHash fingerprints, searched with BK-trees in shards of bounded size.

Of r + 1 blocks of the 64 bits, two fingerprints that differ in at most r bits agree in at least one.  A fingerprint
therefore goes to r + 1 shards, one per block, named by the block's leading bits; as many bits are used as leave a shard
some dozens of members, however many there are in all.  A shard that still holds too many is dealt out by blocks of the
bits that its members need not share.  A shard's members are put into a BK-tree one by one after a search of the radius
around them, and only the shard's spanning links leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import by_batch, column, staged, text_of, unused
from creditloom.llm.components import components

SEED = 42
HASHES_AT_ONCE = 1 << 16
#: Members a shard holds on average, and beyond which it is dealt out.
MEMBERS, CROWDED = 64, 4096


def fingerprint(text: str, width: int) -> int:
    """SimHash over shingles of ``width`` words: a bit is set if it is set in over half the shingles' hashes."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        part = slice(at, at + HASHES_AT_ONCE)
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[part], ends[part])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, content, fingerprint long) of whole texts, content being their digest; null counts as the empty text, whose
    fingerprint is zero."""
    text = text_of(docs, text_col)
    source = docs.select(column(docs, id_col).alias("doc_id"), _content(text).alias("content"), text.alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        prints = [signed(fingerprint(text.as_py(), width)) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("content"), pa.array(prints, pa.int64())],
            names=["doc_id", "content", "fingerprint"],
        )

    return by_batch(source, work, f"doc_id {id_type}, content binary, fingerprint long")


def _content(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


class BkTree:
    """Children hang on the edge of their integer Hamming distance to the parent."""

    def __init__(self, root: int):
        self.root = root
        self.children: dict[int, dict[int, int]] = {root: {}}

    def within(self, value: int, radius: int) -> list[int]:
        """Members at most ``radius`` bits away; only edges within the radius of the own distance are followed."""
        return [node for node, d in self.visited(value, radius) if d <= radius]

    def visited(self, value: int, radius: int) -> Iterator[tuple[int, int]]:
        """The members a search looks at, with their distances."""
        todo, children = [self.root], self.children
        while todo:
            node = todo.pop()
            d = (node ^ value).bit_count()
            yield node, d
            edges = children[node]
            if edges:
                for e in range(d - radius, d + radius + 1):
                    if e in edges:
                        todo.append(edges[e])

    def add(self, value: int) -> None:
        node = self.root
        while True:
            edges = self.children[node]
            d = (node ^ value).bit_count()
            if d not in edges:
                edges[d] = value
                self.children[value] = {}
                return
            node = edges[d]


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, smallest member of its group) for all but the smallest, groups being linked within the shard."""
    members = sorted(members)
    parent = {m: m for m in members}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    mask = (1 << 64) - 1
    tree = BkTree(members[0] & mask)
    for value in members[1:]:
        own = value
        for other in tree.within(value & mask, radius):
            a, b = top(signed(other)), top(own)
            parent[max(a, b)] = min(a, b)
        tree.add(value & mask)
    return [(m, top(m)) for m in members if top(m) != m]


def block_masks(fixed: int, blocks: int, bits: int = 64) -> list[int]:
    """``fixed`` with the leading ``bits`` bits of each of ``blocks`` equal blocks of the other bits."""
    free = [1 << b for b in reversed(range(64)) if not fixed >> b & 1]
    cuts = [len(free) * k // blocks for k in range(blocks + 1)]
    return sorted({fixed | sum(free[a : min(b, a + bits)]) for a, b in zip(cuts, cuts[1:])})


def _dealt(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """(mask, shard, fingerprint) with every mask replaced by finer ones.  A crowded shard leaves at least as many bits
    free as number its members, so blocks of blocks are few and their table is small whatever the corpus."""
    finer = [(signed(mask), [signed(m) for m in new]) for mask, new in masks.items()]
    finer = rows.sparkSession.createDataFrame(finer, "mask long, finer array<long>")
    dealt = rows.join(F.broadcast(finer), "mask").select(F.explode("finer").alias("mask"), "fingerprint")
    return dealt.withColumn("shard", F.col("fingerprint").bitwiseAND(F.col("mask"))).select("mask", "shard", "fingerprint")


def shards(prints: DataFrame, radius: int, members: int = MEMBERS, crowded: int = CROWDED) -> DataFrame:
    """(mask, shard, fingerprint): every fingerprint in each of its shards; two within the radius share at least one."""
    different = staged(prints.select("fingerprint").distinct(), "different")
    n = different.count()
    bits = max(0, (max(n, 1) // members).bit_length())
    rows = _dealt(different.select(F.lit(0).cast("long").alias("mask"), "fingerprint"), {0: block_masks(0, radius + 1, bits)})
    done = []
    while True:
        sizes = rows.groupBy("mask", "shard").agg(F.count("*").alias("n")).filter(F.col("n") > crowded)
        full = staged(sizes.select("mask", "shard"), "crowded")
        masks = [r.mask & (1 << 64) - 1 for r in full.select("mask").distinct().collect()]  # few: blocks of blocks
        if not masks:
            break
        done.append(rows.join(full, ["mask", "shard"], "left_anti").select("mask", "shard", "fingerprint"))
        held = rows.join(full, ["mask", "shard"], "left_semi")
        rows = staged(_dealt(held, {m: block_masks(m, radius + 1) for m in masks}), "shards")
    for part in done:
        rows = rows.unionByName(part)
    return rows


def links(prints: DataFrame, radius: int, members: int = MEMBERS, crowded: int = CROWDED) -> DataFrame:
    """Spanning links (a, b) between different fingerprints at most ``radius`` bits apart."""
    if not 0 <= radius < 8:
        raise ValueError("radius must be 0 to 7")
    groups = (
        shards(prints, radius, members, crowded)
        .groupBy("mask", "shard")
        .agg(F.collect_list("fingerprint").alias("members"))
        .filter(F.size("members") > 1)
    )

    def search(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = {link for members in batch.column("members").to_pylist() for link in shard_links(members, radius)}
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return by_batch(groups.select("members"), search, "a long, b long")


def near_copies(
    docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: (doc_id, fingerprint long, component_id).

    Documents are linked when their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest
    id reachable by links, the own one included (null only if all ids of the component are null).  Texts without words
    have fingerprint zero and link like any other.  Repeated rows are each returned; an empty table gives an empty
    result; other columns are not read.
    """
    return _judged(docs, width, radius, id_col, text_col).select("doc_id", "fingerprint", "component_id")


def _judged(docs: DataFrame, width: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """:func:`near_copies` with the digest of each text and ``kept``, that of the document that stays: the one with the
    smallest id, null ids being the largest and ties going to the smallest fingerprint and digest."""
    prints = staged(fingerprints(docs, width, id_col, text_col), "fingerprints")
    joined = components(links(prints, radius))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint", "content"))
    smallest = prints.groupBy("fingerprint").agg(least.alias("first"))
    rooted = smallest.join(joined, smallest["fingerprint"] == joined["node"], "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("root")
    )
    kept = rooted.groupBy("root").agg(F.min("first").alias("kept"))
    named = rooted.join(kept, "root").select(
        "fingerprint", F.col("kept.doc_id").alias("component_id"), F.col("kept.content").alias("kept")
    )
    return prints.join(staged(named, "components"), "fingerprint")


def drop_near_copies(
    docs: DataFrame, width: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id (null ids are the largest, ties go to the
    smallest fingerprint and text digest); columns stay as they are.

    Rows are judged each by its own text, so near copies that share an id or have none go as well, and rows of one id in
    different components stay.  Rows that repeat the id and text that stay are one document and all stay; null and empty
    texts have fingerprint zero and are near copies of each other.  An empty table gives an empty result.
    """
    judged = _judged(docs, width, radius, id_col, text_col)
    goes = ~(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("content") == F.col("kept")))
    dropped = judged.filter(goes).select(F.col("doc_id").alias("dropped"), F.col("content").alias("dropped_content"))
    dropped = staged(dropped.distinct(), "near-copies")
    ids = dropped.select("dropped").distinct()
    stays = judged.filter(~goes).select(F.col("doc_id").alias("mixed")).distinct()
    mixed = staged(stays.join(ids, F.col("mixed").eqNullSafe(F.col("dropped")), "left_semi"), "mixed-ids")
    sure = ids.join(mixed, F.col("dropped").eqNullSafe(F.col("mixed")), "left_anti")
    left = docs.join(sure, column(docs, id_col).eqNullSafe(sure["dropped"]), "left_anti")
    if mixed.isEmpty():
        return left
    # Ids of which some rows stay and others go: these rows are told apart by their texts.
    is_mixed = column(left, id_col).eqNullSafe(mixed["mixed"])
    own = unused(docs, "own_content")
    unsure = left.join(mixed, is_mixed, "left_semi").withColumn(own, _content(text_of(left, text_col)))
    same = column(unsure, id_col).eqNullSafe(dropped["dropped"]) & (unsure[own] == dropped["dropped_content"])
    unsure = unsure.join(dropped, same, "left_anti").drop(own)
    return left.join(mixed, is_mixed, "left_anti").unionByName(unsure)

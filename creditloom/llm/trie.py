"""Prefix trie of conversations, screened by a count-min sketch of prefix digests.

A prefix is known by the running sums of the hashes of (depth, turn), which add up across blocks of a conversation, so a
conversation of any length is numbered and hashed by many tasks.  A count-min sketch holds how often each prefix digest
occurs.  An estimate of one proves that a prefix has one conversation, and so have all longer ones of it: such tails are
emitted where they are.  Only prefixes that may be shared are shuffled and grouped.  Sums over subtrees climb the shared
nodes by doubled steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm import screens
from creditloom.llm.common import by_batch, column, parts, staged, text_of

#: Rows of the sketch, and the largest number of counters of a row: one bit each (more than one, or not) is broadcast.
ROWS, MAX_COUNTERS = 3, 1 << 26
#: Turns numbered by one task on average at most.
TURNS_PER_PART = 500_000
#: Ids of one node are joined to text in ranges of 2^16.
ID_RANGE_BITS = 16
WORDS = r"[^\x20\x09-\x0D]+"
SUMS = ["s1", "s2", "s3", "s4"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _node(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", depth.cast("string"), *[s.cast("string") for s in sums])))


def _pieces(depth: Column, turn: Column) -> list[Column]:
    """Four 32-bit hashes of a turn at a depth."""
    digest = F.sha2(F.concat(depth.cast("string"), F.lit(":"), F.hex(turn)), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"x{k + 1}") for k in range(4)]


def numbered(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(c, p, seq, turn, words), stored: turns in the order of ``seq`` within the blocks p of a conversation c.

    Ranges are cut between any two rows, so a conversation of any length, even of equal turns, lies in many blocks.
    """
    spark = conversations.sparkSession
    turns = conversations.select(
        column(conversations, id_col).cast("long").alias("c"),
        column(conversations, turn_col).alias("turn"),
        text_of(conversations, role_col).alias("role"),
        text_of(conversations, text_col).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).filter("c IS NOT NULL")
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    dealt = turns.repartitionByRange(parts(spark, conversations.count(), TURNS_PER_PART), *order)
    framed = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = dealt.sortWithinPartitions(*order).select(
        "c",
        F.monotonically_increasing_id().alias("seq"),
        F.unhex(F.sha2(framed, 256)).alias("turn"),
        F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"),
    )
    return staged(rows.withColumn("p", F.shiftright("seq", 33)), "turns")


def prefixes(turns: DataFrame, heads_of: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows (c, depth, length, turn, words, node, parent) of all prefixes, stored, and conversations (c, length).

    With ``heads_of`` n, a conversation c starts with the first h turns of conversation c - c % n (h = crc32 of its
    decimal id % 4; all if there are fewer, none if it is absent) and goes on with its own turns after the first h.
    Remainders have the sign of c.
    """
    blocks = turns.groupBy("c", "p").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    blocks = staged(blocks.withColumn("before", F.coalesce(before, F.lit(0))), "blocks")
    sizes = blocks.groupBy("c").agg(F.sum("n").alias("own"))
    if heads_of is None:
        convs = sizes.select("c", F.lit(0).alias("h"), F.col("c").alias("a"), F.lit(0).cast("long").alias("pre"), "own")
    else:
        h = F.crc32(F.col("c").cast("string").cast("binary")) % 4
        anchors = sizes.select(F.col("c").alias("a"), F.col("own").alias("there"))
        convs = (
            sizes.select("c", h.alias("h"), (F.col("c") - F.col("c") % heads_of).alias("a"), "own")
            .join(anchors, "a", "left")
            .select("c", "h", "a", F.least("h", F.coalesce("there", F.lit(0))).alias("pre"), "own")
        )
    length = F.col("pre") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = staged(convs.withColumn("length", length), "conversations")

    place = Window.partitionBy("c", "p").orderBy("seq")
    indexed = turns.withColumn("rank", F.row_number().over(place)).join(blocks, ["c", "p"])
    indexed = indexed.withColumn("idx", F.col("before") + F.col("rank"))
    zero = F.lit(0).cast("long")
    heads = None
    based = convs.select("c", "h", "pre", "length", *[zero.alias(f"b{k}") for k in (1, 2, 3, 4)])
    if heads_of is not None:
        upto = Window.partitionBy("a").orderBy("idx")
        heads = indexed.filter((F.col("c") % heads_of == 0) & (F.col("idx") <= 3)).withColumnRenamed("c", "a")
        heads = heads.select("a", "idx", "turn", "words", *_pieces(F.col("idx"), F.col("turn")))
        heads = staged(heads.select("*", *[F.sum(f"x{k}").over(upto).alias(f"b{k}") for k in (1, 2, 3, 4)]), "heads")
        ends = heads.select("a", F.col("idx").alias("pre"), "b1", "b2", "b3", "b4")
        based = convs.join(ends, ["a", "pre"], "left").select(
            "c", "h", "pre", "length", *[F.coalesce(f"b{k}", zero).alias(f"b{k}") for k in (1, 2, 3, 4)]
        )

    placed = blocks.join(based, "c")
    own = turns.withColumn("rank", F.row_number().over(place)).join(placed, ["c", "p"])
    own = own.filter(F.col("before") + F.col("rank") > F.col("h"))
    own = own.withColumn("depth", F.col("before") + F.col("rank") - F.col("h") + F.col("pre"))
    own = own.select("*", *_pieces(F.col("depth"), F.col("turn")))
    running = [(F.sum(f"x{k}").over(place) + F.col(f"b{k}")).alias(f"s{k}") for k in (1, 2, 3, 4)]
    keep = ["c", "p", "depth", "length", "turn", "words", "x1", "x2", "x3", "x4"]
    own = staged(own.select(*keep, *running, *[f"b{k}" for k in (1, 2, 3, 4)]), "own")
    # Blocks that continue a conversation: each begins a range partition, so there are fewer than partitions.
    cut = blocks.groupBy("c").agg(F.count("*").alias("k")).filter("k > 1").select("c")
    totals = own.join(F.broadcast(cut), "c", "left_semi").groupBy("c", "p")
    totals = totals.agg(*[F.max(F.col(f"s{k}") - F.col(f"b{k}")).alias(f"t{k}") for k in (1, 2, 3, 4)])
    earlier = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    later = totals.select("c", "p", *[F.sum(f"t{k}").over(earlier).alias(f"t{k}") for k in (1, 2, 3, 4)])
    own = own.join(F.broadcast(later.filter("t1 IS NOT NULL")), ["c", "p"], "left")
    own = own.select(
        *keep[:1], *keep[2:], *[(F.col(f"s{k}") + F.coalesce(f"t{k}", zero)).alias(f"s{k}") for k in (1, 2, 3, 4)]
    )
    if heads is not None:
        led = heads.join(convs.filter("pre > 0"), "a").filter("idx <= pre")
        led = led.select(
            "c", F.col("idx").alias("depth"), "length", "turn", "words", "x1", "x2", "x3", "x4",
            *[F.col(f"b{k}").alias(f"s{k}") for k in (1, 2, 3, 4)],
        )
        own = own.unionByName(led)
    sums = [F.col(s) for s in SUMS]
    up = [F.col(f"s{k}") - F.col(f"x{k}") for k in (1, 2, 3, 4)]
    rows = own.select(
        "c", F.col("depth").cast("long").alias("depth"), F.col("length").cast("long").alias("length"), "turn", "words",
        _node(F.col("depth"), sums).alias("node"), _node(F.col("depth") - 1, up).alias("parent"),
    )
    return staged(rows, "prefixes"), convs.select("c", F.col("length").cast("long").alias("length"))


def _cells(key: str, counters: int) -> list[Column]:
    """A counter in each row of the sketch, all rows in one sequence."""
    one, two = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    low = F.lit(counters - 1)
    places = [one.bitwiseAND(low), F.shiftrightunsigned(one, 32).bitwiseAND(low), two.bitwiseAND(low)]
    return [place + F.lit(row * counters) for row, place in enumerate(places)]


def screened(rows: DataFrame, max_counters: int = MAX_COUNTERS) -> DataFrame:
    """``rows`` with ``shared`` and ``parent_shared``: false where the sketch's estimate is one, which proves it.  The
    root counts as shared."""
    spark = rows.sparkSession
    counters = screens.bits_for(rows.count(), 8, max_counters)
    counts = rows.select(F.explode(F.array(*_cells("node", counters))).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    several = screens.packed(counts.filter("n > 1"), F.col("cell"), 1 << (ROWS * counters - 1).bit_length())
    sketch = spark.sparkContext.broadcast(several)
    own, up, names = _cells("node", counters), _cells("parent", counters), rows.columns
    asked = rows.select(
        "*", *[c.alias(f"own{k}") for k, c in enumerate(own)], *[c.alias(f"up{k}") for k, c in enumerate(up)]
    )

    def look(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        def estimate(kind: str) -> np.ndarray:
            cells = (batch.column(f"{kind}{k}").to_numpy() for k in range(ROWS))
            return np.logical_and.reduce([screens.passes(sketch.value, c) for c in cells])

        rooted = batch.column("depth").to_numpy() == 1
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(estimate("own")), pa.array(estimate("up") | rooted)],
            names=[*names, "shared", "parent_shared"],
        )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return by_batch(asked, look, f"{kinds}, shared boolean, parent_shared boolean")


def _ends_digest(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, c): ids are sorted and joined by id ranges, and a node's ranges stream through its
    hash in order."""
    ranges = (
        ends.groupBy("node", F.shiftright("c", ID_RANGE_BITS).alias("range"))
        .agg(F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("ids"))
        .repartition("node")
        .sortWithinPartitions("node", "range")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
            nodes, digests = zip(*done)
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"]
            )

        node, state = None, None
        for batch in batches:
            done = []
            for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if at == node:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256(ids.encode())
            if done:
                yield out(done)
        if state is not None:
            yield out([(node, state.hexdigest())])

    return ranges.select("node", "ids").mapInArrow(run, "node binary, ends_sha256 string")


def _subtrees(nodes: DataFrame, deepest: int) -> DataFrame:
    """(node, leaves, saved) summed over subtrees of nodes (node, up, leaves, saved): each round adds what lies 2^k
    levels lower and doubles the step."""
    step = 1
    while step < deepest:
        added = nodes.filter("up IS NOT NULL").groupBy(F.col("up").alias("node"))
        added = added.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = nodes.filter("up IS NOT NULL").select(F.col("node").alias("up"), F.col("up").alias("higher"))
        summed = nodes.join(added, "node", "left").select(
            "node",
            "up",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        nodes = staged(summed.join(above, "up", "left").select("node", F.col("higher").alias("up"), "leaves", "saved"), "climb")
        step *= 2
    return nodes.select("node", "leaves", "saved")


def prefix_trie(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    heads_of: int | None = None,
    max_counters: int = MAX_COUNTERS,
) -> DataFrame:
    """One row per distinct prefix of the conversations' turns (role, text), the textless root included.

    Columns: conv_id (smallest member), depth, parent_conv_id (the parent's; null for the root), n_convs, n_children,
    n_leaves (childless nodes of the subtree, itself included), saved_tokens (over the subtree, words of a node's turn
    times its members less one), ends_sha256 (SHA-256 of the ids of the conversations that end here, ascending, joined by
    commas) and turn (digest of the last turn, null for the root).

    Turns go by turn number, null first, then role and text; a null role or text is empty.  Rows that repeat a turn are
    turns of their own.  Rows without a conversation id belong to no conversation.  A conversation without turns (see
    ``heads_of`` in :func:`prefixes`) is a member of the root alone.  An empty table has no nodes, not even a root.
    """
    rows, convs = prefixes(numbered(conversations, id_col, turn_col, role_col, text_col), heads_of)
    everyone = convs.agg(
        F.count("*").alias("n"), F.min("c").alias("first"), F.count_if(F.col("length") == 0).alias("ends")
    ).first()
    one, zero, none = F.lit(1).cast("long"), F.lit(0).cast("long"), F.lit(None).cast("long")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn"]

    def tail(df: DataFrame, parent: Column) -> DataFrame:
        goes_on = F.col("depth") < F.col("length")
        return df.select(
            F.col("c").alias("conv_id"), "depth", parent.alias("parent_conv_id"), one.alias("n_convs"),
            F.when(goes_on, one).otherwise(zero).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
            F.when(goes_on, F.lit(NO_ENDS)).otherwise(F.sha2(F.col("c").cast("string"), 256)).alias("ends_sha256"), "turn",
        )

    judged = staged(screened(rows, max_counters), "judged")
    local = tail(judged.filter("NOT shared AND NOT parent_shared"), F.col("c"))
    open_ = judged.filter("shared OR parent_shared")
    alone = open_.filter("NOT shared").groupBy("c").agg(F.min("depth").alias("alone"))
    open_ = staged(open_.join(alone, "c", "left").drop("shared", "parent_shared"), "open")
    deeper = tail(open_.filter("depth > alone"), F.col("c"))
    edge = open_.filter("depth = alone")
    exact = open_.filter("alone IS NULL OR depth < alone")

    nodes = staged(
        exact.groupBy("node").agg(
            F.count("*").alias("n_convs"), F.min("c").alias("conv_id"), F.first("depth").alias("depth"),
            F.first("parent").alias("parent"), F.first("words").alias("words"), F.first("turn").alias("turn"),
        ),
        "nodes",
    )
    tails = edge.filter("depth > 1").groupBy("parent").agg(F.count("*").alias("tails"))
    inner = nodes.filter("depth > 1").groupBy("parent").agg(F.count("*").alias("inner"))
    below = inner.join(tails, "parent", "full").select(
        F.col("parent").alias("node"), F.coalesce("inner", zero).alias("inner"), F.coalesce("tails", zero).alias("tails")
    )
    ends = exact.filter("depth = length").select("node", "c")
    root_key = F.lit(b"")
    ends = ends.unionByName(convs.filter("length = 0").select(root_key.alias("node"), "c"))
    nodes = nodes.join(below, "node", "left").join(_ends_digest(ends), "node", "left")
    children = F.coalesce(F.col("inner") + F.col("tails"), zero)
    nodes = staged(
        nodes.select(
            "node", "parent", "conv_id", "depth", "n_convs", "turn", children.alias("n_children"),
            (F.coalesce("tails", zero) + F.when(children == 0, one).otherwise(zero)).alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        ),
        "nodes",
    )
    total = nodes.agg(
        F.coalesce(F.max("depth"), zero).alias("deepest"), F.coalesce(F.sum("leaves"), zero).alias("leaves"),
        F.coalesce(F.sum("saved"), zero).alias("saved"), F.count_if(F.col("depth") == 1).alias("inner"),
    ).first()
    first_tails = edge.filter("depth = 1").count()
    up = F.when(F.col("depth") > 1, F.col("parent"))
    summed = _subtrees(nodes.select("node", up.alias("up"), "leaves", "saved"), total.deepest)
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_id"))
    first = F.lit(everyone["first"]).cast("long")
    shared = nodes.drop("leaves", "saved").join(summed, "node").join(above, "parent", "left").select(
        "conv_id", "depth", F.when(F.col("depth") == 1, first).otherwise(F.col("parent_id")).alias("parent_conv_id"),
        "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256", "turn",
    )
    hung = edge.filter("depth > 1").join(above, "parent")
    children = total["inner"] + first_tails
    root_ends = _ends_digest(ends.filter(F.col("node") == root_key))
    if everyone["ends"] == 0:
        root_ends = conversations.sparkSession.createDataFrame([(b"", NO_ENDS)], "node binary, ends_sha256 string")
    root = root_ends.select(
        first.alias("conv_id"), zero.alias("depth"), none.alias("parent_conv_id"), F.lit(everyone["n"]).cast("long").alias("n_convs"),
        F.lit(children).cast("long").alias("n_children"),
        F.lit(total.leaves + first_tails + (children == 0)).cast("long").alias("n_leaves"),
        F.lit(total.saved).cast("long").alias("saved_tokens"), "ends_sha256", F.lit(None).cast("binary").alias("turn"),
    ).filter(F.lit(everyone["n"] > 0))
    out = [local, deeper, tail(edge.filter("depth = 1"), first), tail(hung, F.col("parent_id")), shared, root]
    result = out[0].select(*names)
    for part in out[1:]:
        result = result.unionByName(part.select(*names))
    return result


def sql() -> str:
    """The contract's rows by lists of turns; crc32 is computed bit by bit."""
    return r"""
WITH turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role_, text_) AS i,
           strlen(role_) || ':' || role_ || text_ AS t, text_
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role_, coalesce(text, '') AS text_
          FROM conversations WHERE conv_id IS NOT NULL)
), lists AS (
    SELECT c, list(t ORDER BY i) AS own, list(text_ ORDER BY i) AS texts,
           xor(list_reduce([4294967295] || list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)),
               lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 4 AS h
    FROM turns GROUP BY c
), built AS (
    SELECT l.c, coalesce(a.own[1:l.h], []) || l.own[l.h + 1:] AS seq, coalesce(a.texts[1:l.h], []) || l.texts[l.h + 1:] AS texts
    FROM lists l LEFT JOIN lists a ON a.c = l.c - l.c % 20
), nodes AS (
    SELECT d AS depth, CAST(seq[1:d] AS VARCHAR[]) AS key, min(c) AS conv_id, count(*) AS n_convs, any_value(texts[d]) AS last_text,
           string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(seq) = d) AS ends
    FROM (SELECT c, seq, texts, unnest(range(0, len(seq) + 1)) AS d FROM built) GROUP BY d, seq[1:d]
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id,
           (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.key[1:n.depth] = n.key) AS n_children,
           (n.n_convs - 1) * len(regexp_extract_all(coalesce(n.last_text, ''), '[^\x20\x09-\x0D]+')) AS saved
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.key[1:n.depth - 1] AND n.depth > 0
)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, count(*) FILTER (WHERE s.n_children = 0) AS n_leaves,
       CAST(sum(s.saved) AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM linked n JOIN linked s ON s.depth >= n.depth AND s.key[1:n.depth] = n.key
GROUP BY n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.ends
"""

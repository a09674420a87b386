"""Mix sources to target weights under a token budget, natively in Spark.

The budget flows down a tree domain -> language -> source.  A node's share follows its weight among its siblings but
never exceeds what its subtree can supply in ``max_epochs`` passes; what it cannot use goes to its siblings, and only
when all of them are full does it reach the ancestors' siblings.  Each leaf then takes whole epochs and, for the rest,
the prefix of one more epoch in a seeded order.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import column, staged, text_of, unused

#: Production parameters.  Sources without an entry belong to the domain "other"; names without a weight weigh 1.
DOMAINS = {
    "web": ("src0", "src1", "src2", "src3", "src4"),
    "news": ("src5", "src6", "src7", "src8", "src9"),
    "books": ("src10", "src11", "src12", "src13", "src14"),
    "forums": ("src15", "src16", "src17", "src18", "src19"),
}
DOMAIN_WEIGHTS = {"web": 4, "news": 3, "books": 4, "forums": 2}
LANG_WEIGHTS = {"en": 5, "de": 3, "fr": 3, "es": 2}
SOURCE_WEIGHTS = {"src0": 3}
BUDGET = (3, 4)  # of the tokens there are
MAX_EPOCHS = 2
SEED = 17
NONE = "(none)"
ROWS_PER_BUCKET = 50_000
LEAF = ("domain", "lang", "source")


class Settings:
    """Weights, budget, epochs and seed of a mix."""

    def __init__(
        self,
        domains: Mapping[str, tuple[str, ...]] = DOMAINS,
        domain_weights: Mapping[str, int] = DOMAIN_WEIGHTS,
        lang_weights: Mapping[str, int] = LANG_WEIGHTS,
        source_weights: Mapping[str, int] = SOURCE_WEIGHTS,
        budget: tuple[int, int] = BUDGET,
        max_epochs: int = MAX_EPOCHS,
        seed: int = SEED,
    ):
        self.domains, self.domain_weights, self.lang_weights = domains, domain_weights, lang_weights
        self.source_weights, self.budget, self.max_epochs, self.seed = source_weights, budget, max_epochs, seed


def token_estimate(text: Column) -> Column:
    """Four bytes a token, rounded up; 0 for the empty text."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def lookup(key: Column, values: Mapping[str, int | str], default: int | str) -> Column:
    found = F.lit(default)
    for name, value in values.items():
        found = F.when(key == name, F.lit(value)).otherwise(found)
    return found


def domain_of(source: Column, domains: Mapping[str, tuple[str, ...]] = DOMAINS) -> Column:
    return lookup(source, {s: d for d, names in domains.items() for s in names}, "other")


def fill(nodes: DataFrame, parents: list[str], budget: str, name: str) -> DataFrame:
    """Share ``budget`` of each parent among its nodes (weight, cap) as ``grant``.

    Ordered by cap per weight, a node is full if its fair share of what the fuller ones left reaches its cap; the
    others divide the remainder by weight, rounded down.  Whole numbers throughout, so every run agrees."""
    exact = "decimal(38,0)"
    siblings = Window.partitionBy(*parents)
    before = siblings.orderBy(F.col("cap") / F.col("weight"), name).rowsBetween(Window.unboundedPreceding, -1)
    taken, passed = (F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("cap", "weight"))
    full = F.col("cap").cast(exact) * (F.sum("weight").over(siblings) - passed).cast("decimal(18,0)") <= F.col(
        "weight"
    ).cast("decimal(18,0)") * (F.col(budget) - taken).cast(exact)
    judged = nodes.withColumn("full", full)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(siblings)
    left = F.col(budget) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(siblings)
    return (
        judged.withColumn("open_weight", open_weight)
        .withColumn("left_over", left)
        .withColumn("grant", F.expr(f"CASE WHEN full THEN cap ELSE CAST(weight AS {exact}) * left_over div open_weight END"))
        .drop("full", "open_weight", "left_over", "weight", "cap", budget)
    )


def leaf_table(sized: DataFrame, settings: Settings) -> DataFrame:
    """(domain, lang, source, supply) with the leaf's ``full_epochs`` and the tokens ``rest`` beyond them."""
    leaves = sized.groupBy(*LEAF).agg(F.sum("tokens").alias("supply")).filter("supply > 0")
    weighted = leaves.select(
        "*",
        (F.col("supply") * settings.max_epochs).alias("cap"),
        lookup(F.col("domain"), settings.domain_weights, 1).cast("long").alias("w0"),
        lookup(F.col("lang"), settings.lang_weights, 1).cast("long").alias("w1"),
        lookup(F.col("source"), settings.source_weights, 1).cast("long").alias("w2"),
    ).filter("w0 > 0 and w1 > 0 and w2 > 0")
    up, down = settings.budget
    supply = sized.agg(F.sum("tokens").alias("n")).first().n or 0
    total_tokens, grants = F.lit(supply * up // down).cast("long"), None
    for level, name in enumerate(LEAF):
        keys = list(LEAF[: level + 1])
        nodes = weighted.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.first(f"w{level}").alias("weight"))
        parents = keys[:-1]
        nodes = nodes.join(grants, parents) if parents else nodes.withColumn("budget", total_tokens)
        grants = fill(nodes, parents, "budget", name).withColumnRenamed("grant", "budget")
    return leaves.join(grants, list(LEAF)).select(
        *LEAF,
        "supply",
        F.expr("budget div supply").alias("full_epochs"),
        F.expr("budget % supply").alias("rest"),
    )


def order_key(row: Column, epoch: Column, seed: int) -> Column:
    """Place of a row (doc_id, content, copy) in an epoch's order.  Equal rows have different copy numbers, so every row
    has a place of its own and no id binds rows together."""
    fields = [F.lit(f"{seed}"), epoch.cast("string"), *[F.coalesce(row[c].cast("string"), F.lit("")) for c in ("doc_id", "content", "copy")]]
    return F.md5(F.concat_ws(":", *fields).cast("binary"))


def row_of(doc_id: Column, content: Column, copy: Column) -> Column:
    return F.struct(doc_id.alias("doc_id"), content.alias("content"), copy.cast("long").alias("copy"))


def content_of(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def with_copy(stored: DataFrame, key: str, row: str, name: str) -> DataFrame:
    """Number the rows of each ``key`` (a struct) from 0 as ``name``.

    ``row`` is the stored rows' increasing id, whose upper bits are the partition that wrote them.  Rows are numbered
    within a key and partition, and partitions are stitched by their counts, so a hot key is spread over its partitions."""
    part = F.shiftright(row, 33)
    parts = stored.groupBy(F.col(key), part.alias("mix_part")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(key).orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col(key).alias("mix_of"), F.col("mix_part").alias("mix_in"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("mix_start"))
    inside = F.row_number().over(Window.partitionBy(key, part).orderBy(row)) - 1
    numbered = stored.withColumns({"mix_inside": inside, "mix_part": part})
    met = numbered.join(starts, (F.col(key) == F.col("mix_of")) & (F.col("mix_part") == F.col("mix_in")))
    return met.withColumn(name, F.col("mix_start") + F.col("mix_inside")).drop("mix_inside", "mix_part", "mix_of", "mix_in", "mix_start")


def cuts(sized: DataFrame, leaves: DataFrame, settings: Settings) -> DataFrame:
    """``leaves`` with ``cut``: the last order key within ``rest`` tokens of the leaf's next epoch, '' if there is none.

    Running sums go over buckets of the order first and then within the one bucket that holds the cut, so a leaf with
    a third of all rows is spread over as many tasks as it has buckets."""
    rows = sized.count()
    digits = max(1, math.ceil(math.log(max(rows, 1) / ROWS_PER_BUCKET, 16)))
    wanted = leaves.filter("rest > 0").select(*LEAF, "rest", (F.col("full_epochs") + 1).alias("epoch"))
    keyed = sized.join(wanted, list(LEAF)).select(
        *LEAF, "tokens", "rest", order_key(F.col("row"), F.col("epoch"), settings.seed).alias("place")
    )
    keyed = keyed.withColumn("bucket", F.substring("place", 1, digits))
    sums = keyed.groupBy(*LEAF, "bucket").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    so_far = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("bucket"))
    reached = sums.withColumn("so_far", so_far).filter("so_far > rest and so_far - tokens <= rest")
    cutting = reached.select(*LEAF, "bucket", (F.col("rest") - (F.col("so_far") - F.col("tokens"))).alias("room"))
    inside = keyed.select(*LEAF, "bucket", "place", "tokens").join(cutting, [*LEAF, "bucket"])
    running = F.sum("tokens").over(Window.partitionBy(*LEAF, "bucket").orderBy("place"))
    last = inside.withColumn("running", running).groupBy(*LEAF, "bucket").agg(
        F.max(F.when(F.col("running") <= F.col("room"), F.col("place"))).alias("place")
    )
    found = last.select(*LEAF, F.coalesce("place", "bucket").alias("cut"))
    return leaves.join(found, list(LEAF), "left").withColumn("cut", F.coalesce("cut", F.lit("")))


def plan(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(one small row per document, the leaf table with cuts, the keys of repeated rows), all stored."""
    source = F.coalesce(column(docs, "source").cast("string"), F.lit(NONE))
    text = text_of(docs, "text")
    sized = docs.select(
        F.struct(column(docs, "doc_id").alias("doc_id"), content_of(text).alias("content")).alias("key"),
        domain_of(source, settings.domains).alias("domain"),
        F.coalesce(column(docs, "lang").cast("string"), F.lit(NONE)).alias("lang"),
        source.alias("source"),
        token_estimate(text).alias("tokens"),
        F.monotonically_increasing_id().alias("id"),
    )
    sized = staged(sized, "sizes")
    repeated = staged(sized.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("again")), "repeated")
    if repeated.isEmpty():
        sized = sized.withColumn("copy", F.lit(0).cast("long"))
    else:
        several = with_copy(sized.join(repeated, sized["key"] == repeated["again"], "left_semi"), "key", "id", "copy")
        single = sized.join(repeated, sized["key"] == repeated["again"], "left_anti")
        sized = staged(single.withColumn("copy", F.lit(0).cast("long")).unionByName(several), "numbered")
    row = row_of(F.col("key.doc_id"), F.col("key.content"), F.col("copy"))
    sized = sized.select(F.col("key.doc_id").alias("doc_id"), *LEAF, "tokens", row.alias("row"))
    leaves = staged(leaf_table(sized, settings), "leaves")
    return sized, staged(cuts(sized, leaves, settings), "cuts"), repeated


def copies(full_epochs: Column, cut: Column, row: Column, seed: int) -> Column:
    """In how many epochs of its leaf a row is taken."""
    extra = F.when(cut != "", order_key(row, full_epochs + 1, seed) <= cut).otherwise(False)
    return full_epochs + extra.cast("long")


def select_documents(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per document taken: (doc_id, domain, lang, source, n_tokens, copies).

    Tokens are estimated from the bytes of whole texts; null and empty texts have none and come along where an epoch
    passes them.  Null languages and sources are leaves of their own, named "(none)".  Rows are taken one by one: rows that
    repeat an id, or lack one, and even equal rows have places of their own.  Leaves of weight 0 or without tokens get nothing.  An empty table gives an empty result.
    """
    settings = settings or Settings()
    sized, leaves, _ = plan(docs, settings)
    taken = sized.join(leaves, list(LEAF)).withColumn(
        "copies", copies(F.col("full_epochs"), F.col("cut"), F.col("row"), settings.seed)
    )
    return taken.filter("copies > 0").select("doc_id", *LEAF, F.col("tokens").alias("n_tokens"), "copies")


def mix(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` with each row as often as its leaf's epochs take it; columns stay as they are.

    Rows meet only their leaf's cut, so texts are neither sorted nor collected; rows that are repeated (id and text) are
    stored and numbered first.  Null ids, null and empty texts, null languages and sources, repeated rows and an empty table
    give what :func:`select_documents` says; which of equal rows with different other columns are taken is not defined,
    only how many."""
    settings = settings or Settings()
    _, leaves, repeated = plan(docs, settings)
    kept = docs.columns
    content, copy, key, again = (unused(docs, f"mix_{c}_of_row") for c in ("content", "copy", "key", "again"))
    marked = docs.withColumn(content, content_of(text_of(docs, "text")))
    single = marked
    if not repeated.isEmpty():
        found = repeated.select(F.col("again").alias(again))
        marked = marked.withColumn(key, F.struct(column(marked, "doc_id").alias("doc_id"), F.col(content).alias("content")))
        same = F.col(key) == F.col(again)
        number = unused(docs, "mix_number_of_row")
        several = staged(marked.join(found, same, "left_semi").withColumn(number, F.monotonically_increasing_id()), "repeated-rows")
        several = with_copy(several, key, number, copy).drop(key, number)
        single = marked.join(found, same, "left_anti").drop(key).withColumn(copy, F.lit(0).cast("long"))
        single = single.unionByName(several)
    else:
        single = single.withColumn(copy, F.lit(0).cast("long"))
    source = F.coalesce(column(single, "source").cast("string"), F.lit(NONE))
    lang = F.coalesce(column(single, "lang").cast("string"), F.lit(NONE))
    own = leaves.select(*(F.col(c).alias(f"mix_{c}_of_leaf") for c in ("lang", "source", "full_epochs", "cut")))
    met = single.join(own, (lang == own["mix_lang_of_leaf"]) & (source == own["mix_source_of_leaf"]))
    row = row_of(column(single, "doc_id"), column(single, content), column(single, copy))
    times = copies(own["mix_full_epochs_of_leaf"], own["mix_cut_of_leaf"], row, settings.seed)
    wanted = [column(single, c) for c in kept]
    if settings.max_epochs == 1:
        return met.filter(times > 0).select(*wanted)
    repeats = F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("mix_epoch_of_leaf")
    return met.filter(times > 0).select(*wanted, repeats).drop("mix_epoch_of_leaf")


def sql(settings: Settings | None = None) -> str:
    """The rows of :func:`select_documents` in DuckDB, with one running sum per leaf."""
    s = settings or Settings()

    def case(key: str, values: Mapping[str, int | str], default: int | str) -> str:
        text = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
        return " ".join([f"CASE {key}", *(f"WHEN '{k}' THEN {text(v)}" for k, v in values.items()), f"ELSE {text(default)} END"])

    def level(k: int) -> str:
        keys, parents, name = ", ".join(LEAF[: k + 1]), ", ".join(LEAF[:k]), LEAF[k]
        part = f"PARTITION BY {parents}" if parents else ""
        using = f"JOIN grants{k} USING ({parents})" if parents else "CROSS JOIN grants0"
        return f"""
    nodes{k} AS (
        SELECT {keys}, sum(cap)::HUGEINT AS cap, any_value(w{k})::HUGEINT AS weight FROM weighted GROUP BY {keys}
    ), judged{k} AS (
        SELECT *, cap * (sum(weight) OVER ({part}) - coalesce(sum(weight) OVER earlier, 0))
                  <= weight * (budget - coalesce(sum(cap) OVER earlier, 0)) AS full_up
        FROM nodes{k} {using}
        WINDOW earlier AS ({part} ORDER BY cap::DOUBLE / weight::DOUBLE, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), grants{k + 1} AS (
        SELECT {keys}, CASE WHEN full_up THEN cap ELSE
            weight * (budget - sum(CASE WHEN full_up THEN cap ELSE 0 END) OVER ({part}))
            // sum(CASE WHEN full_up THEN 0 ELSE weight END) OVER ({part}) END::HUGEINT AS budget
        FROM judged{k}
    )"""

    domains = {name: d for d, names in s.domains.items() for name in names}
    return f"""
    WITH sized AS (
        SELECT doc_id, {case(f"coalesce(source, '{NONE}')", domains, "other")} AS domain, coalesce(lang, '{NONE}') AS lang,
               coalesce(source, '{NONE}') AS source, CAST((strlen(coalesce(text, '')) + 3) // 4 AS BIGINT) AS tokens,
               md5(coalesce(text, '')) AS content, row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) - 1 AS copy
        FROM documents
    ), leaves AS (
        SELECT domain, lang, source, sum(tokens)::HUGEINT AS supply FROM sized GROUP BY ALL HAVING sum(tokens) > 0
    ), weighted AS (
        SELECT *, supply * {s.max_epochs} AS cap, {case("domain", s.domain_weights, 1)} AS w0,
               {case("lang", s.lang_weights, 1)} AS w1, {case("source", s.source_weights, 1)} AS w2
        FROM leaves
    ), grants0 AS (
        SELECT (sum(supply) * {s.budget[0]})::HUGEINT // {s.budget[1]} AS budget FROM leaves
    ), {level(0)}, {level(1)}, {level(2)},
    shares AS (
        SELECT domain, lang, source, budget // supply AS full_epochs, budget % supply AS rest
        FROM leaves JOIN grants3 USING (domain, lang, source)
    ), placed AS (
        SELECT *, md5(concat_ws(':', '{s.seed}', full_epochs + 1, coalesce(doc_id::VARCHAR, ''), content, copy)) AS place
        FROM sized JOIN shares USING (domain, lang, source)
    ), run AS (
        SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS running FROM placed
    ), taken AS (
        SELECT *, CAST(full_epochs + CASE WHEN rest > 0 AND running <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM run
    )
    SELECT doc_id, domain, lang, source, tokens AS n_tokens, copies FROM taken WHERE copies > 0
    """

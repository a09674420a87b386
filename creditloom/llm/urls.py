"""URL filter: host and path rules, then a weighted vocabulary counted by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import by_batch, column

# One strict term rejects a url, of the soft terms two different ones do.
STRICT_TERMS = (
    "adult-x", "camgirls", "casino-win", "cheap-pills", "escorts", "hardcore", "malware", "phishing", "porn", "porno",
    "sexcam", "spam-farm", "viagra", "xvideos", "xxx",
)
SOFT_TERMS = (
    "adult", "ads", "bet", "bets", "betting", "bonus", "casino", "cheap", "crack", "dating", "farm", "free", "gambling",
    "jackpot", "keygen", "lottery", "naked", "nude", "pills", "poker", "sex", "spam", "torrent", "track", "warez", "win",
)
SOFT_LIMIT = 2
#: (action, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.  Path: from there up to
    ``?``, ``#`` or the end.  Both are empty for null and for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits; null where none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, domain, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        rule = F.when(fits, domain + prefix).otherwise(rule)
        action = F.when(fits, verdict).otherwise(action)
    return rule, action


@lru_cache(maxsize=8)
def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for term in soft:
        machine.add_word(term, (term, False))
    for term in strict:
        machine.add_word(term, (term, True))
    machine.make_automaton()
    return machine


def hits(text: str, machine: ahocorasick.Automaton) -> tuple[list[str], list[str]]:
    """Strict and soft terms in the text, each once.  A term counts only between non-alphanumeric neighbours."""
    strict, soft = set(), set()
    for end, (term, is_strict) in machine.iter(text):
        start = end - len(term) + 1
        if (start == 0 or not text[start - 1].isalnum()) and (end + 1 == len(text) or not text[end + 1].isalnum()):
            (strict if is_strict else soft).add(term)
    return sorted(strict), sorted(soft)


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    strict: Iterable[str] = STRICT_TERMS,
    soft: Iterable[str] = SOFT_TERMS,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, strict_hits, soft_hits).

    The longest fitting rule decides; without one, a strict term or ``soft_limit`` different soft terms anywhere in the
    lower-cased url block, query string and fragment included and also where it has no ``://``.  A null or empty url has
    no terms and is allowed.  Only id and url are read, repeated rows are judged each, an empty table gives an empty
    result.
    """
    strict, soft = tuple(strict), tuple(soft)
    url = column(pages, url_col)
    host, path = host_and_path(url)
    whole = F.lower(F.coalesce(url.cast("string"), F.lit("")))
    split = pages.select(column(pages, id_col).alias("page_id"), host.alias("host"), path.alias("path"), whole.alias("whole"))

    def count(batch: pa.RecordBatch):
        machine = automaton(strict, soft)
        found = [hits(text, machine) for text in batch.column("whole").to_pylist()]
        kind = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([f[0] for f in found], kind), pa.array([f[1] for f in found], kind)],
            names=["page_id", "host", "path", "strict_hits", "soft_hits"],
        )

    id_type = split.schema["page_id"].dataType.simpleString()
    counted = by_batch(
        split, count, f"page_id {id_type}, host string, path string, strict_hits array<string>, soft_hits array<string>"
    )
    rule, action = rule_columns(F.col("host"), F.col("path"), rules)
    rejects = (F.size("strict_hits") >= 1) | (F.size("soft_hits") >= soft_limit)
    return counted.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(action, F.when(rejects, "block").otherwise("allow")).alias("verdict"),
        "strict_hits",
        "soft_hits",
    )


def sql(strict=STRICT_TERMS, soft=SOFT_TERMS, soft_limit: int = SOFT_LIMIT, rules=RULES) -> str:
    """The same judgement for DuckDB; one bounded match per term."""

    def has(term: str) -> str:
        return rf"CAST(regexp_matches(lower(coalesce(url, '')), '(^|[^[:alnum:]]){term}([^[:alnum:]]|$)') AS INT)"

    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [f"(host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '{p}')" for _, d, p in ranked]
    rule = " ".join(f"WHEN {f} THEN '{d}{p}'" for f, (_, d, p) in zip(fits, ranked))
    action = " ".join(f"WHEN {f} THEN '{a}'" for f, (a, _, _) in zip(fits, ranked))
    n_strict, n_soft = " + ".join(map(has, strict)), " + ".join(map(has, soft))
    return rf"""
    WITH rest AS (
        SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
    ), split AS (
        SELECT page_id, url, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
               regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
        FROM rest
    ), counted AS (
        SELECT *, {n_strict} AS n_strict, {n_soft} AS n_soft FROM split
    )
    SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule,
           CASE {action} WHEN n_strict >= 1 OR n_soft >= {soft_limit} THEN 'block' ELSE 'allow' END AS verdict,
           n_strict, n_soft
    FROM counted
    """

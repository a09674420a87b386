"""The conversation trie against a plain one, with sketches of every quality."""

import hashlib
import random
import re
import zlib

import pytest

from creditloom.llm import trie

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, heads_of):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = 0 if heads_of is None else zlib.crc32(str(c).encode()) % 4
        anchor = c - (c % heads_of if c >= 0 else -(-c % heads_of)) if heads_of else c
        built[c] = own.get(anchor, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = ({k: 0 for k in members} for _ in range(3))
    for key in sorted(members, key=len, reverse=True):
        leaves[key] += children[key] == 0
        if key:
            saved[key] += (len(members[key]) - 1) * len(WORDS.findall(key[-1][1]))
            children[key[:-1]] += 1
            leaves[key[:-1]] += leaves[key]
            saved[key[:-1]] += saved[key]
    out = []
    for key, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(built[c]) == len(key))
        parent = min(members[key[:-1]]) if key else None
        out.append((min(ids), len(key), parent, len(ids), children[key], leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **settings):
    clashing = [(*r, 1, "x", b"y") for r in rows]
    table = spark.createDataFrame(clashing, "conv_id long, turn int, role string, text string, depth int, node string, c binary")
    made = trie.prefix_trie(table.repartition(4), **settings).drop("turn").collect()
    return sorted((tuple(r) for r in made), key=str)


def some_rows():
    rng = random.Random(5)
    rows = []
    for c in [*range(60), 103, 119, -5, 70_000, 2**40 + 3]:
        for turn in range(rng.randrange(1, 7)):
            rows.append((c, turn, rng.choice(["user", "bot"]), rng.choice(["hello there", "what", "a  b\tc d"])))
    rows += [(300, None, None, None), (300, None, "user", ""), (300, 1, "user", "x"), (300, 1, "user", "x")]
    rows += [(301, 1, "user", None), (301, 1, "", "user"), (None, 0, "user", "lost"), (None, None, None, None)]
    deep = [(t, "user", f"deep {t}") for t in range(40)]
    rows += [(c, *t) for c in (400, 402) for t in deep] + [(404, *t) for t in deep[:33]] + [(406, *t) for t in deep[:20]]
    rows += [(c, 0, "user", "the same") for c in range(500, 900)]
    rows += [(70_000 + c, 0, "user", "the same") for c in range(1, 4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("max_counters", [1 << 26, 64, 1])
@pytest.mark.parametrize("heads_of", [None, 20])
def test_equals_a_plain_trie(spark, max_counters, heads_of):
    rows = some_rows()
    assert found(spark, rows, heads_of=heads_of, max_counters=max_counters) == plain(rows, heads_of)


def test_one_conversation_holds_most_rows(spark):
    """Its turns lie in many blocks, whether they differ or not."""
    long = [(7, t, "user", f"turn {t}") for t in range(900)] + [(9, 1, "user", "again") for _ in range(700)]
    rows = long + [(8, t, "user", f"turn {t}") for t in range(450)] + [(c, 0, "user", "turn 0") for c in range(20, 30)]
    spread = trie.numbered(
        spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"), "conv_id", "turn", "role", "text"
    )
    assert spread.filter("c = 7").select("p").distinct().count() > 1
    assert found(spark, rows) == plain(rows, None)
    assert found(spark, rows, heads_of=20) == plain(rows, 20)


def test_screen_keeps_tails_local(spark):
    rows = [(c, t, "user", f"{c if t > 1 else 0} {t}") for c in range(200) for t in range(6)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    turns, _ = trie.prefixes(trie.numbered(table, "conv_id", "turn", "role", "text"), None)
    judged = trie.screened(turns)
    assert judged.filter("depth <= 2 AND NOT shared").count() == 0
    assert judged.filter("depth > 2 AND shared").count() < 20


def test_turnless_and_empty(spark):
    turnless = [c for c in (21, 41, 61, 81, 101) if zlib.crc32(str(c).encode()) % 4]
    rows = [(c, 0, "user", "gone") for c in turnless]
    assert found(spark, rows, heads_of=20) == plain(rows, 20)
    assert found(spark, [], heads_of=20) == [] and found(spark, [(None, 1, "a", "b")], heads_of=20) == []

"""Repeated strings: suffix order, windows and whole jobs against brute force."""

import random

import numpy as np
import pytest

from creditloom.llm import suffixes


def brute(texts, width):
    """Removed spans of each text, by counting every window of the whole table."""
    seen = {}
    for t in texts:
        for i in range(len(t) - width + 1):
            seen[t[i : i + width]] = seen.get(t[i : i + width], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i + 1 : i + width + 1] = True
        edges = np.flatnonzero(np.diff(gone.astype(np.int8)))
        out.append((list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(b for b, g in zip(t, gone[1:]) if not g)))
    return out


def some_text(rng, n, letters="abAé"):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("seed", range(30))
def test_two_stage_order_is_the_suffix_order(seed):
    rng = random.Random(seed)
    data = some_text(rng, rng.randrange(1, 400), rng.choice(["a", "ab", "zyx", "abcdefgh", "\x00\x01é"])).encode()
    wanted = np.array(sorted(rng.sample(range(len(data)), rng.randrange(1, len(data) + 1))))
    order = suffixes.two_stage_order(data, wanted, 20)
    assert sorted(order.tolist()) == wanted.tolist()
    padded = data + b"\xff"
    keys = [padded[p : p + 20] for p in order]
    assert keys == sorted(keys)
    common = suffixes.common_prefixes(data + bytes(20), order, 20)
    for k in range(1, len(order)):
        a, b = ((data + bytes(20))[p : p + 20] for p in order[k - 1 : k + 1])
        assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), 20)


@pytest.mark.parametrize("seed", range(20))
def test_windows_of_strings(seed):
    rng = random.Random(seed)
    strings = list({some_text(rng, rng.randrange(0, 60), "ab").encode() for _ in range(rng.randrange(1, 40))})
    flags = suffixes.repeated_windows(strings, 12)
    spans = [[(s, e) for s, e in suffixes.spans_of(f, 12)] for f in flags]
    for got, (want, _) in zip(spans, brute(strings, 12)):
        merged = []
        for s, e in got:
            if merged and s <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
            else:
                merged.append((s, e))
        assert merged == want


def check(spark, texts, ids, **settings):
    rows = [(i, t, 5, "x", b"y") for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, doc string, data binary").repartition(4)
    found = suffixes.remove_repeats(docs, **settings).collect()
    data = [(t or "").encode() for t in texts]
    want = [(str(i), len(d), s, k) for i, d, (s, k) in zip(ids, data, brute(data, settings.get("width", 200)))]
    got = [(str(r.doc_id), r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in found]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("hot", [500, 2, 1])
def test_whole_jobs_equal_brute_force(spark, hot):
    """Copies, shared passages with changing surroundings, periods, and every hot limit down to none sorted."""
    rng = random.Random(hot)
    words = ["".join(rng.choice("abcdeé") for _ in range(5)) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, licence = prose(60), prose(25)
    texts = [None, "", "short", "a" * 700, "ab" * 300, prose(50) * 3]
    texts += [prose(30) + passage + prose(30) for _ in range(12)]
    texts += [prose(rng.randrange(5)) + licence + prose(rng.randrange(5)) for _ in range(30)]
    texts += [prose(80) for _ in range(10)]
    near = prose(120)
    texts += [near[:k] + "#" + near[k:] for k in range(0, 700, 70)] + [near, near, passage[:200], passage[10:210]]
    ids = [None if k == 7 else k // 2 for k in range(len(texts))]
    check(spark, texts, ids, hot=hot)
    check(spark, texts, ids, hot=hot, width=64, gram=8)


def test_a_long_text_and_none(spark):
    rng = random.Random(3)
    text = some_text(rng, 60_000, "abcdefghij ")
    check(spark, [text, text[1_000:1_199], text[2_000:2_200], "q" + text[50_000:50_300] + "q"], [1, 2, 3, 4])
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(docs).count() == 0

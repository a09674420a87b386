"""Fill-in-middle: the learned index against a plain list of boundaries, edges, and the round trip."""

import hashlib
import random
import re

import numpy as np
import pytest

from creditloom.llm import fim

TOKENS = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    text = text or ""
    tokens = TOKENS.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:i]), "".join(tokens[i:j]), "".join(tokens[j:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_text(rng):
    pieces = ["word", "Aé", "\U0001f600", "中文", " ", "\n", "<", "P>", "<S", "a" * 900, "[`{@", "ß", "\x00", "12"]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(400)))


@pytest.mark.parametrize("seed", range(20))
def test_every_boundary_is_exact(seed):
    rng = random.Random(seed)
    text = odd_text(rng) + "x" * rng.choice([0, 1, 5_000]) + odd_text(rng)
    ends = np.cumsum([0, *map(len, TOKENS.findall(text))])
    assert fim.boundaries(text).tolist() == ends.tolist()
    index = fim.fit(ends)
    assert [index.offset(r) for r in range(len(ends))] == ends.tolist()
    narrow = fim.fit(ends, max_error=2)
    assert [narrow.offset(r) for r in range(len(ends))] == ends.tolist() and np.abs(narrow.residuals).max() <= 2


def test_segments_are_few_on_even_text():
    index = fim.fit(fim.boundaries("even words here " * 20_000))
    assert index.tokens == 120_000 and len(index.ranks) == 1


def test_rows_nulls_marks_and_clashing_columns(spark):
    rng = random.Random(1)
    texts = [None, "", "a", "<P>", "x <S> y", "one <M", "the cat " * 50_000, *(odd_text(rng) for _ in range(60))]
    rows = [(i, t, 7, "q") for i, t in enumerate(texts)] + [(None, "no id", 7, "q"), (8, texts[8], 7, "q"), (-3, "minus", 7, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 int, output string").repartition(5)
    made = fim.transform(docs)
    found = made.select("*", fim.restored(made["output"], made["form"]).alias("back")).collect()
    assert len(found) == len(rows)
    expected = sorted((str(i), *map(str, plain(i, t)), t or "") for i, t, *_ in rows)
    assert sorted((str(r[0]), *map(str, r[1:6]), r.back) for r in found) == expected
    assert {"plain", "psm", "spm"} == {r.form for r in found}
    assert fim.transform(docs.limit(0)).count() == 0

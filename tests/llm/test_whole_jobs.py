"""Bounds, edges and cases in which an operator once did less than its whole job."""

import random

from creditloom.llm import language, pii, simhash, toxicity


def test_lexicon_sees_every_label_up_to_its_documented_bound(spark):
    """27,000 labels that may be read are below the bound, so the four documents of a rare toxic word all count."""
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    plain = ["".join(rng.choice(letters) for _ in range(7)) for _ in range(3_000)]
    rare = [f"zz{a}{b}qx" for a in letters[:5] for b in letters[:6]]
    read = [i for i in range(36_000) if crc(i) % 4 != 2]
    with_rare = {i: rare[k // 4] for k, i in enumerate(rng.sample(read, 4 * len(rare)))}
    docs = [(i, " ".join([*rng.sample(plain, 8), with_rare.get(i, "")])) for i in range(36_000)]
    labels = [(i, int(i in with_rare)) for i in range(36_000)]
    _, model = toxicity.score(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(8), spark.createDataFrame(labels, "doc_id long, toxic int")
    )
    assert {f"={w}" for w in rare} <= set(model.names)


def crc(i):
    import zlib

    return zlib.crc32(str(i).encode())


LANGUAGES = {
    "en": "the cat sat on the mat and the dog ran to the house with a red door",
    "fr": "le chat est sur la table et le chien court vers la maison avec une porte rouge",
    "de": "die Katze sitzt auf der Matte und der Hund rennt zu dem Haus mit einer roten Tür",
}


def test_unseen_scripts_give_no_evidence(spark):
    rows = [(3 * i + k, text, lang) for i in range(30) for k, (lang, text) in enumerate(LANGUAGES.items())]
    unseen = {1000: "привет мир " * 100, 1001: "中文 文本 没有 证据 " * 50, 1002: "ελληνικά"}
    docs = spark.createDataFrame([*rows, *((i, t, None) for i, t in unseen.items())], "doc_id long, text string, lang string")
    assert {r.doc_id for r in language.drop_unidentified(docs).collect()} == {i for i, _, _ in rows}
    scores = {r.doc_id: r.score for r in language.identify(docs).collect()}
    assert all(abs(scores[i] - 1 / 3) < 1e-9 for i in unseen)


BESIDE = [
    ("4111 1111 1111 1111 123", ["4111 1111 1111 1111"]),
    ("4111 1111 1111 1111 12/27", ["4111 1111 1111 1111"]),
    ("room 5 4111 1111 1111 1111", ["4111 1111 1111 1111"]),
    ("4111111111111111 100 EUR", ["4111111111111111"]),
    ("12345 4111 1111 1111 1111", ["4111 1111 1111 1111"]),
    ("7 4111-1111-1111-1111 99 5105105105105100 3", ["4111-1111-1111-1111", "5105105105105100"]),
    ("4111 1111 1111 1112 123", []),
    ("4111 1111 1111 1111 10.0.0.1", ["4111 1111 1111 1111", "10.0.0.1"]),
    ("1 " * 20_000, None),
]


def test_cards_beside_other_numbers(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(BESIDE)], "doc_id int, text string")
    for r in pii.pseudonymise(docs).collect():
        text, values = BESIDE[r.doc_id]
        assert values is None or [f.value for f in r.found] == values
        for f in r.found:
            text = text.replace(f.value, f.pseudonym, 1)
        assert values is None or r.text == text


def test_a_small_language_keeps_its_words(spark):
    large = [(i, " ".join(f"{a}{b}lar" for a in "abcdefghij" for b in "klmnopqrst"), "xl") for i in range(50)]
    small = [(100, "sma smb smc smd sme smf smg smh smi smj", "xs")]
    docs = spark.createDataFrame(large + small, "key int, text string, lang string")
    model = language.fit(docs, words=110, grams=10_000)
    assert {f"sm{c}" for c in "abcdefghij"} <= set(model.known)
    assert len(language.fit(docs, words=60, grams=10_000).known) <= 60
    assert {f"sm{c}" for c in "abcdefghij"} <= set(language.fit(docs, words=60, grams=10_000).known)


def test_near_copies_are_dropped_by_row_not_by_id(spark):
    one, two, three = "alpha beta gamma delta", "one two three four five", "red green blue black white"
    rows = [(1, one), (None, one), (None, two), (5, three), (7, three), (7, "quite another text than those"), (7, "a third text of seven words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted([one, two, three, rows[5][1], rows[6][1]])
    assert {(r.doc_id, r.text) for r in kept.collect()} >= {(1, one), (None, two), (5, three)}

import re

from llm_cases import LONG, TEXTS, docs, key_order

from hitloom.llm.decontaminate import contained_items


def grams(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def test_pairs_equal_brute_force(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
    w = item.split()
    one_changed = " ".join([*w[:20], "changed", *w[21:]])
    two_changed = " ".join([*w[:8], "changed", *w[9:20], "changed", *w[21:]])
    rows = TEXTS + [
        (20, LONG + " " + item + " " + LONG),
        (21, LONG + "\n" + item.upper().replace(" ", ", ") + "!"),
        (22, one_changed),
        (23, two_changed),
        (24, item + " " + item),
        (25, " ".join(w[:12]) + " filler " + " ".join(w[8:])),
        (26, "Two, words"),
        (26, "more rows of one id"),
    ]
    items = [(1, item), (2, "one two three four five six one two"), (3, None), (4, ""), (5, "two words"), (None, item), (6, item), (7, "single")]
    found = contained_items(docs(spark, rows), spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, n int, s string"))
    of = {}
    for i, t in rows:
        if i is not None:
            of.setdefault(i, set()).update(grams(t))
    expected = []
    for d, shingles in of.items():
        for i, t in items:
            own = grams(t)
            if i is not None and own and 100 * len(own & shingles) >= 80 * len(own):
                expected.append((d, i, len(own & shingles), len(own), len(own & shingles) / len(own)))
    assert sorted(map(tuple, found.collect()), key=key_order) == sorted(expected, key=key_order)
    assert {d for d, i, *_ in expected if i == 1} == {20, 21, 22, 24, 25}


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "two words")], "item_id long, text string")
    assert contained_items(docs(spark, []), items).count() == 0
    assert contained_items(docs(spark), items.limit(0)).count() == 0

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import LONG, TEXTS, docs
from pyspark.sql import functions as F

from hitloom.llm import langid, quality_cnn, toxicity
from hitloom.llm.labelled import fold, labelled_texts, training_texts
from hitloom.llm.queries import op5_quality_cnn, op6_toxicity, op8_language_id

SF = "/root/testdata/sf0.01"


def auc(score, label):
    score, label = np.asarray(score), np.asarray(label)
    a, b = score[label == 1][:, None], score[label == 0][None]
    return ((a > b) + 0.5 * (a == b)).mean()


def test_folds_are_crc32_of_the_id(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 7, 123456789012)] + [(None,)], "doc_id long")
    got = [r[0] for r in df.select(fold(F.col("doc_id"), 5)).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 for i in (0, 1, 7, 123456789012)] + [0]


@pytest.mark.parametrize("query, target, least", [(op5_quality_cnn, "quality", 0.95), (op6_toxicity, "toxic", 0.8)])
def test_held_out_rows_are_told_apart(spark, query, target, least):
    found = query(spark, SF)
    assert found.count() == 1000
    rows = found.filter("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert auc([r.score for r in rows], [r[target] for r in rows]) > least


def test_held_out_languages(spark):
    found = op8_language_id(spark, SF)
    rows = found.filter("held_out").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def labelled(spark, target, rows):
    return spark.createDataFrame(rows, f"doc_id long, {target} int")


@pytest.mark.parametrize("score", [quality_cnn.quality_scores, toxicity.toxicity_scores])
def test_without_labels_every_score_is_a_half(spark, score):
    target = "quality" if score is quality_cnn.quality_scores else "toxic"
    for rows in ([], [(1, 1), (7, 1), (None, 0), (3, None)]):
        found = score(docs(spark), labelled(spark, target, rows), F.lit(True)).collect()
        assert len(found) == len(TEXTS) and {r.score for r in found} == {0.5}
    assert score(docs(spark, []), labelled(spark, target, []), F.lit(True)).count() == 0


def test_training_rows_are_bounded_and_from_the_allowed_fold(spark):
    rows = [(i, f"text {i}") for i in range(100)]
    known = labelled(spark, "toxic", [(i, i % 2) for i in range(100)])
    sample = training_texts(docs(spark, rows), known, "toxic", F.col("doc_id") % 5 != 0, 10)
    assert len(sample) == 20 and sum(y for _, y in sample) == 10
    assert all(int(t.split()[1]) % 5 and int(t.split()[1]) % 2 == y for t, y in sample)


def test_a_repeated_id_is_one_training_text(spark, monkeypatch):
    rows = [(1, "same text")] * 200 + [(2, "another")] + [(3, "a third")]
    known = labelled(spark, "toxic", [(1, 1)] * 50 + [(2, 1), (3, 0)])
    sample = training_texts(docs(spark, rows), known, "toxic", F.lit(True), 10)
    assert sorted(sample) == [("a third", 0), ("another", 1), ("same text", 1)]
    monkeypatch.setattr(langid, "PER_LANGUAGE", 2)
    sample = langid.training_texts(docs(spark, rows).withColumn("lang", F.lit("en")), F.lit(True))
    assert len(sample) == 2 and len(set(sample)) == 2


def test_long_and_missing_texts_do_not_shrink_the_sample(spark, monkeypatch):
    rows = [(i, None) for i in range(60)] + [(100 + i, LONG if i % 2 else f"text {i}") for i in range(8)]
    known = labelled(spark, "toxic", [(i, i % 2) for i in range(120)])
    sample = training_texts(docs(spark, rows), known, "toxic", F.lit(True), 4)
    assert [y for _, y in sample] == [0] * 4 + [1] * 4
    assert all(t == LONG if y else t.startswith("text") for t, y in sample)
    monkeypatch.setattr(langid, "PER_LANGUAGE", 4)
    sample = langid.training_texts(docs(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "de").otherwise("en")), F.lit(True))
    assert [lang for _, lang in sample] == ["de"] * 4 + ["en"] * 4 and all(t == LONG for t, lang in sample if lang == "de")


BYTES = [t.encode() for t in ("", "a", "short", "x" * 191, "y" * 192, "z" * 193, LONG[:5000], "Ünï 😀 " * 100)]


def small_cnn():
    rng = np.random.default_rng(3)
    return quality_cnn.ByteCNN(
        rng.normal(size=(quality_cnn.WIDTH, 257, 4)).astype(np.float32),
        rng.normal(size=4),
        rng.normal(size=(4, 3)),
        rng.normal(size=3),
        rng.normal(size=6),
        0.1,
    )


def plain_cnn_score(m, t):
    x = [*t, *[256] * (quality_cnn.WIDTH - 1)] if t else [256] * quality_cnn.WIDTH
    responses = [sum(m.tables[w][x[i + w]] for w in range(quality_cnn.WIDTH)) for i in range(len(x) - quality_cnn.WIDTH + 1)]
    chunks = [np.max(responses[i : i + quality_cnn.CHUNK], axis=0) + m.bias for i in range(0, len(responses), quality_cnn.CHUNK)]
    h = np.maximum(np.array(chunks) @ m.hidden + m.hidden_bias, 0)
    return 1 / (1 + np.exp(-(np.r_[h.max(axis=0), h.mean(axis=0)] @ m.out + m.out_bias)))


@pytest.mark.parametrize("block", [1 << 17, 1000])
def test_byte_network_equals_its_definition(block, monkeypatch):
    monkeypatch.setattr(quality_cnn, "BLOCK", block)
    m = small_cnn()
    assert np.allclose(m.scores(BYTES), [plain_cnn_score(m, t) for t in BYTES], atol=1e-5)


@pytest.mark.parametrize("block", [1 << 16, 50])
def test_text_network_equals_its_definition(block, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(4)
    columns = sum(toxicity.WIDTHS) * toxicity.FILTERS
    tables = rng.normal(size=(toxicity.ROWS, columns)).astype(np.float32)
    tables[0] = 0
    filters = toxicity.FILTERS * len(toxicity.WIDTHS)
    m = toxicity.TextCNN(tables, rng.normal(size=filters), rng.normal(size=filters), 0.2, np.array([1.0, -1.0, 0.5, 0.0]))
    coder = toxicity.Words()
    texts = ["", "1 2 3", "one", "le la les deux", LONG[:3000], "der die das und ist " * 30]
    codes = [coder.codes(t) for t in texts]
    for z, c in zip(m.logits(codes), codes):
        pooled = np.zeros(filters)
        if len(c):
            a, b = toxicity._rows(np.r_[c, 0, 0])
            rows = tables[a] + tables[b]
            at, made = 0, []
            for width in toxicity.WIDTHS:
                part = [
                    sum(rows[i + o, at + o * toxicity.FILTERS : at + (o + 1) * toxicity.FILTERS] for o in range(width) if i + o < len(rows))
                    for i in range(len(c))
                ]
                made.append(np.max(part, axis=0))
                at += width * toxicity.FILTERS
            pooled = np.maximum(np.concatenate(made) + m.bias, 0)
        counts = [int((c >> 40 >> k & 1).sum()) for k in range(4)]
        assert np.isclose(z, pooled @ m.out + 0.2 - m.shift[int(np.argmax(counts))], atol=1e-3)


def test_thresholds_lie_between_the_labels_and_differ_by_language():
    rng = np.random.default_rng(0)
    english = [(" ".join(rng.choice(["the", "of", "house", "tree", "and", "river"], 30)), 0) for _ in range(200)]
    german = [(" ".join(rng.choice(["der", "und", "haus", "baum", "ist", "fluss"], 30)), 0) for _ in range(200)]
    texts = english + german
    texts = [(t + (" schmutzig" if "der" in t.split() else " filthy"), 1) if k % 2 else (t, 0) for k, (t, _) in enumerate(texts)]
    model = toxicity.train(texts)
    coder = toxicity.Words()
    scores = model.scores([coder.codes(t) for t, _ in texts])
    assert np.mean((scores >= toxicity.THRESHOLD) == np.array([y for _, y in texts])) > 0.98


def test_posteriors_equal_forward_backward_by_definition():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 32, 33, 64, 100, 2])
    move, e = rng.random((3, 3)) + 0.1, rng.random((lengths.sum(), 3)) + 0.01
    found, at = langid.posteriors(e, move, lengths), 0
    for n in lengths:
        own = e[at : at + n]
        a, b = np.zeros((n, 3)), np.ones((n, 3))
        a[0] = own[0]
        for t in range(1, n):
            a[t] = (a[t - 1] @ move) * own[t]
            a[t] /= a[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = move @ (own[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        assert np.allclose(found[at : at + n], a * b / (a * b).sum(axis=1, keepdims=True))
        at += n


@pytest.fixture(scope="module")
def crf():
    rng = np.random.default_rng(1)
    pools = {"xx": "alpha betor gammor deltor".split(), "yy": "unu duo trio kvaro".split()}
    return langid.train([(" ".join(rng.choice(pool, 40)), lang) for lang, pool in pools.items() for _ in range(40)])


def test_code_switched_text_is_labelled_piece_by_piece(spark, crf):
    text = "alpha betor gammor deltor alpha betor unu duo trio kvaro unu duo trio kvaro"
    found = langid.label_texts(docs(spark, [(1, text)]), crf, spans=True).first()
    assert [(r.lang, r.start, r.length) for r in found.runs] == [("xx", 0, 6), ("yy", 6, 8)]
    assert found.lang_pred == "yy" and 0.5 < found.score < 0.7


def test_language_of_unusual_texts(spark, crf):
    found = langid.label_texts(docs(spark), crf).collect()
    assert len(found) == len(TEXTS)
    for r in found:
        text = [t for i, t in TEXTS if i == r.doc_id]
        if not any(re.search(r"[^\W\d_]", t or "") for t in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    kept = langid.with_language(docs(spark), crf)
    assert kept.columns == [*docs(spark).columns, "_lang_pred", "_lang_score", "_lang_sure"]
    assert all(r._lang_sure >= r._lang_score for r in kept.collect())
    pairs = lambda df, a, b: sorted((str(r.doc_id), r[a], round(r[b], 9)) for r in df.collect())
    assert pairs(kept, "_lang_pred", "_lang_score") == sorted((str(r.doc_id), r.lang_pred, round(r.score, 9)) for r in found)


def test_numerals_are_no_letters(spark, crf):
    found = langid.label_texts(docs(spark, [(1, "² ½ Ⅷ ① 5 _"), (2, "x²y")]), crf).collect()
    assert [(r.lang_pred, r.score) for r in found if r.doc_id == 1] == [("und", 0.0)]
    assert langid.words_of("x²y ½alpha 一二 a_b") == ["x", "y", "alpha", "一二", "a", "b"]


def test_short_texts_of_many_languages_take_little_memory():
    """200 labels: a transfer matrix for each of these texts would take over 10 GB."""
    import tracemalloc

    rng = np.random.default_rng(2)
    model = langid.WordCRF([f"l{k:03}" for k in range(200)], {}, rng.normal(size=(langid.ROWS + 1, 200)), rng.random((200, 200)) + 0.1)
    texts = pa.array([f"word{chr(97 + k % 26)}" for k in range(8_192)])
    tracemalloc.start()
    labeller, n = langid.Labeller(model), 0
    for portion in langid._portions(texts, 200):
        n += len(labeller.label(portion))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts) and peak < 400e6


def test_at_most_so_many_texts_of_each_language(spark, monkeypatch):
    monkeypatch.setattr(langid, "PER_LANGUAGE", 7)
    rows = [(k, f"text number {k}", "ab"[k % 2] if k < 60 else "c") for k in range(64)] + [(3, "again", "b")] * 50
    found = langid.training_texts(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert sorted(Counter(name for _, name in found).items()) == [("a", 7), ("b", 7), ("c", 4)]


def test_nothing_to_learn_from_means_undetermined(spark):
    rows = docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify(rows, F.lit(True)).collect()} == {("und", 0.0)}
    assert langid.identify(rows.limit(0), F.lit(True)).count() == 0


def assert_gradient(loss, p, grad, names, rng, places=12):
    """``grad`` equals differences of ``loss``, at some places of each parameter, those of the largest derivatives among them."""
    for name in names:
        flat, g = p[name].reshape(-1), grad[name].reshape(-1)
        some = {*np.argsort(-abs(g))[: places // 2].tolist(), *rng.integers(0, len(flat), places // 2).tolist()}
        assert abs(g).max() > 1e-8, name
        for k in some:
            was, around = flat[k], []
            for step in (1e-6, -1e-6):
                flat[k] = was + step
                around.append(loss())
            flat[k] = was
            assert np.isclose((around[0] - around[1]) / 2e-6, g[k], rtol=1e-3, atol=1e-7), (name, k)


def test_gradient_of_the_byte_network():
    rng = np.random.default_rng(5)
    p = quality_cnn.start(rng)
    y, weight = rng.integers(0, 2, len(BYTES)).astype(float), rng.random(len(BYTES)) + 0.5
    run = lambda: quality_cnn.loss_and_gradient(p, BYTES, y, weight, np.float64)
    assert_gradient(lambda: run()[0], p, run()[1], p, rng)


def test_training_network_scores_as_the_scoring_one(monkeypatch):
    rng = np.random.default_rng(6)
    p = quality_cnn.start(rng)
    model = quality_cnn.ByteCNN((p["e"] @ p["f"]).astype(np.float32), p["b"], p["v"], p["c"], p["u"], float(p["d"][0]))
    for block in (1 << 17, 1000):
        monkeypatch.setattr(quality_cnn, "BLOCK", block)
        for t in BYTES:
            loss, _ = quality_cnn.loss_and_gradient(p, [t], np.ones(1), np.ones(1))
            assert np.isclose(np.exp(-loss), model.scores([t])[0], atol=1e-5)


@pytest.mark.parametrize("block", [1 << 16, 7])
def test_gradient_of_the_text_network(block, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(7)
    p = toxicity.start(rng)
    coder = toxicity.Words()
    codes = [coder.codes(t) for t in ("one", "the house and the river", LONG[:900], "der baum " * 9)]
    y, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])
    run = lambda: toxicity.loss_and_gradient(p, codes, y, weight)
    _, grad, touched = run()
    whole = np.zeros_like(p["e"])
    whole[touched] = grad["e"]
    assert_gradient(lambda: run()[0], p, grad | {"e": whole}, p, rng)


def test_gradient_of_the_field():
    rng = np.random.default_rng(8)
    p = {"w": rng.normal(size=(9, 3)), "t": rng.normal(size=(3, 3))}
    rows, owner = rng.integers(0, 9, 20), np.r_[np.arange(6), rng.integers(0, 6, 14)]
    x, y = rng.integers(0, 6, (4, 7)), rng.integers(0, 3, (4, 7))
    there = np.arange(7) < np.array([7, 1, 4, 6])[:, None]
    x[0, 0] = 5
    run = lambda: langid.loss_and_gradient(p["w"], p["t"], rows, owner, x, y, there)
    assert_gradient(lambda: run()[0], p, dict(zip("wt", run()[1:])), p, rng)


def test_training_sequences_hold_every_word_once():
    rng = np.random.default_rng(9)
    texts = [([f"w{k}_{i}" for i in range(n)], k % 2) for k, n in enumerate((1, 2, 23, 24, 25, 300, 7))]
    for _ in range(5):
        made = langid._sequences(texts, rng)
        assert Counter((w, y) for s in made for words, y in s for w in words) == Counter((w, y) for own, y in texts for w in own)
        assert all(0 < sum(len(w) for w, _ in s) <= langid.SEQUENCE for s in made)
        assert any(len(s) > 1 for s in made)


def test_toxicity_learns_from_every_labelled_text(spark, monkeypatch):
    """The last ids by hash alone have a word of their own; runs of a few texts are averaged."""
    monkeypatch.setattr(toxicity, "RUN_TEXTS", 400)
    rng = np.random.default_rng(5)
    plain = lambda: " ".join(rng.choice(["the", "of", "house", "tree", "and", "river", "stone"], 20))
    ids = [r.id for r in spark.range(3400).filter("id % 2 = 1").orderBy(F.xxhash64("id"), "id").collect()]
    last = set(ids[1500:])
    rows = [(i, f"{plain()} {('grubby' if i in last else 'filthy') if i % 2 else 'clean'} {plain()}") for i in range(3400)]
    asked = [(10_000 + k, f"{plain()} {word} {plain()}") for k, word in enumerate(["grubby"] * 20 + ["filthy"] * 20 + ["clean"] * 20)]
    known = labelled(spark, "toxic", [(i, i % 2) for i in range(3400)])
    frame = spark.createDataFrame(rows + asked, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.score for r in toxicity.toxicity_scores(frame, known, F.lit(True)).filter("doc_id >= 10000").collect()}
    assert [found[10_000 + k] >= toxicity.THRESHOLD for k in range(60)] == [True] * 40 + [False] * 20


def test_labelled_texts_are_all_and_each_once(spark):
    rows = [(i, f"text {i}") for i in range(100)] + [(1, "text 1")] * 50 + [(200, None), (None, "x")]
    known = labelled(spark, "toxic", [(i, i % 2) for i in range(100)] + [(1, 1)] * 9 + [(200, 1), (300, 0), (None, 1), (2, None)])
    found = labelled_texts(docs(spark, rows), known, "toxic", F.col("doc_id") % 5 != 0).collect()
    assert sorted((r.doc_id, r.label, r.text) for r in found) == [(i, i % 2, f"text {i}") for i in range(100) if i % 5]


def test_changes_of_all_runs_are_averaged_in_any_order(spark):
    coder = toxicity.Words()
    rows = [(k % 2, coder.codes(f"the house {'filthy' if k % 2 else 'clean'} w{k}").tolist()) for k in range(90)]
    frame = spark.createDataFrame(rows, "label int, codes array<long>")
    p, weights = toxicity.start(np.random.default_rng(1)), np.array([1.0, 1.0])
    made = [toxicity._round(frame.repartition(n, "codes"), p, weights, 1, 7) for n in (3, 3, 1)]
    for k, value in toxicity._unpacked(toxicity._packed(p), p).items():
        assert np.array_equal(value, p[k]) and np.array_equal(made[0][k], made[1][k]) and not np.array_equal(made[2][k], p[k])
    # One run: what learning in place gives.
    whole = frame.repartition(1, "codes").collect()
    own = {k: v.copy() for k, v in p.items()}
    codes, y = [np.array(r.codes) for r in whole], np.array([float(r.label) for r in whole])
    toxicity.learn(own, codes, y, weights[y.astype(int)], np.arange(90), 1, np.random.default_rng(7))
    assert all(np.allclose(made[2][k], own[k], atol=1e-6) for k in own)

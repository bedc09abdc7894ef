"""Language ID by a linear-chain conditional random field over the words of a text.

Every word is labelled with a language, so text that switches between
languages is labelled piece by piece. A word's emission scores are the sum of
learned weights of its features: hashed n-grams of its bytes, its affixes, and
whether it is in a language's lexicon (frequent words of the training texts).
Learned transitions tie neighbours together, and forward-backward gives each
word's posterior. A text's language is the one with the largest mean
posterior, which is its score. How sure the labels are is another matter: the
mean of each word's largest posterior, high also for a text in many languages.

Training sequences are cut from texts of known language, all words of each;
half of them are spliced from two texts, mostly of two languages, so that
transitions learn that languages switch within a sequence. The sample is at most
`PER_LANGUAGE` texts of each language.

Forward-backward is exact over whole texts of any length: words are laid out in
blocks, the blocks' transfer matrices are multiplied up first, then all blocks
run their messages side by side in numpy. Scoring is a narrow map of all rows.

Defined cases: null text, or text without letters, is `und` with score 0; with
no training texts everything is `und`; repeated rows and null ids are labelled
as they are; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from hitloom.llm.common import saved, whole_text
from hitloom.llm.labelled import texts_of

UNDETERMINED = "und"
PER_LANGUAGE = 250
MAX_LANGUAGES = 200  # more different values than this are not languages: an error, not a cut

#: Hash rows of n-grams and affixes; lexicon rows and a bias come after them.
ROWS = 1 << 15
NGRAMS = (2, 3)
AFFIXES = (3, 4, 5)  # bytes, the word's boundary included

SEQUENCE = 24
EPOCHS = 2

#: Share of a language's texts that a word of its lexicon is in.
LEXICON_SHARE = 0.02

#: Words in a block of the scoring layout, words scored at a time, their scores at most, words kept by a worker.
BLOCK = 32
WORDS_AT_ONCE = 1 << 15
SCORES_AT_ONCE = 1 << 20
CACHE = 200_000

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    words = _LETTERS.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    # The pattern takes numerals such as a superscript two for letters.
    apart = ("".join(c if c.isalpha() else " " for c in w).split() for w in words)
    return [w for part in apart for w in part]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) % np.uint64(ROWS)


def features(words: list[str], lexicon: dict[str, list[int]], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature row, word number) pairs of these words."""
    data = [b"\x02" + w.encode() + b"\x03" for w in words]
    x = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.uint64)
    lengths = np.array([len(d) for d in data])
    owner = np.repeat(np.arange(len(words)), lengths)
    found, owners = [np.full(len(words), rows - 1)], [np.arange(len(words))]
    for n in sorted({*NGRAMS, *AFFIXES}):
        if len(x) < n:
            continue
        h = np.full(len(x) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(1_000_003) + x[k : len(x) - n + 1 + k]
        inside = owner[: len(h)] == owner[n - 1 :]
        if n in NGRAMS:
            at = np.flatnonzero(inside)
            found.append(_mix(h[at]).astype(np.int64))
            owners.append(owner[at])
        if n in AFFIXES:
            edge = inside & ((x[: len(h)] == 2) | (x[n - 1 :] == 3))
            at = np.flatnonzero(edge)
            found.append(_mix(h[at] + np.uint64(77)).astype(np.int64))
            owners.append(owner[at])
    listed = [(k, r) for k, w in enumerate(words) for r in lexicon.get(w, ())]
    if listed:
        k, r = np.array(listed).T
        found.append(r)
        owners.append(k)
    return np.concatenate(found), np.concatenate(owners)


def _emissions(weights: np.ndarray, rows: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, weights[rows, y], minlength=n) for y in range(weights.shape[1])], axis=1)


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def _potentials(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


def posteriors(emission: np.ndarray, transition: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exact word posteriors of texts laid one after the other; both inputs are potentials, not logarithms."""
    n_labels = emission.shape[1]
    blocks = -(-lengths // BLOCK)
    first = np.r_[0, np.cumsum(blocks)[:-1]]
    total = int(blocks.sum())
    # Each text's words fill its blocks from the left; missing words leave messages as they are.
    text = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = first[text] * BLOCK + within
    e = np.ones((total * BLOCK, n_labels))
    e[place] = emission
    e = e.reshape(total, BLOCK, n_labels)
    there = np.zeros(total * BLOCK, dtype=bool)
    there[place] = True
    there = there.reshape(total, BLOCK)
    starts = np.zeros(total, dtype=bool)
    starts[first] = True

    # Messages into each block, from the left and from the right. Texts of one block need none.
    left = np.full((total, n_labels), 1.0 / n_labels)
    right = np.full((total, n_labels), 1.0 / n_labels)
    long = np.flatnonzero(np.repeat(blocks > 1, blocks))
    if len(long):
        # A block's transfer matrix: row vector in, row vector out.
        eye = np.broadcast_to(np.eye(n_labels), (len(long), n_labels, n_labels)).copy()
        transfer = eye
        for k in range(BLOCK):
            step = (transfer.reshape(-1, n_labels) @ transition).reshape(transfer.shape)
            if k == 0:
                step[starts[long]] = eye[starts[long]]
            step = step * e[long, k, None, :]
            step /= step.sum(axis=(1, 2), keepdims=True)
            transfer = np.where(there[long, k, None, None], step, transfer)
        number = np.zeros(total, dtype=np.int64)
        number[long] = np.arange(len(long))
        # Text by text, but all texts at once.
        most = int(blocks.max())
        for j in range(1, most):
            at = first[blocks > j] + j
            left[at] = _normal(np.einsum("ni,nij->nj", left[at - 1], transfer[number[at - 1]]))
        for j in range(most - 2, -1, -1):
            at = first[blocks > j + 1] + j
            right[at] = _normal(np.einsum("nij,nj->ni", transfer[number[at + 1]], right[at + 1]))
    forward = np.empty_like(e)
    message = left
    for k in range(BLOCK):
        step = message @ transition
        if k == 0:
            step[starts] = message[starts]
        message = np.where(there[:, k, None], _normal(step * e[:, k]), message)
        forward[:, k] = message
    made = np.empty_like(e)
    message = right
    for k in range(BLOCK - 1, -1, -1):
        made[:, k] = forward[:, k] * message
        step = (message * e[:, k]) @ transition.T
        if k == 0:  # the message into the block before has been worked out above
            break
        message = np.where(there[:, k, None], _normal(step), message)
    return _normal(made.reshape(-1, n_labels)[place])


@dataclass
class WordCRF:
    languages: list[str]
    lexicon: dict[str, list[int]]
    weights: np.ndarray
    transition: np.ndarray  # potentials

    def emissions(self, words: list[str]) -> np.ndarray:
        rows, owner = features(words, self.lexicon, len(self.weights))
        return _potentials(_emissions(self.weights, rows, owner, len(words)))


class Labeller:
    """A worker's model with its cache of words."""

    def __init__(self, model: WordCRF):
        self.model, self.index = model, {}
        self.table = np.empty((0, len(model.languages)))

    def label(self, texts: list[str]) -> list[np.ndarray]:
        """Word posteriors of each text."""
        words = [words_of(t) for t in texts]
        if len(self.index) > CACHE:
            self.index, self.table = {}, self.table[:0]
        new = list({w for own in words for w in own}.difference(self.index))
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.table = np.vstack([self.table, self.model.emissions(new)])
        lengths = np.array([len(own) for own in words])
        made = [np.zeros((0, len(self.model.languages)))] * len(texts)
        some = np.flatnonzero(lengths)
        if len(some):
            get = self.index.__getitem__
            numbers = np.fromiter((get(w) for k in some for w in words[k]), dtype=np.int64, count=int(lengths.sum()))
            parts = posteriors(self.table[numbers], self.model.transition, lengths[some])
            for k, part in zip(some, np.split(parts, np.cumsum(lengths[some])[:-1])):
                made[k] = part
        return made


def _sequences(texts: list[tuple[list[str], int]], rng) -> list[list[tuple[list[str], int]]]:
    """All words of the texts as sequences, lists of (words, label) pieces; every other pair of cuts is spliced into two."""
    cut = []
    for words, label in texts:
        edges = [0, *range(int(rng.integers(1, SEQUENCE + 1)), len(words), SEQUENCE), len(words)]
        cut += [(words[a:b], label) for a, b in zip(edges, edges[1:])]
    rng.shuffle(cut)
    made = [[piece] for piece in cut[len(cut) - len(cut) % 2 :]]
    for number, ((a, x), (b, y)) in enumerate(zip(cut[::2], cut[1::2])):
        if number % 2:
            made += [[(a, x)], [(b, y)]]
        else:
            k = int(rng.integers(1, max(2, len(a))))
            made += [[(a[:k], x), (b[: SEQUENCE - k], y)]]
            if len(a) > k or len(b) > SEQUENCE - k:
                made += [[(b[SEQUENCE - k :], y), (a[k:], x)]]
    return made


def loss_and_gradient(
    weights: np.ndarray, moves: np.ndarray, rows: np.ndarray, owner: np.ndarray, x: np.ndarray, y: np.ndarray, there: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of the labels ``y`` of word sequences ``x``, and its derivatives by weights and transitions.

    ``rows`` and ``owner`` are the features of the words that ``x`` numbers; ``there`` tells words from padding.
    """
    n_labels, count = weights.shape[1], int(x.max()) + 1
    scores = _emissions(weights, rows, owner, count)
    table, move = _potentials(scores), np.exp(moves - moves.max())
    e = table[x]
    sums = np.empty(x.shape)
    alpha = np.empty(e.shape)
    beta = np.full(e.shape, 1.0 / n_labels)
    sums[:, 0] = e[:, 0].sum(axis=1)
    alpha[:, 0] = _normal(e[:, 0])
    for k in range(1, x.shape[1]):
        step = (alpha[:, k - 1] @ move) * e[:, k]
        sums[:, k] = step.sum(axis=1)
        alpha[:, k] = np.where(there[:, k, None], _normal(step), alpha[:, k - 1])
    for k in range(x.shape[1] - 2, -1, -1):
        beta[:, k] = np.where(there[:, k + 1, None], _normal((beta[:, k + 1] * e[:, k + 1]) @ move.T), beta[:, k])
    gold = np.eye(n_labels)[y]
    after = there[:, 1:]
    told = np.log((e * gold).sum(axis=2))[there].sum() + np.log(move[y[:, :-1], y[:, 1:]])[after].sum()
    loss = (np.log(sums)[there].sum() - told) / len(x)
    per_word = np.zeros((count, n_labels))
    np.add.at(per_word, x, np.where(there[..., None], _normal(alpha * beta) - gold, 0) / len(x))
    # A pair's posterior is alpha * move * beta over its sum; added up over all pairs it is one matrix product.
    left, right = alpha[:, :-1][after], (beta[:, 1:] * e[:, 1:])[after]
    pairs = move * ((left / ((left @ move) * right).sum(axis=1, keepdims=True)).T @ right)
    pairs -= gold[:, :-1][after].T @ gold[:, 1:][after]
    return loss, _emissions(per_word, owner, rows, len(weights)), pairs / len(x)


def train(texts: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 1) -> WordCRF | None:
    """Fit by Adam on the sequences' conditional likelihood; None without texts."""
    split = [(w, lang) for w, lang in ((words_of(t), lang) for t, lang in texts) if w]
    languages = sorted({lang for _, lang in split})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    number = {lang: k for k, lang in enumerate(languages)}
    n_labels = len(languages)
    known = Counter(lang for _, lang in split)
    counts = {lang: Counter() for lang in languages}
    for w, lang in split:
        counts[lang].update(set(w))
    lexicon = {}
    for lang in languages:
        least = max(2.0, LEXICON_SHARE * known[lang])
        for w in sorted(w for w, n in counts[lang].items() if n >= least):
            lexicon.setdefault(w, []).append(ROWS + number[lang])
    n_rows = ROWS + n_labels + 1
    vocabulary = sorted({w for own, _ in split for w in own})
    index = {w: k for k, w in enumerate(vocabulary)}
    rows, owner = features(vocabulary, lexicon, n_rows)
    rows = rows[np.argsort(owner, kind="stable")]
    size = np.bincount(owner, minlength=len(vocabulary))
    begin = np.cumsum(size) - size
    p = {"w": np.zeros((n_rows, n_labels)), "t": np.zeros((n_labels, n_labels))}
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    labelled = [(w, number[lang]) for w, lang in split]
    step = 0
    for _ in range(epochs):
        sequences = _sequences(labelled, rng)
        for low in range(0, len(sequences), 128):
            part = sequences[low : low + 128]
            step += 1
            n = max(sum(len(w) for w, _ in s) for s in part)
            x = np.zeros((len(part), n), dtype=np.int64)
            y = np.zeros((len(part), n), dtype=np.int64)
            there = np.zeros((len(part), n), dtype=bool)
            for k, s in enumerate(part):
                own = [index[w] for words, _ in s for w in words]
                x[k, : len(own)] = own
                y[k, : len(own)] = [label for words, label in s for _ in words]
                there[k, : len(own)] = True
            seen, own = np.unique(x, return_inverse=True)
            n_own = size[seen]
            at = np.arange(n_own.sum()) - np.repeat(np.cumsum(n_own) - n_own, n_own) + np.repeat(begin[seen], n_own)
            owners = np.repeat(np.arange(len(seen)), n_own)
            _, dw, dt = loss_and_gradient(p["w"], p["t"], rows[at], owners, own.reshape(x.shape), y, there)
            grad = {"w": dw + 1e-4 * p["w"], "t": dt + 1e-3 * p["t"]}
            for k, dk in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * dk
                second[k] = 0.99 * second[k] + 0.01 * dk * dk
                p[k] -= 0.05 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return WordCRF(languages, lexicon, p["w"], np.exp(p["t"] - p["t"].max()))


def training_texts(
    docs: DataFrame, may_train: Column, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> list[tuple[str, str]]:
    """At most `PER_LANGUAGE` texts of each language, by a hash of the id; one text, or a piece of it, for each id.

    Only rows with a text are looked at. An id counts once for a language, and of its rows one is kept before anything is
    collected.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull() & may_train)
    ids = saved(known.select(key, lang).distinct(), "training_ids")
    languages = [r[0] for r in ids.select(lang).distinct().orderBy(lang).limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different values in {lang}")
    if not languages:
        return []
    order = Window.partitionBy(lang).orderBy(F.xxhash64(key), key)
    picked = ids.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= PER_LANGUAGE).select(key, lang)
    pieces = texts_of(known, [tuple(r) for r in picked.collect()], [key, lang], text)
    return [(t, name) for (_, name), t in sorted(pieces.items(), key=lambda x: (x[0][1], str(x[0][0])))]


def _portions(column: pa.Array, n_labels: int):
    """Consecutive texts, so many words together that a portion's messages fit in little memory.

    A text counts whole blocks, as it is laid out; a text that is longer than a portion is one by itself.
    """
    most = min(WORDS_AT_ONCE, SCORES_AT_ONCE // n_labels)
    part: list[str] = []
    size = 0
    for value in column:
        part.append(value.as_py() or "")
        size += (len(part[-1]) // (6 * BLOCK) + 1) * BLOCK
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def _verdict(model: WordCRF, part: np.ndarray) -> tuple[str, float, float]:
    """The language of a text with these word posteriors, its mean posterior, and how sure the labels of its words are."""
    if not len(part):
        return UNDETERMINED, 0.0, 0.0
    mean = part.mean(axis=0)
    best = int(mean.argmax())
    score = min(1.0, float(mean[best]))
    return model.languages[best], score, min(1.0, max(score, float(part.max(axis=1).mean())))  # rounding put aside


def label_texts(
    docs: DataFrame, model: WordCRF | None, key: str = "doc_id", text: str = "text", spans: bool = False
) -> DataFrame:
    """(key, lang_pred, score) for every row; with ``spans`` also the runs of words of one language.

    A run is (lang, first word, number of words).
    """
    id_type = dict(docs.dtypes)[key]
    runs_type = "array<struct<lang:string,start:int,length:int>>"
    if model is None:
        made = docs.select(key, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
        return made.withColumn("runs", F.array().cast(runs_type)) if spans else made

    def runs(part: np.ndarray) -> list[dict]:
        labels = part.argmax(axis=1)
        cuts = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1], True]) if len(labels) else np.zeros(1, dtype=int)
        return [
            {"lang": model.languages[labels[a]], "start": int(a), "length": int(b - a)} for a, b in zip(cuts[:-1], cuts[1:])
        ]

    def run(batches):
        labeller = Labeller(model)
        for batch in batches:
            names, scores, found = [], [], []
            for portion in _portions(batch.column(1), len(model.languages)):
                for part in labeller.label(portion):
                    name, score, _ = _verdict(model, part)
                    names.append(name)
                    scores.append(score)
                    if spans:
                        found.append(runs(part))
            columns = [batch.column(0), pa.array(names), pa.array(scores)]
            labels = [key, "lang_pred", "score"]
            if spans:
                run_kind = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("length", pa.int32())])
                columns.append(pa.array(found, type=pa.list_(run_kind)))
                labels.append("runs")
            yield pa.RecordBatch.from_arrays(columns, names=labels)

    schema = f"{key} {id_type}, lang_pred string, score double" + (f", runs {runs_type}" if spans else "")
    return docs.select(F.col(key), whole_text(text).alias("text")).mapInArrow(run, schema)


def with_language(docs: DataFrame, model: WordCRF | None, text: str = "text", prefix: str = "_lang") -> DataFrame:
    """All rows and columns, and ``{prefix}_pred``, ``{prefix}_score`` and ``{prefix}_sure``; nothing is joined or shuffled."""
    made = [f"{prefix}_{name}" for name in ("pred", "score", "sure")]
    docs = docs.drop(*made)
    if model is None:
        return docs.withColumns(dict(zip(made, (F.lit(UNDETERMINED), F.lit(0.0), F.lit(0.0)))))
    at = docs.columns.index(text)

    def run(batches):
        labeller = Labeller(model)
        for batch in batches:
            portions = _portions(batch.column(at), len(model.languages))
            found = [_verdict(model, part) for texts in portions for part in labeller.label(texts)]
            columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.float64(), pa.float64()))]
            if found:
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *made])

    kinds = zip(made, (StringType(), DoubleType(), DoubleType()))
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *(StructField(*k) for k in kinds)]))


def identify(docs: DataFrame, may_train: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Train on the rows that ``may_train`` allows, and label every row."""
    return label_texts(docs, train(training_texts(docs, may_train, key, text, lang)), key, text)

"""Periodic runs in sequences of words: all maximal stretches that repeat with some period.

A run is a stretch with smallest period ``q`` (words ``q`` apart are equal) that
is at least ``max(MIN_LENGTH, 2 * q)`` words long and that no neighbouring word
extends. Runs are found by longest common extensions (LCE) on a harmonic grid:
for every period ``p``, only the words at multiples of ``p`` are compared with
those ``p`` further on, since a run of period ``p`` holds such a pair. How far
both agree to the right and to the left gives the run. A sequence of ``n`` words
has about ``n log n`` grid pairs, and most differ in the words themselves.

LCEs come from a difference cover: of the suffixes, only those that start at
residues in `COVER` modulo `STEP` are sorted. For any two places there is a
shift below `STEP` that takes both to sorted suffixes; the words before it are
compared, the rest is a range minimum over the common prefixes of neighbours in
the sorted order, taken from a sparse table. Extensions to the left use the same
on the words backwards.

Sequences of a batch are searched together, with separators that occur once, so
numpy runs over long arrays however short the texts are. Rows stay in their
tasks: no shuffle. A sequence of any length is searched whole; memory is some
200 bytes a word of the longest one, grid pairs are made in blocks.

Defined cases: a null or empty sequence has no run and collapses to the empty
text; null words are words of their own, equal to each other, left out of the
collapsed text; null and repeated keys are rows like any other; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of the shortest run.
MIN_LENGTH = 12

# A perfect difference set. Any residue modulo 57 is the difference of two of its members.
STEP = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)

#: Words that are searched together, if no single sequence has more.
BATCH_WORDS = 1 << 17

#: Grid pairs that are made at a time.
BLOCK_PAIRS = 1 << 16

RUNS = "array<struct<start:long,length:long,period:long>>"


def _shifts() -> np.ndarray:
    """``[i, j]``: the least shift that takes residues ``i`` and ``j`` into the cover together."""
    inside = np.zeros(STEP, dtype=bool)
    inside[list(COVER)] = True
    residues = (np.arange(STEP)[:, None] + np.arange(STEP)[None, :]) % STEP  # residue, shift
    both = inside[residues][:, None, :] & inside[residues][None, :, :]
    return both.argmax(axis=2)


_SHIFTS = _shifts()
_PLACE = np.zeros(STEP, dtype=np.int64)
_PLACE[list(COVER)] = np.arange(len(COVER))


class Extensions:
    """How many words two places of an array have in common from there on.

    ``words`` are positive numbers; the last one must occur once.
    """

    def __init__(self, words: np.ndarray):
        self.words = np.concatenate([words, np.zeros(STEP, dtype=words.dtype)])
        n = len(words)
        places = (np.arange(0, n, STEP)[:, None] + np.array(COVER)[None, :]).ravel()
        self.sampled = np.minimum(places, n)  # those beyond the end are the empty suffix
        self.rank, levels = self._sort()
        order = np.empty(len(self.rank), dtype=np.int64)
        order[self.rank] = np.arange(len(order))
        self._table(self._common(order[:-1], order[1:], levels))

    def _sort(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Ranks of the sampled suffixes, and their names by the first STEP, 2 * STEP, 4 * STEP ... words.

        A name is the number of suffixes in smaller groups; only groups of several are looked at again.
        """
        width = int(self.words.max()).bit_length()
        pack = max(1, 62 // width)
        name = np.zeros(len(self.sampled), dtype=np.int64)
        open_ = np.arange(len(name))
        for low in range(0, STEP, pack):
            key = np.zeros(len(open_), dtype=np.int64)
            for k in range(low, min(low + pack, STEP)):
                key = (key << width) | self.words[np.minimum(self.sampled[open_] + k, len(self.words) - 1)]
            open_ = self._refine(name, open_, key)
        levels, step = [name.copy()], len(COVER)
        while len(open_):
            further = open_ + step
            key = np.where(further < len(name), levels[-1][np.minimum(further, len(name) - 1)], -1)
            open_ = self._refine(name, open_, key)
            levels.append(name.copy())
            step *= 2
            if step > 2 * len(name):  # only empty suffixes are left: they are all the same
                name[open_] += np.arange(len(open_)) - np.searchsorted(np.sort(name[open_]), name[open_])
                break
        return name, levels

    @staticmethod
    def _refine(name: np.ndarray, open_: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Split groups by a further key; returns the members of groups that are still of several."""
        if not len(open_):
            return open_
        order = np.lexsort((key, name[open_]))
        members, old, key = open_[order], name[open_][order], key[order]
        at = np.arange(len(members))
        new_group = np.append(True, old[1:] != old[:-1])
        new_part = new_group | np.append(True, key[1:] != key[:-1])
        group_at = np.maximum.accumulate(np.where(new_group, at, 0))
        part_at = np.maximum.accumulate(np.where(new_part, at, 0))
        name[members] = old + part_at - group_at
        alone = new_part & np.append(new_part[1:], True)
        return members[~alone]

    def _common(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of sampled suffixes that are neighbours in the order."""
        a, b = a.copy(), b.copy()
        found = np.zeros(len(a), dtype=np.int64)
        last = len(self.sampled) - 1
        for level in range(len(levels) - 1, -1, -1):
            same = (a <= last) & (b <= last)
            same &= levels[level][np.minimum(a, last)] == levels[level][np.minimum(b, last)]
            found[same] += STEP << level
            a[same] += len(COVER) << level
            b[same] += len(COVER) << level
        inside = (a <= last) & (b <= last)
        i, j = self.sampled[np.minimum(a, last)], self.sampled[np.minimum(b, last)]
        return found + np.where(inside, self._direct(i, j, np.full(len(i), STEP)), 0)

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common words of places, at most ``most`` (STEP or less), by comparing them one after another."""
        found = np.zeros(len(i), dtype=np.int64)
        on = np.flatnonzero(most > 0)
        for k in range(STEP):
            on = on[self.words[i[on] + k] == self.words[j[on] + k]]
            found[on] += 1
            on = on[most[on] > k + 1]
            if not len(on):
                break
        return found

    def _table(self, common: np.ndarray) -> None:
        rows = [common.astype(np.int32 if len(self.words) < 1 << 31 else np.int64)]
        while 2 << (len(rows) - 1) <= len(common):
            half = 1 << (len(rows) - 1)
            rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
        self.starts = np.cumsum([0] + [len(r) for r in rows])
        self.minima = np.concatenate(rows)

    def _sorted(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common words of two different sampled suffixes, given by rank: the least between them."""
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        start = self.starts[level]
        return np.minimum(self.minima[start + low], self.minima[start + high - (1 << level.astype(np.int64))])

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from ``i`` and ``j`` on; the two must differ, pair by pair."""
        shift = _SHIFTS[i % STEP, j % STEP]
        found = self._direct(i, j, shift)
        on = np.flatnonzero(found == shift)
        a, b = i[on] + shift[on], j[on] + shift[on]
        ranks = (self.rank[x // STEP * len(COVER) + _PLACE[x % STEP]] for x in (a, b))
        found[on] += self._sorted(*ranks)
        return found


def _grid(sizes: np.ndarray, min_length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (sequence, period, place): multiples of each period up to half of the sequence."""
    periods = np.where(sizes >= min_length, sizes // 2, 0)
    ends = np.cumsum(periods)
    for low, high in _blocks(sizes, periods, ends):
        at = np.arange(low, high)
        seq = np.searchsorted(ends, at, side="right")
        period = at - (ends[seq] - periods[seq]) + 1
        times = (sizes[seq] - 1) // period
        first = np.cumsum(times) - times
        k = np.arange(times.sum()) - np.repeat(first, times)
        period = np.repeat(period, times)
        yield np.repeat(seq, times), period, k * period


def _blocks(sizes: np.ndarray, periods: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of (sequence, period) numbers with some BLOCK_PAIRS pairs each."""
    total, low = int(ends[-1]) if len(ends) else 0, 0
    while low < total:
        at = np.arange(low, min(total, low + BLOCK_PAIRS))
        seq = np.searchsorted(ends, at, side="right")
        pairs = np.cumsum((sizes[seq] - 1) // (at - (ends[seq] - periods[seq]) + 1))
        high = low + max(1, int(np.searchsorted(pairs, BLOCK_PAIRS, side="right")))
        yield low, high
        low = high


def find_runs(sequences: list[np.ndarray], min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (sequence, start, length, period) of all runs, by sequence, start and period.

    Words are numbers from 1 on; equal words have equal numbers across sequences.
    """
    sizes = np.array([len(s) for s in sequences], dtype=np.int64)
    if not len(sizes) or sizes.max() < min_length:
        return np.zeros((0, 4), dtype=np.int64)
    most = max(int(s.max()) for s in sequences if len(s))
    parts: list[np.ndarray] = [np.array([most + 1], dtype=np.int64)]
    for k, s in enumerate(sequences):
        parts += [s.astype(np.int64), np.array([most + 2 + k], dtype=np.int64)]
    words = np.concatenate(parts)
    starts = np.cumsum(sizes + 1) - sizes
    ahead, back, end = Extensions(words), Extensions(words[::-1].copy()), len(words) - 1
    found = []
    for seq, p, place in _grid(sizes, min_length):
        i = starts[seq] + place
        same = (words[i] == words[i + p]) | (words[i - 1] == words[i + p - 1])
        seq, p, place, i = seq[same], p[same], place[same], i[same]
        if not len(i):
            continue
        left = back(end - (i - 1), end - (i + p - 1))
        right = ahead(i, i + p)
        # The first grid place inside a run finds it; later ones lie a period or more behind its start.
        run = (left + right >= np.maximum(p, min_length - p)) & (left < p)
        found.append(np.stack([seq[run], place[run] - left[run], left[run] + right[run] + p[run], p[run]], axis=1))
    rows = np.concatenate(found) if found else np.zeros((0, 4), dtype=np.int64)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    # Multiples of the smallest period give the same stretch again.
    new = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)) if len(rows) else np.zeros(0, dtype=bool)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _dropped(sizes: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """For the words of all sequences in a row: whether a run holds the word after its first period."""
    starts = np.cumsum(sizes) - sizes
    change = np.zeros(int(sizes.sum()) + 1, dtype=np.int64)
    low = starts[runs[:, 0]] + runs[:, 1]
    np.add.at(change, low + runs[:, 3], 1)
    np.add.at(change, low + runs[:, 2], -1)
    return np.cumsum(change[:-1]) > 0


def _portions(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive sequences of some BATCH_WORDS words."""
    low, total = 0, 0
    for k, n in enumerate(sizes):
        if k > low and total + n > BATCH_WORDS:
            yield low, k
            low, total = k, 0
        total += n
    if low < len(sizes):
        yield low, len(sizes)


def _searched(lists: pa.ListArray, min_length: int) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed texts of some sequences."""
    values = lists.flatten()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(values, null_encoding="encode")
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends = np.cumsum(sizes)
    runs = find_runs(np.split(codes, ends[:-1]), min_length)
    gone = _dropped(sizes, runs)
    bounds = np.searchsorted(runs[:, 0], np.arange(len(sizes) + 1))
    fields = [pa.array(runs[:, k], pa.int64()) for k in (1, 2, 3)]
    structs = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
    kept = ~gone & values.is_valid().to_numpy(zero_copy_only=False)
    left = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])]
    words = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), values.filter(pa.array(kept)).cast(pa.large_string()))
    texts = pc.binary_join(words, pa.scalar(" ", pa.large_string())).cast(pa.string())
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs), texts


def periodic_runs(df: DataFrame, words: str = "words", key: str = "doc_id", min_length: int = MIN_LENGTH) -> DataFrame:
    """(key, runs, collapsed) for each row's array of words.

    ``runs`` are in order of start and period. ``collapsed`` are the words, joined
    by a space, less those that some run holds after its first period.
    """
    id_type = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            for low, high in _portions(sizes):
                runs, texts = _searched(lists.slice(low, high - low), min_length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), runs, texts], names=[key, "runs", "collapsed"]
                )

    return df.select(F.col(f"`{key}`"), F.col(f"`{words}`").alias("words")).mapInArrow(run, f"`{key}` {id_type}, runs {RUNS}, collapsed string")

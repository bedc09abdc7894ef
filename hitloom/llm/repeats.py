"""Repeated byte strings of a corpus, from an enhanced suffix array in buckets.

A byte is repeated if a string of `LENGTH` bytes covers it that also starts
earlier (in a smaller document, or before in the same one). Strings never cross
documents.

Anchors. Every window of `LENGTH` bytes has an anchor, the leftmost of its
`GRAM`-byte strings with the smallest hash. Equal windows have equal anchors at
the same place, so suffixes need to be compared only where they start at equal
anchors. First all anchors are counted by hash (hashes and places only); then,
for anchors that occur again, the bytes of the windows they stand for are dealt
to buckets by hash. In a bucket the suffixes that start at the anchors are
sorted; a stack scan over their common prefixes gives the interval tree.
Within an interval the bytes to the left are compared in the same way: where
the left extension becomes diverse, and not all members lie in one child
interval, the members are a maximal repeat group with all its occurrences. All
but the first occurrence of a group are repeated bytes. Groups are maximal up to
the windows' horizon; a longer repeat is the union of its anchors' groups.

Hot anchors. Contexts at the edges of a passage differ with each neighbour, so an
anchor that very many documents share can have very many contexts. An anchor
that occurs `HOT` times or more is not resolved in one bucket: its contexts are
split into their windows of `LENGTH` bytes, which are dealt out by a digest of
their bytes. Tasks send the first occurrence of a window only, so a common window
costs little and different ones are spread. `repeat_groups` lists
whole groups and so does not split anchors.

Copies cost little: contexts that are equal within a task are sent once, with
their first occurrence, and the others are known to be repeated. So the bytes
of a bucket grow with the number of different contexts, not with copies.
Documents get a number each when they are first written to the shared folder.
They are spread and joined by that number only; the id just says which
occurrence is earlier, so however many rows share an id, or have none, they are
rows like any other. Documents are shuffled once; that exchange serves all three
passes.

Defined cases: null or empty text has no bytes; rows without an id come before
all others; rows that share an id are separate documents, ordered by a hash of
their text (equal ones by either order, with the same counts); texts shorter
than `LENGTH` keep all bytes; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import scratch_dir, whole_text

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1  # grams in a window

#: Bytes hashed at a time; windows of a longer text are hashed in pieces.
BLOCK = 1 << 19
#: Anchors, and contexts, that a task holds before it sends them on.
HELD_ANCHORS = 1 << 19
HELD_CONTEXTS = 1 << 17
#: Bytes of text that a bucket stands for at most, on average; there is at least one for each shuffle partition.
BUCKET_BYTES = 1 << 26
#: Bytes of the documents whose results one group holds at most, on average; at least one group for each shuffle partition too.
SHARE_BYTES = 1 << 24
#: Occurrences from which an anchor is split by the bytes around it.
HOT = 1 << 15

# An odd multiplier for rolling hashes modulo 2**64 and its inverse.
_BASE = 6364136223846793005
_INVERSE = pow(_BASE, -1, 1 << 64)

_FIRST_ID = -(1 << 63)


class Anchors:
    """Finds the anchors of many texts at a time."""

    def __init__(self):
        size = BLOCK + (1 << 12)
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE, dtype=np.uint64)])
        self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(size, _INVERSE, dtype=np.uint64)])

    def of(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """Blocks of (text, anchor, hash, first window, last window); places are offsets in the text."""
        parts: list[tuple[int, int, bytes]] = []
        size = 0
        step = BLOCK // 2
        for k, t in enumerate(texts):
            for low in range(0, len(t) - LENGTH + 1, step):
                piece = t[low : low + step + LENGTH - 1]
                if size + len(piece) > BLOCK:
                    yield self._block(parts)
                    parts, size = [], 0
                parts.append((k, low, piece))
                size += len(piece)
        if parts:
            yield self._block(parts)

    def _block(self, parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        x = np.frombuffer(b"".join(p for _, _, p in parts), dtype=np.uint8).astype(np.uint64)
        n = len(x)
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum((x + np.uint64(1)) * self.powers[:n], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * self.inverses[: n - GRAM + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        # Leftmost smallest hash of each window: the end of one row of a table and the start of the next.
        windows = n - LENGTH + 1
        fill = -len(h) % SPAN
        table = np.r_[h, np.full(fill, np.iinfo(np.uint64).max, dtype=np.uint64)].reshape(-1, SPAN)
        column = np.arange(SPAN, dtype=np.int32)
        before = np.minimum.accumulate(table, axis=1)
        record = np.zeros(table.shape, dtype=np.int32)
        record[:, 1:] = np.where(table[:, 1:] < before[:, :-1], column[1:], 0)
        before_at = np.maximum.accumulate(record, axis=1).ravel()
        after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1]
        record = np.where(table == after, column, SPAN)
        after_at = np.minimum.accumulate(record[:, ::-1], axis=1)[:, ::-1].ravel()
        i = np.arange(windows)
        j = i + SPAN - 1
        at = np.where(
            after.ravel()[:windows] <= before.ravel()[SPAN - 1 : SPAN - 1 + windows],
            i - i % SPAN + after_at[:windows],
            j - j % SPAN + before_at[SPAN - 1 : SPAN - 1 + windows],
        )
        lengths = np.array([len(p) for _, _, p in parts])
        edges = np.r_[0, np.cumsum(lengths)]
        part = np.repeat(np.arange(len(parts)), lengths)
        valid = part[:windows] == part[LENGTH - 1 :]
        same = np.r_[False, (at[1:] == at[:-1]) & valid[1:] & valid[:-1]]
        first = np.flatnonzero(valid & ~same)
        last = np.flatnonzero(valid & ~np.r_[same[1:], False])
        anchor, own = at[first], part[first]
        shift = np.array([low for _, low, _ in parts])[own] - edges[own]
        text = np.array([k for k, _, _ in parts])[own]
        return text, anchor + shift, h[anchor], first + shift, last + shift


def _packed(*arrays: np.ndarray, tail: bytes = b"") -> bytes:
    data = len(arrays[0]).to_bytes(8, "little") + b"".join(a.tobytes() for a in arrays) + tail
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpacked(blob: bytes, *kinds: str) -> tuple[list[np.ndarray], bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at, made = int.from_bytes(data[:8], "little"), 8, []
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        made.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
        at += size
    return made, data[at:]


# What tasks send: data for a bucket, or (owner set) results for a share of the documents, which buckets pass on.
_PART = pa.schema([("bucket", pa.int32()), ("owner", pa.int32()), ("data", pa.binary())])
_PART_DDL = "bucket int, owner int, data binary"
_RESULT_DDL = "owner int, data binary"


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), _PART.types)], names=_PART.names)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal values begin and end."""
    cuts = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]).tolist() if len(values) else [0]
    return list(zip(cuts[:-1], cuts[1:]))


def _by_owner(table: np.ndarray, owners: int) -> list[tuple[int, bytes]]:
    """Rows of a table of int64 whose first column is the document, one blob per share of the documents."""
    owner = table[:, 0] % owners
    order = np.argsort(owner, kind="stable")
    owner, table = owner[order], np.ascontiguousarray(table[order])
    return [(int(owner[a]), _packed(*table[a:b].T.copy())) for a, b in _runs(owner)]


#: Stands for a document in rows that name a hot anchor.
_NO_ROW = -1


def _by_document(columns: int, marks: bool = False):
    """Results of a share of the documents, one row per document: its table without the first column.

    With ``marks`` the last column is an anchor's hash, and becomes 1 for a hot anchor and 0 for others.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        tables = [np.stack(_unpacked(x, *["i8"] * columns)[0], axis=1) for x in frame["data"]]
        table = np.concatenate(tables)
        if marks:
            named = table[:, 0] == _NO_ROW
            hot = np.unique(table[named, 2])
            table = table[~named]
            table[:, 2] = np.isin(table[:, 2], hot)
        table = np.ascontiguousarray(table[np.argsort(table[:, 0], kind="stable")])
        rows = [(table[a, 0], table[a:b, 1:].tobytes()) for a, b in _runs(table[:, 0])]
        return pd.DataFrame(rows, columns=["row", "data"])

    return run


def _documents(batch: pa.RecordBatch, size: int = 64):
    """Slices of (row, did, tie, texts as bytes, other column) of a batch."""
    row, did, tie = (batch.column(k).to_numpy() for k in (0, 1, 2))
    for low in range(0, batch.num_rows, size):
        texts = [x.as_py() for x in batch.column(3).slice(low, size)]
        more = batch.column(4).slice(low, size).to_pylist() if batch.num_columns > 4 else None
        yield row[low : low + size], did[low : low + size], tie[low : low + size], texts, more


def _send_anchors(buckets: int, owners: int):
    """Pass 1: hashes of anchors to their buckets; anchors that occur twice in a task are known at once."""

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        h, row, place = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(h, kind="stable")
        h, row, place = h[order], row[order], place[order]
        new = np.r_[True, h[1:] != h[:-1]]
        twin = ~new | ~np.r_[new[1:], True]
        rows = []
        for k, data in _by_owner(np.stack([row[twin], place[twin], h[twin].view(np.int64)], axis=1), owners):
            rows.append((k % buckets, k, data))
        many = np.diff(np.r_[np.flatnonzero(new), len(h)]).astype(np.int32)
        h, row, place = h[new], row[new], place[new]
        bucket = (h % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        for a, b in _runs(bucket[order]):
            k = order[a:b]
            rows.append((int(bucket[k[0]]), None, _packed(h[k], row[k], place[k], many[k])))
        yield _part_batch(rows)

    def run(batches):
        finder, held, size = Anchors(), [], 0
        for batch in batches:
            for row, _, _, texts, _ in _documents(batch):
                for text, place, h, _, _ in finder.of(texts):
                    held.append((h, row[text], place))
                    size += len(h)
                if size >= HELD_ANCHORS:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)

    return run


def _find_again(owners: int):
    """A bucket of pass 1: the places of anchors whose hash occurs again, and to all owners which anchors are hot.

    Few anchors are: of n, at most n / `HOT`.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        known = frame[frame["owner"].notna()]
        rows = list(zip(known["owner"].astype("int32"), known["data"]))
        blobs = [_unpacked(x, "u8", "i8", "i8", "i4")[0] for x in frame.loc[frame["owner"].isna(), "data"]]
        if blobs:
            h, row, place, many = (np.concatenate(c) for c in zip(*blobs))
            order = np.argsort(h, kind="stable")
            sorted_h = h[order]
            same = np.r_[False, sorted_h[1:] == sorted_h[:-1]]
            again = np.zeros(len(h), dtype=bool)
            again[order] = same | np.r_[same[1:], False]
            again |= many > 1
            starts = np.flatnonzero(~same)
            hot = sorted_h[starts][np.add.reduceat(many[order].astype(np.int64), starts) >= HOT]
            # The hashes of others are not needed any more.
            named = np.where(np.isin(h, hot), h, np.uint64(0)).view(np.int64)
            if len(hot):
                none = np.zeros(len(hot), dtype=np.int64)
                data = _packed(none + _NO_ROW, none, hot.view(np.int64))
                rows += [(k, data) for k in range(owners)]
            rows += _by_owner(np.stack([row[again], place[again], named[again]], axis=1), owners)
        return pd.DataFrame(rows, columns=["owner", "data"])

    return run


def _contexts(batch: pa.RecordBatch, finder: Anchors) -> Iterator[tuple[tuple, int, int, bytes, bool]]:
    """((did, tie, row, first window), anchor, hash, bytes, hot) for each marked anchor of a batch of documents with marks.

    The first of these are in the order of occurrences.
    """
    for row, did, tie, texts, marks in _documents(batch):
        tables = [np.frombuffer(data, dtype=np.int64).reshape(-1, 2) for data in marks]
        wanted = [x[:, 0] for x in tables]
        hot = [set(x[x[:, 1] != 0, 0].tolist()) for x in tables]
        for text, place, h, first, last in finder.of(texts):
            for k in np.unique(text):
                own = np.flatnonzero(text == k)
                own = own[np.isin(place[own], wanted[k])]
                d, e, r, t = int(did[k]), int(tie[k]), int(row[k]), texts[k]
                for p, v, a, z in zip(*(x[own].tolist() for x in (place, h, first, last))):
                    yield (d, e, r, a), p, v, t[a : z + LENGTH], p in hot[k]


def _windows(held: dict[bytes, tuple], spans: list) -> dict[bytes, tuple]:
    """The first occurrence of each window of these contexts, by its digest; spans get the others."""
    found: dict[bytes, tuple] = {}
    for context, (d, e, r, a) in held.items():
        for k in range(len(context) - LENGTH + 1):
            name = hashlib.blake2b(context[k : k + LENGTH], digest_size=16).digest()
            now = (d, e, r, a + k)
            before = found.setdefault(name, now)
            if before is not now:
                if now < before:
                    found[name], now = now, before
                spans.append((now[2], now[3], now[3] + LENGTH))
    return found


#: Owner of rows that hold windows of hot anchors.
_WINDOWS = -1
_WINDOW_KINDS = ("u8", "u8", "i8", "i8", "i8", "i8")


def _send_contexts(buckets: int, owners: int, split: bool = True):
    """Pass 2: the bytes of the windows of such anchors, each different context of a task once.

    With ``split``, of hot anchors the digests of their windows instead.
    """

    def flush(held: dict[bytes, tuple], hot: dict[bytes, tuple], spans: list) -> Iterator[pa.RecordBatch]:
        rows = []
        windows = _windows(hot, spans)
        if spans:
            for k, data in _by_owner(np.array(spans, dtype=np.int64), owners):
                rows.append((k % buckets, k, data))
        if windows:
            digest = np.frombuffer(b"".join(windows), dtype=np.uint64).reshape(-1, 2)
            seen = np.array(list(windows.values()), dtype=np.int64)
            bucket = (digest[:, 0] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            for a, b in _runs(bucket[order]):
                k = order[a:b]
                rows.append((int(bucket[k[0]]), _WINDOWS, _packed(*digest[k].T.copy(), *seen[k].T.copy())))
        if held:
            contexts = list(held)
            did, tie, row, first = (np.array(c, dtype=np.int64) for c in zip(*(seen for seen, _, _ in held.values())))
            offset = np.array([o for _, o, _ in held.values()], dtype=np.int32)
            h = np.array([v for _, _, v in held.values()], dtype=np.uint64)
            bucket = (h % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((h, bucket))
            sizes = np.array([len(c) for c in contexts], dtype=np.int32)
            for a, b in _runs(bucket[order]):
                k = order[a:b]
                arrays = (h[k], did[k], tie[k], row[k], first[k], offset[k], sizes[k])
                rows.append((int(bucket[k[0]]), None, _packed(*arrays, tail=b"".join(contexts[i] for i in k))))
        yield _part_batch(rows)

    def run(batches):
        finder = Anchors()
        held: dict[bytes, tuple] = {}
        hot: dict[bytes, tuple] = {}
        spans: list[tuple] = []
        n_windows = 0
        for batch in batches:
            for seen, p, v, context, is_hot in _contexts(batch, finder):
                if split and is_hot:
                    before = hot.setdefault(context, seen)
                    if before is seen:
                        n_windows += len(context) - LENGTH + 1
                    else:
                        hot[context], (_, _, r, a) = min(before, seen), max(before, seen)
                        spans.append((r, a, a + len(context)))
                else:
                    now = (seen, p - seen[3], v)
                    before = held.setdefault(context, now)
                    if before is not now:
                        if seen < before[0]:
                            held[context], now = now, before
                        _, _, r, a = now[0]
                        spans.append((r, a, a + len(context)))
                if len(held) + n_windows + len(spans) >= HELD_CONTEXTS:
                    yield from flush(held, hot, spans)
                    held, hot, spans, n_windows = {}, {}, [], 0
        if held or hot:
            yield from flush(held, hot, spans)

    return run


def _context_id(context: bytes, h: int) -> bytes:
    return hashlib.blake2b(context, digest_size=16, key=h.to_bytes(8, "little")).digest()


_OCCURRENCES = "context binary, row long, place long"


def _list_occurrences(batches) -> Iterator[pa.RecordBatch]:
    """Every marked anchor with the id of its context."""
    finder = Anchors()
    kinds = (pa.binary(), pa.int64(), pa.int64())
    names = [x.split()[0] for x in _OCCURRENCES.split(", ")]
    rows: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for (_, _, r, _), p, v, context, _ in _contexts(batch, finder):
            rows.append((_context_id(context, v), r, p))
            if len(rows) >= 50_000:
                yield batch_of()
                rows.clear()
    if rows:
        yield batch_of()


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def _intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the interval tree's nodes of depth >= least; ``lcp[i]`` is between i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        start = i
        while stack and stack[-1][0] > depth:
            d, start = stack.pop()
            if d >= least:
                yield d, start, i
        if not stack or stack[-1][0] < depth:
            stack.append((depth, start))


def _least_of(values: list[int]):
    """Least value in [a, b), in time that does not grow with the range."""
    levels = [np.array(values, dtype=np.int64)]
    while len(levels[-1]) > 1 << (len(levels) - 1):
        below, step = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(below[:-step], below[step:]))

    def least(a: int, b: int) -> int:
        if b - a <= 64:
            return min(values[a:b])
        k = (b - a).bit_length() - 1
        return int(min(levels[k][a], levels[k][b - (1 << k)]))

    return least


def maximal_groups(lefts: list[bytes], rights: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of each maximal repeat of ``length`` bytes or more around one anchor.

    ``rights`` are the suffixes that start at the anchor, ``lefts`` the bytes
    before it, reversed. Members share exactly ``left`` bytes before and
    ``right`` bytes from the anchor on.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [_common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    least = _least_of(lcp)
    rank = {k: i for i, k in enumerate(order)}
    by_left = {k: i for i, k in enumerate(sorted(range(len(lefts)), key=lefts.__getitem__))}
    for depth, first, last in _intervals(lcp, 1):
        need = max(0, length - depth)
        members = [k for k in order[first : last + 1] if len(lefts[k]) >= need]
        if len(members) < 2:
            continue
        members.sort(key=by_left.__getitem__)
        common = [_common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for left, i, j in _intervals(common, need):
            group = members[i : j + 1]
            places = [rank[k] for k in group]
            if least(min(places), max(places)) == depth:
                yield left, depth, group


def _find_repeats(owners: int):
    """A bucket of pass 2: the repeated spans (row, start, end)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        known = frame[frame["owner"] >= 0]
        rows = list(zip(known["owner"].astype("int32"), known["data"]))
        again = _windows_again(frame.loc[frame["owner"] == _WINDOWS, "data"])
        if len(again):
            rows += _by_owner(again, owners)
        if spans := _repeats_of(frame.loc[frame["owner"].isna(), "data"]):
            rows += _by_owner(np.array(spans, dtype=np.int64), owners)
        return pd.DataFrame(rows, columns=["owner", "data"])

    return run


def _windows_again(blobs) -> np.ndarray:
    """(row, start, end) of all but the first occurrence of each window."""
    parts = [_unpacked(x, *_WINDOW_KINDS)[0] for x in blobs]
    if not parts:
        return np.empty((0, 3), dtype=np.int64)
    high, low, did, tie, row, first = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((first, row, tie, did, low, high))
    again = order[1:][(high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])]
    return np.stack([row[again], first[again], first[again] + LENGTH], axis=1)


def _anchor_groups(blobs) -> Iterator[tuple[int, list[tuple], list[bytes], list[int]]]:
    """Per anchor with several contexts: its hash, their first occurrences, their bytes and the anchor's offsets in them."""
    arrays, texts = [], []
    for blob in blobs:
        part, tail = _unpacked(blob, "u8", "i8", "i8", "i8", "i8", "i4", "i4")
        arrays.append(part)
        ends = np.cumsum(part[6]).tolist()
        texts += [tail[a:b] for a, b in zip([0, *ends], ends)]
    if not arrays:
        return
    h, *seen, offset, _ = (np.concatenate(c) for c in zip(*arrays))
    order = np.argsort(h, kind="stable")
    seen, offset = list(zip(*(x.tolist() for x in seen))), offset.tolist()
    for a, b in _runs(h[order]):
        own = order[a:b].tolist()
        yield int(h[own[0]]), [seen[k] for k in own], [texts[k] for k in own], [offset[k] for k in own]


def _repeats_of(blobs) -> list[tuple[int, int, int]]:
    spans: list[tuple[int, int, int]] = []
    for _, seen, texts, offsets in _anchor_groups(blobs):
        if len(seen) < 2:
            continue
        rights = [t[o:] for t, o in zip(texts, offsets)]
        lefts = [t[:o][::-1] for t, o in zip(texts, offsets)]
        reach: dict[int, list[int]] = {}
        for left, right, group in maximal_groups(lefts, rights):
            earliest = min(group, key=seen.__getitem__)
            for k in group:
                if k != earliest:
                    most = reach.setdefault(k, [left, right])
                    most[0], most[1] = max(most[0], left), max(most[1], right)
        for k, (left, right) in reach.items():
            _, _, row, first = seen[k]
            at = first + offsets[k]
            spans.append((row, at - left, at + right))
    return spans


_GROUPS = "context binary, repeat binary, left int, length int"


def _find_groups(frame: pd.DataFrame) -> pd.DataFrame:
    """A bucket of pass 2: which contexts belong to which maximal repeats, named by a digest of their bytes."""
    rows: dict[tuple, None] = {}
    for h, _, texts, offsets in _anchor_groups(frame.loc[frame["owner"].isna(), "data"]):
        distinct = list(dict(zip(texts, offsets)).items())
        rights = [t[o:] for t, o in distinct]
        lefts = [t[:o][::-1] for t, o in distinct]
        found = [(left, right, group) for left, right, group in maximal_groups(lefts, rights)]
        # A whole context may occur many times and still be a repeat that goes no further.
        found += [(o, len(t) - o, [k]) for k, (t, o) in enumerate(distinct)]
        for left, right, group in found:
            t, o = distinct[group[0]]
            name = hashlib.blake2b(t[o - left : o + right], digest_size=16).digest()
            for k in group:
                rows[_context_id(distinct[k][0], h), name, left, left + right] = None
    return pd.DataFrame(list(rows), columns=["context", "repeat", "left", "length"])


def merged_spans(data: bytes | None) -> np.ndarray:
    """Maximal runs (start, end) of a document's repeated spans."""
    table = np.frombuffer(data or b"", dtype=np.int64).reshape(-1, 2)
    if not len(table):
        return table
    table = table[np.argsort(table[:, 0], kind="stable")]
    ends = np.maximum.accumulate(table[:, 1])
    new = np.r_[True, table[1:, 0] > ends[:-1]]
    return np.stack([table[new, 0], ends[np.r_[new[1:], True]]], axis=1)


_DOCUMENT = ("row", "did", "tie", "t")


def _documents_of(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int, int]:
    """(row, did, tie, t, key), shares of the documents, and buckets: documents dealt out by a number of their own.

    (did, tie, row) is their order.

    The numbered documents are written first, so that no repeated task numbers them in another way.
    """
    spark = docs.sparkSession
    t = whole_text(text).cast("binary")
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(key), F.lit(_FIRST_ID)).cast("long").alias("did"),
        F.xxhash64(t).alias("tie"),
        t.alias("t"),
        F.col(key).alias("key"),
        F.octet_length(t).cast("long").alias("size"),
    )
    path = f"{scratch_dir(spark)}/documents"
    numbered.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(numbered.schema).parquet(path).withColumnRenamed("key", key)
    # A number is never null; a join that knows it needs no filter, so all uses of the documents have one plan.
    row = F.coalesce("row", F.lit(0).cast("long")).alias("row")
    return back.select(row, *_DOCUMENT[1:], key).repartition("row"), *_shares(back)


def _marked(base: DataFrame, owners: int, buckets: int) -> DataFrame:
    """(row, marks): for documents with anchors that occur again, their places."""
    return (
        base.mapInArrow(_send_anchors(buckets, owners), _PART_DDL)
        .groupBy("bucket")
        .applyInPandas(_find_again(owners), _RESULT_DDL)
        .groupBy("owner")
        .applyInPandas(_by_document(3, marks=True), "row long, data binary")
        .withColumnRenamed("data", "marks")
    )


def _shares(base: DataFrame) -> tuple[int, int]:
    """Shares of the documents and buckets of anchors, by the bytes of the texts; at least one of each for a shuffle partition."""
    least = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = base.agg(F.sum("size")).first()[0] or 0
    return max(least, -(-size // SHARE_BYTES)), max(least, -(-size // BUCKET_BYTES))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents (row, did, tie, t, key) and, for those with repeats, (row, spans): data for `merged_spans`.

    Every use of the documents has the same columns, so that Spark reuses their exchange.
    """
    base, owners, buckets = _documents_of(docs, key, text)
    spans = (
        base.join(_marked(base, owners, buckets), "row")
        .select(*_DOCUMENT, "marks", key)
        .mapInArrow(_send_contexts(buckets, owners), _PART_DDL)
        .groupBy("bucket")
        .applyInPandas(_find_repeats(owners), _RESULT_DDL)
        .groupBy("owner")
        .applyInPandas(_by_document(3), "row long, data binary")
        .withColumnRenamed("data", "spans")
    )
    return base, spans


def repeat_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(repeat, length, key, start): all occurrences of the maximal repeats of ``LENGTH`` bytes or more.

    ``repeat`` is a digest of the bytes. A repeat longer than its anchors'
    windows is listed once per anchor, each group reaching as far as these
    windows do. There is one row per occurrence and group.
    """
    base, owners, buckets = _documents_of(docs, key, text)
    marked = base.join(_marked(base, owners, buckets), "row").select(*_DOCUMENT, "marks", key)
    groups = (
        marked.mapInArrow(_send_contexts(buckets, owners, split=False), _PART_DDL)
        .groupBy("bucket")
        .applyInPandas(_find_groups, _GROUPS)
    )
    occurrences = marked.mapInArrow(_list_occurrences, _OCCURRENCES)
    found = occurrences.join(groups, "context").select(
        "repeat", "length", "row", (F.col("place") - F.col("left")).alias("start")
    )
    often = found.distinct()
    counts = often.groupBy("repeat").agg(F.count("*").alias("n")).filter("n > 1").select("repeat")
    names = base.select("row", key)
    return often.join(counts, "repeat").join(names, "row").select("repeat", "length", key, "start")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", kept_text: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept_sha256) for every row; spans are (start, end) in bytes.

    With ``kept_text`` also ``kept``, the bytes that are left.
    """
    id_type = dict(docs.dtypes)[key]
    base, spans = repeated_spans(docs, key, text)
    joined = base.join(spans, "row", "left").select(*_DOCUMENT, "spans", key)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for _, _, _, texts, found in _documents(batch):
                for t, data in zip(texts, found):
                    cuts = merged_spans(data).tolist()
                    left = b"".join(t[a:b] for a, b in zip([0, *(z for _, z in cuts)], [*(a for a, _ in cuts), len(t)]))
                    values = (
                        len(t),
                        len(t) - len(left),
                        [{"start": a, "end": z} for a, z in cuts],
                        hashlib.sha256(left).hexdigest(),
                        left,
                    )
                    for column, value in zip(columns, values):
                        column.append(value)
            arrays = [
                batch.column(5),
                *(pa.array(c, type=k) for c, k in zip(columns, (pa.int64(), pa.int64(), kind, pa.string(), pa.binary()))),
            ]
            names = [key, "n_bytes", "n_removed", "spans", "kept_sha256", "kept"]
            n = len(names) if kept_text else len(names) - 1
            yield pa.RecordBatch.from_arrays(arrays[:n], names=names[:n])

    schema = (
        f"{key} {id_type}, n_bytes long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    )
    return joined.mapInArrow(run, schema + (", kept binary" if kept_text else ""))

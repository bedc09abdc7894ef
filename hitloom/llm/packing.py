"""Packing texts and instruction examples into training sequences.

Vector bin packing: a sequence has three limits at once, tokens, segments and
loss-bearing tokens. It is filled item by item with the one that fits and has
the largest dot product of its demands with what is left of the limits (each as
a share of its limit), so items are preferred that use what the sequence still
has most of. Candidates are a window of items of the same task, so memory is
bounded and tasks are independent: no shuffle, and a task that runs again on
the same rows packs them the same way. Sequence ids carry the task's number.

Documents may be cut. Whole sequences are cut off long ones first; the rests are
packed, and where no rest fits the one with the largest product is cut to fit.
What is left at a task's end, or when the segment limit closes a sequence, is
cut to powers of two, which need no padding. Examples (with a prompt that bears
no loss) are never cut.

Token ids are the tokenizer's; `Encoder` says how ordinary text gets them faster.

Defined cases: null or empty text is the end token alone; repeated rows and null
ids are packed as rows of their own; an example above a limit has a sequence to
itself; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import whole_text

#: Items that compete for a place.
WINDOW = 1024

#: Texts with other characters than these are left to the tokenizer: libraries may differ in what they call a letter.
_LATIN = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-\\u024f]")

#: The fast library gives up on white space of about a million characters in a row; so long a run goes to the tokenizer.
_LONG_GAP = re.compile(r"(?<!\s)\s{10000}")

# Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PRE_TOKENS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

END = b"\0\0\0\0"


def _ranks(definition: dict) -> dict[bytes, int] | None:
    """Ids by the bytes they stand for, if this is plain byte-level BPE whose ids are in the order of its merges."""
    model, cut = definition["model"], definition["pre_tokenizer"]
    plain = cut and cut["type"] == "ByteLevel" and not cut["add_prefix_space"] and cut.get("use_regex", True)
    if definition["normalizer"] or model["type"] != "BPE" or not plain:
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocabulary = model["vocab"]
    if any(vocabulary[a + b] != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    # Vocabularies write printable bytes as they are and the others, in order, as characters from 256 on.
    own = [b for b in range(256) if chr(b).isprintable() and b not in (32, 173)]
    others = [b for b in range(256) if b not in own]
    byte_of = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}
    wanted = vocabulary.keys() - {t["content"] for t in definition["added_tokens"]}
    return {bytes(byte_of[c] for c in token): vocabulary[token] for token in wanted}


class Encoder:
    """Texts to token ids, as bytes of little-endian unsigned 32-bit numbers.

    The vocabulary file defines the ids. Where it is plain byte-level BPE, a
    faster library with the same ranks encodes all Latin text without very long gaps.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            definition = json.load(f)
        self.path, self.tokenizer = path, None
        self.special = [t["content"] for t in definition["added_tokens"]]
        ranks = _ranks(definition)
        self.fast = ranks and tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> bytes:
        plain = not _LATIN.search(text) and not _LONG_GAP.search(text)
        if self.fast and plain and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


class Packer:
    """Fills sequences from a window of items ``(payload, tokens, loss)``.

    ``add`` and ``flush`` yield finished sequences, lists of (payload, start,
    length), start being relative to the payload. With ``cut``, every token of
    an item must bear loss, and items must not be longer than a sequence.
    """

    def __init__(self, limits: Limits, cut: bool, window: int = WINDOW):
        self.limits, self.cut, self.window = limits, cut, window
        self.payloads: list = [None] * window
        self.starts = np.zeros(window, dtype=np.int64)
        self.tokens = np.zeros(window, dtype=np.int64)  # 0: a free place
        self.loss = np.zeros(window, dtype=np.int64)
        self.free = list(range(window))

    def _put(self, payload, start: int, tokens: int, loss: int) -> None:
        k = self.free.pop()
        self.payloads[k], self.starts[k], self.tokens[k], self.loss[k] = payload, start, tokens, loss

    def add(self, payload, tokens: int, loss: int, start: int = 0) -> Iterator[list]:
        while len(self.free) < 2:  # one place stays free for the rest of a cut item
            yield from self._sequence(False)
        self._put(payload, start, tokens, loss)

    def flush(self) -> Iterator[list]:
        while len(self.free) < self.window:
            yield from self._sequence(True)

    def _take(self, k: int, length: int) -> tuple:
        """Remove ``length`` tokens of item ``k``."""
        got = (self.payloads[k], int(self.starts[k]), length)
        if length < self.tokens[k]:
            self.starts[k] += length
            self.tokens[k] -= length
            self.loss[k] -= length
        else:
            self.payloads[k], self.tokens[k], self.loss[k] = None, 0, 0
            self.free.append(k)
        return got

    def _sequence(self, last: bool) -> Iterator[list]:
        lim = self.limits
        left = np.array([lim.tokens, lim.segments, lim.loss], dtype=np.int64)
        made: list[tuple] = []
        whole = min(lim.tokens, lim.loss) if self.cut else lim.tokens
        while left[0] and left[1] and len(self.free) < self.window:
            there = self.tokens > 0
            fits = there & (self.tokens <= left[0]) & (self.loss <= left[2])
            value = (
                left[0] / lim.tokens**2 * self.tokens + left[1] / lim.segments**2 + left[2] / lim.loss**2 * self.loss
            )
            k = int(np.argmax(np.where(fits, value, -1.0)))
            room = int(min(left[0], left[2]))
            if self.cut and room and (not fits[k] or (left[1] == 1 and self.tokens[k] < room)):
                over = there & (self.tokens >= room)  # the last segment fills the sequence, if any item can
                if over.any():
                    k = int(np.argmax(np.where(over, value, -1.0)))
                    made.append(self._take(k, room))
                    left -= (room, 1, room)
                    continue
            if not fits[k]:
                if not made and not self.cut:
                    k = int(np.argmax(there))  # above a limit: alone
                    made.append(self._take(k, int(self.tokens[k])))
                break
            n, loss = int(self.tokens[k]), int(self.loss[k])
            made.append(self._take(k, n))
            left -= (n, 1, loss)
        yield from self._close(made, whole, last) if self.cut else [made]

    def _close(self, made: list[tuple], whole: int, last: bool) -> Iterator[list]:
        """Yield a full sequence, or one of a power of two of tokens; the rest goes back or, at the end, is cut on."""
        while made:
            total = sum(n for _, _, n in made)
            size = total if total == whole else 1 << (total.bit_length() - 1)
            now, rest, room = [], [], size
            for payload, start, n in made:
                here = min(n, room)
                if here:
                    now.append((payload, start, here))
                    room -= here
                if n > here:
                    rest.append((payload, start + here, n - here))
            yield now
            made = rest
            if rest and not (last and len(self.free) == self.window) and len(self.free) >= len(rest):
                for payload, start, n in rest:
                    self._put(payload, start, n, n)
                return


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, segment int"


def _first_sequence() -> int:
    return TaskContext.get().partitionId() << 40


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limits: Limits = Limits(), ids: bool = False
) -> DataFrame:
    """Per piece: its document, where it lies there and in its sequence; with ``ids`` also its token ids.

    ``tokenizer`` is the path of a byte-level BPE vocabulary that all executors
    have. Each document ends in id 0. Each id is in exactly one piece.
    """
    id_type = dict(docs.dtypes)[key]
    whole = min(limits.tokens, limits.loss)
    schema = f"{key} {id_type}, {PIECES}" + (", ids array<long>" if ids else "")

    def run(batches):
        encoder, packer, at = Encoder(tokenizer), Packer(limits, cut=True), _first_sequence()
        rows: list[tuple] = []

        def place(sequence: list) -> None:
            nonlocal at
            offset = 0
            for segment, ((name, base, data, total), start, n) in enumerate(sequence):
                part = data[4 * start : 4 * (start + n)]
                row = (name, base + start, n, zlib.crc32(part), total, at, offset, segment)
                rows.append((*row, np.frombuffer(part, "<u4").tolist()) if ids else row)
                offset += n
            at += 1

        kinds = None
        for batch in batches:
            kinds = kinds or pa.schema(
                [(key, batch.schema.field(0).type)]
                + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
                + [("segment", pa.int32())]
                + ([("ids", pa.list_(pa.int64()))] if ids else [])
            )
            names = batch.column(0).to_pylist()
            texts = batch.column(1)
            for low in range(0, len(names), 256):
                for name, data in zip(names[low : low + 256], encoder.encode(texts.slice(low, 256).to_pylist())):
                    data += END
                    total = len(data) // 4
                    full = total - total % whole
                    for start in range(0, full, whole):
                        place([((name, 0, data, total), start, whole)])
                    if full < total:
                        rest = (name, full, data[4 * full :], total)
                        for sequence in packer.add(rest, total - full, total - full):
                            place(sequence)
                if len(rows) >= 10_000:
                    yield _batch(rows, kinds)
                    rows.clear()
        for sequence in packer.flush():
            place(sequence)
        if rows:
            yield _batch(rows, kinds)

    return docs.select(F.col(key), whole_text(text).alias("text")).mapInArrow(run, schema)


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(zip(*rows), kinds.types)], names=kinds.names
    )


def pack_examples(
    examples: DataFrame, key: str, tokens: str = "n_tokens", loss: str = "n_loss", limits: Limits = Limits()
) -> DataFrame:
    """(key, sequence_id, offset) for examples whose token counts are known; none is cut."""
    id_type = dict(examples.dtypes)[key]

    def run(batches):
        packer, at, kinds = Packer(limits, cut=False), _first_sequence(), None
        rows: list[tuple] = []

        def place(sequence: list) -> None:
            nonlocal at
            offset = 0
            for name, _, n in sequence:
                rows.append((name[0], at, offset))
                offset += n
            at += 1

        for batch in batches:
            kinds = kinds or pa.schema([(key, batch.schema.field(0).type), ("sequence_id", pa.int64()), ("offset", pa.int64())])
            for name, n, m in zip(*(c.to_pylist() for c in batch.columns)):
                if not n:
                    place([((name,), 0, 0)])
                    continue
                for sequence in packer.add((name,), n, m):
                    place(sequence)
            if rows:
                yield _batch(rows, kinds)
                rows.clear()
        for sequence in packer.flush():
            place(sequence)
        if rows:
            yield _batch(rows, kinds)

    counted = examples.select(key, *(F.coalesce(c, F.lit(0)).cast("long").alias(f"_{k}") for k, c in enumerate((tokens, loss))))
    return counted.mapInArrow(run, f"{key} {id_type}, sequence_id long, offset long")

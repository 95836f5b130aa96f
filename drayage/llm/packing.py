"""Packing of tokenized documents into sequences of one length, by minimum bin slack.

Documents are cut into full sequences; what remains of each, a piece shorter than a sequence, is packed with others. Each
task packs the pieces of its own rows in windows of bounded size: nothing is shuffled and no piece waits for another
task. At most half a window waits for the next; if more doesn't fit, as with many copies of one length, it is cut. For each sequence the longest remaining piece is taken, and a subset-sum search over the remaining lengths, in
which a set of sums is one long integer, fills the rest as closely as possible. The sums are kept step by step, so that
the counts of each length are found by going back. A choice is used again as often as its lengths last.
"""

import base64
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, table, utf8

SEQUENCE, END_ID, WINDOW = 2048, 1, 4096
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
# White space and letters of these ranges are the same in both libraries' patterns, whatever their Unicode version.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")


class Tokens:
    """Ids of the vocabulary file of ``tokenizers``.

    ``ranks`` names the same vocabulary for ``tiktoken``, which is several times faster. It serves texts of usual
    characters; texts with others, or with the string of a special token, go through ``tokenizers``.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        from tokenizers import Tokenizer
        self.exact = Tokenizer.from_file(vocabulary)
        self.special = "<|"
        self.fast = None
        if ranks:
            import tiktoken
            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: bytes) -> np.ndarray:
        text = text.decode("utf-8", "replace")
        if self.fast is None or self.special in text or _UNUSUAL.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text).astype(np.uint32, copy=False)


def fill(counts: dict, capacity: int) -> dict:
    """How many of each length give the largest sum up to ``capacity``: a bitset of sums, then back step by step."""
    reach, steps, target = 1, [], 1 << capacity
    below = (target << 1) - 1
    for length in sorted(counts, reverse=True):
        if length > capacity:
            continue
        left, times = min(counts[length], capacity // length), 1
        while left:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << length * times) & below
            left -= times
            times *= 2
            if reach & target:
                left = 0
        if reach & target:
            break
    total, used = reach.bit_length() - 1, defaultdict(int)
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            used[length] += times
            total -= length * times
    return used


def bins(counts: dict, size: int):
    """Yields (multiset of lengths, times) until ``counts`` is used up."""
    counts = {k: v for k, v in counts.items() if v}
    while counts:
        longest = max(counts)
        chosen = defaultdict(int)
        chosen[longest] = 1
        counts[longest] -= 1
        for length, n in fill(counts, size - longest).items():
            chosen[length] += n
            counts[length] -= n
        counts[longest] += chosen[longest]
        for length in chosen:
            counts[length] += chosen[length] if length != longest else 0
        times = max(1, min(counts[length] // n for length, n in chosen.items()))
        for length, n in chosen.items():
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        yield dict(chosen), times


class _Packer:
    def __init__(self, number: int, size: int):
        self.next, self.size, self.pieces = number << 33, size, []

    def row(self, doc_id, start, ids, doc_tokens, sequence, offset):
        return doc_id, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False).tobytes()), doc_tokens, sequence, offset

    def sequence(self):
        self.next += 1
        return self.next - 1

    def add(self, doc_id, ids):
        full = len(ids) - len(ids) % self.size
        for start in range(0, full, self.size):
            yield self.row(doc_id, start, ids[start:start + self.size], len(ids), self.sequence(), 0)
        if full < len(ids):
            self.pieces.append((doc_id, full, ids[full:].copy(), len(ids)))

    def pack(self, last: bool, most: int = 0):
        """Packs all pieces; full sequences go out. The others wait for more pieces if they are ``most`` or fewer, else
        they are cut to full sequences and less than one sequence waits. In the end that is cut to lengths that need no
        padding: powers of two."""
        by_length = defaultdict(list)
        for piece in self.pieces:
            by_length[len(piece[2])].append(piece)
        self.pieces = []
        for chosen, times in bins({k: len(v) for k, v in by_length.items()}, self.size):
            full = sum(k * n for k, n in chosen.items()) == self.size
            for _ in range(times):
                members = [by_length[k].pop() for k, n in chosen.items() for _ in range(n)]
                if full:
                    yield from self.place(members)
                else:
                    self.pieces += members
        if last or len(self.pieces) > most:
            members, self.pieces = self.pieces, []
            yield from self.place_cut(members, last)

    def place(self, members):
        sequence, offset = self.sequence(), 0
        for doc_id, start, ids, doc_tokens in members:
            yield self.row(doc_id, start, ids, doc_tokens, sequence, offset)
            offset += len(ids)

    def place_cut(self, members, last: bool):
        """Pieces one after the other, cut where a sequence is full."""
        left = sum(len(m[2]) for m in members)
        room, sequence, offset = 0, None, 0
        for doc_id, start, ids, doc_tokens in members:
            at = 0
            while at < len(ids):
                if not room:
                    if left < self.size and not last:
                        self.pieces.append((doc_id, start + at, ids[at:].copy(), doc_tokens))
                        break
                    room, sequence, offset = min(self.size, 1 << (left.bit_length() - 1)), self.sequence(), 0
                    left -= room
                n = min(room, len(ids) - at)
                yield self.row(doc_id, start + at, ids[at:at + n], doc_tokens, sequence, offset)
                at, offset, room = at + n, offset + n, room - n


def pack(docs: DataFrame, vocabulary: str, ranks: str = None, pattern: str = None, size: int = SEQUENCE,
         end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece: where it starts in its document and in its sequence.

    ``vocabulary`` and ``ranks`` are paths that all executors have, or names that are looked up there by a function of no
    arguments. Each row of ``docs`` is packed, repeated ones as often as they occur and a null doc_id under null; a null
    or empty text is its end id only. Each id lies in one piece. Sequences are full, but for the last ones of a task,
    whose lengths are powers of two: nothing is padded. ``sequence_id`` is unique, and the same when a task runs again.
    """
    def read(batches):
        tokens = Tokens(*(x() if callable(x) else x for x in (vocabulary, ranks, pattern)))
        packer = _Packer(TaskContext.get().partitionId(), size)
        for batch in batches:
            ids_of, out = {}, []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = ids_of.get(text)
                if ids is None:
                    ids = ids_of[text] = np.append(tokens(text), np.uint32(end_id))
                out += packer.add(doc_id, ids)
                if len(packer.pieces) >= window:
                    out += packer.pack(last=False, most=window // 2)
                if len(out) >= 10_000:
                    yield _rows(out)
                    out = []
            yield _rows(out)
        yield _rows(list(packer.pack(last=True)))
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), utf8("text").alias("t")).mapInArrow(read, SCHEMA)


def _rows(rows):
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)


def public_vocabulary():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def public_ranks():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def public_pattern():
    import public_tokenizers
    return public_tokenizers.PATTERN


def op5_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_vocabulary, public_ranks, public_pattern)

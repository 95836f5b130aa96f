"""Removal of long repeated byte strings by prefix doubling on ranks, without a row for every byte.

Ranks are 64-bit names of byte strings. Names of 2, 4, ... 64 bytes come from pairs of names at growing offsets, inside
the document; Spark sorts the (rank, context rank, position) rows of all documents and reranks them, and what is unique
leaves. Only sampled positions take part: of each window of ``LENGTH`` bytes the start of the least-ranked ``CORE``
bytes, so equal windows sample the same place. Three rounds follow, each over what the one before left open:

1. A sampled place stands for the ``SPAN`` windows around it. Its core (the bytes in all of them) is its rank, the union
   of them its context. A core that occurs once settles all its windows: they are unique. A context that occurs earlier
   settles them too: all repeat. Open are first contexts whose core has other contexts.
2. The same for parts of ``PART`` windows.
3. Single windows of ``LENGTH`` bytes, whose rank decides.

Before a shuffle each batch of documents is reduced by itself: a context that occurs earlier in the batch needs no other
place, and of a core with several contexts two rows go on. So rows of one rank grow with the number of batches and not
with the number of copies, and a sorted scan needs to keep one row.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..materialize import snapshot
from .common import LOWEST_ID, gathered, small_batches, table, utf8

LENGTH, CORE = 100, 32
SPAN = LENGTH - CORE + 1            # windows that a sampled place stands for
PART = 14                           # windows of a part
PIECE = 1 << 20                     # bytes ranked at once
ROOM = 256                          # added to positions, so that windows before a text have one

_GOLD, _M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                                              0xD6E8FEB86659FD93))
_PLACE = np.uint64((1 << 23) - 1)   # low bits of an order key: the place in the piece
ROWS = "kind int, core bigint, context bigint, doc_id bigint, place bigint, done boolean"
_ARROW = pa.schema([("kind", pa.int32()), ("core", pa.int64()), ("context", pa.int64()), ("doc_id", pa.int64()),
                    ("place", pa.int64()), ("done", pa.bool_())])
RANK, REPEAT, OPEN = 0, 1, 2


def _pair(a, b):
    """Name of a pair of names."""
    x = a * _M1
    x ^= b * _M3
    x ^= x >> np.uint64(31)
    x *= _M2
    x ^= x >> np.uint64(32)
    return x


def _alphabet():
    x = np.arange(1, 258, dtype=np.uint64) * _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    return (x ^ (x >> np.uint64(27))) * _M2


_BYTES = _alphabet()
_EDGE = _BYTES[256]     # stands before and after a text


class _Names:
    """Names of the strings in pieces of texts; a piece is (document, first window, end of windows)."""

    def __init__(self, texts, pieces, before, after):
        parts, self.doc, self.shift, self.offset, self.valid = [], [], [], [], []
        edge, at, edges = bytes(ROOM), 0, []
        for doc, begin, end in pieces:
            text = texts[doc]
            low, high = max(0, begin - before), min(len(text), end + after)
            parts += [edge, text[low:high]]
            edges.append((at, at + ROOM))
            at += ROOM
            self.doc.append(doc)
            self.offset.append(at)
            self.shift.append(low)
            self.valid.append((at + begin - low, at + max(begin, min(end, len(text) - LENGTH + 1)) - low, at + high - low))
            at += high - low
        parts.append(edge)
        edges.append((at, at + ROOM))
        v = _BYTES[np.frombuffer(b"".join(parts), np.uint8)]
        for a, b in edges:
            v[a:b] = _EDGE
        self.core = None
        for size in (1, 2, 4, 8, 16, 32):
            if size == CORE:
                self.core = v
            v = _pair(v[:-size], v[size:])
        self.n64 = v

    def of(self, at, length):
        """Names of strings of 64 to 128 bytes: a pair of overlapping names of 64."""
        return _pair(self.n64[at], self.n64[at + (length - 64)])

    def located(self, at):
        """(document, position) of places in the pieces."""
        piece = np.searchsorted(self.offset, at + (ROOM - 1), side="right") - 1
        piece = np.clip(piece, 0, len(self.doc) - 1)
        return np.array(self.doc, np.int64)[piece], at - np.array(self.offset)[piece] + np.array(self.shift)[piece]


def _packed(pieces, before, after):
    """Cuts long pieces and puts short ones together, to at most about PIECE bytes each."""
    group, size = [], 0
    for doc, begin, end in pieces:
        for a in range(begin, end, PIECE):
            b = min(end, a + PIECE)
            if group and size + b - a > PIECE:
                yield group
                group, size = [], 0
            group.append((doc, a, b))
            size += b - a + before + after + ROOM
    if group:
        yield group


def _sampled(texts):
    """(core, context, document, first window) of the sampled places of all texts."""
    pieces = [(i, 0, len(t) - LENGTH + 1) for i, t in enumerate(texts) if len(t) >= LENGTH]
    for group in _packed(pieces, SPAN, SPAN + LENGTH):
        names = _Names(texts, group, SPAN, SPAN + LENGTH)
        core = names.core
        key = (core & ~_PLACE) | np.arange(len(core), dtype=np.uint64)
        for _, _, end in names.valid:
            key[end - CORE + 1:end] = ~np.uint64(0)
        least, width = key, 1
        while width < SPAN:
            step = min(width, SPAN - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        open_ = np.zeros(len(least), bool)
        for a, b, _ in names.valid:
            open_[a:b] = True
        at = (least[open_] & _PLACE).astype(np.int64)
        at = at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
        context = _pair(_pair(names.n64[at - SPAN + 1], names.n64[at - 64]), names.of(at, LENGTH))
        doc, position = names.located(at)
        yield core[at], context, doc, position - (SPAN - 1)


def _parts(texts, wanted):
    """The same for the parts of PART windows of wanted (document, first window) spans."""
    spans = [(doc, first, first + SPAN) for doc, first in wanted]
    for names, at in _windows(texts, spans, range(0, SPAN, PART)):
        doc, first = names.located(at)
        yield names.of(at + (PART - 1), LENGTH - PART + 1), names.of(at, LENGTH + PART - 1), doc, first


def _singles(texts, wanted):
    """The same for single windows of wanted parts; the context is a second name of the window."""
    merged = []
    for doc, first in wanted:
        begin, end = max(0, first), min(first + PART, len(texts[doc]) - LENGTH + 1)
        if merged and merged[-1][0] == doc and begin <= merged[-1][2]:
            merged[-1][2] = max(end, merged[-1][2])
        elif begin < end:
            merged.append([doc, begin, end])
    for group in _packed(merged, 0, LENGTH):
        names = _Names(texts, group, 0, LENGTH)
        at = np.concatenate([np.arange(a, b) for a, b, _ in names.valid])
        doc, first = names.located(at)
        other = _pair(_pair(names.n64[at + (LENGTH - 64)], names.n64[at + 20]), names.n64[at] ^ _GOLD)
        yield names.of(at, LENGTH), other, doc, first


def _windows(texts, spans, starts):
    starts = np.array(list(starts))
    for i in range(0, len(spans), 2048):
        group = [(doc, max(0, begin), end) for doc, begin, end in spans[i:i + 2048]]
        names = _Names(texts, group, SPAN + PART, LENGTH + 2 * PART)
        at = np.concatenate([o - s + begin + starts for o, s, (_, begin, _) in
                             zip(names.offset, names.shift, spans[i:i + 2048])])
        doc = np.repeat([g[0] for g in group], len(starts))
        first = np.repeat([s[1] for s in spans[i:i + 2048]], len(starts)) + np.tile(starts, len(group))
        sizes = np.array([len(t) for t in texts])[doc]
        keep = (first + PART > 0) & (first + LENGTH <= sizes)
        yield _Placed(names, doc[keep], first[keep]), at[keep]


class _Placed:
    """Names with places that are known already: spans of a document may overlap."""

    def __init__(self, names, doc, first):
        self.of, self.located = names.of, lambda at: (doc, first)


def _reduced(found, ids, hashes, order, width):
    """Rows of a batch that has ranked all of its places; settles what it can."""
    columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found)] or [np.zeros(0, np.int64)] * 4
    core, context, doc, first = columns
    if not len(core):
        return
    doc, first = doc.astype(np.int64), first.astype(np.int64)
    place = np.lexsort((first, order[doc]))
    core, context, doc, first = (x[place] for x in (core.view(np.int64), context.view(np.int64), doc, first))
    fresh = np.concatenate(([True], (doc[1:] != doc[:-1]) | (first[1:] != first[:-1])))
    core, context, doc, first = (x[fresh] for x in (core, context, doc, first))
    rows = np.lexsort((context, core))
    core, context, doc, first = (x[rows] for x in (core, context, doc, first))
    new_core = np.concatenate(([True], core[1:] != core[:-1]))
    lead = new_core | np.concatenate(([True], context[1:] != context[:-1]))
    # repeats: the windows as byte ranges, joined per document
    again = ~lead
    # the same (id, hash) twice is one document
    heads = np.flatnonzero(lead)[np.cumsum(lead) - 1]
    again &= (ids[doc] != ids[doc[heads]]) | (hashes[doc] != hashes[doc[heads]]) | (first != first[heads])
    yield _ranges(ids[doc[again]], hashes[doc[again]], first[again], width)
    core, context, doc, first, new_core = (x[lead] for x in (core, context, doc, first, new_core))
    number = np.cumsum(new_core) - 1
    counts = np.bincount(number)
    several = counts[number] > 1
    rank = np.arange(len(core)) - np.flatnonzero(new_core)[number]
    place = (hashes[doc] << 32) | (first + ROOM)
    if width > 1:
        yield _batch(OPEN, place[several], 0, ids[doc[several]], place[several], True)
    keep = (rank < 2) if width > 1 else np.ones(len(core), bool)
    yield _batch(RANK, core[keep], context[keep], ids[doc[keep]], place[keep], several[keep])


def _ranges(ids, hashes, first, width):
    """Byte ranges of repeated windows, those of a document joined."""
    order = np.lexsort((first, hashes, ids))
    ids, hashes, first = ids[order], hashes[order], first[order]
    begin, end = np.maximum(first, 0), first + (width - 1 + LENGTH)
    if len(begin):
        other = np.concatenate(([True], (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1]) | (begin[1:] > end[:-1])))
        heads = np.flatnonzero(other)
        begin, end, ids, hashes = begin[heads], np.append(end[heads[1:] - 1], end[-1]), ids[heads], hashes[heads]
    return _batch(REPEAT, _pair(ids.view(np.uint64), begin.view(np.uint64)).view(np.int64), (begin << 32) | end, ids,
                  hashes << 32, True)


def _batch(kind, core, context, ids, place, done):
    n = len(ids)
    full = lambda x, t: np.full(n, x, t) if np.isscalar(x) else x
    return pa.RecordBatch.from_arrays([pa.array(full(kind, np.int32)), pa.array(core), pa.array(full(context, np.int64)),
                                       pa.array(ids), pa.array(place), pa.array(full(done, bool))], schema=_ARROW)


def _batch_reader(rank, width):
    """Reads batches of (doc_id, h, text[, places]) and writes rows."""
    def read(batches):
        for batch in gathered(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            hashes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = batch.column(2).to_pylist()
            order = np.empty(len(ids), np.int64)
            order[np.lexsort((hashes, ids))] = np.arange(len(ids))
            if batch.num_columns > 3:
                wanted = [(i, p - ROOM) for i, places in enumerate(batch.column(3).to_pylist()) for p in sorted(places)]
                found = list(rank(texts, wanted))
            else:
                found = list(rank(texts))
            yield from _reduced(found, ids, hashes, order, width)
    return read


def _scanner(width):
    """Reads rows sorted by (kind, core, context, doc_id, place): what is settled becomes ranges, what isn't stays open.

    Keeps the first row of the current context and whether its core has another one; a first context waits until the
    next core or context tells.
    """
    def settle(core, context, ids, place, done):
        new_core = np.concatenate(([True], core[1:] != core[:-1]))
        lead = new_core | np.concatenate(([True], context[1:] != context[:-1]))
        heads = np.flatnonzero(lead)[np.cumsum(lead) - 1]
        again = ~lead & ((ids != ids[heads]) | (place != place[heads]))
        first = (place & 0xFFFFFFFF) - ROOM
        yield _ranges(ids[again], place[again] >> 32, first[again], width)
        if width > 1:
            number = np.cumsum(new_core) - 1
            contexts = np.bincount(number, weights=lead)
            open_ = lead & (contexts[number] > 1) & ~done
            yield _batch(OPEN, place[open_], 0, ids[open_], place[open_], True)

    def read(batches):
        carried = None
        for batch in batches:
            kind = batch.column(0).to_numpy()
            if (kind != RANK).any():
                yield batch.filter(pa.array(kind != RANK))
                batch = batch.filter(pa.array(kind == RANK))
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 6)]
            if carried is not None:
                rows = [np.concatenate(x) for x in zip(carried, rows)]
            # the last core goes on in the next batch: of its contexts, the first rows are enough
            tail = np.flatnonzero(rows[0] != rows[0][-1])
            cut = tail[-1] + 1 if len(tail) else 0
            if cut:
                yield from settle(*[x[:cut] for x in rows])
            carried = [x[cut:] for x in rows]
            if len(carried[0]) > 200_000:   # a core with very many contexts: all but the last context can be settled
                core, context, ids, place, done = carried
                cut = np.flatnonzero(context != context[-1])
                if len(cut):
                    cut = cut[-1] + 1
                    # it has several contexts, so the two heads kept make the rest count as one of several
                    yield from settle(*[x[:cut + 1] for x in carried])
                    done = done.copy()
                    done[cut] = True
                    mark = [x[[0]] for x in (core, context, ids, place)] + [np.array([True])]
                    carried = [np.concatenate((m, x[cut:])) for m, x in zip(mark, (core, context, ids, place, done))]
                else:                       # one context: the head is enough, the rest repeats it
                    yield from settle(*carried)
                    carried = [x[[0]] for x in carried]
        if carried is not None and len(carried[0]):
            yield from settle(*carried)
    return read


def _round(ranked: DataFrame, width: int, label: str) -> DataFrame:
    spread = ranked.repartition("core").sortWithinPartitions("kind", "core", "context", "doc_id", "place")
    return snapshot(spread.mapInArrow(_scanner(width), ROWS).select("kind", "context", "doc_id", "place"), label)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST_ID)).alias("k"), utf8("text").alias("t")
                       ).select("k", F.hash("t").cast("bigint").alias("h"), "t")


def _again(docs: DataFrame, settled: DataFrame, rank, width: int) -> DataFrame:
    """Ranks the open places of a round anew, in the texts that have any."""
    open_ = settled.where(F.col("kind") == OPEN).groupBy(F.col("doc_id").alias("k"), F.shiftright("place", 32).alias("h")
                                                         ).agg(F.collect_set(F.col("place").bitwiseAND(0xFFFFFFFF)).alias("places"))
    return _keyed(docs).join(open_, ["k", "h"]).select("k", "h", "t", "places").mapInArrow(
        _batch_reader(rank, width), ROWS)


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """``(k, h, spans)``: the byte ranges [begin, end) of each text that an earlier string of LENGTH bytes covers.

    k is the doc_id (the lowest long for null), h a hash of the text. Earlier is a smaller (doc_id, h), then a smaller
    start. Ranges of a text may overlap and are clipped by the reader.
    """
    small_batches(docs.sparkSession)
    first = _round(_keyed(docs).mapInArrow(_batch_reader(_sampled, SPAN), ROWS), SPAN, "sampled-ranks")
    second = _round(_again(docs, first, _parts, PART), PART, "part-ranks")
    third = _round(_again(docs, second, _singles, 1), 1, "window-ranks")
    ranges = first.unionByName(second).unionByName(third).where(F.col("kind") == REPEAT)
    return ranges.groupBy(F.col("doc_id").alias("k"), F.shiftright("place", 32).alias("h")).agg(
        F.collect_list("context").alias("spans"))


def _cut(text: bytes, spans):
    """(kept bytes, removed bytes, removed runs)"""
    if not spans:
        return text, 0, 0
    spans = np.sort(np.array(spans, np.int64))
    begin, end = spans >> 32, np.minimum(spans & 0xFFFFFFFF, len(text))
    reach = np.maximum.accumulate(end)
    heads = np.flatnonzero(np.concatenate(([True], begin[1:] > reach[:-1])))
    begin, end = begin[heads].tolist(), np.append(reach[heads[1:] - 1], reach[-1]).tolist()
    kept = b"".join(text[a:b] for a, b in zip([0, *end], [*begin, len(text)]))
    return kept, len(text) - len(kept), len(begin)


def remove_repeats(docs: DataFrame, name: str = "repeats") -> DataFrame:
    """All columns of ``docs(doc_id, text, ...)`` and a struct ``repeats(kept binary, n_bytes, n_removed, n_spans)``, under
    another ``name`` if ``docs`` has such a column.

    Each byte goes that a string of LENGTH bytes covers which also starts earlier: in a document with a smaller doc_id,
    or earlier in the same one. Strings are judged on the input. Null texts are empty. Null ids come first. Rows that
    share a doc_id are ordered by a hash of their text; rows equal in both are one document and get the same result.
    Texts shorter than LENGTH bytes are kept as they are. An empty table gives no rows.
    """
    ranges = repeated_ranges(docs.select("doc_id", "text"))
    kind = "struct<kept:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint>"

    @F.arrow_udf(kind)
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        rows = [(len(t), *_cut(t, s)) for t, s in zip(text.to_pylist(), spans.to_pylist())]
        return pa.StructArray.from_arrays(
            [pa.array([r[1] for r in rows], pa.binary()), *[pa.array([r[i] for r in rows], pa.int64()) for i in (0, 2, 3)]],
            names=["kept", "n_bytes", "n_removed", "n_spans"])

    key = [F.coalesce(docs["doc_id"].cast("bigint"), F.lit(LOWEST_ID)) == ranges["k"],
           F.hash(utf8(docs["text"])).cast("bigint") == ranges["h"]]
    joined = docs.join(ranges, key, "left")
    return joined.select(*[docs[c] for c in docs.columns], cut(utf8(docs["text"]), ranges["spans"]).alias(name))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept bytes as its text, and ``n_chars`` counted anew if there is one. A character that is cut
    into goes as a whole."""
    @F.arrow_udf("string")
    def readable(kept: pa.Array) -> pa.Array:
        return pa.array([k.decode("utf-8", "ignore") for k in kept.to_pylist()], pa.string())
    name, taken = "repeats", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    cut = remove_repeats(docs, name)
    text = F.when(cut[name]["n_removed"] > 0, readable(cut[name]["kept"])).otherwise(cut["text"])
    changed = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def op3_suffix_array(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "repeats.n_bytes", "repeats.n_removed", "repeats.n_spans",
        F.sha2("repeats.kept", 256).alias("kept_sha256"))

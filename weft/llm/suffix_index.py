"""Repeated byte strings across documents by a family of suffix arrays of geometric sizes.

Every byte covered by a string of LENGTH bytes that also starts in a document of a smaller id is found.

The family (``SuffixFamily``) takes text in batches: a batch gets its suffix array, over LENGTH bytes of each suffix, is
merge-scanned against the suffix arrays of the existing levels, and becomes a level itself; levels of about equal size
merge.  All that is found for a string comes from these scans.  What comes before them only compacts: equal strings
around an anchor have equal suffixes, so they go through the family once, with the least id, and what it knows of their
suffixes is held against each document that has them; the same goes for equal whole texts.

Only suffixes near shared anchors can match.  An anchor is a place whose hash of GRAM bytes is the least of some string
of LENGTH bytes, so equal strings have an anchor at the same place, and about one place in ten is one.  The job:

1. copies of whole texts are found by hash; only the least id of each text goes on, the rest, all of whose strings also
   start in that document, go whole;
2. anchors' hashes are dealt over buckets, where those of a single document are left out;
3. documents meet their shared anchors and send each anchor's surroundings to the bucket of its hash; surroundings
   repeated within a group of documents are sent once, for the least id, the others being settled there;
4. a bucket sorts what it got and compacts equal surroundings to the least id; the suffixes of these go through a
   family in the order of the ids, but for grams with one surroundings only, which no other suffix can match;
5. the found ranges are merged by document.

A gram in more than HOT documents is dealt by the whole strings around it instead, so no bucket gathers it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, by_class, checkpointed, trimmed
from .shingles import mix

LENGTH = 50
GRAM = 32
SIDE = LENGTH - GRAM  # bytes of surroundings on either side of a gram
WIDTH = GRAM + 2 * SIDE + 2  # gram, right side, left side backwards, and how many bytes of each side there are
HOT = 2048
PIECE = 1 << 20
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 64 << 20  # of text, whose anchors' hashes make one bucket
SLICE_BYTES = 32 << 20  # of text, whose rows are formed together: large slices make few, large rows
BATCH = 1 << 16
BROADCAST_BYTES = 24 << 20
_BASE = 0x100000001B3
_HOT_BIT = np.uint64(1 << 63)


@dataclass
class SuffixArray:
    """A text's distinct suffixes, over LENGTH bytes, in order: their places, and the least document id of each."""

    text: np.ndarray
    places: np.ndarray
    ids: np.ndarray

    def suffixes(self) -> np.ndarray:
        return _suffixes(self.text, self.places)


def _suffixes(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The first LENGTH bytes of the suffixes at these places, as they compare."""
    if not len(places):
        return np.empty(0, f"S{LENGTH}")
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, LENGTH)[places]).view(f"S{LENGTH}").ravel()


def _merge_scan(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that merges two sorted runs of suffixes, number of each merged suffix among the distinct ones)."""
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")  # sorts by merging runs: the two that are there, once
    both = both[order]
    return order, np.cumsum(np.concatenate([[True], both[1:] != both[:-1]])) - 1


class SuffixFamily:
    """Suffix arrays of geometric sizes over all text that was added."""

    def __init__(self):
        self.levels: list[SuffixArray] = []

    def add(self, text: np.ndarray, places: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The least document id known, in this batch or before it, for the suffix at each of a batch's places."""
        if not len(places):
            return np.empty(0, np.int64)
        keys = _suffixes(text, places)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        start, number = np.flatnonzero(first), np.empty(len(keys), np.int64)
        number[order] = np.cumsum(first) - 1
        own, known = keys[start], np.minimum.reduceat(docs[order], start)
        batch = SuffixArray(text, places[order][start], known.copy())
        for level in self.levels:
            order, distinct = _merge_scan(level.suffixes(), own)
            least = np.minimum.reduceat(np.concatenate([level.ids, known])[order], np.flatnonzero(np.diff(distinct, prepend=-1)))
            from_batch = order >= len(level.ids)
            known[order[from_batch] - len(level.ids)] = least[distinct[from_batch]]
        self._push(batch)
        return known[number]

    def _push(self, level: SuffixArray) -> None:
        while self.levels and len(self.levels[-1].ids) <= 2 * len(level.ids):
            older = self.levels.pop()
            order, distinct = _merge_scan(older.suffixes(), level.suffixes())
            start = np.flatnonzero(np.diff(distinct, prepend=-1))
            places = np.concatenate([older.places, level.places + len(older.text)])[order]
            ids = np.concatenate([older.ids, level.ids])[order]
            level = SuffixArray(np.concatenate([older.text, level.text]), places[start], np.minimum.reduceat(ids, start))
        self.levels.append(level)


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = best(x[:-span], x[span:])
        span *= 2
    return best(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of a text's anchors, in order."""
    places, hashes = [], []
    for s in range(0, len(text) - LENGTH + 1, PIECE):
        h = text[s : s + PIECE + LENGTH - 1].astype(np.uint64) + np.uint64(1)
        base, span = _BASE, 1
        while span < GRAM:
            h = h[:-span] * np.uint64(base) + h[span:]
            base, span = base * base % (1 << 64), 2 * span
        h = mix(h)
        least = _slide(h, SIDE + 1, np.minimum)  # of every string of LENGTH bytes
        most = _slide(np.pad(least, SIDE), SIDE + 1, np.maximum)  # of the strings that hold a place
        at = np.flatnonzero(h == most)
        places.append(at + s)
        hashes.append(h[at])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, index = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[index]


def _press(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpress(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _press_ints(values: np.ndarray, kind: str = "<i8") -> bytes:
    """Integers compressed byte plane by byte plane."""
    raw = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)
    return _press(raw.T.tobytes())


def _unpress_ints(blobs: list[bytes], kind: str = "<i8") -> np.ndarray:
    width = np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(_unpress(b), np.uint8).reshape(width, -1).T).view(kind).ravel() for b in blobs]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _pack48(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack48(blobs: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view("<u8").ravel()


def _chunk_of(docs: np.ndarray, chunks: int) -> np.ndarray:
    return (mix(docs.astype(np.int64).view(np.uint64) + np.uint64(0xC0FFEE)) % np.uint64(chunks)).astype(np.int64)


def _by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, rows) for each key, rows in their order."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order], prepend=keys[order][:1] - 1))
    for s, e in zip(cuts, [*cuts[1:], len(keys)], strict=True):
        yield int(keys[order[s]]), order[s:e]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _schema(**fields) -> pa.Schema:
    return pa.schema([pa.field(k, v) for k, v in fields.items()])


_I, _B = pa.int64(), pa.binary()
TEXTS = _schema(chunk=_I, docs=_B, starts=_B, lengths=_B, texts=_B)
HASHES = _schema(bucket=_I, docs=_B, counts=_B, hashes=_B)
SHARED = _schema(chunk=_I, docs=_B, counts=_B, hashes=_B)
SENT = _schema(span=pa.bool_(), key=_I, docs=_B, places=_B, what=_B)
SPANS = _schema(chunk=_I, docs=_B, spans=_B)
MERGED = _schema(doc_id=_I, spans=_B)
DEALT = _schema(doc_id=_I, h1=_I, h2=_I, n=_I, spans=_B)


def _ddl(schema: pa.Schema) -> str:
    kind = {pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kind[f.type]}" for f in schema)


def _hash_rows(buckets: int):
    """Texts to rows of the anchors' hashes for each bucket, distinct within a document."""

    def emit(ids: list[int], hashes: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(hashes)
        who = np.repeat(np.arange(len(ids)), [len(x) for x in hashes])
        rows, ids = [], np.array(ids, np.int64)
        for bucket, at in _by((h % np.uint64(buckets)).astype(np.int64)):
            local, counts = np.unique(who[at], return_counts=True)
            rows.append((bucket, _press_ints(ids[local]), _press_ints(counts, "<u4"), _pack48(h[at] >> np.uint64(16))))
        return _batch(rows, HASHES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                x = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.empty(0, np.uint8)
                if len(x) < LENGTH:
                    continue
                ids.append(doc_id)
                hashes.append(np.unique(anchors(x)[1]))
                size += len(x)
                if size > SLICE_BYTES:
                    yield emit(ids, hashes)
                    ids, hashes, size = [], [], 0
        if ids:
            yield emit(ids, hashes)

    return run


def _shared_rows(chunks: int, hot: int):
    """A bucket's hash rows to rows of those hashes that several documents have, by chunk of documents."""

    def run(table: pa.Table) -> pa.Table:
        docs = np.repeat(_unpress_ints(table["docs"].to_pylist()), _unpress_ints(table["counts"].to_pylist(), "<u4"))
        h = _unpack48(table["hashes"].to_pylist())
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.diff(h[order], prepend=h[order][:1] + np.uint64(1)))
        n = np.diff(np.append(first, len(h)))
        times = np.empty(len(h), np.int64)
        times[order] = np.repeat(n, n)
        shared = times > 1
        docs, h = docs[shared], h[shared] | np.where(times[shared] > hot, _HOT_BIT, np.uint64(0))
        rows = []
        for chunk, at in _by(_chunk_of(docs, chunks)):
            at = at[np.argsort(docs[at], kind="stable")]
            ids, per = np.unique(docs[at], return_counts=True)
            rows.append((chunk, ids.astype("<i8").tobytes(), per.astype("<u4").tobytes(), h[at].astype("<u8").tobytes()))
        return pa.Table.from_batches([_batch(rows, SHARED)])

    return run


def _surroundings(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of WIDTH bytes: gram, right side, left side backwards, bytes there on the left and on the right."""
    out = np.zeros((len(at), WIDTH), np.uint8)
    padded = np.concatenate([np.zeros(SIDE, np.uint8), x, np.zeros(SIDE, np.uint8)])
    out[:, : GRAM + SIDE] = np.lib.stride_tricks.sliding_window_view(padded, GRAM + SIDE)[at + SIDE]
    out[:, GRAM + SIDE : -2] = np.lib.stride_tricks.sliding_window_view(padded, SIDE)[at][:, ::-1]
    out[:, -2] = np.minimum(at, SIDE)
    out[:, -1] = np.minimum(len(x) - GRAM - at, SIDE)
    return out


def _single_strings(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row once for every string of LENGTH bytes in it, all else blanked; (rows, index of the row)."""
    out, index = [], []
    for left in range(SIDE + 1):
        at = np.flatnonzero((rows[:, -2] >= left) & (rows[:, -1] >= SIDE - left))
        one = rows[at].copy()
        one[:, LENGTH - left : GRAM + SIDE] = 0
        one[:, GRAM + SIDE + left : -2] = 0
        one[:, -2], one[:, -1] = left, SIDE - left
        out.append(one)
        index.append(at)
    return np.concatenate(out), np.concatenate(index)


def _row_hash(rows: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(rows), -(-WIDTH // 8) * 8), np.uint8)
    wide[:, :WIDTH] = rows
    h = np.zeros(len(rows), np.uint64)
    for column in wide.view("<u8").T:
        h = mix(h * np.uint64(_BASE) + column)
    return h


def _covered(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """(start, end) of all strings of LENGTH bytes around anchors at these places."""
    return np.column_stack([places - rows[:, -2], places + GRAM + rows[:, -1]])


def _settled(rows: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts the rows, least document id with the same row, by sorted place)."""
    keys = rows.view(f"V{WIDTH}").ravel().view(f"S{WIDTH}")
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    least = np.minimum.reduceat(docs[order], np.flatnonzero(first))
    return order, least[np.cumsum(first) - 1]


def _send_rows(buckets: int):
    """A chunk's documents and shared hashes to surroundings for the buckets, and spans settled in the chunk."""

    def run(texts: pa.Table, shared: pa.Table) -> pa.Table:
        counts = np.frombuffer(b"".join(shared["counts"].to_pylist()), "<u4")
        owner = np.repeat(np.frombuffer(b"".join(shared["docs"].to_pylist()), "<i8"), counts)
        wanted = np.frombuffer(b"".join(shared["hashes"].to_pylist()), "<u8")
        order = np.argsort(owner, kind="stable")
        owner, wanted = owner[order], wanted[order]
        rows, docs, places, keys = [np.empty((0, WIDTH), np.uint8)], [], [], []
        for doc_id, start, x in _unpacked(texts):
            s, e = np.searchsorted(owner, [doc_id, doc_id + 1])
            if s == e:
                continue
            at, h = anchors(x)
            own = np.sort(wanted[s:e] & ~_HOT_BIT)
            hot = np.sort(wanted[s:e][wanted[s:e] >= _HOT_BIT] & ~_HOT_BIT)
            short = h >> np.uint64(16)
            hit = own[np.minimum(np.searchsorted(own, short), len(own) - 1)] == short
            at, h, short = at[hit], h[hit], short[hit]
            around = _surroundings(x, at)
            fits = around[:, -2].astype(int) + around[:, -1] >= SIDE
            at, h, short, around = at[fits], h[fits], short[fits], around[fits]
            if len(hot) and len(at):
                is_hot = hot[np.minimum(np.searchsorted(hot, short), len(hot) - 1)] == short
                single, of = _single_strings(around[is_hot])
                at = np.concatenate([at[~is_hot], at[is_hot][of]])
                h = np.concatenate([h[~is_hot], _row_hash(single)])
                around = np.concatenate([around[~is_hot], single])
            rows.append(around)
            docs.append(np.full(len(at), doc_id, np.int64))
            places.append(start + at)
            keys.append(h)
        around = np.concatenate(rows)
        if not len(around):
            return pa.Table.from_batches([_batch([], SENT)])
        docs, places, keys = np.concatenate(docs), np.concatenate(places), np.concatenate(keys)
        order, least = _settled(around, docs)
        around, docs, places, keys = around[order], docs[order], places[order], keys[order]
        here = docs > least
        out = []
        if here.any():
            spans = _covered(around[here], places[here])
            out.append((True, int(texts["chunk"][0].as_py()), _press_ints(docs[here]), b"", _press_ints(spans.ravel(), "<u4")))
        around, docs, places, keys = around[~here], docs[~here], places[~here], keys[~here]
        for bucket, at in _by((keys % np.uint64(buckets)).astype(np.int64)):
            out.append((False, bucket, _press_ints(docs[at]), _press_ints(places[at], "<u4"), _press(around[at].tobytes())))
        return pa.Table.from_batches([_batch(out, SENT)])

    return run


def match_bucket(around: np.ndarray, docs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(docs, spans) that a bucket's surroundings prove to be repeated from documents of smaller ids."""
    if not len(docs):
        return np.empty(0, np.int64), np.empty((0, 2), np.int64)
    order, least = _settled(around, docs)
    around, docs, places = around[order], docs[order], places[order]
    # equal surroundings stand for each other: in a document of a larger id than the least, all their strings are repeated
    whole = docs > least
    out_docs, out_spans = [docs[whole]], [_covered(around[whole], places[whole])]
    around, docs, places = around[~whole], docs[~whole], places[~whole]
    # a gram with only one surroundings has no other suffix to meet
    new_gram = np.concatenate([[True], (around[1:, :GRAM] != around[:-1, :GRAM]).any(1)])
    new_row = np.concatenate([[True], (around[1:] != around[:-1]).any(1)])
    gram = np.cumsum(new_gram) - 1
    several = np.bincount(gram, new_row)[gram] > 1
    around, docs, places = around[several], docs[several], places[several]
    order = np.argsort(docs, kind="stable")
    around, docs, places = around[order], docs[order], places[order]
    family = SuffixFamily()
    step, wide = BATCH // (SIDE + 1), GRAM + 2 * SIDE
    for s in range(0, len(docs), step):
        part, ids, at = around[s : s + step], docs[s : s + step], places[s : s + step]
        straight = np.concatenate([part[:, GRAM + SIDE : -2][:, ::-1], part[:, : GRAM + SIDE]], 1)
        start = np.arange(SIDE + 1)  # suffixes start so many bytes into the surroundings
        valid = (SIDE - start[None, :] <= part[:, -2:-1]) & (start[None, :] <= part[:, -1:])
        who, off = np.nonzero(valid)
        found = family.add(straight.ravel(), who * wide + off, ids[who]) < ids[who]
        who, off = who[found], off[found]
        if len(who):
            head = np.flatnonzero(np.diff(who, prepend=-1))
            hit = who[head]
            lo, hi = np.minimum.reduceat(off, head), np.maximum.reduceat(off, head)
            out_docs.append(ids[hit])
            out_spans.append(np.column_stack([at[hit] - SIDE + lo, at[hit] - SIDE + hi + LENGTH]))
    return np.concatenate(out_docs), np.concatenate(out_spans)


def _match_rows(chunks: int):
    def run(table: pa.Table) -> pa.Table:
        settled = table.filter(table["span"])
        table = table.filter(pc.invert(table["span"]))
        docs = _unpress_ints(table["docs"].to_pylist())
        places = _unpress_ints(table["places"].to_pylist(), "<u4").astype(np.int64)
        around = np.frombuffer(b"".join(map(_unpress, table["what"].to_pylist())), np.uint8).reshape(-1, WIDTH)
        ids, spans = match_bucket(around, docs, places)
        ids = np.concatenate([ids, _unpress_ints(settled["docs"].to_pylist())])
        spans = np.concatenate([spans, _unpress_ints(settled["what"].to_pylist(), "<u4").reshape(-1, 2)])
        rows = [(c, ids[at].astype("<i8").tobytes(), spans[at].astype("<u4").tobytes()) for c, at in _by(_chunk_of(ids, chunks))]
        return pa.Table.from_batches([_batch(rows, SPANS)])

    return run


def _merge_rows(table: pa.Table) -> pa.Table:
    """A chunk's spans to one row a document of disjoint spans in order."""
    docs = np.frombuffer(b"".join(table["docs"].to_pylist()), "<i8")
    spans = np.frombuffer(b"".join(table["spans"].to_pylist()), "<u4").reshape(-1, 2).astype(np.int64)
    order = np.lexsort((spans[:, 0], docs))
    docs, spans = docs[order], spans[order]
    rows = []
    for doc_id, at in _by(docs):
        own = spans[at]
        reach = np.maximum.accumulate(own[:, 1])
        first = np.flatnonzero(np.concatenate([[True], own[1:, 0] > reach[:-1]]))
        joined = np.column_stack([own[first, 0], reach[np.append(first[1:], len(own)) - 1]])
        rows.append((doc_id, joined.astype("<u4").tobytes()))
    return pa.Table.from_batches([_batch(rows, MERGED)])


def _identified(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text) with what tells a text from others of its id: h1, h2, n; null texts are empty."""
    text = F.coalesce("text", F.lit(""))
    return rows.withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text), "n": F.octet_length(text).cast("long")})


def _deal_rows(merged: pa.Table, parts: pa.Table) -> pa.Table:
    """The spans of an id that stands for several texts to one row a text, counted from that text's start."""
    spans = np.frombuffer(merged["spans"][0].as_py(), "<u4").reshape(-1, 2).astype(np.int64) if merged.num_rows else np.empty((0, 2), np.int64)
    rows = []
    for part in parts.to_pylist():
        s, e = np.searchsorted(spans[:, 0], [part["start"], part["start"] + part["n"]])
        if s < e:
            rows.append((part["doc_id"], part["h1"], part["h2"], part["n"], (spans[s:e] - part["start"]).astype("<u4").tobytes()))
    return pa.Table.from_batches([_batch(rows, DEALT)])


def _few(rows: DataFrame) -> DataFrame:
    """rows, broadcast in joins up to BROADCAST_IDS of them."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, spans, whole): the repeated byte ranges of each document that has any.

    ``spans`` holds pairs of little-endian unsigned 32-bit integers (start, end), disjoint and in order; ``whole`` marks
    copies of the text of a smaller id, which are repeated from end to end.  Where an id stands for several texts, rows
    are of single texts and h1, h2 and n (see ``_identified``) tell which.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull())
    every = checkpointed(_identified(rows).drop("text"))
    texts = rows.where(F.octet_length("text") >= LENGTH)
    hashed = every.where(F.col("n") >= LENGTH)
    total = hashed.agg(F.sum("n")).first()[0] or 0
    first = hashed.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("rows"))
    first = checkpointed(first.where("last > least").drop("last"))
    key = ["doc_id", "h1", "h2", "n"]
    one = F.struct("h1", "h2", "n")
    several = checkpointed(every.groupBy("doc_id").agg(F.min(one).alias("a"), F.max(one).alias("b")).where("a <> b").select("doc_id"))
    by = key if several.count() else ["doc_id"]  # ids of one text, as ids should be, need no more
    copies = checkpointed(by_class(hashed, first, ["h1", "h2", "n"], "rows").where("doc_id > least").select(*key).distinct())
    away = _few(copies.select(*by).distinct())
    if by == key:
        # the texts of an id are one document of several parts, a byte apart: none is smaller than another
        parts = every.join(_few(several), "doc_id", "left_semi").distinct()
        before = Window.partitionBy("doc_id").orderBy("h1", "h2", "n").rowsBetween(Window.unboundedPreceding, -1)
        parts = checkpointed(parts.withColumn("start", F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0))))
        most = parts.agg(F.max(F.col("start") + F.col("n"))).first()[0]
        if most >= 1 << 32:
            raise ValueError(f"the texts of one id make up {most} bytes, places have 32 bits")
        texts = _identified(texts).join(_few(parts), key, "left").withColumn("start", F.coalesce("start", F.lit(0)))
    else:
        texts = texts.withColumn("start", F.lit(0).cast("long"))
    single = texts.join(away, by, "left_anti").select("doc_id", "start", "text")

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(least, -(-total // CHUNK_BYTES))
    buckets = 2 * chunks
    hash_buckets = max(least, -(-total // BUCKET_BYTES))
    hashes = single.mapInArrow(trimmed(_hash_rows(hash_buckets)), _ddl(HASHES))
    shared = hashes.groupBy("bucket").applyInArrow(_shared_rows(chunks, hot), _ddl(SHARED))
    placed = single.mapInArrow(trimmed(_text_rows(chunks)), _ddl(TEXTS))
    sent = placed.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_send_rows(buckets), _ddl(SENT))
    matched = sent.groupBy("key").applyInArrow(_match_rows(chunks), _ddl(SPANS))
    merged = matched.groupBy("chunk").applyInArrow(_merge_rows, _ddl(MERGED))
    if by == key:
        merged = checkpointed(merged)
        dealt = merged.join(_few(several), "doc_id", "left_semi").groupBy("doc_id").cogroup(parts.groupBy("doc_id")).applyInArrow(_deal_rows, _ddl(DEALT))
        others = merged.join(_few(several), "doc_id", "left_anti").join(every.distinct(), "doc_id")
        merged = others.select(*key, "spans").unionByName(dealt)
    return merged.withColumn("whole", F.lit(False)).unionByName(
        copies.select(*by, F.lit(None).cast("binary").alias("spans"), F.lit(True).alias("whole"))
    )


def _text_rows(chunks: int):
    """Texts to rows of compressed texts for each chunk: a third of what plain rows would shuffle."""

    def emit(ids: list[int], starts: list[int], texts: list[bytes]) -> pa.RecordBatch:
        rows, docs, begin = [], np.array(ids, np.int64), np.array(starts, np.int64)
        for chunk, at in _by(_chunk_of(docs, chunks)):
            own = [texts[k] for k in at]
            rows.append((chunk, _press_ints(docs[at]), _press_ints(begin[at], "<u4"), _press_ints(np.array([len(t) for t in own]), "<u4"), _press(b"".join(own))))
        return _batch(rows, TEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, starts, texts, size = [], [], [], 0
        for batch in batches:
            for doc_id, start, text in zip(batch["doc_id"].to_pylist(), batch["start"].to_pylist(), batch["text"], strict=True):
                ids.append(doc_id)
                starts.append(start)
                texts.append(text.as_buffer().to_pybytes())
                size += len(texts[-1])
                if size > SLICE_BYTES:
                    yield emit(ids, starts, texts)
                    ids, starts, texts, size = [], [], [], 0
        if ids:
            yield emit(ids, starts, texts)

    return run


def _unpacked(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
    for docs, starts, lengths, texts in zip(*(table[c].to_pylist() for c in ("docs", "starts", "lengths", "texts")), strict=True):
        raw, at = np.frombuffer(_unpress(texts), np.uint8), 0
        for doc_id, start, n in zip(_unpress_ints([docs]).tolist(), *(_unpress_ints([x], "<u4").tolist() for x in (starts, lengths)), strict=True):
            yield doc_id, start, raw[at : at + n]
            at += n


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False, hot: int = HOT) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``keep_bytes`` the kept bytes.

    Null texts are empty.  Texts shorter than LENGTH bytes and rows without an id keep all and repeat nothing.  Rows of
    one id are no smaller than each other.  An empty table gives an empty result; other columns are not read.
    """
    spans = checkpointed(repeated_spans(docs, id_col=id_col, text_col=text_col, hot=hot))
    by = [c for c in ("doc_id", "h1", "h2", "n") if c in spans.columns]
    spans = spans.groupBy(*by).agg(F.max("spans").alias("spans"), F.max("whole").alias("whole"))
    size = spans.agg(F.sum(F.coalesce(F.length("spans"), F.lit(0)) + 16 + 8 * len(by))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        spans = F.broadcast(spans)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows if by == ["doc_id"] else _identified(rows)
    joined = rows.join(spans, by, "left").select("doc_id", "text", "spans", "whole")
    schema = _schema(doc_id=_I, n_bytes=_I, n_removed=_I, n_spans=_I, kept_sha256=pa.string(), kept=_B)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans, whole in zip(batch["doc_id"].to_pylist(), batch["text"], batch["spans"].to_pylist(), batch["whole"].to_pylist(), strict=True):
                raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                ranges = [(0, len(raw))] if whole else np.frombuffer(spans or b"", "<u4").reshape(-1, 2).tolist()
                edges = [0, *(x for r in ranges for x in r), len(raw)]
                kept = b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))
                out.append((doc_id, len(raw), len(raw) - len(kept), len(ranges), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            yield _batch(out, schema)

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    result = joined.mapInArrow(run, ddl)
    return result if keep_bytes else result.drop("kept")

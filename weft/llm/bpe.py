"""BPE encoding by backtracking over longest matches, decoding by an offset table.

A token sequence is the one that byte-pair merging yields exactly if every two neighbours are compatible: merging the
two tokens' bytes alone would not merge across their border.  So the encoder takes the longest token at each place, in
the order an Aho-Corasick automaton of the vocabulary finds them, checks it against the token before it in a table of
compatible pairs, and on failure falls back to the next shorter token or, with none left, takes back the last token and
marks the place as dead.  Each place dies at most once, so a piece takes time linear in its length.

The automaton holds the reversed tokens and reads the reversed piece once, which gives the longest token starting at
every place.  The pair table is filled as pairs turn up, by undoing merges on both sides of the border.  Texts are cut
at the tokenizer's own piece borders; pieces recur, so each worker keeps a bounded memo of encoded pieces.

Decoding concatenates the tokens' bytes, gathered from one byte string by a table of offsets.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import trimmed

#: The byte-level tokenizer's piece pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_ROOM = 150_000  # entries of each half of the memo
MEMO_LENGTH = 48
PAIR_ROOM = 200_000
SLICE_BYTES = 4 << 20

ENCODED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
])
ROUND_TRIP = T.StructType([*ENCODED.fields, T.StructField("decoded", T.StringType())])
CHECKED = T.StructType([*ENCODED.fields, T.StructField("decoded_ok", T.BooleanType())])


def byte_symbols() -> dict[str, int]:
    """The printable symbol that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of a byte-level BPE tokenizer file: ids, merges, automaton, offsets."""

    def __init__(self, blob: bytes):
        import ahocorasick
        import regex

        spec = json.loads(blob)
        byte_of = byte_symbols()
        as_bytes = lambda s: bytes(byte_of[c] for c in s)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # rank space: bytes first, then merged tokens in the order of their merges
        symbols = [s for s in byte_of if s in model["vocab"]]
        rank = {s: i for i, s in enumerate(symbols)}
        self.split: list[tuple[int, int]] = [(i, i) for i in range(len(symbols))]
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in merges:
            if left + right not in rank:
                rank[left + right] = len(rank)
                self.split.append((rank[left], rank[right]))
            self.merged.setdefault((rank[left], rank[right]), rank[left + right])
        self.token = [as_bytes(s) for s in rank]
        self.id_of = [model["vocab"][s] for s in rank]
        known = {t: r for r, t in enumerate(self.token)}
        self.shorter = [next((known[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in known), -1) for t in self.token]
        self.automaton = ahocorasick.Automaton()
        for t, r in known.items():
            self.automaton.add_word(t[::-1].decode("latin-1"), r)
        self.automaton.make_automaton()
        self.pieces = regex.compile(PATTERN).findall
        self.twin_space = regex.compile(r"\s\s").search
        self.size = [len(t) for t in self.token]
        self.packed = [np.array([i], "<u4").tobytes() for i in self.id_of]
        # what is learned on the way, all of it bounded and dropped by forget()
        self.compatible: dict[int, bool] = {}  # by left << 32 | right
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # offsets of the tokens' bytes by id, special tokens included
        by_id = {i: t for i, t in zip(self.id_of, self.token, strict=True)} | {i: s.encode() for s, i in self.special.items()}
        lengths = np.zeros(max(by_id) + 1, np.int64)
        for i, t in by_id.items():
            lengths[i] = len(t)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.bytes = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(len(lengths))), np.uint8)

    def fits(self, left: int, right: int) -> bool:
        """Whether merging left's and right's bytes would leave the border between the two unmerged."""
        key = left << 32 | right
        if (known := self.compatible.get(key)) is not None:
            return known
        bound, result = len(self.token), True
        while True:
            over = self.merged.get((left, right))
            if over is not None and over < bound:
                result = False
                break
            # undo the later of the two tokens' last merges; a byte can't be undone
            left_byte, right_byte = self.split[left][0] == left, self.split[right][0] == right
            if left_byte and right_byte:
                break
            if not left_byte and (left > right or right_byte):
                bound = min(bound, left) if left > right else left
                left = self.split[left][1]
            else:
                bound = right + 1
                right = self.split[right][0]
        if len(self.compatible) >= PAIR_ROOM:
            self.compatible.clear()
        self.compatible[key] = result
        return result

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ranks of the tokens that merging yields for one piece."""
        n = len(piece)
        # the automaton tells the matches of one place longest first, so the longest is the last to be written
        found = list(self.automaton.iter(piece[::-1].decode("latin-1")))
        found.reverse()
        longest = dict(found)
        fits, size, shorter = self.fits, self.size, self.shorter
        out: list[int] = []
        dead: set[int] = set()
        at, token, last = 0, longest.get(n - 1, -1), -1
        while at < n:
            while token >= 0:
                if last < 0 or fits(last, token):
                    if not dead or at + size[token] not in dead:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                last = token
                at += size[token]
                token = longest.get(n - 1 - at, -1)
            else:
                dead.add(at)
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1
                token = shorter[token]
        return out

    def _ids(self, part: str) -> bytes:
        """Ids of a word or piece, cut by the pattern; kept in the young half of the memo, a full half becomes the old."""
        if (out := self.old.get(part)) is None:
            pieces = self.pieces(part)
            if len(pieces) == 1:
                pack = self.packed
                out = b"".join([pack[r] for r in self.encode_piece(part.encode())])
            else:
                memo, ids = self.memo.get, self._ids
                out = b"".join([memo(p) or ids(p) for p in pieces])
        if len(part) <= MEMO_LENGTH:
            if len(self.memo) >= MEMO_ROOM:
                self.old, self.memo = self.memo, {}
            self.memo[part] = out
        return out

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        A single space between two non-space characters always starts a piece, so words are looked up with the space
        before them; texts with runs of white space are cut by the pattern alone.  A piece cut again is itself.
        """
        if self.twin_space(text):
            parts = self.pieces(text)
        else:
            parts = text.replace(" ", "\0 ").split("\0") if "\0" not in text else self.pieces(text)
        memo, ids = self.memo.get, self._ids
        return b"".join([memo(p) or ids(p) for p in parts])

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if self.special_re is None or not (found := list(self.special_re.finditer(text))):
            return self._plain(text)
        out, at = [], 0
        for m in found:
            out += [self._plain(text[at : m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def forget(self) -> None:
        """Drop the memo and the pair table; the vocabulary's own tables stay."""
        self.memo, self.old, self.compatible = {}, {}, {}

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; ids beyond the vocabulary have no bytes, and broken UTF-8 becomes U+FFFD."""
        ids = ids[ids < len(self.offsets) - 1]
        if not len(ids):
            return ""
        start = self.offsets[ids]
        length = self.offsets[ids + 1] - start
        ends = np.cumsum(length)
        where = np.arange(ends[-1]) + np.repeat(start - (ends - length), length)
        return self.bytes[where].tobytes().decode("utf-8", "replace")


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(blob: bytes) -> Vocabulary:
    """The tables of a tokenizer file, built once in each process."""
    key = hashlib.sha256(blob).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(blob)
    return _LOADED[key]


def _shipped(spark: SparkSession, path: str):
    """The tokenizer file as a broadcast: 1.5 MB, whatever the input."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _sliced(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], weigh) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size > SLICE_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, check: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit integers, of every whole text.

    With ``decoded`` also the text that the ids decode to, in the same pass; with ``check`` only whether it is the text.
    Null and empty texts have no tokens; a
    null doc_id stays null; repeated rows are encoded each; an empty table gives an empty result; other columns are
    not read.
    """
    blob = _shipped(docs.sparkSession, path)
    schema = CHECKED if check else ROUND_TRIP if decoded else ENCODED
    types = [pa.int64(), pa.int64(), pa.binary(), pa.bool_() if check else pa.string()][: len(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(blob.value)

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                    plain = text.as_py() or ""
                    ids = vocab.encode(plain)
                    row = (doc_id, len(ids) // 4, ids)
                    if check or decoded:
                        back = vocab.decode(np.frombuffer(ids, "<u4").astype(np.int64))
                        row = (*row, back == plain if check else back)
                    yield row
            vocab.forget()

        return _sliced(rows(), schema.fieldNames(), types, lambda r: len(r[2]) + 64)

    return _texts(docs, id_col, text_col).mapInArrow(trimmed(run), schema)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids), special tokens included."""
    blob = _shipped(tokens.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(blob.value)

        def rows():
            for batch in batches:
                for doc_id, ids in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                    yield doc_id, vocab.decode(np.frombuffer(ids or b"", "<u4").astype(np.int64))

        return _sliced(rows(), ["doc_id", "text"], [pa.int64(), pa.string()], lambda r: len(r[1]) + 64)

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")

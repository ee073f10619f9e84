"""Near-duplicate documents by a chosen-path similarity join on word shingles.

A run is a random tree.  At each node a set chooses each of its tokens with probability 1 / (threshold * size), by a
hash of the node's path and the token, and goes to the child of every chosen token.  Sets with much in common choose
common tokens, so a pair at the threshold shares on average at least one child of a shared node.  Buckets of at most
``LIMIT`` sets are compared by brute force, larger ones are split further down to ``DEPTH``, and what is still larger
is compared block by block.  Runs are repeated until a pair at the threshold is found with the target recall.

A pair that shares several buckets counts at the least of them only, so links are counted without listing them: a
bucket reports link counts and a spanning forest.  A first pass over the buckets, on small min-hash sketches, tells
which sets of a bucket have a likely partner whose bucket this is; only for these are the whole sets computed again and
compared exactly.

Documents of equal shingle sets are one class from the start, and so are those of equal texts without words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, by_class, checkpointed, partitions_for, sweep, trimmed
from .components import components, local_forest
from .shingles import mix, shingle_sets

NUM, DEN = 4, 5  # the threshold as a fraction: 0.8
DEPTH = 3
RECALL = 0.995
LIMIT = 64
BLOCK = 512
BINS = 64
LIKELY = 0.55  # of a sketch's bins: five standard deviations below the threshold
SLICE_BYTES = 1 << 19
TOKENS_AT_ONCE = 1 << 16


def runs_for(recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with this probability, if every bucket is split to the end."""
    met = 1.0
    for _ in range(depth):
        met = 1 - exp(-met)  # about one shared child a shared node
    return ceil(log(1 - recall) / log(1 - met))


def _children(tokens: np.ndarray, paths: np.ndarray, bound: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(index of the parent path, path of the child) of every child that a set chooses below these paths."""
    parents, children = [], []
    for s in range(0, len(tokens), TOKENS_AT_ONCE):
        h = mix(tokens[None, s : s + TOKENS_AT_ONCE] ^ paths[:, None])
        p, t = np.nonzero(h <= bound)
        parents.append(p)
        children.append(mix(h[p, t] + np.uint64(1)))
    return np.concatenate(parents), np.concatenate(children)


def chains(tokens: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Rows of DEPTH paths, one for each way a set goes down the trees; 0 where it chose no child."""
    bound = np.uint64(min((1 << 64) - 1, (1 << 64) * DEN // (NUM * len(tokens))))
    _, at = _children(tokens, seeds, bound)
    rows = np.zeros((len(at), DEPTH), np.uint64)
    rows[:, 0] = at
    for d in range(1, DEPTH):
        alive = np.flatnonzero(rows[:, d - 1])
        if not len(alive):
            break
        parent, child = _children(tokens, rows[alive, d - 1], bound)
        dead = np.setdiff1d(np.arange(len(rows)), alive[parent])
        grown = rows[alive[parent]]
        grown[:, d] = child
        rows = np.concatenate([rows[dead], grown])
    return rows


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The least hash of each of BINS bins, in 16 bits, 0 for an empty bin."""
    h = mix(tokens + np.uint64(0x51ED))
    h.sort()
    where = (h >> np.uint64(58)).astype(np.int64)
    first = np.concatenate([[True], where[1:] != where[:-1]]) if len(h) else np.empty(0, bool)
    out = np.zeros(BINS, np.uint16)
    out[where[first]] = ((h[first] >> np.uint64(20)) & np.uint64(0x7FFF)).astype(np.uint16) + np.uint16(1)
    return out


def _slices(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[list[tuple], list[bytes | None]]]:
    """(key columns' values, texts) of slices of the rows."""
    held, texts, size = [], [], 0
    for batch in batches:
        for *key, text in zip(*(batch[k].to_pylist() for k in keys), batch["text"], strict=True):
            held.append(tuple(key))
            texts.append(text.as_buffer().to_pybytes() if text.is_valid else None)
            size += len(texts[-1] or b"") + 1
            if size > SLICE_BYTES:
                yield held, texts
                held, texts, size = [], [], 0
    if held:
        yield held, texts


def _identity(tokens: np.ndarray, text: bytes | None) -> tuple[int | None, int | None]:
    """128 bits that equal shingle sets share, or equal texts without words; null texts have none."""
    if len(tokens):
        h = mix(tokens).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(tokens * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)))
        return int(h[0].astype(np.int64)), int(h[1].astype(np.int64))
    if text is None:
        return None, None
    h = hashlib.blake2b(text, digest_size=16).digest()
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _signatures(runs: int):
    seeds = mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _slices(batches, ("doc_id", "th")):
            identity, sizes, sketches, rows, counts = [], [], [], [np.empty((0, DEPTH), np.uint64)], [0]
            for text, tokens in zip(texts, shingle_sets([t or b"" for t in texts]), strict=True):
                identity.append(_identity(tokens, text))
                sizes.append(len(tokens))
                sketches.append(sketch(tokens).tobytes())
                rows.append(chains(tokens, seeds) if len(tokens) else rows[0])
                counts.append(len(rows[-1]))
            flat = np.concatenate(rows).view(np.int64)
            struct = pa.StructArray.from_arrays([pa.array(flat[:, d].copy()) for d in range(DEPTH)], [f"p{d}" for d in range(DEPTH)])
            first = [pa.array(c, pa.int64()) for c in (*zip(*keys, strict=True), *zip(*identity, strict=True), sizes)]
            yield pa.RecordBatch.from_arrays(
                [*first, pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), struct)],
                ["doc_id", "th", "h1", "h2", "size", "sketch", "chains"],
            )

    return run


def _grouped(batches: Iterator[pa.RecordBatch], keys: int, room: int = 4096) -> Iterator[pa.Table]:
    """Tables of whole groups: rows come sorted by the first ``keys`` columns, and a group never spans two tables."""
    held: list[pa.RecordBatch] = []
    n = 0

    def cut(final: bool) -> tuple[pa.Table | None, list]:
        table = pa.Table.from_batches(held).combine_chunks()
        if final:
            return table, []
        k = np.column_stack([table.column(c).to_numpy() for c in range(keys)])
        whole = int(np.flatnonzero((k[1:] != k[:-1]).any(1))[-1]) + 1 if (k[1:] != k[:-1]).any() else 0
        return (table.slice(0, whole) if whole else None), table.slice(whole).to_batches()

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= room:
            table, held = cut(False)
            n = sum(b.num_rows for b in held)
            if table is not None:
                yield table
    if n:
        yield cut(True)[0]


def _bounds(table: pa.Table, keys: int) -> np.ndarray:
    k = np.column_stack([table.column(c).to_numpy() for c in range(keys)])
    return np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, [len(k)]])


def _elsewhere(paths: list[np.ndarray], path: int) -> np.ndarray:
    """Whether two sets of a bucket share a bucket of a lesser path."""
    n = len(paths)
    who = np.repeat(np.arange(n), [len(p) for p in paths])
    flat = np.concatenate(paths)
    low = flat < path
    values, inverse, counts = np.unique(flat[low], return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    column = np.cumsum(counts > 1) - 1
    member = np.zeros((n, int((counts > 1).sum())), np.float32)
    member[who[low][shared], column[inverse[shared]]] = 1
    return member @ member.T > 0


def _owned(path: int, bi: int, bj: int, block: np.ndarray, size: np.ndarray, paths: list[np.ndarray]) -> np.ndarray:
    """Pairs (i < j, as a matrix) that this task compares: of fitting sizes, one of each block, met at no lesser path."""
    small, large = np.minimum(size[:, None], size[None, :]), np.maximum(size[:, None], size[None, :])
    pairs = np.triu(small * DEN >= large * NUM, 1)
    if bi != bj:
        pairs &= block[:, None] != block[None, :]
    if pairs.any():
        pairs &= ~_elsewhere(paths, path)
    return pairs


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, bi, bj, rep) of the sets that have a likely partner of their own in this task."""
    for table in _grouped(batches, 3):
        bounds = _bounds(table, 3)
        path, bi, bj, rep, block, size = (table[c].to_numpy() for c in ("path", "bi", "bj", "rep", "block", "size"))
        sk = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, BINS)
        flat, off = table["paths"].combine_chunks().flatten().to_numpy(), np.concatenate([[0], np.cumsum(table["n_paths"].to_numpy())])
        keep = np.zeros(len(rep), bool)
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if e - s < 2:
                continue
            if e - s == 2 and (min(size[s:e]) * DEN < max(size[s:e]) * NUM or ((sk[s] == sk[s + 1]) & (sk[s] > 0)).sum() < LIKELY * max(1, ((sk[s] > 0) | (sk[s + 1] > 0)).sum()) and min(size[s:e]) >= BINS):
                continue
            a = sk[s:e]
            same, used = np.zeros((e - s, e - s), np.int16), np.zeros((e - s, e - s), np.int16)
            for k in range(BINS):
                some = a[:, k] > 0
                same += (a[:, k][:, None] == a[:, k][None, :]) & some[:, None]
                used += some[:, None] | some[None, :]
            near = (same >= LIKELY * used) | (np.minimum(size[s:e, None], size[None, s:e]) < BINS)
            near = np.triu(near, 1)
            if near.any():
                near &= _owned(path[s], bi[s], bj[s], block[s:e], size[s:e], [flat[off[r] : off[r + 1]] for r in range(s, e)])
                keep[s:e] = near.any(0) | near.any(1)
        at = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays([pa.array(c[at]) for c in (path, bi, bj, rep, block)], ["path", "bi", "bj", "rep", "block"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, links): link counts where a = b, edges of a spanning forest elsewhere."""
    for table in _grouped(batches, 3, 1024):
        bounds = _bounds(table, 3)
        path, bi, bj, rep, block, n_docs = (table[c].to_numpy() for c in ("path", "bi", "bj", "rep", "block", "n_docs"))
        paths, sets = table["paths"].to_pylist(), table["tokens"]
        out: list[tuple[np.ndarray, ...]] = []
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if e - s < 2:
                continue
            tokens = [np.frombuffer(sets[r].as_py(), "<u8") for r in range(s, e)]
            size = np.array([len(t) for t in tokens])
            pairs = _owned(path[s], bi[s], bj[s], block[s:e], size, [np.array(paths[r], np.int64) for r in range(s, e)])
            if not pairs.any():
                continue
            _, inverse, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
            who = np.repeat(np.arange(e - s), size)
            shared = counts[inverse] > 1
            column, who = (np.cumsum(counts > 1) - 1)[inverse[shared]], who[shared]
            common = np.zeros((e - s, e - s), np.float32)
            order = np.argsort(column, kind="stable")
            column, who = column[order], who[order]
            for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
                f, t = np.searchsorted(column, [lo, lo + 4096])
                has = np.zeros((e - s, 4096), np.float32)
                has[who[f:t], column[f:t] - lo] = 1
                common += has @ has.T
            common = common.astype(np.int64)
            union = size[:, None] + size[None, :] - common
            i, j = np.nonzero(pairs & (common * DEN >= union * NUM))
            links = np.bincount(i, n_docs[s + j], e - s) + np.bincount(j, n_docs[s + i], e - s)
            nodes, roots = local_forest(e - s, i, j)
            some = np.flatnonzero(links)
            out.append((rep[s + some], rep[s + some], links[some].astype(np.int64)))
            out.append((rep[s + nodes], rep[s + roots], np.zeros(len(nodes), np.int64)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)], ["a", "b", "links"])


def _field(name: str):
    return lambda chain: chain[name]


def _grown(here: str, under: str):
    """Chains that pass one of the row's ``parents`` at one depth and go on to the next."""
    return lambda chain: F.array_contains("parents", chain[here]) & (chain[under] != 0)


def _buckets(classes: DataFrame) -> DataFrame:
    """(path, n, rep) of the sets in every bucket of at least two: the least depth with at most LIMIT, or the deepest."""
    out = None
    level = classes.select("rep", F.explode(F.array_distinct(F.transform("chains", _field("p0")))).alias("path"))
    for d in range(DEPTH):
        counts = checkpointed(level.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        members = checkpointed(by_class(level, counts, ["path"], "n", "inner").select("path", "n", "rep"))
        done = members if d == DEPTH - 1 else members.where(F.col("n") <= LIMIT)
        out = done if out is None else out.unionByName(done)
        if d < DEPTH - 1:
            large = members.where(F.col("n") > LIMIT).select(F.col("path").alias("parent"), F.col("rep").alias("rep"))
            of = classes.select("rep", "chains").join(large.groupBy("rep").agg(F.collect_set("parent").alias("parents")), "rep")
            here, under = f"p{d}", f"p{d + 1}"
            below = F.filter("chains", _grown(here, under))
            level = of.select("rep", F.explode(F.array_distinct(F.transform(below, _field(under)))).alias("path"))
    return out


def _tasks(members: DataFrame) -> DataFrame:
    """Each set of a bucket once for every task (path, bi <= bj) that compares its block with another or itself."""
    blocks = F.ceil(F.col("n") / F.lit(BLOCK))
    placed = members.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("long"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long")))
    placed = placed.withColumn("other", other)
    return placed.select("path", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "rep")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th, text): th tells rows of one id apart by their texts."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _few(ids: DataFrame) -> DataFrame:
    """ids, broadcast in joins up to BROADCAST_IDS rows of a few longs, else shuffled."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def grouped(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """One row a row of ``docs``: doc_id, th (a hash of the text), class_id, n_links, group_id and head.

    ``head`` is the (doc_id, th) of the group's least row; null without a group.  See ``near_duplicates``.
    """
    spark = docs.sparkSession
    sweep(spark)
    texts = _texts(docs, id_col, text_col)
    paths = ", ".join(f"p{d}: bigint" for d in range(DEPTH))
    schema = f"doc_id long, th long, h1 long, h2 long, size long, sketch binary, chains array<struct<{paths}>>"
    signed = checkpointed(texts.mapInArrow(trimmed(_signatures(runs_for(recall))), schema))
    # a class is named by a number of its own, as rows of one id may be in several; the checkpoint fixes the numbers
    classes = checkpointed(
        signed.where("h1 IS NOT NULL AND doc_id IS NOT NULL").groupBy("h1", "h2").agg(
            F.min(F.struct("doc_id", "th")).alias("head"), F.count(F.lit(1)).alias("n_docs"), F.first("size").alias("size"),
            F.first("sketch").alias("sketch"), F.first("chains").alias("chains"),
        ).withColumn("rep", F.monotonically_increasing_id())
    )
    sweep(spark)
    members = checkpointed(_buckets(classes))
    sweep(spark)
    paths_of = members.groupBy("rep").agg(F.sort_array(F.collect_set("path")).alias("paths"))
    facts = classes.select("rep", "head", "size", "n_docs", "sketch").join(paths_of, "rep").withColumn("n_paths", F.size("paths").cast("long"))
    facts = checkpointed(facts)
    key = ["path", "bi", "bj"]
    n_tasks = partitions_for(members.count(), 20_000, spark)
    first_pass = _tasks(members).join(facts.drop("n_docs", "head"), "rep").select(*key, "rep", "block", "size", "sketch", "paths", "n_paths")
    dealt = first_pass.repartition(n_tasks, *key).sortWithinPartitions(*key, "rep")
    likely = checkpointed(dealt.mapInArrow(trimmed(_likely), "path long, bi long, bj long, rep long, block long"))
    del first_pass, dealt
    sweep(spark)

    needed = checkpointed(likely.select("rep").distinct().join(facts.select("rep", "head.*"), "rep"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, part in _slices(batches, ("rep",)):
            sets = shingle_sets([t or b"" for t in part])
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([t.astype("<u8").tobytes() for t in sets], pa.binary())], ["rep", "tokens"])

    # rows that repeat id and text have the same tokens
    sets = texts.join(_few(needed), ["doc_id", "th"]).select("rep", "text").mapInArrow(trimmed(whole), "rep long, tokens binary").dropDuplicates(["rep"])
    second_pass = (
        likely.join(facts.select("rep", "n_docs", "paths"), "rep").join(sets, "rep")
        .select(*key, "rep", "block", "n_docs", "paths", "tokens")
    )
    n_tasks = partitions_for(likely.count(), 4_000, spark)
    dealt = second_pass.repartition(n_tasks, *key).sortWithinPartitions(*key, "rep")
    found = checkpointed(dealt.mapInArrow(trimmed(_verify), "a long, b long, links long"))
    del sets, second_pass, dealt
    sweep(spark)

    counts = found.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    group = components(found.where("a <> b").select("a", "b")).withColumnRenamed("node", "rep")
    group = checkpointed(group.join(classes.select("rep", "head"), "rep"))
    heads = group.groupBy("component").agg(F.min("head").alias("group_head"), F.count(F.lit(1)).alias("n"))
    group = by_class(group.select("rep", "component"), heads, ["component"], "n").select("rep", "group_head")
    of_class = classes.select("h1", "h2", "rep", "n_docs", "head").join(counts, "rep", "left").join(group, "rep", "left")
    of_class = checkpointed(of_class.select(
        "h1", "h2", "n_docs", F.coalesce("links", F.lit(0)).alias("links"), F.col("head.doc_id").alias("class_id"), F.coalesce("group_head", "head").alias("head"),
    ))
    sweep(spark)
    keyed = signed.select("doc_id", "th", F.when(F.col("doc_id").isNotNull(), F.col("h1")).alias("h1"), "h2")
    return by_class(keyed, of_class, ["h1", "h2"], "n_docs").select(
        "doc_id", "th", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("links") + F.col("n_docs") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("head.doc_id"), "doc_id").alias("group_id"), "head",
    )


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """One row a row of ``docs``: doc_id, class_id, n_links, group_id, kept.

    ``class_id`` is the least id with the same shingles, ``n_links`` the number of other rows with a Jaccard similarity
    of at least the threshold, ``group_id`` the least id reachable by links, ``kept`` whether it is its own.  Texts of
    fewer than five words have one shingle of them all.  Equal texts without words are linked copies; null texts have no
    links.  Rows that repeat an id are rows of their own: linked if their texts are near.  Rows without an id link with
    nothing and are kept.  An empty table gives an empty result; other columns are not read.
    """
    rows = grouped(docs, id_col=id_col, text_col=text_col, recall=recall)
    return rows.select("doc_id", "class_id", "n_links", "group_id", F.col("doc_id").eqNullSafe(F.col("group_id")).alias("kept"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, all columns kept.

    That is the row of the least id, of several texts of that id the one of the least hash, of rows that repeat both
    one by the other columns.  Null texts and rows without an id all stay; an empty table gives an empty result.
    """
    rows = grouped(docs)
    own = F.struct("doc_id", "th")
    fate = checkpointed(rows.where("head IS NOT NULL").groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n"), F.first("head").alias("head")).where((F.col("head") != own) | (F.col("n") > 1)))
    fate = fate.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), (F.col("head") != own).alias("__gone"))
    marked = docs.withColumn("__row", F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th")))
    same = (F.col("__row.id") == F.col("__id")) & (F.col("__row.th") == F.col("__th"))
    kept = marked.join(_few(fate), same, "left_anti").select(*docs.columns)
    repeated = fate.where("NOT __gone")
    if not repeated.take(1):
        return kept
    others = F.to_json(F.struct(*[F.col(c) for c in docs.columns if c not in ("doc_id", "text")])) if len(docs.columns) > 2 else F.lit("")
    again = marked.join(_few(repeated), same, "left_semi").withColumn("__others", others)
    again = again.withColumn("__n", F.row_number().over(Window.partitionBy("__row.id", "__row.th").orderBy("__others"))).where("__n = 1")
    return kept.unionByName(again.select(*docs.columns))

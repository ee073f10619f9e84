"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with a cosine of at least ``threshold`` lie within epsilon of each other, so their coordinates on any
orthonormal axes differ by at most one cell of an epsilon grid.  Vectors are sorted by their grid cells on the leading
principal axes, within each label.  The sequence is cut into blocks; block pairs whose cells are provably distant are
never formed, and a pair of blocks is joined by recursive halving of the two sequences, skipping distant intervals,
down to small leaves that are compared outright in double precision.

Equal vectors are one class from the start.  A block pair reports link counts and a spanning forest, never its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_class, checkpointed, partitions_for
from .components import components, local_forest

THRESHOLD = 0.93
AXES = 6
PCA_SAMPLE = 4096  # vectors, the lowest by a hash of their least id
BLOCK = 1024
LEAF = 128


def usable(vector: Column) -> Column:
    """Not null, not zero, no null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(1, keepdims=True)  # no overflow or underflow in the norm
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal axes for each dimension of vectors, from a bounded sample; they only steer the order."""
    rows = classes.orderBy(F.xxhash64(F.lit(9), "least"), "least", "h1").limit(PCA_SAMPLE).select("vector").collect()
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r.vector), []).append(r.vector)
    out = {}
    for dim, vs in by_dim.items():
        x = unit_rows(np.array(vs, float))
        _, axes = np.linalg.eigh(np.cov(x.T, bias=True).reshape(dim, dim))
        out[dim] = axes[:, ::-1][:, :AXES]
    return out


def _join(a: np.ndarray, b: np.ndarray, ca: np.ndarray, cb: np.ndarray, same: bool, threshold: float, hits: list, oa: int = 0, ob: int = 0) -> None:
    """Links between two sequences of unit vectors with grid cells ca and cb; positions from oa and ob go to hits."""
    if (ca.min(0) - 1 > cb.max(0)).any() or (cb.min(0) - 1 > ca.max(0)).any():
        return
    if max(len(a), len(b)) <= LEAF:
        i, j = np.nonzero(a @ b.T >= threshold)
        if same:
            i, j = i[i < j], j[i < j]
        hits.append((i + oa, j + ob))
        return
    ha, hb = (len(a) + 1) // 2, (len(b) + 1) // 2
    parts_a = [(0, ha), (ha, len(a))] if len(a) > LEAF else [(0, len(a))]
    parts_b = [(0, hb), (hb, len(b))] if len(b) > LEAF else [(0, len(b))]
    for p, (s, e) in enumerate(parts_a):
        for q, (t, f) in enumerate(parts_b):
            if not same or q >= p:
                _join(a[s:e], b[t:f], ca[s:e], cb[t:f], same and p == q, threshold, hits, oa + s, ob + t)


def _pair(row: dict, threshold: float) -> tuple[np.ndarray, ...]:
    """(reps, links counted, forest nodes, their roots) of one pair of blocks."""
    sides = []
    for side in ("a", "b"):
        n, dim = row[f"{side}_n"], row["dim"]
        sides.append((
            np.frombuffer(row[f"{side}_reps"], "<i8"), np.frombuffer(row[f"{side}_sizes"], "<i8"),
            np.frombuffer(row[f"{side}_cells"], "<i8").reshape(n, -1), np.frombuffer(row[f"{side}_units"], "<f8").reshape(n, dim),
        ))
    (ra, wa, ca, xa), (rb, wb, cb, xb) = sides
    same = row["a_block"] == row["b_block"]
    hits: list = []
    _join(xa, xb, ca, cb, same, threshold, hits)
    i = np.concatenate([h[0] for h in hits]) if hits else np.empty(0, int)
    j = np.concatenate([h[1] for h in hits]) if hits else np.empty(0, int)
    if not same:
        j = j + len(ra)
    reps, sizes = (ra, wa) if same else (np.concatenate([ra, rb]), np.concatenate([wa, wb]))
    links = np.bincount(i, sizes[j], len(reps)) + np.bincount(j, sizes[i], len(reps))
    nodes, roots = local_forest(len(reps), i, j)
    return reps, links.astype(np.int64), reps[nodes], reps[roots]


def link_vectors(
    rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    Links join vectors of equal, non-null label and equal dimension with a cosine of at least the threshold, in double
    precision.  Vectors that are null, zero or hold null or non-finite components, and rows without a label, have no
    links and are components of their own.  Rows that repeat a vector are linked with each other.  Rows that repeat an
    id with other vectors or labels are vectors of their own.  A null id takes no part, and is kept.  An empty table
    gives an empty result; other columns are not read.
    """
    spark = rows.sparkSession
    v = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    active = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = v.withColumn("h1", F.when(active, F.xxhash64("vector"))).withColumn("h2", F.when(active, F.xxhash64(F.lit(9), "vector")))
    keyed = keyed.withColumn("active", active)
    classes = checkpointed(
        keyed.where("active").groupBy("label", "h1", "h2")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"), F.first("vector").alias("vector"))
        .withColumn("rep", F.monotonically_increasing_id())
    )
    # a class is named by a number of its own, as rows of one id may be in several; the checkpoint fixes the numbers
    axes = principal_axes(classes)
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold))) * (1 + 1e-9) + 1e-12
    cell_names = [f"c{k}" for k in range(AXES)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch["vector"].to_pylist()
            units, cells = [], []
            for vector in vectors:
                u = unit_rows(np.array([vector], float))[0]
                c = np.zeros(AXES, np.int64)
                if (a := axes.get(len(vector))) is not None:
                    c[: a.shape[1]] = np.floor(u @ a / eps)
                units.append(u.astype("<f8").tobytes())
                cells.append(c)
            cells = np.array(cells, np.int64).reshape(len(vectors), AXES)
            yield pa.RecordBatch.from_arrays(
                [batch["label"], pa.array([len(x) for x in vectors], pa.int64()), batch["rep"], batch["size"], pa.array(units, pa.binary())]
                + [pa.array(cells[:, k]) for k in range(AXES)],
                ["label", "dim", "rep", "size", "unit", *cell_names],
            )

    label_type = v.schema["label"].dataType.simpleString()
    schema = f"label {label_type}, dim long, rep long, size long, unit binary, " + ", ".join(f"{c} long" for c in cell_names)
    placed = classes.select("label", "rep", "size", "vector").mapInArrow(place, schema)
    n_classes = classes.count()
    # the global epsilon grid order, cut into ranges; a range never splits the order, so blocks are its intervals
    order = ["label", "dim", *cell_names, "rep"]
    ordered = placed.repartitionByRange(partitions_for(n_classes, 8 * block, spark), *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def packed() -> pa.RecordBatch:
            cells = np.array([r[5:] for r in held], np.int64)
            raw = [held[0][0], held[0][1], held[0][2], len(held)]
            raw += [np.array([r[k] for r in held], "<i8").tobytes() for k in (2, 3)]
            raw += [cells.astype("<i8").tobytes(), b"".join(r[4] for r in held), cells.min(0).tolist(), cells.max(0).tolist()]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(raw, fields, strict=True)], schema=pa.schema(fields))

        label_field = None
        for batch in batches:
            label_field = label_field or pa.field("label", batch.schema.field("label").type)
            fields = [
                label_field, pa.field("dim", pa.int64()), pa.field("block", pa.int64()), pa.field("n", pa.int64()), pa.field("reps", pa.binary()),
                pa.field("sizes", pa.binary()), pa.field("cells", pa.binary()), pa.field("units", pa.binary()),
                pa.field("lo", pa.list_(pa.int64())), pa.field("hi", pa.list_(pa.int64())),
            ]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) >= block or row[:2] != held[0][:2]):
                    yield packed()
                    held = []
                held.append(row)
        if held:
            yield packed()

    # a block is named by its first class, which no other block holds
    blocks = checkpointed(
        ordered.mapInArrow(
            pack, f"label {label_type}, dim long, block long, n long, reps binary, sizes binary, cells binary, units binary, lo array<long>, hi array<long>"
        )
    )
    boxes = blocks.select("label", "dim", "block", "lo", "hi")
    first = lambda c: F.element_at(c, 1)
    # blocks meet on equal label and first cell; a pair of boxes reports at the first cell that both reach
    left = boxes.select("label", "dim", F.col("block").alias("a_block"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"), F.explode(F.sequence(first("lo") - 1, first("hi") + 1)).alias("at"))
    right = boxes.select("label", "dim", F.col("block").alias("b_block"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"), F.explode(F.sequence(first("lo"), first("hi"))).alias("at"))
    close = (F.col("a_block") <= F.col("b_block")) & (F.col("at") == F.greatest(first(F.col("a_lo")) - 1, first(F.col("b_lo"))))
    for k in range(1, AXES + 1):
        lo, hi = (lambda c, k=k: F.element_at(c, k)), (lambda c, k=k: F.element_at(c, k))
        close = close & (lo(F.col("a_lo")) - 1 <= hi(F.col("b_hi"))) & (lo(F.col("b_lo")) - 1 <= hi(F.col("a_hi")))
    pairs = left.join(right, ["label", "dim", "at"]).where(close).select("dim", "a_block", "b_block")
    side = lambda s: blocks.select(F.col("block").alias(f"{s}_block"), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "reps", "sizes", "cells", "units")])
    n_pairs = partitions_for(n_classes, 2 * block, spark)
    tasks = pairs.repartition(n_pairs, "a_block", "b_block").join(side("a"), "a_block").join(side("b"), "b_block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                reps, links, nodes, roots = _pair(batch.slice(k, 1).to_pylist()[0], threshold)
                some = links > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([reps[some], nodes])),
                        pa.array(np.concatenate([reps[some], roots])),
                        pa.array(np.concatenate([links[some], np.zeros(len(nodes), np.int64)])),
                    ],
                    ["a", "b", "links"],
                )

    found = checkpointed(tasks.mapInArrow(compare, "a long, b long, links long"))
    counts = found.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    group = components(found.where("a <> b").select("a", "b")).withColumnRenamed("node", "rep")
    group = checkpointed(group.join(classes.select("rep", "least"), "rep"))
    heads = group.groupBy("component").agg(F.min("least").alias("head"), F.count(F.lit(1)).alias("n"))
    group = by_class(group.select("rep", "component"), heads, ["component"], "n").select("rep", "head")
    of_class = classes.select("label", "h1", "h2", "rep", "size", "least").join(counts, "rep", "left").join(group, "rep", "left")
    of_class = checkpointed(of_class.select("label", "h1", "h2", "size", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("head", "least").alias("head")))
    joined = by_class(keyed.select("vec_id", "label", "h1", "h2"), of_class, ["label", "h1", "h2"], "size")
    own = F.coalesce("head", "vec_id")
    return joined.select(
        "vec_id", F.coalesce(F.col("links") + F.col("size") - 1, F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"),
    )

"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target of words: a share of ``budget`` times all words in proportion to its weight, capped at
``max_copies`` times the source's own words, the excess reshared by weight over the sources below their caps.  A
document of a source is to be taken ``target / source_size`` times in expectation.  The whole part is fixed; the
fractional parts are rounded by pivotal rounding with the sizes as weights: two documents of a source trade expected
words until one's fraction is 0 or 1, which keeps the source's expected words exactly.  A trade draws its direction
from a hash of the documents' ids, so that reruns agree.

The rounding runs as a reduction tree.  Documents are dealt by a hash of their id over leaves of about ``leaf_rows``
documents of one source; a leaf leaves at most one undecided document, ``fan_in`` nodes of a level meet in one node of
the next, and the root rounds what remains at random.  So a source with a third of all rows is many leaves, no task
sees more than a leaf or ``fan_in`` residuals, and a source misses its target by less than one document's size.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, checkpointed

WEIGHTS = (3.0, 1.0, 2.0)
WORD = r"[^\x20\x09-\x0D]+"
EPS = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """(source, source_size, n_docs, target) for rows (source, size): one row a source, null a source of its own.

    Sources by code point, null last, get the weights in turn.  Water filling: sorted by cap / weight, the capped
    sources are a prefix, and the level over the rest is (total - their caps) / (remaining weight).
    """
    per_source = sizes.groupBy("source").agg(
        F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    ordered = per_source.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary")))
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    capped = ordered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        capped.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(budget)))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("caps_before")) / F.col("weight_left"))
        .withColumn("below", F.col("level") * F.col("weight") < F.col("cap"))
    )
    # the level stands at the first source, by ratio, that it does not fill
    first = F.min(F.when(F.col("below"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "rank", "level"))).over(everything)["level"]
    return levels.withColumn("final_level", first).select(
        "source", "source_size", "n_docs",
        F.least(F.col("cap"), F.coalesce(F.col("final_level") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def _trade(table: pa.Table, root: bool) -> pa.Table:
    """Pivotal rounding of one node: settles all rows but at most one, and at the root that one as well.

    Rows come with ``size`` > 0, a fraction ``p`` in (0, 1), the draw ``u`` and the order ``o``.
    """
    rows = table.sort_by([("o", "ascending"), ("doc_id", "ascending")])
    size, p, u = rows["size"].to_pylist(), rows["p"].to_pylist(), rows["u"].to_pylist()
    open_at = -1
    for j in range(len(p)):
        if open_at < 0:
            open_at = j
            continue
        i = open_at
        ratio = size[i] / size[j]
        up = min(1 - p[i], p[j] / ratio)  # what i may gain at j's cost
        down = min(p[i], (1 - p[j]) / ratio)  # what i may lose to j
        if u[j] * (up + down) < down:
            p[i], p[j] = p[i] + up, p[j] - up * ratio
        else:
            p[i], p[j] = p[i] - down, p[j] + down * ratio
        for k in (i, j):
            p[k] = 0.0 if p[k] < EPS else 1.0 if p[k] > 1 - EPS else p[k]
        open_at = next((k for k in (i, j) if 0 < p[k] < 1), -1)
    if root and open_at >= 0:
        # a draw of its own: u has served in a trade already
        p[open_at] = float((u[open_at] * 7919.0) % 1.0 < p[open_at])
    return rows.set_column(rows.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))


def _settler(root: bool):
    return lambda table: _trade(table, root)


def mix(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, budget: float = 1.5, max_copies: float = 2.0, leaf_rows: int = 4096, fan_in: int = 64, seed: int = 17,
) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, copies, taken, and h, a hash of id and text.

    Null text has size 0.  Documents of size 0 are taken with the whole part of their expectation and add no words.
    Rows that repeat a doc_id are documents of their own; rows that agree in id and text get interchangeable results.
    An empty table gives an empty result.  Other columns are not read, so their names can't clash.
    """
    sizes = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("h"),
    )
    sizes = checkpointed(sizes)
    targets = checkpointed(source_targets(sizes, weights, budget, max_copies))
    # one row a source: bounded by the number of sources, and Spark's own threshold decides on a broadcast
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = (
        sizes.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        .withColumn("expected", expected)
        .withColumn("whole", F.floor(F.col("expected") + EPS))
        .withColumn("p", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
        .withColumn("leaves", F.ceil(F.col("n_docs") / F.lit(leaf_rows)))
        .withColumn("node", F.pmod(F.xxhash64(F.lit(seed + 1), "h"), F.col("leaves")))
        .withColumn("u", F.pmod(F.xxhash64(F.lit(seed + 2), "h"), F.lit(1 << 52)) / F.lit(float(1 << 52)))
        .withColumn("o", F.xxhash64(F.lit(seed + 3), "h"))
        .select("doc_id", "h", "source", "size", "source_size", "target", "whole", "p", "u", "o", "node")
    )
    free = (F.col("p") > EPS) & (F.col("size") > 0)
    schema = joined.schema

    settled = [joined.where(~free).withColumn("p", F.lit(0.0))]
    nodes = joined.where(free)
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    width = -(-most // leaf_rows)  # nodes of the largest source at this level
    while most:
        root = width <= 1

        level = checkpointed(nodes.groupBy("source", "node").applyInArrow(_settler(root), schema))
        open_rows = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(level.where(~open_rows))
        if root:
            break
        nodes = level.where(open_rows).withColumn("node", F.floor(F.col("node") / F.lit(fan_in)))
        width = -(-width // fan_in)
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    copies = (F.col("whole") + F.round("p")).cast("int")
    return out.select(
        "doc_id", "size", "source_size", "target", "h", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: the documents' rows, each as often as the mix takes it, with the columns of ``docs``.

    Documents are told apart by (doc_id, text); rows that agree in both get the same treatment on average.
    """
    seed, id_col, text_col = kw.get("seed", 17), kw.get("id_col", "doc_id"), kw.get("text_col", "text")
    decided = checkpointed(mix(docs, **kw).select(F.col("h").alias("__mix_h"), F.col("copies").alias("__copies")))
    of_row = docs.withColumn("__h", F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)))
    repeated = checkpointed(decided.groupBy("__mix_h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__mix_h"))
    same = F.col("__h") == F.col("__mix_h")
    if not repeated.take(1):  # ids that are unique, as they should be: whole texts go through one shuffle
        joined = of_row.join(decided.where("__copies > 0"), same)
    else:
        # rows that repeat id and text are numbered, and the n-th gets the n-th decision
        few = F.broadcast(repeated) if repeated.count() <= BROADCAST_IDS else repeated
        single = of_row.join(few, same, "left_anti").join(decided.join(few, "__mix_h", "left_anti").where("__copies > 0"), same)
        rows = of_row.join(few, same, "left_semi").withColumn("__n", F.row_number().over(Window.partitionBy("__h").orderBy("__h")))
        again = decided.join(few, "__mix_h", "left_semi")
        again = again.withColumn("__m", F.row_number().over(Window.partitionBy("__mix_h").orderBy(F.desc("__copies"))))
        joined = single.unionByName(rows.join(again.where("__copies > 0"), same & (F.col("__n") == F.col("__m"))), allowMissingColumns=True)
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)

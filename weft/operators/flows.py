"""From flows to keyed, prorated rows: one row for every window that a flow overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import UNKNOWN_APPLICATION
from ..functions.windows import node_shift, start_of_number, window_number
from ..options import Options
from ..schema import CONVERSATION, INTERFACE, WINDOW


BLOCK = 64  # windows
SHARE = 1 << 18  # bytes of flows, as Spark estimates them, for a task that makes all copies and sums of its flows
MOST_TASKS = 20_000
NO_SIZE = 1 << 60  # Spark says about 1 << 63 for what it knows no size of
_MARK, _NONE = "\x1f", "\x1e"  # of packed texts: before each, and for a null; a text's own are written as _NONE and a digit


def shares(flows: DataFrame) -> int | None:
    """How many tasks share the flows so that sums and rankings stay in memory, or None if their size is not known."""
    at = int(flows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) if hasattr(flows, "_jdf") else NO_SIZE
    return None if at >= NO_SIZE else max(min(-(-at // SHARE), MOST_TASKS), flows.sparkSession.sparkContext.defaultParallelism)


def _placed(options: Options) -> dict[str, Column]:
    """The shift of a flow's node and the numbers of its first and last window."""
    w = options.window_ms
    start, end = F.col("delta_switched"), F.col("last_switched")
    shift = node_shift(F.col("node_id"), w)
    # the copy i of a flow stands at start + i * w, and must be later than end - max_flow_ms
    too_far = end - options.max_flow_ms - start
    skipped = F.when(too_far < 0, F.lit(0).cast("bigint")).otherwise(F.call_function("div", too_far, F.lit(w).cast("bigint")) + 1)
    first, last = window_number(start, shift, w), window_number(end, shift, w)
    # the last copy stands at the flow's end and is never too far back
    return {"__shift": shift, "__from": first, "__first": F.least(first + skipped, last), "__last": last}


def _lasting(flows: DataFrame, options: Options) -> DataFrame:
    """Flows that have windows, with their place."""
    start, end = F.col("delta_switched"), F.col("last_switched")
    rows = flows.where(start.isNotNull() & end.isNotNull() & (start >= node_shift(F.col("node_id"), options.window_ms)))
    return rows.withColumns(_placed(options)).where(F.col("__last") >= F.col("__from")).drop("__from")


def blocks(flows: DataFrame, options: Options) -> DataFrame:
    """Flows once for every block of BLOCK windows they overlap, ``block``."""
    of = lambda c: F.call_function("div", F.col(c), F.lit(BLOCK).cast("bigint"))
    rows = _lasting(flows, options).withColumn("block", F.explode(F.sequence(of("__first"), of("__last"))))
    return rows.drop("__shift", "__first", "__last")


def dealt(flows: DataFrame, options: Options, keys: tuple[str, ...]) -> DataFrame:
    """Flows once for every block they overlap, dealt over partitions by these columns and the block.

    Sums by those keys and the window then need no further exchange once the flows are copied to their windows, so what
    is shuffled is flows and not their many copies.  The blocks split a key that has very many flows.
    """
    return blocks(flows, options).repartition(*keys, "block")


def copies(flows: DataFrame, options: Options) -> DataFrame:
    """Flows once for every window they overlap, or every window of their ``block`` if they have one."""
    w, low, high = options.window_ms, F.col("__first"), F.col("__last")
    if "block" in flows.columns:
        low, high = F.greatest(low, F.col("block") * BLOCK), F.least(high, F.col("block") * BLOCK + (BLOCK - 1))
        rows = flows.withColumns(_placed(options)).drop("__from")
    else:
        rows = _lasting(flows, options)
    return (
        rows.withColumn("__wn", F.explode(F.sequence(low, high)))
        .withColumn("range_start", start_of_number(F.col("__wn"), F.col("__shift"), w))
        .withColumn("range_end", F.col("range_start") + w)
        .drop("__shift", "__wn", "__first", "__last")
    )


def dispatch(flows: DataFrame, options: Options = Options(), co_locate: tuple[str, ...] = ()) -> DataFrame:  # noqa: B008
    """Each flow once for every window of its node that it overlaps, with range_start and range_end.

    Flows that start before the node's first window are dropped.  A copy further back than ``max_flow_ms`` from the
    flow's end is dropped as well: the sequence starts behind those, so a flow of any length makes a bounded number of
    rows.  A flow that ends in a window before the one it starts in gives none.

    With ``co_locate`` flows are dealt by these columns and ``block`` before the copies are made.
    """
    return copies(dealt(flows, options, co_locate) if co_locate else flows, options)


def prorate(dispatched: DataFrame) -> DataFrame:
    """Adds ``bytes``: the flow's bytes, times its sampling interval if positive, that fall into the window.

    The difference of two truncated running totals, so a flow's windows sum to its truncated total.
    """
    start, end = F.col("delta_switched"), F.col("last_switched")
    sampled = F.col("sampling_interval") > 0
    total = F.col("num_bytes").cast("double") * F.when(sampled, F.col("sampling_interval")).otherwise(F.lit(1.0))
    duration = (end - start + 1).cast("double")
    upto = lambda ms: F.try_divide(ms * total, duration).cast("bigint")
    from_ms = F.greatest(start, F.col("range_start")) - start
    to_ms = F.least(end, F.col("range_end") - 1) - start + 1
    return dispatched.withColumn("bytes", upto(to_ms) - upto(from_ms))


def conversation_keys(flows: DataFrame) -> DataFrame:
    """Flows with their conversation's key, host names in the order of its addresses, and flags; none without exporter."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    ordered = text("src_address") < text("dst_address")
    both = F.coalesce((F.col("foreign_source") != "") & (F.col("foreign_id") != ""), F.lit(False))
    return flows.where(F.col("node_id").isNotNull()).withColumns({
        "foreign_source": F.when(both, F.col("foreign_source")), "foreign_id": F.when(both, F.col("foreign_id")),
        "if_index": F.coalesce("if_index", F.lit(0)), "dscp": F.coalesce("dscp", F.lit(0)), "location": text("location"),
        "address": F.when(ordered, text("src_address")).otherwise(text("dst_address")),
        "larger_address": F.when(ordered, text("dst_address")).otherwise(text("src_address")),
        "application": F.when(text("application") == "", F.lit(UNKNOWN_APPLICATION)).otherwise(F.col("application")),
        "ingress": F.coalesce(F.col("direction"), F.lit("INGRESS")) == "INGRESS",
        "hostname": F.when(ordered, F.col("src_hostname")).otherwise(F.col("dst_hostname")),
        "hostname2": F.when(ordered, F.col("dst_hostname")).otherwise(F.col("src_hostname")),
        "congestion": F.coalesce(F.col("ecn") == 3, F.lit(False)), "non_ect": F.coalesce("ecn", F.lit(0)) == 0,
    })


def _valued(rows: DataFrame, *more: str) -> DataFrame:
    """Prorated rows of flows with their keys as rows of values."""
    return rows.select(
        *WINDOW, *INTERFACE, "dscp", *CONVERSATION, F.when(F.col("ingress"), F.col("bytes")).otherwise(F.lit(0)).cast("bigint").alias("bytes_in"),
        F.when(F.col("ingress"), F.lit(0)).otherwise(F.col("bytes")).cast("bigint").alias("bytes_out"), "hostname", "hostname2", "congestion", "non_ect", *more,
    )


def keyed(prorated: DataFrame, *more: str) -> DataFrame:
    """Conversation keys with DSCP and the aggregated values of single rows; rows without an exporter are dropped."""
    return _valued(conversation_keys(prorated), *more)


def listed(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Adds ``names``, the sorted host names of all rows with these keys that are not empty, and the ``place`` of the row's own.

    The least name of any part of such rows is then that of the least place in the list, which is a number.
    """
    name = F.nullif(F.col("hostname"), F.lit(""))
    rows = rows.withColumn("names", F.array_sort(F.collect_set(name).over(Window.partitionBy(*keys))))
    return rows.withColumn("place", F.array_position("names", name))


def summed(rows: DataFrame, keys: tuple[str, ...], named: bool = True) -> DataFrame:
    """Bytes added, flags joined by or, host names the least that is not empty, or null unless ``named``.

    Without names the buffers are fixed in size, so Spark aggregates by hash; the least of texts takes a sort.  By hash
    go also rows with the list ``names``, a function of the keys, and the ``place`` of their name in it.
    """
    if "names" in rows.columns:
        out = rows.groupBy(*keys, "names").agg(
            F.sum("bytes_in").alias("bytes_in"), F.sum("bytes_out").alias("bytes_out"), F.min("place").alias("place"),
            F.bool_or("congestion").alias("congestion"), F.bool_or("non_ect").alias("non_ect"),
        )
        return unnamed(out).withColumn("hostname", F.get("names", F.col("place") - 1)).drop("names", "place")
    least = lambda c: F.min(F.nullif(F.col(c), F.lit(""))).alias(c)
    out = rows.groupBy(*keys).agg(
        F.sum("bytes_in").alias("bytes_in"), F.sum("bytes_out").alias("bytes_out"), *([least("hostname"), least("hostname2")] if named else []),
        F.bool_or("congestion").alias("congestion"), F.bool_or("non_ect").alias("non_ect"),
    )
    return out if named else unnamed(out)


def unnamed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.lit(None).cast("string") for c in ("hostname", "hostname2")})


def conversation_rows(flows: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """Prorated rows of conversations, with their block of windows: what all sums derive from.

    Flows go through one exchange, before they are copied to their windows; sums by conversation, with DSCP or without,
    are made where the rows are from there on.
    """
    return _valued(prorate(dispatch(conversation_keys(flows), options, co_locate=(*INTERFACE, *CONVERSATION))), "block")


def packed(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """These columns as one, ``packed``: a character for each boolean, then the others as texts, with a mark before each.

    Texts and small numbers take several words each in a row and compress badly between others: rows that are to be
    shuffled get smaller.  No lengths stand between texts, so texts that often follow each other compress as one.
    """
    kinds = dict(rows.dtypes)
    flags = [F.coalesce(F.col(c).cast("int").cast("string"), F.lit("-")) for c in columns if kinds[c] == "boolean"]
    plain = lambda c: F.replace(F.replace(F.col(c), F.lit(_NONE), F.lit(_NONE + "0")), F.lit(_MARK), F.lit(_NONE + "1"))
    text = lambda c: plain(c) if kinds[c] == "string" else F.col(c).cast("string")
    texts = [F.coalesce(text(c), F.lit(_NONE)) for c in columns if kinds[c] != "boolean"]
    return rows.withColumn("packed", F.concat_ws(_MARK, F.concat(F.lit(""), *flags), *texts)).drop(*columns)


def unpacked(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """The columns of ``packed`` again, in their order and of these types."""
    flags, others = [c for c, k in kinds.items() if k == "boolean"], [c for c, k in kinds.items() if k != "boolean"]
    columns: dict[str, Column] = {}
    for c, kind in kinds.items():
        if kind == "boolean":
            flag = F.substring("packed", flags.index(c) + 1, 1)
            columns[c] = F.when(flag != "-", flag == "1")
        else:
            text = F.nullif(F.substring_index(F.substring_index(F.col("packed"), _MARK, others.index(c) + 2), _MARK, -1), F.lit(_NONE))
            text = F.replace(F.replace(text, F.lit(_NONE + "1"), F.lit(_MARK)), F.lit(_NONE + "0"), F.lit(_NONE)) if kind == "string" else text
            columns[c] = text.cast(kind)
    return rows.withColumns(columns).drop("packed")


def turned(column: str, bits: int) -> Column:
    """The word with its bits turned left, the first ones to its end."""
    word = F.col(column).cast("bigint")
    return F.shiftleft(word, bits).bitwiseOR(F.shiftrightunsigned(word, 64 - bits))


def interface_flows(flows: DataFrame, options: Options, columns: tuple[str, ...]) -> DataFrame:
    """Flows with their conversation's key and their blocks of windows, all of an interface and block in one task.

    Whatever is summed and ranked within interfaces and windows then stays where it is.  Of texts and small numbers these
    columns go through the exchange, as one; the others are null.  Every other word is turned for the exchange, so that
    the bytes which differ from row to row stand beside those of the next word, and the rest compresses.
    """
    keys = conversation_keys(flows)
    kinds = {c: k for c, k in keys.dtypes if c in ("dscp", *CONVERSATION, "ingress", "hostname", "hostname2", "congestion", "non_ect")}
    rows = keys.select(*INTERFACE, "sampling_interval", "delta_switched", "last_switched", "num_bytes", *columns)
    rows = blocks(packed(rows, columns), options).select(*INTERFACE, "block", "sampling_interval", "delta_switched", "last_switched", "num_bytes", "packed")
    tasks, words = shares(keys), ("delta_switched", "num_bytes")
    rows = rows.withColumns({c: turned(c, 40) for c in words}).repartition(*([tasks] if tasks else []), *INTERFACE, "block")
    rows = unpacked(rows.withColumns({c: turned(c, 24) for c in words}), {c: kinds[c] for c in columns})
    return rows.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in columns})


def copied(rows: DataFrame, options: Options) -> DataFrame:
    """Prorated rows of ``interface_flows``, or of their ends."""
    more = [c for c in ("block", "marks", "names", "place") if c in rows.columns]
    return _valued(prorate(copies(rows, options)), *more)


def conversation_sums(flows: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """The finest sums, one row a window, interface, DSCP and conversation."""
    return summed(conversation_rows(flows, options), (*WINDOW, *INTERFACE, "dscp", *CONVERSATION, "block")).drop("block")

"""The eight groupings: totals for interfaces and DSCPs, top k below them for applications, hosts, conversations.

Groupings of one kind are worked out together: a conversation row becomes one row for each of them, marked with its
name, and one aggregation and one ranking serve them all.  So there are three branches (applications with the totals,
hosts, conversations).  Of flows that are at hand as a table all groupings are worked out by one branch, in the tasks
that the flows are dealt to by interface and windows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import grouped_by_key
from ..options import Options
from ..schema import CONVERSATION, INTERFACE, WINDOW
from .flows import copied, interface_flows, listed, summed, unnamed


@dataclass(frozen=True)
class Grouping:
    name: str
    keys: tuple[str, ...]  # beside the window
    dims: tuple[str, ...]
    parent: tuple[str, ...] | None  # of top-k groupings

    @property
    def total(self) -> bool:
        return self.parent is None


_TOS = (*INTERFACE, "dscp")
GROUPINGS = {
    g.name: g
    for g in (
        Grouping("EXPORTER_INTERFACE", INTERFACE, ("exporter", "interface"), None),
        Grouping("EXPORTER_INTERFACE_TOS", _TOS, ("exporter", "interface", "dscp"), None),
        Grouping("EXPORTER_INTERFACE_APPLICATION", (*INTERFACE, "application"), ("exporter", "interface", "application"), INTERFACE),
        Grouping("EXPORTER_INTERFACE_HOST", (*INTERFACE, "address"), ("exporter", "interface", "host"), INTERFACE),
        Grouping("EXPORTER_INTERFACE_CONVERSATION", (*INTERFACE, *CONVERSATION), ("exporter", "interface", "conversation"), INTERFACE),
        Grouping("EXPORTER_INTERFACE_TOS_APPLICATION", (*_TOS, "application"), ("exporter", "interface", "dscp", "application"), _TOS),
        Grouping("EXPORTER_INTERFACE_TOS_HOST", (*_TOS, "address"), ("exporter", "interface", "dscp", "host"), _TOS),
        Grouping("EXPORTER_INTERFACE_TOS_CONVERSATION", (*_TOS, *CONVERSATION), ("exporter", "interface", "dscp", "conversation"), _TOS),
    )
}
VALUES = ("bytes_in", "bytes_out", "hostname", "hostname2", "congestion", "non_ect")
SUMMARY = (*WINDOW, "grouped_by", *INTERFACE, "dscp", *CONVERSATION, *VALUES, "grouped_by_key")


def applications(conversations: DataFrame) -> DataFrame:
    """Conversation rows as application rows, without host names."""
    return unnamed(conversations)


def hosts(conversations: DataFrame) -> DataFrame:
    """Conversation rows as two host rows each; a conversation of a host with itself counts twice for it."""
    ends = F.explode(F.array(F.struct("address", "hostname"), F.struct(F.col("larger_address").alias("address"), F.col("hostname2").alias("hostname"))))
    rows = conversations.withColumn("__end", ends)
    return rows.withColumns({"address": F.col("__end.address"), "hostname": F.col("__end.hostname"), "hostname2": F.lit(None).cast("string")}).drop("__end")


def _complete() -> Column:
    return F.col("location").isNotNull() & F.col("protocol").isNotNull() & (F.col("address") != "") & (F.col("larger_address") != "")


def complete(conversations: DataFrame) -> DataFrame:
    """Conversations with a location, a protocol and both addresses."""
    return conversations.where(_complete())


def _family(name: str) -> str:
    return next((f for f in ("HOST", "CONVERSATION") if name.endswith(f)), "APPLICATION")


def _family_rows(conversations: DataFrame, family: str) -> DataFrame:
    return hosts(conversations) if family == "HOST" else conversations


def _family_sums(rows: DataFrame, names: list[str]) -> DataFrame:
    """Sums of groupings of one family: grouped_by, the keys that apply (null for others) and the values."""
    family = _family(names[0])
    own = {"HOST": ("address",), "CONVERSATION": CONVERSATION, "APPLICATION": ("application",)}[family]
    changing = ("dscp", *(c for c in own if any(c not in GROUPINGS[n].keys for n in names)))
    kinds = dict(rows.select(*changing).dtypes)
    mark = lambda n: F.struct(
        F.lit(n).alias("grouped_by"), *[(F.col(c) if c in GROUPINGS[n].keys else F.lit(None).cast(kinds[c])).alias(c) for c in changing]
    )
    rows = rows.withColumn("__m", F.explode(F.array(*map(mark, names))) if len(names) > 1 else mark(names[0]))
    rows = rows.withColumns({c: F.col("__m")[c] for c in ("grouped_by", *changing)}).drop("__m")
    block = [c for c in ("block",) if c in rows.columns and family == "CONVERSATION"]  # lets conversations stay where they are
    return summed(rows, (*WINDOW, *INTERFACE, *block, "grouped_by", "dscp", *own), named=family == "HOST").drop(*block)


def sums(conversations: DataFrame) -> dict[str, DataFrame]:
    """The sums of every grouping by itself, before any pruning.  Only host rows keep host names, as only they show them.

    ``conversations`` are sums by conversation and DSCP, or parts of such sums.
    """
    return {name: _family_sums(_family_rows(conversations, _family(name)), [name]).select(*WINDOW, *g.keys, *VALUES) for name, g in GROUPINGS.items()}


def _display_key(marks: dict[str, str | int], column: str = "grouped_by") -> Column:
    """The display key of rows of groupings that are told by their mark in a column."""
    *others, last = marks
    out = grouped_by_key(GROUPINGS[last].dims)
    for n in others:
        out = F.when(F.col(column) == marks[n], grouped_by_key(GROUPINGS[n].dims)).otherwise(out)
    return out


def _best(rows: DataFrame, parent: tuple[str, ...], key: Column, k: int) -> DataFrame:
    """The k rows of most bytes for each window and parent, with ``grouped_by_key``; ties go to the lesser display key.

    Rows are cut by their bytes first, on each partition before the shuffle, so a parent with very many rows sends few,
    and display keys are made for what is left only.
    """
    by_bytes = Window.partitionBy(*WINDOW, *parent).orderBy(F.desc(F.col("bytes_in") + F.col("bytes_out")))
    ahead = rows.withColumn("__rank", F.rank().over(by_bytes)).where(F.col("__rank") <= k).withColumn("grouped_by_key", key)
    by_key = Window.partitionBy(*WINDOW, *parent).orderBy("__rank", "grouped_by_key")
    return ahead.withColumn("__rank", F.row_number().over(by_key)).where(F.col("__rank") <= k).drop("__rank")


def top_k(rows: DataFrame, grouping: Grouping, k: int) -> DataFrame:
    """The k rows of most bytes of one grouping for each window and parent."""
    return _best(rows, grouping.parent, grouped_by_key(grouping.dims), k)


def summarize(conversations: DataFrame, k: int, names: tuple[str, ...] = tuple(GROUPINGS)) -> DataFrame:
    """The groupings' rows in one table: grouped_by, the key columns that apply, the values and the display key."""
    families: dict[str, list[str]] = {}
    for name in names:
        families.setdefault(_family(name), []).append(name)
    kinds, parts = {"dscp": "int", "protocol": "int"}, []
    for family, members in families.items():
        rows = _family_sums(_family_rows(complete(conversations) if family == "CONVERSATION" else conversations, family), members)
        # a total is the only row of its window and parent, whatever k
        rows = _best(rows, (*INTERFACE, "grouped_by", "dscp"), _display_key({n: n for n in members}), k)
        missing = {c: F.lit(None).cast(kinds.get(c, "string")) for c in SUMMARY if c not in rows.columns}
        parts.append((rows.withColumns(missing) if missing else rows).select(*SUMMARY))
    return reduce(DataFrame.unionByName, parts)


#: Of what columns of a flow the rows of each family are made.
_ENDS = {
    "APPLICATION": [{"application": "application"}], "CONVERSATION": [{c: c for c in CONVERSATION}],
    "HOST": [{"address": "address", "hostname": "hostname"}, {"address": "larger_address", "hostname": "hostname2"}],
}


def _ends(flows: DataFrame, families: dict[str, list[int]]) -> DataFrame:
    """Flows as the rows that each family sums, with ``marks``, the places of its groupings, and the key columns it has."""
    kinds = dict(flows.dtypes)
    row = lambda marks, own: F.struct(
        F.array(*map(F.lit, marks)).alias("marks"), *[(F.col(own[c]) if c in own else F.lit(None).cast(kinds[c])).alias(c) for c in (*CONVERSATION, "hostname")]
    )
    columns = ("marks", *CONVERSATION, "hostname")
    rows = flows.withColumn("__e", F.explode(F.array(*[row(marks, own) for f, marks in families.items() for own in _ENDS[f]])))
    return rows.withColumns({c: F.col("__e")[c] for c in columns} | {"hostname2": F.lit(None).cast("string")}).drop("__e")


def summarize_flows(flows: DataFrame, options: Options, names: tuple[str, ...] = tuple(GROUPINGS)) -> DataFrame:
    """The same of flows, by one scan and one exchange of the flows and none of their copies or sums.

    Host names are listed before the flows are copied to windows, so that no sum needs a sort by names.
    """
    marks = {n: i for i, n in enumerate(names)}
    families: dict[str, list[int]] = {}
    for n, i in marks.items():
        families.setdefault(_family(n), []).append(i)
    own = dict.fromkeys(c for f in families for x in _ENDS[f] for c in x.values())
    rows = _ends(interface_flows(flows, options, ("ingress", "congestion", "non_ect", "dscp", *own)), families)
    if "CONVERSATION" in families:
        rows = rows.where((F.col("marks")[0] != families["CONVERSATION"][0]) | _complete())
    if "HOST" in families:
        rows = listed(rows, (*INTERFACE, "block", "address"))
        rows = rows.withColumn("names", F.when(F.col("marks")[0] == families["HOST"][0], F.col("names")))
    rows = copied(rows, options).withColumn("mark", F.explode("marks"))
    of = lambda c: F.when(F.col("mark").isin([i for n, i in marks.items() if c in GROUPINGS[n].keys]), F.col(c))
    rows = rows.withColumns({c: of(c) for c in ("dscp", "application")})
    rows = summed(rows, (*WINDOW, *INTERFACE, "block", "mark", "dscp", *CONVERSATION), named=False)
    rows = _best(rows, (*INTERFACE, "block", "mark", "dscp"), _display_key(marks, "mark"), options.top_k)
    return rows.withColumn("grouped_by", F.element_at(F.array(*map(F.lit, names)), F.col("mark") + 1)).select(*SUMMARY)

"""WARC: Merkle fixity audit.

An archive is a list of records, each in a volume (a WARC file) at an offset.  Its hash
tree has the records as leaves; a volume's inner nodes are ordered ranges of offsets, each
level's range ``fanout`` times as wide as the one below, and above the volumes' roots
stand ranges of volume numbers in the same way up to the one root.  A node is the SHA-256
of its children's numbers and hashes, in order.

An audit compares the roots of two replicas, then the children of the nodes that differ,
level by level, and so arrives at the records that are damaged, missing or extra without
reading what lies below equal nodes.  Every level is a stored table with one row per node,
and each descent is a semi-join with the few parents that differ.

All of it is DataFrame functions.  Offset ranges hold as many records as fit into them, so
no group grows with the archive, and no order over the whole archive is needed.

Defined results: a null payload is an empty one.  Two records at one place (a repeated
row) are both leaves; their count and hashes are compared as one.  Empty replicas are
equal; of an empty and a full one all records are missing or extra.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pnlflow.llm.common import stored

FANOUT, SPAN = 16, 1 << 16


def record(url: str | Column, payload: str | Column) -> Column:
    """A WARC response record: header lines, a blank line, the payload, two blank lines."""
    url, payload = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (url, payload))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def archive(pages: DataFrame, ids_per_volume: int = 1024) -> DataFrame:
    """Records of pages (page_id, url, html): volume, offset, length, record_id, sha256.  A volume
    takes a fixed range of ids, so placing its records needs no more than that range.  Rows
    without id are spread over the volumes -1 to -4096 by their hash."""
    rows = pages.select(F.col("page_id").cast("long").alias("record_id"), record(F.col("url").cast("string"), F.col("html").cast("string")).alias("record"))
    rows = rows.select(F.coalesce(F.floor(F.col("record_id") / ids_per_volume), -1 - F.pmod(F.xxhash64("record"), F.lit(4096))).cast("long").alias("volume"), "record_id",
                       F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("sha256"))
    before = Window.partitionBy("volume").orderBy("record_id", "sha256").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select("volume", (F.sum("length").over(before) - F.col("length")).alias("offset"), "length", "record_id", "sha256")


@dataclass(frozen=True)
class Tree:
    """levels[0]: the leaves' parents; the last: the one root.  Columns: volume, node, parent_volume,
    parent, sha256.  Above the volumes' roots ``volume`` is null and node a range of volumes."""

    records: DataFrame
    levels: list[DataFrame]


def _up(children: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Parents: the hash of the children's numbers and hashes, in order."""
    listed = F.array_sort(F.collect_list(F.struct(number, "sha256")))
    text = F.array_join(F.transform(listed, lambda c: F.concat(c[number].cast("string"), F.lit(":"), c["sha256"])), "\n")
    return children.groupBy(*keys).agg(F.sha2(text, 256).alias("sha256"))


def heights(*records: DataFrame, fanout: int = FANOUT, span: int = SPAN) -> tuple[int, int]:
    """Levels within a volume and above the volumes that all the replicas need (a few numbers)."""
    high = wide = 0
    for r in records:
        top = r.agg(F.max("offset"), F.max("volume"), F.min("volume")).first()
        if top[0] is not None:
            a, b = top[0] // span, max(top[1], -top[2]) + 1
            while a >= fanout ** high:
                high += 1
            while b >= fanout ** wide:
                wide += 1
    return high, wide


def tree(records: DataFrame, high: int, wide: int, fanout: int = FANOUT, span: int = SPAN, tag: str = "tree") -> Tree:
    """The hash tree of an archive, all levels stored."""
    leaves = stored(records.withColumn("node", F.floor(F.col("offset") / span).cast("long")), f"{tag}-records")
    levels = [stored(_up(leaves, ["volume", "node"], "offset").select("volume", "node", "sha256"), f"{tag}-0")]
    for k in range(1, high + 1):
        below = levels[-1].withColumn("up", F.floor(F.col("node") / fanout).cast("long"))
        levels.append(stored(_up(below, ["volume", "up"], "node").select("volume", F.col("up").alias("node"), "sha256"), f"{tag}-{k}"))
    for k in range(1, wide + 1):
        below = levels[-1] if k > 1 else levels[-1].select(F.col("volume").alias("node"), "sha256")
        below = below.select((F.floor((F.col("node") + (1 if k == 1 else 0)) / fanout)).cast("long").alias("up"), "node", "sha256")
        levels.append(stored(_up(below, ["up"], "node").select(F.lit(None).cast("long").alias("volume"), F.col("up").alias("node"), "sha256"), f"{tag}-{high + k}"))
    return Tree(leaves, levels)


def _differ(one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes that are not the same in both, of those given."""
    a, b = (x.select(*keys, F.col("sha256").alias(n)) for x, n in ((one, "one"), (other, "other")))
    return a.join(b, keys, "full").where(~F.col("one").eqNullSafe(F.col("other"))).select(*keys)


def audit(first: DataFrame, second: DataFrame, fanout: int = FANOUT, span: int = SPAN) -> DataFrame:
    """first, second: records (volume, offset, length, record_id, sha256) of two replicas.  One row
    for each place where they differ: volume, offset, status (damaged, missing: not in the
    second, extra: not in the first), and of either replica how many records are there, the
    smallest record_id and the first hash."""
    high, wide = heights(first, second, fanout=fanout, span=span)
    one, two = (tree(r, high, wide, fanout, span, t) for r, t in ((first, "first"), (second, "second")))
    bad: DataFrame | None = None
    for k in range(high + wide, -1, -1):
        levels, keys = [], ["node"] if k > high else ["volume", "node"]
        for t in (one, two):
            rows = t.levels[k].select(*keys, "sha256")
            if bad is not None:  # only below what differs
                if k > high:
                    rows = rows.withColumn("up", F.floor(F.col("node") / fanout).cast("long"))
                elif k == high:
                    rows = rows.withColumn("up", F.floor((F.col("volume") + 1) / fanout).cast("long"))
                else:
                    rows = rows.withColumn("up", F.floor(F.col("node") / fanout).cast("long"))
                on = ["up"] if k >= high else ["volume", "up"]
                rows = rows.join(bad.withColumnRenamed("node", "up").select(*on), on, "left_semi")
            levels.append(rows)
        bad = stored(_differ(*levels, keys), "differ")
    sides = []
    for t, n in ((one, "first"), (two, "second")):
        rows = t.records.join(bad, ["volume", "node"], "left_semi")
        sides.append(rows.groupBy("volume", "offset").agg(
            F.count("*").alias(f"{n}_records"), F.min("record_id").alias(f"{n}_id"), F.min("sha256").alias(f"{n}_sha256"),
            F.sort_array(F.collect_list("sha256")).alias(f"{n}_all")))
    both = sides[0].join(sides[1], ["volume", "offset"], "full")
    status = (F.when(F.col("second_all").isNull(), "missing").when(F.col("first_all").isNull(), "extra").otherwise("damaged"))
    return both.where(~F.col("first_all").eqNullSafe(F.col("second_all"))).select(
        "volume", "offset", status.alias("status"), *(f"{n}_{c}" for n in ("first", "second") for c in ("records", "id", "sha256")))

"""A Merkle manifest of a table: leaf digests, a tree for each group, and proofs by pointer jumping.

Every row is a leaf, the SHA-256 of its columns. The leaves of a group ascend by key, and
``fanout`` consecutive nodes become their digest until one is left, the group's subroot; the
subroots, in order of their groups, become the root in the same way. A proof lists the
siblings of each node on the way to the root.

Proofs are not walked level by level. Every inner node starts with one segment, its siblings
below its parent, and a pointer to that parent. A self-join gives each node the segments and
the pointer of the node that it points to, which doubles the distance, until all point to
the root: rounds grow with the logarithm of the tree's height. A run of leaves shares the way
above its parent, so leaves stay in the row of their run until the end.

No task sees a group as a whole: leaves are dealt to ranges of (group, key), their places come
from the number of rows in the ranges before, and later steps join on node numbers. At most
``fanout ** distance`` nodes point to one node; above ``ROWS_PER_KEY`` the join is salted. On
the driver are the root, the number of groups and the largest of them.

Defined cases: rows of one key are ordered by their digests, repeated rows are leaves of
their own, and a null key comes first. A null group is a group of its own and the first.
An empty table has no rows in its manifest. A group of one row has that leaf as its subroot,
and a table of one group has that subroot as its root. Texts are digested whole; columns
other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, written

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 8
ROWS_PER_KEY = 4096
SALTS = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOP = 0  # the number of the tree over the subroots; the groups' trees have 1, 2, ...
_PLACE_BITS = 33  # of monotonically_increasing_id, below the number of the partition


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def _raw(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 (binary) of the columns: of each ``-`` if null, else the number of UTF-8 bytes, ``:`` and the value."""
    values = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return _raw(F.concat(*parts))


def folded(leaf: Column, siblings: Column) -> Column:
    """The root (lowercase hex) that a leaf and the siblings on its way give."""
    return F.aggregate(siblings, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]).cast("binary"), 256))


def proof_digest(siblings: Column) -> Column:
    """SHA-256 (lowercase hex) of all siblings in their order."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def _around(kids: Column, at: Column, count: Column) -> Column:
    """The siblings left and right of the node at place ``at`` (from 0) of a run."""

    def digests(of: Column) -> Column:
        return F.unhex(F.array_join(F.transform(of, lambda k: F.hex(k["hash"])), ""))

    left, right = F.slice(kids, F.lit(1), at), F.slice(kids, at + 2, count)
    return F.struct(digests(left).alias("left"), digests(right).alias("right"))


def _runs(nodes: DataFrame, fanout: int, carried: Sequence[str] = ()) -> DataFrame:
    """``tree``, ``run``, ``height``, ``kids`` and their digest ``hash`` from nodes by ``tree`` and ``idx``."""
    kid = F.struct((F.col("idx") % fanout).cast("int").alias("i"), "hash", *carried)
    runs = nodes.groupBy("tree", F.expr(f"idx div {fanout}").alias("run")).agg(
        F.max("height").alias("height"), F.array_sort(F.collect_list(kid)).alias("kids")
    )
    joined = F.array_join(F.transform("kids", lambda k: _hex(k["hash"])), "")
    return runs.withColumn("hash", _raw(joined))


def _edges(runs: DataFrame, level: int, fanout: int, child: Sequence[Column] | None = None) -> DataFrame:
    """From each node of the runs to its parent: the parent's number, the siblings, and the
    subroot where the edge leads to it or starts from it."""
    out = runs.select("*", F.posexplode("kids").alias("at", "kid"))
    idx = F.col("run") * fanout + F.col("at")
    tree, own, place = child or (F.col("tree"), F.lit(level), idx)
    if child:
        sub = F.col("kid.hash")
    else:
        sub = F.when((F.col("tree") != _TOP) & (F.col("height") == level + 1), F.col("hash"))
    return out.select(
        tree.cast("long").alias("tree"), own.cast("int").alias("level"), place.cast("long").alias("idx"),
        F.col("tree").cast("long").alias("a_tree"), F.lit(level + 1).cast("int").alias("a_level"), F.col("run").alias("a_idx"),
        sub.alias("sub"), F.array(_around(F.col("kids"), F.col("at"), F.size("kids"))).alias("way"),
    )


def _jump(edges: DataFrame, root: tuple[int, int, int], distance: int, fanout: int) -> DataFrame:
    """Each node's way and pointer extended by those of the node that it points to."""
    arrived = (F.col("a_tree") == root[0]) & (F.col("a_level") == root[1]) & (F.col("a_idx") == root[2])
    open_ = edges.where(~arrived)
    # An inner node's ancestor at this distance is above that level, or in the top tree.
    above = edges.where((F.col("tree") == _TOP) | (F.col("level") > distance))
    above = above.select(*[F.col(c).alias(f"o_{c}") for c in above.columns])
    on = [F.col(f"a_{c}") == F.col(f"o_{c}") for c in ("tree", "level", "idx")]
    if fanout**distance > ROWS_PER_KEY:
        open_ = open_.withColumn("salt", F.expr(f"idx div {ROWS_PER_KEY} % {SALTS}").cast("int"))
        above = above.withColumn("o_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        on.append(F.col("salt") == F.col("o_salt"))
    far = open_.join(above, on).select(
        "tree", "level", "idx",
        *[F.col(f"o_a_{c}").alias(f"a_{c}") for c in ("tree", "level", "idx")],
        F.coalesce("sub", "o_sub").alias("sub"), F.concat("way", "o_way").alias("way"),
    )
    return edges.where(arrived).unionByName(far)


def _numbered(leaves: DataFrame, fanout: int) -> tuple[DataFrame, DataFrame]:
    """The leaves with ``tree``, ``idx`` and ``height``, and the trees with their numbers of leaves.

    The leaves of a range are counted for each of its groups; a leaf's place is what the
    ranges before hold of its group and its place in its own.
    """
    n = partitions(leaves.sparkSession)
    order = ["name", F.asc_nulls_first("key"), "hash", "row"]
    dealt = leaves.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = written(dealt.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    part = F.shiftright("row", _PLACE_BITS).alias("part")
    held = placed.groupBy("name", part).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy("name")
    held = held.withColumn("before", F.sum("n").over(group.orderBy("part")) - F.col("n"))
    held = written(held.withColumn("total", F.sum("n").over(group)), "merkle-held")

    # Ranges ascend by group: the trees that start in a range follow those of the ranges before.
    starts = held.groupBy("name").agg(F.min("part").alias("part"), F.max("total").alias("total"))
    starts = starts.withColumn("here", F.row_number().over(Window.partitionBy("part").orderBy("name")))
    counts = starts.groupBy("part").agg(F.count("*").alias("c"))  # at most one row for each range
    counts = counts.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("earlier"))
    trees = starts.join(counts, "part").select("name", (F.col("earlier") + F.col("here")).alias("tree"), "total")
    levels = F.sequence(F.lit(0), F.lit(62))
    height = F.size(F.filter(levels, lambda k: F.pow(F.lit(float(fanout)), k) < F.col("total").cast("double")))
    trees = written(trees.withColumn("height", height), "merkle-trees")

    offsets = held.join(trees.drop("total"), "name")
    offsets = written(offsets.select("name", "part", "first", "before", "tree", "height"), "merkle-offsets")
    numbered = placed.withColumn("part", part).join(offsets, ["name", "part"])
    return numbered.withColumn("idx", F.col("before") + F.col("row") - F.col("first")), trees


def manifest(
    df: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", key: str = "doc_id", fanout: int = FANOUT, claim: Column | None = None
) -> DataFrame:
    """``key``, ``leaf``, ``subroot``, ``root`` and ``siblings`` of every row (digests in lowercase hex).

    ``siblings`` has one struct of ``left`` and ``right`` for each level, from the leaf on.
    ``claim``, a binary digest worked out from ``df`` (see :func:`leaf_digest`), is carried along
    as the column of that name, null where it is null.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    leaves = df.select(
        F.col(key).alias("key"),
        F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("name"),
        leaf_digest([F.col(c) for c in columns]).alias("hash"),
        (F.lit(None).cast("binary") if claim is None else claim).alias("claim"),
    )
    numbered, trees = _numbered(written(leaves, "merkle-digests"), fanout)
    n_trees, tallest = trees.agg(F.count("*"), F.coalesce(F.max("height"), F.lit(0))).first()
    if not n_trees:
        return spark.createDataFrame([], f"{key} {kind}, {_RESULT}")

    lone = F.col("height") == 0
    first = _runs(numbered, fanout, ["key", "claim"])
    first = written(first.withColumn("hash", F.when(lone, F.col("kids")[0]["hash"]).otherwise(F.col("hash"))), "merkle-runs")

    subroots = [first.where("height <= 1").select("tree", "height", "hash")]
    edges, runs = [], first
    for level in range(1, tallest):
        nodes = runs.where(F.col("height") > level).select("tree", F.col("run").alias("idx"), "height", "hash")
        runs = written(_runs(nodes, fanout), "merkle-runs")
        edges.append(_edges(runs, level, fanout))
        subroots.append(runs.where(F.col("height") == level + 1).select("tree", "height", "hash"))
    tops = subroots[0]
    for more in subroots[1:]:
        tops = tops.unionByName(more)

    top = 0  # the height of the top tree
    nodes = tops.select(
        F.lit(_TOP).alias("tree"), (F.col("tree") - 1).alias("idx"), F.lit(-1).alias("height"), "hash",
        F.col("tree").alias("child"), F.col("height").alias("child_height"),
    )
    left = n_trees
    while left > 1:
        runs = written(_runs(nodes, fanout, [] if top else ["child", "child_height"]), "merkle-top")
        child = None if top else (F.col("kid.child"), F.col("kid.child_height"), F.lit(0))
        edges.append(_edges(runs, top, fanout, child))
        nodes = runs.select("tree", F.col("run").alias("idx"), "height", "hash")
        left, top = -(-left // fanout), top + 1
    root = nodes.select(_hex(F.col("hash")).alias("root")).first()["root"]
    at = (_TOP, top, 0) if n_trees > 1 else (1, tallest, 0)

    ways = None
    for some in edges:
        ways = some if ways is None else ways.unionByName(some)
    if ways is not None:
        ways, distance = written(ways, "merkle-ways"), 1
        while distance < max(tallest - 1, 0) + top:
            ways, distance = written(_jump(ways, at, distance, fanout), "merkle-ways"), 2 * distance
        up = ways.select("tree", "level", F.col("idx").alias("run"), "sub", "way").where("level <= 1")
        first = first.withColumn("level", F.least("height", F.lit(1))).join(up, ["tree", "level", "run"], "left")
    else:
        first = first.withColumns({"sub": F.col("hash"), "way": F.array().cast(_WAY)})

    own = F.when(lone, F.array().cast(_WAY)).otherwise(F.array(_around(F.col("kids"), F.col("at"), F.size("kids"))))
    rows = first.select("*", F.posexplode("kids").alias("at", "kid"))
    way = F.concat(own, F.coalesce("way", F.array().cast(_WAY)))
    siblings = F.transform(way, lambda s: F.struct(_hex(s["left"]).alias("left"), _hex(s["right"]).alias("right")))
    return rows.select(
        F.col("kid.key").alias(key),
        _hex(F.col("kid.hash")).alias("leaf"),
        _hex(F.coalesce("sub", "hash")).alias("subroot"),
        F.lit(root).alias("root"),
        siblings.alias("siblings"),
        _hex(F.col("kid.claim")).alias("claim"),
    )


_WAY = "array<struct<left:binary,right:binary>>"
_RESULT = "leaf string, subroot string, root string, siblings array<struct<left:string,right:string>>, claim string"


def tamper_report(df: DataFrame) -> DataFrame:
    """The manifest of ``documents`` with digests of its proofs, each verified against a leaf that is
    tampered with (its text's A-Z in lower case) where 3 divides the CRC-32 of doc_id; never for a null doc_id."""
    tampered = [F.translate(F.col(c), _UPPER, _LOWER) if c == "text" else F.col(c) for c in COLUMNS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = manifest(df, claim=F.when(chosen, leaf_digest(tampered)))
    root = folded(F.coalesce("claim", "leaf"), F.col("siblings"))
    out = out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("siblings")).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

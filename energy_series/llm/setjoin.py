"""Exact Jaccard joins of shingle sets, by classes, candidate clusters and prefix trees.

Equal sets are one class. A doubtful class survives only if enough of its shingles occur
elsewhere. Survivors meet by keys that a candidate function gives them; the connected
components of "meets" are clusters, and the sets of a cluster are joined with each other
in prefix trees. A cluster of many sets is cut into blocks, so no group is collected whole. Blocks
meet a few pivots first and only what these leave apart is joined block by block; tasks return links that span what
they found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, shingles
from .prefix_tree import spanning_links

BLOCK_SETS = 128
BLOCK_SHINGLES = 1 << 19
DEALS = 12
PIVOTS = 8


def _lists(values: np.ndarray, n: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))


def set_ids(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64 bits that equal sets share; the empty set has 0."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(shingles.mix(hashes + np.uint64(1)), dtype=np.uint64)])
    ends = np.cumsum(n)
    out = shingles.mix(sums[ends] - sums[ends - n] + n.astype(np.uint64))
    return np.where(n > 0, out | np.uint64(1), np.uint64(0))


def _fields(df: DataFrame, text: str, key: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))


def document_sets(df: DataFrame, size: int, more: Callable[[np.ndarray, np.ndarray], pa.Array] | None = None) -> DataFrame:
    """``key``, ``set_id``, ``n`` and, given ``more``, its list of numbers for each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch, "text"):
                hashes, n = shingles.shingle_sets(part.column("text"), size)
                columns = [part.column("key"), pa.array(set_ids(hashes, n).view(np.int64)), pa.array(n, pa.int64())]
                if more:
                    columns.append(more(hashes, n))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["key", "set_id", "n"] + ["more"] * bool(more)
    return df.mapInArrow(run, "key long, set_id long, n long" + ", more array<long>" * bool(more))


def _one_of(sample: int) -> Callable[[np.ndarray, np.ndarray], pa.Array]:
    """The shingles whose hash is a multiple of ``sample``, the same for every document."""

    def some(hashes: np.ndarray, n: np.ndarray) -> pa.Array:
        chosen = hashes % np.uint64(sample) == 0
        doc = np.repeat(np.arange(len(n)), n)[chosen]
        return _lists(hashes[chosen], np.bincount(doc, minlength=len(n)))

    return some


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the least node of its connected component, for every node of
    ``edges``.

    Alternates two steps until the edges are stars: every node sends its greater
    neighbours to its least neighbour, then its smaller ones. Each round is a written
    table; aggregates combine before the shuffle and joins split a hot node.
    """
    x = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    x = common.written(x, "edges")
    state = _state(x)
    while True:
        both = x.select("u", "v").union(x.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        x = common.written(small.select("e.u", "e.v").filter("u > v").distinct(), "edges")
        seen = _state(x)
        if seen == state:
            break
        state = seen
    roots = x.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _parts(low: int, high: int, similarity: tuple[int, int]) -> tuple[int, int]:
    """The number of parts for sets of ``low`` to ``high`` shingles, and how many of them may be empty.

    Linked sets differ in fewer places than there are parts without the spare ones, of which there are as many as may be
    empty: about what a set of ``low`` shingles leaves empty by chance.
    """
    num, den = similarity
    needed = high * (den - num) // num + 1
    by_chance = needed * np.exp(-low / needed) if needed > 1 else 0.0
    spare = int(by_chance + np.sqrt(by_chance) + 0.5)
    return needed + spare, spare


def _by_parts(similarity: tuple[int, int]) -> Callable:
    """Keys by which every two linked sets meet.

    Two sets of which the larger has y shingles differ in at most ``y * (1 - s) / s``
    places. Where shingles are dealt to one part more than that and to ``spare`` further parts,
    ``spare + 1`` parts are equal in both. The number of parts follows the size class of the larger set, and a class
    reaches up by ``1 / s``, so a set has keys for its own class and for the next.

    A part without shingles says nothing and has no key. Two linked sets that are equal in empty parts alone have more
    than ``spare`` of these each, so each such set is dealt anew, with another seed, and they meet
    there or are dealt anew again. Only what still has too many empty parts after ``DEALS`` deals has keys for empty ones.
    """
    num, den = similarity

    def keys(hashes: np.ndarray, n: np.ndarray) -> pa.Array:
        bounds = [1]
        while bounds[-1] <= max(n.max(initial=0), 1):
            bounds.append(bounds[-1] * den // num + 1)
        bounds += [bounds[-1] * den // num + 1, (bounds[-1] * den // num + 1) * den // num + 1]
        limits = [_parts(bounds[max(i - 1, 0)], bounds[i + 1] - 1, similarity) for i in range(len(bounds) - 1)]
        total, spare = (np.array(x) for x in zip(*limits, strict=True))
        own = np.searchsorted(np.array(bounds), n, "right") - 1
        doc = np.repeat(np.arange(len(n)), n)
        found = []
        for up in (0, 1):
            size_class = own + up
            d, h = doc, hashes
            for deal in range(DEALS):
                if not len(d):
                    break
                seed = shingles.mix(np.uint64([deal]))[0] if deal else np.uint64(0)
                dealt = shingles.mix(h ^ seed) if deal else h
                part = ((dealt >> np.uint64(32)) % total[size_class[d]].astype(np.uint64)).astype(np.int64)
                order = np.lexsort((part, d))
                od, op = d[order], part[order]
                new = np.flatnonzero(np.append(True, (od[1:] != od[:-1]) | (op[1:] != op[:-1])))
                sums = np.add.reduceat(shingles.mix(h[order] ^ np.uint64(0x5851F42D4C957F2D)), new)
                nd, place = od[new], _place(size_class[od[new]], deal, op[new])
                found.append((nd, shingles.mix(sums ^ shingles.mix(place))))
                full = np.bincount(nd, minlength=len(n))
                again = (full > 0) & (total[size_class] - full > spare[size_class])
                if deal == DEALS - 1:
                    for i in np.flatnonzero(again):
                        gone = np.setdiff1d(np.arange(total[size_class[i]]), op[new][nd == i])
                        place = _place(np.full(len(gone), size_class[i]), deal, gone)
                        found.append((np.full(len(gone), i), shingles.mix(shingles.mix(place))))
                d, h = d[again[d]], h[again[d]]
        if not found:
            return _lists(np.zeros(0, np.uint64), np.zeros(len(n), np.int64))
        doc, key = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(doc, kind="stable")
        return _lists(key[order], np.bincount(doc, minlength=len(n)))

    return keys


def _place(size_class: np.ndarray, deal: int, part: np.ndarray) -> np.ndarray:
    """A number for a part of a deal of a size class."""
    return (size_class.astype(np.uint64) * np.uint64(DEALS) + np.uint64(deal)) * np.uint64(1 << 40) + part.astype(np.uint64)


def _shingles(docs: DataFrame, chosen: DataFrame, size: int, meet: Callable | None = None) -> DataFrame:
    """``set_id``, ``shingles`` and, with ``meet``, ``meets`` of the texts whose ``key`` and ``set_id`` are chosen."""
    texts = docs.join(chosen.hint("merge"), "key").select("set_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch, "text"):
                hashes, n = shingles.shingle_sets(part.column("text"), size)
                ids = pa.array(set_ids(hashes, n).view(np.int64))
                same = pc.equal(ids, part.column("set_id"))  # a key that repeats has other texts, too
                out = [ids, _lists(hashes, n)] + ([meet(hashes, n)] if meet else [])
                yield pa.RecordBatch.from_arrays(out, names).filter(same)

    names = ["set_id", "shingles"] + ["meets"] * bool(meet)
    return texts.mapInArrow(run, "set_id long, shingles array<long>" + ", meets array<long>" * bool(meet))


def _meetings(meets: DataFrame) -> DataFrame:
    """The clusters of sets (``set_id``) that share a key (``m``), through the least set of each key."""
    stars = meets.groupBy("m").agg(F.min("set_id").alias("b"), F.max("set_id").alias("c")).filter("b < c")
    return components(meets.join(stars, "m").select(F.col("set_id").alias("a"), "b").filter("a <> b").distinct())


def components_of(
    df: DataFrame,
    text: str,
    key: str,
    size: int,
    similarity: tuple[int, int],
    candidates: Callable[[np.ndarray, np.ndarray], pa.Array] | None = None,
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id``: documents whose sets of ``size``-word
    shingles have a Jaccard similarity of ``num / den`` or more link, and the smallest key
    that links reach names the component. Empty sets link with nothing.

    ``candidates`` gives each set a few meeting keys. Without it, keys by parts find every linked
    pair; they are many for low similarities. Rows that repeat a key are one document each; a
    null key has the component of its set, or null.
    """
    num, den = similarity
    docs = _fields(df, text, key)
    keyed = common.written(document_sets(docs, size, candidates), "sets")
    classes = keyed.filter("n > 0").groupBy("set_id").agg(F.min("key").alias("first"), F.first("n").alias("n"))
    firsts = classes.filter("first is not null").select("set_id", F.col("first").alias("key"))
    if candidates:
        clusters = _meetings(keyed.filter("n > 0 and key is not null").select("set_id", F.explode("more").alias("m")))
        clusters = common.written(clusters, "clusters")
        chosen = firsts.join(clusters.select(F.col("node").alias("set_id")), "set_id", "left_semi")
        sets = common.written(_shingles(docs, chosen, size), "shingles")
    else:
        # A set that links has at most n * (1 - s) / s shingles that occur in no other set, and
        # half as many again are looked up.
        sample = max(1, 2 * num // (3 * (den - num)))
        sampled = document_sets(docs, size, _one_of(sample)).select("set_id", F.explode("more").alias("h"))
        alone = sampled.groupBy("h").agg(F.min("set_id").alias("a"), F.max("set_id").alias("b")).filter("a = b")
        alone = alone.groupBy(F.col("a").alias("set_id")).agg(F.count("*").alias("alone"))
        doubtful = classes.join(alone, "set_id", "left").filter(F.coalesce("alone", F.lit(0)) * num <= F.col("n") * (den - num))
        sets = _shingles(docs, firsts.join(doubtful.select("set_id"), "set_id"), size, _by_parts(similarity))
        sets = common.written(sets, "shingles")
        clusters = _meetings(sets.select("set_id", F.explode("meets").alias("m")))
    links = _cluster_links(sets.select("set_id", "shingles"), clusters, similarity)
    linked = components(links)

    member = linked.join(classes.select(F.col("set_id").alias("node"), "first"), "node")
    roots = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(roots, "root").select(F.col("node").alias("set_id"), "component_id")
    named = classes.join(named, "set_id", "left").select(
        "set_id", F.coalesce("component_id", "first").alias("component_id")
    )
    named = common.written(named, "named")  # so that the next join may split the rows of one class
    return keyed.select("key", "set_id", "n").join(named, "set_id", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id")
    )


def _blocks(of: Column | bool = True) -> Column:
    """The number of blocks that a cluster's sets ``of`` a kind take, as an aggregate; 0 if there are none."""
    sets, held = F.count(F.when(F.lit(of), 1)), F.sum(F.when(F.lit(of), F.col("n")))
    return F.greatest(F.ceil(sets / BLOCK_SETS), F.ceil(F.coalesce(held, F.lit(0)) / BLOCK_SHINGLES)).cast("int")


def _cluster_links(sets: DataFrame, clusters: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a``, ``b``: links that connect what a Jaccard join of each cluster connects.

    Every block is joined with itself and with its cluster's pivots, and says which sets that connects with which
    pivot. Sets connected with one pivot need no comparison: what is left to join are the sets outside the pivot with
    most, with each other and with those inside. A set inside goes to the blocks of outside sets alone.
    """
    sizes = sets.select("set_id", F.size("shingles").cast("long").alias("n")).distinct()
    placed = clusters.withColumnRenamed("node", "set_id").join(sizes, "set_id")
    pivots = F.array(*[F.min_by("set_id", F.xxhash64("set_id", F.lit(i))) for i in range(PIVOTS)])
    cut = placed.groupBy("root").agg(_blocks().alias("blocks"), pivots.alias("pivots"))
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    pivot = (F.col("blocks") > 1) & F.array_contains("pivots", F.col("set_id"))
    dealt = placed.join(cut, "root").select("root", "set_id", "n", "blocks", own.alias("own"), pivot.alias("pivot"))
    dealt = common.written(dealt, "blocks")
    at = F.explode(F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))).alias("i")
    near = _joined(sets, dealt.select("root", "set_id", F.col("pivot").alias("marked"), at).withColumn("j", F.col("i")), similarity)
    near = common.written(near, "near")
    links = near.select("a", "b")
    inside = near.filter("root is not null").select("root", F.col("a").alias("set_id"), F.col("b").alias("pivot")).distinct()
    most = inside.groupBy("root", "pivot").agg(F.count("*").alias("sets")).groupBy("root")
    most = most.agg(F.max_by("pivot", F.struct("sets", "pivot")).alias("pivot"))
    inside = inside.join(most, ["root", "pivot"]).select("root", "set_id", F.lit(False).alias("outside"))
    large = dealt.filter("blocks > 1").select("root", "set_id", "n").join(inside, ["root", "set_id"], "left")
    large = common.written(large.withColumn("outside", F.coalesce("outside", F.lit(True))), "connected")
    cut = large.groupBy("root").agg(_blocks(~F.col("outside")).alias("inner"), _blocks(F.col("outside")).alias("outer")).filter("outer > 0")
    cut = common.written(cut, "outside")
    if cut.isEmpty():
        return links
    hashed = F.xxhash64("set_id")
    own = F.when(F.col("outside"), F.col("inner") + F.pmod(hashed, F.col("outer"))).otherwise(F.pmod(hashed, F.col("inner"))).cast("int")
    others = F.sequence(F.when(F.col("outside"), 0).otherwise(F.col("inner")), F.col("inner") + F.col("outer") - 1)
    left = large.join(cut, "root").select("root", "set_id", own.alias("own"), F.explode(others).alias("other"))
    far = left.select(
        "root",
        "set_id",
        (F.col("own") > F.col("other")).alias("marked"),
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
    )
    return links.union(_joined(sets, far, similarity).select("a", "b"))


def _joined(sets: DataFrame, dealt: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a``, ``b``: links that span what each pair of blocks (``root``, ``i``, ``j``) connects.

    In a pair of two blocks, ``marked`` are the sets of the second. In a block with itself they are pivots, and every set
    that is connected with one (the pivot, too) has a link to it with the cluster's ``root``, which other links lack.
    """
    pairs = sets.join(dealt.hint("merge"), "set_id").select(
        F.xxhash64("root", "i", "j").alias("pair"), "root", "i", "j", "set_id", "shingles", "marked"
    )
    n = common.partitions(sets.sparkSession)
    pairs = pairs.repartition(n, "pair").sortWithinPartitions("pair", "root", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, members in _runs(batches, ["pair", "root", "i", "j"]):
            ids = members.column("set_id").to_numpy()
            values = members.column("shingles").combine_chunks()
            flat = values.flatten().to_numpy(zero_copy_only=False)
            n = np.diff(values.offsets.to_numpy())
            marked = members.column("marked").to_numpy(zero_copy_only=False).astype(bool)
            one = group[2] == group[3]
            found = spanning_links(flat, n, None if one else marked, similarity)
            links = np.array(found, np.int64).reshape(-1, 2)
            stars = _stars(links, len(ids), np.flatnonzero(marked)) if one else links[:0]
            both = np.concatenate([links, stars])
            if len(both):
                root = pa.array(np.full(len(both), group[1]), mask=np.arange(len(both)) < len(links))
                yield pa.RecordBatch.from_arrays([pa.array(ids[both[:, 0]]), pa.array(ids[both[:, 1]]), root], ["a", "b", "root"])

    return pairs.mapInArrow(run, "a long, b long, root long")


def _stars(links: np.ndarray, n: int, pivots: np.ndarray) -> np.ndarray:
    """Pairs of each of ``n`` sets and each pivot that ``links`` connect it with, pivots with themselves included."""
    neighbours: list[list[int]] = [[] for _ in range(n)]
    for a, b in links.tolist():
        neighbours[a].append(b)
        neighbours[b].append(a)
    out = []
    for pivot in pivots.tolist():
        seen, stack = {pivot}, [pivot]
        while stack:
            new = [x for x in neighbours[stack.pop()] if x not in seen]
            seen.update(new)
            stack += new
        out += [(x, pivot) for x in seen]
    return np.array(out, np.int64).reshape(-1, 2)


def _runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal values of ``by``, of rows that are in this order."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in by], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for s, e in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            key = tuple(keys[s].tolist())
            if key != now and held:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(s, e - s))
    if held:
        yield now, pa.Table.from_batches(held)

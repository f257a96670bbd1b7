"""N-gram Jaccard join by prefix trees.

A document's set is its distinct 3-word shingles (words: runs without white space, A-Z in
lower case); with fewer words, the whole sequence as one shingle. Two documents link when
the Jaccard similarity of their sets is 0.9 or more. ``setjoin`` brings sets that can
link together and ``prefix_tree`` joins them exactly; two different shingles count as one
only if their 64-bit hashes agree. Below 0.9, keys by parts would outnumber the shingles: there, sets
meet by MinHash bands of four, which miss a pair with the chance (1 - s ** 4) ** bands: 48 bands, at
0.8 that is 1e-11, and below as many as keep the chance under 2e-11; where that takes too many, keys by parts. The join after it is the same.

Defined cases: a null text or one without words has the empty set, links with nothing
and is a component of its own. Rows that repeat a doc_id are documents of their own with
the same name. A null doc_id takes the component of its set, or null. Other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, op1_fingerprints, setjoin

SHINGLE = 3
SIMILARITY = (9, 10)
BANDS = 48


def jaccard_components(
    df: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row."""
    num, den = similarity
    few = None
    if 10 * num < 9 * den:
        few = op1_fingerprints.banded(similarity, BANDS)
    return setjoin.components_of(df, text, key, size, similarity, few)


def one_of_each(df: DataFrame, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """The rows of ``df`` that no document with a smaller id reaches by links. Rows that share a doc_id stay or go
    together, and rows without one stay; ``one_row_of_each`` decides row by row."""
    found = jaccard_components(df, size=size, similarity=similarity)
    extra = found.filter("component_id < doc_id").select("doc_id").distinct()
    return df.join(extra, "doc_id", "left_anti") if "doc_id" in df.columns else df.filter(F.lit(True))


def one_row_of_each(
    df: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY
) -> DataFrame:
    """One row of each component of ``df``, whether ids repeat or are null: the first by id (nulls last), then by a hash of
    id and text. Of rows with equal id and text, the one whose columns have the smallest hash stands for all. Texts
    without words all stay."""
    body = F.coalesce(F.col(text), F.lit(""))
    row_key = F.xxhash64(F.col(key), F.xxhash64(body)).alias("k")
    rows = df.select(row_key, F.col(key).alias("id"), F.struct("*").alias("row"))
    repeated = df.filter(body.rlike(r"[^ \t-\r]")).select(row_key).groupBy("k").count().filter("count > 1").select("k")
    repeated = common.written(repeated, "repeated")
    if not repeated.isEmpty():
        again = rows.join(repeated, "k", "left_semi").groupBy("k", "id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        rows = rows.join(repeated, "k", "left_anti").unionByName(again)
    found = jaccard_components(rows.select("k", F.col(f"row.{text}").alias("text")), key="k", size=size, similarity=similarity)
    placed = found.filter("n_shingles > 0").select("k", "component_id").join(rows.select("k", "id"), "k")
    placed = common.written(placed, "placed")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("first")
    groups = placed.groupBy("component_id").agg(first, F.count("*").alias("n")).filter("n > 1")
    groups = common.written(groups.select("component_id", F.col("first.k").alias("kept")), "groups")  # so that the join may split a group
    lost = placed.join(groups, "component_id").filter("k <> kept").select("k")
    return rows.join(lost, "k", "left_anti").select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])

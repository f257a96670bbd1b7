"""How far the sources of a language differ in their words, exactly and in whole numbers.

Identical texts of a language are collapsed first, with the number of copies that each source
has, so that a text is cut into terms once however often it was copied; its counts and its
documents are then added with those numbers as weights. Each source's share of a term and the
divergence of two sources follow from the counts of the terms that the language keeps.

The sum over all kept terms for two sources is evaluated over the terms that they have. A term
that neither has adds the same value for all such terms; one that only the first has adds a
value that depends on its count alone, so terms of equal counts are taken together; only terms
that both have are met one by one, and correct the two former sums.

Terms are runs of ASCII letters and of code points from U+0080 on, with A-Z in lower case.
No group meets in one task as a whole: workers add up the terms of their texts before the
shuffle, a source's terms are dealt to ``SALTS`` parts where sources are joined, and the
pairs of a term, or of a language, are split by blocks of ``BLOCK`` sources. What grows with
the number of sources of one language is the list of a text's sources, and the result.

Defined cases: a null text, language or source is the empty string; texts are cut whole; a
repeated row counts as often as it is there; equal values rank by item; a language without
kept terms has pairs of value 0 and no term rows; a language of one source has no pairs; an
empty table has no rows; columns of other names are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

MIN_DOCUMENTS = 10
TOP_TERMS = 10
SALTS = 16
BLOCK = 1024
HELD = 300_000  # terms of sources that a worker adds up before it hands them on
_SCALE = 1_000_000_000

_KEPT = {*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TERMS = bytes((b + 32 if b in range(0x41, 0x5B) else b) if b in _KEPT else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, one after another."""
    return text.translate(_TERMS).split()


def collapsed(docs: DataFrame) -> DataFrame:
    """``lang``, ``text`` and ``sources``, the copies that each source has, of every different text
    of a language. Only a digest is shuffled for each copy; texts are combined before theirs."""
    keyed = docs.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    copies = keyed.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    copies = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    texts = keyed.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "sources")


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and documents of each term of a source, added up as far as the worker may hold them."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def made() -> pa.RecordBatch:
        rows = [(lang, source, t, n, docs[t]) for (lang, source), (counts, docs) in held.items() for t, n in counts.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text, sources in zip(batch.column("lang").to_pylist(), texts, batch.column("sources").to_pylist(), strict=True):
            found = terms(text.as_py())
            each = Counter(found)
            for copy in sources:
                counts, docs = held.setdefault((lang, copy["source"]), (Counter(), Counter()))
                before, n = len(counts), copy["n"]
                if n == 1:
                    counts.update(found)
                    docs.update(each.keys())
                else:
                    for term, k in each.items():
                        counts[term] += n * k
                        docs[term] += n
                size += len(counts) - before
            if size > HELD:
                yield made()
                held.clear()
                size = 0
    if size:
        yield made()


def term_counts(docs: DataFrame, least: int = MIN_DOCUMENTS) -> DataFrame:
    """``lang``, ``source``, ``term``, its count ``n`` there and ``lang_n`` in the language, of kept terms;
    ``head`` marks one row of each term of a language."""
    kinds = "lang string, source string, term string, n long, docs long"
    found = collapsed(docs).mapInArrow(_tally, kinds)
    found = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    found = found.withColumns(
        {
            "lang_n": F.sum("n").over(term),
            "lang_docs": F.sum("docs").over(term),
            "head": F.min("source").over(term) == F.col("source"),
        }
    )
    return found.where(F.col("lang_docs") >= least).drop("docs", "lang_docs")


def _share(count: Column | str, total: str, kinds: str = "v") -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 v)), in decimals, which hold any count."""
    count = F.col(count) if isinstance(count, str) else count
    top = (count + 2).cast("decimal(20,0)") * F.lit(_SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, (F.col(total) + 2 * F.col(kinds)).cast("decimal(20,0)")).cast("long") + 1


def _divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _spread(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def _salted(df: DataFrame, n: int, *by: str) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(n)).cast("int"))


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b`` and ``value`` of every two sources of a language, ``a`` the lesser one."""
    most = groups.groupBy("lang").agg(F.count("*").alias("s")).agg(F.max("s")).first()[0] or 0
    blocks = -(-most // BLOCK) or 1
    others = groups.select("lang", F.col("source").alias("b"), F.col("none").alias("none_b"))
    low, high = F.least("source", "b").alias("a"), F.greatest("source", "b").alias("b")

    both = _salted(groups, blocks, "source").join(_spread(others, blocks), ["lang", "salt"]).where("source < b")
    neither = F.coalesce(F.col("v") * _divergence("none", "none_b"), F.lit(0).cast("long"))
    neither = both.select("lang", low, high, neither.alias("value"))

    alike = rows.groupBy("lang", "source", "p", "none").agg(F.count("*").alias("k"))
    one = _salted(alike, SALTS, "source", "p").join(_spread(others, SALTS), ["lang", "salt"]).where("source <> b")
    more = F.col("k") * (_divergence("p", "none_b") - _divergence("none", "none_b"))
    one = one.select("lang", low, high, more.alias("value"))

    there = rows.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q"), F.col("none").alias("none_b"))
    met = _salted(rows, blocks, "source").join(_spread(there, blocks), ["lang", "term", "salt"]).where("source < b")
    off = _divergence("p", "q") - _divergence("p", "none_b") - _divergence("none", "q") + _divergence("none", "none_b")
    met = met.select("lang", low, high, off.alias("value"))

    parts = [some.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")) for some in (neither, one, met)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(df: DataFrame, least: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: of every source of a language the
    other sources by divergence (part ``pair``), and the ``top`` terms in which it exceeds the
    language most (part ``term``)."""
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = written(term_counts(docs, least), "divergence-terms")

    found = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("head").cast("long")).alias("heads"))
    groups = docs.select("lang", "source").groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
    groups = written(groups.join(found, ["lang", "source"], "left").na.fill(0, ["total", "heads"]), "divergence-sources")
    langs = groups.groupBy("lang").agg(F.sum("heads").alias("v"), F.sum("total").alias("lang_total"))
    none = F.when(F.col("v") > 0, _share(F.lit(0), "total"))
    groups = written(groups.drop("heads").join(langs, "lang").withColumn("none", none), "divergence-groups")

    rows = _salted(counts, SALTS, "term").join(_spread(groups, SALTS), ["lang", "source", "salt"])
    rows = rows.select("lang", "source", "term", "none", _share("n", "total").alias("p"), _share("lang_n", "lang_total").alias("q"))
    rows = written(rows, "divergence-shares")

    pairs = written(_pairs(rows.drop("q"), groups), "divergence-pairs")
    pairs = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    above = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), _divergence("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    above = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.unionByName(above).select("lang", "source", "part", "item", "value", "rank")

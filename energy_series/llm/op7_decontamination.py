"""Benchmark decontamination by a hash set of the test items' n-grams.

Words are runs of digits, a-z and characters beyond ASCII after A-Z became a-z. A window
is ten consecutive words of an item; an item of fewer words, but not none, is one window.
The windows' hashes form a set, which is broadcast if its measured size allows that and
joined by a shuffle otherwise; the hashes of all windows of all texts are looked up, and
a hit counts if its words are equal. A document's word inside any occurrence of a window
is hit. DataFrame expressions only.

Defined cases: null texts have no words; items without words have no windows; texts are
scanned whole; equal items all count. Rows that repeat a doc_id are documents of their
own, told apart by their texts; equal rows get equal results. A null doc_id is kept. An
empty benchmark hits nothing. Results have the named columns only, or in ``clean`` those of
the input; working columns get names that the input lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
BROADCAST_BYTES = 32 << 20
#: What parts words, once A-Z became a-z and before.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does that, faster, to a text of ASCII alone."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN, -1), "")


def _runs(hashes: str, length: int) -> Column:
    """The hashes of all runs of so many words, one for each first word, from the words' hashes."""
    first = F.sequence(F.lit(0), F.greatest(F.size(hashes) - length, F.lit(0)))
    hashed = F.transform(first, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(length)]))
    return F.when(F.size(hashes) >= length, hashed).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """``item_id``, ``length``, ``hash`` and ``gram`` (words) of every distinct window."""
    items = benchmark.select(F.col(key).alias("item_id"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(WINDOW))
    first = F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("i")
    grams = items.select("item_id", "w", length.alias("length"), first)
    return grams.select("item_id", "length", F.slice("w", F.col("i"), F.col("length")).alias("gram")).distinct()


def _once(df: DataFrame, text: str, name: str = "words") -> DataFrame:
    """``df`` with the words of ``text``: the explode of one array makes them once for all the
    expressions that read them."""
    return df.withColumn(name, F.explode(F.array(words(F.col(text)))))


def _candidates(docs: DataFrame, benchmark: DataFrame, text: str, key: str) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``found``: windows (item, start, length, gram) whose hashes occur."""
    grams = item_windows(benchmark)
    lengths = sorted(r["length"] for r in grams.select("length").distinct().collect())  # ten at most
    size = grams.agg(F.sum(F.octet_length(F.array_join("gram", " ")) + 8 * WINDOW + 32)).first()[0] or 0
    grams = grams.withColumn("hashes", F.transform("gram", lambda w: F.xxhash64(w)))
    hashed = F.lit(None).cast("long")
    for n in lengths:
        hashed = F.when(F.col("length") == n, F.get(_runs("hashes", n), F.lit(0))).otherwise(hashed)
    grams = grams.select("item_id", "length", "gram", hashed.alias("hash"))
    grams = F.broadcast(grams) if size <= BROADCAST_BYTES else grams.hint("merge")
    scanned = _once(docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")), "text")
    scanned = scanned.select("doc_id", "text_hash", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # Windows of the first length come first, then those of the next.
    runs = F.concat(*[_runs("hashes", n) for n in lengths]) if lengths else F.array().cast("array<bigint>")
    scanned = scanned.select("doc_id", "text_hash", F.size("hashes").alias("n"), runs.alias("runs"))
    found = scanned.select("doc_id", "text_hash", "n", F.posexplode_outer("runs").alias("place", "hash")).join(grams, "hash")
    before, start = F.lit(0), F.lit(None).cast("int")
    for n in lengths:
        start = F.when(F.col("length") == n, F.col("place") - before).otherwise(start)
        before = before + F.greatest(F.col("n") - (n - 1), F.lit(0))
    found = found.withColumn("start", start).filter("start between 0 and n - length")
    return found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("item_id", "start", "length", "gram")).alias("found"))


def _hits(docs: DataFrame, benchmark: DataFrame, text: str, key: str) -> DataFrame:
    """Every row of ``docs`` as ``row``, with its ``words`` and ``hits``: the windows (item_id, start in
    words, length) that occur in it, checked word by word."""
    found = _candidates(docs, benchmark, text, key).alias("f")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("d"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    same = F.col("d").eqNullSafe(F.col("f.doc_id")) & (F.col("h") == F.col("f.text_hash"))
    joined = _once(rows.join(found.hint("merge"), same, "left").select("row", "t", "found"), "t")
    there = F.filter("found", lambda x: F.slice("words", x["start"] + 1, x["length"]) == x["gram"])
    hits = F.when(F.size(there) > 0, F.transform(there, lambda x: x.dropFields("gram")))
    return joined.select("row", "words", hits.alias("hits"))


def _covered(spans: Column) -> Column:
    """How many places the spans cover together."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["start"] + s["length"]).alias("end"),
        (acc["total"] + F.greatest(s["start"] + s["length"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("total"),
    )
    return F.aggregate(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["length"]))), begin, step, lambda acc: acc["total"])


def report(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Of every row: how many words it has, how many are hit, and by which items."""
    items = F.array_sort(F.transform(F.array_distinct("hits.item_id"), lambda i: i.cast("string")))
    zero = F.lit(0).cast("long")
    out = _hits(docs, benchmark, text, key).select(
        F.col(f"row.{key}").alias("doc_id"),
        F.size("words").cast("long").alias("n_words"),
        F.when(F.col("hits").isNull(), zero).otherwise(_covered(F.col("hits")).cast("long")).alias("n_hit"),
        F.when(F.col("hits").isNull(), zero).otherwise(F.size(items).cast("long")).alias("n_items"),
        F.sha2(F.coalesce(F.array_join(items, ","), F.lit("")), 256).alias("items_sha256"),
    )
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, benchmark: DataFrame, spans: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that have hits or, with ``spans``, without the hit words."""
    hits = _hits(docs, benchmark, text, key)
    if not spans:
        return hits.filter("hits is null").select("row.*")
    body = F.col(f"row.{text}")
    inside = lambda i: F.exists("hits", lambda s: (i >= s["start"]) & (i < s["start"] + s["length"]))
    shown = F.transform(F.array_remove(F.split(body, ANY_BETWEEN, -1), ""), lambda w, i: F.when(inside(i), F.lit("")).otherwise(w))
    gaps = F.split(body, f"[^{ANY_BETWEEN[1:]}", -1)
    without = F.array_join(F.zip_with(gaps, shown, lambda g, w: F.concat(g, F.coalesce(w, F.lit("")))), "")
    made = F.when(F.col("hits").isNull(), body).otherwise(without).alias(text)
    return hits.select(*[made if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])

"""Personal data by patterns, and terms that reveal it by information theory.

Base spans are e-mail addresses, IP addresses, card numbers that pass Luhn's check, and
phone numbers: leftmost matches that do not overlap within a kind; a match that fails its
check is dropped. Each found value is a protected entity. The words (runs of letters, however short or long) within
three words of an entity, in the same line, are terms of it; a run that goes over into the entity is no word. Over all documents, a term
discloses an entity if at least ``SUPPORT`` different texts have them together, if at least
``POSTERIOR`` of the texts that have the term have it next to the entity, and if their
pointwise mutual information, log2(n_both * N / (n_term * n_entity)), reaches ``REVEALED`` of the
entity's own bits, log2(N / n_entity), which a term that is always next to it has. So neither small tables nor
frequent entities rule terms out; of an entity that every text has, no term tells anything. Terms that disclose
an entity are spans wherever they stand, in all texts, unless inside a base span, and ``sanitised`` puts a
kind's name in the place of every span.
DataFrame expressions only: patterns run once over each text, places come from window sums
over the found parts, and only words that are some entity's term are counted.

Defined cases: a null text is empty; texts are searched whole; copies of a text count
once in the statistics; rows that repeat a doc_id are documents of their own, equal rows
have equal spans; a null doc_id is kept; other columns are not read by ``report`` and kept by ``sanitised``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the four kinds. Look-behinds and possessive repeats only spare
#: the matcher starts and steps that cannot succeed.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = r"\p{L}+"
NEAR_WORDS = 3
#: What stands up to the last of these words, from the start of a text or, of its reverse, from the end, in one line.
NEAR = r"^(?:[^\p{L}\n]*+\p{L}++){0,%d}" % NEAR_WORDS
SUPPORT, POSTERIOR, REVEALED = 2, 0.5, 0.5
BROADCAST_BYTES = 32 << 20
_MARK = "\u0001"


def _parts(text: Column, pattern: str) -> Column:
    """What lies between matches, and the matches, in turn; a mark inside the text counts as
    another character, which is in no pattern."""
    return F.split(F.regexp_replace(F.translate(text, _MARK, "\u0002"), pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(places, F.lit(0), step) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    small = lambda p: F.regexp_replace(p, "^0+", "")
    part = lambda p: (F.length(small(p)) <= 3) & (F.coalesce(F.try_to_number(F.right(F.concat(F.lit("000"), p), F.lit(3)), F.lit("999")), F.lit(0)) <= 255)
    return F.forall(F.split(value, r"\.", -1), part)


def _keyed(df: DataFrame, text: str, key: str) -> DataFrame:
    text = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def base_spans(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``text_hash``, ``kind`` (place in ``KINDS``), ``start``, ``end``, ``value``, and the text from the third word
    ``before`` and to the third ``after`` in the same line, of every distinct span."""
    body = F.col("text")

    def found(kind: str) -> Column:
        """Matches of a kind with the lengths up to them; null where there are none."""
        parts = _parts(body, PATTERNS[kind])
        hint = HINTS[kind]
        return F.when(F.instr(body, hint) > 0, parts) if hint else F.when(body.rlike("[0-9]"), parts)

    rows = _keyed(df, text, key).select("doc_id", "text_hash", F.array(*[found(k) for k in KINDS]).alias("kinds"))
    rows = rows.select("doc_id", "text_hash", F.posexplode("kinds").alias("kind", "parts")).filter("size(parts) > 1")
    size = F.size("parts")
    at = F.sequence(F.lit(2), size - 1, F.lit(2))
    # One struct for each match: what lies before it, itself, and what follows.
    near = F.transform(
        at,
        lambda i: F.struct(
            F.length(F.get("parts", i - 2)).alias("gap"),
            F.get("parts", i - 1).alias("value"),
            F.reverse(F.regexp_extract(F.reverse(F.substring_index(F.get("parts", i - 2), "\n", -1)), NEAR, 0)).alias("before"),
            F.regexp_extract(F.get("parts", i), NEAR, 0).alias("after"),
        ),
    )
    rows = rows.select("doc_id", "text_hash", "kind", near.alias("near"))
    rows = rows.select("doc_id", "text_hash", "kind", F.posexplode("near").alias("i", "x")).select("doc_id", "text_hash", "kind", "i", "x.*")
    rows = rows.distinct()  # equal rows of the input have equal spans
    order = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("i")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(order))
    passes = reduce(lambda c, k: c.when(F.col("kind") == k, _passes(KINDS[k], F.col("value"))), range(1, len(KINDS)), F.when(F.col("kind") == 0, F.lit(True)))
    return rows.filter(passes).select(
        "doc_id", "text_hash", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", "gap", "before", "after"
    )


def _terms(spans: DataFrame) -> DataFrame:
    """``entity``, ``term`` and its place, for the terms near every span."""
    entity = F.concat_ws(":", F.col("kind").cast("string"), F.when(F.col("kind") == 0, F.lower("value")).otherwise(_digits(F.col("value"))))

    def placed(side: Column, begin: Column) -> Column:
        """The words of a context that begins at ``begin``."""
        parts = _parts(side, TERM)
        at = F.filter(F.sequence(F.lit(1), F.size(parts)), lambda i: i % 2 == 0)
        return F.transform(
            at,
            lambda i: F.struct(
                F.lower(F.get(parts, i - 1)).alias("term"),
                (begin + F.aggregate(F.slice(parts, F.lit(1), i - 1), F.lit(0), lambda n, p: n + F.length(p))).alias("start"),
                F.length(F.get(parts, i - 1)).alias("length"),
            ),
        )

    start, end = F.col("start").cast("int"), F.col("end").cast("int")
    over = lambda edge: F.col("value").rlike(edge)
    before = F.filter(placed(F.col("before"), start - F.length("before")), lambda w: ~(over(r"^\p{L}") & (w["start"] + w["length"] == start)))
    after = F.filter(placed(F.col("after"), end), lambda w: ~(over(r"\p{L}$") & (w["start"] == end)))
    rows = spans.select("doc_id", "text_hash", entity.alias("entity"), F.explode(F.concat(before, after)).alias("w"))
    return rows.select("doc_id", "text_hash", "entity", "w.term", F.col("w.start").alias("start"), (F.col("w.start") + F.col("w.length")).alias("end"))


def _small(rows: DataFrame, size: Column) -> DataFrame:
    """``rows`` to join with: broadcast if their ``size`` allows."""
    there = rows.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(rows) if there <= BROADCAST_BYTES else rows.hint("merge")


def _disclosing(texts: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``disclosing`` returns, and ``text_hash`` and ``term`` of the texts that have a term in question."""
    both = terms.groupBy("entity", "term").agg(F.count_distinct("text_hash").alias("n_both")).filter(F.col("n_both") >= SUPPORT)
    # The texts that have a term near any entity are some of those that have it: already too many rule it out.
    near = terms.groupBy("term").agg(F.count_distinct("text_hash").alias("n_near"))
    both = both.join(near, "term").filter(F.col("n_both") >= POSTERIOR * F.col("n_near")).drop("n_near")
    both = common.written(both, "terms")
    names = _small(both.select("term").distinct(), F.octet_length("term") + 32)
    words = F.array_distinct(F.split("text", r"[^\p{L}]+", -1))
    each = texts.select("text_hash", F.explode(words).alias("word")).select("text_hash", F.lower("word").alias("term"))
    each = common.written(each.filter("term <> ''").join(names, "term").select("text_hash", "term"), "words")
    n_term = each.groupBy("term").agg(F.count_distinct("text_hash").alias("n_term"))
    n_entity = terms.groupBy("entity").agg(F.count_distinct("text_hash").alias("n_entity"))
    total = texts.agg(F.count_distinct("text_hash")).first()[0]
    found = both.join(n_term, "term").join(n_entity, "entity")
    bits = F.log2(F.col("n_both") * F.lit(float(total)) / (F.col("n_term") * F.col("n_entity")))
    own = F.log2(F.lit(float(total)) / F.col("n_entity"))
    reveals = (F.col("bits") > 0) & (F.col("bits") >= REVEALED * own) & (F.col("n_both") >= POSTERIOR * F.col("n_term"))
    return found.withColumn("bits", bits).filter(reveals), each


def disclosing(df: DataFrame, terms: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``entity``, ``term``, ``n_both``, ``n_term``, ``n_entity`` and ``bits`` of the terms that disclose."""
    return _disclosing(_keyed(df, text, key), terms)[0]


def _places(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``start`` and ``end`` of the words of every text that are in its ``terms``."""
    words = F.transform(
        _parts(F.col("text"), TERM),
        lambda p: F.when(F.array_contains("terms", F.lower(p)), F.concat(F.lit(_MARK), p, F.lit(_MARK))).otherwise(p),
    )
    rows = texts.join(hits, "text_hash").select("doc_id", "text_hash", F.split(F.array_join(words, ""), _MARK, -1).alias("parts"))
    at = F.sequence(F.lit(1), F.size("parts") - 1, F.lit(2))
    lengths = F.transform(
        at, lambda i: F.struct(F.length(F.get("parts", i - 1)).alias("gap"), F.length(F.get("parts", i)).alias("length"))
    )
    rows = rows.filter("size(parts) > 1").select("doc_id", "text_hash", F.posexplode(lengths).alias("i", "x"))
    rows = rows.select("doc_id", "text_hash", "i", "x.*").distinct()  # equal rows of the input have equal places
    end = F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy("doc_id", "text_hash").orderBy("i"))
    return rows.withColumn("end", end).select("doc_id", "text_hash", (F.col("end") - F.col("length")).alias("start"), "end")


def all_spans(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``text_hash`` and ``spans`` (start, kind, end; in order) of every document that has some;
    a disclosing term's kind follows the others."""
    base = common.written(base_spans(df, text, key), "spans")
    terms = common.written(_terms(base), "near")
    texts = _keyed(df, text, key)
    strong, each = _disclosing(texts, terms)
    strong = common.written(strong.select("term").distinct(), "strong")
    hits = each.join(_small(strong, F.octet_length("term") + 32), "term").groupBy("text_hash").agg(F.collect_set("term").alias("terms"))
    hits = common.written(hits, "hits")
    more = _places(texts, _small(hits, F.octet_length(F.array_join("terms", "")) + 32 * F.size("terms") + 32))
    fields = lambda rows, kind: rows.select("doc_id", "text_hash", F.col("start").cast("int"), kind.alias("kind"), F.col("end").cast("int"))
    every = fields(base, F.col("kind")).unionByName(fields(more, F.lit(len(KINDS))))
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    masked = F.max(F.when(F.col("kind") < len(KINDS), F.col("end"))).over(before)
    every = every.withColumn("masked", masked).filter((F.col("kind") < len(KINDS)) | F.col("masked").isNull() | (F.col("end") > F.col("masked")))
    spans = F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    return every.groupBy("doc_id", "text_hash").agg(spans)


def _with_spans(df: DataFrame, text: str, key: str) -> DataFrame:
    found = all_spans(df, text, key).alias("f")
    rows = df.select(F.struct("*").alias("row"), F.col(key).alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    same = F.col("d").eqNullSafe(F.col("f.doc_id")) & (F.col("h") == F.col("f.text_hash"))
    return rows.join(found, same, "left").select("row", "spans")


def report(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """How many base spans of each kind every row has, their digest, and all spans."""
    rows = _with_spans(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text", "doc_id")
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    shown = lambda spans: F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","), F.lit(""))
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    count = lambda k: F.coalesce(F.size(F.filter("spans", lambda s: s["kind"] == k)), F.lit(0)).cast("long")
    zero = F.lit(0).cast("long")
    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.greatest(count(i), zero).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )


def sanitised(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df`` with the name of its kind in the place of every span of ``text``; of spans that
    overlap, the first stands for both."""
    rows = _with_spans(df, text, key)
    body = F.col(f"row.{text}")
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in (*KINDS, "term")])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(body, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.get(names, s["kind"]))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    clean = F.aggregate("spans", begin, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))))
    made = F.when(F.col("spans").isNull(), body).otherwise(clean).alias(text)
    return rows.select(*[made if c == text else F.col(f"row.`{c}`").alias(c) for c in df.columns])

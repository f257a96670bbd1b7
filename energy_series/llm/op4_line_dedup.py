"""Line deduplication by a log-template tree of fixed depth.

A line is cut further after the end of a sentence, so that boilerplate inside a paragraph is
a record of its own. A record is parsed by a tree of fixed depth: its number of tokens,
then its twelve leading tokens, with runs of digits generalised; whatever follows is a
variable field, so records on one leaf have one template. A template recurs if enough
documents have it, and those are not all copies of one text: two documents where it has
eight tokens or more, ten where it has five to seven; shorter records always stay.
Recurring records are dropped everywhere but in one text, that of the smallest
MD5, so what they say is kept once. ``clean`` also cuts at the stops of Chinese and Japanese, and judges
runs: of a short record (under ``MANY_TOKENS`` tokens), the adjacent records from it on and those up to it that
weigh ``RUN`` words together; if another text has such a run, word for word (up to equal 64-bit hashes), all texts but the one of the
smallest MD5 lose the short record. A word weighs one, two characters of a script without blanks do, too. DataFrame expressions only; leaves are counted with
partial aggregates, so a template that a third of all documents share is no hot key.

Defined cases: a null text stays null and has no lines; a record counts once for a
document; equal texts share one fate; rows that repeat a doc_id are documents of their
own; empty tables give empty tables. ``clean`` returns the columns of its input, of any
names, with ``text`` cleaned, ``n_chars`` (where the input has it) following it, and without the
documents of which nothing is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

DEPTH = 12
#: Tokens from which a template may recur, and the documents that takes.
FEW_TOKENS, FEW_DOCUMENTS = 5, 10
MANY_TOKENS, MANY_DOCUMENTS = 8, 2
RUN = 8
MARK = "\u0001"
CUT = r"(?<=\n)|(?<=[.!?] )"
#: Stops that no blank follows, and characters of scripts without blanks.
STOPS = "。！？｡"
WIDE = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def records(text: Column, stops: str = "") -> Column:
    """The records of a text, cut at ``stops`` too; together they are the text. Marks put where ``CUT`` matches, by
    plain replacement, part most texts faster than the pattern, which serves those that have
    the mark."""
    marked = text
    for end in ("\n", ". ", "! ", "? ", *stops):
        marked = F.replace(marked, F.lit(end), F.lit(end + MARK))
    parts = F.when(F.instr(text, MARK) > 0, F.split(text, CUT + (f"|(?<=[{stops}])" if stops else ""), -1)).otherwise(F.split(marked, MARK, -1))
    return F.array_remove(parts, "")


def _leaf(record: Column) -> Column:
    """Hash of the path of a record without digits; 0 for records that cannot recur."""
    tokens = F.split(F.rtrim(record, F.lit(" \n")), " ", -1)
    path = F.xxhash64(F.size(tokens), F.slice(tokens, 1, DEPTH))
    few, many = path.bitwiseOR(F.lit(1)), path.bitwiseAND(F.lit(-2))  # the last bit tells the kinds apart
    return F.when(F.size(tokens) >= MANY_TOKENS, many).when(F.size(tokens) >= FEW_TOKENS, few).otherwise(F.lit(0))


def text_key(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def parsed(df: DataFrame, text: str = "text", stops: str = "") -> DataFrame:
    """``text_key`` and ``leaves`` (one for each record, in order) of every distinct text."""
    masked = F.regexp_replace(F.col(text), "[0-9]+", "0")
    rows = df.filter(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("text_key"), records(masked, stops).alias("records"))
    return rows.select("text_key", F.transform("records", _leaf).alias("leaves"))


def _recurring(leaves: DataFrame) -> DataFrame:
    """``leaf`` and ``kept``, the key of the text that keeps it."""
    each = leaves.select("text_key", F.explode(F.array_distinct("leaves")).alias("leaf")).filter("leaf <> 0")
    count = each.groupBy("leaf").agg(F.count("*").alias("n"), F.min("text_key").alias("kept"), F.max("text_key").alias("other"))
    need = F.when(F.col("leaf").bitwiseAND(F.lit(1)) == 0, MANY_DOCUMENTS).otherwise(FEW_DOCUMENTS)
    return count.filter((F.col("kept") < F.col("other")) & (F.col("n") >= need)).select("leaf", "kept")


def dropped(df: DataFrame, text: str = "text", stops: str = "") -> DataFrame:
    """``text_key`` and ``drop``, the leaves that a text loses, for every text that loses some."""
    leaves = common.written(parsed(df, text, stops), "leaves")
    each = leaves.select("text_key", F.explode(F.array_distinct("leaves")).alias("leaf")).filter("leaf <> 0")
    lost = each.join(_recurring(leaves), "leaf").filter("text_key <> kept")
    return lost.groupBy("text_key").agg(F.collect_set("leaf").alias("drop"))


def _weighed(all_records: Column) -> Column:
    """``i``, a hash ``body``, ``weight`` and whether it is ``short``, of every record that is not blank."""

    def words(record: Column, i: Column) -> Column:
        body = F.array_join(F.array_remove(F.split(record, r"\s+", -1), ""), " ")
        tokens = F.size(F.split(F.rtrim(record, F.lit(" \n")), " ", -1))
        return F.struct(i.alias("i"), body.alias("body"), (tokens < MANY_TOKENS).alias("short"))

    def weight(body: Column) -> Column:
        wide = F.when(F.octet_length(body) > F.length(body), F.length(body) - F.length(F.regexp_replace(body, WIDE, ""))).otherwise(0)
        return F.size(F.split(body, " ", -1)) + F.floor(wide / 2).cast("int")

    there = F.filter(F.transform(all_records, words), lambda x: x["body"] != "")
    hashed = lambda x: F.struct(x["i"].alias("i"), F.xxhash64(x["body"]).alias("body"), weight(x["body"]).alias("weight"), x["short"].alias("short"))
    return F.transform(there, hashed)


def _runs(xs: Column, own: Column) -> Column:
    """``i`` and ``runs`` (hashes) of every short record whose ``body`` is in ``own``."""

    def run(side: Column, back: bool) -> Column:
        """Hash of the first records of ``side`` that weigh ``RUN`` together, null if all don't; a condition, since a hash of a
        null is a number."""
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"))
        more = lambda acc, x: F.when(acc["w"] >= RUN, acc).otherwise(F.struct((acc["n"] + 1).alias("n"), (acc["w"] + x["weight"]).alias("w")))
        bodies = lambda n: F.transform(F.slice(side, F.lit(1), n), lambda y: y["body"])
        found = lambda n: F.xxhash64(F.reverse(bodies(n)) if back else bodies(n))
        return F.aggregate(side, start, more, lambda acc: F.when(acc["w"] >= RUN, found(acc["n"])))

    def one(x: Column, at: Column) -> Column:
        first = F.greatest(at + 2 - RUN, F.lit(1))
        ahead = run(F.slice(xs, at + 1, F.lit(RUN)), False)
        behind = run(F.reverse(F.slice(xs, first, at + 2 - first)), True)
        runs = F.array_compact(F.array(ahead, behind))
        return F.when(x["short"] & F.array_contains(own, x["body"]), F.struct(x["i"].alias("i"), runs.alias("runs")))

    return F.filter(F.transform(xs, one), lambda x: x.isNotNull() & (F.size(x["runs"]) > 0))


def dropped_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """``text_key`` and ``places``, the short records that a text loses since their runs recur, for every text that loses some.

    A run recurs only if its short record is in two texts, so runs are built for those records alone."""
    rows = df.filter(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("text_key"), _weighed(records(F.col(text), STOPS)).alias("xs"))
    rows = common.written(rows, "weighed")
    short = F.transform(F.filter("xs", lambda x: x["short"]), lambda x: x["body"])
    own = rows.select("text_key", F.explode(F.array_distinct(short)).alias("body"))
    in_two = own.groupBy("body").agg(F.min("text_key").alias("low"), F.max("text_key").alias("high")).filter("low < high").select("body")
    in_two = common.written(in_two, "in_two")  # so that the join may split a record
    own = own.join(in_two, "body").distinct().groupBy("text_key").agg(F.collect_list("body").alias("own"))
    runs = rows.join(own.hint("merge"), "text_key").select("text_key", F.explode(_runs(F.col("xs"), F.col("own"))).alias("x"))
    runs = common.written(runs.select("text_key", F.col("x.i").alias("i"), F.explode("x.runs").alias("run")), "runs")
    count = runs.groupBy("run").agg(F.min("text_key").alias("kept"), F.max("text_key").alias("other"))
    count = common.written(count.filter("kept < other").select("run", "kept"), "recurring")  # so that the join may split a run
    lost = runs.join(count, "run").filter("text_key <> kept").select("text_key", "i").distinct()
    return lost.groupBy("text_key").agg(F.collect_list("i").alias("places"))


def _split(df: DataFrame, text: str, runs: bool = False) -> DataFrame:
    """The rows of ``df`` as ``row``, with ``all`` records and those that are ``left``; a record at
    whose place the masked text has a dropped leaf is not left, nor, with ``runs``, one in a dropped run."""
    stops = STOPS if runs else ""
    lost = dropped(df, text, stops)
    if runs:
        lost = lost.join(dropped_runs(df, text), "text_key", "full")
        lost = lost.select("text_key", *[F.coalesce(c, F.array().cast(f"array<{t}>")).alias(c) for c, t in (("drop", "long"), ("places", "int"))])
    lost = lost.hint("merge")
    rows = df.select(F.struct("*").alias("row"), text_key(F.col(text)).alias("text_key"))
    joined = rows.join(lost, "text_key", "left")
    body = F.col(f"row.{text}")
    keep = lambda r: ~F.array_contains(F.col("drop"), _leaf(F.regexp_replace(r, "[0-9]+", "0")))
    if runs:
        places = F.col("places")
        joined = joined.select("row", "drop", "places", records(body, stops).alias("all"))
        left = F.filter("all", lambda r, i: keep(r) & ~F.array_contains(places, i))
        return joined.select("row", "all", F.when(F.col("drop").isNull(), F.col("all")).otherwise(left).alias("left"))
    joined = joined.select("row", "drop", records(body).alias("all"))
    return joined.select("row", "all", F.when(F.col("drop").isNull(), F.col("all")).otherwise(F.filter("all", keep)).alias("left"))


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with recurring records, and those of recurring runs, dropped, without documents that have nothing left but had
    something."""
    parts = _split(df, text, runs=True).filter((F.size("all") == 0) | (F.size("left") > 0) | F.col("all").isNull())
    body = F.array_join("left", "")
    parts = parts.select("row", body.alias("body"))
    made = {text: F.col("body")}
    if "n_chars" in df.columns and text == "text":
        made["n_chars"] = F.length("body").cast(df.schema["n_chars"].dataType)
    return parts.select(*[made[c].alias(c) if c in made else F.col(f"row.`{c}`").alias(c) for c in df.columns])


def report(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped``, ``n_chars`` and ``text_sha256`` of the cleaned text, of every row."""
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    rows = _split(df, text).select(
        F.col(f"row.{key}").alias("doc_id"),
        size("all").alias("n_lines"),
        (size("all") - size("left")).alias("n_dropped"),
        F.coalesce(F.array_join("left", ""), F.lit("")).alias("body"),
    )
    return rows.select("doc_id", "n_lines", "n_dropped", F.length("body").cast("long").alias("n_chars"), F.sha2("body", 256).alias("text_sha256"))

"""Licence scans by a trained paragraph classifier.

A line with a word of licences is a candidate; notices are looked for in it and, since they may be
wrapped, in the words of its paragraph (lines up to one without letters and digits, without comment marks)
that are next to it. The features of a text are those word pairs
and triples that some known notice has. A multinomial logistic regression tells the
families and the class ``unknown`` apart; it is fitted here, by Spark's own trainer, to notices inside
paragraphs of the corpus (families) and to such paragraphs and other notices (unknown),
a bounded sample: the ``SAMPLE`` paragraphs with the smallest hashes. A fifth of the examples
calibrates: a family needs a probability above what ``CALIBRATION`` of the unknown examples
reach. Classified are the whole line, and every run of words, some in the line, that has ``CONFIRM`` of the word
pairs of a notice, from its first to its last. Neighbours of a family differ in a word or a number, so a run must
have every pair of the notice with a name or a number in it, as they stand, must not be negated, and must not be next
to another version than the family's. A predicted family is confirmed by such a run of one of its
notices; a candidate has all families confirmed, or is unknown. DataFrame expressions only; scanning needs
no shuffle, and the weights are bounded by the notices.

Defined cases: a null or empty text has no candidates; texts are scanned whole; every
row gives one row, also where ids repeat or are null; other columns are not read; with
an empty table, the classifier is fitted to the notices alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
SAMPLE = 400
CALIBRATION, LEAST = 0.99, 0.5
CONFIRM = 0.8
#: Words on either side of a line: more than the longest notice has, with the quarter more that a run may have.
NEXT = 24
#: What notices of each family say.
NOTICES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
    ),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted",),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0",
        "licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "redistribute it and/or modify it under the terms of the GNU General Public License",
    ),
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ),
    "mpl-2.0": ("subject to the terms of the Mozilla Public License, v. 2.0",),
    "proprietary": ("All rights reserved",),
}
#: Notices of no known family.
OTHERS = (
    "Use of this text is governed by the licence agreement that comes with it",
    "licensed to the publisher under separate terms",
    "see the file LICENSE for details",
    "This copyright notice must stay",
)
#: Words that tell licences apart, as numbers do; words before a notice that turn it round.
NAMES = frozenset("apache attribution by cc commons creative general gnu mit mozilla nc noncommercial public".split())
NEGATIONS = ("not", "no", "never", "without")
#: The version of a family whose notices need not say it, and others of its kind.
VERSIONS = {"gpl-3.0": ("version 3", ("version 1", "version 2"))}
#: Parts of words and phrases, one of which every candidate has.
SIGNS = ("licens", "licence", "copyright", "rights reserved", "redistribut", "permission is", "permission to use")
FAMILIES = sorted(NOTICES)


def _plain(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _runs_of(words: list[str], sizes: tuple[int, ...] = (2, 3)) -> list[str]:
    return [" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)]


def _telling(notice: str) -> list[str]:
    """The word pairs of a notice that tell it from its neighbours."""
    pairs = sorted(set(_runs_of(_plain(notice), (2,))))
    return [p for p in pairs if any(w in NAMES or w.isdigit() for w in p.split())]


def vocabulary() -> list[str]:
    return sorted({g for notices in NOTICES.values() for n in notices for g in _runs_of(_plain(n))})


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " ", -1), "")


def _shifted(words: Column, n: int) -> Column:
    return F.slice(words, n + 1, F.greatest(F.size(words) - n, F.lit(0)))


def _pairs(words: Column) -> Column:
    """The word pairs, in order; the last has no second word."""
    return F.zip_with(words, _shifted(words, 1), lambda a, b: F.concat_ws(" ", a, b))


def _grams(words: Column) -> Column:
    """The distinct word pairs and triples."""
    pairs = _pairs(words)
    triples = F.zip_with(pairs, _shifted(words, 2), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(pairs, triples))


def _signed(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(s)) for s in SIGNS])


#: Comment marks that are letters, and signs of two words that a line break parts.
MARKS = r"(?i)^\s*(?:dnl\b|rem\b|c(?=\s{2}))"
PARTED = (("rights", "reserved"), ("permission", "is"))


def paragraphs(df: DataFrame, text: str, key: str) -> DataFrame:
    """``doc_id`` and ``paragraphs``, the candidates, of every row: the ``line`` and its words, and up to ``NEXT`` words
    ``before`` and ``after`` it."""
    body = F.coalesce(F.col(text), F.lit(""))
    parted = reduce(lambda a, b: a | b, [F.lower(body).rlike(rf"{x}[^a-z0-9]*\n[^a-z0-9]*{y}\b") for x, y in PARTED])
    plain = lambda line: F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), "[^a-z0-9]+", " "))
    lines = F.transform(F.split(body, "\n", -1), lambda line: F.struct(line.alias("line"), plain(line).alias("plain")))

    def words(side: Column) -> Column:
        return F.array_remove(F.split(side, "[ \n]+", -1), "")

    def candidates(all_lines: Column) -> Column:
        def signed(x: Column, i: Column) -> Column:
            following = F.coalesce(F.get(all_lines, i + 1)["plain"], F.lit(""))
            over = [x["plain"].rlike(rf"\b{a}$") & following.rlike(rf"^{b}\b") for a, b in PARTED]
            return F.when(reduce(lambda a, b: a | b, over, _signed(x["line"])), i)

        def placed(i: Column) -> Column:
            # Every line of a paragraph has a word, so as many lines as words are enough.
            side = lambda start, n: F.array_join(F.transform(F.slice(all_lines, start, n), lambda x: x["plain"]), "\n")
            first = F.greatest(i + 1 - NEXT, F.lit(1))
            before = words(F.substring_index(F.concat(side(first, i + 1 - first), F.lit("\n")), "\n\n", -1))
            after = words(F.substring_index(F.concat(F.lit("\n"), side(i + 2, F.lit(NEXT))), "\n\n", 1))
            n = F.least(F.size(before), F.lit(NEXT))
            x = F.get(all_lines, i)
            return F.struct(
                x["line"].alias("line"),
                words(x["plain"]).alias("words"),
                F.slice(before, F.size(before) - n + 1, n).alias("before"),
                F.slice(after, F.lit(1), F.lit(NEXT)).alias("after"),
            )

        return F.transform(F.filter(F.transform(all_lines, signed), lambda i: i.isNotNull()), placed)

    found = F.when(_signed(body) | parted, F.get(F.transform(F.array(lines), candidates), F.lit(0)))
    kind = "array<struct<line:string,words:array<string>,before:array<string>,after:array<string>>>"
    return df.select(F.col(key).alias("doc_id"), F.coalesce(found, F.array().cast(kind)).alias("paragraphs"))


def _fitting(words: Column, pairs: Column, begin: Column, end: Column, family: str, notice: str) -> Column:
    """``backed``, the family, and ``words`` of the runs that have enough of a notice's word pairs, one of them with a word from
    ``begin`` to before ``end``."""
    own = sorted(set(_runs_of(_plain(notice), (2,))))
    length = len(_plain(notice))
    reach = length - 2 + length // 4
    is_own = lambda pair: F.array_contains(_literals(own), pair)
    telling = _telling(notice)

    def enough(hits: Column) -> Column:
        found = F.array_distinct(F.transform(hits, lambda h: F.get(pairs, h)))
        most = F.size(found) / F.lit(len(own)) >= CONFIRM
        return most & (F.size(F.array_intersect(found, _literals(telling))) == len(telling)) if telling else most

    negated = lambda near: F.coalesce(F.get(words, near[0] - 1).isin(*NEGATIONS), F.lit(False))
    other = F.lit(False)
    if family in VERSIONS:
        own_version, others = VERSIONS[family]
        other = F.arrays_overlap(pairs, _literals(list(others))) & ~F.array_contains(pairs, own_version)
    in_line = lambda hits: F.exists(hits, lambda h: (h >= begin - 1) & (h < end))

    def runs(hits: Column) -> Column:
        near = F.transform(hits, lambda s: F.filter(F.sequence(s, s + reach), lambda i: is_own(F.get(pairs, i))))
        piece = lambda near: F.slice(words, near[0] + 1, F.element_at(near, -1) - near[0] + 2)
        fits = F.filter(near, lambda near: enough(near) & in_line(near) & ~negated(near) & ~other)
        return F.transform(fits, lambda near: F.struct(F.array(F.lit(family)).alias("backed"), piece(near).alias("words")))

    hits = F.filter(F.transform(pairs, lambda p, i: F.when(is_own(p), i)), lambda i: i.isNotNull())
    return F.flatten(F.transform(F.filter(F.array(hits), enough), runs))


def _runs(x: Column) -> Column:
    """``backed`` and ``words`` of the runs of words in and next to a candidate that fit a notice; the line itself
    is the first, backed by the families of all of them."""

    def with_line(found: Column) -> Column:
        families = F.flatten(F.transform(found, lambda r: r["backed"]))
        return F.concat(F.array(F.struct(families.alias("backed"), _words(x["line"]).alias("words"))), found)

    def of(words: Column) -> Column:
        begin = F.size(x["before"])
        end = begin + F.size(x["words"])
        known = [(family, notice) for family, notices in NOTICES.items() for notice in notices]
        found = lambda pairs: F.concat(*[_fitting(words, pairs, begin, end, *k) for k in known])
        return F.get(F.transform(F.transform(F.array(_pairs(words)), found), with_line), F.lit(0))

    return F.get(F.transform(F.array(F.concat(x["before"], x["words"], x["after"])), of), F.lit(0))


def _literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


class Classifier:
    """Weights of every gram for each class, and the calibrated least probability."""

    def __init__(self, weights: dict[str, list[float]], bias: list[float], least: float) -> None:
        self.weights, self.bias, self.least = weights, bias, least

    def families(self, candidate: Column) -> Column:
        """The families confirmed of one candidate, a struct of ``paragraphs``."""
        table = F.create_map(*[x for g, w in self.weights.items() for x in (F.lit(g), F.array(*map(F.lit, w)))])
        known = _literals(list(self.weights))
        runs = F.transform(_runs(candidate), lambda r: F.struct(r["backed"].alias("backed"), _grams(r["words"]).alias("grams")))

        def classed(r: Column) -> Column:
            start = F.array(*map(F.lit, self.bias))
            logits = F.aggregate(
                F.array_intersect(r["grams"], known), start, lambda acc, g: F.zip_with(acc, F.element_at(table, g), lambda a, b: a + b)
            )
            return F.struct(r["backed"].alias("backed"), logits.alias("logits"))

        names = _literals([*FAMILIES, UNKNOWN])

        def decided(x: Column) -> Column:
            top = F.array_max(x["logits"])
            total = F.aggregate(x["logits"], F.lit(0.0), lambda a, v: a + F.exp(v - top))
            name = F.element_at(names, F.array_position(x["logits"], top).cast("int"))
            return F.struct(x["backed"].alias("backed"), name.alias("name"), (F.lit(1.0) / total).alias("probability"))

        def confirmed(x: Column) -> Column:
            fits = F.array_contains(x["backed"], x["name"])
            return F.when(fits & (x["probability"] >= self.least), x["name"])

        names_of = F.transform(F.transform(F.transform(runs, classed), decided), confirmed)
        return F.array_distinct(F.filter(names_of, lambda n: n.isNotNull()))


def examples(df: DataFrame, text: str = "text") -> DataFrame:
    """``grams``, ``label`` (place in the families, then unknown) and ``check`` of the examples."""
    spark = df.sparkSession
    lines = df.select(F.explode(F.split(F.col(text), "\n", -1)).alias("line")).filter("length(line) between 20 and 400")
    lines = lines.filter(~_signed(F.col("line"))).select(F.xxhash64("line").alias("h"), "line").distinct()
    lines = lines.orderBy("h", "line").limit(SAMPLE).select("line")
    lines = lines.union(spark.range(1).select(F.lit("").alias("line")))  # notices by themselves
    rows = [(FAMILIES.index(f), n) for f, notices in NOTICES.items() for n in notices]
    rows += [(len(FAMILIES), n) for n in (*OTHERS, "", "")]
    notices = F.explode(F.array(*[F.struct(F.lit(float(k)).alias("label"), F.lit(n).alias("notice")) for k, n in rows])).alias("n")
    made = lines.select("line", notices).select("line", "n.*", F.xxhash64("line", "n.notice").alias("h"))
    # One in eight lines takes each notice; the notice stands before, inside or after.
    made = made.filter((F.pmod("h", F.lit(8)) == 0) | (F.col("line") == ""))
    half = (F.length("line") / 2).cast("int")
    place = F.pmod(F.shiftright("h", 8), F.lit(3))
    whole = (
        F.when(place == 0, F.concat_ws(" ", "notice", "line"))
        .when(place == 1, F.concat_ws(" ", F.left("line", half), "notice", F.substring("line", half + 1, F.lit(400))))
        .otherwise(F.concat_ws(" ", "line", "notice"))
    )
    check = F.pmod(F.shiftright("h", 16), F.lit(5)) == 0
    return made.select(whole.alias("paragraph"), "label", (check & (F.col("line") != "")).alias("check"))


def trained(df: DataFrame, text: str = "text") -> Classifier:
    """The classifier for notices amid paragraphs of ``df``; all that reaches the driver is bounded
    by the notices."""
    known = vocabulary()
    rows = examples(df, text).select("label", "check", F.explode(F.array(_words(F.col("paragraph")))).alias("words"))
    rows = rows.select("label", "check", F.explode(F.array(_grams(F.col("words")))).alias("grams"))
    there = F.array(*[F.array_contains("grams", g).cast("double") for g in known])
    rows = rows.select("label", "check", array_to_vector(there).alias("features")).coalesce(1).cache()
    model = LogisticRegression(maxIter=100, regParam=1e-3, family="multinomial").fit(rows.filter("not check"))
    scored = model.transform(rows.filter("check")).select("label", vector_to_array("probability").alias("p"))
    best = F.array_max(F.slice("p", 1, len(FAMILIES)))
    reach = scored.filter(F.col("label") == len(FAMILIES)).agg(F.percentile(best, CALIBRATION)).first()[0]
    rows.unpersist()
    weights = model.coefficientMatrix.toArray()
    bias = [float(b) for b in model.interceptVector.toArray()]
    return Classifier({g: [float(w) for w in weights[:, i]] for i, g in enumerate(known)}, bias, max(LEAST, min(reach or LEAST, 0.99)))


def report(df: DataFrame, classifier: Classifier, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_candidates``, ``licences`` (confirmed families, sorted, joined by commas) and ``n_unknown`` of every row."""
    rows = paragraphs(df, text, key)
    found = F.transform("paragraphs", classifier.families)
    rows = rows.select("doc_id", F.size("paragraphs").cast("long").alias("n_candidates"), F.when(F.size("paragraphs") > 0, found).alias("found"))
    found = F.coalesce("found", F.array().cast("array<array<string>>"))
    return rows.select(
        "doc_id",
        "n_candidates",
        F.array_join(F.array_sort(F.array_distinct(F.flatten(found))), ",").alias("licences"),
        F.size(F.filter(found, lambda f: F.size(f) == 0)).cast("long").alias("n_unknown"),
    )

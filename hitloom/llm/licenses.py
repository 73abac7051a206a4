"""License scan with ordered signature rules.

A text is reduced to its words in lower case, one space apart.  Cheap stems
decide whether it is looked at further; then each rule's keyword decides
whether its pattern is tried.  Matches are intervals of words.  One that lies
within another of the same or a better priority is dropped (equal intervals:
the better priority, then the earlier rule stays); so "GNU General Public
License, version 2" is one detection, not three.

All of it is DataFrame functions on one row at a time: nothing is shuffled.
Matches are sorted once and swept with one furthest end for each priority.

Defined results: a null text is an empty text; whole texts are searched;
repeated rows come back as often as they came; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .license_rules import parsed

BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))  # fixed values
CONFIDENCE = {1: 1.0, 2: 0.9, 3: 0.6, 4: 0.3}
# Every keyword holds one of these.
STEMS = ("licen", "identifier", "gpl", "bsd", "public domain", "publicdomain", "permission", "neither the name", "redistribution",
         "advertising", "perl itself", "unencumbered", "provided as is", "mpl", "asl 2", "apache 2", "apache v", "cc0", "cc by", "cdla",
         "rights reserved", "terms of use", "rail", "creative commons", "mit no attribution", "eclipse org",
         "under mit", "under the mit", "terms of the mit")

_NOT_WORD = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def license_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z in lower case."""
    flat = F.translate(text, _UPPER + _NOT_WORD, _UPPER.lower() + " " * len(_NOT_WORD))
    return F.filter(F.split(flat, " "), lambda w: w != F.lit(""))


def _places(words: Column, line: Column, phrase: str) -> Column:
    """Starts of a phrase's words."""
    parts = phrase.split()

    def at(i: Column) -> Column:
        ok = F.lit(True)
        for k, p in enumerate(parts):
            ok = ok & (F.get(words, i + k) == p)
        return ok

    return F.when(F.contains(line, F.lit(f" {phrase} ")),
                  F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), at)).otherwise(F.array().cast("array<int>"))


def _rules_column(rules: list[tuple[str, int, str, str]]) -> Column:
    return F.array(*[F.struct(F.lit(label).alias("label"), F.lit(priority).alias("priority"), F.lit(i).alias("rule"),
                              F.lit(keyword).alias("keyword"), F.lit(f"(?<= )(?:{pattern})(?= )").alias("pattern"))
                     for i, (label, priority, keyword, pattern) in enumerate(rules)])


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _matches(line: Column, rule: Column) -> Column:
    """Intervals of words (start, end) that a rule matches.

    Splitting at the pattern gives what stands between the matches: a gap of
    s spaces holds s - 1 words, a match of s spaces s + 1.
    """
    found = F.regexp_extract_all(line, rule["pattern"], F.lit(0))
    gaps = F.split(line, rule["pattern"])
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(
        (_spaces(g) - 1).alias("skip"), (_spaces(m) + 1).alias("take")))
    none = F.array().cast("array<struct<start:int,stop:int,priority:int,rule:int,label:string>>")
    return F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["skip"] + s["take"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + s["skip"]).alias("start"), (-(acc["at"] + s["skip"] + s["take"])).alias("stop"),
                rule["priority"].alias("priority"), rule["rule"].alias("rule"), rule["label"].alias("label")))).alias("spans")),
        lambda acc: acc["spans"])


def _sweep(spans: Column) -> Column:
    """Drop intervals that lie in others of at least their priority; ``spans`` sorted, longer first."""
    ends = F.array(*[F.lit(-1)] * len(CONFIDENCE))
    none = F.array().cast("array<struct<start:int,stop:int,priority:int,rule:int,label:string>>")

    def one(acc: Column, s: Column) -> Column:
        inside = F.get(acc["ends"], s["priority"] - 1) >= -s["stop"]
        return F.when(inside, acc).otherwise(F.struct(
            F.transform(acc["ends"], lambda e, p: F.when(p + 1 >= s["priority"], F.greatest(e, -s["stop"])).otherwise(e)).alias("ends"),
            F.concat(acc["kept"], F.array(s)).alias("kept")))

    return F.aggregate(spans, F.struct(ends.alias("ends"), none.alias("kept")), one, lambda acc: acc["kept"])


def scan_licenses(docs: DataFrame, rules: list[tuple[str, int, str, str]] | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``docs`` (text and ``keep``) -> ``keep``, n_words, n_base, first_word, last_word, base_labels, labels,
    score, detections (label, priority, start, stop: word interval, stop not included)."""
    line, words = F.col("_line"), F.col("_words")
    wide = docs.select(*keep, license_words(text_or_empty("text")).alias("_words"))
    wide = wide.withColumn("_line", F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")))
    base = [(_places(words, line, phrase), label) for phrase, label in BASE]
    wide = wide.withColumn("_base", F.array(*[F.struct(F.lit(label).alias("label"), p.alias("at")) for p, label in base]))
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.contains(line, F.lit(stem))
    tried = F.filter(_rules_column(rules or parsed()), lambda r: F.contains(line, r["keyword"]))
    spans = F.when(gate, F.array_sort(F.flatten(F.transform(tried, lambda r: _matches(line, r)))))
    wide = wide.withColumn("_spans", _sweep(F.coalesce(
        spans, F.array().cast("array<struct<start:int,stop:int,priority:int,rule:int,label:string>>"))))
    places = F.flatten(F.transform("_base", lambda b: b["at"]))
    base_labels = F.transform(F.filter("_base", lambda b: F.size(b["at"]) > 0), lambda b: b["label"])
    levels = F.transform("_spans", lambda s: s["priority"])
    trust = F.lit(0.0)
    for priority, value in sorted(CONFIDENCE.items(), reverse=True):
        trust = F.when(F.array_contains(levels, priority), F.lit(value)).otherwise(trust)
    sorted_labels = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return wide.select(
        *keep, F.size(words).cast("long").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        sorted_labels(base_labels).alias("base_labels"),
        sorted_labels(F.concat(base_labels, F.transform("_spans", lambda s: s["label"]))).alias("labels"),
        trust.alias("score"),
        F.transform("_spans", lambda s: F.struct(s["label"].alias("label"), s["priority"].alias("priority"),
                                                 s["start"].alias("start"), (-s["stop"]).alias("stop"))).alias("detections"))

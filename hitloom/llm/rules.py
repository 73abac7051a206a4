"""Quality rules with thresholds that adapt to each language and source.

Every document is measured with whole numbers (shares in thousandths).  A
quantile sketch per language, source and measure replaces fixed cutoffs: a
histogram over logarithmic buckets (32 to each power of two, so a quantile is
off by at most about 3 %), whose counts simply add up.  Sketches of a language
and source therefore merge into one per language and one for everything.  A
pair's quartiles are its own, shrunk toward its language's, and these toward those
of everything: the wider ones weigh as much as ``prior_docs`` documents, at every size.

The upper fence of a measure is q75 + reach * max(q75 - q25, least spread);
mean word length also has a lower fence.  A document is kept if it passes the
base rules and no measure lies beyond its fence.

All of it is DataFrame functions.  Hot languages or sources are combined
map-side into a few hundred counts, and fences are joined back by key: Spark
broadcasts them only below its size threshold and otherwise splits skewed keys.

Defined results: a null text has no words; null languages and sources form
groups of their own; repeated rows each count and each come back; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE_SPACE, cut, text_or_empty, word_array

SYMBOLS = "#*$%&|<>"  # fixed value
LEAST_WORDS = 10
REPEAT_PERCENT = 20
WINDOW_WORDS = 5
PRIOR_DOCS = 20
REACH = 3
# Least spread of each measure, so that a group whose documents all agree does
# not throw out the first that differs: (measure, spread, has a lower fence).
MEASURES = (("word_length", 1000, True), ("symbol_share", 40, False), ("capital_share", 40, False),
            ("shout_share", 40, False), ("dup_line_share", 150, False))  # repeated words are the base rule's own


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def repeat_words(words: Column, size: int = WINDOW_WORDS) -> Column:
    """Words that lie in a ``size``-word window found twice or more in the text.

    Windows are compared by 64-bit hash.  Only a text with a repeat sorts its
    windows; equal neighbours in that order give the repeated places.
    """
    count = F.size(words)
    windows = F.when(count >= size, F.transform(
        F.sequence(F.lit(0), count - size),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = _with(ordered, lambda s: F.array_sort(F.array_distinct(F.flatten(F.filter(
            F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))),
            lambda pair: pair.isNotNull())))))
        return _with(places, lambda p: F.lit(size) + F.aggregate(
            F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: F.least(b - a, F.lit(size))),
            F.lit(0), lambda total, step: total + step))

    return _with(windows, lambda hashes: F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(hashes))
                 .otherwise(0)).cast("long")


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, the base counts, base_failed and one column per measure."""
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, WHITE_SPACE, "")) > 0)
    wide = docs.withColumn("_text", text_or_empty("text"))
    wide = wide.withColumns({"_words": word_array(text), "_lines": lines})
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    wide = wide.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(text, WHITE_SPACE, "")).cast("long"),
        "n_symbols": _count_of(text, SYMBOLS),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeat_words(F.col("_words")),
        "_n_lines": F.size("_lines").cast("long"),
        "_n_capitals": _count_of(text, capitals), "_n_shouts": _count_of(text, "!"),
    })

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.expr(f"1000 * `{part}` div `{whole}`")).otherwise(F.lit(0)).cast("long")

    wide = wide.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
        "word_length": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "n_words"), "capital_share": share("_n_capitals", "word_chars"),
        "shout_share": share("_n_shouts", "n_words"), "dup_line_share": share("n_dup_lines", "_n_lines"),
    })
    return wide.drop("_text", "_words", "_lines", "_n_lines", "_n_capitals", "_n_shouts")


def bucket(value: Column) -> Column:
    """Whole number >= 0 -> smallest number of its bucket; below 64 every number has its own."""
    # Down to six leading binary digits.
    low = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(wide: DataFrame) -> DataFrame:
    """Mergeable quantile sketches: lang, source, measure, bucket, n."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket"))
                                for m, _, _ in MEASURES]))
    return (wide.select("lang", "source", pairs.alias("p")).select("lang", "source", "p.*")
            .groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n")))


def _quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the sketches up to ``keys``; the buckets that hold the quartiles."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy(*keys, "measure").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    of_all = Window.partitionBy(*keys, "measure")
    ranked = merged.withColumn("below", F.sum("n").over(up_to)).withColumn("docs", F.sum("n").over(of_all))
    return ranked.groupBy(*keys, "measure").agg(
        F.max("docs").alias("docs"),
        F.min(F.when(4 * F.col("below") >= F.col("docs"), F.col("bucket"))).alias("q25"),
        F.min(F.when(4 * F.col("below") >= 3 * F.col("docs"), F.col("bucket"))).alias("q75"))


def fences(sketch: DataFrame, prior_docs: int = PRIOR_DOCS, reach: int = REACH) -> DataFrame:
    """One row for each language and source: the fences of every measure."""
    own, by_lang, everything = (_quantiles(sketch, k) for k in (["lang", "source"], ["lang"], []))
    own = own.select("lang", "source", "measure", *[F.col(c).alias(f"own_{c}") for c in ("docs", "q25", "q75")])
    by_lang = by_lang.select(F.col("lang").alias("_lang"), F.col("measure").alias("_measure"),
                             *[F.col(c).alias(f"lang_{c}") for c in ("docs", "q25", "q75")])
    everything = everything.select(F.col("measure").alias("_m"), *[F.col(c).alias(f"all_{c}") for c in ("q25", "q75")])
    chosen = (own.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_measure")))
              .join(everything, F.col("measure") == F.col("_m")))

    def pick(c: str) -> Column:
        wider = f"((lang_docs * lang_{c} + {int(prior_docs)} * all_{c}) div (lang_docs + {int(prior_docs)}))"
        return F.expr(f"(own_docs * own_{c} + {int(prior_docs)} * {wider}) div (own_docs + {int(prior_docs)})")

    chosen = chosen.select("lang", "source", "measure", pick("q25").alias("q25"), pick("q75").alias("q75"))
    limits = []
    for m, spread, two_sided in MEASURES:
        here = F.col("measure") == m
        gap = F.lit(reach) * F.greatest(F.col("q75") - F.col("q25"), F.lit(spread))
        limits.append(F.max(F.when(here, F.col("q75") + gap)).alias(f"{m}_most"))
        if two_sided:
            limits.append(F.max(F.when(here, F.col("q25") - gap)).alias(f"{m}_least"))
    return chosen.groupBy("lang", "source").agg(*limits)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _judged(docs: DataFrame, row: list[str], prior_docs: int, reach: int) -> DataFrame:
    """The columns ``row`` as one struct of that name (so that none clashes), counts, kept, reasons."""
    names = [m for m, _, _ in MEASURES]
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in row]).alias("row"), "lang", "source", "text")
    wide = cut(measured(plain).select("row", "lang", "source", *COUNTS, *names), "measured")
    limits = cut(fences(sketches(wide), prior_docs, reach)
                 .withColumnsRenamed({"lang": "_lang", "source": "_source"}), "fences")
    beyond = [F.when((F.col(m) > F.col(f"{m}_most")) | ((F.col(m) < F.col(f"{m}_least")) if two_sided else F.lit(False)), F.lit(m))
              for m, _, two_sided in MEASURES]
    joined = wide.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    return (joined.withColumn("reasons", F.array_join(F.array_compact(F.array(*beyond)), ","))
            .withColumn("kept", ~F.col("base_failed") & (F.col("reasons") == "")))


def quality_rules(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), prior_docs: int = PRIOR_DOCS, reach: int = REACH) -> DataFrame:
    """``docs`` (text, lang, source and the columns ``keep``) -> ``keep``, the counts,
    base_failed, kept and ``reasons`` (measures beyond a fence)."""
    return _judged(docs, list(keep), prior_docs, reach).select("row.*", *COUNTS, "kept", "reasons")


def kept_documents(docs: DataFrame, prior_docs: int = PRIOR_DOCS, reach: int = REACH) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return _judged(docs, docs.columns, prior_docs, reach).where("kept").select("row.*")

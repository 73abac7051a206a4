"""Quality classifier with hierarchical empirical Bayes.

A logistic regression over counts of a text gives each document a likelihood
ratio for being good.  Hosts and their paths give it a prior: the share of good
documents around it, where labelled documents count by label and all others by
their classifier probability.  A path's share is shrunk toward its host's and
a host's toward the share of all documents; how strongly follows from the
spread between hosts (and between paths of a host), estimated by moments.

    host  = (good_host - own + k_host * all)  / (docs_host - 1 + k_host)
    path  = (good_path - own + k_path * host) / (docs_path - 1 + k_path)
    logit(score) = logit(path) + classifier log likelihood ratio

An unlabelled document's probability in turn depends on its path's share, so
shares and probabilities are worked out ``ROUNDS`` times (expectation
maximisation).  A document's own label or probability is taken out of its
prior, so that no evidence counts twice.

One grouped aggregation over all documents, combined map-side, counts them by
host, path, label and ratio to a quarter; the rounds run on those counts.  Only
the regression is fitted on the driver, on at most ``fit_rows`` labelled
documents, the first in order of a hash of doc_id.

Defined results: a null text has no words; null hosts and paths are groups of
their own; labels that are null or of unknown documents are not used, several
labels of a document count as their largest; without labels of both kinds the
classifier says nothing (ratio 0); repeated rows each count and each come
back; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

FIT_ROWS = 20_000
FEATURES = ("log_words", "word_bytes", "symbols", "capitals", "shouts", "bars", "digits", "short_words", "new_words", "dup_lines")
HASH_PLACES = 1 << 40
RIDGE = 1.0
ROUNDS = 3
CLIP = 1e-6


def features(text: bytes | None) -> tuple[float, ...]:
    """Counts of a UTF-8 text, as shares."""
    text = text or b""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    rest = text.translate(None, b"#*$%&|<>")
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (np.log1p(len(words)), sum(map(len, words)) / n, (len(text) - len(rest)) / n,
            (len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / size, text.count(b"!") / n, text.count(b"|") / n,
            (len(text) - len(text.translate(None, b"0123456789"))) / size, sum(len(w) <= 3 for w in words) / n,
            len(set(words)) / n, (len(lines) - len(set(lines))) / max(1, len(lines)))


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts], dtype=object)

    return measure(text.cast("binary"))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 50) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression by Newton steps, for unscaled columns."""
    middle, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z = np.column_stack(((x - middle) / scale, np.ones(len(x))))
    w, penalty = np.zeros(z.shape[1]), np.diag([ridge] * x.shape[1] + [1e-9])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * middle / scale).sum())


def _classifier(measured: DataFrame, labels: DataFrame, fit_rows: int) -> tuple[list[float], float]:
    """Weights and intercept of the log likelihood ratio; the training share is taken out."""
    known = measured.where("label is not null")
    # A hash below this mark takes about fit_rows rows, however many tasks there
    # are; a sorted limit would send that many from each task.
    taken = min(1.0, 1.05 * fit_rows / max(1, known.count()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(HASH_PLACES))
    rows = known.where(place < F.lit(int(taken * HASH_PLACES))).select("features", "label", place.alias("place"), "doc_id").toPandas()
    rows = rows.sort_values(["place", "doc_id"]).head(fit_rows)
    if rows.empty or rows["label"].nunique() < 2:
        return [0.0] * len(FEATURES), 0.0
    y = rows["label"].to_numpy(float)
    w, b = fit_logistic(np.stack(rows["features"].to_numpy()), y)
    return [float(v) for v in w], b - float(np.log(y.mean() / (1 - y.mean())))


def _strength(groups: DataFrame, mean: Column, good: str, docs: str) -> float:
    """Documents that a group's prior is worth: within variance over between variance, by moments."""
    n, share = F.col(docs), F.col(good) / F.col(docs)
    got = groups.agg(F.sum(n * (share - mean) * (share - mean)).alias("q"), F.count("*").alias("groups"), F.sum(n).alias("docs"),
                     F.sum(n * n).alias("squares"), F.sum(n * mean * (1 - mean)).alias("within")).first()
    if not got.docs or got.groups < 2:
        return 1e6
    within = got.within / got.docs
    between = (got.q - (got.groups - 1) * within) / max(1e-9, got.docs - got.squares / got.docs)
    return float(min(1e6, max(1.0, within / between - 1))) if between > 0 else 1e6


def site_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, fit_rows: int = FIT_ROWS,
                 threshold: float = 0.5) -> DataFrame:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, quality) -> doc_id, host, path, evidence (log likelihood
    ratio), host_share, path_share (both without the document), score, kept."""
    truth = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg((F.max("quality") > 0).cast("double").alias("label")))
    plain = docs.select("doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"),
                        feature_column(F.col("text")).alias("features"))
    measured = cut(plain.join(truth, "doc_id", "left"), "features")
    weights, intercept = _classifier(measured, labels, fit_rows)
    evidence = F.lit(intercept)
    for i, w in enumerate(weights):
        evidence = evidence + F.get("features", F.lit(i)) * F.lit(w)
    share = measured.agg(F.avg("label")).first()[0]
    start = min(1 - CLIP, max(CLIP, 0.5 if share is None else share))
    judged = (measured.withColumn("evidence", F.least(F.greatest(evidence, F.lit(-30.0)), F.lit(30.0)))
              .withColumn("near", F.round(F.col("evidence") * 4) / 4).drop("features"))
    counts = cut(judged.groupBy("host", "path", "label", "near").agg(F.count("*").alias("n")), "counts")
    sites = cut(counts.select("host", "path").distinct().withColumn("prior", F.lit(start)), "sites")
    for _ in range(ROUNDS):
        sites, overall, k_host, k_path = _shares(counts, sites)
    found = _at_site(judged, sites).withColumn("own", _own())
    host_share = (F.col("good_host") - F.col("own") + k_host * overall) / (F.col("docs_host") - 1 + k_host)
    found = found.withColumn("host_share", _inside(host_share))
    path_share = (F.col("good_path") - F.col("own") + k_path * F.col("host_share")) / (F.col("docs_path") - 1 + k_path)
    found = found.withColumn("path_share", _inside(path_share)).withColumn("score", F.round(_chance(F.col("evidence"), F.col("path_share")), 9))
    return found.select("doc_id", "host", "path", F.round("evidence", 9).alias("evidence"), F.round("host_share", 9).alias("host_share"),
                        F.round("path_share", 9).alias("path_share"), "score", (F.col("score") >= threshold).alias("kept"))


def _inside(share: Column) -> Column:
    return F.least(F.greatest(share, F.lit(CLIP)), F.lit(1 - CLIP))


def _chance(evidence: Column, prior: Column) -> Column:
    return 1 / (1 + F.exp(-(evidence + F.ln(prior / (1 - prior)))))


def _own() -> Column:
    """How good a document counts: its label, else its probability at the prior of its path."""
    return F.coalesce("label", _chance(F.col("near"), F.col("prior")))


def _at_site(rows: DataFrame, sites: DataFrame) -> DataFrame:
    named = sites.withColumnsRenamed({"host": "_host", "path": "_path"})
    return rows.join(named, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))).drop("_host", "_path")


def _shares(counts: DataFrame, sites: DataFrame) -> tuple[DataFrame, float, float, float]:
    """One round: the sums of each path and host under the priors of the round before, and the new priors.

    ``prior`` stays the one that the sums were made with, ``next`` is the new one.
    """
    if "next" in sites.columns:
        sites = sites.select("host", "path", F.col("next").alias("prior"))
    paths = cut(_at_site(counts, sites).groupBy("host", "path", "prior")
                .agg(F.sum(F.col("n") * _own()).alias("good_path"), F.sum("n").alias("docs_path")), "paths")
    hosts = cut(paths.groupBy("host").agg(F.sum("good_path").alias("good_host"), F.sum("docs_path").alias("docs_host")), "hosts")
    total = hosts.agg(F.sum("good_host"), F.sum("docs_host")).first()
    overall = min(1 - CLIP, max(CLIP, total[0] / total[1])) if total[1] else 0.5
    k_host = _strength(hosts, F.lit(overall), "good_host", "docs_host")
    of_host = hosts.withColumnRenamed("host", "_host")
    sites = cut(paths.join(of_host, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
                .withColumn("host_mean", _inside((F.col("good_host") + k_host * overall) / (F.col("docs_host") + k_host))), "sites")
    k_path = _strength(sites, F.col("host_mean"), "good_path", "docs_path")
    next_prior = _inside((F.col("good_path") + k_path * F.col("host_mean")) / (F.col("docs_path") + k_path))
    return sites.withColumn("next", next_prior).drop("host_mean"), overall, k_host, k_path

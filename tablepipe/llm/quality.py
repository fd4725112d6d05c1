"""Quality classifier by hierarchical empirical Bayes (operator 6).

* Evidence: logistic regression on rates of a text (capitals, marks, symbols,
  repetition, word lengths), counted in Arrow batches with one split of a text
  into words.  It is fitted on a bounded sample of labelled documents (SAMPLE rows, a documented parameter).
* Sites: documents meet by host and by (host, path) in partial aggregates.  A
  host's posterior is its mean evidence drawn towards the global mean, a path's
  towards its host's; how strongly follows from the variance between and within
  groups (method of moments), so sparse sites stay near the prior.
* A document's posterior odds are its evidence's odds times the odds of its path
  against the global odds.  Documents at THRESHOLD or above are kept.

Defined results: null or empty text has the evidence of its (zero) rates; a null
host or path is a group of its own; labels that are null, repeated with other
values (the smallest counts) or without a document are passed over; without
labels of both kinds the evidence is 0.5 everywhere and all documents are kept;
repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepipe.llm.common import written

SAMPLE = 20_000
THRESHOLD = 0.5
RIDGE = 1e-2
# Odds of a single group move a document's odds by this factor at most.
SITE_LIMIT = 4.0
UPPER, UPPER_ACCENTED = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜŸ"
SYMBOLS = b"%#$&*@^~_=+<>{}[]\\"
FEATURES = ("upper", "bang", "pipe", "symbols", "digits", "distinct", "repeats", "word", "short", "long_line")


def rates(text: str | None) -> list[float]:
    """The rates of a text, in the order of FEATURES."""
    t = text or ""
    raw = t.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, count = max(len(t), 1), max(len(words), 1)
    of = lambda chars: len(raw) - len(raw.translate(None, chars))
    log_rate = lambda r: math.log1p(100 * r)
    upper = of(UPPER) + (0 if t.isascii() else sum(map(t.count, UPPER_ACCENTED)))
    return [
        log_rate(upper / n), log_rate(raw.count(b"!") / count), log_rate(raw.count(b"|") / count), log_rate(of(SYMBOLS) / count), log_rate(of(b"0123456789") / n),
        math.log(len(set(words)) + 1) / math.log(count + 1), log_rate(sum(map(eq, words, islice(words, 1, None))) / count),
        math.log(n / count), math.log1p(count), math.log1p(n / (1 + raw.count(b"\n"))),
    ]


def features(text: Column) -> Column:
    """An array of the rates of the text."""

    @F.pandas_udf("array<double>")
    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(rates)

    return counted(text)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, weights with the intercept first) of a ridge logistic
    regression on x and its squares, by Newton's method."""
    x = np.concatenate([x, x * x], axis=1)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    z = np.concatenate([np.ones((len(x), 1)), (x - mean) / scale], axis=1)
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge * len(x) / 100)
    penalty[0] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def evidence(text: Column, model: tuple | None) -> Column:
    """The probability of good quality by the document alone."""
    if model is None:
        return F.lit(0.5)
    mean, scale, w = model

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        x = np.array([rates(t) for t in texts], float).reshape(len(texts), len(FEATURES))
        odds = w[0] + (np.concatenate([x, x * x], axis=1) - mean) / scale @ w[1:]
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -12, 12))))

    return probability(text)


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE, seed: int = 23) -> tuple | None:
    """The fitted model, or None where the labels are not of both kinds."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(label_id).isNotNull())
    usable = usable.groupBy(F.col(label_id).alias("l_id")).agg(F.min(label_col).alias("l_y"))
    total = usable.count()
    part = F.pmod(F.xxhash64("l_id", F.lit(seed)), F.lit(1_000_003)) < 1_000_003 * min(1.0, 0.95 * sample / max(total, 1))
    chosen = F.broadcast(usable.where(part).limit(sample))  # at most SAMPLE rows of an id and a label
    rows = docs.select(F.col(id_col).alias("d_id"), F.col(text_col).cast("string").alias("d_text")).join(chosen, F.col("d_id") == F.col("l_id"))
    rows = rows.select(features(F.col("d_text")).alias("x"), F.col("l_y").alias("y")).limit(sample).toPandas()
    if rows.empty or rows["y"].nunique() < 2:
        return None
    return fit(np.stack(rows["x"].to_list()).astype(float), rows["y"].to_numpy(float))


def _moments(groups: DataFrame, prior: str) -> float:
    """The number of documents that the prior of a group weighs: variance within over variance between."""
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    row = groups.agg(F.sum(q - s * s / n), F.sum(n) - F.count(F.lit(1)), F.sum(n * (s / n - F.col(prior)) ** 2), F.count(F.lit(1)), F.sum(n), F.sum(n * n)).first()
    if not row[3] or not row[4]:
        return 1.0
    within = max(row[0], 0.0) / max(row[1], 1)
    between = (row[2] - row[3] * within) / max(row[4] - row[5] / row[4], 1.0)
    return float(min(max(within / between, 1.0), 1e6)) if between > 0 else 1e6


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, host_posterior, path_posterior; the global mean) from rows of host, path and p."""
    paths = written(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") ** 2).alias("q")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    n, s = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = float(s / n) if n else 0.5
    hosts = hosts.withColumn("prior", F.lit(mean))
    m = _moments(hosts, "prior")
    hosts = written(hosts.select(F.col("host").alias("h_host"), ((F.col("s") + m * mean) / (F.col("n") + m)).alias("host_posterior")), "hosts")
    paths = written(paths.join(hosts, F.col("host").eqNullSafe(F.col("h_host"))).drop("h_host"), "site")
    k = _moments(paths, "host_posterior")
    return paths.select("host", "path", "host_posterior", ((F.col("s") + k * F.col("host_posterior")) / (F.col("n") + k)).alias("path_posterior")), mean


def classified(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc``, with evidence, host_posterior,
    path_posterior, score and keep."""
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"), evidence(F.col(text_col).cast("string"), model).alias("p"))
    sites, mean = site_posteriors(rows.select("host", "path", "p"))
    sites = sites.withColumnsRenamed({"host": "s_host", "path": "s_path"})
    out = rows.join(sites, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    held = lambda p: F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    logit = lambda p: F.log(held(p) / (1 - held(p)))
    limit = float(np.log(SITE_LIMIT))
    site = F.greatest(F.least(logit(F.col("path_posterior")) - logit(F.lit(mean)), F.lit(limit)), F.lit(-limit))
    out = out.withColumn("score", 1 / (1 + F.exp(-(logit(F.col("p")) + site))))
    keep = F.lit(True) if model is None else F.col("score") >= threshold
    return out.select("doc", F.col("p").alias("evidence"), "host_posterior", "path_posterior", "score", keep.alias("keep"))


def filtered(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps."""
    return classified(docs, labels, **options).where("keep").select("doc.*")

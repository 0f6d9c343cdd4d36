"""Quality classifier by hierarchical empirical Bayes: a document's own evidence joined with its host's and path's.

1. A logistic classifier on surface and lexicon features is fitted to a bounded sample of labelled rows
   (at most SAMPLE of them, drawn by hash; the bound is a parameter). Everything after that covers all rows.
2. Every document gets the classifier's probability of being good, from its whole text.
3. Grouped sums by path give each path's count and mean; hosts and the whole follow from them. Between-site
   variances by moments give the prior strengths, so a host's posterior shrinks to the global mean and a path's to its
   host's, the more so the fewer documents it has.
4. A document's final log odds are its own plus those of its path's posterior (without the document itself)
   against the global mean, weighted by SITE_WEIGHT.

Sums are combined before they move, so a host with a third of all rows costs no more than others.

Edge cases. Null or empty text has a feature row like any other. Null hosts make one host, null paths one
path of their host. Unlabelled rows and null labels aren't trained on, nor are ids whose labels disagree; an id that
repeats in docs has each of its rows drawn on its own, within the bound. With fewer than two classes in the
sample the classifier says the sample's mean (0.5 for none). Repeated rows are scored alike. An empty table
gives no rows. Columns that clash with the operator's own make its get an underscore in front.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby, islice
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drawn, join_small, key_text, stored, unused

#: Labelled rows that the classifier may be fitted to: its only bound, which bounds the lexicon too.
SAMPLE = 6_000
#: Documents of the sample that a word must be in, the log odds it must have either way, and these times the root of the documents, to tell anything:
#: a word of few documents needs greater odds, or chance would make half of the lexicon.
WORD_ROWS, WORD_ODDS, WORD_FORCE = 8, 1.0, 10.0
SITE_WEIGHT = 0.25
#: A document is rejected when it is over three times as likely bad as good: losing clean text costs more.
THRESHOLD = 0.25
_EDGE = re.compile(rb"^[^\w\x80-\xff]+|[^\w\x80-\xff]+$")
_MARKS = (b"!!", b"***", b"$$$", b"%%%", b"&&&", b"###", b" | ", b"...", b"http", b"\n")


class Model(NamedTuple):
    lexicon: dict[bytes, float]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def features(text: bytes | None, lexicon: dict[bytes, float]) -> list[float]:
    """Surface features of the whole text, and what its distinct words say by the lexicon."""
    text = text or b""
    words = words_of(text)
    n, size = len(words) or 1, len(text) or 1
    distinct = set(words)
    hits = [lexicon[w] for w in distinct & lexicon.keys()]
    bad, good = [-h for h in hits if h < 0], [h for h in hits if h > 0]
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _KINDS
    runs = max((sum(1 for _ in g) for _, g in groupby(words)), default=0) if any(map(eq, words, islice(words, 1, None))) else min(1, len(words))
    return [
        np.log1p(size),
        *(kinds / size),
        len(distinct) / n,
        np.log1p(n) - np.log1p(len(distinct)),
        size / n,
        min(runs, 20) / 20,
        max(bad, default=0.0),
        np.log1p(sum(bad)),
        len(bad) / n,
        np.log1p(sum(good)) - np.log1p(n),
        *(np.log1p(100 * text.count(m) / n) for m in _MARKS),
    ]


#: Bytes as capitals, marks (neither letters, digits nor white space, nor of longer characters) and digits.
_KINDS = np.array([[65 <= b <= 90, b < 128 and not chr(b).isalnum() and not chr(b).isspace(), 48 <= b <= 57] for b in range(256)], float)


def _sample(docs: DataFrame, labels: DataFrame, good: Column, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(good, text) of at most `rows` labelled documents: ids drawn by their hash, then their rows by the hash of id and text."""
    told = labels.select(F.col(id_col), good.cast("int").alias("__good")).filter(F.col("__good").isNotNull() & F.col(id_col).isNotNull())
    agreed = told.groupBy(id_col).agg(F.min("__good").alias("__good"), F.max("__good").alias("__other")).filter("__good = __other").drop("__other")
    joined = docs.join(F.broadcast(drawn(agreed, F.col(id_col), rows)), id_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return joined.select("__good", text.cast("binary").alias("text"), F.xxhash64(id_col, text).alias("h")).orderBy("h", "text", "__good").limit(rows).select("__good", "text")


def fit(docs: DataFrame, labels: DataFrame, good: Column, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE) -> Model:
    """The classifier, from a bounded sample; good is a condition on the columns of labels. What reaches the driver is bounded by the sample."""
    sample = stored(_sample(docs, labels, good, id_col, text_col, rows), "quality-sample")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = {0: {}, 1: {}}
            for y, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for w in {_EDGE.sub(b"", w) for w in set(words_of(text.as_py()))} | set(words_of(text.as_py())):
                    n[y][w] = n[y].get(w, 0) + 1
            for y, found in n.items():
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([y] * len(found), pa.int32()), pa.array(list(found.values()), pa.int64())], names=["word", "good", "n"])

    n_all = {r["__good"]: r["n"] for r in sample.groupBy("__good").agg(F.count("*").alias("n")).collect()}
    n_good, n_bad = n_all.get(1, 0), n_all.get(0, 0)
    prior = (n_good + 0.5) / (n_good + n_bad + 1)
    if not n_good or not n_bad:
        return Model({}, np.zeros(0), np.ones(0), np.zeros(0), prior)
    seen = sample.mapInArrow(distinct, "word binary, good int, n long").groupBy("word").agg(F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("g"), F.sum(F.when(F.col("good") == 0, F.col("n")).otherwise(0)).alias("b"))
    odds = F.log((F.col("g") + 0.5) / (n_good + 1)) - F.log((F.col("b") + 0.5) / (n_bad + 1))
    told = seen.filter((F.col("g") + F.col("b") >= WORD_ROWS) & (F.length("word") > 0)).select("word", odds.alias("odds"), (F.abs(odds) * F.sqrt(F.col("g") + F.col("b"))).alias("force"))
    lexicon = {bytes(r["word"]): r["odds"] for r in told.filter((F.abs("odds") > WORD_ODDS) & (F.col("force") > WORD_FORCE)).collect()}

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py(), lexicon) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["good", "x"])

    got = sample.mapInArrow(rows_of, "good int, x array<double>").toPandas()
    x, y = np.array(got["x"].tolist()), got["good"].to_numpy(float)
    order = np.lexsort((y, *x.T))  # sums don't depend on the order in which rows came
    x, y = x[order], y[order]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(lexicon, mean, scale, _logistic((x - mean) / scale, y), prior)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights and, last, the intercept, by Newton steps on the ridge-penalised likelihood."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([*[1.0] * (x.shape[1] - 1), 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(text: bytes | None, model: Model) -> float:
    """The classifier's probability that a text is good, within 1e-6 of 0 and 1 at most."""
    if not len(model.weights):
        return model.prior
    z = float(((np.array(features(text, model.lexicon)) - model.mean) / model.scale) @ model.weights[:-1] + model.weights[-1])
    return float(np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-6, 1 - 1e-6))


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "p_text") -> DataFrame:
    """docs with the classifier's probability in a further column; only the texts go to Python."""
    (name,) = unused(docs, out_col)

    @F.arrow_udf("double")
    def p_of(texts: pa.Array) -> pa.Array:
        return pa.array([probability(x.as_py(), model) for x in texts], pa.float64())

    return docs.withColumn(name, p_of(F.col(text_col).cast("binary")))


def _strength(sites: DataFrame, mean: str, upper: str) -> Column:
    """Prior strength by moments: how many documents the upper level's mean counts for at a site of the lower.

    With p (1 - p) as the variance within and the variance of site means around the upper mean less its
    sampling part as the variance between, strength = within / between, in [1, 1000].
    """
    within = F.sum(F.col("n") * F.col(upper) * (1 - F.col(upper))) / F.sum("n")
    spread = F.sum(F.col("n") * F.pow(F.col(mean) - F.col(upper), 2)) / F.sum("n")
    noise = F.sum(F.col(upper) * (1 - F.col(upper))) / F.sum("n")
    between = F.greatest(spread - noise, F.lit(1e-9))
    return sites.agg(F.least(F.lit(1000.0), F.greatest(F.lit(1.0), within / between))).scalar()


def sites(scored: DataFrame, host: Column, path: Column, p_col: str = "p_text") -> DataFrame:
    """Posteriors by path: __host, __path, n, p_sum, host_n, host_sum, global_mean, host_strength, path_strength.

    One shuffle of partial sums by (host, path); everything above is computed from these.
    """
    paths = scored.groupBy(key_text(host).alias("__host"), key_text(path).alias("__path")).agg(F.count("*").alias("n"), F.sum(p_col).alias("p_sum"))
    paths = stored(paths, "quality-paths")
    hosts = paths.groupBy("__host").agg(F.sum("n").alias("host_n"), F.sum("p_sum").alias("host_sum"))
    hosts = hosts.withColumn("global_mean", hosts.agg(F.sum("host_sum") / F.sum("host_n")).scalar())
    by_host = _strength(hosts.select(F.col("host_n").alias("n"), (F.col("host_sum") / F.col("host_n")).alias("m"), "global_mean"), "m", "global_mean")
    hosts = hosts.withColumn("host_strength", by_host)
    hosts = hosts.withColumn("host_mean", (F.col("host_strength") * F.col("global_mean") + F.col("host_sum")) / (F.col("host_strength") + F.col("host_n")))
    both = paths.join(hosts, "__host")
    by_path = _strength(both.select("n", (F.col("p_sum") / F.col("n")).alias("m"), "host_mean"), "m", "host_mean")
    return stored(both.withColumn("path_strength", by_path).drop("host_mean"), "quality-sites")


def combine(scored: DataFrame, site_table: DataFrame, host: Column, path: Column, p_col: str = "p_text", site_weight: float = SITE_WEIGHT) -> DataFrame:
    """scored with host_posterior, path_posterior (both without the row itself) and p_good."""
    names = unused(scored, "host_posterior", "path_posterior", "p_good")
    keyed = scored.withColumns({"__host": key_text(host), "__path": key_text(path)})
    joined = join_small(keyed, site_table, ["__host", "__path"], "inner")
    p, mu = F.col(p_col), F.col("global_mean")
    host_post = (F.col("host_strength") * mu + F.col("host_sum") - p) / (F.col("host_strength") + F.col("host_n") - 1)
    path_post = (F.col("path_strength") * F.col("__hp") + F.col("p_sum") - p) / (F.col("path_strength") + F.col("n") - 1)
    safe = lambda c: F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), c))
    logit = lambda c: F.log(c) - F.log(1 - c)
    joined = joined.withColumn("__hp", safe(host_post)).withColumn("__pp", safe(path_post))
    z = logit(safe(p)) + F.lit(float(site_weight)) * (logit(F.col("__pp")) - logit(safe(mu)))
    return joined.withColumn("__z", 1 / (1 + F.exp(-z))).select(*scored.columns, F.col("__hp").alias(names[0]), F.col("__pp").alias(names[1]), F.col("__z").alias(names[2]))


def classify(docs: DataFrame, model: Model, host: str = "source", path: str = "lang", id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of docs: id, host, path, p_text, host_posterior, path_posterior, p_good and `keep`."""
    narrow = score(docs.select(id_col, host, path, text_col), model, text_col).drop(text_col)
    narrow = stored(narrow, "quality-scores")
    out = combine(narrow, sites(narrow, F.col(host), F.col(path)), F.col(host), F.col(path))
    return out.withColumn("keep", F.col("p_good") >= threshold)


def filtered(docs: DataFrame, model: Model, host: str = "source", path: str = "lang", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that the classifier rejects. Rows are stored with their scores, so each text is scored once and none is shuffled."""
    (p,) = unused(docs, "p_text")
    scored = stored(score(docs, model, text_col, p), "quality-scored")
    out = combine(scored, sites(scored, F.col(host), F.col(path), p), F.col(host), F.col(path), p)
    return out.filter(F.col(out.columns[-1]) >= threshold).select(*docs.columns)

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import catalog, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(0)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        text = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        if bad and i % 8:
            text = [w.upper() + "!!" for w in text]
        elif bad:
            text[5] = "idiot"
        rows.append((i, " ".join(text), "en" if i % 2 else "de", f"h{i % 7}", len(text)))
        labels.append((i, int(not bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, good int")


@pytest.fixture(scope="module")
def model(corpus):
    docs, labels = corpus
    return quality.fit(docs, labels.filter("doc_id < 400"), F.col("good") == 1)


def test_held_out_accuracy(corpus, model):
    docs, labels = corpus
    got = quality.classify(docs, model).join(labels, "doc_id").filter("doc_id >= 400").collect()
    right = [r["keep"] == bool(r["good"]) for r in got]
    assert np.mean(right) > 0.95
    assert np.mean([r["keep"] for r in got if r["good"]]) > 0.97


def test_the_sample_is_bounded(spark, corpus):
    docs, labels = corpus
    good = F.col("good") == 1
    assert quality._sample(docs, labels, good, "doc_id", "text", 50).count() == 50
    copies = docs.filter("doc_id < 60").unionByName(docs.filter("doc_id = 3").crossJoin(spark.range(5000)).drop("id"))
    assert quality._sample(copies, labels.filter("doc_id = 3"), good, "doc_id", "text", 50).count() == 50


def test_labels_that_disagree_are_left_out_and_models_are_equal(spark, corpus):
    docs, labels = corpus
    clash = labels.unionByName(labels.filter("doc_id < 5").withColumn("good", 1 - F.col("good")))
    one = quality.fit(docs, clash, F.col("good") == 1, rows=300)
    two = quality.fit(docs.repartition(7), clash.repartition(5), F.col("good") == 1, rows=300)
    assert one.lexicon == two.lexicon and (one.weights == two.weights).all() and one.prior == two.prior
    assert quality._sample(docs.filter("doc_id < 5"), clash, F.col("good") == 1, "doc_id", "text", 50).count() == 0


def plain_features(text, lexicon):
    words = text.lower().split()
    n, size, distinct = len(words) or 1, len(text) or 1, set(words)
    bad, good = [-lexicon[w] for w in distinct if lexicon.get(w, 0) < 0], [lexicon[w] for w in distinct if lexicon.get(w, 0) > 0]
    longest = run = 0
    for i, w in enumerate(words):
        run = run + 1 if i and words[i - 1] == w else 1
        longest = max(longest, run)
    count = lambda ok: sum(1 for b in text if ok(chr(b)))
    marks = [b"!!", b"***", b"$$$", b"%%%", b"&&&", b"###", b" | ", b"...", b"http", b"\n"]
    surface = [math.log(1 + size), count(lambda c: "A" <= c <= "Z") / size, count(lambda c: c < "\x80" and not c.isalnum() and not c.isspace()) / size, count(lambda c: "0" <= c <= "9") / size]
    spread = [len(distinct) / n, math.log(1 + n) - math.log(1 + len(distinct)), size / n, min(longest, 20) / 20]
    told = [max(bad, default=0), math.log(1 + sum(bad)), len(bad) / n, math.log(1 + sum(good)) - math.log(1 + n)]
    return surface + spread + told + [math.log(1 + 100 * text.count(m) / n) for m in marks]


def plain_strength(sites):
    """sites: (n, mean, upper mean)."""
    total = sum(n for n, _, _ in sites)
    within = sum(n * u * (1 - u) for n, _, u in sites) / total
    between = sum(n * (m - u) ** 2 for n, m, u in sites) / total - sum(u * (1 - u) for _, _, u in sites) / total
    return min(1000, max(1, within / max(between, 1e-9)))


def plain_classified(rows, model):
    """(p_text, host posterior, path posterior, p_good, keep) of (text, host, path) rows, in plain Python."""
    p = []
    for text, _, _ in rows:
        x = plain_features((text or "").encode(), model.lexicon)
        z = sum(w * (v - m) / s for w, v, m, s in zip(model.weights, x, model.mean, model.scale)) + model.weights[-1]
        p.append(min(1 - 1e-6, max(1e-6, 1 / (1 + math.exp(-min(30, max(-30, z)))))))
    hosts, paths = {}, {}
    for (_, h, q), v in zip(rows, p):
        hosts.setdefault(h, []).append(v)
        paths.setdefault((h, q), []).append(v)
    mu = sum(p) / len(p)
    k_host = plain_strength([(len(v), sum(v) / len(v), mu) for v in hosts.values()])
    mean = {h: (k_host * mu + sum(v)) / (k_host + len(v)) for h, v in hosts.items()}
    k_path = plain_strength([(len(v), sum(v) / len(v), mean[h]) for (h, _), v in paths.items()])
    safe = lambda v: min(1 - 1e-6, max(1e-6, v))
    logit = lambda v: math.log(v) - math.log(1 - v)
    out = []
    for (_, h, q), v in zip(rows, p):
        a = safe((k_host * mu + sum(hosts[h]) - v) / (k_host + len(hosts[h]) - 1))
        b = safe((k_path * a + sum(paths[h, q]) - v) / (k_path + len(paths[h, q]) - 1))
        z = logit(v) + 0.25 * (logit(b) - logit(safe(mu)))
        out.append((v, a, b, 1 / (1 + math.exp(-z)), 1 / (1 + math.exp(-z)) >= 0.25))
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_the_query_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = catalog.fitted(spark, docs, SF)
    rows = docs.collect()
    want = dict(zip([r["doc_id"] for r in rows], plain_classified([(r["text"], r["source"], r["lang"]) for r in rows], model)))
    got = catalog.op2_quality(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        *numbers, keep = want[r["doc_id"]]
        assert [r["p_text"], r["host_posterior"], r["path_posterior"], r["p_good"]] == pytest.approx(numbers, rel=1e-6, abs=1e-9)
        assert r["keep"] == keep


def test_posteriors_by_hand(spark):
    scored = spark.createDataFrame([(i, "h" if i < 6 else "g", "p" if i < 2 else "q", 0.1 + 0.05 * i) for i in range(12)], "doc_id long, source string, lang string, p_text double")
    host, path = F.col("source"), F.col("lang")
    table = quality.sites(scored, host, path)
    got = {r["doc_id"]: r for r in quality.combine(scored, table, host, path).collect()}
    rows = [(r["doc_id"], r["source"], r["lang"], r["p_text"]) for r in scored.collect()]
    t = table.first()
    k_host, k_path, mu = t["host_strength"], t["path_strength"], np.mean([r[3] for r in rows])
    assert 1 <= k_host <= 1000 and 1 <= k_path <= 1000
    for i, s, l, p in rows:
        host_p = [r[3] for r in rows if r[1] == s]
        path_p = [r[3] for r in rows if (r[1], r[2]) == (s, l)]
        h = (k_host * mu + sum(host_p) - p) / (k_host + len(host_p) - 1)
        q = (k_path * h + sum(path_p) - p) / (k_path + len(path_p) - 1)
        z = np.log(p / (1 - p)) + quality.SITE_WEIGHT * (np.log(q / (1 - q)) - np.log(mu / (1 - mu)))
        assert got[i]["host_posterior"] == pytest.approx(h) and got[i]["path_posterior"] == pytest.approx(q)
        assert got[i]["p_good"] == pytest.approx(1 / (1 + np.exp(-z)))


def test_sparse_sites_shrink_more(spark):
    rows = [(i, "big", "x", 0.9) for i in range(200)] + [(500, "small", "x", 0.9), (501, "small", "x", 0.9)] + [(600 + i, "other", "x", 0.3) for i in range(200)]
    scored = spark.createDataFrame(rows, "doc_id long, source string, lang string, p_text double")
    out = quality.combine(scored, quality.sites(scored, F.col("source"), F.col("lang")), F.col("source"), F.col("lang"))
    got = {r["source"]: r["host_posterior"] for r in out.collect()}
    assert abs(got["big"] - 0.9) < abs(got["small"] - 0.9)


def test_odd_rows(spark, odd, none, model):
    got = quality.classify(odd, model)
    assert got.count() == odd.count() and got.filter("p_good is null or p_good <= 0 or p_good >= 1").count() == 0
    kept = quality.filtered(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() == got.filter("keep").count()
    assert quality.classify(none, model).count() == 0 and quality.filtered(none, model).count() == 0


def test_without_labels_the_sample_mean_counts(spark, corpus):
    docs, labels = corpus
    for rows, want in ((labels.limit(0), 0.5), (labels.filter("good = 1").limit(9), 0.95)):
        model = quality.fit(docs, rows, F.col("good") == 1)
        assert quality.probability(b"any text", model) == pytest.approx(want)


def test_null_labels_are_left_out(spark, corpus):
    docs, _ = corpus
    rows = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 1)], "doc_id long, good int")
    assert quality._sample(docs, rows, F.col("good") == 1, "doc_id", "text", 10).count() == 1

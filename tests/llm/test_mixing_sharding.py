import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing, sharding


def docs(spark, n=3000):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 10).cast("string"))).alias("source"), F.lit("text").alias("text"))


def poisson(u, rate):
    n, mass = 0, math.exp(-rate)
    upto = mass
    while upto <= u:
        n += 1
        mass *= rate / n
        upto += mass
    return n


def test_counts_invert_the_poisson_distribution(spark):
    d = docs(spark)
    rates = mixing.rates(d)
    of = {r["source_key"]: r["rate"] for r in rates.collect()}
    rows = mixing.counts(d, rates).collect()
    assert len(rows) == 3000
    for r in rows:
        u = int(hashlib.md5(f"v{mixing.SEED}\x1fv{r['doc_id']}\x1fn".encode()).hexdigest()[:13], 16) / 16**13
        assert r["n_copies"] == poisson(u, of["v" + r["source"]])


def test_weights_are_met(spark):
    d = docs(spark, 20_000)
    weights = {"hot": 0.1, **{f"s{i}": 0.1 for i in range(10)}}
    mixed = mixing.mix(d, mixing.rates(d, weights=weights))
    n = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    assert abs(total - 20_000) < 600
    assert all(abs(v / total - 1 / 11) < 0.01 for v in n.values())


def test_large_and_zero_rates(spark):
    d = spark.createDataFrame([(i, "rare" if i == 0 else "rest", "t") for i in range(2001)], "doc_id long, source string, text string")
    r = mixing.rates(d, weights={"rare": 1.0, "rest": 0.0})
    assert {x["source_key"]: x["rate"] for x in r.collect()} == {"vrare": pytest.approx(2001), "vrest": 0.0}
    n = mixing.mix(d, r).count()
    assert abs(n - 2001) < 6 * math.sqrt(2001)
    table = mixing.poisson_tables(r).filter("source_key = 'vrare'").first()["cdf"]
    assert table[-1] == pytest.approx(1) and all(a <= b + 1e-15 for a, b in zip(table, table[1:], strict=False))
    with pytest.raises(Exception, match="no weight"):
        mixing.rates(d, weights={"rare": 1.0}).collect()
    with pytest.raises(ValueError):
        mixing.rates(d, weights={"rare": -1.0})


def test_mixing_does_not_depend_on_partitions_and_shuffles(spark):
    d = docs(spark)
    a, b = (mixing.mix(x, mixing.rates(x)) for x in (d, d.repartition(7)))
    assert sorted(a.collect()) == sorted(b.collect())
    ids = [r["doc_id"] for r in a.collect()]
    assert ids != sorted(ids)
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixing_odd_rows(spark, odd, none):
    r = mixing.rates(odd)
    assert {x["source_key"] for x in r.collect()} >= {"n", "va", "vb"}
    mixed = mixing.mix(odd, r)
    assert mixed.columns == [*odd.columns, "_rate", "_n_copies", "_copy", "_shuffle_key"]
    per = collections.Counter((x["doc_id"], x["text"]) for x in mixed.collect())
    n = collections.Counter()
    for x in mixing.counts(odd, r).collect():
        n[x["doc_id"], x["text"]] += x["_n_copies"]
    assert per == +n
    assert mixing.mix(none, mixing.rates(none)).count() == 0


def plain_shards(rows, n_shards, more=lambda i, s: f"{'n' if s is None else 'v' + s}\x1fvtext"):
    by = collections.defaultdict(list)
    for i, s in rows:
        by["n" if s is None else "v" + s].append((int(hashlib.md5(f"v{sharding.SEED}\x1fv{i}\x1f{more(i, s)}".encode()).hexdigest()[:13], 16), i))
    order = sorted(((r + 0.5) / len(v), s, i) for s, v in by.items() for r, (_, i) in enumerate(sorted(v)))
    n = len(order)
    return {i: ((p * n_shards) // n, p - ((p * n_shards) // n * n + n_shards - 1) // n_shards) for p, (_, _, i) in enumerate(order)}


@pytest.mark.parametrize(("n", "n_shards"), [(20_000, 8), (1000, 7), (5, 8), (1, 3)])
def test_shards_equal_a_plain_sort(spark, n, n_shards):
    d = docs(spark, n)
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.interleave(d, n_shards).collect()}
    assert got == plain_shards([(r["doc_id"], r["source"]) for r in d.collect()], n_shards)


def test_every_shard_matches_the_mixture(spark):
    rows = sharding.interleave(docs(spark, 8000), 8).collect()
    sizes = collections.Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    for source in {r["source"] for r in rows}:
        n = collections.Counter(r["shard"] for r in rows if r["source"] == source)
        assert max(n.values()) - min(n.values()) <= 2


def test_sharding_odd_rows(spark, odd, none):
    out = sharding.interleave(odd, 4)
    assert out.columns == [*odd.columns, "_shard", "_slot"]
    rows = out.collect()
    assert len(rows) == odd.count()
    n = collections.Counter(r["_shard"] for r in rows)
    assert max(n.values()) - min(n.values()) <= 1
    assert len({(r["_shard"], r["_slot"]) for r in rows}) == len(rows)
    assert sharding.interleave(none, 4).count() == 0
    with pytest.raises(ValueError):
        sharding.interleave(odd, 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("sizes", [[1, 2, 3, 4096, 4097, 5000, 12_289], [10_000, 99_999]])
def test_range_counts_equal_counting(spark, sizes):
    want = collections.Counter(math.floor((r + 0.5) / n * sharding.BUCKETS) for n in sizes for r in range(n))
    got = sharding._range_counts(spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "__source string, __size long")).collect()
    assert {r["__range"]: r["__n"] for r in got if r["__n"]} == dict(want)


def test_rows_without_an_id_are_spread(spark):
    d = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("hot").alias("source"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    rows = sharding.interleave(d, 8).collect()
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, k) for s in range(8) for k in range(375)]
    h = F.md5(sharding.key_text(F.lit(sharding.SEED), F.col("doc_id"), F.col("source"), F.col("text")))
    assert d.select(F.substring(h, 1, 3)).distinct().count() > 1500

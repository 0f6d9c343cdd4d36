"""The operators as queries over the driver's tables, with DuckDB SQL for the same rows.

An image is an orders row, an annotation a lineitem row, its label the return flag; a setup is a customer, an export
their nation; a recording is a user of events, a frame an event; a polygon is an embedding, 64 numbers as 32 points; a
clip is a part or a conversation; a file is a page's url.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import numbers, polygons, strings
from tessera.operators import annotations, layout, paste, sampling, splits, stats
from tessera.raster import augment
from tessera.streaming import sampler
from tessera.tables import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

KEEP, DROP = ("A", "N"), ("R",)
SEED = 42
DAY = 86_400_000_000_000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time in nanoseconds."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("ts_ns", F.unix_micros(F.col("ts").cast("timestamp")) * 1000)


def polygon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label, flat): coordinates moved to 0 and above, in pixels."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.transform("embedding", lambda x: (x.cast("double") + 1) * 100).alias("flat"))


FRAMES_SQL = "e AS (SELECT *, epoch_us(ts) * 1000 AS ts_ns FROM events)"
POLY_SQL = "poly AS (SELECT vec_id, label, list_transform(embedding, lambda x: (x::DOUBLE + 1) * 100) AS flat FROM embeddings)"
XY_SQL = POLY_SQL + """, xy AS (SELECT vec_id, label, i, flat[2 * i + 1] AS x, flat[2 * i + 2] AS y,
  flat[CASE WHEN i = 31 THEN 1 ELSE 2 * i + 3 END] AS x2, flat[CASE WHEN i = 31 THEN 2 ELSE 2 * i + 4 END] AS y2
  FROM (SELECT vec_id, label, flat, unnest(range(0, 32)) AS i FROM poly))"""
KEPT_SQL = "kept AS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_or(l_returnflag IN ('A', 'N')) AND NOT bool_or(l_returnflag = 'R'))"
HASH_SQL = "md5('42:' || {0}), {0}"


def kept_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotations.images_to_keep(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", KEEP, DROP)


# --- images and annotations -------------------------------------------------------------------------------------


@query(f"WITH {KEPT_SQL} SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM kept)")
def keep_drop_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return annotations.keep_images(orders, "o_orderkey", kept_orders(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey"))


@query(f"WITH {KEPT_SQL} SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_orderkey IN (SELECT l_orderkey FROM kept)")
def keep_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return annotations.keep_annotations(rows, "l_orderkey", "l_returnflag", kept_orders(spark, sf_dir), KEEP)


def _canonical(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return annotations.canonical(kept_orders(spark, sf_dir), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_orderkey", ["l_linenumber", "l_returnflag"], "l_returnflag", KEEP)


@query(
    f"""WITH {KEPT_SQL}, i AS (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) AS new_image_id FROM kept)
SELECT l_orderkey, l_linenumber, new_image_id, CASE l_returnflag WHEN 'A' THEN 1 ELSE 2 END AS new_category_id,
  row_number() OVER (ORDER BY new_image_id, l_linenumber, l_returnflag) AS new_annotation_id
FROM lineitem JOIN i USING (l_orderkey) WHERE l_returnflag IN ('A', 'N')"""
)
def canonical_reid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(spark, sf_dir)[1].select("l_orderkey", "l_linenumber", "new_image_id", "new_category_id", "new_annotation_id")


SPLIT_SQL = """split AS (SELECT c_custkey, c_nationkey, CASE WHEN r <= 3 THEN 'val' WHEN r <= 6 THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5('42:' || c_custkey), c_custkey) AS r FROM customer))"""


def setups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.fixed_split(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", "c_custkey", 3, 3, SEED)


@query(f"WITH {SPLIT_SQL} SELECT c_custkey, c_nationkey, split FROM split")
def setup_split_per_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setups(spark, sf_dir)


def _orders_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = keep_drop_images(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    return splits.attach(kept, setups(spark, sf_dir), "c_custkey")


@query(
    f"""WITH {KEPT_SQL}, {SPLIT_SQL}
SELECT coalesce(split, 'train') AS split, l_returnflag, count(*) AS n
FROM lineitem JOIN kept USING (l_orderkey) JOIN orders ON o_orderkey = l_orderkey LEFT JOIN split ON c_custkey = o_custkey
WHERE l_returnflag IN ('A', 'N') GROUP BY 1, 2"""
)
def class_counts_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keep_annotations(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey")
    return annotations.class_counts(rows.join(_orders_split(spark, sf_dir), "o_orderkey"), "l_returnflag", "split")


@query(
    f"""WITH {SPLIT_SQL}, p AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
SELECT coalesce(split, 'train') AS split, count(*) FILTER (WHERE l_orderkey IS NOT NULL) AS n_pos, count(*) FILTER (WHERE l_orderkey IS NULL) AS n_neg
FROM orders LEFT JOIN p ON o_orderkey = l_orderkey LEFT JOIN split ON c_custkey = o_custkey GROUP BY 1"""
)
def pos_neg_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    labelled = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    marked = annotations.positives(splits.attach(orders, setups(spark, sf_dir), "c_custkey"), labelled, "o_orderkey")
    return annotations.positive_counts(marked, "split")


@query(f"WITH {SPLIT_SQL} SELECT split, count(*) AS n FROM split GROUP BY 1")
def split_setup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.counts_by_split(setups(spark, sf_dir))


@query(
    f"""WITH {KEPT_SQL}, r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('0:' || o_orderkey), o_orderkey) AS r, count(*) OVER () AS n
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM kept))
SELECT o_orderkey, CASE WHEN r <= n - round_even(n * 0.15::DOUBLE, 0)::BIGINT - round_even(n * 0.15::DOUBLE, 0)::BIGINT THEN 'train'
  WHEN r <= n - round_even(n * 0.15::DOUBLE, 0)::BIGINT THEN 'val' ELSE 'test' END AS split FROM r"""
)
def ratio_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    splits.check_ratios(0.7, 0.15, 0.15)
    return splits.train_first(keep_drop_images(spark, sf_dir).select("o_orderkey"), "o_orderkey", 0.15, 0.15, 0)


@query(
    """WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY md5('42:' || event_id), event_id) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, event_id, CASE WHEN r <= round_even(n * 0.15::DOUBLE, 0) THEN 'val' WHEN r <= 2 * round_even(n * 0.15::DOUBLE, 0) THEN 'test' ELSE 'train' END AS split FROM r"""
)
def ratio_split_per_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "events").select("user_id", "event_id")
    return splits.ratio_split(keys, "user_id", "event_id", ("val", 0.15), ("test", 0.15), "train", SEED)


@query("SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS exports FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def setup_collision_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotations.collisions(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query(
    """SELECT DISTINCT l_linestatus, need.l_returnflag FROM lineitem CROSS JOIN (VALUES ('A'), ('N'), ('R'), ('X')) need(l_returnflag)
EXCEPT SELECT DISTINCT l_linestatus, l_returnflag FROM lineitem"""
)
def missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotations.missing_labels(table(spark, sf_dir, "lineitem").select("l_linestatus", "l_returnflag"), "l_returnflag", ("A", "N", "R", "X"), "l_linestatus")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def split_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return splits.without_split(table(spark, sf_dir, "customer"), assigned, "c_custkey")


@query(
    """WITH s AS (SELECT o_custkey % 7 AS export_no, (o_orderkey % 900)::VARCHAR AS setup, o_orderkey % 3 <> 0 AS colour FROM orders)
SELECT export_no, setup, bool_or(colour) AND bool_or(NOT colour) AS paired FROM s GROUP BY 1, 2"""
)
def setup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    stem = F.concat((k % 900).cast("string"), F.when(k % 3 != 0, "_Color").otherwise("_empty"))
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 7).alias("export_no"), stem.alias("stem"))
    return annotations.setup_pairs(rows, "export_no", "stem")


@query("SELECT o_orderkey, coalesce(list_transform(list_sort(list({'n': l_linenumber, 'f': l_returnflag}) FILTER (WHERE l_orderkey IS NOT NULL)), lambda s: s.n || s.f), []) AS labels FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def grouped_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag")
    out = annotations.with_annotations(table(spark, sf_dir, "orders").select("o_orderkey"), rows, "o_orderkey", "l_linenumber", ["l_returnflag"])
    return out.select("o_orderkey", F.transform("annotations", lambda a: F.concat(a["l_linenumber"].cast("string"), a["l_returnflag"])).alias("labels"))


@query(
    """WITH u AS (SELECT 0 AS export_no, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 1, s_suppkey, s_name FROM supplier UNION ALL SELECT 2, p_partkey, p_name FROM part)
SELECT export_no, id, name, row_number() OVER (ORDER BY export_no, id) AS new_id FROM u"""
)
def merge_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [table(spark, sf_dir, t).select(F.col(k).alias("id"), F.col(n).alias("name")) for t, k, n in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name"))]
    return annotations.merged(parts, ["id"]).select("export_no", "id", "name", "new_id")


@query(
    """WITH m AS (SELECT DISTINCT c_nationkey % 3 AS export_no, c_mktsegment, c_nationkey % 3 * 100 + ascii(c_mktsegment) AS id FROM customer)
SELECT m.export_no::BIGINT AS export_no, m.id::BIGINT AS category, f.id::BIGINT AS canonical_id FROM m JOIN m f ON f.export_no = 0 AND f.c_mktsegment = m.c_mktsegment"""
)
def canonical_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = F.col("c_nationkey") % 3
    found = table(spark, sf_dir, "customer").select(export.cast("long").alias("export_no"), F.col("c_mktsegment").alias("label"), (export * 100 + F.ascii("c_mktsegment")).cast("long").alias("category")).distinct()
    return annotations.canonical_categories(found, "export_no", "category", "label")


@query(f"WITH {KEPT_SQL} SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM kept)")
def set_difference_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.join(kept_orders(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left_anti")


# --- recordings and frames --------------------------------------------------------------------------------------


@query(
    f"""WITH {FRAMES_SQL}, t AS (SELECT *, floor((ts_ns - min(ts_ns) OVER (PARTITION BY user_id)) / {2.0 * DAY}) AS b, row_number() OVER (PARTITION BY user_id ORDER BY ts_ns, event_id) AS i FROM e),
c AS (SELECT *, i + least(0, min(b + 1 - i) OVER (PARTITION BY user_id ORDER BY ts_ns, event_id)) AS c FROM t),
p AS (SELECT *, coalesce(lag(c) OVER (PARTITION BY user_id ORDER BY ts_ns, event_id), 0) AS p FROM c)
SELECT user_id, event_id, CAST(c - 1 AS INTEGER) AS sample_no FROM p WHERE c > p"""
)
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stride_sample(frames(spark, sf_dir).select("user_id", "event_id", "ts_ns"), "user_id", "ts_ns", "event_id", 2 * DAY).select("user_id", "event_id", "sample_no")


@query(
    f"""WITH {FRAMES_SQL}, t AS (SELECT *, ts_ns - min(ts_ns) OVER (PARTITION BY user_id) AS t, max(ts_ns) OVER (PARTITION BY user_id) - min(ts_ns) OVER (PARTITION BY user_id) AS d FROM e)
SELECT user_id, event_id FROM t WHERE t >= {DAY} AND t < greatest(0, d - {2 * DAY})"""
)
def time_range_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.trim(frames(spark, sf_dir), "user_id", "ts_ns", DAY, 2 * DAY).select("user_id", "event_id")


@query(f"WITH {FRAMES_SQL} SELECT user_id, min(ts_ns) AS first_time, max(ts_ns) AS last_time, max(ts_ns) - min(ts_ns) AS duration FROM e GROUP BY 1")
def recording_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.durations(frames(spark, sf_dir), "user_id", "ts_ns")


@query(
    """WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)
SELECT user_id, event_id, CAST(i // 8 AS INTEGER) AS frame_no FROM r WHERE i % 8 = 0"""
)
def modulo_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.every_nth(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), "user_id", "ts", "event_id", 8).select("user_id", "event_id", "frame_no")


@query(
    """WITH n AS (SELECT user_id, event_id, event_type || CASE WHEN event_id % 7 = 0 THEN '/Color_0/image/data' WHEN event_id % 3 = 0 THEN '/COLOR/image' ELSE '/depth' END AS topic FROM events),
r AS (SELECT *, CASE WHEN contains(topic, 'Color_0/image/data') THEN 0 WHEN contains(lower(topic), 'color') AND contains(lower(topic), 'image') THEN 1 ELSE 2 END AS k FROM n)
SELECT user_id, event_id, topic FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY k, event_id) AS q FROM r) WHERE q = 1"""
)
def topic_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.when(F.col("event_id") % 7 == 0, "/Color_0/image/data").when(F.col("event_id") % 3 == 0, "/COLOR/image").otherwise("/depth")
    topics = table(spark, sf_dir, "events").select("user_id", "event_id", F.concat("event_type", tail).alias("topic"))
    return sampling.topic_choice(topics, ["user_id"], "event_id", "topic")


@query(
    """WITH n AS (SELECT event_id, event_type || '_' || lpad((event_id % 9000)::VARCHAR, 4, '0') || '_t' || (event_id % 500) || '.' || lpad((event_id % 100)::VARCHAR, 2, '0') || 's.png' AS name FROM events)
SELECT event_id, name, regexp_extract(name, '^(.*)_([0-9]{4,})_t([0-9]+\\.[0-9]{2})s\\.png$', 1) AS stem, CAST(event_id % 9000 AS INTEGER) AS idx, (event_id % 500) + (event_id % 100) / 100.0::DOUBLE AS seconds FROM n"""
)
def frame_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    rows = table(spark, sf_dir, "events").select("event_id", strings.frame_name(F.col("event_type"), i % 9000, (i % 500) * 100 + i % 100).alias("name"))
    return rows.select("event_id", "name", strings.frame_stem(F.col("name")).alias("stem"), strings.frame_index(F.col("name")).alias("idx"), strings.frame_seconds(F.col("name")).alias("seconds"))


@query(
    """WITH s AS (SELECT p_partkey, lower(replace(p_type, ' ', '-')) || CASE WHEN p_partkey % 5 = 0 THEN '_final' WHEN p_partkey % 3 = 0 THEN '' ELSE '_' || lpad((p_partkey % 40)::VARCHAR, 2, '0') END AS stem FROM part)
SELECT p_partkey, CASE WHEN regexp_matches(stem, '^.*_[0-9]+$') THEN regexp_extract(stem, '^(.*)_([0-9]+)$', 1) ELSE stem END AS component,
  CASE WHEN regexp_matches(stem, '^.*_[0-9]+$') THEN regexp_extract(stem, '^(.*)_([0-9]+)$', 2) ELSE '00' END AS take, split_part(stem, '_', 1) AS class FROM s"""
)
def component_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    tail = F.when(k % 5 == 0, "_final").when(k % 3 == 0, "").otherwise(F.concat(F.lit("_"), F.lpad((k % 40).cast("string"), 2, "0")))
    s = F.col("stem")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lower(F.replace("p_type", F.lit(" "), F.lit("-"))), tail).alias("stem"))
    return rows.select("p_partkey", strings.component_id(s).alias("component"), strings.take_number(s).alias("take"), strings.component_class(s).alias("class"))


@query(
    """WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'scene' ELSE (o_orderkey % 22)::VARCHAR || '_Color' END AS stem FROM orders)
SELECT o_orderkey, coalesce(nullif(regexp_extract(stem, '^([0-9]+)_', 1), ''), stem) AS setup, 'static_setup_' || coalesce(nullif(regexp_extract(stem, '^([0-9]+)_', 1), ''), stem) AS source_group FROM s"""
)
def setup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 4 == 0, "scene").otherwise(F.concat((k % 22).cast("string"), F.lit("_Color"))).alias("stem"))
    key = strings.setup_key(F.col("stem"))
    return rows.select("o_orderkey", key.alias("setup"), strings.static_group(key).alias("source_group"))


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5('0:' || event_id), event_id) AS r FROM events) WHERE r <= 4")
def review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_n(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], "event_id", 4)


@query("SELECT event_id, ['screw_1', 'screw_2', 'nut_1'][1 + CAST('0x' || substr(md5('42:p:' || event_id), 1, 7) AS BIGINT) % 3] AS pick FROM events")
def random_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in ("screw_1", "screw_2", "nut_1")])
    draw = numbers.draw_int(F.lit(SEED), F.lit("p"), F.col("event_id"))
    return table(spark, sf_dir, "events").select("event_id", numbers.pick(names, draw).alias("pick"))


# --- files ------------------------------------------------------------------------------------------------------


@query(
    """WITH f AS (SELECT page_id, (page_id % 40)::VARCHAR || '.png' AS name, CASE page_id % 5 WHEN 0 THEN 'images/' WHEN 1 THEN 'images/default/' WHEN 2 THEN 'images/Test/' WHEN 3 THEN '' ELSE 'more/' || page_id || '/' END AS folder FROM pages)
SELECT name, arg_min(path, (k, path)) AS path FROM (SELECT name, folder || name AS path, CASE folder WHEN 'images/' THEN 0 WHEN 'images/default/' THEN 1 WHEN 'images/Test/' THEN 2 WHEN '' THEN 3 ELSE 4 END AS k FROM f) GROUP BY 1"""
)
def locator_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    folder = F.when(k % 5 == 0, "images/").when(k % 5 == 1, "images/default/").when(k % 5 == 2, "images/Test/").when(k % 5 == 3, "").otherwise(F.concat(F.lit("more/"), k.cast("string"), F.lit("/")))
    rows = table(spark, sf_dir, "pages").select(F.concat((k % 40).cast("string"), F.lit(".png")).alias("name"), folder.alias("folder"))
    return layout.locate(rows.select("name").distinct(), "name", rows.select(F.concat("folder", "name").alias("file")), "file")


@query(
    """WITH f AS (SELECT page_id, 'dir.d/' || page_id || CASE page_id % 5 WHEN 0 THEN '.PNG' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.tar.jpg' WHEN 3 THEN '.txt' ELSE '' END AS path FROM pages)
SELECT page_id, lower(regexp_extract(regexp_extract(path, '[^/]*$'), '^.+(\\.[^.]+)$', 1)) AS suffix FROM f WHERE page_id % 5 < 3"""
)
def extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    end = F.when(k % 5 == 0, ".PNG").when(k % 5 == 1, ".jpeg").when(k % 5 == 2, ".tar.jpg").when(k % 5 == 3, ".txt").otherwise("")
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("dir.d/"), k.cast("string"), end).alias("path"))
    return rows.filter(strings.has_suffix(F.col("path"))).select("page_id", strings.suffix(F.col("path")).alias("suffix"))


@query(
    """WITH u AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE role = 'user'), a AS (SELECT DISTINCT conv_id, turn - 1 AS turn FROM conversations WHERE role = 'assistant')
SELECT conv_id::VARCHAR AS component, count(*) AS n_pairs FROM u JOIN a USING (conv_id, turn) GROUP BY 1"""
)
def mask_rgb_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    at = lambda n, end: F.concat(F.col("conv_id").cast("string"), F.lit("/clip/"), n.cast("string"), F.lit(end))
    rgb = c.filter("role = 'user'").select(at(F.col("turn"), ".png").alias("path")).distinct()
    masks = c.filter("role = 'assistant'").select(at(F.col("turn") - 1, "_mask.png").alias("path")).distinct()
    pairs = layout.mask_pairs(rgb.unionByName(masks), "path")
    return pairs.groupBy("component").agg(F.count("*").alias("n_pairs"))


@query(
    """WITH f AS (SELECT page_id % 60 AS s, CASE page_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split, page_id % 3 AS k FROM pages WHERE page_id % 4 <> 3)
SELECT s::VARCHAR AS key, arg_max(split, k) AS split FROM f GROUP BY 1"""
)
def folder_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    split = F.when(k % 3 == 0, "train").when(k % 3 == 1, "val").otherwise("test")
    path = F.concat(F.lit("out/images/"), split, F.lit("/"), (k % 60).cast("string"), F.when(k % 4 == 3, "_Color.txt").otherwise("_Color.png"))
    files = table(spark, sf_dir, "pages").select(path.alias("path"))
    return layout.splits_from_folders(files, "path", strings.setup_key(strings.stem(F.col("path"))))


@query("SELECT source, list_sort(list(DISTINCT doc_id)) AS stems FROM documents GROUP BY 1")
def source_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return layout.source_index(docs, "doc_id", "source", F.lit(0))[1]


@query("SELECT conv_id, arg_max(text, (turn, text)) AS text, max(turn) AS turn FROM conversations WHERE role = 'user' GROUP BY 1")
def first_click_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = table(spark, sf_dir, "conversations").filter("role = 'user'")
    return clicks.groupBy("conv_id").agg(F.max_by("text", F.struct("turn", "text")).alias("text"), F.max("turn").alias("turn"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')")
def resume_skip_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return layout.to_do(table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k, CASE CAST(props ->> '$.k' AS INTEGER) % 3 WHEN 0 THEN 'screw' WHEN 1 THEN 'nut' ELSE 'gear' END AS class FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(F.lit(0), F.lit("screw"), F.lit(1), F.lit("nut"), F.lit(2), F.lit("gear"))
    rows = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))
    return rows.withColumn("class", names[F.col("k") % 3])


# --- gates and summaries ----------------------------------------------------------------------------------------


@query("SELECT p_partkey, p_size FROM part WHERE p_size >= 20 AND p_retailprice >= 950")
def resolution_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.resolution_gate(table(spark, sf_dir, "part"), "p_size", "p_retailprice", 20, 950).select("p_partkey", "p_size")


@query("SELECT doc_id FROM documents WHERE NOT (length(regexp_replace(text, '[^.]', '', 'g')) / n_chars::DOUBLE < 0.01)")
def coverage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return stats.coverage_gate(docs, F.char_length(F.regexp_replace("text", "[^.]", "")).cast("double"), F.col("n_chars"), 0.01).select("doc_id")


@query("SELECT p_brand, count(*) AS n_videos, CAST(sum(p_size) AS BIGINT) AS n_masks FROM part GROUP BY 1")
def component_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.component_summary(table(spark, sf_dir, "part"), "p_brand", F.col("p_size"))


@query(
    """WITH i AS (SELECT o_orderstatus <> 'F' AS positive, CASE WHEN o_orderstatus <> 'F' OR o_orderkey % 2 = 0 THEN 3 ELSE 0 END AS tried, o_orderkey % 4 AS got FROM orders)
SELECT count(*) AS train_images_total, count(*) FILTER (WHERE positive) AS train_images_with_labels, count(*) FILTER (WHERE NOT positive) AS train_images_hard_negatives,
  CAST(sum(tried) AS BIGINT) AS augmentation_attempts, CAST(sum(least(tried, got)) AS BIGINT) AS augmented_images_written, CAST(count(*) + sum(least(tried, got)) AS BIGINT) AS final_train_image_count FROM i"""
)
def aug_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    positive, k = F.col("o_orderstatus") != "F", F.col("o_orderkey")
    tried = F.when(positive | (k % 2 == 0), 3).otherwise(0)
    return stats.augmentation_summary(table(spark, sf_dir, "orders"), positive, tried, F.least(tried, k % 4))


@query(
    """SELECT l_returnflag, count(*) AS n_samples, CAST(trunc(quantile_cont(a, 0.5)) AS INTEGER) AS median_area, CAST(trunc(quantile_cont(a, 0.05)) AS INTEGER) AS p05_area, CAST(trunc(quantile_cont(a, 0.95)) AS INTEGER) AS p95_area
FROM (SELECT l_returnflag, (l_quantity * 10 - 20)::DOUBLE AS a FROM lineitem) WHERE a > 0 GROUP BY 1"""
)
def size_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.size_calibration(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity"), "l_returnflag", (F.col("l_quantity") * 10 - 20).cast("double"))


@query(
    """WITH i AS (SELECT event_type, user_id, stddev_pop(value) / 4 AS noise FROM events GROUP BY 1, 2)
SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value) + 0.000001, 6) AS std, round(first(noise), 6) AS noise, count(value) AS n_pixels, count(DISTINCT user_id) AS n_images
FROM events JOIN (SELECT event_type, avg(noise) AS noise FROM i GROUP BY 1) USING (event_type) GROUP BY 1"""
)
def source_pool_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = stats.image_partials(table(spark, sf_dir, "events"), "user_id", "event_type", F.col("value"))
    pools = stats.pool(partials, "event_type", F.col("sd") / 4)
    return pools.select("event_type", *[F.round(c, 6).alias(c) for c in ("mean", "std", "noise")], "n_pixels", "n_images")


_MOVED_SQL = """WITH t AS (SELECT event_type, avg(value) AS m, stddev_pop(value) + 0.000001 AS s FROM events GROUP BY 1)
SELECT event_id, round(greatest(0, least(255, (value - (SELECT m FROM t WHERE event_type = 'click')) / (SELECT s FROM t WHERE event_type = 'click')
  * (SELECT s FROM t WHERE event_type = 'view') + (SELECT m FROM t WHERE event_type = 'view'))), 6) AS moved FROM events WHERE event_type = 'click'"""


@query(_MOVED_SQL)
def reinhard_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.moved(table(spark, sf_dir, "events"), "event_type", "value", "click", "view").select("event_id", F.round("moved", 6).alias("moved"))


@query(
    """WITH u AS (SELECT user_id, event_type, stddev_pop(value) AS s FROM events GROUP BY 1, 2), g AS (SELECT event_type, stddev_pop(value) AS g FROM events GROUP BY 1)
SELECT user_id, event_type, round(CASE WHEN g > s THEN sqrt(g * g - s * s) ELSE 0 END, 6) AS noise FROM u JOIN g USING (event_type)"""
)
def noise_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    own = e.groupBy("user_id", "event_type").agg(F.stddev_pop("value").alias("s"))
    whole = e.groupBy("event_type").agg(F.stddev_pop("value").alias("g"))
    return own.join(whole, "event_type").select("user_id", "event_type", F.round(numbers.noise_to_add(F.col("g"), F.col("s")), 6).alias("noise"))


@query(
    """WITH g AS (SELECT user_id, min(event_type) AS grp FROM events WHERE user_id % 3 <> 0 GROUP BY 1), p AS (SELECT event_type AS grp, avg(value) AS mean FROM events WHERE event_type <> 'click' GROUP BY 1),
n AS (SELECT user_id, count(*) FILTER (WHERE value > 90) AS n_polys, avg(value) FILTER (WHERE value > 90) AS own FROM events GROUP BY 1)
SELECT user_id, grp, round(CASE WHEN n_polys > 0 THEN own ELSE p.mean END, 6) AS mean FROM n LEFT JOIN g USING (user_id) LEFT JOIN p USING (grp)"""
)
def pool_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    group_of = e.filter("user_id % 3 <> 0").groupBy("user_id").agg(F.min("event_type").alias("grp"))
    pools = e.filter("event_type <> 'click'").groupBy(F.col("event_type").alias("grp")).agg(F.avg("value").alias("mean"))
    own = e.groupBy("user_id").agg(F.count_if(F.col("value") > 90).alias("n_polys"), F.avg(F.when(F.col("value") > 90, F.col("value"))).alias("own"))
    rows = stats.with_pool(own, group_of, pools, "user_id", "grp")
    return rows.select("user_id", "grp", F.round(F.when(F.col("n_polys") > 0, F.col("own")).otherwise(F.col("mean")), 6).alias("mean"))


# --- polygons ---------------------------------------------------------------------------------------------------


@query(f"WITH {XY_SQL} SELECT vec_id, CAST(i AS INTEGER) AS i, round(x, 6) AS x, round(y, 6) AS y FROM xy")
def poly_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = polygon_rows(spark, sf_dir).select("vec_id", F.posexplode(polygons.points(F.col("flat"))).alias("i", "p"))
    return rows.select("vec_id", "i", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


def _sides() -> tuple:
    return F.lit(128.0), F.lit(72.0)


@query(f"WITH {XY_SQL} SELECT vec_id, CAST(i AS INTEGER) AS i, round(x / 128, 6) AS x, round(y / 72, 6) AS y FROM xy")
def poly_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = polygons.normalized(F.col("flat"), *_sides())
    rows = polygon_rows(spark, sf_dir).select("vec_id", F.posexplode(polygons.points(flat)).alias("i", "p"))
    return rows.select("vec_id", "i", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query(f"WITH {XY_SQL} SELECT vec_id, CAST(i AS INTEGER) AS i, round(greatest(0::FLOAT, least(1::FLOAT, x::FLOAT / 128::FLOAT))::DOUBLE, 5) AS x, round(greatest(0::FLOAT, least(1::FLOAT, y::FLOAT / 72::FLOAT))::DOUBLE, 5) AS y FROM xy")
def poly_normalize_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = polygons.normalized(F.col("flat"), *_sides(), clip=True)
    rows = polygon_rows(spark, sf_dir).select("vec_id", F.posexplode(polygons.points(flat)).alias("i", "p"))
    return rows.select("vec_id", "i", F.round("p.x", 5).alias("x"), F.round("p.y", 5).alias("y"))


@query(f"WITH {XY_SQL} SELECT vec_id, list(CAST(trunc(x * 1.28) AS INTEGER) ORDER BY i) AS xs, list(CAST(trunc(y * 0.72) AS INTEGER) ORDER BY i) AS ys FROM xy GROUP BY 1")
def poly_to_px(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = polygons.to_pixels(F.col("flat"), F.lit(1.28), F.lit(0.72))
    axis = lambda odd: F.filter("px", lambda v, i: i % 2 == odd)
    return polygon_rows(spark, sf_dir).select("vec_id", flat.alias("px")).select("vec_id", axis(0).alias("xs"), axis(1).alias("ys"))


@query(f"WITH {XY_SQL} SELECT vec_id, round(min(x), 6) AS x0, round(min(y), 6) AS y0, round(max(x), 6) AS x1, round(max(y), 6) AS y1, CAST(max(trunc(x)) - min(trunc(x)) + 1 AS INTEGER) AS w FROM xy GROUP BY 1")
def poly_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("flat", lambda v: v.cast("int"))
    b = polygons.bounds(F.col("flat"))
    return polygon_rows(spark, sf_dir).select("vec_id", *[F.round(b[c], 6).alias(c) for c in ("x0", "y0", "x1", "y1")], polygons.pixel_rect(whole)["w"].alias("w"))


AREA_SQL = f"{XY_SQL}, area AS (SELECT vec_id, label, abs(sum(x * y2 - x2 * y)) / 2 AS area FROM xy GROUP BY 1, 2)"


@query(f"WITH {AREA_SQL} SELECT vec_id, round(area, 4) AS area FROM area")
def poly_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygon_rows(spark, sf_dir).select("vec_id", F.round(polygons.area(F.col("flat")), 4).alias("area"))


@query(f"WITH {AREA_SQL} SELECT label, arg_max(vec_id, (area, -vec_id)) AS vec_id, round(max(area), 4) AS area FROM area WHERE area >= 1 GROUP BY 1")
def largest_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = polygon_rows(spark, sf_dir).withColumn("area", polygons.area(F.col("flat"))).filter("area >= 1")
    return rows.groupBy("label").agg(F.max_by("vec_id", F.struct(F.col("area"), -F.col("vec_id"))).alias("vec_id"), F.round(F.max("area"), 4).alias("area"))


@query("SELECT vec_id, CAST(n // 2 AS INTEGER) AS n_points FROM (SELECT vec_id, len(list_filter(embedding, lambda x: x > 0.2)) AS n FROM embeddings) WHERE n // 2 >= 3")
def point_count_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.filter("embedding", lambda x: x > 0.2).alias("flat"))
    return rows.withColumn("n_points", polygons.n_points(F.col("flat"))).filter("n_points >= 3").select("vec_id", "n_points")


BOX_SQL = """b AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x0, embedding[2]::DOUBLE AS y0, embedding[1]::DOUBLE + abs(embedding[3]::DOUBLE) AS x1, embedding[2]::DOUBLE + abs(embedding[4]::DOUBLE) AS y1 FROM embeddings),
pairs AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS i,
  (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS s FROM b a JOIN b USING (label))"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = lambda i: F.col("embedding")[i].cast("double")
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", numbers.box(v(0), v(1), v(0) + F.abs(v(2)), v(1) + F.abs(v(3))).alias("box"))


@query(f"WITH {BOX_SQL} SELECT label, a, b, round(i / (s - i), 6) AS iou FROM pairs WHERE a < b AND i > 0 AND s - i > 0")
def bbox_iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paste.pairs_iou(boxes(spark, sf_dir), "label", "vec_id", "box").select("label", "a", "b", F.round("iou", 6).alias("iou"))


@query(f"WITH {BOX_SQL} SELECT vec_id, label FROM b WHERE vec_id % 2 = 1 AND vec_id NOT IN (SELECT a FROM pairs WHERE a % 2 = 1 AND b % 2 = 0 AND i > 0 AND i / (s - i) > 0.05)")
def iou_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir)
    return paste.free(b.filter("vec_id % 2 = 1"), b.filter("vec_id % 2 = 0"), "label", "box").select("vec_id", "label")


@query(
    """WITH v AS (SELECT o_orderkey, unnest(range(0, 3)) AS aug FROM orders),
t AS (SELECT *, 1 + CAST('0x' || substr(md5('42:n:' || o_orderkey || ':' || aug), 1, 7) AS BIGINT) % 3 AS n_target FROM v),
a AS (SELECT *, unnest(range(0, 2 * n_target)) AS attempt FROM t),
c AS (SELECT *, list_transform(list_sort(list_transform(['gear_1', 'nut_1', 'screw_1', 'screw_2'], lambda c: {'h': md5('42:c:' || o_orderkey || ':' || aug || ':' || c), 'c': c})), lambda s: s.c)[attempt % 4 + 1] AS component FROM a),
s AS (SELECT l_returnflag, CAST(trunc(quantile_cont(l_quantity * 10, 0.5)) AS INTEGER) AS median_area FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(aug AS INTEGER) AS aug, CAST(attempt AS INTEGER) AS attempt, CAST(n_target AS INTEGER) AS n_target, component,
  greatest(50, CAST(trunc(median_area * (1 + 0.2 * (CAST('0x' || substr(md5('42:a:' || o_orderkey || ':' || aug || ':' || attempt), 1, 7) AS BIGINT) / 268435456.0::DOUBLE * 2 - 1))) AS INTEGER)) AS target_area
FROM c JOIN s ON l_returnflag = CASE split_part(component, '_', 1) WHEN 'screw' THEN 'A' WHEN 'nut' THEN 'N' ELSE 'R' END"""
)
def paste_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("gear_1", "nut_1", "screw_1", "screw_2")
    rows = paste.attempts(table(spark, sf_dir, "orders"), "o_orderkey", names, 3, 1, 3, SEED)
    first = strings.component_class(F.col("component"))
    class_of = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("component")).withColumn("l_returnflag", F.when(first == "screw", "A").when(first == "nut", "N").otherwise("R"))
    sizes = stats.size_calibration(table(spark, sf_dir, "lineitem"), "l_returnflag", F.col("l_quantity") * 10)
    out = paste.sized(rows, "o_orderkey", class_of, sizes, "component", "l_returnflag", "median_area", 0.2, SEED)
    return out.select("o_orderkey", "aug", "attempt", "n_target", "component", "target_area")


# --- streams and rasters ----------------------------------------------------------------------------------------


@query(
    f"""WITH {FRAMES_SQL}, r AS (SELECT *, min(ts_ns) OVER (PARTITION BY user_id) AS f, max(ts_ns) OVER (PARTITION BY user_id) - min(ts_ns) OVER (PARTITION BY user_id) AS d FROM e),
t AS (SELECT *, floor((ts_ns - f - {DAY}) / {2.0 * DAY}) AS b, row_number() OVER (PARTITION BY user_id ORDER BY ts_ns, event_id) AS i FROM r WHERE ts_ns - f >= {DAY} AND ts_ns - f < greatest(0, d - {2 * DAY})),
c AS (SELECT *, i + least(0, min(b + 1 - i) OVER (PARTITION BY user_id ORDER BY ts_ns, event_id)) AS c FROM t),
p AS (SELECT *, coalesce(lag(c) OVER (PARTITION BY user_id ORDER BY ts_ns, event_id), 0) AS p FROM c)
SELECT user_id, event_id, ts_ns, CAST(c - 1 AS BIGINT) AS sample_no FROM p WHERE c > p"""
)
def stream_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of files, sampled with state, as far as there are files now."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{sf_dir}/events.parquet*")
    stream = stream.withColumn("ts_ns", F.unix_micros(F.col("ts").cast("timestamp")) * 1000)
    kept = sampler.sample(stream, "user_id", "ts_ns", "event_id", 2 * DAY, DAY, 2 * DAY)
    out = fresh_dir(spark, "stream-sample")
    run = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-log").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(kept.schema).parquet(out).select("user_id", "event_id", "ts_ns", "sample_no")


def _fill_sql(vertices: str, value: str) -> str:
    """Pixels of fills by parity, edges included: vertices has (vec_id, ring, i, x, y), in whole pixels."""
    return f"""v AS ({vertices}),
edge AS (SELECT vec_id, x AS x0, y AS y0, coalesce(lead(x) OVER w, first(x) OVER w) AS x1, coalesce(lead(y) OVER w, first(y) OVER w) AS y1 FROM v WINDOW w AS (PARTITION BY vec_id, ring ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
crossing AS (SELECT vec_id, r AS y, x0 + ((r - y0) * (x1 - x0))::DOUBLE / (y1 - y0) AS x FROM (SELECT *, unnest(range(least(y0, y1), greatest(y0, y1))) AS r FROM edge WHERE y0 <> y1)),
sorted AS (SELECT *, row_number() OVER (PARTITION BY vec_id, y ORDER BY x) AS k, lead(x) OVER (PARTITION BY vec_id, y ORDER BY x) AS until FROM crossing),
inside AS (SELECT vec_id, unnest(range(ceil(x)::BIGINT, floor(until)::BIGINT + 1)) AS x, y FROM sorted WHERE k % 2 = 1),
step AS (SELECT *, unnest(range(0, greatest(abs(x1 - x0), abs(y1 - y0)) + 1)) AS k, greatest(abs(x1 - x0), abs(y1 - y0)) AS n FROM edge),
outline AS (SELECT vec_id, round_even(CASE WHEN n = 0 THEN x0 ELSE k * ((x1 - x0)::DOUBLE / n) + x0 END, 0)::BIGINT AS x, round_even(CASE WHEN n = 0 THEN y0 ELSE k * ((y1 - y0)::DOUBLE / n) + y0 END, 0)::BIGINT AS y FROM step)
SELECT vec_id, count(*) AS {value} FROM (SELECT vec_id, x, y FROM inside UNION SELECT vec_id, x, y FROM outline) WHERE x BETWEEN 0 AND 255 AND y BETWEEN 0 AND 255 GROUP BY 1"""


@query(f"WITH {XY_SQL}, " + _fill_sql("SELECT vec_id, 0 AS ring, i, trunc(x)::BIGINT AS x, trunc(y)::BIGINT AS y FROM xy", "n_pixels"))
def raster_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of each polygon, filled on a canvas of 256 by 256."""
    rows = polygon_rows(spark, sf_dir).select("vec_id", F.transform("flat", lambda v: v / 256).alias("poly"))
    return rows.select("vec_id", augment.raster_area(F.col("poly"), F.lit(256), F.lit(256)).alias("n_pixels"))


@query(f"WITH {XY_SQL}, " + _fill_sql("SELECT vec_id, ring, i, trunc(x + 10 * ring)::BIGINT AS x, trunc(y + 10 * ring)::BIGINT AS y FROM xy, (VALUES (0), (1)) r(ring)", "n_pixels"))
def raster_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of the mask file of each polygon and its copy beside it, filled by parity."""
    rows = polygon_rows(spark, sf_dir).select("vec_id", F.array("flat", F.transform("flat", lambda v: v + 10)).alias("polys"))
    return rows.select("vec_id", augment.mask_pixels(augment.region_png(F.col("polys"), F.lit(256), F.lit(256))).alias("n_pixels"))

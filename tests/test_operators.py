import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import numbers, polygons, strings
from tessera.operators import annotations, layout, paste, ranking, sampling, splits, stats


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("path", "stem", "suffix", "parent"),
    [("a/b/c.tar.PNG", "c.tar", ".png", "b"), ("c", "c", "", ""), ("x/.hidden", ".hidden", "", "x"), ("x/y.", "y.", "", "x")],
)
def test_parts_of_paths(spark, path, stem, suffix, parent):
    p = F.lit(path)
    assert value(spark, strings.stem(p)) == stem
    assert value(spark, strings.suffix(p)) == suffix
    assert value(spark, strings.parent_name(p)) == parent


def test_keys_of_names(spark):
    assert value(spark, strings.setup_key(F.lit("12_Color"))) == "12"
    assert value(spark, strings.setup_key(F.lit("x12_Color"))) == "x12_Color"
    assert value(spark, strings.component_id(F.lit("screw_m4_03"))) == "screw_m4"
    assert value(spark, strings.take_number(F.lit("screw_m4_03"))) == "03"
    assert value(spark, strings.component_id(F.lit("screw_m4_a"))) == "screw_m4_a"
    assert value(spark, strings.take_number(F.lit("screw_m4_a"))) == "00"
    assert value(spark, strings.component_class(F.lit("screw_m4"))) == "screw"
    assert value(spark, strings.rgb_of_mask(F.lit("a/f_mask.png"))) == "a/f.png"


def test_frame_names_round_trip(spark):
    name = value(spark, strings.frame_name(F.lit("a_b"), F.lit(7), F.lit(1234)))
    assert name == "a_b_0007_t12.34s.png"
    assert value(spark, strings.frame_name(F.lit("a"), F.lit(12345), F.lit(5))) == "a_12345_t0.05s.png"
    assert value(spark, F.struct(strings.frame_stem(F.lit(name)), strings.frame_index(F.lit(name)), strings.frame_seconds(F.lit(name)))) == ("a_b", 7, 12.34)
    assert value(spark, strings.frame_index(F.lit("other.png"))) is None


@pytest.mark.parametrize(("n", "ratio", "want"), [(50, 0.15, 8), (30, 0.15, 4), (10, 0.25, 2), (0, 0.5, 0), (56, 0.15, 8)])
def test_shares_round_halves_to_even(spark, n, ratio, want):
    assert value(spark, numbers.share(F.lit(n), ratio)) == want == round(n * ratio)


def test_iou(spark):
    box = lambda *v: numbers.box(*[F.lit(float(x)) for x in v])
    a, b = box(0, 0, 10, 10), box(5, 5, 15, 15)
    assert value(spark, numbers.iou(a, b)) == pytest.approx(25 / 175)
    assert value(spark, numbers.iou(a, b)) == value(spark, numbers.iou(b, a))
    assert value(spark, numbers.iou(a, box(10, 0, 20, 10))) == 0
    assert value(spark, numbers.iou(box(1, 1, 1, 1), box(1, 1, 1, 1))) == 0


def test_areas_and_sides(spark):
    assert value(spark, numbers.target_area(F.lit(100), 0.2, F.lit(0.999999))) == 119
    assert value(spark, numbers.target_area(F.lit(40), 0.2, F.lit(0.0))) == 50
    assert value(spark, numbers.resized_side(F.lit(40), F.lit(400), F.lit(100))) == 20
    assert value(spark, numbers.resized_side(F.lit(10), F.lit(400), F.lit(4))) == 8
    assert value(spark, numbers.noise_to_add(F.lit(5.0), F.lit(3.0))) == 4
    assert value(spark, numbers.noise_to_add(F.lit(3.0), F.lit(5.0))) == 0
    assert value(spark, numbers.transfer(F.lit(300.0), F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(1.0))) == 255
    assert value(spark, numbers.pick(F.array(F.lit("a"), F.lit("b")), F.lit(5))) == "b"
    assert value(spark, numbers.pick(F.array().cast("array<string>"), F.lit(5))) is None


def flat(*v):
    return F.array(*[F.lit(float(x)) for x in v])


def test_polygons(spark):
    square = flat(0, 0, 4, 0, 4, 4, 0, 4)
    assert value(spark, polygons.area(square)) == 16
    assert value(spark, polygons.area(flat(0, 4, 4, 4, 4, 0, 0, 0))) == 16
    assert [tuple(p) for p in value(spark, polygons.points(square))] == [(0, 0), (4, 0), (4, 4), (0, 4)]
    assert tuple(value(spark, polygons.bounds(square))) == (0, 0, 4, 4)
    assert value(spark, polygons.pixel_rect(square))["w"] == 5
    assert value(spark, polygons.normalized(flat(8, 2), F.lit(4), F.lit(4))) == [2.0, 0.5]
    assert value(spark, polygons.normalized(flat(8, -2), F.lit(4), F.lit(4), clip=True)) == [1.0, 0.0]
    assert value(spark, polygons.to_pixels(flat(0.99, -0.99), F.lit(10), F.lit(10))) == [9, -9]
    with pytest.raises(Exception, match="odd number"):
        value(spark, polygons.points(flat(1, 2, 3)))


def test_first_and_largest_polygon(spark):
    small, large, line = flat(0, 0, 2, 0, 2, 2, 0, 2), flat(0, 0, 4, 0, 4, 4, 0, 4), flat(0, 0, 9, 9)
    assert value(spark, polygons.first_polygon(F.array(small, large))) == [0, 0, 2, 0, 2, 2, 0, 2]
    assert value(spark, polygons.first_polygon(F.array().cast("array<array<double>>"))) is None
    assert value(spark, polygons.largest_polygon(F.array(line, small, large, large)))[2] == 4
    assert value(spark, polygons.largest_polygon(F.array(line))) is None
    assert value(spark, polygons.largest_polygon(F.array(flat(0, 0, 1, 0, 0, 1)))) is None


def test_labels_as_text(spark):
    got = value(spark, polygons.parsed_label(F.lit(" 2 0.1 0.2 0.3 0.4 0.5 0.6 ")))
    assert (got["class_id"], got["poly"]) == (2, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6])
    assert value(spark, polygons.parsed_label(F.lit("2 0.1 0.2 0.3 0.4"))) is None
    assert value(spark, polygons.label_line(F.lit(1), flat(0.25, 0.5))) == "1 0.250000 0.500000"


def loop(times, stride, origin):
    kept, target = [], origin
    for t in times:
        if t >= target:
            kept.append(t)
            target += stride
    return kept


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(recordings=st.lists(st.lists(st.integers(0, 300), min_size=1, max_size=40, unique=True), min_size=1, max_size=8), stride=st.integers(1, 60))
def test_grid_with_catch_up_equals_the_loop(spark, recordings, stride):
    rows = [(r, t) for r, times in enumerate(recordings) for t in times]
    got = sampling.stride_sample(spark.createDataFrame(rows, "r int, t long"), "r", "t", "t", stride).collect()
    for r, times in enumerate(recordings):
        want = loop(sorted(times), stride, min(times))
        assert sorted((x["t"], x["sample_no"]) for x in got if x["r"] == r) == list(zip(want, range(len(want)), strict=True))


def test_gaps_are_caught_up(spark):
    times = [0, 1, 2, 50, 51, 52, 53, 54, 55, 56, 57, 58, 59, 60]
    got = sampling.stride_sample(spark.createDataFrame([(1, t) for t in times], "r int, t long"), "r", "t", "t", 10)
    assert sorted(x["t"] for x in got.collect()) == [0, 50, 51, 52, 53, 54, 60]


def test_trim_and_every_nth(spark):
    frames = spark.createDataFrame([(1, t) for t in range(10)], "r int, t long")
    assert sorted(x["t"] for x in sampling.trim(frames, "r", "t", 2, 3).collect()) == [2, 3, 4, 5]
    assert sampling.trim(frames, "r", "t", 5, 5).count() == 0
    assert sorted((x["t"], x["frame_no"]) for x in sampling.every_nth(frames, "r", "t", "t", 4).collect()) == [(0, 0), (4, 1), (8, 2)]
    assert sampling.with_offset(frames.filter("t > 3"), "r", "t").agg(F.max("offset")).first()[0] == 5


def test_ranks_equal_a_plain_sort_with_groups_and_nulls(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k long").repartition(3)
    number = ranking.hash_number(F.lit("s"), F.col("k"))
    got = ranking.ranked(df, [number, F.col("k")], ranking.hash_bucket(number), "r", ("g",), "n").collect()
    for g in ("a", "b", None):
        own = [x for x in got if x["g"] == g]
        assert sorted(x["r"] for x in own) == list(range(1, len(own) + 1)) and {x["n"] for x in own} == {len(own)}
    whole = annotations.renumber(df, ["k"], "id").collect()
    assert all(x["id"] == x["k"] + 1 for x in whole)
    cut = ranking.ranked(df, [F.col("k")], ranking.range_bucket(df, F.col("k").cast("double"), 16, 40), "r").collect()
    assert all(x["r"] == x["k"] + 1 for x in cut)
    assert df.select(ranking.range_bucket(df, F.col("k").cast("double"), 16, 40).alias("b")).distinct().count() == 13


@pytest.mark.parametrize(("n", "want"), [(50, (34, 8, 8)), (101, (71, 15, 15)), (200, (140, 30, 30))])
def test_split_sizes(spark, n, want):
    keys = spark.createDataFrame([(f"f{i}",) for i in range(n)], "k string")
    got = {r["split"]: r["n"] for r in splits.counts_by_split(splits.train_first(keys, "k", 0.15, 0.15, 0)).collect()}
    assert (got["train"], got["val"], got["test"]) == want
    exact = splits.exact_ratio({"": [f"f{i}" for i in range(n)]}, 0.15, 0.15, 0, train_first=True)
    assert tuple(sum(s == x for _, _, s in exact) for x in ("train", "val", "test")) == want


def test_fixed_splits_are_a_partition_and_do_not_depend_on_partitions(spark):
    keys = spark.createDataFrame([(g, f"k{i}") for g in "ab" for i in range(7)] + [("c", "only")], "g string, k string")
    a = splits.fixed_split(keys, "g", "k", 2, 3, 42)
    b = splits.fixed_split(keys.repartition(5), "g", "k", 2, 3, 42)
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 15
    n = {(r["g"], r["split"]): r["n"] for r in a.groupBy("g", "split").agg(F.count("*").alias("n")).collect()}
    assert n["a", "val"] == 2 and n["a", "test"] == 3 and n["a", "train"] == 2 and n["c", "val"] == 1
    assert [r["g"] for r in splits.starved(a, "g").collect()] == ["c"]


def test_exact_splits_follow_one_generator(spark):
    groups = {"1": ["3", "1", "2", "10"], "2": ["a", "b", "c"]}
    rng = random.Random(42)
    want = []
    for g, keys in groups.items():
        keys = sorted(keys)
        rng.shuffle(keys)
        want += [(g, keys[0], "val"), (g, keys[1], "test"), *((g, k, "train") for k in keys[2:])]
    assert splits.exact_fixed(groups, [1, 1], [1, 1]) == want
    keys = spark.createDataFrame([(g, k) for g, ks in groups.items() for k in ks], "g string, k string")
    assert splits.keys_by_group(keys, "g", "k") == {g: sorted(ks) for g, ks in groups.items()}
    got = splits.assignment(keys, want, "g", "k")
    assert sorted((r["g"], r["k"], r["split"]) for r in got.collect()) == sorted(want)


def test_ratios_and_arity_are_checked():
    splits.check_ratios(0.7, 0.15, 0.15)
    for bad in ((0.7, 0.2, 0.2), (0, 0.5, 0.5), (1.2, -0.1, -0.1)):
        with pytest.raises(ValueError):
            splits.check_ratios(*bad)
    assert splits.per_export([3], 2) == [3, 3] and splits.per_export([3, 1], 2) == [3, 1]
    with pytest.raises(ValueError):
        splits.per_export([1, 2, 3], 2)


def test_missing_splits(spark):
    rows, table = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a", "val")], "k string, split string")
    assert sorted(splits.attach(rows, table, "k").collect()) == [("a", "val"), ("b", "train")]
    with pytest.raises(Exception, match="no split for b"):
        splits.attach(rows, table, "k", default=None).collect()
    assert [r["k"] for r in splits.without_split(rows, table, "k").collect()] == ["b"]


def anns(spark):
    return spark.createDataFrame([(1, 1, "screw"), (1, 2, "ignore"), (2, 3, "nut"), (2, 4, "gear"), (4, 5, "platform")], "image long, id long, label string")


def test_keep_and_drop(spark):
    a = anns(spark)
    kept = annotations.images_to_keep(a, "image", "label", ("screw", "nut", "gear"), ("ignore",))
    assert [r["image"] for r in kept.collect()] == [2]
    assert sorted(r["image"] for r in annotations.images_to_keep(a, "image", "label", ("screw", "nut"), ()).collect()) == [1, 2]
    images, rows = annotations.canonical(kept, a, "image", ["id"], "label", ("screw", "nut", "gear"))
    assert [tuple(r) for r in images.collect()] == [(2, 1)]
    assert sorted((r["id"], r["new_image_id"], r["new_category_id"], r["new_annotation_id"]) for r in rows.collect()) == [(3, 1, 2, 1), (4, 1, 3, 2)]


def test_checks(spark):
    a = anns(spark)
    assert [r["label"] for r in annotations.missing_labels(a, "label", ("screw", "bolt")).collect()] == ["bolt"]
    assert sorted(tuple(r) for r in annotations.missing_labels(a.filter("image < 3"), "label", ("screw", "nut"), "image").collect()) == [(1, "nut"), (2, "screw")]
    with pytest.raises(ValueError, match="labels are missing"):
        annotations.require(annotations.missing_labels(a, "label", ("bolt",)), "labels are missing")
    both = spark.createDataFrame([("s", 0), ("s", 1), ("t", 1)], "setup string, export int")
    assert [tuple(r) for r in annotations.collisions(both, "setup", "export").collect()] == [("s", [0, 1])]
    images = spark.createDataFrame([(1,), (3,)], "image long")
    assert sorted((r["image"], len(r["annotations"])) for r in annotations.with_annotations(images, a, "image", "id", ["label"]).collect()) == [(1, 2), (3, 0)]
    assert sorted(tuple(r) for r in annotations.positives(images, a, "image").collect()) == [(1, True), (3, False)]


def test_categories_by_name(spark):
    cats = spark.createDataFrame([(0, 1, "screw"), (0, 2, "nut"), (1, 7, "nut")], "export int, id long, name string")
    assert sorted(tuple(r) for r in annotations.canonical_categories(cats, "export", "id", "name").collect()) == [(0, 1, 1), (0, 2, 2), (1, 7, 2)]
    with pytest.raises(Exception, match="not in the first export"):
        annotations.canonical_categories(cats.union(spark.createDataFrame([(1, 8, "bolt")], cats.schema)), "export", "id", "name").collect()


def test_merged_ids_follow_exports(spark):
    a, b = spark.createDataFrame([(5,), (3,)], "id long"), spark.createDataFrame([(4,)], "id long")
    assert sorted((r["export_no"], r["id"], r["new_id"]) for r in annotations.merged([a, b], ["id"]).collect()) == [(0, 3, 1), (0, 5, 2), (1, 4, 3)]


def test_locating_files(spark):
    files = spark.createDataFrame([("images/default/a.png",), ("images/a.png",), ("deep/er/b.png",), ("deep/b.png",)], "p string")
    got = layout.locate(spark.createDataFrame([("a.png",), ("b.png",), ("c.png",)], "n string"), "n", files, "p")
    assert sorted((r["n"], r["path"]) for r in got.collect()) == [("a.png", "images/a.png"), ("b.png", "deep/b.png"), ("c.png", None)]


def test_pairs_splits_and_done(spark):
    files = spark.createDataFrame([("r/c/k/f1_mask.png",), ("r/c/k/f1.png",), ("r/c/k/f2_mask.png",)], "p string")
    assert [tuple(r)[:3] for r in layout.mask_pairs(files, "p").collect()] == [("c", "k", "f1")]
    listing = spark.createDataFrame([("o/images/train/1_Color.png",), ("o/images/val/1_empty.PNG",), ("o/images/test/2_Color.txt",)], "p string")
    key = strings.setup_key(strings.stem(F.col("p")))
    assert [tuple(r) for r in layout.splits_from_folders(listing, "p", key).collect()] == [("1", "val")]
    assert [r["p"] for r in layout.to_do(files, files.filter("p like '%f1%'"), ["p"]).collect()] == ["r/c/k/f2_mask.png"]
    stems = spark.createDataFrame([("s", "a", 0), ("s", "b", 1), ("t", "a", 0)], "stem string, source string, part int")
    one, many = layout.source_index(stems, "stem", "source", F.col("part"))
    assert sorted(tuple(r) for r in one.collect()) == [("s", "b"), ("t", "a")]
    assert sorted(tuple(r) for r in many.collect()) == [("a", ["t"]), ("b", ["s"])]


def test_pools_by_parts_equal_the_whole(spark):
    rng = random.Random(2)
    rows = [(f"i{k % 7}", "g", rng.uniform(1000, 1001)) for k in range(400)]
    df = spark.createDataFrame(rows, "image string, grp string, v double")
    got = stats.pool(stats.image_partials(df, "image", "grp", F.col("v")), "grp").first()
    want = df.agg(F.avg("v"), F.stddev_pop("v") + 1e-6).first()
    assert got["mean"] == pytest.approx(want[0]) and got["std"] == pytest.approx(want[1], rel=1e-6)
    assert (got["n_pixels"], got["n_images"]) == (400, 7)


def test_gates(spark):
    clips = spark.createDataFrame([(1280, 720), (1279, 720), (None, 720), (0, 0)], "w int, h int")
    assert stats.resolution_gate(clips, "w", "h").count() == 1
    masks = spark.createDataFrame([(1.0, 1000), (0.9, 1000)], "n double, whole int")
    assert stats.coverage_gate(masks, F.col("n"), F.col("whole")).count() == 1


def test_pastes(spark):
    images = spark.createDataFrame([(i,) for i in range(20)], "image long")
    a = paste.attempts(images, "image", ("x", "y", "z"), 3, 1, 4, 7)
    per = a.groupBy("image", "aug").agg(F.max("n_target").alias("n"), F.count("*").alias("tries")).collect()
    assert len(per) == 60 and all(r["tries"] == 2 * r["n"] and 1 <= r["n"] <= 4 for r in per)
    assert sorted(a.collect()) == sorted(paste.attempts(images.repartition(7), "image", ("x", "y", "z"), 3, 1, 4, 7).collect())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30), st.integers(0, 30), st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=25))
def test_overlapping_pairs_equal_all_pairs(spark, rows):
    rows = [(i, g, float(x), float(y), float(x + w), float(y + h)) for i, (g, x, y, w, h) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k long, g int, a double, b double, c double, d double")
    boxes = df.select("k", "g", numbers.box(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("box"))
    want = set()
    for p in rows:
        for q in rows:
            w, h = min(p[4], q[4]) - max(p[2], q[2]), min(p[5], q[5]) - max(p[3], q[3])
            if p[0] < q[0] and p[1] == q[1] and w > 0 and h > 0:
                want.add((p[1], p[0], q[0]))
    assert {(r["g"], r["a"], r["b"]) for r in paste.pairs_iou(boxes, "g", "k", "box").collect()} == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 300), st.integers(0, 300), st.sampled_from([1, 2, 7, 250]), st.sampled_from([1, 3, 90])), min_size=2, max_size=25))
def test_free_boxes_equal_all_pairs_for_boxes_of_all_sizes(spark, rows):
    rows = [(i, g, float(x), float(y), float(x + w), float(y + h)) for i, (g, x, y, w, h) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k long, g int, a double, b double, c double, d double")
    boxes = df.select("k", "g", numbers.box(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("box"))

    def overlap(p, q):
        w, h = min(p[4], q[4]) - max(p[2], q[2]), min(p[5], q[5]) - max(p[3], q[3])
        i = max(w, 0) * max(h, 0)
        return i / ((p[4] - p[2]) * (p[5] - p[3]) + (q[4] - q[2]) * (q[5] - q[3]) - i)

    want = [p[0] for p in rows if p[0] % 2 and not any(q[0] % 2 == 0 and q[1] == p[1] and overlap(p, q) > 0.05 for q in rows)]
    assert sorted(r["k"] for r in paste.free(boxes.filter("k % 2 = 1"), boxes.filter("k % 2 = 0"), "g", "box").collect()) == want
    pairs = {(r["a"], r["b"]) for r in paste.pairs_iou(boxes, "g", "k", "box").collect()}
    assert pairs == {(p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and p[1] == q[1] and overlap(p, q) > 0}


def test_hot_groups_are_dealt_to_ranges(spark, monkeypatch):
    """A recording, an export and a class with all rows: the same results from several ranges, and no range has half of them."""
    from tessera.operators import ranking

    monkeypatch.setattr(ranking.range_bucket, "__defaults__", (ranking.BUCKETS, 50))
    rng = random.Random(5)
    times = sorted(rng.sample(range(100_000), 800))
    frames = spark.createDataFrame([("hot", t, i) for i, t in enumerate(times)] + [("cold", 7, 900), (None, 3, 901), (None, 99_000, 902)], "r string, t long, i long").repartition(5)

    def plain(own, stride):
        out, target = [], own[0]
        for t in own:
            if t >= target:
                out.append(t)
                target += stride
        return out

    for stride in (50, 130, 400):
        got = sampling.stride_sample(frames, "r", "t", "i", stride).collect()
        for name, own in (("hot", times), ("cold", [7]), (None, [3, 99_000])):
            assert [x["t"] for x in sorted((x for x in got if x["r"] == name), key=lambda x: x["sample_no"])] == plain(own, stride)
    assert sorted(x["t"] for x in sampling.every_nth(frames, "r", "t", "i", 9).filter("r = 'hot'").collect()) == times[::9]
    placed = sampling._placed(frames, "r", "t", "i", ranking.range_bucket(frames, F.col("t").cast("double")))
    assert max(x["n"] for x in placed.groupBy("r", "__range").agg(F.count("*").alias("n")).collect()) <= 200
    merged = annotations.merged([frames.select(F.col("i").alias("id")), frames.select((F.col("i") * 2).alias("id"))], ["id"]).collect()
    assert [x["id"] for x in sorted(merged, key=lambda x: x["new_id"])] == sorted(range(800)) + [900, 901, 902] + [2 * i for i in range(800)] + [1800, 1802, 1804]
    areas = [rng.choice([5, 5, 5, rng.randrange(1, 10_000)]) for _ in range(700)]
    sized = spark.createDataFrame([("k", a) for a in areas], "c string, a int")
    got = stats.size_calibration(sized, "c", F.col("a")).first()
    want = np.percentile(areas, [50, 5, 95])
    assert got["n_samples"] == 700 and [got["median_area"], got["p05_area"], got["p95_area"]] == [int(v) for v in want]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "long"])
def test_every_nth_ranges_times_of_any_type(spark, monkeypatch, kind):
    """Also times that a zone's clock leaves out or has twice, which stay in their order."""
    monkeypatch.setattr(ranking.range_bucket, "__defaults__", (ranking.BUCKETS, 20))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        k = F.col("id")
        time = k if kind == "long" else (F.lit("2024-03-09").cast("timestamp_ntz") + F.make_dt_interval(mins=(k * 17).cast("int"))).cast(kind)
        frames = spark.range(300).select((k % 2).alias("r"), (299 - k).alias("i"), time.alias("t")).repartition(5)
        want = {(r, i, n) for r in (0, 1) for n, i in enumerate([x["i"] for x in frames.filter(F.col("r") == r).orderBy("t", "i").collect()][::7])}
        assert {(x["r"], x["i"], x["frame_no"]) for x in sampling.every_nth(frames, "r", "t", "i", 7).collect()} == want
        assert frames.select(ranking.range_bucket(frames, sampling._number(frames, "t"))).distinct().count() >= 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_recordings_without_images(spark):
    topics = spark.createDataFrame([("a", 1, "/imu", "Imu"), ("b", 1, "/x", "Image"), ("b", 2, "/y", "Imu")], "r string, id int, name string, type string")
    assert [x["r"] for x in sampling.without_topic(topics, ["r"], "id", "name", F.col("type")).collect()] == ["a"]

import json
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.plans import runs
from tessera.raster import augment
from tessera.sinks import files as out
from tessera.sinks import labels as text
from tessera.sources import coco, labels, png, recordings
from tessera.sources import files as found


def cdr(width, height, encoding, pixels):
    body = struct.pack("<II", 1, 2)

    def put(fmt, v):
        nonlocal body
        body += b"\0" * (-len(body) % 4) + struct.pack(fmt, v)

    def string(s):
        nonlocal body
        put("<I", len(s) + 1)
        body += s.encode() + b"\0"

    string("cam")
    put("<I", height)
    put("<I", width)
    string(encoding)
    body += b"\0"
    put("<I", width * {"mono8": 1, "rgb8": 3, "bgra8": 4}.get(encoding, 2))
    put("<I", len(pixels))
    return b"\0\1\0\0" + body + pixels


@pytest.fixture
def db3(tmp_path):
    path = tmp_path / "r.db3"
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE topics (id INTEGER, name TEXT, type TEXT)")
    db.execute("CREATE TABLE messages (id INTEGER, topic_id INTEGER, timestamp INTEGER, data BLOB)")
    db.executemany("INSERT INTO topics VALUES (?, ?, ?)", [(1, "/depth/image", "Image"), (2, "/color/image", "Image"), (3, "/imu", "Imu")])
    rows = [(i, 1 + i % 3, 1000 * i, cdr(2, 1, "rgb8", bytes([1, 2, 3, 4, 5, 6])) if i % 2 else b"broken") for i in range(60)]
    db.executemany("INSERT INTO messages VALUES (?, ?, ?, ?)", rows)
    db.commit()
    db.close()
    return str(path)


def test_sqlite_recording(spark, db3):
    got = recordings.read_recording(spark, db3)
    assert got.count() == 60
    one = got.filter("topic_id = 2")
    assert [r["timestamp_ns"] for r in one.orderBy("timestamp_ns").collect()] == [1000 * i for i in range(60) if i % 3 == 1]
    images = recordings.with_images(one)
    assert images.count() == 10
    assert bytes(images.first()["image"]["data"]) == bytes([3, 2, 1, 6, 5, 4])


def test_image_messages():
    assert recordings.decode_image(cdr(2, 1, "mono8", b"\7\10"))["data"] == bytes([7, 7, 7, 8, 8, 8])
    assert recordings.decode_image(cdr(1, 1, "bgra8", b"\1\2\3\4"))["data"] == bytes([1, 2, 3])
    assert recordings.decode_image(cdr(1, 1, "yuv", b"\1\2")) is None
    assert recordings.decode_image(b"") is None and recordings.decode_image(None) is None


def test_bag(spark, tmp_path):
    import bz2

    def header(**kv):
        h = b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k.encode() + b"=" + v for k, v in kv.items())
        return struct.pack("<I", len(h)) + h

    def record(data, **kv):
        return header(**kv) + struct.pack("<I", len(data)) + data

    conn = struct.pack("<I", 0)
    inner = header(topic=b"/c", type=b"Image")[4:]
    chunk = record(inner, op=b"\7", conn=conn, topic=b"/c") + record(b"abc", op=b"\2", conn=conn, time=struct.pack("<II", 2, 5))
    path = tmp_path / "r.bag"
    path.write_bytes(b"#ROSBAG V2.0\n" + record(bz2.compress(chunk), op=b"\5", compression=b"bz2", size=conn))
    got = recordings.read_recording(spark, str(path)).collect()
    assert [(r["topic"], r["type"], r["timestamp_ns"], bytes(r["data"])) for r in got] == [("/c", "Image", 2_000_000_005, b"abc")]


def test_images_of_a_bag(spark, tmp_path):
    def header(**kv):
        h = b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k.encode() + b"=" + v for k, v in kv.items())
        return struct.pack("<I", len(h)) + h

    def record(data, **kv):
        return header(**kv) + struct.pack("<I", len(data)) + data

    def image(seq, encoding, step, pixels):
        text = lambda s: struct.pack("<I", len(s)) + s
        return struct.pack("<III", seq, 1, 2) + text(b"camera") + struct.pack("<II", 1, 2) + text(encoding) + b"\0" + struct.pack("<I", step) + text(pixels)

    conn = struct.pack("<I", 0)
    sent = [image(256, b"rgb8", 6, bytes([1, 2, 3, 4, 5, 6])), image(1, b"mono8", 2, b"\7\10"), b"broken"]
    chunk = record(header(topic=b"/c", type=b"sensor_msgs/Image")[4:], op=b"\7", conn=conn, topic=b"/c")
    chunk += b"".join(record(m, op=b"\2", conn=conn, time=struct.pack("<II", k, 0)) for k, m in enumerate(sent))
    path = str(tmp_path / "i.bag")
    (tmp_path / "i.bag").write_bytes(b"#ROSBAG V2.0\n" + record(chunk, op=b"\5", compression=b"none", size=conn))
    got = recordings.with_images(recordings.read_recording(spark, path), recording=found.recording_format(path)).orderBy("timestamp_ns").collect()
    assert [(r["image"]["height"], r["image"]["width"], bytes(r["image"]["data"])) for r in got] == [(1, 2, bytes([3, 2, 1, 6, 5, 4])), (1, 2, bytes([7, 7, 7, 8, 8, 8]))]
    with pytest.raises(ValueError):
        recordings.with_images(got, recording="mp4")


def bag_with_index(compressions, texts_of):
    """A bag with an index: one chunk for each compression, and in it the messages that texts_of gives."""
    import bz2

    import pyarrow as pa

    def header(**kv):
        h = b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k.encode() + b"=" + v for k, v in kv.items())
        return struct.pack("<I", len(h)) + h

    def record(data, **kv):
        return header(**kv) + struct.pack("<I", len(data)) + data

    conn = struct.pack("<I", 0)
    inner = header(topic=b"/c", type=b"Image")[4:]
    pack = {b"none": lambda d: d, b"bz2": bz2.compress, b"lz4": lambda d: pa.compress(d, codec="lz4", asbytes=True)}
    start = lambda at: record(b" " * 64, op=b"\3", index_pos=struct.pack("<Q", at), conn_count=struct.pack("<I", 1), chunk_count=struct.pack("<I", len(compressions)))
    body, places = b"", []
    front = len(b"#ROSBAG V2.0\n" + start(0))
    for k, kind in enumerate(compressions):
        chunk = record(inner, op=b"\7", conn=conn, topic=b"/c") if k == 0 else b""
        chunk += b"".join(record(m, op=b"\2", conn=conn, time=struct.pack("<II", 10 * k + i, 0)) for i, m in enumerate(texts_of(k)))
        places.append(front + len(body))
        body += record(pack[kind](chunk), op=b"\5", compression=kind, size=struct.pack("<I", len(chunk))) + record(b"", op=b"\4", conn=conn)
    index = record(inner, op=b"\7", conn=conn, topic=b"/c") + b"".join(record(b"", op=b"\6", chunk_pos=struct.pack("<Q", p)) for p in places)
    return b"#ROSBAG V2.0\n" + start(front + len(body)) + body + index


def test_bags_are_read_by_their_index_in_parts(spark, tmp_path):
    kinds = [b"none", b"bz2", b"lz4", b"none", b"lz4"]
    path = tmp_path / "r.bag"
    path.write_bytes(bag_with_index(kinds, lambda k: [f"m{k}.{i}".encode() for i in range(3)]))
    recordings.register(spark)
    got = spark.read.format("rosbag1").option("ranges", 3).load(str(path))
    assert got.rdd.getNumPartitions() == 3
    assert sorted((r["timestamp_ns"] // 10**9, bytes(r["data"]), r["topic"]) for r in got.collect()) == [(10 * k + i, f"m{k}.{i}".encode(), "/c") for k in range(5) for i in range(3)]


def test_formats_and_paths(tmp_path):
    assert found.recording_format("a/B.BAG") == "rosbag1"
    with pytest.raises(ValueError):
        found.recording_format("a.mp4")
    assert found.resolved("x/y", "/r") == "/r/x/y" and found.resolved("/x", "/r") == "/x" and found.resolved("s3://b", "/r") == "s3://b"


SQUARE = [10.0, 10.0, 60.0, 10.0, 60.0, 60.0, 10.0, 60.0]


def export(folder, setups, drop=(), first_id=1):
    """An export of setups, each with a component on its Color image; its categories in an order of its own."""
    names = ["screw", "nut", "gear", "platform", "ignore object"]
    images, anns = [], []
    for i, s in enumerate(setups):
        for kind in ("Color", "empty"):
            image = {"id": first_id + len(images), "width": 128, "height": 72, "file_name": f"{s}_{kind}.png"}
            images.append(image)
            anns.append({"id": len(anns) + 1, "image_id": image["id"], "category_id": 4, "segmentation": [[0, 0, 120, 0, 120, 70, 0, 70]], "area": 1.0, "bbox": [0, 0, 120, 70], "iscrowd": 0})
        anns.append({"id": len(anns) + 1, "image_id": images[-2]["id"], "category_id": 1 + i % 3, "segmentation": [[0, 0, 5, 0, 5, 5], SQUARE], "area": 2500.0, "bbox": [10, 10, 50, 50], "iscrowd": 0})
        if s in drop:
            anns.append({"id": len(anns) + 1, "image_id": images[-2]["id"], "category_id": 5, "segmentation": [], "area": 0, "bbox": [], "iscrowd": 0})
    (folder / "annotations").mkdir(parents=True)
    doc = {"images": images, "annotations": anns, "categories": [{"id": i, "name": n, "supercategory": ""} for i, n in enumerate(names, 1)], "info": {"year": "2024"}, "licenses": []}
    (folder / "annotations" / "instances.json").write_text(json.dumps(doc))
    return str(folder)


def test_static_dataset(spark, tmp_path):
    a, b = export(tmp_path / "a", range(1, 11)), export(tmp_path / "b", range(11, 15))
    docs = coco.documents(spark, [a, b])
    for method in ("exact", "hash"):
        data = runs.static_dataset(docs, (3, 1), (2,), 42, method)
        n = {r["split"]: (r["n"]) for r in data.images.groupBy("split").agg(F.countDistinct("key").alias("n")).collect()}
        assert n == {"val": 4, "test": 4, "train": 6}
        assert data.images.filter("positive").count() == 14 and data.images.count() == 28
        assert data.labels.count() == 14 and data.regions.count() == 28
    assert data.labels.first()["poly"][:2] == [0.0, 0.0]
    stems, groups = runs.index_of(runs.united([data]))
    assert stems.count() == 28 and groups.count() == 14
    images, anns, cats = runs.merged_coco(docs)
    assert sorted(r["new_id"] for r in images.collect()) == list(range(1, 29))
    assert anns.agg(F.max("new_id"), F.max("new_image_id")).first() == (42, 28) and cats.count() == 5


def test_checks_of_exports(spark, tmp_path):
    same = coco.documents(spark, [export(tmp_path / "a", [1, 2]), export(tmp_path / "b", [2, 3])])
    with pytest.raises(ValueError, match="several exports"):
        runs.check_exports(same)
    (tmp_path / "c").mkdir()
    with pytest.raises(Exception):
        coco.documents(spark, [str(tmp_path / "c")]).collect()


def test_evaluation_set(spark, tmp_path):
    path = export(tmp_path / "a", [1, 2, 3, 4], drop=[2])
    (tmp_path / "a" / "aaa.json").write_text("{broken")
    docs = coco.first_complete(spark, path)
    clean = runs.filter_and_canonicalize(docs)
    assert sorted((r["file_name"], r["new_image_id"]) for r in clean.images.collect()) == [("1_Color.png", 1), ("3_Color.png", 2), ("4_Color.png", 3)]
    assert sorted(r["new_category_id"] for r in clean.annotations.collect()) == [1, 1, 3]
    rows = {r["stem"]: r for r in runs.evaluation_labels(clean).collect()}
    assert rows["3_Color"]["class_id"] == 2
    assert rows["1_Color"]["poly"] == pytest.approx([v / (128, 72)[i % 2] for i, v in enumerate(SQUARE)], abs=1e-6)
    assert clean.missing.count() == 0


def test_segmentations(spark):
    rows = [("[[1, 2, 3, 4, 5, 6]]",), ('{"size": [2, 2], "counts": [0, 4]}',), ('[{"size": [2, 2], "counts": "04"}]',), ("[]",), (None,)]
    got = spark.createDataFrame(rows, "s string").select(coco.polygons_of(F.col("s")).alias("p"), coco.rles_of(F.col("s")).alias("r")).collect()
    assert got[0]["p"] == [[1, 2, 3, 4, 5, 6]] and got[0]["r"] is None
    assert got[1]["p"] is None and got[1]["r"][0]["counts_list"] == [0, 4]
    assert got[2]["r"][0]["counts_str"] == "04" and got[2]["r"][0]["counts_list"] is None
    assert got[3]["p"] == [] and got[4]["p"] is None and got[4]["r"] is None
    big = spark.createDataFrame([('{"size": [20, 20], "counts": [84, 12, 8, 12, 8, 12, 264]}',)], "s string")
    poly = big.select(augment.rle_polygon(coco.rles_of(F.col("s"))).alias("p")).first()["p"]
    assert sorted(zip(poly[0::2], poly[1::2], strict=True)) == [(4, 4), (4, 15), (6, 4), (6, 15)]


def test_label_files(spark, tmp_path):
    images = spark.createDataFrame([("a", "train"), ("b", "val")], "stem string, split string")
    rows = spark.createDataFrame([("a", 2, 1, [0.1234565, 0.5, 0.5, 0.5, 0.25, 1.0]), ("a", 1, 0, [0.0] * 6)], "stem string, no int, class_id int, poly array<double>")
    texts = text.label_texts(images, rows, "stem", "no", "class_id", "poly")
    assert {r["path"]: r["written"] for r in text.write_labels(texts, str(tmp_path), "split", "stem").collect()} == {"labels/train/a.txt": True, "labels/val/b.txt": True}
    assert (tmp_path / "labels/train/a.txt").read_text() == "0" + " 0.000000" * 6 + "\n1 0.123456 0.500000 0.500000 0.500000 0.250000 1.000000\n"
    assert (tmp_path / "labels/val/b.txt").read_text() == ""
    back = labels.read_labels(spark, str(tmp_path / "labels"))
    assert sorted((r["stem"], r["line_no"], r["class_id"]) for r in back.collect()) == [("a", 0, 0), ("a", 1, 1)]


def test_documents_and_descriptions(spark, tmp_path):
    assert labels.parse_dataset_yaml(text.dataset_yaml(["screw", "nut"], "/d")) == {"path": "/d", "train": "images/train", "val": "images/val", "test": "images/test", "names": {0: "screw", 1: "nut"}}
    assert labels.parse_dataset_yaml("names: [a, 'b']  # two\nval: x\n")["names"] == {0: "a", 1: "b"}
    assert labels.parse_dataset_yaml("names: {0: a, 3: b}")["names"] == {0: "a", 3: "b"}
    assert labels.parse_dataset_yaml("names:\n- a\n- b\ntrain: t\n") == {"names": {0: "a", 1: "b"}, "train": "t"}
    stems = spark.createDataFrame([("s2", "g"), ("s1", "g")], "stem string, source string")
    groups = spark.createDataFrame([("g", ["s1", "s2"])], "source string, stems array<string>")
    path = str(tmp_path / "index")
    text.source_index_json(stems, groups).write.text(path)
    a, b = labels.read_source_index(spark, path)
    assert sorted(tuple(r) for r in a.collect()) == [("s1", "g"), ("s2", "g")] and [tuple(r) for r in b.collect()] == [("g", ["s1", "s2"])]
    t = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    doc = json.loads(text.coco_json(t([(2, "b"), (1, "a")], "id long, file_name string"), t([(1, 2)], "id long, image_id long"), t([(1, "x")], "id long, name string")).first()["value"])
    assert [i["id"] for i in doc["images"]] == [1, 2] and doc["categories"][0]["name"] == "x"
    log = text.augmentation_log(t([("b", 1), ("a", 2)], "augmented_image string, n_pasted int"), t([(3,)], "n_pastes int"), {"seed": 0}, {"out": "/o"})
    assert json.loads(log.first()["value"])["summary"] == {"n_pastes": 3}
    done = text.write_manifests(t([("train", "b"), ("train", "a")], "split string, name string"), str(tmp_path), "split", "name").collect()
    assert done[0]["path"] == "splits/train.txt" and (tmp_path / "splits/train.txt").read_text() == "a\nb\n"
    assert sorted(r["file_name"] for r in labels.read_manifest(spark, str(tmp_path / "splits/train.txt")).collect()) == ["a", "b"]


def test_save_modes_and_copies(spark, tmp_path):
    root = str(tmp_path / "o")
    out.prepare(root, "error")
    assert out.write_bytes(f"{root}/x/a", b"1", "error") and not out.write_bytes(f"{root}/x/a", b"2", "ignore")
    with pytest.raises(FileExistsError):
        out.write_bytes(f"{root}/x/a", b"2", "error")
    with pytest.raises(FileExistsError):
        out.prepare(root, "error")
    rows = spark.createDataFrame([(f"{root}/x/a", "c/1"), (f"{root}/no", "c/2"), (None, "c/3")], "s string, p string")
    assert sorted(r["written"] for r in out.copy_files(rows, root, F.col("s"), F.col("p")).collect()) == [False, False, True]
    out.prepare(root, "overwrite")
    assert not out.exists(f"{root}/x/a")
    (tmp_path / "v").mkdir()
    for name in ("b.MP4", "a.bag", "c.txt"):
        (tmp_path / "v" / name).write_bytes(b"x")
    listed = found.videos(found.listing(spark, str(tmp_path / "v"))).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in listed] == ["a.bag", "b.MP4"]


def test_augmented_table(spark):
    rng = np.random.default_rng(0)
    patch = png.encode(rng.integers(0, 256, (30, 30, 3), dtype=np.uint8))
    mask = png.encode(augment.S.fill_parity([[3, 3, 26, 3, 26, 26, 3, 26]], 30, 30) * np.uint8(255))
    bank = augment.bank_of(spark.createDataFrame([("screw_a", "p.png", patch, mask)], "component string, rgb_path string, rgb binary, mask binary"), {"screw_a": 0}, {0: 300})
    with pytest.raises(ValueError):
        augment.bank_of(spark.createDataFrame([("c", "p", patch, mask)], "component string, rgb_path string, rgb binary, mask binary"), {}, {}, 10)
    image = png.encode(np.full((150, 150, 3), 90, np.uint8))
    pool = json.dumps([[120.0, 128.0, 128.0], [10.0, 2.0, 2.0], 3.0])
    schema = "stem string, png binary, labels array<struct<class_id: int, poly: array<double>>>, region binary, pool string"
    rows = spark.createDataFrame([("a", image, [], None, pool), ("b", image, [(1, [0.1, 0.1, 0.3, 0.1, 0.3, 0.3])], None, None), ("c", b"bad", [], None, None)], schema)
    got = augment.augment_table(rows, bank, 2).collect()
    assert sorted((r["stem"], r["aug"]) for r in got) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    assert all(r["n_pasted"] == len(r["pastes"]) >= 1 and png.decode(bytes(r["png"])).shape == (150, 150, 3) for r in got)
    again = {(r["stem"], r["aug"]): bytes(r["png"]) for r in augment.augment_table(rows.repartition(3), bank, 2).collect()}
    assert all(again[r["stem"], r["aug"]] == bytes(r["png"]) for r in got)
    parts = rows.select("stem", augment.component_partials(F.col("png"), F.transform("labels", lambda x: x["poly"])).alias("p")).collect()
    assert {r["stem"]: r["p"] is None for r in parts} == {"a": True, "b": False, "c": True}


def test_frames_and_mask_bank(spark):
    frames = spark.createDataFrame([("r", i, i * 500_000_000) for i in range(21)], "rec string, id long, ts long")
    got = runs.extract_frames(frames, "rec", "ts", "id", 2.0, 1.0, 2.0).orderBy("id").collect()
    assert [(r["id"], r["file_name"]) for r in got] == [(2, "r_0000_t1.00s.png"), (6, "r_0001_t3.00s.png"), (10, "r_0002_t5.00s.png"), (14, "r_0003_t7.00s.png")]
    with pytest.raises(ValueError):
        runs.extract_frames(frames, "rec", "ts", "id", 2.0, 5.0, 5.0)
    clips = spark.createDataFrame([("screw_a_01.mov", 1280, 720), ("screw_a_02.mov", 1280, 720), ("nut_b_01.mov", 640, 480)], "video string, width int, height int")
    masks = spark.createDataFrame([("screw_a_01.mov", i, i * 1000, 921600) for i in range(4)] + [("screw_a_02.mov", 0, 5000, 921600)], "video string, frame_no int, inside int, whole int")
    reviews = spark.createDataFrame([("screw_a_01.mov", "accept", 1), ("screw_a_02.mov", "skip", 2), ("nut_b_01.mov", "accept", 1)], "video string, verdict string, attempts int")
    done = spark.createDataFrame([("x",)], "video string")
    rows, summary = runs.mask_bank(clips, masks, reviews, done)
    assert sorted(r["frame_no"] for r in rows.collect()) == [1, 2, 3] and rows.first()["component"] == "screw_a"
    assert [tuple(r) for r in summary.collect()] == [("screw_a", 1, 3)]


def test_stream_equals_batch_over_several_files(spark, tmp_path):
    from tessera.operators import sampling
    from tessera.streaming import sampler

    rows = [(r, t * 7 % 101 + 200 * (t // 40), t) for r in range(3) for t in range(120)]
    df = spark.createDataFrame(rows, "r long, t long, id long")
    for k in range(3):
        df.filter(f"t >= {200 * k} and t < {200 * (k + 1)}").coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    kept = sampler.sample(stream, "r", "t", "id", 25, 10, 30)
    run = kept.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    run.awaitTermination()
    got = spark.read.schema(kept.schema).parquet(str(tmp_path / "out"))
    trimmed = sampling.with_offset(df, "r", "t", "o").withColumn("first", F.col("t") - F.col("o")).drop("o")
    want = sampling.stride_sample(sampling.trim(trimmed, "r", "t", 10, 30), "r", "t", "id", 25, F.col("first") + 10)
    assert sorted((x["r"], x["t"], x["sample_no"]) for x in got.collect()) == sorted((x["r"], x["t"], x["sample_no"]) for x in want.collect())


def test_late_frames_are_sorted_in_marked_or_an_error(spark):
    from tessera.streaming import sampler

    def run(tmp, **how):
        stream = spark.readStream.schema("r long, t long, id long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp / "in"))
        kept = sampler.sample(stream, "r", "t", "id", 10, **how)
        kept.writeStream.format("parquet").option("path", str(tmp / "out")).option("checkpointLocation", str(tmp / "log")).trigger(availableNow=True).start().awaitTermination()
        return sorted(((x["t"], x["sample_no"]) for x in spark.read.schema(kept.schema).parquet(str(tmp / "out")).collect()), key=str)

    import tempfile
    import time
    from pathlib import Path

    def files(*batches):
        tmp = Path(tempfile.mkdtemp())
        for k, times in enumerate(batches):
            spark.createDataFrame([(1, t, t) for t in times], "r long, t long, id long").coalesce(1).write.parquet(str(tmp / "in" / str(k)))
            time.sleep(0.02)
        return tmp

    batches = [[0, 10, 30], [20, 40], [50, 60, 100]]
    assert run(files(*batches), delay=15) == sorted(((10 * k, k) for k in range(7)), key=str)
    marked = run(files(*batches), late="mark")
    assert [t for t, n in marked if n is None] == [] or all(t == 20 for t, n in marked if n is None)
    late = run(files([0, 10, 30, 50], [20, 60], [100]), late="mark")
    assert [t for t, n in late if n is None] == [20]
    with pytest.raises(Exception, match="came late"):
        run(files([0, 10, 30, 50], [20, 60], [100]))
    with pytest.raises(ValueError):
        run(files([0]), late="drop")


def test_setups_without_their_twin(spark, tmp_path):
    docs = coco.documents(spark, [export(tmp_path / "a", range(1, 4))])
    assert runs.unpaired(docs).count() == 0
    path = tmp_path / "a/annotations/instances.json"
    doc = json.loads(path.read_text())
    doc["images"] = [i for i in doc["images"] if i["file_name"] != "2_empty.png"]
    path.write_text(json.dumps(doc))
    assert [tuple(r) for r in runs.unpaired(coco.documents(spark, [str(tmp_path / "a")])).collect()] == [(0, "2")]
    two = coco.documents(spark, [export(tmp_path / k, range(1, 3)) for k in "bc"])
    with pytest.raises(ValueError, match="one export"):
        runs.filter_and_canonicalize(two)


def test_tables_in_buckets_are_grouped_without_a_shuffle(spark):
    from tessera import tables

    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("k"), "id")
    kept = tables.stored_by(df, "buckets", "k")
    tables.released(spark)
    assert sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in df.collect())
    counted = kept.groupBy("k").agg(F.count("*").alias("n"))
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert {r["n"] for r in counted.collect()} == {14, 15}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tessera_")]
    assert tables.small(df, 100) and not tables.small(df, 99)

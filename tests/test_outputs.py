import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import stats
from tessera.plans import outputs, runs
from tessera.raster import augment
from tessera.sources import coco, png, video
from tessera.sources import images as found
from test_files import export


def box(kind, body):
    return struct.pack(">I4s", len(body) + 8, kind) + body


def movie(width, height, version=0):
    clock = bytes(32 if version else 20)
    tkhd = bytes([version, 0, 0, 7]) + clock + bytes(8 + 8 + 36) + struct.pack(">II", width << 16, height << 16)
    sound = bytes(4 + 20 + 8 + 8 + 36 + 8)
    return box(b"ftyp", b"qt  ") + box(b"mdat", b"x" * 50) + box(b"moov", box(b"mvhd", bytes(100)) + box(b"trak", box(b"tkhd", sound)) + box(b"trak", box(b"tkhd", tkhd)))


def test_clip_sizes(spark):
    rows = [(1, movie(1280, 720)), (2, movie(640, 480, 1)), (3, b"no"), (4, None), (5, movie(1920, 1080, 1)), (6, png.encode(np.zeros((720, 1280), np.uint8)))]
    assert [video.size_of(d) for _, d in rows] == [(1280, 720), (640, 480), None, None, (1920, 1080), (1280, 720)]
    assert sorted(r["id"] for r in video.with_size(spark.createDataFrame(rows, "id int, content binary"), F.col("content")).collect()) == [1, 5, 6]


def test_a_dataset_is_written(spark, tmp_path):
    data = runs.static_dataset(coco.documents(spark, [export(tmp_path / "a", range(1, 9))]), method="exact")
    (tmp_path / "a" / "images").mkdir()
    for s in range(1, 9):
        (tmp_path / "a" / "images" / f"{s}_Color.png").write_bytes(png.encode(np.zeros((72, 128, 3), np.uint8)))
    listed = spark.createDataFrame([(f"images/{s}_Color.png",) for s in range(1, 9)], "path string")
    found = outputs.sources_of(data.images, listed).withColumn("path", F.concat(F.lit(f"{tmp_path}/a/"), "path"))
    root = str(tmp_path / "out")
    n = {r["kind"]: (r["n_written"], r["n_missing"]) for r in outputs.write_dataset(data, root, found).collect()}
    assert n == {"labels": (16, 0), "regions": (16, 0), "images": (8, 8)}
    assert len(list((tmp_path / "out/labels/val").iterdir())) == 6 and len(list((tmp_path / "out/images/train").iterdir())) == 2
    mask = png.decode((tmp_path / "out/paste_regions/1_Color.png").read_bytes())
    assert mask.shape == (72, 128) and (mask > 0).sum() == 121 * 71
    with pytest.raises(FileExistsError):
        outputs.write_dataset(data, root, mode="error")


def test_an_augmented_dataset_is_written(spark, tmp_path):
    rng = np.random.default_rng(0)
    patch = rng.integers(0, 256, (30, 30, 3), dtype=np.uint8)
    mask = augment.S.fill_parity([[3, 3, 26, 3, 26, 26, 3, 26]], 30, 30)
    bank = augment.Bank({"screw_a": [("a.png", patch, mask)]}, {"screw_a": 0}, {0: 300})
    picture = png.encode(rng.integers(80, 120, (150, 150, 3), dtype=np.uint8))
    schema = "stem string, png binary, labels array<struct<class_id: int, poly: array<double>>>"
    images = spark.createDataFrame([("a", picture, [(0, [0.1, 0.1, 0.4, 0.1, 0.4, 0.4, 0.1, 0.4])]), ("b", picture, [])], schema)
    index = spark.createDataFrame([("a", "g"), ("b", "g"), ("gone", "g")], "stem string, source string")
    pool = outputs.pools(images, index).first()
    assert pool["n_stems"] == 3 and pool["n_pixels"] == 46 * 46 and 2 < pool["lap_noise"]
    made = outputs.augmented(images, bank, 2, index=index)
    root = str(tmp_path / "aug")
    (tmp_path / "v.png").write_bytes(picture)
    sizes = spark.createDataFrame([(0, 3, 300, 200, 400)], "class_id int, n_samples long, median_area int, p05_area int, p95_area int")
    copies = spark.createDataFrame([(str(tmp_path / "v.png"), "images/val/v.png")], "source string, path string")
    got = outputs.write_augmented(made, images, root, augment.Settings(), 2, sizes=sizes, copies=copies).first().asDict()
    assert got == {"train_images_total": 2, "train_images_with_labels": 1, "train_images_hard_negatives": 1, "augmentation_attempts": 4, "augmented_images_written": 4, "final_train_image_count": 6}
    out = tmp_path / "aug"
    log = json.loads((out / "augmentation_log.json").read_text())
    assert set(log) == {"created_at", "_paths_note", "_absolute_at_write_time", "args", "target_areas_per_class", "augmented_images", "summary"}
    assert log["summary"] == got and log["args"]["augs_per_image"] == 2 and log["args"]["blend"] == "alpha" and log["_absolute_at_write_time"]["out_dataset"] == root
    assert log["target_areas_per_class"] == {"0": {"n_samples": 3, "median_area_px": 300, "p05_area_px": 200, "p95_area_px": 400}}
    assert {e["augmented_image"] for e in log["augmented_images"]} == {f"images/train/{s}_aug{k}.png" for s in "ab" for k in (0, 1)}
    for entry in log["augmented_images"]:
        lines = (out / entry["augmented_label"]).read_text().splitlines()
        assert len(lines) == entry["n_pasted"] + (entry["source_image"] == "images/train/a.png")
        assert png.decode((out / entry["augmented_image"]).read_bytes()).shape == (150, 150, 3)
    # Originals are there, unchanged, a negative with an empty label; so are the files copied along.
    assert (out / "images/train/a.png").read_bytes() == picture and (out / "images/val/v.png").read_bytes() == picture
    assert len((out / "labels/train/a.txt").read_text().splitlines()) == 1 and (out / "labels/train/b.txt").read_text() == ""
    assert "train: images/train" in (out / "dataset.yaml").read_text()
    assert len(list((out / "images/train").iterdir())) == len(list((out / "labels/train").iterdir())) == 6
    assert outputs.augmented(images, bank, 1, negatives=False).select("stem").distinct().count() == 1


def test_a_hundred_variants_are_a_hundred_files(spark, tmp_path):
    schema = "stem string, aug int, png binary, labels array<struct<class_id: int, poly: array<double>>>, n_pasted int, pastes array<struct<component_id: string>>"
    made = spark.createDataFrame([("a", k, b"x", [], 1, []) for k in range(101)], schema)
    outputs.write_augmented(made, made.limit(0).select("stem", "png", "labels"), str(tmp_path / "o"), augment.Settings(), 101)
    assert len(list((tmp_path / "o/images/train").iterdir())) == 101


def test_a_bank_by_paths_gives_the_same_variants(spark, tmp_path):
    rng = np.random.default_rng(0)
    rgb, mask = rng.integers(0, 256, (40, 40, 3), dtype=np.uint8), augment.S.fill_parity([[5, 5, 30, 5, 30, 30, 5, 30]], 40, 40) * np.uint8(255)
    (tmp_path / "f.png").write_bytes(png.encode(rgb))
    (tmp_path / "f_mask.png").write_bytes(png.encode(mask))
    paths = spark.createDataFrame([("screw_a", f"{tmp_path}/f.png", f"{tmp_path}/f_mask.png")], "component string, rgb_path string, mask_path string")
    whole = spark.createDataFrame([("screw_a", "f.png", png.encode(rgb), png.encode(mask))], "component string, rgb_path string, rgb binary, mask binary")
    image = np.full((150, 150, 3), 90, np.uint8)
    made = [augment.augment(image, [], b, augment.generator(0, "x", 0)) for b in (augment.bank_of_paths(paths, {"screw_a": 0}, {0: 300}), augment.bank_of(whole, {"screw_a": 0}, {0: 300}))]
    assert (made[0][0] == made[1][0]).all() and made[0][2] == made[1][2]
    with pytest.raises(ValueError):
        augment.bank_of(whole, {}, {}, max_bytes=40 * 40 * 4 - 1)
    gone = augment.bank_of_paths(paths.withColumn("rgb_path", F.lit(f"{tmp_path}/no.png")), {"screw_a": 0}, {0: 300})
    assert augment.augment(image, [], gone, augment.generator(0, "x", 0)) is None


def test_images_that_cannot_be_decoded_are_no_silent_loss(spark, tmp_path):
    (tmp_path / "in").mkdir()
    jvm = spark.sparkContext._jvm
    assert jvm.javax.imageio.ImageIO.write(jvm.java.awt.image.BufferedImage(1, 1, 10), "jpg", jvm.java.io.File(f"{tmp_path}/in/a.jpg"))
    (tmp_path / "in/b.png").write_bytes(png.encode(np.full((2, 3, 3), [10, 20, 30], np.uint8)))
    rows = {r["stem"]: r for r in found.read_images(spark, str(tmp_path / "in")).collect()}
    assert png.decode(bytes(rows["b"]["png"])).tolist() == [[[10, 20, 30]] * 3] * 2 and (rows["a"]["width"], rows["a"]["height"]) == (1, 1)
    (tmp_path / "in/c.png").write_bytes(b"no image")
    assert found.read_images(spark, str(tmp_path / "in"), "drop").count() == 2 and found.unreadable_images(spark, str(tmp_path / "in")).count() == 1
    with pytest.raises(Exception, match="can't be decoded"):
        found.read_images(spark, str(tmp_path / "in")).collect()
    bad = spark.createDataFrame([("a", b"no", [], None, None)], "stem string, png binary, labels array<struct<class_id: int, poly: array<double>>>, region binary, pool string")
    with pytest.raises(Exception, match="no PNG"):
        augment.augment_table(bad, augment.Bank({}, {}, {}), 1, unreadable="fail").collect()
    assert [r["stem"] for r in augment.undecodable(bad).collect()] == ["a"]


def test_frames_and_a_mask_bank_are_written(spark, tmp_path):
    from tessera.operators import layout

    pixels = np.random.default_rng(0).integers(0, 256, (4, 6, 3), dtype=np.uint8)
    frames = spark.createDataFrame([("r_0000_t1.00s.png", (4, 6, pixels.tobytes()))], "file_name string, image struct<height: int, width: int, data: binary>")
    assert [tuple(r) for r in outputs.write_frames(frames, str(tmp_path / "frames")).collect()] == [("r_0000_t1.00s.png", True)]
    assert (png.decode((tmp_path / "frames/r_0000_t1.00s.png").read_bytes()) == pixels).all()
    root, mask = tmp_path / "bank", png.encode(np.ones((4, 6), np.uint8) * np.uint8(255))
    rows = spark.createDataFrame([("screw_a/01", k, png.encode(pixels), mask) for k in (0, 7, 1_234_567)], "output_dir string, frame_no int, image binary, mask binary")
    clip = ("screw_a_01.mov", "screw_a", "01", "screw_a/01", [1280, 720], 40, [5, 6], 1)
    schema = "video_filename string, component_id string, reseat_idx string, output_dir string, video_resolution_wh array<int>, n_frames_extracted int, first_frame_click array<int>, attempts_to_accept int"
    done = outputs.write_mask_bank(rows, spark.createDataFrame([clip, ("nut_b_01.mov", "nut_b", "01", "nut_b/01", [1280, 720], 40, [1, 1], 2)], schema), str(root), args={"stride": 8})
    assert done.filter("written").count() == 7
    manifest = json.loads((root / "manifest.json").read_text())
    assert [v["n_masks_saved"] for v in manifest["videos"]] == [3] and list(manifest["videos"][0]) == list(outputs.labels.MANIFEST) and manifest["args"] == {"stride": 8}
    listed = spark.createDataFrame([(str(p.relative_to(root)),) for p in root.rglob("*.png")], "path string")
    pairs = layout.mask_pairs(listed, "path").collect()
    assert sorted(r["frame"] for r in pairs) == ["frame_000000", "frame_000007", "frame_1234567"] and {(r["component"], r["clip"]) for r in pairs} == {("screw_a", "01")}


def test_calibration_counts_pixels(spark):
    square = [0.0, 0.0, 0.1, 0.0, 0.1, 0.1, 0.0, 0.1]
    train = spark.createDataFrame([(0, square, 100, 100), (0, square, 200, 200)], "class_id int, poly array<double>, width int, height int")
    got = outputs.calibration(train).first()
    assert (got["n_samples"], got["median_area"]) == (2, (121 + 441) // 2)


def test_lab_pools_by_parts_equal_the_whole(spark):
    rng = np.random.default_rng(1)
    px = rng.normal(100, 9, (3, 500, 3))
    rows = [("g", (500, p.sum(0).tolist(), (p.var(0) * 500).tolist(), float(k))) for k, p in enumerate(px)] + [("g", None)]
    df = spark.createDataFrame(rows, "source string, p struct<n: long, s: array<double>, inner: array<double>, noise: double>")
    got = stats.lab_pool(df, "source").first()
    whole = px.reshape(-1, 3)
    assert got["lab_mean"] == pytest.approx(whole.mean(0).tolist()) and got["lab_std"] == pytest.approx((whole.std(0) + 1e-6).tolist())
    assert (got["lap_noise"], got["n_pixels"], got["n_stems"]) == (1.0, 1500, 4)

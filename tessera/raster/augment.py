"""Copy-paste augmentation of one image, and of a table of images."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.raster import pixels as P
from tessera.raster import shapes as S
from tessera.sinks.files import open_fs
from tessera.sources import png

#: Most overlap of a paste with what is there, tries for a place, least pixels of a scene's components and of a paste.
MAX_IOU, TRIES, SCENE_PIXELS, PASTE_PIXELS = 0.05, 30, 50, 50


@dataclass(frozen=True)
class Settings:
    seed: int = 0
    least: int = 2
    most: int = 5
    jitter: float = 0.2
    feather: int = 1
    flip: float = 0.5
    degrees: float = 180.0
    perspective: float = 0.05
    match_colour: bool = True
    match_noise: bool = True
    blend: str = "alpha"


@dataclass(frozen=True)
class Bank:
    """Patches by component as (name, BGR pixels, mask), or the paths of both files; classes of components and median areas of classes."""

    patches: dict[str, list[tuple[str, np.ndarray | str, np.ndarray | str]]]
    class_of: dict[str, int]
    median_area: dict[int, int]

    def patch(self, component: str, at: int) -> tuple[str, np.ndarray, np.ndarray] | None:
        """A patch; null if its files can't be read."""
        name, rgb, mask = self.patches[component][at]
        if not isinstance(rgb, str):
            return name, rgb, mask
        cut = _from_files(rgb, mask)
        return (name, *cut) if cut else None


@dataclass(frozen=True)
class Pool:
    """Lab statistics and noise of the components in a group of images."""

    mean: np.ndarray
    std: np.ndarray
    noise: float


@dataclass
class Scene:
    """An image under work; targets are its own labels, occupied grows with each paste."""

    image: np.ndarray
    labels: list[tuple[int, np.ndarray]]
    targets: np.ndarray | None
    occupied: list[tuple[int, int, int, int]] = field(default_factory=list)


def generator(seed: int, stem: str, aug: int) -> np.random.Generator:
    """Draws that depend on seed, image and variant alone, not on who makes them or when."""
    return np.random.default_rng(int(md5(f"{seed}:{stem}:{aug}".encode()).hexdigest()[:16], 16))


def extract(rgb: np.ndarray | None, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Patch and mask (0 and 1) cut to the mask's box; null if either can't be read or the mask is empty."""
    if rgb is None or mask is None:
        return None
    if rgb.ndim == 2:
        rgb = np.repeat(rgb[:, :, None], 3, axis=2)
    if mask.ndim == 3:
        mask = P.gray(mask).astype(np.uint8)
    if mask.shape != rgb.shape[:2]:
        mask = P.nearest(mask, rgb.shape[1], rgb.shape[0])
    return cropped(rgb, (mask > 127).astype(np.uint8))


def cropped(rgb: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    box = S.tight_box(mask)
    if box is None:
        return None
    x0, y0, x1, y1 = box
    return rgb[y0:y1, x0:x1], mask[y0:y1, x0:x1]


@lru_cache(maxsize=64)
def _from_files(rgb: str, mask: str) -> tuple[np.ndarray, np.ndarray] | None:
    """A patch from its two files; a worker remembers the last ones."""

    def read(uri: str) -> np.ndarray | None:
        fs, at = open_fs(uri)
        try:
            with fs.open_input_stream(at) as f:
                return png.decode(f.read())
        except OSError:
            return None

    return extract(read(rgb), read(mask))


def box_iou(a: tuple, b: tuple) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return w * h / union if union > 0 else 0.0


def find_place(mask: np.ndarray, shape: tuple[int, int], occupied: list, region: np.ndarray | None, rng: np.random.Generator) -> tuple[int, int] | None:
    """A place for a mask: over no occupied box by more than MAX_IOU, and wholly inside the region; null after TRIES."""
    h, w = mask.shape
    for _ in range(TRIES):
        x, y = int(rng.integers(0, shape[1] - w + 1)), int(rng.integers(0, shape[0] - h + 1))
        if all(box_iou((x, y, x + w, y + h), b) <= MAX_IOU for b in occupied) and (region is None or bool((region[y : y + h, x : x + w][mask > 0] > 0).all())):
            return x, y
    return None


def _variant(patch: np.ndarray, mask: np.ndarray, target: int, s: Settings, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Flip, turn, warp, crop and scale, in this order."""
    if rng.random() < s.flip:
        patch, mask = patch[:, ::-1], mask[:, ::-1]
    if s.degrees > 0:
        patch, mask = P.rotate(patch, mask, float(rng.uniform(-s.degrees, s.degrees)))
    if s.perspective > 0:
        patch, mask = P.warp(patch, mask, rng, s.perspective)
    cut = cropped(patch, mask)
    return P.scale_to(*cut, target) if cut else None


def _matched(patch: np.ndarray, mask: np.ndarray, scene: Scene, pool: Pool | None, s: Settings, rng: np.random.Generator) -> np.ndarray:
    """Colour and noise of the scene's own components, as the image is now; of the pool only where it has no labels."""
    if scene.targets is not None:
        if int(scene.targets.sum()) < SCENE_PIXELS:
            return patch
        if s.match_colour:
            patch = P.colour_matched(patch, mask, *P.lab_stats(scene.image, scene.targets))
        return P.noise_matched(patch, mask, P.noise_of(scene.image, scene.targets), rng) if s.match_noise else patch
    if pool is None:
        return patch
    if s.match_colour:
        patch = P.colour_matched(patch, mask, pool.mean, pool.std)
    return P.noise_matched(patch, mask, pool.noise, rng) if s.match_noise else patch


def augment(image: np.ndarray, labels: list[tuple[int, list[float]]], bank: Bank, rng: np.random.Generator, settings: Settings = Settings(), region: np.ndarray | None = None, pool: Pool | None = None) -> tuple[np.ndarray, list[tuple[int, list[float]]], list[dict]] | None:
    """A variant of the image with its labels (normalised) and its pastes; null if nothing was pasted.

    A paste whose border is too small changes the image but adds no label, and isn't counted.
    """
    if image.ndim == 2:
        image = np.repeat(image[:, :, None], 3, axis=2)
    height, width = image.shape[:2]
    polys = [np.trunc(np.array(p, float).reshape(-1, 2) * [width, height]) for _, p in labels]
    scene = Scene(image.copy(), [(c, np.array(p, float)) for c, p in labels], S.fill_union(polys, width, height) if polys else None)
    scene.occupied += [(int(p[:, 0].min()), int(p[:, 1].min()), int(p[:, 0].max()) + 1, int(p[:, 1].max()) + 1) for p in polys]
    wanted = int(rng.integers(settings.least, settings.most + 1))
    names = sorted(bank.patches)
    rng.shuffle(names)
    log: list[dict] = []
    for attempt in range(2 * wanted if names else 0):
        if len(log) >= wanted:
            break
        name = names[attempt % len(names)]
        class_id = bank.class_of.get(name)
        median = bank.median_area.get(class_id) if class_id is not None else None
        if not median or not bank.patches[name]:
            continue
        cut = bank.patch(name, int(rng.integers(len(bank.patches[name]))))
        if cut is None:
            continue
        source, patch, mask = cut
        target = max(PASTE_PIXELS, int(median * (1 + rng.uniform(-settings.jitter, settings.jitter))))
        made = _variant(patch, mask, target, settings, rng)
        if made is None or made[1].shape[0] >= height or made[1].shape[1] >= width:
            continue
        patch, mask = made
        place = find_place(mask, (height, width), scene.occupied, region, rng)
        if place is None:
            continue
        x, y = place
        patch = _matched(patch, mask, scene, pool, settings, rng)
        blend = P.poisson if settings.blend == "poisson" else lambda *a: P.pasted(*a, settings.feather)
        scene.image = blend(scene.image, patch, mask, x, y)
        border = S.largest_contour(mask)
        if border is None:
            continue
        border = border + [x, y]
        scene.labels.append((class_id, (border / [width, height]).ravel()))
        scene.occupied.append((int(border[:, 0].min()), int(border[:, 1].min()), int(border[:, 0].max()) + 1, int(border[:, 1].max()) + 1))
        log.append({"component_id": name, "class_id": class_id, "source_rgb": source, "paste_xy": [x, y], "paste_wh": [mask.shape[1], mask.shape[0]], "target_area_px": target})
    if not log:
        return None
    return scene.image, [(c, [float(v) for v in np.ravel(p)]) for c, p in scene.labels], log


PASTES = "array<struct<component_id: string, class_id: int, source_rgb: string, paste_xy: array<int>, paste_wh: array<int>, target_area_px: int>>"
AUGMENTED = f"stem string, aug int, png binary, labels array<struct<class_id: int, poly: array<double>>>, n_pasted int, pastes {PASTES}"


def augment_table(images: DataFrame, bank: Bank, variants: int, settings: Settings = Settings(), unreadable: str = "skip") -> DataFrame:
    """Variants of each row of (stem, png, labels, region, pool): an image is decoded once for all of its variants.

    labels is an array of (class_id, poly); region a PNG or null; pool JSON of mean, std and noise, or null. The bank goes to
    every worker, so its builder bounds it. Rows are taken from Arrow batches one by one, so pixels in memory are those of an image.
    Images that can't be decoded have no variants, or with unreadable="fail" are an error; undecodable() lists them, and
    sources.images reads other formats than PNG.
    """
    if unreadable not in ("skip", "fail"):
        raise ValueError("unreadable must be skip or fail")
    context = images.sparkSession.sparkContext
    shared = context.broadcast(bank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                (row,) = b.slice(i, 1).to_pylist()
                image = png.decode(row["png"])
                if image is None:
                    if unreadable == "fail":
                        raise ValueError(f"the image of {row['stem']} is no PNG that can be decoded")
                    continue
                region = png.decode(row["region"])
                pool = Pool(*(np.array(v) for v in json.loads(row["pool"]))) if row["pool"] else None
                labels = [(x["class_id"], x["poly"]) for x in row["labels"] or []]
                for k in range(variants):
                    made = augment(image, labels, shared.value, generator(settings.seed, row["stem"], k), settings, region, pool)
                    if made:
                        picture, polys, log = made
                        out = {"stem": row["stem"], "aug": k, "png": png.encode(picture), "labels": [{"class_id": c, "poly": p} for c, p in polys], "n_pasted": len(log), "pastes": log}
                        yield pa.RecordBatch.from_pylist([out], schema=_SCHEMA)

    paste = pa.struct([("component_id", pa.string()), ("class_id", pa.int32()), ("source_rgb", pa.string()), ("paste_xy", pa.list_(pa.int32())), ("paste_wh", pa.list_(pa.int32())), ("target_area_px", pa.int32())])
    _SCHEMA = pa.schema([("stem", pa.string()), ("aug", pa.int32()), ("png", pa.binary()), ("labels", pa.list_(pa.struct([("class_id", pa.int32()), ("poly", pa.list_(pa.float64()))]))), ("n_pasted", pa.int32()), ("pastes", pa.list_(paste))])
    return images.select("stem", "png", "labels", "region", "pool").mapInArrow(run, AUGMENTED)


def bank_of(rows: DataFrame, class_of: dict[str, int], median_area: dict[int, int], max_bytes: int = 512 << 20) -> Bank:
    """The bank of (component, rgb_path, rgb, mask) rows, PNGs both; over max_bytes of pixels, by the files' headers, is an error, as every worker holds them. bank_of_paths has no such bound."""
    side = lambda at: F.conv(F.hex(F.substring("rgb", at, 4)), 16, 10).cast("long")
    size = rows.agg(F.sum(side(17) * side(21) * 4).alias("n")).first()["n"] or 0
    if size > max_bytes:
        raise ValueError(f"the mask bank has {size} bytes of pixels; at most {max_bytes} go to every worker: use bank_of_paths")
    patches: dict[str, list] = {}
    for r in rows.orderBy("component", "rgb_path").toLocalIterator():
        if cut := extract(png.decode(bytes(r["rgb"])), png.decode(bytes(r["mask"]))):
            patches.setdefault(r["component"], []).append((r["rgb_path"], *cut))
    return Bank(patches, class_of, median_area)


#: Pairs of paths that a bank by paths may have; they go to every worker.
MAX_PATHS = 1_000_000


def bank_of_paths(rows: DataFrame, class_of: dict[str, int], median_area: dict[int, int]) -> Bank:
    """The bank of (component, rgb_path, mask_path) rows, however large: workers read a patch's files, which all of them must see, when it is drawn."""
    found = rows.select("component", "rgb_path", "mask_path").orderBy("component", "rgb_path").limit(MAX_PATHS + 1).collect()
    if len(found) > MAX_PATHS:
        raise ValueError(f"a bank has at most {MAX_PATHS} patches")
    patches: dict[str, list] = {}
    for r in found:
        patches.setdefault(r["component"], []).append((r["rgb_path"].rsplit("/", 1)[-1], r["rgb_path"], r["mask_path"]))
    return Bank(patches, class_of, median_area)


@F.arrow_udf(T.BinaryType())
def region_png(polygons: pa.Array, width: pa.Array, height: pa.Array) -> pa.Array:
    """The mask PNG (0 and 255) of polygons with at least three points, by parity; null without any."""
    out = []
    for ps, w, h in zip(polygons.to_pylist(), width.to_pylist(), height.to_pylist(), strict=True):
        ps = [p for p in ps or [] if p and len(p) >= 6]
        out.append(png.encode(S.fill_parity(ps, w, h) * np.uint8(255)) if ps and w and h else None)
    return pa.array(out, pa.binary())


def undecodable(images: DataFrame) -> DataFrame:
    """The stems of images (stem, png) that can't be decoded."""

    @F.arrow_udf(T.BooleanType())
    def fine(data: pa.Array) -> pa.Array:
        return pa.array([png.decode(x.as_py()) is not None for x in data], pa.bool_())

    return images.filter(~fine("png")).select("stem")


@F.arrow_udf(T.LongType())
def mask_pixels(mask: pa.Array) -> pa.Array:
    """Set pixels of a mask PNG; null if it can't be read."""
    pixels = (png.decode(x.as_py()) for x in mask)
    return pa.array([None if p is None else int((p > 0).sum()) for p in pixels], pa.int64())


@F.arrow_udf(T.LongType())
def raster_area(flat: pa.Array, width: pa.Array, height: pa.Array) -> pa.Array:
    """Pixels of a normalised polygon on an image of these sides."""
    out = []
    for p, w, h in zip(flat.to_pylist(), width.to_pylist(), height.to_pylist(), strict=True):
        out.append(None if p is None else int(S.fill_union([np.array(p, float).reshape(-1, 2) * [w, h]], w, h).sum()))
    return pa.array(out, pa.int64())


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def rle_polygon(rles: pa.Array) -> pa.Array:
    """The largest outer border among the masks of run lengths, flat; null without one."""
    out = []
    for masks in rles.to_pylist():
        best = None
        for m in masks or []:
            border = S.largest_contour(S.decode_rle(m["size"], m["counts_list"] if m["counts_list"] is not None else m["counts_str"]), 1.0)
            if border is not None and (best is None or S.shoelace(border) > S.shoelace(best)):
                best = border
        out.append(None if best is None else best.astype(float).ravel().tolist())
    return pa.array(out, pa.list_(pa.float64()))


@F.arrow_udf(T.StructType().add("n", "long").add("s", T.ArrayType(T.DoubleType())).add("inner", T.ArrayType(T.DoubleType())).add("noise", "double"))
def component_partials(image: pa.Array, polygons: pa.Array) -> pa.Array:
    """Pixels, Lab sums, squares around the image's own mean, and noise of an image's labelled pixels; null under 50."""
    out = []
    for data, ps in zip((x.as_py() for x in image), polygons.to_pylist(), strict=True):
        img = png.decode(data)
        if img is None or not ps:
            out.append(None)
            continue
        if img.ndim == 2:
            img = np.repeat(img[:, :, None], 3, axis=2)
        mask = S.fill_union([np.array(p, float).reshape(-1, 2) * [img.shape[1], img.shape[0]] for p in ps], img.shape[1], img.shape[0])
        n = int(mask.sum())
        if n < SCENE_PIXELS:
            out.append(None)
            continue
        lab = P.to_lab8(img[mask > 0])
        out.append({"n": n, "s": lab.sum(axis=0).tolist(), "inner": (lab.var(axis=0) * n).tolist(), "noise": P.noise_of(img, mask)})
    return pa.array(out, pa.struct([("n", pa.int64()), ("s", pa.list_(pa.float64())), ("inner", pa.list_(pa.float64())), ("noise", pa.float64())]))

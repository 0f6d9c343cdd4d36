import numpy as np
import pytest

from tessera.raster import augment as A
from tessera.raster import pixels as P
from tessera.raster import shapes as S
from tessera.sources import png


def test_fill_of_a_rectangle_counts_both_edges():
    assert S.fill_parity([[2, 3, 10, 3, 10, 8, 2, 8]], 20, 20).sum() == 9 * 6


def test_parity_leaves_a_hole_and_union_does_not():
    outer, inner = [0, 0, 19, 0, 19, 19, 0, 19], [5, 5, 14, 5, 14, 14, 5, 14]
    assert S.fill_parity([outer, inner], 20, 20).sum() == 400 - 8 * 8
    assert S.fill_union([outer, inner], 20, 20).sum() == 400


def test_fill_is_cut_at_the_borders():
    assert S.fill_parity([[-5, -5, 30, -5, 30, 30, -5, 30]], 10, 8).sum() == 80
    assert S.fill_parity([], 4, 4).sum() == 0


def test_contour_of_a_filled_polygon_gives_its_corners():
    mask = S.fill_parity([[2, 3, 10, 3, 10, 8, 2, 8]], 20, 20)
    border = S.largest_contour(mask)
    assert {tuple(p) for p in border.tolist()} == {(2, 3), (10, 3), (10, 8), (2, 8)}
    assert S.shoelace(border) == 40


def test_the_largest_of_several_regions_counts_and_small_ones_do_not():
    mask = np.zeros((30, 30), np.uint8)
    mask[1:4, 1:4] = 1
    mask[10:20, 10:25] = 1
    assert S.components(mask).max() == 2
    assert S.shoelace(S.largest_contour(mask)) == 9 * 14
    assert S.largest_contour(mask[:6, :6]) is None
    assert S.largest_contour(np.zeros((5, 5), np.uint8)) is None


def test_regions_that_touch_at_a_corner_are_one():
    mask = np.array([[1, 0, 1, 0], [0, 1, 0, 0], [0, 0, 0, 1]], np.uint8)
    assert S.components(mask).max() == 2


@pytest.mark.parametrize("seed", range(3))
def test_run_lengths_round_trip(seed):
    mask = (np.random.default_rng(seed).random((7, 5)) > 0.5).astype(np.uint8)
    flat = mask.T.ravel()
    change = np.flatnonzero(np.diff(np.concatenate([[0], flat]))).tolist()
    counts = np.diff([0, *change, len(flat)]).tolist()
    assert (S.decode_rle([7, 5], counts) == mask).all()
    assert (S.decode_rle([7, 5], compressed(counts)) == mask).all()
    with pytest.raises(ValueError):
        S.decode_rle([7, 6], counts)


def compressed(counts):
    out = ""
    for i, n in enumerate(counts):
        x = n - counts[i - 2] if i > 2 else n
        more = True
        while more:
            digit, x = x & 31, x >> 5
            more = not (x == 0 and not digit & 16 or x == -1 and digit & 16)
            out += chr(48 + (digit | 32 if more else digit))
    return out


def test_png_round_trip_and_bad_data():
    rng = np.random.default_rng(0)
    for shape in ((5, 7), (5, 7, 3)):
        img = rng.integers(0, 256, shape, dtype=np.uint8)
        assert (png.decode(png.encode(img)) == img).all()
    assert png.header(png.encode(img)) == (7, 5)
    assert png.decode(b"no") is None and png.decode(None) is None and png.header(b"no") is None
    assert png.decode(png.encode(img)[:60]) is None


def test_png_filters():
    import struct
    import zlib

    raw = bytes([1, 10, 1, 2, 2, 5, 5, 5, 3, 1, 1, 1, 4, 1, 2, 3])
    data = b"\x89PNG\r\n\x1a\n"
    for name, body in ((b"IHDR", struct.pack(">IIBBBBB", 3, 4, 8, 0, 0, 0, 0)), (b"IDAT", zlib.compress(raw))):
        data += struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    assert png.decode(data).tolist() == [[10, 11, 13], [15, 16, 18], [8, 13, 16], [9, 15, 19]]


def test_lab_round_trip():
    img = np.random.default_rng(1).integers(0, 256, (20, 20, 3), dtype=np.uint8)
    assert np.abs(P.from_lab(P.to_lab(img)).astype(int) - img).max() <= 1
    assert np.allclose(P.to_lab(np.full((1, 1, 3), 255, np.uint8)), [[[255, 128, 128]]], atol=0.5)


def test_a_paste_changes_nothing_outside_its_mask():
    rng = np.random.default_rng(2)
    back = rng.integers(0, 256, (60, 60, 3), dtype=np.uint8)
    mask = S.fill_parity([[2, 2, 25, 4, 20, 26, 4, 20]], 30, 30)
    patch = rng.integers(0, 256, (30, 30, 3), dtype=np.uint8)
    whole = np.zeros((60, 60), bool)
    whole[20:50, 10:40] = mask > 0
    for out in (P.pasted(back, patch, mask, 10, 20, 2), P.poisson(back, patch, mask, 10, 20)):
        assert (out[~whole] == back[~whole]).all() and (out != back).any()


def test_poisson_keeps_a_flat_patch_on_a_flat_ground():
    back = np.full((40, 40, 3), 90, np.uint8)
    out = P.poisson(back, np.full((20, 20, 3), 200, np.uint8), np.ones((20, 20), np.uint8), 5, 5)
    assert np.abs(out.astype(int) - 90).max() <= 1


def test_feathered_edges_by_hand():
    # A kernel of three with deviation 1 is 0.27406862, 0.45186276, 0.27406862; the core of a 5 x 5 mask in a cross of one is its 3 x 3.
    mask = np.zeros((7, 7), np.uint8)
    mask[1:6, 1:6] = 1
    core = P.eroded(mask, 1)
    assert core.sum() == 9 and core[2:5, 2:5].all()
    alpha = P.blurred(core.astype(float), 1, 1.0)
    assert alpha[3, 1] == pytest.approx(0.27406862) and alpha[3, 2] == pytest.approx(0.72593138) and alpha[3, 3] == pytest.approx(1) and alpha[1, 1] == pytest.approx(0.27406862**2)
    back, patch = np.full((7, 7, 3), 10, np.uint8), np.full((7, 7, 3), 200, np.uint8)
    out = P.pasted(back, patch, mask, 0, 0, 1)
    # 200 a + 10 (1 - a), cut: 62.07 and 147.93 and 200, and nothing outside.
    assert out[3, 0, 0] == 10 and out[3, 1, 0] == 62 and out[3, 2, 0] == 147 and out[3, 3, 0] == 200


def test_the_ellipse_is_rounded_to_whole_pixels():
    mask = np.zeros((11, 11), np.uint8)
    mask[5, 5] = 1
    hole = P.eroded(1 - mask, 2)
    # Rows -2, -1, 0, 1, 2 of the element are 1, 5, 5, 5 and 1 wide.
    assert (~hole).sum(axis=1).tolist() == [0, 0, 0, 1, 5, 5, 5, 1, 0, 0, 0]


def test_a_mirrored_border_leaves_its_edge_out():
    row = np.array([[0.0, 1.0, 0.0, 0.0]])
    got = P.blurred(row, 1, 1.0)[0]
    assert got.tolist() == pytest.approx([2 * 0.27406862, 0.45186276, 0.27406862, 0.0])


def test_noise_is_drawn_for_each_channel_and_cut():
    flat, ones = np.full((40, 40, 3), 128, np.uint8), np.ones((40, 40), np.uint8)
    out = P.noise_matched(flat, ones, 6.0, np.random.default_rng(3))
    want = np.clip(128 + np.random.default_rng(3).normal(0, 6.0, (40, 40, 3)), 0, 255).astype(np.uint8)
    assert (out == want).all() and (out[..., 0] != out[..., 1]).any()
    few = np.zeros((40, 40), np.uint8)
    few[0, :3] = 1
    assert (P.noise_matched(flat, few, 6.0, np.random.default_rng(3))[0, :3] == want[0, :3]).all()


def test_colours_go_through_whole_levels_of_lab():
    rng = np.random.default_rng(4)
    patch, mask = rng.integers(40, 200, (12, 12, 3), dtype=np.uint8), np.zeros((12, 12), np.uint8)
    mask[2:9, 2:9] = 1
    lab = P.to_lab8(patch)
    assert (lab == np.rint(lab)).all()
    mean, std = lab[mask > 0].mean(axis=0), lab[mask > 0].std(axis=0) + 1e-6
    assert all(a.tolist() == pytest.approx(b.tolist()) for a, b in zip(P.lab_stats(patch, mask), (mean, std)))
    target = (np.array([100.0, 128.0, 130.0]), np.array([5.0, 3.0, 3.0]))
    moved = np.trunc(np.clip((lab - mean) / std * target[1] + target[0], 0, 255))
    want = P.from_lab(np.where(mask[..., None] > 0, moved, lab))
    assert (P.colour_matched(patch, mask, *target) == want).all()
    assert (P.gray(patch) == np.floor(patch @ np.array([0.114, 0.587, 0.299]) + 0.5)).all()


def test_poisson_falls_back_by_the_masks_size():
    rng = np.random.default_rng(5)
    back, patch = rng.integers(0, 256, (60, 60, 3), dtype=np.uint8), rng.integers(0, 256, (12, 12, 3), dtype=np.uint8)
    whole = np.ones((12, 12), np.uint8)  # 144 pixels, 100 of them inside
    assert (P.poisson(back, patch, whole, 5, 5) != P.pasted(back, patch, whole, 5, 5, 3)).any()
    few = np.zeros((12, 12), np.uint8)
    few[1:10, 1:12] = 1  # 99
    assert (P.poisson(back, patch, few, 5, 5) == P.pasted(back, patch, few, 5, 5, 3)).all()


def test_resizes_keep_means_and_sizes():
    img = np.random.default_rng(3).integers(0, 256, (40, 60, 3), dtype=np.uint8)
    small = P.area_resize(img, 15, 10)
    assert small.shape == (10, 15, 3) and abs(small.mean() - img.mean()) < 1
    assert P.bilinear(img, 90, 80).shape == (80, 90, 3) and P.nearest(img, 7, 9).shape == (9, 7, 3)
    mask = np.ones((40, 60), np.uint8)
    got = P.scale_to(img, mask, 600)
    assert abs(int(got[1].sum()) - 600) < 80
    assert P.scale_to(img, mask * 0, 600) is None


def test_a_turn_by_ninety_degrees_swaps_sides():
    img = np.zeros((10, 20, 3), np.uint8)
    out, mask = P.rotate(img, np.ones((10, 20), np.uint8), 90)
    assert mask.shape[0] in (19, 20) and mask.shape[1] in (9, 10)
    assert mask.mean() > 0.8


def test_noise_is_raised_to_the_scenes_and_never_lowered():
    rng = np.random.default_rng(4)
    flat = np.full((60, 60, 3), 128, np.uint8)
    ones = np.ones((60, 60), np.uint8)
    assert P.noise_of(P.noise_matched(flat, ones, 8.0, rng)) > 4
    noisy = rng.integers(0, 256, (60, 60, 3), dtype=np.uint8)
    assert (P.noise_matched(noisy, ones, 1.0, rng) == noisy).all()


def bank():
    rng = np.random.default_rng(5)
    patch = rng.integers(0, 256, (30, 30, 3), dtype=np.uint8)
    mask = S.fill_parity([[3, 3, 26, 3, 26, 26, 3, 26]], 30, 30)
    return A.Bank({"screw_a": [("a.png", patch, mask)]}, {"screw_a": 0}, {0: 300})


def test_variants_depend_on_seed_image_and_number_alone():
    img = np.full((200, 200, 3), 100, np.uint8)
    labels = [(1, [0.1, 0.1, 0.2, 0.1, 0.2, 0.2])]
    a = A.augment(img, labels, bank(), A.generator(0, "x", 1))
    b = A.augment(img, labels, bank(), A.generator(0, "x", 1))
    assert (a[0] == b[0]).all() and a[1] == b[1] and a[2] == b[2]
    assert len(a[1]) == 1 + len(a[2]) and 2 <= len(a[2]) <= 5
    assert all(0 <= v <= 1 for _, p in a[1] for v in p)


def test_pastes_stay_in_their_region_and_none_gives_none():
    img = np.full((200, 200, 3), 100, np.uint8)
    region = np.zeros((200, 200), np.uint8)
    region[100:, :] = 255
    made = A.augment(img, [], bank(), A.generator(0, "y", 0), region=region)
    assert (made[0][:100] == 100).all()
    assert A.augment(img, [], bank(), A.generator(0, "y", 0), region=region * 0) is None
    assert A.augment(img, [], A.Bank({}, {}, {}), A.generator(0, "y", 0)) is None


def test_boxes_overlap_symmetrically():
    a, b = (0, 0, 10, 10), (5, 5, 15, 15)
    assert A.box_iou(a, b) == A.box_iou(b, a) == 25 / 175
    assert A.box_iou(a, a) == 1 and A.box_iou(a, (20, 20, 30, 30)) == 0

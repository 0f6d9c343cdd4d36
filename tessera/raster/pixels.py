"""Warps, colours, noise and blends."""

from __future__ import annotations

import numpy as np

EPSILON = 1e-6
#: Linear RGB to XYZ for D65, and the white point (fixed values of the sRGB standard).
_TO_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])
_WHITE = np.array([0.950456, 1.0, 1.088754])


def nearest(img: np.ndarray, width: int, height: int) -> np.ndarray:
    y = np.minimum(np.arange(height) * img.shape[0] // height, img.shape[0] - 1)
    x = np.minimum(np.arange(width) * img.shape[1] // width, img.shape[1] - 1)
    return img[y][:, x]


def bilinear(img: np.ndarray, width: int, height: int) -> np.ndarray:
    y = np.clip((np.arange(height) + 0.5) * img.shape[0] / height - 0.5, 0, img.shape[0] - 1)
    x = np.clip((np.arange(width) + 0.5) * img.shape[1] / width - 0.5, 0, img.shape[1] - 1)
    return sample(img, np.broadcast_to(x, (height, width)), np.broadcast_to(y[:, None], (height, width)))


def area_resize(img: np.ndarray, width: int, height: int) -> np.ndarray:
    """Means over the part of the image that each pixel covers."""

    def weights(n: int, m: int) -> np.ndarray:
        left, right = np.arange(m)[:, None] * n / m, (np.arange(m)[:, None] + 1) * n / m
        i = np.arange(n)[None, :]
        return np.clip(np.minimum(right, i + 1) - np.maximum(left, i), 0, None) * m / n

    out = np.tensordot(weights(img.shape[0], height), img.astype(float), axes=(1, 0))
    out = np.moveaxis(np.tensordot(weights(img.shape[1], width), out, axes=(1, 1)), 0, 1)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def sample(img: np.ndarray, x: np.ndarray, y: np.ndarray, linear: bool = True) -> np.ndarray:
    """The image at places, zero outside."""
    h, w = img.shape[:2]
    shape = (*x.shape, *img.shape[2:])
    if not linear:
        xi, yi = np.rint(x).astype(int), np.rint(y).astype(int)
        inside = (xi >= 0) & (xi < w) & (yi >= 0) & (yi < h)
        out = np.zeros(shape, img.dtype)
        out[inside] = img[yi[inside], xi[inside]]
        return out
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    out = np.zeros(shape)
    for dx in (0, 1):
        for dy in (0, 1):
            xi, yi = x0 + dx, y0 + dy
            weight = np.where(dx, x - x0, 1 - x + x0) * np.where(dy, y - y0, 1 - y + y0)
            inside = (xi >= 0) & (xi < w) & (yi >= 0) & (yi < h)
            value = img[yi[inside], xi[inside]].astype(float)
            out[inside] += value * (weight[inside][:, None] if img.ndim == 3 else weight[inside])
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def rotate(img: np.ndarray, mask: np.ndarray, degrees: float) -> tuple[np.ndarray, np.ndarray]:
    """Both turned counter-clockwise on a canvas that holds all corners; the mask takes the nearest pixel."""
    h, w = mask.shape
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    width, height = int(h * abs(s) + w * abs(c)), int(h * abs(c) + w * abs(s))
    u, v = np.meshgrid(np.arange(max(1, width)) - width / 2, np.arange(max(1, height)) - height / 2)
    x, y = c * u - s * v + w / 2, s * u + c * v + h / 2
    return sample(img, x, y), sample(mask, x, y, linear=False)


def homography(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The matrix that takes four points to four others."""
    rows, right = [], []
    for (x, y), (u, v) in zip(a, b, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    return np.append(np.linalg.solve(np.array(rows, float), np.array(right, float)), 1).reshape(3, 3)


def warp(img: np.ndarray, mask: np.ndarray, rng: np.random.Generator, strength: float) -> tuple[np.ndarray, np.ndarray]:
    """Both seen from elsewhere: each corner moves by up to strength times the sides; the canvas stays."""
    h, w = mask.shape
    corners = np.array([[0, 0], [w, 0], [w, h], [0, h]], float)
    moved = corners + rng.uniform(-strength, strength, (4, 2)) * [w, h]
    back = homography(moved, corners)
    u, v = np.meshgrid(np.arange(w), np.arange(h))
    p = back @ np.stack([u.ravel(), v.ravel(), np.ones(u.size)])
    x, y = (p[:2] / p[2]).reshape(2, h, w)
    return sample(img, x, y), sample(mask, x, y, linear=False)


def scale_to(img: np.ndarray, mask: np.ndarray, target: int, least: int = 8) -> tuple[np.ndarray, np.ndarray] | None:
    """Both scaled so that the mask has about `target` pixels, sides of at least 8."""
    now = int((mask > 0).sum())
    if not now:
        return None
    f = np.sqrt(target / now)
    w, h = max(least, int(mask.shape[1] * f)), max(least, int(mask.shape[0] * f))
    return (area_resize if f < 1 else bilinear)(img, w, h), nearest(mask, w, h)


def gray(bgr: np.ndarray) -> np.ndarray:
    """Luma rounded to whole levels, as an 8-bit image has it."""
    return np.floor(bgr.astype(float) @ [0.114, 0.587, 0.299] + 0.5)


def laplacian(img: np.ndarray) -> np.ndarray:
    """Sum of the four neighbours less four times the pixel; the border is mirrored without its edge."""
    p = np.pad(img.astype(float), 1, mode="reflect") if min(img.shape[:2]) > 1 else np.pad(img.astype(float), 1, mode="edge")
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]


def noise_of(bgr: np.ndarray, mask: np.ndarray | None = None) -> float:
    """A quarter of the Laplacian's deviation, over the mask or all."""
    l = laplacian(gray(bgr))
    return float((l[mask > 0] if mask is not None else l).std()) / 4


def to_lab(bgr: np.ndarray) -> np.ndarray:
    """Lab with all three channels from 0 to 255."""
    c = bgr[..., ::-1].astype(float) / 255
    linear = np.where(c > 0.04045, ((c + 0.055) / 1.055) ** 2.4, c / 12.92)
    t = linear @ _TO_XYZ.T / _WHITE
    f = np.where(t > 0.008856, np.cbrt(t), 7.787 * t + 16 / 116)
    lightness = np.where(t[..., 1] > 0.008856, 116 * f[..., 1] - 16, 903.3 * t[..., 1])
    return np.stack([lightness * 255 / 100, 500 * (f[..., 0] - f[..., 1]) + 128, 200 * (f[..., 1] - f[..., 2]) + 128], axis=-1)


def to_lab8(bgr: np.ndarray) -> np.ndarray:
    """Lab rounded to the 256 levels of an 8-bit image."""
    return np.clip(np.rint(to_lab(bgr)), 0, 255)


def from_lab(lab: np.ndarray) -> np.ndarray:
    lightness, a, b = lab[..., 0] * 100 / 255, lab[..., 1] - 128, lab[..., 2] - 128
    fy = (lightness + 16) / 116
    f = np.stack([fy + a / 500, fy, fy - b / 200], axis=-1)
    t = np.where(f > 6 / 29, f**3, (f - 16 / 116) / 7.787)
    t[..., 1] = np.where(lightness > 7.9996, fy**3, lightness / 903.3)
    linear = np.clip((t * _WHITE) @ np.linalg.inv(_TO_XYZ).T, 0, 1)
    c = np.where(linear > 0.0031308, 1.055 * linear ** (1 / 2.4) - 0.055, 12.92 * linear)
    return np.clip(np.rint(c[..., ::-1] * 255), 0, 255).astype(np.uint8)


def lab_stats(bgr: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation of each 8-bit Lab channel over a mask."""
    px = to_lab8(bgr[mask > 0])
    return px.mean(axis=0), px.std(axis=0) + EPSILON


def colour_matched(patch: np.ndarray, mask: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """The patch's masked pixels moved to another mean and deviation in 8-bit Lab, cut to whole levels; under 10 of them nothing is done.

    The whole patch takes the way through 8-bit Lab, which moves pixels outside the mask by a level at most.
    """
    if (mask > 0).sum() < 10:
        return patch
    own_mean, own_std = lab_stats(patch, mask)
    lab = to_lab8(patch)
    moved = np.trunc(np.clip((lab - own_mean) / own_std * std + mean, 0, 255))
    return from_lab(np.where(mask[..., None] > 0, moved, lab))


def noise_matched(patch: np.ndarray, mask: np.ndarray, noise: float, rng: np.random.Generator) -> np.ndarray:
    """The patch with Gaussian noise, drawn for each channel, that raises its own, over all of it, to the scene's; sums are cut to whole levels."""
    own = noise_of(patch)
    if noise <= own:
        return patch
    added = patch + rng.normal(0, np.sqrt(noise**2 - own**2), patch.shape)
    return np.where(mask[..., None] > 0, np.clip(added, 0, 255).astype(np.uint8), patch)


def eroded(mask: np.ndarray, radius: int) -> np.ndarray:
    """The mask's pixels whose whole ellipse lies in it; outside the image counts as inside.

    The ellipse is as wide in each row as the circle rounded to whole pixels.
    """
    out = mask > 0
    p = np.pad(out, radius, constant_values=True)
    h, w = mask.shape
    for dy in range(-radius, radius + 1):
        reach = int(np.rint(np.sqrt(radius * radius - dy * dy)))
        for dx in range(-reach, reach + 1):
            out = out & p[radius + dy : radius + dy + h, radius + dx : radius + dx + w]
    return out


def blurred(a: np.ndarray, radius: int, sigma: float) -> np.ndarray:
    """A Gaussian of 2 radius + 1 pixels along both axes; the border is mirrored without its edge."""
    k = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    k /= k.sum()
    for axis in (0, 1):
        n = a.shape[axis]
        at = np.abs(np.arange(-radius, n + radius))
        if n > 1:
            at = at % (2 * n - 2)
            at = np.where(at < n, at, 2 * n - 2 - at)
        p = np.take(a, np.minimum(at, n - 1), axis=axis)
        a = sum(w * np.take(p, np.arange(i, i + n), axis=axis) for i, w in enumerate(k))
    return a


def pasted(background: np.ndarray, patch: np.ndarray, mask: np.ndarray, x: int, y: int, feather: int = 1) -> np.ndarray:
    """The patch over the background, its edge feathered inwards, so that nothing outside the mask changes; sums, in single precision, are cut to whole levels."""
    alpha = (mask > 0).astype(np.float32)
    if feather > 0:
        alpha = blurred(eroded(mask, feather).astype(float), feather, float(feather)).astype(np.float32) * alpha
    alpha = alpha[..., None]
    h, w = mask.shape
    out = background.copy()
    under = out[y : y + h, x : x + w].astype(np.float32)
    out[y : y + h, x : x + w] = np.clip(patch.astype(np.float32) * alpha + under * (1 - alpha), 0, 255).astype(np.uint8)
    return out


def poisson(background: np.ndarray, patch: np.ndarray, mask: np.ndarray, x: int, y: int, least: int = 100, steps: int = 400) -> np.ndarray:
    """The patch's gradients fitted to the background around it, by conjugate gradients; a feathered paste if the mask has under `least` pixels, or if they don't converge.

    The outermost ring of the patch is the fit's border and stays the background's, even where the mask covers it.
    """
    h, w = mask.shape
    inner = np.zeros((h, w), bool)
    inner[1:-1, 1:-1] = mask[1:-1, 1:-1] > 0
    if (mask > 0).sum() < least or not inner.any():
        return pasted(background, patch, mask, x, y, 3)
    out = background.copy()
    under = out[y : y + h, x : x + w].astype(float)

    def apply(v: np.ndarray) -> np.ndarray:
        p = np.pad(v, 1)
        return np.where(inner, 4 * v - p[:-2, 1:-1] - p[2:, 1:-1] - p[1:-1, :-2] - p[1:-1, 2:], 0)

    for c in range(3):
        edge = np.where(inner, 0, under[..., c])
        p = np.pad(edge, 1)
        right = np.where(inner, -laplacian(patch[..., c]) + p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:], 0)
        v = np.where(inner, under[..., c], 0)
        r = right - apply(v)
        d, rr = r.copy(), float((r * r).sum())
        for _ in range(steps):
            if rr < 1e-3 * inner.sum():
                break
            q = apply(d)
            a = rr / float((d * q).sum())
            v, r = v + a * d, r - a * q
            rr, before = float((r * r).sum()), rr
            d = r + rr / before * d
        if not np.isfinite(rr):
            return pasted(background, patch, mask, x, y, 3)
        under[..., c] = np.where(inner, v, under[..., c])
    out[y : y + h, x : x + w] = np.clip(np.rint(under), 0, 255).astype(np.uint8)
    return out

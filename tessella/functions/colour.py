"""Colour spaces and patch filters on numpy batches of shape (n, h, w, c); used inside Arrow tasks."""

from __future__ import annotations

import numpy as np

# Stain colours of haematoxylin, eosin and DAB as rows.
RGB_FROM_HED = np.array([[0.65, 0.70, 0.29], [0.07, 0.99, 0.11], [0.27, 0.57, 0.78]])
HED_FROM_RGB = np.linalg.inv(RGB_FROM_HED)
_FLOOR = 1e-6


def rgb_to_hed(rgb: np.ndarray) -> np.ndarray:
    return np.maximum(np.log(np.maximum(rgb, _FLOOR)) / np.log(_FLOOR) @ HED_FROM_RGB, 0)


def hed_to_rgb(hed: np.ndarray) -> np.ndarray:
    return np.clip(np.exp((hed * np.log(_FLOOR)) @ RGB_FROM_HED), 0, 1)


def rgb_to_hsv(rgb: np.ndarray) -> np.ndarray:
    top, low = rgb.max(-1), rgb.min(-1)
    span = top - low
    safe = np.where(span == 0, 1, span)
    r, g, b = rgb[..., 0], rgb[..., 1], rgb[..., 2]
    h = np.where(top == r, (g - b) / safe, np.where(top == g, 2 + (b - r) / safe, 4 + (r - g) / safe))
    h = np.where(span == 0, 0, h / 6 % 1)
    return np.stack([h, np.where(top == 0, 0, span / np.where(top == 0, 1, top)), top], -1)


def hsv_to_rgb(hsv: np.ndarray) -> np.ndarray:
    h, s, v = hsv[..., 0], hsv[..., 1], hsv[..., 2]
    k = (np.array([5.0, 3.0, 1.0]) + h[..., None] * 6) % 6
    return v[..., None] * (1 - s[..., None] * np.clip(np.minimum(k, 4 - k), 0, 1))


def gaussian_kernel(sigma: float) -> np.ndarray:
    radius = int(4.0 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2) if sigma > 0 else np.ones(1)
    return k / k.sum()


def gaussian_blur(patch: np.ndarray, sigma: float, mode: str = "symmetric") -> np.ndarray:
    """Separable Gaussian over the two leading axes of one patch."""
    k = gaussian_kernel(sigma)
    r = len(k) // 2
    for axis in (0, 1):
        width = [(r, r) if a == axis else (0, 0) for a in range(patch.ndim)]
        padded = np.pad(patch, width, mode=mode)
        patch = sum(w * np.take(padded, np.arange(i, i + patch.shape[axis]), axis=axis) for i, w in enumerate(k))
    return patch


def _mirror(index: np.ndarray, n: int) -> np.ndarray:
    index = np.mod(index, 2 * n)
    return np.where(index < n, index, 2 * n - 1 - index)


def resample(patch: np.ndarray, y: np.ndarray, x: np.ndarray, order: int) -> np.ndarray:
    """Values at fractional positions, nearest (0) or bilinear (1), mirrored at the border."""
    h, w = patch.shape[:2]
    if order == 0:
        return patch[_mirror(np.floor(y + 0.5).astype(int), h), _mirror(np.floor(x + 0.5).astype(int), w)]
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = y - y0, x - x0
    if patch.ndim == 3:
        fy, fx = fy[..., None], fx[..., None]
    at = lambda a, b: patch[_mirror(a, h), _mirror(b, w)]
    return (at(y0, x0) * (1 - fy) * (1 - fx) + at(y0, x0 + 1) * (1 - fy) * fx
            + at(y0 + 1, x0) * fy * (1 - fx) + at(y0 + 1, x0 + 1) * fy * fx)


def scale_patch(patch: np.ndarray, factor: float, order: int) -> np.ndarray:
    """Zoom about the centre, same output shape; a factor below 1 pads by reflection first."""
    h, w = patch.shape[:2]
    if factor < 1:
        ratio = (1.0 / factor - 1.0) / 2.0
        pad = [(int(np.ceil(h * ratio)),) * 2, (int(np.ceil(w * ratio)),) * 2] + [(0, 0)] * (patch.ndim - 2)
        patch = np.pad(patch, pad, mode="reflect")
    ph, pw = patch.shape[:2]
    zh, zw = int(round(ph * factor)), int(round(pw * factor))
    top, left = (zh - h) // 2, (zw - w) // 2
    y = (np.arange(h) + top) * ((ph - 1) / max(zh - 1, 1))
    x = (np.arange(w) + left) * ((pw - 1) / max(zw - 1, 1))
    return resample(patch, *np.meshgrid(y, x, indexing="ij"), order)


def deformation(shape: tuple[int, int], alpha: float, sigma: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Displaced sample positions: smoothed uniform noise times alpha."""
    def noise():
        return gaussian_blur(rng.random(shape) * 2 - 1, sigma, "constant") * alpha
    y, x = np.meshgrid(np.arange(shape[0]), np.arange(shape[1]), indexing="ij")
    return y + noise(), x + noise()

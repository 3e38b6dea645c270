"""Patches as flat row-major arrays: index maps, value ranges, one-hot labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row. Without it the optimizer may inline an
    expression into a lambda and evaluate it again for every array element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _gather(px: str, h: int, w: int, c: int, source, extra: Column | None = None) -> Column:
    """New patch of shape (h, w, c) whose value at (y, x, k) is ``px[source(y, x, k)]``; ``extra`` is a per-row
    value that ``source`` gets as its last argument."""
    def build(b):
        def at(i):
            k = F.pmod(i, F.lit(c)) if c > 1 else F.lit(0)
            p = F.floor(i / c) if c > 1 else i
            args = (F.floor(p / w), F.pmod(p, F.lit(w)), k)
            return F.get(b["px"], source(*args, *([] if extra is None else [b["e"]])).cast("int"))
        return F.transform(F.sequence(F.lit(0), F.lit(h * w * c - 1)), at)
    bound = [F.col(px).alias("px")] + ([] if extra is None else [extra.alias("e")])
    return let(F.struct(*bound), build)


def flip(px: str, h: int, w: int, mode: str | Column, c: int = 1) -> Column:
    """Mirror a patch: 'none', 'vertical', 'horizontal' or 'both'; another mode is an error."""
    m = F.lit(mode) if isinstance(mode, str) else mode
    bits = F.when(m == "none", 0).when(m == "vertical", 1).when(m == "horizontal", 2).when(m == "both", 3).otherwise(
        F.raise_error(F.lit("unknown flip mode")).cast("int"))

    def source(y, x, k, b):
        yy = F.when(b % 2 == 1, h - 1 - y).otherwise(y)
        xx = F.when(b >= 2, w - 1 - x).otherwise(x)
        return (yy * w + xx) * c + k
    return _gather(px, h, w, c, source, bits)


def rot90(px: str, side: int, k: int | Column, c: int = 1) -> Column:
    """Rotate a square patch counter-clockwise k times by 90 degrees."""
    turns = F.pmod(F.lit(k) if isinstance(k, int) else k, F.lit(4))
    n = side - 1

    def source(y, x, ch, t):
        yy = F.when(t == 0, y).when(t == 1, x).when(t == 2, n - y).otherwise(n - x)
        xx = F.when(t == 0, x).when(t == 1, n - y).when(t == 2, n - x).otherwise(y)
        return (yy * side + xx) * c + ch
    return _gather(px, side, side, c, source, turns)


def to_channels_first(px: str, h: int, w: int, c: int) -> Column:
    """(h, w, c) -> (c, h, w)."""
    def build(p):
        return F.transform(F.sequence(F.lit(0), F.lit(h * w * c - 1)), lambda i: F.get(
            p, (F.pmod(i, F.lit(h * w)) * c + F.floor(i / (h * w))).cast("int")))
    return let(F.col(px), build)


def to_channels_last(px: str, h: int, w: int, c: int) -> Column:
    """(c, h, w) -> (h, w, c)."""
    return _gather(px, h, w, c, lambda y, x, k: k * (h * w) + y * w + x)


def resize_nearest(px: str, h: int, w: int, out_h: int, out_w: int) -> Column:
    """Nearest resize of a single-channel patch: source index floor(i * size / new size)."""
    return _gather(px, out_h, out_w, 1, lambda y, x, k: F.floor(y * h / out_h) * w + F.floor(x * w / out_w))


def centre_crop(px: str, h: int, w: int, out_h: int, out_w: int, c: int = 1) -> Column:
    top, left = (h - out_h) // 2, (w - out_w) // 2
    return _gather(px, out_h, out_w, c, lambda y, x, k: ((y + top) * w + x + left) * c + k)


def window(px: str, w: int, top: int, left: int, out_h: int, out_w: int, c: int = 1) -> Column:
    return _gather(px, out_h, out_w, c, lambda y, x, k: ((y + top) * w + x + left) * c + k)


def one_hot(label: Column, classes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == label).cast("int"))


# ---- value ranges ----
def squash(px: str) -> Column:
    """Bytes to floats in [0, 1]."""
    return F.transform(px, lambda v: v / F.lit(255.0))


def rgb_range(px: str, low: float, high: float) -> Column:
    """[0, 255] to [low, high]."""
    return F.transform(px, lambda v: v * F.lit((high - low) / 255.0) + low)


def general_range(px: str, source: tuple[float, float], target: tuple[float, float], legacy: bool = False) -> Column:
    """[source] to [target]. ``legacy`` divides by the product of both widths instead of scaling to the
    target's width; the two agree when the target is one wide."""
    s, t = source[1] - source[0], target[1] - target[0]
    scale = 1.0 / (s * t) if legacy else t / s
    return F.transform(px, lambda v: (v - source[0]) * F.lit(scale) + target[0])


def additional_range(px: str, target: tuple[float, float]) -> Column:
    """[0, 1] to [target]."""
    return F.transform(px, lambda v: v * F.lit(target[1] - target[0]) + target[0])


def gan_in(px: str) -> Column:
    return F.transform(px, lambda v: v / F.lit(127.5) - 1)


def gan_out(px: str) -> Column:
    return F.transform(px, lambda v: F.least(F.greatest((v + 1) / 2, F.lit(0.0)), F.lit(1.0)))


def mean(px: str) -> Column:
    return F.aggregate(px, F.lit(0.0), lambda acc, v: acc + v) / F.size(px)


def contrast(px: str, sigma: Column, peak: float, centre: Column) -> Column:
    """Stretch values around ``centre``: [sigma * centre, peak - sigma * (peak - centre)] becomes [0, peak],
    values beyond are clipped. Integer ranges (peak 255) truncate, up to 1e-9 below a whole number counting as it."""
    low, high = centre * sigma, F.lit(peak) - (F.lit(peak) - centre) * sigma

    def build(b):
        def one(v):
            s = (F.least(F.greatest(v, b["low"]), b["high"]) - b["low"]) / (b["high"] - b["low"]) * peak
            return F.floor(s + 1e-9).cast("int") if peak == 255.0 else s
        return F.transform(b["px"], one)
    return let(F.struct(F.col(px).alias("px"), low.alias("low"), high.alias("high")), build)

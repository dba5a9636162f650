"""Arithmetic as Column expressions: vectors, intervals, boxes, sizes, scores."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """F13, in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, eps: float = 0.0) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + eps)


def unit(a: Column, eps: float = 1e-9) -> Column:
    return F.transform(F.array(norm(a) + eps), lambda n: F.transform(a, lambda x: x.cast("double") / n))[0]


def overlap_length(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """F15."""
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def round_half_even(x: Column, digits: int = 0) -> Column:
    """what Python's round() does."""
    return F.bround(x, digits)


def brightness_score(mean: Column) -> Column:
    """1 at mid grey, 0 a third of the range away from it."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.abs(mean - 0.5) * 3))


def candidate_rank(motion: Column, tout: Column, bright: Column) -> Column:
    """Lower is better."""
    return motion + F.greatest(F.lit(0.0), tout - 0.05) * 8 + (1 - bright) * 0.5


def key_frame_score(stability: Column, sharpness: Column, entropy: Column, bright: Column, tout: Column, most_sharp: Column | None = None, most_entropy: Column | None = None) -> Column:
    """Weighted parts, lowered by overexposed pixels over 5 %. Sharpness and entropy are parts of the largest ones; where
    these are given, values are weighted first and then divided, as near ties hang on the last digit."""
    sharp, ent = 0.25 * sharpness, 0.2 * entropy
    s = 0.4 * stability + (sharp if most_sharp is None else sharp / most_sharp) + (ent if most_entropy is None else ent / most_entropy) + 0.15 * bright
    return F.when(tout > 0.05, s * (1 - (tout - 0.05) / 0.95)).otherwise(s)


def square_crop(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, scale: float = 1.3) -> Column:
    """struct(x1, y1, x2, y2): the square around a box's centre whose side is the box's longer one times scale, moved
    into the frame; corners are cut to whole pixels last. A square larger than the frame sticks out on the near side."""
    side = F.greatest(x2 - x1, y2 - y1) * F.lit(scale)

    def place(lo: Column, hi: Column, most: Column) -> tuple[Column, Column]:
        first = (lo + hi) / 2.0 - side / 2.0
        last = F.when(first < 0, first + side - first).otherwise(first + side)
        first = F.greatest(first, F.lit(0.0))
        return F.when(last > most, first - (last - most)).otherwise(first).cast("int"), F.least(last, most.cast("double")).cast("int")

    (left, right), (top, bottom) = place(x1, x2, width), place(y1, y2, height)
    return F.struct(left.alias("x1"), top.alias("y1"), right.alias("x2"), bottom.alias("y2"))


def padded_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, pad: float = 1.0) -> Column:
    """a face's protected box: padded on all sides by a part of its longer one, clipped to the frame, then rounded (half
    to even). Null for a box without an area."""
    by = F.greatest(x2 - x1, y2 - y1) * F.lit(float(pad))
    whole = lambda v: F.bround(v.cast("double"), 0).cast("int")
    near, far = (lambda v: whole(F.greatest(F.lit(0.0), v - by))), (lambda v, most: whole(F.least(most.cast("double"), v + by)))
    box = F.struct(near(x1).alias("x1"), near(y1).alias("y1"), far(x2, width).alias("x2"), far(y2, height).alias("y2"))
    return F.when((x2 > x1) & (y2 > y1) & (box["x2"] > box["x1"]) & (box["y2"] > box["y1"]), box)


def scaled_width(width: Column, height: Column, target: int = 540) -> Column:
    """width after scaling to a height, up or down; at least 1."""
    return F.greatest(F.lit(1), F.bround((width * target / height).cast("double"), 0).cast("int"))


def visual_tokens(width: Column, height: Column, patch: int = 32) -> Column:
    """F25."""
    return (F.ceil(width / patch) * F.ceil(height / patch)).cast("int")


def work_size(width: Column, height: Column, short: int = 960) -> Column:
    """struct(w, h): the shorter side becomes `short`, also where it was smaller, the longer one keeps the ratio, cut to
    a whole number; odd ones become even."""
    wide = width >= height
    scaled = F.floor(F.greatest(width, height).cast("long") * short / F.least(width, height)).cast("int")
    even = lambda x: (x + F.pmod(x, F.lit(2))).cast("int")
    return F.struct(even(F.when(wide, scaled).otherwise(short)).alias("w"), even(F.when(wide, F.lit(short)).otherwise(scaled)).alias("h"))


def fps_of(avg: Column, real: Column, time_base: Column) -> Column:
    """Average, then nominal rate, then 1 / time base, then NTSC."""
    good = lambda c: F.when((c > 0) & ~F.isnan(c), c)
    return F.coalesce(good(avg), good(real), 1 / good(time_base), F.lit(30000 / 1001))


def gaussian_weights(sigma: float = 3.0) -> list[float]:
    """The kernel over -4 sigma .. 4 sigma, summing to 1."""
    r = math.ceil(sigma * 4)
    w = [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-r, r + 1)]
    return [x / sum(w) for x in w]

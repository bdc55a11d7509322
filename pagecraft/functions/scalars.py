"""Column helpers: rounding, colours, rhythm and vectors. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagecraft.functions import vocab


def half_up(x: Column) -> Column:
    """Rounded to a whole number, halves upwards, also below zero; noise under 1e-9 does not decide a half."""
    return F.floor(F.round(x, 9) + F.lit(0.5))


def let(value: Column, use) -> Column:
    """use(value), with value computed once for a row however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def base64_of(data: Column) -> Column:
    """Base64 in one line."""
    return F.regexp_replace(F.base64(data), "\\s", "")


def is_hero(kind: Column) -> Column:
    return kind.startswith("hero")


# Colours as '#rrggbb'.


def channels(hex_: Column) -> list[Column]:
    """r, g, b; what is not a colour counts as black."""
    bare = F.regexp_extract(hex_, r"(?i)^#?([a-f0-9]{6})$", 1)
    part = lambda i: F.when(bare == "", F.lit(0)).otherwise(F.conv(F.substring(bare, i, 2), 16, 10).cast("int"))
    return [part(1), part(3), part(5)]


def rgb_number(hex_: Column) -> Column:
    """A colour as one whole number; what is not a colour counts as black."""
    return F.coalesce(F.conv(F.nullif(F.regexp_extract(hex_, r"(?i)^#?([a-f0-9]{6})$", 1), F.lit("")), 16, 10).cast("int"), F.lit(0))


def split_number(n: Column) -> tuple[Column, Column, Column]:
    """r, g, b of a rgb_number()."""
    r, g, b = (F.shiftright(n, shift).bitwiseAND(F.lit(255)) for shift in (16, 8, 0))
    return r, g, b


def parsed(hex_: Column) -> Column:
    """struct(hex, r, g, b, luma, sat), for what names a colour's numbers more than once. luma is 0..255."""

    def numbers(n: Column) -> Column:
        r, g, b = split_number(n)
        return F.struct(hex_.alias("hex"), r.alias("r"), g.alias("g"), b.alias("b"), _luma(r, g, b).alias("luma"), hsl_of(r, g, b)[1].alias("sat"))

    return F.when(hex_.isNotNull(), let(rgb_number(hex_), numbers))


def to_hex(r: Column, g: Column, b: Column) -> Column:
    return F.concat(F.lit("#"), *[F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0") for c in (r, g, b)])


def rgb_text_to_hex(text: Column) -> Column:
    """'rgb(a)(r, g, b, ...)' as hex; text with fewer than three numbers stays."""
    numbers = F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))
    return F.when(F.size(numbers) >= 3, to_hex(*[F.get(numbers, F.lit(i)).cast("int") for i in range(3)])).otherwise(text)


def _luma(r: Column, g: Column, b: Column) -> Column:
    return r * F.lit(0.299) + g * F.lit(0.587) + b * F.lit(0.114)


def luminance(hex_: Column) -> Column:
    return _luma(*channels(hex_)) / F.lit(255.0)


def is_dark(hex_: Column) -> Column:
    # The luma itself: over 255 and back it may fall below 128 where it is 128.
    return _luma(*channels(hex_)) < 128


def hsl_of(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """Hue as a share of the circle, saturation and lightness in 0..1; of equal channels the first of r, g, b decides the hue. All are
    quotients of whole numbers, so each is rounded once."""
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    d, both = high - low, high + low
    sat = F.when(d == 0, F.lit(0.0)).when(both > 255, F.try_divide(d, 510 - both)).otherwise(F.try_divide(d, both))
    turn = F.when(high == r, g - b + F.when(g < b, d * 6).otherwise(0)).when(high == g, b - r + d * 2).otherwise(r - g + d * 4)
    return F.when(d == 0, F.lit(0.0)).otherwise(F.try_divide(turn, d * 6)), sat, both / F.lit(510.0)


def hsl(hex_: Column) -> tuple[Column, Column, Column]:
    return hsl_of(*channels(hex_))


def saturation(hex_: Column) -> Column:
    return hsl(hex_)[1]


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(channels(a), channels(b), strict=True)), F.lit(0)).cast("double"))


def _linear(c: Column) -> Column:
    x = c / F.lit(255.0)
    return F.when(x <= 0.03928, x / 12.92).otherwise(F.pow((x + 0.055) / 1.055, F.lit(2.4)))


def relative_luminance(hex_: Column) -> Column:
    r, g, b = channels(hex_)
    return _linear(r) * 0.2126 + _linear(g) * 0.7152 + _linear(b) * 0.0722


def contrast(a: Column, b: Column) -> Column:
    x, y = relative_luminance(a), relative_luminance(b)
    return (F.greatest(x, y) + 0.05) / (F.least(x, y) + 0.05)


def shifted(hex_: Column, amount: float) -> Column:
    step = F.floor(F.lit(amount * 255.0) + 0.5)
    moved = to_hex(*[F.greatest(F.lit(0), F.least(F.lit(255), c + step)) for c in channels(hex_)])
    return F.when(F.rlike(hex_, F.lit(r"(?i)^#?[a-f0-9]{6}$")), moved).otherwise(hex_)


# The ranges of the tones, on r, g and b.
TONES = {
    "gold": lambda r, g, b: (r > 170) & (g > 140) & (g < 220) & (b < 120) & (r > g),
    "maroon": lambda r, g, b: (r > 100) & (r < 180) & (g < 50) & (b < 50),
    "saffron": lambda r, g, b: (r > 200) & (g > 100) & (g < 180) & (b < 80),
    "green": lambda r, g, b: (r < 80) & (g > 80) & (g < 160) & (b < 80),
}


def tone(hex_: Column, name: str) -> Column:
    return TONES[name](*channels(hex_))


def gap(a: Column, b: Column) -> Column:
    """The distance of two parsed() colours."""
    return F.sqrt(sum(((a[c] - b[c]) * (a[c] - b[c]) for c in "rgb"), F.lit(0)).cast("double"))


# Vectors as arrays of doubles.


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + F.lit(1e-8))


def weights(vertical: Column) -> Column:
    """The weights of a vertical as an array."""
    arrays = {v: F.array(*[F.lit(x) for x in vocab.weights(v)]) for v in (*vocab.VERTICAL_WEIGHTS, "default")}
    return reduce(lambda out, v: F.when(vertical == v, arrays[v]).otherwise(out), vocab.VERTICAL_WEIGHTS, arrays["default"])


def weighted_cosine(a: Column, b: Column, vertical: Column) -> Column:
    w = weights(vertical)
    times = lambda x: F.zip_with(x, w, lambda p, q: p * q)
    return cosine(times(a), times(b))


def rhythm(sections: Column) -> Column:
    return F.array_join(F.transform(sections, lambda s: F.when(s["is_dark"], "D").otherwise("L")), "")


def transitions(text: Column) -> Column:
    """Changes between light and dark, counted without overlap."""
    return F.regexp_count(text, F.lit("LD|DL"))


def first_index(sections: Column, test) -> Column:
    """0-based index of the first element that passes, or -1."""
    return F.coalesce(F.array_position(F.transform(sections, lambda s: F.coalesce(test(s), F.lit(False))), True) - 1, F.lit(-1).cast("long"))


def decayed(score: Column, crawled: Column, as_of: Column, half_life_days: float = 180.0) -> Column:
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(crawled.cast("timestamp"))) / F.lit(86_400_000_000.0)
    return score * F.pow(F.lit(0.5), age / F.lit(half_life_days))

"""Scalar expressions: easing, colours, ids, ladders, parsing of settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def smoothstep(u: Column) -> Column:
    u = clamp(u)
    return u * u * (3 - 2 * u)


def smootherstep(u: Column) -> Column:
    u = clamp(u)
    return u * u * u * (10 + u * (6 * u - 15))


def cosine_ease(u: Column) -> Column:
    return (1 - F.cos(clamp(u) * F.pi())) / 2


def ease(u: Column, kind: str) -> Column:
    kinds = {"linear": clamp, "smoothstep": smoothstep, "smootherstep": smootherstep, "cosine": cosine_ease}
    if kind not in kinds:
        raise ValueError(f"unknown easing {kind}")
    return kinds[kind](u)


def ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long")


def hue(label: Column, golden: float = 0.61803398875) -> Column:
    """Hue in [0, 1) of a label's colour; neighbours in number are far apart in colour."""
    return (label.cast("double") * golden) % 1.0


def scale_bar(width: Column, ladder: Sequence[float], share: float = 0.28, fallback: float = 0.2) -> Column:
    """The longest length of a ladder within a share of the width, else a share of it."""
    fits = F.array_max(F.filter(F.array(*[F.lit(float(v)) for v in ladder]), lambda v: v <= width * share))
    return F.coalesce(fits, width * fallback)


def ladder_125(width: Column, share: float = 0.22) -> Column:
    """The longest of 1, 2, 5 times a power of ten within a share of the width."""
    most = width * share
    power = F.pow(F.lit(10.0), F.floor(F.log10(most)))
    return F.when(most >= 5 * power, 5 * power).when(most >= 2 * power, 2 * power).otherwise(power)


def beta_tag(beta: Column) -> Column:
    """A number in twelve significant digits as a part of a name: p for the point, m for minus."""
    return F.translate(significant(beta.cast("double"), 12), ".-", "pm")


def truth(text: Column) -> Column:
    """A boolean from its usual spellings, null for others."""
    t = F.lower(F.trim(text))
    return F.when(t.isin("1", "true", "yes", "on"), True).when(t.isin("0", "false", "no", "off"), False)


def triplet(text: Column) -> Column:
    """Three positive numbers from text with commas, null otherwise."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("double"))
    return F.when((F.size(parts) == 3) & F.forall(parts, lambda v: F.coalesce(v > 0, F.lit(False))), parts)


def is_remote(path: Column) -> Column:
    return path.rlike(r"^(https?|gs|s3|precomputed|zarr|n5)://")


def plain_url(url: Column) -> Column:
    """An http or https URL without credentials and query."""
    return url.rlike(r"^https?://[^/?#@\s]+(/[^?#\s]*)?(#\S*)?$")


def secret_key(name: Column) -> Column:
    """Names of settings that look like secrets."""
    return name.rlike("(?i)(secret|token|passw|credential|api_?key|private_?key|access_?key)")


def shape_product(shape: Column) -> Column:
    return F.aggregate(shape, F.lit(1).cast("long"), lambda a, x: a * x)


def is_vector(a: Column, size: int = 3) -> Column:
    """An array of so many positive numbers."""
    return F.coalesce((F.size(a) == size) & F.forall(a, lambda x: x.isNotNull() & (x > 0)), F.lit(False))


def whole(a: Column) -> Column:
    """Whether all entries are whole numbers."""
    return F.coalesce(F.forall(a, lambda x: x == F.floor(x)), F.lit(False))


def significant(x: Column, digits: int = 7) -> Column:
    """A number in so many significant digits, trailing zeros cut; with an exponent of at least two
    digits where it is below -4 or does not fit the digits."""
    raw = F.format_string(f"%.{digits - 1}e", x.cast("double"))
    power = F.split_part(raw, F.lit("e"), F.lit(2)).cast("int")
    trim = lambda t: F.when(t.contains("."), F.rtrim(F.rtrim(t, F.lit("0")), F.lit("."))).otherwise(t)
    plain = F.call_function("format_string", F.concat(F.lit("%."), F.greatest(F.lit(0), digits - 1 - power).cast("string"), F.lit("f")), x.cast("double"))
    far = F.concat(trim(F.split_part(raw, F.lit("e"), F.lit(1))), F.lit("e"), F.split_part(raw, F.lit("e"), F.lit(2)))
    return F.when(x == 0, "0").when((power < -4) | (power >= digits), far).otherwise(trim(plain))


def short_number(x: Column, digits: int = 7) -> Column:
    return significant(x, digits)


def filled_in(template: Column, values: dict[str, Column]) -> Column:
    """A template with each {name} replaced; null where a name in braces is left, as none is known."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return F.when(~out.rlike(r"\{[^{}]*\}"), out)


def missing_keys(given: Column, needed: Sequence[str]) -> Column:
    """Needed keys that a map does not have, in order."""
    return F.array_except(F.array(*map(F.lit, needed)), F.map_keys(given))


def overlaid(defaults: Column, given: Column) -> Column:
    """A map of defaults with what is given on top."""
    return F.map_from_entries(F.concat(F.filter(F.map_entries(defaults), lambda e: ~F.map_contains_key(given, e["key"])), F.map_entries(given)))


def run_id(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd'T'HHmmss")


def inside_folder(path: Column) -> Column:
    """A relative path that stays below its folder: not empty, not absolute, no step upwards."""
    return F.coalesce((F.length(path) > 0) & ~path.rlike(r"^([/\\]|[A-Za-z]:)") & ~path.rlike(r"(^|/)\.\.(/|$)"), F.lit(False))


def overlaps_source(output: Column, source: Column) -> Column:
    """Whether an output path is the source or lies below it."""
    plain = lambda p: F.rtrim(p, F.lit("/"))
    return (plain(output) == plain(source)) | F.startswith(output, F.concat(plain(source), F.lit("/")))


def hex_colour(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("#%02x%02x%02x", r, g, b)

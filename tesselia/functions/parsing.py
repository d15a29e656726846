"""Values out of vendor properties and text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Suffixes of slide files. Fixed values.
SUFFIXES = (".mrxs", ".svs", ".tif", ".tiff", ".ndpi", ".vms", ".vmu", ".scn", ".bif")

#: Patterns of microns per pixel in free text, in any case; the first that matches counts. Fixed values.
MPP_PATTERNS = (
    r"\bmpp(?:[_\s-]*x)?\s*[:=]\s*([0-9]+(?:\.[0-9]+)?)",
    r"\bmicrons?\s+per\s+pixel\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)",
    r"\bmicrometers?\s+per\s+pixel\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)",
    r"\b(?:pixel\s+size|pixelsize)\s*[:=]\s*([0-9]+(?:\.[0-9]+)?)\s*(?:um|µm)",
)

#: Properties that may hold such text, and microns in a unit of resolution tags. Fixed values.
TEXT_KEYS = ("openslide.comment", "tiff.imagedescription", "image_description")
UNITS = {25400.0: ("inch", "inches", "2"), 10000.0: ("centimeter", "centimetre", "cm", "3")}


def has_suffix(name: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """Whether the name ends in one of the suffixes, in any case."""
    low = F.lower(name)
    out = F.lit(False)
    for s in suffixes:
        out = out | low.endswith(s)
    return out


def lenient_float(value: Column) -> Column:
    """A number or a fraction ``a/b`` as double; null if it is neither, empty, or b is zero."""
    text = F.trim(value)
    plain = F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
    fraction = r"^([0-9]+(?:\.[0-9]+)?)\s*/\s*([0-9]+(?:\.[0-9]+)?)$"
    a, b = (F.nullif(F.regexp_extract(text, fraction, i), F.lit("")).try_cast("double") for i in (1, 2))
    return F.coalesce(plain, F.try_divide(a, F.nullif(b, F.lit(0.0))))


def mpp_from_text(value: Column) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(value, "(?i)" + p, 1), F.lit("")).try_cast("double") for p in MPP_PATTERNS])


def _mpp(x: Column, y: Column, source: str) -> Column:
    return F.struct(x.alias("mpp_x"), y.alias("mpp_y"), F.lit(source).alias("mpp_source"))


def lower_keys(props: Column) -> Column:
    return F.transform_keys(props, lambda k, _: F.lower(k))


#: Keys whose values are numbers, in the order of the arms that read them. Fixed values.
X_KEYS = ("openslide.mpp-x", "mpp_x", "mppx")
Y_KEYS = ("openslide.mpp-y", "mpp_y", "mppy")
POWER_KEYS = ("openslide.objective-power", "aperio.appmag", "hamamatsu.sourcelens", "objective_power")
NUMBER_KEYS = (*X_KEYS, *Y_KEYS, "aperio.mpp", "tiff.xresolution", "tiff.yresolution", *POWER_KEYS)


def mpp_chain(props: Column) -> Column:
    """Struct of mpp_x, mpp_y and mpp_source out of a map of properties by lower-case key; the first arm that gives numbers counts.

    Order: pixel sizes by axis, the vendor's single size, free text, resolution tags, objective power. A missing axis is
    taken from the other. Null if no arm applies. All values are parsed once, and the arms read the parsed ones.
    """
    keys = lambda names: F.array(*[F.lit(k) for k in names])
    parsed = F.struct(
        F.transform(keys(NUMBER_KEYS), lambda k: lenient_float(F.element_at(props, k))).alias("numbers"),
        F.transform(keys(TEXT_KEYS), lambda k: mpp_from_text(F.element_at(props, k))).alias("texts"),
        F.lower(F.trim(F.element_at(props, F.lit("tiff.resolutionunit")))).alias("unit"),
    )
    return F.get(F.transform(F.array(parsed), _mpp_arms), F.lit(0))


def _mpp_arms(p: Column) -> Column:
    number = lambda k: F.get(p["numbers"], F.lit(NUMBER_KEYS.index(k)))
    positive = lambda *names: F.coalesce(*[F.when((number(k) > 0) & ~F.isnan(number(k)), number(k)) for k in names])
    x, y, aperio, power = positive(*X_KEYS), positive(*Y_KEYS), positive("aperio.mpp"), positive(*POWER_KEYS)
    texts = [F.get(p["texts"], F.lit(i)) for i in range(len(TEXT_KEYS))]
    per = F.lit(None).cast("double")
    for microns, names in UNITS.items():
        per = F.when(p["unit"].isin(*names), microns).otherwise(per)
    rx, ry = number("tiff.xresolution"), number("tiff.yresolution")
    rx, ry = F.coalesce(rx, ry), F.coalesce(ry, rx)
    return F.coalesce(
        F.when(F.coalesce(x, y).isNotNull(), _mpp(F.coalesce(x, y), F.coalesce(y, x), "openslide.mpp-x/y")),
        F.when(aperio.isNotNull(), _mpp(aperio, aperio, "aperio.MPP")),
        *[F.when(v > 0, _mpp(v, v, f"text:{k}")) for k, v in zip(TEXT_KEYS, texts)],
        F.when(per.isNotNull() & (rx > 0) & (ry > 0), _mpp(F.try_divide(per, rx), F.try_divide(per, ry), "tiff.resolution")),
        F.when(power.isNotNull(), _mpp(F.try_divide(F.lit(10.0), power), F.try_divide(F.lit(10.0), power), "objective-power-estimate")),
    )


def mpp_with_override(found: Column, override_x: Column, override_y: Column) -> Column:
    """An override wins; given for one axis it holds for both. Not positive: an error."""
    x, y = F.coalesce(override_x, override_y), F.coalesce(override_y, override_x)
    bad = F.raise_error(F.lit("mpp overrides must be positive")).cast(found_type := "struct<mpp_x: double, mpp_y: double, mpp_source: string>")
    return F.when(x.isNull(), found).when((x <= 0) | (y <= 0), bad).otherwise(_mpp(x, y, "config.override").cast(found_type))


def vendor(prop: Column, detected: Column, backend: Column) -> Column:
    return F.coalesce(prop, detected, F.when(backend == "ImageSlide", F.lit("generic-image")))


def bounds(x: Column, y: Column, w: Column, h: Column) -> Column:
    """A struct of ints, cut off toward zero, or null unless all four parse."""
    vals = [lenient_float(c) for c in (x, y, w, h)]
    whole = vals[0].isNotNull() & vals[1].isNotNull() & vals[2].isNotNull() & vals[3].isNotNull()
    return F.when(whole, F.struct(*[v.cast("int").alias(n) for v, n in zip(vals, ("x", "y", "width", "height"))]))


def background(value: Column) -> Column:
    """Struct r, g, b, a of six hex digits with or without ``#``; else white."""
    text = F.regexp_replace(F.coalesce(value, F.lit("")), "^#+", "")
    ok = text.rlike("^[0-9a-fA-F]{6}$")
    part = lambda i: F.when(ok, F.conv(F.substring(text, i, 2), 16, 10).cast("int")).otherwise(255)
    return F.struct(part(1).alias("r"), part(3).alias("g"), part(5).alias("b"), F.lit(255).alias("a"))


def format_bytes(n: Column) -> Column:
    """Two decimals (half to even) and a unit, B to TiB, by powers of 1024."""
    out = None
    for k, unit in enumerate(("B", "KiB", "MiB", "GiB")):
        text = F.format_string(f"%.2f {unit}", F.bround(n.cast("double") / float(1024**k), 2))
        out = F.when(n < 1024 ** (k + 1), text) if out is None else out.when(n < 1024 ** (k + 1), text)
    return out.otherwise(F.format_string("%.2f TiB", F.bround(n.cast("double") / float(1024**4), 2)))


def utc_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def env_bool(value: Column) -> Column:
    text = F.lower(F.trim(value))
    return F.when(text.isin("1", "true", "yes", "y", "on"), True).when(text.isin("0", "false", "no", "n", "off"), False)


def short_sha(value: Column) -> Column:
    return F.nullif(F.substring(F.trim(value), 1, 7), F.lit(""))


def run_id(stamp: Column, sha: Column, config_hash: Column) -> Column:
    return F.concat_ws("_", stamp, F.coalesce(sha, F.lit("nogit")), config_hash)


def output_kind(shape: Column) -> Column:
    """Kind of a model output by its shape."""
    n = F.size(shape)
    return (
        F.when((n == 4) & (F.get(shape, F.lit(1)) == 1), "binary_logits_1ch")
        .when((n == 4) & (F.get(shape, F.lit(1)) == 2), "binary_logits_2ch")
        .when(n == 3, "hw").otherwise("unknown")
    )

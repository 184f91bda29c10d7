"""Scalar expressions over names, scales and settings; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def usable_scale(c: str | Column) -> Column:
    """The scale if it is finite and above 0, else null; a missing calibration never falls back to pixels."""
    v = col(c)
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")) & (v > 0), v)


def object_type(name: str | Column) -> Column:
    """The first kind that the name mentions; else the name without its prefix and channel suffix; else `objects`."""
    low = F.lower(col(name))
    out = None
    for kind in ("cytoplasm", "nuclei", "cells", "spots", "foci", "bacteria"):  # fixed values, in this order
        out = (F if out is None else out).when(low.contains(kind), kind)
    rest = F.split_part(F.regexp_replace(low, "^labels_", ""), F.lit("_channel_"), F.lit(1))
    return out.otherwise(F.coalesce(F.nullif(rest, F.lit("")), F.lit("objects")))


def locations_only(name: str | Column, refined: str | Column, told: str | Column | None = None) -> Column:
    """Whether a label set holds mere places: what its statistics told, if all timepoints have them (see told_locations); else
    spot sets that weren't refined."""
    by_name = F.lower(col(name)).startswith("labels_spots_channel_") & ~col(refined)
    return by_name if told is None else F.coalesce(col(told), by_name)


def told_locations(points_only: str | Column) -> Column:
    """Over a label set's timepoints: whether any of them holds mere places; null if one doesn't say."""
    p = col(points_only)
    return F.when(F.count(p) == F.count(F.lit(1)), F.bool_or(p))


def safe_name(name: str | Column, index: str | Column) -> Column:
    """A group name of letters, digits, _ . and - only; `labels_<index>` if nothing is left."""
    clean = F.btrim(F.regexp_replace(col(name), "[^a-zA-Z0-9_.-]+", "_"), F.lit("_.-"))
    return F.coalesce(F.nullif(clean, F.lit("")), F.concat(F.lit("labels_"), col(index).cast("string")))


def unique_names(names: str | Column) -> Column:
    """Safe names of an ordered array made unique: a taken name gets _2, _3 and so on, tried anew against all taken so far."""
    n = col(names)

    def step(taken: Column, item: Column) -> Column:
        base = item["base"]
        tries = F.transform(F.sequence(F.lit(1), F.size(taken) + 1), lambda k: F.when(k == 1, base).otherwise(F.concat(base, F.lit("_"), k.cast("string"))))
        return F.concat(taken, F.slice(F.filter(tries, lambda x: ~F.array_contains(taken, x)), 1, 1))

    items = F.transform(n, lambda x, i: F.struct(safe_name(x, i + 1).alias("base")))
    return F.aggregate(items, F.array().cast("array<string>"), step)


def label_color(name: str | Column, index: str | Column) -> Column:
    """A label's colour by what its name mentions, else by its index."""
    low, i = F.lower(col(name)), col(index)
    spots, rest = ("FFFF00", "00FFFF", "FF8000", "FF0000"), ("00FF00", "0000FF", "FF00FF", "FFFF00", "00FFFF", "FF8000", "FF0000")  # fixed values
    pick = lambda p: F.element_at(F.array(*map(F.lit, p)), (i % len(p) + 1).cast("int"))
    return F.when(low.contains("cytoplasm"), "FF00FF").when(low.contains("nucle"), "0000FF").when(low.contains("cell"), "00FF00").when(low.contains("spot") | low.contains("foci"), pick(spots)).otherwise(pick(rest))


def signed_color(color: str | Column) -> Column:
    """An opaque colour as a signed 32-bit RGBA number."""
    v = F.conv(col(color), 16, 10).cast("long") * 256 + 255
    return F.when(v >= 2**31, v - 2**32).otherwise(v)


# The types that an image document knows, and its namespace.
XML_TYPES = {"uint8": "uint8", "int8": "int8", "uint16": "uint16", "int16": "int16", "uint32": "uint32", "int32": "int32", "float32": "float", "float64": "double"}
XML_SPACE = "http://www.openmicroscopy.org/Schemas/OME/2016-06"


def escaped(text: str | Column) -> Column:
    """Text as it may stand in an XML attribute."""
    out = col(text)
    for letter, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):  # fixed values, & first
        out = F.replace(out, F.lit(letter), F.lit(entity))
    return out


def element(name: str, attributes: dict[str, str | Column], *inside: Column) -> Column:
    """An XML element of text columns; plain strings are texts."""
    told = [F.concat(F.lit(f' {k}="'), F.lit(v) if isinstance(v, str) else escaped(v.cast("string")), F.lit('"')) for k, v in attributes.items()]
    if not inside:
        return F.concat(F.lit(f"<{name}"), *told, F.lit("/>"))
    return F.concat(F.lit(f"<{name}"), *told, F.lit(">"), *inside, F.lit(f"</{name}>"))


def image_document(name: Column, dtype: Column, size: dict[str, Column], scales: dict[str, Column], channels: Column) -> Column:
    """An image's XML document: its type, sides (t, c, z, y, x), scales (z, y, x; 1.0 where there is none) and channels
    (array<struct<label, color>>); a type that the format doesn't know is an error."""
    known = F.create_map(*(F.lit(x) for pair in XML_TYPES.items() for x in pair))
    kind = F.coalesce(F.try_element_at(known, dtype), F.raise_error(F.concat(F.lit("no image document for type "), dtype)).cast("string"))
    one = lambda c, i: element("Channel", {"ID": F.concat(F.lit("Channel:0:"), i.cast("string")), "Name": c["label"], "Color": signed_color(c["color"]), "SamplesPerPixel": "1"})
    sides = {f"Size{a.upper()}": size[a] for a in "xyzct"} | {f"PhysicalSize{a.upper()}": F.coalesce(scales[a], F.lit(1.0)) for a in "xyz"}
    pixels = element("Pixels", {"ID": "Pixels:0", "DimensionOrder": "XYZCT", "Type": kind, **sides}, F.array_join(F.transform(channels, one), ""))
    return F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n'), element("OME", {"xmlns": XML_SPACE}, element("Image", {"ID": "Image:0", "Name": name}, pixels)))


def diameter_px(diameter_um: str | Column, mean_scale: str | Column, nuclei: str | Column) -> Column:
    """Pixels of a diameter: null below 0; at 0 the default of the target."""
    d = col(diameter_um)
    return F.when(d < 0, F.lit(None).cast("double")).otherwise(F.when(d == 0, F.when(col(nuclei), 12.0).otherwise(25.0)).otherwise(d) / col(mean_scale))


def distance_px(distance_um: str | Column, mean_scale: str | Column) -> Column:
    """Whole pixels of a least distance, one at least, halves to even."""
    return F.greatest(F.lit(1), F.rint(col(distance_um) / col(mean_scale)).cast("int"))


def truth(value: str | Column) -> Column:
    return F.lower(col(value)).isin("1", "true", "yes", "on")


def name_list(value: str | Column) -> Column:
    """A list given as a JSON array or as text separated by , or ;."""
    v = col(value)
    parts = F.coalesce(F.when(F.ltrim(v).startswith("["), F.from_json(v, "array<string>")), F.split(v, "[,;]"))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def expansion_channel(cyto: str | Column, nuclei: str | Column) -> Column:
    return F.when(col(nuclei) > 1, col(nuclei)).otherwise(col(cyto))


def label_path(native: str | Column, prefix: str | Column, group: str | Column, resource: str | Column, channel: str | Column) -> Column:
    """Where a label set lies: its group in the native layout, else a channel of the image."""
    home = F.coalesce(F.nullif(col(resource), F.lit("")), F.lit("/"))
    return F.when(col(native), F.concat(col(prefix), F.lit("labels/"), col(group))).otherwise(F.concat(home, F.lit(":channel:"), col(channel).cast("string")))


def database_name(source: str | Column, form: str | Column) -> Column:
    """The measurement database's name; an unknown format is an error."""
    f = col(form)
    ending = F.when(f.isin("duckdb", "sqlite"), f).otherwise(F.raise_error(F.concat(F.lit("unknown database format: "), f)))
    return F.concat(col(source), F.lit("_multistep_measurements."), ending)


def canonical_number(value: str | Column) -> Column:
    """A number as it stands in a cache key: not-a-number and infinities as words."""
    v = col(value)
    return F.when(F.isnan(v), "nan").when(v == float("inf"), "inf").when(v == float("-inf"), "-inf").otherwise(v.cast("string"))


def cache_key(parts: dict[str, str | Column]) -> Column:
    """A digest of named values in order of their names, the same for equal values of any spelling: numbers in canonical form,
    maps by their sorted keys, null as itself."""
    return F.sha2(F.to_json(F.struct(*(col(c).alias(n) for n, c in sorted(parts.items()))), {"ignoreNullFields": "false"}), 256)


def canonical_map(values: str | Column) -> Column:
    """A map of numbers as an array of (key, number) in order of the keys, numbers in canonical form."""
    return F.transform(F.array_sort(F.map_entries(col(values))), lambda e: F.struct(e["key"].alias("key"), canonical_number(e["value"]).alias("value")))


def fingerprint(files: DataFrame) -> DataFrame:
    """(bundle, path, content) -> (bundle, source_id): a digest over each bundle's files, each as its path, a zero byte and its
    bytes, in the order of their paths. Files are a bundle's sources: small enough to stand in a row."""
    one = F.concat(F.encode("path", "utf-8"), F.lit(b"\x00"), F.col("content").cast("binary"))
    ordered = files.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("path", one.alias("bytes")))).alias("files"))
    whole = F.aggregate("files", F.lit(b""), lambda all_, f: F.concat(all_, f["bytes"]))
    return ordered.select("bundle", F.concat(F.lit("sha256:"), F.sha2(whole, 256)).alias("source_id"))


# What two manifests of an image are compared by.
MANIFEST_KEYS = ["manifest_version", "docker_image_id", "descriptor_sha256", "git_commit", "image_tag"]


def same_manifest(current: str, remote: str, keys: list[str] | None = None) -> Column:
    """Whether two manifests (struct columns) agree on all keys; what both lack is equal, and no remote one equals none."""
    out = F.col(remote).isNotNull()
    for k in keys or MANIFEST_KEYS:
        out = out & F.col(f"{current}.{k}").eqNullSafe(F.col(f"{remote}.{k}"))
    return out


# What stands before a short secret.
SECRET_PLACES = [r"OMERO_(?:ROOT_)?PASSWORD=", r"\s-w\s+"]


def redacted(text: str | Column, secrets: list[str]) -> Column:
    """The text without the secrets, in their order; those of 5 letters and digits at most go in known places only."""
    out = col(text)
    for s in filter(None, secrets):
        if len(s) <= 5 and s.isalnum():
            for place in SECRET_PLACES:
                out = F.regexp_replace(out, rf"(?i)({place}){s}\b", "$1<redacted>")
        else:
            out = F.replace(out, F.lit(s), F.lit("<redacted>"))
    return out


def exact_int(value: str | Column) -> Column:
    """A pixel as a 32-bit integer: halves to even; what isn't finite or doesn't fit is an error."""
    v = col(value)
    rounded = F.rint(v)
    checked = F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.raise_error(F.lit("pixel isn't finite"))).when((rounded < -(2**31)) | (rounded > 2**31 - 1), F.raise_error(F.lit("pixel exceeds 32 bits"))).otherwise(rounded)
    return checked.cast("int")


def rescaled_size(size: str | Column, scale_um: str | Column, target_um: float = 0.5) -> Column:
    """Pixels of a side brought to the target's pixel size; never more than there are, one at least, halves to even."""
    factor = F.least(F.lit(1.0), col(scale_um) / target_um)
    return F.greatest(F.lit(1), F.rint(col(size) * factor).cast("int"))


def selected_channels(primary: str | Column, nuclei: str | Column, count: str | Column) -> Column:
    """Zero-based channels of a model: the primary, and the nuclei's if it is another; one outside the image is an error."""
    p, n = col(primary), col(nuclei)
    chosen = F.when((n > 0) & (n != p), F.array(p - 1, n - 1)).otherwise(F.array(p - 1))
    return F.when(F.forall(chosen, lambda c: (c >= 0) & (c < col(count))), chosen).otherwise(F.raise_error(F.lit("channel outside the image")).cast("array<int>"))

"""Path strings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_path(path: Column) -> Column:
    """Collapse empty, '.' and '..' parts; an empty path is '.'."""
    absolute = path.startswith("/")
    no_part = F.array().cast("array<string>")

    def step(acc, p):
        up = (F.size(acc) > 0) & (F.element_at(acc, -1) != "..")
        return (F.when((p == "") | (p == "."), acc)
                .when((p == "..") & F.coalesce(up, F.lit(False)), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                .when((p == "..") & absolute, acc)
                .otherwise(F.array_append(acc, p)))
    joined = F.array_join(F.aggregate(F.split(path, "/"), no_part, step), "/")
    return F.when(absolute, F.concat(F.lit("/"), joined)).when(joined == "", F.lit(".")).otherwise(joined)


def fill_template(path: Column, values: dict[str, str | Column]) -> Column:
    """Replace every ``{name}`` tag; a tag without a value is an error."""
    for name, v in values.items():
        path = F.replace(path, F.lit("{" + name + "}"), v if isinstance(v, Column) else F.lit(v))
    return F.when(path.rlike(r"\{\w+\}"), F.raise_error(F.concat(F.lit("unknown path tag: "), path))).otherwise(path)


def dirname(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    return F.regexp_extract(basename(path), r"^\.*[^.].*(\.[^.]*)$", 1)


def stem(path: Column) -> Column:
    """Base name without its extension."""
    return F.left(basename(path), F.length(basename(path)) - F.length(extension(path)))


def without_extension(path: Column) -> Column:
    return F.left(path, F.length(path) - F.length(extension(path)))


def common_depth(*dirs: str) -> int:
    """Number of leading directories that all given folders share."""
    parts = [d.split("/") for d in dirs if d]
    depth = 0
    while all(len(p) > depth for p in parts) and len({p[depth] for p in parts}) == 1:
        depth += 1
    return depth


def tag_path(path: Column, root_depth: int, class_depth: int, root_tag: str, class_tag: str) -> Column:
    """Replace the first ``root_depth`` directories by ``{root_tag}`` and the next ``class_depth`` by
    ``{class_tag}``."""
    if root_depth == 0:
        return path
    tags = ["{" + root_tag + "}"] + (["{" + class_tag + "}"] if class_depth else [])
    rest = F.slice(F.split(path, "/"), root_depth + class_depth + 1, F.lit(1 << 20))
    return F.array_join(F.concat(F.array(*[F.lit(t) for t in tags]), rest), "/")


def target_name(source: Column, target: Column, converting: bool) -> Column:
    """Base name of a collected image: the given target name (with '.tif' when converting, else the source
    extension, if it has none) or the source name. A converted target must be '.tif' or '.tiff'."""
    ext = F.lit(".tif") if converting else extension(source)
    name = (F.when(target.isNull(), F.concat(stem(source), ext))
            .when(extension(target) != "", target).otherwise(F.concat(target, ext)))
    if not converting:
        return name
    bad = target.isNotNull() & ~F.lower(extension(name)).isin(".tif", ".tiff")
    return F.when(bad, F.raise_error(F.concat(F.lit("invalid extension for conversion: "), target))).otherwise(name)


def hex_colour(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("#%02X%02X%02X", r, g, b)


def parse_hex(colour: Column) -> list[Column]:
    return [F.conv(F.substring(colour, i, 2), 16, 10).cast("int").alias(c) for i, c in ((2, "r"), (4, "g"), (6, "b"))]

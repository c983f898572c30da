"""String functions on names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
IMAGE_TYPES = ("jpg", "jpeg", "png", "bmp", "webp")
TRUE_LABELS = ("1", "smoking", "smoke", "yes", "true", "positive")


def name_key(name: Column) -> Column:
    """Trimmed, lower case, white space collapsed."""
    return F.regexp_replace(F.lower(F.trim(name)), r"\s+", " ")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def photo_stem(path: Column) -> Column:
    """The base name before ``.rf.``, else without its last suffix."""
    name = base_name(path)
    return F.when(F.instr(name, ".rf.") > 0, F.substring_index(name, ".rf.", 1)).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))


def label_path(path: Column) -> Column:
    """The label file of an image: the last ``images`` folder becomes ``labels``, the suffix ``.txt``."""
    moved = F.regexp_replace(path, "^(.*/)images/", "$1labels/")
    return F.concat(F.regexp_replace(moved, r"(?<=[^/])\.[^./]*$", ""), F.lit(".txt"))


def is_image(path: Column) -> Column:
    return F.lower(F.substring_index(path, ".", -1)).isin(*IMAGE_TYPES)


def safe_name(name: Column, most: int = 40) -> Column:
    """A folder's name: runs of other characters than letters and digits become one underscore; cut to ``most``."""
    return F.left(F.regexp_replace(name, r"[^A-Za-z0-9]+", "_"), F.lit(most))


def clip_name(path: Column) -> Column:
    """A clip's name in file names: its stem, in which runs of other characters than letters, digits, _ and - become one underscore."""
    stem = F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")
    return F.regexp_replace(stem, r"[^A-Za-z0-9_-]+", "_")


def is_positive(label: Column) -> Column:
    return F.lower(F.trim(label)).isin(*TRUE_LABELS)


def hash_hex(h: Column) -> Column:
    """64 bits as 16 hexadecimal digits."""
    return F.lpad(F.lower(F.hex(h)), 16, "0")


def hash_bits(text: Column) -> Column:
    """16 hexadecimal digits as a signed 64-bit integer; null for anything else."""
    return F.when(text.rlike("^[0-9a-fA-F]{16}$"), F.conv(text, 16, -10).cast("bigint"))


def seeded(key: Column, seed: int) -> Column:
    """A shuffle key that any engine can compute."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))

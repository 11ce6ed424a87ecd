"""Columns that bring unevenly spelled references to items, classes, sources and splits to one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The target classes in id order, the split vocabulary in order, image suffixes.
CLASSES = ("plastic", "paper", "cardboard", "metal", "glass", "organic")
SPLITS = ("train", "val", "test", "clean_test", "wild_test")
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "webp")

_FOLDER = "^(?:" + "|".join((*CLASSES, "wilderness")) + ")__"
_SUFFIX = r"\.(?:" + "|".join((*IMAGE_SUFFIXES, "txt")) + ")$"
#: Blanks that a name may have gained or lost.
_BLANKS = " \t\n\r\f\u00a0"


def unescaped(name: Column) -> Column:
    """Percent escapes decoded; a malformed escape leaves the text as it is."""
    decoded = F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), F.coalesce(decoded, name)).otherwise(name)


def item_ident(name: Column) -> Column:
    """``<source>__<name>`` in lower case without blanks, folders, class and suffix; NULL for NULL or nothing left.

    Case, blanks, path prefix, separators and suffix carry no meaning in a reference to an item,
    so two references name the same item exactly when this value is equal.
    """
    # translate() turns backslashes into slashes and deletes blanks. Every step refers to the one before once: nothing is evaluated twice.
    last = F.substring_index(F.translate(F.lower(unescaped(name)), "\\" + _BLANKS, "/"), "/", -1)
    return F.nullif(F.regexp_replace(F.regexp_replace(last, _SUFFIX, ""), _FOLDER, ""), F.lit(""))


def class_of_key(key: Column) -> Column:
    """The class folder of a canonical key."""
    return F.lower(F.trim(F.substring_index(key, "/", 1)))


def source_of_ident(ident: Column) -> Column:
    return F.substring_index(ident, "__", 1)


def plain_name(name: Column, joint: str = "-") -> Column:
    """Lower case, outer blanks gone, inner blanks and underscores as ``joint``; NULL for NULL or blank."""
    return F.nullif(F.regexp_replace(F.trim(F.lower(name)), r"[\s_\-]+", joint), F.lit(""))


def split_name(name: Column) -> Column:
    return plain_name(name, "_")


# Words that stand for "no label".
NO_LABEL = ("", "-", "nan", "none", "n/a", "null", "na", "nil", "unknown", "?", "--", "#n/a", "tbd")


def has_label(label: Column) -> Column:
    """True for a real label path; NULL, blank and filler words are none."""
    return label.isNotNull() & ~F.trim(F.lower(label)).isin(*NO_LABEL)

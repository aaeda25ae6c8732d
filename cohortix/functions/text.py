"""Identifiers, escapes and formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitized(value: Column) -> Column:
    """Other characters than letters, digits, '_', '.' and '-' become one '_'; '.' and '_' are trimmed; 'item' if nothing is left."""
    kept = F.regexp_replace(F.regexp_replace(value, "[^A-Za-z0-9_.-]+", "_"), "^[._]+|[._]+$", "")
    return F.when(kept == "", F.lit("item")).otherwise(kept)


def track_id(video_id: Column, raw: Column) -> Column:
    """<video>_track_<number with four digits>; another raw id is sanitized."""
    n = F.trim(raw.cast("string")).try_cast("long")
    return F.concat(video_id, F.lit("_track_"), F.when(n.isNotNull(), F.format_string("%04d", n)).otherwise(sanitized(raw.cast("string"))))


def person_id(n: Column) -> Column:
    return F.format_string("P%04d", n)


def person_number(name: Column) -> Column:
    """The number of a valid id, else null."""
    return F.when(name.rlike("^P[0-9]+$"), F.substring(name, 2, 18).try_cast("long"))


def html_escaped(value: Column) -> Column:
    out = F.replace(value, F.lit("&"), F.lit("&amp;"))
    for raw, name in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(name))
    return out


def truth(value: Column) -> Column:
    """Boolean written as text; null for anything else."""
    word = F.lower(F.trim(value))
    return F.when(word.isin("1", "true", "yes", "y", "on"), F.lit(True)).when(word.isin("0", "false", "no", "n", "off"), F.lit(False))


def seconds(value: Column) -> Column:
    return F.format_string("%.1fs", value)


def posix_path(path: Column, root: Column) -> Column:
    """The path with '/' and relative to the root if it lies below it."""
    plain = F.replace(path, F.lit("\\"), F.lit("/"))
    base = F.concat(F.regexp_replace(F.replace(root, F.lit("\\"), F.lit("/")), "/+$", ""), F.lit("/"))
    return F.when(F.startswith(plain, base), F.substring(plain, F.length(base) + 1, F.length(plain))).otherwise(plain)


def content_name(digest: Column, length: int = 6) -> Column:
    """V_ and the first digits of an upper-case SHA-1."""
    return F.concat(F.lit("V_"), F.substring(F.upper(digest), 1, length))

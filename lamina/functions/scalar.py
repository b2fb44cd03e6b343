"""Column expressions: cleaning, identifiers, dates, paths and fingerprints. All stay on the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File suffixes by type, tested in this order; images with room for metadata.
WITH_METADATA = ["jpg", "jpeg", "tiff", "tif", "cr2", "nef", "arw", "dng", "orf", "rw2", "raw"]
SUFFIXES = {
    "image": [*WITH_METADATA, "png", "gif", "bmp", "svg", "ico", "webp", "psd", "ai", "eps"],
    "text": ["txt", "pdf", "doc", "docx", "odt", "rtf", "md", "markdown", "tex", "csv", "html", "htm", "xml", "json", "yaml", "yml"],
    "spreadsheet": ["xlsx", "xls", "ods", "csv"],
    "database": ["accdb", "mdb", "sqlite", "db"],
    "compressed": ["zip", "rar", "7z", "tar", "gz", "bz2", "xz", "tgz"],
    "video": ["mp4", "avi", "mov", "wmv", "mkv", "flv", "webm", "m4v"],
}


def clean(c: Column, extra: tuple[str, ...] = ()) -> Column:
    """Trimmed text; empty text and 'nan' in any case (and `extra`) are null."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin("", "nan", *extra), t)


def safe_year(c: Column) -> Column:
    """A year from 1800 to 2100 out of text such as '2009' or '2009.0', else null."""
    y = c.cast("string").try_cast("double").cast("int")
    return F.when(y.between(1800, 2100), y)


def digits(c: Column) -> Column:
    """All digits of a text, or the text if it has none."""
    return F.coalesce(F.nullif(F.regexp_replace(c, r"[^0-9]", ""), F.lit("")), c)


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def normalize_id(c: Column) -> Column:
    """PREFIX-NUMBER[-plate] of an identifier, null if there is no number."""
    p = r"^\s*([A-Za-z][A-Za-z-]*?)[\s_#-]*([0-9]{1,10})[\s_-]*([A-Za-z]{0,2})\s*$"
    return F.when(extract(c, p, 2).isNotNull(), F.concat_ws("-", F.upper(extract(c, p, 1)), extract(c, p, 2), F.lower(extract(c, p, 3))))


def bare_id(c: Column) -> Column:
    """An identifier in small letters without separators; nothing for null."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\-_]+", ""))


def sanitize(c: Column) -> Column:
    """A text as a file name: other than letters, digits, _ and - become one _, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_\-]+", "_"), r"^_+|_+$|(_)_+", "$1")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"[/\\][^/\\]*$", "")


def segments(path: Column) -> Column:
    return F.filter(F.split(path, r"[/\\]"), lambda x: x != "")


def file_type(name: Column) -> Column:
    suffix = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    out = F.when(suffix == "", "unknown")
    for kind, endings in SUFFIXES.items():
        out = out.when(suffix.isin(endings), kind)
    return out.otherwise("other")


def supports_metadata(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1)).isin(WITH_METADATA)


def years(c: Column) -> Column:
    """Runs of exactly four digits that are years from 1900 to 2029."""
    return F.filter(F.regexp_extract_all(c, F.lit(r"[0-9]+"), F.lit(0)), lambda x: x.rlike(r"^(19[0-9]{2}|20[0-2][0-9])$"))


def human_size(c: Column) -> Column:
    kb, mb = c / 1024, c / 1048576
    return F.when(c < 1024, F.format_string("%d B", c)).when(kb < 1024, F.format_string("%.1f KB", kb)).otherwise(F.format_string("%.1f MB", mb))


def merge_lists(*lists: Column) -> Column:
    """Order-preserving union of '; '-joined lists without blanks."""
    parts = [F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), ";"), lambda v: F.trim(v)), lambda v: ~F.lower(v).isin("", "nan")) for x in lists]
    return F.array_join(F.array_distinct(F.concat(*parts)), "; ")


def halves(hex16: Column) -> tuple[Column, Column]:
    """A 16-digit hexadecimal number as two 32-bit halves; null if malformed."""
    ok = hex16.rlike("^[0-9a-fA-F]{16}$")
    part = lambda at: F.when(ok, F.conv(F.substring(hex16, at, 8), 16, 10).cast("bigint"))
    return part(1), part(9)


def hamming(a: Column, b: Column) -> Column:
    """Bits in which two 64-bit hexadecimal hashes differ; -1 if one is malformed."""
    (ah, al), (bh, bl) = halves(a), halves(b)
    return F.coalesce(F.bit_count(ah.bitwiseXOR(bh)) + F.bit_count(al.bitwiseXOR(bl)), F.lit(-1))


def bits_to_hex(bits: list[Column]) -> Column:
    """Hexadecimal digits of 64 bits, the first being the highest."""
    half = lambda b: reduce(lambda x, y: x * 2 + y, b, F.lit(0).cast("bigint"))
    return F.concat(*[F.lpad(F.lower(F.hex(half(bits[i : i + 32]))), 8, "0") for i in (0, 32)])


def first_priority(values: dict[str, Column], order: list[str]) -> Column:
    """The value of the first source in `order` that has one."""
    return F.coalesce(*[clean(values[s]) for s in order])


def conflicting(values: list[Column]) -> Column:
    return F.size(F.array_distinct(F.filter(F.array(*[clean(v) for v in values]), lambda x: x.isNotNull()))) > 1


def compare_field(value: Column, others: Column) -> Column:
    """A value against an array: none, empty, match, partial (one holds the other) or mismatch; by the first of the array that tells."""
    v = F.lower(clean(value))
    rest = F.filter(F.transform(others, lambda x: F.lower(clean(x))), lambda x: x.isNotNull())
    verdict = F.transform(rest, lambda x: F.when(x == v, "match").when(x.contains(v) | v.contains(x), "partial"))
    told = F.get(F.filter(verdict, lambda x: x.isNotNull()), F.lit(0))
    return F.when(F.coalesce(F.size(rest), F.lit(0)) == 0, "none").when(v.isNull(), "empty").otherwise(F.coalesce(told, F.lit("mismatch")))

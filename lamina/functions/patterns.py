"""Identifiers, dates, taxa and campaigns out of file paths, as column expressions.

Paths may use either slash. What a pattern needs to know (prefixes, taxa, camera
names) is a parameter, by default the fixed values below.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.functions.scalar import base_name, extract, segments

#: Collections with their code, specimen prefixes and words in paths, in the order in which they are tried.
COLLECTIONS = [
    ("LH", ["LH", "MCLM", "MCLM-LH", "MCCM", "MCCMLH", "MCCM-LH", "ADR", "PB"], ["las hoyas", "lashoyas", "hoyas", "colección lh"]),
    ("BUE", ["K-BUE", "CER-BUE"], ["buenache", "bue", "cantera"]),
    ("MON", [], ["montsec", "monset"]),
]
PREFIXES = [p for _, prefixes, _ in COLLECTIONS for p in prefixes]
#: Names that cameras give, and the patterns of their numbers.
CAMERAS = ["IMG", "DSC", "DSCF", "DSCN", "DCIM", "DJI", "MG", "PA", "PC"]
CAMERA_NUMBERS = [r"DSC[-_]?[0-9]+", r"_DSC[-_]?[0-9]+", r"DSCN[-_]?[0-9]+", r"IMG[-_]?[0-9]+", r"DSCF[-_]?[0-9]+", r"DCIM[-_]?[0-9]+", r"P[A1][0-9]{6,}", r"PC[0-9]{6,}", r"_MG[-_]?[0-9]+", r"DJI[-_]?[0-9]+"]
#: Taxa by level, and words that announce a campaign.
TAXA = {
    "phylum": ["Arthropoda", "Mollusca", "Chordata", "Echinodermata", "Bryozoa", "Brachiopoda"],
    "class": ["Insecta", "Arachnida", "Crustacea", "Trilobita", "Gastropoda", "Bivalvia", "Cephalopoda", "Mammalia", "Reptilia", "Amphibia", "Osteichthyes", "Chondrichthyes"],
    "order": ["Coleoptera", "Lepidoptera", "Hymenoptera", "Diptera", "Hemiptera", "Orthoptera", "Odonata", "Neuroptera", "Trichoptera", "Phasmatodea", "Decapoda", "Isopoda", "Ammonoidea", "Nautiloidea"],
}
CAMPAIGN = ["campaign", "campaña", "año", "year", "temporada", "season"]
#: Classes by macroclass.
MACROCLASSES = {
    "Botany": ["Angiosperma", "Bennettitales", "Bryophyta", "Charophyceae", "Equisetopsida", "Eudicotyledoneae", "Marchantiopsida", "Pinales", "Pinopsida", "Planta", "Pteridophyta", "Pterophyta"],
    "Insects": ["Coleoptera", "Insecta"],
    "Arthropoda": ["Arachnida", "Branchiopoda", "Crustacea", "Diplopoda", "Heteropoda", "Malacostraca", "Ostracoda"],
    "Mollusca": ["Bivalvia", "Gastropoda", "Mollusca"],
    "Vermes": ["Clitellata", "Nematoda"],
    "Pisces": ["Actinopterygii", "Chondrichthyes", "Lepisosteiforme", "Osteichthyes", "Pycnodontiform", "Sarcopterygii"],
    "Tetrapoda": ["Amphibia", "Aves", "Mammalia", "Reptilia", "Sauropsida", "Tetrapoda", "Testudines", "Vertebrata"],
    "Ichnofossils": ["Coprolitos", "icnofósil", "icnofósiles"],
}
TAIL = r"\s*[-_]?\s*([0-9]{3,8})\s*[-_]?\s*([aAbB]{1,2})?"
LOOSE = r"(?i)([A-Z]{2,4})" + TAIL
NUMBER = r"(?:^|[^0-9])([0-9]{3,8})(?:\s*[-_]?\s*([aAbB]{1,2}))?(?:[^0-9]|$)"
CAMERA_NAME = r"(?i)^(?:" + "|".join(sorted(CAMERAS, key=len, reverse=True)) + r")[0-9]+"


def strict(prefixes: list[str]) -> str:
    """A known prefix, the longest first, then 3 to 8 digits and perhaps a plate."""
    return r"(?i)(" + "|".join(sorted(prefixes, key=len, reverse=True)) + ")" + TAIL


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(.)\.[^.]+$", "$1")


def _found(text: Column, pattern: str, where: str, base: float, known: list[str]) -> Column:
    """The first match as a struct; null without one, for a camera's prefix, and in a folder for a year."""
    prefix, number, plate = F.upper(extract(text, pattern, 1)), extract(text, pattern, 2), F.lower(extract(text, pattern, 3))
    ok = number.isNotNull() & ~prefix.isin(CAMERAS)
    if where == "path":
        ok &= ~((F.length(number) == 4) & number.cast("int").between(1980, 2026))
    sure = F.lit(base) + F.when(prefix.isin(known), 0.1).otherwise(0.0)
    sure = F.round(F.when(plate.isNotNull(), F.least(F.lit(1.0), sure + 0.05)).otherwise(sure), 2)
    return F.when(ok, _specimen(prefix, number, plate, sure, where))


def _specimen(prefix: Column, number: Column, plate: Column, sure: Column, where: str) -> Column:
    return F.struct(F.concat_ws("-", prefix, number, plate).alias("specimen_id"), prefix.alias("prefix"), number.alias("number"), plate.alias("plate"), sure.alias("confidence"), F.lit(where).alias("found_in"))


def prefix_in_path(path: Column, prefixes: list[str] = PREFIXES) -> Column:
    """The first part of a path that holds a prefix anywhere gives it; the longest counts, then the first by name."""
    order = sorted({p.upper() for p in prefixes}, key=lambda p: (-len(p), p))
    held = lambda x: F.coalesce(*[F.when(F.upper(x).contains(p), p) for p in order])
    return F.get(F.filter(F.transform(segments(path), held), lambda x: x.isNotNull()), F.lit(0))


def specimen(path: Column, prefixes: list[str] = PREFIXES) -> Column:
    """Specimen of a path: file name, then its folders from the deepest, then a bare number under a folder with a prefix."""
    known = [p.upper() for p in prefixes]
    name, parts = stem(path), segments(path)
    named = _found(name, strict(known), "filename", 0.9, known)
    loosely = F.when(F.upper(extract(name, LOOSE, 1)).isin(known), _found(name, LOOSE, "filename", 0.7, known))
    folders = F.reverse(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))
    foldered = F.get(F.filter(F.transform(folders, lambda x: _found(x, strict(known), "path", 0.9, known)), lambda x: x.isNotNull()), F.lit(0))
    prefix, number, plate = prefix_in_path(path, prefixes), extract(name, NUMBER, 1), F.lower(extract(name, NUMBER, 2))
    ok = ~name.rlike(CAMERA_NAME) & prefix.isNotNull() & number.isNotNull() & ~((F.length(number) == 4) & number.cast("int").between(1980, 2026))
    return F.coalesce(named, loosely, foldered, F.when(ok, _specimen(prefix, number, plate, F.lit(0.6), "filename")))


def camera_numbers(name: Column) -> Column:
    """The last number of each match of a camera's pattern."""
    hits = F.regexp_extract_all(name, F.lit("(?i)" + "|".join(CAMERA_NUMBERS)), F.lit(0))
    return F.transform(hits, lambda x: F.element_at(F.regexp_extract_all(x, F.lit("[0-9]+"), F.lit(0)), -1))


def other_numbers(name: Column) -> Column:
    """Runs of four and more digits that no camera's match holds."""
    hits = F.regexp_extract_all(name, F.lit("(?i)" + "|".join(CAMERA_NUMBERS)), F.lit(0))
    runs = F.filter(F.regexp_extract_all(name, F.lit("[0-9]+"), F.lit(0)), lambda x: F.length(x) >= 4)
    return F.filter(runs, lambda x: ~F.exists(hits, lambda h: h.contains(x)))


def _dates_in(text: Column) -> Column:
    month, day = "(0[1-9]|1[0-2])", "(0[1-9]|[12][0-9]|3[01])"
    date = lambda y, m, d: F.struct(y.cast("int").alias("year"), m.cast("int").alias("month"), d.cast("int").alias("day"))
    none = F.lit(None).cast("int")
    runs = F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))
    at = lambda x, a, n: F.substring(x, a, n)
    whole = F.transform(F.filter(runs, lambda x: x.rlike(f"^20[0-9]{{2}}{month}{day}$")), lambda x: date(at(x, 1, 4), at(x, 5, 2), at(x, 7, 2)))
    ymd = F.transform(F.regexp_extract_all(text, F.lit(f"20[0-9]{{2}}[-/]{month}[-/]{day}(?![0-9])"), F.lit(0)), lambda x: date(at(x, 1, 4), at(x, 6, 2), at(x, 9, 2)))
    dmy = F.transform(F.regexp_extract_all(text, F.lit(f"{day}[-/]{month}[-/]20[0-9]{{2}}"), F.lit(0)), lambda x: date(at(x, 7, 4), at(x, 4, 2), at(x, 1, 2)))
    year = F.transform(F.filter(runs, lambda x: x.rlike("^20[012][0-9]$")), lambda x: date(x, none, none))
    told = F.transform(F.regexp_extract_all(text, F.lit(r"(?i)(?:campaign|año|year|temporada)[-_\s]*(20[012][0-9])"), F.lit(1)), lambda x: date(x, none, none))
    return F.concat(whole, ymd, dmy, year, told)


def dates(path: Column) -> Column:
    """Distinct dates (year, month, day) of the file name, then of its folders."""
    parts = segments(path)
    folders = F.flatten(F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), _dates_in))
    return F.array_distinct(F.concat(_dates_in(stem(path)), folders))


def best_date(found: Column) -> Column:
    """The first of the fullest dates."""
    full, months = F.filter(found, lambda d: d["day"].isNotNull()), F.filter(found, lambda d: d["month"].isNotNull())
    return F.coalesce(F.get(full, F.lit(0)), F.get(months, F.lit(0)), F.get(found, F.lit(0)))


def partial_date(date: Column) -> Column:
    """YYYYMMDD, YYYYMM or YYYY."""
    two = lambda n: F.lpad(date[n].cast("string"), 2, "0")
    return F.concat(date["year"].cast("string"), F.coalesce(two("month"), F.lit("")), F.when(date["month"].isNotNull(), F.coalesce(two("day"), F.lit(""))).otherwise(""))


def taxa(path: Column, names: dict[str, list[str]] = TAXA) -> Column:
    """(level, value) of the parts of a path that are known taxa, or families by their ending."""

    def of_part(x: Column) -> Column:
        level = reduce(lambda w, kv: w.when(F.lower(x).isin([n.lower() for n in kv[1]]), kv[0]), names.items(), F.when(F.lit(False), ""))
        hint = lambda c: F.struct(c.alias("level"), x.alias("value"))
        return F.concat(F.when(level.isNotNull(), F.array(hint(level))).otherwise(F.array()), F.when(x.rlike("(idae|IDAE)$"), F.array(hint(F.lit("family")))).otherwise(F.array()))

    return F.flatten(F.transform(segments(path), of_part))


def campaign(path: Column) -> Column:
    """Year of the first part of a path that names a campaign, or is a year from 2000 to 2029."""

    def of_part(x: Column) -> Column:
        told = reduce(lambda a, b: a | b, [F.lower(x).contains(w) for w in CAMPAIGN])
        return F.coalesce(F.when(told, extract(x, "(20[012][0-9])")), extract(x, "^(20[012][0-9])$")).cast("int")

    return F.get(F.filter(F.transform(segments(path), of_part), lambda y: y.isNotNull()), F.lit(0))


def collection(path: Column, prefix: Column | None = None) -> Column:
    """Code of the collection: by prefix, else by the first word that the path holds."""
    by_prefix = [F.when(F.upper(prefix).isin(ps), code) for code, ps, _ in COLLECTIONS if ps] if prefix is not None else []
    by_word = [F.when(reduce(lambda a, b: a | b, [F.lower(path).contains(w) for w in words]), code) for code, _, words in COLLECTIONS]
    return F.coalesce(*by_prefix, *by_word)


def macroclass(class_label: Column) -> Column:
    key = F.lower(F.trim(class_label))
    return F.coalesce(*[F.when(key.isin([c.lower() for c in classes]), name) for name, classes in MACROCLASSES.items()])


def extraction(path: Column, prefixes: list[str] = PREFIXES) -> Column:
    """All that a path tells, in one struct."""
    found = specimen(path, prefixes)
    return F.struct(
        found.alias("specimen"), camera_numbers(stem(path)).alias("camera_numbers"), other_numbers(stem(path)).alias("other_numbers"), dates(path).alias("dates"),
        partial_date(best_date(dates(path))).alias("best_date"), taxa(path).alias("taxa"), campaign(path).alias("campaign_year"), collection(path, found["prefix"]).alias("collection"),
    )


def path_clues(path: Column) -> Column:
    """What helps a reviewer: ids, longer numbers, years, collections, taxa and macroclasses, distinct and in order."""
    runs = F.regexp_extract_all(path, F.lit("[0-9]+"), F.lit(0))
    labels = lambda names: F.filter(F.array(*[F.when(F.lower(path).contains(n.lower()), n) for n in names]), lambda x: x.isNotNull())
    return F.struct(
        F.array_distinct(F.regexp_extract_all(path, F.lit(strict(PREFIXES)), F.lit(0))).alias("ids"),
        F.array_distinct(F.filter(runs, lambda x: F.length(x).between(5, 8))).alias("numbers"),
        F.array_distinct(F.filter(runs, lambda x: x.rlike("^(19[0-9]{2}|20[0-2][0-9])$"))).alias("years"),
        F.array_distinct(F.filter(F.array(*[F.when(reduce(lambda a, b: a | b, [F.lower(path).contains(w) for w in words]), code) for code, _, words in COLLECTIONS]), lambda x: x.isNotNull())).alias("collections"),
        labels([n for names in TAXA.values() for n in names]).alias("taxa"), labels(list(MACROCLASSES)).alias("macroclasses"),
    )


def uuid8(path: Column) -> Column:
    """The eight hexadecimal digits that end a file name before its suffix."""
    return F.lower(extract(path, r"_([0-9a-fA-F]{8})\.[^.]+$"))


def short_id(key: Column) -> Column:
    """Eight hexadecimal digits that depend on the key only."""
    return F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)


def exif_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy:MM:dd HH:mm:ss"))


def relative(path: Column, root: Column | str) -> Column:
    """A path below `root` without it; others as they are. Slashes are made forward."""
    path, root = F.replace(path, F.lit("\\"), F.lit("/")), F.concat(F.rtrim(F.lit(root) if isinstance(root, str) else root, F.lit("/")), F.lit("/"))
    return F.when(path.startswith(root), F.substr(path, F.length(root) + 1)).otherwise(path)


def absolute(path: Column, root: str) -> Column:
    return F.when(path.rlike(r"^(/|[A-Za-z]:|[a-z0-9]+://)"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def parsed(text: Column, schema: str) -> Column:
    """JSON, if need be inside a fenced block; null where it is neither."""
    fenced = extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```")
    return F.from_json(F.coalesce(fenced, text), schema)

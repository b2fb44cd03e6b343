"""Where files go and what they are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.patterns import macroclass, short_id, stem
from lamina.functions.scalar import base_name, clean, sanitize

#: Image suffixes that are written as .jpg, folders of collections beside the main one, folders of review by kind of decision.
CONVERTIBLE = ["jpg", "jpeg", "png", "bmp", "gif", "tiff", "tif", "webp", "psd", "cr2", "nef", "arw", "dng", "orf", "rw2", "raw"]
OTHERS = {"BUE": "Otras_Colecciones/Buenache", "MON": "Otras_Colecciones/Montsec"}


def file_name(path: Column, file_type: Column, year: Column, specimen: Column, short: Column) -> Column:
    """<year or 0000>_<specimen or stem>_<short id>.<suffix>; images that can be converted get .jpg."""
    suffix = F.lower(F.regexp_extract(path, r"[^/\\.](\.[^./\\]+)$", 1))
    ending = F.when((file_type == "image") & F.substr(suffix, F.lit(2)).isin(CONVERTIBLE), ".jpg").otherwise(suffix)
    return F.concat(F.concat_ws("_", F.coalesce(year.cast("string"), F.lit("0000")), sanitize(F.coalesce(clean(specimen), stem(path))), short), ending)


def reason_folder(reason: Column) -> Column:
    """A reason for review as a folder name."""
    return F.coalesce(clean(F.regexp_replace(reason, r"""[<>:"/\\|?*\[\]']""", "")), F.lit("Otro"))


def base_folder(collection: Column) -> Column:
    out = F.lit("")
    for code, folder in OTHERS.items():
        out = F.when(collection == code, folder).otherwise(out)
    return F.nullif(out, F.lit(""))


def route(files: DataFrame, key: str = "path") -> DataFrame:
    """`files` with folder, new_name and is_duplicate as it stands after routing.

    Columns: path, file_type, needs_review, review_reason, is_duplicate,
    duplicate_of, macroclass, taxonomic_class, determination, specimen_id,
    campaign_year, collection. Review comes before duplicates; a duplicate whose
    original is not among the files is none; without any taxon, specimen and year a
    file is lost; a macroclass is inferred from the class.
    """
    known = files.select(F.col(key).alias("duplicate_of"), F.lit(True).alias("_known")).distinct()
    rows = files.join(known, "duplicate_of", "left")
    of = {c: clean(F.col(c).cast("string")) for c in ("macroclass", "taxonomic_class", "determination", "specimen_id", "campaign_year")}
    review, duplicate = F.coalesce(F.col("needs_review"), F.lit(False)), F.coalesce(F.col("is_duplicate") & F.col("_known"), F.lit(False))
    lost = F.coalesce(*of.values()).isNull()
    main = F.concat_ws(
        "/", base_folder(F.col("collection")), F.coalesce(F.concat(F.lit("Campaña_"), of["campaign_year"]), F.lit("Sin_Campaña")),
        F.coalesce(of["macroclass"], macroclass(of["taxonomic_class"]), F.lit("Sin_Macroclase")), F.coalesce(of["taxonomic_class"], F.lit("Sin_Clase")), F.coalesce(of["determination"], F.lit("Sin_Genero")),
    )
    image = F.when(review, F.concat(F.lit("Revision_Manual/"), reason_folder(F.col("review_reason")))).when(duplicate, "Duplicados").when(lost, "Casos_Perdidos_Generales").otherwise(main)
    other = F.concat_ws("/", base_folder(F.col("collection")), F.when(F.col("file_type") == "text", "Archivos_Texto").otherwise("Otros_Archivos"))
    is_image, short = F.coalesce(F.col("file_type") == "image", F.lit(False)), short_id(F.col("path"))
    named = file_name(F.col("path"), F.col("file_type"), of["campaign_year"], of["specimen_id"], short)
    plain = F.concat(short, F.lit("_"), F.regexp_replace(base_name(F.col("path")), r"[^\p{L}\p{N}_.\-]", "_"))
    return rows.withColumns({"folder": F.when(is_image, image).otherwise(other), "new_name": F.when(is_image, named).otherwise(plain), "is_duplicate": duplicate}).drop("_known").select(*files.columns, "folder", "new_name")


def comments(kept: Column, duplicate_type: Column, reason: Column) -> Column:
    """Parts of a comment that the engine adds, after what is there."""
    return F.concat_ws(" | ", clean(kept), F.when(duplicate_type.isNotNull(), F.concat(F.lit("[AUTO] duplicate: "), duplicate_type)), F.when(clean(reason).isNotNull(), F.concat(F.lit("[REVIEW] "), clean(reason))))

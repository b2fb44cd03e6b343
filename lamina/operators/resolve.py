"""Field comparison and decisions: policy first, then stored decisions, the file's own before its folder's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.scalar import clean


#: Folder of review for each kind of decision.
REVIEW_FOLDERS = {
    "numeric_id_ambiguity": "Ambiguous_IDs", "metadata_conflict": "Metadata_Conflicts", "source_discrepancy": "Source_Discrepancies", "camera_number_flag": "Camera_Number_Review",
    "duplicate_detected": "Duplicates_Review", "duplicate_metadata_discrepancy": "Duplicate_Metadata_Review", "filename_collision": "Filename_Collisions", "unknown_collection": "Unknown_Collection",
    "no_specimen_id": "No_Specimen_ID", "llm_regex_failed": "LLM_Review", "merge_file_collision": "Merge_File_Collisions", "merge_registry_conflict": "Merge_Registry_Conflicts",
}


def review_folder(kind: Column) -> Column:
    out = F.coalesce(*[F.when(kind == k, f) for k, f in REVIEW_FOLDERS.items()])
    return F.coalesce(out, F.lit("Other_Review"))


def apply_token(token: Column, values: dict[str, Column], current: Column, custom: Column) -> Column:
    """The value that a decision stands for: a source's, none, the reviewer's own, or the current one while it is deferred."""
    out = F.when(token == "none", F.lit(None).cast("string")).when(token == "custom", custom)
    for name, value in values.items():
        out = out.when(token == name, value)
    return out.otherwise(current)


def camera_number(specimen: Column, numbers: Column, use: Column) -> Column:
    """A camera's number becomes the specimen only if that is asked for and there is none."""
    return F.coalesce(clean(specimen), F.when(F.coalesce(use, F.lit(False)), F.get(numbers, F.lit(0))))


def merge_pair(a: Column, b: Column, choice: int | str = 0) -> Column:
    """Two records' values: the one there is, else by choice the first (0), the second (1), none (2) or both for review ('d')."""
    a, b = clean(a), clean(b)
    differ = {0: a, 1: b, 2: F.lit(None).cast("string")}.get(choice, F.concat_ws(" || ", a, b))
    return F.when(a.isNull() | b.isNull() | (a == b), F.coalesce(a, b)).otherwise(differ)


def field_status(a: Column, b: Column) -> Column:
    a, b = clean(a), clean(b)
    return F.when(a.isNull() & b.isNull(), "both_empty").when(a.isNull() | b.isNull(), "one_empty").when(a == b, "same").otherwise("differ")


def decide(conflicts: DataFrame, decisions: DataFrame, default: str) -> DataFrame:
    """Conflicts (path, folder, field, …) with their outcome.

    decisions: (path or null, folder or null, field, outcome). One for a path wins
    over one for its folder; without either the default holds. `defer` asks for review.
    """
    own = decisions.filter("path IS NOT NULL").groupBy("path", "field").agg(F.min("outcome").alias("own"))
    near = decisions.filter("path IS NULL").groupBy("folder", "field").agg(F.min("outcome").alias("near"))
    out = conflicts.join(own, ["path", "field"], "left").join(near, ["folder", "field"], "left")
    return out.withColumn("outcome", F.coalesce("own", "near", F.lit(default))).withColumn("needs_review", F.col("outcome") == "defer").drop("own", "near")


def decide_groups(rows: DataFrame, group: str, key: str, field: str, decisions: DataFrame, mode: str = "auto") -> DataFrame:
    """(group, key, field, outcome, needs_review) of rows in groups that know several values of a field.

    decisions: (group, outcome), one of each counts; without one `mode` holds: auto keeps what there is, deferred asks. The first row by key is the
    original: `keep` leaves it as it is, another outcome than `keep`, `none` and `defer` is its new value, `none` takes its value away. `defer` changes
    nothing and marks all rows of the group for review.
    """
    value = clean(F.col(field).cast("string"))
    seen = rows.filter(F.col(group).isNotNull()).groupBy(group).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.min(key).alias("_first")).filter("_lo <> _hi").drop("_lo", "_hi")
    told = decisions.groupBy(group).agg(F.min("outcome").alias("_told"))
    out = rows.join(seen.join(told, group, "left"), group).withColumn("outcome", F.coalesce("_told", F.lit({"auto": "keep", "deferred": "defer"}[mode])))
    new = F.when((F.col(key) != F.col("_first")) | F.col("outcome").isin("keep", "defer"), value).when(F.col("outcome") != "none", F.col("outcome"))
    return out.select(group, key, new.alias(field), "outcome", (F.col("outcome") == "defer").alias("needs_review"))


def decision_summary(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("type").agg(F.count("*").alias("n"))


def differences(existing: DataFrame, staged: DataFrame, key: str, fields: list[str], most: int = 120) -> DataFrame:
    """Long rows (key, field, existing, staged) of fields that differ, cut to `most` characters with an ellipsis."""
    short = lambda c: F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 1), F.lit("…"))).otherwise(c)

    def long(df: DataFrame, name: str) -> DataFrame:
        cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), clean(F.col(f).cast("string")).alias(name)) for f in fields]))
        return df.select(key, cells.alias("c")).select(key, "c.*")

    both = long(existing, "existing").join(long(staged, "staged"), [key, "field"], "full_outer")
    return both.filter(~F.col("existing").eqNullSafe(F.col("staged"))).select(key, "field", short(F.col("existing")).alias("existing"), short(F.col("staged")).alias("staged"))

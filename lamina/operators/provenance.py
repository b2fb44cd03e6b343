"""Where values come from: for each row a map from field to source to value, and what is derived from it for all fields at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.scalar import clean

MAP = "map<string,map<string,string>>"
#: Sources by field, the first that has a value wins; of other fields and sources the first by name.
PRIORITY = {
    "specimen_id": ["pattern_extractor", "filename_llm", "path_llm"],
    "campaign_year": ["path_llm", "pattern_extractor", "filename_llm"],
    "macroclass": ["path_llm", "filename_llm", "pattern_extractor"],
    "taxonomic_class": ["path_llm", "filename_llm", "pattern_extractor"],
    "determination": ["path_llm", "filename_llm", "pattern_extractor"],
}
#: What is chosen for each kind of decision if nobody decides.
DEFAULTS = {
    "numeric_id_ambiguity": 1, "metadata_conflict": 0, "duplicate_detected": 0, "duplicate_metadata_discrepancy": 0, "unknown_collection": 3,
    "source_discrepancy": 0, "camera_number_flag": 1, "merge_file_collision": 0, "merge_registry_conflict": 0,
}


def noted(**values: dict[str, Column]) -> Column:
    """A map of what sources say: noted(field={source: value, …}, …). Blank values are not in it, nor fields that no source tells."""
    cells = [F.struct(F.lit(f).alias("f"), F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(s).alias("s"), clean(v.cast("string")).alias("v")) for s, v in of.items()]), lambda x: x["v"].isNotNull())).alias("m")) for f, of in values.items()]
    return F.map_from_entries(F.filter(F.array(*cells), lambda x: F.size(x["m"]) > 0))


def merged(a: Column, b: Column) -> Column:
    """Two maps as one; where both have a value of a source for a field, that of `b` counts."""
    none = F.create_map().cast("map<string,string>")
    both = lambda _, x, y: F.map_zip_with(F.coalesce(x, none), F.coalesce(y, none), lambda _, p, q: F.coalesce(q, p))
    empty = F.create_map().cast(MAP)
    return F.map_zip_with(F.coalesce(a, empty), F.coalesce(b, empty), both)


def resolved(sources: Column, field: str) -> Column:
    """(value, source, n_values) of a field: from the source of highest priority, and how many different values there are."""
    of = sources[field]
    told = F.array_sort(F.map_keys(of))
    order = F.filter(F.concat(F.array(*[F.lit(s) for s in PRIORITY.get(field, [])]).cast("array<string>"), told), lambda s: F.array_contains(told, s))
    winner = F.get(order, F.lit(0))
    return F.struct(of[winner].alias("value"), winner.alias("source"), F.coalesce(F.size(F.array_distinct(F.map_values(of))), F.lit(0)).alias("n_values"))


def reconcile(rows: DataFrame, sources: str, fields: list[str] | None = None) -> DataFrame:
    """Rows with each field's value, and n_conflicts: fields for which sources differ. One pass, all fields together."""
    fields = fields or list(PRIORITY)
    out = rows.withColumn("_r", F.struct(*[resolved(F.col(sources), f).alias(f) for f in fields]))
    differ = sum((F.when(F.col(f"_r.{f}.n_values") > 1, 1).otherwise(0) for f in fields), F.lit(0))
    return out.withColumns({f: F.col(f"_r.{f}.value") for f in fields} | {"n_conflicts": differ}).drop("_r")


def discrepancies(rows: DataFrame, key: str, sources: str) -> DataFrame:
    """(key, field, n_values, winner, options): a row for each field whose sources differ; options are '<source>=<value>' by source."""
    cells = rows.select(key, F.explode(sources).alias("field", "of"))
    options = F.array_join(F.transform(F.array_sort(F.map_entries("of")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
    winner = F.coalesce(*[F.when(F.col("field") == f, resolved(F.create_map(F.col("field"), F.col("of")), f)["source"]) for f in PRIORITY], F.get(F.array_sort(F.map_keys("of")), F.lit(0)))
    several = cells.withColumn("n_values", F.size(F.array_distinct(F.map_values("of")))).filter("n_values > 1")
    return several.select(key, "field", "n_values", winner.alias("winner"), options.alias("options"))


def default_choice(kind: Column) -> Column:
    """The option that is taken without a decision; null for kinds that have none."""
    return F.coalesce(*[F.when(kind == k, n) for k, n in DEFAULTS.items()])


def autofill(rows: DataFrame, group: str, key: str, fields: list[str]) -> DataFrame:
    """Rows of groups of several, with each field filled where its group knows one value only, and what became of each field.

    <field>_outcome: filled (the row lacked the value), same, discrepancy (the group has several values: nothing is filled) or none.
    All fields are looked at in one aggregation, which combines before the shuffle.
    """
    aggs = [F.count("*").alias("_n")]
    for f in fields:
        aggs += [F.min(clean(F.col(f).cast("string"))).alias(f"_lo_{f}"), F.max(clean(F.col(f).cast("string"))).alias(f"_hi_{f}")]
    g = rows.filter(F.col(group).isNotNull()).groupBy(group).agg(*aggs).filter("_n > 1")
    out = rows.join(g, group)
    cells = []
    for f in fields:
        own, lo, hi = clean(F.col(f).cast("string")), F.col(f"_lo_{f}"), F.col(f"_hi_{f}")
        outcome = F.when(lo.isNull(), "none").when(lo != hi, "discrepancy").when(own.isNull(), "filled").otherwise("same")
        cells += [F.when(outcome == "filled", lo).otherwise(own).alias(f), outcome.alias(f"{f}_outcome")]
    return out.select(group, key, *cells)

"""Registered queries of what is known about files: sources of values, patterns as data, patterns that are learned, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions.scalar import bare_id
from lamina.operators import learned, match, provenance, resolve, review
from lamina.plans.curation import PATH
from lamina.plans.queries import query
from lamina.sources import reports

# --- sources of values

#: What each source says about each field of a part, in SQL that both engines read.
_SAID = {
    "specimen_id": {"path_llm": "CASE WHEN p_partkey % 2 = 0 THEN p_brand END", "pattern_extractor": "CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE ' ' END", "filename_llm": "CASE WHEN p_partkey % 5 = 0 THEN p_type END"},
    "campaign_year": {"path_llm": "CASE WHEN p_partkey % 4 = 0 THEN CAST(2000 + p_size AS STRING) END", "pattern_extractor": "CASE WHEN p_partkey % 3 = 1 THEN CAST(2000 + p_size % 20 AS STRING) END"},
    "macroclass": {"filename_llm": "CASE WHEN p_partkey % 7 < 3 THEN p_brand ELSE 'nan' END"},
    "taxonomic_class": {"path_llm": "p_type", "filename_llm": "CASE WHEN p_partkey % 2 = 1 THEN p_type END", "pattern_extractor": "CASE WHEN p_partkey % 11 = 0 THEN p_brand END"},
    "determination": {"pattern_extractor": "CASE WHEN p_partkey % 6 = 0 THEN p_name END", "filename_llm": "CASE WHEN p_partkey % 6 < 2 THEN p_type END"},
    "collection_code": {"zeta": "p_brand", "alpha": "CASE WHEN p_partkey % 9 = 0 THEN 'LH' END"},
}
_blank = lambda c: f"CASE WHEN lower(trim({c})) NOT IN ('', 'nan') THEN trim({c}) END"
_ranked = {f: [_blank(of[s]) for s in [*[p for p in provenance.PRIORITY.get(f, []) if p in of], *sorted(set(of) - set(provenance.PRIORITY.get(f, [])))]] for f, of in _SAID.items()}
_many = {f: f"len(list_distinct([{', '.join(v)}]))" for f, v in _ranked.items()}


def _known(part):
    # what path and name say comes first, the pattern extractor's word later
    of = lambda late: {f: {s: F.expr(c) for s, c in said.items() if (s == "pattern_extractor") == late} for f, said in _SAID.items()}
    early, late = provenance.noted(**of(False)), provenance.noted(**{f: v for f, v in of(True).items() if v})
    return part.select("p_partkey", provenance.merged(early, late).alias("sources"))


@query(f"SELECT p_partkey, {', '.join(f'coalesce({', '.join(v)}) AS {f}' for f, v in _ranked.items())}, ({' + '.join(f'({m} > 1)::INT' for m in _many.values())})::INT AS n_conflicts FROM part".replace("AS STRING", "AS VARCHAR"))
def provenance_fields(part):
    return provenance.reconcile(_known(part), "sources", list(_SAID)).drop("sources")


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT p_partkey, '{f}' AS field, {_many[f]}::INT AS n_values, CASE {' '.join(f'''WHEN {_blank(of[s])} IS NOT NULL THEN '{s}' ''' for s in [*[p for p in provenance.PRIORITY.get(f, []) if p in of], *sorted(set(of) - set(provenance.PRIORITY.get(f, [])))])} END AS winner, concat_ws('; ', {', '.join(f"'{s}=' || {_blank(of[s])}" for s in sorted(of))}) AS options FROM part"
        for f, of in _SAID.items()
    )
    + ") WHERE n_values > 1"
)
def provenance_discrepancies(part):
    return provenance.discrepancies(_known(part), "p_partkey", "sources")


_FILLED = {"lang": "CASE WHEN doc_id % 5 <> 0 THEN lang END", "source": "source", "quality": "CAST(quality AS STRING)", "toxic": "CAST(toxic AS STRING)", "odd": "CASE WHEN doc_id % 4 = 0 THEN 'yes' END", "none": "CASE WHEN doc_id % 4 = 9 THEN '' END"}
_outcome = lambda f: f"CASE WHEN lo_{f} IS NULL THEN 'none' WHEN lo_{f} <> hi_{f} THEN 'discrepancy' WHEN f_{f} IS NULL THEN 'filled' ELSE 'same' END"


@query(
    f"""WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS digest, {', '.join(f'nullif(trim({c}), {chr(39) * 2}) AS f_{f}' for f, c in _FILLED.items())} FROM documents LEFT JOIN labels USING (doc_id)),
    g AS (SELECT digest, {', '.join(f'min(f_{f}) AS lo_{f}, max(f_{f}) AS hi_{f}' for f in _FILLED)} FROM d GROUP BY digest HAVING count(*) > 1)
    SELECT digest, doc_id, {', '.join(f'CASE WHEN {_outcome(f)} = {chr(39)}filled{chr(39)} THEN lo_{f} ELSE f_{f} END AS "{f}", {_outcome(f)} AS {f}_outcome' for f in _FILLED)} FROM d JOIN g USING (digest)"""
)
def group_autofill_fields(documents, labels):
    rows = documents.join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left").select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"), *[F.expr(c).alias(f) for f, c in _FILLED.items()])
    return provenance.autofill(rows, "digest", "doc_id", list(_FILLED))


# --- patterns

_NAME = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1)"
_HOST = "regexp_extract(url, '://([^/?#]+)', 1)"
_PATTERNS = [r"(?P<specimen_id>[0-9]{2})[0-9]*", "[0-9]{2}", "(broken", r"([0-9])[0-9]*(\.HTML)?", None]


@query(
    f"""WITH n AS (SELECT page_id, {_HOST} AS host, {_NAME} AS name FROM pages) SELECT page_id, host, name, CASE length(host) % 5 WHEN 0 THEN regexp_matches(name, '[0-9][0-9]') WHEN 1 THEN regexp_matches(name, '[0-9][0-9]') WHEN 3 THEN regexp_matches(name, '[0-9]') ELSE false END AS matched,
    nullif(CASE length(host) % 5 WHEN 0 THEN regexp_extract(name, '[0-9][0-9]') WHEN 1 THEN regexp_extract(name, '[0-9][0-9]') WHEN 3 THEN regexp_extract(name, '[0-9]') END, '') AS value, length(host) % 5 = 2 AS failed FROM n"""
)
def stored_patterns(pages):
    """A host's pattern by the length of its name: with a named group, without a group, broken, with plain groups, none."""
    names = pages.select("page_id", F.expr(_HOST).alias("host"), F.expr(_NAME).alias("name"))
    pattern = F.coalesce(*[F.when(F.length("host") % 5 == k, p) for k, p in enumerate(_PATTERNS) if p])
    found = learned.stored(names, names.select("host").distinct().withColumn("pattern", pattern), "host", "name")
    return found.select("page_id", "host", "name", "matched", "value", F.col("error").isNotNull().alias("failed"))


@query(f"WITH n AS (SELECT {_HOST} AS host, regexp_replace({_NAME}, '[.].*$', '') AS name FROM pages) SELECT host, count(*) AS n, count_if(regexp_matches(name, '[0-9]')) AS n_matched, count_if(regexp_matches(name, '[0-9]')) / count(*)::DOUBLE AS rate FROM n GROUP BY host")
def learned_host_patterns(pages):
    """Names of pages are numbers: what is learned from some matches all."""
    names = pages.select(F.expr(_HOST).alias("host"), F.expr(f"regexp_replace({_NAME}, '[.].*$', '')").alias("name"))
    return learned.induce(names, "host", "name").select("host", "n", "n_matched", "rate")


@query(f"SELECT regexp_replace(path, '/[^/]*$', '') AS folder, count(*) AS n, count(*) AS n_matched FROM (SELECT {PATH} AS path FROM part) GROUP BY 1")
def learned_folder_patterns(part):
    """Twelve makes of names in each folder: no narrow pattern will do, the loosest finds a number in every name."""
    paths = part.select(F.expr(PATH).alias("path"))
    names = paths.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    return learned.induce(names, "folder", "name").select("folder", "n", "n_matched")


# --- reports


@query(
    """WITH a AS (SELECT x, row_number() OVER (ORDER BY x) AS k FROM (SELECT DISTINCT p_brand AS x FROM part)), b AS (SELECT x, row_number() OVER (ORDER BY x) AS k FROM (SELECT DISTINCT p_type AS x FROM part)), c AS (SELECT x, row_number() OVER (ORDER BY x) AS k FROM (SELECT DISTINCT c_mktsegment AS x FROM customer))
    SELECT coalesce(a.k, b.k, c.k) AS position, a.x AS brand, b.x AS type, c.x AS segment FROM a FULL JOIN b ON a.k = b.k FULL JOIN c ON c.k = coalesce(a.k, b.k)"""
)
def ragged_export(part, customer):
    return reports.side_by_side(brand=part.select("p_brand").distinct(), type=part.select("p_type").distinct(), segment=customer.select("c_mktsegment").distinct())


# --- review

_PLACE = "CASE p_partkey % 9 WHEN 0 THEN 'logs/' WHEN 1 THEN 'registries/' WHEN 2 THEN '' WHEN 3 THEN 'Duplicados/' WHEN 4 THEN 'a/logs/' WHEN 5 THEN '__pycache__/' ELSE 'in/b/' END || CASE p_partkey % 8 WHEN 0 THEN 'staging_info.json' WHEN 1 THEN 'pipeline_state.json' WHEN 2 THEN 'duplicados_registro.xlsx' WHEN 3 THEN 'llm_cache.json' ELSE 'f' || CAST(p_partkey AS STRING) || '.jpg' END"


@query(f"WITH f AS (SELECT p_partkey, {_PLACE} AS rel FROM part) SELECT p_partkey, rel FROM f WHERE rel NOT IN ('staging_info.json', 'pipeline_state.json', 'llm_cache.json', 'Duplicados/duplicados_registro.xlsx') AND NOT regexp_matches(rel, '^(logs|__pycache__|registries)/')")
def staged_files(part):
    return part.select("p_partkey", F.expr(_PLACE).alias("rel")).filter(review.is_staged_file(F.col("rel")))


_FLAGS = {"type": "CASE WHEN p_partkey % 3 = 0 THEN 'text' WHEN p_partkey % 11 <> 0 THEN 'image' END", "specimen": "CASE WHEN p_partkey % 4 = 0 THEN ' ' WHEN p_partkey % 4 = 1 THEN 'nan' WHEN p_partkey % 5 <> 0 THEN p_brand END", "collection": "CASE WHEN p_size % 2 = 0 THEN p_brand END", "is_duplicate": "CASE WHEN p_partkey % 6 <> 0 THEN p_partkey % 6 = 1 END"}


@query(
    f"""WITH f AS (SELECT p_partkey, {', '.join(f'{c} AS {n}' for n, c in _FLAGS.items())} FROM part), r AS (SELECT *, coalesce(type = 'image', false) AND (coalesce(lower(trim(specimen)), '') IN ('', 'nan') OR collection IS NULL) AS needs_review FROM f)
    SELECT p_partkey, needs_review FROM r WHERE coalesce(is_duplicate, false) = false AND (type = 'text' OR (type = 'image' AND needs_review) OR collection = p_partkey::VARCHAR)"""
)
def review_flags(part):
    """Unique texts, and unique images that need a review."""
    files = part.select("p_partkey", *[F.expr(c).alias(n) for n, c in _FLAGS.items()])
    files = files.withColumn("needs_review", review.needs_review(F.col("type"), F.col("specimen"), F.col("collection")))
    parts = [review.select(files, kind="text", duplicate=False), review.select(files, kind="image", review=True, duplicate=False)]
    return parts[0].unionByName(parts[1]).select("p_partkey", "needs_review")


_ID = "substr(md5(CAST(doc_id AS STRING)), 1, 8)"
_FILE = f"coalesce(source, 'none') || '/2020_' || CASE WHEN doc_id % 4 = 0 THEN {_ID} ELSE 'name' || CAST(doc_id AS STRING) END || '.txt'"
_TOLD = f"doc_id % 8 = 0 AS by_id, doc_id % 4 = 1 AS by_rel, doc_id % 4 = 2 AS by_path, CASE WHEN doc_id % 8 = 0 THEN upper({_ID}) END AS uuid, CASE doc_id % 4 WHEN 1 THEN {_FILE} WHEN 2 THEN '/root dir/' || {_FILE} END AS file_path"


@query(f"WITH f AS (SELECT doc_id, '/root dir/' || {_FILE} AS path, md5(coalesce(text, '')) AS d, {_TOLD} FROM documents) SELECT doc_id, path, CASE WHEN by_id OR by_rel OR by_path THEN d END AS md5_hash, CASE WHEN by_id THEN 1 WHEN by_rel THEN 2 WHEN by_path THEN 3 END AS step FROM f".replace("AS STRING", "AS VARCHAR"))
def hash_lookup(documents):
    """Every fourth document has its short id in its name; a hash row tells that id, a path below the root, a whole path, or is not there."""
    files = documents.select("doc_id", F.expr(f"'/root dir/' || {_FILE}").alias("path"))
    hashes = documents.filter("doc_id % 8 = 0 OR doc_id % 4 IN (1, 2)").selectExpr(*[c for c in (f"CASE WHEN doc_id % 8 = 0 THEN upper({_ID}) END AS uuid", f"CASE doc_id % 4 WHEN 1 THEN {_FILE} WHEN 2 THEN '/root dir/' || {_FILE} END AS file_path", "md5(coalesce(text, '')) AS md5_hash", "CAST(NULL AS STRING) AS phash")])
    return review.hashes_of(files, hashes, "/root dir").select("doc_id", "path", "md5_hash", "step")


@query(
    """WITH f AS (SELECT doc_id, 'new/' || (doc_id % 50)::VARCHAR || '/n' || doc_id::VARCHAR AS path, md5(coalesce(text, '')) AS d, CASE WHEN doc_id % 6 = 5 THEN 'u' || doc_id::VARCHAR END AS id FROM documents),
    r AS (SELECT 'u' || doc_id::VARCHAR AS uuid, CASE WHEN doc_id % 6 = 0 THEN path WHEN doc_id % 6 = 1 THEN 'old/n' || doc_id::VARCHAR ELSE 'gone/' || doc_id::VARCHAR || '.x' END AS at, d, doc_id % 6 = 2 AS told FROM f),
    c AS (SELECT path, 1 AS step, uuid FROM f JOIN r ON r.at = f.path UNION ALL SELECT path, 2, uuid FROM f JOIN r ON regexp_extract(r.at, '[^/]*$') = regexp_extract(f.path, '[^/]*$') UNION ALL SELECT path, 3, uuid FROM f JOIN r ON r.told AND r.d = f.d UNION ALL SELECT path, 4, uuid FROM f JOIN r ON r.uuid = f.id),
    b AS (SELECT path, min((step, uuid)) AS m FROM c GROUP BY path) SELECT doc_id, m[2] AS uuid, m[1]::INT AS step FROM f LEFT JOIN b USING (path)"""
)
def registry_row_fallback(documents):
    """Registry rows are found by path, by name, by the digest that a hash row tells, by id, or not at all."""
    f = documents.selectExpr("doc_id", "'new/' || CAST(doc_id % 50 AS STRING) || '/n' || CAST(doc_id AS STRING) AS path", "md5(coalesce(text, '')) AS md5_hash", "CASE WHEN doc_id % 6 = 5 THEN 'u' || CAST(doc_id AS STRING) END AS id")
    at = F.expr("CASE WHEN doc_id % 6 = 0 THEN path WHEN doc_id % 6 = 1 THEN 'old/n' || CAST(doc_id AS STRING) ELSE 'gone/' || CAST(doc_id AS STRING) || '.x' END")
    r = f.select(F.expr("'u' || CAST(doc_id AS STRING)").alias("uuid"), at.alias("current_path"), "md5_hash", "doc_id")
    hashes = r.filter("doc_id % 6 = 2").select(F.col("current_path").alias("file_path"), "md5_hash")
    return review.registry_rows(f, r.select("uuid", "current_path"), hashes).select("doc_id", "uuid", "step")


@query("SELECT doc_id FROM documents AS d WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND md5(coalesce(text, '')) IN (SELECT md5(coalesce(text, '')) FROM documents GROUP BY 1 HAVING count(*) > 1) AND (lang IS NULL OR source IS NULL OR doc_id % 3 <> 0) ORDER BY doc_id LIMIT 25")
def sampled_reviews(documents, labels):
    """The first documents without a label that have a copy and lack a field; a third have the last one."""
    copies = documents.withColumn("d", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    copies = copies.join(copies.groupBy("d").count().filter("count > 1"), "d")
    rows = documents.withColumn("note", F.when(F.col("doc_id") % 3 == 0, "x"))
    return review.sample(rows, labels, "doc_id", 25, duplicates=copies, missing=["lang", "source", "note"]).select("doc_id")


@query("SELECT c_mktsegment AS uuid, max((coalesce(c_name, ''), c_nationkey::VARCHAR))[1] AS phash, max((coalesce(c_name, ''), c_nationkey::VARCHAR))[2] AS md5_hash FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1")
def tolerant_hashes(customer):
    """Columns by other names and in other cases, repeated ids."""
    return review.uuid_hashes(customer.select(F.col("c_mktsegment").alias("ID"), F.col("c_name").alias("P_Hash"), F.col("c_nationkey").alias("MD5")))


@query(
    """WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS digest, CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN lang END AS label FROM documents),
    g AS (SELECT digest, min(doc_id) AS first, CASE substr(digest, 1, 1) WHEN '0' THEN 'none' WHEN '1' THEN 'none' WHEN '2' THEN 'defer' WHEN '3' THEN 'defer' WHEN '4' THEN 'new' WHEN '5' THEN 'new' WHEN '6' THEN 'new' ELSE 'keep' END AS outcome FROM d GROUP BY digest HAVING count(DISTINCT label) > 1)
    SELECT digest, doc_id, CASE WHEN doc_id <> first OR outcome IN ('keep', 'defer') THEN label WHEN outcome <> 'none' THEN outcome END AS label, outcome, outcome = 'defer' AS needs_review FROM d JOIN g USING (digest)"""
)
def group_decisions(documents):
    """Copies with several labels, decided by the first digit of their digest; some are left to the mode."""
    rows = documents.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"), F.expr("CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN lang END").alias("label"))
    first = F.substring("digest", 1, 1)
    outcome = F.when(first.isin("0", "1"), "none").when(first.isin("2", "3"), "defer").when(first.isin("4", "5", "6"), "new")
    return resolve.decide_groups(rows, "digest", "doc_id", "label", rows.select("digest", outcome.alias("outcome")).filter("outcome IS NOT NULL").distinct())


@query(
    """WITH e AS (SELECT 'LH-' || p_partkey::VARCHAR || ' A' AS id, p_brand AS brand, CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS kind, p_size AS size FROM part WHERE p_partkey % 3 <> 0),
    s AS (SELECT 'lh_' || p_partkey::VARCHAR || 'a' AS id, CASE WHEN p_partkey % 5 = 0 THEN 'other' ELSE p_brand END AS brand, p_type AS kind, p_retailprice AS price FROM part WHERE p_partkey % 3 <> 1)
    SELECT coalesce(e.id, s.id) AS id, CASE WHEN s.id IS NULL THEN 'existing' WHEN e.id IS NULL THEN 'new' ELSE 'both' END AS origin, coalesce(e.brand, s.brand) AS brand, coalesce(e.kind, s.kind) AS kind, coalesce(e.brand <> s.brand, false)::INT AS n_conflicts, size, price
    FROM e FULL JOIN s ON lower(regexp_replace(e.id, '[ _-]', '', 'g')) = lower(regexp_replace(s.id, '[ _-]', '', 'g'))"""
)
def registry_merge_ids(part):
    """Identifiers that are written in two ways; columns that one side has alone stay."""
    e = part.filter("p_partkey % 3 <> 0").selectExpr("'LH-' || CAST(p_partkey AS STRING) || ' A' AS id", "p_brand AS brand", "CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS kind", "p_size AS size", "1 AS created_at")
    s = part.filter("p_partkey % 3 <> 1").selectExpr("'lh_' || CAST(p_partkey AS STRING) || 'a' AS id", "CASE WHEN p_partkey % 5 = 0 THEN 'other' ELSE p_brand END AS brand", "p_type AS kind", "p_retailprice AS price")
    return match.merge_registries(e, s, "id", {"brand": False, "kind": False}, same=bare_id, others=True, skip=("created_at",))

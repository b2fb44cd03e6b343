"""Registered queries of merges and of trees. Collections and batches are built from the tables by the rules that stand here.

Odd documents are a staged batch, even ones the collection, of which every fifth has a hash but no annotation.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from lamina.operators import merge, tree
from lamina.plans.queries import DIST, SIMHASH, _hashed, _md5, query

MOST = 3

_LINKS = f"""{SIMHASH}, f AS (SELECT doc_id, md5(coalesce(text, '')) AS d, simhash FROM documents JOIN fp USING (doc_id)),
m AS (SELECT a.doc_id, b.doc_id AS other, b.doc_id % 2 = 1 AS inside, CASE WHEN a.simhash = b.simhash THEN 0 WHEN {DIST} <= {MOST} THEN 1 ELSE 2 END AS step
 FROM f AS a JOIN f AS b ON a.doc_id % 2 = 1 AND a.doc_id <> b.doc_id AND (b.doc_id % 2 = 0 OR b.doc_id < a.doc_id) AND ({DIST} <= {MOST} OR a.d = b.d)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, inside ORDER BY step, other) AS k FROM m),
o AS (SELECT * FROM r WHERE k = 1 AND (inside OR other % 10 <> 0)),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY inside) AS c FROM o) WHERE c = 1),
chain AS (SELECT doc_id, other AS root, 1 AS steps FROM l UNION ALL SELECT c.doc_id, l.other, c.steps + 1 FROM chain AS c JOIN l ON l.doc_id = c.root),
links AS (SELECT l.doc_id, l.other, ['perceptual', 'near', 'exact'][l.step + 1] AS how, l.inside, c.root, c.steps FROM l JOIN (SELECT doc_id, arg_max(root, steps) AS root, max(steps) AS steps FROM chain GROUP BY doc_id) AS c ON c.doc_id = l.doc_id)"""
#: A row of the annotations, by rule, in SQL that both engines read.
_ANNOTATION = "CAST(doc_id AS STRING) AS uuid, doc_id AS ordinal, source AS fuente, CASE WHEN doc_id % 5 <> 1 THEN lang END AS class_label, text AS comentarios, source || '/' || CAST(doc_id % 9 AS STRING) || '/' || CAST(doc_id AS STRING) || '.txt; shared/' || coalesce(lang, 'none') AS original_path"
_STAGED, _KEPT = "doc_id % 2 = 1", "doc_id % 2 = 0 AND doc_id % 10 <> 0"
#: Decisions for folders: whole sources, and in some of them a folder below.
_DECISIONS = "SELECT source AS folder, CASE WHEN max(doc_id) % 3 = 0 THEN 'existing' WHEN max(doc_id) % 3 = 1 THEN 'staged' ELSE 'defer' END AS choice FROM documents WHERE source IS NOT NULL GROUP BY source UNION ALL SELECT DISTINCT source || '/' || CAST(doc_id % 9 AS STRING), 'staged' FROM documents WHERE doc_id % 9 = 4 AND source IS NOT NULL"
_MERGED = f"""{_LINKS}, decisions AS ({_DECISIONS}),
staged AS (SELECT doc_id, {_ANNOTATION} FROM documents WHERE {_STAGED}), kept AS (SELECT doc_id, {_ANNOTATION} FROM documents WHERE {_KEPT}),
copies AS (SELECT s.*, k.root, k.how, k.other, coalesce(deep.choice, top.choice, 'existing') AS choice, nullif(trim(fuente), '') AS f, nullif(trim(class_label), '') AS c, nullif(trim(comentarios), '') AS t
 FROM staged AS s JOIN links AS k USING (doc_id) LEFT JOIN decisions AS deep ON deep.folder = s.fuente || '/' || (s.doc_id % 9)::VARCHAR LEFT JOIN decisions AS top ON top.folder = s.fuente),
base AS (SELECT *, 'existing' AS origin FROM kept UNION ALL SELECT *, 'new' FROM staged WHERE doc_id NOT IN (SELECT doc_id FROM links)),
got AS (SELECT root, arg_min(f, doc_id) FILTER (f IS NOT NULL) AS first_f, arg_max(f, doc_id) FILTER (f IS NOT NULL AND choice = 'staged') AS last_f, arg_min(c, doc_id) FILTER (c IS NOT NULL) AS first_c, arg_max(c, doc_id) FILTER (c IS NOT NULL AND choice = 'staged') AS last_c,
 first(t ORDER BY length(t) DESC, doc_id) FILTER (t IS NOT NULL) AS first_t FROM copies GROUP BY root),
pieces AS (SELECT doc_id AS root, -1 AS d, unnest(string_split(original_path, '; ')) AS p, generate_subscripts(string_split(original_path, '; '), 1) AS k FROM base UNION ALL SELECT root, doc_id, unnest(string_split(original_path, '; ')), generate_subscripts(string_split(original_path, '; '), 1) FROM copies),
places AS (SELECT root, p, min((d, k)) AS pos FROM pieces WHERE p IS NOT NULL GROUP BY ALL), paths AS (SELECT root, string_agg(p, '; ' ORDER BY pos) AS original_path FROM places GROUP BY root)"""


def _batch(documents):
    # a text without tokens is a row of blank hashes: it matches nothing and stays
    hashed = _hashed(documents.withColumn("digest", _md5()), ["digest"])
    rows = hashed.selectExpr("CAST(doc_id AS STRING) AS uuid", "doc_id AS ordinal", "simhash AS phash", "CASE WHEN simhash IS NOT NULL THEN digest END AS md5_hash")
    notes = documents.selectExpr("doc_id", *_columns())
    links = merge.links(rows.filter("ordinal % 2 = 1"), rows.filter("ordinal % 2 = 0"), notes.filter(_KEPT), MOST)
    return rows, notes, links


def _columns() -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(_ANNOTATION):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(_ANNOTATION[start:i])
            start = i + 1
    return [*out, _ANNOTATION[start:]]


def _merge(documents):
    rows, notes, links = _batch(documents)
    documents.createOrReplaceTempView("documents")
    decisions = documents.sparkSession.sql(_DECISIONS)
    return merge.merge(notes.filter(_STAGED).drop("doc_id"), notes.filter(_KEPT).drop("doc_id"), links, rows.filter("ordinal % 2 = 1"), rows.filter("ordinal % 2 = 0"), decisions)


@query(f"WITH RECURSIVE {_LINKS} SELECT doc_id::VARCHAR AS uuid, other::VARCHAR AS of, how, inside, root::VARCHAR AS root, steps FROM links")
def merge_links(documents):
    return _batch(documents)[2].select("uuid", "of", "how", "inside", "root", "steps")


@query(
    f"""WITH RECURSIVE {_MERGED} SELECT uuid, ordinal, coalesce(last_f, nullif(trim(fuente), ''), first_f) AS fuente, coalesce(last_c, nullif(trim(class_label), ''), first_c) AS class_label,
    CASE WHEN nullif(trim(comentarios), '') IS NULL OR length(first_t) > length(trim(comentarios)) THEN coalesce(first_t, nullif(trim(comentarios), '')) ELSE trim(comentarios) END AS comentarios, paths.original_path, origin
    FROM base LEFT JOIN got ON got.root = doc_id LEFT JOIN paths ON paths.root = doc_id"""
)
def merge_annotations(documents):
    return _merge(documents).annotations


@query(
    f"""WITH RECURSIVE {_MERGED}, said AS (SELECT doc_id AS root, nullif(trim(fuente), '') AS f, nullif(trim(class_label), '') AS c FROM base)
    SELECT uuid, root::VARCHAR AS root, field, existing, staged, choice FROM (SELECT uuid, copies.root, choice, unnest([{{'field': 'fuente', 'existing': coalesce(said.f, first_f), 'staged': copies.f}}, {{'field': 'class_label', 'existing': coalesce(said.c, first_c), 'staged': copies.c}}], recursive := true)
    FROM copies JOIN said USING (root) JOIN got USING (root)) WHERE staged <> existing"""
)
def merge_conflicts(documents):
    return _merge(documents).conflicts


@query(
    f"""WITH RECURSIVE {_MERGED}, counted AS (
    SELECT 'annotations_' || origin AS part, count(*) AS n FROM base GROUP BY origin UNION ALL SELECT 'duplicates_' || how, count(*) FROM copies GROUP BY how
    UNION ALL SELECT 'hashes', count(*) FROM f WHERE doc_id % 2 = 0 OR doc_id NOT IN (SELECT doc_id FROM links)) SELECT * FROM counted"""
)
def merge_summary(documents):
    merged = _merge(documents)
    out = merge.summary(replace(merged, hashes=merged.hashes.filter("phash IS NOT NULL")))
    return out.filter("NOT startswith(part, 'conflicts_')")


@query(
    f"""WITH RECURSIVE {_LINKS}, staged AS (SELECT doc_id, doc_id::VARCHAR AS uuid, 'd' || (doc_id // 100)::VARCHAR AS folder, CASE WHEN doc_id % 3 = 0 THEN 'g' ELSE 'f' END || (doc_id // 2 % 50)::VARCHAR AS stem FROM documents WHERE doc_id % 2 = 1),
    taken AS (SELECT DISTINCT 'd' || (doc_id // 100)::VARCHAR AS folder, 'f' || (doc_id // 2 % 50)::VARCHAR AS stem, doc_id % 4 = 0 AS more FROM documents WHERE doc_id % 2 = 0),
    a AS (SELECT s.*, CASE WHEN k.doc_id IS NOT NULL THEN 'duplicate' WHEN t.stem IS NULL THEN 'copy' WHEN s.doc_id // 100 % 3 = 1 THEN 'overwrite' WHEN s.doc_id // 100 % 3 = 2 THEN 'merged' ELSE 'keep' END AS action, coalesce(t.more, false) AS more,
     row_number() OVER (PARTITION BY s.stem, k.doc_id IS NOT NULL ORDER BY uuid) - 1 AS nth FROM staged AS s LEFT JOIN links AS k ON k.doc_id = s.doc_id LEFT JOIN taken AS t ON t.folder = s.folder AND t.stem = s.stem)
    SELECT uuid, folder || '/' || stem || '.jpg' AS rel, action, CASE action WHEN 'duplicate' THEN 'Duplicados/' || stem || CASE WHEN nth > 0 THEN '_' || nth::VARCHAR ELSE '' END || '.jpg' WHEN 'merged' THEN folder || '/' || stem || '_merged_' || CASE WHEN more THEN '2' ELSE '1' END || '.jpg' WHEN 'keep' THEN NULL ELSE folder || '/' || stem || '.jpg' END AS target FROM a"""
)
def merge_file_plan(documents):
    """Files of the batch and of the collection stand in folders of a hundred; some of the collection's names have a merged twin already."""
    place = lambda stem: F.expr(f"'d' || CAST(doc_id div 100 AS STRING) || '/' || {stem} || CAST(doc_id div 2 % 50 AS STRING)")
    files = documents.filter("doc_id % 2 = 1").select(F.col("doc_id").cast("string").alias("uuid"), F.concat(place("CASE WHEN doc_id % 3 = 0 THEN 'g' ELSE 'f' END"), F.lit(".jpg")).alias("rel"))
    kept = documents.filter("doc_id % 2 = 0")
    taken = kept.select(F.concat(place("'f'"), F.lit(".jpg")).alias("rel")).unionByName(kept.filter("doc_id % 4 = 0").select(F.concat(place("'f'"), F.lit("_merged_1.jpg")).alias("rel")))
    group = F.expr("doc_id div 100 % 3")
    decisions = documents.select(F.expr("'d' || CAST(doc_id div 100 AS STRING)").alias("folder"), F.when(group == 1, "overwrite").when(group == 2, "both").alias("choice")).filter("choice IS NOT NULL").distinct()
    return merge.file_plan(files, taken, _batch(documents)[2], decisions=decisions)


@query("SELECT p_partkey::VARCHAR AS uuid FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 10 <> 1 AND p_partkey % 7 <> 2 AND NOT (p_partkey % 5 = 0 AND p_partkey % 4 <> 0)")
def staging_unhashed(part):
    """Every third file is a text, every tenth a known copy; hashes are told by key, by path, or without a digest."""
    files = part.selectExpr("CAST(p_partkey AS STRING) AS uuid", "CASE WHEN p_partkey % 10 = 1 THEN 'duplicados/' ELSE 'in/' END || CAST(p_partkey AS STRING) || '.jpg' AS rel", "CASE WHEN p_partkey % 3 = 0 THEN 'text' ELSE 'image' END AS type")
    told = part.filter("p_partkey % 7 = 2 OR p_partkey % 5 = 0").selectExpr("CASE WHEN p_partkey % 7 = 2 THEN CAST(p_partkey AS STRING) END AS uuid", "CASE WHEN p_partkey % 5 = 0 THEN 'in/' || CAST(p_partkey AS STRING) || '.jpg' END AS file_path", "CASE WHEN p_partkey % 7 = 2 OR p_partkey % 4 <> 0 THEN 'digest' END AS md5_hash")
    return merge.without_hashes(files, told).select("uuid")


# --- trees of folders, by the paths of pages

_PATH = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?:/', '/web')"
_LISTED = f"SELECT regexp_extract(path, '^(/web/[^/]+)', 1) AS folder, count(*) AS label FROM (SELECT {_PATH} AS path FROM pages) AS p GROUP BY 1 HAVING count(*) % 2 = 0 UNION ALL SELECT regexp_extract(path, '^(/web/[^/]+/[^/]+)/', 1), 0 - count(*) FROM (SELECT {_PATH} AS path FROM pages) AS p WHERE regexp_extract(path, '^(/web/[^/]+/[^/]+)/', 1) <> '' GROUP BY 1 HAVING count(*) % 3 = 0 UNION ALL SELECT '/web', 0 FROM pages WHERE page_id = 0"


@query(
    f"""WITH paths AS (SELECT page_id, {_PATH} AS path FROM pages), places AS (SELECT page_id, regexp_replace(path, '/[^/]*$', '') AS folder FROM paths), listed AS ({_LISTED}),
    found AS (SELECT page_id, places.folder, listed.folder AS place, label, row_number() OVER (PARTITION BY page_id ORDER BY length(listed.folder) DESC) AS k FROM places LEFT JOIN listed ON places.folder = listed.folder OR starts_with(places.folder, listed.folder || '/'))
    SELECT page_id, folder, place AS _nearest, len(string_split(place, '/'))::INT - 1 AS _depth, label FROM found WHERE k = 1"""
)
def inherited_labels(pages):
    """Hosts with an even number of pages, their first folders with a number divisible by three, and the top have a label."""
    pages.createOrReplaceTempView("pages")
    spark = pages.sparkSession
    places = spark.sql(f"SELECT page_id, regexp_replace({_PATH}, '/[^/]*$', '') AS folder FROM pages")
    return tree.nearest(places, "folder", spark.sql(_LISTED.replace("'/web', 0 ", "'/web', CAST(0 AS BIGINT) ")).withColumnRenamed("folder", "at"), "at")


@query(
    f"""WITH paths AS (SELECT {_PATH} AS path, page_id % 4 <> 1 AS gone FROM pages), once AS (SELECT path, bool_or(gone) AS gone, count(*) AS n FROM paths GROUP BY path),
    up AS (SELECT array_to_string(list_slice(string_split(path, '/'), 1, k), '/') AS folder, k - 1 AS depth, gone, n FROM (SELECT *, unnest(range(3, len(string_split(path, '/')))) AS k FROM once))
    SELECT folder, depth::INT AS depth, sum(n)::BIGINT AS n FROM up GROUP BY ALL HAVING bool_and(gone)"""
)
def emptied_folders(pages):
    """Three of four pages move away."""
    files = pages.selectExpr(f"{_PATH} AS path", "page_id")
    return tree.emptied(files, files.filter("page_id % 4 <> 1"), "path", "/web")

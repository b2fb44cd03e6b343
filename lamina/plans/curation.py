"""Registered queries of path extraction, routing, registries and audits, over paths that are built from the tables by a stated rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import patterns as P
from lamina.functions import scalar as S
from lamina.operators import audit, fingerprint, match, registry, resolve, routing
from lamina.plans.queries import query

_K = "lpad(CAST(p_partkey AS STRING), 5, '0')"
_FOLDERS = ["LH/campaign_2022/Insecta/", "Buenache/Crustacea/Scarabaeidae/", "MCCM_2009/", "Las Hoyas/2019/Arthropoda/Coleoptera/", "Camera dumps/", "Montsec/temporada 2021/Odonata/", "MUPA-12345678-a/ADR 00077 b/odd/"]
_NAMES = [
    f"'LH-' || {_K} || '_a_'", f"'LH ' || {_K} || ' AB'", f"'K-Bue ' || {_K} || ' (1)'", f"'DSC_' || {_K}", f"'PA2' || {_K} || '1'", f"{_K} || 'B'", f"'photo_2023-10-15 ' || {_K}",
    "'20240229'", "'2009'", f"'MCCM-LH ' || {_K} || 'A'", "'campaign 2021 x'", f"'PB_' || {_K} || 'c 12-11-2019'",
]
#: A path for each part, in SQL that Spark and DuckDB share.
PATH = "CASE p_partkey % 7 " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(_FOLDERS)) + " END || CASE p_partkey % 12 " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(_NAMES)) + " END || '.JPG'"
_PARTS = f"f AS (SELECT p_partkey, {PATH} AS path FROM part), s AS (SELECT p_partkey, path, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\\.[^.]+$', '\\1') AS stem FROM f)"


def _paths(part):
    return part.select("p_partkey", F.expr(PATH).alias("path"))


# --- extraction

_STRICT = P.strict([p.upper() for p in P.PREFIXES])
_got = lambda t, pattern: f"upper(regexp_extract({t}, '{pattern}', 1)) || '-' || regexp_extract({t}, '{pattern}', 2) || coalesce('-' || nullif(lower(regexp_extract({t}, '{pattern}', 3)), ''), '')"
_number = lambda t, pattern, g: f"regexp_extract({t}, '{pattern}', {g})"
_year = lambda n: f"(length({n}) = 4 AND coalesce(TRY_CAST({n} AS INT), 0) BETWEEN 1980 AND 2026)"
_HELD = "CASE " + " ".join(f"WHEN contains(upper(x), '{p}') THEN '{p}'" for p in sorted({p.upper() for p in P.PREFIXES}, key=lambda p: (-len(p), p))) + " END"


@query(
    f"""WITH {_PARTS}, t AS (SELECT p_partkey, CASE WHEN {_number('stem', _STRICT, 2)} <> '' THEN {_got('stem', _STRICT)} END AS named,
    list_filter(list_transform(list_reverse(list_slice(parts, 1, len(parts) - 1)), lambda x: CASE WHEN {_number('x', _STRICT, 2)} <> '' AND NOT {_year(_number('x', _STRICT, 2))} THEN {_got('x', _STRICT)} END), lambda x: x IS NOT NULL)[1] AS foldered,
    CASE WHEN NOT regexp_matches(stem, '{P.CAMERA_NAME}') AND {_number('stem', P.NUMBER, 1)} <> '' AND NOT {_year(_number('stem', P.NUMBER, 1))} THEN
    list_filter(list_transform(parts, lambda x: {_HELD}), lambda x: x IS NOT NULL)[1] || '-' || {_number('stem', P.NUMBER, 1)} || coalesce('-' || nullif(lower({_number('stem', P.NUMBER, 2)}), ''), '') END AS bare FROM s)
    SELECT p_partkey, coalesce(named, foldered, bare) AS specimen_id, CASE WHEN named IS NOT NULL OR foldered IS NOT NULL THEN 1.0 WHEN bare IS NOT NULL THEN 0.6 END::DOUBLE AS confidence, CASE WHEN named IS NOT NULL THEN 'filename' WHEN foldered IS NOT NULL THEN 'path' WHEN bare IS NOT NULL THEN 'filename' END AS found_in FROM t"""
)
def specimen_ids(part):
    found = _paths(part).select("p_partkey", P.specimen(F.col("path")).alias("s"))
    return found.select("p_partkey", "s.specimen_id", "s.confidence", "s.found_in")


_CAMERA = "(?i)" + "|".join(P.CAMERA_NUMBERS)


@query(f"WITH {_PARTS}, t AS (SELECT p_partkey, stem, regexp_extract_all(stem, '{_CAMERA}') AS c FROM s) SELECT p_partkey, array_to_string(list_transform(c, lambda x: regexp_extract_all(x, '[0-9]+')[-1]), ',') AS camera, array_to_string(list_filter(regexp_extract_all(stem, '[0-9]+'), lambda x: length(x) >= 4 AND len(list_filter(c, lambda h: contains(h, x))) = 0), ',') AS others FROM t")
def name_numbers(part):
    n = P.stem(F.col("path"))
    return _paths(part).select("p_partkey", F.array_join(P.camera_numbers(n), ",").alias("camera"), F.array_join(P.other_numbers(n), ",").alias("others"))


_M, _D = "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])"


def _dates_sql(t: str) -> str:
    runs = f"regexp_extract_all({t}, '[0-9]+')"
    return (
        f"list_concat(list_concat(list_transform(list_filter({runs}, lambda x: regexp_matches(x, '^20[0-9][0-9]{_M}{_D}$')), lambda x: x), list_transform(regexp_extract_all({t}, '20[0-9][0-9][-/]{_M}[-/]{_D}'), lambda x: regexp_replace(x, '[-/]', '', 'g'))),"
        f" list_concat(list_transform(regexp_extract_all({t}, '{_D}[-/]{_M}[-/]20[0-9][0-9]'), lambda x: x[7:10] || x[4:5] || x[1:2]), list_concat(list_filter({runs}, lambda x: regexp_matches(x, '^20[012][0-9]$')), list_transform(regexp_extract_all({t}, '(?i)(?:campaign|año|year|temporada)[-_\\s]*20[012][0-9]'), lambda x: right(x, 4)))))"
    )


@query(
    f"""WITH {_PARTS}, d AS (SELECT p_partkey, list_concat({_dates_sql('stem')}, flatten(list_transform(list_slice(parts, 1, len(parts) - 1), lambda p: {_dates_sql('p')}))) AS all_dates FROM s),
    u AS (SELECT p_partkey, list_filter(all_dates, lambda x, i: list_position(all_dates, x) = i) AS d FROM d)
    SELECT p_partkey, array_to_string(d, ',') AS dates, coalesce(list_filter(d, lambda x: length(x) = 8)[1], list_filter(d, lambda x: length(x) = 6)[1], d[1]) AS best FROM u"""
)
def path_dates(part):
    rows = _paths(part).select("p_partkey", P.dates(F.col("path")).alias("d"))
    return rows.select("p_partkey", F.array_join(F.transform("d", P.partial_date), ",").alias("dates"), P.partial_date(P.best_date(F.col("d"))).alias("best"))


_LEVEL = "CASE " + " ".join(f"WHEN lower(x) IN ({', '.join(repr(n.lower()) for n in names)}) THEN '{level}'" for level, names in P.TAXA.items()) + " END"


@query(
    f"""WITH {_PARTS} SELECT p_partkey, array_to_string(flatten(list_transform(parts, lambda x: list_filter([{_LEVEL} || ':' || x, CASE WHEN regexp_matches(x, '(idae|IDAE)$') THEN 'family:' || x END], lambda y: y IS NOT NULL))), ',') AS taxa,
    list_filter(list_transform(parts, lambda x: coalesce(CASE WHEN regexp_matches(lower(x), '{'|'.join(P.CAMPAIGN)}') THEN nullif(regexp_extract(x, '20[012][0-9]'), '') END, nullif(regexp_extract(x, '^20[012][0-9]$'), ''))::INT), lambda y: y IS NOT NULL)[1] AS campaign_year FROM s"""
)
def path_hints(part):
    taxa = F.transform(P.taxa(F.col("path")), lambda t: F.concat(t["level"], F.lit(":"), t["value"]))
    return _paths(part).select("p_partkey", F.array_join(taxa, ",").alias("taxa"), P.campaign(F.col("path")).alias("campaign_year"))


_BY_WORD = "CASE " + " ".join(f"WHEN {' OR '.join(f'''contains(lower(path), '{w}')''' for w in words)} THEN '{code}'" for code, _, words in P.COLLECTIONS) + " END"
_BY_PREFIX = "CASE " + " ".join(f"WHEN px IN ({', '.join(repr(p) for p in ps)}) THEN '{code}'" for code, ps, _ in P.COLLECTIONS if ps) + " END"


@query(f"WITH {_PARTS}, c AS (SELECT p_partkey, path, upper(regexp_extract(stem, '^([A-Za-z-]+)', 1)) AS px FROM s) SELECT p_partkey, coalesce({_BY_PREFIX}, {_BY_WORD}) AS collection FROM c")
def path_collections(part):
    prefix = S.extract(P.stem(F.col("path")), "^([A-Za-z-]+)")
    return _paths(part).select("p_partkey", P.collection(F.col("path"), prefix).alias("collection"))


@query(f"WITH {_PARTS} SELECT p_partkey, array_to_string(list_filter(regexp_extract_all(path, '[0-9]+'), lambda x: length(x) BETWEEN 5 AND 8), ',') AS numbers, array_to_string(list_filter(['Arthropoda', 'Insecta', 'Crustacea', 'Coleoptera', 'Odonata'], lambda n: contains(lower(path), lower(n))), ',') AS taxa FROM s")
def review_clues(part):
    clues = _paths(part).select("p_partkey", P.path_clues(F.col("path")).alias("c"))
    return clues.select("p_partkey", F.array_join("c.numbers", ",").alias("numbers"), F.array_join("c.taxa", ",").alias("taxa"))


@query("WITH n AS (SELECT p_partkey, 'x/2022_LH_' || CASE p_partkey % 3 WHEN 0 THEN substr(md5(CAST(p_partkey AS STRING)), 1, 8) WHEN 1 THEN 'ABCDEF0' || (p_partkey % 10) ELSE 'short' END || '.jpg' AS path FROM part) SELECT p_partkey, nullif(lower(regexp_extract(path, '_([0-9a-fA-F]{8})\\.[^.]+$', 1)), '') AS uuid8, substr(md5(path), 1, 8) AS short_id FROM n")
def short_ids(part):
    path = F.expr("'x/2022_LH_' || CASE p_partkey % 3 WHEN 0 THEN substr(md5(CAST(p_partkey AS STRING)), 1, 8) WHEN 1 THEN 'ABCDEF0' || (p_partkey % 10) ELSE 'short' END || '.jpg'")
    return part.select("p_partkey", P.uuid8(path).alias("uuid8"), P.short_id(path).alias("short_id"))


@query("SELECT event_id, (json_extract(props, '$.k'))::BIGINT AS k FROM events")
def fenced_json(events):
    """Answers that wrap their JSON in a fence, bare ones, and none that parse into something else."""
    answer = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Here it is:\n```json\n"), F.col("props"), F.lit("\n```\nDone."))).otherwise(F.col("props"))
    return events.select("event_id", P.parsed(answer, "k long")["k"].alias("k"))


# --- routing and names

_FILES = f"""SELECT {PATH} || CAST(p_partkey AS STRING) || CASE p_partkey % 4 WHEN 0 THEN '.JPG' WHEN 1 THEN '.png' WHEN 2 THEN '.svg' ELSE '.txt' END AS path, CASE WHEN p_partkey % 4 = 3 THEN CASE WHEN p_partkey % 8 = 3 THEN 'text' ELSE 'database' END ELSE 'image' END AS file_type,
 p_partkey % 13 = 0 AS needs_review, CASE WHEN p_partkey % 26 = 0 THEN 'odd: <name>?' WHEN p_partkey % 39 = 0 THEN '[]' END AS review_reason, p_partkey % 5 = 0 AS is_duplicate,
 CASE WHEN p_partkey % 10 = 0 THEN 'nowhere' WHEN p_partkey % 5 = 0 THEN 'first' END AS original, CASE WHEN p_partkey % 6 = 0 THEN 'Mollusca' END AS macroclass,
 CASE p_partkey % 9 WHEN 0 THEN 'Insecta' WHEN 1 THEN 'aves ' WHEN 2 THEN 'Unheard' END AS taxonomic_class, CASE WHEN p_partkey % 8 = 1 THEN 'Iberomesornis' END AS determination,
 CASE WHEN p_partkey % 7 < 3 THEN 'LH ' || CAST(p_partkey AS STRING) || '#a' END AS specimen_id, CASE WHEN p_partkey % 11 < 4 THEN 2000 + p_partkey % 20 END AS campaign_year,
 CASE p_partkey % 3 WHEN 0 THEN 'BUE' WHEN 1 THEN 'MON' ELSE 'LH' END AS collection, p_partkey FROM part"""
_CLASS = "CASE " + " ".join(f"WHEN lower(trim(taxonomic_class)) IN ({', '.join(repr(c.lower()) for c in classes)}) THEN '{m}'" for m, classes in P.MACROCLASSES.items()) + " END"
_safe = lambda t: f"regexp_replace(regexp_replace(regexp_replace({t}, '[^\\p{{L}}\\p{{N}}_\\-]+', '_', 'g'), '^_+|_+$', '', 'g'), '_+', '_', 'g')"


@query(
    f"""WITH f AS ({_FILES}), o AS (SELECT min(path) AS path FROM f), r AS (SELECT f.*, is_duplicate AND original = 'first' AS dup, CASE collection WHEN 'BUE' THEN 'Otras_Colecciones/Buenache' WHEN 'MON' THEN 'Otras_Colecciones/Montsec' END AS base, substr(md5(path), 1, 8) AS short,
    regexp_extract(path, '([^/]*)$', 1) AS name, lower(regexp_extract(path, '(\\.[^.]+)$', 1)) AS suffix FROM f)
    SELECT p_partkey, CASE WHEN file_type <> 'image' THEN concat_ws('/', base, CASE WHEN file_type = 'text' THEN 'Archivos_Texto' ELSE 'Otros_Archivos' END)
    WHEN needs_review THEN 'Revision_Manual/' || CASE WHEN review_reason = 'odd: <name>?' THEN 'odd name' ELSE 'Otro' END WHEN dup THEN 'Duplicados' WHEN macroclass IS NULL AND taxonomic_class IS NULL AND determination IS NULL AND specimen_id IS NULL AND campaign_year IS NULL THEN 'Casos_Perdidos_Generales'
    ELSE concat_ws('/', base, CASE WHEN campaign_year IS NULL THEN 'Sin_Campaña' ELSE 'Campaña_' || campaign_year END, coalesce(macroclass, {_CLASS}, 'Sin_Macroclase'), coalesce(trim(taxonomic_class), 'Sin_Clase'), coalesce(determination, 'Sin_Genero')) END AS folder,
    CASE WHEN file_type <> 'image' THEN short || '_' || regexp_replace(name, '[^\\p{{L}}\\p{{N}}_.\\-]', '_', 'g') ELSE concat_ws('_', coalesce(campaign_year::VARCHAR, '0000'), {_safe("coalesce(specimen_id, regexp_replace(name, '(.)\\.[^.]+$', '\\1'))")}, short) || CASE WHEN suffix IN ('.jpg', '.png') THEN '.jpg' ELSE suffix END END AS new_name, dup AS is_duplicate FROM r"""
)
def routed_files(part):
    made = part.selectExpr("*").selectExpr(*_spark_columns())
    first = made.agg(F.min("path").alias("first"))
    files = made.withColumn("_one", F.lit(1)).join(F.broadcast(first.withColumn("_one", F.lit(1))), "_one")  # one row
    files = files.withColumn("duplicate_of", F.when(F.col("original") == "first", F.col("first")).otherwise(F.col("original"))).drop("first", "original", "_one")
    return routing.route(files).select("p_partkey", "folder", "new_name", F.coalesce("is_duplicate", F.lit(False)).alias("is_duplicate"))


def _spark_columns() -> list[str]:
    """The select list of _FILES, which Spark reads as it is."""
    body, depth, out, word = _FILES[len("SELECT ") : _FILES.rindex(" FROM part")], 0, [], ""
    for piece in body.split(","):
        word = f"{word},{piece}" if word else piece
        depth = word.count("(") - word.count(")")
        if depth == 0 and word.count("'") % 2 == 0:
            out.append(word.strip())
            word = ""
    return out


_NAMED = "SELECT p_partkey, p_brand AS folder, CASE p_partkey % 4 WHEN 0 THEN 'a.jpg' WHEN 1 THEN 'a_1.jpg' WHEN 2 THEN 'b' ELSE 'a.b.png' END AS name FROM part"


@query(
    f"""WITH RECURSIVE n AS ({_NAMED}), k AS (SELECT *, row_number() OVER (PARTITION BY folder, name ORDER BY p_partkey) - 1 AS n FROM n),
    m AS (SELECT *, CASE WHEN name = 'a.jpg' AND n > 0 THEN n + CASE WHEN EXISTS (SELECT 1 FROM n AS o WHERE o.folder = k.folder AND o.name = 'a_1.jpg') THEN 1 ELSE 0 END ELSE n END AS no FROM k)
    SELECT p_partkey, CASE WHEN no = 0 THEN name WHEN name = 'b' THEN 'b_' || no ELSE regexp_replace(name, '\\.([^.]*)$', '_' || no || '.\\1') END AS unique_name FROM m"""
)
def unique_files(part):
    """Unique names with their number before the suffix, past a name that has such a number of its own."""
    return match.unique_names(part.selectExpr("p_partkey", "p_brand AS folder", "CASE p_partkey % 4 WHEN 0 THEN 'a.jpg' WHEN 1 THEN 'a_1.jpg' WHEN 2 THEN 'b' ELSE 'a.b.png' END AS name"), "name", "p_partkey", "folder").select("p_partkey", "unique_name")


@query("SELECT s_suppkey, 'OTH' || lpad((s_suppkey_rank + last)::VARCHAR, 6, '0') AS id FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_name, s_suppkey) AS s_suppkey_rank FROM supplier), (SELECT max(p_partkey) AS last FROM part)")
def next_ids(supplier, part):
    taken = part.select(F.format_string("OTH%06d", "p_partkey").alias("id"))
    return registry.with_ids(supplier.select("s_suppkey", "s_name"), taken, "OTH", "id", "s_name", "s_suppkey").select("s_suppkey", "id")


# --- registries

_MAIN = f"SELECT CAST(p_partkey AS STRING) AS uuid, 'a/' || {_K} || '.jpg; b/' || (p_partkey % 50) || '.jpg' AS original_path, 'out/2020_x_' || substr(md5(CAST(p_partkey AS STRING)), 1, 8) || '.jpg' AS current_path FROM part WHERE p_partkey % 2 = 0"
_DUPS = f"SELECT 'd' || p_partkey AS uuid, CASE p_partkey % 3 WHEN 0 THEN 'z/none.jpg; a/' || lpad(CAST(p_partkey + 1 AS STRING), 5, '0') || '.jpg' WHEN 1 THEN 'nan; q/x_' || substr(md5(CAST(p_partkey + 3 AS STRING)), 1, 8) || '.tif' ELSE '' END AS original_path, CASE WHEN p_partkey % 5 = 0 THEN 'out/y_' || substr(md5(CAST(p_partkey - 1 AS STRING)), 1, 8) || '.jpg' ELSE 'out/plain.jpg' END AS current_path FROM part WHERE p_partkey % 2 = 1"


def _columns(sql: str) -> list[str]:
    """The three columns of a statement of this section, as Spark reads them."""
    body = sql[len("SELECT ") : sql.index(" FROM part")]
    first, rest = body.split(" AS uuid, ")
    second, third = rest.split(" AS original_path, ")
    return [f"{first} AS uuid", f"{second} AS original_path", third]


@query(
    f"""WITH m AS ({_MAIN}), d AS ({_DUPS}), mp AS (SELECT trim(p) AS p, max(uuid) AS main FROM (SELECT uuid, unnest(string_split(original_path, ';')) AS p FROM m) GROUP BY 1), mi AS (SELECT regexp_extract(current_path, '_([0-9a-f]{{8}})\\.[^.]+$', 1) AS p, max(uuid) AS main FROM m GROUP BY 1),
    own AS (SELECT uuid, generate_subscripts(string_split(original_path, ';'), 1) AS place, trim(unnest(string_split(original_path, ';'))) AS p FROM d),
    c AS (SELECT own.uuid, 1 AS step, place, main FROM own JOIN mp USING (p) UNION ALL SELECT uuid, 2, 0, main FROM d JOIN mi ON mi.p = regexp_extract(current_path, '_([0-9a-f]{{8}})\\.[^.]+$', 1) UNION ALL SELECT own.uuid, 3, place, main FROM own JOIN mi ON mi.p = regexp_extract(own.p, '_([0-9a-f]{{8}})\\.[^.]+$', 1)),
    r AS (SELECT uuid, first(main ORDER BY step, place) AS main, first(step ORDER BY step, place) AS step FROM c GROUP BY uuid)
    SELECT d.uuid, coalesce(main, '__unmatched__') AS main, coalesce(step, 0)::INT AS step FROM d LEFT JOIN r ON r.uuid = d.uuid"""
)
def linked_duplicates(part):
    """All three steps, and duplicates without an original."""
    main, dups = part.filter("p_partkey % 2 = 0").selectExpr(*_columns(_MAIN)), part.filter("p_partkey % 2 = 1").selectExpr(*_columns(_DUPS))
    return registry.link_duplicates(dups, main)


@query("WITH f AS (SELECT md5(coalesce(text, '')) AS k, doc_id, source FROM documents), o AS (SELECT k, min(doc_id) AS first FROM f GROUP BY k) SELECT first AS doc_id, string_agg(DISTINCT source, '; ' ORDER BY source) AS sources FROM f JOIN o USING (k) WHERE source IS NOT NULL GROUP BY first")
def accumulated_sources(documents):
    """The sources of an original and of its copies."""
    first = documents.groupBy(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("k")).agg(F.min("doc_id").alias("first"))
    rows = documents.withColumn("k", F.md5(F.coalesce("text", F.lit("")).cast("binary"))).join(first, "k")
    rows = rows.select("doc_id", "source", F.when(F.col("first") != F.col("doc_id"), F.col("first")).alias("duplicate_of"))
    out = registry.with_all_paths(rows, "doc_id", "source")
    return out.select("doc_id", F.array_join(F.array_sort(F.split("all_paths", "; ")), "; ").alias("sources")).filter("sources <> ''")


@query("SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey * 8 + l_linenumber + l_partkey % 9 AS duplicate_of FROM lineitem AS a WHERE l_partkey % 9 > 0 AND NOT EXISTS (SELECT 1 FROM lineitem AS b WHERE b.l_orderkey * 8 + b.l_linenumber = a.l_orderkey * 8 + a.l_linenumber + a.l_partkey % 9)")
def orphan_duplicates(lineitem):
    rows = lineitem.selectExpr("l_orderkey * 8 + l_linenumber AS id", "CASE WHEN l_partkey % 9 > 0 THEN l_orderkey * 8 + l_linenumber + l_partkey % 9 END AS duplicate_of")
    return registry.orphans(rows, "id").select("id", "duplicate_of")


@query("SELECT user_id, first(event_type ORDER BY event_id DESC) AS verdict, max(event_id) AS event_id FROM events GROUP BY user_id")
def verdict_upsert(events):
    """The last verdict of each user, half of them stored and half new."""
    rows = events.select("user_id", F.col("event_type").alias("verdict"), "event_id")
    return registry.upsert(rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1"), "user_id", "event_id")


@query("SELECT d.doc_id, l.doc_id IS NOT NULL AS in_labels, e.vec_id IS NOT NULL AS in_vectors FROM documents AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id LEFT JOIN embeddings AS e ON e.vec_id = d.doc_id")
def key_probe(documents, labels, embeddings):
    return registry.probe(documents, "doc_id", in_labels=labels, in_vectors=embeddings.select(F.col("vec_id").alias("doc_id")))


@query("SELECT CASE WHEN x.doc_id IS NULL THEN 'right' WHEN y.doc_id IS NULL THEN 'left' ELSE 'both' END AS side, count(*) AS n FROM (SELECT DISTINCT doc_id FROM documents) AS x FULL JOIN (SELECT DISTINCT vec_id AS doc_id FROM embeddings) AS y ON x.doc_id = y.doc_id GROUP BY 1")
def compared_sides(documents, embeddings):
    right = embeddings.select(F.col("vec_id").alias("doc_id"))
    pairs = documents.join(right, "doc_id").select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    return registry.compare_sides(pairs, documents.select("doc_id").distinct(), right.distinct(), "doc_id").groupBy("side").agg(F.count("*").alias("n"))


@query(f"WITH f AS (SELECT p_partkey, '/staging/' || {PATH} AS path FROM part) SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'Duplicados/' || p_partkey || '.jpg' ELSE substr(path, 10) END AS path FROM f")
def rewritten_paths(part):
    rows = part.select("p_partkey", F.concat(F.lit("/staging/"), F.expr(PATH), F.lit("#"), F.col("p_partkey").cast("string")).alias("path"))
    moved = rows.filter("p_partkey % 6 = 0").select("path", F.expr("'/out/Duplicados/' || p_partkey || '.jpg'").alias("new_path"))
    out = registry.rewrite_paths(rows, "path", "/staging/", "/out/", moved)
    return out.select("p_partkey", F.regexp_replace("path", "#.*", "").alias("path"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY CASE WHEN c_custkey % 5 = 0 THEN '￿' ELSE lower(c_mktsegment) END, CASE WHEN c_custkey % 3 = 0 THEN repeat('z', 16) WHEN c_custkey % 7 = 0 THEN '' ELSE substr(md5(c_name), 1, 16) END, c_custkey) AS rn FROM customer")
def reviewed_in_order(customer):
    rows = customer.select("c_custkey", F.expr("CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment || '/' || c_name || '.jpg; other/x.jpg' END").alias("paths"))
    hashes = customer.filter("c_custkey % 3 <> 0").select("c_custkey", F.expr("CASE WHEN c_custkey % 7 <> 0 THEN substr(md5(c_name), 1, 16) END").alias("phash"))
    return registry.review_order(rows, hashes, "c_custkey", "paths", "phash").select("c_custkey", "rn")


@query("SELECT coalesce(CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'bad' END, 'pending') AS verdict, count(*) AS n FROM documents AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id GROUP BY 1")
def review_statistics(documents, labels):
    return audit.review_statistics(documents, labels.select("doc_id", F.expr("CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'bad' END").alias("verdict")), "doc_id", "verdict")


# --- audits

_TREE = """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'Duplicados/' WHEN 1 THEN 'Archivos_Texto/' WHEN 2 THEN 'Otros_Archivos/' WHEN 3 THEN 'Revision_Manual/x/' WHEN 4 THEN 'logs/' WHEN 5 THEN '' WHEN 6 THEN 'Campaña_2020/Insects/Insecta/' ELSE 'Sin_Campaña/' || p_type || '/' || p_brand || '/' END || 'f' || p_partkey || CASE p_partkey % 3 WHEN 0 THEN '.jpg' WHEN 1 THEN '.txt' ELSE '.xlsx' END AS rel, CASE p_partkey % 3 WHEN 0 THEN 'image' WHEN 1 THEN 'text' ELSE 'spreadsheet' END AS type FROM part"""


def _tree(part):
    rel, kind = _TREE[len("SELECT p_partkey, ") : -len(" FROM part")].split(" AS rel, ")
    return part.select("p_partkey", F.expr(rel).alias("rel"), F.expr(kind.removesuffix(" AS type")).alias("type"))


_COUNTED = f"WITH t AS ({_TREE}), k AS (SELECT CASE p_partkey % 8 WHEN 0 THEN CASE type WHEN 'image' THEN 'duplicate' WHEN 'text' THEN 'text' ELSE 'other' END WHEN 1 THEN CASE WHEN type = 'text' THEN 'text' ELSE 'other' END WHEN 2 THEN 'other' WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE CASE WHEN type = 'image' THEN 'main' END END AS kind FROM t)"


@query(f"{_COUNTED}, g AS (SELECT kind, count(*) AS structure FROM k WHERE kind IS NOT NULL GROUP BY 1), r AS (SELECT 'main' AS kind, (SELECT count(*) FROM supplier) AS registry UNION ALL SELECT 'ghost', (SELECT count(*) FROM nation) UNION ALL SELECT 'total', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation)) SELECT kind, coalesce(structure, 0) AS structure, coalesce(registry, 0) AS registry, coalesce(structure, 0) - coalesce(registry, 0) AS difference FROM g FULL JOIN r USING (kind)")
def structure_audit(part, supplier, nation):
    """Counts by the folder rules against registries; kinds of either side."""
    return audit.discrepancies(audit.structure(_tree(part)), audit.registry_counts(main=supplier, ghost=nation))


@query(f"WITH t AS ({_TREE}), c AS (SELECT regexp_extract(rel, '^([^/]+)/', 1) AS name, type FROM t) SELECT name, count(*) AS n FROM c WHERE name IN ('Archivos_Texto', 'Otros_Archivos') OR (name IN ('Duplicados', 'Campaña_2020', 'Sin_Campaña') AND type <> 'spreadsheet') GROUP BY 1")
def collection_distribution(part):
    return audit.by_collection(_tree(part))


@query(f"WITH t AS ({_TREE}) SELECT regexp_extract(rel, '^[^/]+/[^/]+/([^/]+)/', 1) AS name, count(*) AS n FROM t WHERE p_partkey % 8 >= 6 GROUP BY 1 ORDER BY 1 LIMIT 15")
def class_distribution_first15(part):
    """The first 15 classes by name; the limit is the report's."""
    return audit.by_level(_tree(part), "rel", 2, first=15)


@query(f"WITH t AS ({_TREE}) SELECT regexp_extract(rel, '^[^/]+/([^/]+)/', 1) AS level1, regexp_extract(rel, '^[^/]+/[^/]+/([^/]+)/', 1) AS level2, count(*) AS n FROM t WHERE p_partkey % 8 >= 6 GROUP BY ALL")
def nested_distribution(part):
    return audit.nested_levels(_tree(part), "rel", 1, 2)


@query(f"WITH t AS ({_TREE}) SELECT count(*) AS total, count_if(type = 'image')::BIGINT AS images, count_if(type <> 'image')::BIGINT AS others FROM t WHERE p_partkey % 8 = 0")
def duplicates_breakdown(part):
    return audit.duplicates_folder(_tree(part))


@query("SELECT DISTINCT 'lang' AS field, lang AS value FROM documents WHERE trim(lang) <> '' UNION SELECT DISTINCT 'source', source FROM documents WHERE trim(source) <> ''")
def taxonomy_labels(documents):
    return audit.taxonomy(["lang", "source"], documents.filter("doc_id % 2 = 0"), documents.filter("doc_id % 2 = 1"))


@query(
    """WITH p AS (SELECT 'missing_hash' AS problem, doc_id::VARCHAR AS key FROM documents ANTI JOIN labels USING (doc_id) UNION ALL SELECT 'missing_row', doc_id::VARCHAR FROM labels ANTI JOIN documents USING (doc_id) UNION ALL SELECT 'leaked_duplicate', doc_id::VARCHAR FROM (SELECT doc_id FROM documents WHERE lang = 'de') SEMI JOIN labels USING (doc_id)),
    r AS (SELECT *, row_number() OVER (PARTITION BY problem ORDER BY key) AS r FROM p), k AS (SELECT unnest(['missing_hash', 'missing_row', 'leaked_duplicate']) AS problem),
    o AS (SELECT problem, count(key) AS n, coalesce(string_agg(key, ',' ORDER BY key) FILTER (r <= 20), '') AS first FROM k LEFT JOIN r USING (problem) GROUP BY problem)
    SELECT problem, n, first, n = 0 AS passed FROM o UNION ALL SELECT 'all', sum(n)::BIGINT, '', sum(n) = 0 FROM o"""
)
def integrity_report(documents, labels):
    out = audit.integrity_report(documents.select("doc_id"), labels.select("doc_id"), documents.filter("lang = 'de'").select("doc_id"), "doc_id")
    return out.withColumn("first", F.array_join("first", ","))


@query("WITH a AS (SELECT doc_id FROM documents WHERE doc_id % 3 <> 2), b AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0), s AS (SELECT doc_id FROM a UNION SELECT doc_id FROM b), m AS (SELECT DISTINCT doc_id FROM labels), o AS (SELECT 'source_a' AS part, (SELECT count(*) FROM a) AS n UNION ALL SELECT 'source_b', (SELECT count(*) FROM b) UNION ALL SELECT 'distinct', (SELECT count(*) FROM s) UNION ALL SELECT 'merged', (SELECT count(*) FROM m) UNION ALL SELECT 'missing', (SELECT count(*) FROM s ANTI JOIN m USING (doc_id)) UNION ALL SELECT 'new', (SELECT count(*) FROM m ANTI JOIN s USING (doc_id)) UNION ALL SELECT 'justified', (SELECT count(*) FROM (SELECT * FROM s ANTI JOIN m USING (doc_id)) SEMI JOIN (SELECT doc_id FROM documents WHERE lang = 'de') USING (doc_id))) SELECT * FROM o UNION ALL SELECT 'equal_totals', (max(CASE WHEN part = 'distinct' THEN n END) - max(CASE WHEN part = 'merged' THEN n END) = 0)::BIGINT FROM o UNION ALL SELECT 'preserved', (max(CASE WHEN part = 'missing' THEN n END) - max(CASE WHEN part = 'justified' THEN n END) = 0)::BIGINT FROM o")
def preservation_report(documents, labels):
    parts = {"a": documents.filter("doc_id % 3 <> 2"), "b": documents.filter("doc_id % 2 = 0")}
    return audit.preservation_report(parts, labels.select("doc_id"), documents.filter("lang = 'de'"), "doc_id")


@query("SELECT count(*) AS n_files, sum(n_chars)::BIGINT AS total_size, count_if(lang = 'en')::BIGINT AS n_images, count(text) - count(DISTINCT md5(text)) AS n_copies FROM documents")
def scan_summary(documents):
    rows = documents.select("n_chars", F.when(F.col("lang") == "en", "image").otherwise("text").alias("type"), F.md5(F.col("text").cast("binary")).alias("digest"))
    return audit.scan_summary(rows, "n_chars", "type", "digest")


@query("SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM documents WHERE lang IS NULL) AS without_phash, (SELECT count(*) FROM (SELECT 1 FROM documents WHERE text IS NOT NULL GROUP BY md5(text) HAVING count(*) > 1)) AS digest_groups, (SELECT count(*) FROM (SELECT 1 FROM documents WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) > 1)) AS lang_groups")
def hash_coverage(documents):
    return audit.coverage(documents.select(F.md5(F.col("text").cast("binary")).alias("digest"), "lang"), "digest", "lang")


@query(f"WITH f AS (SELECT {PATH} AS path FROM part) SELECT regexp_replace(path, '/[^/]*$', '') AS folder, count(*) AS n, array_to_string(list_slice(list_sort(list_distinct(list(regexp_extract(path, '([^/]*)$', 1)))), 1, 20), '|') AS sample FROM f GROUP BY 1")
def files_by_folder(part):
    return audit.by_folder(_paths(part), "path").select("folder", "n", F.array_join("sample", "|").alias("sample"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'match' WHEN 2 THEN 'partial' ELSE 'mismatch' END AS verdict FROM part")
def compared_fields(part):
    others = F.expr("CASE p_partkey % 4 WHEN 0 THEN array(' ', 'nan') WHEN 1 THEN array('zz', upper(p_name)) WHEN 2 THEN array(p_name || ' plus') ELSE array('zz', 'yy') END")
    return part.select("p_partkey", S.compare_field(F.col("p_name"), others).alias("verdict"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Metadata_Conflicts' WHEN 1 THEN 'Merge_File_Collisions' ELSE 'Other_Review' END AS folder, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN p_brand WHEN 2 THEN 'own' ELSE p_type END AS value FROM part")
def decided_values(part):
    kind = F.expr("CASE p_partkey % 3 WHEN 0 THEN 'metadata_conflict' WHEN 1 THEN 'merge_file_collision' ELSE 'strange' END")
    token = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'brand' WHEN 2 THEN 'custom' ELSE 'defer' END")
    value = resolve.apply_token(token, {"brand": F.col("p_brand")}, F.col("p_type"), F.lit("own"))
    return part.select("p_partkey", resolve.review_folder(kind).alias("folder"), value.alias("value"))


@query("WITH h AS (SELECT vec_id, substr(md5((vec_id // 8)::VARCHAR), 1, 15) || (vec_id % 4)::VARCHAR AS h FROM embeddings), p AS (SELECT a.vec_id, b.vec_id AS near, bit_count(xor(('0x' || a.h[16:16])::BIGINT, ('0x' || b.h[16:16])::BIGINT))::INT AS dist FROM h AS a JOIN h AS b ON a.h[1:15] = b.h[1:15] AND a.h <> b.h) SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, near)::INT AS rank FROM p")
def near_by_distance(embeddings):
    """Eight neighbours in number share all digits of a hash but the last."""
    rows = embeddings.select("vec_id", F.expr("substr(md5(CAST(vec_id div 8 AS STRING)), 1, 15) || CAST(vec_id % 4 AS STRING)").alias("h"))
    return fingerprint.neighbours(rows, rows, 3, "vec_id", "h")

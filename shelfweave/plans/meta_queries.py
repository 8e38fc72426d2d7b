"""The field-settings catalogue and scalar text jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfweave.functions import scalars as S
from shelfweave.functions import fixed_values as fv
from shelfweave.functions.urls import normalize_urls
from shelfweave.operators import metas as M
from shelfweave.operators import search as R
from shelfweave.operators.product import PRODUCT
from shelfweave.plans import oracle_views as V
from shelfweave.plans.registry import query

_SETTINGS = "alias, code, meta_type, elastic_type, enabled, searchable, aggregatable, weight, position, operator, display_type, result_limit"


@query("all_metas", """SELECT l.id_lang, string_agg(concat(m.code, m.meta_type, '=', l.name), '|' ORDER BY concat(m.code, m.meta_type)) FILTER (WHERE m.id IS NOT NULL) AS metas,
    count(*) AS labels, CAST(sum(CASE WHEN m.id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS orphans FROM meta m RIGHT JOIN meta_lang l ON l.id = m.id GROUP BY 1""")
def _(c):
    """Per language the map of labels, and how many labels belong to no stored field."""
    rows = M.all_metas(c.meta, c.meta_lang)
    counts = rows.groupBy("id_lang").agg(F.count(F.lit(1)).alias("labels"), F.sum(F.col("code").isNull().cast("int")).alias("orphans"))
    maps = M.metas_by_language(c.meta, c.meta_lang)
    text = F.array_join(F.array_sort(F.transform(F.map_entries("metas"), lambda e: F.concat_ws("=", e["key"], e["value"]))), "|")
    return counts.join(maps.select("id_lang", text.alias("metas")), "id_lang", "left")


@query("meta_name", "SELECT m.alias, l.id_lang, l.name FROM meta m JOIN meta_lang l ON l.id = m.id")
def _(c):
    return M.meta_names(c.meta, c.meta_lang)


@query("searchable_fields", """SELECT concat(alias, '^', CAST(CAST(weight AS INT) AS VARCHAR)) AS field FROM meta WHERE searchable AND elastic_type = 'text'
    UNION ALL SELECT 'name' WHERE NOT EXISTS (SELECT 1 FROM meta WHERE searchable AND elastic_type = 'text' AND alias = 'name')""")
def _(c):
    return M.searchable_fields(c.meta)


@query("alias_lookup", """SELECT string_agg(concat(code, '=', alias), '|' ORDER BY code) AS aliases FROM meta WHERE meta_type = 'feature' AND code IN ('frame-size', 'material-kind', 'condition')""")
def _(c):
    found = M.alias_lookup(c.meta, ["frame-size", "material-kind", "condition"], "feature")
    return found.select(F.array_join(F.transform(F.map_entries("aliases"), lambda e: F.concat_ws("=", e["key"], e["value"])), "|").alias("aliases"))


def _all_properties_sql() -> str:
    def text(v):
        return "NULL" if v is None else f"'{v}'"

    rows = ", ".join(
        f"({i}, '{a.name}', {text(a.type)}, {'NULL' if not a.allowed_types else '[' + ', '.join(text(t) for t in a.allowed_types) + ']'}, {str(a.visible).lower()})"
        for i, a in enumerate(PRODUCT.attributes)
    )
    return f"""SELECT code, meta_type, alias, name, position, weight, searchable, enabled, aggregatable, operator, display_type, result_limit, elastic_type, visible FROM (
        SELECT u.code, u.meta_type, coalesce(m.alias, '') AS alias, coalesce(m.name, u.label) AS name, coalesce(m.position, 0) AS position,
            coalesce(m.weight, CAST(1 AS FLOAT)) AS weight, coalesce(m.searchable, false) AS searchable, coalesce(m.enabled, false) AS enabled,
            coalesce(m.aggregatable, false) AS aggregatable, coalesce(m.operator, 0) AS operator, coalesce(m.display_type, 0) AS display_type,
            coalesce(m.result_limit, 0) AS result_limit,
            CASE WHEN u.meta_type <> 'property' THEN coalesce(m.elastic_type, 'text')
                 WHEN u.allowed IS NULL OR list_contains(u.allowed, coalesce(m.elastic_type, 'text')) THEN coalesce(m.elastic_type, 'text')
                 ELSE coalesce(u.type, u.allowed[1]) END AS elastic_type, u.visible,
            row_number() OVER (PARTITION BY u.code ORDER BY CASE WHEN coalesce(m.position, 0) > 0 THEN 0 ELSE 1 END, u.source, u.within) AS k
        FROM (
            SELECT 0 AS source, lpad(CAST(ord AS VARCHAR), 9, '0') AS within, code, 'property' AS meta_type, code AS label, type, allowed, visible
                FROM (VALUES {rows}) p(ord, code, type, allowed, visible)
            UNION ALL SELECT 1, name, {V.slug('name')}, 'feature', name, NULL, NULL,
                coalesce((SELECT any_value(visible) FROM (VALUES {rows}) p(ord, code, type, allowed, visible) WHERE p.code = {V.slug('name')}), true) FROM feature_name
            UNION ALL SELECT 2, g.name, {V.slug('g.name')}, 'attribute', g.name, NULL, NULL, true FROM attribute_group g) u
        LEFT JOIN (SELECT meta.*, meta_lang.name FROM meta JOIN meta_lang ON meta_lang.id = meta.id WHERE meta_lang.id_lang = 2) m ON m.code = u.code AND m.meta_type = u.meta_type) x
    WHERE k = 1"""


@query("all_properties", _all_properties_sql())
def _(c):
    declared = M.property_definitions(c.spark, PRODUCT)
    groups = M.attribute_groups(c.attribute_group, c.attribute)
    return M.all_properties(declared, c.feature_name, groups, c.meta, c.meta_lang, 2).drop("source", "within")


def _catalogue_sql() -> str:
    """Names of all active languages, declared types and the order, for language 2 and shop 1."""
    def text(v):
        return "NULL" if v is None else f"'{v}'"

    rows = ", ".join(f"({i}, '{a.name}', {'NULL' if not a.allowed_types else '[' + ', '.join(text(t) for t in a.allowed_types) + ']'})" for i, a in enumerate(PRODUCT.attributes))
    return f"""SELECT * FROM (WITH declared AS (SELECT * FROM (VALUES {rows}) p(ord, code, allowed)),
        source AS (SELECT 0 AS source, lpad(CAST(ord AS VARCHAR), 9, '0') AS within, code, 'property' AS meta_type, code AS label FROM declared
            UNION ALL SELECT 1, name, {V.slug('name')}, 'feature', name FROM feature_name
            UNION ALL SELECT 2, concat_ws('|', attribute_group, lpad(CAST(coalesce(position, 0) AS VARCHAR), 9, '0')), {V.slug('attribute_group')}, 'attribute', attribute_group
                FROM group_named WHERE id_shop = 1 AND id_lang = 2 AND id IS NOT NULL),
        kept AS (SELECT * FROM (SELECT s.*, coalesce(m.position, 0) AS position,
                row_number() OVER (PARTITION BY s.code ORDER BY CASE WHEN coalesce(m.position, 0) > 0 THEN 0 ELSE 1 END, s.source, s.within) AS k
            FROM source s LEFT JOIN (SELECT meta.* FROM meta JOIN meta_lang ON meta_lang.id = meta.id WHERE meta_lang.id_lang = 2) m ON m.code = s.code AND m.meta_type = s.meta_type) x WHERE k = 1),
        named AS (SELECT kept.code, kept.meta_type, string_agg(concat(CAST(lang.id_lang AS VARCHAR), '=', coalesce(n.name, kept.label)), '|' ORDER BY lang.id_lang) AS names
            FROM kept CROSS JOIN (SELECT * FROM lang WHERE active) lang LEFT JOIN (SELECT meta.code, meta.meta_type, meta_lang.id_lang, meta_lang.name FROM meta JOIN meta_lang ON meta_lang.id = meta.id) n
                ON n.code = kept.code AND n.meta_type = kept.meta_type AND n.id_lang = lang.id_lang GROUP BY 1, 2)
    SELECT kept.code, kept.meta_type, kept.position, CAST(row_number() OVER (ORDER BY kept.position = 0, kept.position, kept.source, kept.within, kept.code) AS INT) AS place,
        array_to_string(declared.allowed, ',') AS elastic_types, false AS type_configurable, named.names
    FROM kept JOIN named ON named.code = kept.code AND named.meta_type = kept.meta_type LEFT JOIN declared ON declared.code = kept.code) c"""


@query("property_catalogue", _catalogue_sql())
def _(c):
    groups = M.translated_groups(c.attribute_group, c.attribute_group_lang, c.attribute, c.attribute_group_shop, c.attribute_shop, c.lang)
    here = groups.filter("id_shop = 1 AND id_lang = 2 AND id IS NOT NULL")
    found = M.property_catalogue(M.property_definitions(c.spark, PRODUCT), c.feature_name, here, c.meta, c.meta_lang, c.lang, 2)
    text = F.array_join(F.transform(F.map_entries("names"), lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"])), "|")
    return found.select("code", "meta_type", "position", "place", F.array_join("elastic_types", ",").alias("elastic_types"), "type_configurable", text.alias("names"))


@query("renamed_fields", """SELECT CAST(max(CASE WHEN code = 'name' THEN alias END) AS VARCHAR) AS name_alias, CAST(max(CASE WHEN code = 'price' THEN alias END) AS VARCHAR) AS price_alias,
    (SELECT count(*) FROM product_lang) AS documents, (SELECT count(DISTINCT name) FROM product_lang) AS names FROM meta WHERE meta_type = 'property' AND code IN ('name', 'price')""")
def _(c):
    """Product texts with their fields under the stored aliases; the new names are read off the result."""
    docs = c.product_lang.select("id_product", "name", F.lit(1.0).alias("price"))
    renamed = M.rename_by_alias(docs, c.meta, ["name", "price"])
    return renamed.agg(
        F.lit(renamed.columns[1]).alias("name_alias"), F.lit(renamed.columns[2]).alias("price_alias"), F.count(F.lit(1)).alias("documents"),
        F.count_distinct(renamed.columns[1]).alias("names"),
    )


@query("save_metas_dedupe", """SELECT alias, ord, CAST(row_number() OVER (ORDER BY ord) AS INT) AS position FROM (
    SELECT alias, min(ord) AS ord FROM meta_edit GROUP BY 1) d""")
def _(c):
    return M.dedupe_metas(c.meta_edit).select("alias", "ord", "position")


_SAVED = f"""SELECT coalesce(s.id, (SELECT max(id) FROM meta_store) + row_number() OVER (PARTITION BY s.id IS NULL ORDER BY n.ord)) AS id,
        coalesce(n.alias, s.alias) AS alias, coalesce(s.code, n.code) AS code, coalesce(s.meta_type, n.meta_type) AS meta_type,
        coalesce(n.elastic_type, s.elastic_type) AS elastic_type, coalesce(n.enabled, s.enabled) AS enabled, coalesce(n.searchable, s.searchable) AS searchable,
        coalesce(n.aggregatable, s.aggregatable) AS aggregatable, coalesce(n.weight, s.weight) AS weight, CAST(coalesce(s.position, n.position) AS BIGINT) AS position,
        coalesce(n.operator, s.operator) AS operator, coalesce(n.display_type, s.display_type) AS display_type, coalesce(n.result_limit, s.result_limit) AS result_limit
    FROM meta_store s FULL JOIN (
        SELECT *, row_number() OVER (ORDER BY ord) AS position FROM (
            SELECT *, row_number() OVER (PARTITION BY alias ORDER BY ord) AS k FROM meta_edit) d WHERE k = 1) n ON n.code = s.code AND n.meta_type = s.meta_type"""


def saved(c):
    return M.save_metas(c.meta_store, c.meta_edit).withColumn("position", F.col("position").cast("bigint"))


@query("save_metas", f"SELECT id, {_SETTINGS} FROM ({_SAVED}) s")
def _(c):
    return saved(c)


@query("save_metas_lang", f"""SELECT s.id, l.id_lang, concat(upper(s.alias), ' ', l.iso_code) AS name FROM (SELECT alias, min(id) AS id FROM ({_SAVED}) x GROUP BY 1) s
    JOIN (SELECT DISTINCT alias FROM meta_edit WHERE ord % 2 = 0) e ON e.alias = s.alias CROSS JOIN lang l""")
def _(c):
    from shelfweave.operators.relational import spread

    labels = spread(c.meta_edit.filter("ord % 2 = 0").select("alias").distinct(), c.lang.select("id_lang", "iso_code"))
    named = labels.select("alias", "id_lang", F.concat(F.upper("alias"), F.lit(" "), F.col("iso_code")).alias("name"))
    return M.save_labels(saved(c), named)


@query("label_catalog", """SELECT id_file, f.code, x.iso_code, json_extract_string(body, '$."' || f.code || '"."' || x.iso_code || '"') AS label
    FROM (SELECT id_file, body, unnest(json_keys(body)) AS code FROM label_json) f CROSS JOIN (SELECT 'en' AS iso_code UNION ALL SELECT 'nl') x
    WHERE json_extract_string(body, '$."' || f.code || '"."' || x.iso_code || '"') IS NOT NULL""")
def _(c):
    return M.label_catalog(c.label_json)


# --- scalar jobs ---------------------------------------------------------------------------------

@query("slugify", f"SELECT id, {V.slug('title')} AS slug FROM title_text")
def _(c):
    return c.title_text.select("id", S.slugify(F.col("title")).alias("slug"))


@query("date_parse", """SELECT id, CASE WHEN text LIKE 'on %' THEN NULL WHEN length(text) = 10 AND text LIKE '____-__-__' THEN CAST(strptime(text, '%Y-%m-%d') AS TIMESTAMP)
    WHEN text LIKE '____-__-__ __:__:__' THEN CAST(strptime(text, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) ELSE epoch_ms(CAST(text AS BIGINT)) END AS parsed FROM date_text""")
def _(c):
    return c.date_text.select("id", S.parse_date(F.col("text")).alias("parsed"))


_URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?//(?:([^/?#@]*)@)?(\[[0-9A-Fa-f:.]+\]|[^/?#:@\[\]]*)(?::([0-9]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


@query("normalize_urls", rf"""SELECT page_id, scheme, host, port, path, concat(scheme, '://', host, ':', port, path,
        CASE WHEN q <> '' THEN concat('?', url_encode(url_decode(substring(q, 2)))) ELSE '' END, CASE WHEN f <> '' THEN concat('#', url_encode(url_decode(substring(f, 2)))) ELSE '' END) AS normalized
    FROM (SELECT page_id, CASE WHEN u.s = '' THEN 'http' ELSE lower(u.s) END AS scheme, u.h AS host,
            CASE WHEN u.n <> '' THEN u.n WHEN lower(u.s) = 'https' THEN '443' ELSE '80' END AS port,
            replace(url_encode(url_decode(u.p)), '%2F', '/') AS path, u.q, u.f
        FROM (SELECT page_id, regexp_extract(url, '{_URL}', ['s', 'i', 'h', 'n', 'p', 'q', 'f']) AS u FROM pages) x) y WHERE host <> ''""")
def _(c):
    return normalize_urls(c.raw("pages").select("page_id", "url")).drop("url")


@query("stopword_lang", f"""SELECT s.id_shop, l.id_lang, CASE lower(l.iso_code) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in fv.STOPWORD_SETS.items())} ELSE '_english_' END AS stop_words
    FROM shop s CROSS JOIN lang l WHERE l.active""")
def _(c):
    return R.stop_word_sets(c.shop, c.lang, S.stop_word_set(F.col("iso_code")))

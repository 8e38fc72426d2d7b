"""Text analysis, search and facets."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfweave.functions import analyzers as A
from shelfweave.functions import fixed_values as fv
from shelfweave.functions.scalars import fold_accents
from shelfweave.operators import facets as X
from shelfweave.operators import metas as M
from shelfweave.operators import product as P
from shelfweave.operators import search as R
from shelfweave.functions import scalars as S
from shelfweave.plans import oracle_views as V
from shelfweave.plans.registry import query

_STOP = "[" + ", ".join(f"'{w}'" for w in fv.ENGLISH_STOP_WORDS) + "]"


def per_document(tokens):
    def build(c):
        return c.texts.select("doc_id", F.array_join(tokens(F.col("text")), "|").alias("tokens"))

    return build


def _sql(tokens: str) -> str:
    return f"SELECT doc_id, array_to_string({tokens}, '|') AS tokens FROM documents"


def _shingle_sql(t: str) -> str:
    def run(n: int) -> str:
        return f"list_transform(range(1, greatest(1, len({t}) - {n - 2})), lambda i: array_to_string(list_slice({t}, i, i + {n - 1}), ' '))"

    return f"list_concat({t}, {run(2)}, {run(3)})"


query("tokens_standard", _sql(f"list_filter({V.words('lower(text)')}, lambda t: NOT list_contains({_STOP}, t))"))(
    per_document(lambda c: A.standard(c, fv.ENGLISH_STOP_WORDS))
)


@query("tokens_shingle", f"SELECT doc_id, array_to_string({_shingle_sql('t')}, '|') AS tokens FROM (SELECT doc_id, {V.words('lower(text)')} AS t FROM documents) d")
def _(c):
    words = c.texts.select("doc_id", A.word_tokens(F.lower("text")).alias("words"))
    return words.select("doc_id", F.array_join(A.shingles(F.col("words")), "|").alias("tokens"))


query("tokens_reverse", _sql(f"list_transform({V.words('text')}, lambda t: reverse(t))"))(per_document(A.reversed_words))
query("tokens_edge_ngram", _sql(
    "flatten(list_transform(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{Nd}\\p{P}]+'), lambda t: length(t) >= 2), "
    "lambda t: list_transform(range(2, least(10, length(t)) + 1), lambda i: substring(t, 1, i))))"
))(per_document(A.edge_grams))
query("tokens_lowercase", _sql("list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda t: t <> '')"))(per_document(A.letter_tokens))

_STEMMED = f"""SELECT doc_id, list(token ORDER BY pos) AS t FROM (
        SELECT d.doc_id, d.pos, d.lang, coalesce(s.stem, d.form) AS token FROM (
            SELECT doc_id, lang, unnest({V.blanks('lower(text)')}) AS form, generate_subscripts({V.blanks('lower(text)')}, 1) AS pos FROM documents) d
        LEFT JOIN stem_dict s ON s.form = d.form) x
    WHERE NOT EXISTS (SELECT 1 FROM stop_word w WHERE w.lang = x.lang AND w.token = x.token) GROUP BY 1"""


def _stem_sql(tokens: str) -> str:
    return f"SELECT documents.doc_id, coalesce(array_to_string({tokens}, '|'), '') AS tokens FROM documents LEFT JOIN ({_STEMMED}) s ON s.doc_id = documents.doc_id"


def _stemmed(c, fold: bool = False):
    return R.stemmed(c.texts, "doc_id", "text", c.stem_dict, c.stop_word, on=("lang",), fold=fold)


@query("tokens_stem_stop", _stem_sql("t"))
def _(c):
    return _stemmed(c).select("doc_id", F.array_join("tokens", "|").alias("tokens"))


@query("tokens_ascii_fold", _stem_sql(f"list_transform(t, lambda w: {V.fold('w')})"))
def _(c):
    return _stemmed(c, fold=True).select("doc_id", F.array_join("tokens", "|").alias("tokens"))


@query("tokens_stem_shingle", _stem_sql(_shingle_sql("t")))
def _(c):
    return _stemmed(c).select("doc_id", F.array_join(A.shingles(F.col("tokens")), "|").alias("tokens"))


@query("stopword_removal", """SELECT doc_id, token, count(*) AS n FROM doc_token t WHERE NOT EXISTS (SELECT 1 FROM stop_word w WHERE w.lang = t.lang AND w.token = t.token) GROUP BY 1, 2""")
def _(c):
    """Tokens of each document that are no stop words of its language, with their counts."""
    kept = R.remove_stop_words(c.doc_token, c.stop_word)
    return kept.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


_FIELDS_SQL = f"""SELECT 'title' AS field, doc_id, unnest({V.words("lower(split_part(text, chr(10), 1))")}) AS term FROM documents
    UNION ALL SELECT 'content', doc_id, unnest({V.words('lower(text)')}) FROM documents"""


def _text_fields():
    return {"title": A.word_tokens(F.lower(F.split_part("text", F.lit("\n"), F.lit(1)))), "content": A.word_tokens(F.lower("text"))}


@query("term_postings", f"""SELECT p.field, p.term, doc_id, tf, df FROM (SELECT field, term, doc_id, count(*) AS tf FROM ({_FIELDS_SQL}) t GROUP BY 1, 2, 3) p
    JOIN (SELECT field, term, count(DISTINCT doc_id) AS df FROM ({_FIELDS_SQL}) t GROUP BY 1, 2) d ON d.field = p.field AND d.term = p.term""")
def _(c):
    return R.term_postings(c.texts, "doc_id", _text_fields())


def _searched(c):
    """Product texts as one searchable row per translation."""
    names = c.manufacturer.select("id_manufacturer", F.col("name").alias("brand"))
    rows = c.product_lang.join(c.product.select("id_product", "id_manufacturer", "reference"), "id_product").join(names, "id_manufacturer", "left")
    return rows.select((F.col("id_product") * 10 + F.col("id_lang")).alias("doc"), "name", "description", F.concat_ws(" ", "brand", "reference").alias("brand"))


_SEARCHED_SQL = f"""SELECT 'name' AS field, l.id_product * 10 + l.id_lang AS doc, unnest({V.words('lower(l.name)')}) AS term FROM product_lang l
    UNION ALL SELECT 'description', l.id_product * 10 + l.id_lang, unnest({V.words('lower(l.description)')}) FROM product_lang l
    UNION ALL SELECT 'brand', l.id_product * 10 + l.id_lang, unnest({V.words("lower(concat(m.name, ' ', p.reference))")}) FROM product_lang l
        JOIN product p ON p.id_product = l.id_product LEFT JOIN manufacturer m ON m.id_manufacturer = p.id_manufacturer"""
_ASKED_SQL = f"SELECT DISTINCT p_name AS id_query, unnest({V.words('lower(p_name)')}) AS term FROM part"


@query("multi_match", f"""SELECT id_query, doc, score, rank FROM (
    SELECT id_query, doc, score, CAST(row_number() OVER (PARTITION BY id_query ORDER BY score DESC, doc) AS INT) AS rank FROM (
        SELECT id_query, doc, CAST(max(part) AS DOUBLE) AS score FROM (
            SELECT q.id_query, h.doc, h.field, sum(CAST(round(CAST(w.weight AS DOUBLE) * ln(1 + n.n / CAST(f.df AS DOUBLE)) * h.tf, 6) AS DECIMAL(24,6))) AS part
            FROM ({_ASKED_SQL}) q JOIN (SELECT field, term, doc, count(*) AS tf FROM ({_SEARCHED_SQL}) t GROUP BY 1, 2, 3) h ON h.term = q.term
            JOIN (SELECT field, term, count(DISTINCT doc) AS df FROM ({_SEARCHED_SQL}) t GROUP BY 1, 2) f ON f.field = h.field AND f.term = h.term
            JOIN (SELECT 'name' AS field, 3 AS weight UNION ALL SELECT 'description', 1 UNION ALL SELECT 'brand', 2) w ON w.field = h.field
            CROSS JOIN (SELECT count(*) AS n FROM product_lang) n GROUP BY 1, 2, 3) s GROUP BY 1, 2) b) r WHERE rank <= 20""")
def _(c):
    """The 20 best product texts for each query; the queries are the distinct product names."""
    asked = c.raw("part").select(F.col("p_name").alias("id_query")).distinct()
    queries = asked.select("id_query", F.explode(A.word_tokens(F.lower("id_query"))).alias("term"))
    fields = {name: A.word_tokens(F.lower(name)) for name in ("name", "description", "brand")}
    return R.multi_match(_searched(c), "doc", fields, queries, {"name": 3, "description": 1, "brand": 2}, k=20)


_VOCABULARY_SQL = f"SELECT DISTINCT unnest({V.words(V.fold('lower(text)'))}) AS term FROM documents"
_ASKED_TERMS_SQL = f"SELECT DISTINCT unnest({V.words(V.fold('lower(text)'))}) AS term FROM benchmark"


@query("fuzzy_match", f"""SELECT q.term AS query_term, v.term, CAST(levenshtein(q.term, v.term) AS INT) AS distance FROM ({_ASKED_TERMS_SQL}) q
    JOIN ({_VOCABULARY_SQL}) v ON abs(length(q.term) - length(v.term)) <= CASE WHEN length(q.term) <= 2 THEN 0 WHEN length(q.term) <= 5 THEN 1 ELSE 2 END
    WHERE levenshtein(q.term, v.term) <= CASE WHEN length(q.term) <= 2 THEN 0 WHEN length(q.term) <= 5 THEN 1 ELSE 2 END""")
def _(c):
    """Accent-folded terms of the benchmark texts against those of all documents."""

    def terms(frame):
        return frame.select(F.explode(F.array_distinct(A.word_tokens(fold_accents(F.lower("text"))))).alias("term"))

    return R.fuzzy_terms(terms(c.texts), terms(c.raw("benchmark")))


@query("autocomplete_topk", f"""SELECT prefix, entry, weight, rank FROM (SELECT p.prefix, v.term AS entry, v.n AS weight, CAST(row_number() OVER (PARTITION BY p.prefix ORDER BY v.n DESC, v.term) AS INT) AS rank
    FROM (SELECT DISTINCT substring(term, 1, 3) AS prefix FROM (SELECT unnest({V.words('lower(text)')}) AS term FROM benchmark) t WHERE length(term) >= 3) p
    JOIN (SELECT token AS term, count(*) AS n FROM doc_token GROUP BY 1) v ON starts_with(v.term, p.prefix)) r WHERE rank <= 5""")
def _(c):
    entries = c.doc_token.groupBy(F.col("token").alias("entry")).agg(F.count(F.lit(1)).alias("weight"))
    typed = c.raw("benchmark").select(F.explode(A.word_tokens(F.lower("text"))).alias("t")).filter(F.length("t") >= 3)
    return R.suggestions(entries, typed.select(F.substring("t", 1, 3).alias("prefix")), 5)


# --- facets --------------------------------------------------------------------------------------

_FACET_SQL = """SELECT p.id_product, s.id_shop, 'manufacturer' AS field, m.name AS value FROM product p JOIN product_shop s ON s.id_product = p.id_product JOIN manufacturer m ON m.id_manufacturer = p.id_manufacturer WHERE s.active
    UNION ALL SELECT p.id_product, s.id_shop, 'condition', p.condition FROM product p JOIN product_shop s ON s.id_product = p.id_product WHERE s.active
    UNION ALL SELECT p.id_product, s.id_shop, 'category', CAST(c.id_category AS VARCHAR) FROM product p JOIN product_shop s ON s.id_product = p.id_product JOIN category_product c ON c.id_product = p.id_product WHERE s.active
    UNION ALL SELECT p.id_product, s.id_shop, 'weight', CAST(p.weight AS VARCHAR) FROM product p JOIN product_shop s ON s.id_product = p.id_product WHERE s.active"""


def _faceted(c):
    """Products per shop with the values facets are made of."""
    makers = c.manufacturer.select("id_manufacturer", F.col("name").alias("manufacturer"))
    shops = c.product_shop.filter("active").select("id_product", "id_shop", F.col("price"))
    base = c.product.select("id_product", "id_manufacturer", "condition", "weight", "id_tax_rules_group")
    return base.join(makers, "id_manufacturer", "left").join(P.category_ids(c.category_product), "id_product", "left").join(shops, "id_product")


def _fields():
    return {
        "manufacturer": F.array_compact(F.array("manufacturer")), "condition": F.array("condition"),
        "category": F.transform("category_ids", lambda i: i.cast("string")), "weight": F.array(F.col("weight").cast("string")),
    }


@query("facet_counts", f"""SELECT id_shop, f.field, f.value, count(*) AS n FROM ({_FACET_SQL}) f JOIN meta m ON m.code = f.field AND m.meta_type = 'property' AND m.aggregatable GROUP BY 1, 2, 3""")
def _(c):
    values = X.facet_values(_faceted(c), _fields(), ["id_shop"])
    return X.facet_counts(values, M.facet_settings(c.meta.filter("meta_type = 'property'")), ["id_shop"])


@query("facet_topk", f"""SELECT id_shop, field, value, n FROM (SELECT id_shop, field, value, n, result_limit, row_number() OVER (PARTITION BY id_shop, field ORDER BY n DESC, value) AS k FROM (
    SELECT id_shop, f.field, f.value, any_value(m.result_limit) AS result_limit, count(*) AS n FROM ({_FACET_SQL}) f JOIN meta m ON m.code = f.field AND m.meta_type = 'property' GROUP BY 1, 2, 3) g) r
    WHERE coalesce(result_limit, 0) <= 0 OR k <= result_limit""")
def _(c):
    counts = X.facet_counts(X.facet_values(_faceted(c), _fields(), ["id_shop"]), by=["id_shop"])
    settings = c.meta.filter("meta_type = 'property'").select(F.col("code").alias("field"), "result_limit")
    return X.facet_topk(counts, settings, ["id_shop"])


@query("facet_settings", f"""SELECT id_shop, id_lang, field, value, n FROM (SELECT f.id_shop, f.id_lang, f.field, f.value, m.result_limit, f.n,
        row_number() OVER (PARTITION BY f.id_shop, f.id_lang, f.field ORDER BY f.n DESC, f.value) AS k FROM (
            SELECT id_shop, id_lang, field, value, count(*) AS n FROM (
                SELECT t.id_product, t.id_shop, l.id_lang, t.field, t.value FROM ({_FACET_SQL}) t JOIN product_lang l ON l.id_product = t.id_product
                UNION ALL SELECT s.id_product, s.id_shop, l.id_lang, 'price', CAST(s.price AS VARCHAR) FROM product_shop s JOIN product_lang l ON l.id_product = s.id_product WHERE s.active
                UNION ALL SELECT DISTINCT s.id_product, s.id_shop, l.id_lang, {V.slug('x.name')}, x.value FROM product_shop s JOIN product_lang l ON l.id_product = s.id_product
                    JOIN feature_product x ON x.id_product = s.id_product AND x.id_lang = l.id_lang WHERE s.active) r GROUP BY 1, 2, 3, 4) f
        JOIN (SELECT code, any_value(result_limit) AS result_limit FROM meta WHERE aggregatable GROUP BY 1) m ON m.code = f.field) g WHERE coalesce(result_limit, 0) <= 0 OR k <= result_limit""")
def _(c):
    """Facets of whatever fields the documents have, features among them, as far as the settings make them aggregatable, with their limits."""
    slugged = c.feature_product.select("id_product", "id_lang", S.slugify(F.col("name")).alias("code"), "value").groupBy("id_product", "id_lang", "code").agg(
        F.collect_set("value").alias("values"))
    features = slugged.groupBy("id_product", "id_lang").agg(F.map_from_entries(F.collect_list(F.struct("code", "values"))).alias("features"))
    docs = _faceted(c).withColumn("category", F.transform("category_ids", lambda i: i.cast("string"))).drop("category_ids", "id_manufacturer", "id_tax_rules_group")
    docs = docs.join(c.product_lang.select("id_product", "id_lang"), "id_product").join(features, ["id_product", "id_lang"], "left")
    settings = c.meta.filter("aggregatable").groupBy(F.col("code").alias("field")).agg(F.first("result_limit").alias("result_limit"))
    counts = X.facet_counts(X.unpivoted(docs, ["id_product", "id_shop", "id_lang"]), settings, ["id_shop", "id_lang"])
    return X.facet_topk(counts, settings, ["id_shop", "id_lang"])


@query("facet_price_range", """SELECT s.id_shop, min(s.price) AS low, max(s.price) AS high, min(round(s.price * (1 + t.rate / 100), 6)) AS low_with_tax, max(round(s.price * (1 + t.rate / 100), 6)) AS high_with_tax
    FROM product_shop s CROSS JOIN (SELECT arg_min(rate, id_tax_rule) AS rate FROM tax_rule WHERE id_tax_rules_group = 1) t WHERE s.active GROUP BY 1""")
def _(c):
    rate = P.tax_rates(c.tax_rule.filter("id_tax_rules_group = 1")).select("rate").scalar()
    rows = c.product_shop.filter("active").withColumn("taxed", X.with_tax(F.col("price"), rate))
    return rows.groupBy("id_shop").agg(
        F.min("price").alias("low"), F.max("price").alias("high"), F.min("taxed").alias("low_with_tax"), F.max("taxed").alias("high_with_tax")
    )


_AND = ("blue", "ring")
_OR = ("Brand#3", "Brand#7", "Brand#11")


def _named(c):
    """Products with their name parts as a many-valued facet."""
    parts = c.raw("part").select(F.col("p_partkey").alias("id_product"), F.split("p_name", " ").alias("kinds"))
    return _faceted(c).join(parts, "id_product")


@query("facet_and", """SELECT p.id_product, s.id_shop FROM product p JOIN product_shop s ON s.id_product = p.id_product JOIN part ON p_partkey = p.id_product
    WHERE s.active AND list_contains(string_split(p_name, ' '), 'blue') AND list_contains(string_split(p_name, ' '), 'ring')""")
def _(c):
    return X.apply_facets(_named(c), {"kinds": F.col("kinds")}, {"kinds": (_AND, fv.FACET_AND)}).select("id_product", "id_shop")


@query("facet_or", """SELECT * FROM (WITH d AS (SELECT s.id_shop, p.condition, m.name AS manufacturer, string_split(p_name, ' ') AS kinds FROM product p JOIN product_shop s ON s.id_product = p.id_product
        JOIN part ON p_partkey = p.id_product JOIN manufacturer m ON m.id_manufacturer = p.id_manufacturer WHERE s.active)
    SELECT id_shop, 'manufacturer' AS field, manufacturer AS value, count(*) AS n FROM d WHERE condition = 'new' GROUP BY 1, 3
    UNION ALL SELECT id_shop, 'condition', condition, count(*) FROM d WHERE manufacturer IN ('Brand#3', 'Brand#7', 'Brand#11') GROUP BY 1, 3
    UNION ALL SELECT id_shop, 'kinds', k, count(*) FROM (SELECT id_shop, unnest(kinds) AS k FROM d WHERE condition = 'new' AND manufacturer IN ('Brand#3', 'Brand#7', 'Brand#11')) x GROUP BY 1, 3) f""")
def _(c):
    """Counts with three brands chosen by OR and new goods chosen by OR: each is counted without its own choice."""
    fields = {"manufacturer": F.array("manufacturer"), "condition": F.array("condition"), "kinds": F.col("kinds")}
    return X.selected_counts(_named(c), fields, {"manufacturer": (_OR, fv.FACET_OR), "condition": (("new",), fv.FACET_OR)}, ["id_shop"])


@query("fixed_filter_category", f"""SELECT DISTINCT t.id_product, t.id_lang, t.mode FROM (
        SELECT c.id_product, c.id_lang, 'below' AS mode FROM cat_text c JOIN lang ON lang.id_lang = c.id_lang
            WHERE starts_with(concat(array_to_string(list_transform(string_split(c.path, ' /// '), lambda s: {V.slug('s')}), '/'), '/'), concat('europe-', lang.iso_code, '/'))
        UNION ALL SELECT c.id_product, c.id_lang, 'exact' FROM cat_text c JOIN lang ON lang.id_lang = c.id_lang WHERE {V.slug('c.name')} = concat('nation-3-3-', lang.iso_code)) t
    JOIN product_lang l ON l.id_product = t.id_product AND l.id_lang = t.id_lang""")
def _(c):
    """A category page with its sub-categories, and one without, in every language."""
    texts = c.product_lang.select("id_product", "id_lang")
    docs = P.with_categories(texts, c.category_product, c.category, c.category_lang).join(c.lang.select("id_lang", "iso_code"), "id_lang")
    below = X.fixed_filter(docs, "category", F.concat(F.lit("europe-"), "iso_code"), paths=P.category_path_list(F.col("cats")))
    exact = X.fixed_filter(docs, "category", F.concat(F.lit("nation-3-3-"), "iso_code"), subcategories=False, names=F.transform("cats", lambda x: x["text"]["name"]))
    return below.select("id_product", "id_lang", F.lit("below").alias("mode")).unionByName(exact.select("id_product", "id_lang", F.lit("exact").alias("mode")))


@query("fixed_filter_brand", f"""SELECT p.id_product, 'brand' AS kind FROM product p JOIN manufacturer m ON m.id_manufacturer = p.id_manufacturer WHERE {V.slug('m.name')} = 'brand-7'
    UNION ALL SELECT p.id_product, 'supplier' FROM product p JOIN supplier_name s ON s.id_supplier = p.id_supplier WHERE {V.slug('s.supplier_name')} = 'supplier-000000003'""")
def _(c):
    docs = P.brand(c.product, c.manufacturer, c.supplier_name)
    maker = X.fixed_filter(docs, "manufacturer", "brand-7").select("id_product", F.lit("brand").alias("kind"))
    return maker.unionByName(X.fixed_filter(docs, "supplier_name", "supplier-000000003").select("id_product", F.lit("supplier").alias("kind")))


@query("autocomplete_typed", f"""SELECT prefix, entry, weight, rank FROM (SELECT p.prefix, v.term AS entry, v.n AS weight, CAST(row_number() OVER (PARTITION BY p.prefix ORDER BY v.n DESC, v.term) AS INT) AS rank
    FROM (SELECT DISTINCT substring(term, 1, CAST(k AS INT)) AS prefix FROM (SELECT DISTINCT unnest({V.words('lower(text)')}) AS term FROM benchmark) t, generate_series(1, length(term)) g(k)) p
    JOIN (SELECT token AS term, count(*) AS n FROM doc_token GROUP BY 1) v ON starts_with(v.term, p.prefix)) r WHERE rank <= 5""")
def _(c):
    """Suggestions while the words of the benchmark texts are typed, letter by letter to their end."""
    entries = c.doc_token.groupBy(F.col("token").alias("entry")).agg(F.count(F.lit(1)).alias("weight"))
    typed = c.raw("benchmark").select(F.explode(A.word_tokens(F.lower("text"))).alias("t")).distinct()
    prefixes = typed.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("t")), lambda n: F.substring(F.col("t"), F.lit(1), n))).alias("prefix"))
    return R.suggestions(entries, prefixes, 5)

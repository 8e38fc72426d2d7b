"""Hand-made rows for the value rules, and brute-force checks of the join operators."""

import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfweave.functions import analyzers as A
from shelfweave.functions import fixed_values as fv
from shelfweave.functions import scalars as S
from shelfweave.functions.urls import normalize_urls
from shelfweave.operators import category as C
from shelfweave.operators import facets as X
from shelfweave.operators import metas as M
from shelfweave.operators import product as P
from shelfweave.operators import search as R
from shelfweave.operators import sync as Y
from shelfweave.operators.publish import plan_new_version
from shelfweave.operators.registry import ENTITIES, Attribute, Entity, default_updated_at, project, register_entity
from shelfweave.operators.relational import containing_intervals, first_per_key, hot_keys, literal_rows, numbered, split_join, spread, top_per_group
from shelfweave.operators.rows import entity_rows


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def apply(spark, values, build, kind="string"):
    """One expression over the values, order kept."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in rows.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


# --- scalars -------------------------------------------------------------------------------------

def test_slug_and_code(spark):
    given_ = ["Łódź  Główna!", " --a__b-- ", "Straße Ø", "", None, "ÉCOLE n°7"]
    assert apply(spark, given_, S.slugify) == ["lodz-glowna", "a-b", "strasse-o", "", None, "ecole-n-7"]
    assert apply(spark, ["Frame Size", "A  B"], S.code_of) == ["frame_size", "a__b"]


def test_whole_number_of_text(spark):
    given_ = ["12 days", " -7x", "soon", "", None, "1e2 x", "3.9", "+5", "."]
    assert apply(spark, given_, S.php_int) == [12, -7, 0, 0, 0, 100, 3, 5, 0]


def test_truth_of_text(spark):
    assert apply(spark, ["0", "", None, "00", " ", "no"], S.php_bool) == [False, False, False, True, True, True]


def test_lists_paths_dates(spark):
    assert apply(spark, [" a ,b\t,,c", "", "x"], S.split_trim) == [["a", "b", "", "c"], [""], ["x"]]
    assert apply(spark, [123, 7, None], S.image_path, "int") == ["/p/1/2/3/123.jpg", "/p/7/7.jpg", "/p//.jpg"]
    dates = apply(spark, ["2024-02-03 04:05:06", "2024-02-03", "1706933106000", "03.02.2024", None, ""], S.parse_date)
    assert [str(d) if d else None for d in dates] == ["2024-02-03 04:05:06", "2024-02-03 00:00:00", "2024-02-03 04:05:06", None, None, None]
    assert apply(spark, ["pl", "EN", "xx", None], S.stop_word_set) == ["_polish_", "_english_", "_english_", "_english_"]


def test_prices_round_half_up(spark):
    row = spark.createDataFrame([(10.005, 20.0, 0.5), (1.0, None, None)], "b double, r double, d double")
    out = row.select(*[c.alias(n) for n, c in S.price_columns(F.col("b"), F.col("r"), F.col("d")).items()]).collect()
    assert (out[0].original_price_incl_tax, out[0].special_price, out[0].special_price_incl_tax) == (12.01, 5.0, 6.0)
    assert (out[1].original_price_incl_tax, out[1].special_price_incl_tax) == (1.0, 1.0)


def test_urls(spark):
    urls = ["HTTP://Us%20er:p+w@H.com:81/a b/%C3%BC?x=1&y=2#f", "https://h.com", "//h.com/p", "/only/path", "mailto:x", "http://[::1]:9200/", "http://h/%zz"]
    rows = normalize_urls(spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    assert [r.normalized for r in rows] == [
        "http://Us%20er:p%2Bw@H.com:81/a%20b/%C3%BC?x%3D1%26y%3D2#f", "https://h.com:443", "http://h.com:80/p", "http://[::1]:9200/", "http://h:80/%25zz",
    ]


# --- analysers -----------------------------------------------------------------------------------

def test_token_chains(spark):
    assert apply(spark, ["The cat, the HAT", "", "!!"], lambda c: A.standard(c, ("the",))) == [["cat", "hat"], [], []]
    assert apply(spark, ["b-52's Żółw"], A.reversed_words) == [["b", "25", "s", "włóŻ"]]
    assert apply(spark, ["a ab abc-d", "x", ""], A.edge_grams) == [["ab", "ab", "abc", "abc-", "abc-d"], [], []]
    assert apply(spark, ["abcdefghijklmn"], A.edge_grams)[0][-1] == "abcdefghij"
    assert apply(spark, ["It's 4ever"], A.letter_tokens) == [["it", "s", "ever"]]


def test_shingles_of_short_lists(spark):
    rows = spark.createDataFrame([(0, []), (1, ["a"]), (2, ["a", "b"]), (3, ["a", "b", "c"])], "i int, t array<string>")
    got = [r.s for r in rows.select("i", A.shingles(F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == [[], ["a"], ["a", "b", "a b"], ["a", "b", "c", "a b", "b c", "a b c"]]


def test_stem_then_stop(spark):
    docs = spark.createDataFrame([(1, "en", "Running the runs été"), (2, "en", "the"), (3, "fr", "the")], "id int, lang string, text string")
    stems = spark.createDataFrame([("running", "run"), ("runs", "the")], "form string, stem string")
    stops = spark.createDataFrame([("en", "the")], "lang string, token string")
    got = {r.id: r.tokens for r in R.stemmed(docs, "id", "text", stems, stops, on=("lang",), fold=True).collect()}
    assert got == {1: ["run", "ete"], 2: [], 3: ["the"]}


# --- rows and status -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def shop_rows(spark):
    base = spark.createDataFrame([(1, True), (2, True), (3, False)], "id_product int, active boolean")
    shop = spark.createDataFrame([(1, 1, True), (1, 2, False), (2, 1, True), (3, 1, True)], "id_product int, id_shop int, active boolean")
    lang = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (3, 1, "c")], "id_product int, id_lang int, name string")
    return base, shop, lang


def triples(frame):
    return sorted((r.id_product, r.id_shop, r.id_lang) for r in frame.collect())


def test_language_join_kinds(shop_rows):
    base, shop, lang = shop_rows
    every = entity_rows(base, shop, lang, key="id_product", active_level="shop")
    assert triples(every) == [(1, 1, 1), (1, 1, 2), (2, 1, 0), (3, 1, 1)]
    one = entity_rows(base, shop, lang, key="id_product", active_level="shop", id_lang=2)
    assert triples(one) == [(1, 1, 2)]
    assert triples(entity_rows(base, shop, lang, key="id_product", active_level="object", id_shop=2)) == [(1, 2, 1), (1, 2, 2)]
    assert len(triples(entity_rows(base, shop, lang, key="id_product", active_level="shop", only_active=False))) == 6


def test_other_language_status_hides_nothing(spark):
    rows = spark.createDataFrame([(1, 1, 1, "2024-01-01"), (1, 2, 1, "2024-01-01"), (2, 1, 1, "2024-01-01"), (3, 1, 1, "2024-01-01")],
                                 "id_entity int, id_lang int, id_shop int, d string").selectExpr("id_entity", "id_lang", "id_shop", "CAST(d AS DATE) AS date_upd")
    status = spark.createDataFrame(
        [(1, "product", 1, 1, "2024-01-01", None), (2, "product", 1, 1, "2030-01-01", None), (3, "product", 1, 1, "2000-01-01", "bad"), (1, "category", 1, 2, "2024-01-01", None)],
        "id_entity int, index string, id_shop int, id_lang int, d string, error string",
    ).selectExpr("id_entity", "index", "id_shop", "id_lang", "CAST(d AS DATE) AS date_upd", "error")
    got = sorted((r.id_entity, r.id_lang) for r in Y.objects_to_index(rows, status, "product").collect())
    # 1/2 is missing, 2 differs although its status is newer, 3 failed and stays out.
    assert got == [(1, 2), (2, 1)]
    assert Y.objects_to_index(rows.drop("date_upd"), status, "product", dated=False).count() == 1


def test_paging(spark, monkeypatch):
    rows = spark.range(50).selectExpr("id AS id_entity", "1 AS id_lang", "1 AS id_shop")
    want = list(range(10, 15))
    assert sorted(r.id_entity for r in Y.page(rows, 5, 10).collect()) == want
    monkeypatch.setattr(Y, "_PAGE_BOUND", 3)
    assert sorted(r.id_entity for r in Y.page(rows, 5, 10).collect()) == want
    assert Y.page(rows, 0, 45).count() == 5 and Y.page(rows).count() == 50


def test_failed_update_keeps_its_date(spark):
    key = "id_entity int, index string, id_shop int, id_lang int, date_upd string, error string"
    status = spark.createDataFrame([(1, "p", 1, 1, "old", None), (2, "p", 1, 1, "old", "x"), (9, "p", 1, 1, "old", None)], key)
    outcome = spark.createDataFrame([(1, "p", 1, 1, "new", "bad"), (2, "p", 1, 1, "new", None), (3, "p", 1, 1, "new", "bad")], key)
    got = {r.id_entity: (r.date_upd, r.error) for r in Y.upsert_status(status, outcome).collect()}
    assert got == {1: ("old", "bad"), 2: ("new", None), 3: ("new", "bad"), 9: ("old", None)}


def test_outcome_split_and_errors(spark):
    batch = spark.createDataFrame([(i, "p", 1, 1) for i in range(1, 5)], "id_entity int, index string, id_shop int, id_lang int")
    results = spark.createDataFrame(
        [(1, "shop_1_1_7", "p", 201, None, None), (2, "shop_1_1_7", "p", 400, "bad", "why"), (3, "shop_1_1_7", "p", 503, None, "lost"), (4, "shop_1_2_7", "p", 400, "other lang", None)],
        "id_entity int, route string, type string, status int, reason string, caused_by string",
    )
    ok, failed = Y.split_outcome(batch, results)
    assert {r.id_entity for r in ok.collect()} == {1, 4}
    assert {r.id_entity: r.error for r in failed.collect()} == {2: "bad why", 3: "Unknown error"}


def test_progress_of_empty_shop(spark):
    totals = spark.createDataFrame([(1, 4), (2, 0)], "id_shop int, total long")
    indexed = spark.createDataFrame([(1, 3)], "id_shop int, indexed long")
    errors = spark.createDataFrame([(1, 1)], "id_shop int, errors long")
    langs = spark.createDataFrame([(1, 2), (2, 2)], "id_shop int, languages long")
    got = {r.id_shop: (r.percent, r.done, r.expected) for r in Y.progress(indexed, totals, errors, langs).collect()}
    assert got == {1: (75.0, True, 8), 2: (None, True, 0)}


# --- products ------------------------------------------------------------------------------------

def test_negative_stock_counts(spark):
    rows = spark.createDataFrame([(-3, 0), (0, 0), (0, 1), (None, 2), (None, 1), (5, None)], "q int, o int")
    got = [r.y for r in rows.select(P.in_stock(F.col("q"), P.allows_backorder(F.col("o"))).alias("y")).collect()]
    assert got == [True, False, True, False, True, True]


def test_features_first_wins_specs_last_wins(spark):
    rows = spark.createDataFrame([([(1, 1, "Frame Size", "A , B"), (1, 2, "frame size", "Z"), (1, 3, "X", "1"), (1, 4, "X", "2")],), ([],)],
                                 "f array<struct<id_lang:int,position:int,name:string,value:string>>")
    got = rows.select(P.feature_map(F.col("f")).alias("m"), P.spec_map(F.col("f")).alias("s")).collect()
    assert got[0].m == {"frame_size": ["a", "b"], "x": ["1"]} and got[0].s == {"Frame Size": "A , B", "frame size": "Z", "X": "2"}
    assert got[1].m == {} and got[1].s == {}


def test_filled_field_hides_feature(spark):
    docs = spark.createDataFrame([(1, "new", {"condition": ["x"], "size": ["1"]}), (2, None, {"condition": ["x"]})], "id int, condition string, features map<string,array<string>>")
    got = {r.id: r.features for r in P.hide_declared(docs).collect()}
    assert got == {1: {"size": ["1"]}, 2: {"condition": ["x"]}}
    wide = P.flatten_features(P.hide_declared(docs), ["size", "condition"]).collect()
    assert wide[0]["size"] == ["1"] and wide[1]["size"] is None


def test_leaf_names_drop_blanks_and_zero(spark):
    rows = spark.createDataFrame([(["A /// B", "C /// B", "D /// 0", "E"],)], "p array<string>")
    assert rows.select(P.leaf_names(F.col("p")).alias("y")).first().y == ["B", "E"]


def test_small_and_large_trees_agree(spark, sf_dir):
    from shelfweave.sources.catalog import Catalog

    def ways(limit):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        c = Catalog(spark, sf_dir)
        frame = P.categories(c.category_product, c.category, c.category_lang)
        return frame._jdf.queryExecution().executedPlan().toString(), sorted(map(str, frame.collect()))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        (sent, few), (joined, many) = ways("10MB"), ways("-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in joined and sent != joined and few == many and few


def test_chosen_fields_equal_those_of_the_whole_document(spark, sf_dir):
    """Documents of a few fields read only what those are worked out from."""
    from shelfweave.sources.catalog import Catalog

    c = Catalog(spark, sf_dir)
    whole = P.product_documents(c).persist()
    for fields in (["price", "special_price_incl_tax"], ["stock_qty", "in_stock", "image"], ["category_ids", "manufacturer"], ["specs"], ["pageviews", "sales", "sku"], ["features", "sku"], []):
        some = P.product_documents(c, fields=fields)
        assert some.columns[:4] == list(P.ENVELOPE) and sorted(some.columns[4:]) == sorted(fields)
        text = lambda frame: sorted(str(r) for r in frame.select(*some.columns).collect())  # noqa: B023, E731
        assert text(some) == text(whole), fields
    whole.unpersist()
    plan = P.product_documents(c, fields=["link"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") < P.product_documents(c)._jdf.queryExecution().optimizedPlan().toString().count("Join") / 4
    with pytest.raises(ValueError, match="no such fields"):
        P.product_documents(c, fields=["nothing"])


def test_custom_entity(spark):
    mine = register_entity(Entity("gift", (Attribute("title", "text", lambda: F.upper("name")), Attribute("kind", "keyword", const="g"), Attribute("name", "text"))))
    try:
        rows = spark.createDataFrame([(1, 1, 2, "x")], "id_entity int, id_lang int, id_shop int, name string")
        got = project(rows, mine, F.lit("2024-01-01")).first().asDict()
        assert got == {"id": 1, "elastic_id_lang": 1, "elastic_id_shop": 2, "elastic_type": "gift", "title": "X", "kind": "g", "name": "x", "updated_at": "2024-01-01"}
    finally:
        del ENTITIES["gift"]
    kept = default_updated_at(spark.createDataFrame([("a",), (None,)], "updated_at string"), F.lit("now")).collect()
    assert [r.updated_at for r in kept] == ["a", "now"]


# --- metas ---------------------------------------------------------------------------------------

def test_effective_type(spark):
    rows = spark.createDataFrame(
        [("keyword", "float", ["float"]), (None, "date", None), ("text", None, ["boolean", "text"]), ("long", None, ["boolean"])], "s string, d string, a array<string>"
    )
    got = [r.y for r in rows.select(M.effective_type(F.col("s"), F.col("d"), F.col("a")).alias("y")).collect()]
    assert got == ["float", "text", "text", "boolean"]


def test_required_field_is_appended_once(spark):
    metas = spark.createDataFrame([("title", True, "text", 2.0), ("sku", True, "keyword", 1.0), ("half", True, "text", 1.5)], "alias string, searchable boolean, elastic_type string, weight float")
    assert {r.field for r in M.searchable_fields(metas).collect()} == {"title^2", "half^1.5", "name"}
    named = metas.unionByName(spark.createDataFrame([("name", True, "text", 3.0)], metas.schema))
    assert {r.field for r in M.searchable_fields(named, with_weights=False).collect()} == {"title", "half", "name"}


def test_default_labels(spark):
    from shelfweave.sources.labels import default_labels

    rows = default_labels(spark)
    assert rows.select("code").distinct().count() == 36 and rows.filter("iso_code = 'nl'").count() == 35


# --- operators against brute force ---------------------------------------------------------------

@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 3000)), max_size=12), st.lists(st.integers(0, 3000), max_size=15))
def test_containing_intervals(spark, bounds, points):
    spans = [(i, min(a, b), max(a, b)) for i, (a, b) in enumerate(bounds)]
    got = containing_intervals(
        spark.createDataFrame(list(enumerate(points)), "p int, at long"), "at", spark.createDataFrame(spans, "i int, low long, high long"), "low", "high", bits=3, levels=4
    )
    want = sorted((p, i) for p, at in enumerate(points) for i, low, high in spans if low <= at <= high)
    assert sorted((r.p, r.i) for r in got.collect()) == want


def test_interval_out_of_range_is_refused(spark):
    spans = spark.createDataFrame([(1, 5, 1 << 20)], "i int, low long, high long")
    with pytest.raises(Exception, match="out of range"):
        containing_intervals(spark.createDataFrame([(1, 7)], "p int, at long"), "at", spans, "low", "high", bits=3, levels=3).collect()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_is_exact(spark):
    rng = random.Random(7)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(250)}
    asked = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(60)}
    got = {(r.query_term, r.term, r.distance) for r in R.fuzzy_terms(column(spark, words).toDF("term"), column(spark, asked).toDF("term")).collect()}
    allowed = lambda q: 0 if len(q) <= 2 else 1 if len(q) <= 5 else 2
    want = {(q, w, distance(q, w)) for q, w in itertools.product(asked, words) if distance(q, w) <= allowed(q)}
    assert got == want and len(want) > 100


def test_numbered_over_many_ranges(spark):
    rng = random.Random(3)
    rows = [(g, i) for g in "ab" for i in rng.sample(range(5000), 300)]
    frame = spark.createDataFrame(rows, "g string, id long")
    got = {(r.g, r.id): r.row_no for r in numbered(frame, "id", groups=["g"], span=100).collect()}
    for g in "ab":
        for place, i in enumerate(sorted(i for h, i in rows if h == g), 1):
            assert got[(g, i)] == place


def test_first_and_top(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert {r.k: r.v for r in first_per_key(rows, ["k"], [F.col("o")]).collect()} == {"a": "y", "b": "z"}
    assert {r.k: r.v for r in first_per_key(rows, ["k"], [F.col("o")], keep_last=True).collect()} == {"a": "x", "b": "z"}
    top = top_per_group(rows, ["k"], [F.col("o").desc()], 1)
    assert {(r.k, r.v) for r in top.collect()} == {("a", "x"), ("b", "z")}
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_spread_over_dimensions_of_any_size(spark, threshold):
    """One block or many, sent to the tasks or shuffled, repeated and nested rows, an empty dimension."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = spark.createDataFrame([(1, {"a": 1}, "x"), (1, {"a": 1}, "x"), (None, None, None)], "i int, m map<string,int>, t string")
        for n, block in ((0, 5), (2, 1000), (5, 5), (97, 5)):
            got = spread(rows, spark.range(n).toDF("d"), block_rows=block)
            assert got.columns == ["i", "m", "t", "d"]
            assert sorted((r.i or 0, r.d) for r in got.collect()) == sorted((i, d) for i in (1, 1, 0) for d in range(n))
            assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert spread(rows.select("m"), spark.range(3).toDF("d")).count() == 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_cross_join_in_fan_out(spark, sf_dir):
    from shelfweave.sources.catalog import Catalog

    c = Catalog(spark, sf_dir)
    plan = plan_new_version(c.shop, c.lang, "s", 1)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# --- facets and tree -----------------------------------------------------------------------------

def test_selection_kinds(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, None)], "id int, v array<string>")
    ids = lambda frame: [r.id for r in frame.orderBy("id").collect()]
    pick = lambda op: X.apply_facets(docs, {"v": F.col("v")}, {"v": (("a", "b"), op)})
    assert ids(pick(fv.FACET_AND)) == [1] and ids(pick(fv.FACET_OR)) == [1, 2]
    assert ids(X.apply_facets(docs, {"v": F.col("v")}, {"v": (("b",), fv.FACET_OR)}, skip="v")) == [1, 2, 3]


def test_limits_per_field(spark):
    counts = spark.createDataFrame([("f", v, n) for v, n in zip("abcde", (1, 5, 5, 2, 9))] + [("g", "x", 1), ("h", "y", 1)], "field string, value string, n long")
    limits = literal_rows(spark, [("f", 3), ("g", 0)], "field string, result_limit int")
    got = sorted((r.field, r.value) for r in X.facet_topk(counts, limits).collect())
    assert got == [("f", "b"), ("f", "c"), ("f", "e"), ("g", "x")]


def test_paths_of_an_inactive_branch(spark):
    cat = spark.createDataFrame(
        [(1, 0, 0, 1, 10, True), (2, 1, 1, 2, 9, True), (3, 2, 2, 3, 8, False), (4, 3, 3, 4, 5, True), (5, 3, 3, 6, 7, True)],
        "id_category long, id_parent long, level_depth int, nleft long, nright long, active boolean",
    )
    names = spark.createDataFrame([(i, 1, f"n{i}") for i in range(1, 6)], "id_category long, id_lang int, name string")
    active = {r.id_category: r.path for r in C.category_paths(cat, names).collect()}
    whole = {r.id_category: r.path for r in C.category_paths(cat, names, active_only=False).collect()}
    assert active == {1: "", 2: "", 3: "", 4: "n4", 5: "n5"} and whole[5] == "n3 /// n5"
    assert {r.id_category: r.path for r in C.id_paths(cat).collect()}[4] == "1/2/3/4"
    tree = {r.id_category: r.tree for r in C.tree_json(cat, names).collect()}
    assert '"children_data":[]' in tree[2] and tree[3].count('"id":') == 3


def test_facet_limits_of_any_size(spark):
    counts = spark.range(60).selectExpr("explode(array('a', 'b', 'c', 'd')) AS field", "CAST(id AS STRING) AS value", "id AS n")
    limits = spark.createDataFrame([("a", 50), ("b", 0), ("c", None), ("d", 3)], "field string, result_limit int")
    got = {r.field: r["count"] for r in X.facet_topk(counts, limits).groupBy("field").count().collect()}
    assert got == {"a": 50, "b": 60, "c": 60, "d": 3}


def test_suggestions_of_long_prefixes(spark):
    from shelfweave.operators.search import suggestions

    entries = spark.createDataFrame([("internationalisation", 3), ("internationally", 5), ("internal", 9)], "entry string, weight long")
    prefixes = spark.createDataFrame([("internationa",), ("internationalisation",)], "prefix string")
    got = [(r.prefix, r.entry) for r in suggestions(entries, prefixes, 5).orderBy("prefix", "rank").collect()]
    assert got == [("internationa", "internationally"), ("internationa", "internationalisation"), ("internationalisation", "internationalisation")]


# --- search at scale -----------------------------------------------------------------------------

def _matched(spark, seed, n_docs=300, n_queries=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    some = lambda most: [words[min(29, int(rng.expovariate(0.2)))] for _ in range(rng.randint(0, most))]
    docs = [(d, some(12), some(3)) for d in range(n_docs)]
    queries = [(q, t) for q in range(n_queries) for t in some(4)]
    frame = spark.createDataFrame(docs, "doc long, body array<string>, title array<string>")
    return frame, spark.createDataFrame(queries, "id_query long, term string"), {"body": F.col("body"), "title": F.col("title")}, {"body": 1, "title": 3}


def test_best_matches_without_scoring_all(spark):
    for seed in (1, 2):
        docs, queries, fields, weights = _matched(spark, seed)
        whole = R.multi_match(docs, "doc", fields, queries, weights)
        for k in (1, 5, 40):
            want = {tuple(r) for r in top_per_group(whole, ["id_query"], [F.col("score").desc(), F.col("doc")], k).select("id_query", "doc", "score", "rank").collect()}
            got = {tuple(r) for r in R.multi_match(docs, "doc", fields, queries, weights, k).select("id_query", "doc", "score", "rank").collect()}
            assert got == want
        wanted = queries.distinct()
        hits = R._hits(docs, "doc", fields, wanted)
        plan = R.match_plan(wanted, R._gains(docs, hits, weights, 5))
        assert R.candidates(plan, hits, "doc").select("id_query", "doc").distinct().count() < 0.8 * whole.count()


def test_matching_runs_in_tasks_of_so_many_documents(spark, monkeypatch):
    from shelfweave.operators import search

    monkeypatch.setattr(search, "TASK_DOCS", 5)
    docs, queries, fields, weights = _matched(spark, 3)
    docs = docs.withColumn("body", F.concat("body", F.array(F.lit("w0"), F.lit("w1"))))  # two terms in all documents
    best = R.multi_match(docs, "doc", fields, queries, weights, 5)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 60)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {tasks}), REPARTITION_BY_NUM") >= 2  # such shuffles are not put together by their bytes
    whole = top_per_group(R.multi_match(docs, "doc", fields, queries, weights), ["id_query"], [F.col("score").desc(), F.col("doc")], 5)
    assert {tuple(r) for r in best.select("id_query", "doc", "score", "rank").collect()} == {tuple(r) for r in whole.select("id_query", "doc", "score", "rank").collect()}


def test_split_join_deals_out_hot_keys_only(spark):
    rows = spark.range(4000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 500)) AS key", "id AS v")
    side = spark.createDataFrame([("hot", 1), ("k1", 2), ("k499", 3), ("none", 4)], "key string, x int")
    assert [len(r[0]) for r in spark.range(1).select(hot_keys(rows, ["key"])).collect()] == [1]
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain, dealt = rows.join(side, ["key"], how), split_join(rows, side, ["key"], how)
        assert sorted(map(str, plain.select(*dealt.columns).collect())) == sorted(map(str, dealt.collect()))
    plan = split_join(rows, side, ["key"]).select("key", "v", "x")
    assert plan.count() == 4000
    assert split_join(rows.limit(0), side, ["key"]).count() == 0


def test_only_rates_of_hot_tax_groups_are_copied(spark):
    """What is broadcast of the rates grows with the tax groups, not with these times the shuffle partitions."""
    products = spark.range(3000).selectExpr("id AS id_product", "CAST(CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN id % 700 ELSE 7 END AS INT) AS id_tax_rules_group")
    rates = spark.range(5000).selectExpr("CAST(id AS INT) AS id_tax_rules_group", "CAST(id % 25 AS DOUBLE) AS rate").repartition(2)
    frame = P.with_rates(products, rates)
    rows = frame.collect()
    assert {r.id_product: (r.id_tax_rules_group, r.rate) for r in rows} == {
        i: (g, None if g is None else g % 25) for i in range(3000) for g in [(None, i % 700, 7, 7)[i % 4]]} and len(rows) == 3000
    nodes, sent = [frame._jdf.queryExecution().executedPlan().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        if node.nodeName() == "BroadcastExchange":
            sent.append(node.metrics().apply("numOutputRows").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert sent and sum(sent) <= 5000 + 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_short_terms_by_deletions_and_long_ones_by_pieces(spark):
    rng = random.Random(11)
    word = lambda low, high: "".join(rng.choice("ab") for _ in range(rng.randint(low, high)))
    words, asked = {word(1, 10) for _ in range(300)}, {word(2, 8) for _ in range(60)}
    got = {(r.query_term, r.term, r.distance) for r in R.fuzzy_terms(column(spark, words).toDF("term"), column(spark, asked).toDF("term")).collect()}
    allowed = lambda q: 0 if len(q) <= 2 else 1 if len(q) <= 5 else 2
    assert got == {(q, w, distance(q, w)) for q, w in itertools.product(asked, words) if distance(q, w) <= allowed(q)}


def test_numbered_of_sparse_ids(spark):
    rng = random.Random(5)
    rows = [(g, i, t) for g in ("a", None) for i in {rng.randrange(-(1 << 62), 1 << 62) for _ in range(200)} | {-1, 0, 1, 65535, 65536, (1 << 62) + 7} for t in (1, 2)]
    frame = spark.createDataFrame(rows, "g string, id long, t int").repartition(5)
    got = {(r.g, r.id, r.t): r.row_no for r in numbered(frame, "id", groups=["g"], ties=["t"]).collect()}
    for g in ("a", None):
        for place, (i, t) in enumerate(sorted((i, t) for h, i, t in rows if h == g), 1):
            assert got[(g, i, t)] == place
    assert [r.row_no for r in numbered(frame.filter("g = 'a' AND t = 1"), "id").orderBy("id").collect()] == list(range(1, len(rows) // 4 + 1))


def test_unpivoted_fields_are_those_of_the_data(spark):
    docs = spark.createDataFrame([(1, "x", ["a", "b", "a"], {"size": ["s", "m"]}, None), (2, None, [], {}, 2.5)], "id int, kind string, tags array<string>, more map<string,array<string>>, price double")
    got = {tuple(r) for r in X.unpivoted(docs, ["id"]).collect()}
    assert got == {(1, "kind", "x"), (1, "tags", "a"), (1, "tags", "b"), (1, "size", "s"), (1, "size", "m"), (2, "price", "2.5")}


def test_book_of_a_small_tree_gives_what_the_join_gives(spark, sf_dir, monkeypatch):
    """Texts are looked up where they are used: no row of a shuffle carries them, and larger trees are still joined."""
    from shelfweave.sources.catalog import Catalog

    c = Catalog(spark, sf_dir)
    fields = ["category_ids", "category", "categories_without_path"]
    lang = c.product_lang.select("id_product", F.when(F.col("id_product") % 7 == 0, 99).otherwise(F.col("id_lang")).alias("id_lang"))
    pairs = c.category_product.filter("id_product % 5 <> 0").withColumn("id_category", F.when(F.col("id_product") % 9 == 0, 123456789).otherwise(F.col("id_category")))

    def ways():
        book = P.category_book(c.category, c.category_lang)
        cats = P.categories(pairs, c.category, c.category_lang) if book is None else book.places(pairs)
        chosen = P.localized(lang, cats, None, book).select("id_product", "id_lang", *fields)
        listed = P.with_categories(lang, pairs, c.category, c.category_lang).select("id_product", "id_lang", "cats")
        return book, [sorted(map(str, frame.collect())) for frame in (chosen, listed)], chosen._jdf.queryExecution()

    book, looked_up, plan = ways()
    assert book is not None and plan.optimizedPlan().toString().count("AS _category#") == 0
    assert not [x for x in plan.executedPlan().toString().splitlines() if "Exchange" in x and "link_rewrite" in x]
    monkeypatch.setattr(P, "TREE_TEXTS", 5)
    large, joined, _ = ways()
    assert large is None and looked_up == joined and looked_up[0] and looked_up[1]


def test_stop_words_leave_where_the_tokens_are(spark):
    """As a left anti join says, nulls included, but no token is moved for it."""
    tokens = spark.range(3000).selectExpr("id", "CASE id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' END AS lang", "IF(id % 97 = 0, NULL, concat('w', CAST(id % 211 AS STRING))) AS token")
    stops = spark.range(400).selectExpr("IF(id % 3 = 0, 'en', IF(id % 3 = 1, 'fr', NULL)) AS lang", "IF(id % 50 = 0, NULL, concat('w', CAST(id % 100 AS STRING))) AS token")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for words in (stops, stops.limit(0)):
            kept = R.remove_stop_words(tokens, words)
            main = kept._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0].split("Subquery:")[0]
            assert "Join" not in main and "Exchange" not in main.split("== Initial Plan ==")[0].split("Subquery")[0]
            assert sorted(map(str, kept.collect())) == sorted(map(str, tokens.join(words, ["lang", "token"], "left_anti").select("id", "lang", "token").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_plain_stop_words_leave_before_the_dictionary(spark):
    """A stop word that the dictionary stems is judged by its stem only, in its language."""
    docs = spark.createDataFrame([(1, "en", "the runs the ran saw"), (2, "fr", "the runs saw"), (3, None, "the saw")], "id int, lang string, text string")
    stems = spark.createDataFrame([("saw", "see"), ("ran", "the")], "form string, stem string")
    stops = spark.createDataFrame([("en", "the"), ("en", "saw"), ("fr", "see"), (None, "the")], "lang string, token string")
    got = {r.id: r.tokens for r in R.stemmed(docs, "id", "text", stems, stops, on=("lang",)).collect()}
    assert got == {1: ["runs", "see"], 2: ["the", "runs"], 3: ["the", "see"]}


def test_postings_are_shuffled_once(spark):
    """The frequencies and the postings they are joined to come from one shuffle of the tokens."""
    docs = spark.range(50).selectExpr("id", "transform(sequence(1, 20), i -> concat('t', CAST((id * i) % 13 AS STRING))) AS words")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = R.term_postings(docs, "id", {"words": F.col("words")})
        rows = frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    counted = R.document_frequency(R.postings(docs, "id", {"words": F.col("words")}))
    frequency = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "ReusedExchange" in plan and "count(1)" in frequency and "count(1) AS df" not in frequency
    lists = {r.id: r.words for r in docs.collect()}
    assert all(r.tf == lists[r.id].count(r.term) and r.df == sum(r.term in w for w in lists.values()) for r in rows)
    assert len(rows) == sum(len(set(w)) for w in lists.values())

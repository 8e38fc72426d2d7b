"""Store, incremental rounds and the change-feed stream."""

import pytest
from pyspark.sql import functions as F

from shelfweave.operators import category as C
from shelfweave.operators import publish as P
from shelfweave.operators import registry as R
from shelfweave.operators import sync as Y
from shelfweave.operators.product import product_documents
from shelfweave.sources.catalog import Catalog
from shelfweave.sources.store import DOC_KEY, Store
from shelfweave.streaming import incremental as I


class Small(Catalog):
    """A few products, so that a round takes seconds."""

    def raw(self, name):
        frame = super().raw(name)
        return frame.filter("p_partkey < 12") if name == "part" else frame


class Smaller(Small):
    """Few events too."""

    def raw(self, name):
        frame = super().raw(name)
        return frame.filter("event_id < 50") if name == "events" else frame


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return Small(spark, sf_dir)


def keys(frame):
    return {tuple(r) for r in frame.select(*DOC_KEY).collect()}


def test_rounds_until_nothing_is_left(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    assert I.index_remaining(tables, store, 1) == 1
    status = store.read("status")
    rows = I.product_entity_rows(tables)
    assert status.count() == rows.count()
    assert Y.objects_to_index(rows, status, "product").count() == 0
    assert I.index_remaining(tables, store, 1) == 0
    docs = store.documents(1)
    assert keys(docs) == keys(product_documents(tables))
    assert docs.count() == docs.select(*DOC_KEY).distinct().count()


def test_chunks_and_failures(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    total = I.product_entity_rows(tables).count()
    I.index_batch(tables, store, 1, 1, limit=30, checks={"even id": lambda: F.col("id") % 2 == 1})
    status = store.read("status")
    assert status.count() == 30
    failed = status.filter("error IS NOT NULL")
    assert {r.error for r in failed.collect()} == {"even id"} and failed.filter("id_entity % 2 = 1").count() == 0
    # Failed rows are not selected again; the rest is.
    assert I.index_remaining(tables, store, 1) == 1
    assert store.read("status").count() == total
    assert store.documents(1).count() == total - failed.count()


def test_stream_equals_batch(spark, tables, sf_dir, tmp_path):
    source, out = str(tmp_path / "changes"), str(tmp_path / "out")
    first = spark.range(12).selectExpr("id AS id_entity", "'upsert' AS op", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts", "id AS change_id")
    second = spark.createDataFrame(
        [(3, "delete", 100), (4, "delete", 101), (4, "upsert", 102), (5, "upsert", 103)], "id_entity long, op string, change_id long"
    ).selectExpr("id_entity", "op", "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS ts", "change_id")
    first.coalesce(1).write.mode("append").parquet(source)
    query = I.run_incremental(spark, lambda s: tables, source, out)
    query.awaitTermination(300)
    store = Store(spark, out)
    assert keys(store.documents(1)) == keys(product_documents(tables))
    second.coalesce(1).write.mode("append").parquet(source)
    I.run_incremental(spark, lambda s: tables, source, out).awaitTermination(300)
    want = {k for k in keys(product_documents(tables)) if k[0] != 3}
    assert keys(store.documents(1)) == want
    assert store.read("status").filter("id_entity = 3").count() == 0
    assert len(store.snapshots("status")) == 2


def test_streams_on_a_loaded_store_lose_nothing(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    store = Store(spark, out)
    I.index_remaining(tables, store, 1)
    want = keys(store.documents(1))
    for k, (entity, op) in enumerate(((3, "delete"), (4, "upsert"))):
        source = str(tmp_path / f"source-{k}")
        spark.createDataFrame([(entity, op, 1)], "id_entity long, op string, change_id long").selectExpr("id_entity", "op", "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS ts", "change_id").write.parquet(source)
        I.run_incremental(spark, lambda s: tables, source, out).awaitTermination(300)
        assert keys(store.documents(1)) == {x for x in want if x[0] != 3}
    assert store.claim("one", 0) == store.claim("one", 0) != store.claim("one", 1)


def test_replayed_batch_changes_nothing(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    I.index_batch(tables, store, 1, 1)
    before = (keys(store.documents(1)), store.read("status").count())
    I.index_batch(tables, store, 1, 1)
    assert (keys(store.documents(1)), store.read("status").count()) == before


def test_publish_and_erase(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    docs = spark.createDataFrame(
        [(1, "product", s, 1) for s in (1, 2, 3)], "id long, elastic_type string, elastic_id_shop int, elastic_id_lang int"
    )
    for version in (1, 2):
        store.write_documents(docs, version, 1)
    pairs = docs.selectExpr("elastic_id_shop AS id_shop", "elastic_id_lang AS id_lang")
    pointers = P.publish(spark.createDataFrame([], "alias string, version int"), "shop", 1, pairs)
    store.write("pointers", pointers)
    store.write("pointers", P.publish(store.read("pointers"), "shop", 2, pairs.filter("id_shop = 2")))
    live = P.published(store.documents(), store.read("pointers"), "shop")
    assert {(r.elastic_id_shop, r.version) for r in live.collect()} == {(1, 1), (2, 2), (3, 1)}
    shops = spark.createDataFrame([(2,), (3,)], "id_shop int")
    langs = spark.createDataFrame([(1,)], "id_lang int")
    existing = pairs.select("id_shop", "id_lang", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    assert store.erase(P.plan_erase(existing, [2], langs, shops)) == 2
    assert {(r.elastic_id_shop, r.version) for r in store.documents().collect()} == {(1, 1), (2, 1), (3, 1), (1, 2)}
    assert P.plan_erase(existing, None, langs, shops).count() == 0


def test_late_older_changes_do_not_win_in_any_batching(spark, tmp_path):
    from itertools import permutations

    changes = {1: "upsert", 2: "upsert", 3: "delete"}
    for k, order in enumerate([list(p) for p in permutations(changes)] + [[(1, 3), 2], [3, (1, 2)], [2, 3, 3, 1]]):
        store = Store(spark, str(tmp_path / f"s{k}"))
        for number, batch in enumerate(order, 1):
            rows = [(7, changes[x], x) for x in (batch if isinstance(batch, tuple) else (batch,))] + [(8 + number, "upsert", number)]
            frame = spark.createDataFrame(rows, "id_entity long, op string, change_id long").selectExpr("*", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, change_id) AS ts")
            I.hear(store, frame, number)
        assert [(r.op, r.change_id) for r in store.marks.read().filter("id_entity = 7").collect()] == [("delete", 3)]


def test_late_upsert_leaves_a_deleted_document_deleted(spark, tables, tmp_path):
    source, out = str(tmp_path / "changes"), str(tmp_path / "out")
    store = Store(spark, out)
    I.index_remaining(tables, store, 1)
    want = {k for k in keys(store.documents(1)) if k[0] != 3}
    for entity, op, day in ((3, "delete", 3), (3, "upsert", 2)):
        spark.createDataFrame([(entity, op, day)], "id_entity long, op string, change_id long").selectExpr(
            "id_entity", "op", "make_timestamp_ntz(2024, 1, CAST(change_id AS INT), 0, 0, 0) AS ts", "change_id").write.mode("append").parquet(source)
        I.run_incremental(spark, lambda s: tables, source, out).awaitTermination(300)
        assert keys(store.documents(1)) == want


def test_ledger_equals_a_rewrite_and_reads_only_touched_buckets(spark, tmp_path):
    from shelfweave.sources.ledger import Ledger

    log = Ledger(spark, str(tmp_path), "t", "id long, sub string, value long", ["id", "sub"], buckets=8)
    frame = lambda rows: spark.createDataFrame(rows, "id long, sub string, value long")
    plain = {}
    assert log.read().count() == 0
    for number in range(1, 13):
        rows = [(i, s, 100 * number + i) for i in range(number, 60, number) for s in "ab" if (i + number) % 3]
        gone = [(i, "a", 0) for i in range(number + 1, 60, 7) if (i + number) % 3 == 0]
        if number in (6, 11):
            due = log.compact(number, least=2)
            assert due and log.numbers("base")
        log.append(frame(rows), number, frame(gone))
        if number == 9:
            log.append(frame(rows), number, frame(gone))  # a replay
        plain.update({(i, s): v for i, s, v in rows})
        for i, s, _ in gone:
            plain.pop((i, s), None)
        asked = frame([(5, "a", 0), (12, "b", 0)]).select("id")
        assert {(r.id, r.sub): r.value for r in log.read(keys=asked).collect()} == {k: v for k, v in plain.items() if k[0] in (5, 12)}
    assert {(r.id, r.sub): r.value for r in log.read().collect()} == plain
    touched = log.touched(frame([(5, "a", 0)]))
    one = log.log(buckets=touched)
    assert {r[0].split("bucket=")[1].split("/")[0] for r in one.select(F.input_file_name()).collect()} == set(map(str, touched)) and len(touched) == 1
    filters = [x for x in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]]
    assert filters and all("bucket" in f.split("PushedFilters")[0] for f in filters)
    late = Ledger(spark, str(tmp_path), "late", "id long, value long", ["id"], buckets=2)
    rows = lambda v: spark.createDataFrame([(1, v)], "id long, value long")
    for number in (2, 3, 5):
        late.append(rows(number), number)
    late.compact(6, least=1)
    late.append(rows(4), 4)  # claimed before, written after the compaction
    assert [r.value for r in late.read().collect()] == [5]
    assert late.buckets == 2 and Ledger(spark, str(tmp_path), "late", "id long, value long", ["id"]).buckets == 2


def test_all_document_types_are_indexed_and_changes_reach_what_depends_on_them(spark, sf_dir, tmp_path):
    small = Smaller(spark, sf_dir)
    out, source = str(tmp_path / "out"), str(tmp_path / "changes")
    store = Store(spark, out)
    names = ["category", "taxrule", "manufacturer"]
    assert I.index_all(small, store, 1, names) == dict.fromkeys(names, 1)
    assert I.index_all(small, store, 1, names[:1]) == {"category": 0}
    for name in names:
        whole = R.ENTITIES[name].builder(small)
        assert keys(store.documents(1, name)) == keys(whole) and whole.count() == store.documents(1, name).count()
        assert all(r.done for r in I.completeness(small, store, name).collect())
    feed = [(101, "upsert", 1, "category"), (11, "delete", 2, "manufacturer"), (3, "upsert", 3, "tax_rate")]
    spark.createDataFrame(feed, "id_entity long, op string, change_id long, entity string").selectExpr("*", "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS ts").write.parquet(source)
    I.run_incremental(spark, lambda s: small, source, out, entities=names).awaitTermination(300)
    batches = spark.read.schema("id long, deleted boolean, version int, batch int, elastic_type string").parquet(f"{out}/documents").drop("version").distinct()
    last = {(r.elastic_type, r.id, r.deleted) for r in batches.filter(f"batch > {len(names)}").collect()}
    above = {r.id_ancestor for r in C.ancestors(small.category).filter("id_category = 101").collect()}
    active = {r.id_category for r in small.category.filter("active").collect()}
    group = {r.id_tax_rules_group for r in small.tax_rule.filter("id_tax_rule = 3").collect()}
    assert last == {("category", i, False) for i in above & active - {101}} | {("manufacturer", 11, True)} | {("taxrule", i, False) for i in group}


def test_a_type_of_ones_own_with_hooks(spark, tables, tmp_path):
    calls = []

    def builder(t, rows=None):
        calls.append("build")
        docs = t.supplier_name.selectExpr("id_supplier AS id_entity", "supplier_name AS name", "0 AS id_lang", "1 AS id_shop")
        return R.project(docs if rows is None else docs.join(rows.select("id_entity"), "id_entity", "left_semi"), R.ENTITIES["vendor"])

    def changed(rows, status, name, dated=True, limit=0, offset=0):
        calls.append("change")
        return rows.join(status.select("id_entity"), "id_entity", "left_anti").filter("id_entity <> 4")

    R.register_entity(R.Entity(
        "vendor", key="id_supplier", attributes=(R.Attribute("id"), R.Attribute("name", "text")), builder=builder, changed=changed,
        rows=lambda t: t.supplier_name.selectExpr("id_supplier AS id_entity", "1 AS id_shop", "0 AS id_lang"),
        counter=lambda t: t.supplier_name.filter("id_supplier <> 4").selectExpr("1 AS id_shop").groupBy("id_shop").agg(F.count(F.lit(1)).alias("total")),
    ))
    try:
        store = Store(spark, str(tmp_path))
        assert I.index_remaining(tables, store, 1, entity="vendor") == 1 and calls.count("build") == 1 and calls.count("change") == 3
        total = tables.supplier_name.count()
        assert {r.id for r in store.documents(1, "vendor").collect()} == set(range(total)) - {4}
        assert [r.total for r in I.completeness(tables, store, "vendor").collect()] == [total - 1]
    finally:
        del R.ENTITIES["vendor"]


def test_a_round_that_breaks_off_is_tried_again_three_times(spark, tables, tmp_path, monkeypatch):
    tries, whole = [], I.index_batch

    def flaky(*args, **more):
        tries.append(args[3])
        if len(tries) in (1, 2, 4, 5):
            raise RuntimeError("lost")
        return whole(*args, **more)

    monkeypatch.setattr(I, "index_batch", flaky)
    store = Store(spark, str(tmp_path / "a"))
    rows = R.ENTITIES["manufacturer"].rows(tables).count()
    assert I.index_remaining(tables, store, 1, chunk=-(-rows // 2), entity="manufacturer") == 2 and tries == [1, 1, 1, 2, 2, 2]
    monkeypatch.setattr(I, "index_batch", lambda *args, **more: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        I.index_remaining(tables, Store(spark, str(tmp_path / "b")), 1, entity="manufacturer")

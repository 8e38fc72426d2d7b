"""Continuous indexing of any registered document type: the batch jobs of the other modules, driven by the status log or a change feed."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfweave.operators import hooks
from shelfweave.operators import sync as Y
from shelfweave.operators.registry import ENTITIES, Entity, affected, default_updated_at
from shelfweave.operators.relational import first_per_key
from shelfweave.session import checkpoint_root
from shelfweave.sources.store import STATUS_KEY, Store, judged

CHANGE_SCHEMA = "id_entity long, op string, ts timestamp_ntz, change_id long, entity string"
CHECKS: dict[str, Callable[[], Column]] = {"missing name": lambda: F.col("name").isNotNull(), "negative price": lambda: F.col("price") >= 0}
ATTEMPTS = 3
product_entity_rows = hooks.product_rows


def latest_changes(changes: DataFrame) -> DataFrame:
    """The last change of each entity by (ts, change_id); without ``entity`` the ids are those of products."""
    keys = [c for c in ("entity", "id_entity") if c in changes.columns]
    return first_per_key(changes.select(*keys, "op", "ts", "change_id"), keys, [F.col("ts"), F.col("change_id")], keep_last=True)


def newer(changes: DataFrame, marks: DataFrame) -> DataFrame:
    """Changes that come after the last one heard of their entity, by (ts, change_id): what arrives late is left out."""
    heard = marks.select("entity", "id_entity", F.struct("ts", "change_id").alias("_heard"))
    after = F.col("_heard").isNull() | (F.struct("ts", "change_id") > F.col("_heard"))
    return changes.join(heard, ["entity", "id_entity"], "left").filter(after).drop("_heard")


def hear(store: Store, changes: DataFrame, number: int) -> DataFrame:
    """Takes a batch of changes into the marks and returns those that count, read back from what was written.

    A mark is the last change of an entity, deletions too, so batches may bring changes in any order: the last by (ts, change_id) stands. Only the
    buckets of the batch's entities are read. A replay sees the marks of lower numbers and writes the same again.
    """
    store.marks.compact(number)
    last = latest_changes(changes)
    last = last.withColumn("entity", F.coalesce("entity", F.lit("product"))) if "entity" in last.columns else last.withColumn("entity", F.lit("product"))
    store.marks.append(newer(last, store.marks.read(number, last)), number)
    return store.marks.log().filter(F.col("_number") == number).select("entity", "id_entity", "op", "ts", "change_id")


def due(kind: Entity, rows: DataFrame, status: DataFrame, limit: int = 0) -> DataFrame:
    """The rows of a type that are new or changed, by its own rule where it has one."""
    choose = kind.changed or Y.objects_to_index
    return choose(rows, status, kind.name, dated="date_upd" in rows.columns, limit=limit)


def _tombstones(status: DataFrame) -> DataFrame:
    return status.select(
        F.col("id_entity").alias("id"), F.col("index").alias("elastic_type"), F.col("id_shop").alias("elastic_id_shop"),
        F.col("id_lang").alias("elastic_id_lang"), F.col("date_upd").alias("updated_at"), F.lit(True).alias("deleted"),
    )


def index_batch(
    tables, store: Store, version: int, batch: int, changes: DataFrame | None = None, limit: int = 0,
    checks: Mapping[str, Callable[[], Column]] | None = None, entity: str = "product", run_at: Column | None = None,
) -> None:
    """One round of a document type: select what is new or changed, build, write, and record the outcome in the status log.

    With ``changes`` (id_entity, op, and ``forced`` where a document is due whatever its date) only the entities they name are looked at, in the
    status buckets they fall into; deleted ones leave a tombstone. A replay of the batch reads the same earlier status and replaces its own
    output. Documents without a date of their own take that of the run, ``run_at``.
    """
    kind = ENTITIES[entity]
    store.status.compact(batch)
    rows = kind.rows(tables)
    if changes is None:
        known = store.status.read(batch).filter(F.col("index") == entity)
        todo, removed = due(kind, rows, known, limit), None
    else:
        known = store.status.read(batch, changes.select("id_entity")).filter(F.col("index") == entity)
        wanted = changes.filter(F.col("op") != "delete")
        always = F.col("forced") if "forced" in changes.columns else F.lit(False)
        forced = wanted.filter(always | F.lit("date_upd" not in rows.columns)).select("id_entity", F.lit(True).alias("_forced")).distinct()
        seen = known.join(forced, "id_entity", "left").withColumn("date_upd", F.when(F.col("_forced").isNull(), F.col("date_upd"))).drop("_forced")
        todo = due(kind, rows.join(wanted.select("id_entity"), "id_entity", "left_semi"), seen, limit)
        removed = known.join(changes.filter(F.col("op") == "delete").select("id_entity"), "id_entity", "left_semi")
    docs = default_updated_at(kind.builder(tables, todo), run_at if run_at is not None else F.current_date())
    if checks is None:
        checks = CHECKS if entity == "product" else {}
    docs = judged(docs.withColumn("updated_at", F.col("updated_at").cast("date")), {text: holds() for text, holds in checks.items()}).withColumn("deleted", F.lit(False))
    if removed is not None:
        docs = docs.unionByName(_tombstones(removed), allowMissingColumns=True)
    store.write_documents(docs, version, batch)
    # The written batch, not the document plan, feeds the status: nothing is built twice.
    outcome = store.outcome(version, batch)
    if outcome is None:
        store.status.append(known.limit(0), batch, removed)
        return
    outcome = outcome.withColumn("date_upd", F.col("date_upd").cast("date"))
    store.status.append(Y.upsert_status(known.join(outcome, STATUS_KEY, "left_semi"), outcome), batch, removed)


def completeness(tables, store: Store, entity: str = "product") -> DataFrame:
    """Per shop: total (id_shop, total of objects), rows due in all, indexed, failed, and whether all but the failures are in."""
    kind = ENTITIES[entity]
    rows = kind.rows(tables)
    status = store.status.read().filter(F.col("index") == entity).select(*[c for c in STATUS_KEY if c != "index"], F.col("date_upd").alias("_date"), "error", F.lit(True).alias("_known"))
    fits = (F.col("_date") == F.col("date_upd")) if "date_upd" in rows.columns else F.col("_known")
    both = rows.join(status, ["id_entity", "id_shop", "id_lang"], "left")
    counted = both.groupBy("id_shop").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("error").isNull() & fits).alias("indexed"), F.count_if(F.col("error").isNotNull()).alias("errors"),
    )
    totals = kind.counter(tables) if kind.counter else rows.groupBy("id_shop").agg(F.count_distinct("id_entity").alias("total"))
    return totals.join(counted, "id_shop").withColumn("done", F.col("indexed") == F.col("rows") - F.col("errors"))


def index_remaining(tables, store: Store, version: int, chunk: int = 0, rounds: int | None = None, entity: str = "product", attempts: int = ATTEMPTS) -> int:
    """Rounds until all documents but the failed ones are in or ``rounds`` is reached; returns their number.

    ``chunk`` 0 does all in one set-based round, which is what a cluster should use. A round that breaks off is tried again up to ``attempts``
    times, counted anew after every success; its number stays the same, so it replaces what it left behind.
    """
    done, left, run = 0, attempts, f"remaining-{entity}-{uuid.uuid4().hex}"
    while rounds is None or done < rounds:
        if due(ENTITIES[entity], ENTITIES[entity].rows(tables), store.status.read().filter(F.col("index") == entity)).isEmpty():
            break
        try:
            index_batch(tables, store, version, store.claim(run, done), limit=chunk, entity=entity)
        except Exception:
            left -= 1
            if not left:
                raise
            continue
        done, left = done + 1, attempts
    return done


def index_all(tables, store: Store, version: int, entities: Sequence[str] | None = None, chunk: int = 0) -> dict[str, int]:
    """``index_remaining`` of every document type that has hooks (or of those named), one after the other; rounds by type."""
    names = [n for n, e in ENTITIES.items() if e.rows and e.builder] if entities is None else entities
    return {n: index_remaining(tables, store, version, chunk, entity=n) for n in names}


def run_incremental(
    spark: SparkSession, tables_of: Callable[[SparkSession], object], source_dir: str, out_dir: str, version: int = 1, checkpoint: str | None = None,
    files_per_batch: int | None = None, entities: Sequence[str] = ("product",),
):
    """Follows a folder of change files (``CHANGE_SCHEMA``) until all present ones are handled.

    Changes may be of any table that documents depend on; the documents of the types in ``entities`` that they reach are indexed anew.
    """
    reader = spark.readStream.schema(CHANGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    store = Store(spark, out_dir)

    # The shared folder serves many streams: the name stands for this source, target and checkpoint.
    name = hashlib.sha256(f"{source_dir}|{out_dir}|{version}".encode()).hexdigest()[:16]
    place = checkpoint or f"{checkpoint_root(spark, out_dir)}/stream-{name}"
    stream = hashlib.sha256(place.encode()).hexdigest()[:16]

    def handle(batch: DataFrame, batch_id: int) -> None:
        tables, number = tables_of(spark), store.claim(stream, f"{batch_id}-marks")
        heard = hear(store, batch, number)
        store.write("affected", affected(tables, heard), number)
        reached = spark.read.parquet(f"{store.root}/affected/snapshot={number}")
        for entity in sorted(r[0] for r in reached.select("entity").filter(F.col("entity").isin(list(entities))).distinct().collect()):
            index_batch(tables, store, version, store.claim(stream, f"{batch_id}-{entity}"), changes=reached.filter(F.col("entity") == entity), entity=entity)

    return reader.parquet(source_dir).writeStream.foreachBatch(handle).option("checkpointLocation", place).trigger(availableNow=True).start()

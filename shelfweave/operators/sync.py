"""Incremental selection, load outcome and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweave.functions import fixed_values as fv
from shelfweave.operators.relational import numbered

STATUS_KEY = ["id_entity", "index", "id_shop", "id_lang"]
# Beyond this page end a single-task top-n would grow too large; positions are computed instead.
_PAGE_BOUND = 100_000


def objects_to_index(rows: DataFrame, status: DataFrame, entity: str, dated: bool = True, limit: int = 0, offset: int = 0) -> DataFrame:
    """Rows that are new or changed against the status table.

    ``rows`` has ``id_entity, id_lang, id_shop`` and, when ``dated``, the ``date_upd`` that counts
    for change (of the shop row or of the object). Failed rows stay out until their status is
    erased; any differing date counts as a change, also a newer one in the status table.
    """
    known = status.filter(F.col("index") == entity).select(
        "id_entity", "id_shop", "id_lang", F.col("date_upd").alias("_seen"), F.col("error").alias("_error")
    )
    fresh = F.col("_seen").isNull()
    if dated:
        fresh = fresh | (F.col("_seen") != F.col("date_upd"))
    changed = rows.join(known, ["id_entity", "id_shop", "id_lang"], "left").filter(F.col("_error").isNull() & fresh)
    return page(changed.select(*rows.columns), limit, offset)


def page(rows: DataFrame, limit: int = 0, offset: int = 0) -> DataFrame:
    """Rows ``offset+1 .. offset+limit`` by (id_entity, id_lang, id_shop); limit 0 means no limit."""
    if not limit and not offset:
        return rows
    order = ["id_entity", "id_lang", "id_shop"]
    if limit and offset + limit <= _PAGE_BOUND:
        return rows.orderBy(*order).offset(offset).limit(limit)
    placed = numbered(rows, "id_entity", ties=order[1:], name="_no").filter(F.col("_no") > offset)
    if limit:
        placed = placed.filter(F.col("_no") <= offset + limit)
    return placed.drop("_no")


def assign_chunks(rows: DataFrame, size: int = fv.DEFAULT_CHUNK, partition: tuple[str, ...] = ("elastic_type", "id_shop", "id_lang")) -> DataFrame:
    """Batch number (from 0) of each row within its target, ``size`` rows each; id order."""
    placed = numbered(rows, "id_entity", groups=partition, name="_no")
    return placed.withColumn("chunk", F.floor((F.col("_no") - 1) / size).cast("bigint")).drop("_no")


def parse_route(results: DataFrame) -> DataFrame:
    """Shop and language recovered from the target name; 0 where the name has another form."""
    pattern = r"([a-zA-Z]+)_(\d+)_(\d+)"

    def part(group: int) -> Column:
        return F.regexp_extract("route", pattern, group)

    return results.withColumns({
        "prefix": part(1),
        "id_shop": F.coalesce(part(2).try_cast("int"), F.lit(0)),
        "id_lang": F.coalesce(part(3).try_cast("int"), F.lit(0)),
    })


def failures(results: DataFrame) -> DataFrame:
    """Rejected rows with their error text: every status outside 2xx."""
    reason = F.when(
        F.col("reason").isNotNull(), F.concat_ws(" ", "reason", "caused_by")
    ).otherwise(F.lit("Unknown error"))
    refused = results.filter(F.substring(F.col("status").cast("string"), 1, 1) != "2")
    return parse_route(refused).select("id_entity", F.col("type").alias("index"), "id_shop", "id_lang", reason.alias("error"))


def split_outcome(batch: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, failed) rows of a batch keyed like the status table; together they are the batch."""
    failed_keys = failures(results)
    failed = batch.join(failed_keys, STATUS_KEY, "inner")
    return batch.join(failed_keys, STATUS_KEY, "left_anti"), failed


def bulk_outcome(batch: DataFrame, results: DataFrame) -> DataFrame:
    """The batch with one ``ok`` flag and error text per row, in one pass."""
    judged = batch.join(failures(results), STATUS_KEY, "left")
    return judged.withColumn("ok", F.col("error").isNull())


def upsert_status(status: DataFrame, outcome: DataFrame) -> DataFrame:
    """The status table after a load.

    ``outcome`` has the status key, ``date_upd`` and ``error`` (NULL = accepted). An accepted row
    takes the new date and clears its error; a failed known row keeps its date; a failed new row
    is added with the date of the object.
    """
    new = outcome.select(*STATUS_KEY, F.col("date_upd").alias("_date"), F.col("error").alias("_error"), F.lit(True).alias("_new"))
    old = status.select(*STATUS_KEY, "date_upd", "error", F.lit(True).alias("_old"))
    joined = old.join(new, STATUS_KEY, "full_outer")
    touched, accepted = F.col("_new").isNotNull(), F.col("_error").isNull()
    return joined.select(
        *STATUS_KEY,
        F.when(touched & (accepted | F.col("_old").isNull()), F.col("_date")).otherwise(F.col("date_upd")).alias("date_upd"),
        F.when(touched, F.col("_error")).otherwise(F.col("error")).alias("error"),
    )


def erase_status(status: DataFrame, id_shop: int | None = None) -> DataFrame:
    """The status table without one shop, or empty."""
    return status.filter(F.lit(False)) if id_shop is None else status.filter(F.col("id_shop") != id_shop)


def indexed_count(status: DataFrame, objects: DataFrame, entity: str, dated: bool = True) -> DataFrame:
    """Up-to-date status rows per (shop, language).

    ``objects`` has ``id_entity`` and, when its dates are per shop, ``id_shop``; ``date_upd`` when ``dated``.
    """
    on = [c for c in ("id_entity", "id_shop") if c in objects.columns]
    done = status.filter((F.col("index") == entity) & F.col("error").isNull())
    side = objects.select(*on, *([F.col("date_upd").alias("_date")] if dated else []))
    matched = done.join(side, on)
    if dated:
        matched = matched.filter(F.col("date_upd") == F.col("_date"))
    return matched.groupBy("id_shop", "id_lang").agg(F.count(F.lit(1)).alias("indexed"))


def count_objects(objects: DataFrame) -> DataFrame:
    """Objects per shop."""
    return objects.groupBy("id_shop").agg(F.count(F.lit(1)).alias("total"))


def nb_errors(status: DataFrame, index: str | None = None, id_lang: int | None = None, id_shop: int | None = None) -> DataFrame:
    """Failed rows per (index, shop, language), optionally of one of each."""
    rows = status.filter(F.col("error").isNotNull())
    for column, value in (("index", index), ("id_lang", id_lang), ("id_shop", id_shop)):
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    return rows.groupBy("index", "id_shop", "id_lang").agg(F.count(F.lit(1)).alias("errors"))


def count_languages(lang_shop: DataFrame, lang: DataFrame) -> DataFrame:
    """Active languages per shop."""
    active = lang.filter(F.col("active")).select("id_lang")
    return lang_shop.join(active, "id_lang").groupBy("id_shop").agg(F.count(F.lit(1)).alias("languages"))


def progress(indexed: DataFrame, totals: DataFrame, errors: DataFrame, languages: DataFrame) -> DataFrame:
    """Completeness per shop: counts, percent with two decimals, and whether all but the failures are in.

    All four inputs are per-shop counts, so this joins a handful of rows.
    """
    joined = totals.join(indexed, "id_shop", "left").join(errors, "id_shop", "left").join(languages, "id_shop", "left")
    zero = F.lit(0).cast("bigint")
    filled = joined.select(
        "id_shop", "total", F.coalesce("indexed", zero).alias("indexed"), F.coalesce("errors", zero).alias("errors"),
        (F.col("total") * F.coalesce("languages", zero)).alias("expected"),
    )
    ratio = F.col("indexed") / F.nullif(F.col("total").cast("double"), F.lit(0.0)) * 100
    return filled.withColumns({
        "percent": F.round(ratio, 2),
        "done": F.col("indexed") == F.col("total") - F.col("errors"),
    })

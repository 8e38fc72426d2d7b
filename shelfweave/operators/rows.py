"""Which (entity, language, shop) rows exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweave.operators.relational import spread


def active_entities(base: DataFrame, shop: DataFrame | None, key: str, active_level: str | None) -> DataFrame:
    """Entity x shop rows that are active: at shop level, at object level, or unconditionally (None)."""
    rows = base.filter(F.col("active")) if active_level == "object" else base
    if shop is None:
        return rows
    side = shop.filter(F.col("active")) if active_level == "shop" else shop
    clash = [c for c in side.columns if c in rows.columns and c != key]
    return rows.drop(*clash).join(side, key)


def entity_rows(
    base: DataFrame,
    shop: DataFrame | None = None,
    lang: DataFrame | None = None,
    *,
    key: str,
    active_level: str | None = None,
    multilang: bool = True,
    multilang_shop: bool = False,
    id_shop: int | None = None,
    id_lang: int | None = None,
    only_active: bool = True,
) -> DataFrame:
    """One row per (entity, language, shop).

    ``shop`` is the per-shop table of the entity (its columns replace those of ``base`` with the same name), ``lang`` its
    translation table, or for ``multilang=False`` the table of languages. Without ``id_lang`` an
    untranslated entity appears once with language 0; with it, only translated ones remain.
    """
    if shop is not None and id_shop is not None:
        shop = shop.filter(F.col("id_shop") == id_shop)
    rows = active_entities(base, shop, key, active_level if only_active else None)
    if lang is None:
        return rows
    if not multilang:
        languages = lang.filter(F.col("active"))
        if id_lang is not None:
            languages = languages.filter(F.col("id_lang") == id_lang)
        return spread(rows, languages.select([c for c in languages.columns if c not in rows.columns and c != "active"]))
    side = lang if id_lang is None else lang.filter(F.col("id_lang") == id_lang)
    on = [key]
    if multilang_shop and "id_shop" in side.columns:
        if id_shop is not None:
            side = side.filter(F.col("id_shop") == id_shop)
        on.append("id_shop")
    joined = rows.join(side, on, "inner" if id_lang is not None else "left")
    return joined.withColumn("id_lang", F.coalesce("id_lang", F.lit(0)).cast("int"))

"""Target names, versions and the pointer that says which version is live."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweave.operators.relational import spread


def target_name(prefix: str, shop: Column, lang: Column, version: Column | int | None = None) -> Column:
    parts = [F.lit(prefix), shop.cast("string"), lang.cast("string")]
    if version is not None:
        parts.append((version if isinstance(version, Column) else F.lit(version)).cast("string"))
    return F.concat_ws("_", *parts)


def route(docs: DataFrame, prefix: str, version: int) -> DataFrame:
    """Documents with their target name, type and id."""
    return docs.withColumns({
        "target": target_name(prefix, F.col("elastic_id_shop"), F.col("elastic_id_lang"), version),
        "target_type": F.col("elastic_type"),
        "target_id": F.col("id").cast("string"),
    })


def plan_new_version(shops: DataFrame, languages: DataFrame, prefix: str, current: int) -> DataFrame:
    """The targets of the next version: one per shop and active language."""
    pairs = spread(shops.select("id_shop"), languages.filter(F.col("active")).select("id_lang"))
    return pairs.select(
        "id_shop", "id_lang", F.lit(current + 1).alias("version"),
        target_name(prefix, F.col("id_shop"), F.col("id_lang"), current + 1).alias("target"),
    )


def publish(pointers: DataFrame, prefix: str, version: int, targets: DataFrame) -> DataFrame:
    """The pointer table after the given (id_shop, id_lang) rows switch to ``version``; the rest stays."""
    moved = targets.select(
        target_name(prefix, F.col("id_shop"), F.col("id_lang")).alias("alias"), F.lit(version).alias("version"),
    ).distinct()
    return pointers.join(moved, "alias", "left_anti").select("alias", "version").unionByName(moved)


def published(docs: DataFrame, pointers: DataFrame, prefix: str) -> DataFrame:
    """Documents of the live version of each target. ``docs`` carries its ``version``."""
    named = docs.withColumn("alias", target_name(prefix, F.col("elastic_id_shop"), F.col("elastic_id_lang")))
    return named.join(pointers, ["alias", "version"], "left_semi").select(*docs.columns)


def plan_erase(existing: DataFrame, versions: Iterable[int] | None, langs: DataFrame, shops: DataFrame) -> DataFrame:
    """Existing targets to drop: those of the given versions, languages and shops; none without a version."""
    wanted = list(versions or [])
    rows = existing.filter(F.col("version").isin(wanted)) if wanted else existing.filter(F.lit(False))
    return rows.join(langs.select("id_lang"), "id_lang", "left_semi").join(shops.select("id_shop"), "id_shop", "left_semi")

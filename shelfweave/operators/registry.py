"""Entity declarations, the enabled-entity registry and the schema catalogue."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfweave.functions import fixed_values as fv
from shelfweave.functions.scalars import code_of
from shelfweave.operators.relational import literal_rows


@dataclass(frozen=True)
class Attribute:
    """One document field: a column expression, a constant, or the source column of the same name.

    ``needs`` names the parts of the builder's input, beyond the entity's own rows, that the field is worked out from.
    """

    name: str
    type: str | None = None
    expr: Callable[[], Column] | None = None
    const: object = None
    allowed_types: tuple[str, ...] | None = None
    visible: bool = True
    children: tuple[tuple[str, str], ...] = ()
    type_configurable: bool = False
    needs: tuple[str, ...] = ()

    def column(self) -> Column:
        if self.expr is not None:
            return self.expr().alias(self.name)
        if self.const is not None:
            return F.lit(self.const).alias(self.name)
        return F.col(self.name)


@dataclass(frozen=True)
class Dependency:
    """Documents that take something from another table: ``links`` gives (source_id, id_entity) pairs of rows of ``source`` and documents."""

    source: str
    links: Callable[..., DataFrame]


@dataclass(frozen=True)
class Entity:
    """A document type: its fields, how changes are dated, and its hooks.

    ``rows(tables)`` gives the (id_entity, id_shop, id_lang) that should have a document, with ``date_upd`` where changes are dated;
    ``builder(tables, rows)`` the documents, of the given rows only where rows are given; ``changed(rows, status, **page)`` may replace the choice of what is
    due, ``counter(tables)`` the totals (id_shop, total). ``depends`` names the tables whose changes reach the documents.
    """

    name: str
    attributes: tuple[Attribute, ...]
    key: str = "id"
    multilang: bool = True
    active_level: str | None = "object"
    dated: bool = True
    builder: Callable[..., DataFrame] | None = field(default=None, compare=False)
    rows: Callable[..., DataFrame] | None = field(default=None, compare=False)
    changed: Callable[..., DataFrame] | None = field(default=None, compare=False)
    counter: Callable[..., DataFrame] | None = field(default=None, compare=False)
    depends: tuple[Dependency, ...] = field(default=(), compare=False)


ENTITIES: dict[str, Entity] = {}


def register_entity(entity: Entity) -> Entity:
    """Adds or replaces a document type."""
    ENTITIES[entity.name] = entity
    return entity


def attach(name: str, **hooks: object) -> Entity:
    """Gives a registered document type its hooks."""
    return register_entity(replace(ENTITIES[name], **hooks))


def affected(tables, changes: DataFrame) -> DataFrame:
    """(entity, id_entity, op, forced): the documents that changes of (entity, id_entity, op) reach.

    The rows that changed themselves, and over every declared dependency the documents that draw on them, as updates that no date tells
    (``forced``). A document that was itself changed keeps its own operation. Semi-joins on ids; nothing is gathered per source.
    """
    out = changes.select("entity", "id_entity", "op", F.lit(False).alias("forced"))
    for entity in ENTITIES.values():
        for dependency in entity.depends:
            source = changes.filter(F.col("entity") == dependency.source).select(F.col("id_entity").alias("source_id"))
            reached = dependency.links(tables).select("source_id", "id_entity").join(source, "source_id", "left_semi").select("id_entity").distinct()
            out = out.unionByName(reached.select(F.lit(entity.name).alias("entity"), F.col("id_entity").cast("long").alias("id_entity"), F.lit("upsert").alias("op"), F.lit(True).alias("forced")))
    # Deletions first, then own changes, then what was only reached.
    rank = F.when(F.col("op") == "delete", 0).when(F.col("forced"), 2).otherwise(1)
    return out.groupBy("entity", "id_entity").agg(F.min_by("op", rank).alias("op"), F.bool_or("forced").alias("forced"))


def project(rows: DataFrame, entity: Entity, run_at: Column | None = None) -> DataFrame:
    """Envelope columns plus every declared field in one projection; ``updated_at`` falls back to ``run_at``."""
    columns = [
        F.col("id_entity").cast("bigint").alias("id"),
        F.col("id_lang").alias("elastic_id_lang"),
        F.col("id_shop").alias("elastic_id_shop"),
        F.lit(entity.name).alias("elastic_type"),
    ]
    columns += [a.column() for a in entity.attributes if a.name != "id"]
    return default_updated_at(rows.select(*columns), run_at)


def default_updated_at(docs: DataFrame, run_at: Column | None) -> DataFrame:
    """``updated_at`` where it is missing becomes the time of the run, a parameter."""
    if run_at is None:
        return docs
    if "updated_at" not in docs.columns:
        return docs.withColumn("updated_at", run_at)
    return docs.withColumn("updated_at", F.coalesce(F.col("updated_at"), run_at))


def enabled_rows(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows whose (elastic_type, id_shop) is enabled."""
    on = registry.filter(F.col("enabled")).select(F.col("entity_name").alias("elastic_type"), "id_shop")
    return rows.join(on, ["elastic_type", "id_shop"], "left_semi")


def registered(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """(type, shop) pairs with whether documents exist and whether the registry enables them."""
    have = docs.groupBy("elastic_type", "id_shop").agg(F.count(F.lit(1)).alias("documents"))
    listed = registry.filter(F.col("enabled")).select(F.col("entity_name").alias("elastic_type"), "id_shop", F.lit(True).alias("_on"))
    both = have.join(listed, ["elastic_type", "id_shop"], "full_outer")
    return both.select(
        "elastic_type", "id_shop", F.coalesce("documents", F.lit(0).cast("bigint")).alias("documents"),
        F.col("_on").isNotNull().alias("enabled"),
    )


# The analysed variants every text and keyword field carries, and their analysers.
SUB_FIELDS = {
    "trigram": "trigram",
    "reverse": "reverse",
    "lang_pl": "lang_pl",
    "lang_pl_ascii": "lang_pl_ascii",
    "lang_pl_trigram": "lang_pl_trigram",
    "autocomplete": "autocomplete",
}
SEARCH_ANALYZERS = {"autocomplete": "autocomplete_search"}


def _schema_rows(entity: Entity) -> list[tuple]:
    rows: list[tuple] = [(entity.name, "id", "integer", None, None, None)]

    def add(path: str, kind: str, analysed: bool = True) -> None:
        rows.append((entity.name, path, kind, fv.DATE_FORMATS if kind == "date" else None, None, None))
        if analysed and kind in ("text", "keyword"):
            rows.extend((entity.name, f"{path}.{sub}", "text", None, an, SEARCH_ANALYZERS.get(sub)) for sub, an in SUB_FIELDS.items())

    for attribute in entity.attributes:
        if attribute.children:
            add(attribute.name, "nested", False)
            for child, kind in attribute.children:
                add(f"{attribute.name}.{child}", kind)
        elif attribute.type and attribute.name != "id":
            add(attribute.name, attribute.type)
    return rows


def schema_catalog(spark: SparkSession, entities: Mapping[str, Entity], features: DataFrame) -> DataFrame:
    """One row per (entity, field path) with its type, date formats and analysers.

    Feature names of the data become keyword fields of the product unless a declared field has that name.
    """
    schema = "entity string, path string, type string, format string, analyzer string, search_analyzer string"
    declared = literal_rows(spark, [r for e in entities.values() for r in _schema_rows(e)], schema)
    names = features.select(code_of(F.col("name")).alias("path")).distinct()
    taken = declared.filter(F.col("entity") == "product").select("path")
    dynamic = names.join(taken, "path", "left_anti").selectExpr(
        "'product' AS entity", "path", "'keyword' AS type", "CAST(NULL AS STRING) AS format",
        "CAST(NULL AS STRING) AS analyzer", "CAST(NULL AS STRING) AS search_analyzer",
    )
    return declared.unionByName(dynamic)

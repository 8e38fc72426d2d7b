"""Facet counts, bounds and selections over documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweave.functions import fixed_values as fv
from shelfweave.functions.scalars import slugify


def facet_values(docs: DataFrame, fields: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., field, value) rows: one per document and distinct value. Every field is a list column."""
    lists = [F.struct(F.lit(name).alias("field"), F.array_distinct(values.cast("array<string>")).alias("values")) for name, values in fields.items()]
    return docs.select(*keep, F.explode(F.array(*lists)).alias("f")).select(*keep, "f.field", F.explode("f.values").alias("value"))


def facet_counts(values: DataFrame, settings: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Documents per value; only fields in ``settings`` (``field``) where given."""
    rows = values if settings is None else values.join(settings.select("field"), "field", "left_semi")
    return rows.groupBy(*by, "field", "value").agg(F.count(F.lit(1)).alias("n"))


def facet_topk(counts: DataFrame, settings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The most frequent values of each field, as many as its ``result_limit``, whatever that is; 0 and null keep all.

    Fields without a limit never meet a window. The values of the others are cut twice: first in as many lanes as there are shuffle partitions,
    then what is left of all lanes, so no task holds all values of a field.
    """
    lanes = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limited = counts.join(settings.select("field", F.coalesce("result_limit", F.lit(0)).alias("result_limit")), "field")
    best = [F.col("n").desc(), F.col("value")]
    first = F.row_number().over(Window.partitionBy(*by, "field", "_lane").orderBy(*best))
    last = F.row_number().over(Window.partitionBy(*by, "field").orderBy(*best))
    dealt = limited.filter(F.col("result_limit") > 0).withColumn("_lane", F.pmod(F.hash("value"), F.lit(lanes)))
    cut = dealt.withColumn("_rank", first).filter(F.col("_rank") <= F.col("result_limit")).drop("_lane", "_rank")
    top = cut.withColumn("_rank", last).filter(F.col("_rank") <= F.col("result_limit")).drop("_rank")
    return limited.filter(F.col("result_limit") <= 0).unionByName(top).drop("result_limit")


def unpivoted(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., field, value): every field the documents have, one row per distinct value.

    The fields are those of the data: columns by their name, lists by their elements, and the entries of map columns by their keys.
    """
    fields, maps = [], []
    for f in docs.schema.fields:
        kind = f.dataType.typeName()
        if f.name in keep or kind == "struct":
            continue
        if kind == "map":
            values = F.map_values(f.name) if f.dataType.valueType.typeName() == "array" else F.transform(F.map_values(f.name), lambda v: F.array(v))
            maps.append(F.transform(F.arrays_zip(F.map_keys(f.name).alias("field"), values.cast("array<array<string>>").alias("values")), lambda e: F.struct(e["field"].alias("field"), e["values"].alias("values"))))
        else:
            values = F.col(f.name).cast("array<string>") if kind == "array" else F.array(F.col(f.name).cast("string"))
            fields.append(F.struct(F.lit(f.name).alias("field"), values.alias("values")))
    every = F.concat(F.array(*fields), *[F.coalesce(m, F.array().cast("array<struct<field:string,values:array<string>>>")) for m in maps])
    rows = docs.select(*keep, F.explode(every).alias("f")).select(*keep, "f.field", F.explode(F.array_distinct("f.values")).alias("value"))
    return rows.filter(F.col("value").isNotNull())


def facet_range(docs: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """Smallest and largest value."""
    return docs.groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def with_tax(price: Column, rate: Column | None) -> Column:
    """Price including the given rate in percent, or as it is without one."""
    return price if rate is None else F.round(price * (1 + rate / 100), 6)


def chosen(values: Column, selection: Sequence[str], operator: int) -> Column:
    """Whether a document's values satisfy a selection: all of it (AND) or any of it (OR)."""
    wanted = F.array(*[F.lit(s) for s in selection])
    if operator == fv.FACET_AND:
        return F.forall(wanted, lambda w: F.array_contains(values, w))
    return F.arrays_overlap(values, wanted)


def apply_facets(docs: DataFrame, fields: Mapping[str, Column], selections: Mapping[str, tuple[Sequence[str], int]], skip: str | None = None) -> DataFrame:
    """Documents that satisfy every field's selection, except that of ``skip``."""
    for name, (selection, operator) in selections.items():
        if selection and name != skip:
            docs = docs.filter(F.coalesce(chosen(fields[name], selection, operator), F.lit(False)))
    return docs


def selected_counts(docs: DataFrame, fields: Mapping[str, Column], selections: Mapping[str, tuple[Sequence[str], int]], by: Sequence[str] = ()) -> DataFrame:
    """Counts of every field under the selections; a field selected by OR is counted without its own selection.

    One pass over the documents: each field carries the condition it is counted under.
    """
    met = {name: F.coalesce(chosen(fields[name], sel, op), F.lit(False)) for name, (sel, op) in selections.items() if sel}
    lists = []
    for name, values in fields.items():
        held = [c for other, c in met.items() if other != name or selections[other][1] == fv.FACET_AND]
        condition = F.lit(True)
        for c in held:
            condition = condition & c
        kept = F.when(condition, F.array_distinct(values.cast("array<string>")))
        lists.append(F.struct(F.lit(name).alias("field"), kept.alias("values")))
    rows = docs.select(*by, F.explode(F.array(*lists)).alias("f")).select(*by, "f.field", F.explode("f.values").alias("value"))
    return facet_counts(rows, by=by)


def slug_path(path: Column) -> Column:
    """Slugs of the steps of a category path, joined by ``/``."""
    return F.array_join(F.transform(F.split(path, fv.PATH_SEPARATOR), slugify), "/")


def fixed_filter(docs: DataFrame, kind: str, value: str | Column, *, subcategories: bool = True, names: Column | None = None, paths: Column | None = None) -> DataFrame:
    """Documents of a category page or of a brand or supplier page.

    ``value`` is the slug the page stands for, or a column of it where pages differ by language. A category page compares with the slugs of the
    document's category ``names``; with ``subcategories`` the value is a slug path and the document
    needs a category at or below it. Other kinds compare with the slug of the column ``kind``.
    """
    value = F.lit(value) if isinstance(value, str) else value
    if kind != "category":
        return docs.filter(slugify(F.col(kind)) == value)
    if not subcategories:
        return docs.filter(F.exists(names, lambda n: slugify(n) == value))
    under = F.exists(paths, lambda p: F.startswith(F.concat(slug_path(p), F.lit("/")), F.concat(value, F.lit("/"))))
    return docs.filter(under)

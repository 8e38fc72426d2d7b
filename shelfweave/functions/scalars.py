"""Column helpers; every one is a composition of built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfweave.functions import fixed_values as fv

_BLANKS = " \t\n\r\0\x0b"


def fold_accents(c: Column) -> Column:
    """Latin letters without their accents; ligatures spelled out."""
    out = F.translate(c, fv.ACCENTS_FROM, fv.ACCENTS_TO)
    for source, target in fv.LIGATURES:
        out = F.replace(out, F.lit(source), F.lit(target))
    return out


def slugify(c: Column) -> Column:
    """Lower-case ASCII words joined by single dashes."""
    words = F.regexp_replace(fold_accents(F.lower(c)), "[^a-z0-9]+", "-")
    return F.trim(words, F.lit("-"))


def code_of(c: Column) -> Column:
    """Field code of a label: lower case, blanks become underscores."""
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def trim_blanks(c: Column) -> Column:
    return F.trim(c, F.lit(_BLANKS))


def split_trim(c: Column, separator: str = ",") -> Column:
    """Parts of a separated list, each without surrounding blanks."""
    return F.transform(F.split(c, separator), trim_blanks)


def php_int(c: Column) -> Column:
    """Leading number of a text as a whole number, 0 where there is none."""
    number = F.regexp_extract(c, r"^\s*([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)", 1)
    plain = F.regexp_extract(number, r"^[+-]?\d+$", 0)
    whole = F.when(plain != "", plain.try_cast("bigint")).when(number != "", number.try_cast("double").try_cast("bigint"))
    return F.coalesce(whole, F.lit(0).cast("bigint"))


def php_bool(c: Column) -> Column:
    """Truth of a text: NULL, '' and '0' are false."""
    text = c.cast("string")
    return text.isNotNull() & ~text.isin("", "0")


def image_path(c: Column) -> Column:
    """``/p/1/2/3/123.jpg`` for image 123, ``/p//.jpg`` without one."""
    digits = F.coalesce(c.cast("string"), F.lit(""))
    folders = F.when(digits == "", F.lit("/")).otherwise(F.regexp_replace(digits, "(.)", "$1/"))
    return F.concat(F.lit("/p/"), folders, digits, F.lit(".jpg"))


def cover_link(id_image: Column, slug: Column, size: str) -> Column:
    """Link of the cover image in a named size, or the default picture of that size."""
    own = F.concat(F.lit("/"), id_image.cast("string"), F.lit(f"-{size}_default/"), slug, F.lit(".jpg"))
    return F.when(id_image.isNotNull(), own).otherwise(F.lit(f"en-default-{size}_default.jpg"))


def parse_date(c: Column) -> Column:
    """Timestamp of a text in any of the three accepted date formats, else NULL."""
    millis = F.nullif(F.regexp_extract(c, r"^-?\d{5,}$", 0), F.lit("")).try_cast("bigint")
    since_epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=millis.cast("decimal(18,3)") / 1000)
    return F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("timestamp_ntz"),
        since_epoch,
    )


def stop_word_set(iso: Column) -> Column:
    """Name of the stop-word set of a language code."""
    pairs = F.create_map(*[F.lit(x) for pair in fv.STOPWORD_SETS.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, F.lower(iso)), F.lit(fv.STOPWORD_SETS[fv.DEFAULT_STOPWORD_ISO]))


def autocomplete_text(*parts: Column) -> Column:
    """Parts joined by one blank each; a missing part leaves its blank."""
    return F.concat_ws(" ", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def price_columns(base: Column, rate: Column, reduction: Column, group_reduction: Column | None = None, ecotax: Column | None = None) -> dict[str, Column]:
    """The five price fields of a product from its base price, tax rate in percent and reduction share."""
    net = base.cast("decimal(18,4)")
    gross_factor = (F.lit(100).cast("decimal(7,3)") + F.coalesce(rate, F.lit(0.0)).cast("decimal(7,3)")) * F.expr("0.01BD")
    left = F.lit(1).cast("decimal(5,4)") - F.coalesce(reduction, F.lit(0.0)).cast("decimal(5,4)")
    special = net * left
    if group_reduction is not None:
        special = special * (F.lit(1).cast("decimal(5,4)") - F.coalesce(group_reduction, F.lit(0.0)).cast("decimal(5,4)"))
    if ecotax is not None:
        special = special + F.coalesce(ecotax, F.lit(0.0)).cast("decimal(18,4)")

    def cents(c: Column) -> Column:
        return F.round(c, 2).cast("double")

    return {
        "price": base.cast("double"),
        "original_price": base.cast("double"),
        "original_price_incl_tax": cents(net * gross_factor),
        "special_price": cents(special),
        "special_price_incl_tax": cents(special * gross_factor),
    }


def union_by_name(frames: Iterable):
    """All frames below one another, columns matched by name."""
    frames = list(frames)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out

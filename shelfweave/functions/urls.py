"""URL split, normalise and rejoin as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# scheme, user info, host (name or bracketed IPv6), port, path, query, fragment
_SHAPE = (
    r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?//(?:([^/?#@]*)@)?(\[[0-9A-Fa-f:.]+\]|[^/?#:@\[\]]*)(?::([0-9]*))?"
    r"([^?#]*)(\?[^#]*)?(#.*)?$"
)
_MARK = "\u0001"


def raw_decode(c: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone and malformed text unchanged."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def raw_encode(c: Column) -> Column:
    """Percent-encoding of everything but letters, digits and ``-_.~``."""
    form = F.url_encode(c)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        form = F.replace(form, F.lit(found), F.lit(wanted))
    return form


def normalize_urls(frame: DataFrame, column: str = "url") -> DataFrame:
    """URL parts and the rejoined URL; rows without a host are dropped.

    The scheme is lower-case and defaults to http, the port to 443 for https and 80 otherwise; every
    part is decoded and encoded again. The text is matched once per row.
    """
    marked = F.regexp_replace(column, _SHAPE, _MARK.join(f"${i}" for i in range(1, 8)))
    parts = frame.withColumn("_p", F.split(marked, _MARK)).filter(F.size("_p") == 7)

    def part(i: int) -> Column:
        return F.get("_p", F.lit(i))

    scheme = F.when(part(0) == "", F.lit("http")).otherwise(F.lower(part(0)))
    host = raw_decode(part(2))
    port = F.when(part(3) != "", part(3)).when(F.col("scheme") == "https", F.lit("443")).otherwise(F.lit("80"))
    path = F.replace(raw_encode(raw_decode(part(4))), F.lit("%2F"), F.lit("/"))
    query = raw_encode(raw_decode(F.substring(part(5), 2, 1 << 30)))
    fragment = raw_encode(raw_decode(F.substring(part(6), 2, 1 << 30)))
    user = F.array_join(F.transform(F.split(part(1), ":", 2), lambda u: raw_encode(raw_decode(u))), ":")
    named = parts.filter(part(2) != "").withColumn("scheme", scheme).withColumns({"host": host, "port": port, "path": path})
    joined = F.concat(
        F.col("scheme"), F.lit("://"), F.when(part(1) != "", F.concat(user, F.lit("@"))).otherwise(F.lit("")),
        F.when(F.col("host").startswith("["), F.col("host")).otherwise(raw_encode(F.col("host"))), F.lit(":"), F.col("port"), F.col("path"),
        F.when(part(5) != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(part(6) != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")),
    )
    return named.withColumn("normalized", joined).drop("_p")

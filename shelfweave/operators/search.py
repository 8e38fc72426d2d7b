"""Token tables, matching and suggestions as batch joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweave.functions import analyzers as A
from shelfweave.functions.scalars import fold_accents
from shelfweave.operators.relational import split_join, spread, top_per_group


def stemmed(docs: DataFrame, key: str, text: str, dictionary: DataFrame, stop_words: DataFrame, on: tuple[str, ...] = (), fold: bool = False) -> DataFrame:
    """(key, tokens): blank-separated lower-case tokens, stemmed through (form, stem), then without stop words.

    ``stop_words`` has ``token`` and the columns of ``on`` (for instance the language). Stop words are
    matched against stems, as the chain orders it; those that the dictionary does not stem leave before anything is shuffled. Tokens that are still
    very frequent are dealt out over many tasks in the dictionary join; one row per document is gathered from what is kept.
    """
    rows = docs.select(key, *on, F.posexplode(A.blank_tokens(F.lower(text))).alias("pos", "form"))
    plain = stop_words.join(dictionary.select(F.col("form").alias("token")), "token", "left_anti")
    rows = rows.filter(~_listed(rows, plain, on, "form"))
    stems = split_join(rows, dictionary, ["form"]).select(key, *on, "pos", F.coalesce("stem", "form").alias("token"))
    kept = without(stems, stop_words, on)
    token = fold_accents(F.col("token")) if fold else F.col("token")
    words = kept.select(key, "pos", token.alias("token")).repartition(key)
    lists = words.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("_t")).select(
        key, F.transform("_t", lambda t: t["token"]).alias("tokens")
    )
    return docs.select(key).join(lists, key, "left").withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))


#: Stop words are looked up by hash in so many places, so that a token meets few of them.
_PLACES = 1 << 14


def _listed(tokens: DataFrame, stop_words: DataFrame, on: tuple[str, ...], token: str) -> Column:
    """Whether a token is a stop word (of its language). The list is one value in every task, an array of the words by the place their hash gives them."""
    kinds = {name: tokens.schema[name].dataType for name in (*on, token)}
    words = stop_words.select(*[F.col(c).cast(kinds[c]) for c in on], F.col("token").cast(kinds[token])).dropna().distinct()
    place = lambda *keys: F.pmod(F.xxhash64(*keys), F.lit(_PLACES)).cast("int")
    placed = words.groupBy(place(*words.columns).alias("place")).agg(F.collect_list(F.struct(*words.columns)).alias("words"))
    table = placed.agg(F.map_from_entries(F.collect_list(F.struct("place", "words"))).alias("table")).select(
        F.transform(F.sequence(F.lit(0), F.lit(_PLACES - 1)), lambda i: F.try_element_at("table", i)).alias("table")).scalar()
    same = F.struct(*[F.col(c) for c in on], F.col(token).alias("token"))
    return F.coalesce(F.array_contains(F.get(table, place(*on, token)), same), F.lit(False))


def without(tokens: DataFrame, stop_words: DataFrame, on: tuple[str, ...] = ("lang",)) -> DataFrame:
    """Token rows that are no stop words (of their language); the rows stay where they are."""
    return tokens.filter(~_listed(tokens, stop_words, on, "token"))


def remove_stop_words(tokens: DataFrame, stop_words: DataFrame, on: tuple[str, ...] = ("lang", "token")) -> DataFrame:
    """Token rows that are no stop words of their language."""
    return without(tokens, stop_words, tuple(c for c in on if c != "token"))


def postings(docs: DataFrame, key: str, fields: Mapping[str, Column]) -> DataFrame:
    """(field, term, key, tf) of the given token-list columns."""
    lists = [F.struct(F.lit(name).alias("field"), tokens.alias("tokens")) for name, tokens in fields.items()]
    per_field = docs.select(key, F.explode(F.array(*lists)).alias("f")).select(key, "f.field", F.explode("f.tokens").alias("term"))
    return per_field.groupBy("field", "term", key).agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(posting: DataFrame) -> DataFrame:
    """(field, term, df)."""
    # Every posting has a frequency above 0; asking for it keeps the column, so that both uses of the postings share one shuffle.
    return posting.groupBy("field", "term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def term_postings(docs: DataFrame, key: str, fields: Mapping[str, Column]) -> DataFrame:
    """Postings with the document frequency of their term.

    Terms in more documents than an even share of a partition, which the frequencies themselves tell, are dealt out over many tasks.
    """
    posting = postings(docs, key, fields)
    frequency = document_frequency(posting)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = frequency.agg(F.sum("df").alias("n")).scalar()
    # Fewer terms than partitions have more than an even share.
    hot = frequency.filter(F.col("df") * parts > share).agg(F.collect_list(F.xxhash64("field", "term")).alias("hot")).scalar()
    return split_join(posting, frequency, ["field", "term"], "inner", hot)


def _hits(docs: DataFrame, key: str, fields: Mapping[str, Column], wanted: DataFrame, tasks: int | None = None) -> DataFrame:
    """(field, term, key, tf) of the terms that any query asks for; with ``tasks`` dealt over so many by ``key``."""
    asked = wanted.select("term").distinct()
    lists = [F.struct(F.lit(name).alias("field"), tokens.alias("tokens")) for name, tokens in fields.items()]
    exploded = docs.select(key, F.explode(F.array(*lists)).alias("f")).select(key, "f.field", F.explode("f.tokens").alias("term"))
    met = exploded.join(asked, "term", "left_semi")
    return (met.repartition(tasks, key) if tasks else met).groupBy("field", "term", key).agg(F.count(F.lit(1)).alias("tf"))


def _part(gain: Column, tf: Column) -> Column:
    # Fixed-point parts add up to the same sum in any order.
    return F.round(gain * tf, 6).cast("decimal(24,6)")


def _gains(docs: DataFrame, hits: DataFrame, weights: Mapping[str, float], k: int) -> DataFrame:
    """(field, term, df, gain, most, sure): the worth of one occurrence, of as many as any document has, and of as many as ``k`` documents have."""
    total = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    weight = F.create_map(*[F.lit(x) for name, w in weights.items() for x in (name, float(w))])
    counts = hits.groupBy("field", "term", "tf").agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(Window.partitionBy("field", "term").orderBy(F.desc("tf")))
    per_term = counts.withColumn("above", above).groupBy("field", "term").agg(
        F.sum("n").alias("df"), F.max("tf").alias("max_tf"), F.max(F.when(F.col("above") >= k, F.col("tf"))).alias("sure_tf")
    )
    gain = F.try_element_at(weight, F.col("field")) * F.log(1 + total / F.col("df"))
    return per_term.withColumn("gain", gain).select("field", "term", "df", "gain", _part(F.col("gain"), F.col("max_tf")).alias("most"), _part(F.col("gain"), F.col("sure_tf")).alias("sure"))


def match_plan(wanted: DataFrame, gains: DataFrame) -> DataFrame:
    """(id_query, field, term, gain, needed, bound, rest): which terms of a query lead to its best documents.

    ``bound`` is a score that k documents reach for sure, as one term alone gives it to them. Terms of a field, least worth first, whose worths
    together stay below it lead to nothing by themselves: documents are looked for by the others (``needed``) and the former only looked up.
    ``rest`` is what those can add at most.
    """
    terms = wanted.join(gains, "term")
    bounds = terms.groupBy("id_query").agg(F.coalesce(F.max("sure"), F.lit(0).cast("decimal(24,6)")).alias("bound"))
    up = Window.partitionBy("id_query", "field").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = terms.withColumn("_sum", F.sum("most").over(up)).join(bounds, "id_query").withColumn("needed", F.col("_sum") >= F.col("bound"))
    rest = F.coalesce(F.max(F.when(~F.col("needed"), F.col("_sum"))).over(Window.partitionBy("id_query", "field")), F.lit(0))
    return ranked.withColumn("rest", rest).select("id_query", "field", "term", "gain", "needed", "bound", "rest")


def candidates(plan: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """(id_query, key, field, part, bound): documents that hold a needed term and whose score may still reach the bound."""
    found = plan.filter("needed").join(hits, ["field", "term"]).groupBy("id_query", key, "field").agg(
        F.sum(_part(F.col("gain"), F.col("tf"))).alias("part"), F.first("rest").alias("rest"), F.first("bound").alias("bound")
    )
    return found.filter(F.col("part") + F.col("rest") >= F.col("bound")).drop("rest")


#: A task of the matching holds about so many documents, however well they compress in a shuffle.
TASK_DOCS = 100_000


def best_of_fields(plan: DataFrame, hits: DataFrame, key: str, k: int, hot: Column, tasks: int) -> DataFrame:
    """(id_query, key, score): the best ``k`` documents of each field of a query that reach the bound; ``hits`` must lie in tasks by ``key``.

    A document's hits in a field are one row, so what meets a needed term is scored where it is, with the terms that are only looked up. Of several needed terms
    that a document holds the first leads to it. A document with one of the best scores has it in some field, and is among the best of that field.
    """
    held = hits.groupBy(key, "field").agg(F.map_from_entries(F.collect_list(F.struct("term", "tf"))).alias("held"))  # at most the asked terms of one text
    terms = plan.groupBy("id_query", "field").agg(F.array_sort(F.collect_list(F.struct("term", "gain", "needed"))).alias("terms"))  # the terms of one query
    leads = plan.filter("needed").select("id_query", "field", "term", "bound").join(terms, ["id_query", "field"])
    met = split_join(held.select(key, "field", "held", F.explode(F.map_keys("held")).alias("term")), leads, ["field", "term"], "inner", hot, tasks, by=[key])
    there = F.filter("terms", lambda x: F.map_contains_key(F.col("held"), x["term"]))
    first = F.get(F.filter("there", lambda x: x["needed"]), 0)["term"]
    total = F.aggregate("there", F.lit(0).cast("decimal(34,6)"), lambda sum_, x: (sum_ + _part(x["gain"], F.try_element_at("held", x["term"]))).cast("decimal(34,6)"))
    scored = met.withColumn("there", there).filter(first == F.col("term")).withColumn("score", total).filter(F.col("score") >= F.col("bound"))
    return top_per_group(scored.select("id_query", key, "field", "score"), ["id_query", "field"], [F.col("score").desc(), F.col(key)], k).select("id_query", key, "score")


def multi_match(docs: DataFrame, key: str, fields: Mapping[str, Column], queries: DataFrame, weights: Mapping[str, float], k: int | None = None) -> DataFrame:
    """(id_query, key, score): any term may match, fields are weighted, the best field counts.

    Score of a field: sum over its matched query terms of weight * tf * ln(1 + N/df), where df counts the
    documents whose field has the term. ``queries`` has ``id_query, term``. Terms no query asks for
    leave before anything is counted, so the work follows the matches.

    With ``k`` documents that cannot be among a query's best ``k`` are not scored (``match_plan``): a score below one that ``k`` documents reach
    for sure is out, in every field. Ties are by key. Exact: what is left out scores less than the last of the best.
    """
    wanted = queries.select("id_query", "term").distinct()
    if k is None:
        hits = _hits(docs, key, fields, wanted)
        plan = wanted.join(_gains(docs, hits, weights, 1), "term").select("id_query", "field", "term", "gain")
        scored = plan.join(hits, ["field", "term"]).groupBy("id_query", key, "field").agg(F.sum(_part(F.col("gain"), F.col("tf"))).alias("part"))
        return scored.groupBy("id_query", key).agg(F.max("part").cast("double").alias("score"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(parts, -(-docs.count() // TASK_DOCS))
    hits = _hits(docs, key, fields, wanted, tasks)
    gains = _gains(docs, hits, weights, k)
    share = gains.agg(F.sum("df").alias("n")).scalar()
    # A few terms a little below an even share may meet in one task, so those from a quarter of it on are dealt: fewer than four times the tasks.
    hot = gains.filter(F.col("df") * tasks * 4 > share).agg(F.collect_list(F.xxhash64("field", "term")).alias("hot")).scalar()
    found = best_of_fields(match_plan(wanted, gains), hits, key, k, hot, tasks)
    best = found.groupBy("id_query", key).agg(F.max("score").cast("double").alias("score"))
    return top_per_group(best, ["id_query"], [F.col("score").desc(), F.col(key)], k)


def allowed_edits(term: Column) -> Column:
    """Edit distance a term may be off: 0 up to two characters, 1 up to five, else 2."""
    n = F.length(term)
    return F.when(n <= 2, F.lit(0)).when(n <= 5, F.lit(1)).otherwise(F.lit(2))


def _piece(length: str) -> tuple[str, str]:
    # Start (from 1) and size of piece ``i`` of a text of the given length cut into e+1 near-equal pieces.
    short, plain = f"({length}) DIV (e + 1)", f"(e + 1 - ({length}) % (e + 1))"
    start = f"CAST(i * ({short}) + greatest(0, i - {plain}) + 1 AS INT)"
    size = f"CAST({short} + IF(i >= {plain}, 1, 0) AS INT)"
    return start, size


#: Up to so many characters a query term is met by what is left after deletions; longer ones by pieces, which then are long enough to be rare.
SHORT = 6


def _cuts(term: str, times: int) -> str:
    """SQL for a term and all that up to ``times`` deletions of a character leave of it."""
    one = "transform(sequence(1, length({x})), i -> concat(substring({x}, 1, i - 1), substring({x}, i + 1)))"
    first = f"IF(length({term}) > 0, {one.format(x=term)}, array())"
    if times < 2:
        return f"array_distinct(concat(array({term}), {first}))"
    second = f"flatten(transform(filter({first}, x -> length(x) > 0), x -> {one.format(x='x')}))"
    return f"array_distinct(concat(array({term}), {first}, {second}))"


def fuzzy_terms(vocabulary: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_term, term, distance) within the edits the query term allows, exactly.

    Short query terms (``SHORT``): texts within e edits have a text in common that at most e deletions leave of each. Longer ones: a text
    within e edits keeps at least one of e+1 pieces of the vocabulary term unchanged, moved by at most e places; pieces are joined by value, position and
    length. Only pairs that meet are measured.
    """
    queries = queries.select(F.col("term").alias("query_term")).distinct().withColumns(
        {"n": F.length("query_term"), "edits": allowed_edits(F.col("query_term"))}
    )
    vocabulary = vocabulary.select("term").distinct().withColumn("n", F.length("term"))
    # One set of keys for one edit and one for two, as a text of five characters allows one and meets one of six that allows two.
    left = f"CASE edits WHEN 0 THEN array(query_term) WHEN 1 THEN {_cuts('query_term', 1)} ELSE {_cuts('query_term', 2)} END"
    short = queries.filter(F.col("n") <= SHORT).select("query_term", "edits", F.explode(F.expr(left)).alias("cut"))
    kept = (
        f"concat(IF(n <= 2, array(struct(0 AS edits, term AS cut)), array()), "
        f"IF(n BETWEEN 2 AND 6, transform({_cuts('term', 1)}, x -> struct(1 AS edits, x AS cut)), array()), "
        f"IF(n BETWEEN 4 AND {SHORT + 2}, transform({_cuts('term', 2)}, x -> struct(2 AS edits, x AS cut)), array()))"
    )
    cuts = vocabulary.filter(F.col("n") <= SHORT + 2).select("term", F.explode(F.expr(kept)).alias("k")).select("term", "k.edits", "k.cut")
    near = _measured(short.join(cuts, ["edits", "cut"]))
    start, size = _piece("n")
    stored = f"transform(sequence(0, 2), i -> struct(n AS len, i AS i, substring(term, {start}, {size}) AS piece))".replace("(e + 1", "(2 + 1")
    start, size = _piece("n + d")
    asked = (
        "flatten(transform(sequence(-2, 2), d -> flatten(transform(sequence(0, 2), i -> "
        f"transform(filter(sequence(-2, 2), s -> n + d >= 1 AND {start} + s >= 1 AND {start} + s + {size} <= n + 1), s -> "
        f"struct(n + d AS len, i AS i, substring(query_term, {start} + s, {size}) AS piece))))))"
    ).replace("(e + 1", "(2 + 1")
    stored_keys = vocabulary.filter(F.col("n") >= SHORT - 1).select("term", F.explode(F.expr(stored)).alias("k"))
    asked_keys = queries.filter(F.col("n") > SHORT).select("query_term", "edits", F.explode(F.expr(asked)).alias("k"))
    return near.union(_measured(asked_keys.join(stored_keys, "k")))


def _measured(met: DataFrame) -> DataFrame:
    """Pairs within their edits; measured where they meet, with the bounded form, so that only true matches reach the distinct step."""
    far = met.withColumn("distance", F.levenshtein("query_term", "term", 2))
    return far.filter((F.col("distance") >= 0) & (F.col("distance") <= F.col("edits"))).select("query_term", "term", "distance").distinct()


#: Entries are found by up to so many leading characters; what is typed beyond is compared where they meet.
LEADING = 8


def suggestions(entries: DataFrame, prefixes: DataFrame, k: int) -> DataFrame:
    """(prefix, rank, entry, weight): the ``k`` heaviest entries that start with each prefix, of any length.

    An entry is listed under its first characters up to ``LEADING``, for those lengths only that are asked; longer prefixes meet it there and are compared
    in full. Each task keeps k rows per prefix.
    """
    asked = prefixes.select("prefix").distinct().filter(F.length("prefix") > 0).withColumn("lead", F.substring("prefix", 1, LEADING))
    lengths = asked.agg(F.collect_set(F.length("lead")).alias("sizes")).scalar()
    starts = entries.withColumn("_size", F.explode(lengths)).filter(F.col("_size") <= F.length("entry")).select(
        "entry", "weight", F.substring(F.col("entry"), F.lit(1), F.col("_size")).alias("lead"))
    hits = starts.join(asked, "lead").filter(F.startswith("entry", "prefix")).select("entry", "weight", "prefix")
    return top_per_group(hits, ["prefix"], [F.col("weight").desc(), F.col("entry")], k)


def stop_word_sets(shops: DataFrame, languages: DataFrame, name: Column) -> DataFrame:
    """The stop-word set of each active language of each shop."""
    rows = spread(languages.filter(F.col("active")).select("id_lang", "iso_code"), shops.select("id_shop"))
    return rows.select("id_shop", "id_lang", name.alias("stop_words"))

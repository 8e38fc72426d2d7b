"""MinHash near-dedup: ProbMinHash over weighted word shingles, banding and exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .scratch import Scratch
from .text import counted, mix, parts, shingles, uniform, words

BANDS = 25
ROWS = 5
REGISTERS = BANDS * ROWS
THRESHOLD = 0.8
#: Pairs are verified unless the registers put them this far below the threshold: 3.5 standard errors.
MARGIN = 3.5 * (THRESHOLD * (1 - THRESHOLD) / REGISTERS) ** 0.5
BLOCK = 512


def probminhash(value: np.ndarray, weight: np.ndarray, row: np.ndarray, rows: int, m: int = REGISTERS) -> np.ndarray:
    """Signatures (rows x m) of weighted sets: equal registers of two rows have the probability Jaccard similarity as their chance.

    Every element is a Poisson process of its weight whose arrivals fall on registers at random; a register keeps the element that arrives
    first. An element stops once its clock passes the last of its row's registers. Arrivals are functions of the element alone, so
    equal sets have equal signatures. Rows without elements keep zeros.
    """
    clock = np.full(rows * m, np.inf)
    owner = np.zeros(rows * m, np.uint64)
    at, turn = np.zeros(len(value)), 0
    while len(value):
        noise = mix(value + np.uint64((turn * 0x9E3779B97F4A7C15 + 0x51ED270B) & ((1 << 64) - 1)))
        at = at - np.log(uniform(noise)) / weight
        slot = row * m + (mix(noise) % np.uint64(m)).astype(np.int64)
        early = np.flatnonzero(at < clock[slot])
        np.minimum.at(clock, slot[early], at[early])
        won = early[at[early] == clock[slot[early]]]
        owner[slot[won]] = value[won]
        stay = at < clock.reshape(rows, m).max(1)[row]
        value, weight, row, at, turn = value[stay], weight[stay], row[stay], at[stay], turn + 1
    return owner.reshape(rows, m)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted values, weights); Jaccard where all weights are equal."""
    (av, aw), (bv, bw) = a, b
    if not len(av) or not len(bv):
        return float(len(av) == len(bv))
    common, i, j = np.intersect1d(av, bv, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    w, v = aw[i].astype(np.float64), bw[j].astype(np.float64)
    rest_a, rest_b = aw.sum() - w.sum(), bw.sum() - v.sum()
    ratio = w / v
    order = np.argsort(ratio, kind="stable")
    ratio, w, v = ratio[order], w[order], v[order]
    below = np.searchsorted(ratio, ratio, "left")  # elements that weigh less in a, against b, than this one
    sum_v, sum_w = np.concatenate(([0.0], np.cumsum(v))), np.concatenate(([0.0], np.cumsum(w)))
    rest = rest_a + (sum_w[-1] - sum_w[below]) + ratio * (rest_b + sum_v[below])
    return float(np.sum(w / rest))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: digest of the text, one key for each band, and a byte of each register."""
    for b in batches:
        for lo, hi, data, at in parts(b["text"], 1 << 19):
            n = hi - lo
            value, row, _ = shingles(words(data, at))
            value, row, times = counted(value, row)
            sign = probminhash(value, times.astype(np.float64), row, n)
            full = np.bincount(row, minlength=n) > 0
            grown = np.zeros((n, BANDS), np.uint64)
            for r in range(ROWS):
                grown = mix(grown + sign[:, r::ROWS] * np.uint64(0xD1342543DE82EF95))
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(full * BANDS))), pa.int32()), pa.array(grown[full].ravel().view(np.int64)))
            short = (mix(sign) >> np.uint64(56)).astype(np.uint8)
            raw = data.tobytes()
            digest = [hashlib.blake2b(raw[at[i] : at[i + 1]], digest_size=16).digest() for i in range(n)]
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(lo, n), pa.array(digest, pa.binary()), keys, pa.array([x.tobytes() for x in short], pa.binary())],
                                             names=["doc_id", "digest", "bands", "registers"])


def _weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its distinct shingles in order, 32 bits each, and their weights, left out where all are 1."""
    for b in batches:
        for lo, hi, data, at in parts(b["text"], 1 << 19):
            value, row, _ = shingles(words(data, at))
            value, row, times = counted(value >> np.uint64(32), row)
            cut = np.searchsorted(row, np.arange(hi - lo + 1))
            value, times = value.astype("<u4"), times.astype("<u4")
            own = [slice(cut[i], cut[i + 1]) for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(lo, hi - lo), pa.array([value[x].tobytes() for x in own], pa.binary()),
                                              pa.array([times[x].tobytes() if (times[x] > 1).any() else b"" for x in own], pa.binary())], names=["doc_id", "value", "weight"])


def _set(value: bytes, weight: bytes) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(value, "<u4")
    return v, np.frombuffer(weight, "<u4") if weight else np.ones(len(v), np.uint32)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cells = zip(*(b[c].to_pylist() for c in ("value_u", "weight_u", "value_v", "weight_v")))
        sim = [likeness(_set(a, x), _set(c, y)) for a, x, c, y in cells]
        yield pa.RecordBatch.from_arrays([b["u"], b["v"], pa.array(sim, pa.float64())], names=["u", "v", "likeness"])


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact similarity of (u, v) pairs; a document in many pairs is an ordinary skewed key of a join of plain tables."""
    side = lambda s: sets.select(F.col("doc_id").alias(s), F.col("value").alias(f"value_{s}"), F.col("weight").alias(f"weight_{s}"))
    return pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v").mapInArrow(_verified, "u long, v long, likeness double")


def near_duplicates(docs: DataFrame, scratch: Scratch, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) of every document: classes are the components of links of similarity ``threshold`` or more.

    The similarity is the probability Jaccard of five-word shingles weighed by how often they occur; ``class_id`` is the smallest id of
    the class. Documents of equal texts are one document with many ids. Of the others those that share a band are candidates
    (a pair at 0.8 shares none of 25 bands of 5 registers with a chance of 0.00005). Candidates are compared first with the
    smallest id of each bucket; links found so join classes. Then, in the buckets that still hold several classes, pairs of different
    classes are compared in blocks, and what leaves a block are links that join classes. So a bucket's pairs are never listed.

    A null text counts as empty; empty texts are equal and form one class. Texts of fewer than five words have one shingle. Rows with a null
    id are left out; rows that repeat an id are one document, whose texts all count. Other columns are ignored.
    """
    plain = docs.filter("doc_id is not null").select("doc_id", "text")
    signed = scratch.table(plain.mapInArrow(_signatures, "doc_id long, digest binary, bands array<long>, registers binary"), "signed")
    # Equal texts: one row stands for all; the ids are linked to the smallest.
    first = scratch.table(signed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "first")
    copies = (signed.select("doc_id", "digest").join(first.filter("n > 1"), "digest").filter("doc_id <> first")
              .select(F.col("doc_id").alias("u"), F.col("first").alias("v")))
    single = signed.join(first.select(F.col("first").alias("doc_id"), "digest"), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
    single = scratch.table(single.select("doc_id", "bands", "registers"), "single")
    banded = single.select("doc_id", F.posexplode("bands").alias("band", "key")).select("doc_id", "band", "key")
    least = banded.groupBy("band", "key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "key", "least")
    shared = scratch.table(banded.join(scratch.table(least, "least"), ["band", "key"]), "shared")
    stars = scratch.table(shared.filter("doc_id <> least").select(F.col("doc_id").alias("u"), F.col("least").alias("v")).distinct(), "stars")
    members = scratch.table(stars.select(F.col("u").alias("doc_id")).union(stars.select("v")).distinct(), "members")
    sets = plain.join(members, "doc_id").mapInArrow(_weighted, "doc_id long, value binary, weight binary")
    sets = scratch.table(sets.groupBy("doc_id").agg(F.max_by(F.struct("value", "weight"), F.length("value")).alias("s")).select("doc_id", "s.value", "s.weight"), "sets")
    links = _verify(stars, sets).filter(F.col("likeness") >= threshold).select("u", "v").union(copies)
    found = scratch.table(components(links, scratch, "one"), "found")
    more = scratch.table(_across(shared, found, single, sets, scratch, threshold), "more")
    if more.limit(1).count():
        # Later links join whole classes, so only the classes are nodes of this second, much smaller graph.
        of = lambda s: found.select(F.col("node").alias(s), F.col("component").alias(f"class_{s}"))
        between = more.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("class_u", "u").alias("u"), F.coalesce("class_v", "v").alias("v"))
        wider = components(between, scratch, "two").select(F.col("node").alias("component"), F.col("component").alias("wider"))
        wider = scratch.table(wider, "wider")
        grown = found.join(wider, "component", "left").select("node", F.coalesce("wider", "component").alias("component"))
        alone = wider.join(found.select(F.col("component")).distinct(), "component", "left_anti").select(F.col("component").alias("node"), F.col("wider").alias("component"))
        found = scratch.table(grown.union(alone), "found-all")
    return (plain.select("doc_id").distinct().join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", F.coalesce("component", "doc_id").alias("class_id")))


def _across(shared: DataFrame, found: DataFrame, single: DataFrame, sets: DataFrame, scratch: Scratch, threshold: float) -> DataFrame:
    """Links between different classes in the buckets that hold several, at most one less than there are classes in a bucket.

    All pairs of a bucket that lie in different classes are looked at where they lie, and verified unless their registers rule them out, the pair
    met an earlier band, or links found in the bucket have joined their classes. A bucket of more than ``BLOCK`` rows is cut into blocks,
    and each pair of blocks is a group of its own.
    """
    classed = shared.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("band", "key", "doc_id", F.coalesce("component", "doc_id").alias("class"))
    classed = scratch.table(classed, "classed")
    mixed = classed.groupBy("band", "key").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.count(F.lit(1)).alias("n")).filter("a <> b")
    mixed = scratch.table(mixed.select("band", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "mixed")
    rows = classed.join(mixed, ["band", "key"]).join(single, "doc_id").join(sets, "doc_id").withColumn("earlier", F.slice("bands", F.lit(1), F.col("band")))
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    rows = (rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("band", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "doc_id", "class", "earlier", "registers", "value", "weight"))

    def links(key, frame):
        import pandas as pd

        frame = frame.sort_values("doc_id")
        ids, own = frame["doc_id"].to_numpy(), frame["own"].to_numpy()
        root = pd.factorize(frame["class"])[0]
        sign = np.stack([np.frombuffer(x, np.uint8) for x in frame["registers"]])
        earlier = np.stack(frame["earlier"].to_list()).reshape(len(ids), -1)
        held = [_set(v, w) for v, w in zip(frame["value"], frame["weight"])]
        out = []
        for i in range(len(ids)):
            j = i + 1 + np.flatnonzero((own[i + 1 :] != own[i]) if key[2] != key[3] else (own[i + 1 :] == own[i]))
            j = j[root[j] != root[i]]
            j = j[(sign[j] == sign[i]).mean(1) >= threshold - MARGIN]
            # The pair is verified in the first band whose key it shares; registers may agree by chance where the keys differ.
            for k in j[~(earlier[j] == earlier[i]).any(1)]:
                if root[k] != root[i] and likeness(held[i], held[k]) >= threshold:
                    out.append((ids[k], ids[i]))
                    root[root == root[k]] = root[i]
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return rows.groupBy("band", "key", "x", "y").applyInPandas(links, "u long, v long").distinct()


def keep_first(docs: DataFrame, scratch: Scratch, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those whose class has a smaller id; of rows that repeat an id one stays, rows with a null id all stay."""
    gone = scratch.table(near_duplicates(docs, scratch, threshold).filter("doc_id <> class_id").select("doc_id"), "gone")
    mark = "row_" + "_".join(docs.columns)  # a name that no column has
    kept = docs.join(gone, "doc_id", "left_anti").withColumn(mark, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return kept.dropDuplicates(["doc_id", mark]).select(*docs.columns)

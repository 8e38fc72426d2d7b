"""Embedding near-dedup: binary codes of randomly rotated vectors with stored correction factors, and exact recomputation where bounds ask for it."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .scratch import Scratch

COSINE = 0.9
RECALL = 0.97
CODE_BITS = 128
SURE = 3.0
BLOCK = 512


def lookup_plan(rows: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bits per band and number of bands: about four rows of unlike vectors a bucket at any size, and ``recall`` at the threshold itself."""
    bits = max(8, round(math.log2(max(rows, 1))) - 2)
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def rotations(dim: int, bits: int) -> np.ndarray:
    """``bits`` rows of random rotations of ``dim`` dimensions, one rotation after the other, the same everywhere."""
    random = np.random.default_rng(dim)
    turns = []
    for _ in range(-(-bits // dim)):
        q, r = np.linalg.qr(random.normal(size=(dim, dim)))
        turns.append(q * np.sign(np.diag(r)))
    return np.concatenate(turns)[:bits]


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row and vector of those that can link: no nulls, finite, not zero."""
    column = column.cast(pa.list_(pa.float64()))
    at, flat = column.offsets.to_numpy(), column.values
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0).to_numpy(zero_copy_only=False)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(valid):
        v = values[at[i] : at[i + 1]]
        if len(v) and not missing[at[i] : at[i + 1]].any() and np.isfinite(v).all() and v.any():
            yield i, v


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        digest = [None] * b.num_rows
        for i, v in _vectors(b["embedding"]):
            digest[i] = hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([b["vec_id"], b["embedding"], pa.array(digest, pa.binary())], names=["vec_id", "embedding", "digest"])


def _codes(bits: int, bands: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned: dict[int, np.ndarray] = {}
        for b in batches:
            rows = list(_vectors(b["embedding"]))
            code, factor, keys = [None] * b.num_rows, [0.0] * b.num_rows, [None] * b.num_rows
            for dim in sorted({len(v) for _, v in rows}):
                if dim not in turned:
                    turned[dim] = rotations(dim, max(bits * bands, CODE_BITS))
                own = [i for i, v in rows if len(v) == dim]
                unit = np.stack([v / np.abs(v).max() for _, v in rows if len(v) == dim])
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                image = unit @ turned[dim].T
                sign = image > 0
                short = image[:, :CODE_BITS] / np.linalg.norm(image[:, :CODE_BITS], axis=1, keepdims=True)
                right = np.abs(short).sum(1) / math.sqrt(CODE_BITS)
                band = (sign[:, : bits * bands].reshape(len(own), bands, bits) * (1 << np.arange(bits, dtype=np.int64))).sum(2)
                for k, i in enumerate(own):
                    code[i], factor[i], keys[i] = np.packbits(sign[k]).tobytes(), right[k], (band[k] * 65536 + dim).tolist()
            yield pa.RecordBatch.from_arrays([*(b[c] for c in ("vec_id", "copies", "embedding")), pa.array(code, pa.binary()), pa.array(factor), pa.array(keys, pa.list_(pa.int64()))],
                                             names=["vec_id", "copies", "embedding", "code", "factor", "keys"])

    return apply


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index each index is linked with."""
    root = np.arange(n)
    while len(i):
        least = np.minimum(root[i], root[j])
        if (root[i] == least).all() and (root[j] == least).all():
            break
        np.minimum.at(root, root[i], least)
        np.minimum.at(root, root[j], least)
        root = root[root]
    return root


def _compare(rows: dict[str, np.ndarray], bits: int, bands: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compares all rows of equal group: ids, links first met in this bucket (times copies), and the smallest id each is linked with.

    The inner product of a vector and another's code, over the stored factor, estimates their cosine without bias; its error has a bound of
    ``SURE`` standard deviations. Pairs whose upper bound reaches the threshold are recomputed exactly.
    """
    group, ids, vectors = rows["group"], rows["vec_id"], rows["vector"]
    n = len(ids)
    unit = vectors / np.abs(vectors).max(1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    image = (unit @ rotations(vectors.shape[1], CODE_BITS).T).astype(np.float32)
    image /= np.linalg.norm(image, axis=1, keepdims=True)
    all_bits = np.unpackbits(rows["code"], axis=1)
    sign = (all_bits[:, :CODE_BITS].astype(np.float32) * 2 - 1) / math.sqrt(CODE_BITS)
    keys = (all_bits[:, : bits * bands].reshape(n, bands, bits) * (1 << np.arange(bits, dtype=np.int64))).sum(2)
    factor = rows["factor"]
    bound = SURE * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(CODE_BITS - 1)
    links = np.zeros(n, np.int64)
    linked: list[tuple[np.ndarray, np.ndarray]] = []
    step, cross = 1, rows["x"] != rows["y"]
    while True:
        i = np.flatnonzero(group[step:] == group[:-step]) if step < n else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[~cross[i] | (rows["own"][i] != rows["own"][i + step])]
        j = i + step
        near = np.einsum("ij,ij->i", sign[i], image[j]) / factor[i] >= cosine - bound[i]
        i, j = i[near], j[near]
        exact = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
        i, j = i[exact], j[exact]
        if len(i):
            linked.append((i, j))
            first = (keys[i] == keys[j]).argmax(1) == rows["band"][i]
            np.add.at(links, i[first], rows["copies"][j[first]])
            np.add.at(links, j[first], rows["copies"][i[first]])
        step += 1
    i, j = (np.concatenate(x) for x in zip(*linked)) if linked else (np.zeros(0, np.int64),) * 2
    root = _roots(n, i, j)
    keep = np.flatnonzero((links > 0) | (root != np.arange(n)))
    return ids[keep], links[keep], ids[root[keep]]


def _linked(bits: int, bands: int, cosine: float):
    """Rows arrive sorted by group; a group that may go on in the next batch waits for it. A group has two blocks at most."""
    names = ["vec_id", "links", "other"]

    def compared(batch: pa.RecordBatch, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = batch["size"].to_numpy()
        for dim in np.unique(size):
            own = np.flatnonzero(size == dim)
            b = batch.take(pa.array(own))
            rows = {c: b[c].to_numpy(zero_copy_only=False) for c in ("vec_id", "copies", "factor", "band", "own", "x", "y")} | {"group": group[own]}
            rows["vector"] = b["embedding"].flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
            rows["code"] = np.frombuffer(b"".join(b["code"].to_pylist()), np.uint8).reshape(len(own), -1)
            ids, links, other = _compare(rows, bits, bands, cosine)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(other)], names=names)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            b = pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0] if rest is not None and rest.num_rows else b
            if not b.num_rows:
                continue
            key = np.stack([b[c].to_numpy() for c in ("band", "key", "x", "y")], 1)
            group = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]).any(1))))
            end = int(np.searchsorted(group, group[-1]))
            if end:
                yield from compared(b.slice(0, end), group[:end])
            rest = b.slice(end)
        if rest is not None and rest.num_rows:
            yield from compared(rest, np.zeros(rest.num_rows, np.int64))

    return apply


def near_vectors(table: DataFrame, scratch: Scratch, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector; links are pairs of cosine ``cosine`` or more in double precision.

    Equal vectors are compared once. Codes are the signs of randomly rotated vectors; bands of them name buckets, as many as find a pair at
    the threshold itself with a chance of ``recall`` and closer ones nearly always. Inside a bucket estimates and their bounds decide which
    pairs are recomputed; what leaves it is a count and the smallest link of each vector, not pairs. A pair counts in the first bucket it
    shares. Buckets of more than ``BLOCK`` rows are cut into blocks, each pair of blocks a group of its own.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do vectors of different lengths. A null id gets
    no links, a null component and is kept; rows that repeat an id are one vector with several values. An empty table gives no rows.
    """
    rows = scratch.table(table.select("vec_id", "embedding").mapInArrow(_digests, table.select("vec_id", "embedding").withColumn("digest", F.lit(None).cast("binary")).schema), "rows")
    usable = rows.filter("digest is not null and vec_id is not null")
    classes = usable.groupBy("digest").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
    classes = scratch.table(classes, "classes")
    bits, bands = lookup_plan(classes.count(), cosine, recall)
    coded = classes.select(F.col("first").alias("vec_id"), "copies", "embedding").mapInArrow(_codes(bits, bands), "vec_id long, copies long, embedding array<float>, code binary, factor double, keys array<long>")
    coded = scratch.table(coded, "coded")
    banded = coded.select("vec_id", F.posexplode("keys").alias("band", "key"))
    shared = scratch.table(banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    placed = banded.join(shared, ["band", "key"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("vec_id", "band", "key", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    grouped = placed.join(coded.drop("keys"), "vec_id").withColumn("size", F.size("embedding")).repartition("band", "key", "x", "y").sortWithinPartitions("band", "key", "x", "y")
    found = scratch.table(grouped.mapInArrow(_linked(bits, bands, cosine), "vec_id long, links long, other long"), "found")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    member = components(found.select(F.col("vec_id").alias("u"), F.col("other").alias("v")), scratch).withColumnRenamed("node", "first")
    summed = classes.select("digest", "first", "copies").join(links.withColumnRenamed("vec_id", "first"), "first", "left").join(member, "first", "left")
    summed = scratch.table(summed.select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "first").alias("c")), "summed")
    out = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest")).join(summed, "digest", "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

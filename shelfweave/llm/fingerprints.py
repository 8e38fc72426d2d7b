"""Document fingerprints: one-permutation MinHash, optimal densification and packed low-order bits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch
from .text import mix, parts, shingles, words

BINS = 256
BITS = 8
BLOCKS_PER_PARTITION = 4


def one_permutation(value: np.ndarray, row: np.ndarray, rows: int, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """Signatures (rows x bins) of hashed sets, and which rows have elements.

    Each hash is used once: its high part names a bin, the rest competes there for the minimum. An empty bin copies a bin drawn by a hash
    of its own number and the attempt, the same for all sets, until it meets one that was filled: optimal densification.
    """
    top = np.uint64(np.iinfo(np.uint64).max)
    sign = np.full(rows * bins, top, np.uint64)
    np.minimum.at(sign, row * bins + (value >> np.uint64(32)).astype(np.int64) % bins, value & np.uint64(0xFFFFFFFF))
    sign = sign.reshape(rows, bins)
    full = sign != top
    some = full.any(1)
    out, turn = sign.copy(), 0
    r, c = np.nonzero(~full & some[:, None])
    while len(r):
        turn += 1
        donor = (mix(c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn * 0x632BE5AB)) % np.uint64(bins)).astype(np.int64)
        there = full[r, donor]
        out[r[there], c[there]] = sign[r[there], donor[there]]
        r, c = r[~there], c[~there]
    out[~some] = 0
    return out, some


def packed_bits(sign: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low ``bits`` of the mixed minima, packed into bytes."""
    low = (mix(sign) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    return np.packbits(np.unpackbits(low[..., None], axis=-1)[..., 8 - bits :].reshape(len(sign), -1), axis=1)


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity from packed fingerprints: the share of equal groups of bits, less what chance makes equal."""
    lanes = lambda x: np.packbits(np.unpackbits(x, axis=1).reshape(len(x), -1, bits), axis=2)[..., 0]
    equal = (lanes(a) == lanes(b)).mean(1) if len(a) else np.zeros(0)
    chance = 2.0**-bits
    return np.where(some_a & some_b, np.clip((equal - chance) / (1 - chance), 0, 1), (some_a == some_b).astype(float))


def _prints(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    out, has = [], []
    for lo, hi, data, at in parts(pa.array(texts, pa.large_string()), 1 << 19):
        value, row, _ = shingles(words(data, at))
        sign, some = one_permutation(value, row, hi - lo)
        out.append(packed_bits(sign))
        has.append(some)
    width = BINS * BITS // 8
    return (np.concatenate(out), np.concatenate(has)) if out else (np.zeros((0, width), np.uint8), np.zeros(0, bool))


def _edited(text: str, after: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + after[:cut]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by (block, doc_id): each is held until the next of its block is there, whose text and fingerprint it needs."""
    held, names = None, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for b in batches:
        size = 256
        for lo in range(0, b.num_rows, size):
            some = b.slice(lo, size)
            ids, blocks, guests = (some[c].to_pylist() for c in ("doc_id", "block", "guest"))
            texts = [t or "" for t in some["text"].to_pylist()]
            prints, has = _prints(texts)
            if held is not None:
                ids, blocks, guests, texts = [held[0], *ids], [held[1], *blocks], [held[2], *guests], [held[3], *texts]
                prints, has = np.concatenate((held[4][None], prints)), np.concatenate((held[5][None], has))
            held = (ids[-1], blocks[-1], guests[-1], texts[-1], prints[-1], has[-1])
            # Block ends are guests: copies of the first row of the next block, which need no row of their own here.
            own = [i for i in range(len(ids) - 1) if not guests[i]]
            assert all(blocks[i] == blocks[i + 1] for i in own)
            edited = [_edited(texts[i], texts[i + 1]) for i in own]
            other, other_has = _prints(edited)
            at = np.asarray(own, np.int64)
            near = likeness(prints[at], other, has[at], other_has)
            after = likeness(prints[at], prints[at + 1], has[at], has[at + 1])
            mark = lambda p, h: [x.tobytes().hex() if y else "" for x, y in zip(p, h)]
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()), pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                pa.array(mark(prints[at], has[at]), pa.string()), pa.array(mark(other, other_has), pa.string()), pa.array(near), pa.array(after)], names=names)


def _bounds(docs: DataFrame, blocks: int) -> list[int]:
    """Ids that cut the rows into about equal blocks, at most ``blocks`` - 1."""
    cuts = F.percentile_approx("doc_id", F.array(*[F.lit(i / blocks) for i in range(1, blocks)]), F.lit(100 * blocks))
    return sorted(set(docs.agg(cuts).first()[0] or []))


def fingerprints(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, and how alike they, and its and the next document's, are.

    The next document is that of the next larger id, for the last the first; the edited text replaces the last quarter of the code points by as
    many of the next document's first. Ids are cut into a few blocks per shuffle partition, whose bounds come from the ids alone; the texts
    move once and stream through their blocks in order, and the first row of each block goes to the end of the block before as well.

    Fingerprints are 256 bins of 8 bits in hex, of five-word shingles; a text without words has the empty fingerprint, which is like
    another empty one (1.0) and no other (0.0). Null texts are empty. Null ids come first, as the smallest; rows that repeat an id follow
    each other in the order of their hashed texts. An only row is its own next one. An empty table gives no rows.
    """
    number = BLOCKS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, number)
    limits = F.array(*map(F.lit, bounds)).cast("array<bigint>")
    block = F.coalesce(F.size(F.filter(limits, lambda x: x <= F.col("doc_id"))), F.lit(0))
    own = docs.select("doc_id", "text", F.when(F.col("doc_id").isNull(), 0).otherwise(block).alias("block"), F.lit(False).alias("guest"))
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id"))
    heads = own.groupBy("block").agg(first.alias("first")).orderBy("block").collect()  # a row for each block
    ends = [(h["first"]["doc_id"], h["block"], heads[i - 1]["block"]) for i, h in enumerate(heads)]
    ends = docs.sparkSession.createDataFrame(ends, "next_id long, next_block int, block int")
    guests = (docs.select("doc_id", "text").join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("next_id"))).groupBy("next_block", "block")
              .agg(F.min_by(F.struct("doc_id", "text"), F.struct(F.xxhash64("text"), "text")).alias("r")).select("r.doc_id", "r.text", "block", F.lit(True).alias("guest")))
    rows = own.unionByName(guests).repartition(number // BLOCKS_PER_PARTITION, "block")
    rows = rows.sortWithinPartitions("block", "guest", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    return rows.mapInArrow(_rows, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

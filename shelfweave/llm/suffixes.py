"""Suffix dedup: which bytes lie in a long string that also starts elsewhere.

The method asked for is a difference-cover suffix array: sort the sampled suffixes, name them, merge the rest, compare neighbours. On
bytes it moves all suffixes of the corpus several times, far over a disk budget of a few times the input. Here the sample is
content-defined instead of modular (equal strings are sampled at equal places), so a sampled suffix that meets no equal one settles its
neighbourhood; sampled prefixes are named by digests of a length that leaves nothing to recurse on; and only suffixes next to the edges of
repeats are merged one by one. README.md says so too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .passages import _sliding, seeds
from .scratch import Scratch
from .text import mix, parts, powers

LENGTH = 400
STARTS = 101
RUN_BYTES = 1 << 19
_CODES = [mix(np.arange(256, dtype=np.uint64) + np.uint64(1000 * salt + 1)) for salt in range(3)]


def _hashes(data: np.ndarray, at: np.ndarray, length: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``length`` bytes from each byte on, and which of them lie inside one row; each ``salt`` gives a hash of its own."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[salt][data] * up[:-1], out=total[1:])
    value = mix((total[length:] - total[:-length]) * down[:n])
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    return value, row[:n] == row[length - 1 :]


def _sampled(data: np.ndarray, length: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled places of one text and the hashes of their ``length - starts + 1`` bytes."""
    gram = length - starts + 1
    value, _ = _hashes(data, np.array([0, len(data)]), gram)
    place = seeds(value, np.zeros(len(value), np.int64), starts)
    return place, value


def _row_ids(ids: list, data: bytes, at: np.ndarray) -> list[int]:
    """A number for each (id, text)."""
    return [int.from_bytes(hashlib.blake2b(data[at[i] : at[i + 1]], digest_size=8, salt=hashlib.blake2b(repr(d).encode(), digest_size=8).digest()).digest(), "little", signed=True)
            for i, d in enumerate(ids)]


def _sample_rows(length: int, starts: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, at in parts(b["text"], RUN_BYTES):
                raw, ids = data.tobytes(), b["doc_id"].slice(lo, hi - lo)
                value, inside = _hashes(data, at, length - starts + 1)
                # Hashes that reach over a row's end form rows of their own, which no window of starts fits into.
                row = np.repeat(np.arange(hi - lo), np.diff(at))[: len(value)] * 2 + ~inside
                place = seeds(value, row, starts)
                place = place[inside[place]]
                own = np.searchsorted(at, place, "right") - 1
                cut = pa.array(np.searchsorted(own, np.arange(hi - lo + 1)), pa.int32())
                sha = [hashlib.sha256(raw[at[i] : at[i + 1]]).hexdigest() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(_row_ids(ids.to_pylist(), raw, at), pa.int64()), pa.array(np.diff(at)), pa.array(sha, pa.string()),
                    pa.ListArray.from_arrays(cut, pa.array(value[place].view(np.int64)))], names=["doc_id", "uid", "n_bytes", "sha256", "grams"])

    return apply


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, at in parts(b["text"], RUN_BYTES):
            uid = _row_ids(b["doc_id"].slice(lo, hi - lo).to_pylist(), data.tobytes(), at)
            yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), b["text"].slice(lo, hi - lo)], names=["uid", "text"])


def _texts(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, bytes]]:
    for i, text in enumerate(b["text"].to_pylist()):
        raw = (text or "").encode()
        yield i, np.frombuffer(raw, np.uint8), raw


def _named(length: int, starts: int):
    """Names of the prefixes at a text's begin and its sampled places: digests of so many bytes that all windows they reach are in them."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid, at, name, number = [], [], [], b["uid"].to_pylist()
            for i, data, raw in _texts(b):
                place, _ = _sampled(data, length, starts)
                for p in np.unique(np.append(place, 0)).tolist():
                    if p + length <= len(raw):
                        uid.append(number[i])
                        at.append(p)
                        name.append(hashlib.blake2b(raw[p : p + length + starts - 1], digest_size=12).digest())
            yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(at, pa.int32()), pa.array(name, pa.binary())], names=["uid", "place", "name"])

    return apply


def _windows(data: np.ndarray, length: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the smallest sampled start of each window of ``length`` bytes; the first of equal ones."""
    _, value = _sampled(data, length, starts)
    if len(value) < starts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least = _sliding(value, starts, np.minimum)
    # The next place of each value that equals the window's minimum: places are visited from the right.
    place = seeds(value, np.zeros(len(value), np.int64), starts)
    at = np.searchsorted(place, np.arange(len(least)))
    while True:
        wrong = np.flatnonzero(value[place[at]] != least)
        if not len(wrong):
            return least, place[at]
        at[wrong] += 1


def _settled(certain: list[int] | None, windows: int, starts: int) -> np.ndarray:
    """Which windows begin at a place whose name occurs again, or soon after one."""
    out = np.zeros(windows + 1, np.int64)
    for p in certain or ():
        out[p] += 1
        out[min(p + starts, windows)] -= 1
    return np.cumsum(out)[:windows] > 0


def _open(b: pa.RecordBatch, length: int, starts: int) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per text, for each window: its smallest sampled start's hash and distance, whether equal names settle it, and whether no start rules it out."""
    repeated, certain = b["grams"].to_pylist(), b["certain"].to_pylist()
    for i, data, raw in _texts(b):
        least, place = _windows(data, length, starts)
        settled = _settled(certain[i], len(least), starts)
        known = np.isin(least, np.asarray(repeated[i] or [], np.int64).view(np.uint64))
        yield i, raw, least, place - np.arange(len(least)), settled, known


def _doubtful(length: int, starts: int):
    """Sampled starts of windows that are not settled, with the distances that matter."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gram, low, high = [], [], []
            for _, _, least, far, settled, known in _open(b, length, starts):
                doubt = known & ~settled
                value, back = np.unique(least[doubt], return_inverse=True)
                a, z = np.full(len(value), starts), np.zeros(len(value), np.int64)
                np.minimum.at(a, back, far[doubt])
                np.maximum.at(z, back, far[doubt])
                gram.append(value.view(np.int64))
                low.append(a)
                high.append(z)
            join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(join(gram), pa.int64()), pa.array(join(low), pa.int32()), pa.array(join(high), pa.int32())], names=["gram", "low", "high"])

    return apply


def _merged(length: int, starts: int):
    """The windows that have to be compared one by one: those at a distance in question from a start in question.

    Doubtful ones come with their place; of settled ones only the names matter, each once a run of rows.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number, asked = b["uid"].to_pylist(), b["asked"].to_pylist()
            uid, at, names, sure = [], [], [], []
            for i, raw, least, far, settled, known in _open(b, length, starts):
                if not asked[i]:
                    continue
                gram = np.array([x["gram"] for x in asked[i]], np.int64).view(np.uint64)
                order = np.argsort(gram)
                gram, low, high = gram[order], np.array([x["low"] for x in asked[i]])[order], np.array([x["high"] for x in asked[i]])[order]
                k = np.minimum(np.searchsorted(gram, least), len(gram) - 1)
                p = np.flatnonzero(known & (gram[k] == least) & (far >= low[k]) & (far <= high[k]))
                data = np.frombuffer(raw, np.uint8)
                name = np.stack([_hashes(data, np.array([0, len(data)]), length, salt)[0][p] for salt in (1, 2)], 1).view(np.int64)
                doubt = ~settled[p]
                uid.append(np.full(doubt.sum(), number[i]))
                at.append(p[doubt])
                names.append(name[doubt])
                sure.append(name[~doubt])
            sure = np.unique(np.concatenate(sure), axis=0) if sure else np.zeros((0, 2), np.int64)
            names = np.concatenate([*names, sure])
            join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            none = pa.nulls(len(sure), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.chunked_array([pa.array(join(uid), pa.int64()), none]).combine_chunks(), pa.chunked_array([pa.array(join(at), pa.int64()), none]).combine_chunks(),
                                              pa.array(names[:, 0]), pa.array((names[:, 1] >> 32).astype(np.int32))], names=["uid", "place", "one", "two"])

    return apply


def _covered(length: int, starts: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number, certain, more = (b[c].to_pylist() for c in ("uid", "certain", "more"))
            removed, spans, sha = [], [], []
            for i, _, raw in _texts(b):
                begins = np.zeros(len(raw) + 1, np.int64)
                p = np.flatnonzero(_settled(certain[i], max(len(raw) - length + 1, 0), starts))
                if more[i]:
                    p = np.union1d(p, np.asarray(more[i], np.int64))
                begins[p] += 1
                begins[p + length] -= 1
                gone = np.cumsum(begins)[:-1] > 0
                removed.append(int(gone.sum()))
                spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                sha.append(hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())], names=["uid", "removed", "spans", "left"])

    return apply


def _repeated(rows: DataFrame) -> DataFrame:
    """(uid, place) of the rows whose name occurs more than once."""
    twice = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name")
    return rows.join(twice, "name").select("uid", "place")


def repeated_bytes(docs: DataFrame, scratch: Scratch, length: int = LENGTH, starts: int = STARTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document: bytes inside a ``length``-byte string that also starts elsewhere.

    Strings are bytes of whole texts, never over a text's end; the other start may be in the same document and overlap. Every window of
    ``length`` bytes has a sampled start among its first ``starts`` bytes, found from its content alone. (1) A start whose next
    ``length - starts + 1`` bytes occur once rules its windows out. (2) The others' prefixes are named by digests of all windows that begin up to the
    next ``starts`` bytes; equal names settle those. (3) What is left, at edges of repeats, is compared window by window, with all
    windows that have the same start at the same distance. Digests have 96 bits.

    A null text is empty; empty and short texts lose nothing unless a row repeats both id and text: such rows repeat each other's
    strings. Null ids are ids like others. An empty table gives no rows. Other columns are ignored.
    """
    plain = docs.select("doc_id", "text")
    signed = scratch.table(plain.mapInArrow(_sample_rows(length, starts), "doc_id long, uid long, n_bytes long, sha256 string, grams array<long>"), "signed")
    rows = scratch.table(signed.drop("grams"), "rows")
    placed = signed.select("uid", F.explode("grams").alias("gram"))
    twice = scratch.table(placed.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "twice")
    grams = scratch.table(placed.join(twice, "gram").select("uid", "gram").distinct(), "grams")
    scratch.drop("signed")
    own = grams.groupBy("uid").agg(F.collect_list("gram").alias("grams"))  # at most one text's
    held = scratch.table(plain.mapInArrow(_keyed, "uid long, text string").join(own, "uid").dropDuplicates(["uid"]), "held")
    # Rows that agree in id and text count as often as they are there.
    copies = scratch.table(rows.groupBy("uid").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "copies")
    weigh = lambda t: t.union(t.join(copies.select("uid"), "uid").select(*t.columns))
    names = held.mapInArrow(_named(length, starts), "uid long, place int, name binary")
    certain = _repeated(weigh(names)).distinct().groupBy("uid").agg(F.collect_list("place").alias("certain"))
    held = scratch.table(held.join(certain, "uid", "left"), "settled")
    scratch.drop("held")
    asked = held.mapInArrow(_doubtful(length, starts), "gram long, low int, high int").groupBy("gram").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    asked = scratch.table(asked, "asked")
    asked = grams.join(asked, "gram").groupBy("uid").agg(F.collect_list(F.struct("gram", "low", "high")).alias("asked"))
    merged = held.join(asked, "uid").mapInArrow(_merged(length, starts), "uid long, place long, one long, two int")
    merged = scratch.table(merged, "merged")
    scratch.drop("grams")
    scratch.drop("asked")
    equal = merged.groupBy("one", "two").agg(F.count("uid").alias("doubtful"), F.max(F.col("uid").isNull()).alias("sure")).filter("doubtful > 0 and (doubtful > 1 or sure)")
    more = merged.filter("uid is not null").join(equal.select("one", "two"), ["one", "two"]).groupBy("uid").agg(F.collect_list("place").alias("more"))
    cut = held.join(more, "uid", "left").mapInArrow(_covered(length, starts), "uid long, removed long, spans long, left string")
    out = rows.join(cut, "uid", "left")
    return out.select("doc_id", "n_bytes", F.coalesce("removed", F.lit(0)).alias("n_removed"), F.coalesce("spans", F.lit(0)).alias("n_spans"), F.coalesce("left", "sha256").alias("kept_sha256"))

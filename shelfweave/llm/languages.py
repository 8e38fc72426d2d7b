"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .quality import held_out
from .scratch import Scratch
from .text import mix

BUCKETS = 1 << 15
LENGTHS = (2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
RUN_CHARS = 1 << 19
MOST_LANGUAGES = 256


def _runs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first, end, code points in lower case with a blank before and after each text, row offsets)."""
    texts = pc.utf8_lower(pc.fill_null(column, "").cast(pa.large_string()))
    sizes = np.cumsum(pc.utf8_length(texts).to_numpy())
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + RUN_CHARS, "right")))
        some = [f" {t} " for t in texts.slice(lo, hi - lo).to_pylist()]
        points = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
        yield lo, hi, points, np.concatenate(([0], np.cumsum([len(t) for t in some])))
        lo = hi


def _grams(points: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the bucket of every n-gram of letters and blanks inside a row, and where each row begins in them.

    Whatever is no letter counts as a blank; n-grams that begin with two blanks say nothing and go to bucket 0.
    """
    wide = np.where(_letters(points), points, np.uint32(32)).astype(np.uint64)
    last = np.zeros(len(points) + 1, bool)
    for n in LENGTHS:
        value = np.zeros(max(len(wide) - n + 1, 0), np.uint64)
        for j in range(n):
            value = value * np.uint64(0x110000) + wide[j : len(wide) - n + 1 + j]
        bucket = (mix(value) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
        bucket[(wide[: len(value)] == 32) & (wide[1 : len(value) + 1] == 32)] = 0
        # n-grams that begin in a row's last places reach into the next row: bucket 0.
        last[:] = False
        for j in range(1, n):
            last[np.maximum(at[1:] - j, 0)] = True
        bucket[last[: len(bucket)]] = 0
        yield bucket, np.minimum(at, len(bucket))


def _letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters: ASCII by range, others by the character database, once for each distinct one."""
    out = ((points | 32) >= 97) & ((points | 32) <= 122)
    high = np.flatnonzero(points >= 128)
    distinct, place = np.unique(points[high], return_inverse=True)
    out[high] = np.array([chr(c).isalpha() for c in distinct.tolist()], bool)[place] if len(high) else False
    return out


def _counting(langs: list[str]):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), BUCKETS), np.int64)
        for b in batches:
            kind = pc.index_in(b["lang"], pa.array(langs)).to_numpy()
            for lo, hi, points, at in _runs(b["text"]):
                for bucket, begin in _grams(points, at):
                    row = np.repeat(kind[lo:hi], np.diff(begin))
                    total += np.bincount(row * BUCKETS + bucket[: len(row)], minlength=total.size).reshape(total.shape)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[lang, bucket])], names=["kind", "bucket", "n"])

    return apply


def train(docs: DataFrame, scratch: Scratch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log prior and log probability of each bucket by language, from all documents with a language.

    Every task reduces its rows to one number per language and bucket; the driver gets these sums, at most languages x buckets.
    """
    known = docs.filter("lang is not null and text is not null").select("text", F.col("lang").cast("string").alias("lang"))
    number = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(number) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    langs = [r["lang"] for r in number]
    counts = np.zeros((len(langs), BUCKETS))
    if langs:
        sums = known.mapInArrow(_counting(langs), "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
        counts[sums["kind"], sums["bucket"]] = sums["n"]
    counts[:, 0] = 0
    log = np.log(counts + SMOOTHING) - np.log((counts + SMOOTHING).sum(1, keepdims=True)) if langs else counts
    log[:, :1] = 0.0
    prior = np.log(np.array([r["n"] for r in number], float) / max(1, sum(r["n"] for r in number))) if langs else np.zeros(0)
    return langs, prior, log.astype(np.float32)


def languages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, held_out, lang_pred and score (the posterior probability of the prediction) of every whole text.

    Learned from the n-grams of all documents with a language whose crc32 of the id does not leave 2 modulo 4; a prediction reads the text
    alone. A null text, one without letters, and every text where nothing was learned, are ``und`` with score 0. Rows with null or
    repeated ids are predicted like others (a null id is not held out); an empty table gives no rows. Other columns are ignored.
    """
    langs, prior, log = train(docs.filter(~held_out("doc_id", 4, 2)), scratch)
    # languages x buckets numbers, at most 256 x 32,768
    model = docs.sparkSession.sparkContext.broadcast((langs, prior, log))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prior, log = model.value
        for b in batches:
            pred, score = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
            for lo, hi, points, at in _runs(b["text"]):
                total = np.repeat(prior[None, :], hi - lo, 0)
                for bucket, begin in _grams(points, at):
                    padded = np.append(bucket, 0)
                    for k in range(len(langs)):
                        total[:, k] += np.add.reduceat(log[k][padded], begin[:-1], dtype=np.float64)
                letters = np.add.reduceat(np.append(_letters(points), False).astype(np.int64), at[:-1]) > 0
                for i in np.flatnonzero(letters) if langs else ():
                    odds = np.exp(total[i] - total[i].max())
                    k = int(odds.argmax())
                    pred[lo + i], score[lo + i] = langs[k], odds[k] / odds.sum()
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(pred), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    wide = docs.select("doc_id", "text", held_out("doc_id", 4, 2).alias("held_out"))
    return wide.select("doc_id", "held_out", "text").mapInArrow(apply, wide.select("doc_id", "held_out").withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema)

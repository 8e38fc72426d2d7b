"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch
from .text import Words, counted, mix, parts, words

BUCKETS = 4096
RANK = 8
TRAIN_ROWS = 20_000
SHARDS = 4
ROUNDS = 3
EPOCHS = 6
BATCH = 128
STATS = 16


def held_out(doc_id: str, folds: int, fold: int):
    """Whether crc32 of the id as text leaves the remainder ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _stats(data: np.ndarray, at: np.ndarray, w: Words, n_chars: np.ndarray) -> np.ndarray:
    """Structure of each row: shares of kinds of characters and of repeated words, lengths. All lie between about -1 and 3."""
    n = len(at) - 1
    size = np.maximum(np.diff(at), 1).astype(np.float64)
    number = np.diff(w.first)
    many = np.maximum(number, 1).astype(np.float64)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return (total[at[1:]] - total[at[:-1]]) / size

    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit, high = (data >= 48) & (data <= 57), data >= 128
    white = (data == 32) | ((data >= 9) & (data <= 13))
    letter = upper | lower | high
    value, doc, times = counted(w.hash, w.doc)
    distinct = np.bincount(doc, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, doc, times)
    same = np.zeros(len(w.hash), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    last = data[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    odd = ~((last >= 97) & (last <= 122) | (last >= 65) & (last <= 90) | (last >= 128) | (last == 44) | (last == 46))
    alone = (w.end - w.start == 1) & odd if len(w.end) else odd
    at_word = lambda mask: np.bincount(w.doc, mask, minlength=n) / many
    return np.stack([
        np.log1p(number) / 5, np.log1p(n_chars) / 5, share(upper) * 3, share(digit) * 5, share(white) * 3, share(data == 10) * 20, share(high) * 3,
        share(~letter & ~digit & ~white) * 5, distinct / many, most / many, at_word(same), at_word(odd), at_word(alone),
        at_word(w.end - w.start) / 8, share(data == 124) * 20, (number == 0).astype(np.float64),
    ], axis=1)


def _features(column: pa.Array, n_chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows as (first, end, row, word bucket, value, statistics); the word values of a row have length 1 as a vector."""
    for lo, hi, data, at in parts(column):
        w = words(data, at)
        bucket, row, times = counted(w.hash % np.uint64(BUCKETS), w.doc)
        length = np.sqrt(np.bincount(row, times.astype(np.float64) ** 2, minlength=hi - lo))
        yield lo, hi, row, bucket.astype(np.int64), times / np.maximum(length, 1e-9)[row], _stats(data, at, w, n_chars[lo:hi])


def score_parts(model: dict, rows: int, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """Scores in time linear in the features: the pairwise part is half of (sum of v x) squared less the sum of (v x) squared."""
    stats = (stats - model["mean"]) / model["spread"]
    w, v = model["w"], model["v"]
    margin = model["b"] + np.bincount(row, w[bucket] * value, minlength=rows) + stats @ w[BUCKETS:]
    for f in range(v.shape[1]):
        term = v[bucket, f] * value
        one = np.bincount(row, term, minlength=rows) + stats @ v[BUCKETS:, f]
        two = np.bincount(row, term * term, minlength=rows) + (stats * stats) @ (v[BUCKETS:, f] ** 2)
        margin += 0.5 * (one * one - two)
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40)))


class Sample(NamedTuple):
    """Rows of a shard by what is not zero in them; their wide form is made for a few rows at a time."""

    first: np.ndarray  # first value of each row, and the number of values
    bucket: np.ndarray
    value: np.ndarray
    stats: np.ndarray

    def wide(self, rows: np.ndarray) -> np.ndarray:
        """The features of ``rows`` with all their zeros."""
        each = np.diff(self.first)[rows]
        place = np.repeat(self.first[rows] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        x = np.zeros((len(rows), BUCKETS + STATS), np.float32)
        x[np.repeat(np.arange(len(rows)), each), self.bucket[place]] = self.value[place]
        x[:, BUCKETS:] = self.stats[rows]
        return x


def _fit_shard(rows: Sample, sequence: np.ndarray, y: np.ndarray, model: dict, seed: int, rate: float) -> dict:
    """Adam over one shard's rows, taken in the order ``sequence``, in batches, from ``model``."""
    w, v, b = model["w"].copy(), model["v"].copy(), model["b"]
    first = [np.zeros_like(w), np.zeros_like(v), 0.0]
    second = [np.zeros_like(w), np.zeros_like(v), 0.0]
    order, turn = np.random.default_rng(seed), 0
    for _ in range(EPOCHS):
        shuffled = order.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            take = shuffled[lo : lo + BATCH]
            a = rows.wide(sequence[take])
            a2 = a**2
            one = a @ v
            margin = b + a @ w + 0.5 * (one * one - a2 @ (v * v)).sum(1)
            off = (1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40))) - y[take]) / len(take)
            grads = (a.T @ off + 1e-5 * w, a.T @ (off[:, None] * one) - v * (a2.T @ off)[:, None] + 1e-5 * v, off.sum())
            turn += 1
            steps = []
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                steps.append(rate * (first[i] / (1 - 0.9**turn)) / (np.sqrt(second[i] / (1 - 0.999**turn)) + 1e-8))
            w, v, b = w - steps[0], v - steps[1], b - steps[2]
    return {"w": w, "v": v, "b": float(b)}


def _shard_fit(model: dict, turn: int):
    def fit(key, frame):
        stats = ((np.stack(frame["stats"].to_numpy()) - model["mean"]) / model["spread"]).astype(np.float32)
        first = np.append(0, np.cumsum([len(x) for x in frame["bucket"]]))
        rows = Sample(first, np.concatenate(frame["bucket"].to_numpy()).astype(np.int64), np.concatenate(frame["value"].to_numpy()), stats)
        y = frame["y"].to_numpy()
        order = np.lexsort((stats[:, 0], stats[:, 1], y))
        got = _fit_shard(rows, order, y[order], model, 100 * turn + int(key[0]), 0.02 / (1 + turn))
        return pd.DataFrame({"n": [len(frame)], "w": [got["w"].tobytes()], "v": [got["v"].tobytes()], "b": [got["b"]]})

    return fit


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, train_rows: int = TRAIN_ROWS) -> dict:
    """Fits the machine to ``labels`` (doc_id, quality), at most ``train_rows`` of them: those whose hashed ids are smallest.

    The sample's features are split into ``SHARDS`` shards; each shard fits from the shared model, the models are averaged by rows, and
    this repeats ``ROUNDS`` times. Without labels the model is constant: every score is 0.5.
    """
    chosen = (labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    chosen = scratch.table(chosen, "chosen")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, row, bucket, value, stats in _features(b["text"], b["n_chars"].to_numpy(zero_copy_only=False)):
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                wide = lambda x: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x, pa.float32()))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([b["shard"].slice(lo, hi - lo), b["y"].slice(lo, hi - lo), wide(bucket), wide(value),
                                                  pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel(), pa.float32()), STATS).cast(pa.list_(pa.float32()))],
                                                 names=["shard", "y", "bucket", "value", "stats"])

    # The chosen ids are at most train_rows rows of two numbers.
    sample = (_input(docs).join(F.broadcast(chosen), "doc_id")
              .select("text", "n_chars", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int").alias("shard"), F.col("y").cast("double").alias("y")))
    sample = scratch.table(sample.mapInArrow(extract, "shard int, y double, bucket array<float>, value array<float>, stats array<float>"), "features")
    cells = [F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(STATS)] + [F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(STATS)]
    first = sample.agg(*cells).first()
    mean = np.array([first[f"m{i}"] or 0.0 for i in range(STATS)])
    spread = np.array([first[f"s{i}"] or 0.0 for i in range(STATS)])
    spread = np.where(spread < 1e-6, 1.0, spread)
    start = np.random.default_rng(7).normal(0, 0.05, (BUCKETS + STATS, RANK))
    model = {"w": np.zeros(BUCKETS + STATS), "v": start, "b": 0.0, "mean": mean, "spread": spread}
    for turn in range(ROUNDS):
        fit = _shard_fit(model, turn)
        got = sample.groupBy("shard").applyInPandas(fit, "n long, w binary, v binary, b double").collect()  # SHARDS rows
        if not got:
            return model | {"v": np.zeros_like(start)}
        got.sort(key=lambda r: (r["n"], r["b"]))
        total = sum(r["n"] for r in got)
        model |= {k: sum(np.frombuffer(r[k]) * (r["n"] / total) for r in got).reshape(model[k].shape) for k in ("w", "v")}
        model["b"] = sum(r["b"] * r["n"] for r in got) / total
    return model


def _n_chars(docs: DataFrame):
    given = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return F.greatest(F.coalesce(given, F.length("text").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("n_chars")


def _input(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", _n_chars(docs))


def score(docs: DataFrame, model: dict, keep: list[str], name: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and their score as ``name``; every whole text, in bounded runs of rows."""
    rest = [c for c in keep if c != "text"]  # the text crosses to the workers once
    wide = docs.select(F.struct(*rest).alias("kept") if rest else F.lit(0).alias("kept"), "text", _n_chars(docs))
    schema = docs.select(*keep).withColumn(name, F.lit(0.0)).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros(b.num_rows)
            for lo, hi, row, bucket, value, stats in _features(b["text"], b["n_chars"].to_numpy(zero_copy_only=False)):
                out[lo:hi] = score_parts(model, hi - lo, row, bucket, value, stats)
            kept = dict(zip(rest, b["kept"].flatten() if rest else [])) | {"text": b["text"]}
            yield pa.RecordBatch.from_arrays([*(kept[c] for c in keep), pa.array(out)], names=[*keep, name])

    return wide.mapInArrow(apply, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, scratch: Scratch, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1; higher: label 1 likelier) and predicted (1 from 0.5 on) of every document.

    Inputs of a score are the words, the statistics of ``_stats`` and ``n_chars`` (the text's length where that column is missing or
    null), nothing else. Labels of documents whose crc32 of the id leaves 1 modulo 3 are not learned. A null or empty text has no words
    and gets the score of its statistics. Rows with a null or repeated id are scored like others; of several labels of one document the
    larger counts; an empty table gives no rows. Other columns are ignored.
    """
    model = train(docs, labels.filter(~held_out("doc_id", 3, 1)), scratch, train_rows)
    out = score(docs, model, ["doc_id"])
    return out.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, scratch: Scratch, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    model = train(docs, labels.filter(~held_out("doc_id", 3, 1)), scratch, train_rows)
    mark = "score_" + "_".join(docs.columns)  # a name that no column has
    return score(docs, model, docs.columns, mark).filter(F.col(mark) >= 0.5).drop(mark)

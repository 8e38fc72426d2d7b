"""Fingerprints, mixing, packing, quality scores and languages against plain versions, over all of ``documents``."""

import hashlib
import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest

from shelfweave.llm import languages as language_parts
from shelfweave.llm import mixing as mixing_parts
from shelfweave.llm import quality as quality_parts
from shelfweave.llm.fingerprints import fingerprints
from shelfweave.llm.languages import languages
from shelfweave.llm.mixing import mixture
from shelfweave.llm.packing import packed
from shelfweave.llm.passages import _common, align, passing, passing_each
from shelfweave.llm.scratch import Scratch
from shelfweave.llm.text import mix


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return sorted(docs.select("doc_id", "text", "lang", "source").collect(), key=lambda r: r.doc_id)


def _shingles(text):
    w = text.split()
    return {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def _jaccard(a, b):
    a, b = _shingles(a), _shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_documents(spark, docs, rows):
    """Edited texts exactly; likenesses near the true Jaccard, without bias; equal texts have equal fingerprints, others have not."""
    got = {r.doc_id: r for r in fingerprints(docs, Scratch(spark, "test")).collect()}
    assert len(got) == len(rows)
    off, marks = [], defaultdict(set)
    for r, after in zip(rows, rows[1:] + rows[:1]):
        text, other, own = r.text or "", after.text or "", got[r.doc_id]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + other[:cut]
        assert own.n_chars == len(text) and own.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        off += [own.near_edited - _jaccard(text, edited), own.near_next - _jaccard(text, other)]
        marks[text].add(own.fingerprint)
        marks[edited].add(own.edited_fingerprint)
    # 256 bins: a standard deviation of 0.031 at most for sets that fill them, somewhat more for short texts.
    assert abs(np.mean(off)) < 0.005 and np.sqrt(np.mean(np.square(off))) < 0.04 and np.max(np.abs(off)) < 0.2
    assert all(len(m) == 1 for m in marks.values())


def test_copies_follow_the_tilted_rates(spark, docs, rows):
    """The convex dual by bisection: copies of each source and size are its documents times the tilted rate, rounded, but for a few repairs."""
    got = mixture(docs, Scratch(spark, "test")).collect()
    source = {r.doc_id: r.source for r in rows}
    by = defaultdict(lambda: [0, 0])
    target, total, number = {}, Counter(), Counter()
    for r in got:
        s = source[r.doc_id]
        by[s, r["size"]][0] += 1
        by[s, r["size"]][1] += r.copies
        target[s], total[s], number[s] = r.target, total[s] + r["size"], number[s] + 1
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r["size"]
    for s in target:
        if target[s] >= 2 * total[s] * (1 - 1e-9):
            assert all(c == 2 * n for (t, size), (n, c) in by.items() if t == s and size)
            continue
        mean = total[s] / number[s]
        own = [(size, n, c) for (t, size), (n, c) in by.items() if t == s]
        low, high = -60.0, 60.0
        for _ in range(200):
            dual = (low + high) / 2
            words = sum(2 * n * size / (1 + math.exp(-dual * size / mean)) for size, n, _ in own)
            low, high = (low, dual) if words > target[s] else (dual, high)
        off = [abs(c - 2 * n / (1 + math.exp(-dual * size / mean))) for size, n, c in own]
        assert sum(x > 1.001 for x in off) <= mixing_parts.REPAIR_ROUNDS, (s, sorted(off)[-5:])


def test_pieces_hold_the_ids_of_the_tokenizer(spark, docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = defaultdict(list)
    for r in packed(docs, path, Scratch(spark, "test")).collect():
        pieces[r.doc_id].append(r)
    tokenizer = Tokenizer.from_file(path)
    for r in rows:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        own, at = sorted(pieces[r.doc_id], key=lambda p: p.start), 0
        for p in own:
            assert p.start == at and p.doc_tokens == len(ids) and zlib.crc32(ids[at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)


def test_scores_equal_the_sum_over_pairs():
    """The linear-time score is bias, weights and the inner products of all pairs of features, one by one."""
    random = np.random.default_rng(2)
    wide = quality_parts.BUCKETS + quality_parts.STATS
    model = {"w": random.normal(size=wide) / 9, "v": random.normal(size=(wide, 6)) / 9, "b": 0.3, "mean": random.normal(size=quality_parts.STATS), "spread": random.random(quality_parts.STATS) + 0.5}
    row = np.repeat([0, 2, 3], [7, 1, 12])
    bucket = np.concatenate([random.choice(quality_parts.BUCKETS, n, replace=False) for n in (7, 1, 12)])
    value, stats = random.random(20), random.normal(size=(4, quality_parts.STATS))
    got = quality_parts.score_parts(model, 4, row, bucket, value, stats)
    for i in range(4):
        x = dict(zip(bucket[row == i].tolist(), value[row == i].tolist()))
        x |= {quality_parts.BUCKETS + k: (stats[i, k] - model["mean"][k]) / model["spread"][k] for k in range(quality_parts.STATS)}
        margin = model["b"] + sum(model["w"][a] * u for a, u in x.items())
        margin += sum(float(model["v"][a] @ model["v"][b]) * x[a] * x[b] for a in x for b in x if a < b)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_languages_equal_plain_naive_bayes(spark, docs, rows):
    """Counts of grams with dictionaries, log probabilities one by one."""
    cells, place = language_parts.BUCKETS, {}

    def bucket(gram):
        if gram not in place:
            value = 0
            for c in gram:
                value = (value * 0x110000 + ord(c)) % (1 << 64)
            place[gram] = int(mix(np.array([value], np.uint64))[0] % np.uint64(cells - 1)) + 1
        return place[gram]

    def grams(text):
        text = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
        every = (text[k : k + n] for n in language_parts.LENGTHS for k in range(len(text) - n + 1))
        return Counter(bucket(g) for g in every if not g.startswith("  "))

    held = lambda r: zlib.crc32(str(r.doc_id).encode()) % 4 == 2
    own = {r.doc_id: grams(r.text or "") for r in rows}
    counts, number = defaultdict(Counter), Counter()
    for r in rows:
        if r.lang is not None and r.text is not None and not held(r):
            counts[r.lang] += own[r.doc_id]
            number[r.lang] += 1
    langs, smooth = sorted(number), language_parts.SMOOTHING
    whole = {s: sum(counts[s].values()) + smooth * cells for s in langs}
    got = {r.doc_id: r for r in languages(docs, Scratch(spark, "test")).collect()}
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == "und"
            continue
        score = [math.log(number[s] / sum(number.values())) + sum(n * math.log((counts[s][g] + smooth) / whole[s]) for g, n in own[r.doc_id].items()) for s in langs]
        best = max(range(len(langs)), key=score.__getitem__)
        share = 1 / sum(math.exp(x - score[best]) for x in score)
        assert got[r.doc_id].held_out == held(r) and got[r.doc_id].lang_pred == langs[best] and abs(got[r.doc_id].score - share) < 0.01, (r.doc_id, score)


def test_quality_fits_without_a_wide_table_of_its_rows():
    random, rows, wide = np.random.default_rng(9), 3000, quality_parts.BUCKETS + quality_parts.STATS
    bucket = [random.choice(quality_parts.BUCKETS, k % 30, replace=False).astype(np.float32) for k in range(rows)]
    frame = pd.DataFrame({"y": [float(k % 2) for k in range(rows)], "bucket": bucket, "value": [random.random(len(x)).astype(np.float32) for x in bucket],
                          "stats": [random.random(quality_parts.STATS).astype(np.float32) for _ in range(rows)]})
    sample = quality_parts.Sample(np.append(0, np.cumsum([len(x) for x in bucket])), np.concatenate(bucket).astype(np.int64), np.concatenate(frame["value"]), np.stack(frame["stats"]))
    for take in (np.array([7, 0, 2999, 31]), np.array([30])):
        x = sample.wide(take)
        for i, k in enumerate(take):
            own = np.zeros(wide, np.float32)
            own[bucket[k].astype(int)], own[quality_parts.BUCKETS :] = frame["value"][k], frame["stats"][k]
            assert (x[i] == own).all()
    model = {"w": np.zeros(wide), "v": random.normal(0, 0.05, (wide, quality_parts.RANK)), "b": 0.0, "mean": np.zeros(quality_parts.STATS), "spread": np.ones(quality_parts.STATS)}
    tracemalloc.start()
    try:
        quality_parts._shard_fit(model, 0)((0,), frame)
        assert tracemalloc.get_traced_memory()[1] < rows * wide * 4 / 2  # bytes; the wide table and its sorted copy are four times that
    finally:
        tracemalloc.stop()


def test_batches_to_workers_end_at_some_bytes(spark):
    Scratch(spark, "batches")
    texts = spark.range(0, 400, 1, 1).selectExpr("id", "repeat('a word and more ', 4000) text")  # 60,000 bytes each

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"])

    found = [r["size"] for r in texts.mapInArrow(sizes, "size long").collect()]
    assert sum(found) > 400 * 60_000 and max(found) < 8 << 20


def _plain_reach(a, b):
    at_a = at_b = 0
    marks = []
    while True:
        n = min(len(a) - at_a, len(b) - at_b, 64)
        if n <= 0:
            return marks
        same = a[at_a : at_a + n] == b[at_b : at_b + n]
        score = np.cumsum(np.where(same, 1, -2))
        best = int(np.argmax(score))
        if score[best] > 0:
            at_a, at_b = at_a + best + 1, at_b + best + 1
            marks.extend(same[: best + 1])
            if best + 1 == n:
                continue
        for da, db in ((1, 0), (0, 1), (1, 1), (2, 0), (0, 2), (2, 2), (3, 0), (0, 3), (3, 3)):
            if at_a + da + 6 <= len(a) and at_b + db + 6 <= len(b) and (a[at_a + da : at_a + da + 6] == b[at_b + db : at_b + db + 6]).all():
                at_a, at_b = at_a + da, at_b + db
                marks.extend([False] * da)
                break
        else:
            return marks


def test_chains_aligned_at_once():
    """Chains that are aligned together give what each gives alone, word by word."""
    rng, cases = np.random.default_rng(4), []
    for _ in range(300):
        a = rng.integers(0, 40, rng.integers(8, 400)).astype(np.uint32)
        b = []
        for v in a.tolist():
            b += [] if rng.random() < 0.02 else [v] * (1 + (rng.random() < 0.02)) if rng.random() < 0.95 else [99]
        b = np.array(b, np.uint32)
        x, y = [], []
        for i in range(len(a) - 4):
            for j in range(max(i - 6, 0), min(i + 7, len(b) - 4)):
                if (a[i : i + 5] == b[j : j + 5]).all() and (not x or (i > x[-1] + 4 and j > y[-1] + 4)) and rng.random() < 0.2:
                    x, y = [*x, i], [*y, j]
        if x:
            cases.append((a, b, x, y))
    lens = [np.array([len(c[k]) for c in cases]) for k in range(3)]
    begin, length, mark = align(np.concatenate([c[0] for c in cases]), np.cumsum(lens[0]) - lens[0], lens[0], np.concatenate([c[1] for c in cases]), np.cumsum(lens[1]) - lens[1], lens[1],
                                *(np.concatenate([c[k] for c in cases]).astype(np.int64) for k in (2, 3)), lens[2])
    got = np.split(mark, np.cumsum(length)[:-1])
    for i, (a, b, x, y) in enumerate(cases):
        middle = [a[p:q] == b[r:s] if q - p == s - r else _common(a[p:q], b[r:s]) for p, q, r, s in zip(x, x[1:], y, y[1:])]
        back = _plain_reach(a[: x[0]][::-1], b[: y[0]][::-1])[::-1]
        assert begin[i] == x[0] - len(back)
        assert got[i].tolist() == np.concatenate([np.array(back, bool), *middle, np.array(_plain_reach(a[x[-1] :], b[y[-1] :]), bool)]).tolist()
    row, p, q = passing_each(mark, length, 0.8, 12)
    assert len(cases) > 100 and list(zip(row.tolist(), p.tolist(), q.tolist())) == [(i, *z) for i, m in enumerate(got) for z in passing(m, 0.8, 12)]

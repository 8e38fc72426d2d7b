"""The operators for training text against plain versions, and on rows that are null, empty, equal, long or few."""

import hashlib
import os
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfweave.llm import licences as licence_parts
from shelfweave.llm import minhash as minhash_parts
from shelfweave.llm.embeddings import near_vectors
from shelfweave.llm.fingerprints import fingerprints
from shelfweave.llm.languages import languages
from shelfweave.llm.licences import licences
from shelfweave.llm.minhash import keep_first, likeness, near_duplicates
from shelfweave.llm.mixing import mixed, mixture
from shelfweave.llm.packing import packed, shortest_pack_first
from shelfweave.llm.passages import best_chain, chains, cut_passages, passing, repeated_passages
from shelfweave.llm.quality import keep_good, quality_scores
from shelfweave.llm.scratch import Scratch
from shelfweave.llm.suffixes import repeated_bytes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, class_id long, size string, digest string"


def _words(n, salt):
    return " ".join(hashlib.md5(f"{salt}-{i}".encode()).hexdigest()[: 3 + i % 6] for i in range(n))


ODD = [
    (1, _words(120, "a"), "en", "s1"), (2, _words(120, "a"), "en", "s1"), (3, _words(118, "a") + " other end", "de", None), (4, None, None, None), (5, "", "en", "s2"),
    (None, _words(30, "b"), "en", "s1"), (None, None, None, None), (6, _words(20000, "c"), "de", "s2"), (7, "one", "en", "s1"), (8, "one", "en", "s1"),
    (9, _words(80, "d"), "en", "s3"), (9, _words(80, "d"), "en", "s3"), (10, " \n\t ", "de", "s2"), (11, _words(60, "e") + " " + _words(70, "a"), "en", "s1"), (12, "é" * 500 + "é" * 500, "fr", "s3"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, l, s, None, 0.5, 7, "x", "y") for i, t, l, s in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(0, 14)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _scratch(spark):
    return Scratch(spark, "test")


def _covered(texts, length=400):
    seen = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            seen[t[p : p + length]] = seen.get(t[p : p + length], 0) + 1
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        yield gone


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_repeated_bytes_is_brute_force(spark, table, request):
    df = request.getfixturevalue(table)
    rows = [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]
    want = []
    for (doc_id, t), gone in zip(rows, _covered([t for _, t in rows])):
        left = np.frombuffer(t, np.uint8)[~gone].tobytes() if t else b""
        want.append((doc_id or -1, len(t), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0, hashlib.sha256(left).hexdigest()))
    got = [(r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_bytes(df, _scratch(spark)).collect()]
    assert sorted(got) == sorted(want)


def test_fingerprints(spark, odd):
    got = fingerprints(odd, _scratch(spark)).collect()
    assert len(got) == len(ODD)
    texts = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint and by_id[1].near_next == 1.0
    assert by_id[4].fingerprint == "" and by_id[4].near_next == 1.0 and by_id[5].near_next == 0.0
    own, after = by_id[11], next(t for i, t, *_ in texts if i == 12)
    text = next(t for i, t, *_ in ODD if i == 11)
    cut = len(text) // 4
    assert own.edited_sha256 == hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()
    a, b = (frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for w in (text.split(), (text[: len(text) - cut] + after[:cut]).split()))
    assert abs(own.near_edited - len(a & b) / len(a | b)) < 0.15


def test_mixture(spark, docs, odd):
    rows = mixture(docs, _scratch(spark)).join(docs.select("doc_id", "source"), "doc_id").collect()
    sources = sorted({r.source for r in rows})
    total, level = {s: sum(r["size"] for r in rows if r.source == s) for s in sources}, 0.0
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    for _ in range(100):
        full = [s for s in sources if 2 * total[s] <= weight[s] * level]
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in full)) / sum(weight[s] for s in sources if s not in full)
    for s in sources:
        own = [r for r in rows if r.source == s]
        target = min(2 * total[s], weight[s] * level)
        assert abs(own[0].target - target) < 1e-6 * target + 1e-6 and own[0].source_size == total[s]
        assert abs(sum(r.taken for r in own) - target) <= max(0.03 * target, 60), s
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    got = mixture(odd, _scratch(spark)).collect()
    assert len(got) == len(ODD) and all(r.taken == 0 for r in got if not r["size"])
    out = mixed(odd, _scratch(spark))
    assert out.columns == odd.columns and out.agg(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0] > 0


def test_packing(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    got = packed(odd, path, _scratch(spark)).collect()
    for doc_id, text in ((6, _words(20000, "c")), (4, ""), (11, ODD[13][1])):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        own = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: r.start)
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    place = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert place.get(r.sequence_id, 0) == r.offset
        place[r.sequence_id] = r.offset + r.length
    assert max(place.values()) <= 4096


def test_shortest_pack_first():
    histogram = {4096: 3, 3000: 10, 1100: 4, 1000: 25, 96: 7, 1: 1000}
    patterns = shortest_pack_first(histogram)
    held = {}
    for number, lengths in patterns:
        assert sum(lengths) <= 4096
        for length in lengths:
            held[length] = held.get(length, 0) + number
    assert held == histogram


def test_embeddings_are_brute_force(spark):
    random = np.random.default_rng(1)
    base = random.normal(size=(300, 32)).astype(np.float32)
    near = base[:40] + random.normal(scale=0.05, size=(40, 32)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((base, near, base[:5])))]
    rows += [(900, None), (901, [0.0] * 32), (902, [float("nan")] * 32), (903, [1.0, None]), (904, []), (None, base[0].tolist())]
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), _scratch(spark)).collect()}
    x = np.array([v for _, v in rows[:345]], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.9).sum(1) - 1
    assert sum(got[i].n_links for i in range(345)) >= 0.95 * links.sum() and all(got[i].n_links <= links[i] for i in range(345))
    assert all(got[i].n_links == 0 and got[i].kept and got[i].component_id == i for i in range(900, 905)) and len(got) == 351
    assert got[340].component_id == 0 and not got[340].kept


def test_quality(spark, docs, odd, labels, sf_dir):
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = quality_scores(docs, marks, _scratch(spark)).join(marks, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.predicted == r.quality for r in got if r.held_out]) >= 0.9
    assert quality_scores(odd, labels, _scratch(spark)).filter("score between 0 and 1").count() == len(ODD)
    assert keep_good(odd, labels.limit(0), _scratch(spark)).count() == len(ODD)


def test_near_duplicates(spark, odd):
    got = {r.doc_id: r.class_id for r in near_duplicates(odd, _scratch(spark)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11, 12: 12}
    kept = keep_first(odd, _scratch(spark))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 4, 6, 7, 9, 10, 11, 12] and kept.columns == odd.columns


def test_across_goes_by_band_keys(spark):
    """Registers of band 0 agree in their bytes, its keys don't: the pair is verified in band 3, the first it shares, and there only."""
    shared = spark.createDataFrame([(b, k, i) for i in (1, 2) for b, k in ((3, 33), (4, 44))], "band int, key long, doc_id long")
    found = spark.createDataFrame([], "node long, component long")
    single = spark.createDataFrame([(i, [i * 10 + b if b not in (3, 4) else b * 11 for b in range(25)], bytearray(125)) for i in (1, 2)], "doc_id long, bands array<long>, registers binary")
    sets = spark.createDataFrame([(i, bytearray(np.arange(40, dtype="<u4").tobytes()), bytearray()) for i in (1, 2)], "doc_id long, value binary, weight binary")
    assert [tuple(r) for r in minhash_parts._across(shared, found, single, sets, _scratch(spark), 0.8).collect()] == [(2, 1)]


def test_near_duplicates_are_brute_force(spark):
    """1,200 variants of three template texts, more than a block in mixed buckets, against all pairs."""
    random = np.random.default_rng(5)
    texts = []
    for k in range(1200):
        w = _words(130, f"t{k % 3}").split()
        for p in random.choice(130, int(random.integers(1, 5)), replace=False):
            w[p] = f"own{k}x{p}"
        texts.append(w)
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in texts]
    number = {}
    cells = np.zeros((len(sets), len({g for s in sets for g in s})), np.float32)
    for i, s in enumerate(sets):
        cells[i, [number.setdefault(g, len(number)) for g in s]] = 1
    common = cells @ cells.T
    size = cells.sum(1)
    linked = common / (size[:, None] + size[None, :] - common) >= 0.8
    want = list(range(len(sets)))
    for i in range(len(sets)):
        todo = [i] if want[i] == i else []
        while todo:
            for j in np.flatnonzero(linked[todo.pop()]):
                if j > i and want[j] == j:
                    want[j] = i
                    todo.append(j)
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string"), _scratch(spark)).collect()}
    assert got == dict(enumerate(want)) and len(set(want)) > 3


def test_likeness():
    random = np.random.default_rng(3)
    for _ in range(20):
        sets = []
        for _ in "ab":
            v = np.unique(random.integers(0, 30, 20))
            sets.append((v, random.integers(1, 5, len(v))))
        (av, aw), (bv, bw) = sets
        w, v = dict(zip(av.tolist(), aw.tolist())), dict(zip(bv.tolist(), bw.tolist()))
        want = sum(1 / sum(max(w.get(e, 0) / w[d], v.get(e, 0) / v[d]) for e in w.keys() | v.keys()) for d in w.keys() & v.keys())
        assert abs(likeness(*sets) - want) < 1e-9


def test_licences(spark, docs, odd):
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {(i, k) for i, t in texts.items() for k, line in enumerate(t.split("\n")) if "icense" in line or "rights reserved" in line}
    got = licences(docs, _scratch(spark)).collect()
    assert {(r.doc_id, r.paragraph) for r in got} == want and all(r.confirmed for r in got)
    assert licences(odd, _scratch(spark)).count() == 0


def test_anchors_lose_no_find(spark, docs):
    """Every paragraph through the model, without the anchors before it, gives the same finds."""
    grams = licence_parts.vocabulary()
    model, _ = licence_parts.train(spark)
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("number", "paragraph"))
    raw = model.transform(licence_parts._features(lines, grams)).select("doc_id", "number", vector_to_array("rawPrediction").alias("raw"))
    want = raw.filter(F.array_position("raw", F.array_max("raw")) <= len(licence_parts.TEMPLATES)).select("doc_id", "number")
    got = licences(docs, _scratch(spark)).select("doc_id", "paragraph")
    assert want.count() and sorted(map(tuple, want.collect())) == sorted(map(tuple, got.collect()))


def _found(spark, texts):
    got = {}
    for r in licences(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), _scratch(spark)).collect():
        got.setdefault(r.doc_id, []).append((r.paragraph, r.n_lines, r.family, r.confirmed))
    return [sorted(got.get(i, [])) for i in range(len(texts))]


def test_licence_wordings(spark):
    """Versions and relatives of a licence, denials, identifiers, two licences in a line, wrapped and marked notices, nulls."""
    one = {
        "This work is licensed under the GNU General Public License, version 2.": "gpl-2.0", "Licensed under the GNU Affero General Public License, version 3": "agpl-3.0",
        "Released under the Eclipse Public License, version 2.0": "epl-2.0", "Licensed under the Apache License, Version 1.1": "apache-1.1", "Subject to the Mozilla Public License, version 1.1": "mpl-1.1",
        "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3.0", "The code is distributed under the terms of the ISC licence.": "isc",
        "This software is provided under the GNU Lesser General Public License v2.1.": "lgpl-2.1", "This repository is made public under CC BY-SA 4.0 by its authors": "cc-by-sa-4.0",
    }
    nothing = ["We never released this under the MIT License.", "He renewed the fishing license.", "Licensed under the European Union Public Licence, version 1.2", "", None, "\n\n \n", "\n"]
    more = ["Dual licensed under the MIT License or the Apache License, Version 2.0.", "a\n\n * Licensed under the Apache\n * License, Version\n * 2.0 (the \"License\"); you may not use this\n\nb\nAll rights reserved."]
    got = _found(spark, list(one) + nothing + more)
    assert got[: len(one)] == [[(0, 1, family, True)] for family in one.values()]
    assert got[len(one) : -2] == [[]] * len(nothing)
    assert got[-2] == [(0, 1, "apache-2.0", True), (0, 1, "mit", True)] and got[-1] == [(2, 3, "apache-2.0", True), (7, 1, "proprietary", True)]


def test_licences_of_odd_tables(spark, none):
    """Null and repeated ids, columns with the operator's own names, many blank lines, no rows."""
    schema = "doc_id long, text string, row string, words string, family string, number long, paragraph string"
    rows = [(i, "Released under the MIT License.", "a", "b", "c", 1, "d") for i in (None, None, 3, 3)] + [(4, "x\n\n" * 3000 + "y\nReleased under the\nMIT License.\n", "a", "b", "c", 1, "d")]
    got = licences(spark.createDataFrame(rows, schema), _scratch(spark)).collect()
    assert sorted((r.doc_id or 0, r.paragraph, r.n_lines, r.family, r.confirmed) for r in got) == [(0, 0, 1, "mit", True)] * 2 + [(3, 0, 1, "mit", True)] * 2 + [(4, 6000, 3, "mit", True)]
    assert licences(none, _scratch(spark)).count() == 0


def test_wrapped_notices(spark):
    """Every notice in lines of at most 40 letters, between other lines and between blank lines, is found once and confirmed."""
    notices = [(family, n) for family, of in licence_parts.FAMILIES.items() for n in of.notices if len(n) > 50]
    texts = [f"some words before{gap}{chr(10).join(textwrap.wrap(n, 40))}{gap}and words after" for _, n in notices for gap in ("\n", "\n \n")]
    got = _found(spark, texts)
    for k, rows in enumerate(got):
        assert [(f, c) for _, _, f, c in rows if c] == [(notices[k // 2][0], True)], texts[k]


def test_wordings_held_out(spark):
    """Recall and precision on names in wordings that the model has not seen, denials and licences out of the list included."""
    grants = ("You are free to share this package under the {}.", "Everything in this folder is offered under the {}", "Terms: see the {}.")
    denials = ("The authors did not choose the {}.", "A lecture on the {} was held in spring.")
    rows = [(f, g.format(n)) for f, of in licence_parts.FAMILIES.items() for n in licence_parts._named(of) for g in grants]
    wrong = [d.format(n) for of in licence_parts.FAMILIES.values() for n in licence_parts._named(of) for d in denials]
    wrong += [g.format(n) for n in licence_parts.UNLISTED for g in grants]
    got = _found(spark, [t for _, t in rows] + wrong)
    right = [any(f == family for _, _, f, _ in found) for (family, _), found in zip(rows, got)]
    false = [any(c for *_, c in found) for found in got[len(rows) :]]
    print("recall", np.mean(right), "of", len(rows), "confirmed wrongly", np.mean(false), "of", len(wrong), [w for w, x in zip(wrong, false) if x][:8], [t for (_, t), x in zip(rows, right) if not x][:8])
    assert np.mean(right) >= 0.9 and np.mean(false) <= 0.1


def test_languages(spark, docs, odd):
    got = languages(docs, _scratch(spark)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in got if r.held_out]) >= 0.97
    got = languages(odd, _scratch(spark)).collect()
    assert len(got) == len(ODD) and {r.lang_pred for r in got if r.doc_id in (4, 5, 10)} == {"und"}


def test_passages(spark, docs, odd):
    words, first, got = {r.doc_id: r.text.split() for r in docs.collect()}, {}, {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][k : k + 50]), i)
    for r in repeated_passages(docs, _scratch(spark)).collect():
        got.setdefault(r.doc_id, np.zeros(len(words[r.doc_id]), bool))[r.first_word : r.end_word] = True
        assert all(o < r.doc_id for o in r.others)
    missed = total = 0
    for i, w in words.items():
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] != i:
                total += 50
                missed += 50 - int(got[i][k : k + 50].sum()) if i in got else 50
    assert total and missed <= 0.01 * total
    cut = {r.doc_id: r for r in cut_passages(odd, _scratch(spark)).collect()}
    assert cut[2].text == "" and cut[2].n_chars == 0 and cut[1].text == ODD[0][1] and cut[11].text.strip() == _words(60, "e")


def test_passing():
    marks = lambda *n: np.concatenate([np.full(k, i % 2 == 0) for i, k in enumerate(n)])
    assert passing(marks(70, 28, 20), 0.8, 50) == [(0, 70)]
    assert passing(marks(50, 26, 50), 0.8, 50) == [(0, 50), (76, 126)]
    assert passing(marks(30, 8, 30), 0.8, 50) == [(0, 68)]
    assert passing(marks(50, 25, 50, 25, 50), 0.8, 50) == [(0, 125), (75, 200)]
    assert passing(marks(20, 20, 20), 0.8, 50) == [] == passing(np.zeros(90, bool), 0.8, 50)


def test_passages_beside_gaps(spark):
    """A shared run of 50 words or more is found, whatever its chain takes in behind a gap of other words."""
    rows, want = [], {}
    for k, (n, gap, m) in enumerate([(70, 28, 20), (50, 26, 50), (100, 30, 16)] * 12):
        first, last = _words(n, f"f{k}"), _words(m, f"l{k}")
        rows += [(2 * k, f"{_words(9, f'a{k}')} {first} {_words(gap, f'g{k}')} {last} {_words(9, f'b{k}')}"),
                 (2 * k + 1, f"{_words(7, f'c{k}')} {first} {_words(gap, f'h{k}')} {last} {_words(8, f'd{k}')}")]
        want[2 * k + 1] = [(7, 7 + n), *([(7 + n + gap, 7 + n + gap + m)] if m >= 50 else [])]
    got = {}
    for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), _scratch(spark)).collect():
        got.setdefault(r.doc_id, []).append((r.first_word, r.end_word))
    assert {i: sorted(v) for i, v in got.items()} == want


@pytest.mark.parametrize("other_first", [False, True])
def test_passages_whose_seeds_are_elsewhere(spark, other_first):
    """Two documents share 50 words, and every run of 29 to 49 of these (or of 5 to 12) has its first copy in a document of its own."""
    rows, want = [], set()
    for k in range(20):
        shared = _words(50, f"s{k}").split()
        n = 40 if other_first else 12
        for j in range(0, 51 - n):
            rows.append((1000 * k + j, " ".join([_words(60, f"p{k}-{j}"), *shared[j : j + n], _words(60, f"q{k}-{j}")])))
        rows += [(1000 * k + 100, " ".join([_words(30, f"a{k}"), *shared, _words(30, f"b{k}")])), (1000 * k + 200, " ".join([_words(41, f"c{k}"), *shared, _words(30, f"d{k}")]))]
        want.add((1000 * k + 200, 41, 91))
    got = {(r.doc_id, r.first_word, r.end_word): r.others for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), _scratch(spark)).collect()}
    assert want <= got.keys() and all(i - 100 in got[i, p, q] for i, p, q in want)


@pytest.mark.parametrize("put_in", [0, 1])
def test_near_passages_whose_seeds_are_elsewhere(spark, put_in):
    """Two documents share phrases of 20 words with other words between them, and each phrase has its first copy in a document of its own."""
    rows, want = [], {}
    for k in range(20):
        phrases = [_words(20, f"s{k}-{j}") for j in range(5)]
        rows += [(1000 * k + j, f"{_words(60, f'p{k}-{j}')} {p} {_words(60, f'q{k}-{j}')}") for j, p in enumerate(phrases)]
        mixed = lambda name, n: " ".join(f"{p} {_words(n, f'{name}{k}-{j}')}" for j, p in enumerate(phrases))  # noqa: B023, E731
        rows += [(1000 * k + 100, f"{_words(30, f'a{k}')} {mixed('b', 5)} {_words(30, f'c{k}')}"), (1000 * k + 200, f"{_words(41, f'd{k}')} {mixed('e', 5 + put_in)} {_words(30, f'f{k}')}")]
        # One more has all phrases, too far apart.
        rows.append((1000 * k + 300, " ".join(f"{p} {_words(50, f'g{k}-{j}')}" for j, p in enumerate(phrases))))
        want[1000 * k + 200] = (41, 41 + 5 * 20 + 4 * (5 + put_in))
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), _scratch(spark)).collect()
    assert {r.doc_id for r in found} == want.keys() and all(r.doc_id - 100 in r.others and r.first_word >= want[r.doc_id][0] and r.end_word <= want[r.doc_id][1] for r in found)
    assert sum(r.end_word - r.first_word for r in found) >= (0.9 if put_in else 1) * sum(q - p for p, q in want.values())


def test_no_seed_outside_of_passages_is_left_to_one_partner(spark):
    """Every earlier document that has two of the runs beside a difference is met, not only the first one."""
    runs = [_words(20, f"r{j}") for j in range(4)]
    rows = [(j, f"{_words(60, f'p{j}')} {r} {_words(60, f'q{j}')}") for j, r in enumerate(runs)]
    # The first two runs are shared with many at a distance of 9 words, all four with the last but one only.
    rows += [(10 + i, f"{_words(30, f'a{i}')} {runs[0]} {_words(9, f'b{i}')} {runs[1]} {_words(30, f'c{i}')}") for i in range(30)]
    rows += [(90, f"{_words(30, 'd')} {runs[0]} {_words(9, 'e')} {runs[1]} {_words(3, 'f')} {runs[2]} {_words(3, 'g')} {runs[3]}"),
             (91, f"{_words(30, 'h')} {runs[0]} {_words(9, 'i')} {runs[1]} {_words(4, 'j')} {runs[2]} {_words(3, 'k')} {runs[3]}")]
    found = [r for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), _scratch(spark)).collect() if r.doc_id == 91]
    assert [(r.first_word, r.end_word) for r in found] == [(30, 126)] and 90 in found[0].others


def test_best_chain():
    x, y = np.array([0, 5, 10, 15, 20, 25]), np.array([100, 105, 3, 110, 115, 500])
    assert best_chain(x, y) == [0, 1, 3, 4]


def test_chains_of_a_passage_repeated_many_times():
    # 3,000 places of one passage of ten matches, 100 words apart: a chain for each, from one scoring
    x = (np.arange(3000)[:, None] * 100 + np.arange(10) * 6).ravel()
    y = np.tile(np.arange(10) * 6 + 40, 3000)
    found = chains(x, y)
    assert sorted(map(len, found)) == [10] * 3000
    assert all((np.diff(x[c]) == 6).all() and (np.diff(y[c]) == 6).all() for c in found)
    assert sorted(np.concatenate(found)) == list(range(30000))


def test_empty_tables(spark, none, labels):
    s = _scratch(spark)
    for out in (repeated_bytes(none, s), fingerprints(none, s), mixture(none, s), mixed(none, s), packed(none, public_tokenizers.path("word_bpe_49k.json"), s), quality_scores(none, labels, s), near_duplicates(none, s),
                keep_first(none, s), licences(none, s), languages(none, s), repeated_passages(none, s), cut_passages(none, s), near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"), s)):
        assert out.count() == 0


def test_passages_of_an_id_with_several_texts(spark):
    """A passage far into one text of an id is found, though another text of this id is shorter."""
    changed = _words(120, "m").split()
    changed[60] = "other"
    rows = [(0, f"{_words(700, 'l')} {_words(120, 'm')}"), (0, _words(60, "s")), (1, f"{_words(30, 'x')} {' '.join(changed)} {_words(30, 'y')}")]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), _scratch(spark)).collect()
    assert [(r.doc_id, r.first_word, r.end_word, r.others) for r in found] == [(1, 30, 150, [0])]


def test_passages_keep_only_tables_with_readers(spark, docs):
    """What no later step reads is gone when the passages are asked for, and their words are not written out with keys of their own."""
    s = _scratch(spark)
    found = repeated_passages(docs, s)
    kept = {name for name, at in s.latest.items() if os.path.exists(at.removeprefix("file:"))}
    assert kept == {"again", "covered", "chained", "ids", "texts"}
    assert found.count() > 0


def _chained_rows(spark, n):
    base, rng = _words(300, "v").split(), np.random.default_rng(5)
    rows = []
    for i in range(n):
        text = list(base)
        for k in rng.choice(300, 6, False):
            text[k] = f"own{i}x{k}"
        rows.append((i, " ".join(text)))
    s = _scratch(spark)
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), s).collect()
    assert len({r.doc_id for r in found}) >= n - 2
    return spark.read.parquet(s.latest["chained"]).count()


def test_chains_grow_with_the_texts_not_with_their_pairs(spark):
    few, many = _chained_rows(spark, 40), _chained_rows(spark, 160)
    assert many <= 4 * 1.5 * few


@pytest.mark.parametrize(("share", "least"), [(0.05, 0.95), (0.1, 0.9)])
def test_passages_with_changed_words(spark, share, least):
    rng, rows, n = np.random.default_rng(8), [], 60
    for k in range(n):
        first = _words(120, f"z{k}").split()
        second = [f"new{k}x{i}" if rng.random() < share else w for i, w in enumerate(first)]
        rows += [(2 * k, " ".join([_words(40, f"e{k}"), *first, _words(40, f"f{k}")])), (2 * k + 1, " ".join([_words(50, f"g{k}"), *second, _words(30, f"h{k}")]))]
    got = np.zeros(n)
    for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), _scratch(spark)).collect():
        got[r.doc_id // 2] += max(0, min(r.end_word, 170) - max(r.first_word, 50)) / 120
        assert r.first_word >= 48 and r.end_word <= 172
    assert np.mean(np.minimum(got, 1)) >= least


@pytest.mark.parametrize("total", range(7))
def test_batches_of_few_words(spark, total):
    """A table whose only text has ``total`` words, through all that cut words into shingles."""
    table = spark.createDataFrame([(1, " ".join("abcdefg"[:total]))], "doc_id long, text string")
    assert fingerprints(table, _scratch(spark)).count() == 1
    assert near_duplicates(table, _scratch(spark)).count() == 1
    assert repeated_passages(table, _scratch(spark)).count() == 0

"""Spelling variants against brute force: plain counting, all pairs by edit distance, and the bound on affected grams itself."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfweave.llm import spelling as parts
from shelfweave.llm.scratch import Scratch
from shelfweave.llm.spelling import Dictionary, near_words, spelling_variants

SCHEMA = "doc_id long, text string, word string, n long, form string, root string"


def _counts(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def _edits(word):
    """All that one letter left out makes of a word, with its place, and the word itself: two words are near if these meet."""
    return {(word[:i] + word[i + 1 :]) for i in range(len(word))}


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and a in _edits(b)


def _near(words):
    by_cut, near = {}, {w: set() for w in words}
    for w in words:
        for c in _edits(w) | {w}:
            by_cut.setdefault(c, []).append(w)
    for some in by_cut.values():
        for x in some:
            near[x] |= {y for y in some if y != x and _one_edit(x, y)}
    return near


def _plain(rows):
    n = _counts(rows)
    near = _near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def _sorted(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("least", [8, 1, 10**9])
def test_near_words_of_many_alike(spark, monkeypatch, least):
    monkeypatch.setattr(parts, "LEAST_FREQUENT", least)
    pick = random.Random(least)
    words = {"".join(pick.choice("abé") for _ in range(pick.randrange(5, 9))) for _ in range(1500)} | {"a" * k for k in range(5, 30)} | {"ab" * 40, "ab" * 40 + "a", "b" + "ab" * 40}
    words |= {"abcdefgh" * 200, "abcdefgh" * 100 + "x" + "abcdefgh" * 100}
    got = near_words(spark.createDataFrame([(w, 3) for w in words], "word string, n long").repartition(4), Scratch(spark, "t"))
    near = _near(words)
    assert {tuple(sorted((r["a"], r["b"]))) for r in got.collect()} == {tuple(sorted((x, y))) for x in near for y in near[x]}


def test_an_edit_affects_no_more_grams_than_the_bound():
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcd") for _ in range(pick.randrange(5, 14)))
    words = [word() for _ in range(400)]
    code = lambda w: next(parts._by_length([w]))[1]
    every = np.concatenate([parts._grams(code(w), q).ravel() for w in words for q in range(2, 6)])
    gram, n = np.unique(every, return_counts=True)
    for least in (3, 10, 40):
        d = Dictionary(gram[n > least], n[n > least])
        for w in words[:150]:
            g, end, kept = d.decompose(code(w))
            mine, most = Counter(g[kept].tolist()), int(d.affected(code(w), end, kept)[0])
            for i in range(len(w) + 1):
                for other in {w[:i] + c + w[i:] for c in "abcde"} | {w[:i] + c + w[i + 1 :] for c in "abcde" if i < len(w)} | {w[:i] + w[i + 1 :]}:
                    h, _, held = d.decompose(code(other))
                    assert sum((mine & Counter(h[held].tolist())).values()) >= kept.sum() - most


def test_variants_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert _sorted(spelling_variants(docs, Scratch(spark, "t"))) == _plain(rows)


def test_variants_of_odd_rows(spark):
    chain = " ".join(["colour"] * 24 + ["color"] * 12 + ["coler"] * 6 + ["colers"] * 3 + ["Straße", "STRAßE", "straße", "straÿe"] * 3 + ["ÀÉÎõü"] * 3)
    rows = [(1, chain), (1, chain), (2, None), (3, ""), (None, "wording wordings wording"), (None, "wording word5ing wörding"), (4, "a" * 3000 + " " + "a" * 2999), (5, "a" * 3000), (6, "a" * 3000 + " ×÷×÷× ×÷×÷× ×÷×÷×"), (7, " \n")]
    table = spark.createDataFrame([(*r, "w", 1, "f", "r") for r in rows], SCHEMA).repartition(3)
    want = _plain(rows)
    assert _sorted(spelling_variants(table, Scratch(spark, "t"))) == want and any(w[1] and w[2] != w[1] for w in want)
    assert _sorted(spelling_variants(table.limit(0), Scratch(spark, "t"))) == []


def test_near_words_share_a_list_also_where_an_edit_affects_all_grams(monkeypatch):
    monkeypatch.setattr(parts, "PAD", 1)
    pick = random.Random(9)
    words = sorted({"".join(pick.choice("ab") for _ in range(pick.randrange(5, 9))) for _ in range(300)})
    every = np.concatenate([parts._grams(code, q).ravel() for _, code in parts._by_length(words) for q in range(2, 5)])
    gram, n = np.unique(every, return_counts=True)
    on, weak = {w: set() for w in words}, set()
    for row, key, place, length in zip(*(x.tolist() for x in Dictionary(gram[n > 3], n[n > 3]).lists(words))):
        on[words[row]].add((key, place, length))
        weak |= {words[row]} if key < 0 else set()
    assert len(weak) > 50
    for a, others in _near(words).items():
        for b in others:
            if (len(a), a) < (len(b), b):
                further = {(k, p + d, len(b)) for k, p, size in on[a] if k > 0 for d in ((0, 1) if len(b) > len(a) else (0,))}
                assert (further | {x for x in on[a] if x[0] < 0}) & on[b]

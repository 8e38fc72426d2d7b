"""Operators on token ids and words against the public libraries and brute force, and on odd rows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shelfweave.llm import alignment as alignment_parts
from shelfweave.llm.alignment import aligned, alignment_digests, pack_postings, unpack_postings
from shelfweave.llm.bpe import ByteBpe, Known, decoded, encoded, encoding_digests
from shelfweave.llm.packing import Words, _tokens
from shelfweave.llm.scratch import Scratch
from shelfweave.llm.text import shingles, text_bytes, words

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
WORD = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, ids string, n long, word string, digest string"
LONG = " ".join(hashlib.md5(str(i).encode()).hexdigest()[: 2 + i % 9] for i in range(20000))
ODD = [(1, "Hello  world's 42 tests"), (2, "Hello  world's 42 tests"), (2, "other text"), (3, None), (4, ""), (None, "null id"), (None, None), (5, LONG), (6, "x<|endoftext|> y<|endoftext|>"), (7, " \n\t "),
       (8, "İstanbul ß ǅ 日本語 🙂👩‍👩‍👧 ՘֋ \u0085\x1c\x00"), (9, "a" * 3000), (10, "▁ under ▁▁bar"), (11, "one two"), (12, "  lead and trail  ")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "x", 1, "w", "d") for i, t in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _library(specials=True):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = not specials
    return t


def _strange(n):
    pick = random.Random(5)
    kinds = [lambda: pick.choice("aabcde \n'st<|>0é日̀🙂lre"), lambda: chr(pick.choice([pick.randrange(32, 127), pick.randrange(0x80, 0x600), pick.randrange(0x600, 0xD800), pick.randrange(0xE000, 0x30000)]))]
    return ["".join(pick.choice(kinds)() for _ in range(pick.randrange(60))) for _ in range(n)]


def test_ids_equal_those_of_the_library():
    texts = _strange(1500) + [t or "" for _, t in ODD]
    for specials in (True, False):
        ids, at = ByteBpe.of(BPE, specials).encode(texts)
        theirs = _library(specials).encode_batch(texts, add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [e.ids for e in theirs]


def test_word_ids_equal_those_of_the_library():
    from tokenizers import Tokenizer

    library, pick = Tokenizer.from_file(WORD), random.Random(6)
    kinds = ["<|endoftext|>", "<|ENDOFTEXT|>", "It's.", "'re.", "J\u030c", "T\u0308x", "Ä.", "ß,", "İ.", "x</w>", "\n", " ", ".", "!?", "'S", "7½", "(Word)", "…", "\u0338", "\x0b", "\xa0", "Kſ"]
    texts = _strange(1500) + ["".join(pick.choice(kinds[pick.randrange(3) :]) for _ in range(pick.randrange(30))) for _ in range(1500)] + [t or "" for _, t in ODD] + [None, LONG.upper()]
    for lo in range(0, len(texts), 7):  # few texts at a time, as those beside a special token are cut at blanks only
        ids, at = _tokens(WORD, *text_bytes(pa.array(texts[lo : lo + 7], pa.string())))
        theirs = library.encode_batch([t or "" for t in texts[lo : lo + 7]], add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [e.ids for e in theirs]


def test_words_that_differ_in_case_or_marks_are_one():
    found, first = Words.of(WORD).cut(*text_bytes(pa.array(["Word, word.\nWord (WORD)", None, "\t word! "], pa.string())))
    assert found.to_pylist() == ["word", ",", "word", ".", "word", "(", "word", ")", "word", "!"] and first.tolist() == [0, 8, 8, 10]


def test_words_end_at_digits_and_beside_latin_letters():
    from tokenizers import Tokenizer

    found, _ = Words.of(WORD).cut(*text_bytes(pa.array(["Mädchen, 12 mädchen(3×Ä)x7,ä", "é!É"], pa.string())))
    assert found.to_pylist() == ["mädchen", ",", "1", "2", "mädchen", "(", "3×Ä", ")", "x", "7", ",", "ä", "é", "!", "É"]
    library, pick = Tokenizer.from_file(WORD), random.Random(8)
    kinds = [*"äÉ×÷ßÀÿþç1907.,!<=>`^'aZ \n", "\u0301", "\u0338", "\u0327", "\u20e3", "'ll", "'D", "½", "²", "ſ", "Ö1", "\u0100", "\u00bf"]
    texts = ["".join(pick.choice(kinds) for _ in range(pick.randrange(25))) for _ in range(4000)]
    ids, at = _tokens(WORD, *text_bytes(pa.array(texts, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_full_cache_keeps_what_was_asked_for_just_then():
    asked = []

    def solve(pieces):
        asked.append(list(pieces))
        return np.array([ord(c) for p in pieces for c in p], np.int32), np.array([len(p) for p in pieces])

    known = Known(solve, {"fixed": 7}, 6)
    for batch in (["a", "bc", "fixed"], ["d", "ef", "g", "h"], ["bc", "h", "new", "fixed"], ["fixed", "bc", "h", "new"]):
        ids, at = known.ids(batch)
        assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == [[7] if p == "fixed" else [ord(c) for c in p] for p in batch]
    assert asked == [["a", "bc"], ["d", "ef", "g", "h"], ["new"]]


def test_vocabulary_tokens_stand_for_themselves():
    v = ByteBpe.of(BPE).vocabulary
    merged = v.usable[v.rank[v.usable] >= 0]
    assert len(merged) == 50_000
    assert v.follows(v.left[merged], v.right[merged]).sum() == 0  # the two halves of a token never stay apart


def _digests(rows):
    library, want = _library(), []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(want, key=str)


def test_encoding_of_documents_and_odd_rows(odd, none, docs):
    for table in (odd, none, docs):
        rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        assert sorted(map(tuple, encoding_digests(table, BPE).collect()), key=str) == _digests(rows)


def test_ids_decode_without_the_text(spark):
    rows = spark.createDataFrame([(1, b"\x00\xc4\x00\x00" + (50256).to_bytes(4, "little")), (2, None), (3, (127).to_bytes(4, "little"))], "doc_id long, ids binary")
    v = ByteBpe.of(BPE).vocabulary
    got = {r["doc_id"]: r["text"] for r in decoded(rows, BPE).collect()}
    assert got == {1: (v.bytes[50176] + b"<|endoftext|>").decode("utf-8", "replace"), 2: "", 3: v.bytes[127].decode("utf-8", "replace")}


def _plain_alignment(rows):
    """Token by token, with sets of documents for the counts."""
    import sentencepiece

    v, model = ByteBpe.of(BPE).vocabulary, sentencepiece.SentencePieceProcessor(model_file=PIECE)
    library, found, holds = _library(False), [], {}
    for row, (doc_id, text) in enumerate(rows):
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        b_bytes = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("\u2581", " ").encode() for i in b]
        if text and b"".join(b_bytes) != (" " + text).encode():
            a, b, b_bytes = [], [], []
        i = j = x = y = 0
        links, groups, now_a, now_b = [], [], [], []
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = x + len(v.bytes[a[i]]), y + len(b_bytes[j])
            if end_a <= end_b:
                now_a.append(a[i])
                i, x = i + 1, end_a
            if end_b <= end_a:
                now_b.append(b[j])
                j, y = j + 1, end_b
            if end_a == end_b:
                groups.append(",".join(map(str, now_a)) + "|" + ",".join(map(str, now_b)))
                now_a, now_b = [], []
        for pair in set(links):
            holds.setdefault(pair, set()).add(row)
        written = ";".join(groups)
        found.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(written.encode()).hexdigest() if written else ""))
    best = {}
    for (x, y), docs in holds.items():
        best[x] = max(best.get(x, 0), len(docs))
    out = [(i, na, nb, g, len(links), sum(len(holds[p]) == best[p[0]] for p in links), sum(len(holds[p]) for p in links), sha) for i, na, nb, g, links, sha in found]
    return sorted(out, key=str), {p: len(d) for p, d in holds.items()}


def test_alignment_of_documents_and_odd_rows(spark, odd, none, docs, monkeypatch):
    strange = spark.createDataFrame(list(enumerate(_strange(300))), "doc_id long, text string").repartition(4)
    for table, postings in ((odd, 500), (none, 500), (strange, 100), (docs, 4 << 20)):
        monkeypatch.setattr(alignment_parts, "BLOCK_POSTINGS", postings)
        rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        want, holds = _plain_alignment(rows)
        assert sorted(map(tuple, alignment_digests(table, BPE, PIECE, Scratch(spark, "t")).collect()), key=str) == want
        _, pairs = aligned(table, BPE, PIECE, Scratch(spark, "t"))
        assert {(r["a"], r["b"]): r["pair_docs"] for r in pairs.collect()} == holds
        assert sum(r["links"] for r in pairs.collect()) == sum(w[4] for w in want)


def test_written_groups_come_whole(spark):
    rows = spark.createDataFrame([(1, "unhappily wandering"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["groups"], r["groups_sha256"]) for r in aligned(rows, BPE, PIECE, Scratch(spark, "t"), keep_groups=True)[0].collect()}
    assert got[2] == ("", "") and hashlib.sha256(got[1][0].encode()).hexdigest() == got[1][1]


def test_postings_of_dense_pairs_and_high_numbers():
    pick = np.random.default_rng(3)
    key = np.concatenate([(p << 16) + np.sort(pick.choice(1 << 16, n, False)) for p, n in ((5, 1), (9, 4096), (11, 4097), (12, 65536), (70000, 9))])
    number = np.where(pick.random(len(key)) < 0.1, pick.integers(1, 5000, len(key)), 1)
    pair, count, links, docs, planes = pack_postings(key, number)
    row, low, times = unpack_postings(count, pa.array(docs, pa.binary()), pa.array(planes, pa.binary()))
    assert ((pair[row] << 16) + low == key).all() and (times == number).all() and links.sum() == number.sum()
    assert max(map(len, docs)) == 8192


def test_shingles_of_few_words():
    for n in range(7):
        data = " ".join("abcdefg"[:n]).encode()
        w = words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        value, doc, first = shingles(w)
        assert len(value) == (0 if n == 0 else max(1, n - 4)) and (doc == 0).all()

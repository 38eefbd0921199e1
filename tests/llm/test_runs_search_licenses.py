"""Periodic runs, lexical search and license scans against plain Python, and their odd cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.llm import lexical, licenses, queries, runs

LONG = "long text " * 20_000
ODD = [(1, "plain words here"), (1, "plain words here"), (2, None), (3, ""), (None, "no id"), (4, LONG), (5, "\n \t\n")]


# 11 periodic runs


def plain_runs(words):
    """(start, length, period) of every run, by looking at every period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def tile_runs(codes):
    """What solved tiles of one text add up to."""
    intervals = {}
    for first, last, start, boundaries, words in runs.tiles_of(np.array(codes, "int32")):
        solved = runs.solve_tile(np.frombuffer(words, "<i4").tolist(), boundaries, first, last)
        for q, own in solved.items():
            intervals.setdefault(q, []).extend((start + a, start + b) for a, b in own)
    found = []
    for q, own in intervals.items():
        whole = []
        for a, b in sorted(own):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(b, whole[-1][1])
            else:
                whole.append([a, b])
        found += [(a, b + q - a, q) for a, b in whole if b + q - a >= max(12, 2 * q)]
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.integers(0, 2), max_size=120),
    st.integers(1, 40),
    st.integers(0, 3),
    st.sampled_from([4, 16, 64, 4096]),
)
def test_tiles_find_every_run(codes, period, repeats, tile):
    codes = codes + (codes[-period:] * repeats)
    before, runs.TILE = runs.TILE, tile
    try:
        assert tile_runs(codes) == plain_runs(codes)
        assert runs.is_live(np.array(codes, "int32")) or not plain_runs(codes)
    finally:
        runs.TILE = before


def test_fibonacci_word_has_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    assert tile_runs(b) == plain_runs(b)


def dropped(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_odd_rows(spark, documents):
    dice = random.Random(5)
    rows = list(ODD)
    for k in range(10, 40):
        words = [dice.choice(["a", "b", "c", "é", "d e"]) for _ in range(dice.randrange(400))]
        at, period = dice.randrange(len(words) + 1), dice.randrange(1, 60)
        rows.append((k, "\n".join(words + words[at : at + period] * dice.randrange(5))))
    docs = documents(*rows).withColumn("runs", F.lit("clash")).withColumn("row_id", F.lit(1))
    got = runs.collapse(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        row = by_id[doc_id]
        expected = [(0, 40_000, 2)] if doc_id == 4 else plain_runs(words)
        assert row["n_words"] == len(words)
        assert [tuple(r) for r in row["runs"]] == expected
        assert row["collapsed"] == dropped(words, expected)
    digests = {r["doc_id"]: r["collapsed"] for r in runs.collapse(docs, hashed=True).collect()}
    assert digests == {k: hashlib.sha256(r["collapsed"].encode()).hexdigest() for k, r in by_id.items()}
    assert runs.collapse(documents().limit(0)).count() == 0


def test_runs_read_words_across_pieces(monkeypatch):
    monkeypatch.setattr(runs, "_PIECE", 7)
    text = "héllo wörld a bb ccc longer-than-a-piece".encode()
    assert [w for part in runs.words_of(text) for w in part] == text.split()
    assert runs._joined(text, False, [True, False, True, True, True, False]) == "héllo a bb ccc"
    expected = hashlib.sha256("héllo a bb ccc".encode()).hexdigest()
    assert runs._joined(text, True, [True, False, True, True, True, False]) == expected


# 12 lexical search


def plain_search(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def terms(text):
        return term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    counted = [(doc, Counter(terms(text))) for doc, text in docs]
    counted = [(doc, c) for doc, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    frequency = Counter(t for _, c in counted for t in c)
    found = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            m = 10 + 90 * c.total() * n_docs // n_terms
            score = 0
            for t in set(terms(text)):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1)))
                score += weight * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k])]
    return sorted(found, key=repr)


@pytest.mark.parametrize("block_postings", [250_000, 12])
def test_search_like_plain_python(spark, documents, block_postings):
    dice = random.Random(2)
    words = ["Alpha", "beta", "gamma", "ÉTÉ", "été", "x9", "k", "O'Neil", "plain", "words", "rare"]
    rows = list(ODD) + [(100 - k, " ".join(dice.choices(words, k=dice.randrange(1, 60)))) for k in range(60)]
    rows += [(200 - k, "rare rare copy") for k in range(30)]  # ties beyond k
    items = [(1, "Rare beta"), (1, "rare BETA"), (2, None), (3, "nothing shared"), (4, "été, alpha; alpha!"), (None, "k x9"), (5, "copy")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    got = lexical.search(documents(*rows).withColumn("score", F.lit("clash")), table, 10, block_postings).collect()
    assert sorted(map(tuple, got), key=repr) == plain_search(rows, items, 10)


def test_search_in_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(documents().limit(0), items).count() == 0
    assert lexical.search(documents((1, "a")), items.limit(0)).count() == 0


def test_terms_across_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "_PIECE", 8)
    text = "Ab-cd averyveryverylongterm, é1é x y z z"
    assert lexical.term_counts(text.encode()) == Counter(w.encode() for w in text.lower().replace("-", " ").replace(",", " ").split())


def test_heaps_keep_the_smaller_id_of_equal_scores():
    heaps = lexical.Heaps(1, 2)
    for docs in ([5, 9], [7, 3], [4]):
        heaps.add(np.full((len(docs), 1), 8, "int64"), np.array(docs, "int64"), np.ones(len(docs), bool))
    assert sorted(-d for _, d, _ in heaps.heaps[0]) == [3, 4]


# 13 license scans


def test_notices_with_edits(spark, documents):
    mit = next(text for label, text in licenses.TEMPLATES if label == "mit" and len(text) > 100)
    words = mit.split()
    edited = " ".join([*words[:30], "and", "also", *words[30:60], *words[62:]])
    docs = documents(
        *ODD,
        (10, "Intro here. " + edited + " The end."),
        (11, "Intro " + " ".join(words[:20])),  # too little of it
        (12, "MIT License, again: mit-license. Licensed under CC BY-NC 4.0."),
        (13, " ".join(random.Random(1).sample(words, len(words)))),
        (14, "Released under the MIT License. " + "filler " * 50 + "Released under the MIT License."),
    ).withColumn("labels", F.lit("clash"))
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(ODD) + 5
    got = {r["doc_id"]: r for r in rows}
    (notice,) = got[10]["notices"]
    assert (notice["label"], notice["first_word"]) == ("mit", 2)
    assert notice["covered"] > 0.9 and got[10]["score"] == notice["covered"]
    assert got[11]["labels"] == got[13]["labels"] == []
    assert got[12]["base_labels"] == ["cc-by", "mit"]
    assert got[12]["labels"] == ["cc-by", "cc-by-nc", "mit"]
    assert [p["at"] for p in sorted(got[12]["places"])] == [0, 3, 7]
    assert [n["first_word"] for n in got[14]["notices"]] == [0, 55]
    for k in (1, 2, 3, 4, 5, None):
        assert (got[k]["labels"], got[k]["score"]) == ([], 0.0)
    assert got[4]["n_words"] == 40_000
    assert licenses.scan(documents().limit(0)).count() == 0
    assert {r["score"] for r in licenses.scan(documents((1, "MIT license")), templates=[]).collect()} == {0.5}


def test_licenses_use_no_python(spark):
    plan = queries.op13_licenses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(sign in plan for sign in ("Python", "Pandas", "Arrow", "ExistingRDD"))

"""Every stage of the pipeline against plain Python, on rows with nulls, repeats, copies, long texts and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import corpus_pipeline
from tripmill.llm import common, queries, secrets, toxicity

FOLDER = f"{TESTDATA}/sf0.001"
COLUMNS = corpus_pipeline.COLUMNS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of the smallest tables with odd rows added, and a column whose name the operators use."""
    path = tmp_path_factory.mktemp("pipeline")
    docs = common.read_table(spark, FOLDER, "documents")
    dice = random.Random(9)
    words = [f"word{k}" for k in range(400)]
    body = " ".join(words[:120])
    near = " ".join([*words[:50], "edit", *words[51:120]])
    secret = "".join(dice.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=40))
    odd = [
        (9001, body, "en", "a", None), (9002, near, "en", "b", 1), (9003, body, "en", None, 2), (9001, body, "en", "a", 3),
        (9004, None, "en", "a", None), (9005, "", None, "b", 0), (None, "no id here " * 30, "en", "a", 4),
        (9006, f"{' '.join(words[200:240])} password = hunter2hunter2 and key {secret} end", "en", "c", 5),
        (9007, " ".join(dice.choices(words, k=9000)), "en", "c", 6),
    ]
    table = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("bin", F.lit("clash"))
    table.write.parquet(str(path / "documents.parquet"))
    common.read_table(spark, FOLDER, "labels").write.parquet(str(path / "labels.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What goes into each stage and what comes out."""
    docs = common.read_table(spark, folder, "documents")
    found = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(spark, docs, folder), f"test-{name}")
        found[name] = docs
    return found


def rows(df, columns=COLUMNS):
    return Counter(map(tuple, df.select(*columns).collect()))


def best_segment(scores, low, high):
    """The contiguous part of largest sum, the longest first one of several, by looking at all."""
    best = None
    for a in range(low, high):
        total = 0.0
        for b in range(a, high):
            total += scores[b]
            if total > 1e-12 and (best is None or total > best[2] + 1e-9):
                best = (a, b + 1, total)
    return best


def all_segments(scores, low, high):
    best = best_segment(scores, low, high)
    if best is None:
        return []
    return [*all_segments(scores, low, best[0]), best, *all_segments(scores, best[1], high)]


def plain_score(model, text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    scores = [model.token_score(w) for w in words]
    # Segments lie between stretches whose tokens score nothing but the cost.
    hits = [i for i, s in enumerate(scores) if s > 0]
    found, at = [], 0
    while at < len(hits):
        low, reach, end = hits[at], scores[hits[at]], at
        while end + 1 < len(hits) and sum(scores[low : hits[end + 1]]) > 0:
            end += 1
        found += all_segments(scores, low, hits[end] + 1)
        at = end + 1
    n = max(1, len(words))
    expected = [math.log(model.k * n) - model.lam * s for _, _, s in found]
    evidence = min(60.0, sum(-e for e in expected if e < math.log(0.5)))
    # Without a passage a document is not rejected, whatever the share of toxic labels.
    return 1 / (1 + math.exp(-(model.intercept + model.slope * evidence))) if evidence > 0 else 0.0


def test_toxicity(spark, folder, stages):
    model = toxicity.train(stages["input"], common.read_table(spark, folder, "labels"))
    expected = Counter()
    for row in stages["input"].select(*COLUMNS).collect():
        if plain_score(model, row["text"]) < 0.3:
            expected[tuple(row)] += 1
    assert rows(stages["toxicity"]) == expected
    # The model has words to reject by, and a document full of them goes.
    worst = " ".join(max(model.scores, key=model.scores.get).lstrip("^") for _ in range(200)) if model.scores else ""
    assert not worst or plain_score(model, worst) >= 0.3


def test_near_copies(stages):
    given = [tuple(r) for r in stages["toxicity"].select(*COLUMNS).collect()]

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(r[1]) for r in given]
    parent = list(range(len(given)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(given)):
        for j in range(i):
            same = (given[i][1] or "") == (given[j][1] or "")
            if same or sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, row in enumerate(given):
        groups.setdefault(root(i), []).append(row)
    kept = rows(stages["near_copies"])
    assert sum(kept.values()) == len(groups)
    for group in groups.values():
        first = min((r[0] for r in group if r[0] is not None), default=None)
        assert sum(kept[r] for r in set(group)) == 1
        assert any(kept[r] and r[0] == first for r in group)


def test_secrets(stages):
    detector = secrets.train(stages["near_copies"])
    given = {r["doc_id"]: r for r in stages["near_copies"].collect()}
    out = {r["doc_id"]: r for r in stages["secrets"].collect()}
    assert given.keys() == out.keys()
    for doc_id, row in given.items():
        text = row["text"]
        if text is None:
            assert out[doc_id]["text"] is None
            continue
        marks = [False] * len(text)
        starts = set()
        for start, end, _ in sorted(detector.spans(text)):
            if not (start and marks[start - 1]) and not marks[start]:
                starts.add(start)
            marks[start:end] = [True] * (end - start)
        covered = "".join("[secret]" if i in starts else "" if marks[i] else c for i, c in enumerate(text))
        assert out[doc_id]["text"] == covered
        assert out[doc_id]["n_chars"] == len(covered)
        for kind, (pattern, group, least) in secrets.RULES.items():
            assert not [m for m in pattern.finditer(covered) if len(m[group]) >= least and "[secret]" not in m[0]], kind
    assert "hunter2" not in out[9006]["text"]
    assert out[9006]["text"].endswith("and key [secret] end")


def test_mixing(stages, tmp_path):
    given = str(tmp_path / "given")
    stages["secrets"].write.parquet(given)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{given}/*.parquet')")
    expected = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({queries.OP7_SQL})").fetchall()
    # SQL hashes no null id.
    assert rows(stages["mixing"].filter("doc_id IS NOT NULL")) == Counter(expected)


def test_packing(stages):
    packed = stages["packing"].collect()
    texts = Counter()
    pieces = {}
    bins = {}
    for r in packed:
        bins.setdefault(r["bin"], []).append(r)
        if r["start"] == 0 and r["length"] == len(r["text"] or "") and r["length"] < queries.BIN_CHARS:
            texts[r["doc_id"], r["text"]] += 1
        else:
            pieces.setdefault(r["doc_id"], []).append((r["start"], r["text"]))
    given = Counter((r["doc_id"], r["text"]) for r in stages["mixing"].collect())
    # Texts in pieces come together again, once for each copy.
    for (doc_id, text), copies in given.items():
        if len(text or "") >= queries.BIN_CHARS:
            cut = [(k, text[k : k + queries.BIN_CHARS]) for k in range(0, len(text), queries.BIN_CHARS)]
            assert Counter(pieces[doc_id]) == Counter(cut * copies)
        else:
            assert texts[doc_id, text] == copies
    for own in bins.values():
        assert sum(r["length"] for r in own) == own[0]["bin_used"] <= queries.BIN_CHARS
        for name in ("source", "text"):
            values = [hashlib.md5(r[name].encode()).digest() for r in own if r[name] is not None]
            assert len(values) == len(set(values)) or name == "text" and len(own) == 1
    assert sum(given.values()) == sum(1 for r in packed if r["start"] == 0)


def test_run_is_its_stages(spark, folder, stages):
    got = corpus_pipeline.run(spark, folder)
    assert rows(got, ["doc_id", "text", "start", "length"]) == rows(stages["packing"], ["doc_id", "text", "start", "length"])


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        common.read_table(spark, FOLDER, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_labels_without_signal_reject_nothing_by_themselves(spark, folder, tmp_path):
    """Where words say nothing about labels, a document is not rejected for the share of toxic ones alone."""
    docs = common.read_table(spark, folder, "documents")
    labels = docs.select("doc_id").dropna().distinct().withColumn("toxic", (F.xxhash64("doc_id") % 2 == 0).cast("int"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert kept.count() > 0.9 * docs.count()

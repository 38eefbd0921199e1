"""Queries against their SQL, and against brute force where SQL cannot express them."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from conftest import TESTDATA

import __spark_entry__ as entries
import corpus_pipeline
from oracle import check
from tripmill.llm import common, queries

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return common.read_table(spark, FOLDER, "documents").toPandas()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = check.connect(FOLDER)
    assert check.differences(spark, con, queries.queries()[name], FOLDER, queries.oracle_sql()[name]) == ""


def test_registered():
    names = entries.queries()
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run


def test_jaccard_join(spark, docs):
    got = queries.op2_jaccard_join(spark, FOLDER).toPandas()
    sets = {}
    for doc_id, text in zip(docs["doc_id"], docs["text"]):
        words = text.lower().split()
        sets[doc_id] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    owners = defaultdict(list)
    for doc_id, own in sets.items():
        for shingle in own:
            owners[shingle].append(doc_id)
    shared = Counter(p for own in owners.values() for p in combinations(own, 2))
    texts = dict(zip(docs["doc_id"], docs["text"]))
    parent = {d: d for d in texts}
    partners = defaultdict(set)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            parent[max(root(a), root(b))] = min(root(a), root(b))
            if texts[a] != texts[b]:
                partners[a].add(texts[b])
                partners[b].add(texts[a])
    assert len(got) == len(docs)
    assert {d: root(d) for d in texts} == dict(zip(got["doc_id"], got["class_id"]))
    assert {d: len(partners[d]) for d in texts} == dict(zip(got["doc_id"], got["n_links"]))


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def test_secrets(spark, docs):
    got = queries.op3_secrets(spark, FOLDER).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for doc_id, text in zip(docs["doc_id"], docs["text"]):
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        kinds = ["assign", "access", "hex"]
        joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))
        row = got.loc[doc_id]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(k == x for _, k, _ in spans) for x in range(3)]
        assert set(joined.split(",")) - {""} <= set(row["spans"].split(","))


def test_token_files(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.WORD_TOKENIZER))
    got = queries.op4_token_files(spark, FOLDER).toPandas().sort_values("doc_id")
    start = 0
    for row, text in zip(got.itertuples(), docs.sort_values("doc_id")["text"]):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_toxicity_on_held_out_labels(spark):
    folder = f"{TESTDATA}/sf0.1"
    labels = common.read_table(spark, folder, "labels").select("doc_id", "toxic")
    got = queries.op5_toxicity(spark, folder)
    assert got.count() == common.read_table(spark, folder, "documents").count()
    measured = got.join(labels, "doc_id").filter("held_out").toPandas()
    hit = ((measured["predicted"] == 1) & (measured["toxic"] == 1)).sum()
    assert hit / (measured["predicted"] == 1).sum() > 0.85
    assert hit / (measured["toxic"] == 1).sum() > 0.85
    crc = measured["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 4)
    assert (crc == 2).all()


def test_packing(spark, docs):
    got = queries.op6_packing(spark, FOLDER).toPandas()
    lengths = dict(zip(docs["doc_id"], docs["text"].str.len()))
    assert got.groupby("doc_id")["length"].sum().to_dict() == lengths
    assert not got.duplicated(["bin", "source"]).any()
    assert not got.duplicated(["bin", "cluster"]).any()
    bins = got.groupby("bin")
    assert (bins["length"].sum() == bins["bin_used"].first()).all()
    assert got["bin_used"].max() <= queries.BIN_CHARS


def test_packing_keeps_near_copies_apart(spark, tmp_path):
    """Near copies of different sources share no bin, texts without relatives do."""
    words = [f"word{k}" for k in range(100)]
    near = [" ".join([*words[:k], "edit", *words[k + 1 :]]) for k in (0, 30, 99)]
    rows = [(k, text, f"near{k}") for k, text in enumerate([" ".join(words), *near])]
    rows += [(10 + k, " ".join(f"other{k}x{i}" for i in range(100)), f"alone{k}") for k in range(4)]
    rows += [(20, None, "null0"), (21, None, "null1")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op6_packing(spark, str(tmp_path)).toPandas()
    assert len(got) == len(rows)
    copies = got[got["doc_id"] < 10]
    assert copies["bin"].nunique() == 4
    assert copies["cluster"].nunique() == 1
    assert got[got["doc_id"].between(10, 13)]["bin"].nunique() == 1
    assert got[got["doc_id"] >= 20]["cluster"].isna().all()


def test_pipeline(spark):
    folder = f"{TESTDATA}/sf0.01"
    kept = docs = common.read_table(spark, folder, "documents")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = common.stage(stage(spark, before, folder), name)
        counts.append(kept.count())
        if name != "packing":
            assert kept.columns == docs.columns
    toxic, first, redacted, mixed, packed = counts
    assert docs.count() > toxic > first == redacted
    assert mixed > 0
    assert packed >= mixed
    assert corpus_pipeline.run(spark, folder).count() == packed

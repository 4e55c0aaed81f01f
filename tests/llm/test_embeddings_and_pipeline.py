"""Embedding near duplicates and the corpus pipeline."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pytest
from llm.frames import ROWS, documents

from monthloom.llm import embedding_duplicates, toxicity
from monthloom.llm.common import components

KIND = "vec_id long, embedding array<float>, label int, unit string, cid long, n_links string"


def _brute(rows):
    ok = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    cos = lambda a, b: np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b))
    vectors = {k: np.array(rows[k][1], np.float32).astype(float) for k in ok}
    near = {k: [j for j in ok if j != k and len(vectors[j]) == len(vectors[k]) and cos(vectors[j], vectors[k]) >= 0.95] for k in ok}
    out = []
    for k, (i, _) in enumerate(rows):
        seen, open_ = {k}, [k]
        while open_:
            new = [j for j in near.get(open_.pop(), []) if j not in seen]
            seen.update(new)
            open_ += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((i, len(near.get(k, [])), min(ids) if i is not None else None))
    return sorted(out, key=str)


def _found(spark, rows):
    frame = spark.createDataFrame([(i, v, 1, "u", 5, "n") for i, v in rows], KIND)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_duplicates.near_duplicates(frame).collect()), key=str)


def test_groups_copies_and_odd_vectors(spark):
    dice = np.random.default_rng(3)
    rows = [(k, dice.standard_normal(16).tolist()) for k in range(300)]
    center = dice.standard_normal(16)
    rows += [(300 + k, (center + dice.standard_normal(16) * 0.15).tolist()) for k in range(350)]
    rows += [(700 + k, [2.0 * x for x in rows[4][1]]) for k in range(40)]
    rows += [(800, None), (801, []), (802, [0.0] * 16), (803, [1.0] * 15 + [None]), (804, [float("nan")] * 16), (805, [float("inf")] + [1.0] * 15)]
    rows += [(806, [1.0, 0.0]), (807, [1.0, 0.1]), (1, rows[1][1]), (None, rows[2][1])]
    assert _found(spark, rows) == _brute(rows)


def test_links_between_clumps_whose_lists_are_saturated(spark):
    dice = np.random.default_rng(17)
    side, noise = np.eye(64)[:2], lambda: dice.standard_normal(64) * np.sqrt(0.0101 / 64)
    centers = [side[0], 0.9697 * side[0] + np.sqrt(1 - 0.9697**2) * side[1]]
    rows = [(100 * c + k, (centers[c] + noise()).tolist()) for c in range(2) for k in range(60)]
    expected = _brute(rows)
    assert min(n for _, n, _ in expected) > 100 and {c for _, _, c in expected} == {0}
    assert _found(spark, rows) == expected


def test_recall_on_scattered_pairs(spark):
    dice = np.random.default_rng(9)
    rows = []
    for k in range(700):
        v = dice.standard_normal(32)
        rows += [(2 * k, v.tolist()), (2 * k + 1, (v + dice.standard_normal(32) * 0.2).tolist())]
    links = sum(n for _, n, _ in _found(spark, rows))
    assert links >= 0.95 * sum(n for _, n, _ in _brute(rows))
    assert _found(spark, []) == []


def test_audit_weighs_vectors_alike_and_guards_the_last_try(spark, monkeypatch):
    dice = np.random.default_rng(23)
    unit = lambda v: embedding_duplicates.unit(v.tolist())
    rows = [(k, 1, unit(np.eye(32)[0] + 0.001 * dice.standard_normal(32))) for k in range(100)]
    for k in range(10):
        v = dice.standard_normal(32)
        rows += [(100 + 2 * k, 1, unit(v)), (101 + 2 * k, 1, unit(v + 0.01 * dice.standard_normal(32)))]
    classes = spark.createDataFrame(rows, "cid long, copies long, unit binary")
    found = spark.createDataFrame([(k, 99) for k in range(100)], "cid long, links long")
    assert np.isclose(embedding_duplicates.audit(classes, found), 100 / 120)
    monkeypatch.setattr(embedding_duplicates, "TRIES", 1)
    monkeypatch.setattr(embedding_duplicates, "audit", lambda classes, found: 0.5)
    with pytest.raises(RuntimeError, match="recall"):
        _found(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])])


def test_trees_grow_with_their_depth():
    for n in (10**3, 10**6, 10**9):
        bits = embedding_duplicates.bits_for(n)
        same = (1 - np.arccos(0.95) / np.pi) ** bits
        assert 1 - (1 - same) ** embedding_duplicates.trees_for(bits) >= 0.99


def test_components(spark):
    chain = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (101, 102), (7, 7), (200, 100)] + [(500, k) for k in range(501, 700)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert set(found) == {*range(1, 61), 100, 101, 102, 200, *range(500, 700)}
    assert all(c == (1 if i < 61 else 100 if i < 201 else 500) for i, c in found.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    spark.createDataFrame([(1, 0), (9, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "only three words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    clean = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert clean.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(r["doc_id"] for r in clean.collect() if r["doc_id"]) == [1, 2, 3, 4, 7, 9, 11, 12]
    judged = corpus_pipeline.decontaminate(spark, clean, str(tmp_path))
    assert sorted(r["doc_id"] for r in judged.collect() if r["doc_id"]) == [1, 2, 3, 4, 7, 11, 12]
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} <= {i for i, _, _, _ in ROWS}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_output"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
    assert empty.count() == 0


def test_toxic_stage_drops_what_is_toxic(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.toxic(spark, docs, folder).select("doc_id").collect()}
    judged = toxicity.score_toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert kept == {r["doc_id"] for r in judged if not r["predicted"]}

"""The registered queries on the smallest tables against plain versions of what their contracts ask for."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from arborlog.llm import secret_scan
from tests.llm.test_text_operators import plain_components, plain_fingerprint, plain_ids, plain_simhash, plain_spans, words_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall())


def run(spark, name):
    return contract.queries()[name](spark, SMALL).toPandas()


def by_doc(frame):
    return {r.doc_id: r for r in frame.itertuples()}


def test_every_operator_has_one_query():
    names = list(contract.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_op1(spark):
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in table]), np.array([r[1] for r in table], np.float64)
    out = run(spark, "op1_prefix_forest")
    hits = 0
    for q in np.flatnonzero(ids % 100 == 0):
        apart = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        apart[q] = np.inf
        own = out[out.query_id == ids[q]].sort_values("rank")
        at = np.searchsorted(ids, own.vec_id)
        assert own["rank"].tolist() == list(range(1, 11)) and np.allclose(apart[at], own.score, rtol=1e-14)
        assert sorted(zip(own.score, own.vec_id)) == list(zip(own.score, own.vec_id))
        hits += len(set(own.vec_id) & set(ids[np.lexsort((ids, apart))[:10]]))
    assert hits >= 0.9 * len(out)


def test_op1_leaves_out_unusable_vectors(spark):
    from arborlog.llm.prefix_forest import nearest

    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i), 1.0]) for i in range(1, 8)] + [(8, None), (9, [0.0, 0.0]), (10, [nan, 1.0]), (11, [None, 1.0]), (12, [inf, 1.0])]
    rows += [(13, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (2, [2.0, 1.0]), (14, [2.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = defaultdict(list)
    for r in sorted(nearest(table, table.filter("vec_id IN (2, 9, 13, 14)"), k=3, shard_rows=4).collect()):
        out[r.query_id].append((r.vec_id, r.score))
    assert dict(out) == {2: [(14, 0.0), (1, 1.0), (3, 1.0)], 14: [(2, 0.0), (1, 1.0), (3, 1.0)]}


def test_op2(spark, texts):
    found = run(spark, "op2_chunk_dedup")

    def sharing(n):
        held = defaultdict(set)
        for i, t in texts.items():
            w = t.split()
            for k in range(len(w) - n + 1):
                held[" ".join(w[k : k + n])].add(i)
        return set().union(*(s for s in held.values() if len(s) > 1))

    # A short text has a row if another document is its exact copy.
    copies = defaultdict(set)
    for i, t in texts.items():
        copies[t].add(i)
    whole = set().union(*(s for t, s in copies.items() if len(s) > 1 and t.split()))
    assert sharing(51) | whole <= set(found.doc_id) <= sharing(12) | whole
    for r in found.itertuples():
        assert texts[r.doc_id][r.start : r.end] in texts[r.first_doc_id]


def test_op3(spark, texts):
    out = run(spark, "op3_hilbert_packing").sort_values(["sequence_id", "offset"])
    for _, own in out.groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
    filled = out.groupby("sequence_id").length.sum()
    assert (filled.iloc[:-1] == 2048).all()
    seen = set()
    for doc_id, own in out.sort_values("start").groupby("doc_id"):
        ids, at = np.array(plain_ids(texts[doc_id], 1), "<u4"), 0
        for r in own.itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
        seen.add(doc_id)
    assert seen == set(texts)


def test_op4(spark, texts):
    out, ids = by_doc(run(spark, "op4_simhash_fingerprints")), list(texts)
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert set(out) == set(ids)
    for k, i in enumerate(ids):
        after, text = ids[(k + 1) % len(ids)], texts[i]
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        r, fp = out[i], plain_fingerprint(edited)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (f"{fps[i]:016x}", f"{fp:016x}")
        assert (r.near_edited, r.near_next) == (1 - (fps[i] ^ fp).bit_count() / 64, 1 - (fps[i] ^ fps[after]).bit_count() / 64)
        if i % 50:
            assert np.isnan(r.n_near)
        else:
            assert r.n_near == sum((fps[i] ^ other).bit_count() <= 3 for other in fps.values()) - 1


def test_op5_and_op6_on_held_out_rows(spark):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SMALL}/documents.parquet'").fetchall())
    out = run(spark, "op5_rank_order_language")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out.itertuples())
    held = out[out.held_out]
    assert len(out) == len(langs) and np.mean([langs[r.doc_id] == r.lang_pred for r in held.itertuples()]) > 0.95
    out = run(spark, "op6_toxic_instances")
    assert len(out) == len(langs) and ((out.score >= 0) & (out.score <= 1)).all() and ((out.score >= 0.3) == out.predicted).all()


def test_op7(spark, texts):
    out = by_doc(run(spark, "op7_secret_ownership"))
    for i, t in texts.items():
        base = plain_spans(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [getattr(out[i], f"n_{k}") for k in secret_scan.KINDS] == [sum(s[0] == k for s in base) for k in secret_scan.KINDS]
        assert out[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(out[i].spans.split(","))


def test_op8_against_its_sql(spark):
    from checks.compare import connect, differences

    assert differences(contract.queries()["op8_systematic_mix"](spark, SMALL), connect(SMALL), contract.oracle_sql()["op8_systematic_mix"]) == []


def test_op9(spark, texts):
    out, ids = by_doc(run(spark, "op9_simhash_bktree")), list(texts)
    fps = [plain_simhash(texts[i]) for i in ids]
    roots = plain_components(fps, 2)
    assert all((out[i].fingerprint, out[i].component_id) == (f"{fps[k]:016x}", ids[roots[k]]) for k, i in enumerate(ids))


def test_op10(spark, texts):
    out, start = by_doc(run(spark, "op10_rans_blocks")), 0
    for i, t in texts.items():
        ids = np.array(plain_ids(t, 2), "<u4")
        assert (out[i].start, out[i].n_tokens, out[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(out) == len(texts)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SMALL).cache())
        if name != "packing":
            assert tables[-1].columns == docs.columns
    start, clean, single, masked, mixed = [{r.doc_id: r for r in t.collect()} for t in tables[:5]]
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SMALL}/labels.parquet'").fetchall())
    gone = set(start) - set(clean)
    # A small table teaches little; what goes is mostly toxic, and clean documents stay.
    assert sum(labels.get(i) == 0 for i in gone) <= 0.02 * len(start)
    ids = sorted(clean)
    roots = plain_components([plain_simhash(clean[i].text) for i in ids], 2)
    assert set(single) == {ids[k] for k in set(roots)}
    assert set(masked) == set(single)
    for i, r in masked.items():
        values = [t for t in (single[i].text[a:b] for _, a, b in plain_spans(single[i].text))]
        assert r.text == single[i].text or (values and "[SECRET]" in r.text and r.n_chars == len(r.text))
    taken = defaultdict(int)
    for r in tables[4].select("doc_id").collect():
        taken[r.doc_id] += 1
    assert set(taken) <= set(masked) and max(taken.values()) <= 2
    sizes = {i: len(words_of(r.text)) for i, r in masked.items()}
    total = sum(sizes.values())
    assert abs(sum(sizes[i] * n for i, n in taken.items()) - 1.5 * total) <= 0.2 * total
    want = sum(n * len(plain_ids(masked[i].text, 1)) for i, n in taken.items())
    assert tables[5].selectExpr("sum(length)").first()[0] == want
    for t in tables[1:]:
        t.unpersist()

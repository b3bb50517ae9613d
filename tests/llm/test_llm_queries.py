"""Queries of the operators over given tables, against SQL or plain Python."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from tests.llm.test_llm_operators import PATH, linked, plain_groups
from tideline.llm import simhash, toxicity
from tideline.llm.queries import QUERIES, SQL

DATA = os.environ.get("TIDELINE_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{DATA}/documents.parquet")


def rows(spark, name):
    return QUERIES[name](spark, DATA).toPandas()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got, want = rows(spark, name), connection.execute(SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    as_set = lambda f: Counter(map(tuple, f[columns].astype(str).to_numpy().tolist()))
    assert as_set(got) == as_set(want)


def ids_of(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids for r in docs.itertuples()}


def test_bpe(spark, docs):
    out = rows(spark, "op3_bpe_round_trip").set_index("doc_id")
    for doc, ids in ids_of(docs).items():
        assert out.n_tokens[doc] == len(ids)
        assert out.ids_sha256[doc] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    for r in docs.itertuples():
        assert out.decoded_sha256[r.doc_id] == hashlib.sha256((r.text or "").encode()).hexdigest()


def check_pieces(out, ids):
    assert out.sequence_id.is_unique and set(out.doc_id) == set(ids)
    for doc, part in out.groupby("doc_id"):
        whole, at = [*ids[doc], 1], 0
        for r in part.sort_values("start").itertuples():
            assert (r.start, r.doc_tokens, r.offset) == (at, len(whole), 0) and r.length & (r.length - 1) == 0
            assert r.ids_crc32 == zlib.crc32(np.array(whole[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(whole)


def test_packing(spark, docs):
    check_pieces(rows(spark, "op9_packing"), ids_of(docs))


def test_simhash(spark, docs):
    out = rows(spark, "op7_simhash").set_index("doc_id")
    fps = [simhash.fingerprint_of(t) for t in docs.text]
    roots = linked(fps)
    for k, doc in enumerate(docs.doc_id):
        assert out.fingerprint[doc] == f"{fps[k]:016x}"
        assert out.component_id[doc] == min(d for d, r in zip(docs.doc_id, roots, strict=True) if r == roots[k])


def statistics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    again = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return [len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again)]


def test_quality(spark, docs):
    out = rows(spark, "op10_quality_rules").set_index("doc_id")
    for r in docs.itertuples():
        want = statistics(r.text)
        got = out.loc[r.doc_id]
        assert got[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]].tolist() == want
        assert got.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got.kept and got.base_failed)


def test_languages(spark, docs):
    out = rows(spark, "op8_language").set_index("doc_id")
    truth = docs.set_index("doc_id").lang
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.index]).all()
    held = out[out.held_out]
    assert (held.lang_pred == truth[held.index]).mean() > 0.97


def test_toxic_folds(spark):
    out = rows(spark, "op5_toxicity")
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]).all()
    assert (out.predicted == (out.score >= toxicity.THRESHOLD)).all() and out.score.between(0, 1).all()


def test_urls(spark):
    pages = pd.read_parquet(f"{DATA}/pages.parquet")
    out = rows(spark, "op1_url_rules").set_index("page_id")
    assert len(out) == len(pages) and set(out.verdict) <= {"allow", "block"}
    for r in pages.itertuples():
        m = re.search(r"://([^/?#]*)([^?#]*)", r.url or "")
        assert (out.host[r.page_id], out.path[r.page_id]) == ((m[1].lower(), m[2]) if m else ("", ""))


def test_rollup(spark, docs):
    labels = pd.read_parquet(f"{DATA}/labels.parquet")
    toxic = set(labels[labels.toxic == 1].doc_id)
    cleaned = docs.assign(text=[re.sub(r"[#*$%&|<>]+", "", t or "") for t in docs.text])
    want = defaultdict(lambda: [0, 0])
    for doc, ids in ids_of(cleaned).items():
        if doc not in toxic:
            row = docs[docs.doc_id == doc].iloc[0]
            want[row.source, row.lang][0] += 1
            want[row.source, row.lang][1] += len(ids)
    out = rows(spark, "op6_token_rollup")
    assert {(r.source, r.lang): [r.documents, r.tokens] for r in out.itertuples()} == dict(want)


def test_pipeline_stages(spark, docs):
    """Each stage against plain Python on what it was given."""
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    results = []
    for name, stage in corpus_pipeline.STAGES:
        before = frame.toPandas()
        frame = stage(spark, frame, DATA).checkpoint()
        results.append((name, before, frame.toPandas()))
    (_, given, toxic), (_, _, good), (_, _, single), (_, _, far), (_, _, pieces) = results
    for _, _, out in results[:4]:
        assert list(out.columns) == list(docs.columns)
    assert set(toxic.doc_id) <= set(given.doc_id) and len(toxic) > 0.8 * len(given)
    for r in good.itertuples():
        n = statistics(r.text)
        assert n[0] >= 50 and 100 * n[4] <= 50 * n[0]
    want = plain_groups([(r.doc_id, r.text) for r in good.itertuples()])
    assert sorted(single.doc_id) == sorted(k[0] for k in want if k[3])
    roots = linked([simhash.fingerprint_of(t) for t in single.text])
    firsts = [min(d for d, r in zip(single.doc_id, roots, strict=True) if r == k) for k in set(roots)]
    assert sorted(far.doc_id) == sorted(firsts)
    check_pieces(pieces, ids_of(far))

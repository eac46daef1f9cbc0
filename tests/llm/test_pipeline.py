"""run() against a plain re-computation of its stages, and its contract."""

import re
import zlib

import duckdb
import numpy as np

import corpus_pipeline
from cadence.llm import mixing, toxicity
from tests.llm.test_text_ops import path, slow_classes, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_run_against_plain_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    # the classifier's own verdicts (its accuracy has tests of its own)
    model = toxicity.train(toxicity.labelled_sample(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    kept = {i: r for i, r in rows.items() if model.score(r["text"] or "") < toxicity.THRESHOLD}
    assert 0 < len(kept) < len(rows)
    # one of each group
    classes = slow_classes({i: slow_fingerprint(r["text"]) for i, r in kept.items()})
    kept = {i: r for i, r in kept.items() if classes[i] == i}
    # no eight words in a row of a benchmark item
    words = lambda t: re.findall(r"\S+", t or "")
    runs = lambda w: {tuple(w[j : j + 8]) for j in range(len(w) - 7)}
    bench = set().union(*[runs(words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    clean = {i: r for i, r in kept.items() if not runs(words(r["text"])) & bench}
    assert len(clean) < len(kept)
    # mixing by its SQL
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, r["source"], r["text"]) for i, r in clean.items()])
    order = sorted(r[0] for r in con.execute(mixing.sql()).fetchall())
    assert set(order) == set(clean)
    tok, start, want = Tokenizer.from_file(path()), 0, []
    for i in order:
        ids = np.array(tok.encode(clean[i]["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()) == want


def test_stages_in_their_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "tokens"]

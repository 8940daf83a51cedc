"""The pipeline's stages on the smallest table, against brute force, and on rows with nulls, repeats and further columns."""

import os
import re

import duckdb
import public_tokenizers
from helpers import documents, groups_of, normal_digest

import corpus_pipeline
from reqsift.llm import quality, secrets
from reqsift.llm.store import stored

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def redacted(text):
    spans = sorted((m.start(), m.end()) for r in secrets.RULES for m in re.finditer(r[1], text) if len(m[r[2]]) >= r[3])
    out, at = "", 0
    for start, end in spans:
        if start >= at:
            out += text[at:start] + secrets.MARK
        at = max(at, end)
    return out + text[at:]


def test_run(spark):
    from tokenizers import Tokenizer

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality.SQL}) WHERE kept").fetchall()}
    texts = [(i, t) for i, t in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall() if i in good]
    first = {}
    for i, t in texts:
        first.setdefault(normal_digest(t), (i, t))
    texts = sorted(first.values())
    roots, _ = groups_of([t for _, t in texts], corpus_pipeline.WIDTH)
    texts = [x for n, x in enumerate(texts) if roots[n] == n]
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    want = {i: len(encode(redacted(t), add_special_tokens=False).ids) + 1 for i, t in texts}
    got = {}
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_stages_keep_the_columns(spark):
    docs = documents(spark)
    columns, rows = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""), "stage")
        assert docs.columns == columns, name
        rows.append(docs.count())
    assert rows == sorted(rows, reverse=True) and rows[-1] > 0
    assert not docs.filter("text LIKE '%hunter22%'").count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


def test_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "stage")
    assert docs.count() == 0

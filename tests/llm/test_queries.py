"""The registered queries over the supplied tables, against SQL or direct computation."""

import hashlib
import html as entities
import re
import zlib

import pandas as pd
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tools.check_oracles import compare, connect
from venuekit.llm import QUERIES, bpe, language


@pytest.fixture(scope="module")
def documents(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet").set_index("doc_id")


def run(spark, sf_dir, name):
    return queries()[name](spark, sf_dir).toPandas()


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES} and "pipeline" in queries()


@pytest.mark.parametrize("name", ["op2_topk", "op7_chat", "op11_jaccard", "op12_periodic", "op13_audit"])
def test_same_as_sql(spark, sf_dir, name):
    verdict = compare(spark, connect(sf_dir), name, queries()[name], oracle_sql()[name], sf_dir)
    assert verdict.startswith("ok"), verdict


def test_op1(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op1_mixing").set_index("doc_id")
    sizes = documents.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    assert (got["size"].sort_index() == sizes.sort_index()).all()
    by = got.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken - by.target).abs() <= 0.03 * by.target + 1).all()


def test_op4(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op4_fingerprints").set_index("doc_id")
    assert set(got.index) == set(documents.index)
    assert (got.near_edited > got.near_next).mean() > 0.9
    assert documents.assign(f=got.fingerprint).groupby("text").f.nunique().max() == 1


def test_op5(spark, sf_dir, documents):
    own = Tokenizer.from_file(bpe.vocabulary_file())
    got = run(spark, sf_dir, "op5_bpe").set_index("doc_id")
    for i, text in documents.text.items():
        ids = own.encode(text, add_special_tokens=False).ids
        back = own.decode(ids, skip_special_tokens=False)
        assert got.ids_sha256[i] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (got.n_tokens[i], got.decoded_sha256[i]) == (len(ids), hashlib.sha256(back.encode()).hexdigest())


def test_op6(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op6_near_dedup").set_index("doc_id")
    assert documents.assign(c=got.class_id).groupby("text").c.nunique().max() == 1
    grams = {i: {*zip(*[t.split()[k:] for k in range(5)], strict=False)} for i, t in documents.text.items()}
    ids = list(documents.index)
    for a in ids:
        for b in ids:
            if a < b and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]) > 0:
                assert got.class_id[a] == got.class_id[b], (a, b)


def test_op8(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op8_language").set_index("doc_id")
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]
    assert list(got.held_out) == held
    assert (got.lang_pred == documents.lang.reindex(got.index))[got.held_out].mean() > 0.95


def test_op9(spark, sf_dir, documents):
    got = run(spark, sf_dir, "op9_toxicity").set_index("doc_id")
    labels = pd.read_parquet(f"{sf_dir}/labels.parquet").set_index("doc_id")
    clean = got.join(labels[labels.toxic == 0], how="inner")
    assert len(got) == len(documents) and clean.predicted.mean() < 0.05


def test_op10(spark, sf_dir):
    got = run(spark, sf_dir, "op10_html").set_index("page_id")
    pages = pd.read_parquet(f"{sf_dir}/pages.parquet").set_index("page_id")
    for i, page in pages.html.items():
        inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"<(?:p|h1|/p|/h1|br)>", " ", inside))
        assert got.text[i] == " ".join(entities.unescape(plain).split()) and got.n_chars[i] == len(got.text[i])


def test_pipeline_stage_by_stage(spark, sf_dir, documents):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        made = spark.createDataFrame(made.toPandas(), made.schema)
        assert name == "bpe" or made.columns == columns
        seen[name], docs = made.toPandas(), made
    confident = language.document_languages(spark.read.parquet(f"{sf_dir}/documents.parquet")).toPandas()
    assert set(seen["language_id"].doc_id) == set(confident[(confident.lang_pred != "und") & (confident.score >= 0.5)].doc_id)
    lines = seen["line_dedup"].text.str.split("\n").explode()
    lines = lines[lines.str.strip() != ""]
    assert not lines.duplicated().any()
    assert set(lines) <= set(seen["language_id"].text.str.split("\n").explode())
    assert set(seen["near_dedup"].doc_id) <= set(seen["line_dedup"].doc_id) and seen["near_dedup"].doc_id.is_unique
    words = seen["near_dedup"].set_index("doc_id").text.map(lambda t: len(t.split()))
    assert seen["mixing"].text.map(lambda t: len(t.split())).sum() == pytest.approx(words.sum(), rel=0.03)
    own = Tokenizer.from_file(bpe.vocabulary_file())
    wanted = sorted((i, own.encode(t, add_special_tokens=False).ids) for i, t in zip(seen["mixing"].doc_id, seen["mixing"].text, strict=True))
    assert sorted((i, list(x)) for i, x in zip(seen["bpe"].doc_id, seen["bpe"].ids, strict=True)) == wanted


def test_run_gives_the_last_stage(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and got.count() > 0

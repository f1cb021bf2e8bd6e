import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from venuekit.llm import language as L

WORDS = {
    "en": "the of and with from this that reading winter under thing".split(),
    "fr": "le la les des être avec école château hiver sous chose".split(),
    "el": "και το της με από αυτό χειμώνας κάτω πράγμα".split(),
}


def corpus(rng, n=240):
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 40))), lang))
    return rows


def test_held_out_accuracy_and_folds(spark, docs_of):
    rows = corpus(random.Random(1))
    got = {r.doc_id: r for r in L.document_languages(docs_of(rows, extra=True)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    right = [got[i].lang_pred == lang for i, _, lang in rows if got[i].held_out]
    assert np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in got.values())


def test_edge_cases(spark, docs_of):
    rows = [*corpus(random.Random(2)), (9000, None), (9001, ""), (9002, "12 34 !!"), (9003, "the of and", None), (None, "les des"), (9004, "the"), (9004, "the")]
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.document_languages(docs_of(rows)).collect()]
    assert len(got) == len(rows)
    by = {i: (p, s) for i, p, s in got}
    assert by[9000] == by[9001] == by[9002] == ("und", 0.0) and by[9003][0] == "en" and by[None][0] == "fr"
    assert L.document_languages(docs_of(rows).limit(0)).count() == 0
    untaught = L.document_languages(docs_of([(1, "words here", None)])).collect()
    assert [(r.lang_pred, r.score) for r in untaught] == [("und", 0.0)]
    kept = L.confident_documents(docs_of(rows, extra=True))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r.doc_id for r in kept.collect()} >= {9003, 9004, None}
    assert kept.where("doc_id in (9000, 9001, 9002)").count() == 0


def test_spans_of_mixed_text(spark, docs_of):
    model = L.train(docs_of(corpus(random.Random(3))))
    text = "reading under this thing with winter and école sous le château avec les être des chose, από αυτό της και"
    row = L.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model, switch=4.0).first()
    assert [(s.lang, text[s.begin : s.end]) for s in row.spans] == [
        ("en", "reading under this thing with winter and"), ("fr", "école sous le château avec les être des chose"), ("el", "από αυτό της και"),
    ]
    # words of a script that one language uses can only be of it
    greek = L.identify(spark.createDataFrame([(1, "ξψωζθ")], "doc_id long, text string"), model).first()
    assert greek.lang_pred == "el"


def plain_viterbi(scores, switch):
    value, back = scores[0].astype(float), []
    for s in scores[1:]:
        step = value[:, None] - switch * (1 - np.eye(len(value)))
        back.append(step.argmax(axis=0))
        value = step.max(axis=0) + s
    return value.max()


def test_paths_are_optimal():
    rng = np.random.default_rng(4)
    texts = [-rng.integers(0, 6, (n, 3)).astype(np.float32) for n in (1, 2, 5, 9, 30, 31, 64, 200)]
    for path, scores in zip(L.viterbi(texts, 3.0), texts, strict=True):
        worth = scores[np.arange(len(scores)), path].sum() - 3.0 * (np.diff(path) != 0).sum()
        assert worth == plain_viterbi(scores, 3.0)
    flat = np.concatenate(texts)
    begins = np.cumsum([0, *[len(t) for t in texts[:-1]]])
    best = [int(t.sum(axis=0).argmax()) for t in texts]
    rise = L.gains(flat, np.repeat(best, [len(t) for t in texts]), begins)
    for t, b, r in zip(texts, best, rise, strict=True):
        if r <= 3.0:  # then staying is optimal
            assert t[:, b].sum() == plain_viterbi(t, 3.0)


def test_training_does_not_depend_on_partitions(spark, docs_of):
    docs = docs_of(corpus(random.Random(5)))
    a, b = L.train(docs), L.train(docs.repartition(5).orderBy(F.rand(1)))
    assert a["langs"] == b["langs"] and np.allclose(a["scores"], b["scores"])

import math
import random
import zlib

import pytest

from venuekit.llm import toxicity as T

CLEAN = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "so", "ti", "vu", "xa", "ze")]


def corpus(rng, n=400):
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(CLEAN) for _ in range(rng.randint(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["gromble", "sklurt" + rng.choice("abcdefgh"), "Gr0mble!", "grоmble"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs_of, docs, labels):
    return docs_of(docs, extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_scored_right(spark, docs_of):
    docs, labels = corpus(random.Random(1))
    got = {r.doc_id: r for r in T.document_toxicity(*frames(spark, docs_of, docs, labels)).collect()}
    truth = {i: t for i, _, t in labels}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in truth)
    assert all(got[i].predicted == t for i, t in truth.items())
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got.values())


def test_edge_cases(spark, docs_of):
    docs, labels = corpus(random.Random(2))
    docs += [(9000, None), (9001, ""), (None, "gromble"), (9002, "gr0mble"), (9002, "gr0mble"), (9003, "so " * 30000 + "gromble " * 900)]
    labels += [(9000, 1, 1), (None, 0, 1), (5, 0, None), (5, 0, 0)]
    got = T.document_toxicity(*frames(spark, docs_of, docs, labels)).collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r.predicted for r in got}
    assert (by[9000], by[9001], by[9002], by[9003], by[None]) == (0, 0, 1, 1, 1)
    none = T.document_toxicity(*frames(spark, docs_of, docs, labels[:0] + [(1, 1, 0)])).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert T.document_toxicity(frames(spark, docs_of, docs, labels)[0].limit(0), frames(spark, docs_of, docs, labels)[1]).count() == 0


def test_folding():
    fold = T.folder()
    assert fold("Ｉd10t!! i​diot, ІDІОТ écolé") == " idiot idiot idiot ecole "
    assert fold("p@$$ed b@d 漢字 wow!! a@") == " passed bad 漢字 wow a "
    assert fold("") == "  "


def test_exceptions_and_heaviest_pattern():
    model = {"lexicon": {" grom": 2.0, " gromble ": 5.0}, "exceptions": [" blue gromble "], "cut": 1.0}
    matcher, fold = T.automaton(model), T.folder()
    assert sorted(T.hits(matcher, fold("gromble gromit blue gromble")).values()) == [2.0, 5.0]
    assert T.hits(T.automaton({"lexicon": {}, "exceptions": []}), " x ") == {}
    assert T.burden([4.0], 4000) < T.burden([4.0], 4)


def test_learned_exception_phrases(spark, docs_of):
    rng = random.Random(3)
    docs, labels = corpus(rng, 300)
    for i in range(300, 318):  # a plant's name in clean texts
        docs.append((i, " ".join(rng.choice(CLEAN) for _ in range(30)) + f" blue gromble {rng.choice(CLEAN)} {i}"))
        labels.append((i, 1, 0))
    model = T.train(*frames(spark, docs_of, docs, labels), least_odds=4.0)
    assert " blue gromble " in model["exceptions"] and any(p.startswith(" grom") for p in model["lexicon"])
    texts = spark.createDataFrame([(1, "kara blue gromble lovu"), (2, "kara gromble lovu")], "doc_id long, text string")
    assert [r.predicted for r in T.score_texts(texts, model).orderBy("doc_id").collect()] == [0, 1]


def plain_burden(model, text):
    """Weights summed word by word; a word counts with its heaviest pattern, and not inside an exception."""
    words = T.folder()(text).split()
    total = 0.0
    for i, word in enumerate(words):
        spoken = {f" {word} "} | {f" {word[:n]}" for n in range(1, len(word) + 1)}
        weights = [w for p, w in model["lexicon"].items() if p in spoken]
        pairs = {f" {' '.join(words[i - 1 : i + 1])} " if i else "", f" {' '.join(words[i : i + 2])} "}
        if weights and not pairs & set(model["exceptions"]):
            total += max(weights)
    return total / math.log2(8 + len(words))


def test_scores_equal_weights_summed_word_by_word(spark, docs_of):
    rng = random.Random(11)
    docs, labels = corpus(rng, 200)
    docs = [(i, t + (" blue gromble" if i % 9 == 0 else "")) for i, t in docs] + [(500, ""), (501, None), (502, "Gr0mble! gromble")]
    model = T.train(*frames(spark, docs_of, docs, labels)) | {"exceptions": [" blue gromble "]}
    got = {r.doc_id: r for r in T.score_texts(docs_of(docs), model).collect()}
    for i, text in docs:
        want = plain_burden(model, text or "")
        assert got[i].burden == pytest.approx(want)
        assert got[i].score == pytest.approx(want / (want + model["cut"]))
        assert got[i].predicted == int(want >= model["cut"])


def test_texts_that_share_a_passage_are_not_one_family():
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [passage + " " + " ".join(f"o{k}_{i}" for i in range(40)) for k in range(60)] + [passage] * 3
    families = next(iter(T._family([T.pd.DataFrame({"text": texts})]))).family.tolist()
    assert len(set(families[:60])) > 45 and len(set(families[60:])) == 1

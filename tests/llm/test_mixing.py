import re

import pytest

from venuekit.llm import mixing


def targets_by_rounds(sizes, weights):
    """The reshare, round by round."""
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        weight = sum(weights[s] for s in sizes if s not in fixed)
        got = {s: fixed[s] if s in fixed else (left * weights[s] / weight if weight else 0) for s in sizes}
        over = [s for s in sizes if s not in fixed and got[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return got
        fixed |= {s: 3.0 * sizes[s] for s in over}


def test_targets_and_taken(spark, docs_of, rows):
    docs = docs_of([(i, "w " * (1 + i * 7 % 90), "en", "abcdefg"[min(i % 11, 6)]) for i in range(900)])
    got = rows(mixing.mix(docs, shard_words=2000))
    assert len(got) == 900 and rows(mixing.mix(docs.repartition(7), shard_words=2000).select("doc_id", "taken").orderBy("doc_id")) == sorted(
        [{"doc_id": r["doc_id"], "taken": r["taken"]} for r in got], key=lambda r: r["doc_id"]
    )
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    wanted = targets_by_rounds(sizes, weights)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {sizes[s]}
        assert mine[0]["target"] == pytest.approx(wanted[s])
        assert sum(r["taken"] for r in mine) == pytest.approx(wanted[s], rel=0.03)


def test_apportion_is_highest_quotients(spark, rows):
    votes = {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.0, "e": 7.5}
    for seats in (0, 1, 2, 7, 50, 333):
        df = spark.createDataFrame([(1, k, v, seats) for k, v in votes.items()], "g int, k string, v double, n long")
        offers = sorted(((-v / (2 * j - 1), k) for k, v in votes.items() if v for j in range(1, seats + 1)))[:seats]
        wanted = {k: sum(1 for _, x in offers if x == k) for k in votes}
        assert {r["k"]: r["quota"] for r in rows(mixing.apportion(df, ["g"], "k", "v", "n"))} == wanted


def test_nulls_empties_and_repeats(spark, docs_of, rows):
    docs = docs_of([(1, None), (None, "a b"), (2, ""), (2, "x\ty\nz"), (2, "x\ty\nz"), (3, "   ", "en", None), (4, "one", "en", None)], extra=True)
    got = rows(mixing.mix(docs))
    assert sorted(r["size"] for r in got) == [0, 0, 1, 1, 2, 3, 3]
    assert {r["target"] for r in got if r["source"] is None} and all(r["taken"] <= 3 * r["size"] for r in got)
    assert rows(mixing.mix(docs.limit(0))) == []
    blank = rows(mixing.mix(docs_of([(1, ""), (2, None)])))
    assert [(r["target"], r["taken"]) for r in blank] == [(0.0, 0), (0.0, 0)]


def test_mixed_documents_hold_the_taken_words(spark, docs_of, rows):
    docs = docs_of([(i, " ".join(f"d{i}w{j}" for j in range(5 + i % 60)), "en", "ab"[i % 5 == 0]) for i in range(300)])
    taken = {r["doc_id"]: r["taken"] for r in rows(mixing.mix(docs))}
    texts = rows(mixing.mixed_documents(docs))
    words = {}
    for r in texts:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall(r"\S+", r["text"]))
        assert r["n_chars"] == len(r["text"]) and set(r["text"].split()) <= {f"d{r['doc_id']}w{j}" for j in range(70)}
    assert words == {k: v for k, v in taken.items() if v}


def test_own_weights(spark, docs_of, rows):
    docs = docs_of([(i, "w " * 10, "en", "abc"[i % 3]) for i in range(90)])
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", float("nan"))], "source string, weight double")
    got = {r["source"]: r["target"] for r in rows(mixing.mix(docs, weights))}
    assert got == pytest.approx({"a": 450.0, "b": 450.0, "c": 0.0})

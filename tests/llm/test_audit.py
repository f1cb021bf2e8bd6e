import re
from itertools import permutations

import pytest

from venuekit.llm import audit as A

LABELS = "doc_id long, quality int, toxic int, part string"


def letters(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    bad = "A" if len(words) < 50 else ""
    bad += "B" if 100 * len(set(words)) < 65 * len(words) else ""
    bad += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
    return bad + ("D" if re.search(r"[#$%&*|]", text) else "")


def plain(rows, labels):
    """Every filter applied to every document in every order."""
    texts = [(i, t or "", s or "") for i, t, _, s in rows]
    out = {}
    for part in {s for _, _, s in texts}:
        docs = []
        for i, t, s in texts:
            if s == part:
                again = i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)
                good, toxic = (any(k == i and i is not None and x[at] == 1 for k, *x in labels) for at in (0, 1))
                docs.append((letters(t) + ("E" if again else ""), good, toxic))
        removed = {f: 0 for f in "ABCDE"}
        for order in map("".join, permutations("ABCDE")):
            left = list(docs)
            for step, f in enumerate(order, 1):
                goes = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                removed[f] += len(goes)
                out[part, order, step] = {
                    "kept": len(left), "removed": len(goes), "redundant": sum(f in d[0] for d in docs) - len(goes),
                    "unique_fails": sum(d[0] == f for d in docs), "good_lost": sum(d[1] for d in goes),
                    "toxic_lost": sum(d[2] for d in goes),
                }
        for (p, order, step), row in out.items():
            if p == part:
                row["shapley"] = removed[order[step - 1]]
    return out


def check(spark, docs_of, rows, labels):
    got = A.audit(docs_of(rows, extra=True), spark.createDataFrame([(*x, "x") for x in labels], LABELS)).collect()
    want = plain(rows, labels)
    assert len(got) == len(want)
    for r in got:
        found = r.asDict()
        key = found.pop("part"), found.pop("filter_order"), found.pop("step")
        assert found == want[key], key


def test_same_as_every_filter_applied_in_turn(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(80))
    texts = [long, "", None, "AAA BBB", "one $ two", "la " * 90, long + " x", "LA " * 70 + "#", " \t\n", "é" * 40]
    rows = [(i, texts[(i * 7) % len(texts)], "en", [None, "", "s1", "s2"][i % 4]) for i in range(60)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 60, 3)]
    check(spark, docs_of, rows, labels)


def test_missing_and_repeated_ids_and_labels(spark, docs_of):
    rows = [
        (1, "same", "en", "a"), (1, "same", "en", "a"), (1, "other", "en", "a"), (2, "same", "en", "b"),
        (None, "same", "en", "a"), (None, "same", "en", "b"), (None, None, "en", None), (7, None, "en", "b"),
    ]
    labels = [(1, 0, 1), (1, 1, 0), (None, 1, 1), (2, None, None), (99, 1, 1)]
    check(spark, docs_of, rows, labels)


def test_a_third_under_one_text(spark, docs_of):
    rows = [(i, "hot text" if i % 3 else f"text {i}", "en", f"s{i % 2}") for i in range(300)]
    check(spark, docs_of, rows, [(i, 1, 1) for i in range(300)])


def test_no_rows(spark, docs_of):
    assert A.audit(docs_of([]), spark.createDataFrame([], LABELS)).count() == 0


def test_a_very_long_text(spark, docs_of):
    words = "word " * 300_000
    got = A.audit(docs_of([(1, words)]), spark.createDataFrame([], LABELS)).where("filter_order = 'BACDE'").collect()
    assert [r.removed for r in sorted(got, key=lambda r: r.step)] == [1, 0, 0, 0, 0]


def test_texts_are_not_shuffled(spark, docs_of, capsys):
    A.mask_cells(docs_of([(1, "a")]), spark.createDataFrame([], LABELS)).explain("formatted")
    plan = capsys.readouterr().out
    assert not re.search("PythonUDF|MapIn|EvalPython", plan)
    for exchange in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan):
        assert not re.search(r"\b(text|words)#", exchange)


@pytest.mark.parametrize("fails", ["", "A", "CE", "ABCDE"])
def test_a_cell_is_removed_once_in_each_order(spark, fails):
    cell = spark.createDataFrame([(fails, 3, 2, 1)], "fails string, n long, good long, toxic long")
    from pyspark.sql import functions as F

    steps = cell.select(A.fold_orders(F.lit(A.ORDERS)).alias("s")).first().s
    assert len(steps) == 600
    assert sum(s.removed for s in steps) == (360 if fails else 0)
    assert {s.kept for s in steps[4::5]} == {0 if fails else 3}

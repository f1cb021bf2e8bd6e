import random
import re

import numpy as np
import pytest

from venuekit.llm import jaccard as J
from venuekit.llm.rtree import CountTree, overlapping


def grams(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def plain(rows, percent=85):
    sets = [grams(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0] and a and b
            if a and b and (100 * len(a & b) >= percent * len(a | b) or same_id):
                label[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows) if doc is not None)


def got(docs_of, rows, **options):
    found = J.jaccard_components(docs_of(rows, extra=True), **options).where("doc_id is not null")
    return sorted(tuple(r) for r in found.collect())


def variants(rng, groups=8, copies=6, words=600):
    pool = [f"w{i}" for i in range(words)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(pool) for _ in range(rng.randint(20, 160))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                text[rng.randrange(len(text))] = rng.choice(pool)
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 90)))) for i in range(40)]
    return rows


@pytest.mark.parametrize("percent", [85, 60])
def test_components_equal_brute_force(spark, docs_of, percent):
    rows = variants(random.Random(percent))
    want = plain(rows, percent)
    assert len({c for _, _, c in want}) < len(rows) - 20
    assert got(docs_of, rows, percent=percent) == want


def test_small_trees_and_large_buckets(spark, docs_of, monkeypatch):
    """A passage that all documents hold, frequent shingles unknown, and trees of four members."""
    monkeypatch.setattr(J, "SAMPLE_LEAST", 10**9)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(120):
        own = [f"o{i // 3}_{j}" for j in range(9)]
        if i % 3:
            own[rng.randrange(9)] = f"x{i}"
        rows.append((i, " ".join(passage + own)))
    assert got(docs_of, rows, block=4) == plain(rows)


def test_frequent_shingles_change_nothing(spark, docs_of, monkeypatch):
    monkeypatch.setattr(J, "SAMPLE_SHARE", 1)
    monkeypatch.setattr(J, "SAMPLE_LEAST", 2)
    rows = variants(random.Random(11))
    assert got(docs_of, rows) == plain(rows)


def test_edge_cases(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (5, None), (6, ""), (7, " \n"), (8, "One two"), (3, "one  TWO"), (9, "one two three four"), (10, "one two three four"),
        (11, "Ä b c d e"), (12, "ä b c d e"), (20, long), (20, long + " x"), (21, long + " x y"), (21, "quite another text here"),
        (2, "quite another text here"), (30, "a b a b a b a b"), (31, "a b a b a b"),
    ]
    assert got(docs_of, rows) == plain(rows)


def test_missing_ids(spark, docs_of):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (4, "A b c d e"), (None, ""), (None, "x y z"), (None, None)]
    found = J.jaccard_components(docs_of(rows)).collect()
    assert len(found) == 6 and sum(r.component_id == 4 for r in found) == 3
    assert all(r.component_id >= J.UNNAMED for r in found if r.component_id != 4)


def test_no_rows(spark, docs_of):
    assert J.jaccard_components(docs_of([])).count() == 0


def test_very_long_texts_and_a_hot_text(spark, docs_of):
    rng = random.Random(5)
    long = [f"v{rng.randrange(5000)}" for _ in range(120_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:110_000])), (3, " ".join(long[:60_000]))]
    rows += [(i, "one and the same text again") for i in range(10, 60)]
    found = {r[0]: r for r in got(docs_of, rows)}
    assert found[2][2] == 1 and found[3][2] == 3 and {found[i][2] for i in range(10, 60)} == {10}


def test_a_chain_is_one_component(spark, docs_of):
    words = [f"c{i}" for i in range(100)]
    rows = []
    for n in range(8):
        words = [f"n{n}_{i}" if i // 4 == n else w for i, w in enumerate(words)]
        rows.append((100 - n, " ".join(words)))
    want = plain(rows)
    assert {c for _, _, c in want} == {93}
    assert got(docs_of, rows) == want


def test_trees_pass_over_no_pair():
    rng = np.random.default_rng(7)
    for size in (1, 2, 15, 40, 150):
        counts = rng.poisson(2, (size, 8)).astype(np.int64)
        sizes, labels = counts.sum(axis=1), rng.integers(0, max(1, size // 2), size)
        tree = CountTree(counts, sizes, labels)
        other = CountTree(counts[::-1].copy(), sizes[::-1].copy(), labels[::-1].copy())
        bound = np.minimum(counts[:, None], counts[None]).sum(axis=2)
        ok = (185 * bound >= 85 * (sizes[:, None] + sizes[None])) & (labels[:, None] != labels[None])
        found = [(int(x), int(y), int(n)) for i, j, b in overlapping(tree, tree, 85) for x, y, n in zip(i, j, b, strict=True)]
        want = {(i, j) for i, j in zip(*np.nonzero(ok), strict=True) if i < j}
        assert len(found) == len(want) and {tuple(sorted(p[:2])) for p in found} == want
        assert all(n == bound[i, j] for i, j, n in found)
        crossed = {(int(x), size - 1 - int(y)) for i, j, _ in overlapping(tree, other, 85) for x, y in zip(i, j, strict=True)}
        assert crossed == set(zip(*np.nonzero(ok), strict=True))

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from venuekit.llm import periodic as P


def plain(words, least=24, exponent=3):
    """Every period tried at every place."""
    best = {}
    n = len(words)
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            b = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = b - q, i - b + q
            if length >= max(least, exponent * q):
                best.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def numbers(rng):
    n, k = rng.randint(0, 140), rng.choice([1, 2, 3, 9, 60])
    words = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a, p = rng.randrange(n), rng.randint(1, 12)
        for i in range(a, min(n, a + rng.randint(1, 80))):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("least, exponent", [(24, 3), (4, 2), (9, 2), (7, 3), (10, 4)])
def test_runs_equal_brute_force(least, exponent):
    rng = random.Random(least)
    total = 0
    for _ in range(250):
        words = numbers(rng)
        want = plain(words, least, exponent)
        total += len(want)
        assert P.runs_of(np.array(words, dtype=np.int32), least, exponent) == want, words
    assert total > 50


def test_every_primitive_square_is_told_once_at_its_end():
    rng = random.Random(2)
    for _ in range(200):
        words = [rng.randrange(2) for _ in range(rng.randint(0, 40))]
        want = set()
        for end in range(len(words)):
            for q in range(1, (end + 1) // 2 + 1):
                root = words[end - q + 1 : end + 1]
                primitive = not any(q % d == 0 and root == root[:d] * (q // d) for d in range(1, q))
                if primitive and root == words[end - 2 * q + 1 : end - q + 1]:
                    want.add((end, q))
        got = list(P.squares(words))
        assert len(got) == len(set(got)) and set(got) == want


def test_the_automaton_counts_all_substrings():
    words = [1, 2, 1, 1, 2, 1, 3, 1, 2]
    length, link, states = P.suffix_automaton(words)
    distinct = {tuple(words[i:j]) for i in range(9) for j in range(i + 1, 10)}
    assert sum(length[s] - length[link[s]] for s in range(1, len(length))) == len(distinct)
    assert [length[s] for s in states] == list(range(1, 10))


def edited(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(words):
    runs = plain(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_on_edge_cases(spark, docs_of):
    tens = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    rng = random.Random(4)
    prose = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    rows = [(i, prose(rng.randint(0, 300))) for i in tens]
    rows += [(tens[-1] + 1, None), (tens[-1] + 2, ""), (None, "la " * 40), (None, None), (tens[0], None), (tens[1], " \n\t ")]
    rows += [(-5, "a\tb\nc\x0bd " * 10), (-5, "a\tb\nc\x0bd " * 10), (-6, "x\x1cy " * 30 + " z " * 30), (-7, "ha " * 23)]
    got = P.run_digests(P.periodic_runs(P.with_planted_runs(docs_of(rows, extra=True)))).collect()
    want = sorted(((i, *expected(edited(i, t))) for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert sum(r.n_runs > 0 for r in got) > 20


def test_very_long_texts(spark, docs_of):
    cycle = " ".join(f"w{i}" for i in range(7000))
    rows = [(1, " ".join([cycle] * 10)), (2, "x " * 200_000), (3, " ".join(f"u{i}" for i in range(200_000)))]
    got = {r.doc_id: r for r in P.periodic_runs(docs_of(rows)).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 70_000, 7000)] and got[1].collapsed == cycle
    assert [tuple(r) for r in got[2].runs] == [(0, 200_000, 1)] and got[2].collapsed == "x"
    assert not got[3].runs and got[3].collapsed == rows[2][1]


def test_equal_exponents_go_to_the_first_run(spark, docs_of):
    one, two = " ".join("abcdefgh"), " ".join("ijklmnop")
    found = P.periodic_runs(docs_of([(1, " ".join([one] * 3 + ["-"] + [two] * 3 + ["-"] + [one] * 3))]))
    row = P.run_digests(found).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (3, 0, 24, 8, 3000)


def test_no_rows(spark, docs_of):
    assert P.run_digests(P.periodic_runs(P.with_planted_runs(docs_of([])))).count() == 0

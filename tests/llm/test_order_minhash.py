import random

import pyarrow as pa
import pytest

from tests.llm.test_alignment import plain
from venuekit.llm import order_minhash as M
from venuekit.llm.graph import components, thinned, with_links


def planted(rng, groups=12, copies=5):
    words = [f"w{i}" for i in range(800)]
    rows, group = [], {}
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.randint(60, 160))]
        for c in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                text[rng.randrange(len(text))] = rng.choice(words)
            group[len(rows)] = g
            rows.append((len(rows), " ".join(text)))
    for _ in range(60):
        group[len(rows)] = -len(rows)
        rows.append((len(rows), " ".join(rng.choice(words) for _ in range(rng.randint(5, 120)))))
    return rows, group


def test_planted_copies_are_found_and_others_left_alone(spark, docs_of):
    rows, group = planted(random.Random(8))
    got = {r.doc_id: (r.class_id, r.class_size) for r in M.near_classes(docs_of(rows, extra=True)).collect()}
    for a in group:
        mates = [b for b in group if group[b] == group[a]]
        assert got[a] == (min(mates), len(mates)), a


def test_classes_equal_brute_force_links(spark, docs_of):
    rng = random.Random(9)
    rows, _ = planted(rng, groups=6, copies=4)
    # a chain: each is near the next, the ends are far apart
    chain = [f"c{i}" for i in range(100)]
    for n in range(4):
        chain = [f"x{n}_{i}" if n * 15 <= i < n * 15 + 12 else w for i, w in enumerate(chain)]
        rows.append((1000 + n, " ".join(chain)))
    label = {i: i for i, _ in rows}
    split = {i: t.split() for i, t in rows}
    for _ in range(4):
        for a in split:
            for b in split:
                most = max(len(split[a]), len(split[b]))
                if label[a] != label[b] and abs(len(split[a]) - len(split[b])) <= 0.2 * most and len(set(split[a]) & set(split[b])) > 0.5 * most and plain(split[a], split[b]) <= int(0.2 * most):
                    low = min(label[a], label[b])
                    label[a] = label[b] = low
    got = {r.doc_id: r.class_id for r in M.near_classes(docs_of(rows)).collect()}
    assert got == label


def crowd():
    """Texts that share a passage of 150 words and have 50 of their own; pairs of twins share 12 of these, no run of five."""
    passage = [f"p{i}" for i in range(150)]
    own = lambda who: [f"o{who}_{i}" for i in range(50)]
    rows = [(i, " ".join(passage + own(i))) for i in range(12)]
    for i in range(20):
        one, two = own(f"a{i}"), own(f"b{i}")
        twin = [x if j % 4 == 2 else y for j, (x, y) in enumerate(zip(one, two, strict=True))]
        rows += [(100 + i, " ".join(passage + one)), (200 + i, " ".join(passage + twin))]
    return rows


def test_twins_in_a_crowd_that_shares_a_passage(spark, docs_of):
    want = {i: i for i in range(12)} | {100 + i: 100 + i for i in range(20)} | {200 + i: 100 + i for i in range(20)}
    for options in ({}, {"block": 4}):
        got = {r.doc_id: r.class_id for r in M.near_classes(docs_of(crowd()), **options).collect()}
        assert got == want, options


def test_groups_hold_every_pair_of_similar_length(spark):
    rng = random.Random(4)
    rows = [(b, i, i, rng.randint(1, 60), b"") for b, n in ((1, 5), (2, 90)) for i in range(n)]
    members = spark.createDataFrame(rows, "bucket long, id long, label long, n long, bag binary")
    for similarity in (0.8, 0.5):
        met, groups = set(), {}
        for r in M._grouped(members, similarity, 7).collect():
            groups.setdefault(r.grp, []).append(r)
        for g in groups.values():
            assert len(g) < 60
            met |= {(x.id, y.id) for x in g for y in g if x.id < y.id and (x.side, y.side) in ((2, 2), (0, 1), (1, 0))}
        size = {i: n for b, i, _, n, _ in rows if b == 2}
        assert all((x, y) in met for x in size for y in size if x < y and min(size[x], size[y]) >= similarity * max(size[x], size[y]))


def near_pairs(split):
    return {(i, j) for i in range(len(split)) for j in range(i + 1, len(split))
            if plain(split[i], split[j]) <= int(0.2 * max(len(split[i]), len(split[j])) + 1e-9)}


def classes_of(links, ids):
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in links:
        label[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("long", [False, True])
def test_candidates_pass_over_no_near_pair(monkeypatch, long):
    if long:
        monkeypatch.setattr(M, "WORD_BY_WORD", 30)
    rng = random.Random(6)
    sketch = M._sketcher(5, 4, 2)
    texts = []
    for _ in range(30):
        base = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(20, 60))]
        for _ in range(4):
            text = list(base)
            for _ in range(rng.randint(0, len(base) // 4)):
                text[rng.randrange(len(text))] = f"w{rng.randint(0, 300)}"
            texts.append(" ".join(text))
    frame = M.pd.DataFrame({"doc_id": range(len(texts)), "own": range(len(texts)), "t1": 0, "t2": 0, "text": texts})
    made = next(sketch([pa.RecordBatch.from_pandas(frame)])).to_pandas()
    rows = M.pd.DataFrame({"grp": 1, "side": 2, "id": made.own, "label": made.own, "n": made.n_words, "bag": made.bag})
    near = near_pairs([t.split() for t in texts])

    def found(frames, spanning):
        return {(r.a, r.b) for part in M._candidates(0.8, spanning)(frames) for r in part.itertuples()}

    # the group is cut by batches; then its halves meet each other only
    got = found([rows[:50], rows[50:70], rows[70:]], False)
    assert near and near <= got and len(got) < len(near) + (2000 if long else 20)
    assert classes_of(found([rows], True), range(len(texts))) == classes_of(got, range(len(texts)))
    halves = rows.assign(side=[i % 2 for i in range(len(rows))])
    assert {(i, j) for i, j in near if (i + j) % 2} <= found([halves], False) <= got


def test_a_large_bucket_grows_with_its_members(spark):
    """Texts that share a passage meet by rare words: every near pair still, in rows that double with the members."""
    made = []
    for n in (300, 600):
        rng = random.Random(5)
        passage = [f"p{i}" for i in range(20)]
        texts = [passage + [f"o{i}_{j}" for j in range(10 + i % 7)] for i in range(n)]
        texts += [replaced(rng, texts[i], 3) for i in range(0, n, 20)]
        frame = spark.createDataFrame([(i, i, len(t), " ".join(t)) for i, t in enumerate(texts)], "id long, own long, n long, text string")
        rows = spark.createDataFrame([(1, i, i) for i in range(len(texts))], "bucket long, id long, own long")
        words = M._by_rare_words(rows, frame, 0.8, 20)
        at = {}
        for r in words.collect():
            at.setdefault(r.bucket, set()).add(r.id)
        assert all(any({i // 20 + n, i} <= ids for ids in at.values()) for i in range(0, n, 20))
        members = words.join(frame.select("id", "n"), "id").selectExpr("bucket", "id", "id label", "n", "binary('') bag")
        made.append(M._grouped(members, 0.8, 20).count())
        assert M._by_rare_words(rows, frame, 0.8, 10_000) is rows
    assert made[1] < 2.2 * made[0]


def test_long_texts_of_a_large_bucket_are_not_copied_by_their_words(spark):
    """Texts of 1,500 words meet in a few cells and not in buckets of 301 rare words each; short ones still do by words."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(1000)]
    texts = [passage + [f"o{i}_{j}" for j in range(500)] for i in range(30)]
    texts += [replaced(rng, texts[i], 150) for i in range(0, 30, 5)]
    frame = spark.createDataFrame([(i, i, len(t), " ".join(t)) for i, t in enumerate(texts)], "id long, own long, n long, text string")
    rows = spark.createDataFrame([(1, i, i) for i in range(len(texts))], "bucket long, id long, own long")
    members = M._by_rare_words(rows, frame, 0.8, 8).join(frame.select("id", "n"), "id")
    members = members.selectExpr("bucket", "id", "id label", "n", "binary('') bag")
    sides = {}
    for r in M._grouped(members, 0.8, 8).collect():
        sides.setdefault((r.grp, r.side), set()).add(r.id)
    assert sum(len(texts[i]) for ids in sides.values() for i in ids) < 20 * sum(len(t) for t in texts)
    meet = {(i, j) for (grp, side), ids in sides.items() for i in ids for j in sides.get((grp, side if side == 2 else 1 - side), ())}
    assert all((i, 30 + i // 5) in meet for i in range(0, 30, 5))


def test_a_group_makes_no_square_of_pairs(spark):
    """Texts of the same words in other orders, and long ones with the same repeated tail, are told apart inside the task."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    tail = ["is", "onhe"] * 200
    texts = [" ".join(rng.sample(words, len(words))) for _ in range(40)]
    texts += [" ".join([f"o{i}_{j}" for j in range(250)] + tail) for i in range(40)]
    near = " ".join(replaced(rng, texts[0].split(), 5))
    frame = M.pd.DataFrame({"doc_id": range(81), "own": range(81), "t1": 0, "t2": 0, "text": [*texts, near]})
    made = next(M._sketcher(5, 4, 2)([pa.RecordBatch.from_pandas(frame)])).to_pandas()
    rows = M.pd.DataFrame({"grp": 1, "side": 2, "id": made.own, "label": made.own, "n": made.n_words, "bag": made.bag})
    for spanning in (True, False):
        got = {(r.a, r.b) for part in M._candidates(0.8, spanning)([rows]) for r in part.itertuples()}
        assert got == {(0, 80)}


def replaced(rng, words, n):
    """The words with ``n`` of them replaced at random places by words of no other text."""
    text = list(words)
    for i in rng.sample(range(len(text)), n):
        text[i] = f"x{rng.getrandbits(48)}"
    return text


def test_recall_down_to_the_threshold(spark, docs_of):
    """Pairs at 10, 15 and 20 % replaced words, and texts of 5 to 9 words with one replaced."""
    rng = random.Random(20)
    rows, kinds = [], {}
    for kind, sizes, share in [("10", (60, 200), 0.1), ("15", (60, 200), 0.15), ("20", (60, 200), 0.2), ("short", (5, 6, 7, 8, 9), None)]:
        for k in range(100):
            for n in sizes:
                base = [f"{kind}_{n}_{k}_{i}" for i in range(n)]
                if share is None:
                    other = list(base)
                    other[n // 2 if k % 2 else rng.randrange(n)] = "new"
                else:
                    other = replaced(rng, base, int(share * n))
                at = len(rows)
                rows += [(at, " ".join(base)), (at + 1, " ".join(other))]
                kinds.setdefault((kind, n if share else "all"), []).append(at)
    got = {r.doc_id: r.class_id for r in M.near_classes(docs_of(rows)).collect()}
    for kind, pairs in kinds.items():
        assert sum(got[i] == got[i + 1] for i in pairs) >= 0.9 * len(pairs), kind
    assert all(got[i] in (i, i - 1) for i in got)


def test_a_crowd_of_far_texts_makes_no_rows_of_pairs(spark, docs_of):
    """40 words in common and 12 of their own: just too far apart; a few are near and linked."""
    rng = random.Random(40)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"o{i}_{j}" for j in range(12)])) for i in range(150)]
    rows += [(1000 + i, " ".join(replaced(rng, rows[i][1].split(), 3))) for i in range(0, 150, 10)]
    got = {r.doc_id: r.class_id for r in M.near_classes(docs_of(rows)).collect()}
    ids = [i for i, _ in rows]
    near = near_pairs([t.split() for _, t in rows])
    assert got == classes_of([(ids[i], ids[j]) for i, j in near], ids)


def test_every_text_of_a_doc_id_counts_and_order_does_not(spark, docs_of):
    rng = random.Random(41)
    one, two, three = ([f"{c}{i}" for i in range(50)] for c in "abc")
    rows = [(5, " ".join(one)), (5, " ".join(two)), (6, " ".join(replaced(rng, one, 3))), (7, " ".join(replaced(rng, two, 3))),
            (8, " ".join(three))]
    rows += [(50, f"text number {i} of a doc_id that a third of all rows have " + " ".join(f"z{i}_{j}" for j in range(20))) for i in range(10)]
    results = []
    for order in (rows, rows[::-1]):
        frame = docs_of(order).coalesce(1)
        assert {r.doc_id: r.class_id for r in M.near_classes(frame).collect()} == {5: 5, 6: 5, 7: 5, 8: 8, 50: 50}
        results.append(sorted(tuple(r) for r in M.near_representatives(frame).collect()))
    assert results[0] == results[1] and [r[0] for r in results[0]] == [5, 8, 50]


def test_very_long_texts(spark, docs_of):
    long = [f"v{i % 9000}_{i}" for i in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(replaced(random.Random(1), long, 600))), (3, " ".join(long[:30_000]))]
    assert {r.doc_id: r.class_id for r in M.near_classes(docs_of(rows)).collect()} == {1: 1, 2: 1, 3: 3}


def test_nulls_empties_and_repeats(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "one"), (6, "a b c d e f g h i j"), (6, "entirely other words in this one"),
            (7, "entirely other words in this one"), (7, "entirely other words in this one"), (None, "one"), (None, "nameless")]
    got = M.near_classes(docs_of(rows)).collect()
    by = {(r.doc_id): r.class_id for r in got if r.doc_id is not None}
    assert len(got) == len(rows)
    assert by[1] == by[2] == 1 and by[3] == 3 and by[4] == by[5] == 4 and by[6] == by[7] == 6
    assert sorted(r.class_size for r in got if r.doc_id is None) == [1, 3]
    kept = M.near_representatives(docs_of(rows, extra=True)).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3, 4, 6]
    assert M.near_classes(docs_of(rows).limit(0)).count() == 0
    assert M.near_representatives(docs_of(rows).limit(0)).count() == 0


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 2), (7, 7)]
    got = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {5: 2, 9: 2, 2: 2, 7: 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(12)
    for n, size in ((300, 150), (900, 60), (40, 200)):
        links = [(rng.randrange(size), rng.randrange(size)) for _ in range(n)]
        frame = spark.createDataFrame(links, "a long, b long")
        got = {r.id: r.label for r in components(frame).collect()}
        want = classes_of(links, range(size))
        assert got == {i: want[i] for i in {x for pair in links for x in pair}}
        assert thinned(frame).count() <= len(set(links)) + size
    hub = [(a, 100 + b) for a in range(5) for b in range(400)]
    assert thinned(spark.createDataFrame(hub, "a long, b long")).count() == 405


def test_later_links_join_whole_components(spark):
    rng = random.Random(13)
    first, more = ([(rng.randrange(80), rng.randrange(80)) for _ in range(n)] for n in (40, 25))
    of = lambda links: spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.label for r in with_links(components(of(first)), of(more)).collect()}
    want = classes_of(first + more, range(80))
    assert all(got.get(i, i) == want[i] for i in range(80))

import hashlib
import random

from pyspark.sql import functions as F

from venuekit.llm import fingerprints as S


def test_edited_texts_follow_the_chain(spark, docs_of):
    rng = random.Random(1)
    texts = {i * 3 + 1: " ".join(rng.choice("alpha beta gamma delta épsilon ζ".split()) for _ in range(rng.randint(0, 40))) for i in range(40)}
    texts[200], texts[201] = None, "🙂" * 7
    texts[202] = texts[201]
    got = {r.doc_id: r for r in S.document_fingerprints(docs_of(list(texts.items()), extra=True)).collect()}
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    assert set(got) == set(texts)
    for i in texts:
        own, other = texts[i] or "", texts[after[i]] or ""
        edited = own[: len(own) - len(own) // 2] + other[: len(own) // 2]
        assert got[i].n_chars == len(own)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].n_within is None) == (i % 100 != 0)
    assert got[201].fingerprint == got[202].fingerprint and got[202].near_next == 1.0


def test_ranges_do_not_change_the_chain(spark):
    ids = spark.createDataFrame([(i * i,) for i in range(50)], "id long")
    one = {tuple(r) for r in S.following(ids).collect()}
    assert one == {tuple(r) for r in S.following(ids, range_rows=4).collect()}
    assert (0, 49 * 49) in one and (25, 16) in one
    assert S.following(ids.where("id = 4")).collect()[0].next_id == 4


def test_nameless_repeated_single_and_no_documents(spark, docs_of):
    rows = [(None, "lost words here"), (5, "five"), (5, "five"), (5, "other five")]
    got = S.document_fingerprints(docs_of(rows)).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 5]
    single = S.document_fingerprints(docs_of([(100, "all alone")])).collect()[0]
    assert (single.near_next, single.n_within) == (1.0, 0)
    assert S.document_fingerprints(docs_of([(1, "x")]).limit(0)).count() == 0


def test_simhash_equals_its_definition(spark):
    """Votes counted bit by bit, from the same term hashes."""
    text = "the cat and the hat and the cat"
    words = text.split()
    terms = [(words[i], words[i + 1] if i + 1 < len(words) else None) for i in range(len(words))]
    df = spark.createDataFrame(terms, "a string, b string")
    hashed = df.select(F.xxhash64("a", "b").alias("x"), F.length("a") + F.coalesce(F.length("b"), F.lit(0))).withColumn("y", F.xxhash64("x"))
    votes = [0] * 128
    for x, weight, y in hashed.collect():
        for i in range(64):
            votes[i] += weight if x >> i & 1 else -weight
            votes[64 + i] += weight if y >> i & 1 else -weight
    high = sum(1 << i for i in range(64) if votes[i] > 0)
    low = sum(1 << i for i in range(64) if votes[64 + i] > 0)
    got = S.simhash(spark.createDataFrame([(1, text)], "id int, text string"), ["id"]).first()
    assert (got.high % 2**64, got.low % 2**64) == (high, low)


def test_likeness_follows_the_change(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(400)]
    rows = [(n, " ".join([*base[: 400 - n], *[rng.choice(words) for _ in range(n)]])) for n in (0, 20, 100, 200, 400)]
    got = {r.id: (r.high, r.low) for r in S.simhash(spark.createDataFrame(rows, "id int, text string"), ["id"]).collect()}
    near = {n: 1 - sum((a ^ b).bit_count() if (a ^ b) >= 0 else ((a ^ b) % 2**64).bit_count() for a, b in zip(got[0], got[n], strict=True)) / 128 for n in got}
    assert near[0] == 1 and near[20] > near[100] > near[400] and near[200] > near[400] and near[400] < 0.65


def test_radius_search_equals_brute_force(spark):
    rng = random.Random(4)
    prints = []
    for _ in range(60):
        x = rng.getrandbits(128)
        prints.append(x)
        prints += [x ^ sum(1 << b for b in rng.sample(range(128), k)) for k in (1, 2, 3, 4, 5)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = [(signed(p >> 64), signed(p & (2**64 - 1))) for p in prints]
    df = spark.createDataFrame([*rows, rows[0]], "high long, low long")
    asked = df.limit(40)
    ask = [tuple(r) for r in asked.collect()]
    whole = lambda r: (r[0] % 2**64 << 64) | r[1] % 2**64
    for radius, blocks in ((3, 4), (3, 6), (2, 5), (0, 1)):
        wanted = {(*q, *p, (whole(q) ^ whole(p)).bit_count()) for q in ask for p in rows if (whole(q) ^ whole(p)).bit_count() <= radius}
        got = [tuple(r) for r in S.within_radius(spark.createDataFrame(ask, "high long, low long"), df, radius, blocks).collect()]
        assert set(got) == wanted and len(got) == len(wanted)


def test_no_python_in_the_plan(spark, docs_of):
    plan = S.document_fingerprints(docs_of([(1, "a b"), (2, "c d")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

import random

import pytest
from tokenizers import Tokenizer

from venuekit.llm import bpe

PIECES = ["the", " ", "  ", "\n", "'s", "'re", "'", "é", "漢字", "aaaa", "12", "!!", "<|endoftext|>", "<|", "\t", " a", "ß", "🙂", "://"]


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(bpe.vocabulary_file())


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.vocabulary_file())


def test_tree_of_joins_equals_encoding_at_once(own, codec):
    rng = random.Random(6)
    for n in range(1500):
        some = PIECES if n % 2 else rng.sample(PIECES, 3)
        text = "".join(rng.choice(some) for _ in range(rng.randint(1, 120)))
        wanted = own.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == wanted
        step = rng.choice([3, 7, 20, 50])
        level = [(codec.encode(p), p.encode()) for p in (text[i : i + step] for i in range(0, len(text), step))]
        while len(level) > 1:
            up = [(codec.join(*a, *b), a[1] + b[1]) for a, b in zip(level[::2], level[1::2], strict=False)]
            level = up + ([level[-1]] if len(level) % 2 else [])
        assert level[0][0] == wanted, text


def test_round_trip_of_short_and_long_texts(spark, docs_of, own):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 3, 40, 400, 3000])))) for i in range(60)]
    rows += [(60, "x" * 5000), (61, "漢" * 3000), (62, None), (62, "again"), (63, rows[59][1] + " long" * 900), (63, rows[59][1] + " long" * 900), (None, "no id " * 500)]
    docs = docs_of(rows, extra=True)
    got = bpe.decode(bpe.encode(docs, piece_chars=256)).collect()
    assert len(got) == len(rows)
    texts = sorted(((r.doc_id if r.doc_id is not None else -1), r.text, tuple(r.ids)) for r in got)
    wanted = sorted(((i if i is not None else -1), t or "", tuple(own.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert texts == wanted
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def test_digest(spark):
    import hashlib

    df = spark.createDataFrame([([5, 60, 7],), ([],)], "ids array<int>")
    assert [r[0] for r in df.select(bpe.ids_digest(df.ids)).collect()] == [hashlib.sha256(x).hexdigest() for x in (b"5,60,7", b"")]

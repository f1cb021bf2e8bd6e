import random

from tests.llm.test_alignment import plain
from venuekit.llm import lines




def near(a, b, max_edits=2, per=20):
    limit = min(max_edits, min(len(a), len(b)) // per)
    return a != b and abs(len(a) - len(b)) <= limit and plain(a, b) <= limit


def edit(rng, line):
    out = list(line)
    for _ in range(rng.randint(0, 3)):
        i, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.4:
            out[i] = rng.choice("abcdé")
        elif kind < 0.7:
            del out[i]
        else:
            out.insert(i, rng.choice("abcdé"))
    return "".join(out)


def test_links_and_drops_equal_brute_force(spark, docs_of):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([5, 15, 19, 20, 21, 39, 40, 41, 42, 60, 130]))).strip() or "x" for _ in range(60)]
    texts = []
    for i in range(120):
        picked = [edit(rng, rng.choice(base)) if rng.random() < 0.7 else rng.choice(base) for _ in range(rng.randint(1, 5))]
        texts.append((i, "\n".join([*picked, "", "  "])))
    got = {r.doc_id: r for r in lines.line_decisions(docs_of(texts)).collect()}
    all_lines = [(d, p, x) for d, t in texts for p, x in enumerate(t.split("\n")) if x.strip()]
    distinct = sorted({x for _, _, x in all_lines})
    links = {x: [y for y in distinct if near(x, y)] for x in distinct}
    first = {}
    for d, p, x in all_lines:
        first.setdefault(x, (d, p))
    assert any(links.values())
    for d, t in texts:
        mine = [(p, x) for dd, p, x in all_lines if dd == d]
        gone = [p for p, x in mine if first[x] != (d, p) or any(first[y] < first[x] for y in links[x])]
        assert list(got[d].dropped) == gone, d
        assert got[d].n_lines == len(mine) and got[d].n_links == sum(len(links[x]) for _, x in mine)


def test_dedup_keeps_blank_texts_and_drops_emptied_ones(spark, docs_of):
    line = "this very line is in many documents of the corpus"
    rows = [(1, f"{line}\nown one\n\n{line}"), (2, line), (3, f"two\n{line}!"), (4, None), (5, ""), (6, "\n \n"), (None, f"{line}\nlast"), (1, f"{line}\nother text")]
    got = {(r.doc_id, r.text): r.n_chars for r in lines.dedup_lines(docs_of(rows, extra=True)).collect()}
    texts = {t for _, t in got}
    assert (4, None) in got and (5, "") in got and (6, "\n \n") in got
    assert not any(d == 2 for d, _ in got)  # its only line is an earlier one's
    assert (3, "two") in got and (None, "last") in got
    assert sum((t or "").count(line) for t in texts) == 1
    assert all(n == len(t) for (_, t), n in got.items() if t and t.strip())
    again = lines.dedup_lines(docs_of(rows).union(docs_of(rows[:1])))
    assert again.count() == len(rows)  # a repeated row keeps what its double keeps
    assert lines.dedup_lines(docs_of(rows).limit(0)).count() == 0

"""Periodic runs of words: a suffix automaton whose link tree tells, by link-cut access, how long ago each suffix last ended."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.llm.batches import slices, tidy

WORD = r"[^\x20\x09-\x0D]+"
MIN_LENGTH = 24
MIN_EXPONENT = 3

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def suffix_automaton(words) -> tuple[array, array, array]:
    """(length, link, states): the longest string and the suffix link of each state, and the state of each prefix.

    State 0 is the empty string. Most states have one way on, which is held in two flat arrays; further ones are in dicts.
    """
    length, link = array("i", [0]), array("i", [-1])
    word, to, more = array("i", [-1]), array("i", [0]), {}
    states, last = array("i"), 0
    for w in words:
        new, p, q = len(length), last, -1
        length.append(length[last] + 1)
        link.append(0)
        word.append(-1)
        to.append(0)
        while p >= 0:
            if word[p] == w:
                q = to[p]
                break
            if word[p] < 0:
                word[p], to[p] = w, new
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {w: new}
                elif w in others:
                    q = others[w]
                    break
                else:
                    others[w] = new
            p = link[p]
        if q >= 0:
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                word.append(word[q])
                to.append(to[q])
                if q in more:
                    more[copy] = more[q].copy()
                link[q] = link[new] = copy
                while p >= 0:
                    if word[p] == w:
                        if to[p] != q:
                            break
                        to[p] = copy
                    elif p in more and more[p].get(w) == q:
                        more[p][w] = copy
                    else:
                        break
                    p = link[p]
        last = new
        states.append(new)
    return length, link, states


def squares(words) -> Iterator[tuple[int, int]]:
    """(end, period) of every square of a primitive root, by end: the last ``2 period`` words up to ``end`` are one stretch
    twice.

    The suffixes of a prefix are the path from its state to the root of the link tree. A path whose strings last ended at one
    place has one colour, that place, and is one splay tree, of which the root holds the colour. An appended word gives its
    whole path a new colour, one segment after another. Strings of a segment ended ``now - colour`` words ago, and if the
    segment holds one of just that length, it stands twice in a row.
    """
    length, up, states = suffix_automaton(words)
    left, right, colour = (array("i", [-1]) * len(length) for _ in range(3))

    def rotate(x: int, y: int) -> None:
        """Lift ``x`` above its parent ``y``."""
        z = up[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b >= 0:
            up[b] = y
        if z > 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        up[x], up[y] = z, x

    for now, state in enumerate(states):
        x, below = state, -1
        while x > 0:
            # splay: x becomes the root of its tree, and what is right of it lies below it on the path
            y = up[x]
            while y > 0 and (left[y] == x or right[y] == x):
                z = up[y]
                if z > 0 and (left[z] == y or right[z] == y):
                    colour[x] = colour[z]
                    if (left[z] == y) == (left[y] == x):
                        rotate(y, z)
                    else:
                        rotate(x, y)
                        y = z
                        rotate(x, y)
                        y = up[x]
                        continue
                else:
                    colour[x] = colour[y]
                rotate(x, y)
                y = up[x]
            seen = colour[x]
            if right[x] >= 0:
                colour[right[x]] = seen
            right[x] = below
            if seen >= 0 and length[y] < now - seen <= length[x]:
                yield now, now - seen
            below, x = x, y
        if below >= 0:
            colour[below] = now


def _stretches(ids, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """(begin, end) outside of which there is no run.

    In a run every stretch of ``gram`` words stands a second time one period away, and a period is at most the run's length
    by ``min_exponent``. Equal stretches have equal hashes, so nothing is passed over.
    """
    import numpy as np

    # the longest for which every run has at least 2 period + gram - 1 words
    short = min_length // min_exponent
    gram = min(min_length - 2 * short, (min_exponent - 2) * (short + 1)) + 1
    if len(ids) < min_length:
        return []
    base = np.uint64(0x9E3779B97F4A7C15)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * base
    mixed ^= mixed >> np.uint64(29)
    hashes = mixed[: len(ids) - gram + 1].copy()
    for i in range(1, gram):
        hashes = hashes * base + mixed[i : len(ids) - gram + 1 + i]
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    if not len(same):
        return []
    away = order[same + 1] - order[same]
    nearest = np.full(len(hashes), len(ids), dtype=np.int64)
    np.minimum.at(nearest, order[same + 1], away)
    np.minimum.at(nearest, order[same], away)
    found, open_ = [], [(0, len(ids))]
    while open_:
        begin, end = open_.pop()
        room = nearest[begin : end - gram + 1] * min_exponent <= end - begin
        edges = np.flatnonzero(np.diff(np.concatenate([[False], room, [False]]).astype(np.int8)))
        for b, e in zip(edges[::2], edges[1::2], strict=True):
            b, e = begin + int(b), begin + int(e) + gram - 1
            if e - b >= min_length:
                (found if (b, e) == (begin, end) else open_).append((b, e))
    return sorted(found)


def _last_equal(ids, at: int, period: int) -> int:
    """The first place from ``at`` on whose word differs from the one a period before it."""
    import numpy as np

    step = 64
    while at < len(ids):
        differ = np.flatnonzero(ids[at : at + step] != ids[at - period : min(len(ids), at + step) - period])
        if len(differ):
            return at + int(differ[0])
        at += step
        step *= 4
    return len(ids)


def runs_of(ids, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a numpy array of word numbers, by start and period."""
    found = []
    for begin, end in _stretches(ids, min_length, min_exponent):
        part = ids[begin:end]
        until: dict[int, int] = {}
        for last, period in squares(part.tolist()):
            if until.get(period, -1) > last:
                continue
            # the first square of a run begins where the run begins
            start, stop = last - 2 * period + 1, _last_equal(part, last + 1, period)
            until[period] = stop
            if stop - start >= max(min_length, min_exponent * period):
                found.append((begin + start, stop - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _finder(keep: tuple[str, ...], min_length: int, min_exponent: int):
    def find(batches):
        import re

        import numpy as np
        import pyarrow as pa

        words_of = re.compile(WORD).findall
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

        def examined(text: str | None) -> tuple:
            words = words_of(text or "")
            index: dict = {}
            number = index.setdefault
            ids = np.array([number(w, len(index)) for w in words], dtype=np.int32)
            runs = runs_of(ids, min_length, min_exponent)
            stays = np.ones(len(words), dtype=bool)
            for start, length, period in runs:
                stays[start + period : start + length] = False
            kept = " ".join(words) if not runs else " ".join(words[i] for i in np.flatnonzero(stays))
            return len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], kept

        for batch in batches:
            for part in slices(batch):
                made = [examined(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array([m[0] for m in made], pa.int64()),
                     pa.array([m[1] for m in made], kind), pa.array([m[2] for m in made], pa.string())],
                    names=[*keep, "n_words", "runs", "collapsed"],
                )

    return tidy(find)


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep``, n_words, runs and collapsed of every whole text.

    A run is a stretch of words with smallest period q, words q apart being equal, of at least ``max(min_length,
    min_exponent * q)`` words, that no neighbouring word extends with that period. Words are what is between blanks, tabs
    and line breaks, and are numbered from 0. collapsed is the text, words one space apart, without the words of a run after
    its first q.

    A null text is an empty one: no words, no runs. Rows that repeat are treated alike. Each row is a task's own work, so
    nothing is shuffled. Memory: a text's words, and about 150 bytes for each word of its longest stretch that recurs near by;
    time: words by the logarithm of that stretch. Texts in which no nine words stand twice never reach the automaton.
    """
    if min_exponent < 2:
        raise ValueError("a run holds its root twice at least")
    kinds = dict(docs.dtypes)
    columns = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(
        _finder(keep, min_length, min_exponent), f"{columns}, n_words bigint, runs {RUNS}, collapsed string"
    )


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period, then the smallest start, then the smallest period; null without runs."""

    def better(best: Column, run: Column) -> Column:
        mine, its = run["length"] * best["period"], best["length"] * run["period"]
        earlier = (run["start"] < best["start"]) | ((run["start"] == best["start"]) & (run["period"] < best["period"]))
        return F.when(best.isNull() | (mine > its) | ((mine == its) & earlier), run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by the checksum of its doc_id, gets a periodic end; a null doc_id gets none."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    marked = docs.select("doc_id", "text", crc.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    placed = marked.withColumn("a", F.when(n > 0, F.pmod(g, n))).withColumn(
        "p", 1 + F.floor((n - F.col("a")) / (3 + g % 8))
    )
    back = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    edited = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get(F.col("words"), back(i))))
    return placed.select("doc_id", F.when(n > 0, F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """What the query returns of ``periodic_runs``."""
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}") for c in ("start", "length", "period")],
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

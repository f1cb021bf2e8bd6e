"""Near-duplicates by Order MinHash: samples of minimum k-mers in text order, verified by banded alignment."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.llm.alignment import within
from venuekit.llm.batches import slices, tidy
from venuekit.llm.graph import components, labelled, with_links
from venuekit.session import discard, materialize

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 32
SAMPLE = 2
#: functions of which the smallest hash alone is a sample too
SINGLES = 18
#: texts of at most so many words are sampled by shingles of so many words as well
SHORT_TEXT, SHORT_SHINGLE = 24, 2
STAR_ROUNDS = 2
#: cells in which bags of words are compared, first these, then those; texts of at most so many words are then aligned as
#: numbers of 16 bits
CELLS, FINE_CELLS, WORD_BY_WORD = 256, 2048, 1 << 16
#: members of a bucket, and their words, that meet in one go; words that a task keeps told apart meanwhile; what a row costs
#: besides its words, in words
BLOCK = 8192
BLOCK_WORDS = 1 << 23
HELD_WORDS = 1 << 20
ROW_WORDS = 32
#: one text of a large bucket in so many, but about so many texts, is looked at for frequent words; so many words are kept at most
WORD_SHARE, WORD_SAMPLE, FREQUENT = 64, 512, 1 << 17


def _sketcher(shingle: int, sketches: int, sample: int):
    """Samples and word bags of batches of texts; the other columns come along."""

    def sketch(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        seeds = np.array([xxhash.xxh3_64_intdigest(b"order", seed=i) | 1 for i in range(2 * sketches)], dtype=np.uint64)
        factor, mixer = seeds[:sketches, None], seeds[sketches:]
        base = np.uint64(0x9E3779B97F4A7C15)
        half = np.uint64(29)

        class Words(dict):
            def __missing__(self, word):
                if len(self) > 500_000:
                    self.clear()
                value = self[word] = xxhash.xxh3_64_intdigest(word)
                return value

        words = Words()

        def grams(ids, k: int):
            """A number for each occurrence of a k-mer, in text order: equal k-mers differ by their count so far."""
            k = min(k, len(ids))
            out = ids[: len(ids) - k + 1].copy()
            for i in range(1, k):
                out = out * base + ids[i : len(ids) - k + 1 + i]
            out ^= out >> half
            order = np.argsort(out, kind="stable")
            ranked = out[order]
            fresh = np.empty(len(out), dtype=bool)
            fresh[0] = True
            np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
            if not fresh.all():
                place = np.arange(len(out))
                nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
                out[order] += nth.astype(np.uint64) * mixer[0]
            return out

        def bag(ids):
            """The words as numbers of 16 bits in text order, or, for very long texts, how often each number comes: never
            further from another text's than the words are."""
            short = (ids >> np.uint64(32)).astype(np.uint16)
            if len(ids) <= WORD_BY_WORD:
                return short.tobytes()
            return np.minimum(np.bincount(short, minlength=1 << 16), 65535).astype(np.uint16).tobytes()

        def mixed(chosen, seed):
            """A number for each row of hashes, in their order."""
            for j in range(chosen.shape[1]):
                seed = (seed ^ chosen[:, j]) * base
                seed ^= seed >> half
            return seed

        def minima(out, ordered: int, alone: int):
            """The smallest ``sample`` hashes of each of the first ``ordered`` functions in text order, as a number; then the
            smallest hash of each of the first ``alone``."""
            short, single = [], []
            take = min(sample, len(out))
            chunk = max(1, (1 << 18) // len(out))
            used = max(ordered, alone)
            for i in range(0, used, chunk):
                values = out[None, :] * factor[i : min(used, i + chunk)]
                values ^= values >> half
                values *= base
                if take < len(out):
                    at = np.argpartition(values, take - 1, axis=1)[:, :take]
                else:
                    at = np.repeat(np.arange(take)[None, :], len(values), axis=0)
                short.append(mixed(out[np.sort(at, axis=1)], mixer[i : min(used, i + chunk)]))
                least = np.take_along_axis(values, at, axis=1).argmin(axis=1)
                single.append(out[at[np.arange(len(at)), least]])
            return np.concatenate([np.concatenate(short)[:ordered], np.concatenate(single)[:alone]]).view(np.int64)

        def samples(ids):
            """All samples of a text; those of its short shingles come last."""
            found = minima(grams(ids, shingle), sketches, min(SINGLES, sketches))
            if len(ids) > SHORT_TEXT:
                return found
            return np.concatenate([found, minima(grams(ids, SHORT_SHINGLE), 0, min(SINGLES, sketches))])

        for part in (part for batch in batches for part in slices(batch)):
            counts, found, bags = [], [], []
            for text in part.column("text").to_pylist():
                ids = np.array([words[w] for w in text.split()], dtype=np.uint64)
                counts.append(len(ids))
                found.append(samples(ids) if len(ids) else np.zeros(0, np.int64))
                bags.append(bag(ids))
            made = [pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(bags, pa.binary())]
            kept = ["doc_id", "own", "t1", "t2"]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept], *made], names=[*kept, "n_words", "sketch", "bag"]
            )

    return tidy(sketch)


def _near(a: list, b: list, similarity: float) -> bool:
    """Whether two lists of words are near by alignment."""
    most = max(len(a), len(b))
    limit = int((1 - similarity) * most + 1e-9)
    # edits change at most as many words of the larger bag
    if abs(len(a) - len(b)) > limit or most - sum((Counter(a) & Counter(b)).values()) > limit:
        return False
    return within(a, b, limit) <= limit


def _candidates(similarity: float, spanning: bool):
    """Pairs (a, b) of the members of a group that have different labels and are near by their words as numbers of 16 bits.

    Rows come sorted by group. Those of side 2 meet each other, those of side 0 meet those of side 1. ``spanning`` leaves
    out pairs whose labels the pairs before them join already, so a group makes fewer pairs than it has members. Numbers are
    aligned here; of texts longer than ``WORD_BY_WORD`` only the bags are compared.
    """

    def find(batches):
        import numpy as np

        def cells(bag: bytes, n: int):
            words = np.frombuffer(bag, np.uint16)
            if n > WORD_BY_WORD:
                found = words.reshape(-1, FINE_CELLS).sum(axis=0, dtype=np.int64)
            else:
                found = np.bincount(words % FINE_CELLS, minlength=FINE_CELLS)
            return [np.minimum(x, 255).astype(np.uint8) for x in (found.reshape(-1, CELLS).sum(axis=0), found)]

        def counted(bag: bytes, n: int):
            """How often each number comes in a text."""
            words = np.frombuffer(bag, np.uint16)
            found = words if n > WORD_BY_WORD else np.minimum(np.bincount(words, minlength=1 << 16), 65535)
            return found.astype(np.int32)

        def numbered(bag: bytes):
            """The words of a text, equal ones told apart by their count so far."""
            words = np.sort(np.frombuffer(bag, np.uint16)).astype(np.int64)
            first = np.searchsorted(words, words)
            return words * (WORD_BY_WORD + 1) + np.arange(len(words)) - first

        known: dict = {}

        def apart(x, p, y, q):
            u, v = x[p], y[q]
            return (np.maximum(u, v) - np.minimum(u, v)).sum(axis=1, dtype=np.uint32)

        def similar(x, y, same):
            """Places in ``x`` and ``y``, which are sorted by length, with similar lengths and cells."""
            n_x, n_y = x["n"], y["n"]
            for i in range(0, len(n_x), 64):
                n = n_x[i : i + 64]
                low = np.searchsorted(n_y, similarity * n[0] - 1e-6)
                high = np.searchsorted(n_y, n[-1] / similarity + 1e-6, "right") if similarity > 0 else len(n_y)
                low = max(low, i) if same else low
                m = n_y[low:high]
                most = np.maximum(n[:, None], m)
                limit = ((1 - similarity) * most + 1e-9).astype(np.int64)
                ok = (np.abs(n[:, None] - m) <= limit) & (x["label"][i : i + 64, None] != y["label"][low:high])
                left, right = np.nonzero(ok)
                # an insertion or deletion moves a bag by one, a replaced word by two
                spare = (2 * limit - 2 * most + n[:, None] + m)[left, right]
                for j in range(0, len(left), 8192):
                    p, q = i + left[j : j + 8192], low + right[j : j + 8192]
                    keep = np.flatnonzero(apart(x["cells"], p, y["cells"], q) <= spare[j : j + 8192])
                    for k in range(0, len(keep), 1024):
                        some = keep[k : k + 1024]
                        some = some[apart(x["fine"], p[some], y["fine"], q[some]) <= spare[j + some]]
                        yield from zip(p[some].tolist(), q[some].tolist(), strict=True)

        def pairs(group):
            above: dict = {}
            split: dict = {}
            held_words = 0

            def name(k):
                while k in above:
                    k = above[k]
                return k

            def words(side, at):
                found = split.get((side["key"], at))
                if found is None:
                    nonlocal held_words
                    held_words += int(side["n"][at])
                    if held_words > HELD_WORDS:
                        split.clear()
                        held_words = int(side["n"][at])
                    found = split[side["key"], at] = numbered(side["bag"][at])
                return found

            def close(x, i, y, j):
                """Whether the numbers are near: first without their order, then by alignment."""
                n, m = int(x["n"][i]), int(y["n"][j])
                most = max(n, m)
                limit = int((1 - similarity) * most + 1e-9)
                if most > WORD_BY_WORD:
                    moved = np.abs(counted(x["bag"][i], n) - counted(y["bag"][j], m)).sum(dtype=np.int64)
                    return moved <= 2 * limit - abs(n - m)
                shared = len(np.intersect1d(words(x, i), words(y, j), assume_unique=True))
                if most - shared > limit:
                    return False
                one, two = (np.frombuffer(bag, np.uint16).tolist() for bag in (x["bag"][i], y["bag"][j]))
                return within(one, two, limit) <= limit

            def near(x, i, y, j):
                """The same, remembered: most pairs meet in several groups."""
                a, b = int(x["id"][i]), int(y["id"][j])
                pair = (a, b) if a < b else (b, a)
                found = known.get(pair)
                if found is None:
                    if len(known) >= 100_000:
                        known.clear()
                    found = known[pair] = close(x, i, y, j)
                return found

            order = np.argsort(group["n"], kind="stable")
            sides = {}
            for k in (0, 1, 2):
                at = order[group["side"][order] == k]
                if len(at):
                    sides[k] = {c: v[at] for c, v in group.items()} | {"key": k}
                    both = [cells(b, n) for b, n in zip(sides[k]["bag"], sides[k]["n"], strict=True)]
                    sides[k] |= {c: np.stack(v) for c, v in zip(("cells", "fine"), zip(*both, strict=True), strict=True)}
            for p, q in ((2, 2), (0, 1)):
                if p not in sides or q not in sides:
                    continue
                x, y = sides[p], sides[q]
                for i, j in similar(x, y, p == q):
                    one, two = name(int(x["label"][i])), name(int(y["label"][j]))
                    if one == two or not near(x, i, y, j):
                        continue
                    if spanning:
                        above[max(one, two)] = min(one, two)
                    a, b = int(x["id"][i]), int(y["id"][j])
                    yield min(a, b), max(a, b)

        def groups():
            """Each group whole, though batches cut through them."""
            held = None
            for rows in batches:
                if not len(rows):
                    continue
                columns = {c: rows[c].to_numpy() for c in ("grp", "side", "id", "label", "n", "bag")}
                if held is not None:
                    columns = {c: np.concatenate([held[c], v]) for c, v in columns.items()}
                key = columns["grp"]
                cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
                for i, j in zip(cuts, cuts[1:], strict=False):
                    yield {c: v[i:j] for c, v in columns.items()}
                held = {c: v[cuts[-1] :] for c, v in columns.items()}
            if held is not None:
                yield held

        made: set = set()
        for group in groups():
            if (group["label"] != group["label"][0]).any():
                made.update(pairs(group))
            if len(made) >= 10_000:
                yield pd.DataFrame(sorted(made), columns=["a", "b"])
                made.clear()
        if made:
            yield pd.DataFrame(sorted(made), columns=["a", "b"])

    return tidy(find)


def _cells(members: DataFrame, similarity: float, block: int) -> tuple[Column, DataFrame]:
    """The class of length of a member, and (bucket, cells, by_cells, by_words) of the buckets that are too large for one group:
    the number of cells of each class, and the words that all rows have if the bucket's members meet by cells, or by rare words.

    Classes are a little wider than the lengths may differ, so near texts are never two classes apart.
    """
    width = math.log(1 / max(similarity, 0.01) * (1 + 1e-6))
    c = F.floor(F.log(F.col("n").cast("double")) / width).cast("int")
    size = (F.col("n") + ROW_WORDS).cast("double")
    counts = members.select("bucket", "n", c.alias("c")).groupBy("bucket", "c").agg(
        F.greatest(F.count(F.lit(1)) / block, F.sum("n") / BLOCK_WORDS).alias("load"), F.sum(size).alias("size"),
        F.sum(size * (F.floor((1 - similarity) * F.col("n") + 1e-9) + 1)).alias("by_words"),
    )
    each = F.collect_list(F.struct("c", F.ceil("load").cast("int").alias("k"), "size"))
    large = counts.groupBy("bucket").agg(F.sum("load").alias("all"), F.sum("by_words").alias("by_words"), each.alias("each")).where("all > 1")
    cells = F.map_from_entries(F.transform("each", lambda x: F.struct(x.c, x.k)))
    of = lambda k: F.coalesce(F.element_at("cells", k), F.lit(0))
    met = F.aggregate("each", F.lit(0.0), lambda total, x: total + x.size * (of(x.c - 1) + of(x.c) + of(x.c + 1)))
    return c, large.withColumn("cells", cells).select("bucket", "cells", met.alias("by_cells"), "by_words")


def _grouped(members: DataFrame, similarity: float, block: int) -> DataFrame:
    """(grp, side) and the columns of ``members`` but bucket, which has bucket, id, n (its length) and others: every two members
    of a bucket whose lengths are similar meet in one group.

    A bucket of up to ``block`` members and ``BLOCK_WORDS`` words is one group. A larger one is cut into classes of length and
    these, by a hash, into cells of about that size; two cells of the same or of neighbouring classes are a group.
    """
    length, large = _cells(members, similarity, block)
    hot, members = large.select("bucket", "cells"), members.withColumn("c", length)
    c, own = F.col("c"), F.col("own_cell")
    cells_of = lambda k: F.coalesce(F.element_at("cells", k), F.lit(0))
    none = F.array().cast("array<struct<grp:bigint,side:int>>")

    def with_cells(k, key, side):
        """A row's groups with every cell of class ``k``."""
        made = F.transform(F.sequence(F.lit(0), cells_of(k) - 1), lambda i: F.struct(key(i).alias("grp"), side(i).alias("side")))
        return F.when(cells_of(k) > 0, made).otherwise(none)

    name = lambda c1, i1, c2, i2: F.xxhash64("bucket", c1, i1, c2, i2)
    within_class = with_cells(
        c, lambda i: name(c, F.least(own, i), c, F.greatest(own, i)),
        lambda i: F.when(i == own, 2).when(own < i, 0).otherwise(1),
    )
    longer = with_cells(c + 1, lambda i: name(c, own, c + 1, i), lambda i: F.lit(0))
    shorter = with_cells(c - 1, lambda i: name(c - 1, i, c, own), lambda i: F.lit(1))
    alone = F.array(F.struct(F.col("bucket").alias("grp"), F.lit(2).alias("side")))
    placed = members.join(hot, "bucket", "left").withColumn("own_cell", F.pmod(F.xxhash64("id"), F.greatest(cells_of(c), F.lit(1))).cast("int"))
    met = placed.withColumn("at", F.explode(F.when(F.col("cells").isNull(), alone).otherwise(F.concat(within_class, longer, shorter))))
    return met.select("at.grp", "at.side", *[x for x in members.columns if x not in ("bucket", "c")])


def _numbered(text: str) -> list[int]:
    """The words of a text as numbers, equal ones told apart by their count so far."""
    import xxhash

    seen: Counter = Counter()
    out = []
    for word in text.split():
        seen[word] += 1
        out.append(xxhash.xxh3_64_intdigest(word, seed=seen[word]) - (1 << 63))
    return out


def _word_counts(batches):
    """(word, texts) of a batch of texts."""
    for rows in batches:
        found = Counter(word for text in rows.text for word in _numbered(text))
        yield pd.DataFrame({"word": list(found), "texts": list(found.values())}, dtype="int64")


def _rarest(similarity: float, frequent: list[int]):
    """(bucket, id, own): the rarest words of each text, one more than may differ between near texts."""

    def rarest(batches):
        # the list begins with the most frequent
        place = {word: len(frequent) - i for i, word in enumerate(frequent)}
        for rows in batches:
            made = []
            for key, own, text in zip(rows.id, rows.own, rows.text, strict=True):
                words = sorted(_numbered(text), key=lambda w: (place.get(w, 0), w))
                made += [(w, key, own) for w in words[: int((1 - similarity) * len(words) + 1e-9) + 1]]
            yield pd.DataFrame(made, columns=["bucket", "id", "own"], dtype="int64")

    return tidy(rarest)


def _by_rare_words(rows: DataFrame, texts: DataFrame, similarity: float, block: int) -> DataFrame:
    """``rows`` (bucket, id, own) with large buckets replaced by buckets of rare words, in which their near members meet too,
    where that makes less to shuffle than the bucket's cells: cells are as many as its blocks, rare words as many as a share
    of each text's words, so long texts meet by cells unless their bucket is very large.

    Of the words of the longer of two near texts all but a share 1 - ``similarity`` are in both. So, in whatever order of
    words, one word is among the first of both, if one more than may differ is taken of each. Frequent words come last in
    the order; the list of them affects only the order.
    """
    _, large = _cells(rows.join(texts.select("id", "n"), "id"), similarity, block)
    large = materialize(large.where("by_words < by_cells").select("bucket"), "large")
    if large.isEmpty():
        discard(large)
        return rows
    members = materialize(rows.join(large, "bucket", "left_semi").select("id").distinct().join(texts, "id").select("id", "own", "text"), "members")
    share = max(1, min(WORD_SHARE, members.count() // WORD_SAMPLE))
    sample = members.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).select("text")
    counts = sample.mapInPandas(tidy(_word_counts), "word bigint, texts bigint").groupBy("word").agg(F.sum("texts").alias("texts"))
    frequent = [r.word for r in counts.where("texts > 1").orderBy(F.desc("texts"), "word").limit(FREQUENT).collect()]
    words = members.mapInPandas(_rarest(similarity, frequent), "bucket bigint, id bigint, own bigint")
    made = materialize(rows.join(large, "bucket", "left_anti").select("bucket", "id", "own").unionByName(words), "buckets")
    discard(large, members)
    return made


def _aligned(similarity: float):
    """Keep (a, b, own_a, own_b) of pairs whose word lists are near by alignment."""

    def check(batches):
        for rows in batches:
            near = [_near(x.split(), y.split(), similarity) for x, y in zip(rows.text_a, rows.text_b, strict=True)]
            yield rows.loc[pd.Series(near, index=rows.index, dtype=bool), ["a", "b", "own_a", "own_b"]]

    return tidy(check)


def near_classes(
    docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, sketches: int = SKETCHES, sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, class_id, class_size): the class of every document, named by its smallest doc_id, and its number of rows.

    Two texts are near if at most a share 1 - ``similarity`` of the words of the longer one must be inserted, deleted or
    replaced to get the other. Every candidate is verified by banded alignment of the whole texts, and classes are the
    connected components of the links. Each of ``sketches`` functions hashes the ``shingle``-word shingles, each labelled by
    its occurrence number, and samples the smallest ``sample`` of them, in text order; for texts that differ much, the
    smallest alone of ``SINGLES`` functions is a sample too, and for short texts that of their ``SHORT_SHINGLE``-word shingles.
    Two texts that share a part J of their labelled shingles, in the same order, share a sample of s with a chance of about J^s.

    Texts with an equal sample share a bucket. Members of a bucket first meet one of them; those that stay apart from it meet
    one that remains. Then all members of a bucket meet that still are in different classes, however many they are, in one
    task or several: lengths and bags of words in ``CELLS`` cells are compared there, then the words themselves as numbers of
    16 bits, also in order for texts of up to ``WORD_BY_WORD``. That passes over no pair that is near, and one that is not
    gets past it only if words share a number. The pairs that join classes there are aligned by their texts; should one be
    not near after all, all pairs of its buckets follow whose classes are still apart. So two texts that are near are found
    with a chance of 0.9999 at J = 0.5, 0.99 at 0.3 and 0.98 at 0.2, which is a fifth of the words replaced at random, in a
    crowd that shares a passage too.

    Equal texts, and rows with the same doc_id, are in one class without alignment; every different text under a doc_id is
    sampled and compared. A null text is taken as empty; texts without words are near their equals only. A null doc_id stands
    for a document of its own that is named by a hash of its text. No rows: no rows.

    Scale: equal texts become one before samples are dealt. A group of n near copies costs n candidates and not n^2. A bucket
    of more than ``block`` members or ``BLOCK_WORDS`` words is replaced by buckets of the rarest words of its members, 1 and a
    fifth of the words of each, in which every near pair of it meets; so its rows grow with its members. Only where such a
    word is in as many texts again, its bucket is compared in cells of that size by as many tasks as it takes. Among n
    members of a bucket that stay in different classes, all n^2 pairs of similar length have their bags compared, inside
    tasks; these make n - 1 rows of pairs at most. There is no cap on buckets or partners.
    """
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    whole = docs.select("doc_id", text.alias("text")).withColumns(
        {"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")}
    ).withColumn("own", F.coalesce(F.col("doc_id").cast("long"), "t1"))
    kind = dict(docs.dtypes)["doc_id"]
    sketched = materialize(
        whole.select("doc_id", "own", "t1", "t2", "text").mapInArrow(
            _sketcher(shingle, sketches, sample),
            f"doc_id {kind}, own bigint, t1 bigint, t2 bigint, n_words bigint, sketch array<bigint>, bag binary",
        ),
        "sketches",
    )
    exact = sketched.groupBy("t1", "t2").agg(F.min("own").alias("rep"))
    members = materialize(sketched.select("doc_id", "own", "t1", "t2").join(exact, ["t1", "t2"]), "members")
    lowest = members.groupBy("own").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    same = members.join(lowest, "own").where("rep > low").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()

    text_key = ["own", "t1", "t2"]
    reps = members.where(F.col("own") == F.col("rep")).select(F.xxhash64(*text_key).alias("id"), *text_key).dropDuplicates(text_key)
    reps = materialize(reps, "reps")
    # rows that repeat are sampled alike, and count once in a bucket
    dealt = (
        sketched.where("n_words > 0").select(*text_key, "sketch").join(reps, text_key).dropDuplicates(text_key)
        .select("id", "own", F.posexplode("sketch").alias("nth", "x"))
        .select("id", "own", F.xxhash64("nth", "x").alias("bucket"))
    )
    shared = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    crowd = materialize(dealt.join(shared, "bucket"), "buckets")
    wanted = reps.join(crowd.select("id").distinct(), "id", "left_semi")
    sizes = sketched.select(*text_key, F.col("n_words").alias("n"), "bag").join(wanted, text_key).dropDuplicates(text_key)
    texts = whole.select(*text_key, "text").join(sizes, text_key).dropDuplicates(text_key)
    texts = materialize(texts.select("id", "own", "n", "bag", "text"), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = (texts.select(*[F.col(c).alias(x if c == "id" else f"{c}_{x}") for c in ("id", "own", "n", "text")]) for x in "ab")
        # a fixed width: the work is in the alignment, which a merge of small partitions would put into few tasks
        joined = pairs.join(a, "a").repartition(width, "b").join(b, "b").where(
            F.abs(F.col("n_a") - F.col("n_b")) <= (1 - similarity) * F.greatest("n_a", "n_b") + 1e-9
        )
        return materialize(
            joined.select("a", "b", "own_a", "own_b", "text_a", "text_b").mapInPandas(
                _aligned(similarity), "a bigint, b bigint, own_a bigint, own_b bigint"
            ),
            "links",
        )

    def owners(links: DataFrame) -> DataFrame:
        return links.select(F.least("own_a", "own_b").alias("a"), F.greatest("own_a", "own_b").alias("b"))

    discard(sketched, reps)
    stored = [members, crowd, texts]
    links, tried, apart = same, None, crowd.select("bucket", "id")
    for round_ in range(STAR_ROUNDS):
        leaders = apart.groupBy("bucket").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
        star = apart.join(leaders.select("bucket", "a"), "bucket").where(F.col("id") != F.col("a"))
        pairs = star.select("a", F.col("id").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        near = verified(pairs)
        links = links.union(owners(near))
        stored += [pairs, near]
        if round_ + 1 < STAR_ROUNDS:  # those that their leader takes in are done with this bucket
            led = star.select("bucket", "a", F.col("id").alias("b")).join(near, ["a", "b"], "left_anti")
            apart = materialize(led.select("bucket", F.col("b").alias("id")), "apart")
            stored.append(apart)
    labels, points = components(links), texts.select("id", "n", "bag")

    def unsettled(rows: DataFrame) -> DataFrame:
        """The rows, with their labels, of buckets that are not in one class."""
        placed = labelled(rows.select("bucket", "id", "own"), labels, "own", "label")
        mixed = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        return materialize(placed.join(mixed.select("bucket"), "bucket"), "open")

    first = unsettled(crowd)
    plain = first.select("bucket", "id", "own")
    by_words = _by_rare_words(plain, texts, similarity, block)
    rows = first if by_words is plain else unsettled(by_words)
    stored += [first, by_words]
    for spanning in (True, False):  # first pairs that join classes, then all where one of those was not near
        met = _grouped(rows.select("bucket", "id", "label").join(points, "id"), similarity, block)
        met = met.repartition(width, "grp").sortWithinPartitions("grp")
        found = materialize(met.mapInPandas(_candidates(similarity, spanning), "a bigint, b bigint").distinct(), "found")
        pairs = materialize(found.join(tried, ["a", "b"], "left_anti"), "pairs")
        near = verified(pairs)
        tried = tried.union(pairs)
        stored += [rows, found, pairs, near, labels]
        labels = with_links(labels, owners(near))
        wrong = found.join(near, ["a", "b"], "left_anti")
        if not spanning or wrong.isEmpty():
            break
        one, two = (rows.select("bucket", F.col("id").alias(x)) for x in "ab")
        again = one.join(wrong, "a").join(two, ["bucket", "b"]).select("bucket").distinct()
        rows = unsettled(rows.join(again, "bucket", "left_semi").select("bucket", "id", "own"))
    classed = labelled(members.select("doc_id", "own", "rep"), labels, "rep", "class_id")
    # the smallest doc_id of a class of equal texts names it, so a label is the smallest doc_id of all its members
    class_sizes = classed.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    result = materialize(classed.select("doc_id", "class_id").join(class_sizes, "class_id"), "classes")
    discard(*stored, labels)
    return result.select("doc_id", "class_id", "class_size")


def near_representatives(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class: the row with the class's own doc_id. Columns as in ``docs``.

    Rows that repeat a doc_id are one document, and one row of them stays, that of the smallest text hash, then the smallest
    in the other columns, whatever the order of the rows; a null doc_id stays if it names its class.
    """
    classes = near_classes(docs, **options)
    text = F.coalesce("text", F.lit(""))
    columns = ("doc_id", "text", "lang", "source", "n_chars")
    own = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text))
    names = classes.select("class_id").distinct()
    kept = docs.select(*columns, own.alias("own")).join(names, F.col("own") == F.col("class_id"), "left_semi")
    place = F.struct(F.xxhash64(text), F.xxhash64(F.lit(1), text), "lang", "source", "n_chars", "doc_id", F.col("text").isNull())
    first = kept.groupBy("own").agg(F.min_by(F.struct(*columns), place).alias("row"))
    return first.select(*[F.col(f"row.{c}").alias(c) for c in columns])

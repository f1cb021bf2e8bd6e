"""N-gram Jaccard join: count vectors of hashed shingles in R-trees, overlap bounded by summed minima, pairs verified exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuekit.llm.batches import tidy
from venuekit.llm.graph import components, labelled, with_links
from venuekit.llm.order_minhash import _grouped
from venuekit.llm.rtree import LEAF, CountTree, meeting, overlapping
from venuekit.session import discard, materialize

SHINGLE = 4
PERCENT = 85
#: groups of shingles, that is coordinates of a point; large sets have finer counts too, with so many shingles a group
GROUPS, IN_GROUP = 64, 4
#: members of a bucket that meet in one tree
BLOCK = 1024
#: shingles of a document's prefix that are tried first
FIRST = 4
#: one text in so many is looked at for frequent shingles; frequent is what so many of these hold; so many are kept at most
SAMPLE_SHARE, SAMPLE_LEAST, FREQUENT = 64, 4, 1 << 17
#: names of documents without a doc_id begin here
UNNAMED = 1 << 62


def _shingler(shingle: int):
    """The sorted distinct hashes of a text's shingles, from its bytes."""
    import numpy as np
    import xxhash

    class Words(dict):
        def __missing__(self, word):
            if len(self) > 500_000:
                self.clear()
            value = self[word] = xxhash.xxh3_64_intdigest(word)
            return value

    words, base = Words(), np.uint64(0x9E3779B97F4A7C15)

    def shingles(text: bytes):
        # of bytes, lower() changes A-Z only and split() parts at 0x20 and 0x09-0x0D only
        ids = np.array([words[w] for w in text.lower().split()], dtype=np.uint64)
        if not len(ids):
            return ids
        k = min(shingle, len(ids))
        out = ids[: len(ids) - k + 1].copy()
        for i in range(1, k):
            out ^= out >> np.uint64(29)
            out = out * base + ids[i : len(ids) - k + 1 + i]
        out ^= out >> np.uint64(32)
        if k < shingle:
            out += np.uint64(k)
        return np.unique(out)

    return shingles


def _hashes(shingle: int):
    """Rows (hash) of the distinct shingles of each text."""

    def hashes(batches):
        import numpy as np
        import pyarrow as pa

        shingles = _shingler(shingle)
        for batch in batches:
            for text in batch.column("text"):
                found = shingles(text.as_py()).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["hash"])

    return tidy(hashes)


def _sketcher(frequent: list[int], shingle: int, percent: int, groups: int):
    """For each text its number of shingles, the set's signature, its prefix, and its counts by group.

    Sets that overlap enough have a shingle in common in their prefixes, of whatever order: here frequent shingles come last,
    in order of frequency, and the others in order of their hashes.
    """

    def sketch(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        shingles = _shingler(shingle)
        listed = np.array(frequent, dtype=np.int64).view(np.uint64)
        place = np.argsort(listed)
        common = listed[place]
        # most shingles are not in the list: a table of leading bits tells
        leading = np.zeros(1 << 22, dtype=bool)
        leading[common >> np.uint64(42)] = True

        def prefix(found):
            take = len(found) + (-percent * len(found)) // 100 + 1
            maybe = np.flatnonzero(leading[found >> np.uint64(42)])
            if not len(maybe):
                return found[:take]
            at = np.searchsorted(common, found[maybe])
            at[at == len(common)] = 0
            listed = common[at] == found[maybe]
            hot, at = maybe[listed], at[listed]
            rare = np.delete(found, hot)[:take]
            if len(rare) == take:
                return rare
            # the list begins with the most frequent
            last = np.argsort(-place[at], kind="stable")
            return np.concatenate([rare, found[hot[last[: take - len(rare)]]]])

        def counts(found, width):
            """Counts in ``width`` groups, two bytes each; in twice as many where one does not fit."""
            while True:
                made = np.bincount((found >> np.uint64(32)).astype(np.int64) & (width - 1), minlength=width)
                if made.max() < 1 << 16:
                    return made.astype(np.uint16).tobytes()
                width *= 2

        def fine(found):
            """Counts of a large set in more groups; a small set needs none."""
            width = groups
            while width * IN_GROUP < len(found):
                width *= 2
            return counts(found, width) if width > 2 * groups else b""

        for batch in batches:
            kept = [batch.column(c) for c in ("doc_id", "own", "t1")]
            texts = batch.column("text")
            made: dict[str, list] = {c: [] for c in ("n", "s1", "s2", "prefix", "counts", "fine")}
            for text in texts:
                found = shingles(text.as_py())
                raw = found.tobytes()
                made["n"].append(len(found))
                made["s1"].append(xxhash.xxh3_64_intdigest(raw) - (1 << 63))
                made["s2"].append(xxhash.xxh3_64_intdigest(raw, seed=1) - (1 << 63))
                made["prefix"].append(prefix(found).view(np.int64) if len(found) else np.zeros(0, np.int64))
                made["counts"].append(counts(found, groups))
                made["fine"].append(fine(found))
            kinds = {"n": pa.int64(), "s1": pa.int64(), "s2": pa.int64(), "prefix": pa.list_(pa.int64())}
            kinds |= {"counts": pa.binary(), "fine": pa.binary()}
            yield pa.RecordBatch.from_arrays(
                [*kept, *[pa.array(made[c], kinds[c]) for c in kinds]], names=["doc_id", "own", "t1", *kinds]
            )

    return tidy(sketch)


def _folded(counts: bytes, width: int):
    """Counts in ``width`` groups from those in as many or more."""
    import numpy as np

    return np.frombuffer(counts, dtype=np.uint16).reshape(-1, width).sum(axis=0, dtype=np.uint32)


def _finer(percent: int):
    """Of pairs with their sizes and fine counts, those that may still overlap enough."""

    def check(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            kept = []
            for n, m, x, y in zip(*[batch.column(c).to_pylist() for c in ("n_a", "n_b", "fine_a", "fine_b")], strict=True):
                if x and y:
                    width = min(len(x), len(y)) // 2
                    most = int(np.minimum(_folded(x, width), _folded(y, width)).sum())
                    kept.append((100 + percent) * most >= percent * (n + m))
                else:
                    kept.append(True)
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in "ab"], names=["a", "b"])

    return tidy(check)


def _search(percent: int, groups: int, spanning: bool):
    """Pairs (a, b) of the members of each group that have different labels and may overlap enough, from R-trees.

    Rows come sorted by group. Those of side 2 meet each other, those of side 0 meet those of side 1. A pair is passed over
    where the shingle that it has in common there stands too far behind to be its first. ``spanning`` leaves out pairs whose
    labels the pairs before them would already join.
    """

    def search(batches):
        import numpy as np
        import pyarrow as pa

        def met(x, y, n, label, slack, counts, same):
            """(i, j, bound) of the places ``x`` and ``y``, from a tree of each; few points are one leaf."""
            if max(len(x), len(y)) <= LEAF:
                found = [meeting(counts[x], n[x], label[x], counts[y], n[y], label[y], percent, same)]
            else:
                tree = CountTree(counts[x], n[x], label[x])
                found = overlapping(tree, tree if same else CountTree(counts[y], n[y], label[y]), percent)
            for i, j, bound in found:
                i, j = x[i], y[j]
                near = slack[i] + slack[j] >= 0
                if near.any():
                    yield i[near], j[near], bound[near]

        def pairs(id_, side, label, n, slack, counts):
            x, y, z = (np.flatnonzero(side == k) for k in (0, 1, 2))
            above: dict[int, int] = {}

            def name(k):
                while k in above:
                    k = above[k]
                return k

            for p, q, same in ((z, z, True), (x, y, False)):
                if not len(p) or not len(q):
                    continue
                for i, j, bound in met(p, q, n, label, slack, counts, same):
                    if not spanning:
                        yield id_[i], id_[j]
                        continue
                    for k in np.argsort(-bound, kind="stable").tolist():
                        one, two = name(int(label[i[k]])), name(int(label[j[k]]))
                        if one != two:
                            above[max(one, two)] = min(one, two)
                            yield id_[i[k : k + 1]], id_[j[k : k + 1]]

        def grouped():
            held = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "id", "side", "label", "n", "slack")]
                bags = batch.column("bag").to_pylist()
                wide = max(map(len, bags))
                if min(map(len, bags)) == wide:
                    counts = np.frombuffer(b"".join(bags), dtype=np.uint16).reshape(len(bags), -1)
                else:  # of a set with very many shingles in one group
                    counts = np.stack([_folded(b, groups) for b in bags])
                rows.append(counts.reshape(len(bags), -1, groups).sum(axis=1, dtype=np.uint32))
                if held is not None:
                    rows = [np.concatenate([x, y]) for x, y in zip(held, rows, strict=True)]
                key = rows[0]
                cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
                for i, j in zip(cuts, cuts[1:], strict=False):
                    yield [x[i:j] for x in rows[1:]]
                held = [x[cuts[-1] :] for x in rows]
            if held is not None:
                yield held[1:]

        def batch_of(made):
            a, b = (np.concatenate([m[k] for m in made]) for k in (0, 1))
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

        made, total = [], 0
        for id_, side, label, n, slack, counts in grouped():
            if len(id_) < 2 or (label == label[0]).all():
                continue
            for found in pairs(id_, side, label, n, slack, counts):
                made.append(found)
                total += len(found[0])
                if total >= 50_000:
                    yield batch_of(made)
                    made, total = [], 0
        if made:
            yield batch_of(made)

    return tidy(search)


def _verifier(percent: int, shingle: int):
    """Of pairs with both texts, those whose sets overlap enough."""

    def check(batches):
        import numpy as np
        import pyarrow as pa

        shingles = _shingler(shingle)
        names = ("a", "b", "own_a", "own_b")
        for batch in batches:
            sets: dict = {}
            near = []
            for x, y in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                one, two = x.as_py(), y.as_py()
                # a pair's b differs from row to row, while a often stays
                if one not in sets:
                    sets = {one: shingles(one)}
                p, q = sets[one], shingles(two)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                near.append(100 * shared >= percent * (len(p) + len(q) - shared))
            kept = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in names], names=list(names))

    return tidy(check)


def frequent_shingles(whole: DataFrame, shingle: int = SHINGLE) -> list[int]:
    """Hashes of the shingles that many texts hold, the most frequent first, from a share of the texts.

    They decide only the order in which shingles are tried; links do not depend on it.
    """
    some = whole.where(F.pmod("t1", F.lit(SAMPLE_SHARE)) == 0).dropDuplicates(["t1"])
    some = some.select(F.col("text").cast("binary").alias("text"))
    counts = some.mapInArrow(_hashes(shingle), "hash bigint").groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    top = counts.where(F.col("n") >= SAMPLE_LEAST).orderBy(F.desc("n"), "hash").limit(FREQUENT)
    return [row.hash for row in top.collect()]


def jaccard_components(
    docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, groups: int = GROUPS, block: int = BLOCK
) -> DataFrame:
    """(doc_id, n_shingles, component_id): the size of every document's set and the smallest doc_id that links lead to.

    A set holds the distinct ``shingle``-word shingles of the whole text with A-Z in lower case; a text with fewer words is
    one shingle. Two documents link if their intersection is at least ``percent`` of their union, so each text without words,
    null and empty ones too, is on its own. No pair that links is passed over, but for equal 64-bit hashes.

    Shingles are hashed into ``groups``, a power of two; a set's counts by group are a point. Points with a shingle of their
    prefixes in common meet in an R-tree, whose boxes bound the overlap of all pairs below them by the sums of the smaller
    counts; pairs of large sets are bounded by counts in more groups too, and the surviving pairs are verified by their sets. Pairs that would join documents which others join already come last, and
    only if these did not link. A single tree over all points would send each through nearly all boxes: in 64 coordinates the
    boxes of unlike texts overlap. So the prefixes, which miss no link, deal points to trees.

    Rows with one doc_id are one document, linked with whatever one of its texts links with. A null doc_id stands for a
    document of its own, named by a number from 2^62 on that its text gives. Equal sets are one point. No rows: no rows.

    Scale: a document has a seventh of its shingles as prefix. Shingles that many texts share come last in their order (a list
    of at most 2^17, from a share of the texts), so that a passage which a third of all documents hold brings only documents
    together that hold little else. A bucket of more than ``block`` members is cut into trees of that size by length and hash.
    """
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(docs.dtypes)["doc_id"]
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("t1", F.xxhash64("text"))
    unnamed = F.col("t1").bitwiseAND(F.lit(UNNAMED - 1)).bitwiseOR(F.lit(UNNAMED))
    whole = whole.withColumn("own", F.coalesce(F.col("doc_id").cast("long"), unnamed))
    frequent = frequent_shingles(whole, shingle)
    sketched = materialize(
        whole.select("doc_id", "own", "t1", F.col("text").cast("binary").alias("text")).mapInArrow(
            _sketcher(frequent, shingle, percent, groups),
            f"doc_id {kind}, own bigint, t1 bigint, n bigint, s1 bigint, s2 bigint, prefix array<bigint>, counts binary, fine binary",
        ),
        "sketches",
    )
    filled = sketched.where("n > 0")
    exact = filled.groupBy("s1", "s2").agg(F.min(F.struct("own", "t1")).alias("rep"))
    members = filled.select("own", "s1", "s2").join(exact, ["s1", "s2"]).select("own", F.col("rep.own").alias("rep"))
    members = materialize(members.distinct(), "members")
    # a document that stands in several classes joins them
    spread = members.groupBy("own").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).where("a < most")
    same = members.join(spread, "own").where("rep > a").select("a", F.col("rep").alias("b")).distinct()
    chosen = exact.select("rep.own", "rep.t1")
    reps = materialize(
        filled.join(chosen, ["own", "t1"], "left_semi").dropDuplicates(["own", "t1"])
        .select(F.xxhash64("own", "t1").alias("id"), "own", "t1", "n", "prefix", F.col("counts").alias("bag"), "fine"),
        "reps",
    )
    # if a pair's first common shingle is the i-th and j-th of its sets, at most n - i and m - j are in common: both are at
    # least percent / (100 + percent) of n + m only if i + j <= (100 - percent) / (100 + percent) of n + m
    slack = F.ceil(F.col("n") * F.lit((100 - percent) / (100 + percent)) - F.col("nth")).cast("int")
    dealt = reps.select("id", "own", "n", F.posexplode("prefix").alias("nth", "bucket")).select(
        "id", "own", "nth", "bucket", slack.alias("slack")
    )
    shared = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("slack").alias("most")).where("n > 1")
    crowd = materialize(
        dealt.join(shared.select("bucket", "most"), "bucket").where(F.col("slack") + F.col("most") >= 0).drop("most"), "buckets"
    )
    wanted = reps.join(crowd.select("id").distinct(), "id", "left_semi").select("id", "own", "t1")
    texts = materialize(
        whole.select("own", "t1", "text").join(wanted, ["own", "t1"]).dropDuplicates(["id", "own", "t1"])
        .select("id", "own", F.col("text").cast("binary").alias("text")),
        "texts",
    )
    points = reps.select("id", "n", "bag")
    finer = reps.select("id", "n", "fine")
    stored = [sketched, members, reps, crowd, texts]

    def candidates(buckets: DataFrame, spanning: bool, tried: DataFrame | None) -> DataFrame:
        placed = buckets.select("bucket", "id", "label", "slack").join(points, "id")
        met = _grouped(placed, percent / 100, block).repartition(width, "grp").sortWithinPartitions("grp")
        pairs = met.select("grp", "id", "side", "label", "n", "slack", "bag").mapInArrow(
            _search(percent, groups, spanning), "a bigint, b bigint"
        ).distinct()
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        a, b = (finer.select(*[F.col(c).alias(x if c == "id" else f"{c}_{x}") for c in ("id", "n", "fine")]) for x in "ab")
        return materialize(pairs.join(a, "a").join(b, "b").mapInArrow(_finer(percent), "a bigint, b bigint"), "pairs")

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = (texts.select(*[F.col(c).alias(x if c == "id" else f"{c}_{x}") for c in ("id", "own", "text")]) for x in "ab")
        joined = pairs.join(b, "b").repartition(width, "a").join(a, "a")
        found = joined.select("a", "b", "own_a", "own_b", "text_a", "text_b").mapInArrow(
            _verifier(percent, shingle), "a bigint, b bigint, own_a bigint, own_b bigint"
        )
        return materialize(found.select(F.col("own_a").alias("a"), F.col("own_b").alias("b")), "links")

    def mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """The buckets whose members are not all joined yet."""
        placed = labelled(rows.select("bucket", "id", "own", "slack"), labels, "own", "label")
        open_ = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        made = materialize(placed.join(open_.select("bucket"), "bucket"), "open")
        stored.append(made)
        return made

    first = crowd.where(F.col("nth") < FIRST).withColumn("label", F.col("own"))
    tried = candidates(first, True, None)
    found = verified(tried)
    labels, rows = components(same.union(found)), crowd
    stored += [tried, found]
    for spanning in (True, False):
        rows = mixed(rows, labels)
        pairs = candidates(rows, spanning, tried)
        found = verified(pairs)
        tried = tried.union(pairs)
        stored += [pairs, found, labels]
        labels = with_links(labels, found)
    named = labelled(members, labels, "rep", "component_id").groupBy("own").agg(F.min("component_id").alias("component_id"))
    left = sketched.select("doc_id", "own", F.col("n").alias("n_shingles"))
    result = materialize(
        left.join(named, "own", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "own").alias("component_id")),
        "components",
    )
    discard(*stored, labels)
    return result

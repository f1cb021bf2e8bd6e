"""Exact top-k search by inner product: a KD-tree per shard, best-first traversal, and a bound passed on between shards."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuekit.session import materialize

SHARD_ROWS = 2048
BLOCK_QUERIES = 512
LEAF = 64
#: trees that a task holds at a time
GROUP_TREES = 32


def quantized(vector: Column) -> Column:
    """floor(256 * x) of each component x, taken as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256))


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every component is a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def _tree(matrix, ids, leaf: int):
    """Rows reordered so that each node is a run of rows; nodes as (begin, end, left child or -1) with tight boxes.

    A node is split at the median of its widest dimension. Rows are ordered by id inside a leaf.
    """
    import numpy as np

    order = np.argsort(ids, kind="stable")
    begin, end, child, stack = [0], [len(order)], [-1], [0]
    while stack:
        node = stack.pop()
        b, e = begin[node], end[node]
        if e - b <= leaf:
            continue
        rows = matrix[order[b:e]]
        spread = rows.max(axis=0) - rows.min(axis=0)
        axis = int(spread.argmax())
        if not spread[axis]:
            continue  # equal vectors: one leaf, however many
        middle = (e - b) // 2
        part = np.argpartition(rows[:, axis], middle)
        order[b:e] = order[b:e][part]
        child[node] = len(begin)
        for x, y in ((b, b + middle), (b + middle, e)):
            stack.append(len(begin))
            begin.append(x)
            end.append(y)
            child.append(-1)
    matrix, ids = matrix[order], ids[order]
    low = np.array([matrix[b:e].min(axis=0) for b, e in zip(begin, end, strict=True)])
    high = np.array([matrix[b:e].max(axis=0) for b, e in zip(begin, end, strict=True)])
    return {"matrix": matrix, "ids": ids, "begin": begin, "end": end, "child": child, "low": low, "high": high}


def _search(tree, query_ids, queries, floors, k: int):
    """(query position, id, score) of each query's k best rows of a tree that score ``floors`` or more.

    The bound of a node is the largest inner product that a point of its box can have with the query. Nodes are
    visited from the highest bound down until it is under the k-th score so far.
    """
    import heapq

    import numpy as np

    matrix, ids, begin, end, child = (tree[x] for x in ("matrix", "ids", "begin", "end", "child"))
    bounds = np.maximum(queries, 0) @ tree["high"].T + np.minimum(queries, 0) @ tree["low"].T
    found, repeats = [], len(set(ids.tolist())) < len(ids)
    for position, (own, query, floor, bound) in enumerate(zip(query_ids, queries, floors, bounds, strict=True)):
        best: list = []  # a heap of (score, -id): its first is the one to beat
        if bound[0] < floor:
            continue
        queue = [(-bound[0], 0)]
        while queue:
            limit, node = heapq.heappop(queue)
            if -limit < floor:
                break
            first = child[node]
            if first >= 0:
                for x in (first, first + 1):
                    if bound[x] >= floor:
                        heapq.heappush(queue, (-bound[x], x))
                continue
            b, e = begin[node], end[node]
            scores = matrix[b:e] @ query
            at = np.flatnonzero(scores >= floor)
            if len(at) > 4 * k and not repeats:  # of many, those beyond the k-th score (and its ties) cannot come in
                least = np.partition(scores[at], len(at) - k - 1)[len(at) - k - 1]
                at = at[scores[at] >= least]
            for i in at:
                if ids[b + i] == own:
                    continue
                item = (scores[i], -int(ids[b + i]))
                if repeats and (held := next((x for x in best if x[1] == item[1]), None)):  # one id, one candidate
                    if item > held:
                        best[best.index(held)] = item
                        heapq.heapify(best)
                elif len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k and best[0][0] > floor:
                floor = best[0][0]
        found += [(position, -i, s) for s, i in best]
    return found


def _numbers(column):
    """A matrix that multiplies exactly: doubles while every product sum is below 2^53, else Python integers."""
    import numpy as np

    matrix = np.stack([np.asarray(x, dtype=np.int64) for x in column])
    safe = (2.0**53 / matrix.shape[1]) ** 0.5
    exact = matrix.size == 0 or max(abs(float(matrix.max())), abs(float(matrix.min()))) < safe
    return matrix.astype(np.float64) if exact else matrix.astype(object)


def _small(matrix):
    """The same numbers in as few bytes as hold them."""
    import numpy as np

    if matrix.dtype != object and matrix.size:
        for kind in (np.int8, np.int16, np.int32):
            if np.iinfo(kind).min <= matrix.min() and matrix.max() <= np.iinfo(kind).max:
                return matrix.astype(kind)
    return matrix


def _unpacked(tree):
    import numpy as np

    return {x: y.astype(np.float64) if x in ("matrix", "low", "high") and y.dtype != object else y for x, y in tree.items()}


def _alike(tree, query_ids, queries):
    """Both in doubles or both in Python integers."""
    if tree["matrix"].dtype != queries.dtype:
        queries = queries.astype(object)
        tree = {x: y.astype(object) if x in ("matrix", "low", "high") else y for x, y in tree.items()}
    return tree, query_ids, queries


def _build(k: int, leaf: int):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        import pickle

        import numpy as np

        matrix, ids = _numbers(rows.vector), rows.vec_id.to_numpy(np.int64)
        tree = _tree(matrix, ids, leaf)
        once = ~rows.vec_id.duplicated(keep=False).to_numpy(bool)  # of several vectors of an id, another one may ask
        asked = np.flatnonzero(rows.asks.to_numpy(bool) & once)
        home: dict = {int(i): [] for i in ids[asked]}
        none = [float("-inf")] * len(asked)
        for position, _, score in _search(tree, ids[asked], matrix[asked], none, k):
            home[int(ids[asked[position]])].append(score)
        floors = [(q, int(min(s))) for q, s in home.items() if len(s) == k]
        tree = {x: _small(y) if x in ("matrix", "low", "high") else y for x, y in tree.items()}
        return pd.DataFrame({
            "dim": [int(rows.dim.iloc[0])], "shard": [int(rows.shard.iloc[0])], "tree": [pickle.dumps(tree)],
            "queries": [[q for q, _ in floors]], "floors": [[s for _, s in floors]],
        })

    return build


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    import pickle

    rows = rows.sort_values("query_id")
    floors = [float("-inf") if x is None or x != x else int(x) for x in rows.floor.astype(object)]
    block = pickle.dumps((rows.query_id.to_numpy("int64"), _small(_numbers(rows.vector)), floors))
    return pd.DataFrame({"dim": [int(rows.dim.iloc[0])], "block": [int(rows.block.iloc[0])], "asked": [block]})


def _probe(k: int):
    """Rows come sorted by group, the trees of a group before the blocks of queries that meet them."""

    def probe(batches):
        import heapq
        import pickle

        import numpy as np

        current, trees = None, []
        for rows in batches:
            out = []
            for group, block, packed in zip(rows.grp, rows.block, rows.packed, strict=True):
                if group != current:
                    current, trees = group, []
                if block < 0:
                    trees.append(_unpacked(pickle.loads(packed)))
                    continue
                query_ids, queries, floors = pickle.loads(packed)
                queries, best = queries if queries.dtype == object else queries.astype(np.float64), {}
                for tree in trees:  # the k-th scores go on to the group's next tree
                    seen = [best.get(i, []) for i in range(len(query_ids))]
                    passed = [max(f, s[0][0]) if len(s) == k else f for f, s in zip(floors, seen, strict=True)]
                    for position, vec_id, score in _search(*_alike(tree, query_ids, queries), passed, k):
                        held, item = best.setdefault(position, []), (score, -vec_id)
                        if len(held) < k:
                            heapq.heappush(held, item)
                        else:
                            heapq.heappushpop(held, item)
                out += [
                    (int(query_ids[position]), -i, max(-(2**63), min(2**63 - 1, int(score))))
                    for position, held in best.items() for score, i in held
                ]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(np.int64)

    return probe


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, leaf: int = LEAF,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of (vec_id, vector) for which ``is_query`` holds, the ``k`` other rows
    with the largest inner product; ties go to the smaller vec_id. ``vector`` is an array of integers.

    Rows go to shards of about ``shard_rows`` rows by a hash of vec_id, so equal or close vectors that make up a third of
    the table spread evenly. Each shard gets one KD-tree. A query is first searched in its own shard, whose k-th score is a
    floor for all others; shards are dealt to groups, and blocks of queries then meet every group, whose trees pass the rising
    k-th score from one to the next. The result is exact.

    Null vec_ids and null or empty vectors take no part. Rows that repeat a vec_id and its vector count once; different
    vectors under one vec_id are one candidate with the best of their scores, and as a query the first of them in array order
    asks. Only vectors of the same length are compared. Scores beyond 64 bits stop at the largest long.

    Scale: every query meets every shard by design. A tree is shuffled once; a block of ``block_queries`` vectors goes once to
    each group of up to ``GROUP_TREES`` trees, fewer where there are too few shards for the cores. At most ``k`` rows of a
    query leave a group. Nothing is broadcast, and no task holds more than the trees of one group and one batch of blocks.
    """
    rows = vectors.select("vec_id", "vector", is_query.alias("asks")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
    )
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), "vector", F.coalesce("asks", F.lit(False)).alias("asks"),
        F.size("vector").alias("dim"),
    ).dropDuplicates(["vec_id", "vector"])
    rows = materialize(rows, "vectors")
    counts = rows.select(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    shards, blocks = max(1, -(-counts["n"] // shard_rows)), max(1, -(-counts["q"] // block_queries))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    trees = materialize(
        dealt.groupBy("dim", "shard").applyInPandas(
            _build(k, leaf), "dim int, shard int, tree binary, queries array<bigint>, floors array<bigint>"
        ),
        "trees",
    )
    floors = trees.select(F.explode(F.arrays_zip("queries", "floors")).alias("x")).select(
        F.col("x.queries").alias("query_id"), F.col("x.floors").alias("floor")
    ).groupBy("query_id").agg(F.max("floor").alias("floor"))
    asked = rows.where("asks").groupBy(F.col("vec_id").alias("query_id"), "dim").agg(F.min("vector").alias("vector"))
    asked = asked.join(floors, "query_id", "left").withColumn(
        "block", F.pmod(F.xxhash64("query_id", F.lit(3)), F.lit(blocks)).cast("int")
    )
    packed = asked.groupBy("dim", "block").applyInPandas(_pack, "dim int, block int, asked binary")
    # groups of trees: a few for each core, so that a block goes to few of them
    lanes = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = max(1, min(GROUP_TREES, shards // (4 * vectors.sparkSession.sparkContext.defaultParallelism)))
    groups = -(-shards // held)
    kept = trees.select("dim", F.floor(F.col("shard") / held).cast("int").alias("part"), F.lit(-1).alias("block"), F.col("tree").alias("packed"))
    spread = packed.select("dim", F.explode(F.expr(f"sequence(0, {groups - 1})")).alias("part"), "block", F.col("asked").alias("packed"))
    met = (
        kept.unionByName(spread).repartition(max(lanes, 2 * groups), "dim", "part").withColumn("grp", F.xxhash64("dim", "part"))
        .sortWithinPartitions("grp", "block").select("grp", "block", "packed")
        .mapInPandas(_probe(k), "query_id bigint, vec_id bigint, score bigint")
    )
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

import numpy as np
from pyspark.sql import functions as F

from venuekit.llm import topk


def brute(rows, k, asks):
    out = set()
    for q, v in rows:
        if asks(q):
            best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v)))[:k]
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    return out


def found(df, k, **options):
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k, **options).collect()
    return {tuple(r) for r in got}, len(got)


def test_same_as_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [int(x) for x in rng.integers(-40, 40, 6)]) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(60)]  # many equal vectors: ties go to the smaller id
    df = spark.createDataFrame(rows, "vec_id long, vector array<bigint>").repartition(5)
    got, n = found(df, 5, shard_rows=64, block_queries=16, leaf=8)
    assert got == brute(rows, 5, lambda i: i % 5 == 0) and n == len(got)


def test_few_rows_nulls_and_repeats(spark):
    rows = [(0, [1, 2]), (0, [1, 2]), (5, [3, -1]), (7, None), (None, [1, 1]), (8, []), (10, [1]), (15, [2**40, 2**40]), (16, [2**41, 1])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<bigint>").withColumn("rank", F.lit(1))
    kept = [(0, [1, 2]), (5, [3, -1]), (10, [1]), (15, [2**40, 2**40]), (16, [2**41, 1])]
    wanted = {(q, n, i, min(s, 2**63 - 1)) for q, n, i, s in brute(kept, 5, lambda i: i % 5 == 0)}
    assert found(df, 5)[0] == wanted
    assert found(df.limit(0), 5)[0] == set()


def test_quantized_and_usable(spark):
    rows = [(1, [0.5, -0.001]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (5, None), (6, [])]
    df = spark.createDataFrame(rows, "vec_id int, e array<float>").where(topk.usable(F.col("e")))
    assert [tuple(r) for r in df.select("vec_id", topk.quantized(F.col("e"))).collect()] == [(1, [128, -1])]


def test_trees_are_shuffled_once_and_blocks_by_group(spark):
    """Four times the rows make less than eight times the bytes of what the searching tasks read."""
    read = []
    for n in (1_000, 4_000):
        rng = np.random.default_rng(n)
        rows = [(i, [int(x) for x in rng.integers(-40, 40, 16)]) for i in range(n)]
        found = topk.top_k(spark.createDataFrame(rows, "vec_id long, vector array<bigint>"), F.col("vec_id") % 5 == 0, 5, shard_rows=40, block_queries=40)
        read.append(exchanged(found))
    assert 0 < read[1] < 8 * read[0]


def exchanged(df):
    """Bytes that the exchanges of trees or blocks of queries wrote while a frame was made."""
    rows = df._jdf.queryExecution()
    df._jdf.collectToPython()
    return sum(sizes(rows.executedPlan()))


def sizes(node):
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return sizes(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return sizes(node.plan())
    own = []
    if name == "ShuffleExchangeExec" and any(x in node.output().mkString(",") for x in ("packed#", "asked#", "tree#")):
        own = [node.metrics().apply("dataSize").value()]
    children = node.children()
    return own + [x for i in range(children.size()) for x in sizes(children.apply(i))]


def test_vectors_of_one_id_are_one_candidate(spark):
    rows = [(0, [10, 1])] + [(1, [100 + i, i]) for i in range(9)] + [(i, [50 - i, 2]) for i in range(2, 9)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<bigint>")
    got = sorted(r for r in found(df, 5)[0] if r[0] == 0)
    assert got == [(0, 1, 1, 1088), (0, 2, 2, 482), (0, 3, 3, 472), (0, 4, 4, 462), (0, 5, 5, 452)]

"""Filter interaction audit: what each of several quality filters removes, keeps and repeats, in every order of the filters."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
WORD_GAP = r"[\x20\x09-\x0D]+"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STEP = "struct<letter:string," + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def text_failures(text: Column, words: Column) -> Column:
    """The letters of the filters that a text fails by itself, in order; ``words`` are its words."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {
        "A": n < 50,
        "B": 100 * distinct < 65 * n,
        "C": 100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }
    return F.concat(*[F.when(bad, letter).otherwise("") for letter, bad in fails.items()])


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): the documents of each part by the set of filters that they fail.

    The text, null as empty, is read once; what is shuffled is its hash. Copies of a text fail the same filters but for E,
    so they are summed, also before the shuffle, and only the smallest doc_id is held against the other parts' smallest.
    """
    whole = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    worded = whole.withColumn("words", F.filter(F.split("text", WORD_GAP), lambda w: w != ""))
    facts = worded.select(
        "doc_id", "part", text_failures(F.col("text"), F.col("words")).alias("fails"), F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(1), "text").alias("h2"),
    )
    text = ["h1", "h2", "part", "fails"]
    rows = facts.groupBy("doc_id", *text).agg(F.count(F.lit(1)).alias("n"))
    # rows without a doc_id have no label: they go to as many tasks as they have texts
    rows = rows.withColumn("apart", F.when(F.col("doc_id").isNull(), F.col("h1")))
    flag = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("long"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("l_doc")).agg(
        flag("quality").alias("good"), flag("toxic").alias("toxic")
    ).withColumn("l_apart", F.lit(None).cast("long"))
    labelled = rows.join(
        known, F.col("doc_id").eqNullSafe(F.col("l_doc")) & F.col("apart").eqNullSafe(F.col("l_apart")), "left"
    ).select(
        "doc_id", *text, "n", *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]
    )
    weights = ("n", "good", "toxic")
    named = F.col("doc_id").isNotNull()
    summed = labelled.groupBy(*text).agg(
        F.min(F.when(named, F.struct("doc_id", *weights))).alias("first"),
        *[F.sum(F.when(named, F.col(c)).otherwise(0)).alias(c) for c in weights],
        *[F.sum(F.when(named, F.lit(0)).otherwise(F.col(c))).alias(f"{c}_unnamed") for c in weights],
    ).withColumn("least", F.min("first.doc_id").over(Window.partitionBy("h1", "h2")))
    leads = F.coalesce(F.col("first.doc_id") == F.col("least"), F.lit(False))
    original = {c: F.when(leads, F.col(f"first.{c}")).otherwise(0) for c in weights}
    cells = F.array(
        F.struct("fails", *[(original[c] + F.col(f"{c}_unnamed")).alias(c) for c in weights]),
        F.struct(F.concat("fails", F.lit("E")).alias("fails"), *[(F.col(c) - original[c]).alias(c) for c in weights]),
    )
    return (
        summed.select("part", F.explode(cells).alias("cell")).where("cell.n > 0")
        .groupBy("part", F.col("cell.fails").alias("fails")).agg(*[F.sum(f"cell.{c}").alias(c) for c in weights])
    )


def fold_orders(orders: Column) -> Column:
    """The steps of every order for one cell, one after another: a fold carries whether the cell is gone already."""
    zero = F.lit(0).cast("long")

    def step(state: Column, letter: Column) -> Column:
        gone, bad = state["gone"], F.contains(F.col("fails"), letter)
        out = bad & ~gone

        def weigh(when: Column, weight: str = "n") -> Column:
            return F.when(when, F.col(weight)).otherwise(zero)

        made = F.struct(
            letter.alias("letter"), weigh(~gone & ~bad).alias("kept"), weigh(out).alias("removed"),
            weigh(bad & gone).alias("redundant"), weigh(F.col("fails") == letter).alias("unique_fails"),
            weigh(out, "good").alias("good_lost"), weigh(out, "toxic").alias("toxic_lost"),
        )
        return F.struct((gone | bad).alias("gone"), F.array_append(state["steps"], made).alias("steps"))

    start = F.struct(F.lit(False).alias("gone"), F.array().cast(f"array<{_STEP}>").alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(F.split(order, ""), start, step, lambda s: s["steps"])))


def _sum_steps(left: Column, right: Column) -> Column:
    return F.zip_with(
        left, right, lambda a, b: F.struct(b["letter"].alias("letter"), *[(a[c] + b[c]).alias(c) for c in COUNTS])
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part,
    order of the filters and step in it.

    ``docs`` has doc_id, text, source and ``labels`` doc_id, quality, toxic; other columns play no part. Each cell, that is
    the documents of a part that fail the same set of filters, folds across the array of orders, which goes to every task;
    the folds of a part are merged by elementwise sums. shapley is what the step's filter removes summed over all orders.

    A null text is an empty one and a null source the part ''. Rows count each, also if they repeat; E asks for a smaller
    doc_id, so rows that repeat both doc_id and text do not fail it for each other, and a null doc_id is neither smaller nor
    larger than any. A document with several labels has each that one of them gives. No rows: no rows.

    Scale: narrow rows are shuffled, a text as 16 bytes, and summed before the shuffle. A part has at most 32 cells.
    """
    orders = F.lit(ORDERS)
    folded = mask_cells(docs, labels).select("part", fold_orders(orders).alias("steps"))
    zeros = F.expr(f"array_repeat(cast(named_struct('letter', '', {', '.join(repr(c) + ', 0' for c in COUNTS)}) as {_STEP}), "
                   f"{len(ORDERS) * len(FILTERS)})")
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("cells")).select(
        "part", F.aggregate("cells", zeros, _sum_steps).alias("steps")
    )
    letters = F.lit(list(FILTERS))
    total = lambda letter: F.aggregate(
        F.filter("steps", lambda s: s["letter"] == letter), F.lit(0).cast("long"), lambda n, s: n + s["removed"]
    )
    shares = merged.withColumn("shares", F.map_from_arrays(letters, F.transform(letters, total)))
    steps = shares.select("part", "shares", F.posexplode("steps").alias("at", "s"))
    width = len(FILTERS)
    return steps.select(
        "part", F.get(orders, F.floor(F.col("at") / width).cast("int")).alias("filter_order"),
        (F.col("at") % width + 1).cast("int").alias("step"), *[F.col(f"s.{c}").alias(c) for c in COUNTS],
        F.element_at("shares", F.col("s.letter")).alias("shapley"),
    )

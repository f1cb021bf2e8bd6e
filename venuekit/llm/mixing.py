"""Mixing sources to target weights: Sainte-Lague apportionment of equal blocks of words, then seeded block selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuekit.llm.batches import slices, tidy
from venuekit.session import materialize

GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0."""
    trimmed = F.btrim(text, F.lit(GAP_CHARS))
    return F.when(text.isNull() | (trimmed == ""), F.lit(0)).otherwise(F.size(F.split(trimmed, GAP))).cast("long")


def default_weights(rank: Column) -> Column:
    """5, 2, 1, repeating, by the source's place in code point order."""
    return F.element_at(F.array(F.lit(5.0), F.lit(2.0), F.lit(1.0)), ((rank - 1) % 3 + 1).cast("int"))


def source_targets(sources: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Add ``target`` to (source, source_size): shares of all words by weight, at most ``MAX_EPOCHS`` times a source.

    What a full source cannot take goes to the others by weight. The share of a unit of weight is the largest of
    (total - caps so far) / (weights left) over the sources in the order in which they fill up, so one pass gives the
    end of the repeated reshare. ``weights`` (source, weight) replaces the default weights; a source without a row there,
    or with a weight that is null, negative or NaN, weighs 0. A mix is a list of sources written by hand, so this table
    of one row a source is small whatever the size of the corpus.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    if weights is None:
        weighted = sources.withColumn("weight", default_weights(F.row_number().over(order)))
    else:
        given = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double").alias("weight"))
        weighted = sources.join(given, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source")
        sane = F.col("weight").isNotNull() & ~F.isnan("weight") & (F.col("weight") > 0)
        weighted = weighted.withColumn("weight", F.when(sane, F.col("weight")).otherwise(0.0))
    cap = F.lit(float(MAX_EPOCHS)) * F.col("source_size")
    fills_at = F.when(F.col("weight") > 0, cap / F.col("weight"))
    everyone = Window.partitionBy()
    before = Window.orderBy(F.col("fills_at").asc_nulls_last(), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    positive = F.col("weight") > 0
    unit = (F.sum("source_size").over(everyone) - F.coalesce(F.sum(F.when(positive, cap)).over(before), F.lit(0.0))) / (
        F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return (
        weighted.withColumn("fills_at", fills_at)
        .withColumn("unit", F.when(positive, unit))
        .withColumn("unit", F.max("unit").over(everyone))
        .withColumn("target", F.coalesce(F.least(cap, F.col("unit") * F.col("weight")), F.lit(0.0)))
        .select("source", "source_size", "weight", "target")
    )


def apportion(parties: DataFrame, by: list[str], key: str, votes: str, seats: str) -> DataFrame:
    """Add ``quota``: Sainte-Lague seats of each party, ``seats`` a group, by the highest quotients votes / (2 j - 1).

    Instead of a loop over the seats, each party starts with what it surely gets (rounding against a divisor so large that
    no seat too many is given), and only the quotients between that and a sure upper bound, about two a party, are ranked.
    Ties go to the smaller ``key``. Groups without votes or seats get 0.
    """
    group = Window.partitionBy(*by)
    total, k = F.sum(votes).over(group), F.count(F.lit(1)).over(group)
    v, n = F.col(votes).cast("double"), F.col(seats).cast("double")
    has = (F.col("_total") > 0) & (n > 0) & (v > 0)
    surely = F.greatest(F.lit(0), F.floor(v * (n - F.col("_k") / 2) / F.col("_total") + 0.5 - 1e-9))
    at_most = F.floor(v * (n + F.col("_k") / 2) / F.col("_total") + 0.5) + 1
    bounded = (
        parties.withColumn("_total", total.cast("double"))
        .withColumn("_k", k)
        .withColumn("_low", F.when(has, surely).otherwise(F.lit(0)).cast("long"))
        .withColumn("_high", F.when(has, at_most).otherwise(F.lit(0)).cast("long"))
        .withColumn("_open", (F.col(seats) - F.sum("_low").over(group)).cast("long"))
    )
    offers = bounded.where(F.col("_high") > F.col("_low")).select(
        *by, key, votes, "_open", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_j")
    )
    best = Window.partitionBy(*by).orderBy((F.col(votes) / (2 * F.col("_j") - 1)).desc(), key)
    won = (
        offers.withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") <= F.col("_open"))
        .groupBy(*[F.col(c).alias(f"_w_{c}") for c in [*by, key]])
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in [*by, key]]
    joined = bounded.join(won, same, "left")
    return joined.withColumn("quota", F.col("_low") + F.coalesce(F.col("_won"), F.lit(0))).drop(
        "_total", "_k", "_low", "_high", "_open", "_won", *[f"_w_{c}" for c in [*by, key]]
    )


def _taken_before(x: Column) -> Column:
    """Words taken from the first ``x`` words of a shard: whole blocks in closed form, then a part of the block at ``x``."""
    b = F.floor(x / F.col("block"))
    at = lambda i: F.floor((F.col("quota") * i + F.col("phase")) / F.col("blocks"))
    return (at(b) * F.col("block") + (at(b + 1) - at(b)) * (x - b * F.col("block"))).cast("long")


def mix(
    docs: DataFrame, weights: DataFrame | None = None, payload: tuple[str, ...] = (), block_words: int = 256,
    precision: int = 400, shard_words: int = 1 << 17, groups: int = 1024, seed: int = 17,
) -> DataFrame:
    """One row a document: doc_id, size, source, source_size, target, taken, and where its words lie in the mix.

    Blocks of equal size are allocated to sources by the highest quotients, then in each source to groups and shards in
    the same way. A shard of ``blocks`` blocks and a quota of q takes block b floor((q (b + 1) + phase) / blocks) -
    floor((q b + phase) / blocks) times, with a phase that follows from the seed: a systematic draw in which every
    block has the same chance, up to ``MAX_EPOCHS`` times. Documents lie in a shard in the order of a seeded hash, so
    which words are in which block does not depend on partitions, and a rerun agrees.

    A block holds ``block_words`` words, or fewer where the smallest positive target is under ``precision`` blocks, so
    that rounding to whole blocks moves each source by a small part of its target.

    Null text: size 0, nothing is taken. Null source: a source of its own, last. Null or repeated doc_id: a document of its
    own. No documents: no rows. Other columns of the input do not matter, but for those named in ``payload``, which come
    along.

    Scale: source totals are sums with partial aggregation. Shards hold about ``shard_words`` words by a hash of doc_id and
    text, so a hot source is many shards; quotas are ranked among at most ``groups`` groups and then among the shards of one group.
    """
    columns = [F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("hash")]
    columns += [F.col(c).alias(f"p_{c}") for c in payload]
    sized = docs.select(*columns)
    if not payload:
        sized = materialize(sized, "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(totals, weights), "mix-targets")

    everyone = Window.partitionBy()
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everyone)
    block = F.least(F.lit(block_words), F.greatest(F.lit(1), F.floor(smallest / precision)))
    plan = (
        targets.withColumn("block", F.coalesce(block, F.lit(1)).cast("long"))
        .withColumn("seats", F.round(F.sum("target").over(everyone) / F.col("block")).cast("long"))
        .withColumn("all", F.lit(0))
    )
    plan = apportion(plan, ["all"], "source", "target", "seats").withColumnRenamed("quota", "source_quota")
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))
    plan = plan.withColumn("n_groups", F.least(F.lit(groups), shards).cast("long")).withColumn(
        "n_shards", F.ceil(shards / F.col("n_groups")).cast("long")
    )
    plan = materialize(
        plan.select(F.col("source").alias("of"), "source_size", "target", "block", "source_quota", "n_groups", "n_shards"),
        "mix-plan",
    )

    placed = sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # rows without a doc_id, or with one that repeats, are dealt by their texts
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("hash"))
    placed = (
        placed.withColumn("draw", draw)
        .withColumn("grp", F.pmod(F.col("draw"), F.col("n_groups")))
        .withColumn("shard", F.pmod(F.shiftright(F.col("draw"), 20), F.col("n_shards")))
    )
    by_shard = placed.groupBy("source", "grp", "shard").agg(
        F.sum("size").alias("words"), F.first("source_quota").alias("source_quota"), F.first("block").alias("block")
    )
    by_shard = materialize(by_shard, "mix-shards")
    by_group = by_shard.groupBy("source", "grp").agg(
        F.sum("words").alias("group_words"), F.first("source_quota").alias("source_quota")
    )
    by_group = apportion(by_group, ["source"], "grp", "group_words", "source_quota").withColumnRenamed("quota", "group_quota")
    by_group = by_group.select(F.col("source").alias("g_source"), F.col("grp").alias("g_grp"), "group_quota")
    by_shard = by_shard.join(
        by_group, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("grp") == F.col("g_grp"))
    ).drop("g_source", "g_grp", "source_quota")
    quotas = apportion(by_shard, ["source", "grp"], "shard", "words", "group_quota")
    quotas = (
        quotas.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("words") / F.col("block"))).cast("long"))
        .withColumn("quota", F.least(F.col("quota"), MAX_EPOCHS * F.col("blocks")))
        .withColumn("phase", F.pmod(F.xxhash64(F.lit(seed + 1), "source", "grp", "shard"), F.col("blocks")))
        .select(
            F.col("source").alias("q_source"), F.col("grp").alias("q_grp"), F.col("shard").alias("q_shard"), "quota",
            "blocks", "phase",
        )
    )
    in_shard = Window.partitionBy("source", "grp", "shard").orderBy("draw", "doc_id", "size")
    located = placed.withColumn(
        "begin", F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    )
    mixed = located.join(
        materialize(quotas, "mix-quotas"),
        F.col("source").eqNullSafe(F.col("q_source")) & (F.col("grp") == F.col("q_grp")) & (F.col("shard") == F.col("q_shard")),
    )
    taken = _taken_before(F.col("begin") + F.col("size")) - _taken_before(F.col("begin"))
    return mixed.select(
        "doc_id", "size", "source", "source_size", "target", taken.alias("taken"), "begin", "block", "blocks", "quota",
        "phase", *[F.col(f"p_{c}").alias(c) for c in payload if c not in ("source", "doc_id")],
    )


@tidy
def _cut(batches):
    """Texts as often as they are taken: copy c holds the words of the blocks that are drawn c times or more."""
    import re

    import pyarrow as pa

    word = re.compile(r"[^\x20\x09-\x0D]+")
    for rows in (part for batch in batches for part in slices(batch)):
        out = []
        columns = [rows.column(c).to_pylist() for c in ("text", "size", "begin", "block", "blocks", "quota", "phase")]
        for n, (text, size, begin, block, blocks, quota, phase) in enumerate(zip(*columns, strict=True)):
            if not size or not quota:
                continue
            first, last = begin // block, (begin + size - 1) // block
            times = [(quota * (b + 1) + phase) // blocks - (quota * b + phase) // blocks for b in range(first, last + 1)]
            most = max(times)
            if min(times) == most:
                out += [(n, text)] * most
                continue
            ends = [(m.start(), m.end()) for m in word.finditer(text)]
            for copy in range(1, most + 1):
                pieces, open_at, shut = [], None, 0
                for i, t in enumerate(times):
                    low, high = max(0, (first + i) * block - begin), min(size, (first + i + 1) * block - begin)
                    if t >= copy:
                        open_at = ends[low][0] if open_at is None else open_at
                        shut = ends[high - 1][1]
                    elif open_at is not None:
                        pieces.append(text[open_at:shut])
                        open_at = None
                if open_at is not None:
                    pieces.append(text[open_at:shut])
                out.append((n, "\n".join(pieces)))
        places = pa.array([n for n, _ in out], pa.int64())
        doc_id, lang, source = (rows.column(c).take(places) for c in ("doc_id", "lang", "source"))
        texts = pa.array([t for _, t in out], pa.string())
        yield pa.RecordBatch.from_arrays([doc_id, texts, lang, source], names=["doc_id", "text", "lang", "source"])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: documents as often as they are taken, with the columns of ``docs``; n_chars fits the new text.

    A document whose blocks are all drawn equally often keeps its text as it is; where a block border cuts it, the copy
    holds the words of its drawn blocks, pieces joined by a line break. Documents without words are not in a mix. ``docs``
    has doc_id, text, lang, source and n_chars; each text is shuffled once.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    rows = mix(docs, payload=("text", "lang"), **options)
    cut = rows.select("doc_id", "text", "lang", "source", "size", "begin", "block", "blocks", "quota", "phase").mapInArrow(
        _cut, f"doc_id {kinds['doc_id']}, text string, lang string, source string"
    )
    return cut.select("doc_id", "text", "lang", "source", F.length("text").cast(kinds["n_chars"]).alias("n_chars"))

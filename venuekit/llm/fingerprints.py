"""SimHash fingerprints of documents and search within a Hamming radius, in DataFrame expressions only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuekit.session import materialize

WORDS = 2
BITS = 128
#: one bit in each half of a 64-bit number, so that one sum counts the votes of two bits
LANES = (1 << 32) | 1


def simhash(texts: DataFrame, keys: list[str], text: str = "text", words: int = WORDS) -> DataFrame:
    """(keys, high, low): the 128 bits of the SimHash of each text.

    Terms are runs of ``words`` words (shorter at the end of the text), once for each occurrence, and weigh as many votes
    as they have bytes, because short terms are common. Each term's hash votes for or against each bit; a bit is set if
    more than half of the weight is for it. Texts without words, which weigh nothing, have no bit set.

    The votes of two bits are summed in the two halves of one long, so a text has 64 sums, whatever its length; a half
    holds 2^32 bytes of terms. Sums combine before any shuffle, and need none where ``texts`` is partitioned by ``keys``.
    """
    blank = r"[\s]+"
    split = texts.select(*keys, F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r")), blank).alias("_w"))
    run = split.select(*keys, "_w", F.posexplode("_w").alias("_i", "_first"))
    parts = [F.col("_first"), *[F.get("_w", F.col("_i") + i) for i in range(1, words)]]
    term = run.select(*keys, F.xxhash64(*parts).alias("_a"), sum(
        (F.coalesce(F.octet_length(p), F.lit(0)) for p in parts[1:]), F.octet_length(parts[0])
    ).cast("long").alias("_n"))
    term = term.withColumn("_b", F.xxhash64("_a"))
    sums = [
        F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(LANES)) * F.col("_n")).alias(f"{h}{i}")
        for h in ("_a", "_b") for i in range(32)
    ]
    votes = term.groupBy(*keys).agg(F.sum("_n").alias("_total"), *sums)

    def word(h: str) -> Column:
        bits = F.lit(0).cast("long")
        for i in range(32):
            for shift, count in (
                (i, F.col(f"{h}{i}").bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(f"{h}{i}", 32)),
            ):
                one = F.when(count * 2 > F.col("_total"), F.lit(1 << shift if shift < 63 else -(1 << 63))).otherwise(F.lit(0))
                bits = bits.bitwiseOR(one.cast("long"))
        return bits

    return votes.select(*keys, word("_a").alias("high"), word("_b").alias("low"))


def fingerprint_hex(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Number of differing bits of two fingerprints (high, low)."""
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """1 for equal fingerprints, about 0.5 for unrelated texts, 0 if every bit differs."""
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def _block(high: Column, low: Column, begin: int, end: int) -> Column:
    """Bits begin..end-1 of a fingerprint, bit 0 being the highest of ``high``."""

    def part(word: Column, b: int, e: int) -> Column:
        return F.shiftrightunsigned(F.shiftleft(word, b), 64 - (e - b))

    if end <= 64:
        return part(high, begin, end)
    if begin >= 64:
        return part(low, begin - 64, end - 64)
    return F.shiftleft(part(high, begin, 64), end - 64).bitwiseOR(part(low, 0, end - 64))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 4) -> DataFrame:
    """(query_high, query_low, high, low, distance): all fingerprints of ``prints`` within ``radius`` bits of a query.

    Both are (high, low). The 128 bits are cut into ``blocks`` blocks; ``radius`` differing bits touch at most as many
    blocks, so two such fingerprints agree on some choice of blocks - radius of them. For each choice there is a table
    keyed by those blocks, the permutation's leading bits; a pair found in a table is kept if its distance is within the
    radius. More blocks mean more tables with longer, more selective keys. Equal fingerprints count once on both sides.
    """
    choices = list(combinations(range(blocks), blocks - radius))
    edges = [BITS * i // blocks for i in range(blocks + 1)]

    def keyed(frame: DataFrame) -> DataFrame:
        cut = [_block(F.col("high"), F.col("low"), edges[i], edges[i + 1]) for i in range(blocks)]
        keys = [F.xxhash64(F.lit(n), *[cut[i] for i in choice]) for n, choice in enumerate(choices)]
        return frame.select("high", "low").distinct().select("high", "low", F.explode(F.array(*keys)).alias("key"))

    asked = keyed(queries).select(F.col("high").alias("query_high"), F.col("low").alias("query_low"), "key")
    found = asked.join(keyed(prints), "key").withColumn(
        "distance", distance((F.col("query_high"), F.col("query_low")), (F.col("high"), F.col("low")))
    )
    return found.where(F.col("distance") <= radius).select("query_high", "query_low", "high", "low", "distance").distinct()


def following(ids: DataFrame, range_rows: int = 1 << 17) -> DataFrame:
    """(id, next_id): the next smaller id of each distinct id; after the smallest comes the largest.

    Ids are dealt into ranges of about ``range_rows``; inside a range a window looks one row ahead, and the last id of a
    range is followed by the largest id of the next range that has any. One row a range is sorted in one task.
    """
    distinct = materialize(ids.select("id").distinct(), "ids")
    parts = max(1, -(-distinct.count() // range_rows))
    ranged = materialize(distinct.repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("part").orderBy(F.col("id").desc())
    ahead = ranged.withColumn("next_id", F.lead("id").over(inside))
    ends = ranged.groupBy("part").agg(F.max("id").alias("highest"))
    down = Window.orderBy(F.col("part").desc())
    ends = ends.select(
        "part", F.lead("highest").over(down).alias("after"), F.max("highest").over(Window.partitionBy()).alias("top")
    )
    return ahead.join(ends, "part").select("id", F.coalesce("next_id", "after", "top").alias("next_id"))


def document_fingerprints(docs: DataFrame, radius: int = 3, query_step: int = 100) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with their likeness and the likeness to the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and n_within: for
    documents whose id is divisible by ``query_step`` the number of other documents within ``radius`` bits, else null.

    The next document is that of the next smaller doc_id; after the last comes the first. The edited text ends in as many
    code points from the beginning of the next one as its last half has (all of them, if there are fewer). Null text:
    empty. A null doc_id counts as the smallest. Rows that repeat a doc_id are one document, with the text of the smallest hash.
    A single document follows itself. No documents: no rows.

    Scale: texts are shuffled once by doc_id, and beside them the beginnings that end up in another document; terms are
    made and counted where the text is. Ids alone are put in order, in ranges.
    """
    nameless = -(1 << 63)
    whole = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(nameless)).alias("id"), F.coalesce("text", F.lit("")).alias("text")
    )
    hashed = whole.withColumn("h", F.xxhash64("text"))
    sizes = hashed.select("id", "h", F.length("text").alias("n")).groupBy("id").agg(F.min(F.struct("h", "n")).alias("least"))
    sizes = materialize(sizes.select("id", F.col("least.n").cast("long").alias("n")), "sizes")
    chain = following(sizes).join(sizes, "id").select("id", "next_id", "n", F.floor(F.col("n") / 2).cast("int").alias("half"))
    chain = materialize(chain, "chain")

    texts = hashed.groupBy("id").agg(F.min_by("text", "h").alias("text"))
    needed = chain.select(F.col("next_id").alias("id"), F.col("id").alias("before"), "half")
    tails = texts.join(needed, "id").select(
        F.col("before").alias("id"), F.expr("substring(text, 1, half)").alias("tail")
    )
    joined = texts.join(chain, "id").join(tails, "id")
    edited = F.concat(F.expr("substring(text, 1, int(n) - half)"), F.col("tail"))
    both = joined.select("id", "next_id", "n", "text", edited.alias("edited")).select(
        "id", "next_id", "n", F.sha2(F.col("edited").cast("binary"), 256).alias("sha"),
        F.posexplode(F.array("text", "edited")).alias("which", "text"),
    )
    marked = simhash(both, ["id", "next_id", "n", "sha", "which"])
    of = lambda word, which: F.max(F.when(F.col("which") == which, F.col(word)))
    prints = marked.groupBy("id", "next_id", "n", "sha").agg(
        of("high", 0).alias("high"), of("low", 0).alias("low"), of("high", 1).alias("e_high"), of("low", 1).alias("e_low")
    )
    prints = materialize(prints, "prints")

    after = prints.select(F.col("id").alias("next_id"), F.col("high").alias("n_high"), F.col("low").alias("n_low"))
    counted = prints.groupBy("high", "low").agg(F.count(F.lit(1)).alias("documents"))
    asked = prints.where((F.col("id") != nameless) & (F.col("id") % query_step == 0))
    near = within_radius(asked, prints, radius).join(counted, ["high", "low"])
    near = near.groupBy(F.col("query_high").alias("high"), F.col("query_low").alias("low")).agg(
        (F.sum("documents") - 1).alias("n_within")
    )
    within = asked.select("id", "high", "low").join(near, ["high", "low"]).select("id", "n_within")
    own, other, nxt = (F.col("high"), F.col("low")), (F.col("e_high"), F.col("e_low")), (F.col("n_high"), F.col("n_low"))
    return prints.join(after, "next_id").join(within, "id", "left").select(
        F.when(F.col("id") != nameless, F.col("id")).alias("doc_id"), F.col("n").alias("n_chars"),
        F.col("sha").alias("edited_sha256"), fingerprint_hex(*own).alias("fingerprint"),
        fingerprint_hex(*other).alias("edited_fingerprint"), likeness(own, other).alias("near_edited"),
        likeness(own, nxt).alias("near_next"), "n_within",
    )

"""Line dedup by a segment-partition edit join: lines within a few edits of each other, found by shared substrings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.llm.alignment import banded_distance
from venuekit.llm.batches import tidy
from venuekit.session import materialize

MAX_EDITS = 2
CHARS_PER_EDIT = 20
BLANK = " \t\r\x0b\f"


def _version(text: Column) -> Column:
    """Tells texts under one doc_id apart: 31 bits of their hash."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit((1 << 31) - 1))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK)) == ""


def split_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, spot, line, len, h1, h2) of every line that is not blank. h1 and h2 together stand for the line; a spot is
    the version of the text and the number of the line in it."""
    lines = docs.where(F.col("text").isNotNull()).select(
        "doc_id", _version(F.col("text")).alias("version"), F.posexplode(F.split("text", "\n")).alias("pos", "line")
    ).where(~_blank(F.col("line")))
    spot = F.shiftleft("version", 32).bitwiseOR(F.col("pos").cast("long"))
    return lines.select(
        "doc_id", spot.alias("spot"), "line", F.length("line").alias("len"), F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
    )


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(begin, end) of the edits + 1 segments of a line; the last ones are one longer where it does not divide."""
    parts = edits + 1
    short, longer = divmod(length, parts)
    ends = [short * (i + 1) + max(0, i + 1 - (parts - longer)) for i in range(parts)]
    return list(zip([0, *ends[:-1]], ends, strict=True))


def allowed(length: int, max_edits: int, chars_per_edit: int) -> int:
    return min(max_edits, length // chars_per_edit)


def index_places(length: int, max_edits: int, chars_per_edit: int) -> list[tuple[int, int, int]]:
    """(begin, end, tag) under which a line of this length is indexed; a tag names the length, the edits and the segment."""
    e = allowed(length, max_edits, chars_per_edit)
    if not e:
        return []
    return [(b, t, (length * (max_edits + 1) + e) * (max_edits + 1) + i) for i, (b, t) in enumerate(segments(length, e))]


def probe_places(length: int, max_edits: int, chars_per_edit: int) -> list[tuple[int, int, int]]:
    """(begin, end, tag) under which a line finds lines of its length or up to ``max_edits`` shorter.

    Segment i of the shorter line can only sit in the longer one where the edits left and right of it, given by the
    shift and the difference in length, leave enough for the other segments: |shift| <= i from the left and
    |shift - difference| <= edits - i from the right.
    """
    found = []
    for less in range(max_edits + 1):
        shorter = length - less
        e = allowed(shorter, max_edits, chars_per_edit)
        if less > e:
            continue
        for i, (b, t) in enumerate(segments(shorter, e)):
            tag = (shorter * (max_edits + 1) + e) * (max_edits + 1) + i
            for shift in range(max(-i, less - (e - i)), min(i, less + (e - i)) + 1):
                if e and 0 <= b + shift and t + shift <= length:
                    found.append((b + shift, t + shift, tag))
    return found


def _entries(places_of, max_edits: int, chars_per_edit: int):
    """(h1, key, bag) rows of batches of (h1, line): the hashed substrings, and the parity of the line's letters.

    An edit changes the parity of two of the 32 classes of letters at most.
    """

    def entries(batches):
        from functools import lru_cache

        import numpy as np
        import xxhash

        places = lru_cache(maxsize=20_000)(lambda n: places_of(n, max_edits, chars_per_edit))
        digest = xxhash.xxh3_64_intdigest
        for rows in batches:
            lines = rows.line.tolist()
            keys, counts = [], []
            for line in lines:
                at = places(len(line))
                counts.append(len(at))
                keys += [digest(line[b:t], tag) for b, t, tag in at]
            if not keys:
                continue
            lengths = np.array([len(x) for x in lines])
            codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            letters = np.uint32(1) << ((codes * np.uint32(0x9E3779B1)) >> np.uint32(27))
            begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            bags = np.bitwise_xor.reduceat(letters, begins).view(np.int32)
            yield pd.DataFrame({
                "h1": np.repeat(rows.h1.to_numpy(), counts), "key": np.array(keys, dtype=np.uint64).view(np.int64),
                "bag": np.repeat(bags, counts),
            })

    return tidy(entries)


def _verified(max_edits: int, chars_per_edit: int):
    def check(batches):
        for rows in batches:
            near = []
            for a, b, n in zip(rows.line_a, rows.line_b, rows[["len_a", "len_b"]].min(axis=1), strict=True):
                limit = min(max_edits, int(n) // chars_per_edit)
                near.append(a != b and banded_distance(a, b, limit) <= limit)
            yield rows.loc[pd.Series(near, index=rows.index, dtype=bool), ["a", "b"]]

    return tidy(check)


def line_links(lines: DataFrame, max_edits: int = MAX_EDITS, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """Pairs (a, b) of h1, a < b, of different lines that are near: at most ``max_edits`` edits, and at most one for each
    ``chars_per_edit`` characters of the shorter line, so that short lines must be equal.

    A line that allows e edits is indexed under its e + 1 segments: e edits leave one untouched. Lines of its length, or up
    to e longer, probe the index at the places where the segment can lie. Shared keys give candidates, of which the join
    itself passes over those whose letters differ too much; a banded bit-parallel edit distance decides. There is no cap
    on keys or partners. Texts are shuffled once for each different line. Among 10^10 lines, one in about 10^9 shares its
    64-bit h1 with another line and is left out of this search.
    """
    # one aggregate for all four uses, with the same columns, so that its shuffle is made once
    long = lines.where(F.col("len") >= chars_per_edit)
    texts = long.groupBy("h1").agg(F.first("line").alias("line"), F.first("len").alias("len"))

    def entries(places_of, name: str) -> DataFrame:
        found = texts.mapInPandas(_entries(places_of, max_edits, chars_per_edit), "h1 bigint, key bigint, bag int")
        return found.select("key", F.col("h1").alias(name), F.col("bag").alias(f"bag_{name}"))

    index, probe = entries(index_places, "i"), entries(probe_places, "p")
    same_letters = F.bit_count(F.col("bag_i").bitwiseXOR(F.col("bag_p"))) <= 2 * max_edits
    met = index.join(probe, (index["key"] == probe["key"]) & (F.col("i") != F.col("p")) & same_letters)
    pairs = met.select(F.least("i", "p").alias("a"), F.greatest("i", "p").alias("b")).distinct()
    of = lambda x: texts.select(F.col("h1").alias(x), F.col("line").alias(f"line_{x}"), F.col("len").alias(f"len_{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").mapInPandas(
        _verified(max_edits, chars_per_edit), "a bigint, b bigint"
    )


def line_decisions(docs: DataFrame, max_edits: int = MAX_EDITS, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """(doc_id, version, n_lines, n_links, dropped) of each document: which lines go, as sorted positions.

    A line goes if an earlier line (by doc_id, then place in the text) equals it or is near it; n_links counts the links of
    its lines to different lines. Blank lines are no lines: they stay and are not counted, and null, empty and blank
    texts have none. Rows that repeat both doc_id and text are one document: they get one row, and each keeps the same
    lines. A null doc_id comes after the others.

    Scale: exact repeats meet as hashes with partial aggregation, so a line that is in a third of all documents is one row
    for each task; only lines that go or have links travel back to their documents, as positions and never as text.
    """
    lines = split_lines(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "spot")
    firsts = lines.select("h1", "h2", place.alias("place")).groupBy("h1", "h2").agg(F.min("place").alias("first"))
    links = materialize(line_links(lines, max_edits, chars_per_edit), "line-links")
    both = links.select(F.col("a").alias("own"), F.col("b").alias("other")).union(links.select("b", "a"))
    near = (
        both.join(firsts.select(F.col("h1").alias("other"), F.col("first").alias("other_first")), "other")
        .groupBy("own").agg(F.min("other_first").alias("near_first"), F.count(F.lit(1)).alias("links"))
    )
    states = firsts.join(near, firsts["h1"] == near["own"], "left").drop("own")
    marked = lines.select("doc_id", "spot", "h1", "h2").join(states, ["h1", "h2"])
    goes = (place != F.col("first")) | F.coalesce(F.col("near_first") < F.col("first"), F.lit(False))
    marked = marked.select("doc_id", "spot", goes.alias("goes"), F.coalesce("links", F.lit(0)).alias("links"))
    # a set, so that the lines of repeated rows count once
    told = marked.where(F.col("goes") | (F.col("links") > 0)).groupBy(
        F.col("doc_id").alias("t_doc"), F.shiftright("spot", 32).alias("t_version")
    ).agg(F.collect_set(F.struct(F.col("spot").bitwiseAND(F.lit((1 << 32) - 1)).alias("pos"), "goes", "links")).alias("told"))
    real = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: ~_blank(x))
    every = docs.select("doc_id", _version(F.col("text")).alias("version"), F.size(real).cast("long").alias("n_lines")).distinct()
    gone = F.transform(F.filter("told", lambda x: x["goes"]), lambda x: x["pos"].cast("int"))
    none = F.array().cast("array<int>")
    joined = every.join(told, F.col("doc_id").eqNullSafe(F.col("t_doc")) & (F.col("version") == F.col("t_version")), "left")
    return joined.select(
        "doc_id", "version", "n_lines",
        F.coalesce(F.aggregate("told", F.lit(0).cast("long"), lambda n, x: n + x["links"]), F.lit(0)).alias("n_links"),
        F.coalesce(F.sort_array(gone), none).alias("dropped"),
    )


def dedup_lines(docs: DataFrame, max_edits: int = MAX_EDITS, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """Documents without their repeated lines, with the columns of ``docs``; n_chars fits the new text.

    Documents that had lines and keep none are gone; null, empty and blank texts stay as they are.
    """
    kinds = dict(docs.dtypes)
    decided = line_decisions(docs, max_edits, chars_per_edit).where(F.size("dropped") > 0).select(
        F.col("doc_id").alias("d_doc"), F.col("version").alias("d_version"), "dropped", "n_lines"
    )
    joined = docs.select("doc_id", "text", "lang", "source", "n_chars", _version(F.col("text")).alias("version")).join(
        decided, F.col("doc_id").eqNullSafe(F.col("d_doc")) & (F.col("version") == F.col("d_version")), "left"
    )
    kept = joined.where(F.col("dropped").isNull() | (F.size("dropped") < F.col("n_lines")))
    cut = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("dropped", i))
    cut = kept.withColumn("text", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(cut, "\n")))
    length = F.when(F.col("dropped").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kinds["n_chars"]))
    return cut.select("doc_id", "text", "lang", "source", length.alias("n_chars"))

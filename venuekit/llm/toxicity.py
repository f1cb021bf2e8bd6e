"""Toxicity by a weighted lexicon: Aho-Corasick over folded text, normalised by length, with exception phrases."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.llm.language import held_out
from venuekit.session import discard, materialize

SAMPLE_DOCS = 2500
#: hash functions whose minima near copies have in common
MINIMA = 4
PREFIXES = (4, 5, 6)

# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s",
    "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ɑ": "a", "ɡ": "g", "ԁ": "d", "ⅼ": "l",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "l"}


def folder():
    """A function that folds a text to words of plain lower-case letters between single spaces, with one at each end."""
    import re
    import unicodedata

    marks = {i: None for i in (*range(0x300, 0x370), 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)}
    glyphs = marks | {ord(a): b for a, b in HOMOGLYPHS.items()}
    plain = bytes(
        ord(DIGITS.get(chr(i), chr(i))) if chr(i).isalnum() and i < 128 else 32 for i in range(256)
    )
    between = re.compile(r"(?<=[^\W_])[@$!|]+(?=[^\W_])")
    apart = re.compile(r"[\W_]+")
    numbers = str.maketrans(DIGITS)

    def fold(text: str) -> str:
        text = text.lower()
        if not text.isascii():
            text = unicodedata.normalize("NFKD", text).translate(glyphs)
        if any(s in text for s in SIGNS):
            text = between.sub(lambda m: "".join(SIGNS[s] for s in m[0]), text)
        if text.isascii():
            words = text.encode("ascii").translate(plain).decode("ascii").split()
        else:
            words = apart.sub(" ", text.translate(numbers)).split()
        return f" {' '.join(words)} "

    return fold


def automaton(model: dict):
    """The matcher of a model's patterns and exceptions; both begin with a space and so name the word that they begin in."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for pattern, weight in model["lexicon"].items():
        found.add_word(pattern, (weight, len(pattern)))
    for phrase in model["exceptions"]:
        found.add_word(phrase, (None, len(phrase)))
    found.make_automaton()
    return found


def hits(matcher, folded: str) -> dict[int, float]:
    """Weight of each word of a folded text that a pattern matches, by the place of the space before it.

    Of several patterns in a word the heaviest counts; words inside an exception phrase do not.
    """
    weights: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    if not len(matcher):
        return weights
    for end, (weight, length) in matcher.iter(folded):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        elif weight > weights.get(start, float("-inf")):
            weights[start] = weight
    if spared:
        weights = {s: w for s, w in weights.items() if not any(b <= s < e for b, e in spared)}
    return weights


def burden(weights, n_words: int) -> float:
    """Total weight of the hits against the length: twice as many in a much longer text weigh about the same."""
    import math

    return sum(weights) / math.log2(8 + n_words)


def _patterns(batches):
    """(pattern, toxic, clean) counts of texts that have it: whole words, and beginnings that several words may share."""
    fold = folder()

    def flush(counts):
        return pd.DataFrame([(p, t, c) for p, (t, c) in counts.items()], columns=["pattern", "toxic", "clean"])

    counts: dict = {}
    for rows in batches:
        for text, toxic in zip(rows.text, rows.toxic, strict=True):
            seen = set()
            for word in set(fold(text).split()):
                seen.add(f" {word} ")
                seen.update(f" {word[:n]}" for n in PREFIXES if len(word) >= n)
            for p in seen:
                pair = counts.setdefault(p, [0, 0])
                pair[0 if toxic else 1] += 1
            if len(counts) > 400_000:
                yield flush(counts)
                counts = {}
    yield flush(counts)


def _family(batches):
    """Adds a number that near copies mostly share and other texts do not: the smallest hashes of three words in a row under
    ``MINIMA`` functions. Texts that share half of their words in a row agree in all of them once in 16 times."""
    import xxhash

    for rows in batches:
        numbers = []
        for text in rows.text:
            w = text.split()
            runs = [" ".join(w[i : i + 3]).encode() for i in range(max(1, len(w) - 2))]
            least = [min(xxhash.xxh3_64_intdigest(r, seed=k) for r in runs) for k in range(MINIMA)]
            numbers.append(xxhash.xxh3_64_intdigest(repr(least).encode()) >> 1)
        yield rows.assign(family=numbers)


def _phrases(model: dict):
    """(phrase, toxic, clean) counts of the word pairs around hits."""

    def phrases(batches):
        fold, matcher = folder(), automaton(model)
        for rows in batches:
            out = []
            for text, toxic in zip(rows.text, rows.toxic, strict=True):
                folded = fold(text)
                seen = set()
                for start in hits(matcher, folded):
                    stop = folded.index(" ", start + 1)
                    before = folded.rfind(" ", 0, start)
                    after = folded.find(" ", stop + 1)
                    if before >= 0:
                        seen.add(folded[before : stop + 1])
                    if after >= 0:
                        seen.add(folded[start : after + 1])
                out += [(p, int(toxic), 1 - int(toxic)) for p in seen]
            yield pd.DataFrame(out, columns=["phrase", "toxic", "clean"]).astype({"toxic": "int64", "clean": "int64"})

    return phrases


def _burdens(model: dict):
    def weigh(batches):
        fold, matcher = folder(), automaton(model)
        for rows in batches:
            values = []
            for text in rows.text:
                folded = fold(text)
                values.append(burden(hits(matcher, folded).values(), folded.count(" ") - 1))
            yield rows.drop(columns="text").assign(burden=values)

    return weigh


def _cut(values: list[tuple[float, int]]) -> float:
    """The burden that parts the labels best (balanced accuracy), halfway between two that occur."""
    values = sorted(values)
    positives = sum(y for _, y in values)
    negatives = len(values) - positives
    if not positives or not negatives:
        return 0.5
    best, at, tp, fp = 0.0, values[-1][0] + 1.0, positives, negatives
    last = None
    for x, y in values:
        if last is not None and x > last:
            quality = tp / positives - fp / negatives
            if quality > best:
                best, at = quality, (x + last) / 2
        tp, fp, last = tp - y, fp - (1 - y), x
    return max(at, 1e-6)


def _unmatched(model: dict):
    """Toxic texts that no pattern matches, and all clean ones."""

    def rest(batches):
        fold, matcher = folder(), automaton(model)
        for rows in batches:
            open_ = [not toxic or not hits(matcher, fold(text)) for text, toxic in zip(rows.text, rows.toxic, strict=True)]
            yield rows[pd.Series(open_, index=rows.index, dtype=bool)]

    return rest


def _strong(texts: DataFrame, least_share: float, least_odds: float, chance: float) -> dict[str, float]:
    """Patterns that are far more common in toxic texts than chance allows, with the logarithm of how much."""
    import math

    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {}
    counts = texts.mapInPandas(_patterns, "pattern string, toxic bigint, clean bigint").groupBy("pattern").agg(
        F.sum("toxic").cast("double").alias("toxic"), F.sum("clean").cast("double").alias("clean")
    )
    n, base = F.col("toxic") + F.col("clean"), bad / (bad + good)
    share = F.col("toxic") / n
    # Chernoff's bound on the chance that so many of the n texts with the pattern are toxic
    surprise = n * (
        share * F.log(share / base)
        + F.when(F.col("clean") > 0, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(F.lit(0.0))
    )
    odds = ((F.col("toxic") + 0.5) / (bad + 1)) / ((F.col("clean") + 0.5) / (good + 1))
    support = max(3, math.ceil(least_share * bad))
    # few: a text has a bounded number of patterns, and each of these is in least_share of the toxic texts
    found = counts.where((F.col("toxic") >= support) & (odds >= least_odds) & (share > base) & (surprise >= -math.log(chance)))
    return {r["pattern"]: round(r["weight"], 6) for r in found.select("pattern", F.log(odds).alias("weight")).collect()}


def train(
    docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, least_share: float = 0.004, least_odds: float = 12.0,
    chance: float = 1e-5, rounds: int = 4,
) -> dict:
    """A lexicon with weights, exception phrases and the burden at which a text is toxic, from (doc_id, text) and (doc_id,
    toxic).

    Fitted on a bounded sample: at most ``sample_docs`` rows of each label, picked by a hash of doc_id; only they are
    broadcast. Near copies in the sample, which agree in several independent minima, count once. A pattern (a word, or the beginning of words) enters the lexicon if
    it is in a share ``least_share`` of the toxic texts, and 3 at least, is ``least_odds`` times as common there as in clean ones,
    and would be so by chance less often than ``chance``; its weight is the logarithm of that ratio. Toxic texts without
    any pattern so far are then held against the clean ones in the same way, up to ``rounds`` times: so rarer insults, as of
    a language with few texts, are found. A pair of words around a hit is an exception if 3 clean texts or more have it and at
    most one in ten of the texts that have it is toxic. Null labels and texts do not count.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic").distinct()
    picked = [
        known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for y in (0, 1)
    ]
    texts = docs.where(F.col("text").isNotNull() & (F.btrim("text") != "")).select("doc_id", "text")
    sample = texts.join(F.broadcast(picked[0].union(picked[1])), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    families = sample.mapInPandas(_family, "text string, toxic int, family bigint")
    # among near copies the one of the smallest hash stays, so that the choice does not depend on partitions
    chosen = families.groupBy("family", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "toxic")
    chosen = materialize(chosen, "toxic-sample")
    model: dict = {"lexicon": {}, "exceptions": [], "cut": 0.5}
    for _ in range(rounds):
        rest = chosen.mapInPandas(_unmatched(model), "text string, toxic int") if model["lexicon"] else chosen
        more = _strong(rest, least_share, least_odds, chance)
        if not more:
            break
        model["lexicon"] |= more
    model["lexicon"] = dict(sorted(model["lexicon"].items()))
    if model["lexicon"]:
        pairs = chosen.mapInPandas(_phrases(model), "phrase string, toxic bigint, clean bigint").groupBy("phrase").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
        )
        spared = pairs.where((F.col("clean") >= 3) & (F.col("toxic") * 10 <= F.col("clean") + F.col("toxic")))
        model["exceptions"] = [r["phrase"] for r in spared.orderBy("phrase").collect()]
        weighed = chosen.mapInPandas(_burdens(model), "toxic int, burden double").collect()  # the bounded sample
        model["cut"] = _cut([(r["burden"], r["toxic"]) for r in weighed])
    discard(chosen)
    return model


def score_texts(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and burden, score and predicted of every whole text; null text: empty, which has no burden.

    The score is 0.5 at the model's cut, tends to 1 above and to 0 below. The model (see ``train``; a lexicon of one's own has
    patterns that begin with a space, and end with one if they are whole words) goes to every task.
    """
    kinds = dict(docs.dtypes)
    columns = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    whole = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    weighed = whole.mapInPandas(_burdens(model), f"{columns}, burden double")
    ratio = F.col("burden") / F.lit(model["cut"])
    score: Column = ratio / (ratio + 1)
    return weighed.withColumn("score", score).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def document_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted, burden): learned from rows whose crc32(doc_id) mod 5 is not 0."""
    fold = held_out(F.col("doc_id"), 5, 0)
    model = train(docs, labels.where(~fold), sample_docs)
    scored = score_texts(docs.select("doc_id", "text", fold.alias("held_out")), model, keep=("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "score", "predicted", "burden")

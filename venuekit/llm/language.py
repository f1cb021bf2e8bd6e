"""Language ID: script ranges narrow the candidates, then Viterbi over per-word scores with a penalty for switching."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.llm.batches import slices, tidy

GRAMS = (2, 3, 4)
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SAMPLE_DOCS = 4000
SWITCH = 12.0
UNKNOWN = "und"
#: a word counts for or against a language by this much at most
LEAST = -20.0

# First and last code point of the main blocks of scripts that set languages apart.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("latin", 0x1E00, 0x1EFF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)


SCRIPT_NAMES = [*dict.fromkeys(name for name, _, _ in SCRIPTS), "other"]


class Speller:
    """Cuts batches of texts into words of letters and their character n-grams, as flat arrays."""

    def __init__(self) -> None:
        import sys

        import numpy as np

        # what a code point is: 0 nothing, 1 a letter, 2 white space; and the script of a letter
        count = sys.maxunicode + 1
        kinds = (1 if c.isalpha() else 2 if c.isspace() else 0 for c in map(chr, range(count)))
        self.kind = np.fromiter(kinds, np.uint8, count)
        self.script = np.full(count, len(SCRIPT_NAMES) - 1, dtype=np.uint8)
        for name, low, high in SCRIPTS:
            self.script[low : high + 1] = SCRIPT_NAMES.index(name)

    def words(self, texts: list[str]) -> dict:
        """codes (letters in lower case, one space before, between and after words), begins (of words in codes, at the
        space), doc (of each word), first and last (of each word in its text, in code points, end exclusive)."""
        import numpy as np

        low = [t.lower() for t in texts]
        low = [x if len(x) == len(t) else "".join(c.lower()[:1] for c in t) for x, t in zip(low, texts, strict=True)]
        joined = f" {' '.join(low)} "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts = np.cumsum([1, *[len(x) + 1 for x in low[:-1]]]) if low else np.zeros(0, int)
        kind = self.kind[codes]
        kept = np.flatnonzero(kind)
        gap = kind[kept] == 2
        once = np.ones(len(kept), dtype=bool)
        once[1:] = ~(gap[1:] & gap[:-1])
        place, gap = kept[once], gap[once]
        # a space after a dropped sign may still follow a space
        codes = np.where(gap, np.uint32(32), codes[place])
        edges = np.flatnonzero(gap)
        begins, ends = edges[:-1], edges[1:]
        first, last = place[begins + 1] if len(begins) else begins, place[ends - 1] + 1 if len(ends) else ends
        doc = np.searchsorted(starts, first, side="right") - 1
        return {"codes": codes, "gap": gap, "begins": begins, "doc": doc, "first": first - starts[doc], "last": last - starts[doc]}

    def scripts(self, words: dict):
        """The script of each word's first letter."""
        return self.script[words["codes"][words["begins"] + 1]]


def grams_of(words: dict):
    """For each n in ``GRAMS``: the bucket of the n-gram that begins at each place, ``BUCKETS`` where it leaves its word.

    A gram may begin or end with the space next to its word."""
    import numpy as np

    codes, gap = words["codes"], words["gap"]
    value, size = codes.copy(), len(codes)
    crosses = np.zeros(size, dtype=bool)
    for n in range(2, max(GRAMS) + 1):
        if n > size:
            return
        value[: size - n + 1] = value[: size - n + 1] * np.uint32(0x01000193) + codes[n - 1 :]
        if n > 2:
            crosses[: size - n + 2] |= gap[n - 2 :]
        if n in GRAMS:
            bucket = ((value ^ np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
            bucket[crosses] = BUCKETS
            bucket[size - n + 1 :] = BUCKETS
            yield bucket


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


@tidy
def _count(batches):
    """(lang, script, gram, n): n-grams of the different words of each text, and the scripts of these words."""
    import numpy as np

    speller = Speller()
    for rows in batches:
        out = []
        for lang, texts in rows.groupby("lang").text:
            total, scripts = np.zeros(BUCKETS + 1), np.zeros(len(SCRIPT_NAMES))
            for text in texts:
                # a text's words once each, so that one line said over and over is not the language
                words = speller.words([" ".join(sorted(set(text.split())))])
                if not len(words["begins"]):
                    continue
                for bucket in grams_of(words):
                    total += np.bincount(bucket, minlength=BUCKETS + 1)
                scripts += np.bincount(speller.scripts(words), minlength=len(SCRIPT_NAMES))
            out += [(lang, -1, int(g), float(total[g])) for g in np.flatnonzero(total[:BUCKETS])]
            out += [(lang, int(k), -1, float(scripts[k])) for k in np.flatnonzero(scripts)]
        yield pd.DataFrame(out, columns=["lang", "script", "gram", "n"])


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """Scores of n-grams in each language and the scripts it uses, from (text, lang) of labelled documents.

    Fitted on a bounded sample: about ``sample_docs`` documents of each language, or all if there are fewer, picked by a hash of
    the text. Counts are summed in Spark; the model has at most ``BUCKETS`` numbers a language.
    Rows without text or language do not count. The model is the same for any order or partitioning of the rows.
    """
    import numpy as np

    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(totals)
    model = {"langs": langs, "scores": np.zeros((BUCKETS, len(langs))), "scripts": np.ones((len(SCRIPT_NAMES), len(langs)), bool)}
    if not langs:
        return model
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / 1_000_003
    share = F.create_map(*[x for k, n in totals.items() for x in (F.lit(k), F.lit(min(1.0, sample_docs / n)))])
    sample = known.where(draw < F.element_at(share, F.col("lang")))
    counts = sample.mapInPandas(_count, "lang string, script int, gram int, n double").groupBy("lang", "script", "gram").agg(
        F.sum("n").alias("n")
    )
    table, scripts = np.zeros((BUCKETS, len(langs))), np.zeros((len(SCRIPT_NAMES), len(langs)))
    for r in counts.collect():  # bounded by BUCKETS and the scripts of a language
        if r["gram"] >= 0:
            table[r["gram"], langs.index(r["lang"])] = round(r["n"], 6)
        else:
            scripts[r["script"], langs.index(r["lang"])] = round(r["n"], 6)
    smooth = 0.5
    model["scores"] = np.log((table + smooth) / (table.sum(axis=0) + smooth * BUCKETS))
    used = scripts >= 0.01 * scripts.sum(axis=0)
    used &= scripts > 0
    # no language for a script: all are candidates
    model["scripts"] = np.where(used.any(axis=1, keepdims=True), used, True)
    return model


def word_scores(model: dict, speller: Speller, words: dict):
    """(words, languages) log scores against each word's best language (0 is the best).

    Only languages that use the word's script are candidates; if none does, all are.
    """
    import numpy as np

    table = model["table"]
    total = np.zeros((len(words["codes"]), table.shape[1]), dtype=np.float32)
    for bucket in grams_of(words):
        total += table[bucket]
    scores = np.add.reduceat(total, words["begins"], axis=0)
    scores[~model["scripts"][speller.scripts(words)]] = -np.inf
    # one strange word must not outweigh a sentence
    return np.maximum(scores - scores.max(axis=1, keepdims=True), np.float32(LEAST))


def gains(scores, best, begins):
    """For each text, the most that a run of its words scores better in other languages than in its best one.

    ``scores`` has the words of all texts, which begin at ``begins``; ``best`` is the best language of each word's text.
    """
    import numpy as np

    rows = np.arange(len(scores))
    own = scores[rows, best]
    others = scores.copy()
    others[rows, best] = -np.inf
    rival = others.max(axis=1).astype(np.float64) - own if scores.shape[1] > 1 else np.full(len(scores), -1.0)
    # a deep drop before each text makes it begin a new lowest sum
    marked = np.insert(rival, begins, -1e7)
    total = np.cumsum(marked)
    rise = total - np.minimum.accumulate(total)
    return np.maximum.reduceat(rise, begins + np.arange(len(begins)))


def viterbi(scores: list, switch: float = SWITCH) -> list:
    """For each of several texts, the best language of each word: sum of scores, less ``switch`` for each change.

    ``scores`` has a (words, languages) array for each text. Texts of similar length go step by step together.
    """
    import numpy as np

    paths = [np.zeros(len(s), dtype=np.int16) for s in scores]
    order = sorted((i for i in range(len(scores)) if len(scores[i])), key=lambda i: -len(scores[i]))
    while order:
        size = len(scores[order[0]])
        room = max(1, 2_000_000 // size)
        group = [i for i in order[:room] if 2 * len(scores[i]) > size]
        order = order[len(group) :]
        value = np.zeros((size, len(group), scores[group[0]].shape[1]), dtype=np.float32)
        for k, i in enumerate(group):
            value[: len(scores[i]), k] = scores[i]
        for t in range(1, size):  # each step adds the best way to come here; beyond a text's end nothing changes
            before = value[t - 1]
            value[t] += np.maximum(before, before.max(axis=1, keepdims=True) - np.float32(switch))
        best = value.argmax(axis=2).astype(np.int16)
        stays = value >= value.max(axis=2, keepdims=True) - np.float32(switch)
        rows, state = np.arange(len(group)), best[-1]
        chosen = np.empty((size, len(group)), dtype=np.int16)
        chosen[-1] = state
        for t in range(size - 2, -1, -1):
            state = np.where(stays[t, rows, state], state, best[t])
            chosen[t] = state
        for k, i in enumerate(group):
            paths[i] = chosen[: len(scores[i]), k].copy()
    return paths


def _verdict(langs: list, scores, path, first, last) -> tuple:
    """(lang_pred, score, spans) of a text by its words' scores, the path through them, and their places."""
    import numpy as np

    weight = np.bincount(path, minlength=len(langs))
    top = int(weight.argmax())
    used = int(weight[top])
    own = scores[path == top].mean(axis=0, dtype=np.float64)
    # how clearly the words of this language beat the runner-up, by their mean margin
    rival = max((x for k, x in enumerate(own) if k != top), default=LEAST)
    margin = (own[top] - rival) * min(used, 50)
    edges = [0, *(np.flatnonzero(np.diff(path)) + 1), len(path)]
    spans = [
        {"begin": int(first[x]), "end": int(last[y - 1]), "lang": langs[path[x]]}
        for x, y in zip(edges[:-1], edges[1:], strict=True)
    ]
    return langs[top], used / len(path) / (1 + math.exp(-max(-30.0, min(30.0, margin)))), spans


def _predict(model: dict, switch: float, keep: tuple[str, ...]):
    def predict(batches):
        import numpy as np
        import pyarrow as pa

        langs, speller = model["langs"], Speller()
        model["table"] = np.vstack([model["scores"], np.zeros((1, len(langs)))]).astype(np.float32)

        def label(texts: list[str], found: list, at: int, open_: list) -> None:
            """Fill in the texts whose language never changes; leave the others, with their scores, in ``open_``."""
            words = speller.words(texts)
            if not langs or not len(words["begins"]):
                return
            scores = word_scores(model, speller, words)
            begins = np.flatnonzero(np.diff(words["doc"], prepend=-1))
            docs, ends = words["doc"][begins], np.append(begins[1:], len(scores))
            best = np.add.reduceat(scores.astype(np.float64), begins, axis=0).argmax(axis=1)
            change = gains(scores, np.repeat(best, ends - begins), begins) > switch
            for doc, b, e, top, hard in zip(docs, begins, ends, best, change, strict=True):
                own, first, last = scores[b:e], words["first"][b:e], words["last"][b:e]
                if hard:
                    open_.append((at + doc, own.copy(), first.copy(), last.copy()))
                else:
                    found[at + doc] = _verdict(langs, own, np.full(e - b, top), first, last)

        span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
        kinds = (pa.string(), pa.float64(), pa.list_(span))
        for batch in batches:
            # the texts themselves stay Arrow buffers: a slice of them at a time becomes strings
            found, open_, parts, at = [(UNKNOWN, 0.0, [])] * batch.num_rows, [], [], 0
            for part in slices(batch):
                label([t or "" for t in part.column("text").to_pylist()], found, at, open_)
                parts.append((at, part))
                at += part.num_rows
            paths = viterbi([x[1] for x in open_], switch)
            for (i, own, first, last), path in zip(open_, paths, strict=True):
                found[i] = _verdict(langs, own, path, first, last)
            for at, part in parts:
                made = zip(*found[at : at + part.num_rows], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], *[pa.array(x, k) for x, k in zip(made, kinds, strict=True)]],
                    names=[*keep, "lang_pred", "score", "spans"],
                )

    return tidy(predict)


def identify(docs: DataFrame, model: dict, switch: float = SWITCH, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and lang_pred, score, spans of every whole text.

    Each word has a score in each language from its character n-grams, among the languages that use its script. The best
    path through the words pays ``switch`` for each change of language; its runs are the spans (code points, end
    exclusive). lang_pred has most words; ``und`` (score 0, no spans) if the text is null or has no letter, or nothing was
    learned. The score, 0 to 1, is the share of its words times how clearly they beat the next language.

    The model is small (see ``train``) and goes to every task. Ties go to the language first by name. Rows that repeat are
    treated alike.
    """
    kinds = dict(docs.dtypes)
    columns = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    span = "struct<begin int, end int, lang string>"
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(
        _predict(model, switch, keep), f"{columns}, lang_pred string, score double, spans array<{span}>"
    )


def document_languages(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, switch: float = SWITCH) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_spans): learned from documents whose crc32(doc_id) mod 4 is not 2."""
    fold = held_out(F.col("doc_id"), 4, 2)
    model = train(docs.where(~fold).select("text", "lang"), sample_docs)
    found = identify(docs.select("doc_id", "text", fold.alias("held_out")), model, switch, keep=("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def confident_documents(docs: DataFrame, least_score: float = 0.5, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` without those that language ID rejects: no language, or no single one that is clear in at least half."""
    fold = held_out(F.col("doc_id"), 4, 2)
    model = train(docs.where(~fold).select("text", "lang"), sample_docs)
    columns = ("doc_id", "text", "lang", "source", "n_chars")
    found = identify(docs, model, keep=columns)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select(*columns)

"""BPE encoding and decoding; long texts are encoded in parts and joined up a tree."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.llm.batches import slices, tidy

PIECE_CHARS = 1 << 15


def vocabulary_file() -> str:
    """The tokenizer's file on this machine, which its package names."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Codec:
    """Ids of a text, as the byte-level tokenizer in ``path`` gives them without adding special tokens, and the text of ids.

    Special tokens in a text are found as such. A vocabulary that is numbered in merge order is run by the faster of two
    libraries that then give the same ids, any other one by its own.
    """

    def __init__(self, path: str) -> None:
        import json

        import numpy as np
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        spec["truncation"] = spec["padding"] = None
        self.own = Tokenizer.from_str(json.dumps(spec))
        vocabulary = spec["model"]["vocab"]
        # byte-level vocabularies write byte b as the character b, or, if that is not a visible one, as the next after 255
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in visible]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocabulary.items() if t not in specials}
        self.bytes_of |= {i: t.encode() for t, i in specials.items()}
        self.size = np.zeros(max(self.bytes_of) + 1, dtype=np.int64)
        for i, b in self.bytes_of.items():
            self.size[i] = len(b)
        self.longest_special = max(map(len, specials), default=0)
        self.fast = self._fast(spec, specials)

    def _fast(self, spec: dict, specials: dict):
        kind = spec["pre_tokenizer"] or {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        vocabulary = spec["model"]["vocab"]
        ids = [vocabulary["".join(m)] for m in merges]
        plain = kind.get("type") == "ByteLevel" and not kind.get("add_prefix_space") and kind.get("use_regex")
        if not plain or spec["normalizer"] or ids != sorted(ids) or len(set(ids)) != len(ids):
            return None
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"]):
            return None
        import public_tokenizers
        import tiktoken

        ranks = {b: i for i, b in self.bytes_of.items() if i not in specials.values()}
        return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=specials)

    def encode(self, text: str) -> list[int]:
        if self.fast:
            return self.fast.encode(text, allowed_special="all")
        return self.own.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list) -> list[str]:
        return self.own.decode_batch(ids, skip_special_tokens=False)

    def _starts(self, ids, data: bytes):
        """Places where tokens begin, without those inside a character."""
        import numpy as np

        ends = np.cumsum(self.size[ids])
        begins = np.concatenate([[0], ends[:-1]])
        inside = np.frombuffer(data, dtype=np.uint8)[begins] & 0xC0 == 0x80
        return begins, inside

    def join(self, left: list[int], left_text: bytes, right: list[int], right_text: bytes) -> list[int]:
        """The ids of two texts put together, from the ids of each.

        A window around the border is encoded anew and widened until it agrees with both sides: its first token is the one
        that the left has there, its last the one that the right has. Merges depend on neighbours only, so tokens beyond
        such a window stay as they are. A window begins and ends where the rules that split words see no difference: at a
        space between a word and a letter, or between two letters; where a side has no such place it spans all of that side. It
        reaches further into each side than the longest special token, so that none is cut.
        """
        import numpy as np

        if not left or not right:
            return left or right
        size = 16
        l_begin, l_inside = self._starts(left, left_text)
        r_begin, r_inside = self._starts(right, right_text)
        margin = max(16, 4 * self.longest_special)

        def safe(data: bytes, at: int) -> bool:
            before = data[max(0, at - 4) : at].decode("utf-8", "ignore")[-1:]
            after = data[at : at + 8].decode("utf-8", "ignore")[:2]
            if after[:1] == " ":
                return after[1:].isalpha() and not before.isspace()
            return before.isalpha() and after[:1].isalpha()

        while True:
            i, j = len(left), 0
            while i > 0:
                i = max(0, i - size) if i == len(left) else i - 1
                if i == 0 or (not l_inside[i] and len(left_text) - l_begin[i] >= margin and safe(left_text, int(l_begin[i]))):
                    break
            while j < len(right):
                j = min(len(right), j + size) if j == 0 else j + 1
                if j == len(right) or (not r_inside[j] and r_begin[j] >= margin and safe(right_text, int(r_begin[j]))):
                    break
            cut = int(r_begin[j]) if j < len(right) else len(right_text)
            start = int(l_begin[i]) if i else 0
            window = self.encode((left_text[start:] + right_text[:cut]).decode("utf-8"))
            spans = np.cumsum(self.size[window]) if window else np.zeros(0, dtype=np.int64)
            # the tokens next to both edges of the window must be those that the sides have there
            agrees_left = i == 0 or (len(window) > 1 and window[0] == left[i])
            agrees_right = j == len(right) or (len(window) > 1 and window[-1] == right[j - 1])
            whole = len(spans) and spans[-1] == len(left_text) - start + cut
            if (agrees_left and agrees_right and whole) or (i == 0 and j == len(right)):
                return left[:i] + window + right[j:]
            size *= 4


def _encode_rows(path: str | None):
    def encode(batches):
        import pyarrow as pa

        codec = Codec(path or vocabulary_file())
        for batch in batches:
            names = [c for c in batch.schema.names if c != "text"]
            for part in slices(batch):
                ids = pa.array([codec.encode(t) for t in part.column("text").to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], ids], names=[*names, "ids"])

    return tidy(encode)


def _join_pairs(path: str | None):
    loaded: list[Codec] = []  # one for all groups of a task

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        if not loaded:
            loaded.append(Codec(path or vocabulary_file()))
        codec = loaded[0]
        rows = rows.sort_values("piece")
        level = [(list(map(int, ids)), text.encode()) for ids, text in zip(rows.ids, rows.piece_text, strict=True)]
        while len(level) > 1:
            up = [(codec.join(*a, *b), a[1] + b[1]) for a, b in zip(level[::2], level[1::2], strict=False)]
            level = up + ([level[-1]] if len(level) % 2 else [])
        first = rows.iloc[[0]][["doc_id", "row"]]
        return first.assign(ids=[level[0][0]])

    return join


def encode(docs: DataFrame, path: str | None = None, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text, as array<int>; null text: empty.

    A text of more than ``piece_chars`` code points is halved until its pieces are no longer. Pieces are rows and so are
    encoded in parallel; then neighbours are joined, pair by pair up the tree, by encoding growing windows around the border
    until both sides agree. The result is the same as encoding the text at once.

    Rows that repeat a doc_id are encoded each on its own (equal rows of long text share one result). A null doc_id is kept.
    ``path`` names the vocabulary file, on every machine; without it the installed package is asked.

    Scale: short texts are not shuffled. Pieces of a long text meet in one task for the joins, which re-encode a few
    tokens at each border; the row with its ids must be in one place anyway.
    """
    kind = dict(docs.dtypes)["doc_id"]
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    long = F.length("text") > piece_chars
    short_ids = whole.where(~long).mapInArrow(_encode_rows(path), f"doc_id {kind}, ids array<int>")
    # a text of n characters goes into 2^h equal parts
    pieces = F.pow(F.lit(2), F.ceil(F.log2(F.length("text") / F.lit(float(piece_chars))))).cast("int")
    cut = whole.where(long).select(
        "doc_id", F.xxhash64("text").alias("row"), "text", F.ceil(F.length("text") / pieces).cast("int").alias("step"),
        F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"),
    )
    cut = cut.select("doc_id", "row", "piece", F.expr("substring(text, piece * step + 1, step)").alias("text")).where("text != ''")
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = cut.repartition(width, "doc_id", "row", "piece").select("*", F.col("text").alias("piece_text"))
    encoded = parts.mapInArrow(
        _encode_rows(path), f"doc_id {kind}, row bigint, piece int, piece_text string, ids array<int>"
    ).dropDuplicates(["doc_id", "row", "piece"])
    joined = encoded.groupBy("doc_id", "row").applyInPandas(_join_pairs(path), f"doc_id {kind}, row bigint, ids array<int>")
    copies = whole.where(long).groupBy("doc_id", F.xxhash64("text").alias("row")).agg(F.count(F.lit(1)).alias("n"))
    again = joined.join(copies.select(F.col("doc_id").alias("c_doc"), F.col("row").alias("c_row"), "n"),
                        F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("row") == F.col("c_row")))
    again = again.select("doc_id", "ids", F.explode(F.sequence(F.lit(1), F.col("n")))).select("doc_id", "ids")
    return short_ids.union(again)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text): the text of each row of ids; null ids: null text."""
    kind = dict(encoded.dtypes)["doc_id"]

    def texts(batches):
        codec = Codec(path or vocabulary_file())
        for rows in batches:
            for begin in range(0, len(rows), 256):
                part = rows.iloc[begin : begin + 256]
                known = part.ids.notna()
                found = pd.Series(None, index=part.index, dtype="object")
                found[known] = codec.decode([x.tolist() for x in part.ids[known]])
                yield part.assign(text=found)

    return encoded.select("doc_id", "ids").mapInPandas(tidy(texts), f"doc_id {kind}, ids array<int>, text string")


def ids_digest(ids: Column) -> Column:
    """SHA-256, lowercase hex, of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256)

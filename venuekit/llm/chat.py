"""Chat formatting by a black-box template: each turn's span is found by rendering successive prefixes."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Template = Callable[[list[dict]], str]

# The strings by which common chat formats mark turns.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)


def escape(text: str, control: tuple[str, ...] = CONTROL) -> str:
    """A text without control strings: a backslash goes in after their first character. Backslashes are doubled."""
    text = text.replace("\\", "\\\\")
    for c in control:
        text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def unescape(text: str) -> str:
    """The text before ``escape``: a backslash stands for what follows it."""
    import re

    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def marked_turns(messages: list[dict]) -> str:
    """The standard template: each turn between a start mark with its role and an end mark, and control strings escaped.

    A line break in a role is escaped too, so that the first bare one ends the role.
    """
    out = []
    for m in messages:
        role = escape(m["role"]).replace("\n", "\\\n")
        out.append(f"<|im_start|>{role}\n{escape(m['text'])}<|im_end|>\n")
    return "".join(out)


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def locate(template: Template, messages: list[dict], assistant: str = "assistant") -> dict:
    """Render successive prefixes of a conversation and compare each output with the one before.

    A template that only adds to its output gives each turn the span that its prefix adds. One whose output for a longer
    prefix does not begin with the output for the shorter one rewrites history: ``rewrites`` has the places of such turns,
    and spans are then taken from where the outputs part. The text inside a span is what changes when the same turn is
    rendered with two other texts: what both share before and after it is the turn's frame.
    Returns formatted, rewrites, spans (role, begin, end, text_begin, text_end), and loss (spans of assistant texts).
    """
    before, spans, rewrites = "", [], []
    for i, message in enumerate(messages):
        now = template(messages[: i + 1])
        begin = len(before) if now.startswith(before) else _common(before, now)
        if begin < len(before):
            rewrites.append(i)
        probes = [template([*messages[:i], message | {"text": x}]) for x in ("a", "b")]
        head = _common(*probes)
        tail = _common(*(p[head:][::-1] for p in probes))
        if probes[0] == probes[1]:  # the template leaves this turn's text out
            head, tail = len(now), 0
        spans.append((message["role"], begin, len(now), min(head, len(now)), max(min(head, len(now)), len(now) - tail)))
        before = now
    loss = [(b, e) for role, _, _, b, e in spans if role == assistant]
    return {"formatted": before, "rewrites": rewrites, "spans": spans, "loss": loss}


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as an array of (turn, role, text).

    Null role or text: empty. Ties in turn go by role, then text; a null turn comes first. Rows that repeat are turns of
    their own. Rows without a conv_id make up one conversation.
    """
    part = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("turns"))


def format_conversations(turns: DataFrame, template: Template = marked_turns, assistant: str = "assistant") -> DataFrame:
    """(conv_id, formatted, rewrites, spans, loss): the formatted text of each conversation and where its turns are.

    Spans are in code points: role, begin and end of the turn, and of its text. ``loss`` has the begin and end of every
    assistant text: a mask to learn from. ``rewrites`` lists the turns at which the template changed what it had rendered
    before; then spans of earlier turns refer to earlier outputs and ``loss`` is empty, because a mask over the final text
    cannot be trusted. Turns are taken as by ``conversations_of``. No rows: no rows.

    Scale: a conversation is one row, like the text it becomes; conversations are independent. The template sees each
    prefix three times, so the work in a conversation grows with the square of its length.
    """
    kind = dict(turns.dtypes)["conv_id"]

    def render(batches):
        for rows in batches:
            found = []
            for conversation in rows.turns:
                got = locate(template, [{"role": t["role"], "text": t["text"]} for t in conversation], assistant)
                if got["rewrites"]:
                    got["loss"] = []
                found.append((got["formatted"], got["rewrites"], got["spans"], got["loss"]))
            names = ["formatted", "rewrites", "spans", "loss"]
            made = pd.DataFrame(found, columns=names, index=rows.index)
            made["spans"] = [[dict(zip(SPAN, s, strict=True)) for s in x] for x in made.spans]
            made["loss"] = [[{"begin": b, "end": e} for b, e in x] for x in made.loss]
            yield pd.concat([rows[["conv_id"]], made], axis=1)

    span = "struct<role string, begin int, end int, text_begin int, text_end int>"
    schema = f"conv_id {kind}, formatted string, rewrites array<int>, spans array<{span}>, loss array<struct<begin int, end int>>"
    return conversations_of(turns).mapInPandas(render, schema)


SPAN = ("role", "begin", "end", "text_begin", "text_end")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read from a text that ``marked_turns`` made, by its marks alone."""
    import re

    turn = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.S)
    found, at = [], 0
    while at < len(formatted):
        m = turn.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return found


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """The digests of op7, read back from the formatted text and its mask."""
    kind = dict(formatted.dtypes)["conv_id"]

    def digest(batches):
        from hashlib import sha256

        for rows in batches:
            out = []
            for conv_id, text, loss in zip(rows.conv_id, rows.formatted, rows.loss, strict=True):
                turns = read_turns(text)
                learned = "".join(unescape(text[x["begin"] : x["end"]]) for x in loss)
                said = "".join(f"{role}\n{words}\n" for role, words in turns)
                out.append((
                    conv_id, len(turns), sha256(said.encode()).hexdigest(), len(learned),
                    sha256(learned.encode()).hexdigest(), len(text),
                ))
            yield pd.DataFrame(
                out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            )

    return formatted.select("conv_id", "formatted", "loss").mapInPandas(
        digest,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )

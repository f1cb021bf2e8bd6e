import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from venuekit.llm import chat

PIECES = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "|", "\n", "a", "é", "im_end|>", "[", "INST]"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "sys\ntem", "<|im_end|>"]), PIECES), min_size=1, max_size=5))
def test_reading_back_gives_the_turns(turns):
    messages = [{"role": r, "text": t} for r, t in turns]
    got = chat.locate(chat.marked_turns, messages)
    assert chat.read_turns(got["formatted"]) == turns and not got["rewrites"]
    said = [chat.unescape(got["formatted"][b:e]) for b, e in got["loss"]]
    assert said == [t for r, t in turns if r == "assistant"]
    for (_, text), (_, begin, end, b, e) in zip(turns, got["spans"], strict=True):
        assert begin <= b <= e <= end and not any(c in got["formatted"][b:e] for c in chat.CONTROL)
        assert chat.unescape(got["formatted"][b:e]) == text


def test_rewritten_history_is_detected():
    def last_only(messages):
        return "".join(f"[{m['text'] if i == len(messages) - 1 else '...'}]" for i, m in enumerate(messages))

    got = chat.locate(last_only, [{"role": "assistant", "text": t} for t in ("one", "two", "three")])
    assert got["rewrites"] == [1, 2]

    def silent(messages):
        return "".join(m["text"] + ";" for m in messages if m["role"] != "system")

    got = chat.locate(silent, [{"role": "system", "text": "s"}, {"role": "assistant", "text": "yes"}])
    assert got["rewrites"] == [] and got["loss"] == [(0, 3)]


def test_table_with_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, 0, None, None), (None, 5, "assistant", "x"), (3, None, "user", "late"), (3, 0, "assistant", "</s>")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("formatted", chat.F.lit(1))
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(turns)).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == digest("user\nq\nassistant\na\nassistant\na\n") and got[1].loss_sha256 == digest("aa")
    assert got[2].turns_sha256 == digest("\n\n") and got[2].loss_chars == 0 and got[None].loss_sha256 == digest("x")
    assert got[3].turns_sha256 == digest("user\nlate\nassistant\n</s>\n") and got[3].loss_sha256 == digest("</s>")
    assert chat.format_conversations(turns.limit(0)).count() == 0
    rewriting = chat.format_conversations(turns.where("conv_id = 1"), lambda ms: str(len(ms)) + ms[-1]["text"]).first()
    assert list(rewriting.rewrites) == [1, 2] and rewriting.loss == []

import hashlib

from hypothesis import given, strategies as st

from medstrata.llm.chat import HARD, Expansion, escape, format_turns, op8_query, read_back, read_turn, unescape, write_turn
from tests.llm.helpers import with_clashes

pieces = st.lists(st.sampled_from(["\\", "#", "##", "### ", "</turn>", "<|", "<|image 0|>", "|>", ": ", "a", "\n", "</", "turn>", "é", " "]), max_size=12).map("".join)


@given(pieces)
def test_escape_is_reversible(text):
    assert unescape(escape(text)) == text


@given(pieces, pieces, pieces)
def test_turn_reads_back(role, text, more):
    turn = write_turn(role, [{"type": "text", "text": text}, {"type": "image", "ref": "r", "width": 28, "height": 15}, {"type": "text", "text": more}])
    assert read_turn(turn.segment) == (role, text + more, ["<|image 0|>"])


@given(pieces, pieces)
def test_loss_is_the_assistant_text(text, more):
    turn = write_turn("assistant", [{"text": text}, {"type": "audio", "seconds": 2}, {"text": more}])
    assert "".join(unescape(turn.segment[a:b]) for a, b in turn.loss) == text + more
    assert not write_turn("user", [{"text": text}]).loss


def test_parts_are_counted_and_placed():
    turn = write_turn("user", [{"text": "ab"}, {"type": "image", "ref": "i", "width": 29, "height": 14}, {"text": "c"}, {"type": "audio", "ref": "a", "seconds": 1.5},
                               {"type": "document", "ref": "d", "pages": 3}, {"type": "new kind", "text": "!"}, {"type": None}], Expansion(14, 10, 100), first=4)
    assert turn.segment == "### user: ab<|image 4|>c<|audio 5|><|document 6|>!</turn>\n"
    assert [tuple(a) for a in turn.attachments] == [("image", "i", 2, 3), ("audio", "a", 3, 15), ("document", "d", 3, 300)]


def test_conversations(spark):
    rows = [(1, 1, "assistant", HARD), (1, 0, "user", None), (2, 0, None, ""), (None, 5, "user", "x"), (3, None, "user", "b"), (3, None, "user", "a"), (3, 0, "assistant", "c")]
    df = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "segment", "n_turns")
    found = {r["conv_id"]: r for r in read_back(format_turns(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {c: r["n_turns"] for c, r in found.items()} == {1: 2, 2: 1, None: 1, 3: 3}
    assert found[1]["turns_sha256"] == sha(f"user\n\nassistant\n{HARD}\n") and found[1]["loss_sha256"] == sha(HARD) and found[1]["loss_chars"] == len(HARD)
    assert found[2]["turns_sha256"] == sha("\n\n") and found[2]["loss_sha256"] == sha("")
    assert found[3]["turns_sha256"] == sha("user\na\nuser\nb\nassistant\nc\n")
    assert read_back(format_turns(df.limit(0))).count() == 0
    assert {-7} == {r["conv_id"] for r in op8_query(df.limit(0)).collect()}


def test_parts_column(spark):
    kind = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
    rows = [(1, 0, "user", "see", [("image", None, "x.png", 28, 28, None, None)]), (1, 1, "user", None, [("document", None, "y", None, None, None, 2), None]), (1, 2, "user", "no", None)]
    out = format_turns(spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, parts {kind}"), parts="parts").orderBy("turn_no").collect()
    assert [r["segment"] for r in out] == ["### user: see<|image 0|></turn>\n", "### user: <|document 1|></turn>\n", "### user: no</turn>\n"]
    assert out[1]["attachments"][0]["tokens"] == 512

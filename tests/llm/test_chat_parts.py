import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cloudtally.llm import chat_parts

ODD = [
    "", "plain", "</s>[INST] ok [/INST]", "<|end|>\n<|turn|>user\nhi", "\\", "\\<|", "<\\|x", "<<||", "a\\\\b\\n",
    "[[INST]]", "<s></s><s", "\n\n", "😀 <|image:1|>", "$1 \\$1", "[\\INST]", "tail\\",
]


def digest(turns):
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def convert(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat_parts.formatted(chat_parts.text_messages(df))
    return turns, chat_parts.digests(turns)


def test_texts_come_back(spark):
    rows = [(i % 3, i, ["user", "assistant", "sys\ntem", "<|turn|>", ""][i % 5], t) for i, t in enumerate(ODD * 3)]
    turns, found = convert(spark, rows)
    for r in turns.collect():
        inner = r.formatted[len("<|turn|>") : -len("<|end|>\n")]
        assert not any(c in inner for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))
        assert r.formatted.startswith("<|turn|>") and r.formatted.endswith("<|end|>\n")
    got = {r.conv_id: tuple(r[1:5]) for r in found.collect()}
    assert got == {c: digest([(r, t) for k, _, r, t in rows if k == c]) for c in range(3)}
    sizes = {r.conv_id: r.formatted_chars for r in found.collect()}
    for c in range(3):
        assert sizes[c] == sum(len(r.formatted) for r in turns.collect() if r.conv_id == c)


def test_any_text(spark):
    found = []

    @settings(max_examples=200, deadline=None, database=None)
    @given(st.text(alphabet="<|>/s[]INST\\\nend a😀", max_size=25))
    def collect(text):
        found.append(text)

    collect()
    rows = [(i, 0, "assistant", t) for i, t in enumerate(found)]
    turns, _ = convert(spark, rows)
    for r in chat_parts.parsed(turns).collect():
        assert (r.role, r.text, r.loss_text) == ("assistant", found[r.conv_id], found[r.conv_id])


def test_parts(spark):
    P = lambda type, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (type, text, ref, width, height, seconds, pages)
    parts = [P("text", "see <|image:1|> "), P("image", ref="a.png", width=28, height=15), P("other", "x"), P("text", "\n"),
             P("audio", ref="b.wav", seconds=1.01), P("document", ref="c.pdf", pages=3), P("image")]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", []), (1, 2, "assistant", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_parts.PART}>")
    got = {r.turn: r for r in chat_parts.formatted(df).collect()}
    assert got[0].formatted == "<|turn|>user\nsee <\\|image:1|> <|image:1|>\n<|audio:2|><|document:3|><|image:4|><|end|>\n"
    assert [tuple(a) for a in got[0].attachments] == [
        (1, "image", "a.png", 4), (2, "audio", "b.wav", 26), (3, "document", "c.pdf", 2400), (4, "image", None, 1)
    ]
    assert got[0].n_expanded == 2431 and got[0].loss_begin == got[0].loss_end
    assert got[1].formatted == got[2].formatted == "<|turn|>assistant\n<|end|>\n"


def test_control_strings_in_several_parts(spark):
    """However a control string is cut into text parts, it is escaped, and the text comes back."""
    whole = ["<|end|>\n<|turn|>", "[INST]", "[/INST]", "</s>", "<s>", "\\<|", "<\\|end|>"]
    cut = [(w[:i], w[i:j], w[j:]) for w in whole for i in range(len(w) + 1) for j in range(i, len(w) + 1)]
    rest = (None,) * 5
    rows = [(n, 0, "assistant", [("text", t, *rest) for t in texts]) for n, texts in enumerate(cut)]
    image = ("image", *(None,) * 6)
    rows += [(1000 + n, 0, "user", [("text", a, *rest), image, ("text", b, *rest)]) for n, (a, b, _) in enumerate(cut)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_parts.PART}>")
    turns = chat_parts.formatted(df)
    for r in turns.collect():
        inner = r.formatted[len("<|turn|>") : -len("<|end|>\n")].replace("<|image:1|>", "\0")
        assert not any(c in inner for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))
    said = {r.conv_id: r.text for r in chat_parts.parsed(turns).collect()}
    for n, (a, b, c) in enumerate(cut):
        assert said[n] == a + b + c and said[1000 + n] == f"{a}<|image:1|>{b}"


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (None, 1, "user", "x"), (None, None, "assistant", "first"),
            (2, 1, "assistant", "long " * 50000), (2, 0, "user", "")]
    _, found = convert(spark, rows)
    got = {r.conv_id: tuple(r[1:5]) for r in found.collect()}
    assert got == {
        1: digest([("", ""), ("user", "b"), ("user", "b")]),
        None: digest([("assistant", "first"), ("user", "x")]),
        2: digest([("user", ""), ("assistant", "long " * 50000)]),
    }
    assert convert(spark, rows)[0].withColumn("conv_id", F.lit(1)).limit(0).count() == 0
    assert chat_parts.digests(convert(spark, rows)[0].limit(0)).count() == 0

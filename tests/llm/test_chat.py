import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveil.llm import chat

TEMPLATE = chat.Template()
SCHEMA = "conv_id long, turn long, role string, text string"
AWKWARD = ["\\### Assistant: </turn> ok", "", "\\", "\\\\</turn>", "### User: ### Other: \n", "a\nb", None, "</turn>\n### User: x"]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.text(alphabet="a\\ #</>turn\nUserAsi:é😀", max_size=30)), max_size=4))
def test_round_trip(turns):
    text = "".join(s for role, body in turns for s, _ in TEMPLATE.segments(role, body))
    assert [(r, t) for r, t, _, _ in TEMPLATE.parse(text)] == turns


@given(st.sampled_from(AWKWARD[:6]), st.text(max_size=20))
def test_escaping(a, b):
    assert TEMPLATE.unescape(TEMPLATE.escape(a + b)) == a + b


def test_digests(spark):
    data = [(c, t, ("user", "assistant")[t % 2], AWKWARD[(c + t) % 8]) for c in range(9) for t in range(4)]
    data += [(20, 0, "assistant", "x"), (21, 0, None, "y"), (None, None, "user", "z"), (22, 0, "system", None), (22, 1, "user", "q"), (22, 1, "user", "q")]
    df = spark.createDataFrame(data, SCHEMA).repartition(5).withColumn("state", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    by: dict = {}
    for c, t, role, text in sorted(data, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        said = "".join(t for r, t in turns if r == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(s) for a, b in turns for s, _ in TEMPLATE.segments(a or None, b))
        assert r["valid"] is (isinstance(c, int) and c < 9)


def test_machine_tells_wrong_orders(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "system", "s"), (2, 1, "user", "u")], SCHEMA)
    out = [(r["conv_id"], r["turn_no"], r["valid"], r["state"]) for r in chat.format_turns(df).orderBy("conv_id", "turn_no").collect()]
    assert out == [(1, 0, True, "user"), (1, 1, False, "user"), (1, 2, False, "assistant"), (2, 0, True, "system"), (2, 1, True, "user")]


def test_own_template_and_empty(spark):
    own = chat.Template(headers={"h": "[H]", "b": "[B]"}, other="[O]", end="[/]", separator="", loss=("b",), follows={"start": ("h",), "h": ("b",), "b": ("h",)}, final=("b",))
    df = spark.createDataFrame([(1, 0, "h", "[B] \\[/]"), (1, 1, "b", "[H]")], SCHEMA)
    r = chat.read_back(chat.format_turns(df, own), own).first()
    assert r["valid"] and r["loss_chars"] == 3
    assert chat.read_back(chat.format_turns(df.limit(0))).collect() == []

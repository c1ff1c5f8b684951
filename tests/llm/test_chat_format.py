import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from siftworks.llm import chat_format as cf

ROLES = ("system", "user", "assistant", "tool", "", "[ROLE] x")
TEXT = st.lists(st.sampled_from([*cf.CONTROLS, "\\", " ", "\n", "a", "[", "<", "é", "INST]", "/", "😀", "</s", "ok"]), max_size=12).map("".join)


def brute(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), len(cf.instruct(turns)), False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ROLES), TEXT), max_size=8))
def test_pieces_join_to_the_whole_and_read_back(turns):
    renderer = cf.Renderer(cf.instruct, window=4)
    pieces, texts = [], []
    for role, text in turns:
        piece, a, b, rewritten = renderer.add(role, text)
        assert not rewritten
        pieces.append(piece)
        texts.append(cf.unescape(piece[a:b]))
    if turns:
        assert "".join(pieces) == cf.instruct(turns)
    assert texts == [t for _, t in turns]
    assert [t for p in pieces for t in cf.read_turns(p)] == turns == cf.read_turns(cf.instruct(turns))


def test_template_that_rewrites_history_is_told():
    def last_only(turns):
        return "".join(f"<{r}>{t if i == len(turns) - 1 or r != 'assistant' else ''}" for i, (r, t) in enumerate(turns))
    renderer = cf.Renderer(last_only)
    assert [renderer.add(r, t)[3] for r, t in (("user", "a"), ("assistant", "b"), ("user", "c"))] == [False, False, True]


def test_long_conversations_of_templates_that_look_back(spark):
    def numbered(turns):
        return "<s>" + "".join(f"[{i}|{r}|{t}|{turns[0][1]}]" for i, (r, t) in enumerate(turns))

    def last_system(turns):  # the system text stands in the last user turn
        last = max((i for i, (r, _) in enumerate(turns) if r == "user"), default=-1)
        return "".join(f"<{r}>{turns[0][1] if i == last else ''}{t}" for i, (r, t) in enumerate(turns))

    turns = [("system", "rules")] + [(("user", "assistant")[i % 2], f"turn {i}") for i in range(150)]
    table = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)] + [(2, 0, "user", "short")], "conv_id long, turn long, role string, text string")
    rows = [r for r in cf.format_turns(table, numbered).orderBy("position").collect() if r["conv_id"] == 1]
    assert "".join(r["piece"] for r in rows) == numbered(turns) and not any(r["rewritten"] for r in rows)
    moved = [r for r in cf.format_turns(table, last_system).orderBy("position").collect() if r["conv_id"] == 1]
    assert [r["rewritten"] for r in moved] == [r == "user" and i > 1 for i, (r, _) in enumerate(turns)]
    wrong = cf.turn_local(lambda turns: numbered(turns))
    marked = {(r["conv_id"], r["position"]) for r in cf.format_turns(table, wrong).where("rewritten").collect()}
    assert (1, len(turns) - 1) in marked and not any(c == 2 for c, _ in marked)


def test_digests(spark):
    rows = [(1, 1, "assistant", "yes", 5), (1, 0, "user", "q", 5), (2, 0, "assistant", None, 5), (3, 0, None, "x", 5), (3, 0, None, "x", 5),
            (None, 0, "user", "n", 5), (4, None, "user", "[INST]\\", 5), (5, 0, "assistant", "long " * 50_000, 5)]
    rows += [(6, i, ("user", "assistant")[i % 2], f"turn {i} </s>", 5) for i in range(300)]
    table = cf.with_probe(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int"))
    got = {r[0]: tuple(r)[1:] for r in cf.read_back(cf.format_turns(table)).collect()}
    groups = {}
    for conv, turn, role, text in [r[:4] for r in rows] + [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]:
        groups.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert got == {conv: brute([t[1:] for t in sorted(turns)]) for conv, turns in groups.items()}
    assert cf.read_back(cf.format_turns(table.limit(0))).count() == 0


def test_given_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    groups = {}
    for r in table.orderBy("conv_id", "turn").collect():
        groups.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    got = {r[0]: tuple(r)[1:] for r in cf.read_back(cf.format_turns(table)).collect()}
    assert got == {conv: brute(turns) for conv, turns in groups.items()}

from ingestflow.llm import chat
from ingestflow.llm.common import Workspace, read_table
from tests.conftest import SF_MID

ROW = "conv_id long, turn long, role string, text string, transcript string"


def model(spark):
    return chat.learn(read_table(spark, SF_MID, "conversations"))


def test_roles_of_given_conversations(spark):
    from ingestflow.llm.queries import op3_transcripts
    rows = op3_transcripts(spark, SF_MID).collect()
    total = read_table(spark, SF_MID, "conversations").select("conv_id").distinct().count()
    assert len(rows) == total
    assert sum(r.n_right for r in rows) / sum(r.n_lines for r in rows) > 0.97
    one = next(r for r in rows if r.n_right == r.n_lines)
    assert one.rendered.count("<|end|>") == one.n_turns


def test_markers_the_model_was_not_written_with(spark):
    m = model(spark)
    text = "Human: What is this?\nIt is odd.\n\nAI: A test, with\ntwo lines.\nHuman: Thanks."
    assert [r for r, _ in chat.parse(text, m)] == ["user", "assistant", "user"]
    assert chat.parse(text, m)[1][1] == "A test, with\ntwo lines."
    names = "Carla: hello there, friend.\nDan: Good morning to you.\nCarla: And now?"
    assert [r for r, _ in chat.parse(names, m)] == ["user", "assistant", "user"]


def test_viterbi_equals_all_paths(spark):
    import itertools
    import math
    m = model(spark)
    lines = ["User: hi there.", "more", "Bot: yes"]
    seen = chat.features(lines)

    def score(path):
        s = m.first[path[0]]
        for i, f in enumerate(seen):
            s += sum(m.seen[path[i]][k][v] for k, v in enumerate(f))
            if i:
                s += m.step[path[i - 1]][path[i]]
        return s

    best = max(itertools.product(range(6), repeat=3), key=score)
    assert math.isclose(score(best), score(m.viterbi(lines)))


def test_round_trip(spark):
    m = model(spark)
    turns = [("system", "Be kind."), ("user", "Why is it so?\nTell me."), ("assistant", "Because.\nOf that.")]
    for style in range(len(chat.STYLES)):
        text, states = chat.transcript(turns, style)
        assert m.viterbi(text.split("\n")) == states
        assert chat.parse(text, m) == turns


def test_edge_cases(spark, monkeypatch):
    m = model(spark)
    assert chat.parse(None, m) == [] and chat.parse("", m) == [] and chat.render([]) == ""
    assert len(chat.parse("User: a\n" + "x\n" * 20000, m)) >= 1
    monkeypatch.setattr(chat, "PIECE_ROWS", 10)
    rows = [(1, 0, "user", "hello", "c"), (1, 0, "user", "hello", "c"), (1, 1, None, "odd", "c"),
            (1, 2, "user", None, "c"), (None, 0, "user", "no id", "c"), (2, None, "user", "no turn", "c"),
            (3, 0, "user", "", "c")]
    rows += [(9, 5, "user", f"text {i}", "c") for i in range(100)]      # one turn number, many rows
    rows += [(8, i, ("user", "assistant")[i % 2], f"t {i}.", "c") for i in range(200)]
    df = spark.createDataFrame(rows, ROW).select("conv_id", "turn", "role", "text")
    got = chat.pieces(df, Workspace(spark, "t")).collect()
    assert sum(len(r.turns) for r in got if r.conv_id == 9) == 100
    assert len([r for r in got if r.conv_id == 9]) > 3
    assert {r.piece for r in got if r.conv_id == 8} == {0, 1, 2, 3}
    assert sum(len(r.turns) for r in got if r.conv_id == 1) == 2
    assert {r.conv_id for r in got} == {1, 2, 3, 8, 9, None}


def test_empty_table(spark):
    df = spark.createDataFrame([], ROW).select("conv_id", "turn", "role", "text")
    assert chat.pieces(df, Workspace(spark, "t")).collect() == []
    m = chat.learn(df)
    assert chat.parse("User: hi", m)

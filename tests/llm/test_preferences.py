from flowguard.llm import preferences


def talk(*turns):
    return [{"role": r, "text": t} for r, t in turns]


def shown(turns):
    return "".join(f"<|{t['role']}|>\n{t['text']}<|end|>\n" for t in turns)


def test_prompt_completions_and_masks(spark):
    a = talk(("system", "s"), ("user", "hi"), ("assistant", "good é"), ("user", "thanks"), ("assistant", ""))
    b = talk(("system", "s"), ("user", "hi"), ("assistant", "bad"))
    cases = {"p": (a, b), "same": (b, b), "prefix": (a[:2], a), "nothing": (a, talk(("user", "hi"))), "empty": ([], b)}
    df = spark.createDataFrame([(k, *v) for k, v in cases.items()],
                               "pair_id string, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    got = {r.pair_id: r for r in preferences.format_preferences(df).collect()}
    for k, n in {"p": 2, "same": 3, "prefix": 2, "nothing": 0, "empty": 0}.items():
        r, (x, y) = got[k], cases[k]
        assert (r.n_common, r.prompt, r.chosen, r.rejected) == (n, shown(x[:n]), shown(x[n:]), shown(y[n:]))
        assert r.differs == (x[n:] != y[n:])
        for text, mask, turns in ((r.chosen, r.chosen_mask, x[n:]), (r.rejected, r.rejected_mask, y[n:])):
            assert [text[s.start:s.end] for s in mask] == [t["text"] + "<|end|>\n" for t in turns if t["role"] == "assistant"]


def test_conversations_take_nulls_repeats_and_order(spark):
    rows = [(1, 1, "assistant", "b", 0), (1, 0, "user", "a", 0), (1, None, None, None, 0), (1, 1, "assistant", "b", 0), (None, 0, "user", "x", 0),
            (2, 0, "user", "q", 0), (3, 0, "assistant", "z", 0)]
    talks = preferences.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int"))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in talks.collect()}
    assert got == {1: [("user", ""), ("user", "a"), ("assistant", "b"), ("assistant", "b")], 2: [("user", "q")], 3: [("assistant", "z")]}
    assert [r.pair_id for r in preferences.neighbours(talks).collect()] == ["next-1"]
    assert [r.pair_id for r in preferences.retold(talks).collect()] == ["own-1"]
    assert preferences.format_preferences(preferences.retold(talks.limit(0))).count() == 0

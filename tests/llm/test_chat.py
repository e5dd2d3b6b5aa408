from tidemark.llm.chat import preference_pairs, with_other_answers

SCHEMA = "pair_id bigint, turn bigint, role string, text string"


def shown(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def test_common_turns_are_rendered_once(spark):
    chosen = [(1, 0, "system", "S"), (1, 1, "user", "q é👍"), (1, 2, "assistant", "good"), (1, 3, "user", "more"), (1, 4, "assistant", "ok")]
    rejected = [(1, 0, "system", "S"), (1, 1, "user", "q é👍"), (1, 2, "assistant", "bad"), (2, 0, "user", "alone")]
    extra = ["'x' AS _side", "1 AS c", "2 AS n_common"]
    left = spark.createDataFrame(chosen, SCHEMA).selectExpr("*", *extra)
    got = {r["pair_id"]: r for r in preference_pairs(left, spark.createDataFrame(rejected, SCHEMA)).collect()}
    one = got[1]
    assert one["n_common"] == 2 and one["prompt"] == shown([("system", "S"), ("user", "q é👍")])
    assert one["chosen"] == shown([("assistant", "good"), ("user", "more"), ("assistant", "ok")])
    assert [one["chosen"][s["start"] : s["end"]] for s in one["chosen_mask"]] == ["good<|end|>\n", "ok<|end|>\n"]
    assert [one["rejected"][s["start"] : s["end"]] for s in one["rejected_mask"]] == ["bad<|end|>\n"]
    two = got[2]
    assert (two["n_common"], two["prompt"], two["chosen"], two["chosen_mask"]) == (0, "", "", [])
    assert two["rejected"] == shown([("user", "alone")])


def test_odd_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "a", "tie"), (1, 0, "a", "tie"), (None, 0, "user", "lost"), (3, 0, "assistant", "x" * 200_000)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = {r["pair_id"]: r for r in preference_pairs(table, table).collect()}
    assert set(got) == {1, 3} and got[1]["n_common"] == 4
    assert got[1]["prompt"] == shown([("user", "first"), (None, None), ("a", "tie"), ("a", "tie")])
    assert got[1]["chosen"] == got[1]["rejected"] == "" and got[3]["chosen_mask"] == []
    assert preference_pairs(table.limit(0), table.limit(0)).count() == 0


def test_other_answers(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (2, 0, "user", "p"), (2, 1, "assistant", "early"), (2, 2, "user", "r"),
            (2, 3, "assistant", "a2"), (4, 0, "user", "none")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted(tuple(r) for r in with_other_answers(table).collect())
    assert got == [(1, 0, "user", "q"), (1, 1, "assistant", "a2")]

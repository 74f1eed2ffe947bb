from notemask.llm import chat

TURN = "array<struct<turn:bigint,role:string,text:string>>"


def formatted(spark, chosen, rejected):
    rows = spark.createDataFrame([(chosen, rejected)], f"chosen {TURN}, rejected {TURN}")
    return chat.format_preferences(rows).first()


def learnt(text, spans):
    return [text[int(a) : int(b)] for a, b in (s.split(":") for s in spans.split(",") if s)]


def test_prefix_is_rendered_once_and_only_replies_are_learnt(spark):
    start = [(0, "system", "Be brief."), (1, "user", "Hi")]
    r = formatted(spark, [*start, (2, "assistant", "Hello"), (3, "user", "ok"), (4, "assistant", "Bye é😀")], [*start, (2, "assistant", "No")])
    assert r.n_common == 2
    assert r.prompt == "<|system|>\nBe brief.<|end|>\n<|user|>\nHi<|end|>\n"
    assert r.chosen_text == "<|assistant|>\nHello<|end|>\n<|user|>\nok<|end|>\n<|assistant|>\nBye é😀<|end|>\n"
    assert learnt(r.chosen_text, r.chosen_loss) == ["Hello<|end|>\n", "Bye é😀<|end|>\n"]
    assert learnt(r.rejected_text, r.rejected_loss) == ["No<|end|>\n"]


def test_equal_null_and_empty_conversations(spark):
    same = [(0, "user", None), (1, None, "x <|end|>")]
    r = formatted(spark, same, same)
    assert (r.n_common, r.chosen_text, r.rejected_text, r.chosen_loss) == (2, "", "", "")
    assert r.prompt == "<|user|>\n<|end|>\n<|unknown|>\nx < |end|><|end|>\n"
    r = formatted(spark, None, [(0, "assistant", "")])
    assert (r.n_common, r.prompt, r.chosen_text, r.rejected_loss) == (0, "", "", "14:22")
    r = formatted(spark, same[:1], same)
    assert (r.n_common, r.chosen_text) == (1, "")


def test_pairs_swap_the_last_reply(spark):
    rows = [
        (0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 2, "user", "late"), (1, 0, "user", "p"), (1, 1, "assistant", "b"),
        (2, 0, "user", "alone"), (4, 0, "assistant", "no partner"), (None, 0, "user", "lost"), (-1, 0, "assistant", "m"),
        (0, 0, "user", "q"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS pair")
    found = {r.conv_id: r for r in chat.preference_pairs(table).collect()}
    assert sorted(found) == [-1, 0, 1, 2, 4]
    assert [t.text for t in found[0].chosen] == ["q", "q", "a"] and [t.text for t in found[0].rejected] == ["q", "q", "b"]
    assert [t.text for t in found[2].chosen] == [t.text for t in found[2].rejected] == ["alone"]
    assert found[4].rejected == [] and found[-1].rejected == []


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_preferences(chat.preference_pairs(empty)).count() == 0


def test_columns_with_any_names_stay(spark):
    rows = spark.createDataFrame([([(0, "user", "x")], [(0, "user", "y")])], f"chosen {TURN}, rejected {TURN}")
    names = ["_a", "_b", "_head", "row", "a", "b", "head"]
    r = chat.format_preferences(rows.selectExpr("*", *(f"'mine' AS `{n}`" for n in names))).first()
    assert all(r[n] == "mine" for n in names) and r.n_common == 0

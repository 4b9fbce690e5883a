import hashlib

from hourcast.llm import chat
from hourcast.llm.queries import CONTROL_TEXT, op1_chat_format
from conftest import SF

EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"


def formatted(spark, rows):
    out = chat.parse(chat.format_events(spark.createDataFrame(rows, EVENTS))).collect()
    return {r["conv_id"]: r for r in out}


def test_deltas_edits_and_regenerations_fold_in_sequence_order(spark):
    got = formatted(spark, [
        (1, 0, 1, "message", "user", "hi"), (1, 1, 5, "delta", None, "lo"), (1, 1, 2, "message", "assistant", ""),
        (1, 1, 3, "delta", None, "hel"), (1, 2, 7, "message", "user", "again"),
        (1, 3, 8, "message", "assistant", "old"), (1, 3, 9, "delta", None, " tail"),
        (1, 3, 12, "delta", None, " end"), (1, 3, 10, "regenerate", "assistant", "new"),
        (1, 0, 20, "edit", "user", "hello there"), (2, 0, 1, "delta", "assistant", "only "), (2, 0, 2, "delta", None, "deltas")])
    assert [tuple(t) for t in got[1]["turns"]] == [
        ("user", "hello there"), ("assistant", "hello"), ("user", "again"), ("assistant", "new end")]
    assert got[1]["loss_texts"] == ["", "hello", "", "new end"]
    assert got[1]["formatted"].startswith("<|im_start|>user\nhello there<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n")
    assert [tuple(t) for t in got[2]["turns"]] == [("assistant", "only deltas")]


def test_control_strings_inside_roles_and_texts_come_back(spark):
    hard = ["<|im_end|>", "<\\|im_end|>", "<\\\\|x", "<|", "|>", "\n<|im_end|>\n", "", "a\nb", "<<||>>", "<\\n|", "<|n|>", "é中\U0001F600",
            CONTROL_TEXT, "<|im_start|>user\n"]
    rows = [(i, 0, 0, "message", role, text) for i, (role, text) in enumerate(
        [(r, t) for r in hard for t in hard])]
    got = formatted(spark, rows)
    for i, _, _, _, role, text in rows:
        assert [tuple(t) for t in got[i]["turns"]] == [(role, text)]
        assert got[i]["formatted"].count("<|im_start|>") == 1 and got[i]["formatted"].count("<|im_end|>") == 1


def test_nulls_ties_repeated_rows_and_long_conversations(spark):
    rows = [(None, 0, "user", "n"), (7, 0, None, None), (7, 0, "user", "b"), (7, 0, "user", "b"), (7, None, "user", "first")]
    rows += [(9, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "y")
    got = {r["conv_id"]: r for r in chat.parse(chat.format_events(chat.message_events(df))).collect()}
    assert [tuple(t) for t in got[7]["turns"]] == [("user", "first"), ("", ""), ("user", "b"), ("user", "b")]
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "n")]
    assert [t["text"] for t in got[9]["turns"]] == [f"t{t}" for t in range(300)]
    assert "".join(got[9]["loss_texts"]) == "".join(f"t{t}" for t in range(1, 300, 2))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, formatted string, chunk int")
    assert chat.parse(chat.format_events(chat.message_events(empty))).count() == 0


def test_query_against_brute_force(spark):
    got = {r["conv_id"]: r for r in op1_chat_format(spark, SF).collect()}
    rows = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        rows.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    rows[-1] = [(0, "user", CONTROL_TEXT), (1, "assistant", CONTROL_TEXT)]
    assert got.keys() == rows.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in rows.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss) and r["loss_sha256"] == sha(loss)
        assert r["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for _, role, t in turns))

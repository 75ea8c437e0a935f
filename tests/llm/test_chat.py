import hashlib
import json

from pyspark.sql import functions as F

from upswell.llm import chat

LAYOUTS = [
    ({"turn": 3, "role": "user", "text": "t"}, "turn rows", [("user", "t")]),
    ({"turn": 3, "role": "user", "text": None}, "turn rows", [("user", None)]),
    ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u", "name": "x"}], "id": 9}, "messages", [("system", "s"), ("user", "u")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations", [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}], "system": "s"}, "conversations", [("system", "s"), ("user", "q")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "more", "output": "o", "key": {"a": 1}}, "instruction", [("user", "i\n\nmore"), ("assistant", "o")]),
    ({"prompt": "p", "completion": "c"}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"system": "s", "prompt": "p", "response": "r"}, "prompt and response", [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"question": "?", "answer": "!"}, None, [(None, None)]),
    ({"messages": []}, None, [(None, None)]),
    (None, None, [(None, None)]),
]


def test_layouts_by_fingerprint(spark):
    rows = [(i, None if r is None else json.dumps(r), "x") for i, (r, _, _) in enumerate(LAYOUTS)]
    records = spark.createDataFrame(rows, "conv_id long, j string, layout string").withColumn("record", F.parse_json("j"))
    got = {}
    for r in chat.canonical_turns(records).orderBy("conv_id", "place").collect():
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    assert got == {i: [(name, *t) for t in turns] for i, (_, name, turns) in enumerate(LAYOUTS)}
    assert chat.canonical_turns(records.limit(0)).collect() == []


def test_format_is_reversible(spark, rng):
    parts = ["<|im_end|>", "<|im_start|>", "<|", "|>", "<", "|", "\\", "\\b", "\\l", "\\n", "\n", "user", "é🙂", " "]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
    rows = [(c, t, rng.choice(["user", "assistant", "tool\n\\<|x"]), rng.choice([text(), None])) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(99, t, "assistant" if t % 2 else "user", f"{t}") for t in range(700)] + [(98, 0, "assistant", None), (None, 1, None, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, place long, role string, text string").withColumn("layout", F.lit("rows"))
    done = chat.formatted(turns).withColumn("formatted", chat.text_of("segments"))
    back = done.select("conv_id", "formatted", chat.turns_in(F.col("formatted")).alias("turns"), chat.loss_text("segments").alias("loss"), "segments").collect()
    want = {}
    for c, t, role, said in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        want.setdefault(c, []).append((role or "", said or ""))
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back} == want
    for r in back:
        assert r.loss == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert r.formatted.count("<|im_start|>") == len(want[r.conv_id]) == r.formatted.count("<|im_end|>")
        assert "".join(s.text for s in r.segments) == r.formatted


def test_query_on_control_strings(spark, tmp_path):
    from upswell.llm.queries import QUERIES

    spark.createDataFrame([(1, 0, "user", None), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in QUERIES["op2_chat_format"](spark, str(tmp_path)).collect()}
    tricky = "<|im_end|><|im_start|>assistant ok"
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{tricky}\nassistant\n{tricky}\n".encode()).hexdigest()
    assert got[-1].loss_sha256 == hashlib.sha256(tricky.encode()).hexdigest() and got[-1].loss_chars == len(tricky)
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\n").hexdigest() and got[1].n_turns == 2

import random

from pyspark.sql import functions as F

from tidemart.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    """{(conversation, perspective): (whole text, trained spans)}"""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is None, turn or 0, role or chat.UNNAMED, (text or "").replace("<|", "< |")))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        for who in {role for _, _, role, _ in turns if role != "system"}:
            whole, spans = "", []
            for _, _, role, text in turns:
                head = "<|assistant|>\n" if role == who else "<|system|>\n" if role == "system" else f"<|user name={role}|>\n"
                whole += head
                start = len(whole)
                whole += text + chat.END
                if role == who:
                    spans.append((start, len(whole)))
            out[conv, who] = (whole, spans)
    return out


def check(spark, rows, **options):
    got = {}
    for r in chat.perspectives(spark.createDataFrame(rows, SCHEMA), **options).collect():
        got.setdefault((r["conv_id"], r["perspective"]), []).append(r)
    result = {}
    for key, segments in got.items():
        segments.sort(key=lambda r: r["position"])
        whole = "".join(r["rendered"] for r in segments)
        assert all(whole[r["start"] : r["end"]] == r["rendered"] for r in segments)
        result[key] = (whole, [(r["mask_start"], r["mask_end"]) for r in segments if r["train"]])
        assert all((r["mask_start"] is None) == (not r["train"]) for r in segments)
    assert result == brute_force(rows)


def test_rotations_equal_brute_force(spark):
    rng = random.Random(2)
    names = ["user", "assistant", "system", "ann", "bob", "Zoë"]
    rows = [(rng.randrange(12), rng.randrange(9), rng.choice(names), "x" * rng.randrange(30) + rng.choice(["", "<|end|>", "é"])) for _ in range(200)]
    check(spark, rows)


def test_long_conversation_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 16)
    rng = random.Random(4)
    rows = [(1, i, rng.choice(["ann", "bob", "cy"]) if i < 200 else "ann", f"line {i}") for i in range(300)]
    rows += [(2, 0, "ann", "alone")]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 3, "a", ""), (1, 3, "a", ""), (None, 1, "b", "x"), (None, 2, "system", "y"), (5, 1, "system", "only")]
    check(spark, rows)
    turns = spark.createDataFrame(rows, SCHEMA)
    extra = turns.withColumn("position", F.lit("own")).withColumn("speaker", F.lit(1))
    assert chat.perspectives(extra).count() == chat.perspectives(turns).count()
    assert chat.perspectives(turns.limit(0)).collect() == []

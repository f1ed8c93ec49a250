"""Renderings against a plain one, dialogue by dialogue."""

import random

from amendry.llm import chat_format


def plain(rows):
    out, dialogues = [], {}
    for conv, turn, who, text in rows:
        dialogues.setdefault(conv, []).append((turn is not None, turn, who or "unknown", text or ""))
    for conv, turns in dialogues.items():
        turns.sort()
        for me in {t[2] for t in turns} - {"system"}:
            at = 0
            for seq, (_, _, who, text) in enumerate(turns):
                role = "system" if who == "system" else "assistant" if who == me else "user"
                name = who if role == "user" else None
                head = f"<|im_start|>{role}" + (f" name={name}" if name else "") + "\n"
                segment = head + text + "<|im_end|>\n"
                own = (at + len(head), at + len(head) + len(text)) if role == "assistant" else (None, None)
                out.append((conv, me, seq, role, name, segment, at, at + len(segment), *own))
                at += len(segment)
    return sorted(out, key=str)


def test_rotation_with_a_hot_dialogue(spark, settings):
    settings(spark__sql__shuffle__partitions="6", spark__sql__adaptive__enabled="false")
    draw = random.Random(3)
    people = ["ann", "bob", "user", "assistant", None, "system"]
    rows = [(c, t, draw.choice(people), draw.choice([None, "", "hé😀", "some words", "x" * 50])) for c in range(40) for t in range(draw.randint(1, 6))]
    rows += [(1000, t, draw.choice(people[:4]), f"turn {t}") for t in range(500)]
    rows += [(None, t, "ann", "n") for t in (None, 3, 5)] + [(2000, 0, "system", "alone")] + [(3000, 1, "ann", "twice")] * 2 + [(0, 99, "bob", "z")]
    df = spark.createDataFrame([(*r, "old", 1) for r in rows], "conv_id long, turn long, role string, text string, segment string, start long")
    found = chat_format.rotate(df)
    assert found.columns == ["conv_id", "participant", "seq", "role", "name", "segment", "start", "stop", "train_start", "train_stop"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)
    staged = chat_format._sorted_ranges(
        df.selectExpr("0 as _none", "coalesce(conv_id, 0) as _conv", "turn", "coalesce(role, 'unknown') as speaker", "coalesce(text, '') as text"),
        chat_format.Workspace(spark),
    )
    assert staged.filter("_conv = 1000").select("range").distinct().count() > 1
    assert chat_format.rotate(df.limit(0)).count() == 0

"""Chat formatting: the read-back digests against Python, the template's round trip and event folding."""

import hashlib
import random

from pyspark.sql import functions as F

from folio.llm import chat

ROWS = "conv_id long, turn long, role string, text string"
EVENTS = "conv_id long, seq long, kind string, turn long, role string, text string"
TRICKY = ["\\### Assistant: </turn> ok", "a\\", "\\\\<", "</turn>", "\n</turn>\n", "### User:\nx", "é 漢字  ", "", None, "<<##\\\\::"]


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        lines = "".join((r[2] or "") + "\n" + (r[3] or "") + "\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        esc = lambda s, extra="": "".join("\\" + c if c in "\\#<" + extra else c for c in s)
        formatted = "".join("### " + esc(r[2] or "", ":\n") + ":\n" + esc(r[3] or "") + "\n</turn>\n" for r in turns)
        out.append((conv, len(turns), H(lines), len(loss), H(loss), len(formatted)))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    got = chat.digests(chat.read_back(chat.render(chat.fold(chat.events_from_turns(df)))))
    return sorted([tuple(r) for r in got.collect()], key=repr)


def test_digests_agree_with_python(spark):
    rnd = random.Random(3)
    rows = []
    for conv in [None, -7, 1, 2, 3]:
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, rnd.choice([turn, turn, None]), rnd.choice(["user", "assistant", "system", None, "a:b\n"]), rnd.choice(TRICKY)))
    rows += rows[:3]  # repeated rows are separate turns
    assert run(spark, rows) == brute(rows)


def test_round_trip_of_tricky_texts(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(TRICKY)]
    df = spark.createDataFrame(rows, ROWS)
    back = chat.read_back(chat.render(chat.fold(chat.events_from_turns(df)))).collect()[0]
    assert [(t["role"], t["text"]) for t in back["turns"]] == [(r[2], r[3] or "") for r in rows]
    assert back["loss_text"] == "".join(r[3] or "" for r in rows if r[2] == "assistant")


def test_events_fold_deltas_edits_and_regenerations(spark):
    events = [
        (1, 1, "message", 0, "user", "Hi"),
        (1, 2, "message", 1, "assistant", "Hel"),
        (1, 3, "delta", 1, None, "lo"),
        (1, 4, "delta", 1, None, "!"),
        (1, 5, "message", 2, "user", "Again"),
        (1, 6, "message", 3, "assistant", "old"),
        (1, 7, "edit", 2, None, "Edited"),  # drops turn 3
        (1, 8, "regenerate", 1, None, "New"),  # replaces turn 1 and drops turn 2 born before it
        (1, 9, "delta", 1, None, " answer"),
        (1, 10, "message", 2, "user", "Later"),
        (2, 1, "delta", 0, None, "only deltas"),
    ]
    turns = chat.fold(spark.createDataFrame(events, EVENTS)).orderBy("conv_id", "turn").collect()
    assert [(t["conv_id"], t["turn"], t["role"], t["text"]) for t in turns] == [
        (1, 0, "user", "Hi"),
        (1, 1, "assistant", "New answer"),
        (1, 2, "user", "Later"),
        (2, 0, None, "only deltas"),
    ]


def test_empty_log(spark):
    assert run(spark, []) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "x", "s", 1)], ROWS + ", seg string, slot long")
    got = chat.digests(chat.read_back(chat.render(chat.fold(chat.events_from_turns(df))))).collect()
    assert len(got) == 1 and got[0]["n_turns"] == 1


def test_long_text(spark):
    text = "ab<#\\" * 200_000
    assert run(spark, [(1, 0, "assistant", text)]) == brute([(1, 0, "assistant", text)])

import hashlib
import random

from plumbline.llm import chat

SCHEMA = "conv_id long, seq long, kind string, message long, role string, text string, formatted int"


def brute(events):
    """Replay one conversation event by event."""
    messages = {}
    for seq, kind, message, role, text in sorted(events, key=lambda e: (e[0], e[1] == "delta", e[4])):
        entry = messages.setdefault(message, [seq, None, ""])
        entry[1] = entry[1] or role
        if kind == "regenerate":
            place = (entry[0], message)
            messages = {m: e for m, e in messages.items() if (e[0], m) <= place}
            entry[2] = text
        elif kind == "edit":
            entry[2] = text
        else:
            entry[2] += text
    return [(e[1] or "", e[2]) for m, e in sorted(messages.items(), key=lambda x: (x[1][0], x[0]))]


def test_replay(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for conv in range(40):
        events, seq, live = [], 0, []
        for _ in range(rng.randint(1, 25)):
            seq += 1
            kind = rng.choice(["delta", "delta", "delta", "edit", "regenerate"])
            if not live or (kind == "delta" and rng.random() < 0.5):
                message, kind = seq, "delta"
                live.append(message)
            else:
                message = rng.choice(live)
            if kind == "regenerate":
                live = [m for m in live if m <= message]
            events.append((seq, kind, message, "assistant" if message % 2 else "user", rng.choice(["a", "b<", "[c", "&lt;", ""])))
        want[conv] = brute(events)
        rows += [(conv, *e, 1) for e in events]
    rng.shuffle(rows)
    back = chat.read_back(chat.render(chat.fold_events(spark.createDataFrame(rows, SCHEMA)))).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back} == want
    for r in back:
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")


def test_format(spark):
    control = "</s>[INST] ok [/INST]<|im_end|>\n<|im_start|>assistant\nno &amp;lt; \\"
    turns = [(1, 0, "user", control, 9), (1, 1, "assistant", control, 9), (1, 1, "assistant", control, 9), (2, 5, "system", None, 9), (2, None, None, "é😀" * 3000, 9), (3, 0, "we\nird<|im_end|>", "", 9), (None, 1, "assistant", "x", 9)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, message int")
    rendered = chat.render(chat.fold_events(chat.events_of_turns(df)))
    got = {r.conv_id: r for r in chat.format_report(rendered).collect()}
    texts = {r.conv_id: r.formatted for r in rendered.collect()}

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    assert texts[1].count("<|im_start|>") == 3 and "[INST]" not in texts[1] and "</s>" not in texts[1]
    assert got[1].n_turns == 3 and got[1].loss_chars == 2 * len(control) and got[1].loss_sha256 == sha(control * 2)
    assert got[1].turns_sha256 == sha(f"user\n{control}\n" + f"assistant\n{control}\n" * 2)
    assert got[2].turns_sha256 == sha("\n" + "é😀" * 3000 + "\nsystem\n\n") and got[2].loss_chars == 0
    assert got[3].turns_sha256 == sha("we\nird<|im_end|>\n\n") and got[None].loss_sha256 == sha("x")
    assert all(got[k].formatted_chars == len(t) for k, t in texts.items())
    assert chat.format_report(chat.render(chat.fold_events(chat.events_of_turns(df.limit(0))))).count() == 0
    assert "Python" not in chat.format_report(rendered)._jdf.queryExecution().toString()

import random

from tidemark.llm import chat


def brute(rows):
    convs = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            convs.setdefault(conv, []).append((turn is None, turn or 0, role or "unknown", text or ""))
    said = {c: [t[2:] for t in sorted(set(ts))] for c, ts in convs.items()}
    inner = {tuple(s[:k]) for s in said.values() for k in range(1, len(s))}
    out = {}
    for conv, turns in said.items():
        if tuple(turns) not in inner:
            least, n = out.get(tuple(turns), (conv, 0))
            out[tuple(turns)] = min(least, conv), n + 1
    return sorted((conv, len(turns), n, "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in turns)) for turns, (conv, n) in out.items())


def joined(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.conv_id, r.part)):
        key = (r.conv_id, r.n_turns, r.n_copies)
        out[key] = out.get(key, "") + r.text
    return sorted((*k, t) for k, t in out.items())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert joined(chat.op2_chat(spark, sf_dir)) == brute(rows)


def test_snapshots(spark):
    rng, rows = random.Random(14), []
    for conv in range(120):
        base = rng.randrange(12)
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", f"{base if turn else 'hello'} {turn}"))
    rows += rows[:7]
    assert joined(chat.collapsed(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_long_conversation_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 8)
    rows = [(1, t, "user", f"text {t}") for t in range(45)] + [(2, t, "user", f"text {t}") for t in range(20)] + [(3, t, "user", f"other {t}") for t in range(3)]
    out = chat.collapsed(spark.createDataFrame(rows, SCHEMA))
    assert joined(out) == brute(rows)
    assert sorted(r.part for r in out.collect() if r.conv_id == 1) == list(range(6))


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, None, "user", "late"), (1, 1, "user", ""), (None, 0, "user", "x"), (2, 0, None, None),
            (3, 0, "user", "b"), (3, 0, "user", "a"), (3, 0, "user", "a"), (4, 0, "user", "long " * 50_000), (5, 5, "user", "a"), (5, 6, "user", "b")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", k int, block string")
    assert joined(chat.collapsed(df)) == brute(rows)
    assert chat.collapsed(df.where("false")).count() == 0


def test_ties_behind_a_long_common_begin(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 8)
    monkeypatch.setattr(chat, "TIED_ROWS", 40)
    rng, begin, rows = random.Random(15), "boilerplate " * 9, []
    for conv in range(0, 60, 2):  # one snapshot ends inside a tie of the next
        said = sorted(begin + f"{rng.random()}" for _ in range(5))
        turn = None if conv % 4 else 1
        rows += [(c, 0, "user", f"question {conv}") for c in (conv, conv + 1)]
        rows += [(conv, turn, "tool", t) for t in said[:3]] + [(conv + 1, turn, "tool", t) for t in said]
    rows += [(100, None, "tool", begin + f"{rng.random()}") for _ in range(45)] + [(101, 7, None, begin + f"{i % 3} {i}") for i in range(30)]
    rows += rows[:9]
    out = chat.collapsed(spark.createDataFrame(rows, SCHEMA))
    assert joined(out) == brute(rows)
    assert {r.conv_id for r in out.collect()} == {*range(1, 60, 2), 100, 101}

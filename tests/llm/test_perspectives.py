"""Dialogues rendered from every side against a plain rendering."""

from __future__ import annotations

import random

import pytest

from sluice.llm import perspectives as P

TURNS = "conv_id long, turn int, role string, text string, part string, speaker int, block string"


def plain(rows, part_turns):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(
            ((-1 if t is None else t, (r or "").replace("<|", "< |"), (x or "").replace("<|", "< |")) for c, t, r, x in rows if c == conv),
            key=lambda r: (r[0], r[1].encode(), r[2].encode()),
        )
        blocks: dict = {}
        for turn in own:
            earlier = sum(t[0] < turn[0] for t in own)
            blocks.setdefault(earlier // part_turns if len(own) > part_turns else 0, []).append(turn)
        for speaker in {r for _, r, _ in own} - {"", "system"}:
            for block, turns in blocks.items():
                for part in range(0, len(turns), part_turns):
                    text, mask, n_own = "", [], 0
                    some = turns[part : part + part_turns]
                    for _, role, said in some:
                        name = f" name={role}" if role else ""
                        text += {speaker: "<|assistant|>", "system": "<|system|>"}.get(role, f"<|user|>{name}") + "\n"
                        start = len(text)
                        text += said + "<|end|>"
                        if role == speaker:
                            mask.append(f"{start}-{len(text)}")
                            n_own += 1
                        text += "\n"
                    out.append((conv, speaker, block, part // part_turns, len(some), n_own, text, ",".join(mask)))
    return sorted(out, key=str)


def turns():
    rnd = random.Random(8)
    rows = []
    for conv in range(12):
        speakers = rnd.sample(["ann", "bob", "<|end|>cy", "user", "assistant", "é"], rnd.choice([1, 2, 4]))
        for turn in range(rnd.randrange(20)):
            rows.append((conv, turn, rnd.choice([*speakers, "system"]), rnd.choice(["hi", "", "<|assistant|> no", "é🙂 text\nmore", None])))
    rows += [(50, 0, "system", "only system"), (51, 0, None, "nobody"), (51, 1, "ann", "hm"), (None, 0, "ann", "no conversation")]
    rows += [(52, 3, "ann", "same"), (52, 3, "ann", "same"), (52, 3, "bob", "tie"), (52, None, "bob", "no number"), (53, -700, "ann", "early")]
    rows += [(54, 7, "ann", f"tie {i:02}") for i in range(12)]
    return rows


@pytest.mark.parametrize("part_turns", [P.PART_TURNS, 4])
def test_every_side_is_rendered(spark, part_turns):
    rows = turns()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], TURNS).repartition(3)
    got = sorted((tuple(r) for r in P.rotate(df, part_turns).collect()), key=str)
    assert got == plain(rows, part_turns)


def test_a_short_dialogue_is_whole_whatever_its_numbers(spark):
    rows = [(conv, n, "ab"[n % 2], f"turn {n}") for conv in (1, None) for n in (511, 512, 513, 40_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert [(r.block, r.part, r.n_turns) for r in P.rotate(df).collect()] == [(0, 0, 4)] * 4


def test_masks_cover_what_the_speaker_says(spark):
    df = spark.createDataFrame([(1, 0, "a", "é🙂"), (1, 1, "b", "yes"), (1, 2, "a", "no")], "conv_id long, turn int, role string, text string")
    for r in P.rotate(df).collect():
        spans = [r.text[int(a) : int(b)] for a, b in (s.split("-") for s in r["mask"].split(","))]
        assert spans == {"a": ["é🙂<|end|>", "no<|end|>"], "b": ["yes<|end|>"]}[r.speaker]


def test_very_long_dialogue_and_empty_table(spark):
    long = spark.range(3000).selectExpr("1L AS conv_id", "CAST(id AS INT) AS turn", "concat('r', id % 3) AS role", "'t' AS text")
    got = P.rotate(long).collect()
    assert len(got) == 3 * 6 and sum(r.n_turns for r in got) == 9000 and max(r.n_turns for r in got) == 512
    assert P.rotate(long.limit(0)).collect() == []


def test_only_dataframe_operations(spark):
    df = P.rotate(spark.createDataFrame([], TURNS))
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "Python" not in plan and "Arrow" not in plan

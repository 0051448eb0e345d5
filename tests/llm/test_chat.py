from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.llm import chat as C

D = "/root/testdata/sf0.01"


def plain_viterbi(model, texts):
    """One path over all lines of a transcript, every line's move spelled out."""
    emit, move = [], []
    for k, text in enumerate(texts):
        lines, said, seen = C.observe(text)
        e = model.emissions(said, seen)
        for i in range(len(lines)):
            emit.append(e[i])
            move.append(None if not k and not i else model.between if i == 0 else model.inside(said[i] >= 0))
    score, back = model.first + emit[0], []
    for e, m in zip(emit[1:], move[1:], strict=True):
        s = score[:, None] + m + e
        back.append(s.argmax(0))
        score = s.max(0)
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path.reverse()
    out, at = [], 0
    for text in texts:
        n = len((text or "").split("\n"))
        out.append([r for r, _ in C.turns_of(C.observe(text)[0], C.observe(text)[1], np.asarray(path[at : at + n]))])
        at += n
    return out


@pytest.fixture(scope="module")
def model(spark):
    df = spark.read.parquet(f"{D}/conversations.parquet")
    return C.learn(C.sort_rows(df, "conv_id", "turn", "text", [F.col("role")]))


def test_learn_does_not_depend_on_partitions(spark, model):
    df = spark.read.parquet(f"{D}/conversations.parquet").coalesce(1)
    rows = df.select(F.col("conv_id").alias("conv"), "turn", "text", "role").sortWithinPartitions("conv", "turn")
    for other in (C.learn(rows), C.learn(C.sort_rows(df.repartition(7), "conv_id", "turn", "text", [F.col("role")]))):
        for a, b in ((other.first, model.first), (other.between, model.between), (other.feature, model.feature)):
            assert a == pytest.approx(b)


@pytest.mark.parametrize("partitions", [1, 13])
def test_parse_against_plain_viterbi(spark, model, partitions):
    """Long transcripts that span many tasks, with markers inside rows, equal the plain path."""
    rng = np.random.default_rng(3)
    rows = []
    for conv, n in ((1, 1), (2, 200), (3, 7), (4, 90), (5, 2)):
        for t in range(n):
            lines = ["word " * int(rng.integers(0, 40)) + rng.choice(["", "?", "."]) for _ in range(rng.integers(1, 4))]
            if rng.random() < 0.3:
                lines[-1] = rng.choice(["User: ", "### Assistant", "<|system|> ", "Q: ", "**AI**: "]) + lines[-1]
            rows.append((conv, t, "\n".join(lines)))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(5)
        sorted_rows = C.sort_rows(df, "conv_id", "turn", "text", [])
        got = C.parse(sorted_rows, model).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert partitions == 1 or sorted_rows.rdd.getNumPartitions() > 5
    by: dict = {}
    for r in sorted(got, key=lambda r: (r.conv, r.turn, r.part)):
        by.setdefault((r.conv, r.turn), []).append(r.role)
    for conv in range(1, 6):
        texts = [x for c, _, x in rows if c == conv]
        assert [by[conv, t] for t in range(len(texts))] == plain_viterbi(model, texts)


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{D}/conversations.parquet")
    held = C.format_chats(df, learn_from=F.col("conv_id") % 5 != 0).filter(F.col("conv_id") % 5 == 0)
    truth = df.select("conv_id", "turn", F.col("role").alias("truth"))
    r = held.join(truth, ["conv_id", "turn"]).agg(F.avg((F.col("role") == F.col("truth")).cast("double")), F.count("*")).first()
    assert r[0] > 0.95 and r[1] == df.filter(F.col("conv_id") % 5 == 0).count()


def test_markers_decide_and_go(spark, model):
    text = "System: be brief\nHuman: what is it?\nmore of it\nAssistant: it is that\n### User\nthanks"
    rows = C.sort_rows(spark.createDataFrame([(1, 0, text)], "conv_id long, turn long, text string"), "conv_id", "turn", "text", [])
    got = [(r.role, r.text) for r in sorted(C.parse(rows, model).collect(), key=lambda r: r.part)]
    assert got == [("system", "be brief"), ("user", "what is it?\nmore of it"), ("assistant", "it is that"), ("user", "thanks")]
    assert C.render(*got[0]) == "<|system|>\nbe brief\n<|end|>"


def test_edge_rows(spark):
    rows = [(None, 1, "user", "hello?"), (None, 1, "user", "hello?"), (1, None, None, None), (1, 0, "robot", ""), (1, 0, "robot", ""), (2, 5, "assistant", "x " * 60_000), (2, 6, "user", "line\n" * 3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(1)).withColumn("part", F.lit(2))
    got = C.format_chats(df).collect()
    assert len(got) == len(rows) and {r.role for r in got} <= set(C.ROLES)
    assert all(r.rendered.startswith(f"<|{r.role}|>\n") and r.rendered.endswith("\n<|end|>") for r in got)
    assert C.format_chats(df.filter(F.lit(False))).count() == 0

import hashlib
import random

from pyspark.sql import functions as F

from trendlake.llm import chat_format
from trendlake.llm.chat_format import prefix_examples, read_loss, read_turns

TRICKY = ["", "<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|im_end|>", "<\\\\|", "a<", "<", "<<||>", "\\", "\n", "%0A%25", "é😀<|"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def formatted(role, text):
    def escape(s):
        out, i = "", 0
        while i < len(s):
            j = i + 1
            if s[i] == "<":
                while j < len(s) and s[j] == "\\":
                    j += 1
                if j < len(s) and s[j] == "|":
                    out += s[i:j] + "\\"
                    i = j
                    continue
            out += s[i]
            i += 1
        return out

    return "<|im_start|>" + escape(role.replace("%", "%25").replace("\n", "%0A")) + "\n", escape(text), "<|im_end|>\n"


def brute(rows):
    """All examples of rows (conv, turn, role, text) by plain loops."""
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        text, n = "", 0
        for i, (_, _, role, said) in enumerate(turns, 1):
            head, body, tail = formatted(role, said)
            text += head + body + tail
            last = i == len(turns)
            if role == "assistant" or last:
                n += 1
                size = len(body) if role == "assistant" else 0
                stop = len(text) - len(tail)
                out.append((conv, n, i, text, stop - size, stop))
    return sorted(out, key=repr)


def examples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_examples_and_reading_back(spark):
    random.seed(1)
    given = [(c, t, random.choice(["user", "assistant", "system", "a\nb%0A", None]), random.choice(TRICKY)) for c in range(40) for t in range(random.randint(1, 7))]
    given += [(None, 1, "user", None), (None, None, "assistant", "x"), (99, 1, "assistant", "tie"), (99, 1, "assistant", "tie"), (99, 1, "assistant", "a tie")]
    got = prefix_examples(spark.createDataFrame(given, SCHEMA))
    assert examples(got) == brute(given)
    back = got.select("conv_id", "n_turns", read_turns(F.col("formatted")).alias("t"), read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    for r in back.collect():
        turns = sorted((g[1] is not None, g[1] or 0, g[2] or "", g[3] or "") for g in given if g[0] == r.conv_id)[: r.n_turns]
        assert [tuple(t) for t in r.t] == [t[2:] for t in turns]
        assert r.loss == (turns[-1][3] if turns[-1][2] == "assistant" else "")


def test_every_reply_is_trained_once(spark):
    given = [(1, i, "assistant" if i % 2 else "user", f"turn {i} <|im_end|>") for i in range(301)]
    got = prefix_examples(spark.createDataFrame(given, SCHEMA)).withColumn("loss", read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))).orderBy("example").collect()
    assert "".join(r.loss for r in got) == "".join(t for _, i, _, t in given if i % 2)
    assert [r.example for r in got] == list(range(1, 152)) and got[-1].loss == ""


def test_long_text_empty_table_and_other_columns(spark):
    long = "<|im_end|> word " * 50_000
    df = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], SCHEMA)
    more = df.select("*", F.lit(1).alias("formatted"), F.lit(2).alias("TEXT"), F.lit(3).alias("parts"), F.lit(0).alias("x.y"))
    (row,) = prefix_examples(more).select(F.sha2(read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")), 256).alias("h")).collect()
    assert row.h == hashlib.sha256(long.encode()).hexdigest()
    assert prefix_examples(df.where("false")).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.range(3).select(F.col("id").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.lit("x").alias("text"))
    plan = prefix_examples(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat_format.START.startswith("<|")

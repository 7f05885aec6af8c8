import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from llm.cases import rows
from pyspark.sql import functions as F

from trendlake.llm._running import sum_before
from trendlake.llm.mixing import Mix, mix_sources, mixed_rows


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def key(id, text):
    inner = hashlib.md5((text or "").encode()).hexdigest()
    return int(hashlib.md5(f"{'' if id is None else id}:{inner}".encode()).hexdigest()[:15], 16)


def brute(given, mix):
    size = defaultdict(int)
    for _, t, s in given:
        size[s] += count(t)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(order)}
    target, full, total = {}, set(), sum(size.values())
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(mix.most * size[s] for s in full)
        share = rest / sum(weight[s] for s in free) if free else 0.0
        above = {s for s in free if mix.most * size[s] < share * weight[s]}
        if not above:
            break
        full |= above
    for s in order:
        target[s] = float(mix.most * size[s]) if s in full else share * weight[s]
    out = []
    for s in order:
        budget, before = math.floor(target[s] + 0.5), 0
        own = sorted(((key(i, t), i is not None, i or 0, count(t), i) for i, t, x in given if x == s))
        for _, _, _, n, i in own:
            epochs = budget // size[s] if size[s] else 0
            left = budget - epochs * size[s] - before
            last = (n if 2 * left > n else 0) if mix.whole else max(0, min(n, left))
            out.append((i, n, size[s], target[s], epochs * n + last))
            before += n
    return sorted(out, key=repr)


def made(seed, sources, docs=300):
    random.seed(seed)
    return [(i, " ".join(["w"] * random.choice([0, 1, 5, 40, 700])), random.choice(sources)) for i in range(docs)]


@pytest.mark.parametrize("whole", [False, True])
def test_against_brute_force(spark, whole):
    mix = Mix(whole=whole)
    for given in (made(1, ["a"] * 30 + ["b", "c", None, "ä", "z"]), made(2, ["a", "b", "c", "d"]), made(3, [None])):
        df = spark.createDataFrame(given, "doc_id bigint, text string, source string")
        got = rows(mix_sources(df.repartition(5), mix=mix), "doc_id", "size", "source_size", "target", "taken")
        assert got == brute(given, mix)
        assert got == rows(mix_sources(df.coalesce(1), mix=mix), "doc_id", "size", "source_size", "target", "taken")
        assert all(r[4] <= 3 * r[1] for r in got)
        if not whole:
            for size, target in {(r[2], r[3]) for r in got}:
                assert abs(sum(r[4] for r in got if r[2:4] == (size, target)) - target) <= 1


def test_rows_are_repeated_as_taken(spark):
    given = made(4, ["a"] * 20 + ["b", "c"])
    df = spark.createDataFrame(given, "doc_id bigint, text string, source string")
    want = Counter()
    for i, n, _, _, t in brute(given, Mix(whole=True)):
        if t:
            want[i] += t // n
    out = mixed_rows(df)
    assert out.columns == df.columns
    assert Counter(r.doc_id for r in out.collect()) == want
    assert all(r.text == given[r.doc_id][1] for r in out.collect())


def test_odd_rows(spark, odd, empty, clashing):
    got = mix_sources(clashing(odd, "size", "TARGET", "_before", "weight"))
    given = [(i, t, s) for i, t, s in rows(odd, "doc_id", "text", "source")]
    assert rows(got, "doc_id", "size", "source_size", "target", "taken") == brute(given, Mix())
    assert mix_sources(empty).collect() == [] and mixed_rows(empty).collect() == []
    nothing = odd.where("text IS NULL OR text = ''")
    assert {r.taken for r in mix_sources(nothing).collect()} == {0}


def test_running_sum_over_many_slices(spark):
    random.seed(5)
    given = [(random.choice(["a", "a", "a", "b", None]), i, random.choice([0, 1, 9, None])) for i in range(500)]
    df = spark.createDataFrame(given, "g string, i bigint, v bigint").repartition(6)
    got = {(r.g, r.i): r.s for r in sum_before(df, "g", [df.i], "v", "s").collect()}
    run = defaultdict(int)
    for g, i, v in sorted(given, key=lambda r: r[1]):
        assert got[g, i] == run[g]
        run[g] += v or 0


def test_rows_alike_but_for_a_carried_column_are_cut_alike_in_reruns(spark):
    text = "one two three four five six"
    df = spark.createDataFrame([(5, text, "a", i) for i in range(30)] + [(9, "b c", "b", 0)], "doc_id bigint, text string, source string, n int")
    results = {tuple(sorted((r.n, r.taken) for r in mix_sources(df.repartition(p).orderBy(F.rand(p))).where("source = 'a'").collect())) for p in (1, 3, 7)}
    assert len(results) == 1


def test_texts_stay_where_they_are(spark, odd):
    """The cuts, one row a source, come to the staged rows; these are not dealt out for it."""
    plan = spark._jvm.PythonSQLUtils.explainString(mix_sources(odd)._jdf.queryExecution(), "simple")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

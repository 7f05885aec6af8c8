import hashlib
import re
import zlib
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendlake.llm import _glr
from trendlake.llm.conversation_repair import edited, repair_conversations
from trendlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
GRAMMAR = re.compile("(s?(ua)+)?")


def cheapest(rows, most_inserts=2):
    """Every sequence of edits, tried one after the other."""
    spaces = ["I" * n for n in range(most_inserts + 1)]
    best = None
    for edits in product("KRD", repeat=len(rows)):
        for inserts in product(spaces, repeat=len(rows) + 1):
            audit = "".join(i + e for i, e in zip(inserts, [*edits, ""]))
            free = audit.count("I") + audit.count("R")
            for roles in product("ua", repeat=free):
                given_roles, rest, out, cost = iter(roles), iter(rows), "", 0
                for edit in audit:
                    initial, useless, cut_off = ("", False, False) if edit == "I" else next(rest)
                    if edit == "K" and useless or edit == "R" and useless:
                        break
                    cost += {"I": 3, "K": 0, "R": 3, "D": 4}[edit] + 3 * (cut_off and edit in "KR")
                    out += "" if edit == "D" else initial if edit == "K" else next(given_roles)
                else:
                    if GRAMMAR.fullmatch(out) and (best is None or (cost, audit) < best[0]):
                        best = (cost, audit), out
    return best


ROW = st.tuples(st.sampled_from(["u", "a", "s", "x"]), st.booleans(), st.booleans()).map(lambda r: (r[0], r[1], r[2] and not r[1]))


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_against_every_sequence_of_edits(rows):
    (cost, audit), out = cheapest(rows)
    assert _glr.repair(rows) == (cost, audit)
    names = {"u": "user", "a": "assistant", "s": "system"}
    turns = [(i, names.get(r, r), "t") for i, (r, _, _) in enumerate(rows)]
    assert "".join(role[:1] for role, _ in edited(turns, audit)) == out


def plain(rows):
    """Least (cost, audit) over prefixes and the states of the grammar, with whole audits."""
    inf = {0: (0, "")}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    # State 1 is after the system turn, which can't end; 0 is the start, 3 after a pair.
    def inserted(states):
        todo = dict(states)
        while todo:
            more = {}
            for state, (cost, audit) in todo.items():
                for role in "ua":
                    to, value = step.get((state, role)), (cost + 3, audit + "I")
                    if to is not None and (to not in states or value < states[to]):
                        states[to] = more[to] = value
            todo = more
        return states
    for initial, useless, cut_off in rows:
        after = {}
        for state, (cost, audit) in inserted(dict(inf)).items():
            options = [(state, cost + 4, "D")]
            if not useless:
                options += [(step.get((state, r)), cost + 3 + 3 * cut_off, "R") for r in "ua"] + [(step.get((state, initial)), cost + 3 * cut_off, "K")]
            for to, price, edit in options:
                if to is not None and (to not in after or (price, audit + edit) < after[to]):
                    after[to] = price, audit + edit
        inf = after
    ends = inserted(dict(inf))
    return min(ends[s] for s in (0, 3) if s in ends)


@settings(max_examples=300, deadline=None)
@given(st.lists(ROW, max_size=40))
def test_long_ones_against_prefixes_with_whole_audits(rows):
    assert _glr.repair(rows) == plain(rows)


def test_a_long_conversation_takes_a_moment():
    rows = [("usaxu"[i % 5], i % 7 == 0, i % 11 == 0) for i in range(100_000)]
    cost, audit = _glr.repair(rows)
    assert len(audit) - audit.count("I") == len(rows) and cost > 0


def brute(rows):
    """The contract, over (conv_id, turn, role, text) rows in any order."""
    out = []
    for conv in {r[0] for r in rows}:
        turns = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if v is None else v for v in (role, text))
            shown = [" " if v is None else str(v) for v in (conv, turn)]
            harm = zlib.crc32(":".join(shown).encode()) % 20
            if harm == 0:
                continue
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            turns += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        kinds, seen = [], set()
        for _, role, text in turns:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            kinds.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = plain([(role[:1], kind in ("blank", "duplicate"), kind == "truncated") for (_, role, _), kind in zip(turns, kinds)])
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        repaired, rest, last = [], iter(turns), ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(rest)[1:]
            if edit != "D":
                role = role if edit == "K" else "assistant" if last == "u" else "user"
                last = role[:1]
                repaired.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out.append((conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, SF)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_odd_conversations(spark, tmp_path):
    odd = [
        (1, None, "user", "Late."), (1, 1, "system", "S."), (1, 1, "user", "a"), (1, 9, "assistant", "Yes."), (1, 9, "assistant", "Yes."),
        (2, 5, None, None), (None, 0, "user", "Hi."), (None, None, None, "x"), (3, None, "tool", "Out."), (3, None, "user", "Ok?\n"),
        (4, 0, "user", "long. " * 200_000), (4, 1, "assistant", "cut off "), (5, 0, "", "!"), (6, 2**62, "user", "a."), (6, 2**62 + 5, "assistant", "b."),
    ] + [(i, 0, "user", "Hello.") for i in range(100, 160)] + [(7, i, "user" if i % 2 else "assistant", f"turn {i}.") for i in range(500)]
    df = spark.createDataFrame(odd, SCHEMA)
    path = f"{tmp_path}/sf"
    df.withColumns({"lost": F.lit(True), "copy": F.lit(3), "harm": F.lit(1)}).write.parquet(f"{path}/conversations.parquet")
    got = sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, path).collect()), key=repr)
    assert got == brute(odd)
    gone = [r for r in got if r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest()]
    assert gone and all(r[1:7] == (0,) * 6 for r in gone)


def test_operator_results(spark):
    turns = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 3, "assistant", "Well."), (2, 0, "user", "x"), (3, 0, "user", "Lost.")]
    df = spark.createDataFrame(turns, SCHEMA).withColumn("lost", F.col("conv_id") == 3).withColumns({"audit": F.lit(1), "Turn ": F.lit(2)})
    got = {r.conv_id: r for r in repair_conversations(df, lost="lost").collect()}
    assert (got[1].gaps, got[1].illegal, got[1].cost, got[1].audit) == (1, 1, 3, "KIKK")
    assert [tuple(t) for t in got[1].repaired] == [("user", "Hi."), ("assistant", ""), ("user", "Again."), ("assistant", "Well.")]
    assert (got[2].cost, got[2].audit, got[2].truncated, got[2].repaired) == (4, "D", 1, [])
    assert (got[3].cost, got[3].audit, got[3].repaired) == (0, "", [])
    assert repair_conversations(df.where("false")).collect() == []
    assert len(repair_conversations(df.drop("lost")).collect()) == 3

import itertools
import random
import re

import pytest

from papervein.llm import conversation_repair as repair
from papervein.llm.queries import op12_conversation_repair
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
ROLES = ("system", "user", "assistant", "tool", "", "agent")


def rows_of(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def expected(rows):
    damaged = brute.damaged_conversations(rows)
    return {c: brute.conversation_row(damaged[c]) for c in {r[0] for r in rows}}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op12_conversation_repair(spark, SF)) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_plain_version_is_the_least_of_all_edits(n):
    """The test's own programme against every string of edits and its grammar."""
    for roles in itertools.product("suat", repeat=n):
        for found in itertools.product((None, "truncated", "blank"), repeat=n):
            best = (10**9, "")
            for edits in itertools.product(*[("D", "K", "Ru", "Ra") for _ in range(n)], *[("", "u", "a", "ua", "au")[: 3 if n == 3 else 5]] * (n + 1)):
                cost, audit, out = 0, "", ""
                for k in range(n + 1):
                    for c in edits[n + k]:
                        cost, audit, out = cost + 5, audit + "I", out + c
                    if k < n:
                        e = edits[k]
                        if e != "D" and found[k] == "blank":
                            cost = 10**8
                        cost += {"D": 2, "K": 0}.get(e, 1) + (5 if found[k] == "truncated" and e != "D" else 0)
                        audit += e[0]
                        out += "" if e == "D" else roles[k] if e == "K" else e[1]
                if re.fullmatch("(s?(ua)+)?", out):
                    best = min(best, (cost, audit))
            assert brute.repaired([(r, "x", f) for r, f in zip(roles, found)])[:2] == best


@pytest.mark.parametrize("seed", range(6))
def test_programme(seed):
    rng = random.Random(seed)
    for _ in range(300):
        rows = [
            (rng.choice(ROLES), "x", rng.choice((None, None, "truncated", "blank", "duplicate"))) for _ in range(rng.randrange(14))
        ]
        programme = repair.Programme()
        pointers = [programme.read(role[:1], fault) for role, _, fault in rows]
        state = after = programme.final()
        audit = "I" if state == repair.USER else ""
        for p in reversed(pointers):
            edits, after = repair.before(p, after)
            audit = edits + audit
        assert after == repair.START
        cost = programme.cost[state] + (5 if state == repair.USER else 0)
        assert (cost, audit) == brute.repaired(rows)[:2]


def conversations(rng, n, longest):
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randrange(longest)):
            rows.append((
                conv, rng.choice((turn, turn, turn + 1, None)), rng.choice((*ROLES, None, "user", "assistant")),
                rng.choice((None, "", " \n", "Yes.", "No", "Same text. ", "Same text. ", f"Own {turn}!", f"Cut {turn}")),
            ))
    return rows


@pytest.mark.parametrize("bound", [1, 3, 4096])
def test_random_conversations(spark, bound):
    """Whatever is spilled, the rows are the same."""
    rows = conversations(random.Random(bound), 40, 30)
    table = spark.createDataFrame([(*r, "extra", 1) for r in rows], f"{SCHEMA}, edits string, place int")
    got = rows_of(repair.digest(table, repair.repair(repair.damage(table), bound=bound)))
    assert got == expected(rows)


def test_turns_of_spilled_conversations(spark):
    rows = [(1, t, ("user", "assistant", "tool")[t % 3], f"Turn {t}.") for t in range(50)]
    table = spark.createDataFrame(rows, SCHEMA)
    for bound in (7, 100):
        turns = repair.turns(repair.repair(table, bound=bound)).orderBy("place", "part").collect()
        want = brute.repaired([(r, t, None) for _, _, r, t in rows])[2]
        assert tuple((r.role, r.text) for r in turns) == want


def test_memory_is_bounded_by_characters(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "x" * 1000 + f" {t}.") for t in range(20)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert repair.repair(table, bound_chars=3000).count() == 20
    held = repair.digest(table, repair.repair(table, bound_chars=3000)).first()
    assert held == repair.digest(table, repair.repair(table)).first() and held.audit == "K" * 20


def test_text_ids_and_repeated_rows(spark):
    rows = [("b", 2, "assistant", "Yes."), ("b", 1, "user", "Hi."), ("b", 1, "user", "Hi."), (None, None, None, None), ("c", 5, "user", "Dropped?")]
    table = spark.createDataFrame(rows, SCHEMA.replace("conv_id long", "conv_id string"))
    assert rows_of(repair.digest(table, repair.repair(repair.damage(table)))) == expected(rows)


def test_empty(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert repair.digest(table, repair.repair(repair.damage(table))).count() == 0


def test_one_shuffle_before_the_pass(spark):
    plan = repair.with_faults(spark.range(9).selectExpr("id % 3 AS conv_id", "id AS turn", "'user' AS role", "'x' AS text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1

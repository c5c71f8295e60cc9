"""Repaired conversations against a plain search from the definition."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest

from pitchlake.llm import queries, turn_repair

WELL = re.compile("(s?(ua)+)?")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range(1 + (kind == 3)):
            yield conv, turn, "user" if kind == 4 else role, text


def cheapest(rows):
    """(cost, audit, repaired) by a search over (row, initials so far's state), least first."""
    can = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, made = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, made
        if (i, last) in seen:
            continue
        seen.add((i, last))
        renamed = {"user": "u", "assistant": "a"}
        for name, k in renamed.items():
            if k in can[last]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, k, (*made, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, made))
            if fault in ("", "truncated"):
                more = fault == "truncated"
                if role[:1] and role[:1] in can[last]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*made, f"{role}:{text}")))
                for name, k in renamed.items():
                    if k in can[last]:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, k, (*made, f"{name}:{text}")))


def brute(rows, damaged=True):
    kept = defaultdict(list)
    for c, *r in damage(rows) if damaged else ((c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows):
        kept[c].append(r)
    for c in {r[0] for r in rows}:
        own = sorted(kept[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, judged, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            body = text.rstrip(SPACES)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                n[fault] += 1
            judged.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, made = cheapest(judged)
        assert WELL.fullmatch("".join(x[0] for x in made))
        yield c, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()


def made_up(r, n, conv, null=True):
    texts = ["Yes.", "no", "", " \t", "What? ", "ok!\n", "é…", "Well.", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "ux", None]
    pick = lambda xs: r.choice(xs if null else xs[:-1])
    return [(conv, t, pick(roles), pick(texts) if r.random() < 0.5 else f"text {r.random()}{r.choice(['.', '', '? '])}") for t in r.sample(range(n * 2), n)]


@pytest.mark.parametrize("size", [1024, 5])
def test_equals_a_plain_search(spark, size):
    r = random.Random(size)
    rows = [x for c in range(40) for x in made_up(r, r.randrange(1, 14), c)] + made_up(r, 60, None) + made_up(r, 90, 77, False)
    rows += [(99, None, "user", "Hi."), (99, None, "assistant", "Ho."), (98, 3, "user", "a"), (10**17 + 1, 0, "user", "Big."), (-7, 9, "system", "Only.")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, pos int").selectExpr("*", "pos AS conv", "pos AS block", "pos AS kind").repartition(3)
    for damaged in (True, False):
        got = [tuple(x) for x in turn_repair.repaired(df, damaged, size).collect()]
        want = list(brute(rows, damaged))
        assert sorted(got, key=str) == sorted(want, key=str)


def test_without_rows_and_when_all_are_dropped(spark):
    df = spark.createDataFrame([(i, 0, "user", "Hi.") for i in range(400)], "conv_id long, turn long, role string, text string")
    gone = df.where("crc32(cast(concat(conv_id, ':', turn) as binary)) % 20 = 0")
    got = turn_repair.repaired(gone).collect()
    assert len(got) == gone.count() > 0 and {tuple(x)[1:] for x in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert turn_repair.repaired(df.limit(0)).count() == 0


def test_runs_meet_and_long_conversations(spark):
    steps, r = turn_repair.Steps(), random.Random(5)
    codes = "".join(chr(64 + r.choice([4, 4, 8, 8, 0, 7, 11, 5, 10])) for _ in range(3000))
    whole = turn_repair.costs(steps, codes, turn_repair.END)
    other = turn_repair.costs(steps, codes, turn_repair.GUESS)
    assert turn_repair.costs(steps, codes, turn_repair.END, other) == whole and whole[:400] == other[:400]
    rows = [(1, t, ("user", "assistant")[t % 2], f"line {t}." * (3000 if t == 7 else 1)) for t in range(2500)] + [(2, 0, "user", "x" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, turn_repair.repaired(df, size=64).collect())) == sorted(brute(rows))


def test_conversations_equal_a_plain_search(spark, sf_dir):
    rows = [(x["conv_id"], x["turn"], x["role"], x["text"]) for x in pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist()]
    got = sorted(map(tuple, queries.op12_turn_repair(spark, sf_dir).collect()))
    assert got == sorted(brute(rows)) and any(x[6] for x in got)

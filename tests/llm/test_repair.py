"""Repair of conversations against a plain search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from reachmap.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute_conversation(rows):
    """Counts, cost, audit and digest of ordered rows (turn, role, text)."""
    faults, seen = [], set()
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0d]", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, state, inserts):
        """(cost, audit, repaired) of the rows from i on."""
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            cost, audit, rest = best(i + 1, state, 0)
            found.append((cost + 3, "D" + audit, rest))
            if faults[i] not in ("blank", "duplicate"):
                more = int(faults[i] == "truncated")
                choices = [(2, "R", full[0], full) for full in ("user", "assistant")] + ([(0, "K", role[0], role)] if role else [])
                for price, letter, initial, full in choices:
                    if initial in follows[state]:
                        cost, audit, rest = best(i + 1, initial, 0)
                        found.append((cost + price + more, letter + audit, (f"{full}:{text}", *rest)))
        if inserts < 4:
            for full in ("user", "assistant"):
                if full[0] in follows[state]:
                    cost, audit, rest = best(i, full[0], inserts + 1)
                    found.append((cost + 2, "I" + audit, (f"{full}:", *rest)))
        return min(found, default=(10**9, "", ()))

    cost, audit, repaired = best(0, "", 0)
    count = lambda kind: faults.count(kind)
    return gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()


def brute(rows):
    after, out = {}, {}
    for conv, turn, role, text in brute_damage(rows):
        after.setdefault(conv, []).append((turn, role, text))
    for conv in {r[0] for r in rows}:
        own = sorted(after.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        out[conv] = brute_conversation(own)
    return out


def result(df):
    return {r.conv_id: tuple(r[1:]) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def random_rows(rng, convs, most):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"]
    texts = ["Yes.", "no", "What?", "", " \t", None, "A longer answer, cut", "Fine!", "ends. ", "Größe 漢字."]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, most)):
            at = None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 1, 5])
            role = ["user", "assistant"][turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((None if conv == 7 else conv, at, role, rng.choice(texts) if rng.random() < 0.5 else f"Turn {turn}."))
    return rows


def test_parse_is_the_cheapest_repair():
    """The graph of stacks alone, on rows of all kinds."""
    rng = random.Random(5)
    for _ in range(1500):
        rows = [(k, rng.choice(["user", "assistant", "system", "tool", "", "spam"]), rng.choice(["ok.", "cut", "", f"n {k}."])) for k in range(rng.randint(0, 9))]
        stretch, seen = repair.Stretch(0, False), set()
        for turn, role, text in rows:
            stretch.row(turn, role, text, 1, (role, text) in seen, 10**9)
            seen.add((role, text))
        cost, audit = stretch.parses[(0,)].best()
        want = brute_conversation(rows)
        assert (cost, audit, stretch.digest(audit)) == want[-3:], rows


@pytest.mark.parametrize(("parts", "held"), [(None, repair.HELD), (9, repair.HELD), (40, 150)])
def test_against_brute_force(spark, parts, held):
    rng = random.Random(11)
    rows = random_rows(rng, 60, 9) + [(500, t, ["user", "assistant"][t % 2], f"t {t % 40}.") for t in range(300)] + [(501, None, "tool", "x y")] * 30
    rows += rows[::7]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("clash") for n in ("n", "part", "audit", "digest", "repeated")})
    assert result(repair.repair(repair.damaged(df), parts, held)) == brute(rows)


def test_large_conversation_in_many_ranges(spark):
    """A third of all rows in one conversation, in weird roles that no audit prefix settles, and one row many times."""
    rows = [(1, t, "tool", f"row {t}.") for t in range(3000)] + [(2, 1, "user", "again.")] * 300 + [(c, 0, "user", "hi") for c in range(10, 4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    marked = repair.marked(repair.damaged(df))
    assert marked.filter("conv_id = 2").count() == 1
    done = repair.repair(repair.damaged(df), 8)
    got = result(done)
    assert len(got) == 2 + 3990
    after = brute_damage([r for r in rows if r[0] == 1])
    assert got[1][5] >= 2 * 2500 and len(got[1][6].replace("I", "")) == len(after)
    assert got[2] == brute([r for r in rows if r[0] == 2])[2]


def test_empty_and_defined_cases(spark):
    empty = repair.repair(repair.damaged(spark.createDataFrame([], SCHEMA)))
    assert empty.count() == 0 and empty.columns[0] == "conv_id"
    # a conversation whose only row is dropped
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert result(repair.repair(repair.damaged(spark.createDataFrame([(conv, 0, "user", "hi.")], SCHEMA)))) == {conv: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_query_on_the_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(repair.op11_conversation_repair(spark, path)) == brute(rows)

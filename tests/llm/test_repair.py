import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemart.llm import repair
from tidemart.llm.common import table

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                     T.StructField("cell", T.StringType()), T.StructField("fault", T.StringType())])


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm:
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not visible else "duplicate" if (role, text) in seen else
                   "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Cheapest (cost, audit, lines), by a plain search that carries whole audits along."""
    marks = faults(rows)
    legal = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
    best = {"": (0, "", ())}

    def offer(table_, state, value):
        if state not in table_ or value < table_[state]:
            table_[state] = value

    def inserts(states):
        for _ in range(3):
            for state, (cost, audit, lines) in list(states.items()):
                for r in legal[state]:
                    if r in "ua":
                        offer(states, r, (cost + 5, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[r])))

    for (_, role, text), mark in zip(rows, marks):
        inserts(best)
        after = {}
        for state, (cost, audit, lines) in best.items():
            offer(after, state, (cost + 2, audit + "D", lines))
            if mark in ("blank", "duplicate"):
                continue
            more = 5 if mark == "truncated" else 0
            for r in legal[state]:
                if role[:1] == r:
                    offer(after, r, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                if r in "ua":
                    offer(after, r, (cost + more + 1, audit + "R", (*lines, {"u": "user", "a": "assistant"}[r] + ":" + text)))
        best = after
    inserts(best)
    return min(v for s, v in best.items() if s in ("", "a"))


def brute(rows, damage=True):
    out = []
    harmed = brute_damage(rows) if damage else [(c, t, r or " ", x or " ") for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        mine = sorted([r[1:] for r in harmed if r[0] == conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        times = [t for t, _, _ in mine if t is not None]
        initials = [r[:1] for _, r, _ in mine]
        marks = faults(mine)
        cost, audit, lines = brute_repair(mine)
        out.append((conv, max(times) - min(times) + 1 - len(set(times)) if times else 0, marks.count("blank"),
                    marks.count("duplicate"), marks.count("truncated"),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS).repartition(3)


def found(spark, rows, **options):
    got = repair.repaired(repair.turns(frame(spark, rows)), **options).collect()
    return sorted([(r.conv, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got], key=str)


def conversation(rng, conv, n, roles=("user", "assistant", "system", "tool", "", "unknown")):
    texts = ["Yes.", "No!", "cut", " \t", "", "Why?", "end. ", "É…"]
    rows = []
    for i in range(n):
        role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[i % 2]
        rows.append((conv, i + rng.randrange(2) * 100, role, rng.choice(texts) if rng.random() < 0.3 else f"turn {i} {rng.random()}."))
    turns = rng.sample(range(-n, 3 * n + 1), n)
    return [(c, turns[i], r, x) for i, (c, _, r, x) in enumerate(rows)]


@pytest.mark.parametrize("cell_rows", [5, 4096])
def test_random_conversations_against_brute_force(spark, cell_rows):
    """Small cells cut most conversations into several parts, large ones almost none."""
    rng = random.Random(cell_rows)
    rows = [r for conv in range(120) for r in conversation(rng, conv, rng.randrange(1, 14))]
    rows += conversation(rng, 5000, 90) + conversation(rng, None, 7) + [(7000, None, "user", "a."), (7000, 1, "assistant", "b.")]
    assert found(spark, rows, cell_rows=cell_rows) == brute(rows, damage=False)


def test_long_texts_cut_cells_by_bytes(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"{i}" + "x" * 5000 + ".") for i in range(12)] + [(2, 0, "user", "y" * 50_000)]
    assert found(spark, rows, cell_bytes=12_000) == brute(rows, damage=False)


def test_all_short_conversations(spark):
    """Every sequence of up to three rows of seven sorts, at once."""
    sorts = [("system", "s."), ("user", "u."), ("assistant", "a."), ("user", "cut"), ("assistant", "cut"), ("tool", "t."), ("user", " ")]
    rows, conv = [], 0
    for n in (1, 2, 3):
        for pick in np.ndindex(*[len(sorts)] * n):
            rows += [(conv, i, sorts[p][0], sorts[p][1] if sorts[p][1] == " " else f"{i}{sorts[p][1]}") for i, p in enumerate(pick)]
            conv += 1
    assert found(spark, rows) == brute(rows, damage=False)


def test_the_registered_query_with_awkward_rows(spark, tmp_dir):
    rng = random.Random(9)
    rows = [r for conv in range(200) for r in conversation(rng, conv, rng.randrange(1, 5))]
    rows += [(300 + i, i, None, None) for i in range(5)] + [(None, None, "user", "Hello."), (None, 3, "assistant", "x" * 100_000 + "!")]
    frame(spark, rows).write.parquet(f"{tmp_dir}/conversations.parquet")
    df = repair.op13_repair(spark, tmp_dir)
    want = brute(rows)
    assert sorted(map(tuple, df.collect()), key=str) == want
    assert any(w[-2] == "" and w[1:7] == (0,) * 6 for w in want)
    assert df.dtypes == [("conv_id", "bigint"), *[(c, "bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                         ("audit", "string"), ("repaired_sha256", "string")]


def test_the_registered_query_on_its_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, repair.op13_repair(spark, sf).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_ranks_choose_the_least_path():
    """Arcs with equal labels: only what follows tells them apart."""
    #   0 -a-> 1 -c-> 3(end),  0 -a-> 2 -b-> 3
    label = np.array([[0, 0], [2, -1], [1, -1], [-1, -1]])
    target = np.array([[1, 2], [3, 0], [3, 0], [0, 0]])
    pointers = repair.ranked(label, target, np.array([False, False, False, True]))
    assert pointers[0].tolist() == [2, 3, 3, 3]

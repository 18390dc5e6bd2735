"""Repair of damaged conversations: cheapest edits to a legal order of roles, the least of them
by prefix-doubling path ranking.

``damaged`` breaks a table of turns in a repeatable way (by crc32 of ``conv_id:turn``, modulo 20: 0
drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes its role user).
``repaired`` takes any table of turns. Rows of a conversation are ordered by turn (nulls first;
ties by role, then by a hash of the text). The first fault of a row counts: blank (nothing but
blanks), duplicate (role and text seen earlier), truncated (last visible character not ``.!?``).

Edits: Keep 0, Rerole (to user or assistant) 1, Delete 2 (the only one for blanks and
duplicates), Insert (an empty user or assistant turn, anywhere) 5; a truncated row that stays
costs 5 more. The result's role initials must form ``(s?(ua)+)?``. Of all cheapest edits those
win whose initials, in order (the audit), are the ASCII-least.

Method: a node is a row and what the roles so far allow (nothing yet, after system, user,
assistant). Costs to the end come from a pass backwards; arcs on a cheapest path stay. Nodes
are then ranked by the first 1, 2, 4, ... letters of their least path: the rank of twice the
length is that of (own rank, rank of the node that the doubled pointer leads to). The ranks
choose each node's arc, and the doubled pointers unroll the path.

Plan: rows are sorted by a range exchange on (conversation, turn, ...), so a conversation of any
length is spread over partitions, and cut into cells of bounded rows and bytes. Conversations
that lie within a cell are finished there. For the others (at most the first and last of each
cell) every cell yields a small matrix: the cost from each state before it to each state
behind it. The matrices of a conversation are folded from its end, which gives each cell its
costs to go; the cell then finds the least path for each state it may be entered in, and the
pieces are put together in a pass over them in order. A sha256 is serial by its definition: for
one conversation that pass reads its text once, in batches, never as a whole.

Defined results: null role or text: one space. A role that begins with none of s, u, a is never
kept as it is. A null conv_id is a conversation of its own; rows that repeat a turn take part one
by one. Conversations without rows after the damage have zeros, an empty audit and the hash of
nothing; an empty table gives an empty result. Other columns are not read. A gap beyond 64 bits
is reported as 2**63 - 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import table, written

BLANKS = " \t\n\x0b\x0c\r"
CELL_ROWS = 4096
CELL_BYTES = 8 << 20
#: States: nothing yet, after system, after user, after assistant; costs behind the last row
#: (a user turn needs an assistant's, a system turn both).
END = (0, 10, 5, 0)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
LABELS = "DIKR"
#: The state that a role leads to: by keeping a row of kind s, u, a, other, and by setting a role.
_KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
_SET = np.array([2, 2, 3, 2])
NAMES = {2: "user", 3: "assistant"}
FAR = 1 << 40
LARGEST = (1 << 63) - 1

#: A conversation's part within a cell, as entered in one state.
PARTS = ("conv {conv}, cell long, start int, entry int, leaves int, first boolean, last boolean, blank long, duplicate long, "
         "truncated long, illegal long, low long, high long, turns long, first_turn long, last_turn long, "
         "first_role string, last_role string, cost long, audit string, piece binary, sha string")
RESULT = ("conv {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def turns(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text of a table with conv_id, turn, role, text."""
    return rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of ``turns`` after the damage."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(text("conv"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = rows.withColumn("harm", harm).filter("harm <> 0")
    rows = rows.withColumn("text", F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.translate("text", ".!?", ""))
                           .otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")))
    times = F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(times)).select("conv", "turn", "role", "text")


def in_cells(rows: DataFrame, cell_rows: int, cell_bytes: int) -> DataFrame:
    """The rows in order, with cell and seq (their place in it); cells ascend with the order."""
    seen = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    conv = F.coalesce(F.col("conv").cast("string"), F.lit(" "))
    ranged = rows.select(
        "conv", "turn", "role", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("row"),
        "text", kind.alias("kind"), (F.length(seen) == 0).alias("blank"),
        (~F.substring(seen, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.md5(F.concat_ws("\x00", conv, F.length("role").cast("string"), "role", "text").cast("binary"))).alias("same"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "mark", "row")]
    ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order).drop("mark", "row")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, n, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            lengths = np.diff(np.frombuffer(batch["text"].cast(pa.large_string()).buffers()[1], np.int64)[
                batch["text"].offset:][:len(batch) + 1]) if len(batch) else []
            cells, seqs = [], []
            for length in lengths.tolist() if len(batch) else []:
                if n and (n >= cell_rows or size + length > cell_bytes):
                    cell, n, size = cell + 1, 0, 0
                cells.append(cell)
                seqs.append(n)
                n, size = n + 1, size + length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64()), pa.array(seqs, pa.int32())],
                                             [*batch.schema.names, "cell", "seq"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema.fields)
    return ranged.mapInArrow(deal, f"{fields}, cell long, seq int")


def with_faults(cells: DataFrame) -> DataFrame:
    """cell, seq, conv, turn, kind, fault (0 none, 1 blank, 2 duplicate, 3 truncated)."""
    spark = cells.sparkSession
    at = F.struct("cell", "seq")
    again = cells.filter("NOT blank").groupBy("same").agg(F.min(at).alias("earliest"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = written(spark, again.drop("n"), "repair-repeated")
    fault = F.when(F.col("blank"), 1).when(at > F.col("earliest"), 2).when(F.col("cut"), 3).otherwise(0)
    return cells.select("cell", "seq", "conv", "turn", "kind", "blank", "cut", "same").join(again, "same", "left") \
        .select("cell", "seq", "conv", "turn", "kind", fault.alias("fault"))


def runs(conv: pa.ChunkedArray) -> list[tuple[int, int]]:
    """(start, end) of the runs of one conversation in rows in order."""
    ids = conv.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
    return list(zip(cuts[:-1], cuts[1:])) if len(ids) else []


def costs(kind: list[int], fault: list[int], end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The least cost from each state before each row to the end, whose costs are ``end``."""
    n0, n1, n2, n3 = end
    out = [tuple(end)]
    for k, f in zip(reversed(kind), reversed(fault)):
        t, s, u, a = n0 + DELETE, n1 + DELETE, n2 + DELETE, n3 + DELETE
        if f in (0, 3):
            stay = CUT if f == 3 else KEEP
            t, s, u, a = (min(t, n2 + stay + REROLE), min(s, n2 + stay + REROLE), min(u, n3 + stay + REROLE),
                          min(a, n2 + stay + REROLE))
            if k == 0:
                t = min(t, n1 + stay)
            elif k == 1:
                t, s, a = min(t, n2 + stay), min(s, n2 + stay), min(a, n2 + stay)
            elif k == 2:
                u = min(u, n3 + stay)
        u, a = min(u, a + INSERT), min(a, u + INSERT)
        n0, n1, n2, n3 = min(t, u + INSERT), min(s, u + INSERT), u, a
        out.append((n0, n1, n2, n3))
    return out[::-1]


def ranked(label: np.ndarray, target: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Pointers of 1, 2, 4, ... steps along each node's least path. ``label`` and ``target``: the
    arcs of a cheapest path by node (label -1: none); ``last``: nodes without arcs.

    Ranks order nodes by the first letters of their least path, twice as many each time. Arcs
    are chosen by (label, rank of the target) once ranks cover whole paths."""
    nodes = np.arange(len(label))
    none = np.iinfo(np.int64).max
    rank = np.zeros(len(label), np.int64)
    while True:
        key = np.where(label < 0, none, label * (len(label) + 1) + rank[target])
        choice = key.argmin(axis=1)
        ahead = np.where(last, nodes, target[nodes, choice])
        rank = np.where(last, 0, label[nodes, choice] + 1)
        pointers = [ahead]
        while not last[pointers[-1]].all():
            step = pointers[-1]
            rank = np.unique(rank * (int(rank.max()) + 1) + rank[step], return_inverse=True)[1].reshape(-1)
            pointers.append(step[step])
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointers[-1]], return_inverse=True)[1].reshape(-1)
        key = np.where(label < 0, none, label * (len(label) + 1) + rank[target])
        if (last | (key.argmin(axis=1) == choice)).all():
            return pointers


def paths(kind: np.ndarray, fault: np.ndarray, spans: list[tuple[int, int]], ends: list[tuple[int, ...]]):
    """For each span of rows: (costs before its first row, a function from the state it is
    entered in to its least path as (labels, rows, states after each edit))."""
    go = [costs(kind[a:z].tolist(), fault[a:z].tolist(), end) for (a, z), end in zip(spans, ends)]
    cost = np.array([c for g in go for c in g], np.int64)  # a layer of nodes for each row and each span's end
    layer = np.concatenate([np.arange(a, z) + i for i, (a, z) in enumerate(spans)])
    nodes, states = len(cost) * 4, np.arange(4)
    label, target = np.full((nodes, 4), -1), np.zeros((nodes, 4), np.int64)
    stays = ((fault == 0) | (fault == 3))[:, None]
    extra = np.where(fault == 3, CUT, KEEP)[:, None]
    kept = _KEPT[:, kind].T
    here = layer[:, None]
    for j, (to, price, there, allowed) in enumerate((
            (np.broadcast_to(states, kept.shape), DELETE, here + 1, True),
            (np.broadcast_to(_SET, kept.shape), INSERT, here, True),
            (kept, extra, here + 1, stays & (kept >= 0)),
            (np.broadcast_to(_SET, kept.shape), extra + REROLE, here + 1, stays))):
        best = allowed & (cost[there, np.maximum(to, 0)] + price == cost[layer])
        at = (here * 4 + states)[best]
        label[at, j] = j
        target[at, j] = (there * 4 + np.maximum(to, 0))[best]
    last = (label < 0).all(axis=1)
    pointers = ranked(label, target, last)
    chosen = np.where(target == pointers[0][:, None], label, -1)
    first = np.where(chosen < 0, 9, chosen).min(axis=1)

    def unroll(start: int):
        path = np.array([start])
        for step in pointers:
            if last[path[-1]]:
                break
            path = np.concatenate([path, step[path]])
        path = path[:int(last[path].argmax()) + 1]
        return path

    out = []
    for i, (a, z) in enumerate(spans):
        def path(entry: int, i: int = i, a: int = a):
            way = unroll((a + i) * 4 + entry)
            return first[way[:-1]].tolist(), (way[:-1] // 4 - i).tolist(), (way[1:] % 4).tolist()
        out.append((go[i][0], path))
    return out


def borders(codes: DataFrame, conv: str) -> DataFrame:
    """Costs through the first and last conversation of each cell: conv, cell, start, through
    (4 x 4, by state before and behind)."""
    def measure(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("seq")
        spans = runs(rows["conv"])
        spans = spans[:1] + spans[-1:] if len(spans) > 1 else spans
        kind, fault = rows["kind"].to_pylist(), rows["fault"].to_pylist()
        through = []
        for a, z in spans:
            single = [costs(kind[a:z], fault[a:z], tuple(0 if s == t else FAR for s in range(4)))[0] for t in range(4)]
            through.append([single[t][s] for s in range(4) for t in range(4)])
        return pa.table({"conv": rows["conv"].take([a for a, _ in spans]).combine_chunks(),
                         "cell": pa.array([rows["cell"][0].as_py()] * len(spans), pa.int64()),
                         "start": pa.array([a for a, _ in spans], pa.int32()),
                         "through": pa.array(through, pa.list_(pa.int64()))})

    return codes.groupBy("cell").applyInArrow(measure, f"conv {conv}, cell long, start int, through array<bigint>")


def folded(parts: DataFrame) -> DataFrame:
    """cell, start, first, last, ends (costs behind the part) of the ``borders``; a
    conversation has one row a cell here."""
    def fold(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("cell", "ascending"), ("start", "ascending")])
        through = np.array(rows["through"].to_pylist(), np.int64).reshape(-1, 4, 4)
        ends, g = [], np.array(END, np.int64)
        for m in through[::-1]:
            ends.append(g.tolist())
            g = np.minimum((m + g[None, :]).min(axis=1), FAR)
        n = len(through)
        return pa.table({"cell": rows["cell"], "start": rows["start"], "first": [i == 0 for i in range(n)],
                         "last": [i == n - 1 for i in range(n)], "ends": pa.array(ends[::-1], pa.list_(pa.int64()))})

    return parts.groupBy("conv").applyInArrow(fold, "cell long, start int, first boolean, last boolean, ends array<bigint>")


def finish(state: int) -> list[int]:
    """States that inserted turns behind the last row lead to."""
    return {0: [], 1: [2, 3], 2: [3], 3: []}[state]


def solved(cells: DataFrame, codes: DataFrame, folds: DataFrame, conv: str) -> DataFrame:
    """``PARTS`` of each cell; a conversation that lies within it is a single finished part."""
    marks = codes.select("cell", "seq", "fault", F.lit(None).cast("boolean").alias("first"),
                         F.lit(None).cast("boolean").alias("last"), F.lit(None).cast("array<bigint>").alias("ends"))
    folds = folds.select("cell", F.col("start").alias("seq"), F.lit(None).cast("int").alias("fault"), "first", "last", "ends")
    marks = marks.unionByName(folds).withColumnRenamed("cell", "of")
    names = [x.strip().split()[0] for x in PARTS.split(",")]

    def solve(rows: pa.Table, notes: pa.Table) -> pa.Table:
        rows = rows.sort_by("seq")
        isfold = notes["fault"].is_null()
        fault = notes.filter(pa.compute.invert(isfold)).sort_by("seq")["fault"].to_numpy().astype(np.int64)
        known = {r["seq"]: r for r in notes.filter(isfold).to_pylist()}
        kind = rows["kind"].to_numpy().astype(np.int64)
        role, text, turn = rows["role"].to_pylist(), rows["text"].to_pylist(), rows["turn"].to_pylist()
        ids = rows["conv"].to_pylist()
        spans = runs(rows["conv"])
        about = [known.get(a, {"first": True, "last": True, "ends": list(END)}) for a, _ in spans]
        out = []
        for (a, z), note, (go, path) in zip(spans, about, paths(kind, fault, spans, [tuple(n["ends"]) for n in about])):
            times = [t for t in turn[a:z] if t is not None]
            starts = [r[:1] for r in role[a:z]]
            faults = np.bincount(fault[a:z], minlength=4).tolist()
            base = [ids[a], rows["cell"][0].as_py(), a]
            facts = [*faults[1:], sum(x + y not in ("su", "ua", "au") for x, y in zip(starts, starts[1:])),
                     min(times, default=None), max(times, default=None), len(set(times)), turn[a], turn[z - 1], starts[0], starts[-1]]
            for entry in (0,) if note["first"] else range(4):
                letters, places, states = path(entry)
                leaves = states[-1] if states else entry
                lines = []
                for x, r, s in zip(letters, places, states):
                    if x == 1:
                        lines.append(f"{NAMES[s]}:")
                    elif x:
                        lines.append(f"{role[r] if x == 2 else NAMES[s]}:{text[r]}")
                cost = go[entry] - note["ends"][leaves]
                if note["last"]:
                    more = finish(leaves)
                    lines += [f"{NAMES[s]}:" for s in more]
                    letters, cost = letters + [1] * len(more), cost + END[leaves]
                audit = "".join(LABELS[x] for x in letters)
                piece = "".join("\n" + line for line in lines).encode()
                whole = note["first"] and note["last"]
                out.append([*base, entry, leaves, note["first"], note["last"], *facts, cost, audit, None if whole else piece,
                            hashlib.sha256(piece[1:]).hexdigest() if whole else None])
        columns = [list(c) for c in zip(*out)] or [[] for _ in names]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    empty = cells.sparkSession.createDataFrame([], PARTS.format(conv=conv))
    fields = empty.toArrow().schema
    return cells.select("cell", "seq", "conv", "turn", "role", "text", "kind").groupBy("cell") \
        .cogroup(marks.groupBy("of")).applyInArrow(solve, PARTS.format(conv=conv))


def joined(parts: DataFrame, conv: str) -> DataFrame:
    """``RESULT`` of conversations in several parts: read in order, entered as left before."""
    order = [F.col(c).asc_nulls_first() for c in ("conv", "cell", "start", "entry")]
    dealt = parts.repartition("conv").sortWithinPartitions(*order)
    fields = parts.sparkSession.createDataFrame([], RESULT.format(conv=conv)).toArrow().schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def result() -> pa.RecordBatch:
            gaps = now["high"] - now["low"] + 1 - now["turns"] if now["turns"] else 0
            row = [now["conv"], min(gaps, LARGEST), *now["sums"], "".join(now["audit"]), now["hash"].hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, fields)], schema=fields)

        for batch in batches:
            for at in range(len(batch)):
                r = {name: batch[name][at].as_py() for name in ("conv", "cell", "entry", "first")}
                if r["first"]:
                    if now is not None:
                        yield result()
                    now = {"conv": r["conv"], "state": 0, "sums": [0] * 5, "low": None, "high": None, "turns": 0,
                           "audit": [], "hash": hashlib.sha256(), "empty": True, "cell": None, "role": None, "turn": None}
                if r["entry"] != now["state"] or r["cell"] == now["cell"]:
                    continue
                r = {name: batch[name][at].as_py() for name in batch.schema.names}
                broken = now["role"] is not None and now["role"] + r["first_role"] not in ("su", "ua", "au")
                now["sums"] = [x + y for x, y in zip(now["sums"], (r["blank"], r["duplicate"], r["truncated"],
                                                                   r["illegal"] + broken, r["cost"]))]
                lows, highs = [x for x in (now["low"], r["low"]) if x is not None], [x for x in (now["high"], r["high"]) if x is not None]
                same = r["first_turn"] is not None and r["first_turn"] == now["turn"]
                now.update(low=min(lows, default=None), high=max(highs, default=None), turns=now["turns"] + r["turns"] - same,
                           state=r["leaves"], cell=r["cell"], role=r["last_role"], turn=r["last_turn"])
                now["audit"].append(r["audit"])
                piece = r["piece"]
                now["hash"].update(piece[1:] if now["empty"] else piece)
                now["empty"] = now["empty"] and not piece
        if now is not None:
            yield result()

    return dealt.mapInArrow(read, RESULT.format(conv=conv))


def repaired(rows: DataFrame, cell_rows: int = CELL_ROWS, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """``RESULT`` of each conversation in a table of ``turns``."""
    spark = rows.sparkSession
    conv = rows.schema["conv"].dataType.simpleString()
    cells = written(spark, in_cells(rows, cell_rows, cell_bytes), "repair-cells")
    codes = written(spark, with_faults(cells), "repair-codes")
    folds = written(spark, folded(borders(codes, conv)), "repair-folds")
    parts = written(spark, solved(cells, codes, folds, conv), "repair-parts")
    gaps = F.when(F.col("turns") == 0, F.lit(0).cast("decimal(38,0)")).otherwise(
        F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.col("turns"))
    whole = parts.filter("first AND last").select(
        "conv", F.least(gaps, F.lit(LARGEST).cast("decimal(38,0)")).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))
    return whole.unionByName(joined(parts.filter("NOT (first AND last)"), conv))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(table(spark, sf_dir, "conversations"))
    found = repaired(damaged(rows)).withColumnRenamed("conv", "found")
    every = rows.select("conv").distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return every.join(found, F.col("conv").eqNullSafe(F.col("found")), "left").select(
        F.col("conv").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))

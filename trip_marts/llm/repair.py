"""Repair of conversations at the least cost, of equal repairs the least audit.

Roles have to read `(s?(ua)+)?` by their initials. A repair keeps, re-roles or deletes every
row and inserts rows; its audit is the string of the edits' initials. The states of that
pattern and the rows of a conversation make a graph whose arcs are edits. After the cost
of the way to the end is known for every node (from min-plus products of the rows' cost
matrices), only arcs on cheapest ways are left. Prefix doubling ranks the nodes by the
least audit of 1, 2, 4, ... edits that starts there, with a pointer to the node it leads
to, and the least path is read off through the doubled pointers.

Rows are sorted once over the whole table and cut into chunks of at most `CHUNK` rows, so
a conversation of any length is spread over many tasks. Conversations inside one chunk
are finished there. For the others chunks first give their cost matrix; costs to the end
are then carried from chunk to chunk, every chunk gives its least path for each state
it may be entered in, and the states are carried forward.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from trip_marts.llm.groups import with_groups
from trip_marts.llm.shared import saved

#: Rows of a chunk; a power of two, so that chunks never cross the tasks' ranges.
CHUNK = 512
#: States: nothing yet, after s, after u, after a. The first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
MAY_END = [START, ASSISTANT]
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_FAR = 1 << 40
#: Letters of an audit in ASCII order; an ended audit is less than any letter.
LETTERS = "DIKR"
#: State behind each state after a row of a given kind (s, u, a, other) is kept; -1: can't be.
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: State behind each state after a user or assistant row is put there.
PUT = np.array([USER, USER, ASSISTANT, USER])
BLANK, DUPLICATE, CUT, SOUND = range(4)
PUT_ROLE = {USER: "user", ASSISTANT: "assistant"}
SPACE = " \t\n\x0b\x0c\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """`(conv_id, turn, role, text)` with a damage picked by the CRC-32 of `conv_id:turn`.

    Nulls are one space, in the key as in role and text; `conv_id` and `turn` stay null as columns.
    Of 20 remainders, 0 drops a row, 1 empties its text, 2 removes its `.`, `!` and `?`, 3
    repeats it and 4 makes its role user.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(
        "conv_id", "turn",
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(key) % 20).alias("damage"),
    ).where("damage != 0")
    kind = F.col("damage")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """Rows with `pos`, their place in the whole table by conversation and turn, nulls first.

    Rows of one turn stand by a hash of role and text; equal rows are together. The range of
    a task ends anywhere, also inside a conversation, a turn or a run of equal rows.
    """
    hashed = rows.withColumns({"hash": F.xxhash64("role", "text"), "row": F.monotonically_increasing_id()})
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("hash"), F.asc("row")]
    ranged = hashed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("hash", "row")
    return saved(ranged.withColumn("pos", F.monotonically_increasing_id()), "ordered")


def said_before(rows: DataFrame) -> DataFrame:
    """`pos` of the ordered rows whose role and text occur earlier in their conversation.

    Rows are compared by SHA-256. A saying that fills a third of the rows is reduced to
    its first place in every task, and only that place is sent to its rows.
    """
    conv = F.concat(F.when(F.col("conv_id").isNull(), "-").otherwise("="), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    slim = saved(rows.select("pos", conv.alias("conv"), said.alias("said")), "said")
    groups = slim.groupBy("conv", "said").agg(F.count("*").alias("size"), F.min("pos").alias("first"))
    repeated = saved(groups.where("size > 1"), "repeated")
    found = with_groups(slim, repeated, ["conv", "said"], slim.count())
    return found.where("pos > first").select("pos")


def kinds_of(roles: list[str]) -> np.ndarray:
    """0, 1, 2 for roles whose initial is s, u or a, 3 for others."""
    return np.array([3 if not r else ("sua".find(r[0]) + 4) % 4 for r in roles], np.int64)


def faults_of(texts: list[str], again: np.ndarray) -> np.ndarray:
    """First fault of every row: blank, said before, cut off, or none."""
    found = np.full(len(texts), SOUND)
    for i, text in enumerate(texts):
        end = text.rstrip(SPACE)[-1:]
        found[i] = BLANK if not end else DUPLICATE if again[i] else SOUND if end in ".!?" else CUT
    return found


# ---- costs


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Min-plus products of 4 x 4 cost matrices."""
    return np.minimum((x[..., :, :, None] + y[..., None, :, :]).min(axis=-2), _FAR)


def _inserted() -> np.ndarray:
    """Least cost from state to state by insertions only."""
    step = np.full((4, 4), _FAR)
    step[np.arange(4), np.arange(4)] = 0
    step[np.arange(4), PUT] = INSERT
    return product(step, step)


INSERTED = _inserted()
#: Least cost from each state to the end of a conversation without rows left.
END = INSERTED[:, MAY_END].min(axis=1)


def edit_costs(faults: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost of keeping and of re-roling each row."""
    keep = np.where(faults == CUT, TRUNCATED, np.where(faults == SOUND, 0, _FAR))
    return keep, np.minimum(keep + REROLE, _FAR)


def row_costs(kinds: np.ndarray, faults: np.ndarray) -> np.ndarray:
    """Cost matrix of every row: insertions ahead of it, then one edit of it."""
    keep, put = edit_costs(faults)
    own = np.full((len(kinds), 4, 4), _FAR)
    for s in range(4):
        own[:, s, s] = DELETE
        own[:, s, PUT[s]] = np.minimum(own[:, s, PUT[s]], put)
        to = KEPT[s, kinds]
        can = np.flatnonzero(to >= 0)
        own[can, s, to[can]] = np.minimum(own[can, s, to[can]], keep[can])
    return product(INSERTED[None], own)


def suffix_products(costs: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Product of the matrices from every row to the end of its run, by doubled steps."""
    out, step, here = costs.copy(), 1, np.arange(len(costs))
    while True:
        at = np.flatnonzero(here + step < ends)
        if not len(at):
            return out
        out[at] = product(out[at], out[at + step])
        step *= 2


# ---- least paths


class Paths:
    """Least audits through runs of rows, once the cost behind each run is known.

    Run g has rows starts[g] up to ends[g]; `after[g]` is the cost from each state behind it, and
    `last[g]` tells that its conversation ends there. A run of n rows has n + 1
    places, and a node is a place and a state.
    """

    def __init__(self, kinds, faults, starts, ends, after, last) -> None:
        n, runs = len(kinds), len(starts)
        run = np.repeat(np.arange(runs), ends - starts)
        place = np.arange(n) + run
        self.first = starts + np.arange(runs)
        final = ends + np.arange(runs)
        cost = np.zeros((n + runs, 4), np.int64)
        cost[final] = after
        if n:
            whole = suffix_products(row_costs(kinds, faults), ends[run])
            cost[place] = (whole + after[run][:, None, :]).min(axis=-1)
        self.letter, self.pointer = self._least_arcs(cost, kinds, faults, place, final, last)

    @staticmethod
    def _least_arcs(cost, kinds, faults, place, final, last) -> tuple[np.ndarray, np.ndarray]:
        """Letter (0 at an end) and target of the arc of the least audit from each node."""
        nodes = cost.size
        here, flat = np.arange(nodes).reshape(-1, 4), cost.ravel()
        to, ok = np.tile(np.arange(nodes), (len(LETTERS), 1)), np.zeros((len(LETTERS), nodes), bool)

        def arcs(letter: str, source: np.ndarray, target: np.ndarray, price) -> None:
            """Of these arcs, keep those on a cheapest way."""
            good = flat[source] == flat[target] + price
            to[LETTERS.index(letter), source[good]] = target[good]
            ok[LETTERS.index(letter), source[good]] = True

        keep, put = edit_costs(faults)
        for s in range(4):
            own, following = here[place, s], place + 1
            arcs("D", own, here[following, s], DELETE)
            arcs("R", own, here[following, PUT[s]], put)
            state = KEPT[s, kinds]
            can = state >= 0
            arcs("K", own[can], here[following[can], state[can]], keep[can])
            open_ = np.concatenate([place, final[last]])
            arcs("I", here[open_, s], here[open_, PUT[s]], INSERT)
        letter = np.where(ok.any(axis=0), ok.argmax(axis=0) + 1, 0)
        pointer = to[np.maximum(letter - 1, 0), np.arange(nodes)]
        rank = ranks(letter, pointer)
        # letters come first, then the rank of what they lead to
        order = np.where(ok, np.arange(1, 5)[:, None] * (nodes + 1) + rank[to], np.iinfo(np.int64).max)
        best = order.argmin(axis=0)
        return np.where(ok.any(axis=0), best + 1, 0), to[best, np.arange(nodes)]

    def audits(self, entry: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Audit and last state of the least path of every run from its entry state."""
        path, pointer = (self.first * 4 + entry)[:, None], self.pointer
        while self.letter[path[:, -1]].any():
            path = np.concatenate([path, pointer[path]], axis=1)
            pointer = pointer[pointer]
        letters = np.frombuffer(b"\0" + LETTERS.encode(), np.uint8)[self.letter[path]]
        return [row.tobytes().rstrip(b"\0").decode() for row in letters], path[:, -1] % 4


def ranks(letter: np.ndarray, pointer: np.ndarray) -> np.ndarray:
    """Rank of every node by its whole least audit, from audits of 1, 2, 4, ... edits."""
    rank = letter
    while True:
        rank = np.unique(rank * (len(letter) + 5) + rank[pointer], return_inverse=True)[1]
        further = pointer[pointer]
        if (further == pointer).all():
            return rank
        pointer = further


def replayed(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], int]:
    """Lines of the repaired rows, and the state behind them."""
    lines, i = [], 0
    for letter in audit:
        if letter == "I":
            state = int(PUT[state])
            lines.append(f"{PUT_ROLE[state]}:")
            continue
        if letter == "R":
            state = int(PUT[state])
            lines.append(f"{PUT_ROLE[state]}:{texts[i]}")
        elif letter == "K":
            state = int(KEPT[state, kinds_of([roles[i]])[0]])
            lines.append(f"{roles[i]}:{texts[i]}")
        i += 1
    return lines, state


# ---- chunks


def _legal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether initials follow each other: su, ua or au."""
    return ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))


FACTS = ["lo", "hi", "turns", "blank", "duplicate", "truncated", "illegal"]
RUN_SCHEMA = (
    "conv_id {id}, run long, audit string, sha string, cost long, lo long, hi long, turns long, blank long, duplicate long, "
    "truncated long, illegal long, matrix array<long>, kinds array<long>, faults array<long>, roles array<string>, texts array<string>"
)


def _facts(turns: list[int | None], kinds: np.ndarray, faults: np.ndarray) -> dict:
    """What is counted in one run of rows."""
    known = [t for t in turns if t is not None]
    return {
        "lo": known[0] if known else None,
        "hi": known[-1] if known else None,
        "turns": len(set(known)),
        "blank": int((faults == BLANK).sum()),
        "duplicate": int((faults == DUPLICATE).sum()),
        "truncated": int((faults == CUT).sum()),
        "illegal": int((~_legal(kinds[:-1], kinds[1:])).sum()),
    }


def _digest(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def chunk_runs(rows: pa.Table, again: pa.Table) -> list[dict]:
    """The runs of one conversation each in a chunk: finished ones, and those that may go on.

    Only the first and the last run can go on in another chunk.
    """
    rows = rows.sort_by("pos")
    ids, turns, roles, texts = (rows[c].to_pylist() for c in ("conv_id", "turn", "role", "text"))
    pos = rows["pos"].to_numpy()
    kinds, faults = kinds_of(roles), faults_of(texts, np.isin(pos, again["pos"].to_numpy()))
    starts = np.array([i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]])
    ends = np.append(starts[1:], len(ids))
    inner = slice(1, len(starts) - 1)
    out = []
    if len(starts) > 2:
        lo, hi = int(starts[1]), int(ends[-2])
        own = starts[inner] - lo, ends[inner] - lo
        k = len(own[0])
        paths = Paths(kinds[lo:hi], faults[lo:hi], *own, np.tile(END, (k, 1)), np.ones(k, bool))
        for (a, b), audit in zip(zip(starts[inner], ends[inner]), paths.audits(np.zeros(k, np.int64))[0]):
            lines, _ = replayed(audit, START, roles[a:b], texts[a:b])
            done = {"conv_id": ids[a], "audit": audit, "sha": _digest(lines), "cost": cost_of(audit, faults[a:b])}
            out.append(done | _facts(turns[a:b], kinds[a:b], faults[a:b]))
    for number, g in enumerate(sorted({0, len(starts) - 1})):
        a, b = int(starts[g]), int(ends[g])
        matrix = suffix_products(row_costs(kinds[a:b], faults[a:b]), np.full(b - a, b - a))[0]
        out.append(
            {
                "conv_id": ids[a], "run": rows["chunk"][0].as_py() * 2 + number, "matrix": matrix.ravel().tolist(),
                "kinds": kinds[a:b].tolist(), "faults": faults[a:b].tolist(), "roles": roles[a:b], "texts": texts[a:b],
            } | _facts(turns[a:b], kinds[a:b], faults[a:b])
        )
    return out


def cost_of(audit: str, faults: np.ndarray) -> int:
    """Cost of the edits of an audit."""
    rows = [letter for letter in audit if letter != "I"]
    cut = sum(letter != "D" and fault == CUT for letter, fault in zip(rows, faults))
    return INSERT * audit.count("I") + DELETE * audit.count("D") + REROLE * audit.count("R") + TRUNCATED * cut


def _by_conversation(df: DataFrame, schema: str, falling: bool, each) -> DataFrame:
    """Runs of one conversation after another through `each(rows of a conversation)`, a generator.

    A conversation's runs come as an iterator, so that no task holds all of them.
    """
    run = F.desc("run") if falling else F.asc("run")
    ordered = df.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), run)
    fields = _arrow(schema)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):  # one at a time, as a run's texts may be long
                    yield batch.slice(i, 1).to_pylist()[0]

        for _, own in itertools.groupby(rows(), key=lambda r: r["conv_id"]):
            for some in itertools.batched(each(own), 64):
                yield pa.RecordBatch.from_pylist(list(some), schema=fields)

    return ordered.mapInArrow(go, schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _costs_behind(runs: Iterator[dict]) -> Iterator[dict]:
    """From a conversation's last run to its first: cost behind each, and what joins it to the next."""
    after, following = END, None
    for run in runs:
        matrix = np.array(run["matrix"], np.int64).reshape(4, 4)
        same = following is not None and run["hi"] is not None and run["hi"] == following["lo"]
        legal = following is None or bool(_legal(np.array(run["kinds"][-1]), np.array(following["kinds"][0])))
        before = np.minimum((matrix + after[None, :]).min(axis=1), _FAR)
        yield {
            "run": run["run"], "after": after.tolist(), "last": following is None, "whole": int(before[START]),
            "same_turn": int(same), "broken": int(not legal),
        }
        after, following = before, run


def _ways(run: dict) -> dict:
    """Least path through a run from each state."""
    n = len(run["kinds"])
    one = np.zeros(1, np.int64), np.array([n])
    paths = Paths(
        np.array(run["kinds"], np.int64), np.array(run["faults"], np.int64), *one,
        np.array([run["after"]], np.int64), np.array([run["last"]]),
    )
    found = [paths.audits(np.array([s])) for s in range(4)]
    return {"conv_id": run["conv_id"], "run": run["run"], "audits": [a[0] for a, _ in found], "exits": [int(e[0]) for _, e in found]}


def _entered(runs: Iterator[dict]) -> Iterator[dict]:
    """From a conversation's first run to its last: the state it is entered in, and its audit."""
    state = START
    for run in runs:
        yield {"run": run["run"], "entry": state, "audit": run["audits"][state]}
        state = run["exits"][state]


def _piece(run: dict) -> dict:
    lines, _ = replayed(run["audit"], run["entry"], run["roles"], run["texts"])
    kept = {c: run[c] for c in ("conv_id", "run", "audit", "whole", "same_turn", "broken", *FACTS)}
    return kept | {"piece": "\n".join(lines)}


def _finished(runs: Iterator[dict]) -> Iterator[dict]:
    """A conversation from its runs' pieces, in order; texts pass one run at a time."""
    digest, audit, total, any_line = hashlib.sha256(), [], None, False
    for run in runs:
        if run["piece"]:
            digest.update((("\n" if any_line else "") + run["piece"]).encode())
            any_line = True
        audit.append(run["audit"])
        if total is None:
            total = {"conv_id": run["conv_id"], "cost": run["whole"], "lo": None, "hi": None} | dict.fromkeys(FACTS[2:], 0)
        total["lo"] = run["lo"] if total["lo"] is None else total["lo"]
        total["hi"] = total["hi"] if run["hi"] is None else run["hi"]
        for fact in FACTS[2:]:
            total[fact] += run[fact]
        total["turns"] -= run["same_turn"]
        total["illegal"] += run["broken"]
    yield total | {"audit": "".join(audit), "sha": digest.hexdigest()}


def repaired(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repair of every conversation with rows.

    `rows` has `conv_id`, `turn`, `role` and `text`, of which role and text are not null. Columns:
    `conv_id`, `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`, `audit`,
    `repaired_sha256`. Rows without a conversation make up one of their own; rows without a
    turn come first. An empty table gives no rows.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    ordered = in_order(rows.select("conv_id", "turn", "role", "text"))
    chunk = F.shiftright("pos", CHUNK.bit_length() - 1)
    schema = RUN_SCHEMA.format(id=id_type)
    fields = _arrow(schema)

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(chunk_runs(left, right) if left.num_rows else [], schema=fields)

    again = said_before(ordered).withColumn("chunk", chunk)
    made = ordered.withColumn("chunk", chunk).groupBy("chunk").cogroup(again.groupBy("chunk")).applyInArrow(each, schema)
    made = saved(made, "runs")
    runs = made.where("run is not null")
    slim = runs.select("conv_id", "run", "matrix", "kinds", "lo", "hi")
    behind = "run long, after array<long>, last boolean, whole long, same_turn long, broken long"
    behind = saved(_by_conversation(slim, behind, True, _costs_behind), "behind")
    ways = f"conv_id {id_type}, run long, audits array<string>, exits array<long>"
    ways = _each_row(runs.select("conv_id", "run", "kinds", "faults").join(behind.select("run", "after", "last"), "run"), ways, _ways)
    entered = saved(_by_conversation(ways, "run long, entry long, audit string", False, _entered), "entered")
    facts = ", ".join(f"{c} long" for c in ("whole", "same_turn", "broken", *FACTS))
    pieces = runs.drop("audit", "sha", "cost", "matrix", "kinds", "faults").join(entered, "run").join(behind.drop("after", "last"), "run")
    pieces = _each_row(pieces, f"conv_id {id_type}, run long, audit string, {facts}, piece string", _piece)
    facts = ", ".join(f"{c} long" for c in FACTS)
    rest = _by_conversation(pieces, f"conv_id {id_type}, cost long, {facts}, audit string, sha string", False, _finished)
    whole = made.where("run is null").select("conv_id", "cost", *FACTS, "audit", "sha").unionByName(rest)
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return whole.select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("sha").alias("repaired_sha256"),
    )


def _each_row(df: DataFrame, schema: str, each) -> DataFrame:
    fields = _arrow(schema)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one at a time, as a run's texts may be long
                yield pa.RecordBatch.from_pylist([each(batch.slice(i, 1).to_pylist()[0])], schema=fields)

    return df.mapInArrow(go, schema)


def repair_digest(conversations: DataFrame) -> DataFrame:
    """`repaired` of the damaged rows, with a row for every conversation of the table.

    A conversation that loses all rows has zeros, an empty audit and the digest of an empty
    text. Nulls are handled as in `damaged`; repeated rows are rows of their own, of which the
    later ones are duplicates. Other columns are ignored; an empty table gives no rows.
    """
    found = saved(repaired(damaged(conversations.select("conv_id", "turn", "role", "text"))), "repaired")
    ids = conversations.select("conv_id").distinct()
    seen = found.select(F.col("conv_id").alias("seen"))
    gone = ids.join(seen, F.col("conv_id").eqNullSafe(F.col("seen")), "left_anti")
    nothing = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = gone.select("conv_id", *nothing, F.lit("").alias("audit"), F.lit(_digest([])).alias("repaired_sha256"))
    return found.unionByName(empty)

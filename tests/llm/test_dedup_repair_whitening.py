"""Exact dedup, conversation repair and whitening against brute force and on odd rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from trip_marts.llm import charpoly, exact_dedup, repair, whitening
from trip_marts.llm.shared import ship

SPACES = re.compile(r"[\x20\x09-\x0D]")


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship(spark)


# ---- exact dedup

TEXTS = ["a b", "ab", "a\tb\n", None, "", " \r\x0b\x0c", "a b", "A b", "é" * 5000, "é " * 5000, "x", "x"]


def test_equal_texts_equal_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(i, "hot  text") for i in range(100, 400)] + [(7, "A b"), (None, "ab "), (None, None), (500, "hottext ")]
    made = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as keep_id", "'s' as sha", "true as kept").repartition(5)
    found = exact_dedup.equal_texts(made).collect()
    groups: dict[str, list] = {}
    for i, text in rows:
        groups.setdefault(SPACES.sub("", text or ""), []).append((-len(text or ""), i is None, i))
    expected = Counter()
    for text, own in groups.items():
        own.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        for k, (_, _, i) in enumerate(own):
            expected[(i, own[0][2], len(own), k == 0, sha)] += 1
    assert Counter(tuple(r) for r in found) == expected
    assert exact_dedup.equal_texts(made.limit(0)).count() == 0


def test_one_row_of_each_text_stays_whole(spark):
    rows = [(i, t, i % 3, "x") for i, t in enumerate(TEXTS)] + [(i, "hot", 0, "y") for i in range(50, 90)] + [(3, None, 0, "x")]
    made = spark.createDataFrame(rows, "doc_id long, text string, sha int, again string")
    kept = exact_dedup.without_copies(made)
    assert kept.columns == made.columns
    stays = {r.doc_id for r in exact_dedup.equal_texts(made).where("kept").collect()}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(stays)
    assert exact_dedup.without_copies(made.limit(0)).count() == 0


def test_a_full_filter_only_costs_shuffles(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 64)
    monkeypatch.setattr(exact_dedup, "LEAST_BITS", 64)
    made = spark.createDataFrame([(i, f"t{i // 2}") for i in range(300)], "doc_id long, text string")
    with pytest.warns(UserWarning, match="raise MAX_BITS"):
        found = exact_dedup.equal_texts(made).collect()
    assert all((r.keep_id, r.group_size, r.kept) == (r.doc_id // 2 * 2, 2, r.doc_id % 2 == 0) for r in found) and len(found) == 300


def test_rows_without_an_equal_are_not_shuffled(spark):
    rows = spark.createDataFrame([(f"{i}",) for i in range(5000)] + [("7",)] * 50, "sha string")
    bits = exact_dedup.filter_bits(5050)
    held = spark.sparkContext.broadcast(exact_dedup.repeated_bits(rows, bits))
    again = rows.where(exact_dedup.may_repeat(rows.sha, held, bits))
    assert again.where("sha = '7'").count() == 51 and again.count() < 51 + 250
    assert exact_dedup.filter_bits(10**12) == exact_dedup.MAX_BITS


# ---- conversation repair


def brute_repair(rows):
    """Cheapest repair, then least audit, of `(turn, role, text)` in order, by all states row by row."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    put = {"": "u", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    def inserted(states):
        for _ in range(2):
            for last, (cost, audit, lines) in list(states.items()):
                new = cost + 3, audit + "I", [*lines, f"{full[put[last]]}:"]
                if put[last] not in states or new < states[put[last]]:
                    states[put[last]] = new
        return states

    states = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        following = {}
        for last, (cost, audit, lines) in inserted(states).items():
            options = [(last, cost + 4, audit + "D", lines)]
            if fault not in ("blank", "duplicate"):
                cost += 3 * (fault == "truncated")
                options.append((put[last], cost + 3, audit + "R", [*lines, f"{full[put[last]]}:{text}"]))
                if role[:1] == put[last] or (last == "" and role[:1] == "s"):
                    options.append((role[0], cost, audit + "K", [*lines, f"{role}:{text}"]))
            for state, *rest in options:
                if state not in following or tuple(rest) < following[state]:
                    following[state] = tuple(rest)
        states = following
    states = inserted(states)
    cost, audit, lines = min(states[s] for s in ("", "a") if s in states)
    initials = [r[:1] for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def conversations(seed, count):
    rng = np.random.default_rng(seed)
    texts = ["Hello.", "Well?", "cut off", "", " \n", "Yes!", "no", "So it is. ", "x" * 3000 + "."]
    rows = []
    for conv in range(count):
        for turn in range(int(rng.integers(1, 12)) if conv else 400):
            role = str(rng.choice(["user", "assistant", "system", "tool", "", "User"], p=[0.4, 0.35, 0.1, 0.05, 0.05, 0.05]))
            rows.append((conv, turn * int(rng.integers(1, 3)) + turn, role, str(rng.choice(texts)) + (f"{turn}." if rng.random() < 0.6 else "")))
    return list({r[:2]: r for r in rows}.values())  # no ties between different rows


def brute_digest(rows):
    """The contract row by row: damage, order, repair."""
    own: dict = {}
    for conv, turn, role, text in rows:
        own.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return {c: brute_repair(sorted(r, key=lambda x: (x[0] is not None, x[0] or 0))) if r else nothing for c, r in own.items()}


@pytest.mark.parametrize("chunk", [8, 512])
def test_repairs_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rows = conversations(chunk, 80) + [(1000, None, "user", "Hi."), (1000, 4, None, None), (None, 1, "user", "A."), (None, 2, "assistant", "B.")]
    rows += [(k, 0, "user", "Gone.") for k in range(2000, 2040)]  # some lose their only row
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as cost", "'x' as audit")
    found = repair.repair_digest(made.repartition(3, "turn")).collect()
    expected = brute_digest(rows)
    assert len(found) == len(expected)
    for row in found:
        assert tuple(row)[1:] == expected[row.conv_id], row.conv_id
    assert sum(r.audit == "" for r in found) > 0 and repair.repair_digest(made.limit(0)).count() == 0


def test_equal_rows_of_one_conversation_are_split(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 16)
    rows = [(1, 5, "user", "Same.")] * 300 + [(1, 6, "assistant", "Other.")]
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (found,) = repair.repaired(made).collect()
    assert (found.duplicate, found.cost, found.audit) == (299, 4 * 299, "K" + "D" * 299 + "K")
    assert repair.in_order(made).select("pos").distinct().count() == 301


def test_costs_of_audits_and_ranks():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 14))
        kinds, faults = rng.integers(0, 4, n), rng.integers(0, 4, n)
        paths = repair.Paths(kinds, faults, np.array([0]), np.array([n]), repair.END[None], np.array([True]))
        (audit,), _ = paths.audits(np.array([repair.START]))
        least = (repair.suffix_products(repair.row_costs(kinds, faults), np.full(n, n))[0] + repair.END).min(axis=1)
        assert repair.cost_of(audit, faults) == least[repair.START]
    letter, pointer = np.array([1, 1, 2, 0, 1]), np.array([1, 2, 3, 3, 4])  # DDI, DI, I, end, D for ever
    assert np.argsort(repair.ranks(letter[:4], pointer[:4])).tolist() == [3, 0, 1, 2]


# ---- whitening


def brute_whitening(vectors):
    x = np.floor(np.array(vectors, float) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    values, parts = np.linalg.eigh(np.cov(x.T, bias=True))
    return x, n, s, values[::-1], parts[:, ::-1].T


def test_whitening_equals_eigh(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(400, 12)) * np.linspace(0.5, 2, 12)).astype(np.float32).tolist()
    odd = [None, [None] * 12, [float("nan")] * 12, [float("inf")] * 12, [], [1.0, 2.0], [1e30] * 12]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, v) for i, v in enumerate(odd)] + [(None, vectors[0])]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as n", "2 as component").repartition(4)
    found = whitening.whiten(made).collect()
    x, n, s, values, parts = brute_whitening([*vectors, vectors[0]])
    by_id = {(r.vec_id, r.component): r for r in found}
    assert set(by_id) == {(i, c) for i in [None, *range(400)] for c in range(1, 9)} and len(found) == 401 * 8
    signs = {}
    for (i, c), r in by_id.items():
        own = x[i or 0]
        expected = (own - s / n) @ parts[c - 1] / np.sqrt(values[c - 1])
        sign = signs.setdefault(c, np.sign(expected * r.whitened))
        assert abs(expected * sign - r.whitened) < 1e-9
        assert (r.n, r.deviation) == (n, int(((n * own - s).astype(object) ** 2).sum()))
        assert abs(r.explained - values[c - 1] / values.sum()) < 1e-12 and r.identity_error < 1e-9


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(5)], schema)).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-9 for r in line)
    square = whitening.whiten(spark.createDataFrame([(k, v) for k, v in enumerate(itertools.product([0.0, 1.0], repeat=3))], schema)).collect()
    assert len(square) == 24 and square[0].identity_error < 1e-9  # one eigenvalue three times


def test_sums_of_products_are_exact(spark):
    rng = np.random.default_rng(3)
    for size in (100, 1 << 40, 1 << 61):
        x = rng.integers(-size, size, (300, 5))
        rows = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(3)
        whole = np.column_stack([x, np.ones(300, int)]).astype(object)
        assert (whitening.summed_products(rows, 5) == whole.T @ whole).all()


def test_polynomials_roots_and_null_spaces():
    rng = np.random.default_rng(4)
    for d in (1, 2, 5, 9):
        factor = rng.integers(-9, 10, (d, d))
        a = (factor @ factor.T).tolist()
        primes = charpoly.primes_below(1 << 31, charpoly.coefficient_bound(a))
        residues = np.array([np.array(a) % p for p in primes])
        poly = charpoly.combined(charpoly.polynomials_mod(residues, np.array(primes)), primes)
        assert poly[::-1] == [round(c) for c in np.poly(np.array(a, float))] or d > 5
        values = np.linalg.eigvalsh(a)[::-1]
        roots = charpoly.largest_roots(poly, d, 40)
        assert np.allclose([r / 2**40 for r, m in roots for _ in range(m)], values[: len(roots)], rtol=1e-9, atol=1e-9)
        v = charpoly.null_space(a, *roots[0], 40)
        assert np.allclose(np.array(a) @ v[0], values[0] * v[0], atol=1e-7 * values[0])
    cluster = [0, 0, -75, 55, -13, 1]  # x^2 (x - 3) (x - 5)^2
    assert charpoly.largest_roots(cluster, 3, 8) == [(5 * 256 - 1, 2), (3 * 256, 1)]
    assert [charpoly.roots_above(cluster, at) for at in (0, 2, 3, 4, 5)] == [3, 3, 2, 2, 0]
    assert charpoly.primes_below(30, 1000) == [29, 23, 19]

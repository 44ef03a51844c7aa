"""Conversation repair, hard negatives and sharding against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from airspark.llm import conversation_repair, hard_negatives, shard_tree

SPACE = " \t\n\v\f\r"
CONVERSATION = "conv_id long, turn long, role string, text string, again string, row int, n int"


# ---- conversation repair

def least_repair(rows):
    """(cost, audit, repaired rows) of rows (role, fault), from the last row back to the first."""
    step = {("S", "s"): "P", ("S", "u"): "U", ("P", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
    fits = {"S": "u", "P": "u", "U": "a", "A": "u"}
    best = {"S": (0, ""), "A": (0, "")}
    for at in range(len(rows), -1, -1):
        now = dict(best) if at == len(rows) else {}
        if at < len(rows):
            role, fault = rows[at]
            late = int(fault == "truncated")
            for s in "SPUA":
                ways = []
                if s in best:
                    ways.append((best[s][0] + 3, "D" + best[s][1]))
                if fault not in ("blank", "duplicate"):
                    if (q := step[s, fits[s]]) in best:
                        ways.append((best[q][0] + 2 + late, "R" + best[q][1]))
                    if (q := step.get((s, role[:1]))) in best:
                        ways.append((best[q][0] + late, "K" + best[q][1]))
                if ways:
                    now[s] = min(ways)
        for _ in range(4):  # insertions
            for s in "SPUA":
                q = step[s, fits[s]]
                if q in now:
                    new = (now[q][0] + 2, "I" + now[q][1])
                    if s not in now or new < now[s]:
                        now[s] = new
        best = now
    return best["S"]


def brute_repair(rows):
    """rows: (turn, role, text) of one conversation -> the operator's columns."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    sig = lambda r, x: hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
    rows.sort(key=lambda y: (y[0] is not None, y[0] or 0, sig(y[1], y[2])))
    seen, faults = set(), []
    for _, r, x in rows:
        body = x.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((r, x))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = least_repair([(r, f) for (_, r, _), f in zip(rows, faults)])
    out, at, previous = [], iter(rows), ""
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else next(at)
        if edit in "RI":
            role = "assistant" if previous == "u" else "user"
        if edit != "D":
            out.append(f"{role}:{text}")
            previous = role[:1]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def held(spark, rows, partitions=8, **more):
    df = spark.createDataFrame([(*r, "x", 7, 1) for r in rows], CONVERSATION).repartition(partitions)
    out = conversation_repair.repair(df, **more)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r)[1:] for r in out.collect()}


def test_repair_against_brute_force(spark):
    r = random.Random(5)
    texts = ["One.", "Two!", "Three?\n", "open end", "", " \t", None, "Four. ", "x", "naïve – fin.", "dot . no"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "ux", "s"]
    rows = []
    for conv in [*range(300), None]:
        for k in range(r.randint(1, 12)):
            turn = None if r.random() < 0.05 else r.choice([k, k, k, k + r.randint(-2, 9)])
            rows.append((conv, turn, r.choices(roles, [9, 9, 3, 1, 1, 1, 1, 1, 1])[0], f"{r.choice('abc')} " + t
                         if (t := r.choice(texts)) and r.random() < 0.7 else t))
    groups = defaultdict(list)
    for c, *row in rows:
        groups[c].append(tuple(row))
    got = held(spark, rows)
    assert set(got) == set(groups)
    for c, own in groups.items():
        assert got[c] == brute_repair(own), (c, own)


def test_repair_of_long_and_repeated_conversations(spark):
    """More rows than a stretch holds, across partitions; one row repeated; very long texts."""
    r = random.Random(6)
    rows = [(7, k // 2, r.choice(["user", "assistant", "assistant", "tool", "system"]), r.choice([f"t{k}.", f"t{k}", "", "same."]))
            for k in range(1500)]
    rows += [(8, 3, "user", "again.")] * 700 + [(8, 4, "assistant", "yes.")]
    rows += [(9, 0, "user", "word " * 200_000 + "."), (9, 1, "assistant", "word " * 300_000), (9, 2, "user", "word " * 200_000 + ".")]
    got = held(spark, rows, 16)
    for c in (7, 8, 9):
        assert got[c] == brute_repair([x[1:] for x in rows if x[0] == c]), c
    assert got[8][2] == 699 and got[8][6] == "K" + "D" * 699 + "K"


def test_repair_edges(spark):
    assert held(spark, []) == {}
    nothing = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    assert held(spark, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], copies=F.lit(0)) == {1: nothing}
    assert held(spark, [(1, None, "system", "Be kind."), (1, None, None, None)])[1][5:7] == (6, "DD")
    assert held(spark, [(1, 0, "assistant", "Yes.")])[1][5:7] == (2, "IK")


def test_damage(spark):
    rows = [(c, t, "assistant", "A. b! c?") for c in [*range(40), None] for t in [0, 1, None]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(x.conv_id, x.turn): x for x in conversation_repair.damage(df).collect()}
    kinds = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        kinds[kind] += 1
        x = got[c, t]
        assert x.copies == {0: 0, 3: 2}.get(kind, 1) and x.role == ("user" if kind == 4 else role)
        assert x.text == {1: "", 2: "A b c"}.get(kind, text)
    assert all(kinds[k] for k in range(5))


def test_agenda_pops_the_least_audit():
    for seed in range(300):
        r = random.Random(seed)
        code = "".join(r.choice("suaoSUAOx") for _ in range(r.randint(0, 9)))
        rows = [({"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "tool"),
                 "blank" if c == "x" else "truncated" if c.isupper() else "") for c in code]
        (found,) = conversation_repair.lightest(code, "S", conversation_repair.GOALS).values()
        assert found == least_repair(rows), code
        spans = conversation_repair.lightest(code, "S")
        assert min(spans[s] for s in "SA" if s in spans) == found


# ---- hard negatives

def brute_mine(rows, n_pos=5, n_neg=3):
    """rows: (id, vector, label), as lists."""
    good = [(i, np.floor(np.array(v, dtype=np.float64) * 256), y) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v, y) in enumerate(good):
        if i % 50:
            continue
        scores = [(-int(v @ w), j, z) for b, (j, w, z) in enumerate(good) if b != a and len(w) == len(v)]
        for p, j in sorted((s, j) for s, j, z in scores if z == y)[:n_pos]:
            fit = sorted((s, k) for s, k, z in scores if z != y and 50 * -p <= 100 * -s <= 95 * -p)[:n_neg]
            out += [(i, j, rank + 1, k, -p, -s) for rank, (s, k) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*x, "c", 3, 0.5) for x in rows],
                               "vec_id long, embedding array<float>, label int, row string, block int, n double")
    out = hard_negatives.mine(df, lambda i: i % 50 == 0, **more)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(x) for x in out.collect())


def test_mining_against_brute_force(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 20))
    rows = []
    for i in range(900):
        y = int(r.choice(6, p=[0.5, 0.1, 0.1, 0.1, 0.1, 0.1]))
        v = (centres[y] * r.uniform(0, 1) + centres[0] + r.normal(size=20) * 0.4).astype(np.float32).tolist()
        rows.append((i, v, y))
    rows += [(1000 + i, rows[i % 3][1], i % 2) for i in range(60)]  # ties and copies
    rows += [(50, rows[50][1], rows[50][2]), (100, rows[7][1], 1), (100, rows[100][1], 2)]  # a repeated row and id
    rows += [(2000 + 25 * i, [0.5] * 7, i % 2) for i in range(8)] + [(2300, [], 0), (2301, [], 0), (2302, [], 1)]
    rows += [(None, [0.1] * 20, 1), (3000, None, 1), (3050, [0.1] * 20, None), (3100, [None] * 20, 1),
             (3150, [float("nan")] * 20, 1), (3200, [float("inf")] * 20, 1), (3250, [-0.5] * 20, 3), (3300, [0.0] * 20, 9)]
    want = brute_mine(rows)
    assert len(want) > 100
    assert mined(spark, rows) == want
    assert mined(spark, rows, shard_rows=64, block_rows=4) == want
    assert mined(spark, []) == []


def test_bounds_hold_and_discard():
    r = np.random.default_rng(4)
    rows = hard_negatives.Summaries(np.floor(r.normal(size=(400, 33)) * 256 + np.repeat(r.normal(size=(400, 1)) * 500, 33, axis=1)))
    asked = hard_negatives.Summaries(np.floor(r.normal(size=(10, 33)) * 256 + 300))
    seen = []

    def keep(low, high):
        seen.append((low, high))
        return np.ones(len(low), dtype=bool)

    for q in range(10):
        exact = rows.vectors @ asked.vectors[q]
        hard_negatives.survivors(q, asked, rows, keep, np.arange(400))
        assert all((low <= exact).all() and (exact <= high).all() for low, high in seen[-5:])
        assert (np.diff([float((h - w).mean()) for w, h in seen[-5:]]) <= 1e-6).all()  # halving tightens
        left = hard_negatives.survivors(q, asked, rows, hard_negatives.best_scores(5), np.arange(400))
        assert set(np.argsort(-exact)[:5]) <= set(left.tolist()) and len(left) < 200


# ---- sharding

def test_tree_is_fair_and_moves_little(spark):
    ids = spark.range(40_000).withColumn("k", F.col("id").cast("string"))
    tree = {"a": {"x": {0: 1.0, 1: 3.0}, "y": {2: 2.0}}, "b": {"z": {3: 1.0, 4: 1.0, 5: 0.0}}}
    heavier = {"a": {"x": {0: 1.0, 1: 6.0}, "y": {2: 2.0}}, "b": {"z": {3: 1.0, 4: 1.0, 5: 0.0}}}
    df = shard_tree.descend(shard_tree.descend(ids, F.col("k"), tree, "s"), F.col("k"), heavier, "t")
    got = df.select("s", "t").toPandas()
    share = got["s"].value_counts(normalize=True)
    assert all(abs(share[s] - w / 8) < 0.01 for s, w in enumerate([1, 3, 2, 1, 1])) and 5 not in share
    moved = got[got.s != got.t]
    # Only the heavier region, rack and shard take rows: nothing goes to the other region, nor to y from x.
    assert len(moved) and not set(moved.t) & {3, 4} and not len(moved[(moved.s == 1)]) and not len(moved[moved.s.isin([0]) & moved.t.eq(2)])


def test_sharding_contract(spark):
    texts = [None, "", "a", "naïve", "long " * 100_000]
    rows = [(i, texts[i % 5], "c", 1, "s") for i in range(3000)] + [(7, "a", "c", 1, "s")] * 500 + [(None, None, None, 2, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, size string, slot int, source string").repartition(13)
    out = shard_tree.assign(df, shard_tree.tree_of(24), shard_tree.tree_of(25))
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = out.collect()
    assert Counter(x.doc_id for x in got) == Counter(x[0] for x in rows)
    want = {(x[0], len((x[1] or "").encode()) + 8, zlib.crc32((x[1] or "").encode())) for x in rows}
    assert {(x.doc_id, x.size, x.text_crc32) for x in got} == want
    slots = defaultdict(list)
    for x in got:
        slots[x.shard].append(x.slot)
        assert x.law == "key" and x.grown_shard in (x.shard, 24)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({x.shard for x in got if x.doc_id == 7}) == 1
    moved = sum(x.grown_shard == 24 for x in got if x.doc_id != 7)
    assert 0.5 * 3000 / 25 < moved < 2 * 3000 / 25
    assert shard_tree.assign(df.limit(0), shard_tree.tree_of(24)).count() == 0
    again = shard_tree.assign(df.repartition(3), shard_tree.tree_of(24), shard_tree.tree_of(25)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))  # the layout of the input does not matter


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", "s", i) for i in range(500)], "doc_id long, text string, source string, n_chars int")
    back = shard_tree.write_shards(df, f"{tmp_path}/shards", shard_tree.tree_of(5))
    assert sorted((x.doc_id, x.source, x.n_chars) for x in back.collect()) == [(i, "s", i) for i in range(500)]
    assert back.columns[-1] == "shard" and back.select("shard").distinct().count() == 5

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import hard_negatives, source_mix, turn_repair

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Conversation repair


def cheapest_by_search(symbols):
    """Least (cost, audit) by uniform-cost search over (row, state), without grammar or spans."""
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(symbols) and state in (0, 3):
            return cost, audit
        for (p, role), q in turn_repair.MOVES.items():
            if p != state:
                continue
            if role in "ua":
                heapq.heappush(heap, (cost + 3, audit + "I", at, q))
            if at < len(symbols) and symbols[at] != "d":
                more = 3 if symbols[at].isupper() else 0
                if symbols[at].lower() == role:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, q))
                if role in "ua":
                    heapq.heappush(heap, (cost + more + 3, audit + "R", at + 1, q))
        if at < len(symbols):
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state))
    raise AssertionError


def test_grammar_against_search():
    rng = random.Random(3)
    for _ in range(400):
        symbols = "".join(rng.choice("dsuaoSUAOua") for _ in range(rng.randint(1, 14)))
        cells = [turn_repair.ROW_CELLS[s] for s in symbols]
        assert turn_repair.cheapest(turn_repair.parse_rows(symbols)) == cheapest_by_search(symbols), symbols
        # Charts of two cells give what one chart over all rows gives.
        assert turn_repair.combine(cells, 2) == turn_repair.chart(cells)
    long = "".join(rng.choice("dsuaoUA") for _ in range(300))
    assert turn_repair.cheapest(turn_repair.parse_rows(long)) == cheapest_by_search(long)


def brute_repair(rows):
    """Report and repaired lines of one conversation, from (turn, role, text) without nulls but in turns."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults, symbols = set(), Counter(), ""
    for _, role, text in rows:
        last = WORD.findall(text)
        symbol = role[:1] if role[:1] in ("s", "u", "a") and role else "o"
        if not last:
            faults["blank"] += 1
            symbol = "d"
        elif (role, text) in seen:
            faults["duplicate"] += 1
            symbol = "d"
        elif last[-1][-1] not in ".!?":
            faults["truncated"] += 1
            symbol = symbol.upper()
        seen.add((role, text))
        symbols += symbol
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    cost, audit = cheapest_by_search(symbols)
    left, lines, at, k = len(audit) - audit.count("D"), [], 0, 0
    for letter in audit:
        if letter != "D":
            role = rows[at][1] if letter == "K" else ("assistant" if (left - k) % 2 else "user")
            lines.append(f"{role}:{'' if letter == 'I' else rows[at][2]}")
            k += 1
        at += letter != "I"
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest


@pytest.fixture(scope="module")
def turns():
    rng, rows = random.Random(5), []
    for conv in [*range(25), None]:
        for turn in range(rng.randint(1, 9)):
            text = rng.choice(["Hi.", "Hi.", "well then", "Oh! ", "é?\n", " \t", "", None, "no. ", f"t{turn}."])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text))
    # A long conversation that needs several blocks, ties in turns and repeated rows.
    rows += [(99, k // 3, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"c{k}!"])) for k in range(150)]
    rows += [(98, k, "user" if k % 2 == 0 else "assistant", f"x{k}.") for k in range(40)]
    return rows + rows[:5] + [(97, 0, "user", "w. " * 40_000)]


@pytest.mark.parametrize("block", [4, 256])
def test_repair_against_search(spark, turns, monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK_ROWS", block)
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in turns], "conv_id long, turn long, role string, text string, key int, place int, cost string")
    report, repaired = turn_repair.repair(df)
    digests = {r["conv_id"]: r["sha256"] for r in turn_repair.digests(repaired).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    got = {r["conv_id"]: (*r[1:], digests.get(r["conv_id"], empty)) for r in report.collect()}
    by_conv = defaultdict(list)
    for conv, turn, role, text in turns:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {conv: brute_repair(rows) for conv, rows in by_conv.items()}


def test_damage_and_empty_table(spark):
    rows = [(1, k, "assistant", "a. b! c?") for k in range(60)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = Counter()
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        want[(conv, turn, "user" if fate == 4 else role, text)] += {0: 0, 3: 2}.get(fate, 1)
    assert Counter(map(tuple, turn_repair.damage(df).collect())) == +want
    report, repaired = turn_repair.repair(df.limit(0))
    assert report.count() == repaired.count() == turn_repair.digests(repaired).count() == 0


# Mixing of sources


def brute_mix(rows, weights=(1, 2, 3)):
    """Taken words per row number, by plain sorting of each source."""
    sizes, names = [], sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = Counter()
    for _, text, source in rows:
        sizes.append(len(WORD.findall(text or "")))
        total[source] += sizes[-1]
    weight, full = {s: weights[k % len(weights)] for k, s in enumerate(names)}, set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        above = {s for s in names if s not in full and rest * weight[s] > 3 * total[s] * open_}
        if not above:
            break
        full |= above
    target = {s: float(3 * total[s]) if s in full else rest * weight[s] / open_ for s in names}
    taken = [0] * len(rows)
    for s in names:
        epochs = int(target[s] // total[s]) if total[s] else 0
        left = int(target[s]) - epochs * total[s]
        order = []
        for k, (i, text, source) in enumerate(rows):
            if source == s:
                words = WORD.findall(text or "")
                told = f"{source_mix.SEED}:{'' if i is None else i}:{text or ''}".encode()
                u = (int(hashlib.md5(told).hexdigest()[:12], 16) + 0.5) / 2**48
                w = max(len(set(words)) / len(words), 0.05) if words else 1.0
                order.append((-math.log(u) / w, i or 0, sizes[k], k))
                taken[k] = epochs * sizes[k]
        for _, _, size, k in sorted(order):
            taken[k] += min(size, left)
            left -= min(size, left)
    return Counter((i, s, size, total[s], round(target[s], 9), t) for (i, _, s), size, t in zip(rows, sizes, taken, strict=True))


@pytest.mark.parametrize("buckets", [65_536, 3])
def test_mix_against_sorting(spark, monkeypatch, buckets):
    monkeypatch.setattr(source_mix, "BUCKETS", buckets)
    rng, rows = random.Random(8), []
    for i in range(400):
        source = rng.choice(["big"] * 8 + ["a", "b", "É", None, "tiny"])
        words = " ".join(f"w{rng.randrange(30)}" for _ in range(rng.choice([0, 1, 5, 60]) if source != "tiny" else 1))
        rows.append((i, words, source))
    rows += [(None, "x y z", "big"), (None, None, "void"), (3, "other text", "big"), (900, "v " * 50_000, "a"), *rows[:4]]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, bucket int")
    got = Counter((r["doc_id"], r["source"], r["size"], r["source_size"], round(r["target"], 9), r["taken"]) for r in source_mix.mix(df).collect())
    assert got == brute_mix(rows)
    by_source = defaultdict(int)
    for (_, source, size, own, target, taken), n in got.items():
        assert 0 <= taken <= 3 * size and target <= 3 * own
        by_source[source, target] += taken * n
    assert all(taken == math.floor(target) for (_, target), taken in by_source.items())
    assert source_mix.mix(df.limit(0)).count() == 0


def test_drawn_in_proportion_to_quality(spark):
    rows = spark.range(30_000).withColumn("text", F.lit("one"))
    rows = rows.select("id", "text", F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("source"), F.when(F.col("id") % 4 < 2, 3.0).alias("quality"))
    rows = rows.withColumn("quality", F.when(F.col("quality").isNull(), 1.0).otherwise(F.col("quality")))
    # Sources x and y are equal and weigh 1 and 2, so x gives two thirds of its words.
    got = source_mix.mix(rows, "id", "text", "source", "quality").join(rows.select("id", "quality"), "id").where("source = 'x'")
    share = {r["quality"]: r["s"] for r in got.groupBy("quality").agg(F.avg("taken").alias("s")).collect()}
    # With t the key at which the rest ends, 1 - exp(-3t) and 1 - exp(-t) average to 2/3.
    t = next(k / 1000 for k in range(1, 10_000) if 2 - math.exp(-3 * k / 1000) - math.exp(-k / 1000) >= 4 / 3)
    assert share[3.0] == pytest.approx(1 - math.exp(-3 * t), abs=0.02) and share[1.0] == pytest.approx(1 - math.exp(-t), abs=0.02)


# Hard negatives


def brute_negatives(rows, every=100):
    rows = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows if None not in (i, y, v) and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, y, v + [0] * (width - len(v))) for i, y, v in rows]
    anchors = {}
    for i, y, v in rows:
        if i % every == 0:
            anchors[i] = min((y, v), anchors.get(i, (y, v)))
    out = Counter()
    for i, (y, v) in anchors.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, z, w in rows)
        for down, p, _ in [s for s in scored if s[2] == y and s[1] != i][:5]:
            fit = [s for s in scored if s[2] != y and 80 * -down <= 100 * -s[0] <= 100 * -down][:5]
            out.update((i, p, rank + 1, j, -down, -s) for rank, (s, j, _) in enumerate(fit))
    return out


@pytest.mark.parametrize("block", [3, 2048])
def test_negatives_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(900):
        v = centres[i % 6] + rng.normal(size=8) * (0.2 if i % 3 else 0.0)  # every third row repeats its centre: ties
        rows.append((i, int(rng.integers(4)), [float(x) for x in v]))
    rows += [(901, None, rows[0][2]), (902, 1, None), (903, 1, [None, 1.0]), (904, 1, [float("nan")] * 8), (905, 2, [float("inf")] * 8), (None, 1, rows[1][2])]
    rows += [(906, 1, [1.0, -2.0]), (907, 2, []), rows[7], (200, 3, rows[3][2]), (100, rows[100][1], rows[100][2])]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "vec_id long, label int, embedding array<double>, rank int, v string")
    got = Counter(map(tuple, hard_negatives.hard_negatives(df).collect()))
    assert got == brute_negatives(rows) and len(got) > 50
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


def test_tree_bounds_spare_scores():
    rng = np.random.default_rng(2)
    centres = rng.integers(-300, 300, size=(20, 16))
    anchors = np.repeat(centres, 10, axis=0) + rng.integers(-2, 3, size=(200, 16))
    rows = centres[rng.integers(20, size=5000)] + rng.integers(-20, 21, size=(5000, 16))
    tree = hard_negatives.spanning_tree(np.arange(200), np.zeros(200, dtype=np.int64), anchors)
    assert (tree.parent < np.arange(200)).all() and (tree.parent >= 0).sum() == 199
    low = [np.array([np.sort(rows @ a)[-40]]) for a in tree.vectors]
    goal = hard_negatives.Goal(False, low, [np.array([np.inf])] * 200, 5)
    best = hard_negatives.Best(goal)
    computed = hard_negatives.search(tree, goal, best, np.arange(5000), np.ones(5000, dtype=np.int64), rows)
    for a, found in zip(tree.vectors, best.rows, strict=True):
        assert found[0] == sorted((-int(s), i) for i, s in enumerate(rows @ a))[:5]
    assert computed < 0.4 * 200 * 5000

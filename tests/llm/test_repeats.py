import random
import re
from itertools import combinations

import pyarrow as pa
import pytest

from quern.llm import decontaminate, graph, jaccard_join, slices, substring_dedup, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = "doc_id long, text string, key string, words int, _doc int, a int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, 2, 3) for i, t in rows], CLASH)


def sentence(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def copies():
    """Texts with near copies, shared passages, tiny texts, ties, nulls and repeated rows."""
    rng = random.Random(11)
    rows, shared = [], sentence(rng, 60)
    for i in range(40):
        base = sentence(rng, rng.randint(1, 120))
        if i % 3 == 0:
            at = rng.randint(0, len(base))
            base[at:at] = shared[: rng.randint(30, 60)]
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            other = list(base)
            for _ in range(rng.randint(0, 6)):
                other[rng.randrange(len(other))] = rng.choice(["W1", "w1", "é", "x"])
            rows.append(" ".join(other).upper() if rng.random() < 0.2 else "\n".join(other))
    rows += [None, "", "  \t", "one", "One", "one two", "one  two", "one two three"] + [" ".join(f"n{k}" for k in range(10)), " ".join(f"n{k}" for k in range(12))]
    rows.append(" ".join(sentence(rng, 6000, 9)))
    return [(i, t) for i, t in enumerate(rows)]


def brute_components(rows, percent, shingle):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(UPPER))
        sets[i] = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize(("percent", "shingle", "block"), [(90, 3, 1000), (80, 5, 1000), (80, 3, 2), (60, 1, 3)])
def test_components_against_brute_force(spark, copies, monkeypatch, percent, shingle, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0 if block == 2 else 1000)
    got = jaccard_join.near_duplicates(frame(spark, copies), percent, shingle).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(copies, percent, shingle)


def test_components_of_null_and_repeated_keys(spark):
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "x y z"), (9, None)]
    got = jaccard_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(
        map(str, [(None, 2, 7), (7, 2, 7), (7, 2, 7), (None, 1, None), (9, 0, 9)])
    )
    assert jaccard_join.near_duplicates(frame(spark, [])).count() == 0


def test_signature_tree_finds_the_components_of_all_pairs():
    import numpy as np

    rng = np.random.default_rng(4)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 1 << 62, rng.integers(1, 90)).astype(np.uint64)
        for _ in range(rng.integers(1, 9)):
            keep = rng.random(len(base)) < 0.93
            keep[0] = True
            sets.append(np.unique(np.concatenate((base[keep], rng.integers(0, 1 << 62, rng.integers(0, 4)).astype(np.uint64)))))
    similar = lambda s, t: 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))

    def components(links, n):
        label = list(range(n))
        for _ in range(n):
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        return label

    n, half = len(sets), len(sets) // 2
    want = [(a, b) for a, b in combinations(range(n), 2) if similar(sets[a], sets[b])]
    assert components(jaccard_join.similar_links(jaccard_join.SignatureTree(sets), None, 80), n) == components(want, n)
    across = [(a, b) for a, b in want if a < half <= b]
    links = jaccard_join.similar_links(jaccard_join.SignatureTree(sets[:half]), jaccard_join.SignatureTree(sets[half:]), 80)
    assert components(links, n) == components(across, n)


def brute_links(rows, percent, shingle):
    """For each row number the number of other rows whose sets are similar."""
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(UPPER))
        sets.append({tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set()))
    alike = lambda s, t: bool(s) and bool(t) and 100 * len(s & t) >= percent * len(s | t)
    return [sum(alike(s, t) for j, t in enumerate(sets) if i != j) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("percent", "shingle", "block", "frequent"), [(90, 3, 1000, 3), (80, 5, 2, 3), (60, 1, 3, 1)])
def test_links_against_brute_force(spark, copies, monkeypatch, percent, shingle, block, frequent):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard_join, "FREQUENT_TEXTS", frequent)
    monkeypatch.setattr(jaccard_join, "FREQUENT_SAMPLE", 1)
    rows = copies + [(5, copies[9][1]), (5, copies[9][1]), (5, copies[20][1]), (None, copies[9][1]), (None, "only here, three"), (None, "only here, three")]
    got = jaccard_join.near_duplicates(frame(spark, rows), percent, shingle, links=True).collect()
    counts = brute_links(rows, percent, shingle)
    # One name per component: of keys that are repeated each text has its own.
    assert sorted((str(r["doc_id"]), r["n_links"]) for r in got) == sorted((str(i), n) for (i, _), n in zip(rows, counts, strict=True))


def test_repeated_keys_are_told_apart_by_their_texts(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, a), (5, a), (5, b), (9, b + " end"), (9, b + " end"), (2, None), (2, None), (3, ""), (None, a + " x"), (7, "alone here")]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_join.near_duplicates(frame(spark, rows), 80, 5).collect()}
    assert got == {(1, 1), (5, 1), (5, 5), (9, 5), (2, 2), (3, 3), (None, 1), (7, 7)}
    left = jaccard_join.drop_near_duplicates(frame(spark, rows), 80, 5)
    assert left.columns == frame(spark, rows).columns
    kept = [(1, a), (5, b), (2, None), (2, None), (3, ""), (7, "alone here")]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(map(str, kept))
    twice = [(9, b), (9, b), (9, b), (None, a), (None, a)]
    left = jaccard_join.drop_near_duplicates(frame(spark, twice), 80, 5).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in left))) == sorted(map(str, [(9, b), (None, a)]))
    assert jaccard_join.drop_near_duplicates(frame(spark, [])).count() == 0


def test_connected_handles_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    got = {r["node"]: r["root"] for r in graph.connected(spark.createDataFrame(path + star + [(5, 5)], "a long, b long")).collect()}
    assert len({got[i] for i in range(201)}) == 1 and len({got[1000 + k] for k in range(200)}) == 1
    assert got[0] != got[1000] and len(got) == 401
    assert graph.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_slices_hold_few_items_or_one_row(monkeypatch):
    monkeypatch.setattr(slices, "SLICE_ITEMS", 10)
    rng = random.Random(2)
    rows = [[rng.randrange(99) for _ in range(rng.choice([0, 1, 4, 9, 25]))] for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"w": pa.array(rows, pa.list_(pa.int64())), "i": pa.array(range(60))})
    seen = []
    for part, values, ends in slices.sliced(iter([batch, batch.slice(0, 0)]), "w"):
        assert part.num_rows == 1 or len(values) <= 10
        seen += [values[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]
    assert seen == rows


def brute_kept(rows, window):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = {}
    for r, (_, w) in enumerate(words):
        for p in range(len(w) - window + 1):
            seen.setdefault(tuple(w[p : p + window]), []).append((r, p))
    gone = {(r, p + k) for places in seen.values() if len(places) > 1 for r, p in places for k in range(window)}
    return [(i, len(w), [x for p, x in enumerate(w) if (r, p) not in gone]) for r, (i, w) in enumerate(words)]


@pytest.mark.parametrize(("window", "anchor", "places"), [(35, 8, 2_000_000), (12, 4, 0), (5, 2, 100)])
def test_kept_words_against_brute_force(spark, copies, monkeypatch, window, anchor, places):
    monkeypatch.setattr(substring_dedup, "BROADCAST_PLACES", places)
    assert slices.SLICE_ITEMS == 200_000  # the longest text here has 6,000 words, so several share a slice
    rows = copies + [(None, copies[0][1]), (3, copies[5][1]), (3, copies[5][1]), (None, "a b")]
    got = substring_dedup.kept_words(frame(spark, rows), window=window, anchor=anchor).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["kept"]) for r in got) == sorted((str(i), n, k) for i, n, k in brute_kept(rows, window))


def test_repeats_are_cut_out_of_the_texts(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, f"start here\n{passage}\nend one "), (2, f"{passage} tail"), (3, "alone  with\tspaces\n"), (4, None), (5, "")]
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert {k: r["text"] for k, r in got.items()} == {1: "start here\nend one ", 2: " tail", 3: rows[2][1], 4: None, 5: ""}
    assert got[1]["key"] == "k" and got[1]["_doc"] == 2
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def brute_hits(rows, items, size):
    grams = {}
    for item, t in items:
        w = PLAIN.findall((t or "").translate(UPPER))
        n = min(size, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[p : p + n]), set()).add("" if item is None else str(item))
    out = []
    for i, t in rows:
        w = PLAIN.findall((t or "").translate(UPPER))
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in grams:
                    hit |= set(range(p, p + n))
                    found |= grams[tuple(w[p : p + n])]
        out.append((str(i), len(w), len(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("most", [1 << 26, -1])
def test_hits_against_brute_force(spark, copies, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most)
    items = [(1, copies[0][1]), (2, "W5, w6; W7!"), (10, copies[0][1]), (3, None), (4, ""), (None, "One"), (5, copies[9][1]), (5, copies[9][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    rows = copies + [(None, copies[0][1]), (0, copies[0][1]), (0, "Ünïcode, W5 w6-w7 ONE")]
    got = decontaminate.find_hits(frame(spark, rows), bench).withColumn("n", decontaminate.words_hit(decontaminate.F.col("hits"))).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n"], r["items"]) for r in got) == brute_hits(rows, items, 10)


def test_decontaminate_drops_or_cuts(spark):
    item = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(1, f"Before. {item.upper()}! After."), (2, "clean text"), (None, None), (None, item), (2, f"x {item}")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.decontaminate(frame(spark, rows), bench)
    assert left.columns == frame(spark, rows).columns
    assert sorted(str(r["text"]) for r in left.collect()) == ["None", "clean text"]
    cut = decontaminate.decontaminate(frame(spark, rows), bench, "spans")
    assert sorted(str(r["text"]) for r in cut.collect()) == ["", "Before! After.", "None", "clean text", "x"]
    assert decontaminate.decontaminate(frame(spark, rows), bench.limit(0)).count() == len(rows)
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0
    with pytest.raises(ValueError):
        decontaminate.decontaminate(left, bench, "other")


def test_window_hashes_depend_on_the_words_alone(spark):
    """Each size from 1 to 15 asked for alone gives the hashes that it has among all sizes, one per window."""
    rng = random.Random(8)
    rows = [(i, sentence(rng, n, 3)) for i, n in enumerate([0, 1, 6, 15, 60])]
    d = spark.createDataFrame(rows, "i long, w array<string>")
    d = words.with_window_hashes(d, "w", {f"all{k}": k for k in range(1, 16)})
    for k in range(1, 16):
        d = words.with_window_hashes(d, "w", {f"one{k}": k})
    for r in d.collect():
        for k in range(1, 16):
            windows = [tuple(r["w"][p : p + k]) for p in range(len(r["w"]) - k + 1)]
            assert r[f"one{k}"] == r[f"all{k}"], k
            assert len(set(zip(windows, r[f"one{k}"]))) == len(set(windows)) == len(set(r[f"one{k}"])), k


@pytest.mark.parametrize("n, size", [(k, max(k, 10)) for k in range(1, 16)])
def test_only_item_size_against_brute_force(spark, n, size):
    rng = random.Random(n)
    rows = [(i, " ".join(sentence(rng, 40))) for i in range(4)]
    items = [(1, " ".join(rows[3][1].split()[20 : 20 + n])), (2, " ".join(f"none{k}" for k in range(n)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_hits(frame(spark, rows), bench, size=size).withColumn("n", decontaminate.words_hit(decontaminate.F.col("hits"))).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n"], r["items"]) for r in got) == brute_hits(rows, items, size)

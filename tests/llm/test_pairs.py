"""Joins between texts against brute force: near duplicates, benchmark leaks, repeated passages."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from corpora import CLASHING, ODD, documents, prose

from mercato.llm import decontaminate, graph, jaccard, passages
from mercato.llm.vectors import Texts


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def edited(text, seed, n):
    draw = random.Random(seed)
    w = text.split()
    for _ in range(n):
        w[draw.randrange(len(w))] = f"e{draw.randrange(10**6)}"
    return " ".join(w)


def linked(rows):
    """Component of each row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        keys = [k for k in (least.get(find(i)), key) if k is not None]
        least[find(i)] = min(keys, default=None)
    return sorted(((key, len(sets[i]), least[find(i)] if sets[i] else key) for i, (key, _) in enumerate(rows)), key=str)


# --- words and shingles -----------------------------------------------------------

def test_words_of_a_batch(monkeypatch):
    from mercato.llm import vectors

    monkeypatch.setattr(vectors, "_PIECE", 64)
    monkeypatch.setattr(vectors, "_KEPT", {})
    draw = random.Random(1)
    texts = ["".join(draw.choice(["a", "B", " ", "\n", "é", "\x0b", "\U0001f600", "x" * 90]) for _ in range(draw.randrange(60))) for _ in range(300)] + [None, ""]
    found = Texts(pa.array(texts)).words()
    flat = [w for t in texts for w in words(t)]
    assert len(found) == len(flat) and np.diff(found.first).tolist() == [len(words(t)) for t in texts]
    by = {}
    for w, h in zip(flat, found.hash.tolist(), strict=True):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)
    hashes, rows = found.shingles(5)
    assert [len(set(hashes[rows == i].tolist())) for i in range(len(texts))] == [len(shingles(t)) for t in texts]


# --- near duplicates ----------------------------------------------------------------

def corpus():
    base, rows = prose(1, 120), []
    rows += [(i, edited(base, i, i % 9)) for i in range(60)]
    rows += [(100 + i, prose(50 + i, 40) + " " + prose(2, 30)) for i in range(30)]  # a shared passage, no link
    rows += [(200 + i, edited(prose(3, 700), i, 30 + 3 * i)) for i in range(12)]
    rows += [(300, "a b"), (301, "A  b"), (302, "a b c"), (303, None), (304, ""), (305, " \n"), (306, "a b c d e"), (307, "a b c d e f")]
    rows += [(None, base), (None, None), (None, "only without a key here"), (5, base), (5, base), (400, prose(4, 20000)), (401, edited(prose(4, 20000), 9, 300))]
    return rows


def test_components_equal_brute_force(llm, monkeypatch):
    rows = corpus()
    frame = documents(llm, rows).repartition(6)
    found = sorted(map(tuple, jaccard.link_documents(frame).collect()), key=str)
    assert found == linked(rows)
    monkeypatch.setattr(jaccard, "TILE", 8)  # blocks in many tiles, and no star to help the tree
    monkeypatch.setattr(jaccard.JaccardJoin, "stars", lambda self, blocks, points: blocks.limit(0).selectExpr("class AS a", "class AS b"))
    assert sorted(map(tuple, jaccard.link_documents(frame).collect()), key=str) == found


def test_one_row_of_each_component_stays(llm):
    rows = corpus()
    kept = jaccard.keep_one(documents(llm, rows))
    assert kept.columns == ["doc_id", "text", "lang", "n_chars", *CLASHING]
    expected = linked(rows)
    whole = [c for _, n, c in expected if n]
    got = kept.collect()
    with_words = [r for r in got if shingles(r.text)]
    assert len(with_words) == len(set(whole)) and {r.doc_id for r in with_words} == set(whole)
    assert len(got) - len(with_words) == sum(1 for _, t in rows if not shingles(t))


def test_tree_keeps_every_pair_that_can_reach_the_overlap():
    draw = np.random.default_rng(2)
    for groups in (1, 4, 64):
        base = draw.integers(0, 9, groups)
        points = np.maximum(base + draw.integers(-2, 3, (150, groups)), 0)
        sizes = points.sum(axis=1)
        parts = draw.integers(0, 40, 150)
        i, j = jaccard._tree_pairs(points, sizes, parts, np.zeros(150, np.int64), True)
        got = {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist(), strict=True)}
        expected = set()
        for a in range(150):
            for b in range(a):
                need = jaccard.needed_overlap(int(sizes[a]), int(sizes[b]))
                fits = np.minimum(points[a], points[b]).sum() >= need and 100 * min(sizes[a], sizes[b]) >= 75 * max(sizes[a], sizes[b])
                if fits and parts[a] != parts[b]:
                    expected.add((b, a))
        assert got == expected


def test_packed_vectors_round_trip():
    draw = np.random.default_rng(7)
    for n in (0, 1, 5, 300, 20000):
        hashes = np.sort(draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        groups = (hashes >> np.uint64(64 - jaccard.FINE_BITS)).astype(np.int64)
        found = jaccard.unpacked(pa.scalar(jaccard.packed(hashes), pa.binary()))
        assert found.tolist() == groups.tolist()
        numbered = jaccard._numbered(found)
        assert len(set(numbered.tolist())) == n and (np.diff(numbered) > 0).all()


def test_near_duplicates_of_odd_rows(odd, nothing):
    found = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.link_documents(odd).collect()}
    assert found[(4, 76)] == 4 and found[(None, 76)] == 4 and found[(1, 0)] == 1 and found[(6, 1)] == 6
    assert jaccard.link_documents(nothing).count() == 0 and jaccard.keep_one(nothing).count() == 0


def test_components_of_long_paths(llm):
    draw = random.Random(3)
    chain = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(50)]
    draw.shuffle(chain)
    found = dict(map(tuple, graph.components(llm.createDataFrame(chain, "a long, b long")).collect()))
    assert all(found[i] == 0 for i in range(201)) and all(found[1000 + i] == 1000 for i in range(50)) and len(found) == 251
    assert graph.components(llm.createDataFrame([], "a long, b long")).count() == 0


# --- benchmark ------------------------------------------------------------------------

def leak_similarity(window, item):
    def weights(w):
        return {tuple(w[i : i + 5]): min(255, sum(map(len, w[i : i + 5]))) for i in range(len(w) - 4)}

    a, b = weights(window), weights(item)
    common = sum(v for k, v in a.items() if k in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


def test_leaks_equal_brute_force(llm):
    items = [(i, prose(500 + i, 20 + 3 * i)) for i in range(12)] + [(12, "too short here"), (13, None), (14, prose(500, 20)), (None, prose(600, 30))]
    draw = random.Random(4)
    rows = [(i, prose(700 + i, 90)) for i in range(30)]
    for i in range(60):
        item = items[i % 12][1]
        w = prose(800 + i, 60).split()
        at = draw.choice([0, 60, draw.randrange(60)])
        rows.append((100 + i, " ".join(w[:at]) + " " + edited(item, i, i % 5).upper() + ", " + " ".join(w[at:])))
    rows += [(None, prose(600, 30)), (300, prose(600, 30)), (300, prose(600, 30)), (301, None), (302, ""), (303, prose(5, 20000) + " " + prose(505, 35))]
    frame, benchmark = documents(llm, rows), llm.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, text_key string")
    plain = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    expected = {}
    for key, text in rows:
        w = plain(text)
        for item, passage in items:
            own = plain(passage)
            if len(own) >= 5 and text:
                best = max((leak_similarity(w[max(s, 0) : s + len(own)], own) for s in range(-len(own), len(w))), default=0)
                if best >= 0.75:
                    expected[(text, item)] = best
    from pyspark.sql import functions as F

    from mercato.llm.tables import text_key

    leaks = decontaminate.find_leaks(frame, benchmark)
    found = {(r.text, r.item): r.similarity for r in frame.select("text").distinct().withColumn("text_key", text_key(F.col("text"))).join(leaks, "text_key").collect()}
    assert found.keys() == expected.keys() and len(found) > 20
    kept = decontaminate.decontaminate(frame, benchmark)
    leaked = {t for t, _ in expected}
    assert kept.columns == frame.columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(str(r) for r in rows if r[1] not in leaked)


def test_leak_in_a_window_that_no_shingle_lines_up(llm):
    """Words put into the middle of an item: windows at its start or end lose long words at the other end."""
    item = [("x" * 30 if 5 <= i < 10 or 90 <= i < 95 else "w") + str(i) for i in range(100)]
    text = [*[f"p{i}" for i in range(30)], *item[:50], *[f"n{i}" for i in range(8)], *item[50:], *[f"q{i}" for i in range(30)]]
    best = max(leak_similarity(text[s : s + 100], item) for s in range(len(text) - 100))
    assert leak_similarity(text[30:130], item) < 0.75 and leak_similarity(text[38:138], item) < 0.75 <= best
    frame = llm.createDataFrame([(1, " ".join(text)), (2, prose(4, 200))], "doc_id long, text string")
    benchmark = llm.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert [(r.item, r.similarity) for r in decontaminate.find_leaks(frame, benchmark).collect()] == [(7, best)]
    assert [r.doc_id for r in decontaminate.decontaminate(frame, benchmark).collect()] == [2]


def test_every_fingerprint_within_the_radius_is_met(llm):
    from pyspark.sql import functions as F

    draw = random.Random(5)
    rows = []
    for i in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randrange(decontaminate.RADIUS + 1)):
            b ^= 1 << bit
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        rows.append((i, signed(a), signed(b)))
    frame = llm.createDataFrame(rows, "i int, a long, b long")
    left = frame.select("i", F.explode(decontaminate.block_values(F.col("a"), 2)).alias("v"))
    right = frame.select("i", F.explode(decontaminate.block_values(F.col("b"), 1)).alias("v"))
    assert left.join(right, ["i", "v"]).select("i").distinct().count() == 300


def test_leak_beyond_the_radius_is_found(llm):
    from pyspark.sql import functions as F

    short = [f"w{i:03d}" for i in range(39)]
    item, window = [*short, "a" * 60], [*short, "b" * 60]
    prints = llm.createDataFrame([(item, window)], "a array<string>, b array<string>").select(
        F.bit_count(decontaminate.simhash(F.col("a")).bitwiseXOR(decontaminate.simhash(F.col("b")))).alias("bits")
    )
    assert prints.first().bits > decontaminate.RADIUS and leak_similarity(window, item) >= 0.75
    frame = llm.createDataFrame([(1, f"{prose(1, 50)} {' '.join(window)} {prose(2, 50)}"), (2, prose(3, 90))], "doc_id long, text string")
    benchmark = llm.createDataFrame([(None, " ".join(item))], "item_id long, text string")
    assert [r.similarity for r in decontaminate.find_leaks(frame, benchmark).collect()] == [leak_similarity(window, item)]
    assert [r.doc_id for r in decontaminate.decontaminate(frame, benchmark).collect()] == [2]


def test_leaks_of_odd_rows(llm, odd, nothing):
    benchmark = llm.createDataFrame([(1, prose(3, 60))], "item_id long, text string")
    assert [r.doc_id for r in odd.join(decontaminate.decontaminate(odd, benchmark).select("doc_id"), "doc_id", "left_anti").collect() if r.doc_id] == [9]
    assert decontaminate.decontaminate(nothing, benchmark).count() == 0
    assert decontaminate.decontaminate(odd, benchmark.limit(0)).count() == len(ODD)


# --- passages ----------------------------------------------------------------------------

def test_chain_is_the_best_one():
    # Two segments in order beat one out of order; the gap costs less than it gains.
    chains = passages.chain([(0, 0, 30), (40, 41, 30), (10, 300, 12)])
    assert chains[0] == [(0, 0, 30), (40, 41, 30)] and chains[1] == [(10, 300, 12)]
    assert passages.chain([(0, 0, 10), (200, 200, 10)]) == [[(0, 0, 10)], [(200, 200, 10)]]  # too far apart
    tree = passages.Fenwick(8)
    for place, value in [(3, 5.0), (1, 7.0), (6, 9.0)]:
        tree.put(place, value, place)
    assert [tree.get(n)[1] for n in (1, 2, 4, 6, 7)] == [-1, 1, 1, 1, 6]


def test_chain_skips_what_is_too_far_behind():
    far, near = (0, 0, 500), [(570, 570, 17), (590, 591, 17), (610, 612, 17)]
    assert sorted(passages.chain([far, *near])) == [[far], near]


def test_best_chain_equals_brute_force():
    draw = random.Random(8)
    for _ in range(300):
        parts = sorted({(draw.randrange(300), draw.randrange(300), draw.choice([8, 9, 17, 60])) for _ in range(draw.randrange(2, 25))})
        score = []
        for x, y, n in parts:
            gains = [0.0]
            for (u, v, m), own in zip(parts, score, strict=False):
                if -4 <= (a := x - u - m) <= 64 and -4 <= (b := y - v - m) <= 64:
                    gains.append(min(own - (a + b) / 2, own))
            score.append(n + max(gains))
        links = passages.chain(parts)[0]
        total = 0.0
        for before, (x, y, n) in zip([None, *links], links, strict=False):
            gap = 0 if before is None else max(x + y - sum(before[:2]) - 2 * before[2], 0) / 2
            total += n - gap
        assert total == max(score)


def test_alignment_extends_and_fills_gaps():
    draw = np.random.default_rng(6)
    common = draw.integers(0, 1 << 30, 80).astype(np.uint32)
    left = np.concatenate((draw.integers(0, 1 << 30, 20).astype(np.uint32), common, draw.integers(0, 1 << 30, 20).astype(np.uint32)))
    right = np.concatenate((common[:40], draw.integers(0, 1 << 30, 3).astype(np.uint32), common[40:]))
    x0, x1, y0, y1, equal, columns = passages.align(left, right, [(25, 5, 20), (62, 45, 20)])
    assert (x0, x1, y0, y1) == (20, 100, 0, 83) and equal == 80 and columns == 83


@pytest.fixture(scope="module")
def repeated():
    shared, long = prose(900, 55), prose(901, 120)
    rows = [(i, prose(1000 + i, 150)) for i in range(40)]  # clean
    for i in range(25):
        w = prose(2000 + i, 100).split()
        at = random.Random(i).choice([0, 100, 37])
        rows.append((100 + i, " ".join(w[:at] + shared.split() + w[at:])))
    rows += [(200 + i, prose(3000 + i, 60) + " " + edited(long, i, 4)) for i in range(5)]
    rows += [(300, prose(4000, 70)), (301, prose(4000, 70).upper()), (302, prose(4000, 40)), (303, prose(4001, 49)), (304, prose(4001, 49))]
    rows += [(None, prose(4002, 60)), (305, prose(4002, 60)), (306, None), (307, ""), (308, prose(5000, 20000) + " " + shared)]
    return rows


def test_passages_of_fifty_words_are_found(llm, repeated):
    frame = documents(llm, repeated).repartition(5)
    found = passages.find_passages(frame).collect()
    keys = {r.doc_id for r in found}
    runs = {}
    for key, text in repeated:
        w = words(text)
        for i in range(len(w) - 49):
            runs.setdefault(tuple(w[i : i + 50]), set()).add(key)
    exact = {k for v in runs.values() if len(v) > 1 for k in v}
    assert exact <= keys and {200 + i for i in range(5)} <= keys
    assert not keys & {*range(40), 302, 303, 304, 306, 307}
    for r in found:
        if 100 <= (r.doc_id or 0) < 125:
            w = words(dict(repeated)[r.doc_id])[r.start_word : r.end_word]
            assert " ".join(words(prose(900, 55))) in " ".join(w) and r.end_word - r.start_word <= 60


def test_exact_passages_whose_parts_are_common(llm):
    # Each pair shares 60 words in full; many others hold only the first or the last 30 of them.
    rows, pairs = [], {}
    for g in range(6):
        w = prose(6000 + g, 60).split()
        for j in range(2):
            key = 1000 + 2 * g + j
            rows.append((key, f"{prose(6100 + key, 70)} {' '.join(w)} {prose(6200 + key, 70)}"))
            pairs[key] = 70
        for j in range(40):
            part = w[:30] if j % 2 else w[30:]
            rows.append((2000 + 100 * g + j, f"{prose(9000 + 100 * g + j, 60)} {' '.join(part)} {prose(8000 + 100 * g + j, 60)}"))
    found = passages.find_passages(llm.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(pairs)
    assert all(r.start_word <= 70 and r.end_word >= 130 and r.other == r.doc_id ^ 1 for r in found)


def worn(words_, share, draw):
    """The words with exactly that share of them replaced, at random places."""
    out = list(words_)
    for i in draw.sample(range(len(out)), round(share * len(out))):
        out[i] = f"e{draw.randrange(10**9)}"
    return out


def test_tiers_hold_the_equal_runs_of_every_stretch():
    for c in range(50, 100):
        tier = next(t for t in passages.TIERS if c <= t[0])
        assert c - 3 * (c // 4) - 2 >= tier[1]


def test_edited_passages_of_one_pair_are_found(llm):
    draw = random.Random(77)
    vocabulary = [f"v{i}" for i in range(20000)]
    rows, pairs = [], set()
    for length in (60, 100):
        for share in (0.05, 0.1, 0.15, 0.2, 0.25):
            for _ in range(20):
                key, common = len(rows), draw.choices(vocabulary, k=length)
                for j, part in enumerate((common, worn(common, share, draw))):
                    rows.append((key + j, " ".join(draw.choices(vocabulary, k=80) + part + draw.choices(vocabulary, k=80))))
                pairs.add((key, key + 1))
    found = passages.find_passages(llm.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {(r.doc_id & ~1, r.doc_id | 1) for r in found} == pairs
    assert all(r.other == r.doc_id ^ 1 and r.start_word < 140 and r.end_word > 80 for r in found)


def test_a_worn_passage_links_all_its_holders(llm):
    # Every holder has lost other words, so no first holder of a seed stands for the others.
    draw = random.Random(5)
    common = prose(7700, 80).split()
    rows = [(i, " ".join([*prose(7800 + i, 60).split(), *worn(common, 0.1, draw), *prose(7900 + i, 60).split()])) for i in range(30)]
    found = passages.find_passages(llm.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r.doc_id, r.n_links, r.other) for r in found} == {(i, 29, 0 if i else 1) for i in range(30)}


def test_pairs_miss_no_stretch_of_a_small_vocabulary(llm):
    # Few words, so that most runs are frequent: the thresholds decide what is compared.
    draw = random.Random(3)
    vocabulary = [f"v{i}" for i in range(30)]
    rows = []
    for i in range(60):
        common = draw.choices(vocabulary, k=52)
        for j in range(2):
            part = worn(common, 0.24, draw) if j else common
            part = [w if w[0] == "v" else draw.choice(vocabulary) for w in part]
            rows.append((2 * i + j, draw.choices(vocabulary, k=draw.randrange(5, 60)) + part + draw.choices(vocabulary, k=draw.randrange(60))))
    links = set()
    for a, left in rows:
        for b, right in rows:
            for shift in range(50 - len(right), len(left) - 49) if a < b else ():
                x = max(shift, 0)
                same = [u == v for u, v in zip(left[x:], right[x - shift :], strict=False)]
                if any(4 * sum(same[i : i + 50]) >= 150 for i in range(len(same) - 49)):
                    links.add((a, b))
                    break
    frame = llm.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id long, text string").repartition(3)
    pairs, _ = passages.class_passages(frame.select("text"))
    ids = {r["class"]: r.id for r in frame.selectExpr("doc_id AS id", "text").mapInArrow(passages._members, "id long, n long, class long").collect()}
    assert len(links) >= 50
    assert links <= {tuple(sorted((ids[r.a], ids[r.b]))) for r in pairs.collect()}


def test_frequent_runs_miss_no_stretch(llm):
    # Every run of a few texts counts as frequent here, so runs join with a run of two words near them.
    draw = random.Random(13)
    vocabulary = [f"v{i}" for i in range(25)]
    rows = []
    for i in range(60):
        common = draw.choices(vocabulary, k=52)
        for j in range(2):
            part = worn(common, 0.24, draw) if j else common
            part = [w if w[0] == "v" else draw.choice(vocabulary) for w in part]
            rows.append((2 * i + j, draw.choices(vocabulary, k=draw.randrange(5, 60)) + part + draw.choices(vocabulary, k=draw.randrange(60))))
    frame = llm.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id long, text string").repartition(3)
    ids = {r["class"]: r.id for r in frame.selectExpr("doc_id AS id", "text").mapInArrow(passages._members, "id long, n long, class long").collect()}
    found = {tuple(sorted((ids[r.a], ids[r.b]))) for r in passages.class_passages(frame.select("text"), wide=0)[0].collect()}
    usual = {tuple(sorted((ids[r.a], ids[r.b]))) for r in passages.class_passages(frame.select("text"), wide=255)[0].collect()}
    assert {(2 * i, 2 * i + 1) for i in range(60)} <= found == usual


def test_holders_of_a_common_line_are_no_candidates(llm):
    # The line has as many equal runs as the worst passage; only what stands around it tells.
    line = prose(8900, 13)
    rows = [(i, f"{prose(40000 + i, 60)} {line} {prose(50000 + i, 60)}") for i in range(200)]
    left, right = prose(8901, 30).split(), prose(8902, 30).split()
    draw = random.Random(2)
    rows += [(300 + j, " ".join([*prose(60000 + j, 40).split(), *worn(left, 0.2 * j, draw), *line.split(), *worn(right, 0.2 * j, draw), *prose(61000 + j, 40).split()])) for j in range(2)]
    frame = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert passages.candidates(frame.select("text"), wide=48).filter("NOT group").count() < 200
    assert {(r.doc_id, r.other) for r in passages.find_passages(frame).collect()} == {(300, 301), (301, 300)}


def test_tiers_hold_the_equal_runs_of_two_of_every_stretch():
    for c in range(50, 100):
        tier = next(t for t in passages.TWO_TIERS if c <= t[0])
        assert c - 2 * (c // 4) - 1 >= tier[1] >= passages.EQUAL_TWOS


def test_common_runs_link_their_holders_without_pairs(llm):
    common = prose(8800, 70)
    rows = [(i, f"{prose(20000 + i, 60)} {common} {prose(30000 + i, 60)}") for i in range(150)]
    frame = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    pairs, groups = passages.class_passages(frame.select("text"))
    assert pairs.count() == 0 and groups.select("class").distinct().count() == 150
    found = passages.find_passages(frame).collect()
    assert {(r.doc_id, r.n_links, r.other) for r in found} == {(i, 149, 0 if i else 1) for i in range(150)}
    assert all(r.start_word <= 60 and r.end_word >= 130 for r in found)


def test_words_that_repeat_over_and_over(monkeypatch):
    left, right = np.zeros(3000, np.uint32), np.concatenate((np.arange(1, 900, dtype=np.uint32), np.zeros(2000, np.uint32)))
    spans = passages.pair_passages(left, right)
    assert spans and all(x1 - x0 >= 50 and y0 >= 850 for x0, x1, y0, _, _ in spans)


def plain_gap(left, right):
    cost = {(i, j): i + j for i in range(len(left) + 1) for j in range(len(right) + 1) if not i or not j}
    for i in range(1, len(left) + 1):
        for j in range(1, len(right) + 1):
            cost[i, j] = min(cost[i - 1, j - 1] + (left[i - 1] != right[j - 1]), cost[i - 1, j] + 1, cost[i, j - 1] + 1)
    out, i, j = [], len(left), len(right)
    while i or j:
        if i and j and cost[i, j] == cost[i - 1, j - 1] + (left[i - 1] != right[j - 1]):
            i, j = i - 1, j - 1
            out.append((1, 1, left[i] == right[j]))
        elif i and cost[i, j] == cost[i - 1, j] + 1:
            i -= 1
            out.append((1, 0, False))
        else:
            j -= 1
            out.append((0, 1, False))
    return out[::-1]


def plain_subsequence(left, right):
    best = {}
    for i in range(len(left) + 1):
        for j in range(len(right) + 1):
            best[i, j] = 0 if not i or not j else best[i - 1, j - 1] + 1 if left[i - 1] == right[j - 1] else max(best[i - 1, j], best[i, j - 1])
    return best[len(left), len(right)]


def test_gaps_and_extensions_equal_brute_force():
    draw = np.random.default_rng(12)
    for _ in range(400):
        left, right = (draw.integers(0, draw.integers(2, 9), draw.integers(0, 70)).astype(np.uint32) for _ in range(2))
        assert passages._gap(left, right) == plain_gap(left.tolist(), right.tolist())
        assert passages._edit(left, right) == plain_subsequence(left.tolist(), right.tolist())
        score = best = stop = same = equal = 0
        for at, (u, v) in enumerate(zip(left.tolist(), right.tolist(), strict=False)):
            score, same = score + (1 if u == v else -2), same + (u == v)
            if score > best:
                best, stop, equal = score, at + 1, same
            if best - score > passages.DROP:
                break
        assert passages._extension(left, right) == (stop, equal)


def compared(monkeypatch, *texts):
    """The pairs (places of texts) that get aligned when all texts meet, and their spans."""
    aligned, plain = [], passages.pair_passages
    monkeypatch.setattr(passages, "pair_passages", lambda *a: aligned.append(1) or plain(*a))
    pairs = pa.table({"a": [i for i in range(len(texts)) for _ in range(i)], "b": [j for i in range(len(texts)) for j in range(i)]})
    held = pa.table({"class": range(len(texts)), "words": pa.array([np.array(t, np.uint32).tobytes() for t in texts], pa.binary())})
    out = passages._compared(pairs, held).to_pylist()
    return len(aligned), out


def test_texts_without_the_words_of_a_passage_are_not_aligned(monkeypatch):
    # A word 40 times in one text and 30 times in the other: 38 by 28 equal runs, but no 38 equal words.
    left, right = [1] * 40 + list(range(100, 160)), list(range(200, 260)) + [1] * 30
    assert compared(monkeypatch, left, right) == (0, [])


def test_passages_with_the_fewest_equal_words_are_aligned(monkeypatch):
    # 50 words, 12 of them unequal, every fourth; and a word that comes 50 times in both texts.
    common = list(range(1, 51))
    worn_ = [w if i % 4 != 3 else 1000 + i for i, w in enumerate(common)]
    n, found = compared(monkeypatch, list(range(100, 130)) + common, worn_ + list(range(200, 240)))
    assert n == 1 and [(r["a_start"], r["a_end"], r["b_start"], r["b_end"]) for r in found] == [(0, 50, 30, 80)]
    n, found = compared(monkeypatch, [1] * 50 + list(range(100, 130)), list(range(200, 240)) + [1] * 50)
    assert n == 1 and {(r["a_start"], r["a_end"], r["b_start"], r["b_end"]) for r in found} >= {(40, 90, 0, 50)}


def test_passages_of_odd_rows(odd, nothing):
    assert {r.doc_id for r in passages.find_passages(odd).collect()} == {None, 4}
    assert passages.find_passages(nothing).count() == 0


def test_spanning_pairs_join_what_all_pairs_join():
    draw = np.random.default_rng(4)
    for n in (2, 10, 200):
        a, b = draw.integers(0, n, 5 * n), draw.integers(0, n, 5 * n)
        parts = draw.integers(0, max(2, n // 2), n) * 7 - 50
        keep = jaccard.spanning(a, b, parts)

        def groups(pairs, parts=parts):
            label = {int(p): int(p) for p in parts}
            for _ in range(len(label)):
                for x, y in pairs:
                    low = min(label[int(parts[x])], label[int(parts[y])])
                    label[int(parts[x])] = label[int(parts[y])] = low
            return label

        assert groups(list(zip(a, b, strict=True))) == groups(list(zip(a[keep], b[keep], strict=True)))
        assert keep.sum() == len(set(parts.tolist())) - len(set(groups(list(zip(a, b, strict=True))).values()))


def test_one_of_equal_rows_stays_whatever_their_order(llm):
    rows = [(1, prose(60, 80), f"v{i}") for i in range(20)]
    kept = {jaccard.keep_one(llm.createDataFrame(rows[i:] + rows[:i], "doc_id long, text string, v string").repartition(4)).first().v for i in (0, 7, 13)}
    assert len(kept) == 1

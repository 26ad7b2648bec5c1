"""Exact dedup, SimHash near-dedup, line dedup and components against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from ledgerline.llm import common, components, exact_dedup, line_dedup, simhash_dedup
from tests.llm.helpers import awkward, awkward_rows, empty, lower, words


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_equals_brute_force(spark):
    rows = awkward_rows()
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r)
    best = {n: min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0] for n, g in groups.items()}
    want = Counter((r[0], best[norm(r[1])], len(groups[norm(r[1])]), hashlib.sha256(norm(r[1]).encode()).hexdigest())
                   for r in rows)
    got = exact_dedup.exact_dedup(awkward(spark)).collect()
    assert Counter((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == {r["text_sha256"]: 1 for r in got}
    assert all(r["id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_dedup_cuts_a_hot_group_over_partitions(spark):
    rows = [(i, "same text" + " " * (i % 3)) for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert exact_dedup._sorted(df, "doc_id", "text", False).rdd.glom().map(len).max() < 2000
    out = exact_dedup.exact_dedup(df)
    assert out.where("kept").count() == 1001
    assert [tuple(r) for r in out.where("group_size > 1").select("keep_id", "group_size").distinct().collect()] == [(2, 3000)]
    assert exact_dedup.distinct_rows(df).count() == 1001


def test_distinct_rows_keep_whole_rows(spark):
    df = awkward(spark)
    out = exact_dedup.distinct_rows(df)
    assert out.columns == df.columns
    assert sorted(norm(r["text"]) for r in out.collect()) == sorted({norm(r[1]) for r in awkward_rows()})


def brute_simhash(text):
    w = words(lower(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(keys, linked):
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if linked(keys[i], keys[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(keys))]


def test_simhash_components_equal_brute_force(spark):
    rows = awkward_rows()
    fps = [brute_simhash(r[1]) for r in rows]
    comp = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {c: min((r[0] is None, r[0] or 0) for r, k in zip(rows, comp, strict=True) if k == c) for c in comp}
    want = Counter((r[0], f, None if least[c][0] else least[c][1]) for r, f, c in zip(rows, fps, comp, strict=True))
    got = simhash_dedup.near_duplicates(awkward(spark)).collect()
    assert Counter((r["id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got) == want
    kept = simhash_dedup.representatives(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert len({brute_simhash(r["text"]) for r in kept.collect()}) == len(set(comp))


@pytest.mark.parametrize("r", [3, 4, 5, 6])
def test_anchors_cover(r):
    n, rng = (1 << r) - 1, random.Random(r)
    for _ in range(50):
        x = rng.getrandbits(n)
        near = set(simhash_dedup.anchors_of(np.array([x], np.uint64), r)[0].tolist())
        assert len(near) in (1, 1 << r - 1)
        assert any((x ^ a).bit_count() <= 1 for a in near) and all((x ^ a).bit_count() <= 2 for a in near)
        assert near & set(simhash_dedup.anchors_of(np.array([x ^ 1 << rng.randrange(n)], np.uint64), r)[0].tolist())


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_fingerprint_links_miss_none(spark, bits):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for k in range(1, 6):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), k)))
    fps = sorted(np.array(sorted(fps), np.uint64).view(np.int64).tolist())
    comp = brute_components(fps, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= bits)
    links = simhash_dedup.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"), bits)
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    got = [roots.get(f, f) for f in fps]
    assert {frozenset(i for i, c in enumerate(comp) if c == k) for k in comp} == {
        frozenset(i for i, c in enumerate(got) if c == k) for k in got}


def test_links_of_a_crowded_anchor_are_complete():
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), k)) for k in range(4) for _ in range(1200)}
    fp = np.array(sorted(fps), np.uint64).view(np.int64)
    assert len(fp) > 2080  # the way by patterns
    few = simhash_dedup.links_within(fp[:300], 2)
    for part, (a, b) in ((fp, simhash_dedup.links_within(fp, 2)), (fp[:300], few)):
        u = part.view(np.uint64)
        i, j = np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 2)
        want = common.forest(part[i], part[j])
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(want[0].tolist(), want[1].tolist(), strict=True))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(400)] + [(1000, 1001)], "a long, b long").repartition(5)
    out = components.components(links).collect()
    assert len(out) == 403 and len({r["root"] for r in out if r["node"] <= 400}) == 1
    assert len({r["root"] for r in out}) == 2
    assert components.components(links.where("false")).count() == 0


def brute_edit(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in "ab")
        assert line_dedup.edit_distance(a, b) == brute_edit(a, b)


def line_table(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    lines = [" ".join(rng.choice(vocab) for _ in range(40)) for _ in range(40)]
    rows = []
    for i in range(60):
        mine = []
        for line in rng.sample(lines, 4):
            w = line.split()
            if rng.random() < .5:
                w[rng.randrange(40)] += "x"
            mine.append("  ".join(w) if rng.random() < .3 else " ".join(w).upper())
        rows.append((i, "\n".join([*mine, "", "common line"]), None))
    rows += [rows[0], (None, rows[1][1], "x"), (None, None, None), (99, "", None)]
    return rows


def test_line_dedup_equals_brute_force(spark):
    rows = line_table(spark)
    seen = defaultdict(list)
    for doc, text, _ in rows:
        key = (doc is None, doc or 0)
        for j, line in enumerate((text or "").split("\n")):
            n = " ".join(words(lower(line)))
            if n:
                seen[n].append((*key, j))
    names = list(seen)

    def linked(i, j):       # edit similarity alone
        longer = max(len(names[i]), len(names[j]))
        return abs(len(names[i]) - len(names[j])) <= .2 * longer and longer - brute_edit(names[i], names[j]) >= .8 * longer

    comp = brute_components(range(len(names)), linked)
    assert len(set(comp)) < len(names)
    first = {}
    for n, c in zip(names, comp, strict=True):
        first[c] = min([*seen[n], *([first[c]] if c in first else [])])
    top = {n: first[c] for n, c in zip(names, comp, strict=True)}
    want = Counter()
    for doc, text, _ in rows:
        kept = [line for j, line in enumerate((text or "").split("\n"))
                if not (n := " ".join(words(lower(line)))) or top[n] == (doc is None, doc or 0, j)]
        want[(doc, (text or "").count("\n") + 1, "\n".join(kept))] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, id string").selectExpr("*", "1 AS line", "2 AS node")
    got = line_dedup.dedup_lines(df.repartition(4)).collect()
    assert Counter((r["id"], r["n_lines"], r["text"]) for r in got) == want
    assert all(r["n_dropped"] == r["n_lines"] - len(r["text"].split("\n")) or not r["text"] for r in got)


def test_line_recall_against_edit_similarity(spark):
    """Lines of the documents with one character altered, added or lost are
    found, short, middle and long ones."""
    rng = random.Random(11)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    lines = sorted({" ".join(words(lower(x))) for t in texts for x in (t or "").split("\n")})
    rng.shuffle(lines)
    bins = {(4, 9): [], (10, 19): [], (20, 39): [], (40, 79): [], (80, 10 ** 6): []}
    rows = []
    for line in lines:
        for (lo, hi), some in bins.items():
            if lo <= len(line.split()) <= hi and len(some) < 60:
                at = rng.choice([i for i, c in enumerate(line) if c != " "])
                other = line[:at] + rng.choice(["q", "", line[at] + "z"]) + line[at + 1:]
                if other != line and line_dedup.similar(line, " ".join(other.split())):
                    some.append(len(rows))
                    rows.append((len(rows), line + "\n" + other))
    got = {r["id"]: r["n_dropped"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    recall = {k: sum(got[i] > 0 for i in v) / len(v) for k, v in bins.items()}
    assert min(len(v) for v in bins.values()) >= 20 and min(recall.values()) >= .9, recall


def test_empty_tables(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    assert exact_dedup.distinct_rows(empty(spark)).count() == 0
    assert simhash_dedup.near_duplicates(empty(spark)).count() == 0
    assert simhash_dedup.representatives(empty(spark)).count() == 0
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_line_dedup_of_awkward_rows(spark):
    got = line_dedup.dedup_lines(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    assert Counter(r["id"] for r in got) == Counter(r[0] for r in awkward_rows())
    # rows equal in id and text share their decisions; blank lines stay
    assert len({r["text"] for r in got if r["id"] == 0 and r["n_lines"] == 1 and "fox" in r["text"]}) <= 1
    assert all(r["text"] == (t or "") for r in got for i, t, *_ in awkward_rows()[6:9] if r["id"] == i)

"""Periodic runs, subvector clustering and the licence scan against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import license_scan, periodic_runs, queries, subvector_kmeans
from tests.llm.helpers import SCHEMA, awkward, awkward_rows, empty

# --- periodic runs ----------------------------------------------------------------


def plain_runs(x, min_length=24, min_exponent=3):
    out = []
    for q in range(1, len(x) // min_exponent + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            a = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            length = i + q - a
            if length >= max(min_length, min_exponent * q) and not any(
                    q % r == 0 and s <= a and a + length <= s + n for s, n, r in out):
                out.append((a, length, q))
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_runs_are_the_plain_ones_however_words_arrive(data):
    x = data.draw(st.lists(st.integers(0, data.draw(st.integers(0, 4))), max_size=90))
    for a, p, n in data.draw(st.lists(st.tuples(st.integers(0, 80), st.integers(1, 20), st.integers(0, 90)), max_size=3)):
        for i in range(a + p, min(a + n, len(x))):
            x[i] = x[i - p]
    setting = data.draw(st.sampled_from([(24, 3), (2, 2), (5, 2), (9, 4)]))
    want = plain_runs(x, *setting)
    assert periodic_runs.runs_of(x, *setting) == want
    catcher, at = periodic_runs.RunCatcher(*setting), 0
    while at < len(x):
        step = data.draw(st.sampled_from([1, 1, 3, 17]))
        catcher.append(np.array(x[at: at + step]))
        at += step
    assert catcher.runs() == want


def test_equal_fingerprints_of_different_words_make_no_run(monkeypatch):
    """With a base that makes all fingerprints collide only the words count."""
    same = periodic_runs._Powers()
    same.up, same.down, same.reach = np.zeros(256, np.uint64), np.ones(256, np.uint64), lambda n: None
    monkeypatch.setattr(periodic_runs, "_POWERS", same)
    x = [random.Random(4).randrange(9) for _ in range(120)] + list(range(10)) * 4
    assert periodic_runs.runs_of(x) == plain_runs(x)


def test_long_texts_of_few_words_stay_cheap():
    n = 300_000
    for x, want in ([0] * n, [(0, n, 1)]), ([i % 7 for i in range(n)], [(0, n, 7)]):
        assert periodic_runs.runs_of(x) == want
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert periodic_runs.runs_of(b) == plain_runs(b)


def plain_op11(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    keep = [True] * n
    for s, length, q in runs:
        for i in range(s + q, s + length):
            keep[i] = False
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, None if not runs else 1000 * top[1] // top[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(x for x, k in zip(w, keep) if k)))


def run_rows():
    rng = random.Random(8)
    rows = []
    for i in range(260):
        w = [rng.choice("alpha beta gamma delta eps".split()) if i % 3 else f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 150))]
        if i % 4 == 0 and len(w) > 30:
            at, p = rng.randrange(len(w) // 2), rng.randint(1, 9)
            for j in range(at + p, len(w)):
                w[j] = w[j - p]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w), "en", "s", 0))
    return rows


def _table(spark, tmp_path, rows, name="documents"):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_op11_is_the_plain_one(spark, tmp_path):
    rows = run_rows() + [r for r in awkward_rows() if len(r[1] or "") < 5000]
    got = queries.op11_periodic_runs(spark, _table(spark, tmp_path, rows)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted((plain_op11(r[0], r[1]) for r in rows), key=key)
    assert sum(r.n_runs > 0 for r in got) > 50


def test_runs_of_awkward_rows(spark):
    got = periodic_runs.periodic_runs(awkward(spark))
    assert got.columns == ["id", "n_words", "runs", "collapsed"]
    rows = got.collect()
    assert len(rows) == len(awkward_rows())
    long_ = [r for r in rows if r.n_words > 29_000]
    assert [[tuple(x) for x in r.runs] for r in long_] == [[(0, 30_000, 1)]] * 2
    assert {r.collapsed for r in long_} == {"word end", "word end tail"}
    assert all(r.collapsed == "" and r.runs == [] for r in rows if r.n_words == 0) and periodic_runs.periodic_runs(empty(spark)).collect() == []


# --- subvector clustering ---------------------------------------------------------


def plain_kmeans(rows, k=40, rounds=5, dims=64, scale=256, seed=2):
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for c in range(len(cents)):
            mine = [v for (_, v), (_, n) in zip(kept, got) if n == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    got, per = assign(), {}
    for d, n in got:
        per[n] = per.get(n, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, n, d, per[n], sum(per.values()), sha[n]) for (i, _), (d, n) in zip(kept, got)), key=str)


VECTORS = "vec_id long, embedding array<float>, label int, id int, v string, cluster double"


def _vectors(n, dims=64, seed=0):
    rng = np.random.default_rng(seed)
    out = [(i, rng.normal(0, .3, dims).astype(np.float32).tolist(), 0, 1, "x", 2.0) for i in range(n)]
    out += [(n + i, out[0][1], 0, 1, "x", 2.0) for i in range(60)]       # copies of one vector
    out += [out[1], out[1], (None, out[2][1], None, None, None, None), (n + 70, None, 0, 0, "", .0), (n + 71, [], 0, 0, "", .0),
            (n + 72, out[3][1][:-1], 0, 0, "", .0), (n + 73, out[3][1][:-1] + [None], 0, 0, "", .0),
            (n + 74, out[3][1][:-1] + [float("nan")], 0, 0, "", .0), (n + 75, out[3][1][:-1] + [float("-inf")], 0, 0, "", .0)]
    return out


@pytest.mark.parametrize("n,parts,block,chunk", [(150, 1, 2, 16_384), (150, 7, 5, 16), (20, 3, 64, 8), (0, 2, 2, 8)])
def test_clusters_are_the_plain_ones(spark, n, parts, block, chunk):
    rows = _vectors(n or 4)[:: 1 if n else 99] if n else []
    df = spark.createDataFrame(rows, VECTORS).repartition(parts)
    enc = subvector_kmeans.encode(df, block=block, chunk=chunk)
    out = subvector_kmeans.assign(enc, subvector_kmeans.fit(enc, subvector_kmeans.first_centroids(df)))
    assert out.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == plain_kmeans([r[:2] for r in rows])


def test_dictionaries_lose_nothing(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 3, (500, 9))
    x[:, 8] = rng.integers(-2 ** 27, 2 ** 27, 500)
    for block in (1, 2, 4, 9):
        dictionaries, codes = subvector_kmeans._encode_chunk(x, block)
        assert np.array_equal(np.concatenate([d[c] for d, c in zip(dictionaries, codes)], axis=1), x)
        assert all(len(np.unique(d, axis=0)) == len(d) for d in dictionaries)


def test_components_beyond_exact_distances_fail(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="would not be exact"):
        subvector_kmeans.cluster(df).collect()


# --- licence scan -----------------------------------------------------------------


def plain_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", text)


def least_edits(notice, text):
    """Smallest edit distance of the notice to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(notice, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "x", text[at] + "q"]) + text[at + 1:]
    return text


def test_fuzzy_search_finds_what_plain_edit_distance_finds():
    rng = random.Random(12)
    scan = license_scan.scanner()
    hits = 0
    for trial in range(160):
        label, notice, edits, _ = scan.notices[trial % len(scan.notices)]
        filler = lambda: " ".join(rng.choice("the license of gnu software any this public as under".split()) for _ in range(rng.randint(0, 12)))
        text = f"{filler()} {edited(rng, notice, rng.randint(0, edits + 2))} {filler()}".strip()
        found = {}
        for lab, note, start, end, e in scan.fuzzy(text):
            assert e <= next(x[2] for x in scan.notices if x[1] == note)
            assert least_edits(note, text[start: end]) <= e
            found[note] = min(e, found.get(note, 99))
        for lab, note, k, _ in scan.notices:
            assert (note in found) == (least_edits(note, text) <= k), (note, text)
        hits += len(found)
    assert hits > 100


def plain_base(text):
    w = plain_words(text)
    places = []
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i: i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


TEXTS = ["", None, "GNU General\nPublic-License gnu general public license", "cc by cc by CC-BY", "mitlicense mit licenses", "the MIT License é mit license",
         "Licensed under the Apache Licence, Version 2.0", "Permission is hereby granted, free of charge, to any persn obtaining a copy of this software",
         "nothing to see " * 40, "cc\x00by \u00a0cc by", "Licensed under CC BY-NC 4.0."]


def test_op13_base_is_the_plain_one(spark, tmp_path):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)] + awkward_rows()
    got = queries.op13_license_scan(spark, _table(spark, tmp_path, rows)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(
        ((r[0], *plain_base(r[1])) for r in rows), key=key)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base) and (r.score > 0) == bool(r.labels)
    by_id = {r.doc_id: r for r in got if r.doc_id and r.doc_id >= 6}
    mine = {r.doc_id: r for r in queries.op13_license_scan(spark, _table(spark, tmp_path / "b", rows[: len(TEXTS)])).collect()}
    assert mine[6].labels == "apache" and mine[6].base_labels == "" and .9 < mine[6].score < 1
    assert mine[7].labels == "mit" and mine[8].labels == "" and mine[10].labels == "cc-by,cc-by-nc"
    assert by_id


def test_license_spans_of_awkward_rows(spark):
    out = license_scan.scan_licenses(awkward(spark))
    assert out.columns == ["id", "n_words", "places", "matches", "score"] and out.count() == len(awkward_rows())
    assert license_scan.scan_licenses(empty(spark)).collect() == []
    one = spark.createDataFrame([(1, "We are LICENSED under teh GNU General Public License now", None, None, None)], SCHEMA)
    (m,) = license_scan.scan_licenses(one).first().matches
    assert (m.label, m.word, m.words, m.edits) == ("gpl", 2, 7, 2) and m.span.startswith("licensed under teh")


def test_many_repeats_of_a_piece_stay_cheap():
    scan = license_scan.scanner()
    text = "gnu general public lice " * 20_000
    assert scan.fuzzy(text) == [] or all(x[4] <= 4 for x in scan.fuzzy(text))

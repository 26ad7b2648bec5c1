"""Source mixing, PU quality, toxicity and the pipeline."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from ledgerline.llm import pu_quality, queries, source_mixing, toxicity
from ledgerline.llm.common import stored
from tests.llm.helpers import awkward, awkward_rows, empty, fold, prose, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def targets(sizes, weights=(5, 2, 1)):
    """Sources by name, null last; capped and shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left, all_w = total - sum(capped.values()), sum(w[s] for s in free)
        now = {s: left * w[s] / all_w for s in free}
        over = [s for s in free if now[s] >= 2 * sizes[s]]
        if not over:
            return capped | now
        capped |= {s: 2.0 * sizes[s] for s in over}
        if len(capped) == len(names):
            return capped


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 200))), None,
             rng.choice(["a", "a", "a", "a", "b", "c", "é", None]), 0) for i in range(1500)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = source_mixing.mix_sources(df).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want, taken = targets(sizes), Counter()
    source = {r[0]: r[3] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        s = source[r["id"]]
        taken[s] += r["taken"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] + 20 for s in sizes)
    assert Counter(map(tuple, got)) == Counter(map(tuple, source_mixing.mix_sources(df.repartition(3)).collect()))
    mixed = source_mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    out = mixed.collect()
    assert sum(len(words(r["text"])) for r in out) == sum(taken.values())
    by_id = Counter()
    for r in out:
        by_id[r["doc_id"]] += len(words(r["text"]))
    assert all(by_id[r["id"]] == r["taken"] for r in got)


def test_sainte_lague_gives_seats_to_the_highest_quotients(spark):
    rng = random.Random(4)
    for _ in range(4):
        items = [(g, i, float(rng.randint(0, 60)), seats, 100) for g, seats in ((1, rng.randint(1, 40)), (2, rng.randint(1, 9)))
                 for i in range(rng.randint(1, 9))]
        items = [x for x in items if sum(y[2] for y in items if y[0] == x[0])]
        got = source_mixing.sainte_lague(spark.createDataFrame(items, "grp int, item int, weight double, seats long, cap long"),
                                         "grp", "item").collect()
        for g in {x[0] for x in items}:
            mine = [x for x in items if x[0] == g]
            won = Counter(i for _, i in sorted(((-w / (2 * k + 1), i) for _, i, w, n, _ in mine for k in range(n)),
                                               )[: mine[0][3]])
            seats = {r["item"]: r["quota"] for r in got if r["grp"] == g}
            weight = {x[1]: x[2] for x in mine}
            assert sum(seats.values()) == mine[0][3]
            # equal quotients may go to either item
            assert sorted(round(weight[i] / (2 * k + 1), 9) for i in seats for k in range(seats[i])) == sorted(
                round(weight[i] / (2 * k + 1), 9) for i in won for k in range(won[i]))


def test_mixing_awkward_rows(spark):
    got = source_mixing.mix_sources(awkward(spark)).collect()
    assert Counter(r["id"] for r in got) == Counter(r[0] for r in awkward_rows())
    mixed = source_mixing.mixed_rows(awkward(spark))
    assert mixed.columns == awkward(spark).columns
    assert sum(len(words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in got)
    assert source_mixing.mix_sources(empty(spark)).count() == 0 == source_mixing.mixed_rows(empty(spark)).count()


def test_mixing_runs_no_python_on_executors(spark):
    plan = source_mixing.mix_sources(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_sql_twins(spark, key):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.QUERIES[key](spark, SF).toPandas()
    want = con.execute(queries.ORACLE_SQL[key]).df()[list(got.columns)]
    key_col = next(c for c in ("doc_id", "vec_id") if c in got.columns)
    assert got.sort_values(key_col).reset_index(drop=True).equals(
        want.sort_values(key_col).reset_index(drop=True).astype(got.dtypes.to_dict()))


def labelled(spark, spoil, column):
    clean, other = prose(300), [(i + 400, spoil(t, i), *_) for i, t, *_ in prose(200, seed=9)]
    df = spark.createDataFrame(clean + other, DOCS)
    labels = spark.createDataFrame([(r[0], int(r[0] < 400)) for r in clean + other] + [(None, 1), (5, None)],
                                   f"doc_id long, {column} int")
    return df, labels


def test_pu_quality(spark):
    df, labels = labelled(spark, lambda t, i: t.replace(" ", "%%% ") if i % 2 else t.upper(), "quality")
    model = pu_quality.train(df, labels)
    got = pu_quality.score(df, model).collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(r["held_out"] == (fold(r["id"], 5) == 0) for r in got)
    assert sum(r["predicted"] == (r["id"] < 400) for r in held) >= .93 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= .3) for r in got)
    out = pu_quality.score(awkward(spark), model)
    assert out.count() == len(awkward_rows()) and out.where("score is null").count() == 0
    kept = pu_quality.good_rows(awkward(spark), model)
    assert kept.columns == awkward(spark).columns and kept.count() == out.where("predicted = 1").count()
    assert pu_quality.score(empty(spark), model).count() == 0
    alone = pu_quality.train(df, labels.where("false"))
    assert pu_quality.score(df, alone).where("abs(score - 0.5) > 1e-9").count() == 0


def test_non_negative_risk_learns_from_positives_and_unlabelled_alone():
    rng = np.random.default_rng(0)
    dim = len(pu_quality.STATS) + (1 << pu_quality.GRAM_BITS)
    good, bad = np.zeros((300, dim), np.float32), np.zeros((200, dim), np.float32)
    good[:, 0], bad[:, 0] = rng.normal(2, 1, 300), rng.normal(-2, 1, 200)
    model = pu_quality.fit_nnpu(good[:100], np.vstack([good[100:], bad]), prior=.5)
    z = [(((x - model.mean) / model.scale) @ model.weights + model.bias) for x in (good, bad)]
    assert (z[0] > 0).mean() > .9 and (z[1] < 0).mean() > .9


def plain_vector(text):
    """The classifier's features, computed one by one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    lower_words = data.lower().split()
    grams = Counter()
    for i in range(len(data) - 2):
        code = 3
        for byte in data[i: i + 3]:
            code = (code * 257 + byte) % 2 ** 32
        grams[code * 2654435761 % 2 ** 32 >> 32 - pu_quality.GRAM_BITS] += 1
    total = sum(grams.values())
    shares = [pu_quality.GRAM_SCALE * math.sqrt(grams[b] / total) if total else 0.0 for b in range(1 << pu_quality.GRAM_BITS)]
    if not lower_words:
        return [0.0] * len(pu_quality.STATS) + shares
    kind = lambda c: (1 if c < 128 and chr(c).isupper() else 2 if c < 128 and chr(c).islower() else 3 if c < 128 and chr(c).isdigit()
                      else 4 if c < 128 and chr(c).isspace() else 6 if c < 128 and chr(c) in ".,;:'\"?-()" else 5 if c < 128 else 0)
    n = Counter(map(kind, data))
    letters, count = max(1, n[1] + n[2]), len(lower_words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    often = Counter(lower_words)
    stats = [math.log1p(count), n[1] / letters, n[5] / len(data), n[3] / len(data), len(often) / count ** .9,
             max(often.values()) / count, sum(map(len, lower_words)) / count / 10, data.count(b"!") / count,
             1 - len(set(lines)) / len(lines), math.log1p(count / len(lines)), data.count(b".") / count,
             sum(a == b for a, b in zip(lower_words, lower_words[1:])) / count]
    return stats + shares


def test_pu_features_are_the_plain_ones():
    for text in [None, "", " \n", "a", "ab!", "One two two. THREE 3%\nOne two two. THREE 3%\n\u00e9\u00e8 caf\u00e9 #1", prose(1)[0][1]]:
        assert pu_quality.vector(text).tolist() == pytest.approx(plain_vector(text), abs=1e-5)


def test_pu_fit_against_plain_descent():
    """The fitted scorer's risk is that of plain full-batch descent on the
    non-negative risk, and both tell the hidden classes apart alike."""
    rng = np.random.default_rng(5)
    size, dim = len(pu_quality.STATS), len(pu_quality.STATS) + (1 << pu_quality.GRAM_BITS)

    def rows(n, positive):
        x = np.zeros((n, dim), np.float32)
        x[:, :3] = rng.normal(.8 if positive else -.8, 1, (n, 3))
        return x

    prior, pos, hidden, neg = .4, rows(500, True), rows(400, True), rows(600, False)
    unl = np.vstack([hidden, neg])
    model = pu_quality.fit_nnpu(pos, unl, prior)
    mean, std = unl[:, :size].mean(0), unl[:, :size].std(0) + 1e-6

    def prepared(x):
        return np.hstack([np.clip((x[:, :size] - mean) / std, -5, 5), np.ones((len(x), 1))])

    p, u = prepared(pos), prepared(unl)

    def risk(w):
        negative = np.logaddexp(0, u @ w).mean() - prior * np.logaddexp(0, p @ w).mean()
        return prior * np.logaddexp(0, -(p @ w)).mean() + max(0.0, negative), negative

    w = np.zeros(size + 1)
    sig = lambda z: 1 / (1 + np.exp(-z))
    for _ in range(4000):
        bracket = u.T @ sig(u @ w) / len(u) - prior * p.T @ sig(p @ w) / len(p)
        w -= .05 * (bracket - prior * p.T @ sig(-(p @ w)) / len(p) if risk(w)[1] >= 0 else -bracket)
    mine = np.append(model.weights[:size], model.bias)
    assert risk(mine)[0] <= risk(w)[0] + .02
    agree = [(np.sign(u @ a) == np.sign(np.r_[np.ones(400), -np.ones(600)])).mean() for a in (mine, w)]
    assert abs(agree[0] - agree[1]) < .03 and agree[0] > .85


def test_toxicity(spark):
    bad = ["nastyone", "vileword", "foulterm"]
    rng = random.Random(0)

    def spoil(t, i):
        w = t.split()
        for _ in range(3):
            w.insert(rng.randrange(len(w)), bad[i % 3] + rng.choice(["", "!", ","]))
        return " ".join(w)

    df, labels = labelled(spark, spoil, "toxic")
    labels = labels.selectExpr("doc_id", "1 - toxic AS toxic")
    model = toxicity.train(df, labels)
    got = toxicity.score(df, model).collect()
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["predicted"] == (r["id"] >= 400) for r in held) >= .97 * len(held)
    assert all(e["label"] == 1 for r in held if r["predicted"] for e in r["evidence"][:1])
    out = toxicity.score(awkward(spark), model)
    assert out.count() == len(awkward_rows()) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(empty(spark), model).count() == 0
    assert toxicity.train(df, labels.where("toxic = 0")) is None
    assert toxicity.score(df, None).where("predicted = 1").count() == 0


def test_toxicity_counts_every_term(spark):
    """Toxic words seen in few examples decide, and similarities equal a
    brute-force cosine over all terms, those of no example too."""
    clean = prose(400)
    rows = [(i, t + (f" {i // 4 % 50:02d}slur" if i >= 200 else ""), *_) for i, t, *_ in clean]
    rows += [(1000 + k, f"{k:02d}slur " + " ".join(f"{a}{k}{b}qx" for a in "hjv" for b in "hjv"), None, None, 0) for k in range(8)]
    df = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.train(df, labels)
    got = {r["id"]: r for r in toxicity.score(df, model).collect()}

    def terms(text):
        out = Counter()
        for w in text.split():
            out.update(toxicity.terms_of(w))
        return {**out, **{(t, k): 1 for t, n in out.items() if t.endswith("-") for k in (2, 3) if n >= k}}

    counts = {r[0]: terms(r[1]) for r in rows}
    seen = Counter(t for i in model.ids for t in counts[i])     # of the indexed collection

    def vector(c):
        w = {t: (1 + math.log(n)) * math.log((len(model.ids) + 1) / (seen[t] + 1)) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / norm for t, x in w.items()}

    vectors = {i: vector(c) for i, c in counts.items()}
    for i in [*range(1000, 1008), *range(0, 400, 40)]:
        near = sorted((round(sum(x * vectors[e].get(t, 0) for t, x in vectors[i].items()), 9) for e in model.ids), reverse=True)[:3]
        assert [e["similarity"] for e in got[i]["evidence"]] == pytest.approx(near[: len(got[i]["evidence"])], abs=1e-8)
    assert all(got[i]["predicted"] == 1 and got[i]["evidence"][0]["label"] == 1 for i in range(1000, 1008))


def test_toxicity_of_few_words_in_long_texts():
    """One to three toxic words among hundreds of others are caught, clean texts let alone."""
    rng = random.Random(3)
    bad = ["".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(24)]
    common = [a + b + c for a in ("ba", "do", "ki", "lu", "me") for b in ("nar", "rit", "sol", "lem") for c in ("o", "ta", "vin")]
    parts, texts = ["sha", "tor", "ven", "qui", "lop", "mar", "est", "ing"], []
    for i in range(1600):
        k = rng.choice((100, 300, 900))
        text = rng.choices(common, k=k) + ["".join(rng.choices(parts, k=4)) for _ in range(k // 4)]
        text += rng.sample(bad, max(1, k // 300)) if i % 4 == 0 else []
        rng.shuffle(text)
        texts.append(" ".join(text))
    plain = toxicity.Terms()
    taught, held = ([i for i in range(1600) if (i % 5 == 0) == out] for out in (False, True))
    counts, labels = [plain.counts(texts[i]) for i in taught], np.array([int(i % 4 == 0) for i in taught])
    terms, numbers = np.unique(np.concatenate([c[0] for c in counts]), return_inverse=True)
    rows = list(zip(np.split(numbers, np.cumsum([len(c[0]) for c in counts])[:-1]), [c[1] for c in counts], strict=True))
    model = toxicity.fit(toxicity.vectors_of(terms, numbers, len(rows)), rows, labels, taught, tuple(np.bincount(labels)))
    scores = [s for s, _ in model.score(model.reader().read([texts[i] for i in held]))]
    least = np.quantile([s for s, i in zip(scores, held, strict=True) if i % 4], .9)
    assert np.mean([s > least for s, i in zip(scores, held, strict=True) if i % 4 == 0]) > .93


def test_toxicity_reads_texts_alike_in_any_company():
    """Counts of terms are those of ``Terms``, whatever is read beside or remembered."""
    texts = ["some words, some of them Words twice", None, "", "twice as many and the same the same", "word " * 50 + "wordless words"]
    plain = toxicity.Terms()
    counts = [dict(zip(*(x.tolist() for x in plain.counts(t)), strict=True)) for t in texts]
    terms = np.unique(np.array([t for c in counts[3:] for t in c], np.int64))
    vectors = toxicity.Vectors(terms, np.ones(len(terms)), 1.0)
    reader = toxicity.Reader(vectors)
    for many in (texts, texts[:1], texts[::-1]):
        for text, (numbers, n, unseen) in zip(many, reader.read(many), strict=True):
            want = counts[texts.index(text)]
            assert dict(zip(terms[numbers].tolist(), n.tolist(), strict=True)) == {t: k for t, k in want.items() if t in set(terms.tolist())}
            assert unseen == pytest.approx(sum((1 + math.log(k)) ** 2 for t, k in want.items() if t not in set(terms.tolist())))


def test_block_max_index_is_exact():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(500):
        ids = np.sort(rng.choice(60, rng.integers(0, 9), replace=False)).astype(np.int64)
        w = rng.random(len(ids))
        rows.append((ids, w / np.sqrt((w * w).sum()) if len(ids) else w))
    index = toxicity.BlockMaxIndex(rows, 60)
    dense = np.zeros((500, 60))
    for i, (ids, w) in enumerate(rows):
        dense[i, ids] = w
    together = index.nearest(rows[:100], 15, skip=list(range(100)))
    for q, (found, sims) in enumerate(together):
        alone, _ = index.nearest([rows[q]], 15, skip=[q])[0]
        assert alone.tolist() == found.tolist()
        want = dense @ dense[q]
        want[q] = 0
        order = [i for i in np.lexsort((np.arange(500), -np.round(want, 9))) if want[i] > 0][:15]
        assert found.tolist() == order and np.allclose(sims, want[order])


def test_pipeline(spark, tmp_path):
    """Stage by stage on awkward and generated rows; each keeps the columns."""
    import corpus_pipeline

    clean = prose(120)
    junk = [(i + 200, t.replace(" ", " %%% "), *_) for i, t, *_ in prose(60, seed=1)]
    near = [(300 + r[0], r[1] + " end", *r[2:]) for r in clean[:5]]
    rows = clean + junk + near + [(400 + r[0], r[1], *r[2:]) for r in clean[:7]] + [(None, None, None, None, None), (500, "", None, None, 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] < 200)) for r in clean + junk], "doc_id long, quality int").write.parquet(
        f"{tmp_path}/labels.parquet")
    docs, counts = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stored(stage(spark, docs, str(tmp_path)), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append({r["doc_id"] for r in docs.collect()})
    assert len(counts[0] & set(range(120))) >= 118 and not counts[0] & {r[0] for r in junk if fold(r[0], 5)}
    assert not counts[1] & set(range(400, 407))
    assert counts[3] <= counts[2] <= counts[1] <= counts[0]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[0] == "doc_id" and out.where("not parity").count() == 0 and out.count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0

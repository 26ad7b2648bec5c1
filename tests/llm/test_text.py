"""Chat formatting, SentencePiece codec, quality rules and language model."""

import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from ledgerline.llm import chat_format, context_mixing, quality_rules, sentencepiece_codec, word_contexts
from ledgerline.session import shared_dir
from tests.llm.helpers import LONG, awkward, awkward_rows, empty, fold, lower, prose, words


def cheapest(roles):
    """Every sequence of actions."""
    best = math.inf

    def go(i, state, cost):
        nonlocal best
        if cost >= best:
            return
        if i == len(roles):
            if state in chat_format.FINAL:
                best = cost
            return
        if state != chat_format.START:
            go(i + 1, state, cost + chat_format.MERGE + (0 if state == roles[i] else chat_format.RELABEL))

        def opened(at, inserted, paid):
            for x in chat_format.LEGAL[at]:
                go(i + 1, x, paid + (0 if x == roles[i] else chat_format.RELABEL))
                if inserted < 2:
                    opened(x, inserted + 1, paid + chat_format.INSERT)

        opened(state, 0, cost)

    go(0, chat_format.START, 0.0)
    return best


def test_repair_is_cheapest_whole_and_in_parts():
    rng = random.Random(0)
    for _ in range(200):
        roles = [rng.randrange(4) for _ in range(rng.randint(1, 6))]
        assert chat_format.repair(roles)[0] == pytest.approx(cheapest(roles))
        cut = rng.randrange(len(roles) + 1)
        parts = [p for p in (roles[:cut], roles[cut:]) if p]
        places = chat_format.chained([(7, i, chat_format.matrix(p)) for i, p in enumerate(parts)])
        assert sum(chat_format.repair(p, places[7, i][1], (places[7, i][2],))[0]
                   for i, p in enumerate(parts)) == pytest.approx(cheapest(roles))


def test_rendered_turns_are_legal(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool", None]), f"t{t}" if t % 4 else None)
            for c in range(50) for t in range(rng.randint(1, 7))]
    rows += [rows[0], rows[0], (None, 1, "user", "x"), (None, None, "assistant", None), (3, None, "user", "late")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr(
        "*", "1 AS id", "2 AS part", "3 AS cost").repartition(5)
    got = chat_format.repair_conversations(df).collect()
    assert sum(r["n_turns"] for r in got) == len(rows) and {r["id"] for r in got} == {r[0] for r in rows}
    for conv in {r["id"] for r in got}:
        text = "".join(r["rendered"] for r in sorted((r for r in got if r["id"] == conv), key=lambda r: r["part"]))
        roles = re.findall(r"<\|(system|user|assistant)\|>\n", text)
        assert re.fullmatch("(s)?(ua)*u?", "".join(r[0] for r in roles)) and len(roles) == text.count("<|end|>")
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
        whole = chat_format.result([r[2] for r in mine], [r[3] or "" for r in mine])
        assert whole[-2] == pytest.approx(sum(r["cost"] for r in got if r["id"] == conv)) and whole[-1] == text
    assert chat_format.repair_conversations(df.where("false")).count() == 0


def test_a_conversation_longer_than_a_row(spark):
    """Parts are cut by characters, however the rows are partitioned; a
    conversation that fits is one row, also over a partition's border."""
    df = spark.range(4000).selectExpr("7L AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role",
                                      "cast(id AS string) AS text")
    roles = ["user" if i % 3 == 0 else "assistant" for i in range(4000)]
    whole = chat_format.result(roles, [str(i) for i in range(4000)])
    for row_chars in (500, chat_format.ROW_CHARS):
        got = sorted(chat_format.repair_conversations(df.repartition(6), row_chars=row_chars).collect(), key=lambda r: r["part"])
        assert [r["part"] for r in got] == list(range(len(got))) and len(got) == (38 if row_chars == 500 else 1)
        assert sum(r["cost"] for r in got) == pytest.approx(whole[-2])
        text = "".join(r["rendered"] for r in got)
        assert [int(x) for x in re.findall(r"\d+", text)] == list(range(4000)) and (len(got) > 1 or text == whole[-1])


def test_rows_do_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(c, t % 5 if c == 3 else t, rng.choice(["system", "user", "assistant", None]), f"{c} {t} " + "x" * rng.randint(0, 40))
            for c in range(40) for t in range(rng.randint(1, 12) if c % 9 else 200)]
    rows += [(9, 1, "user", "again")] * 300 + [(None, None, "user", "n")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 8, 32):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(sorted(map(str, chat_format.repair_conversations(df.repartition(n + 1), row_chars=900).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 41


@pytest.fixture(scope="module")
def reference():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL_PATH)


def test_codec_equals_the_library(spark, reference):
    extra = ["▁marked▁text", "a\x00b", "<s> </s> <unk>", "tab\tand  two   spaces\n", " lead", "trail ", "😀 emoji 你好"]
    rows = awkward_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(extra)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS id", "2 AS ids")
    got = sentencepiece_codec.encode(df)
    found = Counter((r["id"], tuple(r["ids"]), r["n_tokens"]) for r in got.collect())
    want = Counter((r[0], tuple(ids), len(ids)) for r in rows for ids in [reference.encode(r[1] or "")])
    assert found == want
    assert got.where("not parity").count() == 0
    back = {r["id"]: r["text"] for r in sentencepiece_codec.decode(got.where("id > 0")).collect()}
    lossy = {r["id"] for r in got.where("not round_trip").collect()}
    assert lossy <= {100}  # the marker itself reads as a space
    assert all(back[r[0]] == (r[1] or "") for r in rows if (r[0] or 0) > 0 and r[0] not in lossy)
    assert sentencepiece_codec.encode(empty(spark)).count() == 0


def test_codec_by_whole_texts(reference):
    with open(sentencepiece_codec.MODEL_PATH, "rb") as f:
        codec = sentencepiece_codec.Codec(f.read())
    codec.parts = None
    texts = ["some text here", "", "two  spaces\n"]
    got = codec.encode(texts)
    assert [np.frombuffer(g[0], np.int32).tolist() for g in got] == [reference.encode(t) for t in texts]
    assert all(g[1] and g[2] for g in got)


def test_round_trip_runs_the_decoder():
    """A decoder that gives another text shows, in parts and in whole texts."""
    from tokenizers import decoders

    with open(sentencepiece_codec.MODEL_PATH, "rb") as f:
        codec = sentencepiece_codec.Codec(f.read())
    codec.parts.decoder = codec.texts.decoder = decoders.Replace("a", "b")
    assert [g[1:] for g in codec.encode(["some data", ""])] == [(True, False), (True, True)]
    codec.parts = None
    assert [g[1:] for g in codec.encode(["some data", ""])] == [(True, False), (True, True)]


def test_unigram_model_file():
    """A tiny model file written by hand: the best path by unigram scores, and byte fallback."""
    import struct

    def message(*items):
        out = b""
        for n, v in items:
            if isinstance(v, bytes):
                out += bytes([n << 3 | 2, len(v)]) + v
            elif isinstance(v, float):
                out += bytes([n << 3 | 5]) + struct.pack("<f", v)
            else:
                out += (bytes([n << 3]) if n < 16 else bytes([n << 3 & 0x7F | 0x80, n >> 4])) + bytes([v])
        return out

    pieces = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("▁", -3.0, 1), ("b", -2.0, 1), ("ab", -1.5, 1), ("a", -2.5, 1)]
    pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    data = b""
    for text, score, kind in pieces:
        body = message((1, text.encode()), (2, score), (3, kind))
        data += bytes([1 << 3 | 2, len(body)]) + body
    trainer = message((3, 1), (35, 1))
    norm = message((3, 1), (4, 0), (5, 1))
    data += bytes([2 << 3 | 2, len(trainer)]) + trainer + bytes([3 << 3 | 2, len(norm)]) + norm
    model = sentencepiece_codec.Model(data)
    assert model.kind == sentencepiece_codec.UNIGRAM and model.byte_fallback and model.by_parts
    tok = sentencepiece_codec.tokenizer(model, whole=True)
    assert tok.encode("ab").tokens == ["▁a", "b"]
    assert tok.encode("a é").tokens[0] == "▁a" and "<0xC3>" in tok.encode("a é").tokens
    assert tok.decode(tok.encode("ab é a").ids) == "ab é a"


def brute_measures(text):
    w = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(hit))


def test_quality_rules(spark):
    clean, junk = prose(160), [(i + 200, t.replace(" ", " | ").upper(), *_) for i, t, *_ in prose(160, seed=1)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(r[0], int(r[0] < 200)) for r in clean + junk] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality_rules.train(df, labels)
    out = quality_rules.apply_rules(df, model).collect()
    held = [r for r in out if fold(r["id"], 5) == 0]
    assert held and sum(r["kept"] == (r["id"] < 200) for r in held) >= .95 * len(held)
    rows = awkward_rows()
    got = Counter(tuple(r)[:6] + (r["base_failed"],) for r in quality_rules.apply_rules(awkward(spark), model).collect())
    want = Counter((r[0], *m, quality_rules.base_failed(m[0], m[4])) for r in rows for m in [brute_measures(r[1])])
    assert got == want
    assert brute_measures(LONG) == quality_rules.measures(LONG)
    assert quality_rules.apply_rules(empty(spark), model).count() == 0
    assert quality_rules.train(df, labels.where("quality = 1")) is None
    assert quality_rules.apply_rules(df, None).where("kept = base_failed").count() == 0


def test_lm_scores(spark):
    rows = prose(120) + [(500 + r[0], r[1], None, r[3], r[4]) for r in awkward_rows() if r[0] is not None] + [
        (None, None, None, None, None), (7, "second row of an id", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = context_mixing.score(df.selectExpr("*", "1 AS id", "2 AS cls", "'w' AS word", "true AS train")).collect()
    tokens = [[*words(lower(r[1])), "\n"] for r in rows]
    c = Counter(t for r, ts in zip(rows, tokens, strict=True) if fold(r[0], 7) != 2 for t in ts)
    total, distinct = sum(c.values()), len(c)
    want = Counter()
    for r, ts in zip(rows, tokens, strict=True):
        base = sum(math.log10((c[t] + 1) / (total + distinct + 1)) for t in ts)
        want[(r[0], fold(r[0], 7) == 2, len(ts), sum(c[t] > 0 for t in ts), total, round(base, 6))] += 1
    assert Counter((r["id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    whole = [r for r in got if r["id"] is not None and r["id"] < 120 and r["held_out"] and r["n_tokens"] > 10]
    assert sum(r["score"] for r in whole) > sum(r["base_score"] for r in whole)
    assert context_mixing.score(empty(spark)).count() == 0


def test_lm_scores_know_word_order(spark):
    """The same words score higher in an order seen in training."""
    phrase = "red fox ran over the old stone bridge".split()
    held = [i for i in range(200) if fold(i, 7) == 2]
    rows = [(i, " ".join(phrase if i % 2 else random.Random(i).sample(prose(1, seed=i)[0][1].split(), 30)), "en") for i in range(200)]
    rows[held[0]] = (held[0], " ".join(phrase), "en")
    rows[held[1]] = (held[1], " ".join(phrase[::-1]), "en")
    got = {r["id"]: r for r in context_mixing.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[held[0]]["held_out"] and got[held[0]]["base_score"] == pytest.approx(got[held[1]]["base_score"])
    assert got[held[0]]["score"] > got[held[1]]["score"] + 4


def test_contexts_across_words_equal_brute_force(spark):
    rng = random.Random(5)
    texts = [(r, rng.random() < .8, [rng.randrange(8) for _ in range(rng.randrange(1, 12))]) for r in range(40)]
    logs = {w: -rng.random() * 3 for w in range(8)}
    logs[7] = -5000.0
    pairs = {1: Counter(), 2: Counter()}

    def contexts(tokens, i):
        padded = [None, None, *tokens]
        return {1: (padded[i + 1],), 2: (padded[i], padded[i + 1])}

    for _, train, tokens in texts:
        for i, w in enumerate(tokens):
            for order, c in contexts(tokens, i).items():
                pairs[order][c, w] += train
    want = {}
    for row, train, tokens in texts:
        sum_ = 0.0
        for i, w in enumerate(tokens):
            own, rest = 0.0, 1.0
            for order, c in contexts(tokens, i).items():
                mine = {v: n - (train and v == w) for (x, v), n in pairs[order].items() if x == c}
                total = sum(mine.values())
                if total > 0:
                    one, two = (sum(n == k for n in pairs[order].values()) for k in (1, 2))
                    d = min(max(one / (one + 2 * two), .05), .95) if one else .5
                    freed = d * sum(n > 0 for n in mine.values()) / total
                    own, rest = max(mine[w] - d, 0) / total + freed * own, freed * rest
            sum_ += math.log10(own + rest * 10 ** logs[w]) - logs[w] if own else math.log10(rest)
        want[row] = sum_
    got = context_mixing.across_words(spark.createDataFrame(texts, "row long, train boolean, tokens array<long>"),
                                      spark.createDataFrame(list(logs.items()), "hash long, s0 float"), 1).collect()
    assert {r["row"]: r["o0"] for r in got} == pytest.approx({r: x for r, x in want.items() if r in {g["row"] for g in got}}, abs=1e-4)
    assert all(abs(want[r]) < 1e-9 for r in want.keys() - {g["row"] for g in got})


@pytest.mark.parametrize(("known", "hot"), [(0, 1 << 20), (5, 1 << 20), (5, 1), (5, 30), (8, 30)])
def test_contexts_do_not_depend_on_chunks_frequent_and_hot_words(spark, monkeypatch, known, hot):
    """Sums of chunks of a few texts, with some words known to all tasks and some
    dealt over all slots, equal those of the plain table of tokens."""
    rng = random.Random(9)
    texts = [(r, rng.random() < .8, [rng.randrange(8) for _ in range(rng.randrange(1, 30))]) for r in range(60)]
    texts += [(r + 60, *t[1:]) for r, t in enumerate(texts[:20])]
    table = [(w, sum(t.count(w) for _, train, t in texts if train), -rng.random() * 3, -rng.random() * 3) for w in range(8)]
    scored = spark.createDataFrame(table, "hash long, c long, s0 float, s1 float")
    want = context_mixing.across_words(spark.createDataFrame(texts, "row long, train boolean, tokens array<long>"), scored, 2, slots=1).collect()
    monkeypatch.setattr(word_contexts, "HOT_TOKENS", hot)
    top = np.array([[h, c] for h, c, *_ in table[:known]], np.int64).reshape(-1, 2)
    logs = np.array([s for *_, a, b in table[:known] for s in (np.float32(a), np.float32(b))], float).reshape(-1, 2)
    frequent = word_contexts.Frequent.of(top[:, 0], top[:, 1], logs, 60)
    chunks = []
    for i in range(0, 80, 7):
        some = texts[i: i + 7]
        codes = np.array([w if w < known else w + 1 for _, _, t in some for w in t])
        chunks.append((i, bytearray(word_contexts.chunk_blob(codes, np.array([len(t) for *_, t in some]), np.array([int(x) for _, x, _ in some]),
                                                             np.array([r for r, *_ in some]), np.arange(known, 8)))))
    got = context_mixing.across_words(spark.createDataFrame(chunks, "chunk long, blob binary").repartition(3), scored, 2, frequent, 5).collect()
    assert len(got) == len(texts)
    for r in sorted(want):
        assert tuple(next(g for g in got if g["row"] == r["row"])) == pytest.approx(tuple(r), abs=1e-9)
    for (row, _, tokens), r in zip(texts, sorted(want), strict=True):
        assert r["known"] == len(tokens) and r["m1"] == pytest.approx(sum(table[w][3] for w in tokens), abs=1e-5)


def test_lm_stores_a_few_bytes_per_token(spark):
    """Tables and shuffles of (context, word) rows took several times the input."""
    rng = random.Random(3)
    texts = [(i, " ".join(f"w{int(30_000 ** rng.random())}" for _ in range(500)), "en") for i in range(400)]
    before = written(spark)
    assert context_mixing.score(spark.createDataFrame(texts, "doc_id long, text string, lang string")).count() == 400
    assert written(spark) - before < 10 * 400 * 501     # the version before: 24 bytes a token


def written(spark):
    root = shared_dir(spark).removeprefix("file:")
    return sum(p.stat().st_size for p in Path(root).rglob("lm-*/*.parquet"))


def test_beginnings_are_counted_and_scored_once():
    """What words share with the one before is left out, the results stay."""
    words_in = sorted(["a", "ab", "abc", "abd", "b", "ünï", "ünïcödé", "x" * 300, "x" * 299 + "y", ""]) + ["ab", "zz", "z"]
    coder = context_mixing.Coder(np.arange(256.0))
    n = np.array([[i % 3, i % 2] for i in range(len(words_in))], float)
    slots = 1 << context_mixing.TABLE_BITS

    def table(parts):
        cells, weights = zip(*[x for p in parts for x in context_mixing.cells_of([words_in[i] for i in p], n[p], coder)], strict=True)
        return np.bincount(np.concatenate(cells), np.concatenate(weights), minlength=2 * slots)

    whole, single = table([list(range(len(words_in)))]), table([[i] for i in range(len(words_in))])
    assert whole.sum() > 0 and np.array_equal(whole, single)
    counts = whole.reshape(-1, 2).astype(np.float32)
    model = context_mixing.Mixer(coder, counts[:, 0].copy(), counts[:, 1].copy(), np.full((18, 6), .3), np.ones(2) / 2)
    each = np.concatenate([model.log10_probabilities([w]) for w in words_in])
    assert np.allclose(model.log10_probabilities(words_in), each, rtol=1e-12, atol=0)
    bits, plain = (context_mixing.bits_of(words_in, coder, shared=x) for x in (True, False))
    assert len(bits.bit) < len(plain.bit) and len(bits.of) == len(plain.token)


def test_word_probabilities_sum_to_one_over_each_byte():
    """The code tree is complete: the bits' probabilities of all bytes add up to one."""
    coder = context_mixing.Coder(np.arange(256.0))
    assert math.isclose(sum(2.0 ** -n for n in coder.length.tolist()), 1.0)

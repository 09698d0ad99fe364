"""Operators on texts against plain versions: the whole tables, and rows with every odd case."""

import base64
import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from compare import connect, difference, duck_rows, spark_rows
from tabsift.llm import byte_bpe, licenses, mixing, packing, quality, repeats, set_join, token_counts
from tabsift.llm.oracles import ORACLES
from tabsift.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, row long, class string"
LINE = "The quick brown fox jumps over the lazy dog and runs away from the bear. "
ODD = [
    (1, None), (2, ""), (3, " "), (4, "\n\t "), (5, "word"), (6, "one two three"), (6, "one two three"), (None, "no id here"),
    (7, "a" * 700), (8, "ab " * 400), (9, LINE * 6), (10, LINE * 6), (11, "x" + LINE * 5), (12, LINE * 3 + "tail " + LINE * 3),
    (13, "don't I'll we've 's 't  's''s'll she'd"), (14, "naïve café 日本語テキスト 🙂🙂 ½ ² Ⅷ ١٢٣"),
    (15, "tabs\tand\r\nlines  \n\n  with   runs   "), (16, "▁ ▁▁a <s> </s> <unk> <0x41>"), (17, "\x00\x01 \x1c\x1d\x85 x"),
    (18, "é" * 300 + " " + "é" * 300), (19, "HELLO hello HeLLo world again"), (20, "hello hello hello world again"),
    (21, " leading and trailing "), (22, "<|endoftext|> special"), (23, "0123456789" * 30), (24, "a b　c﻿d"),
    (25, "y" * 3000 + "zz" * 500),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", None if n % 3 == 0 else f"s{n % 4}", len(t or ""), "clash", 5, "clash")
            for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def empty(df):
    return df.limit(0)


# Repeated strings


def plain_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = defaultdict(int)
    for _, t in texts:
        for k in range(len(t) - length + 1):
            seen[t[k:k + length]] += 1
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k:k + length]] > 1:
                gone[k:k + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, kept))
    return sorted(out, key=repr)


def found_repeats(df, **options):
    got = repeats.remove_repeats(df, **options).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got), key=repr)


def test_repeats_of_the_table(docs):
    assert found_repeats(docs) == plain_repeats(pairs_of(docs), 200)


@pytest.mark.parametrize("options", [{}, {"crowd": 0}, {"lot_bytes": 600}, {"block": 1}, {"length": 64}])
def test_repeats_of_odd_rows(odd, options):
    assert found_repeats(odd, **options) == plain_repeats(pairs_of(odd), options.get("length", 200))


def test_repeats_of_no_rows(odd):
    assert found_repeats(empty(odd)) == []


def test_merged_transforms_order_all_suffixes():
    rng = np.random.default_rng(1)
    blocks = [bytes(rng.integers(97, 99, rng.integers(1, 60)).astype(np.uint8)) for _ in range(40)]
    for length in (8, 16, 32):
        count = defaultdict(int)
        for b in blocks:
            for k in range(len(b) - length + 1):
                count[b[k:k + length]] += 1
        wanted = [[k for k in range(len(b) - length + 1) if count[b[k:k + length]] > 1] for b in blocks]
        assert [x.tolist() for x in repeats.repeated_starts(blocks, length)] == wanted
    left, right = (np.frombuffer(b"".join(x + b"\xff" for x in blocks[h::2]) + bytes([e]), np.uint8)
                   for h, e in ((0, 0xFD), (1, 0xFE)))
    source, place, interval = repeats.merge_transforms(left, right, 16)
    strings = [(left, right)[s].tobytes()[p:p + 16] for s, p in zip(source, place)]
    full = [s for s in strings if len(s) == 16]
    assert full == sorted(full)
    assert all((a == b) == (x == y) for a, b, x, y in zip(strings, strings[1:], interval, interval[1:])
               if len(a) == len(b) == 16)


# Similar sets


def plain_groups(rows, width=4, percent=85):
    sets, of = [], []
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            low = low.replace(c, " ")
        words = [w for w in low.split(" ") if w]
        few = {tuple(words)} if words else set()
        sets.append({tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else few)
        of.append(i)
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            n, m = len(sets[a]), len(sets[b])
            if n and m and 100 * min(n, m) >= percent * max(n, m):
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (n + m - shared):
                    root[top(a)] = top(b)
    least = {}
    for k, i in enumerate(of):
        held = least.get(top(k))
        least[top(k)] = i if held is None else held if i is None else min(held, i)
    return sorted(((i, len(sets[k]), least[top(k)]) for k, i in enumerate(of)), key=repr)


def found_groups(df, **options):
    return sorted(map(tuple, set_join.jaccard_groups(df, **options).collect()), key=repr)


def test_groups_of_the_table(docs):
    assert found_groups(docs) == plain_groups(pairs_of(docs))


def variants(spark):
    """Groups of texts that differ by a few words, with chains of links and frequent lines in common."""
    rng = np.random.default_rng(4)
    rows, number = [], 0
    for group in range(12):
        base = [f"w{x}" for x in rng.integers(0, 4000, 120)]
        if group % 2:
            base[:30] = [f"hot{k}" for k in range(30)]
        text = list(base)
        for step in range(25):
            if step % 3 == 0:
                text = list(text)
                text[rng.integers(0, 120)] = f"n{number}"
            other = list(text)
            for _ in range(rng.integers(0, 4)):
                other[rng.integers(0, 120)] = f"m{rng.integers(0, 50)}"
            rows.append((number, " ".join(other)))
            number += 1
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("percent", [85, 60])
def test_groups_of_variants(spark, percent):
    df = variants(spark)
    assert found_groups(df, percent=percent) == plain_groups(pairs_of(df), percent=percent)


def test_pairs_of_one_component_are_not_derived(spark):
    """Sets around leaders: those that link to theirs meet only the rest, in blocks of any size, and no link is lost."""
    rng = np.random.default_rng(6)
    rows, sets, size = [], {}, {}
    for leader in range(5):
        head = set(range(1000 * leader, 1000 * leader + 60))
        sets[leader] = head
        for k in range(24):
            out = 0 if leader == 3 else rng.integers(0, 22)  # all of the fourth leader's sets link to it
            mine = {int(x) for x in rng.choice(sorted(head), 60 - out, replace=False)}
            mine |= {int(x) for x in rng.integers(5000, 5012, rng.integers(0, 4))}
            name = 100 + 24 * leader + k
            sets[name] = mine
            both = len(head & mine)
            only = lambda x: np.array(sorted(x), np.int64).tobytes()
            rows.append((name, leader, len(mine), 60, both, bytearray(only(mine - head)), bytearray(only(head - mine)),
                         100 * both >= 85 * (len(mine) + 60 - both)))
    answers = spark.createDataFrame(rows, set_join.ANSWER + ", link boolean")
    group = {r[0]: r[1] for r in rows}
    led = {(r[0], r[1]) for r in rows if r[7]}

    def grouped(pairs):
        root = {x: x for x in sets}
        for a, b in pairs:
            old, new = root[a], root[b]
            root = {x: new if r == old else r for x, r in root.items()}
        parts = {}
        for x, r in root.items():
            parts.setdefault(r, set()).add(x)
        return sorted(map(sorted, parts.values()))

    linked = lambda x, y: 100 * len(x & y) >= 85 * len(x | y)
    wanted = {(a, b) for a in group for b in group if a < b and group[a] == group[b] and linked(sets[a], sets[b])}
    for block in (3, 1024):
        got = {tuple(r) for r in set_join.derived_links(answers, 85, block).collect()}
        assert grouped(got | led) == grouped(wanted | led) != grouped(led)
        assert not any(group[a] == 3 for a, _ in got)


def test_groups_of_odd_rows(odd):
    assert found_groups(odd) == plain_groups(pairs_of(odd))
    assert found_groups(empty(odd)) == []


# Mixing


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame(
        [("b", 100), ("a", 10), ("c", 100), (None, 100), ("d", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # 465 words; weights a 5, b 2, c 1, d 5, null 2; a stops at 20, d at 0, b and null at 200; c takes the rest.
    assert got == {"a": 20.0, "d": 0.0, "b": pytest.approx(178.0), None: pytest.approx(178.0), "c": pytest.approx(89.0)}
    assert mixing.source_targets(empty(sizes)).collect() == []


@pytest.mark.parametrize("options", [{}, {"group_rows": 20, "fanout": 2}])
def test_mix(docs, options):
    one = mixing.mix_sources(docs, **options).toPandas()
    again = mixing.mix_sources(docs.repartition(5), **options).toPandas()
    key = ["doc_id", "size"]
    assert one.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))
    assert len(one) == docs.count() and (one["taken"] <= 2 * one["size"]).all() and (one["taken"] >= 0).all()
    for _, part in one.groupby("source"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 1
    texts = dict(pairs_of(docs))
    assert all(len((texts[r.doc_id] or "").split()) == r.size for r in one.itertuples() if (texts[r.doc_id] or "").isascii())
    parts = one[(one["size"] > 0) & (one["taken"] % one["size"] > 0)]
    assert parts.groupby("source").size().max() <= 1


def test_copies_are_fair(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), "s" if i % 4 else "t") for i in range(400)], "doc_id long, text string, source string")
    share = [mixing.mix_sources(df, seed=s).groupBy("source").agg(
        F.sum(F.when(F.col("doc_id") < 200, F.col("taken"))) / F.sum("taken")).toPandas().iloc[:, 1].mean() for s in range(3)]
    assert abs(np.mean(share) - 0.5) < 0.1


@pytest.mark.parametrize("options", [{}, {"group_rows": 20, "fanout": 2}])
def test_mix_of_whole_copies(docs, options):
    mixed = mixing.mix_sources(docs, whole_copies=True, **options).toPandas()
    assert len(mixed) == docs.count() and not mixed[mixed["size"] > 0].eval("taken % size").any()
    for _, part in mixed.groupby("source"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) < part["size"].max()


def test_the_last_document_is_drawn_with_its_probability():
    rows = pd.DataFrame({"size": [100], "key": ["k"], "p": [0.3]})
    drawn = [mixing._round_group(rows, seed, True)["p"][0] for seed in range(2000)]
    assert set(drawn) == {0.0, 1.0} and abs(np.mean(drawn) - 0.3) < 0.05
    assert mixing._round_group(rows, 0)["p"][0] == 0.3


def test_mix_query_takes_whole_documents(spark, sf):
    rows = QUERIES["op3_mix_sources"](spark, sf).collect()
    assert all(r["taken"] % r["size"] == 0 for r in rows if r["size"])


def test_mix_of_odd_rows(odd):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mix_sources(empty(odd)).collect() == []


def test_documents_are_repeated(spark):
    docs = spark.createDataFrame([(1, " a b  c d"), (2, "e f"), (3, "g")], "doc_id long, text string")
    plan = spark.createDataFrame([(1, 4, 6), (2, 2, 4), (3, 1, 0)], "doc_id long, size long, taken long")
    got = sorted(map(tuple, mixing.repeat_documents(docs, plan, "doc_id").select("doc_id", "text").collect()))
    assert [i for i, _ in got] == [1, 1, 2, 2] and sorted(t.split() for i, t in got if i == 1) == [["a", "b"], ["a", "b", "c", "d"]]


# Tokens


@pytest.fixture(scope="module")
def tiktoken_library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(docs, odd, tiktoken_library):
    for df in (docs, odd):
        encoded = byte_bpe.encode(df.select("doc_id", "n_chars", "lang", F.col("text").alias("copy"), "text"), RANKS, decode=True)
        for row in encoded.collect():
            text = row["copy"] or ""
            ids = np.array(tiktoken_library.encode_ordinary(text), "<u4")
            assert row["token_ids"] == ids.tobytes() and row["n_tokens"] == len(ids), text[:80]
            assert row["decoded"] == text.encode()
    assert byte_bpe.encode(empty(odd), RANKS).collect() == []
    back = byte_bpe.decode(byte_bpe.encode(odd, RANKS, decode=True).select("doc_id", "token_ids", F.col("decoded").alias("wanted")), RANKS)
    assert all(r["decoded"] == r["wanted"] for r in back.collect())


def test_long_words(tiktoken_library, monkeypatch):
    rng = random.Random(3)
    several = lambda parts, n: "".join(rng.choice(parts) for _ in range(n))
    parts = ["an", "a", "the", "ing", "aa", "in", "st", "tion", "er", "es", "re", "e", "s", "t"]
    words = {several([chr(c) for c in range(0x4E00, 0x5000)], 60) for _ in range(50)}
    words |= {several("abcdefghijklmnopqrstuvwxyz", n) for n in (97, 120, 5_000)} | {several(parts, 3_000), "a" * 20_001, "-" * 5_000}
    words |= {several(rng.sample(parts, k), rng.randrange(3, 60)) for k in (2, 4, 12) for _ in range(200)}
    ranks = byte_bpe.Ranks(open(RANKS, "rb").read())
    for bound, whole in ((byte_bpe.LONG_WORD, False), (3, False), (3, True)):  # then also short words as long ones, uncut
        monkeypatch.setattr(byte_bpe, "LONG_WORD", bound)
        merger = byte_bpe.Merger(ranks)
        if whole:
            merger.cut = lambda raw: [raw]
        merger.learn(words)
        for word in words:
            assert np.frombuffer(merger.ids[word], "<u4").tolist() == tiktoken_library.encode_ordinary(word), word[:80]
            assert merger.text[word] == word.encode()


def test_words_are_cut_where_no_token_reaches():
    ranks = byte_bpe.Ranks(open(RANKS, "rb").read())
    merger = byte_bpe.Merger(ranks)
    tokens = list(merger.rank)
    raw = "中文字符qzxjthe".encode() * 3
    pieces = merger.cut(raw)
    assert b"".join(pieces) == raw and len(pieces) > 3
    for a, b in zip(pieces, pieces[1:]):
        assert not any(a[-1:] + b[:1] in t for t in tokens)


def test_decoding_in_runs(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "DECODED", 3)
    ids = [list(range(300, 300 + n)) for n in (7, 0, 1, 3, 9, 2)]
    rows = [(i, np.array(v, "<u4").tobytes(), "own") for i, v in enumerate(ids)] + [(9, None, "own")]
    df = spark.createDataFrame(rows, "doc_id long, token_ids binary, decoded string")
    token = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(RANKS, "rb"))}
    got = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(df, RANKS).collect()}
    assert got == {9: b""} | {i: b"".join(token[x] for x in v) for i, v in enumerate(ids)}
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(np.array([5, 4_000_000], "<u4").tobytes(),)], "token_ids binary"), RANKS).collect()


def test_query_digests(spark, sf, docs, tiktoken_library):
    got = {r["doc_id"]: r for r in QUERIES["op5_byte_bpe"](spark, sf).collect()}
    for i, text in pairs_of(docs)[:50]:
        ids = np.array(tiktoken_library.encode_ordinary(text or ""), "<u4").tobytes()
        assert got[i]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_every_character_is_cut_as_by_the_library(tiktoken_library):
    kinds = np.frombuffer(__import__("zlib").decompress(byte_bpe.character_classes()), np.uint8)
    ranks = byte_bpe.Ranks(open(RANKS, "rb").read())
    merger = byte_bpe.Merger(ranks)
    points = [i for i in range(0x3000) if not 0xD800 <= i < 0xE000]
    texts = [f"a{chr(i)}a {chr(i)}{chr(i)}'s{chr(i)} 1{chr(i)}1" for i in points]
    words = byte_bpe.pretokens(texts, kinds)
    merger.learn(set().union(*words))
    for text, w in zip(texts, words):
        assert np.frombuffer(b"".join(merger.ids[x] for x in w), "<u4").tolist() == tiktoken_library.encode_ordinary(text), repr(text)


def test_piece_counts(docs, odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (docs, odd):
        got = token_counts.count_tokens(df.select("doc_id", F.col("text").alias("copy"), "n_tokens" if "n_tokens" in df.columns else "lang", "text"), MODEL)
        for row in got.collect():
            text = row["copy"] or ""
            assert row["n_tokens"] == len(library.encode(text)), repr(text[:80])
            assert row["n_bytes"] == len(text.encode()) and row["over_limit"] == (row["n_tokens"] > 4096)
    assert token_counts.count_tokens(empty(odd), MODEL).collect() == []


def test_packing_is_lossless(docs, odd, tiktoken_library):
    for df in (docs, odd):
        rows = packing.pack_tokens(df, RANKS, pattern=public_tokenizers.PATTERN, row_tokens=256, lot_tokens=20_000).collect()
        pieces = defaultdict(list)
        for r in rows:
            line = np.frombuffer(r["input_ids"], "<u4")
            cu = r["cu_seqlens"]
            assert len(line) == 256 and cu[0] == 0 and cu[-1] == r["n_tokens"] <= 256 and (line[cu[-1]:] == 50_256).all()
            assert r["position_resets"] == cu[:-1] and len(cu) == r["n_segments"] + 1 == len(r["doc_ids"]) + 1
            positions = packing.position_ids(cu, 256)
            assert (positions[cu[:-1]] == 0).all()
            for i, start, a, b in zip(r["doc_ids"], r["doc_starts"], cu, cu[1:]):
                pieces[i].append((start, line[a:b].tolist()))
        wanted = defaultdict(list)
        for i, t in pairs_of(df):
            ids = tiktoken_library.encode_ordinary(t or "")
            wanted[i] += [(k, ids[k:k + 256]) for k in range(0, len(ids), 256)]
        assert {i: sorted(p) for i, p in pieces.items()} == {i: sorted(p) for i, p in wanted.items() if p}
    assert packing.pack_tokens(empty(odd), RANKS, pattern=public_tokenizers.PATTERN).collect() == []


def test_best_fit_is_the_tightest():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = rng.integers(1, 101, 200).tolist()
        rows = packing.best_fit_decreasing(lengths, 100)
        assert sorted(i for r in rows for i in r) == list(range(200)) and all(sum(lengths[i] for i in r) <= 100 for r in rows)
        room: list[int] = []
        for n in sorted(lengths, reverse=True):
            fit = [r for r in room if r >= n]
            if fit:
                room[room.index(min(fit))] -= n
            else:
                room.append(100 - n)
        assert sorted(100 - sum(lengths[i] for i in r) for r in rows) == sorted(room)
        assert len(rows) <= math.ceil(11 / 9 * sum(lengths) / 100) + 1


# Quality


def test_quality_separates_held_out_rows(spark, sf):
    got = QUERIES["op6_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert set(got["held_out"]) == {True, False} and got["score"].between(0, 1).all()
    out = got[got["held_out"]]
    assert (out["predicted"] == out["quality"]).mean() > 0.9
    again = QUERIES["op6_quality"](spark, sf).select("doc_id", "score").toPandas().set_index("doc_id")["score"]
    assert (got.set_index("doc_id")["score"] - again).dropna().abs().max() < 1e-9


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 0), (9, 0, 0), (9, 1, 0), (13, None, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0), labels.where("quality = 0")):
        got = quality.score_quality(odd, given).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score_quality(empty(odd), labels).collect() == []


def test_nonnegative_risk_learns_from_unlabelled():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (3000, 4)), rng.normal(-1, 1, (3000, 4))
    scorer = quality.fit_positive_unlabelled(good[:1000], np.concatenate([good[1000:2400], bad[:600]]), 0.7)
    assert (scorer.scores(good[2400:]) > 0.5).mean() > 0.85 and (scorer.scores(bad[600:]) < 0.5).mean() > 0.85


# Licenses


def test_licenses_equal_sql(spark, sf):
    assert difference(spark_rows(QUERIES["op10_licenses"](spark, sf)), duck_rows(connect(sf), ORACLES["op10_licenses"])) is None


def test_license_rules(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
           "documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation "
           "the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and "
           "to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above "
           "copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the "
           "Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT "
           "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
           "EVENT SHALL THE\nAUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER IN AN "
           "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,\nOUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
           "OTHER DEALINGS IN THE\nSOFTWARE.\n")
    rows = [(1, mit), (2, "Some words\nReleased under the MIT License.\nmore"), (3, None), (4, ""), (5, "mit."),
            (6, "# SPDX-License-Identifier: Apache-2.0\n"), (7, "This is not licensed under the Apache License, Version 2.0."),
            (8, "Licensed under CC BY-NC 4.0. Released under the MIT License."), (8, "Licensed under CC BY-NC 4.0.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rules", F.lit(1))
    got = [(r["doc_id"], r["rules"], r["licenses"]) for r in licenses.scan_licenses(df).orderBy("doc_id").collect()]
    assert [(i, names) for i, _, names in got if i != 8] == [
        (1, ["MIT"]), (2, ["MIT"]), (3, []), (4, []), (5, []), (6, ["Apache-2.0"]), (7, [])]
    assert got[0][1] == ["m03 m04 m05 m06"]
    assert sorted(names for i, _, names in got if i == 8) == [["CC-BY-NC-4.0"], ["CC-BY-NC-4.0", "MIT"]]
    assert licenses.scan_licenses(empty(df)).collect() == []


MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
    "documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation "
    "the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to "
    "permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\n")
NOTICES = {
    "mit": ("m03", "MIT", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + MIT_GRANT),
    "mit, comment": ("m03", "MIT", "/*\n * The MIT License (MIT)\n * Copyright (c) 2020 Some One\n"
                     + "".join(f" * {x}\n" for x in MIT_GRANT.splitlines())),
    "mit, windows": ("m03", "MIT", ("MIT License\n\nCopyright (c) 2020 Some One\n\n" + MIT_GRANT).replace("\n", "\r\n")),
    "gpl3": ("g02 g04 g05", "GPL-3.0-or-later", (
        "Name - what it does\nCopyright (C) 2020  Some One\n\nThis program is free software: you can redistribute it and/or modify"
        "\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of "
        "the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\n"
        "but WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See "
        "the\nGNU General Public License for more details.\n")),
    "mpl": ("p01 p02", "MPL-2.0", (
        "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not "
        "distributed with this\n// file, You can obtain one at https://mozilla.org/MPL/2.0/.\n\ncode")),
    "apache": ("a02 a03 a04 a05", "Apache-2.0", (
        "#  Copyright 2020 Some One\n#\n#  Licensed under the Apache License, Version 2.0 (the \"License\");\n#  you may not use "
        "this file except in compliance with the License.\n#  You may obtain a copy of the License at\n#\n#      "
        "http://www.apache.org/licenses/LICENSE-2.0\n#\n#  Unless required by applicable law or agreed to in writing, software\n"
        "#  distributed under the License is distributed on an \"AS IS\" BASIS,\n#  WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.\n#  See the License for the specific language governing permissions and\n#  limitations under "
        "the License.\n#\n")),
    "bsd": ("b01 b02 b03 b04", "BSD-3-Clause", (
        "BSD 3-Clause License\n\nCopyright (c) 2020, Some One\nAll rights reserved.\n\nRedistribution and use in source and binary "
        "forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions "
        "of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n"
        "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following "
        "disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n3. Neither the name of the "
        "copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this "
        "software without specific prior written permission.\n\nTHIS SOFTWARE")),
}


def test_whole_license_notices(spark):
    rows = [(name, text) for name, (_, _, text) in NOTICES.items()]
    rows += [("not", "Nothing here is\nreleased under\nthe MIT license."), ("wrapped", "None is released under\nthe MIT License\nor so."),
             ("half", "This program is free software: take it.")]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    for name, (rule, license, _) in NOTICES.items():
        assert rule in got[name]["rules"] and got[name]["licenses"] == [license], name
        assert set(rule.split()) <= set(got[name]["sentence_ids"]), name
    assert not any(got[name]["licenses"] for name in ("not", "wrapped", "half"))

"""Fingerprints, edited texts and near groups against plain versions."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from tabsift.llm import fingerprints
from tabsift.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n_chars string, part int, tail string, mark string"


def plain_shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)}


def jaccard(a, b):
    a, b = plain_shingles(a), plain_shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_edits(rows):
    """(id, text, edited text, next text) where ids differ."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for n, (i, t) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        out.append((i, t, t[:len(t) - len(t) // 2] + after[:len(t) // 2], after))
    return out


def check(rows, got):
    wanted = plain_edits(rows)
    assert len(got) == len(wanted)
    by_id = {r["doc_id"]: r for r in got}
    prints = {}
    for i, text, edited, after in wanted:
        r = by_id[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r["fingerprint"]) == (512 if text.strip(" \t\n\v\f\r") else 0)
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert abs(r["near_edited"] - jaccard(text, edited)) < 0.25 and abs(r["near_next"] - jaccard(text, after)) < 0.25
        assert (r["near_edited"] == 1) >= (text == edited) and (r["near_next"] == 1) >= (text == after)
        assert edited not in prints or prints[edited] == r["edited_fingerprint"]
    error = [abs(by_id[i]["near_edited"] - jaccard(t, e)) for i, t, e, _ in wanted]
    assert np.mean(error) < 0.05


def test_fingerprints_of_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES["op12_fingerprints"](spark, sf).collect())


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(2)
    text = lambda n: " ".join("".join(rng.choice(list("abcdé日🙂"), 5)) for _ in range(n))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two three"), (6, "HELLO there you All again"), (7, "hello There you all again"),
            (-9, text(3000)), (2**63 - 1, "largest id of all and more words"), (-(2**63), "smallest id"), (None, "no id here at all ok")]
    rows += [(100 + k, text(int(rng.integers(1, 60)))) for k in range(40)]
    return spark.createDataFrame([(*r, "clash", 1, "clash", "clash") for r in rows], SCHEMA).repartition(5)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("ranges", [1, 4, 60])
def test_fingerprints_of_odd_rows(odd, monkeypatch, ranges):
    monkeypatch.setattr(fingerprints, "RANGES", ranges)
    got = fingerprints.fingerprint_documents(odd).collect()
    check(rows_of(odd), got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[6]["fingerprint"] == by_id[7]["fingerprint"] and by_id[2]["near_edited"] == 1 and by_id[4]["near_next"] == 0


def test_few_rows(odd):
    assert fingerprints.fingerprint_documents(odd.limit(0)).collect() == []
    alone = fingerprints.fingerprint_documents(odd.where("doc_id = 5"), edited_text=True).collect()
    assert [(r["edited"], r["near_next"]) for r in alone] == [("one two" + "one tw", 1.0)]
    kept = fingerprints.fingerprint_documents(odd, keep=("part", "mark", "n_chars"))
    assert kept.columns[:4] == ["doc_id", "part", "mark", "n_chars"] and {r["mark"] for r in kept.collect()} == {"clash"}


def test_repeated_rows_and_ids(spark):
    """Rows of equal id follow each other in the order of their texts' hashes; the same on every run and partitioning."""
    rows = [(k % 7, f"text number {k % 30} with a few words more") for k in range(300)] + [(None, "x y z")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string")
    runs = [sorted(map(repr, fingerprints.fingerprint_documents(df.repartition(n), edited_text=True).collect())) for n in (1, 5)]
    assert runs[0] == runs[1] and len(runs[0]) == 340
    marks = {t: m for t, m in df.selectExpr("text", "xxhash64(text)").distinct().collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), marks[r[1]], r[1]))
    wanted = sorted(t[:len(t) - len(t) // 2] + order[(n + 1) % 340][1][:len(t) // 2] for n, (_, t) in enumerate(order))
    assert sorted(r["edited"] for r in fingerprints.fingerprint_documents(df, edited_text=True).collect()) == wanted


def test_pieces_of_long_texts(monkeypatch):
    rng = np.random.default_rng(5)
    whole = fingerprints.MinHasher()
    for text in (" ".join("w" * int(n) + str(n) for n in rng.integers(1, 40, 900)), "a" * 5000 + " b c", " " * 5000, "x " * 3 + " " * 5000,
                 "long" * 400 + " and " + "long" * 500 + " word", "one two three four five " + " " * 4000):
        monkeypatch.setattr(fingerprints, "PIECE_CHARS", 10**9)
        wanted = whole.signatures([text])
        monkeypatch.setattr(fingerprints, "PIECE_CHARS", 500)
        got = whole.signatures([text, text])
        assert (got[0] == wanted[0]).all() and (got[1] == wanted[1]).all()


def plain_groups(rows, threshold=0.8):
    sets, root = [plain_shingles(t or "") for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                root = [root[a] if r == root[b] else r for r in root]
    held = defaultdict(list)
    for (i, _), r in zip(rows, root):
        held[r].append(i)
    return sorted((i, min(g)) for g in held.values() for i in g)


def test_near_groups(spark):
    """Exact copies, near copies of many kinds, one large group, chains, and texts that are alone."""
    rng = np.random.default_rng(7)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    rows = []
    for g in range(60):
        words = rng.choice(vocabulary, 120).tolist()
        for _ in range(90 if g == 0 else int(rng.integers(1, 6))):
            changed = list(words)
            for k in rng.integers(0, 120, int(rng.integers(0, 4))):
                changed[k] = str(rng.choice(vocabulary))
            rows.append((len(rows), " ".join(changed)))
        words = words[20:] + rng.choice(vocabulary, 6).tolist()  # a chain: like the first ones only in part
        rows.append((len(rows), " ".join(words)))
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, " "), (len(rows) + 3, "few words"), (len(rows) + 4, "Few  words")]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted, got = plain_groups(rows), sorted(map(tuple, fingerprints.near_groups(df).collect()))
    assert [r[0] for r in got] == [r[0] for r in wanted]
    sets = dict(rows)
    assert all(g[1] >= w[1] for g, w in zip(got, wanted)), "no link below the threshold"
    assert sum(g == w for g, w in zip(got, wanted)) >= 0.98 * len(rows)
    assert len(sets) == len(rows) - 1 and len({g for _, g in wanted}) < len(rows) - 100
    assert fingerprints.near_groups(df.limit(0)).collect() == []

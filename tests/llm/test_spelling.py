"""Spelling variants against a plain version."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import re

from tabsift.llm import spelling
from tabsift.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string, word string, n long, form string, root string"


def plain_counts(rows, least=7, one_in=31):
    found = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if one_in and h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= least:
                found[run] += 1
    return found


def plain_variants(rows, least=7, least_n=2, times=10, one_in=31):
    n = {w: c for w, c in plain_counts(rows, least, one_in).items() if c >= least_n}
    holes = defaultdict(set)  # a word without one letter, with the place where it was
    for w in n:
        holes[w, None].add(w)
        for k in range(len(w)):
            holes[w[:k] + w[k + 1:], k].add(w)
    near = defaultdict(set)
    for (rest, k), held in holes.items():
        for w in held:
            near[w] |= held - {w}
            if k is not None and rest in n:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def found(df, **options):
    return sorted(map(tuple, spelling.spelling_variants(df, **options).collect()), key=repr)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_variants_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wanted = plain_variants(rows_of(docs))
    assert sorted(map(tuple, QUERIES["op13_spelling"](spark, sf).collect()), key=repr) == wanted
    assert found(docs, cell_words=200, block_words=90, slice_words=300) == wanted
    assert sum(r[4] for r in wanted) > 100 and any(r[1] for r in wanted)


@pytest.fixture(scope="module")
def odd(spark):
    long = "abcdefghijklmnopqrstuvwxyz" * 900
    rows = [(1, None), (2, ""), (3, "short words only"), (4, "LETTERS letters Letters letterss letters"), (5, "letters " * 40 + "lettars lettars"),
            (6, "naïveté naïveté naivete naivete NAÏVETÉ"), (None, "without number without number letterss"), (7, "日本語 letters日本語letters ½ªº"),
            (8, "ÀÉÎÕÜ÷× àéîõü÷× àéîõü÷× ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿÿ"), (9, long + " " + long + "x"), (9, long + " " + long + "x"),
            (10, "a" * 300 + " " + "a" * 301), (11, "a" * 300 + " " + "a" * 301), (11, "a" * 300 + " " + "a" * 301), (12, "aaaaaaa aaaaaab " * 2),
            (13, "listens silents tinsels enlists " * 3), (14, "x" * 6 + " " + "x" * 7 + " " + "x" * 7)]
    rows += [(100 + k, "chainaa " * 3 + "chainab " * 40 + "chainbb " * 500) for k in range(2)]
    return spark.createDataFrame([(*r, "clash", 1, "clash", "clash") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("options", [{}, {"cell_words": 3, "block_words": 2, "slice_words": 2, "sample_words": 40}])
def test_variants_of_odd_rows(odd, options):
    assert found(odd, **options) == plain_variants(rows_of(odd))
    assert found(odd, least_length=1, least_count=1, form_times=2, delete_one_in=0, **options) == plain_variants(rows_of(odd), 1, 1, 2, 0)


def test_no_rows(odd):
    assert found(odd.limit(0)) == []
    assert found(odd.where("text is null")) == []


def test_forms_lead_to_roots(odd):
    got = {r[0]: r for r in found(odd, delete_one_in=0)}
    assert got["chainaa"][1:3] == ("chainab", "chainbb") and got["chainbb"][2] == "chainbb"


def test_crowds_of_words(spark):
    """Few letters: many words of equal letter counts, and cells of several blocks and slices."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcé"), int(rng.integers(7, 10)))) for _ in range(1500)]
    rows = [(k, " ".join(rng.choice(words, 200))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df, cell_words=60, block_words=25, slice_words=70) == plain_variants(rows)


def test_words_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    rows = [(k, " ".join(f"{'abcdefgh'[(k + m) % 8]}eneral" for m in range(8))) for k in range(20)]
    got = spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string"), delete_one_in=0).collect()
    assert dict(map(tuple, got)) == plain_counts(rows, 7, 0)


def test_boxes_keep_every_edit():
    """A word one edit away is reached, from one side only where the lengths are equal."""
    rng = np.random.default_rng(2)
    words = sorted({bytes(rng.choice(list(b"abcd\xe9"), 6).astype(np.uint8)) for _ in range(400)})
    held = spelling.Words(words)
    cell = spelling.Cell(words, [1] * len(words))
    none = np.full(len(words), spelling.NONE, np.uint8)
    q, p = cell.pairs(held, none, none, True)
    got = sorted(zip(q.tolist(), p.tolist()))
    assert got == sorted((i, j) for i, a in enumerate(words) for j, b in enumerate(words)
                         if sum(x != y for x, y in zip(a, b)) == 1 and a < b)

"""The pipeline stage by stage against plain versions, on small documents with copies, near copies and junk."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from tabsift.llm import mixing
from tabsift.llm.common import staged
from test_text_operators import plain_groups, plain_repeats, tiktoken_library  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 7)))
    passage = " ".join(word() for _ in range(60))
    rows, labels = [], []
    for i in range(240):
        words = [word() for _ in range(int(rng.integers(40, 120)))]
        text = " ".join(words)
        if i % 8 == 7:
            text = " ".join("!!" + w.upper() + "!!" for w in words)
        elif i % 20 == 3:
            text = text + " " + passage + " é " + word()
        rows.append([i, text, "en", None if i % 10 == 9 else f"s{i % 3}", len(text), "x"])
        if i % 2:
            labels.append((i, 0 if i % 8 == 7 else 1, 0))
    for i in range(240, 260):
        words = rows[(i - 240) * 8][1].split()
        if i % 2:
            words[5] = "changed"
        text = " ".join(words)
        rows.append([i, text, "en", "s1", len(text), "x"])
    rows += [[260, "", "en", "s1", 0, "x"], [261, None, "en", None, 0, "x"], [262, None, None, None, None, None], rows[0]]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string").repartition(3).write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def outputs(spark, corpus):
    docs, found = spark.read.parquet(f"{corpus}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, docs, corpus), "test-stage")
        found.append((before, docs))
    return found


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_keep_the_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "suffix-array dedup", "mixing sources to target weights",
        "byte-level BPE encoding and decoding"]
    for before, after in outputs[:-1]:
        assert after.columns == before.columns


def test_quality_stage_drops_junk_and_keeps_text(outputs):
    before, after = (dict(pairs(df)) for df in outputs[0])
    junk = {i for i, t in before.items() if t and t.startswith("!!")}
    gone = set(before) - set(after)
    assert junk <= gone and len(gone - junk) <= 4


def test_near_duplicate_stage_keeps_one_of_each_group(outputs):
    before, after = (pairs(df) for df in outputs[1])
    groups = plain_groups(before)
    filled = {g for i, n, g in groups if n}
    assert sorted(i for i, t in after if t) == sorted(filled)


def test_repeat_stage_removes_long_repeats(outputs):
    before, after = (pairs(df) for df in outputs[2])
    wanted = {i: kept.decode(errors="ignore") for i, _, _, _, kept in plain_repeats(before, 200)}
    assert dict(after) == wanted
    assert any(len(t or "") > len(wanted[i]) for i, t in before)


def test_repeat_stage_keeps_replacement_characters_of_the_text(spark):
    # The repeat starts within a character: é and ĩ end in the same byte.
    long = " ".join(str(k) for k in range(100, 180))
    docs = spark.createDataFrame(
        [(1, f"� one é{long}#end �", "en", "s", 1), (2, f"two ĩ{long}%fin", "en", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long")
    got = dict(pairs(corpus_pipeline.repeated_strings(spark, docs, "")))
    assert got == {1: "� one #end �", 2: "two %fin"}


def test_mix_stage_takes_whole_documents(outputs):
    before, after = (pairs(df) for df in outputs[3])
    texts = dict(before)
    taken = Counter()
    for i, t in after:
        words, whole = t.split(), texts[i].split()
        assert words == whole[:len(words)]
        taken[i] += len(words)
    sizes = {i: len((t or "").split()) for i, t in before}
    assert all(taken[i] <= 2 * n for i, n in sizes.items())
    # Whole copies: a source is off its target by less than its largest document.
    given = outputs[3][0].select("source", mixing.words_in(F.col("text")).alias("size"), "doc_id")
    targets = {r["source"]: r["target"] for r in mixing.source_targets(given.select("source", "size")).collect()}
    held = defaultdict(list)
    for r in given.collect():
        held[r["source"]].append(r["doc_id"])
    for source, ids in held.items():
        assert abs(sum(taken[i] for i in ids) - targets[source]) < max(sizes[i] for i in ids)


def test_mix_stage_keeps_every_text_whole(outputs):
    before, after = (pairs(df) for df in outputs[3])
    assert set(after) <= set(before)


def test_token_stage(outputs, tiktoken_library):  # noqa: F811
    before, after = outputs[4]
    wanted, got = defaultdict(list), defaultdict(list)
    for i, t in pairs(before):
        wanted[i].append((tiktoken_library.encode_ordinary(t or ""), hashlib.sha256((t or "").encode()).hexdigest()))
    for r in after.collect():
        got[r["doc_id"]].append((np.frombuffer(r["token_ids"], "<u4").tolist(), r["decoded_sha256"]))
    assert {i: sorted(v) for i, v in wanted.items()} == {i: sorted(v) for i, v in got.items()}


def test_whole_run_equals_its_stages(spark, corpus, outputs):
    key = lambda df: sorted((r["doc_id"], bytes(r["token_ids"])) for r in df.collect())
    assert key(corpus_pipeline.run(spark, corpus)) == key(outputs[-1][1])


def test_an_empty_table_stays_empty(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, corpus), "test-empty")
        assert docs.count() == 0

"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target, in words; every document of it the same expected number of copies, target / size of
the source. Whole copies are certain, what is left is a probability. Pairs of documents move probability mass
from one to the other, keeping the words they take together, until one of them is decided; the undecided one
goes on to the next pair. Documents are dealt into bounded groups first; what each group leaves undecided (one
document) is rounded again with that of other groups, level by level, up to one document per source.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tabsift.llm.common import staged, words_in

#: Weights of the sources in the order of their names.
WEIGHTS = (5.0, 2.0, 1.0)
#: Documents that one task rounds together.
GROUP_ROWS = 20_000
#: Residual documents that the next level rounds together.
FANOUT = 64
TINY = 1e-9


def source_targets(
    sizes: DataFrame, *, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS
) -> DataFrame:
    """(source, source_size, target) from (source, size): the words that the mix takes of each source.

    Sources in the order of their names, null last, weigh ``weights`` in turn and share ``share`` times all words.
    A target stops at ``most`` times the size of its source; the excess goes to the others by weight, until none
    is above. Only three sums per round reach the driver. No rows: no targets; no words: every target is 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source, so one task can number them.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    table = staged(totals.select("source", "source_size", weight.alias("weight")), "mix-sources")
    limit = F.col("source_size") * most
    all_words = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words per unit of weight; it only rises
    while all_words:
        free, fixed = table.agg(
            F.sum(F.when(F.col("weight") * level <= limit, F.col("weight"))),
            F.sum(F.when(F.col("weight") * level > limit, limit)),
        ).first()
        risen = (share * all_words - (fixed or 0.0)) / free if free else level
        if risen <= level:
            break
        level = risen
    target = F.least(F.col("weight") * level, limit).cast("double")
    return table.select("source", "source_size", target.alias("target"))


def _draw(*key: object) -> float:
    """A number from 0 to 1 that depends on the key alone."""
    import xxhash

    return (xxhash.xxh64_intdigest(repr(key)) >> 11) * 2.0**-53


def _round_group(rows: pd.DataFrame, seed: int, draw_last: bool = False) -> pd.DataFrame:
    """Decide all documents of a group but one; ``p`` of the others is 0 or 1 afterwards. With ``draw_last`` that one
    is drawn with its ``p``."""
    rows = rows.sort_values(["size", "key", "p"], ascending=[False, True, True], kind="stable")
    size, p, key = rows["size"].tolist(), rows["p"].tolist(), rows["key"].tolist()
    held = None  # the undecided document
    for j in range(len(p)):
        if p[j] < TINY or p[j] > 1 - TINY or not size[j]:
            p[j] = float(round(p[j]))
            continue
        if held is None:
            held = j
            continue
        i = held
        # Words that can go from i to j, and from j to i, until one of the two is decided.
        to_j = min(p[i] * size[i], (1 - p[j]) * size[j])
        to_i = min(p[j] * size[j], (1 - p[i]) * size[i])
        moved = to_j if _draw(seed, key[i], key[j], size[i], size[j]) < to_i / (to_i + to_j) else -to_i
        p[i] -= moved / size[i]
        p[j] += moved / size[j]
        for k in (i, j):
            if p[k] < TINY or p[k] > 1 - TINY:
                p[k] = float(round(p[k]))
        held = next((k for k in (j, i) if 0 < p[k] < 1), None)
    if draw_last and held is not None:
        p[held] = float(_draw(seed, "last", key[held], size[held]) < p[held])
    return rows.assign(p=p, open=[0 < x < 1 for x in p])


def mix_sources(
    docs: DataFrame, *, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS,
    seed: int = 17, group_rows: int = GROUP_ROWS, fanout: int = FANOUT, keep: tuple[str, ...] = (),
    whole_copies: bool = False,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and the columns named in ``keep``.

    ``taken`` is the number of words the mix takes, repeats counted. It is a whole number of copies; only the last
    undecided document of a source gives a part of one, so that the source meets its target to a word. With
    ``whole_copies`` that document is drawn too: no copy is cut, a source is off its target by less than one document,
    and every document keeps its expected number of copies. Repeated rows are documents of their own; a null text has no words and gives none; a null source is a source; a null
    doc_id is an id. The same rows give the same mix, however they are dealt over files and tasks.
    """
    sized = staged(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), *keep), "mix-sizes")
    targets = source_targets(sized, share=share, most=most, weights=weights)
    # Rows of equal id and size share their draws.
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        sized["*"], "source_size", "target", copies.alias("copies")
    )
    whole = F.floor(F.col("copies") + TINY)
    rows = rows.select("*", whole.alias("whole"), F.greatest(F.col("copies") - whole, F.lit(0.0)).alias("p"), ids.alias("key"))
    many = math.ceil(max(1, sized.count()) / group_rows)
    deal = F.pmod(F.xxhash64(F.lit(seed), "key", "size"), F.lit(many))
    state = rows.select(*rows.columns, deal.alias("group"))

    def rounded(df: DataFrame, level: int, last: bool) -> DataFrame:
        held = df.select("source", "group", "key", "doc_id", "size", "source_size", "target", "whole", "p", *keep)
        schema = held.withColumn("open", F.lit(True)).schema
        return held.groupBy("source", "group").applyInPandas(
            lambda part: _round_group(part, seed + level, last and whole_copies)[schema.names], schema
        )

    done = None
    level = 0
    while True:
        step = staged(rounded(state, level, many == 1), f"mix-level-{level}")
        decided = step.where("not open") if many > 1 else step
        done = decided if done is None else done.unionByName(decided)
        if many == 1:
            break
        many, level = math.ceil(many / fanout), level + 1
        state = step.where("open").withColumn("group", F.floor(F.col("group") / fanout))
    taken = F.col("whole") * F.col("size") + F.round(F.col("p") * F.col("size")).cast("long")
    return done.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *keep)


def repeat_documents(docs: DataFrame, mixed: DataFrame, key: str) -> DataFrame:
    """The mix as documents: each row of ``docs`` as often as it is taken, a part as the first words of its text.

    ``mixed`` holds ``key``, ``size`` and ``taken`` for every row of ``docs``; other columns of ``docs`` stay.
    """
    plan = mixed.where("taken > 0").select(
        key, F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))).alias("copy__"),
        "size", "taken",
    ).select(key, F.least(F.col("size"), F.col("taken") - (F.col("copy__") - 1) * F.col("size")).alias("words__"),
             F.col("size").alias("size__"))
    words = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    part = F.concat_ws(" ", F.slice(words, F.lit(1), F.col("words__").cast("int")))
    text = F.when(F.col("words__") >= F.col("size__"), F.col("text")).otherwise(part)
    return docs.join(plan, key).withColumn("text", text).drop("words__", "size__")

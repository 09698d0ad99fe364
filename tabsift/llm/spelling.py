"""Spelling variants: words one edit apart, found by k-d trees over letter counts, and the form each word goes back to.

One edit moves the letter counts of a word little: a replaced letter takes one away and adds another, an inserted one
adds one. So near words are searched per pair of lengths (equal, or one apart) in k-d trees over the counts, and a box
is left out when it needs more than one letter added or one taken away. What the boxes leave is verified letter by
letter. The upper levels of the trees, fitted on a bounded sample, deal the words into cells: a word is a point of its
own cell and a query of the few cells its edits can reach. Each cell builds the rest of its tree in its task; cells
with many words are cut into blocks of points and slices of queries, so that a task holds a bounded number of either.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabsift.llm.common import chunks, small_batches, staged

#: Least code points and occurrences of a word, and how many times as frequent a form must be.
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 7, 2, 10
#: Words a cell aims at, points of a block, queries of a slice, and words of a leaf.
CELL_WORDS, BLOCK_WORDS, SLICE_WORDS, LEAF_WORDS = 40_000, 120_000, 1_000_000, 48
#: Words of the sample that the upper levels are fitted on, and least sample words of a cell.
SAMPLE_WORDS, SAMPLE_PER_CELL = 100_000, 32
#: Distinct words counted in a task before they are passed on, text bytes of a chunk, and pairs compared at once.
HELD_WORDS, CHUNK_BYTES, PAIRS_AT_ONCE = 200_000, 2_000_000, 4_000_000
#: Queries searched at once, and bytes of their words.
QUERY_ROWS, QUERY_BYTES = 50_000, 16_000_000
#: A longer word weighs as several words of this length where cells are cut.
USUAL_LENGTH = 64
#: Letters are the code points of a-z and U+00C0 to U+00FF, which Latin-1 has as one byte each.
LETTERS = np.full(256, 255, np.uint8)
LETTERS[97:123] = np.arange(26)
LETTERS[192:256] = 26 + np.arange(64)
DIMENSIONS = 90
NONE = 255


def count_words(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, delete_one_in: int = 31,
) -> DataFrame:
    """(word, n): runs of letters with A-Z in lower case, and how often they occur in all texts.

    With h the crc32 of ``<id>:<run>``, a run loses its code point h % length where ``delete_one_in`` divides h (0: never);
    results shorter than ``least_length`` are no words. A null id counts as empty, a null text as none.
    """
    source = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    small_batches(docs.sparkSession)

    def rows(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least_length)
        held: Counter = Counter()
        for batch in chunks(batches, "text", CHUNK_BYTES):
            for id_, whole in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if not whole:
                    continue
                begin = zlib.crc32(f"{'' if id_ is None else id_}:".encode())
                # Other characters become question marks, which end a run as they do; bytes lower A-Z only.
                found = Counter(runs.findall(whole.encode("latin-1", "replace").lower()))
                for word, n in found.items():
                    if delete_one_in:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), begin)
                        if h % delete_one_in == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least_length:
                                continue
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield rows(held)
                    held = Counter()
        if held:
            yield rows(held)

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """Words of one length as matrices: their bytes, their letter counts (at most 250) and a code of 64 bits.

    Codes of words whose letter counts differ by d in all differ in at most d bits.
    """

    def __init__(self, words: list[bytes]):
        self.letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        self.counts = np.zeros((len(words), DIMENSIONS), np.uint8)
        each = np.arange(len(words))
        for column in LETTERS[self.letters.T]:
            self.counts[each, column] += self.counts[each, column] < 250
        bits = np.zeros((len(words), 64), np.uint8)
        bits[:, :26] = self.counts[:, :26] > 0
        bits[:, 26:52] = self.counts[:, :26] > 1
        for k in range(26, DIMENSIONS):
            bits[:, 52 + k % 12] ^= self.counts[:, k] & 1
        self.codes = np.packbits(bits, axis=1).view(np.uint64).ravel()


def best_cut(counts: np.ndarray) -> tuple[int, int] | None:
    """The dimension and the count up to which words go left that cut the words most evenly; None if all are equal."""
    best, cut = len(counts), None
    for upto in range(6):
        left = (counts <= upto).sum(0)
        uneven = np.abs(2 * left - len(counts))
        at = int(uneven.argmin())
        if uneven[at] < best:
            best, cut = int(uneven[at]), (at, upto)
    if cut is None:
        least, most = counts.min(0), counts.max(0)
        at = int((most - least).argmax())
        if most[at] > least[at]:
            cut = at, int(least[at] + (most[at] - least[at]) // 2)
    return cut


def grow(counts: np.ndarray, rows: np.ndarray, leaf: int, leaves: list[np.ndarray]):
    """A k-d tree of (dimension, upto, left, right); a leaf is its number, and ``leaves`` holds its rows."""
    cut = best_cut(counts[rows]) if len(rows) > leaf else None
    if cut is None:
        leaves.append(rows)
        return len(leaves) - 1
    left = counts[rows, cut[0]] <= cut[1]
    return (*cut, grow(counts, rows[left], leaf, leaves), grow(counts, rows[~left], leaf, leaves))


def own_leaves(tree, counts: np.ndarray) -> np.ndarray:
    """The leaf of each word."""
    found = np.zeros(len(counts), np.int32)

    def down(node, rows):
        if isinstance(node, int):
            found[rows] = node
            return
        left = counts[rows, node[0]] <= node[1]
        down(node[2], rows[left])
        down(node[3], rows[~left])

    down(tree, np.arange(len(counts)))
    return found


def reached(tree, counts: np.ndarray, up: np.ndarray, down: np.ndarray, take: bool, rows: np.ndarray | None = None):
    """Yield (leaf, rows, up, down): the queries whose edits reach a leaf's box.

    A query may add one letter and, if ``take``, take one away; ``up`` and ``down`` are the letters that boxes have
    made it use so far (255: none). Where both are used the added letter is the larger one: the other half of the
    pairs of equal length is found from their other word.
    """
    stack = [(tree, np.arange(len(counts)) if rows is None else rows, up, down)]
    while stack:
        node, at, u, d = stack.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            yield node, at, u, d
            continue
        dim, upto, left, right = node
        value = counts[at, dim].astype(np.int16) + (u == dim) - (d == dim)
        low = value <= upto
        add = (value == upto) & (u == NONE) & ((d == NONE) | (d < dim))
        onto = np.flatnonzero(~low | add)
        stack.append((right, at[onto], np.where(add[onto], np.uint8(dim), u[onto]), d[onto]))
        if take:
            drop = (value == upto + 1) & (d == NONE) & ((u == NONE) | (u > dim))
            onto = np.flatnonzero(low | drop)
            stack.append((left, at[onto], u[onto], np.where(drop[onto], np.uint8(dim), d[onto])))
        else:
            onto = np.flatnonzero(low)
            stack.append((left, at[onto], u[onto], d[onto]))


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows differ in one letter, that of ``b`` being the larger one."""
    differ = a != b
    one = differ.sum(1) == 1
    at = differ.argmax(1)
    each = np.arange(len(a))
    return one & (a[each, at] < b[each, at])


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``b`` are those of ``a`` with one letter more."""
    n = a.shape[1]
    ahead, behind = a == b[:, :n], a == b[:, 1:]
    leading = np.where(ahead.all(1), n, ahead.argmin(1))
    trailing = np.where(behind.all(1), n, behind[:, ::-1].argmin(1))
    return leading + trailing >= n


class Cell:
    """The points of a cell, their tree, and the search of queries in it."""

    def __init__(self, words: list[bytes], counts: list[int]):
        self.names, self.n, self.words = words, np.array(counts, np.int64), Words(words)
        self.leaves: list[np.ndarray] = []
        self.tree = grow(self.words.counts, np.arange(len(words)), LEAF_WORDS, self.leaves)

    def pairs(self, queries: Words, up: np.ndarray, down: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) of the words one edit apart: equally long ones, or points one letter longer."""
        found_q, found_p = [], []
        for leaf, rows, _, _ in reached(self.tree, queries.counts, up, down, same):
            points = self.leaves[leaf]
            codes = self.words.codes[points]
            step = max(1, PAIRS_AT_ONCE // len(points))
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                apart = np.bitwise_count(queries.codes[part][:, None] ^ codes[None, :])
                q, p = np.nonzero(apart <= (2 if same else 1))
                q, p = part[q], points[p]
                true = (replaced if same else inserted)(queries.letters[q], self.words.letters[p])
                found_q.append(q[true])
                found_p.append(p[true])
        none = [np.zeros(0, np.int64)]
        return np.concatenate(found_q or none), np.concatenate(found_p or none)


def nearest(words: list[bytes], mine: np.ndarray, others: list[bytes], n: np.ndarray, theirs: np.ndarray) -> pa.RecordBatch:
    """Per word of ``mine`` its near words, the largest count among them, and the first word of that count."""
    order = np.lexsort((theirs, -n[theirs], mine))  # others are in code-point order
    mine, theirs = mine[order], theirs[order]
    first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
    many = np.diff(np.append(first, len(mine)))
    decode = lambda rows, of: pa.array([of[k].decode("latin-1") for k in rows.tolist()], pa.string())
    return pa.RecordBatch.from_arrays(
        [decode(mine[first], words), pa.array(many, pa.int64()), pa.array(n[theirs[first]], pa.int64()),
         decode(theirs[first], others)], names=["word", "near", "most", "form"])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches joined to about ``QUERY_ROWS`` rows or ``QUERY_BYTES`` bytes."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= QUERY_ROWS or size >= QUERY_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words within cells; rows come sorted: of a cell its points, its queries of equal length, the shorter ones."""
    key, points, cell = None, ([], []), None
    for batch in gathered(batches):
        column = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
        keys = np.stack([column[c].to_numpy(zero_copy_only=False) for c in ("length", "cell", "block", "slice", "kind")], axis=1)
        words = [w.encode("latin-1") for w in column["word"].to_pylist()]
        counts = column["n"].to_numpy()
        up, down = (column[c].to_numpy().astype(np.uint8) for c in ("up", "down"))
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
            now, kind = tuple(keys[begin, :4].tolist()), int(keys[begin, 4])
            if now != key:
                key, points, cell = now, ([], []), None
            mine = words[begin:end]
            if kind == 0:
                points[0].extend(mine)
                points[1].extend(counts[begin:end].tolist())
                continue
            if not points[0]:
                continue
            cell = cell or Cell(*points)
            q, p = cell.pairs(Words(mine), up[begin:end], down[begin:end], kind == 1)
            if len(q):
                yield nearest(mine, q, cell.names, cell.n, p)
                yield nearest(cell.names, p, mine, counts[begin:end], q)


def fit_trees(words: DataFrame, *, cell_words: int, sample_words: int) -> dict:
    """The upper levels of a tree for every length with more than ``cell_words`` words, by a sample of the words."""
    sizes = words.groupBy(F.length("word").alias("length")).count().where(F.col("count") > cell_words)
    sizes = {r["length"]: r["count"] for r in sizes.collect()}  # lengths with many words only
    if not sizes:
        return {}
    share = min(1.0, sample_words / sum(sizes.values()))
    drawn = F.pmod(F.xxhash64(F.lit(5), "word"), F.lit(1_000_000)) < F.lit(max(1, int(share * 1_000_000)))
    sample = words.where(F.length("word").isin(list(sizes)) & drawn).select("word").limit(2 * sample_words).toPandas()["word"]
    trees = {}
    for length, held in sample.groupby(sample.str.len()):
        counts = Words([w.encode("latin-1") for w in held]).counts
        leaf = max(SAMPLE_PER_CELL, int(cell_words * len(held) / sizes[length]))
        trees[int(length)] = grow(counts, np.arange(len(held)), leaf, [])
    return trees


def to_cells(words: DataFrame, trees: dict) -> DataFrame:
    """Each word as a point of its cell (kind 0) and a query of cells of its length (1) and of the next one (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.array([w.encode("latin-1") for w in batch.column("word").to_pylist()], object)
            n = batch.column("n").to_numpy()
            lengths = np.array([len(w) for w in held], np.int64)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                none = np.full(len(rows), NONE, np.uint8)
                counts = Words(held[rows].tolist()).counts if {length, length + 1} & set(trees) else np.zeros((len(rows), 0), np.uint8)
                found = [(length, 0, leaf, at, none[at], none[at]) for leaf, at in cells_of(own_leaves(trees.get(length, 0), counts))]
                for kind in (1, 2):
                    to = length + kind - 1
                    found += [(to, kind, leaf, at, u, d) for leaf, at, u, d in reached(trees.get(to, 0), counts, none, none, kind == 1)]
                for to, kind, leaf, at, u, d in found:
                    many = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(many, to, np.int32)), pa.array(np.full(many, leaf, np.int32)),
                         pa.array(np.full(many, kind, np.int8)), pa.array(u), pa.array(d),
                         batch.column("word").take(pa.array(rows[at])), pa.array(n[rows[at]])],
                        names=["length", "cell", "kind", "up", "down", "word", "n"])

    def cells_of(leaves: np.ndarray):
        return [(leaf, np.flatnonzero(leaves == leaf)) for leaf in np.unique(leaves).tolist()]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):  # Spark has no unsigned bytes
            columns = [c.cast(pa.int16()) if pa.types.is_uint8(c.type) else c for c in batch.columns]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return words.select("word", "n").mapInArrow(
        signed, "length int, cell int, kind byte, up short, down short, word string, n long")


def near_words(
    words: DataFrame, *, cell_words: int = CELL_WORDS, block_words: int = BLOCK_WORDS, slice_words: int = SLICE_WORDS,
    sample_words: int = SAMPLE_WORDS,
) -> DataFrame:
    """(word, n_near, form, form_n) for the distinct ``words`` (word, n) that have a near word: one inserted, deleted or
    replaced letter apart; form is the near word of largest n, ties to the first in code-point order.

    Words are of the letters that ``count_words`` gives.
    """
    trees = fit_trees(words, cell_words=cell_words, sample_words=sample_words)
    dealt = staged(to_cells(words, trees), "spelling-cells")
    place = ["length", "cell"]
    # Cells beyond the bounds are few: their number is the rows over the bound.
    weight = F.greatest(F.lit(1.0), F.col("length") / USUAL_LENGTH)
    large = dealt.groupBy(*place).agg(
        F.ceil(F.sum(F.when(F.col("kind") == 0, weight)) / block_words).cast("int").alias("blocks"),
        F.ceil(F.sum(F.when(F.col("kind") > 0, weight)) / slice_words).cast("int").alias("slices"),
    ).where("blocks > 1 or slices > 1")
    dealt = dealt.join(F.broadcast(large), place, "left").fillna(1, ["blocks", "slices"])
    hashed = F.xxhash64("word")
    own = lambda point, parts: F.when(  # noqa: E731  own part of the words' own kind, every part of the other
        (F.col("kind") == 0) == F.lit(point), F.array(F.pmod(hashed, F.col(parts)).cast("int"))
    ).otherwise(F.sequence(F.lit(0), F.col(parts) - 1))
    dealt = dealt.select("*", F.explode(own(True, "blocks")).alias("block")).select("*", F.explode(own(False, "slices")).alias("slice"))
    key = [*place, "block", "slice"]
    sorted_ = dealt.select(*key, "kind", "up", "down", "word", "n").repartition(*key).sortWithinPartitions(*key, "kind", "word")
    found = sorted_.mapInArrow(search, "word string, near long, most long, form string")
    best = F.min(F.struct((-F.col("most")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def follow(words: DataFrame) -> DataFrame:
    """``words`` (word, form, ...) with root: the word that its forms lead to, itself without one.

    Pointers are doubled: a form occurs more often than its word, so there are no circles and few rounds.
    """
    links = staged(words.where("form is not null").select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(onward, "root", "left").select("word", "root", "next")
        moved = staged(moved, "spelling-links")
        if moved.where("next is not null").limit(1).count() == 0:
            break
        links = moved.select("word", F.coalesce("next", "root").alias("root"))
    return words.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, form_times: int = FORM_TIMES, delete_one_in: int = 31, **cells,
) -> DataFrame:
    """One row per word of all texts: word, form, root, n, n_near, form_n.

    Words are the results of ``count_words`` with ``least_count`` occurrences or more (n). n_near counts the words
    one edit away. The form is the one of them with the largest n, ties to the smallest in code-point order, if that n
    is ``form_times`` the word's or more, else null; root is where forms lead. Null and empty texts have no words, and
    an empty table gives no rows; a repeated row is a document of its own. Other columns are not read. Texts
    and runs may be of any length.
    """
    words = staged(
        count_words(docs, id_col=id_col, text=text, least_length=least_length, delete_one_in=delete_one_in).where(F.col("n") >= least_count),
        "spelling-words")
    known = words.join(near_words(words, **cells), "word", "left")
    formed = F.col("form_n") >= form_times * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("form")).alias("form"),
        F.when(formed, F.col("form_n")).alias("form_n"))
    known = staged(known, "spelling-forms")
    return follow(known).select("word", "form", "root", "n", "n_near", "form_n")

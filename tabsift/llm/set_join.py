"""Jaccard self-join of shingle sets with index-level and answer-level skipping.

Sets with equal shingles are one class. Every class lists the first shingles of its set in one global order, in
which the frequent ones come last; two similar sets share one of them. The list of a shingle is sorted by size, so
that a block of it is skipped as a whole when sizes or positions rule out the threshold. Each class is compared with
one leader first, the least class of its lists. The answers of all classes with that leader are then derived from
their answers with it: how they differ from the leader tells how they differ from each other. Only pairs of a list
with different leaders, in different components, are left; the triangle inequality and small sketches of the sets rule
out most of them before any text is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tabsift.llm.common import chunks, discard, nullable, small_batches, staged
from tabsift.llm.components import components, local_roots
from tabsift.llm.shingles import Shingler

CHUNK_BYTES = 2_000_000
#: Frequent shingles that the order puts last. It bounds what is broadcast; the order never changes the result.
FREQUENT = 65_536
#: Times that a shingle must occur in a chunk to be a candidate for the frequent ones.
OFTEN = 5
#: Classes of one leader that are compared at once.
BLOCK = 1_024
#: Counters of a set's sketch; a counter stops at 255.
COUNTERS = 256


def _class(tokens: np.ndarray) -> int | None:
    if not len(tokens):
        return None
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sketch(tokens: np.ndarray) -> bytes:
    counts = np.bincount((tokens & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    return [t or b"" for t in column.to_pylist()]


def set_classes(docs: DataFrame, *, id_col: str, text: str, width: int) -> DataFrame:
    """Rows (id, n, class, sketch) per document, class null for an empty set, and rows (token, often) of frequent
    shingles. A sketch counts the shingles by their last bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in chunks(batches, text, CHUNK_BYTES):
            sets = shingler.sets(_texts(batch, text))
            tokens, many = np.unique(np.concatenate(sets), return_counts=True)
            tokens, many = tokens[many >= OFTEN].view(np.int64), many[many >= OFTEN]
            rows, extra = batch.num_rows, len(tokens)
            ids = batch.column(batch.schema.get_field_index(id_col))
            yield pa.RecordBatch.from_arrays([
                pa.array([True] * rows + [False] * extra),
                pa.concat_arrays([ids, pa.nulls(extra, ids.type)]),
                pa.concat_arrays([batch.column(batch.schema.get_field_index("text_key")), pa.nulls(extra, pa.int64())]),
                pa.array(np.append([len(s) for s in sets], np.zeros(extra, np.int64)).astype(np.int64)),
                pa.array([_class(s) for s in sets] + [None] * extra, pa.int64()),
                pa.array([None] * rows + tokens.tolist(), pa.int64()),
                pa.array([None] * rows + many.tolist(), pa.int64()),
                pa.array([_sketch(s) for s in sets] + [None] * extra, pa.binary()),
            ], names=["is_doc", "id", "text_key", "n", "class", "token", "often", "sketch"])

    schema = docs.select(F.lit(True).alias("is_doc"), F.col(id_col).alias("id"), *(
        F.lit(0).cast("long").alias(c) for c in ("text_key", "n", "class", "token", "often")),
        F.lit(b"").alias("sketch")).schema
    return docs.select(id_col, text, F.xxhash64(text).alias("text_key")).mapInArrow(
        run, nullable(schema))


def overlap_needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least number of common shingles for a Jaccard similarity of ``percent`` hundredths."""
    return -(-(percent * (n + m)) // (100 + percent))


def prefixes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], *, text: str, width: int, percent: int) -> DataFrame:
    """(token, class, n, pos): the first shingles of every set in the global order, rare ones first."""
    heavy, weight = frequent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(width), set()
        for batch in chunks(batches, text, CHUNK_BYTES):
            out: list[list[np.ndarray]] = [[], [], [], []]
            for tokens in shingler.sets(_texts(batch, text)):
                key = _class(tokens)
                if key is None or key in seen:
                    continue
                seen.add(key)
                n = len(tokens)
                first = n - -(-percent * n // 100) + 1
                if len(heavy):
                    at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
                    rank = np.where(heavy[at] == tokens, weight[at], 0)
                    tokens = tokens[np.argsort(rank, kind="stable")]
                tokens = tokens[:first].view(np.int64)
                out[0].append(tokens)
                out[1].append(np.full(len(tokens), key, np.int64))
                out[2].append(np.full(len(tokens), n, np.int32))
                out[3].append(np.arange(len(tokens), dtype=np.int32))
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in out], names=["token", "class", "n", "pos"])

    return docs.select(text).mapInArrow(run, "token long, class long, n int, pos int")


def _lists(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Whole lists from rows sorted by token: the last token of a batch waits for the next batch."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names}
        token = rows["token"]
        last = np.searchsorted(token, token[-1])
        if last == 0 and held and held[-1]["token"][-1] == token[-1]:
            held.append(rows)
            continue
        cut = int(last)
        held.append({c: v[:cut] for c, v in rows.items()})
        yield {c: np.concatenate([h[c] for h in held]) for c in names}
        held = [{c: v[cut:] for c, v in rows.items()}]
    if held:
        yield {c: np.concatenate([h[c] for h in held]) for c in names}


def _feasible(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and positions allow the pair, the token being the first one it shares."""
    n, m = rows["n"][i].astype(np.int64), rows["n"][j].astype(np.int64)
    room = np.minimum(n - rows["pos"][i], m - rows["pos"][j])  # this shingle and those after it
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (room >= overlap_needed(n, m, percent))


def _spans(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the place of its list's first row, and the length of its list."""
    new = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    many = np.diff(np.append(new, len(token)))
    return np.repeat(new, many), np.repeat(many, many)


def _sorted_lists(rows: DataFrame) -> DataFrame:
    return rows.repartition("token").sortWithinPartitions("token", "n", "pos", "class")


def shared_lists(rows: DataFrame) -> DataFrame:
    """The rows of all lists with at least two classes, each class once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _lists(batches, ["token", "class", "n", "pos"]):
            if not len(part["token"]):
                continue
            same = (part["token"][1:] == part["token"][:-1]) & (part["class"][1:] == part["class"][:-1])
            part = {c: v[np.concatenate([[True], ~same])] for c, v in part.items()}
            stay = _spans(part["token"])[1] > 1
            yield pa.RecordBatch.from_arrays([pa.array(v[stay]) for v in part.values()], names=list(part))

    return _sorted_lists(rows).mapInArrow(run, "token long, class long, n int, pos int")


def leaders(lists: DataFrame, percent: int) -> DataFrame:
    """(class, leader): for every class the least class that heads one of its lists, is below it and may be similar.

    The head of a list is its least class, so the classes of one group mostly agree on a leader.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _lists(batches, ["token", "class", "n", "pos"]):
            size = len(part["token"])
            if not size:
                continue
            head, many = _spans(part["token"])
            starts = np.flatnonzero(head == np.arange(size))
            order = np.lexsort((part["class"], head))  # each list again, by class
            least = np.repeat(order[starts], many[starts])
            mine = np.flatnonzero(least != np.arange(size))
            mine = mine[_feasible(part, mine, least[mine], percent)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part["class"][mine]), pa.array(part["class"][least[mine]])], names=["class", "leader"])

    found = _sorted_lists(lists).mapInArrow(run, "class long, leader long")
    return found.groupBy("class").agg(F.min("leader").alias("leader"))


def _pairs(key: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    a, b = np.minimum(key[i], key[j]), np.maximum(key[i], key[j])
    both = np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def other_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: all pairs of a list that sizes, positions and known answers leave open.

    Rows come with ``root``, the component so far, ``leader`` and ``far``, the distance to it. Pairs of one component
    need no answer, and pairs of one leader have one. A pair whose leaders are compared themselves is skipped where
    the triangle inequality of the Jaccard distance rules it out (``above`` and ``above_far``: the leader's leader).
    """
    names = ["token", "class", "n", "pos", "root", "leader", "far", "above", "above_far"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slack = 1 - percent / 100 + 1e-9
        for part in _lists(batches, names):
            # Lists whose sets are all linked, or all answered, are skipped as a whole.
            for column in ("root", "leader"):
                size = len(part["token"])
                if not size:
                    break
                new = np.flatnonzero(np.concatenate([[True], part["token"][1:] != part["token"][:-1]]))
                mixed = np.minimum.reduceat(part[column], new) != np.maximum.reduceat(part[column], new)
                stay = np.repeat(mixed, np.diff(np.append(new, size)))
                part = {c: v[stay] for c, v in part.items()}
            size = len(part["token"])
            if not size:
                continue
            head, many = _spans(part["token"])
            ends = head + many
            n = part["n"].astype(np.int64)
            root, leader, far, above, above_far = (part[c] for c in names[4:])
            # Rows of a list are sorted by size: partners are the run of rows with sizes up to n / t, the rest of
            # the list is skipped as one block.
            for step in range(1, int(many.max())):
                i = np.flatnonzero(np.arange(size) + step < ends)
                i = i[100 * n[i] >= percent * n[i + step]]
                if not len(i):
                    break
                j = i + step
                good = (root[i] != root[j]) & (leader[i] != leader[j])
                i, j = i[good], j[good]
                good = _feasible(part, i, j, percent)
                i, j = i[good], j[good]
                known = far[i] + far[j] + slack
                apart = ((above[i] == leader[j]) & (above_far[i] > known)) | ((above[j] == leader[i]) & (above_far[j] > known))
                i, j = i[~apart], j[~apart]
                if len(i):
                    yield _pairs(part["class"], i, j)

    return _sorted_lists(lists).mapInArrow(run, "a long, b long").distinct()


def possible_pairs(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sketches (class, n, sketch) leave open.

    The counters of two sets differ by no more than the shingles that only one of them has, and for a link those
    are at most (100 - percent) / (100 + percent) of both sizes together.
    """
    mine = lambda side: sketches.select(*(F.col(c).alias(f"{c}_{side}") for c in ("class", "n", "sketch")))
    rows = pairs.join(mine("a"), F.col("a") == F.col("class_a")).join(mine("b"), F.col("b") == F.col("class_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                          for c in ("sketch_a", "sketch_b"))
            apart = np.abs(one.astype(np.int16) - other).sum(1, dtype=np.int64)
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            stay = pa.array((100 + percent) * apart <= (100 - percent) * sizes)
            yield batch.select(["a", "b"]).filter(stay)

    return rows.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


ANSWER = "a long, b long, n_a long, n_b long, shared long, only_a binary, only_b binary"


def verified(pairs: DataFrame, texts: DataFrame, *, width: int, percent: int, differences: bool = False) -> DataFrame:
    """The pairs with the sizes of their sets and of what they share, whether they link and, if asked for, the
    shingles that only one of the two has. The text of a goes to where that of b is."""
    left = texts.select(F.col("class").alias("a"), F.col("packed").alias("packed_a"))
    right = texts.select(F.col("class").alias("b"), F.col("packed").alias("packed_b"))
    rows = pairs.join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, unpack = Shingler(width), zstandard.ZstdDecompressor()
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            plain = dict(zip(a, batch.column("packed_a").to_pylist())) | dict(zip(b, batch.column("packed_b").to_pylist()))
            sets, lot, held = {}, [], 0
            for key, packed in plain.items():
                lot.append((key, unpack.decompress(packed)))
                held += len(lot[-1][1])
                if held > CHUNK_BYTES:
                    sets |= zip([k for k, _ in lot], shingler.sets([t for _, t in lot]))
                    lot, held = [], 0
            if lot:
                sets |= zip([k for k, _ in lot], shingler.sets([t for _, t in lot]))
            out: list[list] = [[], [], [], [], []]
            for x, y in zip(a, b):
                one, other = sets[x], sets[y]
                both = np.intersect1d(one, other, assume_unique=True)
                out[0].append(len(one)), out[1].append(len(other)), out[2].append(len(both))
                for place, mine in ((3, one), (4, other)):
                    out[place].append(np.setdiff1d(mine, both, assume_unique=True).tobytes() if differences else None)
            kinds = [pa.int64()] * 3 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=["a", "b", "n_a", "n_b", "shared", "only_a", "only_b"])

    found = rows.select("a", "b", "packed_a", "packed_b").mapInArrow(run, ANSWER)
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return found.withColumn("link", 100 * F.col("shared") >= percent * union)


def _derive(part: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the classes of two blocks (or inside one) that have the same leader, as stars.

    Of two sets what they share follows from what each lacks of the leader's set and has besides it:
    |x y| = |h| - |h - x| - |h - y| + |(h - x)(h - y)| + |(x - h)(y - h)|. No set is looked at again.
    """
    first, second = part["b1"].iloc[0], part["b2"].iloc[0]
    a = np.flatnonzero(part["block"].to_numpy() == first)
    b = a if first == second else np.flatnonzero(part["block"].to_numpy() == second)
    none = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    if not len(a) or not len(b):
        return none
    size = part["n"].to_numpy()
    lacks = np.array([len(x) // 8 for x in part["lacks"]])
    # What is lacking and what is besides are apart: a token can't be both for one leader.
    tokens = [np.frombuffer(x + y, np.int64) for x, y in zip(part["lacks"], part["besides"])]
    owner = np.repeat(np.arange(len(part)), [len(t) for t in tokens])
    order = np.argsort(np.concatenate(tokens), kind="stable") if len(owner) else np.zeros(0, np.int64)
    ranked, owner = np.concatenate(tokens)[order] if len(order) else order, owner[order]
    cuts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])) if len(order) else np.zeros(1, int)
    place = np.full(len(part), -1)
    place[a] = np.arange(len(a))
    column = np.full(len(part), -1)
    column[b] = np.arange(len(b))
    common = np.zeros((len(a), len(b)), np.int32)
    for begin, end in zip(cuts[:-1], cuts[1:]):
        if end - begin > 1:
            rows, columns = place[owner[begin:end]], column[owner[begin:end]]
            common[np.ix_(rows[rows >= 0], columns[columns >= 0])] += 1
    shared = part["n_leader"].iloc[0] - lacks[a][:, None] - lacks[b][None, :] + common
    union = size[a][:, None] + size[b][None, :] - shared
    i, j = np.nonzero(100 * shared >= percent * union)
    i, j = a[i], b[j]
    i, j = i[i != j], j[i != j]
    root = local_roots(i, j, len(part))
    ids = part["class"].to_numpy()
    linked = np.flatnonzero(root != np.arange(len(part)))
    return pd.DataFrame({"a": ids[linked], "b": ids[root[linked]]})


def derived_links(answers: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """(a, b): links between classes of one leader, from their answers with it.

    Classes that link to the leader are one component with it, so no pair of these is derived: a group of near copies
    costs nothing, however large. Classes that do not link to it meet each other and those that do, by pairs of blocks;
    their blocks come first.
    """
    mine = answers.select(
        F.col("b").alias("leader"), F.col("a").alias("class"), F.col("n_a").alias("n"), F.col("n_b").alias("n_leader"),
        F.col("only_b").alias("lacks"), F.col("only_a").alias("besides"), "link")
    blocks = lambda members: F.ceil(members / block).cast("int")
    sizes = mine.groupBy("leader").agg(
        F.count_if(~F.col("link")).alias("apart"), F.count_if("link").alias("linked")).where(
        "apart > 0 and apart + linked > 1").select(
        "leader", blocks(F.col("apart")).alias("first"), blocks(F.col("linked")).alias("second"))
    place = F.xxhash64("class")
    dealt = mine.join(sizes, "leader").withColumn("block", F.when(
        F.col("link"), F.col("first") + F.pmod(place, F.greatest("second", F.lit(1)))).otherwise(
        F.pmod(place, F.col("first"))).cast("int"))
    last = F.when(F.col("link"), F.col("first")).otherwise(F.col("first") + F.col("second")) - 1
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last))).select(
        "leader", "class", "n", "n_leader", "lacks", "besides", "block",
        F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"))
    return pairs.groupBy("leader", "b1", "b2").applyInPandas(lambda part: _derive(part, percent), "a long, b long")


def packed_texts(docs: DataFrame, wanted: DataFrame, *, text: str) -> DataFrame:
    """(class, packed): the compressed text of one document of each wanted (class, text_key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [pack.compress(t) for t in _texts(batch, text)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), pa.array(packed, pa.binary())], names=["text_key", "packed"])

    packed = docs.select(F.xxhash64(text).alias("text_key"), text).mapInArrow(run, "text_key long, packed binary")
    return packed.join(wanted, "text_key").select("class", "packed").dropDuplicates(["class"])


def jaccard_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85
) -> DataFrame:
    """One row per document: id_col, n_shingles, component_id.

    Documents link when their sets of ``width``-word shingles have a Jaccard similarity of ``percent`` hundredths
    or more; component_id is the smallest id that links reach. A document with fewer words has all of them as its
    one shingle; without words, also with a null text, its set is empty and links with nothing. Repeated rows are
    documents of their own and link. A null id takes part, but is no component_id unless its whole component has
    none. An empty table gives no rows. Shingles and sets are compared by 64-bit numbers.
    """
    small_batches(docs.sparkSession)
    source = docs.select(id_col, text)
    rows = staged(set_classes(source, id_col=id_col, text=text, width=width), "shingle-sets")
    own = rows.where("is_doc").select("id", "text_key", "n", "class")
    often = rows.where("not is_doc").groupBy("token").agg(F.sum("often").alias("often"))
    top = often.orderBy(F.col("often").desc(), "token").limit(FREQUENT).toPandas()
    heavy = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(heavy)
    frequent = heavy[order], top["often"].to_numpy(np.int64)[order]
    lists = staged(shared_lists(
        prefixes(source, frequent, text=text, width=width, percent=percent)), "shingle-lists")
    # Ids may repeat with other texts, so texts are found by a number of their own.
    classes = own.where("class is not null").groupBy("class").agg(F.min("id").alias("id"), F.min("text_key").alias("text_key"))
    wanted = lists.select("class").distinct().join(classes, "class").select("class", "text_key")
    texts = staged(packed_texts(source, wanted, text=text), "shingle-texts")
    # One comparison per class; what follows is derived from the answers where it can be.
    led = leaders(lists, percent).select(F.col("class").alias("a"), F.col("leader").alias("b"))
    answers = staged(verified(led, texts, width=width, percent=percent, differences=True), "set-answers")
    edges = answers.where("link").select("a", "b").union(derived_links(answers, percent))
    roots = components(edges)
    # The differences were for the derived links, which are in the components by now.
    full, answers = answers, staged(answers.drop("only_a", "only_b"), "set-answers-led")
    discard(full)
    distance = 1 - F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))
    near = answers.select(F.col("a").alias("class"), F.col("b").alias("leader"), distance.alias("far"))
    above = near.select(F.col("class").alias("leader"), F.col("leader").alias("above"), F.col("far").alias("above_far"))
    near = near.join(above, "leader", "left")
    open_lists = lists.join(roots.withColumnRenamed("node", "class"), "class", "left").join(near, "class", "left").select(
        "token", "class", "n", "pos", F.coalesce("root", "class").alias("root"),
        F.coalesce("leader", "class").alias("leader"), F.coalesce("far", F.lit(0.0)).alias("far"),
        F.coalesce("above", "leader", "class").alias("above"), F.coalesce("above_far", "far", F.lit(0.0)).alias("above_far"))
    asked = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = other_pairs(open_lists, percent).join(asked, ["a", "b"], "left_anti")
    sketches = rows.where("is_doc and class is not null").groupBy("class").agg(
        F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    more = possible_pairs(more, sketches, percent)
    rest = staged(verified(more, texts, width=width, percent=percent), "set-answers-rest").where("link").select("a", "b")
    # The components so far are edges of their own.
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(rest))
    known = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "id", F.coalesce("root", "class").alias("root"))
    smallest = known.groupBy("root").agg(F.min("id").alias("component_id"))
    known = known.join(smallest, "root").select("class", "component_id")
    return own.join(known, "class", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))

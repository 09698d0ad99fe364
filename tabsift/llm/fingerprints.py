"""Document fingerprints by MinHash, documents edited with the text that follows, and near copies by signature bands.

A signature holds, for each of many hash permutations, the least hash of a text's word shingles; two signatures agree in
about as many places as the shingle sets are similar. numpy takes the minima of many texts at once. Each document's next
one is found by dealing the rows into ranges of the order and sorting them there: the cuts are keys of rows that
exist, so the row that follows a range is known and is sent to it as well.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabsift.llm.common import WORD, chunks, nullable, small_batches, staged
from tabsift.llm.components import components
from tabsift.llm.shingles import Shingler, _mix

#: Words of a shingle, permutations, and bits of a minimum that a fingerprint keeps.
WIDTH, PERMUTATIONS, BITS = 5, 128, 16
#: Text bytes hashed at once; longer texts are hashed in pieces that overlap by a shingle.
CHUNK_BYTES, PIECE_CHARS = 1_000_000, 1_000_000
#: Ranges of the order per shuffle partition, sample rows per range, and rows of the whole sample.
RANGES, SAMPLE_PER_RANGE, SAMPLE_ROWS = 4, 10, 500_000
#: Bands of a signature, similarity of near copies, and how much faster each round's leaders grow.
BANDS, THRESHOLD, FASTER = 32, 0.8, 8
WORDS = re.compile(WORD)
ID, REST = "document_id", "document_rest"
MADE = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited")


class MinHasher:
    """Signatures of texts: minima of permutations a * x + b (a odd) of the 32-bit numbers, over shingles of words."""

    def __init__(self, width: int = WIDTH, permutations: int = PERMUTATIONS, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.factors = draw.integers(0, 2**32, permutations, dtype=np.uint32) | np.uint32(1)
        self.terms = draw.integers(0, 2**32, permutations, dtype=np.uint32)
        self.shingler, self.width = Shingler(width), width

    def pieces(self, text: str) -> list[str]:
        """The text, or overlapping parts of a long one that have its shingles together; words stay whole."""
        if len(text) <= PIECE_CHARS:
            return [text]
        found, begin, fresh = [], 0, 0
        starts: deque[int] = deque(maxlen=self.width)
        for word in WORDS.finditer(text):
            starts.append(word.start())
            fresh += 1
            if word.end() - begin >= PIECE_CHARS and len(starts) == self.width:
                found.append(text[begin:word.end()])
                # The next part begins with the words that shingles over the cut begin with.
                begin, fresh = starts[1] if self.width > 1 else word.end(), 0
        return [*found, text[begin:]] if fresh or not found else found

    def shingles(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of the texts one after the other, repeats included, and how many each text has."""
        words, upto = self.shingler.words(texts)
        many = np.diff(np.concatenate([[0], upto]))
        whole = np.zeros(max(0, len(words) - self.width + 1), np.uint64)
        for k in range(self.width):
            whole += words[k:k + len(whole)] * self.shingler.place[k]
        whole = _mix(whole)
        begin = upto - many
        found = np.where(many >= self.width, many - self.width + 1, np.minimum(many, 1))
        at = np.repeat(begin - np.concatenate([[0], np.cumsum(found)[:-1]]), found) + np.arange(found.sum())
        short = np.repeat((many > 0) & (many < self.width), found)
        out = np.zeros(len(at), np.uint64)
        out[~short] = whole[at[~short]]
        place = self.shingler.place
        with np.errstate(over="ignore"):
            few = [(words[b:b + n] * place[:n]).sum(dtype=np.uint64) + place[-1] * np.uint64(n)
                   for b, n in zip(begin.tolist(), many.tolist()) if 0 < n < self.width]
        out[short] = _mix(np.array(few, np.uint64))
        return out, found

    def signatures(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The minima of each text (rows) and which texts have any word."""
        minima = np.full((len(texts), len(self.factors)), 2**32 - 1, np.uint32)
        worded = np.zeros(len(texts), bool)
        held, rows, size = [], [], 0
        for row, text in enumerate(texts):
            for piece in self.pieces(text):
                held.append(piece.encode())
                rows.append(row)
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    self._lower(held, rows, minima, worded)
                    held, rows, size = [], [], 0
        if held:
            self._lower(held, rows, minima, worded)
        return minima, worded

    def _lower(self, held: list[bytes], rows: list[int], minima: np.ndarray, worded: np.ndarray) -> None:
        shingles, many = self.shingles(held)
        some = np.flatnonzero(many)
        if not len(some):
            return
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        starts = (np.cumsum(many) - many)[some]
        at = np.array(rows)[some]
        worded[at] = True
        room = np.empty_like(x)
        for k, (a, b) in enumerate(zip(self.factors, self.terms)):
            np.multiply(x, a, out=room)
            np.add(room, b, out=room)
            np.minimum.at(minima[:, k], at, np.minimum.reduceat(room, starts))


def likeness(a: np.ndarray, b: np.ndarray, a_worded: np.ndarray, b_worded: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The share of places in which fingerprints agree, less what chance gives; 1 for two without words, 0 for one."""
    agree = (a == b).mean(1) if len(a) else np.zeros(0)
    chance = 2.0 ** -bits
    share = np.clip((agree - chance) / (1 - chance), 0, 1)
    return np.where(a_worded & b_worded, share, (a_worded == b_worded).astype(float))


def _ordered(docs: DataFrame, id_col: str, text: str, keep: tuple[str, ...]) -> DataFrame:
    """The rows with their key in the order: no_id, turned (falling ids), mark (a hash of the text)."""
    id_ = F.col(id_col).cast("long")
    return docs.select(
        F.col(id_col).alias(ID), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`") for c in keep)).alias(REST),
        id_.isNull().alias("no_id"), F.coalesce(F.bitwise_not(id_), F.lit(0)).alias("turned"),
    ).withColumn("mark", F.xxhash64("text"))


def _ranges(rows: DataFrame) -> tuple[tuple | None, list[tuple]]:
    """The first key of the order, and the keys that cut it into ranges, from a sample of bounded size."""
    spark = rows.sparkSession
    least, many = rows.agg(F.min(F.struct("no_id", "turned")), F.count(F.lit(1))).first()
    if least is None:
        return None, []
    at_first = F.col(ID).isNull() if least["no_id"] else F.col(ID) == F.lit(~least["turned"])
    first = (least["no_id"], least["turned"], rows.where(at_first).agg(F.min("mark")).first()[0])
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, min(SAMPLE_PER_RANGE * ranges, SAMPLE_ROWS) / many)
    drawn = rows.select("no_id", "turned", "mark")
    drawn = sorted({tuple(r) for r in (drawn.sample(share, seed=3) if share < 1 else drawn).collect()} - {first})
    step = max(1, -(-len(drawn) // ranges))
    return first, drawn[::step]


def next_texts(rows: DataFrame) -> DataFrame:
    """The rows of ``_ordered`` dealt into ranges and sorted there, with part and tail.

    tail marks copies of the rows that follow a range (the first row of all follows the last range).
    """
    first, cuts = _ranges(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("no_id", "turned", "mark"))))
            own = [bisect_right(cuts, key) for key in keys]
            # A cut's own row begins a range, so it ends the one before; the first row of all ends the last one.
            ends = [(n, part - 1) for n, (key, part) in enumerate(zip(keys, own)) if part and cuts[part - 1] == key]
            ends += [(n, len(cuts)) for n, key in enumerate(keys) if key == first]
            for places, parts, tail in ((range(len(keys)), own, False), (*(zip(*ends) if ends else ((), ())), True)):
                if len(parts):
                    held = batch.take(pa.array(list(places)))
                    yield pa.RecordBatch.from_arrays(
                        [*held.columns, pa.array(list(parts), pa.int32()), pa.array([tail] * len(parts))],
                        names=[*batch.schema.names, "part", "tail"])

    schema = rows.select("*", F.lit(0).alias("part"), F.lit(True).alias("tail")).schema
    dealt = rows.mapInArrow(run, nullable(schema))
    return dealt.repartition("part").sortWithinPartitions("part", "tail", "no_id", "turned", "mark", "text")


def fingerprint_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), width: int = WIDTH,
    permutations: int = PERMUTATIONS, edited_text: bool = False,
) -> DataFrame:
    """One row per document: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document's;
    documents follow each other by falling id (null last; equal ids by a hash of the text, then by the text), the first
    comes after the last. fingerprint is the lower 16 bits of each minimum as hex, empty for a text without words.
    near_edited and near_next are the likeness of the document's fingerprint to those of the edited text and of the next
    document. Null texts count as empty; a single document follows itself; repeated rows are documents of their own; an
    empty table gives no rows. ``keep`` names columns to carry along (but those above), ``edited_text`` adds the text as
    edited. Ids are whole numbers.
    """
    small_batches(docs.sparkSession)
    keep = tuple(c for c in keep if c not in MADE)
    rows = next_texts(_ordered(docs, id_col, text, keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(width, permutations)
        part = held = None  # the last row of the range so far: its columns, text, signature
        for batch in chunks(batches, "text", CHUNK_BYTES):
            column = {c: batch.column(batch.schema.get_field_index(c)) for c in (ID, REST, "text", "part", "tail")}
            parts, tails = column["part"].to_numpy(), column["tail"].to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(parts[1:] != parts[:-1]) + 1
            for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(parts)]):
                if parts[begin] != part:
                    part, held = int(parts[begin]), None
                own = int((~tails[begin:end]).sum())
                many = own + (own < end - begin)  # of the rows after the range only the first
                if not own and held is None:
                    continue
                texts = column["text"].slice(begin, many).to_pylist()
                minima, worded = hasher.signatures(texts)
                before = ([held["row"]] if held else []) + [
                    pa.RecordBatch.from_arrays([column[ID].slice(begin, own), column[REST].slice(begin, own)], names=[ID, REST])]
                given = pa.Table.from_batches(before).combine_chunks()
                if held:
                    texts = [held["text"], *texts]
                    minima, worded = np.concatenate([held["minima"], minima]), np.concatenate([held["worded"], worded])
                ready = len(texts) - 1
                if ready:
                    yield finished(hasher, given.slice(0, ready), texts, minima, worded)
                held = None if own < many else {
                    "row": given.slice(ready).combine_chunks().to_batches()[0], "text": texts[-1], "minima": minima[-1:], "worded": worded[-1:]}

    def finished(hasher: MinHasher, given: pa.Table, texts: list[str], minima: np.ndarray, worded: np.ndarray) -> pa.RecordBatch:
        """All texts but the last, which only follows."""
        edited = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for t, after in zip(texts, texts[1:])]
        changed, changed_worded = hasher.signatures(edited)
        own, other = (m.astype(np.uint16) for m in (minima, changed))
        hexed = lambda prints, some: pa.array([p.astype(">u2").tobytes().hex() if w else "" for p, w in zip(prints, some)])
        made = {
            "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
            "fingerprint": hexed(own[:-1], worded[:-1]), "edited_fingerprint": hexed(other, changed_worded),
            "near_edited": pa.array(likeness(own[:-1], other, worded[:-1], changed_worded)),
            "near_next": pa.array(likeness(own[:-1], own[1:], worded[:-1], worded[1:])),
            "edited": pa.array(edited if edited_text else [None] * len(edited), pa.string()),
        }
        flat = given.combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([*flat.columns, *made.values()], names=[*flat.schema.names, *made])

    text_, number = F.lit("").alias, F.lit(0.0).alias
    schema = rows.select(
        ID, REST, F.lit(0).cast("long").alias("n_chars"), text_("edited_sha256"), text_("fingerprint"), text_("edited_fingerprint"),
        number("near_edited"), number("near_next"), text_("edited")).schema
    found = rows.select(ID, REST, "text", "part", "tail").mapInArrow(run, nullable(schema))
    return found.select(
        F.col(ID).alias(id_col), *(F.col(f"{REST}.`{c}`") for c in keep), *MADE[:None if edited_text else -1])


def near_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, permutations: int = PERMUTATIONS,
    bands: int = BANDS, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: id_col, group_id. Documents whose shingle sets have a Jaccard similarity of ``threshold``
    or more, found by their bands and verified, are in one group, named by its smallest id.

    Equal texts are one class. In each bucket of a band the classes are compared with a leader; those that are like none
    stay for the next round, with several times the leaders, until none is left: a large group of near copies costs a
    pair each, and no group emits all its pairs. Two classes whose signatures share no band are not compared: of pairs of
    similarity 0.8, 32 bands of 4 miss less than one in a million; so may be the one link between two classes that are
    each like a leader of their own. Texts without words are alone, equal or not; a group of null ids only has none.
    """
    small_batches(docs.sparkSession)
    each = permutations // bands

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            keys = [hashlib.blake2b(t.encode(), digest_size=16).digest() if WORDS.search(t) else None for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), batch.column(1)], names=["id", "key", "text"])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(width, permutations)
        for batch in chunks(batches, "text", CHUNK_BYTES):
            minima, _ = hasher.signatures(batch.column(1).to_pylist())
            hashes = [[int.from_bytes(hashlib.blake2b(row[b * each:(b + 1) * each].tobytes(), digest_size=8).digest(), "little", signed=True)
                       for b in range(bands)] for row in minima]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.list_(pa.int64()))], names=["key", "bands"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in chunks(batches, "text", CHUNK_BYTES):
            found = shingler.sets([t.encode() for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in found], pa.binary())], names=["key", "shingles"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                near.append(both >= threshold * (len(a) + len(b) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near)], names=["key", "first", "near"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    given = rows.mapInArrow(keyed, nullable(rows.select("id", F.lit(b"").alias("key"), "text").schema))
    classes = staged(given.where("key is not null").groupBy("key").agg(F.min("text").alias("text")), "print-classes")
    prints = staged(classes.select("key", "text").mapInArrow(signed, "key binary, bands array<long>"), "print-bands")
    shingles = classes.select("key", "text").mapInArrow(sets, "key binary, shingles binary")
    bucket, leaders, edges = ["band", "hash"], 1, []
    members = prints.select("key", F.posexplode("bands").alias(*bucket))
    while True:
        crowds = members.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = staged(members.join(crowds, bucket), "print-buckets")
        if members.isEmpty():
            break
        # A place among the members that is drawn anew each round: the least one leads, and about ``leaders`` more.
        placed = members.withColumn("place", F.pmod(F.xxhash64(F.lit(leaders), "key", *bucket), F.lit(2**31)))
        least = placed.groupBy(*bucket).agg(F.min(F.struct("place", "key")).alias("least"))
        first = placed.where(F.col("place") * F.col("n") < float(2**31) * (leaders - 1)).select(*bucket, F.col("key").alias("leader")).union(
            least.select(*bucket, "least.key")).distinct()
        asked = staged(members.select("key", *bucket).join(first, bucket), "print-asked")
        pairs = asked.where("key <> leader").select("key", "leader").distinct()
        both = pairs.join(shingles, "key").withColumnRenamed("shingles", "mine").join(
            shingles.select(F.col("key").alias("leader"), F.col("shingles").alias("theirs")), "leader")
        known = staged(both.select("key", "leader", "mine", "theirs").mapInArrow(compared, "key binary, leader binary, near boolean"), "print-pairs")
        edges.append(known.where("near").select("key", "leader"))
        # Leaders have met all of their bucket; those near one of them are linked to it.
        done = F.max(F.coalesce("near", F.lit(True)))
        left = asked.join(known, ["key", "leader"], "left").groupBy("key", *bucket).agg(done.alias("done")).where(~F.col("done"))
        members, leaders = staged(left.select("key", *bucket), "print-members"), leaders * FASTER
    return _named(given.select("id", "key"), edges, id_col)


def _named(given: DataFrame, edges: list[DataFrame], id_col: str) -> DataFrame:
    """The documents with the smallest id of their group."""
    number = lambda c: F.xxhash64(F.lit(9), c)
    out = given.where("key is not null").withColumn("node", number("key"))
    if edges:
        all_edges = reduce(DataFrame.union, edges)
        roots = components(all_edges.select(number("key").alias("a"), number("leader").alias("b")))
        out = out.join(roots, "node", "left").withColumn("node", F.coalesce("root", "node"))
    out = out.join(out.groupBy("node").agg(F.min("id").alias("group_id")), "node").select("id", "group_id")
    alone = given.where("key is null").select("id", F.col("id").alias("group_id"))
    return out.union(alone).select(F.col("id").alias(id_col), "group_id")

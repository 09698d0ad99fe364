"""Suffix-array dedup: repeated strings of a given length, by merging Burrows-Wheeler transforms of shards.

Suffixes that could be equal are brought together first. Of the 16-byte grams of a 200-byte string the one of
least hash (the leftmost of equals) is its anchor; equal strings have equal anchors at equal places. The strings of a
document with the same anchor follow each other and are one window. Windows whose anchor occurs nowhere else hold no
repeats, equal windows are repeats throughout; only windows that share an anchor but differ are cut into blocks
of a few strings, and blocks with the same bytes common to all their strings meet in one task. The common bytes
are the same there, so a short mark stands for them, and only the bytes on either side travel. In the task the blocks
are dealt into two shards. Each gets its suffix array and transform; the transforms are merged by refining the
interleave of the two, eight characters a round. A round splits the intervals of suffixes with a common prefix; the
intervals that are left with two suffixes or more at the length of a string are the repeats. No suffix is sorted again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tabsift.llm.common import chunks, small_batches, staged

#: Length of the repeated strings, of the grams that anchor them, and of a round of the merge, in bytes.
LENGTH, GRAM, STEP = 200, 16, 8
#: Strings of one block, bytes of blocks merged at once, and text bytes scanned at once.
BLOCK, LOT_BYTES, CHUNK_BYTES = 24, 1_000_000, 1_000_000
#: Windows of one anchor above which its strings are counted one by one, so that no group grows with the input.
#: A block takes about 60 bytes, so fewer windows are a few megabytes.
CROWD = 50_000
#: Bytes that UTF-8 never holds: the end of a block, the ends of the two shards, and the mark of common bytes.
END, LAST, MARK = 0xFF, (0xFD, 0xFE), 0xF5


class Scanner:
    """Windows of the strings of many texts at once."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.byte = np.random.default_rng(3).integers(0, 2**64, 256, dtype=np.uint64)
        self.base = 0xD1342543DE82EF95
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            inverse = pow(self.base, -1, 2**64)
            self.up = np.cumprod(np.append(np.uint64(1), np.full(n, self.base, np.uint64)))
            self.down = np.cumprod(np.append(np.uint64(1), np.full(n, inverse, np.uint64)))

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        return x

    def windows(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, anchor hash, window hash, first string, number of strings, place of the anchor) per window."""
        raw = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        n = len(raw)
        if n < self.length:
            return tuple(np.zeros(0, np.int64) for _ in range(6))
        self._powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[raw] * self.up[:n], out=sums[1:])
        grams = self._mix((sums[self.gram:] - sums[:-self.gram]) * self.down[:n - self.gram + 1])
        # High bits of the hash, then the place: the least is the leftmost of least hash.
        bits = np.uint64(max(1, int(n).bit_length()))
        least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
        span, wanted = 1, self.length - self.gram + 1
        while span * 2 <= wanted:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < wanted:
            least = np.minimum(least[:len(least) - (wanted - span)], least[wanted - span:])
        anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        # Strings that lie inside one text.
        inside = np.zeros(len(anchor) + 1, np.int8)
        long = sizes >= self.length
        np.add.at(inside, begins[long], 1)
        np.add.at(inside, ends[long] - self.length + 1, -1)
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        first = inside.copy()
        first[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        first[begins[long]] = True
        starts = np.flatnonzero(first)
        # A window ends before the next one starts, or with its text.
        text = np.searchsorted(ends, starts, side="right")
        stops = np.minimum(np.append(starts[1:], n), ends[text] - self.length + 1)
        many = stops - starts
        place = anchor[starts] - starts
        upto = stops + self.length - 1
        whole = (sums[upto] - sums[starts]) * self.down[starts]
        whole = self._mix(whole + (many * 1024 + place).astype(np.uint64))
        return text, grams[anchor[starts]].view(np.int64), whole.view(np.int64), starts - begins[text], many, place


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the cyclic shifts of bytes that end in a byte of their own, by doubling sorted prefixes."""
    n = len(text)
    rank = _words(text)
    depth = STEP
    order = np.argsort(rank, kind="stable")
    while True:
        ranked = rank[order]
        dense = np.empty(n, np.int64)
        dense[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if dense[order[-1]] == n - 1:
            return order
        rank = dense * n + np.roll(dense, -depth % n)
        order = np.argsort(rank, kind="stable")
        depth *= 2


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on (cyclic) as one number of the same order."""
    round_ = np.resize(text, len(text) + STEP)
    words = np.zeros(len(text), np.uint64)
    for k in range(STEP):
        words = words << np.uint64(8) | round_[k:k + len(text)]
    return words


def merge_transforms(left: np.ndarray, right: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge two texts by their transforms up to a common prefix of ``length``.

    Gives, in merged order of all suffixes: the text (0, 1) of each, its place there, and the number of the
    interval of suffixes that have their first ``length`` bytes in common.
    """
    if length % STEP:
        raise ValueError(f"the length must be a multiple of {STEP}")
    texts = left, right
    arrays = [suffix_array(t) for t in texts]
    # The transform, eight characters wide: what stands before each suffix, in the order of the suffix array.
    before = [_words(t)[(a - STEP) % len(t)] for t, a in zip(texts, arrays)]
    _, number = np.unique(np.concatenate(before), return_inverse=True)
    before = number[:len(left)], number[len(left):]
    low, high = [(b & 0xFFFF).astype(np.uint16) for b in before], [(b >> 16).astype(np.uint16) for b in before]
    wide = number.max(initial=0) > 0xFFFF
    total = len(left) + len(right)
    source = np.concatenate([np.zeros(len(left), bool), np.ones(len(right), bool)])
    interval = np.zeros(total, np.int64)
    word, upper = np.empty(total, np.uint16), np.empty(total, np.uint16)
    for _ in range(length // STEP):
        other = ~source
        word[other], word[source] = low[0], low[1]
        order = np.argsort(word, kind="stable")
        if wide:
            upper[other], upper[source] = high[0], high[1]
            order = order[np.argsort(upper[order], kind="stable")]
        ranked, prior = word[order], interval[order]
        split = (ranked[1:] != ranked[:-1]) | (prior[1:] != prior[:-1])
        if wide:
            over = upper[order]
            split |= over[1:] != over[:-1]
        interval = np.concatenate([[0], np.cumsum(split)])
        source = source[order]
    place = np.empty(total, np.int64)
    place[~source], place[source] = arrays
    return source.astype(np.int8), place, interval


def repeated_starts(blocks: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per block the starts of strings of ``length`` bytes that occur more than once in all blocks together."""
    shards, homes = [], []
    for half in (0, 1):
        mine = list(range(half, len(blocks), 2))
        body = b"".join(blocks[i] + bytes([END]) for i in mine) + bytes([LAST[half]])
        shards.append(np.frombuffer(body, np.uint8))
        homes.append((np.array(mine, np.int64), np.cumsum([0] + [len(blocks[i]) + 1 for i in mine])))
    source, place, interval = merge_transforms(*shards, length=length)
    repeated = np.bincount(interval)[interval] > 1
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(blocks)
    for half in (0, 1):
        mine, begins = homes[half]
        places = np.sort(place[repeated & (source == half)])
        home = np.searchsorted(begins, places, side="right") - 1
        held = home < len(mine)
        places, home = places[held], home[held]
        size = np.array([len(blocks[i]) for i in mine], np.int64)
        inside = places - begins[home] + length <= size[home]
        places, home = places[inside], home[inside]
        cuts = np.searchsorted(home, np.arange(len(mine) + 1))
        for at, i in enumerate(mine.tolist()):
            found[i] = places[cuts[at]:cuts[at + 1]] - begins[at]
    return found


def _binary(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def scan_windows(rows: DataFrame, length: int) -> DataFrame:
    """(anchor, window, row, at) of all windows of (row, text); at holds start, many and place (12 bits each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(length, GRAM)
        for batch in chunks(batches, "text", CHUNK_BYTES):
            ids = batch.column("row").to_numpy()
            text, anchor, window, start, many, place = scanner.windows(_binary(batch, "text"))
            at = (start << 24) | (many << 12) | place
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (anchor, window, ids[text], at)], names=["anchor", "window", "row", "at"])

    return rows.mapInArrow(run, "anchor long, window long, row long, at long")


def packed_rows(rows: DataFrame, text: str) -> DataFrame:
    """The rows with ``text`` compressed, as ``packed``, for joins."""
    kept = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [pack.compress(t) for t in _binary(batch, text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(packed, pa.binary())],
                                             names=[*kept, "packed__"])

    return rows.mapInArrow(run, rows.select(*kept, F.lit(b"").alias("packed__")).schema)


def mark_of(key: int, block: int) -> bytes:
    """Stands for the bytes that the strings of a block have in common; fills strings up to whole rounds."""
    digits, key = [MARK], key % MARK**8
    for _ in range(8):
        key, digit = divmod(key, MARK)
        digits.append(digit)
    return bytes(digits + [MARK] * (-(block - 1 + len(digits)) % STEP))


def cut_blocks(found: DataFrame, length: int, block: int) -> DataFrame:
    """Blocks (key, row, start, many, solved, left, sides) of the differing windows of (row, packed, windows).

    Strings of one block have the anchor at ``block`` neighbouring places; key stands for the anchor and the bytes
    that all of them share, sides are the bytes to the left and right of those, the first ``left`` to the left.
    Crowded anchors give one string per block: the key alone stands for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        digest = xxhash.xxh3_64_intdigest
        names = ["key", "row", "start", "many", "solved", "left", "sides"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.binary()]
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()
            return made

        for batch in batches:
            for row, packed, windows in zip(*(batch.column(c).to_pylist() for c in ("row", "packed__", "windows"))):
                text = unpack.decompress(packed)
                for w in windows:
                    at, stop = w["start"], w["start"] + w["many"]
                    anchor, solved = at + w["place"], w["solved"]
                    step = 1 if w["crowded"] else block
                    while at < stop:
                        group = (anchor - at) // step  # strings with the anchor at group * step ... + step - 1
                        begin = anchor - group * step
                        end, upto = min(stop, begin + 1), begin - step + 1 + length
                        key = digest(text[begin:upto], seed=group + step * 1000)
                        sides = None if step == 1 else text[at:begin] + text[upto:end + length - 1]
                        out.append((key - (1 << 63), row, at, end - at, solved, begin - at, sides))
                        at = end
                    if len(out) >= 4000:
                        yield flush()
        if out:
            yield flush()

    return found.select("row", "packed__", "windows").mapInArrow(
        run, "key long, row long, start int, many int, solved boolean, left int, sides binary")


def compare_blocks(blocks: DataFrame, block: int, lot_bytes: int) -> DataFrame:
    """(row, start, many, mask): the strings of each block that are repeated, as bits from its first string on."""
    names = ["key", "row", "start", "many", "solved", "left", "sides"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Differing blocks of a key, by their sides: [key, strings, repeated, open rows].
        groups: list[dict[tuple, list]] = []
        held = 0
        out: list[tuple] = []

        def settle() -> None:
            flat = [(side, entry) for group in groups for side, entry in group.items()]
            short = [side[1][:side[0]] + mark_of(entry[0], block) + side[1][side[0]:] for side, entry in flat]
            length = block - 1 + len(mark_of(0, block))
            for (_, entry), starts in zip(flat, repeated_starts(short, length)):
                mask = (1 << entry[1]) - 1 if entry[2] else sum(1 << int(s) for s in starts)
                if mask:
                    out.extend((row, start, entry[1], mask) for row, start in entry[3])
            groups.clear()

        def close(group: dict[tuple, list]) -> int:
            """Settle a group of equal blocks at once, keep one of differing blocks for the merge."""
            if len(group) > 1:
                groups.append(group)
                return sum(len(side[1]) + 16 for side in group)
            for entry in group.values():
                if entry[2]:
                    out.extend((row, start, entry[1], (1 << entry[1]) - 1) for row, start in entry[3])
            return 0

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            columns = zip(*out) if out else [[]] * 4
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["row", "start", "many", "mask"])
            out.clear()
            return made

        last, group, alone = None, {}, None
        for batch in batches:
            for key, row, start, many, solved, left, sides in zip(*(batch.column(c).to_pylist() for c in names)):
                if key != last:
                    held += close(group)
                    last, group, alone = key, {}, None
                    if held >= lot_bytes:
                        settle()
                        held = 0
                if sides is None:  # one string of a crowd: rows go on as they come, from the second on
                    if alone is None:
                        alone = (row, start, solved)
                        continue
                    if alone and not alone[2]:
                        out.append((alone[0], alone[1], 1, 1))
                    alone = ()
                    if not solved:
                        out.append((row, start, 1, 1))
                    continue
                entry = group.get((left, sides, many))
                if entry is None:
                    entry = group[left, sides, many] = [key, many, solved, []]
                else:  # the same block again
                    entry[2] = True
                if not solved:
                    entry[3].append((row, start))
            yield flush()
        close(group)
        if groups:
            settle()
        yield flush()

    dealt = blocks.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "row long, start int, many int, mask int")


def remove_repeats(
    docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text: str = "text",
    block: int = BLOCK, lot_bytes: int = LOT_BYTES, crowd: int = CROWD, keep: tuple[str, ...] = (),
    whole_characters: bool = False,
) -> DataFrame:
    """One row per document: id_col, n_bytes, n_removed, n_spans, kept (binary), and the columns named in ``keep``.

    A byte goes if a string of ``length`` bytes over it starts at one more place, in any document, also the same
    one and overlapping itself; no string crosses documents. All strings are judged on the input. n_spans counts
    the maximal runs removed; kept is the rest, one after the other, which may cut a character; with
    ``whole_characters`` the bytes left of a cut one go from kept as well. Null and empty texts have 0 bytes, and texts below ``length`` lose none. Repeated rows are documents of their own: they lose what
    they share. An empty table gives no rows. Equality of whole windows and of common bytes is that of 64-bit hashes.
    """
    if length % STEP or not block + GRAM < length < 4096 or block > 30:
        raise ValueError("length must be a multiple of 8, below 4096 and well above a block of up to 30 strings")
    small_batches(docs.sparkSession)
    # Rows of equal id and text share a number; they also share their windows and what they lose.
    keep = tuple(c for c in keep if c not in (id_col, text, "n_bytes", "n_removed", "n_spans", "kept"))
    source = docs.select(F.xxhash64(id_col, text).alias("row__"), F.col(id_col).alias("id__"),
                         F.coalesce(F.col(text), F.lit("")).alias("text__"), *keep)
    plain = source.select(F.col("row__").alias("row"), F.col("text__").alias("text"))
    rows = scan_windows(plain, length)
    # One order serves all the counts below.
    rows = rows.repartition("anchor").sortWithinPartitions("anchor", "window", "row", "at")
    by_anchor = Window.partitionBy("anchor")
    by_window = Window.partitionBy("anchor", "window")
    judged = rows.select(
        "*", F.count(F.lit(1)).over(by_window).alias("same"),
        F.row_number().over(by_window.orderBy("row", "at")).alias("turn"),
        (F.min("window").over(by_anchor) < F.max("window").over(by_anchor)).alias("differs"),
        F.count(F.lit(1)).over(by_anchor).alias("near"),
    ).where("same > 1 or differs").select(
        "row", F.shiftright("at", 24).cast("int").alias("start"),
        F.shiftright("at", 12).bitwiseAND(4095).cast("int").alias("many"),
        F.col("at").bitwiseAND(4095).cast("int").alias("place"), (F.col("same") > 1).alias("solved"),
        (F.col("differs") & (F.col("turn") == 1)).alias("compare"), (F.col("near") > crowd).alias("crowded"))
    judged = staged(judged, "repeat-windows")
    # Of equal windows one stands for all where they are compared with others.
    windows = judged.where("compare").groupBy("row").agg(
        F.collect_list(F.struct("start", "many", "place", "solved", "crowded")).alias("windows"))
    packed = packed_rows(plain, "text")
    compared = compare_blocks(cut_blocks(packed.join(windows, "row"), length, block), block, lot_bytes)
    solved = judged.where("solved").select("row", "start", "many", F.lit(-1).alias("mask"))
    spans = solved.union(compared).groupBy("row").agg(
        F.collect_list(F.struct("start", "many", "mask")).alias("spans__")).withColumnRenamed("row", "row__")
    texts = packed_rows(source, "text__").join(spans, "row__", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for body, found in zip(batch.column("packed__").to_pylist(), batch.column("spans__").to_pylist()):
                raw = unpack.decompress(body)
                removed = n_spans = 0
                if found:
                    change = np.zeros(len(raw) + 1, np.int32)
                    for s in found:
                        if s["mask"] < 0 or s["mask"] == (1 << s["many"]) - 1:
                            runs = [(s["start"], s["start"] + s["many"])]
                        else:
                            runs = [(s["start"] + k, s["start"] + k + 1) for k in range(s["many"]) if s["mask"] >> k & 1]
                        for a, b in runs:
                            change[a] += 1
                            change[b + length - 1] -= 1
                    gone = np.cumsum(change[:-1]) > 0
                    removed = int(gone.sum())
                    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out[0].append(len(raw))
                out[1].append(removed)
                out[2].append(n_spans)
                left = kept if found else raw
                out[3].append(left.decode(errors="ignore").encode() if whole_characters else left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id__"), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary()),
                 *(batch.column(c) for c in keep)], names=names)

    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept", *keep]
    number = F.lit(0).cast("long")
    schema = source.select(F.col("id__").alias(id_col), number.alias("n_bytes"), number.alias("n_removed"),
                           number.alias("n_spans"), F.lit(b"").alias("kept"), *keep).schema
    return texts.mapInArrow(cut, schema)

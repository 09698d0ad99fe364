"""Byte-level BPE: encoding by recursive DuckDB queries inside each task, and decoding.

A text is cut into pre-tokens. What is not a token by itself becomes rows (word, position, token) in a DuckDB
database of the task, which exists in memory only. A recursive query joins neighbouring tokens with the merge
table and contracts, in every word at once, the leftmost pair of least rank until no pair is left. Each distinct
word is merged once per task. An ordered aggregation over the ids' byte strings decodes them.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabsift.llm.common import chunks, read_bytes, small_batches

#: Text bytes handled at once, words merged by one query, bytes of long words merged by one query, and words
#: remembered, in one task; ids decoded by one query.
CHUNK_BYTES = 4_000_000
QUERY_WORDS = 50_000
QUERY_BYTES = 200_000
REMEMBERED = 300_000
DECODED = 250_000
#: Words of more bytes are cut first, see ``Merger.cut``; pieces of more bytes contract all places of the least pair
#: in one step.
LONG_WORD = 96

#: One step per merge: every word contracts the leftmost of its pairs of least rank. ``best`` packs rank and place.
MERGE = """
with recursive s(w, t, done) as (
    select w, t, false from words
    union all
    select s.w,
        case when best is null then t
             else list_concat(t[:(best & 16777215) - 1], [(best >> 24)::int], t[(best & 16777215) + 2:]) end,
        best is null
    from s left join (
        select w, min((m.rank::bigint << 24) + p) as best
        from (select w, unnest(t) as a, unnest(t[2:]) as b, generate_subscripts(t, 1) as p from s where not done) u
        join merges m on m.l = u.a and m.r = u.b
        group by w
    ) g on g.w = s.w
    where not done
)
select w, t from s where done
"""

#: The same fixpoint for long words, as rows: all places of the least pair at once, the leftmost first where they
#: overlap. That is the same result unless the merge can yield a pair of a lower rank, which goes before the next
#: place. What such a merge can set off stays within a known number of bytes, so that it is made at the leftmost place
#: and at those that begin ``gap`` bytes or more after the place before; see ``Ranks.gaps``.
MERGE_LONG = """
with recursive s(w, p, t, done) as (
    select w, p, t, false from places
    union all
    select w, p, case when hit then best else t end, best is null
    from (
        select w, p, t, best, hit, coalesce(lag(hit) over (partition by w order by p), false) as gone
        from (
            select w, p, t, best, coalesce(rank = best, false) and (turn = 1 or p - before >= gap)
                and row_number() over (partition by w, rank is not distinct from best, run order by p) % 2 = 1 as hit
            from (
                select *, row_number() over (partition by w, rank is not distinct from best order by p) as turn,
                    lag(p) over (partition by w, rank is not distinct from best order by p) as before,
                    place - turn as run
                from (
                    select a.*, m.rank, m.gap, min(m.rank) over (partition by a.w) as best
                    from (
                        select w, p, t, lead(t) over (partition by w order by p) as n,
                            row_number() over (partition by w order by p) as place
                        from s where not done
                    ) a left join merges m on m.l = a.t and m.r = a.n
                )
            )
        )
    )
    where not gone
)
select w, list(t order by p) as t from s where done group by w
"""

#: Ordered aggregation of the ids' bytes, as hexadecimal text; and one of the ids that are no token, if any.
DECODE = """
select w, string_agg(v.hex, '' order by p) as bytes, max(f.id) filter (where v.id is null) as unknown
from (select w, unnest(t) as id, generate_subscripts(t, 1) as p from found) f
left join vocabulary v on v.id = f.id
group by w
"""

def character_classes() -> bytes:
    """Per code point 0 white space, 1 letter, 2 number, 3 other, as the library's own patterns see it; compressed,
    to travel with the tasks."""
    import tiktoken

    everything = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, 3, np.uint8)
    for value, pattern in enumerate((r"\s", r"\p{L}", r"\p{N}")):
        # Text that a pattern leaves out gives no tokens; a token is a byte here.
        library = tiktoken.Encoding(f"class{value}", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        matched = bytes(library.encode_ordinary(everything)).decode()
        table[np.frombuffer(matched.encode("utf-32-le"), np.uint32)] = value
    return zlib.compress(table.tobytes(), 1)


def pretokens(texts: list[str], classes: np.ndarray) -> list[list[str]]:
    """The pre-tokens of each text, as the public pattern cuts them: contractions, then letters, numbers or other
    characters with at most one space before them, then white space without the space that the next one takes."""
    joined = "".join(texts)
    if not joined:
        return [[] for _ in texts]
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    n = len(points)
    kind = classes[points]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[0] = edge[n] = True
    edge[ends] = True
    change = np.empty(n + 1, bool)
    change[0] = change[n] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    change |= edge
    white = np.append(kind == 0, True)
    after_space = np.zeros(n + 1, bool)
    after_space[1:n] = points[:-1] == 32
    after_space &= ~edge
    starts = change & (white | ~after_space)
    # The last white character before other characters starts a token of its own, or the next one.
    last = np.flatnonzero(white[:n] & change[1:] & ~edge[1:])
    starts[last] = True
    # Contractions.
    quotes = np.flatnonzero((points == 39) & starts[:n])
    if len(quotes):
        at = np.append(points, [0, 0, 0]).astype(np.int64)
        inside = lambda k: quotes + k < ends[np.searchsorted(ends, quotes, side="right")]
        one, two = at[quotes + 1], at[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"]) & inside(1)
        long = inside(2) & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) |
                            ((one == ord("l")) & (two == ord("l"))))
        starts[quotes[short] + 1] = False
        starts[quotes[short] + 2] = True
        starts[quotes[long] + 1] = False
        starts[quotes[long] + 3] = True
    cuts = np.flatnonzero(starts[: n + 1])
    places = cuts.tolist()
    tokens = [joined[a:b] for a, b in zip(places, places[1:])]
    upto = np.searchsorted(cuts, np.concatenate([[0], ends])).tolist()
    return [tokens[a:b] for a, b in zip(upto, upto[1:])]


class Ranks:
    """A rank file on the driver: tokens by id and the merge table (left id, right id, id of the result)."""

    def __init__(self, data: bytes):
        rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        if len({bytes([i]) for i in range(256)} - set(rank)):
            raise ValueError("not a byte-level vocabulary")
        left, right, result = [], [], []
        for token, number in rank.items():
            for cut in range(1, len(token)):
                a, b = rank.get(token[:cut]), rank.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), result.append(number)
        self.data = data
        self.merges = np.array([left, right, result], np.int32)
        self.gaps = self._gaps({number: len(token) for token, number in rank.items()}, left, right, result)
        #: By two bytes: whether any token has the first right before the second.
        self.meet = np.zeros((256, 256), bool)
        for token in rank:
            self.meet[list(token[:-1]), list(token[1:])] = True


    @staticmethod
    def _gaps(size: dict[int, int], left: list[int], right: list[int], result: list[int]) -> np.ndarray:
        """Per merge the bytes between the beginnings of two places from which on these are independent.

        A merge at one place changes only the pairs with the new token. Those of lower rank go next and yield a token
        around it, and so on, until all have a higher rank: one token grows. It can't exceed the longest token that
        such merges lead to, so that places which are twice its growth apart share nothing. Merges that lead to no
        lower rank have a gap of 0.
        """
        grows: dict[int, set[int]] = {}
        for a, b, c in zip(left, right, result):
            grows.setdefault(a, set()).add(c)
            grows.setdefault(b, set()).add(c)
        gap = {}
        for token in set(result):
            reached, open_ = {token}, [token]
            while open_:
                more = {t for t in grows.get(open_.pop(), ()) if t < token} - reached
                reached |= more
                open_ += more
            gap[token] = 2 * max(map(size.__getitem__, reached)) - size[token] if len(reached) > 1 else 0
        return np.array([gap[c] for c in result], np.int32)


class Merger:
    """The words of one task: a DuckDB database in memory and the words merged so far."""

    def __init__(self, ranks: Ranks):
        import duckdb

        self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.data.splitlines() if x)}
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], np.int32)
        self.meet = ranks.meet
        self.database = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self._table("merges", {"l": ranks.merges[0], "r": ranks.merges[1], "rank": ranks.merges[2],
                               "gap": ranks.gaps})
        self._table("vocabulary", {
            "id": np.fromiter(self.rank.values(), np.int32), "hex": pa.array([k.hex() for k in self.rank])})
        #: By word, or by piece of a long word (as bytes).
        self.ids: dict[str | bytes, bytes] = {}
        self.text: dict[str | bytes, bytes] = {}

    def _table(self, name: str, columns: dict) -> None:
        self.database.register("arrow__", pa.table(columns))
        self.database.execute(f"create or replace table {name} as select * from arrow__")
        self.database.unregister("arrow__")

    def cut(self, raw: bytes) -> list[bytes]:
        """The pieces of a word between bytes that no token has side by side.

        A merge over such a place would make a token that has them, so the pieces merge independently.
        """
        values = np.frombuffer(raw, np.uint8)
        places = [0, *(np.flatnonzero(~self.meet[values[:-1], values[1:]]) + 1).tolist(), len(raw)]
        return [raw[i:j] for i, j in zip(places, places[1:])]

    def learn(self, words: set[str]) -> None:
        """Encode and decode all words that are not known yet."""
        new = words.difference(self.ids)
        if len(self.ids) + len(new) > REMEMBERED:
            self.ids, self.text = {}, {}
            new = words
        short, long = [], []
        whole: list[tuple[str | bytes, int]] = []
        cut: dict[str, list[bytes]] = {}

        def sort(key: str | bytes, raw: bytes) -> None:
            if raw in self.rank:
                whole.append((key, self.rank[raw]))
            else:
                (short if len(raw) <= LONG_WORD else long).append((key, raw))

        for word in new:
            raw = word.encode()
            if len(raw) <= LONG_WORD or raw in self.rank:
                sort(word, raw)
            else:
                cut[word] = self.cut(raw)
        for piece in set().union(*cut.values()).difference(self.ids):
            sort(piece, piece)
        for at in range(0, len(short), QUERY_WORDS):
            self._merge(short[at:at + QUERY_WORDS], MERGE)
        # Pieces of like length end after about as many steps.
        lot, held = [], 0
        for pair in sorted(long, key=lambda p: len(p[1])):
            if lot and held + len(pair[1]) > QUERY_BYTES:
                self._merge(lot, MERGE_LONG)
                lot, held = [], 0
            lot.append(pair)
            held += len(pair[1])
        if lot:
            self._merge(lot, MERGE_LONG)
        for at in range(0, len(whole), QUERY_WORDS):
            part = whole[at:at + QUERY_WORDS]
            ids = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32),
                                           np.array([i for _, i in part], np.int32))
            self._keep([w for w, _ in part], pa.table({"w": np.arange(len(part), dtype=np.int32), "t": ids}))
        for word, pieces in cut.items():
            self.ids[word] = b"".join(map(self.ids.__getitem__, pieces))
            self.text[word] = b"".join(map(self.text.__getitem__, pieces))

    def _merge(self, words: list[tuple[str | bytes, bytes]], query: str) -> None:
        lengths = np.array([len(raw) for _, raw in words])
        tokens = self.byte[np.frombuffer(b"".join(raw for _, raw in words), np.uint8)]
        numbers = np.arange(len(words), dtype=np.int32)
        if query is MERGE:
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            rows = pa.table({"w": numbers, "t": pa.ListArray.from_arrays(offsets, tokens)})
            self.database.register("words", rows)
        else:
            rows = pa.table({"w": np.repeat(numbers, lengths), "p": np.arange(len(tokens)), "t": tokens})
            self.database.register("places", rows)
        self._keep([w for w, _ in words], self.database.sql(query).to_arrow_table())

    def _keep(self, words: list[str | bytes], found: pa.Table) -> None:
        lists = found.column("t").combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        sizes = np.cumsum(pa.compute.list_value_length(lists).to_numpy()) * 4
        begins = [0, *sizes.tolist()]
        for w, a, b in zip(found.column("w").to_pylist(), begins, begins[1:]):
            self.ids[words[w]] = flat[a:b]
        for w, text in self.decoded(found).items():
            self.text[words[w]] = text

    def decoded(self, found: pa.Table) -> dict[int, bytes]:
        """The bytes of each list of ids (w, t); lists without ids are left out."""
        self.database.register("found", found)
        rows = self.database.execute(DECODE).fetchall()
        for w, _, unknown in rows:
            if unknown is not None:
                raise ValueError(f"id {unknown} is not in the vocabulary")
        return {w: bytes.fromhex(text) for w, text, _ in rows}


def encode(docs: DataFrame, ranks_path: str, *, text: str = "text", decode: bool = False) -> DataFrame:
    """The columns of ``docs`` but ``text``, with token_ids (little-endian unsigned 32-bit numbers, as binary),
    n_tokens and, if ``decode``, decoded: the bytes that the ids stand for, as binary.

    Whole texts, without special tokens. Null and empty texts have no tokens. Repeated rows stay, an empty table
    stays empty. Columns of these names that ``docs`` already has give way.
    """
    ranks = Ranks(read_bytes(ranks_path))
    classes = character_classes()
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (text, "token_ids", "n_tokens", "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(ranks)
        kinds = np.frombuffer(zlib.decompress(classes), np.uint8)
        for batch in chunks(batches, text, CHUNK_BYTES):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            words = pretokens(texts, kinds)
            merger.learn(set().union(*words))
            ids = [b"".join(map(merger.ids.__getitem__, w)) for w in words]
            made = [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]
            if decode:
                made.append(pa.array([b"".join(map(merger.text.__getitem__, w)) for w in words], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + made,
                names=[*kept, "token_ids", "n_tokens", *["decoded"] * decode],
            )

    schema = docs.select(*kept, F.lit(b"").alias("token_ids"), F.lit(0).cast("long").alias("n_tokens"),
                         *[F.lit(b"").alias("decoded")] * decode).schema
    return docs.select(*kept, F.col(text)).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The columns of ``encoded`` with decoded, the bytes that its token_ids stand for; null ids stand for none.

    Ids that the vocabulary lacks raise a ValueError. Lists of any length are decoded in bounded runs.
    """
    ranks = Ranks(read_bytes(ranks_path))
    small_batches(encoded.sparkSession)
    kept = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(ranks)
        for batch in chunks(batches, "token_ids", 4 * DECODED):
            rows = [i or b"" for i in batch.column(batch.schema.get_field_index("token_ids")).to_pylist()]
            sizes = np.array([len(i) // 4 for i in rows])
            flat = np.frombuffer(b"".join(rows), "<u4").astype(np.int64)
            # A row's ids in runs of at most DECODED.
            runs = -(-sizes // DECODED)
            owner = np.repeat(np.arange(len(rows)), runs)
            first = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
            lengths = np.minimum(sizes[owner] - first * DECODED, DECODED)
            ends = np.cumsum(lengths)
            plain: list[list[bytes]] = [[] for _ in rows]
            at = 0
            while at < len(owner):
                upto = max(at + 1, int(np.searchsorted(ends, ends[at] - lengths[at] + DECODED, side="right")))
                begun = int(ends[at] - lengths[at])
                offsets = np.concatenate([[0], ends[at:upto] - begun]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, flat[begun:int(ends[upto - 1])])
                found = merger.decoded(pa.table({"w": np.arange(upto - at, dtype=np.int32), "t": lists}))
                for place, row in enumerate(owner[at:upto].tolist()):
                    plain[row].append(found[place])
                at = upto
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array([b"".join(p) for p in plain], pa.binary())],
                names=[*kept, "decoded"])

    return encoded.select(*kept).mapInArrow(run, encoded.select(*kept, F.lit(b"").alias("decoded")).schema)

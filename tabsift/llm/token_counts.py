"""Token counts with whole-token shortcuts, for piece models with merges inside words only.

The model writes a space as U+2581 and puts one before the text; its merges run over the whole text. Offline the
vocabulary shows where merges can never reach: no piece holds a space after another character, and some characters
(a line feed, in the usual models) are in no piece at all. So a text falls into units that are merged on their own:
a run of spaces with the characters up to the next space, and what follows a line feed. Units that the offline
proof knows to be one token are counted as they are; only the others are merged, each distinct one once per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabsift.llm.common import chunks, read_bytes, small_batches

SPACE = "▁"
#: Text bytes handled at once, and distinct units remembered, in one task.
CHUNK_BYTES = 2_000_000
REMEMBERED = 400_000


class UnitRules:
    """What the vocabulary proves: whether a line feed stands alone, and the units that are one token."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("a piece crosses a space: texts of this model can't be cut at spaces")
        if self.library.encode("a  b ", out_type=str) == self.library.encode("a b", out_type=str) or not (
            self.library.encode("a", out_type=str)[0].startswith(SPACE)
        ):
            raise ValueError("the model changes spaces or adds none before the text")
        if len(self.library.encode("a ")) != len(self.library.encode("a")) + 1:
            raise ValueError("the model drops a space at the end")
        # A line feed that no piece holds is always a token (or bytes) of its own.
        self.cut_lines = not any("\n" in piece for piece in pieces) and len(self.library.encode("\n")) == 2
        self.units = re.compile(r"\n[^ \n]*| +[^ \n]*" if self.cut_lines else r" +[^ ]*")
        usual = [p for i, p in enumerate(pieces) if not (
            self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))]
        alone = [p.replace(SPACE, " ") for p in usual if p.startswith(SPACE)]
        single = self.library.encode([unit[1:] for unit in alone], num_threads=1)
        self.one_token = [u for u, ids in zip(alone, single) if len(ids) == 1 and self.units.fullmatch(u)]

    def split(self, text: str) -> list[str]:
        """The units of a text, in order; together they are the text after the space put before it."""
        return self.units.findall(" " + text.replace(SPACE, " ")) if text else []

    def merged(self, units: list[str]) -> list[int]:
        """Tokens of each unit as the library merges it."""
        # The library puts a space before its input: it stands for the unit's first one, or is not counted.
        plain = [u[1:] if u[0] == " " else u for u in units]
        # Nothing after the only space: the library would take it for an empty text.
        return [1 if u == " " else len(ids) - (u[0] != " ")
                for u, ids in zip(units, self.library.encode(plain, num_threads=1))]


def count_tokens(docs: DataFrame, model_path: str, *, text: str = "text", limit: int = 4096) -> DataFrame:
    """The columns of ``docs`` but ``text``, with n_bytes, n_tokens and over_limit.

    Counts are those of the library, without begin and end marks, over whole texts; special strings are plain
    text. Null and empty texts have no bytes and no tokens. Repeated rows stay, an empty table stays empty.
    Columns of these names that ``docs`` already has give way.
    """
    model = read_bytes(model_path)
    small_batches(docs.sparkSession)
    made = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in docs.columns if c != text and c not in made]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = UnitRules(model)
        base = dict.fromkeys(rules.one_token, 1)
        known = dict(base)
        for batch in chunks(batches, text, CHUNK_BYTES):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            units = [rules.split(t) if t else [] for t in texts]
            new = set().union(*units).difference(known)
            if len(known) + len(new) > REMEMBERED:
                known = dict(base)
                new = set().union(*units).difference(known)
            new = list(new)
            known.update(zip(new, rules.merged(new)))
            totals = [sum(map(known.__getitem__, u)) for u in units]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(totals, pa.int64())], names=[*kept, "n_tokens"]
            )

    source = docs.select(*kept, F.col(text))
    # The byte length needs no Python: it is taken before the texts go.
    source = source.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    kept.append("n_bytes")
    schema = source.select(*kept).withColumn("n_tokens", F.lit(0).cast("long")).schema
    return source.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)

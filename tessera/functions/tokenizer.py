"""A tokenizer of the caller's choice, with offsets.

An encoder takes a list of texts and returns for each its ids and the first and
end character (code points) of every token. It is made by a factory, once a task,
so its files are read where it runs. The engine's own stand-in (white space
tokens) needs none and stays plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, functions as F

Encoder = Callable[[list[str]], list[tuple[list[int], list[int], list[int]]]]
SPANS = "array<struct<id:int,start:int,end:int>>"
_KIND = pa.list_(pa.struct([("id", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def spans(text: Column, factory: Callable[[], Encoder]) -> Column:
    """The tokens of a text as an array of (id, start, end). Null counts as
    empty. Tokens come in order; where bytes of one character are tokens of
    their own, they share its characters."""
    @F.arrow_udf(SPANS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = factory()
        for batch in batches:
            ids, starts, ends, sizes = [], [], [], [0]
            for i, s, e in encode(batch.to_pylist()):
                if not len(i) == len(s) == len(e):
                    raise ValueError("an encoder returns as many starts and ends as ids")
                ids += i
                starts += s
                ends += e
                sizes.append(len(ids))
            parts = [pa.array(x, pa.int32()) for x in (ids, starts, ends)]
            yield pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(parts, names=["id", "start", "end"])).cast(_KIND)
    return run(F.coalesce(text, F.lit("")))


def ids(spans_col: str | Column) -> Column:
    return F.transform(spans_col, lambda x: x["id"])


def cut(text: Column, tokens: Column, first: Column, count: Column) -> Column:
    """The piece of the text from token ``first`` (from 0) on that ``count``
    tokens cover, as it stands there."""
    start = F.get(tokens, first)["start"]
    return F.substring(text, start + 1, F.get(tokens, first + count - 1)["end"] - start)


def windows(text: str, tokens: str, n: int) -> Column:
    """The whole text in pieces of ``n`` tokens: a piece ends where the next
    one's first token begins, so together they are the text. Both arguments are
    columns of the frame; a text without tokens is one piece."""
    t, k = F.coalesce(F.col(text), F.lit("")), F.col(tokens)
    pieces = F.greatest(F.lit(1), F.ceil(F.size(k) / F.lit(n)).cast("int"))

    def piece(i):
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(k, i * n)["start"])
        end = F.when(i == pieces - 1, F.length(t)).otherwise(F.get(k, (i + 1) * n)["start"])
        return F.substring(t, start + 1, end - start)
    return F.transform(F.sequence(F.lit(0), pieces - 1), piece)

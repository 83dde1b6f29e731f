"""Fill-in-the-middle transformation of whole texts, one Arrow batch at a time.

Every text of a batch is split into units at once: the units of all texts are
one flat array beside the number of the text that each belongs to. A unit's
ordinal in its text says which role it has (prefix, middle or suffix); the units
of a role are filtered out, made into one list a text again and joined. No
Python code runs per text or per unit, and nothing is shuffled.

Cut points, order and rate come from a keyed hash of the document's id, so a
rerun, another partitioning or a lost executor gives the same output.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_limits, text_of

MARKERS = ("<P>", "<S>", "<M>")
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _draw(id_col: str, seed: int, i: int) -> Column:
    """The ``i``-th group of eight digits of the id's hash, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")


def _mod(x: pa.Array, m) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, m), m))


def _role(units: pa.Array, parent: pa.Array, ordinal: pa.Array, first: pa.Array, end: pa.Array) -> pa.Array:
    """The units with an ordinal from ``first`` to before ``end``, joined text
    by text (``first`` and ``end`` have one value a text)."""
    inside = pc.and_(pc.greater_equal(ordinal, pc.take(first, parent)), pc.less(ordinal, pc.take(end, parent)))
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(pc.subtract(end, first))])
    lists = pa.LargeListArray.from_arrays(offsets, pc.filter(units, inside))
    return pc.binary_join(lists, pa.scalar("", pa.large_string()))


def transform_batch(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array, end: str = "\n",
                    markers: tuple = MARKERS, percent: int = 100, spm_percent: int = 50) -> dict[str, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a batch of texts
    (without nulls)."""
    text = text.cast(pa.large_string())
    parts = pc.split_pattern(text, end)
    flat, parent = pc.list_flatten(parts), pc.cast(pc.list_parent_indices(parts), pa.int64())
    count = pc.cast(pc.list_value_length(parts), pa.int64())
    starts = pc.subtract(pc.cumulative_sum(count), count)
    ordinal = pc.subtract(pa.array(np.arange(len(flat), dtype=np.int64)), pc.take(starts, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(count, parent), 1))
    # what follows the last end mark is a unit unless it is empty
    real = pc.invert(pc.and_(last, pc.equal(flat, "")))
    n = pc.subtract(count, pc.cast(pc.or_(pc.ends_with(text, end), pc.equal(text, "")), pa.int64()))
    ends = pc.if_else(last, pa.scalar("", pa.large_string()), pa.scalar(end, pa.large_string()))
    units = pc.filter(pc.binary_join_element_wise(flat, ends, pa.scalar("", pa.large_string())), real)
    parent, ordinal = pc.filter(parent, real), pc.filter(ordinal, real)

    m = pc.add(n, 1)
    one, two = _mod(h1, m), _mod(h2, m)
    a, b = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    prefix = _role(units, parent, ordinal, pc.subtract(a, a), a)
    middle = _role(units, parent, ordinal, a, b)
    suffix = _role(units, parent, ordinal, b, n)

    marked = pc.match_substring(text, markers[0])
    for x in markers[1:]:
        marked = pc.or_(marked, pc.match_substring(text, x))
    plain = pc.or_(pc.or_(pc.equal(text, ""), marked), pc.greater_equal(_mod(h3, 100), percent))
    spm = pc.less(_mod(h4, 100), spm_percent)
    p, s, mid = (pa.scalar(x, pa.large_string()) for x in markers)
    none = pa.scalar("", pa.large_string())
    out = pc.if_else(spm, pc.binary_join_element_wise(s, suffix, p, prefix, mid, middle, none),
                     pc.binary_join_element_wise(p, prefix, s, suffix, mid, middle, none))
    chars = lambda x: pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(x), pa.int64()))
    form = pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM))
    return {"n": n, "form": form, "prefix_chars": chars(prefix), "middle_chars": chars(middle),
            "output": pc.cast(pc.if_else(plain, text, out), pa.string())}


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end: str = "\n", seed: int = 7,
                   markers: tuple = MARKERS, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null for ``plain``)
    and output of every row.

    A unit ends with ``end`` or with the text. Four numbers h1 to h4 come from
    the SHA-256 of ``<seed>:<id>``: the prefix has as many units as the smaller
    of h1 and h2 modulo n + 1, prefix and middle together as the larger.
    ``percent`` of the documents are transformed (by h3), ``spm_percent`` of
    these suffix first (by h4). Empty texts and texts that hold a marker stay
    as they are (``plain``), so :func:`restore` is exact.

    A null text counts as empty, a null id as the empty id. Rows that share an
    id get the same numbers; each row is transformed by itself, so repeated rows
    give repeated results. Texts of any length are taken whole: a batch is
    bounded by bytes and holds one text at least. An empty table gives no rows.
    Other columns are not read, so their names don't matter."""
    if len(set(markers)) != 3 or not all(markers) or not end:
        raise ValueError("three different markers and an end mark are needed")
    arrow_limits(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                       *[_draw(id_col, seed, i).alias(f"h{i + 1}") for i in range(4)])

    def run(batches):
        for b in batches:
            if b.num_rows:
                got = transform_batch(*(b.column(i) for i in range(1, 6)), end, markers, percent, spm_percent)
                yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), **got})

    return rows.mapInArrow(run, OUT)


def restore(output: str | Column = "output", form: str | Column = "form", markers: tuple = MARKERS) -> Column:
    """The exact text behind an output of :func:`fill_in_middle`. Transformed
    texts hold no marker, so each stands once and parts the output."""
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    parts = F.split(output, "|".join(re.escape(x) for x in markers), -1)
    # psm: "", prefix, suffix, middle; spm: "", suffix, prefix, middle
    return (F.when(form == PSM, F.concat(parts[1], parts[3], parts[2]))
             .when(form == SPM, F.concat(parts[2], parts[3], parts[1])).otherwise(output))

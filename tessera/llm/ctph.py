"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last eight bytes rolls over the UTF-8 bytes of a text. Where it
falls below ``2**32 / size`` a chunk ends, so chunks follow the content and not
the offset, and an edit changes the chunks that it touches and no others. The
chunk size (a power of two) is the least that gives at most ``CHUNKS`` chunk
ends; a chunk's hash is one symbol of the signature. A fingerprint is the chunk
size and the signatures at it and at the next two sizes, whose chunk ends are
among those of the smaller size: ``size:signature:signature:signature``.

Two fingerprints are compared at the smallest chunk size that both have, by the
edit distance of the signatures (insertions and deletions cost 1, so a replaced
symbol costs 2): ``1 - distance / (symbols of both)``. Sizes that don't meet
make a likeness of 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from .common import arrow_limits, text_of

#: Chunk ends of a text at most, the least chunk size (bits) and the sizes kept.
CHUNKS, LEAST_BITS, LEVELS = 64, 2, 3
#: Bytes hashed at a time, so that a long text takes little more than itself.
BLOCK = 1 << 18
WINDOW = 8
DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Rows of a cell of the id order, and cells at most (both only deal out work).
CELL_ROWS, MAX_CELLS = 500, 10_000

_MIX = np.uint32(0x9E3779B1)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
_STEP = [np.uint32(pow(0x2545F491, k, 1 << 32)) for k in (1, 2, 4)]


def _rolling(block: np.ndarray) -> np.ndarray:
    """The window's hash at every byte: a polynomial of the last eight bytes'
    values, doubled up from one to two, four and eight, then mixed."""
    y = _BYTE[block]
    for shift, factor in zip((1, 2, 4), _STEP):
        z = y.copy()
        z[shift:] += factor * y[:-shift]
        y = z
    y ^= y >> np.uint32(15)
    y *= _MIX
    return y ^ (y >> np.uint32(13))


def _blocks(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, hash at each byte from there) over the whole of ``data``."""
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, len(whole), BLOCK):
        before = min(at, WINDOW - 1)
        yield at, _rolling(whole[at - before:at + BLOCK])[before:]


def _chunk_ends(data: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """(bits, ends, hashes): the chunk size in bits, the places after the last
    bytes of its chunks and the window's hash there."""
    # ends at 2**k bytes are those whose hash has k leading zeros
    likely = max(LEAST_BITS, (len(data) // CHUNKS).bit_length() - 3)
    counts, places, hashes, kept = np.zeros(33, np.int64), [], [], 0
    for at, x in _blocks(data):
        x_low = x[x < (1 << 32 - LEAST_BITS)]
        counts += np.bincount(32 - np.frexp(x_low.astype(np.float64))[1], minlength=33)
        if kept <= 64 * CHUNKS:
            here = np.flatnonzero(x < (1 << 32 - likely))
            places.append(here + (at + 1))
            hashes.append(x[here])
            kept += len(here)
    at_least = counts[::-1].cumsum()[::-1]
    bits = LEAST_BITS
    while bits < 32 and at_least[bits] > CHUNKS:
        bits += 1
    if bits < likely or kept > 64 * CHUNKS:  # repetitive text: its ends at the size found
        places, hashes = [], []
        for at, x in _blocks(data):
            here = np.flatnonzero(x < (1 << 32 - bits))
            places.append(here + (at + 1))
            hashes.append(x[here])
    ends = np.concatenate(places) if places else np.zeros(0, np.int64)
    found = np.concatenate(hashes) if hashes else np.zeros(0, np.uint32)
    low = found < (1 << 32 - bits)
    return bits, ends[low], found[low]


def _signature(data: memoryview, ends: Iterable[int]) -> str:
    out, start = [], 0
    for end in [*ends, len(data)]:
        if end > start:
            x = zlib.crc32(data[start:end])
            x = (x ^ x >> 16) * 0x9E3779B1 >> 12
            out.append(DIGITS[x >> 6 & 63] + DIGITS[x & 63])
            start = end
    return "".join(out)


def fingerprint(text: str | None) -> str:
    """The fingerprint of a whole text (null: that of the empty text). Equal
    texts have equal fingerprints."""
    data = (text or "").encode()
    bits, ends, hashes = _chunk_ends(data)
    view = memoryview(data)
    return ":".join([str(1 << bits), *(_signature(view, ends[hashes < (1 << max(0, 32 - bits - k))].tolist()) for k in range(LEVELS))])


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a row of bits a symbol."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & at.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def likeness(a: str | None, b: str | None) -> float | None:
    """0 to 1 of two fingerprints; 1 if they are equal; null if one is null."""
    if a is None or b is None:
        return None
    if a == b:
        return 1.0
    (x, *xs), (y, *ys) = a.split(":"), b.split(":")
    x, y = int(x).bit_length(), int(y).bit_length()
    size = max(x, y)
    if size - x >= LEVELS or size - y >= LEVELS:
        return 0.0
    p, q = xs[size - x], ys[size - y]
    p, q = [p[i:i + 2] for i in range(0, len(p), 2)], [q[i:i + 2] for i in range(0, len(q), 2)]
    return 2.0 * _common(p, q) / (len(p) + len(q)) if p and q else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars and fingerprint of every row; nothing is shuffled.

    A null text counts as empty; null and repeated ids are ids like others;
    texts of any length are read whole, in blocks; an empty table gives no rows;
    other columns are not read."""
    arrow_limits(docs.sparkSession)

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_chars": pa.array(map(len, texts), pa.int64()),
                                              "fingerprint": pa.array(map(fingerprint, texts), pa.string())})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string")


def compare(pairs: DataFrame, left: str, right: str, name: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of the fingerprints in two of its columns."""
    @F.pandas_udf("double")
    def like(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b)], dtype="float64")
    return pairs.withColumn(name, like(left, right))


# -- each text beside the next one ---------------------------------------------


def _cells(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text, tie) with ``_cell``: numbers that rise with the
    order (doc_id falling, nulls last, then ``tie``), some ``CELL_ROWS`` rows
    each. Ids that hold more than a cell are split by ``tie``. The bounds are
    approximate quantiles of the ids, at most ``MAX_CELLS`` numbers."""
    n, known = rows.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    wanted = min(MAX_CELLS, max(1, -(-n // CELL_ROWS)))
    bounds = rows.agg(F.percentile_approx("doc_id", [i / wanted for i in range(1, wanted)], 10 * wanted)).first()[0] if wanted > 1 and known else []
    distinct = sorted(set(bounds or []))
    hot = {float(x): bounds.count(x) for x in distinct if bounds.count(x) > 1}
    parts = lambda m: F.floor((F.col("tie") / F.lit(2.0 ** 64) + 0.5) * m)
    span = wanted + 3
    if distinct:
        splits = sorted({float("-inf"), float("inf"), *map(float, distinct)})
        rows = rows.withColumn("_d", F.col("doc_id").cast("double"))
        cut = Bucketizer(splits=splits, inputCol="_d", outputCol="_bucket", handleInvalid="keep").transform(rows)
        turn = F.lit(float(len(splits) - 2)) - F.col("_bucket")
        # the id at a bucket's lower bound comes last in it
        sub = F.lit(0)
        if hot:
            m = F.create_map(*[F.lit(x) for kv in hot.items() for x in kv])[F.col("_d")]
            sub = F.when(m.isNotNull(), 1 + parts(m)).otherwise(0)
        last = float(len(splits) - 1)
    else:
        cut, turn, sub, last = rows, F.lit(0.0), F.lit(0), 1.0
    nulls = max(1, -(-(n - known) // CELL_ROWS)) if n > known else 1
    return cut.withColumn("_cell", F.when(F.col("doc_id").isNull(), F.lit(last * span) + parts(min(nulls, MAX_CELLS)))
                          .otherwise(turn * span + sub).cast("long")).drop("_d", "_bucket")


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited and
    near_next of every row: its text's last ``floor(n_chars / 2)`` code points
    replaced by the first as many (or all) of the next document, the
    fingerprints of both, and the likeness of the text's fingerprint to the
    edited text's and to the next document's.

    The next document has the next smaller id; after the smallest comes the
    largest (a single document follows itself). Rows that share an id follow
    each other in the order of a 64-bit hash of their texts, rows without an id
    come after all others. Equal rows follow each other, which gives the same
    results in any order. A null text counts as empty, texts of any length are
    taken whole, other columns are not read, and an empty table gives no rows.

    Texts are shuffled once, to cells of the id order that are read row by row;
    a cell ends with a copy of the next cell's first row, so no cell waits for
    another and a lost task is run again by itself. Rows that agree in id and
    text can't be told apart, so they share a cell whatever their number; it is
    read row by row as well."""
    spark = docs.sparkSession
    arrow_limits(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = _cells(rows.withColumn("tie", F.xxhash64("text")))
    # the row that each cell begins with: one small row a cell
    first = rows.groupBy("_cell").agg(F.min(F.struct((~F.col("doc_id").isNotNull()).alias("void"), F.bitwise_not("doc_id").alias("fall"), "tie")).alias("f"))
    first = sorted((r["_cell"], r["f"]["fall"], r["f"]["tie"]) for r in first.collect())  # at most twice MAX_CELLS
    if not first:
        return rows.limit(0).mapInArrow(_run, OUT)
    guests = [(first[i - 1][0], None if fall is None else ~fall, tie) for i, (_, fall, tie) in enumerate(first)]
    heads = spark.createDataFrame(guests, "_to long, _id long, _tie long").coalesce(1)
    # bounded by MAX_CELLS, and so small at any size
    copies = rows.join(F.broadcast(heads), rows["doc_id"].eqNullSafe(heads["_id"]) & (rows["tie"] == heads["_tie"]))
    copies = copies.select("doc_id", "text", "tie", F.col("_to").alias("_cell"), F.lit(1).alias("_guest")).dropDuplicates(["_cell"])
    dealt = rows.withColumn("_guest", F.lit(0)).unionByName(copies).repartition("_cell")
    dealt = dealt.sortWithinPartitions("_cell", "_guest", F.col("doc_id").desc_nulls_last(), "tie")
    return dealt.select("_cell", "_guest", "doc_id", "text").mapInArrow(_run, OUT)


OUT = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
NAMES = [x.split()[0] for x in OUT.split(", ")]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, chars, before = [], 0, None
    for b in batches:
        for cell, guest, doc, text in zip(*(c.to_pylist() for c in b.columns)):
            mark = fingerprint(text)
            if before is not None and before[0] == cell:
                _, own, own_text, own_mark = before
                half = len(own_text) // 2
                edited = own_text[:len(own_text) - half] + text[:half]
                edited_mark = own_mark if edited == own_text else fingerprint(edited)
                out.append((own, len(own_text), edited, own_mark, edited_mark, likeness(own_mark, edited_mark), likeness(own_mark, mark)))
                chars += len(edited)
            before = None if guest else (cell, doc, text, mark)
            if len(out) >= 2000 or chars > 4 << 20:
                yield _batch(out)
                out, chars = [], 0
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], names=NAMES)

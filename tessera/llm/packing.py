"""Best-fit packing with certified bin counts.

``tokenize`` turns documents into pieces of at most ``capacity`` token ids.
``pack`` deals the pieces to partitions of a bounded number of items and runs
best-fit decreasing in each. Dual-feasible functions give a lower bound of the
bins that a partition needs; a partition that meets it is certified. Pieces in
the unfilled bins of partitions with a gap (and the emptiest bin of certified
ones, which only rounding keeps open) are exchanged: dealt anew, to fewer
partitions, and packed again, until the bound over all pieces is met or a round
saves nothing.
"""

from __future__ import annotations

import os
from array import array
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import arrow_limits, buckets_for, stage

CAPACITY = 4096
#: Items of one partition of the packing, and so what one task holds.
PART_ITEMS = 8192
#: Words whose ids a worker remembers.
CACHE_WORDS = 300_000
#: Words that are one pre-token of letters, and at most one more of dots and
#: commas. Their ASCII letters may be lower-cased ahead of the tokenizer.
_PLAIN = "^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,]*)$"
_JOINED = 64

_TOKENIZERS: dict[str, tuple] = {}


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        last = np.zeros(tok.get_vocab_size(), bool)  # the ids that end a word
        for token, i in tok.get_vocab().items():
            last[i] = token.endswith("</w>")
        _TOKENIZERS[path] = (tok, last, {})
    return _TOKENIZERS[path]


def _encode(tok, words: list[str]) -> list[bytes]:
    run = getattr(tok, "encode_batch_fast", tok.encode_batch)
    return [array("I", e.ids).tobytes() for e in run(words, add_special_tokens=False)]


def _word_ids(path: str, words: list[str]) -> list[bytes]:
    """The ids of each distinct word. Words of letters go to the tokenizer many
    at a time, and the ids that end a word tell them apart again."""
    tok, last, known = _tokenizer(path)
    new = [w for w in words if w not in known]
    if len(known) + len(new) > CACHE_WORDS:  # words that came again stay
        again = {w: known[w] for w in words if w in known}
        known.clear()
        known.update(again)
    found: dict[str, bytes] = {}
    plain = [w for w in new if w.isalpha()]
    for i in range(0, len(plain), 16_384):
        part = plain[i:i + 16_384]
        groups = [part[j:j + _JOINED] for j in range(0, len(part), _JOINED)]
        for group, raw in zip(groups, _encode(tok, [" ".join(g) for g in groups])):
            ends = np.flatnonzero(last[np.frombuffer(raw, "<u4")]) * 4 + 4
            if len(ends) != len(group) or ends[-1] != len(raw):
                found.update(zip(group, _encode(tok, group)))
                continue
            at = 0
            for w, end in zip(group, ends.tolist()):
                found[w] = raw[at:end]
                at = end
    rest = [w for w in new if w not in found]
    for i in range(0, len(rest), 16_384):
        found.update(zip(rest[i:i + 16_384], _encode(tok, rest[i:i + 16_384])))
    out = [known[w] if w in known else found[w] for w in words]
    if len(known) + len(found) <= CACHE_WORDS:
        known.update(found)
    return out


def _gather(pool: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs ``pool[first[i] : first[i] + n[i]]`` one after another."""
    ends = np.cumsum(n)
    return pool[np.repeat(first - (ends - n), n) + np.arange(int(ends[-1]) if len(n) else 0)]


def _distinct_ids(path: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pool, first, n): the ids of each of ``words`` as a run of the pool."""
    parts = pc.extract_regex(words, _PLAIN)
    plain = pc.is_valid(parts)
    stem = pc.if_else(plain, pc.ascii_lower(parts.field(0)), words).dictionary_encode()
    tail = pc.if_else(plain, parts.field(1), "").dictionary_encode()
    stems, tails = stem.dictionary.to_pylist(), tail.dictionary.to_pylist()
    ids = _word_ids(path, stems) + _encode(_tokenizer(path)[0], tails)
    size = np.fromiter((len(x) >> 2 for x in ids), np.int64, len(ids))
    pool, first = np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(size) - size
    both = np.stack([np.asarray(stem.indices), np.asarray(tail.indices) + len(stems)], 1).astype(np.int64)
    pool = _gather(pool, first[both.ravel()], size[both.ravel()])
    n = size[both].sum(axis=1)
    return pool, np.cumsum(n) - n, n


def encode_texts(path: str, texts: pa.Array, eos: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): the ids of every text and ``eos`` after each. A word
    BPE never merges across white space, so each distinct word of the batch is
    encoded once and the texts are put together by index."""
    split = pc.ascii_split_whitespace(texts.fill_null(""))
    flat, off = split.flatten(), np.asarray(split.offsets) - split.offsets[0].as_py()
    owner = np.repeat(np.arange(len(texts)), np.diff(off))
    full = np.asarray(pc.binary_length(flat)) > 0
    owner, coded = owner[full], flat.filter(pa.array(full)).dictionary_encode()
    codes = np.asarray(coded.indices).astype(np.int64)
    pool, first, size = _distinct_ids(path, coded.dictionary)
    n = size[codes]
    per_text = np.bincount(owner, weights=n, minlength=len(texts)).astype(np.int64) + 1
    ends = np.cumsum(per_text)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<u4")
    body = np.ones(len(out), bool)
    body[ends - 1] = False
    out[body] = _gather(pool, first[codes], n)
    out[ends - 1] = eos
    return out, np.concatenate([[0], ends])


def tokenize(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
             eos: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length and ``ids`` (binary,
    little-endian unsigned 32 bit).

    Null text counts as empty: one piece that holds ``eos`` alone. Only texts of
    more than ``capacity`` ids are cut. Other columns of ``docs`` are left out."""
    arrow_limits(docs.sparkSession, rows=3000, mb=16)  # the more texts, the fewer distinct words a text
    schema = "doc_id long, piece int, start long, length long, ids binary"

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids, off = encode_texts(tokenizer, b.column(1).cast(pa.string()), eos)
            doc, piece, start, length, raw = [], [], [], [], []
            for i, d in enumerate(b.column(0).to_pylist()):
                lo, hi = int(off[i]), int(off[i + 1])
                for k, at in enumerate(range(lo, hi, capacity)):
                    end = min(at + capacity, hi)
                    doc.append(d)
                    piece.append(k)
                    start.append(at - lo)
                    length.append(end - at)
                    raw.append(ids[at:end].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(raw, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that items need at least; ``counts[s]`` items have size ``s``.
    The largest bound of two families of dual-feasible functions: sizes below a
    threshold vanish while those that leave less than it fill a bin, and sizes
    rounded by (k + 1)-fold floors."""
    sizes = np.arange(capacity + 1, dtype=np.int64)
    weight = counts * sizes
    up, n_up = np.cumsum(weight), np.cumsum(counts)
    best = -(-int(weight.sum()) // capacity)
    for t in range(1, capacity // 2 + 1):
        big = int(n_up[-1] - n_up[capacity - t])  # size > capacity - t
        mid = int(up[capacity - t] - up[t - 1])
        best = max(best, big + -(-mid // capacity))
    for k in range(1, 65):
        scaled = (k + 1) * sizes
        whole = scaled % capacity == 0
        # in units of 1 / (capacity * k) of a bin
        value = np.where(whole, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item. Open bins are kept in stacks by free space
    and a bit mask of the stacks that are not empty, so that the tightest bin
    that fits is the lowest bit at or above the item's size."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, made = 0, 0
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        fits = mask >> s
        if fits:
            free = s + (fits & -fits).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                mask &= ~(1 << free)
        else:
            free, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - free
        left = free - s
        if left:
            stacks[left].append(b)
            mask |= 1 << left
    return bins, offsets


def _pack_part(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        sizes = table.column("length").to_numpy()
        bins, offsets = best_fit_decreasing(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        bound = lower_bound(np.bincount(sizes, minlength=capacity + 1)[:capacity + 1], capacity)
        gap = len(fill) - bound
        open_bin = fill < capacity
        if gap == 0:  # certified: rounding alone leaves room, so the emptiest bin is offered
            open_bin &= np.arange(len(fill)) == np.argmin(fill)
        for name, col in (("_bin", bins), ("offset", offsets), ("_open", open_bin[bins]),
                          ("_bins", np.full(len(sizes), len(fill))), ("_gap", np.full(len(sizes), gap))):
            table = table.append_column(name, pa.array(col))
        return table
    return run


def pack(items: DataFrame, capacity: int = CAPACITY, part_items: int = PART_ITEMS) -> DataFrame:
    """``items`` (doc_id, piece, length and any columns of plain types) with
    ``sequence_id`` and ``offset`` (gapless from 0 in each sequence).

    Lengths lie between 1 and ``capacity``; others raise. Repeated rows are
    items of their own, ties are dealt by a hash of their key, and no items give
    no rows. The driver sees one row of sums a round and at most ``capacity``
    counts of lengths."""
    cols = items.columns
    pool = stage(items, "pack-items")
    kinds = pool.groupBy("length").agg(F.count(F.lit(1)).alias("n")).limit(capacity + 1).collect()
    if any(r.length is None or not 1 <= r.length <= capacity for r in kinds):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    counts = np.zeros(capacity + 1, np.int64)
    for r in kinds:
        counts[r.length] = r.n
    need, n_pool, sealed, done = lower_bound(counts, capacity), int(counts.sum()), 0, []
    if not n_pool:
        return items.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    last, last_bins, first = None, None, 0
    for turn in count():  # each round but the last saves a bin
        parts = buckets_for(n_pool, part_items)
        dealt = pool.select(*cols, F.pmod(F.xxhash64("doc_id", "piece", F.lit(turn)), F.lit(parts)).cast("long").alias("_part"))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
        out = stage(dealt.groupBy("_part").applyInArrow(
            _pack_part(capacity), f"{fields}, _bin long, offset long, _open boolean, _bins long, _gap long"), "pack-round")
        out = out.withColumn("sequence_id", F.lit(first).cast("long") + F.shiftleft(F.col("_part"), 24) + F.col("_bin"))
        first += parts << 24
        now = out.agg(F.sum(F.when(F.col("offset") == 0, 1)).alias("bins"),
                      F.sum(F.when((F.col("offset") == 0) & F.col("_open"), 1)).alias("open"),
                      F.sum(F.col("_open").cast("int")).alias("items")).first()
        if last is not None and now.bins >= last_bins:  # the exchange saved nothing
            done.append(last)
            return _union(done, cols)
        done.append(out.filter(~F.col("_open")))
        last, last_bins, n_pool = out.filter("_open"), now.open or 0, now.items or 0
        sealed += now.bins - last_bins
        if sealed + last_bins <= need or not n_pool:
            break
        pool = last
    done.append(last)
    return _union(done, cols)


def _union(frames: list[DataFrame], cols: list[str]) -> DataFrame:
    out = None
    for f in frames:
        f = f.select(*cols, "sequence_id", F.col("offset").cast("long").alias("offset"))
        out = f if out is None else out.unionByName(f)
    return out


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that carry ``ids``: one row
    of at most the capacity's ids per sequence (bounded, so gathered whole)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), parts.alias("p")).select(
        "sequence_id", "length",
        F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))

"""Quality rules with a word model: modified Kneser-Ney over pairs of words.

Base rules count words, symbols, repeated lines and repeated windows. The model
has an open vocabulary for each language: words above a fixed share of all
places have a place of their own in a sorted array of word hashes, rarer ones
share one unknown word and are spelled by a second Kneser-Ney model, over pairs
of bytes. Spark counts the words, then the pairs of all documents in shards; a
shard holds its pairs as a sorted array of keys (the places of both words)
beside their counts. Both orders are counted as Kneser and Ney count all but the
highest: a pair by the distinct words before it, a word by the distinct words
before it, so a passage isn't the likelier the more copies it has. Discounts, the types before and after each word and its
continuation count are added up over the shards (a few arrays as long as the
vocabulary), sent back to each, and turned into an array of log probabilities,
in which the documents' pairs are looked up: only sums by document return. A
document's perplexity per symbol must lie within the band of its language,
whose upper limit is the wider the shorter the document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import arrow_limits, buckets_for, byte_values, stage

#: Contract: least words, most percent of repeated words, window of those.
MIN_WORDS, MAX_REPEAT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
#: A word of the vocabulary is found MIN_COUNT times and at more than 1 in
#: SHARE of all places, so there are fewer than SHARE, whatever the corpus.
MIN_COUNT, SHARE = 5, 1 << 17
#: Documents a shard of the word counts, word places a shard of the pairs, slices of the vocabulary's totals.
COUNT_ROWS, SHARD_PLACES, SLICES = 8192, 4_000_000, 64
#: The bands: up to Tukey's inner fence (in spreads of a normal from the median), down to this share of the median.
ABOVE, LOW = 2.698, 0.5
#: Word hashes that a counting task holds.
_FLUSH = 1_000_000
_BITS = np.uint64(20)
_MASK = np.uint64((1 << 20) - 1)  # a place: the vocabulary has fewer than 3 * SHARE
_EDGE = 256  # a word's start and its end, as a byte

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[4]
    return x ^ (x >> np.uint64(32))


def _lang_code(lang: str | None) -> int:
    return xxhash.xxh64_intdigest("" if lang is None else f"={lang}")


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers from 0, as compressed planes of bytes."""
    x = np.ascontiguousarray(x, dtype="<u8")
    width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return len(x).to_bytes(8, "little") + bytes([width]) + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _unpack(b: bytes) -> np.ndarray:
    n, width = int.from_bytes(b[:8], "little"), b[8]
    out = np.zeros((n, 8), np.uint8)
    if n and width:
        planes = pa.decompress(b[9:], n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _rising(x: np.ndarray) -> np.ndarray:
    """What a sorted array rises by from place to place; ``np.cumsum`` undoes it."""
    return np.diff(x, prepend=x.dtype.type(0))


class Words:
    """The words of a batch of texts: owner (text) and code of each, the
    distinct words, and the distinct pairs of word and language."""

    def __init__(self, texts: pa.Array, langs: list):
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        flat, off = split.flatten(), np.asarray(split.offsets) - split.offsets[0].as_py()
        owner = np.repeat(np.arange(len(texts)), np.diff(off))
        full = np.asarray(pc.binary_length(flat)) > 0
        coded = flat.filter(pa.array(full)).dictionary_encode()
        self.owner, self.codes = owner[full], np.asarray(coded.indices).astype(np.int64)
        self.distinct = coded.dictionary
        names = sorted({x for x in langs if x is not None}) + [None]
        place = {x: i for i, x in enumerate(names)}
        self.langs, self.lang_of = names, np.array([place[x] for x in langs], np.int64)
        pair = self.codes * len(names) + self.lang_of[self.owner] if len(self.codes) else self.codes
        self.pairs, self.pair_of, self.pair_n = np.unique(pair, return_inverse=True, return_counts=True)


def repeated_words(owner: np.ndarray, codes: np.ndarray, n_texts: int, window: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in a window of ``window`` words found at
    least twice in the text."""
    n = len(codes) - window + 1
    if n < 2:
        return np.zeros(n_texts, np.int64)
    h = owner[:n].astype(np.uint64) * _ODD[5]
    for k in range(window):
        h = _mix((h + codes[k:k + n].astype(np.uint64) + np.uint64(1)) * _ODD[k % 8])
    inside = np.flatnonzero(owner[:n] == owner[window - 1:])
    order = inside[np.argsort(h[inside], kind="stable")]
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    a, b = order[same], order[same + 1]
    true = owner[a] == owner[b]
    for k in range(window):
        true &= codes[a + k] == codes[b + k]
    starts = np.unique(np.concatenate([a[true], b[true]]))
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return np.bincount(owner, weights=np.cumsum(cover)[:-1] > 0, minlength=n_texts).astype(np.int64)


def _dup_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    lines = [x for x in lines if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each distinct pair of word and language, and the codes of the languages."""
    code = np.array([_lang_code(x) for x in words.langs], np.uint64)
    raw = np.array([xxhash.xxh64_intdigest(w) for w in words.distinct.cast(pa.binary()).to_pylist()], np.uint64)
    return _mix(raw[words.pairs // len(words.langs)] + _mix(code[words.pairs % len(words.langs)])), code


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, byte, word) of every pair of bytes of the words, edges included."""
    texts = texts.cast(pa.binary())
    sizes = np.asarray(pc.binary_length(texts)).astype(np.int64) + 1
    word = np.repeat(np.arange(len(sizes)), sizes)
    now = np.full(len(word), _EDGE, np.int64)
    ends = np.cumsum(sizes) - 1
    inside = np.ones(len(word), bool)
    inside[ends] = False
    now[inside] = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    before = np.insert(now[:-1], 0, _EDGE) if len(now) else now
    return before, now, word


# -- modified Kneser-Ney

def discounts(types: np.ndarray) -> np.ndarray:
    """The three discounts, from the numbers of pairs counted 1, 2, 3 and 4 times
    (one row a language). Half of a count where the counts don't give one."""
    t = np.asarray(types, np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        y = t[:, 0] / (t[:, 0] + 2 * t[:, 1])
        d = np.stack([j - (j + 1) * y * t[:, j] / t[:, j - 1] for j in (1, 2, 3)], axis=1)
    most = np.array([1.0, 2.0, 3.0])
    return np.where((d > 0) & (d < most), d, most / 2)


def log_probability(n, cut, total, back, lower) -> np.ndarray:
    """Of a pair counted ``n`` times with the discounts ``cut`` (a row a pair):
    the discounted share of its history's ``total``, and the mass ``back`` that
    the history's discounts free, dealt by continuation (``lower``)."""
    off = cut[np.arange(len(n)), np.minimum(n, 3).astype(np.int64) - 1]
    return np.log(np.maximum(n - off, 0) / total + back / total * lower)


def spelling(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a byte after another, from their counts (257 x 257)."""
    out = np.full(counts.shape, -np.inf)
    v, w = np.nonzero(counts)
    if len(v):
        cut = discounts([[np.sum(counts == j) for j in (1, 2, 3, 4)]])
        types = np.stack([(counts == 1).sum(1), (counts == 2).sum(1), (counts >= 3).sum(1)], axis=1)
        after = (counts > 0).sum(0) / len(v)
        out[v, w] = log_probability(counts[v, w], np.repeat(cut, len(v), 0), counts.sum(1)[v], (types * cut).sum(1)[v], after[w])
    return out


# -- the vocabulary

COUNTS = "shard long, lang long, words binary, n binary"


def word_counts(docs: DataFrame) -> DataFrame:
    """kind, key, lang and n over all documents. Kind 0: a word's hash (the end of
    a text counts as a word) of at least MIN_COUNT places; kind 1: places of a
    shard; kind 2: a byte (key) after another (lang). A task adds up its batches
    before it sends sorted arrays."""
    shards = buckets_for(docs.count(), COUNT_ROWS)
    names = [x.split()[0] for x in COUNTS.split(", ")]

    def flush(held):
        keys, code, n = (np.concatenate(x) for x in zip(*held))
        keys, first, of = np.unique(keys, return_index=True, return_inverse=True)
        code, n = code[first], np.bincount(of, weights=n).astype(np.uint64)
        shard = (_mix(keys) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((keys, code, shard))
        keys, code, n, shard = keys[order], code[order], n[order], shard[order]
        cuts = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (code[1:] != code[:-1]), [True]]))
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        return pa.RecordBatch.from_arrays([
            pa.array(shard[cuts[:-1]]), pa.array(code[cuts[:-1]].view(np.int64)),
            pa.array([_pack(_rising(keys[a:b])) for a, b in spans], pa.binary()), pa.array([_pack(n[a:b]) for a, b in spans], pa.binary())], names=names)

    def run(batches):
        held, size, pairs = [], 0, np.zeros((257, 257), np.int64)
        for b in batches:
            words = Words(b.column(0).cast(pa.string()), b.column(1).to_pylist())
            if not len(words.codes):
                continue
            keys, code = _hashes(words)
            of = words.pairs % len(words.langs)
            texts = np.bincount(words.lang_of[np.unique(words.owner)], minlength=len(code))
            told = np.flatnonzero(texts)
            held.append((np.append(keys, end_hash(code[told])), np.append(code[of], code[told]), np.append(words.pair_n, texts[told])))
            size += len(keys)
            before, now, word = _letters(words.distinct)
            times = np.bincount(words.codes, minlength=len(words.distinct))
            pairs += np.bincount(before * 257 + now, weights=times[word], minlength=257 * 257).astype(np.int64).reshape(257, 257)
            if size >= _FLUSH:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)
        rows = np.flatnonzero(pairs.any(1))
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(-1 - rows), pa.array(rows), pa.array([b""] * len(rows), pa.binary()),
                                              pa.array([_pack(pairs[r]) for r in rows], pa.binary())], names=names)

    def add(t: pa.Table) -> pa.Table:
        n = [_unpack(x) for x in t.column("n").to_pylist()]
        lang = t.column("lang").to_numpy()
        if t.column("shard")[0].as_py() < 0:
            total = np.sum(n, axis=0).astype(np.int64)
            at = np.flatnonzero(total)
            return _count_rows(2, at, np.repeat(lang[0], len(at)), total[at])
        keys = [np.cumsum(_unpack(x), dtype=np.uint64) for x in t.column("words").to_pylist()]
        code = np.repeat(lang, [len(k) for k in keys])
        keys, first, of = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(of, weights=np.concatenate(n)).astype(np.int64)
        often = total >= MIN_COUNT
        return pa.concat_tables([_count_rows(0, keys[often].view(np.int64), code[first][often], total[often]),
                                 _count_rows(1, [0], [0], [total.sum()])])
    sent = docs.select("text", "lang").mapInArrow(run, COUNTS)
    return sent.groupBy("shard").applyInArrow(add, "kind int, key long, lang long, n long")


def _count_rows(kind, key, lang, n) -> pa.Table:
    return pa.table([pa.array(np.full(len(key), kind, np.int32)), *(pa.array(np.asarray(x, np.int64)) for x in (key, lang, n))],
                    names=["kind", "key", "lang", "n"])


def end_hash(code: np.ndarray) -> np.ndarray:
    return _mix(_mix(code) + np.uint64(1))


def unknown_hash(code: np.ndarray) -> np.ndarray:
    return _mix(_mix(code) + np.uint64(2))


@dataclass
class Vocabulary:
    """Sorted word hashes of all languages, with each language's end of text and
    unknown word among them; languages without a word share the code 0."""

    words: np.ndarray
    lang_of: np.ndarray
    langs: np.ndarray
    end: np.ndarray
    unknown: np.ndarray
    hot: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, code: np.ndarray, n: np.ndarray, least_hot: float) -> Vocabulary:
        langs = np.unique(np.append(code, np.uint64(0)))
        every = np.concatenate([end_hash(langs), unknown_hash(langs), keys])
        words, first = np.unique(every, return_index=True)
        place = lambda h: np.searchsorted(words, h)
        hot = np.zeros(len(words), bool)
        hot[place(keys[n > least_hot])] = True
        hot[place(every[:2 * len(langs)])] = True
        lang_of = np.searchsorted(langs, np.concatenate([langs, langs, code]))[first]
        return cls(words, lang_of, langs, place(end_hash(langs)), place(unknown_hash(langs)), hot)

    def lang_places(self, code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.langs, code), len(self.langs) - 1)
        return np.where(self.langs[at] == code, at, 0)

    def places(self, keys: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word, and whether it is known."""
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        known = self.words[at] == keys
        return np.where(known, at, self.unknown[lang]), known


# -- pairs in shards

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
ABOUT = f"doc_id long, lang string, {BASE}, total double"
POSTINGS = "shard int, batch long, about binary, grams binary, runs binary, docs binary, n binary"
_ABOUT = [x.split()[0] for x in ABOUT.split(", ")]
_POSTINGS = [x.split()[0] for x in POSTINGS.split(", ")]


def _pairs(words: Words, place: np.ndarray, end: np.ndarray):
    """(gram, document, times) of the distinct word pairs of each document with
    the word before them, in the order of grams (a pair's places, then that of
    the word before); its start and its end are one word."""
    last = np.flatnonzero(np.append(words.owner[1:] != words.owner[:-1], True))
    doc = np.insert(words.owner, last + 1, words.owner[last])
    ends = end[words.lang_of[words.owner[last]]]
    now = np.insert(place[words.pair_of], last + 1, ends)
    before = np.insert(now[:-1], 0, 0)
    starts = np.append(0, np.flatnonzero(doc[1:] != doc[:-1]) + 1)
    before[starts] = ends
    earlier = np.insert(before[:-1], 0, 0)
    earlier[starts] = ends
    gram = (before.astype(np.uint64) << (_BITS + _BITS)) | (now.astype(np.uint64) << _BITS) | earlier.astype(np.uint64)
    order = np.lexsort((doc, gram))
    gram, doc = gram[order], doc[order]
    at = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])))
    return gram[at], doc[at], np.diff(np.append(at, len(gram)))


def send_postings(docs: DataFrame, vocabulary, letters, shards: int) -> DataFrame:
    """A row of POSTINGS for each batch and shard, and one about the batch's
    documents (their base counts and what their unknown words' spelling adds).
    The pairs of a first word share a shard, but those of hot words are dealt."""
    is_symbol = np.isin(np.arange(256), list(SYMBOLS))

    def one(k, batch, about, gram, doc, n):
        first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.zeros(0, np.int64)
        runs = np.diff(np.append(first, len(gram)))
        return [k, batch, about, _pack(_rising(gram[first])), _pack(runs), _pack(doc), _pack(n)]

    def run(batches):
        v, spell = vocabulary.value, letters.value
        task = TaskContext.get().partitionId()
        for number, b in enumerate(batches):
            raw, rows = byte_values(b.column(1)), b.num_rows
            words = Words(b.column(1).cast(pa.string()), b.column(2).to_pylist())
            total, batch, none = np.zeros(rows), (task << 32) | number, np.zeros(0, np.uint64)
            out = []
            if len(words.codes):
                keys, code = _hashes(words)
                lang = v.lang_places(code)
                place, known = v.places(keys, lang[words.pairs % len(words.langs)])
                before, now, word = _letters(words.distinct)
                spelled = np.bincount(word, weights=spell[before, now], minlength=len(words.distinct))
                total = np.bincount(words.owner, weights=np.where(known[words.pair_of], 0.0, spelled[words.codes]), minlength=rows)
                gram, doc, n = _pairs(words, place, v.end[lang])
                head = gram >> (_BITS + _BITS)
                shard = (_mix(np.where(v.hot[head], gram >> _BITS, head)) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                gram, doc, n = gram[order], doc[order], n[order]
                cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                out = [one(k, batch, None, gram[cuts[k]:cuts[k + 1]], doc[cuts[k]:cuts[k + 1]], n[cuts[k]:cuts[k + 1]])
                       for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()]
            chars = np.asarray(pc.utf8_length(words.distinct)).astype(np.int64)
            about = pa.RecordBatch.from_arrays([
                b.column(0), b.column(2), pa.array(np.bincount(words.owner, minlength=rows)),
                pa.array(np.bincount(words.owner, weights=chars[words.codes], minlength=rows).astype(np.int64)),
                pa.array([int(is_symbol[np.frombuffer(t, np.uint8)].sum()) for t in raw], pa.int64()),
                pa.array([_dup_lines(t) for t in raw], pa.int64()),
                pa.array(repeated_words(words.owner, words.codes, rows)), pa.array(total)], names=_ABOUT)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, about.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(about)
            out.append(one(batch % shards, batch, sink.getvalue().to_pybytes(), none, none, none))
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names=_POSTINGS)
    return docs.select("doc_id", "text", "lang").mapInArrow(run, POSTINGS)


def _counted(t: pa.Table):
    """The sorted distinct pairs of a shard and their counts (the distinct words
    before each), and for each place of the rows' grams its pair."""
    grams, of = np.unique(np.concatenate([np.cumsum(_unpack(x), dtype=np.uint64) for x in t.column("grams").to_pylist()]), return_inverse=True)
    pairs = grams >> _BITS
    new = np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)]
    at = np.flatnonzero(new)
    return pairs[at], np.diff(np.append(at, len(pairs))), (np.cumsum(new) - 1)[of]


#: Totals by place of the vocabulary: of a word as the first of pairs its count and
#: the pairs counted once, twice, 3, 4 and at least 3 times; the words before it.
_TOTALS = 7


def _totals(t: pa.Table, size: int) -> pa.Table:
    keys, n, _ = _counted(t)
    head, tail = (keys >> _BITS).astype(np.int64), (keys & _MASK).astype(np.int64)
    of = lambda chosen: np.bincount(head[chosen], minlength=size)
    x = np.stack([np.bincount(head, weights=n, minlength=size), of(n == 1), of(n == 2), of(n == 3), of(n == 4), of(n >= 3),
                  np.bincount(tail, minlength=size)]).astype(np.uint64)
    parts = np.array_split(x, SLICES, axis=1)
    salt = t.column("shard")[0].as_py() % SLICES
    return pa.table([pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(np.full(SLICES, salt, np.int32)),
                     pa.array([_pack(p.ravel()) for p in parts], pa.binary())], names=["slice", "salt", "totals"])


def _add(t: pa.Table) -> pa.Table:
    total = _unpack(t.column("totals")[0].as_py())
    for x in t.column("totals").to_pylist()[1:]:
        total = total + _unpack(x)
    return pa.table([t.column("slice")[:1], t.column("salt")[:1], pa.array([_pack(total)], pa.binary())], names=["slice", "salt", "totals"])


def _look_up(t: pa.Table, totals: pa.Table, v: Vocabulary) -> pa.Table:
    """batch, about, and the sums of log probabilities by document of a shard."""
    if not t.num_rows:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], pa.binary())], names=["batch", "about", "sums"])
    slices = sorted(zip(totals.column("slice").to_pylist(), totals.column("totals").to_pylist()))
    x = np.concatenate([_unpack(b).reshape(_TOTALS, -1) for _, b in slices], axis=1).astype(np.float64)
    by_lang = lambda a: np.bincount(v.lang_of, weights=a, minlength=len(v.langs))
    cut = discounts(np.stack([by_lang(x[j]) for j in (1, 2, 3, 4)], axis=1))
    types = by_lang(x[6])
    keys, n, of = _counted(t)
    head, tail = (keys >> _BITS).astype(np.int64), (keys & _MASK).astype(np.int64)
    lang = v.lang_of[head]
    back = (x[[1, 2, 5]].T * cut[v.lang_of]).sum(1)
    logp = log_probability(n, cut[lang], x[0][head], back[head], x[6][tail] / types[lang])
    sums, at = [], 0
    for r, m, d in zip(*(t.column(c).to_pylist() for c in ("runs", "n", "docs"))):
        r = _unpack(r).astype(np.int64)
        each = np.repeat(logp[of[at:at + len(r)]], r)
        sums.append(np.bincount(_unpack(d).astype(np.int64), weights=each * _unpack(m)).astype("<f4").tobytes())
        at += len(r)
    return pa.table([t.column("batch"), t.column("about"), pa.array(sums, pa.binary())], names=["batch", "about", "sums"])


def _documents(t: pa.Table) -> pa.Table:
    """The rows about a batch's documents, with the sums of all shards."""
    about = next(x for x in t.column("about").to_pylist() if x is not None)
    out = pa.ipc.open_stream(about).read_all()
    total = out.column("total").to_numpy().copy()
    for s in sorted(t.column("sums").to_pylist()):  # in an order that reruns share
        s = np.frombuffer(s, "<f4").astype(np.float64)
        total[:len(s)] += s
    return out.set_column(out.schema.get_field_index("total"), "total", pa.array(total))


def losses(docs: DataFrame, shard_places: int = SHARD_PLACES) -> DataFrame:
    """The base counts of ``docs`` (doc_id, text, lang) with ``found`` (symbols:
    characters and ends of the words and the text) and ``loss``, the log
    perplexity per symbol (null without words).

    The driver sees the vocabulary (fewer than SHARE words) and the counts of
    byte pairs (66,049), never pairs of words. The shards' exchange is read
    twice, for the totals and for the sums."""
    spark = docs.sparkSession
    counts = stage(word_counts(docs), "quality-words")
    places = counts.filter("kind = 1").agg(F.sum("n")).first()[0] or 0
    shards = -(-places // shard_places) or 1
    kept = counts.filter((F.col("kind") == 0) & (F.col("n") * SHARE > places)).orderBy("key").toArrow()
    pairs = np.zeros((257, 257))
    for r in counts.filter("kind = 2").collect():
        pairs[r.lang, r.key] = r.n
    v = Vocabulary.of(*(kept.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("key", "lang", "n")), places / (8 * shards))
    sizes = len(v.words)
    vocabulary = spark.sparkContext.broadcast(v)
    sent = send_postings(docs, vocabulary, spark.sparkContext.broadcast(spelling(pairs)), shards).repartition(shards, "shard")
    kinds = "slice int, salt int, totals binary"
    totals = sent.groupBy("shard").applyInArrow(lambda t: _totals(t, sizes), kinds)
    totals = totals.groupBy("slice", "salt").applyInArrow(_add, kinds).groupBy("slice").applyInArrow(_add, kinds)
    everywhere = totals.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "slice", "totals").repartition(shards, "shard")
    sums = sent.groupBy("shard").cogroup(everywhere.groupBy("shard")).applyInArrow(
        lambda a, b: _look_up(a, b, vocabulary.value), "batch long, about binary, sums binary")
    out = sums.groupBy("batch").applyInArrow(_documents, ABOUT)
    out = out.withColumn("found", F.when(F.col("n_words") > 0, F.col("word_chars") + F.col("n_words") + 1))
    return out.withColumn("loss", -F.try_divide(F.col("total"), F.col("found"))).drop("total")


# -- the bands

def _quartiles(rows: DataFrame, value, step: float) -> DataFrame:
    """lang and the quartiles q1, q2, q3 of ``value``, read off a histogram of
    fixed steps (its rows follow the range of the values, not the input)."""
    bins = rows.groupBy("lang", F.floor(value / step).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("lang")
    ranked = bins.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("all", F.sum("n").over(w))
    q = lambda p: F.min(F.when(F.col("upto") >= F.col("all") * p, F.col("bin"))) * step
    return ranked.groupBy("lang").agg(q(0.25).alias("q1"), q(0.5).alias("q2"), q(0.75).alias("q3"))


def bands(scored: DataFrame, above: float) -> DataFrame:
    """_lang, ``middle`` and ``over``: a document of n symbols lies in its
    language's band when its log perplexity is between ``LOW * middle`` and
    ``middle + over / sqrt(n)``. The middle is the median; a mean over n symbols
    spreads as 1 / sqrt(n), so the spread is taken of the distances from the
    median times sqrt(n). The lower limit is for texts that repeat little but
    the commonest pairs; those with copies stay above it."""
    good = scored.filter("loss is not null and not base_failed").select("lang", "loss", "found")
    middle = _quartiles(good, F.col("loss"), 1e-4).select(F.col("lang").alias("_l"), F.col("q2").alias("middle"))
    middle = stage(middle, "quality-middle")
    off = good.join(middle, F.col("lang").eqNullSafe(F.col("_l"))).drop("_l")
    t = _quartiles(off, (F.col("loss") - F.col("middle")) * F.sqrt("found"), 1e-2)
    spread = F.greatest((F.col("q3") - F.col("q1")) / 1.349, F.lit(1e-2))
    t = t.select(F.col("lang").alias("_lang"), (spread * above).alias("over"))
    return t.join(middle, F.col("_lang").eqNullSafe(F.col("_l"))).drop("_l")


def _verdict(scored: DataFrame, limits: DataFrame) -> DataFrame:
    # one row per language of the two limits
    out = scored.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    out = out.withColumn("low", F.col("middle") * LOW).withColumn(
        "high", F.col("middle") + F.try_divide(F.col("over"), F.sqrt("found"))).drop("middle", "over")
    inside = F.coalesce(F.col("loss").between(F.col("low"), F.col("high")), F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The base counts, base_failed, found, loss, low, high and kept of every row.

    Null, empty and blank texts have no words and fail the base rules. A null
    language is a language of its own; languages without a word of the
    vocabulary share one model. A language without a document that passes the
    base rules has no band and rejects nothing more. Repeated rows count and are
    judged alike; texts of any length are read whole; other columns are left
    out, so their names don't matter; an empty table gives no rows."""
    arrow_limits(docs.sparkSession, rows=2500, mb=12)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    scored = stage(losses(docs).withColumn("base_failed", failed), "quality-scored")
    return _verdict(scored, bands(scored, ABOVE))

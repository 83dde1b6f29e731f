"""Toxicity by a weighted finite-state pattern grammar.

Words are tagged by a lexicon (insult, threat, target, negation, reported
speech); small transducers then rewrite the tags of a clause: one marks insults
and threats in the scope of a negation, one those in reported speech, one those
aimed at somebody. The speech verb and the target may stand on either side, so
one composed machine reads the clause from the left and one reads what that
gives from the right. Each insult or threat gets a pattern. A document's score
is a logistic function of the weights that its matched clauses add up to by
pattern.

Word lists hold common terms of four languages. Further terms, as word stems of
insults or of threats, and all weights are learned from labelled rows of the
training fold.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import arrow_limits, as_row, from_row, stage

#: Labelled rows that the lexicon and the weights are fitted on, at most.
MAX_TRAIN = 20_000
#: Learned stems: letters (shorter words are learned whole), training documents
#: of label 1 that hold one, least log odds, and how many of its standard errors
#: these are at least.
STEM_LETTERS, MIN_SUPPORT, MIN_ODDS, MIN_ERRORS = range(4, 13), 8, 2.0, 2.0
#: A learned stem is a threat if targets follow it within so many words more often than they precede it.
NEAR = 3
_WHOLE = "$"  # ends a stem that is a whole word

# Fixed word lists of the grammar.
TERMS = {
    "I": """idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb fool jerk imbecile vermin
            dummkopf trottel depp abschaum arschloch versager idiote crétin imbécile connard ordure salaud minable
            estúpido imbécil basura escoria inútil payaso""".split(),
    "T": """kill hurt destroy beat shoot stab strangle murder töten umbringen vernichten verprügeln tuer frapper
            détruire abattre matar golpear destruir""".split(),
    "Y": """you your yours yourself they them their du dich dir dein euch ihr tu toi vous votre ton ils eux tú usted
            ustedes vosotros tus ellos""".split(),
    "N": "not no never n't isn't aren't don't nicht kein keine nie ne pas jamais aucun nunca tampoco".split(),
    "R": """said says wrote quoted reported claimed according sagte schrieb laut berichtete dit écrit selon déclaré
            dijo escribió según afirmó""".split(),
}
TAGS = "OITYNRB"  # B ends a clause
#: Targets, negations and speech verbs keep their tags, whatever is learned.
_MARKS = {w: tag for tag in "YNR" for w in TERMS[tag]}
_END, _TRIM = ".!?;:", "\"'()[]{}<>.,!?;:#*$%&|~_-+=/\\@^`“”«»¿¡…"


@dataclass
class Transducer:
    """A deterministic machine: arcs of (state, symbol) to (state, output);
    symbols without an arc pass unchanged and keep the state."""

    arcs: dict = field(default_factory=dict)
    start: int = 0

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol))

    def states(self):
        return {self.start} | {s for s, _ in self.arcs} | {t for t, _ in self.arcs.values()}


def compose(first: Transducer, second: Transducer, symbols) -> Transducer:
    """The machine that runs ``first`` and gives its outputs to ``second``."""
    out, seen, todo, number = Transducer(), {}, [], {}
    number[(first.start, second.start)] = 0
    todo.append((first.start, second.start))
    while todo:
        pair = todo.pop()
        if pair in seen:
            continue
        seen[pair] = True
        for s in symbols:
            a, mid = first.step(pair[0], s)
            b, end = second.step(pair[1], mid)
            if (a, b) not in number:
                number[(a, b)] = len(number)
                todo.append((a, b))
            elif (a, b) not in seen:
                todo.append((a, b))
            out.arcs[(number[pair], s)] = (number[(a, b)], end)
    return out


def _negation(scope: int = 3) -> Transducer:
    """Insults and threats at most ``scope`` words after a negation."""
    t = Transducer()
    for left in range(scope + 1):
        t.arcs[(left, "N")] = (scope, "N")
        t.arcs[(left, "B")] = (0, "B")
        for s in "OYR":
            t.arcs[(left, s)] = (max(0, left - 1), s)
        for s in "IT":
            t.arcs[(left, s)] = (max(0, left - 1), f"{s}n" if left else s)
    return t


def _mark(pattern: str, mark: str) -> str:
    """``pattern`` with a further mark, in the order of PATTERNS."""
    return pattern[0] + "".join(m for m in "nrt" if m in pattern[1:] + mark)


def _marker(by: str, mark: str, kinds: list[str]) -> Transducer:
    """Marks insults and threats that it reads after ``by`` in their clause."""
    t = Transducer()
    for state in (0, 1):
        t.arcs[(state, by)] = (1, by)
        t.arcs[(state, "B")] = (0, "B")
    for k in kinds:
        t.arcs[(1, k)] = (1, _mark(k, mark))
    return t


def grammar() -> Transducer:
    """Negation, then reported speech, then targets, from the left."""
    plain = ["I", "T", "In", "Tn"]
    told = plain + [k + "r" for k in plain]
    both = compose(_negation(), _marker("R", "r", plain), TAGS)
    return compose(both, _marker("Y", "t", told), TAGS)


PATTERNS = [k + n + r + t for k in "IT" for n in ("", "n") for r in ("", "r") for t in ("", "t")]
MACHINE = grammar()
#: From the right: reported speech, then targets, over what the first machine gives.
BACK = compose(_marker("R", "r", PATTERNS), _marker("Y", "t", PATTERNS), [*"OYNRB", *PATTERNS])


def read(tags) -> list[str]:
    """The tags of a clause with its insults and threats as patterns."""
    out, state = [], MACHINE.start
    for t in tags:
        state, o = MACHINE.step(state, t)
        out.append(o)
    state = BACK.start
    for i in range(len(out) - 1, -1, -1):
        state, out[i] = BACK.step(state, out[i])
    return out


class Lexicon:
    """Tags and weights of words: whole words of the lists, learned stems (with
    tag and weight). Stems go before the lists' insults and threats."""

    def __init__(self, stems: dict[str, tuple[str, float]]):
        self.words = {w: (tag, 1.0) for tag, ws in TERMS.items() for w in ws}
        self.stems = stems
        self.lengths = sorted({len(s) for s in stems if not s.endswith(_WHOLE)}, reverse=True)

    def tag(self, word: str) -> tuple[str, float, str]:
        """(tag, weight, term)."""
        end = "B" if word[-1:] in _END else ""
        w = word.lower().strip(_TRIM)
        if w in _MARKS:
            return _MARKS[w] + end, 1.0, w
        for stem in (*(w[:n] for n in self.lengths if len(w) >= n), w + _WHOLE):
            if stem in self.stems:
                tag, weight = self.stems[stem]
                return tag + end, weight, stem
        tag, weight = self.words.get(w, ("O", 0.0))
        return tag + end, weight, w


N_FEATURES = len(PATTERNS) + 3


def _tagged(lexicon: Lexicon, texts: pa.Array):
    """Per word of a batch: text, code of its distinct word; tags of those."""
    texts = pc.replace_substring(texts.fill_null(""), "\n", " . ")
    split = pc.ascii_split_whitespace(texts)
    flat, off = split.flatten(), np.asarray(split.offsets) - split.offsets[0].as_py()
    owner = np.repeat(np.arange(len(texts)), np.diff(off))
    full = np.asarray(pc.binary_length(flat)) > 0
    coded = flat.filter(pa.array(full)).dictionary_encode()
    tags = [lexicon.tag(w) for w in coded.dictionary.to_pylist()]
    return owner[full], np.asarray(coded.indices).astype(np.int64), tags


def features(lexicon: Lexicon, texts: pa.Array) -> np.ndarray:
    """A row per text: the weights of its matches by pattern, the distinct terms
    matched, the clauses with a match and the matches per word. Only clauses
    that hold an insult or a threat are run through the machine."""
    owner, codes, tags = _tagged(lexicon, texts)
    x = np.zeros((len(texts), N_FEATURES))
    if not len(owner):
        return x
    hot = np.array([t[0][0] in "IT" for t in tags])
    ends = np.array([t[0][-1] == "B" for t in tags])
    last = ends[codes]
    last[np.flatnonzero(owner[1:] != owner[:-1])] = True
    clause = np.concatenate([[0], np.cumsum(last)[:-1]])
    hits = np.flatnonzero(hot[codes])
    if not len(hits):
        return x
    starts = np.searchsorted(clause, np.arange(clause[-1] + 2))
    n_words = np.bincount(owner, minlength=len(texts))
    place = {p: i for i, p in enumerate(PATTERNS)}
    terms: dict[int, set] = {}
    n_hits = np.zeros(len(texts))
    for c in np.unique(clause[hits]).tolist():
        lo, hi = starts[c], starts[c + 1]
        doc = int(owner[lo])
        own = terms.setdefault(doc, set())
        clause_tags = [tags[code] for code in codes[lo:hi].tolist()]
        for (tag, weight, term), out in zip(clause_tags, read([t[0][0] for t in clause_tags])):
            if tag[0] in "IT":
                x[doc, place[out]] += weight
                n_hits[doc] += 1
                own.add(term)
        x[doc, -2] += 1
    for doc, own in terms.items():
        x[doc, -3] = len(own)
    x[:, :-1] = np.log1p(x[:, :-1])
    x[:, -1] = 10 * n_hits / np.maximum(1, n_words)
    return x


def _fold():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> DataFrame:
    """text and toxic of at most ``max_rows`` labelled documents of the training
    fold, by hashed doc_id. A doc_id labelled twice counts as toxic if either
    says so; of rows that share a doc_id the least text is learned from; null
    labels and ids don't count."""
    told = (labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .filter(_fold() != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # at most max_rows rows of two numbers: small enough to broadcast, by that bound
    found = docs.select("doc_id", "text").join(F.broadcast(told), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select(
        "text", F.col("toxic").cast("int").alias("toxic"))


def _stem_counts(rows: DataFrame, among: set[str] | None = None) -> DataFrame:
    """stem and the number of texts with it; only of the stems in ``among``."""
    def run(batches):
        n = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                words = {w.lower().strip(_TRIM) for w in set((text or "").split())} - _MARKS.keys()
                stems = {w[:k] for w in words for k in STEM_LETTERS if len(w) >= k}
                stems |= {w + _WHOLE for w in words if 0 < len(w) < STEM_LETTERS[0]}
                n.update(stems if among is None else stems & among)
        names = list(n)
        for i in range(0, len(names), 100_000):
            part = names[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([n[s] for s in part], pa.int64())], names=["stem", "n"])
    return rows.select("text").mapInArrow(run, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def _sides(rows: DataFrame, stems: set[str]) -> DataFrame:
    """stem and how many more targets follow it within NEAR words of its clause
    than precede it."""
    def run(batches):
        lexicon, n = Lexicon({s: ("I", 1.0) for s in stems}), Counter()
        for b in batches:
            owner, codes, tags = _tagged(lexicon, b.column(0).cast(pa.string()))
            if not len(owner):
                continue
            kind = np.array([t[0][0] for t in tags])[codes]
            ends = np.array([t[0][-1] == "B" for t in tags])[codes]
            ends[np.flatnonzero(owner[1:] != owner[:-1])] = True
            clause = np.concatenate([[0], np.cumsum(ends)[:-1]])
            hits = np.flatnonzero(np.array([t[2] in stems for t in tags])[codes])
            for step in (k for k in range(-NEAR, NEAR + 1) if k):
                at = hits[(hits + step >= 0) & (hits + step < len(codes))]
                at = at[(clause[at] == clause[at + step]) & (kind[at + step] == "Y")]
                for code, times in zip(*(x.tolist() for x in np.unique(codes[at], return_counts=True))):
                    n[tags[code][2]] += times if step > 0 else -times
        names = list(n)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n[s] for s in names], pa.int64())], names=["stem", "n"])
    return rows.select("text").mapInArrow(run, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def learn_stems(train: DataFrame) -> dict[str, tuple[str, float]]:
    """Word stems that tell label 1 from 0, with their tag and log odds. Of stems
    that start with one another, the one with the most evidence stays; there is
    no cap on their number. Texts of label 1 name the candidates; only those are
    counted in the others. ``train`` is bounded, and so is what its stems take."""
    n = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    n_pos, n_neg = n.get(1, 0), sum(v for k, v in n.items() if k != 1)
    if n_pos < MIN_SUPPORT or n_neg < MIN_SUPPORT:
        return {}
    seen = stage(_stem_counts(train.filter("toxic = 1")).filter(F.col("n") >= MIN_SUPPORT).withColumnRenamed("n", "pos"), "toxic-stems")
    among = {r.stem for r in seen.collect()}
    neg = _stem_counts(train.filter("toxic <> 1"), among).withColumnRenamed("n", "neg")
    seen = seen.join(neg, "stem", "left").withColumn("neg", F.coalesce("neg", F.lit(0)))
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    error = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    best = (seen.withColumn("odds", odds).filter((F.col("odds") >= MIN_ODDS) & (F.col("odds") >= MIN_ERRORS * error))
            .withColumn("proof", F.col("pos") * F.col("odds"))
            .orderBy(F.desc("proof"), F.desc(F.length("stem")), "stem").collect())
    kept: dict[str, float] = {}
    starts: set[str] = set()  # of those kept
    for r in best:
        own = [r.stem[:k] for k in range(1, len(r.stem) + 1)]
        if r.stem not in starts and not any(x in kept for x in own):
            kept[r.stem] = float(r.odds)
            starts.update(own)
    if not kept:
        return {}
    side = {r.stem: r.n for r in _sides(train.filter("toxic = 1"), set(kept)).collect()}
    return {x: ("T" if side.get(x, 0) > 0 else "I", w) for x, w in kept.items()}


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, turns: int = 50) -> np.ndarray:
    """Logistic weights by Newton's method, the bias last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[-1] = 1e-6
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Weights without labels of both kinds to learn from: any match counts.
DEFAULT = np.concatenate([np.full(len(PATTERNS), 2.0), [1.0, 1.0, 0.0, -3.0]])


@dataclass
class Model:
    stems: dict
    weights: np.ndarray


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> Model:
    """Fit stems (with their tags) and weights on the training fold. At most ``max_rows`` rows of
    features reach the driver."""
    arrow_limits(docs.sparkSession)
    train = stage(training_rows(docs, labels, max_rows), "toxic-train")
    stems = learn_stems(train)

    def run(batches):
        lexicon = Lexicon(stems)
        for b in batches:
            x = features(lexicon, b.column(0).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])
    rows = train.mapInArrow(run, "y int, x array<double>").collect()
    y = np.array([float(r.y == 1) for r in rows])
    if len(y) < 2 * MIN_SUPPORT or not 0 < y.sum() < len(y):
        return Model(stems, DEFAULT)
    order = np.lexsort((*np.array([r.x for r in rows]).T, y))  # sums don't depend on the order rows came in
    return Model(stems, fit_weights(np.array([r.x for r in rows])[order], y[order]))


def _scores(lexicon: Lexicon, weights: np.ndarray, texts: pa.Array) -> pa.Array:
    z = np.clip(features(lexicon, texts.cast(pa.string())) @ weights[:-1] + weights[-1], -30, 30)
    return pa.array(1 / (1 + np.exp(-z)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Only the text is scored.

    Null and empty texts have no matches and score as the bias says; a null
    doc_id is not held out; repeated rows give repeated results; texts of any
    length are read whole; other columns are not read, so their names don't
    matter; an empty table gives no rows."""
    arrow_limits(docs.sparkSession)
    stems, weights = model.stems, model.weights

    def run(batches):
        lexicon = Lexicon(stems)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), _scores(lexicon, weights, b.column(0))], names=["doc_id", "score"])
    cols = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"))
    out = cols.mapInArrow(run, StructType([StructField("doc_id", cols.schema["doc_id"].dataType), StructField("score", DoubleType())]))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns
    unchanged, whatever their names. Nulls, empty and long texts, repeated rows
    and empty tables as in :func:`score`."""
    arrow_limits(docs.sparkSession)
    stems, weights = model.stems, model.weights
    rows = docs.select(F.col(text_col).alias("text"), as_row(docs, [text_col]).alias("row"))

    def run(batches):
        lexicon = Lexicon(stems)
        for b in batches:
            clean = pc.less(_scores(lexicon, weights, b.column(0)), 0.5)
            yield b.filter(clean)
    return rows.mapInArrow(run, rows.schema).select(*from_row(docs, replace={text_col: F.col("text")}))

"""Mixing sources to target weights by a low-discrepancy schedule.

The words of each source, its documents in a hashed order, form a stream that
is cut into equal blocks. The mix is a row of slots of one block each: slot
``k`` has the base-2 van der Corput point of ``k``, and the cumulative weights
say which source that point falls to. The j-th slot of a source takes the j-th
block of its stream, which starts again after its end (an epoch), and a source
closes when its target is reached. Over the first 2**m slots the points are the
grid i / 2**m, so with 2**m at least the number of blocks wanted, every source
gets at least its blocks.

All of it is built from Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, as_row, buckets_for, from_row, row_order, stage, text_of

#: Words of a block.
BLOCK = 1024
#: Contract: weights by place of the source, repeating; share of all words; epochs at most.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2.0
#: Documents of a source that one task numbers, and slots of a source.
DOCS_PER_BUCKET, SLOTS_PER_CHUNK = 5_000, 65_536


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """One row per source (null is a source, last in order): ``source_size``,
    ``target``. Targets share ``share`` times all words by weight; one above
    ``epochs`` times its source's words stops there and the excess goes to the
    others by weight, until none is above. A row per source is all it handles;
    two sums a turn reach the driver."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place % len(weights) + 1).cast("int"))
    open_ = stage(sources.withColumn("weight", w), "mix-sources")
    cap = F.col("source_size") * F.lit(float(epochs))
    total = open_.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        # sources whose level share is above their cap are closed at it
        shut = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        r = open_.agg(F.sum(F.when(shut, cap).otherwise(0.0)).alias("fixed"),
                      F.sum(F.when(shut, 0.0).otherwise(F.col("weight"))).alias("w"),
                      F.sum(shut.cast("int")).alias("n")).first()
        if r.n is None or r.n == capped:
            break
        capped = r.n
        if not r.w:
            break
        level = (share * total - r.fixed) / r.w
    level = level or 0.0
    return open_.select("source", "source_size",
                        F.least(F.col("weight") * F.lit(level), cap).alias("target"))


def _stream(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``at``: the words before the document in its source's
    hashed order. A source of any size is split into buckets of that order."""
    n = sizes.count()
    bits = max(0, (buckets_for(n, DOCS_PER_BUCKET) - 1).bit_length())
    df = sizes.withColumn("_h", F.xxhash64("doc_id", F.lit("mix")))
    df = df.withColumn("_b", F.shiftright(F.col("_h"), 63 - bits) if bits else F.lit(0).cast("long"))
    sums = df.groupBy("source", "_b").agg(F.sum("size").alias("_n"))
    before = sums.select(F.col("source").alias("_source"), F.col("_b").alias("_bucket"), F.coalesce(F.sum("_n").over(
        Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("size").over(
        Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "size", "own")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (df.withColumn("_inside", inside)
            .join(before, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_b") == F.col("_bucket")))
            .withColumn("at", F.col("_before") + F.col("_inside"))
            .drop("_h", "_b", "_inside", "_source", "_bucket", "_before"))


def schedule(goal: DataFrame, block: int = BLOCK) -> DataFrame:
    """The slots: ``slot``, ``source``, ``epoch``, ``block`` (of the source) and
    ``words`` taken from the block. ``goal`` is the result of ``targets``."""
    spark = goal.sparkSession
    want = goal.filter("source_size > 0").withColumn("goal", F.round("target").cast("long")).filter("goal > 0")
    # words are taken in turns of the stream: its last block may be shorter
    per_turn = F.ceil(F.col("source_size") / block).cast("long")
    turns = F.floor(F.col("goal") / F.col("source_size"))
    rest = F.col("goal") - turns * F.col("source_size")
    want = want.withColumn("per_turn", per_turn).withColumn(
        "slots", (turns * per_turn + F.ceil(rest / block)).cast("long"))
    upto = F.sum("slots").over(Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    want = stage(want.withColumn("hi", upto).withColumn("lo", F.col("hi") - F.col("slots")), "mix-wanted")
    n = want.agg(F.sum("slots")).first()[0] or 0
    bits = max(1, (max(n, 1) - 1).bit_length())
    parts = buckets_for(1 << bits, 1 << 18)
    reverse = F.conv(F.reverse(F.lpad(F.bin("id"), bits, "0")), 2, 10).cast("long")
    # points as whole numbers: i * n / 2**bits is the place among the n wanted slots
    place = F.expr(f"cast((cast(point as decimal(30,0)) * {n}) div {1 << bits} as long)")
    cell = max(1, n >> 12)
    slots = (spark.range(0, 1 << bits if n else 0, 1, parts).withColumn("point", reverse).withColumn("place", place)
             .withColumn("cell", F.floor(F.col("place") / cell).cast("long")))
    # cells turn the interval lookup into an equality join
    owners = want.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell))))
    owned = slots.join(owners, "cell").filter("place >= lo and place < hi").withColumn(
        "_c", F.floor(F.col("id") / SLOTS_PER_CHUNK))
    counts = owned.groupBy("source", "_c").agg(F.count(F.lit(1)).alias("_n"))
    first = counts.select(F.col("source").alias("_source"), F.col("_c").alias("_chunk"), F.coalesce(F.sum("_n").over(
        Window.partitionBy("source").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    ranked = (owned.withColumn("_r", F.row_number().over(Window.partitionBy("source", "_c").orderBy("id")) - 1)
              .join(first, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_c") == F.col("_chunk")))
              .withColumn("rank", F.col("_first") + F.col("_r"))
              .filter("rank < slots"))
    start = F.col("block") * block
    left = F.col("goal") - F.col("epoch") * F.col("source_size") - start
    return (ranked.withColumn("epoch", F.expr("rank div per_turn")).withColumn("block", F.expr("rank % per_turn"))
            .withColumn("words", F.least(F.lit(block).cast("long"), F.col("source_size") - start, left))
            .select(F.col("id").alias("slot"), "source", "epoch", "block", "words"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        block: int = BLOCK, weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> tuple[DataFrame, DataFrame]:
    """(documents, spans). Documents: doc_id, source, size, own (a hash of the
    text), source_size, target and ``at``, the words before it in its source's stream. Spans: slot, source,
    epoch, block, doc_id, size, ``at``, ``skip`` (the document's words before
    the span) and ``words``: what each slot of the mix takes from which document.

    Null texts have size 0, as have texts of blanks alone; they take part in no
    span. A null source is a source. Equal doc_ids are told apart by ``at``.
    Other columns of ``docs`` are left out. No words at all: targets of 0 and
    no spans."""
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
                        F.xxhash64(text_of(text_col)).alias("own"))
    sizes = stage(sizes, "mix-sizes")
    goal = stage(targets(sizes, weights, share, epochs), "mix-targets")
    placed = _stream(sizes)
    placed = stage(placed.join(goal.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "mix-placed")
    slots = schedule(goal, block)
    cut = (placed.filter("size > 0")
           .select("doc_id", "source", "size", "at", F.explode(F.sequence(
               F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}"))).alias("block"))
           .withColumn("lo", F.greatest(F.lit(0).cast("long"), F.col("at") - F.col("block") * block))
           .withColumn("hi", F.least(F.lit(block).cast("long"), F.col("at") + F.col("size") - F.col("block") * block)))
    s = slots.withColumnRenamed("source", "_s").withColumnRenamed("block", "_k")
    spans = (cut.join(s, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_k")))
             .withColumn("n", F.least(F.col("hi"), F.col("words")) - F.col("lo")).filter("n > 0")
             .select("slot", "source", "epoch", "block", "doc_id", "size", "at",
                     (F.col("block") * block + F.col("lo") - F.col("at")).alias("skip"), F.col("n").alias("words")))
    return placed, spans


def taken(placed: DataFrame, spans: DataFrame) -> DataFrame:
    """``placed`` with ``taken``: the words the mix takes of each document."""
    per = spans.groupBy(F.col("source").alias("_s"), F.col("at").alias("_at")).agg(F.sum("words").alias("_taken"))
    on = F.col("source").eqNullSafe(F.col("_s")) & (F.col("at") == F.col("_at")) & (F.col("size") > 0)
    return (placed.join(per, on, "left").withColumn("taken", F.coalesce("_taken", F.lit(0).cast("long")))
            .drop("_s", "_at", "_taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: once for each epoch
    in which it takes at least half of the document's words. A source's slots
    end inside at most one document, so whole documents differ from its target
    by less than one. Documents without words are in no mix.

    All columns pass through unchanged, whatever their names. Null ids and
    sources are values like others. Rows that agree in id, source and text share
    their turns evenly; an odd one goes to the first by their other columns, so
    reruns agree. An empty table gives no rows."""
    keyed = docs.select(as_row(docs).alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        F.xxhash64(text_of(text_col)).alias("own"), row_order(docs, [id_col, source_col, text_col]).alias("rest"))
    placed, spans = mix(docs, id_col, source_col, text_col, **how)
    turns = (spans.groupBy("source", "at", "epoch").agg(F.sum("words").alias("n"), F.first("size").alias("size"))
             .filter("2 * n >= size").groupBy(F.col("source").alias("_s"), F.col("at").alias("_at"))
             .agg(F.count(F.lit(1)).alias("times")))
    on = F.col("source").eqNullSafe(F.col("_s")) & (F.col("at") == F.col("_at"))
    # rows equal in doc_id, source and text stand for each other
    per = (placed.filter("size > 0").join(turns, on, "left").groupBy("doc_id", "source", "own")
           .agg(F.coalesce(F.sum("times"), F.lit(0)).alias("times"), F.count(F.lit(1)).alias("rows")).filter("times > 0")
           .select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("own").alias("_own"), "times", "rows"))
    both = keyed.join(per, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("own") == F.col("_own")))
    # n equal rows share their turns: each takes every n-th of them
    w = Window.partitionBy("_id", "_source", "_own").orderBy("rest")
    share = F.expr("times div rows") + (F.col("k") <= F.expr("times % rows")).cast("long")
    out = both.withColumn("k", F.row_number().over(w)).withColumn("times", share).filter("times > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("turn")).select(*from_row(docs))

"""Evaluation metrics as aggregates: exact-match classification scores,
precision@k, corpus BLEU, review gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def eval_exact(pairs: DataFrame, pred: str = "prediction", gold: str = "answer") -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 with the
    predicted and true strings as class labels (undefined ratios = 0).

    Per-class counts come from two small group-bys (classes x 1 row)."""
    p = pairs.select(F.col(pred).cast("string").alias("p"), F.col(gold).cast("string").alias("g"))
    tp = p.where(F.col("p") == F.col("g")).groupBy(F.col("g").alias("c")).agg(F.count(F.lit(1)).alias("tp"))
    npred = p.groupBy(F.col("p").alias("c")).agg(F.count(F.lit(1)).alias("n_pred"))
    ngold = p.groupBy(F.col("g").alias("c")).agg(F.count(F.lit(1)).alias("support"))
    cls = ngold.join(npred, "c", "full_outer").join(tp, "c", "left").fillna(0, ["tp", "n_pred", "support"])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    per = cls.select("support", "tp", prec.alias("prec"), rec.alias("rec"), f1.alias("f1"))
    return per.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("prec") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("rec") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
        F.sum("support").alias("n"))


def precision_at_k(hits: DataFrame, relevant: str = "relevant", k: int = 10) -> DataFrame:
    """Mean over queries of (relevant hits in the top k) / k."""
    per_q = hits.where(F.col("rank") <= k).groupBy("qid").agg(
        (F.sum(F.col(relevant).cast("int")) / F.lit(float(k))).alias("p"))
    return per_q.agg(F.avg("p").alias(f"precision_at_{k}"), F.count(F.lit(1)).alias("n_queries"))


def _ngrams(tokens, n):
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - n + 1)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))


def _clipped(grams):
    """Of sorted (gram, role) the sum over grams of the lesser count of the two roles."""
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit("").alias("gram"), zero.alias("c"), zero.alias("r"), zero.alias("match"))

    def step(a, x):
        own, other = (x["role"] == 0).cast("long"), (x["role"] == 1).cast("long")
        same = a["gram"] == x["gram"]
        return F.struct(x["gram"].alias("gram"), (F.when(same, a["c"]).otherwise(zero) + own).alias("c"),
                        (F.when(same, a["r"]).otherwise(zero) + other).alias("r"),
                        (a["match"] + F.when(same, zero).otherwise(F.least(a["c"], a["r"]))).alias("match"))
    return F.aggregate(grams, start, step, lambda a: a["match"] + F.least(a["c"], a["r"]))


def corpus_bleu(pairs: DataFrame, cand: str = "candidate", ref: str = "reference", max_n: int = 4) -> DataFrame:
    """Corpus BLEU (single reference, whitespace tokens, uniform weights): the
    n-grams of a pair's candidate and reference are clipped in the pair's own row
    and only counts leave it; they are summed per n, and the unigram totals give
    the lengths for the brevity penalty. 0 when any precision is 0. Rows that
    share a ``pair_id`` are one pair, and a null text has no words."""
    words = lambda t: F.filter(F.split(F.trim(t), r"\s+"), lambda x: x != "")
    rows = pairs.groupBy("pair_id").agg(F.collect_list(F.struct(F.col(cand).alias("c"), F.col(ref).alias("r"))).alias("rows"))
    tokens = lambda side: F.array_compact(F.transform("rows", lambda x: words(x[side])))
    bound = F.array(F.struct(tokens("c").alias("c"), tokens("r").alias("r")))

    def counted(x):
        def of(n):
            grams = lambda side, role: F.flatten(F.transform(x[side], lambda t: F.transform(
                _ngrams(t, n), lambda g: F.struct(g.alias("gram"), F.lit(role).alias("role")))))
            both = F.array(F.struct(grams("c", 0).alias("c"), grams("r", 1).alias("r")))
            return F.transform(both, lambda g: F.struct(_clipped(F.sort_array(F.concat(g["c"], g["r"]))).alias("match"),
                                                        F.size(g["c"]).cast("long").alias("total"), F.size(g["r"]).cast("long").alias("ref_total")))[0]
        return F.struct(*[of(n).alias(f"n{n}") for n in range(1, max_n + 1)])
    per_pair = rows.select(F.transform(bound, counted)[0].alias("x"))
    p = per_pair.groupBy().agg(
        *[F.coalesce(F.try_divide(F.sum(f"x.n{n}.match"), F.sum(f"x.n{n}.total")), F.lit(0.0)).alias(f"p{n}") for n in range(1, max_n + 1)],
        F.coalesce(F.sum("x.n1.total"), F.lit(0)).alias("c_len"), F.coalesce(F.sum("x.n1.ref_total"), F.lit(0)).alias("r_len"))
    logs = [F.log(F.col(f"p{n}")) for n in range(1, max_n + 1)]
    any_zero = None
    for n in range(1, max_n + 1):
        z = F.col(f"p{n}") <= 0
        any_zero = z if any_zero is None else (any_zero | z)
    bp = F.when(F.col("c_len") >= F.col("r_len"), F.lit(1.0)).otherwise(
        F.exp(1 - F.col("r_len") / F.greatest(F.col("c_len"), F.lit(1))))
    geo = F.exp(sum(logs[1:], logs[0]) / max_n)
    return p.select(*[F.col(f"p{n}") for n in range(1, max_n + 1)], bp.alias("bp"),
                    F.when(any_zero, F.lit(0.0)).otherwise(bp * geo).alias("bleu"))


def review_gate(yes: DataFrame, yes_col: str, precision: DataFrame, prec_col: str,
                min_yes: float = 0.75, min_precision: float = 0.7) -> DataFrame:
    """Release gate: share of "yes" on the review sample and retrieval
    precision against thresholds (parameters)."""
    y = yes.agg(F.avg(F.col(yes_col).cast("double")).alias("yes_share"), F.count(F.lit(1)).alias("n_reviewed"))
    pr = precision.select(F.col(prec_col).alias("precision"))
    yv = y.select("yes_share").scalar()
    nv = y.select("n_reviewed").scalar()
    return pr.select(yv.alias("yes_share"), nv.alias("n_reviewed"), "precision",
                     ((yv >= min_yes) & (F.col("precision") >= min_precision)).alias("passed"))


"""Aggregations and window top-N: file rollups, dedupe, statistics.

Per-group outputs are built from bounded partial aggregates (counts, sums,
``max`` of boolean flags), so a hot group never materialises as one list:
Spark combines map-side before the shuffle. Where the reference emits an
unbounded list per group (function ids of a file), it is kept as rows
(``file_members``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import metrics as M

TAGS_WITH_OTHER = sorted(M.TAG_ORDER + ["other"])  # binary order, "I/O" first


def unit_flags(units: DataFrame, body: str = "body", path: str = "file_path") -> DataFrame:
    """Units + loc, cyclomatic and one boolean per tag and per risk note."""
    b = F.col(body)
    return units.select("*", M.loc(b).alias("loc"), M.cyclomatic(b).alias("cyclomatic"),
                        *M.intent_tag_flags(b, path), *M.risk_note_flags(b, path))


def tags_from_flags(prefix: str = "") -> Column:
    return F.array_compact(F.array(*[F.when(F.col(prefix + M.tag_col(t)), F.lit(t)) for t in TAGS_WITH_OTHER]))


def enrich_units(units: DataFrame, body: str = "body", path: str = "file_path") -> DataFrame:
    """Function rows with loc, cyclomatic, calls, intent_tags, risk_notes."""
    f = unit_flags(units, body, path)
    flag_cols = [M.tag_col(t) for t in TAGS_WITH_OTHER] + [c for c, _ in M.NOTE_COLUMNS]
    return (f.withColumn("calls", M.call_sites(F.col(body)))
             .withColumn("intent_tags", tags_from_flags())
             .withColumn("risk_notes", M.notes_from_flags())
             .drop(*flag_cols))


def file_rollup(flagged: DataFrame, path: str = "file_path") -> DataFrame:
    """One row per file: function count, summed loc and cyclomatic, the
    sorted union of tags, and the file's distinct risk notes in rule order.

    Input: :func:`unit_flags` output. Aggregates only (partial + final)."""
    tag_cols = [M.tag_col(t) for t in TAGS_WITH_OTHER]
    note_cols = [c for c, _ in M.NOTE_COLUMNS]
    agg = flagged.groupBy(path).agg(
        F.count(F.lit(1)).alias("num_functions"),
        F.sum("loc").cast("bigint").alias("loc"),
        F.sum("cyclomatic").cast("bigint").alias("cyclomatic"),
        *[F.max(F.col(c)).alias(c) for c in tag_cols + note_cols])
    return agg.select(
        F.concat(F.lit("file:"), F.col(path)).alias("id"), F.col(path).alias("file_path"),
        "num_functions", "loc", "cyclomatic",
        tags_from_flags().alias("intent_tags"), M.notes_from_flags().alias("risk_notes"))


def file_members(units: DataFrame, id_col: str = "id", path: str = "file_path") -> DataFrame:
    """The reference's per-file ``functions`` list, kept as rows; file order
    is ``start_line`` (a projection: no shuffle, no per-file group)."""
    return units.select(path, id_col, "start_line")


def top_n_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """``row_number() <= n`` per group; Catalyst plans a partial
    WindowGroupLimit before the shuffle, so hot groups are cut map-side."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_n_per_file(units: DataFrame, n: int = 8, text: str = "summary", path: str = "file_path") -> DataFrame:
    """The file prompt content: the ``n`` largest functions by loc (ties in
    start order), their ``text`` joined by blank lines. Bounded: at most n
    rows per file reach the collect."""
    top = top_n_per_group(units, path, [F.col("loc").desc(), F.col("start_line").asc()], n)
    return (top.groupBy(path)
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.coalesce(F.col(text), F.lit("")).alias("t")))),
                                             lambda x: x["t"]), "\n\n").alias("top_text"),
                    F.count(F.lit(1)).alias("n_top")))


def files_in_parts(units: DataFrame, n: int = 8, text: str = "summary", path: str = "file_path") -> DataFrame:
    """Every function of a file, largest first (ties in start order), ``n`` to a
    part: (file_path, part, top_text, n_top). Part 0 is ``top_n_per_file``."""
    w = Window.partitionBy(path).orderBy(F.col("loc").desc(), F.col("start_line").asc())
    ranked = units.withColumn("rank", F.row_number().over(w)).withColumn("part", F.expr(f"cast((rank - 1) div {n} as int)"))
    item = F.struct("rank", F.coalesce(F.col(text), F.lit("")).alias("t"))
    return ranked.groupBy(path, "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]), "\n\n").alias("top_text"),
        F.count(F.lit(1)).alias("n_top"))


def dedupe_exact(records: DataFrame, order: str = "id", text: str = "text", min_chars: int = 0, min_lines: int = 0,
                 key: str = "sha256") -> DataFrame:
    """(key, order): for each whole text, known by its SHA-256, the smallest
    ``order``, after dropping texts shorter than ``min_chars`` / ``min_lines``.
    An aggregate, so copies collapse before the shuffle and no text moves;
    semi-join on ``order`` for further columns."""
    t = F.coalesce(F.col(text), F.lit(""))
    kept = records.where((F.length(t) >= min_chars) & (F.size(F.split(t, M.SPLITLINES_RE)) >= min_lines))
    return kept.groupBy(F.sha2(t.cast("binary"), 256).alias(key)).agg(F.min(order).alias(order))


def index_stats(index: DataFrame, size: str = "file_size", sha: str = "sha256") -> DataFrame:
    """Files, total bytes, failures (no hash) and human-readable bytes."""
    return index.agg(F.count(F.lit(1)).alias("files"), F.sum(size).cast("bigint").alias("total_bytes"),
                     F.sum(F.col(sha).isNull().cast("int")).cast("bigint").alias("failures")) \
                .withColumn("total_human", human_bytes(F.col("total_bytes")))


def human_bytes(n: Column) -> Column:
    """``%3.1f`` + unit over B, KB, MB, GB, TB, else PB (1024 steps)."""
    x = n.cast("double")
    expr = None
    for i, u in enumerate(["B", "KB", "MB", "GB", "TB"]):
        cond = x < F.lit(1024.0 ** (i + 1))
        val = F.concat(F.format_string("%.1f", x / F.lit(1024.0 ** i)), F.lit(u))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.concat(F.format_string("%.1f", x / F.lit(1024.0 ** 5)), F.lit("PB")))


def iec_bytes(n: Column) -> Column:
    """``numfmt --to=iec --suffix=B``: integer below 1024, else one decimal
    (rounded up) below 10 and a whole number from 10, units K M G T P E."""
    x = n.cast("double")
    expr = F.when(x < 1024, F.concat(n.cast("bigint").cast("string"), F.lit("B")))
    for i, u in enumerate(["K", "M", "G", "T", "P", "E"], start=1):
        v = x / F.lit(1024.0 ** i)
        txt = F.when(F.ceil(v * 10) / 10 < 10, F.format_string("%.1f", F.ceil(v * 10) / 10)) \
               .otherwise(F.ceil(v).cast("bigint").cast("string"))
        expr = expr.when(x < F.lit(1024.0 ** (i + 1)), F.concat(txt, F.lit(u + "B")))
    return expr


def path_prefix_usage(paths: DataFrame, path: str, size: str, depth: int = 2, top: int = 20) -> DataFrame:
    """Bytes per directory prefix up to ``depth`` levels (like ``du -d``),
    largest ``top`` first. Prefixes are exploded per row and summed with a
    partial aggregate; only the final top-n is ordered."""
    parts = F.split(F.regexp_replace(F.col(path), r"^/+|/+$", ""), "/")
    dirs = F.slice(parts, 1, F.size(parts) - 1)
    levels = F.sequence(F.lit(0), F.least(F.size(dirs), F.lit(depth)))
    ex = paths.select(F.col(size).alias("_b"), dirs.alias("_d"), F.explode(levels).alias("lvl"))
    ex = ex.select("_b", F.when(F.col("lvl") == 0, F.lit("."))
                          .otherwise(F.array_join(F.slice("_d", 1, F.col("lvl")), "/")).alias("prefix"))
    agg = ex.groupBy("prefix").agg(F.sum("_b").cast("bigint").alias("bytes"))
    return (agg.orderBy(F.col("bytes").desc(), F.col("prefix").asc()).limit(top)
               .withColumn("human", iec_bytes(F.col("bytes"))))


def call_stats_total(calls: DataFrame, prompts: str, tokens: str, latency: str, ts: str) -> DataFrame:
    """Totals of model calls: count, prompts, tokens, mean latency, last."""
    return calls.agg(F.count(F.lit(1)).alias("total_calls"),
                     F.sum(prompts).cast("bigint").alias("total_prompts"),
                     F.sum(tokens).cast("bigint").alias("total_tokens"),
                     F.avg(latency).alias("average_latency_s"), F.max(ts).alias("last_update"))


def call_stats_running(calls: DataFrame, order: list[str], prompts: str, tokens: str, latency: str, ts: str) -> DataFrame:
    """After every call the totals, mean latency and last time so far, in
    ``order`` (unique). Latencies are summed as decimals, so the mean doesn't
    depend on how rows are grouped."""
    from .scale import running
    exact = F.col(latency).cast("decimal(28,9)")
    c = calls.withColumn("_one", F.lit(1)).withColumn("_timed", exact.isNotNull().cast("int")).withColumn("_latency", exact)
    r = running(c, order, {"total_calls": "_one", "total_prompts": prompts, "total_tokens": tokens, "_sum": "_latency", "_n": "_timed"},
                {"last_update": ts})
    return r.withColumn("average_latency_s", F.when(F.col("_n") > 0, F.col("_sum").cast("double") / F.col("_n"))).drop("_one", "_timed", "_latency", "_sum", "_n")


def scc_sizes(nodes: DataFrame, comp: str = "scc_id") -> DataFrame:
    """Component sizes; ``in_cycle`` = size > 1."""
    return nodes.groupBy(comp).agg(F.count(F.lit(1)).alias("size")).withColumn("in_cycle", F.col("size") > 1)

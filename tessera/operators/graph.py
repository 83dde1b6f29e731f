"""Call graph and graph algorithms as DataFrame joins.

Graphs are two DataFrames: nodes and edges. Adjacency is never nested into
per-node arrays (a hub's whole neighbourhood would land in one row); degree
columns are partial-aggregated counts. Iterative algorithms run a driver
loop whose only actions are ``count``/``isEmpty`` on the frontier, and each
round is checkpointed reliably into the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions import metrics as M
from ..session import cut_lineage, drop_state, free_shuffles


# ---------------------------------------------------------------------------
# Edges
# ---------------------------------------------------------------------------

def raw_calls(units: DataFrame) -> DataFrame:
    """(src, src_file, callee) per distinct call-site name, self excluded."""
    return (units.select(F.col("id").alias("src"), F.col("file_path").alias("src_file"), "name",
                         F.explode(F.array_distinct(M.call_sites("body"))).alias("callee"))
                 .where(F.col("callee") != F.col("name")).drop("name"))


def call_counts(units: DataFrame) -> DataFrame:
    """Static call count per (caller, callee name), duplicates counted."""
    ex = units.select(F.col("id").alias("src"), F.explode(M.call_sites("body")).alias("callee"))
    return ex.groupBy("src", "callee").agg(F.count(F.lit(1)).alias("n_calls"))


def definitions(units: DataFrame) -> DataFrame:
    return units.select(F.col("id").alias("dst"), F.col("file_path").alias("dst_file"), F.col("name").alias("callee"))


def call_edges_in_file(units: DataFrame) -> DataFrame:
    """Same-file edges of the parse stage: a callee name resolves to the
    last definition of that name in the file; self calls excluded."""
    last_def = (units.groupBy("file_path", "name")
                     .agg(F.max_by("id", F.struct("start_line", "id")).alias("dst"))
                     .withColumnRenamed("file_path", "src_file").withColumnRenamed("name", "callee"))
    return raw_calls(units).join(last_def, ["src_file", "callee"]).select("src", "dst", "src_file", "callee").distinct()


def salted_name_join(calls: DataFrame, defs: DataFrame, hot_defs: int, salts: int) -> DataFrame:
    """``calls`` x ``defs`` on ``callee`` with hot names split over
    ``salts`` tasks: a name with more than ``hot_defs`` definitions has each
    call replicated once per salt while each definition goes to exactly one
    salt (hash of its id), so every (call, definition) pair appears once and
    the fan-out of one name is spread instead of landing in one task."""
    counts = defs.groupBy("callee").agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > hot_defs).select("callee", F.lit(True).alias("_hot"))
    c = calls.join(hot, "callee", "left")
    d = defs.join(hot, "callee", "left")
    cold = (c.where(F.col("_hot").isNull()).drop("_hot")
             .join(d.where(F.col("_hot").isNull()).drop("_hot"), "callee"))
    hot_calls = (c.where(F.col("_hot")).drop("_hot")
                  .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    hot_defs_df = (d.where(F.col("_hot")).drop("_hot")
                    .withColumn("_salt", F.pmod(F.xxhash64("dst"), F.lit(salts)).cast("int")))
    warm = hot_calls.join(hot_defs_df, ["callee", "_salt"]).drop("_salt")
    return cold.unionByName(warm)


def resolve_callees(units: DataFrame, calls: DataFrame | None = None, hot_defs: int = 10_000,
                    salts: int = 64) -> tuple[DataFrame, DataFrame]:
    """Tiered resolution of call-site names.

    1. the callee text is a function id; 2. every definition of that name in
    the caller's file; 3. every definition of that name in any file;
    4. otherwise external. Returns (edges[src, dst, tier], external[src,
    callee]). Tiers are separated with semi/anti joins on distinct keys;
    in tier 3, names with more than ``hot_defs`` definitions are joined
    salted over ``salts`` tasks (:func:`salted_name_join`); AQE's skew join
    covers the rest. ``calls`` may be passed precomputed (:func:`raw_calls`, e.g. written
    once as a stage) so the call-site regex is not re-run per tier."""
    calls = raw_calls(units) if calls is None else calls
    defs = definitions(units)
    ids = defs.select(F.col("dst").alias("callee")).distinct()
    by_id = calls.join(ids, "callee", "left_semi").select("src", F.col("callee").alias("dst"), F.lit(1).alias("tier"))
    rest = calls.join(ids, "callee", "left_anti")
    file_keys = defs.select(F.col("dst_file").alias("src_file"), "callee").distinct()
    same = (rest.join(defs.withColumnRenamed("dst_file", "src_file"), ["src_file", "callee"])
                .select("src", "dst", F.lit(2).alias("tier")))
    rest = rest.join(file_keys, ["src_file", "callee"], "left_anti")
    names = defs.select("callee").distinct()
    anyf = salted_name_join(rest, defs, hot_defs, salts).select("src", "dst", F.lit(3).alias("tier"))
    external = rest.join(names, "callee", "left_anti").select("src", "callee").distinct()
    edges = by_id.unionByName(same).unionByName(anyf)
    edges = edges.groupBy("src", "dst").agg(F.min("tier").alias("tier"))
    return edges, external


#: Calls of one name from which on they are told by a broadcast row and don't
#: meet in a task (so there are at most that part of the calls' number of rows).
HOT_CALLS = 100_000


def split_known(calls: DataFrame, names: DataFrame, hot_calls: int = HOT_CALLS) -> tuple[DataFrame, DataFrame]:
    """The ``calls`` whose callee is one of ``names`` (callee, distinct), and the
    others. Calls are counted by name before they meet; those of a name with more
    than ``hot_calls`` (``if``, ``printf``) stay where they are."""
    hot = calls.groupBy("callee").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_calls).select("callee")
    hot = hot.join(names.withColumn("_is", F.lit(True)), "callee", "left").select("callee", F.coalesce("_is", F.lit(False)).alias("_is"))
    marked = calls.join(F.broadcast(hot), "callee", "left")
    rare = marked.where(F.col("_is").isNull()).drop("_is")
    known = marked.where(F.col("_is")).drop("_is").unionByName(rare.join(names, "callee", "left_semi"))
    others = marked.where(~F.col("_is")).drop("_is").unionByName(rare.join(names, "callee", "left_anti"))
    return known.select(*calls.columns), others.select(*calls.columns)


def name_graph(units: DataFrame, calls: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The call graph through name nodes: (src, key) for what a function calls
    and (key, dst) for what a key stands for. The key is the callee's name in
    the caller's file if that file defines it, else the name anywhere, so the
    paths src -> key -> dst are exactly the resolved edges, in as many rows as
    there are calls and definitions instead of their products. Names that nobody
    defines are no nodes."""
    calls = raw_calls(units) if calls is None else calls
    defs = definitions(units)
    ids = defs.select(F.col("dst").alias("callee")).distinct()
    known, _ = split_known(calls, defs.select("callee").union(ids).distinct())
    by_id, rest = split_known(known, ids)
    scoped = F.concat(F.col("callee"), F.lit("\x00"))
    own = defs.select(F.col("dst_file").alias("src_file"), "callee").distinct().withColumn("_own", F.lit(True))
    local = F.concat(scoped, F.col("src_file"))
    up = rest.join(own, ["src_file", "callee"], "left").select(
        "src", F.when(F.col("_own"), local).otherwise(scoped).alias("key"))
    up = up.unionByName(by_id.select("src", F.concat(F.lit("\x00"), F.col("callee")).alias("key")))
    down = (defs.select(F.explode(F.array(scoped, F.concat(scoped, F.col("dst_file")), F.concat(F.lit("\x00"), F.col("dst")))).alias("key"), "dst"))
    used = up.select("key").distinct()
    return up.distinct(), down.join(used, "key", "left_semi")


def class_id(key: str) -> Column:
    """A name node's key as text: ``name:f`` (any definition of f),
    ``file:path:f`` (those of that file) or ``id:...`` (one function)."""
    k = F.col(key)
    name, rest = F.substring_index(k, "\x00", 1), F.substring_index(k, "\x00", -1)
    return (F.when(name == "", F.concat(F.lit("id:"), rest)).when(rest == "", F.concat(F.lit("name:"), name))
             .otherwise(F.concat(F.lit("file:"), rest, F.lit(":"), name)))


def class_tier(class_id_col: str) -> Column:
    """The tier by which calls of a class were resolved."""
    kind = F.substring_index(class_id_col, ":", 1)
    return F.when(kind == "id", 1).when(kind == "file", 2).otherwise(3)


def met_twice(up: DataFrame, down: DataFrame) -> DataFrame:
    """(src, key, dst) of the calls by name whose caller calls that definition
    by its id as well."""
    by_id = up.where(F.col("key").startswith("\x00")).select("src", F.substring_index("key", "\x00", -1).alias("dst"))
    return by_id.join(down.where(~F.col("key").startswith("\x00")), "dst").join(up, ["src", "key"], "left_semi").select("src", "key", "dst")


def name_edges(up: DataFrame, down: DataFrame) -> DataFrame:
    """The resolved edges, each once: every (src, dst, key) of the name graph
    (and any further columns of ``up`` and ``down``). The pairs come from a join
    on the key and are not shuffled again; where a caller names a definition in
    two ways, that by its id counts."""
    skip = met_twice(up.select("src", "key"), down.select("key", "dst")).groupBy("src", "key").agg(F.collect_set("dst").alias("_skip"))
    pairs = up.join(skip, ["src", "key"], "left").join(down, "key")
    return pairs.where(F.col("_skip").isNull() | ~F.array_contains("_skip", F.col("dst"))).drop("_skip")


def name_degrees(nodes: DataFrame, up: DataFrame, down: DataFrame, external: DataFrame) -> DataFrame:
    """``degree_metrics`` from counts per name node: a definition's callers are
    those of its keys, a function's callees the definitions of its keys. (A
    function that calls another both by name and by id counts it twice.)"""
    n_up = up.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    n_down = down.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    indeg = down.join(n_up, "key").groupBy(F.col("dst").alias("id")).agg(F.sum("n").alias("in_degree"))
    outdeg = up.join(n_down, "key").groupBy(F.col("src").alias("id")).agg(F.sum("n").alias("n_callees"))
    ext = external.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n_external"))
    d = nodes.join(indeg, "id", "left").join(outdeg, "id", "left").join(ext, "id", "left")
    return d.select(*nodes.columns, F.coalesce("in_degree", F.lit(0)).cast("bigint").alias("in_degree"),
                    (F.coalesce("n_callees", F.lit(0)) + F.coalesce("n_external", F.lit(0))).cast("bigint").alias("out_degree"),
                    F.coalesce("n_external", F.lit(0)).cast("bigint").alias("n_external"))


def name_file_edges(units: DataFrame, up: DataFrame, down: DataFrame) -> DataFrame:
    """Distinct (src_file, dst_file) of the call graph: both sides are reduced
    to distinct (file, key) before they meet."""
    a, b = file_keys(units, up, down)
    return a.join(b, "key").select("src_file", "dst_file").distinct()


def file_keys(units: DataFrame, up: DataFrame, down: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct (src_file, key) of the files that call and (dst_file, key) of
    those that define."""
    f = units.select("id", "file_path")
    a = up.join(f.withColumnRenamed("id", "src"), "src").select(F.col("file_path").alias("src_file"), "key").distinct()
    b = down.join(f.withColumnRenamed("id", "dst"), "dst").select(F.col("file_path").alias("dst_file"), "key").distinct()
    return a, b


def as_edges(up: DataFrame, down: DataFrame) -> DataFrame:
    """Name nodes as nodes of a plain (src, dst) graph; their ids hold a NUL,
    which function ids don't."""
    return up.select("src", F.col("key").alias("dst")).unionByName(down.select(F.col("key").alias("src"), "dst"))


def is_function(c):
    return ~F.col(c).contains("\x00")


def reverse_edges(edges: DataFrame) -> DataFrame:
    """callers of each function = the inverse of callees, as pairs (for chosen
    functions; ``classes`` keeps the whole relation factored)."""
    return edges.select(F.col("dst").alias("id"), F.col("src").alias("caller")).distinct()


def degree_metrics(nodes: DataFrame, edges: DataFrame, external: DataFrame) -> DataFrame:
    """in = distinct callers; out = resolved callees + external names.

    ``edges`` (src, dst) and ``external`` (src, callee) must be distinct, as
    :func:`resolve_callees` returns them; plain counts then equal distinct
    counts without the extra shuffle of a two-level distinct aggregate."""
    indeg = edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))
    outdeg = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n_callees"))
    ext = external.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n_external"))
    d = nodes.join(indeg, "id", "left").join(outdeg, "id", "left").join(ext, "id", "left")
    return d.select(*nodes.columns,
                    F.coalesce("in_degree", F.lit(0)).cast("bigint").alias("in_degree"),
                    (F.coalesce("n_callees", F.lit(0)) + F.coalesce("n_external", F.lit(0))).cast("bigint").alias("out_degree"),
                    F.coalesce("n_external", F.lit(0)).cast("bigint").alias("n_external"))


def file_edges(units: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct file edges of resolved call edges (self-edges kept)."""
    f = units.select("id", "file_path")
    return (edges.join(f.withColumnRenamed("id", "src").withColumnRenamed("file_path", "src_file"), "src")
                 .join(f.withColumnRenamed("id", "dst").withColumnRenamed("file_path", "dst_file"), "dst")
                 .select("src_file", "dst_file").distinct())


def file_degrees(fe: DataFrame) -> DataFrame:
    """Nodes (the union of both edge ends) with their degrees."""
    outd = fe.groupBy(F.col("src_file").alias("file_path")).agg(F.count(F.lit(1)).alias("out_degree"))
    ind = fe.groupBy(F.col("dst_file").alias("file_path")).agg(F.count(F.lit(1)).alias("in_degree"))
    return file_node_set(fe).join(ind, "file_path", "left").join(outd, "file_path", "left").select(
        "file_path", F.coalesce("in_degree", F.lit(0)).cast("bigint").alias("in_degree"),
        F.coalesce("out_degree", F.lit(0)).cast("bigint").alias("out_degree"))


def file_node_set(file_edges: DataFrame) -> DataFrame:
    """Sources union targets, distinct."""
    return (file_edges.select(F.col("src_file").alias("file_path"))
            .union(file_edges.select(F.col("dst_file").alias("file_path"))).distinct())


def name_index(units: DataFrame) -> DataFrame:
    """Per function name: number of definitions and of files defining it."""
    return units.groupBy("name").agg(F.count(F.lit(1)).alias("n_defs"),
                                     F.countDistinct("file_path").alias("n_files"))


def _upwards(parts: Column, most: Column) -> Column:
    """The folders from the root (empty) down to ``most`` levels of a path."""
    return F.transform(F.sequence(F.lit(0), most), lambda n: F.struct(F.array_join(F.slice(parts, 1, n), "/").alias("folder"), n.alias("level")))


def include_graph(files: DataFrame, includes: DataFrame) -> DataFrame:
    """file -> included file. An include names a path suffix; of the files that
    end with it the one nearest to the including file counts: that below the
    deepest folder that both are in, then with the fewest folders between, then
    the first by path. One with ``..`` is a path from the file's own folder.

    Both sides go through (suffix, folder): a file offers itself to every folder
    above it, which keeps the nearest, and an include asks the folders above its
    file. So a name that many files have and include is no product of the two."""
    c = F.col
    parts = F.split("file_path", "/")
    f = files.select("file_path", parts.alias("ps"), F.size(parts).alias("n"))
    f = f.select("file_path", "ps", "n", F.explode(F.sequence(F.lit(1), "n")).alias("k"))  # the last k parts
    f = f.select("file_path", "n", "k", F.array_join(F.slice("ps", c("n") - c("k") + 1, c("k")), "/").alias("include"),
                 F.explode(_upwards(c("ps"), c("n") - c("k"))).alias("up"))
    nearest = f.groupBy("include", c("up.folder").alias("folder")).agg(
        F.min(F.struct((c("n") - c("k") - c("up.level")).alias("between"), "file_path"))["file_path"].alias("dst_file"))
    plain = F.array_join(F.filter(F.split("include", "/"), lambda x: ~x.isin("", ".")), "/")
    asked = includes.select(c("file_path").alias("src_file"), "include", plain.alias("plain"), F.split("file_path", "/").alias("ps")).distinct()
    climbs = F.array_contains(F.split("include", "/"), "..")
    ask = asked.where(~climbs).select("src_file", c("plain").alias("include"), F.explode(_upwards(c("ps"), F.size("ps") - 1)).alias("up"))
    found = (ask.select("src_file", "include", c("up.folder").alias("folder"), c("up.level").alias("level")).join(nearest, ["include", "folder"])
             .groupBy("src_file", "include").agg(F.max_by("dst_file", "level").alias("dst_file")))

    def step(path, x):
        return F.when(x.isin("", "."), path).when((x == "..") & (F.size(path) > 0), F.slice(path, 1, F.greatest(F.size(path) - 1, F.lit(0)))).otherwise(
            F.concat(path, F.array(x)))
    whole = F.aggregate(F.concat(F.slice("ps", F.lit(1), F.size("ps") - 1), F.split("include", "/")), F.array().cast("array<string>"), step)
    exact = asked.where(climbs).select("src_file", F.array_join(whole, "/").alias("dst_file")).join(
        files.select(c("file_path").alias("dst_file")), "dst_file", "left_semi")
    return found.select("src_file", "dst_file").unionByName(exact.select("src_file", "dst_file")).distinct()


def module_edges(file_edges: DataFrame) -> DataFrame:
    """Collapse files to modules (file name without its suffix)."""
    stem = lambda c: F.regexp_extract(M.file_name(c), r"^(.+?)(\.[^.]*)?$", 1)
    return file_edges.select(stem("src_file").alias("src"), stem("dst_file").alias("dst")).distinct()


# ---------------------------------------------------------------------------
# Iterative algorithms
# ---------------------------------------------------------------------------

def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` as a side that joins deal by key. The packed size of a round's
    table, which Spark goes by, says little about its rows: small files of many
    nodes would be broadcast, each through the driver's memory."""
    return rows.hint("merge")


def _nodes_of(edges: DataFrame, nodes: DataFrame | None) -> DataFrame:
    if nodes is not None:
        return nodes.select("id").distinct()
    return edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()


def _reach_min(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, f, b): the node of least priority that reaches ``id`` and the one
    that it reaches, itself included. ``nodes`` has id and prio.

    Forward and backward labels move in the same round, over edges and by
    pointer jumping (a label's own label), which doubles the distance covered.
    Runs to the fixpoint; a round's table goes with the next."""
    me = F.struct("prio", "id")
    state = cut_lineage(nodes.select("id", me.alias("f"), me.alias("b")))
    while True:
        fin = (edges.join(_dealt(state.select(F.col("id").alias("src"), "f")), "src")
                    .groupBy(F.col("dst").alias("id")).agg(F.min("f").alias("f1")))
        bin_ = (edges.join(_dealt(state.select(F.col("id").alias("dst"), "b")), "dst")
                     .groupBy(F.col("src").alias("id")).agg(F.min("b").alias("b1")))
        fj = state.select(F.col("id").alias("_fid"), F.col("f").alias("f2"))
        bj = state.select(F.col("id").alias("_bid"), F.col("b").alias("b2"))
        new = (state.join(_dealt(fj), F.col("f.id") == F.col("_fid"), "left").join(_dealt(bj), F.col("b.id") == F.col("_bid"), "left")
                    .join(_dealt(fin), "id", "left").join(_dealt(bin_), "id", "left")
                    .select("id", F.least("f", F.coalesce("f1", "f"), F.coalesce("f2", "f")).alias("nf"),
                            F.least("b", F.coalesce("b1", "b"), F.coalesce("b2", "b")).alias("nb"), "f", "b"))
        changed = Observation()  # counted by the write
        new = new.observe(changed, F.count_if((F.col("nf") < F.col("f")) | (F.col("nb") < F.col("b"))).alias("n"))
        new = cut_lineage(new.select("id", F.col("nf").alias("f"), F.col("nb").alias("b")))
        drop_state(new.sparkSession, state)
        state = new
        free_shuffles(new.sparkSession)
        if not changed.get["n"]:
            return state


def scc(edges: DataFrame, nodes: DataFrame | None = None, log=None) -> DataFrame:
    """Strongly connected components: (id, scc_id, size, in_cycle).

    Each round draws a new priority for every node left and finds the least
    that reaches it and the least that it reaches. Where the two are the same
    node, that is the component's. An edge whose ends differ in either joins two
    components and goes; nodes without an edge in or out are alone. So a chain
    falls apart in an expected number of rounds that follows the logarithm of
    its length. scc_id is the smallest member id; a self-loop alone is no cycle.
    Tables go as soon as the next are written, and the rounds' shuffles with them."""
    spark = edges.sparkSession
    active = cut_lineage(_nodes_of(edges, nodes))
    e = cut_lineage(edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct())
    done, turn = [], 0
    while True:
        # alone: without an edge in or out
        ends = e.select(F.col("src").alias("id")).distinct().join(_dealt(e.select(F.col("dst").alias("id"))), "id", "left_semi")
        rest = cut_lineage(active.join(_dealt(ends), "id", "left_semi"))
        done.append(cut_lineage(active.join(_dealt(rest), "id", "left_anti").select("id", F.col("id").alias("root"))))
        drop_state(spark, active)
        if rest.isEmpty():
            drop_state(spark, rest)
            drop_state(spark, e)
            break
        turn += 1
        if log:
            log("round", turn)
        inside = (e.join(_dealt(rest.withColumnRenamed("id", "src")), "src", "left_semi")
                   .join(_dealt(rest.withColumnRenamed("id", "dst")), "dst", "left_semi"))
        inside = cut_lineage(inside)
        drop_state(spark, e)
        label = _reach_min(rest.withColumn("prio", F.xxhash64("id", F.lit(turn))), inside)
        found = F.col("f.id") == F.col("b.id")
        done.append(cut_lineage(label.where(found).select("id", F.col("f.id").alias("root"))))
        left = label.where(~found)
        active = cut_lineage(left.select("id"))
        drop_state(spark, rest)
        if active.isEmpty():
            for d in (active, label, inside):
                drop_state(spark, d)
            break
        ls = left.select(F.col("id").alias("src"), F.col("f").alias("fs"), F.col("b").alias("bs"))
        ld = left.select(F.col("id").alias("dst"), F.col("f").alias("fd"), F.col("b").alias("bd"))
        e = cut_lineage(inside.join(_dealt(ls), "src").join(_dealt(ld), "dst").where("fs = fd and bs = bd").select("src", "dst"))
        drop_state(spark, label)
        drop_state(spark, inside)
        free_shuffles(spark)
    roots = done[0]
    for d in done[1:]:
        roots = roots.unionByName(d)
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("scc_id"))
    out = cut_lineage(roots.join(_dealt(sizes), "root").select("id", "scc_id", F.col("size").cast("bigint").alias("size"),
                                                       (F.col("size") > 1).alias("in_cycle")))
    for d in done:
        drop_state(spark, d)
    free_shuffles(spark)
    return out


def function_scc(up: DataFrame, down: DataFrame, units: DataFrame) -> DataFrame:
    """``scc`` of the functions, found over name nodes."""
    return _functions_of(scc(as_edges(up, down), units.select("id").union(up.select("key")).union(down.select("key"))))


def file_scc(units: DataFrame, up: DataFrame, down: DataFrame) -> DataFrame:
    """``scc`` of the files in the file call graph, found over name nodes: the
    paths file -> key -> file are its edges, in as many rows as files have names
    and not their products."""
    a, b = file_keys(units, up, down)
    return _functions_of(scc(as_edges(a.withColumnRenamed("src_file", "src"), b.withColumnRenamed("dst_file", "dst"))))


def _functions_of(c: DataFrame) -> DataFrame:
    """Components without the name nodes in them."""
    c = c.where(is_function("id"))
    sizes = c.groupBy("scc_id").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
    return c.select("id", "scc_id").join(_dealt(sizes), "scc_id").select(
        "id", F.col("least").alias("scc_id"), "size", (F.col("size") > 1).alias("in_cycle"))


def bfs_distance(edges: DataFrame, sources: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Multi-source BFS: (id, dist) = hops from the nearest source. Nodes
    never reached are absent (null after a left join). Each hop writes its
    frontier; edges into what was reached are dropped as they are met, so
    later hops read ever fewer and no hop reads the visited set again."""
    reached = sources.select("id").distinct()
    frontier = cut_lineage(reached.withColumn("dist", F.lit(0)))
    levels, e, hop = [frontier], edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct(), 0
    while max_hops is None or hop < max_hops:
        hop += 1
        older = e
        e = cut_lineage(e.join(frontier.select(F.col("id").alias("dst")), "dst", "left_anti"), "bfs-edges")
        drop_state(e.sparkSession, older)
        nxt = (e.join(frontier.select(F.col("id").alias("src")), "src", "left_semi")
                .select(F.col("dst").alias("id")).distinct().withColumn("dist", F.lit(hop)))
        frontier = cut_lineage(nxt)
        if frontier.isEmpty():
            break
        levels.append(frontier)
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def function_distance(up: DataFrame, down: DataFrame, units: DataFrame) -> DataFrame:
    """Hops from the nearest entry point (function without callers) over name
    nodes: two steps of the search are one call."""
    called = down.join(up.select("key").distinct(), "key", "left_semi").select(F.col("dst").alias("id")).distinct()
    entries = units.select("id").join(called, "id", "left_anti")
    d = bfs_distance(as_edges(up, down), entries).where(is_function("id"))
    return units.select("id").join(d, "id", "left").select("id", F.expr("cast(dist div 2 as bigint)").alias("to_entry_points"))


def k_hop_neighbors(edges: DataFrame, seeds: DataFrame, k: int = 2, undirected: bool = True) -> DataFrame:
    """(seed, id, dist) for nodes within ``k`` hops of each seed (seed
    excluded). Seeds are a bounded set (retrieval hits, top entry points);
    each hop joins the frontier with the edge list."""
    e = edges.select("src", "dst")
    if undirected:
        e = e.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    e = cut_lineage(e.distinct())
    visited = cut_lineage(seeds.select(F.col("id").alias("seed"), "id").distinct().withColumn("dist", F.lit(0)))
    frontier = visited
    for hop in range(1, k + 1):
        nxt = (e.join(frontier.select("seed", F.col("id").alias("src")), "src")
                .select("seed", F.col("dst").alias("id")).distinct()
                .join(visited.select("seed", "id"), ["seed", "id"], "left_anti")
                .withColumn("dist", F.lit(hop)))
        frontier = cut_lineage(nxt)
        visited = cut_lineage(visited.unionByName(frontier))
    return visited.where(F.col("dist") > 0)


def function_neighbors(up: DataFrame, down: DataFrame, seeds: DataFrame, k: int = 2) -> DataFrame:
    """``k_hop_neighbors`` (either direction) of the functions over name nodes.
    A hop goes up to a key and down from it, or the other way round."""
    there = cut_lineage(seeds.select(F.col("id").alias("seed"), "id").distinct().withColumn("dist", F.lit(0)))
    visited, frontier = there, there
    for hop in range(1, k + 1):
        calls = frontier.join(up, F.col("id") == F.col("src")).select("seed", "key").distinct().join(down, "key").select("seed", F.col("dst").alias("id"))
        called = frontier.join(down, F.col("id") == F.col("dst")).select("seed", "key").distinct().join(up, "key").select("seed", F.col("src").alias("id"))
        nxt = (calls.unionByName(called).distinct().join(visited.select("seed", "id"), ["seed", "id"], "left_anti")
               .withColumn("dist", F.lit(hop)))
        frontier = cut_lineage(nxt)
        visited = visited.unionByName(frontier)
    return visited.where(F.col("dist") > 0)


def degree_centrality(degrees: DataFrame) -> DataFrame:
    """(in+out)/(n-1), n from a scalar subquery over the node table."""
    n = degrees.select(F.count(F.lit(1))).scalar()
    return degrees.withColumn("degree_centrality",
                              (F.col("in_degree") + F.col("out_degree")).cast("double") / F.greatest(n - 1, F.lit(1)))


def top_entry_points(degrees: DataFrame, k: int = 10) -> DataFrame:
    """Entry points (no callers), top-k by out-degree, ties by id."""
    return (degrees.where(F.col("in_degree") == 0)
                   .orderBy(F.col("out_degree").desc(), F.col("id").asc()).limit(k))


def betweenness_sampled(edges: DataFrame, sources: DataFrame, targets: Column | None = None, log=None) -> DataFrame:
    """Brandes betweenness from a fixed set of sources (directed, unweighted):
    (id, betweenness) summed over sources.

    Forward, a table a level of (s, id, sigma): the nodes that the search from s
    reaches there and their numbers of shortest paths. Backward, a table a level
    of their dependencies delta, from the deepest up. Each is written once and
    reads the level next to it (forward also the ids reached before). Paths end
    at nodes that ``targets`` (on ``id``) accepts, and only those are returned.
    ``log`` gets the level and its rows."""
    spark = edges.sparkSession
    e = cut_lineage(edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct(), "paths-edges")
    levels = [cut_lineage(sources.select(F.col("id").alias("s"), "id").distinct().withColumn("sigma", F.lit(1.0)), "paths-level")]
    older, merged = [], []
    while True:
        older.append(levels[-1].select("s", "id"))
        reached = older[0]
        for lv in older[1:]:
            reached = reached.unionByName(lv)
        if len(older) > 8:  # few tables to look in, however deep the search
            reached = cut_lineage(reached, "paths-reached")
            merged.append(reached)
            older = [reached]
        nxt = (e.join(levels[-1].withColumnRenamed("id", "src"), "src")
                .groupBy("s", F.col("dst").alias("id")).agg(F.sum("sigma").alias("sigma"))
                .join(reached, ["s", "id"], "left_anti"))
        nxt = cut_lineage(nxt, "paths-level")
        rows = nxt.count()
        if log:
            log(len(levels), rows)
        if not rows:
            drop_state(spark, nxt)
            break
        levels.append(nxt)
    ends = F.lit(1.0) if targets is None else F.when(targets, 1.0).otherwise(0.0)
    # delta(v) = sum over successors w one level down of sigma(v) / sigma(w) * (ends(w) + delta(w))
    below = levels[-1].withColumn("delta", F.lit(0.0))
    deltas = [below]
    for lv in reversed(levels[:-1]):
        w = below.select("s", F.col("id").alias("dst"), ((ends + F.col("delta")) / F.col("sigma")).alias("share"))
        back = (e.join(w, "dst").groupBy("s", F.col("src").alias("id")).agg(F.sum("share").alias("share"))
                 .join(lv, ["s", "id"]).select("s", "id", (F.col("sigma") * F.col("share")).alias("delta")))
        below = cut_lineage(lv.join(back, ["s", "id"], "left").select("s", "id", "sigma", F.coalesce("delta", F.lit(0.0)).alias("delta")), "paths-delta")
        deltas.append(below)
    out = None
    for d in deltas:
        out = d if out is None else out.unionByName(d)
    out = out.where(F.col("id") != F.col("s"))
    out = out if targets is None else out.where(targets)
    total = cut_lineage(out.groupBy("id").agg(F.sum("delta").alias("betweenness")), "betweenness")
    for state in (e, *levels, *merged, *deltas[1:]):
        drop_state(spark, state)
    return total


def function_betweenness(up: DataFrame, down: DataFrame, sources: DataFrame, log=None) -> DataFrame:
    """Betweenness of functions with paths and dependencies factored through
    name nodes: a call is two steps, and a source reaches a name node once, so
    a level holds no more than the calls and definitions next to it. (A function
    that calls another both by name and by id has two paths to it.)"""
    return betweenness_sampled(as_edges(up, down), sources, is_function("id"), log)


def graph_distance(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Hops from the nearest entry point (function without callers);
    null when unreachable from every entry point."""
    callers = edges.where(F.col("src") != F.col("dst")).select(F.col("dst").alias("id")).distinct()
    entries = nodes.select("id").join(callers, "id", "left_anti")
    d = bfs_distance(edges.where(F.col("src") != F.col("dst")), entries)
    return nodes.select("id").join(d, "id", "left").select("id", F.col("dist").cast("bigint").alias("to_entry_points"))

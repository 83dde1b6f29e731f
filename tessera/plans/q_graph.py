"""Registered graph queries: edges, tiers, degrees, file graph, SCC, BFS."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as M
from ..operators import classes as C
from ..operators import graph as G
from ..operators import segment as S
from . import pipeline as P
from .registry import register
from .sql_code import CODE_CTES, FILES_CTES, list_parts_sql, q

CALL_RE = q(M.CALL_SITE_RE)

GRAPH_CTES = f"""
calls_raw AS (SELECT DISTINCT id AS src, file_path AS src_file, callee
              FROM (SELECT id, file_path, name, unnest(regexp_extract_all(body, {CALL_RE}, 1)) AS callee FROM units2)
              WHERE callee <> name),
t1 AS (SELECT src, callee AS dst, 1 AS tier FROM calls_raw WHERE callee IN (SELECT id FROM units2)),
r1 AS (SELECT * FROM calls_raw WHERE callee NOT IN (SELECT id FROM units2)),
t2 AS (SELECT r.src, u.id AS dst, 2 AS tier FROM r1 r JOIN units2 u ON u.file_path = r.src_file AND u.name = r.callee),
r2 AS (SELECT * FROM r1 r WHERE NOT EXISTS (SELECT 1 FROM units2 u WHERE u.file_path = r.src_file AND u.name = r.callee)),
t3 AS (SELECT r.src, u.id AS dst, 3 AS tier FROM r2 r JOIN units2 u ON u.name = r.callee),
ext AS (SELECT DISTINCT src, callee FROM r2 r WHERE NOT EXISTS (SELECT 1 FROM units2 u WHERE u.name = r.callee)),
edges AS (SELECT src, dst, CAST(min(tier) AS BIGINT) AS tier
          FROM (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3) GROUP BY src, dst),
deg AS (SELECT u.id, u.file_path,
               CAST(coalesce((SELECT count(DISTINCT e.src) FROM edges e WHERE e.dst = u.id), 0) AS BIGINT) AS in_degree,
               CAST(coalesce((SELECT count(DISTINCT e.dst) FROM edges e WHERE e.src = u.id), 0)
                  + coalesce((SELECT count(DISTINCT x.callee) FROM ext x WHERE x.src = u.id), 0) AS BIGINT) AS out_degree,
               CAST(coalesce((SELECT count(DISTINCT x.callee) FROM ext x WHERE x.src = u.id), 0) AS BIGINT) AS n_external
        FROM units2 u)
"""
WG = "WITH " + CODE_CTES + "," + GRAPH_CTES
WGF = WG + "," + FILES_CTES

INCLUDE_CTES = r"""
inc AS (SELECT file_path, unnest(regexp_extract_all(text, '(?m)^\s*#\s*include\s*[<"]([^>"]+)[>"]', 1)) AS include FROM files),
incp AS (SELECT i.file_path AS src_file, i.include, f.file_path AS dst_file,
                string_split(i.file_path, '/')[1:-2] AS home, string_split(f.file_path, '/')[1:-1 - len(string_split(i.include, '/'))] AS base
         FROM inc i JOIN files f ON f.file_path = i.include OR ends_with(f.file_path, '/' || i.include)),
incc AS (SELECT *, coalesce(list_max(list_filter(range(1, least(len(home), len(base)) + 1), lambda n: home[1:n] = base[1:n])), 0) AS shared FROM incp),
incg AS (SELECT DISTINCT src_file, dst_file FROM (
           SELECT src_file, dst_file, row_number() OVER (PARTITION BY src_file, include ORDER BY shared DESC, len(base), dst_file) AS rk FROM incc) WHERE rk = 1),
medges AS (SELECT DISTINCT regexp_extract(regexp_extract(src_file, '([^/]*)$', 1), '^(.+?)(\.[^.]*)?$', 1) AS src,
                           regexp_extract(regexp_extract(dst_file, '([^/]*)$', 1), '^(.+?)(\.[^.]*)?$', 1) AS dst
           FROM incg),
mnodes AS (SELECT src AS id FROM medges UNION SELECT dst FROM medges)
"""


def _module_scc(spark, sf):
    return P.materialize(spark, sf, "module_scc", lambda: G.scc(_module_edges(spark, sf)))


@register("call_edges_in_file", WG + """
, lastdef AS (SELECT file_path, name, arg_max(id, start_line) AS dst FROM units2 GROUP BY file_path, name)
SELECT DISTINCT c.src, l.dst, c.src_file, c.callee FROM calls_raw c JOIN lastdef l ON l.file_path = c.src_file AND l.name = c.callee
""")
def q_call_edges_in_file(spark, sf):
    return G.call_edges_in_file(P.c_units(spark, sf))


# the call graph through classes: a call belongs to the class of the callee's
# name in the caller's file if it is defined there, else of the name anywhere
CLASS_CTES = f"""
upc AS (SELECT DISTINCT src, CASE WHEN callee IN (SELECT id FROM units2) THEN 'id:' || callee
                 WHEN EXISTS (SELECT 1 FROM units2 u WHERE u.file_path = src_file AND u.name = callee) THEN 'file:' || src_file || ':' || callee
                 ELSE 'name:' || callee END AS class FROM calls_raw),
downc AS (SELECT 'name:' || name AS class, id FROM units2 UNION ALL SELECT 'file:' || file_path || ':' || name, id FROM units2
          UNION ALL SELECT 'id:' || id, id FROM units2),
cm AS (SELECT class, 'caller' AS side, src AS item FROM upc UNION ALL SELECT class, 'definition', id FROM downc),
cn AS (SELECT class, count(*) FILTER (WHERE side = 'caller') AS n_callers, count(*) FILTER (WHERE side = 'definition') AS n_definitions
       FROM cm GROUP BY class),
cc AS (SELECT class, side, part, parts, n_callers, n_definitions, string_agg(item, ',' ORDER BY item) AS members
       FROM (SELECT cm.class, side, item, n_callers, n_definitions, parts,
                    CAST(('0x' || substring(sha1(item), 1, 7)) AS BIGINT) % parts AS part
             FROM (SELECT cm.*, n_callers, n_definitions,
                          CAST(ceil(CASE side WHEN 'caller' THEN n_callers ELSE n_definitions END / {P.LIST_ITEMS}.0) AS BIGINT) AS parts
                   FROM cm JOIN cn ON cn.class = cm.class WHERE n_callers > 0 AND n_definitions > 0) cm)
       GROUP BY class, side, part, parts, n_callers, n_definitions)
"""


@register("resolve_callees", WG + "SELECT src, dst, tier FROM edges")
def q_resolve_callees(spark, sf):
    """Every resolved call with every definition that it may mean."""
    return P.call_pairs(spark, sf)


@register("resolved_links", WG + """
SELECT 'caller' AS side, src AS id, count(*) AS n_links FROM edges GROUP BY src
UNION ALL SELECT 'definition', dst, count(*) FROM edges GROUP BY dst
""")
def q_resolved_links(spark, sf):
    """Links of every caller and definition, summed from class counts (the SQL
    twin counts the expanded pairs)."""
    up, down = P.call_sides(spark, sf)
    n = C.class_counts(up, down)
    return (C.link_counts(up, n, ["item"], "n_right").select(F.lit("caller").alias("side"), F.col("item").alias("id"), "n_links")
            .unionByName(C.link_counts(down, n, ["item"], "n_left").select(F.lit("definition").alias("side"), F.col("item").alias("id"), "n_links")))


@register("external_calls", WG + "SELECT src, callee FROM ext")
def q_external_calls(spark, sf):
    return P.external(spark, sf)


# every caller and callee of a function, in parts
NEIGHBOR_LISTS_SQL = (list_parts_sql("cr", "edges", "dst", "src", ",", "callers") + "," + list_parts_sql("ce", "edges", "src", "dst", ",", "callees") + """,
nb AS (SELECT coalesce(cr.id, ce.id) AS id, coalesce(cr.part, ce.part) AS part, cr.callers, ce.callees
       FROM cr FULL JOIN ce ON ce.id = cr.id AND ce.part = cr.part)
""")
# lists of a class: its only part's text, or null if it has several
CALLERS_CTES = f"""
lists AS (SELECT class, side, n_callers, n_definitions, max(parts) AS parts, max(members) AS members FROM cc GROUP BY class, side, n_callers, n_definitions),
fcallers AS (SELECT d.id, string_agg(CASE WHEN l.parts = 1 THEN l.members ELSE 'callers of ' || l.class END, ',' ORDER BY l.class) AS callers,
                    CAST(sum(l.n_callers) AS BIGINT) AS n
             FROM downc d JOIN lists l ON l.class = d.class AND l.side = 'caller' GROUP BY d.id),
ced AS (SELECT u.src AS id, CASE WHEN l.n_definitions = 1 THEN l.members ELSE l.class END AS item
        FROM upc u JOIN lists l ON l.class = u.class AND l.side = 'definition'),
{list_parts_sql("ce", "ced", "id", "item", ",", "callees", P.LIST_ITEMS)},
nb AS (SELECT coalesce(f.id, ce.id) AS id, coalesce(ce.part, 0) AS part, f.callers, ce.callees
       FROM fcallers f FULL JOIN ce ON ce.id = f.id AND ce.part = 0
       UNION ALL SELECT id, part, NULL, callees FROM ce WHERE part > 0),
nbc AS (SELECT class, part, n_callers, n_definitions, max(CASE WHEN side = 'caller' THEN members END) AS callers,
               max(CASE WHEN side = 'definition' THEN members END) AS definitions
        FROM cc WHERE (side = 'caller' AND parts > 1) OR (side = 'definition' AND n_definitions > 1)
        GROUP BY class, part, n_callers, n_definitions)
"""


@register("reverse_edges", WG + "SELECT DISTINCT dst AS id, src AS caller FROM edges")
def q_reverse_edges(spark, sf):
    """Every caller of every function."""
    return P.call_pairs(spark, sf).select(F.col("dst").alias("id"), F.col("src").alias("caller"))


@register("degree_metrics", WG + "SELECT id, in_degree, out_degree, n_external FROM deg")
def q_degree_metrics(spark, sf):
    return P.degrees(spark, sf).select("id", "in_degree", "out_degree", "n_external")


@register("enrich_join_graph", WG + """
SELECT u.id, u.file_path, d.in_degree, d.out_degree,
       CAST(u.start_line AS BIGINT) AS start_line FROM units2 u LEFT JOIN deg d ON d.id = u.id
""")
def q_enrich_join_graph(spark, sf):
    u = P.c_units(spark, sf)
    d = P.degrees(spark, sf)
    return u.select("id", "file_path", F.col("start_line").cast("bigint").alias("start_line")).join(
        d.select("id", "in_degree", "out_degree"), "id", "left")


_FILE_EDGES = """
fedges AS (SELECT DISTINCT a.file_path AS src_file, b.file_path AS dst_file
           FROM edges e JOIN units2 a ON a.id = e.src JOIN units2 b ON b.id = e.dst)
"""


@register("file_call_graph", WG + "," + _FILE_EDGES + """
, fnodes AS (SELECT src_file AS file_path FROM fedges UNION SELECT dst_file FROM fedges)
SELECT file_path,
       CAST((SELECT count(*) FROM fedges WHERE dst_file = fnodes.file_path) AS BIGINT) AS in_degree,
       CAST((SELECT count(*) FROM fedges WHERE src_file = fnodes.file_path) AS BIGINT) AS out_degree
FROM fnodes
""")
def q_file_call_graph(spark, sf):
    return G.file_degrees(P.file_edges(spark, sf))


@register("file_node_set", WG + "," + _FILE_EDGES + """
SELECT src_file AS file_path FROM fedges UNION SELECT dst_file FROM fedges
""")
def q_file_node_set(spark, sf):
    return G.file_node_set(P.file_edges(spark, sf))


@register("name_index", "WITH " + CODE_CTES + """
SELECT name, count(*) AS n_defs, count(DISTINCT file_path) AS n_files FROM units2 GROUP BY name
""")
def q_name_index(spark, sf):
    return G.name_index(P.c_units(spark, sf))


@register("call_counts", "WITH " + CODE_CTES + f"""
SELECT id AS src, callee, count(*) AS n_calls
FROM (SELECT id, unnest(regexp_extract_all(body, {CALL_RE}, 1)) AS callee FROM units2) GROUP BY id, callee
""")
def q_call_counts(spark, sf):
    return G.call_counts(P.c_units(spark, sf))


def _module_edges(spark, sf):
    files = P.code_files(spark, sf)
    inc = S.extract_includes(files)
    return G.module_edges(G.include_graph(files, inc))


@register("include_graph", "WITH " + CODE_CTES + "," + FILES_CTES + "," + INCLUDE_CTES + """
SELECT src_file, dst_file FROM incg
""")
def q_include_graph(spark, sf):
    files = P.code_files(spark, sf)
    return G.include_graph(files, S.extract_includes(files))


_SCC_SQL = "WITH RECURSIVE " + CODE_CTES + "," + FILES_CTES + "," + INCLUDE_CTES + """
, reach(a, b) AS (SELECT src, dst FROM medges UNION SELECT r.a, e.dst FROM reach r JOIN medges e ON e.src = r.b),
comp AS (SELECT n.id, coalesce((SELECT min(r.b) FROM reach r WHERE r.a = n.id AND r.b <> n.id
                 AND EXISTS (SELECT 1 FROM reach r2 WHERE r2.a = r.b AND r2.b = n.id)), n.id) AS c0 FROM mnodes n),
comp2 AS (SELECT id, least(id, c0) AS scc_id FROM comp),
sizes AS (SELECT scc_id, count(*) AS size FROM comp2 GROUP BY scc_id)
"""


@register("scc", _SCC_SQL + """
SELECT c.id, c.scc_id, s.size, s.size > 1 AS in_cycle FROM comp2 c JOIN sizes s USING (scc_id)
""")
def q_scc(spark, sf):
    return _module_scc(spark, sf)


@register("scc_sizes", _SCC_SQL + "SELECT scc_id, size, size > 1 AS in_cycle FROM sizes")
def q_scc_sizes(spark, sf):
    from ..operators.rollup import scc_sizes
    return scc_sizes(_module_scc(spark, sf)).select("scc_id", F.col("size").cast("bigint").alias("size"), "in_cycle")


@register("scc_functions")
def q_scc_functions(spark, sf):
    """Function-level SCC over the call graph (rows-only check)."""
    return P.function_scc(spark, sf)


_FILE_SCC_SQL = "WITH RECURSIVE " + CODE_CTES + "," + GRAPH_CTES + "," + _FILE_EDGES + """
, fnodes AS (SELECT src_file AS id FROM fedges UNION SELECT dst_file FROM fedges),
reach(a, b) AS (SELECT src_file, dst_file FROM fedges UNION SELECT r.a, e.dst_file FROM reach r JOIN fedges e ON e.src_file = r.b),
mutual AS (SELECT r.a, r.b FROM reach r JOIN reach q ON q.a = r.b AND q.b = r.a),
comp AS (SELECT n.id, coalesce(least(n.id, min(m.b)), n.id) AS scc_id FROM fnodes n LEFT JOIN mutual m ON m.a = n.id GROUP BY n.id),
sizes AS (SELECT scc_id, count(*) AS size FROM comp GROUP BY scc_id)
"""


@register("file_nodes", _FILE_SCC_SQL + """
SELECT c.id AS file_path, CAST((SELECT count(*) FROM fedges WHERE dst_file = c.id) AS BIGINT) AS in_degree,
       CAST((SELECT count(*) FROM fedges WHERE src_file = c.id) AS BIGINT) AS out_degree, c.scc_id, s.size, s.size > 1 AS in_cycle
FROM comp c JOIN sizes s USING (scc_id)
""")
def q_file_nodes(spark, sf):
    """File node records: degrees and component in the file call graph."""
    fe = P.file_edges(spark, sf)
    c = G.file_scc(*P.name_graph(spark, sf))
    return G.file_degrees(fe).join(c.withColumnRenamed("id", "file_path"), "file_path")


@register("func_nodes")
def q_func_nodes(spark, sf):
    """Function node records: degrees, numbers of callers, callees and external
    names, and the component (rows-only: closure in SQL is out of reach; parts
    are checked by degree_metrics, external_calls and pytest)."""
    d = P.degrees(spark, sf)
    return d.join(P.function_scc(spark, sf).hint("merge"), "id").select(
        "id", "file_path", "in_degree", "out_degree", F.col("in_degree").alias("n_callers"),
        (F.col("out_degree") - F.col("n_external")).alias("n_callees"), "n_external", "scc_id", "size", "in_cycle")


@register("graph_distance", "WITH RECURSIVE " + CODE_CTES + "," + GRAPH_CTES + """
, e2 AS (SELECT src, dst FROM edges WHERE src <> dst),
entries AS (SELECT id FROM units2 WHERE id NOT IN (SELECT dst FROM e2)),
bfs(node, dist) USING KEY (node) AS (
  SELECT id, 0 FROM entries
  UNION
  SELECT e.dst, min(b.dist + 1) FROM bfs b JOIN e2 e ON e.src = b.node
  WHERE e.dst NOT IN (SELECT node FROM recurring.bfs) GROUP BY e.dst)
SELECT u.id, CAST(b.dist AS BIGINT) AS to_entry_points FROM units2 u LEFT JOIN bfs b ON b.node = u.id
""")
def q_graph_distance(spark, sf):
    u, up, down = P.name_graph(spark, sf)
    return G.function_distance(up, down, u)


_TOP_SQL = """
top AS (SELECT id, out_degree FROM deg WHERE in_degree = 0 ORDER BY out_degree DESC, id LIMIT 10)
"""


@register("top_entry_points", WG + "," + _TOP_SQL + "SELECT id, out_degree FROM top")
def q_top_entry_points(spark, sf):
    d = P.degrees(spark, sf)
    return G.top_entry_points(d, 10).select("id", "out_degree")


@register("callees_of_entry_points", WG + "," + _TOP_SQL + """
SELECT e.src, e.dst, e.tier FROM edges e JOIN top t ON t.id = e.src
""")
def q_callees_of_entry_points(spark, sf):
    """Pairs of a chosen set: the resolved callees of the top entry points."""
    up, down = P.call_sides(spark, sf)
    top = G.top_entry_points(P.degrees(spark, sf), 10).select(F.col("id").alias("item"))
    pairs = C.pairs_of(up.join(top, "item", "left_semi").withColumnRenamed("item", "src"), down.withColumnRenamed("item", "dst"))
    return pairs.groupBy("src", "dst").agg(F.min(G.class_tier("key")).cast("bigint").alias("tier"))


@register("k_hop_neighbors", WG + "," + _TOP_SQL + """
, ue AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
h1 AS (SELECT DISTINCT t.id AS seed, e.dst AS id FROM top t JOIN ue e ON e.src = t.id WHERE e.dst <> t.id),
h2 AS (SELECT DISTINCT h.seed, e.dst AS id FROM h1 h JOIN ue e ON e.src = h.id
       WHERE e.dst <> h.seed AND NOT EXISTS (SELECT 1 FROM h1 x WHERE x.seed = h.seed AND x.id = e.dst))
SELECT seed, id, CAST(1 AS BIGINT) AS dist FROM h1 UNION ALL SELECT seed, id, CAST(2 AS BIGINT) FROM h2
""")
def q_k_hop(spark, sf):
    _, up, down = P.name_graph(spark, sf)
    seeds = G.top_entry_points(P.degrees(spark, sf), 10).select("id")
    return G.function_neighbors(up, down, seeds, 2).select("seed", "id", F.col("dist").cast("bigint").alias("dist"))


@register("degree_centrality", WG + """
SELECT id, round(CAST(in_degree + out_degree AS DOUBLE) / greatest((SELECT count(*) FROM deg) - 1, 1), 9) AS degree_centrality
FROM deg
""")
def q_degree_centrality(spark, sf):
    d = P.degrees(spark, sf)
    return G.degree_centrality(d).select("id", F.round("degree_centrality", 9).alias("degree_centrality"))


#: Levels that the SQL twin unrolls.
_LEVELS = 48
_BETWEEN_SQL = "WITH RECURSIVE " + CODE_CTES + "," + GRAPH_CTES + """
, e2 AS (SELECT src, dst FROM edges WHERE src <> dst),
srcs AS (SELECT id FROM units2 ORDER BY sha1(id), id LIMIT 8),
bfs(s, id, d, sigma) USING KEY (s, id) AS (
  SELECT id, id, 0, CAST(1 AS DOUBLE) FROM srcs
  UNION
  SELECT b.s, e.dst, b.d + 1, sum(b.sigma) FROM bfs b JOIN e2 e ON e.src = b.id
  WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.s = b.s AND r.id = e.dst) GROUP BY b.s, e.dst, b.d),
""" + f"d{_LEVELS} AS (SELECT s, id, sigma, CAST(0 AS DOUBLE) AS delta FROM bfs WHERE d = {_LEVELS})," + ",".join(f"""
d{n} AS (SELECT v.s, v.id, v.sigma, coalesce(sum(v.sigma / w.sigma * (1 + w.delta)), 0) AS delta
         FROM (SELECT * FROM bfs WHERE d = {n}) v LEFT JOIN e2 e ON e.src = v.id LEFT JOIN d{n + 1} w ON w.s = v.s AND w.id = e.dst
         GROUP BY v.s, v.id, v.sigma)""" for n in range(_LEVELS - 1, -1, -1)) + """
SELECT id, round(sum(delta), 6) AS betweenness FROM (
""" + " UNION ALL ".join(f"SELECT s, id, delta FROM d{n}" for n in range(_LEVELS + 1)) + ") WHERE id <> s GROUP BY id"


@register("betweenness_sampled", _BETWEEN_SQL)
def q_betweenness(spark, sf):
    """Brandes from the 8 sources with the smallest id hash."""
    u, up, down = P.name_graph(spark, sf)
    src = u.select("id").orderBy(F.sha1(F.col("id")), "id").limit(8)
    return G.function_betweenness(up, down, src).select("id", F.round("betweenness", 6).alias("betweenness"))

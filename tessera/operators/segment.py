"""Segmentation: source text -> unit rows, file by file.

A file is one input row and its units come from that row, those of C by a scan
of its text (:mod:`..functions.ccode`) and the others by array functions over its
lines, in time and memory that follow its length: nothing is shuffled or sorted,
and a task holds a bounded batch of files. One file is one input string, so it is
bounded by Spark's 2 GB value size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import ccode, metrics as M
from ..functions import tokenizer as K

# The assembly label / directive patterns (the reference's
# definitions of a unit; that of the C function header is in ccode).
ASM_LABEL_RE = r"^([A-Za-z_\.][\w\.\$@]*)\s*:\s*(?:\b.*)?$"
ASM_DIRECTIVE_RE = r"(?i)\.(globl|global|extern)\b"
ASM_PUBLIC_RE = r"(?i)^\s*PUBLIC\b"
ASM_INSTR_RE = r"^\s*[A-Za-z]+\s"
# Header matches whose "name" is a control keyword are not functions.
C_KEYWORDS = ["if", "else", "for", "while", "switch", "return", "do", "sizeof"]

UNIT_COLUMNS = ["file_path", "name", "signature", "body", "start_line", "end_line", "language", "kind"]


def _strip(c: Column) -> Column:
    """Python ``str.strip()`` (all whitespace, not only spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def split_lines(files: DataFrame, path: str = "file_path", text: str = "text",
                partitioned: bool = False) -> DataFrame:
    """(file_path, line_no 1-based, line, has_nl, n_lines) per line.

    A trailing newline does not start an extra line (``splitlines``)."""
    if not partitioned:
        files = files.repartition(path)
    t = F.col(text)
    parts = F.split(t, "\n")
    # computed once per file, before the explode: expressions next to a
    # generator are evaluated per generated row (quadratic per file)
    pre = files.select(F.col(path).alias("file_path"), parts.alias("_parts"),
                       (F.size(parts) - F.when(t.endswith("\n"), 1).otherwise(0)).alias("n_lines"),
                       t.endswith("\n").alias("ends_nl"))
    return (pre.select("file_path", "n_lines", "ends_nl", F.posexplode("_parts").alias("pos", "line"))
               .where(F.col("pos") < F.col("n_lines"))
               .select("file_path", (F.col("pos") + 1).alias("line_no"), "line",
                       ((F.col("pos") + 1 < F.col("n_lines")) | F.col("ends_nl")).alias("has_nl"),
                       "n_lines"))


def _count_char(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


# Tokens of C that hide what is inside them: a directive (up to a comment),
# comments, strings and character constants, each up to its end, the line's or
# the text's. Plain code runs on over the lines up to what may hide something, so
# a file has few tokens. Possessive loops run in constant stack on texts of any
# length.
_ESCAPED = r"\\(?:\r\n|[\s\S])"
_STRING = rf'"(?:[^"\\\n]|{_ESCAPED})*+"?'
_CHAR = rf"'(?:[^'\\\n]|{_ESCAPED})*+'?"
C_TOKEN_RE = "|".join([
    rf"(?dm:^)[^\S\n]*#(?:[^\\\n/\"']|{_ESCAPED}|/(?!\*)|{_STRING}|{_CHAR})*+",
    r"/\*(?s:.*?)(?:\*/|\z)", rf"//(?:[^\\\n]|{_ESCAPED})*+", _STRING, _CHAR,
    r"(?:[^/\"'\n#]++|\n(?![^\S\n]*+#)|/(?![/*]))++", r"[/\n#]"])
# what opens a linkage or namespace block, whose members stand at depth 0 (the
# words come first: they are looked for at every place of a text)
BLOCK_RE = r'(extern(?<=\bextern)\s+"\s*"\s*|namespace(?<=\bnamespace)\b[\w\s:]*)\{'


def code_view(text: Column) -> Column:
    """``text`` with everything blanked that isn't code: comments, the inside of
    strings and character constants, and directives (their ``#`` stays). Lengths
    and lines are the same, so a place in the one is the place in the other.

    The brace that opens a linkage or namespace block becomes a ``;``: it ends a
    statement, adds no depth, and its closing brace is a stray one."""
    def shown(t):
        hidden = t.startswith("'") | t.startswith("/*") | t.startswith("//")
        return (F.when(t.startswith('"'), F.regexp_replace(t, r'[^\n"]', " ")).when(hidden, F.regexp_replace(t, r"[^\n]", " "))
                 .when(t.contains("#"), F.regexp_replace(t, r"[^\n#]", " ")).otherwise(t))  # a directive, or a # alone
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(C_TOKEN_RE), 0)
    opened = lambda v: F.when(v.contains("extern") | v.contains("namespace"), F.regexp_replace(v, BLOCK_RE, "$1;")).otherwise(v)
    return F.transform(F.array(F.array_join(F.transform(tokens, shown), "")), opened)[0]


def _plain_lines(text: Column) -> Column:
    """A text's lines as an array; a trailing newline does not start another."""
    parts = F.split(text, "\n")
    return F.slice(parts, F.lit(1), F.size(parts) - F.when(text.endswith("\n"), 1).otherwise(0))


def _label_lines(lines: Column) -> Column:
    """Numbers of the lines that hold a label."""
    return F.array_compact(F.transform(lines, lambda c, i: F.when(c.rlike(ASM_LABEL_RE), i + 1)))


#: Ends of statements that are added up before they join the file's list.
_RUN = 256
# a run of lines without a brace; lines from an opening brace to its closing one
# with no others between but pairs on a line; or a line
BLOCK_LINES_RE = (r"(?:[^{}\n]*+\n)++|[^{}\n]*+(?:\{(?:[^{}]++|\{[^{}\n]*+\})*+\}[^{}\n]*+)++\n|[^\n]*+\n")


def _code_lines(text: Column) -> tuple[Column, Column]:
    """The lines of a text, as an array, and its :func:`code_view`."""
    t = F.coalesce(text, F.lit(""))
    t = F.when(t.endswith("\n"), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t)
    return F.split(t, "\n"), code_view(t)


def _scan(code: Column) -> Column:
    """One pass over a file's code: ``ends`` (line and depth of the last line of
    each depth-0 statement), the greatest depth after a line and the lines at
    depth 0.

    A statement ends with a line after which the brace depth is 0 and whose code
    ends with ``;`` or holds ``}`` or is a directive, so a header of any number
    of lines stands with its body. Depth counts braces of code alone and never
    falls below 0 (a stray ``}`` changes nothing for what follows). Lines without
    braces are passed over in runs, which are looked into at depth 0 alone. So are
    lines whose braces close: those but the last are one level deeper. Ends are
    kept in runs too, so adding some copies a short array however many a file
    has."""
    ends_type = "array<struct<line:int,depth:int>>"
    none = F.array().cast(ends_type)
    end = lambda line, depth: F.struct(line.cast("int").alias("line"), depth.cast("int").alias("depth"))
    start = F.struct(*[F.lit(0).alias(c) for c in ("line", "sum", "low", "most", "flat")], none.alias("run"),
                     F.array().cast(f"array<{ends_type}>").alias("runs"))

    def closes(c):
        return c.contains("}") | (c.contains(";") & c.rlike(r";\s*$")) | (c.contains("#") & c.rlike(r"^\s*#"))

    def step(a, c):
        braces = c.contains("{") | c.contains("}")
        total = a["sum"] + F.when(braces, F.length(F.replace(c, F.lit("}"), F.lit(""))) - F.length(F.replace(c, F.lit("{"), F.lit("")))).otherwise(0)
        n = _count_char(c, "\n")

        def moved(x):
            low = F.least(a["low"], x["sum"])
            depth = x["sum"] - low
            inside = F.array_compact(F.transform(F.split(c, "\n"), lambda one, i: F.when(closes(one), end(a["line"] + i + 1, F.lit(0)))))
            own = F.when(closes(c), F.array(end(a["line"] + x["n"], F.lit(0)))).otherwise(none)
            deepest = depth + F.when(x["braces"] & (x["n"] > 1), 1).otherwise(0)
            flat = F.when(depth != 0, 0).when(x["braces"], 1).otherwise(x["n"])  # closed lines: the last

            def added(e):
                full = F.size(a["run"]) >= _RUN
                return F.struct(
                    (a["line"] + x["n"]).alias("line"), x["sum"].alias("sum"), low.alias("low"), F.greatest(a["most"], deepest).alias("most"),
                    (a["flat"] + flat).alias("flat"),
                    F.when(full, e).when(F.size(e) > 0, F.concat(a["run"], e)).otherwise(a["run"]).alias("run"),
                    F.when(full, F.array_append(a["runs"], a["run"])).otherwise(a["runs"]).alias("runs"))
            return F.transform(F.array(F.when(depth != 0, none).when(x["braces"], own).otherwise(inside)), added)[0]
        return F.transform(F.array(F.struct(total.alias("sum"), n.alias("n"), braces.alias("braces"))), moved)[0]

    def result(a):  # lines after the last end are a statement of their own
        def with_rest(ends):
            last = F.when(F.size(ends) == 0, 0).otherwise(F.element_at(ends, -1)["line"])
            rest = F.when(last < a["line"], F.array(end(a["line"], a["sum"] - a["low"]))).otherwise(none)
            return F.struct(F.concat(ends, rest).alias("ends"), a["most"].alias("most"), a["flat"].alias("flat"))
        return F.transform(F.array(F.concat(F.flatten(a["runs"]), a["run"])), with_rest)[0]
    blocks = F.regexp_extract_all(F.concat(code, F.lit("\n")), F.lit(BLOCK_LINES_RE), 0)
    return F.aggregate(blocks, start, step, result)


#: Characters of text and rows of a batch that a task sends back to Spark.
_BATCH_CHARS, _BATCH_ROWS = 8 << 20, 20_000
_ARROW = {"string": pa.string(), "int": pa.int32()}


def _rows_of_files(files: DataFrame, rows_of: Callable[[str | None], Iterable[tuple]], columns: str) -> DataFrame:
    """``rows_of(text)`` of every file beside its ``file_path``. A file is one
    row, and its rows come from that row: no line is shuffled, sorted or gathered
    again, and a task holds a bounded batch of texts (``session.configure``)."""
    kinds = [c.split() for c in f"file_path string, {columns}".split(", ")]
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in kinds])

    def run(batches):
        held, chars = [], 0
        for b in batches:
            for path, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for row in rows_of(text):
                    held.append((path, *row))
                    chars += sum(len(x) for x in row if isinstance(x, str))
                    if chars > _BATCH_CHARS or len(held) >= _BATCH_ROWS:
                        yield _batch(held, schema)
                        held, chars = [], 0
        if held:
            yield _batch(held, schema)
    return files.select("file_path", "text").mapInArrow(run, f"file_path string, {columns}")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def statements(files: DataFrame) -> DataFrame:
    """A row for each depth-0 statement of a file (see :func:`_scan`): its text
    and code, first and last line and the depth after it."""
    def rows_of(text):
        text, code = ccode.lines_and_code(text)
        for i, (a, b, first, last, depth) in enumerate(ccode.statements(code)):
            yield i, first, last, depth, text[a:b], code[a:b]
    return _rows_of_files(files, rows_of, "stmt int, first_line int, last_line int, depth int, text string, code string")


def segment_c_units(files: DataFrame) -> DataFrame:
    """Top-level C functions of ``.c``/``.h`` files, with their whole body.

    A unit is a depth-0 statement whose code up to its first ``{`` matches the
    header pattern; it starts on the pattern's first non-blank line and ends
    where the depth returns to 0. ``body`` is the text from the opening ``{``
    to the closing ``}``; one that is never closed runs to the end of the file,
    and its end line is the brace's. Braces in strings, comments and directives
    are no braces, and functions of linkage and namespace blocks are at depth
    0. Comments in a header are blanks in its signature."""
    c_files = files.where(M.suffix("file_path").isin(".c", ".h"))
    u = _rows_of_files(c_files, lambda text: ccode.c_functions(text, C_KEYWORDS),
                       "name string, signature string, body string, start_line int, end_line int")
    return u.select("*", F.lit("c").alias("language"), F.lit("function").alias("kind"))


def running_depth(files: DataFrame) -> DataFrame:
    """Per file the greatest brace depth after a line and the lines at depth 0."""
    found = files.select("file_path", F.transform(F.array(_code_lines(F.col("text"))[1]), _scan)[0].alias("s"))
    return found.select("file_path", F.col("s.most").cast("bigint").alias("max_depth"), F.col("s.flat").cast("bigint").alias("depth0_lines"))


def segment_asm_units(files: DataFrame) -> DataFrame:
    """Label blocks of ``.asm`` files (label to next label).

    A block is kept when a ``.globl/.global/.extern`` directive or a leading
    ``PUBLIC`` sits within the label line and the 5 lines above, or when a
    line of the block starts with an instruction word. When no block of a
    file qualifies all are kept; a file without labels is one ``<file>``
    unit. Bodies are whole."""
    a_files = files.where(M.suffix("file_path") == ".asm")
    text = F.col("text")
    bound = F.array(F.struct(_plain_lines(text).alias("ls"), text.alias("t")))

    def cut(x):
        ls, n = x["ls"], F.size(x["ls"])

        def with_labels(labels):
            def block(start, i):
                last = F.coalesce(F.get(labels, i + 1) - 1, n)
                above = F.greatest(start - 5, F.lit(1))
                region = F.slice(ls, above, start - above + 1)
                first = F.get(F.filter(region, lambda c: c.rlike(r"\S")), F.lit(0))
                pre = F.exists(region, lambda c: c.rlike(ASM_DIRECTIVE_RE)) | F.coalesce(first.rlike(ASM_PUBLIC_RE), F.lit(False))
                own = F.slice(ls, start, last - start + 1)
                ended = (last < n) | x["t"].endswith("\n")
                lone = F.when(ended, own).otherwise(F.slice(own, F.lit(1), last - start))  # a word alone counts on a line that ends
                instr = F.exists(own, lambda c: c.rlike(ASM_INSTR_RE)) | F.exists(lone, lambda c: c.rlike(r"^\s*[A-Za-z]+$"))
                name = F.regexp_extract(F.element_at(ls, start), ASM_LABEL_RE, 1)
                return F.struct(
                    name.alias("name"), F.concat(name, F.lit(" (asm)")).alias("signature"),
                    F.concat(F.array_join(own, "\n"), F.when(ended, F.lit("\n")).otherwise(F.lit(""))).alias("body"),
                    start.alias("start_line"), last.alias("end_line"), (pre | instr).alias("qualifies"))

            def kept(b):
                return F.filter(b["all"], lambda u: u["qualifies"] | ~b["any"])

            def with_any(blocks):
                return F.transform(F.array(F.struct(blocks.alias("all"), F.exists(blocks, lambda u: u["qualifies"]).alias("any"))), kept)[0]
            whole = F.array(F.struct(F.lit("<file>").alias("name"), F.lit("<asm>").alias("signature"), x["t"].alias("body"),
                                     F.lit(1).alias("start_line"), n.alias("end_line"), F.lit(True).alias("qualifies")))
            return F.when(F.size(labels) == 0, whole).otherwise(F.transform(F.array(F.transform(labels, block)), with_any)[0])
        return F.transform(F.array(_label_lines(ls)), with_labels)[0]
    units = a_files.select("file_path", F.explode(F.transform(bound, cut)[0]).alias("u"))
    return units.select("file_path", "u.name", "u.signature", "u.body", "u.start_line", "u.end_line",
                        F.lit("asm").alias("language"), F.lit("asm_block").alias("kind"))


def asm_labels(files: DataFrame) -> DataFrame:
    """(file_path, label, line_no, next_label_line) of every label; the last of
    a file has no next."""
    bound = F.array(_plain_lines(F.col("text")))

    def cut(ls):
        return F.transform(F.array(_label_lines(ls)), lambda at: F.transform(at, lambda line, i: F.struct(
            F.regexp_extract(F.element_at(ls, line), ASM_LABEL_RE, 1).alias("label"), line.cast("bigint").alias("line_no"),
            F.get(at, i + 1).cast("bigint").alias("next_label_line"))))[0]
    return files.select("file_path", F.explode(F.transform(bound, cut)[0]).alias("l")).select("file_path", "l.*")


def segment_whole_file(files: DataFrame, path: str = "file_path", text: str = "text") -> DataFrame:
    """Files of any other suffix: one ``<file>`` unit each (no shuffle)."""
    other = files.where(~M.suffix(path).isin(".c", ".h", ".asm"))
    t = F.coalesce(F.col(text), F.lit(""))
    return other.select(
        F.col(path).alias("file_path"), F.lit("<file>").alias("name"), F.lit("<file>").alias("signature"),
        t.alias("body"), F.lit(1).alias("start_line"),
        (_count_char(t, "\n") + 1).cast("int").alias("end_line"),
        M.language_of(F.col(path)).alias("language"), F.lit("full_file").alias("kind"))


def segment_units(files: DataFrame) -> DataFrame:
    """All units of a tree: C functions, assembly blocks, whole files."""
    return (segment_c_units(files).unionByName(segment_asm_units(files))
            .unionByName(segment_whole_file(files)))


# ---------------------------------------------------------------------------
# Line / token windows over units
# ---------------------------------------------------------------------------

def chunk_lines(units: DataFrame, size: int = 200, stride: int = 150, text: str = "text",
                start_col: str = "start_line") -> DataFrame:
    """Overlapping line windows of ``size`` lines every ``stride`` lines.

    Text is stripped first and empty texts are dropped; chunk line numbers
    are offset by the unit's start line. Windows start at 1, 1+stride, ...;
    the last window is the first one that reaches the end. Runs per row
    (``sequence`` + ``slice``): no shuffle."""
    t = _strip(F.col(text))
    lines = F.split(t, "\n")
    n = F.size(lines)
    starts = F.sequence(F.lit(1), F.greatest(n - size + stride, F.lit(1)), F.lit(stride))
    base = units.where(F.length(t) > 0).withColumn("_lines", lines).withColumn("_n", n)
    ex = base.select("*", F.posexplode(starts).alias("chunk_idx", "s"))
    ex = ex.where((F.col("s") == 1) | (F.col("s") <= F.col("_n") - size + stride))
    e = F.least(F.col("s") + size - 1, F.col("_n"))
    unit_start = F.coalesce(F.col(start_col), F.lit(1))
    return (ex.withColumn("chunk_text", F.array_join(F.slice("_lines", F.col("s"), e - F.col("s") + 1), "\n"))
              .withColumn("chunk_start_line", (unit_start + F.col("s") - 1).cast("int"))
              .withColumn("chunk_end_line", (unit_start + e - 1).cast("int"))
              .drop("_lines", "_n", "s"))


def chunk_tokens(units: DataFrame, size: int = 512, stride: int = 384, text: str = "text", tokenizer=None) -> DataFrame:
    """Overlapping windows over tokens with token_start/token_end (0-based, end
    exclusive): whitespace tokens, or those of a ``tokenizer`` (a factory of an
    encoder, see :mod:`tessera.functions.tokenizer`). The chunk is a piece of
    the text as it stands: from its first token to its last, what is between
    unchanged."""
    t = F.coalesce(F.col(text), F.lit(""))
    if tokenizer is not None:
        n = F.size("_spans")
        base = units.withColumn("_spans", K.spans(t, tokenizer)).where(n > 0)
        ex = base.select("*", F.posexplode(F.sequence(F.lit(0), F.greatest(n - size + stride - 1, F.lit(0)), F.lit(stride))).alias("chunk_idx", "token_start"))
        ex = ex.where((F.col("token_start") == 0) | (F.col("token_start") + size - stride < n))
        ex = ex.withColumn("token_end", F.least(F.col("token_start") + size, n).cast("int"))
        piece = K.cut(t, F.col("_spans"), F.col("token_start"), F.col("token_end") - F.col("token_start"))
        return ex.withColumn("chunk_text", piece).withColumn("token_start", F.col("token_start").cast("int")).drop("_spans")
    # token i is words[i] and gaps[i] the white space before it
    words = F.regexp_extract_all(t, F.lit(r"\S+"), 0)
    gaps = F.regexp_extract_all(t, F.lit(r"(\s*)\S+"), 1)
    n = F.size("_toks")
    starts = F.sequence(F.lit(0), F.greatest(n - size + stride - 1, F.lit(0)), F.lit(stride))
    base = units.withColumn("_toks", words).withColumn("_gaps", gaps).where(n > 0)
    ex = base.select("*", F.posexplode(starts).alias("chunk_idx", "token_start"))
    ex = ex.where((F.col("token_start") == 0) | (F.col("token_start") + size - stride < n))
    count = F.least(F.col("token_start") + size, n) - F.col("token_start")
    part = F.zip_with(F.slice("_gaps", F.col("token_start") + 1, count), F.slice("_toks", F.col("token_start") + 1, count),
                      lambda g, w: F.concat(g, w))
    return (ex.withColumn("token_end", (F.col("token_start") + count).cast("int"))
              .withColumn("token_start", F.col("token_start").cast("int"))
              .withColumn("chunk_text", F.regexp_replace(F.array_join(part, ""), r"^\s+", ""))
              .drop("_toks", "_gaps"))


# ---------------------------------------------------------------------------
# Includes and prototypes
# ---------------------------------------------------------------------------
INCLUDE_RE = r'(?m)^\s*#\s*include\s*[<"]([^>"]+)[>"]'
# a declaration up to its semicolon
PROTOTYPE_RE = r"^\s*([A-Za-z_][\w\s\*]*?)\s*\b([A-Za-z_]\w*)\s*\(([^)]*)\)\s*$"


def extract_includes(files: DataFrame) -> DataFrame:
    """(file_path, include, ordinal) per ``#include`` directive."""
    inc = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(INCLUDE_RE), 1)
    return files.select("file_path", F.posexplode(inc).alias("ordinal", "include"))


def extract_prototypes(files: DataFrame) -> DataFrame:
    """Depth-0 declarations ending in ``);`` in header files, over any number
    of lines and any number on a line: (file_path, name, signature, line_no of
    the first). Linkage and namespace blocks add no depth; comments are blanks
    in the signature."""
    h = files.where(M.suffix("file_path") == ".h")
    t = statements(h).where((F.col("depth") == 0) & ~F.col("code").contains("{"))
    pieces = t.select("file_path", "first_line", F.split("code", ";").alias("ps"))
    p = pieces.select("file_path", "first_line", "ps", F.posexplode("ps").alias("i", "p")).where(F.col("i") < F.size("ps") - 1)
    name = F.regexp_extract("p", PROTOTYPE_RE, 2)
    ahead = F.array_join(F.slice("ps", F.lit(1), F.col("i")), ";")
    line_no = F.col("first_line") + _count_char(ahead, "\n") + _count_char(F.regexp_extract("p", r"^\s*", 0), "\n")
    return p.where((name != "") & ~name.isin(*C_KEYWORDS)).select(
        "file_path", name.alias("name"), _strip(F.col("p")).alias("signature"), line_no.cast("int").alias("line_no"))

"""Training-set assembly: Q&A, contexts, unions, splits, samples, tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Question / context wording of the training examples.
FN_QUESTIONS = [  # (field, question template, answer kind)
    ("summary", "What does {base} do?"),
    ("risk_notes", "What are the potential risks of {base}?"),
    ("intent_tags", "What intent tags apply to {base}?"),
    ("change_recipe", "What changes might be needed for {base}?"),
    ("headers", "Which headers declare {base}?"),
]
FILE_QUESTIONS = [
    ("summary", "What is the overall purpose of {base}?"),
    ("risk_notes", "What are the potential risks in {base}?"),
    ("intent_tags", "What intent tags apply to {base}?"),
    ("change_recipe", "What changes might be needed in {base}?"),
]


def _fmt(template: str, base: Column) -> Column:
    a, b = template.split("{base}")
    return F.concat(F.lit(a), base, F.lit(b))


def qna_generate(functions: DataFrame, files: DataFrame | None = None,
                 headers: DataFrame | None = None, long_headers: DataFrame | None = None) -> DataFrame:
    """Questions per function (summary always; risks, tags, change recipe,
    headers when non-empty) and per file (summary always, then risks, tags,
    recipe). ``functions``: id, name, file_path, summary, risk_notes,
    intent_tags (array), change_recipe; ``headers``: id, headers (text).
    ``long_headers`` (name, part, headers) are lists that are asked for once a
    name and part instead of once a function."""
    f = functions
    base = F.concat(F.lit("Function '"), F.coalesce("name", F.lit("<unknown>")), F.lit("' in file '"),
                    F.coalesce("file_path", F.lit("<unknown file>")), F.lit("'"))
    answers = {
        "summary": F.coalesce(F.col("summary"), F.lit("")),
        "risk_notes": F.col("risk_notes"),
        "intent_tags": F.array_join(F.col("intent_tags"), ", "),
        "change_recipe": F.col("change_recipe"),
    }
    items = []
    for i, (field, tmpl) in enumerate(FN_QUESTIONS):
        if field == "headers":
            continue
        present = F.lit(True) if field == "summary" else (answers[field].isNotNull() & (answers[field] != ""))
        items.append(F.when(present, F.struct(F.lit(i).alias("qn"), _fmt(tmpl, base).alias("question"),
                                              answers[field].alias("answer"), F.lit("function").alias("level"))))
    none = F.lit(0).alias("part")
    out = f.select("id", none, F.explode(F.array_compact(F.array(*items))).alias("q")).select("id", "part", "q.*")
    if headers is not None:
        (qn, tmpl), = [(i, t) for i, (field, t) in enumerate(FN_QUESTIONS) if field == "headers"]
        out = out.unionByName(f.join(headers.where(F.col("headers") != "").select("id", "headers"), "id").select(
            "id", none, F.lit(qn).alias("qn"), _fmt(tmpl, base).alias("question"), F.col("headers").alias("answer"),
            F.lit("function").alias("level")))
        if long_headers is not None:
            every = F.concat(F.lit("every function '"), F.col("name"), F.lit("'"))
            out = out.unionByName(long_headers.select(
                F.concat(F.lit("name:"), "name").alias("id"), "part", F.lit(qn).alias("qn"), _fmt(tmpl, every).alias("question"),
                F.col("headers").alias("answer"), F.lit("function").alias("level")))
    if files is not None:
        fbase = F.concat(F.lit("File '"), F.coalesce("file_path", F.lit("<unknown file>")), F.lit("'"))
        fitems = []
        for i, (field, tmpl) in enumerate(FILE_QUESTIONS):
            ans = F.array_join(F.col("intent_tags"), ", ") if field == "intent_tags" else F.col(field)
            present = F.lit(True) if field == "summary" else (ans.isNotNull() & (ans != ""))
            fitems.append(F.when(present, F.struct(F.lit(i).alias("qn"), _fmt(tmpl, fbase).alias("question"),
                                                   F.coalesce(ans, F.lit("")).alias("answer"),
                                                   F.lit("file").alias("level"))))
        fo = files.select("id", none, F.explode(F.array_compact(F.array(*fitems))).alias("q")).select("id", "part", "q.*")
        out = out.unionByName(fo)
    return out


PART_ITEMS = 64


def list_parts(pairs: DataFrame, key: str, item: str, sep: str, size: int = PART_ITEMS) -> DataFrame:
    """(key, part, parts, ``item``, n): every item of every key's list, split
    over rows of about ``size`` items. An item's part is its hash modulo the
    number of parts, so a hub's list never sits in one task; within a part the
    items are in order. ``n`` counts the whole list."""
    n = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted_parts(pairs.join(n, key), key, item, sep, size)


def counted_parts(pairs: DataFrame, key: str, item: str, sep: str, size: int = PART_ITEMS) -> DataFrame:
    """:func:`list_parts` of pairs that know the length ``n`` of their list."""
    h = F.conv(F.substring(F.sha1(F.col(item).cast("string")), 1, 7), 16, 10).cast("bigint")
    cut = pairs.withColumn("parts", F.ceil(F.col("n") / F.lit(size)).cast("int")).withColumn("part", (h % F.col("parts")).cast("int"))
    return cut.groupBy(key, "part", "parts", "n").agg(
        F.array_join(F.array_sort(F.collect_list(F.col(item))), sep).alias(item))


def train_function_context(fn: DataFrame) -> DataFrame:
    """``Function: … | File: … | LOC: …, Cyclomatic: … | Intent tags: … |
    Risk notes: … | Callers: … | Callees: …`` -> summary."""
    ctx = F.concat_ws(" | ",
                      F.concat(F.lit("Function: "), F.coalesce("name", F.lit("<unknown>"))),
                      F.concat(F.lit("File: "), F.coalesce("file_path", F.lit("<unknown>"))),
                      F.concat(F.lit("LOC: "), F.coalesce(F.col("loc"), F.lit(0)).cast("string"), F.lit(", Cyclomatic: "),
                               F.coalesce(F.col("cyclomatic"), F.lit(0)).cast("string")),
                      F.concat(F.lit("Intent tags: "), F.array_join(F.coalesce("intent_tags", F.array().cast("array<string>")), ",")),
                      F.concat(F.lit("Risk notes: "), F.coalesce("risk_notes", F.lit(""))),
                      F.concat(F.lit("Callers: "), F.coalesce("callers", F.lit(""))),
                      F.concat(F.lit("Callees: "), F.coalesce("callees", F.lit(""))))
    return fn.select("id", "part", ctx.alias("input_text"), F.coalesce("summary", F.lit("")).alias("target_text"))


def train_file_context(files: DataFrame) -> DataFrame:
    ctx = F.concat(F.lit("File: "), F.coalesce("file_path", F.lit("<unknown>")), F.lit(" | LOC: "),
                   F.coalesce(F.col("loc"), F.lit(0)).cast("string"), F.lit(" | Functions: "),
                   F.coalesce(F.col("num_functions"), F.lit(0)).cast("string"), F.lit(" | Intent: "),
                   F.array_join(F.coalesce("intent_tags", F.array().cast("array<string>")), ","))
    return files.select("id", ctx.alias("input_text"), F.coalesce("summary", F.lit("")).alias("target_text"))


def train_class_context(classes: DataFrame) -> DataFrame:
    """Of classes that function contexts name in place of a list: their callers
    and definitions, part by part."""
    ctx = F.concat(F.lit("Functions: "), F.col("class"), F.lit(" | Callers: "), F.coalesce("callers", F.lit("")),
                   F.lit(" | Definitions: "), F.coalesce("definitions", F.lit("")))
    tgt = F.concat(F.col("class"), F.lit(" has "), F.col("n_callers").cast("string"), F.lit(" callers and "),
                   F.col("n_definitions").cast("string"), F.lit(" definitions."))
    return classes.select(F.col("class").alias("id"), "part", ctx.alias("input_text"), tgt.alias("target_text"))


def train_header_context(links: DataFrame) -> DataFrame:
    """Header links, a row a part of either side of a class: its headers beside
    the number of definitions, its definitions beside the number of headers."""
    items, paths, name = F.col("items"), F.col("paths"), F.col("name")
    nd, nh = F.col("n_definitions").cast("string"), F.col("n_headers").cast("string")
    left = F.col("side") == "header"
    ctx = F.when(left, F.concat(F.lit("Header: "), items, F.lit(" | Function: "), name, F.lit(" | Definitions: "), nd)).otherwise(
        F.concat(F.lit("Implementation: "), paths, F.lit(" | Function ID: "), items, F.lit(" | Function: "), name, F.lit(" | Headers: "), nh))
    tgt = F.when(left, F.concat(F.lit("Linking header "), items, F.lit(" to the "), nd, F.lit(" definitions of "), name, F.lit("."))).otherwise(
        F.concat(F.lit("Linking implementation "), paths, F.lit(" to the "), nh, F.lit(" headers that declare "), name, F.lit(".")))
    return links.select(ctx.alias("input_text"), tgt.alias("target_text"))


def train_header_links(links: DataFrame) -> DataFrame:
    """A row a header link (header_file, implementation_file, function_id)."""
    h, i, fid = (F.coalesce(F.col(c), F.lit("")) for c in ("header_file", "implementation_file", "function_id"))
    ctx = F.concat(F.lit("Header: "), h, F.lit(" | Implementation: "), i, F.lit(" | Function ID: "), fid)
    return links.select(ctx.alias("input_text"), F.concat(F.lit("Linking header "), h, F.lit(" to implementation "), i, F.lit(".")).alias("target_text"))


def training_union(qna: DataFrame, fn_ctx: DataFrame, file_ctx: DataFrame, header_ctx: DataFrame) -> DataFrame:
    """Q&A, function contexts, file contexts and header links in one table."""
    parts = [qna.select(F.lit("qna").alias("source"), F.col("question").alias("input_text"),
                        F.col("answer").alias("target_text")),
             fn_ctx.select(F.lit("function").alias("source"), "input_text", "target_text"),
             file_ctx.select(F.lit("file").alias("source"), "input_text", "target_text"),
             header_ctx.select(F.lit("header").alias("source"), "input_text", "target_text")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hash_order(id_col: Column, seed: str) -> Column:
    return F.sha1(F.concat(id_col.cast("string"), F.lit("|" + seed)))


def shuffle_split(df: DataFrame, id_col: str, val_frac: float = 0.1, max_records: int = 0,
                  seed: str = "0", exact: bool = True) -> DataFrame:
    """Deterministic shuffle + split. ``exact``: the first
    ``max(1, int(n*val_frac))`` rows in hash order are validation (a global
    sort); otherwise a hash bucket below ``val_frac`` (no sort, for very
    large tables). ``max_records`` caps train rows in hash order."""
    h = hash_order(F.col(id_col), seed)
    d = df.withColumn("_h", h)
    if exact:
        from .scale import global_rank
        n = df.select(F.count(F.lit(1))).scalar()
        nval = F.greatest(F.lit(1), F.floor(n * F.lit(val_frac))) if val_frac > 0 else F.lit(0)
        ranked = global_rank(d, ["_h", id_col], name="_rk")
        d = ranked.withColumn("split", F.when(F.col("_rk") <= nval, F.lit("val")).otherwise(F.lit("train")))
        if max_records > 0:
            d = d.where((F.col("split") == "val") | (F.col("_rk") - nval <= max_records))
        return d.drop("_h", "_rk")
    bucket = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") / F.lit(float(16 ** 8))
    return d.withColumn("split", F.when(bucket < val_frac, "val").otherwise("train")).drop("_h")


def holdout_by_group(df: DataFrame, group: str, pct: int = 20, seed: str = "0") -> DataFrame:
    """Whole groups held out: bucket = first 8 hex of sha1(group|seed) mod 100."""
    b = F.conv(F.substring(hash_order(F.col(group), seed), 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("split", F.when(b < pct, F.lit("holdout")).otherwise(F.lit("train")))


def review_sample(df: DataFrame, id_col: str, stratum: str, n: int = 50, seed: str = "0") -> DataFrame:
    """Fixed-size hash-ordered sample per stratum (a partial window limit
    cuts each stratum map-side)."""
    w = Window.partitionBy(stratum).orderBy(hash_order(F.col(id_col), seed), F.col(id_col))
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= n).drop("_rk")


def assist_limit(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Cap on the rows sent to the model, in a fixed order (top-n)."""
    return df.orderBy(*order).limit(n) if n > 0 else df


def tokenize_ids(text: Column, vocab: int = 32000) -> Column:
    """Pluggable tokenizer stand-in: whitespace tokens, id = first 7 hex of
    sha1(token) mod vocab (computable in SQL engines too)."""
    toks = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\S+"), 0)
    return F.transform(toks, lambda t: (F.conv(F.substring(F.sha1(t), 1, 7), 16, 10).cast("bigint") % vocab).cast("int"))


def pad_to(ids: Column, max_len: int, pad) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(F.lit(0), F.lit(max_len) - F.size(ids))))


def tokenize_windows(ids: Column, max_len: int, target_ids: Column | None = None, pad_id: int = 0, label_pad: int = -100) -> Column:
    """Array of (window, start, end, input_ids, attention_mask, labels), each
    ``max_len`` wide: as many windows as the ids need, so none is lost. Labels
    are the input ids themselves, or of a target text those of its window with
    the same number (windows without one are all label padding)."""
    bound = F.array(F.struct(ids.alias("i"), (ids if target_ids is None else target_ids).alias("t")))

    def cut(x):
        longest = F.greatest(F.size(x["i"]), F.size(x["t"]))
        n = F.greatest(F.lit(1), F.ceil(longest / F.lit(max_len)).cast("int"))

        def window(w):
            own, lab = F.slice(x["i"], w * max_len + 1, max_len), F.slice(x["t"], w * max_len + 1, max_len)
            start = F.least(w * max_len, F.size(x["i"]))
            return F.struct(w.alias("window"), start.alias("start"), (start + F.size(own)).alias("end"),
                            pad_to(own, max_len, pad_id).alias("input_ids"),
                            pad_to(F.transform(own, lambda _: F.lit(1)), max_len, 0).alias("attention_mask"),
                            pad_to(lab, max_len, label_pad).alias("labels"))
        return F.transform(F.sequence(F.lit(0), n - 1), window)
    return F.transform(bound, cut)[0]


def seq2seq_turn_pairs(conv: DataFrame) -> DataFrame:
    """Consecutive user -> assistant turns as (conv_id, turn, input, target).

    The next turn is found by an equi-join on (conv_id, turn + 1) rather
    than ``lead`` over a conversation window, so one very long conversation
    is spread over tasks by the composite key."""
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("input"))
    a = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target"))
    return u.join(a, ["conv_id", "turn"])


def seq2seq_from_versions(old: DataFrame, new: DataFrame, key: list[str], text: str = "text",
                          sha: str = "sha1") -> DataFrame:
    """Before/after pairs for units whose content changed between two
    snapshots (full outer join on the unit key)."""
    o = old.select(*key, F.col(text).alias("before"), F.col(sha).alias("sha_before"))
    n = new.select(*key, F.col(text).alias("after"), F.col(sha).alias("sha_after"))
    j = o.join(n, key, "full_outer")
    return j.where(F.col("sha_before").isNotNull() & F.col("sha_after").isNotNull() &
                   (F.col("sha_before") != F.col("sha_after")))


def sft_instruction(fn: DataFrame) -> DataFrame:
    """{instruction, input, output} rows as JSON text: the instruction asks
    for a summary; input carries the signature, file, callers and callees."""
    inst = F.concat(F.lit("Explain what the function "), F.col("name"), F.lit(" in "), F.col("file_path"), F.lit(" does."))
    inp = F.concat_ws("\n", F.concat(F.lit("Signature: "), F.coalesce("signature", F.lit(""))),
                      F.concat(F.lit("Callers: "), F.coalesce("callers", F.lit(""))),
                      F.concat(F.lit("Callees: "), F.coalesce("callees", F.lit(""))))
    return fn.select("id", "part", F.to_json(F.struct(inst.alias("instruction"), inp.alias("input"),
                                              F.coalesce("summary", F.lit("")).alias("output"))).alias("record"))

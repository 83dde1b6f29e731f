"""Column builders for model I/O text: prompts, JSON parsing, completions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Prompt wording, default model fields and assist templates.
FUNCTION_PROMPT = (
    "        Summarize the following {lang} function. IMPORTANT: Return only valid JSON (no surrounding text).\n"
    "        Required keys: summary (string), intent_tags (list of strings), risk_notes (string), "
    "change_recipe (string), confidence (float 0-1).\n"
    "\n"
    "        Function signature:\n"
    "        {signature}\n"
    "\n"
    "        Function body:\n"
    "        {body}\n"
    "\n"
    "        Return a single JSON object and nothing else.\n"
)
FILE_PROMPT = (
    "        Summarize this file: {path}.\n"
    "        Aggregate the provided function summaries and return only a single JSON object with keys:\n"
    "        - summary (string)\n"
    "        - intent_tags (list of strings)\n"
    "        - risk_notes (string)\n"
    "        - change_recipe (string)\n"
    "        - confidence (float 0-1)\n"
    "\n"
    "        Content (top {n} functions by LOC):\n"
    "        {body}\n"
    "\n"
    "        Return strictly one JSON object and nothing else.\n"
)
DEFAULT_CONFIDENCE = 0.6
FAILED_CONFIDENCE = 0.0
ASSIST_INSTRUCTION = {
    "summarize": "Summarize the purpose of this code:",
    "patch": "Suggest a short, safe improvement or minimal patch:",
}
ASSIST_PROMPT = {"summarize": "Summarize this code:\n{chunk}\n", "patch": "Suggest a patch for this code:\n{chunk}\n"}
MAX_PROMPT_TOKENS = 512

MODEL_SCHEMA = T.StructType([
    T.StructField("summary", T.StringType()),
    T.StructField("intent_tags", T.ArrayType(T.StringType())),
    T.StructField("risk_notes", T.StringType()),
    T.StructField("change_recipe", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])
FLAT_BLOCK_RE = r"\{[^{}]*\}"


def strip(c: Column) -> Column:
    """Python ``str.strip()`` on ASCII whitespace."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def dedent(c: Column) -> Column:
    """``textwrap.dedent`` for space indentation: whitespace-only lines
    become empty, then the common leading spaces of the other lines go. Lines
    and margin are bound to a lambda, so each is worked out once a text."""
    lines = F.transform(F.split(c, "\n"), lambda l: F.when(l.rlike(r"^\s*$"), F.lit("")).otherwise(l))

    def measured(ls):
        widths = F.transform(F.filter(ls, lambda l: l != ""), lambda l: F.length(F.regexp_extract(l, r"^( *)", 1)))
        return F.struct(ls.alias("ls"), F.coalesce(F.array_min(widths), F.lit(0)).alias("margin"))

    def cut(x):
        return F.array_join(F.transform(x["ls"], lambda l: F.when(l == "", l).otherwise(F.substring(l, x["margin"] + 1, 1 << 30))), "\n")
    return F.transform(F.transform(F.array(lines), measured), cut)[0]


def token_windows(text: Column, n: int = MAX_PROMPT_TOKENS) -> Column:
    """The text as pieces of at most ``n`` whitespace tokens, each as it stands
    in the text; only the white space at a cut is left out. A text of at most
    ``n`` tokens is one piece, unchanged."""
    t = F.coalesce(text, F.lit(""))
    bound = F.array(F.struct(F.regexp_extract_all(t, F.lit(r"\s*\S+"), 0).alias("p"), F.regexp_extract(t, r"(\s*)\z", 1).alias("tail")))

    def cut(x):  # the pieces are worked out once and bound to x
        last = F.greatest(F.lit(0), F.ceil(F.size(x["p"]) / F.lit(n)).cast("int") - 1)

        def window(i):
            part = F.array_join(F.slice(x["p"], i * n + 1, n), "")
            return F.concat(F.when(i == 0, part).otherwise(F.regexp_replace(part, r"^\s+", "")),
                            F.when(i == last, x["tail"]).otherwise(F.lit("")))
        return F.transform(F.sequence(F.lit(0), last), window)
    return F.transform(bound, cut)[0]


def prompt_function(signature: Column, body: Column, is_asm: Column) -> Column:
    """The prompt for a body, or for one of its token windows."""
    lang = F.when(is_asm, F.lit("assembly")).otherwise(F.lit("C"))
    head, rest = FUNCTION_PROMPT.split("{lang}")
    mid, tail = rest.split("{signature}")
    mid2, tail2 = tail.split("{body}")
    raw = F.concat(F.lit(head), lang, F.lit(mid), F.coalesce(signature, F.lit("")), F.lit(mid2),
                   F.coalesce(body, F.lit("")), F.lit(tail2))
    return dedent(raw)


def prompt_function_graph(name, path, signature, callers, callees, headers, body) -> Column:
    """Prompt with the function's graph context (columns by name)."""
    c = lambda x: F.coalesce(F.col(x), F.lit(""))
    return F.concat(F.lit("Function "), c(name), F.lit(" in "), c(path), F.lit("\nSignature: "), c(signature),
                    F.lit("\nCallers: "), c(callers), F.lit("\nCallees: "), c(callees),
                    F.lit("\nDeclared in: "), c(headers), F.lit("\nBody:\n"), c(body))


def prompt_file(path: Column, top_text: Column, n: int = 8) -> Column:
    head, rest = FILE_PROMPT.split("{path}")
    mid, tail = rest.split("{body}")
    return dedent(F.concat(F.lit(head), path, F.lit(mid.replace("{n}", str(n))), F.coalesce(top_text, F.lit("")),
                           F.lit(tail)))


def _valid_json(c: Column) -> Column:
    # from_json turns malformed input into a struct of nulls, not a null:
    # validity is checked separately
    return F.try_parse_json(c).isNotNull()


def parse_model_json(text: Column, schema: T.StructType = MODEL_SCHEMA) -> Column:
    """Whole text as a JSON object, else the first flat ``{...}`` block,
    else null (malformed JSON counts as no JSON)."""
    t = strip(text)
    whole = F.when(t.startswith("{") & t.endswith("}") & _valid_json(t), F.from_json(t, schema))
    block = F.regexp_extract(t, FLAT_BLOCK_RE, 0)
    return F.coalesce(whole, F.when((block != "") & _valid_json(block), F.from_json(block, schema)))


def model_defaults(parsed: Column, raw_text: Column, failed: Column | None = None) -> Column:
    """Fill missing fields; non-JSON output becomes the summary; a failed
    call gives empty fields with confidence 0. ``parsed`` is bound to a lambda,
    so a text is parsed once and not once a field."""
    no_tags = F.array().cast("array<string>")

    def filled(m):
        ok = m.isNotNull()
        return F.struct(
            F.when(ok, F.coalesce(m["summary"], F.lit(""))).otherwise(strip(F.coalesce(raw_text, F.lit("")))).alias("summary"),
            F.when(ok, F.coalesce(m["intent_tags"], no_tags)).otherwise(no_tags).alias("intent_tags"),
            F.when(ok, F.coalesce(m["risk_notes"], F.lit(""))).otherwise(F.lit("")).alias("risk_notes"),
            F.when(ok, F.coalesce(m["change_recipe"], F.lit(""))).otherwise(F.lit("")).alias("change_recipe"),
            F.when(ok, F.coalesce(m["confidence"], F.lit(DEFAULT_CONFIDENCE))).otherwise(
                F.lit(DEFAULT_CONFIDENCE)).cast("double").alias("confidence"))
    out = F.transform(F.array(parsed), filled)[0]
    if failed is None:
        return out
    empty = F.struct(F.lit("").alias("summary"), no_tags.alias("intent_tags"),
                     F.lit("").alias("risk_notes"), F.lit("").alias("change_recipe"),
                     F.lit(FAILED_CONFIDENCE).alias("confidence"))
    return F.when(failed, empty).otherwise(out)


def validate_enrichment(fields: Column) -> Column:
    """(valid, reason): summary present, confidence within [0, 1]."""
    c = fields["confidence"]
    reason = (F.when(fields["summary"].isNull() | (fields["summary"] == ""), F.lit("empty summary"))
               .when(c.isNull() | (c < 0) | (c > 1), F.lit("confidence out of range")))
    return F.struct(reason.isNull().alias("valid"), reason.alias("reason"))


def strip_completion(output: Column, prompt: Column, stop: str | None = None) -> Column:
    """Drop an echoed prompt prefix, strip, then cut at the stop token."""
    p = strip(prompt)
    out = F.when(output.startswith(p), strip(F.substring(output, F.length(p) + 1, 1 << 30))).otherwise(strip(output))
    if stop:
        out = F.when(out.contains(stop), strip(F.split_part(out, F.lit(stop), F.lit(1)))).otherwise(out)
    return out


def assist_record(chunks_name, source_file, start_line, end_line, language, text, output, mode: str = "summarize") -> Column:
    """The before/after record of one assisted chunk: the payload as input, the
    model's text as target, the hash over text and output."""
    out = F.coalesce(output, F.lit(""))
    return F.struct(
        F.lit("seq2seq_pair").alias("type"), F.lit("seq2seq").alias("kind"), chunks_name.alias("name"),
        source_file.alias("source_file"), start_line.alias("start_line"), end_line.alias("end_line"), language.alias("language"),
        F.sha2(F.concat(F.coalesce(text, F.lit("")), out), 256).alias("sha256"),
        assist_payload(text, mode).alias("input"), out.alias("target"))


def assist_prompt(chunk: Column, mode: str = "summarize") -> Column:
    a, b = ASSIST_PROMPT[mode].split("{chunk}")
    return F.concat(F.lit(a), chunk, F.lit(b))


def assist_payload(text: Column, mode: str = "summarize") -> Column:
    """``{instruction}\\n\\n### Code:\\n{text}\\n\\n### Output:``"""
    return F.concat(F.lit(ASSIST_INSTRUCTION[mode] + "\n\n### Code:\n"), F.coalesce(text, F.lit("")),
                    F.lit("\n\n### Output:"))

"""Column builders for per-unit code metrics, tags, notes and ids.

All of these are built-in expressions (codegen, no Python in the hot path).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# These patterns and sentences define the metrics and must
# equal the reference's so results agree. Kept verbatim, including their
# quirks (``&&``/``||``/``?`` wrapped in word boundaries, ``pthread_``
# followed by a boundary, substring tests such as "free" in "freeze").
# ---------------------------------------------------------------------------
CALL_SITE_RE = r"\b([A-Za-z_]\w*)\s*\("
CONTROL_RE = r"\b(if|else|for|while|case|switch|goto|&&|\|\||\?|return)\b"
TAG_RULES = [  # (tag, pattern on the lower-cased body)
    ("I/O", r"\b(read|write|scanf|printf|fopen|fread|fwrite)\b"),
    ("memory", r"\b(malloc|calloc|realloc|free|memcpy|memmove|memset)\b"),
    ("concurrency", r"\b(pthread_|mutex|lock|unlock|fork|exec)\b"),
    ("math", r"\b(pow|sqrt|sin|cos|log|exp)\b"),
    ("string", r"\b(strcmp|strcpy|strncpy|strlen|strcat|memchr)\b"),
    ("crypto", r"\b(md5|sha1|sha256|aes|crypto_)\b"),
]
BITOPS_RE = r"[&|^~<>]{1,2}"  # on the original body
NOTE_MEMORY = "Uses dynamic memory — watch for leaks and double-free."
NOTE_OVERFLOW = "Potential buffer overflow (unsafe string ops)."
NOTE_OVERFLOW_RE = r"\b(strcpy|strcat|gets)\b"
NOTE_CONCURRENCY = "Concurrency: locking / race conditions possible."
NOTE_ASM = "Assembly code — ABI/calling conventions matter; harder to analyze."
# Python's str.splitlines() boundaries, so line counts agree with it.
SPLITLINES_RE = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
# ---------------------------------------------------------------------------

# The same matches in fewer steps: a control token is looked for only where its
# first letter stands, a call site without stepping back into a name, and a line of
# ASCII that isn't blank from its first character on.
ASCII_LINE_RE = ("[" + "".join(rf"\x{i:02x}" for i in range(128) if chr(i) not in " \t\n\r\x0b\x0c\x1c\x1d\x1e")
                 + r"][^\n\r\x0b\x0c\x1c\x1d\x1e]*")
CONTROL_FAST_RE = r"(?=[iefwcsgr&|?])" + CONTROL_RE
CALL_SITE_FAST_RE = r"(?=[A-Za-z_])\b([A-Za-z_]\w*+)\s*+\("

# The words of all rules: a text has those of its tags among the ones found, each
# once a place, since a word of one rule is never a part of another's.
_TAG_WORDS = {t: re.search(r"\((.*)\)", p)[1].split("|") for t, p in TAG_RULES}
_WORDS = [w for words in _TAG_WORDS.values() for w in words]
TAG_WORDS_RE = f"(?=[{''.join(sorted({w[0] for w in _WORDS}))}])" + rf"\b({'|'.join(_WORDS)})\b"
# Tags in the binary (Python ``sorted``) order: the array is built sorted.
TAG_ORDER = ["I/O", "asm", "bitops", "concurrency", "crypto", "math", "memory", "string"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def file_name(path) -> Column:
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def suffix(path) -> Column:
    """``Path(p).suffix.lower()``: last dot of the final component, with at
    least one character before and after it."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1))


def extension(path) -> Column:
    """Suffix without the dot, case kept (file index column)."""
    return F.regexp_extract(file_name(path), r"^.+\.([^.]+)$", 1)


def language_of(path) -> Column:
    sfx = suffix(path)
    return (F.when(sfx.isin(".c", ".h"), F.lit("c"))
             .when(sfx == ".asm", F.lit("asm")).otherwise(F.lit("other")))


def loc(body) -> Column:
    """Non-blank lines (``splitlines`` + ``strip``)."""
    b = F.coalesce(_c(body), F.lit(""))
    ascii_lines = F.regexp_count(b, F.lit(ASCII_LINE_RE))
    lines = F.size(F.filter(F.split(b, SPLITLINES_RE), lambda x: x.rlike(r"\S")))
    return F.when(F.octet_length(b) == F.char_length(b), ascii_lines).otherwise(lines).cast("bigint")


def cyclomatic(body) -> Column:
    """1 + number of control-token matches; 1 for an empty body."""
    b = _c(body)
    return F.when(F.coalesce(F.length(b), F.lit(0)) == 0, F.lit(1).cast("bigint")) \
            .otherwise((F.regexp_count(b, F.lit(CONTROL_FAST_RE)) + 1).cast("bigint"))


def call_sites(body) -> Column:
    """Every ``name(`` token in order, duplicates and keywords kept."""
    b = F.coalesce(_c(body), F.lit(""))
    found = lambda flags: F.regexp_extract_all(b, F.lit(flags + CALL_SITE_FAST_RE), 1)
    return F.when(F.octet_length(b) == F.char_length(b), found("")).otherwise(found("(?U)"))


def _tag_words(body) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(_c(body), F.lit(""))), F.lit(TAG_WORDS_RE), 1)


def _tag_flags(found: Column, body, path) -> dict:
    b = F.coalesce(_c(body), F.lit(""))
    flags = {t: F.arrays_overlap(found, F.array(*map(F.lit, words))) for t, words in _TAG_WORDS.items()}
    flags["asm"] = suffix(path) == ".asm"
    flags["bitops"] = b.rlike(BITOPS_RE)
    return flags


def intent_tags(body, path) -> Column:
    """Sorted tag set; ``["other"]`` when no rule fires."""
    def tags_of(found):
        flags = _tag_flags(found, body, path)
        return F.array_compact(F.array(*[F.when(flags[t], F.lit(t)) for t in TAG_ORDER]))
    tags = F.transform(F.array(_tag_words(body)), tags_of)  # the words are looked for once
    return F.transform(tags, lambda x: F.when(F.size(x) == 0, F.array(F.lit("other"))).otherwise(x))[0]


def intent_tag_flags(body, path) -> list[Column]:
    """One boolean column per tag (``tag_<name>``), for bounded rollups."""
    flags = _tag_flags(_tag_words(body), body, path)
    any_tag = None
    for t in TAG_ORDER:
        any_tag = flags[t] if any_tag is None else (any_tag | flags[t])
    cols = [flags[t].alias(tag_col(t)) for t in TAG_ORDER]
    cols.append((~any_tag).alias(tag_col("other")))
    return cols


def tag_col(t: str) -> str:
    return "tag_" + ("io" if t == "I/O" else t)


def risk_note_flags(body, path) -> list[Column]:
    b = F.coalesce(_c(body), F.lit(""))
    return [
        (b.contains("malloc") | b.contains("free") | b.contains("realloc")).alias("note_memory"),
        b.rlike(NOTE_OVERFLOW_RE).alias("note_overflow"),
        (b.contains("pthread") | b.contains("mutex")).alias("note_concurrency"),
        (suffix(path) == ".asm").alias("note_asm"),
    ]


NOTE_COLUMNS = [("note_memory", NOTE_MEMORY), ("note_overflow", NOTE_OVERFLOW),
                ("note_concurrency", NOTE_CONCURRENCY), ("note_asm", NOTE_ASM)]


def notes_from_flags(prefix: str = "") -> Column:
    """Space-joined notes in rule order from boolean ``note_*`` columns."""
    return F.concat_ws(" ", *[F.when(F.col(prefix + c), F.lit(s)) for c, s in NOTE_COLUMNS])


def risk_notes(body, path) -> Column:
    flags = risk_note_flags(body, path)
    return F.concat_ws(" ", *[F.when(f, F.lit(s)) for f, (_, s) in zip(flags, NOTE_COLUMNS)])


def sha1_short(text, length: int = 12) -> Column:
    """First ``length`` hex chars of SHA-1 over the first 10,000 chars: a label
    for display. Texts are told apart by the SHA-256 of all of them."""
    t = F.coalesce(_c(text), F.lit(""))
    return F.substring(F.sha1(F.substring(t, 1, 10000).cast("binary")), 1, length)


def content_sha256(content) -> Column:
    return F.sha2(_c(content), 256)


def function_id(path, name, start_line, prefix: str = "repo") -> Column:
    """``repo:{path}:{name}:{start}``, defaults ``<unknown>`` / 0."""
    return F.concat_ws(":", F.lit(prefix), F.coalesce(_c(path), F.lit("")),
                       F.coalesce(_c(name), F.lit("<unknown>")),
                       F.coalesce(_c(start_line).cast("string"), F.lit("0")))


def truncate(text, n: int) -> Column:
    return F.substring(_c(text), 1, n)


# Display limits of the unit record (fixed values). Nothing is computed from
# the cut text.
PREVIEW_BODY_CHARS = 100_000
PREVIEW_FILE_CHARS = 8_000

"""C text as code: its view without what isn't code, and its depth-0 statements.

Plain Python over one text, called file by file inside tasks. Texts are passed
over by searches for the few characters that matter, so the time follows their
length and the memory a copy of one text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

_BLANK = " \t\r\f\x0b"
_ESCAPED = r"\\(?:\r\n|[\s\S])"
_STRING = rf'"(?:[^"\\\n]|{_ESCAPED})*+"?'
_CHAR = rf"'(?:[^'\\\n]|{_ESCAPED})*+'?"
_OPENS = re.compile(r"[/\"'#]")
_TOKENS = {'"': re.compile(_STRING), "'": re.compile(_CHAR), "/": re.compile(rf"//(?:[^\\\n]|{_ESCAPED})*+"),
           "#": re.compile(rf"#(?:[^\\\n/\"']|{_ESCAPED}|/(?!\*)|{_STRING}|{_CHAR})*+")}
_HIDDEN = {'"': re.compile(r'[^\n"]+'), "#": re.compile(r"[^\n#]+"), "/": re.compile(r"[^\n]+"), "'": re.compile(r"[^\n]+")}
# what follows the word of a linkage or namespace block, up to its brace
_BLOCKS = {"extern": re.compile(r'\s+"\s*"\s*\{', re.A), "namespace": re.compile(r"(?u:\b)[\w\s:]*\{", re.A)}
_BRACE = re.compile(r"[{}]")
# the end of a statement on a line without braces: a ; at its end or a # that may start it
_END = re.compile(rf"(?m);[{_BLANK}]*[\x85\u2028\u2029]?$|#")
_CLOSED = re.compile(rf";[{_BLANK}]*[\x85\u2028\u2029]?\Z")
# Fixed value: the C function header (the reference's definition of a unit), found
# at the start of any line and never from a blank one
_HEADER = re.compile(r"(?:\A|(?<=[\n\x85\u2028\u2029])|(?<=\r)(?!\n))[^\S\n]*([a-zA-Z_][\w\s\*\(\)]*?)\s+([A-Za-z_]\w*)\s*\(\s*([^)]*)\)\s*\{", re.A)
_EDGES = re.compile(r"\A\s+|\s+(?=[\x85\u2028\u2029]?\Z)", re.A)


def _blanked(token: str, kind: str) -> str:
    """Blanks for all but line ends, a string's quotes and a directive's #."""
    if "\n" not in token:
        if kind == "/" or kind == "'":
            return " " * len(token)
        if kind == '"' and token.find('"', 1) == len(token) - 1:
            return '"' + " " * (len(token) - 2) + '"'
    return _HIDDEN[kind].sub(lambda m: " " * (m.end() - m.start()), token)


def code_view(text: str) -> str:
    """``segment.code_view`` of one text: everything blanked that isn't code;
    lengths and lines are the same. The brace that opens a linkage or namespace
    block becomes a ``;``."""
    pieces, shown, at = [], 0, 0  # shown: up to where the text is in pieces; at: where to look on
    while m := _OPENS.search(text, at):
        i = start = m.start()
        kind = text[i]
        if kind == "/" and text.startswith("*", i + 1):
            end = text.find("*/", i + 2) + 2
            end = end if end > 1 else len(text)
        elif kind == "/" and not text.startswith("/", i + 1):
            at = i + 1
            continue
        else:
            if kind == "#":
                start = text.rfind("\n", 0, i) + 1
                if start < shown or text[start:i].strip(_BLANK):  # no directive
                    at = i + 1
                    continue
            end = _TOKENS[kind].match(text, i).end()
        pieces += (text[shown:start], _blanked(text[start:end], kind))
        shown = at = end
    view = "".join(pieces) + text[shown:] if pieces else text
    braces = set()
    for word, rest in _BLOCKS.items():
        at = view.find(word)
        while at >= 0:
            m = rest.match(view, at + len(word))
            if m and not (at and (view[at - 1].isalnum() or view[at - 1] == "_")):
                braces.add(m.end() - 1)
            at = view.find(word, at + 1)
    ends = [-1, *sorted(braces), len(view)]
    return ";".join(view[a + 1:b] for a, b in zip(ends, ends[1:])) if braces else view


def statements(code: str) -> Iterator[tuple[int, int, int, int, int]]:
    """(start, end, first line, last line, depth) of the depth-0 statements of a
    :func:`code_view`, as offsets without the last line's end.

    A statement ends with a line after which the brace depth is 0 and whose code
    ends with ``;`` or holds ``}`` or is a directive. Depth counts whole lines
    and never falls below 0. What follows the last end is a statement too."""
    size, total, low = len(code), 0, 0
    start = at = 0  # the statement's start; the line to look on from
    first = 1

    def ended(stop):
        nonlocal start, first
        last = first + code.count("\n", start, stop)
        found = start, stop, first, last, total - low
        start, first = stop + 1, last + 1
        return found
    while True:
        m = _BRACE.search(code, at)
        line = code.rfind("\n", at, m.start()) + 1 or at if m else size
        while total == low and (e := _END.search(code, at, line)):  # lines without braces
            at = e.start() + 1
            if code[at - 1] == "#" and code[code.rfind("\n", 0, at - 1) + 1:at - 1].strip(_BLANK):
                continue
            stop = code.find("\n", at)
            stop = size if stop < 0 else stop
            yield ended(stop)
            at = stop + 1
        if not m:
            break
        stop = code.find("\n", m.start())
        stop = size if stop < 0 else stop
        closing = code.count("}", line, stop)
        total += code.count("{", line, stop) - closing
        low = min(low, total)
        if total == low and (closing or _CLOSED.search(code, line, stop) or code[line:stop].lstrip(_BLANK).startswith("#")):
            yield ended(stop)
        at = stop + 1
        if at > size:
            break
    if start <= size:
        yield ended(size)


def lines_and_code(text: str | None) -> tuple[str, str]:
    """A text without the end of its last line, and its view."""
    text = (text or "").removesuffix("\n")
    return text, code_view(text)


def c_functions(text: str | None, no_names: frozenset[str]) -> Iterator[tuple[str, str, str, int, int]]:
    """(name, signature, body, start line, end line) of the functions of a C
    text (see ``segment.segment_c_units``)."""
    text, code = lines_and_code(text)
    for start, end, first, last, depth in statements(code):
        brace = code.find("{", start, end)
        if brace < 0:
            continue
        ahead = max(code.rfind(";", start, brace) + 1, start)  # declarations on the same line go before
        m = _HEADER.search(code[ahead:brace + 1])
        if not m or m.group(2) in no_names:
            continue
        line = first + code.count("\n", start, ahead + m.start())
        signature = f"{_EDGES.sub('', m.group(1))} {m.group(2)}({_EDGES.sub('', m.group(3))})"
        if depth == 0:
            yield m.group(2), signature, text[brace:max(code.rfind("}", brace, end) + 1, brace)], line, last
        else:  # never closed: to the end of the text
            yield m.group(2), signature, text[brace:end], line, line + m.group().count("\n")

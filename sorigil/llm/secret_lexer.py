"""Secret scan by assignment-aware lexing.

Three plain patterns give the base spans (``assign``, ``access``, ``hex``). Beside them a small
lexer reads source and configuration syntax: ``name = "literal"``, ``"name": "literal"``,
``name: literal``, ``NAME=literal``, ``const name = 'a' + 'b'``, ``name: type = "literal"``, ``var name string = "literal"``,
``table["name"] = "literal"`` and ``<name>literal</name>``; literals may have escapes, triple quotes or backticks. Pairs of
name and value are kept in order of the text; a value that is the name of an earlier pair takes that
pair's literal (constants are propagated, so ``k = "x"; api_token = k`` marks the literal at ``k``).
Every literal is scored by the parts of the names it reaches (``db_password`` -> ``db``, ``password``)
and by its own form; names about a secret (``token_type``) and bare values that are code (``os.environ["DB"]``, a call, a
dotted name) hold none. Literals at or above ``SCORE`` become spans of kind ``literal``.

Results: offsets are code points, end exclusive. A literal that lies within a base span is not
reported again. Null and empty texts have no spans. Repeated rows are scanned each on their own; columns
beside the id and the text are left alone. A scan keeps nothing beyond one text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sorigil.llm.common import by_batch

# The base patterns of the contract and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 and more; shorter runs fail the length rule anyway
KINDS = ("assign", "access", "hex", "literal")
LEAST = {"assign": 6, "access": 20}

# Parts of names that hold secrets, with their weight.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0, "credential": 1.0,
    "credentials": 1.0, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "bearer": 0.9, "auth": 0.7, "authorization": 0.7,
    "private": 0.5, "access": 0.4, "key": 0.4, "api": 0.4, "signature": 0.4, "salt": 0.4, "session": 0.3, "client": 0.2,
}
#: Last parts of names that speak about a secret and do not hold it.
ABOUT = frozenset("type name id ids kind count length len size limit url uri endpoint path file policy expiry expires ttl timeout version".split())
DOTTED = re.compile(r"[A-Za-z_]\w*+(?:(?:\.|->|::)[A-Za-z_]\w*+)++\Z", re.A)
PLACEHOLDER = re.compile(r"(?:x+|\*+|\.+|-+|<.*>|\$\{.*\}|%.*%|true|false|null|none|nil|undefined|changeme|example|todo|your[-_ ].*)\Z", re.I | re.A)
SCORE = 1.0
LEAST_LITERAL = 6

# Runs are possessive and have no length limit: each is read once, so that work stays in proportion to the text.
_DQ, _SQ = r'''"(?P<dq>(?:[^"\\\n]|\\.)*+)"''', r"""'(?P<sq>(?:[^'\\\n]|\\.)*+)'"""
_LEX = re.compile(
    r"""(?P<tag><(?P<tname>[A-Za-z_][\w.-]*+)>(?P<tval>[^<>\s]++)</)"""
    r"""|(?P<q>["']?)(?<![\w.-])(?P<name>[A-Za-z_][\w.-]*+)(?P=q)(?:(?<=["'])\])?+"""
    # a type: name: str = "literal"
    r"""(?:[\x20\t]*+:[\x20\t]*+(?:&(?:'\w++[\x20\t]++)?)?[A-Za-z_][\w.\[\]<>|?*]*+(?=[\x20\t]*+=[\x20\t]*+["'`]))?"""
    r"""[\x20\t]*+(?::=|=>|=(?![=>])|:(?![:/]))[\x20\t]*+"""
    r'''(?:"""(?P<d3>(?:[^"\\]|\\(?s:.)|"(?!""))*+)"""'''
    r"""|'''(?P<s3>(?:[^'\\]|\\(?s:.)|'(?!''))*+)'''"""
    rf"""|{_DQ}|{_SQ}|`(?P<bt>(?:[^`\\]|\\(?s:.))*+)`"""
    r"""|(?P<bare>[^\s"'`,;(){}\[\]<>|]++))""",
    re.A,
)
_VALUES = ("tval", "d3", "s3", "dq", "sq", "bt", "bare")
_PLUS = re.compile(rf"[\x20\t]*+\+[\x20\t]*+(?:{_DQ}|{_SQ})")
TYPES_BEHIND = frozenset(("string",))  # Go: var name string = "literal"
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the contract's three patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def name_weight(name: str) -> float:
    """How strongly a target name speaks of a secret: its parts, and neighbouring parts joined."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if len(parts) > 1 and parts[-1] in ABOUT:
        return 0.0
    joined = [a + b for a, b in zip(parts, parts[1:])]
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in {*parts, *joined}))


def literal_weight(value: str) -> float:
    """From -1 (a placeholder, too short) to 1 (long, mixed, dense): evidence in the literal itself."""
    if len(value) < LEAST_LITERAL or PLACEHOLDER.match(value):
        return -1.0
    if " " in value:  # a passphrase or prose: the name alone decides
        return 0.0
    counts = Counter(value)
    bits = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    mixed = any(c.isdigit() for c in value) + any(c.isupper() for c in value) + any(c.islower() for c in value)
    return min(1.0, max(0.0, (bits - 2.0) / 2.0)) * (0.4 + 0.2 * mixed)


def is_expression(text: str, value: str, end: int) -> bool:
    """Whether a bare value is code: called, indexed, or a dotted name (no part of it long, with both letters and digits)."""
    if text[end : end + 1] in ("(", "["):
        return True
    if not DOTTED.match(value):
        return False
    return not any(len(p) >= 12 and any(c.isdigit() for c in p) for p in re.split(r"\W+", value))


def word_before(text: str, at: int) -> str | None:
    """The word ahead of a place on the same line, with blanks between."""
    end = at
    while end and text[end - 1] in " \t":
        end -= 1
    start = end
    while start and (text[start - 1].isalnum() or text[start - 1] == "_"):
        start -= 1
    return text[start:end] if start < end < at else None


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Spans of literals whose name, or a name they are handed on to, is sensitive."""
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    literals: list[tuple[int, int, float, str]] = []  # start, end, weight of the names reached, value
    value_of: dict[str, int] = {}  # name -> literal
    for m in _LEX.finditer(text):
        name, kind = m["tname"] or m["name"], next(k for k in _VALUES if m[k] is not None)
        if name in TYPES_BEHIND and kind != "bare":
            name = word_before(text, m.start("name")) or name
        weight, value = name_weight(name), m[kind]
        if kind == "bare" and value in value_of:  # a constant named before: its literal gets this name as well
            at = value_of[name] = value_of[value]
            start, end, had, value = literals[at]
            literals[at] = (start, end, max(had, weight), value)
            continue
        start, end = m.span(kind)
        if kind == "bare" and is_expression(text, value, end):  # its value is not in the text
            value_of.pop(name, None)
            continue
        more = kind in ("dq", "sq") and _PLUS.match(text, m.end())
        while more:  # "a" + "b": one value, marked to its end
            end = more.end("dq") if more["dq"] is not None else more.end("sq")
            value += more["dq"] or more["sq"] or ""
            more = _PLUS.match(text, more.end())
        value_of[name] = len(literals)
        literals.append((start, end, weight, value))
    return sorted({(s, e) for s, e, w, v in literals if w > 0 and w + literal_weight(v) >= SCORE})


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each sorted by start, then kind."""
    text = text or ""
    base = sorted(base_spans(text))
    reach, at, extra = -1, 0, []
    for s, e in literal_spans(text):
        while at < len(base) and base[at][0] <= s:
            reach, at = max(reach, base[at][2]), at + 1
        if e > reach:
            extra.append((s, 3, e))
    return base, sorted(base + extra)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str | None, mark: str = "<secret>") -> str | None:
    """The text with every found span replaced by ``mark``; overlapping spans become one."""
    if text is None:
        return None
    out, at = [], 0
    for s, _, e in scan(text)[1]:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, base counts and digest, and all spans. No shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            base, every = scan(text)
            n = Counter(k for _, k, _ in base)
            rows.append((n[0], n[1], n[2], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
        cols = list(zip(*rows)) if rows else [[]] * 5
        types = [pa.int64()] * 3 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], names=[id_col, *(c.split()[0] for c in SCHEMA.split(", "))])

    schema = T.StructType([docs.schema[id_col], *T._parse_datatype_string(SCHEMA)])
    return docs.select(id_col, text_col).mapInArrow(by_batch(run), schema)


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans in its texts replaced; other columns, nulls and order of columns stay."""
    names = docs.columns
    at = names.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.set_column(at, text_col, pa.array([redact(t) for t in batch.column(at).to_pylist()], pa.string()))

    return docs.mapInArrow(by_batch(run), docs.schema)

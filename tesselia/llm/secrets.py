"""Secret scans: base patterns, and assignment-aware lexing of source and configuration syntax.

The lexer reads a text into tokens and pairs of a name and its literals: ``name = "x"``, ``name: x``, ``"name": 'x'``,
``name => x``, ``name := "x" + other``. Constants are propagated: a name that was assigned a literal stands for it in
later assignments. A literal is scored by how sensitive the name is that it reaches and by how much it looks
like a key; literals above ``threshold`` are findings: ``literal`` if written in the assignment itself, ``flow`` if
they got there by a constant.

Base findings are leftmost non-overlapping matches of each kind, those too short dropped; they always stay. Lexed literals that
overlap a base finding are the same secret and are not repeated. Spans are in code points, end exclusive. Null and
empty texts have none. No shuffle; texts without any of the patterns' literals are skipped by a linear-time
filter over the whole Arrow column; time grows as a text's length (spans meet base findings by bisection). Repeated rows are each
scanned, an empty table gives no rows, and other columns may have any names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_arrow, sha256_hex, texts

KINDS = ("assign", "access", "hex", "literal", "flow")

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

_TOKEN = re.compile(
    r"""(?P<str>"(?:[^"\\\n]|\\.)*"|(?<!\w)'(?:[^'\\\n]|\\.)*')|(?P<name>[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)"""
    r"""|(?P<not>[=!<>]=)|(?P<set>:=|=>|\+=|[=:])|(?P<plus>\+)|(?P<end>[\n;,{}])""",
    re.ASCII,
)
_BARE = re.compile(r"""[^\s,;"'(){}\[\]<>#]+""")
#: A member of something, as in a.b, is looked up and no literal.
_MEMBER = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)+", re.ASCII).fullmatch
#: A literal with a prefix or three quotes, as after an assignment.
_STRING = re.compile(r"""(?:[rbuRBUfF]{1,2})?(?:\"{3}(?P<a>(?:[^"\\]|\\.|"(?!""))*)\"{3}|'{3}(?P<b>(?:[^'\\]|\\.|'(?!''))*)'{3}|"(?P<c>(?:[^"\\\n]|\\.)*)"|'(?P<d>(?:[^'\\\n]|\\.)*)')""", re.DOTALL)
_BLANK = re.compile(r"[ \t]*")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_STRONG = {"password", "passwd", "passphrase", "pwd", "secret", "token", "credential", "credentials", "apikey", "bearer", "authorization"}
_KEYS = {"api", "access", "private", "auth", "signing", "encryption", "secret", "account"}
_NEUTRAL = {"count", "type", "name", "field", "length", "size", "limit", "ttl", "url", "path", "file", "hint", "policy", "label", "id"}
_PLACEHOLDER = re.compile(r"(?i)x{4,}|\*{3,}|\.{3,}|changeme|example|placeholder|your[_-]|<.*>|\$\{.*\}|null|none|true|false|undefined")
#: What a text must hold for the lexer to be able to find anything.
_WORTH = r"(?i)pass|pwd|secret|token|credential|key|bearer|authorization"


def name_score(name: str) -> float:
    """0 for a harmless name, up to 1 for one that says it holds a secret."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts:
        return 0.0
    hot = any(p in _STRONG for p in parts) or any(a in _KEYS and b in ("key", "keys") for a, b in zip(parts, parts[1:]))
    return (0.3 if parts[-1] in _NEUTRAL else 1.0) if hot else 0.0


def literal_score(value: str, quoted: bool) -> float:
    """0 to 1: length, mixed characters and entropy; 0 for placeholders, plain words, prose and short values."""
    if len(value) < 8 or re.search(r"\s", value) or _PLACEHOLDER.search(value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", r"\d", r"[^\w\s]"))
    if entropy < 2.5 or classes < 2 and (not quoted or n < 20 and value.isalpha()):
        return 0.0
    return min(1.0, 0.3 * quoted + 0.2 * (classes - 1) + entropy / 8)


_PLUS = re.compile(r"[ \t]*\+[ \t]*")


def lex(text: str, threshold: float = 1.4) -> list[tuple[int, int, str]]:
    """(start, end, kind) of literals that reach a sensitive name.

    An assignment is a node: its own literals and the nodes of the constants it names. Literals are then found by a walk from the
    sensitive ones, the most sensitive first, that visits each node once, so time is linear in the text.
    """
    nodes: list[tuple[list[tuple[int, int, bool]], list[int]]] = []
    env: dict[str, int] = {}
    hot: list[tuple[float, int]] = []
    name, at = None, 0
    while m := _TOKEN.search(text, at):
        at = m.end()
        kind = m.lastgroup
        if kind == "name":
            name = m.group()
        elif kind == "str":
            name = m.group()[1:-1]
        elif kind != "set":
            name = None
        elif name is not None:
            target, name = name, None
            own: list[tuple[int, int, bool]] = []
            refs = [env[target]] if m.group() == "+=" and target in env else []
            while True:
                at = _BLANK.match(text, at).end()
                term = _STRING.match(text, at)
                if term:
                    own.append((*term.span(term.lastgroup), True))
                    at = term.end()
                else:
                    bare = _BARE.match(text, at)
                    if not bare:
                        break
                    word = bare.group().rstrip(".:")
                    at = at + max(1, len(word))
                    if word in env:
                        refs.append(env[word])
                    elif text[at : at + 1] not in ("(", "[") and not _MEMBER(word):
                        own.append((at - len(word), at, False))
                plus = _PLUS.match(text, at)
                if not plus:
                    break
                at = plus.end()
            env[target] = len(nodes)
            nodes.append((own, refs))
            if score := name_score(target):
                hot.append((score, env[target]))
    found: dict[tuple[int, int], str] = {}
    seen: set[int] = set()
    for score, first in sorted(hot, key=lambda h: -h[0]):
        todo = [first]
        while todo:
            n = todo.pop()
            if n in seen and n != first:
                continue
            seen.add(n)
            for a, b, quoted in nodes[n][0]:
                if ((a, b) not in found or n == first) and score + literal_score(text[a:b], quoted) >= threshold:
                    found[a, b] = "literal" if n == first else "flow"
            todo += [r for r in nodes[n][1] if r not in seen]
    return [(a, b, k) for (a, b), k in sorted(found.items())]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def scan(text: str, worth: bool = True, threshold: float = 1.4) -> tuple[list, list]:
    """Base spans, and all spans with the lexed ones; sorted by start, then kind."""
    base = sorted(base_spans(text), key=lambda s: (s[0], KINDS.index(s[2])))
    starts, ends = [], []  # of the union of base spans
    for a, b, _ in base:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    extra = []
    for s in lex(text, threshold) if worth else []:
        k = bisect_right(ends, s[0])
        if k == len(ends) or starts[k] >= s[1]:
            extra.append(s)
    return base, sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan_secrets(docs: DataFrame, threshold: float = 1.4) -> DataFrame:
    """doc_id, and arrays of structs (kind, start, end): base and all; one row per document."""
    schema = "doc_id long, base array<struct<kind: string, start: long, end: long>>, spans array<struct<kind: string, start: long, end: long>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return _scan(docs, threshold, schema, lambda b, s: ([{"kind": k, "start": x, "end": y} for x, y, k in b], [{"kind": k, "start": x, "end": y} for x, y, k in s]), [kind, kind])


def secret_digests(docs: DataFrame, threshold: float = 1.4) -> DataFrame:
    """doc_id, counts of base findings by kind, SHA-256 of the base spans and all spans as text."""

    def shape(base, spans):
        n = Counter(s[2] for s in base)
        return n["assign"], n["access"], n["hex"], sha256_hex(joined(base).encode()), joined(spans)

    return _scan(docs, threshold, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", shape, [pa.int64()] * 3 + [pa.string()] * 2)


def _scan(docs: DataFrame, threshold: float, schema: str, shape, kinds) -> DataFrame:
    names = ["doc_id"] + [c.split(" ")[0] for c in re.findall(r", (\w+ (?:array|long|string))", re.sub(r"<.*?>>", "", schema))]

    def make():
        nothing = shape([], [])

        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column("text")
            worth = pc.match_substring_regex(column, _WORTH)
            flagged = pc.or_(pc.or_(worth, pc.match_substring(column, "AKIA")), pc.match_substring_regex(column, "[0-9a-f]{16}"))
            out = [nothing] * len(column)
            for i in pc.indices_nonzero(flagged).to_pylist():
                out[i] = shape(*scan(column[i].as_py(), worth[i].as_py(), threshold))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(zip(*out), kinds))], names)

        return f

    return map_arrow(texts(docs), make, schema)

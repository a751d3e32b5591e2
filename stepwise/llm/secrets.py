"""Secret scan by assignment-aware lexing (operator 2).

Two layers of spans per text (code points, end exclusive):

* base spans, by pattern: ``assign`` (a sensitive word, ``:`` or ``=``, a
  value), ``access`` (access key ids) and ``hex`` (long lowercase hex runs);
* what reading the text as source or configuration adds: the lexer turns
  assignments (``name = expr``, ``"name": expr``, ``name: value``, ``name :=
  expr``, ``name => expr``, ``name: type = expr``, ``name type = expr``) into
  name-literal pairs. An expression is a chain of literals, names and bare
  values joined by ``+``, ``.`` or ``..``; its first literal may stand on the
  line after the sign or in parentheses; constants
  are propagated in reading order, through names, ``$NAME`` and ``${NAME}``,
  so a literal is also scored under every name it reaches (a constant is walked
  again only for a more sensitive name or a stronger whole). Its score is the
  sensitivity of the target name times the strength of the value; a literal
  that scores enough is a span: ``literal`` where it stands in the assignment
  itself, ``flow`` where it reached the name through a constant.

Only text around ``=`` and ``:`` is lexed, so prose costs one search. Each row
is handled alone; memory is that of one Arrow batch of texts.

Defined results: a null or empty text has no spans; repeated rows each get
their row; an empty table gives no rows; other columns are kept by
``find_secrets``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from string import punctuation

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans of one start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal", "flow")
#: A literal with at least this score (0 to 1) is a span.
MIN_SCORE = 0.35

SPANS = "array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>"

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ of 24 and more
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
_CUES = ("password", "passwd", "secret", "token", "api")

# Sensitivity of a target name: single words, and pairs of neighbouring words.
WORDS = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.8, "credentials": 0.8, "bearer": 0.8, "jwt": 0.8, "auth": 0.6, "private": 0.5, "pass": 0.6, "dsn": 0.5,
}
PAIRS = {
    ("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("signing", "key"): 0.9,
    ("encryption", "key"): 0.9, ("account", "key"): 0.8, ("connection", "string"): 0.6, ("session", "id"): 0.4,
}
#: Whole values, but for punctuation around them, that stand for a secret without being one.
PLACEHOLDERS = re.compile(
    r"(?i)change.?me|example|placeholder|dummy|sample|todo|none|null|undefined|true|false|x{4,}|test(?:ing)?|(?:your|insert|enter)[-_ .].*"
)
_TEMPLATE = re.compile(r"<[^<>]*>|\{\{?[^{}]*\}?\}|%\(?\w*\)?")
#: The password of an address with credentials.
_CREDENTIALS = re.compile(r"[A-Za-z][\w+.-]*://[^/\s:@]*:([^/\s@]+)@")
PUNCTUATION = punctuation + " \t"
_URL = re.compile(r"[A-Za-z][\w+.-]*://")
_PATH = re.compile(r"(?:/[\w.@~-]+)+/?")
#: Words of a passphrase, at least; it has a digit and doesn't end as a sentence does.
PASSPHRASE_WORDS = 4
#: The joint strength of a value's pieces counts in so many steps, so that a
#: constant is walked again only when what it is part of got a step stronger.
STEPS = 20

_NAMED = r"""(["'`]?)([A-Za-z_$][\w.$-]*)\1\]?(?:\[\d*\])*"""
_HEAD = re.compile(rf"""(?<![\w.$-]){_NAMED}[ \t]*(?:=>|:=|=(?![=>])|:(?![:/]))[ \t]*""")
# A type: a dotted name with what stands before and after it, or several joined by "|".
_ONE_TYPE = r"""(?:&(?:'\w+[ \t]+)?(?:mut[ \t]+)?|\*|\[\w*\])*+[A-Za-z_]\w*+(?:(?:\.|::)\w++)*+(?:<[^<>=\n]*+(?:<[^<>=\n]*+>[^<>=\n]*+)*+>|\[[^\[\]=\n]*+(?:\[[^\[\]=\n]*+\][^\[\]=\n]*+)*+\]|\(\w*\)|[?!*&])*+"""
_TYPE = rf"{_ONE_TYPE}(?:[ \t]*\|[ \t]*{_ONE_TYPE})*+"
#: ``: type =`` behind a name and its colon.
_TYPED = re.compile(rf"({_TYPE})[ \t]*=(?![=>])[ \t]*")
_BASIC = r"(?:string|str|bytes?|rune|text|n?(?:var)?char2?)\b"
#: ``name type =``, by a keyword before it or a basic type; either may be the name (``const string name =``).
_DECLARED = re.compile(
    rf"""(?<![\w.$-])(?:(?:var|const|let|val)[ \t]+([A-Za-z_$][\w$]*)[ \t]+({_ONE_TYPE})"""
    rf"""|([A-Za-z_$][\w$]*)[ \t]+((?:\[\w*\]|\*)*+{_BASIC}(?:\(\w*\))?))[ \t]*=(?![=>])[ \t]*""",
)
# What may stand between the sign and a quoted literal, and between quoted literals in parentheses.
_OPEN = re.compile(r"(?:\s|\\\n|\()*+")
_KEY_SIGN = re.compile(r"\]?[ \t]*(?::|=)")
_JOIN_INSIDE = re.compile(r"\s*(?:(?:\+|\.\.?|&)\s*(?=[\"'`A-Za-z_$])|(?=[A-Za-z]{0,2}[\"'`]))")
_QUOTED = re.compile(r'''[A-Za-z]{0,2}("""|\'\'\'|"|'|`)''')
_BARE = re.compile(r"""(?:\$\{[^}\s]*\}|[^\s,;#"'`(){}\[\]<>+])+""")
_NAME = re.compile(r"[A-Za-z_$][\w.$]*\Z")
_REF = re.compile(r"\$\{?([A-Za-z_][\w.]*)\}?")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.?|&)[ \t]*(?=[\"'`A-Za-z_$])")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

# A piece of a value: where its literal stands, and the text.
Piece = tuple[int, int, str]


class Value:
    """A value as it is written: its own pieces, and the constants it uses."""

    __slots__ = ("pieces", "constants", "_letters", "credit")

    def __init__(self, pieces: list[Piece], constants: list["Value"]):
        self.pieces = pieces
        self.constants = list({id(c): c for c in constants}.values())
        self._letters: Counter | None = None
        #: Best (weight, weight x joint strength) that its pieces were given.
        self.credit = (0.0, 0.0)

    def __bool__(self) -> bool:
        return bool(self.pieces or self.constants)

    def letters(self) -> Counter:
        """How often its characters occur, those of its constants included;
        counted once per constant, from the counts of what it is made of."""
        stack = [self]
        while stack:
            top = stack[-1]
            missing = [c for c in top.constants if c._letters is None]
            if top._letters is None and missing:
                stack += missing
                continue
            stack.pop()
            if top._letters is None:
                top._letters = Counter()
                for _, _, text in top.pieces:
                    top._letters.update(text)
                for c in top.constants:
                    top._letters.update(c._letters)
        return self._letters


def name_score(name: str) -> float:
    """How sensitive a target name is, 0 to 1."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    single = max((WORDS.get(p, WORDS.get(p.rstrip("s"), 0.0)) for p in parts), default=0.0)
    pair = max((PAIRS.get(p, 0.0) for p in zip(parts, parts[1:])), default=0.0)
    return max(single, pair)


def is_placeholder(value: str) -> bool:
    core = value.strip(PUNCTUATION)
    return not core or bool(PLACEHOLDERS.fullmatch(core) or _TEMPLATE.fullmatch(value))


def strength(letters: Counter) -> float:
    """Length, entropy and mixture of characters, 0 to 1."""
    n = sum(letters.values())
    entropy = -sum(c / n * math.log2(c / n) for c in letters.values()) if n else 0.0
    kinds = {0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in letters}
    return min(1.0, n / 16 if n < 16 else 1.0) * min(1.0, entropy / 3) * min(1.0, 0.4 + 0.2 * len(kinds))


def _never(value: str) -> bool:
    """A piece that no neighbours make a secret: a placeholder or an address."""
    return is_placeholder(value) or bool(_URL.match(value))


def _is_path(value: str) -> bool:
    """A path of names; a name that mixes small and capital letters with digits
    is none (base64 may begin with a slash)."""
    if not _PATH.fullmatch(value):
        return False
    mixed = (re.search("[a-z]", n) and re.search("[A-Z]", n) and re.search("[0-9]", n) for n in value.split("/"))
    return not any(mixed)


def value_score(value: str) -> float:
    """How much a value looks like a secret, 0 to 1; nothing for placeholders,
    prose, paths and addresses. Of an address with credentials, its password."""
    if m := _CREDENTIALS.match(value):
        value = m[1]
    elif _URL.match(value) or _is_path(value):
        return 0.0
    if len(value) < 6 or is_placeholder(value):
        return 0.0
    if len(words := value.split()) > 1:
        if len(words) < PASSPHRASE_WORDS or value.rstrip()[-1] in ".?!:;," or not re.search(r"\d", value):
            return 0.0
    return strength(Counter(value))


def _quoted(text: str, at: int) -> tuple[int, int, int] | None:
    """Start and end of the body of a string literal at ``at``, and where it
    ends."""
    if not (m := _QUOTED.match(text, at)):
        return None
    quote, i = m[1], m.end()
    while True:
        end = text.find(quote, i)
        if end < 0 or len(quote) == 1 and quote != "`" and text.find("\n", m.end(), end) >= 0:
            return None
        back = end
        while back > m.end() and text[back - 1] == "\\":
            back -= 1
        if (end - back) % 2 == 0:
            return m.end(), end, end + len(quote)
        i = end + 1


def _refer(text: str, start: int, end: int, known: dict[str, Value], into: Value) -> None:
    """Adds a literal, and the constants that references in it name."""
    value = text[start:end]
    if not _REF.fullmatch(value):
        into.pieces.append((start, end, value))
    into.constants += [known[m[1]] for m in _REF.finditer(value) if m[1] in known]


def _expand(value: Value, enter=lambda constant: True) -> Iterator[tuple[Piece, bool]]:
    """The pieces of a value, and whether each came through a constant; every
    constant that ``enter`` admits is walked once."""
    yield from ((p, False) for p in value.pieces)
    walked = {id(value)}
    stack = [iter(value.constants)]
    while stack:
        constant = next(stack[-1], None)
        if constant is None:
            stack.pop()
        elif id(constant) not in walked:
            walked.add(id(constant))
            if enter(constant):
                yield from ((p, True) for p in constant.pieces)
                stack.append(iter(constant.constants))


def _expression(text: str, i: int, known: dict[str, Value]) -> tuple[Value, int]:
    """The value that is written at ``i``, and where it ends (``i`` if there is none)."""
    pieces, constants = Value([], []), []
    at, join = i, _JOIN
    opened = _OPEN.match(text, i).end()
    if opened > i:
        inside = "(" in text[i:opened]
        body, bare = _quoted(text, opened), _BARE.match(text, opened)
        if body and not _KEY_SIGN.match(text, body[2]) or inside and bare and bare[0] in known:
            i, join = opened, _JOIN_INSIDE if inside else _JOIN
    while True:
        if body := _quoted(text, i):
            _refer(text, body[0], body[1], known, pieces)
            i = body[2]
        elif bare := _BARE.match(text, i):
            word = bare[0]
            if _NAME.match(word) and word in known:
                constants.append(known[word])
            else:
                _refer(text, bare.start(), bare.end(), known, pieces)
            i = bare.end()
        else:
            break
        at = i
        if not (j := join.match(text, i)):
            break
        i = j.end()
    return Value(pieces.pieces, pieces.constants + constants), at


def _assigned(text: str) -> Iterator[tuple[str, Value]]:
    """Name and value of every assignment, in reading order."""
    known: dict[str, Value] = {}
    at = 0
    declared = _DECLARED.search(text)
    while True:
        m = _HEAD.search(text, at)
        while declared and declared.start() < at:
            declared = _DECLARED.search(text, at)
        if not m and not declared:
            return
        found: list[tuple[str, Value]] = []
        if declared and (not m or declared.start() <= m.start()):
            value, at = _expression(text, declared.end(), known)
            for name in (declared[1] or declared[3], (declared[2] or declared[4]).lstrip("&*")):
                found.append((name, value))
        else:
            name, at, value = m[2], m.end(), None
            if text[m.start() : at].rstrip().endswith(":") and (typed := _TYPED.match(text, at)):
                value, end = _expression(text, typed.end(), known)
                if value:
                    if re.search(r"\d", typed[1]):  # may be a value itself
                        found.append((name, Value([(*typed.span(1), typed[1])], [])))
                    at = end
            if not value:
                value, at = _expression(text, at, known)
            found.append((name, value))
        for name, value in found:
            known[name] = known[name.rsplit(".", 1)[-1]] = value
            yield name, value


def assignments(text: str) -> Iterator[tuple[str, list[Piece]]]:
    """Name and pieces of the value of every assignment, in reading order."""
    for name, value in _assigned(text):
        yield name, [p for p, _ in _expand(value)]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    low = text.lower()
    if any(c in low for c in _CUES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def spans(text: str | None) -> list[tuple[str, int, int, str | None, float | None]]:
    """All spans of one text, by start, then kind."""
    if not text:
        return []
    found: dict[tuple[str, int, int], tuple[str | None, float | None]] = {s: (None, None) for s in base_spans(text)}
    if "=" in text or ":" in text:
        scores: dict[Piece, float] = {}
        for name, value in _assigned(text):
            weight = name_score(name)
            if not weight:
                continue
            # A secret cut in pieces is as strong as its pieces together.
            whole = 0.0
            if value.constants or len(value.pieces) > 1:
                whole = math.floor(STEPS * strength(value.letters())) / STEPS

            def enter(constant: Value) -> bool:
                best, joint = constant.credit
                if weight <= best and weight * whole <= joint:
                    return False  # all it holds has had as much already
                constant.credit = max(weight, best), max(weight * whole, joint)
                return True

            for piece, through in _expand(value, enter):
                start, end, own = piece
                if piece not in scores:
                    scores[piece] = value_score(own)
                score = weight * max(scores[piece], whole if len(own) >= 4 and not _never(own) else 0.0)
                key = ("flow" if through else "literal", start, end)
                if score >= MIN_SCORE and score > (found.get(key, (None, 0.0))[1] or 0.0):
                    found[key] = (name, round(score, 6))
    rank = {k: i for i, k in enumerate(KINDS)}
    return [(*s, *found[s]) for s in sorted(found, key=lambda s: (s[1], rank[s[0]], s[2]))]


def secret_spans(text: Column) -> Column:
    @F.pandas_udf(SPANS)
    def each(texts: pd.Series) -> pd.Series:
        names = ("kind", "start", "end", "name", "score")
        return pd.Series([[dict(zip(names, s)) for s in spans(t)] for t in texts])

    return each(text)


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs(text, ...)`` with ``secrets``: its spans, each with its kind,
    start, end and, for what the lexer found, target name and score."""
    return docs.withColumn("secrets", secret_spans(F.col("text")))


def listed(spans_of: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the spans of these kinds, comma-joined."""
    own = F.filter(spans_of, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans_of: Column, kind: str) -> Column:
    return F.size(F.filter(spans_of, lambda s: s["kind"] == kind)).cast("long")

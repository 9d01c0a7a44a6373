"""Secret scans by assignment-aware lexing.

Texts are read as source and configuration syntax: `name = "literal"`, `"name": "literal"`, `NAME=value`, `name: value`,
`name: Type = "literal"`, `--name value`, `<name>value</name>`, `key="name" value="literal"` and
`scheme://user:value@host` give pairs of a name and an expression. Constants are propagated through an expression's
references, concatenations, interpolations and calls in the order of the text, so that a literal counts under every
name it reaches. A literal is scored by the most sensitive of these names and by how much it looks like a credential.

Three patterns are the base and always reported: keyword assignments, access key ids and long hexadecimal runs.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import DataFrame

from reviewlake.llm.batches import add_to_texts, free_name

#: Kinds in the order that decides between spans of one start; the first three are the base.
KINDS = ("assign", "access", "hex", "literal", "url")

# The base patterns, their least lengths and the group that is measured.
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}+"), 0, 32),
}

# How sensitive a name's words are, alone and as neighbours, and words that say a name holds something else.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "secret": 1.0, "apikey": 1.0, "pwd": 0.9, "token": 0.9, "jwt": 0.9,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "pass": 0.8, "dsn": 0.6, "auth": 0.7, "authorization": 0.8,
    "salt": 0.7, "signature": 0.6, "cookie": 0.6, "webhook": 0.5, "pin": 0.5,
}
SENSITIVE_PAIRS = {
    ("api", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("access", "key"): 1.0, ("encryption", "key"): 1.0,
    ("signing", "key"): 1.0, ("account", "key"): 0.9, ("storage", "key"): 0.9, ("auth", "key"): 1.0, ("master", "key"): 0.9,
    ("service", "key"): 0.9, ("connection", "string"): 0.7, ("client", "secret"): 1.0,
}
ELSEWHERE_LAST = {"name", "id", "count", "length", "size", "limit", "path", "file", "url", "uri", "type", "field", "label", "column",
                  "expires", "expiry", "ttl", "timeout", "hint", "policy", "placeholder", "prompt", "format", "pattern", "header",
                  "index", "endpoint", "prefix", "suffix", "env", "var", "issuer", "algorithm"}
ELSEWHERE_FIRST = {"max", "min", "num", "public", "is", "has", "no", "use", "show", "require", "requires", "reset", "forgot"}
PLACEHOLDER = re.compile(r"change.?me|example|your[-_ ]|placeholder|dummy|redacted|todo|xxxx|\*\*\*|\.\.\.|^<.*>$|^\$\{?\w+\}?$|^%\w+%$|"
                         r"^(null|none|nil|true|false|undefined|required|optional|string|password|secret|token)$", re.I | re.A)

#: A name and the operator that gives it a value. Possessive, and only from a word's start: linear in the text.
PAIR = re.compile(r"""(?<![\w$.-])-{0,2}(?P<name>[A-Za-z_$][\w$.-]*+)(?:\[["'](?P<key>[\w$.-]++)["'])?+["'\]]{0,2}+[ \t]*+"""
                  r"""(?P<op>:=|=>|=(?![=>~])|:(?!:|//))[ \t]*+""", re.A)
FLAG = re.compile(r"(?<![\w-])--(?P<name>[A-Za-z][\w-]*+)[ \t]++(?=[^\s=-])", re.A)
ELEMENT = re.compile(r"<(?P<name>[A-Za-z][\w.:-]*+)>(?P<value>[^<>\n]++)</", re.A)
ATTRIBUTES = re.compile(r"""\b(?:key|name|id)=["'](?P<name>[\w$.:-]++)["']\s++value=["'](?P<value>[^"'\n]++)["']""", re.A | re.I)
URL = re.compile(r"""(?<![\w+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s/:@"'<>]*+:(?P<value>[^\s/@"'<>]++)@""", re.A)

ANNOTATION = re.compile(r"[A-Za-z_][\w.\[\]|?]*+[ \t]*+=(?![=>~])[ \t]*+", re.A)
QUOTED = re.compile(r'''[rbfuRBFU]{0,2}+(?P<q>["'`])(?:(?<=")(?P<d>(?:[^"\\\n]|\\.)*+)"|(?<=')(?P<s>(?:[^'\\\n]|\\.)*+)'|(?<=`)(?P<b>(?:[^`\\\n]|\\.)*+)`)''', re.A)
CALL = re.compile(r"(?:new[ \t]++)?[A-Za-z_$][\w$.]*+\(", re.A)
READER = re.compile(r"(?:getenv|get|getproperty|env|environ)\($", re.I | re.A)
COMMA = re.compile(r"[ \t]*+,[ \t]*+")
BARE = re.compile(r"""[^\s"'`,;{}()\[\]<>|&#]++""")
HOLE = re.compile(r"\$?\{(\w+)\}|\$(\w+)|%(\w+)%", re.A)
JOIN = re.compile(r"[ \t]*+(?:\\?\r?\n[ \t]*+)?(?:\+|\.(?=[ \t]*[\"'$])|\|\||\?\?|or\b)[ \t]*+(?:\\?\r?\n[ \t]*+)?", re.A)
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", re.A)


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.5  # least product of the scores of name and literal
    shortest: int = 6       # code points of a credential
    longest: int = 4096     # values that grow beyond this by propagation are no credentials and go no further


def name_score(name: str) -> float:
    """How likely a value of this name is a secret, by its words and pairs of neighbouring words."""
    words = [word.lower() for word in WORDS.findall(name)]
    if not words:
        return 0.0
    score = max([SENSITIVE.get(word, 0.0) for word in words] + [SENSITIVE_PAIRS.get(pair, 0.0) for pair in zip(words, words[1:])])
    return score - 0.6 if words[-1] in ELSEWHERE_LAST or words[0] in ELSEWHERE_FIRST else score


def literal_score(value: str, settings: Settings = Settings()) -> float:
    """How much a value looks like a credential: length, character entropy, kinds of characters, no placeholder."""
    if not settings.shortest <= len(value) <= settings.longest:
        return 0.0
    if PLACEHOLDER.search(value) or len(set(value)) < 4:
        return 0.1
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    kinds = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    score = 0.35 + 0.4 * min(1.0, entropy / 4) + 0.25 * min(1.0, (kinds - 1) / 2)
    return score / 2 if any(c.isspace() for c in value) else score


@dataclass
class Value:
    """What an expression is known to be: its text and the spans of the literals it is made of."""
    text: str = ""
    spans: tuple[tuple[int, int], ...] = ()
    quoted: bool = False

    def joined(self, other: Value, settings: Settings) -> Value:
        if len(self.text) + len(other.text) > settings.longest:
            return Value()
        return Value(self.text + other.text, tuple(dict.fromkeys(self.spans + other.spans)), self.quoted or other.quoted)


@dataclass
class Lexer:
    """One pass over a text; constants are those of the assignments read so far."""
    text: str
    settings: Settings = Settings()
    constants: dict[str, Value] = field(default_factory=dict)
    unclosed: set[str] = field(default_factory=set)

    def known(self, name: str) -> Value | None:
        return self.constants.get(name) or self.constants.get(name.rpartition(".")[2])

    def filled(self, value: str, start: int, end: int, quoted: bool) -> Value:
        """A literal with the constants put into its holes."""
        spans, at, text = [(start, end)], 0, []
        if "{" in value or "$" in value or "%" in value:
            for hole in HOLE.finditer(value):
                constant = self.known(hole[1] or hole[2] or hole[3])
                if constant is not None:
                    text += [value[at:hole.start()], constant.text]
                    spans += constant.spans
                    at = hole.end()
        whole = "".join(text) + value[at:]
        return Value(whole, tuple(dict.fromkeys(spans)), quoted) if len(whole) <= self.settings.longest else Value()

    def term(self, at: int) -> tuple[Value, int] | None:
        """A literal, a call's literals, a known constant or a bare value at a place, and where it ends."""
        text = self.text
        for triple in ('"""', "'''"):
            if text.startswith(triple, at) and triple not in self.unclosed:
                end = text.find(triple, at + 3)
                if end >= 0:
                    return self.filled(text[at + 3:end], at + 3, end, True), end + 3
                self.unclosed.add(triple)
        if found := QUOTED.match(text, at):
            inner = next(name for name in "dsb" if found[name] is not None)
            return self.filled(found[inner], *found.span(inner), True), found.end()
        if call := CALL.match(text, at):
            return self.call(call)
        if found := BARE.match(text, at):
            if (constant := self.known(found[0].lstrip("$"))) is not None:
                return constant, found.end()
            return self.filled(found[0], *found.span(), False), found.end()
        return None

    def call(self, opening: re.Match) -> tuple[Value, int]:
        """The literals and constants among a call's arguments; the first one of a lookup is a name."""
        at, value, first = opening.end(), Value(), bool(READER.search(opening[0]))
        while True:
            found = QUOTED.match(self.text, at)
            if found:
                inner = next(name for name in "dsb" if found[name] is not None)
                one, at = self.filled(found[inner], *found.span(inner), True), found.end()
            elif found := BARE.match(self.text, at):
                one, at = self.known(found[0]) or Value(), found.end()
            else:
                return value, at
            value = value if first else value.joined(one, self.settings)
            first = False
            comma = COMMA.match(self.text, at)
            if not comma:
                return value, at
            at = comma.end()

    def expression(self, at: int) -> tuple[Value, int]:
        """Terms that are concatenated or alternatives of one another."""
        found = self.term(at)
        if found is None:
            return Value(), at
        value, at = found
        while joint := JOIN.match(self.text, at):
            more = self.term(joint.end())
            if more is None:
                break
            value, at = value.joined(more[0], self.settings), more[1]
        return value, at

    def pairs(self):
        """(name, value) in the order of the text."""
        at = 0
        while found := PAIR.search(self.text, at):
            start = found.end()
            if found["op"] == ":" and (typed := ANNOTATION.match(self.text, start)):
                start = typed.end()
            value, at = self.expression(start)
            at = max(at, found.end())
            if value.spans:
                name = found["key"] or found["name"]
                self.constants[name] = value
                self.constants[name.rpartition(".")[2]] = value
                alone = found["op"] == "=" and found.end("name") == found.start("op") and found.end() == found.end("op") == start
                yield name, value, value.quoted or alone
            else:
                self.constants.pop(found["name"], None)  # it holds something unknown from here on


def find_literals(text: str, settings: Settings = Settings()) -> list[tuple[str, int, int, str, float]]:
    """(kind, start, end, name, score) of the literals that reach a sensitive name, each under its best one."""
    best: dict[tuple[str, int, int], tuple[float, str]] = {}

    def judge(kind: str, name: str, value: Value, sensitive: float, sure: bool) -> None:
        if sensitive <= 0:
            return
        score = sensitive * literal_score(value.text, settings)
        digit = any(c.isdigit() for c in value.text) and any(c.isalpha() for c in value.text)
        if score >= settings.threshold and (sure or digit):
            for start, end in value.spans:
                if start < end and best.get((kind, start, end), (0.0, ""))[0] < score:
                    best[kind, start, end] = (score, name)

    def plain(kind: str, found: re.Match, name: str, sensitive: float) -> None:
        judge(kind, name, Value(found["value"], (found.span("value"),)), sensitive, True)

    lexer = Lexer(text, settings)
    if "=" in text or ":" in text:
        for name, value, sure in lexer.pairs():
            judge("literal", name, value, name_score(name), sure)
    if "--" in text:
        for found in FLAG.finditer(text):
            if (term := lexer.term(found.end())) is not None:
                judge("literal", found["name"], term[0], name_score(found["name"]), term[0].quoted)
    if "://" in text:
        for found in URL.finditer(text):
            plain("url", found, "userinfo", 0.95)
    if "value" in text.lower():
        for found in ATTRIBUTES.finditer(text):
            plain("literal", found, found["name"], name_score(found["name"]))
    if "</" in text:
        for found in ELEMENT.finditer(text):
            plain("literal", found, found["name"], name_score(found["name"]))
    return [(kind, start, end, name, score) for (kind, start, end), (score, name) in best.items()]


def find_base(text: str) -> list[tuple[str, int, int, str | None, float | None]]:
    """Spans of the base patterns, leftmost and not overlapping for each kind; matches that are too short are dropped."""
    found = []
    for kind, (pattern, group, least) in BASE.items():
        found += [(kind, *match.span(), match[1].lower() if kind == "assign" else None, None)
                  for match in pattern.finditer(text) if len(match[group]) >= least]
    return found


def find_secrets(text: str | None, settings: Settings = Settings()) -> list[tuple[str, int, int, str | None, float | None]]:
    """All spans by start, kind and end: the base's, and literals that no span of the base covers."""
    text = text or ""
    base = sorted(find_base(text), key=lambda one: one[1])
    starts, ends = [one[1] for one in base], list(accumulate((one[2] for one in base), max))

    def covered(start: int, end: int) -> bool:
        before = bisect_right(starts, start)
        return before > 0 and ends[before - 1] >= end

    found = base + [one for one in find_literals(text, settings) if not covered(one[1], one[2])]
    return sorted(found, key=lambda one: (one[1], KINDS.index(one[0]), one[2]))


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None, settings: Settings = Settings()) -> DataFrame:
    """The `keep` columns (default: all) with `secrets`: an array of (kind, start, end, name, score) of each whole text.

    Places are code points, end exclusive. Base spans have no score, and a name only for assignments. Null and empty
    texts have none. Row for row, without shuffle; a column `secrets` of the input is replaced.
    """
    return add_to_texts(df, text, "secrets array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>",
                        lambda texts: ([[dict(zip(("kind", "start", "end", "name", "score"), one)) for one in find_secrets(value, settings)]
                                        for value in texts],), keep)


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]", settings: Settings = Settings()) -> DataFrame:
    """The input with each run of overlapping spans in `text` replaced by `mark`; null texts stay null."""
    def cut(value: str | None) -> str | None:
        pieces, at, last = [], 0, -1
        for _, start, end, _, _ in find_secrets(value, settings):
            if start > last:
                pieces += [value[at:start], mark]
            last = at = max(last, end)
        return value if not pieces else "".join(pieces) + value[at:]

    new = free_name(df)
    made = add_to_texts(df, text, f"{new} string", lambda texts: ([cut(value) for value in texts],))
    return made.select(*[made[new].alias(name) if name == text else made[name] for name in df.columns])

"""Chat formatting: a small template language, compiled to closures.

A template is text with ``{{ expression }}`` and ``{% statement %}``. Statements: ``for NAME in
expression`` / ``endfor``, ``if`` / ``elif`` / ``else`` / ``endif``, ``generation`` / ``endgeneration``
(what a model is to learn). Expressions: names, ``a.b`` fields of dictionaries, strings, integers,
``+``, ``==``, ``!=``, ``not``, ``and``, ``or``, parentheses and ``| filter``. Nothing else exists: no
calls, no attributes of objects, no indexing, so a template can't reach the interpreter.

``compile_template`` parses into a syntax tree, folds what is constant and joins neighbouring text, and
turns each node into a closure.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts


class TemplateError(ValueError):
    pass


def escape(text: str) -> str:
    """Text without ``<`` and line ends, so that it can hold no control string; ``unescape`` takes it back."""
    return text.replace("\\", "\\\\").replace("<", "\\l").replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"l": "<", "n": "\n", "\\": "\\"}[m[1]], text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "lower": str.lower, "upper": str.upper}


# --- syntax tree ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Op:
    sign: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    arg: object


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Emit:
    expr: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


TOKEN = re.compile(r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[+|().]))")


class Expression:
    """Recursive descent: or, and, not, comparison, sum, filter, atom."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def all(self):
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def take(self, *texts: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][1] in texts and self.tokens[self.at][0] in ("sign", "name"):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def chain(self, part, *signs):
        node = part()
        while sign := self.take(*signs):
            node = Op(sign, (node, part()))
        return node

    def either(self):
        return self.chain(self.both, "or")

    def both(self):
        return self.chain(self.negated, "and")

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.chain(self.summed, "==", "!=")

    def summed(self):
        return self.chain(self.filtered, "+")

    def filtered(self):
        node = self.atom()
        while self.take("|"):
            kind, name = self.next()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = Filter(name, node)
        return node

    def next(self):
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def atom(self):
        kind, text = self.next()
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1]))
        if kind == "number":
            return Const(int(text))
        if text == "(":
            node = self.either()
            if not self.take(")"):
                raise TemplateError("a parenthesis is open")
            return node
        if kind == "name":
            path = [text]
            while self.take("."):
                kind, text = self.next()
                if kind != "name" or text.startswith("_"):
                    raise TemplateError(f"no field {text!r}")
                path.append(text)
            return Name(tuple(path))
        raise TemplateError(f"unexpected {text!r}")


def parse(template: str) -> tuple:
    """The syntax tree of a template."""
    pieces = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", template, flags=re.DOTALL)
    at = 0

    def body(*ends: str):
        nonlocal at
        nodes = []
        while at < len(pieces):
            piece = pieces[at]
            at += 1
            if piece.startswith("{{"):
                nodes.append(Emit(Expression(piece[2:-2]).all()))
            elif piece.startswith("{%"):
                word, _, rest = piece[2:-2].strip().partition(" ")
                if word in ends:
                    return tuple(nodes), word, rest
                nodes.append(statement(word, rest))
            elif piece:
                nodes.append(Text(piece))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(nodes), "", ""

    def branch(test: str):
        then, word, rest = body("elif", "else", "endif")
        other = (branch(rest),) if word == "elif" else body("endif")[0] if word == "else" else ()
        return If(Expression(test).all(), then, other)

    def statement(word: str, rest: str):
        if word == "for" and (m := re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest.strip(), re.DOTALL)):
            return For(m[1], Expression(m[2]).all(), body("endfor")[0])
        if word == "if":
            return branch(rest)
        if word == "generation":
            return Generation(body("endgeneration")[0])
        raise TemplateError(f"no statement {word!r}")

    return body()[0]


# --- constant folding -------------------------------------------------------------------------------

OPS = {"+": lambda a, b: a + b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "and": lambda a, b: a and b, "or": lambda a, b: a or b,
       "not": lambda a: not a}


def folded(node):
    """An expression with its constant parts computed."""
    if isinstance(node, Op):
        args = tuple(map(folded, node.args))
        if all(isinstance(a, Const) for a in args):
            return Const(OPS[node.sign](*[a.value for a in args]))
        if node.sign in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.sign == "and") else args[0]
        return Op(node.sign, args)
    if isinstance(node, Filter):
        arg = folded(node.arg)
        return Const(FILTERS[node.name](str(arg.value))) if isinstance(arg, Const) else Filter(node.name, arg)
    return node


def folded_body(nodes: tuple) -> tuple:
    """Statements with constant expressions as text, decided branches in place, neighbouring text joined."""
    out: list = []
    for node in nodes:
        if isinstance(node, Emit):
            expr = folded(node.expr)
            new = (Text(str(expr.value)),) if isinstance(expr, Const) else (Emit(expr),)
        elif isinstance(node, If):
            test, then, other = folded(node.test), folded_body(node.then), folded_body(node.other)
            new = (then if test.value else other) if isinstance(test, Const) else (If(test, then, other),)
        elif isinstance(node, For):
            new = (For(node.name, folded(node.over), folded_body(node.body)),)
        elif isinstance(node, Generation):
            new = (Generation(folded_body(node.body)),)
        else:
            new = (node,)
        for one in new:
            if isinstance(one, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + one.text)
            elif not (isinstance(one, Text) and not one.text):
                out.append(one)
    return tuple(out)


# --- closures ---------------------------------------------------------------------------------------

class Output:
    """What has been rendered, its length, and the spans to learn."""

    def __init__(self):
        self.parts, self.size, self.spans = [], 0, []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def value_of(node) -> Callable[[Mapping], object]:
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        first, *rest = node.path

        def read(scope):
            value = scope[first]
            for field in rest:
                if not isinstance(value, Mapping):
                    raise TemplateError(f"{field!r} of something without fields")
                value = value[field]
            return value
        return read
    if isinstance(node, Filter):
        inner, apply = value_of(node.arg), FILTERS[node.name]
        return lambda scope: apply(str(inner(scope)))
    args = [value_of(a) for a in node.args]
    if node.sign == "not":
        return lambda scope: not args[0](scope)
    left, right = args
    if node.sign == "and":
        return lambda scope: left(scope) and right(scope)
    if node.sign == "or":
        return lambda scope: left(scope) or right(scope)
    apply = OPS[node.sign]
    return lambda scope: apply(left(scope), right(scope))


def writer(node) -> Callable[[dict, Output], None]:
    if isinstance(node, Text):
        return lambda scope, out, text=node.text: out.add(text)
    if isinstance(node, Emit):
        expr = value_of(node.expr)
        return lambda scope, out: out.add(str(expr(scope)))
    if isinstance(node, If):
        test, then, other = value_of(node.test), sequence(node.then), sequence(node.other)
        return lambda scope, out: (then if test(scope) else other)(scope, out)
    if isinstance(node, For):
        over, body = value_of(node.over), sequence(node.body)

        def loop(scope, out):
            for item in over(scope):
                body({**scope, node.name: item}, out)
        return loop
    body = sequence(node.body)

    def generation(scope, out):
        start = out.size
        body(scope, out)
        out.spans.append((start, out.size))
    return generation


def sequence(nodes: tuple) -> Callable[[dict, Output], None]:
    steps = [writer(n) for n in nodes]

    def run(scope, out):
        for step in steps:
            step(scope, out)
    return run


def compile_template(template: str) -> Callable[[Mapping], tuple[str, list[tuple[int, int]]]]:
    """A function from variables to the text and the spans inside ``generation``."""
    run = sequence(folded_body(parse(template)))

    def render(scope):
        out = Output()
        run(dict(scope), out)
        return "".join(out.parts), out.spans
    return render


# --- conversations ----------------------------------------------------------------------------------

TEMPLATE = ("{% for turn in turns %}" "{{ '<turn>' }}{{ turn.role | escape }}\n"
            "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}{% else %}{{ turn.text | escape }}{% endif %}"
            "{{ '</turn>' + '\\n' }}{% endfor %}")
TURN = re.compile(r"<turn>([^<\n]*)\n([^<\n]*)</turn>\n")


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a text that ``TEMPLATE`` made."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError("not a formatted conversation")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


SPANS = "array<struct<start:int,stop:int>>"


def format_conversations(rows: DataFrame, template: str = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, spans): one row for each conversation, its rows by turn.

    ``spans`` are the code point ranges to learn. Null roles and texts are empty; null turns come first;
    rows of one turn are in order of role and text, repeated rows stay; rows with a null conv_id are one
    conversation. A conversation is one record, so it must fit into a task. Other columns are not read.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    grouped = rows.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    kind = grouped.schema["conv_id"].dataType.simpleString()

    def work():
        render = compile_template(template)

        def step(batch):
            done = [render({"turns": turns}) for turns in batch.column(1).to_pylist()]
            return {"conv_id": batch.column(0), "formatted": [text for text, _ in done],
                    "spans": [[{"start": a, "stop": b} for a, b in spans] for _, spans in done]}
        return step

    return map_texts(grouped, f"conv_id {kind}, formatted string, spans {SPANS}", work)


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the formatted texts."""
    from hashlib import sha256

    def work():
        def step(batch):
            out = {name: [] for name in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_back(text)
                learned = "".join(unescape(text[s["start"]: s["stop"]]) for s in spans)
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode()).hexdigest())
                out["loss_chars"].append(len(learned))
                out["loss_sha256"].append(sha256(learned.encode()).hexdigest())
                out["formatted_chars"].append(len(text))
            return {"conv_id": batch.column(0), **out}
        return step

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return map_texts(formatted.select("conv_id", "formatted", "spans"),
                     f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long", work)

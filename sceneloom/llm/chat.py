"""Chat formatting: a small sandboxed template language, compiled to Python closures.

    {{ expr }}  {% for x in messages %}..{% endfor %}  {% if a %}..{% elif b %}..{% else %}..{% endif %}
    {% set x = expr %}  {% generation %}..{% endgeneration %}  {# comment #}  {% for x in messages if test %}

Expressions: text and number literals, true, false, none, names, `a.b`, `a['b']`, `a[0]`, `a[-1]`, `a[1:]`, `+ - % ~ == !=
< <= > >= in not in and or`, `a if b else c`, `is defined` (none, string, not ..), the filters of FILTERS, `|default(x)`, and
raise_exception(text). There are no other calls, no attributes of Python objects, no unbounded loops: a template reads
mappings that it is given and nothing else. What it makes is bounded, too: each turn of an outermost loop may make texts
of BUDGET_CHARS code points and BUDGET_RATIO times the turn's own, and take BUDGET_STEPS statements. Whatever goes wrong, on
compiling or on rendering, is a TemplateError.

A template that goes through `messages` once, in an outermost loop, has its turns streamed: no conversation has to fit
into memory. One that looks at `messages` in another way too (`messages[0]`, `messages|length`, a second loop) gets
them as a list, of WHOLE_CHARS code points at most; a longer conversation is then an error. A message has `role`, `text`
(also as `content`) and `turn`.

Rows of a conversation are taken by turn (nulls first, ties by role and text). Null roles and texts
count as empty. Rows with a null conv_id make one conversation with a null id. Repeated rows are
repeated turns. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TemplateError(ValueError):
    """The template is not well formed or asks for something that the sandbox lacks."""


# --- control strings -------------------------------------------------------------------------


def guard(text: str) -> str:
    """Control strings `<|...|>` can't occur in the result; unguard() undoes it."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def guard_line(text: str) -> str:
    return guard(text).replace("\n", "\\n")


def unguard(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


def _length(x) -> int:
    if not isinstance(x, (str, list, dict)):
        raise TemplateError("only texts, lists and mappings have a length")
    return len(x)


#: What a turn of an outermost loop, or the statements around it, may make: code points, as many times the turn's own, and statements.
BUDGET_CHARS, BUDGET_RATIO, BUDGET_STEPS = 1_000_000, 64, 1_000_000
#: The budget's place among a template's values; no name can be spelt so.
BUDGET = "\0budget"


class Budget:
    """What may still be made and done."""

    def __init__(self):
        self.refill(0)

    def refill(self, own: int) -> None:
        self.chars, self.steps = BUDGET_CHARS + BUDGET_RATIO * own, BUDGET_STEPS

    def spend(self, value):
        if isinstance(value, (str, list)):
            self.chars -= len(value)
            if self.chars < 0:
                raise TemplateError("the template makes too much text")
        return value

    def step(self) -> None:
        self.steps -= 1
        if self.steps < 0:
            raise TemplateError("the template takes too many steps")


def _spent(env: dict, value):
    """The value, on the account of the rendering; constants that are folded have none."""
    budget = env.get(BUDGET)
    return budget.spend(value) if budget else value


FILTERS: dict[str, Callable] = {
    "guard": guard,
    "guard_line": guard_line,
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": _length,
    "string": lambda x: "" if x is None else str(x),
}

# --- syntax tree -----------------------------------------------------------------------------
# Expressions: ("const", v) ("name", n) ("get", e, e) ("slice", e, e, e) ("filter", name, e) ("default", e, e) ("is", test, e)
#   ("cond", test, e, e) ("raise", e) ("not", e) (op, e, e)
# Statements: ("out", e) ("for", name, e, body, test) ("if", [(e, body)..]) ("set", name, e) ("gen", body)

_PIECES = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<num>\d+)|(?P<str>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+%~<>|.:\[\]()=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_LITERALS = {"true": True, "false": False, "none": None}
_COMPARE: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
}


def _plus(a, b):
    if isinstance(a, str) != isinstance(b, str):
        raise TemplateError("+ needs two texts or two numbers")
    return a + b


def _number(f: Callable) -> Callable:
    def run(a, b):
        if not isinstance(a, int) or not isinstance(b, int):
            raise TemplateError("- and % need two numbers")
        if f is _rest and b == 0:
            raise TemplateError("% by 0")
        return f(a, b)

    return run


def _rest(a: int, b: int) -> int:
    return a % b


#: What `is` may ask for, beside `defined`.
TESTS: dict[str, Callable] = {"none": lambda x: x is None, "string": lambda x: isinstance(x, str), "mapping": lambda x: isinstance(x, dict), "true": lambda x: x is True, "false": lambda x: x is False}

_BINARY = _COMPARE | {"+": _plus, "-": _number(lambda a, b: a - b), "%": _number(_rest), "~": lambda a, b: f"{'' if a is None else a}{'' if b is None else b}"}


class _Expression:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"can't read {text[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, ahead: int = 0) -> str | None:
        i = self.at + ahead
        return self.tokens[i][1] if i < len(self.tokens) and self.tokens[i][0] != "str" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, what: str) -> None:
        if not self.take(what):
            raise TemplateError(f"{what!r} expected")

    def whole(self) -> tuple:
        out = self.chosen()
        self.end()
        return out

    def listed(self) -> tuple[tuple, tuple | None]:
        """What a loop goes through, and its test."""
        many = self.either()
        test = self.either() if self.take("if") else None
        self.end()
        return many, test

    def chosen(self) -> tuple:
        value = self.either()
        if not self.take("if"):
            return value
        test = self.either()
        return ("cond", test, value, self.chosen() if self.take("else") else ("const", None))

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def either(self) -> tuple:
        left = self.both()
        while self.take("or"):
            left = ("or", left, self.both())
        return left

    def both(self) -> tuple:
        left = self.negated()
        while self.take("and"):
            left = ("and", left, self.negated())
        return left

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        left = self.added()
        while True:
            if self.peek() == "not" and self.peek(1) == "in":
                self.at += 2
                left = ("not", ("in", left, self.added()))
            elif self.take("is"):
                no = self.take("not")
                test = self.peek()
                if test != "defined" and test not in TESTS:
                    raise TemplateError(f"no test {test!r}")
                self.at += 1
                left = ("not", ("is", test, left)) if no else ("is", test, left)
            elif op := self.take(*_COMPARE):
                left = (op, left, self.added())
            else:
                return left

    def added(self) -> tuple:
        left = self.remainder()
        while op := self.take("+", "-", "~"):
            left = (op, left, self.remainder())
        return left

    def remainder(self) -> tuple:
        left = self.postfix()
        while self.take("%"):
            left = ("%", left, self.postfix())
        return left

    def postfix(self) -> tuple:
        left = self.primary()
        while op := self.take(".", "[", "|"):
            if op == "[":
                first = ("const", None) if self.peek() == ":" else self.either()
                if self.take(":"):
                    left = ("slice", left, first, ("const", None) if self.peek() == "]" else self.either())
                else:
                    left = ("get", left, first)
                self.need("]")
                continue
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name.startswith("_"):
                raise TemplateError("a plain name expected")
            self.at += 1
            if op == "|" and name == "default":
                self.need("(")
                left = ("default", left, self.chosen())
                self.need(")")
                continue
            if op == "|" and name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            left = ("get", left, ("const", name)) if op == "." else ("filter", name, left)
        return left

    def primary(self) -> tuple:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "num":
            return ("const", int(text))
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "name" and text == "raise_exception":
            self.need("(")
            said = self.chosen()
            self.need(")")
            return ("raise", said)
        if kind == "name":
            return ("const", _LITERALS[text]) if text in _LITERALS else ("name", text)
        if text == "-" and self.at < len(self.tokens) and self.tokens[self.at][0] == "num":
            self.at += 1
            return ("const", -int(self.tokens[self.at - 1][1]))
        if text == "(":
            out = self.chosen()
            self.need(")")
            return out
        raise TemplateError(f"unexpected {text!r}")


def parse(template: str) -> list[tuple]:
    """The syntax tree of a template: a list of statements."""
    pieces = _PIECES.split(template)
    for i, p in enumerate(pieces):
        if i % 2 and p[2:3] == "-":
            pieces[i - 1] = pieces[i - 1].rstrip()
        if i % 2 and p[-3:-2] == "-":
            pieces[i + 1] = pieces[i + 1].lstrip()
    queue = [("text", p) if i % 2 == 0 else ("tag", p) for i, p in enumerate(pieces) if p and not p.startswith("{#")]
    out, rest = _body(queue, 0, ())
    if rest < len(queue):
        raise TemplateError(f"unexpected {queue[rest][1]}")
    return out


def _inner(tag: str) -> str:
    return tag[2:-2].strip("-").strip()


def _body(queue: list, at: int, ends: tuple[str, ...]) -> tuple[list, int]:
    out: list[tuple] = []
    while at < len(queue):
        kind, text = queue[at]
        if kind == "text":
            out.append(("out", ("const", text)))
        elif text.startswith("{{"):
            out.append(("out", _Expression(_inner(text)).whole()))
        else:
            word, _, rest = _inner(text).partition(" ")
            if word in ends:
                return out, at
            if word == "for":
                m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"can't read {text}")
                body, at = _body(queue, at + 1, ("endfor",))
                _closed(queue, at, "endfor")
                out.append(("for", m[1], *(listed := _Expression(m[2]).listed())[:1], body, listed[1]))
            elif word == "if":
                arms = []
                while True:
                    test = _Expression(rest).whole() if word != "else" else ("const", True)
                    body, at = _body(queue, at + 1, ("elif", "else", "endif") if word != "else" else ("endif",))
                    _closed(queue, at, "endif")
                    arms.append((test, body))
                    word, _, rest = _inner(queue[at][1]).partition(" ")
                    if word == "endif":
                        break
                out.append(("if", arms))
            elif word == "set":
                name, eq, value = rest.partition("=")
                if not eq or not name.strip().isidentifier():
                    raise TemplateError(f"can't read {text}")
                out.append(("set", name.strip(), _Expression(value).whole()))
            elif word == "generation":
                body, at = _body(queue, at + 1, ("endgeneration",))
                _closed(queue, at, "endgeneration")
                out.append(("gen", body))
            else:
                raise TemplateError(f"unexpected {text}")
        at += 1
    return out, at


def _closed(queue: list, at: int, end: str) -> None:
    if at >= len(queue):
        raise TemplateError(f"{end} is missing")


def fold(node):
    """The same tree with constant expressions worked out, dead arms gone and neighbouring texts joined."""
    if isinstance(node, list):
        out: list[tuple] = []
        for x in map(fold, node):
            if x[0] == "splice":
                new = x[1]
            else:
                new = [x]
            for y in new:
                if y == ("out", ("const", "")):
                    continue
                if y[0] == "out" and y[1][0] == "const" and out and out[-1][0] == "out" and out[-1][1][0] == "const":
                    out[-1] = ("out", ("const", _text(out[-1][1][1]) + _text(y[1][1])))
                else:
                    out.append(y)
        return out
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind in ("out",):
        return ("out", fold(node[1]))
    if kind == "for":
        return ("for", node[1], fold(node[2]), fold(node[3]), node[4] and fold(node[4]))
    if kind == "set":
        return ("set", node[1], fold(node[2]))
    if kind == "gen":
        return ("gen", fold(node[1]))
    if kind == "if":
        arms = []
        for test, body in node[1]:
            test = fold(test)
            if test[0] == "const":
                if not test[1]:
                    continue
                if not arms:
                    return ("splice", fold(body))
                arms.append((("const", True), fold(body)))
                break
            arms.append((test, fold(body)))
        return ("if", arms) if arms else ("splice", [])
    if kind == "filter":
        inner = fold(node[2])
        return ("const", FILTERS[node[1]](inner[1])) if inner[0] == "const" else ("filter", node[1], inner)
    if kind == "is":
        inner = fold(node[2])
        return ("const", node[1] == "defined" or TESTS[node[1]](inner[1])) if inner[0] == "const" else ("is", node[1], inner)
    if kind == "cond" and (test := fold(node[1]))[0] == "const":
        return fold(node[2] if test[1] else node[3])
    parts = [fold(x) for x in node[1:]]
    if all(x[0] == "const" for x in parts) and kind not in ("get", "slice", "raise"):
        return ("const", _expression((kind, *parts))({}))
    return (kind, *parts)


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# --- closures --------------------------------------------------------------------------------
#: What a renderer yields beside texts: generation begins, generation ends, a loop's turn is over.
GEN_ON, GEN_OFF, CUT = object(), object(), object()


def _expression(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]

        def lookup(env):
            if name not in env:
                raise TemplateError(f"no value {name!r}")
            return env[name]

        return lookup
    if kind == "get":
        whole, key = _expression(node[1]), _expression(node[2])

        def get(env):
            at, k = whole(env), key(env)
            if isinstance(at, dict):
                return at.get(k)
            if isinstance(at, (list, str)) and isinstance(k, int):
                if not -len(at) <= k < len(at):
                    raise TemplateError(f"no part {k} of {len(at)}")
                return at[k]
            raise TemplateError("only mappings, lists and texts have parts")

        return get
    if kind == "slice":
        whole, first, last = map(_expression, node[1:])

        def part(env):
            at, a, b = whole(env), first(env), last(env)
            if not isinstance(at, (list, str)) or not all(x is None or isinstance(x, int) for x in (a, b)):
                raise TemplateError("only lists and texts have stretches, by numbers")
            return _spent(env, at[a:b])

        return part
    if kind == "filter":
        f, inner = FILTERS[node[1]], _expression(node[2])
        return lambda env: _spent(env, f(inner(env)))
    if kind in ("is", "default"):
        asked = node[2] if kind == "is" else node[1]
        value, there = _expression(asked), _defined(asked)
        if kind == "default":
            other = _expression(node[2])
            return lambda env: value(env) if there(env) else other(env)
        if node[1] == "defined":
            return there
        test = TESTS[node[1]]
        return lambda env: test(value(env))
    if kind == "cond":
        test, a, b = map(_expression, node[1:])
        return lambda env: a(env) if test(env) else b(env)
    if kind == "raise":
        said = _expression(node[1])

        def fail(env):
            raise TemplateError(_text(said(env)))

        return fail
    if kind == "not":
        inner = _expression(node[1])
        return lambda env: not inner(env)
    a, b = _expression(node[1]), _expression(node[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    op = _BINARY[kind]
    if kind in ("+", "~"):
        return lambda env: _spent(env, op(a(env), b(env)))
    return lambda env: op(a(env), b(env))


def _defined(node: tuple) -> Callable[[dict], bool]:
    """Whether a name has a value, or a mapping or list the part that is asked for."""
    if node[0] == "name":
        return lambda env: node[1] in env
    if node[0] == "get":
        whole, key, there = _expression(node[1]), _expression(node[2]), _defined(node[1])

        def has(env):
            if not there(env):
                return False
            at, k = whole(env), key(env)
            return k in at if isinstance(at, dict) else isinstance(at, (list, str)) and isinstance(k, int) and -len(at) <= k < len(at)

        return has
    return lambda env: True


def _statements(nodes: list[tuple], depth: int = 0) -> Callable[[dict], Iterator]:
    steps = [_statement(n, depth) for n in nodes]

    def run(env):
        budget = env.get(BUDGET)
        for step in steps:
            if budget:
                budget.step()
            yield from step(env)

    return run


def _statement(node: tuple, depth: int) -> Callable[[dict], Iterator]:
    kind = node[0]
    if kind == "out":
        value = _expression(node[1])

        def out(env):
            yield _spent(env, _text(value(env)))

        return out
    if kind == "set":
        name, value = node[1], _expression(node[2])

        def put(env):
            env[name] = value(env)
            return iter(())

        return put
    if kind == "gen":
        body = _statements(node[1], depth)

        def gen(env):
            yield GEN_ON
            yield from body(env)
            yield GEN_OFF

        return gen
    if kind == "if":
        arms = [(_expression(t), _statements(b, depth)) for t, b in node[1]]

        def choose(env):
            for test, body in arms:
                if test(env):
                    yield from body(env)
                    return

        return choose
    name, many, body, test = node[1], _expression(node[2]), _statements(node[3], depth + 1), node[4] and _expression(node[4])

    def loop(env):
        inner = dict(env)
        rows = many(env)
        if isinstance(rows, (str, int, bool)):
            raise TemplateError("only lists can be gone through")
        rows = iter(rows or ())
        if test:
            rows = (x for x in rows if test(inner | {name: x}))
        budget = env.get(BUDGET)
        now = next(rows, _END)
        at = 0
        while now is not _END:
            after = next(rows, _END)
            inner[name] = now
            if budget and depth == 0:
                budget.refill(sum(len(x) for x in now.values() if isinstance(x, str)) if isinstance(now, dict) else len(now) if isinstance(now, str) else 0)
            elif budget:
                budget.step()
            inner["loop"] = {"index0": at, "index": at + 1, "first": at == 0, "last": after is _END}
            yield from body(inner)
            if depth == 0:
                yield CUT
            now, at = after, at + 1

    return loop


_END = object()


def _uses(node, name: str) -> int:
    """How often a name stands in a tree."""
    if isinstance(node, tuple):
        return int(node == ("name", name)) + sum(_uses(x, name) for x in node)
    return sum(_uses(x, name) for x in node) if isinstance(node, list) else 0


class Template:
    """A compiled template: a function from values to texts and markers, made of closures.

    streams: `messages` is gone through once, by an outermost loop, and may be an iterator.
    """

    def __init__(self, template: str):
        try:
            tree = fold(parse(template))
            loops = sum(n[0] == "for" and n[2] == ("name", "messages") and not _uses(n[3:], "messages") for n in tree)
            self.streams = loops == _uses(tree, "messages") <= 1
            self._run = _statements(tree)
        except (RecursionError, TypeError, ValueError, IndexError, OverflowError) as e:
            raise TemplateError(str(e) or type(e).__name__) from e

    def __call__(self, env: dict) -> Iterator:
        try:
            yield from self._run({BUDGET: Budget()} | env)
        except (RecursionError, TypeError, IndexError, KeyError, AttributeError, OverflowError) as e:
            raise TemplateError(f"{type(e).__name__}: {e}") from e


def compile_template(template: str) -> Template:
    return Template(template)


#: Turns between `<|im_start|>` and `<|im_end|>`; what assistants say is generation.
CHATML = """{% for m in messages %}<|im_start|>{{ m.role|guard_line }}
{% if m.role == 'assistant' %}{% generation %}{{ m.text|guard }}{% endgeneration %}{% else %}{{ m.text|guard }}{% endif %}<|im_end|>
{% endfor %}"""

FORMATTED = "conv_id long, piece int, text string, loss array<struct<start:int,end:int>>"


def _pieces(events: Iterator, limit: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Texts of about `limit` code points, cut only between turns, and their generation spans."""
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    n = 0
    begun = None
    for e in events:
        if e is GEN_ON:
            begun = n
        elif e is GEN_OFF:
            spans.append((begun, n))
            begun = None
        elif e is CUT:
            if n >= limit and begun is None:
                yield "".join(parts), spans
                parts, spans, n = [], [], 0
        else:
            parts.append(e)
            n += len(e)
    yield "".join(parts), spans


#: Code points of a conversation that a template may look at as a whole.
WHOLE_CHARS = 1 << 26


def _whole(messages: Iterator[dict], most: int) -> list[dict]:
    out, n = [], 0
    for m in messages:
        n += len(m["text"]) + len(m["role"])
        if n > most:
            raise TemplateError(f"a conversation has over {most} code points: a template that looks at all messages can't take it")
        out.append(m)
    return out


def format_conversations(conversations: DataFrame, template: str = CHATML, piece_chars: int = 1 << 20, values: dict | None = None, whole_chars: int = WHOLE_CHARS) -> DataFrame:
    """conv_id, piece, text, loss: the formatted conversation and its generation spans in code points.

    A conversation of more than `piece_chars` comes in pieces (0, 1, ..), cut between turns, that
    follow each other in a partition. values: what else the template may name (`bos_token`, `add_generation_prompt`..).
    A conversation is one sequence, so its turns go to one task; they are streamed there unless the template looks at all
    of them (whole_chars).
    """
    compile_template(template)  # errors show here, not in tasks
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template)
        turns = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))
        out: list[tuple] = []
        size = 0
        for conv, own in itertools.groupby(turns, key=lambda r: r[0]):
            messages = ({"role": r[2], "text": r[3], "content": r[3], "turn": r[1]} for r in own)
            env = dict(values or {}) | {"messages": messages if run.streams else _whole(messages, whole_chars)}
            for k, (text, spans) in enumerate(_pieces(run(env), piece_chars)):
                out.append((conv, k, text, [{"start": a, "end": b} for a, b in spans]))
                size += len(text)
                if size >= 1 << 22:
                    yield _batch(out)
                    out, size = [], 0
        if out:
            yield _batch(out)

    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(render, FORMATTED)


_FORMATTED_ARROW = pa.schema([("conv_id", pa.int64()), ("piece", pa.int32()), ("text", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _batch(rows: list[tuple], schema: pa.Schema = _FORMATTED_ARROW) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGESTS_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted text (CHATML), control strings as they were."""
    at = 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        at = m.end()
        yield unguard(m[1]), unguard(m[2])
    if at != len(text):
        raise ValueError(f"no turn begins at {at}")


def digests(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, read back from their text and spans.

    `formatted` must come straight from format_conversations(), whose pieces stand in order.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True))
        out = []
        for conv, own in itertools.groupby(pieces, key=lambda r: r[0]):
            n = loss_chars = chars = 0
            turns, loss = hashlib.sha256(), hashlib.sha256()
            for _, text, spans in own:
                chars += len(text)
                for role, said in read_turns(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for s in spans:
                    said = unguard(text[s["start"] : s["end"]])
                    loss_chars += len(said)
                    loss.update(said.encode())
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 4096:
                yield _batch(out, _DIGESTS_ARROW)
                out = []
        if out:
            yield _batch(out, _DIGESTS_ARROW)

    return formatted.mapInArrow(read, DIGESTS)

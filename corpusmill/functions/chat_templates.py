"""A tokenizer's own chat template as a native column expression.

Tokenizers carry their chat template as text in a small template language. The part
of it that published templates use to lay out a conversation (a loop over the
messages, conditions, concatenation, a few tests and filters) maps onto Spark
expressions: the loop is a ``transform`` over the messages, a condition a ``when``.
What is known when the plan is made (the special tokens, whether an answer is to be
opened) is decided there, so only the branch that is needed enters the plan.

``compile_template`` reads the text once; the result is given to the renderer as
``template=``. Anything outside the subset raises ``TemplateError`` and names it: such
a template goes through ``custom=`` (Python, Arrow-batched) instead.

Read as usual for chat templates: a block tag takes the line break after it and the
blanks before it on its line, ``-`` in a tag all white space on that side. A field that
a message lacks, or has as null, prints as nothing and is false, undefined and equal
to nothing but ``none``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class TemplateError(ValueError):
    """A template says something that has no native expression."""


# ------------------------------------------------------------------ text to statements

_TAG = re.compile(r"\{\{(?P<expr>.*?)\}\}|\{%(?P<block>.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~%<>|.,:()\[\]=]))""",
    re.S,
)
_ESCAPE = re.compile(r"\\(.)", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _pieces(text: str) -> list[tuple[str, str]]:
    """(kind, content) of the text's parts: ``text``, ``expr`` or ``block``."""
    if text.endswith("\n"):
        text = text[:-1]
    out: list[tuple[str, str]] = []
    at, eat, newline = 0, False, False  # eat: strip what follows; newline: drop one line break
    for m in _TAG.finditer(text):
        before = text[at : m.start()]
        tag = m.group(0)
        shown = m.group("expr") is not None
        if tag[2] == "-":
            before = before.rstrip()
        elif not shown and tag[2] != "+":
            line = before.rfind("\n") + 1
            if (line or at == 0) and not before[line:].strip(" \t"):
                before = before[:line]
        if eat:
            before = before.lstrip()
        elif newline and before.startswith("\n"):
            before = before[1:]
        out.append(("text", before))
        inner = m.group("expr") if shown else m.group("block")
        if inner is not None:
            start, end = tag[2] in "-+", tag[-3] in "-+" and len(tag) > 5
            out.append(("expr" if shown else "block", inner[start : len(inner) - end].strip()))
        eat, newline = tag[-3] == "-", not shown and tag[-3] != "+"
        at = m.end()
    rest = text[at:]
    out.append(("text", rest.lstrip() if eat else rest[1:] if newline and rest.startswith("\n") else rest))
    return [(k, v) for k, v in out if k != "text" or v]


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        kind = m.lastgroup
        value = m.group(kind)
        if kind == "str":
            value = _ESCAPE.sub(lambda e: _ESCAPES.get(e.group(1), e.group(1)), value[1:-1])
        out.append((kind, value))
        at = m.end()
    return out


class _Reader:
    """Expressions as nested tuples, by precedence."""

    def __init__(self, source: str):
        self.source, self.tokens, self.i = source, _tokens(source), 0

    def peek(self, *values: str) -> bool:
        return self.i < len(self.tokens) and self.tokens[self.i][0] != "str" and self.tokens[self.i][1] in values

    def take(self, *values: str) -> bool:
        if self.peek(*values):
            self.i += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r} in {self.source!r}")

    def name(self) -> str:
        if self.i < len(self.tokens) and self.tokens[self.i][0] == "name":
            self.i += 1
            return self.tokens[self.i - 1][1]
        raise TemplateError(f"expected a name in {self.source!r}")

    def whole(self):
        out = self.choice()
        if self.i < len(self.tokens):
            raise TemplateError(f"cannot read {self.tokens[self.i][1]!r} in {self.source!r}")
        return out

    def choice(self):
        out = self.either()
        if self.take("if"):
            cond = self.either()
            other = self.choice() if self.take("else") else ("const", None)
            return ("choose", cond, out, other)
        return out

    def either(self):
        out = self.both()
        while self.take("or"):
            out = ("or", out, self.both())
        return out

    def both(self):
        out = self.negation()
        while self.take("and"):
            out = ("and", out, self.negation())
        return out

    def negation(self):
        return ("not", self.negation()) if self.take("not") else self.comparison()

    def comparison(self):
        out = self.sum()
        while True:
            if self.peek("==", "!=", "<", "<=", ">", ">="):
                op = self.tokens[self.i][1]
                self.i += 1
                out = ("compare", op, out, self.sum())
            elif self.take("in"):
                out = ("in", out, self.sum())
            elif self.peek("not") and self.tokens[self.i + 1 : self.i + 2] == [("name", "in")]:
                self.i += 2
                out = ("not", ("in", out, self.sum()))
            elif self.take("is"):
                negative = self.take("not")
                test = ("is", self.name(), out)
                out = ("not", test) if negative else test
            else:
                return out

    def sum(self):
        out = self.product()
        while self.peek("+", "-", "~"):
            op = self.tokens[self.i][1]
            self.i += 1
            out = ("sum", op, out, self.product())
        return out

    def product(self):
        out = self.filtered()
        while self.take("%"):
            out = ("rest", out, self.filtered())
        return out

    def filtered(self):
        out = self.postfix()
        while self.take("|"):
            out = ("call", self.name(), out, [])
            if self.take("("):
                out = ("call", out[1], out[2], self.arguments(")"))
        return out

    def arguments(self, end: str) -> list:
        out = []
        while not self.take(end):
            out.append(self.choice())
            if not self.peek(end):
                self.need(",")
        return out

    def postfix(self):
        out = self.atom()
        while True:
            if self.take("."):
                name = self.name()
                out = ("call", name, out, self.arguments(")")) if self.take("(") else ("get", out, ("const", name))
            elif self.take("["):
                if self.take(":"):
                    out = ("slice", out, None, None if self.peek("]") else self.choice())
                else:
                    at = self.choice()
                    out = ("slice", out, at, None if self.peek("]") else self.choice()) if self.take(":") else ("get", out, at)
                self.need("]")
            else:
                return out

    def atom(self):
        if self.i >= len(self.tokens):
            raise TemplateError(f"something is missing in {self.source!r}")
        kind, value = self.tokens[self.i]
        self.i += 1
        if kind == "str":
            return ("const", value)
        if kind == "int":
            return ("const", int(value))
        if kind == "name":
            fixed = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
            if value in fixed:
                return ("const", fixed[value])
            return ("raise", self.arguments(")")) if value == "raise_exception" and self.take("(") else ("name", value)
        if value == "(":
            out = self.choice()
            self.need(")")
            return out
        if value == "[":
            return ("list", self.arguments("]"))
        if value == "-":
            return ("sum", "-", ("const", 0), self.postfix())
        raise TemplateError(f"cannot read {value!r} in {self.source!r}")


def _statements(pieces: list[tuple[str, str]], at: int = 0, inside: str = "") -> tuple[list, int, str]:
    """Statements up to the block that ends ``inside``; where they stop, and that block."""
    out: list = []
    while at < len(pieces):
        kind, content = pieces[at]
        at += 1
        if kind == "text":
            out.append(("print", ("const", content)))
            continue
        if kind == "expr":
            out.append(("print", _Reader(content).whole()))
            continue
        word, _, rest = content.partition(" ")
        if word in ("endif", "endfor", "else", "elif"):
            if not inside:
                raise TemplateError(f"{word!r} ends nothing")
            return out, at, content
        if word == "if":
            branches, other = [], []
            cond, end = _Reader(rest).whole(), ""
            while True:
                body, at, end = _statements(pieces, at, "if")
                branches.append((cond, body))
                if end.startswith("elif "):
                    cond = _Reader(end[5:]).whole()
                    continue
                if end == "else":
                    other, at, end = _statements(pieces, at, "if")
                break
            if end != "endif":
                raise TemplateError(f"{end!r} ends an if")
            out.append(("if", branches, other))
        elif word == "for":
            r = _Reader(rest)
            name = r.name()
            r.need("in")
            over = r.whole()
            body, at, end = _statements(pieces, at, "for")
            if end != "endfor":
                raise TemplateError(f"{end!r} ends a loop")
            out.append(("for", name, over, body))
        elif word == "set":
            r = _Reader(rest)
            name = r.name()
            r.need("=")
            out.append(("set", name, r.whole()))
        elif word in ("generation", "endgeneration"):
            continue  # marks the answer for training masks; prints nothing
        else:
            raise TemplateError(f"no native form of {word!r}")
    if inside:
        raise TemplateError(f"an {inside} has no end")
    return out, at, ""


# ------------------------------------------------------------------ statements to columns

#: kinds of a value in the plan; a constant of the template is a plain Python value
TEXT, NUMBER, FLAG, ITEMS, ITEM = "text", "number", "flag", "a list", "a message"


@dataclass
class _Value:
    kind: str
    col: Column
    fields: dict = field(default_factory=dict)  # of an item, or of a list's items: name -> nested fields or None


_RAISED: dict = {}  # the fields of the null that stands where a template raises


def _fixed(v) -> bool:
    return not isinstance(v, _Value)


class _Scope:
    def __init__(self, names: dict):
        self.names = names

    def __call__(self, node):
        return getattr(self, "_" + node[0])(*node[1:])

    # ---- values

    def _const(self, value):
        return value

    def _list(self, items):
        return [self(i) for i in items]

    def _name(self, name):
        return self.names.get(name)

    def _raise(self, args):
        return _Value(TEXT, F.lit(None).cast("string"), _RAISED)

    def _get(self, of, at):
        of, at = self(of), self(at)
        if isinstance(of, dict):
            return of.get(at)
        if of is None or not isinstance(of, _Value) or not _fixed(at):
            raise TemplateError(f"no native form of an element {at!r}")
        if of.kind == ITEMS and isinstance(at, int) and not isinstance(at, bool):
            where = F.lit(at) if at >= 0 else F.size(of.col) + at
            return _Value(ITEM, F.when((where >= 0) & (where < F.size(of.col)), F.get(of.col, where)), of.fields)
        if of.kind == ITEM and isinstance(at, str):
            if at not in of.fields:
                return None
            return _as_value(of.col[at], of.fields[at])
        raise TemplateError(f"no native form of element {at!r} of {of.kind}")

    def _slice(self, of, low, high):
        of, low, high = self(of), self(low) if low else 0, self(high) if high else None
        if not isinstance(of, _Value) or of.kind != ITEMS or not all(isinstance(x, int) for x in (low, high or 0)):
            raise TemplateError("only a list is cut, at fixed places")
        n = F.size(of.col)
        a = F.least(F.lit(low), n) if low >= 0 else F.greatest(n + low, F.lit(0))
        b = n if high is None else F.least(F.lit(high), n) if high >= 0 else F.greatest(n + high, F.lit(0))
        return _Value(ITEMS, F.slice(of.col, a + 1, F.greatest(b - a, F.lit(0))), of.fields)

    def _choose(self, cond, yes, no):
        cond = self.truth(self(cond))
        if _fixed(cond):
            return self(yes) if cond else self(no)
        return _merged(cond.col, self(yes), self(no))

    # ---- conditions

    def truth(self, v):
        if _fixed(v):
            return bool(v)
        if v.kind == FLAG:
            return _Value(FLAG, F.coalesce(v.col, F.lit(False)))
        if v.kind == TEXT:
            return _Value(FLAG, F.coalesce(v.col != "", F.lit(False)))
        if v.kind == NUMBER:
            return _Value(FLAG, F.coalesce(v.col != 0, F.lit(False)))
        return _Value(FLAG, F.coalesce(F.size(v.col) > 0, F.lit(False)) if v.kind == ITEMS else v.col.isNotNull())

    def _not(self, a):
        a = self.truth(self(a))
        return not a if _fixed(a) else _Value(FLAG, ~a.col)

    def _and(self, a, b):
        a = self(a)
        t = self.truth(a)
        if _fixed(t):
            return self(b) if t else a
        b = self.truth(self(b))
        return (t if b else False) if _fixed(b) else _Value(FLAG, t.col & b.col)

    def _or(self, a, b):
        a = self(a)
        t = self.truth(a)
        if _fixed(t):
            return a if t else self(b)
        right = self(b)
        if a.kind == TEXT and (isinstance(right, str) or (not _fixed(right) and right.kind == TEXT)):
            return _merged(t.col, a, right)
        b = self.truth(right)
        return (True if b else t) if _fixed(b) else _Value(FLAG, t.col | b.col)

    def _compare(self, op, a, b):
        a, b = self(a), self(b)
        if _fixed(a) and _fixed(b):
            return {"==": a == b, "!=": a != b}[op] if op in ("==", "!=") else {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]
        if _fixed(a) and (a is None or isinstance(a, bool)):
            a, b = b, a
        if _fixed(b) and (b is None or (isinstance(b, bool) and a.kind != FLAG)):
            if op not in ("==", "!="):
                raise TemplateError(f"no native form of {op} {b}")
            # a text is never equal to true or false; nothing is equal to none
            same = a.col.isNull() if not b else F.lit(False)
            return _Value(FLAG, same if op == "==" else ~same)
        x, y = _column(a), _column(b)
        same = {"==": x.eqNullSafe(y), "!=": ~x.eqNullSafe(y), "<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[op]
        return _Value(FLAG, F.coalesce(same, F.lit(False)))

    def _in(self, a, b):
        a, b = self(a), self(b)
        if isinstance(b, list):
            found = [self._compare_values(a, x) for x in b]
            if all(_fixed(f) for f in found):
                return any(found)
            out = F.lit(False)
            for f in found:
                out = out | (F.lit(f) if _fixed(f) else f.col)
            return _Value(FLAG, out)
        if isinstance(a, str) and isinstance(b, _Value) and b.kind == ITEM:
            if a not in b.fields:
                return False
            return _Value(FLAG, F.coalesce(b.col[a].isNotNull(), F.lit(False)))
        if _fixed(a) and _fixed(b):
            return a in (b or "")
        if _is_text(a) and _is_text(b):
            return _Value(FLAG, F.coalesce(F.contains(_column(b), _column(a)), F.lit(False)))
        raise TemplateError("no native form of 'in' here")

    def _compare_values(self, a, x):
        return self._compare("==", ("const", a), ("const", x))

    def _is(self, test, a):
        if test in ("defined", "undefined") and a[0] == "name" and a[1] not in self.names:
            return test == "undefined"
        v = self(a)
        if test in ("defined", "undefined", "none"):
            gone = v is None if _fixed(v) else _Value(FLAG, v.col.isNull())
            if test != "defined":
                return gone
            return not gone if _fixed(gone) else _Value(FLAG, ~gone.col)
        if test in ("string", "mapping", "iterable"):
            kinds = {"string": (TEXT,), "mapping": (ITEM,), "iterable": (ITEMS, TEXT, ITEM)}[test]
            return isinstance(v, str) and test != "mapping" if _fixed(v) else (_Value(FLAG, v.col.isNotNull()) if v.kind in kinds else False)
        raise TemplateError(f"no native form of the test {test!r}")

    # ---- text and numbers

    def _sum(self, op, a, b):
        a, b = self(a), self(b)
        numbers = all(isinstance(v, int) if _fixed(v) else v.kind == NUMBER for v in (a, b))
        if op == "~" or not numbers:
            if op == "-":
                raise TemplateError("only numbers are subtracted")
            if isinstance(a, str) and isinstance(b, str):
                return a + b
            return _Value(TEXT, F.concat(_text(a), _text(b)))
        if _fixed(a) and _fixed(b):
            return a + b if op == "+" else a - b
        return _Value(NUMBER, _column(a) + _column(b) if op == "+" else _column(a) - _column(b))

    def _rest(self, a, b):
        a, b = self(a), self(b)
        if _fixed(a) and _fixed(b):
            return a % b
        return _Value(NUMBER, F.pmod(_column(a), _column(b)))

    def _call(self, name, of, args):
        v, args = self(of), [self(x) for x in args]
        if name == "default" and len(args) == 1 and (v is None or (not _fixed(v) and v.kind == TEXT)):
            return args[0] if v is None else _Value(TEXT, F.coalesce(v.col, _text(args[0])))
        if name in ("length", "count") and not args:
            if isinstance(v, (str, list)):
                return len(v)
            if isinstance(v, _Value) and v.kind in (ITEMS, TEXT):
                return _Value(NUMBER, F.size(v.col) if v.kind == ITEMS else F.length(_text(v)))
        if v is None and name in _METHODS:
            v = ""
        if name in _METHODS and _is_text(v) and all(isinstance(x, str) for x in args):
            local, native = _METHODS[name]
            return local(v, *args) if _fixed(v) else _Value(FLAG if name.endswith("with") else TEXT, native(_text(v), *args))
        raise TemplateError(f"no native form of {name!r}")

    # ---- statements

    def run(self, statements: list) -> list:
        """What the statements print, as texts and columns."""
        out: list = []
        for s in statements:
            out += getattr(self, "_do_" + s[0])(*s[1:])
        return out

    def _do_print(self, node):
        v = self(node)
        return [] if v is None or v == "" and _fixed(v) else [v if isinstance(v, str) else _text(v)]

    def _do_set(self, name, node):
        self.names[name] = self(node)
        return []

    def _do_if(self, branches, other):
        if not branches:
            return self.run(other)
        (cond, body), rest = branches[0], branches[1:]
        cond = self.truth(self(cond))
        if _fixed(cond):
            return self.run(body) if cond else self._do_if(rest, other)
        yes, no = _Scope(dict(self.names)), _Scope(dict(self.names))
        a, b = yes.run(body), no._do_if(rest, other)
        for name in yes.names.keys() | no.names.keys():
            x, y = yes.names.get(name), no.names.get(name)
            self.names[name] = x if x is y else _merged(cond.col, x, y)
        return [F.when(cond.col, _joined(a)).otherwise(_joined(b))]

    def _do_for(self, name, over, body):
        over = self(over)
        if not isinstance(over, _Value) or over.kind != ITEMS:
            raise TemplateError("a loop runs over the messages or a list field")
        n = F.size(over.col)

        def each(item: Column, i: Column) -> Column:
            loop = {
                "index0": _Value(NUMBER, i), "index": _Value(NUMBER, i + 1), "first": _Value(FLAG, i == 0), "last": _Value(FLAG, i == n - 1),
                "length": _Value(NUMBER, n), "revindex0": _Value(NUMBER, n - 1 - i), "revindex": _Value(NUMBER, n - i),
            }
            inner = _Scope({**self.names, name: _as_value(item, over.fields or None), "loop": loop})
            return _joined(inner.run(body))

        each_one = F.transform(over.col, each)
        # a null is a place where the template gave up
        whole = F.array_join(each_one, "")
        return [F.when(~F.exists(each_one, lambda t: t.isNull()), whole) if _gives_up(body) else whole]


_METHODS = {
    "trim": (lambda s, *a: s.strip(), lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")),
    "strip": (lambda s, *a: s.strip(*a), lambda c, chars=None: F.regexp_replace(c, r"(?U)^\s+|\s+\z", "") if chars is None else F.btrim(c, F.lit(chars))),
    "lstrip": (lambda s, *a: s.lstrip(*a), lambda c, chars=None: F.regexp_replace(c, r"(?U)^\s+", "") if chars is None else F.ltrim(c, F.lit(chars))),
    "rstrip": (lambda s, *a: s.rstrip(*a), lambda c, chars=None: F.regexp_replace(c, r"(?U)\s+\z", "") if chars is None else F.rtrim(c, F.lit(chars))),
    "upper": (lambda s: s.upper(), F.upper),
    "lower": (lambda s: s.lower(), F.lower),
    "string": (lambda s: s, lambda c: c),
    "startswith": (lambda s, x: s.startswith(x), lambda c, x: F.startswith(c, F.lit(x))),
    "endswith": (lambda s, x: s.endswith(x), lambda c, x: F.endswith(c, F.lit(x))),
    "replace": (lambda s, x, y: s.replace(x, y), lambda c, x, y: F.replace(c, F.lit(x), F.lit(y))),
}


def _as_value(col: Column, fields) -> _Value:
    """A message's field: text, or nested messages (``[fields]``) or fields."""
    if isinstance(fields, list):
        return _Value(ITEMS, col, fields[0])
    return _Value(ITEM, col, fields) if isinstance(fields, dict) else _Value(TEXT, col)


def _is_text(v) -> bool:
    return isinstance(v, str) if _fixed(v) else v.kind == TEXT


def _column(v) -> Column:
    return F.lit(v) if _fixed(v) else v.col


def _text(v) -> Column:
    """What a value prints; a null prints as nothing, unless the template gave up there."""
    if _fixed(v):
        return F.lit("" if v is None else str(v))
    if v.kind == TEXT:
        return v.col if v.fields is _RAISED else F.coalesce(v.col, F.lit(""))
    if v.kind == NUMBER:
        return v.col.cast("string")
    if v.kind == FLAG:
        return F.when(v.col, F.lit("True")).otherwise(F.lit("False"))
    raise TemplateError(f"{v.kind} is printed as a whole")


def _gives_up(statements: list) -> bool:
    return "'raise'" in repr(statements)


def _merged(cond: Column, x, y):
    """A value that is ``x`` where the condition holds and ``y`` elsewhere."""
    if _fixed(x) and _fixed(y) and x == y and type(x) is type(y):
        return x
    if any(isinstance(v, (list, dict)) for v in (x, y)):
        raise TemplateError("a list differs between branches")
    if any(not _fixed(v) and v.fields is _RAISED for v in (x, y)):
        return _Value(TEXT, F.when(cond, _text(x)).otherwise(_text(y)), _RAISED)
    kinds = {v.kind for v in (x, y) if not _fixed(v)} | {TEXT for v in (x, y) if isinstance(v, str)}
    kinds |= {FLAG for v in (x, y) if isinstance(v, bool)} if kinds <= {FLAG} else set()
    kinds |= {NUMBER for v in (x, y) if isinstance(v, int) and not isinstance(v, bool)}
    if len(kinds) != 1:
        raise TemplateError(f"a value is {' or '.join(sorted(kinds)) or 'nothing'} by branch")
    kind = kinds.pop()
    # false and none beside a text or a list: null, which is false and undefined
    cols = [F.lit(None) if _fixed(v) and not isinstance(v, str) and kind in (TEXT, ITEMS, ITEM) else _column(v) for v in (x, y)]
    fields = next((v.fields for v in (x, y) if not _fixed(v) and v.fields), {})
    return _Value(kind, F.when(cond, cols[0]).otherwise(cols[1]), fields)


def _joined(parts: list) -> Column:
    out: list = []
    for p in parts:
        if isinstance(p, str) and out and isinstance(out[-1], str):
            out[-1] += p
        else:
            out.append(p)
    cols = [F.lit(p) if isinstance(p, str) else p for p in out]
    return F.lit("") if not cols else cols[0] if len(cols) == 1 else F.concat(*cols)


@dataclass(frozen=True)
class CompiledTemplate:
    """A chat template in native form. ``tokens`` are the tokenizer's special tokens and
    other settings that the template names (``bos_token``, ``eos_token``, ...)."""

    source: str
    tokens: tuple[tuple[str, object], ...] = ()

    def text(self, messages: Column, fields: dict, add_generation_prompt: bool) -> Column:
        """The rendered conversation; null where the template raises. ``fields`` are the
        message's fields: name to None (text), to a nested field table, or to a list of
        one for an array of objects."""
        names = {**dict(self.tokens), "messages": _Value(ITEMS, messages, fields), "add_generation_prompt": add_generation_prompt}
        statements, _, _ = _statements(_pieces(self.source))
        return _joined(_Scope(names).run(statements))


def compile_template(source: str, **tokens: object) -> CompiledTemplate:
    """Reads a template: ``compile_template(text, bos_token="<s>", eos_token="</s>")``. What
    has no native form raises here if it cannot be read, else when a plan is made."""
    out = CompiledTemplate(source, tuple(sorted(tokens.items())))
    _statements(_pieces(source))
    return out


def message_fields(item: T.StructType) -> dict:
    """The field table of a message type."""
    out = {}
    for f in item.fields:
        kind = f.dataType
        if isinstance(kind, T.StructType):
            out[f.name] = message_fields(kind)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out[f.name] = [message_fields(kind.elementType)]
        else:
            out[f.name] = None
    return out


ROLE_AND_CONTENT: dict = {"role": None, "content": None}

"""Chat formatting: a compiler for a small sandboxed template language.

``compile_template`` parses a template to a syntax tree, folds constants and
builds Python closures. Templates know text, ``{{ expr }}``, ``{% if %}`` /
``elif`` / ``else``, ``{% for x in y %}``, ``{% set x = expr %}`` and
``{% generation %}`` (what it holds is under the loss mask). Expressions have
strings, integers, ``true false none``, names, ``a.b`` and ``a['b']`` (keys of
mappings only), ``== != and or not + ~`` and filters. A template reaches
nothing but the values given to it: no attributes, calls or imports.

Closures push text to a sink as they run, and ``for`` takes an iterator, so a
conversation of any length is rendered turn by turn in bounded memory. Rows
come hashed by conversation and sorted by turn; turns that tie are in order of
role and text. Contract: null roles and texts are empty; a null conversation
id is a conversation of its own; repeated rows are repeated turns; other
columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import queue
import re
import threading

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- escapes

#: strings that mark turns; texts never show them unescaped (fixed values)
CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<<:>>",
            "<</ROLE>>")
_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\([\\:])")


def protect(text: str) -> str:
    """Escape reversibly: backslashes double, and a control string is broken
    after its first character by a backslash and a colon."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\:" + m[0][1:], text.replace("\\", "\\\\"))


def unprotect(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else "", text)


TEMPLATE = """\
{%- for m in messages -%}
{%- if m.role == 'system' -%}<<SYS>> {{ m.text | protect }} <</SYS>>
{%- elif m.role == 'user' -%}[INST] {{ m.text | protect }} [/INST]
{%- elif m.role == 'assistant' -%}<s> {% generation %}{{ m.text | protect }}{% endgeneration %} </s>
{%- else -%}<<ROLE>> {{ m.role | protect }} <<:>> {{ m.text | protect }} <</ROLE>>
{%- endif -%}
{%- endfor -%}
"""

FILTERS = {"protect": protect, "trim": str.strip, "upper": str.upper, "lower": str.lower}

# ---------------------------------------------------------------- parsing

_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"|([A-Za-z_]\w*)"
                    r"|(==|!=|[.\[\]()|+~=]))")


class TemplateError(ValueError):
    pass


def _tokens(code: str) -> list[tuple[str, object]]:
    out, at = [], 0
    code = code.rstrip()
    while at < len(code):
        m = _TOKEN.match(code, at)
        if not m:
            raise TemplateError(f"cannot read {code[at:]!r}")
        at = m.end()
        if m[1] is not None:
            out.append(("const", int(m[1])))
        elif m[2] is not None or m[3] is not None:
            raw = m[2] if m[2] is not None else m[3]
            out.append(("const", re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(
                e[1], e[1]), raw)))
        elif m[4] is not None:
            name = m[4].lower()
            out.append(("const", {"true": True, "false": False, "none": None}[name])
                       if name in ("true", "false", "none") else ("name", m[4]))
        else:
            out.append(("op", m[5]))
    return out


class _Expr:
    """Recursive descent over one expression's tokens, into tuples."""

    def __init__(self, tokens):
        self.t, self.i = tokens, 0

    def peek(self, *values) -> bool:
        return self.i < len(self.t) and self.t[self.i][1] in values \
            and self.t[self.i][0] in ("op", "name")

    def next(self, kind=None, value=None):
        if self.i >= len(self.t):
            raise TemplateError("expression ends early")
        k, v = self.t[self.i]
        if (kind and k != kind) or (value and v != value):
            raise TemplateError(f"unexpected {v!r}")
        self.i += 1
        return v

    def whole(self):
        e = self.either()
        if self.i != len(self.t):
            raise TemplateError(f"unexpected {self.t[self.i][1]!r}")
        return e

    def either(self):
        e = self.both()
        while self.peek("or"):
            self.next()
            e = ("or", e, self.both())
        return e

    def both(self):
        e = self.negated()
        while self.peek("and"):
            self.next()
            e = ("and", e, self.negated())
        return e

    def negated(self):
        if self.peek("not"):
            self.next()
            return ("not", self.negated())
        e = self.added()
        while self.peek("==", "!="):
            e = (self.next(), e, self.added())
        return e

    def added(self):
        e = self.filtered()
        while self.peek("+", "~"):
            e = (self.next(), e, self.filtered())
        return e

    def filtered(self):
        e = self.item()
        while self.peek("|"):
            self.next()
            name = self.next("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            e = ("filter", name, e)
        return e

    def item(self):
        kind, v = self.t[self.i] if self.i < len(self.t) else ("end", None)
        self.i += 1
        if kind == "const":
            e = ("const", v)
        elif kind == "name":
            e = ("name", v)
        elif (kind, v) == ("op", "("):
            e = self.either()
            self.next("op", ")")
        else:
            raise TemplateError(f"unexpected {v!r}")
        while self.peek(".", "["):
            if self.next() == ".":
                e = ("key", e, self.next("name"))
            else:
                k = self.next("const")
                self.next("op", "]")
                e = ("key", e, k)
        return e


def parse(source: str) -> list:
    """The syntax tree: a list of nodes."""
    parts = _TAG.split(source)
    for i in range(1, len(parts), 2):  # "-" strips the white space beside a tag
        if parts[i][2] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        if parts[i][-3] == "-":
            parts[i + 1] = parts[i + 1].lstrip()
    root: list = []
    stack: list[tuple[str, list]] = [("root", root)]
    for i, part in enumerate(parts):
        body = stack[-1][1]
        if i % 2 == 0:
            if part:
                body.append(("text", part))
            continue
        code = part[2:-2].strip("-").strip()
        if part[1] == "#":
            continue
        if part[1] == "{":
            body.append(("print", _Expr(_tokens(code)).whole()))
            continue
        word, _, rest = code.partition(" ")
        if word == "for":
            m = re.match(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read {code!r}")
            inner: list = []
            body.append(("for", m[1], _Expr(_tokens(m[2])).whole(), inner))
            stack.append(("for", inner))
        elif word == "if":
            inner = []
            body.append(("if", [(_Expr(_tokens(rest)).whole(), inner)]))
            stack.append(("if", inner))
        elif word in ("elif", "else"):
            if stack.pop()[0] != "if":
                raise TemplateError(f"{word} without if")
            inner = []
            test = _Expr(_tokens(rest)).whole() if word == "elif" else ("const", True)
            stack[-1][1][-1][1].append((test, inner))
            stack.append(("if", inner))
        elif word == "set":
            name, eq, value = rest.partition("=")
            if not eq:
                raise TemplateError(f"cannot read {code!r}")
            body.append(("set", name.strip(), _Expr(_tokens(value)).whole()))
        elif word == "generation":
            inner = []
            body.append(("generation", inner))
            stack.append(("generation", inner))
        elif word.startswith("end") and stack[-1][0] == word[3:]:
            stack.pop()
        else:
            raise TemplateError(f"unexpected {code!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    return root


# ---------------------------------------------------------------- folding

_BINARY = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b,
           "~": lambda a, b: _show(a) + _show(b)}


def _show(v) -> str:
    return "" if v is None else str(v)


def _add(a, b):
    if type(a) is not type(b) or not isinstance(a, (str, int)):
        raise TemplateError("+ needs two strings or two integers")
    return a + b


def fold_expr(e: tuple) -> tuple:
    op = e[0]
    if op in ("==", "!=", "~", "+", "and", "or"):
        a, b = fold_expr(e[1]), fold_expr(e[2])
        if op in ("and", "or") and a[0] == "const":
            return b if bool(a[1]) == (op == "and") else a
        if a[0] == b[0] == "const":
            return ("const", _add(a[1], b[1]) if op == "+" else _BINARY[op](a[1], b[1]))
        return (op, a, b)
    if op == "not":
        a = fold_expr(e[1])
        return ("const", not a[1]) if a[0] == "const" else ("not", a)
    if op == "filter":
        a = fold_expr(e[2])
        return ("const", FILTERS[e[1]](_show(a[1]))) if a[0] == "const" else ("filter", e[1], a)
    if op == "key":
        return ("key", fold_expr(e[1]), e[2])
    return e


def fold_tree(nodes: list) -> list:
    """Constants computed, branches that cannot run removed, texts joined."""
    out: list = []
    for node in nodes:
        kind = node[0]
        if kind == "print":
            e = fold_expr(node[1])
            made = [("text", _show(e[1]))] if e[0] == "const" else [("print", e)]
        elif kind == "if":
            arms: list = []
            for test, body in node[1]:
                test = fold_expr(test)
                if test[0] == "const" and not test[1]:
                    continue
                arms.append((test, fold_tree(body)))
                if test[0] == "const":
                    break
            made = arms[0][1] if arms and arms[0][0][0] == "const" else [("if", arms)] * bool(arms)
        elif kind == "for":
            made = [("for", node[1], fold_expr(node[2]), fold_tree(node[3]))]
        elif kind == "generation":
            made = [("generation", fold_tree(node[1]))]
        elif kind == "set":
            made = [("set", node[1], fold_expr(node[2]))]
        else:
            made = [node]
        for n in made:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)
    return out


# ---------------------------------------------------------------- closures

def _value(e: tuple):
    op = e[0]
    if op == "const":
        c = e[1]
        return lambda env: c
    if op == "name":
        name = e[1]
        return lambda env: env.get(name)
    if op == "key":
        base, key = _value(e[1]), e[2]

        def get(env):
            v = base(env)
            return v.get(key) if isinstance(v, dict) else None
        return get
    if op == "filter":
        f, a = FILTERS[e[1]], _value(e[2])
        return lambda env: f(_show(a(env)))
    if op == "not":
        a = _value(e[1])
        return lambda env: not a(env)
    a, b = _value(e[1]), _value(e[2])
    if op == "and":
        return lambda env: a(env) and b(env)
    if op == "or":
        return lambda env: a(env) or b(env)
    f = _add if op == "+" else _BINARY[op]
    return lambda env: f(a(env), b(env))


def _body(nodes: list, marked: bool):
    steps = [_step(n, marked) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(env, emit):
        for s in steps:
            s(env, emit)
    return run


def _step(node: tuple, marked: bool):
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda env, emit: emit(text, marked)
    if kind == "print":
        value = _value(node[1])
        return lambda env, emit: emit(_show(value(env)), marked)
    if kind == "generation":
        return _body(node[1], True)
    if kind == "set":
        name, value = node[1], _value(node[2])

        def put(env, emit):
            env[name] = value(env)
        return put
    if kind == "if":
        arms = [(_value(t), _body(b, marked)) for t, b in node[1]]

        def choose(env, emit):
            for test, body in arms:
                if test(env):
                    return body(env, emit)
        return choose
    name, items, body = node[1], _value(node[2]), _body(node[3], marked)

    def loop(env, emit):
        inner = dict(env)
        for i, v in enumerate(items(env) or ()):
            inner[name] = v
            inner["loop"] = {"index0": i, "index": i + 1, "first": i == 0}
            body(inner, emit)
    return loop


def compile_template(source: str):
    """run(values, emit): renders by calling emit(text, under_loss_mask)."""
    return _body(fold_tree(parse(source)), False)


def render(template, messages) -> tuple[str, list[tuple[int, int]]]:
    """One conversation as text and the spans under the loss mask."""
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    at = 0

    def emit(text, marked):
        nonlocal at
        parts.append(text)
        if marked:
            spans.append((at, at + len(text)))
        at += len(text)
    template({"messages": messages}, emit)
    return "".join(parts), spans


# ---------------------------------------------------------------- reading back

_TURN = re.compile(r"<<SYS>> (?P<system>.*?) <</SYS>>|\[INST\] (?P<user>.*?) \[/INST\]"
                   r"|<s> (?P<assistant>.*?) </s>"
                   r"|<<ROLE>> (?P<role>.*?) <<:>> (?P<text>.*?) <</ROLE>>", re.S)


class Reader:
    """Reads turns and masked text back from formatted output, piece by piece;
    holds one turn at most."""

    ENDS = ("<</SYS>>", "[/INST]", "</s>", "<</ROLE>>")

    def __init__(self):
        self.buffer: list[str] = []
        self.turns = self.loss = self.chars = 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, marked: bool) -> None:
        self.chars += len(text)
        if marked:
            plain = unprotect(text)
            self.loss += len(plain)
            self.loss_hash.update(_utf8(plain))
        self.buffer.append(text)
        if not marked and any(e in text for e in self.ENDS):
            held = "".join(self.buffer)
            at = 0
            while m := _TURN.match(held, at):
                at = m.end()
                role = m.lastgroup if m["role"] is None else unprotect(m["role"])
                body = m["text"] if m["role"] is not None else m[m.lastgroup]
                self.turns += 1
                self.turn_hash.update(_utf8(f"{role}\n{unprotect(body)}\n"))
            self.buffer = [held[at:]]

    def row(self) -> tuple:
        if "".join(self.buffer):
            raise ValueError("output holds an unfinished turn")
        return (self.turns, self.turn_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(),
                self.chars)


def _utf8(s: str) -> bytes:
    return s.encode("utf-8", "surrogatepass")


# ---------------------------------------------------------------- Spark

def _by_conversation(rows: DataFrame) -> DataFrame:
    d = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return (d.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text"))


def _conversations(batches):
    """(conv_id, iterator of messages) in order; rows are read as they are
    asked for, so nothing is gathered. What a caller leaves is skipped."""
    def rows():
        for b in batches:
            yield from zip(*(b.column(i).to_pylist() for i in range(3)))
    source = rows()
    held = next(source, None)

    def turns(conv):
        nonlocal held
        while held is not None and held[0] == conv:
            message = {"role": held[1], "text": held[2]}
            held = next(source, None)
            yield message
    while held is not None:
        conv = held[0]
        it = turns(conv)
        yield conv, it
        for _ in it:
            pass


#: characters of a chunk of formatted output, from which a new one begins, and
#: chunks that may wait to be taken
CHUNK_CHARS = 1 << 20
WAITING = 4


class Chunks:
    """A sink that cuts what a program emits into chunks, while it runs."""

    def __init__(self, give):
        self.give, self.number = give, 0
        self._new()

    def _new(self) -> None:
        self.parts, self.spans, self.at = [], [], 0

    def feed(self, text: str, marked: bool) -> None:
        self.parts.append(text)
        if marked:
            self.spans.append((self.at, self.at + len(text)))
        self.at += len(text)
        if self.at >= CHUNK_CHARS:
            self._cut()

    def _cut(self) -> None:
        self.give(self.number, "".join(self.parts), self.spans)
        self.number += 1
        self._new()

    def close(self) -> None:
        if self.parts or not self.number:
            self._cut()


def _pulled(produce):
    """What ``produce(give)`` gives, as an iterator: it runs in a thread that
    stays WAITING items ahead."""
    taken, left = queue.Queue(WAITING), threading.Event()

    def give(item):
        while not left.is_set():
            try:
                return taken.put(item, timeout=1)
            except queue.Full:
                continue
        raise RuntimeError("nobody takes the output any more")

    def work():
        try:
            produce(lambda item: give((item, None)))
            give((None, StopIteration()))
        except BaseException as e:  # noqa: BLE001 - raised where the output is taken
            if not left.is_set():
                give((None, e))
    threading.Thread(target=work, daemon=True).start()
    try:
        while True:
            item, end = taken.get()
            if isinstance(end, StopIteration):
                return
            if end is not None:
                raise end
            yield item
    finally:
        left.set()


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, chunk, formatted, loss_spans): each conversation's text, in
    chunks of about CHUNK_CHARS (most have one), with the spans of the chunk
    under the loss mask. The template runs once over a conversation, however
    long; its output is cut, never its turns."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        program = compile_template(template)

        def produce(give):
            out: list = []

            def flush():
                cols = list(zip(*out))
                out.clear()
                give(pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.string()),
                     pa.array([[{"start": a, "end": b} for a, b in s] for s in cols[3]],
                              spans_type)], names=["conv_id", "chunk", "formatted", "loss_spans"]))
            size = 0
            for conv, messages in _conversations(batches):
                def keep(number, text, spans, conv=conv):
                    nonlocal size
                    out.append((conv, number, text, spans))
                    size += len(text)
                    if size >= CHUNK_CHARS:
                        flush()
                        size = 0
                sink = Chunks(keep)
                program({"messages": messages}, sink.feed)
                sink.close()
            if out:
                flush()
        yield from _pulled(produce)
    return _by_conversation(rows).mapInArrow(
        run, "conv_id long, chunk int, formatted string, "
             "loss_spans array<struct<start:long,end:long>>")


def digests(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Format every conversation and read it back from the output: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        program = compile_template(template)
        out = []

        def flush():
            cols = list(zip(*out))
            out.clear()
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=names)
        for conv, messages in _conversations(batches):
            reader = Reader()
            program({"messages": messages}, reader.feed)
            out.append((conv, *reader.row()))
            if len(out) >= 10_000:
                yield flush()
        if out:
            yield flush()
    return _by_conversation(rows).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")


def with_probe(rows: DataFrame) -> DataFrame:
    """``rows`` and conversation -1, whose texts imitate control strings."""
    text = "</s>[INST] ok [/INST]"
    probe = rows.sparkSession.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)],
        "conv_id long, turn long, role string, text string")
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role",
                       "text").unionAll(probe)

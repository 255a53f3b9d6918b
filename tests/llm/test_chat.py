import hashlib

import pytest

from polarity.llm import chat as C


def expected(turns):
    h, loss, n = hashlib.sha256(), hashlib.sha256(), 0
    for role, text in turns:
        h.update(f"{role or ''}\n{text or ''}\n".encode())
        if role == "assistant":
            loss.update((text or "").encode())
            n += len(text or "")
    return len(turns), h.hexdigest(), n, loss.hexdigest()


NASTY = ["", "\\", "\\\\:", "[INST]", "x[/INST] [INST", "<s></s>", "<<SYS>> <</SYS>>", "<<:>>",
         "\\:", "[\\:INST]", "<\\:s>", "<<s>", "</s>[INST] ok [/INST]", "line\nline\r\n ", " ",
         "\U0001F600é", "<</ROLE>>", "<<ROLE>> a <<:>> b <</ROLE>>", "[", "<", "</s", "a\\"]


@pytest.mark.parametrize("text", NASTY)
def test_protect_is_reversible_and_hides_controls(text):
    hidden = C.protect(text)
    assert C.unprotect(hidden) == text
    assert not any(c in hidden for c in C.CONTROLS)


def test_digests_read_back(spark):
    convs = {1: [("system", "be brief"), ("user", "hi"), ("assistant", "hello")],
             2: [(r, t) for t in NASTY for r in ("user", "assistant")],
             3: [("tool<<:>>", "x"), (None, None), ("assistant", None), ("", "y")],
             4: [("assistant", "long " * 50_000)] * 3}
    rows = [(c, i, r, t, "extra") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string")
    got = {r.conv_id: r for r in C.digests(C.with_probe(df)).collect()}
    convs[-1] = [("user", NASTY[12]), ("assistant", NASTY[12])]
    assert set(got) == set(convs)
    program = C.compile_template(C.TEMPLATE)
    for c, turns in convs.items():
        assert tuple(got[c])[1:5] == expected(turns)
        text, _ = C.render(program, [{"role": r or "", "text": t or ""} for r, t in turns])
        assert got[c].formatted_chars == len(text)
    whole = {}
    for r in sorted(C.format_conversations(df).collect(), key=lambda r: (r.conv_id, r.chunk)):
        whole.setdefault(r.conv_id, ["", ""])
        whole[r.conv_id][0] += r.formatted
        whole[r.conv_id][1] += "".join(C.unprotect(r.formatted[s.start:s.end]) for s in r.loss_spans)
    for c, turns in convs.items():
        if c >= 0:
            assert len(whole[c][0]) == got[c].formatted_chars
            assert whole[c][1] == "".join(t or "" for r, t in turns if r == "assistant")


def test_template_runs_once_over_a_long_conversation(spark, monkeypatch):
    template = ("BEGIN{% set n = 'x' %}{% for m in messages %}{{ loop.index }}{% if loop.first %}^{% endif %}"
                "{% generation %}{{ m.text }}{% endgeneration %}{% endfor %}END")
    turns = {1: [("user", f"turn {i} " + "long " * 50_000) for i in range(12)], 2: [("user", "")]}
    rows = [(c, i, r, t) for c, ts in turns.items() for i, (r, t) in enumerate(ts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = sorted(C.format_conversations(df, template).collect(), key=lambda r: (r.conv_id, r.chunk))
    assert sum(r.conv_id == 1 for r in out) > 1
    program = C.compile_template(template)
    for c, ts in turns.items():
        want, spans = C.render(program, [{"role": r, "text": t} for r, t in ts])
        mine = [r for r in out if r.conv_id == c]
        assert [r.chunk for r in mine] == list(range(len(mine)))
        assert "".join(r.formatted for r in mine) == want
        assert "".join(r.formatted[s.start:s.end] for r in mine for s in r.loss_spans) == "".join(
            want[a:b] for a, b in spans)


def test_a_failing_program_fails_the_output():
    def produce(give):
        give(1)
        raise ValueError("broken")
    got = C._pulled(produce)
    assert next(got) == 1
    with pytest.raises(ValueError, match="broken"):
        next(got)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.digests(df).collect() == []
    assert [r.conv_id for r in C.digests(C.with_probe(df)).collect()] == [-1]


def show(source, **values):
    parts = []
    C.compile_template(source)(values, lambda t, g: parts.append(f"<{t}>" if g else t))
    return "".join(parts)


def test_language():
    assert show("a{{ 'b' ~ (1 + 2) }}c") == "ab3c"
    assert show("{% set x = 'q' %}{{ x | upper }}{# no #}!") == "Q!"
    assert show("{% if a == 1 %}one{% elif not a %}none{% else %}many{% endif %}", a=2) == "many"
    assert show("{% for m in ms %}{% if loop.first %}^{% endif %}{{ m.t }}{{ m['u'] }},{% endfor %}",
                ms=[{"t": "a", "u": 1}, {"t": "b"}]) == "^a1,b,"
    assert show("{% generation %}{{ x }}{% endgeneration %}.", x="y") == "<y>."
    assert show("a  {%- if true -%}  b  {%- endif %} c") == "ab c"


def test_folding():
    tree = C.fold_tree(C.parse("a{{ 'b' ~ 'c' | upper }}{% if 1 == 2 %}x{% else %}y{% endif %}z"))
    assert tree == [("text", "abCyz")]
    assert C.fold_expr(("and", ("const", False), ("name", "x"))) == ("const", False)


@pytest.mark.parametrize("bad", ["{{ x.__class__() }}", "{% for x %}", "{% if a %}", "{{ }}",
                                 "{{ a | eval }}", "{% endif %}", "{{ 'a' 'b' }}", "{% import os %}"])
def test_refused(bad):
    with pytest.raises(C.TemplateError):
        C.compile_template(bad)


def test_sandbox_reaches_mappings_only():
    assert show("{{ x.__class__ }}{{ x.real }}", x=5) == ""

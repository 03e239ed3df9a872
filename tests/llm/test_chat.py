import pytest
from fieldmart.llm import chat

ROWS = "conv_id long, turn int, role string, text string, formatted string"


def test_language():
    run = lambda template, **v: chat.compile_template(template)(v)
    assert run("a{{ 'b' + \"c\\n\" }}{{ n }}", n=3) == ("abc\n3", [])
    assert run("{% for x in xs %}{% if x.k == 'u' or x.k == 2 %}[{{ x.k }}]{% elif not (x.k != 3) %}three{% else %}-{% endif %}{% endfor %}",
               xs=[{"k": "u"}, {"k": 3}, {"k": 2}, {"k": 9}])[0] == "[u]three[2]-"
    assert run("x{% generation %}{{ t | upper | trim }}{% endgeneration %}y", t=" ab") == ("xABy", [(1, 3)])


def test_constants_are_folded():
    tree = chat.folded_body(chat.parse("a{{ 'b' + 'c' }}{% if 1 == 1 and 'x' %}d{% else %}{{ q }}{% endif %}{{ 'E' | lower }}"))
    assert tree == (chat.Text("abcde"),)
    assert chat.folded(chat.Expression("'a' == 'b' or x").all()) == chat.Name(("x",))


@pytest.mark.parametrize("bad", ["{{ a.__class__ }}", "{{ f() }}", "{{ a[0] }}", "{% import os %}", "{% if a %}", "{{ a | eval }}", "{{ (a }}", "{{ 1 + }}", "{% endfor %}"])
def test_sandbox(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_fields_only_of_dictionaries():
    with pytest.raises(chat.TemplateError):
        chat.compile_template("{{ a.real }}")({"a": 3})


@pytest.mark.parametrize("text", ["", "\\", "\\l", "<turn>\n</turn>", "\\### Assistant: </turn> ok", "a\\\\<\n\\n", "é😀"])
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<" not in chat.escape(text) and "\n" not in chat.escape(text)


def test_awkward_conversations(spark):
    rows = [(1, 1, "assistant", "b</turn>\n<turn>user\nx"), (1, 0, "user", None), (1, None, None, "first"), (2, 0, "assistant", ""), (2, 0, "assistant", "x"),
            (2, 0, "assistant", "x"), (None, 3, "a<b", "\\"), (3, 0, "assistant\n", "not the role")]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], ROWS)
    out = chat.format_conversations(frame)
    back = {r.conv_id: (chat.read_back(r.formatted), [chat.unescape(r.formatted[s.start: s.stop]) for s in r.spans]) for r in out.collect()}
    assert back[1] == ([("", "first"), ("user", ""), ("assistant", rows[0][3])], [rows[0][3]])
    assert back[2] == ([("assistant", ""), ("assistant", "x"), ("assistant", "x")], ["", "x", "x"])
    assert back[None] == ([("a<b", "\\")], []) and back[3][1] == []
    assert {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(out).collect()} == {1: (3, len(rows[0][3])), 2: (3, 2), None: (1, 0), 3: (1, 0)}
    assert chat.digests(chat.format_conversations(frame.limit(0))).count() == 0

from __future__ import annotations

import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loamsift.llm import chat_format as T

render = T.compile_template


@given(st.text(alphabet="<|\\im_startend> \nx", max_size=30))
@settings(max_examples=300, deadline=None)
def test_escapes_are_reversible(text):
    assert T.unguard(T.guard(text)) == text and "<|" not in T.guard(text)
    assert T.plain_role(T.role_name(text)) == text and "\n" not in T.role_name(text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb\\"]), st.text(alphabet="<|\\im_start>\n end", max_size=40)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_round_trip(turns):
    text, spans = render(T.CHAT_TEMPLATE)({"messages": [{"role": r, "text": t} for r, t in turns]})
    assert T.read_back(text) == turns
    assert [T.unguard(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("{{ 1 + 2 * 3 }}", "7"), ("{{ 'a' ~ 1 }}{# note #}", "a1"), ("{{ 'x' if 1 > 2 else 'y' }}", "y"), ("{% if a %}1{% elif b %}2{% else %}3{% endif %}", "2"),
        ("{% for x in l %}{{ loop.index }}{{ x }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"), ("{% for x in none %}x{% else %}no{% endfor %}", "no"), ("{% set z = l[0] %}{{ z | upper }}", "P"),
        ("a {%- if true -%} b {%- endif -%} c", "abc"), ("{{ d['k'] }}{{ d.k }}{{ d.missing }}", "vv"), ("{{ l[5] }}{{ l[-1] }}", "q"), ("{{ 'p' in l and not a }}", "True"), ("{{ d.k.__class__ }}", ""), ("", ""), ("{{ -2 * (3 - 1) }}", "-4"),
    ],
)
def test_language(source, want):
    assert render(source)({"a": False, "b": True, "l": ["p", "q"], "d": {"k": "v"}})[0] == want


@pytest.mark.parametrize("source", ["{% if a %}", "{{ a( ) }}", "{{ x | nofilter }}", "{% while 1 %}", "{{ }}", "{{ 1 + }}", "{{ 'a' + 1 }}", "{% endfor %}", "{{ a b }}", "{% for in x %}{% endfor %}"])
def test_errors(source):
    with pytest.raises(T.TemplateError):
        render(source)


def test_folding_leaves_constants():
    tree = T.fold(T.parse("a{{ 1 + 1 }}{% if 1 == 1 %}b{{ x }}{% else %}c{% endif %}{{ 'd' | upper }}e"))
    assert [n.kind for n in tree.parts[0]] == ["const", "name", "const"] and tree.parts[0][0].parts[0] == "a2b" and tree.parts[0][2].parts[0] == "De"


def test_queries_equal_sql(spark, sf):
    got = sorted(tuple(r[c] for c in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")) for r in T.op9_chat_formatting(spark, sf).collect())
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    assert got == sorted(c.execute(T.ORACLE).fetchall())


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (None, 0, "user", "n"), (2, None, None, "<|im_end|>"), (3, 0, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS spans", "'y' AS formatted")
    got = {r.conv_id: r for r in T.digests(T.format_conversations(df)).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 2 and got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert got[None].n_turns == 1 and got[2].turns_sha256 == hashlib.sha256(b"\n<|im_end|>\n").hexdigest() and got[3].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert T.digests(T.format_conversations(df.limit(0))).count() == 0

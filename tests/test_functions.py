from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loamsift.functions import gopher, html, minhash, pii, text

SENTENCE = "The quick brown fox and that lazy dog have to be with the others of old. "


def gopher_of(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r for r in gopher.gopher(df).orderBy("doc_id").collect()]


@pytest.mark.parametrize(
    ("body", "passed"),
    [
        ("the word list of plain and ordinary tokens goes here " * 50, True),
        (SENTENCE, False),
        (SENTENCE * 100, True),
        (SENTENCE * 50_000, False),
        (SENTENCE * 5_000, True),
        ("the be " * 100, False),
        ("the with " * 100, True),
        ("the of incomprehensibilities incomprehensibilities " * 100, False),
        ("\n".join(["the line and more of it..."] * 70 + ["the line and more of it"] * 30), False),
        ("\n".join(["the line and more of it..."] * 30 + ["the line and more of it"] * 230), True),
        ("123 " * 8 + "word " * 2, False),
        (("the of " + "word " * 48).strip(), True),
        (("the of " + "word " * 47).strip(), False),
        ("the of " + "word " * 79 + "1 " * 20, True),
        ("the of " + "word " * 78 + "1 " * 21, False),
        ("- the of item\n" * 100, False),
        ("# " * 9 + "the of word " * 30, True),
        ("# " * 12 + "the of word " * 30, False),
    ],
)
def test_gopher_rules(spark, body, passed):
    assert gopher_of(spark, body)[0].passed is passed


def test_gopher_empty_null_and_bounds(spark):
    empty, null, blank, low, high = gopher_of(spark, "", None, " \n ", "the of " + "word " * 99_998, "the of " + "word " * 99_999)
    assert empty.failed_checks == null.failed_checks == ["empty_or_invalid"]
    assert blank.reason == "word_count" and blank.mean_word_length == 0.0
    assert low.passed and high.failed_checks == ["word_count"]


@pytest.mark.parametrize(
    ("kind", "body", "masked", "n"),
    [
        ("emails", "Feel free to contact me at test@gmail.com if so.", "Feel free to contact me at |||EMAIL_ADDRESS||| if so.", 1),
        ("emails", "a@fakedomain.ai b@fakedomain.ai", "|||EMAIL_ADDRESS||| |||EMAIL_ADDRESS|||", 2),
        ("emails", "|||EMAIL_ADDRESS||| a@x.de, b@x.de", "|||EMAIL_ADDRESS||| |||EMAIL_ADDRESS|||, |||EMAIL_ADDRESS|||", 2),
        ("phones", "call 2831823829 now", "call |||PHONE_NUMBER||| now", 1),
        ("phones", "(283)-182-3829", "|||PHONE_NUMBER|||", 1),
        ("phones", "(283) 182 3829", "|||PHONE_NUMBER|||", 1),
        ("phones", "283-182-3829", "|||PHONE_NUMBER|||", 1),
        ("phones", "283 182 3829", "|||PHONE_NUMBER|||", 1),
        ("phones", "٢٨٣١٨٢٣٨٢٩", "|||PHONE_NUMBER|||", 1),
        ("ips", "IP 192.0.2.146.", "IP |||IP_ADDRESS|||.", 1),
        ("ips", "300.1.1.1", "300.1.1.1", 0),
        ("ips", None, "", 0),
    ],
)
def test_masks(spark, kind, body, masked, n):
    m, c = pii.mask(F.col("t"), kind)
    assert tuple(spark.createDataFrame([(body,)], "t string").select(m, c).first()) == (masked, n)


def test_mask_all_in_order(spark):
    row = pii.mask_all(spark.createDataFrame([("a@b.co 283-182-3829 10.0.0.1 1.2.3.4.5",)], "text string")).first()
    assert row.text == "|||EMAIL_ADDRESS||| |||PHONE_NUMBER||| |||IP_ADDRESS||| |||IP_ADDRESS|||.5"
    assert (row.n_emails, row.n_phones, row.n_ips, row.n_total) == (1, 1, 2, 4)


@pytest.mark.parametrize(
    ("body", "kind"),
    [(None, "empty"), ("", "empty"), ("<!DOCTYPE html>", "full_html"), ("x" * 2000 + "<html>", "plain_text"), (" <?xml?>", "xml"), ("<P>x", "partial_html"), ("<foo>\nbar</foo>", "generic_tags"), ("1 < 2", "plain_text")],
)
def test_html_type(spark, body, kind):
    assert spark.createDataFrame([(body,)], "t string").select(html.html_type(F.col("t"))).first()[0] == kind


PAGE = """<html><head><title>no</title><script>var x="<p>";</script></head><body><div><h1>A  Title</h1>
<p> one <b>two</b>
three</p><img src="x"/><p>A <a href="#">link</a>.</p><ul><li>First</li><li>Second</li></ul></div></body></html>"""


def test_extract():
    assert html.extract_text(PAGE) == "A Title\n\none two three\n\nA link.\n\n  • First\n  • Second"
    assert html.extract_text(b"") is None and html.extract_text(None) is None
    assert html.extract_text("<html></html>") == ""
    assert html.extract_text("<p>\xe9</p>".encode("latin-1")) == "é"
    assert html.extract_text("<head><title>t</title><body>x") == "x"


def test_extract_column(spark):
    df = spark.createDataFrame([("<p>a</p>",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(html.extracted_or_original(F.col("t"))).collect()] == ["a", None, ""]


def test_text_columns(spark):
    df = spark.createDataFrame([(" a b\x1c c\n",), ("",), (None,)], "t string")
    got = df.select(text.collapse(F.col("t")), text.words(F.col("t")), text.truncate_words(F.col("t"), 2)).collect()
    assert tuple(got[0]) == ("a b c", ["a", "b", "c"], "a b") and tuple(got[1]) == ("", [], "") and got[2][0] is None


def test_normalize():
    assert text.normalize_text("Écoute,  le_Monde!  «été»") == "ecoute lemonde ete"
    assert text.normalize_text(" \n") == ""


@pytest.mark.parametrize(("own", "want"), [([], []), (["a"], ["a"]), (["a", "b"], ["a b"]), (["a", "b", "a", "b"], ["a b", "b a"])])
def test_ngrams(spark, own, want):
    assert spark.createDataFrame([(own,)], "w array<string>").select(text.word_ngrams(F.col("w"), 2)).first()[0] == want


def signature_of(sets, family):
    first = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
    return minhash.signature_rows(np.array([x for own in sets for x in own], np.uint64), first, family).tolist()


@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=40), max_size=6), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_signature_is_its_definition(sets, size):
    family = minhash.hash_family(size)
    assert signature_of(sets, family) == [minhash.scalar_signature(own, family) for own in sets]


def test_signature_edges():
    """Extreme numbers, extreme hash functions, empty sets between others, and sets that cross from one block of numbers to the next."""
    rng = random.Random(0)
    family = [*minhash.hash_family(60), (1, 0), (minhash.PRIME - 1, minhash.PRIME - 1), (1, minhash.PRIME - 1), (1 << 31, 1), ((1 << 31) - 1, 0)]
    cases = [[], [0], [2**64 - 1], [2**61 - 1], [], [2**61 - 2, 2**61, 2**63, 1]] + [[rng.getrandbits(64) for _ in range(rng.randint(1, 3000))] for _ in range(5)]
    assert signature_of(cases, family) == [minhash.scalar_signature(own, family) for own in cases]
    long_ = [[5], [rng.getrandbits(64) for _ in range(minhash.AT_ONCE + 10)], [], [7, 8]]
    assert signature_of(long_, family[:3]) == [minhash.scalar_signature(own, family[:3]) for own in long_]


def plain_metrics(t):
    import re

    tokens = re.findall(r"[A-Za-z]+(?:'[A-Za-z]+)*|[0-9]+(?:\.[0-9]+)*|\S", t)
    own = [x for x in tokens if re.search("[A-Za-z]", x)]
    rows = [x.strip() for x in t.split("\n") if x.strip()]
    n, m = len(own), len(rows)
    per = lambda a, b: a / b if b else 0.0
    return (
        n, per(sum(map(len, own)), n), per(t.count("#"), n), per(t.count("...") + t.count("…"), n), per(sum(bool(re.match("[-•●○▪▸►◦*→⁃‣⦿⦾]", x)) for x in rows), m),
        per(sum(x.endswith(("...", "…")) for x in rows), m), per(n, len(tokens)), len({x.lower() for x in own} & {"the", "be", "to", "of", "and", "that", "have", "with"}),
    )


def test_gopher_metrics_are_their_definition(spark):
    rng = random.Random(9)
    parts = ["the", "The", "of", "BE", "to'", "'", "a", "Z", "12", "1.5", ".", "..", "...", "…", "#", "-", "•", "*", " ", "  ", "\n", "\n\n", "\t", "\x1c", " ", "é", "K", "ſ", "\r", " ", "that's", "with"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(800)]
    for r, t in zip(gopher_of(spark, *texts), texts, strict=True):
        assert tuple(r[m] for m in gopher.METRICS) == pytest.approx(plain_metrics(t), abs=1e-12), repr(t)

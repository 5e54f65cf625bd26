from __future__ import annotations

import json
import os
import random
import re
import time
from datetime import datetime

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docweave.functions import dates as D
from docweave.functions import paths as P
from docweave.functions import pii
from docweave.functions.replace import Replacer, independent, replace_strings

AS_OF = datetime(2024, 5, 20, 13, 30)


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first().y


REPLACE = [
    (["old_string"], "new_string", "This is a text blob with old_string.", "This is a text blob with new_string."),
    (["old_string1", "old_string2"], "new_string", "with old_string1 and old_string2.", "with new_string and new_string."),
    (["old_string"], "new_string", "no match here", "no match here"),
    ([], "new_string", "This is a text blob with old_string.", "This is a text blob with old_string."),
    (["old_string"], "new_string", "", ""),
    (["old_string!"], "new_string?", "with old_string!.", "with new_string?."),
    (["a", "b"], "b", "a b", "b b"),
    (["a", "c"], "c!", "a", "c!!"),
    (["a.b"], "-", "A.B axb", "- axb"),
    (["K", "S", "é", "σ"], "_", "K ſ É ς", "_ _ _ _"),
    (["x\\Ey"], "_", "1x\\EY2", "1_2"),
    (["", None, "  "], "_", "abc", "abc"),
    (["a"], "$1", "a", "$1"),
]


@pytest.mark.parametrize(("targets", "new", "text", "want"), REPLACE)
def test_replace(spark, targets, new, text, want):
    assert one(spark, text, Replacer(targets, new).replace(F.col("x"))) == want


def test_replace_blank_kept(spark):
    assert one(spark, "abc", replace_strings(F.col("x"), [""], "X", keep_blank=True)) == "XaXbXcX"


def test_replace_refuses_templates():
    with pytest.raises(ValueError):
        replace_strings(F.lit("a"), ["a"], "\\1")


def test_replace_long_list(spark):
    targets = [f"t{i}x" for i in range(300)] + ["t5"]
    text = "T5X t17x t299x t5 t6"
    want = text
    for t in targets:
        want = re.sub(re.escape(t), "_", want, flags=re.IGNORECASE)
    assert one(spark, text, replace_strings(F.col("x"), targets, "_")) == want


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@example(["x", "ab"], "", "axb")
@given(st.lists(st.text("abAB.$", min_size=1, max_size=3), max_size=4), st.text("abx", max_size=2), st.text("abAB.$x", max_size=15))
def test_replace_equals_sequential(spark, targets, new, text):
    want = text
    for t in targets:
        want = re.sub(re.escape(t), lambda _: new, want, flags=re.IGNORECASE)
    assert one(spark, text, replace_strings(F.col("x"), targets, new)) == want


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab", min_size=1, max_size=3), min_size=2, max_size=4), st.text("abx", max_size=15))
def test_deleting_equals_sequential(spark, targets, text):
    want = text
    for t in targets:
        want = re.sub(re.escape(t), "", want, flags=re.IGNORECASE)
    assert one(spark, text, replace_strings(F.col("x"), targets, "")) == want


_PARTS = ["2001-02-03", "2001-02-30", "1999-12-31", "3/4/2021", "12/31/1999", "02/30/2020", "13/02/2020", "12:30", "7", "pm", "at", "a", "T", "Z", "h", "May", "mon", "remark", " ", " ", " ", ", ", ". ", "-", "/", "(", ")", "UTC", "+"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(_PARTS), max_size=7).map("".join))
def test_plain_dates_are_what_the_parser_reads(text):
    assert D.parse_fuzzy(text, AS_OF) == D._parsed(text, AS_OF)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["jan", "May", "remark", "sun", "sunny", "é", ".", " ", "_", "sept", "tues", "x"]), max_size=5).map("".join))
def test_texts_without_a_name_hold_no_date(text):
    names = D.MAY_HOLD_DATE.replace(r"\p{Nd}", r"\d").replace(r"\p{L}", r"[^\W\d_]")
    assert re.search(names, text) or D._parsed(text, AS_OF) is None


def test_independent():
    assert independent(["abc", "xyz"], "<>") and not independent(["abc", "cde"], "<>") and not independent(["abc", "x"], "axb") and not independent(["ab", "abc"], "")


NAMES = ["/a/b/scan.pdf", "scan", "/a.b/scan", ".hidden", "/x/.hidden.txt", "a.tar.gz", "/a/b/", "é.漢.pdf"]


@pytest.mark.parametrize("name", NAMES)
def test_stem(spark, name):
    base, end = os.path.splitext(os.path.basename(name))
    assert one(spark, name, P.stem(F.col("x"))) == base
    assert one(spark, name, P.extension(F.col("x"))) == end
    assert one(spark, name, P.dirname(F.col("x"))) == os.path.dirname(name)


def test_subject(spark):
    get = lambda d: one(spark, d, P.subject_id(F.col("x")))
    assert get("/s/094-123456/094-999999") == "094-123456" and get("/s/094-12345/x") is None and get("/s/1094-1234567") == "094-123456"


def test_output_path(spark):
    path = P.output_path("output", "list_replacement_output_file", "document", F.concat(P.stem(F.col("x")), F.lit(".txt")))
    assert one(spark, "test.txt", path) == "output/list_replacement_output_file/document/test.txt"


def test_input_choice(spark):
    rows = spark.createDataFrame([(None, "o"), ("", "o"), ("r", "o"), (None, None)], "r string, o string")
    assert [x.y for x in rows.select(P.text_input(F.col("r"), F.col("o")).alias("y")).collect()] == ["o", "o", "r", None]


def spans(spark, text, **kw):
    return [tuple(s) for s in one(spark, text, pii.detect(F.col("x"), **kw))]


def test_detect(spark):
    text = "é漢 a.b@x.org at 10.0.0.300 or 10.0.0.3, +1 (555) 123-4567; 4111 1111 1111 1111 / 4111 1111 1111 1112 id 094-123456"
    found = spans(spark, text)
    assert {(e, text[a:b]) for e, a, b, _ in found} == {("EMAIL_ADDRESS", "a.b@x.org"), ("IP_ADDRESS", "10.0.0.3"), ("PHONE_NUMBER", "+1 (555) 123-4567"), ("CREDIT_CARD", "4111 1111 1111 1111"), ("ID", "094-123456")}
    assert found == sorted(found, key=lambda s: (s[1], s[2], s[0]))
    assert spans(spark, None) == [] and spans(spark, "") == []


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("GB82WEST12345698765432", "IBAN_CODE"), ("GB83WEST12345698765432", None), ("DE89370400440532013000", "IBAN_CODE"), ("536-90-4399", "US_SSN"), ("666-12-3456", None),
        ("912-12-3456", None), ("536-00-4399", None), ("536-90-0000", None), ("555-123-4567", "PHONE_NUMBER"), ("(555) 123-4567", "PHONE_NUMBER"), ("+1 (555) 123-4567", "PHONE_NUMBER"), ("+1-555-123-4567", "PHONE_NUMBER"),
    ],
)
def test_checked_numbers(spark, text, want):
    found = one(spark, f"é {text}.", pii.detect(F.col("x")))
    assert [(s.entity, s.start, s.end) for s in found] == ([(want, 2, 2 + len(text))] if want else [])


def test_thresholds(spark):
    schema = "array<struct<entity:string,start:int,end:int,score:double>>"
    rows = spark.createDataFrame([([("A", 0, 1, 0.45), ("A", 1, 2, 0.44), ("IN_PAN", 2, 3, 1.0)],)], f"s {schema}")
    assert [x.start for x in rows.select(pii.keep_spans(F.col("s"), 0.45).alias("y")).first().y] == [0]


def test_resolve_and_redact(spark):
    schema = "array<struct<entity:string,start:int,end:int,score:double>>"
    rows = spark.createDataFrame([("abcdefghij", [("A", 0, 4, 0.5), ("B", 2, 6, 0.9), ("C", 5, 7, 0.9), ("D", 7, 9, 0.1), ("E", 7, 10, 0.1)])], f"x string, s {schema}")
    kept = pii.resolve(F.col("s"))
    out = rows.select(kept.alias("k"), pii.redact(F.col("x"), kept).alias("y")).first()
    assert [s.entity for s in out.k] == ["B", "E"] and out.y == "ab<B>g<E>"


def test_record(spark):
    schema = "array<struct<entity:string,start:int,end:int,score:double>>"
    rows = spark.createDataFrame([("é1\n2 z", [("A", 1, 4, 0.5)])], f"x string, s {schema}")
    got = json.loads(rows.select(F.to_json(pii.record(F.col("x"), F.col("s"))).alias("y")).first().y)
    assert got == [{"Original Text": "12", "Type": "A", "Start": 1, "End": 4, "Score": 0.5}]


def test_model_spans_and_labels(spark):
    model = F.array(F.struct(F.lit("PERSON").alias("entity"), F.lit(0).alias("start"), F.lit(3).alias("end"), F.lit(0.9).alias("score")))
    text = "Ann a@b.org"
    assert one(spark, text, pii.scrub(F.col("x"), model_spans=model)[0]) == "<PERSON> <EMAIL_ADDRESS>"
    rows = spark.createDataFrame([("HCW",), ("O",), ("ID",), ("new",)], "x string")
    assert [r.y for r in rows.select(pii.map_label(F.col("x")).alias("y")).collect()] == ["PERSON", None, "ID", "new"]


FUZZY = [
    ("Visit on 3/4/2021 was short", datetime(2021, 3, 4)),
    ("May", datetime(2024, 5, 20)),
    ("12:30", datetime(2024, 5, 20, 12, 30)),
    ("01/02/03", datetime(2003, 1, 2)),
    ("13/02/2020", datetime(2020, 2, 13)),
    ("2020-01-01T10:00:00+05:00", datetime(2020, 1, 1, 10)),
    ("nothing here", None),
    ("", None),
    (None, None),
    ("Visit on 3/4/2021 and 3/9/2021", None),
]


@pytest.mark.parametrize(("text", "want"), FUZZY)
def test_fuzzy(spark, text, want):
    assert one(spark, text, D.fuzzy_date(F.col("x"), AS_OF)) == want


def test_find_dates():
    tree = {"a": ["2020-01-02", {"b": "none", "c": "2021-03-04"}], "d": 5, "e": "2009-01-01"}
    assert D.find_dates(tree, None, None, AS_OF) == [datetime(2020, 1, 2), datetime(2021, 3, 4)]
    assert D.find_dates("2020-01-02", datetime(2020, 1, 2), datetime(2020, 1, 2), AS_OF) == [datetime(2020, 1, 2)]
    assert D.find_dates("2020-01-02 10:00", None, datetime(2020, 1, 2), AS_OF) == []


def test_json_dates(spark):
    rows = spark.createDataFrame([('{"a": ["2020-01-02"]}',), ("not json",), (None,)], "text string")
    assert [r.dates for r in D.json_dates(rows, AS_OF).collect()] == [[datetime(2020, 1, 2)], [], []]


def test_lines(spark):
    rows = spark.createDataFrame([("a\r\nb\rc\n\nd\n",), ("",), ("x",)], "text string")
    assert [(r.line, r.text) for r in D.lines(rows).collect()] == [(0, "a"), (1, "b"), (2, "c"), (3, ""), (4, "d"), (0, "x")]


def test_strict_dates(spark):
    assert one(spark, "2020-02-30 x2020-01-02y 2020-01-03-12020-01-04", D.strict_dates(F.col("x"))) == [datetime(2020, 1, 2), datetime(2020, 1, 3)]


def test_bounds(spark):
    rows = spark.createDataFrame([(datetime(2010, 1, 1), None), (datetime(2009, 12, 31), None), (datetime(2020, 1, 2, 10), datetime(2020, 1, 2)), (AS_OF, None)], "d timestamp_ntz, high timestamp_ntz")
    assert [r.y for r in rows.select(D.within(F.col("d"), None, F.col("high"), AS_OF).alias("y")).collect()] == [True, False, False, True]


def test_first_position(spark):
    rows = spark.createDataFrame([(1, "x", 5), (1, "x", 2), (1, "y", 3)], "k int, date string, pos int")
    assert sorted(tuple(r) for r in D.distinct_dates(rows, ["k"]).collect()) == [(1, "x", 2), (1, "y", 3)]


def test_detection_tries_patterns_only_where_they_can_match(spark):
    """Long runs of letters cost nothing, though the text holds a mail address: the mail pattern needs their square."""
    text = "x" * 150_000 + " me@mail.org " + "y" * 150_000
    began = time.monotonic()
    assert one(spark, text, F.to_json(pii.detect(F.col("x")))) == '[{"entity":"EMAIL_ADDRESS","start":150001,"end":150012,"score":1.0}]'
    assert time.monotonic() - began < 8


def test_detection_equals_patterns_over_the_whole_text(spark):
    rng = random.Random(5)
    bits = ["555", "1234", "4111", "1111", "094-123456", "2001-02-03", "10.0.0.1", "a@b.org", "_d@e.fr", "http", "s://", "?c=", "GB82WEST12345698765432", "536-90-4399", "+1", "(555)", "word", "é", "😀", " ", " ", " ", "-", ".", ":", "\n", "  ", ")", "(", "@", "Ab"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    whole = F.array_sort(F.transform(F.concat(*[pii.pattern_spans(F.col("x"), *r) for r in pii.RECOGNISERS]), lambda s: F.struct(s["start"], s["end"], s["entity"], s["score"])))
    found = F.transform(pii.detect(F.col("x")), lambda s: F.struct(s["start"], s["end"], s["entity"], s["score"]))
    out = rows.select("x", F.size(found).alias("n"), (F.to_json(found) == F.to_json(whole)).alias("same")).collect()
    assert [r.x for r in out if not r.same] == [] and sum(r.n for r in out) > 2000

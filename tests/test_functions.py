from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from logstrata.functions import jsontext, kv, pytext, xmltext

VALID = [
    "{}", "[]", "400", "-1.5e3", '"x"', "true", "null", '{"a": {"b": [1, {"c": 2}]}}', ' {"a":1}\t', '{"a:b": "c:d"}',
    '{"q": "\\"}]{["}', '{"u": "\\u00e9 é 😀"}', '{"a": 1, "a": 2}', '{"n": NaN, "i": [-Infinity, Infinity]}', "NaN", '"NaN"',
    '{"~~~~": "~~~~~~~~~~~~"}',
]
INVALID = [
    "", " ", "{", "{'a': 1}", '{"a":1} x', '{"a":1}] x', "1,2", '1,"b":2', '{"a":1},{"b":2}', '{"a":01}', "tru", "true false",
    '"a" "b"', '{"a":1}\n{"b":2}', '1NaN', '[1,]', '{"a":1,}', '"\x01"', '1,"~"] x', '1,"~~~~~~~~~~"] [', "NaN x", "{NaN}",
]


def column(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in rows.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def python_json(text):
    try:
        json.loads(text)
        return True
    except json.JSONDecodeError:
        return False


def test_is_json_agrees_with_a_strict_parser(spark):
    texts = VALID + INVALID
    assert column(spark, texts, jsontext.is_json) == [python_json(t) for t in texts]
    assert all(python_json(t) for t in VALID) and not any(python_json(t) for t in INVALID)


def test_count_fields_counts_nested_pairs_once(spark):
    assert column(spark, VALID, jsontext.count_fields) == [0, 0, 0, 0, 0, 0, 0, 3, 1, 1, 1, 1, 1, 2, 0, 0, 1]


def test_count_fields_of_very_long_strings(spark):
    text = json.dumps({"a": 'x\\"' * 100_000, "b": {"c": ":" * 100_000}})
    assert column(spark, [text], jsontext.count_fields) == [3]


def test_record_to_json_writes_the_standard_layout(spark):
    texts = [t for t in VALID if "NaN" not in t and "1.5e3" not in t and '"a": 2' not in t]
    assert column(spark, texts, jsontext.record_to_json) == [json.dumps(json.loads(t)) for t in texts]


def test_record_to_json_is_stable_on_its_own_output(spark):
    once = column(spark, ['{"é":[1,{"b" :"x, y: z"}],"c":"\\"\\\\"}'], jsontext.record_to_json)
    assert column(spark, once, jsontext.record_to_json) == once == ['{"\\u00e9": [1, {"b": "x, y: z"}], "c": "\\"\\\\"}']


@pytest.mark.parametrize(
    ("event", "expected"),
    [
        ('{"message":"{\\"a\\":1}"}', {"a": 1}),
        ('{"json":{"z":1,"a":2}}', {"z": 1, "a": 2}),
        ('{"@timestamp":"x","ecs":{"v":1}}', None),
        ('{"@timestamp":"x","json":{"z":{"y":1,"x":2}},"tags":["f"],"s":"5"}', {"json": {"z": {"y": 1, "x": 2}}, "tags": ["f"], "s": "5"}),
        ('{"message":"<1> raw"}', None),
        ('{"message":"{}"}', {}),
        ('{"message":"[1]"}', None),
        ('{"message":5}', None),
        ('{"a":null,"b":"x\\"y"}', {"a": None, "b": 'x"y'}),
        ("400", None),
        ('"{\\"a\\": 1}"', None),
        ("{}", None),
    ],
)
def test_normalize_event(spark, event, expected):
    (got,) = column(spark, [event], jsontext.normalize_event)
    assert (got is None) == (expected is None)
    if got is not None:
        assert json.loads(got) == expected and list(json.loads(got)) == list(expected)


def test_kv_tokens_and_unquote(spark):
    line = "pid=1 old-auid=2 comm=\"a b\" msg='op=x acct=\"r\"' e= k.v=3\x1dARCH=x86 é=1 a=\"q\"b=2 q=\" z='"
    (got,) = column(spark, [line], lambda t: F.to_json(kv.kv_map(t)))
    expected = {
        "pid": "1", "old-auid": "2", "comm": "a b", "msg": 'op=x acct="r"', "k.v": "3", "ARCH": "x86", "é": "1", "a": "q", "b": "2",
        "q": '"', "z": "'",
    }
    assert json.loads(got) == expected and list(json.loads(got)) == list(expected)
    values = ['"a"', "'a'", "\"a'", '"', '""', "a", ""]
    assert column(spark, values, kv.unquote) == ["a", "a", "\"a'", '"', "", "a", ""]


def test_capture_without_a_match_and_with_the_mark_in_the_text(spark):
    regex = r"(?s)\A(a+)-(b*)\z"
    texts = ["aa-b", "a-", "x", "a-b\x01"]
    assert column(spark, texts, lambda t: pytext.capture(t, regex, 2)) == [["aa", "b"], ["a", ""], None, None]
    dotted = r"(?s)\A(.)-(.*)\z"
    assert column(spark, ["a-\x01z"], lambda t: pytext.capture(t, dotted, 2)) == [["a", "\x01z"]]


def test_escape_bare_amp(spark):
    texts = ["2>&1 &amp; &lt;&gt;&quot;&apos; &#10;&#xAf; &copy; &#; &#x; &"]
    assert column(spark, texts, xmltext.escape_bare_amp) == [
        "2>&amp;1 &amp; &lt;&gt;&quot;&apos; &#10;&#xAf; &amp;copy; &amp;#; &amp;#x; &amp;"
    ]


def test_xml_to_json_shapes(spark):
    documents = [
        b"<Event xmlns='u'><A/><B x='1'>t</B><C>1</C><C>2</C><C k='v'/></Event>",
        b"<Event Name='n'><Name>m</Name> text </Event>",
        b"<Event><broken</Event>",
        b"<Event/>",
        "<Event>é\n 04688 </Event>".encode(),
        b"<Event>\xff</Event>",
    ]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "i int, d binary")
    got = [r["v"] for r in rows.select("i", xmltext.xml_to_json("d").alias("v")).orderBy("i").collect()]
    assert [g and json.loads(g) for g in got] == [
        {"Event": {"xmlns": "u", "A": None, "B": {"x": "1", "#text": "t"}, "C": ["1", "2", {"k": "v"}]}},
        {"Event": {"Name": ["n", "m"], "#text": "text"}},
        None,
        {"Event": None},
        {"Event": "é\n 04688"},
        None,
    ]


def test_names(spark):
    assert column(spark, ["a/b.zip", "b.tar.gz", ".zip"], pytext.stem_dir) == ["a/b", "b.tar", ".zip"]
    assert column(spark, ["a/b.json", ".json", "x", "a.b/c"], pytext.suffix) == [".json", "", "", ""]
    ids = spark.createDataFrame([(0, 7), (1, 99999), (2, 123456)], "i int, n int")
    assert [r["v"] for r in ids.select("i", pytext.shard_name(F.col("n")).alias("v")).orderBy("i").collect()] == [
        "00007.jsonl", "99999.jsonl", "123456.jsonl",
    ]


def test_strip_removes_unicode_blanks(spark):
    texts = ["   x y \x1c\n", "﻿z", " \t"]
    assert column(spark, texts, pytext.strip) == [t.strip() for t in texts]
    assert column(spark, texts, pytext.first_char) == ["x", "﻿", ""]


def long_values():
    """JSON values beyond what Spark's parser takes: a long document, string, number and name."""
    return [
        json.dumps([{"k": "v" * 20} for _ in range(900_000)]),
        json.dumps({"s": "x" * 25_000_000}),
        '{"n": ' + "7" * 1200 + "}",
        json.dumps({"k" * 60_000: {"b": 1}}),
    ]


def test_json_checks_have_no_size_limit(spark):
    texts = long_values()
    broken = [texts[0][:-1], texts[1] + " x", texts[2].replace("7}", "7.}"), texts[3] + "}"]
    assert len(texts[0]) > 25_000_000
    assert column(spark, texts + broken, jsontext.is_json) == [python_json(t) for t in texts + broken] == [True] * 4 + [False] * 4
    assert column(spark, texts, jsontext.count_fields) == [900_000, 1, 1, 2]


def test_events_of_any_size_are_normalized(spark):
    event = json.dumps({"@timestamp": "t", "message": '{"n": ' + "7" * 1200 + "}"})
    rows = spark.createDataFrame([(event,), ('{"message": "{\\"a\\": 1}"}',), ('{"message": "' + "x" * 2000 + '"}',)], "e string")
    found = {r["e"]: r["record_json"] for r in jsontext.normalized_events(rows, "e").collect()}
    assert [found[e["e"]] and json.loads(found[e["e"]]) for e in rows.collect()] == [{"n": int("7" * 1200)}, {"a": 1}, None]

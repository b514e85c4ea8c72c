import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import jsonx
from millrace.functions.clock import elapsed_ms, parse_rfc3339
from millrace.functions.text import md5_base64, plain_base64, presanitize


def sanitize_by_steps(text):
    """The clean-up as an ordered list of literal replacements."""
    out = text.strip('" \t\r\n')
    for letter, real in (("r", "\r"), ("n", "\n")):
        for many, few in ((4, 2), (2, 1)):
            out = out.replace("\\" * many + letter, "\\" * few + letter)
        out = out.replace("\\" + letter, real)
    out = out.replace("\r\n", "\r").replace("\n", "\r")
    return out.removeprefix("﻿")


def test_presanitize_cases(one):
    cases = {
        '"MSH|^~\\\\&|A\\rPID|1"': "MSH|^~\\\\&|A\rPID|1",
        "ISA*00~\\nGS*HC~\\nST*837~": "ISA*00~\rGS*HC~\rST*837~",
        '{\n "a": 1\r\n}': '{\r "a": 1\r}',
        "﻿MSH|": "MSH|",
        '  "x"  ': "x",
        "": "",
    }
    assert one(list(cases), presanitize) == list(cases.values())


def test_presanitize_equals_ordered_replacements(one):
    texts = ["a" + "\\" * k + letter + "b" + "\\" * j + other
             for k in range(7) for j in range(4) for letter in "rnx" for other in "rn\n"]
    texts += ["\\r\\n", "\\\\r\\\\n\\n", "\r\n\\r", '"\\"\\n"']
    assert one(texts, presanitize) == [sanitize_by_steps(t) for t in texts]


def test_presanitize_null(one):
    assert one([None], presanitize) == [None]


def test_escaped_newline_in_json_string_breaks_the_document(one):
    clean = one(['{"resourceType":"Patient","t":"a\\nb"}'], presanitize)
    assert one(clean, lambda c: jsonx.strict_document(c).isNotNull()) == [False]


STRICT = {
    '{"a":1}': True, ' [1, {"a":2}] ': True, '"s"': True, "null": True, "12": True, '{"a":1,"a":2}': True,
    '{"a":1} x': False, '{"a":1}}': False, '{"a":1}]': False, '{"a":1},{"b":2}': False, "": False, "{bad": False,
    "{'a':1}": False, '{"a":01}': False, '{"a":NaN}': False, '{"a":"x\ny"}': False, "1,2": False, "]": False, "1]": False,
}


def test_strict_document(one):
    assert one(list(STRICT), lambda c: jsonx.strict_document(c).isNotNull()) == list(STRICT.values())


def nested(depth, leaf='{"id":1}'):
    return '{"a":' * depth + leaf + "}" * depth


def has_key_by_walking(text, key, limit=10):
    try:
        level = [json.loads(text)]
    except ValueError:
        return False
    for _ in range(limit + 1):
        if any(isinstance(n, dict) and key in n for n in level):
            return True
        level = [c for n in level for c in (n.values() if isinstance(n, dict) else n if isinstance(n, list) else [])]
    return False


def test_key_search_depth_limit(one):
    texts = [nested(d) for d in range(14)] + ["[" * d + '{"id":1}' + "]" * d for d in range(14)]
    got = one(texts, lambda c: jsonx.json_has_key(c, "id"))
    assert got == [d <= 10 for d in range(14)] * 2


def test_key_search_is_not_fooled_by_strings(one):
    cases = {
        '{"a":"\\"id\\":1"}': False, '{"a":"id"}': False, '{"\\"id":1}': False, '{"a\\\\id":1}': False,
        '{"a":["x",{"id":null}]}': True, '{"i\\u0064":1}': True, '{"b":[{"i\\u0064":1}]}': True,
        '{"id" : 1}': True, '[1,"a",{"b":{"id":[]}}]': True, '"id"': False, '{"id":1': False, '{"a":{"id":1}} x': False,
        nested(3, '{"x":[[[[[[[[[[[]]]]]]]]]]],"y":{"id":1}}'): True,
        nested(3, '{"x":[[[[[[[[[[[{"id":1}]]]]]]]]]]]}'): False,
    }
    assert one(list(cases), lambda c: jsonx.json_has_key(c, "id")) == list(cases.values())


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.sampled_from(['id', '"id":', "\\", "{", "]", "é", "a\\\"id"]),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["id", "a", 'x"id', "id\\", "b"]), inner, max_size=3),
    max_leaves=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(json_values, st.integers(0, 12), st.sampled_from(["", " ", "x", "]", "}"])), min_size=40, max_size=60))
def test_key_search_equals_walking_the_document(one, cases):
    texts = ["[" * d + json.dumps(v) + "]" * d + tail for v, d, tail in cases]
    got = one(texts, lambda c: jsonx.json_has_key(c, "id"))
    assert got == [has_key_by_walking(t, "id") for t in texts]


def test_as_text(one):
    cases = {'{"v":null}': "", "{}": "", '{"v":"hello"}': "hello", '{"v":123}': "123", '{"v":3.14}': "3.14",
             '{"v":true}': "true", '{"v":["a",1,true]}': '["a",1,true]', '{"v":{"x":1,"y":"z"}}': '{"x":1,"y":"z"}'}
    got = one(list(cases), lambda c: jsonx.as_text(jsonx.json_part(F.try_parse_json(c), "$.v")))
    assert got == list(cases.values())


def test_rfc3339_is_strict(one):
    cases = {"2025-01-01T12:00:00Z": True, "2025-01-01T12:00:00.123456789+02:00": True, "2025-01-01": False,
             "2025-01-01 12:00:00Z": False, "2025-01-01T12:00:00": False, "not-a-timestamp": False, "": False,
             "2025-13-01T12:00:00Z": False}
    assert one(list(cases), lambda c: parse_rfc3339(c).isNotNull()) == list(cases.values())


def test_base64_has_no_line_breaks(one):
    (text,) = one(["x" * 500], lambda c: plain_base64(c.cast("binary")))
    assert "\n" not in text and "\r" not in text and len(text) == 668
    assert one(["a"], md5_base64) == ["DMF1ucDxtqgxw5niaXcmYQ=="]


def test_elapsed_ms(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' a, timestamp_ntz'2024-01-01 00:00:01.2345' b")
    assert row.select(elapsed_ms(F.col("a"), F.col("b"))).first()[0] == 1234.5


def test_sql_function_agrees_with_the_expression(spark, one):
    from millrace.functions.sql import register_functions

    register_functions(spark)
    texts = ['{"a":{"id":1}}', "{bad", nested(10), nested(11), '[{"id":1}]', '{"a":NaN,"id":1}', "", None]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").createOrReplaceTempView("texts")
    by_sql = [r[0] for r in spark.sql("SELECT json_has_key(t, 'id') FROM texts ORDER BY i").collect()]
    assert by_sql == one(texts, lambda c: jsonx.json_has_key(c, "id")) == [True, False, True, False, True, False, False, False]

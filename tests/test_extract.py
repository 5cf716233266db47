"""Answer extraction against a plain statement of the rule."""

import json
import random
import re

import pyarrow as pa
import pytest

from goldquarry.operators import extract
from goldquarry.operators.extract import extract_json

CASES = [
    ('{"a": 1}', {"a": 1}),
    ('  \n{"a": 1}\t', {"a": 1}),
    ('```json\n{"a": 1}\n```', {"a": 1}),
    ('```JSON{"a": 1}```', {"a": 1}),
    ("```\n[{\"a\": 1}]\n```", {"a": 1}),
    ('<think>{"a": 0}</think>{"a": 1}', {"a": 1}),
    ('<think>x</think> {"a": 0} <think>\n{"b": 1}\n</think>', {"a": 0}),
    ('<think>{"a": 1}</think>', {"a": 1}),
    ('[{"a": 1}]', {"a": 1}),
    ('[{"a": 1}, {"b": 2}]', {"b": 2}),
    ('{"a": 1} {"b": {"c": 2}}', {"b": {"c": 2}}),
    ('{"a": 1} tail', {"a": 1}),
    ('so { broken {"a": 1}', {"a": 1}),
    ('{"a": {"b": {"c": 1}}}', {"a": {"b": {"c": 1}}}),
    ('{"a": "}"}', {"a": "}"}),
    ('{"a": "x{y"}', {"a": "x{y"}),
    ('{"a": 1, "a": 2}', {"a": 2}),
    ('{"a": 1', None),
    ("none", None),
    ("", None),
    (None, None),
    ("[1, 2]", None),
    ("{}", {}),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r.i: (r.json, r.parse_status) for r in extract_json(df, "t").collect()}
    for i, (raw, want) in enumerate(CASES):
        text, status = got[i]
        assert status == ("no_object" if want is None else "ok"), raw
        if want is not None:
            assert json.loads(text) == want, raw


def test_non_standard_numbers_parse(spark):
    df = spark.createDataFrame([('{"a": NaN, "b": "x"}',)], "t string")
    row = extract_json(df, "t").first()
    assert row.parse_status == "ok" and '"b"' in row.json


def test_flat_rows_do_not_reach_python(spark):
    plan = extract_json(spark.createDataFrame([("x",)], "t string"), "t")
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert text.count("ArrowEvalPython") >= 1 and "BatchEvalPython" not in text


def test_patterns_are_applied_once(spark):
    plan = extract_json(spark.createDataFrame([("x",)], "t string"), "t")
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert text.count("regexp_replace") == 2 and text.count("parseJson") == 1


def plain_last_object(text):
    """The rule, brace by brace."""
    decoder, found, end = json.JSONDecoder(), None, 0
    for brace in re.finditer(r"\{", text or ""):
        if brace.start() >= end:
            try:
                found, end = decoder.raw_decode(text, brace.start())
            except ValueError:
                continue
    return None if found is None else json.dumps(found)


PIECES = ["{", "}", '"', "\\", "a", ":", ",", "[", "]", "1", " ", "é", '{"a": 1}', '{"b": {"c": [2, {}]}}', '"x{"', '{"q": "\\"}"}', "say ",
          '{"s": "\\\\"}', "{}", '{"u": "\u2028"}', "null", '{"x": "{"}']


@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_structural_index_is_the_rule(monkeypatch, limit):
    """Random nested, quoted, escaped and broken texts, in slices of one and of many."""
    monkeypatch.setattr(extract, "SLICE_BYTES", limit)
    rng = random.Random(limit)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(14))) for _ in range(6000)]
    texts += [t for t, _ in CASES] + ["", None, "", "{" * 3000, "{" * 2000 + "}" * 2000, '{"a":' * 500 + "1" + "}" * 500, ""]
    array = pa.array(texts)
    assert extract.last_objects(array).to_pylist() == [plain_last_object(t) for t in texts]
    assert extract.last_objects(array.slice(17, 900)).to_pylist() == [plain_last_object(t) for t in texts[17:917]]


def test_only_the_chosen_span_is_parsed(monkeypatch):
    read = []
    monkeypatch.setattr(extract, "_parsed", lambda data: read.append(data) or "{}")
    long = "prose { with } braces " * 5000 + '{"a": {"b": 1}}' + " tail" * 5000
    extract.last_objects(pa.array([long, '{"x": 1} then {"y": {"z": 2}}']))
    assert read == [b'{"a": {"b": 1}}', b'{"y": {"z": 2}}']

import hashlib
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.functions import masking, parsing, rules
from lakelayers.functions.fingerprint import content_sha256
from lakelayers.functions.json_text import fill_absent_keys, response_records

relaxed = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_hash_vectors(values):
    texts = ["Hello, World!", "", None, "Grüße 世界"]
    assert values(texts, content_sha256("v")) == [
        "dffd6021bb2bd5b0af676290809ec3a53191dd81c7f70a4b28688a362182986f",
        "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
        None,
        hashlib.sha256("Grüße 世界".encode()).hexdigest(),
    ]


def test_hash_of_binary(values):
    data = bytes(range(256))
    assert values([data], content_sha256("v"), "binary") == [hashlib.sha256(data).hexdigest()]


def test_mask_full(values):
    assert values(["x", "", None], masking.mask_full("v")) == ["********", "", None]
    assert values([0, 5, None], masking.mask_full("v", T.IntegerType()), "int") == ["0", "********", None]
    assert values([True, False, None], masking.mask_full("v", T.BooleanType()), "boolean") == [
        "********", "false", None,
    ]


def test_mask_partial(values):
    texts = [None, "", "a", "12345678", "123456789", "ä€𝄞456789é"]
    assert values(texts, masking.mask_partial("v")) == [
        "None", "None", "***", "***", "1234...6789", "ä€𝄞4...789é",
    ]


def test_clip_text(values):
    texts = ["x" * 100, "x" * 101, None]
    assert values(texts, masking.clip_text("v")) == ["x" * 100, "x" * 97 + "...", None]


def test_masking_by_key(spark):
    rows = [("API_KEY", "abc"), ("api_key", ""), ("region", "r" * 120), ("Token", None)]
    frame = spark.createDataFrame(rows, "k string, v string")
    found = frame.select(masking.mask_by_key("k", "v"), masking.preview_by_key("k", "v")).collect()
    assert [tuple(row) for row in found] == [
        ("********", "********"), ("", "(empty)"), ("r" * 120, "r" * 97 + "..."), (None, "(empty)"),
    ]


def test_mask_columns_by_name_is_opt_in(spark):
    frame = spark.createDataFrame([("s", 7, "x")], "password string, l_orderkey int, note string")
    assert tuple(masking.mask_columns(frame, ["note"]).first()) == ("s", 7, "********")
    assert tuple(masking.mask_columns(frame, by_name=True).first()) == ("********", "********", "x")
    with pytest.raises(ValueError):
        masking.mask_columns(frame, ["nothing"])


TOKENS = [
    "true", "TRUE", "1", "yes", "false", "0", "No", "on", "off", " true", "2", " 5 ", "\t5\n", "+5", "-17",
    "1_000", "1__0", "_1", "1_", "1e3", "5.0", ".5", "5.", "1_0.5e1_0", "nan", "-Inf", "infinity", "x", "",
    ".", "e5", "1d", "0x1p3", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "1 2",
]


def expected_of(token, kind):
    """What Python makes of the token, null where it refuses."""
    if kind == "bool":
        return {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}.get(token.lower())
    try:
        number = int(token) if kind == "int" else float(token)
    except ValueError:
        return None
    return number if kind == "float" or -(2**63) <= number < 2**63 else None


@pytest.mark.parametrize("kind, parser", [
    ("bool", parsing.parse_bool), ("int", parsing.parse_long), ("float", parsing.parse_double),
])
def test_strict_parsing(values, kind, parser):
    found = values([*TOKENS, None], parser("v"))
    wanted = [*[expected_of(token, kind) for token in TOKENS], None]
    for token, one, other in zip([*TOKENS, None], found, wanted):
        same = one == other or (isinstance(one, float) and isinstance(other, float) and math.isnan(one)
                                and math.isnan(other))
        assert same, (token, one, other)


def test_words_can_be_refused(values):
    assert values(["nan", "inf", "1.5"], parsing.parse_double("v", allow_words=False)) == [None, None, 1.5]


def test_lenient_bool(values):
    assert values(["on", "YES", "t", "", None], parsing.parse_bool_lenient("v")) == [
        True, True, False, False, None,
    ]


@given(st.lists(st.text(alphabet="0123456789+-_.eE nai", max_size=8), min_size=1, max_size=60))
@relaxed
def test_number_parsing_agrees_with_python(values, tokens):
    for kind, parser in (("int", parsing.parse_long), ("float", parsing.parse_double)):
        found = values(tokens, parser("v"))
        assert repr(found) == repr([expected_of(token, kind) for token in tokens])


def test_response_records(values):
    bodies = [
        '[{"id":1,"b":2.50, "a":[1,2]},{"id":2}]', '{"data":[{"z":1,"a":{"c":null}}],"n":1}', '{"x": 1}', "7",
        '{"data":null}', "[]", "{oops", "[1,2] xyz", '{"data":[{"a":1}', '{"data":{"k":1}}',
        ' \n {"data" : [ {"q": "é\\u00e9"} ] } ', '"str"', '[{"a":1}', '{"a":1} trailing', "null", None, "",
        '[{"a":1},3,null,{"b":"]"}]', '{"a":1} {"b":2}', '{"data":"[{}]"}',
    ]
    assert values(bodies, response_records("v")) == [
        ['{"a":[1,2],"b":2.5,"id":1}', '{"id":2}'], ['{"a":{"c":null},"z":1}'], ['{"x": 1}'], None, None, [],
        None, None, None, None, ['{"q":"éé"}'], None, None, None, None, None, None, ['{"a":1}', '{"b":"]"}'],
        None, None,
    ]


def test_fill_absent_keys(values):
    records = [
        '{"id":1}', '{"id":1,"source":null}', "{}", ' { } ', '{"a":{"source":1}}', '{"a":"}"} ', "[1]", "x", None,
    ]
    defaults = {"source": 'a "b"', "n": 3, "none": F.lit(None).cast("string")}
    assert values(records, fill_absent_keys("v", defaults)) == [
        '{"id":1,"source":"a \\"b\\"","n":3,"none":null}',
        '{"id":1,"source":null,"n":3,"none":null}',
        '{"source":"a \\"b\\"","n":3,"none":null}',
        '{"source":"a \\"b\\"","n":3,"none":null}',
        '{"a":{"source":1},"source":"a \\"b\\"","n":3,"none":null}',
        '{"a":"}","source":"a \\"b\\"","n":3,"none":null}',
        "[1]", "x", None,
    ]


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**53), 2**53) | st.text(max_size=5),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from("abcde}{"), inner, max_size=3),
    max_leaves=6,
)


@given(st.lists(st.dictionaries(st.sampled_from(["id", "source", "x", "data"]), json_values, max_size=4),
                min_size=1, max_size=25))
@relaxed
def test_unnest_and_fill_agree_with_python(values, records):
    records = [{key: value for key, value in record.items() if key != "data"} for record in records]
    found = values([json.dumps(records)], response_records("v"))[0]
    assert [json.loads(text) for text in found] == records
    filled = values([json.dumps(record, ensure_ascii=False) for record in records],
                    fill_absent_keys("v", {"source": "s"}))
    assert [json.loads(text) for text in filled] == [{**{"source": "s"}, **record} for record in records]


def test_rules(spark):
    rows = [("prod", "s3://b", 1), ("PROD", "s3://b", None), (" ", "x", 1), (None, None, 1), ("dev", "s3://", 2)]
    frame = spark.createDataFrame(rows, "env string, path string, n int")
    checks = [
        rules.not_null("n"), rules.not_blank("env"), rules.one_of("env", ("local", "develop", "staging", "prod")),
        rules.has_prefix("path", "s3://"),
    ]
    found = frame.select(rules.first_failed_rule(checks)).collect()
    assert [row[0] for row in found] == [None, "n_not_null", "env_not_blank", "env_not_blank", "env_one_of"]


def test_blanks_of_all_kinds(values, spark):
    blanks = ["\u00a0", " \u2003\t", "\x1c", "", "x\u00a0", None]
    assert values(blanks, rules.not_blank("v").holds) == [False, False, False, False, True, None]
    assert values(blanks, rules.strip_blank("v")) == ["", "", "", "", "x", None]
    numbers = ["\u00a05\u2003", "\x1c-7", "\u00a0inf"]
    assert values(numbers, parsing.parse_long("v")) == [5, -7, None]
    assert values(numbers, parsing.parse_double("v")) == [5.0, -7.0, math.inf]


def test_masking_by_key_of_typed_values(spark):
    frame = spark.sql("SELECT * FROM VALUES ('api_key', 5), ('api_key', 0), ('region', 7), ('token', NULL) AS t(k, v)")
    plain = [r[0] for r in frame.select(masking.mask_by_key("k", "v")).collect()]
    typed = [r[0] for r in frame.select(masking.mask_by_key("k", "v", T.IntegerType())).collect()]
    shown = [r[0] for r in frame.select(masking.preview_by_key("k", "v", data_type=T.IntegerType())).collect()]
    assert plain == ["********", "********", "7", None]
    assert typed == ["********", "0", "7", None]
    assert shown == ["********", "(empty)", "7", "(empty)"]


def test_no_rules_reject_nothing(values):
    assert values(["a"], rules.first_failed_rule([])) == [None]


def test_normalizations(values):
    assert values(["a", "a/", None], rules.with_trailing_slash("v")) == ["a/", "a/", None]
    assert values([" \t a b\n"], rules.strip_blank("v")) == ["a b"]
    assert values(["Warn"], rules.fold_case("v", upper=True)) == ["WARN"]

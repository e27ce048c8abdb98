import json

from hypothesis import given, settings
from hypothesis import strategies as st

from fleetspan.operators.nested import Invalid, _tokens_read, pivot, read, record_rows
from fleetspan.operators.nested import triples as of_value

LISTS = ("l", "l[].vs", "vs")


def triples(text, lone=()):
    try:
        return of_value(read(text), lone)
    except Invalid:
        return None


value = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=3), x, max_size=4), max_leaves=12)


@settings(max_examples=300, deadline=None)
@given(value, st.booleans(), st.sampled_from([None, 2]))
def test_whole_json_is_accepted_and_cut_json_is_not(v, ascii_, indent):
    text = json.dumps(v, ensure_ascii=ascii_, indent=indent)
    if isinstance(v, str):
        return
    assert triples(text) is not None and of_value(_tokens_read(text)) == triples(text)
    for cut in {1, len(text) // 2, len(text) - 1}:
        part = text[:cut]
        try:
            json.loads(part)
        except ValueError:
            assert triples(part) is None


def test_invalid_texts():
    for bad in ("-Infinity", "Infinity", "", None, "{", "[1,]", '{"a":1,}', "{'a':1}", "01", "1.", "nul", "NaN", "[1 2]", '{"a" 1}', '{"a":1} x', '"a\nb"', "<html>", "[}", '{"a":]}', ",", '{"a":1]', "[1}"):
        assert triples(bad) is None, bad


def test_paths_ordinals_and_last_key():
    got = triples('{"a": 1, "a": {"b": "x"}, "l": [{"p": "1"}, null, {"p": 2, "vs": {"q": true}}]}', ("l", "l[].vs"))
    assert ("a.b", (), "x") in got and ("a", (), "1") not in got
    rows = pivot(got)
    assert rows["l[]", (0,)]["p"] == "1" and rows["l[]", (2,)]["p"] == "2"
    assert "{}" in rows["l[]", (0,)] and rows["l[]", (1,)] == {"value": None}
    assert rows["l[].vs[]", (2, 0)]["q"] == "true"


def test_quoted_text_and_escapes():
    inner = json.dumps({"vs": [{"p": "é \"\\", "bad": "\ud800"}]})
    rows = pivot(triples(json.dumps(inner), ("vs",)))
    assert rows["vs[]", (0,)]["p"] == "é \"\\"


def test_rows_of_records(spark):
    docs = [
        (1, '{"hr": "1", "l": [{"cl": 5, "vs": [{"p": 1}, null, [], {"p": "2"}]}, 7, {"cl": null, "vs": {"p": 3}}]}'), (2, '{"vs": [{"p": "x"}, {}]}'), (3, None), (4, ""), (5, "{"), (6, "[]"), (None, '{"vs": [{"p": "n"}]}'), (7, '"{\\"vs\\": [{\\"p\\": \\"q\\"}]}"'), (8, "null"),
    ]
    df = spark.createDataFrame([(*x, "t", 1) for x in docs], "id bigint, body string, path string, fields int")
    rows = record_rows(df, "id", "body", LISTS).where("is_object").collect()
    v = sorted(((r["record_key"] or 0, r["path"], tuple(r["ordinals"]), r["fields"].get("p"), r["parent"].get("cl")) for r in rows if r["path"].endswith("vs[]")), key=str)
    assert v == sorted([(1, "l[].vs[]", (0, 0), "1", "5"), (1, "l[].vs[]", (0, 3), "2", "5"), (1, "l[].vs[]", (2, 0), "3", None), (2, "vs[]", (0,), "x", None), (2, "vs[]", (1,), None, None), (0, "vs[]", (0,), "n", None), (7, "vs[]", (0,), "q", None)], key=str)
    assert record_rows(df.limit(0), "id", "body", LISTS).count() == 0


def test_very_deep_and_very_long():
    assert triples("[" * 20_000 + "]" * 20_000) is not None
    assert len(triples("[" + ",".join(["1"] * 100_000) + "]")) == 100_000
    deep = triples('{"a":' * 30_000 + "1" + "}" * 30_000)
    assert len(deep) == 1 and deep[0][2] == "1"


def test_tables_are_found_in_the_data(spark):
    docs = [(1, '{"a": {"b": [{"c": 1.50, "d": [10, "x", null, {"e": 2}]}, {"c": 2}]}, "m": [[1, 2], [3]]}'), (2, '{"a": {"b": []}, "z": {}}')]
    rows = {(r["record_key"], r["path"], tuple(r["ordinals"]), r["is_object"]): (dict(r["fields"]), dict(r["parent"])) for r in record_rows(spark.createDataFrame(docs, "id bigint, body string"), "id", "body").collect()}
    assert rows[1, "a.b[]", (0,), True] == ({"c": "1.50", "d": None}, {"a.b": None, "m": None})
    assert rows[1, "a.b[].d[]", (0, 0), False] == ({"value": "10"}, {"c": "1.50", "d": None})
    assert rows[1, "a.b[].d[]", (0, 3), True][0] == {"e": "2"}
    assert rows[1, "m[][]", (0, 1), False][0] == {"value": "2"}
    assert rows[2, "", (), True][0] == {"a.b": None, "z": None} and len(rows) == 2 + 2 + 4 + 3


def test_the_first_copy_counts_as_a_whole(spark):
    docs = [(1, 5, '{"vs": [{"p": "B2"}, {"p": "B3"}]}'), (1, 3, '{"vs": [{"p": "A1"}]}'), (1, 2, "{"), (None, 1, '{"vs": [{"p": "n"}]}'), (None, 1, '{"vs": [{"p": "n"}]}')]
    df = spark.createDataFrame(docs, "id bigint, at int, body string").selectExpr("id", "timestamp_seconds(at) AS at", "body")
    rows = record_rows(df, "id", "body", LISTS, "at", once=True, paths=("vs[]",), columns=("p",)).collect()
    assert sorted((r["record_key"] or 0, r["fields"]["p"]) for r in rows) == [(0, "n"), (0, "n"), (1, "A1")]
    assert record_rows(df, "id", "body", LISTS, "at", once=True, paths=("nothing[]",)).count() == 0

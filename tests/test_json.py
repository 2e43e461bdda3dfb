"""JSON validity, canonical form and unnest edge cases (FIXTURES 2.1, SURVEY 4.3)."""

from filmmart.functions import jsonops as J

VALID = ["[1]", '{"a":1}', "null", "[]", " \n [1] \n ", '{"a":1,"a":2}', '[{"a":NaN}]', "[" * 5000 + "]" * 5000]
INVALID = ["[1] x", "[1],[2]", '{"a":1}],[{"b":2}', '1},{"v":2', '1,"w":2', "{bad", "", '["a\nb"]', "[1]]",
           '{"a":1}}', "{'a':1}", "[1,]", "// c\n[1]", "[01]", '["\\x"]', "{a:1}", "\ufeff[1]", "", "[1,,2]", "['a']", '["a\tb"]']


def test_validity(spark):
    df = spark.createDataFrame([(v,) for v in VALID + INVALID], "v string")
    got = {r["v"]: r["ok"] for r in df.select("v", J.is_valid_json("v").alias("ok")).collect()}
    assert all(got[v] for v in VALID), {v: got[v] for v in VALID}
    assert not any(got[v] for v in INVALID), [v for v in INVALID if got[v]]


def test_split_and_canonical(spark):
    df = spark.createDataFrame([("a", '[ {"b": 1.0, "a": "x"} ]'), ("b", "[1] x"), ("c", "")], "f string, value string")
    good, bad = J.split_valid(df, "value")
    assert [r["c"] for r in good.select(J.canonical_json("value").alias("c")).collect()] == ['[{"b":1.0,"a":"x"}]']
    assert {r["f"]: r["reason"] for r in bad.collect()} == {"b": "malformed JSON", "c": "empty file"}


def test_repeated_keys_at_any_size(spark):
    """The last of equal keys stays, in small documents, nested ones and ones of 70 MB."""
    big = '[{"a":1,"t":"' + "x" * 1_000_000 + '"}' + (',{"t":"' + "y" * 1_000_000 + '"}') * 69 + ',{"a":1,"b":0,"a":{"c":1,"c":2}}]'
    texts = ['{"a":1,"a":2}', '[{"x":{"k":"1","k":null}},{"x":1}]', '[{"v":NaN,"w":-Infinity,"z":1.50}]', '[1.50,"é\\u00e9"]', big]
    got = [r["c"] for r in spark.createDataFrame(list(enumerate(texts)), "i int, v string").orderBy("i").select(J.canonical_json("v").alias("c")).collect()]
    assert got[:4] == ['{"a":2}', '[{"x":{"k":null}},{"x":1}]', '[{"v":null,"w":null,"z":1.5}]', '[1.5,"éé"]']
    assert got[4].endswith(',{"a":{"c":2},"b":0}]') and len(got[4]) > 70_000_000
    plain = spark.createDataFrame([(big.replace('"a":1,"b":0,"a":{"c":1,"c":2}', '"b":0'),)], "v string").select(J.is_valid_json("v").alias("ok"))
    assert plain.first()["ok"]


def test_unnest(spark):
    rows = [("f1", '[{"id":1},{"id":2}]'), ("f2", "[]"), ("f3", "null"), ("f4", '{"id":9}')]
    df = spark.createDataFrame(rows, "_source_file string, data string").selectExpr(
        "timestamp'2024-01-01 00:00:00' as _loaded_at", "*")
    out = J.unnest_records(df, with_position=True).collect()
    assert sorted((r["_source_file"], r["_pos"], r["record"]) for r in out) == [
        ("f1", 0, '{"id":1}'), ("f1", 1, '{"id":2}')]
    rej = J.unnest_rejects(df).collect()
    assert [r["_source_file"] for r in rej] == ["f4"]


def test_paths(spark):
    df = spark.createDataFrame([('{"o":{"k":null},"n":null,"g":["A","B"],"cag[rating]":"PG"}',)], "r string")
    r = df.select(J.path("r", "$.o").alias("o"), J.path("r", "$.n").alias("n"), J.path("r", "$.g[0]").alias("g0"),
                  J.path("r", "$['cag[rating]']").alias("rating")).first()
    assert (r["o"], r["n"], r["g0"], r["rating"]) == ('{"k":null}', None, "A", "PG")


def test_lines_as_array(spark):
    df = spark.createDataFrame([('{"a":1}\n{"a":2}\n',), ("\n",), ('{"a":1}\n{"a":\n',)], "v string")
    got = [r["x"] for r in df.select(J.lines_as_array("v").alias("x")).collect()]
    assert got == ['[{"a":1},{"a":2}]', "[]", '[{"a":1},{"a":]']
    ok = [r["ok"] for r in df.select(J.is_valid_json(J.lines_as_array("v")).alias("ok")).collect()]
    assert ok == [True, True, False]

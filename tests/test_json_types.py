"""Schema inference as a lattice over the rows of all files."""

from __future__ import annotations

import decimal
import json

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from corpusmill.sources import json_corpus, json_types
from corpusmill.sources.json_corpus import read_json_corpus, read_prompt_file, read_train_eval
from corpusmill.sources.json_types import Seen, shape


def jl(*objs) -> str:
    return "".join(json.dumps(o, ensure_ascii=False) + "\n" for o in objs)


ORDER = ["_file_ord", "_block_ord", "_row_ord"]


def plain(value):
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    return [plain(v) for v in value] if isinstance(value, list) else value


def values(df, *cols):
    return [tuple(plain(v) for v in r) for r in rows(df, *cols, order=ORDER)]


def test_empty_text_at_any_depth_is_null_there(spark, write):
    a = write("n.jsonl", jl({"m": {"n": 1, "s": "x"}}, {"m": {"n": "", "s": ""}}, {"m": ""}, {"m": {"l": [{"k": 2.5}, {"k": ""}, ""]}}, {"m": {"l": ""}}))
    df = read_json_corpus(spark, a)
    assert dict(df.dtypes)["m"] == "struct<l:array<struct<k:double>>,n:bigint,s:string>"
    none = {"l": None, "n": None, "s": None}
    assert values(df, "m") == [({**none, "n": 1, "s": "x"},), ({**none, "s": ""},), (None,), ({**none, "l": [{"k": 2.5}, {"k": None}, None]},), (none,)]


def test_empty_list_where_others_have_an_object_or_a_number(spark, write):
    a = write("e.jsonl", jl({"o": [], "n": []}, {"o": {"k": [1, ""]}, "n": 3}, {"o": {"k": []}, "n": ""}))
    assert values(read_json_corpus(spark, a), "o", "n") == [(None, None), ({"k": [1, None]}, 3), ({"k": []}, None)]


@pytest.mark.parametrize("one", [["a", "b"], {"k": 1}, [None], [[]]])
@pytest.mark.parametrize("other", ["t", 5, True])
def test_list_or_object_beside_a_scalar_raises_in_one_file(spark, write, one, other):
    with pytest.raises(ValueError, match="'x' is (an object|a list) in some rows and text or a number"):
        read_json_corpus(spark, write("c.jsonl", jl({"x": one}, {"x": other})))


def test_conflicts_inside_are_named_with_their_place(spark, write):
    p = write("deep.jsonl", jl({"x": [{"y": {"z": 1}}]}, {"x": [{"y": [2]}]}))
    with pytest.raises(ValueError, match=r"'x\[\]\.y' is an object in some rows and a list"):
        read_json_corpus(spark, p)


def test_wide_numbers_stay_numbers(spark, write):
    a = write("w.jsonl", jl({"x": 1, "y": 1, "z": 10**40}))
    b = write("w.json", json.dumps([{"x": 12345678901234567890, "y": 2.5, "z": 1}]))
    df = read_json_corpus(spark, f"{a};{b}")
    assert [dict(df.dtypes)[c] for c in "xyz"] == ["decimal(20,0)", "double", "double"]
    assert values(df, "x", "y") == [(decimal.Decimal(1), 1.0), (decimal.Decimal(12345678901234567890), 2.5)]
    c = write("v.jsonl", jl({"x": -(2**63)}, {"x": 2**63 - 1}))
    assert values(read_json_corpus(spark, c), "x") == [(-(2**63),), (2**63 - 1,)]


def test_names_that_differ_in_case(spark, write):
    a = write("one.jsonl", jl({"a": 1}))
    b = write("two.jsonl", jl({"A": 2}))
    with pytest.raises(ValueError, match=r"'A' \(in .*two.jsonl\) and 'a' \(in .*one.jsonl\) differ in case"):
        read_json_corpus(spark, f"{a};{b}")
    with pytest.raises(ValueError, match=r"'m.Q'.*'m.q'"):
        read_json_corpus(spark, write("three.jsonl", jl({"m": {"q": 1, "Q": 2}})))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert values(read_json_corpus(spark, f"{a};{b}"), "a", "A") == [(1, None), (None, 2)]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_only_places_that_were_empty_are_read_as_text(spark, write):
    df = read_json_corpus(spark, write("p.jsonl", jl({"n": 1, "m": {"k": 1}, "e": 1, "l": [1]}, {"n": 2, "e": "", "l": [""]})))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<e:string,l:array<string>,m:struct<k:bigint>,n:bigint>" in plan
    assert "from_json" not in plan and "BatchEvalPython" not in plan and "MapInArrow" not in plan


def test_nothing_but_empty_objects_or_lists(spark, write):
    df = read_json_corpus(spark, write("h.jsonl", jl({"o": {}, "l": [], "n": None, "t": ""}, {"o": {}, "l": [], "n": None, "t": ""})))
    assert [dict(df.dtypes)[c] for c in "olnt"] == ["string", "array<string>", "string", "string"]
    assert values(df, "o", "l", "n", "t") == [("{}", [], None, "")] * 2


def test_one_pass_over_both_layouts_and_sides(spark, write, monkeypatch):
    a = write("train/a.jsonl", jl({"x": 1, "only": True}))
    b = write("train/b.json", json.dumps([{"x": ""}, {"x": {}}][:1]))
    c = write("eval/c.json", json.dumps([{"x": 2.5}], indent=2))
    calls = []
    whole = json_corpus.fold
    monkeypatch.setattr(json_corpus, "fold", lambda *args: calls.append(1) or whole(*args))
    monkeypatch.setattr(json_corpus, "_reader", lambda spark, layout, mode, r=json_corpus._reader: calls.append(0) or r(spark, layout, mode))
    train, held_out = read_train_eval(spark, f"{a};{b}", c)
    assert sum(calls) == 1  # one fold; the other calls are the reads
    assert dict(train.dtypes)["x"] == dict(held_out.dtypes)["x"] == "double"
    assert "only" in train.columns and "only" not in held_out.columns
    assert values(train, "x") == [(1.0,), (None,)] and values(held_out, "x") == [(2.5,)]


def test_long_array_files_join_in_with_the_parser_s_types(spark, write, monkeypatch):
    monkeypatch.setattr(json_corpus, "ARRAY_BYTES", 10)
    a = write("l.json", json.dumps([{"x": 1, "m": {"k": "", "j": [1, ""]}}, {"x": "", "m": ""}]))
    b = write("l.jsonl", jl({"x": 12345678901234567890, "m": {"k": 7}}))
    df = read_json_corpus(spark, f"{a};{b}")
    assert dict(df.dtypes)["m"] == "struct<j:array<bigint>,k:bigint>"
    assert values(df, "x", "m") == [(1, {"j": [1, None], "k": None}), (None, None), (12345678901234567890, {"j": None, "k": 7})]


def test_malformed_rows_name_their_file(spark, write):
    for bad in ('{"x": 1} tail\n', "[1]\n", "5\n", '{"x": \n'):
        with pytest.raises(PySparkException, match="bad.jsonl"):
            read_json_corpus(spark, write("bad.jsonl", '{"x": 1}\n' + bad))
    with pytest.raises(PySparkException, match="bad.json"):
        read_json_corpus(spark, write("bad.json", '[{"x": 1} {"x": 2}]'))


def test_blank_files_byte_order_marks_and_arrays_on_a_line(spark, write):
    a = write("a.jsonl", b"\xef\xbb\xbf" + b'{"x": 1}\n\n  \n[{"x": 2}, {"x": 3}]\n')
    b = write("b.json", b"\xef\xbb\xbf \n[ ]\n")
    assert sorted(values(read_json_corpus(spark, f"{a};{b}"), "x"), key=repr) == [(1,), (2,), (3,)]


def test_lossless_prompts_follow_the_same_types(spark, write):
    p = write("p.jsonl", '{"m": {"n": 1}}\n{"m": {"n": ""}}\n{"m": ""}\n')
    got = [(r[0], plain(r[1])) for r in rows(read_prompt_file(spark, p, lossless=True), "_raw", "m", order=ORDER)]
    assert got == [('{"m": {"n": 1}}', {"n": 1}), ('{"m": {"n": ""}}', {"n": None}), ('{"m": ""}', None)]


# ------------------------------------------------------------------ properties

scalars = st.one_of(st.none(), st.just(""), st.text(max_size=3), st.booleans(), st.integers(-(10**25), 10**25), st.floats(allow_nan=False, allow_infinity=False))
anything = st.recursive(scalars, lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(st.sampled_from("abAB"), v, max_size=3)), max_leaves=8)


def seen(values) -> Seen:
    out = Seen()
    for v in values:
        out.add(v, "f")
    return out


def joined(*parts) -> list:
    out = Seen()
    for p in parts:
        out.merge(p)
    return out.dump()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from("xy"), anything, max_size=2), max_size=6), st.integers(0, 6))
def test_merging_is_a_join(objects, cut):
    a, b = seen(objects[:cut]), seen(objects[cut:])
    whole = joined(seen(objects))
    assert joined(a, b) == joined(b, a) == whole
    assert joined(a, a) == joined(a) and joined(seen(objects), b) == whole
    assert Seen.load(json.loads(json.dumps(whole))).dump() == whole


typed = st.deferred(lambda: st.one_of(st.sampled_from(["long", "double", "bool", "text"]), st.tuples(st.just("list"), typed), st.dictionaries(st.sampled_from("abc"), typed, min_size=1, max_size=3)))


def of(kind):
    """Values of a type, with nulls, and with "" and [] at any place."""
    if isinstance(kind, dict):
        own = st.fixed_dictionaries({}, optional={k: of(v) for k, v in kind.items()})
    elif isinstance(kind, tuple):
        own = st.lists(of(kind[1]), max_size=3)
    else:
        own = {"long": st.integers(-(2**63), 2**63 - 1), "double": st.floats(allow_nan=False, allow_infinity=False), "bool": st.booleans(), "text": st.text("ab\"\\ é", max_size=4)}[kind]
    return st.one_of(own, own, st.none(), st.just(""))


def expected(value, kind):
    """What a row reads as, by the inferred type."""
    if isinstance(kind, T.StringType):
        return value if value is None or isinstance(value, str) else json.dumps(value)
    if value is None or value == "" or (value == [] and not isinstance(kind, T.ArrayType)):
        return None
    if isinstance(kind, T.StructType):
        return {f.name: expected(value.get(f.name), f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [expected(v, kind.elementType) for v in value]
    return float(value) if isinstance(kind, T.DoubleType) else value


@settings(max_examples=25, deadline=None)
@given(st.data())
def test_rows_read_back_with_empty_values_null(spark, tmp_path_factory, data):
    kind = data.draw(st.dictionaries(st.sampled_from("xyz"), typed, min_size=1, max_size=3))
    objects = data.draw(st.lists(st.fixed_dictionaries({}, optional={k: of(v) for k, v in kind.items()}), min_size=1, max_size=6))
    d = tmp_path_factory.mktemp("rows")
    half = len(objects) // 2
    (d / "a.jsonl").write_text(jl(*objects[:half]), encoding="utf-8")
    (d / "b.json").write_text(json.dumps(objects[half:], indent=1), encoding="utf-8")
    found = shape(seen(objects), list(seen(objects).fields or ()), False).schema
    df = read_json_corpus(spark, str(d))
    assert [f for f in df.schema.fields if not f.name.startswith("_")] == found.fields
    want = [tuple(expected(o.get(f.name), f.dataType) for f in found.fields) for o in objects]
    if found.fields:
        assert values(df, *found.fieldNames()) == want
    assert json_types.MERGERS > 0

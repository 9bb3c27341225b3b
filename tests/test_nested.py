import json
import random

import pytest
from pyspark.sql import functions as F

from lakeops.sources import nested

TEXTS = ['{"k": 1, "a": [{"b": [1, 2], "c": "x"}, {"b": [], "c": null}], "q r": 1.5, "order": true}',
         '{"k": "s", "a": [], "m": {"n": 1e3, "VOID": 2}, "big": 123456789012345678901234567890}',
         '{"k": 2', "", None, "[1, 2]", "3", '{"K": 5, "e": {}, "none": null}', "{} x", '{"k": [1, {"z": 2}]}', "{}"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "id int, t string, _parsed string").repartition(3)


def test_schema_is_merged_from_all_rows(texts):
    assert nested.infer_json_schema(texts, "t").simpleString() == (
        "struct<K:bigint,a:array<struct<b:array<bigint>,c:string>>,big:decimal(30,0),e:string,k:string,"
        "m:struct<VOID:bigint,n:double>,none:string,order:boolean,q r:decimal(2,1)>")


def test_parse_and_malformed(texts):
    parsed = nested.parse_json(texts, "t")
    assert parsed.columns == ["id", "t", "_parsed", "parsed", "malformed"]
    rows = {r.id: r for r in parsed.collect()}
    assert {i for i, r in rows.items() if r.malformed is not None} == {2, 3, 5, 6}
    assert all(rows[i].malformed == TEXTS[i] and rows[i].parsed is None for i in (2, 3, 5, 6))
    assert rows[8].parsed.K is None  # what follows a whole object is not looked at
    assert rows[4].parsed is None and rows[4].malformed is None and rows[10].parsed.k_2 is None
    assert rows[0].parsed.k_2 == "1" and rows[1].parsed.k_2 == "s" and json.loads(rows[9].parsed.k_2) == [1, {"z": 2}]
    assert rows[7].parsed.K == 5 and rows[7].parsed.e == "{}"
    assert [tuple(x) for x in rows[0].parsed.a] == [([1, 2], "x"), ([], None)]
    with pytest.raises(ValueError, match="taken"):
        nested.parse_json(texts, "t", into="ID")
    with pytest.raises(ValueError, match="no JSON object"):
        nested.parse_json(texts.filter("id = 2"), "t")


def test_declared_schema(texts):
    from pyspark.sql.types import StructType
    rows = {r.id: r for r in nested.parse_json(texts, "t", StructType.fromDDL("k BIGINT, m STRUCT<n: DOUBLE>")).collect()}
    assert rows[0].parsed.k == 1 and rows[1].malformed == TEXTS[1] and rows[9].malformed == TEXTS[9]


def test_explode_to_any_depth(spark):
    rng = random.Random(3)

    def tree(depth):
        return [rng.randrange(9) if depth == 1 else tree(depth - 1) for _ in range(rng.randrange(4))]

    docs = [{"id": i, "box": {"items": [{"name": f"n{j}", "grid": tree(3)} for j in range(rng.randrange(4))]}}
            for i in range(40)]
    df = spark.createDataFrame([(json.dumps(d), 7) for d in docs], "text string, grid_pos int")
    parsed = nested.parse_json(df, "text")
    found = nested.explode_path(parsed, ["parsed", "box", "items", "grid"], ["text", "grid_pos"])
    assert found.columns == ["text", "grid_pos", "items_pos", "_grid_pos", "grid_pos_2", "grid_pos_3", "grid"]
    want = [(json.dumps(d), 7, a, b, c, e, v) for d in docs for a, item in enumerate(d["box"]["items"])
            for b, x in enumerate(item["grid"]) for c, y in enumerate(x) for e, v in enumerate(y)]
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) > 50
    outer = nested.explode_path(parsed, ["parsed", "box", "items"], ["text"], outer=True)
    assert outer.count() == sum(max(1, len(d["box"]["items"])) for d in docs)
    flat = nested.flatten_structs(outer)
    assert flat.columns == ["text", "items_pos", "items_grid", "items_name"]
    with pytest.raises(ValueError, match="no field nope in parsed.box"):
        nested.explode_path(parsed, ["parsed", "box", "nope"], [])


def test_flatten_with_clashing_names(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1, 'd', array(2)), 'x.y', 3) AS a, 4 AS a_b_c, 5 AS `p.q`")
    flat = nested.flatten_structs(df)
    assert flat.columns == ["a_b_c", "a_b_d", "a_x.y", "a_b_c_2", "p.q"] and tuple(flat.first()) == (1, [2], 3, 4, 5)


def test_xml(spark, tmp_path):
    from pyspark.sql.types import StructType
    texts = ['<o id="1"><item><n>1</n></item><item><n>2</n></item></o>', '<o id="2"><item><n>x</n></item></o>', "<o", None,
             '<o id="3"></o>']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    schema = StructType.fromDDL("_id INT, item ARRAY<STRUCT<n: INT>>")
    parsed = nested.parse_xml(df, "t", schema)
    rows = {r.i: r for r in parsed.collect()}
    assert {i for i, r in rows.items() if r.malformed} == {1, 2} and rows[3].parsed is None and rows[4].parsed._id == 3
    found = nested.flatten_structs(nested.explode_path(parsed, ["parsed", "item"], ["i"]))
    assert sorted(map(tuple, found.collect())) == [(0, 0, 1), (0, 1, 2)]
    (tmp_path / "one.xml").write_text("<all><o><a>1</a></o><o><a>2</a><b>t</b></o></all>")
    read = nested.read_xml(spark, str(tmp_path / "one.xml"), "o")
    assert sorted((r.a, r.b or "") for r in read.collect()) == [(1, ""), (2, "t")]


def test_plans_have_no_shuffle_and_no_python(texts):
    plan = nested.explode_path(nested.parse_json(texts.coalesce(1), "t"), ["parsed", "a", "b"], ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and text.count("Exchange") <= 1  # the repartition of the fixture

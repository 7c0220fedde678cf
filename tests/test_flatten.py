import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagedframes import flatten, flatten_schema

LEAVES = st.sampled_from([T.StringType(), T.IntegerType(), T.ArrayType(T.StructType().add("x", T.LongType()))])


def structs(children):
    fields = st.lists(st.tuples(children, st.booleans()), min_size=1, max_size=3)
    return fields.map(lambda fs: T.StructType([T.StructField(f"f{i}", t, n) for i, (t, n) in enumerate(fs)]))


SCHEMAS = structs(st.recursive(LEAVES, structs, max_leaves=6))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SCHEMAS)
def test_schema_rule_equals_the_projection(spark, schema):
    flat = flatten(spark.createDataFrame([], schema))
    assert flat.schema == flatten_schema(schema)
    assert flatten(flat).schema == flat.schema
    assert not any(isinstance(f.dataType, T.StructType) for f in flat.schema)


def test_values_names_and_order(spark):
    df = spark.sql("SELECT 1 a, named_struct('c', named_struct('d', 2, 'e', array(3)), 'f', 4) b, 5 g")
    flat = flatten(df)
    assert flat.columns == ["a", "b_c_d", "b_c_e", "b_f", "g"]
    assert tuple(flat.first()) == (1, 2, [3], 4, 5)


def test_null_struct_gives_null_leaves(spark):
    df = spark.createDataFrame([(None,)], "s STRUCT<a: INT, t: STRUCT<b: INT>>")
    assert tuple(flatten(df).first()) == (None, None)


def test_leaf_is_nullable_when_its_parent_is():
    inner = T.StructType([T.StructField("id", T.IntegerType(), False)])
    schema = T.StructType([T.StructField("s", inner, True), T.StructField("r", inner, False)])
    assert [f.nullable for f in flatten_schema(schema)] == [True, False]


def test_odd_names(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("x.y"), F.lit(2).alias("q`r")).alias("a b"), F.lit(3).alias("c.d"))
    flat = flatten(df)
    assert flat.columns == ["a b_x_y", "a b_q`r", "c_d"]
    assert tuple(flat.first()) == (1, 2, 3)


def test_clash_names_both_paths(spark):
    df = spark.sql("SELECT named_struct('b', 1) a, 2 a_b")
    with pytest.raises(ValueError, match="a_b from a > b and a_b"):
        flatten(df)

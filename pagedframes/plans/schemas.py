"""Fields of the schemas in API descriptions, with references followed.

A field that refers to another definition holds that definition's fields. Each
definition is read once, for its own fields and those of objects written
within it. The references between definitions are then small rows without any
text, and walks along them double in length each round: walks of exactly the
longest length so far are joined with all walks that begin where they end. So a
chain of ``n`` references takes about ``log2(n)`` rounds, whatever the number of
documents. Each round is a written table, so no round computes an earlier one
again and a lost executor costs one round's tasks.

Parsed JSON is exploded with the outer form and a filter after it: the plain
form lets Catalyst infer a filter before it, which parses the text once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagedframes.plans.catalogue import ref_name
from pagedframes.storage import new_folder, write_and_reopen

_NODE = "type string, required array<string>, properties map<string,string>"
_FIELD = (
    "type string, format string, `$ref` string, properties string,"
    " items struct<`$ref`:string,type:string,properties:string>"
)
_INLINE = "problem is null and ref is null and child is not null"
_REFERS = "problem is null and ref is not null"
_LEAF_TYPES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "array<string>": T.ArrayType(T.StringType()),
}
_SCALARS = {"boolean": "boolean", "integer": "int", "string": "string"}


def _definitions(specs: DataFrame) -> DataFrame:
    """``spec_id, name, node, unknown``; ``unknown`` lists what a node refers to and its document lacks."""
    documents = specs.select(
        "spec_id", F.from_json("body", "definitions map<string,string>").getField("definitions").alias("all")
    )
    each = documents.select("spec_id", F.map_keys("all").alias("names"), F.explode_outer("all").alias("name", "node"))
    each = each.filter("name is not null")
    refs = F.regexp_extract_all("node", F.lit(r'"\$ref":"([^"]*)"'))
    return each.select("spec_id", "name", "node", F.array_except(F.transform(refs, ref_name), "names").alias("unknown"))


def _roots(definitions: DataFrame) -> DataFrame:
    no_names, no_numbers = F.array().cast("array<string>"), F.array().cast("array<int>")
    return definitions.select(
        "spec_id",
        F.col("name").alias("schema_name"),
        no_names.alias("path"),
        no_numbers.alias("pos"),
        F.array("name").alias("opened"),
        F.lit(False).alias("path_nullable"),
        F.lit(False).alias("in_array"),
        "node",
        "unknown",
    )


def _type_of(field: Column, array_items: Column) -> tuple[Column, Column]:
    """(Spark type, what to say when there is none) of one field; structs are only named as such."""
    ref, kind, form = field.getField("$ref"), field.getField("type"), field.getField("format")
    item_kind = array_items.getField("type")
    scalar = F.coalesce(*[F.when(kind == name, F.lit(spark)) for name, spark in _SCALARS.items()])
    in_array = (
        F.when(array_items.getField("$ref").isNotNull() | (item_kind == "object"), F.lit("array<struct>"))
        .when(item_kind == "string", F.lit("array<string>"))
    )
    spark_type = (
        F.when(ref.isNotNull() | (kind == "object"), F.lit("struct"))
        .when(kind == "array", in_array)
        .when((kind == "number") & (form == "double"), F.lit("double"))
        .otherwise(scalar)
    )
    told = (
        F.when(kind == "number", F.concat(F.lit("number of format "), F.coalesce(form, F.lit("none"))))
        .when(kind == "array", F.concat(F.lit("array of "), F.coalesce(item_kind, F.lit("nothing"))))
        .otherwise(F.concat(F.lit("type "), F.coalesce(kind, F.lit("none"))))
    )
    return spark_type, told


def _expand(nodes: DataFrame) -> DataFrame:
    """Object nodes to one row per property; ``child`` is the node of an inline object."""
    parsed = nodes.withColumn("__node", F.from_json("node", _NODE))
    rows = parsed.select(
        "spec_id",
        "schema_name",
        "path",
        "pos",
        "opened",
        "path_nullable",
        "in_array",
        "unknown",
        F.col("__node.required").alias("required"),
        F.posexplode_outer("__node.properties").alias("__pos", "__name", "__json"),
    )
    rows = rows.filter("__name is not null").withColumn("__field", F.from_json("__json", _FIELD))
    field, items = F.col("__field"), F.col("__field.items")
    spark_type, problem = _type_of(field, items)
    target = ref_name(F.coalesce(field.getField("$ref"), F.when(field.getField("type") == "array", items.getField("$ref"))))
    inline = F.when(field.getField("$ref").isNull() & (field.getField("type") == "object"), F.col("__json")).when(
        (field.getField("type") == "array") & items.getField("$ref").isNull() & (items.getField("type") == "object"),
        F.get_json_object("__json", "$.items"),
    )
    nullable = ~F.coalesce(F.array_contains("required", F.col("__name")), F.lit(False))
    dangling = (
        F.when(spark_type.isNull(), problem)
        .when(F.array_contains("unknown", target), F.concat(F.lit("unknown reference "), target))
        .when(F.array_contains("opened", target), F.concat(F.lit("refers back to "), target))
    )
    return rows.select(
        "spec_id",
        "schema_name",
        F.array_append("path", F.col("__name")).alias("path"),
        F.array_append("pos", F.col("__pos")).alias("pos"),
        spark_type.alias("type"),
        nullable.alias("nullable"),
        target.alias("ref"),
        dangling.alias("problem"),
        (F.col("path_nullable") | nullable).alias("path_nullable"),
        "in_array",
        "opened",
        "unknown",
        inline.alias("child"),
    )


def _inline(level: DataFrame) -> DataFrame:
    """The objects written within the fields of a level, as nodes."""
    return level.filter(_INLINE).select(
        "spec_id",
        "schema_name",
        "path",
        "pos",
        "opened",
        "path_nullable",
        (F.col("in_array") | F.startswith(F.col("type"), F.lit("array"))).alias("in_array"),
        "unknown",
        F.col("child").alias("node"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _own_fields(specs: DataFrame, folder: str) -> DataFrame:
    """The fields that each definition has itself, those of objects written within it included.

    One narrow pass for each level of such objects, none of which moves a row.
    """
    nodes, levels = _roots(_definitions(specs)), []
    while True:
        # counted as the level is written, so no job reads it for that
        seen = Observation()
        rows = _expand(nodes).observe(seen, F.count_if(F.expr(_INLINE)).alias("objects"))
        level = write_and_reopen(rows, f"{folder}/own{len(levels)}")
        levels.append(level)
        if not seen.get["objects"]:
            return _union([level.drop("child", "unknown") for level in levels])
        nodes = _inline(level)


_WALK = ["spec_id", "first", "last", "path", "pos", "opened", "path_nullable", "in_array"]


def _walks(own: DataFrame, folder: str) -> DataFrame:
    """All walks along references that open no definition twice, from ``first`` to ``last``.

    ``opened`` names the definitions on the walk in order, both ends included.
    """
    steps = own.filter(_REFERS).select(
        "spec_id",
        F.col("schema_name").alias("first"),
        F.col("ref").alias("last"),
        "path",
        "pos",
        F.array("schema_name", "ref").alias("opened"),
        "path_nullable",
        (F.col("in_array") | F.startswith(F.col("type"), F.lit("array"))).alias("in_array"),
    )
    longest = 1
    rounds = [write_and_reopen(steps, f"{folder}/walks0")]
    while True:
        begun, all_walks = rounds[-1].filter(F.size("opened") == longest + 1), _union(rounds)
        onward = all_walks.select(
            F.col("spec_id").alias("__spec"), F.col("first").alias("__at"), *[F.col(c).alias(f"__{c}") for c in _WALK[2:]]
        )
        beyond = F.slice("__opened", F.lit(2), F.size("__opened"))
        met = begun.join(onward, (F.col("spec_id") == F.col("__spec")) & (F.col("last") == F.col("__at")))
        met = met.filter(~F.arrays_overlap("opened", beyond)).select(
            "spec_id",
            "first",
            F.col("__last").alias("last"),
            F.concat("path", "__path").alias("path"),
            F.concat("pos", "__pos").alias("pos"),
            F.concat("opened", beyond).alias("opened"),
            (F.col("path_nullable") | F.col("__path_nullable")).alias("path_nullable"),
            (F.col("in_array") | F.col("__in_array")).alias("in_array"),
        )
        longest *= 2
        seen = Observation()
        met = met.observe(seen, F.count_if(F.size("opened") == longest + 1).alias("longest"))
        rounds.append(write_and_reopen(met, f"{folder}/walks{len(rounds)}"))
        # part of a walk is a walk, so without one of this length there is none that is longer
        if not seen.get["longest"]:
            return _union(rounds)


_PUBLIC = ["spec_id", "schema_name", "path", "pos", "type", "nullable", "ref", "problem", "path_nullable", "in_array"]


def fields(specs: DataFrame) -> DataFrame:
    """The own fields of each schema; ``type`` names structs only as such, ``ref`` says which."""
    own = _expand(_roots(_definitions(specs)))
    return own.select(
        "spec_id",
        "schema_name",
        F.get("pos", F.lit(0)).alias("pos"),
        F.get("path", F.lit(0)).alias("field"),
        "type",
        "nullable",
        "ref",
        "problem",
    )


def field_paths(specs: DataFrame) -> DataFrame:
    """All fields at all levels, by ``path``.

    ``path_nullable`` is whether anything on the path is nullable, ``in_array``
    whether an array lies above. A reference to a schema that is being opened
    already is dropped and told as ``problem``, so cycles end.
    """
    folder = new_folder(specs.sparkSession, "fields")
    own = _own_fields(specs, folder)
    walks = _walks(own, folder).select(*[F.col(c).alias(f"__{c}") for c in _WALK])
    below = own.join(walks, (F.col("spec_id") == F.col("__spec_id")) & (F.col("schema_name") == F.col("__last")))
    back = F.when(F.array_contains("__opened", F.col("ref")), F.concat(F.lit("refers back to "), "ref"))
    below = below.select(
        "spec_id",
        F.col("__first").alias("schema_name"),
        F.concat("__path", "path").alias("path"),
        F.concat("__pos", "pos").alias("pos"),
        "type",
        "nullable",
        "ref",
        F.coalesce("problem", back).alias("problem"),
        (F.col("path_nullable") | F.col("__path_nullable")).alias("path_nullable"),
        (F.col("in_array") | F.col("__in_array")).alias("in_array"),
    )
    return own.select(*_PUBLIC).unionByName(below)


def flat_fields(paths: DataFrame) -> DataFrame:
    """The columns that flattening each schema gives: ``spec_id, schema_name, column, type, nullable``.

    Structs give way to their leaves and arrays stay whole, as in
    :func:`pagedframes.operators.flatten`.
    """
    leaves = paths.filter("problem is null and not in_array and type != 'struct'")
    return leaves.select(
        "spec_id",
        "schema_name",
        "pos",
        F.translate(F.array_join("path", "_"), ".", "_").alias("column"),
        "type",
        F.col("path_nullable").alias("nullable"),
    )


def declared_schema(paths: DataFrame, schema_name: str, spec_id: object = None) -> T.StructType:
    """The ``StructType`` of one schema. Only that schema's field rows of one document come to the driver.

    ``spec_id`` tells which document, and may be left out where only one has the schema.
    """
    own = paths.filter(F.col("schema_name") == schema_name)
    if spec_id is not None:
        own = own.filter(F.col("spec_id") == F.lit(spec_id))
    elif own.select("spec_id").distinct().limit(2).count() > 1:
        raise ValueError(f"several documents have {schema_name}: say which one by spec_id")
    rows = sorted(own.collect(), key=lambda r: r["pos"])
    if not rows:
        raise ValueError(f"the description has no fields for {schema_name}")
    children: dict[tuple[str, ...], list] = {}
    for row in rows:
        if row["problem"] is None:
            children.setdefault(tuple(row["path"][:-1]), []).append(row)
        elif not row["problem"].startswith("refers back"):
            raise ValueError(f"{schema_name}.{'.'.join(row['path'])}: {row['problem']}")

    def build(path: tuple[str, ...]) -> T.StructType:
        return T.StructType(
            [T.StructField(r["path"][-1], data_type(r), r["nullable"]) for r in children.get(path, [])]
        )

    def data_type(row) -> T.DataType:
        kind = row["type"]
        if kind in ("struct", "array<struct>"):
            struct = build(tuple(row["path"]))
            return struct if kind == "struct" else T.ArrayType(struct)
        return _LEAF_TYPES[kind]

    return build(())

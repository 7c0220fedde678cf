"""API descriptions as tables.

``specs`` has one description document per row: ``spec_id, body``. Objects in
a document are read as maps of JSON text, which keeps the order in which keys
were written; that order decides which response and which endpoint wins.
Each document is taken apart within its row, so only :func:`dataset_endpoint`
shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METHODS = ("get", "post", "put", "delete")
_MAP = "map<string,string>"
_REQUEST = (
    "produces array<string>,"
    " parameters array<struct<`in`:string,name:string,type:string,enum:array<string>,required:boolean>>,"
    " responses map<string,string>"
)
_RESPONSE = "schema struct<`$ref`:string,type:string,items:struct<`$ref`:string>>"


def ref_name(ref: Column) -> Column:
    """``#/definitions/Contact`` names ``Contact``."""
    return F.element_at(F.split(ref, "/"), -1)


def endpoints(specs: DataFrame) -> DataFrame:
    """``spec_id, pos, endpoint, method, schema_name, schema_type, params, problem``, one row per operation.

    Vendor extensions (``x-...``) are no operations. ``schema_name`` and
    ``schema_type`` come from the first response and are empty for delete.
    An operation that cannot be used has a ``problem``.
    """
    # posexplode restarts for each endpoint, so the document-wide order needs both positions
    paths = specs.select(
        "spec_id", F.posexplode_outer(F.from_json("body", f"paths map<string,{_MAP}>").getField("paths"))
    ).filter("key is not null").select("spec_id", F.col("pos").alias("path_pos"), F.col("key").alias("endpoint"), F.col("value").alias("methods"))
    operations = paths.select("spec_id", "path_pos", "endpoint", F.posexplode("methods")).filter(
        ~F.startswith(F.col("key"), F.lit("x-"))
    )
    parsed = operations.select(
        "spec_id",
        F.struct("path_pos", F.col("pos").alias("method_pos")).alias("pos"),
        "endpoint",
        F.col("key").alias("method"),
        F.from_json("value", _REQUEST).alias("request"),
    )
    first_response = F.get(F.map_values("request.responses"), F.lit(0))
    read = parsed.select("*", F.from_json(first_response, _RESPONSE).getField("schema").alias("response"))

    ref, kind = F.col("response.`$ref`"), F.col("response.type")
    item_ref = F.col("response.items.`$ref`")
    is_delete = F.col("method") == "delete"
    name = (
        F.when(is_delete, F.lit(""))
        .when(ref.isNotNull(), ref_name(ref))
        .when((kind == "array") & item_ref.isNotNull(), ref_name(item_ref))
        .otherwise(F.lit(""))
    )
    shape = F.when(is_delete, F.lit("")).when(ref.isNotNull(), F.lit("object")).otherwise(kind)
    content = F.coalesce(F.get("request.produces", F.lit(0)), F.lit(""))
    problem = (
        F.when(~F.col("method").isin(*METHODS), F.concat(F.lit("method "), F.col("method"), F.lit(" is not supported")))
        .when(~content.isin("application/json", ""), F.concat(F.lit("content type "), content))
        .when(shape.isNull(), F.lit("no response schema"))
    )
    declared = F.filter("request.parameters", lambda p: p["in"] == "query")
    params = F.transform(
        F.coalesce(declared, F.array()),
        lambda p: F.struct(
            p["name"].alias("name"),
            p["type"].alias("type"),
            F.coalesce(p["enum"], F.array().cast("array<string>")).alias("enum"),
            F.coalesce(p["required"], F.lit(False)).alias("required"),
        ),
    )
    operation = F.struct(
        "spec_id",
        "pos",
        "endpoint",
        "method",
        name.alias("schema_name"),
        shape.alias("schema_type"),
        params.alias("params"),
        problem.alias("problem"),
    )
    # an array of one: filters on what was parsed stay behind it, where they do not parse again
    return read.select(F.explode(F.array(operation)).alias("operation")).select("operation.*")


def read_paths(endpoints: DataFrame, endpoint: str | None = None) -> DataFrame:
    """The usable operations that read, of all endpoints or of one."""
    return _paths(endpoints.filter("method = 'get'"), endpoint)


def write_paths(endpoints: DataFrame, endpoint: str | None = None) -> DataFrame:
    """The usable operations that write, of all endpoints or of one."""
    return _paths(endpoints.filter("method in ('post', 'put', 'delete')"), endpoint)


def _paths(operations: DataFrame, endpoint: str | None) -> DataFrame:
    usable = operations.filter("problem is null")
    return usable if endpoint is None else usable.filter(F.col("endpoint") == endpoint)


def query_params(endpoints: DataFrame) -> DataFrame:
    """``spec_id, endpoint, method, pos, name, type, enum, required``, one row per query parameter."""
    # outer, so that no filter on the array is inferred, which would parse the document again
    each = endpoints.select("spec_id", "endpoint", "method", F.posexplode_outer("params").alias("pos", "param"))
    return each.filter("pos is not null").select("spec_id", "endpoint", "method", "pos", "param.*")


def datasets(endpoints: DataFrame) -> DataFrame:
    """The readable datasets ``(spec_id, schema_name, schema_type)``, one row per read path."""
    return read_paths(endpoints).select("spec_id", "schema_name", "schema_type")


def dataset_endpoint(endpoints: DataFrame) -> DataFrame:
    """``(spec_id, schema_name, kind)`` to the endpoint that serves it; the one written last wins.

    ``kind`` is ``item`` for endpoints that take a ``{key}`` and ``list`` for
    those without a placeholder, so reading a list never ends at the endpoint
    of one record. Endpoints with other placeholders serve neither.
    """
    rest = F.replace("endpoint", F.lit("{key}"))
    kind = F.when(F.contains(F.col("endpoint"), F.lit("{key}")), F.lit("item")).otherwise(F.lit("list"))
    return (
        read_paths(endpoints)
        .filter(~F.contains(rest, F.lit("{")))
        .groupBy("spec_id", "schema_name", kind.alias("kind"))
        .agg(
            F.max_by("endpoint", "pos").alias("endpoint"),
            F.max_by("schema_type", "pos").alias("schema_type"),
            F.max_by("params", "pos").alias("params"),
        )
    )


def base_url(specs: DataFrame) -> DataFrame:
    """``(spec_id, base_url)``: first scheme, host and base path."""
    parsed = F.from_json("body", "host string, basePath string, schemes array<string>").alias("spec")
    return specs.select("spec_id", parsed).select(
        "spec_id",
        F.concat(F.get("spec.schemes", F.lit(0)), F.lit("://"), F.col("spec.host"), F.col("spec.basePath")).alias(
            "base_url"
        ),
    )

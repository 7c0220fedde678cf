"""Query parameters: typed, required, enumerated; and the filters they stand for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagedframes.constants import PAGING_PARAMS
from pagedframes.functions.urls import query_string

# parameter type -> (Python type of a value, Spark type)
_TYPES = {"boolean": (bool, "boolean"), "integer": (int, "int"), "string": (str, "string")}


def _typed(name: str, value: object, declared: Mapping[str, str]) -> Column:
    if name not in declared:
        raise ValueError(f"unknown parameter {name}")
    if declared[name] not in _TYPES:
        raise ValueError(f"parameter {name}: type {declared[name]} is not supported")
    python_type, spark_type = _TYPES[declared[name]]
    if not isinstance(value, python_type) or (python_type is int and isinstance(value, bool)):
        raise ValueError(f"parameter {name}: {value!r} is not of type {declared[name]}")
    return F.lit(value).cast(spark_type)


def checked(params: Mapping[str, object], declared: Mapping[str, str], required: list[str]) -> dict[str, Column]:
    """The caller's parameters as typed literals, paging parameters left out."""
    missing = [name for name in required if name not in params and name not in PAGING_PARAMS]
    if missing:
        raise ValueError(f"required parameters are missing: {', '.join(missing)}")
    return {name: _typed(name, value, declared) for name, value in params.items() if name not in PAGING_PARAMS}


def filter_rows(rows: DataFrame, params: Mapping[str, object], declared: Mapping[str, str]) -> DataFrame:
    """Keep the records whose columns equal the parameters of the same name.

    What a server makes of a parameter is its own affair; over landed records
    equality is the one meaning given here.
    """
    for name, value in checked(params, declared, []).items():
        rows = rows.filter(F.col(f"`{name}`") == value)
    return rows


# --- many requests at once -------------------------------------------------
# requests: request_id, spec_id, endpoint, params MAP<STRING, STRING>
# endpoints: see catalogue.endpoints; its params column holds the declared ones


def _with_declared(requests: DataFrame, endpoints: DataFrame) -> DataFrame:
    # A description lists an endpoint's parameters in one row, so each check
    # below stays within the request row: one join, nothing exploded before it.
    # ``declared`` is null for an endpoint that the description does not have.
    reads = endpoints.filter("method = 'get'").select("spec_id", "endpoint", F.col("params").alias("declared"))
    return requests.join(reads, ["spec_id", "endpoint"], "left")


def _supplied() -> Column:
    return F.map_filter("params", lambda name, _: ~name.isin(*PAGING_PARAMS))


def missing_params(requests: DataFrame, endpoints: DataFrame) -> DataFrame:
    """``(request_id, name)`` for every required parameter that a request lacks."""
    required = F.filter("declared", lambda p: p["required"] & ~p["name"].isin(*PAGING_PARAMS))
    lacking = F.array_except(F.transform(required, lambda p: p["name"]), F.map_keys("params"))
    return _with_declared(requests, endpoints).select("request_id", F.explode(lacking).alias("name"))


def _each_supplied(requests: DataFrame, endpoints: DataFrame) -> DataFrame:
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))
    # a request to an unknown endpoint keeps one row, so that it is reported
    supplied = F.when(F.col("declared").isNull(), nothing).otherwise(F.map_entries(_supplied()))
    joined = _with_declared(requests, endpoints)
    each = joined.select("request_id", "endpoint", "declared", F.explode(supplied).alias("param"))
    own = F.get(F.filter("declared", lambda p: p["name"] == F.col("param.key")), F.lit(0))
    return each.select(
        "request_id",
        "endpoint",
        F.col("declared").isNotNull().alias("known"),
        F.col("param.key").alias("name"),
        F.col("param.value").alias("value"),
        own.alias("own"),
    )


def param_problems(requests: DataFrame, endpoints: DataFrame) -> DataFrame:
    """``(request_id, name, value, problem)``: unknown endpoints and names, unsupported types, values that do not fit."""
    fits = (
        F.when(F.col("own.type") == "boolean", F.col("value").isin("true", "false"))
        .when(F.col("own.type") == "integer", F.col("value").try_cast("int").isNotNull())
        .otherwise(F.lit(True))
    )
    problem = (
        F.when(~F.col("known"), F.concat(F.lit("unknown endpoint "), F.col("endpoint")))
        .when(F.col("own").isNull(), F.lit("unknown"))
        .when(~F.col("own.type").isin(*_TYPES), F.lit("type not supported"))
        .when(~fits, F.lit("value does not fit"))
    )
    return (
        _each_supplied(requests, endpoints)
        .select("request_id", "name", "value", problem.alias("problem"))
        .filter(F.col("problem").isNotNull())
    )


def enum_violations(requests: DataFrame, endpoints: DataFrame) -> DataFrame:
    """``(request_id, name, value)`` where the declared values do not hold the supplied one."""
    broken = (F.size("own.enum") > 0) & ~F.array_contains("own.enum", F.col("value"))
    return _each_supplied(requests, endpoints).filter(broken).select("request_id", "name", "value")


def request_query(requests: DataFrame) -> DataFrame:
    """Adds the encoded ``query`` of each request, paging parameters left out."""
    return requests.withColumn("query", query_string(_supplied()))

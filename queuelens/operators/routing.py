"""Routing of requests to registered services."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from queuelens.plans.joins import broadcast_if_small
from queuelens.plans.ordered import running
from queuelens.session import cut_lineage

# What a greeting starts with, and the text of the one error (fixed values).
GREETING = "hello "
NOT_FOUND = " not found"


def signature(method: Column, param_types: Column) -> Column:
    """A method with its parameter types, as in ``greet(string,int)``; null without a name."""
    types = F.array_join(F.coalesce(param_types, F.array().cast("array<string>")), ",", "null")
    return F.concat(method, F.lit("("), types, F.lit(")"))


def latest_registry(registry: DataFrame) -> DataFrame:
    """(__service, __impl, __methods): of the implementations of a service the last registered.

    ``registry`` has a row per service, impl, seq and method with its param_types; a
    service has few methods, which are gathered in an array.
    """
    last = registry.groupBy(F.col("service").alias("__service")).agg(
        F.max_by("impl", "seq").alias("__impl"))
    methods = registry.groupBy(F.col("service").alias("__of"), F.col("impl").alias("__by")).agg(
        F.collect_set(signature(F.col("method"), F.col("param_types"))).alias("__methods"))
    same = (F.col("__service") == F.col("__of")) & (F.col("__impl") == F.col("__by"))
    return last.join(methods, same, "left").select("__service", "__impl", "__methods")


def _answered(joined: DataFrame) -> DataFrame:
    """Requests next to their registration, with ``impl`` and ``error``, of which one is null."""
    wanted = signature(F.col("method"), F.col("param_types"))
    known = F.col("__impl").isNotNull()
    found = known & F.coalesce(F.array_contains("__methods", wanted), F.lit(False))
    service = F.coalesce("service", F.lit("null"))
    missing = F.when(known, F.concat(service, F.lit("."), F.coalesce(wanted, F.lit("null"))))
    return joined.withColumns({
        "impl": F.when(found, F.col("__impl")),
        "error": F.when(~found, F.concat(F.coalesce(missing, service), F.lit(NOT_FOUND))),
    }).drop("__service", "__impl", "__methods")


def _looked_up(requests: DataFrame, registry: DataFrame, broadcast: bool) -> DataFrame:
    """``requests`` with the implementation (``impl``) and ``error``, of which one is null."""
    table = latest_registry(registry)
    table = broadcast_if_small(table) if broadcast else table
    return _answered(requests.join(table, F.col("service") == F.col("__service"), "left"))


def _with_results(routed: DataFrame, bodies: Mapping[str, Column]) -> DataFrame:
    result = F.lit(None).cast("string")
    for impl, body in bodies.items():
        result = F.when(F.col("impl") == impl, body).otherwise(result)
    return routed.withColumn("result", result)


def route_requests(requests: DataFrame, registry: DataFrame, bodies: Mapping[str, Column],
                   broadcast: bool = True) -> DataFrame:
    """Every request with its implementation and either a result or an error.

    ``requests`` has service, method, param_types and args. A service is looked up by its
    name, then its method by name and parameter types. ``bodies`` has what each
    implementation returns, as an expression over the request. ``broadcast`` measures the
    registry now; a stream leaves that to each of its micro-batches.
    """
    return _with_results(_looked_up(requests, registry, broadcast), bodies)


def route_requests_as_of(requests: DataFrame, registry: DataFrame, bodies: Mapping[str, Column],
                         ts: str = "ts", row_id: str = "event_id", registered_at: str = "registered_at",
                         hot_rows: int | None = None) -> DataFrame:
    """Every request answered by the last registration of its service so far, not of all times.

    ``registry`` has a row per service, ``registered_at``, seq, impl and method with its
    param_types; registrations at one time follow each other by seq, and the request of that
    time comes after them. Requests and registrations are one log per service, along which the
    place of the last registration is carried; a service with very many requests is cut in
    chunks. Registrations come back in by their place. Rows without a time find nothing.
    """
    place = ["__at", "__seq"]
    registrations = cut_lineage(
        registry.where(F.col("service").isNotNull() & F.col(registered_at).isNotNull())
        .groupBy(F.col("service").alias("__service"), F.col(registered_at).alias("__at"),
                 F.col("seq").cast("bigint").alias("__seq"))
        .agg(F.max("impl").alias("__impl"),
             F.collect_set(signature(F.col("method"), F.col("param_types"))).alias("__methods")))
    asked = requests.where(F.col("service").isNotNull() & F.col(ts).isNotNull())
    log = asked.select(
        "service", F.col(ts).alias("__at"), F.lit(1).alias("__kind"), F.col(row_id).cast("bigint").alias("__seq"),
        F.struct(*requests.columns).alias("__request"),
    ).unionByName(registrations.select(
        F.col("__service").alias("service"), "__at", F.lit(0).alias("__kind"), "__seq"), allowMissingColumns=True)
    own = F.when(F.col("__kind") == 0, F.struct(*place))
    carried = running(log, ["service"], ["__at", "__kind", "__seq"], {"__last": ("max", own)}, hot_rows=hot_rows)
    placed = carried.where(F.col("__kind") == 1).select("__request.*", F.col("__last").alias("__place"))
    known = broadcast_if_small(registrations.select(
        "__service", F.struct(*place).alias("__there"), "__impl", "__methods"))
    joined = placed.join(
        known, (F.col("service") == F.col("__service")) & (F.col("__place") == F.col("__there")), "left")
    rest = requests.where(F.col("service").isNull() | F.col(ts).isNull())
    return _with_results(_answered(joined.drop("__place", "__there").unionByName(
        rest, allowMissingColumns=True)), bodies)


def dead_letters(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Requests for a service or method that is not registered, with the error."""
    return _looked_up(requests, registry, True).where(F.col("error").isNotNull()).drop("impl")


def dispatch_summary(routed: DataFrame, service: Sequence[str], caller: str) -> DataFrame:
    """Requests, distinct callers and failures per service and implementation."""
    return routed.groupBy(*service, "impl").agg(
        F.count("*").alias("n_requests"),
        F.count_distinct(caller).alias("n_callers"),
        F.count_if(F.col("impl").isNull()).alias("n_failed"),
    )

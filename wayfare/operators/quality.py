"""Data quality: profiles, cleaning rules, deduplication, event contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from wayfare.functions.frames import complete, computed_once
from wayfare.functions.noise import uniform

# Fixed cleaning rules for New York trips: column, comparison, bound.
NYC_RULES = [
    ("passenger_count", ">=", 1), ("passenger_count", "<=", 6),
    ("trip_distance", ">", 0.0), ("trip_distance", "<", 100.0),
    ("fare_amount", ">", 0.0), ("fare_amount", "<", 500.0),
    ("extra", ">=", 0.0),
    ("mta_tax", ">=", 0.0),
    ("tip_amount", ">=", 0.0), ("tip_amount", "<", 200.0),
    ("tolls_amount", ">=", 0.0), ("tolls_amount", "<", 100.0),
    ("improvement_surcharge", ">=", 0.0),
    ("total_amount", ">", 0.0), ("total_amount", "<", 600.0),
    ("congestion_surcharge", ">=", 0.0),
    ("tpep_pickup_datetime", ">=", "2019-01-01"), ("tpep_pickup_datetime", "<", "2019-04-01"),
]

_COMPARE = {
    ">": lambda c, bound: c > bound, ">=": lambda c, bound: c >= bound,
    "<": lambda c, bound: c < bound, "<=": lambda c, bound: c <= bound,
}


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in each column."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: missing values and their share of all rows in percent."""
    counted = df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return counted.unpivot("total_rows", df.columns, "column_name", "missing_values").select(
        "column_name", "missing_values",
        F.round(F.try_divide(F.col("missing_values") * 100.0, F.col("total_rows")), 2)
        .alias("missing_pct"))


def keep_complete(df: DataFrame, flag: str = "MISSING_DATA") -> DataFrame:
    """Rows whose flag is false; an unknown flag counts as missing."""
    return df.filter(~F.col(flag))


def audit(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before, after and dropped by a filter, in one pass."""
    kept = F.count_if(keep)
    return df.agg(
        F.count("*").alias("rows_before"), kept.alias("rows_after"),
        (F.count("*") - kept).alias("rows_dropped"))


def audit_frames(before: DataFrame, after: DataFrame) -> DataFrame:
    """The same for two frames that no single filter connects."""
    counts = before.agg(F.count("*").alias("n"), F.lit(0).cast("bigint").alias("m")).unionAll(
        after.agg(F.lit(0).cast("bigint"), F.count("*")))
    return counts.agg(
        F.sum("n").alias("rows_before"), F.sum("m").alias("rows_after"),
        (F.sum("n") - F.sum("m")).alias("rows_dropped"))


def sanity(df: DataFrame, entity: str = "TAXI_ID", epoch: str = "TIMESTAMP") -> DataFrame:
    return df.agg(
        F.count_distinct(entity).alias("unique_taxis"),
        F.from_unixtime(F.min(epoch)).alias("first_trip_date"),
        F.from_unixtime(F.max(epoch)).alias("last_trip_date"))


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum, mean and maximum, one row per column, in one pass."""
    parts = [
        agg(F.col(name).cast("double")).alias(f"{prefix}{name}")
        for name in columns for prefix, agg in (("lo_", F.min), ("av_", F.avg), ("hi_", F.max))]
    return df.agg(*parts).select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"lo_{name}").alias("min_value"),
                 F.col(f"av_{name}").alias("mean_value"), F.col(f"hi_{name}").alias("max_value"))
        for name in columns])).alias("s")).select("s.*")


def nyc_condition(rules: list[tuple] = NYC_RULES) -> Column:
    checks = [_COMPARE[sign](F.col(name), F.lit(bound)) for name, sign, bound in rules]
    return reduce(lambda a, b: a & b, checks)


def fill_nyc(df: DataFrame) -> DataFrame:
    return df.drop("airport_fee").fillna({"congestion_surcharge": 0.0})


def clean_nyc(df: DataFrame, rules: list[tuple] = NYC_RULES) -> DataFrame:
    return complete(fill_nyc(df).filter(nyc_condition(rules)), ["PULocationID", "DOLocationID"])


def with_duration(
    df: DataFrame, start: str = "tpep_pickup_datetime", end: str = "tpep_dropoff_datetime",
) -> DataFrame:
    minutes = (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60
    return df.withColumn("duration_min", minutes)


def plausible_trips(df: DataFrame, minutes: tuple[int, int] = (1, 180)) -> DataFrame:
    return with_duration(df).filter(
        F.col("duration_min").between(*minutes) & (F.col("trip_distance") > 0))


def dedupe(df: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties settled by the remaining columns.

    An aggregate, not a ranking: copies of a key collapse on the map side, so a key that
    holds much of the table costs no more than any other.
    """
    rest = [name for name in df.columns if name not in keys]
    ranked = [*order, *[name for name in rest if name not in order]]
    first = F.min(F.struct(*ranked)).alias("_row")
    return df.groupBy(*keys).agg(first).select(*[
        F.col(name) if name in keys else F.col(f"_row.{name}").alias(name)
        for name in df.columns])


def assert_schema(df: DataFrame, expected: str | StructType) -> DataFrame:
    """The frame itself if names and types agree, an error that lists the differences if not."""
    wanted = StructType.fromDDL(expected) if isinstance(expected, str) else expected
    have = {field.name: field.dataType.simpleString() for field in df.schema}
    want = {field.name: field.dataType.simpleString() for field in wanted}
    if have != want:
        names = sorted(name for name in have.keys() | want.keys()
                       if have.get(name) != want.get(name))
        raise ValueError("schema differs: " + ", ".join(
            f"{name} is {have.get(name)}, expected {want.get(name)}" for name in names))
    return df


def sample_trips(
    df: DataFrame, fraction: float = 0.01, seed: int = 42, limit: int | None = None,
    key: str = "TRIP_ID", order: list[str] = (),
) -> DataFrame:
    """A repeatable sample of about ``fraction`` of the keys; on request the first ``limit`` rows of it."""
    draw = uniform(F.col(key), seed, "sample")
    drawn = df.withColumn("_draw", draw).filter(F.col("_draw") < fraction)
    if limit is not None:
        drawn = drawn.orderBy("_draw", key, *order).limit(limit)
    return drawn.drop("_draw")


_NUMERIC = "^(BIGINT|DECIMAL|DOUBLE)"


def _readings(properties: dict) -> dict[str, Column]:
    """What the rules of each property look at: its JSON type, its number, its text."""
    found = {}
    for name, rule in properties.items():
        path = f"$.{name}"
        found[f"_kind_{name}"] = F.schema_of_variant(F.try_variant_get("_doc", path, "variant"))
        if {"minimum", "maximum"} & rule.keys() or rule.get("type") == "integer":
            found[f"_number_{name}"] = F.try_variant_get("_doc", path, "double")
        if {"const", "enum"} & rule.keys():
            found[f"_text_{name}"] = F.try_variant_get("_doc", path, "string")
    return found


def _violations(name: str, rule: dict) -> list[tuple[str, Column]]:
    """Reasons why a present property breaks its rule, each with its condition."""
    kind, number, text = (F.col(f"_{what}_{name}") for what in ("kind", "number", "text"))
    wanted = rule.get("type")
    broken = []
    if wanted == "string":
        broken.append(("type", kind != "STRING"))
    elif wanted == "integer":
        broken.append(("type", ~kind.rlike(_NUMERIC) | (number != F.floor(number))))
    elif wanted == "number":
        broken.append(("type", ~kind.rlike(_NUMERIC)))
    if "const" in rule:
        broken.append(("const", text != str(rule["const"])))
    if "enum" in rule:
        broken.append(("enum", ~text.isin([str(item) for item in rule["enum"]])))
    if "minimum" in rule:
        broken.append(("minimum", number < rule["minimum"]))
    if "maximum" in rule:
        broken.append(("maximum", number > rule["maximum"]))
    return [(f"{label}:{name}", condition) for label, condition in broken]


def validate(df: DataFrame, contract: dict, value: str = "value") -> DataFrame:
    """Add ``reasons``, the rules a JSON event breaks (empty: the event conforms).

    Supports type, const, enum, minimum, maximum, required and additionalProperties.
    """
    properties = contract["properties"]
    required = [
        F.when(~F.array_contains("_keys", name), f"required:{name}")
        for name in contract.get("required", [])]
    broken = [
        F.when(condition, reason)
        for name, rule in properties.items() for reason, condition in _violations(name, rule)]
    extra = F.array()
    if contract.get("additionalProperties") is False:
        known = F.array(*[F.lit(name) for name in properties])
        extra = F.transform(F.array_except("_keys", known),
                            lambda name: F.concat(F.lit("unexpected:"), name))
    found = F.array_sort(F.concat(F.array_compact(F.array(*required, *broken)), extra))
    parsed = computed_once(df, _keys=F.json_object_keys(value), _doc=F.try_parse_json(value))
    read = computed_once(parsed, **_readings(properties))
    return read.withColumn(
        "reasons", F.when(F.col("_keys").isNull(), F.array(F.lit("not an object")))
        .otherwise(found)).drop("_keys", "_doc", *_readings(properties))


def conforming(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("reasons") == 0).drop("reasons")

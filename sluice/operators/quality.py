"""Record standardization, validation, scoring, migration and change data."""

from __future__ import annotations

from collections.abc import Sequence

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import mask_ip
from sluice.functions.times import parse_iso
from sluice.functions.values import col, percent, rows
from sluice.operators.project import computed_once

# The labels of HTTP status classes, and the version stamp of standardized records.
STATUS_CLASSES = ((200, "Success"), (400, "Client Error"), (500, "Server Error"))
ETL_VERSION = "1.0"


def status_class(code: Column | str) -> Column:
    """Class of an HTTP status; null when there is none (or it is zero)."""
    c = col(code)
    label = F.lit("Other")
    for start, name in STATUS_CLASSES:
        label = F.when((c >= start) & (c < start + 100), name).otherwise(label)
    return F.when(c != 0, label)


def standardize(events: DataFrame, processed_at: Column) -> DataFrame:
    """Defaults for missing fields, a hidden address, the status class and the processing stamp."""
    return events.select(
        F.coalesce("timestamp", processed_at.cast(events.schema["timestamp"].dataType)).alias("timestamp"),
        F.coalesce("event_type", F.lit("unknown")).alias("event_type"),
        "user_id",
        mask_ip("ip_address").alias("ip_address"),
        "status_code",
        F.coalesce("response_size", F.lit(0)).alias("response_size"),
        processed_at.alias("processed_at"),
        F.lit(ETL_VERSION).alias("etl_version"),
        status_class("status_code").alias("status_category"),
    )


# JSON records. A record is parsed once, into a VARIANT, and so is each field the rules look at.

# The fields the rules look at.
RULE_FIELDS = ("timestamp", "event_type", "user_id", "value")


def parsed(records: DataFrame, text: str = "record") -> DataFrame:
    """Add ``json`` and, per rule field, its JSON type and its text under ``fields``."""

    def facts(name: str) -> Column:
        value = F.try_variant_get("json", f"$.{name}", "variant")
        as_text = F.try_variant_get("json", f"$.{name}", "string")
        return F.struct(F.schema_of_variant(value).alias("kind"), as_text.alias("text")).alias(name)

    read = computed_once(records, "json", F.try_parse_json(text))
    return computed_once(read, "fields", F.struct(*[facts(n) for n in RULE_FIELDS]))


def field(name: str, kind: str = "string") -> Column:
    if name not in RULE_FIELDS:
        return F.try_variant_get("json", f"$.{name}", kind)
    text = F.col(f"fields.{name}.text")
    return text if kind == "string" else text.try_cast(kind)


def field_kind(name: str) -> Column:
    """JSON type of a field, for example STRING or BIGINT; null when it is absent."""
    return F.col(f"fields.{name}.kind")


def filled(name: str) -> Column:
    """Present and neither null, empty, zero nor false."""
    kind, value = field_kind(name), field(name)
    number = value.try_cast("double")
    full = (
        F.when(kind == "STRING", value != "")
        .when(kind == "VOID", F.lit(False))
        .when(kind == "BOOLEAN", value == "true")
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), ~value.isin("{}", "[]"))
        .otherwise(number != 0)
    )
    return F.coalesce(full, F.lit(False))


def whole_number(name: str) -> Column:
    return F.coalesce(field_kind(name).isin("BIGINT", "BOOLEAN"), F.lit(False))


def completeness_tag() -> Column:
    """``valid`` when both key fields exist, even if they are null."""
    both = field_kind("timestamp").isNotNull() & field_kind("event_type").isNotNull()
    return F.when(both, "valid").otherwise("incomplete")


# The fields each rule set asks for.
VALID_NEEDS = ("timestamp", "event_type")
SCORE_NEEDS = ("timestamp", "event_type", "user_id")


def is_valid() -> Column:
    """Key fields filled, the time in ISO form, and a user id, if any, that is a number."""
    rule = parse_iso(field("timestamp")).isNotNull()
    rule = rule & (field_kind("timestamp") == "STRING")
    for name in VALID_NEEDS:
        rule = rule & filled(name)
    rule = rule & (~filled("user_id") | whole_number("user_id"))
    return F.coalesce(rule, F.lit(False))


def type_errors() -> Column:
    """Names of the fields that are present with the wrong type."""
    has = {n: field_kind(n) for n in ("timestamp", "event_type", "user_id", "value")}
    wrong = [
        F.when(has["timestamp"] != "STRING", "timestamp"),
        F.when(has["event_type"] != "STRING", "event_type"),
        F.when(~has["user_id"].isin("BIGINT", "VOID"), "user_id"),
        F.when(~(has["value"].startswith("DECIMAL") | has["value"].isin("BIGINT", "DOUBLE", "VOID")), "value"),
    ]
    return F.array_compact(F.array(*wrong))


def rule_errors(rules: dict[str, Column]) -> Column:
    """Names of the rules a record breaks; a rule that cannot be evaluated counts as kept."""
    return F.array_compact(F.array(*[F.when(~keeps, name) for name, keeps in rules.items()]))


def missing_fields(names: tuple[str, ...]) -> Column:
    absent = [F.when(field(n).isNull(), n) for n in names]
    return F.array_compact(F.array(*absent))


def default_rules() -> dict[str, Column]:
    """Format of the time and range of the value."""
    stamp = field("timestamp")
    return {
        "timestamp_format": stamp.isNull() | parse_iso(stamp).isNotNull(),
        "value_range": F.coalesce(field("value", "double") >= 0, F.lit(True)),
    }


# Points lost per missing field, type error and broken rule.
LOST = {"missing": 13, "type": 10, "rule": 10}


def score(rules: dict[str, Column]) -> Column:
    """Quality of a record from 0 to 100."""
    empty = sum((~filled(n)).cast("int") for n in SCORE_NEEDS)
    lost = (
        empty * LOST["missing"]
        + F.size(type_errors()) * LOST["type"]
        + F.size(rule_errors(rules)) * LOST["rule"]
    )
    return F.greatest(F.lit(0), F.lit(100) - lost)


def record_errors() -> Column:
    """Everything wrong with a record, as ``kind:field`` entries; empty for a good record."""

    def labelled(kind: str, names: Column) -> Column:
        return F.transform(names, lambda n: F.concat(F.lit(f"{kind}:"), n))

    found = F.concat(
        labelled("missing", missing_fields(SCORE_NEEDS)),
        labelled("type", type_errors()),
        labelled("rule", rule_errors(default_rules())),
    )
    return F.when(F.col("json").isNull(), F.array(F.lit("json:record"))).otherwise(found)


def good_and_bad(records: DataFrame, failed_at: Column, text: str = "record") -> tuple[DataFrame, DataFrame]:
    """Split records in good ones and dead letters, which keep the original text and the reason."""
    checked = computed_once(parsed(records, text), "_errors", record_errors())
    good = checked.filter(F.size("_errors") == 0).drop("_errors")
    bad = checked.filter(F.size("_errors") > 0).select(
        *[c for c in records.columns if c != text],
        F.col(text).alias("original_record"),
        F.array_join("_errors", "; ").alias("error"),
        failed_at.alias("timestamp"),
        F.lit(0).alias("retry_count"),
    )
    return good, bad


def quality_metrics(
    records: DataFrame, at: str, period: str = "5 minutes", text: str = "record", dimensions: Sequence[str] = ()
) -> DataFrame:
    """Total, valid and invalid records per period and dimensions; every record counts, parsable or not."""
    checked = parsed(records, text).select(at, *dimensions, is_valid().alias("_valid"))
    valid = F.count_if("_valid")
    return (
        checked.groupBy(F.window(at, period).alias("window"), *dimensions)
        .agg(
            rows().alias("total_records"),
            valid.alias("valid_records"),
            F.count_if(~F.col("_valid")).alias("invalid_records"),
            (valid.cast("double") * 100.0 / F.greatest(rows(), F.lit(1))).alias("quality_rate"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            *dimensions,
            "total_records", "valid_records", "invalid_records", "quality_rate",
        )
    )


def quality_report(records: DataFrame, key: str, text: str = "record") -> DataFrame:
    """Schema compliance, type accuracy, duplicate rate and mean score of a table, in one row.

    Per key the row count and the sums are taken first, so duplicates need no second pass.
    """
    checked = parsed(records, text).select(
        key,
        (F.size(missing_fields(SCORE_NEEDS)) == 0).cast("bigint").alias("_complete"),
        F.size(type_errors()).cast("bigint").alias("_wrong"),
        score(default_rules()).cast("bigint").alias("_score"),
    )
    sums = [F.sum(c).alias(c) for c in ("_complete", "_wrong", "_score")]
    per_key = checked.groupBy(key).agg(rows().alias("_n"), *sums)
    fields = 4
    n = F.sum("_n")
    return per_key.agg(
        n.alias("total_records"),
        percent(F.sum("_complete"), n).alias("schema_compliance"),
        percent(n * fields - F.sum("_wrong"), n * fields).alias("type_accuracy"),
        percent(F.sum(F.col("_n") - 1), n).alias("duplicate_rate"),
        F.try_divide(F.sum("_score").cast("double"), n.cast("double")).alias("quality_score"),
    )


def source_statistics(checked: DataFrame, source: str, ok: Column) -> DataFrame:
    """Sent and failed records per source."""
    return checked.groupBy(source).agg(
        F.count_if(ok).alias("sent"),
        F.count_if(~ok).alias("failed"),
        percent(F.count_if(ok), rows()).alias("success_rate"),
    )


# Schema versions.


def _to_v1_1(df: DataFrame) -> DataFrame:
    return df.withColumn("session_id", F.coalesce("session_id", F.lit("unknown")))


def _to_v1_2(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "value": F.coalesce(F.col("value").try_cast("double"), F.lit(0.0)),
            "properties": F.coalesce(F.to_json("properties"), F.lit("{}")),
        }
    )


# Each step lifts records of any earlier version; applying one twice changes nothing.
MIGRATIONS: tuple[tuple[str, Callable[[DataFrame], DataFrame]], ...] = (("v1.1", _to_v1_1), ("v1.2", _to_v1_2))


def migrate(df: DataFrame, version: str = "version") -> DataFrame:
    """Bring records of all versions, held in the columns of the newest one, to that version."""
    for _, step in MIGRATIONS:
        df = step(df)
    return df.withColumn(version, F.lit(MIGRATIONS[-1][0]))


# Change data.


def classify_changes(changes: DataFrame, important: list[str]) -> DataFrame:
    """What a change record means: new, deleted, an important field changed, or an ordinary update."""
    differs = F.lit(False)
    for name in important:
        differs = differs | ~F.col(f"before.{name}").eqNullSafe(F.col(f"after.{name}"))
    label = (
        F.when(F.col("operation") == "INSERT", "new_record")
        .when(F.col("operation") == "DELETE", "record_deleted")
        .when(differs, "important_update")
        .otherwise("ordinary_update")
    )
    return changes.withColumn("change_type", label)


def apply_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Latest state per key without the deleted ones.

    The newest change is found by an aggregation, so a key with many changes is reduced
    inside every task first.
    """
    place = F.struct("timestamp", "transaction_id")
    newest = changes.groupBy(*keys).agg(
        F.max_by(F.struct("operation", "after", "timestamp"), place).alias("_last")
    )
    alive = newest.filter(F.col("_last.operation") != "DELETE")
    return alive.select(*keys, "_last.after.*", F.col("_last.timestamp").alias("changed_at"))

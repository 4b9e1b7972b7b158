"""Parsing of web server and application log lines into one log table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.times import parse_access_time, parse_iso
from sluice.functions.values import col, percent, rows
from sluice.operators.project import computed_once

# The two access log formats and the columns of their nine groups.
APACHE = (
    r'(\S+) \S+ \S+ \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) (\S+)" (\d{3}) (\d+|-) "([^"]*)" "([^"]*)"'
)
NGINX = r'(\S+) - - \[(.*?)\] "(\S+) (\S+) (\S+)" (\d+) (\d+) "([^"]*)" "([^"]*)"'
GROUPS = (
    "ip_address", "time_text", "method", "path", "protocol", "status_text", "size_text", "referer", "user_agent",
)

MARK = "\u0001"


def access_fields(line: Column | str, pattern: str) -> Column:
    """The groups of an access log line as an array; null when the line does not match.

    One replacement joins the groups by a mark that one split takes apart again, so the
    pattern runs once per line instead of once per group.
    """
    text = F.translate(F.trim(col(line)), MARK, "")
    marked = F.regexp_replace(text, f"(?s)^{pattern}.*$", MARK.join(f"${i + 1}" for i in range(len(GROUPS))))
    parts = F.split(marked, MARK)
    return F.when(F.size(parts) == len(GROUPS), parts)


def parse_access(df: DataFrame, line: str, pattern: str, log_type: str, received_at: Column | None = None) -> DataFrame:
    """Parsed access log lines; lines of another format are left out.

    A time that cannot be read becomes ``received_at`` (null when not given).
    """
    found = computed_once(df, "_parts", access_fields(line, pattern)).filter(F.col("_parts").isNotNull())
    part = {name: F.col("_parts")[i] for i, name in enumerate(GROUPS)}
    when = parse_access_time(part["time_text"])
    return found.withColumns(
        {
            "timestamp": F.coalesce(when, received_at) if received_at is not None else when,
            **{name: part[name] for name in ("ip_address", "method", "path", "protocol")},
            "status_code": part["status_text"].try_cast("int"),
            "response_size": F.coalesce(part["size_text"].try_cast("int"), F.lit(0)),
            "referer": F.nullif(part["referer"], F.lit("-")),
            "user_agent": part["user_agent"],
            "log_type": F.lit(log_type),
        }
    ).drop("_parts", line)


def parse_apache(df: DataFrame, line: str = "line", received_at: Column | None = None) -> DataFrame:
    return parse_access(df, line, APACHE, "apache_access", received_at)


def parse_nginx(df: DataFrame, line: str = "line", received_at: Column | None = None) -> DataFrame:
    return parse_access(df, line, NGINX, "nginx_access", received_at)


def parse_application(df: DataFrame, line: str = "line", received_at: Column | None = None) -> DataFrame:
    """JSON application log lines with defaults; anything else is kept as a text message."""
    read = computed_once(df, "_json", F.try_parse_json(F.trim(line)))
    is_record = F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False))

    def field(name: str, default: str | None = None) -> Column:
        value = F.try_variant_get("_json", f"$.{name}", "string")
        value = value if default is None else F.coalesce(value, F.lit(default))
        return F.when(F.col("_record"), value)

    when = parse_iso(field("timestamp"))
    return (
        read.withColumn("_record", is_record)
        .withColumns(
            {
                "timestamp": F.coalesce(when, received_at) if received_at is not None else when,
                "level": F.coalesce(field("level"), F.lit("INFO")),
                "message": F.when(F.col("_record"), F.coalesce(field("message"), F.lit(""))).otherwise(F.trim(line)),
                "logger": field("logger", "unknown"),
                "thread": field("thread"),
                "exception": field("exception"),
                "user_id": field("user_id"),
                "request_id": field("request_id"),
                "log_type": F.when(F.col("_record"), "application").otherwise("application_text"),
            }
        )
        .drop("_json", "_record", line)
    )


def unify(*logs: DataFrame) -> DataFrame:
    """One table over all log types; columns a type does not have are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def parse_rate(lines: DataFrame, line: str = "line", log_type: str = "log_type") -> DataFrame:
    """Share of lines per log type that their own format accepts."""
    fits = F.when(F.col(log_type) == "nginx_access", access_fields(line, NGINX).isNotNull()).otherwise(
        access_fields(line, APACHE).isNotNull()
    )
    tried = computed_once(lines.select(log_type, line), "_fits", fits)
    return tried.groupBy(log_type).agg(
        rows().alias("lines"),
        F.count_if("_fits").alias("parsed"),
        percent(F.count_if("_fits"), rows()).alias("success_rate"),
    )


def routing_key(source: Column | str) -> Column:
    """Key that keeps related records together: by session or address, request, transaction, device."""
    s = col(source)
    return (
        F.when(s == "web", F.coalesce("session_id", "ip_address"))
        .when(s == "database", F.concat_ws("_", "table", "transaction_id"))
        .when(s == "sensor", F.col("device_id"))
        .otherwise(F.coalesce("ip_address", "request_id", F.lit("default")))
    )

"""Scalar expressions over columns: text, JSON, identifiers, dates and numbers. None is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Models of another cloud than the one that reports them. The prefixes cover today's exact entries too.
MODEL_CLOUD = {
    "eu.amazon.nova-2-lite-v1:0": "aws",
    "us.amazon.nova-2-lite-v1:0": "aws",
    "amazon.nova-lite-v1:0": "aws",
    "amazon.nova-pro-v1:0": "aws",
    "amazon.nova-micro-v1:0": "aws",
    "amazon.titan-embed-text-v2:0": "aws",
    "amazon.titan-embed-text-v1": "aws",
}
AWS_MODEL_PREFIX = r"^(arn:aws:|amazon\.|eu\.amazon\.|us\.amazon\.)"

# Unicode's white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# Span kinds by operation.
SPAN_KINDS = {"invoke_agent": "agent_run", "create_agent": "agent_run", "chat": "model_call", "text_completion": "model_call", "execute_tool": "tool_call"}

# Services that connector names start with, in the order in which they are tried.
CONNECTORS = [
    "Excel Online (Business)", "Office 365 Outlook", "Microsoft Dataverse", "Microsoft Teams", "OneDrive for Business", "Azure DevOps",
    "Generative actions", "Human review", "MSN Weather", "SharePoint", "Redmine", "Jira", "Mail",
]


def c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: str | Column) -> Column:
    """Without white space, Unicode's included, at both ends. Only the ends are looked at; a pattern would be tried at each place of a text."""
    return F.btrim(c(x).cast("string"), F.lit(WHITE))


def text(x: str | Column) -> Column:
    """Stripped text; empty becomes null."""
    return F.nullif(strip(x), F.lit(""))


def hash16(x: str | Column) -> Column:
    """The first 16 hexadecimal digits of the stripped text's SHA-256."""
    return F.left(F.sha2(strip(x), 256), F.lit(16))


def json_or_null(x: str | Column) -> Column:
    """A JSON text that says nothing becomes null."""
    return F.when(F.trim(c(x)).isin("", "[]", "{}", "null"), None).otherwise(c(x))


def braced(x: str | Column) -> Column:
    """Whether a text, if it is JSON, is an object: told by its first character, where a variant's schema would go through all of its values."""
    return F.ltrim(c(x).cast("string"), F.lit(" \t\n\r")).startswith("{")


def drift_object(x: str | Column) -> Column:
    """A JSON object as a variant; anything else is an empty object."""
    return F.coalesce(F.when(braced(x), F.try_parse_json(c(x).cast("string"))), F.parse_json(F.lit("{}")))


def safe_long(x: str | Column) -> Column:
    return c(x).try_cast("double").try_cast("bigint")


def safe_double(x: str | Column) -> Column:
    return c(x).try_cast("double")


def first_of_list(x: str | Column) -> Column:
    """The first element of a JSON list of strings."""
    return F.get(F.from_json(c(x), "array<string>"), F.lit(0))


def dotnet_date(x: str | Column) -> Column:
    """``/Date(ms)/`` as ISO text in UTC; other text passes; what doesn't fit is null."""
    millis = F.regexp_extract(c(x), r"^/Date\((-?\d+)(?:[+-]\d{4})?\)/$", 1).try_cast("bigint")
    fits = millis.between(-62135596800000, 253402300799999)
    iso = F.date_format(F.timestamp_millis(F.when(fits, millis)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(c(x).startswith("/Date("), iso).otherwise(c(x))


def model_cloud(x: str | Column, reported_by: str | Column, exact: dict[str, str] = MODEL_CLOUD) -> Column:
    """The cloud that bills a model: an exact entry, else its prefix, else the cloud that reports it."""
    table = F.create_map(*[F.lit(v) for kv in exact.items() for v in kv])
    return F.coalesce(F.element_at(table, c(x)), F.when(F.lower(c(x)).rlike(AWS_MODEL_PREFIX), "aws").otherwise(c(reported_by)))


def identity_base(x: str | Column) -> Column:
    """An id without its last ``:suffix``, whatever that is."""
    return F.regexp_replace(c(x), r":[^:]*$", "")


def id_head(x: str | Column) -> Column:
    """An id up to its first colon; null is empty."""
    return F.split_part(F.coalesce(c(x), F.lit("")), F.lit(":"), F.lit(1))


def span_kind(operation: str | Column) -> Column:
    """Span kind by operation; unknown operations pass."""
    pairs = [F.lit(v) for kv in SPAN_KINDS.items() for v in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), c(operation)), c(operation))


def date_key(x: str | Column) -> Column:
    """yyyymmdd of the first ten characters, as they are written; null if that isn't a date."""
    day = F.left(c(x).cast("string"), F.lit(10))
    return F.when(F.try_to_date(day, "yyyy-MM-dd").isNotNull(), F.replace(day, F.lit("-"), F.lit("")).try_cast("int"))


def key_date(x: str | Column) -> Column:
    """The date of a yyyymmdd number."""
    return F.try_to_date(c(x).cast("string"), "yyyyMMdd")


def iso_day(x: str | Column) -> Column:
    """A yyyymmdd number as ISO text; other text passes."""
    s = F.coalesce(c(x).try_cast("bigint").cast("string"), c(x).cast("string"))
    return F.when(F.length(s) == 8, F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))).otherwise(s)


def nanos_iso(x: str | Column) -> Column:
    """Nanoseconds since the epoch as ISO text in UTC."""
    micros = F.call_function("div", c(x).try_cast("bigint"), F.lit(1000).cast("bigint"))
    return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_stamp(x: str | Column) -> Column:
    """A timestamp as ISO text in UTC; text passes as it is."""
    return F.date_format(c(x), "yyyy-MM-dd'T'HH:mm:ssXXX")


def utc_stamp(x: str | Column) -> Column:
    """Naive times are UTC."""
    return F.try_to_timestamp(F.when(c(x).endswith("Z"), c(x)).otherwise(F.concat(c(x), F.lit("Z"))))


def signal_class(x: str | Column) -> Column:
    """What is known of an unregistered caller."""
    return (
        F.when(c(x).isNull() | (c(x) == ""), "no_agent_id")
        .when(c(x).rlike("^[0-9a-f]{8}-[0-9a-f]{4}-"), "guid_only")
        .otherwise("named_unregistered")
    )


def is_http_error(x: str | Column) -> Column:
    return F.coalesce(c(x).rlike("^[45]"), F.lit(False))


def effective_cost() -> Column:
    """Effective cost, else billed, else 0."""
    return F.coalesce(F.col("effective_cost"), F.col("billed_cost"), F.lit(0)).cast("decimal(18,2)")


def millionths(amount: str | Column) -> Column:
    """A double as a decimal of six places, rounded in binary arithmetic as SQL engines do: times a million, half away from zero, and back.

    ``round`` goes by the shortest decimal text of a double instead. From about 10^8 on doubles are so far apart that the two differ in the last place.
    """
    whole = F.round(F.round(c(amount) * 1e6) / 1e6 * 1e6).try_cast("bigint")  # null beyond 9 * 10^12
    exact = whole.cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(6,6)")
    return F.coalesce(exact.cast("decimal(38,6)"), F.round(c(amount), 6).cast("decimal(38,6)"))


def metric_stat(name: str | Column) -> Column:
    """Latencies are averaged, counts are summed."""
    return F.when(F.lower(c(name)).rlike("latency|time"), "Average").otherwise("Sum")


def token_total(total: Column, input_: Column, output: Column) -> Column:
    """The total, else input plus output with a missing one as 0, else null."""
    parts = F.coalesce(input_, F.lit(0)) + F.coalesce(output, F.lit(0))
    return F.coalesce(total, F.when(input_.isNotNull() | output.isNotNull(), parts))


# Status codes of a failed span, in upper case.
FAILED = ["ERROR", "STATUS_CODE_ERROR"]


def span_error(status_code: Column, message: Column, http: Column, exception: Column) -> Column:
    """Error label: of a failed status its message, the exception or ERROR; of HTTP 400 and up its number; the exception."""
    failed = status_code.isin(FAILED) | (status_code.rlike("(?i)error$") & F.upper(status_code).isin(FAILED))  # upper case by Unicode's rules is dear, and no other letters become ERROR
    named = F.nullif(exception, F.lit(""))
    return F.when(failed, F.coalesce(F.nullif(message, F.lit("")), named, F.lit("ERROR"))).when(http >= 400, F.concat(F.lit("HTTP "), http.cast("string"))).otherwise(named)


def resource_part(x: str | Column, part: str) -> Column:
    """A segment of a resource id such as ``subscriptions`` or ``resourcegroups``; null if absent."""
    return F.nullif(F.regexp_extract(c(x), rf"(?i)(?:^|/){part}/([^/]+)", 1), F.lit(""))


def connector_service(x: str | Column, services: list[str] = CONNECTORS) -> Column:
    """The first listed service that a connector's name is or starts with, else the name."""
    found = c(x)
    for service in reversed(services):
        found = F.when((c(x) == service) | c(x).startswith(service + " "), F.lit(service)).otherwise(found)
    return found


def window_start(target: str | Column, days: int = 3) -> Column:
    """First day of the window in which late reports are read again."""
    return F.date_sub(c(target), days - 1)


def scan_start(cursor: str | Column, end: str | Column, lookback_days: int) -> Column:
    """Where a scan starts: at the cursor, else some days back, never behind its end."""
    return F.least(F.coalesce(c(cursor), F.date_sub(c(end), lookback_days)), c(end))


def content_window_start(cursor: str | Column, now: str | Column) -> Column:
    """Start of a content scan: the cursor, or six hours back at first, but within the seven days less ten minutes that are kept."""
    oldest = c(now) - F.expr("INTERVAL 7 DAYS") + F.expr("INTERVAL 10 MINUTES")
    return F.greatest(F.coalesce(c(cursor), c(now) - F.expr("INTERVAL 6 HOURS")), oldest)


def content_window_end(start: Column, now: str | Column) -> Column:
    """End of a content scan: at most a day behind its start."""
    return F.least(start + F.expr("INTERVAL 24 HOURS"), c(now))

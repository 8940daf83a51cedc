"""Request texts to structured, redacted records."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import redact, request
from ..functions.text import is_blank, last_win_map

EMPTY_ENTRIES = "array<struct<key:string,value:string>>"


def _no_entries() -> Column:
    return F.array().cast(EMPTY_ENTRIES)


@lru_cache(maxsize=64)
def _expressions(jvm: int, text: str) -> dict[str, Column]:
    """The expressions of the parser, which depend on nothing but the name of the text column.

    They are many; building them once per JVM keeps the set-up of a query or micro-batch short.
    """
    source = F.col(text)
    is_get = F.col("_method").eqNullSafe(F.lit("GET"))
    named = F.col("_named")

    def carries(names: tuple[str, ...]) -> Column:
        return (
            redact.names_any(named, names)
            | request.url_has_param(F.col("_url"), names)
            | (F.col("_multipart") & request.multipart_has_field(F.col("_body"), names))
        )

    return {
        "method": request.method(source),
        "body": request.body(source),
        "payload": F.when(
            is_get & request.has_payload(F.col("_body")), request.payload_entries(request.last_line(F.col("_body")))
        ).otherwise(_no_entries()),
        "bad": is_blank(source) | F.col("_method").isNull() | F.col("_payload").isNull(),
        "multipart": ~is_get & request.is_multipart(F.col("_body")),
        "lines": F.when(~is_get, request.lines(F.col("_body"))),
        "host": request.host(source).alias("host"),
        "raw_url": request.url(source).alias("_url"),
        "raw_fields": F.when(is_get, F.col("_payload"))
        .otherwise(request.header_entries(request.header_lines(F.col("_body"), F.col("_lines"), F.col("_multipart"))))
        .alias("_fields"),
        "raw_form": request.form_entries(F.col("_lines")).alias("_form"),
        "named": F.concat("_fields", F.coalesce("_form", _no_entries())),
        "found": redact.credentials(F.array_append(redact.texts_of(named), F.col("_url"))),
        "url": redact.redact_url(F.col("_url"), F.col("_found")).alias("url"),
        "has_username": carries(redact.USERNAME_FIELDS).alias("has_username"),
        "has_password": carries(redact.PASSWORD_FIELDS).alias("has_password"),
        "has_basic": request.has_authorization(source, "basic").alias("has_basic"),
        "has_bearer": request.has_authorization(source, "bearer").alias("has_bearer"),
        "has_session": request.has_session_cookie(source).alias("has_session"),
        "has_key": (F.size("_found") > 0).alias("has_key"),
        "has_userinfo": request.has_userinfo(F.col("_url")).alias("has_userinfo"),
        "fields": last_win_map(redact.redact_entries(F.col("_fields"), found=F.col("_found"))).alias("fields"),
        "request_parameters": redact.redact_entries(F.col("_form"), found=F.col("_found")).alias("request_parameters"),
    }


def _parser(text: str) -> dict[str, Column]:
    return _expressions(id(SparkContext._gateway), text)


def classify(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_method``, ``_body``, ``_payload`` and the flag ``_bad`` for texts that are no request.

    Bad are: empty or unreadable texts, texts without a request line, a GET with a payload that is not the JSON it should be.
    """
    x = _parser(text)
    df = df.withColumns({"_method": x["method"], "_body": x["body"]})
    return df.withColumn("_payload", x["payload"]).withColumn("_bad", x["bad"])


def observe_bad(df: DataFrame, observation: Observation | str | None) -> DataFrame:
    """Count the records and the bad ones on the way through; a name works for streams too.

    Always present: the filter above it then uses the classified columns instead of being pushed below
    them, where it would parse every payload a second time.
    """
    return df.observe(
        observation or f"parse_requests-{uuid.uuid4().hex}",
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("_bad")).alias("bad_records"),
    )


def parse_requests(
    df: DataFrame,
    text: str = "text",
    keep: Iterable[str] = (),
    observation: Observation | str | None = None,
) -> DataFrame:
    """One row per well-formed request; the raw text is not among the output columns.

    Output: ``keep`` + ``host, url, action_type, has_username, has_password, has_basic, has_bearer, has_session,
    has_userinfo, has_key, fields, request_parameters``. Values of sensitive fields are replaced here and nowhere later.
    """
    keep = list(keep)
    if text in keep:
        raise ValueError("the raw text is not kept: it may hold credentials")
    x = _parser(text)
    good = observe_bad(classify(df, text), observation).filter(~F.col("_bad"))
    raw = (
        good.withColumns({"_lines": x["lines"], "_multipart": x["multipart"]})
        .select(
            *keep,
            "_body",
            "_multipart",
            x["host"],
            x["raw_url"],
            x["has_basic"],
            x["has_bearer"],
            x["has_session"],
            F.col("_method").alias("action_type"),
            x["raw_fields"],
            x["raw_form"],
        )
        .withColumn("_named", x["named"])
        .withColumn("_found", x["found"])
    )
    return raw.select(
        *keep,
        "host",
        x["url"],
        "action_type",
        x["has_username"],
        x["has_password"],
        "has_basic",
        "has_bearer",
        "has_session",
        x["has_userinfo"],
        x["has_key"],
        x["fields"],
        x["request_parameters"],
    )

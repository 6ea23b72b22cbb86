"""From request envelopes to typed event records: unpack, validate, flatten, enrich, parse and route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.functions import is_bot, stage_part
from playtide.schema import BATCH_SCHEMA, EVENT_SCHEMA, INGEST_COLUMNS, RENAMED_FIELDS, STRUCTURED_FIELDS, names

# Limits and defaults of the ingest contract.
MAX_USER_KEY = 64
MAX_APP_VERSION = 20
MAX_SCHEMA_VERSION = 4
MAX_NICKNAME = 30
MAX_BATCH_EVENTS = 50
DEFAULT_APP_VERSION = "0.1.0"
DEFAULT_SCHEMA_VERSION = "1"
CURRENT_SCHEMA_VERSION = "2"

_KINDS = {f.name: f.dataType for f in EVENT_SCHEMA.fields} | dict(INGEST_COLUMNS)


def _whole(value: Column) -> Column:
    """A variant that stands for a whole number (12, 12.0 or "12") as bigint, else null."""
    text = F.try_variant_get(value, "$", "string")
    number = text.try_cast("decimal(38,10)")
    # The plain form is nearly all there is; 12.0 and 1e3 go through the decimal.
    return F.coalesce(text.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))


def parse_batches(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the request's ``user_key``, ``app_version`` and ``events``; null where the text does not fit.

    Event fields are read as variants, so that a missing one, a null and a wrong type can be told apart: whole numbers may come as
    text or as 1.0; ``null_version`` of an event marks versions that are null, not left out. ``inline`` parses each
    text, and reads each event's fields, once; plain expressions would be repeated in every limit that is checked.
    ``payload`` stays a variant here; ``object_payload`` is false where it is there and no object.
    """
    request = F.from_json(value, BATCH_SCHEMA, {"mode": "PERMISSIVE"})
    event = lambda e: F.struct(
        e["event_type"].alias("event_type"), e["session_id"].alias("session_id"), _whole(e["client_timestamp"]).alias("client_timestamp"),
        *(F.try_variant_get(e[name], "$", "string").alias(name) for name in ("app_version", "schema_version")),
        e["payload"].alias("payload"),
        # Only an object can be read as a struct, here one without fields.
        (e["payload"].isNull() | F.try_variant_get(e["payload"], "$", "struct<>").isNotNull()).alias("object_payload"),
        (F.is_variant_null(e["app_version"]) | F.is_variant_null(e["schema_version"])).alias("null_version"))
    parsed = df.select(*df.columns, F.inline(F.array(request)))
    head = [*df.columns, "user_key", "app_version"]
    return parsed.select(*head, F.inline(F.array(F.struct(F.transform("events", event).alias("events")))))


def _broken(checks: dict[str, Column]) -> Column:
    """Names of the checks that fail; a check that cannot be decided does not."""
    return F.array_compact(F.array(*[F.when(check, F.lit(name)) for name, check in checks.items()]))


def validate_batches(df: DataFrame) -> DataFrame:
    """Add ``errors``, the limits a request breaks; a request with any error is refused as a whole."""
    events = F.col("events")
    incomplete = F.exists(
        events, lambda e: e["event_type"].isNull() | e["session_id"].isNull() | e["client_timestamp"].isNull()
    )
    return df.withColumn("errors", _broken({
        "user_key": F.col("user_key").isNull() | (F.length("user_key") > MAX_USER_KEY),
        "app_version": F.length("app_version") > MAX_APP_VERSION,
        "events": events.isNull() | ~F.size(events).between(1, MAX_BATCH_EVENTS),
        "event": incomplete,
        "payload": F.exists(events, lambda e: ~e["object_payload"]),
        "version": F.exists(events, lambda e: e["null_version"]),
        "event_app_version": F.exists(events, lambda e: F.length(e["app_version"]) > MAX_APP_VERSION),
        "event_schema_version": F.exists(events, lambda e: F.length(e["schema_version"]) > MAX_SCHEMA_VERSION),
    }))


def validate_scores(df: DataFrame) -> DataFrame:
    """Add ``errors`` to submitted scores: an over-long user key, no mode or a negative count."""
    return df.withColumn("errors", _broken({
        "user_key": F.col("user_key").isNull() | (F.length("user_key") > MAX_USER_KEY),
        "mode": F.col("mode").isNull(),
        "score": F.col("score").isNull() | (F.col("score") < 0),
        "stages_cleared": F.col("stages_cleared") < 0,
        "universal_used": F.col("universal_used") < 0,
    }))


def validate_users(df: DataFrame) -> DataFrame:
    """Add ``errors`` to user records: an over-long key or nickname."""
    return df.withColumn("errors", _broken({
        "user_key": F.col("user_key").isNull() | (F.length("user_key") > MAX_USER_KEY),
        "nickname": F.length("nickname") > MAX_NICKNAME,
    }))


def explode_batches(df: DataFrame, *keep: str) -> DataFrame:
    """One row per event of the valid requests, with the contract's defaults filled in."""
    return (
        df.filter(F.size("errors") == 0)
        .select(*keep, "user_key", F.posexplode("events").alias("batch_pos", "event"))
        .select(
            *keep, "user_key", "batch_pos", "event.event_type", "event.session_id", "event.client_timestamp",
            F.coalesce("event.app_version", F.lit(DEFAULT_APP_VERSION)).alias("app_version"),
            # An empty version counts as the first one.
            F.coalesce(F.nullif("event.schema_version", F.lit("")), F.lit(DEFAULT_SCHEMA_VERSION)).alias("schema_version"),
            F.coalesce(F.to_json("event.payload"), F.lit("{}")).alias("payload"),
        )
    )


def enrich(df: DataFrame, server_time: Column | None = None, event_id: Column | None = None) -> DataFrame:
    """Add the server's id and receive time.

    The default id is random: write the result before using it twice. All events of a micro-batch get one time.
    """
    now = F.unix_millis(F.current_timestamp()) if server_time is None else server_time
    return df.withColumns({"event_id": F.uuid() if event_id is None else event_id, "timestamp": now})


def flatten_payload(df: DataFrame) -> DataFrame:
    """Lift the known payload fields into columns and keep the rest as JSON in ``extra``.

    The version is compared as text: from "2" on the payload is flattened, before it stays whole in ``payload``. A column that has two
    names takes the plain one first (``from_screen`` before ``from``); the platform may sit inside ``device_info``, which stays in
    ``extra`` as well and gives way to a plain platform. A value that does not fit its column, such as a score of 12.7, stays in ``extra``.
    """
    flat = F.col("schema_version") >= F.lit(CURRENT_SCHEMA_VERSION)
    sources = {field: [field] for field in STRUCTURED_FIELDS}
    for payload_name, column in RENAMED_FIELDS.items():
        sources[column].append(payload_name)
    kinds = {name: _KINDS[field] for field, listed in sources.items() for name in listed}

    def fitted(value: Column, kind: T.DataType) -> Column:
        return F.try_variant_get(value, "$", "string") if isinstance(kind, T.StringType) else _whole(value).try_cast(kind)

    def lifted(field: str) -> Column:
        found = [fitted(F.col("_values")[name], _KINDS[field]) for name in sources[field]]
        if field == "platform":
            found.append(F.try_variant_get(F.col("_values")["device_info"], "$.platform", "string"))
        return F.when(flat, F.coalesce(*found))

    texts, wide, narrow = ([n for n, kind in kinds.items() if isinstance(kind, t)] for t in (T.StringType, T.LongType, T.IntegerType))
    taken = lambda name, value: F.is_variant_null(value) | F.when(
        name.isin(texts), F.try_variant_get(value, "$", "string").isNotNull()
    ).when(name.isin(wide), _whole(value).isNotNull()).when(name.isin(narrow), _whole(value).try_cast("int").isNotNull()).otherwise(False)
    rest = F.to_json(F.map_filter("_values", lambda name, value: ~(name.isin(list(kinds)) & taken(name, value))))
    # ``inline`` parses each payload once; fields and rest come from the same map.
    return (
        df.select("*", F.inline(F.array(F.struct(F.from_json("payload", "map<string,variant>").alias("_values")))))
        .withColumns({**{field: lifted(field) for field in STRUCTURED_FIELDS}, "_rest": F.when(flat, rest)})
        .withColumns({"extra": F.when(F.col("_rest") != "{}", F.col("_rest")), "payload": F.when(~flat, F.col("payload"))})
        .drop("_rest", "_values")
    )


def ingest_records(df: DataFrame, value: str = "value") -> DataFrame:
    """Requests as JSON text to event records: parse, validate, unpack, enrich and flatten in one projection."""
    return flatten_payload(enrich(explode_batches(validate_batches(parse_batches(df, value)))))


def to_message(df: DataFrame, key: str = "user_key") -> DataFrame:
    """Key and JSON value of each record, ready for a message topic."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def parse_events(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to the typed event columns plus ``error``.

    Unknown fields are ignored; numbers that are absent, null or empty text read 0, numbers may come as text, and fractions are
    cut off. ``error`` is null, ``json`` for text that does not parse or holds a number field that is none, or ``field`` where an id,
    type or user is missing. The text stays in ``raw`` for the dead-letter route.
    """
    corrupt = "_corrupt"
    numbers = {f.name: f.dataType for f in EVENT_SCHEMA.fields if f.dataType in (T.IntegerType(), T.LongType())}
    loose = [T.StructField(f.name, T.StringType()) for f in EVENT_SCHEMA.fields]
    schema = T.StructType([*loose, T.StructField(corrupt, T.StringType())])
    event = F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    # ``inline`` parses each text once, however many columns and conditions look at the result.
    parsed = df.select(F.col(value).alias("raw"), F.inline(F.array(event)))
    unset = F.col("event_id").isNull() | F.col("event_type").isNull() | F.col("user_key").isNull()
    given = {name: F.coalesce(F.nullif(name, F.lit("")), F.lit("0")) for name in numbers}
    cut = {name: given[name].try_cast("decimal(38,10)").try_cast("bigint").try_cast(kind) for name, kind in numbers.items()}
    strange = F.exists(F.array(*(c.cast("bigint") for c in cut.values())), lambda x: x.isNull())
    error = F.when(F.col("raw").isNull() | F.col(corrupt).isNotNull() | strange, F.lit("json")).when(unset, F.lit("field"))
    return parsed.withColumn("error", error).withColumns({n: F.coalesce(c, F.lit(0)) for n, c in cut.items()}).select(
        *names(EVENT_SCHEMA), "error", "raw")


def only_version(df: DataFrame, version: str = CURRENT_SCHEMA_VERSION) -> DataFrame:
    """Rows of exactly one schema version; a missing version is another one."""
    return df.filter(F.col("schema_version") == version)


def require(df: DataFrame, columns: tuple[str, ...] = ("event_id", "event_type", "user_key")) -> DataFrame:
    """Rows where all the columns are set."""
    return df.dropna(subset=list(columns))


def accepted_events(df: DataFrame, value: str = "value") -> DataFrame:
    """Parsed events the stream jobs work on: well-formed, current version, ids present."""
    return only_version(parse_events(df, value).filter(F.col("error").isNull())).select(*names(EVENT_SCHEMA))


def route_dlq(parsed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split parsed events into accepted records, dead letters ``{error, record}``, and the two counts."""
    ok = parsed.filter(F.col("error").isNull()).select(*names(EVENT_SCHEMA))
    dead = parsed.filter(F.col("error").isNotNull()).select("error", F.col("raw").alias("record"))
    counts = parsed.agg(
        F.count_if(F.col("error").isNull()).alias("accepted"), F.count_if(F.col("error").isNotNull()).alias("failed")
    )
    return ok, dead, counts


def fill_defaults(df: DataFrame) -> DataFrame:
    """0 for missing numbers and '' for missing text, as the fact table stores them."""
    return df.na.fill(0).na.fill("")


def exclude_bots(df: DataFrame) -> DataFrame:
    """Rows of users that do not look like test bots."""
    return df.filter(~is_bot())


def with_stage(df: DataFrame) -> DataFrame:
    """Add ``chapter`` and ``stage_no`` from either id form: "1".."50" or "chapter-stage"; null for other stages."""
    plain = F.col("stage_id").try_cast("int")
    dashed = F.col("stage_id").rlike("^[0-9]+-[0-9]+$")
    return df.withColumns({
        "chapter": F.when(plain.isNotNull(), F.ceil(plain / F.lit(10)).cast("int")).when(dashed, stage_part("stage_id", 1)),
        "stage_no": F.when(plain.isNotNull(), F.pmod(plain - 1, F.lit(10)) + 1).when(dashed, stage_part("stage_id", 2)),
    })

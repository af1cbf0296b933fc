"""Raw JSON events to clean ones: parsing, validation and routing, as one projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import collapsed, stripped
from ..schema import EVENT_TYPES

#: Variant types by what JSON readers call them, for reasons.
KINDS = {"STRING": "str", "BOOLEAN": "bool", "DOUBLE": "float", "FLOAT": "float", "VOID": "NoneType"}


#: Fields that are read, by the object that holds them: each gets columns of its type (t_), text (s_) and, if NUMBERS has it, number (n_).
TOP = ("type", "wiki", "title", "namespace", "timestamp", "user", "bot", "minor", "comment", "server_name", "log_type", "log_action", "revision", "length")
META = ("id", "dt", "domain")
PAIRS = {"rev": "revision", "length": "length"}
NUMBERS = {"namespace": 32, "timestamp": 64, "rev_old": 64, "rev_new": 64, "length_old": 32, "length_new": 32}


def _t(name: str) -> Column:
    return F.col(f"t_{name}")


def _s(name: str) -> Column:
    return F.col(f"s_{name}")


def _absent(name: str) -> Column:
    """Nothing there, or a JSON null."""
    return _t(name).isNull() | (_t(name) == "VOID")


def _whole(name: str) -> Column:
    """Whether the value is a JSON integer, of any size."""
    return F.coalesce((_t(name) == "BIGINT") | _t(name).rlike(r"^DECIMAL\([0-9]+,0\)$"), F.lit(False))


def _kind_name(name: str) -> Column:
    kind = _t(name)
    named = reduce(lambda c, kv: F.when(kind == kv[0], kv[1]).otherwise(c), KINDS.items(), F.lit("float"))
    return F.when(F.startswith(kind, F.lit("ARRAY")), "list").when(F.startswith(kind, F.lit("OBJECT")), "dict").otherwise(named)


def _truthy(name: str) -> Column:
    """JSON truth: not null, false, zero, or an empty string, list or object."""
    kind, text = _t(name), _s(name)
    filled = F.when(kind == "BOOLEAN", text == "true").when(kind == "STRING", F.length(text) > 0)
    filled = filled.when(kind.rlike("^(ARRAY|OBJECT)"), ~text.isin("[]", "{}")).otherwise(text.try_cast("double") != 0)
    return F.when(_absent(name), False).otherwise(F.coalesce(filled, F.lit(True)))


def _text(name: str) -> Column:
    """A value as text, "" if it is not truthy."""
    return F.when(_truthy(name), F.when(_t(name) == "BOOLEAN", F.initcap(_s(name))).otherwise(_s(name))).otherwise("")


def _name(name: str) -> Column:
    """A string that is not empty, else null."""
    return F.when((_t(name) == "STRING") & (F.length(_s(name)) > 0), _s(name))


def _number_fault(name: str) -> Column:
    """The reason why an optional integer is none; null if it is fine."""
    expected = F.concat(F.lit("expected int, got "), _kind_name(name))
    return F.when(_absent(name), F.lit(None)).when(~_whole(name), expected).when(F.col(f"n_{name}").isNull(), "int out of range")


def _container_fault(name: str) -> Column:
    return F.when(_truthy(name) & ~F.startswith(_t(name), F.lit("OBJECT")), f"{name} is not an object")


def _event_time() -> Column:
    """meta.dt if it is a time, else the whole seconds of timestamp."""
    dt = F.when(_t("dt") == "STRING", _s("dt"))
    zoned = F.when(dt.rlike(r"([zZ]|[+-][0-9]{2}:?[0-9]{2})$"), dt).otherwise(F.concat(dt, F.lit("Z")))
    basic = F.try_to_timestamp(F.regexp_replace(dt, "[zZ]$", "+0000"), F.lit("yyyyMMdd'T'HHmmssxx"))
    seconds = F.when(_whole("timestamp"), F.col("n_timestamp"))
    seconds = F.when(F.abs(seconds) < 253_402_300_800, seconds)
    return F.coalesce(zoned.try_cast("timestamp"), basic, F.timestamp_seconds(seconds))


def _extracted(rows: DataFrame) -> DataFrame:
    """rows (with v, a variant) and the type and text of every field, then numbers, title and time: each object is gone through once.

    Fields of what is no object are null, like those it lacks.
    """
    variants = lambda names: ", ".join(f"{n} variant" for n in names)
    rows = rows.withColumn("x", F.try_variant_get("v", "$", f"struct<meta struct<{variants(META)}>, {variants(TOP)}>"))
    rows = rows.withColumns({f"x_{prefix}": F.try_variant_get(F.col(f"x.{n}"), "$", f"struct<{variants(('old', 'new'))}>") for prefix, n in PAIRS.items()})
    fields = {n: F.col(f"x.meta.{n}") for n in META} | {n: F.col(f"x.{n}") for n in TOP} | {f"{p}_{n}": F.col(f"x_{p}.{n}") for p in PAIRS for n in ("old", "new")}
    rows = rows.withColumns({f"t_{n}": F.schema_of_variant(f) for n, f in fields.items()} | {f"s_{n}": F.try_variant_get(f, "$", "string") for n, f in fields.items()})
    numbers = {f"n_{n}": F.when(_whole(n), _s(n).try_cast("long" if bits == 64 else "int")) for n, bits in NUMBERS.items()}
    return rows.withColumns(numbers).withColumns({"c_title": collapsed(F.coalesce(_name("title"), F.lit(""))), "c_time": _event_time()})


def parsed(rows: DataFrame, value: str = "value", fields: tuple[str, ...] = ()) -> DataFrame:
    """rows with outcome (clean, rejected or skipped), reason and event, a struct of a clean event's fields, or of those asked for.

    The first fault in the order of validation is the reason. Heartbeats (meta.domain canary) are skipped before they
    are validated. value may be binary or a string; null is rejected. Timestamps need a session in UTC.
    """
    names, column = rows.columns, F.col(value)
    text = column if dict(rows.dtypes)[value] == "string" else F.try_validate_utf8(column.cast("string"))
    rows = _extracted(rows.withColumn("body", text).withColumn("v", F.try_parse_json("body")))
    no_object = _t("id").isNull() & ~F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))
    known_type = F.coalesce((_t("type") == "STRING") & _s("type").isin(*EVENT_TYPES), F.lit(False))
    reason = F.coalesce(
        F.when(F.col("body").isNull(), "value is not valid utf-8"),
        F.when(F.col("v").isNull(), "invalid json"),
        F.when(no_object, "event is not a json object"),
        F.when(_t("id").isNull(), "missing meta.id"),
        F.when(_name("id").isNull(), "meta.id is not a non-empty string"),
        F.when(~known_type, F.concat(F.lit("unknown event type: "), F.coalesce(_s("type"), F.lit("None")))),
        F.when(_name("wiki").isNull(), "missing wiki"),
        F.when(F.length("c_title") == 0, "missing title"),
        F.when(F.col("n_namespace").isNull(), "namespace is not an int"),
        F.when(F.col("c_time").isNull(), "no usable event time"),
        _container_fault("revision"), _number_fault("rev_old"), _number_fault("rev_new"),
        _container_fault("length"), _number_fault("length_old"), _number_fault("length_new"),
    )
    canary = F.coalesce((_t("domain") == "STRING") & (_s("domain") == "canary"), F.lit(False))
    every = {
        "event_id": _s("id"), "wiki": _s("wiki"), "title": F.col("c_title"), "type": _s("type"), "namespace": F.col("n_namespace"),
        "user": _text("user"), "bot": _truthy("bot"), "minor": _truthy("minor"), "comment": stripped(_text("comment")), "event_time": F.col("c_time"),
        **{n: F.col(f"n_{n}") for n in ("rev_old", "rev_new", "length_old", "length_new")},
        "server_name": _text("server_name"), "log_type": _name("log_type"), "log_action": _name("log_action"),
    }
    event = F.struct(*(every[n].alias(n) for n in fields or every))
    rows = rows.withColumn("reason", F.when(~canary, reason)).withColumn("canary", canary)
    outcome = F.when(F.col("canary"), "skipped").when(F.col("reason").isNotNull(), "rejected").otherwise("clean")
    rows = rows.withColumn("outcome", outcome).withColumn("event", F.when(F.col("outcome") == "clean", event))
    return rows.select(*names, "reason", "outcome", "event")


def with_duplicates(rows: DataFrame, *arrival: str, value: str = "value") -> DataFrame:
    """parsed rows whose outcome is duplicate where a clean event of the same id arrived before, by the columns given.

    One shuffle for all outcomes: rows that are not clean have no id and are dealt by their arrival, so that equal ones spread.
    """
    key = F.coalesce(F.col("event.event_id"), F.concat(F.lit("\x00"), F.xxhash64(value, *arrival).cast("string")))
    order = Window.partitionBy("_key").orderBy(F.col("event").isNull(), *arrival)
    numbered = rows.withColumn("_key", key).withColumn("_n", F.row_number().over(order))
    again = (F.col("outcome") == "clean") & (F.col("_n") > 1)
    return numbered.withColumn("outcome", F.when(again, "duplicate").otherwise(F.col("outcome"))).drop("_key", "_n")


def dead_letters(rows: DataFrame, stage: str, source: str, value: str = "value", position: tuple[str, ...] = ()) -> DataFrame:
    """The rejected rows as dead letters: stage, reason, source, position, failed_at and the payload as it came."""
    column = F.col(value)
    text = column if dict(rows.dtypes)[value] == "string" else F.coalesce(F.try_validate_utf8(column.cast("string")), F.concat(F.lit("hex:"), F.hex(column)))
    where = F.map_from_arrays(F.array(*(F.lit(c) for c in position)), F.array(*(F.col(c).cast("string") for c in position))) if position else F.expr("map()").cast("map<string,string>")
    return rows.where("outcome = 'rejected'").select(
        F.lit(stage).alias("stage"), "reason", F.lit(source).alias("source"), where.alias("position"), F.current_timestamp().alias("failed_at"), F.coalesce(text, F.lit("")).alias("payload")
    )


def to_wire(events: DataFrame, key: Column) -> DataFrame:
    """key and value (JSON) of each event; null fields are written, other alphabets stay as they are."""
    return events.select(key.alias("key"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def from_wire(rows: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """The rows of value (JSON) in schema, and those that cannot be read, for the dead letters.

    Fields that older writers left out are null.
    """
    rows = rows.withColumn("event", F.from_json(F.col("value").cast("string"), schema))
    broken = F.col("event").isNull() | F.col("event.event_id").isNull() if "event_id" in schema.split(", ")[0] else F.col("event").isNull()
    return rows.where(~broken).select("event.*"), rows.where(broken).drop("event")

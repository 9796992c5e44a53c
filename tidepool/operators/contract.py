"""Order-event data contract as column expressions.

A message is decoded once into a VARIANT (``try_parse_json``); every field
rule is a Column over it, so validation runs in the JVM, row-parallel, with
no Python per row.  The result carries the coerced fields, an ``errors``
array (``"field: message"``, at most one per field, in contract order) and
the joined ``rejection_reason``.  Accepted and rejected rows are two filters
of that one frame.

Lax typing follows the contract's model rules: strings must be JSON strings;
a float field takes numbers, booleans and numeric text (outer whitespace and
``_`` between digits allowed); an int field takes whole numbers (also as
``34.0`` or ``"34.0"``) and booleans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import strip_ws

# Contract fields in model order, their kinds, and messages.
FIELDS = (
    ("order_id", "text"),
    ("customer_id", "text"),
    ("restaurant_name", "text"),
    ("customer_area", "text"),
    ("order_total_sar", "float"),
    ("delivery_distance_km", "float"),
    ("estimated_delivery_minutes", "int"),
    ("status", "status"),
    ("event_ts", "timestamp"),
)
ALLOWED_STATUSES = ("CONFIRMED", "PREPARING", "PICKED_UP", "DELIVERED", "CANCELLED")
MSG_REQUIRED = "Field required"
MSG_STRING = "Input should be a valid string"
MSG_NUMBER = "Input should be a valid number"
MSG_NUMBER_PARSE = "Input should be a valid number, unable to parse string as a number"
MSG_INT = "Input should be a valid integer"
MSG_INT_PARSE = "Input should be a valid integer, unable to parse string as an integer"
MSG_INT_FRACTION = "Input should be a valid integer, got a number with a fractional part"
MSG_NOT_OBJECT = ": Input should be a valid dictionary or instance of OrderEvent"
MSG_BAD_JSON = "value: invalid JSON"
MSG_EMPTY = "Value error, field must not be empty"
MSG_TOTAL = "Value error, order_total_sar must be greater than 0 and at most 5000"
MSG_DISTANCE = "Value error, delivery_distance_km must be greater than 0 and at most 50"
MSG_MINUTES = "Value error, estimated_delivery_minutes must be between 5 and 180"
MSG_STATUS = "Value error, status must be one of " + str(sorted(ALLOWED_STATUSES))
MSG_TS = "Value error, event_ts must use a valid ISO-8601 format"

_NUM_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"
_INT_TEXT = r"^[+-]?\d+(\.0*)?$"

# ISO-8601 forms accepted by datetime.fromisoformat after "Z" -> "+00:00": with separators or without, never mixed.
_DATES = (r"(\d{4})-(\d{2})-(\d{2})", r"(\d{4})(\d{2})(\d{2})", r"(\d{4})-W(\d{2})(?:-([1-7]))?", r"(\d{4})W(\d{2})([1-7])?")
_FRACTION = r"(?:[.,]\d+)?"  # of the last part given: of a second, a minute or an hour
_TIMES = (rf"(\d{{2}})(?::(\d{{2}})(?::(\d{{2}}))?)?{_FRACTION}", rf"(\d{{2}})(\d{{2}})(\d{{2}})?{_FRACTION}")
_OFFSETS = tuple("[+-]" + t for t in _TIMES)
ISO_PATTERN = rf"^(?:{'|'.join(_DATES)})(?:.(?:{'|'.join(_TIMES)})(?:{'|'.join(_OFFSETS)})?)?$"


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_number_kind(kind: Column) -> Column:
    return kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | \
        kind.startswith("DECIMAL")


def _is_int_kind(kind: Column) -> Column:
    return kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$")


def _num_text(s: Column) -> Column:
    """Numeric text as the contract reads it: stripped, ``_`` between digits dropped."""
    t = strip_ws(s)
    return F.when(F.instr(t, "_") > 0, F.regexp_replace(t, r"(?<=\d)_(?=\d)", "")).otherwise(t)


def _err(field: str, cond: Column, msg: str) -> tuple[Column, Column]:
    return cond, F.lit(f"{field}: {msg}")


def _first(*pairs: tuple[Column, Column]) -> Column:
    out = None
    for cond, msg in pairs:
        out = F.when(cond, msg) if out is None else out.when(cond, msg)
    return out


def iso_timestamp_ok(ts: Column) -> Column:
    """``datetime.fromisoformat(ts.replace("Z", "+00:00"))`` succeeds.

    Grammar by regular expression, then calendar and clock ranges checked on
    the captured parts (Spark's own cast accepts forms such as ``2026-07``).
    One regex pass: a full match is rewritten to ``"@" + the captured parts``
    joined by ``|``; anything else comes back unchanged (no leading ``@``).
    """
    return iso_ok_from_parts(iso_parts(ts))


def iso_parts(ts: Column) -> Column:
    """The ISO parts as ``"@|y|m|d|week year|week|hh|mm|ss|offset hh|mm|ss"``, or the text unchanged."""
    t = F.regexp_replace(ts, "Z", "+00:00")
    return F.regexp_replace(t, ISO_PATTERN, "@|$1$4|$2$5|$3$6|$7$10|$8$11|$13$16|$14$17|$15$18|$19$22|$20$23|$21$24")


def iso_ok_from_parts(parts: Column) -> Column:
    """Calendar and clock checks on the output of ``iso_parts``: real dates from year 1 on, week 53 only
    in years that have one, clock times below 24 h and offsets below 24 h."""
    matched = parts.startswith("@|")
    g = F.split(parts, r"\|")

    def part(i):
        return F.try_element_at(g, F.lit(i + 2))

    def number(i):
        return F.coalesce(part(i).try_cast("int"), F.lit(0))

    year, week_year, week = part(0), part(3), number(4)
    day = F.try_to_date(F.concat_ws("-", year, part(1), part(2)), "yyyy-MM-dd")
    # the 28th of December is always in a year's last week
    weeks = F.weekofyear(F.try_to_date(F.concat(week_year, F.lit("-12-28")), "yyyy-MM-dd"))
    date_ok = F.when(week_year != "", (week_year != "0000") & week.between(1, 53) & (week <= weeks)).otherwise((year != "0000") & day.isNotNull())
    time_ok = (number(5) <= 23) & (number(6) <= 59) & (number(7) <= 59)
    offset_ok = number(8) * 3600 + number(9) * 60 + number(10) < 86400
    return F.coalesce(matched & date_ok & time_ok & offset_ok, F.lit(False))


def validate(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Add coerced fields, ``errors`` and ``rejection_reason``.

    Built as a few narrow projections (decode -> per-field kind/text ->
    coerced values -> errors) so each variant lookup and strip is computed
    once per row and every stage stays small enough for code generation.
    """
    # of a key given twice the last value counts; without this setting such a message is no JSON
    raw.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    df = raw.withColumn("_v", F.try_parse_json(F.col(value_col).cast("string")))
    vcol = F.col("_v")
    probe = {"_top": _kind(vcol)}
    for name, kind in FIELDS:
        probe[f"_k_{name}"] = _kind(F.try_variant_get(vcol, f"$.{name}", "variant"))
        probe[f"_s_{name}"] = F.try_variant_get(vcol, f"$.{name}", "string")
        if kind == "float":
            probe[f"_d_{name}"] = F.try_variant_get(vcol, f"$.{name}", "double")
        if kind == "int":
            probe[f"_dec_{name}"] = F.try_variant_get(vcol, f"$.{name}", "decimal(38,6)")
            probe[f"_i_{name}"] = F.try_variant_get(vcol, f"$.{name}", "int")
    df = df.withColumns(probe)

    # coerced values (and helper flags) from the probed columns
    vals = {}
    for name, kind in FIELDS:
        k, s = F.col(f"_k_{name}"), F.col(f"_s_{name}")
        if kind in ("text", "status"):
            vals[f"_x_{name}"] = strip_ws(s)
        elif kind == "timestamp":
            vals[f"_iso_{name}"] = iso_parts(s)
        elif kind == "float":
            txt = _num_text(s)
            vals[f"_p_{name}"] = F.when(F.lower(txt).rlike(_NUM_TEXT), txt.try_cast("double"))
        else:
            txt = _num_text(s)
            vals[f"_t_{name}"] = txt
            vals[f"_tok_{name}"] = txt.rlike(_INT_TEXT)
    df = df.withColumns(vals)

    cols, errs = {}, []
    for name, kind in FIELDS:
        k, s = F.col(f"_k_{name}"), F.col(f"_s_{name}")
        missing = k.isNull()
        if kind in ("text", "status", "timestamp"):
            not_str = k != "STRING"
            if kind == "text":
                value = F.col(f"_x_{name}")
                rule = _err(name, value == "", MSG_EMPTY)
            elif kind == "status":
                value = F.upper(F.col(f"_x_{name}"))
                rule = _err(name, ~value.isin(*ALLOWED_STATUSES), MSG_STATUS)
            else:
                value = s
                rule = _err(name, ~iso_ok_from_parts(F.col(f"_iso_{name}")), MSG_TS)
            err = _first(_err(name, missing, MSG_REQUIRED), _err(name, not_str, MSG_STRING), rule)
        elif kind == "float":
            parsed = F.col(f"_p_{name}")
            value = F.when(k == "STRING", parsed).when(
                _is_number_kind(k) | (k == "BOOLEAN"), F.col(f"_d_{name}"))
            hi = 5000.0 if name == "order_total_sar" else 50.0
            msg = MSG_TOTAL if name == "order_total_sar" else MSG_DISTANCE
            err = _first(_err(name, missing, MSG_REQUIRED),
                         _err(name, (k == "STRING") & parsed.isNull(), MSG_NUMBER_PARSE),
                         _err(name, value.isNull(), MSG_NUMBER),
                         _err(name, ~((value > 0) & (value <= hi)), msg))
        else:  # int
            text_ok = F.col(f"_tok_{name}")
            dec = F.col(f"_dec_{name}")
            whole = _is_int_kind(k) | (k == "BOOLEAN") | (dec.isNotNull() & (dec == F.floor(dec)))
            value = F.when(k == "STRING", F.when(text_ok, F.regexp_replace(F.col(f"_t_{name}"), r"\..*$", "")
                                                 .try_cast("int"))) \
                .when(_is_number_kind(k) & whole, dec.try_cast("int")) \
                .when(k == "BOOLEAN", F.col(f"_i_{name}"))
            err = _first(_err(name, missing, MSG_REQUIRED),
                         _err(name, (k == "STRING") & ~text_ok, MSG_INT_PARSE),
                         _err(name, _is_number_kind(k) & ~whole, MSG_INT_FRACTION),
                         _err(name, value.isNull(), MSG_INT),
                         _err(name, ~value.between(5, 180), MSG_MINUTES))
        cols[name] = value
        errs.append(err)
    top = F.col("_top")
    errors = F.when(vcol.isNull(), F.array(F.lit(MSG_BAD_JSON))) \
        .when(~top.startswith("OBJECT"), F.array(F.lit(MSG_NOT_OBJECT))) \
        .otherwise(F.array_compact(F.array(*errs)))
    helpers = [c for c in df.columns if c.startswith("_") and c != "_v"]
    out = df.withColumns({**cols, "errors": errors}).drop(*helpers)
    return out.withColumn("rejection_reason", F.array_join("errors", "; ")) \
        .withColumnRenamed("_v", "original_record")


def route(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Validate once for several outputs: the result is written under ``spark.checkpoint.dir``, partitioned by route.

    Each output then reads its own part only, and the rule tree is evaluated once per
    message.  A filter on a frame of ``validate`` is pushed below its projections, which repeats
    the rule tree inside the filter (seven times slower here), so one output alone is routed too;
    only a summary of all messages needs no such table.
    """
    from tidepool.session import scratch_path
    path = scratch_path(raw.sparkSession, "routed")
    checked = validate(raw, value_col).drop("original_record")
    checked.withColumn("rejected", (F.size("errors") > 0).cast("int")).write.partitionBy("rejected").parquet(path)
    return raw.sparkSession.read.parquet(path)


def _is_rejected(validated: DataFrame) -> Column:
    return F.col("rejected") == 1 if "rejected" in validated.columns else F.size("errors") > 0


def accepted(validated: DataFrame) -> DataFrame:
    """The accepted projection (coerced contract fields only)."""
    return validated.where(~_is_rejected(validated)).select(*[n for n, _ in FIELDS])


def quarantined(validated: DataFrame, with_time: bool = True) -> DataFrame:
    """The quarantine envelope around the original message."""
    cols = [F.col("value").cast("string").alias("original_record"), "rejection_reason",
            F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"),
            F.col("offset").alias("source_offset")]
    if with_time:
        cols.append(F.current_timestamp().alias("rejected_at"))
    return validated.where(_is_rejected(validated)).select(*cols)


def route_summary(validated: DataFrame) -> DataFrame:
    """produced = accepted + quarantined, and every reject has a reason."""
    rejected = _is_rejected(validated)
    return validated.agg(
        F.count(F.lit(1)).alias("produced"),
        F.count_if(~rejected).alias("accepted"),
        F.count_if(rejected).alias("quarantined"),
        F.coalesce(F.bool_and(F.when(rejected, F.col("rejection_reason") != "")), F.lit(True))
        .alias("all_rejects_have_reason"))


def original_order_id(quarantine: DataFrame) -> Column:
    """``original_record.order_id`` of a quarantine row."""
    return F.try_variant_get(F.try_parse_json("original_record"), "$.order_id", "string")

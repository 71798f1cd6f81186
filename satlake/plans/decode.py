"""Landed payloads to balances: one table-driven job for all sources."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.catalog import Catalog, counted
from satlake.functions.decoders import DECIMAL, DECODERS, HEX, HTTP_OK, INTEGER, Decoder
from satlake.functions.scalars import (
    end_of_day_seconds,
    epoch_seconds,
    hex_uint,
    is_hex_number,
    shift_point,
    start_of_day_seconds,
)
from satlake.operators.latest import latest_by
from satlake.schemas import BALANCE, schema

RAW = "decimal(38,0)"


def _case(decoders: Iterable[str], value: Callable[[Decoder], Column], default: Column) -> Column:
    """CASE over the decoder name, with equal branches merged into one."""
    branches: dict[str, tuple[Column, list[str]]] = {}
    for name in decoders:
        branch = value(DECODERS[name])
        branches.setdefault(str(branch), (branch, []))[1].append(name)
    result = default
    for branch, names in branches.values():
        result = F.when(F.col("decoder").isin(*names), branch).otherwise(result)
    return result


def read_numbers(df: DataFrame, decoders: Iterable[str] = tuple(DECODERS)) -> DataFrame:
    """Add found, raw, places and balance to rows with decoder, payload, slug and decimals.

    The steps are separate projections, so each one computes its input once.
    """
    names = list(decoders)
    payload, slug, decimals = F.col("payload"), F.col("token_implementation"), F.col("token_decimals")
    null_text, null_int = F.lit(None).cast("string"), F.lit(None).cast("int")

    def raw_of(spec: Decoder) -> Column:
        if spec.form == HEX:
            number = hex_uint(F.col("found"))
        elif spec.form == INTEGER:
            number = F.col("found").try_cast(RAW)
        else:
            # Only its being zero matters: the value itself is not scaled.
            return F.signum(F.col("found").try_cast("double")).try_cast(RAW)
        if spec.cap is None:
            return number
        cap = F.lit(spec.cap).cast("decimal(10,0)") * F.rpad(
            F.lit("1"), F.col("places") + 1, F.lit("0")
        ).cast("decimal(19,0)")
        return F.try_subtract(cap, number).cast(RAW)

    def balance_of(spec: Decoder) -> Column:
        if spec.form == DECIMAL:
            return F.col("found").try_cast(BALANCE)
        return shift_point(F.col("raw"), F.col("places"))

    found = _case(names, lambda d: d.found(payload, slug), null_text)
    places = _case(names, lambda d: d.places(payload, decimals), null_int)
    read = _computed(df, found=found, places=places)
    read = read.withColumn("raw", _case(names, raw_of, F.lit(None).cast(RAW)))
    return read.withColumn("balance", _case(names, balance_of, F.lit(None).cast(BALANCE)))


def _computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters take as they are.

    A filter on a plain projected column is moved below the projection with
    the whole expression written out in it, again for every use.  A generator
    of exactly one row keeps the filter above, so each value is computed once.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def _any(names: Iterable[str], wanted: Callable[[Decoder], bool]) -> Column:
    hits = [n for n in names if wanted(DECODERS[n])]
    return F.col("decoder").isin(*hits) if hits else F.lit(False)


def rejection_reason(decoders: Iterable[str] = tuple(DECODERS), scoped: bool = True) -> Column:
    """Why a row is not stored; NULL for a valid row. The first reason that applies.

    ``scoped`` also asks for a known implementation, of the network that the
    source polls, and for a day to store it under.
    """
    names = list(decoders)
    address, decimals = F.col("token_address"), F.col("token_decimals")
    no_address = _any(names, lambda d: d.needs_address) & (F.coalesce(address, F.lit("")) == "")
    places = decimals.try_cast("int")
    no_decimals = _any(names, lambda d: d.needs_decimals) & (
        places.isNull() | (_any(names, lambda d: not d.zero_decimals_ok) & (places == 0))
    )
    bad_form = F.lit(False)
    for form in sorted({DECODERS[n].address_form for n in names if DECODERS[n].address_form}):
        bad_form = bad_form | (_any(names, lambda d: d.address_form == form) & ~address.rlike(form))
    bad_status = _any(names, lambda d: d.checks_status) & (F.col("status") != HTTP_OK)
    not_ok = F.lit(False)
    for name in names:
        if DECODERS[name].ok is not None:
            flagged = F.coalesce(DECODERS[name].ok(F.col("payload")), F.lit(False))
            not_ok = not_ok | ((F.col("decoder") == name) & ~flagged)
    # A number was written but does not fit; otherwise the text is no number.
    too_large = F.when(_any(names, lambda d: d.form == HEX), is_hex_number(F.col("found"))).otherwise(
        F.col("found").try_cast("double").isNotNull()
    )
    only = F.col("only_token")
    reason = F.when(F.col("decoder").isNull(), "unknown_source").when(
        only.isNotNull() & (F.col("token_implementation") != only), "unsupported_token"
    )
    if scoped:
        polled = F.when(F.col("stored_as").isNull(), F.col("network"))
        reason = (
            reason.when(F.col("known").isNull(), "unknown_implementation")
            .when(polled.isNotNull() & ~polled.eqNullSafe(F.col("impl_network")), "wrong_network")
            .when(F.col("effective_day").isNull(), "no_day")
        )
    return (
        reason.when(no_address, "no_address")
        .when(bad_form, "bad_address")
        .when(no_decimals, "no_decimals")
        .when(F.coalesce(bad_status, F.lit(True)), "bad_status")
        .when(not_ok, "not_okay")
        .when(F.col("found").isNull(), "no_result")
        .when(F.col("balance").isNull() & too_large, "out_of_range")
        .when(F.col("balance").isNull(), "not_a_number")
        .when(~F.col("keep_zero") & (F.col("raw") == 0), "zero_supply")
    )


def with_config(observations: DataFrame, config: DataFrame) -> DataFrame:
    """Attach the source rules.

    A token with a decoder of its own gets that one, and the number of some
    sources is stored under a slug of its own.
    """
    special = F.col("token_implementation") == F.col("special_token")
    joined = observations.join(counted(config), "source", "left")
    return joined.withColumns(
        {
            "decoder": F.when(special, F.col("special_decoder")).otherwise(F.col("decoder")),
            "polled_implementation": F.col("token_implementation"),
            "token_implementation": F.coalesce("stored_as", "token_implementation"),
        }
    )


def decode_observations(
    cat: Catalog,
    observations: DataFrame,
    config: DataFrame,
    decoders: Iterable[str] = tuple(DECODERS),
    objects: DataFrame | None = None,
) -> DataFrame:
    """Every observation with its balance and, where it has none, the reason.

    A scan with joins against small sides; nothing is shuffled unless the
    implementations outgrow a broadcast.  Where a source has a second place to
    look, a token that the first one does not serve is read there: a token
    without an address from its latest reserve, a coin without a supply from
    its listed ``objects`` (object_id, payload).
    """
    names = list(decoders)
    impls = cat.token_implementations.select(
        F.col("slug").alias("token_implementation"),
        F.col("network").alias("impl_network"),
        "token_address",
        "token_decimals",
        F.lit(True).alias("known"),
    )
    rows = with_config(observations, config).join(
        cat.per_implementation(impls), "token_implementation", "left"
    )
    decoded = _computed(read_numbers(rows, names), reason=rejection_reason(names))
    if "explorer_self" in names:
        held = impl_fallback_reserve(cat).select(
            F.col("derivative_token").alias("token_implementation"), F.col("balance").alias("_other")
        )
        decoded = _served(cat, decoded, held, "explorer_self", "no_address")
    if "coin_value" in names and objects is not None:
        listed = object_fallback(cat.token_implementations, objects).select(
            F.col("slug").alias("token_implementation"), F.col("balance").alias("_other")
        )
        decoded = _served(cat, decoded, listed, "coin_value", "no_result")
    return decoded


def _served(cat: Catalog, decoded: DataFrame, other: DataFrame, decoder: str, reason: str) -> DataFrame:
    """Rows of one decoder and reason take the balance of the other place, if it has one."""
    joined = decoded.join(cat.per_implementation(other), "token_implementation", "left")
    served = (F.col("decoder") == decoder) & (F.col("reason") == reason) & F.col("_other").isNotNull()
    served = F.coalesce(served, F.lit(False))
    return joined.withColumns(
        {
            "balance": F.when(served, F.col("_other").cast(BALANCE)).otherwise(F.col("balance")),
            "reason": F.when(~served, F.col("reason")),
        }
    ).drop("_other")


_VALID = (
    "seq",
    "source",
    "token_implementation",
    "observed_at",
    "effective_day",
    "is_final",
    "balance",
)


def valid_balances(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).select(*_VALID)


def quarantined(decoded: DataFrame) -> DataFrame:
    """Rejected observations with all that they landed with, so that they can be polled again from here."""
    return decoded.where(F.col("reason").isNotNull()).select(
        "seq",
        "source",
        "token_implementation",
        "polled_implementation",
        "observed_at",
        "effective_day",
        "is_final",
        "status",
        "payload",
        "reason",
    )


def as_observations(letters: DataFrame) -> DataFrame:
    """Rejected observations as they landed, each once however often it was rejected."""
    polls = letters.withColumn("token_implementation", F.col("polled_implementation"))
    return polls.select(*[f.name for f in schema("observations")]).distinct()


def decode_reserves(cat: Catalog, observations: DataFrame) -> DataFrame:
    """Reserve polls to reserve balances and reasons.

    Rows carry reserve_implementation_id; the collateral implementation gives
    address and decimals.
    """
    reserves = cat.reserve_implementations.select(
        F.col("id").alias("reserve_implementation_id"),
        "reserve_network",
        "reserve_address",
        "collateral_token",
        "derivative_token",
    )
    collateral = cat.token_implementations.select(
        F.col("slug").alias("collateral_token"), "token_address", "token_decimals"
    )
    rows = observations.join(reserves, "reserve_implementation_id", "left").join(
        cat.per_implementation(collateral), "collateral_token", "left"
    )
    rows = rows.withColumns(
        {
            "decoder": F.lit("evm_hex"),
            "token_implementation": F.col("collateral_token"),
            "only_token": F.lit(None).cast("string"),
            "keep_zero": F.lit(False),
        }
    )
    names = ["evm_hex"]
    reason = F.when(F.col("collateral_token").isNull(), "no_collateral_token").otherwise(
        rejection_reason(names, scoped=False)
    )
    return _computed(read_numbers(rows, names), reason=reason).drop(
        "token_implementation", "decoder", "only_token", "keep_zero"
    )


def sum_by_derivative(decoded: DataFrame) -> DataFrame:
    """Total over the reserve addresses of each derivative token and day."""
    return (
        decoded.where(F.col("reason").isNull())
        .groupBy("token_implementation", "effective_day")
        .agg(F.sum("balance").cast("decimal(38,8)").alias("balance"))
    )


def effective_day(observed_day: Column, invocation: Column, final_only: Column) -> Column:
    """Day that a poll is stored under: a final run closes the day before."""
    is_final = F.when(final_only, invocation == "final").otherwise(invocation != "incremental")
    return F.when(F.coalesce(is_final, F.lit(False)), F.date_sub(observed_day, 1)).otherwise(observed_day)


def stamp_runs(runs: DataFrame, config: DataFrame) -> DataFrame:
    """Add the stored day and the second whose block a run reads.

    A run of the current day reads the newest state, a final run the last
    second of its day; some sources read the start of the day in both cases.
    ``runs`` has source, invocation and observed_at.  A run of an unknown source
    has no day, and ``reason`` says so.
    """
    rules = config.select("source", "final_only", "start_of_day", F.lit(True).alias("_known"))
    observed_day = F.col("observed_at").cast("date")
    day = effective_day(observed_day, F.col("invocation"), F.col("final_only"))
    stamped = (
        runs.join(counted(rules), "source", "left")
        .withColumn("reason", F.when(F.col("_known").isNull(), "unknown_source"))
        .withColumn("day", F.when(F.col("_known"), day))
    )
    second = (
        F.when(F.col("start_of_day"), start_of_day_seconds(F.col("day")))
        .when(F.col("day") == observed_day, epoch_seconds(F.col("observed_at")))
        .otherwise(end_of_day_seconds(F.col("day")))
    )
    return stamped.withColumn("block_second", second).drop("final_only", "start_of_day", "_known")


def poll_order(is_final: Column, observed_at: Column, seq: Column) -> Column:
    """One number that orders polls: final ones last, then by time, then by arrival.

    A single decimal instead of a struct lets the aggregation hash its keys
    rather than sort its rows.  38 digits: flag, 18 of microseconds, 19 of seq.
    """
    flag = F.when(is_final, F.lit("1" + "0" * 37)).otherwise(F.lit("0")).cast("decimal(38,0)")
    micros = F.unix_micros(observed_at.cast("timestamp")).cast("decimal(18,0)")
    shifted = (micros * F.lit("1" + "0" * 19).cast("decimal(20,0)")).cast("decimal(38,0)")
    return (flag + (shifted + seq.cast("decimal(19,0)")).cast("decimal(38,0)")).cast("decimal(38,0)")


def daily_last(valid: DataFrame) -> DataFrame:
    """Last balance per implementation and day; final polls beat incremental ones.

    One candidate per key leaves each map task, so a hot key does not pile up.
    """
    order = poll_order(F.col("is_final"), F.col("observed_at"), F.col("seq"))
    return (
        valid.withColumn("_order", order)
        .groupBy("token_implementation", F.col("effective_day").alias("date"))
        .agg(
            F.max_by("balance", "_order").alias("balance"),
            F.max_by("observed_at", "_order").alias("observed_at"),
        )
    )


def impl_fallback_reserve(cat: Catalog) -> DataFrame:
    """Latest reserve balance per derivative token, for tokens without an address.

    Among rows of the latest date the one of the lowest reserve id is taken.
    """
    reserves = cat.reserve_implementations.select("id", "derivative_token")
    # The latest row of a derivative token is the latest of one of its reserves,
    # so the history is reduced per reserve before it meets the dimension.
    rows = cat.recent_rows("reserve_balances", "reserve_implementation_id")
    facts = latest_by(rows, "reserve_implementation_id", "date", "balance")
    joined = facts.join(reserves, facts["reserve_implementation_id"] == reserves["id"])
    order = F.struct("date", (-F.col("id")).alias("low_id"))
    return (
        joined.where(F.col("derivative_token").isNotNull())
        .groupBy("derivative_token")
        .agg(F.max_by("balance", order).alias("balance"), F.max("date").alias("date"))
    )


def object_fallback(tokens: DataFrame, objects: DataFrame) -> DataFrame:
    """First object in a token's stated order that reports a non-zero value.

    ``tokens`` has slug, reserve_implementations (JSON array of object ids) and
    token_decimals; ``objects`` has object_id and payload.
    """
    value = F.get_json_object(
        "payload", "$.result.data.content.fields.treasury_cap.fields.total_supply.fields.value"
    ).try_cast(RAW)
    ids = F.from_json("reserve_implementations", "array<string>")
    listed = tokens.select("slug", "token_decimals", F.posexplode(ids).alias("pos", "object_id"))
    read = objects.select("object_id", value.alias("raw")).where("raw is not null and raw <> 0")
    return (
        listed.join(read, "object_id")
        .groupBy("slug", "token_decimals")
        .agg(F.min_by(F.struct("object_id", "raw"), "pos").alias("first"))
        .select(
            "slug",
            "first.object_id",
            shift_point(F.col("first.raw"), F.col("token_decimals")).alias("balance"),
        )
    )

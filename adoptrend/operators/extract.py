"""Extraction from raw event logs: shard ranges, nested fields, activity counts, mined messages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptrend.functions.calendar import month_label, year_label
from adoptrend.functions.fixed import (
    BOT_PATTERN,
    EXCLUDED_LABELS,
    MIGRATION_STEMS,
    SAMPLED_MONTHS,
    STRICT_MESSAGE_FILTER,
    STRICT_PATTERNS,
    STRICT_PAYLOAD_FILTER,
    SWAP_STEMS,
    TOKEN,
    TOKEN_LENGTH,
)
from adoptrend.functions.text import contains_pattern, first_match, normalise, present


def _first_of(shard: str) -> date:
    digits = shard.replace("-", "")
    return date(int(digits[:4]), int(digits[4:6]), 1)


def _following(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def _bound(df: DataFrame, ts: str, day: date) -> Column:
    # same type as the column, so that the comparison reaches the Parquet statistics uncast
    return F.lit(day.isoformat()).cast(df.schema[ts].dataType)


def scan_months(df: DataFrame, ts: str, lo: str | None, hi: str | None) -> DataFrame:
    """Rows of the months ``lo`` to ``hi`` (``YYYYMM`` or ``YYYY-MM``), both included; None is open."""
    if lo is not None:
        df = df.where(F.col(ts) >= _bound(df, ts, _first_of(lo)))
    if hi is not None:
        df = df.where(F.col(ts) < _bound(df, ts, _following(_first_of(hi))))
    return df


def scan_complete_months(df: DataFrame, ts: str, asof: date) -> DataFrame:
    """Rows before the month that holds ``asof``: that month is still filling."""
    return df.where(F.col(ts) < _bound(df, ts, asof.replace(day=1)))


def sample_months(
    df: DataFrame, ts: str, months: Sequence[int] = SAMPLED_MONTHS, years: Sequence[int] | None = None
) -> DataFrame:
    """Rows of the given calendar months of every year.

    With the ``years`` named, the months become time ranges that skip files and row groups.
    """
    if years is None:
        return df.where(F.month(ts).isin(*months))
    starts = [date(y, m, 1) for y in years for m in months]
    ranges = [(F.col(ts) >= _bound(df, ts, s)) & (F.col(ts) < _bound(df, ts, _following(s))) for s in starts]
    return df.where(reduce(lambda a, b: a | b, ranges))


def sample_hash(df: DataFrame, key: str, share: float) -> DataFrame:
    """A repeatable sample of keys: those whose hash falls in the lowest ``share`` of its range.

    Whole keys are kept or left out, and the choice depends on neither file layout nor run. A share
    of 1 keeps every key and 0 none; a NULL key is never kept.
    """
    if share >= 1:
        return df.where(F.col(key).isNotNull())
    if share <= 0:
        return df.where(F.lit(False))
    # 60 bits of the hash, as text of one length
    limit = f"{int(share * 16**15):015x}"
    return df.where(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 15) < limit)


def flatten_nested(df: DataFrame, array_col: str, fields: Sequence[str]) -> DataFrame:
    """One row per element of an array of structs, its fields as columns; empty names and sizes go."""
    rest = [c for c in df.columns if c != array_col]
    flat = df.select(*rest, F.inline(F.col(array_col)))
    name, *sizes = fields
    keep = present(F.col(name))
    for size in sizes:
        keep = keep & (F.col(size) > 0)
    return flat.where(keep)


def ingest_labels(df: DataFrame, exclude: Sequence[str] = EXCLUDED_LABELS) -> DataFrame:
    """Raw label rows as stored: normalised, excluded labels dropped, size unknown (0)."""
    label = normalise(F.col("language"))
    return df.where(present(F.col("language")) & ~label.isin(*exclude)).select(
        "repo_name", label.alias("language"), F.lit(0).cast("long").alias("bytes"), "created_at"
    )


def ingest_audit(df: DataFrame, exclude: Sequence[str] = EXCLUDED_LABELS) -> DataFrame:
    """Seen, kept and skipped rows of an ingest, in one pass."""
    label = normalise(F.col("language"))
    kept = F.coalesce(present(F.col("language")) & ~label.isin(*exclude), F.lit(False))
    counted = df.agg(F.count("*").alias("seen"), F.count_if(kept).alias("kept"))
    return counted.select(
        "seen",
        "kept",
        (F.col("seen") - F.col("kept")).alias("skipped"),
        F.round(F.try_divide(F.col("kept") * 100.0, F.col("seen")), 6).alias("kept_pct"),
        F.round(F.try_divide((F.col("seen") - F.col("kept")) * 100.0, F.col("seen")), 6).alias("skipped_pct"),
    )


def monthly_activity(events: DataFrame, entity: str, ts: str, event_type: tuple[str, str] | None = None) -> DataFrame:
    """Events per entity and month; ``event_type`` is (column, value)."""
    chosen = events if event_type is None else events.where(F.col(event_type[0]) == event_type[1])
    return (
        chosen.where(F.col(entity).isNotNull())
        .groupBy(F.col(entity), month_label(F.col(ts)).alias("year_month"))
        .agg(F.count("*").alias("commit_count"))
    )


def actor_edges(
    events: DataFrame, actor: str, entity: str, ts: str, bot_pattern: str = BOT_PATTERN
) -> DataFrame:
    """Events per (actor, entity, year) of actors that do not look automated."""
    login = F.lower(F.col(actor))
    return (
        events.where(present(F.col(actor)) & present(F.col(entity)) & ~login.rlike(bot_pattern))
        .groupBy(login.alias("actor"), F.col(entity).alias("repo_name"), year_label(F.col(ts)).alias("year"))
        .agg(F.count("*").alias("commit_count"))
    )


def json_unnest(df: DataFrame, payload: str, array_field: str, field: str) -> DataFrame:
    """One row per object of a JSON array inside ``payload``, with one text field of it."""
    schema = f"{array_field} array<struct<{field}: string>>"
    rest = [c for c in df.columns if c != payload]
    parsed = df.select(*rest, F.from_json(F.col(payload), schema).alias("_parsed"))
    return parsed.select(*rest, F.posexplode(f"_parsed.{array_field}").alias("pos", "_item")).select(
        *rest, "pos", F.col(f"_item.{field}").alias(field)
    )


def _stem(stems: Sequence[str]) -> str:
    return "|".join(rf"{s}\w*" for s in stems)


def pair_patterns(stems: Sequence[str], swap_stems: Sequence[str]) -> dict[str, str]:
    """The regular expressions that find the source and the target of a migration."""
    verb, swap = _stem(stems), _stem(swap_stems)
    return {
        "from_verb": rf"(?:{verb})[^.\n]{{0,60}}?\bfrom\b\s+({TOKEN})",
        "from_swap": rf"\b(?:{swap})\s+({TOKEN})\s+with\b",
        "to_verb": rf"(?:{verb})[^.\n]{{0,60}}?\b(?:to|with|into)\b\s+({TOKEN})",
        # the verb and its "to" may stand on two lines
        "to_direct": rf"\b(?:{verb})\s+to\s+({TOKEN})",
    }


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row, whatever is asked of them later.

    The rows pass through a generator, which the optimizer neither pushes filters through nor
    merges projections across; otherwise every mention of a column repeats its expression.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def parse_pairs(
    df: DataFrame,
    text: str,
    stems: Sequence[str] = MIGRATION_STEMS,
    swap_stems: Sequence[str] = SWAP_STEMS,
    strict: bool = False,
) -> DataFrame:
    """``from_tech`` and ``to_tech`` read from each message; NULL where the message names none.

    ``strict`` keeps the narrower behaviour of the original extraction: stems count only as whole
    words in the filters, "swap" has no target, and a closing full stop stays on the token.
    """
    patterns = STRICT_PATTERNS if strict else pair_patterns(stems, swap_stems)
    message = F.lower(F.col(text))
    told = F.col(text).isNotNull()
    if strict:
        told = (
            told & contains_pattern(message, STRICT_PAYLOAD_FILTER) & contains_pattern(message, STRICT_MESSAGE_FILTER)
        )
    else:
        told = told & message.rlike("|".join(dict.fromkeys([*stems, *swap_stems])))
    # a pattern is only looked for where the message has the word it turns on
    found = {
        "from_verb": F.when(message.contains("from"), first_match(message, patterns["from_verb"])),
        "from_swap": F.when(message.contains("with"), first_match(message, patterns["from_swap"])),
        "to_verb": first_match(message, patterns["to_verb"]),
        "to_direct": F.when(message.contains("to"), first_match(message, patterns["to_direct"])),
    }
    read = _once(df.where(told), _found=F.struct(*[c.alias(name) for name, c in found.items()]))

    def either(first: str, second: str) -> Column:
        token = F.coalesce(*[F.nullif(F.col(f"_found.{name}"), F.lit("")) for name in (first, second)])
        return token if strict else F.nullif(F.rtrim(token, F.lit(".-")), F.lit(""))

    return (
        read.withColumn("from_tech", either("from_verb", "from_swap"))
        .withColumn("to_tech", either("to_verb", "to_direct"))
        .drop("_found")
    )


def mine_pairs(
    df: DataFrame,
    text: str,
    period: str,
    stems: Sequence[str] = MIGRATION_STEMS,
    swap_stems: Sequence[str] = SWAP_STEMS,
    min_len: int = TOKEN_LENGTH[0],
    max_len: int = TOKEN_LENGTH[1],
    min_count: int = 2,
    strict: bool = False,
) -> DataFrame:
    """Migration pairs per period, seen at least ``min_count`` times."""
    sized = F.length("from_tech").between(min_len, max_len) & F.length("to_tech").between(min_len, max_len)
    # words without which there is no source or no target: far cheaper to look for than the patterns
    message = F.lower(F.col(text))
    sourced = message.contains("from") | message.contains("with")
    aimed = message.contains("to") | message.contains("with")
    return (
        parse_pairs(df.where(sourced & aimed), text, stems, swap_stems, strict)
        .where(sized & (F.col("from_tech") != F.col("to_tech")))
        .groupBy("from_tech", "to_tech", F.col(period).alias("year"))
        .agg(F.count("*").alias("migration_count"))
        .where(F.col("migration_count") >= min_count)
    )

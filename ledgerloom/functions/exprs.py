"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

# Every character that counts as a blank, as a pattern and as a list.
# (Java's Unicode \s misses U+001C..U+001F.)
BLANK = r"[\s\x1c-\x1f]"
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def ladder(rungs: Iterable[tuple[Column, str]], default: str) -> Column:
    """First hit wins: a CASE chain over (predicate, class)."""
    chain = None
    for predicate, value in rungs:
        chain = F.when(predicate, value) if chain is None else chain.when(predicate, value)
    return F.lit(default) if chain is None else chain.otherwise(default)


def strip(column: Column) -> Column:
    """Remove every kind of Unicode blank at both ends (``trim`` removes spaces only).

    Texts that begin and end with a visible ASCII character, nearly all, are left alone.
    """
    first, last = F.ascii(column), F.ascii(F.substring(column, -1, 1))
    plain = first.between(33, 126) & last.between(33, 126)
    return F.when(plain, column).otherwise(F.btrim(column, F.lit(BLANKS)))


def as_text(column: Column) -> Column:
    return column.cast("string")


def clean(column: Column) -> Column:
    """Text without outer blanks; NULL becomes the empty string."""
    return F.coalesce(strip(as_text(column)), F.lit(""))


def clean_or_null(column: Column) -> Column:
    return F.nullif(strip(as_text(column)), F.lit(""))


def clean_gender(column: Column) -> Column:
    return F.nullif(F.lower(strip(as_text(column))), F.lit(""))


def is_present(column: Column) -> Column:
    """Neither NULL nor spaces."""
    return column.isNotNull() & (F.trim(as_text(column)) != "")


def null_bucket(column: Column, label: str = "NULL") -> Column:
    return F.coalesce(F.nullif(F.trim(as_text(column)), F.lit("")), F.lit(label))


def differs(left: Column, right: Column) -> Column:
    return ~left.eqNullSafe(right)


def differs_blank(left: Column, right: Column) -> Column:
    """Inequality in which NULL and the empty string are the same value."""
    return F.coalesce(left, F.lit("")) != F.coalesce(right, F.lit(""))


def count_if(predicate: Column) -> Column:
    return F.count_if(predicate)


def is_short(column: Column) -> Column:
    return F.length(F.trim(as_text(column))).between(1, 2)


def has_check(column: Column, excluded: Sequence[str] = ("", "unverified")) -> Column:
    """The check holds some evidence, that is, a value outside ``excluded``."""
    return column.isNotNull() & ~F.lower(as_text(column)).isin(*excluded)


def is_short_alias(column: Column) -> Column:
    """At most two words."""
    return F.size(F.split(strip(column), f"(?U){BLANK}+")) <= 2


def is_provider_name(column: Column) -> Column:
    return F.lower(column).contains("provider")


def pct(part: Column, total: Column) -> Column:
    """Percent with two decimals, halves rounded up, 0 when the total is 0.

    Integer arithmetic keeps halves exact, so results do not hang on binary fractions.
    """
    hundredths = F.call_function("div", part * 20000 + total, total * 2)
    return F.when(total == 0, F.lit(0.0)).otherwise(hundredths / F.lit(100.0))


def share(part: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(part / total)


def join_set(column: Column, sep: str = "|") -> Column:
    """Aggregate: sorted distinct values as text. Only for columns with a small domain;
    sets of ids, labels or external ids go through ``operators.listing.member_values``."""
    return F.array_join(F.array_sort(F.collect_set(as_text(column))), sep)


def unique_sorted(values: Column) -> Column:
    """Array without blanks and copies, ordered without regard to case."""
    kept = F.array_distinct(F.filter(F.transform(values, clean), lambda v: v != ""))
    order = lambda a, b: (
        F.when(F.lower(a) < F.lower(b), -1)
        .when(F.lower(a) > F.lower(b), 1)
        .when(a < b, -1)
        .when(a > b, 1)
        .otherwise(0)
    )
    return F.array_sort(kept, order)


def json_cell(value: Column) -> Column:
    """A set, a counter or a struct as one JSON text; fields that are NULL stay."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def cardinality_class(values: Column) -> Column:
    return ladder([(F.size(values) == 0, "none"), (F.size(values) == 1, "single")], "multiple")


def value_mark(column: Column) -> Column:
    """64-bit mark of a value, NULL for NULL.

    Least and greatest marks fit fixed-width aggregation buffers, so Spark hashes where it
    would sort the rows for the least and greatest of a text. Different marks prove
    different values; a group whose values differ but all share one mark has odds of one
    in 2^64 per pair.
    """
    return F.when(column.isNotNull(), F.xxhash64(column))


def ends(**columns: Column) -> list[Column]:
    """Aggregates ``<name>_low`` and ``<name>_high`` over the marks of the columns."""
    found = []
    for name, column in columns.items():
        found.append(F.min(value_mark(column)).alias(f"{name}_low"))
        found.append(F.max(value_mark(column)).alias(f"{name}_high"))
    return found


def merged_ends(*names: str) -> list[Column]:
    """The same over frames that already hold both ends."""
    found = []
    for name in names:
        found.append(F.min(f"{name}_low").alias(f"{name}_low"))
        found.append(F.max(f"{name}_high").alias(f"{name}_high"))
    return found


def relation(low: Column, high: Column, none: str, one: str, many: str) -> Column:
    """Class of a set of values by the ends of its marks.

    Equal ends mean one value, so no set is collected: the class of a group of any size
    needs only two partial aggregates.
    """
    return ladder([(low.isNull(), none), (low == high, one)], many)


def yes_no(flag: Column) -> Column:
    return F.when(flag, "yes").otherwise("no")


def present_names(flags: Iterable[tuple[str, Column]], sep: str = "|") -> Column:
    """Names of the flags that hold, in the given order."""
    named = [F.when(flag, F.lit(name)) for name, flag in flags]
    return F.array_join(F.array_compact(F.array(*named)), sep)


def display_label(label: Column, entity_id: Column) -> Column:
    return F.coalesce(F.nullif(label, F.lit("")), F.concat(F.lit("Player "), as_text(entity_id)))


def or_blank(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))

"""Keys under which names are compared. Each rule is a different function on purpose.

ASCII names, nearly all of a register, take a native expression. Only the others reach
Python, in Arrow batches, where each distinct name of a batch is worked out once. The
work stays on the row, so a very common name costs no shuffle and heats no task.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from itertools import filterfalse

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from ledgerloom.functions.exprs import BLANK, strip

# The batch functions travel to the executors whole, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class NameRule:
    """What survives in a key: ``dropped`` is the pattern of runs replaced by ``gap``."""

    dropped: str
    gap: str = " "
    unmark: bool = True
    lower_first: bool = False


# The six pattern rules.
RULES = {
    "conservative": NameRule(r"\W+"),
    "alias": NameRule(r"[^a-z0-9]+"),
    "label": NameRule(r"[\W_]+"),
    "compact": NameRule(r"[^a-z0-9]+", gap="", lower_first=True),
    "words": NameRule(r"\W+", unmark=False),
    "ascii": NameRule(r"[^a-z0-9]+", unmark=False),
}


def without_marks(text: str) -> str:
    """Compatibility decomposition less its combining marks."""
    return "".join(filterfalse(unicodedata.combining, unicodedata.normalize("NFKD", text)))


def name_key(text: str, rule: NameRule) -> str:
    """The key of one name; the definition that the column functions follow."""
    if rule.lower_first:
        text = text.lower()
    if rule.unmark:
        text = without_marks(text)
    if not rule.lower_first:
        text = text.lower()
    return re.sub(rule.dropped, rule.gap, text).strip()


def _once_per_name(one: Callable[[str], str]) -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def batch(names: pd.Series) -> pd.Series:
        keys = {name: one(name) for name in names.dropna().unique()}
        return pd.Series([keys.get(name) for name in names], dtype=object)

    return batch


def _by_rule(column: Column, rule: NameRule) -> Column:
    plain = F.octet_length(column) == F.char_length(column)
    native = F.trim(F.regexp_replace(F.lower(column), rule.dropped, rule.gap))
    python = _once_per_name(lambda name: name_key(name, rule))
    key = F.when(plain, native).otherwise(python(F.when(~plain, column)))
    return F.coalesce(key, F.lit(""))


def norm_conservative(column: Column) -> Column:
    return _by_rule(column, RULES["conservative"])


def search_name(normalized: Column) -> Column:
    """Kept as a field of its own; today it equals the conservative key."""
    return normalized


def norm_alias(column: Column) -> Column:
    return _by_rule(column, RULES["alias"])


def norm_label(column: Column) -> Column:
    return _by_rule(column, RULES["label"])


def norm_compact(column: Column) -> Column:
    return _by_rule(column, RULES["compact"])


def norm_words(column: Column) -> Column:
    return _by_rule(column, RULES["words"])


def norm_ascii(column: Column) -> Column:
    """No marks are stripped, so every non-ASCII letter is a gap: native throughout."""
    rule = RULES["ascii"]
    key = F.trim(F.regexp_replace(F.lower(column), rule.dropped, rule.gap))
    return F.coalesce(key, F.lit(""))


def norm_space(column: Column, null_as: str | None = "") -> Column:
    """Lower case with runs of blanks as one space. ``null_as=None`` maps blank names to NULL."""
    key = strip(F.regexp_replace(F.lower(column), f"(?U){BLANK}+", " "))
    if null_as is None:
        return F.nullif(key, F.lit(""))
    return F.coalesce(key, F.lit(null_as))


def norm_trim(column: Column) -> Column:
    return F.lower(F.trim(column.cast("string")))


def norm_casefold(column: Column) -> Column:
    """Full case folding, in which ß equals SS."""
    text = strip(column)
    plain = F.octet_length(text) == F.char_length(text)
    folded = _once_per_name(str.casefold)(F.when(~plain, text))
    return F.when(plain, F.lower(text)).otherwise(folded)

"""Masking of personal values in text columns and in log records."""

from __future__ import annotations

import logging
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

MASK = "[REDACTED]"
# fixed values: masked in this order; of labelled values the label stays
_VALUE = r"""('[^']*'|"[^"]*"|[^\s,;]+)"""
LABELLED = (
    rf"(?i)(\b(?:date\s+of\s+birth|birth\s*date|d\.?o\.?b\.?|claimant_date_of_birth)\b\s*[:=]?\s*){_VALUE}",
    rf"(?i)(\bclaimant_[a-z_]+\b\s*[:=]\s*){_VALUE}",
)
BARE = (r"\b[STFG]\d{7}[A-Z]\b", r"(?<!\d)\d{9,12}(?!\d)")
#: What every match of LABELLED has, in lower case, but for the letters whose partner is an ASCII i; what every match of BARE has.
_LABELS, _OTHER_I, _DIGITS = ("birth", "dob", "d.ob", "do.b", "d.o.b", "claimant_"), "\u0130\u0131", r"(?U)\d{7}"


def mask(text: Column) -> Column:
    """Dates of birth and claimant values after their label, identity numbers, runs of 9 to 12 digits.

    A text without what such values have is not searched for them.
    """

    def replaced(t: Column, patterns: tuple[str, ...], by: str) -> Column:
        return reduce(lambda c, p: F.regexp_replace(c, "(?U)" + p, by), patterns, t)

    def labelled(t: Column) -> Column:
        named = let(F.lower(t), lambda low: reduce(or_, (F.contains(low, F.lit(x)) for x in _LABELS)))
        other = reduce(or_, (F.contains(t, F.lit(x)) for x in _OTHER_I))
        return F.when(named | other, replaced(t, LABELLED, "$1" + MASK)).otherwise(t)

    return let(let(text, labelled), lambda t: F.when(t.rlike(_DIGITS), replaced(t, BARE, MASK)).otherwise(t))


def mask_text(text: str) -> str:
    """``mask`` for the driver's own strings."""
    for p in LABELLED:
        text = re.sub(p, lambda m: m[1] + MASK, text)
    for p in BARE:
        text = re.sub(p, MASK, text)
    return text


class MaskingFilter(logging.Filter):
    """Masks the formatted message, ``extra`` attributes named claimant_*, and tracebacks."""

    def filter(self, record: logging.LogRecord) -> bool:
        text = record.getMessage()
        for name in [k for k, v in vars(record).items() if k.startswith("claimant_") and v is not None]:
            if value := str(getattr(record, name)):
                text = text.replace(value, MASK)
            setattr(record, name, MASK)
        record.msg, record.args = mask_text(text), None
        if record.exc_info:
            record.exc_text, record.exc_info = mask_text(logging.Formatter().formatException(record.exc_info)), None
        if record.stack_info:
            record.stack_info = mask_text(record.stack_info)
        return True


def install_masking(*loggers: str) -> None:
    """On the handlers of the root logger and of ``loggers``; doing it again changes nothing."""
    logging.basicConfig()
    for name in ("", *loggers):
        for handler in logging.getLogger(name or None).handlers:
            if not any(isinstance(f, MaskingFilter) for f in handler.filters):
                handler.addFilter(MaskingFilter())

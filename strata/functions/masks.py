"""Column masks (P1-P3). ``privileged`` is a bool or a boolean Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._col import as_col, as_lit


def _guard(c: Column, masked: Column, privileged) -> Column:
    if privileged is True:
        return c
    if privileged is False or privileged is None:
        return masked
    return F.when(as_lit(privileged), c).otherwise(masked)


def mask_email(c, privileged=False) -> Column:
    """``jane@x.com`` -> ``***@x.com`` (domain kept)."""
    c = as_col(c)
    return _guard(c, F.regexp_replace(c, r"^.*@", "***@"), privileged)


def mask_phone(c, privileged=False) -> Column:
    """``XXX-XXX-`` + the last four characters."""
    c = as_col(c)
    masked = F.when(c.isNotNull(), F.concat(F.lit("XXX-XXX-"), F.right(c, F.lit(4))))
    return _guard(c, masked, privileged)


def mask_null(c, privileged=False) -> Column:
    """NULL for the unprivileged."""
    c = as_col(c)
    return _guard(c, F.when(F.lit(False), c), privileged)  # NULL of the column's own type


def mask_hash(c, privileged=False) -> Column:
    """SHA-256 hex (joins still work on the hashed value)."""
    c = as_col(c).cast("string")  # text for the privileged too: one type
    return _guard(c, F.sha2(c, 256), privileged)


def mask_text(c, privileged=False, token: str = "***") -> Column:
    """A fixed token for non-NULL values (text, also for the privileged)."""
    c = as_col(c).cast("string")
    return _guard(c, F.when(c.isNotNull(), F.lit(token)), privileged)


MASKS = {"email": mask_email, "phone": mask_phone, "null": mask_null, "hash": mask_hash, "text": mask_text}


def redact_emails(c, token: str = "***@") -> Column:
    """Mask the local part of every e-mail address inside free text (the
    whole text). Texts without an ``@`` skip the regular expression."""
    c = as_col(c)
    return F.when(c.contains("@"), F.regexp_replace(c, r"[A-Za-z0-9._%+-]+@([A-Za-z0-9-]+\.[A-Za-z0-9.-]+)", token + "$1")) \
        .otherwise(c)

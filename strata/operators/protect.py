"""Row filters and tag-driven column policies."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.masks import MASKS


@dataclass
class Caller:
    """Who is reading: their groups and attributes (e.g. a region)."""

    groups: set = field(default_factory=set)
    attrs: dict = field(default_factory=dict)


def row_filter(df: DataFrame, column: str, caller: Caller, attr: str = "region", admin_group: str = "admins") -> DataFrame:
    """Callers see only rows whose ``column`` equals their attribute;
    members of ``admin_group`` see every row. A caller without the
    attribute sees nothing."""
    if admin_group in caller.groups:
        return df
    value = caller.attrs.get(attr)
    if value is None:
        return df.where(F.lit(False))
    return df.where(F.col(column) == F.lit(value))


def apply_policies(df: DataFrame, tags: dict[str, str], policies: dict[str, str], caller: Caller,
                   exempt_groups: dict[str, str] | None = None) -> DataFrame:
    """P5: columns are tagged once (``{column: tag}``), a policy maps a tag
    to a mask (``{tag: "email" | "phone" | "null" | "hash" | "text"}``);
    one ``select`` applies every mask of every tagged column present.
    ``exempt_groups`` maps a tag to the group allowed to see it in clear."""
    exempt_groups = exempt_groups or {}
    cols: list[Column] = []
    for c in df.columns:
        tag = tags.get(c)
        if tag and tag in policies:
            privileged = exempt_groups.get(tag) in caller.groups if tag in exempt_groups else False
            cols.append(MASKS[policies[tag]](c, privileged).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)

"""Declarative qualification rules: all must hold, the first that fails names the reason."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.functions.text import blank_if_null, is_blank, lenient_number

OPERATORS = {"exists", "not_exists", "in", "not_in", "contains_any", "not_contains_any", ">=", "<=", ">", "<", "==", "!=", "allow", "deny"}


@dataclass(frozen=True)
class Rule:
    """``field op value``; ``label`` names the reason, else op:field. ``scope`` "any" lets deny see all tags."""

    field: str
    op: str
    value: Any = None
    label: str = ""
    scope: str = "primary"
    stage: str = ""
    per_tag: dict[str, list[str]] = field(default_factory=dict)

    @property
    def reason(self) -> str:
        return self.label or f"{self.op}:{self.field}"


def _list(value: Any) -> list[str]:
    return [str(v).lower() for v in (value if isinstance(value, (list, tuple)) else [value])]


def holds(rule: Rule, tag_column: str | None = None) -> Column:
    """Whether a rule holds (never null). Tag fields are |-joined, the primary tag first."""
    raw = F.col(rule.field)
    text, number = F.lower(blank_if_null(raw)), lenient_number(raw)
    if rule.op in ("exists", "not_exists"):
        return ~is_blank(raw) if rule.op == "exists" else is_blank(raw)
    if rule.op in ("in", "not_in"):
        return text.isin(_list(rule.value)) if rule.op == "in" else ~text.isin(_list(rule.value))
    if rule.op in ("contains_any", "not_contains_any", "allow", "deny"):
        if rule.op == "deny" and rule.scope != "any":
            text = F.get(F.split(text, r"\|"), 0)
        any_of = lambda values: sum((text.contains(v).cast("int") for v in values), F.lit(0)) > 0
        found = any_of(_list(rule.value)) if rule.value else F.lit(False)
        if rule.op == "allow" and rule.per_tag and tag_column:
            tags = F.split(F.lower(blank_if_null(F.col(tag_column))), r"\|")
            for tag, values in rule.per_tag.items():
                found = found | (F.array_contains(tags, tag.lower()) & any_of(_list(values)))
        return found if rule.op in ("contains_any", "allow") else ~found
    if rule.op in ("==", "!="):
        try:
            same = F.when(number.isNotNull(), number == float(rule.value)).otherwise(text == str(rule.value).lower())
        except (TypeError, ValueError):
            same = text == str(rule.value).lower()
        return same if rule.op == "==" else ~same
    compare = {">=": number >= rule.value, "<=": number <= rule.value, ">": number > rule.value, "<": number < rule.value}
    return F.coalesce(compare[rule.op], F.lit(False))


def drop_reason(rules: list[Rule], columns: list[str], tag_column: str | None = None) -> Column:
    """The reason of the first rule that fails, or null. Rules on unknown fields, of other stages and operators are left out."""
    used = [r for r in rules if r.field in columns and r.op in OPERATORS and r.stage != "enrichment"]
    return F.coalesce(*[F.when(~holds(r, tag_column), F.lit(r.reason)) for r in used], F.lit(None).cast("string"))


def qualify(df: DataFrame, rules: list[Rule], tag_column: str | None = None) -> DataFrame:
    """``df`` with drop_reason; split by filters on it, so that kept and dropped rows are always all rows."""
    return df.withColumn("drop_reason", drop_reason(rules, df.columns, tag_column))

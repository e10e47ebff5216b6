"""Validation rules as data.

Each rule turns into one boolean *violation* column that is never NULL, so every rule of a table is
evaluated in the same projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Helper columns the validation plan adds before rules are evaluated.
DUPLICATE_FLAG = "_is_duplicate"


def reference_flag(column: str) -> str:
    return f"_has_{column}"


@dataclass(frozen=True)
class Rule:
    code: str
    reason: str
    kind: str
    column: str | None = None
    values: tuple = ()

    def holds(self) -> Column:
        """The acceptance predicate; NULL where the inputs leave it undecided."""
        c = F.col(self.column) if self.column else None
        if self.kind in ("key_present", "required"):
            return c.isNotNull() & (c != "")
        if self.kind == "unique":
            return ~F.col(DUPLICATE_FLAG)
        if self.kind == "exists":
            return F.col(reference_flag(self.column))
        if self.kind == "one_of":
            return c.isin(*self.values)
        if self.kind == "within":
            return c.between(*self.values)
        if self.kind == "positive":
            # Spark orders NaN above every number, so it has to be excluded by name.
            return (c > 0) & ~F.isnan(c)
        if self.kind == "non_negative":
            return (c >= 0) & ~F.isnan(c)
        if self.kind == "implies":
            when, then = self.values
            return ~(F.expr(when) & ~F.expr(then))
        raise ValueError(f"unknown rule kind {self.kind}")

    def violated(self, null_policy: str = "reject") -> Column:
        """TRUE where the record breaks the rule.

        An undecided implication is never a violation of its own: the NULL input already breaks the
        range or domain rule of its column. An undecided domain rule follows ``null_policy``:
        "reject" reports it, "drop" leaves the record out of both outputs.
        """
        undecided_is_fine = self.kind == "implies" or (
            self.kind == "one_of" and null_policy == "drop"
        )
        return ~F.coalesce(self.holds(), F.lit(undecided_is_fine))


def key_present(code: str, reason: str, column: str) -> Rule:
    return Rule(code, reason, "key_present", column)


def unique(code: str, reason: str, column: str) -> Rule:
    return Rule(code, reason, "unique", column)


def required(code: str, reason: str, column: str) -> Rule:
    return Rule(code, reason, "required", column)


def within(code: str, reason: str, column: str, low, high) -> Rule:
    return Rule(code, reason, "within", column, (low, high))


def positive(code: str, reason: str, column: str) -> Rule:
    return Rule(code, reason, "positive", column)


def non_negative(code: str, reason: str, column: str) -> Rule:
    return Rule(code, reason, "non_negative", column)


def one_of(code: str, reason: str, column: str, values: tuple) -> Rule:
    return Rule(code, reason, "one_of", column, values)


def exists(code: str, reason: str, column: str) -> Rule:
    return Rule(code, reason, "exists", column)


def implies(code: str, reason: str, *, when: str, then: str) -> Rule:
    return Rule(code, reason, "implies", None, (when, then))

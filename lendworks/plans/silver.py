"""Silver: every source validated in dependency order against accepted parents."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame

from lendworks.operators.skew import heavy_keys
from lendworks.operators.standardize import standardize
from lendworks.operators.validate import (
    ACCEPTED,
    accepted,
    all_rejects,
    reconcile,
    rejected,
    validate,
)
from lendworks.sources.registry import SOURCES

# Saves a validated frame under a name and returns a reader of it.
Save = Callable[[str, Callable[[], DataFrame], tuple[str, ...]], DataFrame]


class SilverLayer:
    """Lazily built Silver tables over one set of Bronze frames.

    Each source is validated once and saved partitioned by verdict. Silver rows and rejects are then
    partition-pruned reads of that one table, so neither recomputes the validation. A rejected
    parent rejects its children because children look only at accepted parent keys.
    """

    def __init__(
        self,
        bronze: Mapping[str, DataFrame],
        save: Save,
        null_policy: str = "reject",
        as_at: Column | None = None,
    ):
        self._bronze = bronze
        self._save = save
        self._null_policy = null_policy
        self._as_at = as_at
        self._hot: dict[str, dict[str, list]] = {}

    def hot(self, source: str) -> dict[str, list]:
        """Heavy keys of a feed's own key and references, sketched once for all that asks."""
        if source not in self._hot:
            spec = SOURCES[source]
            keys = [*([spec.key] if spec.deduplicated else []), *spec.references]
            self._hot[source] = heavy_keys(standardize(self._bronze[source], spec), keys)
        return self._hot[source]

    def validated(self, source: str) -> DataFrame:
        return self._save(f"validated_{source}", lambda: self._validate(source), (ACCEPTED,))

    def _validate(self, source: str) -> DataFrame:
        spec = SOURCES[source]
        parents = {
            column: self.keys(parent, *spec.carried.get(column, ()))
            for column, parent in spec.references.items()
        }
        return validate(self._bronze[source], spec, parents, self.hot(source), self._null_policy, self._as_at)

    def build(self, *sources: str) -> None:
        """Save all validated tables, or those named; sources whose parents are ready run side by side.

        The threads only submit jobs, so a small table does not leave the cluster waiting.
        """
        waiting = [s for s in SOURCES if s in self._bronze and s in (sources or SOURCES)]
        with ThreadPoolExecutor(len(SOURCES)) as pool:
            while waiting:
                ready = [s for s in waiting if not set(SOURCES[s].references.values()) & set(waiting)]
                list(pool.map(self.validated, ready))
                waiting = [s for s in waiting if s not in ready]

    def keys(self, source: str, *extra: str) -> DataFrame:
        """Accepted keys of a source; unique because duplicates are rejected."""
        return self.validated(source).filter(ACCEPTED).select(SOURCES[source].key, *extra)

    def payments_by_type(self) -> DataFrame:
        """Accepted payments with the loan type their reference check found."""
        payments = self.validated("emi_payments").filter(ACCEPTED)
        return payments.withColumnRenamed("parent_loan_type", "loan_type")

    def table(self, source: str) -> DataFrame:
        return accepted(self.validated(source))

    def rejects(self, source: str) -> DataFrame:
        return rejected(self.validated(source), SOURCES[source])

    def all_rejects(self) -> DataFrame:
        self.build()
        return all_rejects(self.rejects(s) for s in self._bronze)

    def reconciliation(self) -> DataFrame:
        self.build()
        return all_rejects(reconcile(self.validated(s), SOURCES[s]) for s in self._bronze)

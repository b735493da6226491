"""Conservation figures of a run (D1, D3, D4, D5): what goes into a step and what comes out of it.

The sums are metrics of the writes that the job makes anyway (``DataFrame.observe``): no extra job, no
second read.  A map task that runs twice (a lost executor) counts twice, so a figure that does not
agree is a reason to look, not to drop the result; ``strict`` makes it an error."""

from __future__ import annotations

import dataclasses
import threading
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Half a unit of the last place of a stored amount.
ROUNDED = Decimal("0.0000005")


@dataclasses.dataclass(frozen=True)
class Figure:
    """``explained``: what the step loses by its rules (a NULL cost bears no share).  ``allowed``: how
    far the rest may be off; None where the rules themselves decide how much is lost (levels without volume)."""

    step: str
    before: Decimal
    after: Decimal
    allowed: Decimal | None
    explained: Decimal = Decimal(0)

    @property
    def lost(self) -> Decimal:
        return self.before - self.after

    @property
    def agrees(self) -> bool:
        return self.allowed is None or abs(self.lost - self.explained) <= self.allowed

    def __str__(self) -> str:
        text = f"{self.step}: {self.before} in, {self.after} out, {self.lost} lost"
        if self.explained:
            text += f", {self.explained} of it on rows without a cost"
        return text if self.agrees else f"{text}: NOT CONSERVED (allowed {self.allowed})"


class NotConserved(RuntimeError):
    pass


class Figures:
    """Sums taken while a job runs.  ``wait``: seconds to wait for a sum of a step that Spark may have
    left out, for example as it had no rows."""

    def __init__(self, wait: float = 30) -> None:
        self._seen: dict[str, Observation] = {}
        self._wait = wait

    def watch(self, df: DataFrame, name: str, **sums: str | Column) -> DataFrame:
        """``df`` whose rows are counted and summed on their way."""
        self._seen[name] = seen = Observation()
        exact = {k: F.sum(F.col(c) if isinstance(c, str) else c).cast("decimal(38,6)") for k, c in sums.items()}
        return df.observe(seen, F.count("*").alias("rows"), *[c.alias(k) for k, c in exact.items()])

    def _sums(self, name: str) -> dict[str, Decimal]:
        out: dict[str, Decimal] = {}
        if name in self._seen:
            reader = threading.Thread(target=lambda: out.update(self._seen[name].get), daemon=True)
            reader.start()
            reader.join(self._wait)
        return {k: Decimal(v or 0) for k, v in out.items()}

    def _total(self, prefix: str) -> dict[str, Decimal]:
        total: dict[str, Decimal] = {}
        for name in self._seen:
            if name.split("#")[0] == prefix:
                for k, v in self._sums(name).items():
                    total[k] = total.get(k, Decimal(0)) + v
        return total

    def report(self, strict: bool = False) -> list[Figure]:
        """All figures, once everything is written.  Call it after the last action only."""
        zero = Decimal(0)
        pool, spread, delta, reported = (self._total(x) for x in ("pool", "spread", "delta", "reported"))
        found = [Figure("pool spread", spread.get("before", zero) + pool.get("pool_cost", zero), spread.get("after", zero),
                        2 * spread.get("rows", zero) * ROUNDED, spread.get("unborne", zero))]
        for step in ("positive", "negative"):
            of = self._total(step)
            found.append(Figure(f"{step} rows allocated", of.get("cost", zero), of.get("share", zero), None))
        found.append(Figure("delta booked", delta.get("reported", zero) - delta.get("ledger", zero), delta.get("delta", zero), zero))
        found.append(Figure("reported amounts, repeated for each ledger attribute", reported.get("reported", zero), delta.get("reported", zero), None))
        if strict and (wrong := [f for f in found if not f.agrees]):
            raise NotConserved("; ".join(map(str, wrong)))
        return found

"""Result columns of a registered query and how both engines must render them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DECIMALS = 6
# Sums differ in the last bits with the order of addition.  A hundredth of the last shown digit
# keeps decimal ties from falling to different sides.
NUDGE = 1e-8


@dataclass(frozen=True)
class Shape:
    """Names of the columns shown as text, as whole numbers and as rounded numbers."""

    text: str = ""
    whole: str = ""
    number: str = ""

    @property
    def columns(self) -> list[str]:
        return [*self.text.split(), *self.whole.split(), *self.number.split()]

    def project(self, df: DataFrame) -> DataFrame:
        """The Spark side."""
        return df.select(
            *[F.col(f"`{c}`").cast("string").alias(c) for c in self.text.split()],
            *[F.col(f"`{c}`").cast("long").alias(c) for c in self.whole.split()],
            *[
                F.round(F.col(f"`{c}`").cast("double") + NUDGE, DECIMALS).alias(c)
                for c in self.number.split()
            ],
        )

    def wrap(self, sql: str) -> str:
        """The SQL side: the same columns of a query given as text."""
        shown = [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in self.text.split()]
        shown += [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in self.whole.split()]
        shown += [
            f'round(CAST("{c}" AS DOUBLE) + {NUDGE:.8f}, {DECIMALS}) AS "{c}"'
            for c in self.number.split()
        ]
        return f"SELECT {', '.join(shown)} FROM ({sql}) AS result"


def bundle(name: str, stats: str = "n mean sd min max") -> str:
    """Names of a statistics bundle."""
    return " ".join(f"{name}_{s}" for s in stats.split())


def spread(template: str, **parts: str) -> str:
    """All names a template gives over space-separated parts."""
    names = [template]
    for key, values in parts.items():
        names = [n.replace("{" + key + "}", v) for n in names for v in values.split()]
    return " ".join(names)

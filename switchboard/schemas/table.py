"""Table contract: name, ordered typed columns, key and physical layout."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    pk: list[str] = field(default_factory=list)
    partition: str | None = None
    cluster: list[str] = field(default_factory=list)
    # Decimal columns that hold sums: stored with all digits Spark has, so a total beyond the declared precision stays whole.
    sums: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[tuple[str, str]]:
        """Ordered ``(column, type text)`` pairs; commas inside ``<>`` and ``()`` stay."""
        parts = re.split(r",\s+(?![^<(]*[>)])", self.ddl)
        return [tuple(p.split(" ", 1)) for p in parts]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def stored(self) -> T.StructType:
        """The declared columns with the types they are stored with: those of ``sums`` have room for any total."""
        fields = self.schema.fields
        return T.StructType(
            [T.StructField(f.name, T.DecimalType(38, f.dataType.scale)) if f.name in self.sums else f for f in fields]
        )

    def conform(self, df: DataFrame) -> DataFrame:
        """Project ``df`` to the declared columns, in order and with their stored types.

        Columns that already have the declared type are left bare so that a filter on a
        partition column still prunes partitions.
        """
        have = {f.name: f.dataType for f in df.schema.fields}
        out: list[Column] = []
        for f in self.stored.fields:
            col = F.col(f.name)
            out.append(col if have.get(f.name) == f.dataType else col.cast(f.dataType).alias(f.name))
        return df.select(*out)

"""Data contracts. Every check returns its violations; no rows means it holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse.operators.combine import union_all
from editpulse.operators.filters import AsOf, instant


def expect_not_null(rows: DataFrame, column: str) -> DataFrame:
    """The rows where the column is NULL."""
    return rows.where(F.col(column).isNull())


def expect_unique(rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their row count."""
    counted = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    return counted.agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def expect_accepted_values(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their row count. NULL is not a violation."""
    odd = rows.where(~F.col(column).isin(*values))
    return odd.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def expect_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with their row count. NULL is not a violation.

    The child is counted per key before the join, so a key with most of the rows joins as one row.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    counted = keys.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def expect_fresh(
    rows: DataFrame,
    column: str = "ingested_at",
    as_of: AsOf = None,
    warn_minutes: int = 5,
    error_minutes: int = 30,
) -> DataFrame:
    """One row: newest value, its age in seconds and pass / warn / error. No rows at all is an error."""
    newest = rows.agg(F.max(column).alias("latest"))
    age = F.unix_micros(instant(as_of)) - F.unix_micros("latest")
    minute = 60_000_000
    return newest.select(
        "latest",
        (age / F.lit(1_000_000)).alias("age_seconds"),
        F.when(age.isNull() | (age > error_minutes * minute), "error")
        .when(age > warn_minutes * minute, "warn")
        .otherwise("pass")
        .alias("status"),
    )


@dataclass(frozen=True)
class Contract:
    """What one relation promises."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, tuple] = field(default_factory=dict)
    # column -> (parent relation, parent column)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.not_null) + len(self.unique) + len(self.accepted) + len(self.relationships)


    def declared(self) -> list[tuple[str, str]]:
        """(check, column) of every check."""
        return [
            *[("not_null", c) for c in self.not_null],
            *[("unique", c) for c in self.unique],
            *[("accepted_values", c) for c in self.accepted],
            *[("relationships", c) for c in self.relationships],
        ]


def _code(rows: DataFrame, column: str) -> Column:
    """A column's values as 64-bit numbers: times and whole numbers as they are, others by their hash."""
    kind, value = rows.schema[column].dataType, F.col(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    return value.cast("bigint") if isinstance(kind, T.IntegralType) else F.when(value.isNotNull(), F.xxhash64(value))


# A check's number is its key space times this, plus the child's bit, or one of the two below.
_NUMBERS = 64
_UNIQUE, _ROW = 62, 61


class _Profile:
    """Key spaces and check numbers of a set of contracts.

    A key space holds the values of one column, and the values of the columns that refer to it. A check of single rows
    has a space of its own, with one key.
    """

    def __init__(self, contracts: Mapping[str, Contract]):
        self.spaces: dict[tuple, int] = {}
        self.numbers: list[tuple[int, str, str, str]] = []
        self.children: dict[int, int] = {}
        for name, contract in contracts.items():
            for check, column in contract.declared():
                self.numbers.append((self._number(name, contract, check, column), name, check, column))

    def space(self, *what: str) -> int:
        return self.spaces.setdefault(what, len(self.spaces))

    def _number(self, name: str, contract: Contract, check: str, column: str) -> int:
        if check == "unique":
            return self.space(name, column) * _NUMBERS + _UNIQUE
        if check != "relationships":
            return self.space(name, column, check) * _NUMBERS + _ROW
        space = self.space(*contract.relationships[column])
        bit = self.children.get(space, 0)
        self.children[space] = bit + 1
        return space * _NUMBERS + bit

    def entries(self, name: str, rows: DataFrame, contract: Contract | None) -> DataFrame | None:
        """(space, key, is_value, bits) of one relation, from one scan: its values, its references, its faulty rows."""

        def entry(present: Column, space: int, key: Column, is_value: bool, bits: int) -> Column:
            columns = {"space": F.lit(space), "key": key, "is_value": F.lit(int(is_value)).cast("bigint"), "bits": F.lit(bits).cast("bigint")}
            return F.when(present, F.struct(*[c.alias(n) for n, c in columns.items()]))

        found = []
        for of, space in self.spaces.items():
            if len(of) == 2 and of[0] == name:
                found.append(entry(F.col(of[1]).isNotNull(), space, _code(rows, of[1]), True, 0))
        for number, owner, check, column in self.numbers:
            if owner == name and check == "relationships":
                found.append(entry(F.col(column).isNotNull(), number // _NUMBERS, _code(rows, column), False, 1 << number % _NUMBERS))
            elif owner == name and check != "unique":
                faulty = F.col(column).isNull() if check == "not_null" else ~F.col(column).isin(*contract.accepted[column])
                found.append(entry(faulty, number // _NUMBERS, F.lit(0).cast("bigint"), True, 1 << _ROW))
        if not found:
            return None
        # Absent entries become empty rows, which the filter drops: cheaper than filtering the array of every row.
        return rows.select(F.inline(F.array(*found))).where(F.col("space").isNotNull())


def run_contracts(contracts: Mapping[str, Contract], relations: Mapping[str, DataFrame]) -> DataFrame:
    """(relation, check, column, violations), one row per declared check.

    Violations are offending rows for not_null and accepted_values, offending keys for unique and
    relationships. Every relation is read once. All keys of all checks are counted by one aggregation over (key
    space, key), combined before its shuffle; it decides uniqueness and references together, and a second one adds up
    the violations. Text keys are compared by 64-bit hashes.
    """
    profile = _Profile(contracts)
    spark = next(iter(relations.values())).sparkSession
    read = {*contracts, *(of[0] for of in profile.spaces)}
    parts = [profile.entries(name, relations[name], contracts.get(name)) for name in relations if name in read]
    keys = union_all([p for p in parts if p is not None]).groupBy("space", "key")
    counted = keys.agg(F.sum("is_value").alias("n"), F.bit_or("bits").alias("bits"))

    def broken(bit: int, is_broken: Column, n: Column) -> Column:
        number = (F.col("space") * _NUMBERS + bit).alias("number")
        return F.when(is_broken, F.struct(number, n.cast("bigint").alias("violations")))

    has = lambda bit: F.col("bits").bitwiseAND(F.lit(1 << bit)) != 0
    referred = [broken(bit, (F.col("n") == 0) & has(bit), F.lit(1)) for bit in range(max(profile.children.values(), default=0))]
    marks = [broken(_ROW, has(_ROW), F.col("n")), broken(_UNIQUE, (F.col("n") > 1) & ~has(_ROW), F.lit(1)), *referred]
    found = counted.select(F.inline(F.array(*marks))).where(F.col("number").isNotNull())
    named = spark.createDataFrame([(*row, 0) for row in profile.numbers], "number INT, relation STRING, `check` STRING, `column` STRING, violations BIGINT")
    added = named.unionByName(found, allowMissingColumns=True).groupBy("number")
    texts = [F.max(c).alias(c) for c in ("relation", "check", "column")]
    # A value that comes twice in a column without a unique check has a number that no check bears.
    return added.agg(*texts, F.sum("violations").alias("violations")).where(F.col("relation").isNotNull()).drop("number")

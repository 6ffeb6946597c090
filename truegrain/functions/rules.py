"""Cross-column rules with two-valued logic.

A rule is a callable over a row, written with ``&``, ``|`` and ``~``::

    lambda row: ~((row["age"] < 18) & (row["is_adult"] == True))

or a boolean Column, or a SQL expression string. A callable gets Python's answers
rather than SQL's: comparing with a missing number is False (so its negation is
True), ordering a missing text is an error, as is naming a column the table lacks,
and an error breaks the rule unless ``&`` or ``|`` was decided before reaching it.
Columns and SQL strings are taken as they are, with null read as broken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions import cells


class Truth:
    """A yes/no answer and whether reaching it failed."""

    def __init__(self, yes: Column, error: Column | None = None):
        self.yes = yes
        self.error = error

    def __and__(self, other: Truth) -> Truth:
        return Truth(self.yes & other.yes, _either(self.error, other.error, self.yes))

    def __or__(self, other: Truth) -> Truth:
        return Truth(self.yes | other.yes, _either(self.error, other.error, ~self.yes))

    def __invert__(self) -> Truth:
        return Truth(~self.yes, self.error)

    def holds(self) -> Column:
        return self.yes if self.error is None else self.yes & ~self.error


def _either(first: Column | None, second: Column | None, reached: Column | None = None):
    """The left side fails, or the right side fails and is reached."""
    if second is not None and reached is not None:
        second = second & reached
    if first is None or second is None:
        return first if second is None else second
    return first | second


class Cell:
    """A value in the row under test."""

    def __init__(self, value: Column, text: bool = False, error: Column | None = None):
        self.value = value
        self.text = text
        self.error = error

    def _compare(self, other, test: Callable[[Column, Column], Column], ordering: bool) -> Truth:
        right = other if isinstance(other, Cell) else Cell(F.lit(other), isinstance(other, str))
        error = _either(self.error, right.error)
        if ordering and (self.text or right.text):
            error = _either(error, self.value.isNull() | right.value.isNull())
        return Truth(F.coalesce(test(self.value, right.value), F.lit(False)), error)

    def __lt__(self, other) -> Truth:
        return self._compare(other, lambda a, b: a < b, True)

    def __le__(self, other) -> Truth:
        return self._compare(other, lambda a, b: a <= b, True)

    def __gt__(self, other) -> Truth:
        return self._compare(other, lambda a, b: a > b, True)

    def __ge__(self, other) -> Truth:
        return self._compare(other, lambda a, b: a >= b, True)

    def __eq__(self, other) -> Truth:  # type: ignore[override]
        return self._compare(other, lambda a, b: a == b, False)

    def __ne__(self, other) -> Truth:  # type: ignore[override]
        return ~self._compare(other, lambda a, b: a == b, False)

    __hash__ = None  # type: ignore[assignment]

    def isin(self, values: Iterable) -> Truth:
        return Truth(F.coalesce(self.value.isin(list(values)), F.lit(False)), self.error)

    def is_missing(self) -> Truth:
        return Truth(self.value.isNull(), self.error)

    def is_present(self) -> Truth:
        return Truth(self.value.isNotNull(), self.error)

    def _compute(self, other, sum_up: Callable[[Column, Column], Column]) -> Cell:
        right = other if isinstance(other, Cell) else Cell(F.lit(other))
        return Cell(sum_up(self.value, right.value), False, _either(self.error, right.error))

    def __add__(self, other) -> Cell:
        return self._compute(other, lambda a, b: a + b)

    def __sub__(self, other) -> Cell:
        return self._compute(other, lambda a, b: a - b)

    def __mul__(self, other) -> Cell:
        return self._compute(other, lambda a, b: a * b)

    def __truediv__(self, other) -> Cell:
        return self._compute(other, F.try_divide)

    def __abs__(self) -> Cell:
        return Cell(F.abs(self.value), False, self.error)


class Row:
    """Hands a rule its cells; NaN counts as missing."""

    def __init__(self, df: DataFrame):
        self._df = df

    def __getitem__(self, name: str) -> Cell:
        dtype = cells.dtype_of(self._df, name)
        if dtype is None:
            return Cell(F.lit(None).cast("double"), False, F.lit(True))
        value = cells.column(name)
        if cells.is_fraction(dtype):
            value = F.when(~F.isnan(value), value)
        return Cell(value, cells.is_text(dtype))


Rule = Callable[[Row], Truth] | Column | str


def _resolves(df: DataFrame, test: Column) -> bool:
    """Whether the table has every column the test names; asks the schema, runs nothing."""
    try:
        return len(df.select(test).columns) == 1
    except AnalysisException as failure:
        if (failure.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise


def holds(df: DataFrame, rule: Rule) -> Column:
    """The rule as a Column that is true or false on every row of ``df``."""
    if isinstance(rule, (Column, str)):
        test = F.expr(rule) if isinstance(rule, str) else rule
        return F.coalesce(test, F.lit(False)) if _resolves(df, test) else F.lit(False)
    answer = rule(Row(df))
    if not isinstance(answer, Truth):
        raise TypeError("a rule must return a comparison of row cells; combine with &, | and ~")
    return answer.holds()

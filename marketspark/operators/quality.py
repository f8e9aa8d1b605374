"""Row rules, rejected rows with reasons, attrition per rule, table tests, publish gate."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.functions.dates import day
from marketspark.functions.numbers import double, number, positive, whole
from marketspark.functions.text import has_text, is_currency, literal
from marketspark.schemas import CORRUPT, EQUITY, FX

FX_COLUMNS = ("date", "base", "quote", "rate")
EQUITY_COLUMNS = ("date", "ticker", "open", "high", "low", "close", "adj_close", "volume")
PRICES = ("open", "high", "low", "close", "adj_close")


@dataclass(frozen=True)
class Rule:
    """A named row condition in SQL; a null outcome counts as a failure."""

    name: str
    passes: str

    @property
    def fails(self) -> str:
        return f"not coalesce({self.passes}, false)"


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    """Fail with the list of absent columns. Looks at the schema only."""
    present = set(df.columns)
    missing = [name for name in names if name not in present]
    if missing:
        raise ValueError(f"{what} lacks columns: {missing}")


def kinds(df: DataFrame) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in df.schema.fields}


def _every(conditions: Iterable[str]) -> str:
    return " and ".join(f"({condition})" for condition in conditions)


def _not_null(names: Iterable[str]) -> list[str]:
    return [f"{name} is not null" for name in names]


def _readable(kind: dict[str, T.DataType], keys: Sequence[str]) -> list[Rule]:
    """A document that could not be parsed has no field at all, only its raw text."""
    if CORRUPT not in kind:
        return []
    return [Rule("readable", f"{CORRUPT} is null or {' or '.join(_not_null(keys))}")]


def fx_rules(df: DataFrame, check_currency: bool = True) -> list[Rule]:
    """Rules of an exchange-rate record, in the order they are attributed."""
    require_columns(df, FX_COLUMNS, "exchange-rate records")
    kind = kinds(df)
    rules = _readable(kind, FX_COLUMNS)
    if CORRUPT in kind:
        # The rate is read as a double: a quoted number or a boolean leaves it
        # null and keeps the raw document.
        rules.append(Rule("rate_type", f"rate is not null or {CORRUPT} is null"))
    code_ok = is_currency if check_currency else has_text
    present = [*_not_null(FX_COLUMNS[:3]), f"{number('rate', kind['rate'])} is not null"]
    return rules + [
        Rule("required", _every(present)),
        Rule("date_format", f"{day('date', kind['date'])} is not null"),
        Rule("currency", _every(map(code_ok, ("base", "quote")))),
        Rule("positive_rate", positive(double("rate"))),
    ]


def equity_rules(df: DataFrame) -> list[Rule]:
    """Rules of a daily bar, in the order they are attributed."""
    require_columns(df, EQUITY_COLUMNS, "daily bars")
    kind = kinds(df)
    present = ["date is not null", has_text("ticker")]
    present += [f"{number(name, kind[name])} is not null" for name in PRICES]
    # ``required`` checks the shape of each price, so later rules cast it plainly.
    open_, high, low, close, _ = map(double, PRICES)
    ohlc = [f"{high} >= {x}" for x in (low, open_, close)] + [f"{low} <= {x}" for x in (open_, close)]
    volume = whole("volume", kind["volume"])
    return _readable(kind, ("date", "ticker", *PRICES)) + [
        Rule("required", _every(present)),
        Rule("date_format", f"{day('date', kind['date'], allow_time=True)} is not null"),
        Rule("positive_price", _every(positive(double(name)) for name in PRICES)),
        Rule("ohlc", _every(ohlc)),
        Rule("volume", f"{volume} is null or {volume} >= 0"),
    ]


def require_casts(df: DataFrame, casts: dict[str, str], record: Sequence[str]) -> DataFrame:
    """Fail on the first value that its cast in ``casts`` cannot read, naming the record and the field.

    A missing value passes; a field that kept its document from being parsed whole does not.
    """
    named = ", ', {0}=', coalesce(cast(`{0}` as string), 'null')"
    label = "".join(named.format(name) for name in record)
    for field, cast in casts.items():
        bad = f"`{field}` is not null and ({cast}) is null"
        if CORRUPT in df.columns:
            bad = f"({bad}) or (`{field}` is null and {CORRUPT} is not null)"
        text = f"concat('{field} cannot be read: ', coalesce(cast(`{field}` as string), 'not of its type'){label})"
        # A value that is not deterministic keeps Spark from moving later filters below this one, where they would hide it.
        df = df.where(f"if({bad}, cast(raise_error({text}) as boolean), monotonically_increasing_id() >= 0)")
    return df


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every rule. One conjunction, so simple parts reach the scan."""
    return df.where(_every(rule.passes for rule in rules))


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the names of all failed rules and of the first one.

    Each rule is evaluated once per row, and in generated code: ``array_compact`` and other
    functions of a lambda would have Spark interpret the rules.
    """
    failed = ", ".join(f"if({rule.fails}, '{rule.name}', '')" for rule in rules)
    return df.selectExpr("*", f"array_remove(array({failed}), '') as reject_reasons").selectExpr("*", "get(reject_reasons, 0) as first_reason")


def rejected(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that fail a rule, with the reasons."""
    return with_reasons(df, rules).where("first_reason is not null")


def attrition(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Rows before and after each rule, where a rule sees the survivors of those before it.

    A row belongs to its first failing rule, so one global aggregate gives all
    steps and the rows are read once.
    """
    last = len(rules)
    first_failing = " ".join(f"when {rule.fails} then {i}" for i, rule in enumerate(rules))
    counts = ", ".join(f"count_if(step > {i}) as n{i + 1}" for i in range(last))
    steps = ", ".join(
        f"struct('{table}' as table_name, {i + 1} as step, '{rule.name}' as rule, n{i} as rows_before, "
        f"n{i} - n{i + 1} as rows_removed, n{i + 1} as rows_after)"
        for i, rule in enumerate(rules)
    )
    return (
        df.selectExpr(f"case {first_failing} else {last} end as step")
        .selectExpr("count(*) as n0", *counts.split(", "))
        .selectExpr(f"inline(array({steps}))")
    )


@dataclass(frozen=True)
class TableTests:
    """Declared tests of one table."""

    table: str
    not_null: Sequence[str] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()


# The tests declared for each published table.
DECLARED_TESTS = {
    "staging_fx": TableTests("staging_fx", ("date", "base", "quote", "rate")),
    "staging_equity": TableTests(
        "staging_equity", ("date", "instrument", "open", "high", "low", "close")
    ),
    "silver": TableTests(
        "silver", ("date", "asset_type", "instrument", "source"),
        accepted=(("asset_type", (FX, EQUITY)),),
    ),
    "gold_market": TableTests("gold_market", ("date",), unique=(("date",),)),
}


def run_tests(df: DataFrame, tests: TableTests) -> DataFrame:
    """Failing rows per declared test; ``unique`` counts the repeated keys.

    All null and value tests share one aggregate; each unique key costs one
    aggregation, combined before the shuffle.
    """
    checks = [("not_null", name, f"`{name}` is null") for name in tests.not_null]
    checks += [
        ("accepted_values", name, f"`{name}` not in ({', '.join(map(literal, values))})")
        for name, values in tests.accepted
    ]

    def row(kind: str, name: str, failures: str) -> str:
        return (
            f"struct('{tests.table}' as table_name, '{name}' as column_name, "
            f"'{kind}' as test, {failures} as failures)"
        )

    parts = []
    if checks:
        counts = [f"count_if({bad}) as f{i}" for i, (_, _, bad) in enumerate(checks)]
        rows = ", ".join(row(kind, name, f"f{i}") for i, (kind, name, _) in enumerate(checks))
        parts.append(df.selectExpr(*counts).selectExpr(f"inline(array({rows}))"))
    for key in tests.unique:
        repeated = (
            df.dropna(subset=list(key)).groupBy(*key).agg(F.expr("count(*) as n"))
            .selectExpr("count_if(n > 1) as f")
        )
        parts.append(repeated.selectExpr(f"inline(array({row('unique', ','.join(key), 'f')}))"))
    return reduce(DataFrame.unionByName, parts)


def check_publishable(df: DataFrame, name: str) -> DataFrame:
    """Refuse an empty table or one with a repeated column name.

    Call it on a table that is already written: the emptiness check then reads
    one row instead of running the plan behind the table.
    """
    repeated = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if repeated:
        raise ValueError(f"{name} repeats columns: {repeated}")
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df


def check_tests(results: DataFrame) -> None:
    """Refuse a table whose declared tests fail. The result has a row per test."""
    failing = results.where("failures > 0").collect()
    if failing:
        raise ValueError("; ".join(
            f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in failing
        ))

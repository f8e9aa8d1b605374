"""Tables declared by what they are made of, and built through the catalog in that order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from marketspark.operators.dedupe import SILVER_ORDER, dedupe
from marketspark.operators.returns import simple_returns
from marketspark.operators.upsert import upsert
from marketspark.operators.weekly import weekly_performance
from marketspark.plans.layers import gold_market, gold_returns, unify
from marketspark.plans.staging import EQUITY_ORDER, FX_ORDER, stage_equity, stage_fx
from marketspark.schemas import EQUITY_KEY, FX_KEY, SILVER, SILVER_KEY
from marketspark.session import make_folder
from marketspark.sources.tables import GRAINS

KINDS = ("view", "table", "incremental")


@dataclass(frozen=True)
class Model:
    """A relation: ``build`` makes it from its ``inputs``, other models or given sources, in their order.

    A ``view`` is evaluated by its readers, a ``table`` is rebuilt whole, and an
    ``incremental`` one, which has a ``date``, takes the rows built now by ``key``; the last by ``order`` wins.
    """

    name: str
    kind: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    key: Sequence[str] = ()
    order: Sequence[str] = ()

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"{self.name}: kind must be one of {KINDS}, not {self.kind!r}")
        if (self.kind == "incremental") != bool(self.key):
            raise ValueError(f"{self.name}: an incremental model, and no other, needs a key")


def _silver(rows: DataFrame) -> DataFrame:
    return simple_returns(rows).select(*SILVER.fieldNames())


MODELS = (
    Model("staging_fx", "incremental", ("bronze_fx",), stage_fx, FX_KEY, FX_ORDER),
    Model("staging_equity", "incremental", ("bronze_equity",), stage_equity, EQUITY_KEY, EQUITY_ORDER),
    Model("observations", "view", ("staging_fx", "staging_equity"), lambda fx, equity: dedupe(unify(fx, equity), SILVER_KEY, SILVER_ORDER)),
    Model("silver", "table", ("observations",), _silver),
    Model("gold_market_data", "table", ("silver",), gold_market),
    Model("gold_returns", "table", ("silver",), gold_returns),
    Model("weekly_performance", "table", ("silver",), weekly_performance),
)


def plan(models: Sequence[Model], target: str) -> list[Model]:
    """Models to build, inputs first: ``name`` is that model alone, ``+name`` with all it is made of, ``*`` is all."""
    known = {model.name: model for model in models}
    if len(known) < len(models):
        raise ValueError("a model is declared twice")
    graph = {model.name: [name for name in model.inputs if name in known] for model in models}
    order = [name for name in TopologicalSorter(graph).static_order()]  # an error where they depend on each other
    if target == "*":
        return [known[name] for name in order]
    name = target.removeprefix("+")
    if name not in known:
        raise ValueError(f"no model {name!r}")
    wanted, open_names = {name}, [name] if target.startswith("+") else []
    while open_names:
        more = [n for n in graph[open_names.pop()] if n not in wanted]
        wanted.update(more)
        open_names += more
    return [known[name] for name in order if name in wanted]


def build(
    spark: SparkSession, models: Sequence[Model], target: str, sources: Mapping[str, DataFrame], database: str, root: str,
    grain: str = "month",
) -> list[str]:
    """Build the models of ``target`` in ``database``; the names built, in order.

    ``sources`` are frames by name. Incremental tables live below ``root``, partitioned by
    date. Inputs that are not selected must have been built before.
    """
    spark.sql(f"create database if not exists `{database}`")
    done = []
    for model in plan(models, target):
        inputs = [sources[name] if name in sources else _relation(spark, database, name) for name in model.inputs]
        rows, name = model.build(*inputs), f"`{database}`.`{model.name}`"
        if model.kind == "view":
            rows.createOrReplaceTempView(_view(database, model.name))
        elif model.kind == "table":
            rows.write.mode("overwrite").format("parquet").saveAsTable(name)
        else:
            path = f"{root.rstrip('/')}/{model.name}"
            upsert(rows, path, model.key, model.order, grain)
            make_folder(spark, path)  # of a table without rows
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema)
            parts = GRAINS[grain]
            spark.sql(
                f"create table if not exists {name} ({columns}, {', '.join(f'{p} int' for p in parts)}) using parquet "
                f"partitioned by ({', '.join(parts)}) location '{path}'")
            spark.sql(f"alter table {name} recover partitions")
            spark.catalog.refreshTable(name)
        done.append(model.name)
    return done


def _view(database: str, name: str) -> str:
    return f"{database}_{name}"  # temporary views belong to no database


def _relation(spark: SparkSession, database: str, name: str) -> DataFrame:
    view = _view(database, name)
    if spark.catalog.tableExists(view):
        return spark.table(view)
    table = spark.table(f"`{database}`.`{name}`")
    return table.drop(*[part for part in GRAINS["day"] if part in table.columns])

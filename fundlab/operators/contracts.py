"""Tables with declared types, keys and ranges, checked while rows are written.

Rows that break a table's contract do not reach it: they go to a table beside it, as texts, with what is wrong. A batch of which
more than a share is broken changes nothing. Counts come from the write itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from fundlab.operators.store import exists, upsert, write_table
from fundlab.storage import materialize, release


class ContractBroken(Exception):
    """Too many rows of a batch break the table's contract."""


@dataclass(frozen=True)
class Contract:
    """columns: name -> type. key: columns that are not null and together unique. ranges: column -> (least, most), either may be None. required: further columns that are not null."""

    columns: dict[str, str]
    key: tuple[str, ...]
    ranges: dict[str, tuple] = field(default_factory=dict)
    required: tuple[str, ...] = ()

    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in self.columns.items()))


# The tables of the engine.
CONTRACTS = {
    "nav_daily": Contract({"scheme_code": "string", "nav_date": "date", "nav": "double"}, ("scheme_code", "nav_date"), {"nav": (0, None)}, ("nav",)),
    "benchmark_daily": Contract({"ticker": "string", "date": "date", "close": "double"}, ("ticker", "date"), {"close": (0, None)}, ("close",)),
    "rf_daily": Contract({"date": "date", "rate": "double", "source": "string"}, ("date",), {"rate": (0, 100)}, ("rate",)),
    "holdings_monthly": Contract({"scheme_code": "string", "security_name": "string", "as_of_month": "date", "weight_pct": "double", "isin": "string", "instrument_type": "string", "source_amc": "string", "computed_at": "timestamp"}, ("scheme_code", "security_name", "as_of_month"), {"weight_pct": (-100, 200)}),
    "index_constituents_monthly": Contract({"ticker": "string", "isin": "string", "as_of_month": "date", "weight_pct": "double", "security_name": "string"}, ("ticker", "isin", "as_of_month"), {"weight_pct": (0, 100)}),
    "portfolio_turnover_monthly": Contract({"scheme_code": "string", "as_of_month": "date", "ptr": "double", "source_amc": "string", "computed_at": "timestamp"}, ("scheme_code", "as_of_month"), {"ptr": (0, None)}),
    "stock_adv_daily": Contract({"isin": "string", "symbol": "string", "date": "date", "close": "double", "total_traded_value": "double"}, ("isin", "date"), {"total_traded_value": (0, None)}),
    "scheme_aum_monthly": Contract({"scheme_code": "string", "as_of_month": "date", "aum_crore": "double", "source_amc": "string", "computed_at": "timestamp"}, ("scheme_code", "as_of_month"), {"aum_crore": (0, None)}),
}


def conformed(rows: DataFrame, contract: Contract) -> DataFrame:
    """rows with the contract's columns, in its order and types, and ``broken``, what is wrong with a row. Columns that are not there are null; others go.

    Of rows with one key the first by all columns is kept, and the others are broken, but equal rows count once.
    """
    given = set(rows.columns)
    text = lambda c: F.col(f"`{c}`").cast("string") if c in given else F.lit(None).cast("string")
    typed = {c: (F.col(f"`{c}`").try_cast(t) if c in given else F.lit(None)).cast(t) for c, t in contract.columns.items()}
    read = rows.select(*[v.alias(c) for c, v in typed.items()], F.struct(*[text(c).alias(c) for c in contract.columns]).alias("_given"))
    reasons = [F.when(F.col(f"_given.{c}").isNotNull() & F.col(c).isNull(), f"{c} is no {t}") for c, t in contract.columns.items()]
    reasons += [F.when(F.col(c).isNull() & F.col(f"_given.{c}").isNull(), f"{c} is missing") for c in (*contract.key, *contract.required)]
    for c, (least, most) in contract.ranges.items():
        outside = (F.col(c) < least if least is not None else F.lit(False)) | (F.col(c) > most if most is not None else F.lit(False)) | (F.isnan(c) if contract.columns[c] == "double" else F.lit(False))
        reasons.append(F.when(outside, f"{c} is outside its range"))
    judged = read.withColumn("broken", F.array_compact(F.array(*reasons))).dropDuplicates()
    sound = F.size("broken") == 0
    by_key = Window.partitionBy(*contract.key, sound).orderBy(*contract.columns)
    again = sound & (F.row_number().over(by_key) > 1)
    return judged.withColumn("_again", again).withColumn("broken", F.when(F.col("_again"), F.array(F.lit("another row has its key"))).otherwise(F.col("broken"))).drop("_again")


def create_tables(spark: SparkSession, root: str, contracts: dict[str, Contract] = CONTRACTS) -> list[str]:
    """Make the tables that are not there, empty and typed: their names."""
    made = [name for name in contracts if not exists(spark, f"{root}/{name}")]
    for name in made:
        write_table(spark.createDataFrame([], contracts[name].schema()), f"{root}/{name}")
    return made


def upsert_checked(rows: DataFrame, path: str, contract: Contract, most_broken: float = 0.0, batch: str = "") -> dict[str, int]:
    """Merge a batch's sound rows into a table and its broken ones into ``{path}_broken``: how many of each.

    Where more than ``most_broken`` of the rows are broken the table stays as it was, the broken rows are kept all the same, and ContractBroken is raised. A batch that
    is run again, under the same name, gives the same two tables.
    """
    spark = rows.sparkSession
    judged = materialize(conformed(rows, contract), n=F.count(F.lit(1)), broken=F.count_if(F.size("broken") > 0))
    n, broken = (judged.seen.get(k) or 0 for k in ("n", "broken"))
    if broken:
        kept = judged.filter(F.size("broken") > 0).select(F.lit(batch).alias("batch"), F.to_json("_given").alias("given"), F.array_join("broken", "; ").alias("broken"))
        upsert(kept, f"{path}_broken", ["batch", "given"])
    if broken > most_broken * n:
        release(judged)
        raise ContractBroken(f"{broken} of {n} rows break the contract of {path}")
    if not exists(spark, path):
        write_table(spark.createDataFrame([], contract.schema()), path)
    upsert(judged.filter(F.size("broken") == 0).select(*contract.columns), path, list(contract.key))
    release(judged)
    return {"written": n - broken, "broken": broken}

"""Which tables and columns a point-in-time read may use, checked before a plan is built."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.asof import as_of

CLASSES = ("immutable", "season_scoped", "asof_filtered", "evaluation_only", "forbidden_current_state", "unsupported")


class PolicyError(ValueError):
    pass


@dataclass(frozen=True)
class TablePolicy:
    kind: str
    features: tuple[str, ...] = ()
    anchor: tuple[str, ...] = ()
    time: str | None = None


@dataclass
class Registry:
    tables: dict[str, TablePolicy] = field(default_factory=dict)

    def policy(self, table: str) -> TablePolicy:
        if table not in self.tables:
            raise PolicyError(f"unknown table {table}")
        found = self.tables[table]
        if found.kind in ("forbidden_current_state", "unsupported"):
            raise PolicyError(f"{table} is {found.kind}")
        return found

    def check(self, table: str, columns: list[str], purpose: str = "feature") -> None:
        found = self.policy(table)
        if found.kind == "evaluation_only" and purpose != "evaluation":
            raise PolicyError(f"{table} is for evaluation only")
        if "*" in columns and found.kind != "immutable":
            raise PolicyError(f"{table}: columns must be named")
        extra = [c for c in columns if c not in (*found.features, *found.anchor, found.time, "*")]
        if extra:
            raise PolicyError(f"{table}: {', '.join(extra)} may not be read")

    def select(self, table: str, df: DataFrame, columns: list[str], purpose: str = "feature") -> DataFrame:
        self.check(table, columns, purpose)
        return df.select(*columns)

    def observation(self, table: str, df: DataFrame) -> DataFrame:
        """Only the table's feature columns that exist, with its anchor and time."""
        found = self.policy(table)
        return df.select(*[c for c in (*found.anchor, *([found.time] if found.time else []), *found.features) if c in df.columns])

    def as_of(self, table: str, df: DataFrame, content: str, cutoff: Column, keep: tuple[str, ...] = ()) -> DataFrame:
        found = self.policy(table)
        if found.kind != "asof_filtered" or not found.time:
            raise PolicyError(f"{table} has no transaction time")
        self.check(table, list(keep))
        return as_of(df, found.anchor, found.time, content, cutoff, keep)


#: Tables that evidence may be cited from, with the column that names a row; and what each lane's digests cover.
EVIDENCE_TABLES = {"results": "result_id", "schedules": "schedule_id", "plays": "play_id", "lineups": "lineup_id", "prices": "snapshot_id"}
DIGEST_POLICIES = {"forward": ("results", "schedules", "prices"), "reconstructed": ("results", "schedules", "plays", "lineups")}


def cite(table: str, df: DataFrame) -> DataFrame:
    """(``evidence_table``, ``evidence_id``) of a table's rows, if evidence may be cited from it."""
    if table not in EVIDENCE_TABLES:
        raise PolicyError(f"no evidence may be cited from {table}")
    return df.select(F.lit(table).alias("evidence_table"), F.col(EVIDENCE_TABLES[table]).cast("string").alias("evidence_id"))


def lane_digest(lane: str, cited: DataFrame) -> DataFrame:
    """One row: rows and an order-free digest of a lane's evidence; rows of other tables are refused."""
    if lane not in DIGEST_POLICIES:
        raise PolicyError(f"unknown lane {lane}")
    allowed = F.col("evidence_table").isin(*DIGEST_POLICIES[lane])
    checked = cited.where(F.when(allowed, True).otherwise(F.raise_error(F.concat(F.col("evidence_table"), F.lit(f" is not of lane {lane}")))))
    return checked.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.xxhash64("evidence_table", "evidence_id").cast("decimal(38,0)")), F.lit(0)).alias("digest"))


#: Tests that a read's optional filters may make.
TESTS = {"equal": lambda c, v: c.isNull() if v is None else c == F.lit(v), "one_of": lambda c, v: c.isin(*v), "at_least": lambda c, v: c >= F.lit(v), "at_most": lambda c, v: c <= F.lit(v), "starts": lambda c, v: F.startswith(c, F.lit(v))}


def filters(wanted: dict[str, dict[str, object]]) -> Column:
    """The conjunction of optional tests (column -> test -> value); a test whose value is left out does not count."""
    out = F.lit(True)
    for name, tests in wanted.items():
        for test, value in tests.items():
            if test not in TESTS:
                raise PolicyError(f"unknown test {test}")
            out = out & TESTS[test](F.col(name), value)
    return out


def conditions(**equal: object) -> Column:
    """The only predicates a read takes: equality with values, or null for ``None``."""
    out = F.lit(True)
    for name, value in equal.items():
        out = out & (F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return out

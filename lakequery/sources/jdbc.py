"""MySQL-, Postgres- and ClickHouse-protocol databases through JDBC.

A reader hands the database one statement per partition. Filters and columns of a later query are
pushed into it; give ``partition`` for any large table, or a single task will read all of it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime
from decimal import Decimal
from itertools import groupby
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Protocol family, driver class and default port of each database.
_FAMILIES = {
    "mysql": ("mysql", "com.mysql.cj.jdbc.Driver", 3306),
    "doris": ("mysql", "com.mysql.cj.jdbc.Driver", 9030),
    "starrocks": ("mysql", "com.mysql.cj.jdbc.Driver", 9030),
    "postgres": ("postgresql", "org.postgresql.Driver", 5432),
    "supabase": ("postgresql", "org.postgresql.Driver", 5432),
    "clickhouse": ("clickhouse", "com.clickhouse.jdbc.ClickHouseDriver", 8123),
}
DATABASES = tuple(_FAMILIES)

# The statement that lists the tables of the current database or schema. A statement
# such as SHOW TABLES cannot be a derived table, so each family's metadata table is read instead.
_TABLE_LISTS = {
    "mysql": "SELECT table_name FROM information_schema.tables WHERE table_schema = DATABASE()",
    "postgresql": (
        "SELECT table_name FROM information_schema.tables WHERE table_schema = current_schema()"
    ),
    "clickhouse": "SELECT name AS table_name FROM system.tables WHERE database = currentDatabase()",
}
FETCH_SIZE = 10_000
# How finely the quantile sketch tells ranks apart: one part in so many per task.
RANKS_PER_TASK = 100


@dataclass(frozen=True)
class Partitioning:
    """How tasks share a statement: ranges of a numeric, date or timestamp column.

    The ranges are equally wide, or with ``even`` hold about as many rows each, whatever the values are; that takes a
    read of the column first. A value with more rows than a range should have then gets a range of its own.
    """

    column: str
    tasks: int
    lower: object | None = None
    upper: object | None = None
    even: bool = False


@dataclass(frozen=True)
class Database:
    """Where a database is and who reads it. ``schema`` applies to the Postgres family."""

    kind: str
    host: str
    database: str = ""
    username: str = ""
    password: str = ""
    port: int | None = None
    schema: str | None = None

    def __post_init__(self):
        if self.kind not in _FAMILIES:
            raise ValueError(f"unknown database: {self.kind} (one of {', '.join(DATABASES)})")

    @property
    def dialect(self) -> str:
        """The encoding that fits this database's values."""
        return {"mysql": "mysql", "postgresql": "postgres", "clickhouse": "json"}[self._family]

    @property
    def tables_sql(self) -> str:
        """A statement whose rows name the tables."""
        return _TABLE_LISTS[self._family]

    @property
    def _family(self) -> str:
        return _FAMILIES[self.kind][0]

    @property
    def url(self) -> str:
        host = self.host.strip().rstrip("/")
        secure = host.startswith("https://")
        host = host.split("://", 1)[-1]
        if host.count(":") > 1 and not host.startswith("["):
            host = f"[{host}]"
        if self.port is not None or ":" not in host.rsplit("]", 1)[-1]:
            host = f"{host.rsplit(':', 1)[0] if _has_port(host) else host}:{self._port}"
        name = quote(self.database.strip(), safe="")
        url = f"jdbc:{self._family}://{host}/{name}"
        if self._family == "mysql":
            # One-bit integers stay numbers, as the protocol delivers them.
            return f"{url}?characterEncoding=UTF-8&tinyInt1isBit=false"
        if self._family == "clickhouse" and secure:
            return f"{url}?ssl=true"
        return url

    @property
    def _port(self) -> int:
        return _FAMILIES[self.kind][2] if self.port is None else self.port

    def options(self, sql: str, partition: Partitioning | None = None) -> dict[str, str]:
        """Options of ``spark.read.format("jdbc")`` for one statement."""
        statement = sql.strip().rstrip(";")
        options = {
            "url": self.url,
            "driver": _FAMILIES[self.kind][1],
            # A derived table, because Spark allows `query` only without a partition column.
            "dbtable": f"({statement}) lakequery",
            "user": self.username,
            "password": self.password,
            "fetchsize": str(FETCH_SIZE),
            # Zoneless timestamps stay zoneless, as their text has no offset.
            "preferTimestampNTZ": "true",
        }
        search_path = (self.schema or "").strip()
        if search_path and self._family == "postgresql":
            literal = search_path.replace("'", "''")
            options["sessionInitStatement"] = f"SELECT set_config('search_path', '{literal}', false)"
        if partition is not None:
            if partition.lower is None or partition.upper is None:
                raise ValueError("partition bounds are missing; read_database can look them up")
            options |= {
                "partitionColumn": partition.column,
                "lowerBound": str(partition.lower),
                "upperBound": str(partition.upper),
                "numPartitions": str(partition.tasks),
            }
        return options


def even_bounds(values: DataFrame, tasks: int) -> list:
    """Quantiles of the one column of ``values`` that cut it into ``tasks`` equal shares, by a mergeable sketch.

    A value that takes up several shares appears as often. Empty where there is no value.
    """
    shares = [k / tasks for k in range(1, tasks)]
    if not shares:
        return []
    sketch = F.percentile_approx(F.col(values.columns[0]), shares, RANKS_PER_TASK * tasks)
    return list(values.agg(sketch).first()[0] or [])


def literal(value: object) -> str:
    """A bound as SQL that every family reads."""
    if isinstance(value, datetime):
        return f"'{value.isoformat(' ')}'"
    if isinstance(value, date):
        return f"'{value.isoformat()}'"
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    raise TypeError(f"a partition column cannot hold {value!r}")


def range_predicates(column: str, bounds: list) -> list[str]:
    """Conditions that share out every row, nulls too, each row to exactly one of them.

    A bound that appears twice or more is a value of many rows, which gets a condition of its own.
    """
    cuts = [(bound, len(list(same)) > 1) for bound, same in groupby(bounds)]
    if not cuts:
        return []
    out = [f"{column} < {literal(cuts[0][0])} OR {column} IS NULL"]
    for (bound, alone), following in zip(cuts, [*cuts[1:], None]):
        low = f"{column} >= {literal(bound)}"
        if alone:
            out.append(f"{column} = {literal(bound)}")
            low = f"{column} > {literal(bound)}"
        out.append(low if following is None else f"{low} AND {column} < {literal(following[0])}")
    return out


def column_sql(sql: str, column: str) -> str:
    """The statement that gives the partition column alone."""
    return f"SELECT {column} FROM ({sql.strip().rstrip(';')}) shared"


def _has_port(host: str) -> bool:
    return host.rsplit("]", 1)[-1].count(":") == 1


def bounds_sql(sql: str, column: str) -> str:
    """The statement whose one row holds the least and greatest value of ``column``."""
    statement = sql.strip().rstrip(";")
    return f"SELECT min({column}) AS lo, max({column}) AS hi FROM ({statement}) bounded"


def read_database(
    spark: SparkSession,
    database: Database,
    sql: str,
    partition: Partitioning | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The result of one statement as a frame; ``limit`` is applied by the database.

    With ``partition.even`` tasks read the column in equally wide ranges once, and its quantiles then cut the
    statement into conditions that the database evaluates. Rows that come meanwhile fall into one of them all the same.

    The statement becomes a derived table, and some databases ignore ORDER BY in one that has no
    LIMIT of its own. A statement whose order decides which rows are first should carry its LIMIT.
    """
    if limit is not None:
        sql = f"SELECT * FROM ({sql.strip().rstrip(';')}) capped LIMIT {int(limit)}"
        partition = None
    if partition is not None and (partition.lower is None or partition.upper is None):
        probe = database.options(bounds_sql(sql, partition.column))
        low, high = spark.read.format("jdbc").options(**probe).load().first()
        if low is None:
            partition = None
        else:
            partition = replace(partition, lower=low, upper=high)
    if partition is not None and partition.even:
        column = spark.read.format("jdbc").options(**database.options(column_sql(sql, partition.column), partition)).load()
        predicates = range_predicates(partition.column, even_bounds(column, partition.tasks))
        if predicates:
            options = database.options(sql)
            return spark.read.jdbc(options.pop("url"), options.pop("dbtable"), predicates=predicates, properties=options)
    return spark.read.format("jdbc").options(**database.options(sql, partition)).load()

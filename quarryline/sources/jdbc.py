"""Database sources: connection options from a catalogue and credentials, and query scans."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarryline.functions.dates import quoted

# Vendor and type as written in plans, and the JDBC dialect they use.
DIALECTS = {
    "Oracle MySQL": "mysql",
    "MariaDB Foundation MariaDB": "mariadb",
    "SAP HANA": "hana",
}

# The vendor and type of a plan entry whose queries run on this Spark session's own tables.
SPARK_TABLES = "Apache Spark"

_DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "mariadb": "org.mariadb.jdbc.Driver",
    "hana": "com.sap.db.jdbc.Driver",
}

DEFAULT_FETCH_SIZE = 10_000

SECRET_KEYS = ("Name", "Username", "Password")


@dataclass(frozen=True)
class Connection:
    dialect: str
    host: str
    port: int
    username: str
    password: str = field(repr=False)
    full_name: str = ""


def lookup(tree: Mapping, path: list[str], what: str) -> Mapping:
    """Walk a nested catalogue; the first level that is missing is named in the error."""
    for level, key in enumerate(path):
        if not isinstance(tree, Mapping) or key not in tree:
            raise ValueError(f'{what} has no entry "{" / ".join(path[: level + 1])}"')
        tree = tree[key]
    return tree


def secret(account: Mapping, key: str) -> str:
    """A credential, taken from an environment variable when the account says it is kept there."""
    value = account[key]
    if account.get("Storage", {}).get(key) == "environment variable":
        if value not in os.environ:
            raise ValueError(f"environment variable {value} for {key} is not set")
        return os.environ[value]
    return value


def resolve_connection(sequence: Mapping, systems: Mapping, credentials: Mapping) -> Connection:
    """Host, port and credentials of a plan entry, from the catalogue and the account list."""
    vendor, kind = sequence["server-vendor"], sequence["server-type"]
    dialect = DIALECTS.get(f"{vendor} {kind}")
    if dialect is None:
        raise ValueError(f"no JDBC dialect for {vendor} {kind}")
    place = [sequence["server-group"], sequence["server-layer"]]
    server = lookup(systems, [vendor, kind, "Server", *place], "the source catalogue")
    account = lookup(credentials, [vendor, kind, *place, sequence["account-label"]], "the credentials")
    for holder, keys, what in ((server, ("ServerName", "ServerPort"), "server"), (account, SECRET_KEYS, "account")):
        absent = [k for k in keys if k not in holder]
        if absent:
            raise ValueError(f"{what} entry lacks {', '.join(absent)}")
    return Connection(
        dialect=dialect,
        host=server["ServerName"],
        port=int(server["ServerPort"]),
        username=secret(account, "Username"),
        password=secret(account, "Password"),
        full_name=secret(account, "Name"),
    )


def jdbc_options(connection: Connection, fetch_size: int = DEFAULT_FETCH_SIZE) -> dict[str, str]:
    """Options of the Spark JDBC source for a connection."""
    address = f"{connection.host}:{connection.port}"
    if connection.dialect == "mysql":
        url = (
            f"jdbc:mysql://{address}/mysql?useCompression=true&characterEncoding=UTF-8"
            "&connectionCollation=utf8mb4_unicode_ci&useCursorFetch=true"
        )
    elif connection.dialect == "mariadb":
        url = f"jdbc:mariadb://{address}/mysql?useCompression=true"
    else:
        url = f"jdbc:sap://{address}/?compress=true&statementCacheSize=10"
    return {
        "url": url,
        "driver": _DRIVERS[connection.dialect],
        "user": connection.username,
        "password": connection.password,
        "fetchsize": str(fetch_size),
    }


def chop_blanks(df: DataFrame) -> DataFrame:
    """Trailing blanks removed from every text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({name: F.rtrim(quoted(name)) for name in texts}) if texts else df


def query_scan(
    spark: SparkSession, query: str, connection: Connection | None = None, split: Mapping | None = None
) -> DataFrame:
    """Run SQL text on the source and read its result.

    Without a connection the text runs on the session's own tables and views. With one it is
    pushed to the database as a whole; ``split`` (column, lower, upper, partitions) turns it into
    a parallel scan. Bounds only steer the split, no row is left out.
    """
    query = query.strip().rstrip(";")
    if connection is None:
        return spark.sql(query)
    reader = spark.read.format("jdbc").options(**jdbc_options(connection))
    if split:
        reader = reader.option("dbtable", f"({query}) AS split_source").options(
            partitionColumn=split["column"],
            lowerBound=split["lower"],
            upperBound=split["upper"],
            numPartitions=split["partitions"],
        )
    else:
        reader = reader.option("query", query)
    frame = reader.load()
    return chop_blanks(frame) if connection.dialect == "hana" else frame

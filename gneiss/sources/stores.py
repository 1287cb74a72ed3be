"""Sinks that take batches of rows over a connection: SQL upserts and a graph store. Connections are made where rows lie."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.operators.graph import ENDS, constraints
from gneiss.schemas import TABLES, VERTICES, ddl

COUNTED = "rows long, batches long"


class Connection(Protocol):
    """A DB-API connection."""

    def cursor(self): ...
    def commit(self) -> None: ...
    def rollback(self) -> None: ...
    def close(self) -> None: ...


class GraphSession(Protocol):
    """Runs a statement with parameters; one call is one transaction."""

    def run(self, statement: str, **parameters) -> object: ...
    def close(self) -> None: ...


def batches_of(rows: Iterator, size: int) -> Iterator[list]:
    while part := list(islice(rows, size)):
        yield part


def upsert_statement(table: str, columns: Sequence[str], key: Sequence[str], keep: Sequence[str] = (), mark: str = "?") -> str:
    """One row in; a row of that key takes the new values, but for `keep`, which only fill what is null."""
    sets = ", ".join(f"{c} = COALESCE({table}.{c}, excluded.{c})" if c in keep else f"{c} = excluded.{c}" for c in columns if c not in key)
    return f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({', '.join([mark] * len(columns))}) ON CONFLICT ({', '.join(key)}) DO UPDATE SET {sets}"


def ensure_table(connect: Callable[[], Connection], table: str, columns, key: tuple[str, ...], indexes: tuple[str, ...] = ()) -> None:
    """Create table and indexes unless they are there."""
    connection = connect()
    try:
        for statement in ddl(table, columns, key, indexes):
            connection.cursor().execute(statement)
        connection.commit()
    finally:
        connection.close()


def _counted(batches: Iterator[pa.RecordBatch], open_: Callable, put: Callable, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of the partition in batches through one connection, opened when the first row comes."""
    rows = (r for b in batches for r in b.to_pylist())
    held, n, done = None, 0, 0
    try:
        for part in batches_of(rows, size):
            held = held or open_()
            put(held, part)
            n, done = n + len(part), done + 1
    finally:
        if held is not None:
            held.close()
    yield pa.record_batch([pa.array([n]), pa.array([done])], names=["rows", "batches"])


def upsert_sql(rows: DataFrame, connect: Callable[[], Connection], table: str, key: tuple[str, ...], *, keep: tuple[str, ...] = (), indexes: tuple[str, ...] = (), batch: int = 500, mark: str = "?", writers: int | None = None) -> int:
    """Upsert rows, one per key, into a SQL table, which is created if need be; each batch is one transaction.

    A task that runs again repeats its upserts, which changes nothing. `connect` is called on the executors and holds the
    credentials; nothing of it is logged. `writers` bounds the connections. Returns the rows written.
    """
    ensure_table(connect, table, rows.schema, key, indexes)
    statement, columns = upsert_statement(table, rows.columns, key, keep, mark), rows.columns

    def put(connection: Connection, part: list[dict]) -> None:
        try:
            connection.cursor().executemany(statement, [tuple(r[c] for c in columns) for r in part])
            connection.commit()
        except Exception:
            connection.rollback()
            raise

    some = rows.coalesce(writers) if writers else rows
    return some.mapInArrow(lambda it: _counted(it, connect, put, batch), COUNTED).agg(F.sum("rows")).first()[0] or 0


def merge_vertices_statement(label: str, key: str) -> str:
    return f"UNWIND $rows AS row MERGE (n:{label} {{{key}: row.{key}}}) SET n += row"


def merge_edges_statement(shape: Sequence[str]) -> str:
    """shape: label and key of the start, type, label and key of the end."""
    a, b, rel, x, y = shape
    return f"UNWIND $rows AS row MATCH (a:{a} {{{b}: row.from_id}}) MATCH (b:{x} {{{y}: row.to_id}}) MERGE (a)-[:{rel}]->(b)"


def ensure_constraints(connect: Callable[[], GraphSession]) -> int:
    session = connect()
    try:
        for statement in constraints():
            session.run(statement)
    finally:
        session.close()
    return len(constraints())


def put_vertices(rows: DataFrame, table: str, connect: Callable[[], GraphSession], batch: int = 500, writers: int | None = None) -> int:
    """Merge vertices, one per key, into a graph store in batches."""
    statement = merge_vertices_statement(*VERTICES[table])
    some = rows.select(*TABLES[table])
    some = some.coalesce(writers) if writers else some
    return some.mapInArrow(lambda it: _counted(it, connect, lambda s, part: s.run(statement, rows=part), batch), COUNTED).agg(F.sum("rows")).first()[0] or 0


def put_edges(rows: DataFrame, connect: Callable[[], GraphSession], batch: int = 500, writers: int | None = None) -> dict[tuple[str, ...], int]:
    """Merge resolved edges into a graph store, shape by shape, as a statement names labels and type. Shapes are few."""
    shape = [c for c in ENDS if c not in ("from_id", "to_id")]
    out = {}
    for r in rows.select(*shape).distinct().collect():
        own = rows
        for c in shape:
            own = own.where(F.col(c) == r[c])
        own = own.select("from_id", "to_id")
        own = own.coalesce(writers) if writers else own
        statement = merge_edges_statement(tuple(r))
        out[tuple(r)] = own.mapInArrow(lambda it, s=statement: _counted(it, connect, lambda c, part: c.run(s, rows=part), batch), COUNTED).agg(F.sum("rows")).first()[0] or 0
    return out

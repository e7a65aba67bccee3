"""Export of rows to an external system, each row once.

The rows go through a data source writer. A task sends its rows in batches to a staging place of its own;
when all tasks have succeeded, the driver publishes the staged rows of the attempts that count, all in
one call. A task that fails discards what it staged and its retry stages anew, so no row is published
twice; if the job fails, nothing is published.

A client needs ``stage(token, rows)``, ``publish(export_id, tokens)``, ``discard(tokens)`` and ``close()``.
Staged rows are kept under their token, in a table beside the target for a database; ``publish`` moves the
rows of all tokens in one transaction and remembers ``export_id``: publishing an export that was published
before discards its rows, so a run that is started again sends nothing twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from itertools import islice
from typing import Callable, Iterator, Optional, Protocol, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tidemark.spec import EXPORT_BATCH_ROWS


class ExportClient(Protocol):
    def stage(self, token: str, rows: Sequence[tuple]) -> None: ...

    def publish(self, export_id: str, tokens: Sequence[str]) -> None: ...

    def discard(self, tokens: Sequence[str]) -> None: ...

    def close(self) -> None: ...


@dataclass
class Staged(WriterCommitMessage):
    """What a task has staged: its token, none if it had no rows."""

    token: Optional[str]


def export_once(df: DataFrame, client_factory: Callable[[], ExportClient], export_id: str, batch_rows: int = EXPORT_BATCH_ROWS) -> None:
    """Send the rows of ``df``; ``export_id`` names what is sent, such as a run and batch."""

    class Writer(DataSourceWriter):
        def write(self, iterator: Iterator[Row]) -> Staged:
            first = next(iterator, None)
            if first is None:
                return Staged(None)
            token, client = f"{export_id}-{uuid.uuid4().hex}", client_factory()
            try:
                rows = [tuple(first), *map(tuple, islice(iterator, batch_rows - 1))]
                while rows:
                    client.stage(token, rows)
                    rows = [tuple(r) for r in islice(iterator, batch_rows)]
            except BaseException:
                client.discard([token])
                raise
            finally:
                client.close()
            return Staged(token)

        def commit(self, messages: list) -> None:
            self._tell(messages, lambda client, tokens: client.publish(export_id, tokens))

        def abort(self, messages: list) -> None:
            self._tell(messages, lambda client, tokens: client.discard(tokens))

        def _tell(self, messages: list, what: Callable) -> None:
            tokens = [m.token for m in messages if m is not None and m.token]
            if tokens:
                client = client_factory()
                try:
                    what(client, tokens)
                finally:
                    client.close()

    class Export(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tidemark_export"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return Writer()

    df.sparkSession.dataSource.register(Export)
    df.write.format("tidemark_export").mode("append").save()

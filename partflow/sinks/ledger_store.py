"""The ledger at rest: append-only parquet tables, one writer per run."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.frames import empty_frame, one_row
from partflow.operators import ledger as algebra
from partflow.operators.keyed import newest_per_key
from partflow.sources.storage import Storage, exists, matching
from partflow.spec import LEDGER_SCHEMAS


#: How long a run may take before the next one of its exporter holds it for broken off.
LEASE = dt.timedelta(hours=24)


@dataclass(frozen=True)
class Run:
    """A started run; its number orders all events it writes."""

    run_id: int
    exporter: str
    started_at: dt.datetime


class Ledger:
    """Tables of upload, error, run and registry events below ``root``.

    Files of older schemas are read beside new ones: a column that they lack is null
    there, as every read names the full schema; one that was narrower (an int for a
    bigint) is widened; one that is not in use any more is left out.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _generation(self) -> int:
        committed = matching(self.spark, f"{self.root}/uploads/generation=*/_SUCCESS")
        numbers = [int(path.rsplit("/", 2)[1].split("=")[1]) for path in committed]
        return max(numbers, default=0)

    def folder(self, table: str) -> str:
        """Where the files of a table lie."""
        # uploads can be replaced as a whole; each replacement is a new directory
        suffix = f"/generation={self._generation():06d}" if table == "uploads" else ""
        return f"{self.root}/{table}{suffix}"

    def events(self, table: str) -> DataFrame:
        """All events of a table."""
        schema = LEDGER_SCHEMAS[table]
        path = self.folder(table)
        if not exists(self.spark, path):
            return empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)

    def _conform(self, table: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in LEDGER_SCHEMAS[table].fields
            ]
        )

    def append(self, table: str, rows: DataFrame) -> None:
        """Add events; columns the rows lack become null."""
        self._conform(table, rows).write.mode("append").parquet(self.folder(table))

    def replace_uploads(self, rows: DataFrame) -> None:
        """Make ``rows`` the whole upload history; the old one stays on disk, unread."""
        conformed = self._conform("uploads", rows)
        conformed.write.parquet(f"{self.root}/uploads/generation={self._generation() + 1:06d}")

    def compact(self, table: str) -> int:
        """Rewrite the files a table has now as few ones of today's schema; returns how many there were.

        Every run appends files of a few rows. All events stay, in their order; rows that
        are wholly alike become one. Files that are appended meanwhile are left as they are.
        The new ones are in place before the old ones go, so a run broken off leaves events
        twice, which no view minds but the listings of errors, until the next compaction. A
        reader that listed the old files just before has to read again.
        """
        storage, root = Storage(self.spark), self.folder(table)
        old = storage.matching(f"{root}/*.parquet")
        if len(old) < 2:
            return len(old)
        staging = f"{self.root}/_compacted-{uuid.uuid4().hex}"
        events = self.spark.read.schema(LEDGER_SCHEMAS[table]).parquet(*old).distinct()
        events.orderBy("event_seq").write.parquet(staging)
        for path in storage.matching(f"{staging}/*.parquet"):
            storage.rename(path, f"{root}/{path.rsplit('/', 1)[1]}")
        for path in old:
            storage.delete(path)
        storage.delete(staging)
        return len(old)

    def uploads(self) -> DataFrame:
        return algebra.current_uploads(self.events("uploads"))

    def errors(self, table: str) -> DataFrame:
        """Open errors of ``upload_errors`` or ``validation_errors``."""
        return algebra.current_errors(self.events(table), self.events("cleared_errors"))

    def failed(self) -> DataFrame:
        return algebra.failed_partitions(
            self.errors("upload_errors"), self.errors("validation_errors"), self.uploads()
        )

    def runs(self) -> DataFrame:
        return algebra.current_runs(self.events("runs"))

    def watermark(self, exporter: str, mode: str = "latest") -> str | None:
        """Source watermark of one exporter, or None."""
        found = algebra.last_watermarks(self.runs().where(F.col("exporter") == exporter), mode).first()
        return found.source_data_watermark if found else None

    def registry_hashes(self) -> DataFrame:
        return self.events("registry_hashes")

    def registry_state(self) -> DataFrame:
        return newest_per_key(self.events("registry_state"), ["source"], ["event_seq"])

    def next_suffix(self, exporter: str, day: str) -> int:
        """Number of the next snapshot of ``day``."""
        mine = self.uploads().where(F.col("exporter") == exporter)
        found = algebra.next_suffixes(mine, day).first()
        return found.next_suffix if found else 1

    def claim_suffix(self, exporter: str, day: str, token: str) -> int:
        """The number of the caller's snapshot of ``day``, claimed before it is written.

        ``token`` names the snapshot (say, by its time): asked again with it, as a repeated
        run does, the number is the same. Runs at the same time get different numbers, and
        none is left out as long as every claim is followed by its snapshot.
        """
        storage, number = Storage(self.spark), 1
        name = "".join(c if c.isalnum() else "-" for c in token)
        while not storage.claim(f"{self.root}/claims/{exporter}/{day}/{number:06d}", name):
            number += 1
        return number

    def start_run(self, exporter: str, now: dt.datetime, lease: dt.timedelta = LEASE) -> Run:
        """Record the start of a run under the next number.

        Earlier runs of the exporter that have not ended ``lease`` after their start are
        closed as failed: their driver died. One that ends after all is as it ended.
        """
        own, abandoned = F.col("exporter") == exporter, F.col("run_started_at") < F.lit(now - lease)
        runs = self.runs().select("run_id", F.when(own & abandoned & (F.col("status") == "running"), F.struct("run_id", "run_started_at")).alias("left"))
        found = runs.agg(F.max("run_id").alias("last"), F.collect_list("left").alias("left")).first()
        for one in sorted(found.left):
            late = f"The run broke off: it has not ended within {lease} of its start"
            old = Run(one.run_id, exporter, one.run_started_at)
            self._record(old, run_completed_at=now, records_fetched=0, records_exported=0, status="failed", error_details=late, event_seq=1)
        run = Run((found.last or 0) + 1, exporter, now)
        self._record(run, status="running", event_seq=0)
        return run

    @contextmanager
    def closing(self, run: Run | None, now: dt.datetime, records_fetched: int = 0) -> Iterator[None]:
        """Close the run (None: a dry run) as failed if what is done here ends with an exception."""
        try:
            yield
        except Exception as error:
            if run is not None:
                self.complete_run(run, now, records_fetched, 0, "failed", f"{type(error).__name__}: {str(error)[:500]}")
            raise

    def complete_run(
        self,
        run: Run,
        now: dt.datetime,
        records_fetched: int,
        records_exported: int,
        status: str = "completed",
        error_details: str | None = None,
        watermark: str | None = None,
    ) -> None:
        """Record the end of a run. Only a completed run sets a watermark."""
        self._record(
            run,
            run_completed_at=now,
            records_fetched=records_fetched,
            records_exported=records_exported,
            status=status,
            error_details=error_details,
            source_data_watermark=watermark if status == "completed" else None,
            event_seq=2,
        )

    def _record(self, run: Run, **values) -> None:
        row = {"run_id": run.run_id, "exporter": run.exporter, "run_started_at": run.started_at, **values}
        self.append("runs", one_row(self.spark, LEDGER_SCHEMAS["runs"], row))

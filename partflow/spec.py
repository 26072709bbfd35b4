"""Dataset definitions and the schemas of everything the package writes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

DAILY = "daily"
EPOCH = "epoch"


@dataclass(frozen=True)
class DatasetSpec:
    """One partitioned dataset and where its truth lives."""

    name: str
    truth_table: str
    slot_column: str
    partition_type: str
    group: str = "dune"

    def __post_init__(self) -> None:
        if self.partition_type not in (DAILY, EPOCH):
            raise ValueError(f"partition type of {self.name!r} must be {DAILY!r} or {EPOCH!r}")

    @property
    def partition_column(self) -> str:
        """Name of the Hive partition column."""
        return "date" if self.partition_type == DAILY else "epoch"


def _spec(name: str, truth: str, slot: str, kind: str) -> DatasetSpec:
    return DatasetSpec(name, truth, slot, kind)


# The standard datasets, their truth tables and slot columns.
STANDARD_DATASETS: tuple[DatasetSpec, ...] = (
    _spec("block", "block", "slot", DAILY),
    _spec("transaction", "transaction", "slot", DAILY),
    _spec("transaction_metadata", "transaction_metadata", "slot", DAILY),
    _spec("transaction_scripts", "transaction_scripts", "slot", DAILY),
    _spec("tx_input", "tx_input", "spent_at_slot", DAILY),
    _spec("assets", "assets", "slot", DAILY),
    _spec("address_utxo", "address_utxo_flattened", "slot", DAILY),
    _spec("voting_procedure", "voting_procedure", "slot", DAILY),
    _spec("gov_action_proposal", "gov_action_proposal", "slot", DAILY),
    _spec("reward", "reward", "earned_epoch", EPOCH),
    _spec("epoch_stake", "epoch_stake", "epoch", EPOCH),
    _spec("gov_action_proposal_status", "gov_action_proposal_status", "epoch", EPOCH),
    _spec("adapot", "adapot", "epoch", EPOCH),
)


def select_datasets(
    specs: Iterable[DatasetSpec],
    names: Iterable[str] | None = None,
    group: str | None = None,
) -> tuple[list[DatasetSpec], list[str]]:
    """Datasets by name, by group, or all of them; unknown names come back second."""
    known = {spec.name: spec for spec in specs}
    if names is not None:
        wanted = list(names)
        return [known[n] for n in wanted if n in known], [n for n in wanted if n not in known]
    return [s for s in known.values() if group is None or s.group == group], []


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def flat_schema(text: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike a DDL text it needs no session."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


REGISTRATION_SCHEMA = flat_schema(
    "drep_id string, drep_hash string, anchor_url string, anchor_hash string,"
    " block bigint, slot bigint, tx_hash string"
)

PROFILE_SCHEMA = flat_schema(
    "drep_id string, drep_hash string, anchor_url string, anchor_hash string, drep_name string,"
    " source_block bigint, source_slot bigint, source_tx_hash string, source_date string,"
    " fetch_status string, http_status int, last_checked_at string, updated_at string"
)

POOL_DATA_SCHEMA = flat_schema(
    "pool_hash string, pool_id string, ticker string, name string, description string, homepage string,"
    " metadata_url string, metadata_hash string, fetched_at timestamp, version int"
)

REGISTRY_SCHEMA = flat_schema(
    "script_hash string, project_name string, contract_name string, category string, sub_category string,"
    " purpose string, language string, fetched_at timestamp, version int"
)

#: Landed answers of a metadata service: one document per request.
RESPONSE_SCHEMA = flat_schema(
    "id string, http_status int, body string, transport_error string, fetched_at timestamp"
)

#: Entries of a manifest, and what it says of an exporter.
MANIFEST_SCHEMA = flat_schema(
    "exporter string, partition_value string, partition_type string, s3_key string, file_name string,"
    " file_size_bytes bigint, last_modified timestamp"
)
MANIFEST_SUMMARY_SCHEMA = flat_schema(
    "exporter string, partition_type string, total_files bigint, total_size_bytes bigint,"
    " earliest_partition string, latest_partition string"
)

#: Ledger tables. ``event_seq`` orders the events of one table; it is the run number.
LEDGER_SCHEMAS: dict[str, T.StructType] = {
    "uploads": flat_schema(
        "exporter string, partition_value string, s3_key string, file_name string, row_count bigint,"
        " min_slot bigint, max_slot bigint, file_size bigint, uploaded_at timestamp, status string,"
        " event_seq bigint"
    ),
    "upload_errors": flat_schema(
        "exporter string, partition_value string, file_path string, file_size bigint,"
        " error_details string, attempts int, created_at timestamp, event_seq bigint"
    ),
    "validation_errors": flat_schema(
        "exporter string, partition_value string, pq_count bigint, pg_count bigint,"
        " pq_min_slot bigint, pq_max_slot bigint, pg_min_slot bigint, pg_max_slot bigint,"
        " error_details string, created_at timestamp, event_seq bigint"
    ),
    "cleared_errors": flat_schema("exporter string, partition_value string, event_seq bigint"),
    "runs": flat_schema(
        "run_id bigint, exporter string, run_started_at timestamp, run_completed_at timestamp,"
        " records_fetched bigint, records_exported bigint, status string, error_details string,"
        " source_data_watermark string, event_seq bigint"
    ),
    "registry_state": flat_schema(
        "source string, last_commit_sha string, last_checked_at timestamp, event_seq bigint"
    ),
    "registry_hashes": flat_schema(
        "script_hash string, source string, first_seen_at timestamp, event_seq bigint"
    ),
}

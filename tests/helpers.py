"""Fixtures written as the datasets are found on disk."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq


def rows(df, *order):
    """Rows of a frame as sorted tuples, columns in the given order."""
    frame = df.select(*order) if order else df
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: tuple("~" if v is None else str(v) for v in r))


def write_partition(base, dataset, directory, columns, name=None, schema=None):
    folder = Path(base) / dataset / directory
    folder.mkdir(parents=True, exist_ok=True)
    value = directory.split("=")[-1]
    marker = "-epoch-" if directory.startswith("epoch=") else "-"
    path = folder / (name or f"{dataset}{marker}{value}.parquet")
    pq.write_table(pa.table(columns, schema=schema), str(path))
    return path


def write_registrations(base, day, entries):
    """``entries``: (drep_id, url, block)."""
    text = pa.string()
    schema = pa.schema(
        [("drep_id", text), ("drep_hash", text), ("anchor_url", text), ("anchor_hash", text),
         ("block", pa.int64()), ("slot", pa.int64()), ("tx_hash", text)]
    )
    columns = {
        "drep_id": [e[0] for e in entries],
        "drep_hash": [f"hash_{e[0]}" for e in entries],
        "anchor_url": [e[1] for e in entries],
        "anchor_hash": [None for _ in entries],
        "block": [e[2] for e in entries],
        "slot": [e[2] * 20 for e in entries],
        "tx_hash": [f"tx_{e[0]}_{e[2]}" for e in entries],
    }
    return write_partition(base, "drep_registration", f"date={day}", columns, schema=schema)


def write_pools(base, day, pools):
    return write_partition(base, "pool_registration", f"date={day}", {"pool_id": pools, "slot": [1] * len(pools)})


def responses(spark, *entries):
    """``entries``: (id, status, body, transport error)."""
    return spark.createDataFrame(
        [(i, s, b, e, None) for i, s, b, e in entries],
        "id string, http_status int, body string, transport_error string, fetched_at timestamp",
    )

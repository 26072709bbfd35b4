import json

import pytest

from partflow.functions.documents import resolve_pools, resolve_profiles
from partflow.operators import registry
from partflow.operators.profile import join_responses

from helpers import responses, rows


def profile_body(given, outer=None, url="https://u"):
    metadata = {"body": {"givenName": given}}
    if outer is not None:
        metadata["givenName"] = outer
    return json.dumps({"url": url, "json_metadata": metadata})


NO_NAME = "no givenName in metadata"


@pytest.mark.parametrize(
    "status, body, transport, name, url, error",
    [
        (200, profile_body("Alice"), None, "Alice", "https://u", None),
        (200, profile_body("  Al \n"), None, "Al", "https://u", None),
        (200, '{"url": "u", "json_metadata": {"givenName": "Top"}}', None, "Top", "u", None),
        (200, profile_body("", "Top"), None, "Top", "https://u", None),
        (200, profile_body(None, "Top"), None, "Top", "https://u", None),
        (200, profile_body(0, "Top"), None, "Top", "https://u", None),
        (200, profile_body(0.0, "Top"), None, "Top", "https://u", None),
        (200, profile_body(False, "Top"), None, "Top", "https://u", None),
        (200, profile_body([], "Top"), None, "Top", "https://u", None),
        (200, profile_body({}, "Top"), None, "Top", "https://u", None),
        (200, profile_body("0", "Top"), None, "0", "https://u", None),
        (200, profile_body(7, "Top"), None, None, "https://u", NO_NAME),
        (200, profile_body(True, "Top"), None, None, "https://u", NO_NAME),
        (200, profile_body(["x"], "Top"), None, None, "https://u", NO_NAME),
        (200, profile_body("  ", "Top"), None, None, "https://u", NO_NAME),
        (200, '{"json_metadata": {"body": "text", "givenName": "Top"}}', None, "Top", "", None),
        (200, '{"json_metadata": "text"}', None, None, "", NO_NAME),
        (200, '{"url": null}', None, None, None, NO_NAME),
        (200, "[1]", None, None, "", "invalid JSON document"),
        (200, "{bad", None, None, "", "invalid JSON document"),
        (404, None, None, None, "", "no metadata"),
        (429, None, None, None, "", "rate limited"),
        (500, None, None, None, "", "HTTP 500"),
        (None, None, "timeout", None, "", "timeout"),
        (None, None, "connection error", None, "", "connection error"),
    ],
)
def test_resolve_profiles(spark, status, body, transport, name, url, error):
    got = resolve_profiles(responses(spark, ("d", status, body, transport))).first()
    assert (got.drep_name, got.anchor_url, got.error) == (name, url, error)
    assert got.success == (name is not None) and got.http_status == status


def test_resolve_pools(spark):
    full = {"pool_id": "pool1", "hex": "d2", "url": "https://m", "hash": "h", "ticker": "T", "name": "N", "homepage": "p"}
    got = resolve_pools(
        responses(
            spark,
            ("a", 200, json.dumps(full), None),
            ("b", 200, json.dumps({"ticker": None, "name": None}), None),
            ("c", 200, json.dumps({"ticker": "", "name": "only"}), None),
            ("d", 404, None, None),
        )
    )
    found = {r.id: r for r in got.collect()}
    assert found["a"].metadata_url == "https://m" and found["a"].metadata_hash == "h" and found["a"].description is None
    assert found["a"].success and found["a"].error is None and found["c"].success
    assert found["b"].error == "no ticker or name in metadata" and found["d"].error == "no metadata"


def test_every_id_gets_one_response(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "drep_id string")
    landed = responses(spark, ("a", 200, "{}", None), ("a", 200, "{}", None), ("z", 200, "{}", None))
    got = join_responses(ids, landed, "drep_id")
    assert rows(got, "drep_id", "http_status", "transport_error") == [("a", 200, None), ("b", None, "no response")]


def files(spark, *contents):
    return spark.createDataFrame([(f"f{i}.json", c) for i, c in enumerate(contents)], "path string, content string")


def test_parse_registries(spark):
    contracts = {"projectName": "P", "category": "DeFi", "contracts": [{"scriptHash": "a", "name": "n", "language": "Plutus"}]}
    got = registry.parse_contracts(files(spark, json.dumps(contracts), "not json", "{bad", "")).collect()
    assert [(r.script_hash, r.project_name, r.language, r.purpose, r.source) for r in got] == [
        ("a", "P", "Plutus", "", "stricahq")
    ]
    scripts = {"dAppName": "D", "scripts": [{"scriptHash": "b", "name": "n", "type": "PlutusV2", "purpose": "spend"}]}
    got = registry.parse_scripts(files(spark, json.dumps(scripts), "{bad")).collect()
    assert [(r.script_hash, r.project_name, r.language) for r in got] == [("b", "D", "PlutusV2")]
    versioned = {"dAppName": "D", "scripts": [{"name": "n", "versions": [{"scriptHash": "c"}, {"scriptHash": "d"}]}, {"name": "m"}]}
    got = registry.parse_versioned_scripts(files(spark, json.dumps(versioned), "")).collect()
    assert [(r.script_hash, r.contract_name) for r in got] == [("c", "n"), ("d", "n")]


def test_sources_rank(spark):
    records = spark.createDataFrame(
        [("a", "crfa_v1", 1), ("a", "stricahq", 2), ("a", "crfa_v2", 3), ("b", "crfa_v1", 4), ("b", "other", 5)],
        "script_hash string, source string, n int",
    )
    assert rows(registry.best_source(records), "script_hash", "n") == [("a", 2), ("b", 4)]
    known = spark.createDataFrame([("a", "crfa_v2")], "script_hash string, source string")
    assert rows(registry.not_outranked(records, known), "n") == [(2,), (3,), (4,), (5,)]


def test_changed_files(spark):
    changes = spark.createDataFrame(
        [
            ("projects/foo.json", "modified"),
            ("projects/bar.json", "added"),
            ("projects/readme.md", "modified"),
            ("other/baz.json", "modified"),
            ("projects/gone.json", "removed"),
        ],
        "filename string, status string",
    )
    assert rows(registry.changed_files(changes, "projects/"), "filename") == [("projects/bar.json",), ("projects/foo.json",)]


def test_revision_plan(spark):
    latest = spark.createDataFrame(
        [("stricahq", "n", True), ("crfa_v2", "same", True), ("crfa_v1", "n", True), ("x", "n", False)],
        "source string, latest_sha string, diff_known boolean",
    )
    state = spark.createDataFrame(
        [("stricahq", "older", 1), ("stricahq", "old", 2), ("crfa_v2", "same", 1), ("x", "old", 1)],
        "source string, last_commit_sha string, event_seq bigint",
    )
    assert rows(registry.revision_plan(latest, state), "source", "mode", "last_sha") == [
        ("crfa_v1", "full", None),
        ("crfa_v2", "skip", "same"),
        ("stricahq", "incremental", "old"),
        ("x", "full", "old"),
    ]

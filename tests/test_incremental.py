"""Loads in parts, ids of equal documents, partial sums, sets that commit
together, and fields that changed type."""

from __future__ import annotations

import json
import os

import pytest
from conftest import write_docs
from pyspark.sql import functions as F
from test_flatten import DOC_A, DOC_B, DOC_C, DOC_D

from crease.operators.numbering import occurrence_numbers
from crease.operators.stats import STATISTICS, merge_partials, production_stats
from crease.plans import incremental
from crease.plans.pipeline import run_pipeline
from crease.sources import commits, documents, drift, sinks


def _variant(k: int) -> dict:
    doc = json.loads(json.dumps(DOC_A))
    doc["info"]["season"] = str(2008 + k % 3)
    doc["info"]["venue"] = f"Ground {k}"
    return doc


def _lines(path, docs) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs) + "\n")


def _rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()), key=repr)


def _tables(spark, root):
    names = ("matches", "balls_by_ball", "quarantine")
    drop = ("processed_at", "source_file")
    out = {n: _rows((df := incremental.read_table(spark, root, n)).drop(*[c for c in drop if c in df.columns])) for n in names}
    return out | {n: _rows(df.select(sorted(df.columns))) for n, df in incremental.read_statistics(spark, root).items()}


FIRST = [_variant(0), _variant(1), DOC_B, DOC_C, _variant(0), "{oops", "123"]
SECOND = [_variant(2), _variant(0), DOC_D, DOC_C, _variant(3), _variant(2), "{oops", "[1,2]"]


def test_two_landings_equal_one_load(spark, tmp_path):
    """Tables, ids of repeated documents and statistics do not depend on the parts."""
    _lines(tmp_path / "parts" / "a.json", FIRST)
    parts = str(tmp_path / "root-parts")
    assert incremental.load_new(spark, str(tmp_path / "parts"), parts) == len(FIRST)
    _lines(tmp_path / "parts" / "b.json", SECOND)
    # the first file could not be read any more: only new files are opened
    (tmp_path / "parts" / "a.json").write_text("this is no longer what was loaded\n")
    os.utime(tmp_path / "parts" / "a.json", (1, 1))
    assert incremental.load_new(spark, str(tmp_path / "parts"), parts) == len(SECOND)
    assert incremental.load_new(spark, str(tmp_path / "parts"), parts) == 0

    _lines(tmp_path / "whole" / "x.json", SECOND[::-1] + FIRST)
    whole = str(tmp_path / "root-whole")
    assert incremental.load_new(spark, str(tmp_path / "whole"), whole) == len(FIRST) + len(SECOND)
    got, want = _tables(spark, parts), _tables(spark, whole)
    assert got == want
    ids = [r["match_id"] for r in incremental.read_table(spark, parts, "matches").collect()]
    assert len(ids) == 11 == len(set(ids)) and sum("-" in i for i in ids) == 4
    assert len(got["quarantine"]) == 4

    # a full rebuild of the statistics from silver says the same
    silver = incremental.read_table(spark, parts, "matches"), incremental.read_table(spark, parts, "balls_by_ball")
    for name, df in production_stats(*silver).items():
        assert _rows(df.select(sorted(df.columns))) == got[name], name


def test_failed_batch_is_replayed_whole(spark, tmp_path, monkeypatch):
    """A load that fails after some parts shows nothing; the next one makes them good."""
    _lines(tmp_path / "in" / "a.json", FIRST)
    root = str(tmp_path / "root")
    incremental.load_new(spark, str(tmp_path / "in"), root)
    before = _tables(spark, root)
    _lines(tmp_path / "in" / "b.json", SECOND)
    written = []

    def failing(df, path, partition_by=None):
        if "partials/team_stats" in path:
            raise OSError("disk is gone")
        written.append(path)
        return sinks.write_parquet(df, path, partition_by)

    monkeypatch.setattr(incremental, "write_parquet", failing)
    with pytest.raises(Exception, match="disk is gone"):
        incremental.load_new(spark, str(tmp_path / "in"), root)
    assert any("balls_by_ball" in p for p in written) and _tables(spark, root) == before
    monkeypatch.undo()
    assert incremental.load_new(spark, str(tmp_path / "in"), root) == len(SECOND)
    _lines(tmp_path / "whole" / "x.json", FIRST + SECOND)
    incremental.load_new(spark, str(tmp_path / "whole"), str(tmp_path / "w"))
    assert _tables(spark, root) == _tables(spark, str(tmp_path / "w"))


def test_nothing_loaded_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert incremental.load_new(spark, str(tmp_path / "in"), str(tmp_path / "root")) == 0


def test_partials_of_disjoint_matches_add_up(spark, tmp_path):
    path = write_docs(tmp_path / "in", {f"{k}.json": _variant(k) for k in range(12)})
    docs = documents.read_match_documents(spark, path).cache()
    from crease.operators.flatten import balls_by_ball, matches_table

    tables = {"matches": matches_table(docs), "balls_by_ball": balls_by_ball(docs)}
    for name, s in STATISTICS.items():
        df = tables[s.of].withColumn("part", F.crc32(F.col("match_id").cast("binary")) % 3)
        parts = [s.partials(df.filter(F.col("part") == k)) for k in range(3)]
        merged = merge_partials(parts[0].unionByName(parts[1]).unionByName(parts[2]), s.keys)
        assert _rows(s.figures(merged)) == _rows(s.figures(s.partials(df))), name


def test_occurrence_numbers_of_a_hot_key(spark):
    """A key with most rows is numbered by several partitions, without gaps."""
    rows = [("hot", k) for k in range(4000)] + [(f"k{k % 50}", k) for k in range(500)]
    df = spark.createDataFrame(rows, "key string, at long").repartition(7)
    start = spark.createDataFrame([("hot", 10), ("k3", 5), ("absent", 9)], "key string, n long")
    got = occurrence_numbers(df, "key", ["at"], start=start).collect()
    by_key = {}
    for r in sorted(got, key=lambda r: r["at"]):
        by_key.setdefault(r["key"], []).append(r["occurrence"])
    for key, numbers in by_key.items():
        first = {"hot": 10, "k3": 5}.get(key, 0)
        assert numbers == list(range(first, first + len(numbers))), key
    assert len(got) == len(rows)


def test_equal_documents_keep_apart_in_any_layout(spark, tmp_path):
    docs = [_variant(k % 4) for k in range(20)]
    ids = []
    for name, files in (("one", [docs]), ("many", [docs[k::5] for k in range(5)])):
        for k, part in enumerate(files):
            _lines(tmp_path / name / f"{k}.json", part)
        read = documents.read_match_documents(spark, str(tmp_path / name), multi_line=False)
        bronze = str(tmp_path / f"bronze-{name}")
        read.write.parquet(bronze)
        ids.append(sorted(r["match_id"] for r in documents.separate_repeats(spark.read.parquet(bronze)).collect()))
    assert ids[0] == ids[1] and len(set(ids[0])) == 20
    assert len({i.split("-")[0] for i in ids[0]}) == 4


def test_json_that_is_no_document_is_set_aside(spark, tmp_path):
    lines = ["123", '"abc"', "[1,2]", "true", "null", "{}", '{"meta": {"revision": 1}}', '{"info": 5}', '{"info": {"season": "2009"}}', '{"innings": "x"}', "{oops"]
    _lines(tmp_path / "in" / "d.json", lines)
    docs = documents.read_match_documents(spark, str(tmp_path / "in"), multi_line=False).cache()
    valid, bad = documents.split_corrupt(docs)
    assert valid.count() == 3  # those with info or innings, whatever these hold
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons.count("unparsable document") == 1 and set(reasons) == {"unparsable document", "no match in the document"}
    assert valid.count() + bad.count() == docs.count()


def test_failed_run_leaves_the_old_set(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    src = write_docs(tmp_path / "in", {"a.json": DOC_A, "b.json": DOC_B})
    assert commits.current_set(spark, root) == {}
    run_pipeline(spark, src, root)
    first = commits.current_set(spark, root)
    before = {n: _rows(df) for n, df in commits.read_set(spark, root).items()}
    assert set(first) == {*STATISTICS, "matches", "balls_by_ball", "quarantine"}
    write_docs(tmp_path / "in", {"e.json": _variant(5)})
    n = []

    def failing(df, path, partition_by=None):
        n.append(path)
        if "/gold/" in path and len([p for p in n if "/gold/" in p]) > 3:
            raise OSError("disk is gone")
        return write(df, path, partition_by)

    write = sinks.write_parquet
    monkeypatch.setattr(sinks, "write_parquet", failing)
    with pytest.raises(OSError, match="disk is gone"):
        run_pipeline(spark, src, root)
    assert commits.current_set(spark, root) == first
    assert {n: _rows(df) for n, df in commits.read_set(spark, root).items()} == before
    monkeypatch.undo()
    run_pipeline(spark, src, root, keep_runs=1)
    after = commits.current_set(spark, root)
    assert set(after) == set(first) and not set(after.values()) & set(first.values())
    assert commits.read_set(spark, root)["matches"].count() == 3
    assert len(os.listdir(f"{root}/runs")) == 1 and commits.latest_commit(spark, root)["seq"] == 2


def test_drift_of_every_kind(spark, tmp_path):
    lines = [
        DOC_A,
        {"info": {"season": 2009, "dates": "2009-01-01", "overs": 20.5, "teams": ["A", "B"], "city": None, "umpires": ["x"], "outcome": []},
         "innings": [{"team": "A", "overs": [{"over": "0", "deliveries": [{"batter": "b", "runs": {"batter": "4", "total": True}, "wickets": [7]}]}, 5]}],
         "meta": "none", "extra": {"deep": 1}},
        "123", "{oops", '{"info": 1}',
    ]
    _lines(tmp_path / "in" / "d.json", lines)
    table = drift.drift_table(drift.read_variants(spark, str(tmp_path / "in")))
    got = {(r["level"], r["field"], r["declared"], r["found"]): r["n_values"] for r in table.collect()}
    assert got == {
        ("info", "dates", "array", "string"): 1,
        ("info", "overs", "long", "number"): 1,
        ("info", "umpires", None, "array"): 1,
        ("info", "outcome", "struct", "array"): 1,
        ("innings.overs", "over", "long", "string"): 1,
        ("innings.overs.deliveries.runs", "batter", "long", "string"): 1,
        ("innings.overs.deliveries.runs", "total", "long", "boolean"): 1,
        ("innings.overs.deliveries.wickets", "[]", "struct", "integer"): 1,
        ("innings.overs", "[]", "struct", "integer"): 1,
        ("", "meta", "struct", "string"): 1,
        ("", "extra", None, "object"): 1,
        ("", "info", "struct", "integer"): 1,
    }
    values = {(r["level"], r["field"]): r["value"] for r in drift.drift_values(drift.read_variants(spark, str(tmp_path / "in"))).collect()}
    assert values["info", "dates"] == '"2009-01-01"' and json.loads(values["", "extra"]) == {"deep": 1}


def test_command_line_load(spark, tmp_path, capsys):
    _lines(tmp_path / "in" / "a.json", FIRST)
    assert incremental.main([str(tmp_path / "in"), str(tmp_path / "root"), "--max-files", "1"]) == len(FIRST)
    assert incremental.main([str(tmp_path / "in"), str(tmp_path / "root")]) == 0
    assert f"{len(FIRST)} documents loaded" in capsys.readouterr().out
    many = write_docs(tmp_path / "one-per-file", {"a.json": DOC_A, "b.json": DOC_B, "x.txt": "no"})
    assert incremental.main([many, str(tmp_path / "root2"), "--multi-line"]) == 2
    assert incremental.read_table(spark, str(tmp_path / "root2"), "balls_by_ball").count() == 4

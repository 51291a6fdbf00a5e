import datetime as dt
import json

from tests.frames import rows_by
from tracklens.sources import issues as source
from tracklens.sources.sinks import write_all, write_results

RECORDS = [
    {"number": 1, "creator": "a", "state": "closed", "labels": ["x"], "title": "t",
     "created_date": "2024-01-01T10:00:00+00:00", "updated_date": "2024-01-02T00:00:00Z",
     "events": [
         {"event_type": "closed", "author": "b", "event_date": "2024-01-05T00:00:00+00:00"},
         {"event_type": "closed", "author": "c", "event_date": "2024-01-03T10:00:00+00:00"},
         {"event_type": "commented", "author": "d", "event_date": "yesterday", "comment": "hi"}]},
    {"number": "x7", "state": "open", "created_date": "10:30", "labels": None},
    {"number": 3, "state": "draft", "created_date": "2024-01-01"},
    {"number": 4, "labels": []},
]


def check(spark, path, **options):
    raw = source.read_raw_issues(spark, path, **options)
    assert sorted(r.number for r in source.rejected_issues(raw).collect()) == ["3", "4"]
    issues = source.read_issues(spark, path, **options)
    rows = rows_by(issues, "number")
    assert set(rows) == {1, -1}
    assert rows[1]["created_date"] == dt.datetime(2024, 1, 1, 10)
    assert rows[-1]["created_date"] is None and rows[-1]["labels"] == rows[-1]["events"] == []
    events = source.issue_events(issues).orderBy("pos").collect()
    assert [(e.issue_number, e.pos, e.author) for e in events] == [(1, 0, "b"), (1, 1, "c"), (1, 2, "d")]
    assert events[2].event_date is None and events[2].comment == "hi"
    nested = rows_by(source.issue_table(issues), "number")
    flat = rows_by(source.issue_table(issues, source.issue_events(issues)), "number")
    assert nested == flat
    assert nested[1]["closure_date"] == dt.datetime(2024, 1, 3, 10)
    assert (nested[1]["resolution_hours"], nested[1]["comment_count"], nested[1]["event_count"]) == (48, 1, 3)
    assert nested[-1]["resolution_hours"] is None and nested[-1]["event_count"] == 0
    assert source.validate_issues(issues).first().asDict() == {
        "issues": 2, "bad_number": 1, "bad_state": 0, "no_created_date": 1, "no_creator": 1,
        "numbers_present": True}


def test_json_array(spark, tmp_path):
    (tmp_path / "issues.json").write_text(json.dumps(RECORDS))
    check(spark, str(tmp_path / "issues.json"))


def test_json_lines(spark, tmp_path):
    (tmp_path / "issues.jsonl").write_text("\n".join(json.dumps(r) for r in RECORDS))
    check(spark, str(tmp_path / "issues.jsonl"), json_lines=True)


def test_one_bad_row_spoils_no_other(spark, tmp_path):
    odd = [dict(RECORDS[0], number={"deep": 1}), RECORDS[0]]
    (tmp_path / "issues.json").write_text(json.dumps(odd))
    assert sorted(r.number for r in source.read_issues(
        spark, str(tmp_path / "issues.json")).collect()) == [-1, 1]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    write_all({"one": df, "two": df.limit(1)}, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/one").count() == 2
    assert spark.read.json(f"{tmp_path}/two").columns == ["k", "v"]
    write_results(df, f"{tmp_path}/p", format="parquet", partition_by=["k"])
    assert spark.read.parquet(f"{tmp_path}/p").filter("k = 2").first().v == "b"


def test_packed_json_lines(spark, tmp_path):
    path, out = tmp_path / "issues.jsonl", f"{tmp_path}/packed"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    write_results(source.read_raw_issues(spark, str(path), json_lines=True), out, compression="gzip")
    assert {f.suffix for f in (tmp_path / "packed").glob("part-*")} == {".gz"}
    check(spark, out, json_lines=True)

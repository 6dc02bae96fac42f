"""Delimited files, batch definitions and audited loads."""

import json

import pytest
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators import flatten, hashtags
from pulsegrid.plans import queries as Q
from pulsegrid.sinks.delimited import write_delimited
from pulsegrid.sinks.load import kind_of_path, load_files
from pulsegrid.sources import batch_config
from pulsegrid.sources.delimited import read_delimited

SF = "/root/testdata/sf0.001"
AWKWARD = ["plain", "a~b", 'say "hi"', "back\\slash", 'mix\\"~"\\', "null", "", None, " lead and trail ", "\\", '"']


def test_roundtrip_of_awkward_texts(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(AWKWARD)], "i string, t string")
    write_delimited(rows.repartition(3), f"{tmp_path}/out")
    back = {r.i: r.t for r in read_delimited(spark, f"{tmp_path}/out", ["i", "t"]).collect()}
    assert back == {str(i): t for i, t in enumerate(AWKWARD)}


def test_load_input_has_a_headed_file_per_partition(spark, tmp_path):
    lines = spark.range(0, 40, 1, 4).select(F.concat(F.lit('"'), "id", F.lit('"~"t"')).alias("value"))
    Q._write_with_headers(lines.filter("value != 'x'"), ["i", "t"], f"{tmp_path}/in")
    files = [p.read_text().splitlines() for p in tmp_path.glob("in/part-*")]
    assert len(files) == 4 and all(f[0] == "i~t" and len(f) == 11 for f in files)
    back = read_delimited(spark, f"{tmp_path}/in", ["i", "t"])
    assert sorted(int(r.i) for r in back.collect()) == list(range(40))


def test_line_format_and_header_per_file(spark, tmp_path):
    rows = spark.createDataFrame([("1", 'a"b\nc', None), ("2", "", "\\")], "x string, y string, z string").repartition(2, "x")
    write_delimited(rows, f"{tmp_path}/out")
    files = [p.read_text() for p in tmp_path.glob("out/part-*") if p.stat().st_size]
    assert all(f.startswith("x~y~z\n") for f in files)
    lines = {line for f in files for line in f.splitlines()[1:]}
    assert lines == {'"1"~"a\\"b c"~', '"2"~""~"\\\\"'}


def test_reads_the_older_dialect(spark, tmp_path):
    # A synthetic row in the shape of the older files: bare null, trailing blank in the header.
    columns = S.wide_status_columns()
    values = {"statusFilterType": "STREAM_TRACKER", "statusOriginalUserFilter": "STREAM_KEYWORD",
              "statusDerivedUserFilter": "(AA) & (BB)", "statusText": 'some \\"quoted\\" text', "statusLang": ""}
    line = "~".join(f'"{values[c]}"' if values.get(c) else values.get(c, "null") for c in columns)
    (tmp_path / "old.txt").write_text("~".join(columns) + " \n" + line + "\n")
    df = read_delimited(spark, str(tmp_path / "old.txt"), columns, compat=True)
    assert df.columns == columns
    (row,) = df.collect()
    assert row.statusText == 'some "quoted" text' and row.statusDerivedUserFilter == "(AA) & (BB)"
    assert row.statusLang == "" and row.statusPlaceName is None and row.statusHashtagEntity is None


def test_definitions(spark, tmp_path):
    one = {"batchRunStartTime": "", "batchCutOffMaxDate": "", "batchName": "B", "batchCutOffMinDate": "07/03/2021-05:06:07",
           "batchTrackStream": "TRUE", "userNames": ",u1,,u2,u3,", "dateFormat": "dd/MM/yyyy-HH:mm:ss",
           "batchRefLevel": "5", "ignored": "x"}
    (tmp_path / "b.json").write_text(json.dumps(one, indent=2))
    definitions = batch_config.read_batch_definitions(spark, str(tmp_path))
    assert [tuple(r) for r in batch_config.watched_users(definitions).orderBy("position").collect()] == [
        ("B", 0, "u1"), ("B", 1, "u2"), ("B", 2, "u3")]
    row = batch_config.batch_settings(definitions).first()
    assert (str(row.cutoff_min), row.cutoff_max, row.start_time, row.track_stream, row.ref_level) == (
        "2021-03-07 05:06:07", None, None, True, 5)


def test_load_is_idempotent_and_retries_empty_files(spark, tmp_path):
    src, table, audit = (f"{tmp_path}/{n}" for n in ("in", "table", "audit"))
    columns = ["a", "b"]
    write_delimited(spark.createDataFrame([("1", "x"), ("2", "y" * 501)], "a string, b string").coalesce(1), f"{src}/one")
    write_delimited(spark.createDataFrame([("3", "z" * 501)], "a string, b string").coalesce(1), f"{src}/bad")
    first = {(r.accepted_rows, r.rejected_rows, r.is_loaded)
             for r in load_files(spark, f"{src}/*", table, audit, columns).collect()}
    assert first == {(1, 1, True), (0, 1, False)}
    again = load_files(spark, f"{src}/*", table, audit, columns).collect()
    assert [(r.accepted_rows, r.is_loaded) for r in again] == [(0, False)]
    assert [(r.a, r.b) for r in spark.read.parquet(table).select("a", "b").collect()] == [("1", "x")]
    assert spark.read.parquet(audit).filter(~F.col("is_loaded")).count() == 2
    rejects = spark.read.parquet(f"{table}-rejects").select("reason", "longest")
    assert sorted(map(tuple, rejects.collect())) == [("field too long", 501)] * 2


def test_equal_names_in_two_folders_are_two_files(spark, tmp_path):
    src, table, audit = (f"{tmp_path}/{n}" for n in ("in", "table", "audit"))
    for folder, value in (("one", "1"), ("two", "2")):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "STATUS-1.txt").write_text(f'a~b\n"{value}"~"x"\n')
        load_files(spark, src, table, audit, ["a", "b"])
    assert sorted(r.a for r in spark.read.parquet(table).collect()) == ["1", "2"]
    assert load_files(spark, src, table, audit, ["a", "b"]).count() == 0


def test_wrong_field_counts_are_rejected(spark, tmp_path):
    src, table, audit = (f"{tmp_path}/{n}" for n in ("in", "table", "audit"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "STATUS.txt").write_text('a~b\n"1"~"x"\n"2"\n"3"~"y"~"z"\n')
    counts = load_files(spark, src, table, audit, ["a", "b"]).first()
    assert (counts.accepted_rows, counts.rejected_rows) == (1, 2)
    rejects = spark.read.parquet(f"{table}-rejects").collect()
    assert sorted(r.row for r in rejects) == ['"2"', '"3"~"y"~"z"']
    assert {r.reason for r in rejects} == {"wrong number of fields"} and all("STATUS.txt" in r.file_name for r in rejects)


def test_routing_by_name():
    assert kind_of_path("out/batch-STATUS-2014") == "STATUS"
    assert kind_of_path("out/batch-USER-2014") == "USER"
    for name in ("out/x-REJECTED-STATUS-1", "out/other"):
        with pytest.raises(ValueError):
            kind_of_path(name)


def test_statuses_through_files_rank_the_same(spark, tmp_path):
    """Landed records -> wide rows -> delimited files -> loaded table -> typed rows -> ranking."""
    flat = Q._flattened(spark, SF)
    wide = flatten.wide_status(hashtags.expand_hashtags(flat))
    write_delimited(wide, f"{tmp_path}/STATUS")
    counts = load_files(spark, f"{tmp_path}/STATUS", f"{tmp_path}/table", f"{tmp_path}/audit").collect()
    assert sum(r.accepted_rows for r in counts) == wide.count()
    loaded = flatten.typed_status(spark.read.parquet(f"{tmp_path}/table"))
    key = ["original_user", "position"]
    want = hashtags.top_hashtags(flat).orderBy(key).collect()
    assert hashtags.top_hashtags(loaded).select(want[0].__fields__).orderBy(key).collect() == want

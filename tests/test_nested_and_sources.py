import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as registry
from snapgrid.operators import clean, nested
from snapgrid.plans import ingest, reports
from snapgrid.schema import LOCATION_RECORD, PORT_ITEM, STATION_ITEM, StagePaths
from snapgrid.session import shared_folder
from snapgrid.sources import sinks, tables
from snapgrid.sources.snapshots import infer_record, read_snapshots

RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("address", T.StructType([T.StructField("code", T.StringType())])),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)


def write(folder, name, value):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")


def test_three_document_shapes(spark, tmp_path):
    folder = tmp_path / "json"
    write(folder, "a.json", {"locations": [{"id": 1, "address": {"code": "é"}, "tags": ["x"]}, {"id": 2}]})
    write(folder, "b.json", [{"id": 3}, {"id": 4}])
    write(folder, "c.json", {"id": 5})
    write(folder, "d.json", {"locations": []})
    got = read_snapshots(spark, str(folder), RECORD)
    assert {(r["source_file"], r["id"]) for r in got.collect()} == {
        ("a.json", 1), ("a.json", 2), ("b.json", 3), ("b.json", 4), ("c.json", 5),
    }
    flat = ingest.convert_snapshots(spark, str(folder), str(tmp_path / "flat"), RECORD)
    one = flat.filter("id = 1").first()
    assert (one["tags"], one["address_code"], one["source_file"]) == ('["x"]', "é", "a.json")


def test_envelope_that_is_no_list_fails(spark, tmp_path):
    write(tmp_path / "bad", "x.json", {"locations": "none"})
    with pytest.raises(Exception, match="no records found"):
        read_snapshots(spark, str(tmp_path / "bad"), RECORD).collect()


@pytest.mark.parametrize("document", ["{broken", '{"locations": null}', '{"locations": {"id": 1}}', '{"other": 1}'])
def test_documents_without_records_fail(spark, tmp_path, document):
    write(tmp_path / "bad", "x.json", document)
    with pytest.raises(Exception, match="no records found"):
        read_snapshots(spark, str(tmp_path / "bad"), RECORD).collect()


def test_field_of_another_type_is_null(spark, tmp_path):
    write(tmp_path / "odd", "x.json", {"locations": [{"id": "x1", "tags": ["a"]}, {"id": 2, "address": {"code": 5}}]})
    got = read_snapshots(spark, str(tmp_path / "odd"), RECORD).collect()
    assert [(r["id"], r["tags"]) for r in got] == [(None, ["a"]), (2, None)]
    assert got[1]["address"]["code"] == "5"


def test_lone_objects_and_quoted_numbers(spark, tmp_path):
    port = {"id": "5", "power_kw": "7.4", "port_status": {"status": "A"}, "authentications": [{"payment_required": True}]}
    station = {"id": 3, "ports": [port, {"id": 6, "port_status": [{"status": "B"}, {"status": "C"}]}]}
    location = {"id": 1, "last_updated": "2024-01-01T00:00:00Z", "opening_hours": {"hour_begin": "8:00"}, "stations": [station]}
    write(tmp_path / "json", "a.json", {"locations": [location]})
    locations = ingest.locations_from_snapshots(spark, str(tmp_path / "json"))
    assert locations.first()["loc_opening_hours_hour_begin"] == "8:00"
    got = ingest.extract_ports(ingest.extract_stations(locations)).orderBy("port_id").collect()
    assert [(r["port_id"], r["port_power_kw"], r["port_status"], r["port_payment_required"]) for r in got] == [
        (5, 7.4, "A", True),
        (6, None, "B", None),
    ]


def test_inferred_record(spark, tmp_path):
    write(tmp_path / "any", "a.json", {"locations": [{"id": 1, "x": {"y": [1, 2]}}], "version": 3})
    write(tmp_path / "any", "b.json", [{"id": 2}])
    found = infer_record(spark, str(tmp_path / "any"))
    got = nested.flatten(read_snapshots(spark, str(tmp_path / "any"), found))
    assert set(map(tuple, got.collect())) == {("a.json", 1, "[1,2]"), ("b.json", 2, None)}


SHAPES = {
    "enveloped": lambda records: [{"locations": records, "exported": "x", "pages": {"of": 3}}],
    "listed": lambda records: [records],
    "lone": lambda records: records,
    "mixed": lambda records: [{"locations": records[:1]}, records[1:2], *records[2:]],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_fields_of_every_document_shape(spark, tmp_path, shape):
    """The same records give the same table in every shape of document; what surrounds an envelope is no field."""
    records = [
        {"id": 1, "network": "A", "operator": None, "x y": {"z.OBJECT<": [1]}},
        {"id": 2, "operator": {"name": "B", "since": 2.5}, "tags": [], "odd": 1},
        {"id": 3, "lone": True, "operator": {"name": "C", "since": 3}, "odd": "1", "empty": {}, "never": None, "big": 2**70},
    ]
    for i, document in enumerate(SHAPES[shape](records)):
        write(tmp_path / "in", f"{i}.json", document)
    flat = nested.flatten(read_snapshots(spark, str(tmp_path / "in"))).drop("source_file")
    own = {f.name: f.dataType.simpleString() for f in flat.schema.fields if f.name in (
        "network", "operator_name", "operator_since", "x y_z.OBJECT<", "tags", "odd", "lone", "empty", "never", "big", "exported", "pages_of"
    )}
    assert own == {
        "network": "string", "operator_name": "string", "operator_since": "double", "x y_z.OBJECT<": "string", "tags": "string",
        "odd": "string", "lone": "boolean", "empty": "string", "never": "string", "big": "decimal(22,0)",
    }
    got = {r["id"]: r.asDict() for r in flat.select("id", *[F.col(f"`{c}`") for c in own]).collect()}
    assert (got[1]["network"], got[1]["x y_z.OBJECT<"], got[1]["operator_name"]) == ("A", "[1]", None)
    assert (got[2]["operator_name"], got[2]["operator_since"], got[2]["odd"], got[2]["tags"]) == ("B", 2.5, "1", "[]")
    assert (got[3]["lone"], got[3]["operator_since"], got[3]["odd"], got[3]["empty"], got[3]["big"]) == (True, 3.0, "1", "{}", 2**70)


def test_inference_refuses_broken_documents(spark, tmp_path):
    write(tmp_path / "in", "a.json", {"id": 1})
    write(tmp_path / "in", "b.json", "{broken")
    with pytest.raises(Exception, match="no JSON document: b.json"):
        infer_record(spark, str(tmp_path / "in"))


def test_a_folder_without_records(spark, tmp_path):
    write(tmp_path / "in", "a.json", {"locations": []})
    assert infer_record(spark, str(tmp_path / "in")).fields == []
    assert read_snapshots(spark, str(tmp_path / "in")).count() == 0


def test_flatten_order_and_types(spark):
    df = spark.sql("select named_struct('b', 1, 'c', named_struct('d', 'x')) as a, array(1, 2) as l, 5 as z")
    flat = nested.flatten(df)
    assert flat.columns == ["l", "z", "a_b", "a_c_d"]
    assert flat.collect() == [("[1,2]", 5, 1, "x")]


def test_unnest_stations_from_text(spark):
    cells = [
        (7, '[{"id": 70, "label": "north", "ports": [{"id": 3}, {"id": 4}], "coordinates": {"latitude": 2.5}}, {"id": 71, "operator": "x"}]'),
        (8, None),
    ]
    df = spark.createDataFrame(cells, "loc_id long, loc_stations string")
    got = [r.asDict() for r in ingest.extract_stations(df).orderBy("st_id").collect()]
    assert got[0] == {
        "st_id": 70, "st_label": "north", "st_notes": None, "st_ports": '[{"id":3},{"id":4}]', "st_more_fields": None,
        "st_location_id": 7,
    }
    assert got[1]["st_id"] == 71 and got[1]["st_more_fields"] == '{"operator":"x"}' and len(got) == 2


def test_unnest_ports_from_text(spark):
    port = {"id": 12, "power_kw": 3.5, "price": 0.4, "port_status": [{"status": "BUSY"}, {"status": "AVAILABLE"}]}
    other = {"id": 13, "connector_type": "CHADEMO", "authentications": {"authentication_id": "CARD", "payment_required": True}}
    df = spark.createDataFrame([(5, 6, json.dumps([port, "no object", other]))], "st_id long, st_location_id long, st_ports string")
    got = [r.asDict() for r in ingest.extract_ports(df).orderBy("port_id").collect()]
    assert [(r["port_id"], r["port_station_id"], r["port_station_location_id"]) for r in got] == [(12, 5, 6), (13, 5, 6)]
    assert got[0]["port_status"] == "BUSY" and got[0]["port_power_kw"] == 3.5 and got[0]["port_more_fields"] == '{"price":0.4}'
    assert got[1]["port_authentication_id"] == "CARD" and got[1]["port_payment_required"] is True
    assert not {"port_authentications", "port_coordinates"} & set(got[0])


def test_source_fields_that_no_schema_names(spark, tmp_path):
    port = {"id": 1, "port_status": [{"status": "AVAILABLE"}], "price": {"kwh": 0.5}}
    station = {"id": 10, "operator": "acme", "ports": [port]}
    place = {"id": 100, "last_updated": "2024-01-01T00:00:00Z", "network": "n1", "access": {"public": True}, "stations": [station]}
    (tmp_path / "a.json").write_text(json.dumps({"locations": [place, {"id": 101, "stations": []}]}))
    locations = ingest.locations_from_snapshots(spark, str(tmp_path))
    assert {"loc_network", "loc_access_public"} <= set(locations.columns)
    stations = ingest.extract_stations(locations)
    assert stations.first()["st_operator"] == "acme"
    ports = ingest.extract_ports(stations)
    row = ports.first()
    assert row["port_price.kwh"] == 0.5 and row["port_status"] == "AVAILABLE" and row["port_station_id"] == 10


@pytest.mark.parametrize(
    "status, want",
    [
        ('[{"status": "A"}, {"status": "B"}]', "A"),
        ("[]", None),
        ('{"status": "A"}', "A"),
        ('"[{\\"status\\": \\"A\\"}]"', "A"),
        ("null", None),
        ("3", None),
        ('[7, {"status": "B"}]', None),
    ],
)
def test_first_object_of_any_shape(spark, status, want):
    df = spark.createDataFrame([(1, 2, f'[{{"id": 1, "port_status": {status}}}]')], "st_id long, st_location_id long, st_ports string")
    assert ingest.extract_ports(df).first()["port_status"] == want


def test_bad_items_are_skipped(spark):
    child = T.StructType([T.StructField("id", T.LongType())])
    cells = ['[1, {"id": 2}, null, "x", [3]]', '{"id": 9}', "not json", None, "[]"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "p int, c string")
    assert [tuple(r) for r in nested.unnest(df, "c", child, ["p"]).collect()] == [(2, 0)]


def test_parent_wins_and_objects_flatten(spark):
    child = T.StructType(
        [
            T.StructField("p", T.LongType()),
            T.StructField("o", T.StructType([T.StructField("x", T.StructType([T.StructField("y", T.IntegerType())]))])),
        ]
    )
    df = spark.createDataFrame([(7, '[{"p": 1, "o": {"x": {"y": 5}}}]')], "p long, c string")
    got = nested.unnest(df, "c", child, ["p"])
    assert got.columns == ["o.x.y", "p"] and got.collect() == [(5, 7)]


def test_text_and_typed_paths_agree(spark):
    cell = '[{"id": 1, "notes": "n", "ports": [{"id": 5, "port_status": [{"status": "A"}, {"status": "B"}]}, {"id": 6}]}]'
    text = spark.createDataFrame([(10, cell)], "loc_id long, loc_stations string")
    typed = text.select("loc_id", F.from_json("loc_stations", T.ArrayType(STATION_ITEM)).alias("loc_stations"))
    a = ingest.extract_ports(ingest.extract_stations(text))
    assert a.filter("port_more_fields is not null").isEmpty()
    a = a.drop("port_more_fields")
    b = ingest.extract_ports(ingest.extract_stations(typed))
    assert a.columns == b.columns and sorted(a.collect()) == sorted(b.collect()) and a.count() == 2


def test_opening_hours(spark):
    cells = ['[{"weekday_begin": 1, "hour_begin": "8:00"}, {"weekday_begin": 6}]', '{"hour_end": "20:00"}', None, "[]", "{bad", "[5]"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, opening_hours string")
    got = nested.opening_hours(df).orderBy("i")
    assert got.columns == ["i"] + [f"opening_hours_{f}" for f in ("weekday_begin", "weekday_end", "hour_begin", "hour_end")]
    assert [tuple(r)[1:] for r in got.collect()] == [
        ("1", None, "8:00", None),
        (None, None, None, "20:00"),
        *[(None,) * 4] * 4,
    ]
    assert nested.unreadable_hours(df).first()[0] == 2
    assert nested.opening_hours(df.drop("opening_hours")).columns == ["i"]


def csv(folder, name, header, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


def test_file_selection_and_checked_union(spark, tmp_path):
    raw = tmp_path / "raw"
    csv(raw, "2022_01.csv", "id,name", "1,a")
    csv(raw, "2023_01.csv", "name,id", '"b, ""q""",2')
    csv(raw, "2024_01.csv", "other", "1")
    picked = tables.list_files(spark, str(raw), "*.csv", ("2022_", "2023_"))
    assert [p.rsplit("/", 1)[1] for p in picked] == ["2022_01.csv", "2023_01.csv"]
    got = tables.read_checked(spark, picked)
    assert got.columns == ["id", "name"] and set(map(tuple, got.collect())) == {("1", "a"), ("2", 'b, "q"')}
    with pytest.raises(FileNotFoundError):
        tables.list_files(spark, str(raw), "*.csv", ("1999_",))
    with pytest.raises(ValueError, match=r"missing \['id', 'name'\], unexpected \['other'\]"):
        tables.read_checked(spark, tables.list_files(spark, str(raw), "*.csv"))


def test_raw_profile_by_file(spark, tmp_path):
    raw = tmp_path / "raw"
    csv(raw, "2022_01_loc.csv", "id,name", "1,", "2,b")
    csv(raw, "2023_01_loc.csv", "id,name", "3,c")
    found = reports.raw_profile(tables.read_csv(spark, str(raw), line_breaks=False))
    assert set(map(tuple, found["shape"].collect())) == {("2022_01_loc", 2, 2, "2022_01"), ("2023_01_loc", 1, 2, "2023_01")}
    nulls = {(r["file"], r["column"]): r["nulls"] for r in found["nulls"].collect()}
    assert nulls[("2022_01_loc", "name")] == 1 and sum(nulls.values()) == 1


def test_location_consolidation(spark, tmp_path):
    raw, hours = tmp_path / "raw", tmp_path / "hours"
    header = "id,opening_hours_weekday_begin,opening_hours_weekday_end,opening_hours_hour_begin,opening_hours_hour_end"
    csv(raw, "2022_01.csv", header, "1,,,8:00,", "1,,,8:00,")
    csv(raw, "2024_01.csv", "id,opening_hours", '1,"[{""hour_begin"": ""8:00""}]"', '2,"[{""hour_begin"": ""9:00""}]"')
    csv(raw, "2025_01.csv", "opening_hours,id", '"{""hour_begin"": ""7:00""}",3')
    written = ingest.derive_opening_hours(spark, str(raw), str(hours))
    assert {(r["source_file"], r["id"]) for r in written.collect()} == {
        ("2024_01.csv", "1"), ("2024_01.csv", "2"), ("2025_01.csv", "3"),
    }
    got = ingest.consolidate_locations(spark, str(raw), written)
    assert {(r["loc_id"], r["loc_opening_hours_hour_begin"]) for r in got.collect()} == {("1", "8:00"), ("2", "9:00"), ("3", "7:00")}
    assert got.count() == 3
    with pytest.raises(ValueError, match="unexpected"):
        ingest.consolidate_locations(spark, str(raw), written.withColumn("more", F.lit(1)))
    csv(tmp_path / "plain", "a.csv", "id", "1")
    with pytest.raises(FileNotFoundError):
        ingest.tables_with_hours(spark, str(tmp_path / "plain"))


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_last_in_file_order(spark, tmp_path, monkeypatch, broadcast):
    """The file's order decides between rows of one version, not their values; files go by name, copies count once."""
    monkeypatch.setattr(tables, "BROADCAST_BLOCKS", broadcast)
    raw, hours = tmp_path / "raw", tmp_path / "hours"
    header = "id,last_updated,name"
    csv(raw, "2023_b.csv", header, "1,2024-01-01T00:00:00Z,a", "2,2024-01-01T00:00:00Z,y", "3,2024-01-01T00:00:00Z,q")
    csv(raw, "2022_a.csv", header, "1,2024-01-01T00:00:00Z,z", "2,2024-01-01T00:00:00Z,z", "3,2024-01-01T00:00:00Z,q", "4,x,b", "4,x,a")
    picked = tables.list_files(spark, str(raw), "*.csv", ("2022_", "2023_"))
    read = tables.read_checked(spark, picked, place="place").orderBy("place").collect()
    assert [(r["id"], r["name"]) for r in read] == [("1", "z"), ("2", "z"), ("3", "q"), ("4", "b"), ("4", "a"), ("1", "a"), ("2", "y"), ("3", "q")]
    csv(hours, "x.csv", header, "2,2024-01-01T00:00:00Z,d")
    later = tables.read_checked(spark, [str(hours)], place="place").withColumn("source_file", F.lit("x.csv"))
    got = clean.clean_locations(ingest.consolidate_locations(spark, str(raw), later))
    assert {(r["loc_id"], r["loc_name"]) for r in got.collect()} == {("1", "a"), ("2", "d"), ("3", "q"), ("4", "a")}
    assert "loc_place" not in got.columns


def test_last_record_in_document_order(spark, tmp_path):
    def record(i, v):
        return {"id": i, "last_updated": "2024-01-01T00:00:00Z", "onstreet_location": "true", "address": {"postal_code": v}}

    write(tmp_path / "in", "b.json", [record(1, "a"), record(2, "y"), record(2, "c")])
    write(tmp_path / "in", "a.json", {"locations": [record(1, "z"), record(2, "x")]})
    write(tmp_path / "in", "c.json", record(3, "k"))
    read = ingest.locations_from_snapshots(spark, str(tmp_path / "in"))
    ordered = [(r["loc_id"], r["loc_address_postal_code"]) for r in read.orderBy("loc_place").collect()]
    assert ordered == [(1, "z"), (2, "x"), (1, "a"), (2, "y"), (2, "c"), (3, "k")]
    got = clean.clean_locations(read).collect()
    assert {(r["loc_id"], r["loc_address_postal_code"]) for r in got} == {(1, "a"), (2, "c"), (3, "k")}


def test_locations_of_documents_and_tables(spark, tmp_path):
    """Documents are converted, nested hours derived, all tables consolidated; without tables the types stay."""
    paths = StagePaths(str(tmp_path))
    (tmp_path / "raw").mkdir()
    stations = [{"id": 11, "ports": [{"id": 5}]}]
    record = {"id": 1, "last_updated": "2024-01-01T00:00:00Z", "opening_hours": [{"hour_begin": "8:00"}], "stations": stations}
    write(tmp_path / "raw" / "json", "2025_01.json", {"locations": [record, {**record, "id": 2}, record]})
    typed = ingest.locations(spark, paths)
    assert dict(typed.dtypes)["loc_id"] == "bigint" and dict(typed.dtypes)["loc_stations"].startswith("array")
    assert [(r["loc_id"], r["loc_opening_hours_hour_begin"]) for r in typed.orderBy("loc_place").collect()] == [(1, "8:00"), (2, "8:00")]
    assert spark.read.parquet(paths.path("converted")).count() == 3
    before = {r["st_id"] for r in ingest.extract_stations(typed).collect()}
    # The same columns as CSV: one table of an early year, one whose hours are still nested.
    columns = [c.removeprefix("loc_") for c in typed.columns if c != "loc_place"]
    plain = [c for c in columns if not c.startswith("opening_hours")]
    cell = {"id": "3", "stations": '"[{""id"": 12}]"', "opening_hours_hour_begin": "9:00", "opening_hours": '"[{""hour_begin"": ""7:00""}]"'}
    csv(tmp_path / "raw" / "tables", "2022_01.csv", ",".join(columns), ",".join(cell.get(c, "") for c in columns))
    nested_columns = [*plain, "opening_hours"]
    csv(tmp_path / "raw" / "tables", "2024_01.csv", ",".join(nested_columns), ",".join({**cell, "id": "4"}.get(c, "") for c in nested_columns))
    csv(tmp_path / "raw" / "tables", "2019_01.csv", "other", "1")
    got = ingest.locations(spark, paths).orderBy("loc_place").collect()
    assert [(r["loc_id"], r["loc_opening_hours_hour_begin"]) for r in got] == [("3", "9:00"), ("4", "7:00"), ("1", "8:00"), ("2", "8:00")]
    locations = sinks.write_table(ingest.locations(spark, paths), paths.path("locations"))
    assert {r["st_id"] for r in ingest.extract_stations(locations).collect()} == before | {12}
    assert {r["port_id"] for r in ingest.extract_ports(ingest.extract_stations(locations)).collect()} == {5}


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    """A plain file is split into tasks; one whose cells hold line breaks, or a stray quote, is read in one piece."""
    raw = tmp_path / "raw"
    rows = [f'{i},"a ""{i}"", b"' for i in range(4_000)]
    csv(raw, "plain.csv", "id,name", *rows)
    csv(raw, "broken.csv", "id,name", *rows[:100], '7,"two\nlines"', "8,end")
    csv(raw, "stray.csv", "id,name", '9,5" pipe')
    found = {r["path"].rsplit("/", 1)[1]: r["breaks"] for r in tables.breaks_by_file(spark, str(raw)).collect()}
    assert found == {"plain.csv": False, "broken.csv": True, "stray.csv": True}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        groups = tables.file_groups(spark, tables.list_files(spark, str(raw), "*.csv"))
        assert [(g.line_breaks, [p.rsplit("/", 1)[1] for p in g.paths]) for g in groups] == [(True, ["broken.csv", "stray.csv"]), (False, ["plain.csv"])]
        assert tables.read_group(spark, groups[1]).rdd.getNumPartitions() > 3
        got = tables.read_checked(spark, [p for g in groups for p in g.paths], place="place").orderBy("place").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    plain = [(str(i), f'a "{i}", b') for i in range(4_000)]
    assert [(r["id"], r["name"]) for r in got[:102]] == [*plain[:100], ("7", "two\nlines"), ("8", "end")]
    assert [(r["id"], r["name"]) for r in got[102:4_102]] == plain
    assert tables.read_csv(spark, str(raw / "plain.csv")).rdd.getNumPartitions() >= 1


def test_stage_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01T00:00:00Z", 5), (2, "soon", 6)], "a int, ts string, b int")
    path = str(tmp_path / "stage")
    with pytest.raises(FileNotFoundError):
        tables.read_stage(spark, path)
    df.toPandas().to_csv(f"{path}.csv", index=False)
    assert tables.read_stage(spark, path, ts="ts").count() == 1
    sinks.write_table(df, path)
    assert tables.read_stage(spark, path, ["b"]).columns == ["b"]
    assert "ReadSchema: struct<a:int>" in tables.read_stage(spark, path, ["a"])._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(KeyError):
        tables.read_stage(spark, path, ["zz"])
    with pytest.raises(Exception, match="invalid timestamp"):
        tables.read_stage(spark, path, ts="ts", bad_ts="fail").collect()


def test_daily_coverage_needs_times(spark, tmp_path):
    spark.createDataFrame([("soon",)], "snapshot_ts string").write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no valid values"):
        reports.daily_coverage(spark, str(tmp_path / "t"))


def test_sinks(spark, tmp_path):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("t"))
    assert sinks.write_counted(df, str(tmp_path / "t"), "k") == (10, 3)
    with pytest.raises(ValueError):
        sinks.write_counted(df.limit(0), str(tmp_path / "e"), "k")
    sinks.write_csv(df.filter("k = 0"), str(tmp_path / "c"), sort=["t"])
    back = tables.read_csv(spark, str(tmp_path / "c"))
    assert sorted(r["t"] for r in back.collect())[1] == "1970-01-01T00:00:03.000000Z"
    changed = sinks.rewrite_table(spark, str(tmp_path / "t"), str(tmp_path / "u"), lambda d: d.drop("t"))
    assert changed.columns == ["k"]
    with pytest.raises(ValueError):
        sinks.rewrite_table(spark, str(tmp_path / "t"), str(tmp_path / "t"), lambda d: d)


def test_default_schemas_match(spark):
    assert {f.name for f in LOCATION_RECORD.fields} >= {"id", "stations", "opening_hours", "last_updated"}
    assert {f.name for f in PORT_ITEM.fields} >= {"port_status", "authentications", "power_kw"}


def test_exported_names_are_safe(spark, tmp_path):
    df = spark.range(3)
    found = reports.export_tables({"a/b c": df, "a:b c": df.limit(1), "plain-1": df}, str(tmp_path))
    assert sorted(p.rsplit("/", 1)[1] for p in found.values()) == ["a_b_c", "a_b_c_2", "plain-1"]
    assert [tables.read_csv(spark, found[n]).count() for n in ("a/b c", "a:b c", "plain-1")] == [3, 1, 3]


def test_numbers_read_as_text_do_not_reread_the_file(spark, tmp_path):
    """a document is read once for each pass, however many of its numbers are read as text."""
    write(tmp_path / "in", "a.json", [{"id": i, "address": {"code": i * 1.10}} for i in range(2000)])
    size = (tmp_path / "in" / "a.json").stat().st_size
    seen = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    before = seen.getLong("bytesRead")
    rows = read_snapshots(spark, str(tmp_path / "in"), RECORD).collect()
    assert seen.getLong("bytesRead") - before < 10 * size
    assert {r["id"]: r["address"]["code"] for r in rows} == {i: repr(i * 1.10) for i in range(2000)}


@pytest.mark.parametrize("ending", ["", "\n", "\r\n\n"])
def test_documents_over_several_lines(spark, tmp_path, ending):
    """A file is one document whatever its line breaks; empty files hold no records."""
    write(tmp_path / "in", "a.json", json.dumps([{"id": 1, "tags": ["x"]}, {"id": 2}], indent=2) + ending)
    write(tmp_path / "in", "b.json", json.dumps({"locations": [{"id": 3}]}, indent=2) + ending)
    write(tmp_path / "in", "c.json", "")
    assert sorted(r["id"] for r in read_snapshots(spark, str(tmp_path / "in"), RECORD).collect()) == [1, 2, 3]


def documents_written(spark, name):
    return {str(p): json.loads(p.read_text()) for p in Path(shared_folder(spark)).glob(f"{name}-*/*.txt")}


def records_in(document):
    return document.get("locations", [document]) if isinstance(document, dict) else document


@pytest.mark.parametrize("query, name", [("snapshot_chain", "chain"), ("json_mixed_shapes", "documents")])
def test_more_rows_are_more_documents(spark, tmp_path, monkeypatch, query, name):
    """customers and suppliers of one nation are dealt over documents."""
    monkeypatch.setattr(registry, "DOCUMENT_ROWS", 10)
    n = F.col("id")
    ids = spark.range(200)
    made = {
        "customer": ids.select(n.alias("c_custkey"), F.lit("c").alias("c_name"), F.lit(7).alias("c_nationkey"), F.lit(1.5).alias("c_acctbal")),
        "supplier": ids.select(n.alias("s_suppkey"), F.lit("s").alias("s_name"), F.lit(7).alias("s_nationkey")),
        "nation": spark.range(2).select(n.cast("int").alias("n_nationkey"), F.lit("n").alias("n_name"), F.lit(0).alias("n_regionkey")),
        "orders": ids.select((n + 1000).alias("o_orderkey"), n.alias("o_custkey")),
        "lineitem": ids.select(
            (n + 1000).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
            F.lit(2.0).alias("l_quantity"),
        ),
    }
    for table, rows in made.items():
        rows.write.parquet(str(tmp_path / f"{table}.parquet"))
    earlier = documents_written(spark, name)
    rows = registry.queries()[query](spark, str(tmp_path)).count()
    documents = [d for path, d in documents_written(spark, name).items() if path not in earlier]
    assert rows == (200 if query == "snapshot_chain" else 402)
    assert max(len(records_in(d)) for d in documents) <= 15


def test_place_of_written_lines(spark, tmp_path):
    """lines are numbered by block, without a window over the lines of a file."""
    path = str(tmp_path / "lines")
    spark.range(3000, numPartitions=3).write.option("header", True).csv(path)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = registry.written_order(spark, path)
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert sorted((r["place"], int(r["id"])) for r in rows) == [(i + 1, i) for i in range(3000)]
    assert "row_number" not in found._jdf.queryExecution().executedPlan().toString()

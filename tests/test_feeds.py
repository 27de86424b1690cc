"""Feeds whose files differ, and JSON that a parser would read past."""

import json

import pytest
from helpers import values

from freightmill.contracts import CARRIERS, TELEMATICS
from freightmill.operators.enrich import split_feed
from freightmill.sources.files import _first_lines, conform, read_csv_text, read_json_text
from freightmill.sources.json_records import array_records, line_records

SOUND = [
    ('{"a": 1}', {"a": "1"}),
    ('  {"a": 1.50, "n": {"x": [1, 2.50], "x": 3}, "z": null, "t": true} ',
     {"a": "1.50", "n": '{"x":[1,2.50],"x":3}', "z": None, "t": "true"}),
    ('{"a": 12345678901234567890.1234567890, "b": 1e400, "c": -0.0}',
     {"a": "12345678901234567890.1234567890", "b": "1e400", "c": "-0.0"}),
    ('{"s": "1.5 \\"quoted, 2\\" {", "u": "\\u00e9", "e": "", "7": "7"}',
     {"s": '1.5 "quoted, 2" {', "u": "é", "e": "", "7": "7"}),
    ("{}", {}),
    ('{"a": "' + 'x\\"1' * 100_000 + '"}', {"a": 'x"1' * 100_000}),
]
FLAWED = [
    ('{"a":1}{"a":2}', "text after the record"),
    ('{"a":1} x', "text after the record"),
    ('{"a":1},{"a":2}', "text after the record"),
    ('{"a":1}],[{"a":2}', "text after the record"),
    ('{"a":1}}', "text after the record"),
    ('{"a":1, "b":2, "a":1}', "repeated field"),
    ("null", "not an object"),
    ("[1]", "not an object"),
    ('"{\\"a\\":1}"', "not an object"),
    ('{"a":', "broken JSON"),
    ('{"a":01}', "broken JSON"),
    ('{"a":NaN}', "broken JSON"),
    ("{'a':1}", "broken JSON"),
    ('{"a":"x\ty"}', "broken JSON"),
]


def texts(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_every_json_line_is_read_or_refused_whole(spark):
    lines = [t for t, _ in SOUND] + [t for t, _ in FLAWED] + ["", " \t"]
    rows = {r.value: r for r in line_records(texts(spark, lines)).collect()}
    assert len(rows) == len(SOUND) + len(FLAWED)
    for text, record in SOUND:
        assert (rows[text].record, rows[text].flaw, rows[text].flawed_text) == (record, None, None)
    for text, flaw in FLAWED:
        assert (rows[text].record, rows[text].flaw, rows[text].flawed_text) == (None, flaw, text)


def test_every_array_element_is_read_or_refused_whole(spark):
    sound = "[" + ",\n".join(t for t, _ in SOUND) + "]"
    mixed = '[{"a":1.50}, null, 5, "x", "{\\"a\\":1}", [2.50], {"a":2,"a":3.0}]'
    alone = {
        '[{"a":1}] x': "text after the record",
        '[{"a":1}][{"a":2}]': "text after the record",
        '[{"a":1},]': "broken JSON",
        '[{"a":1}': "broken JSON",
        '{"a":1}': "not an array",
        "null": "not an array",
    }
    found = array_records(texts(spark, [sound, mixed, "[]", " ", *alone])).collect()
    assert [r.record for r in found if r.value == sound] == [record for _, record in SOUND]
    assert [(r.record, r.flaw, r.flawed_text) for r in found if r.value == mixed] == [
        ({"a": "1.50"}, None, None),
        (None, "not an object", "null"),
        (None, "not an object", "5"),
        (None, "not an object", "x"),
        (None, "not an object", '{"a":1}'),
        (None, "not an object", "[2.50]"),
        (None, "repeated field", '{"a":2,"a":3.0}'),
    ]
    rest = {r.value: (r.flaw, r.flawed_text) for r in found if r.value not in (sound, mixed)}
    assert rest == {text: (flaw, text) for text, flaw in alone.items()}


@pytest.mark.parametrize("array_document", [False, True])
def test_landed_is_accepted_and_quarantined(spark, tmp_path, array_document):
    good = {
        "telematics_id": "T1", "vehicle_id": "V", "timestamp": "2024-03-01T05:00:00Z",
        "speed_kmh": 1.0, "fuel_consumption_l_100km": 2.0, "engine_temp_celsius": 3.0,
        "idle_minutes_today": 4, "maintenance_alert_flag": 0, "gps_latitude": 5.125,
        "gps_longitude": 6.0,
    }
    text = json.dumps(good)
    twice = text.replace('"speed_kmh": 1.0', '"speed_kmh": 1.0, "speed_kmh": 9.0')
    path = tmp_path / "fleet.json"
    if array_document:
        path.write_text(f"[{text}, null, {twice}, 7]")
    else:
        path.write_text("\n".join([text, f"{text}{text}", f"{text} tail", twice, "null", '{"a":']))
    feed = read_json_text(spark, str(path), TELEMATICS, array_document)
    accepted, refused = split_feed(feed, TELEMATICS)
    assert values(accepted, "telematics_id", "gps_latitude") == [("T1", 5.125)]
    assert accepted.count() + refused.count() == feed.count() == (4 if array_document else 6)
    reasons = [r[0] for r in values(refused, "_reason")]
    if array_document:
        assert reasons == [
            "malformed record: not an object", "malformed record: not an object",
            "malformed record: repeated field",
        ]
        kept = {json.dumps(json.loads(r[0])) for r in values(refused, "_corrupt_record")}
        assert kept == {"null", "7", json.dumps(json.loads(twice))}
    else:
        assert reasons == [
            "malformed record", "malformed record: not an object",
            "malformed record: repeated field", "malformed record: text after the record",
            "malformed record: text after the record",
        ]
        assert {r[0] for r in values(refused, "_corrupt_record")} == {
            f"{text}{text}", f"{text} tail", twice, "null", '{"a":'
        }


def test_many_files_with_three_headers(spark, tmp_path):
    folder = tmp_path / "carriers.csv"
    (folder / "deeper").mkdir(parents=True)
    headers = ["carrier_id,transport_mode", "transport_mode,fleet,carrier_id", '"carrier_id"']
    rows = ["C{k},Road", "Sea,7,C{k}", '"C{k}"']
    for k in range(600):
        place = folder / "deeper" if k % 2 else folder
        blank = "\n" if k % 5 == 0 else ""
        text = f"{blank}{headers[k % 3]}\n{rows[k % 3].format(k=k)}\n"
        (place / f"f{k}.csv").write_text(text)
    (folder / "empty.csv").write_text("")
    context = spark.sparkContext
    context.setJobGroup("headers", "headers of many files")
    try:
        assert [len(f) for f in _first_lines(spark, str(folder), True).values()] == [200] * 3
        assert len(context.statusTracker().getJobIdsForGroup("headers")) <= 2
        feed = read_csv_text(spark, str(folder))
        # Spark lists the files of each of the three scans in a job of its own.
        assert len(context.statusTracker().getJobIdsForGroup("headers")) <= 2 + 2 + 3
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # Three headers are three scans, however many files there are.
    scans = feed._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert scans == 3
    typed = conform(feed, CARRIERS)
    assert sorted(r[0] for r in typed.select("carrier_id").collect()) == sorted(
        f"C{k}" for k in range(600)
    )
    counts = {r[0]: r[1] for r in typed.groupBy("transport_mode").count().collect()}
    assert counts == {"Road": 200, "Sea": 200, None: 200}
    assert typed.where("fleet = '7'").count() == 200


def test_headers_that_need_care(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("﻿carrier_id,transport_mode\r\nC1,Road\r\n".encode())
    assert values(read_csv_text(spark, f"{tmp_path}/bom.csv"), "carrier_id", "transport_mode") == [
        ("C1", "Road")
    ]
    (tmp_path / "again.csv").write_text("carrier_id,,x,x\nC1,a,b,c\n")
    again = read_csv_text(spark, f"{tmp_path}/again.csv")
    assert values(again, "carrier_id", "_c1", "x2", "x3") == [("C1", "a", "b", "c")]
    (tmp_path / "none.csv").write_text("\n")
    nothing = conform(read_csv_text(spark, f"{tmp_path}/none.csv"), CARRIERS)
    assert nothing.count() == 0 and set(CARRIERS.columns) < set(nothing.columns)
    (tmp_path / "folder").mkdir()
    with pytest.raises(FileNotFoundError):
        read_csv_text(spark, f"{tmp_path}/folder")
    (tmp_path / "odd.csv").write_text('carrier_id\nC1\n"C2\n')
    with pytest.raises(ValueError, match="multi_line.*odd.csv"):
        read_csv_text(spark, f"{tmp_path}/odd.csv")

"""Large JSON arrays are read by many tasks; damaged elements land as unreadable records, their neighbours as rows."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimloom import jobs
from claimloom.sources import arrays, landing

FIELDS = landing.EVENT_FIELDS["lookups"]


def event(i, **changes):
    return {"id": f"l{i}", "claim_id": None, "ndc": "001", "partner": "P", "channel": "web", "timestamp": "2026-01-02"} | changes


def read(spark, tmp_path, text, name="a.json"):
    directory = tmp_path / "in"
    directory.mkdir(exist_ok=True)
    (directory / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return arrays.read_arrays(spark, str(directory), landing.event_schema("lookups"), str(tmp_path / "spool"))


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 2000 bytes, so that small files are cut as large ones are."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    events = [event(i, partner=f"p{i % 7}", channel="} , {" if i % 1000 == 0 else "web") for i in range(200_000)]
    text = json.dumps(events)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        found = read(spark, tmp_path, text)
        tasks = found.where("_corrupt_record is null").select(F.spark_partition_id().alias("p")).distinct().count()
        whole = landing.read_events(spark, "lookups", str(tmp_path / "in"))
        assert tasks > 4 and whole.rdd.getNumPartitions() == 1
        assert found.where("_corrupt_record is not null").count() == 0
        assert found.count() == 200_000
        assert found.select(FIELDS).exceptAll(whole.select(FIELDS)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("indent", [None, 2])
def test_braces_in_strings_and_inner_objects_over_a_cut(spark, tmp_path, small_ranges, indent):
    odd = ['a},{"id":"x"},{b', "{}", "},{" * 300, '\\"}', "}\n{", "[{}]", "é}{€"]
    events = [event(i, partner=odd[i % len(odd)], channel={"inner": {"deep": "}"}} if i % 5 == 0 else "web") for i in range(60)]
    events += [{}, {"other": 1}, event(99)]
    found = read(spark, tmp_path, json.dumps(events, indent=indent, ensure_ascii=False))
    whole = landing.read_events(spark, "lookups", str(tmp_path / "in"))
    assert found.where("_corrupt_record is not null").count() == 0
    tight = whole.withColumn("channel", F.when(F.col("channel") != "web", F.replace("channel", F.lit(": "), F.lit(":"))).otherwise(F.col("channel")))
    tight = tight.withColumn("channel", F.regexp_replace("channel", r"[\s]+", ""))
    assert rows(found, *FIELDS) == rows(tight, *FIELDS)


DAMAGED = [
    '{"id": "x, "ndc": "1"}',
    '{"id": "x", "ndc": }',
    '{"id" "x"}',
    '{"id": "x", "ndc": "1"',
    "17",
    '"text"',
    "{'id': 'x'}",
    '{"id": "x", "ndc": "}',
]


@pytest.mark.parametrize("damaged", DAMAGED)
def test_a_damaged_element_is_a_row_and_its_neighbours_are_kept(spark, tmp_path, small_ranges, damaged):
    before, after = [json.dumps(event(i)) for i in range(30)], [json.dumps(event(i)) for i in range(30, 60)]
    text = "[" + ",\n".join([*before, damaged, *after]) + "]\n"
    found = read(spark, tmp_path, text).cache()
    bad = found.where("_corrupt_record is not null").collect()
    kept = {r.id for r in found.where("_corrupt_record is null").collect()}
    # The element behind a damaged one without its end is in the same piece, and so in the same record.
    assert {f"l{i}" for i in range(60)} - kept <= {"l30"}
    assert len(bad) == 1 and bad[0]["_corrupt_record"].startswith(damaged.rstrip("}"))
    assert text.encode()[bad[0]["_corrupt_at"] :].decode().lstrip(",\n ").startswith(damaged)
    assert "l30" in kept or '"l30"' in bad[0]["_corrupt_record"]
    assert bad[0]["_source_file"].endswith("a.json") and bad[0]["id"] is None


@pytest.mark.parametrize("ending", ["", ', "ndc": "00', ', "price": 12'])
def test_a_file_that_is_cut_off(spark, tmp_path, small_ranges, ending):
    text = json.dumps([event(i) for i in range(40)])[:-1] + ', {"id": "cut"' + ending
    found = read(spark, tmp_path, text).cache()
    assert found.where("_corrupt_record is null").count() == 40
    assert [r["_corrupt_record"] for r in found.where("_corrupt_record is not null").collect()] == ['{"id": "cut"' + ending]


def test_other_shapes_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in {"a": "[]", "b": "", "c": " [ \n ] ", "d": json.dumps(event(1)), "e": "﻿[" + json.dumps(event(2)) + "]",
                       "f": json.dumps(event(3)) + "\n" + json.dumps(event(4)) + "\n"}.items():
        (tmp_path / "in" / f"{name}.json").write_text(text)
    found = read(spark, tmp_path, json.dumps([event(5)]).encode() + b"\xff", "g.json")
    assert rows(found.where("_corrupt_record is null"), "id") == [(f"l{i}",) for i in range(1, 6)]
    assert found.where("_corrupt_record is not null").count() == 1


def test_a_file_that_is_damaged_from_end_to_end(spark, tmp_path, small_ranges, monkeypatch):
    monkeypatch.setattr(arrays, "MAX_PIECES", 10)
    found = read(spark, tmp_path, "[" + ",".join(["{id: x}"] * 95) + "]")
    bad = [r["_corrupt_record"] for r in found.collect()]
    assert len(bad) == 95 and set(bad) == {"{id: x}"}
    found = read(spark, tmp_path, '[{"id": "x' + "}" * 95)
    lengths = [len(r["_corrupt_record"]) for r in found.collect()]
    assert sum(lengths) == len('{"id": "x' + "}" * 95) and len(lengths) == 10


def test_unreadable_records_reach_the_quarantine(spark, tmp_path):
    sources = {
        "claims": [{"id": "c1", "npi": "1", "ndc": "001", "price": 10, "quantity": 1, "pbm_fee": 1, "timestamp": "2026-01-01"}],
        "reverts": [],
        "lookups": [event(i, claim_id="c1") for i in range(5)],
    }
    for source, events in sources.items():
        (tmp_path / source).mkdir()
        (tmp_path / source / "a.json").write_text(json.dumps(events))
    (tmp_path / "lookups" / "b.json").write_text('[{"id": "broken", "ndc": nothing}, ' + json.dumps(event(7)) + "]")
    (tmp_path / "sites.csv").write_text("npi,chain\n1,x\n")
    (tmp_path / "terms.csv").write_text("partner,fee_cents,fee_percentage\nP,10,\n")
    (tmp_path / "prices.csv").write_text(",".join(landing.PRICE_HEADERS) + "\n")
    paths = {s: str(tmp_path / s) for s in sources}
    paths |= {"pharmacies": str(tmp_path / "sites.csv"), "partners": str(tmp_path / "terms.csv"), "price_history": str(tmp_path / "prices.csv")}
    root = str(tmp_path / "root")
    assert jobs.land(spark, paths, root)["lookups"] == 7
    wh = jobs.build(spark, root)
    assert [tuple(r) for r in wh.dq_rejects.select("source_table", "reject_reason", "defect_class", "raw_payload").collect()] == [
        ("lookups", "unreadable_record", "malformed", '{"id": "broken", "ndc": nothing}')
    ]
    assert wh.fct_lookup.count() == 6

"""Unreadable input is never lost silently: pages, JSON files and CSV lines."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from footfall.functions.messages import decode_page
from footfall.sources.counts import read_counts_csv, read_counts_json, split_counts_csv, split_counts_json
from footfall.sources.messages import decode_pages, page_rejects

R1, R2 = '{"id":"1","year":2020}', '{"id":"2","year":"2021"}'
PAGES = {
    f"[{R1},{R2}]": ["1", "2"], f" [ {R1} , {R2} ] \n": ["1", "2"], "[]": [], " [ ] ": [], "[{}]": [None],
    '[{"id":"1","id":"2"}]': ["2"], '[{"id":5,"x":[1,{"y":2}]}]': ["5"], '[{"id":"]"},{"id":"],["}]': ["]", "],["], '[{"id":"é\\u00e9"}]': ["éé"],
    '[{"id":"1"},{"id":"2","ye': None, f"[{R1},{R2}": None, f"[{R1},]": None, f"[{R1}] junk": None, f"[{R1}]]": None, f"[{R1}][{R2}]": None,
    f"[{R1}],[{R2}]": None, f"[{R1}]],[[{R2}]": None, f'[{R1}],[{{"id":"0"}}]],[[{R2}]': None, "[null]": None, f"[{R1},null]": None, "[1]": None, f"[{R1},5]": None,
    f"[[{R1}]]": None, "junk": None, "{}": None, R1: None, "": None, "null": None, "['a']": None, "[{'id':'1'}]": None, None: None,
}


def test_every_kind_of_page(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(PAGES)], "i int, t string")
    got = {r["i"]: r["ids"] for r in df.select("i", F.transform(decode_page("t"), lambda x: x["id"]).alias("ids")).collect()}
    assert [got[i] for i in range(len(PAGES))] == list(PAGES.values())


def test_a_page_of_150_megabytes(spark, tmp_path):
    rec = '{"id":"7","sensor_name":"' + "x" * 985 + '"}'
    (tmp_path / "page").write_text("[" + (rec + ",") * 150_000 + rec + "]")
    df = spark.read.text(str(tmp_path / "page"))
    assert df.select(F.length("value")).first()[0] > 150_000_000
    assert decode_pages(df, malformed="raise").filter("id = '7'").count() == 150_001
    assert decode_pages(df.select(F.expr("substring(value, 1, length(value) - 1)").alias("value")), malformed="reject").count() == 0


def test_pages_are_parsed_once(spark):
    df = spark.createDataFrame([("[]",)], "value string")
    for malformed in ("raise", "reject"):
        plan = decode_pages(df, malformed=malformed)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1 and "parse_json" not in plan


def test_rejected_pages_keep_their_provenance(spark):
    df = spark.createDataFrame([(t, "t", 0, i) for i, t in enumerate(PAGES)], "value string, topic string, partition int, offset long")
    bad = [i for i, ids in enumerate(PAGES.values()) if ids is None]
    assert sorted(r.offset for r in page_rejects(df).collect()) == bad
    assert decode_pages(df, malformed="reject").count() == sum(len(v) for v in PAGES.values() if v)


def write(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text)
    return str(folder)


def test_truncated_json_file(spark, tmp_path):
    path = write(tmp_path / "json", good=f"[{R1},\n{R2}]\n", torn='[{"id":"3"},\n{"id":"4","ye', two=f"[{R1}][{R2}]", one=R1, blank=" \n", empty="")
    with pytest.raises(Exception, match="malformed record in .*t(orn|wo)"):
        read_counts_json(spark, path).collect()
    assert sorted(r.id for r in read_counts_json(spark, path, malformed="reject").collect()) == ["1", "1", "2"]
    counts, rejects = split_counts_json(spark, path)
    assert sorted((r.id, r.year) for r in counts.collect()) == [("1", 2020), ("1", 2020), ("2", 2021)]
    found = {r["file"].rsplit("/", 1)[1]: r["text"] for r in rejects.collect()}
    assert found == {"torn": '[{"id":"3"},\n{"id":"4","ye', "two": f"[{R1}][{R2}]"}
    single = str(tmp_path / "json" / "torn")
    with pytest.raises(Exception, match="malformed record"):
        read_counts_json(spark, single).collect()


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "lines", a=f"[{R1},{R2}]\n\n{R1}\n" + '[{"id":"3"\n', b=json.dumps([{"id": 9}]) + "\n")
    with pytest.raises(Exception, match="malformed record in .*/a"):
        read_counts_json(spark, path, multi_line=False).collect()
    counts, rejects = split_counts_json(spark, path, multi_line=False)
    assert sorted(r.id for r in counts.collect()) == ["1", "1", "2", "9"]
    assert [r["text"] for r in rejects.collect()] == ['[{"id":"3"']


HEADER = "ID,Date_Time,Year,Month,Mdate,Day,Time,Sensor_ID,Sensor_Name,Hourly_Counts\n"


@pytest.mark.parametrize("infer", [False, True])
def test_csv_lines(spark, tmp_path, infer):
    good = '1,"May 01, 2020 01:00:00 PM",2020,May,1,Friday,13,7,"a, b",5\n'
    path = write(tmp_path / "csv", a=HEADER + good + "2,torn\n", b=HEADER + good.replace("1,", "3,", 1) + "4" + ",x" * 12 + "\n")
    with pytest.raises(Exception, match="malformed record in .*/[ab]"):
        read_counts_csv(spark, path, infer).collect()
    with pytest.raises(Exception, match="malformed record"):  # whatever is selected
        read_counts_csv(spark, path, infer).select("id").collect()
    assert read_counts_csv(spark, path, infer, malformed="reject").select("id").count() == 2
    counts, rejects = split_counts_csv(spark, path, infer)
    assert sorted((r.id, r.sensor_name, r.hourly_counts) for r in counts.collect()) == [("1", "a, b", 5), ("3", "a, b", 5)]
    assert sorted(r["text"] for r in rejects.collect()) == ["2,torn", "4" + ",x" * 12]
    with pytest.raises(ValueError, match="malformed"):
        read_counts_csv(spark, path, malformed="skip")


def test_a_split_keeps_of_rejects_only_their_text(spark, tmp_path, monkeypatch):
    from footfall.sources import counts as C

    good, torn = '1,"May 01, 2020 01:00:00 PM",2020,May,1,Friday,13,7,"a, b",5', "2,torn"
    path = write(tmp_path / "a b", f=HEADER + good + "\n" + torn + "\n")
    monkeypatch.setattr(C, "shared_dir", lambda spark, name: str(tmp_path / name))
    counts, rejects = split_counts_csv(spark, path)
    kept = spark.read.parquet(str(tmp_path / "csv-read"))
    assert not list((tmp_path / "csv-read").glob("rejected=*"))  # folders per flag cost a sort
    assert kept.filter("rejected").select("id", "text").collect() == [(None, torn)]
    named = spark.read.text(path).select("_metadata.file_path").distinct().collect()[0][0]
    assert [tuple(r) for r in rejects.collect()] == [(named, torn)] and counts.count() == 1


def test_file_rejects_encodes_each_page_once(spark, tmp_path, monkeypatch):
    from footfall.plans import io

    spark.sql("select id as event_id, timestamp_ntz'2020-05-01 13:00:00' as ts, id % 3 as user_id, 'a' as event_type, 1.5D as value from range(0, 1200, 1, 1)").write.parquet(str(tmp_path / "events.parquet"))
    spark.sql("select id as l_orderkey, 1 as l_linenumber, timestamp_ntz'2020-05-01 00:00:00' as l_shipdate, 7L as l_suppkey, 2.0D as l_quantity from range(5)").write.parquet(str(tmp_path / "lineitem.parquet"))
    made, encode = spark.sparkContext.accumulator(0), io.encode_pages

    def counted(*args, **kw):
        def note(batches):
            for b in batches:
                made.add(b.num_rows)
                yield b

        pages = encode(*args, **kw)
        return pages.mapInArrow(note, pages.schema)

    monkeypatch.setattr(io, "encode_pages", counted)
    assert sorted(tuple(r) for r in io.file_rejects(spark, str(tmp_path)).collect()) == [("csv", 5, True), ("json", 1200, True)]
    assert made.value == 3

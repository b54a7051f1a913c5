"""Landing of CSV extracts: splittable with quoted line breaks, in file order, malformed records set aside and counted."""

import csv
import io
import random

import pytest

from quotaloom.plans import jobs
from quotaloom.sources import landing, versions
from quotaloom.sources.schemas import RAW_COLUMNS, RAW_FILES

HEADER = RAW_COLUMNS["products"]


def land(spark, folder, text, split=None):
    """(good rows in order, rejected texts, partitions of the scan) of a products extract."""
    (folder / RAW_FILES["products"]).write_bytes(text.encode())
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split or was))
    try:
        records = landing.read_records(spark, str(folder), "products")
        rows = sorted(records.collect(), key=lambda r: tuple(r._seq))
        n = landing._lines(spark, str(folder / RAW_FILES["products"])).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    return [r[: len(HEADER)] for r in rows if r[landing.REJECTED] is None], [r[landing.REJECTED] for r in rows if r[landing.REJECTED] is not None], n


def written(rows, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(HEADER)
    w.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("odd", [[], ["two\nlines"], ["a\r\nb", 'say ""\n", "x', "\n\n\n", '"', ",\n,"]])
def test_many_splits_give_the_rows_of_one(spark, tmp_path, end, odd):
    draw = random.Random(len(odd))
    plain = ["plain", 'in "quotes"', "with, comma", "x" * 40]
    rows = [(f"P{i}", draw.choice(plain + odd), "cat", str(i), "1") for i in range(600)]
    good, bad, n = land(spark, tmp_path, written(rows, end), split=1500)
    assert n > 8 and bad == []
    assert good == rows


def test_a_record_over_several_splits(spark, tmp_path):
    long = "\n".join(f'line {i} "" , "quoted"' for i in range(500))
    rows = [("P1", "a", "c", "1", "1"), ("P2", long, "c", "2", "1"), ("P3", "b\nb", "c", "3", "1")]
    good, bad, n = land(spark, tmp_path, written(rows), split=700)
    assert n > 5 and (good, bad) == (rows, [])


@pytest.mark.parametrize("breaks", ["", 'P0,"one\ntwo",c,1,1\n'])
def test_malformed_records_are_set_aside(spark, tmp_path, breaks):
    body = 'P1,short\nP2,5" pipe,c,2,1\nP3,too,many,3,1,9\n,,,,\nP4,fine,c,4,1\n'
    good, bad, _ = land(spark, tmp_path, ",".join(HEADER) + "\n" + breaks + body, split=40)
    assert bad == ["P1,short", "P3,too,many,3,1,9"]
    assert [r[0] for r in good] == (["P0"] if breaks else []) + ["P2", None, "P4"]
    assert good[-3][1] == '5" pipe'


def test_an_open_quote_rejects_one_record(spark, tmp_path):
    good, bad, _ = land(spark, tmp_path, ",".join(HEADER) + '\nP1,a,c,1,1\nP2,"never closed,c,2,1\nP3,b,c,3,1\n')
    assert [r[0] for r in good] == ["P1"] and bad == ['P2,"never closed,c,2,1\nP3,b,c,3,1']


def test_header_only(spark, tmp_path):
    assert land(spark, tmp_path, ",".join(HEADER) + "\n")[:2] == ([], [])


def test_refresh_counts_and_keeps_rejects(spark, tmp_path):
    raw, dst = tmp_path / "raw", str(tmp_path / "wh")
    jobs.extract_job(spark, "/root/testdata/sf0.001", str(raw))
    late = raw / RAW_FILES["campaigns"] / "part-99999.csv"
    late.write_text(",".join(RAW_COLUMNS["campaigns"]) + "\nC900,only two\nC901,Campaign X,a,surplus\n")
    dq = {r.label: r for r in jobs.etl_job(spark, str(raw), dst, kind="extracts").collect()}
    assert (dq["campaigns"].rejected, dq["reps"].rejected) == (2, 0)
    assert dq["campaigns"].rows_in == dq["campaigns"].rows_out + dq["campaigns"].dropped == 7
    version = versions.current(spark, dst)
    kept = versions.read_rejected(spark, dst, version, "campaigns")
    assert sorted(r.record for r in kept.collect()) == ["C900,only two", "C901,Campaign X,a,surplus"]
    assert versions.read_rejected(spark, dst, version, "reps") is None

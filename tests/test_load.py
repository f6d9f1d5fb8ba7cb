"""Loads past bad lines, and tables laid out by range."""

from __future__ import annotations

import datetime as dt
import glob

import extracts
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from schoolyard.sources import load
from schoolyard.sources.load import LoadRejected, load_csv
from schoolyard.sources.raw import raw_schema, read_csv
from schoolyard.sources.tables import Store

TAGS = "support_ticket_tag"
BAD = {
    "3": "too few values",
    "4,x,y": "too many values",
    '5,"open': "open quote",
    '10,"x,y",z': "too many values",
}
GOOD = ["1,a", '2,"a, ""b"" c"', "7,", '8,""', '11," pad "', "12, lead", ","]


def _parts(tmp_path, **files):
    folder = tmp_path / f"{TAGS}.csv"
    folder.mkdir()
    for name, lines in files.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(tmp_path)


def test_bad_lines_land_in_rejects_with_file_and_text(spark, tmp_path):
    good = [f"{i},t{i}" for i in range(100, 300)]
    folder = _parts(tmp_path, one=["ticket_id,tag", *GOOD, *BAD], two=['﻿"ticket_id","tag"', "", *good])
    store = Store(spark, f"{tmp_path}/out")
    got = load_csv(spark, folder, TAGS, store, max_rejected_share=0.05)
    rejects = {r.line: (r.file.split("/")[-1], r.reason) for r in got.rejects.collect()}
    assert rejects == {line: ("one.csv", why) for line, why in BAD.items()}
    report = {r.file.split("/")[-1]: tuple(r)[1:] for r in got.report.collect()}
    assert report == {"one.csv": (1, len(GOOD) + len(BAD), len(GOOD), 1, 1, 2), "two.csv": (1, 200, 200, 0, 0, 0)}
    assert got.rows.schema == raw_schema(TAGS)
    # what is read is what a scan of the good lines gives
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / f"{TAGS}.csv").write_text("\n".join(["ticket_id,tag", *GOOD, *good]) + "\n")
    want = read_csv(spark, str(tmp_path / "plain"), TAGS)
    assert sorted(map(str, got.rows.collect())) == sorted(map(str, want.collect()))


def test_too_many_bad_lines_leave_the_table_before(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/out")
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "c").mkdir()
    load_csv(spark, _parts(tmp_path / "a", one=["ticket_id,tag", "1,a"]), TAGS, store)
    with pytest.raises(LoadRejected, match="1 of 2"):
        load_csv(spark, _parts(tmp_path / "b", one=["ticket_id,tag", "2,b", "3"]), TAGS, store)
    assert [tuple(r) for r in store.read("raw", TAGS).collect()] == [("1", "a")]
    assert [r.line for r in store.read("raw", f"{TAGS}__rejects").collect()] == ["3"]
    with pytest.raises(LoadRejected, match="no header"):  # moved columns
        load_csv(spark, _parts(tmp_path / "c", one=["tag,ticket_id", "a,1"]), TAGS, store, 1.0)
    with pytest.raises(AnalysisException):
        load_csv(spark, f"{tmp_path}/none", TAGS, store)


def test_an_extract_without_rows_is_an_empty_table(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/out")
    got = load_csv(spark, _parts(tmp_path, one=["ticket_id,tag"]), TAGS, store)
    assert got.rows.count() == got.rejects.count() == 0
    assert [tuple(r)[1:] for r in got.report.collect()] == [(1, 0, 0, 0, 0, 0)]


def test_loaded_extracts_are_what_a_scan_gives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "RAW_TABLES", ("crm_account", "support_ticket", TAGS))
    (tmp_path / "csv").mkdir()
    extracts.write(str(tmp_path / "csv"))
    raw = load.load_all(spark, str(tmp_path / "csv"), Store(spark, f"{tmp_path}/out"))
    for table, df in raw.items():
        want = read_csv(spark, str(tmp_path / "csv"), table)
        assert sorted(map(str, df.collect())) == sorted(map(str, want.collect())), table


# -- layout -----------------------------------------------------------------


def _orders(spark, rows=24_000, schools=300):
    """Six months; a third of all orders are of one school."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.xxhash64("id") % schools)
    month = F.add_months(F.lit(dt.date(2024, 1, 1)), (F.xxhash64("id", F.lit(1)) % 3 + 2).cast("int"))
    month = F.when(F.col("id") % 50 != 1, month)
    return spark.range(rows).select(
        "id", F.md5(hot.cast("string")).alias("school_id"), F.lit("x").alias("note"), month.alias("m")
    )


def _files(path, school):
    """Files of a table, those whose footer admits the school, and the rows of the largest."""
    every = glob.glob(f"{path}/m=*/*.parquet")
    met, largest = 0, 0
    for file in every:
        footer = pq.read_metadata(file)
        largest = max(largest, footer.num_rows)
        at = footer.schema.names.index("school_id")
        stats = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
        met += any(s.min <= school <= s.max for s in stats)
    return len(every), met, largest


def test_a_filter_on_one_school_meets_few_files(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/t")
    df = _orders(spark)
    store.replace_months(df, "curated", "o", "m", "school_id")
    want = sorted(map(tuple, df.collect()), key=str)
    got = store.cluster_months("curated", "o", "m", "school_id", file_rows=500)
    assert sorted(map(tuple, got.select(*df.columns).collect()), key=str) == want
    school = df.filter("id % 3 <> 0").groupBy("school_id").count().orderBy("school_id").collect()[100][0]
    path = f"{tmp_path}/t/curated/o"
    months = df.select("m").distinct().count()
    n, met, largest = _files(path, school)
    assert n >= 48 and met <= 2 * months and largest < 1_500
    one = got.filter(F.col("school_id") == school)
    n_found = len(one.collect())
    assert 0 < n_found == df.filter(F.col("school_id") == school).count()
    leaf = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().apply("numOutputRows").value() < df.count() / 4
    # the hot school is dealt over files instead of making one large
    hot = df.filter("id = 0").first().school_id
    assert _files(path, hot)[1] > 10
    # some months only, rows without one among them
    again = store.cluster_months("curated", "o", "m", "school_id", [None], file_rows=100)
    assert sorted(map(tuple, again.select(*df.columns).collect()), key=str) == want
    assert _files(path, school)[0] > n


def test_clustering_cut_short_leaves_the_table_whole(spark, tmp_path, monkeypatch):
    store = Store(spark, f"{tmp_path}/t")
    df = _orders(spark, 300)
    store.replace_months(df, "curated", "o", "m", "school_id")

    class Lost(Exception):
        pass

    def lost(*args, **kwargs):
        raise Lost

    for step in ("_list", "_put"):
        with monkeypatch.context() as patch:
            patch.setattr(Store, step, lost)
            with pytest.raises(Lost):
                store.cluster_months("curated", "o", "m", "school_id", file_rows=50)
        assert {r.id for r in Store(spark, f"{tmp_path}/t").read("curated", "o").collect()} == set(range(300))

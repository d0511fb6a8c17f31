"""Landed files to loaded tables, streams, restarts."""

import csv
import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import types as T

from cataloom import storage
from cataloom.operators import explore
from cataloom.operators.ranking import rank_by_dimension
from cataloom.operators.search import Facet, search
from cataloom.plans.extract import extract
from cataloom.plans.run import run
from cataloom.plans.transform import build_star, clean_facts
from cataloom.schemas import CLEAN, RAW_DETAIL_COLUMNS
from cataloom.sources import landing, tables
from cataloom.sources.raw_csv import read_csv, read_raw_csv, split_raw_csv
from cataloom.streaming.ingest import ingest_stream, ingested, ingested_details

BASE = {
    "name": "n", "developer": "d", "publisher": "p", "owners": "10,000 .. 20,000",
    "average_forever": "50", "average_2weeks": "0", "median_forever": None,
    "median_2weeks": "60", "ccu": "7", "price": "999", "initialprice": "1999",
    "discount": "50", "tags": "{'Action': 5}", "languages": "English", "genre": "Action",
}


def record(appid, **cells):
    return {"appid": appid, **BASE, **cells}


RECORDS = [
    record("1"),
    record("2", name="NA"),
    record("3", name="None", price="150000"),
    record("4", price="150001"),
    record("5", price=None),
    record("6", name="late", price="200000"),
    record("6", name="second"),
    record("6", name="third"),
    record("7", owners=None, genre=None, tags="[]", languages="Not supported"),
    record("8", owners="x", genre="A,,B", tags=None, languages="English, English*"),
    record("9", tags="{'Score 50': 1}"),
    record("['999']", **{c: None for c in BASE}),
    record("10", name='He said "hi"', tags="""{"a": 1, "b": 3, "a": 2}""",
           languages="Spanish - Spain, Spanish - Latin America, #x\r\n, Hebrew"),
    record("11", publisher=""),
]


@pytest.fixture
def raw_csv(tmp_path):
    path = tmp_path / "raw.csv"
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.DictWriter(out, RAW_DETAIL_COLUMNS)
        writer.writeheader()
        writer.writerows(RECORDS)
    return str(path)


def test_clean_facts(spark, raw_csv):
    for partitions in (1, 5):
        raw = read_raw_csv(spark, raw_csv).repartition(partitions)
        facts, rejected = clean_facts(raw)
        found = {r["id_app"]: r for r in facts.collect()}
        assert [(r["appid"], r["reason"]) for r in rejected.collect()] == []
        assert sorted(found) == [1, 3, 6, 7, 8, 9, 10]
        assert found[6]["name"] == "second"
        assert found[3]["price_usd"] == 1500.0 and found[3]["name"] == "None"
        one = found[1]
        assert (one["owners_min"], one["owners_max"]) == (10000, 20000)
        assert (one["average_forever_hs"], one["average_2weeks_hs"]) == (0.83, 0.0)
        assert one["median_forever_hs"] is None and one["median_2weeks_hs"] == 1.0
        assert (found[7]["owners_min"], found[7]["owners_max"]) == (None, None)
        assert (found[8]["owners_min"], found[8]["owners_max"]) == (None, None)
        assert found[10]["name"] == 'He said "hi"'


def test_build_star(spark, raw_csv, tmp_path, rows):
    out = str(tmp_path / "clean")
    star, rejected = build_star(read_raw_csv(spark, raw_csv), out)
    assert [(r["appid"], r["reason"]) for r in rejected.collect()] == [("9", "tags")]
    assert star["apps"].columns == CLEAN["apps"].names
    assert rows(star["genres"]) == [(0, "Action"), (1, "A"), (2, None), (3, "B")]
    assert rows(star["apps_genres"]) == [
        (1, 0), (10, 0), (3, 0), (6, 0), (8, 1), (8, 2), (8, 3),
    ]
    assert rows(star["languages"]) == [
        (0, "English", "English"), (1, "Spanish - Spain", "Spanish"),
        (2, "Spanish - Latin America", "Spanish"), (3, "Heew", "Heew"),
    ]
    links = rows(star["apps_languages"])
    assert links.count((8, 0)) == 2 and not [link for link in links if link[0] == 7]
    assert rows(star["tags"]) == [(0, "Action"), (1, "a"), (2, "b")]
    assert rows(star["apps_tags"]) == [(1, 0, 5), (10, 1, 2), (10, 2, 3), (3, 0, 5), (6, 0, 5)]
    for name in CLEAN:
        assert rows(tables.read_staged(spark, out, name)) == rows(star[name])


def test_records_without_an_id_are_set_aside(spark, raw_csv, rows):
    raw = read_raw_csv(spark, raw_csv)
    good, rejected = landing.split_details(landing.mark_rejected(raw))
    assert [r["appid"] for r in rejected.collect()] == ["['999']"]
    assert good.count() == len(RECORDS) - 1
    asked = spark.createDataFrame([(1,), (999,)], "appid bigint")
    assert rows(landing.failed_ids(asked, good)) == [(999,)]


def test_a_label_that_means_nothing_has_no_name(spark, rows):
    data = [(0, *[{**record("1"), "genre": "NA,B", "tags": "{'null': 1}"}[c]
                  for c in RAW_DETAIL_COLUMNS])]
    schema = ", ".join(f"{c} string" for c in RAW_DETAIL_COLUMNS)
    star, _ = build_star(spark.createDataFrame(data, f"row_seq bigint, {schema}"))
    assert rows(star["genres"]) == [(0, None), (1, "B")]
    assert rows(star["tags"]) == [(0, None)]
    assert rows(star["apps_genres"]) == [(1, 0), (1, 1)]


def test_several_csv_files_keep_their_order(spark, tmp_path):
    for number in range(3):
        with open(tmp_path / f"part {number} é%20.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.DictWriter(out, RAW_DETAIL_COLUMNS)
            writer.writeheader()
            # The last file is the longest, and is read first.
            writer.writerows(
                [record("1", name=f"{number}.{i}") for i in range(3 + 40 * number)]
            )
    raw = read_raw_csv(spark, str(tmp_path))
    assert raw.select("row_seq").distinct().count() == 3 * 3 + 40 * 3
    assert clean_facts(raw)[0].first()["name"] == "0.0"


@pytest.fixture
def landed(tmp_path):
    apps = [{"appid": i, "name": f"app{i}"} for i in (5, 3, 9, 4, 8)]
    apps[3:3] = [{"appid": 6, "name": "  "}, {"appid": 7, "name": None}]
    (tmp_path / "list").mkdir()
    (tmp_path / "list/apps.json").write_text(json.dumps({"applist": {"apps": apps}}, indent=1))
    (tmp_path / "details").mkdir()
    whole = record("3", tags={"Action": 5, "1990's": 2}, score_rank="")
    lines = [
        json.dumps(whole),
        json.dumps(record(5, price=0, tags=[])),
        json.dumps(record("9", genre="A"))[:-1],
        json.dumps({"appid": ["8"]}),
        "",
        json.dumps(record(7, name="named")),
    ]
    (tmp_path / "details/a.json").write_text("\n".join(lines))
    return str(tmp_path / "list"), str(tmp_path / "details")


def test_extract(spark, landed, tmp_path, rows):
    raw = extract(spark, *landed, str(tmp_path / "raw"), batch_size=2)
    listed = [(r["row_seq"], r["appid"]) for r in raw["app_list"].collect()]
    assert sorted(listed) == [(0, 5), (1, 3), (2, 9), (3, 7), (4, 4), (5, 8)]
    details = raw["app_details"].orderBy("row_seq").collect()
    found = [(r["row_seq"], r["batch_id"], r["appid"]) for r in details]
    assert found == [(0, 0, "5"), (1, 0, "3"), (3, 1, "7")]
    assert raw["app_details"].columns == ["row_seq", "batch_id", *RAW_DETAIL_COLUMNS]
    assert rows(raw["failed_ids"].select("appid")) == [(4,), (8,), (9,)]
    assert raw["rejected"].count() == 2
    assert raw["unrequested"].count() == 0


def test_first_landed_record_answers(spark, landed, tmp_path):
    path = tmp_path / "details"
    # Longer files are scanned first, but the order is that of the paths.
    (path / "b.json").write_text(
        "\n".join(json.dumps(record(a, name=f"b{i}")) for i in range(50) for a in (3, 4))
    )
    raw = extract(spark, *landed, str(tmp_path / "raw"))
    names = {r["appid"]: r["name"] for r in raw["app_details"].collect()}
    assert names == {"3": "n", "4": "b0", "5": "n", "7": "named"}
    assert raw["app_details"].count() == 4


def test_extract_from_a_start_index(spark, landed, tmp_path):
    raw = extract(spark, *landed, str(tmp_path / "raw"), start=3, batch_size=2)
    assert raw["app_list"].count() == 6  # the whole list, whatever the start is
    assert [(r["row_seq"], r["appid"]) for r in raw["app_details"].collect()] == [(3, "7")]
    asked = [(r["row_seq"], r["appid"], r["batch_id"]) for r in raw["failed_ids"].collect()]
    assert sorted(asked) == [(4, 4, 0), (5, 8, 1)]
    assert sorted(r["appid"] for r in raw["unrequested"].collect()) == [3, 5]
    past = extract(spark, *landed, str(tmp_path / "raw"), start=6)
    assert past["app_list"].count() == 6 and past["failed_ids"].count() == 0
    assert past["unrequested"].count() == 3


def test_extract_stops_without_applications(spark, landed, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty/apps.json").write_text('{"applist": {"apps": []}}')
    raw = str(tmp_path / "raw")
    extract(spark, *landed, raw)
    with pytest.raises(ValueError):
        extract(spark, str(tmp_path / "empty"), landed[1], raw)
    assert spark.read.parquet(f"{raw}/app_list").count() == 6  # the good list is still there


def test_reports_stay_when_a_run_is_repeated(spark, landed, tmp_path, rows):
    raw = str(tmp_path / "raw")
    first = extract(spark, *landed, raw)
    before = {n: rows(first[n]) for n in ("rejected", "failed_ids", "unrequested")}
    (tmp_path / "details/a.json").write_text(json.dumps(record("3")))
    extract(spark, *landed, raw)
    assert {n: rows(first[n]) for n in before} == before


def test_blank_names(spark, rows):
    data = [(1, "   "), (2, None), (3, " \t　"), (4, "x"), (5, "")]
    df = spark.createDataFrame(data, "appid bigint, name string")
    assert [r[0] for r in rows(landing.drop_blank_names(df))] == [2, 4]


def test_run_twice_gives_one_copy(spark, landed, tmp_path, rows):
    spark.sql("CREATE DATABASE run_twice")
    results = []
    for _ in range(2):
        outcome = run(spark, *landed, str(tmp_path / "base"), database="run_twice")
        results.append({n: rows(spark.table(f"run_twice.{n}")) for n in CLEAN})
    assert results[0] == results[1]
    assert [r[0] for r in results[0]["apps"]] == [3, 5, 7]
    assert results[0]["tags"] == [(0, "Action"), (1, "1990s")]
    assert outcome.quality.where("violations > 0").count() == 0
    assert all(df.isEmpty() for df in outcome.rejected_rows.values())
    assert explore.table_names(spark, "run_twice") == sorted(CLEAN)
    seen = explore.preview(spark, "run_twice", 2)
    assert sorted(seen) == sorted(CLEAN) and seen["apps"].count() == 2


def test_prepare_tables_empties(spark, landed, tmp_path):
    spark.sql("CREATE DATABASE prepared")
    root = str(tmp_path / "tables")
    tables.create_tables(spark, root, database="prepared")
    run(spark, *landed, str(tmp_path / "base"), database="prepared")
    tables.create_tables(spark, root, database="prepared")
    assert spark.table("prepared.apps").count() == 3
    tables.prepare_tables(spark, root, database="prepared")
    assert spark.table("prepared.apps").count() == 0


def test_failed_load_keeps_old_tables(spark, landed, tmp_path):
    spark.sql("CREATE DATABASE kept")
    base = str(tmp_path / "base")
    run(spark, *landed, base, database="kept")
    with pytest.raises(Exception):
        tables.load_tables(spark, str(tmp_path / "nowhere"), base, database="kept")
    assert spark.table("kept.apps").count() == 3


def test_a_table_with_other_columns_is_not_touched(spark, landed, tmp_path):
    spark.sql("CREATE DATABASE other")
    spark.sql("CREATE TABLE other.genres (id_genre bigint, label string) USING parquet")
    with pytest.raises(ValueError, match="other columns"):
        run(spark, *landed, str(tmp_path / "base"), database="other")
    assert explore.table_names(spark, "other") == ["genres"]


def test_load_order():
    order = tables.load_order(CLEAN)
    assert set(order[:4]) == {"apps", "genres", "languages", "tags"}


def test_conform_splits_bad_rows(spark, rows):
    data = [("1", "a"), ("x", "b"), (None, "c")]
    df = spark.createDataFrame(data, "id_genre string, genre string")
    good, bad = tables.conform(df, CLEAN["genres"])
    assert rows(good) == [(1, "a")] and rows(bad) == [("x", "b"), (None, "c")]


def test_csv_round_trip(spark, tmp_path, rows):
    cells = [("1", ' "q", b '), ("2", "line\nbreak"), ("3", "x\\"), ("4", None)]
    df = spark.createDataFrame(cells, "name string, developer string")
    path = tables.write_table(df, str(tmp_path / "out"), "csv")
    assert rows(tables.read_csv(spark, path, df.schema)) == sorted(cells, key=repr)


def test_csv_by_header_name(spark, tmp_path, rows):
    text = 'name,appid,more\n"a ""q"", b",1,x\nshort,2\nlong,3,x,y\n"two\nlines",4,z\n'
    (tmp_path / "a.csv").write_text(text)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("appid", "name")])
    more = T.StructType([*schema, T.StructField("price", T.StringType())])
    good, rejected = split_raw_csv(spark, str(tmp_path), schema)
    expected = [("1", 'a "q", b'), ("4", "two\nlines")]
    assert rows(good.select("appid", "name")) == expected and good.count() == 2
    assert rows(rejected.select("_corrupt")) == [("long,3,x,y",), ("short,2",)]
    assert rejected.count() == 2 and rows(good.select("appid")) == [("1",), ("4",)]
    with pytest.raises(ValueError, match="price"):
        read_csv(spark, str(tmp_path), more)
    (tmp_path / "b.csv").write_text("appid,name,more\n9,b,x\n")
    with pytest.raises(Exception, match="b.csv"):
        read_csv(spark, str(tmp_path), schema).collect()


UNREADABLE = [
    ({"appid": "x3"}, "appid"), ({"appid": "4.5"}, "appid"), ({"appid": ""}, "appid"),
    ({"price": "9,99"}, "price"), ({"ccu": "abc"}, "ccu"), ({"ccu": "12.7"}, "ccu"),
    ({"discount": "half"}, "discount"), ({"average_2weeks": "?"}, "average_2weeks"),
    ({"initialprice": "x", "ccu": "y"}, "ccu,initialprice"),
    ({"tags": "{'a': 2.9}"}, "tags"), ({"tags": "{'a': 1} x"}, "tags"),
]
READABLE = [
    {"appid": "4.0"}, {"appid": " 9007199254740993 "}, {"price": None}, {"ccu": ""},
    {"tags": "[ ]"}, {"tags": "\n"}, {"owners": "x"}, {"price": "150001"},
]


def test_unreadable_cells_reject_the_row(spark):
    data = [{**record(str(100 + i)), **cells} for i, (cells, _) in enumerate(UNREADABLE)]
    data += [{**record(str(200 + i)), **cells} for i, cells in enumerate(READABLE)]
    data.append({**record("x"), "name": None})  # a required field is missing: no report
    schema = ", ".join(f"{c} string" for c in RAW_DETAIL_COLUMNS)
    raw = spark.createDataFrame(
        [(i, *[r[c] for c in RAW_DETAIL_COLUMNS]) for i, r in enumerate(data)],
        f"row_seq bigint, {schema}",
    )
    star, rejected = build_star(raw)
    reasons = {r["row_seq"]: r["reason"] for r in rejected.collect()}
    assert reasons == {i: reason for i, (_, reason) in enumerate(UNREADABLE)}
    kept = {r["id_app"] for r in star["apps"].collect()}
    assert kept == {4, 9007199254740993, 203, 204, 205, 206}


def test_append_batches(spark, tmp_path, rows):
    path, fields = str(tmp_path / "out"), ("a", "b")
    for _ in range(2):
        tables.reset_batches(spark, path, fields)
        one = spark.createDataFrame([("1", "x")], "a string, extra string")
        tables.append_batch(one, path, fields)
        tables.append_batch(spark.createDataFrame([("2", "y")], "b string, a string"), path, fields)
    assert rows(spark.read.parquet(path)) == [("1", None), ("y", "2")]


def test_stream_restart_adds_nothing(spark, tmp_path, rows):
    landing_dir, target = tmp_path / "landing", str(tmp_path / "out")
    landing_dir.mkdir()

    def take():
        ingest_stream(
            spark, str(landing_dir), target, str(tmp_path / "ck"), files_per_batch=1
        ).awaitTermination()
        return rows(ingested(spark, target).select("appid"))

    (landing_dir / "1.json").write_text(json.dumps(record("1")) + "\n{broken")
    (landing_dir / "2.json").write_text(json.dumps(record("2")))
    assert take() == [("1",), ("2",)]
    assert take() == [("1",), ("2",)]
    (landing_dir / "3.json").write_text(json.dumps(record("3")))
    assert take() == [("1",), ("2",), ("3",)]
    assert ingested(spark, target, rejected=True).count() == 1
    details = ingested_details(spark, target)
    assert rows(details.select("row_seq", "appid")) == [(0, "1"), (1, "2"), (2, "3")]
    star, _ = build_star(details)
    assert rows(star["apps"].select("id_app")) == [(1,), (2,), (3,)]
    assert rows(ingested(spark, target).groupBy("batch_id").count().select("count")) == [
        (1,), (1,), (1,),
    ]


def test_no_python_in_the_star_plan(spark, raw_csv):
    plan = clean_facts(read_raw_csv(spark, raw_csv))[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_run_sql_takes_parameters(spark):
    found = tables.run_sql(spark, "SELECT :label AS label", {"label": "Shoot 'Em Up"})
    assert found.first()["label"] == "Shoot 'Em Up"


def test_bucketed_tables_join_without_a_shuffle(spark, landed, tmp_path, rows):
    spark.sql("CREATE DATABASE plain")
    spark.sql("CREATE DATABASE bucketed")
    base, root = str(tmp_path / "base"), str(tmp_path / "tables")
    run(spark, *landed, base, database="plain")
    for buckets in (0, 4, 4, 3):  # first load, change of layout, refresh, change again
        tables.load_tables(
            spark, f"{base}/clean", root, database="bucketed", buckets=buckets
        )
        for name in CLEAN:
            assert rows(spark.table(f"bucketed.{name}")) == rows(spark.table(f"plain.{name}"))
    assert explore.table_names(spark, "bucketed") == sorted(CLEAN)

    def exchanges(make):
        plans = {}
        for database in ("plain", "bucketed"):
            frames = (spark.table(f"{database}.{n}") for n in ("apps", "apps_genres", "genres"))
            plan = make(*frames)._jdf.queryExecution().executedPlan().toString()
            plans[database] = plan.count("Exchange hashpartitioning(id_app#")
        return plans["plain"], plans["bucketed"]

    def ranked(apps, links, genres):
        return rank_by_dimension(
            apps, links, genres, fact_id="id_app", dim_id="id_genre", label="genre",
            criterion="owners_max",
        )

    def searched(apps, links, genres):
        facet = Facet(links, genres, "id_genre", "genre", ["Action", "A"])
        return search(apps, [facet], fact_id="id_app", order_by="owners_max")

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(lambda apps, links, _: apps.join(links, "id_app")) == (2, 0)
        assert exchanges(ranked) == (2, 0)
        plain, bucketed = exchanges(searched)
        assert plain >= 2 and bucketed == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_table_freshness(spark, landed, tmp_path):
    spark.sql("CREATE DATABASE fresh")
    before = datetime.now(timezone.utc)
    run(spark, *landed, str(tmp_path / "base"), database="fresh")
    now = datetime.now(timezone.utc)
    found = explore.table_freshness(spark, "fresh.apps", now).first()
    assert found["message"].startswith("Last database update: 0d 0h 0m ")
    loaded = found["last_update"].astimezone(timezone.utc)
    assert before - timedelta(seconds=2) <= loaded <= now


def test_publish_keeps_stage_and_name(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a")], "id_genre bigint, genre string")
    path = tables.publish(df, "/data/here/clean/genres", str(tmp_path))
    assert path == f"{tmp_path}/clean/genres"
    assert rows(tables.read_staged(spark, f"{tmp_path}/clean", "genres")) == [(1, "a")]


def test_shared_folder_is_the_session_setting(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert storage.scratch_path(spark, "x") != storage.scratch_path(spark, "x")


class FakeSession:
    """A session without the setting, local or on a cluster."""

    def __init__(self, master, folder=None):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder or default)})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})


def test_no_machine_local_folder_on_a_cluster():
    local = storage.shared_dir(FakeSession("local[2]"))
    assert storage.shared_dir(FakeSession("local[2]")) == local
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            storage.shared_dir(FakeSession(master))
        with pytest.raises(RuntimeError):
            storage.shared_dir(FakeSession(master, "/tmp/any"))
        for folder in ("hdfs://name/tmp", "file:/shared", "s3a://bucket/tmp/"):
            assert storage.shared_dir(FakeSession(master, folder)) == folder.rstrip("/")
    assert storage.shared_dir(FakeSession("local[2]", "/tmp/any")) == "/tmp/any"


class Elsewhere:
    """The session as if on a cluster, with another setting; ``lost``: files the driver misses."""

    def __init__(self, spark, folder, lost=0):
        context = spark.sparkContext
        self.sparkContext = type(
            "Context",
            (),
            {"master": "local-cluster[2,1,1024]", "__getattr__": lambda _, name: getattr(context, name)},
        )()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder)})
        self.range = spark.range
        self.read = spark.read if not lost else self
        self.lost, self.inner = lost, spark

    def schema(self, kinds):
        return self

    def parquet(self, path):
        found = self.inner.read.parquet(path)
        return found.limit(found.count() - self.lost)


def test_a_bare_folder_on_a_cluster_is_taken_if_all_reach_it(spark, tmp_path):
    folder = tmp_path / "reached"
    there = Elsewhere(spark, f"{folder}/")
    assert storage.shared_dir(there) == f"file:{folder}"
    trials = sorted((folder / "cataloom").iterdir())
    assert len(trials) == 1
    assert storage.scratch_path(there, "x").startswith(f"file:{folder}/cataloom/")
    assert sorted((folder / "cataloom").iterdir()) == trials
    (tmp_path / "plain").write_text("no folder")
    for unreached in (Elsewhere(spark, str(tmp_path / "plain")), Elsewhere(spark, str(tmp_path / "own"), 1)):
        with pytest.raises(RuntimeError, match="needs a scheme"):
            storage.shared_dir(unreached)

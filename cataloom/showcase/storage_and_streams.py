"""Files, tables, catalog and streams: data is written, read back and compared."""

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cataloom.operators import explore
from cataloom.operators.ids import dense_ids
from cataloom.plans.extract import extract
from cataloom.plans.run import run
from cataloom.schemas import CLEAN, CORRUPT, RAW_LIST, RAW_LIST_COLUMNS
from cataloom.showcase import query, roles, table
from cataloom.showcase.cleaning import (
    BAD_TAGS,
    STAR_ROWS,
    facts_sql,
    raw_details,
    star_rows,
    star_sql,
)
from cataloom.showcase.roles import APPS, LANGUAGES
from cataloom.sources import landing, tables
from cataloom.sources.raw_csv import read_csv, read_raw_csv, split_raw_csv
from cataloom.sources.split_csv import split_csv
from cataloom.storage import materialize, scratch_path
from cataloom.streaming.ingest import ingest_stream, ingested


def _json_lines(df: DataFrame, path: str) -> str:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)
    return path


def _lists(spark, d) -> DataFrame:
    """A list document of two applications for each part."""
    app = F.struct(F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"))
    twin = F.struct((-F.col("p_partkey") - 1).alias("appid"), F.col("p_brand").alias("name"))
    return table(spark, d, "part").select("p_partkey", F.array(app, twin).alias("apps"))


def _land_list(spark, d) -> str:
    """The documents one per line, in files in the order of the parts."""
    ordered = _lists(spark, d).repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey")
    documents = ordered.select(F.struct("apps").alias("applist"))
    return _json_lines(documents, scratch_path(spark, "list"))


@query("""SELECT p_partkey AS appid, p_name AS name FROM part
    UNION ALL SELECT -p_partkey - 1, p_brand FROM part""")
def scan_list_json(spark, d):
    apps = landing.read_app_list(spark, _land_list(spark, d), one_document=False)
    return apps.select("appid", "name")


def _land_details(spark, d) -> str:
    """One detail record per part; those of one type are cut short, one type has no id."""
    part = table(spark, d, "part")
    appid = F.when(
        F.col("p_type") == "SMALL", F.concat(F.lit("['"), F.col("p_partkey"), F.lit("']"))
    ).otherwise(F.col("p_partkey").cast("string"))
    record = F.to_json(
        F.struct(
            appid.alias("appid"),
            F.col("p_name").alias("name"),
            F.col("p_size").alias("ccu"),
            F.create_map(F.col("p_brand"), F.col("p_size")).alias("tags"),
            F.lit("ignored").alias("score_rank"),
        )
    )
    cut = F.when(F.col("p_type") == "PROMO", F.rtrim(record, F.lit("}"))).otherwise(record)
    path = scratch_path(spark, "details")
    part.select(cut.alias("value")).write.text(path)
    return path


@query("""SELECT p_partkey AS appid, p_name AS name, CAST(p_size AS VARCHAR) AS ccu,
        '{"' || p_brand || '":' || coalesce(p_size || '', 'null') || '}' AS tags
    FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')""")
def scan_details_json(spark, d):
    marked = landing.mark_rejected(landing.read_details(spark, _land_details(spark, d)))
    good, _ = landing.split_details(marked)
    return good.select("appid", "name", "ccu", "tags")


_QUOTED_ID = "'[' || chr(39) || p_partkey || chr(39) || ']'"


@query(f"""SELECT true AS cut, '{{"appid":"' || p_partkey || '","name":"' || p_name || '","ccu":'
        || p_size || ',"tags":{{"' || p_brand || '":' || p_size || '}},"score_rank":"ignored"' AS text
    FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT false, {_QUOTED_ID} || p_name FROM part WHERE p_type = 'SMALL'""")
def scan_details_json_rejected(spark, d):
    marked = landing.mark_rejected(landing.read_details(spark, _land_details(spark, d)))
    _, rejected = landing.split_details(marked)
    return rejected.select(
        F.col(CORRUPT).isNotNull().alias("cut"),
        F.coalesce(CORRUPT, F.concat("appid", "name")).alias("text"),
    )


def _extract_sql(start: int) -> str:
    """Rows of all raw tables after an extract from a start position."""
    return f"""WITH numbered AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS r FROM part),
    app_list AS (SELECT 2 * r AS row_seq, p_partkey AS appid, p_name AS name FROM numbered
        UNION ALL SELECT 2 * r + 1, -p_partkey - 1, p_brand FROM numbered),
    good AS (SELECT p_partkey AS appid FROM part WHERE p_type NOT IN ('PROMO', 'SMALL'))
    SELECT 'app_list' AS table_name, row_seq, CAST(NULL AS BIGINT) AS batch_id,
        CAST(appid AS VARCHAR) AS appid, name FROM app_list
    UNION ALL SELECT 'app_details', row_seq, (row_seq - {start}) // 2500,
        CAST(appid AS VARCHAR), name
        FROM app_list JOIN good USING (appid) WHERE row_seq >= {start}
    UNION ALL SELECT 'failed_ids', row_seq, (row_seq - {start}) // 2500,
        CAST(appid AS VARCHAR), name
        FROM app_list WHERE row_seq >= {start} AND appid NOT IN (SELECT appid FROM good)
    UNION ALL SELECT 'unrequested', NULL, NULL, CAST(appid AS VARCHAR), name
        FROM app_list JOIN good USING (appid) WHERE row_seq < {start}
    UNION ALL SELECT 'rejected', NULL, NULL, {_QUOTED_ID}, p_name FROM part WHERE p_type = 'SMALL'
    UNION ALL SELECT 'rejected', NULL, NULL, 'cut', NULL FROM part WHERE p_type = 'PROMO'"""


def _extracted(spark, d, start: int) -> DataFrame:
    raw = extract(
        spark, _land_list(spark, d), _land_details(spark, d), scratch_path(spark, "raw"),
        start=start, one_document=False,
    )
    cut = F.col(CORRUPT).isNotNull()
    raw["rejected"] = raw["rejected"].select(
        F.when(cut, F.lit("cut")).otherwise(F.col("appid")).alias("appid"),
        F.when(~cut, F.col("name")).alias("name"),
    )
    fields = {"row_seq": "bigint", "batch_id": "bigint", "appid": "string", "name": "string"}
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            *(
                (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
                for c, kind in fields.items()
            ),
        )
        for name, df in raw.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(_extract_sql(0))
def extract_raw(spark, d):
    return _extracted(spark, d, 0)


@query(_extract_sql(100))
def extract_restart(spark, d):
    """From a start position: the whole list stays, details before it are reported."""
    return _extracted(spark, d, 100)


@query("""SELECT applist.appid, applist.name FROM (SELECT unnest([
        {'appid': p_partkey, 'name': p_name}, {'appid': -p_partkey - 1, 'name': p_brand}])
        AS applist FROM part)""")
def inline_list(spark, d):
    """Files that are one document of many lines each, for every 500 parts."""
    lists = _lists(spark, d).groupBy(F.floor(F.col("p_partkey") / 500).alias("file"))
    apps = F.struct(F.flatten(F.collect_list("apps")).alias("apps"))
    documents = lists.agg(apps.alias("applist"))
    text = F.to_json(F.struct("applist"), {"pretty": "true"}).alias("value")
    path = scratch_path(spark, "documents")
    documents.select("file", text).write.partitionBy("file").text(path)
    return landing.read_app_list(spark, path).select("appid", "name")


_TEXT_COLUMNS = ("doc_id", "quoted", "text", "blank")


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'a "' || source || '", b' AS quoted, text,
        CASE WHEN lang <> 'en' THEN '  ' || lang || ' ' END AS blank FROM documents""")
def scan_raw_csv(spark, d):
    """Quotes, commas, line breaks, outer blanks and null tokens survive the round trip."""
    documents = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit('a "'), "source", F.lit('", b')).alias("quoted"),
        "text",
        F.when(F.col("lang") == "en", F.lit("NA"))
        .otherwise(F.concat(F.lit("  "), "lang", F.lit(" ")))
        .alias("blank"),
    )
    path = tables.write_table(documents, scratch_path(spark, "documents"), "csv")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _TEXT_COLUMNS])
    return read_raw_csv(spark, path, schema).drop("row_seq")


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'a "' || source || '", b' AS quoted, text,
        row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents""")
def scan_split_csv(spark, d):
    """Texts with quotes and line breaks come back, in order, from files shared by many tasks."""
    documents = table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit('a "'), "source", F.lit('", b')).alias("quoted"), "text"
    )
    ordered = documents.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id")
    path = tables.write_table(ordered, scratch_path(spark, "documents"), "csv")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in documents.columns])
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    spark.conf.set(split, "64k")
    try:
        rows, _ = split_csv(spark, path, schema)
    finally:
        spark.conf.set(split, before)
    return dense_ids(rows, ["row_seq"], "position").drop("row_seq")


@query("SELECT CAST(p_partkey AS VARCHAR) AS appid FROM part")
def scan_csv_ids(spark, d):
    """Only the ids of a written application list."""
    apps = table(spark, d, "part").select(
        F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"), "p_brand"
    )
    path = scratch_path(spark, "app_list")
    tables.write_table(apps, path, "csv", RAW_LIST_COLUMNS)
    return read_csv(spark, path, RAW_LIST).select("appid")


@query("""SELECT p_partkey AS row, p_name AS name, CAST(p_size AS VARCHAR) AS size, false AS short
    FROM part WHERE p_type <> 'PROMO'
    UNION ALL SELECT p_partkey, NULL, NULL, true FROM part WHERE p_type = 'PROMO'""")
def scan_csv_by_name(spark, d):
    """Columns in another order, one more than asked for, and lines that are too short."""
    names = ("size", "more", "name", "row")
    whole = F.concat_ws(",", F.col("p_size"), F.lit("x"), F.col("p_name"), F.col("p_partkey"))
    short = F.concat_ws(",", F.col("p_size"), F.col("p_partkey"))
    line = F.when(F.col("p_type") == "PROMO", short).otherwise(whole)
    files = table(spark, d, "part").groupBy(F.floor(F.col("p_partkey") / 500).alias("file"))
    body = files.agg(F.concat_ws("\n", F.collect_list(line)).alias("lines"))
    text = F.concat(F.lit(",".join(names) + "\n"), "lines").alias("value")
    path = scratch_path(spark, "named")
    body.select("file", text).write.partitionBy("file").text(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("row", "name", "size")])
    good, rejected = split_raw_csv(spark, f"{path}/*", schema, multi_line=False)
    kept = good.select(
        F.col("row").cast("bigint").alias("row"), "name", "size", F.lit(False).alias("short")
    )
    lost = rejected.select(
        F.element_at(F.split(CORRUPT, ","), -1).cast("bigint").alias("row"),
        *(F.lit(None).cast("string").alias(c) for c in ("name", "size")),
        F.lit(True).alias("short"),
    )
    return kept.union(lost)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders""")
def append_batches(spark, d):
    """A reset target filled batch by batch holds every row once."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus", "o_totalprice"
    )
    path, fields = scratch_path(spark, "batches"), ("o_orderkey", "o_orderstatus")
    tables.reset_batches(spark, path, fields)
    for status in ("F", "O", "P"):
        tables.append_batch(orders.where(F.col("o_orderstatus") == status), path, fields)
    return spark.read.parquet(path)


def _in_new_database(spark, make) -> DataFrame:
    """The stored result of ``make(database)``; the database is dropped, its files stay."""
    path = scratch_path(spark, "db")
    name = "cataloom_" + path.split("/")[-2]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    try:
        return materialize(make(name), "result")
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@query(f"""WITH {APPS}, {LANGUAGES}
    SELECT normalized_language, name, count(*) AS num_links,
        CAST(sum(owners_max) AS BIGINT) AS owners
    FROM apps JOIN apps_languages USING (id_app) JOIN languages USING (id_language)
    WHERE name IS NOT NULL GROUP BY ALL""")
def full_refresh_roundtrip(spark, d):
    """Stage, create, load twice; the tables hold one copy."""
    return _in_new_database(spark, lambda database: _refreshed(spark, d, database))


_STAGED = ("apps", "languages", "apps_languages")


def _stage(spark, d) -> str:
    apps = roles.apps(spark, d)
    for missing in (
        "owners_min", "average_forever_hs", "median_forever_hs", "median_2weeks_hs",
        "initial_price_usd",
    ):
        apps = apps.withColumn(missing, F.lit(None).cast("string"))
    staged = scratch_path(spark, "staged")
    tables.write_tables(
        {
            "apps": tables.project(apps, tables.CLEAN["apps"].names),
            "languages": roles.languages(spark, d),
            "apps_languages": roles.apps_languages(spark, d),
        },
        staged,
        "csv",
    )
    return staged


def _refreshed(spark, d, database) -> DataFrame:
    staged, root = _stage(spark, d), scratch_path(spark, "tables")
    tables.create_tables(spark, root, _STAGED, database)
    for _ in range(2):
        tables.load_tables(spark, staged, root, _STAGED, database, "csv")
    loaded = {n: spark.table(f"{database}.{n}") for n in _STAGED}
    joined = loaded["apps_languages"].join(loaded["apps"], "id_app")
    return (
        joined.join(loaded["languages"], "id_language")
        .groupBy("normalized_language", "name")
        .agg(F.count("*").alias("num_links"), F.sum("owners_max").alias("owners"))
    )


@query(f"""WITH {APPS}, {LANGUAGES}
    SELECT 'filled' AS state, 'apps' AS table_name, id_app AS id FROM apps WHERE name IS NOT NULL
    UNION ALL SELECT 'filled', 'languages', id_language FROM languages
    UNION ALL SELECT 'filled', 'apps_languages', id_language FROM apps_languages""")
def empty_then_refresh(spark, d):
    """Tables are filled, emptied, and filled again; between, they have no rows."""

    def ids(database, state):
        keys = {"apps": "id_app", "languages": "id_language", "apps_languages": "id_language"}
        parts = [
            spark.table(f"{database}.{n}").select(
                F.lit(state).alias("state"), F.lit(n).alias("table_name"), F.col(k).alias("id")
            )
            for n, k in keys.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    def make(database):
        staged, root = _stage(spark, d), scratch_path(spark, "tables")
        tables.load_tables(spark, staged, root, _STAGED, database, "csv")
        tables.prepare_tables(spark, root, _STAGED, database)
        empty = materialize(ids(database, "empty"), "empty")
        tables.load_tables(spark, staged, root, _STAGED, database, "csv")
        return empty.union(ids(database, "filled"))

    return _in_new_database(spark, make)


@query("SELECT p_partkey AS id_genre, p_name AS genre FROM part")
def publish_table(spark, d):
    """A table published under its stage and name, read back from there."""
    genres = table(spark, d, "part").select(
        F.col("p_partkey").alias("id_genre"), F.col("p_name").alias("genre")
    )
    base = scratch_path(spark, "store")
    tables.publish(genres, "/any/where/clean/genres", base)
    return tables.read_staged(spark, f"{base}/clean", "genres")


@query("""SELECT 'Last database update: 1d 1h 1m 1s ago' AS message, count(*) AS num_rows
    FROM part""")
def table_freshness(spark, d):
    """The age of a stored table, seen a day, an hour, a minute and a second after its last
    file was written."""

    def make(database):
        path = tables.write_table(table(spark, d, "part"), scratch_path(spark, "fresh"))
        spark.catalog.createTable(f"{database}.part", path, "parquet")
        stored = spark.table(f"{database}.part")
        written = stored.agg(F.max("_metadata.file_modification_time")).first()[0]
        now = written + timedelta(days=1, hours=1, minutes=1, seconds=1)
        found = explore.table_freshness(spark, f"{database}.part", now, latest=True)
        message = found.first()["message"]
        return stored.agg(F.lit(message).alias("message"), F.count("*").alias("num_rows"))

    return _in_new_database(spark, make)


@query("""SELECT p_type, count(*) AS num_parts, round(avg(p_size / CAST(60 AS DOUBLE)), 6) AS hours
    FROM part WHERE p_name <> 'Shoot ''Em Up' AND p_size >= 10 GROUP BY p_type""")
def adhoc_sql(spark, d):
    table(spark, d, "part").createOrReplaceTempView("cataloom_part")
    found = tables.run_sql(
        spark,
        """SELECT p_type, count(*) AS num_parts, round(avg(p_size / 60.0D), 6) AS hours
           FROM cataloom_part WHERE p_name <> :label AND p_size >= :low GROUP BY p_type""",
        {"label": "Shoot 'Em Up", "low": 10},
    )
    spark.catalog.dropTempView("cataloom_part")
    return found


_GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "labels", "pages", "benchmark", "conversations",
)


def _in_catalog(spark, d, make) -> DataFrame:
    """The stored result of ``make(database)`` with all given tables in the database."""

    def with_tables(database):
        for name in _GIVEN:
            spark.catalog.createTable(f"{database}.{name}", f"{d}/{name}.parquet", "parquet")
        return make(database)

    return _in_new_database(spark, with_tables)


def _counts(frames) -> DataFrame:
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("num_rows"))
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS num_rows FROM {n}" for n in sorted(_GIVEN)))
def catalog_tables(spark, d):
    return _in_catalog(spark, d, lambda database: _counts(
        {n: spark.table(f"{database}.{n}") for n in explore.table_names(spark, database)}
    ))


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, least(count(*), 100) AS num_rows, least(count(*), 100) AS found"
    f" FROM {n}" for n in sorted(_GIVEN)))
def preview(spark, d):
    """Which rows are shown is open; each must be one of its table."""

    def make(database):
        parts = []
        for name, shown in explore.preview(spark, database).items():
            whole = spark.table(f"{database}.{name}")
            mark = F.xxhash64(*whole.columns).alias("mark")
            # At most a hundred marks.
            marks = F.broadcast(materialize(shown.select(mark), name))
            known = whole.select(mark).join(marks, "mark", "left_semi").distinct()
            known = known.withColumn("known", F.lit(1))
            parts.append(
                marks.join(F.broadcast(known), "mark", "left").agg(
                    F.lit(name).alias("table_name"),
                    F.count("*").alias("num_rows"),
                    F.count("known").alias("found"),
                )
            )
        return reduce(DataFrame.unionByName, parts)

    return _in_catalog(spark, d, make)


_EVENTS = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("event_id", "user_id", "event_type", "props", CORRUPT)
    ]
)


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
        event_type, props FROM events""", name="ingest_stream")
def ingest_events(spark, d):
    """Two landings of files, taken up by three runs; the last finds nothing new."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "props")
    landed, target = scratch_path(spark, "landing"), scratch_path(spark, "ingested")
    checkpoint = scratch_path(spark, "checkpoint")
    is_click = F.col("event_type") == "click"
    for part in (events.where(is_click), events.where(~is_click), None):
        if part is not None:
            lines = part.select(F.to_json(F.struct(*part.columns)).alias("value"))
            lines.write.mode("append").text(landed)
        ingest_stream(
            spark, landed, target, checkpoint, files_per_batch=2, schema=_EVENTS, key="event_id"
        ).awaitTermination()
    return ingested(spark, target, schema=_EVENTS).select(
        "event_id", "user_id", "event_type", "props"
    )


@query("""SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS position,
        (p_partkey // 2) || CASE p_size WHEN 13 THEN '.5' WHEN 14 THEN '.0' ELSE '' END AS appid,
        CASE WHEN p_name <> 'old ring' THEN p_name END AS name FROM part""")
def raw_csv_file_order(spark, d):
    """Raw records written as several CSV files come back in the order of the files."""
    raw = raw_details(spark, d).repartitionByRange(5, "row_seq").sortWithinPartitions("row_seq")
    path = tables.write_table(raw.drop("row_seq"), scratch_path(spark, "raw"), "csv")
    back = read_raw_csv(spark, path).select("row_seq", "appid", "name")
    return dense_ids(back, ["row_seq"], "position").drop("row_seq")


_RUN_FACTS = facts_sql("p_partkey", "p_partkey", "11, 12")


@query(f"""WITH {star_sql(_RUN_FACTS)}
    {STAR_ROWS}
    UNION ALL SELECT 'app_list', p_partkey, NULL, p_name, NULL FROM part
    UNION ALL SELECT 'app_list', -p_partkey - 1, NULL, p_brand, NULL FROM part
    UNION ALL SELECT 'failed_ids', -p_partkey - 1, NULL, p_brand, NULL FROM part
    UNION ALL SELECT 'rejected_facts', id_app, NULL, 'tags', NULL FROM facts
        WHERE p_size IN {BAD_TAGS}
    UNION ALL SELECT 'rejected_facts', p_partkey, NULL,
        CASE p_size WHEN 11 THEN 'price' ELSE 'ccu' END, NULL
        FROM part WHERE p_name <> 'old ring' AND p_brand <> 'Brand#7' AND p_size IN (11, 12)
    UNION ALL SELECT 'violations', 0, NULL, NULL, NULL""")
def end_to_end(spark, d):
    """Landed list and details, through cleaning and normalising, to loaded tables."""
    details = raw_details(spark, d).withColumn("appid", F.col("row_seq").cast("string"))
    landed = _json_lines(details.drop("row_seq"), scratch_path(spark, "details"))

    def rows(name, df, key, label):
        return df.select(
            F.lit(name).alias("table_name"),
            F.col(key).cast("bigint").alias("key"),
            F.lit(None).cast("bigint").alias("ref"),
            (F.lit(None) if label is None else F.col(label)).cast("string").alias("label"),
            F.lit(None).cast("double").alias("amount"),
        )

    def make(database):
        outcome = run(
            spark, _land_list(spark, d), landed, scratch_path(spark, "base"), database,
            one_document=False,
        )
        loaded = {name: spark.table(f"{database}.{name}") for name in CLEAN}
        broken = outcome.quality.where("violations > 0").agg(F.count("*").alias("num"))
        return reduce(
            DataFrame.unionByName,
            [
                star_rows(loaded),
                rows("app_list", outcome.raw["app_list"], "appid", "name"),
                rows("failed_ids", outcome.raw["failed_ids"], "appid", "name"),
                rows("rejected_facts", outcome.rejected_facts, "appid", "reason"),
                rows("violations", broken, "num", None),
            ],
        )

    return _in_new_database(spark, make)

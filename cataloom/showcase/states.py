"""Tables that change in steps: snapshots, repeatable batches, and a star that grows by batches."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.operators.ids import with_batch
from cataloom.plans.refresh import refresh
from cataloom.schemas import CLEAN
from cataloom.showcase import query, roles, table
from cataloom.showcase.cleaning import (
    _FACTS,
    STAR_ROWS,
    facts_sql,
    raw_details,
    star_rows,
    star_sql,
)
from cataloom.showcase.roles import APPS, LANGUAGES
from cataloom.showcase.storage_and_streams import _RUN_FACTS, _json_lines, _land_list
from cataloom.sources import batches, snapshots, versions
from cataloom.storage import scratch_path
from cataloom.streaming import star


def _catalogue(spark, d, moved: int = 0) -> dict[str, DataFrame]:
    """Languages and links, whose ids are moved together, and the applications."""
    languages, links = roles.languages(spark, d), roles.apps_languages(spark, d)
    place = F.col("id_language") + F.lit(moved)
    return {
        "apps": roles.apps(spark, d).select("id_app", "name"),
        "languages": languages.withColumn("id_language", place),
        "apps_languages": links.withColumn("id_language", place),
    }


@query(f"""WITH {APPS}, {LANGUAGES}, linked AS (SELECT normalized_language, id_app
        FROM apps JOIN apps_languages USING (id_app) JOIN languages USING (id_language))
    SELECT seen, normalized_language, count(*) AS num_links
    FROM linked, (SELECT unnest(['before', 'during', 'after']) AS seen)
    WHERE seen <> 'after' OR id_app % 2 = 0 GROUP BY ALL""")
def snapshot_refresh(spark, d):
    """What readers see who began before, during and after a refresh that gives all languages
    other ids; a mix of old and new tables would have no links."""
    root = scratch_path(spark, "catalogue")
    snapshots.replace(spark, root, _catalogue(spark, d))
    seen = {"before": snapshots.current(spark, root)}
    frames = _catalogue(spark, d, moved=1_000_000)
    frames["apps"] = frames["apps"].where("id_app % 2 = 0")
    stored = snapshots.store(spark, root, frames)
    seen["during"] = snapshots.current(spark, root)
    snapshots.put_in_force(spark, root, stored, seen["before"].version)
    seen["after"] = snapshots.current(spark, root)
    parts = []
    for name, snapshot in seen.items():
        t = snapshot.frames(spark)
        links = t["apps_languages"].join(t["apps"], "id_app").join(t["languages"], "id_language")
        counts = links.groupBy("normalized_language").agg(F.count("*").alias("num_links"))
        parts.append(counts.withColumn("seen", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query(f"""WITH {APPS}, {LANGUAGES},
    sizes AS (SELECT 'apps' AS table_name, count(*) AS n, count(*) FILTER (id_app % 2 = 0) AS few FROM apps
        UNION ALL SELECT 'languages', count(*), count(*) FROM languages
        UNION ALL SELECT 'apps_languages', count(*), 0 FROM apps_languages)
    SELECT CAST(v AS BIGINT) AS version, table_name,
        CASE WHEN table_name = 'apps' AND v >= 1 OR table_name = 'apps_languages' AND v = 2
            THEN few ELSE n END AS num_rows
    FROM sizes, range(3) AS t(v)""")
def snapshot_conflict(spark, d):
    """Of two writers who begin with the same state one fails, and leaves no trace until it
    begins again with the state of the other."""
    root = scratch_path(spark, "catalogue")
    base = snapshots.replace(spark, root, _catalogue(spark, d))
    fewer = base.read(spark, "apps").where("id_app % 2 = 0")
    snapshots.replace(spark, root, {"apps": fewer}, after=base.version)
    none = {"apps_languages": base.read(spark, "apps_languages").limit(0)}
    try:
        snapshots.replace(spark, root, none, after=base.version)
    except versions.VersionConflict:
        snapshots.replace(spark, root, none)
    return snapshots.history(spark, root).select("version", "table_name", "num_rows")


@query(f"""WITH {star_sql(_RUN_FACTS)}
    {STAR_ROWS}
    UNION ALL SELECT 'apps_before', id_app, NULL, name, NULL FROM kept WHERE id_app % 3 = 0""")
def snapshot_end_to_end(spark, d):
    """Two refreshes from landed files; who reads the first state keeps it during the second."""
    details = raw_details(spark, d).withColumn("appid", F.col("row_seq").cast("string"))
    listed, root = _land_list(spark, d), scratch_path(spark, "catalogue")
    some = _json_lines(details.where("row_seq % 3 = 0").drop("row_seq"), scratch_path(spark, "some"))
    every = _json_lines(details.drop("row_seq"), scratch_path(spark, "every"))
    first = refresh(spark, listed, some, root, one_document=False).snapshot
    refresh(spark, listed, every, root, one_document=False)
    now = snapshots.current(spark, root).frames(spark)
    before = first.read(spark, "apps").select(
        F.lit("apps_before").alias("table_name"),
        F.col("id_app").alias("key"),
        F.lit(None).cast("bigint").alias("ref"),
        F.col("name").alias("label"),
        F.lit(None).cast("double").alias("amount"),
    )
    return star_rows({name: now[name] for name in CLEAN}).unionByName(before)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'done'
        ELSE o_orderstatus END AS o_orderstatus,
        CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS batch_id FROM orders""")
def repeatable_batches(spark, d):
    """Batches put twice, one of them with other contents the second time."""
    number = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", number.alias("batch_id"))
    root, fields = scratch_path(spark, "batches"), ("o_orderkey", "o_orderstatus")
    batches.put_batches(orders, root, fields)
    batches.put_batches(orders.where("batch_id = 0"), root, fields)
    done = orders.where("batch_id = 2").withColumn("o_orderstatus", F.lit("done"))
    batches.put_batches(done, root, fields)
    return batches.read_batches(spark, root, fields)


@query("""SELECT (p_partkey - low) // 300 AS batch, count(*) AS num_rows,
        max(p_partkey) - low + 1 AS done, CAST(0 AS BIGINT) AS restart
    FROM part, (SELECT min(p_partkey) AS low FROM part)
    WHERE (p_partkey - low) // 300 > 0 GROUP BY batch, low""")
def batch_ledger(spark, d):
    """Rows and positions done of each batch; the first one is missing, so work begins there."""
    part = table(spark, d, "part").select("p_partkey", "p_name")
    low = part.agg(F.min("p_partkey")).first()[0]
    work = with_batch(part, "p_partkey", low, 300).where("batch_id > 0")
    root = scratch_path(spark, "batches")
    for _ in range(2):
        batches.put_batches(work, root, ["p_name"], position="p_partkey")
    restart = batches.restart_position(spark, root, low, 300) - low
    return batches.progress(spark, root, low).withColumn("restart", F.lit(restart).cast("bigint"))


def _thirds(details: DataFrame) -> list[DataFrame]:
    """Raw records in three runs of their order; two cut an application off from its copy."""
    low, high = details.agg(F.min("row_seq"), F.max("row_seq")).first()
    ends = [low, (2 * low + high) // 3 | 1, (low + 2 * high) // 3 | 1, high + 1]
    return [
        details.where((F.col("row_seq") >= a) & (F.col("row_seq") < b))
        for a, b in zip(ends, ends[1:], strict=False)
    ]


@query(f"WITH {star_sql(_FACTS)} {STAR_ROWS}")
def star_batches(spark, d):
    """Three batches, each taken up twice, then late copies of all applications: the tables of a
    rebuild, ids included."""
    details, root = raw_details(spark, d), scratch_path(spark, "star")
    for number, batch in enumerate(_thirds(details)):
        for _ in range(2):
            star.apply_batch(spark, root, batch, "details", number)
    late = details.withColumn("genre", F.lit("Late")).withColumn("price", F.lit("100"))
    # Only those taken up: a record that was left out may still come right.
    seen = star.snapshots.current(spark, root).read(spark, "seen")
    late = late.join(seen, F.floor("appid").cast("bigint") == F.col("id_app"), "left_semi")
    star.apply_batch(spark, root, late, "details", 3)
    return star_rows(star.star(spark, root))


# Records whose id is no plain number (sizes 13 and 14) are rejected as they land.
_LANDED_FACTS = facts_sql("p_partkey // 2", "p_partkey", "11, 12, 13, 14")


@query(f"""WITH {star_sql(_LANDED_FACTS)} {STAR_ROWS}
    UNION ALL SELECT 'rejected_records', NULL, NULL, _id, NULL FROM (
        SELECT p_partkey // 2 || '.5' AS _id FROM part WHERE p_size = 13
        UNION ALL SELECT p_partkey // 2 || '.0' FROM part WHERE p_size = 14)""")
def star_stream(spark, d):
    """Files landed in three drops, each followed by a run of the stream; the last finds nothing."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "star")
    for batch in (*_thirds(raw_details(spark, d)), None):
        if batch is not None:
            ordered = batch.repartitionByRange(3, "row_seq").sortWithinPartitions("row_seq")
            record = F.struct(*[c for c in batch.columns if c != "row_seq"])
            ordered.select(F.to_json(record).alias("value")).write.mode("append").text(landing)
        star.star_stream(spark, landing, root, f"{root}-checkpoint").awaitTermination()
    rejected = star.rejected_records(spark, root).select(
        F.lit("rejected_records").alias("table_name"),
        F.lit(None).cast("bigint").alias("key"),
        F.lit(None).cast("bigint").alias("ref"),
        F.col("appid").alias("label"),
        F.lit(None).cast("double").alias("amount"),
    )
    return star_rows(star.star(spark, root)).unionByName(rejected)

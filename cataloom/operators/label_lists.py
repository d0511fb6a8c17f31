"""The canonical label of a text from a list of any length.

``functions.canonical_label`` tries every name on every text. Here each name is looked up under the
rarest of its runs of three characters: only texts that have this run are compared with it. The
work follows the number of such meetings, not texts times names.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 3


def runs(text: Column, length: int) -> Column:
    """The different runs of ``length`` characters of a text."""
    characters = F.split(text, "")
    last = F.length(text) - length
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    parts = F.transform(starts, lambda i: F.array_join(F.slice(characters, i + 1, length), ""))
    return F.array_distinct(parts)


def canonical_labels(
    df: DataFrame, text: str, names: Sequence[str] | DataFrame, result: str
) -> DataFrame:
    """``df`` with the first of ``names`` that its text contains, ignoring case, else the text.

    ``names`` is a list, or a table (name, position) whose least position comes first. An empty
    name is contained in every text; a null text stays null.
    """
    spark = df.sparkSession
    if not isinstance(names, DataFrame):
        rows = [(name, place) for place, name in enumerate(names)]
        names = spark.createDataFrame(rows, "name string, position bigint")
    names = names.where("name IS NOT NULL").withColumn("low", F.lower("name"))
    texts = df.select(F.lower(F.col(text)).alias("_text")).where("_text IS NOT NULL").distinct()

    # Names shorter than a run are looked up under all of themselves.
    sizes = range(1, RUN + 1)
    of_texts = texts.select("_text", F.explode(F.concat(*[runs(F.col("_text"), n) for n in sizes])).alias("run"))
    size = F.least(F.length("low"), F.lit(RUN))
    of_name = F.array().cast("array<string>")
    for n in sizes:
        of_name = F.when(size == n, runs(F.col("low"), n)).otherwise(of_name)
    of_names = names.select("name", "position", "low", F.size(of_name).alias("n"), F.explode(of_name).alias("run"))
    frequency = of_texts.groupBy("run").agg(F.count("*").alias("texts"))
    keys = (
        of_names.join(frequency, "run")
        .groupBy("name", "position", "low", "n")
        .agg(F.count("*").alias("found"), F.min_by("run", F.struct("texts", "run")).alias("run"))
        # A name with a run that no text has is in no text.
        .where("found = n")
    )
    met = of_texts.join(keys, "run").where(F.contains("_text", "low"))
    found = met.select("_text", "position", "name")
    empty = names.where("low = ''").orderBy("position").select("position", "name").first()
    if empty:
        found = found.unionByName(texts.select("_text", *[F.lit(empty[c]).alias(c) for c in ("position", "name")]))
    best = found.groupBy("_text").agg(F.min_by("name", "position").alias("_name"))
    joined = df.join(best, F.lower(F.col(text)) == F.col("_text"), "left")
    return joined.withColumn(result, F.coalesce("_name", F.col(text))).drop("_text", "_name")

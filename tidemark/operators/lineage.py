"""Claims of recordings by runs, and which results and files are current. Versions are maps from an id to a number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.shared import shared_folder

KEY = ["namespace", "value"]
CLAIM = [*KEY, "configuration_digest", "versions_key"]
#: Model ids whose versions are held in one map, and rows of a table that is broadcast.
MOST_IDS, MOST_BROADCAST = 1_000, 100_000


def versions_key(versions: Column) -> Column:
    """A sortable form of a versions map: number of ids, then pair by pair, shorter ids first."""
    pairs = F.transform(F.map_entries(versions), lambda e: F.struct(F.length(e["key"]).alias("n"), e["key"].alias("k"), e["value"].alias("v")))
    return F.struct(F.size(versions).alias("size"), F.array_sort(pairs).alias("pairs"))


def current_results(outcomes: DataFrame, runs: DataFrame) -> DataFrame:
    """The covered outcome with the greatest versions for each recording and configuration, in runs not withdrawn."""
    live = outcomes.where("state = 'covered'").join(runs.where("not withdrawn").select("run_id"), "run_id", "left_semi")
    order = Window.partitionBy(*KEY, "configuration_digest").orderBy(versions_key(F.col("output_versions")).desc(), "run_id")
    return live.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def highest_versions(outcomes: DataFrame) -> DataFrame:
    """The greatest version of each id in covered and withdrawn outcomes."""
    pairs = outcomes.where("state in ('covered', 'withdrawn')").select(F.explode("output_versions").alias("version_id", "version"))
    return pairs.groupBy("version_id").agg(F.max("version").alias("highest"))


def small(rows: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """``rows`` to be broadcast if a count shows at most ``most`` of them, else as they are."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def up_to_date(results: DataFrame, highest: DataFrame) -> DataFrame:
    """``up_to_date``: no version of the result is below the highest of its id.

    Ids are those of models, so their highest versions are one map, looked up in place; only with more than MOST_IDS of
    them the results meet them in a join.
    """
    known = highest.limit(MOST_IDS + 1).collect()
    if len(known) <= MOST_IDS:
        pairs = [F.lit(x) for row in known for x in (row["version_id"], row["highest"])]
        best = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,bigint>")
        fine = F.forall(F.map_entries("output_versions"), lambda e: e["value"] >= F.coalesce(F.try_element_at(best, e["key"]), e["value"]))
        return results.withColumn("up_to_date", fine)
    keys = ["run_id", *KEY]
    low = results.select(*keys, F.explode("output_versions").alias("version_id", "version")).join(highest, "version_id").where("version < highest").select(*keys).distinct()
    return results.join(low.withColumn("low", F.lit(True)), keys, "left").withColumn("up_to_date", F.col("low").isNull()).drop("low")


def current_files(outcomes: DataFrame, runs: DataFrame, files: DataFrame) -> DataFrame:
    results = up_to_date(current_results(outcomes, runs), highest_versions(outcomes))
    return results.drop("state", "skip_reason").join(files, ["run_id", *KEY])


def claims(requests: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Requests (run_id, created_at, claim key) that get their claim, one per key at most.

    A request is left out if its run already has an outcome for the recording or any run holds a live claim on the
    key; of simultaneous requests the earliest run wins. There must be one writer at a time.
    """
    free = requests.join(outcomes.select("run_id", *KEY), ["run_id", *KEY], "left_anti")
    free = free.join(outcomes.where("state in ('pending', 'covered')").select(*CLAIM), CLAIM, "left_anti")
    order = Window.partitionBy(*CLAIM).orderBy("created_at", "run_id")
    return free.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def skip_reasons(requests: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Requests whose key another run holds, with the reason from the holder's state."""
    held = outcomes.where("state in ('pending', 'covered')").select(*CLAIM, F.col("run_id").alias("holder"), F.col("state").alias("held"))
    reason = F.when(F.col("held") == "covered", "already_covered").otherwise("in_progress")
    return requests.join(held, CLAIM).where("holder <> run_id").select("run_id", *KEY, reason.alias("skip_reason"))


def backbone_inputs(requests: DataFrame, outcomes: DataFrame, runs: DataFrame, files: DataFrame, accepted: Column) -> DataFrame:
    """For each request its backbone's embeddings file, or why there is none. ``accepted`` is a predicate on ``uri``."""
    live = outcomes.where("state = 'covered'").join(runs.where("not withdrawn").select("run_id"), "run_id", "left_semi")
    covered = live.select(*KEY, F.col("run_id").alias("backbone_run"))
    embeddings = files.where("kind = 'embeddings'").select(F.col("run_id").alias("backbone_run"), *KEY, "uri")
    rows = requests.join(covered, KEY, "left").join(embeddings, ["backbone_run", *KEY], "left")
    reason = (
        F.when(F.col("backbone_run").isNull(), "input_not_available")
        .when(F.col("uri").isNull(), "input_has_no_windows")
        .when(~F.coalesce(accepted, F.lit(False)), "input_location_unsupported")
    )
    return rows.select("run_id", *KEY, reason.alias("skip_reason"), F.when(reason.isNull(), F.col("uri")).alias("uri"))


def task_chunks(pending: DataFrame, size: int) -> DataFrame:
    """The task of each pending recording: ``size`` recordings each, in order of the recordings of a run.

    Recordings are sorted over range partitions and numbered within each, after the run's recordings in those before,
    so a large run is not one group. The sorted rows are written, since they are read twice.
    """
    path = shared_folder(pending.sparkSession, "chunks")
    pending.repartitionByRange("run_id", *KEY).withColumn("part", F.spark_partition_id()).write.parquet(path)
    rows = pending.sparkSession.read.parquet(path)
    counts = rows.groupBy("run_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("run_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    starts = counts.select("run_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("run_id", "part").orderBy(*KEY)) - 1
    numbered = rows.withColumn("nth", nth).join(starts, ["run_id", "part"])
    return numbered.select(*pending.columns, F.floor((F.col("before") + F.col("nth")) / F.lit(size)).cast("long").alias("task"))


def presets_of(configurations: DataFrame, presets: DataFrame) -> DataFrame:
    names = presets.groupBy("configuration_digest").agg(F.array_sort(F.collect_list("name")).alias("presets"))
    return configurations.join(small(names), "configuration_digest", "left").withColumn("presets", F.coalesce("presets", F.array().cast("array<string>")))


def first_writers(entries: DataFrame) -> DataFrame:
    """Entries (name, digest, created_at, entry_id): what each writer is told and the digest that stands."""
    order = Window.partitionBy("name").orderBy("created_at", "entry_id")
    first = F.first("digest").over(order)
    outcome = F.when(F.row_number().over(order) == 1, "created").when(F.col("digest") == first, "exists").otherwise("conflict")
    return entries.select("entry_id", "name", outcome.alias("outcome"), first.alias("standing"))


def outdated_versions(runs: DataFrame, release: DataFrame) -> DataFrame:
    """Versions of runs that the release changed or lacks."""
    pairs = runs.select("run_id", F.explode("output_versions").alias("version_id", "version"))
    return pairs.join(small(release), "version_id", "left").where(~F.col("version").eqNullSafe(F.col("released"))).select("run_id", "version_id", "version", "released")

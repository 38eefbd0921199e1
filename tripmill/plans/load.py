"""The batch load: dimensions, audit, fact table, rollups and summary."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.config import Settings
from tripmill.operators import additive, clean
from tripmill.plans import contract
from tripmill.plans.tables import SavedTables
from tripmill.sources import dimensions, store
from tripmill.sources.trips import TripFiles, files_of

BULK = "bulk"
_JOBS_AT_ONCE = 4


def load(
    spark: SparkSession,
    raw: DataFrame | TripFiles,
    locations: DataFrame,
    path: str,
    settings: Settings | None = None,
    unreadable: Sequence[str] = (),
) -> SavedTables:
    """Load everything from scratch under ``path``, replacing what is there.

    ``raw`` is what ``open_trips`` gives, and then files that are broken or torn are listed in the audit as
    rejected and the others are loaded; or it is a table of trips, and ``unreadable`` names files to list.
    """
    settings = settings or Settings()
    write_dimensions(spark, locations, path)
    load_trips(spark, raw, path, settings, BULK, unreadable=unreadable)
    merge_rollups(spark, path, settings)
    return SavedTables(spark, path, raw.raw if isinstance(raw, TripFiles) else raw, settings)


def write_dimensions(spark: SparkSession, locations: DataFrame, path: str) -> None:
    tables = {
        "dim_location": locations,
        "dim_vendor": dimensions.vendors(spark),
        "dim_payment_type": dimensions.payment_types(spark),
        "dim_rate_code": dimensions.rate_codes(spark),
    }
    violations = [v for name, rows in tables.items() for v in contract.table_violations(rows, name)]
    if violations:
        raise contract.ContractError(violations)
    _write_together(tables, path)


def load_trips(
    spark: SparkSession,
    raw: DataFrame | TripFiles,
    path: str,
    settings: Settings,
    batch: str,
    unreadable: Sequence[str] = (),
) -> None:
    """Scan the files of one batch once, decide which ones to accept, write their trips, then list the files.

    The scan stages the trips that pass the filters, and the last trip of every row group, which shows that the
    file could be read to its end. The audit and the fact table are built from the staged trips. The audit comes last:
    trips of a batch it does not list are not part of the table, so a load that breaks off in between
    leaves nothing to be seen, and its files are loaded by the next one. A batch that breaks the tables' contract is
    taken back before it is listed. Files that an earlier batch lists
    are left alone, and file numbers go on from the highest one listed.
    """
    if batch != BULK and batch in store.replaced_batches(spark, path):
        return  # It is complete, and its trips lie in files shared with other batches by now.
    ids = clean.home_ids(store.read_table(spark, path, "dim_location"), settings.home)
    everything, first, pending = batch == BULK, 0, f"{path}/load_pending"
    trips, files = (raw.raw, raw.files) if isinstance(raw, TripFiles) else (raw, files_of(raw))
    if isinstance(raw, TripFiles):
        unreadable = [*raw.unreadable, *unreadable]
    earlier = None if everything else loaded_files(spark, path)
    if earlier is not None:
        earlier = earlier.filter(F.col("load_batch") != batch)
        files = clean.without_files(files, earlier)
        last = earlier.agg(F.max("file_no")).first()[0]
        first = 0 if last is None else last + 1
    files = store.stage(files, pending, f"{batch}-files")
    if files.groupBy(clean.path_key()).count().filter("count > 1").limit(1).count():
        raise ValueError("two source files share the hash of their path; load them in separate batches")
    found = store.stage(clean.candidates(trips, files, ids), pending, f"{batch}-trips")

    audit = clean.audit_candidates(files, found)
    if unreadable:
        audit = audit.unionByName(_rejected(spark, unreadable, earlier), allowMissingColumns=True)
    audit = audit.join(clean.number_files(audit, first), "source_file", "left")
    staged = store.stage(audit, pending, batch)
    valid = found.filter(F.col("is_valid")).drop("is_valid", "is_file_end")
    accepted = clean.accepted(valid, staged.filter(F.col("file_no").isNotNull()))
    if everything:
        # A table is never seen with the new trips and the old audit, or the other way round.
        store.write_audit(staged.limit(0), path, batch, True)
    store.write_fact(clean.build_fact(accepted), path, batch, everything)
    known = [] if earlier is None else [b for b in store.visible_batches(spark, path) if b != batch]
    violations = contract.batch_violations(spark, path, batch, known)
    if violations:
        # A batch that is loaded again has replaced its former trips, so it is no longer listed either.
        for table in ("load_audit", "fact_trip"):
            store.delete(spark, f"{path}/{table}/load_batch={batch}")
        raise contract.ContractError(violations)
    write_states(spark, path, batch, everything, settings.sketches)
    store.write_audit(staged, path, batch, everything)
    for name in (f"{batch}-trips", f"{batch}-files", batch):
        store.delete(spark, f"{pending}/{name}")


def _rejected(spark: SparkSession, files: Sequence[str], earlier: DataFrame | None) -> DataFrame:
    """Audit rows of files that could not be opened, without those an earlier batch lists."""
    rows = spark.createDataFrame([(f, "rejected") for f in files], "source_file string, status string")
    return rows if earlier is None else rows.join(earlier.select("source_file"), "source_file", "left_anti")


def loaded_files(spark: SparkSession, path: str) -> DataFrame | None:
    """The audit of all complete batches, or None before the first load."""
    try:
        audit = store.read_table(spark, path, "load_audit")
    except Exception as error:  # the class depends on the kind of session
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return audit


def not_loaded(files: DataFrame, path: str, batch: str) -> DataFrame:
    """The rows of ``files`` whose ``source_file`` no other complete batch lists."""
    earlier = loaded_files(files.sparkSession, path)
    return files if earlier is None else clean.without_files(files, earlier.filter(F.col("load_batch") != batch))


def write_states(spark: SparkSession, path: str, batch: str, replace_all: bool, with_sketches: bool = False) -> None:
    """Sums of one batch for the rollups, from that batch's partitions of the fact table alone."""
    trips = store.read_table(spark, path, "fact_trip").filter(F.col("load_batch") == batch)
    found = additive.states(trips, with_sketches)
    with ThreadPoolExecutor(_JOBS_AT_ONCE) as pool:
        written = [pool.submit(store.write_state, df, path, name, batch, replace_all) for name, df in found.items()]
        for job in written:
            job.result()


def merge_rollups(spark: SparkSession, path: str, settings: Settings | None = None) -> None:
    """Write the rollups and the summary from the states of all complete batches; the fact table is not read."""
    settings = settings or Settings()
    # The state of a batch outlives the compaction of its trips; states made anew belong to the batch that stands for others.
    listed = [r["load_batch"] for r in store.read_table(spark, path, "load_audit").select("load_batch").distinct().collect()]
    listed = [*listed, *store.visible_batches(spark, path), *store.replaced_batches(spark, path)]
    kept = [*additive.STATES, *(additive.SKETCHES if settings.sketches else [])]
    states = {n: store.read_state(spark, path, n).filter(F.col("load_batch").isin(listed)) for n in kept}
    routes = store.stage(additive.merged_routes(states.pop(additive.ROUTES)), path, "route_fares")
    merged = {additive.VALUES: additive.merged_values(states.pop(additive.VALUES))}
    merged |= {n: merge(states.pop(n)) for n, merge in additive.SKETCHES.items() if n in states}
    _write_together(merged | additive.merge(routes, states, settings.min_od_trips), path)


def refresh_rollups(spark: SparkSession, path: str, settings: Settings | None = None) -> None:
    """Rebuild the states of all complete batches from the stored fact table, then the rollups and the summary.

    Loads keep the states up to date and need ``merge_rollups`` only; this is for tables whose states are lost.
    """
    settings = settings or Settings()
    store.delete(spark, f"{path}/rollup_state")
    for batch in store.visible_batches(spark, path):
        write_states(spark, path, batch, False, settings.sketches)
    merge_rollups(spark, path, settings)


def _write_together(tables: dict[str, DataFrame], path: str) -> None:
    """Write independent tables at the same time, so that one's last tasks overlap the next."""
    with ThreadPoolExecutor(_JOBS_AT_ONCE) as pool:
        written = [pool.submit(store.write_table, df, path, name) for name, df in tables.items()]
        for job in written:
            job.result()

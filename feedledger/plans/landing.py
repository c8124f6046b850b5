"""JOB-3: data files land in the store and the catalog records it.

The source is a listing of paths; no content passes through Spark rows. A task copies each file in
chunks to a temporary name at its destination, computing the digest on the way, and then moves it to
its canonical path, so a half-written file is never seen there. Path, digest, status, the download
stage and a log row follow from the outcomes; a file that cannot be read fails alone.

Cases: a catalog file without a listed source has no outcome and stays as it is; of several sources
of one name the one with the least path is taken; a file lands again with the same result; a blank
root falls back to the file's own; an empty catalog or listing lands nothing.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import names as N
from ..operators import actions as A
from ..operators import policy as P
from ..operators import stages as ST
from ..session import ensure_checkpoint_dir, ship_package

OUTCOMES = "id string, filename string, source string, to string, local_hash string, bytes long, duration_ms double, error string"
CHUNK = 4 << 20


def sources(files: DataFrame, listing: DataFrame, root: str | Column) -> DataFrame:
    """(id, filename, source, to): the listed source of every catalog file and where it goes."""
    found = listing.where(N.has_data_extension("name")).groupBy(F.upper("name").alias("_name")).agg(F.min("remote_path").alias("source"))
    to = N.canonical_path(P.resolve_directory(root if isinstance(root, Column) else F.lit(root), F.col("root_path")), "catalog", "state", "year", "month", "filename", ".dbc")
    return files.join(found, files["filename"] == found["_name"]).select("id", "filename", "source", to.alias("to"))


def land(files: DataFrame, listing: DataFrame, root: str | Column, chunk: int = CHUNK) -> DataFrame:
    """Copy every file with a listed source (``scan.list_directories`` columns) to its canonical path;
    one outcome a file, checkpointed, so that copying happens once."""
    spark = files.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)

    def run(batches):
        import pandas as pd

        from ..sources import fsio

        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                t0, digest, size, error = time.perf_counter(), None, None, None
                try:
                    digest, size = fsio.copy_with_digest(row.source, row.to, chunk)
                except Exception as e:  # noqa: BLE001 -- one bad file must not fail the others
                    error = f"{type(e).__name__}: {e}"
                rows.append((*row, digest, size, (time.perf_counter() - t0) * 1000.0, error))
            out = pd.DataFrame(rows, columns=["id", "filename", "source", "to", "local_hash", "bytes", "duration_ms", "error"])
            out["bytes"] = out["bytes"].astype("Int64")
            yield out

    todo = sources(files, listing, root).repartition("id")
    return todo.mapInPandas(run, OUTCOMES).checkpoint(eager=True)


def record_landing(files: DataFrame, stages: DataFrame, outcomes: DataFrame, as_of) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The next files, stages and log rows: path, digest, status ``downloaded`` and a done stage for a
    file that landed; status ``failed`` and the error for one that did not."""
    ok = F.col("error").isNull()
    changes = outcomes.select("id", F.when(ok, "downloaded").otherwise("failed").alias("overall_status"), F.when(ok, F.col("to")).alias("dbc_path"), "local_hash")
    events = outcomes.select(F.col("id").alias("file_id"), F.lit("download").alias("stage"), F.when(ok, "completed").otherwise("failed").alias("event_type"),
                             F.col("error").alias("message"), S.ts_lit(as_of).alias("created_at"), F.lit(0).cast("long").alias("id"))
    told = outcomes.withColumnRenamed("id", "file_id")
    done = F.format_string("downloaded in %.1fs, sha256=%s", F.col("duration_ms") / 1000, F.substring("local_hash", 1, 8))
    payload = F.struct(F.col("local_hash").alias("hash"), "duration_ms", F.col("to").alias("path"), "bytes")
    logs = A.log_rows(told.where(ok), "download", "completed", done, as_of, payload).unionByName(A.log_rows(told.where(~ok), "download", "failed", F.col("error"), as_of))
    return A.apply_file_changes(files, changes, as_of), ST.apply_stage_events(stages, events), logs

"""STM-1: listings merged batch by batch into the bucketed catalog (UPD-14, UPD-3, JOIN-9).

A batch reads the groups that its parsed names fall into, merges the listing with them
(``scan.merge_scan``, which decides name by name), folds the change into the report cells as a signed
delta, and overwrites those groups. What a listing costs depends on what it lists, not on the catalog.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import names as N
from ..operators import maintained as M
from ..operators import policy as P
from ..operators import scan as SC
from ..sources.bucketed import Catalog, name_group, set_conf, without_group
from .jobs import checkpoint_location, consume

#: A listing joins the files' buckets on the name alone, though it also compares the directory.
_CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def touched_groups(catalog: Catalog, listing: DataFrame, as_of_year: int) -> list[int]:
    """The groups of the listing's data files: at most ``catalog.groups`` numbers. The names are judged
    in the aggregate: as a filter, the parse would be repeated for each of its uses in every check."""
    parsed = N.with_parsed_name(listing.where(N.has_data_extension("name")), "name", as_of_year, "_p")
    judged = parsed.groupBy(name_group("name", catalog.groups).alias("g")).agg(F.bool_or(F.col("_p.error").isNull()).alias("_named"))
    return sorted(r["g"] for r in judged.where("_named").collect())


def merge_listing(catalog: Catalog, listing: DataFrame, policy: P.Policy | None, as_of, as_of_year: int, batch: int) -> None:
    """Merge one listing as batch number ``batch``; one that was applied changes nothing."""
    if catalog.applied(batch):
        return
    if not catalog.staged(batch):
        groups = touched_groups(catalog, listing, as_of_year)
        with set_conf(catalog.spark, _CO_PARTITION, "false"):
            old = {name: without_group(catalog.read(name, groups), schema) for name, (schema, _) in Catalog.TABLES.items() if name != "cells"}
            res = SC.merge_scan(old["files"], old["stages"], old["queue"], listing, policy, as_of, as_of_year, checkpoint=True)
            files = res.files.select(*S.FILES.fieldNames(), name_group("filename", catalog.groups).alias("g"))
            ids = files.select(F.col("id").alias("_id"), "g")
            grouped = lambda rows: rows.join(ids, F.col("file_id") == F.col("_id")).drop("_id")
            delta = M.signed_delta(catalog.read("files", groups), files, ["g"])
            cells = M.folded(catalog.read("cells", groups), delta, ["g"])
            catalog.stage(batch, {"files": files, "stages": grouped(res.stages), "queue": grouped(res.queue), "cells": cells}, res.summary)
    catalog.apply(batch)


def start_landing(spark: SparkSession, listing_dir: str, root: str, policy_fn: Callable[[SparkSession], P.Policy | None], as_of_fn,
                  as_of_year: int, available_now: bool = True, max_files: int | None = None, groups: int | None = None):
    """STM-1: a file stream of listing snapshots (Parquet with the LISTING schema) merged batch by batch."""
    how = {} if groups is None else {"groups": groups}

    def run(batch: DataFrame, batch_id: int) -> None:
        catalog = Catalog(batch.sparkSession, root, **how)
        if catalog.applied(batch_id):
            consume(batch)
            return
        merge_listing(catalog, batch, policy_fn(batch.sparkSession), as_of_fn(), as_of_year, batch_id)

    r = spark.readStream.schema(S.LISTING)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    w = r.parquet(listing_dir).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location(root, "landing"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()

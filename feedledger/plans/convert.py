"""Bulk conversion of compressed record files to TSV and Parquet (SRC-4, SNK-1/2/6, PRJ-6,
JOB-1..4, MATH-3) as one Spark job over all planned files.

Plan:
1. list the files (``binaryFile`` without ``content``; only path/length/time are read);
2. spread files over tasks (explicit ``repartition(n)``, so AQE does not fold the tiny listing
   into one task) -- a compressed body is one sequential stream, so the unit of parallelism is
   the file;
3. ``mapInPandas`` reads each file, parses its header, decompresses the body and emits one row
   per record (raw bytes) in bounded batches, plus one status row per file;
4. the decoded rows are written once as a Parquet table partitioned by (kind, layout signature)
   under the cluster's checkpoint folder (lineage cut, decoded once, survives executor loss; each
   layout is later read with partition pruning);
5. per distinct field layout (a handful; collected as a tiny list) the fields are cut out of the
   record bytes with ``substring`` + ``decode`` in Catalyst, rendered as text (STR-12), and
   written with ``partitionBy(catalog, state, year, month, file)`` -- the Spark form of the
   canonical ``{root}/{catalog}/{state}/{yyyy}/{mm}/{base}`` layout -- with dynamic partition
   overwrite, so re-running a file replaces only its own output.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import names as N
from ..functions import text as TX
from ..operators import policy as P
from ..session import ensure_checkpoint_dir, ship_package
from ..sources import dbc
from ..sources.fsio import read_bytes as _read_bytes

DECODED_SCHEMA = (
    "path string, catalog string, state string, year string, month string, file string, "
    "kind string, sig string, meta string, rec_index long, rec binary, error string, decode_ms double, n_records long"
)
PART_COLS = ["catalog", "state", "year", "month", "file"]
RECORD_BATCH = 65536




def _decode_iter(batches, encoding: str, record_batch: int = RECORD_BATCH, chunk: int = 1 << 20):
    import pandas as pd

    cols = ["path", *PART_COLS, "kind", "sig", "meta", "rec_index", "rec", "error", "decode_ms", "n_records"]
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            path = row.path
            parts = {c: getattr(row, c) for c in PART_COLS}  # parsed once per file, in Catalyst
            t0 = time.perf_counter()
            sig = None
            done = 0
            try:
                data = _read_bytes(path)
                h = dbc.parse_header(data, encoding)
                sig = h.signature()
                size = h.record_len
                limit = h.n_records
                pending = bytearray()
                batch: list[bytes] = []

                def flush(recs, first):
                    return pd.DataFrame({
                        "path": path, **parts, "kind": "record", "sig": sig, "meta": None,
                        "rec_index": range(first, first + len(recs)), "rec": recs, "error": None,
                        "decode_ms": None, "n_records": None,
                    }, columns=cols)

                # decompress incrementally and cut records from a bounded buffer
                for piece in dbc.explode_chunks(data, h.header_len + 4, chunk):
                    pending += piece
                    whole = len(pending) // size
                    whole = min(whole, limit - done - len(batch))
                    if whole > 0:
                        batch.extend(bytes(pending[i * size:(i + 1) * size]) for i in range(whole))
                        del pending[:whole * size]
                    if len(batch) >= record_batch:
                        yield flush(batch, done)
                        done += len(batch)
                        batch = []
                if batch:
                    yield flush(batch, done)
                    done += len(batch)
                if done < limit:
                    raise ValueError(f"body holds {done} of {limit} records")
                if bytes(pending) not in (b"", b"\x1a"):
                    raise ValueError(f"{len(pending)} bytes follow the last of {limit} records")
                ms = (time.perf_counter() - t0) * 1000.0
                yield pd.DataFrame([[path, *parts.values(), "file", sig, h.fields_json(), None, None, None, ms, done]],
                                   columns=cols)
            except Exception as e:  # noqa: BLE001 -- one bad file must not fail the others
                ms = (time.perf_counter() - t0) * 1000.0
                yield pd.DataFrame([[path, *parts.values(), "file", sig, None, None, None, f"{type(e).__name__}: {e}", ms, 0]],
                                   columns=cols)


def decode_files(paths: DataFrame, encoding: str = "iso-8859-1", tasks: int | None = None,
                 path_col: str = "path", record_batch: int = RECORD_BATCH, chunk: int = 1 << 20,
                 as_of_year: int = 2026) -> DataFrame:
    """SRC-4 steps 2-4: decoded records + one status row per file, checkpointed."""
    spark = paths.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    p = with_file_parts(paths.select(F.col(path_col).alias("path")).distinct(), as_of_year)  # one row per file: name parsing runs once per file
    n = tasks or max(1, spark.sparkContext.defaultParallelism * 2)
    spread = p.repartition(n)
    decoded = spread.mapInPandas(lambda it: _decode_iter(it, encoding, record_batch, chunk), DECODED_SCHEMA)
    # written once as a table partitioned by (kind, layout) in the shared checkpoint folder: the
    # lineage is cut, and each layout's writer later reads only its own partition
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/feedledger-decoded-{uuid.uuid4().hex[:12]}"
    decoded.write.partitionBy("kind", "sig").parquet(path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------------- fields and names


def sanitize_name(name: str) -> str:
    """PRJ-6: keep [A-Za-z0-9_], everything else becomes '_'; blank -> 'column'."""
    if not name:
        return "column"
    return "".join(ch if (ch.isascii() and (ch.isalnum() or ch == "_")) else "_" for ch in name)


def normalize_columns(names: list[str]) -> list[str]:
    """PRJ-6: sanitised, unique names; repeats get _1, _2, ... and a suffix that is already
    taken is skipped, so the result is always unique (Spark rejects duplicate columns)."""
    out: list[str] = []
    used: set[str] = set()
    counts: dict[str, int] = {}
    for raw in names:
        base = sanitize_name(raw) or "column"
        name = base
        if name in used:
            k = counts.get(base, 0)
            while True:
                k += 1
                name = f"{base}_{k}"
                if name not in used:
                    break
            counts[base] = k
        used.add(name)
        out.append(name)
    return out


def field_text(rec: Column, offset: int, length: int, ftype: str, encoding: str) -> Column:
    """One field of a record as text (STR-12): C trimmed; N/F as plain numbers (unparseable
    text kept trimmed); L as true/false; D as yyyy-MM-dd; blank -> ''."""
    raw = F.trim(F.decode(F.substring(rec, offset + 1, length), encoding))
    t = ftype.upper()
    if t in ("N", "F"):
        num = raw.try_cast("double")
        return F.when(raw == "", F.lit("")).when(num.isNull(), raw).otherwise(TX.number_to_text(num))
    if t == "L":
        u = F.upper(raw)
        return F.when(u.isin("T", "Y"), F.lit("true")).when(u.isin("F", "N"), F.lit("false")).otherwise(F.lit(""))
    if t == "D":
        d = F.try_to_timestamp(raw, F.lit("yyyyMMdd"))
        return F.when(raw == "", F.lit("")).otherwise(F.coalesce(F.date_format(d, "yyyy-MM-dd"), raw))
    return raw


def layout_columns(fields: list, encoding: str, names: list[str]) -> list[Column]:
    cols = []
    off = 1  # byte 0 is the deletion flag
    for (fname, ftype, length, _dec), out_name in zip(fields, names):
        cols.append(field_text(F.col("rec"), off, length, ftype, encoding).alias(out_name))
        off += length
    return cols


def with_file_parts(paths: DataFrame, as_of_year: int = 2026) -> DataFrame:
    """path and the partition columns from its file name (SNK-3 layout). The name is parsed in stages:
    in one expression every part would repeat every check."""
    named = N.with_parsed_name(paths.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("_name")), "_name", as_of_year, "_p")
    return named.select("path", F.col("_p.catalog").alias("catalog"), F.col("_p.state").alias("state"), F.format_string("%04d", F.col("_p.year")).alias("year"),
                        F.format_string("%02d", F.col("_p.month")).alias("month"), F.upper(N.base_name("_name")).alias("file"))


# ------------------------------------------------------------------------------------ the job


@dataclass
class ConversionResult:
    outcomes: DataFrame  # one row per input file
    layouts: list  # (sig, fields) per distinct layout
    tables: dict  # sig -> DataFrame of text columns (+ partition columns)


def convert(paths: DataFrame, tsv_root: str | None = None, parquet_root: str | None = None,
            encoding: str = "iso-8859-1", keep_deleted: bool = False, as_of_year: int = 2026,
            tasks: int | None = None, path_col: str = "path", decode_opts: dict | None = None) -> ConversionResult:
    """JOB-1 / JOB-2: convert every listed file; write TSV and/or Parquet when roots are given.

    Outcome rows carry path, file, layout signature, records, error, decode time and rows/s.
    """
    decoded = decode_files(paths, encoding, tasks, path_col, as_of_year=as_of_year, **(decode_opts or {}))
    status = decoded.where(F.col("kind") == "file")
    layouts = [(r["sig"], json.loads(r["meta"])) for r in
               status.where(F.col("error").isNull()).select("sig", "meta").distinct().collect()]
    tables = {}
    for sig, fields in layouts:
        # records of a file that failed part-way are dropped with the file (semi join on the
        # status rows of the files that decoded cleanly: one small row per file)
        ok_files = status.where(F.col("error").isNull() & (F.col("sig") == sig)).select("path")
        recs = decoded.where((F.col("kind") == "record") & (F.col("sig") == sig)).join(ok_files, "path", "left_semi")
        if not keep_deleted:
            recs = recs.where(F.substring("rec", 1, 1) != F.unhex(F.lit("2A")))
        raw_names, parts = [f[0] for f in fields], PART_COLS
        pq_names = normalize_columns(raw_names)
        tsv_names = raw_names if len(set(raw_names)) == len(raw_names) and all(raw_names) else pq_names
        # a file without a record to keep has no row below: its artifact is the header alone
        bare = ok_files.join(recs.select("path").distinct(), "path", "left_anti").join(status.select("path", *parts), "path") if parquet_root or tsv_root else None
        # one writer and one output file for every source file
        ordered = recs.repartition(*parts).sortWithinPartitions("file", "rec_index") if parquet_root or tsv_root else recs
        if parquet_root:
            staging = _staging(decoded.sparkSession)
            (ordered.select(*parts, *layout_columns(fields, encoding, pq_names)).write
             .option("compression", "snappy")
             .option("parquet.block.size", 134217728)
             .option("parquet.page.size", 8192)
             .option("parquet.enable.dictionary", "true")
             .partitionBy(*parts)
             .parquet(staging))
            publish(decoded.sparkSession, staging, parquet_root, ".parquet")
            write_headers(bare, pq_names, parquet_root, ".parquet")
        if tsv_root:
            staging = _staging(decoded.sparkSession)
            (ordered.select(*parts, *layout_columns(fields, encoding, tsv_names)).write
             .option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
             .option("emptyValue", "").option("nullValue", "")
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .partitionBy(*parts)
             .csv(staging))
            publish(decoded.sparkSession, staging, tsv_root, ".csv")
            write_headers(bare, tsv_names, tsv_root, ".csv")
        tables[sig] = recs.select(*parts, "rec_index", *layout_columns(fields, encoding, pq_names))
    outcomes = status.select(
        "path", F.upper(N.base_name(F.regexp_extract("path", r"([^/]*)$", 1))).alias("file"), "sig",
        F.col("n_records").alias("records"), "error", F.round("decode_ms", 3).alias("decode_ms"),
        F.round(F.try_divide(F.col("n_records") * 1000.0, F.col("decode_ms")), 1).alias("rows_per_sec"),
        F.col("error").isNull().alias("ok"),
    )
    return ConversionResult(outcomes, layouts, tables)


def _staging(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/feedledger-staging-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, staging: str, root: str, ext: str) -> None:
    """SNK-1..3: move the committed part file of every source file to its canonical path. The moves
    run in tasks; a task that is repeated finds its source gone and leaves what it has published."""
    parts = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(staging).select("path"))
    at = {c: F.regexp_extract("path", f"/{c}=([^/]*)/", 1) for c in PART_COLS}
    moves = parts.select("path", N.canonical_path(root, at["catalog"], at["state"], at["year"].cast("int"), at["month"].cast("int"),
                                                  F.concat(at["file"], F.lit(ext)), ext).alias("to"))

    def run(batches):
        from ..sources import fsio

        for pdf in batches:
            for src, dst in zip(pdf["path"], pdf["to"]):
                try:
                    fsio.move(src, dst)
                except FileNotFoundError:
                    pass
            yield pdf[["to"]]

    moves.mapInPandas(run, "to string").write.format("noop").mode("overwrite").save()


def header_bytes(names: list[str], ext: str) -> bytes:
    """A TSV or Parquet file with these text columns and no rows."""
    if ext == ".csv":
        quoted = ('"' + n.replace('"', '""') + '"' if any(c in n for c in '\t"\r\n') else n for n in names)
        return ("\t".join(quoted) + "\n").encode()
    import pyarrow as pa
    import pyarrow.parquet as pq

    out = pa.BufferOutputStream()
    pq.write_table(pa.table({n: pa.array([], pa.string()) for n in names}), out, compression="snappy")
    return out.getvalue().to_pybytes()


def write_headers(files: DataFrame, names: list[str], root: str, ext: str) -> None:
    """SNK-1 / SNK-2: the artifact of every file (PART_COLS) that has no record, in tasks."""
    to = files.select(N.canonical_path(root, "catalog", "state", F.col("year").cast("int"), F.col("month").cast("int"), F.concat("file", F.lit(ext)), ext).alias("to"))
    data = header_bytes(names, ext)

    def run(batches):
        from ..sources import fsio

        for pdf in batches:
            for path in pdf["to"]:
                fsio.put(path, data)
            yield pdf

    to.mapInPandas(run, "to string").write.format("noop").mode("overwrite").save()


#: What a finished conversion leaves in the catalog: status, path column, extension.
READY = {"csv_conversion": ("csv_ready", "csv_path", ".csv"), "parquet_conversion": ("parquet_ready", "parquet_path", ".parquet")}


def record_conversion(files: DataFrame, stages: DataFrame, outcomes: DataFrame, stage: str, root: str | Column, as_of,
                      blocked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """JOB-1 / JOB-2 / JOB-4: the next files and stages after a conversion. A converted file gets its
    canonical path, the ready status and a done stage; a failed one the failed status and its error;
    a file that the policy blocked becomes ignored."""
    from ..operators import actions as A
    from ..operators import stages as ST

    status, column, ext = READY[stage]
    seen = outcomes.groupBy(F.col("path").alias("_path")).agg(F.bool_and("ok").alias("_ok"), F.max("error").alias("_error"))
    keyed = files.join(seen, F.regexp_replace("dbc_path", "^file:/*", "/") == F.regexp_replace("_path", "^file:/*", "/"))
    to = N.canonical_path(root, "catalog", "state", "year", "month", "filename", ext)
    changes = keyed.select("id", F.when(F.col("_ok"), F.lit(status)).otherwise(F.lit("failed")).alias("overall_status"), F.when(F.col("_ok"), to).alias(column))
    if blocked is not None:
        changes = changes.unionByName(blocked.select("id", F.lit("ignored").alias("overall_status"), F.lit(None).cast("string").alias(column)))
    events = keyed.select(F.col("id").alias("file_id"), F.lit(stage).alias("stage"), F.when(F.col("_ok"), F.lit("completed")).otherwise(F.lit("failed")).alias("event_type"),
                          F.col("_error").alias("message"), S.ts_lit(as_of).alias("created_at"), F.lit(0).cast("long").alias("id"))
    return A.apply_file_changes(files, changes, as_of), ST.apply_stage_events(stages, events)


def convert_admitted(files: DataFrame, policy: P.Policy | None, **kwargs) -> tuple[ConversionResult, DataFrame]:
    """JOB-4 + JOB-1/2: only admitted files with a data path are converted; denied files are
    returned for the ignored status update."""
    flagged = files if policy is None else P.policy_allows(files, policy)
    allowed = F.lit(True) if policy is None else F.col("allowed")
    has_path = F.col("dbc_path").isNotNull() & (F.trim("dbc_path") != "")
    todo = flagged.where(allowed & has_path).select(F.col("dbc_path").alias("path"))
    blocked = flagged.where(~allowed).select("id")
    return convert(todo, **kwargs), blocked


def land_inventory(spark: SparkSession, landing: str | list[str], files: DataFrame, root: str = "/data",
                   recursive: bool = True) -> DataFrame:
    """JOB-3 (re-aimed): match files already present in a mounted landing area to the catalog by
    file name and record their path and sha256 digest (SNK-6). Network copying is not built."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    land = reader.load(landing if isinstance(landing, list) else [landing])
    found = land.select(
        F.regexp_replace("path", "^file:", "").alias("local_path"),
        F.upper(F.regexp_extract("path", r"([^/]*)$", 1)).alias("filename"),
        N.content_digest("content").alias("local_hash"),
        F.col("length").alias("local_size"),
    ).where(N.has_data_extension("filename"))
    keyed = files.select("id", "filename", "catalog", "state", "year", "month")
    return keyed.join(found, "filename", "inner").select(
        "id", "filename", "local_path", "local_hash", "local_size",
        N.canonical_path(root, "catalog", "state", "year", "month", "filename", ".dbc").alias("expected_path"),
    )


def outcome_log_rows(outcomes: DataFrame, files: DataFrame, stage: str, as_of) -> DataFrame:
    """JOB-1/JOB-2 logging (SNK-4): one 'completed' or 'failed' log row per converted file with
    duration and record count in the JSON payload; files are matched to the catalog by data path."""
    from ..operators import actions as A

    keyed = outcomes.join(files.select(F.col("id").alias("file_id"), F.col("dbc_path").alias("path")), "path", "inner")
    rows = []
    for ok, event, message in ((True, "completed", "conversion completed"), (False, "failed", None)):
        part = keyed.where(F.col("ok") == ok)
        msg = F.lit(message) if message else F.col("error")
        rows.append(A.log_rows(part, stage, event, msg, as_of,
                               F.struct(F.col("decode_ms").alias("duration_ms"), "records", "rows_per_sec")))
    return rows[0].unionByName(rows[1])

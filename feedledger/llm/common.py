"""Helpers shared by the operators: stored intermediates, native text expressions, let-binding."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: The six characters that separate words.
WS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application below the session's shared checkpoint folder.

    It is removed when the driver process ends (results are lazy and may read it until then).
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{app}-{uuid.uuid4().hex[:8]}"
        _ROOTS[app] = root
        atexit.register(_remove, spark, root)
    return _ROOTS[app]


def _remove(spark: SparkSession, root: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None:  # the session has ended; the cluster's folder policy takes over
        return
    try:
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the JVM may already be gone at interpreter exit
        pass


def new_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that hold for what runs inside."""
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: it is computed once, its
    lineage is cut, and no lost executor takes part of it away. What was shuffled for it is removed
    when it is written, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(df: DataFrame) -> None:
    """Remove a table of ``stored`` that nothing reads any more."""
    _remove(df.sparkSession, df._stored_at)


_KEPT: dict = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What a worker process keeps from task to task: that of the last operator that ran in it."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Drop what an earlier operator left in this worker process and give the memory back to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    _KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


#: What an executor and its Python workers hold of a task's rows at once, in ``small_batches``.
_SMALL = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside passes rows to Python in small Arrow batches, for rows of many bytes: a batch
    lies in the executor's memory beside the heap, and once more in the worker."""
    with _set(spark, _SMALL):
        yield


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to clash with no column."""
    used, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a lambda variable is never inlined again)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Array of the words of a text (null or no word: empty array)."""
    flat = F.btrim(F.translate(F.coalesce(c, F.lit("")), WS, " " * len(WS)), F.lit(" "))
    return let(flat, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " +")))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus`` (null id: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


#: Bytes of text whose words are told apart at once.
SLICE_BYTES = 6 << 20


def slices(texts, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) of neighbouring texts of a binary array, of about ``limit`` bytes together."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield at, to
        at = to


def distinct_words(texts, lower: bool = True) -> tuple:
    """(bounds, which, names) of a binary array without nulls: text i has the words
    names[which[bounds[i]: bounds[i + 1]]], names an array with each once; ``lower`` lower-cases A-Z."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    shown = texts.view(pa.string())  # nothing here looks beyond ASCII
    lists = pc.ascii_split_whitespace(pc.ascii_lower(shown) if lower else shown)
    coded = lists.values.dictionary_encode()
    names, which, bounds = coded.dictionary, coded.indices.to_numpy(), lists.offsets.to_numpy()
    empty = pc.index(names, "").as_py()
    if empty >= 0:  # before a first and after a last separator
        real = which != empty
        bounds = np.append(0, np.cumsum(real))[bounds]
        which = which[real]
        which = which - (which > empty)
        names = pa.concat_arrays([names[:empty], names[empty + 1:]])
    return bounds, which, names

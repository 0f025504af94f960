"""Reading inputs and keeping intermediate tables for the llm operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import demandlake
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.sources import storage

#: Words are runs of anything but space, tab, newline, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


#: File names that are sent to the rows; more of them are joined.
SENT_FILES = 50_000

#: Bytes of an Arrow batch that a task sends to Python.
BATCH_BYTES = 4 << 20

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package's sources to the Python workers, once per
    application, through Spark's own file distribution."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(demandlake.__file__).parent
    path = Path(tempfile.mkdtemp()) / "demandlake_sources.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def frugal(spark: SparkSession) -> Iterator[None]:
    """While a table is written: Arrow batches of BATCH_BYTES at most, so that
    rows on their way to Python take little memory however long the texts are
    (by default a batch is 10,000 of them, or 64 MB), and shuffle files that go
    with the write instead of staying until the driver collects its garbage.
    Smaller batches that the session asks for stay."""
    size, gone = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    first = {c: spark.conf.get(c) for c in (size, gone)}
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(size, str(min(as_bytes(first[size]), BATCH_BYTES)))
    spark.conf.set(gone, "true")
    try:
        yield
    finally:
        for c, v in first.items():
            spark.conf.set(c, v)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives
    a lost executor, and later scans read only the columns they need."""
    ship(df.sparkSession)
    path = storage.scratch_path(df.sparkSession, f"llm-{name}")
    with frugal(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*kept: DataFrame) -> None:
    """Delete tables written by ``keep`` that nothing will read again: what was
    made of them has been written itself."""
    for df in kept:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/llm-" in folder:
                storage.remove(df.sparkSession, folder)


def located(df: DataFrame, name: str) -> DataFrame:
    """The columns of ``df`` by position (c0, c1, ...) and ``row``, a locator
    that is the same whenever the rows are read again.

    Rows that come straight from files are located by file and place there,
    so nothing is copied; other frames are written first."""
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]
    try:
        at = df.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    except AnalysisException:
        at = None
    if at is None or "_metadata" in df.columns:
        return keep(df.select(*columns, F.monotonically_increasing_id().alias("row")), name)
    files = sorted(r["file"] for r in at.select("file").distinct().collect())  # the listing, which the driver holds anyway
    numbers = df.sparkSession.createDataFrame([(f, i << 40) for i, f in enumerate(files)], "file string, start long")
    if len(files) <= SENT_FILES:  # a local list has no size that Spark knows
        numbers = F.broadcast(numbers)
    return at.join(numbers, "file").select(*[f"c{i}" for i in range(len(df.columns))], (F.col("start") + F.col("place")).alias("row"))


def without(df: DataFrame, located_rows: DataFrame, lost: DataFrame, name: str) -> DataFrame:
    """``df`` less the rows of ``lost(row)``.  The locators are written, so
    Spark knows their size before it chooses between sending them to the texts
    and moving the texts."""
    left = located_rows.join(keep(lost.select("row"), name), "row", "left_anti")
    return left.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])


def lower_ascii(c: Column) -> Column:
    """A-Z only, whatever the locale."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def n_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Elements that ``running`` sums in one go.
RUN_BLOCK = 64


def running(x: Column, start: Column | None = None, levels: int = 2) -> Column:
    """For each element of an array of integers the sum of all before it.

    An array cannot be grown in place, so a plain fold copies it for each
    element; here blocks are folded, and their totals are summed by the same
    rule, so the cost is linear up to tens of millions of elements."""
    start = F.lit(0).cast("int") if start is None else start

    def fold(part: Column, first: Column) -> Column:
        begin = F.struct(first.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, v: F.struct((acc["at"] + v).cast("int").alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(part, begin, step, lambda acc: acc["out"])

    if not levels:
        return fold(x, start)

    def by_blocks(a: Column) -> Column:
        last = F.floor((F.size(a) - 1) / RUN_BLOCK).cast("int")
        return let(F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * RUN_BLOCK + 1, RUN_BLOCK)), sums)

    def sums(blocks: Column) -> Column:
        total = lambda p: F.aggregate(p, F.lit(0).cast("int"), lambda acc, v: (acc + v).cast("int"))
        return F.flatten(F.zip_with(blocks, running(F.transform(blocks, total), start, levels - 1), fold))

    return let(x, lambda a: F.when(F.size(a) <= RUN_BLOCK, fold(a, start)).otherwise(by_blocks(a)))


def most_frequent(counted: DataFrame, limit: int) -> DataFrame:
    """The rows of largest ``n``, whole classes of counts, ``limit`` at most.
    The cut comes from a histogram of log-spaced classes (under 600), so no
    task sends its own top rows to the driver."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    seen, cut = 0, None
    for r in sorted(counted.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        seen += r["count"]
        if seen > limit:
            break
        cut = r["step"]
    return counted.where(step >= cut) if cut is not None else counted.limit(0)

"""Helpers the operators share: tables, staging, code shipping, folds, words and hashes."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.session import own_scratch, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, as a zip of its sources, and batches
    of fewer rows and of at most 16 MB."""
    if spark.conf.get(ARROW_ROWS) == "10000":  # Spark's default; texts may be long
        spark.conf.set(ARROW_ROWS, "2000")
    if int(re.sub("[^0-9]", "", spark.conf.get(ARROW_BYTES))) > 1 << 24:
        spark.conf.set(ARROW_BYTES, str(1 << 24))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="celluloid-code-")) / "celluloid_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared scratch folder and read them back: one evaluation, lineage cut."""
    spark = df.sparkSession
    own_scratch(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what was made from them is staged itself."""
    for staged_rows in tables:
        spark = staged_rows.sparkSession
        files = staged_rows.inputFiles()
        if files:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def spread(*columns: str) -> Column:
    """A fixed pseudo-random order that depends on the row's values alone."""
    return F.xxhash64(*columns, F.lit(20_011))


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """At most ``rows`` rows, the same ones in every run. Rows are thinned by hash first, so that no
    task or driver gets more than about ``rows``, however many partitions there are."""
    total = df.count()
    if total > rows:
        share = (rows + 8 * rows**0.5 + 16) / total
        df = df.where(F.pmod(spread(*keys), F.lit(1 << 31)) < share * (1 << 31))
    return df.orderBy(spread(*keys), *keys).limit(rows)


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; bytes.split() parts at exactly the six characters of ``WORD``."""
    return text.encode().split() if text else []


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


class WordHashes:
    """64-bit hashes of a text's words, for all words at once: a polynomial over random numbers of the
    bytes, taken from running sums and shifted back to the word's start (the base is odd, so it has an
    inverse)."""

    def __init__(self, seed: int = 20_011):
        random = np.random.default_rng(seed)
        self.letters = random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(random.integers(1 << 61, 1 << 62)) * 2 + 1
        self._lay(1 << 14)

    def _lay(self, size: int) -> None:
        self.powers, self.inverses = (_powers(b, size) for b in (self.base, pow(self.base, -1, 1 << 64)))

    def of(self, data: bytes) -> np.ndarray:
        """Hashes of the words in UTF-8 data, in their order."""
        if not data:
            return np.zeros(0, dtype=np.uint64)
        letters = np.frombuffer(data, dtype=np.uint8)
        if len(letters) > len(self.powers):
            self._lay(2 * len(letters))
        edges = np.flatnonzero(np.diff(_SPACE.take(letters), prepend=True, append=True))  # starts and ends in turn
        running = np.zeros(len(letters) + 1, dtype=np.uint64)
        np.cumsum(self.letters.take(letters) * self.powers[: len(letters)], out=running[1:])
        starts, ends = edges[::2], edges[1::2]
        return mix((running[ends] - running[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

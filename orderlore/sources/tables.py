"""Where the input tables come from, and where files of a run go."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlore.sources.schemas import TABLE_SCHEMAS


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLE_SCHEMAS[name]])


class Tables(Mapping[str, DataFrame]):
    """Named input tables, opened on first use and given their declared schema."""

    def __init__(self, openers: Mapping[str, Callable[[], DataFrame]]):
        self._openers = dict(openers)
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = conform(self._openers[name](), name)
        return self._opened[name]

    def __iter__(self):
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    @classmethod
    def of(cls, **frames: DataFrame) -> "Tables":
        """Any DataFrames: views, other catalogs, other databases."""
        return cls({name: (lambda df=df: df) for name, df in frames.items()})

    @classmethod
    def parquet(cls, spark: SparkSession, folder: str) -> "Tables":
        """``folder/<table>.parquet``, read with the declared schemas."""
        return cls(
            {
                name: (lambda name=name: spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet"))
                for name in TABLE_SCHEMAS
            }
        )

    def stored(self, folder: str) -> "Tables":
        """All tables written once as Parquet below ``folder`` and read from there."""
        for name in self:
            self[name].write.parquet(f"{folder}/{name}.parquet")
        spark = next(iter(self.values())).sparkSession
        return Tables.parquet(spark, folder)

    @classmethod
    def catalog(cls, spark: SparkSession, prefix: str = "") -> "Tables":
        """Tables or views of the session catalog, e.g. bucketed by ``user_id``."""
        return cls({name: (lambda name=name: spark.table(prefix + name)) for name in TABLE_SCHEMAS})

    @classmethod
    def jdbc(
        cls,
        spark: SparkSession,
        options: Mapping[str, str],
        split: Mapping[str, tuple[str, int, int, int]] | None = None,
        names: Mapping[str, str] | None = None,
    ) -> "Tables":
        """A database. ``split`` maps a table to (numeric column, lower, upper, parts),
        so that it is read by many tasks; ``names`` maps our names to remote ones."""

        def opener(name: str) -> Callable[[], DataFrame]:
            reader = spark.read.format("jdbc").options(**options).option("dbtable", (names or {}).get(name, name))
            if split and name in split:
                column, low, high, parts = split[name]
                reader = reader.options(
                    partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
                )
            return reader.load

        return cls({name: opener(name) for name in TABLE_SCHEMAS})


def remote_query(
    spark: SparkSession,
    options: Mapping[str, str],
    query: str,
    columns: Mapping[str, str],
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A query run by another database, its result given declared column types.

    ``split``, a numeric column with lower bound, upper bound and parts, lets many tasks read.
    """
    reader = spark.read.format("jdbc").options(**options)
    if split:
        column, low, high, parts = split
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
        ).option("dbtable", f"({query}) q")
    else:
        reader = reader.option("query", query)
    result = reader.load()
    return result.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns.items()])


#: Folders handed out inside of open ``scratch`` blocks, the innermost last.
_open: list[list[str]] = []


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/runs"
    return root.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that the session names for checkpoints.

    All executors must reach it. A session that names none gets a folder
    beside its saved tables, in the warehouse, which they reach as well.
    """
    path = f"{_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def materialise_at(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``materialise``, and the path, for results that are discarded when later ones replace them."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate once as Parquet and go on from the files.

    For results that several jobs read: unlike a cache it survives lost
    executors, and unlike a plan it is computed once.
    """
    return materialise_at(df, purpose)[0]


def _place(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediates, wherever its file system is. What is gone already is no error."""
    place, files = _place(spark, path)
    files.delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[str], None]]:
    """Intermediates written inside of the block are removed at its end, also after an error.

    The block is given a function that takes the paths to keep. Results that are still to be computed must not read
    what is removed: write them inside of the block and keep them.
    """
    kept: set[str] = set()
    _open.append([])
    try:
        yield kept.add
    finally:
        for path in _open.pop():
            if path not in kept:
                discard(spark, path)
            elif _open:
                _open[-1].append(path)


def leaving_nothing(function):
    """A function of a DataFrame that returns no plan over files: what it writes meanwhile is removed."""

    @wraps(function)
    def run(df: DataFrame, *args, **named):
        with scratch(df.sparkSession):
            return function(df, *args, **named)

    return run


def finished(spark: SparkSession, path: str, result: str) -> list[str]:
    """Names of the folders below ``path`` in which the named result has been written to its end, sorted."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(n for n in names if files.exists(_place(spark, f"{path}/{n}/{result}/_SUCCESS")[0]))


# --- results with a name --------------------------------------------------------------


def code_version() -> str:
    """A hash of the library's source files, without those of the text operators."""
    package = Path(__file__).resolve().parent.parent
    files = sorted(f for f in package.rglob("*.py") if f.relative_to(package).parts[0] != "llm")
    return hashlib.sha256(b"".join(f.read_bytes() for f in files)).hexdigest()


def fingerprint(spark: SparkSession, paths: Sequence[str], *settings: object) -> str:
    """A name for what is computed from the files below ``paths``: their names, sizes and times, the settings and the
    version of the code. A changed, added or missing file gives another name."""
    found = []
    for path in sorted(paths):
        place, files = _place(spark, path)
        if not files.exists(place):
            continue
        listed = files.listFiles(place, True)
        while listed.hasNext():
            file = listed.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return hashlib.sha256(repr((sorted(found), settings, code_version())).encode()).hexdigest()[:32]


def reused(spark: SparkSession, purpose: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The result with a name: read if an earlier run or session has finished it, else built, written and read.

    It is written elsewhere and moved when whole, so a lost run leaves nothing that looks finished, and of two
    sessions that build it at a time the first one counts. Intermediates of the building are removed.
    """
    path = f"{_root(spark)}/{purpose}-{name}"
    place, files = _place(spark, path)
    if not files.exists(_place(spark, f"{path}/_SUCCESS")[0]):
        with scratch(spark):
            _, written = materialise_at(build(), purpose)
            if not files.rename(_place(spark, written)[0], place) and not files.exists(place):
                raise OSError(f"cannot move {written} to {path}")
    return spark.read.parquet(path)

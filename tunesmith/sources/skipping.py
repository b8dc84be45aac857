"""A side table that says which files of a table may hold a value.

Row groups can be skipped by the order that a table is sorted in. For other columns a
side table keeps one row per file with the least and the greatest value of each column and
bit maps of its hashed values. A lookup asks the side table first; the scan then opens the
files that are left, which Spark selects by the hidden column with the file's name.

Files are known by name, size and time of change. Files that the side table does not know,
or knows in an older state, are opened, so a table may grow after its side table was written;
``extend_skipping`` then adds the new ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tunesmith.functions.exact import all_of, any_of, typed, unchanged
from tunesmith.sources.layout import DAY_OF, written
from tunesmith.sources.scratch import stored
from tunesmith.sources.tables import FILE, table_files

# Bits of one bit map, bits per distinct value, and maps of a file and column at most (a map is 4 KB).
MAP_BITS, BITS_PER_VALUE, MOST_MAPS = 32_768, 10, 256
# Files whose names go into a scan's filter.
NAMED_FILES = 10_000

def _mapped(kind: T.DataType) -> bool:
    """Are equal values of this type hashed alike? Text under a rule other than its bytes is not."""
    simple = isinstance(kind, (T.IntegralType, T.DateType, T.DecimalType, T.TimestampType, T.TimestampNTZType, T.DoubleType, T.FloatType, T.BooleanType, T.BinaryType))
    return simple or kind.simpleString() == "string"


def _place(value: Column, maps: Column) -> Column:
    """The bit of a value among all maps of a file."""
    return F.pmod(F.xxhash64(value), maps * MAP_BITS)


def write_skipping(spark: SparkSession, path: str, cols, side: str) -> None:
    """Write the side table of the Parquet table at ``path`` for the columns ``cols``.

    Each column is read twice, alone: once for rows, NULLs, least, greatest and about how
    many values a file has, once for the bit maps. Maps are sized for the file with the most
    values, ``BITS_PER_VALUE`` bits each, up to ``MOST_MAPS`` maps, which bounds the side
    table; past that the maps only let more files through.
    """
    df = written(spark, path)
    _profile(df, [cols] if isinstance(cols, str) else list(cols)).write.parquet(side)


def extend_skipping(spark: SparkSession, path: str, side: str) -> int:
    """Add the files that the side table does not know yet, reading no others; returns how many.

    A file that has changed is added in its new state; its old line fits no file any more.
    """
    known = spark.read.parquet(side)
    new = table_files(spark, path).join(known.select(*FILE), list(FILE), "left_anti").select("file_path")
    new = stored(new, "new-files")
    cols = [c.removeprefix("known_") for c in known.columns if c.startswith("known_")]
    total = new.count()
    slices = -(-total // NAMED_FILES)
    for k in range(slices):
        # So many names go to the driver at a time, give or take the unevenness of a hash.
        names = [r[0] for r in new.where(F.pmod(F.xxhash64("file_path"), F.lit(slices)) == k).collect()]
        if names:
            _profile(written(spark, path).where(F.col("_metadata.file_path").isin(names)), cols).write.mode("append").parquet(side)
    return total


def _profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per file of ``df``."""
    meta = [F.col(f"_metadata.{c}").alias(f"__{c}") for c in FILE]
    about = df.select(*meta, *cols).groupBy(*[f"__{c}" for c in FILE]).agg(
        F.count(F.lit(1)).alias("rows"),
        *[a for c in cols for a in (F.count(c).alias(f"known_{c}"), F.min(c).alias(f"least_{c}"), F.max(c).alias(f"greatest_{c}"), F.approx_count_distinct(c).alias(f"values_{c}"))],
    )
    found = about = stored(about.withColumnsRenamed({f"__{c}": c for c in FILE}), "files")
    most = about.agg(F.lit(0).alias("none"), *[F.max(f"values_{c}").alias(c) for c in cols]).first()
    for c in cols:
        if not _mapped(df.schema[c].dataType):
            continue
        maps = min(max(-(-(most[c] or 0) * BITS_PER_VALUE // MAP_BITS), 1), MOST_MAPS)
        at = df.where(F.col(c).isNotNull()).select(F.col("_metadata.file_path").alias("__path"), _place(F.col(c), F.lit(maps)).alias("__at"))
        # Maps are made where the rows are and put together by file.
        made = at.groupBy("__path", F.floor(F.col("__at") / MAP_BITS).cast("int").alias("__map")).agg(F.bitmap_construct_agg(F.col("__at") % MAP_BITS).alias("__bits"))
        made = made.groupBy("__path").agg(F.map_from_entries(F.collect_list(F.struct("__map", "__bits"))).alias(f"bits_{c}"))
        found = found.withColumn(f"maps_{c}", F.lit(maps)).join(made, F.col("file_path") == F.col("__path"), "left").drop("__path")
    return found


def _bit(maps: Column, at: Column) -> Column:
    """Is the bit set? A map that is not there has none."""
    bits = F.element_at(maps, F.floor(at / MAP_BITS).cast("int"))
    byte = F.substring(bits, F.floor(at % MAP_BITS / 8).cast("int") + 1, F.lit(1))
    return F.coalesce(F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1, F.lit(False))


def _may_hold(files: DataFrame, col: str, kind: T.DataType, values, ranges) -> Column:
    """Can a file hold one of the values, or a value in one of the ranges (either end None)?"""
    least, greatest, conds = F.col(f"least_{col}"), F.col(f"greatest_{col}"), []
    for value in values:
        if value is None:
            conds.append(F.col(f"known_{col}") < F.col("rows"))
            continue
        v = typed(value, kind)
        cond = (least <= v) & (greatest >= v)
        if f"bits_{col}" in files.columns and unchanged(value, kind):
            cond = cond & _bit(F.col(f"bits_{col}"), _place(v, F.col(f"maps_{col}")))
        conds.append(cond)
    for lo, hi in ranges:
        ends = ([greatest >= typed(lo, kind)] if lo is not None else []) + ([least <= typed(hi, kind)] if hi is not None else [])
        conds.append(all_of([F.col(f"known_{col}") > 0, *ends]))
    return F.coalesce(any_of(conds), F.lit(False))


def files_to_open(spark: SparkSession, path: str, side: str, wanted: dict) -> DataFrame:
    """Names of the files of the table that may hold a row with all that is ``wanted``, and of unknown ones.

    ``wanted`` maps a column of the side table to a list of values and (lo, hi) pairs.
    """
    known = spark.read.parquet(side)
    schema = written(spark, path).schema
    conds = [_may_hold(known, c, schema[c].dataType, *_split(listed)) for c, listed in wanted.items()]
    known = known.select(*[F.col(c).alias(f"__{c}") for c in FILE], all_of(conds).alias("__hit"))
    same = all_of([F.col(c) == F.col(f"__{c}") for c in FILE])
    return table_files(spark, path).join(known, same, "left").where(F.coalesce("__hit", F.lit(True))).select("file_path")


def _split(listed) -> tuple[list, list]:
    return [v for v in listed if not isinstance(v, tuple)], [v for v in listed if isinstance(v, tuple)]


def _is_wanted(df: DataFrame, col: str, listed) -> Column:
    (values, ranges), kind = _split(listed), df.schema[col].dataType
    given, conds = [v for v in values if v is not None], []
    if given:
        conds.append(F.col(col).isin([typed(v, kind) for v in given]))
    if len(given) < len(values):
        conds.append(F.col(col).isNull())
    for lo, hi in ranges:
        ends = ([F.col(col) >= typed(lo, kind)] if lo is not None else []) + ([F.col(col) <= typed(hi, kind)] if hi is not None else [])
        conds.append(all_of([F.col(col).isNotNull(), *ends]))
    return any_of(conds)


def skipping_lookup(spark: SparkSession, path: str, side: str, wanted: dict, cols=None) -> DataFrame:
    """Rows of the table with, for every column of ``wanted``, one of its values or a value in one of its ranges.

    ``wanted`` maps a column to a list of values (None: NULL) and (lo, hi) pairs (both ends
    included, either may be None). An empty list matches nothing. With over ``NAMED_FILES``
    files left their names are not put into the scan; the rows are the same.
    """
    df = written(spark, path)
    cols = cols or [f.name for f in df.schema.fields if DAY_OF not in (f.metadata or {})]
    rows = df.where(all_of([_is_wanted(df, c, listed) for c, listed in wanted.items()]))
    names = [r[0] for r in files_to_open(spark, path, side, wanted).limit(NAMED_FILES + 1).collect()]
    if len(names) <= NAMED_FILES:
        rows = rows.where(F.col("_metadata.file_path").isin(names) if names else F.lit(False))
    return rows.select(*cols)

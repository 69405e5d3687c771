"""Reading, materialising and size-checked broadcasting for the operators of this subpackage."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import written

BROADCAST_BYTES = 32 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES
            ) -> tuple[DataFrame, bool]:
    """A written form of ``df``, and whether all its rows fit the broadcast bound.

    ``row_bytes``: a bound for every row, or an expression that says what each takes.
    """
    table = written(df)
    each = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    return table, (table.agg(F.sum(each)).first()[0] or 0) <= limit


def lookup(big: DataFrame, small: DataFrame, on: list[str], how: str,
           row_bytes: int | Column) -> DataFrame:
    """Join that broadcasts ``small`` only after its size was checked; shuffles otherwise."""
    table, fits = bounded(small, row_bytes)
    return big.join(F.broadcast(table) if fits else table.hint("merge"), on, how)


def through_python(df: DataFrame, fn, schema: str, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``mapInPandas`` that brings 64-bit ids back as they were.

    A pandas column of longs with a null among them is one of floats, which changes ids beyond 2^53;
    so ids travel as text. ``schema`` names them as string.
    """
    sent = df.withColumns({c: F.col(c).cast("long").cast("string") for c in ids})
    return sent.mapInPandas(fn, schema).withColumns({c: F.col(c).cast("long") for c in ids})


def row_key(df: DataFrame) -> DataFrame:
    """Adds __id and __text: the doc_id and a hash of the text, neither null, to tell rows apart."""
    return df.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)),
                           "__text": F.xxhash64("text")})


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (__id, __text) is not in ``dropped``; all columns as they were.

    The texts are not shuffled while the dropped keys fit the broadcast bound.
    """
    keys = dropped.select("__id", "__text").distinct()
    return lookup(row_key(docs), keys, ["__id", "__text"], "left_anti", row_bytes=24).select(
        *docs.columns)

"""Shared helpers: table access, shared storage and vectorised text passes over Arrow buffers."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys with more rows than HOT_ROWS, or than an even share of HOT_KEYS, are joined without a shuffle.
HOT_ROWS, HOT_KEYS = 10_000, 10_000
#: Bytes of text that one vectorised pass holds at a time; longer texts form a pass of their own.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; other columns never leave the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new path below the folder that driver and executors share.

    The cluster names it in spark.checkpoint.dir. Only a session without that setting (tests, a
    laptop) gets a folder below the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def settle(df: DataFrame, what: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back, which cuts its lineage.

    The files outlive the executors that wrote them.
    """
    path = shared_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def own_columns(df: DataFrame) -> list[Column]:
    return [F.col(quoted(c)) for c in df.columns]


def private(df: DataFrame, *names: str) -> list[str]:
    """A name for each of `names` that no column of df has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while (name := f"_{name}").lower() in taken:
            pass
        out.append(name)
    return out


def carried(documents: DataFrame, keep: bool) -> tuple[DataFrame, list[T.StructField]]:
    """doc_id and text; with keep the other columns too, as the struct `kept`. Also the fields beyond doc_id."""
    others = [F.col(quoted(c)) for c in documents.columns if c not in ("doc_id", "text")] if keep else []
    source = documents.select("doc_id", "text", *([F.struct(*others).alias("kept")] if others else []))
    return source, [f for f in source.schema if keep and f.name != "doc_id"]


def restored(found: DataFrame, documents: DataFrame) -> DataFrame:
    """The columns of documents again, out of what `carried` made of them."""
    return found.select(*(F.col(c) if c in ("doc_id", "text") else F.col("kept").getField(c).alias(c) for c in documents.columns))


def spread_join(rows: DataFrame, keyed: DataFrame, on: list[str], total: int, n: str = "n") -> DataFrame:
    """rows joined to keyed, which has one row for each key and in `n` how many of the `total` rows have it.

    Rows of hot keys stay where they are: at most HOT_KEYS keys can have more than total / HOT_KEYS
    rows, so those keys' rows of `keyed` are broadcast. All others are joined by a shuffle in which no
    key has more rows than that. Null keys match nothing.
    """
    limit = max(HOT_ROWS, total // HOT_KEYS)
    if total <= limit:
        return rows.join(keyed.drop(n), on)
    hot = F.broadcast(keyed.where(F.col(n) > limit).drop(n))
    cold = rows.join(hot.select(*on), on, "left_anti").join(keyed.where(F.col(n) <= limit).drop(n), on)
    return rows.join(hot, on).unionByName(cold)


def spread_left_join(rows: DataFrame, keyed: DataFrame, on: list[str], total: int, n: str = "n") -> DataFrame:
    """The same, with all rows kept: those of hot keys by a broadcast, all others by one left join."""
    limit = max(HOT_ROWS, total // HOT_KEYS)
    payload = [c for c in keyed.columns if c not in (*on, n)]
    if total <= limit:
        return rows.join(keyed.drop(n), on, "left")
    hot = keyed.where(F.col(n) > limit).drop(n)
    hot = F.broadcast(hot.withColumnsRenamed({c: f"hot_{c}" for c in payload}).withColumn("hot_key", F.lit(True)))
    told = rows.join(hot, on, "left")
    # A hot row is found already; its own number takes its place in the shuffle.
    spread = F.when(F.col("hot_key"), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    cold = keyed.where(F.col(n) <= limit).drop(n).withColumn("hot_spread", F.lit(-1).cast("long"))
    found = told.withColumn("hot_spread", spread).join(cold, [*on, "hot_spread"], "left")
    return found.select(*rows.columns, *(F.coalesce(c, f"hot_{c}").alias(c) for c in payload))


def held_out(doc_id: str, modulus: int, remainder: int) -> F.Column:
    """True where crc32 of the id's decimal text leaves the remainder; null ids count as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


class TextBlock:
    """Consecutive rows as one UTF-8 buffer: data (uint8) and the rows' offsets in it."""

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets

    @property
    def rows(self) -> int:
        return self.hi - self.lo

    def text(self, row: int) -> str:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes().decode("utf-8", "replace")


def text_blocks(column: pa.Array, most: int = CHUNK_BYTES):
    """Splits an Arrow string column into TextBlocks of about `most` bytes; null texts are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield TextBlock(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


_ODD = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        up = np.full(n, base, np.uint64)
        down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        held = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if n <= 4 * CHUNK_BYTES:
            _powers[base] = held
    return held


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which each input bit reaches each output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _ODD) -> np.ndarray:
    """64-bit hashes of values[start:end]; equal spans hash alike wherever they stand."""
    up, down = _power_table(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def runs(inside: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run never crosses one of the breaks."""
    n = len(inside)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    at = breaks[(breaks > 0) & (breaks < n)]
    starts[at] = inside[at]
    ends = np.zeros(n + 1, bool)
    ends[1:n] = inside[:-1] & (~inside[1:] | starts[1:])
    ends[n] = n > 0 and inside[-1]
    return np.flatnonzero(starts), np.flatnonzero(ends)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k consecutive word hashes at each position (the last k - 1 have none)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h *= np.uint64(_ODD)
        h += words[j : j + n]
    return mix64(h + np.uint64(k))

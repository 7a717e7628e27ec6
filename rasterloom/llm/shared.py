"""What the operators of this subpackage share: the shared folder, written tables, prefix sums."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset on one machine (tests), a new local one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-rasterloom-")
        base = _own[app]
    return base.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/rasterloom/{label}-{uuid.uuid4().hex}"


#: Whether a write's shuffles are deleted at its end. Else they stay until the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts the lineage and outlives executors. Its shuffles are
    deleted, the session's own setting for that stays as it was."""
    path, conf = fresh_path(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read any more: what was made of them has been written itself."""
    for t in tables:
        session = t.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(t._written)
        path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Rows of one value in a task of a join, beyond which they are dealt over several; rows of a side up to which it is broadcast.
DEALT, BROADCAST_ROWS = 1024, 1_000_000


def often(rows: DataFrame, on: list[str]) -> DataFrame | None:
    """The values of ``on`` with more than DEALT rows, with the ``parts`` to deal them into; None if there are none."""
    found = written(rows.groupBy(*on).agg(F.ceil(F.count("*") / DEALT).cast("int").alias("parts")).where("parts > 1"), "often")
    n = found.count()
    return None if n == 0 else F.broadcast(found) if n <= BROADCAST_ROWS else found


def met(rows: DataFrame, side: DataFrame, on: list[str], spread: list[str], many: DataFrame | None) -> DataFrame:
    """``rows`` joined with the one row of ``side`` per value of ``on``; the values in ``many`` (see ``often``) are dealt
    over several tasks by a hash of ``spread``, with a copy of their row of ``side`` each."""
    if many is None:
        return rows.join(side, on)
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(many, on, "left").withColumn("_part", F.pmod(F.xxhash64(*spread), parts).cast("int")).drop("parts")
    copies = side.join(many, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(copies, [*on, "_part"]).drop("_part")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def packed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as one struct column ``_row``: no helper column can clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def numbered(rows: DataFrame, key: str, out: str, order: str | None = None) -> DataFrame:
    """Adds ``out``: numbers from 1 of the rows of equal ``key``, by ``order`` or in any order.

    Rows of a key are numbered together, those of one that has more than DEALT by the task that read them, after the rows
    of the tasks before; ``rows`` must be read from a table, so that a task reads the same rows each time.
    """
    many = often(rows.select(key), [key])
    by = order or key
    if many is None:
        return rows.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy(by)))
    dealt = rows.withColumn("_task", F.spark_partition_id()).join(many, key, "left")
    dealt = dealt.withColumn("_task", F.when(F.col("parts").isNotNull(), F.col("_task")).otherwise(-1)).drop("parts")
    counts = written(dealt.where("_task >= 0").groupBy(key, "_task").agg(F.count("*").alias("_n")), "task-counts")
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(key, "_task", before.alias("_before"))
    side = F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts
    here = F.row_number().over(Window.partitionBy(key, "_task").orderBy(by))
    return dealt.join(side, [key, "_task"], "left").withColumn(out, (here + F.coalesce("_before", F.lit(0))).cast("long")).drop("_task", "_before")


def top_bits(hash_col: Column, bits: int) -> Column:
    """The leading bits of a signed 64-bit hash as a number whose order is that of the hash."""
    return F.shiftrightunsigned(hash_col.bitwiseXOR(F.lit(-(2**63))), 64 - bits).cast("int")


def with_running_total(df: DataFrame, keys: list[str], hash_name: str, ties: list[str], value: str, out: str, bits: int = 10) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows of the same keys that come before in the order of (hash, ties).

    A key may hold any share of the rows: they are dealt by (keys, leading bits of the hash), summed per such
    bucket, and only the sums (at most 2^bits a key) are accumulated in one place. Null keys are keys like any other.
    """
    keyed = df.withColumn("_bucket", top_bits(F.col(hash_name), bits))
    names = [f"_k{i}" for i in range(len(keys))]
    for n, k in zip(names, keys):
        keyed = keyed.withColumn(n, F.struct(F.col(k).isNull().alias("n"), F.col(k).alias("v")))
    sums = keyed.groupBy(*names, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*names, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    on = None
    s = sums.select(*[F.col(n).alias(f"_r{n}") for n in names], F.col("_bucket").alias("_rb"), "_offset")
    for n in names:
        c = F.col(n).eqNullSafe(F.col(f"_r{n}"))
        on = c if on is None else on & c
    c = F.col("_bucket") == F.col("_rb")
    joined = keyed.join(s, c if on is None else on & c)
    within = Window.partitionBy(*names, "_bucket").orderBy(hash_name, *ties).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_offset") + F.coalesce(F.sum(value).over(within), F.lit(0))
    return joined.withColumn(out, total).drop(*names, *[f"_r{n}" for n in names], "_rb", "_bucket", "_offset")


def ranked(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` as a written table with ``rank`` (from 0) within their group, by ``order``, and ``total``, the group's size.

    Nulls come first and a null group is a group. Rows are sorted by range over as many tasks as a shuffle has, however
    large a group is; only the counts of (group, task) are accumulated. Rows alike in all of these columns are ranked in
    any order.
    """
    by = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), label)
    names = [f"_g{i}" for i in range(len(group))]
    task = F.shiftright("_at", 33)
    counts = placed.groupBy(*[F.col(c).alias(n) for n, c in zip(names, group)], task.alias("_task")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    every = Window.partitionBy(*names)
    before = F.coalesce(F.sum("_n").over(every.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = written(counts.select(*names, "_task", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(every).alias("total")), f"{label}-counts")
    on = task == F.col("_task")
    for a, c in zip(names, group):
        on = on & F.col(c).eqNullSafe(F.col(a))
    side = F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts
    return placed.join(side, on).withColumn("rank", F.col("_at") + F.col("_shift")).drop(*names, "_task", "_shift", "_at")

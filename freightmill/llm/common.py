"""Helpers shared by the text operators: word splitting, cutting lineage, scratch columns."""

from __future__ import annotations

import gc
import tempfile
import time

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_GAP = r"[\x20\x09-\x0D]+"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def scratch_names(frame: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``frame`` does not use (compared without case)."""
    taken = {c.lower() for c in frame.columns}
    names = []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; NULL as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # ``lower`` works on bytes where a text is all ASCII and is much faster there.
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def words(text: Column) -> Column:
    """Lower-cased words between blanks and ASCII control spaces; empty array without any."""
    return F.array_remove(F.split(ascii_lower(text), WORD_GAP), "")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a temporary folder is made if all of Spark runs on this machine; on a
    cluster nothing would be shared, so that is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp()


#: Seconds between two requests to let go of shuffle files.
RELEASE_EVERY = 2.0
_released = 0.0


def give_back(spark: SparkSession) -> bool:
    """Ask the driver's JVM to hand free native memory to the system; whether it could.

    The C library otherwise keeps what was freed, apart for many threads, and the driver of many
    small stages has hundreds of them. The JVM's own command ``System.trim_native_heap`` is
    called through its management bean, inside the process. JVMs without it (other systems than
    Linux, before 17.0.9) go on as they are.
    """
    context = spark.sparkContext
    jvm, array = context._jvm, context._gateway.new_array
    named = jvm.java.lang.Class.forName
    kinds = array(jvm.java.lang.Class, 4)
    given = array(jvm.java.lang.Object, 4)
    try:
        names = ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
        for k, name in enumerate(names):
            kinds[k] = named(name)
        given[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        given[1] = "systemTrimNativeHeap"
        given[2] = array(jvm.java.lang.Object, 0)
        given[3] = array(jvm.java.lang.String, 0)
        call = named("javax.management.MBeanServer").getMethod("invoke", kinds)
        call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        return False
    return True


def cut(frame: DataFrame) -> DataFrame:
    """Write ``frame`` to the reliable checkpoint folder once and go on from there.

    The shuffle files and checkpoints that only its lineage needed stay on disk until the driver
    collects its garbage, which it does every half hour where memory is not short; so it is
    asked to, from time to time, and to hand back the memory. What is still in use stays.
    """
    global _released
    spark = frame.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    frame = frame.checkpoint(eager=True)
    if time.monotonic() - _released > RELEASE_EVERY:
        gc.collect()  # lets go of the frames that hold the lineage
        spark.sparkContext._jvm.System.gc()
        give_back(spark)
        _released = time.monotonic()
    return frame


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Long values go to Python by 8 MB at a time: a batch is held several times over, in the
    executor outside its heap and in each of its Python workers.

    Sets ``spark.sql.execution.arrow.maxBytesPerBatch`` of the session, unless it is lower.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20


def measured(frame: DataFrame) -> DataFrame:
    """``frame``, written once and counted: marked for broadcast only if it is small enough.

    Beyond the bounds it stays a plain table, and a join with it shuffles.
    """
    frame = cut(frame)
    size = F.sum(F.length(F.to_json(F.struct(*[f"`{c}`" for c in frame.columns]))))
    rows, size = frame.agg(F.count("*"), size).first()
    return F.broadcast(frame) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else frame


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")

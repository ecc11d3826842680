"""Operators that prepare text for language-model training. Nothing else in the library imports this subpackage."""

import ctypes
import functools

import pyarrow as pa

# Python workers live on from task to task: freed Arrow memory goes back to the system, not to a pool.
pa.set_memory_pool(pa.system_memory_pool())


#: Bytes of an Arrow batch between the JVM and a worker. By rows alone, a batch of texts can be a whole input split, held
#: several times over by each task.
BATCH_BYTES = 4 << 20


def bounded_batches(spark) -> None:
    """Sets the bytes of an Arrow batch in this session, unless the session was started with a value of its own."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(setting):
        spark.conf.set(setting, str(BATCH_BYTES))


def unused(df, name: str) -> str:
    """A column name that ``df`` doesn't have, in any spelling of case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tidy(task):
    """``task`` (an iterator of batches to another) that hands the worker's freed memory back at its end, where the C
    library can."""

    @functools.wraps(task)
    def run(batches):
        yield from task(batches)
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass

    return run

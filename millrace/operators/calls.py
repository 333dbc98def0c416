"""Calls of a slow service from tasks: some at once, with time limits, tries and a log of answers."""

from __future__ import annotations

import json
import queue
import threading
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import opened, written


class TooManyHang(Exception):
    """So many calls of a task don't end that no more are made."""


class Answers:
    """Answers of one task, in the folder ``log``: a line each, written before the next call begins.

    A task that runs again first reads what its earlier attempts wrote, which
    are the files of its partition's number.
    """

    def __init__(self, log: str, job: str, part: int):
        from pyarrow import fs

        self.system, folder = opened(log)
        self.system.create_dir(folder, recursive=True)
        mine = f"{job}-{part}-"
        self.known: dict[tuple[str, str | None], str] = {}
        for e in self.system.get_file_info(fs.FileSelector(folder)):
            if e.base_name.startswith(mine):
                for line in self.system.open_input_stream(e.path).read().decode().split("\n"):
                    try:
                        row = json.loads(line)
                    except ValueError:  # the end of a file whose writer was killed
                        continue
                    self.known[(row["path"], row["expected"])] = row["answer"]
        self.out = self.system.open_output_stream(f"{folder}/{mine}{uuid.uuid4().hex}.json")
        self.lock = threading.Lock()

    def add(self, path: str, expected: str | None, answer: str) -> None:
        with self.lock:
            self.out.write((json.dumps({"path": path, "expected": expected, "answer": answer}) + "\n").encode())
            self.out.flush()

    def close(self) -> None:
        self.out.close()


class Pool:
    """``workers`` calls at once. A call that takes longer than ``timeout`` is given up; its thread is left behind and replaced.

    Threads can't be stopped, so no more than ``most_hanging`` may be left
    behind; after that calls fail at once.
    """

    def __init__(self, call: Callable, workers: int, timeout: float, tries: int, backoff: float, most_hanging: int = 64):
        self.call, self.workers, self.timeout, self.tries, self.backoff = call, workers, timeout, tries, backoff
        self.most_hanging, self.hanging = most_hanging, 0

    def _once(self, item: tuple) -> str:
        done: queue.Queue = queue.Queue()

        def run() -> None:
            try:
                done.put((self.call(*item), None))
            except Exception as e:
                done.put((None, e))

        if self.hanging >= self.most_hanging:
            raise TooManyHang(f"{self.hanging} calls didn't end")
        threading.Thread(target=run, daemon=True).start()
        try:
            answer, error = done.get(timeout=self.timeout)
        except queue.Empty:
            self.hanging += 1
            raise TimeoutError(f"no answer in {self.timeout} s") from None
        if error is not None:
            raise error
        return answer

    def ask(self, item: tuple) -> tuple[str | None, str | None]:
        """Answer, or what the last try raised. A call that hung isn't tried again."""
        for k in range(self.tries):
            try:
                return self._once(item), None
            except (TimeoutError, TooManyHang) as e:
                return None, f"{type(e).__name__}: {e}"
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
                if k + 1 < self.tries:
                    time.sleep(self.backoff * 2**k)
        return None, error

    def map(self, items: list[tuple], then: Callable) -> list[tuple[str | None, str | None]]:
        """:meth:`ask` of each item, in their order; ``then`` gets each answer as it comes."""
        out: list = [(None, None)] * len(items)
        todo = iter(range(len(items)))
        lock = threading.Lock()

        def work() -> None:
            while True:
                with lock:
                    i = next(todo, None)
                if i is None:
                    return
                out[i] = self.ask(items[i])
                if out[i][1] is None:
                    then(items[i], out[i][0])

        threads = [threading.Thread(target=work, daemon=True) for _ in range(min(self.workers, len(items)))]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        return out


def answered(images: DataFrame, log: str) -> DataFrame:
    """``path, expected, answer`` of what is in the log; of several answers to one request the least."""
    spark = images.sparkSession
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(log)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "path string, expected string, answer string")
    rows = spark.read.schema("path string, expected string, answer string").option("mode", "DROPMALFORMED").json(log)
    return rows.where("answer is not null").groupBy("path", "expected").agg(F.min("answer").alias("answer"))


def ask_all(images: DataFrame, client: Callable[[str, str], str], workers: int = 4, timeout: float = 120.0, tries: int = 2, backoff: float = 0.5, log: str | None = None) -> DataFrame:
    """``path, answer, error`` of each (path, expected), asked once.

    A task has ``workers`` calls under way at a time, so a job has as many times
    that as it has cores. A call that raises is tried again, ``tries`` times in
    all, after ``backoff`` seconds, twice that and so on; one that gives no answer
    in ``timeout`` seconds isn't. What fails leaves its reason in ``error``; the
    file stays where it is.

    With a ``log`` (a folder that executors share, by URI) every answer is
    written as it comes: what a lost task had asked its next attempt doesn't
    ask, and a later run with the same log asks only what has no answer yet.
    Answers belong to a path and what was expected. Repeated rows are asked
    once each, but by a log. A row's order within its partition stays.
    """
    job, rows = uuid.uuid4().hex, images.select("path", "expected")
    schema = "path string, answer string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = Pool(client, workers, timeout, tries, backoff)
        book = Answers(log, job, TaskContext.get().partitionId()) if log else None
        known = book.known if book else {}
        try:
            for b in batches:
                items = [(p, None if pd.isna(e) else e) for p, e in zip(b["path"], b["expected"], strict=True)]
                new = [i for i in items if i not in known]
                found = iter(pool.map(new, (lambda item, answer: book.add(*item, answer)) if book else lambda item, answer: None))
                both = [(known[i], None) if i in known else next(found) for i in items]
                yield pd.DataFrame([(i[0], *a) for i, a in zip(items, both, strict=True)], columns=["path", "answer", "error"])
        finally:
            if book:
                book.close()

    if not log:
        return written(rows.mapInPandas(run, schema))
    before = written(answered(images, log))
    same = F.col("path").eqNullSafe(F.col("_path")) & F.col("expected").eqNullSafe(F.col("_expected"))
    marked = rows.join(before.toDF("_path", "_expected", "answer"), same, "left")
    old = marked.where("answer is not null").select("path", "answer", F.lit(None).cast("string").alias("error"))
    return written(old.unionByName(rows.join(before.toDF("_path", "_expected", "answer"), same, "left_anti").mapInPandas(run, schema)))
